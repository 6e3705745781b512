"""Line dedup: explode normalised lines, hash, count documents per hash, drop, reassemble by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerscore.llm.common import SPACE, carried, fresh_names, lower_ascii
from tellerscore.session import materialize

_OUT = ["n_lines", "n_dropped"]


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(SPACE)))


def dedupe_lines(
    docs: DataFrame,
    min_chars: int = 20,
    min_docs: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Drop lines that ``min_docs`` documents share, except in the largest id that holds them.

    A line takes part if its key has ``min_chars`` code points. Returns every input row with the new
    text and ``n_lines`` (before dropping) and ``n_dropped``.

    Null or empty text is one empty line, and null becomes empty. A null id counts as the smallest id.
    Rows with one id are one document when documents are counted; each row keeps its own lines, and
    rows that repeat id and text come out alike. No rows give no rows. Input columns named like an
    output are replaced.

    Keys are two independent 64-bit hashes. Counting first makes (key, id) distinct and combines before
    each shuffle, so a line found everywhere is never gathered; the join of lines with dropped keys is a
    merge join whose skewed partitions adaptive execution splits.
    """
    wanted = fresh_names(docs, _OUT)
    text = F.coalesce(text_col, F.lit(""))
    # The lines go through the join as an array, so that the projection above it only picks elements.
    rows = wanted.select(
        carried(wanted, text_col),
        F.col(id_col).alias("_doc"),
        F.xxhash64(text).alias("_row"),
        F.split(text, "\n", -1).alias("_lines"),
    )
    exploded = rows.select(
        F.col("_doc").alias("id"), F.col("_row").alias("row"), F.posexplode("_lines").alias("pos", "line")
    ).select("id", "row", "pos", line_key(F.col("line")).alias("key"))
    hashed = materialize(
        exploded.where(F.length("key") >= min_chars).select(
            "id", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2")
        ),
        "lines",
    )
    # Written, so that both sides of the join with it are plain exchanges, whose hot keys can be split.
    shared = materialize(
        hashed.select("h1", "h2", "id")
        .distinct()
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2", "last"),
        "shared-lines",
    )
    dropped = (
        hashed.join(shared, ["h1", "h2"])
        .where(~F.col("id").eqNullSafe(F.col("last")))
        .groupBy("id", "row")
        .agg(F.collect_set("pos").alias("_gone"))
        .select(F.col("id").alias("_id"), F.col("row").alias("_gone_row"), "_gone")
    )
    joined = rows.join(
        dropped, rows["_doc"].eqNullSafe(dropped["_id"]) & (rows["_row"] == dropped["_gone_row"]), "left"
    )
    places = F.array_except(
        F.sequence(F.lit(0), F.size("_lines") - 1), F.coalesce("_gone", F.array().cast("array<int>"))
    )
    kept = F.array_join(F.transform(places, lambda i: F.get("_lines", i)), "\n")
    return joined.select(
        *[kept.alias(c) if c == text_col else F.col(f"_in.`{c}`").alias(c) for c in wanted.columns],
        F.size("_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
