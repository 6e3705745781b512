"""Secret scans: fixed patterns, and character Markov models of random strings against identifiers.

Everything is column expressions: patterns are matched inside Spark, the models are counted by
grouping character pairs of labelled samples, and candidates are scored from a literal table.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tellerscore.llm.common import fresh_names
from tellerscore.session import materialize

# The patterns of the base kinds, what must be at least how long, and their order.
PATTERNS = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: Kinds by number: the base kinds, then what the models add.
KINDS = (*PATTERNS, "markov")

#: Strings that the models judge are maximal runs of these characters.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CLASS = "[A-Za-z0-9+/_=-]"
_SIZE = len(ALPHABET) + 1  # code 0 is the start of a string
_OUT = ["spans", "n_assign", "n_access", "n_hex", "n_markov"]


def _runs(text: Column, kind_no: int, pattern: str) -> Column:
    """Matches in order: their kind, the length of the text since the match before, and the match."""
    hits = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, hit: F.struct(F.lit(kind_no).alias("kind_no"), F.length(gap).alias("gap"), hit.alias("value")),
    )
    return F.when(text.rlike(pattern), hits).otherwise(F.array().cast("array<struct<kind_no:int,gap:int,value:string>>"))


def _codes(text: str, at: str) -> str:
    return f"locate(substring({text}, {at}, 1), '{ALPHABET}')"


def _secret(kind_no: Column, value: Column) -> Column:
    """The random part of a base span."""
    return F.when(kind_no == 0, F.regexp_extract(value, PATTERNS["assign"], 2)).otherwise(value)


def _log_ratios(random: DataFrame, ordinary: DataFrame) -> list[float] | None:
    """Log probability ratio of each character pair, ``before * _SIZE + after``, add-half smoothed.

    Each input has one column ``value``. Only the pair counts, at most ``2 * _SIZE ** 2`` numbers, come
    to the driver.
    """
    strings = random.select(F.lit(1).alias("is_random"), "value").unionByName(
        ordinary.select(F.lit(0).alias("is_random"), "value")
    )
    pairs = (
        strings.where(F.length("value") > 0)
        .select("is_random", "value", F.explode(F.sequence(F.lit(1), F.length("value"))).alias("i"))
        .select(
            "is_random",
            F.expr(f"IF(i = 1, 0, {_codes('value', 'i - 1')})").alias("a"),
            F.expr(_codes("value", "i")).alias("b"),
        )
    )
    counts = [[0.5] * _SIZE**2, [0.5] * _SIZE**2]
    seen = [0, 0]
    for row in pairs.groupBy("is_random", "a", "b").count().collect():
        counts[row["is_random"]][row["a"] * _SIZE + row["b"]] += row["count"]
        seen[row["is_random"]] += row["count"]
    if not all(seen):
        return None
    ratios = []
    for a in range(_SIZE):
        ordinary_row, random_row = (c[a * _SIZE : (a + 1) * _SIZE] for c in counts)
        shift = math.log(sum(ordinary_row) / sum(random_row))
        ratios += [round(math.log(r / o) + shift, 6) for o, r in zip(ordinary_row, random_row)]
    return ratios


def _ratio(ratios: list[float]) -> Column:
    """Log-likelihood ratio of the column ``value``, by one look-up per character in a literal table."""
    table = f"from_json('{json.dumps(ratios)}', 'array<double>')"
    pair = f"IF(i = 1, 0, {_codes('value', 'i - 1')}) * {_SIZE} + {_codes('value', 'i')}"
    return F.expr(f"aggregate(sequence(1, length(value)), 0D, (sum, i) -> sum + get({table}, {pair}))")


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    margin: float = 12.0,
    train_docs: int = 1000,
    train_secrets: int = 50_000,
) -> DataFrame:
    """Find secrets in whole texts.

    Returns every input row without its text, with ``spans``, an array of ``(start, kind_no, end)`` in
    order, and the number of spans of each kind. Positions are code points, ends exclusive; ``KINDS``
    names the kinds.

    The base kinds match leftmost and non-overlapping and drop failing matches. A run of ``min_chars``
    or more characters that touches no base span is a ``markov`` span if the log-likelihood ratio of the
    two models exceeds ``margin``. The models learn from labelled samples of this input: values of base
    spans (``train_secrets`` of them at most, on average) are random strings; the other words of about
    ``train_docs`` documents, chosen by hash, are ordinary. Both bounds only limit training.

    Null text counts as empty. A null id is a value like any other. Rows that repeat id and text come
    out alike. Without base spans or other words there is nothing to learn from, and no markov span. No
    rows give no rows. Input columns named like an output are replaced.

    A position is a running sum over the matches of one document, so the cost is linear in them.
    """
    wanted = fresh_names(docs, _OUT)
    text = F.coalesce(text_col, F.lit(""))
    # Runs of one class that are long enough match as a whole, so only these two patterns can skip short ones.
    patterns = [
        PATTERNS["assign"],
        PATTERNS["access"],
        f"[0-9a-f]{{{LEAST['hex']},}}",
        f"{_CLASS}{{{min_chars},}}",
    ]
    hits = (
        docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("row"), text.alias("text"))
        .select("id", "row", F.concat(*[_runs(F.col("text"), i, p) for i, p in enumerate(patterns)]).alias("hits"))
        .where(F.size("hits") > 0)
        .select("id", "row", F.posexplode("hits").alias("pos", "hit"))
        .select("id", "row", "pos", "hit.*")
        .where(F.col("value").isNotNull())
        .repartition("id", "row")  # of one document, for the three steps that follow
        .dropDuplicates(["id", "row", "pos"])
    )
    before = Window.partitionBy("id", "row", "kind_no").orderBy("pos")
    end = F.sum(F.col("gap") + F.length("value")).over(before)
    least = F.when(F.col("kind_no") == 1, F.length("value") >= LEAST["access"]).otherwise(
        (F.col("kind_no") != 0) | (F.length(_secret(F.col("kind_no"), F.col("value"))) >= LEAST["assign"])
    )
    spans = (
        hits.withColumn("end", end)
        .where(least)
        .select("id", "row", "kind_no", (F.col("end") - F.length("value")).alias("start"), "end", "value")
    )
    in_order = Window.partitionBy("id", "row").orderBy("start", "kind_no")
    base = F.col("kind_no") < 3
    reach = F.max(F.when(base, F.col("end"))).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    next_base = F.min(F.when(base, F.col("start"))).over(in_order.rowsBetween(0, Window.unboundedFollowing))
    alone = (F.coalesce(reach, F.lit(0)) <= F.col("start")) & (F.coalesce(next_base, F.col("end")) >= F.col("end"))
    spans = materialize(spans.withColumn("alone", base | alone).where("alone").drop("alone"), "secret-spans")

    ratios = _train(docs, spans, text, train_docs, train_secrets)
    judged = F.lit(False) if ratios is None else _ratio(ratios) > margin
    by_doc = (
        spans.where(base | judged)
        .groupBy("id", "row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "kind_no", "end"))).alias("spans"))
    )
    rows = wanted.withColumn("_row", F.xxhash64(text)).drop(text_col)
    joined = rows.join(by_doc, rows[id_col].eqNullSafe(by_doc["id"]) & (rows["_row"] == by_doc["row"]), "left")
    none = F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint>>")
    out = joined.select(
        *[rows[c] for c in rows.columns if c != "_row"], F.coalesce(by_doc["spans"], none).alias("spans")
    )
    return out.withColumns({f"n_{kind}": _count(F.col("spans"), i) for i, kind in enumerate(KINDS)})


def _count(spans: Column, kind_no: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind_no"] == kind_no)).cast("long")


def _train(docs: DataFrame, spans: DataFrame, text: Column, train_docs: int, train_secrets: int) -> list[float] | None:
    n_docs, n_secrets = docs.count(), spans.where("kind_no < 3").count()
    if not n_docs or not n_secrets:
        return None
    parts = 1 << 30
    chosen = docs.select(text.alias("text")).where(
        F.pmod(F.xxhash64("text"), F.lit(parts)) < int(parts * min(1.0, train_docs / n_docs))
    )
    blanked = F.col("text")
    for pattern in PATTERNS.values():
        blanked = F.regexp_replace(blanked, pattern if pattern != PATTERNS["hex"] else "[0-9a-f]{24,}", " ")
    words = chosen.select(F.explode(F.regexp_extract_all(blanked, F.lit(_CLASS + "{4,}"), F.lit(0))).alias("value"))
    secrets = spans.where(
        (F.col("kind_no") < 3)
        & (F.pmod(F.xxhash64("id", "start"), F.lit(parts)) < int(parts * min(1.0, train_secrets / n_secrets)))
    ).select(_secret(F.col("kind_no"), F.col("value")).alias("value"))
    return _log_ratios(secrets, words)


def joined(spans: Column, kinds: int = len(KINDS)) -> Column:
    """``kind:start:end`` of the first ``kinds`` kinds, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.filter(spans, lambda s: s["kind_no"] < kinds),
            lambda s: F.concat_ws(":", F.get(names, s["kind_no"]), s["start"], s["end"]),
        ),
        ",",
    )
