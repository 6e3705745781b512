"""Exact dedup against a persistent digest index.

The index is a table bucketed and sorted by digest, with a partition per batch. A batch of documents is
reduced to one row per digest (combined map-side, so a hot digest is no hot task), kept apart from what
other batches brought by a sort-merge anti-join that reads the index without a shuffle, and appended. A
retry under the same batch name replaces its partition and decides as the first try did.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerscore.llm.common import SPACE_CLASS, carried, fresh_names, shuffle_partitions
from tellerscore.session import materialize, new_path

_OUT = ["digest", "keep_id", "group_size", "kept", "indexed_before"]


class DigestIndex:
    """Digests seen so far: ``digest, keep_id, n_rows, batch``, bucketed and sorted by ``digest``.

    ``path`` belongs to the index for good; a later session opens it again with the same number of
    buckets. ``n_rows`` counts the copies in the batch that brought the digest in.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest STRING, keep_id BIGINT, n_rows BIGINT, batch STRING) "
            f"USING parquet PARTITIONED BY (batch) "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
        spark.catalog.recoverPartitions(self.table)  # another session may have added batches

    def read(self, without: str | None = None) -> DataFrame:
        """All digests, or those that other batches than one brought."""
        rows = self.spark.table(self.table)
        return rows if without is None else rows.where(F.col("batch") != without)

    def append(self, rows: DataFrame, batch: str) -> None:
        """Add what a batch brings, which must be written already; one file per bucket.

        Whatever an earlier try of the batch has left is replaced.
        """
        laid_out = rows.select("digest", "keep_id", "n_rows").repartition(self.buckets, "digest").sortWithinPartitions("digest")
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {self.table} PARTITION (batch = :batch) SELECT digest, keep_id, n_rows FROM {{rows}}",
            args={"batch": batch},
            rows=laid_out,
        )

    def forget(self) -> None:
        """Take the table out of the session's catalog. Its files stay, and can be opened again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def normalised(text: Column) -> Column:
    """The text without any of the six white-space characters; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE_CLASS}+", "")


def dedupe(
    docs: DataFrame, index: DigestIndex, batch: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Deduplicate ``docs`` against ``index`` and among themselves, and append their new digests.

    Returns every input row without its text, with ``digest`` (sha256 of the normalised text),
    ``keep_id`` (row that stays: the indexed one, else most code points in the original text, else
    smallest id), ``group_size`` (equal rows of this batch, and those that the index counted),
    ``kept`` and ``indexed_before``.

    Null text equals empty text. A null id sorts before all others. Rows that repeat both id and text
    agree in every column. No rows give no rows. Input columns named like an output are replaced.

    ``batch`` names these documents (letters, digits, dots, lines). The index is written before the result is
    read, so whoever has to run a batch again, because its output was lost, must name it as before: its own
    digests then count as new, and the result is the first one. Without a name every call is a batch of its
    own; running such a batch twice appends nothing, and keeps nothing the second time.
    """
    wanted = fresh_names(docs, _OUT)
    rows = materialize(
        wanted.select(
            carried(wanted, text_col),
            F.col(id_col).alias("_id"),
            F.sha2(normalised(F.col(text_col)), 256).alias("digest"),
            F.coalesce(F.length(text_col), F.lit(0)).alias("_points"),
        ),
        "digests",
    )
    groups = materialize(
        rows.groupBy("digest")
        .agg(
            F.min(F.struct((-F.col("_points")).alias("points"), F.col("_id").alias("id"))).alias("first"),
            F.count(F.lit(1)).alias("n_rows"),
        )
        .select("digest", F.col("first.id").alias("keep_id"), "n_rows"),
        "digest-groups",
    )
    batch = _named(batch)
    known = index.read(without=batch).select("digest", F.col("keep_id").alias("old_id"), F.col("n_rows").alias("old_rows"))
    resolved = materialize(
        groups.join(known.hint("merge"), "digest", "left").select(
            "digest",
            F.when(F.col("old_rows").isNull(), F.col("keep_id")).otherwise(F.col("old_id")).alias("keep_id"),
            (F.col("n_rows") + F.coalesce("old_rows", F.lit(0))).alias("group_size"),
            F.col("old_rows").isNotNull().alias("indexed_before"),
        ),
        "digest-resolved",
    )
    index.append(materialize(groups.join(known.hint("merge"), "digest", "left_anti"), "digests-new"), batch)
    return rows.join(resolved, "digest").select(
        "_in.*",
        "digest",
        "keep_id",
        "group_size",
        (F.col("_id").eqNullSafe(F.col("keep_id")) & ~F.col("indexed_before")).alias("kept"),
        "indexed_before",
    )


def _named(batch: str | None) -> str:
    if batch is None:
        return uuid.uuid4().hex
    if not re.fullmatch(r"[\w.-]+", batch, re.ASCII):
        raise ValueError(f"a batch's name is made of letters, digits, dots and lines: {batch!r}")
    return batch


def new_index(spark: SparkSession) -> DigestIndex:
    """An empty index in the shared folder."""
    return DigestIndex(spark, new_path(spark, "digest-index"), shuffle_partitions(spark))
