"""State dealt to buckets by the hash of its key.

Micro-batches add deltas, ``ep=<n>/bucket=<b>``. A merge rewrites only the buckets that deltas touched, into
``<table>_base/<buckets>/bucket=<b>/v=<n>``, and leaves the others where they are; a marker finishes it.
Whoever looks up keys opens the newest version of the keys' buckets and the deltas since the last merge.
When buckets have grown past a size, the next merge doubles their number, so the cost of a lookup follows
the keys that are asked for and not the keys that are stored.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tellerscore.streaming.tables import EpochTable


@dataclass(frozen=True)
class BucketedTable(EpochTable):
    """An :class:`EpochTable` whose rows are found by ``key``.

    ``buckets`` is the first number of buckets, ``bucket_rows`` how many rows one holds on average before
    their number doubles.
    """

    key: str = field(default="", kw_only=True)
    buckets: int = field(default=64, kw_only=True)
    bucket_rows: int = field(default=1_000_000, kw_only=True)

    def write(self, df: DataFrame, epoch: int) -> None:
        _, buckets = self._merged(df.sparkSession, epoch)
        self._deal(df, buckets).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/ep={epoch}")

    def read(self, spark: SparkSession, before: int | None = None, only: int | None = None) -> DataFrame:
        if only is not None:
            return self._load(spark, f"{self.path}/ep={only}")
        return self._rows(spark, before, None)

    def lookup(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """All rows of the given keys. A null key finds nothing; repeated keys find their rows once."""
        spark = keys.sparkSession
        wanted = keys.select(F.col(self.key).cast(self.schema[self.key].dataType)).where(F.col(self.key).isNotNull()).distinct()
        _, buckets = self._merged(spark, before)
        opened = {r[0] for r in wanted.select(self._bucket(buckets)).distinct().collect()}  # at most ``buckets`` numbers
        return self._rows(spark, before, opened).join(wanted, self.key, "left_semi")

    def compact(self, spark: SparkSession, before: int, merge: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Merge the deltas before ``before``, which must be finished, into the buckets they touch.

        ``merge`` may only bring rows of one key together.
        """
        start, buckets = self._merged(spark, before)
        if start == before:
            return
        touched = {bucket for _, bucket in self._deltas(spark, start, before)}
        if touched:
            rows = self._rows(spark, before, touched)
            merged = self._rewrite(merge(rows) if merge else rows, buckets, before)
            largest = merged.where(F.col("v") == before).count() / len(touched)
            if largest > self.bucket_rows:
                rows = self._rows(spark, before, None)
                while largest > self.bucket_rows:
                    largest, buckets = largest / 2, buckets * 2
                self._rewrite(merge(rows) if merge else rows, buckets, before)
        fs, marker = self._file(spark, f"{self.path}_base/_done/{before}-{buckets}")
        fs.create(marker, True).close()

    def vacuum(self, spark: SparkSession) -> None:
        """Delete merged deltas and replaced versions. Run it when no reader of older state is left."""
        start, buckets = self._merged(spark, None)
        if start is None:
            return
        gone = [f"{self.path}/{name}" for name, n in self._numbers(spark, self.path).items() if n < start]
        gone += [f"{self.path}_base/{name}" for name, n in self._numbers(spark, f"{self.path}_base").items() if n != buckets]
        for bucket, versions in self._versions(spark, start, buckets).items():
            gone += [f"{self.path}_base/{buckets}/bucket={bucket}/v={v}" for v in versions if v != max(versions)]
        for path in gone:
            fs, target = self._file(spark, path)
            fs.delete(target, True)

    def last(self, spark: SparkSession) -> int | None:
        merged = self._merged(spark, None)[0]
        stored = [*self._numbers(spark, self.path).values(), *([] if merged is None else [merged - 1])]
        return max(stored, default=None)

    def _base(self, spark: SparkSession, before: int | None) -> int | None:
        return self._merged(spark, before)[0]

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int").alias("bucket")

    def _deal(self, df: DataFrame, buckets: int) -> DataFrame:
        rows = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields])
        return rows.withColumn("bucket", self._bucket(buckets)).hint("rebalance", "bucket")

    def _rewrite(self, rows: DataFrame, buckets: int, version: int) -> DataFrame:
        """Write new versions of buckets, in the order of the key. A retry replaces what it finds."""
        target = f"{self.path}_base/{buckets}"
        dealt = self._deal(rows, buckets).withColumn("v", F.lit(version).cast("long"))
        dealt.sortWithinPartitions("bucket", self.key).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("bucket", "v").parquet(target)
        return rows.sparkSession.read.schema(StructType([*self.schema.fields, StructField("v", LongType())])).parquet(target)

    def _merged(self, spark: SparkSession, before: int | None) -> tuple[int | None, int]:
        """The last finished merge that is not ahead of ``before``, and the number of buckets since then."""
        fs, folder = self._file(spark, f"{self.path}_base/_done")
        if not fs.exists(folder):
            return None, self.buckets
        names = [s.getPath().getName().split("-") for s in fs.listStatus(folder)]
        found = [(int(n), int(buckets)) for n, buckets in names if before is None or int(n) <= before]
        return max(found, default=(None, self.buckets))

    def _numbered(self, spark: SparkSession, folder: str, outer: str, inner: str) -> list[tuple[int, int]]:
        """The numbers of all folders ``<outer>=<n>/<inner>=<m>``, listed at once."""
        fs, pattern = self._file(spark, f"{folder}/{outer}=*/{inner}=*")
        found = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.globStatus(pattern))
        names = spark._jvm.org.apache.commons.lang3.ArrayUtils.toString(found) if found else ""
        return [(int(n), int(m)) for n, m in re.findall(rf"/{outer}=(\d+)/{inner}=(\d+)(?=[,}}])", names)]

    def _versions(self, spark: SparkSession, start: int, buckets: int) -> dict[int, list[int]]:
        """The finished versions of every bucket."""
        fs, done = self._file(spark, f"{self.path}_base/_done")
        finished = {int(s.getPath().getName().split("-")[0]) for s in fs.listStatus(done)}
        out: dict[int, list[int]] = {}
        for bucket, version in self._numbered(spark, f"{self.path}_base/{buckets}", "bucket", "v"):
            if version <= start and version in finished:
                out.setdefault(bucket, []).append(version)
        return out

    def _deltas(self, spark: SparkSession, start: int | None, before: int | None) -> list[tuple[int, int]]:
        """Micro-batches since a merge, with the buckets that they wrote."""
        found = self._numbered(spark, self.path, "ep", "bucket")
        return sorted((n, b) for n, b in found if n >= (start or 0) and (before is None or n < before))

    def _rows(self, spark: SparkSession, before: int | None, opened: set[int] | None) -> DataFrame:
        start, buckets = self._merged(spark, before)
        paths = [f"{self.path}/ep={n}/bucket={b}" for n, b in self._deltas(spark, start, before) if opened is None or b in opened]
        if start is not None:
            base = f"{self.path}_base/{buckets}"
            versions = sorted(self._versions(spark, start, buckets).items())
            paths += [f"{base}/bucket={b}/v={max(found)}" for b, found in versions if opened is None or b in opened]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths).select(*[F.col(f"`{n}`") for n in self.schema.names])
