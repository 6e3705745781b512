"""Tables that streaming jobs write one micro-batch at a time.

Every micro-batch owns the folder ``ep=<n>``. A retry replaces that folder as a whole, even with
nothing, and readers of micro-batch n look only at earlier ones, so running it twice gives the
same table as running it once.

Compaction merges the micro-batches before n into ``<table>_base/<n>``. Readers take the newest
finished base that is not ahead of them, and the micro-batches from there on.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


@dataclass(frozen=True)
class EpochTable:
    path: str
    schema: StructType
    partition_by: tuple[str, ...] = ()
    #: Order of the rows inside a file, by which scans can skip row groups.
    sort_by: tuple[str, ...] = ()

    def write(self, df: DataFrame, epoch: int) -> None:
        self._save(df, f"{self.path}/ep={epoch}")

    def read(self, spark: SparkSession, before: int | None = None, only: int | None = None) -> DataFrame:
        """Rows of all micro-batches, of those before one, or of a single one."""
        if only is not None:
            return self._load(spark, f"{self.path}/ep={only}")
        base = self._base(spark, before)
        rows = self._epochs(spark, base, before)
        return rows if base is None else self._load(spark, f"{self.path}_base/{base}").unionByName(rows)

    def compact(self, spark: SparkSession, before: int, merge: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Merge all micro-batches before ``before``, which must be finished, into a new base."""
        rows = self.read(spark, before=before)
        target = f"{self.path}_base/{before}"
        if self._base(spark, before) != before:
            self._save(merge(rows) if merge else rows, target)

    def last(self, spark: SparkSession) -> int | None:
        """The highest micro-batch that was written or merged."""
        written = [*self._numbers(spark, self.path).values()]
        merged = [n - 1 for n in self._numbers(spark, f"{self.path}_base").values()]
        return max(written + merged, default=None)

    def vacuum(self, spark: SparkSession) -> None:
        """Delete what the newest base replaces. Run it when no reader of older state is left."""
        newest = self._base(spark, None)
        if newest is None:
            return
        for folder in (self.path, f"{self.path}_base"):
            for name, number in self._numbers(spark, folder).items():
                if number < newest:
                    fs, target = self._file(spark, f"{folder}/{name}")
                    fs.delete(target, True)

    def drop_days(self, spark: SparkSession, before: int, oldest: datetime.date) -> None:
        """Delete the folders of days before ``oldest`` in what was written before micro-batch ``before``.

        The first column of ``partition_by`` is the day. No file is read or rewritten. A reader that planned earlier may miss its files.
        """
        day = self.partition_by[0]
        for folder, last in ((self.path, before - 1), (f"{self.path}_base", before)):
            for name, number in self._numbers(spark, folder).items():
                fs, epoch = self._file(spark, f"{folder}/{name}")
                for part in fs.listStatus(epoch) if number <= last else []:
                    key, _, value = part.getPath().getName().partition("=")
                    if key == day and value[:1].isdigit() and datetime.date.fromisoformat(value) < oldest:
                        fs.delete(part.getPath(), True)

    def _save(self, df: DataFrame, path: str) -> None:
        rows = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields])
        if self.partition_by:
            # Files of one partition value come from few tasks, and a large value still gets many.
            rows = rows.hint("rebalance", *self.partition_by)
        if self.sort_by:
            rows = rows.sortWithinPartitions(*self.partition_by, *self.sort_by)
        rows.write.mode("overwrite").partitionBy(*self.partition_by).parquet(path)

    def _load(self, spark: SparkSession, path: str) -> DataFrame:
        fs, target = self._file(spark, path)
        if not fs.exists(target):
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(path).select(*[F.col(f"`{n}`") for n in self.schema.names])

    def _epochs(self, spark: SparkSession, first: int | None, before: int | None) -> DataFrame:
        fs, target = self._file(spark, self.path)
        if not fs.exists(target):
            return spark.createDataFrame([], self.schema)
        layout = StructType([*self.schema.fields, StructField("ep", LongType())])
        rows = spark.read.schema(layout).parquet(self.path)
        if first is not None:
            rows = rows.where(F.col("ep") >= first)
        if before is not None:
            rows = rows.where(F.col("ep") < before)
        return rows.select(*[F.col(f"`{n}`") for n in self.schema.names])

    def _base(self, spark: SparkSession, before: int | None) -> int | None:
        """The newest finished base whose micro-batches all come before ``before``."""
        finished = []
        for name, number in self._numbers(spark, f"{self.path}_base").items():
            fs, marker = self._file(spark, f"{self.path}_base/{name}/_SUCCESS")
            if (before is None or number <= before) and fs.exists(marker):
                finished.append(number)
        return max(finished, default=None)

    def _numbers(self, spark: SparkSession, folder: str) -> dict[str, int]:
        """Numbered folders: ``<n>`` or ``ep=<n>``."""
        fs, target = self._file(spark, folder)
        if not fs.exists(target):
            return {}
        names = [s.getPath().getName() for s in fs.listStatus(target)]
        return {n: int(n.removeprefix("ep=")) for n in names if n.removeprefix("ep=").isdigit()}

    @staticmethod
    def _file(spark: SparkSession, path: str):
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(spark._jsc.hadoopConfiguration()), target
