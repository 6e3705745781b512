"""Which transaction ids are known: blocked Bloom filters, and the ids themselves for what the filters let through.

Ids are stored by day and bucket. Beside them stands a filter for each day and bucket: blocks of four 64-bit
words, about a dozen ids to a block. An id sets two bits in every word of the one block that its hash
chooses, so a filter is a bitwise-or aggregate with a row per block, and asking it is an equi-join by
block. Of ids that are not known about one in five thousand a day passes. Whatever passes is looked up among
the ids of that day and bucket: a day is a folder, its files are in the order of the bucket, so the answer
is exact and few other ids are read.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tellerscore.operators.dedupe import unseen
from tellerscore.session import joinable, materialize
from tellerscore.streaming.tables import EpochTable

#: Ids that share a block on average, and the most blocks of a filter, as a power of two.
BLOCK_IDS, MOST_BLOCKS = 12, 26
BUCKETS = 64
_WORDS = [f"w{i}" for i in range(4)]
_CELL = ["event_day", "bucket"]


def _power(exponent: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), exponent.cast("int"))


def _hash() -> Column:
    return F.xxhash64("id")


def _block(level: Column) -> Column:
    return F.pmod(_hash(), _power(level))


def _second_hash() -> Column:
    return F.xxhash64("id", F.lit(1))


def _bits(more: Column) -> list[Column]:
    """Two bits in each of four words, from a second hash."""
    bit = lambda i: _power(F.shiftrightunsigned(more, 6 * i).bitwiseAND(63))
    return [bit(2 * i).bitwiseOR(bit(2 * i + 1)).alias(name) for i, name in enumerate(_WORDS)]


def in_buckets(ids: DataFrame) -> DataFrame:
    """The upper half of the hash chooses the bucket, the lower half the block."""
    return ids.withColumn("bucket", F.shiftrightunsigned(_hash(), 40).bitwiseAND(BUCKETS - 1).cast("int"))


def filters(ids: DataFrame) -> DataFrame:
    """The filters of ``id, event_day, bucket``: a row per block that holds an id."""
    sizes = ids.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("n"))
    level = F.least(F.greatest(F.ceil(F.log2(F.col("n") / BLOCK_IDS)), F.lit(0)), F.lit(MOST_BLOCKS)).cast("int")
    sized = ids.join(F.broadcast(sizes.select(*_CELL, level.alias("level"))), _CELL)  # at most days times buckets
    placed = sized.select(*_CELL, "level", _block(F.col("level")).alias("block"), *_bits(_second_hash()))
    return placed.groupBy(*_CELL, "level", "block").agg(*[F.bit_or(w).alias(w) for w in _WORDS])


def let_through(ids: DataFrame, of: DataFrame) -> DataFrame:
    """``id, event_day, bucket`` of those of ``ids`` that may be known, by what filters say.

    An id is asked for once per level that the filters of its bucket have, which are few: days of like size share one.
    """
    levels = of.select("bucket", "level").distinct()
    asked = in_buckets(ids.select("id").distinct()).join(levels, "bucket")
    asked = asked.select("id", "bucket", "level", _block(F.col("level")).alias("block"), _second_hash().alias("_more"))
    found = asked.join(of, ["bucket", "level", "block"])
    for w, bits in zip(_WORDS, _bits(F.col("_more"))):
        found = found.where(F.col(w).bitwiseAND(bits) == bits)
    return found.select("id", *_CELL).distinct()


class KnownIds:
    """Ids by day and bucket with their filters, one delta per micro-batch."""

    def __init__(self, root: str):
        ids = StructType.fromDDL("id long, event_day date, bucket int")
        self.ids = EpochTable(f"{root}/known_ids", ids, ("event_day",), ("bucket", "id"))
        blocks = StructType.fromDDL("event_day date, bucket int, level int, block long, " + ", ".join(f"{w} long" for w in _WORDS))
        self.filters = EpochTable(f"{root}/known_filters", blocks, ("event_day",), ("bucket", "block"))

    def add(self, rows: DataFrame, epoch: int) -> None:
        """Store ``id, event_day`` of a micro-batch; null ids are not stored."""
        self.ids.write(in_buckets(rows.where(F.col("id").isNotNull()).select("id", "event_day").distinct()), epoch)
        self.filters.write(filters(self.ids.read(rows.sparkSession, only=epoch)), epoch)

    def unseen(self, batch: DataFrame, before: int | None = None) -> DataFrame:
        """Rows of ``batch`` whose id no micro-batch before ``before`` stored; a null id is never known."""
        spark = batch.sparkSession
        passed = materialize(let_through(batch, self.filters.read(spark, before=before)), "let-through")
        known = self.among(spark, passed, before)
        return batch if known is None else unseen(batch, known)

    def among(self, spark: SparkSession, passed: DataFrame, before: int | None = None) -> DataFrame | None:
        """The exact step: which of what the filters let through is stored. Only those days are opened, and of them the row groups with those buckets."""
        cells: dict[datetime.date, list[int]] = {}
        found = passed.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("n")).collect()  # at most days times buckets
        for day, bucket, _ in found:
            cells.setdefault(day, []).append(bucket)
        if not cells:
            return None
        opened = F.lit(False)
        for day, buckets in sorted(cells.items()):
            opened |= (F.col("event_day") == F.lit(day)) & F.col("bucket").isin(buckets)
        many = sum(cell["n"] for cell in found)
        stored = self.ids.read(spark, before=before).where(opened)
        return joinable(stored.join(joinable(passed, many), ["id", *_CELL], "left_semi").select("id").distinct(), many)

    def compact(self, spark: SparkSession, before: int, oldest: datetime.date | None = None) -> None:
        """Merge deltas, and let go of days before ``oldest``. Filters are made anew for what is left."""
        kept = F.lit(True) if oldest is None else F.col("event_day") >= F.lit(oldest)
        self.ids.compact(spark, before, lambda rows: rows.where(kept))
        self.filters.compact(spark, before, lambda _: filters(self.ids.read(spark, before=before)))

    def vacuum(self, spark: SparkSession) -> None:
        self.ids.vacuum(spark)
        self.filters.vacuum(spark)

