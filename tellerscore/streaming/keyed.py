"""Trailing features as keyed state of a stream: the (count, exact sum) of each day, as one value per key value.

The scoring job takes features from tables of day totals. This is the same rule as one stateful operator:
no table is read or listed, and a micro-batch touches only the state of its own keys.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from decimal import Decimal
from itertools import accumulate, groupby
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tellerscore.operators.history import HISTORY_TTL
from tellerscore.schemas import AMOUNT, HORIZONS, KEYS, average_name, count_name

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: One value per key, since every access to the state is a call from the Python worker to the engine.
_KEPT = "arrived long, day array<int>, n array<long>, s array<decimal(35,6)>"
OUTPUT = (
    "id long, late boolean, "
    + ", ".join(f"avg_{h} double" for h in HORIZONS)
    + ", "
    + ", ".join(f"n_{h} int" for h in HORIZONS)
    + ", family string"
)
_COLUMNS = [c.split()[0] for c in OUTPUT.split(", ")]


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which keyed state needs."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


class TrailingDays(StatefulProcessor):
    """Counts and averages of one key value over its last days.

    A key's value holds at most ``max(horizons) + 1 + late_days`` days, the newest one included; older ones leave when a
    newer day comes. A timer on the clock of arrival lets go of a key that brought nothing for ``ttl_ms``.
    """

    def __init__(self, horizons: dict[str, int], late_days: int, ttl_ms: int):
        self.horizons, self.late_days, self.ttl_ms = horizons, late_days, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", _KEPT)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        batch, arrived = [], 0
        for part in rows:
            # ts as its integer: a frame of a few rows costs less as plain tuples than as another frame
            batch += zip(part["ts"].astype("int64").tolist(), *[part[c].tolist() for c in ("id", "day", "amount")])
            arrived = max(arrived, int(part["arrived"].max()))
        batch.sort(key=lambda row: row[:2])
        before = self.kept.get()
        totals = {} if before is None else {day: (n, s) for day, n, s in zip(*before[1:])}
        newest = max(totals, default=min(row[2] for row in batch))
        own: dict[int, tuple[list[int], list[Decimal]]] = {}
        for day, part in groupby(batch, key=lambda row: row[2]):
            n, s = totals.get(day, (0, Decimal(0)))
            sums = list(accumulate((row[3] for row in part), initial=s))[1:]
            own[day] = (list(range(n + 1, n + 1 + len(sums))), sums)
            totals[day] = (n + len(sums), sums[-1])
        out = defaultdict(list)
        for day, (counts, sums) in own.items():
            for name, span in self.horizons.items():
                earlier = [t for d, t in totals.items() if day - span <= d < day]
                n, s = sum(t[0] for t in earlier), sum((t[1] for t in earlier), Decimal(0))
                out[f"n_{name}"] += [n + c for c in counts]
                out[f"avg_{name}"] += [float(s + t) / (n + c) for t, c in zip(sums, counts)]
            newest = max(newest, day)
            out["late"] += [day < newest - self.late_days] * len(counts)
        oldest = newest - max(self.horizons.values()) - self.late_days
        left = [(day, *total) for day, total in totals.items() if day >= oldest]
        if before is None:
            self.handle.registerTimer(arrived + self.ttl_ms)
        self.kept.update((arrived, *[[total[i] for total in left] for i in range(3)]))
        yield pd.DataFrame({"id": [row[1] for row in batch], **out, "family": key[0]})[_COLUMNS]

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        """A key has one timer: it moves on if rows came since it was set, and otherwise ends the key."""
        due = self.kept.get()[0] + self.ttl_ms
        if due > expiredTimerInfo.getExpiryTimeInMs():
            self.handle.registerTimer(due)
        else:
            self.kept.clear()
        return iter(())

    def close(self) -> None:
        pass


def trailing_stream(
    rows: DataFrame,
    keys: tuple[str, ...] = KEYS,
    horizons: dict[str, int] = HORIZONS,
    late_days: int = 7,
    ttl_ms: int = HISTORY_TTL * 1000,
) -> DataFrame:
    """Each row of a stream once per key column (``family``), with its features as they stand when it arrives.

    ``rows`` has ``id``, ``ts``, ``amount`` and the key columns. Rows with a null among them have no features and are
    left out; repeats count again, so drop them before. Inside a micro-batch rows count in order of (``ts``, ``id``),
    over micro-batches in order of arrival: what came earlier on a row's own day counts, also if its time is later.
    The clock is that of arrival, one time per micro-batch, so no row is dropped as late, whatever its own time.
    ``late`` marks rows more than ``late_days`` behind the newest day of their key, whose oldest days may have left.

    All key columns share one shuffle. A task holds the rows of one key of one micro-batch, so the
    trigger's admission limit bounds it; for backfills, whose keys have no such bound, use
    :func:`tellerscore.operators.features.point_in_time`.
    """
    narrow = rows.select("id", "ts", F.col("amount").cast(AMOUNT).alias("amount"), *keys).dropna()
    family = F.explode(F.array(*[F.struct(F.lit(k).alias("family"), F.col(k).cast("string").alias("key")) for k in keys]))
    clocked = narrow.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", "0 seconds")
    arrived, day = F.unix_millis("_arrived").alias("arrived"), F.unix_date(F.to_date("ts")).alias("day")
    keyed = clocked.select("id", "ts", "amount", day, arrived, "_arrived", family.alias("_k"))
    return (
        keyed.select("id", "ts", "amount", "day", "arrived", "_arrived", "_k.family", "_k.key")
        .groupBy("family", "key")
        .transformWithStateInPandas(TrailingDays(horizons, late_days, ttl_ms), OUTPUT, "Append", "EventTime")
    )


def by_row(found: DataFrame, keys: tuple[str, ...] = KEYS, horizons: dict[str, int] = HORIZONS) -> DataFrame:
    """What :func:`trailing_stream` wrote, as one row per id with the feature columns of all key columns."""
    columns = []
    for key in keys:
        own = F.col("family") == key
        columns += [F.max(F.when(own, F.col(f"avg_{h}"))).alias(average_name(key, h)) for h in horizons]
        columns += [F.max(F.when(own, F.col(f"n_{h}"))).alias(count_name(key, h)) for h in horizons]
    return found.groupBy("id").agg(*columns)
