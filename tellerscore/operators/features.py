"""Trailing average and count features, and the calendar flags.

A transaction's horizon of n days covers the n calendar days before its own day and its own day
up to itself. The work is split accordingly:

* earlier days come from day totals (key, day, count, exact sum), which a map-side combine makes
  small, whatever the number of transactions behind them;
* the own day comes from running totals over the raw rows, grouped by (key, day).

So no task ever holds a key's whole history.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellerscore.functions.fields import is_night, is_weekend, since
from tellerscore.operators.running import SPLIT_ROWS, GroupSizes, running_totals
from tellerscore.schemas import AMOUNT, FEATURES, HORIZONS, KEYS, average_name, count_name
from tellerscore.session import materialize, materialize_measured

ORDER = ["ts", "id"]
TOTALS = "decimal(35,6)"


@dataclass(frozen=True)
class DayTotals:
    """A frame (key, day, n, s), the largest ``n`` in it and the rows behind it."""

    frame: DataFrame
    largest: int
    rows: int


def _by_day(rows: DataFrame, key: str, amount_type) -> DataFrame:
    return rows.groupBy(F.col(key).alias("key"), F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("amount").cast(amount_type)).cast(TOTALS).alias("s"),
    )


def day_totals(rows: DataFrame, keys: tuple[str, ...] = KEYS, amount_type=AMOUNT) -> dict[str, DayTotals]:
    """Day totals per key column. One scan of ``rows`` serves all key columns.

    The totals are written once, because feature jobs read them several times.
    """
    narrow = rows.select(
        *keys,
        F.to_date("ts").alias("day"),
        F.col("amount").cast(amount_type).alias("_amount"),
    )
    # grouping() is 0 for the key column that a grouping set groups by.
    family = F.coalesce(*[F.when(F.grouping(k) == 0, i) for i, k in enumerate(keys)])
    totals = narrow.groupingSets([[k, "day"] for k in keys], *keys, "day").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_amount").cast(TOTALS).alias("s"), family.alias("_family")
    )
    largest = [F.max(F.when(F.col("_family") == i, F.col("n"))).alias(f"max_{k}") for i, k in enumerate(keys)]
    count = F.sum(F.when(F.col("_family") == 0, F.col("n"))).alias("rows")
    written, seen = materialize_measured(totals, "day-totals", *largest, count)
    return {
        key: DayTotals(
            written.where(F.col("_family") == i).select(F.col(key).alias("key"), "day", "n", "s"),
            seen[f"max_{key}"] or 0,
            seen["rows"] or 0,
        )
        for i, key in enumerate(keys)
    }


def sum_by_day(totals: DataFrame) -> DataFrame:
    """Partial totals as one row per (key, day)."""
    return totals.groupBy("key", "day").agg(F.sum("n").alias("n"), F.sum("s").cast(TOTALS).alias("s"))


def _with_past(fresh: dict[str, DayTotals], past: dict[str, DataFrame], split_rows: int) -> dict[str, DayTotals]:
    """Totals of the new rows together with the past ones.

    The past sizes bound what a group can hold; only if they do not rule out a large group are
    the merged totals written, so that they can be measured and read several times.
    """
    sizes = reduce(
        DataFrame.unionByName,
        [
            past[k].groupBy("key", "day").agg(F.sum("n").alias("n")).select(F.lit(k).alias("family"), "n")
            for k in fresh
        ],
    )
    seen = {
        r["family"]: r for r in sizes.groupBy("family").agg(F.max("n").alias("n"), F.sum("n").alias("rows")).collect()
    }
    merged = {}
    for key, totals in fresh.items():
        frame = sum_by_day(totals.frame.unionByName(past[key]))
        largest = totals.largest + (seen[key]["n"] if key in seen else 0)
        rows = totals.rows + (seen[key]["rows"] if key in seen else 0)
        if largest > split_rows:
            frame = materialize(frame, "day-totals")
        merged[key] = DayTotals(frame, largest, rows)
    return merged


def earlier_days(totals: DataFrame, horizons: dict[str, int] = HORIZONS) -> DataFrame:
    """For each (key, day): count and sum over the n days before it, for every horizon.

    A key has one row per active day here, so its window stays small.
    """
    by_day = Window.partitionBy("key").orderBy(F.unix_date("day"))
    columns = []
    for name, days in horizons.items():
        frame = by_day.rangeBetween(-days, -1)
        columns.append(F.coalesce(F.sum("n").over(frame), F.lit(0)).alias(f"_n_{name}"))
        columns.append(F.sum("s").over(frame).alias(f"_s_{name}"))
    return totals.select("key", "day", *columns)


def point_in_time(
    rows: DataFrame,
    keys: tuple[str, ...] = KEYS,
    horizons: dict[str, int] = HORIZONS,
    amount_type=AMOUNT,
    past_totals: dict[str, DataFrame] | None = None,
    past_rows: DataFrame | None = None,
    totals: dict[str, DayTotals] | None = None,
    split_rows: int = SPLIT_ROWS,
    row_count: int | None = None,
) -> DataFrame:
    """Add the trailing features as they stood at each row, itself included.

    ``rows`` needs ``id`` (unique), ``ts``, ``amount`` and the key columns, none of them null. It
    is read several times: pass a table, or a frame written by ``materialize``.

    When ``rows`` is the newest part of a longer history, pass that history's day totals as
    ``past_totals`` and its raw rows of the days that ``rows`` covers as ``past_rows``; features
    are returned for ``rows`` only. ``totals`` are the day totals of ``rows`` where the caller
    already has them.

    Fewer rows than one task may sort cannot contain a group that must be split, so for those the
    day totals are not written and measured first. ``row_count`` saves the count that finds out.
    """
    with_past = past_totals is not None
    if totals is None and not with_past:
        if row_count is None:
            row_count = rows.count()
        if row_count <= split_rows:
            totals = {k: DayTotals(_by_day(rows, k, amount_type), row_count, row_count) for k in keys}
    if totals is None:
        totals = day_totals(rows, keys, amount_type)
    if with_past:
        totals = _with_past(totals, past_totals, split_rows)
    result = rows.withColumn("_day", F.to_date("ts"))
    for i, key in enumerate(keys):
        if i and totals[key].largest > split_rows:
            # Split groups and the others are read apart; do not compute the first key twice.
            result = materialize(result, "features")
        result = _add_family(result, key, totals[key], horizons, amount_type, past_rows, split_rows)
    return result.drop("_day")


def _add_family(rows, key, totals, horizons, amount_type, past_rows, split_rows):
    group = [key, "_day"]
    candidates = rows
    if past_rows is not None:
        # Only the past rows of a (key, day) that the new rows touch can matter.
        touched = rows.select(*group).distinct()
        past = (
            past_rows.select("id", key, "ts", "amount", F.to_date("ts").alias("_day"))
            .join(touched, group, "left_semi")
            .withColumn("_past", F.lit(True))
        )
        candidates = rows.withColumn("_past", F.lit(False)).unionByName(past, allowMissingColumns=True)
    names = {"key": key, "day": "_day"}
    sizes = GroupSizes(totals.frame.withColumnsRenamed(names), totals.largest, totals.rows)
    before = earlier_days(totals.frame, horizons).withColumnsRenamed(names)
    joined = running_totals(
        candidates, group, ORDER, F.col("amount").cast(amount_type), sizes, split_rows, before
    )
    if past_rows is not None:
        joined = joined.where(~F.col("_past"))
    averages, counts = [], []
    for name in horizons:
        count = F.coalesce(F.col(f"_n_{name}"), F.lit(0)) + F.col("run_n")
        total = F.coalesce(F.col(f"_s_{name}"), F.lit(0).cast(TOTALS)) + F.col("run_s")
        averages.append((total.cast("double") / count).alias(average_name(key, name)))
        counts.append(count.cast("int").alias(count_name(key, name)))
    return joined.select(*rows.columns, *averages, *counts)


def as_of_totals(
    history: DataFrame,
    key: str,
    as_of: datetime.date | Column,
    horizons: dict[str, int] = HORIZONS,
    amount_type=AMOUNT,
) -> DataFrame:
    """One row per key active in the longest horizon: features against one anchor day.

    The window runs from n days before the anchor day on and has no upper bound. A key without a
    row has count 0 and a null average.
    """
    anchor = as_of if isinstance(as_of, Column) else F.lit(as_of)
    recent = history.where(since(F.col("ts"), anchor, max(horizons.values())))
    columns = []
    for name, days in horizons.items():
        inside = since(F.col("ts"), anchor, days)
        value = F.when(inside, F.col("amount").cast(amount_type))
        columns.append((F.sum(value).cast("double") / F.nullif(F.count_if(inside), F.lit(0))).alias(average_name(key, name)))
    for name, days in horizons.items():
        columns.append(F.count_if(since(F.col("ts"), anchor, days)).cast("int").alias(count_name(key, name)))
    return recent.groupBy(key).agg(*columns)


def as_of_from_days(
    totals: DataFrame, key: str, as_of: datetime.date | Column, horizons: dict[str, int] = HORIZONS
) -> DataFrame:
    """:func:`as_of_totals` from day totals (key, day, n, s) instead of raw rows: horizons are whole days."""
    anchor = as_of if isinstance(as_of, Column) else F.lit(as_of)
    first = {name: F.date_sub(anchor, days) for name, days in horizons.items()}
    recent = totals.where(F.col("day") >= F.date_sub(anchor, max(horizons.values())))
    averages, counts = [], []
    for name in horizons:
        n = F.coalesce(F.sum(F.when(F.col("day") >= first[name], F.col("n"))), F.lit(0))
        s = F.sum(F.when(F.col("day") >= first[name], F.col("s"))).cast("double")
        averages.append((s / F.nullif(n, F.lit(0))).alias(average_name(key, name)))
        counts.append(n.cast("int").alias(count_name(key, name)))
    return recent.groupBy(F.col("key").alias(key)).agg(*averages, *counts)


def as_of_features(
    rows: DataFrame,
    history: DataFrame,
    as_of: datetime.date | Column,
    keys: tuple[str, ...] = KEYS,
    horizons: dict[str, int] = HORIZONS,
    amount_type=AMOUNT,
) -> DataFrame:
    """Add the features of every row against one anchor day, the same for all rows of a key."""
    result = rows
    for key in keys:
        result = result.join(as_of_totals(history, key, as_of, horizons, amount_type), key, "left")
        result = result.fillna(0, [count_name(key, h) for h in horizons])
    return result


def calendar_flags(rows: DataFrame) -> DataFrame:
    return rows.withColumn("transaction_in_weekend", is_weekend(F.col("ts"))).withColumn(
        "transaction_at_night", is_night(F.col("ts"))
    )


def incomplete(columns: list[str] = FEATURES) -> Column:
    """True where some feature is null, which the model sees as not-a-number."""
    missing = F.lit(False)
    for name in columns:
        missing = missing | F.col(name).isNull()
    return missing
