"""Features after rows came late: what a late row changes, and nothing else, is computed again.

A row that arrives late belongs into the trailing windows of the rows of its key that follow it within the longest
horizon. Those lie on its own day, later than itself, or on the days after it, so they are found by (key, day) without
reading the rest of the history.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tellerscore.operators import features
from tellerscore.operators.running import SPLIT_ROWS
from tellerscore.schemas import AMOUNT, HORIZONS, KEYS, average_name, count_name
from tellerscore.session import joinable, materialize, materialize_measured


def touched_days(late: DataFrame, key: str, totals: DataFrame, horizons: dict[str, int] = HORIZONS) -> DataFrame:
    """The (key, day) pairs of ``totals`` that a late row can change: its own day and the longest horizon after it.

    Late days and the days of ``totals`` go through one window by key, with one row per active day, so no late day is
    multiplied by the days it reaches.
    """
    stored = totals.select("key", "day", F.lit(True).alias("_stored"))
    late_days = late.select(F.col(key).alias("key"), F.to_date("ts").alias("day"), F.lit(False).alias("_stored"))
    days = stored.unionByName(late_days).where(F.col("key").isNotNull() & F.col("day").isNotNull())
    days = days.groupBy("key", "day").agg(F.max("_stored").alias("_stored"), F.max(~F.col("_stored")).alias("_late"))
    reach = Window.partitionBy("key").orderBy(F.unix_date("day")).rangeBetween(-max(horizons.values()), 0)
    return days.withColumn("_late", F.max("_late").over(reach)).where("_stored AND _late").select("key", "day")


def corrections(
    late: DataFrame,
    history: DataFrame,
    totals: dict[str, DataFrame],
    keys: tuple[str, ...] = KEYS,
    horizons: dict[str, int] = HORIZONS,
    amount_type=AMOUNT,
    split_rows: int = SPLIT_ROWS,
) -> dict[str, DataFrame]:
    """By key column, the features of the late rows and new ones of the earlier rows they change.

    ``late`` and ``history`` have ``id``, ``ts``, ``amount`` and the key columns, without nulls, no id in both or
    twice; ``late`` is read several times. ``totals`` are the day totals (key, day, n, s) of ``history``, as partial
    sums or whole, by key column. If ``history`` is partitioned by ``event_day``, only touched days are read.

    Each frame has ``id``, ``late`` and the features of its key column. A row of the history is in it exactly if a late
    row precedes it, in order of (``ts``, ``id``), within the longest horizon. Without late rows there are none.
    """
    found = {}
    longest = max(horizons.values())
    late_rows = late.count()
    for key in keys:
        known = features.sum_by_day(totals[key])
        n = F.count(F.lit(1)).alias("n")
        touched, seen = materialize_measured(touched_days(late, key, known, horizons), "touched-days", n)
        touched = joinable(touched, seen["n"])
        # Whole days are read again, so that their running totals are right.
        named = touched.select(F.col("key").alias(key), F.col("day").alias("_day"))
        rows = history.withColumn("_day", F.to_date("ts"))
        if "event_day" in history.columns:
            days = touched.select(F.col("day").alias("event_day")).distinct()
            rows = rows.join(days, "event_day", "left_semi")
        again = rows.join(named, [key, "_day"], "left_semi")
        columns = ["id", key, "ts", "amount"]
        both = again.select(*columns, F.lit(False).alias("late")).unionByName(
            late.select(*columns, F.lit(True).alias("late"))
        )
        both = materialize(both, "touched-rows")
        # Totals of the days that are read again come from their rows; only keys with late rows matter.
        late_keys = joinable(late.select(F.col(key).alias("key")).distinct(), late_rows)
        others = known.join(late_keys, "key", "left_semi")
        others = others.join(touched, ["key", "day"], "left_anti")
        fresh = features.point_in_time(
            both, (key,), horizons, amount_type, past_totals={key: others}, split_rows=split_rows
        )
        found[key] = _changed(fresh, both, key, longest).select(
            "id", "late", *[f(key, h) for f in (average_name, count_name) for h in horizons]
        )
    return found


def _changed(fresh: DataFrame, both: DataFrame, key: str, longest: int) -> DataFrame:
    """Late rows, and rows that follow one: by the first late row of each (key, day) within reach.

    A row follows a late one of an earlier day for sure, so of the days before only whether there is one counts.
    """
    reached = _reached(both, key, longest).hint("merge")  # about as many days as rows, where keys are seldom
    rows = fresh.withColumn("_day", F.to_date("ts")).join(reached, [key, "_day"], "left")
    follows = F.col("_before") | (F.struct("ts", "id") > F.col("_own"))
    return rows.where(F.col("late") | F.coalesce(follows, F.lit(False)))


def _reached(both: DataFrame, key: str, longest: int) -> DataFrame:
    """By (key, day) of the rows: whether a late one lies on a day before, within reach, and the first one of the day itself."""
    own = F.min(F.when(F.col("late"), F.struct("ts", "id"))).alias("_own")
    dated = both.where(F.col(key).isNotNull() & F.col("ts").isNotNull())
    days = dated.groupBy(key, F.to_date("ts").alias("_day")).agg(own)
    reach = Window.partitionBy(key).orderBy(F.unix_date("_day")).rangeBetween(-longest, -1)
    return days.withColumn("_before", F.coalesce(F.max(F.col("_own").isNotNull()).over(reach), F.lit(False)))


def corrected(featured: DataFrame, changes: dict[str, DataFrame], horizons: dict[str, int] = HORIZONS) -> DataFrame:
    """``featured`` (``id`` and the features of all key columns) with the changes applied and late rows added.

    A row whose one key is untouched keeps the stored features of that key. Late rows are in the changes of every key.
    """
    names = {k: [f(k, h) for f in (average_name, count_name) for h in horizons] for k in changes}
    renamed = [
        frame.select("id", F.lit(True).alias(f"_in_{k}"), *[F.col(n).alias(f"_new_{n}") for n in names[k]])
        for k, frame in changes.items()
    ]
    change = reduce(lambda a, b: a.join(b, "id", "full"), renamed)
    joined = featured.join(change, "id", "full")
    columns = [
        F.when(F.col(f"_in_{k}"), F.col(f"_new_{n}")).otherwise(F.col(n)).alias(n) for k in changes for n in names[k]
    ]
    rest = [c for c in featured.columns if c != "id" and c not in [n for own in names.values() for n in own]]
    return joined.select("id", *rest, *columns)
