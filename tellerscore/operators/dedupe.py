"""Keyed last-wins and first-wins selection.

Both are grouped aggregates, so copies of one key collapse inside each map task before the
shuffle: a key that holds a third of all rows sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], order: list[str], chooser) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    # The other columns break ties, so that a retry picks the same row.
    ties = [c for c in rest if c not in order]
    picked = df.groupBy(*keys).agg(
        chooser(F.struct(*rest), F.struct(*order, *ties)).alias("_row")
    )
    fields = {c: F.col(c) for c in keys} | {c: F.col("_row")[c] for c in rest}
    return picked.select(*[fields[c].alias(c) for c in df.columns])


def last_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one that comes last in ``order``."""
    return _pick(df, keys, order, F.max_by)


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one that comes first in ``order``."""
    return _pick(df, keys, order, F.min_by)


def arrival(df: DataFrame) -> list[str]:
    """Columns that order records as they came: the broker's time where it is known, then the position.

    Offsets of different partitions, or of a topic that was made anew, say nothing about time.
    """
    return [c for c in ("broker_time", "offset", "partition") if c in df.columns]


def dedupe_transactions(batch: DataFrame) -> DataFrame:
    """A transaction id delivered more than once counts once; the last copy wins."""
    return last_by(batch, ["id"], arrival(batch))


def without_repeats(records: DataFrame, delay: str) -> DataFrame:
    """A stream of change events without inserts that come again within ``delay`` of their first arrival.

    The key is the feed and the inserted id, so ids of two feeds do not meet. Records that are no inserts, or
    have no id, all pass. The clock is that of arrival, one time per micro-batch: no record is late, whatever
    its own time, so none is lost, and ids older than ``delay`` leave the state.
    """
    new = F.get_json_object("value", "$.payload.before").isNull()
    own = F.when(new, F.get_json_object("value", "$.payload.after.id"))
    position = F.struct("partition", "offset")
    keyed = records.withColumns(
        {
            "_arrived": F.current_timestamp(),
            "_feed": F.coalesce("topic", F.lit("")),
            "_id": own,
            "_place": F.when(own.isNull(), F.to_json(position)),
        }
    )
    single = keyed.withWatermark("_arrived", delay).dropDuplicatesWithinWatermark(["_feed", "_id", "_place"])
    return single.drop("_arrived", "_feed", "_id", "_place")


def unseen(batch: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of the batch whose id is not in ``known``."""
    return batch.join(known.select("id"), "id", "left_anti")
