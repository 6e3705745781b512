"""Reads of the retained transaction history."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Retention of transactions and accounts in seconds.
HISTORY_TTL = 7_889_229
ACCOUNT_TTL = 604_800
HISTORY_DAYS = HISTORY_TTL // 86_400


def retained(history: DataFrame, today: Column | datetime.date, days: int = HISTORY_DAYS) -> DataFrame:
    """Rows of the last ``days`` days. ``event_day`` is a partition column, so older days are not read."""
    anchor = today if isinstance(today, Column) else F.lit(today)
    return history.where(F.col("event_day") >= F.date_sub(anchor, days))


def history_scan(history: DataFrame, batch: DataFrame, key: str, first_day, last_day) -> DataFrame:
    """The history rows that a batch's keys can see: pruned by day, then by key."""
    days = history.where(F.col("event_day").between(F.lit(first_day), F.lit(last_day)))
    return days.join(batch.select(key).distinct(), key, "left_semi")
