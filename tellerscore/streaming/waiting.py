"""Transactions that wait for their account, as a stream-stream left outer join.

The scoring job keeps waiting rows in a table that it reads and writes again with every micro-batch. Here they
are state of the join: an account that arrives finds its waiting transactions by key, and the watermark ends a
wait without a further look at it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerscore.operators.dedupe import first_by
from tellerscore.operators.history import ACCOUNT_TTL


def with_account_stream(
    transactions: DataFrame, accounts: DataFrame, wait: str, delay: str, account_ttl: int = ACCOUNT_TTL
) -> DataFrame:
    """A stream of transactions with every version of their account that holds for them.

    Both streams carry ``broker_time``. A version holds for what comes up to ``account_ttl`` seconds after it, and for
    what has waited up to ``wait`` (an interval such as ``5 days``) when it comes; it is joined as soon as both sides
    are there. A transaction that no version holds for comes out once, with nulls in the columns of the account and a
    null ``seen``, when the clock of both streams has passed its wait.

    State is bounded by what arrives within ``wait`` and ``account_ttl``, each longer by ``delay``, up to which the
    records of a stream may be out of order; records later than that are dropped by the engine. Transactions without
    an account id wait and come out unmatched. Rows without a time have no place in either stream:
    keep them in a quarantine table (``parse.read_transactions`` does).
    """
    rows = transactions.withColumnRenamed("broker_time", "arrived").withWatermark("arrived", delay)
    versions = accounts.select(
        F.col("account_id").alias("_account"), "customer_id", "account_type", F.col("broker_time").alias("seen")
    ).withWatermark("seen", delay)
    holds = (
        (F.col("account_id") == F.col("_account"))
        & (F.col("seen") >= F.col("arrived") - F.make_dt_interval(secs=F.lit(account_ttl)))
        & (F.col("seen") <= F.col("arrived") + F.expr(f"INTERVAL {wait}"))
    )
    return rows.join(versions, holds, "left_outer").drop("_account")


def settled(joined: DataFrame) -> DataFrame:
    """One row per transaction of what :func:`with_account_stream` wrote, with the version that counts for it.

    That is the last one from before the transaction, or else the first that came after it, so it does not depend on
    how the streams were cut into micro-batches. Repeats of an id count once. Versions of one instant are told apart by
    their columns.
    """
    after = F.col("seen") > F.col("arrived")
    distance = F.abs(F.unix_micros("seen") - F.unix_micros("arrived"))
    # Nulls would come first; a transaction with any version has none, but repeats of its id may.
    order = {"_none": F.col("seen").isNull(), "_after": F.coalesce(after, F.lit(False)), "_distance": distance}
    return first_by(joined.withColumns(order), ["id"], [*order]).drop(*order)


def never_came(joined: DataFrame) -> DataFrame:
    """Transactions whose wait ended without an account."""
    return settled(joined).where("seen IS NULL").drop("seen", "customer_id", "account_type")
