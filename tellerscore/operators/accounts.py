"""The account dimension and its join with transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tellerscore.operators.dedupe import arrival, first_by, last_by



def latest_accounts(versions: DataFrame) -> DataFrame:
    """The last version of each account.

    Offsets only order the records of one partition's life, so the time a version was seen comes first where
    it is known, and then the broker's: a later micro-batch wins, and inside one the later record.
    """
    seen = ["seen_at"] if "seen_at" in versions.columns else []
    return last_by(versions, ["account_id"], [*seen, *arrival(versions)])


def first_accounts(versions: DataFrame) -> DataFrame:
    """The first version of each account, as an append-only table would answer."""
    return first_by(versions, ["account_id"], arrival(versions))


def live_accounts(versions: DataFrame, now: Column, ttl_seconds: int | None) -> DataFrame:
    """Latest versions that were written no longer than ``ttl_seconds`` ago; no limit if None."""
    latest = latest_accounts(versions)
    if ttl_seconds is None:
        return latest
    return latest.where(F.col("seen_at") > now - F.make_dt_interval(secs=F.lit(ttl_seconds)))


def insert_if_absent(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append the distinct rows that the table does not hold yet, comparing whole rows null-safe.

    An account that changes its customer therefore gets a second row.
    """
    # Duplicates among the new rows go first: they combine map-side, before the anti-join.
    return table.unionByName(rows.select(table.columns).distinct().subtract(table))


def with_account(batch: DataFrame, accounts: DataFrame) -> DataFrame:
    """Each transaction with its account's columns and whether the account is ``known``.

    The join carries no hint. Adaptive execution broadcasts the account side only if it
    measures small, and otherwise splits a hot account's transactions over several tasks.
    """
    columns = accounts.select("account_id", "customer_id", "account_type", F.lit(True).alias("known"))
    return batch.join(columns, "account_id", "left").select(
        *batch.columns, "customer_id", "account_type", F.coalesce("known", F.lit(False)).alias("known")
    )


def resolved_only(joined: DataFrame) -> DataFrame:
    return joined.where("known").drop("known")


def pending_only(joined: DataFrame) -> DataFrame:
    """Transactions that wait for their account, in the shape they arrived in."""
    return joined.where("NOT known").drop("known", "customer_id", "account_type")


def join_account(batch: DataFrame, accounts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Transactions with their customer, and those whose account is not known yet."""
    joined = with_account(batch, accounts)
    return resolved_only(joined), pending_only(joined)
