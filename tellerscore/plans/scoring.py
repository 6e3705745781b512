"""Scoring a whole history at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerscore.operators import features, ml
from tellerscore.operators.accounts import join_account, latest_accounts
from tellerscore.operators.dedupe import dedupe_transactions
from tellerscore.operators.parse import Tenant, accounts, transactions
from tellerscore.session import materialize_measured


@dataclass(frozen=True)
class Scored:
    """``scored`` is canonical; ``project_scored`` turns it into a tenant's output row."""

    scored: DataFrame
    pending: DataFrame
    quarantine: DataFrame


def label(rows: DataFrame, model: Model | None) -> DataFrame:
    """Labels from the model; without one every row is ``valid``."""
    if model is None:
        return rows.withColumn("is_fraud", F.lit("valid"))
    return ml.score(model, rows)


def score_backfill(transaction_records: DataFrame, account_records: DataFrame, tenant: Tenant, model: Model | None = None) -> Scored:
    """Parse, join and score every insert in event order.

    The parsed and joined rows are written once in columnar form: the feature jobs read them
    several times, and would parse the JSON each time otherwise.
    """
    inserts, bad_transactions = transactions(transaction_records, tenant)
    versions, bad_accounts = accounts(account_records, tenant)
    resolved, pending = join_account(dedupe_transactions(inserts), latest_accounts(versions))
    rows, seen = materialize_measured(resolved, "resolved", F.count(F.lit(1)).alias("n"))
    featured = features.calendar_flags(features.point_in_time(rows, row_count=seen["n"]))
    return Scored(label(featured, model), pending, bad_transactions.unionByName(bad_accounts))
