"""Change streams, accounts and histories that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerscore.functions.fields import encode_amount
from tellerscore.operators import features
from tellerscore.session import materialize, new_path

NULLS = {"ignoreNullFields": "false"}


#: A rule that looks at averages and counts of both keys over all horizons, and at both flags; the same
#: text is an expression for Spark and for the SQL counterpart.
RULE = """(
    amount > 1.5 * customer_id_avrge_amount_1week AND customer_id_count_1month >= 3
    OR amount > 1.5 * account_id_avrge_amount_1day AND account_id_count_1day >= 2
    OR amount > 1.9 * customer_id_avrge_amount_1day AND customer_id_count_1week >= 2
    OR transaction_at_night = 1 AND amount > 1.8 * customer_id_avrge_amount_3month AND account_id_count_3month >= 2
    OR transaction_in_weekend = 1 AND amount < 0.1 * account_id_avrge_amount_1month AND customer_id_count_3month >= 4
    OR amount > 1.4 * account_id_avrge_amount_1week AND account_id_count_1week >= 2 AND customer_id_count_1day = 1
    OR amount > 1.7 * account_id_avrge_amount_3month AND account_id_count_1month >= 2
    OR amount < 0.2 * customer_id_avrge_amount_1month AND account_id_count_1month = 1)"""


#: The rule behind the label of the training rows.
LABELLED = """(
    amount > 2.5 * customer_id_avrge_amount_3month AND customer_id_count_3month > 3
    OR transaction_at_night = 1 AND amount > 150)"""


def rule_model() -> SQLTransformer:
    """A model that needs no training: it predicts 1 where the rule holds."""
    return SQLTransformer(statement=f"SELECT *, CAST({RULE} AS DOUBLE) AS prediction FROM __THIS__")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as transactions; three neighbouring accounts belong to one customer."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("account_id"),
        F.expr("o_custkey div 3").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as transactions with clock times."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("account_id"),
        F.expr("user_id div 3").alias("customer_id"),
        F.col("value").alias("amount"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("op_type"),
        F.col("props").alias("description"),
    )


def _records(df: DataFrame, value, offset) -> DataFrame:
    return df.select(value.alias("value"), F.lit(0).alias("partition"), offset.cast("long").alias("offset"))


def order_records(spark: SparkSession, sf: str) -> DataFrame:
    """Tenant A change events: open and finished orders are inserts, status P stands for updates."""
    rows = orders(spark, sf)
    before = F.when(F.col("status") == "P", F.struct(F.col("id").alias("id")))
    after = F.struct(
        F.col("id"),
        F.col("account_id").alias("savings_account_id"),
        F.unix_millis("ts").alias("created_date"),
        F.when(F.col("status") == "F", 2).otherwise(1).alias("transaction_type_enum"),
        encode_amount(F.col("amount")).alias("amount"),
    )
    payload = F.struct(before.alias("before"), after.alias("after"))
    return _records(rows, F.to_json(F.struct(payload.alias("payload")), NULLS), F.col("id"))


def event_records(spark: SparkSession, sf: str) -> DataFrame:
    """Tenant B change events, their clock one hour ahead."""
    rows = events(spark, sf)
    after = F.struct(
        F.col("id"),
        F.concat(F.lit("U"), F.col("account_id")).alias("bank_account_id"),
        (F.unix_micros("ts") + 3_600_000_000).alias("operation_date"),
        F.col("op_type").alias("type"),
        F.col("amount"),
        F.col("description"),
    )
    payload = F.struct(F.lit(None).cast("string").alias("before"), after.alias("after"))
    return _records(rows, F.to_json(F.struct(payload.alias("payload")), NULLS), F.col("id"))


def account_records_a(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer")
    after = F.struct(F.col("c_custkey").alias("id"), F.expr("c_custkey div 3").alias("client_id"))
    payload = F.struct(F.lit(None).cast("string").alias("before"), after.alias("after"))
    return _records(rows, F.to_json(F.struct(payload.alias("payload")), NULLS), F.col("c_custkey"))


def account_records_b(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer")
    after = F.struct(
        F.concat(F.lit("U"), F.col("c_custkey")).alias("id"),
        F.expr("c_custkey div 3").alias("client_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", "SA").otherwise("CA").alias("type"),
    )
    payload = F.struct(F.lit(None).cast("string").alias("before"), after.alias("after"))
    return _records(rows, F.to_json(F.struct(payload.alias("payload")), NULLS), F.col("c_custkey"))


def account_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Every order is taken as a new version of its account: the customer changes with it."""
    return orders(spark, sf).select(
        F.expr("id div 7").alias("customer_id"),
        "account_id",
        F.col("priority").alias("account_type"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.lit("accounts").alias("topic"),
        F.lit(None).cast("timestamp").alias("broker_time"),
        F.col("ts").alias("seen_at"),
    )


def files(records: DataFrame, name: str) -> str:
    """Write change events as JSON lines, as a file stream reads them."""
    path = new_path(records.sparkSession, name)
    records.write.option("ignoreNullFields", False).json(path)
    return path


def featured_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with all features and a rule-made label, written."""
    rows = events(spark, sf).select("id", "account_id", "customer_id", "amount", "ts")
    with_features = features.calendar_flags(features.point_in_time(rows))
    return materialize(with_features.withColumn("is_fraud", F.expr(LABELLED).cast("int")), "featured-events")
