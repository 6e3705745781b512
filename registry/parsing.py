"""Sources, projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from registry import inputs
from tellerscore.functions import alerts, fields
from tellerscore.functions.text import cast_columns, decode_value, json_deserialize, json_serialize
from tellerscore.operators import parse
from tellerscore.operators.alerts import alert_rows
from tellerscore.plans.scoring import label
from tellerscore.schemas import FEATURES, LABEL, TXN_AFTER_A
from tellerscore.session import new_path
from tellerscore.sources.training import training_csv

SMALL_JSON = StructType([StructField("id", LongType()), StructField("account", LongType())])


def _inserts(spark, sf):
    return parse.transactions(inputs.order_records(spark, sf), parse.TENANT_A)[0]


def decode_value_query(spark, sf):
    text = F.to_json(F.struct(F.col("id"), F.col("account_id").alias("account")))
    return decode_value(inputs.orders(spark, sf).select("id", F.encode(text, "UTF-8").alias("value")))


def src_csv(spark, sf):
    rows = inputs.featured_events(spark, sf).select(*FEATURES, LABEL)
    path = new_path(spark, "training-csv")
    rows.write.option("header", True).csv(path)
    counts = training_csv(spark, path)
    return counts.groupBy("transaction_at_night", "transaction_in_weekend").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("total"),
        F.sum("account_id_count_3month").alias("account_rows"),
    )


def src_rows(spark, sf):
    names = spark.createDataFrame([("F", "finished"), ("O", "open"), ("P", "partial")], "status string, name string")
    return inputs.orders(spark, sf).join(names, "status").groupBy("name").agg(F.count(F.lit(1)).alias("n"))


def src_dicts(spark, sf):
    records = [{"op_type": "click", "weight": 1}, {"op_type": "purchase", "weight": 5}, {"op_type": "view", "weight": 2}]
    weights = spark.createDataFrame(records, "op_type string, weight int")
    weighed = inputs.events(spark, sf).join(weights, "op_type", "left").groupBy("op_type")
    return weighed.agg(F.sum(F.coalesce("weight", F.lit(0))).cast("long").alias("total"))


def parse_envelope(spark, sf):
    parsed = parse.parse_envelope(inputs.order_records(spark, sf), TXN_AFTER_A)
    return parsed.select("offset", "status", F.col("payload.after.savings_account_id").alias("account_id"))


def quarantine(spark, sf):
    records = inputs.order_records(spark, sf)
    damaged = records.withColumn(
        "value",
        F.when(F.col("value").contains('"transaction_type_enum":2'), F.expr("left(value, length(value) - 3)"))
        .when(F.col("value").contains('"before":null'), F.col("value")),
    )
    return parse.transactions(damaged, parse.TENANT_A)[1].select("offset", "reason")


def filter_insert(spark, sf):
    parsed = parse.parse_envelope(inputs.order_records(spark, sf), TXN_AFTER_A)
    return parse.filter_insert(parsed).select(F.col("payload.after.id").alias("id"))


def decode_amount(spark, sf):
    return _inserts(spark, sf).select("id", "amount")


def epoch_ms_to_ts(spark, sf):
    return _inserts(spark, sf).select("id", fields.time_text(F.col("ts")).alias("datetime"))


def epoch_us_to_ts(spark, sf):
    rows = parse.transactions(inputs.event_records(spark, sf), parse.TENANT_B)[0]
    return rows.select("id", fields.time_text(F.col("ts")).alias("datetime"))


def iso_ts(spark, sf):
    rows = parse.transactions(inputs.event_records(spark, sf), parse.TENANT_B)[0]
    return rows.select("id", fields.iso_ts(F.col("ts")).alias("iso"))


def op_type(spark, sf):
    return _inserts(spark, sf).select("id", "op_type")


def account_type(spark, sf):
    return parse.accounts(inputs.account_records_b(spark, sf), parse.TENANT_B)[0].select(
        "customer_id", "account_id", "account_type"
    )


def is_night(spark, sf):
    return inputs.events(spark, sf).select("id", fields.is_night(F.col("ts")).alias("night"))


def is_weekend(spark, sf):
    return inputs.events(spark, sf).select("id", fields.is_weekend(F.col("ts")).alias("weekend"))


def label_text(spark, sf):
    return inputs.table(spark, sf, "labels").select(
        "doc_id", fields.label_text(F.col("toxic").cast("double")).alias("is_fraud")
    )


def cast_columns_query(spark, sf):
    text = inputs.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("value").cast("string").alias("amount"),
        F.col("event_type").alias("count"),
    )
    target = StructType([StructField("id", LongType()), StructField("amount", DoubleType()), StructField("count", LongType())])
    return cast_columns(text, target)


def project_scored(spark, sf):
    rows = parse.transactions(inputs.event_records(spark, sf), parse.TENANT_B)[0]
    known = parse.accounts(inputs.account_records_b(spark, sf), parse.TENANT_B)[0]
    joined = rows.join(known.select("account_id", "customer_id", "account_type"), "account_id")
    return parse.project_scored(label(joined, None), parse.TENANT_B)


def _labelled_orders(spark, sf):
    """Orders with a rule for a model: large ones count as fraud."""
    guess = F.when(F.col("amount") > 400000, 1.0).otherwise(0.0)
    return inputs.orders(spark, sf).withColumn("is_fraud", fields.label_text(guess))


def alert_text(spark, sf):
    rows = _labelled_orders(spark, sf)
    return rows.select(
        "id",
        alerts.alert_text(
            fields.time_text(F.col("ts")),
            F.col("id"),
            F.col("customer_id"),
            F.col("account_id"),
            fields.number_text(F.col("amount")),
        ).alias("body"),
    )


def alert_payload(spark, sf):
    rows = _labelled_orders(spark, sf)
    title = F.concat(F.lit("Order "), F.col("id"))
    return rows.select("id", alerts.alert_payload(title, F.col("priority")).alias("chat"))


def alert_rows_query(spark, sf):
    return alert_rows(_labelled_orders(spark, sf), "desk@example.org", "The bank")


def json_serialize_query(spark, sf):
    rows = inputs.orders(spark, sf).select("id", F.col("account_id").alias("account"))
    return rows.select("id", json_serialize("id", "account").alias("value"))


def json_deserialize_query(spark, sf):
    rows = json_serialize_query(spark, sf)
    return rows.select(json_deserialize(F.col("value"), SMALL_JSON).alias("v")).select("v.id", "v.account")


def filter_eq(spark, sf):
    return inputs.orders(spark, sf).where(F.col("status") == "F").select("id", "account_id")


def filter_expr(spark, sf):
    rows = inputs.table(spark, sf, "labels").withColumn("prediction", (1 - F.col("toxic")).cast("double"))
    return rows.filter(F.expr("prediction = quality")).select("doc_id", "prediction")


def filter_since(spark, sf):
    rows = inputs.orders(spark, sf)
    anchor = F.lit("2001-08-01").cast("date")
    flags = [fields.since(F.col("ts"), anchor, n).cast("int").alias(f"in_{n}") for n in (1, 7, 30, 90)]
    return rows.where(fields.since(F.col("ts"), anchor, 90)).select("id", *flags)


def select_columns(spark, sf):
    return inputs.events(spark, sf).select(["id", "amount"])


QUERIES = {
    "decode_value": decode_value_query,
    "src_csv": src_csv,
    "src_rows": src_rows,
    "src_dicts": src_dicts,
    "parse_envelope": parse_envelope,
    "parse_quarantine": quarantine,
    "filter_insert": filter_insert,
    "decode_amount": decode_amount,
    "epoch_ms_to_ts": epoch_ms_to_ts,
    "epoch_us_to_ts": epoch_us_to_ts,
    "iso_ts": iso_ts,
    "op_type": op_type,
    "account_type": account_type,
    "is_night": is_night,
    "is_weekend": is_weekend,
    "label_text": label_text,
    "cast_columns": cast_columns_query,
    "project_scored": project_scored,
    "alert_text": alert_text,
    "alert_payload": alert_payload,
    "alert_rows": alert_rows_query,
    "json_serialize": json_serialize_query,
    "json_deserialize": json_deserialize_query,
    "filter_eq": filter_eq,
    "filter_expr": filter_expr,
    "filter_since": filter_since,
    "select_columns": select_columns,
}

_ORDER_JSON = "'{\"id\":' || o_orderkey || ',\"account\":' || o_custkey || '}'"


# The wording of the alerts, written out once more, so that a changed word is noticed.
_MOMENT = "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"
_BODY = f"""'We have detected a suspicious transaction on a user''s account on ' || {_MOMENT} || '.
Your immediate attention to this matter is required.
Please review the details provided below:

Transaction ID: ' || CAST(o_orderkey AS VARCHAR) || '
Customer ID: ' || CAST((o_custkey // 3) AS VARCHAR) || '
Account ID: ' || CAST(o_custkey AS VARCHAR) || '
Amount: $' || CAST(o_totalprice AS VARCHAR) || '
Date: ' || {_MOMENT} || '.

We kindly request that you take immediate action to thoroughly investigate and address this issue to prevent any further fraudulent activity.
Your prompt response is greatly appreciated.'"""
_SUBJECT = "'Urgent: Potential Fraud Transaction Detected - Action Required'"
_GREETING = """'Dear Admin,

'"""
_FAREWELL = """'

Best regards,
The bank'"""


def _chat_sql(title: str, body: str) -> str:
    quoted = f"""replace(replace({body}, '"', '\\"'), chr(10), '\\n')"""
    return f"""'{{"icon_emoji":":exclamation:","username":"AI Assistant Alert","attachments":[{{"title":"' || {title}
        || '","text":"' || {quoted} || '","color":"danger"}}]}}'"""


ORACLE = {
    "decode_value": f"SELECT o_orderkey AS id, {_ORDER_JSON} AS value FROM orders",
    "src_csv": """
        SELECT CAST(hour(ts) >= 22 OR hour(ts) < 6 AS INT) AS transaction_at_night,
               CAST(isodow(ts) >= 6 AS INT) AS transaction_in_weekend,
               COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
               CAST(SUM(c) AS BIGINT) AS account_rows
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS c FROM events)
        GROUP BY 1, 2""",
    "src_rows": """
        SELECT name, COUNT(*) AS n FROM orders
        JOIN (VALUES ('F','finished'), ('O','open'), ('P','partial')) s(code, name) ON o_orderstatus = code
        GROUP BY name""",
    "src_dicts": """
        SELECT event_type AS op_type,
               CAST(SUM(CASE event_type WHEN 'click' THEN 1 WHEN 'purchase' THEN 5 WHEN 'view' THEN 2 ELSE 0 END) AS BIGINT) AS total
        FROM events GROUP BY 1""",
    "parse_envelope": """
        SELECT o_orderkey AS "offset", CASE WHEN o_orderstatus = 'P' THEN 'update' ELSE 'insert' END AS status,
               o_custkey AS account_id FROM orders""",
    "parse_quarantine": """
        SELECT o_orderkey AS "offset", CASE WHEN o_orderstatus = 'F' THEN 'malformed' ELSE 'tombstone' END AS reason
        FROM orders WHERE o_orderstatus IN ('F', 'P')""",
    "filter_insert": "SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'P'",
    "decode_amount": "SELECT o_orderkey AS id, o_totalprice AS amount FROM orders WHERE o_orderstatus <> 'P'",
    "epoch_ms_to_ts": """
        SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS datetime
        FROM orders WHERE o_orderstatus <> 'P'""",
    "epoch_us_to_ts": "SELECT event_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS datetime FROM events",
    "iso_ts": "SELECT event_id AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso FROM events",
    "op_type": """
        SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'DEBIT' ELSE 'CREDIT' END AS op_type
        FROM orders WHERE o_orderstatus <> 'P'""",
    "account_type": """
        SELECT c_custkey // 3 AS customer_id, 'U' || c_custkey AS account_id,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'Saving Account' ELSE 'Current Account' END AS account_type
        FROM customer""",
    "is_night": "SELECT event_id AS id, CAST(hour(ts) >= 22 OR hour(ts) < 6 AS INT) AS night FROM events",
    "is_weekend": "SELECT event_id AS id, CAST(isodow(ts) >= 6 AS INT) AS weekend FROM events",
    "label_text": "SELECT doc_id, CASE WHEN toxic = 0 THEN 'valid' ELSE 'fraudulent' END AS is_fraud FROM labels",
    "cast_columns": "SELECT event_id AS id, value AS amount, TRY_CAST(event_type AS BIGINT) AS count FROM events",
    "project_scored": """
        SELECT 'U' || user_id AS "account-id", value AS amount, c_custkey // 3 AS "Customer-id",
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS "operation-date", 'valid' AS is_fraud,
               event_id AS "transaction-id", event_type AS type, props AS "transaction-description",
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'Saving Account' ELSE 'Current Account' END AS account_type,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "@timestamp"
        FROM events JOIN customer ON user_id = c_custkey""",
    "alert_text": f"SELECT o_orderkey AS id, {_BODY} AS body FROM orders",
    "alert_payload": "SELECT o_orderkey AS id, " + _chat_sql("'Order ' || o_orderkey", "o_orderpriority") + " AS chat FROM orders",
    "alert_rows": f"""
        SELECT id, 'fraud' AS channel, 'desk@example.org' AS recipient, {_SUBJECT} AS subject,
               {_chat_sql(_SUBJECT, "body")} AS chat,
               {_GREETING} || body || {_FAREWELL} AS mail
        FROM (SELECT o_orderkey AS id, {_BODY} AS body FROM orders WHERE o_totalprice > 400000)""",
    "json_serialize": f"SELECT o_orderkey AS id, {_ORDER_JSON} AS value FROM orders",
    "json_deserialize": "SELECT o_orderkey AS id, o_custkey AS account FROM orders",
    "filter_eq": "SELECT o_orderkey AS id, o_custkey AS account_id FROM orders WHERE o_orderstatus = 'F'",
    "filter_expr": "SELECT doc_id, CAST(1 - toxic AS DOUBLE) AS prediction FROM labels WHERE 1 - toxic = quality",
    "filter_since": """
        SELECT o_orderkey AS id, CAST(d >= DATE '2001-07-31' AS INT) AS in_1, CAST(d >= DATE '2001-07-25' AS INT) AS in_7,
               CAST(d >= DATE '2001-07-02' AS INT) AS in_30, CAST(d >= DATE '2001-05-03' AS INT) AS in_90
        FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders) WHERE d >= DATE '2001-05-03'""",
    "select_columns": "SELECT event_id AS id, value AS amount FROM events",
}
