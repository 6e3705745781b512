"""Joins, keyed selection, set operations and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import inputs
from tellerscore.operators import accounts, dedupe, history, metrics
from tellerscore.session import new_path
from tellerscore.streaming.buckets import BucketedTable


def _building(spark, sf):
    """Customers as accounts, but only those of some segments, so that accounts are missing."""
    rows = inputs.table(spark, sf, "customer").where("c_mktsegment IN ('BUILDING', 'MACHINERY')")
    return rows.select(
        F.col("c_custkey").alias("account_id"),
        F.expr("c_custkey div 3").alias("customer_id"),
        F.col("c_mktsegment").alias("account_type"),
    )


def _batch(spark, sf):
    return inputs.orders(spark, sf).select("id", "account_id", "amount")


def join_account(spark, sf):
    return accounts.join_account(_batch(spark, sf), _building(spark, sf))[0]


def pending_account(spark, sf):
    return accounts.join_account(_batch(spark, sf), _building(spark, sf))[1]


def exists_check(spark, sf):
    rows = inputs.table(spark, sf, "customer").select(F.col("c_custkey").alias("account_id"))
    return rows.join(inputs.events(spark, sf), "account_id", "left_anti")


def account_lookup(spark, sf):
    rows = inputs.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("account_id"),
        F.expr("c_custkey div 3").alias("customer_id"),
        F.col("c_mktsegment").alias("account_type"),
    )
    table = BucketedTable(new_path(spark, "accounts"), rows.schema, key="account_id", buckets=8)
    table.write(rows, 0)
    return table.lookup(inputs.orders(spark, sf))


def latest_account(spark, sf):
    return accounts.latest_accounts(inputs.account_versions(spark, sf)).select(
        "account_id", "customer_id", "account_type"
    )


def first_match(spark, sf):
    return accounts.first_accounts(inputs.account_versions(spark, sf)).select(
        "account_id", "customer_id", "account_type"
    )


def latest_by_time(spark, sf):
    """Versions in four partitions whose offsets run against the broker's time, as after a topic was made anew."""
    versions = inputs.account_versions(spark, sf).withColumns(
        {"partition": (F.col("offset") % 4).cast("int"), "offset": 10**9 - F.col("offset"), "broker_time": F.col("seen_at")}
    )
    return accounts.latest_accounts(versions.drop("seen_at")).select("account_id", "customer_id", "account_type")


def dedupe_by_time(spark, sf):
    """Corrected copies that come later, in another partition and at a smaller offset."""
    rows = inputs.events(spark, sf).select("id", "account_id", "amount", "op_type", F.col("ts").alias("broker_time"))
    first = rows.withColumns({"partition": F.lit(0), "offset": F.col("id") + 10**9})
    later = rows.where("op_type = 'error'").withColumns(
        {"partition": F.lit(1), "offset": F.col("id"), "amount": F.col("amount") + 1, "broker_time": F.expr("broker_time + INTERVAL 1 HOUR")}
    )
    return dedupe.dedupe_transactions(first.unionByName(later)).select("id", "account_id", "amount")


def account_ttl(spark, sf):
    now = F.lit("2001-08-02 00:00:00").cast("timestamp")
    live = accounts.live_accounts(inputs.account_versions(spark, sf), now, history.ACCOUNT_TTL)
    return live.select("account_id", "customer_id")


def first_row(spark, sf):
    return inputs.order_records(spark, sf).orderBy("offset").limit(1).select("offset")


def show(spark, sf):
    return inputs.orders(spark, sf).orderBy("id").limit(20).select("id", "account_id", "amount")


def _pairs(spark, sf):
    return inputs.orders(spark, sf).select("customer_id", "account_id", "status")


def insert_if_absent(spark, sf):
    rows = _pairs(spark, sf)
    return accounts.insert_if_absent(rows.where("status = 'F'"), rows)


def subtract(spark, sf):
    rows = _pairs(spark, sf)
    keys = ("customer_id", "account_id")
    return rows.where("status <> 'P'").select(*keys).subtract(rows.where("status = 'P'").select(*keys))


def union_append(spark, sf):
    rows = _pairs(spark, sf)
    return rows.where("status <> 'P'").unionByName(rows.where("status = 'P'"))


def dedupe_txn(spark, sf):
    rows = inputs.events(spark, sf).select("id", "account_id", "amount", F.lit(0).alias("partition"), F.col("id").alias("offset"), "op_type")
    again = rows.where("op_type = 'error'").withColumn("amount", F.col("amount") + 1).withColumn("offset", F.col("offset") + 10**9)
    copies = rows.where("op_type = 'view'").withColumn("offset", F.col("offset") + 2 * 10**9)
    everything = rows.unionByName(again).unionByName(copies).unionByName(copies)
    return dedupe.dedupe_transactions(everything).select("id", "account_id", "amount")


def history_ttl(spark, sf):
    rows = inputs.orders(spark, sf).withColumn("event_day", F.to_date("ts"))
    return history.retained(rows, F.lit("2001-08-01").cast("date")).select("id", "amount")


def history_scan(spark, sf):
    rows = inputs.orders(spark, sf).withColumn("event_day", F.to_date("ts"))
    batch = rows.where("event_day = '2001-08-01'")
    seen = history.history_scan(rows, batch, "customer_id", F.lit("2001-05-03").cast("date"), F.lit("2001-08-01").cast("date"))
    return seen.select("id", "customer_id", "amount")


def _predictions(spark, sf):
    return inputs.table(spark, sf, "labels").select(
        F.col("quality").alias("is_fraud"), (1 - F.col("toxic")).cast("double").alias("prediction")
    )


def match_percentage(spark, sf):
    return metrics.match_percentage(_predictions(spark, sf)).select(F.round("match_percentage", 6).alias("match_percentage"))


def eval_metrics(spark, sf):
    measured = metrics.eval_metrics(_predictions(spark, sf))
    return measured.select(*[F.round(m, 9).alias(m) for m in metrics.METRICS])


def count_rows(spark, sf):
    return inputs.orders(spark, sf).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "join_account": join_account,
    "pending_account": pending_account,
    "exists_check": exists_check,
    "account_lookup": account_lookup,
    "latest_account": latest_account,
    "first_match": first_match,
    "latest_by_time": latest_by_time,
    "dedupe_by_time": dedupe_by_time,
    "account_ttl": account_ttl,
    "first_row": first_row,
    "show": show,
    "insert_if_absent": insert_if_absent,
    "subtract": subtract,
    "union_append": union_append,
    "dedupe_txn": dedupe_txn,
    "history_ttl": history_ttl,
    "history_scan": history_scan,
    "match_percentage": match_percentage,
    "eval_metrics": eval_metrics,
    "count_rows": count_rows,
}

_KNOWN = "(SELECT c_custkey AS account_id, c_custkey // 3 AS customer_id, c_mktsegment AS account_type FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))"
_VERSION = "SELECT o_custkey AS account_id, o_orderkey // 7 AS customer_id, o_orderpriority AS account_type, o_orderdate AS seen, row_number() OVER (PARTITION BY o_custkey ORDER BY {order}) AS r FROM orders"
_PAIRS = "SELECT o_custkey // 3 AS customer_id, o_custkey AS account_id, o_orderstatus AS status FROM orders"

ORACLE = {
    "join_account": f"""
        SELECT o_orderkey AS id, o_custkey AS account_id, o_totalprice AS amount, customer_id, account_type
        FROM orders JOIN {_KNOWN} ON o_custkey = account_id""",
    "pending_account": f"""
        SELECT o_orderkey AS id, o_custkey AS account_id, o_totalprice AS amount
        FROM orders WHERE o_custkey NOT IN (SELECT account_id FROM {_KNOWN})""",
    "exists_check": "SELECT c_custkey AS account_id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)",
    "account_lookup": """
        SELECT c_custkey AS account_id, c_custkey // 3 AS customer_id, c_mktsegment AS account_type
        FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""",
    "latest_account": f"SELECT account_id, customer_id, account_type FROM ({_VERSION.format(order='o_orderdate DESC, o_orderkey DESC')}) WHERE r = 1",
    "latest_by_time": f"SELECT account_id, customer_id, account_type FROM ({_VERSION.format(order='o_orderdate DESC, o_orderkey')}) WHERE r = 1",
    "dedupe_by_time": """
        SELECT event_id AS id, user_id AS account_id, CASE WHEN event_type = 'error' THEN value + 1 ELSE value END AS amount FROM events""",
    "first_match": f"SELECT account_id, customer_id, account_type FROM ({_VERSION.format(order='o_orderkey')}) WHERE r = 1",
    "account_ttl": f"""
        SELECT account_id, customer_id FROM ({_VERSION.format(order='o_orderdate DESC, o_orderkey DESC')})
        WHERE r = 1 AND seen > TIMESTAMP '2001-07-26 00:00:00'""",
    "first_row": 'SELECT MIN(o_orderkey) AS "offset" FROM orders',
    "show": "SELECT o_orderkey AS id, o_custkey AS account_id, o_totalprice AS amount FROM orders ORDER BY 1 LIMIT 20",
    "insert_if_absent": f"""
        SELECT * FROM ({_PAIRS}) WHERE status = 'F' UNION ALL
        (SELECT * FROM ({_PAIRS}) EXCEPT SELECT * FROM ({_PAIRS}) WHERE status = 'F')""",
    "subtract": f"""
        SELECT customer_id, account_id FROM ({_PAIRS}) WHERE status <> 'P'
        EXCEPT SELECT customer_id, account_id FROM ({_PAIRS}) WHERE status = 'P'""",
    "union_append": f"SELECT * FROM ({_PAIRS}) WHERE status <> 'P' UNION ALL SELECT * FROM ({_PAIRS}) WHERE status = 'P'",
    "dedupe_txn": """
        SELECT event_id AS id, user_id AS account_id,
               CASE WHEN event_type = 'error' THEN value + 1 ELSE value END AS amount FROM events""",
    "history_ttl": """
        SELECT o_orderkey AS id, o_totalprice AS amount FROM orders
        WHERE CAST(o_orderdate AS DATE) >= DATE '2001-08-01' - 91""",
    "history_scan": """
        SELECT o_orderkey AS id, o_custkey // 3 AS customer_id, o_totalprice AS amount FROM orders
        WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2001-05-03' AND DATE '2001-08-01' AND o_custkey // 3 IN
              (SELECT o_custkey // 3 FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '2001-08-01')""",
    "match_percentage": """
        SELECT ROUND(100.0 * SUM(CASE WHEN 1 - toxic = quality THEN 1 ELSE 0 END)::DOUBLE / COUNT(*), 6) AS match_percentage
        FROM labels""",
    "eval_metrics": """
        WITH p AS (SELECT quality AS label, 1 - toxic AS guess FROM labels),
             c AS (SELECT k, (SELECT COUNT(*) FROM p WHERE label = k)::DOUBLE AS n,
                          (SELECT COUNT(*) FROM p WHERE guess = k)::DOUBLE AS g,
                          (SELECT COUNT(*) FROM p WHERE label = k AND guess = k)::DOUBLE AS t
                   FROM (SELECT label AS k FROM p UNION SELECT guess FROM p))
        SELECT ROUND(SUM(n * CASE WHEN g > 0 THEN t / g ELSE 0 END) / SUM(n), 9) AS "weightedPrecision",
               ROUND(SUM(t) / SUM(n), 9) AS "weightedRecall", ROUND(SUM(t) / SUM(n), 9) AS accuracy,
               ROUND(SUM(n * 2 * t / (n + g)) / SUM(n), 9) AS f1 FROM c""",
    "count_rows": "SELECT COUNT(*) AS n FROM orders",
}
