"""Queries that keep their state inside a stream: trailing features by key, and transactions that wait."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import inputs
from registry.trailing import ORACLE as TRAILING
from tellerscore import schemas
from tellerscore.operators import parse
from tellerscore.session import materialize, new_path
from tellerscore.sources.cdc import cdc_stream
from tellerscore.streaming import keyed, waiting

_BORDERS = ("2024-01-08", "2024-01-16 12:00:00", "2024-01-24")
_WAIT, _TTL_DAYS = "5 days", 10


def _in_steps(stream, parts, name):
    """Run a stream once per step, from its checkpoint, after the step's files were added; return its table.

    ``parts`` are pairs of a frame with a ``part`` column and the folder that the stream reads it from. A step
    holds as many files as its rows need, and no later step's rows are seen before it ends.
    """
    spark = stream.sparkSession
    path = new_path(spark, name)
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-checkpoint")
    for i in range(len(_BORDERS) + 2):
        for rows, folder in parts:
            step = rows.where(F.col("part") == i).drop("part")
            step.write.mode("append").option("ignoreNullFields", False).json(folder)
        with keyed.rocksdb_state(spark):
            query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def _empty_folder(rows):
    folder = new_path(rows.sparkSession, "steps")
    rows.drop("part").limit(0).write.json(folder)
    return folder


def _part(time):
    return sum((time >= F.lit(d).cast("timestamp")).cast("int") for d in _BORDERS)


def feat_stream_state(spark, sf):
    """Events in four micro-batches that follow event order, their features from keyed state."""
    rows = inputs.events(spark, sf).select("id", "account_id", "customer_id", "amount", "ts")
    parts = materialize(rows.withColumn("part", _part(F.col("ts"))), "parts")
    folder = _empty_folder(parts)
    stream = spark.readStream.schema(rows.schema).json(folder)
    names = [f(k, h) for k in schemas.KEYS for f in (schemas.average_name, schemas.count_name) for h in schemas.HORIZONS]
    found = _in_steps(keyed.trailing_stream(stream), [(parts, folder)], "featured")
    return keyed.by_row(found).select("id", *names)


def _timed_events(spark, sf):
    """Change events of tenant B as the broker stamped them."""
    times = inputs.events(spark, sf).select(F.col("id").alias("offset"), F.col("ts").alias("timestamp"))
    return inputs.event_records(spark, sf).join(times, "offset")


def _timed_accounts(spark, sf):
    """Two versions of every account, three days apart, the first on one of forty days."""
    records = inputs.account_records_b(spark, sf)
    start = F.lit("2024-01-01").cast("timestamp")
    first = F.make_dt_interval(days=(F.col("offset") * 7 % 40).cast("int"), mins=(F.col("offset") % 1440).cast("int"))
    old = records.withColumn("timestamp", start + first)
    newer = F.replace("value", F.lit('"type":"SA"'), F.lit('"type":"CA"'))
    new = old.withColumns({"timestamp": F.col("timestamp") + F.expr("INTERVAL 3 DAYS"), "value": newer})
    return old.unionByName(new.withColumn("offset", F.col("offset") + 10**9))


def _stepped(records, account):
    """Records in four steps of time; one more, far ahead, tells that nothing comes from before it."""
    steps = materialize(records.withColumn("part", _part(F.col("timestamp"))), "steps")
    ahead = steps.orderBy("offset").limit(1).withColumns(
        {
            "value": F.regexp_replace("value", r'"id":"?U?\d+"?', f'"id":{account}'),
            "timestamp": F.lit("2024-06-01").cast("timestamp"),
            "offset": F.lit(2 * 10**9).cast("long"),
            "part": F.lit(len(_BORDERS) + 1),
        }
    )
    return steps.unionByName(ahead), _empty_folder(steps)


def pending_stream(spark, sf):
    """Every event with the account that counts for it, or none if none came in time."""
    events, versions = _stepped(_timed_events(spark, sf), "-1"), _stepped(_timed_accounts(spark, sf), '"U-1"')
    rows = parse.transactions(cdc_stream(spark, "json", events[1]), parse.TENANT_B)[0]
    accounts = parse.accounts(cdc_stream(spark, "json", versions[1]), parse.TENANT_B)[0]
    rows = rows.select("id", "account_id", "amount", "broker_time")
    joined = waiting.with_account_stream(rows, accounts, _WAIT, "1 hour", _TTL_DAYS * 86_400)
    found = waiting.settled(_in_steps(joined, [events, versions], "joined").where("id >= 0"))
    return found.select("id", "account_id", "amount", "customer_id", "account_type", "seen")


QUERIES = {"feat_stream_state": feat_stream_state, "pending_stream": pending_stream}

ORACLE = {
    "feat_stream_state": TRAILING["join_history"],
    "pending_stream": f"""
        WITH v AS (
            SELECT 'U' || c_custkey AS account, c_custkey // 3 AS customer_id, c_mktsegment = 'BUILDING' AS saving,
                   TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey * 7 % 40 AS INT)) + to_minutes(c_custkey % 1440) AS seen
            FROM customer),
        a AS (
            SELECT account, customer_id, CASE WHEN saving THEN 'Saving Account' ELSE 'Current Account' END AS account_type, seen FROM v
            UNION ALL SELECT account, customer_id, 'Current Account', seen + INTERVAL 3 DAYS FROM v)
        SELECT id, account_id, amount, customer_id, account_type, seen FROM (
            SELECT event_id AS id, 'U' || user_id AS account_id, value AS amount, customer_id, account_type, seen,
                   row_number() OVER (PARTITION BY event_id ORDER BY seen > ts, abs(epoch_us(seen) - epoch_us(ts))) AS r
            FROM events LEFT JOIN a ON account = 'U' || user_id
                AND seen BETWEEN ts - INTERVAL {_TTL_DAYS} DAYS AND ts + INTERVAL {_WAIT}) WHERE r = 1""",
}
