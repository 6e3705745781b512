"""Streaming sources, sinks and the micro-batch jobs, each driven to the end of its input."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry import inputs
from registry.trailing import featured_sql
from tellerscore import schemas
from tellerscore.operators import accounts, dedupe, parse
from tellerscore.plans.scoring import label, score_backfill
from tellerscore.session import materialize, new_path
from tellerscore.sinks import committed, notify
from tellerscore.sinks.index import conform, create_target, write_index
from tellerscore.sources import segments
from tellerscore.sources.cdc import cdc_stream, multi_stream
from tellerscore.streaming.buckets import BucketedTable
from tellerscore.streaming.jobs import AccountJob, ScoringJob, Tables
from tellerscore.streaming.known import KnownIds
from tellerscore.streaming.tables import EpochTable


#: Rows of a file that a stream reads: files, and with them the tasks of a micro-batch, grow with the table.
FILE_ROWS = 20_000


def _files(rows):
    """How many files hold ``rows`` rows."""
    return max(1, -(-rows // FILE_ROWS))


def _drain(stream, name):
    """Run a stream over all its input into a table and return the table."""
    spark = stream.sparkSession
    path = new_path(spark, name)
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", f"{path}-checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def src_cdc_stream(spark, sf):
    folder = inputs.files(inputs.order_records(spark, sf), "order-records")
    stream = cdc_stream(spark, "json", folder)
    inserts, _ = parse.transactions(stream, parse.TENANT_A)
    return _drain(inserts.select("id", "account_id", "amount", "op_type"), "cdc")


def src_multi_stream(spark, sf):
    savings = cdc_stream(spark, "json", inputs.files(inputs.order_records(spark, sf), "order-records"))
    current = cdc_stream(spark, "json", inputs.files(inputs.event_records(spark, sf), "event-records"))
    a = parse.transactions(savings, parse.TENANT_A)[0].withColumn("account_id", F.col("account_id").cast("string"))
    b = parse.transactions(current, parse.TENANT_B)[0]
    merged = multi_stream({"savings": a, "current": b})
    return _drain(merged.select("product", "id", "account_id", "amount"), "multi")


def src_segments(spark, sf):
    """Two topics of three partitions as one stream of bounded micro-batches, stopped between two halves of the log."""
    topics = {"orders": inputs.order_records(spark, sf), "events": inputs.event_records(spark, sf)}
    records = [
        rows.select("value", "offset", F.lit(name).alias("topic"), F.pmod("offset", F.lit(3)).alias("partition"))
        for name, rows in topics.items()
    ]
    records = records[0].unionByName(records[1]).withColumn("timestamp", F.timestamp_seconds("offset"))
    newest = {r["topic"]: r["newest"] for r in records.groupBy("topic").agg(F.max("offset").alias("newest")).collect()}
    halves = [F.when(F.col("topic") == topic, newest.get(topic, 0) // 2) for topic in topics]
    early = F.col("offset") < F.coalesce(*halves)
    log, path = new_path(spark, "log"), new_path(spark, "from-log")
    limit = str(max(1, sum(newest.values()) // 6))
    for half in (early, ~early):
        segments.write_segments(records.where(half), log)
        stream = cdc_stream(spark, segments.NAME, log, maxOffsetsPerTrigger=limit)
        query = (
            stream.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", f"{path}-checkpoint")
            .trigger(processingTime="0 seconds")
            .start()
        )
        query.processAllAvailable()
        query.stop()
    read = spark.read.schema(stream.schema).parquet(path)
    a = parse.transactions(read.where("topic = 'orders'"), parse.TENANT_A)[0]
    b = parse.transactions(read.where("topic = 'events'"), parse.TENANT_B)[0]
    merged = multi_stream({"savings": a.withColumn("account_id", F.col("account_id").cast("string")), "current": b})
    return merged.select("product", "id", "account_id", "amount", F.unix_seconds("broker_time").alias("broker_second"))


def micro_batch(spark, sf):
    """Rows of each micro-batch, appended to a table as they come."""
    records = inputs.event_records(spark, sf)
    width = _files(records.count() // 4)
    folder = inputs.files(records.repartition(4 * width, "offset"), "event-records")
    table = EpochTable(new_path(spark, "micro-batches"), schemas.canonical(schemas.StringType))

    def write(batch, epoch):
        table.write(parse.transactions(batch, parse.TENANT_B)[0], epoch)

    stream = cdc_stream(spark, "json", folder, maxFilesPerTrigger=str(width))
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{table.path}-checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return table.read(spark).select("id", "account_id", "amount")


def foreach_batch(spark, sf):
    """Each micro-batch adds its counts per account; the table sums to the counts of all events."""
    records = inputs.event_records(spark, sf)
    width = _files(records.count() // 3)
    folder = inputs.files(records.repartition(3 * width, "offset"), "event-records")
    schema = spark.createDataFrame([], "account_id string, n long").schema
    table = EpochTable(new_path(spark, "counts"), schema)

    def count(batch, epoch):
        rows = parse.transactions(batch, parse.TENANT_B)[0]
        table.write(rows.groupBy("account_id").agg(F.count(F.lit(1)).alias("n")), epoch)

    query = (
        cdc_stream(spark, "json", folder, maxFilesPerTrigger=str(width))
        .writeStream.foreachBatch(count)
        .option("checkpointLocation", f"{table.path}-checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return table.read(spark).groupBy("account_id").agg(F.sum("n").alias("n"))


def sink_index(spark, sf):
    """Scored rows of two micro-batches, the second one written twice."""
    inserts, _ = parse.transactions(inputs.order_records(spark, sf), parse.TENANT_A)
    known, _ = parse.accounts(inputs.account_records_a(spark, sf), parse.TENANT_A)
    resolved, _ = accounts.join_account(inserts, accounts.latest_accounts(known))
    rows = parse.project_scored(label(resolved, None), parse.TENANT_A)
    table = EpochTable(new_path(spark, "scored"), parse.TENANT_A.scored)
    write_index(rows.where("type = 'DEBIT'"), None, table.schema, table, 0)
    for _ in range(2):
        write_index(rows.where("type = 'CREDIT'"), None, table.schema, table, 1)
    return table.read(spark)


def sink_console(spark, sf):
    """How many records a stream printed."""
    folder = inputs.files(inputs.order_records(spark, sf), "order-records")
    query = notify.show_stream(cdc_stream(spark, "json", folder), f"{folder}-checkpoint", availableNow=True)
    query.awaitTermination()
    n = sum(p["numInputRows"] for p in query.recentProgress)
    return spark.createDataFrame([(n,)], "n long")


def sink_schema(spark, sf):
    path = new_path(spark, "typed")
    target = "id bigint, amount double, day date"
    schema = spark.createDataFrame([], target).schema
    create_target(spark, schema, path)
    rows = inputs.orders(spark, sf).select(F.col("amount").cast("string").alias("amount"), "id", F.to_date("ts").alias("day"))
    conform(rows, schema).write.mode("append").parquet(path)
    create_target(spark, schema, path)
    return spark.read.schema(schema).parquet(path)


def sink_notify(spark, sf):
    path = new_path(spark, "messages")
    rows = inputs.orders(spark, sf).select(F.concat(F.lit("order "), F.col("id"), F.lit(" is "), F.col("status")).alias("text"))
    notify.send(rows, "text", "text", path)
    return spark.read.text(path)


def sink_committed(spark, sf):
    """Messages of four micro-batches; the last one is published, forgotten by the stream and tried again."""
    records = inputs.order_records(spark, sf)
    width = _files(records.count() // 4)
    folder = inputs.files(records.repartition(4 * width, "offset"), "order-records")
    path = new_path(spark, "messages")
    rows = parse.transactions(cdc_stream(spark, "json", folder, maxFilesPerTrigger=str(width)), parse.TENANT_A)[0]
    rows = rows.select("id", F.concat(F.lit("order "), F.col("id"), F.lit(" is "), F.col("op_type")).alias("text"))
    for attempt in range(2):
        query = notify.send_stream(rows, "id", "text", path, f"{path}-checkpoint", availableNow=True)
        query.awaitTermination()
        if not attempt:
            last = query.lastProgress["batchId"]
            fs, mark = EpochTable._file(spark, f"{path}-checkpoint/commits/{last}")
            fs.delete(mark, False)
    schema = spark.createDataFrame([], "id long, value string").schema
    return committed.committed(spark, path, schema)


def history_upsert(spark, sf):
    """The second micro-batch brings the later half and repeats part of the first, and is retried."""
    rows = inputs.events(spark, sf).withColumn("event_day", F.to_date("ts")).withColumns(
        {"partition": F.lit(0), "offset": F.col("id")}
    )
    first = rows.where("ts < '2024-01-16'")
    second = rows.where("ts >= '2024-01-16'").unionByName(first.where("op_type = 'click'"))
    table = EpochTable(new_path(spark, "history"), schemas.history(), ("event_day",))
    known = KnownIds(new_path(spark, "known"))
    for epoch, batch in ((0, first), (1, second), (1, second)):
        table.write(known.unseen(dedupe.dedupe_transactions(batch), before=epoch), epoch)
        known.add(table.read(spark, only=epoch), epoch)
    return table.read(spark).select("id", "account_id", "amount")


def known_ids(spark, sf):
    """Every event asked for, after three micro-batches of which two are merged."""
    rows = inputs.events(spark, sf).withColumn("event_day", F.to_date("ts"))
    borders = [F.lit(d).cast("timestamp") for d in ("2024-01-06", "2024-01-11", "2024-01-16")]
    part = materialize(rows.withColumn("part", sum((F.col("ts") >= b).cast("int") for b in borders)), "parts")
    known = KnownIds(new_path(spark, "known"))
    for epoch in range(3):
        known.add(part.where(F.col("part") == epoch), epoch)
        if epoch == 1:
            known.compact(spark, 2)
    unknown = known.unseen(rows.select("id")).withColumn("known", F.lit(False))
    unknown = unknown.hint("merge")
    return rows.select("id").join(unknown, "id", "left").select("id", F.coalesce("known", F.lit(True)).alias("known"))


def _versions_by_year(spark, sf):
    versions = inputs.account_versions(spark, sf)
    year = F.year("seen_at")
    return [versions.where(c) for c in (year < 1997, year.between(1997, 1998), year > 1998)]


def dedupe_stream(spark, sf):
    """Three micro-batches; the second repeats records of itself, and the third many of the first two."""
    records = inputs.event_records(spark, sf).withColumn("topic", F.lit("events"))
    part = F.pmod("offset", F.lit(3))
    again = records.where("offset % 2 = 0").withColumn("offset", F.col("offset") + 10**9)
    batches = [records.where(part == 0), records.where(part == 1), records.where(part == 2)]
    batches = [batches[0], batches[1].unionByName(batches[1]), batches[2].unionByName(again)]
    width = _files(records.count())
    folder = new_path(spark, "event-records")
    for rows in batches:
        rows.repartition(width, "offset").write.mode("append").json(folder)
    stream = dedupe.without_repeats(cdc_stream(spark, "json", folder, maxFilesPerTrigger=str(width)), "1 hour")
    return _drain(parse.transactions(stream, parse.TENANT_B)[0].select("id", "account_id", "amount"), "single")


def account_upsert(spark, sf):
    """Versions arrive by date in three micro-batches, one of them twice; the last seen wins."""
    parts = _versions_by_year(spark, sf)
    table = BucketedTable(new_path(spark, "accounts"), schemas.account_dimension(), key="account_id", buckets=8)
    for epoch in (0, 1, 1, 2):
        if epoch == 2:
            table.compact(spark, 2, accounts.latest_accounts)
        table.write(accounts.latest_accounts(parts[epoch]), epoch)
    return accounts.latest_accounts(table.read(spark)).select("account_id", "customer_id", "account_type")


def account_state(spark, sf):
    """The accounts of finished orders, looked up in buckets that doubled and were merged again."""
    table = BucketedTable(
        new_path(spark, "accounts"), schemas.account_dimension(), key="account_id", buckets=2, bucket_rows=1000
    )
    for epoch, part in enumerate(_versions_by_year(spark, sf)):
        table.write(accounts.latest_accounts(part), epoch)
        table.compact(spark, epoch + 1, accounts.latest_accounts)
    keys = inputs.orders(spark, sf).where("status = 'F'")
    return accounts.latest_accounts(table.lookup(keys)).select("account_id", "customer_id", "account_type")


def score_batch(spark, sf):
    """All orders scored at once; each row carries the features the model would see."""
    records = inputs.order_records(spark, sf), inputs.account_records_a(spark, sf)
    outcome = score_backfill(*records, parse.TENANT_A, inputs.rule_model())
    return outcome.scored.select("id", "is_fraud", *schemas.FEATURES)


def _scored_stream(spark, sf):
    """Events as tenant B in four micro-batches that follow event order, after their accounts."""
    tables = Tables(new_path(spark, "deployment"), parse.TENANT_B)
    folder = inputs.files(inputs.account_records_b(spark, sf), "account-records")
    AccountJob(tables, parse.TENANT_B).start(cdc_stream(spark, "json", folder), availableNow=True).awaitTermination()

    records = inputs.event_records(spark, sf)
    borders = [F.lit(d).cast("timestamp") for d in ("2024-01-08", "2024-01-16 12:00:00", "2024-01-24")]
    times = inputs.events(spark, sf).select(F.col("id").alias("offset"), "ts").hint("merge")
    stamped = records.join(times, "offset")
    stamped = materialize(stamped, "stamped")
    part = sum((F.col("ts") >= b).cast("int") for b in borders)
    folder = new_path(spark, "event-records")
    width = _files(max(r[1] for r in stamped.groupBy(part).count().collect()))
    for i in range(4):
        rows = stamped.where(part == i).select("value", "partition", "offset")
        rows.repartition(width, "offset").write.mode("append").json(folder)
    job = ScoringJob(tables, parse.TENANT_B, inputs.rule_model(), recipient="desk@example.org", signature="The bank")
    stream = cdc_stream(spark, "json", folder, maxFilesPerTrigger=str(width))
    job.start(stream, availableNow=True).awaitTermination()
    return tables


def stream_equals_batch(spark, sf):
    """The output rows of the streaming job."""
    return _scored_stream(spark, sf).scored.read(spark)


def score_stream(spark, sf):
    """What the streaming job's model saw of every event, its label, and whether an alert was written."""
    tables = _scored_stream(spark, sf)
    alerts = tables.alerts.read(spark).select("id", F.lit(True).alias("alerted"))
    rows = tables.features.read(spark).join(alerts, "id", "left")
    return rows.withColumn("alerted", F.coalesce("alerted", F.lit(False)))


QUERIES = {
    "src_cdc_stream": src_cdc_stream,
    "src_multi_stream": src_multi_stream,
    "src_segments": src_segments,
    "micro_batch": micro_batch,
    "foreach_batch": foreach_batch,
    "sink_index": sink_index,
    "sink_console": sink_console,
    "sink_schema": sink_schema,
    "sink_notify": sink_notify,
    "sink_committed": sink_committed,
    "history_upsert": history_upsert,
    "account_upsert": account_upsert,
    "account_state": account_state,
    "dedupe_stream": dedupe_stream,
    "known_ids": known_ids,
    "score_batch": score_batch,
    "stream_equals_batch": stream_equals_batch,
    "score_stream": score_stream,
}

_LABEL = f"CASE WHEN {inputs.RULE} THEN 'fraudulent' ELSE 'valid' END"

ORACLE = {
    "src_cdc_stream": """
        SELECT o_orderkey AS id, o_custkey AS account_id, o_totalprice AS amount,
               CASE WHEN o_orderstatus = 'F' THEN 'DEBIT' ELSE 'CREDIT' END AS op_type
        FROM orders WHERE o_orderstatus <> 'P'""",
    "src_multi_stream": """
        SELECT 'savings' AS product, o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS account_id, o_totalprice AS amount
        FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL SELECT 'current', event_id, 'U' || user_id, value FROM events""",
    "src_segments": """
        SELECT 'savings' AS product, o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS account_id, o_totalprice AS amount,
               o_orderkey AS broker_second
        FROM orders WHERE o_orderstatus <> 'P'
        UNION ALL SELECT 'current', event_id, 'U' || user_id, value, event_id FROM events""",
    "micro_batch": "SELECT event_id AS id, 'U' || user_id AS account_id, value AS amount FROM events",
    "foreach_batch": "SELECT 'U' || user_id AS account_id, COUNT(*) AS n FROM events GROUP BY 1",
    "sink_index": """
        SELECT o_custkey AS "account-id", o_totalprice AS amount, o_custkey // 3 AS "customer-id",
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS datetime, 'valid' AS is_fraud, o_orderkey AS "transaction-id",
               CASE WHEN o_orderstatus = 'F' THEN 'DEBIT' ELSE 'CREDIT' END AS type,
               strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') AS "@timestamp"
        FROM orders WHERE o_orderstatus <> 'P'""",
    "sink_console": "SELECT COUNT(*) AS n FROM orders",
    "sink_schema": "SELECT o_orderkey AS id, o_totalprice AS amount, CAST(o_orderdate AS DATE) AS day FROM orders",
    "sink_notify": """
        SELECT '{"message":"order ' || o_orderkey || ' is ' || o_orderstatus || '"}' AS value FROM orders""",
    "sink_committed": """
        SELECT o_orderkey AS id, '{"message":"order ' || o_orderkey || ' is '
               || CASE WHEN o_orderstatus = 'F' THEN 'DEBIT' ELSE 'CREDIT' END || '"}' AS value
        FROM orders WHERE o_orderstatus <> 'P'""",
    "history_upsert": "SELECT event_id AS id, user_id AS account_id, value AS amount FROM events",
    "account_upsert": """
        SELECT account_id, customer_id, account_type FROM (
            SELECT o_custkey AS account_id, o_orderkey // 7 AS customer_id, o_orderpriority AS account_type,
                   row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1""",
    "account_state": """
        SELECT account_id, customer_id, account_type FROM (
            SELECT o_custkey AS account_id, o_orderkey // 7 AS customer_id, o_orderpriority AS account_type,
                   row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
        WHERE r = 1 AND account_id IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""",
    "dedupe_stream": "SELECT event_id AS id, 'U' || user_id AS account_id, value AS amount FROM events",
    "known_ids": "SELECT event_id AS id, ts < TIMESTAMP '2024-01-16' AS known FROM events",
    "score_batch": f"SELECT *, {_LABEL} AS is_fraud FROM ({featured_sql('inserts')})",
    "score_stream": f"""
        SELECT *, FALSE AS incomplete, {_LABEL} AS is_fraud, {inputs.RULE} AS alerted FROM ({featured_sql('known_events')})""",
    "stream_equals_batch": f"""
        SELECT 'U' || user_id AS "account-id", value AS amount, c_custkey // 3 AS "Customer-id",
               strftime(ts, '%Y-%m-%d %H:%M:%S') AS "operation-date", {_LABEL} AS is_fraud,
               event_id AS "transaction-id", event_type AS type, props AS "transaction-description",
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'Saving Account' ELSE 'Current Account' END AS account_type,
               strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "@timestamp"
        FROM events JOIN customer ON user_id = c_custkey JOIN ({featured_sql("known_events")}) ON event_id = id""",
}
