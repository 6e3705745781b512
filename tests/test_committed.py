"""The sink that publishes micro-batches as a whole and once."""

import pytest
from pyspark.sql import functions as F

from tellerscore.operators import parse
from tellerscore.session import new_path
from tellerscore.sinks import committed
from tellerscore.sinks.index import write_index
from tellerscore.streaming.jobs import AccountJob, ScoringJob, Tables
from tellerscore.streaming.tables import EpochTable
from tests.records import account_a, records, transaction_a

ROWS = "id long, text string"


def schema(spark):
    return spark.createDataFrame([], ROWS).schema


def add(spark, folder, rows):
    spark.createDataFrame(rows, ROWS).repartition(2).write.mode("append").parquet(folder)


def run(spark, folder, path, change=lambda df: df, **options):
    committed.register(spark)
    rows = change(spark.readStream.schema(ROWS).parquet(folder))
    writer = rows.writeStream.format(committed.NAME).options(path=path, checkpointLocation=f"{path}-checkpoint", **options)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stored(spark, path, **options):
    return sorted((r.id, r.text) for r in committed.committed(spark, path, schema(spark), **options).collect())


def files(spark, path):
    """Files in the folder, and those that manifests name."""
    fs, folder = EpochTable._file(spark, f"{path}/data")
    there = {f.getPath().getName() for f in fs.listStatus(folder) if f.getPath().getName().endswith(".parquet")}
    named = [r.file for r in spark.read.schema("file string").json(f"{path}/manifests").collect()]
    assert len(named) == len(set(named))
    return there, set(named)


def test_a_repeated_micro_batch_adds_nothing(spark):
    folder, path = new_path(spark, "in"), new_path(spark, "out")
    rows = [(i, f"t{i}") for i in range(50)] + [(None, None)]
    add(spark, folder, rows[:30])
    run(spark, folder, path)
    add(spark, folder, rows[30:])
    last = run(spark, folder, path).lastProgress["batchId"]
    before = files(spark, path)
    fs, mark = EpochTable._file(spark, f"{path}-checkpoint/commits/{last}")
    assert fs.delete(mark, False)  # as if the driver had died between both commits
    run(spark, folder, path)
    assert files(spark, path) == before and before[0] == before[1]
    found = committed.committed(spark, path, schema(spark)).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, spark.createDataFrame(rows, ROWS).collect()))


def test_a_failed_micro_batch_leaves_nothing(spark):
    folder, path = new_path(spark, "in"), new_path(spark, "out")
    add(spark, folder, [(i, "a") for i in range(20)])
    run(spark, folder, path)
    add(spark, folder, [(i, "b") for i in range(20, 60)])
    broken = F.when(F.col("id") == 45, F.raise_error(F.lit("broken"))).otherwise(F.col("text"))
    with pytest.raises(Exception, match="broken"):
        run(spark, folder, path, lambda df: df.withColumn("text", broken.cast("string")))
    assert stored(spark, path) == [(i, "a") for i in range(20)]
    run(spark, folder, path)
    assert stored(spark, path) == [(i, "a" if i < 20 else "b") for i in range(60)]


def test_the_last_row_of_an_id(spark):
    folder, path = new_path(spark, "in"), new_path(spark, "out")
    add(spark, folder, [(1, "z"), (2, "b")])
    run(spark, folder, path, stream="2024")
    add(spark, folder, [(1, "a"), (3, "c"), (3, "d")])
    run(spark, folder, path, stream="2024")
    assert stored(spark, path, id_column="id") == [(1, "a"), (2, "b"), (3, "d")]
    again = new_path(spark, "in")
    add(spark, again, [(2, "a")])
    committed.register(spark)
    writer = spark.readStream.schema(ROWS).parquet(again).writeStream.format(committed.NAME)
    writer = writer.options(path=path, checkpointLocation=new_path(spark, "checkpoint"), stream="2025")
    writer.trigger(availableNow=True).start().awaitTermination()  # counts from 0 again
    assert stored(spark, path, id_column="id") == [(1, "a"), (2, "a"), (3, "d")]


def test_batch_writes(spark):
    path = new_path(spark, "out")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], ROWS)
    for epoch in (0, 1, 1):
        write_index(rows.withColumn("id", F.col("id") + 10 * epoch), committed.NAME, rows.schema, epoch=epoch, path=path)
    assert stored(spark, path) == [(1, "a"), (2, "b"), (11, "a"), (12, "b")]
    write_index(rows.limit(0), committed.NAME, rows.schema, epoch=2, path=path)
    assert len(stored(spark, path)) == 4
    for bad in ({"path": path}, {"path": path, "batch": "3", "stream": "a/b"}):
        with pytest.raises(Exception, match="batch|stream"):
            rows.write.format(committed.NAME).options(**bad).mode("append").save()


def test_nothing_published(spark):
    folder, path = new_path(spark, "in"), new_path(spark, "out")
    spark.createDataFrame([], ROWS).write.parquet(folder)
    run(spark, folder, path)
    assert stored(spark, path) == []


def test_the_scoring_job_publishes_each_transaction_once(spark):
    tables, path = Tables(new_path(spark, "deployment"), parse.TENANT_A), new_path(spark, "out")
    AccountJob(tables, parse.TENANT_A).process(records(spark, [account_a(10, 1)]), 0)
    job = ScoringJob(tables, parse.TENANT_A, index_format=committed.NAME, index_options={"path": path})
    first = records(spark, [transaction_a(i, 10, 10**6, 1_704_067_200_000) for i in (1, 2)])
    for batch, epoch in ((first, 0), (first, 0), (records(spark, [transaction_a(3, 10, 10**6, 1_704_067_200_000)], 2), 1)):
        job.process(batch, epoch)
    found = committed.committed(spark, path, parse.TENANT_A.scored)
    assert sorted(r["transaction-id"] for r in found.collect()) == [1, 2, 3]
