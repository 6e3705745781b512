"""The stream over segment files with offsets per partition."""

import datetime

import pytest
from pyspark.sql import functions as F

from tellerscore.session import new_path
from tellerscore.sources import segments
from tellerscore.sources.cdc import cdc_stream
from tellerscore.streaming.tables import EpochTable

RECORDS = "topic string, partition int, offset long, timestamp timestamp, value string"


def records(topic, partition, first, end, step=1):
    time = datetime.datetime(2024, 1, 1, 12)
    return [(topic, partition, n, time + datetime.timedelta(seconds=n), f"{topic}-{partition}-{n}") for n in range(first, end, step)]


def run(spark, log, path, **options):
    """Run to the end of the log; return the rows of each micro-batch of this run."""
    stream = cdc_stream(spark, segments.NAME, log, **options)
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-checkpoint")
    query = writer.trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
        return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    finally:
        query.stop()


def stored(spark, path):
    rows = spark.read.parquet(path).collect()
    return sorted((r.topic, r.partition, r.offset, r.broker_time, r.value) for r in rows)


def write(spark, log, rows):
    segments.write_segments(spark.createDataFrame(rows, RECORDS), log)


def test_advance():
    assert segments.advance({}, {"a/0": 10, "b/0": 30}, None) == {"a/0": 10, "b/0": 30}
    assert segments.advance({"a/0": 4}, {"a/0": 10, "b/0": 30}, 12) == {"a/0": 6, "b/0": 10}
    assert segments.advance({"a/0": 10, "b/0": 29}, {"a/0": 10, "b/0": 30}, 5) == {"a/0": 10, "b/0": 30}
    assert segments.advance({"b/0": 5}, {"a/0": 1000, "b/0": 6}, 5) == {"a/0": 4, "b/0": 6}  # at least one each


def test_bounded_micro_batches_and_restarts(spark):
    log, path = new_path(spark, "log"), new_path(spark, "out")
    options = {"maxOffsetsPerTrigger": "40", "offsetsPerTask": "7"}
    first = records("a", 0, 0, 90) + records("a", 1, 5, 60, 5) + records("b", 0, 100, 101)
    write(spark, log, first)
    sizes = run(spark, log, path, **options)
    assert stored(spark, path) == sorted(first) and len(sizes) >= 4 and max(sizes) <= 42
    assert run(spark, log, path, **options) == []
    second = records("a", 0, 90, 150) + records("c", 2, 0, 3)
    write(spark, log, second)
    assert max(run(spark, log, path, **options)) <= 42
    assert stored(spark, path) == sorted(first + second)


def test_a_micro_batch_is_replayed(spark):
    log, path = new_path(spark, "log"), new_path(spark, "out")
    options = {"maxOffsetsPerTrigger": "25"}
    rows = records("a", 0, 0, 100)
    write(spark, log, rows)
    sizes = run(spark, log, path, **options)
    fs, mark = EpochTable._file(spark, f"{path}-checkpoint/commits/{len(sizes) - 1}")
    assert fs.delete(mark, False)  # as if the stream had died before it noted its last micro-batch
    write(spark, log, records("a", 0, 100, 130))
    run(spark, log, path, **options)
    assert stored(spark, path) == sorted(rows + records("a", 0, 100, 130))


def test_a_lost_log_is_an_error(spark):
    log, path = new_path(spark, "log"), new_path(spark, "out")
    write(spark, log, records("a", 0, 0, 60))
    run(spark, log, path)
    shorter = new_path(spark, "log")
    write(spark, shorter, records("a", 0, 0, 40))
    reader = segments._Reader(segments.BROKER_RECORD, {"path": shorter})
    assert reader.partitions({"a/0": 60}, {"a/0": 60}) == []  # how a restart begins
    assert reader.latestOffset() == {"a/0": 60}
    with pytest.raises(ValueError, match="behind the checkpoint"):
        reader.partitions({"a/0": 60}, {"a/0": 40})
    run(spark, shorter, path)
    assert len(stored(spark, path)) == 60


def test_topics_without_limit(spark):
    log, path = new_path(spark, "log"), new_path(spark, "out")
    write(spark, log, records("a", 0, 0, 20) + records("b", 0, 0, 20) + records("c", 1, 0, 5))
    assert run(spark, log, path, topics="a, c") == [25]
    assert {r.topic for r in spark.read.parquet(path).select(F.col("topic")).collect()} == {"a", "c"}
    write(spark, log, records("c", 1, 5, 9))
    assert run(spark, log, path, topics="a, c") == [4]
