"""Change-event sources.

A broker and a folder of JSON-lines files give the same columns: ``value``, ``partition``, ``offset``, and
``topic`` and ``broker_time``, which files may lack. Time, then position, decide which copy of a record is the
last one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerscore.functions.text import decode_value
from tellerscore.schemas import BROKER_RECORD
from tellerscore.sources import segments


def cdc_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """A stream of change events.

    For ``kafka`` pass ``kafka.bootstrap.servers`` and ``subscribe`` (several topics, comma
    separated, make one stream). For files pass ``path``; their records carry the columns of
    ``CDC_RECORD``, or all of ``BROKER_RECORD``. For ``segments`` pass ``path`` and the options of
    :mod:`tellerscore.sources.segments`.
    """
    if fmt == segments.NAME:
        segments.register(spark)
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "kafka":
        reader = reader.schema(BROKER_RECORD)
    return _record_columns(reader.load(path) if path else reader.load())


def _record_columns(records: DataFrame) -> DataFrame:
    named = decode_value(records).withColumnRenamed("timestamp", "broker_time")
    return named.select("value", "partition", "offset", "topic", "broker_time")


def multi_stream(streams: dict[str, DataFrame]) -> DataFrame:
    """Several parsed feeds as one, told apart by a ``product`` column."""
    named = [df.withColumn("product", F.lit(product)) for product, df in streams.items()]
    return reduce(DataFrame.unionByName, named)
