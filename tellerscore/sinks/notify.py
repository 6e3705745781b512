"""Notifications as JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tellerscore.functions.alerts import notification
from tellerscore.sinks import committed


def messages(df: DataFrame, text: str) -> DataFrame:
    """One ``value`` per row: the JSON message of column ``text``."""
    return df.select(notification(F.col(text)).alias("value"))


def send(df: DataFrame, text: str, fmt: str = "kafka", path: str | None = None, **options: str) -> None:
    """Publish the messages; ``fmt`` may also be a file format with a path."""
    writer = messages(df, text).write.format(fmt).options(**options).mode("append")
    writer.save(path) if path else writer.save()


def send_stream(df: DataFrame, ident: str, text: str, path: str, checkpoint: str, stream: str = "0", **trigger):
    """Publish the messages of a stream, each once, as ``ident`` and ``value`` in a committed target.

    A micro-batch that fails, or is tried again after it was published, adds nothing twice.
    """
    committed.register(df.sparkSession)
    rows = df.select(ident, notification(F.col(text)).alias("value"))
    writer = rows.writeStream.format(committed.NAME).option("path", path).option("stream", stream)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def show_stream(df: DataFrame, checkpoint: str, rows: int = 20, **trigger):
    """Print the first ``rows`` of each micro-batch.

    The console sink sends whole micro-batches to the driver. Here tasks read all rows and keep the first ones.
    """

    def show(batch: DataFrame, epoch: int) -> None:
        place = F.monotonically_increasing_id()
        first = batch.withColumn("_place", place).orderBy("_place").limit(rows).drop("_place")
        print(f"Batch: {epoch}")
        first.show(rows)

    writer = df.writeStream.foreachBatch(show).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
