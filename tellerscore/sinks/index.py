"""Writes of scored rows to a search index or a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tellerscore.sinks import committed
from tellerscore.streaming.tables import EpochTable

FILE_FORMATS = ("parquet", "orc", "json", "csv", "text", "avro", "xml")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the declared columns, in order and typed; a column the target lacks is an error."""
    extra = set(df.columns) - set(schema.names)
    missing = set(schema.names) - set(df.columns)
    if extra or missing:
        raise ValueError(f"columns differ from the target: extra {sorted(extra)}, missing {sorted(missing)}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def create_target(spark: SparkSession, schema: StructType, path: str, fmt: str = "parquet") -> None:
    """Create an empty typed target; leaves an existing one alone."""
    spark.createDataFrame([], schema).write.format(fmt).mode("ignore").save(path)


def write_index(
    df: DataFrame,
    fmt: str | None,
    schema: StructType,
    table: EpochTable | None = None,
    epoch: int = 0,
    id_column: str = "transaction-id",
    **options: str,
) -> None:
    """Write scored rows so that writing them again changes nothing.

    Without a format they go to ``table`` as micro-batch ``epoch``, which a repeated write replaces. With
    one they are appended through a search index's connector, where the document id does the same, or
    through the sink of :mod:`tellerscore.sinks.committed`, which keeps the first finished attempt of micro-batch
    ``epoch``. File formats know neither, so they are refused.
    """
    rows = conform(df, schema)
    if fmt is None:
        table.write(rows, epoch)
        return
    if fmt in FILE_FORMATS:
        raise ValueError(f"{fmt} would repeat rows that are written again; write to a table instead")
    if fmt == committed.NAME:
        committed.register(rows.sparkSession)
        settings = {"batch": str(epoch), **options}
    else:
        settings = {"es.mapping.id": id_column, **options}
    rows.write.format(fmt).options(**settings).mode("append").save()
