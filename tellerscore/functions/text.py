"""Conversions between records and JSON text, and typed casts that turn bad text into nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def decode_value(records: DataFrame) -> DataFrame:
    """Broker records carry bytes; everything after works on text."""
    return records.withColumn("value", F.expr("CAST(value AS STRING)"))


def json_serialize(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))


def json_deserialize(text: Column, schema: StructType) -> Column:
    return F.from_json(text, schema)


def cast_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """Every column of ``schema``, by name; text that does not parse becomes null."""
    return df.select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )
