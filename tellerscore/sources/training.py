"""Training data in CSV files with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tellerscore.functions.text import cast_columns
from tellerscore.schemas import TRAINING


def training_csv(spark: SparkSession, path: str) -> DataFrame:
    """The feature columns and the label, found by name and cast from text; bad text becomes null.

    Files may hold the columns in any order, and others besides.
    """
    text = spark.read.option("header", True).option("inferSchema", False).csv(path)
    missing = set(TRAINING.names) - set(text.columns)
    if missing:
        raise ValueError(f"the file lacks columns: {', '.join(sorted(missing))}")
    return cast_columns(text.select(*TRAINING.names), TRAINING)
