"""Column helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of every contract here: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` is enough, and much faster, where every character is ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def fold(text: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(text.cast("string"), F.lit("")).cast("binary")) % folds


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def carried(df: DataFrame, *without: str) -> Column:
    """All columns but some as one struct ``_in``, so that none clashes with what an operator works with."""
    return F.struct(*[df[c] for c in df.columns if c not in without]).alias("_in")


def fresh_names(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop columns that clash with the names an operator adds; the operator's own win."""
    taken = {name.lower() for name in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])
