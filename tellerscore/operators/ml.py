"""Training, saving and applying the classifiers.

The learners are Spark's own; this module fixes their settings, splits data reproducibly, and
replaces the two steps that would pull data to the driver: one-row scoring and string indexing
of columns with many values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    LinearSVC,
    LinearSVCModel,
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerscore.functions.fields import label_text
from tellerscore.operators.running import SPLIT_ROWS, GroupSizes, running_totals
from tellerscore.schemas import FEATURES, LABEL
from tellerscore.session import joinable, materialize, materialize_measured

#: A column of at most so many values is looked up by a broadcast of them.
FEW_VALUES = 10_000

MODELS = {
    "lr": LogisticRegressionModel,
    "svm": LinearSVCModel,
    "mlp": MultilayerPerceptronClassificationModel,
}


def logistic_regression(label: str = LABEL) -> LogisticRegression:
    return LogisticRegression(labelCol=label)


def linear_svm(label: str = LABEL) -> LinearSVC:
    return LinearSVC(maxIter=10, regParam=0.1, labelCol=label)


def perceptron(layers: tuple[int, ...] = (19, 32, 16, 2), seed: int = 123, label: str = LABEL) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(labelCol=label, featuresCol="features", layers=list(layers), seed=seed)


def assembler(columns: list[str] = FEATURES) -> VectorAssembler:
    """Missing values become not-a-number instead of an error or a dropped row."""
    return VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="keep")


def assemble(df: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    return assembler(columns).transform(df)


def vector_rows(df: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """The feature vectors alone, built as expressions for the whole frame at once."""
    values = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in columns]
    return df.select(array_to_vector(F.array(*values)).alias("features"))


def in_first_part(keys: list[str], share: float, seed: int = 123) -> Column:
    """True for about ``share`` of the rows, decided by each row's key columns alone.

    Unlike ``randomSplit`` the answer does not depend on partitioning, so a recomputed task puts
    every row on the side where it was before.
    """
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    digest = F.substring(F.md5(F.concat_ws(":", *parts, F.lit(str(seed)))), 1, 8)
    return F.conv(digest, 16, 10).cast("long") < int(share * 2**32)


def split(df: DataFrame, keys: list[str], share: float = 0.7, seed: int = 123) -> tuple[DataFrame, DataFrame]:
    """Training and test rows."""
    first = in_first_part(keys, share, seed)
    return df.where(first), df.where(~first)


def summary_predictions(model: Model, df: DataFrame) -> DataFrame:
    return model.evaluate(df).predictions


def score(model: Model, df: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Add ``prediction`` and ``is_fraud`` to every row of a feature frame."""
    predicted = model.transform(assemble(df, columns))
    return predicted.select(*df.columns, "prediction", label_text(F.col("prediction")).alias("is_fraud"))


def save(model: Model, path: str) -> None:
    model.write().overwrite().save(path)


def load(kind: str, path: str) -> Model:
    return MODELS[kind].load(path)


def index_values(df: DataFrame, columns: list[str], split_rows: int = SPLIT_ROWS) -> DataFrame:
    """The index of every value: (column, value, frequency, position), most frequent first.

    Ties go by value. Positions are running counts, so a column of a billion values is numbered
    by many tasks.
    """
    pairs = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
        ).alias("pair")
    ).select("pair.*")
    counted, _ = materialize_measured(
        pairs.where("value IS NOT NULL").groupBy("column", "value").agg((-F.count(F.lit(1))).alias("_rank")),
        "values",
        F.count(F.lit(1)).alias("n"),
    )
    sizes = counted.groupBy("column").agg(F.count(F.lit(1)).alias("n"))
    largest, total = sizes.agg(F.max("n"), F.sum("n")).first()
    numbered = running_totals(
        counted, ["column"], ["_rank", "value"], F.lit(1), GroupSizes(sizes, largest or 0, total or 0), split_rows
    )
    return numbered.select(
        "column",
        "value",
        (-F.col("_rank")).alias("frequency"),
        (F.col("run_n") - 1).cast("double").alias("position"),
    )


def apply_index(df: DataFrame, index: DataFrame, columns: list[str], few: int = FEW_VALUES) -> DataFrame:
    """Add ``<column>_index``; a null or a value without an index gets the number of values.

    Columns of at most ``few`` values, which come a hundred times each and more, are looked up where the rows
    are. Those of the others are melted to (row, column, value), joined with the index once, and regrouped, so
    there are as many shuffles for one such column as for a hundred. The row itself stays behind and meets its
    positions at the end. Values that many rows share are split by adaptive execution, like any skewed join key.
    """
    if not columns:
        return df
    measured = index.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.sum("frequency").alias("rows")).collect()
    sizes = {r["column"]: r["n"] for r in measured}
    repeated = {r["column"] for r in measured if r["n"] <= few and r["n"] * 100 <= r["rows"]}
    short = [c for c in columns if c in repeated]
    long = [c for c in columns if c not in repeated]
    carried = F.struct(*[df[c] for c in df.columns if c not in {f"{c}_index" for c in columns}])
    rows = df.select(F.monotonically_increasing_id().alias("_row"), carried.alias("_in"))
    rows = materialize(_looked_up(rows, index, short), "rows")
    if long:
        rows = rows.join(_positions(rows, index, long, sum(sizes.get(c, 0) for c in long)), "_row", "left")
    found = [F.coalesce(F.col(f"_{c}"), F.lit(float(sizes.get(c, 0)))).alias(f"{c}_index") for c in columns]
    return rows.select("_in.*", *found)


def _looked_up(rows: DataFrame, index: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with ``_<column>``, the value's position or null, for columns of few values."""
    if not columns:
        return rows
    known = materialize(index.where(F.col("column").isin(columns)), "short-index")
    for c in columns:
        own = known.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("position").alias(f"_{c}"))
        rows = rows.join(F.broadcast(own), F.col("_in")[c].cast("string") == F.col("_value"), "left").drop("_value")
    return rows


def _positions(rows: DataFrame, index: DataFrame, columns: list[str], values: int) -> DataFrame:
    """For each ``_row`` with a known value in any of ``columns``, ``_<column>``, the value's position or null.

    Cells are dealt by row before they are regrouped: until then, hardly two of a task belong to one row.
    """
    cells = [F.struct(F.lit(at).alias("at"), F.col("_in")[c].cast("string").alias("value")) for at, c in enumerate(columns)]
    melted = rows.select("_row", F.inline(F.array(*cells))).where("value IS NOT NULL")
    at = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column")).cast("int") - 1
    known = index.where(F.col("column").isin(columns)).select("value", at.alias("at"), "position")
    joined = melted.join(joinable(known, values), ["value", "at"]).select("_row", "at", "position")
    found = [F.max(F.when(F.col("at") == at, F.col("position"))).alias(f"_{c}") for at, c in enumerate(columns)]
    return materialize(joined, "cells").repartition("_row").groupBy("_row").agg(*found)


def repeating(df: DataFrame, columns: list[str], most: int = 100) -> list[str]:
    """The columns of at most about ``most`` different values; positions of values that never come again say nothing."""
    found = df.agg(*[F.approx_count_distinct(F.col(c)).alias(c) for c in columns]).first()
    return [c for c in columns if found[c] <= most]


def scales_of(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and standard deviation of each column; nulls do not count, a constant column is only shifted."""
    if not columns:
        return {}
    found = df.agg(*[f(F.col(c).cast("double")).alias(f"{c}_{f.__name__}") for c in columns for f in (F.avg, F.stddev_pop)]).first()
    return {c: (found[f"{c}_avg"] or 0.0, found[f"{c}_stddev_pop"] or 1.0) for c in columns}


@dataclass(frozen=True)
class IndexedModel:
    """A classifier of value indexes: the indexes of the label and the features, and the model itself.

    Columns with a scale enter as standardised numbers instead, a missing one as the mean.
    """

    index: DataFrame
    model: Model
    columns: tuple[str, ...]
    label: str
    scales: dict[str, tuple[float, float]]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``label``, the index of the label column where there is one, and ``prediction``."""
        predicted = self.model.transform(_vectors(df, self.index, self.columns, self.label, self.scales))
        kept = [F.col(f"{self.label}_index").alias("label")] if self.label in df.columns else []
        return predicted.select(*df.columns, *kept, "prediction")

    def save(self, path: str) -> None:
        save(self.model, f"{path}/model")
        self.index.write.mode("overwrite").parquet(f"{path}/index")
        rows = [(c, *scale) for c, scale in self.scales.items()]
        self.index.sparkSession.createDataFrame(rows, _SCALES).write.mode("overwrite").parquet(f"{path}/scales")


_SCALES = "column string, mean double, deviation double"


def _vectors(df: DataFrame, index: DataFrame, columns: tuple[str, ...], label: str, scales: dict) -> DataFrame:
    """``df`` with the label's index, where it has the label, and the feature vector."""
    indexed = [c for c in columns if c not in scales]
    found = apply_index(df, index, [*indexed, label] if label in df.columns else indexed)
    standard = {
        f"{c}_index": F.coalesce((F.col(c).cast("double") - mean) / deviation, F.lit(0.0))
        for c, (mean, deviation) in scales.items()
    }
    return assembler([f"{c}_index" for c in columns]).transform(found.withColumns(standard) if standard else found)


def load_indexed(spark: SparkSession, kind: str, path: str, columns: list[str] = FEATURES, label: str = LABEL) -> IndexedModel:
    scales = {r["column"]: (r["mean"], r["deviation"]) for r in spark.read.parquet(f"{path}/scales").collect()}
    return IndexedModel(spark.read.parquet(f"{path}/index"), load(kind, f"{path}/model"), tuple(columns), label, scales)


def fit_indexed(
    df: DataFrame,
    classifier: Estimator | None = None,
    columns: list[str] = FEATURES,
    label: str = LABEL,
    scaled: list[str] = (),
) -> IndexedModel:
    """Index the label and every feature but the ``scaled`` ones, and fit a classifier.

    The index is a table, whatever the number of values; none of it passes through the driver. With nothing
    scaled, continuous columns are indexed too: such a model knows the rows it was trained on, and little of
    others, whose values all count as unseen.
    """
    scales = scales_of(df, [c for c in columns if c in scaled])
    index = materialize(index_values(df, [c for c in [*columns, label] if c not in scales]), "index")
    vectors = _vectors(df, index, tuple(columns), label, scales)
    table = materialize(vectors.select("features", F.col(f"{label}_index").alias("label")), "indexed")
    model = (classifier or perceptron((len(columns), 10, 5, 2), 42, "label")).fit(table)
    return IndexedModel(index, model, tuple(columns), label, scales)
