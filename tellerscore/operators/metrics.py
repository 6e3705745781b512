"""Quality of predictions, each from one pass over the rows."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

METRICS = ("weightedPrecision", "weightedRecall", "accuracy", "f1")


def match_percentage(predictions: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Share of rows, in percent, whose prediction equals the label."""
    hit = F.coalesce(F.expr(f"prediction = {label}"), F.lit(False))
    return predictions.agg((F.avg(hit.cast("int")) * 100).alias("match_percentage"))


def eval_metrics(predictions: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Class-weighted precision and recall, accuracy and F1 from one confusion count.

    The same numbers as :func:`evaluate`, which scans the rows once per metric.
    """
    pairs = predictions.groupBy(
        F.col(label).cast("double").alias("label"), F.col("prediction").cast("double").alias("guess")
    ).agg(F.count(F.lit(1)).alias("n"))
    hits = F.sum(F.when(F.col("label") == F.col("guess"), F.col("n")).otherwise(0))
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("label").alias("class"), F.col("n").alias("labelled"), F.lit(0).cast("long").alias("guessed"), "label", "guess", "n"),
                F.struct(F.col("guess").alias("class"), F.lit(0).cast("long").alias("labelled"), F.col("n").alias("guessed"), F.lit(None).cast("double").alias("label"), "guess", "n"),
            )
        ).alias("side")
    ).select("side.*")
    per_class = sides.groupBy("class").agg(
        F.sum("labelled").alias("labelled"), F.sum("guessed").alias("guessed"), hits.alias("hit")
    )
    total = F.sum("labelled")
    precision = F.when(F.col("guessed") > 0, F.col("hit") / F.col("guessed")).otherwise(0.0)
    return per_class.agg(
        (F.sum(F.col("labelled") * precision) / total).alias("weightedPrecision"),
        (F.sum("hit") / total).alias("weightedRecall"),
        (F.sum("hit") / total).alias("accuracy"),
        (F.sum(F.col("labelled") * 2 * F.col("hit") / (F.col("labelled") + F.col("guessed"))) / total).alias("f1"),
    )


def evaluate(predictions: DataFrame, label: str = "is_fraud", metrics: tuple[str, ...] = METRICS) -> dict[str, float]:
    """The metrics by Spark's own evaluator."""
    evaluator = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction")
    return {m: evaluator.evaluate(predictions, {evaluator.metricName: m}) for m in metrics}
