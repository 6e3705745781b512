"""Training programs: split, fit, compare on both parts, save."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame

from tellerscore.operators import metrics, ml
from tellerscore.schemas import FEATURES, LABEL
from tellerscore.session import materialize

ESTIMATORS = {"lr": ml.logistic_regression, "svm": ml.linear_svm, "mlp": ml.perceptron}


@dataclass(frozen=True)
class Trained:
    model: Model
    train_match: float
    test_match: float
    metrics: dict[str, float]


def train(
    df: DataFrame, kind: str, keys: list[str] | None = None, path: str | None = None, share: float = 0.7
) -> Trained:
    """Fit a classifier on a feature table and report how it does on rows it has not seen.

    Rows are split by ``keys``, or by all their values where the table has no key. The assembled
    rows are written once; every iteration and metric reads them from there instead of computing
    the features again.
    """
    first = ml.in_first_part(keys or FEATURES, share).alias("_training")
    table = materialize(ml.assemble(df).select("features", LABEL, first), "training")
    training, test = table.where("_training"), table.where("NOT _training")
    model = ESTIMATORS[kind]().fit(training)
    seen, unseen = ml.summary_predictions(model, training), ml.summary_predictions(model, test)
    if path:
        ml.save(model, path)
    return Trained(
        model,
        metrics.match_percentage(seen).first()[0],
        metrics.match_percentage(unseen).first()[0],
        metrics.eval_metrics(unseen).first().asDict(),
    )
