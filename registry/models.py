"""Machine learning operators, on the featured events."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from registry import inputs
from registry.trailing import featured_sql
from tellerscore.operators import metrics, ml
from tellerscore.plans.training import train
from tellerscore.schemas import FEATURES
from tellerscore.session import materialize, new_path

INDEXED = ["op_type", "account_id", "description", "amount"]


def ml_assemble(spark, sf):
    rows = ml.assemble(inputs.featured_events(spark, sf))
    values = vector_to_array("features")
    return rows.select("id", *[values[i].alias(n) for i, n in enumerate(FEATURES)])


def ml_vector_rows(spark, sf):
    rows = ml.vector_rows(inputs.featured_events(spark, sf)).select(vector_to_array("features").alias("v"))
    return rows.groupBy(F.col("v")[17].alias("weekend"), F.col("v")[18].alias("night")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("v")[0].cast("decimal(18,2)")).cast("double").alias("total")
    )


def ml_string_index(spark, sf):
    rows = inputs.events(spark, sf)
    index = materialize(ml.index_values(rows, INDEXED), "index")
    return ml.apply_index(rows, index, INDEXED).select("id", *[f"{c}_index" for c in INDEXED])


def ml_split(spark, sf):
    training, test = ml.split(inputs.events(spark, sf), ["id"])
    return training.select("id", F.lit("train").alias("part")).unionByName(test.select("id", F.lit("test").alias("part")))


def _linear_agrees(model, rows):
    """Is the prediction what coefficients and intercept give?"""
    terms = [F.lit(float(c)) * F.coalesce(F.col(n).cast("double"), F.lit(float("nan"))) for n, c in zip(FEATURES, model.coefficients)]
    margin = sum(terms, F.lit(float(model.intercept)))
    scored = ml.score(model, rows)
    return scored.withColumn("agrees", F.col("prediction") == (margin > 0).cast("double"))


def _linear(kind):
    """Two fits: the usual label, checked against the decision made anew in columns, and a label that
    is one of the features, which the prediction must equal."""

    def query(spark, sf):
        rows = inputs.featured_events(spark, sf)
        made = _linear_agrees(train(rows, kind, ["id"]).model, rows.drop("is_fraud")).select("id", "agrees")
        night = rows.withColumn("is_fraud", F.col("transaction_at_night"))
        scored = ml.score(train(night, kind, ["id"]).model, rows.drop("is_fraud"))
        return made.join(scored.select("id", F.col("prediction").alias("night")), "id")

    return query


def ml_mlp(spark, sf):
    """Predictions against a forward pass from the layers' weights."""
    rows = inputs.featured_events(spark, sf)
    model = train(rows, "mlp", ["id"]).model
    weights, layers = model.weights.toArray(), model.getLayers()

    @F.pandas_udf("double")
    def forward(vectors: pd.Series) -> pd.Series:
        values, at = np.stack(vectors), 0
        for size, following in zip(layers, layers[1:]):
            matrix = weights[at : at + size * following].reshape(size, following)
            at += size * following
            values = values @ matrix + weights[at : at + following]
            at += following
            if following != layers[-1]:
                values = 1 / (1 + np.exp(-values))
        return pd.Series(values.argmax(axis=1).astype(float))

    scored = ml.score(model, rows.drop("is_fraud"))
    features = F.array(*[F.col(n).cast("double") for n in FEATURES])
    return scored.select("id", (F.col("prediction") == forward(features)).alias("agrees"))


def ml_summary(spark, sf):
    """Size of each part, and whether the reported match is that of the scored rows."""
    rows = inputs.featured_events(spark, sf)
    done = train(rows, "lr", ["id"])
    scored = ml.score(done.model, rows.withColumnRenamed("is_fraud", "label"))
    part = F.when(ml.in_first_part(["id"], 0.7), "train").otherwise("test").alias("part")
    counted = scored.groupBy(part).agg(
        F.count(F.lit(1)).alias("n"), (100 * F.avg((F.col("label") == F.col("prediction")).cast("double"))).alias("match")
    )
    told = F.when(F.col("part") == "train", done.train_match).otherwise(done.test_match)
    return counted.select("part", "n", (F.abs(told - F.col("match")) < 1e-9).alias("agrees"))


def ml_score(spark, sf):
    """Metrics of scored rows against Spark's evaluator."""
    rows = inputs.featured_events(spark, sf)
    model = train(rows, "lr", ["id"]).model
    scored = ml.score(model, rows.withColumnRenamed("is_fraud", "label"))
    predictions = scored.select(F.col("label").cast("double").alias("is_fraud"), "prediction")
    own = metrics.eval_metrics(predictions).first()
    found = []
    for name in metrics.METRICS:
        evaluator = MulticlassClassificationEvaluator(labelCol="is_fraud", metricName=name)
        found.append((name, abs(evaluator.evaluate(predictions) - own[name]) < 1e-9))
    return spark.createDataFrame(found, "metric string, agrees boolean")


def ml_pipeline(spark, sf):
    """All 19 columns indexed; both parts scored by the model that was saved and loaded."""
    rows = inputs.featured_events(spark, sf)
    first = ml.in_first_part(["id"], 0.8, 42)
    path = new_path(spark, "indexed")
    ml.fit_indexed(rows.where(first)).save(path)
    scored = ml.load_indexed(spark, "mlp", path).transform(rows)
    part = F.when(first, "train").otherwise("test").alias("part")
    return scored.select("id", part, "label", F.col("prediction").isin(0.0, 1.0).alias("usable"))


def ml_pipeline_scaled(spark, sf):
    """Columns that repeat indexed, the others scaled; whether either part is predicted better than by one label."""
    rows = inputs.featured_events(spark, sf)
    first = ml.in_first_part(["id"], 0.8, 42)
    training = rows.where(first)
    indexed = ml.repeating(training, FEATURES)
    model = ml.fit_indexed(training, scaled=[c for c in FEATURES if c not in indexed])
    part = F.when(first, "train").otherwise("test").alias("part")
    share = lambda right: F.avg(right.cast("double"))
    right, ones = share(F.col("prediction") == F.col("label")), share(F.col("label") == 1)
    better = (right > F.greatest(ones, 1 - ones)).alias("better")
    return model.transform(rows).groupBy(part).agg(F.count(F.lit(1)).alias("n"), better)


def model_save(spark, sf):
    """What the saved files say, and how many events the saved weights can score."""
    path = new_path(spark, "model")
    rows = inputs.featured_events(spark, sf)
    train(rows, "lr", ["id"], path)
    saved = spark.read.json(f"{path}/metadata")
    weights = spark.read.parquet(f"{path}/data").select("numFeatures", "numClasses").first()
    n = ml.score(ml.load("lr", path), rows.drop("is_fraud")).where("prediction IN (0, 1)").count()
    return saved.select(
        "class",
        F.col("paramMap.labelCol").alias("label"),
        F.col("defaultParamMap.maxIter").alias("iterations"),
        F.lit(weights["numFeatures"]).alias("features"),
        F.lit(weights["numClasses"]).alias("classes"),
        F.lit(n).cast("long").alias("scored"),
    )


def model_load(spark, sf):
    rows = inputs.featured_events(spark, sf)
    path = new_path(spark, "model")
    model = train(rows, "lr", ["id"], path).model
    inputs_only = rows.drop("is_fraud")
    kept = ml.score(model, inputs_only).select("id", F.col("prediction").alias("kept"))
    loaded = ml.score(ml.load("lr", path), inputs_only).select("id", F.col("prediction").alias("loaded"))
    return kept.join(loaded, "id").select("id", (F.col("kept") == F.col("loaded")).alias("same"))


QUERIES = {
    "ml_assemble": ml_assemble,
    "ml_vector_rows": ml_vector_rows,
    "ml_string_index": ml_string_index,
    "ml_split": ml_split,
    "ml_lr": _linear("lr"),
    "ml_svm": _linear("svm"),
    "ml_mlp": ml_mlp,
    "ml_summary": ml_summary,
    "ml_score": ml_score,
    "ml_pipeline": ml_pipeline,
    "ml_pipeline_scaled": ml_pipeline_scaled,
    "model_save": model_save,
    "model_load": model_load,
}


def _index_sql(column, value):
    return f"""
        (SELECT event_id, position FROM events JOIN (
            SELECT {value} AS v, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, {value}) - 1 AS DOUBLE) AS position
            FROM events GROUP BY 1) ON v = {value}) AS i_{column}"""


_INDEX_VALUES = {"op_type": "event_type", "account_id": "CAST(user_id AS VARCHAR)", "description": "props", "amount": "CAST(value AS VARCHAR)"}


_NIGHT = "CAST(hour(ts) >= 22 OR hour(ts) < 6 AS DOUBLE)"


def _part(share, seed, id="event_id"):
    return (
        f"CASE WHEN CAST('0x' || substr(md5({id} || ':{seed}'), 1, 8) AS BIGINT) < {int(share * 2**32)} "
        "THEN 'train' ELSE 'test' END"
    )


ORACLE = {
    "ml_assemble": "SELECT id, " + ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in FEATURES) + f" FROM ({featured_sql('events')})",
    "ml_vector_rows": """
        SELECT CAST(isodow(ts) >= 6 AS DOUBLE) AS weekend, CAST(hour(ts) >= 22 OR hour(ts) < 6 AS DOUBLE) AS night,
               COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2""",
    "ml_string_index": "SELECT e.event_id AS id, "
    + ", ".join(f"i_{c}.position AS {c}_index" for c in INDEXED)
    + " FROM events e "
    + " ".join(f"JOIN {_index_sql(c, v)} ON i_{c}.event_id = e.event_id" for c, v in _INDEX_VALUES.items()),
    "ml_split": """
        SELECT event_id AS id, CASE WHEN CAST('0x' || substr(md5(event_id || ':123'), 1, 8) AS BIGINT) < 3006477107
                                    THEN 'train' ELSE 'test' END AS part FROM events""",
    "ml_lr": f"SELECT event_id AS id, TRUE AS agrees, {_NIGHT} AS night FROM events",
    "ml_svm": f"SELECT event_id AS id, TRUE AS agrees, {_NIGHT} AS night FROM events",
    "ml_mlp": "SELECT event_id AS id, TRUE AS agrees FROM events",
    "ml_summary": f"SELECT {_part(0.7, 123)} AS part, COUNT(*) AS n, TRUE AS agrees FROM events GROUP BY 1",
    "ml_score": "SELECT metric, TRUE AS agrees FROM (VALUES ('weightedPrecision'), ('weightedRecall'), ('accuracy'), ('f1')) t(metric)",
    "ml_pipeline": f"""
        WITH f AS (SELECT id, CAST({inputs.LABELLED} AS INT) AS y, {_part(0.8, 42, "id")} AS part FROM ({featured_sql("events")})),
             i AS (SELECT y, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, CAST(y AS VARCHAR)) - 1 AS DOUBLE) AS label
                   FROM f WHERE part = 'train' GROUP BY y)
        SELECT id, part, label, TRUE AS usable FROM f JOIN i ON f.y = i.y""",
    "ml_pipeline_scaled": f"SELECT {_part(0.8, 42)} AS part, COUNT(*) AS n, TRUE AS better FROM events GROUP BY 1",
    "model_save": """
        SELECT 'org.apache.spark.ml.classification.LogisticRegressionModel' AS class, 'is_fraud' AS label,
               CAST(100 AS BIGINT) AS iterations, CAST(19 AS INT) AS features, CAST(2 AS INT) AS classes,
               COUNT(*) AS scored FROM events""",
    "model_load": "SELECT event_id AS id, TRUE AS same FROM events",
}
