import random

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tellerscore.operators import ml
from tellerscore.plans.training import train
from tellerscore.schemas import FEATURES, LABEL, TRAINING
from tellerscore.session import materialize, new_path
from tellerscore.sources.training import training_csv



def row(amount, usual, seen, flags):
    """A row whose averages lie around ``usual`` and whose counts grow with the horizon."""
    of = {"amount": amount, "transaction_in_weekend": flags, "transaction_at_night": flags}
    return [of[n] if n in of else usual if "avrge" in n else seen + i for i, n in enumerate(FEATURES)]


# An ordinary row, a suspicious one, a more suspicious one.
SMALL, LARGE, LARGER = row(40, 44, 1, 0), row(6100, 3900, 6, 1), row(9800, 3900, 6, 1)


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        fraud = rng.random() < 0.3
        base = LARGE if fraud else SMALL
        noisy = [float(v * rng.uniform(0.5, 1.5)) if "avrge" in n or n == "amount" else v for n, v in zip(FEATURES, base)]
        rows.append((i, *noisy, int(fraud != (rng.random() < 0.02))))
    from pyspark.sql.types import LongType, StructField, StructType

    return spark.createDataFrame(rows, StructType([StructField("id", LongType()), *TRAINING.fields])).cache()


@pytest.mark.parametrize("kind", ["lr", "svm", "mlp"])
def test_train_save_load_score(spark, table, kind):
    path = new_path(spark, kind)
    done = train(table, kind, ["id"], path)
    assert done.train_match > 90 and done.test_match > 85
    assert done.metrics["accuracy"] == pytest.approx(done.test_match / 100)
    rows = spark.createDataFrame([[float(v) for v in r] for r in (SMALL, LARGE, LARGER)], FEATURES)
    scored = ml.score(ml.load(kind, path), rows).orderBy("amount").collect()
    assert [r.is_fraud for r in scored] == ["valid", "fraudulent", "fraudulent"]


def test_missing_values_are_kept_and_scored_valid(spark, table):
    model = train(table, "lr", ["id"]).model
    rows = table.drop(LABEL).limit(3).withColumn("customer_id_avrge_amount_1day", F.lit(None).cast("double"))
    scored = ml.score(model, rows).collect()
    assert len(scored) == 3 and {r.prediction for r in scored} == {0.0}


def test_vectors_are_in_feature_order(spark, table):
    one = table.where("id = 1")
    values = ml.assemble(one).select(vector_to_array("features").alias("v")).first().v
    assert values == [float(one.first()[n]) for n in FEATURES]
    assert ml.vector_rows(one).select(vector_to_array("features").alias("v")).first().v == values


def test_split_does_not_depend_on_partitions(spark, table):
    a = {r.id for r in ml.split(table.repartition(7), ["id"])[0].collect()}
    b = {r.id for r in ml.split(table.coalesce(1), ["id"])[0].collect()}
    assert a == b and 0.6 < len(a) / table.count() < 0.8


@pytest.mark.parametrize("split_rows", [10**6, 5])
def test_index_equals_the_in_memory_indexer(spark, split_rows):
    rng = random.Random(1)
    words = ["a", "b", "c", "dd", "e", "f", None] + [f"w{i}" for i in range(30)]
    df = spark.createDataFrame([(i, rng.choice(words), rng.randrange(4) / 2) for i in range(300)], "id long, w string, v double")
    indexer = StringIndexer(inputCols=["w", "v"], outputCols=["w_want", "v_want"], handleInvalid="keep").fit(df)
    index = ml.index_values(df, ["w", "v"], split_rows)
    unseen = df.unionByName(spark.createDataFrame([(900, "new", 77.0)], df.schema))
    both = ml.apply_index(indexer.transform(unseen), index, ["w", "v"])
    assert both.count() == 301
    assert both.where("w_index <> w_want OR v_index <> v_want").count() == 0


@pytest.mark.parametrize("columns", [1, 5, 19])
def test_shuffles_do_not_grow_with_columns(spark, table, columns):
    index = ml.index_values(table, FEATURES)
    indexed = ml.apply_index(table, spark.createDataFrame(index.collect(), index.schema), FEATURES[:columns])
    indexed.count()
    plan = indexed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and plan.count("Aggregate ") == 1


def test_columns_of_few_values_are_not_shuffled(spark):
    """And the result is that of columns that are; a value or a column that the index lacks, and nulls."""
    data = [(i, i % 3, None if i % 10 == 0 else f"w{i % 4}", i / 2, "x") for i in range(1000)]
    df = spark.createDataFrame(data, "id long, few int, w string, many double, absent string")
    index = materialize(ml.index_values(df.where("w IS NULL OR w <> 'w3'"), ["few", "w", "many"]), "index")
    columns = ["few", "w", "many", "absent"]
    got = ml.apply_index(df, index, columns)
    assert sorted(got.collect()) == sorted(ml.apply_index(df, index, columns, few=0).collect())
    assert {(r.w, r.w_index == 3.0) for r in got.collect()} == {("w0", False), ("w1", False), ("w2", False), ("w3", True), (None, True)}
    plan = ml.apply_index(df, index, ["few", "w"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan


def test_indexing_keeps_rows_and_columns(spark):
    """Repeated rows, nulls, clashing names, a value that a third of the rows share, no rows."""
    data = [(i % 50, "hot" if i % 3 else None, "old", float(i % 7)) for i in range(300)]
    df = spark.createDataFrame(data, "id long, w string, w_index string, `a b` double")
    index = ml.index_values(df, ["w", "a b"])
    got = ml.apply_index(df, index, ["w", "a b"])
    assert got.columns == ["id", "w", "a b", "w_index", "a b_index"]
    wanted = sorted((i, w or "", x, 0.0 if w else 1.0) for i, w, _, x in data)
    assert sorted((r.id, r.w or "", r["a b"], r.w_index) for r in got.collect()) == wanted
    assert ml.apply_index(df.limit(0), index, ["w"]).count() == 0 and ml.apply_index(df, index, []) is df


def test_pipeline_equals_the_in_memory_pipeline(spark, table):
    """All 19 columns indexed, most of them continuous: vectors and predictions are those of Spark's own stages."""
    training, test = ml.split(table, ["id"], 0.8, 42)
    model = ml.fit_indexed(training)
    every = [*FEATURES, LABEL]
    indexer = StringIndexer(inputCols=every, outputCols=[f"{c}_index" for c in every], handleInvalid="keep").fit(training)
    own = ml._vectors(table, model.index, tuple(FEATURES), LABEL, {}).select("id", "features", f"{LABEL}_index")
    wanted = ml.assembler([f"{c}_index" for c in FEATURES]).transform(indexer.transform(table))
    text = lambda df: df.select("id", F.col("features").cast("string").alias("f"), f"{LABEL}_index")
    assert text(own).exceptAll(text(wanted)).isEmpty()
    predicted = model.transform(test)
    expected = model.model.transform(wanted.join(test.select("id"), "id", "left_semi"))
    assert predicted.select("id", "prediction").exceptAll(expected.select("id", "prediction")).isEmpty()
    path = new_path(spark, "indexed")
    model.save(path)
    again = ml.load_indexed(spark, "mlp", path)
    assert again.transform(test).exceptAll(predicted).isEmpty()
    assert "label" not in again.transform(test.drop(LABEL)).columns


def test_pipeline(spark, table):
    """Columns that repeat are indexed, continuous ones scaled: this carries over to other rows."""
    training, test = ml.split(table, ["id"], 0.8, 42)
    indexed = ml.repeating(training, FEATURES)
    assert {"transaction_at_night", "account_id_count_1day"} <= set(indexed) and "amount" not in indexed
    model = ml.fit_indexed(training, scaled=[c for c in FEATURES if c not in indexed])
    path = new_path(spark, "indexed")
    model.save(path)
    again = ml.load_indexed(spark, "mlp", path)
    predicted = model.transform(test)
    assert predicted.where("prediction = label").count() > 0.75 * test.count()
    assert again.transform(test).exceptAll(predicted).isEmpty()
    assert model.transform(test.withColumn("amount", F.lit(None).cast("double"))).where("prediction IS NULL").isEmpty()


def test_training_csv(spark, table):
    path = new_path(spark, "csv")
    table.select(*FEATURES, LABEL).write.option("header", True).csv(path)
    again = training_csv(spark, path)
    assert again.schema == TRAINING and again.count() == 600
    assert train(again, "lr").test_match > 85


def test_training_csv_goes_by_name(spark, table):
    path = new_path(spark, "csv")
    mixed = table.select(LABEL, F.lit("more").alias("note"), *reversed(FEATURES))
    mixed.write.option("header", True).csv(path)
    assert training_csv(spark, path).exceptAll(table.select(*FEATURES, LABEL)).isEmpty()
    with pytest.raises(ValueError, match="amount"):
        table.drop("amount").write.option("header", True).csv(f"{path}-short")
        training_csv(spark, f"{path}-short")
