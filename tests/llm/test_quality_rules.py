"""The rule ensemble: statistics, extraction and compilation of rules, held-out accuracy, odd labels."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tellerscore.llm import quality_rules
from tellerscore.llm.quality_rules import STATISTICS, Rule, RuleModel
from tests.llm.documents import frame, rows, text_of


def named(text):
    return dict(zip(STATISTICS, quality_rules.statistics_of(text.encode())))


def test_statistics():
    found = named("One two two.\nTHREE | 4! é\n\n")
    assert found["log_words"] == math.log1p(7) and found["log_lines"] == math.log1p(2)
    assert found["distinct_words"] == 1 and found["capital_words"] == 2 / 7 and found["ended_lines"] == 1 / 2
    assert found["upper_share"] == 6 / 28 and found["beyond_ascii_share"] == 2 / 28
    assert found["odd_endings"] == 2 / 7 and found["odd_words"] == 2 / 7 and found["log_longest_word"] == math.log1p(5)
    assert set(named("").values()) == {0.0} and len(STATISTICS) == len(set(STATISTICS)) == len(named(" \n "))


def test_every_byte_has_one_class():
    classes = b"".join(quality_rules.BYTES.values())
    assert sorted(classes) == list(range(256))


def test_paths_agree_with_the_forest(spark):
    """A sample falls into exactly one longest path of each tree, and each path is what its parent is, and more."""
    rng = np.random.default_rng(3)
    data = [(float(a > 0.2 and b < 0.5), [float(a), float(b), float(c)]) for a, b, c in rng.normal(size=(300, 3))]
    table = spark.createDataFrame(data, "label double, found array<double>")
    forest = RandomForestClassifier(numTrees=1, maxDepth=3, seed=1).fit(table.select("label", array_to_vector("found").alias("features")))
    rules = quality_rules.paths(forest)
    assert len(rules) == forest.trees[0].numNodes - 1 and len({r.bounds for r in rules}) == len(rules)
    held = np.array(table.select(F.array(*[r.holds(F.col("found")).cast("int") for r in rules])).collect()).reshape(300, -1)
    plain = [[all(low < x[i] <= high for i, low, high in r.bounds) for r in rules] for _, x in data]
    assert (held == np.array(plain)).all()
    depths = held.sum(axis=1)  # a path of n tests has n - 1 ancestors that hold as well
    assert depths.min() >= 1 and depths.max() <= 3


def test_compiled_expression(spark):
    model = RuleModel(-0.25, (Rule(((0, 0.5, math.inf),), 1.5), Rule(((0, -math.inf, 2.0), (1, 0.0, 1.0)), -2.0)))
    data = [(0.0, 0.5), (0.5, 0.0), (1.0, 1.0), (3.0, 0.5), (2.0, 1.5)]
    df = spark.createDataFrame([(list(x),) for x in data], "found array<double>")
    got = [r[0] for r in df.select(model.probability(F.col("found"))).collect()]
    odds = [-0.25 + 1.5 * (a > 0.5) - 2 * (a <= 2 and 0 < b <= 1) for a, b in data]
    assert got == pytest.approx([1 / (1 + math.exp(-o)) for o in odds])
    assert str(model.rules[1]) == f"{STATISTICS[1]} > 0 AND {STATISTICS[0]} <= 2 AND {STATISTICS[1]} <= 1"


def graded(n, seed=4):
    """Texts of which a quarter are shouted, cut into cells or one word over and over; label and text."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = ". ".join(text_of(rng, rng.choice(["en", "de", "fr"]), rng.randint(4, 60)).capitalize() for _ in range(rng.randint(1, 4)))
        kind = rng.randrange(12)
        spoilt = {0: text.upper() + "!!", 1: " | ".join(text.split()), 2: " ".join(text.split()[:1] * 40)}
        out.append((i, spoilt.get(kind, text + "."), int(kind > 2)))
    return out


def test_held_out_accuracy(spark):
    data = graded(900)
    docs = spark.createDataFrame([(i, t, "clash") for i, t, _ in data], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, q) for i, _, q in data], "doc_id long, quality int")
    model = quality_rules.fit(docs, labels, training=F.col("doc_id") % 3 != 0)
    assert 0 < len(model.rules) < 150
    got = {r["doc_id"]: r for r in quality_rules.score(docs, model).collect()}
    assert len(got) == len(data) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    held = [(got[i]["predicted"], q) for i, _, q in data if i % 3 == 0]
    assert sum(a == b for a, b in held) > 0.97 * len(held)


def test_labels_outside_training_teach_nothing(spark):
    data = graded(300)
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in data], "doc_id long, quality int")
    turned = labels.withColumn("quality", F.when(F.col("doc_id") % 3 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    known = F.col("doc_id") % 3 != 0
    a, b = (quality_rules.fit(docs, seen, training=known) for seen in (labels, turned))
    assert [r.bounds for r in a.rules] == [r.bounds for r in b.rules]
    assert [a.intercept, *[r.weight for r in a.rules]] == pytest.approx([b.intercept, *[r.weight for r in b.rules]], rel=1e-6)


def test_odd_labels_and_texts(spark):
    docs = frame(spark, rows(), ("predicted", "_in", "_found"))
    labels = [(i, i % 2) for i in range(100)] + [(3, 0), (5, None), (6, 7), (None, 1), (100_000, 1), (8, 0), (8, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    used = {r["_id"]: r["_label"] for r in quality_rules._labelled(labels, "doc_id", "quality", None, 1000).collect()}
    assert 3 not in used and used[5] == 1 and used[6] == 0 and used[8] == 0 and len(used) == 100
    model = quality_rules.fit(docs, labels)
    got = quality_rules.score(docs, model)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "_in", "_found", "score", "predicted"]
    by_id = {}
    for r in got.collect():
        by_id.setdefault(r["doc_id"], []).append(r["score"])
    assert sum(map(len, by_id.values())) == len(rows()) and by_id[140] == by_id[141]
    assert all(0 <= s <= 1 for scores in by_id.values() for s in scores) and len(set(by_id[145])) == 1


def test_without_contrast(spark):
    docs = frame(spark, rows(20))
    labels = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, quality int")
    assert quality_rules.fit(docs, labels.limit(0)) == RuleModel(0.0)
    assert quality_rules.fit(docs.limit(0), labels) == RuleModel(0.0)
    model = quality_rules.fit(docs, labels)
    assert model.rules == () and {round(r["score"], 6) for r in quality_rules.score(docs, model).collect()} == {0.95}
    assert quality_rules.score(docs.limit(0), model).collect() == []


def test_bound_of_the_fit(spark):
    labels = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    n = quality_rules._labelled(labels, "doc_id", "quality", None, 500).count()
    assert 400 < n < 600
