"""The registered queries op11 to op13 on the smallest tables: contract columns, SQL or a plain version, odd rows."""

import importlib.util
import math
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tellerscore.llm import queries
from tellerscore.session import new_path

FOLDER = "/root/testdata/sf0.001"
spec = importlib.util.spec_from_file_location("compare", Path(__file__).parent.parent.parent / "scripts" / "compare.py")
compare = importlib.util.module_from_spec(spec)
spec.loader.exec_module(compare)


def test_whitening_query(spark):
    rows = queries.op11_whitening(spark, FOLDER)
    kinds = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    assert ", ".join(f"{n} {t}" for n, t in rows.dtypes) == kinds
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect() if r.embedding}
    ids = sorted(vectors)
    x = [[math.floor(1024 * c) + 100_000 for c in vectors[i]] for i in ids]
    n, sums = len(x), [sum(column) for column in zip(*x)]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    values, basis = values[::-1], basis[:, ::-1]
    found = {(r.vec_id, r.component): r for r in rows.collect()}
    assert found.keys() == {(i, k) for i in ids for k in range(1, 9)}
    for k in range(1, 9):
        own = np.array([found[i, k].whitened for i in ids])
        wanted = centred @ basis[:, k - 1] / math.sqrt(values[k - 1])
        assert np.abs(own - wanted * np.sign(own @ wanted)).max() < 1e-6
        assert {found[i, k].explained for i in ids} == {found[ids[0], k].explained}
        assert found[ids[0], k].explained == pytest.approx(values[k - 1] / values.sum(), rel=1e-9)
    for i, row in zip(ids, x):
        assert found[i, 1].deviation == sum((n * c - s) ** 2 for c, s in zip(row, sums)) and found[i, 1].n == n
    assert {r.identity_error for r in found.values()} == {found[ids[0], 1].identity_error} and found[ids[0], 1].identity_error < 1e-9


def test_search_query(spark):
    assert compare.compare(spark, compare.connect(FOLDER), FOLDER, "op12_lexical_search").startswith("equal")
    kinds = "item_id bigint, rank int, doc_id bigint, score bigint"
    assert ", ".join(f"{n} {t}" for n, t in queries.op12_lexical_search(spark, FOLDER).dtypes) == kinds


def test_quality_query(spark):
    rows = queries.op13_quality_rules(spark, FOLDER)
    assert ", ".join(f"{n} {t}" for n, t in rows.dtypes) == "doc_id bigint, held_out boolean, score double, predicted int"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = rows.collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 10 and np.mean(held) > 0.9


def test_queries_without_usable_rows(spark):
    folder = new_path(spark, "empty")
    docs = spark.createDataFrame([(1, None, "en", "s", None), (2, "", None, None, 0)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(1, None, 0), (9, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert queries.op11_whitening(spark, folder).collect() == []
    assert queries.op12_lexical_search(spark, folder).collect() == []
    assert {(r.doc_id, r.score, r.predicted) for r in queries.op13_quality_rules(spark, folder).collect()} == {(1, 0.5, 1), (2, 0.5, 1)}
    assert queries.op13_quality_rules(spark, folder).where(F.col("doc_id").isNull()).count() == 0
