"""State in buckets of its key, and the filters of known ids."""

import datetime

import pytest
from pyspark.sql import functions as F

from tellerscore.operators.dedupe import last_by
from tellerscore.session import new_path
from tellerscore.streaming import known
from tellerscore.streaming.buckets import BucketedTable
from tellerscore.streaming.known import KnownIds

DAY = datetime.date(2024, 1, 1)


def table(spark, **options):
    schema = spark.createDataFrame([], "account_id long, customer_id long, at long").schema
    return BucketedTable(new_path(spark, "buckets"), schema, key="account_id", **options)


def versions(spark, start, stop, at):
    return spark.range(start, stop).select(F.col("id").alias("account_id"), (F.col("id") * 10 + at).alias("customer_id"), F.lit(at).cast("long").alias("at"))


def latest(rows):
    return last_by(rows, ["account_id"], ["at"])


def keys(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "account_id long")


def found(df):
    return sorted(map(tuple, df.collect()))


def test_lookup_opens_only_the_buckets_of_its_keys(spark):
    """As many files for a hundred times the accounts, before and after merging."""
    opened = []
    for accounts in (100, 1000, 10_000):
        state = table(spark, buckets=64)
        state.write(versions(spark, 0, accounts, 0), 0)
        state.compact(spark, 1, latest)
        state.write(versions(spark, 0, accounts, 1), 1)
        rows = state.lookup(keys(spark, 3, 50, 3, None))
        assert found(rows) == [(3, 30, 0), (3, 31, 1), (50, 500, 0), (50, 501, 1)]
        opened.append(len(rows.inputFiles()))
    assert len(set(opened)) == 1 and opened[0] <= 4


def test_a_merge_rewrites_only_what_deltas_touched(spark):
    state = table(spark, buckets=16)
    state.write(versions(spark, 0, 200, 0), 0)
    state.compact(spark, 1, latest)
    before = set(state.read(spark).inputFiles())
    state.write(versions(spark, 7, 8, 5), 1)
    state.compact(spark, 2, latest)
    after = set(state.read(spark).inputFiles())
    assert len(before) == len(after) == 16 and len(before & after) == 15
    assert found(state.lookup(keys(spark, 7, 8))) == [(7, 75, 5), (8, 80, 0)]
    state.vacuum(spark)
    assert set(state.read(spark).inputFiles()) == after and state.read(spark).count() == 200
    # who reads as of an earlier micro-batch still needs what vacuum took; who reads the newest does not
    state.compact(spark, 2, latest)
    assert set(state.read(spark).inputFiles()) == after


def test_buckets_double_as_they_grow(spark):
    state = table(spark, buckets=2, bucket_rows=40)
    plain = None
    for epoch in range(4):
        rows = versions(spark, 0, 100 * 2**epoch, epoch)
        plain = rows if plain is None else latest(plain.unionByName(rows))
        state.write(rows, epoch)
        state.compact(spark, epoch + 1, latest)
    assert state._merged(spark, None) == (4, 32)
    assert state._merged(spark, 1) == (1, 4)
    assert found(state.read(spark)) == found(plain)
    assert found(state.lookup(keys(spark, 0, 99, 799, 800))) == [(0, 3, 3), (99, 993, 3), (799, 7993, 3)]
    assert state.read(spark, before=1).count() == 100
    state.vacuum(spark)
    assert found(state.read(spark)) == found(plain)


def test_what_was_not_finished_is_not_read(spark):
    state = table(spark, buckets=4)
    state.write(versions(spark, 0, 20, 0), 0)
    state._rewrite(versions(spark, 0, 20, 9), 4, 1)  # a merge that died before its marker
    assert found(state.read(spark)) == found(versions(spark, 0, 20, 0))
    state.compact(spark, 1, latest)
    assert found(state.read(spark)) == found(versions(spark, 0, 20, 0))
    for _ in range(2):  # a micro-batch and its retry
        state.write(versions(spark, 5, 6, 2), 1)
    assert found(state.lookup(keys(spark, 5))) == [(5, 50, 0), (5, 52, 2)]
    assert state.lookup(keys(spark, 5), before=1).count() == 1 and state.last(spark) == 1
    state.write(versions(spark, 0, 0, 0), 2)
    assert state.read(spark, only=2).count() == 0 and state.lookup(keys(spark)).count() == 0


def test_text_keys(spark):
    schema = spark.createDataFrame([], "account_id string, n long").schema
    state = BucketedTable(new_path(spark, "buckets"), schema, key="account_id")
    state.write(spark.createDataFrame([("U1", 1), ("", 2), (None, 3)], schema), 0)
    assert found(state.lookup(spark.createDataFrame([("U1",), ("",), (None,)], "account_id string"))) == [("", 2), ("U1", 1)]


def stored(spark, start, stop, days):
    return spark.range(start, stop).select("id", F.date_add(F.lit(DAY), (F.col("id") % days).cast("int")).alias("event_day"))


@pytest.mark.parametrize("merged", [False, True])
def test_unseen_equals_an_anti_join(spark, merged):
    ids = KnownIds(new_path(spark, "known"))
    ids.add(stored(spark, 0, 3000, 5), 0)
    ids.add(stored(spark, 3000, 3000, 5), 1)
    ids.add(stored(spark, 5000, 9000, 40), 2)
    if merged:
        ids.compact(spark, 3)
        ids.vacuum(spark)
        ids.add(stored(spark, 20_000, 20_100, 1), 3)
    batch = spark.range(2500, 12_000).unionByName(spark.createDataFrame([(None,), (2600,), (-1,), (2**63 - 1,)], "id long"))
    got = sorted(r[0] if r[0] is not None else -2 for r in ids.unseen(batch).collect())
    assert got == sorted([*range(3000, 5000), *range(9000, 12_000), -2, -1, 2**63 - 1])
    if not merged:  # vacuum has taken older state
        assert ids.unseen(batch, before=2).count() == batch.count() - 501
    assert ids.unseen(batch, before=0).count() == batch.count()
    assert ids.unseen(batch.limit(0)).count() == 0


def test_filters_let_few_through_and_only_their_ids_are_read(spark):
    ids = KnownIds(new_path(spark, "known"))
    ids.add(stored(spark, 0, 200_000, 10), 0)
    filters = ids.filters.read(spark)
    assert known.let_through(spark.range(200_000), filters).count() >= 200_000
    strangers = known.let_through(spark.range(10**6, 10**6 + 50_000), filters)
    assert strangers.count() < 50_000 * 10 * 0.001
    # one known id: one day is opened, and one bucket asked for
    passed = known.let_through(spark.createDataFrame([(77,)], "id long"), filters)
    exact = ids.among(spark, passed)
    assert [r[0] for r in exact.collect()] == [77]
    scans = [line for line in exact._jdf.queryExecution().executedPlan().toString().split("\n") if "ReadSchema: struct<id:bigint" in line]
    assert scans and "(event_day#" in scans[0].split("PartitionFilters")[1].split("]")[0]
    assert "bucket" in scans[0].split("PushedFilters")[1]
    # a filter is a fraction of the ids it stands for: 32 bytes for about a dozen of them
    assert filters.count() * 32 < 200_000 * 8


def test_days_past_retention_are_forgotten(spark):
    ids = KnownIds(new_path(spark, "known"))
    ids.add(stored(spark, 0, 100, 10), 0)
    ids.compact(spark, 1, DAY + datetime.timedelta(days=5))
    assert sorted(r[0] for r in ids.unseen(spark.range(100)).collect()) == [i for i in range(100) if i % 10 < 5]
    assert ids.filters.read(spark).where(F.col("event_day") < F.lit(DAY + datetime.timedelta(days=5))).count() == 0


def test_an_id_is_asked_for_once_per_level_of_its_bucket(spark, monkeypatch):
    ids = KnownIds(new_path(spark, "known"))
    ids.add(stored(spark, 0, 2000, 3).unionByName(spark.range(5000, 25_000).withColumn("event_day", F.lit(DAY))), 0)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan(known.let_through(spark.range(100), ids.filters.read(spark)))
    # many ids that pass are not sent through the driver, and the answer stays the same
    batch = spark.range(1000, 6000)
    assert "BroadcastHashJoin" in plan(ids.unseen(batch))
    monkeypatch.setattr("tellerscore.session.BROADCAST_ROWS", 100)
    assert "BroadcastHashJoin" not in plan(ids.unseen(batch))
    assert sorted(r[0] for r in ids.unseen(batch).collect()) == [*range(2000, 5000)]
