import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tellerscore.operators import features, running
from tellerscore.session import materialize
from tellerscore.schemas import HORIZONS, KEYS, average_name, count_name

SCHEMA = "id long, account_id long, customer_id long, amount double, ts timestamp"
START = datetime.datetime(2024, 1, 1)


def rows_with_a_hot_key(n=400, seed=5):
    """A third of the rows belong to one customer, and many of them share one instant."""
    rng = random.Random(seed)
    rows = []
    for i in rng.sample(range(10 * n), n):
        hot = rng.random() < 0.4
        account = 1 if hot else rng.randrange(2, 20)
        day = rng.choice([0, 3, 3, 3, 40, 95]) if hot else rng.randrange(120)
        second = rng.choice([0, 0, 0, 7, 86399]) if hot else rng.randrange(86400)
        ts = START + datetime.timedelta(days=day, seconds=second)
        rows.append((i, account, account // 3, rng.randrange(1, 10**6) / 100, ts))
    return rows


def by_hand(rows, key, history=None):
    """Brute force over all pairs: features by row id."""
    at = 2 if key == "customer_id" else 1
    result = {}
    for row in rows:
        mine = [o for o in (history or rows) if o[at] == row[at] and (o[4], o[0]) <= (row[4], row[0])]
        for name, days in HORIZONS.items():
            inside = [o for o in mine if o[4].date() >= row[4].date() - datetime.timedelta(days=days)]
            total = sum(Decimal(str(o[3])) for o in inside)
            result[row[0], name] = (len(inside), float(total) / len(inside))
    return result


def check(frame, rows, history=None):
    got = {r.id: r for r in frame.collect()}
    assert len(got) == len(rows)
    for key in KEYS:
        for (id, name), (count, average) in by_hand(rows, key, history).items():
            assert got[id][count_name(key, name)] == count
            assert got[id][average_name(key, name)] == pytest.approx(average, rel=1e-12)


@pytest.mark.parametrize("split_rows", [10**6, 150, 10, 1])
def test_point_in_time_equals_brute_force(spark, split_rows):
    rows = rows_with_a_hot_key()
    df = spark.createDataFrame(rows, SCHEMA)
    check(features.point_in_time(df, split_rows=split_rows), rows)


@pytest.mark.parametrize("split_rows", [10**6, 10])
def test_newest_part_against_stored_history(spark, split_rows):
    rows = rows_with_a_hot_key()
    cut = START + datetime.timedelta(days=3, seconds=5)
    old, new = [r for r in rows if r[4] < cut], [r for r in rows if r[4] >= cut]
    past = spark.createDataFrame(old, SCHEMA)
    totals = {k: t.frame for k, t in features.day_totals(past).items()}
    same_days = past.where(F.to_date("ts") >= F.lit(cut.date()))
    fresh = spark.createDataFrame(new, SCHEMA)
    scored = features.point_in_time(fresh, past_totals=totals, past_rows=same_days, split_rows=split_rows)
    check(scored, new, rows)


def test_horizon_edges(spark):
    day = datetime.datetime(2024, 3, 10)
    rows = [
        (1, 1, 1, 1.0, day - datetime.timedelta(days=7)),
        (2, 1, 1, 2.0, day - datetime.timedelta(days=7, seconds=1)),
        (3, 1, 1, 4.0, day + datetime.timedelta(hours=23)),
        (4, 1, 1, 8.0, day),
    ]
    got = {r.id: r for r in features.point_in_time(spark.createDataFrame(rows, SCHEMA), keys=("account_id",)).collect()}
    assert got[4].account_id_count_1day == 1 and got[4].account_id_count_1week == 2
    assert got[4].account_id_count_1month == 3
    assert got[3].account_id_avrge_amount_1week == pytest.approx(13 / 3)


def test_the_split_moves_no_row_to_the_driver_and_joins_by_merge(spark):
    df = spark.createDataFrame(rows_with_a_hot_key(), SCHEMA)
    frame = features.point_in_time(df, keys=("customer_id",))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "BroadcastExchange" not in plan
    assert plan.count("Window") >= 2


def test_a_hot_group_is_cut_into_even_pieces(spark):
    hot = spark.range(0, 100_000).select(F.lit(1).alias("key"), "id", F.lit(0).alias("ts"))
    cut = running.pieces(hot, ["key", "ts", "id"], 10)
    sizes = [r["count"] for r in cut.groupBy("_piece").count().collect()]
    assert sum(sizes) == 100_000 and len(sizes) == 10 and max(sizes) < 20_000


def test_a_hot_group_stays_spread_over_tasks(spark):
    hot = spark.range(0, 20_000).select(
        "id",
        F.lit(1).cast("long").alias("account_id"),
        F.lit(0).cast("long").alias("customer_id"),
        F.lit(2.5).alias("amount"),
        F.lit(START).alias("ts"),
    )
    featured = features.point_in_time(hot, split_rows=2_000)
    per_task = featured.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 20_000 and max(r["count"] for r in per_task) < 15_000
    assert featured.where("account_id_count_1day <> id + 1 OR customer_id_count_3month <> id + 1").count() == 0


def test_running_totals_with_null_measures(spark):
    rows = [(1, 1, None), (1, 2, 5), (1, 3, None), (1, 4, 6), (2, 1, None)]
    df = spark.createDataFrame(rows, "k int, o int, v int")
    sizes = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = []
    for split_rows in (10, 1):
        out = running.running_totals(df, ["k"], ["o"], F.col("v"), running.GroupSizes(sizes, 4, 5), split_rows)
        got.append(sorted((r.k, r.o, r.run_n, r.run_s) for r in out.collect()))
    assert got[0] == got[1]
    assert got[0] == [(1, 1, 1, None), (1, 2, 2, 5), (1, 3, 3, 5), (1, 4, 4, 11), (2, 1, 1, None)]


def test_as_of_features(spark):
    rows = rows_with_a_hot_key()
    df = spark.createDataFrame(rows, SCHEMA)
    anchor = (START + datetime.timedelta(days=97)).date()
    got = {r.id: r for r in features.as_of_features(df, df, anchor).collect()}
    for row in rows:
        for key, at in (("customer_id", 2), ("account_id", 1)):
            for name, days in HORIZONS.items():
                inside = [o for o in rows if o[at] == row[at] and o[4].date() >= anchor - datetime.timedelta(days=days)]
                assert got[row[0]][count_name(key, name)] == len(inside)
                average = got[row[0]][average_name(key, name)]
                if inside:
                    assert average == pytest.approx(sum(o[3] for o in inside) / len(inside))
                else:
                    assert average is None


def test_anchor_day_reaches_the_scan(spark):
    written = materialize(spark.createDataFrame(rows_with_a_hot_key(), SCHEMA), "history")
    frame = features.as_of_totals(written, "account_id", START.date())
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2023-10-03" in plan
    assert "ReadSchema: struct<account_id:bigint,amount:double,ts:timestamp>" in plan


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert features.point_in_time(df).count() == 0
