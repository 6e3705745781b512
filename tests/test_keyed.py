import datetime

from pyspark.sql import functions as F

from tellerscore.operators import accounts, dedupe, metrics
from tellerscore.operators.history import ACCOUNT_TTL

VERSION = "account_id long, customer_id long, account_type string, partition int, offset long, seen_at timestamp"
T0 = datetime.datetime(2024, 1, 1)


def versions(spark):
    rows = [
        (1, 10, None, 0, 5, T0),
        (1, 11, None, 0, 7, T0 + datetime.timedelta(days=3)),
        (1, 12, None, 0, 6, T0),
        (2, 20, None, 0, 1, T0),
    ]
    return spark.createDataFrame(rows, VERSION)


def test_latest_and_first(spark):
    latest = {r.account_id: r.customer_id for r in accounts.latest_accounts(versions(spark)).collect()}
    first = {r.account_id: r.customer_id for r in accounts.first_accounts(versions(spark)).collect()}
    assert latest == {1: 11, 2: 20} and first == {1: 10, 2: 20}


def test_copies_collapse_before_the_shuffle(spark):
    copies = spark.range(1000).select(F.lit(1).alias("id"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    plan = dedupe.dedupe_transactions(copies)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan
    assert dedupe.dedupe_transactions(copies).first().offset == 999


def test_account_ttl(spark):
    now = F.lit(T0 + datetime.timedelta(days=8))
    live = accounts.live_accounts(versions(spark), now, ACCOUNT_TTL)
    assert [r.account_id for r in live.collect()] == [1]
    assert accounts.live_accounts(versions(spark), now, None).count() == 2


def test_insert_if_absent_compares_whole_rows(spark):
    schema = "customer_id long, account_id long"
    old = spark.createDataFrame([(1, 1), (1, 1), (None, 2)], schema)
    new = spark.createDataFrame([(1, 1), (9, 1), (9, 1), (None, 2), (3, None)], schema)
    rows = accounts.insert_if_absent(old, new).collect()
    assert sorted(map(repr, rows)) == sorted(
        map(repr, spark.createDataFrame([(1, 1), (1, 1), (None, 2), (9, 1), (3, None)], schema).collect())
    )


def test_join_account(spark):
    batch = spark.createDataFrame([(1, 1), (2, 2), (3, 99)], "id long, account_id long")
    resolved, pending = accounts.join_account(batch, accounts.latest_accounts(versions(spark)))
    assert {r.id: r.customer_id for r in resolved.collect()} == {1: 11, 2: 20}
    assert [tuple(r) for r in pending.collect()] == [(3, 99)] and pending.columns == batch.columns


def test_metrics_equal_the_evaluator(spark):
    rows = [(i % 3 % 2, float((i * 7) % 5 % 2)) for i in range(200)] + [(1, 2.0), (3, 0.0)]
    df = spark.createDataFrame(rows, "is_fraud int, prediction double")
    measured = metrics.eval_metrics(df).first().asDict()
    for name, value in metrics.evaluate(df).items():
        assert abs(measured[name] - value) < 1e-12
    hits = sum(a == b for a, b in rows)
    assert abs(metrics.match_percentage(df).first()[0] - 100 * hits / len(rows)) < 1e-9
