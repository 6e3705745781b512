"""Late rows and what they change, against features computed anew from all rows."""

import datetime
import random

import pytest

from tellerscore.operators import corrections, features
from tellerscore.schemas import KEYS, average_name, count_name
from tellerscore.session import materialize

SCHEMA = "id long, account_id long, customer_id long, amount double, ts timestamp"
START = datetime.datetime(2024, 1, 1)


def made(seed, n=240):
    """A hot account, ties of time, and days further apart than the longest horizon."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        account = 1 if rng.random() < 0.4 else rng.randrange(2, 9)
        day = rng.choice([0, 1, 2, 30, 31, 90, 91, 92, 120, 181, 182, 300])
        ts = START + datetime.timedelta(days=day, hours=rng.choice([0, 1, 1, 23]))
        rows.append((i, account, account // 3, rng.randrange(1, 10_000) / 100, ts))
    return rows


def followers(rows, late, column):
    """Ids that a late row precedes within 90 days, and the late ones, one pair at a time."""
    out = set(late)
    for a in rows:
        for b in rows:
            near = 0 <= (a[4].date() - b[4].date()).days <= 90
            if b[0] in late and a[column] == b[column] and near and (b[4], b[0]) < (a[4], a[0]):
                out.add(a[0])
    return out


def run(spark, rows, late, split_rows=4_000_000):
    everything = materialize(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "to_date(ts) AS event_day"), "rows")
    chosen = everything.where(everything.id.isin(sorted(late)) if late else "false")
    on_time = everything.where(~everything.id.isin(sorted(late))) if late else everything
    totals = features.day_totals(on_time)
    frames = {k: t.frame for k, t in totals.items()}
    changes = corrections.corrections(chosen, on_time, frames, split_rows=split_rows)
    names = [f(k, h) for k in KEYS for f in (average_name, count_name) for h in ("1day", "1week", "1month", "3month")]
    first = features.point_in_time(on_time, totals=totals).select("id", *names)
    done = corrections.corrected(first, changes).select("id", *names)
    whole = features.point_in_time(everything).select("id", *names)
    return changes, sorted(map(tuple, done.collect())), sorted(map(tuple, whole.collect()))


@pytest.mark.parametrize("seed, split_rows", [(1, 4_000_000), (2, 10)])
def test_corrections_equal_a_full_pass(spark, seed, split_rows):
    rows = made(seed)
    late = set(random.Random(seed + 10).sample(range(len(rows)), 25))
    changes, done, whole = run(spark, rows, late, split_rows)
    assert done == whole
    for key, column in (("account_id", 1), ("customer_id", 2)):
        found = [(r["id"], r["late"]) for r in changes[key].select("id", "late").collect()]
        assert len(found) == len({i for i, _ in found})
        assert {i for i, _ in found} == followers(rows, late, column)
        assert {i for i, is_late in found if is_late} == late


def test_without_late_rows_nothing_changes(spark):
    changes, done, whole = run(spark, made(3, 40), set())
    assert done == whole
    assert all(frame.isEmpty() for frame in changes.values())


def test_all_rows_late(spark):
    rows = made(4, 40)
    changes, done, whole = run(spark, rows, set(range(40)))
    assert done == whole and changes["account_id"].count() == 40


def test_only_days_within_reach_are_touched(spark):
    days = [0, 1, 90, 91, 200]
    rows = [(d, 1, 0, 1.0, START + datetime.timedelta(days=d)) for d in days]
    totals = features._by_day(spark.createDataFrame(rows, SCHEMA), "account_id", "decimal(25,6)")
    late = spark.createDataFrame([(9, 1, 0, 1.0, START)], SCHEMA)
    found = corrections.touched_days(late, "account_id", totals).collect()
    assert sorted((r["day"] - START.date()).days for r in found) == [0, 1, 90]


def test_late_days_are_not_multiplied_by_their_reach(spark):
    rows = made(5, 60) + [(100, None, 3, 1.0, START), (101, 1, 0, 1.0, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    late = frame.where("id % 5 = 0 OR id > 99")
    touched = corrections.touched_days(late, "account_id", features._by_day(frame, "account_id", "decimal(25,6)"))
    reached = corrections._reached(frame.selectExpr("*", "id % 5 = 0 OR id > 99 AS late"), "account_id", 90)
    for found in (touched, reached):
        assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    days = {(r[1], r[4].date()) for r in rows if None not in r}
    far = [(k, d) for k, d in days if any(r[1] == k and r[0] % 5 == 0 and 0 <= (d - r[4].date()).days <= 90 for r in rows[:60])]
    assert sorted(map(tuple, touched.collect())) == sorted(far)
    own = {(r["account_id"], r["_day"]): r["_before"] for r in reached.collect()}
    assert own == {
        (k, d): any(r[1] == k and r[0] % 5 == 0 and 1 <= (d - r[4].date()).days <= 90 for r in rows[:60]) for k, d in days
    }
