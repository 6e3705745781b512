"""Streams with state of their own: trailing features by key, and transactions that wait for their account."""

import datetime

import pytest

from tellerscore.schemas import average_name, count_name
from tellerscore.session import new_path
from tellerscore.streaming import keyed, waiting

ROWS = "id long, account_id string, customer_id long, amount decimal(25,6), ts timestamp"
TRANSACTIONS = "id long, account_id string, amount double, broker_time timestamp"
ACCOUNTS = "account_id string, customer_id long, account_type string, broker_time timestamp"


def at(day, hour=0):
    return datetime.datetime(2024, 1, 1, hour) + datetime.timedelta(days=day)


def stream_of(spark, schema, name):
    folder = new_path(spark, name)
    spark.createDataFrame([], schema).write.parquet(folder)
    return spark.readStream.schema(schema).parquet(folder), folder


def step(spark, stream, path, *adds):
    """Add rows and run the stream to their end, from the checkpoint of the step before."""
    for rows, schema, folder in adds:
        plain = spark.createDataFrame(rows, schema.replace("decimal(25,6)", "long"))
        plain.selectExpr(*[f"CAST({c.split()[0]} AS {c.split()[1]})" for c in schema.split(", ")]).write.mode("append").parquet(folder)
    with keyed.rocksdb_state(spark):
        writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{path}-checkpoint")
        query = writer.option("path", path).trigger(availableNow=True).start()
    query.awaitTermination()
    return query.recentProgress


def state_rows(progress):
    return [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]][-1]


def features(spark, stream, path):
    rows = keyed.by_row(spark.read.schema(stream.schema).parquet(path), keys=("account_id",)).collect()
    return {r["id"]: (r[count_name("account_id", "1day")], r[count_name("account_id", "3month")],
                      r[average_name("account_id", "3month")]) for r in rows}


def test_state_follows_arrival_and_marks_late_rows(spark):
    rows, folder = stream_of(spark, ROWS, "rows")
    stream, path = keyed.trailing_stream(rows, keys=("account_id",), late_days=2), new_path(spark, "out")
    first = [(1, "a", 1, 10, at(0)), (3, "a", 1, 30, at(1, 5)), (2, "a", 1, 20, at(1, 5)), (4, "b", 1, 1, at(1))]
    step(spark, stream, path, (first, ROWS, folder))
    # Nulls have no features; 6 is late but inside the days kept, 7 is too late; both come after 5 in a task.
    second = [(5, "a", 1, 40, at(91)), (6, "a", 1, 5, at(89)), (7, "a", 1, 7, at(0, 1)), (8, None, 1, 1, at(1)),
              (9, "b", 1, None, at(1)), (10, "b", 1, 3, None)]
    step(spark, stream, path, (second, ROWS, folder))
    found = features(spark, stream, path)
    assert found[1] == (1, 1, 10.0) and found[4] == (1, 1, 1.0)
    assert found[2] == (2, 2, 15.0) and found[3] == (3, 3, 20.0)
    assert found[7] == (2, 2, 8.5)
    assert found[6] == (1, 5, pytest.approx(72 / 5))
    assert found[5] == (1, 4, pytest.approx(95 / 4))
    assert set(found) == set(range(1, 8))
    late = {r["id"]: r["late"] for r in spark.read.parquet(path).collect()}
    assert not any(late[i] for i in (1, 2, 3, 4, 5, 6, 7))
    step(spark, stream, path, ([(11, "a", 1, 1, at(80)), (12, "a", 1, 1, at(90))], ROWS, folder))
    late = {r["id"]: r["late"] for r in spark.read.parquet(path).collect()}
    assert late[11] and not late[12]


def test_state_is_bounded_by_days_and_silent_keys_leave(spark):
    rows, folder = stream_of(spark, ROWS, "rows")
    stream = keyed.trailing_stream(rows, keys=("account_id",), horizons={"1day": 1, "1week": 7, "1month": 7, "3month": 7},
                                   late_days=0, ttl_ms=1)
    path = new_path(spark, "out")
    many = [(i, "a", 1, 1, at(i // 3)) for i in range(120)]
    step(spark, stream, path, (many[:60], ROWS, folder))
    progress = step(spark, stream, path, (many[60:], ROWS, folder))
    found = features(spark, stream, path)
    assert len(found) == 120 and found[119][0] == 6
    # Eight days, the time of arrival, the timer with its index and counters of the engine.
    assert state_rows(progress) <= 16
    progress = step(spark, stream, path, ([(200, "b", 1, 1, at(50))], ROWS, folder))
    progress = step(spark, stream, path, ([(201, "c", 1, 1, at(50))], ROWS, folder))
    assert state_rows(progress) <= 8
    step(spark, stream, path, ([(300, "a", 1, 4, at(40))], ROWS, folder))
    assert features(spark, stream, path)[300] == (1, 1, 4.0)


def test_waiting_transactions(spark):
    rows, row_folder = stream_of(spark, TRANSACTIONS, "rows")
    accounts, account_folder = stream_of(spark, ACCOUNTS, "accounts")
    joined = waiting.with_account_stream(rows, accounts, "2 days", "1 hour", account_ttl=3 * 86_400)
    path = new_path(spark, "joined")

    def arrive(transactions, versions):
        step(spark, joined, path, (transactions, TRANSACTIONS, row_folder), (versions, ACCOUNTS, account_folder))
        return {r["id"]: r for r in waiting.settled(spark.read.schema(joined.schema).parquet(path)).collect()}

    # 1: its account came first; 2: comes later; 3: never; 4: too late; 5: has no account id; 1 comes twice.
    found = arrive(
        [(1, "a", 1.0, at(1)), (1, "a", 1.0, at(1)), (2, "b", 2.0, at(1)), (3, "c", 3.0, at(1)), (4, "d", 4.0, at(1)),
         (5, None, 5.0, at(1))],
        [("a", 10, "x", at(0)), ("a", 11, "x", at(0, 12)), (None, 9, "x", at(0))],
    )
    assert {i: r["customer_id"] for i, r in found.items()} == {1: 11}
    found = arrive([(6, "a", 6.0, at(2))], [("b", 20, "y", at(2)), ("b", 21, "y", at(2, 1)), ("a", 12, "x", at(2, 1))])
    # A version that came after the transaction does not replace the one from before it.
    assert {i: r["customer_id"] for i, r in found.items()} == {1: 11, 2: 20, 6: 11}
    found = arrive([(7, "a", 7.0, at(20))], [("d", 40, "z", at(20))])
    # The version of "a" is too old for 7, and the one of "d" came too late for 4.
    found = arrive([(8, "z", 8.0, at(40))], [("z", 50, "z", at(40))])
    assert {i: r["customer_id"] for i, r in found.items()} == {1: 11, 2: 20, 3: None, 4: None, 5: None, 6: 11, 7: None, 8: 50}
    given_up = waiting.never_came(spark.read.schema(joined.schema).parquet(path))
    assert {r["id"] for r in given_up.collect()} == {3, 4, 5, 7}
    assert given_up.columns == ["id", "account_id", "amount", "arrived"]


def test_a_key_is_one_value_whatever_its_days(spark):
    rows, folder = stream_of(spark, ROWS, "rows")
    stream, path = keyed.trailing_stream(rows, keys=("account_id",)), new_path(spark, "out")
    progress = step(spark, stream, path, ([(i, "a", 1, 2, at(i)) for i in range(40)], ROWS, folder))
    # The value, the timer with its index and counters of the engine.
    assert state_rows(progress) <= 8
    step(spark, stream, path, ([(40, "a", 1, 43, at(40))], ROWS, folder))
    assert features(spark, stream, path)[40] == (2, 41, 3.0)
