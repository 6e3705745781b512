"""The trailing features in their three forms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry import inputs
from tellerscore.operators import corrections, features
from tellerscore.schemas import HORIZONS, KEYS, average_name, count_name
from tellerscore.session import materialize

CUT = "2024-01-16 12:00:00"


def _averages(key):
    return [average_name(key, h) for h in HORIZONS]


def _counts(key):
    return [count_name(key, h) for h in HORIZONS]


def _rows(df):
    return df.select("id", "account_id", "customer_id", "amount", "ts")


def _pit(source, keys, wanted):
    def query(spark, sf):
        rows = _rows(getattr(inputs, source)(spark, sf))
        return features.point_in_time(rows, keys=keys).select("id", *wanted)

    return query


def join_history(spark, sf):
    rows = _rows(inputs.events(spark, sf))
    names = [c for k in KEYS for c in _averages(k) + _counts(k)]
    return features.point_in_time(rows).select("id", *names)


def feat_rollup(spark, sf):
    """Events in two parts: the later part sees the earlier one through its stored day totals and
    the raw rows of the days both share."""
    rows = _rows(inputs.events(spark, sf))
    cut = F.lit(CUT).cast("timestamp")
    old, new = rows.where(F.col("ts") < cut), rows.where(F.col("ts") >= cut)
    totals = features.day_totals(old)
    past = {key: t.frame for key, t in totals.items()}
    same_days = old.where(F.to_date("ts") >= F.to_date(cut))
    first = features.point_in_time(old, totals=totals)
    second = features.point_in_time(new, past_totals=past, past_rows=same_days)
    names = [c for k in ("customer_id", "account_id") for c in _averages(k) + _counts(k)]
    return first.unionByName(second).select("id", *names)


def feat_as_of(spark, sf):
    rows = _rows(inputs.orders(spark, sf))
    accounts = rows.select("customer_id").distinct()
    as_of = F.lit("2001-08-01").cast("date")
    return features.as_of_features(accounts, rows, as_of, keys=("customer_id",))


def late_rows(spark, sf):
    """Every event scored against the last day: rows older than a horizon may find it empty."""
    rows = _rows(inputs.events(spark, sf))
    day = F.lit("2024-01-30").cast("date")
    scored = features.as_of_features(rows, rows, day)
    averages, counts = ([c for k in KEYS for c in names(k)] for names in (_averages, _counts))
    return scored.select("id", *averages, *counts, features.incomplete(averages).alias("incomplete"))


def _on_time(spark, sf):
    """Events that came in time, and the clicks of the first half of the month, which came after all others."""
    rows = _rows(inputs.events(spark, sf)).withColumn("event_day", F.to_date("ts"))
    clicks = inputs.events(spark, sf).where("op_type = 'click'").select("id")
    early = rows.where(F.col("ts") < F.lit(CUT).cast("timestamp"))
    late = materialize(early.join(clicks.hint("merge"), "id", "left_semi"), "late-rows")
    return materialize(rows.join(late.select("id").hint("merge"), "id", "left_anti"), "history"), late


def late_corrections(spark, sf):
    """A first pass without the late events, then corrections of what they change."""
    history, late = _on_time(spark, sf)
    totals = features.day_totals(history)
    names = [c for k in KEYS for c in _averages(k) + _counts(k)]
    first = features.point_in_time(history, totals=totals).select("id", *names)
    changes = corrections.corrections(late, history, {k: t.frame for k, t in totals.items()})
    return corrections.corrected(first, changes).select("id", *names)


def late_reach(spark, sf):
    """Which events the late ones change, by key column."""
    history, late = _on_time(spark, sf)
    changes = corrections.corrections(late, history, {k: t.frame for k, t in features.day_totals(history).items()})
    return reduce(DataFrame.unionByName, [c.select(F.lit(k).alias("key"), "id", "late") for k, c in changes.items()])


def calendar_flags(spark, sf):
    return features.calendar_flags(inputs.events(spark, sf)).select(
        "id", "transaction_in_weekend", "transaction_at_night"
    )


QUERIES = {
    "feat_customer_avg": _pit("orders", ("customer_id",), _averages("customer_id")),
    "feat_customer_count": _pit("orders", ("customer_id",), _counts("customer_id")),
    "feat_account_avg": _pit("orders", ("account_id",), _averages("account_id")),
    "feat_account_count": _pit("orders", ("account_id",), _counts("account_id")),
    "feat_customer_pit": _pit("events", ("customer_id",), _averages("customer_id") + _counts("customer_id")),
    "feat_account_pit": _pit("events", ("account_id",), _averages("account_id") + _counts("account_id")),
    "join_history": join_history,
    "feat_rollup": feat_rollup,
    "feat_as_of": feat_as_of,
    "late_rows": late_rows,
    "late_corrections": late_corrections,
    "late_reach": late_reach,
    "calendar_flags": calendar_flags,
}

_SOURCES = {
    "orders": "SELECT o_orderkey AS id, o_custkey AS account_id, o_custkey // 3 AS customer_id, CAST(o_totalprice AS DECIMAL(25,6)) AS amount, o_orderdate AS ts FROM orders",
    "inserts": "SELECT o_orderkey AS id, o_custkey AS account_id, o_custkey // 3 AS customer_id, CAST(o_totalprice AS DECIMAL(25,6)) AS amount, o_orderdate AS ts FROM orders WHERE o_orderstatus <> 'P'",
    "known_events": "SELECT event_id AS id, 'U' || user_id AS account_id, c_custkey // 3 AS customer_id, CAST(value AS DECIMAL(25,6)) AS amount, ts FROM events JOIN customer ON user_id = c_custkey",
    "events": "SELECT event_id AS id, user_id AS account_id, user_id // 3 AS customer_id, CAST(value AS DECIMAL(25,6)) AS amount, ts FROM events",
}


_LATE = f"""
    SELECT event_id AS id, user_id AS account_id, user_id // 3 AS customer_id, ts,
           event_type = 'click' AND ts < TIMESTAMP '{CUT}' AS came_late FROM events"""


def pit_columns(key, horizons, averages=True, counts=True):
    """SQL of the trailing columns over a join of rows ``a`` with their history ``b``."""
    columns = []
    for name, days in horizons.items():
        inside = f"FILTER (WHERE CAST(b.ts AS DATE) >= CAST(a.ts AS DATE) - {days})"
        if averages:
            columns.append(
                f"CAST(SUM(b.amount) {inside} AS DOUBLE) / COUNT(*) {inside} AS {average_name(key, name)}"
            )
        if counts:
            columns.append(f"CAST(COUNT(*) {inside} AS INT) AS {count_name(key, name)}")
    return ", ".join(columns)


def pit_sql(source, key, horizons=HORIZONS, averages=True, counts=True):
    t = _SOURCES[source]
    columns = pit_columns(key, horizons, averages, counts)
    return f"""
        SELECT a.id, {columns} FROM ({t}) a
        JOIN ({t}) b ON a.{key} = b.{key} AND (b.ts < a.ts OR (b.ts = a.ts AND b.id <= a.id))
        GROUP BY a.id"""


def _late_sql():
    """Every event against 2024-01-30, with the horizons of both keys."""
    ctes, joins, columns, averages = [], [], [], []
    for key in KEYS:
        sums = []
        for name, days in HORIZONS.items():
            inside = f"FILTER (WHERE d >= DATE '2024-01-30' - {days})"
            sums.append(f"COUNT(*) {inside} AS n_{name}, CAST(SUM(amount) {inside} AS DOUBLE) AS s_{name}")
            columns.append(f"{key}_t.s_{name} / NULLIF({key}_t.n_{name}, 0) AS {average_name(key, name)}")
            columns.append(f"CAST({key}_t.n_{name} AS INT) AS {count_name(key, name)}")
            averages.append(f"{key}_t.n_{name} = 0")
        ctes.append(f"{key}_t AS (SELECT {key}, {', '.join(sums)} FROM e GROUP BY 1)")
        joins.append(f"JOIN {key}_t ON e.{key} = {key}_t.{key}")
    return f"""
        WITH e AS (SELECT *, CAST(ts AS DATE) AS d FROM ({_SOURCES['events']})), {', '.join(ctes)}
        SELECT id, {', '.join(columns)}, {' OR '.join(averages)} AS incomplete FROM e {' '.join(joins)}"""


ORACLE = {
    "feat_customer_avg": pit_sql("orders", "customer_id", counts=False),
    "feat_customer_count": pit_sql("orders", "customer_id", averages=False),
    "feat_account_avg": pit_sql("orders", "account_id", counts=False),
    "feat_account_count": pit_sql("orders", "account_id", averages=False),
    "feat_customer_pit": pit_sql("events", "customer_id"),
    "feat_account_pit": pit_sql("events", "account_id"),
    "join_history": f"""
        SELECT * FROM ({pit_sql("events", "customer_id")}) JOIN ({pit_sql("events", "account_id")}) USING (id)""",
    "feat_rollup": f"""
        SELECT * FROM ({pit_sql("events", "customer_id")}) JOIN ({pit_sql("events", "account_id")}) USING (id)""",
    "feat_as_of": "SELECT customer_id, "
    + ", ".join(
        f"CAST(SUM(amount) FILTER (WHERE d >= DATE '2001-08-01' - {n}) AS DOUBLE) / NULLIF(COUNT(*) FILTER (WHERE d >= DATE '2001-08-01' - {n}), 0) AS {average_name('customer_id', h)}, "
        f"CAST(COUNT(*) FILTER (WHERE d >= DATE '2001-08-01' - {n}) AS INT) AS {count_name('customer_id', h)}"
        for h, n in HORIZONS.items()
    )
    + f" FROM (SELECT *, CAST(ts AS DATE) AS d FROM ({_SOURCES['orders']})) GROUP BY customer_id",
    "late_rows": _late_sql(),
    "late_corrections": f"""
        SELECT * FROM ({pit_sql("events", "customer_id")}) JOIN ({pit_sql("events", "account_id")}) USING (id)""",
    "late_reach": f"WITH e AS ({_LATE})" + " UNION ALL ".join(
        f"""
        SELECT '{key}' AS key, id, came_late AS late FROM e
        WHERE came_late OR EXISTS (
            SELECT 1 FROM e l WHERE l.came_late AND l.{key} = e.{key} AND (l.ts < e.ts OR (l.ts = e.ts AND l.id < e.id))
                AND CAST(l.ts AS DATE) >= CAST(e.ts AS DATE) - {max(HORIZONS.values())})"""
        for key in KEYS
    ),
    "calendar_flags": """
        SELECT event_id AS id, CAST(isodow(ts) >= 6 AS INT) AS transaction_in_weekend,
               CAST(hour(ts) >= 22 OR hour(ts) < 6 AS INT) AS transaction_at_night FROM events""",
}


def featured_sql(source):
    """Every row of a source with all features of both keys and the calendar flags."""
    return f"""
        SELECT t.id, CAST(t.amount AS DOUBLE) AS amount, c.* EXCLUDE (id), a.* EXCLUDE (id),
               CAST(isodow(t.ts) >= 6 AS INT) AS transaction_in_weekend,
               CAST(hour(t.ts) >= 22 OR hour(t.ts) < 6 AS INT) AS transaction_at_night
        FROM ({_SOURCES[source]}) t JOIN ({pit_sql(source, "customer_id")}) c ON t.id = c.id
        JOIN ({pit_sql(source, "account_id")}) a ON t.id = a.id"""
