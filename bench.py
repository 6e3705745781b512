"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; print one JSON line.

Each query first runs once on the smallest tables, then twice on the given ones; the faster of the
two counts, from building the plan to the last row. Trainings and the scoring stream run once.
"""

from __future__ import annotations

import json
import os
import sys
import time

from registry import inputs, models, streams, trailing
from tellerscore.operators import features, ml, parse
from tellerscore.plans.training import train
from tellerscore.session import build_session

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
SMALL = os.path.join(os.path.dirname(SF), "sf0.001")
CPUS = os.environ.get("BENCH_CPUS", "8")


def customer_features(source):
    def query(spark, sf):
        rows = source(spark, sf).select("id", "customer_id", "amount", "ts")
        return features.point_in_time(rows, keys=("customer_id",))

    return query


def all_features(spark, sf):
    rows = inputs.orders(spark, sf).select("id", "account_id", "customer_id", "amount", "ts")
    return features.calendar_flags(features.point_in_time(rows))


def written_first(spark, sf):
    """The way of inputs too large for one task: day totals are written and measured."""
    rows = inputs.orders(spark, sf).select("id", "customer_id", "amount", "ts")
    return features.point_in_time(rows, keys=("customer_id",), split_rows=1000)


def parse_inserts(spark, sf):
    return parse.transactions(inputs.order_records(spark, sf), parse.TENANT_A)[0]


def fit_and_score(kind):
    def query(spark, sf):
        rows = inputs.featured_events(spark, sf)
        model = train(rows, kind, ["id"]).model
        return ml.score(model, rows.drop("is_fraud")).select("id", "prediction")

    return query


QUERIES = {
    "feat_customer_orders": customer_features(inputs.orders),
    "feat_customer_events": customer_features(inputs.events),
    "feat_customer_orders_written": written_first,
    "feat_all_orders": all_features,
    "feat_as_of": trailing.QUERIES["feat_as_of"],
    "parse_inserts": parse_inserts,
    "score_batch": streams.score_batch,
    "stream_events": streams.QUERIES["micro_batch"],
    "score_stream": streams.score_stream,
    "ml_string_index": models.QUERIES["ml_string_index"],
    "ml_pipeline": models.QUERIES["ml_pipeline"],
    "ml_pipeline_scaled": models.QUERIES["ml_pipeline_scaled"],
    "fit_score_lr": fit_and_score("lr"),
    "fit_score_svm": fit_and_score("svm"),
    "fit_score_mlp": fit_and_score("mlp"),
}


#: Whole trainings and streams.
ONCE = ("fit_score_lr", "fit_score_svm", "fit_score_mlp", "ml_pipeline", "ml_pipeline_scaled", "score_stream")


def run(query, spark, sf):
    started = time.time()
    query(spark, sf).write.format("noop").mode("overwrite").save()
    return round(time.time() - started, 3)


def main():
    spark = build_session(
        "bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__ui__enabled="false", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or QUERIES:
        query = QUERIES[name]
        run(query, spark, SMALL)
        runs = 1 if name in ONCE else 2
        times[name] = min(run(query, spark, SF) for _ in range(runs))
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": SF}))
    spark.stop()


if __name__ == "__main__":
    main()
