import datetime
import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tellerscore.operators import parse
from tellerscore.operators.dedupe import without_repeats
from tellerscore.session import new_path, shared_folder
from tellerscore.sinks import notify
from tellerscore.sinks.index import conform, write_index
from tellerscore.sources.cdc import cdc_stream
from tellerscore.streaming.jobs import AccountJob, ScoringJob, Tables
from tests.records import account_a, account_b, records, transaction_a, transaction_b

DAY = 86_400_000
T0 = 1_704_067_200_000  # 2024-01-01


@pytest.fixture
def tables(spark):
    return Tables(new_path(spark, "deployment"), parse.TENANT_A)


def scored(spark, tables):
    return {r["transaction-id"]: r for r in tables.scored.read(spark).collect()}


def send_accounts(spark, tables, values, epoch=0, start=0):
    AccountJob(tables, parse.TENANT_A).process(records(spark, values, start), epoch)


class CountRule:
    """Stands in for a model: more than two transactions of the account in a day are fraud."""

    def transform(self, df):
        many = (F.col("account_id_count_1day") > 2).cast("double")
        return df.withColumn("prediction", many)


def test_pending_transactions_wait_for_their_account(spark, tables):
    job = ScoringJob(tables, parse.TENANT_A)
    send_accounts(spark, tables, [account_a(10, 1)])
    job.process(records(spark, [transaction_a(1, 10, 10**6, T0), transaction_a(2, 20, 10**6, T0)]), 0)
    assert set(scored(spark, tables)) == {1}
    job.process(records(spark, [transaction_a(3, 10, 10**6, T0)], 2), 1)
    assert set(scored(spark, tables)) == {1, 3}
    send_accounts(spark, tables, [account_a(20, 2)], 1)
    job.process(records(spark, [transaction_a(4, 10, 10**6, T0)], 3), 2)
    rows = scored(spark, tables)
    assert set(rows) == {1, 2, 3, 4} and rows[2]["customer-id"] == 2
    job.process(records(spark, [transaction_a(5, 10, 10**6, T0)], 4), 3)
    assert tables.scored.read(spark).count() == 5


def test_a_micro_batch_leaves_no_intermediate_tables(spark, tables):
    here = Path(shared_folder(spark)) / "tellerscore" / spark.sparkContext.applicationId
    send_accounts(spark, tables, [account_a(10, 1)])
    before = {p.name for p in here.iterdir()}
    ScoringJob(tables, parse.TENANT_A).process(records(spark, [transaction_a(1, 10, 10**6, T0)]), 0)
    assert {p.name for p in here.iterdir()} == before
    assert set(scored(spark, tables)) == {1}


def test_console(spark, capfd):
    folder = new_path(spark, "records")
    records(spark, ["one", "two", "three"]).write.json(folder)
    query = notify.show_stream(cdc_stream(spark, "json", folder), f"{folder}-checkpoint", availableNow=True)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 3


def test_bad_records_are_set_aside(spark, tables):
    send_accounts(spark, tables, [account_a(10, 1), "broken"])
    good = transaction_a(1, 10, 10**6, T0)
    update = json.loads(transaction_a(2, 10, 10**6, T0))
    update["payload"]["before"] = {}
    job = ScoringJob(tables, parse.TENANT_A)
    job.process(records(spark, [good, json.dumps(update), None, good[:-5]]), 0)
    assert set(scored(spark, tables)) == {1}
    assert sorted(r.reason for r in tables.bad_transactions.read(spark).collect()) == ["malformed", "tombstone"]
    assert [r.reason for r in tables.bad_accounts.read(spark).collect()] == ["malformed"]
    job.process(records(spark, ["nothing of use"], 4), 1)
    assert tables.bad_transactions.read(spark).count() == 3


def encoded(millionths):
    import base64

    return base64.b64encode(millionths.to_bytes(11, "big")).decode()


def test_no_record_stops_a_micro_batch(spark, tables):
    """Times and amounts outside what dates and exact sums can hold."""
    send_accounts(spark, tables, [account_a(10, 1)])
    year_10000, year_1 = 253_402_300_800_000, -62_135_596_800_000
    times = [T0 * 1000, 2**63 - 1, -(2**63), year_1, year_10000]
    values = [transaction_a(100 + i, 10, 10**6, ms) for i, ms in enumerate(times)]
    large = json.loads(transaction_a(200, 10, 10**6, T0))
    large["payload"]["after"]["amount"] = encoded(10**25 - 1)
    good = transaction_a(1, 10, 10**6, T0)
    ScoringJob(tables, parse.TENANT_A).process(records(spark, [*values, json.dumps(large), good]), 0)
    assert set(scored(spark, tables)) == {1}
    assert [r.reason for r in tables.bad_transactions.read(spark).collect()] == ["unusable field"] * 6


def test_no_record_of_the_other_tenant_stops_a_micro_batch(spark):
    tables = Tables(new_path(spark, "deployment"), parse.TENANT_B)
    AccountJob(tables, parse.TENANT_B).process(records(spark, [account_b("10", 1, "SA")]), 0)
    times = [2**63 - 1, -(2**63), -62_135_596_800_000_000, 253_402_300_800_000_000]
    values = [transaction_b(100 + i, "10", 1.0, us, "T", "d") for i, us in enumerate(times)]
    values += [transaction_b(200 + i, "10", a, T0 * 1000, "T", "d") for i, a in enumerate([1e19, -1e300, 1e25])]
    good = transaction_b(1, "10", 2.0, T0 * 1000, "T", "d")
    ScoringJob(tables, parse.TENANT_B).process(records(spark, [*values, good]), 0)
    assert [r["transaction-id"] for r in tables.scored.read(spark).collect()] == [1]
    assert [r.reason for r in tables.bad_transactions.read(spark).collect()] == ["unusable field"] * 7


def test_a_known_id_with_another_day_is_skipped(spark, tables):
    send_accounts(spark, tables, [account_a(10, 1)])
    job = ScoringJob(tables, parse.TENANT_A)
    job.process(records(spark, [transaction_a(1, 10, 10**6, T0)]), 0)
    job.process(records(spark, [transaction_a(1, 10, 10**6, T0 + 3 * DAY), transaction_a(2, 10, 10**6, T0 + 3 * DAY)], 1), 1)
    assert tables.scored.read(spark).count() == 2 and tables.history.read(spark).count() == 2


def test_a_later_version_wins_whatever_its_offset(spark, tables):
    send_accounts(spark, tables, [account_a(10, 1)], 0, start=1000)
    send_accounts(spark, tables, [account_a(10, 2)], 1, start=0)
    ScoringJob(tables, parse.TENANT_A).process(records(spark, [transaction_a(1, 10, 10**6, T0)]), 0)
    assert scored(spark, tables)[1]["customer-id"] == 2


def test_a_lost_checkpoint_loses_nothing(spark, tables):
    send_accounts(spark, tables, [account_a(10, 1)])
    for n in (1, 2):  # the second run has no checkpoint, and numbers its micro-batches from 0 again
        folder = new_path(spark, "records")
        values = [transaction_a(i, 10, 10**6, T0 + i) for i in range(1, n + 1)]
        records(spark, values).write.json(folder)
        job = ScoringJob(tables, parse.TENANT_A)
        job.start(cdc_stream(spark, "json", folder), availableNow=True).awaitTermination()
        fs, checkpoint = tables.scored._file(spark, f"{tables.root}/_checkpoint_transactions")
        fs.delete(checkpoint, True)
    assert set(scored(spark, tables)) == {1, 2} and tables.history.read(spark).count() == 2


def test_the_anchor_day_is_fixed_once_per_micro_batch(spark, tables):
    send_accounts(spark, tables, [account_a(10, 1)])
    tables.anchors.write(spark.createDataFrame([(datetime.date(2024, 1, 3),)], tables.anchors.schema), 0)
    job = ScoringJob(tables, parse.TENANT_A, as_of="today", send_alerts=False)
    values = [transaction_a(1, 10, 10**6, T0), transaction_a(2, 10, 3 * 10**6, T0 + 2 * DAY)]
    for _ in range(2):
        job.process(records(spark, values), 0)
        rows = {r.id: r for r in tables.features.read(spark).collect()}
        assert {r.account_id_count_1day for r in rows.values()} == {1}
        assert {r.customer_id_avrge_amount_1week for r in rows.values()} == {2.0}
    assert not rows[1].incomplete and tables.alerts.read(spark).count() == 0
    job.process(records(spark, [transaction_a(3, 10, 10**6, T0)], 5), 1)
    row = tables.features.read(spark, only=1).first()
    assert row.incomplete and row.account_id_count_3month == 0


def test_waiting_ends_in_quarantine(spark, tables):
    job = ScoringJob(tables, parse.TENANT_A, pending_days=2)
    job.process(records(spark, [transaction_a(1, 10, 10**6, T0), transaction_a(2, 20, 10**6, T0)]), 0)
    old = F.when(F.col("id") == 1, F.col("since") - F.expr("INTERVAL 3 DAYS")).otherwise(F.col("since"))
    tables.pending.write(tables.pending.read(spark, only=0).withColumn("since", old), 1)
    job.process(records(spark, [transaction_a(3, 30, 10**6, T0)], 2), 2)
    assert {r.id for r in tables.pending.read(spark, only=2).collect()} == {2, 3}
    bad = tables.bad_transactions.read(spark).collect()
    assert [(json.loads(r.value)["id"], r.reason) for r in bad] == [(1, "account never came")]
    send_accounts(spark, tables, [account_a(20, 2)])
    job.process(records(spark, [transaction_a(4, 20, 10**6, T0)], 3), 3)
    assert set(scored(spark, tables)) == {2, 4}


def test_file_formats_are_refused_as_an_index(spark, tables):
    rows = spark.createDataFrame([], tables.scored.schema)
    with pytest.raises(ValueError, match="parquet"):
        write_index(rows, "parquet", tables.scored.schema, path="anywhere")


def test_jobs_merge_their_tables(spark, tables):
    accounts = AccountJob(tables, parse.TENANT_A, compact_every=2)
    job = ScoringJob(tables, parse.TENANT_A, CountRule(), compact_every=2)
    for i in range(5):
        accounts.process(records(spark, [account_a(10, i)], i), i)
        job.process(records(spark, [transaction_a(i, 10, 10**6, T0 + i)], i), i)
    assert tables.day_totals["account_id"]._base(spark, None) == tables.accounts._base(spark, None) == 4
    counts = {r.id: r.account_id_count_1day for r in tables.features.read(spark).collect()}
    assert counts == {i: i + 1 for i in range(5)}
    labels = {r.id: r.is_fraud for r in tables.features.read(spark).collect()}
    assert [labels[i] for i in range(5)] == ["valid", "valid", "fraudulent", "fraudulent", "fraudulent"]


def test_the_job_lets_go_of_days_past_retention(spark, tables):
    """Days count back from the newest one that is not in the future; what they were scored as stays."""
    job = ScoringJob(tables, parse.TENANT_A, CountRule(), compact_every=2)
    send_accounts(spark, tables, [account_a(10, 1)])
    future = 4_102_444_800_000  # 2100-01-01
    times = [T0, T0 + 9 * DAY, T0 + 100 * DAY, future]
    job.process(records(spark, [transaction_a(i, 10, 10**6, t) for i, t in enumerate(times)]), 0)
    job.process(records(spark, [transaction_a(5, 10, 10**6, T0 + DAY)], 5), 1)
    third = records(spark, [transaction_a(6, 10, 10**6, T0 + 100 * DAY + 1), transaction_a(2, 10, 1, T0)], 6)
    for _ in range(2):
        job.process(third, 2)
    left = {str(r["event_day"]) for r in tables.history.read(spark).collect()}
    assert left == {"2024-01-10", "2024-04-10", "2100-01-01"}
    days = {str(r["day"]) for r in tables.day_totals["account_id"].read(spark, before=2).collect()}
    assert days == left
    assert {r["id"] for r in tables.known.ids.read(spark, before=2).collect()} == {1, 2, 3}
    assert set(scored(spark, tables)) == {0, 1, 2, 3, 5, 6}
    counts = {r["id"]: r["account_id_count_3month"] for r in tables.features.read(spark).collect()}
    assert counts[6] == 2 and counts[2] == 1


def test_repeated_ids(spark, tables):
    send_accounts(spark, tables, [account_a(10, 1)])
    job = ScoringJob(tables, parse.TENANT_A)
    job.process(records(spark, [transaction_a(1, 10, 10**6, T0), transaction_a(1, 10, 3 * 10**6, T0)]), 0)
    assert scored(spark, tables)[1].amount == 3.0
    job.process(records(spark, [transaction_a(1, 10, 3 * 10**6, T0), transaction_a(2, 10, 10**6, T0)], 2), 1)
    assert tables.scored.read(spark).count() == 2 and tables.history.read(spark).count() == 2


def test_an_account_may_change_its_customer(spark, tables):
    send_accounts(spark, tables, [account_a(10, 1)])
    job = ScoringJob(tables, parse.TENANT_A)
    job.process(records(spark, [transaction_a(1, 10, 10**6, T0)]), 0)
    send_accounts(spark, tables, [account_a(10, 2, before={"id": 10})], 1, start=1)
    job.process(records(spark, [transaction_a(2, 10, 10**6, T0 + 1000)], 1), 1)
    rows = scored(spark, tables)
    assert (rows[1]["customer-id"], rows[2]["customer-id"]) == (1, 2)
    totals = {(r.key, r.n) for r in tables.day_totals["customer_id"].read(spark).collect()}
    assert totals == {(1, 1), (2, 1)}


def transactions(n=60):
    """One account holds most of the transactions, spread over some days."""
    return [
        transaction_a(i, 10 if i % 3 else 20 + i % 2, (i % 7 + 1) * 10**6, T0 + (i // 6) * DAY + i * 1000, i % 3)
        for i in range(n)
    ]


def test_stream_equals_one_batch_and_survives_replays(spark):
    accounts = [account_a(10, 1), account_a(20, 2), account_a(21, 2)]
    results, alerts = [], []
    for cuts in ([(0, 60)], [(0, 13), (13, 14), (14, 47), (47, 60)]):
        tables = Tables(new_path(spark, "deployment"), parse.TENANT_A)
        send_accounts(spark, tables, accounts)
        job = ScoringJob(tables, parse.TENANT_A, CountRule(), recipient="desk", signature="The bank")
        values = transactions()
        for epoch, (start, end) in enumerate(cuts):
            job.process(records(spark, values[start:end], start), epoch)
        if len(cuts) > 1:
            again = len(cuts) - 2
            start, end = cuts[again]
            job.process(records(spark, values[start:end], start), again)
        results.append(sorted(map(repr, tables.scored.read(spark).collect())))
        alerts.append(sorted(map(repr, tables.alerts.read(spark).collect())))
        assert tables.history.read(spark).count() == 60
    assert results[0] == results[1] and len(results[0]) == 60
    assert alerts[0] == alerts[1] and 0 < len(alerts[0]) < 60


def test_compaction_changes_nothing_but_files(spark, tables):
    send_accounts(spark, tables, [account_a(10, 1), account_a(20, 2), account_a(21, 2)])
    send_accounts(spark, tables, [account_a(10, 1)], 1, start=3)
    plain = Tables(new_path(spark, "deployment"), parse.TENANT_A)
    send_accounts(spark, plain, [account_a(10, 1), account_a(20, 2), account_a(21, 2)])
    values = transactions()
    for epoch, (start, end) in enumerate([(0, 20), (20, 40), (40, 60)]):
        for target in (tables, plain):
            job = ScoringJob(target, parse.TENANT_A, CountRule())
            job.process(records(spark, values[start:end], start), epoch)
        tables.compact(spark, epoch, 2, datetime.date(2024, 1, 10))
        for table in (tables.accounts, tables.history, *tables.day_totals.values()):
            table.vacuum(spark)
    assert sorted(map(repr, tables.scored.read(spark).collect())) == sorted(map(repr, plain.scored.read(spark).collect()))
    assert tables.history.read(spark).count() == 60
    # A base that lacks its marker was not finished and is not read.
    fs, unfinished = tables.history._file(spark, f"{tables.history.path}_base/9")
    fs.mkdirs(unfinished)
    assert tables.history.read(spark).count() == 60


def test_late_rows_and_one_anchor_day(spark, tables):
    send_accounts(spark, tables, [account_a(10, 1)])
    job = ScoringJob(tables, parse.TENANT_A, CountRule(), as_of=datetime.date(2024, 1, 10))
    day_10 = T0 + 9 * DAY
    job.process(records(spark, [transaction_a(i, 10, 10**6, day_10 + i) for i in range(2)]), 0)
    assert {r.is_fraud for r in scored(spark, tables).values()} == {"valid"}
    # A row of January 2 is judged by what the account did until January 10.
    job.process(records(spark, [transaction_a(7, 10, 10**6, T0 + DAY), transaction_a(8, 10, 10**6, day_10 + 9)], 2), 1)
    assert scored(spark, tables)[7].is_fraud == "fraudulent"


def test_tenant_b_through_file_streams(spark):
    tables = Tables(new_path(spark, "deployment"), parse.TENANT_B)
    folder = new_path(spark, "records")
    records(spark, [account_b("U1", 5, "SA")]).write.json(f"{folder}/accounts")
    values = [transaction_b(i, "U1", 1.5 * i, T0 * 1000 + 3_600_000_000, "IN", "gift") for i in range(1, 5)]
    records(spark, values).repartition(2).write.json(f"{folder}/transactions")
    AccountJob(tables, parse.TENANT_B).start(
        cdc_stream(spark, "json", f"{folder}/accounts"), availableNow=True
    ).awaitTermination()
    ScoringJob(tables, parse.TENANT_B).start(
        cdc_stream(spark, "json", f"{folder}/transactions", maxFilesPerTrigger="1"), availableNow=True
    ).awaitTermination()
    rows = tables.scored.read(spark)
    assert rows.schema == parse.TENANT_B.scored and rows.count() == 4
    row = rows.where("`transaction-id` = 2").first()
    assert (row["account-id"], row["Customer-id"], row["operation-date"]) == ("U1", 5, "2024-01-01 00:00:00")
    assert (row["account_type"], row["transaction-description"]) == ("Saving Account", "gift")


def test_alerts_reach_the_notifier(spark, tables):
    send_accounts(spark, tables, [account_a(10, 1)])
    out = new_path(spark, "messages")
    job = ScoringJob(
        tables, parse.TENANT_A, CountRule(), notify=lambda alerts: notify.send(alerts, "subject", "text", out)
    )
    job.process(records(spark, [transaction_a(i, 10, 10**6, T0 + i) for i in range(3)]), 0)
    (message,) = spark.read.text(out).collect()
    assert json.loads(message.value)["message"].startswith("Urgent")
    chat = json.loads(tables.alerts.read(spark).first().chat)
    assert chat["attachments"][0]["color"] == "danger" and "Amount: $1.0\n" in chat["attachments"][0]["text"]


def test_sink_refuses_other_columns(spark):
    schema = spark.createDataFrame([], "a int, b string").schema
    with pytest.raises(ValueError, match="missing"):
        conform(spark.createDataFrame([(1,)], "a int"), schema)
    assert conform(spark.createDataFrame([("x", "1")], "b string, a string"), schema).schema == schema


BROKER = "value string, partition int, offset long, topic string, timestamp timestamp"


def arrivals(spark, folder, values, topic="t", start=0):
    rows = [(v, 0, start + i, topic, datetime.datetime(2024, 1, 1)) for i, v in enumerate(values)]
    spark.createDataFrame(rows, BROKER).coalesce(1).write.mode("append").json(folder)


def test_repeats_are_dropped_across_micro_batches(spark):
    """Inserts are told apart by feed and id; other records and broken ones all pass; the state lets go."""
    folder, out = new_path(spark, "records"), new_path(spark, "single")
    insert, update = transaction_a(1, 10, 10**6, T0), transaction_a(1, 10, 10**6, T0).replace('"before": null', '"before": {}')
    arrivals(spark, folder, [insert, insert, update, update, "broken", "broken", transaction_a(2, 10, 10**6, T0)])
    arrivals(spark, folder, [insert, transaction_a(3, 10, 10**6, T0)], start=7)
    arrivals(spark, folder, [insert], topic="other")

    def run():
        stream = without_repeats(cdc_stream(spark, "json", folder, maxFilesPerTrigger="1"), "2 seconds")
        assert stream.columns == ["value", "partition", "offset", "topic", "broker_time"]
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-c").trigger(availableNow=True).start()
        query.awaitTermination()
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]

    kept = run()
    ids = sorted((r.topic, json.loads(r.value)["payload"]["after"]["id"]) for r in spark.read.parquet(out).collect() if r.value not in ("broken", update))
    assert ids == [("other", 1), ("t", 1), ("t", 2), ("t", 3)]
    assert spark.read.parquet(out).count() == 4 + 2 + 2
    time.sleep(3)
    for i in range(2):  # a watermark moves with the micro-batch after the one that passed it
        arrivals(spark, folder, [transaction_a(50 + i, 10, 10**6, T0)], start=50 + i)
        left = run()
    assert left < kept


def test_a_scoring_stream_without_repeats(spark, tables):
    folder = new_path(spark, "records")
    send_accounts(spark, tables, [account_a(10, 1)])
    arrivals(spark, folder, [transaction_a(1, 10, 10**6, T0)] * 3 + [transaction_a(2, 10, 10**6, T0)])
    ScoringJob(tables, parse.TENANT_A, repeat_delay="1 hour").start(cdc_stream(spark, "json", folder), availableNow=True).awaitTermination()
    assert set(scored(spark, tables)) == {1, 2} and tables.history.read(spark).count() == 2


def test_the_broker_s_time_decides_between_partitions(spark, tables):
    """The later record has the smaller offset, in another partition and in the same one, made anew."""
    noon = datetime.datetime(2024, 1, 1, 12)
    rows = [(account_a(10, 1), 0, 900, "a", noon), (account_a(10, 2), 1, 5, "a", noon + datetime.timedelta(hours=1)), (account_a(20, 3), 0, 901, "a", noon), (account_a(20, 4), 0, 0, "a", noon + datetime.timedelta(hours=1))]
    folder = new_path(spark, "records")
    spark.createDataFrame(rows, BROKER).write.json(f"{folder}/accounts")
    AccountJob(tables, parse.TENANT_A).start(cdc_stream(spark, "json", f"{folder}/accounts"), availableNow=True).awaitTermination()
    values = [(transaction_a(1, 10, 10**6, T0), 0, 70, "t", noon), (transaction_a(1, 10, 4 * 10**6, T0), 2, 1, "t", noon + datetime.timedelta(hours=1)), (transaction_a(2, 20, 10**6, T0), 0, 71, "t", noon)]
    spark.createDataFrame(values, BROKER).write.json(f"{folder}/transactions")
    ScoringJob(tables, parse.TENANT_A).start(cdc_stream(spark, "json", f"{folder}/transactions"), availableNow=True).awaitTermination()
    found = {i: (r["customer-id"], r["amount"]) for i, r in scored(spark, tables).items()}
    assert found == {1: (2, 4.0), 2: (4, 1.0)}


def test_shown_micro_batches_read_all_rows_and_send_the_first_ones(spark, capsys):
    folder = new_path(spark, "shown")
    spark.range(1000, 1500, numPartitions=7).write.json(folder)
    stream = spark.readStream.schema("id long").json(folder)
    query = notify.show_stream(stream, f"{folder}-checkpoint", rows=3, availableNow=True)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 500
    assert sum(line.startswith("|1") for line in capsys.readouterr().out.split("\n")) == 3
