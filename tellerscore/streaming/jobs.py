"""The two streaming jobs: the account dimension, and transaction scoring."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType

from tellerscore import schemas
from tellerscore.operators import features, parse
from tellerscore.operators.accounts import (
    latest_accounts,
    live_accounts,
    pending_only,
    resolved_only,
    with_account,
)
from tellerscore.operators.alerts import alert_rows
from tellerscore.operators.dedupe import dedupe_transactions, without_repeats
from tellerscore.operators.history import HISTORY_DAYS, retained
from tellerscore.operators.parse import Tenant, project_scored
from tellerscore.plans.scoring import label
from tellerscore.session import concurrently, materialize, scratch_scope
from tellerscore.sinks.index import write_index
from tellerscore.streaming.buckets import BucketedTable
from tellerscore.streaming.known import KnownIds
from tellerscore.streaming.tables import EpochTable

QUARANTINE = StructType(
    [
        StructField("value", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("reason", StringType()),
    ]
)
ALERTS = StructType(
    [StructField("id", LongType())]
    + [StructField(n, StringType()) for n in ("channel", "recipient", "subject", "chat", "mail")]
)


class Tables:
    """The tables of one deployment, all below one folder."""

    def __init__(self, root: str, tenant: Tenant):
        account = type(tenant.account_id)
        self.root = root
        self.accounts = BucketedTable(f"{root}/accounts", schemas.account_dimension(account), key="account_id")
        self.known = KnownIds(root)
        self.history = EpochTable(f"{root}/history", schemas.history(account), ("event_day",))
        kinds = {"customer_id": LongType(), "account_id": tenant.account_id}
        self.day_totals = {
            key: EpochTable(f"{root}/day_totals_{key}", schemas.day_totals(kind), ("day",))
            for key, kind in kinds.items()
        }
        self.pending = EpochTable(f"{root}/pending", schemas.pending(account))
        self.scored = EpochTable(f"{root}/scored", tenant.scored)
        self.features = EpochTable(f"{root}/features", schemas.featured())
        self.alerts = EpochTable(f"{root}/alerts", ALERTS)
        self.anchors = EpochTable(f"{root}/anchors", StructType([StructField("day", DateType())]))
        self.bad_transactions = EpochTable(f"{root}/quarantine_transactions", QUARANTINE)
        self.bad_accounts = EpochTable(f"{root}/quarantine_accounts", QUARANTINE)


    def compact(self, spark: SparkSession, epoch: int, account_epoch: int, today: datetime.date) -> None:
        """Merge the state of finished micro-batches, and let go of days past retention.

        Keeps the number of files that each micro-batch has to list and read from growing.
        """
        self.accounts.compact(spark, account_epoch, latest_accounts)
        self.history.compact(spark, epoch, lambda rows: retained(rows, today))
        self.known.compact(spark, epoch, today - datetime.timedelta(days=HISTORY_DAYS))
        oldest = F.date_sub(F.lit(today), HISTORY_DAYS)
        for table in self.day_totals.values():
            table.compact(spark, epoch, lambda rows: features.sum_by_day(rows.where(F.col("day") >= oldest)))

    def retire(self, spark: SparkSession, epoch: int, today: datetime.date) -> None:
        """Merge known ids and day totals of the micro-batches before ``epoch``, and let go of days past retention.

        Retention counts back from the newest stored day, but from ``today`` at most: a backfill keeps what its own
        rows need, and a row from the future retires nothing. History is retired by deleting folders of days.
        """
        totals = self.day_totals["customer_id"].read(spark, before=epoch)
        newest = totals.where(F.col("day") <= F.lit(today)).agg(F.max("day")).first()[0] or today
        oldest = newest - datetime.timedelta(days=HISTORY_DAYS)
        self.known.compact(spark, epoch, oldest)
        for table in self.day_totals.values():
            table.compact(spark, epoch, lambda rows: features.sum_by_day(rows.where(F.col("day") >= F.lit(oldest))))
        self.history.drop_days(spark, epoch, oldest)


@dataclass(frozen=True)
class AccountJob:
    """Keeps the versions of each account; every micro-batch adds its last ones."""

    tables: Tables
    tenant: Tenant
    compact_every: int = 100

    def process(self, batch: DataFrame, epoch: int) -> None:
        if epoch and epoch % self.compact_every == 0:
            self.tables.accounts.compact(batch.sparkSession, epoch, latest_accounts)
        read = parse.read_accounts(batch, self.tenant).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            latest = latest_accounts(parse.kept(read)).withColumn("seen_at", F.current_timestamp())
            self.tables.accounts.write(latest, epoch)
            self.tables.bad_accounts.write(parse.quarantined(read), epoch)
        finally:
            read.unpersist()

    def start(self, records: DataFrame, **trigger):
        written = (self.tables.accounts, self.tables.bad_accounts)
        return _start(records, self.process, self.tables.root, "accounts", written, trigger)


@dataclass(frozen=True)
class ScoringJob:
    """Scores each micro-batch as a whole.

    ``as_of`` gives the features against one anchor day instead of each transaction's own day. The text
    ``today`` follows the clock: the day is written down once per micro-batch, so a retry sees the same.
    Every ``compact_every`` micro-batches :meth:`Tables.retire` merges known ids and day totals and lets go of days
    past retention.
    A transaction whose account does not come for ``pending_days`` goes to quarantine.
    ``send_alerts`` is off for tenants that want none.
    ``index_format`` sends scored rows to a connector; without it they go to a table.
    ``repeat_delay`` (such as ``1 hour``) drops inserts that come again within that time before a micro-batch is
    made of them; later repeats are known by their ids as always.
    ``notify`` receives the alert rows of a micro-batch, for a broker or another channel.
    """

    tables: Tables
    tenant: Tenant
    model: Model | None = None
    account_ttl: int | None = None
    pending_days: int = 30
    as_of: datetime.date | str | None = None
    send_alerts: bool = True
    compact_every: int = 100
    recipient: str = ""
    signature: str = ""
    index_format: str | None = None
    index_options: dict[str, str] | None = None
    repeat_delay: str | None = None
    notify: Callable[[DataFrame], None] | None = None

    def process(self, batch: DataFrame, epoch: int) -> None:
        if epoch and epoch % self.compact_every == 0:
            self.tables.retire(batch.sparkSession, epoch, datetime.datetime.now(datetime.UTC).date())
        read = parse.read_transactions(batch, self.tenant).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            with scratch_scope(batch.sparkSession):
                self._process(read, epoch)
        finally:
            read.unpersist()

    def _process(self, read: DataFrame, epoch: int) -> None:
        spark, tables = read.sparkSession, self.tables
        bad = parse.quarantined(read)
        arrived = parse.kept(read).withColumn("since", F.current_timestamp())
        delivered = arrived.unionByName(tables.pending.read(spark, only=epoch - 1))
        days = delivered.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
        if days[0] is None:
            tables.bad_transactions.write(bad, epoch)
            return
        # An insert may come again with another time, so ids are looked up on every retained day.
        new = materialize(tables.known.unseen(dedupe_transactions(delivered), before=epoch), "new")
        dimension = live_accounts(tables.accounts.lookup(new), F.current_timestamp(), self.account_ttl)
        # Accounts may arrive meanwhile: what this batch saw of them is written down once, so every
        # transaction is either resolved or pending.
        overdue = F.col("since") < F.current_timestamp() - F.make_dt_interval(days=F.lit(self.pending_days))
        joined = materialize(with_account(new, dimension).withColumn("overdue", overdue), "batch")
        resolved = resolved_only(joined).drop("since", "overdue")
        # Written with the batch, so both outputs below agree on who has waited too long.
        waiting = pending_only(joined)
        bad = bad.unionByName(_given_up(waiting.where("overdue")))
        waiting = waiting.where("NOT overdue").drop("overdue")
        totals = features.day_totals(resolved)

        featured = self._features(resolved, totals, epoch, days)
        scored = materialize(label(features.calendar_flags(featured), self.model), "scored")
        rows = project_scored(scored, self.tenant)
        options = self.index_options or {}
        output = partial(write_index, rows, self.index_format, self.tenant.scored, tables.scored, epoch, **options)
        alerts = alert_rows(scored if self.send_alerts else scored.limit(0), self.recipient, self.signature)
        concurrently(
            spark,
            output,
            partial(tables.bad_transactions.write, bad, epoch),
            partial(tables.pending.write, waiting, epoch),
            partial(tables.history.write, scored.withColumn("event_day", F.to_date("ts")), epoch),
            partial(tables.known.add, scored.select("id", F.to_date("ts").alias("event_day")), epoch),
            partial(tables.features.write, scored.withColumn("incomplete", features.incomplete()), epoch),
            partial(tables.alerts.write, alerts, epoch),
            *[partial(table.write, totals[key].frame, epoch) for key, table in tables.day_totals.items()],
        )
        if self.notify and self.send_alerts:
            self.notify(tables.alerts.read(spark, only=epoch))

    def _features(self, resolved: DataFrame, totals: dict, epoch: int, days: list) -> DataFrame:
        spark, tables = resolved.sparkSession, self.tables
        longest = datetime.timedelta(days=max(schemas.HORIZONS.values()))
        if self.as_of is not None:
            return self._against(self._anchor(spark, epoch), resolved, totals, epoch)
        past_totals = {}
        for key, table in tables.day_totals.items():
            recent = table.read(spark, before=epoch).where(
                F.col("day").between(F.lit(min(days) - longest), F.lit(max(days)))
            )
            keys = resolved.select(F.col(key).alias("key")).distinct()
            past_totals[key] = recent.join(keys, "key", "left_semi")
        past_rows = _on_days(tables.history.read(spark, before=epoch), resolved, min(days), max(days))
        return features.point_in_time(
            resolved, past_totals=past_totals, past_rows=past_rows, totals=totals
        )

    def _anchor(self, spark: SparkSession, epoch: int) -> datetime.date:
        if self.as_of != "today":
            return self.as_of
        anchors = self.tables.anchors
        if anchors.read(spark, only=epoch).isEmpty():
            anchors.write(spark.range(1).select(F.current_date().alias("day")), epoch)
        return anchors.read(spark, only=epoch).first()["day"]

    def _against(self, day: datetime.date, resolved: DataFrame, totals: dict, epoch: int) -> DataFrame:
        """Features against one day, from the day totals of the batch's keys."""
        result = resolved
        for key, table in self.tables.day_totals.items():
            keys = resolved.select(F.col(key).alias("key")).distinct()
            past = table.read(resolved.sparkSession, before=epoch).join(keys, "key", "left_semi")
            both = past.unionByName(totals[key].frame)
            result = result.join(features.as_of_from_days(both, key, day), key, "left")
            result = result.fillna(0, [schemas.count_name(key, h) for h in schemas.HORIZONS])
        return result

    def start(self, records: DataFrame, **trigger):
        t = self.tables
        if self.repeat_delay:
            records = without_repeats(records, self.repeat_delay)
        written = (t.history, t.pending, t.scored, t.alerts, t.features, t.bad_transactions, *t.day_totals.values())
        return _start(records, self.process, t.root, "transactions", written, trigger)


def _given_up(rows: DataFrame) -> DataFrame:
    """Transactions without an account, as quarantine rows: their fields as JSON, and why."""
    fields = F.to_json(F.struct("id", "account_id", "amount", "ts", "op_type", "description"))
    return rows.select(fields.alias("value"), "partition", "offset", F.lit("account never came").alias("reason"))


def _on_days(history: DataFrame, batch: DataFrame, first: datetime.date, last: datetime.date) -> DataFrame:
    """The history of a batch's days. Days are partitions: the join lets scans skip those between."""
    days = batch.select(F.to_date("ts").alias("event_day")).distinct()
    return history.where(F.col("event_day").between(F.lit(first), F.lit(last))).join(days, "event_day", "left_semi")


def _start(records: DataFrame, process, root: str, name: str, written: tuple[EpochTable, ...], trigger: dict):
    """Start a job whose micro-batches go on counting where the tables end.

    Spark counts the micro-batches of a checkpoint from 0. If the checkpoint was lost while the tables
    were kept, a new one therefore starts behind the last stored micro-batch instead of replacing the
    first ones; records that come again are known by their ids.
    """
    spark, checkpoint = records.sparkSession, f"{root}/_checkpoint_{name}"
    first = EpochTable(f"{root}/_first_{name}", StructType([StructField("first", LongType())]))
    fs, metadata = EpochTable._file(spark, f"{checkpoint}/metadata")
    if not fs.exists(metadata):
        stored = [n for n in (table.last(spark) for table in written) if n is not None]
        first.write(spark.createDataFrame([(max(stored, default=-1) + 1,)], first.schema), 0)
    kept = first.read(spark, only=0).first()
    shift = kept["first"] if kept else 0
    writer = records.writeStream.foreachBatch(lambda batch, epoch: process(batch, shift + epoch))
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
