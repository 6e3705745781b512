"""From change-event text to typed rows.

Each tenant's event layout is an adapter; everything after it works on one canonical frame.
Records that cannot be used go to a quarantine output with a reason, so one bad record never
stops a batch.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructType

from tellerscore import schemas
from tellerscore.functions import fields


@dataclass(frozen=True)
class Tenant:
    """How one source system lays out its transactions and accounts."""

    name: str
    account_id: DataType
    transaction_after: StructType
    account_after: StructType
    transaction: Callable[[Column], dict[str, Column]]
    account: Callable[[Column], dict[str, Column]]
    scored: StructType
    scored_names: dict[str, str]


def _summable(amount: Column) -> Column:
    """Null for a double too large for exact sums, which puts its record into quarantine."""
    return F.when(amount.try_cast(schemas.AMOUNT).isNotNull(), amount)


def _transaction_a(after: Column) -> dict[str, Column]:
    return {
        "id": after["id"],
        "account_id": after["savings_account_id"],
        "amount": _summable(fields.decode_amount(after["amount"]).cast("double")),
        "ts": fields.epoch_ms_to_ts(after["created_date"]),
        "op_type": fields.op_type(after["transaction_type_enum"]),
        "description": F.lit(None).cast("string"),
    }


def _transaction_b(after: Column) -> dict[str, Column]:
    return {
        "id": after["id"],
        "account_id": after["bank_account_id"],
        "amount": _summable(after["amount"]),
        "ts": fields.epoch_us_to_ts(after["operation_date"]),
        "op_type": after["type"],
        "description": after["description"],
    }


def _account_a(after: Column) -> dict[str, Column]:
    return {
        "customer_id": after["client_id"],
        "account_id": after["id"],
        "account_type": F.lit(None).cast("string"),
    }


def _account_b(after: Column) -> dict[str, Column]:
    return {
        "customer_id": after["client_id"],
        "account_id": after["id"],
        "account_type": fields.account_type(after["type"]),
    }


TENANT_A = Tenant(
    name="A",
    account_id=LongType(),
    transaction_after=schemas.TXN_AFTER_A,
    account_after=schemas.ACCOUNT_AFTER_A,
    transaction=_transaction_a,
    account=_account_a,
    scored=schemas.SCORED_A,
    scored_names={
        "account_id": "account-id",
        "amount": "amount",
        "customer_id": "customer-id",
        "datetime": "datetime",
        "is_fraud": "is_fraud",
        "id": "transaction-id",
        "op_type": "type",
        "iso": "@timestamp",
    },
)
TENANT_B = Tenant(
    name="B",
    account_id=StringType(),
    transaction_after=schemas.TXN_AFTER_B,
    account_after=schemas.ACCOUNT_AFTER_B,
    transaction=_transaction_b,
    account=_account_b,
    scored=schemas.SCORED_B,
    scored_names={
        "account_id": "account-id",
        "amount": "amount",
        "customer_id": "Customer-id",
        "datetime": "operation-date",
        "is_fraud": "is_fraud",
        "id": "transaction-id",
        "op_type": "type",
        "description": "transaction-description",
        "account_type": "account_type",
        "iso": "@timestamp",
    },
)

POSITION = ("partition", "offset")
#: What files may lack, and records made by hand: the feed, and when the broker took the record.
ORIGIN = {"topic": "string", "broker_time": "timestamp"}


def once(df: DataFrame, *keep: str, columns: Column) -> DataFrame:
    """Columns ``keep`` and the fields of the struct ``columns``, computed once per row.

    A plain projection would be copied into every filter and expression that uses it, and with
    it the JSON parsing; the optimizer does not move expressions out of a generator.
    """
    return df.select(*keep, F.inline(F.array(columns)))


def parse_envelope(records: DataFrame, after: StructType) -> DataFrame:
    """Add ``payload`` and ``status``: insert, update, delete, tombstone, malformed or empty."""
    envelope = F.from_json(
        "value",
        schemas.envelope(after),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"},
    )
    parsed = once(records, *records.columns, columns=envelope)
    payload = F.col("payload")
    before, new = payload["before"], payload["after"]
    status = (
        F.when(F.col("value").isNull(), "tombstone")
        .when(F.col("_corrupt").isNotNull() | payload.isNull(), "malformed")
        .when(before.isNotNull() & new.isNull(), "delete")
        .when(new.isNull(), "empty")
        .when(before.isNotNull(), "update")
        .otherwise("insert")
    )
    return parsed.withColumn("status", status).drop("_corrupt")


def filter_insert(parsed: DataFrame) -> DataFrame:
    """Inserts and snapshot reads. Bad records also lack ``before``, so ``after`` must be there."""
    return parsed.where("payload.before IS NULL AND payload.after IS NOT NULL AND status = 'insert'")


def read_transactions(records: DataFrame, tenant: Tenant) -> DataFrame:
    """Every record with its canonical fields and what is to become of it.

    ``fate`` is ``keep``, ``skip`` (updates and deletes), or the reason for quarantine.
    """
    return _adapt(records, tenant.transaction_after, tenant.transaction, ("id", "account_id", "amount", "ts"), ("insert",))


def read_accounts(records: DataFrame, tenant: Tenant) -> DataFrame:
    """As :func:`read_transactions`; inserts and updates both carry an account version."""
    return _adapt(records, tenant.account_after, tenant.account, ("customer_id", "account_id"), ("insert", "update"))


def kept(read: DataFrame) -> DataFrame:
    return read.where("fate = 'keep'").drop("value", "fate")


def quarantined(read: DataFrame) -> DataFrame:
    return read.where("fate NOT IN ('keep', 'skip')").select("value", *POSITION, F.col("fate").alias("reason"))


def transactions(records: DataFrame, tenant: Tenant) -> tuple[DataFrame, DataFrame]:
    """Canonical inserts, and the records that need attention with a reason."""
    read = read_transactions(records, tenant)
    return kept(read), quarantined(read)


def accounts(records: DataFrame, tenant: Tenant) -> tuple[DataFrame, DataFrame]:
    """Account versions, and the records that need attention with a reason."""
    read = read_accounts(records, tenant)
    return kept(read), quarantined(read)


def _adapt(records, after, adapter, required, wanted):
    parsed = parse_envelope(records, after)
    missing = {c: F.lit(None).cast(kind) for c, kind in ORIGIN.items() if c not in parsed.columns}
    parsed = parsed.withColumns(missing) if missing else parsed
    columns = adapter(F.col("payload.after"))
    typed = once(
        parsed, "value", "status", *POSITION, *ORIGIN, columns=F.struct(*[c.alias(n) for n, c in columns.items()])
    )
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    fate = (
        F.when(F.col("status").isin(*wanted), F.when(complete, "keep").otherwise("unusable field"))
        .when(F.col("status").isin("tombstone", "malformed", "empty"), F.col("status"))
        .otherwise("skip")
    )
    text = F.when(~fate.isin("keep", "skip"), F.col("value"))
    return typed.select(*columns, *POSITION, *ORIGIN, text.alias("value"), fate.alias("fate"))


def project_scored(scored: DataFrame, tenant: Tenant) -> DataFrame:
    """The output row of a tenant, cast to its declared schema."""
    from_canonical = {
        **{n: F.col(n) for n in tenant.scored_names if n not in ("datetime", "iso")},
        "datetime": fields.time_text(F.col("ts")),
        "iso": fields.iso_ts(F.col("ts")),
    }
    kinds = {f.name: f.dataType for f in tenant.scored.fields}
    return scored.select(
        *[
            from_canonical[source].cast(kinds[target]).alias(target)
            for source, target in tenant.scored_names.items()
        ]
    )
