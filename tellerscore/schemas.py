"""Declared schemas. Nothing in the library infers a schema from data."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Trailing horizons in calendar days, and the feature order of the training file.
HORIZONS = {"1day": 1, "1week": 7, "1month": 30, "3month": 90}
KEYS = ("customer_id", "account_id")


def average_name(key: str, horizon: str) -> str:
    return f"{key}_avrge_amount_{horizon}"


def count_name(key: str, horizon: str) -> str:
    return f"{key}_count_{horizon}"


def _feature_order() -> list[str]:
    names = ["amount"]
    for key in KEYS:
        names += [average_name(key, h) for h in HORIZONS]
        names += [count_name(key, h) for h in HORIZONS]
    return names + ["transaction_in_weekend", "transaction_at_night"]


FEATURES = _feature_order()
LABEL = "is_fraud"

# Every decoded amount below 10^25 millionths fits; sums stay within 38 digits.
AMOUNT = DecimalType(25, 6)


def _struct(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


TXN_AFTER_A = _struct(
    ("id", LongType()),
    ("savings_account_id", LongType()),
    ("created_date", LongType()),
    ("transaction_type_enum", IntegerType()),
    ("amount", StringType()),
)
TXN_AFTER_B = _struct(
    ("id", LongType()),
    ("bank_account_id", StringType()),
    ("operation_date", LongType()),
    ("type", StringType()),
    ("amount", DoubleType()),
    ("description", StringType()),
)
ACCOUNT_AFTER_A = _struct(("id", LongType()), ("client_id", LongType()))
ACCOUNT_AFTER_B = _struct(("id", StringType()), ("client_id", LongType()), ("type", StringType()))


def envelope(after: StructType) -> StructType:
    """Change-event schema; ``before`` stays raw text, so an empty object is still not null."""
    payload = _struct(("before", StringType()), ("after", after))
    return _struct(("payload", payload), ("_corrupt", StringType()))


# One record of a change stream. Files carry the position columns that a broker supplies.
CDC_RECORD = _struct(("value", StringType()), ("partition", IntegerType()), ("offset", LongType()))
# What a broker also tells of a record: its feed, and when it took it.
BROKER_RECORD = StructType([*CDC_RECORD.fields, StructField("topic", StringType()), StructField("timestamp", TimestampType())])


def canonical(account: type = LongType) -> StructType:
    """A parsed insert, the same for every tenant apart from the account id's type."""
    return _struct(
        ("id", LongType()),
        ("account_id", account()),
        ("amount", DoubleType()),
        ("ts", TimestampType()),
        ("op_type", StringType()),
        ("description", StringType()),
        ("partition", IntegerType()),
        ("offset", LongType()),
        ("topic", StringType()),
        ("broker_time", TimestampType()),
    )


def pending(account: type = LongType) -> StructType:
    """A parsed insert that waits for its account, and since when."""
    return StructType([*canonical(account).fields, StructField("since", TimestampType(), True)])


def account_dimension(account: type = LongType) -> StructType:
    return _struct(
        ("customer_id", LongType()),
        ("account_id", account()),
        ("account_type", StringType()),
        ("partition", IntegerType()),
        ("offset", LongType()),
        ("topic", StringType()),
        ("broker_time", TimestampType()),
        ("seen_at", TimestampType()),
    )


def history(account: type = LongType) -> StructType:
    return _struct(
        ("id", LongType()),
        ("account_id", account()),
        ("customer_id", LongType()),
        ("amount", DoubleType()),
        ("ts", TimestampType()),
        ("event_day", DateType()),
    )


def day_totals(kind) -> StructType:
    """Per key and day: how many transactions and their exact sum."""
    return _struct(("key", kind), ("day", DateType()), ("n", LongType()), ("s", DecimalType(35, 6)))


SCORED_A = _struct(
    ("account-id", LongType()),
    ("amount", DoubleType()),
    ("customer-id", LongType()),
    ("datetime", StringType()),
    ("is_fraud", StringType()),
    ("transaction-id", LongType()),
    ("type", StringType()),
    ("@timestamp", StringType()),
)
SCORED_B = _struct(
    ("account-id", StringType()),
    ("amount", DoubleType()),
    ("Customer-id", LongType()),
    ("operation-date", StringType()),
    ("is_fraud", StringType()),
    ("transaction-id", LongType()),
    ("type", StringType()),
    ("transaction-description", StringType()),
    ("account_type", StringType()),
    ("@timestamp", StringType()),
)


def featured() -> StructType:
    """What the model saw of each scored transaction, and what it said."""
    columns = [(n, _training_type(n)) for n in FEATURES]
    return _struct(("id", LongType()), *columns, ("incomplete", BooleanType()), (LABEL, StringType()))


def _training_type(name: str):
    return DoubleType() if name == "amount" or "_avrge_" in name else IntegerType()


TRAINING = StructType([StructField(n, _training_type(n), True) for n in [*FEATURES, LABEL]])

CHAT_PAYLOAD = _struct(
    ("icon_emoji", StringType()),
    ("username", StringType()),
    (
        "attachments",
        ArrayType(_struct(("title", StringType()), ("text", StringType()), ("color", StringType()))),
    ),
)
