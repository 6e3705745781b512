import base64
import datetime
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tellerscore.functions import alerts, fields
from tellerscore.functions.text import cast_columns
from tellerscore.schemas import TRAINING


def encode(value: int, size: int | None = None, signed: bool = False) -> str:
    size = size or max(1, (value.bit_length() + 7) // 8)
    return base64.b64encode(value.to_bytes(size, "big", signed=signed)).decode()


def decoded(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", fields.decode_amount(F.col("t"), **options).alias("v")).orderBy("i").collect()
    return [r.v for r in rows]


EDGES = [0, 1, 255, 256, 12345678, 1_500_000_000, 2**63, 2**64, 2**70 + 12345, 10**25 - 1]


def test_decode_amount_is_the_unsigned_integer_in_millionths(spark):
    want = [decimal.Decimal(v).scaleb(-6) for v in EDGES]
    assert decoded(spark, [encode(v) for v in EDGES]) == want
    assert decoded(spark, [encode(v, 16) for v in EDGES]) == want


def test_decode_amount_double_equals_python_float(spark):
    df = spark.createDataFrame([(encode(v), float(decimal.Decimal(v) / 1000000)) for v in EDGES], "t string, want double")
    assert df.where(fields.decode_amount(F.col("t")).cast("double") != F.col("want")).count() == 0


def test_decode_amount_without_a_value(spark):
    assert decoded(spark, [encode(10**25), encode(2**200), None, "not base64!", encode(10**25, 40)]) == [None] * 5
    assert decoded(spark, [""]) == [0]


def test_negative_amounts(spark):
    minus_five = encode(-5_000_000, 4, signed=True)
    assert decoded(spark, [minus_five]) == [decimal.Decimal("4289.967296")]
    values = [-5_000_000, -1, -128, 127, -(2**63), 2**63 - 1, 5]
    texts = [encode(v, 8, signed=True) for v in values]
    assert decoded(spark, texts, signed=True) == [decimal.Decimal(v).scaleb(-6) for v in values]


def test_encode_then_decode(spark):
    df = spark.createDataFrame([(112946.26,), (0.0,), (0.000001,)], "a double")
    same = fields.decode_amount(fields.encode_amount(F.col("a"))).cast("double") == F.col("a")
    assert df.where(~same).count() == 0
    assert df.select(fields.encode_amount(F.col("a")).alias("e")).first().e == "AAAAGkwfKCA="


@pytest.mark.parametrize(
    "text, night, weekend",
    [
        ("2024-01-05 05:59:59", 1, 0),
        ("2024-01-05 06:00:00", 0, 0),
        ("2024-01-05 21:59:59", 0, 0),
        ("2024-01-05 22:00:00", 1, 0),
        ("2024-01-05 23:59:59", 1, 0),
        ("2024-01-06 00:00:00", 1, 1),
        ("2024-01-07 12:00:00", 0, 1),
        ("2024-01-08 00:00:00", 1, 0),
    ],
)
def test_clock_edges(spark, text, night, weekend):
    row = spark.sql(f"SELECT TIMESTAMP '{text}' AS ts").select(
        fields.is_night(F.col("ts")).alias("n"), fields.is_weekend(F.col("ts")).alias("w")
    ).first()
    assert (row.n, row.w) == (night, weekend)


def test_times(spark):
    df = spark.sql("SELECT 907372800123 AS ms, 907372800123456 AS us")
    row = df.select(
        fields.time_text(fields.epoch_ms_to_ts(F.col("ms"))).alias("a"),
        fields.iso_ts(fields.epoch_ms_to_ts(F.col("ms"))).alias("b"),
        fields.iso_ts(fields.epoch_us_to_ts(F.col("us"))).alias("c"),
        fields.iso_ts(fields.epoch_us_to_ts(F.col("us"), 0)).alias("d"),
    ).first()
    assert row.a == "1998-10-03 00:00:00"
    assert row.b == "1998-10-03T00:00:00.123000"
    assert row.c == "1998-10-02T23:00:00.123456"
    assert row.d == "1998-10-03T00:00:00.123456"


def test_since_counts_whole_days_without_upper_bound(spark):
    df = spark.createDataFrame(
        [("2024-03-09 00:00:00",), ("2024-03-08 23:59:59",), ("2024-03-20 00:00:00",)], "t string"
    ).select(F.col("t").cast("timestamp").alias("ts"))
    kept = df.where(fields.since(F.col("ts"), F.lit(datetime.date(2024, 3, 10)), 1)).count()
    assert kept == 2


def test_codes(spark):
    df = spark.createDataFrame([(2, "SA"), (1, "CA"), (None, None)], "code int, kind string")
    rows = df.select(fields.op_type(F.col("code")).alias("o"), fields.account_type(F.col("kind")).alias("a")).collect()
    assert [(r.o, r.a) for r in rows] == [
        ("DEBIT", "Saving Account"),
        ("CREDIT", "Current Account"),
        ("CREDIT", "Current Account"),
    ]


@pytest.mark.parametrize("value", [0.0, 75.0, 0.1, 112946.26, 12345678.9, 1e15, 1e16, 2.5e18, 1e-4, 1e-5, 1.5e-6, 123456789.125, -20.5])
def test_number_text_is_the_shortest_form(spark, value):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(fields.number_text(F.col("v")).alias("t")).first().t == repr(value)


def test_alert_text(spark):
    df = spark.createDataFrame([("2024-01-05 05:59:59", 7, 8, "U9", 1500.5)], "t string, i long, c long, a string, v double")
    body = df.select(
        alerts.alert_text(F.col("t"), F.col("i"), F.col("c"), F.col("a"), fields.number_text(F.col("v"))).alias("b")
    ).first().b
    lines = body.split("\n")
    named = dict(line.split(": ", 1) for line in lines if ": " in line)
    assert list(named.items()) == [
        ("Transaction ID", "7"),
        ("Customer ID", "8"),
        ("Account ID", "U9"),
        ("Amount", "$1500.5"),
        ("Date", "2024-01-05 05:59:59."),
    ]
    assert len(lines) == 12 and lines[0].endswith("on 2024-01-05 05:59:59.")
    assert body == alerts.BODY.format(datetime="2024-01-05 05:59:59", id=7, customer_id=8, account_id="U9", amount=1500.5)


def test_bad_text_casts_to_null(spark):
    good = ["1.5" if "_avrge_" in n or n == "amount" else "2" for n in TRAINING.names]
    bad = ["x"] * len(good)
    text = StructType([StructField(n, StringType()) for n in TRAINING.names])
    rows = cast_columns(spark.createDataFrame([good, bad], text), TRAINING)
    assert rows.schema == TRAINING
    first, second = rows.collect()
    assert first.amount == 1.5 and first.is_fraud == 2
    assert set(second) == {None}
