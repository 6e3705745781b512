"""Column expressions for decoding and typing the fields of a change event.

All of them are built-in Spark expressions, so they stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tellerscore.schemas import AMOUNT

# Fixed values of the change-event formats and labels.
MICRO_UNITS = "0.000001"
DEBIT_CODE = 2
SAVING_CODE = "SA"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
NIGHT_FROM, NIGHT_TO = 22, 6

# Seconds of 0002-01-01 and 9998-12-31: a year inside the calendar, so that no horizon leaves it.
FIRST_SECOND, LAST_SECOND = -62_104_060_800, 253_370_678_400


def _hex_to_number(digits: Column) -> Column:
    """Value of the last 24 hex digits as decimal(38,0). ``conv`` alone stops at 64 bits."""
    padded = F.concat(F.lit("0" * 24), digits)
    high = F.conv(F.substring(padded, -24, 12), 16, 10).cast("decimal(15,0)")
    low = F.conv(F.substring(padded, -12, 12), 16, 10).cast("decimal(15,0)")
    return (high * F.lit(2**48).cast("decimal(15,0)") + low).cast("decimal(38,0)")


def decode_amount(encoded: Column, signed: bool = False) -> Column:
    """Base64 of a big-endian integer of millionths, as decimal(25,6).

    Null for text that is not base64 and for magnitudes of 10^25 millionths or more. The integer
    is read as unsigned unless ``signed``, which reads two's complement.
    """
    digits = F.hex(F.try_to_binary(encoded, F.lit("base64")))
    if signed:
        negative = F.substring(digits, 1, 1).isin(*"89ABCDEF")
        flipped = F.translate(digits, "0123456789ABCDEF", "FEDCBA9876543210")
        digits = F.when(negative, flipped).otherwise(digits)
    number = _hex_to_number(digits)
    if signed:
        number = F.when(negative, -number - 1).otherwise(number)
    fits = F.length(F.ltrim(digits, F.lit("0"))) < 24
    unscaled = F.when(fits, number.try_cast("decimal(25,0)"))
    return (unscaled * F.lit(MICRO_UNITS).cast("decimal(6,6)")).cast(AMOUNT)


def encode_amount(amount: Column) -> Column:
    """The inverse of :func:`decode_amount` for amounts whose millionths fit 64 bits."""
    units = (amount.cast("decimal(18,6)") * F.lit(1000000)).cast("long")
    return F.base64(F.unhex(F.lpad(F.hex(units), 16, "0")))


def epoch_ms_to_ts(ms: Column) -> Column:
    """Null outside the years that a trailing horizon can reach back from, and dates can name."""
    return F.when(ms.between(FIRST_SECOND * 1000, LAST_SECOND * 1000), F.timestamp_millis(ms))


def epoch_us_to_ts(us: Column, shift_hours: int = 1) -> Column:
    """Epoch microseconds moved back by the source's fixed clock shift; null outside the same years."""
    shift = shift_hours * 3_600_000_000
    usable = us.between(FIRST_SECOND * 1_000_000 + shift, LAST_SECOND * 1_000_000 + shift)
    return F.when(usable, F.timestamp_micros(us - F.lit(shift)))


def time_text(ts: Column) -> Column:
    return F.date_format(ts, TIME_FORMAT)


def iso_ts(ts: Column) -> Column:
    """ISO text with six fraction digits and no zone."""
    return F.date_format(ts, ISO_FORMAT)


def op_type(code: Column) -> Column:
    return F.when(code == DEBIT_CODE, "DEBIT").otherwise("CREDIT")


def account_type(code: Column) -> Column:
    return F.when(code == SAVING_CODE, "Saving Account").otherwise("Current Account")


def is_night(ts: Column, start: int = NIGHT_FROM, end: int = NIGHT_TO) -> Column:
    return ((F.hour(ts) >= start) | (F.hour(ts) < end)).cast("int")


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def label_text(prediction: Column) -> Column:
    return F.when(prediction == 0.0, "valid").otherwise("fraudulent")


def since(moment: Column, anchor: Column, days: int) -> Column:
    """True from ``days`` whole calendar days before the anchor day on, with no upper bound.

    Compares the bare timestamp with that day's midnight, so that file scans can use it.
    """
    return moment >= F.date_sub(anchor, days).cast("timestamp")


def number_text(value: Column) -> Column:
    """A double as shortest text: positional from 1e-4 to 1e16, else ``d.de-05`` or ``de+16``."""
    text = value.cast("string")
    plain = F.rtrim(text.cast("decimal(38,20)").cast("string"), F.lit("0"))
    plain = F.when(F.endswith(plain, F.lit(".")), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    power = F.substring_index(text, "E", -1)
    sign = F.when(F.startswith(power, F.lit("-")), "e-").otherwise("e+")
    scientific = F.concat(mantissa, sign, F.lpad(F.ltrim(power, F.lit("-")), 2, "0"))
    size = F.abs(value)
    return F.when((size == 0) | ((size >= 1e-4) & (size < 1e16)), plain).otherwise(scientific)
