"""The two clocks: the relay's ``time_us`` (trusted) and the client's ``createdAt`` (only data)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from settle.schema import MAX_AHEAD_MS, MAX_BEHIND_MS, MICROS, WINDOW_S

# A cast alone would also take offsets, bare dates, a year, or a time of day; only a full UTC
# date and time is a claim we can use.
CLAIM_SHAPE = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,9})?\z"


def whole_div(numerator: Column, divisor: int) -> Column:
    """Integer division truncating toward zero (``/`` would give a double)."""
    return F.call_function("div", numerator, F.lit(divisor))


def observed_time(time_us: Column) -> Column:
    return F.timestamp_micros(time_us)


def claimed_time(created_at: Column) -> Column:
    """The claimed time at millisecond precision, or NULL unless it is a well-formed UTC time."""
    bare = F.regexp_replace(created_at, r"Z\z", "")
    parsed = F.when(bare.rlike(CLAIM_SHAPE), bare.try_cast("timestamp"))
    return F.timestamp_millis(F.unix_millis(parsed))


def lag_ms(time_us: Column, claimed: Column) -> Column:
    """Observed minus claimed, in milliseconds; negative means the post claims the future."""
    return whole_div(time_us, 1000) - F.unix_millis(claimed)


def clock_suspect(lag: Column) -> Column:
    """No usable claim, or one outside the plausible range. The bounds themselves are plausible."""
    return lag.isNull() | (lag > MAX_BEHIND_MS) | (lag < -MAX_AHEAD_MS)


def minute_index(time_us: Column) -> Column:
    """The number of the one-minute window a µs instant falls in (floor, also before 1970)."""
    width = WINDOW_S * MICROS
    return whole_div(time_us - F.pmod(time_us, F.lit(width)), width)


def wire_time(ts: Column) -> Column:
    """UTC text with exactly three decimals (a plain cast trims trailing zeros)."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")
