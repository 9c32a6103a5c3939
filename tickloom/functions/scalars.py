"""Scalar expressions that several operators share; all are built from Spark's own functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Date formats of vendors' expiry fields.
EXPIRY_FORMATS = ("yyyy-MM-dd", "dd-MM-yyyy", "dd/MM/yyyy", "dd MMM yyyy", "dd-MMM-yyyy")


def bucket_start(time: Column, interval_s: int) -> Column:
    """The start of the bucket that holds time, on whole epoch seconds."""
    seconds = F.unix_seconds(time.cast("timestamp"))
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(interval_s)))


def floor_div(whole: Column, by: int) -> Column:
    """The floor of a long divided by a positive number, in whole numbers: doubles can't tell nanoseconds of today apart."""
    return F.call_function("div", whole - F.pmod(whole, F.lit(by)), F.lit(by))


def micros(ns: Column) -> Column:
    """The timestamp of epoch nanoseconds, whose last three digits are cut off."""
    return F.timestamp_micros(floor_div(ns, 1000))


def utc_date(ns: Column) -> Column:
    """The UTC date of epoch nanoseconds."""
    return F.timestamp_seconds(floor_div(ns, 1_000_000_000)).cast("date")


def parse_expiry(text: Column) -> Column:
    """The first of EXPIRY_FORMATS that fits (a time of day after the date is ignored), else null."""
    day = F.split(F.trim(text), "[ T](?=[0-9]{1,2}:)")[0]
    return F.coalesce(*[F.try_to_date(day, f) for f in EXPIRY_FORMATS])


def strike_text(strike: Column) -> Column:
    """A strike with one decimal at least and four at most, never in powers of ten."""
    fixed = strike.cast("decimal(18,4)").cast("string")
    return F.regexp_replace(fixed, r"(\.\d)(\d*?)0+$", "$1$2")


def strike_key(strike: Column) -> Column:
    """Strikes are doubles: they are joined as whole hundredths."""
    return F.round(strike * 100).cast("long")


def ratio(numerator: Column, denominator: Column, otherwise: Column) -> Column:
    """numerator / denominator, or otherwise where the denominator is 0."""
    return F.when(denominator == 0, otherwise).otherwise(numerator / denominator)


def config_hash(config: Column) -> Column:
    """The first 16 hex digits of the sha256 of a map of settings, whose keys are sorted first."""
    entries = F.map_from_entries(F.array_sort(F.map_entries(config)))
    return F.substring(F.sha2(F.to_json(entries), 256), 1, 16)


def short_id(*parts: Column, digits: int = 8) -> Column:
    """A short id that depends on its parts alone."""
    return F.substring(F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256), 1, digits)


def fused(a: Column, b: Column, c: Column) -> Column:
    """a * b + c of doubles rounded once, by the errors of the product and of the sum."""

    def halves(x):
        high = x * 134217729.0 - (x * 134217729.0 - x)
        return high, x - high

    (a1, a2), (b1, b2), product = halves(a), halves(b), a * b
    lost = ((a1 * b1 - product) + a1 * b2 + a2 * b1) + a2 * b2
    total = product + c
    kept = total - product
    return total + (((product - (total - kept)) + (c - kept)) + lost)
