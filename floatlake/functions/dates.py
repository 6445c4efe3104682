"""Dates, times and relative days as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from floatlake.catalog import JULD_FILL, JULD_MAX_DAYS, MONTH_CODES, MONTH_NAMES
from floatlake.functions.text import col, reading_value, strip, to_number

_MICROS_PER_DAY = 86_400_000_000
# 1950-01-01 00:00:00 UTC in microseconds since 1970-01-01.
_JULD_EPOCH_MICROS = -7305 * _MICROS_PER_DAY


def split_datetime(c: Column | str) -> tuple[Column, Column]:
    """(date text, time text) of a text holding a date, a time or both."""
    text = strip(c)
    present = text.isNotNull() & ~text.isin("nan", "")
    parts = F.split(text, r"\s+")
    several = present & (F.size(parts) >= 2)
    only_time = present & text.contains(":")
    date = F.when(several, F.get(parts, F.lit(0))).when(present & ~only_time, text)
    time = F.when(
        several, F.array_join(F.slice(parts, F.lit(2), F.size(parts)), " ")
    ).when(only_time, text)
    return date, time


def compact_date(c: Column | str) -> Column:
    """YYYYMMDDHHMMSS to yyyy-MM-dd; other text is kept."""
    c = col(c)
    parsed = F.date_format(F.try_to_timestamp(c, F.lit("yyyyMMddHHmmss")), "yyyy-MM-dd")
    return F.when(F.length(c) == 14, F.coalesce(parsed, c)).otherwise(c)


def _days_to_timestamp(days: Column) -> Column:
    usable = (days != F.lit(JULD_FILL)) & (F.abs(days) < F.lit(JULD_MAX_DAYS))
    micros = (days * F.lit(float(_MICROS_PER_DAY))).try_cast("bigint")
    return F.when(usable, F.timestamp_micros(micros + F.lit(_JULD_EPOCH_MICROS)))


def _written_timestamp(c: Column) -> Column:
    # A bare time or a bare year would be completed with today's date: ask for a
    # whole date first.
    text = strip(c)
    dated = text.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}")
    return F.when(dated, F.try_to_timestamp(text))


def juld_to_timestamp(c: Column | str, kind: str = "double") -> Column:
    """Days since 1950-01-01 UTC to a timestamp.

    kind is the Spark type of the input: timestamps and dates pass through,
    strings may hold either a number of days or a written date and time.
    """
    c = col(c)
    if kind.startswith("timestamp") or kind == "date":
        return c.cast("timestamp")
    if kind == "string":
        return F.coalesce(_days_to_timestamp(to_number(c)), _written_timestamp(c))
    return _days_to_timestamp(c.cast("double"))


def to_date_or_null(c: Column | str, default: str | None = None) -> Column:
    """Date of a date-time text, null (or the default) when it cannot be read."""
    date = F.to_date(_written_timestamp(col(c)))
    return date if default is None else F.coalesce(date, F.lit(default).cast("date"))


def time_of_day(c: Column | str) -> Column:
    """HH:mm:ss of a timestamp."""
    return F.date_format(col(c), "HH:mm:ss")


def reading_date(c: Column | str) -> Column:
    """Date from the first ten characters, as yyyy-MM-dd or dd-MM-yyyy."""
    text = F.substring(reading_value(c), 1, 10)
    return F.coalesce(
        F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))),
        F.to_date(F.try_to_timestamp(text, F.lit("dd-MM-yyyy"))),
    )


def reading_time(c: Column | str) -> Column:
    """HH:mm:ss part: the first eight characters of the time text."""
    return F.substring(reading_value(c), 1, 8)


def ymd_parts(c: Column | str) -> Column:
    """struct<year, month, day> from the first eight characters.

    One unreadable part makes all three null. No range check is made.
    """
    c = col(c)
    year = F.substring(c, 1, 4).try_cast("int")
    month = F.substring(c, 5, 2).try_cast("int")
    day = F.substring(c, 7, 2).try_cast("int")
    whole = year.isNotNull() & month.isNotNull() & day.isNotNull()
    return F.struct(
        F.when(whole, year).alias("year"),
        F.when(whole, month).alias("month"),
        F.when(whole, day).alias("day"),
    )


def filename_date(c: Column | str) -> Column:
    """Year, month and day at the start of a file name such as 20250801_prof.nc."""
    return ymd_parts(c)


def _month_lookup(c: Column, names: list[str], unknown: str) -> Column:
    inside = c.between(1, 12)
    picked = F.get(F.array(*[F.lit(n) for n in names]), c - 1)
    return F.when(inside, picked).otherwise(F.lit(unknown))


def month_name(c: Column | str) -> Column:
    return _month_lookup(col(c), MONTH_NAMES, "Unknown")


def month_code(c: Column | str) -> Column:
    return _month_lookup(col(c), MONTH_CODES, "UNK")


def month_number(c: Column | str) -> Column:
    """Month number of an English month name, null when unknown."""
    at = F.array_position(F.array(*[F.lit(n) for n in MONTH_NAMES]), col(c))
    return F.when(at > 0, at.cast("int"))


def parse_months(spec: str) -> list[int]:
    """Months of a parameter such as "1-12", "8,9,10" or "8"."""
    text = spec.strip()
    if "-" in text:
        first, last = (int(part) for part in text.split("-"))
        months = list(range(first, last + 1))
    else:
        months = [int(part) for part in text.split(",")]
    if not months or any(not 1 <= month <= 12 for month in months):
        raise ValueError(f"months must lie in 1..12: {spec!r}")
    return months
