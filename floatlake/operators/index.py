"""Profile index lines: parsing, filtering and the platform list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from floatlake.catalog import INDEX_FIELDS
from floatlake.functions.dates import ymd_parts
from floatlake.functions.paths import platform_from_path
from floatlake.functions.text import parses_as_float, strip, to_number


def data_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """Index lines that hold data: no comments, headers or blank lines; trimmed."""
    raw = F.col(line)
    header = F.lower(raw).contains("file,date,latitude")
    return df.where(~raw.startswith("#") & ~header & (strip(raw) != "")).withColumn(
        line, strip(raw)
    )


def index_problem(parts: Column | str) -> Column:
    """Why the fields of a data line cannot be used, null for a good line."""
    parts = F.col(parts) if isinstance(parts, str) else parts
    return (
        F.when(F.size(parts) < len(INDEX_FIELDS), F.lit("too few fields"))
        .when(~parses_as_float(F.get(parts, F.lit(2))), F.lit("latitude is not a number"))
        .when(~parses_as_float(F.get(parts, F.lit(3))), F.lit("longitude is not a number"))
    )


def parse_index(df: DataFrame, line: str = "line") -> DataFrame:
    """Fields of every usable index line, with the platform number from its path.

    Other columns of the input (such as the line number) are kept in front.
    """
    kept = [c for c in df.columns if c != line]
    split = data_lines(df, line).select(*kept, F.split(line, ",").alias("_parts"))
    good = split.where(index_problem("_parts").isNull()).select(
        *kept, *[F.get("_parts", F.lit(i)).alias(name) for i, name in enumerate(INDEX_FIELDS)]
    )
    return good.withColumns({
        "latitude": to_number("latitude"),
        "longitude": to_number("longitude"),
        "platform_number": platform_from_path("file"),
    })


def rejected_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """Data lines that parse_index leaves out, with the reason."""
    reason = index_problem(F.split(line, ","))
    return data_lines(df, line).withColumn("reason", reason).where("reason IS NOT NULL")


def filter_ocean(df: DataFrame, code: str = "I") -> DataFrame:
    return df.where(F.col("ocean") == code)


def filter_months(df: DataFrame, year: int, months: list[int]) -> DataFrame:
    """Profiles dated in one of the months of the year (dates are YYYYMMDD... text)."""
    parts = ymd_parts("date")
    return df.where(
        (F.length("date") >= 8) & (parts["year"] == year) & parts["month"].isin(months)
    )


def first_per_platform(df: DataFrame, order: list[str]) -> DataFrame:
    """First row of every platform; rows without a platform count as one platform.

    An aggregation rather than a row number: partial results are combined before the
    shuffle, so a platform with very many rows costs no more than the others.
    """
    keys = F.struct(*[F.col(c) for c in order])
    first = F.min_by(F.struct(*[F.col(c) for c in df.columns]), keys)
    return df.groupBy("platform_number").agg(first.alias("_row")).select("_row.*")


def distinct_platforms(df: DataFrame, column: str = "platform_number") -> DataFrame:
    return (
        df.where(F.col(column).isNotNull())
        .select(F.col(column).cast("string").alias("platform_number"))
        .distinct()
    )


def merge_platforms(existing: DataFrame, found: DataFrame) -> DataFrame:
    """Union of the stored list and the platforms found, sorted as text."""
    return (
        distinct_platforms(existing)
        .union(distinct_platforms(found))
        .distinct()
        .orderBy("platform_number")
    )


def new_platforms(existing: DataFrame, found: DataFrame) -> DataFrame:
    """Platforms found that are not stored yet."""
    return distinct_platforms(found).join(
        distinct_platforms(existing), "platform_number", "left_anti"
    )


def sample_platforms(platforms: DataFrame, n: int = 10) -> DataFrame:
    """The first n platforms by name, for a report."""
    return platforms.orderBy("platform_number").limit(n)
