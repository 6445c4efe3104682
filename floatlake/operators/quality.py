"""Quality rules as violation tables, reject handling and load counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from floatlake.catalog import FLOAT_TYPES


def duplicate_floats(metadata: DataFrame) -> DataFrame:
    """Floats with more than one metadata row."""
    return (
        metadata.groupBy("float_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    )


def bad_float_types(metadata: DataFrame) -> DataFrame:
    """Metadata rows whose float type is missing or not one of the known types."""
    kind = F.col("float_type")
    return metadata.where(kind.isNull() | ~kind.isin(FLOAT_TYPES))


def missing_fields(readings: DataFrame) -> DataFrame:
    """Readings without a float or a parameter name."""
    return readings.where(F.col("float_id").isNull() | F.col("parameter_name").isNull())


def orphan_readings(readings: DataFrame, metadata: DataFrame) -> DataFrame:
    """Readings of floats that have no metadata row.

    One anti-join: rows of a frequent float stay where they are when the ids are broadcast,
    and Spark splits a skewed left side when they are not.
    """
    return readings.join(metadata.select("float_id").distinct(), "float_id", "left_anti").select(*readings.columns)


def split_rejects(df: DataFrame, problem: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with a reason): only the bad rows are rejected."""
    checked = df.withColumn("reason", problem)
    good = checked.where(F.col("reason").isNull()).drop("reason")
    return good, checked.where(F.col("reason").isNotNull())


def reading_problem() -> Column:
    """Why a reading cannot be stored, null when it can."""
    return (
        F.when(F.col("float_id").isNull(), F.lit("float_id is missing"))
        .when(F.col("parameter_name").isNull(), F.lit("parameter_name is missing"))
    )


def load_counters(df: DataFrame, filename: str = "filename", kind: str = "float_type") -> DataFrame:
    """Files, rows and rows per float type.

    Counted per file first: a distinct count in one step would send every row.
    """
    per_file = df.groupBy(filename).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(kind) == t).alias(t) for t in FLOAT_TYPES],
    )
    return per_file.agg(
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(FLOAT_TYPES[0]), F.lit(0)).alias("bgc_rows"),
        F.coalesce(F.sum(FLOAT_TYPES[1]), F.lit(0)).alias("core_rows"),
    )


def average_columns(files: DataFrame) -> DataFrame:
    """Whole number of columns per file, from rows holding an all_columns array."""
    columns = F.sum(F.size("all_columns"))
    n = F.count(F.lit(1))
    return files.agg(
        F.when(n > 0, F.floor(columns / n)).otherwise(F.lit(0)).alias("average_columns")
    )


def observe_rows(df: DataFrame, name: str = "load") -> tuple[DataFrame, Observation]:
    """Count the rows that pass while they are written, at no extra cost."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
