"""Outputs. Writers that lay rows out by partition rebalance them first: a large
partition is then written by several tasks, a small one by one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from floatlake.catalog import READINGS_SCHEMA
from floatlake.functions.dates import month_name
from floatlake.functions.paths import relative_dir
from floatlake.operators.readings import without_loaded
from floatlake.sources.tables import read_or_empty


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", "true").option("escape", '"').csv(path)


def _rebalanced(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.hint("rebalance", *columns)


def write_partitioned(
    df: DataFrame, path: str, columns: list[str], format: str = "parquet",
    mode: str = "overwrite", sort: list[str] | None = None, options: dict | None = None,
    whole: bool = False,
) -> None:
    """Write by partition columns; overwrite replaces only the partitions written, or with
    ``whole`` all that lies under the path."""
    laid_out = _rebalanced(df, columns)
    if sort:
        # Rows of one partition and one float lie together, so that min/max statistics
        # let readers skip row groups.
        laid_out = laid_out.sortWithinPartitions(*columns, *sort)
    writer = laid_out.write.format(format).mode(mode).partitionBy(*columns)
    writer = writer.option("partitionOverwriteMode", "static" if whole else "dynamic")
    if format == "csv":
        writer = writer.option("header", "true").option("escape", '"')
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    writer.save(path)


def write_by_month(df: DataFrame, path: str, format: str = "parquet", sort: list[str] | None = None) -> None:
    """One folder per year and month name; months not in ``df`` are left alone."""
    named = df.withColumn("month_name", month_name("month")).drop("month")
    write_partitioned(named, path, ["year", "month_name"], format, sort=sort)


def write_mirrored(df: DataFrame, root: str, out: str, format: str = "csv") -> None:
    """Keep the folder structure below ``root``, one folder per source file."""
    placed = df.withColumn("rel_dir", relative_dir("path", root)).drop(
        "path", "row_block", "row_pos", "_columns"
    )
    write_partitioned(placed, out, ["rel_dir", "filename"], format)


def write_readings(df: DataFrame, path: str, mode: str = "append") -> None:
    """Readings by float type and year, with a bloom filter on the float.

    Overwrite replaces all that lies under the path, as a repeated run must.
    """
    placed = df.withColumn("year", F.year("JULD_DATE"))
    write_partitioned(
        placed, path, ["float_type", "year"], mode=mode, sort=["float_id"],
        options={"parquet.bloom.filter.enabled#float_id": "true"}, whole=True,
    )


#: Readings as stored, with the columns of their folders.
READINGS_LAYOUT = T.StructType([
    *READINGS_SCHEMA.fields, T.StructField("float_type", T.StringType()), T.StructField("year", T.IntegerType()),
])
COUNTERS_SCHEMA = (
    "files bigint, rows bigint, errors bigint, bgc_readings bigint, core_readings bigint, average_columns bigint"
)


def write_counters(spark: SparkSession, path: str, counts: dict[str, int]) -> str:
    """One row of what a run has read, written and rejected; counts a run has not taken are null."""
    names = [part.split()[0] for part in COUNTERS_SCHEMA.split(", ")]
    row = spark.createDataFrame([tuple(counts.get(name) for name in names)], COUNTERS_SCHEMA)
    row.coalesce(1).write.mode("overwrite").parquet(path)
    return path


def append_readings(df: DataFrame, path: str, dedupe: bool = False) -> None:
    """Append. Loading a file twice stores its readings twice unless ``dedupe`` is set,
    which leaves out readings whose id is stored already."""
    if dedupe:
        placed = df.withColumn("year", F.year("JULD_DATE"))
        stored = read_or_empty(df.sparkSession, path, READINGS_LAYOUT)
        df = without_loaded(placed, stored).drop("year")
    write_readings(df, path, "append")


def jdbc_options(url: str, table: str, batchsize: int = 30_000, **properties: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(batchsize), **properties}


def write_jdbc(df: DataFrame, url: str, table: str, batchsize: int = 30_000, **properties: str) -> None:
    """Append to a database table in batches, one connection per task."""
    options = jdbc_options(url, table, batchsize, **properties)
    df.write.format("jdbc").options(**options).mode("append").save()
