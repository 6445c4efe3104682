"""CSV and text inputs with a reproducible row order.

Every reader adds ``path``, ``filename`` and the row order columns ``ROW_ORDER``:
file, block start and position in the scan. They are the same whenever a task is run
again, unlike any order after a shuffle.
"""

from __future__ import annotations

import csv
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from floatlake.catalog import column_type
from floatlake.functions.dates import juld_to_timestamp
from floatlake.functions.paths import basename, year_month_parts
from floatlake.functions.text import clean_bytes, null_tokens, to_number
from floatlake.sources.quoted import parsed_records, quoted_records

ROW_ORDER = ["path", "row_block", "row_pos"]
FILE_COLUMNS = ["path", "filename", "row_block", "row_pos", "_columns"]


def _decoded(path: Column) -> Column:
    """File paths of the scan metadata are URL-encoded; a plus sign is literal there."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def escaped(path: str) -> str:
    """A path as a pattern that stands for itself only."""
    return re.sub(r"([\\[\]{}*?])", r"\\\1", path)


def with_row_order(df: DataFrame) -> DataFrame:
    """Add path, filename and the row order to a file scan."""
    path = _decoded(F.col("_metadata.file_path"))
    return df.select(
        "*",
        path.alias("path"),
        basename(path).alias("filename"),
        F.col("_metadata.file_block_start").alias("row_block"),
        F.monotonically_increasing_id().alias("row_pos"),
    )


def list_files(spark: SparkSession, roots: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """Paths of all matching files under the roots. No file content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = reader.option("pathGlobFilter", pattern).load(roots)
    return files.select(_decoded(F.col("path")).alias("path"))


def number_rows(df: DataFrame) -> DataFrame:
    """Turn ``row_pos`` into the row's number in its block.

    Positions in a scan depend on the other files of the scan; numbers in a block do
    not. Needed only where one file may be loaded under different runs and its
    readings must get the same ids. A block is one input split, so no group is large.
    """
    keys = ["path", "row_block"]
    starts = df.groupBy(*keys).agg(F.min("row_pos").alias("_start"))
    numbered = df.join(starts, keys).withColumn("row_pos", F.col("row_pos") - F.col("_start"))
    return numbered.select(*df.columns)


def with_path_columns(df: DataFrame, path: str = "path") -> DataFrame:
    """Add year, month_name and filename of <year>/<month>/<file>.csv; others drop out."""
    parts = year_month_parts(path)
    return df.withColumn("_parts", parts).where(F.col("_parts").isNotNull()).select(
        *[c for c in df.columns if c not in ("year", "month_name", "filename")], "_parts.*"
    )


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Text lines with their order."""
    return with_row_order(spark.read.text(paths).withColumnRenamed("value", "line"))


def read_index(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Profile index lines, ready for parse_index."""
    return read_lines(spark, paths)


def headers_of(spark: SparkSession, paths: str | list[str], pattern: str = "*.csv") -> list[tuple[str, list[str]]]:
    """(header line, files) for every distinct header.

    A text scan keeps the rows of each file's first block and of those the first line.
    What comes to the driver is the file list Spark's own scan planning holds there as well.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    # The filter stands below the row positions, so other blocks end in the scan's own stage.
    lines = with_row_order(reader.text(paths).where(F.col("_metadata.file_block_start") == 0))
    first = lines.groupBy("path").agg(F.min_by("value", "row_pos").alias("header"))
    rows = first.select("path", "header").toLocalIterator()
    groups: dict[str, list[str]] = {}
    for row in rows:
        groups.setdefault(row["header"].lstrip("﻿").rstrip("\r"), []).append(row["path"])
    return sorted((header, sorted(files)) for header, files in groups.items())


def _read_one_header(
    spark: SparkSession, header: str, files: list[str], multi_line: bool
) -> DataFrame:
    names = [name.strip() or f"_unnamed{i}" for i, name in enumerate(next(csv.reader([header])))]
    places = [escaped(file) for file in files]
    if multi_line:
        ordered = parsed_records(quoted_records(read_lines(spark, places)), len(names))
    else:
        numbered = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))])
        reader = spark.read.schema(numbered).option("header", "true").option("quote", '"').option("escape", '"')
        ordered = with_row_order(reader.csv(places))
    seen, taken, picked = set(), {c.upper() for c in FILE_COLUMNS}, []
    for i, name in enumerate(names):
        if name not in seen:
            seen.add(name)
            # Names that differ in case only are columns of their own, told apart by a number.
            own, k = name, 2
            while own.upper() in taken:
                own, k = f"{name}_{k}", k + 1
            taken.add(own.upper())
            picked.append(F.col(f"_c{i}").alias(own))
    columns = F.array(*[F.lit(name) for name in names])
    return ordered.select(*picked, *[c for c in FILE_COLUMNS if c != "_columns"],
                          columns.alias("_columns"))


def union_shapes(parts: list[DataFrame]) -> DataFrame:
    """Tables with different columns, united by name; the file columns come last."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    tail = [c for c in FILE_COLUMNS if c in out.columns]
    return out.select(*[c for c in out.columns if c not in tail], *tail)


def read_mixed_csv(
    spark: SparkSession, paths: str | list[str], pattern: str = "*.csv",
    headers: list[tuple[str, list[str]]] | None = None, multi_line: bool = False,
) -> DataFrame:
    """Many CSV files with different headers, united by name, all columns as text.

    Spark applies the first header to every file of one scan, so each distinct header
    gets a scan of its own. Equally named columns keep the first; a name that differs
    only in case from an earlier one gets a number. ``headers`` skips
    the header pass when the caller already knows them. ``multi_line`` allows line
    breaks inside quoted values (but not in the header); files are still read in blocks.
    """
    groups = headers if headers is not None else headers_of(spark, paths, pattern)
    if not groups:
        raise ValueError(f"no CSV files with a header under {paths}")
    return union_shapes([_read_one_header(spark, header, files, multi_line) for header, files in groups])


def read_strings_csv(spark: SparkSession, paths: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """CSV files as text with the null tokens turned into nulls."""
    df = read_mixed_csv(spark, paths, pattern)
    return df.withColumns({
        name: null_tokens(name) for name in df.columns if name not in FILE_COLUMNS
    })


def type_levels(df: DataFrame) -> DataFrame:
    """Text columns to the types of the column catalog; unknown columns stay text."""
    typed = {}
    for name, dtype in df.dtypes:
        if name in FILE_COLUMNS or dtype != "string":
            continue
        kind = column_type(name)
        if kind == "double":
            typed[name] = to_number(name)
        elif kind == "bigint":
            typed[name] = to_number(name).try_cast("bigint")
        elif kind == "timestamp":
            typed[name] = juld_to_timestamp(clean_bytes(name), "string")
    return df.withColumns(typed) if typed else df


def read_levels_csv(spark: SparkSession, paths: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """Level rows from CSV, typed by column name. Types are never inferred."""
    return type_levels(read_strings_csv(spark, paths, pattern))


def read_platform_list(spark: SparkSession, path: str) -> DataFrame:
    """Stored platform numbers as text; a missing list is an empty one."""
    empty = spark.createDataFrame([], "platform_number string")
    try:
        df = spark.read.option("header", "true").csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty
        raise
    if "platform_number" not in df.columns:
        return empty
    return df.select(null_tokens("platform_number").alias("platform_number")).dropna().distinct()
