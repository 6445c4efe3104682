"""Stored tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet table, empty when it does not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def partition_values(spark: SparkSession, pattern: str, column: str) -> list[int]:
    """Whole numbers that ``column=`` has in the names of the folders a pattern finds; no file is opened."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(path) or []
    names = [part for status in found for part in status.getPath().toString().split("/")]
    return sorted({int(x.split("=", 1)[1]) for x in names if x.startswith(f"{column}=")})
