"""Which files are still to be processed.

A manifest is a Parquet table of (path, run_id, seq), ``seq`` numbering runs as they
finish. It is appended after a run's output is complete, and a run writes only to
folders named by its run_id. A run that was cut short can be repeated with the same
run_id, which replaces its whole output, or with a new one: readers leave out what
unfinished runs wrote. Lists of files stay tables; only the reader of files takes paths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from floatlake.sources.tables import read_or_empty

MANIFEST_SCHEMA = "path string, run_id bigint, seq bigint"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, MANIFEST_SCHEMA)


def new_files(found: DataFrame, done: DataFrame, column: str = "path") -> DataFrame:
    """Files found that are not in the list of processed ones, each once."""
    return found.select(column).distinct().join(done.select(column), column, "left_anti")


def keep_pending(files: DataFrame, path: str) -> DataFrame:
    """Write the files a run takes, so that it reads and records the same ones."""
    files.select("path").write.mode("overwrite").parquet(path)
    return files.sparkSession.read.schema("path string").parquet(path)


def pending_paths(files: DataFrame) -> list[str]:
    """Paths for a reader; a scan's own planning holds the same list on the driver."""
    return sorted(row["path"] for row in files.select("path").toLocalIterator())


def finish_run(spark: SparkSession, manifest: str, files: DataFrame, run_id: int) -> None:
    """Record the files of a finished run, as the latest one."""
    last = read_manifest(spark, manifest).agg(F.max("seq")).first()[0]
    files.select(
        "path", F.lit(run_id).cast("bigint").alias("run_id"),
        F.lit((last or 0) + 1).cast("bigint").alias("seq"),
    ).write.mode("append").parquet(manifest)


def finished_runs(spark: SparkSession, manifest: str) -> DataFrame:
    return read_manifest(spark, manifest).select("run_id").distinct()


def read_finished(spark: SparkSession, path: str, manifest: str) -> DataFrame:
    """A table written by run, without what runs left behind that never finished."""
    return spark.read.parquet(path).join(finished_runs(spark, manifest), "run_id", "left_semi")


def previous_run(spark: SparkSession, manifest: str, run_id: int | None = None) -> int | None:
    """The run that finished last, other than this one."""
    done = read_manifest(spark, manifest)
    if run_id is not None:
        done = done.where(F.col("run_id") != run_id)
    return done.agg(F.max_by("run_id", "seq")).first()[0]
