"""File-stream form of the load flow.

The stream tracks which files were seen; every micro-batch hands its file names to
the batch flow. Its run id comes from the stream's own id and the batch number: a batch
that is repeated after a failure replaces its own output, and streams and batch runs that
share an output never meet in one run. Files some other run has loaded are left out by
the manifest. Runs that end at the same moment are not kept from each other: let one
stream at a time write to an output.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from floatlake.plans.flows import run_load
from floatlake.sources.csv import _decoded, escaped

_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def file_stream(spark: SparkSession, root: str, pattern: str = "*.csv", max_files: int = 10_000) -> DataFrame:
    """Names of arriving files; their content is not read here."""
    return (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", max_files)
        .load(root)
        .select(_decoded(F.col("path")).alias("path"))
    )


def stream_run_id(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """A number for one batch of one stream; a new checkpoint is a new stream."""
    stream = spark.read.text(f"{escaped(checkpoint)}/metadata").first()[0]
    return int(hashlib.sha256(f"{stream}/{batch_id}".encode()).hexdigest()[:15], 16)


def start_load_stream(
    spark: SparkSession, root: str, out: str, checkpoint: str, mode: str = "row",
    max_files: int = 10_000,
) -> StreamingQuery:
    """Load everything that has arrived, then stop; run again for what comes later."""
    def load(batch: DataFrame, batch_id: int) -> None:
        run_id = stream_run_id(batch.sparkSession, checkpoint, batch_id)
        run_load(batch.sparkSession, root, out, run_id, mode, files=batch)

    return (
        file_stream(spark, root, max_files=max_files)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
