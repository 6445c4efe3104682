"""Helpers shared by the text operators: written intermediate tables, row identity, text blocks."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null document id inside an operator; it sorts before every id.
NO_ID = -(2**63)
#: Texts are handed to numpy in blocks of about this many characters.
BLOCK_CHARS = 1_000_000

#: monotonically_increasing_id() has the partition above so many bits.
_RANGE_BITS = 33

_own_folder: list[str] = []
_open: list[Workspace] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share (`spark.checkpoint.dir`); where none is set, one of this machine, if it is the only one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_folder:
        _own_folder.append("file://" + tempfile.mkdtemp(prefix="floatlake-"))
    return _own_folder[0]


class Workspace:
    """Written tables of one run: lineage ends at each of them, so a lost executor costs one step."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        _open.append(self)

    def save(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        path = f"{self.root}/{name}"
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table no later step reads."""
        self._delete(f"{self.root}/{name}")

    def close(self) -> None:
        """Delete all tables of the run, once nothing reads its result any more."""
        self._delete(self.root)
        if self in _open:
            _open.remove(self)

    def _delete(self, folder: str) -> None:
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def finished_tables() -> Iterator[None]:
    """Deletes, at its end, the tables of all operators called inside, whose results must be written by then."""
    before = list(_open)
    try:
        yield
    finally:
        for workspace in [x for x in _open if x not in before]:
            workspace.close()


def numbered(rows: DataFrame, order: list[str], workspace: Workspace, name: str) -> DataFrame:
    """All rows with `number`: 0, 1, ... in ascending order (nulls first), which must tell rows apart.

    Sorted ranges of rows are written; the driver sees one count per range, no row.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("number", F.monotonically_increasing_id())
    placed = workspace.save(placed, name)
    sizes = placed.groupBy(F.shiftright("number", _RANGE_BITS).alias("range")).count().orderBy("range").collect()
    starts, total = [], 0
    for x in sizes:
        starts.append((x["range"], total - (x["range"] << _RANGE_BITS)))
        total += x["count"]
    moved = rows.sparkSession.createDataFrame(starts, "range long, moved long")
    joined = placed.withColumn("range", F.shiftright("number", _RANGE_BITS)).join(F.broadcast(moved), "range")
    return joined.withColumn("number", F.col("number") + F.col("moved")).drop("range", "moved")


def row_id(column: str) -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def real_id(column: str) -> Column:
    return F.nullif(F.col(column), F.lit(NO_ID))


def keyed_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`did`, `t`, `text`: rows of one id and one text are one; a null text is empty.

    Other columns are left behind, so their names can't clash.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(row_id(id_column).alias("did"), F.xxhash64(text).alias("t"), text.alias("text"))


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that `df` doesn't have, whatever its case."""
    taken = {name.lower() for name in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def blocks(rows: Iterable[str | None], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about `limit` characters each; a longer text is a range of its own."""
    start = size = 0
    at = -1
    for at, text in enumerate(rows):
        length = len(text) if text else 0
        if at > start and size + length > limit:
            yield start, at
            start, size = at, 0
        size += length
    if at >= start:
        yield start, at + 1


def record_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [x if isinstance(x := columns[f.name], pa.Array) else pa.array(x, f.type) for f in schema], schema=schema
    )
