"""CSV with line breaks inside quoted values, read in blocks.

Whether a line starts a record depends on all quotes before it in its file: a record starts where their
number is even. So the quotes of each block are counted first; sums over the blocks before it
tell each block whether it begins inside a value, and with that its lines can be put together where they
lie. Only the pieces of records that cross a border of blocks meet elsewhere, two or so a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

PLACE = ["path", "filename", "row_block", "row_pos"]

_PIECES = pa.schema([
    ("path", pa.string()), ("filename", pa.string()), ("row_block", pa.int64()), ("row_pos", pa.int64()), ("record", pa.string()),
    ("starts", pa.bool_()), ("ends", pa.bool_()),
])


def _quotes(line: str):
    return F.char_length(line) - F.char_length(F.replace(F.col(line), F.lit('"'), F.lit("")))


def _open_blocks(lines: DataFrame) -> DataFrame:
    """`path, row_block, inside`: whether a block begins inside a quoted value."""
    blocks = lines.groupBy("path", "row_block").agg((F.sum(_quotes("line")) % 2).alias("odd"))
    # A row per block of a file, not per line.
    before = Window.partitionBy("path").orderBy("row_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1
    return blocks.select("path", "row_block", inside.alias("inside"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each block, put together from its lines; the first and last may be pieces."""
    block, place, held, inside, starts = None, None, [], False, True

    def piece(ends: bool) -> tuple:
        return *place, "\n".join(held), starts, ends

    for batch in batches:
        rows = []
        for path, filename, row_block, row_pos, line, opens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (path, row_block) != block:
                if held:
                    rows.append(piece(False))
                block, held, inside, starts = (path, row_block), [], opens, not opens
            if not held:
                place = path, filename, row_block, row_pos
            held.append(line)
            inside ^= line.count('"') % 2 == 1
            if not inside:
                rows.append(piece(True))
                held, starts = [], True
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _PIECES, strict=True)], schema=_PIECES)
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(piece(False), _PIECES, strict=True)], schema=_PIECES)


def quoted_records(lines: DataFrame) -> DataFrame:
    """`path, filename, row_block, row_pos, record` of every record of files read by lines (`line`, PLACE).

    A record stands at its first line; its lines are joined by \\n. A quote that is never closed makes the
    rest of the file one record, as it does when a file is read whole, but without a line break at its end.
    """
    opened = lines.select(*PLACE, "line").join(F.broadcast(_open_blocks(lines)), ["path", "row_block"])
    schema = "path string, filename string, row_block bigint, row_pos bigint, record string, starts boolean, ends boolean"
    pieces = opened.select(*PLACE, "line", "inside").mapInArrow(_pieces, schema)
    whole = pieces.where("starts AND ends").select(*PLACE, "record")
    cut = pieces.where("NOT (starts AND ends)")
    # Pieces that start a record number those that go on with it: a file has two or so for each of its blocks.
    order = Window.partitionBy("path").orderBy("row_block", "row_pos")
    numbered = cut.withColumn("number", F.sum(F.col("starts").cast("int")).over(order))
    joined = numbered.groupBy("path", "filename", "number").agg(
        F.min(F.struct("row_block", "row_pos")).alias("at"), F.sort_array(F.collect_list(F.struct("row_block", "row_pos", "record"))).alias("parts"),
    )
    crossing = joined.select(
        "path", "filename", F.col("at.row_block").alias("row_block"), F.col("at.row_pos").alias("row_pos"),
        F.array_join(F.transform("parts", lambda x: x["record"]), "\n").alias("record"),
    )
    return whole.unionByName(crossing)


def parsed_records(records: DataFrame, n_columns: int) -> DataFrame:
    """`_c0` ... and PLACE of every record but the first of each file, as the CSV reader gives them."""
    fields = ", ".join(f"_c{i} string" for i in range(n_columns))
    first = records.where("row_block = 0").groupBy("path").agg(F.min("row_pos").alias("_first"))
    # A row per file: Spark broadcasts it while it is small.
    body = records.join(first, "path", "left").where("row_block > 0 OR row_pos > _first").where(F.trim("record") != "")
    parsed = F.from_csv("record", F.lit(fields), {"quote": '"', "escape": '"'})
    return body.withColumn("_row", parsed).select("_row.*", *PLACE)
