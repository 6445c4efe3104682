"""Exact substring deduplication by windows that double in length while they repeat."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floatlake.llm.common import Workspace, blocks, keyed_texts, real_id, record_batch
from floatlake.llm.wordtable import WordTable, window_minimum, windows

#: Lengths below this are not worth a level of their own.
SHORTEST = 16

_MARKS = pa.schema([("key", pa.int64()), ("did", pa.int64()), ("t", pa.int64())])
_WINDOWS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("did", pa.int64()), ("t", pa.int64()), ("pos", pa.int32())])
_KEPT = pa.schema([("did", pa.int64()), ("kept", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())])


def levels(length: int) -> list[int]:
    """`length` and its halves, shortest first: each level is twice the one before."""
    found = [length]
    while found[0] % 2 == 0 and found[0] // 2 >= SHORTEST:
        found.insert(0, found[0] // 2)
    return found


def _marks(hashes: np.ndarray, length: int, target: int) -> np.ndarray:
    """For every window of `target` words the least hash among its windows of `length` words.

    Equal windows have equal marks, so a window can only repeat if its mark does, and a text
    needs to send one mark for a run of windows.
    """
    return window_minimum(windows(hashes, length), target - length + 1)


def _live(table: WordTable, hashes: np.ndarray, done: list[int], target: int, survivors: list | None) -> np.ndarray:
    """Starts of the target windows whose marks of the last finished level still repeat."""
    starts = np.flatnonzero(table.fits(target))
    if done and len(starts):
        marks = _marks(hashes, done[-1], target)[starts].view(np.int64)
        text_of = table.text_of[starts]
        keep = np.zeros(len(starts), bool)
        bounds = np.searchsorted(text_of, np.arange(len(survivors) + 1))
        for i, keys in enumerate(survivors):
            if keys is not None and bounds[i + 1] > bounds[i]:
                keep[bounds[i] : bounds[i + 1]] = np.isin(marks[bounds[i] : bounds[i + 1]], keys)
        starts = starts[keep]
    return starts


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, WordTable, list | None]]:
    texts = batch.column("text").to_pylist()
    keys = batch.column("keys") if "keys" in batch.schema.names else None
    for a, b in blocks(texts):
        survivors = None if keys is None else [None if x.as_py() is None else np.array(x.as_py(), np.int64) for x in keys[a:b]]
        yield a, b, WordTable([(x or "").encode() for x in texts[a:b]]), survivors


def _emit_marks(level: int, done: list[int], target: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            did, t = batch.column("did").to_numpy(), batch.column("t").to_numpy()
            for a, _, table, survivors in _texts(batch):
                hashes = table.hashes()
                starts = _live(table, hashes, done, target, survivors)
                if not len(starts):
                    continue
                marks, text_of = _marks(hashes, level, target)[starts], table.text_of[starts]
                new = np.ones(len(marks), bool)
                new[1:] = (marks[1:] != marks[:-1]) | (text_of[1:] != text_of[:-1])
                row = a + text_of[new]
                yield record_batch(_MARKS, key=marks[new].view(np.int64), did=did[row], t=t[row])

    return run


def _emit_windows(done: list[int], target: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            did, t = batch.column("did").to_numpy(), batch.column("t").to_numpy()
            for a, _, table, survivors in _texts(batch):
                hashes = table.hashes()
                starts = _live(table, hashes, done, target, survivors)
                if not len(starts):
                    continue
                text_of = table.text_of[starts]
                yield record_batch(
                    _WINDOWS,
                    a=windows(hashes, target, 1)[starts].view(np.int64), b=windows(hashes, target, 2)[starts].view(np.int64),
                    did=did[a + text_of], t=t[a + text_of], pos=(starts - table.first[text_of]).astype(np.int32),
                )

    return run


def _cut(target: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            did = batch.column("did")
            for a, b, table, _ in _texts(batch):
                kept, removed = [], np.zeros(b - a, np.int64)
                for i in range(b - a):
                    first, count = table.first[i], table.count[i]
                    if batch.column("copy")[a + i].as_py():
                        gone = np.full(count, count >= target)
                    else:
                        change = np.zeros(count + 1, np.int32)
                        if (starts := batch.column("starts")[a + i].as_py()) is not None:
                            at = np.array(starts, np.int64)
                            np.add.at(change, at, 1)
                            np.add.at(change, at + target, -1)
                        gone = np.cumsum(change)[:count] > 0
                    removed[i] = gone.sum()
                    raw = table.bytes[table.text_start[i] : table.text_end[i]].tobytes().split()
                    kept.append(b" ".join(raw if not removed[i] else [w for w, x in zip(raw, gone.tolist(), strict=True) if not x]).decode())
                yield record_batch(_KEPT, did=did[a:b], kept=kept, n_words=table.count, n_removed=removed)

    return run


def drop_repeated_windows(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = 50
) -> DataFrame:
    """`doc_id, kept, n_words, n_removed` of every row.

    Words are runs of other characters than space and \\t to \\r. Each word goes that lies in a
    window of `length` consecutive words whose sequence also starts in a document with a smaller
    id; windows are judged on the input. `kept` joins the other words by one space. Null texts
    have no word; rows with one id are one document; a null id is the smallest and stays null.
    An empty table gives no row.

    Levels go from the shortest of `length`, `length / 2`, ... to `length`. A level keeps the
    windows whose part of its length occurs in two different texts; only those are looked at
    with twice the length. Copies of a whole text take no part: all but the smallest lose every window.
    """
    workspace = Workspace(docs.sparkSession, "substrings")
    texts = keyed_texts(docs, id_column, text_column)
    t2 = F.xxhash64(F.lit(1), "text")
    originals = texts.select("did", "t", t2.alias("t2")).groupBy("t", "t2").agg(F.min("did").alias("did"))
    originals = workspace.save(originals.select("did", "t").distinct(), "originals")

    steps = levels(length)
    source, done, found = texts, [], True
    for step, level in enumerate(steps[:-1]):
        marks = workspace.save(source.mapInArrow(_emit_marks(level, done, length), "key long, did long, t long"), f"marks{step}")
        repeated = marks.groupBy("key").agg(F.min("t").alias("least"), F.max("t").alias("most")).filter("least <> most").select("key")
        repeated = workspace.save(repeated, f"repeated{step}")
        found = bool(repeated.take(1))
        if not found:
            break
        survivors = marks.join(repeated, "key", "left_semi").groupBy("did", "t").agg(F.collect_set("key").alias("keys"))
        survivors = workspace.save(survivors.join(originals, ["did", "t"], "left_semi"), f"survivors{step}")
        workspace.drop(f"marks{step}")
        source = texts.join(survivors, ["did", "t"])
        done.append(level)
    if found:
        spots = source.mapInArrow(_emit_windows(done, length), "a long, b long, did long, t long, pos int")
        spots = workspace.save(spots, "windows")
        firsts = spots.groupBy("a", "b").agg(F.min("did").alias("first"), F.max("did").alias("last")).filter("first < last")
        firsts = workspace.save(firsts.select("a", "b", "first"), "firsts")
        covered = spots.join(firsts, ["a", "b"]).filter("did > first").groupBy("did", "t").agg(F.collect_set("pos").alias("starts"))
        marked = originals.join(covered, ["did", "t"], "left").withColumn("copy", F.lit(False))
    else:
        marked = originals.withColumns({"starts": F.lit(None).cast("array<int>"), "copy": F.lit(False)})
    marked = workspace.save(marked, "marked")
    joined = texts.join(marked, ["did", "t"], "left").withColumn("copy", F.coalesce("copy", F.lit(True)))
    return joined.select("did", "text", "starts", "copy").mapInArrow(_cut(length), "did long, kept string, n_words long, n_removed long").select(
        real_id("did").alias("doc_id"), "kept", "n_words", "n_removed"
    )
