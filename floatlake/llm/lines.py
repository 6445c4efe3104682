"""Line deduplication over levelled sorted runs of line hashes."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floatlake.llm.common import Workspace, free_name, keyed_texts, real_id, row_id

#: The table is taken in this many batches, by falling document id.
BATCHES = 4
#: Runs of one level that are merged into one of the next.
FAN_OUT = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["k1", "k2"]


def line_key(line: Column) -> Column:
    """The line without spaces and \\t \\n \\v \\f \\r at both ends, A-Z lower-cased and nothing else."""
    bare = F.btrim(line, F.lit(" \t\n\x0b\f\r"))
    # lower() also changes other letters; where each code point is one byte there are none.
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """`k1, k2, did, t, pos` of every line whose key has `min_chars` code points, from `keyed_texts`."""
    key = F.col("key")
    return (
        docs.select("did", "t", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .select("did", "t", "pos", line_key(F.col("line")).alias("key"))
        .filter(F.char_length(key) >= min_chars)
        .select(F.xxhash64(key).alias("k1"), F.xxhash64(F.lit(1), key).alias("k2"), "did", "t", "pos")
    )


class LineRuns:
    """Every line key seen so far: sorted runs `k1, k2, n, holder` in levels, and hits on them.

    A key lies in exactly one run. Batches come by falling document id, so the batch that
    brings a key holds its largest document; later batches only count it again.
    """

    def __init__(self, workspace: Workspace, fan_out: int = FAN_OUT) -> None:
        self.workspace, self.fan_out = workspace, fan_out
        self.levels: list[list[tuple[str, DataFrame]]] = []
        self.hits: list[DataFrame] = []
        self.made = 0

    def _write(self, rows: DataFrame) -> tuple[str, DataFrame]:
        name = f"run{self.made}"
        self.made += 1
        return name, self.workspace.save(rows.repartitionByRange("k1").sortWithinPartitions(*KEY), name)

    def _all(self) -> list[DataFrame]:
        return [run for level in self.levels for _, run in level]

    def _compact(self, level: int) -> None:
        while level < len(self.levels) and len(self.levels[level]) >= self.fan_out:
            old, self.levels[level] = self.levels[level], []
            merged = old[0][1]
            for _, run in old[1:]:
                merged = merged.unionByName(run)
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._write(merged))
            for name, _ in old:
                self.workspace.drop(name)
            level += 1

    def add(self, tally: DataFrame) -> None:
        """Take in a batch `k1, k2, n, holder`: keys no run has become a run, the others are hits."""
        new = tally
        for run in self._all():
            new = new.join(run.select(*KEY), KEY, "left_anti")
        seen = self._all()
        if not self.levels:
            self.levels.append([])
        if seen:
            known = seen[0].select(*KEY)
            for run in seen[1:]:
                known = known.unionByName(run.select(*KEY))
            hits = tally.join(known, KEY, "left_semi")
            self.hits.append(self.workspace.save(hits, f"hits{self.made}"))
        self.levels[0].append(self._write(new))
        self._compact(0)

    def tallies(self) -> DataFrame:
        """`k1, k2, n, holder` of every key: documents that hold it, and the largest of them."""
        rows: DataFrame | None = None
        for part in [*self._all(), *self.hits]:
            rows = part if rows is None else rows.unionByName(part)
        return rows.groupBy(*KEY).agg(F.sum("n").alias("n"), F.max("holder").alias("holder"))


def _without_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, totals, dropped = [], [], []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
            lines = (text or "").split("\n")
            out = set(gone or ())
            kept.append("\n".join([x for i, x in enumerate(lines) if i not in out]) if out else text or "")
            totals.append(len(lines))
            dropped.append(len(out))
        columns = {name: batch.column(name) for name in batch.schema.names if name not in ("text", "gone")}
        yield pa.RecordBatch.from_pydict(
            columns | {"kept": pa.array(kept, pa.string()), "n_lines": pa.array(totals, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())}
        )


def repeated_lines(docs: DataFrame, workspace: Workspace, min_chars: int, min_docs: int) -> DataFrame:
    """`did, t, gone`: positions of the lines to drop from a text, from `keyed_texts`."""
    # Boundaries of the batches, by approximate quantiles: ids of a batch are larger than those of the next.
    cuts = docs.agg(F.percentile_approx("did", [k / BATCHES for k in range(1, BATCHES)], 1000)).first()[0] or []
    number = F.lit(0)
    for cut in cuts:
        number = number + (F.col("did") <= cut).cast("int")
    hashed = line_hashes(docs, min_chars).withColumn("batch", number)
    hashed = workspace.save(hashed, "lines", ["batch"])
    runs = LineRuns(workspace)
    for batch in range(BATCHES):
        per_doc = hashed.filter(F.col("batch") == batch).groupBy(*KEY, "did").agg(F.lit(1).alias("one"))
        tally = per_doc.groupBy(*KEY).agg(F.count("*").alias("n"), F.max("did").alias("holder"))
        runs.add(workspace.save(tally, f"tally{batch}"))
        workspace.drop(f"tally{batch}")
    common = workspace.save(runs.tallies().filter(F.col("n") >= min_docs).select(*KEY, "holder"), "common")
    gone = hashed.join(common, KEY).filter("did <> holder").select("did", "t", "pos")
    return gone.groupBy("did", "t").agg(F.collect_set("pos").alias("gone"))


def drop_repeated_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """`doc_id, kept, n_lines, n_dropped` of every row.

    A line's key is the trimmed line with A-Z lower-cased. A key of `min_chars` code points or
    more that occurs in `min_docs` documents or more loses all its lines but those of the largest
    document that holds it. A null or empty text is one empty line. Rows with the same id are one
    document; a null id sorts before all others and stays null. An empty table gives no row.
    """
    workspace = Workspace(docs.sparkSession, "lines")
    texts = keyed_texts(docs, id_column, text_column)
    gone = repeated_lines(texts, workspace, min_chars, min_docs)
    joined = texts.join(gone, ["did", "t"], "left").select("did", "text", "gone")
    return joined.mapInArrow(_without_lines, "did long, kept string, n_lines long, n_dropped long").select(
        real_id("did").alias("doc_id"), "kept", "n_lines", "n_dropped"
    )


def with_kept_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """`docs` with the lines gone from the text column; all other columns stay as they are.

    Null texts stay null.
    """
    workspace = Workspace(docs.sparkSession, "lines")
    gone = repeated_lines(keyed_texts(docs, id_column, text_column), workspace, min_chars, min_docs)
    did, t, out = (free_name(docs, x) for x in ("did", "t", "gone"))
    gone = gone.select(F.col("did").alias(did), F.col("t").alias(t), F.col("gone").alias(out))
    text = F.col(text_column)
    keyed = docs.withColumns({did: row_id(id_column), t: F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))})
    joined = keyed.join(gone, [did, t], "left")
    kept = _keep_lines()(F.struct(text.cast("string").alias("text"), F.col(out).alias("gone")))
    return joined.withColumn(text_column, F.when(F.col(out).isNull(), text).otherwise(kept)).select(*docs.columns)


def _keep_lines():
    @F.pandas_udf("string")
    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            kept = []
            for text, gone in zip(batch["text"], batch["gone"], strict=True):
                out = () if gone is None else set(gone)
                kept.append("\n".join([x for i, x in enumerate(text.split("\n")) if i not in out]) if out else text)
            yield pd.Series(kept, dtype=object)

    return keep
