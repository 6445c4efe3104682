"""Quality rules: an isolation forest on rule statistics, with a threshold from labelled rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floatlake.llm.common import Workspace, blocks, record_batch
from floatlake.llm.wordtable import SPACE, WordTable, mix, windows

TREES = 128
#: Rows each tree is grown from; the forest sees at most TREES x SAMPLE rows, drawn by a hash.
SAMPLE = 256
SCORE_BINS = 1000
#: Share of the labelled good documents that the threshold must keep.
KEEP_GOOD = 0.995
REPEAT_WINDOW = 5

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_STATISTICS = pa.schema([("doc_id", pa.int64()), *((name, pa.int64()) for name in STATISTICS)])
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
#: First bytes of code points outside white space.
_POINT = ~SPACE & ((np.arange(256) & 0xC0) != 0x80)


def text_statistics(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Counts of each text: words, code points in words, symbols, repeated lines, words in repeated windows."""
    table = WordTable(texts)
    points = np.concatenate(([0], np.cumsum(_POINT[table.bytes])))
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[table.bytes])))
    repeat_lines = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if b"\n" in text:
            lines = [x for x in text.split(b"\n") if x.split(None, 1)]
            repeat_lines[i] = len(lines) - len(set(lines))
    covered = np.zeros(len(table.start), np.int64)
    keys = windows(table.hashes(), REPEAT_WINDOW)
    starts = np.flatnonzero(table.fits(REPEAT_WINDOW))
    if len(starts):
        # The text number goes into the key: windows are compared inside a text.
        own = mix(keys[starts] ^ mix(table.text_of[starts].astype(np.uint64), 5), 9)
        order = np.argsort(own)
        same = own[order][1:] == own[order][:-1]
        again = np.zeros(len(starts), bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        change = np.zeros(len(table.start) + 1, np.int64)
        change[starts[again]] += 1
        change[starts[again] + REPEAT_WINDOW] -= 1
        covered = (np.cumsum(change)[:-1] > 0).astype(np.int64)
    total = np.concatenate(([0], np.cumsum(covered)))
    return {
        "n_words": table.count.astype(np.int64),
        "word_chars": points[table.text_end] - points[table.text_start],
        "n_symbols": symbols[table.text_end] - symbols[table.text_start],
        "n_dup_lines": repeat_lines,
        "n_repeat_words": total[table.first + table.count] - total[table.first],
    }


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for a, b in blocks(texts):
            found = text_statistics([(x or "").encode() for x in texts[a:b]])
            yield record_batch(_STATISTICS, doc_id=batch.column("doc_id")[a:b], **found)


def statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`doc_id` and STATISTICS of every row. A null text has no word."""
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return texts.mapInArrow(_statistics, ", ".join(f"{name} long" for name in _STATISTICS.names))


def features(rows: pd.DataFrame) -> np.ndarray:
    """What the forest splits on: word length and the shares of symbols and of repeated words.

    Shares don't grow with the text; roots and logarithms spread the small ones, which random
    splits would seldom part. Repeated lines and the length are no sign: good documents have
    shared lines and all lengths.
    """
    words = np.maximum(rows["n_words"].to_numpy(float), 1)
    chars = np.maximum(rows["word_chars"].to_numpy(float), 1)
    symbols, repeated = rows["n_symbols"].to_numpy(float), rows["n_repeat_words"].to_numpy(float)
    return np.stack([np.log(chars / words), np.sqrt(symbols / chars), np.sqrt(repeated / words)], axis=1)


def _path(n: np.ndarray | int) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.maximum(np.asarray(n, float), 1)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649) - 2 * (n - 1) / n, np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class IsolationForest:
    """Trees as arrays: the feature split on (-1: leaf), its value, the left child, the leaf's path length."""

    feature: np.ndarray
    value: np.ndarray
    left: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    usual: float

    @classmethod
    def grow(cls, rows: np.ndarray, trees: int = TREES, sample: int = SAMPLE) -> IsolationForest:
        """Random splits of random parts of `rows`, whose order doesn't matter."""
        rng = np.random.default_rng(3)
        rows = rows[np.lexsort(rows.T[::-1])]
        size = min(sample, len(rows))
        depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
        feature, value, left, path, roots = [], [], [], [], []

        def node() -> int:
            for column, x in ((feature, -1), (value, 0.0), (left, 0), (path, 0.0)):
                column.append(x)
            return len(feature) - 1

        for _ in range(trees):
            part = rows[rng.choice(len(rows), size, replace=False)] if size else rows
            roots.append(node())
            open_nodes = [(roots[-1], part, 0)]
            while open_nodes:
                at, own, level = open_nodes.pop()
                low, high = (own.min(axis=0), own.max(axis=0)) if len(own) else (np.zeros(1), np.zeros(1))
                able = np.flatnonzero(high > low)
                if level >= depth or not len(able):
                    path[at] = level + float(_path(len(own)))
                    continue
                feature[at] = int(rng.choice(able))
                value[at] = float(rng.uniform(low[feature[at]], high[feature[at]]))
                left[at] = node()
                right = node()
                below = own[:, feature[at]] < value[at]
                open_nodes += [(left[at], own[below], level + 1), (right, own[~below], level + 1)]
        return cls(np.array(feature), np.array(value), np.array(left), np.array(path), np.array(roots), float(_path(size)) or 1.0)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly of each row, 0 to 1: 2 to the minus mean path length over the usual one."""
        total = np.zeros(len(rows))
        index = np.arange(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            while True:
                split = self.feature[at]
                if (split < 0).all():
                    break
                right = rows[index, np.maximum(split, 0)] >= self.value[at]
                at = np.where(split < 0, at, self.left[at] + right)
            total += self.path[at]
        return 2.0 ** (-total / len(self.roots) / self.usual)


def scores(spark: SparkSession, forest: IsolationForest, columns: list[str] = STATISTICS) -> Column:
    shared = spark.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(shared.value.score(features(batch)))

    return score(F.struct(*columns))


def calibrate(bins: dict[tuple[int, int], int], keep_good: float = KEEP_GOOD) -> float:
    """Score from which a document goes, from counts by (bin, label; 1: good).

    Of the thresholds that keep `keep_good` of the good documents, the one with the largest
    difference between the share of bad ones found and of good ones lost; ties: the highest.
    No labelled bad document: nothing goes.
    """
    good = np.zeros(SCORE_BINS + 1)
    bad = np.zeros(SCORE_BINS + 1)
    for (number, label), n in bins.items():
        (good if label else bad)[number] += n
    if not bad.sum():
        return np.inf
    lost = np.cumsum(good[::-1])[::-1] / max(good.sum(), 1)
    gain = np.cumsum(bad[::-1])[::-1] / bad.sum() - lost
    gain[lost > 1 - keep_good] = -1
    best = SCORE_BINS - int(np.argmax(gain[::-1]))
    return best / SCORE_BINS if gain[best] > 0 else np.inf


def quality_verdicts(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_id: str = "doc_id", label_column: str = "quality", keep_good: float = KEEP_GOOD,
) -> DataFrame:
    """`doc_id`, STATISTICS, `base_failed`, `kept`, `anomaly` of every row.

    `base_failed`: fewer than 10 words, or over a fifth of the words in repeated 5-word windows.
    `anomaly`: the isolation forest's score, from statistics of a hash sample of about
    TREES x SAMPLE rows (twice that at most). `kept`: not failed, and less anomalous than the threshold, which is
    chosen on all labelled rows that the base keeps. Null labels count for nothing; a null text
    has no word and fails. Repeated rows are judged alike; empty tables give no row.
    """
    spark = docs.sparkSession
    workspace = Workspace(spark, "quality")
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    rows = workspace.save(statistics(docs, id_column, text_column).withColumn("base_failed", failed), "statistics")
    share = min(1.0, TREES * SAMPLE / max(1, rows.count()))
    draw = F.pmod(F.xxhash64("doc_id", *STATISTICS), F.lit(1 << 30))
    # The smallest hashes, in their order: the same rows on every run, also where repeated rows make them too many.
    ranked = rows.filter(draw < int(share * (1 << 30))).orderBy(draw, *STATISTICS).limit(2 * TREES * SAMPLE)
    drawn = ranked.select(*STATISTICS).toPandas()
    forest = IsolationForest.grow(features(drawn))
    scored = workspace.save(rows.withColumn("anomaly", scores(spark, forest)), "scored")
    known = labels.select(F.col(label_id).cast("long").alias("doc_id"), F.col(label_column).cast("int").alias("good")).dropna()
    counted = (
        scored.filter("not base_failed").join(known, "doc_id")
        .groupBy(F.floor(F.col("anomaly") * SCORE_BINS).cast("int").alias("bin"), (F.col("good") > 0).cast("int").alias("good")).count()
    )
    threshold = calibrate({(row.bin, row.good): row["count"] for row in counted.collect()}, keep_good)
    kept = ~F.col("base_failed") & (F.floor(F.col("anomaly") * SCORE_BINS) / SCORE_BINS < F.lit(float(threshold)))
    return scored.select("doc_id", *STATISTICS, "base_failed", kept.alias("kept"), "anomaly")
