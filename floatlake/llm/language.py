"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floatlake.llm.common import Workspace, blocks, free_name

BUCKETS = 1 << 15
GRAMS = (1, 2, 3)
SMOOTHING = 0.5
UNKNOWN = "und"
#: The log-probability matrix that is broadcast may not be larger.
MODEL_BYTES = 256 << 20

_LETTER = regex.compile(r"\p{L}")
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_COUNTS = pa.schema([("label", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])


def gram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all n-grams of lower-cased texts, one row per n, and the bounds of each text.

    A text has a space before and after it; a column is the n-grams that start at one character.
    """
    padded = [f" {text.lower()}  " for text in texts]
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(x) for x in padded])
    bounds = np.stack((np.concatenate(([0], ends[:-1])), ends - 2), axis=1)
    n = len(points)
    table = np.empty((len(GRAMS), n), np.int32)
    for row, gram in enumerate(GRAMS):
        mixed = np.full(n, gram, np.uint32) * np.uint32(0x27D4EB2F)
        for k in range(gram):
            mixed[: n - k] = (mixed[: n - k] ^ points[k:]) * _FACTORS[k]
            mixed ^= mixed >> np.uint32(15)
        table[row] = mixed & np.uint32(BUCKETS - 1)
    return table, bounds


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of one partition: at most languages x buckets rows, and bucket -1 for documents."""
    counts: dict[str, np.ndarray] = {}
    documents: dict[str, int] = {}
    for batch in batches:
        texts, labels = batch.column("text").to_pylist(), batch.column("label").to_pylist()
        for a, b in blocks(texts):
            for label in set(labels[a:b]):
                own = [x for x, y in zip(texts[a:b], labels[a:b], strict=True) if y == label]
                table, bounds = gram_buckets(own)
                inside = np.ones(table.shape[1], bool)
                inside[bounds[:, 1]] = inside[bounds[:, 1] + 1] = False
                total = counts.setdefault(label, np.zeros(BUCKETS, np.int64))
                total += np.bincount(table[:, inside].ravel(), minlength=BUCKETS)
                documents[label] = documents.get(label, 0) + len(own)
    for label, total in counts.items():
        used = np.flatnonzero(total)
        buckets = np.concatenate(([-1], used)).astype(np.int32)
        n = np.concatenate(([documents[label]], total[used]))
        yield pa.RecordBatch.from_arrays([pa.array([label] * len(n)), pa.array(buckets), pa.array(n)], schema=_COUNTS)


@dataclass(frozen=True)
class LanguageModel:
    labels: list[str]
    #: One row per label, one column per bucket.
    weights: np.ndarray
    priors: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Label and posterior probability of each text. Ties go to the label first in order."""
        found, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        rows = [i for i, x in enumerate(texts) if x and _LETTER.search(x)]
        if not rows or not self.labels:
            return found, scores
        table, bounds = gram_buckets([texts[i] for i in rows])
        sums = np.empty((len(self.labels), len(rows)))
        for k, weights in enumerate(self.weights):
            each = weights[table[0]]
            for row in table[1:]:
                each += weights[row]
            sums[k] = np.add.reduceat(each, bounds.ravel(), dtype=np.float64)[::2] + self.priors[k]
        sums -= sums.max(axis=0)
        odds = np.exp(sums)
        odds /= odds.sum(axis=0)
        for i, k, score in zip(rows, odds.argmax(axis=0), odds.max(axis=0), strict=True):
            found[i], scores[i] = self.labels[k], min(1.0, score)
        return found, scores


def learn(docs: DataFrame, text: Column, label: Column) -> LanguageModel:
    """Counts over all rows of `docs` with a text and a label.

    Only languages x BUCKETS sums come to the driver, however many documents there are.
    """
    rows = docs.select(text.cast("string").alias("text"), label.cast("string").alias("label")).dropna()
    counts = rows.mapInArrow(_count, "label string, bucket int, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    # Written, so that the texts are counted once.
    counts = Workspace(docs.sparkSession, "language").save(counts, "counts")
    most = MODEL_BYTES // (BUCKETS * 4)
    labels = sorted(x[0] for x in counts.filter("bucket = -1").select("label").limit(most + 1).collect())
    if len(labels) > most:
        raise ValueError(f"more than {most} labels make a model over {MODEL_BYTES} bytes")
    found = counts.toPandas() if labels else pd.DataFrame({"label": [], "bucket": [], "n": []})
    table, documents = np.zeros((len(labels), BUCKETS)), np.ones(len(labels))
    number = found["label"].map({x: i for i, x in enumerate(labels)}).to_numpy(np.int64)
    bucket, n = found["bucket"].to_numpy(np.int64), found["n"].to_numpy(np.float64)
    real = bucket >= 0
    np.add.at(table, (number[real], bucket[real]), n[real])
    documents[number[~real]] = n[~real]
    table += SMOOTHING
    weights = np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)
    return LanguageModel(labels, weights, np.log(documents / documents.sum()) if labels else documents)


def predictions(spark: SparkSession, model: LanguageModel, text: Column) -> Column:
    """`struct<lang_pred, score>` of a text column; the model is broadcast (MODEL_BYTES at most)."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.tolist()
            parts = [shared.value.predict(texts[a:b]) for a, b in blocks(texts)]
            yield pd.DataFrame({
                "lang_pred": pd.Series([x for found, _ in parts for x in found], dtype=object),
                "score": np.concatenate([x for _, x in parts]) if parts else np.zeros(0),
            })

    return predict(text.cast("string"))


def identify(
    docs: DataFrame, learn_from: Column, text_column: str = "text", label_column: str = "lang"
) -> DataFrame:
    """`docs` with a struct column `language` (`lang_pred`, `score`), under a free name.

    Learns from the rows where `learn_from` holds and text and label are not null; predicts
    every row from its text alone. No letter, a null text or nothing to learn from: `und`, 0.
    Repeated rows count as often as they occur; an empty table gives no row.
    """
    model = learn(docs.filter(learn_from), F.col(text_column), F.col(label_column))
    return docs.withColumn(free_name(docs, "language"), predictions(docs.sparkSession, model, F.col(text_column)))


def fold(id_column: str = "doc_id", folds: int = 3) -> Column:
    """crc32 of the id as text, modulo `folds`; null for a null id."""
    return F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(folds))


def in_known_language(docs: DataFrame, id_column: str = "doc_id", min_score: float = 0.5) -> DataFrame:
    """`docs` without the rows whose language is `und` or has a probability under `min_score`."""
    name = free_name(docs, "language")
    known = identify(docs, fold(id_column) != 1)
    return known.filter((F.col(name)["lang_pred"] != UNKNOWN) & (F.col(name)["score"] >= min_score)).select(*docs.columns)
