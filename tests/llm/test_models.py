"""The language model and the forest against plain versions of them."""

from __future__ import annotations

import math
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import regex

sys.path.insert(0, str(Path(__file__).resolve().parent))

from floatlake.llm import language, quality, queries  # noqa: E402

SF = "/root/testdata/sf0.001"
WORD32 = 0xFFFFFFFF


def plain_grams(text):
    """Buckets of the 1- to 3-grams that start at each character of ` text `, written out."""
    padded = f" {text.lower()} "
    for at in range(len(padded)):
        for n in (1, 2, 3):
            # A text ends with a space; what stands behind it is one more.
            gram = (padded + " ")[at : at + n]
            if len(gram) < n:
                continue
            mixed = n * 0x27D4EB2F & WORD32
            for ch, factor in zip(gram, (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D), strict=False):
                mixed = (mixed ^ ord(ch)) * factor & WORD32
                mixed ^= mixed >> 15
            yield at, mixed & (language.BUCKETS - 1)


def starts_inside(text):
    return range(len(text.lower()) + 1)


def plain_bayes(rows, learn):
    """`(label, score)` for each (id, text, lang), learning from the rows where `learn` holds."""
    counts, documents = defaultdict(Counter), Counter()
    for row in rows:
        if learn(row) and row[1] is not None and row[2] is not None:
            documents[row[2]] += 1
            counts[row[2]].update(b for at, b in plain_grams(row[1]) if at in starts_inside(row[1]))
    labels = sorted(documents)
    total = {x: sum(counts[x].values()) + language.SMOOTHING * language.BUCKETS for x in labels}
    for _, text, _ in rows:
        if not text or not regex.search(r"\p{L}", text) or not labels:
            yield language.UNKNOWN, 0.0
            continue
        grams = Counter(b for at, b in plain_grams(text) if at in starts_inside(text))
        sums = [
            math.log(documents[x] / sum(documents.values())) + sum(n * math.log((counts[x][b] + language.SMOOTHING) / total[x]) for b, n in grams.items())
            for x in labels
        ]
        best = max(sums)
        yield labels[sums.index(best)], 1 / sum(math.exp(s - best) for s in sums)


def test_language_against_plain_bayes(spark):
    docs = queries.table(spark, SF, "documents").select("doc_id", "text", "lang").collect()
    rows = [(r.doc_id, r.text, r.lang) for r in docs] + [(10**6, None, "en"), (10**6 + 1, "1 2", "en"), (10**6 + 2, "le la", None), (10**6 + 3, "", "fr")]
    learn = lambda r: zlib.crc32(str(r[0]).encode()) % 3 != 1
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    found = {r.doc_id: r.language for r in language.identify(df, language.fold() != 1).collect()}
    for row, (label, score) in zip(rows, plain_bayes(rows, learn), strict=True):
        own = found[row[0]]
        assert abs(own.score - score) < 1e-3
        assert own.lang_pred == label or score < 0.501


def plain_path(forest, at, row):
    """Path length of a row, node by node."""
    while forest.feature[at] >= 0:
        at = forest.left[at] + (row[forest.feature[at]] >= forest.value[at])
    return forest.path[at]


def usual(n):
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def test_forest_against_plain_paths():
    rng = np.random.default_rng(2)
    rows = np.concatenate([rng.normal(0, 1, (600, 3)), rng.normal(6, 1, (6, 3)), np.ones((40, 3))])
    forest = quality.IsolationForest.grow(rows, trees=40, sample=128)
    expected = [2 ** (-sum(plain_path(forest, at, row) for at in forest.roots) / 40 / usual(128)) for row in rows]
    assert np.allclose(forest.score(rows), expected, atol=1e-12)
    # The order of the rows says nothing, and rows far from the others are the most anomalous.
    again = quality.IsolationForest.grow(rows[::-1], trees=40, sample=128)
    assert np.allclose(again.score(rows), expected)
    assert set(np.argsort(expected)[-6:].tolist()) == set(range(600, 606))


def test_trees_are_random_splits():
    """Each split lies inside the values of its node, and a leaf's path is its depth and what its rows would add."""
    rows = np.random.default_rng(5).integers(0, 6, (200, 3)).astype(float)
    forest = quality.IsolationForest.grow(rows, trees=5, sample=200)
    deepest = math.ceil(math.log2(200))

    def check(at, own, depth):
        able = [f for f in range(3) if len(own) and own[:, f].min() < own[:, f].max()]
        if depth >= deepest or not able:
            assert forest.feature[at] == -1 and math.isclose(forest.path[at], depth + usual(len(own)))
            return 1
        f, value = forest.feature[at], forest.value[at]
        assert f in able and own[:, f].min() <= value <= own[:, f].max()
        return check(forest.left[at], own[own[:, f] < value], depth + 1) + check(forest.left[at] + 1, own[own[:, f] >= value], depth + 1)

    for root in forest.roots:
        assert check(root, rows, 0) > 20


def test_threshold_against_all_thresholds(spark):
    """`kept` follows from the anomalies and the labels, by trying every threshold."""
    docs, labels = (queries.table(spark, "/root/testdata/sf0.01", x) for x in ("documents", "labels"))
    rows = quality.quality_verdicts(docs, labels).collect()
    good = {r.doc_id: r.quality > 0 for r in labels.collect() if r.quality is not None}
    bins = lambda r: math.floor(r.anomaly * quality.SCORE_BINS) / quality.SCORE_BINS
    judged = [(bins(r), good[r.doc_id]) for r in rows if r.doc_id in good and not r.base_failed]
    n_good, n_bad = sum(g for _, g in judged), sum(not g for _, g in judged)
    best = (0, math.inf)
    for k in range(quality.SCORE_BINS + 1):
        t = k / quality.SCORE_BINS
        lost = sum(g and b >= t for b, g in judged) / n_good
        gain = sum(not g and b >= t for b, g in judged) / n_bad - lost
        if lost <= 1 - quality.KEEP_GOOD and gain > 0:
            best = max(best, (round(gain, 12), t)) if best[1] < math.inf else (round(gain, 12), t)
    assert {r.doc_id for r in rows if r.kept} == {r.doc_id for r in rows if not r.base_failed and bins(r) < best[1]}


def test_many_repeated_rows_are_drawn_alike(spark, monkeypatch):
    """More chosen rows than are drawn: the same ones whatever the order of the table."""
    monkeypatch.setattr(quality, "TREES", 8)
    monkeypatch.setattr(quality, "SAMPLE", 16)
    rows = [(1, "the same words again and again in this one text " * 3)] * 2000 + [(i, f"text {i} " + "word " * (i % 40 + 12)) for i in range(2, 200)]
    labels = spark.createDataFrame([(1, 1), (5, 0)], "doc_id long, quality int")
    found = []
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string").repartition(4)
        found.append({(r.doc_id, r.anomaly) for r in quality.quality_verdicts(df, labels).collect()})
    assert found[0] == found[1]
