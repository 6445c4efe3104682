"""Manifest, clusters and personal data against plain Python, and their edge cases."""

from __future__ import annotations

import random
import sys
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402
import brute_rows  # noqa: E402
from floatlake.llm import clusters, merkle, private, queries  # noqa: E402
from test_operators import EDGES, SF, same  # noqa: E402


def third():
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, merkle.lowered_text(F.col("text")))


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def manifest_of(spark, rows, schema=SCHEMA):
    return [tuple(r) for r in merkle.manifest(spark.createDataFrame(rows, schema).repartition(3), third()).collect()]


@pytest.mark.parametrize("n", [1, 2, 8, 9, 65, 600])
def test_manifest(spark, n):
    rng = random.Random(n)
    rows = [(i, rng.choice(["a", None]), rng.choice(["en", "fr", None, "Ünd", ""]), rng.choice([None, i]), f"Text {i % 7} É") for i in range(n)]
    same(manifest_of(spark, rows), list(brute_rows.manifest(rows)))


def test_manifest_of_many_blocks(spark, monkeypatch):
    """Several rounds of sweeps up and down, one group with most rows and many groups of one."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    rows = [(i, "s", "en" if i % 9 else f"x{i}", 1, f"T{i}") for i in range(700)]
    found = manifest_of(spark, rows)
    same(found, list(brute_rows.manifest(rows)))
    assert len({r[2] for r in found}) == 79 and 0 < sum(r[6] for r in found) < len(found)


def test_manifest_of_edges(spark):
    rows = [(i, "s", lang, None, t) for i, t in EDGES for lang in ("en", None)] + [(7, None, "en", 3, "same")] * 20
    extra = [(*r, 1, "z") for r in rows]
    found = manifest_of(spark, extra, SCHEMA + ", g long, TREE string")
    same(found, list(brute_rows.manifest(rows)))
    assert manifest_of(spark, []) == []


def test_manifest_shows_a_change_of_one_row(spark):
    rows = [(i, "s", "en", i, f"t{i}") for i in range(100)]
    changed = [*rows[:50], (50, "s", "en", 50, "other"), *rows[51:]]
    before, after = manifest_of(spark, rows), manifest_of(spark, changed)
    assert {r[3] for r in before} != {r[3] for r in after}
    assert sum(a[1] != b[1] for a, b in zip(sorted(before), sorted(after), strict=True)) == 1


def clusters_of(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster int, label string").repartition(3)
    found = clusters.centroid_clusters(df, **options).collect()
    for r in found:
        assert r["centroid_sha256"] == brute.sha(",".join(map(str, r["centroid"])))
    return [(r["vec_id"], r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], list(r["centroid"])) for r in found]


def test_clusters(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 1, 64)]) for i in range(200)]
    # Ties and repeats: few different values, equal vectors, equal ids, null ids.
    rows += [(200 + i, [float(x) for x in rng.integers(0, 2, 64)]) for i in range(60)]
    rows += [(300, [0.5] * 64)] * 5 + [(None, [0.25] * 64)] * 2
    bad = [(400, None), (401, []), (402, [1.0] * 63), (403, [1.0] * 65), (404, [None] + [1.0] * 63), (405, [float("nan")] + [1.0] * 63), (406, [float("-inf")] + [1.0] * 63)]
    found = clusters_of(spark, [(*r, 1, "x") for r in rows + bad])
    same(found, list(brute_rows.clusters(rows + bad)))


def test_few_and_huge_vectors(spark):
    rows = [(i, [float(i % 3)] * 64, None, None) for i in range(10)]
    same(clusters_of(spark, rows), list(brute_rows.clusters([r[:2] for r in rows])))
    assert clusters_of(spark, []) == []
    found = clusters_of(spark, [(1, [3e38] * 64, 0, ""), (2, [-3e38] * 64, 0, "")], k=1, rounds=0)
    assert sorted(x[2] for x in found) == [0, 64 * (2 * clusters.LARGEST) ** 2]


@pytest.mark.parametrize("high", [2, 1000])
def test_threshold_algorithm_is_exact(high):
    """Nearest centroids and ties as a full comparison has them."""
    rng = np.random.default_rng(high)
    points = rng.integers(0, high, (30, 5))
    points[7] = points[21]
    vectors = np.concatenate([rng.integers(-3, high + 3, (5000, 5)), points])
    number, distance = clusters.Centroids(points).nearest(vectors)
    full = ((vectors[:, None, :] - points[None]) ** 2).sum(2)
    assert (number == full.argmin(1)).all() and (distance == full.min(1)).all()


def test_threshold_algorithm_stops_early(monkeypatch):
    """With centroids far apart, few of them are measured."""
    measured = []
    whole = np.einsum
    monkeypatch.setattr(np, "einsum", lambda spec, a, b: measured.append(len(a)) or whole(spec, a, b))
    points = np.arange(40)[:, None] * np.full((1, 64), 1000)
    clusters.Centroids(points).nearest(points + 3)
    assert sum(measured) <= 2 * len(points)


PRIVATE = [
    "mail a.b@c.de.f, b@c x@y.z_q@r.s and 1.2.3.4.5.6.7.8 or 300.1.1.1 and 0001.2.3.255",
    "card 4111 1111 1111 1111 and 4111111111111112, 5500-0000-0000-0004 5 55 3782 822463 10005 +1 (017) 555-7713.",
    "+1 (((((, +12, +1234567890, +1 234 567 890 12 345 678, ++49 30 1234567-", "é1@x.y \U0001F600 9.9.9.9 \U0001F600 +4930123456 z",
    "a@b.c@d.e.f@g", "@a.b", "a@b.", "....@....", "1-1-1-1 2  2", "", None, "words only",
]


def spans_of(spark, rows, **options):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, k long, START string").repartition(3)
    found = private.personal_data(df, **options).collect()
    for r in found:
        assert [r[f"n_{name}"] for name in private.KINDS] == [sum(x.k == k for x in r.base) for k in range(4)]
    return [(r.doc_id, [tuple(x) for x in r.base], [tuple(x) for x in r.spans]) for r in found]


def planted(n=40):
    """Numbers behind the words of phones and mails behind those of mails, half of them in no base form."""
    rng = random.Random(n)
    for i in range(n):
        number = f"{rng.randint(200, 999)} {rng.randint(200, 999)} {rng.randint(1000, 9999)}"
        form = f"+1 {number}" if i % 2 else number
        yield f"some words {i} here. Please phone: {form} today"
        yield f"in the {rng.randint(1900, 2000)} issue, the {rng.randint(1000000, 9999999)} th"
        yield f"write to mailbox user{i}@{'host.org' if i % 3 else 'localhost'} soon"


def test_private_data(spark):
    rows = [*enumerate([*PRIVATE, *planted()]), *EDGES, (3, PRIVATE[3]), (900, PRIVATE[0]), (None, PRIVATE[1])]
    found = spans_of(spark, rows)
    same(found, list(brute_rows.personal_data(rows)))
    assert spans_of(spark, []) == []


def test_contexts_find_unseen_identifiers(spark):
    texts = list(planted())
    found = spans_of(spark, list(enumerate(texts)))
    for i, base, spans in found:
        assert set(base) <= set(spans)
        text = texts[i]
        if "phone" in text:
            (start, kind, stop), = spans
            assert kind == 3 and text[start:stop].endswith(text[-10:-6])
        elif "mailbox" in text:
            (start, kind, stop), = spans
            assert kind == 0 and text[start:stop].startswith("user") and "@" in text[start:stop]
        else:
            assert not spans


def test_copies_of_a_text_teach_nothing(spark):
    rows = [(i, "call me +1 200 300 4000 now") for i in range(30)] + [(99, "call me 200 300 5000 now")]
    assert [x for i, _, x in spans_of(spark, rows) if i == 99] == [[]]


@pytest.mark.parametrize("part", ["1", "1 ", "a@", "a", ".", "-", "1.", "+1", "+1(", "%", "a.b@c.d ", "1 2", "("])
def test_long_texts_take_linear_time(spark, part):
    """No stack, and no time that grows with the square of a run; plain Python takes shorter texts."""
    short, long = part * (2000 // len(part)), part * (300_000 // len(part))
    start = time.perf_counter()
    found = {i: base for i, base, _ in spans_of(spark, [(1, short), (2, long)])}
    assert time.perf_counter() - start < 60
    assert found[1] == brute_rows.base_spans(short)
    assert len(found[2]) >= len(found[1])


def test_native_plan(spark):
    plan = queries.op13_private_data(spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
