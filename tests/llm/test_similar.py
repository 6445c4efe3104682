"""Near copies at a similarity: recall against all pairs, exactness of links, edge cases."""

from __future__ import annotations

import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from brute import LOWER, WORD  # noqa: E402
from floatlake.llm import common, queries, similar  # noqa: E402
from test_operators import EDGES  # noqa: E402


def shingles(text, n=5):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
    return words


def corpus(n=150, seed=1):
    """Texts with near copies at similarities from under 0.6 to 1."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(60, 400))]
        rows.append(" ".join(words))
        for _ in range(rng.randrange(4)):
            rows.append(" ".join(edited(rng, words, rng.randrange(1, max(2, len(words) // 14)))))
    return list(enumerate(rows))


def groups_of(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return {r.did: r.group for r in similar.similar_groups(df, common.Workspace(spark, "test")).collect()}


def test_recall_and_exactness(spark):
    rows = corpus()
    found = groups_of(spark, rows)
    sets = {i: shingles(t) for i, t in rows}
    pairs = [(i, j) for i in sets for j in range(i + 1, min(i + 5, len(rows))) if jaccard(sets[i], sets[j]) >= 0.8]
    assert len(pairs) > 40
    together = sum(found[i] == found[j] for i, j in pairs)
    assert together >= 0.9 * len(pairs)
    # Whatever is in one group is linked by exact similarities.
    for group in set(found.values()):
        members = [i for i in found if found[i] == group]
        reached, todo = {members[0]}, [members[0]]
        while todo:
            i = todo.pop()
            new = {j for j in members if j not in reached and jaccard(sets[i], sets[j]) >= 0.8}
            reached |= new
            todo += new
        assert reached == set(members)


def test_recall_on_documents(spark):
    """On the given table, against candidates by shared shingles."""
    rows = [(r.doc_id, r.text) for r in queries.table(spark, "/root/testdata/sf0.01", "documents").collect()]
    sets = {i: shingles(t) for i, t in rows}
    holders = {}
    for i, own in sets.items():
        for s in own:
            holders.setdefault(s, []).append(i)
    pairs = {(a, b) for own in holders.values() for k, a in enumerate(own) for b in own[k + 1 :]}
    near = [(a, b) for a, b in pairs if jaccard(sets[a], sets[b]) >= 0.8]
    found = groups_of(spark, rows)
    assert near and sum(found[a] == found[b] for a, b in near) >= 0.95 * len(near)


def test_one_of_each_group_stays(spark):
    base = [f"w{i}" for i in range(200)]
    rng = random.Random(3)
    rows = [(9, " ".join(base)), (4, " ".join(edited(rng, base, 2))), (7, " ".join(base).upper()), (4, "another text under the same id as one before it"), (30, "x y"), (31, "X  y"), (32, "x y z")]
    rows += [(i, t) for i, t in EDGES if i is None or i > 10 or i < 5]
    df = spark.createDataFrame([(i, t, 5, "k") for i, t in rows], "doc_id long, text string, c long, DID string").repartition(3)
    kept = similar.first_of_similar(df)
    assert kept.columns == df.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    ids = [i for i, _ in found]
    assert (4, rows[1][1]) in found and (4, rows[3][1]) in found and 9 not in ids and 7 not in ids
    assert 30 in ids and 31 not in ids and 32 in ids
    assert sum(not (t or "").split() for _, t in found) == 1
    assert similar.first_of_similar(df.limit(0)).count() == 0


def test_parts_grow_slowly():
    for texts, most in ((1000, 10), (10**6, 30), (10**9, 100)):
        bits, parts = similar.plan_parts(texts, 0.8, 0.9)
        assert bits % similar.RUNS == 0 and bits <= 63 and parts <= most
