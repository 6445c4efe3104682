"""Recall of leaked items at the bound of edits, and the size of their index."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from floatlake.llm import decontaminate  # noqa: E402


def edited(rng, words, edits, mixed):
    words = list(words)
    for at in sorted(rng.sample(range(len(words)), edits), reverse=True):
        kind = rng.randrange(3) if mixed else 0
        new = f"z{rng.randrange(10**9)}"
        if kind == 0:
            words[at] = new
        elif kind == 1:
            del words[at]
        else:
            words.insert(at, new)
    return words


@pytest.mark.parametrize("mixed", [False, True])
@pytest.mark.parametrize("share", [0.1, decontaminate.MAX_EDITS])
def test_recall_at_the_bound(spark, share, mixed):
    """As many words edited as are allowed, for items of all lengths, anywhere in a text."""
    rng = random.Random(share)
    items, docs = [], []
    for length in (5, 10, 15, 20, 32, 46, 71, 140, 300):
        for _ in range(100):
            words = [f"w{rng.randrange(5000)}" for _ in range(length)]
            filler = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(60))]
            copy = edited(rng, words, int(share * length), mixed)
            docs.append((len(items), " ".join(filler + copy + filler[::-1])))
            items.append((len(items), " ".join(words)))
    found = decontaminate.leaked_items(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"), max_edits=share,
    )
    own = {r.doc_id for r in found.collect() if r.doc_id == r.item_id}
    for k, length in enumerate((5, 10, 15, 20, 32, 46, 71, 140, 300)):
        assert sum(100 * k <= i < 100 * (k + 1) for i in own) >= 100 * decontaminate.RECALL, length


def test_index_bytes_are_bounded(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(20_000)}" for _ in range(rng.randrange(5, 80)))) for i in range(3000)]
    items = spark.createDataFrame(rows, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 2 << 20)
    sizes, held = [], 0
    for index, alone in decontaminate.item_indexes(items):
        sizes.append(index.value.bytes())
        held += len(index.value.items)
        assert not alone
    assert held == len(rows) and len(sizes) > 5 and max(sizes) <= decontaminate.ITEM_BYTES


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    rng = random.Random(6)
    items = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(20))) for i in range(60)]
    docs = [(i, f"a b {items[i % 60][1]} c" if i % 3 else "clean text of no item") for i in range(90)] + [(90, None)]
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, decontaminate.leaked_items(a, b).collect()))
    clean = sorted(map(tuple, decontaminate.clean_documents(a, b).collect()), key=repr)
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 40_000)
    assert sorted(map(tuple, decontaminate.leaked_items(a, b).collect())) == whole and len(whole) == 60
    assert sorted(map(tuple, decontaminate.clean_documents(a, b).collect()), key=repr) == clean and len(clean) == 31
