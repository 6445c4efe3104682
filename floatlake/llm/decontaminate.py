"""Benchmark decontamination: CGK embeddings, bit-sampling LSH, exact edit distance."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floatlake.llm.common import Workspace, blocks, free_name, record_batch

#: Embedding positions sampled for one key.
SAMPLED = 5
RECALL = 0.95
#: Independent walks that the repetitions are dealt to: an edit that throws one off may not throw off the next.
WALKS = 4
#: Sizes of windows: an item gets the largest of which it is WINDOWS times as long. So it holds several at any
#: stride, and edits of a share of its words leave one of them with fewer.
SIZES = (1, 2, 3, 4, 6, 8, 12, 16)
WINDOWS = 2.5
#: The best window of an item differs from its copy's in about so many times the share of edited words.
DRIFT = 1.5
#: Memory of an index that is broadcast at once; more items are searched in further passes.
ITEM_BYTES = 64 << 20
#: Bytes of a key in the index, with the number of its window.
KEY_BYTES = 12
#: Largest share of an item's words that may be edited.
MAX_EDITS = 0.2

_WORD = re.compile(r"[^\W_]+")
_PAD = 255
_FOUND = pa.schema([
    ("did", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int64()), ("item_words", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
])


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits, in lower case."""
    return _WORD.findall(text.lower()) if text else []


def window_length(words: int) -> int:
    """Size of the windows of an item: its share of the item stays the same, up to the largest of SIZES."""
    return max(x for x in SIZES if x == 1 or x * WINDOWS <= words)


def stride(length: int) -> int:
    return max(1, length // 2)


def repetitions(recall: float, max_edits: float = MAX_EDITS, sampled: int = SAMPLED) -> int:
    """Keys per window so that one of an item's best window agrees with probability `recall`."""
    same = (1 - min(0.9, DRIFT * max_edits)) ** sampled
    return math.ceil(math.log(1 - recall) / math.log(1 - same)) if same < 1 else 1


def edit_end(item: list[int], words: list[int]) -> tuple[int, int]:
    """Least edit distance of the item to any stretch of `words`, and where that stretch ends.

    Bit-parallel dynamic programming over one integer as long as the item; ties: the first end.
    """
    size = len(item)
    masks: dict[int, int] = {}
    for i, word in enumerate(item):
        masks[word] = masks.get(word, 0) | 1 << i
    full, high = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = full, 0, size
    best, end = size, 0
    for at, word in enumerate(words):
        equal = masks.get(word, 0)
        vertical = equal | minus
        cross = ((((equal & plus) + plus) ^ plus) | equal) & full
        up = (minus | ~(cross | plus)) & full
        down = plus & cross
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up = (up << 1) & full
        down = (down << 1) & full
        plus = (down | ~(vertical | up)) & full
        minus = up & vertical
        if score < best:
            best, end = score, at + 1
    return best, end


@dataclass
class _Keys:
    """Windows of one length, by item and offset in it; for each repetition their sorted keys and which window each is."""

    length: int
    picks: np.ndarray
    turns: np.ndarray
    items: np.ndarray
    offsets: np.ndarray
    keys: list[np.ndarray]
    rows: list[np.ndarray]
    seen: list[np.ndarray]


class ItemIndex:
    """CGK embeddings of windows of benchmark items, under keys of sampled positions.

    The embedding of a window is read by a walk: step j writes the current word, then goes on to
    the next word or stays, by a random bit of j and the word. Windows few edits apart take the
    same walk but for a few steps, so sampled positions of the embedding agree.
    """

    def __init__(self, items: list[tuple[int, str]], recall: float, max_edits: float) -> None:
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, list[int]]] = []
        for item_id, text in items:
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if codes:
                self.items.append((item_id, codes))
        self.distinct = [frozenset(codes) for _, codes in self.items]
        self.max_edits = max_edits
        #: Symbol of a word: 0 for words of no item.
        symbols = [0] + [xxhash.xxh64_intdigest(w.encode(), 7) & 0x7FFFFFFF for w in self.vocabulary]
        self.symbols = np.array(symbols, np.int64)
        self.classes: list[_Keys] = []
        by_length: dict[int, list[int]] = {}
        for i, (_, codes) in enumerate(self.items):
            by_length.setdefault(window_length(len(codes)), []).append(i)
        for length, members in sorted(by_length.items()):
            self.classes.append(self._class(length, members, repetitions(recall, max_edits)))

    def _class(self, length: int, members: list[int], repeats: int) -> _Keys:
        rng = np.random.default_rng(1000 + length)
        steps = 2 * length
        turns = rng.integers(0, 2, (WALKS, steps, 256), dtype=np.uint8)
        picks = np.sort(np.array([rng.choice(steps, min(SAMPLED, steps), replace=False) for _ in range(repeats)]), axis=1)
        codes, starts, items, offsets, base = [], [], [], [], 0
        for i in members:
            own = self.items[i][1]
            # A text is searched at every stride, and any window of an item can be the one its copy has there.
            n = len(own) - length + 1
            starts.append(np.arange(base, base + n))
            items.append(np.full(n, i, np.int32))
            offsets.append(np.arange(n, dtype=np.int32))
            codes += own
            base += len(own)
        entry = _Keys(length, picks, turns, np.concatenate(items), np.concatenate(offsets), [], [], [])
        for keys in self._window_keys(entry, self.symbols[np.array(codes)], np.concatenate(starts)):
            order = np.argsort(keys, kind="stable")
            seen = np.zeros(1 << 16, bool)
            seen[(keys & np.uint64(0xFFFF)).astype(np.int64)] = True
            entry.keys.append(keys[order])
            entry.rows.append(order.astype(np.int32))
            entry.seen.append(seen)
        return entry

    def bytes(self) -> int:
        """Memory of the keys."""
        return sum(x.nbytes for entry in self.classes for part in (entry.keys, entry.rows, [entry.items, entry.offsets]) for x in part)

    @staticmethod
    def _window_keys(entry: _Keys, symbols: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
        """For each repetition the key of every window."""
        padded = np.append(symbols, 0)
        end = starts + entry.length
        for walk in range(min(WALKS, len(entry.picks))):
            picked = entry.picks[walk::WALKS]
            wanted = set(picked.ravel().tolist())
            at = starts.copy()
            written: dict[int, np.ndarray] = {}
            for step in range(max(wanted) + 1):
                symbol = padded[at]
                inside = at < end
                if step in wanted:
                    written[step] = np.where(inside, symbol, _PAD).astype(np.uint64)
                at += entry.turns[walk, step][symbol & 255] & inside
            for number, picks in enumerate(picked):
                key = np.full(len(starts), 1 + walk + number * WALKS, np.uint64)
                for step in picks:
                    key = (key ^ written[step]) * np.uint64(0x9E3779B97F4A7C15)
                    key ^= key >> np.uint64(29)
                yield key

    def search(self, texts: list[list[str]]) -> list[tuple[int, int, int, int, int]]:
        """`(text, item, distance, first word, end word)` of every item found in a text."""
        get = self.vocabulary.get
        codes = [np.fromiter(map(get, words, repeat(0)), np.int64, len(words)) for words in texts]
        counts = np.array([len(x) for x in codes], np.int64)
        ends = np.cumsum(counts)
        firsts = ends - counts
        joined = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        symbols = self.symbols[joined]
        found = []
        for entry in self.classes:
            step = stride(entry.length)
            per_text = np.maximum(0, (counts - entry.length) // step + 1) * (counts >= entry.length)
            text_of = np.repeat(np.arange(len(texts)), per_text)
            rank = np.arange(len(text_of)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
            starts = firsts[text_of] + rank * step
            if not len(starts):
                continue
            # A window whose words are of no item embeds like no item.
            known = np.concatenate(([0], np.cumsum(joined > 0)))
            some = 2 * (known[starts + entry.length] - known[starts]) >= entry.length
            starts, text_of = starts[some], text_of[some]
            if not len(starts):
                continue
            tries: set[tuple[int, int, int]] = set()
            for r, keys in enumerate(self._window_keys(entry, symbols, starts)):
                maybe = np.flatnonzero(entry.seen[r][(keys & np.uint64(0xFFFF)).astype(np.int64)])
                lo = np.searchsorted(entry.keys[r], keys[maybe], "left")
                hi = np.searchsorted(entry.keys[r], keys[maybe], "right")
                for k in np.flatnonzero(hi > lo).tolist():
                    w = maybe[k]
                    for e in entry.rows[r][lo[k] : hi[k]].tolist():
                        tries.add((int(text_of[w]), int(entry.items[e]), int(starts[w] - entry.offsets[e])))
            found += self._verify(sorted(tries), joined, firsts, ends)
        return found

    def _verify(self, tries, joined, firsts, ends) -> Iterator[tuple[int, int, int, int, int]]:
        """Exact check of places, near ones of an item together."""
        last = checked = None
        for text, item, start in tries:
            own = self.items[item][1]
            allowed = int(self.max_edits * len(own))
            # One check covers the starts of a stretch as long as the edits can shift a place.
            place = text, item, start // (allowed + 1)
            if (text, item) == last or place == checked:
                continue
            checked = place
            first = place[2] * (allowed + 1)
            a = max(first - allowed, int(firsts[text]))
            b = min(first + 2 * allowed + len(own), int(ends[text]))
            part = joined[a:b].tolist()
            # An edit takes at most one of the item's distinct words away.
            distinct = self.distinct[item]
            if len(distinct.intersection(part)) < len(distinct) - allowed:
                continue
            distance, end = edit_end(own, part)
            if distance <= allowed:
                back, length = edit_end(own[::-1], part[:end][::-1])
                last = text, item
                yield text, item, distance, a + end - length - int(firsts[text]), a + end - int(firsts[text])


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: ItemIndex = shared.value
        for batch in batches:
            texts, did = batch.column("text").to_pylist(), batch.column("did")
            for a, b in blocks(texts):
                rows = index.search([words_of(x) for x in texts[a:b]])
                if rows:
                    columns = list(zip(*rows, strict=True))
                    yield record_batch(
                        _FOUND, did=did.take(pa.array([a + i for i in columns[0]])), item_id=[index.items[i][0] for i in columns[1]],
                        distance=columns[2], item_words=[len(index.items[i][1]) for i in columns[1]],
                        first_word=columns[3], last_word=[x - 1 for x in columns[4]],
                    )

    return run


def item_indexes(
    items: DataFrame, item_id: str = "item_id", item_text: str = "text", max_edits: float = MAX_EDITS, recall: float = RECALL
) -> Iterator[tuple[Broadcast, bool]]:
    """Broadcast indexes of the items, each of at most about ITEM_BYTES, and whether it is the only one; at least one.

    Of several only one is alive: an index goes when the next is asked for.
    """
    spark = items.sparkSession
    chosen = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).cast("string").alias("x")).filter("x is not null")
    words, n = chosen.agg(F.sum(F.regexp_count("x", F.lit(r"[\p{L}\p{N}]+"))), F.count("*")).first()
    passes = math.ceil(1.25 * (words or 0) * (repetitions(recall, max_edits) * KEY_BYTES + 8) / ITEM_BYTES)
    # An item is indexed as a whole, so more passes than items help nothing.
    passes = max(1, min(passes, n))
    for number in range(passes):
        own = chosen.filter(F.pmod(F.xxhash64("i", "x"), F.lit(passes)) == number).collect()
        rows = sorted(((row.i, row.x) for row in own), key=lambda x: (x[0] is not None, x))
        index = spark.sparkContext.broadcast(ItemIndex(rows, recall, max_edits))
        yield index, passes == 1
        if passes > 1:
            index.destroy()


def leaked_items(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_id: str = "item_id", item_text: str = "text", max_edits: float = MAX_EDITS, recall: float = RECALL,
) -> DataFrame:
    """`doc_id, item_id, distance, item_words, first_word, last_word` for each item in a document.

    Words are runs of letters and digits, lower-cased. An item is in a document if some stretch
    of the document's words is at most `max_edits` of the item's words away by edit distance;
    one place per row and item is returned. Null and empty texts and items match nothing;
    repeated rows and items count each; a null id stays null; empty tables give no row.

    The items are the query set. They are indexed in blocks of at most ITEM_BYTES, each
    block broadcast and held against all documents, so neither side is shuffled. With several
    blocks the finds of each are written before the next is made.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("did"), F.col(text_column).cast("string").alias("text"))
    found: DataFrame | None = None
    workspace = None
    for index, alone in item_indexes(items, item_id, item_text, max_edits, recall):
        part = texts.mapInArrow(_search(index), "did long, item_id long, distance long, item_words long, first_word long, last_word long")
        if not alone:
            workspace = workspace or Workspace(docs.sparkSession, "leaks")
            part = workspace.save(part, f"block{index._jbroadcast.id()}")
        found = part if found is None else found.unionByName(part)
    return found.withColumnRenamed("did", "doc_id")


def clean_documents(
    docs: DataFrame, items: DataFrame, text_column: str = "text", max_edits: float = MAX_EDITS, recall: float = RECALL
) -> DataFrame:
    """The rows of `docs` with no item in their text, with all their columns; a null text stays.

    With several blocks of items, the hashes of the texts that a block finds are written, and rows
    of those texts go.
    """
    column = F.col(text_column).cast("string")
    workspace, leaking = None, None
    keys = {free_name(docs, "leak1"): F.xxhash64(column), free_name(docs, "leak2"): F.xxhash64(F.lit(1), column)}
    for index, alone in item_indexes(items, max_edits=max_edits, recall=recall):
        if alone:
            name = free_name(docs, "leak")
            return docs.withColumn(name, _leaks(index)(column)).filter(~F.col(name)).select(*docs.columns)
        workspace = workspace or Workspace(docs.sparkSession, "leaks")
        part = docs.filter(_leaks(index)(column)).select(*(x.alias(name) for name, x in keys.items())).distinct()
        part = workspace.save(part, f"block{index._jbroadcast.id()}")
        leaking = part if leaking is None else leaking.unionByName(part)
    return docs.withColumns(keys).join(leaking, list(keys), "left_anti").select(*docs.columns)


def _leaks(shared: Broadcast):
    @F.pandas_udf("boolean")
    def leaks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts, found = batch.tolist(), np.zeros(len(batch), bool)
            for a, b in blocks(texts):
                rows = shared.value.search([words_of(x) for x in texts[a:b]])
                found[[a + row[0] for row in rows]] = True
            yield pd.Series(found)

    return leaks
