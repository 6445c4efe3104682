"""SimHash near-duplicates by a self-join of the binary trie of fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floatlake.llm.common import Workspace, blocks, free_name, real_id, record_batch, row_id

#: A pair with at most two differing bits agrees on one of three runs of bits. Each run in turn
#: is the top of the trie, so every search starts at a node paired with itself.
TURNS = (0, 22, 43)
TOP_BITS = 21
#: Node pairs with more fingerprints than this are split before a task works on them.
NODE_ROWS = 200_000
SPLIT_BITS = 8
#: Components come in about twice as many rounds as the logarithm of the longest chain; more is an error.
MOST_ROUNDS = 200

_FINGERPRINTS = pa.schema([("did", pa.int64()), ("fp", pa.int64())])
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint_bits(texts: list[str | None], shingle: int = 3) -> np.ndarray:
    """One 64-bit fingerprint a text: a bit is set if it is in over half the shingle hashes.

    A-Z are lower-cased; words are runs of other bytes than white space. Fewer words than a
    shingle: the whole sequence is the one shingle. No word: zero.
    """
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        words = text.encode().lower().split() if text else []
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) <= shingle:
            hashes.append(digest(joined, 42))
            counts[i] = 1
            continue
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = ends[: -shingle] - np.fromiter(map(len, words[:-shingle]), np.int64, len(words) - shingle) - 1
        starts = [*starts.tolist(), int(ends[-shingle - 1])]
        stops = (ends[shingle - 1 :] - 1).tolist()
        hashes += [digest(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)]
        counts[i] = len(starts)
    result = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        table = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        first = np.concatenate(([0], np.cumsum(counts[full])[:-1]))
        ones = np.add.reduceat(np.unpackbits(table, axis=1, bitorder="little"), first, axis=0, dtype=np.int32)
        bits = ones * 2 > counts[full, None]
        result[full] = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
    return result


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for a, b in blocks(texts):
            yield record_batch(
                _FINGERPRINTS, did=batch.column("did")[a:b], fp=fingerprint_bits(texts[a:b]).view(np.int64)
            )


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`did`, `fp` of every row. Null text: no word."""
    return docs.select(row_id(id_column).alias("did"), F.col(text_column).cast("string").alias("text")).mapInArrow(
        _fingerprint, "did long, fp long"
    )


def _turned(column: str, left: int) -> Column:
    """The 64 bits turned left, so that bit 63 - left comes first."""
    value = F.col(column)
    return F.shiftleft(value, left).bitwiseOR(F.shiftrightunsigned(value, 64 - left)) if left else value


def node_pairs(nodes: DataFrame, max_bits: int, workspace: Workspace) -> DataFrame:
    """Rows `turn, depth, a, b, v`: fingerprint `v` (turned) in the pair of trie nodes (a, b) at `depth`.

    Node pairs that hold too many rows go down SPLIT_BITS levels together: a fingerprint goes
    with each partner prefix that keeps the differing bits within `max_bits`.
    """
    turns = F.explode(F.array(*[
        F.struct(F.lit(i).alias("turn"), _turned("fp", left).alias("v")) for i, left in enumerate(TURNS)
    ]))
    at = nodes.select(turns.alias("x")).select("x.*")
    prefix = F.shiftrightunsigned("v", 64 - TOP_BITS)
    pairs = at.select("turn", F.lit(TOP_BITS).alias("depth"), prefix.alias("a"), prefix.alias("b"), "v")
    masks = sorted((m for m in range(1 << SPLIT_BITS) if bin(m).count("1") <= max_bits))
    key = ["turn", "depth", "a", "b"]
    done: DataFrame | None = None
    for step in range((64 - TOP_BITS) // SPLIT_BITS):
        counts = pairs.groupBy(key).agg(F.count("*").alias("n"))
        counts = workspace.save(counts.filter("n > 1"), f"nodes{step}")
        # Bounded: a hot pair holds over NODE_ROWS rows, so there are at most rows / NODE_ROWS.
        hot = counts.filter(F.col("n") > NODE_ROWS).select(*key, F.lit(True).alias("hot"))
        live = pairs.join(counts.select(key), key, "left_semi")
        if not hot.take(1):
            return live if done is None else done.unionByName(live)
        live = workspace.save(live.join(hot, key, "left"), f"pairs{step}")
        calm = live.filter("hot is null").select(*key, "v")
        done = calm if done is None else done.unionByName(calm)
        deeper = F.col("depth") + SPLIT_BITS
        own = F.call_function("shiftrightunsigned", F.col("v"), F.lit(64 - SPLIT_BITS) - F.col("depth"))
        other = F.when(F.shiftrightunsigned(own, SPLIT_BITS) == F.col("a"), F.col("b")).otherwise(F.col("a"))
        low = own.bitwiseAND(F.lit((1 << SPLIT_BITS) - 1))
        partner = F.shiftleft(other, SPLIT_BITS).bitwiseOR(low.bitwiseXOR(F.col("m").cast("long")))
        pairs = (
            live.filter("hot").withColumn("m", F.explode(F.array(*map(F.lit, masks))))
            .withColumn("x", own).withColumn("y", partner)
            .filter(F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= max_bits)
            .select("turn", deeper.cast("int").alias("depth"), F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "v")
        )
    live = pairs
    return live if done is None else done.unionByName(live)


def trie_links(values: np.ndarray, groups: np.ndarray, max_bits: int, depths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i < j) of equal group whose values differ in 1 to `max_bits` bits.

    `values` are sorted inside each group, and `depths` is one number inside it: a group holds the
    values of one trie node at that depth, or of two, which start with the bits they differ in
    spent. Two nodes go down the trie together: each level
    splits both by their next bit, adds one where the branches differ, and leaves pairs over budget.
    Pairs of few values are compared directly.
    """
    edge = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1], [True])))
    left, right = edge[:-1], edge[1:]
    start = depths[left]
    # Shifted twice, since numpy shifts by less than 64 bits only.
    prefix = (values >> np.uint64(1)) >> (63 - depths).astype(np.uint64)
    border = np.flatnonzero((groups[1:] == groups[:-1]) & (prefix[1:] != prefix[:-1])) + 1
    middle = right.copy()
    middle[np.searchsorted(left, border, "right") - 1] = border
    two = middle < right
    first = [left, np.where(two, middle, right), np.where(two, middle, left), right, np.bitwise_count(prefix[left] ^ prefix[right - 1]).astype(np.int64)]
    lo1, hi1, lo2, hi2, spent = (x[:0] for x in first)
    found_a, found_b = [], []
    for level in range(int(start.min()) if len(start) else 65, 65):
        new = (start == level) & (first[4] <= max_bits)
        if new.any():
            lo1, hi1, lo2, hi2, spent = (np.concatenate((x, y[new])) for x, y in zip((lo1, hi1, lo2, hi2, spent), first, strict=True))
        few = ((hi1 - lo1) * (hi2 - lo2) <= 16) | (level == 64)
        if few.any():
            n2 = (hi2 - lo2)[few]
            size = (hi1 - lo1)[few] * n2
            which = np.repeat(np.arange(len(size)), size)
            rank = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
            i, j = lo1[few][which] + rank // n2[which], lo2[few][which] + rank % n2[which]
            near = (i < j) & (np.bitwise_count(values[i] ^ values[j]) <= max_bits)
            found_a.append(i[near])
            found_b.append(j[near])
        lo1, hi1, lo2, hi2, spent = (x[~few] for x in (lo1, hi1, lo2, hi2, spent))
        if not len(lo1):
            continue
        bit = np.uint64(1) << np.uint64(63 - level)
        ones = np.concatenate(([0], np.cumsum((values & bit) != 0)))
        # Values of a node share all higher bits, so those without this bit come first.
        mid1 = hi1 - (ones[hi1] - ones[lo1])
        mid2 = hi2 - (ones[hi2] - ones[lo2])
        same = lo1 == lo2
        parts = [
            (lo1, mid1, lo2, mid2, spent, np.ones(len(lo1), bool)),
            (mid1, hi1, mid2, hi2, spent, np.ones(len(lo1), bool)),
            (lo1, mid1, mid2, hi2, spent + 1, np.ones(len(lo1), bool)),
            (mid1, hi1, lo2, mid2, spent + 1, ~same),
        ]
        kept = [(p[5] & (p[4] <= max_bits) & (p[1] > p[0]) & (p[3] > p[2])) for p in parts]
        lo1, hi1, lo2, hi2, spent = (
            np.concatenate([p[k][keep] for p, keep in zip(parts, kept, strict=True)]) for k in range(5)
        )
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def _forest(a: list[int], b: list[int]) -> list[int]:
    """Which of the links join two trees, taken in order."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    kept = []
    for k, (x, y) in enumerate(zip(a, b, strict=True)):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append(k)
    return kept


def _turn_back(values: np.ndarray, turns: np.ndarray) -> np.ndarray:
    left = np.array(TURNS, np.uint64)[turns]
    return (values >> left) | (values << (np.uint64(64) - left) % np.uint64(64))


def _join_nodes(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None

        def links(part: dict[str, np.ndarray]) -> pa.RecordBatch:
            new = np.ones(len(part["v"]), bool)
            for name in ("turn", "depth", "a", "b"):
                new[1:] &= part[name][1:] == part[name][:-1]
            new[0] = False
            group = np.cumsum(~new)
            values = part["v"].view(np.uint64)
            order = np.lexsort((values, group))
            values, group = values[order], group[order]
            i, j = trie_links(values, group, max_bits, part["depth"][order].astype(np.int64))
            turn = part["turn"][order]
            x, y = _turn_back(values[i], turn[i]), _turn_back(values[j], turn[j])
            kept = _forest(x.tolist(), y.tolist())
            return record_batch(_LINKS, a=x[kept].view(np.int64), b=y[kept].view(np.int64))

        for batch in batches:
            part = {name: batch.column(name).to_numpy() for name in ("turn", "depth", "a", "b", "v")}
            if held is not None:
                part = {k: np.concatenate((held[k], part[k])) for k in part}
            last = np.ones(len(part["v"]), bool)
            for name in ("turn", "depth", "a", "b"):
                last &= part[name] == part[name][-1]
            cut = len(last) if not last.any() else int(np.argmax(last))
            if cut:
                yield links({k: x[:cut] for k, x in part.items()})
            held = {k: x[cut:] for k, x in part.items()}
        if held is not None and len(held["v"]):
            yield links(held)

    return run


def near_links(fps: DataFrame, workspace: Workspace, max_bits: int = 2) -> DataFrame:
    """Links `a, b` between distinct fingerprints `fp` that differ in at most `max_bits` (0 to 2) bits.

    Per node pair, links inside what is already joined are left out: components stay the same.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the three turns of the trie hold for at most two differing bits")
    key = ["turn", "depth", "a", "b"]
    pairs = node_pairs(fps.select("fp"), max_bits, workspace)
    return pairs.repartition(*key).sortWithinPartitions(*key).mapInArrow(_join_nodes(max_bits), "a long, b long")


def components(links: DataFrame, workspace: Workspace) -> DataFrame:
    """`node`, `component` (the smallest node reachable) of every node with a link `a, b`.

    Each round points the larger neighbours of a node at the smallest one, then the smaller
    ones; every round is a written table, and rounds end when nothing changes.
    """
    state = workspace.save(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "star0"
    )
    seen = None
    for step in range(1, MOST_ROUNDS + 1):
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = workspace.save(large, f"large{step}")
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("x"))
        state = workspace.save(moved.select("x.u", F.col("x.m").alias("v")).filter("u <> v").distinct(), f"star{step}")
        now = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        workspace.drop(f"large{step}")
        workspace.drop(f"star{step - 1}")
        if now == seen:
            return state.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = now
    raise RuntimeError(f"components still changed after {MOST_ROUNDS} rounds")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", max_bits: int = 2
) -> DataFrame:
    """`doc_id, fingerprint, component_id` of every row.

    `component_id` is the smallest id reachable by links between fingerprints that differ in at
    most `max_bits` bits. Null and empty texts have fingerprint zero and are linked like others.
    Repeated rows come out as often as they went in; a null id sorts before all others and
    stays null. An empty table gives no row.
    """
    workspace = Workspace(docs.sparkSession, "simhash")
    prints = workspace.save(fingerprints(docs, id_column, text_column), "prints")
    classes = workspace.save(prints.groupBy("fp").agg(F.min("did").alias("rep")), "classes")
    links = workspace.save(near_links(classes, workspace, max_bits).distinct(), "links")
    by_rep = links.join(classes.select(F.col("fp").alias("a"), F.col("rep").alias("ra")), "a").join(
        classes.select(F.col("fp").alias("b"), F.col("rep").alias("rb")), "b"
    )
    joined = components(by_rep.select(F.col("ra").alias("a"), F.col("rb").alias("b")), workspace)
    named = workspace.save(
        classes.join(joined, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("component", "rep").alias("c")),
        "named",
    )
    return prints.join(named, "fp").select(
        real_id("did").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        real_id("c").alias("component_id"),
    )


def first_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", max_bits: int = 2) -> DataFrame:
    """The rows of `docs` whose id is the smallest of their component, with all their columns.

    Of rows that share that id, each stays.
    """
    found = near_duplicates(docs, id_column, text_column, max_bits)
    name = free_name(docs, "first_id")
    kept = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(row_id("doc_id").alias(name)).distinct()
    return docs.join(kept, row_id(id_column) == F.col(name), "left_semi")
