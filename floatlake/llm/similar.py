"""Near copies at a similarity of word shingles: wide SimHash fingerprints, trie self-joins of their parts, exact check.

Two texts of shingle similarity s differ in a share of about acos(2s / (1 + s)) / pi of their SimHash bits, far
more than a trie can search at once. So a fingerprint has as many parts as it takes for one of them to
differ in at most MAX_BITS bits with the wanted recall, and each part is joined with itself by a binary trie as in
simhash. What that finds is held against the whole fingerprint, and then against the shingles themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floatlake.llm.common import Workspace, blocks, free_name, record_batch, row_id
from floatlake.llm.simhash import _forest, components, trie_links
from floatlake.llm.wordtable import WordTable, mix, windows

#: Differing bits of a part that its trie searches, and the runs of the part one of which must agree for that.
MAX_BITS = 2
RUNS = MAX_BITS + 1
#: A text has about so many other texts by chance within MAX_BITS bits of a part.
BY_CHANCE = 0.05
#: Pairs whose whole fingerprints differ in so many standard deviations more bits than expected are dropped unchecked.
DEVIATIONS = 4
#: Characters that are printed together: a print takes many times the memory of its text's shingles.
PRINT_CHARS = 250_000
#: Contents a task remembers so as to print copies once.
REMEMBERED = 1_000_000

_KEYS = pa.schema([("did", pa.int64()), ("c", pa.int64())])
_PRINTS = pa.schema([("c", pa.int64()), ("bits", pa.list_(pa.int64())), ("parts", pa.list_(pa.int64()))])
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_SETS = pa.schema([("c", pa.int64()), ("shingles", pa.list_(pa.int64()))])


def differing_share(similarity: float) -> float:
    """Share of SimHash bits by which two sets of that similarity differ."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def plan_parts(texts: int, similarity: float, recall: float) -> tuple[int, int]:
    """`(bits of a part, parts)` for so many distinct texts."""
    near = lambda bits: sum(math.comb(bits, i) for i in range(MAX_BITS + 1))
    bits = 24
    while bits < 63 and texts * near(bits) > BY_CHANCE * 2**bits:
        bits += RUNS
    p = differing_share(similarity)
    found = sum(math.comb(bits, i) * p**i * (1 - p) ** (bits - i) for i in range(MAX_BITS + 1))
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log(1 - found)))


def _shingles(texts: list[str | None], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, text after text, and how many each text has. A-Z are lower-cased."""
    table = WordTable([(x or "").encode("utf-8", "surrogatepass").lower() for x in texts])
    words = table.hashes()
    whole = windows(words, length)
    fits = table.fits(length)[: len(whole)]
    counts = np.where(table.count >= length, table.count - length + 1, (table.count > 0).astype(np.int64))
    result = np.zeros(int(counts.sum()), np.uint64)
    ends = np.cumsum(counts)
    long = np.repeat(table.count >= length, counts)
    result[long] = whole[fits]
    for i in np.flatnonzero((table.count > 0) & (table.count < length)).tolist():
        # Fewer words than a shingle: the whole sequence is the one shingle.
        own = words[table.first[i] : table.first[i] + table.count[i]]
        result[ends[i] - 1] = windows(own, len(own), 7)[0]
    return result, counts


def _content_hashes(texts: list[str | None]) -> np.ndarray:
    """What texts of the same words have in common; 0 for no word."""
    table = WordTable([(x or "").encode("utf-8", "surrogatepass").lower() for x in texts])
    words, found = table.hashes(), np.zeros(len(texts), np.uint64)
    for i in np.flatnonzero(table.count).tolist():
        own = words[table.first[i] : table.first[i] + table.count[i]]
        found[i] = windows(own, len(own), 11)[0] | np.uint64(1)
    return found.view(np.int64)


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`did, c` of every row."""
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for a, b in blocks(texts):
            yield record_batch(_KEYS, did=batch.column("did")[a:b], c=_content_hashes(texts[a:b]))


def wide_prints(hashes: np.ndarray, counts: np.ndarray, words: int) -> np.ndarray:
    """`words` SimHash words of each text, from hashes of its shingles: a bit is set if it is in over half of them."""
    full = np.flatnonzero(counts)
    result = np.zeros((len(counts), words), np.uint64)
    if not len(full):
        return result
    first = np.concatenate(([0], np.cumsum(counts[full])[:-1]))
    for word in range(words):
        table = mix(hashes, 100 + word).view(np.uint8).reshape(-1, 8)
        ones = np.add.reduceat(np.unpackbits(table, axis=1, bitorder="little"), first, axis=0, dtype=np.int32)
        bits = ones * 2 > counts[full, None]
        result[full, word] = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
    return result


def _prints(length: int, bits: int, parts: int):
    """Whole fingerprints, and their parts turned so that each run of bits comes first once."""
    words, run = -(-bits * parts // 64), bits // RUNS

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in blocks(texts, PRINT_CHARS):
                # Copies of one task are printed once.
                contents = _content_hashes(texts[a:b]).tolist()
                if len(seen) > REMEMBERED:
                    seen.clear()
                own = {c: text for c, text in zip(contents, texts[a:b], strict=True) if c and c not in seen}
                seen.update(own)
                if not own:
                    continue
                n = len(own)
                found = wide_prints(*_shingles(list(own.values()), length), words)
                flat = np.unpackbits(found.view(np.uint8).reshape(n, -1), axis=1, bitorder="little")[:, : bits * parts]
                split = flat.reshape(n, parts, bits)
                turned = np.stack([np.roll(split, -run * r, axis=2) for r in range(RUNS)], axis=2)
                padded = np.zeros((n, parts, RUNS, 64), np.uint8)
                padded[..., :bits] = turned
                values = np.packbits(padded, axis=3, bitorder="big").view(">u8")[..., 0].astype(np.uint64)
                yield record_batch(_PRINTS, c=list(own), bits=list(found.view(np.int64)), parts=list(values.view(np.int64).reshape(n, -1)))

    return emit


def _join_nodes(run: int):
    """Links within trie nodes: rows sorted by part and value, a node being what starts with the same run of bits."""

    def links(part: np.ndarray, v: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        values = v.view(np.uint64)
        node = values >> np.uint64(64 - run)
        new = np.ones(len(v), bool)
        new[1:] = (part[1:] != part[:-1]) | (node[1:] != node[:-1])
        group = np.cumsum(new)
        order = np.lexsort((values, group))
        i, j = trie_links(values[order], group[order], MAX_BITS, np.full(len(v), run, np.int64))
        a, b = c[order][i], c[order][j]
        kept = _forest(a.tolist(), b.tolist())
        return record_batch(_LINKS, a=a[kept], b=b[kept])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            own = [batch.column(x).to_numpy() for x in ("part", "v", "c")]
            if held is not None:
                own = [np.concatenate(x) for x in zip(held, own, strict=True)]
            node = own[1].view(np.uint64) >> np.uint64(64 - run)
            last = (own[0] == own[0][-1]) & (node == node[-1])
            cut = len(last) - int(last[::-1].argmin()) if not last.all() else 0
            if cut:
                yield links(*(x[:cut] for x in own))
            held = [x[cut:] for x in own]
        if held is not None and len(held[0]):
            yield links(*held)

    return emit


def _sets(length: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in blocks(texts, PRINT_CHARS):
                hashes, counts = _shingles(texts[a:b], length)
                own = np.split(hashes.view(np.int64), np.cumsum(counts)[:-1])
                yield record_batch(_SETS, c=_content_hashes(texts[a:b]), shingles=[np.unique(x) for x in own])

    return emit


def _similar(similarity: float):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for k, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                if min(len(x), len(y)) >= similarity * max(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if both >= similarity * (len(x) + len(y) - both):
                        kept.append(k)
            yield pa.RecordBatch.from_arrays([batch.column(n).take(pa.array(kept, pa.int64())) for n in ("a", "b")], ["a", "b"])

    return emit


def similar_groups(
    docs: DataFrame, workspace: Workspace, shingle: int = 5, similarity: float = 0.8, recall: float = 0.9,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """`did, c, group`: the text (by a hash of its words) and the group of every row.

    Texts whose sets of word shingles have the similarity are linked, and groups are what links reach. A pair
    at exactly that similarity is searched with probability `recall`, one of more with a higher one; what is
    linked is exact. A group is named by its smallest text hash. Texts of the same words are one text; those
    without a word are one.

    Copies are settled before anything is compared, and texts with equal parts meet one of them only, so a large
    group of near copies gives stars of links and not all its pairs.
    """
    rows = docs.select(row_id(id_column).alias("did"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    keyed = workspace.save(rows.mapInArrow(_contents, "did long, c long"), "contents")
    holders = workspace.save(keyed.filter("c <> 0").groupBy("c").agg(F.min("did").alias("did")), "holders")
    bits, parts = plan_parts(max(1, holders.count()), similarity, recall)
    printed = rows.mapInArrow(_prints(shingle, bits, parts), "c long, bits array<long>, parts array<long>").dropDuplicates(["c"])
    printed = workspace.save(printed, "prints")
    each = printed.select("c", F.posexplode("parts").alias("part", "v"))
    distinct = workspace.save(each.groupBy("part", "v").agg(F.min("c").alias("c"), F.count("*").alias("n")), "values")
    shared = distinct.filter(f"n > 1 AND part % {RUNS} = 0").select("part", "v", F.col("c").alias("first"))
    stars = each.filter(f"part % {RUNS} = 0").join(shared, ["part", "v"]).filter("c <> first").select(F.col("first").alias("a"), F.col("c").alias("b"))
    run = bits // RUNS
    nodes = distinct.select("part", "v", "c", F.shiftrightunsigned("v", 64 - run).alias("node"))
    near = nodes.repartition("part", "node").sortWithinPartitions("part", "node").select("part", "v", "c").mapInArrow(_join_nodes(run), "a long, b long")
    links = workspace.save(stars.unionByName(near).distinct(), "candidates")

    total, p = bits * parts, differing_share(similarity)
    most = math.ceil(total * p + DEVIATIONS * math.sqrt(total * p * (1 - p)))
    prints = printed.select("c", "bits")
    differing = F.aggregate(F.zip_with("x", "y", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    both = links.join(prints.withColumnsRenamed({"c": "a", "bits": "x"}), "a").join(prints.withColumnsRenamed({"c": "b", "bits": "y"}), "b")
    likely = workspace.save(both.filter(differing <= most).select("a", "b"), "likely")

    wanted = likely.select(F.explode(F.array("a", "b")).alias("c")).distinct()
    needed = holders.join(wanted, "c", "left_semi").select("did").distinct()
    sets = rows.join(needed, "did", "left_semi").mapInArrow(_sets(shingle), "c long, shingles array<long>").dropDuplicates(["c"])
    sets = workspace.save(sets, "sets")
    compared = likely.join(sets.withColumnsRenamed({"c": "a", "shingles": "x"}), "a").join(sets.withColumnsRenamed({"c": "b", "shingles": "y"}), "b")
    verified = workspace.save(compared.mapInArrow(_similar(similarity), "a long, b long"), "links")
    groups = components(verified, workspace)
    return keyed.join(groups, F.col("c") == F.col("node"), "left").select("did", "c", F.coalesce("component", "c").alias("group"))


def first_of_similar(
    docs: DataFrame, shingle: int = 5, similarity: float = 0.8, recall: float = 0.9, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row of each group of similar texts, with all columns: the smallest id, and of equal ids the smallest text hash.

    Rows without a word are a group. Rows of one id and the same words all stay if they are chosen. Null ids come
    before all others. An empty table gives no row.
    """
    workspace = Workspace(docs.sparkSession, "similar")
    found = workspace.save(similar_groups(docs, workspace, shingle, similarity, recall, id_column, text_column), "groups")
    first = found.groupBy("group").agg(F.min(F.struct("did", "c")).alias("x")).select("x.did", "x.c")
    did, c, text = (free_name(docs, x) for x in ("did", "c", "words"))
    kept = first.select(F.col("did").alias(did), F.col("c").alias(c)).distinct()
    # Most rows are settled by their id; the text decides where one id has several.
    marked = docs.withColumn(did, row_id(id_column)).join(kept.groupBy(did).agg(F.collect_set(c).alias(c)), did)
    several = found.groupBy("did").agg(F.count_distinct("c").alias("n")).filter("n > 1").select(F.col("did").alias(did))
    if not several.take(1):
        return marked.select(*docs.columns)
    flag = free_name(marked, "several")
    marked = marked.join(several.withColumn(flag, F.lit(True)), did, "left").withColumn(text, F.coalesce(F.col(text_column).cast("string"), F.lit("")))
    own = _content_of()(F.col(text))
    return marked.filter(F.col(flag).isNull() | F.array_contains(c, own)).select(*docs.columns)


def _content_of():
    @F.pandas_udf("long")
    def content(texts):
        import pandas as pd

        return pd.Series(_content_hashes(texts.tolist()))

    return content
