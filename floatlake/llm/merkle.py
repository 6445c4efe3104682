"""Merkle manifest of a dataset: digests of all rows, one root, and a proof for every row."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floatlake.llm.common import Workspace, numbered, record_batch

#: Children of a node.
FAN = 8
#: Levels that one sweep climbs; a block of FAN ** LEVELS nodes is whole in one task.
LEVELS = 4
#: Columns of a row that its leaf covers, in order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_DIGEST = 32

_NODE = "g long, n long, level int, i long, digest binary, children binary"
_SUFFIX = "g long, n long, level int, i long, suffix binary, subroot binary"
_PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def parent_digest(children: bytes) -> bytes:
    """Digest of a run of children: of their digests as hex text, one after the other."""
    return hashlib.sha256(children.hex().encode()).digest()


def at_level(n: int, level: int) -> int:
    """Nodes of a tree of `n` leaves at a level."""
    return -(-n // FAN**level)


def height(n: int) -> int:
    """Levels above the leaves."""
    level = 0
    while at_level(n, level) > 1:
        level += 1
    return level


def run_length(n: int, level: int, i: int) -> int:
    """Children of the parent of node `i` of a level."""
    return min(FAN, at_level(n, level) - i // FAN * FAN)


class LabelQueue:
    """Messages to nodes, taken by the receiver's label: last leaf below it, then level.

    In this order all nodes below a node come right before it, so a sweep over sorted rows holds
    messages to one path of receivers only. `down` turns the order round.
    """

    def __init__(self, down: bool = False) -> None:
        self.sign = -1 if down else 1
        self.heap: list[tuple[int, int, int, tuple]] = []
        self.sent = 0

    def label(self, level: int, i: int) -> tuple[int, int]:
        return self.sign * ((i + 1) * FAN**level - 1), self.sign * level

    def send(self, level: int, i: int, *message) -> None:
        self.sent += 1
        heapq.heappush(self.heap, (*self.label(level, i), self.sent, message))

    def next_label(self) -> tuple[int, int] | None:
        return self.heap[0][:2] if self.heap else None

    def take(self, label: tuple[int, int]) -> list[tuple]:
        """All messages to one node, in the order they were sent."""
        found = []
        while self.heap and self.heap[0][:2] == label:
            found.append(heapq.heappop(self.heap)[3])
        return found


def _rise(base: int):
    """Forward sweep of blocks of nodes of level `base`, sorted: the nodes above them."""
    schema = arrow_schema(_NODE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, rows, block = LabelQueue(), [], None
        g = n = top = 0

        def deliver(before: tuple[int, int] | None) -> None:
            while (label := queue.next_label()) and (before is None or label < before):
                level = label[1]
                i = (label[0] + 1) // FAN**level - 1
                children = b"".join(x for x, in queue.take(label))
                digest = parent_digest(children)
                rows.append((g, n, base + level, i, digest, children))
                if level < top:
                    queue.send(level + 1, i // FAN, digest)

        for batch in batches:
            for own_g, own_n, i, digest in zip(*(batch.column(x).to_pylist() for x in ("g", "n", "i", "digest")), strict=True):
                if block != (own_g, i // FAN**LEVELS):
                    deliver(None)
                    block, g, n = (own_g, i // FAN**LEVELS), own_g, own_n
                    top = min(LEVELS, height(at_level(n, base)))
                deliver(queue.label(0, i))
                queue.send(1, i // FAN, digest)
            if rows:
                yield record_batch(schema, **dict(zip(schema.names, zip(*rows, strict=True), strict=True)))
                rows = []
        deliver(None)
        if rows:
            yield record_batch(schema, **dict(zip(schema.names, zip(*rows, strict=True), strict=True)))

    return run


def _fall(base: int, trees: int, root: bytes | None):
    """Reversed sweep: suffixes of block roots go down to the nodes of level `base`.

    Rows come by falling label, a suffix before the node it is for. A parent sends each child
    the child's siblings and its own suffix. With `root`, the base nodes are rows of the
    dataset, whose proofs come out.
    """
    schema = arrow_schema(_SUFFIX if root is None else _PROOF)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = LabelQueue(down=True)
        for batch in batches:
            rows = []
            columns = {name: batch.column(name).to_pylist() for name in batch.schema.names}
            for at, (g, n, level, i, suffix) in enumerate(zip(*(columns[x] for x in ("g", "n", "level", "i", "suffix")), strict=True)):
                if suffix is not None:
                    queue.send(level - base, i, suffix, columns["subroot"][at])
                    continue
                (above, subroot), = queue.take(queue.label(level - base, i))
                children = columns["children"][at]
                if level > base:
                    for k in range(len(children) // _DIGEST):
                        siblings = children[: k * _DIGEST] + children[(k + 1) * _DIGEST :]
                        queue.send(level - base - 1, i * FAN + k, siblings + above, subroot)
                elif root is None:
                    rows.append((g, n, level, i, above, subroot))
                else:
                    leaf, tampered = columns["digest"][at], columns["tampered"][at]
                    folded = fold(tampered or leaf, above, [(n, i), (trees, g)])
                    proof = hashlib.sha256(above.hex().encode()).hexdigest()
                    rows.append((columns["doc_id"][at], leaf.hex(), subroot.hex(), root.hex(), proof, folded.hex(), folded == root))
            if rows:
                yield record_batch(schema, **dict(zip(schema.names, zip(*rows, strict=True), strict=True)))

    return run


def fold(digest: bytes, proof: bytes, places: list[tuple[int, int]]) -> bytes:
    """Root from a leaf and its siblings; `places` are `(leaves, index)` in each tree on the way up."""
    at = 0
    for n, i in places:
        for level in range(height(n)):
            index = i // FAN**level
            end = at + (run_length(n, level, index) - 1) * _DIGEST
            cut = at + index % FAN * _DIGEST
            digest = parent_digest(proof[at:cut] + digest + proof[cut:end])
            at = end
    return digest


def _block(base: int) -> Column:
    return F.floor(F.col("i") / F.pow(F.lit(FAN), (base + LEVELS - F.col("level")).cast("double"))).cast("long")


def _risen(nodes: DataFrame, largest: int, workspace: Workspace, name: str) -> list[tuple[int, DataFrame, DataFrame | None]]:
    """`(base level, nodes of it, nodes above them)` of each round, for `g, n, i, digest`; a round climbs LEVELS."""
    rounds, base = [], 0
    while True:
        several = nodes.filter(F.ceil(F.col("n") / F.lit(FAN**base)) > 1)
        if at_level(largest, base) <= 1:
            if not rounds:
                rounds.append((base, nodes, None))
            return rounds
        block = (F.shiftright("i", 3 * LEVELS)).alias("block")
        dealt = several.select("g", "n", "i", "digest", block).repartition("g", "block").sortWithinPartitions("g", "i")
        above = workspace.save(dealt.mapInArrow(_rise(base), _NODE), f"{name}{base}")
        rounds.append((base, nodes, above))
        base += LEVELS
        nodes = above.filter(F.col("level") == base).select("g", "n", "i", "digest")


def _tops(rounds: list[tuple[int, DataFrame, DataFrame | None]]) -> DataFrame:
    """`g, n, level, i, digest` of the last node of each tree."""
    leaves = rounds[0][1].filter("n = 1").select("g", "n", F.lit(0).alias("level"), "i", "digest")
    for base, _, above in rounds:
        if above is not None:
            leaves = leaves.unionByName(above.filter(
                # The only node of its level, and not the only one of the level below.
                (F.ceil(F.col("n") / F.pow(F.lit(float(FAN)), F.col("level"))) == 1)
                & (F.ceil(F.col("n") / F.pow(F.lit(float(FAN)), F.col("level") - 1)) > 1)
            ).select("g", "n", "level", "i", "digest"))
    return leaves


def _fallen(rounds, tops: DataFrame, workspace: Workspace, name: str, trees: int = 0, root: bytes | None = None) -> DataFrame:
    """Suffixes of all leaves (or, with `root`, their proofs), from the suffixes of the trees' last nodes."""
    found = None
    for base, nodes, above in reversed(rounds):
        extra = [x for x in ("doc_id", "tampered") if root is not None and base == 0]
        none = F.lit(None).cast("binary")
        leaves = nodes.select("g", "n", F.lit(base).alias("level"), "i", "digest", none.alias("children"), *extra)
        rows = leaves if base == 0 else leaves.filter(F.ceil(F.col("n") / F.lit(FAN**base)) > 1)
        if above is not None:
            rows = rows.unionByName(above, allowMissingColumns=True)
        own = tops.filter((F.col("level") > base) & (F.col("level") <= base + LEVELS) | ((F.col("level") == 0) & (F.lit(base) == 0)))
        messages = own if found is None else own.unionByName(found)
        stream = rows.unionByName(messages, allowMissingColumns=True)
        end = (F.col("i") + 1) * F.pow(F.lit(float(FAN)), F.col("level") - base).cast("long")
        block = F.shiftright(end - 1, 3 * LEVELS)
        stream = stream.withColumn("block", block).withColumn("end", end).repartition("g", "block").sortWithinPartitions(
            "g", F.desc("end"), F.desc("level"), F.col("suffix").isNull()
        ).drop("block", "end")
        last = base == 0
        fallen = stream.mapInArrow(_fall(base, trees, root if last else None), _PROOF if last and root is not None else _SUFFIX)
        if last:
            return fallen
        found = workspace.save(fallen, f"{name}{base}")
    raise AssertionError("there is always a round of leaves")


def leaf_digest(columns: list[Column]) -> Column:
    """Digest of values: `-` for a null, else the count of its bytes, a colon and the value."""
    texts = [x.cast("string") for x in columns]
    parts = [F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def manifest(docs: DataFrame, tampered_text: Column | None = None, columns: tuple[str, ...] = COLUMNS, group: str = "lang") -> DataFrame:
    """`doc_id, leaf, subroot, root, proof_sha256, folded_root, verified` of every row.

    The leaves of each `group` value ascend by the first column; every FAN consecutive nodes of
    a level become one of the next until one is left, the subroot. Subroots by group (null first)
    give the root the same way. `folded_root` is recomputed from a row's proof and its leaf, or its
    leaf with `tampered_text` in place of the last column where that is not null.

    Time-forward processing: rows are numbered by sorted ranges, and a sweep over the nodes by
    label sends each digest to the parent through a priority queue. Nodes at the border of a
    block wait in a written table for the next sweep, LEVELS levels higher. Then sweeps by falling
    label bring down what a proof has from a node on. Texts are read once and never moved; a task
    holds messages to one path of nodes, whatever the size of a group.

    Equal first columns are ordered by leaf; rows equal in all columns are leaves of their own. A null
    first column comes first. A null text stays null, tampered or not. An empty table gives no row.
    Columns other than those named play no part.
    """
    workspace = Workspace(docs.sparkSession, "merkle")
    key, *middle, text = columns
    tampered = F.lit(None).cast("binary") if tampered_text is None else F.when(
        tampered_text.isNotNull(), leaf_digest([F.col(x) for x in (key, *middle)] + [tampered_text])
    )
    leaves = docs.select(
        F.col(group).cast("string").alias("tree"), F.col(key).cast("long").alias("doc_id"),
        leaf_digest([F.col(x) for x in columns]).alias("digest"), tampered.alias("tampered"),
        # Tells equal rows apart, so that many of them can be in several ranges.
        F.monotonically_increasing_id().alias("row"),
    )
    leaves = workspace.save(leaves, "leaves")
    placed = numbered(leaves, ["tree", "doc_id", "digest", "row"], workspace, "placed")
    groups = placed.groupBy("tree").agg(F.min("number").alias("first"), F.count("*").alias("n"))
    trees = workspace.save(numbered(groups, ["first"], workspace, "groups").withColumnRenamed("number", "g"), "trees")
    n_trees, largest = trees.agg(F.count("*"), F.max("n")).first()
    if not n_trees:
        return docs.sparkSession.createDataFrame([], _PROOF)
    named = trees.withColumnRenamed("tree", "named")
    nodes = placed.join(named, F.col("tree").eqNullSafe(F.col("named"))).select(
        "g", "n", (F.col("number") - F.col("first")).alias("i"), "digest", "doc_id", "tampered"
    )
    nodes = workspace.save(nodes, "nodes")
    workspace.drop("leaves")
    workspace.drop("placed")

    lower = _risen(nodes, largest, workspace, "up")
    subroots = workspace.save(_tops(lower), "subroots")
    upper = _risen(subroots.select(F.lit(0).cast("long").alias("g"), F.lit(n_trees).alias("n"), F.col("g").alias("i"), "digest"), n_trees, workspace, "top")
    roots = _tops(upper)
    root = bytes(roots.first()["digest"])
    start = roots.select("g", "n", "level", "i", F.lit(b"").alias("suffix"), F.lit(b"").alias("subroot"))
    above = _fallen(upper, start, workspace, "down").select(F.col("i").alias("g"), "suffix")
    tops = subroots.join(above, "g").select("g", "n", "level", "i", "suffix", F.col("digest").alias("subroot"))
    tops = workspace.save(tops, "tops")
    return _fallen(lower, tops, workspace, "proofs", n_trees, root)


def lowered_text(text: Column) -> Column:
    """A-Z made a-z, nothing else."""
    return F.translate(text, _UPPER, _LOWER)
