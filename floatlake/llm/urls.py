"""URL filters: exact membership in key lists by cascades of Bloom filters."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from floatlake.llm.common import Workspace

#: Bits of all filters broadcast at once; a larger list is applied in several passes.
BROADCAST_BITS = 64 << 23
#: False positives a level lets through.
FALSE_SHARE = 0.1
#: After the first level, so few keys that pass all levels are held by value: no further level follows.
LAST_KEYS = 8


def url_host(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: str, path: str, prefixes: list[int], longest: int) -> list[str]:
    """Keys that can stand for a URL: each parent of the host with each prefix of the path.

    Parents of more than `longest` characters, the longest host of a key, can't be one, so a host of
    very many labels costs no more than a short one. The longest key comes first; of equally long
    ones that with the longer host.
    """
    keys, at = [], len(host)
    while at > 0:
        at = host.rfind(".", 0, at)
        parent = host[at + 1 :]
        if len(parent) > longest:
            break
        if parent:
            keys += [(parent, path[:n]) for n in prefixes if n <= len(path)]
    keys.sort(key=lambda x: (-len(x[0]) - len(x[1]), -len(x[0])))
    return [p + x for p, x in keys]


def key_hashes(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    low = np.fromiter((xxhash.xxh64_intdigest(k.encode("utf-8", "surrogatepass"), 1) for k in keys), np.uint64, len(keys))
    high = np.fromiter((xxhash.xxh64_intdigest(k.encode("utf-8", "surrogatepass"), 2) for k in keys), np.uint64, len(keys))
    return low, high | np.uint64(1)


def positions(low: np.ndarray, high: np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
    """Bits of each key in the filter of a level, one row per hash."""
    start = low ^ (np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64))
    start ^= start >> np.uint64(31)
    start *= np.uint64(0x94D049BB133111EB)
    return np.stack([(start + np.uint64(k) * high) % np.uint64(bits) for k in range(hashes)]) if len(low) else np.zeros((hashes, 0), np.uint64)


@dataclass
class Cascade:
    """Levels `(bits, hashes, words)`: even ones hold listed keys, odd ones the others that pass.

    `rest` holds the few keys that passed every level, and `rest_listed` what they are.
    For keys of the universe it was built over, the answer is exact.
    """

    levels: list[tuple[int, int, np.ndarray]] = field(default_factory=list)
    rest: frozenset[str] = frozenset()
    rest_listed: bool = True

    def contains(self, keys: list[str]) -> np.ndarray:
        low, high = key_hashes(keys)
        listed = np.zeros(len(keys), bool)
        open_keys = np.arange(len(keys))
        for number, (bits, hashes, words) in enumerate(self.levels):
            at = positions(low[open_keys], high[open_keys], number, bits, hashes)
            inside = ((words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)
            # A key missing from a level of listed keys is not listed, and the other way round.
            listed[open_keys[~inside]] = number % 2 == 1
            open_keys = open_keys[inside]
            if not len(open_keys):
                return listed
        for i in open_keys:
            listed[i] = (keys[i] in self.rest) == self.rest_listed
        return listed


def _filter_size(keys: int) -> tuple[int, int]:
    bits = max(64, math.ceil(keys * -math.log(FALSE_SHARE) / math.log(2) ** 2))
    return -(-bits // 64) * 64, max(1, round(bits / max(keys, 1) * math.log(2))) if keys > 10 else 3


def _set_bits(level: int, bits: int, hashes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = positions(*key_hashes(batch.column("key").to_pylist()), level, bits, hashes).ravel()
            words, index = np.unique(at >> np.uint64(6), return_inverse=True)
            masks = np.zeros(len(words), np.uint64)
            np.bitwise_or.at(masks, index, np.uint64(1) << (at & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(words.astype(np.int64)), pa.array(masks.view(np.int64))], ["word", "mask"])

    return run


def _passing(cascade: Cascade):
    """Whether a key passes the last level."""
    number = len(cascade.levels) - 1
    bits, hashes, words = cascade.levels[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = positions(*key_hashes(batch.column("key").to_pylist()), number, bits, hashes)
            inside = ((words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)
            yield batch.filter(pa.array(inside))

    return run


def build_cascade(universe: DataFrame, listed: DataFrame, workspace: Workspace, name: str) -> Cascade:
    """Cascade over `universe.key` (distinct, every key that may be asked for) for `listed.key`.

    Each level's bits are set by an aggregation; only words of bits come to the driver.
    Levels end when no key of the other side passes, or LAST_KEYS at most, which are kept by value.
    A list without a key in the universe needs no level.
    """
    inside = workspace.save(universe.join(listed.select("key").distinct(), "key", "left_semi"), f"{name}-in")
    outside = workspace.save(universe.join(inside, "key", "left_anti"), f"{name}-out")
    cascade = Cascade()
    sides, listed_side = [inside, outside], True
    own = inside.count()
    while True:
        if not own or (cascade.levels and own <= LAST_KEYS):
            cascade.rest = frozenset(row.key for row in sides[0].collect())
            cascade.rest_listed = listed_side
            return cascade
        number = len(cascade.levels)
        bits, hashes = _filter_size(own)
        rows = sides[0].mapInArrow(_set_bits(number, bits, hashes), "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
        words = np.zeros(bits // 64, np.uint64)
        words[rows["word"].to_numpy()] = rows["mask"].to_numpy().view(np.uint64)
        cascade.levels.append((bits, hashes, words))
        passing = workspace.save(sides[1].mapInArrow(_passing(cascade), "key string"), f"{name}-{number}")
        sides, listed_side = [passing, sides[0]], not listed_side
        own = passing.count()


def corpus_keys(addresses: DataFrame, prefixes: list[int], longest: int) -> DataFrame:
    """Distinct `key` over all `host, path`: the complete key universe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = {k for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True) for k in candidate_keys(h, p, prefixes, longest)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(keys), pa.string())], ["key"])

    short = addresses.select(
        # Longer parents of the host are no keys; the cut end is none either, unless the whole host is.
        F.when(F.char_length("host") > longest + 1, F.right("host", F.lit(longest + 1))).otherwise(F.col("host")).alias("host"),
        F.substring("path", 1, max(prefixes, default=0)).alias("path"),
    )
    return short.mapInArrow(run, "key string").distinct()


def _in_shard(key: str, number: int, shards: int) -> bool:
    """Whether pmod(xxhash64(key), shards) is the shard: a cascade is exact for its own keys only."""
    value = xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass"), 42)
    return (value - (1 << 64) if value >> 63 else value) % shards == number


def _lookup(spark: SparkSession, cascades: dict[str, Cascade], prefixes: list[int], longest: int, number: int, shards: int):
    shared = spark.sparkContext.broadcast(cascades)

    @F.pandas_udf("rule string, allowed boolean, listed boolean")
    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = shared.value
        for batch in batches:
            known: dict[tuple[str, str], tuple] = {}
            pairs = list(zip(batch["host"], batch["path"], strict=True))
            fresh = sorted(set(pairs))
            keys = [candidate_keys(h, p, prefixes, longest) for h, p in fresh]
            if shards > 1:
                keys = [[k for k in own if _in_shard(k, number, shards)] for own in keys]
            flat = [k for own in keys for k in own]
            ruled, allowed, listed = (found[x].contains(flat) for x in ("rules", "allowed", "listed"))
            at = 0
            for pair, own in zip(fresh, keys, strict=True):
                hit = next((i for i in range(at, at + len(own)) if ruled[i]), None)
                known[pair] = (None if hit is None else flat[hit], None if hit is None else bool(allowed[hit]), bool(listed[at : at + len(own)].any()))
                at += len(own)
            rows = [known[pair] for pair in pairs]
            yield pd.DataFrame({
                "rule": pd.Series([x[0] for x in rows], dtype=object), "allowed": pd.Series([x[1] for x in rows], dtype=object),
                "listed": pd.Series([x[2] for x in rows], dtype=bool),
            })

    return look


def url_verdicts(
    pages: DataFrame, rules: DataFrame, listed: DataFrame, id_column: str = "page_id", url_column: str = "url"
) -> DataFrame:
    """`page_id, host, path, rule, verdict, listed` of every row.

    `rules` has `key` (host, then the start of a path) and `verdict` (allow or block); `listed`
    has `key` (a host, or a host and the start of a path). A key fits its host, all hosts below
    it and every path with its start. The longest rule that fits decides; with none, a URL is
    blocked if a listed key fits, else allowed. A null URL or one without `://` has an empty
    host and path, fits no key and is allowed. Repeated rows, rules and keys change nothing (of
    two verdicts for one rule, block holds); an empty table gives no row.

    Rules and lists are encoded as Bloom filter cascades over all keys the pages can ask for, so
    a page is judged where it lies: no join with a list. Cascades of more than BROADCAST_BITS
    are split by a hash of the key and applied one after the other.
    """
    spark = pages.sparkSession
    workspace = Workspace(spark, "urls")
    url = F.col(url_column).cast("string")
    addressed = pages.select(F.col(id_column).cast("long").alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"))
    rules = rules.select("key", "verdict").dropna().filter("key <> ''")
    listed = listed.select("key").dropna().filter("key <> ''")
    length = F.char_length("key") - F.char_length(F.substring_index("key", "/", 1))
    every = rules.select("key").unionByName(listed)
    # One row per length of a path: as few as the longest one has characters.
    prefixes = sorted(row.n for row in every.select(length.alias("n")).distinct().collect())
    longest = every.agg(F.max(F.char_length(F.substring_index("key", "/", 1)))).first()[0] or 0
    universe = workspace.save(corpus_keys(addressed, prefixes, longest), "universe")
    blocked = rules.filter("verdict = 'block'").select("key")
    allowed = rules.filter("verdict <> 'block'").join(blocked, "key", "left_anti").select("key")

    total = rules.count() + listed.count()
    shards = max(1, math.ceil(4 * _filter_size(total)[0] / BROADCAST_BITS))
    shard = F.pmod(F.xxhash64("key"), F.lit(shards))
    judged = addressed.withColumns({"rule": F.lit(None).cast("string"), "allowed": F.lit(None).cast("boolean"), "listed": F.lit(False)})
    for number in range(shards):
        if number:
            judged = workspace.save(judged, f"judged{number}")
        own = universe.filter(shard == number)
        cascades = {
            name: build_cascade(own, keys, workspace, f"{name}{number}")
            for name, keys in (("rules", rules.select("key")), ("allowed", allowed), ("listed", listed))
        }
        found = _lookup(spark, cascades, prefixes, longest, number, shards)(F.struct("host", "path"))
        judged = judged.withColumn("x", found)
        longer = F.col("x.rule").isNotNull() & (
            F.col("rule").isNull() | (F.char_length("x.rule") > F.char_length("rule"))
            | ((F.char_length("x.rule") == F.char_length("rule")) & (F.instr("x.rule", "/") > F.instr("rule", "/")))
        )
        judged = judged.select(
            "page_id", "host", "path", F.when(longer, F.col("x.rule")).otherwise(F.col("rule")).alias("rule"),
            F.when(longer, F.col("x.allowed")).otherwise(F.col("allowed")).alias("allowed"), (F.col("listed") | F.col("x.listed")).alias("listed"),
        )
    verdict = F.when(F.coalesce("allowed", ~F.col("listed")), "allow").otherwise("block")
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "listed")


def hosts_with_words(pages: DataFrame, words: list[str], url_column: str = "url") -> DataFrame:
    """Distinct `key`: hosts of the pages that have one of the words between dots and hyphens."""
    hosts = pages.select(url_host(F.col(url_column).cast("string")).alias("key")).filter("key <> ''").distinct()
    return hosts.filter(F.arrays_overlap(F.split("key", r"[.\-]"), F.array(*map(F.lit, words))))
