"""Clustering of whole-number vectors around centroids, nearest ones found by the threshold algorithm."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floatlake.llm.common import Workspace, record_batch

#: Whole numbers are held at this size at most, so that a distance of 64 components fits a long.
LARGEST = (1 << 27) - 1
#: Vectors that are walked together.
BATCH = 2048

_ASSIGNED = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])
_SUMS = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])


@dataclass(frozen=True)
class Centroids:
    """Centroids with one sorted list of them per dimension."""

    points: np.ndarray

    @cached_property
    def lists(self) -> tuple[np.ndarray, np.ndarray]:
        """Per dimension, the centroids by value, and their values between two borders that are never nearest."""
        order = np.argsort(self.points, axis=0, kind="stable")
        values = np.take_along_axis(self.points, order, axis=0)
        return order.T.copy(), values.T.copy()

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each vector; ties go to the smaller number."""
        parts = [self._walk(vectors[at : at + BATCH]) for at in range(0, len(vectors), BATCH)]
        if not parts:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        return np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])

    def _walk(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The threshold algorithm for some vectors.

        Every list is walked outward from the vector's own value, one centroid a round, the nearer
        side first. A centroid is measured whole when a list first shows it. One not yet shown is at
        least as far in each dimension as that list's frontier, so once the frontiers' squares sum
        to strictly more than the best distance, no other centroid can be nearer, or as near.
        """
        k, dims = self.points.shape
        order, values = self.lists
        n = len(vectors)
        high = np.stack([np.searchsorted(values[d], vectors[:, d]) for d in range(dims)], axis=1)
        low = high - 1
        seen = np.zeros((n, k), bool)
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, k, np.int64)
        open_rows = np.arange(n)
        each = np.arange(dims)
        while len(open_rows):
            own, lo, hi = vectors[open_rows], low[open_rows], high[open_rows]
            no_low, no_high = lo < 0, hi >= k
            down = own - values[each, np.maximum(lo, 0)]
            up = values[each, np.minimum(hi, k - 1)] - own
            take_low = ~no_low & (no_high | (down <= up))
            ended = no_low & no_high
            gap = np.where(take_low, down, up)
            # A list that has shown all centroids leaves none unseen.
            bound = (gap * gap).sum(1)
            going = ~(ended.any(1) | (bound > best[open_rows]))
            if not going.any():
                break
            open_rows, take_low, lo, hi, own = open_rows[going], take_low[going], lo[going], hi[going], own[going]
            shown = order[each, np.where(take_low, lo, hi)]
            low[open_rows] = lo - take_low
            high[open_rows] = hi + ~take_low
            fresh = np.zeros((len(open_rows), k), bool)
            np.put_along_axis(fresh, shown, True, axis=1)
            fresh &= ~seen[open_rows]
            seen[open_rows] |= fresh
            row, centroid = np.nonzero(fresh)
            if len(row):
                apart = own[row] - self.points[centroid]
                distance = np.full(fresh.shape, np.iinfo(np.int64).max)
                distance[row, centroid] = np.einsum("ij,ij->i", apart, apart)
                first = distance.argmin(1)
                least = distance[np.arange(len(first)), first]
                old, old_number = best[open_rows], number[open_rows]
                better = (least < old) | ((least == old) & (first < old_number))
                best[open_rows] = np.where(better, least, old)
                number[open_rows] = np.where(better, first, old_number)
        return number.astype(np.int32), best


def whole_vectors(rows: DataFrame, dims: int, scale: int, id_column: str, vector_column: str) -> DataFrame:
    """`vec_id, vector` (whole numbers) of rows whose vector has exactly `dims` components, all finite."""
    vector = F.col(vector_column)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform(vector, lambda x: F.floor(
        F.greatest(F.lit(-1.0 * LARGEST), F.least(F.lit(1.0 * LARGEST), x.cast("double") * scale))
    ).cast("long"))
    kept = rows.filter((F.size(vector) == dims) & F.coalesce(finite, F.lit(False)))
    return kept.select(F.col(id_column).cast("long").alias("vec_id"), scaled.alias("vector"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """Vectors of the `k` smallest hashes of seed and id, in that order; k rows reach the driver."""
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("-"))), 256)
    rows = vectors.select("vector", draw.alias("draw")).orderBy("draw", "vector").limit(k).collect()
    return np.array([r["vector"] for r in rows], np.int64)


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    column = batch.column("vector")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _assign(centroids: Centroids):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, distance = centroids.nearest(_matrix(batch, centroids.points.shape[1]))
            yield record_batch(_ASSIGNED, vec_id=batch.column("vec_id"), cluster=number, distance=distance)

    return run


def _sum_up(centroids: Centroids):
    """One row per centroid and task: how many vectors it is nearest to, and their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dims = centroids.points.shape
        count, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            vectors = _matrix(batch, dims)
            number, _ = centroids.nearest(vectors)
            count += np.bincount(number, minlength=k)
            np.add.at(sums, number, vectors)
        used = np.flatnonzero(count)
        yield record_batch(_SUMS, cluster=used.astype(np.int32), n=count[used], sums=list(sums[used]))

    return run


def moved_centroids(vectors: DataFrame, centroids: Centroids) -> Centroids:
    """Every centroid with vectors replaced by their componentwise floor of the mean; others stay."""
    dims = centroids.points.shape[1]
    partial = vectors.select("vector").mapInArrow(_sum_up(centroids), "cluster int, n long, sums array<long>")
    wide = F.array(*(F.sum(F.col("sums")[d].cast("decimal(38,0)")) for d in range(dims)))
    points = centroids.points.copy()
    for r in partial.groupBy("cluster").agg(F.sum("n").alias("n"), wide.alias("sums")).collect():
        points[r["cluster"]] = [int(x) // r["n"] for x in r["sums"]]
    return Centroids(points)


def _of_cluster(values: list, kind: str) -> Column:
    return F.get(F.array(*(F.lit(x).cast(kind) for x in values)), F.col("cluster"))


def centroid_clusters(
    rows: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, dims: int = 64, scale: int = 256,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """`vec_id, cluster, distance, cluster_inertia, inertia, centroid, centroid_sha256` of every usable vector.

    Vectors count with exactly `dims` components, none null, NaN or infinite; each component x
    becomes floor(scale * x), held between -LARGEST and LARGEST. Centroids start as the `k` vectors
    whose ids hash smallest; `rounds` times all vectors go to their nearest centroid (squared
    Euclidean distance, ties to the smaller number) and each centroid that has some moves to the
    floor of their mean. Then vectors are assigned once more. All numbers are exact.

    Each round reads the written vectors once, without moving them; one row of sums per centroid and
    task is shuffled, and k rows reach the driver. Fewer than k usable vectors give as many
    centroids; equal centroids and equal ids are allowed, equal vectors of one id are interchangeable
    (a null id hashes as `-`, and equal ids are drawn by vector). An inertia that exceeds a long is
    null. No usable vector gives no row. Other columns play no part.
    """
    spark = rows.sparkSession
    workspace = Workspace(spark, "clusters")
    vectors = workspace.save(whole_vectors(rows, dims, scale, id_column, vector_column), "vectors")
    points = first_centroids(vectors, k, seed)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string"
    if not len(points):
        return spark.createDataFrame([], schema)
    centroids = Centroids(points)
    for _ in range(rounds):
        centroids = moved_centroids(vectors, centroids)
    assigned = workspace.save(vectors.mapInArrow(_assign(centroids), "vec_id long, cluster int, distance long"), "assigned")
    workspace.drop("vectors")
    distance = F.sum(F.col("distance").cast("decimal(38,0)"))
    own = {r["cluster"]: int(r["d"]) for r in assigned.groupBy("cluster").agg(distance.alias("d")).collect()}
    fits = lambda x: x if x < 1 << 63 else None
    numbers = range(len(points))
    texts = [",".join(map(str, p)) for p in centroids.points.tolist()]
    return assigned.select(
        "vec_id", "cluster", "distance",
        _of_cluster([fits(own.get(c, 0)) for c in numbers], "long").alias("cluster_inertia"),
        F.lit(fits(sum(own.values()))).cast("long").alias("inertia"),
        F.split(_of_cluster(texts, "string"), ",").cast("array<long>").alias("centroid"),
    ).withColumn("centroid_sha256", F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256))
