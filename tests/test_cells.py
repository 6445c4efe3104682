"""Boxes in dense cells: parts of cells and several lists give the first box as a plain search does."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from floatlake.operators import regions

SCHEMA = "prio long, name string, min_lat double, max_lat double, min_lon double, max_lon double"


def expected(boxes, points, mode):
    order = sorted(boxes, key=lambda b: (b[0], b[1]))
    a = np.array([b[2:] for b in order])
    for y, x in points:
        if y is None or x is None:
            yield "Unknown"
            continue
        held = (a[:, 0] <= y) & (y <= a[:, 1]) & (a[:, 2] <= x) & (x <= a[:, 3]) if mode == "closed" else (a[:, 0] < y) & (y < a[:, 1]) & (a[:, 2] < x) & (x < a[:, 3])
        yield order[int(held.argmax())][1] if held.any() else "Unknown"


def found(spark, boxes, points, **options):
    df = spark.createDataFrame([(i, y, x, 7) for i, (y, x) in enumerate(points)], "pid long, lat double, lon double, _sy long")
    out = regions.assign_boxes(df, spark.createDataFrame(boxes, SCHEMA), ["pid"], **options)
    assert out.columns == ["pid", "lat", "lon", "_sy", "region"]
    return [r.region for r in out.orderBy("pid").collect()]


def clustered(rng, n):
    """Boxes of all sizes, most of them in one degree, some with whole-degree borders, nested, equal or around all."""
    for i in range(n):
        kind = rng.randrange(10)
        if kind == 0:
            s, w = rng.randrange(9, 12), rng.randrange(19, 22)
            yield rng.randrange(50), f"b{i}", float(s), float(s + 1), float(w), float(w + 1)
        elif kind == 1:
            yield rng.randrange(50), f"b{i}", 10.25, 10.75, 20.25, 20.75
        elif kind == 2:
            yield rng.randrange(40, 60), f"b{i}", 9.5, 11.5, 19.0, 22.0
        else:
            s, w = 10 + rng.randrange(256) / 256, 20 + rng.randrange(256) / 256
            yield rng.randrange(50), f"b{i}", s, s + rng.choice([1, 3, 20]) / 256, w, w + rng.choice([1, 3, 20]) / 256


@pytest.mark.parametrize("mode", ["closed", "open"])
@pytest.mark.parametrize("most, pairs", [(20, 1_000_000), (3, 1_000_000), (20, 0)])
def test_dense_cells(spark, mode, most, pairs):
    rng = random.Random(most)
    boxes = list(clustered(rng, 800))
    points = [(10 + rng.randrange(513) / 512, 20 + rng.randrange(513) / 512) for _ in range(1500)] + [(rng.uniform(9, 12), rng.uniform(19, 22)) for _ in range(200)]
    points += [(None, 1.0), (50.0, 50.0), (10.0, 20.0), (11.0, 21.0)]
    got = found(spark, boxes, points, mode=mode, max_cell_boxes=most, max_broadcast_pairs=pairs, points_per_task=100)
    assert got == list(expected(boxes, points, mode))


def test_no_list_is_longer_than_stated(spark):
    """100,000 boxes in one degree."""
    rng = np.random.default_rng(1)
    s, w = 10 + rng.random(100_000), 20 + rng.random(100_000)
    boxes = [(i, f"b{i}", float(a), float(min(a + 0.003, 11)), float(b), float(min(b + 0.003, 21))) for i, (a, b) in enumerate(zip(s, w, strict=True))]
    table = spark.createDataFrame(boxes, SCHEMA)
    cells = regions._cells(regions._unwrapped(table))
    lists = regions._split_lists(cells, regions._dense_cells(cells, regions.MAX_CELL_BOXES), regions.MAX_CELL_BOXES)
    assert lists.agg(F.max(F.size("_boxes"))).first()[0] <= regions.MAX_CELL_BOXES
    points = [(float(10 + y), float(20 + x)) for y, x in rng.random((400, 2))]
    assert found(spark, boxes, points) == list(expected(boxes, points, "closed"))


def test_boxes_that_cannot_be_told_apart_by_cells(spark):
    """Thousands of nested boxes around one point go to several lists."""
    boxes = [(i, f"b{i}", 10.5 - i * 1e-7, 10.5 + i * 1e-7, 20.5 - i * 1e-7, 20.5 + i * 1e-7) for i in range(1, 2000)]
    points = [(10.5, 20.5), (10.5 + 5.5e-5, 20.5), (10.5 + 1.5e-4, 20.5 - 1.9e-4), (10.6, 20.6)]
    assert found(spark, boxes, points) == list(expected(boxes, points, "closed")) and len(boxes) > 7 * regions.MAX_CELL_BOXES
