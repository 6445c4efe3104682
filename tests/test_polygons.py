"""Points in polygons: random shapes, holes, borders and cells, against a plain test of every edge."""

import math
import random

import pytest
from pyspark.sql import functions as F

from floatlake.operators import polygons


def plain(rings, y, x, border):
    odd = on = False
    for ring in rings:
        for (y1, x1), (y2, x2) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (y1, x1) == (y2, x2):
                continue
            if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(y1, y2) <= y <= max(y1, y2) and min(x1, x2) <= x <= max(x1, x2):
                on = True
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd or on if border else odd and not on


def shape(rng, size):
    y, x, n = rng.uniform(-60, 60), rng.uniform(-150, 150), rng.randint(3, 30)
    return [(y + size * rng.uniform(0.3, 1) * math.sin(k * 6.283 / n), x + size * rng.uniform(0.3, 1) * math.cos(k * 6.283 / n)) for k in range(n)]


def vertex_rows(shapes):
    return [(p, name, r, k, y, x) for p, name, rings in shapes for r, ring in enumerate(rings) for k, (y, x) in enumerate(ring)]


SCHEMA = "prio long, name string, ring long, place long, lat double, lon double"


def assigned(spark, shapes, points, **options):
    df = spark.createDataFrame([(i, *p, 1) for i, p in enumerate(points)], "pid long, lat double, lon double, _edges long")
    out = polygons.assign_polygons(df, spark.createDataFrame(vertex_rows(shapes), SCHEMA), **options)
    assert out.columns == ["pid", "lat", "lon", "_edges", "region"]
    return {r.pid: r.region for r in out.collect()}


def expected(shapes, points, border):
    found = {}
    for i, (y, x) in enumerate(points):
        usable = y is not None and x is not None and not math.isnan(y) and not math.isnan(x)
        held = [(p, name) for p, name, rings in shapes if usable and plain(rings, y, x, border)]
        found[i] = min(held)[1] if held else "Unknown"
    return found


@pytest.mark.parametrize("border", [True, False])
@pytest.mark.parametrize("pairs", [1_000_000, 0])
def test_random_shapes(spark, border, pairs):
    rng = random.Random(7)
    shapes = [(rng.randint(0, 3), f"p{i}", [shape(rng, rng.choice([0.2, 3, 25]))]) for i in range(25)]
    points = [(y + rng.uniform(-2, 2), x + rng.uniform(-2, 2)) for _, _, rings in shapes for y, x in rings[0] for _ in range(3)]
    points += [(rng.uniform(-80, 80), rng.uniform(-170, 170)) for _ in range(500)] + [(None, 1.0), (1.0, None), (float("nan"), 2.0)]
    assert assigned(spark, shapes, points, border=border, max_broadcast_pairs=pairs, points_per_task=50) == expected(shapes, points, border)


@pytest.mark.parametrize("border", [True, False])
def test_whole_degrees_holes_and_borders(spark, border):
    """Edges along cell borders, through cell corners and through points; an island in a hole; a closed and an open ring."""
    square = lambda s, w, n, e: [(s, w), (s, e), (n, e), (n, w)]
    shapes = [
        (2, "lake", [square(0.0, 0.0, 10.0, 10.0) + [(0.0, 0.0)], square(2.0, 2.0, 8.0, 8.0), square(4.0, 4.0, 6.0, 6.0)]),
        (1, "kite", [[(5.0, 10.0), (10.0, 15.0), (5.0, 20.0), (0.0, 15.0)]]),
        (3, "bow", [[(-5.0, -5.0), (5.0, 5.0), (5.0, -5.0), (-5.0, 5.0)]]),
    ]
    points = [(y / 2, x / 2) for y in range(-14, 26) for x in range(-14, 46)]
    found = assigned(spark, shapes, points, border=border)
    assert found == expected(shapes, points, border)
    at = {p: found[i] for i, p in enumerate(points)}
    assert at[1.0, 1.0] == at[5.0, 5.0] == "lake" and at[7.0, 3.0] != "lake"
    assert (at[0.0, 9.5] == "lake") == border and (at[2.0, 7.0] == "lake") == border


def test_no_polygon_and_no_point(spark):
    assert assigned(spark, [], [(1.0, 1.0)]) == {0: "Unknown"}
    assert assigned(spark, [(1, "a", [[(0.0, 0.0), (0.0, 9.0), (9.0, 0.0)]])], []) == {}
    line = [(1, "line", [[(0.0, 0.0), (5.0, 5.0)]]), (2, "dot", [[(3.0, 4.0)]]), (3, "bad", [[(float("nan"), 1.0), (None, 2.0), (1.0, float("inf"))]])]
    assert assigned(spark, line, [(2.0, 2.0), (3.0, 4.0), (2.0, 1.0)]) == {0: "Unknown", 1: "Unknown", 2: "Unknown"}


def test_only_border_cells_carry_edges(spark):
    rows = vertex_rows([(1, "a", [[(0.0, 0.0), (0.0, 40.0), (40.0, 40.0), (40.0, 0.0)]])])
    cells = polygons.polygon_cells(polygons.polygon_edges(spark.createDataFrame(rows, SCHEMA)), False)
    counts = {r["_whole"]: (r["n"], r["most"]) for r in cells.groupBy("_whole").agg(F.count("*").alias("n"), F.max(F.size("_edges")).alias("most")).collect()}
    assert counts[True][1] == 0 and counts[True][0] >= 38 * 38 and counts[False][0] < 4 * 43 and counts[False][1] <= 4
