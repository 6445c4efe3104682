"""Points in polygons: even-odd ray casting, by one-degree cells.

A polygon is a set of rings of vertices; a point is in it if a ray from the point crosses its
rings an odd number of times, so a ring inside another is a hole. Cells that no edge touches lie
wholly inside or outside, so only points of border cells are tested, and only against the edges of
their one-degree row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from floatlake.operators.regions import MAX_BROADCAST_PAIRS, POINTS_PER_TASK, _shuffled_cells

#: Added to both sides of where an edge passes through a column of cells: a cell more costs a test, no result.
MARGIN = 1e-9
CELL = ["_clat", "_clon"]


def polygon_edges(vertices: DataFrame) -> DataFrame:
    """`prio, name, y1, x1, y2, x2` of each edge, from `prio, name, ring, place, lat, lon`.

    A ring is closed: its last vertex is joined to the first, equal or not. Vertices without
    a finite position are left out.
    """
    ring = Window.partitionBy("prio", "name", "ring").orderBy("place", "lat", "lon")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    y, x = F.col("lat").cast("double"), F.col("lon").cast("double")
    known = vertices.select("prio", "name", "ring", "place", y.alias("lat"), x.alias("lon")).where(
        (F.abs("lat") < float("inf")) & (F.abs("lon") < float("inf"))
    )
    ends = known.select(
        "prio", "name", F.col("lat").alias("y1"), F.col("lon").alias("x1"),
        F.coalesce(F.lead("lat").over(ring), F.first("lat").over(whole)).alias("y2"),
        F.coalesce(F.lead("lon").over(ring), F.first("lon").over(whole)).alias("x2"),
    )
    return ends.where("y1 <> y2 OR x1 <> x2")


def _cross(edge: Column, y: Column, x: Column) -> Column:
    """Twice the area of edge and point: zero on the edge's line."""
    return (edge["x2"] - edge["x1"]) * (y - edge["y1"]) - (edge["y2"] - edge["y1"]) * (x - edge["x1"])


def in_rings(edges: Column, y: Column, x: Column, border: bool) -> Column:
    """Whether a point is inside, from the edges of all rows a ray eastward from it can meet.

    Points on an edge are inside exactly if ``border``.
    """
    def crossed(edge: Column) -> Column:
        # An upward edge is crossed by points left of it, a downward one the other way round.
        area = _cross(edge, y, x)
        up = edge["y2"] > edge["y1"]
        return ((edge["y1"] > y) != (edge["y2"] > y)) & F.when(up, area > 0).otherwise(area < 0)

    def touched(edge: Column) -> Column:
        return (
            (_cross(edge, y, x) == 0)
            & y.between(F.least(edge["y1"], edge["y2"]), F.greatest(edge["y1"], edge["y2"]))
            & x.between(F.least(edge["x1"], edge["x2"]), F.greatest(edge["x1"], edge["x2"]))
        )

    odd = F.size(F.filter(edges, crossed)) % 2 == 1
    on = F.exists(edges, touched)
    return (odd | on) if border else (odd & ~on)


def polygon_cells(edges: DataFrame, border: bool) -> DataFrame:
    """`prio, name, _clat, _clon, _edges` of cells inside a polygon (no edges) or at its border."""
    key = ["prio", "name"]
    edge = F.struct("y1", "x1", "y2", "x2")
    south, north = F.least("y1", "y2"), F.greatest("y1", "y2")
    west, east = F.least("x1", "x2"), F.greatest("x1", "x2")
    rows = edges.select(*key, edge.alias("edge"), F.explode(F.sequence(F.floor(south), F.floor(north))).alias("_clat"))
    strips = rows.groupBy(*key, "_clat").agg(F.sort_array(F.collect_list("edge")).alias("_edges"))

    # Columns an edge passes through, and the rows it passes through in each.
    columns = edges.withColumn("_clon", F.explode(F.sequence(F.floor(west), F.floor(east))))
    run = F.col("x2") - F.col("x1")

    def height(at: Column) -> Column:
        return F.col("y1") + (F.col("y2") - F.col("y1")) * F.try_divide(at - F.col("x1"), run)

    a, b = height(F.greatest(west, F.col("_clon"))), height(F.least(east, F.col("_clon") + 1))
    low = F.greatest(south, F.coalesce(F.least(a, b), south) - MARGIN)
    high = F.least(north, F.coalesce(F.greatest(a, b), north) + MARGIN)
    passed = columns.withColumn("_clat", F.explode(F.sequence(F.floor(low), F.floor(high))))
    at_border = passed.select(*key, *CELL).distinct()

    bounds = edges.groupBy(*key).agg(
        F.floor(F.min(south)).alias("s"), F.floor(F.max(north)).alias("n"), F.floor(F.min(west)).alias("w"), F.floor(F.max(east)).alias("e"),
    )
    cells = bounds.withColumn("_clat", F.explode(F.sequence("s", "n"))).withColumn("_clon", F.explode(F.sequence("w", "e")))
    clear = cells.select(*key, *CELL).join(at_border, [*key, *CELL], "left_anti").join(strips, [*key, "_clat"])
    middle = in_rings(F.col("_edges"), F.col("_clat") + 0.5, F.col("_clon") + 0.5, border)
    inside = clear.where(middle).select(*key, *CELL, F.slice("_edges", 1, 0).alias("_edges"), F.lit(True).alias("_whole"))
    tested = at_border.join(strips, [*key, "_clat"]).select(*key, *CELL, "_edges", F.lit(False).alias("_whole"))
    return inside.unionByName(tested)


def assign_polygons(
    points: DataFrame,
    vertices: DataFrame,
    lat: str = "lat",
    lon: str = "lon",
    border: bool = False,
    unknown: str = "Unknown",
    label: str = "region",
    max_broadcast_pairs: int = MAX_BROADCAST_PAIRS,
    points_per_task: int = POINTS_PER_TASK,
) -> DataFrame:
    """Every point with the first polygon (by ``prio``, then name) that holds it.

    ``vertices`` is a table of `prio, name, ring, place, lat, lon`. Points on an edge, outer or
    of a hole, are inside only with ``border``. Points without a position are unknown. The cells'
    lists are broadcast while they hold at most ``max_broadcast_pairs`` edges and cells (counted
    here); beyond that points and cells are shuffled, and cells of many points are cut.
    """
    key = ["prio", "name"]
    cells = polygon_cells(polygon_edges(vertices), border)
    pairs = cells.agg(F.sum(F.size("_edges") + 1)).first()[0] or 0
    lists = cells.groupBy(*CELL).agg(F.sort_array(F.collect_list(F.struct(*key, "_whole", "_edges"))).alias("_polygons"))
    located = points.withColumns({
        "_clat": F.floor(F.when(~F.isnan(lat), F.col(lat))), "_clon": F.floor(F.when(~F.isnan(lon), F.col(lon))),
    })
    if pairs <= max_broadcast_pairs:
        joined = located.join(F.broadcast(lists), CELL, "left")
    else:
        joined = _shuffled_cells(located, lists, points_per_task)
    y, x = F.col(lat).cast("double"), F.col(lon).cast("double")
    hits = F.filter("_polygons", lambda p: p["_whole"] | in_rings(p["_edges"], y, x, border))
    return joined.select(*points.columns, F.coalesce(F.get(hits, F.lit(0))["name"], F.lit(unknown)).alias(label))
