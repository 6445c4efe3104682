"""Region and ocean labels on tables, joins with large box tables, label counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from floatlake.catalog import BOX_SCHEMA, OCEAN_BOXES, REGION_BOXES, box_rows, find_column
from floatlake.functions.geo import assign_ocean, assign_region, in_box

# Cell-box pairs up to which the box side of the grid join is broadcast.
MAX_BROADCAST_PAIRS = 1_000_000
# Points of one cell that a single task may hold in the shuffled form.
POINTS_PER_TASK = 5_000_000
# Boxes of one cell from which on it is cut into parts; no array holds more.
MAX_CELL_BOXES = 256
# Halvings of a one-degree cell at most.
MAX_DEPTH = 8
BOX = ["prio", "name", "min_lat", "max_lat", "min_lon", "max_lon"]


def region_boxes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(box_rows(REGION_BOXES), BOX_SCHEMA)


def ocean_boxes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(box_rows(OCEAN_BOXES), BOX_SCHEMA)


def has_region_columns(df: DataFrame) -> bool:
    return {"avg_REGION", "ocean"} <= set(df.columns)


def add_region_columns(df: DataFrame, mode: str = "core") -> DataFrame:
    """Add avg_REGION and ocean; tables that have both, or no position, are unchanged.

    core leaves box borders out and uses the ocean belts; bgc includes borders and uses
    the ocean boxes.
    """
    lat, lon = find_column(df.columns, "LATITUDE"), find_column(df.columns, "LONGITUDE")
    if has_region_columns(df) or lat is None or lon is None:
        return df
    region, ocean = ("open", "chain") if mode == "core" else ("closed", "boxes")
    return df.withColumns({
        "avg_REGION": assign_region(lat, lon, region),
        "ocean": assign_ocean(lat, lon, ocean),
    })


def label_share(df: DataFrame, label: str) -> DataFrame:
    """Profiles per label with their share in percent, the most frequent first.

    The window runs over the counts, one row per label, not over the profiles.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(
        label, "n", (F.col("n") * 100.0 / total).alias("percent")
    ).orderBy(F.desc("n"), label)


def _unwrapped(boxes: DataFrame) -> DataFrame:
    """Cut boxes across the 180 degree meridian (min_lon > max_lon) into two."""
    across = F.col("min_lon") > F.col("max_lon")
    spans = F.when(
        across,
        F.array(
            F.struct(F.col("min_lon").alias("west"), F.lit(180.0).alias("east")),
            F.struct(F.lit(-180.0).alias("west"), F.col("max_lon").alias("east")),
        ),
    ).otherwise(F.array(F.struct(F.col("min_lon").alias("west"), F.col("max_lon").alias("east"))))
    return boxes.withColumn("_span", F.explode(spans)).select(
        "prio", "name", "min_lat", "max_lat",
        F.col("_span.west").alias("min_lon"), F.col("_span.east").alias("max_lon"),
    )


def _cells(boxes: DataFrame) -> DataFrame:
    """One row per box and one-degree cell it touches."""
    def span(low: str, high: str):
        return F.explode(F.sequence(F.floor(low), F.floor(high)))

    return boxes.withColumn("_clat", span("min_lat", "max_lat")).withColumn(
        "_clon", span("min_lon", "max_lon")
    )


def assign_boxes(
    points: DataFrame,
    boxes: DataFrame,
    id_columns: list[str],
    lat: str = "lat",
    lon: str = "lon",
    mode: str = "closed",
    unknown: str = "Unknown",
    label: str = "region",
    max_broadcast_pairs: int = MAX_BROADCAST_PAIRS,
    points_per_task: int = POINTS_PER_TASK,
    max_cell_boxes: int = MAX_CELL_BOXES,
) -> DataFrame:
    """First matching box of a box table for every point, by an equi-join on cells.

    Boxes are spread over one-degree cells and meet only the points of their cells, as one
    array per cell. While the cell-box pairs stay under ``max_broadcast_pairs`` (counted
    here) the arrays are broadcast and the points do not move. Beyond that both sides are
    shuffled; a cell with many points is cut into as many slices as its count asks for, and
    each slice gets the array. A cell with more than ``max_cell_boxes`` boxes is cut into parts, and no array
    holds more than that. Every point stays a row of its own in all forms, whatever
    its ``id_columns`` hold. Longitudes lie within +-180 where a box crosses the meridian.
    """
    boxes = _unwrapped(boxes)
    cells = _cells(boxes)
    pairs = boxes.agg(
        F.sum(
            (F.floor("max_lat") - F.floor("min_lat") + 1)
            * (F.floor("max_lon") - F.floor("min_lon") + 1)
        )
    ).first()[0] or 0
    located = points.withColumns({
        "_clat": F.floor(F.when(~F.isnan(lat), F.col(lat))),
        "_clon": F.floor(F.when(~F.isnan(lon), F.col(lon))),
    })

    def inside(box) -> Column:
        bounds = (box(c) for c in ("min_lat", "max_lat", "min_lon", "max_lon"))
        return in_box(F.col(lat), F.col(lon), *bounds, mode=mode)

    dense = _dense_cells(cells, max_cell_boxes)
    if dense is None:
        lists = cells.groupBy("_clat", "_clon").agg(F.sort_array(F.collect_list(F.struct(*BOX))).alias("_boxes"))
        joined = _join_cells(located, lists, ["_clat", "_clon"], pairs <= max_broadcast_pairs, points_per_task)
        return joined.select(*points.columns, F.coalesce(_first_hit(inside)["name"], F.lit(unknown)).alias(label))

    key = ["_clat", "_clon", "_sy", "_sx"]
    lists = _split_lists(cells, dense, max_cell_boxes)
    located = located.join(F.broadcast(dense), ["_clat", "_clon"], "left").withColumns({
        "_sy": _part(F.col(lat), "_clat"), "_sx": _part(F.col(lon), "_clon"), "_point": F.monotonically_increasing_id(),
    })
    # The first list of a cell holds the boxes that come first: who finds one there is done.
    first = lists.where("_number = 0").select(*key, "_boxes", "_lists")
    joined = _join_cells(located, first, key, pairs <= max_broadcast_pairs, points_per_task)
    judged = joined.select(*points.columns, *key, "_point", "_lists", _first_hit(inside)["name"].alias("_found"))
    others = judged.where("_found IS NULL AND _lists > 1").join(lists.where("_number > 0").select(*key, "_boxes"), key)
    later = others.select("_point", _first_hit(inside).alias("_hit")).where("_hit IS NOT NULL").groupBy("_point").agg(
        F.min(F.struct("_hit.prio", "_hit.name")).alias("_later")
    )
    result = judged.join(later, "_point", "left")
    return result.select(*points.columns, F.coalesce("_found", "_later.name", F.lit(unknown)).alias(label))

def _first_hit(inside) -> Column:
    """The first box of a cell's list that holds the point."""
    return F.get(F.filter("_boxes", lambda box: inside(lambda c: box[c])), F.lit(0))


def _join_cells(located: DataFrame, lists: DataFrame, cell: list[str], small: bool, points_per_task: int) -> DataFrame:
    if small:
        return located.join(F.broadcast(lists), cell, "left")
    return _shuffled_cells(located, lists, points_per_task, cell)


def _dense_cells(cells: DataFrame, most: int) -> DataFrame | None:
    """`_clat, _clon, _depth` of cells with more than ``most`` boxes, and how often to halve them; None without any.

    At most pairs / most rows. Cells are halved until an even spread of boxes fits, and once more.
    """
    counts = cells.groupBy("_clat", "_clon").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    depth = F.least(F.lit(MAX_DEPTH), F.ceil(F.log(4.0, F.col("n") / most)) + 1).cast("int")
    dense = counts.select("_clat", "_clon", depth.alias("_depth"))
    return dense if dense.take(1) else None


def _part(value: Column, cell: str) -> Column:
    """Which part of its cell a coordinate lies in."""
    parts = F.pow(F.lit(2.0), F.coalesce("_depth", F.lit(0)))
    return F.greatest(F.lit(0), F.least(parts - 1, F.floor((value - F.col(cell)) * parts))).cast("int")


def _split_lists(cells: DataFrame, dense: DataFrame, most: int) -> DataFrame:
    """`_clat, _clon, _sy, _sx, _number, _boxes, _lists`: boxes of cells and their parts, ``most`` in a list.

    Of boxes with equal borders only the first can win. Behind a box that covers a whole part
    no later box can. What is left of a part beyond ``most`` boxes goes on in further lists.
    """
    key = ["_clat", "_clon", "_sy", "_sx"]
    borders = ["min_lat", "max_lat", "min_lon", "max_lon"]
    first = cells.groupBy("_clat", "_clon", *borders).agg(F.min(F.struct("prio", "name")).alias("_first"))
    first = first.select("_clat", "_clon", "_first.prio", "_first.name", *borders).join(F.broadcast(dense), ["_clat", "_clon"], "left")
    parts = first.withColumn("_sy", F.explode(F.sequence(_part(F.col("min_lat"), "_clat"), _part(F.col("max_lat"), "_clat")))).withColumn(
        "_sx", F.explode(F.sequence(_part(F.col("min_lon"), "_clon"), _part(F.col("max_lon"), "_clon")))
    )
    size = F.pow(F.lit(0.5), F.coalesce("_depth", F.lit(0)))
    south, west = F.col("_clat") + F.col("_sy") * size, F.col("_clon") + F.col("_sx") * size
    covers = (F.col("min_lat") < south) & (F.col("max_lat") >= south + size) & (F.col("min_lon") < west) & (F.col("max_lon") >= west + size)
    own = F.struct("prio", "name")
    walls = parts.where(covers).groupBy(*key).agg(F.min(own).alias("_wall"))
    seen = parts.join(walls, key, "left").where(F.col("_wall").isNull() | (own <= F.col("_wall")))
    place = F.row_number().over(Window.partitionBy(*key).orderBy("prio", "name", *borders)) - 1
    numbered = seen.withColumn("_number", F.floor(place / most).cast("int"))
    lists = numbered.groupBy(*key, "_number").agg(F.sort_array(F.collect_list(F.struct(*BOX))).alias("_boxes"))
    return lists.withColumn("_lists", F.max("_number").over(Window.partitionBy(*key)) + 1)


def _shuffled_cells(
    located: DataFrame, lists: DataFrame, points_per_task: int, cell: list[str] | None = None
) -> DataFrame:
    cell = cell or ["_clat", "_clon"]
    # At most points / points_per_task cells are cut, so this table is always small.
    slices = (
        located.where("_clat IS NOT NULL AND _clon IS NOT NULL").groupBy(*cell)
        .agg(F.ceil(F.count(F.lit(1)) / points_per_task).cast("bigint").alias("_slices"))
        .where("_slices > 1")
    )
    # The place of a row in its partition is the same whenever a task is run again.
    place = F.monotonically_increasing_id()
    placed = located.withColumn("_place", F.pmod(place, F.lit(1 << 20)))
    cut = placed.join(F.broadcast(slices), cell, "left").withColumn(
        "_slice",
        # Points without a cell match nothing; they are spread over all tasks.
        F.when(F.col("_clat").isNull() | F.col("_clon").isNull(), -1 - F.pmod("_place", F.lit(4096)))
        .otherwise(F.pmod("_place", F.coalesce("_slices", F.lit(1)))),
    ).drop("_slices", "_place")
    copies = (
        lists.join(F.broadcast(slices), cell, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_slices", F.lit(1).cast("bigint")) - 1)))
        .drop("_slices")
    )
    return cut.join(copies, [*cell, "_slice"], "left")
