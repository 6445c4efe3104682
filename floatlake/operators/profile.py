"""Measures of one profile: level count, surface temperature, mixed layer, depth.

A profile is the group of level rows that share ``keys``. Rows with a null key form
no profile. All results are one row per profile, from one look at the levels and
partial + final aggregations; see states.records for how the mixed layer does with one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from floatlake.catalog import (
    MAX_DEPTH, MIXED_LAYER_THRESHOLD, REFERENCE_PRESSURE, SURFACE_PRESSURE, find_column,
)
from floatlake.functions.measures import pressure_to_depth, valid_pair, valid_pressure
from floatlake.functions.text import is_finite, nan_to_null
from floatlake.operators.skew import HOT_ROWS, any_null, attach_groups
from floatlake.operators.states import LIST_ROWS, States

SIZE = "_size"


def n_levels_keys(columns: list[str]) -> list[str]:
    """Grouping of the level count: platform, cycle, and serial number and JULD if there."""
    wanted = ["PLATFORM_NUMBER", "CYCLE_NUMBER", "FLOAT_SERIAL_NO", "JULD"]
    found = [find_column(columns, name) for name in wanted]
    if found[0] is None or found[1] is None:
        raise ValueError("PLATFORM_NUMBER and CYCLE_NUMBER are needed to count levels")
    return [name for name in found if name is not None]


def level_counts(df: DataFrame, keys: list[str] | None = None, pres: str = "PRES") -> DataFrame:
    """Number of valid pressures and of rows per profile."""
    keys = keys or n_levels_keys(df.columns)
    return (
        df.where(~any_null(keys))
        .groupBy(*keys)
        .agg(F.count_if(valid_pressure(pres)).alias("n_levels"), F.count(F.lit(1)).alias(SIZE))
    )


def with_n_levels(
    df: DataFrame, keys: list[str] | None, order: list[str], pres: str = "PRES",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every row with the number of valid pressures of its profile.

    Rows with a null key get null. Summaries do not need this operator: they count
    while they aggregate and never move the rows.
    """
    keys = keys or n_levels_keys(df.columns)
    counts = level_counts(df, keys, pres)
    return attach_groups(df, counts, keys, ["n_levels"], SIZE, order, hot_rows)


def n_levels_range(df: DataFrame) -> DataFrame:
    """Smallest and largest level count, of rows or of level_counts."""
    return df.agg(
        F.min("n_levels").alias("min_n_levels"), F.max("n_levels").alias("max_n_levels")
    )


def surface_temp_state(states: States, pres: Column, temp: Column) -> Column:
    """Mean temperature of the levels between 0 and 20 dbar."""
    near = pres.between(0.0, SURFACE_PRESSURE) & is_finite(pres) & is_finite(temp)
    return states.mean("surface", F.when(near, temp))


def depth_states(states: States, pres: Column, mode: str) -> tuple[Column, Column, Column]:
    """Smallest, largest and mean depth."""
    depth = pressure_to_depth(pres)
    usable = depth >= 0
    if mode == "core":
        usable = usable & (depth <= MAX_DEPTH) & is_finite(depth)
    kept = F.when(usable, depth)
    return states.min("depth", kept), states.max("depth", kept), states.mean("depth", kept)


def layer_state(states: States, pres: Column, temp: Column, mode: str, threshold: float) -> Column:
    """Mixed-layer depth: the smallest pressure whose temperature differs from the reference by the threshold.

    The reference is the mean of the levels down to 10 dbar, else the temperature of the
    shallowest level (the smaller one of a tie); with fewer than three levels there is none. It is
    known only when all levels are merged, so levels that can be the first beyond some
    temperature are kept till then. "First by depth" equals "smallest pressure".
    """
    valid = valid_pair(pres, temp, mode)
    n = states.count("pairs", valid)
    near = states.mean("near", F.when(valid & (pres <= REFERENCE_PRESSURE), temp))
    points = states.staircase("pairs", pres, temp, valid)
    reference = F.when(n >= 3, F.coalesce(near, F.array_min(points)["temp"]))
    # The reference stands in an array of one, so that it is worked out once a profile and not once a level.
    beyond = F.transform(F.array(reference), lambda known: F.array_min(F.transform(
        F.filter(points, lambda x: F.abs(x["temp"] - known) >= threshold), lambda x: x["pres"]
    )))
    return F.get(beyond, F.lit(0))


def _levels(df: DataFrame, keys: list[str], order: list[str], pres: str, temp: str) -> DataFrame:
    named = [k for k in dict.fromkeys([*keys, *order]) if k not in (pres, temp)]
    return df.where(~any_null(keys)).select(
        *named,
        nan_to_null(F.col(pres).try_cast("double")).alias(pres),
        nan_to_null(F.col(temp).try_cast("double")).alias(temp),
    )


def profile_metrics(
    df: DataFrame, keys: list[str], order: list[str], mode: str = "bgc",
    pres: str = "PRES", temp: str = "TEMP", threshold: float = MIXED_LAYER_THRESHOLD,
    hot_rows: int = LIST_ROWS,
) -> DataFrame:
    """All measures of every profile: counts, surface temperature, mixed layer, depth."""
    rows = _levels(df, keys, order, pres, temp)
    p, t = F.col(pres), F.col(temp)
    states = States(order)
    total = states.count("rows")
    valid = states.count("valid", valid_pressure(p))
    surface = surface_temp_state(states, p, t)
    low, high, mean = depth_states(states, p, mode)
    layer = layer_state(states, p, t, mode, threshold)
    return states.grouped(rows, keys, hot_rows).select(
        *keys,
        total.alias("row_count"),
        valid.alias("n_levels"),
        surface.alias("surface_temp_C"),
        layer.alias("mixed_layer_depth_m"),
        low.alias("min_DEPTH_m"),
        high.alias("max_DEPTH_m"),
        mean.alias("avg_DEPTH_m"),
    )


def surface_temperature(
    df: DataFrame, keys: list[str], pres: str = "PRES", temp: str = "TEMP"
) -> DataFrame:
    states = States([])
    surface = surface_temp_state(states, F.col(pres), F.col(temp))
    rows = df.where(~any_null(keys))
    return states.per_group(rows, keys).select(*keys, surface.alias("surface_temp_C"))


def depth_stats(
    df: DataFrame, keys: list[str], mode: str = "bgc", pres: str = "PRES"
) -> DataFrame:
    states = States([])
    low, high, mean = depth_states(states, nan_to_null(pres), mode)
    rows = df.where(~any_null(keys))
    return states.per_group(rows, keys).select(
        *keys, low.alias("min_DEPTH_m"), high.alias("max_DEPTH_m"), mean.alias("avg_DEPTH_m")
    )


def mixed_layer_depth(
    df: DataFrame, keys: list[str], order: list[str], mode: str = "bgc",
    pres: str = "PRES", temp: str = "TEMP", threshold: float = MIXED_LAYER_THRESHOLD,
    hot_rows: int = LIST_ROWS,
) -> DataFrame:
    """Mixed-layer depth of every profile, null where the threshold is never reached."""
    rows = _levels(df, keys, order, pres, temp)
    states = States(order)
    layer = layer_state(states, F.col(pres), F.col(temp), mode, threshold)
    return states.grouped(rows, keys, hot_rows).select(*keys, layer.alias("mixed_layer_depth_m"))
