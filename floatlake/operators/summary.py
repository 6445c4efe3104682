"""Profile summaries: one row per profile group, with a fixed schema.

Two rule sets exist. ``summarize_bgc`` (biogeochemical floats) averages numeric
columns and keeps the first text. ``summarize_core`` (core floats) chooses per
column between first value, range and mean, and groups by level count and date.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from floatlake.catalog import (
    CORE_SKIPPED, FIRST_VALUE_COLUMNS, MIXED_LAYER_THRESHOLD, find_column,
)
from floatlake.functions.dates import compact_date, juld_to_timestamp, time_of_day
from floatlake.functions.geo import assign_ocean, assign_region
from floatlake.functions.measures import valid_pressure
from floatlake.functions.text import clean_bytes, nan_to_null, strip, to_number, unwrapped
from floatlake.operators.profile import (
    depth_states, layer_state, n_levels_keys, surface_temp_state, with_n_levels,
)
from floatlake.operators.skew import any_null
from floatlake.operators.states import LIST_ROWS, WHOLE, States, gathered, is_row_number

#: Name of the mixed layer beside states.
LAYER = "_layer"
#: Before the name of a column, its clean text beside it.
TEXT = "_text:"
#: Text columns that hold compact dates.
COMPACT = ("DATE_CREATION", "DATE_UPDATE")

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
_FRACTIONAL = ("float", "double")


def _is_numeric(dtype: str) -> bool:
    return dtype.startswith(_NUMERIC)


def _present(df: DataFrame) -> DataFrame:
    """NaN is a missing value everywhere, as in the data's own tools."""
    return df.withColumns(
        {name: nan_to_null(name) for name, dtype in df.dtypes if dtype in _FRACTIONAL}
    )


def _with_texts(df: DataFrame, names: list[str], compact: tuple[str, ...] = ()) -> DataFrame:
    """Clean text beside the text columns.

    In steps, so that each is worked out once a row, however often the next one and the states look at it.
    """
    df = df.withColumns({f"{TEXT}{name}": strip(name) for name in names})
    df = df.withColumns({f"{TEXT}{name}": unwrapped(F.col(f"{TEXT}{name}")) for name in names})
    return df.withColumns({f"{TEXT}{name}": compact_date(f"{TEXT}{name}") for name in names if name.upper() in compact})


def grouping_columns(columns: list[str]) -> list[str]:
    """Keys of the bgc summary found among the columns.

    The first column naming a platform, FLOAT_SERIAL_NO, the first column naming a
    cycle, n_levels and JULD, each only if there.
    """
    def containing(term: str) -> str | None:
        return next((c for c in columns if term in c.lower()), None)

    found = [
        containing("platform"), find_column(columns, "FLOAT_SERIAL_NO"),
        containing("cycle"), find_column(columns, "n_levels"), find_column(columns, "JULD"),
    ]
    keys = list(dict.fromkeys(name for name in found if name is not None))
    if not keys:
        raise ValueError("no grouping columns found")
    return keys


def core_grouping_columns(columns: list[str]) -> list[str]:
    """Keys of the core summary: platform, serial number, level count and date."""
    found = [
        find_column(columns, name)
        for name in ("PLATFORM_NUMBER", "FLOAT_SERIAL_NO", "n_levels", "DATE")
    ]
    if found[0] is None:
        raise ValueError("PLATFORM_NUMBER is needed for a core summary")
    return [name for name in found if name is not None]


def prepare_bgc(df: DataFrame) -> DataFrame:
    """JULD as a date and JULD_LOCATION as a time of day, each if there."""
    return _with_times(df, {
        "JULD": lambda name, ts: {name: F.to_date(ts)},
        "JULD_LOCATION": lambda name, ts: {name: time_of_day(ts)},
    })


def prepare_core(df: DataFrame) -> DataFrame:
    """JULD and JULD_LOCATION as timestamps, with JULD_LOCATION_time added."""
    return _with_times(df, {
        "JULD": lambda name, ts: {name: ts},
        "JULD_LOCATION": lambda name, ts: {name: ts, f"{name}_time": time_of_day(ts)},
    })


def _with_times(df: DataFrame, makers) -> DataFrame:
    types, new = dict(df.dtypes), {}
    for wanted, make in makers.items():
        name = find_column(df.columns, wanted)
        if name is not None:
            new.update(make(name, juld_to_timestamp(name, types[name])))
    return df.withColumns(new) if new else df


def infer_column_kinds(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """"mean", "first" or "mixed" for text columns, from one aggregate row.

    A column without any number keeps its first text, one with only numbers is
    averaged, and a mixed one gets the mean as text where a group has numbers.
    """
    if not columns:
        return {}
    tests = []
    for name in columns:
        text = clean_bytes(name)
        tests.append(F.count(text).alias(f"{name}_n"))
        tests.append(F.count(to_number(text)).alias(f"{name}_num"))
    counts = df.agg(*tests).first()
    kinds = {}
    for name in columns:
        n, numbers = counts[f"{name}_n"], counts[f"{name}_num"]
        kinds[name] = "first" if numbers == 0 else "mean" if numbers == n else "mixed"
    return kinds


def column_rules(df: DataFrame, keys: list[str], infer: bool = False) -> dict[str, str]:
    """Rule per non-key column: identifiers first, numbers mean, text both.

    Rules come from names and types, so the summaries of all runs have one schema. Only
    with ``infer`` is the content of text columns looked at (one scan).
    """
    rules, open_columns = {}, []
    for name, dtype in df.dtypes:
        if name in keys:
            continue
        if name.upper() in FIRST_VALUE_COLUMNS:
            rules[name] = "first"
        elif _is_numeric(dtype):
            rules[name] = "mean"
        elif dtype == "string" and infer:
            open_columns.append(name)
        elif dtype == "string":
            rules[name] = "both"
        else:
            rules[name] = "first"
    rules.update(infer_column_kinds(df, open_columns))
    return rules


def _bgc_value(states: States, name: str, dtype: str, rule: str) -> dict[str, Column]:
    """Output columns of one input column."""
    value = F.col(f"{TEXT}{name}" if dtype == "string" else name)
    if rule == "first":
        return {name: states.first(name, value)}
    number = to_number(value) if dtype == "string" else value
    mean = states.mean(name, number)
    if rule == "mean":
        return {name: mean}
    if rule == "both":
        return {name: states.first(name, value), f"{name}_mean": mean}
    return {name: F.coalesce(mean.cast("string"), states.first(name, value))}


def _bgc_keys(names: list[str], pres: str | None) -> tuple[list[str], bool]:
    """Keys of the bgc summary, and whether its groups are exactly the counted profiles.

    Then the level count is one more aggregate of the group; otherwise it has to be
    put on the rows before they are grouped.
    """
    platform, cycle = find_column(names, "PLATFORM_NUMBER"), find_column(names, "CYCLE_NUMBER")
    if find_column(names, "n_levels") is not None or None in (platform, cycle, pres):
        return grouping_columns(names), False
    keys = grouping_columns([*names, "n_levels"])
    return keys, set(n_levels_keys(names)) <= set(keys)


def _points(rows: DataFrame, keys: list[str], pres: str, temp: str) -> DataFrame:
    """What the mixed layer needs of the levels.

    It is aggregated by itself: its lists would put the many states of a summary through a slower
    kind of aggregation, which costs more than a second look at these few columns.
    """
    return rows.select(*dict.fromkeys([*keys, pres, temp]))


def summarize_bgc(
    df: DataFrame,
    order: list[str],
    rules: dict[str, str] | None = None,
    columns: list[str] | None = None,
    partition_columns: list[str] | None = None,
    threshold: float = MIXED_LAYER_THRESHOLD,
    hot_rows: int = LIST_ROWS,
) -> DataFrame:
    """Summary of biogeochemical profiles.

    ``order`` are the columns giving the row order inside a profile; one whole number
    is the fastest. ``partition_columns`` (such as the file) are extra keys. ``rules``
    maps a column to "mean", "first", "mixed" or "both"; when left out, names and types
    decide (column_rules): a text column X then gives its first text as X and the mean of
    its numbers as X_mean. ``columns`` limits which other columns are summarised.
    Every column keeps its own name. The position used for the labels is the first
    latitude and the first longitude, also given as first_LATITUDE / first_LONGITUDE.
    """
    names = df.columns
    pres, temp = find_column(names, "PRES"), find_column(names, "TEMP")
    lat, lon = find_column(names, "LATITUDE"), find_column(names, "LONGITUDE")
    df = _present(df)

    keys, counting_inside = _bgc_keys(names, pres)
    if "n_levels" in keys and not counting_inside and find_column(names, "n_levels") is None:
        df = with_n_levels(df, n_levels_keys(names), order, pres)
    keys = list(dict.fromkeys([*(partition_columns or []), *keys]))
    row_keys = [k for k in keys if not (counting_inside and k == "n_levels")]

    others = [
        c for c in (columns or names)
        if c not in keys and (columns is not None or c not in order)
    ]
    if rules is None:
        rules = column_rules(df.select(*dict.fromkeys([*row_keys, *others])), row_keys)
    types = dict(df.dtypes)
    rows = _with_texts(df.where(~any_null(row_keys)), [c for c in others if types[c] == "string"])

    states = States(order, is_row_number(rows, order))
    p = F.col(pres).try_cast("double") if pres else F.lit(None).cast("double")
    t = F.col(temp).try_cast("double") if temp else F.lit(None).cast("double")
    states.count("rows")
    out = list(row_keys)
    if counting_inside:
        out.insert(keys.index("n_levels"), states.count("valid", valid_pressure(p)).alias("n_levels"))
    low, high, mean = depth_states(states, p, "bgc")
    out += [
        surface_temp_state(states, p, t).alias("surface_temp_C"),
        low.alias("min_DEPTH_m"), high.alias("max_DEPTH_m"), mean.alias("avg_DEPTH_m"),
    ]
    if lat and lon:
        first_lat, first_lon = states.first(lat, F.col(lat)), states.first(lon, F.col(lon))
    else:
        first_lat = first_lon = F.lit(None).cast("double")
    out += [first_lat.alias("first_LATITUDE"), first_lon.alias("first_LONGITUDE")]
    values: dict[str, Column] = {}
    for name in others:
        values.update(_bgc_value(states, name, types[name], rules.get(name, "first")))
    out += [value.alias(name) for name, value in values.items()]
    # The labels are set after the aggregation: once per profile, not once per level.
    summary = states.per_group(rows, row_keys).select(*out).withColumns({
        "avg_REGION": assign_region("first_LATITUDE", "first_LONGITUDE", "closed"),
        "ocean": assign_ocean("first_LATITUDE", "first_LONGITUDE", "boxes"),
    })
    if pres is None or temp is None:
        summary = summary.withColumn("mixed_layer_depth_m", F.lit(None).cast("double"))
    else:
        points = States([], prefix="points")
        layer = layer_state(points, p, t, "bgc", threshold).alias("mixed_layer_depth_m")
        layers = points.grouped(_points(rows, row_keys, pres, temp), row_keys, hot_rows)
        summary = summary.join(layers.select(*row_keys, layer), row_keys, "left")
    measures = ["surface_temp_C", "mixed_layer_depth_m", "min_DEPTH_m", "max_DEPTH_m",
                "avg_DEPTH_m", "avg_REGION", "ocean", "first_LATITUDE", "first_LONGITUDE"]
    return summary.select(*keys, *measures, *values)


def _core_value(states: States, name: str, dtype: str) -> dict[str, Column]:
    """Output columns of one input column; unused parts of a rule are null."""
    upper = name.upper()
    if not _is_numeric(dtype):
        return {name: states.first(name, F.col(f"{TEXT}{name}" if dtype == "string" else name))}
    value = F.col(name)
    if upper == "PRES":
        return {name: states.mean(name, value)}
    spread = upper.endswith("_ERROR") or upper in ("JULD_LOCATION_MIN", "JULD_LOCATION_MAX")
    ranged = upper.startswith("HISTORY_") and "PRES" in upper
    if not spread and not ranged:
        return {name: states.first(name, value)}
    low, high = states.min(name, value), states.max(name, value)
    constant, varying = low == high, low != high
    if upper.endswith("_ERROR"):
        return {
            name: F.when(constant, low),
            f"{name}_min": F.when(varying, low),
            f"{name}_max": F.when(varying, high),
            f"{name}_mean": F.when(varying, states.mean(name, value)),
        }
    if spread:
        return {
            name: F.when(constant, low),
            f"{name}_min": low,
            f"{name}_max": high,
            f"{name}_mean": F.when(varying, states.mean(name, value)),
        }
    return {
        name: F.when(constant, low),
        f"{name}_min": F.when(varying, low),
        f"{name}_max": F.when(varying, high),
    }


class CoreSummary:
    """Summary of core profiles with some columns, in steps that can be taken at different times.

    ``profiles`` aggregates level rows to one row of states per profile. ``merged`` brings the
    states of one profile from several runs together, and ``summary`` merges profiles to groups.
    """

    def __init__(
        self, types: dict[str, str], order: list[str], columns: list[str] | None = None,
        default_date: str | None = None, partition_columns: list[str] | None = None,
        threshold: float = MIXED_LAYER_THRESHOLD, hot_rows: int = LIST_ROWS,
    ):
        names = list(types)
        self.pres, self.temp = find_column(names, "PRES"), find_column(names, "TEMP")
        self.juld, self.default_date, self.hot_rows = find_column(names, "JULD"), default_date, hot_rows
        extra = partition_columns or []
        has_date = self.juld is not None or default_date is not None
        platform, cycle = find_column(names, "PLATFORM_NUMBER"), find_column(names, "CYCLE_NUMBER")
        self.counted = None not in (platform, cycle, self.pres)
        keys = core_grouping_columns(
            [*names, *(["n_levels"] if self.counted else []), *(["DATE"] if has_date else [])]
        )
        row_keys = [k for k in keys if k != "n_levels"]
        # Levels are counted per profile, and the count is a key of the groups.
        self.profile_keys = list(dict.fromkeys([*extra, *row_keys, *(n_levels_keys(names) if self.counted else [])]))
        self.keys = [*extra, *keys]

        skipped = {*keys, *extra}
        others = [
            c for c in (columns or names)
            if c not in skipped and c.upper() not in CORE_SKIPPED
            and (columns is not None or c not in order)
        ]
        numbered = len(order) == 1 and types[order[0]] in WHOLE
        self.states = States(order, numbered, mergeable=self.counted)
        self.points = States([], prefix="points")
        p = F.col(self.pres).try_cast("double") if self.pres else F.lit(None).cast("double")
        t = F.col(self.temp).try_cast("double") if self.temp else F.lit(None).cast("double")
        self.layered = self.pres is not None and self.temp is not None
        self.layer = layer_state(self.points, p, t, "core", threshold) if self.layered else F.lit(None).cast("double")
        self.n_levels = F.count_if(valid_pressure(p)).alias("n_levels")
        self.row_count = self.states.count("rows")
        self.values: dict[str, Column] = {
            "row_count": self.row_count,
            "surface_temp_avg_C": surface_temp_state(self.states, p, t),
        }
        low, high, mean = depth_states(self.states, p, "core")
        self.values.update({"min_DEPTH_m": low, "max_DEPTH_m": high, "avg_DEPTH_m": mean})
        self.texts = [name for name in others if types[name] == "string"]
        for name in others:
            self.values.update(_core_value(self.states, name, types[name]))

    def _rows(self, df: DataFrame) -> DataFrame:
        df = _present(df)
        df = _with_texts(df, self.texts, COMPACT)
        if self.juld is not None:
            df = df.withColumn("DATE", F.to_date(self.juld))
        elif self.default_date is not None:
            df = df.withColumn("DATE", F.lit(self.default_date).cast("date"))
        return df.where(~any_null(self.profile_keys))

    def _lists(self, rows: DataFrame) -> DataFrame:
        """Level counts and points of every profile.

        Points are gathered by profile first: where its levels lie all over the input, lists of one or two points
        would be made, sent and merged twice.
        """
        levels = gathered(_points(rows, self.profile_keys, self.pres, self.temp), self.profile_keys)
        lists = self.points.in_chunks(levels, self.profile_keys, self.hot_rows, self.n_levels)
        return self.points.merged(lists, self.profile_keys, F.sum("n_levels").alias("n_levels"))

    def profiles(self, df: DataFrame) -> DataFrame:
        """All states of every profile, with its level count if levels can be counted."""
        rows = self._rows(df)
        profiles = self.states.per_group(rows, self.profile_keys, *([self.n_levels] if self.counted else []))
        if not self.layered:
            return profiles
        if self.counted:
            return profiles.join(self._lists(rows).drop("n_levels"), self.profile_keys)
        return profiles.join(self.points.grouped(_points(rows, self.profile_keys, self.pres, self.temp), self.profile_keys, self.hot_rows), self.profile_keys)

    def merged(self, parts: DataFrame) -> DataFrame:
        """Profiles whose levels came with several runs, from the states of each."""
        count = [F.sum("n_levels").alias("n_levels")] if self.counted else []
        whole = self.states.merged(parts, self.profile_keys, *count)
        return whole.join(self.points.merged(parts, self.profile_keys), self.profile_keys) if self.layered else whole

    def summary(self, profiles: DataFrame, lists: DataFrame | None = None) -> DataFrame:
        """Groups of the profiles; ``lists`` may hold the points apart."""
        layer = self.layer
        if not self.counted:
            groups = profiles
        else:
            groups = self.states.merged(profiles, self.keys)
            if self.layered:
                points = self.points.in_slices(profiles if lists is None else lists, self.profile_keys, self.keys)
                groups, layer = groups.join(points.select(*self.keys, layer.alias(LAYER)), self.keys), F.col(LAYER)
        head = [*self.keys, *([] if self.counted else ["n_levels"]), "row_count",
                "surface_temp_avg_C", "mixed_layer_depth_m"]
        return groups.select(
            *self.keys,
            *([] if self.counted else [self.row_count.alias("n_levels")]),
            layer.alias("mixed_layer_depth_m"),
            *[value.alias(name) for name, value in self.values.items()],
        ).select(*head, *[name for name in self.values if name not in head])

    def of_levels(self, df: DataFrame) -> DataFrame:
        """Summary straight from level rows: nothing is joined before the groups."""
        if not (self.counted and self.layered):
            return self.summary(self.profiles(df))
        rows = self._rows(df)
        return self.summary(self.states.per_group(rows, self.profile_keys, self.n_levels), self._lists(rows))


def summarize_core(
    df: DataFrame,
    order: list[str],
    columns: list[str] | None = None,
    default_date: str | None = None,
    partition_columns: list[str] | None = None,
    threshold: float = MIXED_LAYER_THRESHOLD,
    hot_rows: int = LIST_ROWS,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Summary of core profiles.

    Levels are counted per platform, cycle, serial number and full JULD, while the
    summary groups by platform, serial number, level count and date. The rows are
    therefore aggregated to profiles once, and the profile states are merged to
    groups, which is a far smaller second step.

    ``default_date`` dates the rows when the input has no JULD column.
    ``partition_columns`` (such as year and month) are extra keys: each partition is
    summarised by itself. ``keep`` writes the profile states (one row per profile) and reads
    them back, so that the groups come from what was written.
    """
    plan = CoreSummary(dict(df.dtypes), order, columns, default_date, partition_columns, threshold, hot_rows)
    return plan.of_levels(df) if keep is None else plan.summary(keep(plan.profiles(df)))
