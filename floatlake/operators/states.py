"""Mergeable aggregate states.

Every summary is a set of counts, sums, extremes and "first non-null" values. Kept
as states they can be computed per fine group and merged per coarse group, so only
the first step touches the rows, with map-side partial aggregation at both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WHOLE = ("tinyint", "smallint", "int", "bigint")

#: Rows of a group that one list gathers at most.
LIST_ROWS = 1 << 20
CHUNK = "_chunk"
#: Points of a staircase that are thinned together.
SLICE = 512
#: Parts that the fine groups of a coarse group are dealt to.
SLICES = 4096
#: Hash of a group's keys.
PLACE = "_place"


def records(points: Column) -> Column:
    """Of points sorted by pressure, those with a new lowest or highest temperature.

    The first point by pressure whose temperature is beyond any bound is among them, whatever
    the bound, so the bound can be learnt later.
    """
    start = F.struct(
        F.lit(float("inf")).alias("low"), F.lit(float("-inf")).alias("high"), F.slice(points, 1, 0).alias("kept"),
    )

    def step(state: Column, point: Column) -> Column:
        temp = point["temp"]
        return F.when((temp < state["low"]) | (temp > state["high"]), F.struct(
            F.least(state["low"], temp).alias("low"), F.greatest(state["high"], temp).alias("high"),
            F.concat(state["kept"], F.array(point)).alias("kept"),
        )).otherwise(state)

    return F.aggregate(points, start, step, lambda state: state["kept"])


def thinned(points: Column) -> Column:
    """Long lists of points without those that are no records among their SLICE neighbours by pressure."""
    def by_slices(ordered: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(ordered) - 1) / SLICE).cast("int"))
        return F.flatten(F.transform(starts, lambda i: records(F.slice(ordered, i * SLICE + 1, F.lit(SLICE)))))

    once = F.transform(F.array(F.array_sort(points)), by_slices)
    # The list is a variable of the outer step, so that it is sorted once and not once a slice.
    twice = F.transform(once, lambda kept: F.when(F.size(kept) <= SLICE, kept).otherwise(by_slices(kept)))
    return F.when(F.size(points) <= SLICE, points).otherwise(F.get(twice, F.lit(0)))


def gathered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows with those of a group beside each other; Spark cuts large groups into several tasks.

    Rows are sent by a hash that is no key itself, so an aggregation by the keys still has an exchange of its own.
    """
    return rows.withColumn(PLACE, F.xxhash64(*keys)).hint("rebalance", PLACE).drop(PLACE)


def is_row_number(df: DataFrame, order: list[str]) -> bool:
    """One whole number gives the row order."""
    return len(order) == 1 and dict(df.dtypes)[order[0]] in WHOLE


class States:
    """Collects states for rows ordered by ``order``.

    With ``numbered`` the order is one whole number. First values of numbers then
    aggregate by hashing; an order of several columns, or a text value, makes Spark
    sort instead, which costs a few times more. ``mergeable`` keeps what ``merged``
    needs beside the first values. A state is named by what it holds, so states written by one run
    can be merged with those of another; two collections in one table take a ``prefix`` each.
    """

    def __init__(self, order: list[str], numbered: bool = False, mergeable: bool = False, prefix: str = "state"):
        self._order = order
        self._prefix = prefix
        self._numbered = numbered
        self._mergeable = mergeable
        self._partials: list[Column] = []
        self._merges: list[Column] = []
        self._known: dict[str, str] = {}
        self._lists: list[str] = []

    def _add(self, label: str, partial: Column, merge) -> str:
        name = self._known.get(label)
        if name is None:
            name = f"{self._prefix}:{label}"
            self._known[label] = name
            self._partials.append(partial.alias(name))
            self._merges.append(merge(F.col(name)).alias(name))
        return name

    def count(self, label: str, condition: Column | None = None) -> Column:
        partial = F.count(F.lit(1)) if condition is None else F.count_if(condition)
        return F.col(self._add(f"n:{label}", partial, F.sum))

    def sum(self, label: str, value: Column) -> Column:
        return F.col(self._add(f"sum:{label}", F.sum(value), F.sum))

    def mean(self, label: str, value: Column) -> Column:
        total = self.sum(label, value.cast("double"))
        n = F.col(self._add(f"cnt:{label}", F.count(value), F.sum))
        return F.when(n > 0, total / n)

    def min(self, label: str, value: Column) -> Column:
        return F.col(self._add(f"min:{label}", F.min(value), F.min))

    def max(self, label: str, value: Column) -> Column:
        return F.col(self._add(f"max:{label}", F.max(value), F.max))

    def first(self, label: str, value: Column) -> Column:
        """First non-null value by row order."""
        if self._numbered:
            position = F.when(value.isNotNull(), F.col(self._order[0]))
            merge = F.min
            if self._mergeable:
                at = self._add(f"at:{label}", F.min(position), F.min)
                merge = lambda state: F.min_by(state, F.col(at))
            return F.col(self._add(f"first:{label}", F.min_by(value, position), merge))
        tagged = F.struct(*[F.col(o) for o in self._order], value.alias("_value"))
        partial = F.min(F.when(value.isNotNull(), tagged))
        return F.col(self._add(f"first:{label}", partial, F.min))["_value"]

    def staircase(self, label: str, pres: Column, temp: Column, where: Column) -> Column:
        """Points (`pres`, `temp`) that can be the first beyond some temperature; all, of few points."""
        point = F.struct(pres.alias("pres"), temp.alias("temp"))
        partial = F.collect_list(F.when(where, point))
        name = self._add(f"stairs:{label}", partial, lambda state: F.flatten(F.collect_list(state)))
        if name not in self._lists:
            self._lists.append(name)
        return F.col(name)

    def _thin(self, groups: DataFrame) -> DataFrame:
        if not self._lists:
            return groups
        return groups.withColumns({name: thinned(F.col(name)) for name in self._lists})

    def per_group(self, rows: DataFrame, keys: list[str], *beside: Column) -> DataFrame:
        """States per group, with plain aggregates beside them if wanted."""
        return self._thin(rows.groupBy(*keys).agg(*self._partials, *beside))

    def merged(self, fine: DataFrame, keys: list[str], *beside: Column) -> DataFrame:
        """States of fine groups merged to coarser ones."""
        return self._thin(fine.groupBy(*keys).agg(*self._merges, *beside))

    def grouped(self, rows: DataFrame, keys: list[str], hot_rows: int = LIST_ROWS) -> DataFrame:
        """States per group, whatever its size."""
        if not self._lists:
            return self.per_group(rows, keys)
        return self.merged(self.in_chunks(rows, keys, hot_rows), keys)

    def in_slices(self, fine: DataFrame, fine_keys: list[str], keys: list[str]) -> DataFrame:
        """States of fine groups merged to coarser ones, by way of slices of these: lists stay short."""
        if not self._lists:
            return self.merged(fine, keys)
        part = F.pmod(F.xxhash64(*fine_keys), F.lit(SLICES))
        return self.merged(self.merged(fine.withColumn(CHUNK, part), [*keys, CHUNK]), keys)

    def in_chunks(self, rows: DataFrame, keys: list[str], hot_rows: int = LIST_ROWS, *beside: Column) -> DataFrame:
        """States per group and stretch of rows, for a merge that follows: no list holds a whole large group.

        Rows of a partition are numbered one after the other, so few small groups are cut. Spark sorts
        what it can't gather by hashing: a hash of the keys leads, so that one number settles nearly every comparison.
        """
        chunk = F.shiftright(F.monotonically_increasing_id(), hot_rows.bit_length() - 1)
        placed = rows.withColumn(CHUNK, chunk).withColumn(PLACE, F.xxhash64(*keys))
        return self.per_group(placed, [PLACE, *keys, CHUNK], *beside).drop(PLACE)
