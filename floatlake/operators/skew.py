"""Bringing group-level values back to the rows without hot tasks.

A plain join or a window on the group key would put a group holding a third of all
rows into one task. Here a group above ``HOT_ROWS`` rows is joined by broadcast and
its rows are spread over many tasks; all other groups are joined by a shuffle.
There can be at most (total rows / HOT_ROWS) hot groups, so the broadcast side is
bounded: 200,000 keys for a trillion rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HOT_ROWS = 5_000_000
SPREAD = 4096

_SALT = "_salt"
_HOT = "_hot"


def any_null(keys: list[str]) -> Column:
    test = F.lit(False)
    for key in keys:
        test = test | F.col(key).isNull()
    return test


def attach_groups(
    rows: DataFrame,
    groups: DataFrame,
    keys: list[str],
    values: list[str],
    size: str,
    order: list[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join of ``groups`` (one row per key) to ``rows``.

    ``size`` is the group's row count in ``groups``; ``order`` identifies a row and
    spreads hot rows the same way whenever a task is run again. Rows with a null key
    get null values and are spread too.
    """
    hot = groups.where(F.col(size) > hot_rows).select(
        *keys, *[F.col(v).alias(f"{_HOT}_{v}") for v in values], F.lit(True).alias(_HOT)
    )
    # Zero, but not as a literal: a constant would be taken out of the join keys, and
    # the spread rows would then be sent to the place of their group after all.
    zero = F.pmod(F.col(size).cast("bigint"), F.lit(1).cast("bigint"))
    cold = groups.where(F.col(size) <= hot_rows).select(
        *keys, *[F.col(v).alias(f"_cold_{v}") for v in values], zero.alias(_SALT)
    )
    spread = F.pmod(F.xxhash64(*order), F.lit(SPREAD).cast("bigint")) + 1
    apart = F.col(_HOT).isNotNull() | any_null(keys)
    joined = (
        rows.join(F.broadcast(hot), keys, "left")
        .withColumn(_SALT, F.when(apart, spread).otherwise(F.lit(0).cast("bigint")))
        .join(cold, [*keys, _SALT], "left")
    )
    return joined.select(
        *rows.columns,
        *[F.coalesce(F.col(f"{_HOT}_{v}"), F.col(f"_cold_{v}")).alias(v) for v in values],
    )


def attach_flag(
    rows: DataFrame, keyed: DataFrame, keys: list[str], flag: str, order: list[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Mark rows whose key occurs in ``keyed`` with a boolean, whatever the skew."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    marked = sizes.join(
        keyed.select(*keys).distinct().withColumn(flag, F.lit(True)), keys, "left"
    )
    out = attach_groups(rows, marked, keys, [flag], "_size", order, hot_rows)
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
