"""Nested profiles to level rows.

Input is one row per profile: level variables are arrays, parameter, calibration and
history variables are (nested) arrays, all others plain columns. An array never
leaves its row, so flattening is narrow: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from floatlake.functions.dates import juld_to_timestamp
from floatlake.functions.text import col, decode_text, join_chars, strip


def first_of(c: Column | str, is_text: bool = False) -> Column:
    """First element; '' (text) or null (numbers) when there is none."""
    value = F.get(col(c), F.lit(0))
    return strip(F.coalesce(value, F.lit(""))) if is_text else value


def first_of_first(c: Column | str, is_text: bool = False) -> Column:
    """First parameter of the first calibration."""
    value = F.get(F.get(col(c), F.lit(0)), F.lit(0))
    return strip(F.coalesce(value, F.lit(""))) if is_text else value


def last_of(c: Column | str, is_text: bool = False) -> Column:
    """Last history entry; '' (text) or null (numbers) when there is none."""
    value = F.try_element_at(col(c), F.lit(-1))
    return strip(F.coalesce(value, F.lit(""))) if is_text else value


def first_element(c: Column | str, dtype: T.DataType) -> Column:
    """First element of arrays nested to any depth, in storage order."""
    value = col(c)
    while isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.ArrayType):
        value, dtype = F.flatten(value), dtype.elementType
    return F.get(value, F.lit(0))


def _base(dtype: T.DataType) -> T.DataType:
    while isinstance(dtype, T.ArrayType):
        dtype = dtype.elementType
    return dtype


def classify(schema: T.StructType, dims: dict[str, str] | None = None) -> dict[str, str]:
    """Role per column: profile, level, param, calib, history, chars, other or skip.

    Dimensions are not part of a Spark schema, so arrays can be named in ``dims``.
    Unnamed arrays follow the data's naming: HISTORY_* are histories, PARAMETER* and
    STATION_PARAMETERS are per parameter, nested arrays per calibration and the rest
    are level variables. Maps and structs are skipped.
    """
    roles = {}
    for field in schema.fields:
        dtype, name = field.dataType, field.name
        if dims and name in dims:
            roles[name] = dims[name]
        elif isinstance(dtype, (T.MapType, T.StructType)):
            roles[name] = "skip"
        elif not isinstance(dtype, T.ArrayType):
            roles[name] = "profile"
        elif isinstance(dtype.elementType, T.ArrayType):
            deep = isinstance(dtype.elementType.elementType, T.ArrayType)
            roles[name] = "other" if deep else "calib"
        elif name.upper().startswith("HISTORY_"):
            roles[name] = "history"
        elif name.upper().startswith(("PARAMETER", "STATION_PARAMETERS")):
            roles[name] = "param"
        else:
            roles[name] = "level"
    return roles


def skipped_variables(schema: T.StructType, dims: dict[str, str] | None = None) -> list[str]:
    """Variables flattening leaves out."""
    return [name for name, role in classify(schema, dims).items() if role == "skip"]


def profile_values(df: DataFrame, roles: dict[str, str]) -> dict[str, Column]:
    """One plain value per profile for every variable that is not a level variable."""
    values = {}
    for field in df.schema.fields:
        name, dtype, role = field.name, field.dataType, roles[field.name]
        is_text = isinstance(_base(dtype), T.StringType)
        if role == "profile":
            binary = isinstance(dtype, T.BinaryType)
            values[name] = decode_text(name) if binary else F.col(name)
        elif role == "param":
            values[name] = first_of(name, is_text)
        elif role == "calib":
            values[name] = first_of_first(name, is_text)
        elif role == "history":
            values[name] = last_of(name, is_text)
        elif role == "chars":
            values[name] = join_chars(name, isinstance(_base(dtype), T.BinaryType))
        elif role == "other":
            values[name] = first_element(name, dtype)
    return values


def _filled(df: DataFrame, name: str) -> Column:
    """The array, empty where a profile has none: the levels of its other variables count."""
    return F.coalesce(F.col(name), F.array().cast(df.schema[name].dataType))


def flatten_profiles(
    df: DataFrame,
    id_columns: list[str],
    dims: dict[str, str] | None = None,
    scalars: dict[str, object] | None = None,
    convert_juld: bool = False,
) -> DataFrame:
    """One row per profile and level.

    ``id_columns`` identify the profile and come first, followed by ``level_idx``;
    together they are the row order. The other columns are sorted by name inside the
    blocks profile, level, scalar. Arrays of unequal length are filled with nulls.
    ``scalars`` are values of the whole set, repeated on every row. With
    ``convert_juld`` JULD and JULD_LOCATION become timestamps.
    """
    roles = classify(df.schema, dims)
    single = {k: v for k, v in profile_values(df, roles).items() if k not in id_columns}
    levels = sorted(name for name, role in roles.items() if role == "level")
    if not levels:
        raise ValueError("no level variable to flatten")
    if convert_juld:
        types = dict(df.dtypes)
        for name in ("JULD", "JULD_LOCATION"):
            if name in single:
                single[name] = juld_to_timestamp(name, types[name])
    exploded = df.select(
        *id_columns,
        *[single[name].alias(name) for name in sorted(single)],
        F.posexplode(F.arrays_zip(*[_filled(df, name).alias(name) for name in levels])).alias("level_idx", "_level"),
    )
    return exploded.select(
        *id_columns,
        "level_idx",
        *sorted(single),
        *[F.col("_level")[name].alias(name) for name in levels],
        *[F.lit(value).alias(name) for name, value in sorted((scalars or {}).items())],
    )
