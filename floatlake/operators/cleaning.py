"""Cleaning of all-text tables read from CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from floatlake.catalog import find_column
from floatlake.functions.dates import split_datetime
from floatlake.functions.text import clean_bytes, null_tokens, strip

DATETIME_COLUMNS = ["JULD", "JULD_LOCATION"]


def _filled(name: str):
    return F.max(strip(null_tokens(name)) != "")


def filled_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns holding any text, from one aggregate row over all columns."""
    if not columns:
        return []
    row = df.agg(*[_filled(name).alias(name) for name in columns]).first()
    return [name for name in columns if row[name]]


def drop_null_columns(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Drop columns in which every value is null or blank; ``keep`` are never dropped.

    Runs on the raw text: a column of b'' values still counts as filled.
    """
    keep = keep or []
    text = [name for name, dtype in df.dtypes if dtype == "string" and name not in keep]
    survivors = {*filled_columns(df, text)}
    return df.select(*[c for c in df.columns if c not in text or c in survivors])


def split_datetime_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace each date-time column by <name>_DATE and <name>_TIME at the end."""
    for wanted in columns or DATETIME_COLUMNS:
        name = find_column(df.columns, wanted)
        if name is not None:
            date, time = split_datetime(name)
            df = df.withColumns({f"{name}_DATE": date, f"{name}_TIME": time}).drop(name)
    return df


def keep_first_of_duplicates(df: DataFrame) -> DataFrame:
    """Keep the first of equally named columns."""
    seen, picked = set(), []
    for position, name in enumerate(df.columns):
        if name.upper() not in seen:
            seen.add(name.upper())
            picked.append(position)
    if len(picked) == len(df.columns):
        return df
    numbered = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"_c{i}").alias(df.columns[i]) for i in picked])


def clean_text_columns(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Null tokens and blank text to null, byte-string wrappers off, in text columns."""
    keep = keep or []

    def cleaned(name: str):
        return F.when(strip(name) != "", clean_bytes(null_tokens(name)))

    return df.withColumns({
        name: cleaned(name)
        for name, dtype in df.dtypes if dtype == "string" and name not in keep
    })


def clean_table(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """All cleaning steps: drop empty columns, clean the text, split date-times."""
    keep = keep or []
    kept = drop_null_columns(keep_first_of_duplicates(df), keep)
    return split_datetime_columns(clean_text_columns(kept, keep))
