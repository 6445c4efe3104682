"""Predicates and derived quantities of single levels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from floatlake.catalog import PRESSURE_FILL, PRESSURE_FLOOR
from floatlake.functions.text import col, is_finite


def valid_pressure(c: Column | str) -> Column:
    """A real pressure: present, finite, not the fill value, above the floor."""
    c = col(c)
    return is_finite(c) & (c != F.lit(PRESSURE_FILL)) & (c > F.lit(PRESSURE_FLOOR))


def pressure_to_depth(c: Column | str) -> Column:
    """Depth in metres; one decibar is taken as one metre."""
    return col(c)


def valid_pair(pres: Column | str, temp: Column | str, mode: str) -> Column:
    """Level usable for the mixed layer: both values finite; bgc also needs PRES >= 0."""
    pres, temp = col(pres), col(temp)
    both = is_finite(pres) & is_finite(temp)
    return both & (pres >= 0) if mode == "bgc" else both
