"""Values read out of file paths, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from floatlake.functions.text import col, strip


def basename(c: Column | str) -> Column:
    return F.regexp_extract(col(c), r"([^/\\]*)$", 1)


def float_type(c: Column | str) -> Column:
    """BCG or NON-BCG, by the (case-sensitive) folder names in the path."""
    c = col(c)
    return F.when(c.contains("BCG") & ~c.contains("Non-BCG"), F.lit("BCG")).otherwise(
        F.lit("NON-BCG")
    )


def platform_from_path(c: Column | str) -> Column:
    """Platform number: a path part of seven or more digits, else a file name part.

    File name parts may carry the prefixes BD, SD, AD and RD, which are taken out
    one after the other.
    """
    c = col(c)
    folder = F.nullif(F.regexp_extract(c, r"(?:^|/)([0-9]{7,})(?:/|$)", 1), F.lit(""))
    bare = F.transform(F.split(basename(c), "_"), _without_prefixes)
    digits = F.filter(bare, lambda part: part.rlike("^[0-9]+$"))
    return F.coalesce(folder, F.get(digits, F.lit(0)))


def _without_prefixes(part: Column) -> Column:
    for prefix in ("BD", "SD", "AD", "RD"):
        part = F.replace(part, F.lit(prefix), F.lit(""))
    return part


def float_id_from_filename(c: Column | str) -> Column:
    """File name without the _Sprof.csv ending."""
    return strip(F.replace(col(c), F.lit("_Sprof.csv"), F.lit("")))


def year_month_parts(c: Column | str) -> Column:
    """struct<year, month_name, filename> of <digits>/<month>/<file>.csv, else null."""
    c = col(c)
    pattern = r"(?:^|/)([0-9]+)/([^/]+)/([^/]+\.csv)$"
    return F.when(
        c.rlike(pattern),
        F.struct(
            F.regexp_extract(c, pattern, 1).try_cast("int").alias("year"),
            F.regexp_extract(c, pattern, 2).alias("month_name"),
            F.regexp_extract(c, pattern, 3).alias("filename"),
        ),
    )


def relative_dir(c: Column | str, root: str) -> Column:
    """Folder of the file below root, '' for files directly in it."""
    c = F.regexp_replace(F.url_decode(F.replace(col(c), F.lit("+"), F.lit("%2B"))), r"^file:/*", "/")
    base = root.rstrip("/").replace("file://", "")
    folder = F.regexp_replace(c, r"/?[^/]*$", "")
    return F.when(
        folder.startswith(base), F.regexp_replace(F.substring(folder, len(base) + 1, 1 << 20), "^/", "")
    ).otherwise(folder)
