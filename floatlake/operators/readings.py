"""Long readings, float metadata, upsert, and queries on the loaded tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from floatlake.catalog import find_column
from floatlake.functions.dates import reading_date, reading_time
from floatlake.functions.paths import float_id_from_filename, float_type
from floatlake.functions.text import reading_value, strip
from floatlake.operators.skew import HOT_ROWS, attach_flag, attach_groups

FILE_COLUMNS = ["path", "filename"]


def resolve_float_id(
    df: DataFrame, order: list[str], mode: str = "row", filename: str = "filename",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``float_id``: the platform number, else the file name without _Sprof.csv.

    ``row`` uses each row's own platform number, ``file`` the one of the file's first
    row for the whole file.
    """
    platform = find_column(df.columns, "PLATFORM_NUMBER")
    fallback = float_id_from_filename(filename)
    if platform is None:
        return df.withColumn("float_id", fallback)
    if mode == "row":
        return df.withColumn("float_id", F.coalesce(strip(reading_value(platform)), fallback))
    if mode != "file":
        raise ValueError(f"mode must be 'row' or 'file', not {mode!r}")
    # min_by keeps a null of the first row, which then falls back to the file name.
    files = df.groupBy(filename).agg(
        F.min_by(strip(reading_value(platform)), F.struct(*order)).alias("_first_id"),
        F.count(F.lit(1)).alias("_size"),
    )
    out = attach_groups(df, files, [filename], ["_first_id"], "_size", order, hot_rows)
    return out.withColumn("float_id", F.coalesce("_first_id", fallback)).drop("_first_id")


def _date_texts(df: DataFrame) -> tuple[Column, Column]:
    """Date and time text of a row: the JULD pair if the table has it, else JULD_LOCATION.

    A ``_columns`` array (the header of the row's own file, set by the mixed CSV
    reader) decides per file.
    """
    def pair(prefix: str):
        date, time = (find_column(df.columns, f"{prefix}_{part}") for part in ("DATE", "TIME"))
        if date is None:
            return None
        return F.col(date), F.col(time) if time else F.lit(None).cast("string")

    main, other = pair("JULD"), pair("JULD_LOCATION")
    if main is None:
        nothing = F.lit(None).cast("string")
        return other or (nothing, nothing)
    if other is None or "_columns" not in df.columns:
        return main
    own = F.array_contains("_columns", "JULD_DATE") | F.array_contains("_columns", "JULD")
    return F.when(own, main[0]).otherwise(other[0]), F.when(own, main[1]).otherwise(other[1])


def date_problem(df: DataFrame) -> Column:
    """Why the date or time of a row cannot be stored, null when it can."""
    date, time = _date_texts(df)
    clock = r"^([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?$"
    return (
        F.when(reading_value(date).isNotNull() & reading_date(date).isNull(), F.lit("date cannot be read"))
        .when(reading_time(time).isNotNull() & ~reading_time(time).rlike(clock), F.lit("time cannot be read"))
    )


def to_readings(
    df: DataFrame, order: list[str], columns: list[str] | None = None,
    id_column: str = "float_id", carry: list[str] | None = None,
) -> DataFrame:
    """One row per non-null cell: float, parameter name, value, date and time.

    Key and date columns are emitted as parameters too. The unpivot is narrow: rows
    are multiplied in place and empty cells are dropped before anything moves. ``id``
    is a hash of the row order and the parameter, the same on every run. Columns in
    ``carry`` are repeated on every reading.
    """
    carry = carry or []
    if columns is None:
        hidden = {id_column, "_columns", *FILE_COLUMNS, *order, *carry}
        columns = [n for n, t in df.dtypes if t == "string" and n not in hidden]
    date, time = (read(text) for read, text in zip((reading_date, reading_time), _date_texts(df)))
    source = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order]
    # The prefixes keep parameter columns apart from equally named fixed ones.
    fixed = ["float_id", "JULD_DATE", "JULD_TIME", "_source", *carry]
    wide = df.select(
        F.col(id_column).alias("float_id"),
        date.alias("JULD_DATE"),
        time.alias("JULD_TIME"),
        F.concat_ws("|", *source).alias("_source"),
        *carry,
        *[reading_value(c).alias(f"p_{c}") for c in columns],
    )
    long = wide.unpivot(
        fixed, [f"p_{c}" for c in columns], "parameter_name", "value"
    ).where(F.col("value").isNotNull())
    name = F.substring("parameter_name", 3, 1 << 20)
    return long.select(
        F.sha2(F.concat_ws("|", "_source", name), 256).alias("id"),
        "float_id",
        name.alias("parameter_name"),
        "value",
        "JULD_DATE",
        "JULD_TIME",
        *carry,
    )


def last_reading_date(df: DataFrame) -> Column:
    """Latest JULD date as an aggregate, else the latest JULD_LOCATION date."""
    parts = []
    for wanted in ("JULD_DATE", "JULD_LOCATION_DATE"):
        name = find_column(df.columns, wanted)
        if name is not None:
            parts.append(F.max(reading_date(name)))
    return F.coalesce(*parts) if parts else F.lit(None).cast("date")


def _filled(df: DataFrame, name: str) -> Column:
    """The column has a value here; the halves of a split date-time count together."""
    filled = F.col(name).isNotNull()
    for own, other in (("_DATE", "_TIME"), ("_TIME", "_DATE")):
        if name.upper().endswith(own):
            twin = find_column(df.columns, name[: -len(own)] + other)
            return filled | F.col(twin).isNotNull() if twin else filled
    return filled


def float_metadata(
    df: DataFrame, order: list[str], columns: list[str] | None = None,
    filename: str = "filename", path: str = "path",
) -> DataFrame:
    """One metadata row per file and float, from the float's first row in the file.

    ``df`` must carry ``float_id`` and hold cleaned text. ``all_columns`` lists the
    columns holding any value; a date and time pair is listed whole. Partial
    aggregates are combined before the shuffle.
    """
    if columns is None:
        hidden = {"float_id", "_columns", filename, path, *order}
        columns = [n for n, t in df.dtypes if t == "string" and n not in hidden]

    def attribute(name: str) -> Column:
        found = find_column(df.columns, name)
        return reading_value(found) if found else F.lit(None).cast("string")

    first = F.min_by(
        F.struct(
            float_type(path).alias("float_type"),
            attribute("WMO_INST_TYPE").alias("wmo_inst_type"),
            attribute("DATA_CENTRE").alias("institution"),
            attribute("PROJECT_NAME").alias("project_name"),
            attribute("PLATFORM_TYPE").alias("platform_type"),
        ),
        F.struct(*order),
    ).alias("_first")
    # The column flags are part of the same aggregation, under names of their own.
    flags = [F.max(_filled(df, c)).alias(f"_f_{c}") for c in columns]
    # Files of one name in two folders are two files.
    keys = list(dict.fromkeys([filename, *([path] if path in df.columns else []), "float_id"]))
    grouped = df.groupBy(*keys).agg(first, last_reading_date(df).alias("last_reading_date"), *flags)
    listed = F.array_compact(F.array(*[F.when(F.col(f"_f_{c}"), F.lit(c)) for c in columns]))
    return grouped.select(
        "float_id",
        F.col("_first.float_type").alias("float_type"),
        F.col("_first.wmo_inst_type").alias("profiler_type"),
        F.col("_first.institution").alias("institution"),
        F.col("_first.project_name").alias("project_name"),
        F.col("_first.wmo_inst_type").alias("wmo_inst_type"),
        F.col("_first.platform_type").alias("platform_type"),
        listed.alias("all_columns"),
        F.col(filename).alias("csv_filename"),
        "last_reading_date",
    )


def upsert_metadata(existing: DataFrame, incoming: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Metadata after loading ``incoming`` in ``order`` (default: by file name, then float type).

    A float seen before keeps all its first values; only last_reading_date and
    all_columns take those of the latest load, even when null or older.
    """
    order = order or ["csv_filename", "float_type"]
    names = existing.columns
    kept = [n for n in names if n not in ("float_id", "last_reading_date", "all_columns")]
    seq = F.struct(F.lit(1).alias("load"), *[F.col(c).cast("string").alias(f"o{i}") for i, c in enumerate(order)])
    before = F.struct(
        F.lit(0).alias("load"),
        *[F.lit(None).cast("string").alias(f"o{i}") for i in range(len(order))],
    )
    both = existing.withColumn("_seq", before).unionByName(
        incoming.select(*names, seq.alias("_seq"))
    )
    merged = both.groupBy("float_id").agg(
        F.min_by(F.struct(*kept), "_seq").alias("_first"),
        F.max_by(F.struct("last_reading_date", "all_columns"), "_seq").alias("_last"),
    )
    return merged.select(
        "float_id", "_first.*", "_last.last_reading_date", "_last.all_columns"
    ).select(*names)


def without_loaded(readings: DataFrame, loaded: DataFrame) -> DataFrame:
    """Readings whose id is not stored yet. Ids are unique, so no key is hot.

    A stored table laid out by float type and year is read only where the new rows lie:
    the pairs they hold are few, and Spark prunes partitions by them.
    """
    place = [c for c in ("float_type", "year") if c in readings.columns and c in loaded.columns]
    if place:
        near = readings.select(*place).distinct()
        unplaced = F.lit(False)
        for name in place:
            unplaced = unplaced | F.col(name).isNull()
        # Folders of null values are few, and no equality finds them.
        loaded = loaded.join(F.broadcast(near), place, "left_semi").unionByName(loaded.where(unplaced))
    return readings.join(loaded.select("id"), "id", "left_anti")


def count_readings(readings: DataFrame) -> DataFrame:
    return readings.agg(F.count(F.lit(1)).alias("n"))


def readings_of_float(readings: DataFrame, float_id: str) -> DataFrame:
    return readings.where(F.col("float_id") == float_id)


def readings_between(readings: DataFrame, first: str, last: str) -> DataFrame:
    """Readings of a range of dates; with a year column only those partitions are read."""
    found = readings.where(
        F.col("JULD_DATE").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    )
    year = find_column(readings.columns, "year")
    return found if year is None else found.where(F.col(year).between(int(first[:4]), int(last[:4])))


def readings_of_parameter(readings: DataFrame, parameter: str) -> DataFrame:
    return readings.where(F.col("parameter_name") == parameter)


def find_floats(
    metadata: DataFrame, float_type: str | None = None, institution: str | None = None,
    profiler_type: str | None = None, read_since: str | None = None,
    read_until: str | None = None,
) -> DataFrame:
    """Floats by type, institution, profiler type and last reading date."""
    for name, value in (
        ("float_type", float_type), ("institution", institution), ("profiler_type", profiler_type)
    ):
        if value is not None:
            metadata = metadata.where(F.col(name) == value)
    if read_since is not None:
        metadata = metadata.where(F.col("last_reading_date") >= F.lit(read_since).cast("date"))
    if read_until is not None:
        metadata = metadata.where(F.col("last_reading_date") <= F.lit(read_until).cast("date"))
    return metadata


def floats_with_column(metadata: DataFrame, column: str) -> DataFrame:
    return metadata.where(F.array_contains("all_columns", column))


def column_postings(before: DataFrame, after: DataFrame) -> DataFrame:
    """`column, float_id, present` for what a load changes: columns its floats have now, and those they had.

    ``before`` is metadata without the load and ``after`` the load's own: a float takes its columns
    from the latest load. Only floats of the load move.
    """
    def listed(metadata: DataFrame) -> DataFrame:
        return metadata.select(F.explode(F.array_distinct("all_columns")).alias("column"), "float_id").distinct()

    now = listed(after)
    touched = before.join(after.select("float_id").distinct(), "float_id", "left_semi")
    lost = listed(touched).join(now, ["column", "float_id"], "left_anti")
    return now.withColumn("present", F.lit(True)).unionByName(lost.withColumn("present", F.lit(False)))


def floats_with_columns(postings: DataFrame, columns: list[str]) -> DataFrame:
    """`float_id` of the floats that have all the columns, from postings with ``seq`` (the latest counts).

    Postings stored by column are read for these columns only; the metadata is not read.
    """
    wanted = sorted(set(columns))
    latest = postings.where(F.col("column").isin(wanted)).groupBy("column", "float_id").agg(F.max_by("present", "seq").alias("present"))
    held = latest.where("present").groupBy("float_id").agg(F.count(F.lit(1)).alias("_n"))
    return held.where(F.col("_n") == len(wanted)).select("float_id")


def delete_floats(readings: DataFrame, metadata: DataFrame, deleted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readings, metadata) without the deleted floats and everything read from them.

    One anti-join each; readings without a float stay.
    """
    gone = deleted.select("float_id").distinct()
    left = readings.join(gone, "float_id", "left_anti").select(*readings.columns)
    return left, metadata.join(gone, "float_id", "left_anti").select(*metadata.columns)
