"""End-to-end flows. Each step reads the table the step before has written, so any
prefix of steps can be run, and a lost executor never repeats an earlier step."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from floatlake.catalog import METADATA_SCHEMA
from floatlake.functions.dates import filename_date, month_number
from floatlake.functions.paths import basename, float_type, year_month_parts
from floatlake.operators.cleaning import clean_text_columns, split_datetime_columns
from floatlake.operators.flatten import flatten_profiles
from floatlake.operators.index import (
    filter_months, filter_ocean, first_per_platform, new_platforms, parse_index, rejected_lines,
)
from floatlake.operators.quality import average_columns, observe_rows, split_rejects
from floatlake.operators.readings import (
    column_postings, date_problem, float_metadata, floats_with_columns, resolve_float_id, to_readings, upsert_metadata,
)
from floatlake.operators.regions import add_region_columns, has_region_columns
from floatlake.operators.summary import (
    CoreSummary, core_grouping_columns, grouping_columns, prepare_bgc, prepare_core, summarize_bgc,
)
from floatlake.plans.buckets import BUCKETS, BucketTable
from floatlake.plans.increments import (
    finish_run, finished_runs, keep_pending, new_files, pending_paths, previous_run, read_manifest,
)
from floatlake.sources.csv import (
    FILE_COLUMNS, ROW_ORDER, escaped, list_files, number_rows, read_index, read_mixed_csv,
    type_levels, with_path_columns,
)
from floatlake.sources.profiles import read_profiles
from floatlake.sources.sinks import write_by_month, write_counters, write_mirrored, write_partitioned, write_readings
from floatlake.sources.tables import partition_values, read_or_empty

PROFILE_IDS = ["file", "prof_idx"]
#: Counter of the readings of each float type.
READING_COUNTS = {"BCG": "bgc_readings", "NON-BCG": "core_readings"}


def bgc_platforms(lines: DataFrame, order: list[str], year: int, months: list[int], ocean: str = "I") -> DataFrame:
    """First profile per platform of one ocean and the months of a year."""
    found = parse_index(lines)
    return first_per_platform(filter_months(filter_ocean(found, ocean), year, months), order)


def update_platform_list(spark: SparkSession, found: DataFrame, path: str) -> DataFrame:
    """Add platforms not stored yet; the list is the union of all additions."""
    stored = read_or_empty(spark, path, "platform_number string")
    new_platforms(stored, found).write.mode("append").parquet(path)
    return spark.read.parquet(path).orderBy("platform_number")


def bgc_levels(profiles: DataFrame) -> DataFrame:
    """Level rows with ``row_no``, the position of a level in its file."""
    levels = flatten_profiles(profiles, PROFILE_IDS)
    number = F.shiftleft(F.col("prof_idx").cast("bigint"), 32) + F.col("level_idx")
    return levels.withColumn("row_no", number)


def bgc_summary(levels: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """Level rows to summary rows, every file by itself."""
    rows = prepare_bgc(levels).drop("prof_idx", "level_idx")
    return summarize_bgc(rows, ["row_no"], rules, partition_columns=["file"])


def core_plan(types: dict[str, str], order: list[str], default_date: str | None = None) -> CoreSummary:
    """Monthly summary of level rows with these columns."""
    return CoreSummary(types, order, default_date=default_date, partition_columns=["year", "month"])


def core_summary(levels: DataFrame, order: list[str], default_date: str | None = None) -> DataFrame:
    """Level rows with year and month to labelled monthly summaries."""
    rows = prepare_core(levels)
    return add_region_columns(core_plan(dict(rows.dtypes), order, default_date).of_levels(rows), "core")


def _run_folder(out: str, table: str, run_id: int) -> str:
    return f"{out}/{table}/run_id={run_id}"


def _taken_files(spark: SparkSession, found: DataFrame, out: str, run_id: int) -> DataFrame:
    """The files this run takes, as a written table."""
    pending = new_files(found, read_manifest(spark, f"{out}/manifest"))
    return keep_pending(pending, _run_folder(out, "pending", run_id))


def run_bgc(
    spark: SparkSession, out: str, run_id: int, index: str | None = None,
    profiles: str | None = None, year: int | None = None, months: list[int] | None = None,
    steps: tuple[str, ...] = ("platforms", "levels", "summary"),
    rules: dict[str, str] | None = None,
) -> dict[str, str]:
    """Biogeochemical floats: platform list, level rows and profile summaries.

    Index lines that cannot be used are kept apart with the reason. Profile files already
    in the manifest are left out. Returns the paths written.
    """
    written, counts = {}, {}
    if "platforms" in steps:
        lines = read_index(spark, index)
        written["rejects"] = _run_folder(out, "rejects", run_id)
        rejected, seen = observe_rows(rejected_lines(lines).select("line", "reason"), "rejects")
        rejected.write.mode("overwrite").parquet(written["rejects"])
        counts["errors"] = seen.get["rows"]
        found = bgc_platforms(lines, ROW_ORDER, year, months)
        update_platform_list(spark, found, f"{out}/platforms")
        written["platforms"] = f"{out}/platforms"
    levels_path = _run_folder(out, "levels", run_id)
    if "levels" in steps:
        files = _taken_files(spark, list_files(spark, profiles, "*.parquet"), out, run_id)
        paths = pending_paths(files)
        if not paths:
            return written
        counts["files"] = len(paths)
        levels, seen = observe_rows(bgc_levels(read_profiles(spark, [escaped(p) for p in paths])), "levels")
        levels.write.mode("overwrite").parquet(levels_path)
        counts["rows"] = seen.get["rows"]
        written["levels"] = levels_path
    if "summary" in steps:
        summary_path = _run_folder(out, "summary", run_id)
        summary = bgc_summary(spark.read.parquet(levels_path), rules)
        # Files of a profile lie together and in the order of their keys.
        summary.sortWithinPartitions(*grouping_columns(summary.columns)).write.mode("overwrite").parquet(summary_path)
        written["summary"] = summary_path
    if "levels" in steps:
        written["counters"] = write_counters(spark, _run_folder(out, "counters", run_id), counts)
        finish_run(spark, f"{out}/manifest", files, run_id)
    return written


def placed_files(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files below <year>/<month name>/, other files with the reason)."""
    parts = found.select("path", year_month_parts("path").alias("_parts"))
    number = month_number("_parts.month_name")
    reason = (
        F.when(F.col("_parts").isNull(), "not below a <year>/<month>/ folder")
        .when(number.isNull(), "month folder is not known")
    )
    good, rejected = split_rejects(parts, reason)
    return good.select("path"), rejected.select("path", "reason")


def dated_files(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files with a date in their name, other files with the reason)."""
    named = found.select("path", basename("path").alias("filename"))
    good, undated = routed_by_filename(named)
    return good.select("path"), undated.select("path", F.lit("no date in the file name").alias("reason"))


def _month_of_filename(rows: DataFrame) -> DataFrame:
    dated, _ = routed_by_filename(rows.withColumn("filename", basename("path")))
    return dated.drop("day")


def run_core(
    spark: SparkSession, out: str, run_id: int, csv_root: str | None = None,
    steps: tuple[str, ...] = ("levels", "summary"), default_date: str | None = None,
    by: str = "folder",
) -> dict[str, str]:
    """Core floats: daily CSV files to typed level rows and labelled monthly summaries.

    Every run keeps the states of its profiles by month. A month with new files is summarised
    again from the states of finished runs and this one: level rows of earlier runs are not read,
    and other months are not touched. A file's month is that of its <year>/<month>/ folder or, ``by``
    "filename", of the date its name starts with. Files without one are listed as
    rejects and not recorded: once moved or renamed, they are taken.
    """
    if by not in ("folder", "filename"):
        raise ValueError(f"by must be 'folder' or 'filename', not {by!r}")
    written, counts = {}, {}
    levels_path, own = f"{out}/levels", _run_folder(out, "levels", run_id)
    if "levels" in steps:
        usable, rejected = (placed_files if by == "folder" else dated_files)(list_files(spark, csv_root, "*.csv"))
        files = _taken_files(spark, usable, out, run_id)
        paths = pending_paths(files)
        if not paths:
            return written
        counts["files"] = len(paths)
        raw = read_mixed_csv(spark, paths)
        if by == "folder":
            placed = with_path_columns(raw).withColumn("month", month_number("month_name")).drop("month_name")
        else:
            placed = _month_of_filename(raw)
        levels = type_levels(clean_text_columns(placed, ["path", "filename"])).drop("_columns")
        levels, seen = observe_rows(levels, "levels")
        write_partitioned(levels, own, ["year", "month"], whole=True)
        counts["rows"] = seen.get["rows"]
        written["levels"] = levels_path
        written["rejects"] = _run_folder(out, "rejects", run_id)
        rejected, seen = observe_rows(rejected, "rejects")
        rejected.write.mode("overwrite").parquet(written["rejects"])
        counts["errors"] = seen.get["rows"]
    if "summary" in steps:
        summary = add_region_columns(monthly_groups(spark, out, run_id, default_date), "core")
        write_by_month(summary, f"{out}/summary", sort=core_grouping_columns(summary.columns))
        written["summary"] = f"{out}/summary"
    if "levels" in steps:
        written["counters"] = write_counters(spark, _run_folder(out, "counters", run_id), counts)
        finish_run(spark, f"{out}/manifest", files, run_id)
    return written


def monthly_groups(spark: SparkSession, out: str, run_id: int, default_date: str | None = None) -> DataFrame:
    """Summary of the months a run has rows in, from kept profile states.

    States of runs whose files had other columns are merged too: a column that one run lacks has no
    values there. Only if the columns that make up a profile differ, or a run has kept no
    states, are its level rows of these months read again.
    """
    own = prepare_core(spark.read.parquet(_run_folder(out, "levels", run_id)).drop("filename"))
    states_path = _run_folder(out, "profiles", run_id)
    plan = core_plan(dict(own.dtypes), ROW_ORDER, default_date)
    write_partitioned(plan.profiles(own), states_path, ["year", "month"], whole=True)
    kept = spark.createDataFrame([(run_id, *x) for x in own.dtypes], "run_id bigint, name string, type string")
    kept.coalesce(1).write.mode("overwrite").parquet(f"{out}/columns/of_run={run_id}")

    months = sorted(spark.read.parquet(states_path).select("year", "month").distinct().collect())
    runs = finished_runs(spark, f"{out}/manifest").where(F.col("run_id") != run_id)
    # Names of folders tell which runs have rows in the touched months; no file is opened for that.
    holding = {x for m in months for x in partition_values(spark, f"{out}/levels/run_id=*/year={m.year}/month={m.month}", "run_id")}
    earlier = sorted(x["run_id"] for x in runs.where(F.col("run_id").isin(sorted(holding))).collect())
    if not earlier:
        return plan.summary(spark.read.parquet(states_path))
    columns: dict[int, dict[str, str]] = {}
    for x in spark.read.parquet(f"{out}/columns").where(F.col("run_id").isin([run_id, *earlier])).collect():
        columns.setdefault(x["run_id"], {})[x["name"]] = x["type"]
    types = {name: kind for own_types in columns.values() for name, kind in own_types.items()}
    both = core_plan(types, ROW_ORDER, default_date)
    plans = {x: core_plan(columns[x], ROW_ORDER, default_date) for x in columns}
    same = set(plans) == {run_id, *earlier} and all((p.profile_keys, p.counted, p.layered) == (both.profile_keys, both.counted, both.layered) for p in plans.values())
    if not same:
        current = spark.range(1).select(F.lit(run_id).cast("bigint").alias("run_id"))
        rows = _month_folders(spark, f"{out}/levels", months).join(runs.unionByName(current), "run_id", "left_semi").drop("run_id", "filename")
        rows = prepare_core(rows)
        return core_plan(dict(rows.dtypes), ROW_ORDER, default_date).of_levels(rows)
    chosen = spark.range(1).select(F.explode(F.array(*[F.lit(x).cast("bigint") for x in (run_id, *earlier)])).alias("run_id"))
    states = _month_folders(spark, f"{out}/profiles", months).join(F.broadcast(chosen), "run_id", "left_semi").drop("run_id")
    return both.summary(both.merged(states))


def _month_folders(spark: SparkSession, table: str, months: list) -> DataFrame:
    """Rows of some months, of all runs."""
    folders = [f"{escaped(table)}/run_id=*/year={m.year}/month={m.month}" for m in months]
    return spark.read.option("basePath", table).option("mergeSchema", "true").parquet(*folders)


def tag_summaries(spark: SparkSession, source: str, target: str, mode: str = "core") -> bool:
    """Write a summary table with its labels to ``target``; False if it has them already.

    Spark cannot replace a table it is reading, so the result goes to a place of its own.
    """
    df = spark.read.parquet(source)
    if has_region_columns(df):
        return False
    add_region_columns(df, mode).write.mode("overwrite").parquet(target)
    return True


def routed_by_filename(df: DataFrame, filename: str = "filename") -> tuple[DataFrame, DataFrame]:
    """(rows with year, month and day from the file name, rows without a readable date)."""
    dated = df.withColumn("_date", filename_date(filename))
    usable = (F.col("_date.year") != 0) & (F.col("_date.month") != 0)
    good = dated.where(usable).select(*df.columns, "_date.*")
    return good, dated.where(~F.coalesce(usable, F.lit(False))).select(*df.columns)


def load_tables(clean: DataFrame, order: list[str], mode: str = "row") -> tuple[DataFrame, DataFrame]:
    """(readings with float_type, metadata) of a cleaned table."""
    identified = resolve_float_id(clean, order, mode)
    metadata = float_metadata(identified, order)
    readings = to_readings(
        identified.withColumn("float_type", float_type("path")), order, carry=["float_type"],
        columns=[n for n, t in clean.dtypes if t == "string" and n not in FILE_COLUMNS],
    )
    return readings, metadata


def run_load(
    spark: SparkSession, roots: str | list[str], out: str, run_id: int, mode: str = "row",
    steps: tuple[str, ...] = ("clean", "load"), files: DataFrame | None = None,
    stable_ids: bool = True, buckets: int = 0,
) -> dict[str, str]:
    """Dirty CSV trees to cleaned rows, long readings and float metadata.

    The CSV text is parsed once, into a columnar table; readings and metadata read
    only what they need of that. Rows whose date or time cannot be read are kept apart
    with the reason. ``files`` (``path``) replaces the search; files in the manifest are
    left out of it too. ``stable_ids`` gives a file's readings the same ids in every run
    (see number_rows). Each run writes the float metadata as a whole, or, with ``buckets``, only the
    hash buckets its floats lie in (see buckets.py; read it with read_metadata). Which
    columns a float has gained or lost is kept by column (see floats_having).
    """
    written, counts = {}, {}
    manifest, clean_path = f"{out}/manifest", _run_folder(out, "clean", run_id)
    if "clean" in steps:
        files = _taken_files(spark, list_files(spark, roots, "*.csv") if files is None else files, out, run_id)
        paths = pending_paths(files)
        if not paths:
            return written
        counts["files"] = len(paths)
        raw = read_mixed_csv(spark, paths)
        raw = number_rows(raw) if stable_ids else raw
        clean, seen = observe_rows(split_datetime_columns(clean_text_columns(raw, FILE_COLUMNS)), "clean")
        clean.write.mode("overwrite").parquet(clean_path)
        counts["rows"] = seen.get["rows"]
        written["clean"] = clean_path
    if "load" in steps:
        clean = spark.read.parquet(clean_path)
        good, rejected = split_rejects(clean, date_problem(clean))
        rejects_path = _run_folder(out, "rejects", run_id)
        rejected, seen = observe_rows(rejected, "rejects")
        rejected.write.mode("overwrite").parquet(rejects_path)
        counts["errors"] = seen.get["rows"]
        readings, _ = load_tables(good, ROW_ORDER, mode)
        _, metadata = load_tables(clean, ROW_ORDER, mode)
        readings_path = _run_folder(out, "readings", run_id)
        by_type = Observation("readings")
        counted = [F.count_if(F.col("float_type") == kind).alias(name) for kind, name in READING_COUNTS.items()]
        write_readings(readings.observe(by_type, *counted), readings_path, "overwrite")
        counts |= by_type.get
        postings_path = _run_folder(out, "postings", run_id)
        if buckets:
            metadata_path = _run_folder(out, "incoming", run_id)
            metadata.write.mode("overwrite").parquet(metadata_path)
            incoming = spark.read.schema(METADATA_SCHEMA).parquet(metadata_path)
            table = metadata_table(spark, out, buckets)
            existing = table.get_touched(incoming)
            write_postings(column_postings(existing, incoming), postings_path)
            table.upsert(incoming, upsert_metadata, f"run-{run_id}")
            metadata_path = f"{out}/metadata_buckets"
            counts |= average_columns(table.read()).first().asDict()
        else:
            before = previous_run(spark, manifest, run_id)
            existing = (
                spark.createDataFrame([], METADATA_SCHEMA) if before is None
                else spark.read.schema(METADATA_SCHEMA).parquet(_run_folder(out, "metadata", before))
            )
            metadata_path = _run_folder(out, "metadata", run_id)
            upsert_metadata(existing, metadata).write.mode("overwrite").parquet(metadata_path)
            write_postings(column_postings(existing, metadata), postings_path)
            counts |= average_columns(spark.read.parquet(metadata_path)).first().asDict()
        written.update(readings=readings_path, metadata=metadata_path, rejects=rejects_path)
    if "clean" in steps:
        written["counters"] = write_counters(spark, _run_folder(out, "counters", run_id), counts)
        finish_run(spark, manifest, files, run_id)
    return written


def metadata_table(spark: SparkSession, out: str, buckets: int = BUCKETS) -> BucketTable:
    """The bucketed float metadata of run_load."""
    return BucketTable(spark, f"{out}/metadata_buckets", METADATA_SCHEMA, "float_id", buckets)


def write_postings(postings: DataFrame, path: str) -> None:
    write_partitioned(postings, path, ["column"], whole=True)


def floats_having(spark: SparkSession, out: str, columns: list[str]) -> DataFrame:
    """Floats with all the columns, by the postings of finished runs: only these columns' folders are read."""
    runs = read_manifest(spark, f"{out}/manifest").groupBy("run_id").agg(F.max("seq").alias("seq"))
    stored = spark.read.schema("float_id string, present boolean, run_id bigint, column string").parquet(f"{out}/postings")
    return floats_with_columns(stored.join(F.broadcast(runs), "run_id"), columns)


def run_clean(spark: SparkSession, root: str, out: str) -> str:
    """A tree of cleaned CSV files like the one below ``root``, one folder per file.

    Columns without any value in a file are left out of that file's copy. The text is parsed
    once: cleaned rows are written, laid out by the set of columns their file fills, and
    each set, which has one header, is one pass over its own rows. That table stays beside ``out``.
    """
    rows_path = f"{out.rstrip('/')}_rows"
    clean = split_datetime_columns(clean_text_columns(read_mixed_csv(spark, root), FILE_COLUMNS))
    clean.write.mode("overwrite").parquet(f"{rows_path}/parsed")
    clean = spark.read.schema(clean.schema).parquet(f"{rows_path}/parsed")
    columns = [c for c in clean.columns if c not in FILE_COLUMNS]
    filled = F.array_compact(F.array(*[F.when(F.max(F.col(f"`{c}`").isNotNull()), F.lit(c)) for c in columns]))
    per_file = clean.groupBy("path").agg(filled.alias("_filled"))
    # A header for every distinct set: as few as the sources have kinds of files.
    sets = sorted(r["_filled"] for r in per_file.select("_filled").distinct().collect())
    if len(sets) == 1:
        write_mirrored(clean.select(*sets[0], *FILE_COLUMNS), root, out)
        return out
    numbers = spark.createDataFrame(list(enumerate(sets)), "_set int, _filled array<string>")
    numbered = clean.join(per_file.join(F.broadcast(numbers), "_filled").select("path", "_set"), "path")
    write_partitioned(numbered, f"{rows_path}/by_set", ["_set"], whole=True)
    by_set = spark.read.schema(numbered.schema).parquet(f"{rows_path}/by_set")
    for number, names in enumerate(sets):
        write_mirrored(by_set.where(F.col("_set") == number).select(*names, *FILE_COLUMNS), root, out)
    return out
