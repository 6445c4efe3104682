"""The queries. Each takes (spark, folder of Parquet tables) and returns a DataFrame."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from floatlake import functions as fl
from floatlake.gallery import adapters as A
from floatlake.operators import (
    cleaning, flatten, index, polygons, profile, quality, readings, regions, summary,
)
from floatlake.plans import flows, increments
from floatlake.sources import csv, profiles

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table. Its times are UTC, whatever zone the caller's session has."""
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    utc = {
        c: F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(c).cast("timestamp_ntz"))
        for c, kind in df.dtypes if kind == "timestamp"
    }
    return df.withColumns(utc) if utc else df


def adapted(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    """The SQL over test tables, without a view in the caller's session."""
    used = [name for name in TABLES if re.search(rf"FROM {name}\b", sql)]
    for name in used:
        sql = re.sub(rf"FROM {name}\b", f"FROM {{{name}}}", sql)
    return spark.sql(sql, **{name: table(spark, sf, name) for name in used})


def lower(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def day(c):
    return F.date_format(c, "yyyy-MM-dd")


def _with_juld(df: DataFrame) -> DataFrame:
    return lower(df).withColumn("juld", day("juld"))


def levels(spark, sf):
    return adapted(spark, sf, A.LEVELS)


# --- profiles -------------------------------------------------------------------

def profile_metrics(spark, sf):
    out = profile.profile_metrics(
        levels(spark, sf), A.PROFILE_KEYS, A.LEVEL_ORDER, "bgc", pres="pres", temp="temp"
    )
    return _with_juld(out)


def n_levels(spark, sf):
    out = profile.with_n_levels(levels(spark, sf), A.PROFILE_KEYS, A.LEVEL_ORDER, pres="pres")
    return out.select(*A.LEVEL_ORDER, "platform_number", "n_levels")


def n_levels_range(spark, sf):
    return profile.n_levels_range(profile.level_counts(levels(spark, sf), A.PROFILE_KEYS, "pres"))


def surface_temp(spark, sf):
    return _with_juld(
        profile.surface_temperature(levels(spark, sf), A.PROFILE_KEYS, "pres", "temp")
    )


def _layer(mode):
    def query(spark, sf):
        return _with_juld(profile.mixed_layer_depth(
            levels(spark, sf), A.PROFILE_KEYS, A.LEVEL_ORDER, mode, "pres", "temp"
        ))
    return query


def _depth(mode):
    def query(spark, sf):
        return _with_juld(profile.depth_stats(levels(spark, sf), A.PROFILE_KEYS, mode, "pres"))
    return query


SUMMARY_COLUMNS = [
    "pres", "temp", "psal", "pres_error", "latitude", "longitude", "data_centre",
    "pres_qc", "date_update", "history_start_pres", "juld_location_min",
]


def summary_core(spark, sf):
    out = lower(summary.summarize_core(
        levels(spark, sf), A.LEVEL_ORDER, columns=["cycle_number", *SUMMARY_COLUMNS]
    ))
    return out.withColumns({
        "date": day("date"),
        **{c: F.round(c, 9) for c in ("pres_error", "pres_error_mean")},
    })


def summary_core_tagged(spark, sf):
    tagged = regions.add_region_columns(summary.summarize_core(
        levels(spark, sf), A.LEVEL_ORDER, columns=["latitude", "longitude"]
    ), "core")
    return lower(tagged).withColumn("date", day("date")).select(
        "platform_number", "float_serial_no", "n_levels", "date", "row_count",
        F.col("avg_region"), "ocean",
    )


def summary_bgc(spark, sf):
    out = summary.summarize_bgc(levels(spark, sf), A.LEVEL_ORDER, columns=SUMMARY_COLUMNS)
    return _with_juld(out).withColumns({c: F.round(c, 9) for c in ("psal", "pres_error")})


def summary_bgc_mixed(spark, sf):
    rows = adapted(spark, sf, A.MIXED_LEVELS)
    out = summary.summarize_bgc(rows, A.LEVEL_ORDER, columns=["flag"])
    return _with_juld(out).select("platform_number", "float_serial_no", "cycle_number", "juld", "flag", "flag_mean")


# --- regions --------------------------------------------------------------------

def points(spark, sf):
    return adapted(spark, sf, A.POINTS)


def _region(mode):
    def query(spark, sf):
        return points(spark, sf).select("pid", fl.assign_region("lat", "lon", mode).alias("region"))
    return query


def _region_grid(pairs):
    def query(spark, sf):
        return regions.assign_boxes(
            points(spark, sf), regions.region_boxes(spark), ["pid"], max_broadcast_pairs=pairs,
            points_per_task=20,
        ).select("pid", "region")
    return query


def _polygons(border, pairs=1_000_000):
    def query(spark, sf):
        vertices = adapted(spark, sf, A.POLYGON_VERTICES)
        return polygons.assign_polygons(points(spark, sf), vertices, border=border, max_broadcast_pairs=pairs, points_per_task=20).select("pid", "region")
    return query


def region_grid_duplicates(spark, sf):
    rows, boxes = adapted(spark, sf, A.POINTS_REPEATED), regions.region_boxes(spark)
    forms = [
        regions.assign_boxes(rows, boxes, ["pid"], max_broadcast_pairs=pairs, points_per_task=20)
        .select(F.lit(form).alias("form"), "pid", "lat", "lon", "region")
        for form, pairs in (("broadcast", 1_000_000), ("shuffled", 0))
    ]
    return forms[0].unionByName(forms[1])


def _ocean(mode):
    def query(spark, sf):
        return points(spark, sf).select("pid", fl.assign_ocean("lat", "lon", mode).alias("ocean"))
    return query


def region_share(spark, sf):
    tagged = points(spark, sf).select(fl.assign_region("lat", "lon", "open").alias("region"))
    return regions.label_share(tagged, "region")


def ocean_share(spark, sf):
    tagged = points(spark, sf).select(fl.assign_ocean("lat", "lon", "chain").alias("ocean"))
    return regions.label_share(tagged, "ocean")


# --- index ----------------------------------------------------------------------

def index_lines(spark, sf):
    return adapted(spark, sf, A.INDEX_LINES)


def index_parse(spark, sf):
    return index.parse_index(index_lines(spark, sf))


def index_rejects(spark, sf):
    return index.rejected_lines(index_lines(spark, sf))


def _indian_months(spark, sf, months):
    parsed = index.parse_index(index_lines(spark, sf))
    return index.filter_months(index.filter_ocean(parsed, "I"), 2024, fl.parse_months(months))


def index_filter(spark, sf):
    return _indian_months(spark, sf, "1-6").select("line_no", "file", "date", "ocean", "platform_number")


def platform_first(spark, sf):
    out = flows.bgc_platforms(index_lines(spark, sf), ["line_no"], 2024, fl.parse_months("1-12"))
    return out.select("platform_number", "line_no", "file", "date")


def platform_union(spark, sf):
    return index.merge_platforms(_indian_months(spark, sf, "1-6"), _indian_months(spark, sf, "4,8,12"))


def platform_new(spark, sf):
    return index.new_platforms(_indian_months(spark, sf, "1-6"), _indian_months(spark, sf, "4,8,12"))


def platform_sample(spark, sf):
    return index.sample_platforms(platform_new(spark, sf))


# --- flattening -----------------------------------------------------------------

def flatten_levels(spark, sf):
    nested = table(spark, sf, "embeddings").select(
        "vec_id",
        F.col("label").cast("bigint").alias("CYCLE_NUMBER"),
        F.col("embedding").cast("array<double>").alias("TEMP"),
        F.transform("embedding", lambda x, i: i * F.lit(5.0)).alias("PRES"),
        F.slice("embedding", 1, 60).cast("array<double>").alias("PSAL"),
    )
    return lower(flatten.flatten_profiles(nested, ["vec_id"], scalars={"DATA_TYPE": "float profile"}))


def flatten_first_last(spark, sf):
    words = F.split("o_orderpriority", "-")
    empty = F.array().cast("array<string>")
    nested = table(spark, sf, "orders").select(
        "o_orderkey",
        F.array("o_totalprice", F.col("o_custkey").cast("double")).alias("PRES"),
        words.alias("PARAMETER_DATA_MODE"),
        F.array(words, F.array("o_orderstatus")).alias("CALIB"),
        F.when(F.col("o_orderkey") % 5 == 0, empty).otherwise(words).alias("HISTORY_ACTION"),
        F.when(F.col("o_orderkey") % 5 == 0, F.array().cast("array<double>"))
        .otherwise(F.array("o_totalprice", F.lit(7.0))).alias("HISTORY_START_PRES"),
        F.split("o_orderstatus", "").alias("DATA_CENTRE"),
        F.array(F.array(F.array("o_totalprice"))).alias("DEEP"),
        F.array(F.array().cast("array<string>")).alias("EMPTY_CALIB"),
    )
    return lower(flatten.flatten_profiles(nested, ["o_orderkey"], {"DATA_CENTRE": "chars"}))


def flatten_discovered(spark, sf):
    """Two kinds of JSON profiles: other variables, and one as a list here and a value there."""
    even = F.struct(
        F.col("o_orderkey").alias("KEY"), F.array("o_totalprice", F.col("o_custkey").cast("double")).alias("PRES"),
        F.array("o_orderstatus", "o_orderpriority").alias("FLAG"), F.lit(None).cast("string").alias("NOTHING"),
    )
    odd = F.struct(F.col("o_orderkey").alias("KEY"), F.col("o_custkey").alias("PRES"), F.array("o_totalprice").alias("DOXY"), F.concat("o_orderpriority", F.lit("x")).alias("CLERK"))
    is_even = F.col("o_orderkey") % 2 == 0
    lines = table(spark, sf, "orders").select(
        F.when(is_even, F.to_json(even)).otherwise(F.to_json(odd)).alias("line")
    )
    return lower(flatten.flatten_profiles(profiles.profiles_from_json(lines, "line"), ["KEY"]))


# --- cleaning -------------------------------------------------------------------

def dirty(spark, sf):
    return adapted(spark, sf, A.DIRTY)


def clean_bytes(spark, sf):
    return dirty(spark, sf).select("rn", fl.clean_bytes("project_name").alias("project_name"))


def null_tokens(spark, sf):
    return dirty(spark, sf).select(
        "rn",
        fl.null_tokens("project_name").alias("as_read"),
        fl.reading_value("project_name").alias("as_loaded"),
    )


def split_datetime(spark, sf):
    date, time = fl.split_datetime("juld")
    return dirty(spark, sf).select("rn", date.alias("juld_date"), time.alias("juld_time"))


def compact_date(spark, sf):
    return dirty(spark, sf).select("rn", fl.compact_date("date_update").alias("date_update"))


def loader_times(spark, sf):
    date, time = fl.split_datetime("juld")
    return dirty(spark, sf).select(
        "rn", day(fl.reading_date(date)).alias("reading_date"), fl.reading_time(time).alias("reading_time"),
        day(fl.to_date_or_null("juld", "2025-01-01")).alias("date_or_default"),
    )


def juld_timestamp(spark, sf):
    days = F.when(F.col("o_orderkey") % 9 == 0, F.lit(999999.0)).otherwise(
        F.lit(27000.0) + F.col("o_orderkey") / F.lit(64.0)
    )
    stamp = fl.juld_to_timestamp(days)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("juld"),
        fl.time_of_day(stamp).alias("juld_time"),
    )


def strict_number(spark, sf):
    lines = index_lines(spark, sf)
    lat, lon = (F.get(F.split("line", ","), F.lit(i)) for i in (2, 3))
    return lines.select("line_no", fl.to_number(lat).alias("latitude"), fl.to_number(lon).alias("longitude"))


def filename_parts(spark, sf):
    path = F.concat(
        F.lit("root/BCG floats/"), F.date_format("o_orderdate", "yyyy"), F.lit("/"),
        F.date_format("o_orderdate", "MMMM"), F.lit("/"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit("undated"))
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd")), F.lit("_prof.csv"),
    )
    files = table(spark, sf, "orders").select("o_orderkey", path.alias("path"))
    parts, date = fl.year_month_parts("path"), fl.filename_date(fl.basename("path"))
    return files.select(
        "o_orderkey",
        fl.basename("path").alias("filename"),
        fl.float_type("path").alias("float_type"),
        parts["year"].cast("double").alias("folder_year"),
        parts["month_name"].alias("month_name"),
        fl.month_number(parts["month_name"]).cast("double").alias("month_number"),
        date["year"].cast("double").alias("file_year"),
        date["month"].cast("double").alias("file_month"),
        date["day"].cast("double").alias("file_day"),
    )


def month_names(spark, sf):
    month = F.month("o_orderdate") + F.when(F.col("o_orderkey") % 20 == 0, 12).otherwise(0)
    return table(spark, sf, "orders").select(
        "o_orderkey", fl.month_name(month).alias("month_name"), fl.month_code(month).alias("month_code")
    )


def month_routing(spark, sf):
    name = F.concat(
        F.when(F.col("o_orderkey") % 10 == 0, F.lit("undated"))
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd")), F.lit("_prof.nc"),
    )
    files = table(spark, sf, "orders").select("o_orderkey", name.alias("filename"))
    good, rejected = flows.routed_by_filename(files)
    target = F.concat_ws("/", F.col("year").cast("string"), fl.month_name("month"))
    routed = good.groupBy(target.alias("target")).agg(F.count(F.lit(1)).alias("n"))
    lost = rejected.groupBy(F.lit("rejected").alias("target")).agg(F.count(F.lit(1)).alias("n"))
    return routed.unionByName(lost)


def drop_null_columns(spark, sf):
    return cleaning.drop_null_columns(dirty(spark, sf), ["filename", "path"])


def clean_table(spark, sf):
    return cleaning.clean_table(dirty(spark, sf), ["filename", "path"])


def mixed_union(spark, sf):
    """Two header shapes through the reader's own union and typing."""
    left = dirty(spark, sf).select("filename", "rn", "project_name", F.col("cycle_number").alias("CYCLE_NUMBER"))
    right = index_lines(spark, sf).select(
        F.col("line_no").alias("rn"), "line", F.concat("line_no", F.lit(".5")).alias("TEMP_ERROR"), F.lit("x.txt").alias("filename")
    )
    out = csv.type_levels(csv.union_shapes([left, right]))
    return lower(out)


# --- readings and metadata ------------------------------------------------------

def _cleaned(spark, sf):
    return readings.resolve_float_id(clean_table(spark, sf), ["rn"])


def readings_unpivot(spark, sf):
    long = readings.to_readings(
        _cleaned(spark, sf), ["rn"],
        columns=["project_name", "date_update", "cycle_number", "juld_DATE", "juld_TIME"],
    )
    return lower(long).withColumn("juld_date", day("juld_date")).select(
        "float_id", F.lower("parameter_name").alias("parameter_name"), "value", "juld_date", "juld_time"
    )


def _plain_metadata(df: DataFrame) -> DataFrame:
    """Comparable text in place of dates and arrays."""
    return df.withColumns({
        "last_reading_date": day("last_reading_date"),
        "all_columns": F.array_join(F.transform("all_columns", F.lower), "|"),
    })


def float_metadata(spark, sf):
    return _plain_metadata(readings.float_metadata(_cleaned(spark, sf), ["rn"]))


def metadata_upsert(spark, sf):
    later = cleaning.clean_table(adapted(spark, sf, A.DIRTY_LATER), ["filename", "path"])
    return _plain_metadata(readings.upsert_metadata(
        readings.float_metadata(_cleaned(spark, sf), ["rn"]),
        readings.float_metadata(readings.resolve_float_id(later, ["rn"]), ["rn"]),
    ))


def float_ids_by_file(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.lit("F"), (F.col("o_custkey") % 50).cast("string"), F.lit("_Sprof.csv")).alias("filename"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("nan"))
        .otherwise(F.concat(F.lit(" "), F.col("o_custkey").cast("string"))).alias("PLATFORM_NUMBER"),
    )
    out = readings.resolve_float_id(rows, ["o_orderkey"], "file")
    return out.select("o_orderkey", "float_id")


def reading_rows(spark, sf):
    return adapted(spark, sf, A.READINGS)


def metadata_rows(spark, sf):
    return adapted(spark, sf, A.METADATA)


def _with_day(df):
    return df.withColumn("juld_date", day("juld_date"))


def readings_count(spark, sf):
    return readings.count_readings(reading_rows(spark, sf))


def readings_by_float(spark, sf):
    return _with_day(readings.readings_of_float(reading_rows(spark, sf), "42"))


def readings_by_parameter_month(spark, sf):
    chosen = readings.readings_of_parameter(
        readings.readings_between(reading_rows(spark, sf), "2024-01-10", "2024-01-20"), "purchase"
    )
    return _with_day(chosen)


def floats_by_attribute(spark, sf):
    found = readings.find_floats(
        metadata_rows(spark, sf), float_type="BCG", institution="BUILDING", read_since="2024-03-01"
    )
    return found.withColumn("last_reading_date", day("last_reading_date"))


def floats_with_columns(spark, sf):
    """Floats that have two columns after two loads, from the postings of each."""
    first = readings.float_metadata(_cleaned(spark, sf), ["rn"])
    later = cleaning.clean_table(adapted(spark, sf, A.DIRTY_LATER), ["filename", "path"])
    later = readings.float_metadata(readings.resolve_float_id(later, ["rn"]), ["rn"])
    loads = [readings.upsert_metadata(first.limit(0), first), readings.upsert_metadata(first.limit(0), later)]
    postings = [
        readings.column_postings(before, after).withColumn("seq", F.lit(seq).cast("bigint"))
        for seq, (before, after) in enumerate([(loads[0].limit(0), loads[0]), loads])
    ]
    return readings.floats_with_columns(postings[0].unionByName(postings[1]), ["project_name", "date_update"])


def floats_with_column(spark, sf):
    found = readings.floats_with_column(
        readings.float_metadata(_cleaned(spark, sf), ["rn"]), "project_name"
    )
    return _plain_metadata(found)


def quality_violations(spark, sf):
    metadata, rows = metadata_rows(spark, sf), reading_rows(spark, sf)
    doubled = metadata.select("float_id").unionByName(metadata.where("float_type = 'BCG'").select("float_id"))
    empty = rows.withColumn("parameter_name", F.when(F.col("parameter_name") != "error", F.col("parameter_name")))
    return (
        quality.duplicate_floats(doubled).select(F.lit("duplicate").alias("rule"), "float_id")
        .unionByName(quality.bad_float_types(metadata).select(F.lit("type").alias("rule"), "float_id"))
        .unionByName(quality.missing_fields(empty).select(F.lit("missing").alias("rule"), "float_id"))
    )


def orphan_readings(spark, sf):
    out = quality.orphan_readings(reading_rows(spark, sf), metadata_rows(spark, sf))
    return out.select("event_id", "float_id")


def cascade_delete(spark, sf):
    rows, metadata = reading_rows(spark, sf), metadata_rows(spark, sf)
    deleted = metadata.where("float_type = 'OTHER'")
    left, floats = readings.delete_floats(rows, metadata, deleted)
    return left.select(F.lit("reading").alias("kind"), F.col("event_id").cast("string").alias("key")).unionByName(
        floats.select(F.lit("float").alias("kind"), F.col("float_id").alias("key"))
    )


def load_counters(spark, sf):
    return quality.load_counters(dirty(spark, sf).withColumn("float_type", fl.float_type("path")))


def average_columns(spark, sf):
    return quality.average_columns(readings.float_metadata(_cleaned(spark, sf), ["rn"]))


def reading_rejects(spark, sf):
    rows = reading_rows(spark, sf).withColumn(
        "parameter_name", F.when(F.col("parameter_name") != "error", F.col("parameter_name"))
    )
    good, rejected = quality.split_rejects(rows, quality.reading_problem())
    return (
        good.groupBy(F.lit("kept").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
        .unionByName(rejected.groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n")))
    )


def new_files(spark, sf):
    found = table(spark, sf, "pages").select(F.col("url").alias("path"))
    done = found.where(F.col("path").startswith("http://"))
    return increments.new_files(found, done)


QUERIES = {
    "profile_metrics": profile_metrics,
    "n_levels": n_levels,
    "n_levels_range": n_levels_range,
    "surface_temp": surface_temp,
    "mixed_layer_depth_bgc": _layer("bgc"),
    "mixed_layer_depth_core": _layer("core"),
    "depth_stats_bgc": _depth("bgc"),
    "depth_stats_core": _depth("core"),
    "summary_core": summary_core,
    "summary_core_tagged": summary_core_tagged,
    "summary_bgc": summary_bgc,
    "summary_bgc_mixed": summary_bgc_mixed,
    "region_closed": _region("closed"),
    "region_open": _region("open"),
    "region_grid": _region_grid(1_000_000),
    "region_grid_shuffled": _region_grid(0),
    "region_grid_duplicates": region_grid_duplicates,
    "region_polygons": _polygons(False),
    "region_polygons_shuffled": _polygons(False, 0),
    "region_polygons_border": _polygons(True),
    "ocean_boxes": _ocean("boxes"),
    "ocean_chain": _ocean("chain"),
    "region_share": region_share,
    "ocean_share": ocean_share,
    "index_parse": index_parse,
    "index_rejects": index_rejects,
    "index_filter": index_filter,
    "platform_first": platform_first,
    "platform_union": platform_union,
    "platform_new": platform_new,
    "platform_sample": platform_sample,
    "flatten_levels": flatten_levels,
    "flatten_first_last": flatten_first_last,
    "flatten_discovered": flatten_discovered,
    "clean_bytes": clean_bytes,
    "null_tokens": null_tokens,
    "split_datetime": split_datetime,
    "compact_date": compact_date,
    "loader_times": loader_times,
    "juld_ts": juld_timestamp,
    "strict_number": strict_number,
    "filename_parts": filename_parts,
    "month_names": month_names,
    "month_routing": month_routing,
    "drop_null_columns": drop_null_columns,
    "clean_table": clean_table,
    "mixed_union": mixed_union,
    "readings_unpivot": readings_unpivot,
    "float_metadata": float_metadata,
    "metadata_upsert": metadata_upsert,
    "float_ids_by_file": float_ids_by_file,
    "readings_count": readings_count,
    "readings_by_float": readings_by_float,
    "readings_by_parameter_month": readings_by_parameter_month,
    "floats_by_attribute": floats_by_attribute,
    "floats_with_column": floats_with_column,
    "floats_with_columns": floats_with_columns,
    "quality_violations": quality_violations,
    "orphan_readings": orphan_readings,
    "cascade_delete": cascade_delete,
    "load_counters": load_counters,
    "average_columns": average_columns,
    "reading_rejects": reading_rejects,
    "new_files": new_files,
}
