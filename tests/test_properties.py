"""Properties that hold for any data, and where the two rule sets differ."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from floatlake import functions as fl
from floatlake.gallery import adapters as A, queries as Q
from floatlake.operators import cleaning, flatten, index, profile, quality, readings, regions, summary

SF = "/root/testdata/sf0.001"


def test_flatten_keeps_every_level(spark):
    df = spark.createDataFrame(
        [("f", 0, 9, [1.0, 2.0], [5.0], ["x"]), ("f", 1, 8, [], [], []), ("g", 0, 7, [3.0], [4.0], [])],
        "file string, prof_idx int, CYCLE_NUMBER int, PRES array<double>, TEMP array<double>, HISTORY_ACTION array<string>")
    out = flatten.flatten_profiles(df, ["file", "prof_idx"], scalars={"FORMAT": "3.1"})
    assert out.columns == ["file", "prof_idx", "level_idx", "CYCLE_NUMBER", "HISTORY_ACTION", "PRES", "TEMP", "FORMAT"]
    assert [tuple(r) for r in out.orderBy("file", "level_idx").collect()] == [
        ("f", 0, 0, 9, "x", 1.0, 5.0, "3.1"), ("f", 0, 1, 9, "x", 2.0, None, "3.1"), ("g", 0, 0, 7, "", 3.0, 4.0, "3.1")]
    assert out.count() == df.agg(F.sum(F.size("PRES"))).first()[0]


def test_flatten_roles(spark):
    df = spark.createDataFrame(
        [(1, {"a": 1}, [[["p"]]], [["c"]], bytearray(b"x"), [1.0])],
        "id int, m map<string,int>, o array<array<array<string>>>, c array<array<string>>, b binary, PRES array<double>")
    assert flatten.skipped_variables(df.schema) == ["m"]
    assert tuple(flatten.flatten_profiles(df, ["id"]).first()) == (1, 0, "x", "c", "p", 1.0)
    with pytest.raises(ValueError):
        flatten.flatten_profiles(df.select("id"), ["id"])


def test_profile_bounds(spark):
    lv = Q.levels(spark, SF)
    for mode in ("bgc", "core"):
        out = profile.profile_metrics(lv, A.PROFILE_KEYS, A.LEVEL_ORDER, mode, "pres", "temp")
        bad = out.where(
            (F.col("n_levels") > F.col("row_count"))
            | (F.col("min_DEPTH_m") > F.col("avg_DEPTH_m")) | (F.col("avg_DEPTH_m") > F.col("max_DEPTH_m")))
        assert bad.count() == 0
        layers = out.where("mixed_layer_depth_m IS NOT NULL").withColumnRenamed("mixed_layer_depth_m", "pres")
        assert layers.count() > 0
        assert layers.join(lv, [*A.PROFILE_KEYS, "pres"], "left_anti").count() == 0


def test_grid_equals_box_list(spark):
    rng = random.Random(7)
    rows = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(3000)]
    rows += [(10_000 + i, float(rng.randrange(-60, 40)), float(rng.randrange(20, 150))) for i in range(3000)]
    rows += [(20_000 + i, 15.0, 65.0) for i in range(500)] + [(30_000, None, 1.0), (30_001, float("nan"), 1.0)]
    points = spark.createDataFrame(rows, "id int, lat double, lon double").repartition(4)
    for mode, unknown in (("closed", "Unknown"), ("open", "Unknown Region")):
        direct = points.withColumn("direct", fl.assign_region("lat", "lon", mode))
        for pairs in (10**6, 0):
            out = regions.assign_boxes(direct, regions.region_boxes(spark), ["id"], mode=mode, unknown=unknown,
                                       max_broadcast_pairs=pairs, points_per_task=50)
            assert out.count() == len(rows)
            assert out.where("region <> direct").count() == 0


def test_ocean_table_matches_list(spark):
    grid = [(i, lat / 2.0, lon / 2.0) for i, (lat, lon) in enumerate(
        (lat, lon) for lat in range(-180, 181, 7) for lon in range(-360, 361, 10))]
    points = spark.createDataFrame(grid, "id int, lat double, lon double")
    direct = points.withColumn("direct", fl.assign_ocean("lat", "lon", "boxes"))
    for pairs in (10**6, 0):
        out = regions.assign_boxes(direct, regions.ocean_boxes(spark), ["id"], max_broadcast_pairs=pairs)
        assert out.where("region <> direct").count() == 0 and out.count() == len(grid)
    assert regions.region_boxes(spark).agg(F.max("prio")).first()[0] == 84


def test_tagging_is_not_repeated(spark):
    df = spark.createDataFrame([(15.0, 65.0)], "LATITUDE double, LONGITUDE double")
    once = regions.add_region_columns(df)
    assert regions.has_region_columns(once) and regions.add_region_columns(once) is once
    plain = spark.createDataFrame([(1,)], "x int")
    assert regions.add_region_columns(plain) is plain
    assert regions.add_region_columns(df, "bgc").first().ocean == "Indian Ocean"


def test_upsert(spark):
    schema = readings_schema = ("float_id string, float_type string, profiler_type string, institution string, "
                                "project_name string, wmo_inst_type string, platform_type string, "
                                "all_columns array<string>, csv_filename string, last_reading_date date")
    def row(inst, day, file, cols=("PRES",)):
        return ("F1", "BCG", None, inst, None, None, None, list(cols), file, day)
    existing = spark.createDataFrame([row("A", dt.date(2025, 2, 1), "a")], schema)
    incoming = spark.createDataFrame([row("B", dt.date(2025, 1, 1), "b", ("TEMP",))], readings_schema)
    out = readings.upsert_metadata(existing, incoming)
    assert (out.count(), out.first().institution, out.first().last_reading_date, out.first().all_columns) == (
        1, "A", dt.date(2025, 1, 1), ["TEMP"])
    assert readings.upsert_metadata(out, incoming).collect() == out.collect()
    blank = spark.createDataFrame([row("C", None, "c")], schema)
    assert readings.upsert_metadata(existing, blank).first().last_reading_date is None
    both = spark.createDataFrame([row("B", None, "b1"), row("C", dt.date(2025, 3, 1), "b2")], schema)
    fresh = readings.upsert_metadata(existing.limit(0), both).first()
    assert (fresh.institution, fresh.last_reading_date) == ("B", dt.date(2025, 3, 1))


def test_readings_are_the_filled_cells(spark):
    df = spark.createDataFrame(
        [(1, "F", "a", None, "2025-01-02", "01:02:03.5"), (2, "F", " nan ", "b", None, None)],
        "n int, float_id string, X string, Y string, JULD_DATE string, JULD_TIME string")
    out = readings.to_readings(df, ["n"])
    got = {(r.parameter_name, r.value, r.JULD_DATE, r.JULD_TIME) for r in out.collect()}
    day = dt.date(2025, 1, 2)
    assert got == {("X", "a", day, "01:02:03"), ("JULD_DATE", "2025-01-02", day, "01:02:03"),
                   ("JULD_TIME", "01:02:03.5", day, "01:02:03"), ("Y", "b", None, None)}
    assert readings.without_loaded(out, out).count() == 0
    other = df.withColumnsRenamed({"JULD_DATE": "JULD_LOCATION_DATE", "JULD_TIME": "JULD_LOCATION_TIME"})
    assert readings.to_readings(other, ["n"]).where("JULD_DATE IS NOT NULL").count() == 3


def test_date_pair_follows_the_file(spark):
    df = spark.createDataFrame(
        [(1, "F", None, "2025-01-02", ["JULD_DATE", "JULD_LOCATION_DATE"]), (2, "F", None, "2025-01-03", ["JULD_LOCATION_DATE"])],
        "n int, float_id string, JULD_DATE string, JULD_LOCATION_DATE string, _columns array<string>")
    out = readings.to_readings(df, ["n"])
    assert {(r.value, str(r.JULD_DATE)) for r in out.collect()} == {("2025-01-02", "None"), ("2025-01-03", "2025-01-03")}


def test_platform_list_is_idempotent(spark):
    found = spark.createDataFrame([("b",), ("a",), (None,)], "platform_number string")
    once = index.merge_platforms(found.limit(0), found)
    assert [r[0] for r in once.collect()] == ["a", "b"]
    assert index.merge_platforms(once, found).collect() == once.collect()
    assert index.new_platforms(once, found).count() == 0


def test_mixed_rules(spark):
    df = spark.createDataFrame(
        [(0, "1", "b'1'", "x", "3", "7"), (1, "1", "b'2'", "y", "z", None), (2, "2", "b'4'", "y", "q", None)],
        "n int, PLATFORM_NUMBER string, QC string, NOTE string, MIX string, WMO_INST_TYPE string")
    rules = summary.column_rules(df, ["n", "PLATFORM_NUMBER"], infer=True)
    assert rules == {"QC": "mean", "NOTE": "first", "MIX": "mixed", "WMO_INST_TYPE": "first"}
    out = {r.PLATFORM_NUMBER: r for r in summary.summarize_bgc(df, ["n"], rules).collect()}
    assert (out["1"].QC, out["1"].NOTE, out["1"].MIX, out["1"].WMO_INST_TYPE) == (1.5, "x", "3.0", "7")
    assert out["2"].MIX == "q" and out["2"].ocean == "Unknown" and out["2"].mixed_layer_depth_m is None


def test_core_without_level_count_or_date(spark):
    df = spark.createDataFrame([(0, "1", 5.0), (1, "1", 6.0)], "n int, PLATFORM_NUMBER string, PRES double")
    row = summary.summarize_core(df, ["n"], default_date="2025-01-01").first()
    assert (row.row_count, row.n_levels, row.DATE, row.PRES) == (2, 2, dt.date(2025, 1, 1), 5.5)
    assert "DATE" not in summary.summarize_core(df, ["n"]).columns
    with pytest.raises(ValueError):
        summary.summarize_core(df.drop("PLATFORM_NUMBER"), ["n"])


def test_core_merges_cycles_of_one_day(spark):
    """Two cycles of one day with equal level counts form one summary row."""
    rows = [(c * 10 + i, "1", c, dt.datetime(2025, 1, 1, c), 5.0 * i + c, 28.0 - i) for c in (1, 2) for i in range(4)]
    rows += [(30, "1", 3, dt.datetime(2025, 1, 1, 3), 1.0, 20.0)]
    df = spark.createDataFrame(rows, "n int, PLATFORM_NUMBER string, CYCLE_NUMBER int, JULD timestamp, PRES double, TEMP double")
    out = {r.n_levels: r for r in summary.summarize_core(df, ["n"]).collect()}
    assert set(out) == {4, 1} and out[4].row_count == 8 and out[4].CYCLE_NUMBER == 1
    shallow = [r for r in rows if r[2] < 3 and r[4] <= 10]
    reference = sum(r[5] for r in shallow) / len(shallow)
    assert out[4].mixed_layer_depth_m == min(r[4] for r in rows if r[2] < 3 and abs(r[5] - reference) >= 0.2)
    assert out[1].mixed_layer_depth_m is None


def test_time_preparation(spark):
    df = spark.createDataFrame([(27500.25, "2025-04-17 06:00:00")], "JULD double, JULD_LOCATION string")
    bgc, core = summary.prepare_bgc(df).first(), summary.prepare_core(df).first()
    assert (bgc.JULD, bgc.JULD_LOCATION) == (dt.date(2025, 4, 17), "06:00:00")
    assert (core.JULD, core.JULD_LOCATION_time) == (dt.datetime(2025, 4, 17, 6), "06:00:00")


def test_unreadable_numbers_are_missing(spark):
    df = spark.createDataFrame([(0, "1", "5", "28"), (1, "1", "bad", "27"), (2, "1", "30", "x")],
                               "row int, PLATFORM_NUMBER string, PRES string, TEMP string")
    row = profile.profile_metrics(df, ["PLATFORM_NUMBER"], ["row"]).first()
    assert (row.row_count, row.n_levels, row.max_DEPTH_m, row.surface_temp_C) == (3, 2, 30.0, 28.0)


def test_observed_rows(spark, tmp_path):
    df, seen = quality.observe_rows(spark.range(7).toDF("id"))
    df.write.parquet(str(tmp_path / "t"))
    assert seen.get["rows"] == 7


def test_null_columns(spark):
    df = spark.createDataFrame([("a", " ", None, "b''"), (None, "", "nan", "b''")], "x string, y string, z string, q string")
    assert cleaning.drop_null_columns(df).columns == ["x", "q"]


def test_platform_column_of_another_name(spark):
    """Groups wider than the counted profiles: the level count is set on the rows first."""
    rows = [(i, "A", str(i // 4), 1, 5.0 * (i % 4), 28.0 - i % 4) for i in range(8)]
    df = spark.createDataFrame(rows, "row int, PLATFORM_TYPE string, PLATFORM_NUMBER string, CYCLE_NUMBER int, PRES double, TEMP double")
    out = summary.summarize_bgc(df, ["row"], {}, ["TEMP"]).collect()
    assert [(r.PLATFORM_TYPE, r.CYCLE_NUMBER, r.n_levels, r.max_DEPTH_m) for r in out] == [("A", 1, 4, 15.0)]
