"""The shape of the plans: no Python, no needless exchange, pruned and filtered scans."""

import re

import pytest

import __spark_entry__ as entry
from floatlake import functions as fl
from floatlake.gallery import adapters as A, queries as Q
from floatlake.operators import summary

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_no_python_and_no_cross_product(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for word in ("Python", "Pandas", "CartesianProduct", "NestedLoop"):
        assert word not in text


@pytest.mark.parametrize("name", [
    "region_closed", "region_open", "ocean_boxes", "ocean_chain", "flatten_levels", "flatten_first_last",
    "readings_unpivot", "index_parse", "index_filter", "readings_by_float", "split_datetime",
])
def test_narrow_queries(spark, name):
    assert "Exchange" not in plan(entry.queries()[name](spark, SF))


def test_small_grid_moves_no_points(spark):
    text = plan(Q.QUERIES["region_grid"](spark, SF))
    scan = text[text.index("FileScan parquet") - 4000:]
    assert "BroadcastHashJoin" in scan


@pytest.mark.parametrize("name, scans", [
    ("profile_metrics", 1), ("mixed_layer_depth_bgc", 1), ("mixed_layer_depth_core", 1),
    ("summary_core", 2), ("summary_core_tagged", 2), ("summary_bgc", 2),
])
def test_levels_are_looked_at_once(spark, name, scans):
    """Though the mixed layer's reference is known last; summaries look a second time at its columns alone."""
    text = plan(Q.QUERIES[name](spark, SF))
    assert text.count("FileScan") == scans and text.count("Join") == scans - 1
    if scans == 1:
        assert "SortAggregate" not in text


def test_level_counts_share_one_aggregation(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = final_plan(Q.n_levels(spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The branches for large and ordinary groups share one aggregation, and the branch
    # for large groups is gone once it is seen to be empty.
    assert "ReusedExchange" in text and "BroadcastHashJoin" not in text
    join = re.search(r"SortMergeJoin \[([^\]]*)\]", text).group(1)
    assert "_salt" in join


def test_summary_without_layers_is_one_exchange(spark):
    lv = Q.levels(spark, SF).drop("temp")
    text = plan(summary.summarize_bgc(lv, A.LEVEL_ORDER, {"psal": "mean"}, ["psal"]))
    assert text.count("Exchange") == 1


def test_scans_are_pruned_and_filtered(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    text = plan(Q.QUERIES["depth_stats_bgc"](spark, SF))
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "l_extendedprice" not in schema and "l_discount" not in schema
    found = plan(Q.table(spark, SF, "customer").where("c_mktsegment = 'BUILDING'"))
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)]" in found


def test_labels_are_expressions(spark):
    df = Q.points(spark, SF).select(fl.assign_region("lat", "lon").alias("r"))
    text = plan(df)
    assert "Join" not in text and "*(1)" in text


def test_kept_profiles_save_a_scan_of_the_levels(spark, tmp_path):
    def keep(profiles):
        profiles.write.parquet(str(tmp_path / "profiles"))
        return spark.read.schema(profiles.schema).parquet(str(tmp_path / "profiles"))

    rows, order = Q.levels(spark, SF), A.LEVEL_ORDER
    plain = summary.summarize_core(rows, order, columns=Q.SUMMARY_COLUMNS)
    kept = summary.summarize_core(rows, order, columns=Q.SUMMARY_COLUMNS, keep=keep)
    scans = re.findall(r"FileScan parquet .*?Location: [^\n]*lineitem", plan(kept).split("== Initial Plan ==")[0])
    assert len(scans) <= 1
    assert kept.exceptAll(plain).count() == plain.exceptAll(kept).count() == 0


def test_profile_metrics_hash_the_levels(spark):
    text = plan(Q.QUERIES["profile_metrics"](spark, SF))
    assert "SortAggregate" not in text and "HashAggregate" in text


@pytest.mark.parametrize("name, gathers", [("summary_core", 1), ("summary_bgc", 0)])
def test_summaries_gather_points_by_a_number_and_clean_texts_once(spark, name, gathers):
    text = plan(Q.QUERIES[name](spark, SF))
    assert text.count("ObjectHashAggregate(keys=[_place") == 2 and text.count("REBALANCE_PARTITIONS") == gathers
    if name == "summary_core":
        # One for each text column: neither the aggregate nor the unwrapping trims again.
        spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
        try:
            optimized = Q.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.debug.maxToStringFields")
        assert len(re.findall(r"\btrim\(", optimized)) == 3


def test_clean_texts_leave_the_columns_they_come_from(spark):
    """A pressure in the wrapper of a byte string is no number, as before, though its clean text is summarised."""
    rows = [(i, "1", 1, "2025-01-01", p, 20.0 - i, d) for i, (p, d) in enumerate([("b'5'", " b'20250101052756' "), ("7", None), (None, "b'x'")])]
    df = spark.createDataFrame(rows, "n int, PLATFORM_NUMBER string, CYCLE_NUMBER int, JULD string, PRES string, TEMP double, DATE_UPDATE string")
    core = summary.summarize_core(df, ["n"]).first()
    assert (core.row_count, core.n_levels, core.min_DEPTH_m, core.PRES, core.DATE_UPDATE) == (3, 1, 7.0, "5", "2025-01-01")
    bgc = summary.summarize_bgc(df, ["n"], {"PRES": "first", "DATE_UPDATE": "both"}).first()
    assert (bgc.n_levels, bgc.min_DEPTH_m, bgc.PRES, bgc.DATE_UPDATE, bgc.DATE_UPDATE_mean) == (1, 7.0, "5", "20250101052756", 20250101052756.0)
