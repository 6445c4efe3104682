"""Hot groups give the same rows and do not end up in one task."""

from pyspark.sql import functions as F

from floatlake.operators import profile, skew, summary
from floatlake.operators.quality import orphan_readings
from floatlake.operators.readings import resolve_float_id


def hot_levels(spark):
    """One profile holds half of the rows, a tenth of the rows has no cycle."""
    return spark.range(20_000).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 2 == 0, F.lit("hot"))
        .otherwise(F.concat(F.lit("p"), (F.col("id") % 40).cast("string"))).alias("PLATFORM_NUMBER"),
        F.when(F.col("id") % 10 != 3, F.lit(1)).alias("CYCLE_NUMBER"),
        F.lit("2024-01-01").cast("date").alias("JULD"),
        (F.col("id") % 1000 + 1).cast("double").alias("PRES"),
        (F.lit(28.0) - (F.col("id") % 1000) / F.lit(1024.0)).alias("TEMP"),
        F.lit(10.0).alias("LATITUDE"), F.lit(60.0).alias("LONGITUDE"),
    )


KEYS = ["PLATFORM_NUMBER", "CYCLE_NUMBER", "JULD"]


def same(a, b):
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_hot_and_cold_agree(spark):
    df = hot_levels(spark)
    for run in (
        lambda h: profile.with_n_levels(df, KEYS, ["row"], hot_rows=h),
        lambda h: profile.profile_metrics(df, KEYS, ["row"], hot_rows=h),
        lambda h: profile.mixed_layer_depth(df, KEYS, ["row"], hot_rows=h),
        lambda h: summary.summarize_bgc(df, ["row"], {"TEMP": "mean"}, ["TEMP"], hot_rows=h),
        lambda h: summary.summarize_core(df, ["row"], ["TEMP", "LATITUDE"], hot_rows=h),
        lambda h: summary.summarize_core(df.withColumn("b", F.lit(0)), ["b", "row"] if h == 100 else ["row"],
                                         ["TEMP", "LATITUDE"], hot_rows=h),
    ):
        same(run(100), run(10**9))


def test_counts_are_whole(spark):
    out = profile.with_n_levels(hot_levels(spark), KEYS, ["row"], hot_rows=100)
    counts = {r.PLATFORM_NUMBER: r.n for r in out.groupBy("PLATFORM_NUMBER").agg(F.max("n_levels").alias("n")).collect()}
    assert counts["hot"] == 10_000 and out.count() == 20_000
    assert out.where("CYCLE_NUMBER IS NULL AND n_levels IS NOT NULL").count() == 0


def test_hot_rows_are_spread(spark):
    """With the shuffled join forced, no task holds the hot rows or the null keys."""
    limits = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        df = hot_levels(spark)
        out = profile.with_n_levels(df, KEYS, ["row"], hot_rows=100)
        sizes = [r.n for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 20_000
        assert max(sizes) < 20_000 * 0.25
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_flags(spark):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, F.lit("a")).otherwise(F.lit("b")).alias("float_id"))
    rows = rows.unionByName(spark.createDataFrame([(5000, None)], "id long, float_id string"))
    metadata = spark.createDataFrame([("a",)], "float_id string")
    lost = orphan_readings(rows, metadata)
    assert lost.where("float_id = 'a'").count() == 0
    assert lost.count() == 1000 - 334 + 1
    for hot in (10, 10**6):
        marked = skew.attach_flag(rows, metadata, ["float_id"], "f", ["id"], hot_rows=hot)
        assert "_salt" not in marked.columns and marked.where("f").count() == 334


def test_file_ids(spark):
    rows = spark.createDataFrame(
        [("a_Sprof.csv", 0, " 7 "), ("a_Sprof.csv", 1, "8"), ("b_Sprof.csv", 0, None), ("b_Sprof.csv", 1, "9")],
        "filename string, n int, PLATFORM_NUMBER string")
    for hot in (1, 100):
        got = {(r.filename, r.n): r.float_id for r in resolve_float_id(rows, ["n"], "file", hot_rows=hot).collect()}
        assert got == {("a_Sprof.csv", 0): "7", ("a_Sprof.csv", 1): "7", ("b_Sprof.csv", 0): "b", ("b_Sprof.csv", 1): "b"}
    by_row = [r.float_id for r in resolve_float_id(rows, ["n"]).orderBy("filename", "n").collect()]
    assert by_row == ["7", "8", "b", "9"]
