"""Readers, writers and flows on real files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from floatlake.operators.cleaning import clean_table, keep_first_of_duplicates
from floatlake.operators.index import parse_index, rejected_lines
from floatlake.plans import flows, increments
from floatlake.sources import csv as source, sinks
from floatlake.sources.profiles import read_profiles
from floatlake.streaming.ingest import start_load_stream


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


@pytest.fixture()
def tree(tmp_path):
    """Three files: two headers in different column order, one with a repeated column."""
    root = tmp_path / "in"
    put(root / "BCG floats" / "100_Sprof.csv",
        "PLATFORM_NUMBER,JULD,PRES,PROJECT_NAME,EMPTY\n"
        "b'100 ',2025-04-15 07:34:37.000800256,5.0,\"b'P, \"\"Q\"\"'\",\n"
        "b'100 ',2025-04-16 01:00:00,nan,b'P2',\n")
    put(root / "Non-BCG floats" / "2025" / "August" / "20250801_prof.csv",
        "PRES,PLATFORM_NUMBER,CYCLE_NUMBER,TEMP,PRES\n7.5,200,1,20.0,9\n8.5,201,1,NA,9\n")
    put(root / "Non-BCG floats" / "2025" / "August" / "20250802_prof.csv",
        "PRES,PLATFORM_NUMBER,CYCLE_NUMBER,TEMP,PRES\n1.0,200,2,21.0,9\n")
    put(root / "Non-BCG floats" / "skip.txt", "a,b\n1,2\n")
    return str(root)


def test_mixed_headers(spark, tree):
    df = source.read_mixed_csv(spark, tree)
    rows = {(r.filename, r.PLATFORM_NUMBER, r.PRES, r.TEMP) for r in df.collect()}
    assert ("20250801_prof.csv", "200", "7.5", "20.0") in rows
    assert ("100_Sprof.csv", "b'100 '", "5.0", None) in rows
    assert df.count() == 5
    quoted = df.where("filename = '100_Sprof.csv' AND PRES = '5.0'").first().PROJECT_NAME
    assert quoted == "b'P, \"Q\"'"
    assert df.where("TEMP IS NOT NULL").first()._columns == ["PRES", "PLATFORM_NUMBER", "CYCLE_NUMBER", "TEMP", "PRES"]
    with pytest.raises(ValueError):
        source.read_mixed_csv(spark, tree, "*.none")


def test_line_breaks_in_quotes(spark, tmp_path):
    put(tmp_path / "a.csv", 'A,B\n1,"x\ny"\n2,z\n')
    df = source.read_mixed_csv(spark, str(tmp_path), multi_line=True)
    assert [(r.A, r.B) for r in df.orderBy("A").collect()] == [("1", "x\ny"), ("2", "z")]


def test_typed_levels(spark, tree):
    df = source.read_levels_csv(spark, tree)
    types = dict(df.dtypes)
    assert (types["PRES"], types["CYCLE_NUMBER"], types["JULD"], types["PROJECT_NAME"]) == (
        "double", "bigint", "timestamp", "string")
    assert df.where("JULD IS NOT NULL").agg(F.min("JULD")).first()[0] == dt.datetime(2025, 4, 15, 7, 34, 37, 800)
    assert df.where("TEMP IS NULL AND CYCLE_NUMBER = 1").count() == 1


def test_discovery(spark, tree):
    files = source.list_files(spark, tree)
    assert files.count() == 3
    assert files.where("path LIKE '%/BCG floats/%'").count() == 1
    placed = source.with_path_columns(files)
    assert {(r.year, r.month_name) for r in placed.collect()} == {(2025, "August")}
    assert placed.count() == 2


def test_row_order(spark, tmp_path):
    put(tmp_path / "a.csv", "n\n" + "\n".join(str(i) for i in range(5000)) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        df = source.read_strings_csv(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 1
        ordered = [int(r.n) for r in df.orderBy(*source.ROW_ORDER).select("n").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert ordered == list(range(5000))


def test_index_file(spark, tmp_path):
    good = "aoml/1900722/profiles/BD1900722_001.nc,20250801053000,-12.5,78.25,I,846,IF,PRES,RRD,20250802"
    path = put(tmp_path / "index.txt", f"# title\nfile,date,latitude,x\n\n  {good},extra \n1,2\n{good.replace('-12.5', 'bad')}\n")
    lines = source.read_index(spark, path)
    row = parse_index(lines).collect()
    assert [(r.platform_number, r.latitude, r.longitude, r.date_update) for r in row] == [
        ("1900722", -12.5, 78.25, "20250802")]
    assert {r.reason for r in rejected_lines(lines).collect()} == {"too few fields", "latitude is not a number"}


def test_platform_list(spark, tmp_path):
    assert source.read_platform_list(spark, str(tmp_path / "none")).count() == 0
    path = put(tmp_path / "list.csv", "platform_number\n0012\n0012\n\n77\n")
    assert sorted(r[0] for r in source.read_platform_list(spark, path).collect()) == ["0012", "77"]
    assert source.read_platform_list(spark, put(tmp_path / "x.csv", "other\n1\n")).count() == 0
    out = str(tmp_path / "stored")
    found = spark.createDataFrame([("9",), ("8",), (None,)], "platform_number string")
    for _ in range(2):
        listed = flows.update_platform_list(spark, found, out)
    assert [r[0] for r in listed.collect()] == ["8", "9"]


def test_clean_table(spark, tree):
    df = clean_table(source.read_strings_csv(spark, tree), source.FILE_COLUMNS)
    assert "EMPTY" not in df.columns and "JULD" not in df.columns
    assert {"JULD_DATE", "JULD_TIME"} <= set(df.columns)
    row = df.where("filename = '100_Sprof.csv' AND PRES = '5.0'").first()
    assert (row.PLATFORM_NUMBER, row.PROJECT_NAME, row.JULD_DATE) == ("100 ", 'P, "Q"', "2025-04-15")
    twice = spark.createDataFrame([(1, 2, 3)], ["a", "b", "A"])
    assert keep_first_of_duplicates(twice).columns == ["a", "b"]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(2025, 8, "a\"b"), (2025, 9, "c")], "year int, month int, v string")
    out = str(tmp_path / "months")
    sinks.write_by_month(df, out)
    sinks.write_by_month(df.where("month = 9").withColumn("v", F.lit("new")), out)
    got = {(r.year, r.month_name, r.v) for r in spark.read.parquet(out).collect()}
    assert got == {(2025, "August", 'a"b'), (2025, "September", "new")}
    assert (tmp_path / "months" / "year=2025" / "month_name=August").is_dir()
    sinks.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", "true").option("escape", '"').csv(str(tmp_path / "csv")).where("v = 'a\"b'").count() == 1
    options = sinks.jdbc_options("jdbc:postgresql://host/db", "readings", user="me")
    assert options["batchsize"] == "30000" and options["dbtable"] == "readings"


def test_mirrored(spark, tree, tmp_path):
    out = tmp_path / "mirror"
    sinks.write_mirrored(source.read_strings_csv(spark, tree), tree, str(out))
    folders = {p.name for p in out.iterdir() if p.is_dir()}
    assert any("August" in f for f in folders) and any("BCG floats" in f or "BCG%20floats" in f for f in folders)
    assert spark.read.option("header", "true").csv(str(out)).count() == 5


def test_load_flow(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    first = flows.run_load(spark, tree, out, 1)
    readings = spark.read.parquet(first["readings"])
    # Non-null cells per row: 5 and 4 in the first file, 4, 3 and 4 in the others.
    assert readings.count() == readings.select("id").distinct().count() == 5 + 4 + 4 + 3 + 4
    row = readings.where("float_id = '100' AND parameter_name = 'PRES'").first()
    assert (row.value, row.JULD_DATE, row.JULD_TIME, row.float_type) == ("5.0", dt.date(2025, 4, 15), "07:34:37", "BCG")
    metadata = {r.float_id: r for r in spark.read.parquet(first["metadata"]).collect()}
    assert set(metadata) == {"100", "200", "201"}
    assert metadata["100"].last_reading_date == dt.date(2025, 4, 16)
    assert set(metadata["100"].all_columns) == {"PLATFORM_NUMBER", "PRES", "PROJECT_NAME", "JULD_DATE", "JULD_TIME"}
    # Nothing new: nothing is done.
    assert flows.run_load(spark, tree, out, 2) == {}
    # A later file: only it is loaded, and the metadata is carried over.
    put(tmp_path / "in" / "BCG floats" / "late" / "100_Sprof.csv",
        "PLATFORM_NUMBER,JULD,PROJECT_NAME\n100,2025-01-01 00:00:00,other\n")
    third = flows.run_load(spark, tree, out, 3)
    assert spark.read.parquet(third["readings"]).count() == 4
    again = {r.float_id: r for r in spark.read.parquet(third["metadata"]).collect()}
    assert set(again) == {"100", "200", "201"}
    assert again["100"].last_reading_date == dt.date(2025, 1, 1)
    assert again["100"].project_name == metadata["100"].project_name


def test_repeated_run_replaces_itself(spark, tree, tmp_path, monkeypatch):
    out = str(tmp_path / "out")

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(flows, "finish_run", lost)
        with pytest.raises(RuntimeError):
            flows.run_load(spark, tree, out, 1)
    n = spark.read.parquet(f"{out}/readings/run_id=1").count()
    assert increments.read_finished(spark, f"{out}/readings", f"{out}/manifest").count() == 0
    assert flows.run_load(spark, tree, out, 1)
    assert spark.read.parquet(f"{out}/readings").count() == n
    assert increments.read_finished(spark, f"{out}/readings", f"{out}/manifest").count() == n


def test_core_flow(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    header = "PLATFORM_NUMBER,CYCLE_NUMBER,JULD,LATITUDE,LONGITUDE,PRES,TEMP,PRES_ADJUSTED_ERROR\n"
    put(root / "2025" / "August" / "20250801_prof.csv", header + "".join(
        f"b'1',1,2025-08-01 06:00:00,15.0,65.0,{p},{t},2.4\n" for p, t in ((5, 28.0), (10, 28.2), (20, 28.0), (30, 27.8))))
    put(root / "2025" / "July" / "20250701_prof.csv", header + "1,1,2025-07-01,15,65,5,28,2\n")
    put(root / "old" / "20250801_prof.csv", header + "9,1,2025-08-01,15,65,5,28,2\n")
    flows.run_core(spark, out, 1, str(root))
    rows = {r.month_name: r for r in spark.read.parquet(f"{out}/summary").collect()}
    assert set(rows) == {"August", "July"}
    august = rows["August"]
    assert (august.n_levels, august.mixed_layer_depth_m, august.avg_REGION, august.ocean) == (
        4, 30.0, "Arabian Sea", "Indian Ocean")
    assert august.PRES_ADJUSTED_ERROR == 2.4 and august.PRES_ADJUSTED_ERROR_min is None
    assert flows.run_core(spark, out, 2, str(root)) == {}
    put(root / "2025" / "August" / "20250802_prof.csv", header + "2,1,2025-08-02 06:00:00,15,65,5,28,2\n")
    flows.run_core(spark, out, 3, str(root))
    table = spark.read.parquet(f"{out}/summary")
    assert table.where("month_name = 'August'").count() == 2 and table.where("month_name = 'July'").count() == 1


def test_bgc_flow(spark, tmp_path):
    out = str(tmp_path / "out")
    good = "aoml/1900722/profiles/BD1900722_001.nc,20250801053000,-12.5,78.25,I,846,IF,PRES,RRD,20250802"
    index = put(tmp_path / "index.txt", good + "\n" + good.replace(",I,", ",P,").replace("1900722", "1900999") + "\n")
    profiles = spark.createDataFrame(
        [("f1", 0, "1900722", 1, 27500.25, -12.5, 78.25, [5.0, 10.0, 20.0, 30.0], [28.0, 28.2, 28.0, 27.8],
          ["b'1'", "b'2'", "b'1'", "b'2'"], ["R", "D"], "IF")],
        "file string, prof_idx int, PLATFORM_NUMBER string, CYCLE_NUMBER bigint, JULD double, LATITUDE double, "
        "LONGITUDE double, PRES array<double>, TEMP array<double>, PRES_QC array<string>, "
        "PARAMETER_DATA_MODE array<string>, DATA_CENTRE string")
    profiles.write.parquet(str(tmp_path / "profiles"))
    written = flows.run_bgc(spark, out, 1, index, str(tmp_path / "profiles"), 2025, [8])
    assert [r[0] for r in spark.read.parquet(written["platforms"]).collect()] == ["1900722"]
    row = spark.read.parquet(written["summary"]).first()
    assert (row.JULD, row.n_levels, row.mixed_layer_depth_m) == (dt.date(2025, 4, 17), 4, 30.0)
    assert (row.PRES_QC, row.PRES_QC_mean, row.PARAMETER_DATA_MODE, row.DATA_CENTRE, row.ocean) == ("1", 1.5, "R", "IF", "Indian Ocean")
    counters = spark.read.parquet(written["counters"]).first()
    assert (counters.rows, counters.errors) == (4, 0) and counters.files >= 1
    assert flows.run_bgc(spark, out, 2, index, str(tmp_path / "profiles"), 2025, [8], steps=("levels", "summary")) == {}
    with pytest.raises(ValueError):
        read_profiles(spark, str(tmp_path), "json")


def test_stream_loads_each_file_once(spark, tree, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    start_load_stream(spark, tree, out, check).awaitTermination()
    n = spark.read.parquet(f"{out}/readings").count()
    assert n > 0
    start_load_stream(spark, tree, out, check).awaitTermination()
    assert spark.read.parquet(f"{out}/readings").count() == n
    put(tmp_path / "in" / "BCG floats" / "300_Sprof.csv", "PLATFORM_NUMBER,PRES\n300,1\n")
    start_load_stream(spark, tree, out, check).awaitTermination()
    assert spark.read.parquet(f"{out}/readings").count() == n + 2
    latest = increments.previous_run(spark, f"{out}/manifest")
    floats = spark.read.parquet(f"{out}/metadata/run_id={latest}")
    assert {r.float_id for r in floats.collect()} == {"100", "200", "201", "300"}


def test_rejects_are_kept_apart(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    put(root / "1_Sprof.csv", "PRES,JULD\n1,2025-01-01 10:00:00\n2,2025-99-01 10:00:00\n3,2025-01-01 25:61:00\n4,\n")
    written = flows.run_load(spark, str(root), out, 1)
    reasons = {r.PRES: r.reason for r in spark.read.parquet(written["rejects"]).collect()}
    assert reasons == {"2": "date cannot be read", "3": "time cannot be read"}
    pres = spark.read.parquet(written["readings"]).where("parameter_name = 'PRES'")
    assert sorted(r.value for r in pres.collect()) == ["1", "4"]
    assert spark.read.parquet(written["metadata"]).first().float_id == "1"


def test_ids_do_not_depend_on_other_files(spark, tmp_path):
    root = tmp_path / "in"
    body = "PRES,TEMP\n" + "".join(f"{i},{i}\n" for i in range(50))
    put(root / "b_Sprof.csv", body)
    first = flows.run_load(spark, str(root), str(tmp_path / "one"), 1, stable_ids=True)
    put(root / "a_Sprof.csv", body * 3)
    second = flows.run_load(spark, str(root), str(tmp_path / "two"), 1, stable_ids=True)
    once, both = (spark.read.parquet(w["readings"]) for w in (first, second))
    assert once.join(both.select("id"), "id").count() == once.count() == 100
    store = str(tmp_path / "store")
    for _ in range(2):
        sinks.append_readings(once, store, dedupe=True)
    assert spark.read.parquet(store).count() == 100
    sinks.append_readings(both, store, dedupe=True)
    assert spark.read.parquet(store).count() == both.count()


def test_tagging_goes_to_a_new_table(spark, tmp_path):
    source_path, target = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([(15.0, 65.0)], "LATITUDE double, LONGITUDE double").write.parquet(source_path)
    assert flows.tag_summaries(spark, source_path, target)
    assert spark.read.parquet(target).first().avg_REGION == "Arabian Sea"
    assert not flows.tag_summaries(spark, target, source_path)


CORE_HEADER = "PLATFORM_NUMBER,CYCLE_NUMBER,JULD,LATITUDE,LONGITUDE,PRES,TEMP,NITRATE_ADJUSTED_ERROR\n"


def core_file(root, name, platform="1"):
    return put(root / "2025" / "August" / name, CORE_HEADER + "".join(
        f"{platform},1,2025-08-01 06:00:00,15,65,{p},28,{p}\n" for p in (5, 15, 25)))


def cut_short(monkeypatch, run, *args):
    """Run a flow that dies just before it is recorded."""
    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(flows, "finish_run", lost)
        with pytest.raises(RuntimeError):
            run(*args)


def test_cut_short_core_run_is_not_counted_twice(spark, tmp_path, monkeypatch):
    root, out = tmp_path / "in", str(tmp_path / "out")
    core_file(root, "20250801_prof.csv")
    cut_short(monkeypatch, flows.run_core, spark, out, 1, str(root))
    flows.run_core(spark, out, 2, str(root))
    row = spark.read.parquet(f"{out}/summary").first()
    assert (row.n_levels, row.row_count) == (3, 3)
    assert (row.NITRATE_ADJUSTED_ERROR_min, row.NITRATE_ADJUSTED_ERROR_max, row.NITRATE_ADJUSTED_ERROR_mean) == (5.0, 25.0, 15.0)


def test_repeated_core_run_leaves_nothing_stale(spark, tmp_path, monkeypatch):
    root, out = tmp_path / "in", str(tmp_path / "out")
    core_file(root, "20250801_prof.csv")
    other = put(root / "2024" / "July" / "20240701_prof.csv", CORE_HEADER + "7,1,2024-07-01,15,65,5,28,2\n")
    cut_short(monkeypatch, flows.run_core, spark, out, 1, str(root))
    import os

    os.remove(other)
    flows.run_core(spark, out, 1, str(root))
    assert {r.PLATFORM_NUMBER for r in increments.read_finished(spark, f"{out}/levels", f"{out}/manifest").collect()} == {"1"}


def test_repeated_load_leaves_nothing_stale(spark, tmp_path, monkeypatch):
    import os

    root, out = tmp_path / "in", str(tmp_path / "out")
    old = put(root / "1_Sprof.csv", "PRES,JULD\n1,2024-01-01 10:00:00\n")
    put(root / "2_Sprof.csv", "PRES,JULD\n2,2025-01-01 10:00:00\n")
    cut_short(monkeypatch, flows.run_load, spark, str(root), out, 1)
    os.remove(old)
    flows.run_load(spark, str(root), out, 1)
    found = increments.read_finished(spark, f"{out}/readings", f"{out}/manifest")
    assert {r.float_id for r in found.collect()} == {"2"}


def test_two_streams_and_a_batch_share_an_output(spark, tmp_path):
    out = str(tmp_path / "out")
    for name in ("a", "b"):
        put(tmp_path / name / f"{name}_Sprof.csv", "PRES\n1\n2\n")
        start_load_stream(spark, str(tmp_path / name), out, str(tmp_path / f"check-{name}")).awaitTermination()
    found = increments.read_finished(spark, f"{out}/readings", f"{out}/manifest")
    assert {r.float_id for r in found.collect()} == {"a", "b"} and found.count() == 4
    # A new checkpoint, and a batch run, find nothing left to do.
    start_load_stream(spark, str(tmp_path / "a"), out, str(tmp_path / "check-new")).awaitTermination()
    assert flows.run_load(spark, [str(tmp_path / "a"), str(tmp_path / "b")], out, 1) == {}
    put(tmp_path / "a" / "c_Sprof.csv", "PRES\n3\n")
    assert flows.run_load(spark, str(tmp_path / "a"), out, 2)
    start_load_stream(spark, str(tmp_path / "a"), out, str(tmp_path / "check-a")).awaitTermination()
    assert increments.read_finished(spark, f"{out}/readings", f"{out}/manifest").count() == 5
    assert spark.read.parquet(f"{out}/metadata/run_id=2").count() == 3


def test_core_rejects_are_listed_and_not_recorded(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    core_file(root, "20250801_prof.csv")
    put(root / "20250802_prof.csv", CORE_HEADER + "8,1,2025-08-01,15,65,5,28,2\n")
    put(root / "2025" / "Augustus" / "20250803_prof.csv", CORE_HEADER + "9,1,2025-08-01,15,65,5,28,2\n")
    written = flows.run_core(spark, out, 1, str(root))
    reasons = {r.path.split("/")[-1]: r.reason for r in spark.read.parquet(written["rejects"]).collect()}
    assert reasons == {"20250802_prof.csv": "not below a <year>/<month>/ folder", "20250803_prof.csv": "month folder is not known"}
    assert increments.read_manifest(spark, f"{out}/manifest").count() == 1
    counters = spark.read.parquet(written["counters"]).first()
    assert (counters.files, counters.rows, counters.errors) == (1, 3, 2)


def test_load_counters(spark, tree, tmp_path):
    written = flows.run_load(spark, tree, str(tmp_path / "out"), 1)
    row = spark.read.parquet(written["counters"]).first()
    assert (row.files, row.rows, row.errors, row.bgc_readings, row.core_readings) == (3, 5, 0, 9, 11)
    assert row.average_columns >= 4


def test_pattern_characters_in_names(spark, tmp_path):
    root = tmp_path / "in [1]"
    for name in ("a[1]_Sprof.csv", "b{x}_Sprof.csv", "c_Sprof.csv"):
        put(root / name, "PRES,pres\n1,2\n")
    df = source.read_mixed_csv(spark, source.escaped(str(root)))
    assert {r.filename for r in df.collect()} == {"a[1]_Sprof.csv", "b{x}_Sprof.csv", "c_Sprof.csv"}
    assert df.columns[:2] == ["PRES", "pres_2"] and df.first().pres_2 == "2"


def test_header_pass_keeps_first_blocks_only(spark, tmp_path):
    put(tmp_path / "a.csv", "n\n" + "\n".join(str(i) for i in range(5000)) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        lines = source.with_row_order(spark.read.text(str(tmp_path)).where(F.col("_metadata.file_block_start") == 0))
        assert 0 < lines.count() < 2500
        assert source.headers_of(spark, str(tmp_path))[0][0] == "n"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_summary_schema_does_not_depend_on_content(spark, tmp_path):
    out = str(tmp_path / "out")
    for run, flag in ((1, "5"), (2, "good")):
        profiles = spark.createDataFrame(
            [(f"f{run}", 0, "1", 1, 27500.25, [5.0, 10.0], [28.0, 28.2], [flag, flag])],
            "file string, prof_idx int, PLATFORM_NUMBER string, CYCLE_NUMBER bigint, JULD double, PRES array<double>, "
            "TEMP array<double>, FLAG array<string>")
        profiles.write.mode("append").parquet(str(tmp_path / "profiles"))
        flows.run_bgc(spark, out, run, profiles=str(tmp_path / "profiles"), steps=("levels", "summary"))
    rows = {r.file: (r.FLAG, r.FLAG_mean) for r in spark.read.parquet(f"{out}/summary").collect()}
    assert rows == {"f1": ("5", 5.0), "f2": ("good", None)}


def test_bad_bytes_become_text(spark):
    from floatlake.functions.text import join_chars
    from floatlake.operators.flatten import flatten_profiles

    df = spark.createDataFrame([("f", 0, bytearray(b"a\xffb"), [1.0])], "file string, prof_idx int, NAME binary, PRES array<double>")
    assert flatten_profiles(df, ["file", "prof_idx"]).first().NAME == "ab"
    chars = spark.createDataFrame([([bytearray(b"A"), bytearray(b"\xff"), bytearray(b"B ")],)], "c array<binary>")
    assert chars.select(join_chars("c", True)).first()[0] == "AB"


def test_date_range_reads_its_years_only(spark, tree, tmp_path):
    from floatlake.operators.readings import readings_between

    written = flows.run_load(spark, tree, str(tmp_path / "out"), 1)
    found = readings_between(spark.read.parquet(written["readings"]), "2025-04-01", "2025-04-30")
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "year" in filters and found.count() == 9


def test_cleaned_tree(spark, tree, tmp_path):
    out = flows.run_clean(spark, tree, str(tmp_path / "clean"))
    files = [p for p in (tmp_path / "clean").rglob("*.csv") if p.is_file()]
    assert len(files) == 3
    heads = {p.parent.name.split("=")[-1]: p.read_text().splitlines()[0].split(",") for p in files}
    assert "EMPTY" not in heads["100_Sprof.csv"] and "JULD_DATE" in heads["100_Sprof.csv"]
    assert "PROJECT_NAME" not in heads["20250801_prof.csv"]
    assert spark.read.option("header", "true").csv(out).count() == 5


MONTHLY_HEADER = "PLATFORM_NUMBER,CYCLE_NUMBER,JULD,LATITUDE,LONGITUDE,PRES,TEMP,DATA_CENTRE,PRES_ADJUSTED_ERROR"


def monthly_files(kinds):
    """Daily files of two months; profiles 3 and 4 are cut over two files each."""
    import random

    rng = random.Random(len(kinds))
    for day, (month, name, more) in enumerate(kinds):
        lines = [MONTHLY_HEADER + (",PSAL" if more else "")]
        for platform in (day, 100 + day % 3):
            for level in range(12):
                pres, temp = 4 * level + 4 * 12 * (day % 2) * (platform >= 100), 28 - level * rng.random() / 8
                lines.append(f"{platform},1,{name[:4]}-{month}-01 06:00:00,15,65,{pres},{temp},{'IN' if level % 4 else ''},{rng.choice([2, 3])}" + (f",{34 + level}" if more else ""))
        yield f"{name[:4]}/{ {'07': 'July', '08': 'August'}[month] }/{name}", "\n".join(lines) + "\n"


KINDS = [("07", "20250701_prof.csv", False), ("08", "20250801_prof.csv", False), ("08", "20250802_prof.csv", True), ("07", "20250703_prof.csv", False), ("08", "20250804_prof.csv", True)]


def by_column(df):
    names = sorted(c for c in df.columns)
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*names).collect()), key=repr), names


@pytest.mark.parametrize("damage", [True, False])
def test_summaries_are_kept_up_over_runs(spark, tmp_path, damage):
    """Run after run gives what one run gives, from kept states: old level files may be unreadable."""
    whole, root, out = tmp_path / "whole", tmp_path / "in", str(tmp_path / "out")
    for run, (path, text) in enumerate(monthly_files(KINDS), 1):
        put(whole / path, text)
        put(root / path, text)
        flows.run_core(spark, out, run, str(root))
        if damage:
            for file in (tmp_path / "out" / "levels" / f"run_id={run}").rglob("*.parquet"):
                file.write_bytes(b"no parquet file any more")
    flows.run_core(spark, str(tmp_path / "once"), 1, str(whole))
    found, once = spark.read.parquet(f"{out}/summary"), spark.read.parquet(f"{tmp_path}/once/summary")
    assert by_column(found) == by_column(once)
    assert found.where("PSAL IS NOT NULL").count() > 0


def test_other_profile_columns_bring_the_levels_back(spark, tmp_path):
    whole, root, out = tmp_path / "whole", tmp_path / "in", str(tmp_path / "out")
    files = list(monthly_files(KINDS[1:3]))
    files[1] = files[1][0], files[1][1].replace("CYCLE_NUMBER", "CYCLE_NUMBER,FLOAT_SERIAL_NO", 1).replace(",1,2025", ",1,s7,2025")
    for run, (path, text) in enumerate(files, 1):
        put(whole / path, text)
        put(root / path, text)
        flows.run_core(spark, out, run, str(root))
    flows.run_core(spark, str(tmp_path / "once"), 1, str(whole))
    assert by_column(spark.read.parquet(f"{out}/summary")) == by_column(spark.read.parquet(f"{tmp_path}/once/summary"))


def test_core_flow_by_file_name(spark, tmp_path):
    """The date in the name places a file, whatever its folder; names without one are rejects."""
    root, out = tmp_path / "in", str(tmp_path / "out")
    put(root / "any" / "20250801_prof.csv", CORE_HEADER + "7,1,2025-08-01,15,65,5,28,2\n")
    put(root / "2020" / "May" / "20250701_prof.csv", CORE_HEADER + "8,1,2025-07-01,15,65,5,28,2\n")
    put(root / "any" / "undated_prof.csv", CORE_HEADER + "9,1,2025-07-01,15,65,5,28,2\n")
    written = flows.run_core(spark, out, 1, str(root), by="filename")
    rows = {(r.year, r.month_name): r.PLATFORM_NUMBER for r in spark.read.parquet(f"{out}/summary").collect()}
    assert rows == {(2025, "August"): "7", (2025, "July"): "8"}
    rejects = spark.read.parquet(written["rejects"]).collect()
    assert [(r.path.rsplit("/", 1)[1], r.reason) for r in rejects] == [("undated_prof.csv", "no date in the file name")]
    with pytest.raises(ValueError):
        flows.run_core(spark, out, 2, str(root), by="date")


def test_equal_file_names_in_two_folders_are_two_files(spark, tmp_path):
    for kind, project in (("BCG floats", "a"), ("Non-BCG floats", "b")):
        put(tmp_path / kind / "1_Sprof.csv", f"PLATFORM_NUMBER,PROJECT_NAME\n1,{project}\n")
    clean = source.read_strings_csv(spark, str(tmp_path))
    found = flows.load_tables(clean, source.ROW_ORDER)[1].collect()
    assert sorted((r.float_type, r.project_name) for r in found) == [("BCG", "a"), ("NON-BCG", "b")]


def test_profiles_with_unknown_variables(spark, tmp_path):
    """Files with different variables, classified per file, become one table of levels."""
    from floatlake.operators.flatten import flatten_profiles

    put(tmp_path / "a.json", '{"ID": 1, "PRES": [5, 10.5], "TEMP": [28.0, 27], "PLATFORM_NUMBER": "19", "it\'s": [1, 2], "deep": {"x": 1}}\nno json\n[1]\n')
    put(tmp_path / "b.json", '{"ID": 2, "PRES": 7, "DOXY": [[200, 201], [202]], "PLATFORM_NUMBER": 20, "NOTE": null}\n{"ID": 3, "DOXY": [205], "NOTE": null}\n')
    put(tmp_path / "c.json", "\n")
    found = read_profiles(spark, str(tmp_path), "json", discover=True)
    assert dict(found.dtypes) == {
        "ID": "bigint", "PRES": "array<double>", "TEMP": "array<double>", "DOXY": "array<array<bigint>>", "PLATFORM_NUMBER": "string",
        "NOTE": "string", "it's": "array<bigint>",
    }
    rows = {r.ID: r for r in found.collect()}
    assert rows[1].PRES == [5.0, 10.5] and rows[2].PRES == [7.0] and rows[3].PRES is None
    assert rows[2].DOXY == [[200, 201], [202]] and rows[3].DOXY == [[205]]
    assert (rows[1].PLATFORM_NUMBER, rows[2].PLATFORM_NUMBER) == ("19", "20") and rows[1]["it's"] == [1, 2]
    levels = flatten_profiles(found, ["ID"]).collect()
    assert sorted((r.ID, r.level_idx, r.PRES, r.TEMP) for r in levels) == [(1, 0, 5.0, 28.0), (1, 1, 10.5, 27.0), (2, 0, 7.0, None)]
    assert read_profiles(spark, str(tmp_path), "json", discover=True, with_files=True).select("path").distinct().count() == 2
    with pytest.raises(ValueError):
        read_profiles(spark, str(tmp_path), "parquet", discover=True)
