"""Metadata by touched bucket, writers beside each other, and floats by column."""

import json
import threading

import pytest
from pyspark.sql import functions as F, types as T

from floatlake.operators import readings
from floatlake.plans import buckets, flows

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def replace(existing, incoming):
    return existing.join(incoming.select("k"), "k", "left_anti").select("k", "v").unionByName(incoming)


def rows(spark, **values):
    return spark.createDataFrame(sorted(values.items()), SCHEMA)


def held(table):
    return {r.k: r.v for r in table.read().collect()}


def key_in_other_bucket(spark, table, than):
    one = spark.createDataFrame([(f"x{i}", i) for i in range(50)], SCHEMA).withColumn("b", table.bucket())
    own = rows(spark, **{than: 1}).select(table.bucket()).first()[0]
    return next(r.k for r in one.collect() if r.b != own)


def test_an_upsert_writes_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    table = buckets.BucketTable(spark, path, SCHEMA, "k", 16)
    assert table.read().count() == 0 and table.upsert(rows(spark).limit(0), replace, "none") == []
    table.upsert(spark.createDataFrame([(f"k{i}", i) for i in range(200)], SCHEMA), replace, "first")
    before = table.versions()
    assert len(before) == 16 and len(held(table)) == 200
    touched = table.upsert(rows(spark, k7=700), replace, "second")
    after = buckets.BucketTable(spark, path, SCHEMA, "k", 99).versions()
    assert len(touched) == 1 and {b for b in after if after[b] != before[b]} == set(touched)
    files = [f for f in (tmp_path / "t" / "data" / f"version={after[touched[0]]}").rglob("*.parquet")]
    assert {f.parent.name for f in files} == {f"bucket={touched[0]}"}
    assert held(table) == {f"k{i}": 700 if i == 7 else i for i in range(200)}
    # The number of buckets stays that of the first commit, whatever a reader says.
    assert buckets.BucketTable(spark, path, SCHEMA, "k", 99).get(["k7", "k8"]).count() == 2
    table.vacuum()
    assert held(table) == {f"k{i}": 700 if i == 7 else i for i in range(200)}


def test_a_bucket_can_become_empty(spark, tmp_path):
    table = buckets.BucketTable(spark, str(tmp_path / "t"), SCHEMA, "k", 4)
    table.upsert(rows(spark, a=1), replace, "x")
    assert table.upsert(rows(spark, a=1), lambda old, new: old.limit(0), "y") and held(table) == {} and table.versions() == {}


def test_a_writer_cut_short_leaves_the_old_version(spark, tmp_path, monkeypatch):
    table = buckets.BucketTable(spark, str(tmp_path / "t"), SCHEMA, "k", 4)
    table.upsert(rows(spark, a=1, b=2), replace, "x")

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(table, "_create", lost)
        table.upsert(rows(spark, a=9), replace, "y")
    assert held(table) == {"a": 1, "b": 2}
    # A commit whose file was not finished is none, and its number stays taken.
    (tmp_path / "t" / "commits" / f"{2:012d}").write_text('{"buckets": {"0"')
    assert held(table) == {"a": 1, "b": 2}
    table.upsert(rows(spark, a=5), replace, "z")
    assert held(table) == {"a": 5, "b": 2}
    assert json.loads((tmp_path / "t" / "commits" / f"{3:012d}").read_text())["count"] == 4


def test_writers_of_one_bucket_conflict_and_others_do_not(spark, tmp_path):
    path = str(tmp_path / "t")
    table, other = (buckets.BucketTable(spark, path, SCHEMA, "k", 16) for _ in range(2))
    table.upsert(rows(spark, a=1), replace, "x")
    far = key_in_other_bucket(spark, table, "a")

    def meanwhile(value):
        def merge(existing, incoming):
            other.upsert(rows(spark, **value), replace, "other")
            return replace(existing, incoming)
        return merge

    with pytest.raises(buckets.Conflict):
        table.upsert(rows(spark, a=2), meanwhile({"a": 3}), "y")
    assert held(table) == {"a": 3}
    table.upsert(rows(spark, a=4), meanwhile({far: 5}), "y")
    assert held(table) == {"a": 4, far: 5}


def test_commit_numbers_are_taken_once(spark, tmp_path):
    table = buckets.BucketTable(spark, str(tmp_path / "t"), SCHEMA, "k", 4)
    won = []
    threads = [threading.Thread(target=lambda: won.append(table._create(1, {"buckets": {}}))) for _ in range(8)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert sorted(won) == [False] * 7 + [True]


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_loads_with_buckets_match_whole_ones(spark, tmp_path):
    root, whole, parts = tmp_path / "in", str(tmp_path / "whole"), str(tmp_path / "parts")
    for i in range(30):
        put(root / "BCG floats" / f"{i}_Sprof.csv", f"PLATFORM_NUMBER,PRES,JULD\n{i},5,2025-01-0{i % 9 + 1} 00:00:00\n")
    for run in (1, 2):
        flows.run_load(spark, str(root), whole, run)
        flows.run_load(spark, str(root), parts, run, buckets=64)
        table = flows.metadata_table(spark, parts)
        a = spark.read.parquet(f"{whole}/metadata/run_id={run}").select(*table.read().columns)
        assert a.exceptAll(table.read()).count() == table.read().exceptAll(a).count() == 0 and a.count() == 30
        having = lambda out, *c: {r.float_id for r in flows.floats_having(spark, out, list(c)).collect()}
        for out in (whole, parts):
            assert having(out, "PRES", "JULD_DATE") == ({str(i) for i in range(30)} - ({"7"} if run == 2 else set()))
            assert having(out, "DOXY") == ({"7"} if run == 2 else set()) and having(out, "DOXY", "PRES") == set()
        if run == 1:
            before = table.versions()
            put(root / "BCG floats" / "late" / "7_Sprof.csv", "PLATFORM_NUMBER,DOXY\n7,200\n")
    after = table.versions()
    # A load of one file has written one bucket.
    assert sum(after[b] != before.get(b) for b in after) == 1


def test_postings_are_read_by_column(spark, tmp_path):
    rows = [("PRES", f"f{i}", True, 1) for i in range(50)] + [("TEMP", "f1", True, 1), ("PRES", "f2", False, 2)]
    df = spark.createDataFrame(rows, "column string, float_id string, present boolean, seq long")
    flows.write_postings(df, str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    found = readings.floats_with_columns(stored, ["TEMP", "PRES", "PRES"])
    assert [r.float_id for r in found.collect()] == ["f1"]
    plan = readings.floats_with_columns(stored, ["TEMP"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(column" in plan or "PartitionFilters: [column" in plan
    assert readings.floats_with_columns(stored, ["PRES"]).where(F.col("float_id") == "f2").count() == 0
