"""CSV with line breaks in quoted values: in blocks as read whole."""

import random

import pytest
from pyspark.sql import functions as F

from floatlake.sources import csv as source, quoted


def content(rng, rows):
    def value():
        kind = rng.randrange(8)
        if kind == 0:
            return '"' + "\n".join(rng.choice(["a", 'say ""hi""', "", "x,y", "# no"]) for _ in range(rng.randrange(2, 6))) + '"'
        if kind == 1:
            return '"' + "line\n" * rng.choice([1, 30, 400]) + '"'
        return rng.choice(["", "plain", "1.5", '"a,b"', '""', '"q""q"', " spaced "])

    return "A,B,C\n" + "".join(f"{i},{value()},{value()}\n" for i in range(rows))


def whole(spark, path):
    """The file read by one task."""
    df = spark.read.option("header", "true").option("multiLine", "true").option("quote", '"').option("escape", '"').csv(str(path))
    return sorted(map(tuple, df.select("A", "B", "C").collect()), key=repr)


def in_blocks(spark, path, size):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = source.read_mixed_csv(spark, str(path), multi_line=True)
        rows = sorted(map(tuple, df.select("A", "B", "C").collect()), key=repr)
        lines = source.read_lines(spark, str(path))
        tasks = quoted.quoted_records(lines).select(F.spark_partition_id().alias("p")).distinct().count()
        order = [r.A for r in df.orderBy(*source.ROW_ORDER).collect()]
        return rows, tasks, order
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("size", [2_000, 50_000, 10**9])
def test_blocks_give_the_rows_of_the_whole_file(spark, tmp_path, size):
    path = tmp_path / "a.csv"
    path.write_text(content(random.Random(size), 600))
    rows, tasks, order = in_blocks(spark, path, size)
    assert rows == whole(spark, path) and len(rows) == 600
    assert tasks > 3 or size == 10**9
    assert order == [str(i) for i in range(600)]


def test_a_value_longer_than_blocks_and_a_quote_never_closed(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('A,B,C\n1,"' + "long line of it\n" * 3000 + '",2\n3,x,y\n4,"open,5\n6,7\n')
    rows, _, _ = in_blocks(spark, path, 4_000)
    assert rows == [(a, b and b.removesuffix("7\n") + "7" if a == "4" else b, c) for a, b, c in whole(spark, path)]
    assert [r[0] for r in rows] == ["1", "3", "4"] and rows[0][1].count("\n") == 3000


def test_several_files_and_an_empty_one(spark, tmp_path):
    for i, text in enumerate(["A,B,C\n1,\"x\ny\",z\n", "A,B,C\n", "A,B,C\r\n2,\"p\r\nq\",r\r\n\r\n", "A,B,D\n3,a,b\n"]):
        (tmp_path / f"{i}.csv").write_bytes(text.encode())
    df = source.read_mixed_csv(spark, str(tmp_path), multi_line=True)
    found = {r.A: (r.B, r.C, r.D, r.filename) for r in df.collect()}
    assert found == {"1": ("x\ny", "z", None, "0.csv"), "2": ("p\nq", "r", None, "2.csv"), "3": ("a", None, "b", "3.csv")}
