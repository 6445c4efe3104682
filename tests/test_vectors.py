"""Hand-computed cases."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from floatlake import functions as fl
from floatlake.operators import profile
from floatlake.operators.summary import grouping_columns

NAN, INF = math.nan, math.inf


def evaluate(spark, values, make, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r[1] for r in df.select("i", make(F.col("v")).alias("r")).orderBy("i").collect()]


LAYERS = [
    ([5, 10, 20, 30], [28.0, 28.2, 28.0, 27.8], 28.0667, 30, 30),
    ([30, 5, 20, 10], [27.8, 28.0, 28.0, 28.2], 28.0667, 30, 30),
    ([15, 25, 40], [20.0, 19.5, 19.0], 20.0, 25, 25),
    ([5, 10, 20], [28.0, 28.0, 28.0], 28.0, None, None),
    ([5, 10], [28.0, 27.0], 27.5, None, None),
    ([25, 40, 60], [20.0, 19.0, 18.0], None, 40, 40),
    ([-5, 5, 10, 30], [20.0, 28.0, 28.0, 27.0], 28.0, 30, -5),
    ([5, 10, 30, None], [28.0, 28.0, 27.0, 25.0], 28.0, 30, 30),
    ([5, 10, 30, NAN], [28.0, 28.0, 27.0, 25.0], 28.0, 30, 30),
    ([5, 10, INF, 30], [28.0, 28.0, 10.0, 27.0], 28.0, 30, 30),
    ([15, 15, 25, 40], [21.0, 20.0, 20.1, 19.0], 20.5, 15, 15),
]


@pytest.mark.parametrize("mode", ["bgc", "core"])
def test_layers(spark, mode):
    rows = [
        (case, i, None if p is None else float(p), t)
        for case, (pres, temp, *_) in enumerate(LAYERS)
        for i, (p, t) in enumerate(zip(pres, temp))
    ]
    df = spark.createDataFrame(rows, "k int, i int, PRES double, TEMP double")
    got = {r.k: r for r in profile.profile_metrics(df, ["k"], ["i"], mode).collect()}
    alone = {r.k: r for r in profile.mixed_layer_depth(df, ["k"], ["i"], mode).collect()}
    for case, (_, _, surface, bgc, core) in enumerate(LAYERS):
        expected = bgc if mode == "bgc" else core
        assert got[case].mixed_layer_depth_m == expected, case
        assert alone[case].mixed_layer_depth_m == expected, case
        if surface is None:
            assert got[case].surface_temp_C is None
        else:
            assert got[case].surface_temp_C == pytest.approx(surface, abs=1e-4)


def test_n_levels(spark):
    pres = [5.0, 99999.0, -10.0, -9.9, None, NAN, INF]
    df = spark.createDataFrame([(1, i, p) for i, p in enumerate(pres)] + [(None, 9, 5.0)],
                               "k int, i int, PRES double")
    out = profile.with_n_levels(df, ["k"], ["i"])
    assert {(r.k, r.n_levels) for r in out.collect()} == {(1, 2), (None, None)}
    assert profile.n_levels_range(out).first() == (2, 2)


def test_depth(spark):
    df = spark.createDataFrame([(1, p) for p in (-1.0, 0.0, 10.0, 13000.0)], "k int, PRES double")
    bgc = profile.depth_stats(df, ["k"], "bgc").first()
    core = profile.depth_stats(df, ["k"], "core").first()
    assert bgc[1:3] == (0.0, 13000.0) and bgc[3] == pytest.approx(4336.6667, abs=1e-3)
    assert core[1:] == (0.0, 10.0, 5.0)


REGIONS = [
    (15.0, 65.0, "Arabian Sea", "Arabian Sea"),
    (15.0, 38.0, "Red Sea", "Red Sea"),
    (29.0, 35.0, "Red Sea", "Red Sea"),
    (5.0, 65.0, "Arabian Sea", "Unknown Region"),
    (5.0, 102.0, "Wharton Basin", "Malacca Strait"),
    (None, 65.0, "Unknown", "Unknown Region"),
    (NAN, 65.0, "Unknown", "Unknown Region"),
]
OCEANS = [
    (0.0, 20.0, "Indian Ocean", "Atlantic Ocean"),
    (35.0, 25.0, "Unknown", "Indian Ocean"),
    (40.0, 130.0, "Pacific Ocean", "Indian Ocean"),
    (68.0, -150.0, "Pacific Ocean", "Arctic Ocean"),
    (-60.0, 50.0, "Indian Ocean", "Southern Ocean"),
    (-65.0, -30.0, "Atlantic Ocean", "Southern Ocean"),
    (0.0, -70.0, "Pacific Ocean", "Atlantic Ocean"),
    (10.0, 160.0, "Pacific Ocean", "Pacific Ocean"),
    (None, 1.0, "Unknown", "Unknown Ocean"),
    (NAN, 1.0, "Unknown", "Unknown Ocean"),
]


def test_positions(spark):
    for cases, make, modes in (
        (REGIONS, fl.assign_region, ("closed", "open")), (OCEANS, fl.assign_ocean, ("boxes", "chain")),
    ):
        df = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(cases)], "i int, lat double, lon double")
        got = df.select("i", *[make("lat", "lon", m) for m in modes]).orderBy("i").collect()
        assert [tuple(r[1:]) for r in got] == [c[2:] for c in cases]
    with pytest.raises(ValueError):
        fl.assign_region("lat", "lon", "half")


def test_clean_bytes(spark):
    values = ["b'AB '", ' b"x" ', "b'x", "b'", None, "plain "]
    assert evaluate(spark, values, fl.clean_bytes) == ["AB ", "x", "b'x", "", None, "plain"]


def test_split_datetime(spark):
    cases = {
        "2025-04-15 07:34:37.000800256": ("2025-04-15", "07:34:37.000800256"),
        "15-04-2025 07:34:37 AM": ("15-04-2025", "07:34:37 AM"),
        "07:34:37": (None, "07:34:37"),
        "2025-04-15": ("2025-04-15", None),
        "2025-04-15T07:34:37": (None, "2025-04-15T07:34:37"),
        "nan": (None, None), "": (None, None), None: (None, None),
    }
    df = spark.createDataFrame([(i, k) for i, k in enumerate(cases)], "i int, v string")
    date, time = fl.split_datetime("v")
    got = [tuple(r)[1:] for r in df.select("i", date, time).orderBy("i").collect()]
    assert got == list(cases.values())


def test_platform_from_path(spark):
    cases = {
        "aoml/1900722/profiles/BD1900722_001.nc": "1900722",
        "x/SD123_001.nc": "123", "x/SBDD77_1.nc": "77", "x/abc.nc": None,
        "123456/x_9_8.nc": "9", "1234567": "1234567",
    }
    assert evaluate(spark, list(cases), fl.platform_from_path) == list(cases.values())


def test_juld(spark):
    utc = dt.datetime
    got = evaluate(spark, [27500.25, 999999.0, 0.0, None, NAN, 1e9], fl.juld_to_timestamp, "double")
    assert got == [utc(2025, 4, 17, 6), None, utc(1950, 1, 1), None, None, None]
    texts = ["27500.25", "2025-04-17 06:00:00", "2025-04-17T06:00:00", "999999.0", "07:34:37", "x", None]
    got = evaluate(spark, texts, lambda c: fl.juld_to_timestamp(c, "string"))
    assert got == [utc(2025, 4, 17, 6)] * 3 + [None] * 4


def test_dates(spark):
    assert evaluate(spark, ["20250101052756", "20251301052756", "2025", None], fl.compact_date) == [
        "2025-01-01", "20251301052756", "2025", None]
    assert evaluate(spark, ["2025-04-15", "15-04-2025", "bad", "nan", None], fl.reading_date) == [
        dt.date(2025, 4, 15), dt.date(2025, 4, 15), None, None, None]
    assert evaluate(spark, ["07:34:37 AM", "nan", None], fl.reading_time) == ["07:34:37", None, None]
    got = evaluate(spark, ["20250801_prof.nc", "2025080", "2025", "ab250801", None], fl.filename_date)
    assert [tuple(r) for r in got] == [(2025, 8, 1), (2025, 8, 0), (None,) * 3, (None,) * 3, (None,) * 3]
    assert evaluate(spark, [1, 12, 0, 13], fl.month_name, "int") == ["January", "December", "Unknown", "Unknown"]
    assert evaluate(spark, [1, 8, 13], fl.month_code, "int") == ["JAN", "AUG", "UNK"]
    assert evaluate(spark, ["March", "march"], fl.month_number) == [3, None]


@pytest.mark.parametrize("spec,months", [("1-12", list(range(1, 13))), ("8, 9,10", [8, 9, 10]), ("8", [8])])
def test_months(spec, months):
    assert fl.parse_months(spec) == months


@pytest.mark.parametrize("spec", ["0", "13", "5-13", "9-8", "x"])
def test_bad_months(spec):
    with pytest.raises(ValueError):
        fl.parse_months(spec)


def test_numbers(spark):
    values = ["1", "-1.5e3", ".5", "1d", "1f", " 7 ", "inf", "-Infinity", "nan", "x", "", None]
    got = evaluate(spark, values, fl.to_number)
    assert got == [1.0, -1500.0, 0.5, None, None, 7.0, INF, -INF, None, None, None, None]
    ok = evaluate(spark, values, fl.parses_as_float)
    assert ok == [True, True, True, False, False, True, True, True, True, False, False, False]


def test_tokens(spark):
    values = ["", "NA", " NA", "nan", "b'x'", None]
    assert evaluate(spark, values, fl.null_tokens) == [None, None, " NA", None, "b'x'", None]
    assert evaluate(spark, [" nan ", " v ", "None", "\t", None], fl.reading_value) == [None, "v", None, None, None]


def test_bytes_and_chars(spark):
    raw = [bytearray(b"ab"), bytearray(b"a\xffb")]
    assert evaluate(spark, raw[:1], fl.decode_text, "binary") == ["ab"]
    assert evaluate(spark, raw, lambda c: fl.decode_text(c, True), "binary") == ["ab", "ab"]
    assert evaluate(spark, [["A", "O", " "]], fl.join_chars, "array<string>") == ["AO"]


def test_paths(spark):
    paths = ["d/BCG floats/a.csv", "d/Non-BCG floats/2025/August/b.csv", "d/bcg/a.csv"]
    assert evaluate(spark, paths, fl.float_type) == ["BCG", "NON-BCG", "NON-BCG"]
    got = evaluate(spark, paths, fl.year_month_parts)
    assert got[0] is None and tuple(got[1]) == (2025, "August", "b.csv")
    assert evaluate(spark, ["5904_Sprof.csv", "x.csv"], fl.float_id_from_filename) == ["5904", "x.csv"]


def test_grouping_columns():
    names = ["PLATFORM_NUMBER", "PLATFORM_TYPE", "CYCLE_NUMBER", "JULD", "n_levels", "FLOAT_SERIAL_NO"]
    assert grouping_columns(names) == ["PLATFORM_NUMBER", "FLOAT_SERIAL_NO", "CYCLE_NUMBER", "n_levels", "JULD"]
    with pytest.raises(ValueError):
        grouping_columns(["PRES"])


def test_boxes_covered_by_several_earlier_ones_go():
    from floatlake.catalog import REGION_BOXES
    from floatlake.functions.geo import visible_boxes

    halves = [("a", 0, 10, 0, 10), ("b", 0, 10, 10, 20), ("c", 2, 8, 5, 15), ("d", 0, 10, 5, 25)]
    assert [x[0] for x in visible_boxes(halves)] == ["a", "b", "d"]
    # With open borders the line between the halves is covered by neither.
    assert [x[0] for x in visible_boxes(halves, "open")] == ["a", "b", "c", "d"]
    for mode in ("closed", "open"):
        kept = visible_boxes(REGION_BOXES, mode)
        assert len(kept) < len(REGION_BOXES) - 20
        ok = (lambda x, a, b: a <= x <= b) if mode == "closed" else (lambda x, a, b: a < x < b)
        edges = [sorted({v for b in REGION_BOXES for v in (b[i], b[i + 1])}) for i in (1, 3)]
        spots = [sorted({*e, *((p + q) / 2 for p, q in zip(e, e[1:], strict=False))}) for e in edges]
        for y in spots[0][::3]:
            for x in spots[1]:
                first = [next((b[0] for b in boxes if ok(y, b[1], b[2]) and ok(x, b[3], b[4])), None) for boxes in (REGION_BOXES, kept)]
                assert first[0] == first[1]
