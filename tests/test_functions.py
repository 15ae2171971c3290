import random
import sys
from datetime import date

import pytest
from pyspark.sql import functions as F

from roadcast.functions import geodesic, numeric, polygon, text, times


def column(spark, values, kind, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", expression(F.col("v")).alias("r"))
    return [r.r for r in df.orderBy("i").collect()]


def test_strip_equals_python_for_every_whitespace_character(spark):
    spaces = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    values = [s + "a" + s + "b" + s + s for s in spaces + ["​", "﻿", "᠎", "\0"]]
    assert column(spark, values, "string", text.strip) == [v.strip() for v in values]


def test_cell_normalises_line_breaks_and_blanks(spark):
    values = [" a ", "", "\t 　", None, "x\r\ny\rz", "a b"]
    assert column(spark, values, "string", text.cell) == ["a", None, None, None, "x\ny\nz", "a b"]


def test_parse_int(spark):
    values = ["5", "+5", "-5", "1.0", "x", None, "1_000", "1__0", "_1", "2147483648", "007"]
    assert column(spark, values, "string", text.parse_int) == [5, 5, -5, None, None, None, 1000, None, None, None, 7]


def test_parse_timestamp_keeps_the_clock(spark):
    values = ["2026-01-05 10:11:12", "2026-01-05T10:11:12", "01/05/2026", "2026-01-05", None]
    got = column(spark, values, "string", lambda c: text.parse_timestamp(c).cast("string"))
    assert got == ["2026-01-05 10:11:12", "2026-01-05 10:11:12", None, "2026-01-05 00:00:00", None]


def test_parse_iso_date_is_strict(spark):
    got = column(spark, ["2026-02-19", "20260219", "2026-2-19", "2026-02-30"], "string", text.parse_iso_date)
    assert got == [date(2026, 2, 19), None, None, None]


def test_paths(spark):
    assert column(spark, ["a/b/c.csv", "c.csv"], "string", text.base_name) == ["c.csv", "c.csv"]
    got = column(
        spark, ["root//"], "string", lambda c: text.dated_path(c, F.lit("2026-02-19").cast("date"), F.lit("f.csv"))
    )
    assert got == ["root/2026-02-19/f.csv"]


@pytest.mark.parametrize("digits", [2, 6])
def test_round_exact_equals_python(spark, digits):
    rng = random.Random(digits)
    values = [rng.uniform(-200, 200) for _ in range(3000)]
    values += [(round(rng.uniform(-120, 120), 6) + round(rng.uniform(-120, 120), 6)) / 2 for _ in range(3000)]
    values += [2.675, 0.125, -0.125, 2.5, 1.0000005, 32.1234565, 0.0]
    assert column(spark, values, "double", lambda c: numeric.round_exact(c, digits)) == [round(v, digits) for v in values]


def test_round_scaled_is_half_even_on_the_scaled_value(spark):
    assert column(spark, [0.125, 0.135, 33.333333], "double", lambda c: numeric.round_scaled(c, 2)) == [0.12, 0.14, 33.33]


def test_geodesic_published_line_and_special_cases(spark):
    lines = [
        # Flinders Peak to Buninyong, a published Vincenty test line
        (-37.951033416667, 144.424867888889, -37.652821138889, 143.926495527778, 54972.271),
        (1.0, 2.0, 1.0, 2.0, 0.0),
        (0.0, 0.0, 0.0, 1.0, 111319.491),
        (0.0, 179.5, 0.0, -179.5, 111319.491),
        (90.0, 0.0, -90.0, 0.0, 20003931.459),
    ]
    df = spark.createDataFrame([r[:4] for r in lines], "a double, b double, c double, d double")
    got = [r.m for r in df.select(geodesic.geodesic_m(*[F.col(c) for c in "abcd"]).alias("m")).collect()]
    assert got == pytest.approx([r[4] for r in lines], abs=1e-3)


def test_batch_key_and_iso_text_ignore_the_session_zone(spark):
    df = spark.sql("select timestamp'2026-02-19 10:53:07Z' as t union all select timestamp'1960-01-02 03:04:05.120003Z'")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            rows = df.select(times.batch_key(times.utc_clock(F.col("t"))), times.iso_utc(times.utc_clock(F.col("t")))).collect()
            assert sorted(map(tuple, rows)) == [
                ("nws_observations/1960-01-02/1960-01-02T03-04-05Z.json", "1960-01-02T03:04:05.120003+00:00"),
                ("nws_observations/2026-02-19/2026-02-19T10-53-07Z.json", "2026-02-19T10:53:07+00:00"),
            ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_run_date():
    assert times.resolve_run_date("2026-02-19") == date(2026, 2, 19)
    assert times.resolve_run_date(None) == date.today()
    for bad in ("2026/02/19", "19-02-2026", "x"):
        with pytest.raises(ValueError):
            times.resolve_run_date(bad)


def test_polygon_area_closed_forms(spark):
    square = [[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]
    hole = [[1.0, 1.0], [1.0, 2.0], [2.0, 2.0], [2.0, 1.0], [1.0, 1.0]]
    unclosed = [[0.0, 0.0], [3.0, 0.0], [0.0, 2.0]]
    df = spark.createDataFrame(
        [(0, [square]), (1, [square[::-1], hole]), (2, [unclosed])], "i int, part array<array<array<double>>>"
    )
    got = [r.a for r in df.orderBy("i").select(polygon.part_area(F.col("part")).alias("a")).collect()]
    assert got == [16.0, 15.0, 3.0]


def test_partial_dates_are_no_timestamps(spark):
    from roadcast.functions.text import parse_timestamp
    from roadcast.functions.times import resolve_run_date

    cases = {"2024-01-05": True, "2024-01-05 10:11:12": True, "2024-01-05T10:11:12.5": True, "2024": False, "2024-01": False, "2024-1-5": False, "2024-01-05x": False}
    frame = spark.createDataFrame([(c,) for c in cases], "t string").select("t", parse_timestamp(F.col("t")).isNotNull().alias("ok"))
    assert {r.t: r.ok for r in frame.collect()} == cases
    for text in ("2024-1-5", "2024-01-05T00", "20240105", "2024-13-01"):
        with pytest.raises(ValueError):
            resolve_run_date(text)
    assert str(resolve_run_date("2024-01-05")) == "2024-01-05"


def test_near_antipodal_distances_settle(spark):
    """Two published lines (Wikipedia, Vincenty's formulae), half a meridian, and the poles."""
    from roadcast.functions.geodesic import geodesic_m

    cases = [
        (0.0, 0.0, 0.5, 179.5, 19936288.579), (0.0, 0.0, 0.5, 179.7, 19944127.421), (0.0, 0.0, 0.0, 180.0, 20003931.459),
        (90.0, 0.0, -90.0, 0.0, 20003931.459), (30.0, -60.0, -30.0, 120.0, 20003931.459),
    ]
    frame = spark.createDataFrame(cases, "a double, b double, c double, d double, m double")
    for r in frame.select("m", geodesic_m(*map(F.col, "abcd")).alias("got")).collect():
        assert r.got == pytest.approx(r.m, abs=0.01)
    assert frame.select(geodesic_m(F.lit(None).cast("double"), *map(F.col, "bcd")).alias("got")).first().got is None
