"""Column functions on hand-made values."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from hardwood.functions import cleaning as c
from hardwood.functions.hashing import row_hash
from hardwood.functions.ratios import percentage, ratio


def column(frame, values, kind, function):
    return [row[0] for row in frame([(v,) for v in values], f"v {kind}").select(function(F.col("v"))).collect()]


def test_ratios_round_half_away_from_zero(frame):
    rows = frame([(201, 200), (5, 800), (1, 0), (-1, 8), (None, 3), (3, None)], "n int, d int")
    got = rows.select(ratio(F.col("n"), F.col("d")), percentage(F.col("n"), F.col("d"))).collect()
    assert [tuple(r) for r in got] == [
        (1.01, 100.5), (0.01, 0.63), (None, None), (-0.13, -12.5), (None, None), (None, None)]


def test_ids_that_are_not_digits_are_null_and_raise_nothing(frame):
    raw = ["", "12a", " 12", "12\n", "1" * 20, "0021", None, "-5", "٣"]
    assert column(frame, raw, "string", c.numeric_id) == [None] * 5 + [21, None, None, None]


def test_numbers(frame):
    raw = ["1949.0", " 7 ", "1e3", ".5", "1d", "NaN", "0x1p3", "", None, "12\n"]
    assert column(frame, raw, "string", c.to_number) == [1949.0, 7.0, 1000.0, 0.5] + [None] * 6
    assert column(frame, ["105.0", "7", "x", "99999999999"], "string", c.whole_number) == [105, 7, None, None]


def test_dates_booleans_sentinels_seasons(frame):
    assert column(frame, ["10-26-2010", "99-99-2010", "2010-10-26", None], "string", c.us_date) == [
        dt.date(2010, 10, 26), None, None, None]
    assert column(frame, ["TRUE", "True", "False", "maybe", None], "string", c.truth) == [
        True, True, False, False, False]
    assert column(frame, ["0", "10", None], "string", c.without_sentinel) == [None, "10", None]
    long = "2" + "0" * 30 + "2010"
    assert column(frame, ["22010", "2x", None, long, long + "x"], "string", c.season_year) == [2010, None, None, 2010, None]
    assert column(frame, [2010, None], "int", c.season_label) == ["2010-2011", None]
    assert column(frame, [1.5, float("nan"), None], "double", c.finite) == [1.5, None, None]


def hashes(frame, rows, schema, numeric=()):
    df = frame(rows, schema)
    return [row[0] for row in df.select(row_hash(df, df.columns, numeric)).collect()]


def test_row_hash_sees_content_not_format(frame):
    a, b = hashes(frame, [("ab", "c"), ("a", "bc")], "x string, y string")
    assert a != b
    a, b, d = hashes(frame, [("1949", None), ("1949.0", ""), (" 1949 ", " ")], "x string, y string", ["x"])
    assert a == b == d
    a, b = hashes(frame, [("007",), ("7",)], "x string")
    assert a != b
    a, b = hashes(frame, [("007",), ("7",)], "x string", ["x"])
    assert a == b
    stamps = [(dt.datetime(2024, 1, 1, 5),), (dt.datetime(2024, 1, 1, 9),)]
    a, b = hashes(frame, stamps, "x timestamp_ntz")
    assert a == b
    text, number = hashes(frame, [("180.90",)], "x string", ["x"]) + hashes(frame, [(180.9,)], "x double")
    assert text == number


def test_row_hash_keeps_every_digit_of_numbers(frame):
    for kind, numeric, values in (
        ("string", ["x"], ["0.12345678901", "0.12345678902", "1e-12", "0", "1" * 45, "1" * 44 + "2", "-1", "1.5", "1.50e3"]),
        ("double", (), [0.12345678901, 0.12345678902, 1e-12, 0.0, 1e300, 1e299, -1.0, 1.5, 1500.0]),
    ):
        assert len(set(hashes(frame, [(v,) for v in values], f"x {kind}", numeric))) == len(values)
    same = [("1949",), ("1949.",), ("+1949.00",), ("01949",), ("1949e0",), ("1949E+00",)]
    assert len(set(hashes(frame, same, "x string", ["x"]))) == 1
    assert len(set(hashes(frame, [("0",), ("-0.0",), ("0e7",), (".0",), ("00",)], "x string", ["x"]))) == 1
    assert len(set(hashes(frame, [(".5",), ("0.5",), ("0.50",)], "x string", ["x"]))) == 1
    wide = [Decimal("9" * 38), Decimal("9" * 37 + "8"), None]
    assert len(set(hashes(frame, [(v,) for v in wide], "x decimal(38,0)"))) == 3
