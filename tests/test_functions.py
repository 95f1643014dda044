"""Scalar functions against tables of cases."""

import pytest
from pyspark.sql import functions as F

from veilframe.functions import dates, numbers, rawdates, text


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("value", "grain"),
    [("2024", "year"), ("2024-03", "month"), ("2024-03-05", "day"), ("2024-03-05T10:00", "day"), ("2024-02-30", "day"), ("UNK", "none"), ("2024-3", "none"), ("", "none"), (None, "none"), ("x2024", "none")],
)
def test_granularity(spark, value, grain):
    assert one(spark, value, dates.granularity) == grain


def test_study_day_has_no_day_zero(spark):
    df = spark.createDataFrame([("2024-01-05", "2024-01-05"), ("2024-01-04", "2024-01-05"), ("2024-01", "2024-01-05"), ("2024-01-07", None), ("2024-02-30", "2024-01-05")], "e string, a string")
    assert [r[0] for r in df.select(dates.study_day(df.e, df.a)).collect()] == [1, -1, None, None, None]
    assert [r[0] for r in df.select(dates.study_day(df.e, df.a, True)).collect()][:2] == [0, -1]


@pytest.mark.parametrize(
    ("value", "days", "want"),
    [("2024-01-31", 1, "2024-02-01"), ("2024-01-31T08:00", 1, "2024-02-01"), ("2024-01", 30, "2024-02"), ("2024", 200, "2025"), ("2024-02-30", 1, "2024-02"), ("2024-13", 1, None), ("junk", 1, None), (None, 1, None)],
)
def test_shift_iso(spark, value, days, want):
    assert one(spark, value, lambda c: dates.shift_iso(c, F.lit(days))) == want


@pytest.mark.parametrize(
    ("birth", "at", "want"),
    [("1934-05-01", "2024-05-01", "90+"), ("1934-05-02", "2024-05-01", "89"), ("1980", "2024-05-01", "44"), ("1980-06", "2024-05", "43"), ("", "2024-05", None)],
)
def test_capped_age(spark, birth, at, want):
    df = spark.createDataFrame([(birth, at)], "b string, a string")
    assert df.select(dates.capped_age(df.b, df.a)).first()[0] == want


@pytest.mark.parametrize("value", [45.0, 1e7, 123456.7, 0.5, 0.0001, 0.00001234, 999999.9, 1e-10, -3.25, 0.0, 1234567.0, 100.125, 2.5e20])
def test_general_matches_six_digits(spark, value):
    assert one(spark, value, numbers.general, "double") == f"{value:g}"


@pytest.mark.parametrize(
    ("value", "want"), [("95", "90+"), ("12.50", "12.5"), ("12d", None), ("0x10", None), (" 7 ", "7"), ("1e3", "90+"), (None, None), ("abc", None), ("", None)]
)
def test_cap_numeric(spark, value, want):
    assert one(spark, value, lambda c: numbers.cap_numeric(c, 90)) == want


@pytest.mark.parametrize(("value", "want"), [("17", "<18"), ("18", "18-39"), ("39.5", "18-39"), ("40", "40+"), ("95", "90+"), (None, None), ("x", None)])
def test_bands(spark, value, want):
    assert one(spark, value, lambda c: numbers.bands(c, [40, 18, 18], cap=90)) == want


@pytest.mark.parametrize(("value", "want"), [("12345-6789", "123"), ("03601", "000"), ("12", None), ("AB 102 3", "000"), (None, None)])
def test_zip3(spark, value, want):
    assert one(spark, value, text.zip3) == want


@pytest.mark.parametrize(
    ("value", "order", "days", "want"),
    [
        ("25-Sep-2023", None, 10, "05-Oct-2023"), ("07JUL2023", None, 1, "08JUL2023"), ("3/4/2024", "dmy", 1, "4/4/2024"), ("03/04/2024", "mdy", 30, "04/03/2024"),
        ("03/04/2024", None, 1, None), ("2024-03-05T10:30", None, 1, "2024-03-06T10:30"), ("2015", None, 200, "2016"), ("Mar-2015", None, 30, "Apr-2015"),
        ("UN-JAN-2012", None, 31, "UN-FEB-2012"), ("2012-UN-UN", None, 365, "2013-UN-UN"), ("19/13/2024", "dmy", 1, None), ("2025-02-30", None, 1, None),
        ("UN/03/2020", "dmy", 200, "UN/10/2020"), ("UN/03/2020", "mdy", 200, None), ("UN/03/2020", None, 200, None), ("03/UN/2020", "mdy", 200, "10/UN/2020"),
        ("15/UN/2020", "dmy", 200, None), ("00/03/2020", "dmy", 200, "00/10/2020"), ("UNK/UNK/2019", None, 365, "UNK/UNK/2020"), ("2020-03-00", None, 200, "2020-10-00"),
        ("2020-01-02T10:30", None, 200, "2020-07-20T10:30"), ("2020-01-02T10:30 and later", None, 200, None), ("2020-01-02 10:30:05.5+0200", None, 200, "2020-07-20 10:30:05.5+0200"),
        ("1/2/2020T10:30", "dmy", 200, "19/8/2020T10:30"), ("03MAR2020:10:20", None, 200, "19SEP2020:10:20"), ("3 Mar 2020 10:20 or so", None, 200, None),
        ("20240105", None, 1, "20240106"), ("1.9.2024", "dmy", 30, "1.10.2024"), ("5 September 2023", None, 30, "5 October 2023"), ("junk", "dmy", 1, None),
    ],
)
def test_written_dates_move_in_place(value, order, days, want):
    assert rawdates.move(value, days, order) == want


def test_written_shift_statuses(spark):
    df = spark.createDataFrame([("25-Sep-2023", 5), ("2015", 5), ("junk", 5), ("25-Sep-2023", None), ("NA", 5), (None, 5)], "v string, n int")
    got = df.select(rawdates.shift_written(df.v, df.n, "dmy").alias("s")).collect()
    assert [r.s.status for r in got] == ["shifted", "partial_shifted", "unparsed", "no_offset", "blank", "blank"]
    held = df.select(rawdates.shift_written(df.v, df.n, "dmy").alias("s"), "v").select(rawdates.finish(F.col("v"), F.col("s"), "redact").alias("v"))
    assert [r.v for r in held.collect()][2:4] == [None, None]
    with pytest.raises(Exception, match="unreadable date of shape AAAA"):
        df.select(rawdates.shift_written(df.v, df.n, "dmy").alias("s"), "v").select(rawdates.finish(F.col("v"), F.col("s"), "fail")).collect()


def test_order_inference_and_forms(spark):
    df = spark.createDataFrame([("25/03/2024", "03/25/2024", "01/02/2024", "2024-01-01"), ("01/02/2024", "01/02/2024", "01/02/2024", None)], "a string, b string, c string, d string")
    assert {r.column_name: r.day_order for r in rawdates.infer_order(df, ["a", "b", "c", "d"]).collect()} == {"a": "dmy", "b": "mdy", "c": "unknown", "d": "unambiguous"}
    forms = {r.template: r.n for r in rawdates.format_counts(df, "a").collect()}
    assert forms == {"{d}/{m}/{y}": 2}


@pytest.mark.parametrize(("word", "value", "hit"), [("Ab 12", "x ab  12!", True), ("Ab 12", "xab 12", False), ("药物", "此药物好", True), ("a.b", "axb", False)])
def test_word_pattern(spark, word, value, hit):
    assert one(spark, value, lambda c: c.rlike(text.word_pattern([word]))) is hit
