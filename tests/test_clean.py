"""Cleaning rules on the dirt listed in FIXTURES (section 1 and the date strings of section 2)."""
from pyspark.sql import functions as F

from feedloom.functions import clean as C


def _one(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_null_tokens(spark):
    vals = ["", " ", "nan", "NaN", "None", "NULL", "null ", "x", " y "]
    assert _one(spark, vals, C.null_token) == [None] * 7 + ["x", " y "]


def test_flag_bool(spark):
    vals = ["1", "1.0", "yes", "Y", "0", "0.0", "no", "T", "2", "12.0", "abc", None, "true", "FALSE", "n"]
    assert _one(spark, vals, C.to_flag_bool) == [True, True, True, True, False, False, False, None, True, True,
                                                 None, None, True, False, False]


def test_whole_number(spark):
    assert _one(spark, ["12", "12.0", " 7 ", "abc", "", "3.9", "-4.5", None], C.to_whole_number) == \
        [12, 12, 7, None, None, 3, -4, None]


def test_yyyymmdd(spark):
    vals = ["19550104", "20230001", "20230100", "20230230", "1955010", "abcdefgh", "", None]
    out = _one(spark, vals, C.yyyymmdd_to_iso_text)
    assert out == ["1955-01-04", None, None, None, None, None, None, None]


def test_date_text(spark):
    vals = ["2023-01-15", "20230115", "0000-00-00", "", "01/15/2023", "abc"]
    out = [str(x) if x else None for x in _one(spark, vals, C.to_date_text)]
    assert out == ["2023-01-15", "2023-01-15", None, None, "2023-01-15", None]
    assert _one(spark, vals, C.date_unparsable) == [False, False, False, False, False, True]


def test_xml_flag_and_sentinel(spark):
    assert _one(spark, ["T", "t", "true", "F", "no", "", " ", None], C.xml_flag) == \
        ["T", "T", "T", "F", "F", None, None, None]
    assert _one(spark, ["0000000", " 1234567 ", "", None], C.no_registration) == [None, "1234567", None, None]


def test_digits_and_parts(spark):
    assert _one(spark, ["12", "007", "1.5", "-3", "abc", ""], C.digits_to_int) == [12, 7, None, None, None, None]
    df = spark.createDataFrame([("a", None, " ", "b"), (None, None, "", None)], "p1 string, p2 string, p3 string, p4 string")
    assert [r[0] for r in df.select(C.join_present("p1", "p2", "p3", "p4")).collect()] == ["a, b", None]
    assert [r[0] for r in df.select(C.composite_id("p1", "p4")).collect()] == ["a-b", None]
    m = spark.createDataFrame([(" x ", "y", "x", None, "")], "a string, b string, c string, d string, e string")
    assert m.select(C.distinct_merge("a", "b", "c", "d", "e")).first()[0] == "x; y"


def test_clean_by_name_dispatch(spark):
    df = spark.createDataFrame([("yes", "19550104", "12.0", " text ", "NaN")],
                               "cancel_pend_in string, filing_dt string, serial_no string, note string, other string")
    r = df.select(*[C.clean_by_name(c).alias(c) for c in df.columns]).first()
    assert r.cancel_pend_in is True and str(r.filing_dt) == "1955-01-04" and r.serial_no == 12
    assert r.note == "text" and r.other is None


def test_dates_with_a_time_part(spark):
    from feedloom.functions import clean
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("2020-01-02 03:04:05",), ("2020-01-02 99:00:00",)], "s string")
    assert [str(r[0]) for r in df.select(clean.try_date(F.col("s"))).collect()] == ["2020-01-02", "None"]
