"""Screens on the threshold keys and file-verdict cases of FIXTURES section 7."""
from pyspark.sql import functions as F

from feedloom.operators import screen as Q

KEYS = ["59999999", "60000000", "60000001", "69999999", "70000000", "80000000", "0", None, "abc"]


def test_range_flags(spark):
    df = spark.createDataFrame([(k,) for k in KEYS], "serial_no string")
    k = Q.numeric_key("serial_no")
    flags = Q.range_flags(k)
    rows = df.select("serial_no", *[v.alias(n) for n, v in flags.items()],
                     Q.null_or_zero(k).alias("nz"), Q.is_fake(k).alias("fake")).collect()
    got = {r.serial_no: r for r in rows}
    assert got["60000000"].ge_60000000 and not got["60000000"].gt_60000000 and not got["60000000"].in_fake_band
    assert got["60000001"].in_fake_band and got["69999999"].in_fake_band and not got["70000000"].in_fake_band
    assert got["59999999"].valid and got["0"].nz and got[None].nz
    assert got["abc"].ge_60000000 is None and got["abc"].fake is False


def test_threshold_buckets_and_summary(spark):
    df = spark.createDataFrame([(k, i % 2) for i, k in enumerate(KEYS)], "serial_no string, batch_number int")
    b = {r.threshold: (r.at_or_above, r.pct) for r in Q.threshold_buckets(df, "serial_no").collect()}
    assert b == {60000001: (4, 44.4), 70000000: (2, 22.2), 80000000: (1, 11.1)}
    s = {r.batch_number: r for r in Q.screen_summary(df, "batch_number", "serial_no").collect()}
    assert s[None].is_total and s[None].examined == 9 and s[None].flagged == 2 and s[None].kept == 7


def test_file_verdicts(spark):
    rows = [("missing-none", None), ("all-null", None), ("all-out", "70000000"), ("all-out", "80000000"),
            ("mixed", "70000000"), ("mixed", "123"), ("clean", "1"), ("clean", "2")]
    df = spark.createDataFrame(rows, "file string, serial_no string").filter(F.col("file") != "missing-none")
    v = {r.file: (r.accepted, r.reason) for r in Q.file_verdict(df, "file", "serial_no").collect()}
    assert v == {"all-null": (False, "no keys"), "all-out": (False, "all keys out of range"),
                 "mixed": (True, "ok"), "clean": (True, "ok")}
    no_col = spark.createDataFrame([("f", "x")], "file string, other string")
    r = Q.file_verdict(no_col, "file", "serial_no").first()
    assert r.accepted is False and r.reason.startswith("missing columns")


def test_line_screen_counts(spark):
    text_50 = "\n".join(["60000001 row"] * 50 + ["12345 real"] * 3)
    text_51 = "\n".join(["x 60000002"] * 51)
    df = spark.createDataFrame([(1, text_50), (2, text_51), (3, "")], "doc_id long, text string")
    got = {r.doc_id: (r.marked_lines, r.real_lines, r.rejected) for r in Q.line_screen(df, "doc_id", "text").collect()}
    assert got == {1: (50, 3, False), 2: (51, 0, True), 3: (0, 0, False)}
