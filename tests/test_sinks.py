"""Keyed loads: idempotence and guarded transitions (rerun tests)."""
import datetime as dt

from pyspark.sql import functions as F

from feedloom import schemas as S
from feedloom.operators import sinks as K

NOW = dt.datetime(2024, 2, 1)


def _history(spark):
    rows = [("P1", "a.csv", "completed", 2, None, "u1", 10), ("P1", "b.csv", "error", 1, "boom", "u2", 20),
            ("P2", "c.csv", "pending", None, None, "u3", 30)]
    df = spark.createDataFrame(rows, "product_id string, file_name string, status string, processing_attempts long, "
                                     "error_message string, file_url string, file_size long")
    return df.withColumn("processing_started", F.lit(None).cast("timestamp_ntz")) \
        .withColumn("processing_completed", F.lit(None).cast("timestamp_ntz")) \
        .withColumn("rows_processed", F.lit(None).cast("long")).withColumn("rows_saved", F.lit(None).cast("long")) \
        .withColumn("batch_count", F.lit(None).cast("long"))


def test_insert_ignore_first_wins_and_is_idempotent(spark):
    existing = spark.createDataFrame([(1,)], "k long")
    incoming = spark.createDataFrame([(1, 0, "x"), (2, 1, "late"), (2, 0, "early"), (3, 0, "y")], "k long, pos long, v string")
    ins = K.insert_ignore(existing, incoming, ["k"], ["pos"])
    assert sorted((r.k, r.v) for r in ins.collect()) == [(2, "early"), (3, "y")]
    stored = existing.unionByName(ins.select("k"))
    assert K.insert_ignore(stored, incoming, ["k"], ["pos"]).count() == 0


def test_mark_processing_never_downgrades(spark):
    h = _history(spark)
    inc = spark.createDataFrame([("P1", "a.csv", "new", 1), ("P1", "b.csv", "new", 2), ("P3", "d.csv", "n", 3)],
                                "product_id string, file_name string, file_url string, file_size long")
    out = {(r.product_id, r.file_name): r for r in K.mark_processing(h, inc, NOW).collect()}
    assert out[("P1", "a.csv")].status == "completed" and out[("P1", "a.csv")].file_url == "u1"
    b = out[("P1", "b.csv")]
    assert b.status == "processing" and b.processing_attempts == 2 and b.error_message is None and b.file_size == 2
    d = out[("P3", "d.csv")]
    assert d.status == "processing" and d.processing_attempts == 1
    assert out[("P2", "c.csv")].status == "pending"


def test_mark_completed_error_and_upsert_completed(spark):
    h = _history(spark)
    upd = spark.createDataFrame([("P2", "c.csv", 5, 4, 1), ("P9", "zz.csv", 1, 1, 1)],
                                "product_id string, file_name string, rows_processed long, rows_saved long, batch_count long")
    out = K.mark_completed(h, upd, NOW)
    assert out.count() == 3
    c = out.filter("file_name = 'c.csv'").first()
    assert c.status == "completed" and c.rows_saved == 4
    msg = spark.createDataFrame([("P2", "c.csv", "x" * 1500)], "product_id string, file_name string, message string")
    e = K.mark_error(h, msg).filter("file_name = 'c.csv'").first()
    assert e.status == "error" and len(e.error_message) == S.ERROR_MESSAGE_MAX
    keys = spark.createDataFrame([("P2", "c.csv"), ("P4", "q.csv")], "product_id string, file_name string")
    u = {r.file_name: r for r in K.upsert_completed(h, keys, NOW).collect()}
    assert u["q.csv"].rows_processed == 0 and u["c.csv"].rows_processed is None and u["c.csv"].status == "completed"


def test_upsert_keeps_created_and_table(spark):
    old = spark.createDataFrame([("P1", "old", "t1", dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1))],
                                "product_id string, title string, table_name string, created_at timestamp_ntz, "
                                "updated_at timestamp_ntz")
    new = spark.createDataFrame([("P1", "new", "t9"), ("P2", "x", "t2")], "product_id string, title string, table_name string")
    out = {r.product_id: r for r in K.upsert(old, new, ["product_id"], ["title"], ["table_name"], NOW).collect()}
    assert out["P1"].title == "new" and out["P1"].table_name == "t1"
    assert out["P1"].created_at == dt.datetime(2020, 1, 1) and out["P1"].updated_at == NOW
    assert out["P2"].created_at == NOW


def test_retention_delete_and_conform(spark):
    b = spark.createDataFrame([(True, True, dt.datetime(2024, 1, 1)), (True, True, dt.datetime(2024, 1, 30)),
                               (True, False, dt.datetime(2023, 1, 1)), (None, True, dt.datetime(2023, 1, 1))],
                              "processed boolean, saved_to_db boolean, created_at timestamp_ntz")
    assert K.retention(b, NOW, 7).count() == 3
    raw = spark.createDataFrame([("12", "2023-01-05", "x"), ("abc", "0000-00-00", None), (None, "2023-02-30", "y")],
                                "serial_no string, filing_dt string, note string")
    c = K.conform(raw, {"serial_no": "bigint", "filing_dt": "date", "note": "string"}).collect()
    assert [r.rejected for r in c] == [False, True, True]
    assert c[1].reject_columns == ["serial_no"] and c[2].reject_columns == ["filing_dt"]


def test_integrity(spark):
    child = spark.createDataFrame([("P1", 1), ("P2", 2), ("P2", 3)], "product_id string, x long")
    parent = spark.createDataFrame([("P1",)], "product_id string")
    assert K.orphans(child, parent, ["product_id"]).count() == 2
    assert [r.product_id for r in K.duplicate_keys(child, ["product_id"]).collect()] == ["P2"]
    assert K.cascade_delete(child, parent, ["product_id"]).count() == 2
    t = spark.createDataFrame([("abcdef", "ab")], "a string, b string")
    assert K.length_violations(t, {"a": 5, "b": 5}, ["b"]).first().too_long == ["a"]


def test_versioned_table_upsert(spark, tmpdir_path):
    from feedloom.operators import tables as TB
    root = tmpdir_path + "/registry"
    first = spark.createDataFrame([("P1", "a", "t1"), ("P2", "b", "t2")], "product_id string, title string, table_name string")
    assert TB.upsert_table(spark, root, first, ["product_id"], ["title"], ["table_name"], NOW) == 1
    reader = TB.read_current(spark, root)  # a reader holding version 1
    new = spark.createDataFrame([("P2", "B", "zz"), ("P3", "c", "t3")], "product_id string, title string, table_name string")
    assert TB.upsert_table(spark, root, new, ["product_id"], ["title"], ["table_name"], NOW) == 2
    cur = {r.product_id: (r.title, r.table_name) for r in TB.read_current(spark, root).collect()}
    assert cur == {"P1": ("a", "t1"), "P2": ("B", "t2"), "P3": ("c", "t3")}
    assert reader.count() == 2  # version 1 is untouched
    TB.upsert_table(spark, root, new, ["product_id"], ["title"], ["table_name"], NOW)
    assert len(TB.vacuum(spark, root, keep=2)) == 1 and TB.current_version(spark, root) == 3


def test_insert_ignore_null_key_parts_are_equal(spark):
    from feedloom.operators import sinks
    rows = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("b", "r", 3)], "k string, r string, pos int")
    stored = sinks.insert_ignore(rows.limit(0), rows, ["k", "r"], ["pos"])
    assert sorted(r.pos for r in stored.collect()) == [1, 3]
    assert sinks.insert_ignore(stored, rows, ["k", "r"], ["pos"]).count() == 0


def test_incoming_keys_are_made_unique(spark):
    """K3/K4: several incoming rows of a key leave one row, the last by order."""
    import datetime as dt
    from feedloom import schemas as S
    from feedloom.operators import sinks as K
    old = spark.createDataFrame([("a", "x", "t", None, None)], "product_id string, title string, table_name string, created_at timestamp_ntz, updated_at timestamp_ntz")
    new = spark.createDataFrame([("a", "1", "n", 1), ("a", "2", "n", 2), ("b", "9", "n", 1), ("b", "3", "n", 2)], "product_id string, title string, table_name string, at int")
    out = K.upsert(old, new, ["product_id"], ["title"], ["table_name"], dt.datetime(2024, 1, 1), order=None).collect()
    assert sorted((r.product_id, r.title, r.table_name) for r in out) == [("a", "2", "t"), ("b", "9", "n")]
    out = K.upsert(old, new, ["product_id"], ["title"], ["table_name"], dt.datetime(2024, 1, 1), order=["at"]).collect()
    assert sorted((r.product_id, r.title) for r in out) == [("a", "2"), ("b", "3")]
    h = spark.createDataFrame([], S.FILE_HISTORY_SCHEMA)
    inc = spark.createDataFrame([("p", "f", "u", 1)] * 3, "product_id string, file_name string, file_url string, file_size long")
    assert K.mark_processing(h, inc, dt.datetime(2024, 1, 1)).count() == 1
