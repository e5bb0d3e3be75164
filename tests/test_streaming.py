"""Structured Streaming: exactly-once ingest with resume, absorbing 'completed' state."""
import os

from pyspark.sql import functions as F

from feedloom.streaming import ingest as STR


def test_ingest_resumes_without_reloading(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    for i in range(3):
        with open(os.path.join(src, f"f{i}.csv"), "w") as f:
            f.write("serial_number,status_code\n" + "".join(f"{i * 10 + j},S\n" for j in range(5)) + "1,S\n")
    target, ckpt = os.path.join(tmpdir_path, "out"), os.path.join(tmpdir_path, "ckpt")
    STR.ingest_csv_stream(spark, src, ["serial_number", "status_code"], target, ckpt, "TRCFECO2", key=["serial_no"])
    first = spark.read.parquet(target)
    assert first.count() == 15 and first.select("serial_no").distinct().count() == 15
    batches = first.select("batch_id").distinct().count()
    with open(os.path.join(src, "f9.csv"), "w") as f:
        f.write("serial_number,status_code\n100,S\n1,S\n")
    STR.ingest_csv_stream(spark, src, ["serial_number", "status_code"], target, ckpt, "TRCFECO2", key=["serial_no"])
    again = spark.read.parquet(target)
    assert again.count() == 16 and again.select("batch_id").distinct().count() == batches + 1


def test_file_state_completed_is_absorbing(spark):
    ev = spark.createDataFrame([("P", "a", "processing", 1), ("P", "a", "completed", 2), ("P", "a", "processing", 3),
                                ("P", "b", "processing", 1), ("P", "b", "error", 2)],
                               "product_id string, file_name string, status string, t int") \
        .withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz"))
    got = {r.file_name: (r.status, r.attempts) for r in STR.file_state(ev).collect()}
    assert got == {"a": ("completed", 2), "b": ("error", 1)}
