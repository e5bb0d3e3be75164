"""Streaming queries (ST1-ST3): each runs a Structured Streaming job to completion over
files rendered from the driver tables and returns the sink's current contents."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.plans import standins as SI
from feedloom.plans.q_clean import _RAW_SQL, ws
from feedloom.plans.q_files import messy_case_csv
from feedloom.plans.registry import query
from feedloom.session import scratch_path
from feedloom.streaming import ingest as STR

_CSV_COLS = ["L OrderKey", "l-linenumber", "Serial Number", "Filing-Dt", "cancel pend in", "MARK_ID_CHAR",
             "mark_draw_cd"]


@query("stream_ingest", "ST1 K2 S3", f"""
SELECT l_orderkey, l_linenumber, serial_no FROM (
  SELECT l_orderkey, l_linenumber,
         CAST(trunc(TRY_CAST({ws("CASE WHEN lower(" + ws('serial_no') + ") IN ('', 'nan', 'none', 'null') THEN NULL ELSE serial_no END")}
              AS DECIMAL(38,6))) AS BIGINT) AS serial_no
  FROM {_RAW_SQL} t) x
GROUP BY l_orderkey, l_linenumber, serial_no""")
def stream_ingest(spark, d):
    src = messy_case_csv(spark, d)
    files = len(spark.read.text(src).inputFiles())
    target = scratch_path(spark, "stream-target")
    STR.ingest_csv_stream(spark, src, _CSV_COLS, target, scratch_path(spark, "stream-ckpt"), "TRCFECO2",
                          key=["l_orderkey", "l_linenumber", "serial_no"], keep=["l_orderkey", "l_linenumber"],
                          files_per_batch=-(-files // 4) or 1)
    out = spark.read.parquet(target)
    return out.select(F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
                      F.col("l_linenumber").cast("int").alias("l_linenumber"), "serial_no")


EVENT_SCHEMA = T.StructType([T.StructField("product_id", T.StringType()), T.StructField("file_name", T.StringType()),
                             T.StructField("status", T.StringType()), T.StructField("ts", T.TimestampNTZType())])


def status_events(spark, d):
    """Status events per file, derived from orders: processing, then the outcome, then a late retry."""
    o = SI.table(spark, d, "orders")
    base = o.select(F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("product_id"),
                    F.concat(F.lit("f"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("file_name"),
                    "o_orderstatus", F.col("o_orderdate").alias("ts"))
    first = base.select("product_id", "file_name", F.lit("processing").alias("status"), "ts")
    outcome = base.filter(F.col("o_orderstatus") != "O").select(
        "product_id", "file_name",
        F.when(F.col("o_orderstatus") == "F", "completed").otherwise("error").alias("status"),
        (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"))
    late = base.filter(F.col("o_orderstatus") == "F").select(
        "product_id", "file_name", F.lit("processing").alias("status"), (F.col("ts") + F.expr("INTERVAL 2 DAY")).alias("ts"))
    return first.unionByName(outcome).unionByName(late)


_EVENTS_SQL = """events AS (
  SELECT 'P' || CAST(o_custkey AS VARCHAR) AS product_id, 'f' || CAST(o_orderkey AS VARCHAR) || '.csv' AS file_name,
         'processing' AS status, o_orderdate AS ts FROM orders
  UNION ALL
  SELECT 'P' || CAST(o_custkey AS VARCHAR), 'f' || CAST(o_orderkey AS VARCHAR) || '.csv',
         CASE WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'error' END, o_orderdate + INTERVAL 1 DAY
  FROM orders WHERE o_orderstatus <> 'O'
  UNION ALL
  SELECT 'P' || CAST(o_custkey AS VARCHAR), 'f' || CAST(o_orderkey AS VARCHAR) || '.csv', 'processing',
         o_orderdate + INTERVAL 2 DAY FROM orders WHERE o_orderstatus = 'F')"""


@query("stream_state", "ST2 K4 K5 K6", f"""
WITH {_EVENTS_SQL}
SELECT product_id, file_name,
       CASE WHEN COUNT(*) FILTER (WHERE status = 'completed') > 0 THEN 'completed' ELSE arg_max(status, ts) END
         AS status,
       COUNT(*) FILTER (WHERE status = 'processing') AS attempts, MAX(ts) AS last_event
FROM events GROUP BY product_id, file_name""")
def stream_state(spark, d):
    src = scratch_path(spark, "status-events")
    status_events(spark, d).repartition(4).write.parquet(src)
    target = scratch_path(spark, "state-target")
    STR.file_state_stream(spark, src, EVENT_SCHEMA, target, scratch_path(spark, "state-ckpt"))
    return STR.read_upserts(spark, target, ["product_id", "file_name"])


@query("file_state_batch", "ST2", f"""
WITH {_EVENTS_SQL}
SELECT product_id, file_name,
       CASE WHEN COUNT(*) FILTER (WHERE status = 'completed') > 0 THEN 'completed' ELSE arg_max(status, ts) END
         AS status,
       COUNT(*) FILTER (WHERE status = 'processing') AS attempts, MAX(ts) AS last_event
FROM events GROUP BY product_id, file_name""")
def file_state_batch(spark, d):
    return STR.file_state(status_events(spark, d))


@query("stream_board", "ST3 A7 W", """
SELECT date_trunc('hour', ts) AS window_start, event_type, COUNT(*) AS events, round(SUM(value), 2) AS value_sum
FROM events GROUP BY 1, 2""")
def stream_board(spark, d):
    src = scratch_path(spark, "events-in")
    ev = SI.table(spark, d, "events").select("ts", "event_type", "value")
    ev.repartition(4).write.parquet(src)
    schema = T.StructType([T.StructField("ts", T.TimestampNTZType()), T.StructField("event_type", T.StringType()),
                           T.StructField("value", T.DoubleType())])
    target = scratch_path(spark, "board-target")
    # The rendered files arrive in no particular time order and span 30 days, so the
    # watermark (allowed lateness) must cover that disorder or late rows are dropped.
    STR.activity_board_stream(spark, src, schema, target, scratch_path(spark, "board-ckpt"), watermark="31 days")
    out = STR.read_upserts(spark, target, ["window_start", "event_type"])
    return out.select("window_start", "event_type", "events", F.round("value_sum", 2).alias("value_sum"))
