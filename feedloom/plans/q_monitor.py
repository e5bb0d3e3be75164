"""Monitoring queries on the stand-in control tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from feedloom.operators import monitor as M
from feedloom.operators import positions as P
from feedloom.plans import standins as SI
from feedloom.plans.registry import query
from feedloom.plans.standins import with_ctes

# Fixed evaluation instant for "recent" windows (inside the events range).
AS_OF = dt.datetime(2024, 1, 15, 12, 0, 0)
AS_OF_SQL = "TIMESTAMP '2024-01-15 12:00:00'"


@query("status_view", "J1 A1 T5", with_ctes(["products", "history"], """
SELECT p.product_id, p.title AS product_title, p.table_name, p.schema_created,
       COUNT(h.file_name) AS total_files,
       COUNT(*) FILTER (WHERE h.status = 'completed') AS completed_files,
       COUNT(*) FILTER (WHERE h.status = 'processing') AS processing_files,
       COUNT(*) FILTER (WHERE h.status = 'error') AS error_files,
       COUNT(*) FILTER (WHERE h.status = 'pending') AS pending_files,
       CAST(SUM(h.rows_processed) AS BIGINT) AS total_rows_processed,
       CAST(SUM(h.rows_saved) AS BIGINT) AS total_rows_saved,
       MAX(h.processing_completed) AS last_completed
FROM products p LEFT JOIN history h ON p.product_id = h.product_id
GROUP BY p.product_id, p.title, p.table_name, p.schema_created
ORDER BY p.product_id"""))
def status_view(spark, d):
    return M.processing_status(SI.products(spark, d), SI.history(spark, d))


@query("status_stats", "J1 A2", with_ctes(["products", "history"], """
SELECT p.product_id, p.title AS product_title,
       COUNT(h.file_name) AS total_files,
       COUNT(*) FILTER (WHERE h.status = 'completed') AS completed_files,
       COUNT(*) FILTER (WHERE h.status = 'processing') AS processing_files,
       COUNT(*) FILTER (WHERE h.status = 'error') AS error_files,
       CAST(COALESCE(SUM(h.rows_processed), 0) AS BIGINT) AS total_rows,
       CAST(COALESCE(SUM(h.rows_saved), 0) AS BIGINT) AS total_saved,
       MAX(h.processing_completed) AS last_processed
FROM products p LEFT JOIN history h ON p.product_id = h.product_id
GROUP BY p.product_id, p.title"""))
def status_stats(spark, d):
    return M.processing_stats(SI.products(spark, d), SI.history(spark, d))


@query("status_totals", "A3", with_ctes(["history"], """
SELECT COUNT(*) AS total_files,
       COUNT(*) FILTER (WHERE status = 'completed') AS completed_files,
       COUNT(*) FILTER (WHERE status = 'processing') AS processing_files,
       COUNT(*) FILTER (WHERE status = 'error') AS error_files,
       COUNT(*) FILTER (WHERE status = 'pending') AS pending_files,
       CAST(SUM(rows_processed) AS BIGINT) AS total_rows_processed,
       CAST(SUM(rows_saved) AS BIGINT) AS total_rows_saved
FROM history"""))
def status_totals(spark, d):
    return M.status_totals(SI.history(spark, d))


@query("batch_progress", "A4", with_ctes(["batches"], """
SELECT product_id, file_name, COUNT(*) AS total_batches,
       COUNT(*) FILTER (WHERE processed) AS processed_batches,
       COUNT(*) FILTER (WHERE saved_to_db) AS saved_batches
FROM batches GROUP BY product_id, file_name"""))
def batch_progress(spark, d):
    return M.batch_progress(SI.batches(spark, d))


@query("source_distribution", "A5", with_ctes(["product_rows"], """
SELECT data_source, COUNT(*) AS row_count FROM product_rows GROUP BY data_source ORDER BY row_count DESC"""))
def source_distribution(spark, d):
    return M.source_distribution(SI.product_rows(spark, d))


@query("progress_board", "U1 J2 A6 T5", with_ctes(["products", "product_rows"], """
SELECT p.product_id, p.table_name,
       COUNT(t.table_name) AS record_count,
       COALESCE(MAX(t.batch_number), 0) AS latest_batch,
       MAX(t.created_at) AS last_processed
FROM products p LEFT JOIN product_rows t ON p.table_name = t.table_name
GROUP BY p.product_id, p.table_name
ORDER BY last_processed DESC NULLS LAST"""))
def progress_board(spark, d):
    return M.progress_board(SI.products(spark, d), SI.product_rows(spark, d))


def _activity_frames(spark, d):
    ev = SI.table(spark, d, "events")
    o = SI.table(spark, d, "orders")
    li = SI.table(spark, d, "lineitem")
    # One scan of events, tagged by type, plus two other "tables".
    return {
        "events": ev.select(F.concat(F.lit("product_"), F.col("event_type")).alias("table_name"),
                            F.col("user_id").alias("batch_number"), F.col("ts").alias("created_at")),
        "orders": o.select(F.lit("product_orders").alias("table_name"),
                           F.col("o_custkey").alias("batch_number"), F.col("o_orderdate").alias("created_at")),
        "lineitem": li.select(F.lit("product_lineitem").alias("table_name"),
                              F.col("l_linenumber").cast("bigint").alias("batch_number"),
                              F.col("l_shipdate").alias("created_at")),
    }


@query("recent_activity", "U1 P22 A7 F11", f"""
SELECT table_name, COUNT(*) AS total_records, MAX(batch_number) AS latest_batch, MAX(created_at) AS last_activity
FROM (SELECT 'product_' || event_type AS table_name, user_id AS batch_number, ts AS created_at FROM events
      UNION ALL SELECT 'product_orders', o_custkey, o_orderdate FROM orders
      UNION ALL SELECT 'product_lineitem', CAST(l_linenumber AS BIGINT), l_shipdate FROM lineitem) t
WHERE created_at > {AS_OF_SQL} - INTERVAL 1 HOUR AND created_at <= {AS_OF_SQL}
GROUP BY table_name ORDER BY last_activity DESC""")
def recent_activity(spark, d):
    frames = _activity_frames(spark, d)
    rows = frames["events"].unionByName(frames["orders"]).unionByName(frames["lineitem"])
    return M.recent_activity(rows, AS_OF)


@query("table_lookup", "J3 F10", with_ctes(["products"], """
SELECT o.o_orderkey, p.product_id, p.table_name
FROM orders o JOIN products p ON 'P' || CAST(o.o_custkey AS VARCHAR) = p.product_id"""))
def table_lookup(spark, d):
    o = SI.table(spark, d, "orders")
    ids = o.select("o_orderkey", F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("product_id"))
    return M.table_of_product(SI.products(spark, d), ids).select("o_orderkey", "product_id", "table_name")


@query("history_newest", "T7 T6", with_ctes(["history"], """
SELECT product_id, file_name, download_date, status,
       row_number() OVER (ORDER BY download_date DESC NULLS LAST, file_name, product_id) AS place FROM history"""))
def history_newest(spark, d):
    h = SI.history(spark, d).select("product_id", "file_name", "download_date", "status")
    return P.global_positions(h, [F.desc_nulls_last("download_date"), "file_name", "product_id"], "place", base=1)


@query("page_offset", "T1", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 5 OFFSET 1080""")
def page_offset(spark, d):
    o = SI.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return M.page(o, [F.col("o_orderkey")], 5, 1080)


@query("top_keys", "T2 P16", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey >= 600 ORDER BY o_orderkey DESC LIMIT 10""")
def top_keys(spark, d):
    o = SI.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return M.top_k(o, "o_orderkey", 10, where=F.col("o_orderkey") >= 600)


@query("low_keys", "T3", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey ASC LIMIT 5""")
def low_keys(spark, d):
    o = SI.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return M.top_k(o, "o_orderkey", 5, where=F.col("o_orderkey") > 1000, descending=False)


@query("sorted_ends", "T4", """
SELECT * FROM (SELECT o_totalprice, 'first' AS "end" FROM orders ORDER BY o_totalprice ASC LIMIT 5)
UNION ALL SELECT * FROM (SELECT o_totalprice, 'last' AS "end" FROM orders ORDER BY o_totalprice DESC LIMIT 5)""")
def sorted_ends(spark, d):
    return M.ends_of_sorted(SI.table(spark, d, "orders"), "o_totalprice", 5)


@query("files_per_product_top_n", "W1 P14", with_ctes(["history"], """
SELECT product_id, file_name, pos FROM (
  SELECT product_id, file_name, CAST(substr(file_name, 2, length(file_name) - 5) AS BIGINT) AS pos,
         ROW_NUMBER() OVER (PARTITION BY product_id
                            ORDER BY CAST(substr(file_name, 2, length(file_name) - 5) AS BIGINT)) AS rn
  FROM history WHERE status <> 'error') t
WHERE rn <= 2"""))
def files_per_product_top_n(spark, d):
    h = SI.history(spark, d).filter(F.col("status") != "error")
    h = h.withColumn("pos", F.regexp_extract("file_name", r"^f([0-9]+)\.csv$", 1).cast("bigint"))
    return P.first_n_per_group(h, ["product_id"], [F.col("pos")], 2, tiebreak=["file_name"]) \
        .select("product_id", "file_name", "pos")


@query("batch_assignment", "W4 W2 F9", """
SELECT o_custkey, o_orderkey, pos, CAST(floor(pos / 4) AS BIGINT) AS batch_number FROM (
  SELECT o_custkey, o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos
  FROM orders) t""")
def batch_assignment(spark, d):
    o = SI.table(spark, d, "orders").select("o_custkey", "o_orderkey")
    return P.assign_batches(o, ["o_custkey"], ["o_orderkey"], batch_size=4)


_LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
_LINE_RANKS = f"""
SELECT {', '.join(_LINE_ORDER)}, l_returnflag, rn FROM (
  SELECT *, ROW_NUMBER() OVER (ORDER BY {', '.join(_LINE_ORDER)}) AS rn FROM lineitem) t"""


@query("row_slice", "W2", f"{_LINE_RANKS} WHERE rn BETWEEN 10080 AND 10090")
def row_slice(spark, d):
    li = SI.table(spark, d, "lineitem").select(*_LINE_ORDER, "l_returnflag")
    return P.rank_slice(li, _LINE_ORDER, 10080, 10090, name="rn")


@query("last_n", "W3 J7", f"{_LINE_RANKS} WHERE rn > (SELECT COUNT(*) FROM lineitem) - 5")
def last_n(spark, d):
    li = SI.table(spark, d, "lineitem").select(*_LINE_ORDER, "l_returnflag")
    total = li.count()
    return P.rank_slice(li, _LINE_ORDER, total - 4, total, name="rn")


@query("count_predicate", "A8", """
SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE o_orderkey >= 6000) AS high_keys,
       COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS finished
FROM orders""")
def count_predicate(spark, d):
    o = SI.table(spark, d, "orders")
    return M.count_where(o, high_keys=F.col("o_orderkey") >= 6000, finished=F.col("o_orderstatus") == "F")


@query("run_counters", "A16 F9", with_ctes(["batches"], """
SELECT product_id, file_name, COUNT(*) AS rows_processed, COUNT(*) FILTER (WHERE saved_to_db) AS rows_saved,
       CAST(ceil(COUNT(*) / 3) AS BIGINT) AS batch_count
FROM batches GROUP BY product_id, file_name"""))
def run_counters(spark, d):
    b = SI.batches(spark, d)
    return M.run_counters(b, b.filter(F.col("saved_to_db")), batch_size=3)
