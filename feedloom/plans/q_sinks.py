"""Keyed-load and integrity queries on the stand-in tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from feedloom.operators import positions as P
from feedloom.operators import sinks as K
from feedloom.plans import standins as SI
from feedloom.plans.q_clean import raw_case_rows, _RAW_SQL, ws
from feedloom.plans.registry import ORACLES, query
from feedloom.plans.standins import with_ctes

NOW = dt.datetime(2024, 2, 1, 0, 0, 0)
NOW_SQL = "TIMESTAMP '2024-02-01 00:00:00'"
OLD = dt.datetime(2024, 1, 1, 0, 0, 0)
OLD_SQL = "TIMESTAMP '2024-01-01 00:00:00'"


@query("insert_ignore", "K2 W6 J5 K1", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
         ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS rn
  FROM lineitem) t
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderstatus = 'F' AND o.o_orderkey = t.l_orderkey)""")
def insert_ignore(spark, d):
    existing = SI.table(spark, d, "orders").filter(F.col("o_orderstatus") == "F") \
        .select(F.col("o_orderkey").alias("l_orderkey"))
    incoming = SI.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return K.insert_ignore(existing, incoming, ["l_orderkey"], ["l_linenumber"],
                           tiebreak=["l_partkey", "l_quantity"])


def _registry_old(spark, d):
    return SI.products(spark, d).filter(F.col("description") != "MACHINERY") \
        .withColumn("created_at", F.lit(OLD).cast("timestamp_ntz")) \
        .withColumn("updated_at", F.lit(OLD).cast("timestamp_ntz"))


def _registry_new(spark, d):
    c = SI.table(spark, d, "customer").filter(F.col("c_nationkey") < 10)
    return c.select(F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("product_id"),
                    F.upper("c_name").alias("title"), F.col("c_mktsegment").alias("description"),
                    F.lit("monthly").alias("frequency"), (F.col("c_custkey") * 2048).alias("total_size"),
                    F.concat(F.lit("new_p"), F.col("c_custkey").cast("string")).alias("table_name"),
                    F.lit(False).alias("schema_created"))


@query("upsert_registry", "K3", with_ctes(["products"], f"""
, old AS (SELECT *, {OLD_SQL} AS created_at, {OLD_SQL} AS updated_at FROM products WHERE description <> 'MACHINERY'),
new AS (SELECT 'P' || CAST(c_custkey AS VARCHAR) AS product_id, upper(c_name) AS title, c_mktsegment AS description,
               'monthly' AS frequency, c_custkey * 2048 AS total_size, 'new_p' || CAST(c_custkey AS VARCHAR) AS table_name,
               false AS schema_created FROM customer WHERE c_nationkey < 10)
SELECT COALESCE(o.product_id, n.product_id) AS product_id,
       CASE WHEN n.product_id IS NOT NULL THEN n.title ELSE o.title END AS title,
       CASE WHEN n.product_id IS NOT NULL THEN n.description ELSE o.description END AS description,
       CASE WHEN n.product_id IS NOT NULL THEN n.frequency ELSE o.frequency END AS frequency,
       CASE WHEN n.product_id IS NOT NULL THEN n.total_size ELSE o.total_size END AS total_size,
       CASE WHEN o.product_id IS NOT NULL THEN o.table_name ELSE n.table_name END AS table_name,
       CASE WHEN o.product_id IS NOT NULL THEN o.schema_created ELSE n.schema_created END AS schema_created,
       COALESCE(o.created_at, {NOW_SQL}) AS created_at,
       CASE WHEN n.product_id IS NOT NULL THEN {NOW_SQL} ELSE o.updated_at END AS updated_at
FROM old o FULL OUTER JOIN new n ON o.product_id = n.product_id"""))
def upsert_registry(spark, d):
    return K.upsert(_registry_old(spark, d), _registry_new(spark, d), ["product_id"],
                    ["title", "description", "frequency", "total_size"], ["table_name", "schema_created"], NOW)


def _incoming_files(spark, d):
    o = SI.table(spark, d, "orders").filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    a = o.select(F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("product_id"),
                 F.concat(F.lit("f"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("file_name"),
                 F.col("o_orderkey").alias("file_size"))
    c = SI.table(spark, d, "customer").filter(F.col("c_mktsegment") == "AUTOMOBILE")
    b = c.select(F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("product_id"),
                 F.concat(F.lit("n"), F.col("c_custkey").cast("string"), F.lit(".csv")).alias("file_name"),
                 F.col("c_custkey").alias("file_size"))
    inc = a.unionByName(b)
    return inc.withColumn("file_url", F.concat(F.lit("bulk/v2/"), F.col("file_name")))


_INCOMING_SQL = """incoming AS (
  SELECT 'P' || CAST(o_custkey AS VARCHAR) AS product_id, 'f' || CAST(o_orderkey AS VARCHAR) || '.csv' AS file_name,
         o_orderkey AS file_size FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
  UNION ALL
  SELECT 'P' || CAST(c_custkey AS VARCHAR), 'n' || CAST(c_custkey AS VARCHAR) || '.csv', c_custkey
  FROM customer WHERE c_mktsegment = 'AUTOMOBILE')"""


@query("history_transition", "K4", with_ctes(["history"], f""",
{_INCOMING_SQL},
j AS (SELECT h.product_id AS h_pid, h.file_name AS h_fn, h.status AS h_status, h.processing_attempts AS h_att,
             h.error_message AS h_err, h.file_url AS h_url, h.file_size AS h_size, h.processing_started AS h_started,
             i.product_id AS i_pid, i.file_name AS i_fn, i.file_size AS i_size
      FROM history h FULL OUTER JOIN incoming i ON h.product_id = i.product_id AND h.file_name = i.file_name)
SELECT COALESCE(h_pid, i_pid) AS product_id, COALESCE(h_fn, i_fn) AS file_name,
       CASE WHEN t THEN 'processing' ELSE h_status END AS status,
       CASE WHEN h_fn IS NULL THEN 1 WHEN t THEN COALESCE(h_att, 0) + 1 ELSE h_att END AS processing_attempts,
       CASE WHEN t THEN NULL ELSE h_err END AS error_message,
       CASE WHEN t THEN 'bulk/v2/' || i_fn ELSE h_url END AS file_url,
       CASE WHEN t THEN i_size ELSE h_size END AS file_size,
       CASE WHEN t THEN {NOW_SQL} ELSE h_started END AS processing_started
FROM (SELECT *, (i_fn IS NOT NULL AND NOT COALESCE(h_status = 'completed', false)) AS t FROM j) x"""))
def history_transition(spark, d):
    h = K.mark_processing(SI.history(spark, d), _incoming_files(spark, d), NOW)
    return h.select("product_id", "file_name", "status", "processing_attempts", "error_message",
                    "file_url", "file_size", "processing_started")


def _updates(spark, d):
    o = SI.table(spark, d, "orders").filter(F.col("o_orderstatus") == "O")
    lc = SI.line_counts(spark, d)
    j = o.join(lc, o.o_orderkey == lc.l_orderkey, "left")
    a = j.select(F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("product_id"),
                 F.concat(F.lit("f"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("file_name"),
                 F.coalesce("li_rows", F.lit(0)).alias("rows_processed"),
                 F.coalesce("li_kept", F.lit(0)).alias("rows_saved"),
                 F.ceil(F.coalesce("li_rows", F.lit(0)) / 2).cast("bigint").alias("batch_count"))
    c = SI.table(spark, d, "customer").filter(F.col("c_mktsegment") == "AUTOMOBILE")
    b = c.select(F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("product_id"),
                 F.concat(F.lit("n"), F.col("c_custkey").cast("string"), F.lit(".csv")).alias("file_name"),
                 F.lit(1).cast("bigint").alias("rows_processed"), F.lit(1).cast("bigint").alias("rows_saved"),
                 F.lit(1).cast("bigint").alias("batch_count"))
    return a.unionByName(b)


@query("history_complete", "K5", with_ctes(["history"], f""",
updates AS (
  SELECT 'P' || CAST(o_custkey AS VARCHAR) AS product_id, 'f' || CAST(o_orderkey AS VARCHAR) || '.csv' AS file_name,
         COALESCE(li_rows, 0) AS u_rows_processed, COALESCE(li_kept, 0) AS u_rows_saved,
         CAST(ceil(COALESCE(li_rows, 0) / 2) AS BIGINT) AS u_batch_count
  FROM orders LEFT JOIN line_counts ON o_orderkey = l_orderkey WHERE o_orderstatus = 'O'
  UNION ALL
  SELECT 'P' || CAST(c_custkey AS VARCHAR), 'n' || CAST(c_custkey AS VARCHAR) || '.csv', 1, 1, 1
  FROM customer WHERE c_mktsegment = 'AUTOMOBILE')
SELECT h.product_id, h.file_name,
       CASE WHEN u.file_name IS NOT NULL THEN 'completed' ELSE h.status END AS status,
       CASE WHEN u.file_name IS NOT NULL THEN u_rows_processed ELSE h.rows_processed END AS rows_processed,
       CASE WHEN u.file_name IS NOT NULL THEN u_rows_saved ELSE h.rows_saved END AS rows_saved,
       CASE WHEN u.file_name IS NOT NULL THEN u_batch_count ELSE h.batch_count END AS batch_count,
       CASE WHEN u.file_name IS NOT NULL THEN {NOW_SQL} ELSE h.processing_completed END AS processing_completed,
       CASE WHEN u.file_name IS NOT NULL THEN NULL ELSE h.error_message END AS error_message
FROM history h LEFT JOIN updates u ON h.product_id = u.product_id AND h.file_name = u.file_name"""))
def history_complete(spark, d):
    h = K.mark_completed(SI.history(spark, d), _updates(spark, d), NOW)
    return h.select("product_id", "file_name", "status", "rows_processed", "rows_saved", "batch_count",
                    "processing_completed", "error_message")


@query("history_error", "K6", with_ctes(["history"], """,
updates AS (SELECT 'P' || CAST(o_custkey AS VARCHAR) AS product_id, 'f' || CAST(o_orderkey AS VARCHAR) || '.csv' AS file_name,
                   repeat(o_orderpriority || ' failure; ', 100) AS message FROM orders WHERE o_orderpriority = '3-MEDIUM')
SELECT h.product_id, h.file_name,
       CASE WHEN u.file_name IS NOT NULL THEN 'error' ELSE h.status END AS status,
       CASE WHEN u.file_name IS NOT NULL THEN substring(u.message, 1, 1000) ELSE h.error_message END AS error_message
FROM history h LEFT JOIN updates u ON h.product_id = u.product_id AND h.file_name = u.file_name"""))
def history_error(spark, d):
    o = SI.table(spark, d, "orders").filter(F.col("o_orderpriority") == "3-MEDIUM")
    u = o.select(F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("product_id"),
                 F.concat(F.lit("f"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("file_name"),
                 F.repeat(F.concat("o_orderpriority", F.lit(" failure; ")), 100).alias("message"))
    return K.mark_error(SI.history(spark, d), u).select("product_id", "file_name", "status", "error_message")


@query("upsert_completed", "K7", with_ctes(["history"], f""",
keys AS (SELECT 'P' || CAST(o_custkey AS VARCHAR) AS product_id, 'f' || CAST(o_orderkey AS VARCHAR) || '.csv' AS file_name
         FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'
         UNION ALL SELECT 'P' || CAST(c_custkey AS VARCHAR), 'n' || CAST(c_custkey AS VARCHAR) || '.csv'
         FROM customer WHERE c_mktsegment = 'AUTOMOBILE')
SELECT COALESCE(h.product_id, k.product_id) AS product_id, COALESCE(h.file_name, k.file_name) AS file_name,
       CASE WHEN k.file_name IS NOT NULL THEN 'completed' ELSE h.status END AS status,
       CASE WHEN h.file_name IS NULL THEN 0 ELSE h.rows_processed END AS rows_processed,
       CASE WHEN h.file_name IS NULL THEN 0 ELSE h.rows_saved END AS rows_saved,
       CASE WHEN k.file_name IS NOT NULL THEN {NOW_SQL} ELSE h.processing_completed END AS processing_completed
FROM history h FULL OUTER JOIN keys k ON h.product_id = k.product_id AND h.file_name = k.file_name"""))
def upsert_completed(spark, d):
    o = SI.table(spark, d, "orders").filter(F.col("o_orderpriority") == "4-NOT SPECIFIED")
    a = o.select(F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("product_id"),
                 F.concat(F.lit("f"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("file_name"))
    c = SI.table(spark, d, "customer").filter(F.col("c_mktsegment") == "AUTOMOBILE")
    b = c.select(F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("product_id"),
                 F.concat(F.lit("n"), F.col("c_custkey").cast("string"), F.lit(".csv")).alias("file_name"))
    h = K.upsert_completed(SI.history(spark, d), a.unionByName(b), NOW)
    return h.select("product_id", "file_name", "status", "rows_processed", "rows_saved", "processing_completed")


@query("delete_out_of_range", "K8 P16", with_ctes(["product_rows"], """
SELECT table_name, file_name, batch_number, serial_no FROM product_rows
WHERE NOT COALESCE(TRY_CAST(serial_no AS BIGINT) >= 60000000, false)"""))
def delete_out_of_range(spark, d):
    rows = SI.product_rows(spark, d)
    kept = K.delete_where(rows, F.col("serial_no").try_cast("bigint") >= 60000000)
    return kept.select("table_name", "file_name", "batch_number", "serial_no")


@query("retention", "K9", with_ctes(["batches"], """
SELECT product_id, file_name, batch_number, created_at FROM batches
WHERE NOT COALESCE(processed AND saved_to_db AND created_at < TIMESTAMP '1998-06-01 00:00:00' - INTERVAL 7 DAY, false)"""))
def retention(spark, d):
    b = K.retention(SI.batches(spark, d), dt.datetime(1998, 6, 1), keep_days=7)
    return b.select("product_id", "file_name", "batch_number", "created_at")


@query("truncate_reset", "K10", with_ctes(["products"], """
SELECT product_id, table_name, false AS schema_created, CAST(0 AS BIGINT) AS rows_left FROM products"""))
def truncate_reset(spark, d):
    p = K.reset_registry(SI.products(spark, d))
    left = K.truncate(SI.product_rows(spark, d)).agg(F.count(F.lit(1))).scalar()
    return p.select("product_id", "table_name", "schema_created", left.alias("rows_left"))


_CONFORM_TYPES = {"serial_no": "bigint", "filing_dt": "date", "mark_draw_cd": "int", "mark_identification": "string"}


@query("conform_reject", "K11 P13 I3", f"""
SELECT l_orderkey, l_linenumber, serial_no, CAST(filing_dt AS VARCHAR) AS filing_dt, mark_draw_cd, mark_identification,
       concat_ws(',', CASE WHEN s IS NOT NULL AND serial_no IS NULL THEN 'serial_no' END,
                      CASE WHEN f IS NOT NULL AND f NOT IN ('', '0000-00-00', 'nan') AND filing_dt IS NULL THEN 'filing_dt' END,
                      CASE WHEN m IS NOT NULL AND mark_draw_cd IS NULL THEN 'mark_draw_cd' END) AS reject_columns,
       (s IS NOT NULL AND serial_no IS NULL) OR (f IS NOT NULL AND f NOT IN ('', '0000-00-00', 'nan') AND filing_dt IS NULL)
         OR (m IS NOT NULL AND mark_draw_cd IS NULL) AS rejected
FROM (SELECT l_orderkey, l_linenumber, s, f, m, NULLIF({ws('mark_identification')}, '') AS mark_identification,
             CAST(trunc(TRY_CAST(s AS DECIMAL(38,6))) AS BIGINT) AS serial_no,
             CASE WHEN f IN ('', '0000-00-00', 'nan') OR f IS NULL THEN NULL
                  ELSE COALESCE(TRY_STRPTIME(f, '%Y-%m-%d'), TRY_STRPTIME(f, '%Y%m%d'), TRY_STRPTIME(f, '%m/%d/%Y'))::DATE
             END AS filing_dt,
             CAST(trunc(TRY_CAST(m AS DECIMAL(38,6))) AS INTEGER) AS mark_draw_cd
      FROM (SELECT *, NULLIF({ws('serial_no')}, '') AS s, NULLIF({ws('filing_dt')}, '') AS f,
                   NULLIF({ws('mark_draw_cd')}, '') AS m FROM {_RAW_SQL} r) q) t""")
def conform_reject(spark, d):
    c = K.conform(raw_case_rows(spark, d), _CONFORM_TYPES, keep=["l_orderkey", "l_linenumber"])
    return c.select("l_orderkey", "l_linenumber", "serial_no", F.date_format("filing_dt", "yyyy-MM-dd").alias("filing_dt"),
                    "mark_draw_cd", "mark_identification", F.array_join("reject_columns", ",").alias("reject_columns"),
                    "rejected")


@query("seed_keep", "K13", with_ctes(["products"], """
SELECT product_id, title FROM products
UNION ALL
SELECT 'P' || CAST(n_nationkey AS VARCHAR), n_name FROM nation
WHERE 'P' || CAST(n_nationkey AS VARCHAR) NOT IN (SELECT product_id FROM products)"""))
def seed_keep(spark, d):
    n = SI.table(spark, d, "nation").select(F.concat(F.lit("P"), F.col("n_nationkey").cast("string"))
                                            .alias("product_id"), F.col("n_name").alias("title"))
    return K.seed_keep(SI.products(spark, d).select("product_id", "title"), n, ["product_id"])


@query("skip_loaded", "K14", with_ctes(["products", "product_rows"], """
SELECT product_id, product_id IN (SELECT product_id FROM product_rows) AS has_rows FROM products"""))
def skip_loaded(spark, d):
    p = SI.products(spark, d).select("product_id")
    with_rows, without = K.loaded_products(p, SI.product_rows(spark, d))
    return with_rows.withColumn("has_rows", F.lit(True)).unionByName(without.withColumn("has_rows", F.lit(False)))


@query("dup_keys", "I1", with_ctes(["product_rows"], """
SELECT serial_no, COUNT(*) AS occurrences FROM product_rows GROUP BY serial_no HAVING COUNT(*) > 1"""))
def dup_keys(spark, d):
    return K.duplicate_keys(SI.product_rows(spark, d), ["serial_no"])


@query("fk_orphans", "I2", with_ctes(["products", "history"], """
SELECT h.product_id, h.file_name FROM history h
WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.schema_created AND p.product_id = h.product_id)"""))
def fk_orphans(spark, d):
    parents = SI.products(spark, d).filter(F.col("schema_created"))
    return K.orphans(SI.history(spark, d).select("product_id", "file_name"), parents, ["product_id"])


@query("null_defaults", "I3", with_ctes(["history"], """
SELECT product_id, file_name, COALESCE(status, 'pending') AS status, COALESCE(rows_processed, 0) AS rows_processed,
       COALESCE(rows_saved, 0) AS rows_saved, COALESCE(error_message, '') AS error_message FROM history"""))
def null_defaults(spark, d):
    h = SI.history(spark, d).select("product_id", "file_name", "status", "rows_processed", "rows_saved",
                                    "error_message")
    return K.apply_defaults(h, {"status": "pending", "rows_processed": 0, "rows_saved": 0, "error_message": ""})


@query("null_counts", "I3 A8", with_ctes(["history"], """
SELECT COUNT(*) FILTER (WHERE rows_processed IS NULL) AS rows_processed_nulls,
       COUNT(*) FILTER (WHERE processing_completed IS NULL) AS processing_completed_nulls,
       COUNT(*) FILTER (WHERE error_message IS NULL) AS error_message_nulls FROM history"""))
def null_counts(spark, d):
    return K.null_violations(SI.history(spark, d), ["rows_processed", "processing_completed", "error_message"])


@query("length_check", "I4", """
SELECT conv_id, turn, concat_ws(',', CASE WHEN length(role) > 5 THEN 'role' END,
                                     CASE WHEN length(text) > 2000 THEN 'text' END) AS too_long
FROM conversations WHERE length(role) > 5 OR length(text) > 2000""")
def length_check(spark, d):
    cv = SI.table(spark, d, "conversations")
    r = K.length_violations(cv, {"role": 5, "text": 2000}, ["conv_id", "turn"])
    return r.withColumn("too_long", F.array_join("too_long", ","))


@query("cascade", "I5", with_ctes(["products", "history"], """
SELECT product_id, file_name FROM history
WHERE product_id NOT IN (SELECT product_id FROM products WHERE description = 'HOUSEHOLD')"""))
def cascade(spark, d):
    gone = SI.products(spark, d).filter(F.col("description") == "HOUSEHOLD")
    return K.cascade_delete(SI.history(spark, d).select("product_id", "file_name"), gone, ["product_id"])


@query("worklist", "J4 P14 W1", with_ctes(["products", "history"], """
SELECT product_id, file_name FROM (
  SELECT product_id, file_name, ROW_NUMBER() OVER (PARTITION BY product_id
         ORDER BY CAST(substr(file_name, 2, length(file_name) - 5) AS BIGINT)) AS rn
  FROM history h
  WHERE status <> 'completed'
    AND product_id IN (SELECT product_id FROM products WHERE upper(frequency) IN ('DAILY', 'WEEKLY'))
    AND upper(product_id) NOT IN ('P1', 'P2', 'P3')) t
WHERE rn <= 2"""))
def worklist(spark, d):
    h = SI.history(spark, d)
    allow = SI.products(spark, d).filter(F.upper("frequency").isin("DAILY", "WEEKLY")).select("product_id")
    files = h.select("product_id", "file_name").join(allow, "product_id", "left_semi") \
        .filter(~F.upper("product_id").isin("P1", "P2", "P3"))
    todo = K.worklist(files, h)
    todo = todo.withColumn("__pos", F.regexp_extract("file_name", r"^f([0-9]+)\.csv$", 1).cast("bigint"))
    return P.first_n_per_group(todo, ["product_id"], ["__pos"], 2, tiebreak=["file_name"]) \
        .select("product_id", "file_name")


@query("registry_versions", "K3 K1 K10", ORACLES["upsert_registry"])
def registry_versions(spark, d):
    """K3 persisted: the old registry is committed as version 1, the upsert as version 2; read back."""
    from feedloom.operators import tables as TB
    from feedloom.session import scratch_path
    root = scratch_path(spark, "registry")
    TB.commit_version(spark, _registry_old(spark, d), root, sort_by=["product_id"])
    TB.upsert_table(spark, root, _registry_new(spark, d), ["product_id"],
                    ["title", "description", "frequency", "total_size"], ["table_name", "schema_created"], NOW)
    cur = TB.read_current(spark, root)
    return cur.select("product_id", "title", "description", "frequency", "total_size", "table_name",
                      "schema_created", "created_at", "updated_at")
