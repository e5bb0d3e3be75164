"""Control tables derived from the driver tables.

A feed loader keeps a product registry, a per-file load history, a batch
table and one data table per product.  The driver tables stand in for them:

* customer -> product registry (``products``)
* orders (+ lineitem counts) -> file load history (``history``)
* lineitem (+ orders) -> batch tracking (``batches``) and product data rows (``product_rows``)

Every stand-in is defined twice: as DataFrame code (what runs) and as a SQL
CTE (what the DuckDB oracle runs).  Both read the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pid(c: str):
    return F.concat(F.lit("P"), F.col(c).cast("string"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n3 = F.col("c_nationkey") % 3
    return c.select(
        _pid("c_custkey").alias("product_id"),
        F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("description"),
        F.when(n3 == 0, "daily").when(n3 == 1, "weekly").otherwise("annual").alias("frequency"),
        (F.col("c_custkey") * 1024).alias("total_size"),
        F.when(n3 == 0, "case_file").when(n3 == 1, "assignment").otherwise("proceeding").alias("family"),
        F.concat(F.lit("product_p"), F.col("c_custkey").cast("string")).alias("table_name"),
        ((F.col("c_custkey") % 2) == 0).alias("schema_created"),
    )


PRODUCTS_SQL = """products AS (
  SELECT 'P' || CAST(c_custkey AS VARCHAR) AS product_id, c_name AS title, c_mktsegment AS description,
         CASE c_nationkey % 3 WHEN 0 THEN 'daily' WHEN 1 THEN 'weekly' ELSE 'annual' END AS frequency,
         c_custkey * 1024 AS total_size,
         CASE c_nationkey % 3 WHEN 0 THEN 'case_file' WHEN 1 THEN 'assignment' ELSE 'proceeding' END AS family,
         'product_p' || CAST(c_custkey AS VARCHAR) AS table_name,
         (c_custkey % 2) = 0 AS schema_created
  FROM customer)"""


def line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("li_rows"),
        F.count_if(F.col("l_returnflag") != "R").alias("li_kept"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    li = line_counts(spark, sf_dir)
    j = o.join(li, o.o_orderkey == li.l_orderkey, "left")
    status = (F.when(F.col("o_orderstatus") == "F", "completed")
              .when(F.col("o_orderstatus") == "P", "error")
              .when(F.col("o_orderpriority") == "5-LOW", "pending")
              .otherwise("processing"))
    rows = F.coalesce(F.col("li_rows"), F.lit(0))
    j = j.withColumn("status", status)
    return j.select(
        _pid("o_custkey").alias("product_id"),
        F.concat(F.lit("f"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("file_name"),
        (rows * 1024 + F.col("o_orderkey") % 1000).alias("file_size"),
        F.concat(F.lit("bulk/P"), F.col("o_custkey").cast("string"), F.lit("/f"),
                 F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("file_url"),
        F.col("o_orderdate").alias("download_date"),
        F.col("o_orderdate").alias("processing_started"),
        F.when(F.col("status") == "completed", F.col("o_orderdate")).alias("processing_completed"),
        F.when(F.col("status") == "completed", rows)
         .when(F.col("status") == "error", F.lit(0).cast("bigint")).alias("rows_processed"),
        F.when(F.col("status") == "completed", F.coalesce(F.col("li_kept"), F.lit(0))).alias("rows_saved"),
        F.col("status"),
        F.when(F.col("status") == "error", F.concat(F.lit("load failed: "), F.col("o_orderpriority")))
         .alias("error_message"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("processing_attempts"),
        rows.alias("batch_count"),
    )


HISTORY_SQL = """line_counts AS (
  SELECT l_orderkey, COUNT(*) AS li_rows, COUNT(*) FILTER (WHERE l_returnflag <> 'R') AS li_kept
  FROM lineitem GROUP BY l_orderkey),
history AS (
  SELECT 'P' || CAST(o_custkey AS VARCHAR) AS product_id,
         'f' || CAST(o_orderkey AS VARCHAR) || '.csv' AS file_name,
         COALESCE(li_rows, 0) * 1024 + o_orderkey % 1000 AS file_size,
         'bulk/P' || CAST(o_custkey AS VARCHAR) || '/f' || CAST(o_orderkey AS VARCHAR) || '.csv' AS file_url,
         o_orderdate AS download_date,
         o_orderdate AS processing_started,
         CASE WHEN st = 'completed' THEN o_orderdate END AS processing_completed,
         CASE WHEN st = 'completed' THEN COALESCE(li_rows, 0) WHEN st = 'error' THEN 0 END AS rows_processed,
         CASE WHEN st = 'completed' THEN COALESCE(li_kept, 0) END AS rows_saved,
         st AS status,
         CASE WHEN st = 'error' THEN 'load failed: ' || o_orderpriority END AS error_message,
         CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS processing_attempts,
         COALESCE(li_rows, 0) AS batch_count
  FROM (SELECT o.*, lc.li_rows, lc.li_kept,
               CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'P' THEN 'error'
                    WHEN o_orderpriority = '5-LOW' THEN 'pending' ELSE 'processing' END AS st
        FROM orders o LEFT JOIN line_counts lc ON o.o_orderkey = lc.l_orderkey) x)"""


def _lines_with_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner")


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _lines_with_owner(spark, sf_dir)
    return j.select(
        _pid("o_custkey").alias("product_id"),
        F.concat(F.lit("f"), F.col("l_orderkey").cast("string"), F.lit(".csv")).alias("file_name"),
        F.col("l_linenumber").cast("bigint").alias("batch_number"),
        F.col("l_quantity").cast("bigint").alias("rows_in_batch"),
        (F.col("l_linestatus") == "F").alias("processed"),
        (F.col("l_returnflag") != "N").alias("saved_to_db"),
        F.col("l_shipdate").alias("created_at"),
    )


BATCHES_SQL = """batches AS (
  SELECT 'P' || CAST(o_custkey AS VARCHAR) AS product_id,
         'f' || CAST(l_orderkey AS VARCHAR) || '.csv' AS file_name,
         CAST(l_linenumber AS BIGINT) AS batch_number,
         CAST(l_quantity AS BIGINT) AS rows_in_batch,
         l_linestatus = 'F' AS processed,
         l_returnflag <> 'N' AS saved_to_db,
         l_shipdate AS created_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def serial_text():
    """Text serial number with deterministic dirt: 'abc', NULL, '0', else a number."""
    k = F.lit(50000000) + F.col("l_orderkey") * 2000 + F.col("l_linenumber")
    return (F.when(F.col("l_orderkey") % 97 == 0, F.lit("abc"))
            .when(F.col("l_orderkey") % 89 == 0, F.lit(None).cast("string"))
            .when(F.col("l_orderkey") % 83 == 0, F.lit("0"))
            .otherwise(k.cast("string")))


SERIAL_SQL = """CASE WHEN l_orderkey % 97 = 0 THEN 'abc' WHEN l_orderkey % 89 = 0 THEN NULL
       WHEN l_orderkey % 83 = 0 THEN '0'
       ELSE CAST(50000000 + l_orderkey * 2000 + l_linenumber AS VARCHAR) END"""


def product_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the per-product data tables, one tagged table."""
    j = _lines_with_owner(spark, sf_dir)
    return j.select(
        F.concat(F.lit("product_p"), F.col("o_custkey").cast("string")).alias("table_name"),
        _pid("o_custkey").alias("product_id"),
        F.concat(F.lit("f"), F.col("l_orderkey").cast("string"), F.lit(".csv")).alias("file_name"),
        F.col("l_linenumber").cast("bigint").alias("batch_number"),
        F.col("l_shipdate").alias("created_at"),
        serial_text().alias("serial_no"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus"), F.lit(" [CSV]")).alias("data_source"),
    )


PRODUCT_ROWS_SQL = f"""product_rows AS (
  SELECT 'product_p' || CAST(o_custkey AS VARCHAR) AS table_name,
         'P' || CAST(o_custkey AS VARCHAR) AS product_id,
         'f' || CAST(l_orderkey AS VARCHAR) || '.csv' AS file_name,
         CAST(l_linenumber AS BIGINT) AS batch_number,
         l_shipdate AS created_at,
         {SERIAL_SQL} AS serial_no,
         l_returnflag || l_linestatus || ' [CSV]' AS data_source
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


CTES = {
    "products": PRODUCTS_SQL,
    "history": HISTORY_SQL,
    "batches": BATCHES_SQL,
    "product_rows": PRODUCT_ROWS_SQL,
}


def with_ctes(names: list[str], body: str) -> str:
    if not names:
        return body
    return "WITH " + ",\n".join(CTES[n] for n in names) + "\n" + body
