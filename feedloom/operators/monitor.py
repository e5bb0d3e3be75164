"""Load monitoring: status views, progress boards, counts, top-k.

Pattern used throughout: aggregate the large side first (partial aggregation
runs map-side, so even a product holding a third of all files costs one
combine per task), then join the small per-key result to the registry.
The registry join is left to the planner: it broadcasts when the registry's
statistics are under ``spark.sql.autoBroadcastJoinThreshold`` and uses a
sort-merge join otherwise; nothing is force-broadcast.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.names import tagged_union


def _count_status(s: str) -> Column:
    return F.count_if(F.col("status") == s).alias(f"{s}_files")


def _per_product_history(history: DataFrame) -> DataFrame:
    return history.groupBy("product_id").agg(
        F.count("file_name").alias("total_files"),
        _count_status("completed"), _count_status("processing"),
        _count_status("error"), _count_status("pending"),
        F.sum("rows_processed").alias("total_rows_processed"),
        F.sum("rows_saved").alias("total_rows_saved"),
        F.max("processing_completed").alias("last_completed"),
    )


def processing_status(products: DataFrame, history: DataFrame) -> DataFrame:
    """A1 + J1: per product file counts by status and row sums (NULL sums when no files)."""
    agg = _per_product_history(history)
    j = products.join(agg, "product_id", "left")
    zero = F.lit(0).cast("bigint")
    return j.select(
        "product_id", F.col("title").alias("product_title"), "table_name", "schema_created",
        *[F.coalesce(F.col(c), zero).alias(c) for c in
          ("total_files", "completed_files", "processing_files", "error_files", "pending_files")],
        "total_rows_processed", "total_rows_saved", "last_completed",
    ).orderBy("product_id")


def processing_stats(products: DataFrame, history: DataFrame) -> DataFrame:
    """A2: as A1 without pending; sums default to 0."""
    s = processing_status(products, history)
    zero = F.lit(0).cast("bigint")
    return s.select(
        "product_id", "product_title", "total_files", "completed_files", "processing_files", "error_files",
        F.coalesce("total_rows_processed", zero).alias("total_rows"),
        F.coalesce("total_rows_saved", zero).alias("total_saved"),
        F.col("last_completed").alias("last_processed"),
    )


def status_totals(history: DataFrame) -> DataFrame:
    """A3: one row of global totals."""
    return history.agg(
        F.count(F.lit(1)).alias("total_files"),
        _count_status("completed"), _count_status("processing"),
        _count_status("error"), _count_status("pending"),
        F.sum("rows_processed").alias("total_rows_processed"),
        F.sum("rows_saved").alias("total_rows_saved"),
    )


def batch_progress(batches: DataFrame) -> DataFrame:
    """A4: batches per (product, file): total, processed, saved."""
    return batches.groupBy("product_id", "file_name").agg(
        F.count(F.lit(1)).alias("total_batches"),
        F.count_if(F.col("processed")).alias("processed_batches"),
        F.count_if(F.col("saved_to_db")).alias("saved_batches"),
    )


def source_distribution(rows: DataFrame, col: str = "data_source") -> DataFrame:
    """A5: rows per data source, most frequent first."""
    return rows.groupBy(col).agg(F.count(F.lit(1)).alias("row_count")).orderBy(F.desc("row_count"), col)


def progress_board(registry: DataFrame, rows: DataFrame) -> DataFrame:
    """A6 + J2 + U1: per registered product table: rows, latest batch (0 when none), last load."""
    per_table = rows.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.max("batch_number").alias("latest_batch"),
        F.max("created_at").alias("last_processed"))
    j = registry.select("product_id", "table_name").join(per_table, "table_name", "left")
    return j.select(
        "product_id", "table_name",
        F.coalesce("record_count", F.lit(0).cast("bigint")).alias("record_count"),
        F.coalesce("latest_batch", F.lit(0).cast("bigint")).alias("latest_batch"),
        "last_processed",
    ).orderBy(F.desc_nulls_last("last_processed"), "product_id")


def recent_activity(frames: dict[str, DataFrame] | DataFrame, as_of: _dt.datetime,
                    window: str = "1 hour") -> DataFrame:
    """A7 + U1 + P22: per table, rows created in the last ``window`` before ``as_of``."""
    rows = tagged_union(frames) if isinstance(frames, dict) else frames
    cut = F.lit(as_of) - F.expr(f"INTERVAL {window}")
    recent = rows.filter((F.col("created_at") > cut) & (F.col("created_at") <= F.lit(as_of)))
    return recent.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.max("batch_number").alias("latest_batch"),
        F.max("created_at").alias("last_activity"),
    ).orderBy(F.desc("last_activity"))


def count_where(df: DataFrame, **preds: Column) -> DataFrame:
    """Row count plus one conditional count per predicate, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  *[F.count_if(F.coalesce(p, F.lit(False))).alias(n) for n, p in preds.items()])


def table_of_product(products: DataFrame, ids: DataFrame) -> DataFrame:
    """Product id -> table name lookup (the id list is the small side)."""
    return ids.join(products.select("product_id", "table_name"), "product_id", "inner")


def newest_first(history: DataFrame, n: int | None = None) -> DataFrame:
    """Load history newest first (optionally the first n)."""
    d = history.orderBy(F.desc("download_date"), "file_name")
    return d.limit(n) if n else d


def page(df: DataFrame, order: list, n: int, offset: int = 0) -> DataFrame:
    """ORDER BY .. LIMIT n OFFSET m."""
    return df.orderBy(*order).offset(offset).limit(n) if offset else df.orderBy(*order).limit(n)


def top_k(df: DataFrame, key: str, k: int, where: Column | None = None, descending: bool = True) -> DataFrame:
    """Top-k by key (TakeOrderedAndProject: per-task heaps then one merge of k*tasks rows)."""
    d = df.filter(where) if where is not None else df
    o = F.col(key).desc() if descending else F.col(key).asc()
    return d.orderBy(o).limit(k)


def ends_of_sorted(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """T4: first k and last k of the sorted keys, as two bounded top-k scans."""
    lo = df.select(key).filter(F.col(key).isNotNull()).orderBy(F.asc(key)).limit(k).withColumn("end", F.lit("first"))
    hi = df.select(key).filter(F.col(key).isNotNull()).orderBy(F.desc(key)).limit(k).withColumn("end", F.lit("last"))
    return lo.unionByName(hi)


def last_n_by_position(df: DataFrame, pos: str, n: int) -> DataFrame:
    """Rows whose position is greater than (row count - n)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.filter(F.col(pos) > total - F.lit(n))


def exists(df: DataFrame) -> bool:
    """EXISTS-style probe (LIMIT 1)."""
    return not df.isEmpty()


def run_counters(loaded: DataFrame, saved: DataFrame, batch_size: int,
                 key: tuple = ("product_id", "file_name")) -> DataFrame:
    """Rows processed / saved / batches per file (true saved counts)."""
    p = loaded.groupBy(*key).agg(F.count(F.lit(1)).alias("rows_processed"))
    s = saved.groupBy(*key).agg(F.count(F.lit(1)).alias("rows_saved"))
    j = p.join(s, list(key), "full")
    return j.select(*key,
                    F.coalesce("rows_processed", F.lit(0).cast("bigint")).alias("rows_processed"),
                    F.coalesce("rows_saved", F.lit(0).cast("bigint")).alias("rows_saved"),
                    F.ceil(F.coalesce("rows_processed", F.lit(0)) / F.lit(batch_size)).cast("bigint")
                    .alias("batch_count"))


def extension_counts(listing: DataFrame) -> DataFrame:
    """Files and bytes per extension."""
    ext = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    return listing.groupBy(ext.alias("extension")).agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("length").alias("total_bytes"))


def table_sizes(listing: DataFrame, root: str) -> DataFrame:
    """Bytes per table directory under ``root``, largest first."""
    rel = F.regexp_replace("path", "^(file:)?" + root.rstrip("/").replace(".", r"\.") + "/", "")
    tname = F.regexp_extract(rel, r"^([^/]+)/", 1)
    return (listing.withColumn("table_name", tname).filter(F.col("table_name") != "")
            .groupBy("table_name").agg(F.sum("length").alias("total_bytes"),
                                       F.count(F.lit(1)).alias("file_count"))
            .orderBy(F.desc("total_bytes")))
