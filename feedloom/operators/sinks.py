"""Keyed loads as pure DataFrame transforms.

Each function maps (current state, incoming rows) to the next state or to
the rows to append.  Writers on top persist the result; on plain Parquet
a new version directory is written and swapped in (never overwrite a path
that is being read).  Every step is a join or aggregation on the natural
key, so Spark shuffles by key; nothing is collected to the driver.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom import schemas as S
from feedloom.operators.positions import keep_first


def _ts(now) -> Column:
    return F.lit(now).cast("timestamp_ntz") if isinstance(now, _dt.datetime) else now


# --------------------------------------------------------------------------- K1/K2/K13/J5
def insert_ignore(existing_keys: DataFrame, incoming: DataFrame, key: list[str],
                  order: list, tiebreak: list[str] | None = None) -> DataFrame:
    """K2 (+W6, J5): rows to append: first per key inside the batch, minus keys already stored.

    NULL key parts are equal to each other, stored or incoming; stored keys are taken out first, so
    only new rows are ranked.
    """
    stored = existing_keys.select(*[F.col(c).alias(f"__k_{c}") for c in key]).distinct()
    new = incoming.join(stored, [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in key], "left_anti")
    return keep_first(new, key, order, tiebreak=tiebreak)


def seed_keep(existing: DataFrame, seed: DataFrame, key: list[str]) -> DataFrame:
    """Add seed rows whose key is absent; existing rows are kept as they are."""
    new = seed.join(existing.select(*key), key, "left_anti")
    return existing.unionByName(new, allowMissingColumns=True)


# --------------------------------------------------------------------------- K3
def one_per_key(rows: DataFrame, key: list[str], cols: list[str], order: list[str] | None = None) -> DataFrame:
    """One incoming row a key: the last by ``order``, ties and no order by the greatest values (aggregated within tasks first)."""
    best = F.max(F.struct(*[F.col(c) for c in [*(order or []), *cols]])).alias("__b")
    return rows.groupBy(*key).agg(best).select(*key, *[F.col("__b").getField(c).alias(c) for c in cols])


def upsert(old: DataFrame, new: DataFrame, key: list[str], update_cols: list[str],
           keep_cols: list[str], now, order: list[str] | None = None) -> DataFrame:
    """K3: insert new keys; for matched keys overwrite ``update_cols`` and bump ``updated_at``.

    ``keep_cols`` keep the stored value when the key exists (e.g. created_at, table_name).  Of several incoming
    rows of a key the last by ``order`` counts.
    """
    new = one_per_key(new, key, update_cols + keep_cols, order)
    o = old.select(*key, *[F.col(c).alias(f"__o_{c}") for c in update_cols + keep_cols],
                   F.col("created_at").alias("__o_created"), F.col("updated_at").alias("__o_updated"),
                   F.lit(True).alias("__o"))
    n = new.select(*key, *[F.col(c).alias(f"__n_{c}") for c in update_cols + keep_cols], F.lit(True).alias("__n"))
    j = o.join(n, key, "full")
    has_new = F.col("__n").isNotNull()
    has_old = F.col("__o").isNotNull()
    out = [*key]
    for c in update_cols:
        out.append(F.when(has_new, F.col(f"__n_{c}")).otherwise(F.col(f"__o_{c}")).alias(c))
    for c in keep_cols:
        out.append(F.when(has_old, F.col(f"__o_{c}")).otherwise(F.col(f"__n_{c}")).alias(c))
    out.append(F.coalesce(F.col("__o_created"), _ts(now)).alias("created_at"))
    out.append(F.when(has_new, _ts(now)).otherwise(F.col("__o_updated")).alias("updated_at"))
    return j.select(*out)


# --------------------------------------------------------------------------- K4-K7
HKEY = ["product_id", "file_name"]


def mark_processing(history: DataFrame, incoming: DataFrame, now) -> DataFrame:
    """K4: guarded upsert to 'processing'; 'completed' rows are never downgraded (nor touched)."""
    inc = one_per_key(incoming, HKEY, ["file_url", "file_size"]).select(
        *HKEY, F.col("file_url").alias("__url"), F.col("file_size").alias("__size"), F.lit(True).alias("__n"))
    j = history.withColumn("__o", F.lit(True)).join(inc, HKEY, "full")
    touched = F.col("__n").isNotNull() & ~F.coalesce(F.col("status") == "completed", F.lit(False))
    is_new = F.col("__o").isNull()
    cols = []
    for f in history.columns:
        if f in HKEY:
            cols.append(F.col(f))
        elif f == "status":
            cols.append(F.when(touched, F.lit("processing")).otherwise(F.col(f)).alias(f))
        elif f == "processing_started":
            cols.append(F.when(touched, _ts(now)).otherwise(F.col(f)).alias(f))
        elif f == "processing_attempts":
            cols.append(F.when(is_new, F.lit(1).cast("bigint"))
                        .when(touched, F.coalesce(F.col(f), F.lit(0)) + 1).otherwise(F.col(f)).alias(f))
        elif f == "error_message":
            cols.append(F.when(touched, F.lit(None).cast("string")).otherwise(F.col(f)).alias(f))
        elif f == "file_url":
            cols.append(F.when(touched, F.col("__url")).otherwise(F.col(f)).alias(f))
        elif f == "file_size":
            cols.append(F.when(touched, F.col("__size")).otherwise(F.col(f)).alias(f))
        else:
            cols.append(F.col(f))
    return j.select(*cols)


def mark_completed(history: DataFrame, updates: DataFrame, now) -> DataFrame:
    """K5: keyed update to 'completed' with counts; keys missing from history are ignored."""
    u = updates.select(*HKEY, *[F.col(c).alias(f"__u_{c}") for c in ("rows_processed", "rows_saved", "batch_count")],
                       F.lit(True).alias("__u"))
    j = history.join(u, HKEY, "left")
    hit = F.col("__u").isNotNull()
    repl = {"status": F.lit("completed"), "processing_completed": _ts(now),
            "rows_processed": F.col("__u_rows_processed"), "rows_saved": F.col("__u_rows_saved"),
            "batch_count": F.col("__u_batch_count"), "error_message": F.lit(None).cast("string")}
    return j.select(*[F.when(hit, repl[c]).otherwise(F.col(c)).alias(c) if c in repl else F.col(c)
                      for c in history.columns])


def mark_error(history: DataFrame, updates: DataFrame) -> DataFrame:
    """K6: keyed update to 'error'; message truncated to 1000 characters."""
    u = updates.select(*HKEY, F.col("message").alias("__msg"), F.lit(True).alias("__u"))
    j = history.join(u, HKEY, "left")
    hit = F.col("__u").isNotNull()
    repl = {"status": F.lit("error"), "error_message": F.substring("__msg", 1, S.ERROR_MESSAGE_MAX)}
    return j.select(*[F.when(hit, repl[c]).otherwise(F.col(c)).alias(c) if c in repl else F.col(c)
                      for c in history.columns])


def upsert_completed(history: DataFrame, keys: DataFrame, now) -> DataFrame:
    """K7: mark 'completed' directly; inserts start with zero counts, updates keep counts."""
    k = keys.select(*HKEY, F.lit(True).alias("__k"))
    j = history.withColumn("__o", F.lit(True)).join(k, HKEY, "full")
    hit, is_new = F.col("__k").isNotNull(), F.col("__o").isNull()
    out = []
    for c in history.columns:
        if c in HKEY:
            out.append(F.col(c))
        elif c == "status":
            out.append(F.when(hit, F.lit("completed")).otherwise(F.col(c)).alias(c))
        elif c == "processing_completed":
            out.append(F.when(hit, _ts(now)).otherwise(F.col(c)).alias(c))
        elif c in ("rows_processed", "rows_saved"):
            out.append(F.when(is_new, F.lit(0).cast("bigint")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


# --------------------------------------------------------------------------- K8-K11, K14
def delete_where(df: DataFrame, pred: Column) -> DataFrame:
    """K8: the rows that remain after deleting ``pred`` (NULL predicate keeps the row)."""
    return df.filter(~F.coalesce(pred, F.lit(False)))


def retention(batches: DataFrame, as_of, keep_days: int = 7) -> DataFrame:
    """K9: drop batches processed AND saved AND older than ``keep_days`` before ``as_of``."""
    old = F.col("created_at") < (_ts(as_of) - F.make_interval(days=F.lit(keep_days)))
    return delete_where(batches, F.col("processed") & F.col("saved_to_db") & old)


def truncate(df: DataFrame) -> DataFrame:
    """Empty table with the same schema."""
    return df.limit(0)


def reset_registry(products: DataFrame) -> DataFrame:
    """Registry after a reset: no product has its schema created."""
    return products.withColumn("schema_created", F.lit(False))


def conform(df: DataFrame, types: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """Cast text columns to the family's types; flag rows where a present value fails to cast.

    Returns all rows with ``rejected`` and ``reject_columns``; split with ``filter``.
    Built in stages (text -> typed value -> reject flags) so each value is computed once
    and the flags read the typed columns instead of re-inlining the conversions.
    """
    from feedloom.functions.clean import text_or_null, to_date_text, to_whole_number
    keep = keep or []
    src = df.select(*keep, *[text_or_null(F.col(c)).alias(f"__src_{c}") for c in types])
    typed_cols = []
    for c, t in types.items():
        s = F.col(f"__src_{c}")
        if t == "date":
            v = to_date_text(s)
        elif t == "string":
            v = s
        elif t in ("int", "bigint"):
            v = to_whole_number(s).cast(t)
        else:
            v = s.try_cast(t)
        typed_cols.append(v.alias(c))
    typed = src.select(*keep, *[f"__src_{c}" for c in types], *typed_cols)
    bad = []
    for c, t in types.items():
        absent = F.col(f"__src_{c}").isNull()
        if t == "date":
            absent = absent | F.col(f"__src_{c}").isin(*S.EMPTY_DATE_TOKENS)
        bad.append(F.when(~absent & F.col(c).isNull(), F.lit(c)))
    rej = F.array_compact(F.array(*bad))
    return typed.select(*keep, *types, rej.alias("reject_columns")).withColumn("rejected", F.size("reject_columns") > 0)


def loaded_products(products: DataFrame, rows: DataFrame, key: str = "product_id") -> tuple[DataFrame, DataFrame]:
    """(products with rows, products without) via semi/anti joins."""
    return (products.join(rows.select(key), key, "left_semi"),
            products.join(rows.select(key), key, "left_anti"))


def worklist(files: DataFrame, history: DataFrame) -> DataFrame:
    """Catalog files not yet completed."""
    done = history.filter(F.col("status") == "completed").select(*HKEY)
    return files.join(done, HKEY, "left_anti")


# --------------------------------------------------------------------------- I1-I5
def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once (partial aggregation; skew-safe)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)


def orphans(child: DataFrame, parent: DataFrame, key: list[str]) -> DataFrame:
    """Child rows whose key has no parent."""
    return child.join(parent.select(*key).distinct(), key, "left_anti")


def apply_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Fill column defaults for NULLs."""
    return df.select(*[F.coalesce(F.col(c), F.lit(defaults[c]).cast(df.schema[c].dataType)).alias(c)
                       if c in defaults else F.col(c) for c in df.columns])


def null_violations(df: DataFrame, required: list[str]) -> DataFrame:
    """Count of NULLs per required column (one pass)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in required])


def length_violations(df: DataFrame, limits: dict[str, int], keep: list[str]) -> DataFrame:
    """I4: rows where a text column exceeds its declared length; lists the offending columns."""
    bad = F.array_compact(F.array(*[F.when(F.char_length(F.col(c)) > n, F.lit(c)) for c, n in limits.items()]))
    return df.select(*keep, bad.alias("too_long")).filter(F.size("too_long") > 0)


def cascade_delete(children: DataFrame, deleted_parents: DataFrame, key: list[str]) -> DataFrame:
    """Children that remain after their parents are deleted."""
    return children.join(deleted_parents.select(*key), key, "left_anti")

