"""Data screens: out-of-range keys, file verdicts, text/link screens.

All screens are single-pass conditional aggregations or per-row predicates;
texts are split and exploded on executors, then re-aggregated by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom import schemas as S
from feedloom.functions.clean import pct, strip_ws

# FIXED VALUES: marker tokens and content terms used by the screens.
FAKE_SERIAL_MARKERS = ["60000001", "60000002", "60000003", "60000004", "60000005"]
CONTENT_TERMS = ["trademark", "serial", "registration", "assignment", "case"]
MARKED_LINE_LIMIT = 50
KEYWORD_ACCEPT = 2


def numeric_key(c) -> Column:
    """Key as a number; non-numeric text gives NULL and is never flagged."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("bigint")


def range_flags(k: Column) -> dict[str, Column]:
    """The five range predicates used by the screens."""
    lo, hi = S.SCREEN_BAND
    return {
        "ge_60000000": k >= S.SCREEN_LOW,
        "gt_60000000": k > S.SCREEN_LOW,
        "ge_60000001": k >= lo,
        "in_fake_band": k.between(lo, hi),
        "valid": k < S.SCREEN_LOW,
    }


def is_fake(k: Column) -> Column:
    lo, hi = S.SCREEN_BAND
    return F.coalesce(k.between(lo, hi), F.lit(False))


def prefix_or_range(text: Column, k: Column, prefix: str = "600000") -> Column:
    """Key text starts with a prefix, or the key is out of range."""
    return F.coalesce(text.cast("string").startswith(prefix), F.lit(False)) | F.coalesce(k >= S.SCREEN_LOW, F.lit(False))


def null_or_zero(k: Column) -> Column:
    """P18."""
    return k.isNull() | (k == 0)


def key_range(df: DataFrame, key: str) -> DataFrame:
    """A10: min, max and span of the numeric keys."""
    k = numeric_key(key)
    return df.agg(F.min(k).alias("min_key"), F.max(k).alias("max_key")) \
        .withColumn("key_span", F.col("max_key") - F.col("min_key"))


def threshold_buckets(df: DataFrame, key: str, thresholds=None) -> DataFrame:
    """Rows at or above each threshold, with the share of all rows (long form)."""
    thresholds = thresholds or S.SCREEN_THRESHOLDS
    k = numeric_key(key)
    wide = df.agg(F.count(F.lit(1)).alias("total"),
                  *[F.count_if(k >= t).alias(f"t{t}") for t in thresholds])
    stack = F.expr("stack({n}, {args}) as (threshold, at_or_above)".format(
        n=len(thresholds), args=", ".join(f"CAST({t} AS BIGINT), t{t}" for t in thresholds)))
    return wide.select("total", stack).select("threshold", "at_or_above",
                                              pct("at_or_above", "total").alias("pct"))


def file_verdict(df: DataFrame, file_col: str, key: str, required: list[str] | None = None) -> DataFrame:
    """Per file: accept unless the key column is missing, all keys NULL, or none in range."""
    required = required or ["serial_no"]
    missing = [c for c in required if c not in df.columns]
    if missing:
        return df.select(file_col).distinct().select(
            file_col, F.lit(False).alias("accepted"),
            F.lit("missing columns: " + ",".join(missing)).alias("reason"))
    k = numeric_key(key)
    agg = df.groupBy(file_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.col(key)).alias("non_null_keys"),
        F.count_if(k >= S.SCREEN_LOW).alias("out_of_range"),
        F.count_if(k < S.SCREEN_LOW).alias("in_range"))
    reason = (F.when(F.col("non_null_keys") == 0, F.lit("no keys"))
              .when((F.col("out_of_range") > 0) & (F.col("out_of_range") == F.col("non_null_keys")),
                    F.lit("all keys out of range"))
              .when(F.col("in_range") == 0, F.lit("no key in range"))
              .otherwise(F.lit("ok")))
    return agg.withColumn("reason", reason).withColumn("accepted", F.col("reason") == "ok")


def screen_summary(df: DataFrame, batch_col: str, key: str) -> DataFrame:
    """Examined / flagged / kept per batch plus a total row (rollup)."""
    flag = is_fake(numeric_key(key))
    r = df.rollup(batch_col).agg(
        F.count(F.lit(1)).alias("examined"),
        F.count_if(flag).alias("flagged"))
    return r.withColumn("kept", F.col("examined") - F.col("flagged")) \
        .withColumn("flagged_pct", pct("flagged", "examined")) \
        .withColumn("kept_pct", pct("kept", "examined")) \
        .withColumn("is_total", F.col(batch_col).isNull())


def flags_by_table(rows: DataFrame, tables: DataFrame, key: str, table_col: str = "table_name") -> DataFrame:
    """Out-of-range rows per table, zero for tables with no flagged (or no) rows."""
    k = numeric_key(key)
    per = rows.groupBy(table_col).agg(F.count_if(k >= S.SCREEN_LOW).alias("out_of_range"),
                                      F.count(F.lit(1)).alias("rows"))
    return tables.select(table_col).join(per, table_col, "left").select(
        table_col, F.coalesce("out_of_range", F.lit(0).cast("bigint")).alias("out_of_range"),
        F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"))


def page_links(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """Every href target; absolute links and data-file links flagged."""
    links = pages.select(id_col, F.explode(F.regexp_extract_all(html_col, F.lit(r'href="([^"]*)"'), 1)).alias("link"))
    return links.withColumn("is_absolute", F.col("link").startswith("http")) \
        .withColumn("is_data", F.lower("link").contains(".zip") | F.lower("link").contains(".csv"))


def keyword_score(df: DataFrame, text_col: str, terms: list[str] | None = None) -> DataFrame:
    """How many terms occur (case-insensitive); accepted at >= 2; marker class."""
    terms = terms or CONTENT_TERMS
    low = F.lower(F.col(text_col))
    score = sum((low.contains(t).cast("int") for t in terms), F.lit(0))
    marker = (F.when(F.col(text_col).contains(FAKE_SERIAL_MARKERS[0]), F.lit("flagged"))
              .when(F.col(text_col).contains("serial_no") | F.col(text_col).contains("serial_number"), F.lit("valid"))
              .otherwise(F.lit("unknown")))
    return df.withColumn("score", score).withColumn("accepted", F.col("score") >= KEYWORD_ACCEPT) \
        .withColumn("marker", marker)


def line_screen(df: DataFrame, id_col: str, text_col: str, markers: list[str] | None = None,
                limit: int = MARKED_LINE_LIMIT, head_lines: int | None = None) -> DataFrame:
    """Per text, lines containing any marker, 'real' lines, and a reject verdict.

    ``head_lines`` restricts the screen to the first N lines when a caller wants
    the quick check; by default every line of the whole text is screened.
    """
    markers = markers or FAKE_SERIAL_MARKERS
    lines = df.select(id_col, F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "line"))
    if head_lines is not None:
        lines = lines.filter(F.col("pos") < head_lines)
    line = strip_ws("line")
    marked = sum((line.contains(m).cast("int") for m in markers), F.lit(0)) > 0
    real = ~marked & (line.contains("serial_no") | F.substring(line, 1, 10).rlike("[0-9]"))
    agg = lines.groupBy(id_col).agg(F.count(F.lit(1)).alias("lines"),
                                    F.count_if(marked).alias("marked_lines"),
                                    F.count_if(real).alias("real_lines"))
    return agg.withColumn("rejected", F.col("marked_lines") > limit)


def remove_empty_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows whose columns are all NULL or blank (configured cleaning step)."""
    cols = cols or df.columns
    present = None
    for c in cols:
        v = F.col(f"`{c}`").cast("string")
        p = v.isNotNull() & (strip_ws(v) != "")
        present = p if present is None else (present | p)
    return df.filter(present)


def error_budget(checked: DataFrame, file_col: str, rejected_col: str = "rejected",
                 batch_col: str | None = None) -> DataFrame:
    """Per file: rows, rejects, reject rate; 'fail' past the per-file error limit, 'alert' past
    the error-rate threshold, else 'ok' (configured limits, one aggregation)."""
    keys = [file_col] + ([batch_col] if batch_col else [])
    agg = checked.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"),
                                     F.count_if(F.col(rejected_col)).alias("rejects"))
    limit = S.MAX_ERRORS_PER_BATCH if batch_col else S.MAX_ERRORS_PER_FILE
    rate = pct("rejects", "rows", 2)
    verdict = (F.when(F.col("rejects") > limit, F.lit("fail"))
               .when(rate > S.ERROR_RATE_ALERT_PCT, F.lit("alert")).otherwise(F.lit("ok")))
    return agg.withColumn("reject_pct", rate).withColumn("verdict", verdict)
