"""Screening queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators import screen as Q
from feedloom.plans import standins as SI
from feedloom.plans.q_clean import ws
from feedloom.plans.registry import query
from feedloom.plans.standins import with_ctes

K = "TRY_CAST(serial_no AS BIGINT)"


@query("range_flags", "P16 P17 P18", with_ctes(["product_rows"], f"""
SELECT table_name, file_name, batch_number, serial_no,
       {K} >= 60000000 AS ge_60000000, {K} > 60000000 AS gt_60000000, {K} >= 60000001 AS ge_60000001,
       {K} BETWEEN 60000001 AND 69999999 AS in_fake_band, {K} < 60000000 AS valid,
       COALESCE(starts_with(serial_no, '600000'), false) OR COALESCE({K} >= 60000000, false) AS prefix_flag,
       {K} IS NULL OR {K} = 0 AS null_or_zero
FROM product_rows"""))
def range_flags(spark, d):
    r = SI.product_rows(spark, d)
    k = Q.numeric_key("serial_no")
    flags = Q.range_flags(k)
    return r.select("table_name", "file_name", "batch_number", "serial_no",
                    *[v.alias(n) for n, v in flags.items()],
                    Q.prefix_or_range(F.col("serial_no"), k).alias("prefix_flag"),
                    Q.null_or_zero(k).alias("null_or_zero"))


@query("key_lookup", "P19", with_ctes(["product_rows"], f"""
SELECT table_name, file_name, batch_number, serial_no FROM product_rows WHERE {K} = 60004001"""))
def key_lookup(spark, d):
    r = SI.product_rows(spark, d)
    return r.filter(Q.numeric_key("serial_no") == 60004001).select("table_name", "file_name", "batch_number",
                                                                     "serial_no")


@query("key_range", "A10", with_ctes(["product_rows"], f"""
SELECT MIN({K}) AS min_key, MAX({K}) AS max_key, MAX({K}) - MIN({K}) AS key_span FROM product_rows"""))
def key_range(spark, d):
    return Q.key_range(SI.product_rows(spark, d), "serial_no")


@query("threshold_buckets", "A11 F9", with_ctes(["product_rows"], f"""
SELECT t.threshold, COUNT(*) FILTER (WHERE {K} >= t.threshold) AS at_or_above,
       round(100.0 * COUNT(*) FILTER (WHERE {K} >= t.threshold) / NULLIF(COUNT(*), 0), 1) AS pct
FROM product_rows CROSS JOIN (VALUES (60000001), (70000000), (80000000)) t(threshold)
GROUP BY t.threshold""").replace("t.threshold, COUNT", "CAST(t.threshold AS BIGINT) AS threshold, COUNT"))
def threshold_buckets(spark, d):
    return Q.threshold_buckets(SI.product_rows(spark, d), "serial_no")


@query("file_verdict", "A17", with_ctes(["product_rows"], f"""
SELECT file_name, rows, non_null_keys, out_of_range, in_range, reason, reason = 'ok' AS accepted FROM (
  SELECT file_name, COUNT(*) AS rows, COUNT(serial_no) AS non_null_keys,
         COUNT(*) FILTER (WHERE {K} >= 60000000) AS out_of_range, COUNT(*) FILTER (WHERE {K} < 60000000) AS in_range,
         CASE WHEN COUNT(serial_no) = 0 THEN 'no keys'
              WHEN COUNT(*) FILTER (WHERE {K} >= 60000000) > 0
                   AND COUNT(*) FILTER (WHERE {K} >= 60000000) = COUNT(serial_no) THEN 'all keys out of range'
              WHEN COUNT(*) FILTER (WHERE {K} < 60000000) = 0 THEN 'no key in range'
              ELSE 'ok' END AS reason
  FROM product_rows GROUP BY file_name) t"""))
def file_verdict(spark, d):
    return Q.file_verdict(SI.product_rows(spark, d), "file_name", "serial_no")


@query("screen_summary", "A18 F9", with_ctes(["product_rows"], f"""
SELECT batch_number, examined, flagged, examined - flagged AS kept,
       round(100.0 * flagged / NULLIF(examined, 0), 1) AS flagged_pct,
       round(100.0 * (examined - flagged) / NULLIF(examined, 0), 1) AS kept_pct,
       batch_number IS NULL AS is_total
FROM (SELECT batch_number, COUNT(*) AS examined,
             COUNT(*) FILTER (WHERE COALESCE({K} BETWEEN 60000001 AND 69999999, false)) AS flagged
      FROM product_rows GROUP BY ROLLUP (batch_number)) t"""))
def screen_summary(spark, d):
    return Q.screen_summary(SI.product_rows(spark, d), "batch_number", "serial_no")


@query("flag_by_table", "A20 U1", with_ctes(["products", "product_rows"], f"""
SELECT p.table_name, COALESCE(r.out_of_range, 0) AS out_of_range, COALESCE(r.rows, 0) AS rows
FROM products p LEFT JOIN (SELECT table_name, COUNT(*) FILTER (WHERE {K} >= 60000000) AS out_of_range,
                                  COUNT(*) AS rows FROM product_rows GROUP BY table_name) r
  ON p.table_name = r.table_name"""))
def flag_by_table(spark, d):
    return Q.flags_by_table(SI.product_rows(spark, d), SI.products(spark, d), "serial_no")


@query("page_links", "X9", """
SELECT page_id, link, starts_with(link, 'http') AS is_absolute,
       contains(lower(link), '.zip') OR contains(lower(link), '.csv') AS is_data
FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages) t""")
def page_links(spark, d):
    return Q.page_links(SI.table(spark, d, "pages"), "page_id", "html")


def _score_sql(col: str) -> str:
    terms = " + ".join(f"CAST(contains(lower({col}), '{t}') AS INTEGER)" for t in Q.CONTENT_TERMS)
    return terms


@query("keyword_score", "X10", f"""
SELECT page_id, {_score_sql('html')} AS score, ({_score_sql('html')}) >= 2 AS accepted,
       CASE WHEN contains(html, '60000001') THEN 'flagged'
            WHEN contains(html, 'serial_no') OR contains(html, 'serial_number') THEN 'valid' ELSE 'unknown' END AS marker
FROM pages""")
def keyword_score(spark, d):
    p = SI.table(spark, d, "pages")
    return Q.keyword_score(p, "html").select("page_id", "score", "accepted", "marker")


@query("doc_keyword_score", "X10", f"""
SELECT doc_id, {_score_sql('text')} AS score, ({_score_sql('text')}) >= 2 AS accepted FROM documents""")
def doc_keyword_score(spark, d):
    return Q.keyword_score(SI.table(spark, d, "documents"), "text").select("doc_id", "score", "accepted")


_LINE = ws("line")
_MARKED = " OR ".join(f"contains({_LINE}, '{m}')" for m in Q.FAKE_SERIAL_MARKERS)


@query("line_screen", "X12 S16 F14", f"""
SELECT doc_id, COUNT(*) AS lines, COUNT(*) FILTER (WHERE {_MARKED}) AS marked_lines,
       COUNT(*) FILTER (WHERE NOT ({_MARKED}) AND (contains({_LINE}, 'serial_no')
                                                   OR regexp_matches(substr({_LINE}, 1, 10), '[0-9]'))) AS real_lines,
       COUNT(*) FILTER (WHERE {_MARKED}) > 50 AS rejected
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) t GROUP BY doc_id""")
def line_screen(spark, d):
    return Q.line_screen(SI.table(spark, d, "documents"), "doc_id", "text")


@query("remove_empty_rows", "P13 S4", """
SELECT l_orderkey, l_linenumber, a, b FROM (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_linenumber IN (1, 2) THEN NULL ELSE l_returnflag END AS a,
         CASE WHEN l_linenumber = 1 THEN ' ' WHEN l_linenumber = 2 THEN NULL ELSE l_linestatus END AS b
  FROM lineitem) t
WHERE NOT ((a IS NULL OR regexp_replace(a, '^\\s+|\\s+$', '', 'g') = '')
           AND (b IS NULL OR regexp_replace(b, '^\\s+|\\s+$', '', 'g') = ''))""")
def remove_empty_rows(spark, d):
    li = SI.table(spark, d, "lineitem")
    ln = F.col("l_linenumber")
    t = li.select("l_orderkey", "l_linenumber",
                  F.when(ln.isin(1, 2), F.lit(None).cast("string")).otherwise(F.col("l_returnflag")).alias("a"),
                  F.when(ln == 1, F.lit(" ")).when(ln == 2, F.lit(None).cast("string"))
                  .otherwise(F.col("l_linestatus")).alias("b"))
    return Q.remove_empty_rows(t, ["a", "b"])


def _error_budget_sql() -> str:
    from feedloom.plans.registry import ORACLES
    return f"""
SELECT l_orderkey AS file_key, COUNT(*) AS rows, COUNT(*) FILTER (WHERE rejected) AS rejects,
       round(100.0 * COUNT(*) FILTER (WHERE rejected) / NULLIF(COUNT(*), 0), 2) AS reject_pct,
       CASE WHEN COUNT(*) FILTER (WHERE rejected) > 100 THEN 'fail'
            WHEN round(100.0 * COUNT(*) FILTER (WHERE rejected) / NULLIF(COUNT(*), 0), 2) > 5 THEN 'alert'
            ELSE 'ok' END AS verdict
FROM ({ORACLES['conform_reject']}) c GROUP BY l_orderkey"""


from feedloom.plans import q_sinks as _q_sinks  # noqa: E402  (conform_reject must be registered first)


@query("error_budget", "P13 A16 A18", _error_budget_sql())
def error_budget(spark, d):
    checked = _q_sinks.conform_reject(spark, d).withColumnRenamed("l_orderkey", "file_key")
    return Q.error_budget(checked, "file_key")


@query("latest_archives", "W1 P24", SI.with_ctes(["history"], """
SELECT product_id, file_name, download_date FROM (
  SELECT product_id, file_name, download_date,
         ROW_NUMBER() OVER (PARTITION BY product_id ORDER BY download_date DESC, file_name DESC) AS rn
  FROM history) t WHERE rn <= 10"""))
def latest_archives(spark, d):
    from feedloom import schemas as S
    from feedloom.operators import positions as P
    h = SI.history(spark, d).select("product_id", "file_name", "download_date")
    return P.first_n_per_group(h, ["product_id"], [F.col("download_date").desc(), F.col("file_name").desc()],
                               S.KEEP_LATEST_ARCHIVES)
