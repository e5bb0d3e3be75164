"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators import profile as PR
from feedloom.plans import standins as SI
from feedloom.plans.q_clean import raw_case_rows, _RAW_SQL, ws
from feedloom.plans.registry import query

_PROFILE_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_orderpriority": "string"}


def _profile_sql():
    parts = []
    for c in _PROFILE_COLS:
        parts.append(f"""SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count,
       COUNT({c}) AS non_null_count, COUNT(DISTINCT {c}) AS distinct_count,
       CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value,
       '{_TYPES[c]}' AS data_type, round(100.0 * COUNT({c}) / NULLIF(COUNT(*), 0), 1) AS non_null_pct FROM orders""")
    return "\nUNION ALL\n".join(parts)


@query("column_profile", "A9 Q6", _profile_sql())
def column_profile(spark, d):
    return PR.column_profile(SI.table(spark, d, "orders").select(*_PROFILE_COLS))


def _usage_sql():
    parts = [f"""SELECT '{c}' AS field, COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {ws(f'CAST({c} AS VARCHAR)')} <> '')
       AS used, round(100.0 * COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {ws(f'CAST({c} AS VARCHAR)')} <> '')
       / NULLIF(COUNT(*), 0), 1) AS used_pct FROM {_RAW_SQL} r"""
             for c in ["serial_no", "filing_dt", "cancel_pend_in", "mark_identification", "mark_draw_cd"]]
    return "\nUNION ALL\n".join(parts)


@query("field_usage", "A12", _usage_sql())
def field_usage(spark, d):
    raw = raw_case_rows(spark, d)
    return PR.field_usage(raw, ["serial_no", "filing_dt", "cancel_pend_in", "mark_identification", "mark_draw_cd"])


@query("key_candidates", "Q1", """
WITH t AS (SELECT o_orderkey AS serial_no, o_custkey AS registration_number, o_orderkey AS id FROM orders),
s AS (SELECT 'serial_no' AS column_name, 0 AS rank, COUNT(DISTINCT serial_no) AS distinct_count,
             COUNT(*) FILTER (WHERE serial_no IS NULL) AS null_count, COUNT(*) AS n FROM t
      UNION ALL SELECT 'registration_number', 1, COUNT(DISTINCT registration_number),
             COUNT(*) FILTER (WHERE registration_number IS NULL), COUNT(*) FROM t
      UNION ALL SELECT 'id', 2, COUNT(DISTINCT id), COUNT(*) FILTER (WHERE id IS NULL), COUNT(*) FROM t)
SELECT column_name, rank, distinct_count, null_count, null_count = 0 AND distinct_count = n AS qualifies,
       COALESCE(rank = (SELECT MIN(rank) FROM s WHERE null_count = 0 AND distinct_count = n), false) AS chosen
FROM s""")
def key_candidates(spark, d):
    o = SI.table(spark, d, "orders").select(F.col("o_orderkey").alias("serial_no"),
                                            F.col("o_custkey").alias("registration_number"),
                                            F.col("o_orderkey").alias("id"))
    return PR.key_candidates(o)


_CLASS_COLS = ["serial_no", "filing_dt", "cancel_pend_in", "mark_identification", "mark_draw_cd"]


def _class_sql():
    parts = []
    for c in _CLASS_COLS:
        v = ws(c)
        parts.append(f"""SELECT '{c}' AS column_name,
       COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {v} <> '') AS present,
       COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {v} <> '' AND COALESCE(TRY_STRPTIME({v}, '%Y-%m-%d'),
                                                                    TRY_STRPTIME({v}, '%Y%m%d')) IS NOT NULL) AS date_like,
       COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {v} <> '' AND TRY_CAST({v} AS DOUBLE) IS NOT NULL) AS number_like,
       COUNT(*) FILTER (WHERE {c} IS NOT NULL AND {v} <> '' AND lower({v}) IN
                        ('true', '1', '1.0', 'yes', 'y', 'false', '0', '0.0', 'no', 'n', 't', 'f')) AS bool_like
FROM {_RAW_SQL} r""")
    body = "\nUNION ALL\n".join(parts)
    return f"""SELECT *, CASE WHEN present = 0 THEN 'empty'
    WHEN date_like / NULLIF(present, 0) >= 0.9 THEN 'date'
    WHEN ends_with(lower(column_name), '_in') AND bool_like / NULLIF(present, 0) >= 0.9 THEN 'boolean'
    WHEN number_like / NULLIF(present, 0) >= 0.9 THEN 'number'
    WHEN bool_like / NULLIF(present, 0) >= 0.9 THEN 'boolean'
    WHEN contains(lower(column_name), 'date') OR ends_with(lower(column_name), '_dt') THEN 'date'
    ELSE 'text' END AS class FROM ({body}) x"""


@query("column_classes", "Q2", _class_sql())
def column_classes(spark, d):
    return PR.column_classes(raw_case_rows(spark, d).select(*_CLASS_COLS))


@query("typed_schema", "Q5", f"""
SELECT column_name, CASE class WHEN 'date' THEN 'DATE' WHEN 'number' THEN 'NUMERIC' WHEN 'boolean' THEN 'BOOLEAN'
       ELSE 'TEXT' END AS sql_type, column_name = 'serial_no' AS is_key FROM ({_class_sql()}) c""")
def typed_schema(spark, d):
    return PR.typed_schema(PR.column_classes(raw_case_rows(spark, d).select(*_CLASS_COLS)), key="serial_no")
