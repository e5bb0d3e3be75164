"""Cleaning, typing, renaming and scalar-function queries.

Dirty inputs are made deterministically from the whole driver tables (a
token chosen by key) and the oracle repeats the same expression.  Dates in
results are rendered as ISO text so both engines report the same values.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom import schemas as S
from feedloom.functions import clean as C
from feedloom.functions import names as N
from feedloom.operators import positions as P
from feedloom.plans import standins as SI
from feedloom.plans.registry import query


def tok(tokens: list[str | None], key: str):
    """Pick ``tokens[key % len]`` (Spark side)."""
    arr = F.array(*[F.lit(t).cast("string") for t in tokens])
    return F.element_at(arr, (F.col(key) % len(tokens)).cast("int") + 1)


def tok_sql(tokens: list[str | None], key: str) -> str:
    """Same as ``tok`` in DuckDB SQL."""
    lits = ", ".join("NULL" if t is None else "'" + t.replace("'", "''") + "'" for t in tokens)
    return f"([{lits}])[(({key}) % {len(tokens)}) + 1]"


def ws(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _iso(c):
    return F.date_format(c, "yyyy-MM-dd")


NULL_TOKS = ["NaN", " none ", "", "NULL", "  ", None, "null ", "value", "N/A"]
BOOL_TOKS = ["1", "1.0", "yes", "Y", "0", "0.0", "no", "T", "2", "12.0", "abc", "true", "FALSE", "n", " ", "-1.5"]
INT_TOKS = ["12", "12.0", " 7 ", "abc", "", "3.9", "-4.5", "007", None]
DATE_TOKS = ["2023-01-15", "20230115", "0000-00-00", "", "01/15/2023", "abc", "2023-02-30", "nan", None]
D8_TOKS = ["19550104", "20230001", "20230100", "20230230", "1955010", "abcdefgh", "", None, " 20240229 "]
FLAG_TOKS = ["T", "t", "true", "F", "no", "", " ", "Yes", "TRUE", "x", None]
DIGIT_TOKS = ["12", "007", "1.5", "-3", "abc", "", " 42 ", None]
E2N_TOKS = ["", " a ", "  ", "b", None, "c  "]


@query("clean_nulls", "P6", f"""
SELECT o_orderkey, raw,
       CASE WHEN lower({ws('raw')}) IN ('', 'nan', 'none', 'null') THEN NULL ELSE raw END AS cleaned
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 9 THEN o_orderpriority
                              ELSE {tok_sql(NULL_TOKS, 'o_orderkey')} END AS raw FROM orders) t""")
def clean_nulls(spark, d):
    o = SI.table(spark, d, "orders")
    raw = F.when(F.col("o_orderkey") % 10 == 9, F.col("o_orderpriority")).otherwise(tok(NULL_TOKS, "o_orderkey"))
    return o.select("o_orderkey", raw.alias("raw")).withColumn("cleaned", C.null_token("raw"))


_BOOL_SQL = f"""CASE WHEN lower({ws('raw')}) IN ('true', '1', '1.0', 'yes', 'y') THEN true
            WHEN lower({ws('raw')}) IN ('false', '0', '0.0', 'no', 'n') THEN false
            WHEN TRY_CAST({ws('raw')} AS DOUBLE) IS NOT NULL THEN TRY_CAST({ws('raw')} AS DOUBLE) <> 0
            ELSE NULL END"""


@query("clean_bool", "P8", f"""
SELECT l_orderkey, l_linenumber, raw, {_BOOL_SQL} AS flag
FROM (SELECT l_orderkey, l_linenumber, {tok_sql(BOOL_TOKS, 'l_orderkey + l_linenumber')} AS raw FROM lineitem) t""")
def clean_bool(spark, d):
    li = SI.table(spark, d, "lineitem").withColumn("__k", F.col("l_orderkey") + F.col("l_linenumber"))
    return li.select("l_orderkey", "l_linenumber", tok(BOOL_TOKS, "__k").alias("raw")) \
        .withColumn("flag", C.to_flag_bool("raw"))


@query("clean_int", "P10", f"""
SELECT o_orderkey, raw, CAST(trunc(TRY_CAST({ws('raw')} AS DECIMAL(38,6))) AS BIGINT) AS num
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) || '.0'
                              ELSE {tok_sql(INT_TOKS, 'o_orderkey')} END AS raw FROM orders) t""")
def clean_int(spark, d):
    o = SI.table(spark, d, "orders")
    raw = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))) \
        .otherwise(tok(INT_TOKS, "o_orderkey"))
    return o.select("o_orderkey", raw.alias("raw")).withColumn("num", C.to_whole_number("raw"))


_DATE_SQL = f"""CASE WHEN {ws('raw')} IN ('', '0000-00-00', 'nan') OR raw IS NULL THEN NULL
            ELSE COALESCE(TRY_STRPTIME({ws('raw')}, '%Y-%m-%d'), TRY_STRPTIME({ws('raw')}, '%Y%m%d'),
                          TRY_STRPTIME({ws('raw')}, '%m/%d/%Y'))::DATE END"""


@query("clean_date", "P9", f"""
SELECT o_orderkey, raw, CAST({_DATE_SQL} AS VARCHAR) AS parsed,
       (raw IS NOT NULL AND {ws('raw')} NOT IN ('', '0000-00-00', 'nan') AND {_DATE_SQL} IS NULL) AS unparsable
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                              ELSE {tok_sql(DATE_TOKS, 'o_orderkey')} END AS raw FROM orders) t""")
def clean_date(spark, d):
    o = SI.table(spark, d, "orders")
    raw = F.when(F.col("o_orderkey") % 2 == 0, _iso(F.col("o_orderdate"))).otherwise(tok(DATE_TOKS, "o_orderkey"))
    return o.select("o_orderkey", raw.alias("raw")).select(
        "o_orderkey", "raw", _iso(C.to_date_text("raw")).alias("parsed"),
        C.date_unparsable("raw").alias("unparsable"))


@query("date8", "F1", f"""
SELECT o_orderkey, raw,
       CASE WHEN regexp_full_match({ws('raw')}, '[0-9]{{8}}')
            THEN strftime(TRY_STRPTIME({ws('raw')}, '%Y%m%d'), '%Y-%m-%d') END AS iso_date
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y%m%d')
                              ELSE {tok_sql(D8_TOKS, 'o_orderkey')} END AS raw FROM orders) t""")
def date8(spark, d):
    o = SI.table(spark, d, "orders")
    raw = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyyMMdd")) \
        .otherwise(tok(D8_TOKS, "o_orderkey"))
    return o.select("o_orderkey", raw.alias("raw")).withColumn("iso_date", C.yyyymmdd_to_iso_text("raw"))


@query("xml_flag", "P20", f"""
SELECT o_orderkey, raw,
       CASE WHEN upper(NULLIF({ws('raw')}, '')) LIKE 'T%' THEN 'T'
            WHEN NULLIF({ws('raw')}, '') IS NOT NULL THEN 'F' END AS flag
FROM (SELECT o_orderkey, {tok_sql(FLAG_TOKS, 'o_orderkey')} AS raw FROM orders) t""")
def xml_flag(spark, d):
    o = SI.table(spark, d, "orders")
    return o.select("o_orderkey", tok(FLAG_TOKS, "o_orderkey").alias("raw")).withColumn("flag", C.xml_flag("raw"))


@query("sentinel_null", "P21", f"""
SELECT o_orderkey, NULLIF(NULLIF({ws('raw')}, ''), '0000000') AS registration_number
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '0000000' WHEN o_orderkey % 4 = 1 THEN ' '
                              ELSE lpad(CAST(o_custkey AS VARCHAR), 7, '0') END AS raw FROM orders) t""")
def sentinel_null(spark, d):
    o = SI.table(spark, d, "orders")
    raw = (F.when(F.col("o_orderkey") % 4 == 0, F.lit("0000000")).when(F.col("o_orderkey") % 4 == 1, F.lit(" "))
           .otherwise(F.lpad(F.col("o_custkey").cast("string"), 7, "0")))
    return o.select("o_orderkey", C.no_registration(raw).alias("registration_number"))


@query("digits_int", "P25", f"""
SELECT o_orderkey, raw, CASE WHEN regexp_full_match({ws('raw')}, '[0-9]+') THEN TRY_CAST({ws('raw')} AS BIGINT) END
       AS page_count
FROM (SELECT o_orderkey, {tok_sql(DIGIT_TOKS, 'o_orderkey')} AS raw FROM orders) t""")
def digits_int(spark, d):
    o = SI.table(spark, d, "orders")
    return o.select("o_orderkey", tok(DIGIT_TOKS, "o_orderkey").alias("raw")) \
        .withColumn("page_count", C.digits_to_int("raw"))


@query("empty_to_null", "P7", f"""
SELECT o_orderkey, raw, CASE WHEN raw = '' THEN NULL ELSE {ws('raw')} END AS cleaned
FROM (SELECT o_orderkey, {tok_sql(E2N_TOKS, 'o_orderkey')} AS raw FROM orders) t""")
def empty_to_null(spark, d):
    o = SI.table(spark, d, "orders")
    return o.select("o_orderkey", tok(E2N_TOKS, "o_orderkey").alias("raw")) \
        .withColumn("cleaned", C.empty_to_null_trim("raw"))


@query("composite_id", "F3", f"""
SELECT l_orderkey, l_linenumber,
       CASE WHEN NULLIF({ws('reel')}, '') IS NOT NULL AND NULLIF({ws('frame')}, '') IS NOT NULL
            THEN {ws('reel')} || '-' || {ws('frame')} END AS assignment_id
FROM (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS reel,
             CASE WHEN l_linenumber = 5 THEN ' ' ELSE CAST(l_linenumber AS VARCHAR) END AS frame FROM lineitem) t""")
def composite_id(spark, d):
    li = SI.table(spark, d, "lineitem")
    reel = F.when(F.col("l_linenumber") == 3, F.lit(None).cast("string")).otherwise(F.col("l_orderkey").cast("string"))
    frame = F.when(F.col("l_linenumber") == 5, F.lit(" ")).otherwise(F.col("l_linenumber").cast("string"))
    return li.select("l_orderkey", "l_linenumber", C.composite_id(reel, frame).alias("assignment_id"))


_ADDR_PARTS_SQL = ("CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END",
                   "CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END",
                   "CASE WHEN c_custkey % 4 = 0 THEN '  ' ELSE CAST(c_nationkey AS VARCHAR) END")


@query("address_line", "F4", f"""
SELECT c_custkey, NULLIF(concat_ws(', ', {', '.join(f"NULLIF({ws(p)}, '')" for p in _ADDR_PARTS_SQL)}), '')
       AS address FROM customer""")
def address_line(spark, d):
    c = SI.table(spark, d, "customer")
    p1 = F.when(F.col("c_custkey") % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("c_name"))
    p2 = F.when(F.col("c_custkey") % 5 == 0, F.lit("")).otherwise(F.col("c_mktsegment"))
    p3 = F.when(F.col("c_custkey") % 4 == 0, F.lit("  ")).otherwise(F.col("c_nationkey").cast("string"))
    return c.select("c_custkey", C.join_present(p1, p2, p3).alias("address"))


@query("goods_merge", "F5 U4", f"""
SELECT p_partkey, NULLIF(array_to_string(list_filter(l, lambda x, i: x IS NOT NULL AND NOT list_contains(l[1:i-1], x)),
       '; '), '') AS goods_services
FROM (SELECT p_partkey, [NULLIF({ws('p_type')}, ''), NULLIF({ws('p_brand')}, ''),
                         NULLIF({ws("CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE p_name END")}, ''),
                         NULL, NULLIF({ws("' '")}, '')] AS l FROM part) t""")
def goods_merge(spark, d):
    p = SI.table(spark, d, "part")
    third = F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")).otherwise(F.col("p_name"))
    return p.select("p_partkey", C.distinct_merge("p_type", "p_brand", third, F.lit(None).cast("string"), F.lit(" "))
                    .alias("goods_services"))


@query("first_non_null", "F6", f"""
SELECT o_orderkey, COALESCE(NULLIF({ws("CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE NULL END")}, ''),
                            NULLIF({ws("CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END")}, ''),
                            NULLIF({ws('o_orderstatus')}, '')) AS proceeding_type FROM orders""")
def first_non_null(spark, d):
    o = SI.table(spark, d, "orders")
    a = F.when(F.col("o_orderkey") % 3 == 0, F.lit(" "))
    b = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority"))
    return o.select("o_orderkey", C.first_present(a, b, "o_orderstatus").alias("proceeding_type"))


@query("table_name", "F10 F8 P15", """
SELECT 'P' || CAST(c_custkey AS VARCHAR) AS product_id, 'product_' || lower('P' || CAST(c_custkey AS VARCHAR)) AS table_name,
       upper(c_mktsegment) AS segment
FROM customer WHERE contains(c_mktsegment, 'BUILD') OR starts_with(c_name, 'Customer#0000001')""")
def table_name(spark, d):
    c = SI.table(spark, d, "customer")
    c = c.filter(F.col("c_mktsegment").contains("BUILD") | F.col("c_name").startswith("Customer#0000001"))
    pid = F.concat(F.lit("P"), F.col("c_custkey").cast("string"))
    return c.select(pid.alias("product_id"), C.table_name_of(pid).alias("table_name"),
                    F.upper("c_mktsegment").alias("segment"))


@query("rename_columns", "P2 P3 P4 K12", """
SELECT o_orderkey AS serial_no, o_custkey AS registration_number, strftime(o_orderdate, '%Y-%m-%d') AS filing_date,
       o_orderstatus AS mark_identification, o_orderpriority AS mark_drawing_code, o_totalprice AS exm_attorney_name
FROM orders""")
def rename_columns(spark, d):
    o = SI.table(spark, d, "orders")
    messy = o.select(F.col("o_orderkey").alias(" Serial Number "), F.col("o_custkey").alias("Registration-No"),
                     _iso(F.col("o_orderdate")).alias("FILING_DT"), F.col("o_orderstatus").alias("Mark Id Char"),
                     F.col("o_orderpriority").alias("mark_draw_cd"),
                     F.col("o_totalprice").alias("Examiner Attorney Name"),
                     F.lit("x").alias("file_location"))
    renamed = N.apply_aliases(messy, "canonical", drop=S.CASE_FILE_DROP)
    return N.evolve_serial(renamed)


@query("strict_names", "P1", """
SELECT o_orderkey AS filing_date_yyyymmdd, o_custkey AS mark_id, o_orderstatus AS status_code_2 FROM orders""")
def strict_names(spark, d):
    o = SI.table(spark, d, "orders")
    messy = o.select(F.col("o_orderkey").alias("Filing Date (YYYYMMDD)"), F.col("o_custkey").alias("__Mark--ID__"),
                     F.col("o_orderstatus").alias("status.code #2"))
    return N.normalize_columns(messy, "strict")


@query("align_union", "U3 K1 U2", """
SELECT * FROM (SELECT o_orderkey AS serial_no, o_orderstatus AS status_code, NULL::BIGINT AS batch_number,
                      'orders' AS data_source FROM orders
               UNION ALL BY NAME
               SELECT l_orderkey AS serial_no, NULL AS status_code, CAST(l_linenumber AS BIGINT) AS batch_number,
                      'lineitem' AS data_source FROM lineitem)""")
def align_union(spark, d):
    o = SI.table(spark, d, "orders").select(F.col("o_orderkey").alias("serial_no"),
                                            F.col("o_orderstatus").alias("status_code"),
                                            F.lit("orders").alias("data_source"))
    li = SI.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("serial_no"),
                                               F.col("l_linenumber").cast("bigint").alias("batch_number"),
                                               F.lit("lineitem").alias("data_source"))
    return N.align_union([o, li])


# A raw text "CSV" derived from lineitem, typed by the name-suffix rules.
def raw_case_rows(spark, d, li=None):
    li = SI.table(spark, d, "lineitem") if li is None else li
    k = F.col("l_orderkey") + F.col("l_linenumber")
    return li.select(
        "l_orderkey", "l_linenumber",
        SI.serial_text().alias("serial_no"),
        F.when(k % 11 == 0, F.lit("0000-00-00")).when(k % 13 == 0, F.lit(" "))
         .otherwise(_iso(F.col("l_shipdate"))).alias("filing_dt"),
        F.element_at(F.array(*[F.lit(t) for t in BOOL_TOKS]), (k % len(BOOL_TOKS)).cast("int") + 1)
         .alias("cancel_pend_in"),
        F.when(k % 7 == 0, F.lit("NaN")).otherwise(F.concat(F.lit("  "), F.col("l_returnflag"), F.lit(" ")))
         .alias("mark_identification"),
        F.when(k % 5 == 0, F.lit("12.0")).otherwise(F.col("l_linenumber").cast("string")).alias("mark_draw_cd"),
    )


_RAW_SQL = f"""(SELECT l_orderkey, l_linenumber, {SI.SERIAL_SQL} AS serial_no,
        CASE WHEN (l_orderkey + l_linenumber) % 11 = 0 THEN '0000-00-00'
             WHEN (l_orderkey + l_linenumber) % 13 = 0 THEN ' '
             ELSE strftime(l_shipdate, '%Y-%m-%d') END AS filing_dt,
        {tok_sql(BOOL_TOKS, 'l_orderkey + l_linenumber')} AS cancel_pend_in,
        CASE WHEN (l_orderkey + l_linenumber) % 7 = 0 THEN 'NaN' ELSE '  ' || l_returnflag || ' ' END
          AS mark_identification,
        CASE WHEN (l_orderkey + l_linenumber) % 5 = 0 THEN '12.0' ELSE CAST(l_linenumber AS VARCHAR) END AS mark_draw_cd
      FROM lineitem)"""


def _nt(x: str) -> str:
    return f"CASE WHEN lower({ws(x)}) IN ('', 'nan', 'none', 'null') THEN NULL ELSE {x} END"


@query("typed_projection", "P6 P8 P9 P10 P11 P12", f"""
SELECT l_orderkey, l_linenumber,
       CAST(trunc(TRY_CAST({ws(_nt('serial_no'))} AS DECIMAL(38,6))) AS BIGINT) AS serial_no,
       CAST({_DATE_SQL.replace('raw', _nt('filing_dt'))} AS VARCHAR) AS filing_dt,
       {_BOOL_SQL.replace('raw', _nt('cancel_pend_in'))} AS cancel_pend_in,
       NULLIF({ws(_nt('mark_identification'))}, '') AS mark_identification,
       CAST(trunc(TRY_CAST({ws(_nt('mark_draw_cd'))} AS DECIMAL(38,6))) AS BIGINT) AS mark_draw_cd,
       'TRCFECO2 [CSV]' AS data_source
FROM {_RAW_SQL} t""")
def typed_projection(spark, d):
    raw = raw_case_rows(spark, d)
    cols = ["serial_no", "filing_dt", "cancel_pend_in", "mark_identification", "mark_draw_cd"]
    typed = raw.select("l_orderkey", "l_linenumber", *[C.clean_by_name(c).alias(c) for c in cols],
                       C.lineage_source(F.lit("TRCFECO2"), "csv").alias("data_source"))
    return typed.withColumn("filing_dt", _iso(F.col("filing_dt")))


@query("party_by_role", "X7 W5", """
SELECT conv_id, arg_min(text, turn) FILTER (WHERE upper(trim(role)) = 'USER') AS applicant_name,
       arg_min(text, turn) FILTER (WHERE upper(trim(role)) = 'ASSISTANT') AS opposer_name
FROM conversations GROUP BY conv_id""")
def party_by_role(spark, d):
    cv = SI.table(spark, d, "conversations")
    role = F.upper(F.trim("role"))

    def first_of(code):
        return F.min_by(F.col("text"), F.when(role == code, F.col("turn")))
    # Partial aggregation keeps a hot conversation from landing whole in one task.
    return cv.groupBy("conv_id").agg(first_of("USER").alias("applicant_name"),
                                     first_of("ASSISTANT").alias("opposer_name"))


@query("first_child", "W5", """
SELECT l_orderkey, l_partkey AS first_part, l_quantity AS first_qty FROM (
  SELECT l_orderkey, l_partkey, l_quantity,
         ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS rn
  FROM lineitem) t WHERE rn = 1""")
def first_child(spark, d):
    li = SI.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber",
                                               F.col("l_partkey").alias("first_part"),
                                               F.col("l_quantity").alias("first_qty"))
    return P.first_by_aggregate(li, ["l_orderkey"], ["l_linenumber", "first_part", "first_qty"],
                                ["first_part", "first_qty"])


@query("alternate_aliases", "P5", """
SELECT o_orderkey AS serial_no, o_custkey AS registration_no, strftime(o_orderdate, '%Y-%m-%d') AS filing_dt,
       o_orderstatus AS mark_id_char FROM orders""")
def alternate_aliases(spark, d):
    o = SI.table(spark, d, "orders")
    src = o.select(F.col("o_orderkey").alias("Serial Number"), F.col("o_custkey").alias("registration-number"),
                   _iso(F.col("o_orderdate")).alias("Filing Date"), F.col("o_orderstatus").alias("mark identification"))
    return N.apply_aliases(src, "alternate")


@query("sample_rows", "S15 T6", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 1000""")
def sample_rows(spark, d):
    # Deterministic sample: the first 1000 rows by key (a bounded top-k, not a full sort).
    o = SI.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return o.orderBy("o_orderkey").limit(1000)


@query("align_to_schema", "K1 U3", """
SELECT o_orderkey AS serial_no, CAST(NULL AS VARCHAR) AS registration_number,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS filing_date, '{"status_code":"' || o_orderstatus || '"}' AS _extras
FROM orders""")
def align_to_schema(spark, d):
    from pyspark.sql import types as T
    o = SI.table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("serial_no"),
                                            _iso(F.col("o_orderdate")).alias("filing_date"),
                                            F.col("o_orderstatus").alias("status_code"))
    target = T.StructType([T.StructField("serial_no", T.LongType()),
                           T.StructField("registration_number", T.StringType()),
                           T.StructField("filing_date", T.DateType())])
    return N.align_to(o, target).withColumn("filing_date", F.col("filing_date").cast("string"))
