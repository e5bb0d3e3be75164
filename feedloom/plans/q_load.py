"""Whole deliveries: files of several headers, archives of several members, rejects, batches, formats and reloads
(S3, S4, S8, S9, S11, K1-K6, K11, K12, U3, P10, P12, P13, A16, F13)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from feedloom.functions import clean as C
from feedloom.operators import tables as TB
from feedloom.plans import standins as SI
from feedloom.plans.registry import query
from feedloom.plans.render import CSV_ROWS, XML_ROWS, rendered, spread
from feedloom.session import open_output, scratch_path
from feedloom.sources import csv as CS

NOW = dt.datetime(2024, 2, 1)
BATCH = 1000
CSV_GLOB = "*.[cC][sS][vV]"


def _write_lines(rows, header: str, path: str, extension: str = "csv", by: list[str] | None = None) -> None:
    """Files of ready lines (column ``line``) under a header line; nothing is quoted or escaped.  A folder for each value of ``by``."""
    (rows.select(F.col("line").alias(header), *(by or [])).write.partitionBy(*(by or []))
     .option("header", "true").option("sep", "\u0001").option("quote", "\u0000")
     .option("emptyValue", "").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .option("extension", extension).csv(path))


# Serial numbers with leading zeros; every 40th row is too wide, every 41st too narrow, every 43rd has no number,
# every 37th a date that does not exist.
SERIAL = "lpad(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), 12, '0')"
_ROW = f"""
SELECT l_orderkey % 3 AS generation, l_linenumber, {SERIAL} AS serial, l_orderkey * 10 + l_linenumber AS n,
       strftime(l_shipdate, '%Y-%m-%d') AS day, l_returnflag || ', ' || l_linestatus || ' no. ' || CAST(l_suppkey AS VARCHAR) AS mark FROM lineitem"""
_GOOD = "n % 40 <> 0 AND n % 41 <> 0"


def _feed(li):
    n = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    serial = F.lpad(n.cast("string"), 12, "0")
    return li.select((F.col("l_orderkey") % 3).alias("generation"), "l_linenumber", n.alias("n"),
                     F.when(n % 43 == 0, F.lit("none yet")).otherwise(serial).alias("serial"),
                     F.when(n % 37 == 0, F.lit("2023-02-30")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("day"),
                     F.concat(F.lit('"'), "l_returnflag", F.lit(", "), "l_linestatus", F.lit(" no. "), F.col("l_suppkey").cast("string"), F.lit('"')).alias("mark"))


def _mixed_dir(spark, d):
    """Three generations of one feed: other names, another order, an unknown column, an upper-case extension.

    A generation is written in one job: a line number's rows are dealt to one task before they are rendered, and make one file.
    """
    def render():
        root, li = scratch_path(spark, "mixed"), SI.table(spark, d, "lineitem").where(F.col("l_linenumber").between(1, 7))
        wide, narrow = F.col("n") % 40 == 0, F.col("n") % 41 == 0

        def part(generation, cells, header, name, extension="csv"):
            line = F.concat_ws(",", *cells)
            line = F.when(wide, F.concat(line, F.lit(",EXTRA"))).when(narrow, cells[0]).otherwise(line)
            own = li.where(F.col("l_orderkey") % 3 == generation)
            if own.limit(1).count():
                own = own.repartition("l_linenumber").sortWithinPartitions("l_linenumber")
                rows = _feed(own).select(line.alias("line"), F.col("l_linenumber").alias("ln"))
                _write_lines(rows, header, f"{root}/{name}", extension, ["ln"])
            else:  # a header alone
                _write_lines(_feed(own).select(line.alias("line")).coalesce(1), header, f"{root}/{name}/ln=1", extension)

        c = F.col
        part(0, [c("serial"), c("day"), c("mark")], "Serial Number,Filing-Dt,MARK_ID_CHAR", "first")
        part(1, [c("mark"), c("serial"), c("day")], "mark_identification,serial_no,filing_date", "second")
        part(2, [c("serial"), c("day"), c("mark"), F.concat(F.lit("note "), c("n"))],
             'serial_no,filing_dt,mark_identification,"Extra Note"', "third", "CSV")
        return root
    return rendered(spark, d, "mixed-dir", render)


_MIXED_SQL = f"""
SELECT CASE WHEN n % 43 = 0 THEN NULL ELSE serial END AS serial_no,
       CASE WHEN n % 37 = 0 THEN NULL ELSE day END AS filing_date, mark AS mark_identification,
       CASE WHEN generation = 2 THEN 'note ' || CAST(n AS VARCHAR) END AS extra_note
FROM ({_ROW}) WHERE {_GOOD}"""


@query("mixed_dir", "S3 S4 S11 K12 U3 P3 P9 P10", _MIXED_SQL)
def mixed_dir(spark, d):
    rows, _ = CS.load_text(spark, _mixed_dir(spark, d), glob=CSV_GLOB)
    rows = rows.where(F.col(CS.CORRUPT).isNull())
    day = F.coalesce(C.typed_text("filing_date", "date")[0], C.typed_text("filing_dt", "date")[0]) if "filing_dt" in rows.columns \
        else C.typed_text("filing_date", "date")[0]
    return rows.select(C.typed_text("serial_no", "string")[0].alias("serial_no"), F.date_format(day, "yyyy-MM-dd").alias("filing_date"),
                       C.text_or_null("mark_identification").alias("mark_identification"), "extra_note")


@query("wrong_width_rows", "S3 S4 P13", f"""
SELECT generation, CASE WHEN n % 40 = 0 THEN 'wide' ELSE 'narrow' END AS width, COUNT(*) AS rows
FROM ({_ROW}) WHERE NOT ({_GOOD}) GROUP BY ALL""")
def wrong_width_rows(spark, d):
    rows = CS.read_csv(spark, _mixed_dir(spark, d), glob=CSV_GLOB)
    bad = rows.where(F.col(CS.CORRUPT).isNotNull())
    place = F.regexp_extract("file_path", "/(first|second|third)/", 1)
    generation = F.when(place == "first", 0).when(place == "second", 1).otherwise(2).cast("long")
    width = F.when(F.col(CS.CORRUPT).endswith(",EXTRA"), F.lit("wide")).otherwise(F.lit("narrow"))
    return bad.groupBy(generation.alias("generation"), width.alias("width")).agg(F.count(F.lit(1)).alias("rows"))


@query("evolve_columns", "K12 U3 K1", """
SELECT CAST(o_orderkey AS VARCHAR) AS serial_no, CAST(o_custkey AS VARCHAR) AS registration_number, o_orderstatus AS status_code,
       CAST(NULL AS VARCHAR) AS mark_identification, CAST(NULL AS VARCHAR) AS assignment_id, CAST(NULL AS VARCHAR) AS extra_note FROM orders
UNION ALL
SELECT CAST(l_orderkey AS VARCHAR), NULL, NULL, l_returnflag,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR), l_linestatus FROM lineitem""")
def evolve_columns(spark, d):
    """Files of two generations read as one table: one key column, the columns a file lacks NULL."""
    from feedloom.plans.q_files import _generations
    rows, _ = CS.load_text(spark, _generations(spark, d), glob="*.csv")
    return rows.select("serial_no", "registration_number", "status_code", "mark_identification", "assignment_id", "extra_note")


# --------------------------------------------------------------------------- loads
def _loaded(spark, d):
    """The mixed delivery loaded once a session: (table, rejects, batches)."""
    from feedloom.plans.load import run_load

    def load():
        root = scratch_path(spark, "loaded")
        run_load(spark, _mixed_dir(spark, d), "TRCFECO2", "case_file", f"{root}/table", f"{root}/history", NOW, batch_size=BATCH,
                 rejects_root=f"{root}/rejects", batches_root=f"{root}/batches")
        return root
    return rendered(spark, d, "mixed-loaded", load)


@query("load_rejects", "P13 K11 S11", f"""
SELECT cause, value, COUNT(*) AS rows FROM (
  SELECT CASE WHEN {_GOOD} THEN 'no serial_no' ELSE 'wrong number of fields' END AS cause,
         CASE WHEN {_GOOD} THEN mark WHEN n % 40 = 0 THEN 'EXTRA'
              WHEN generation = 1 THEN '"' || mark || '"' WHEN n % 43 = 0 THEN 'none yet' ELSE serial END AS value
  FROM ({_ROW}) WHERE NOT ({_GOOD}) OR n % 43 = 0) GROUP BY ALL""")
def load_rejects(spark, d):
    """Rejected rows with their cause, read back from where the load kept them."""
    bad = spark.read.parquet(f"{_loaded(spark, d)}/rejects")
    mark = C.text_or_null(F.get_json_object("raw", "$.mark_identification"))
    value = F.when(F.col("cause") == "no serial_no", mark).when(F.col("raw").endswith(",EXTRA"), F.lit("EXTRA")).otherwise(F.col("raw"))
    return bad.groupBy("cause", value.alias("value")).agg(F.count(F.lit(1)).alias("rows"))


@query("batch_history", "A16 W4 P12 K1", f"""
WITH f AS (SELECT generation, l_linenumber, COUNT(*) AS n FROM ({_ROW}) GROUP BY ALL)
SELECT generation, l_linenumber, b AS batch_number, least({BATCH}, n - b * {BATCH}) AS rows_in_batch
FROM f, unnest(range((n + {BATCH} - 1) // {BATCH})) t(b)""")
def batch_history(spark, d):
    """Batch rows of the load: consecutive rows of each file, all rows counted."""
    batches = spark.read.parquet(f"{_loaded(spark, d)}/batches")
    place = F.regexp_extract("file_name", "^([a-z]+)/", 1)
    generation = F.when(place == "first", 0).when(place == "second", 1).otherwise(2).cast("long")
    return batches.select(generation.alias("generation"), F.regexp_extract("file_name", "/ln=(\\d)/", 1).cast("int").alias("l_linenumber"),
                          "batch_number", "rows_in_batch")


@query("json_store", "F13 K1 P9", f"""
SELECT DISTINCT serial AS serial_no, CASE WHEN generation = 2 THEN 'note ' || CAST(n AS VARCHAR) END AS extra_note,
       CASE WHEN n % 37 = 0 THEN '2023-02-30' END AS bad_date, n % 37 = 0 AS flagged
FROM ({_ROW}) WHERE {_GOOD} AND n % 43 <> 0 AND (generation = 2 OR n % 37 = 0)""")
def json_store(spark, d):
    """Columns outside the contract and values that did not convert, read back from the VARIANT beside the row."""
    rows = spark.read.parquet(f"{_loaded(spark, d)}/table").where(F.col("_extras").isNotNull())
    get = lambda name: F.try_variant_get("_extras", f"$.{name}", "string")
    return rows.select("serial_no", get("extra_note").alias("extra_note"),
                       F.coalesce(get("filing_date"), get("filing_dt")).alias("bad_date"), (F.size("bad_columns") > 0).alias("flagged"))


def _zip_of(spark, groups: dict[str, list[str]], extra: dict[str, str]) -> None:
    """Archives built by Spark tasks, one a task: target -> rendered files; ``extra`` goes into each."""
    rows = [(target, path) for target, paths in groups.items() for path in paths]
    files = spark.read.format("binaryFile").load([p for _, p in rows]).select("path", "content")
    wanted = spark.createDataFrame(rows, "target string, path string")

    def build(pdf):
        import io
        import zipfile

        import pandas as pd
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
            for name, text in extra.items():
                zf.writestr(name, text)
            for n, (path, content) in enumerate(sorted(zip(pdf["path"], pdf["content"]))):
                zf.writestr(f"data/{n}.{'xml' if path.endswith('.txt') else 'csv'}", content)
        with open_output(pdf["target"].iloc[0]) as f:
            f.write(buf.getvalue())
        return pd.DataFrame({"n": [len(pdf)]})
    files.join(F.broadcast(wanted), "path").groupBy("target").applyInPandas(build, "n long").count()


def _zip_delivery(spark, d):
    """Archives of equal names in two folders, two CSVs and one XML each, beside one that is no archive."""
    def render():
        src, root = scratch_path(spark, "zip-parts"), scratch_path(spark, "zip-mixed")
        li, o = spread(SI.table(spark, d, "lineitem"), 8, CSV_ROWS), spread(SI.table(spark, d, "orders"), 4, XML_ROWS)
        key = F.concat(F.lit("1"), F.lpad((F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"), 11, "0"))
        (li.select(key.alias("serial_no"), F.concat(F.lit("L"), F.col("l_linenumber").cast("string")).alias("mark_identification"))
         .write.option("header", "true").csv(f"{src}/csv"))
        rec = F.concat(F.lit("<case-file><serial-number>2"), F.lpad(F.col("o_orderkey").cast("string"), 11, "0"),
                       F.lit("</serial-number><case-file-header><mark-identification>"), F.col("o_orderstatus"),
                       F.lit("</mark-identification></case-file-header></case-file>"))
        o.select(rec.alias("value")).write.text(f"{src}/xml")
        files = lambda sub: sorted(r.path for r in spark.read.format("binaryFile").load(f"{src}/{sub}").select("path").collect())
        csvs, xmls = files("csv"), files("xml")
        groups = {f"{root}/d{i % 2}/feed{i // 2}.zip": [*csvs[2 * i:2 * i + 2], *xmls[i:i + 1]] for i in range(max(-(-len(csvs) // 2), len(xmls)))}
        _zip_of(spark, {t: p for t, p in groups.items() if p}, {"README.txt": "layout notes", "docs/spec.pdf": "%PDF-1.4"})
        with open_output(f"{root}/d0/broken.zip") as f:
            f.write(b"this is no archive")
        return root
    return rendered(spark, d, "zip-delivery", render)


@query("zip_mixed", "S8 S9 S11 K6", f"""
SELECT DISTINCT '1' || lpad(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), 11, '0') AS serial_no,
       'L' || CAST(l_linenumber AS VARCHAR) AS mark_identification, 'csv' AS kind
FROM lineitem
UNION ALL
SELECT '2' || lpad(CAST(o_orderkey AS VARCHAR), 11, '0'), o_orderstatus, 'xml' FROM orders""")
def zip_mixed(spark, d):
    """Every member of every archive is loaded by its type; a file that is no archive stops nothing."""
    from feedloom.plans.load import run_load
    root = scratch_path(spark, "zip-loaded")
    run_load(spark, _zip_delivery(spark, d), "TRCFECO2", "case_file", f"{root}/table", f"{root}/history", NOW)
    return spark.read.parquet(f"{root}/table").select("serial_no", "mark_identification", F.regexp_extract("file_name", r"\.(\w+)$", 1).alias("kind"))


@query("two_formats", "K1 K2 K11 P10", """
SELECT lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS serial_no, strftime(o_orderdate, '%Y-%m-%d') AS filing_date,
       CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE o_orderstatus END AS mark_identification,
       CASE WHEN o_orderkey % 2 = 0 THEN 'TRCFECO2 [CSV]' ELSE 'TRCFECO2 [XML]' END AS data_source FROM orders""")
def two_formats(spark, d):
    """A CSV delivery, then an XML delivery of all keys, into one table: one schema, the stored rows stay."""
    from feedloom.plans.load import run_load
    src, out, o = scratch_path(spark, "formats"), scratch_path(spark, "formats-loaded"), SI.table(spark, d, "orders")
    key = F.lpad(F.col("o_orderkey").cast("string"), 9, "0")
    o = spread(o, 3, XML_ROWS)
    (o.where("o_orderkey % 2 = 0").select(key.alias("Serial No"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("filing_date"),
                                          F.col("o_orderpriority").alias("mark_identification"))
     .write.option("header", "true").csv(f"{src}/one"))
    rec = F.concat(F.lit("<case-file><serial-number>"), key, F.lit("</serial-number><case-file-header><filing-date>"),
                   F.date_format("o_orderdate", "yyyyMMdd"), F.lit("</filing-date><mark-identification>"), F.col("o_orderstatus"),
                   F.lit("</mark-identification></case-file-header></case-file>"))
    o.select(rec.alias("value")).write.option("extension", "xml").text(f"{src}/parts")
    # The text writer names its files .txt; an archive gives them their name, three files in each.
    parts = sorted(r.path for r in spark.read.format("binaryFile").load(f"{src}/parts").select("path").collect())
    _zip_of(spark, {f"{src}/two/feed{i // 3}.zip": parts[i:i + 3] for i in range(0, len(parts), 3)}, {})
    for step in ("one", "two"):
        run_load(spark, f"{src}/{step}", "TRCFECO2", "case_file", f"{out}/table", f"{out}/history", NOW)
    rows = spark.read.parquet(f"{out}/table")
    return rows.select("serial_no", F.date_format("filing_date", "yyyy-MM-dd").alias("filing_date"), "mark_identification", "data_source")


@query("reload", "K4 K5 K6 J4 A16", """
SELECT 'csv' AS kind, 'completed' AS status, 1 AS attempts, COUNT(*) AS rows_processed, COUNT(DISTINCT l_orderkey * 10 + l_linenumber) AS rows_saved,
       CAST(NULL AS VARCHAR) AS message FROM lineitem
UNION ALL SELECT 'xml', 'completed', 1, COUNT(*), COUNT(*), NULL FROM orders
UNION ALL SELECT 'zip', 'error', 3, NULL, NULL, 'not a readable archive: File is not a zip file' WHERE EXISTS (SELECT 1 FROM orders)""")
def reload(spark, d):
    """Three loads of one delivery leave the state of one; the broken archive is tried again each time."""
    from feedloom.plans.load import run_load
    root = scratch_path(spark, "reloaded")
    for day in (1, 2, 3):
        run_load(spark, _zip_delivery(spark, d), "TRCFECO2", "case_file", f"{root}/table", f"{root}/history", dt.datetime(2024, 2, day))
    h = TB.read_current(spark, f"{root}/history")
    kind = F.regexp_extract("file_name", r"\.(\w+)$", 1)
    return h.groupBy(kind.alias("kind"), "status", F.col("processing_attempts").alias("attempts")).agg(
        F.sum("rows_processed").alias("rows_processed"), F.sum("rows_saved").alias("rows_saved"), F.max("error_message").alias("message"))


# --------------------------------------------------------------------------- XML
@query("xml_namespaces", "A14", """
SELECT 'urn:feed:' || CAST(l_linenumber AS VARCHAR) AS uri, CASE WHEN l_linenumber % 2 = 0 THEN 'tm' ELSE '' END AS prefix, CAST(1 AS BIGINT) AS files
FROM lineitem GROUP BY l_linenumber""")
def xml_namespaces(spark, d):
    """Namespaces declared by the root elements of a folder of documents."""
    from feedloom.sources.xml import namespaces
    root = scratch_path(spark, "namespaces")
    rows = SI.table(spark, d, "lineitem").select("l_linenumber", F.concat(F.lit("<r>"), "l_orderkey", F.lit("</r>")).alias("line"))
    for k in range(1, 8):
        attr = f'xmlns:tm = "urn:feed:{k}"' if k % 2 == 0 else f"xmlns='urn:feed:{k}'"
        own = rows.where(F.col("l_linenumber") == k)
        if own.limit(1).count():
            _write_lines(own.coalesce(1), f'<?xml version="1.0"?><!-- feed --><rows {attr} other="x">', f"{root}/{k}", "xml")
    return namespaces(spark, root, glob="*.xml").groupBy("prefix", "uri").agg(F.count(F.lit(1)).alias("files"))


@query("nested_proceedings", "X6 S12", """
SELECT 'P' || CAST(o_orderkey AS VARCHAR) AS proceeding_number, CASE WHEN o_orderkey % 2 = 0 THEN 'OPP' ELSE 'CAN & X' END AS proceeding_type,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS status, strftime(o_orderdate, '%Y-%m-%d') AS filing_date
FROM orders""")
def nested_proceedings(spark, d):
    """Proceedings whose fields lie deeper than the record's children, prefixed, or in another case."""
    from feedloom.operators.extract import PROCEEDING_SCHEMA, extract_proceedings
    from feedloom.sources.xml import read_xml
    root, o = scratch_path(spark, "nested-proceedings"), spread(SI.table(spark, d, "orders"), 3, XML_ROWS)
    kind = F.when(F.col("o_orderkey") % 2 == 0, F.lit("<proceeding-type>OPP</proceeding-type>")).otherwise(
        F.lit("<info><ns:type-code>CAN &amp; X</ns:type-code></info>"))
    status = F.when(F.col("o_orderkey") % 5 == 0, F.lit("<state><STATUS/></state>")).otherwise(
        F.concat(F.lit("<state><STATUS code='1'>"), "o_orderstatus", F.lit("</STATUS></state>")))
    rec = F.concat(F.lit("<proceeding-entry xmlns:ns='u'><head><id><proceeding-number>P"), F.col("o_orderkey").cast("string"),
                   F.lit("</proceeding-number></id></head>"), kind, status, F.lit("<dates><day><filed-date> "),
                   F.date_format("o_orderdate", "yyyyMMdd"), F.lit(" </filed-date></day></dates></proceeding-entry>"))
    o.select(rec.alias("value")).write.text(root)
    rows = extract_proceedings(read_xml(spark, root, "proceeding-entry", PROCEEDING_SCHEMA), "TTABYR")
    return rows.select("proceeding_number", "proceeding_type", "status", F.date_format("filing_date", "yyyy-MM-dd").alias("filing_date"))
