"""Render driver tables into feed-shaped files (XML, CSV) with Spark, for round-trip queries.

Every record is built from one row with column expressions (no grouping), so
rendering is a map-only job over the whole table.  Files go to a fresh
folder under the session's shared checkpoint location.  The tables are dealt to tasks before they
are rendered (``spread``), so the files grow in number with a table and not in size, and only the
table's own narrow rows cross the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import open_output, scratch_path


#: Rows of a table that one rendered file holds.
CSV_ROWS, XML_ROWS = 250_000, 100_000


def spread(df: DataFrame, files: int, rows: int, like: DataFrame | None = None) -> DataFrame:
    """``df`` dealt to one task a file: ``files`` of them, more where a file would hold over ``rows`` rows.

    ``like`` is counted in its place (a table's own count reads no rows).
    """
    return df.repartition(max(files, -(-(df if like is None else like).count() // rows)))


def esc(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c.cast("string"), F.lit(char), F.lit(entity))
    return c


def el(tag: str, value, indent: str = "\n  ") -> Column:
    """``<tag>value</tag>``; NULL value -> element omitted."""
    v = value if isinstance(value, Column) else F.lit(value)
    return F.when(v.isNotNull(), F.concat(F.lit(f"{indent}<{tag}>"), esc(v), F.lit(f"</{tag}>"))).otherwise(F.lit(""))


def wrap(tag: str, *parts: Column, indent: str = "\n", attrs: str = "") -> Column:
    return F.concat(F.lit(f"{indent}<{tag}{attrs}>"), *parts, F.lit(f"{indent}</{tag}>"))


def write_text(df: DataFrame, spark: SparkSession, name: str) -> str:
    """One compressed file a task (records repeat their tags: about a tenth of the text's size), at the codec's fastest level."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)
    return path


def ymd(c) -> Column:
    return F.date_format(c, "yyyyMMdd")


# --------------------------------------------------------------------------- case files
def case_file_records(orders: DataFrame, tag: str = "case-file", prefix: str | None = None,
                      keep: list[str] | None = None) -> DataFrame:
    k = F.col("o_orderkey")
    t = f"{prefix}:" if prefix else ""
    flags = F.element_at(F.array(*[F.lit(x) for x in ["T", "F", "t", "Yes", "", "x"]]), (k % 6).cast("int") + 1)
    header = wrap(f"{t}case-file-header",
                  el(f"{t}filing-date", F.when(k % 13 == 0, F.lit("20230230")).when(k % 17 == 0, F.lit(""))
                     .otherwise(ymd("o_orderdate")), "\n    "),
                  el(f"{t}status-code", F.col("o_orderstatus"), "\n    "),
                  el(f"{t}mark-identification",
                     F.when(k % 7 == 0, F.concat("o_orderpriority", F.lit(" & Co"))).otherwise(F.col("o_orderpriority")),
                     "\n    "),
                  el(f"{t}trademark-in", flags, "\n    "),
                  el(f"{t}service-mark-in", F.when(k % 2 == 0, F.lit("T")).otherwise(F.lit("F")), "\n    "),
                  el(f"{t}abandon-dt", F.when(F.col("o_orderstatus") == "F", ymd("o_orderdate")), "\n    "),
                  el(f"{t}exm-attorney-name", F.concat(F.lit("Examiner "), (F.col("o_custkey") % 50).cast("string")),
                     "\n    "),
                  indent="\n  ")
    ir = F.when(k % 5 == 0, wrap(f"{t}international-registration",
                                 el(f"{t}international-registration-number", F.concat(F.lit("IR"), k.cast("string")),
                                    "\n    "),
                                 el(f"{t}international-registration-date", ymd(F.date_add("o_orderdate", 30)), "\n    "),
                                 el(f"{t}priority-claimed-in", F.when(k % 10 == 0, F.lit("T")).otherwise(F.lit("F")),
                                    "\n    "),
                                 indent="\n  ")).otherwise(F.lit(""))
    attrs = f' xmlns:{prefix}="urn:example:tm"' if prefix else ""
    rec = wrap(f"{t}{tag}",
               el(f"{t}serial-number", (F.lit(70000000) + k).cast("string")),
               el(f"{t}registration-number", F.when(F.col("o_orderstatus") == "P", F.lit("0000000"))
                  .otherwise(F.lpad(F.col("o_custkey").cast("string"), 7, "0"))),
               header, ir, attrs=attrs)
    return orders.select(*(keep or []), rec.alias("value"))


# --------------------------------------------------------------------------- assignments
def _party(tag: str, name: Column, addr1: Column, city: Column, state: Column, post: Column,
           country: Column | None = None) -> Column:
    i = "\n      "
    return wrap(tag, el("person-or-organization-name", name, i), el("address-1", addr1, i), el("address-2", F.lit(""), i),
                el("city", city, i), el("state", state, i), el("postcode", post, i),
                el("country-name", country, i) if country is not None else F.lit(""), indent="\n    ")


def assignment_records(lineitem: DataFrame) -> DataFrame:
    ln = F.col("l_linenumber")
    n = F.when(ln % 3 == 0, 0).when(ln % 3 == 1, 1).otherwise(3)

    def prop(i: int) -> Column:
        ii = "\n      "
        p = wrap("property",
                 el("serial-no", (F.lit(80000000) + F.col("l_partkey") * 3 + i).cast("string"), ii),
                 el("registration-no", F.lit("") if i == 1 else (F.lit(1000000) + F.col("l_suppkey") * 3 + i)
                    .cast("string"), ii),
                 el("intl-reg-no", F.concat(F.lit("IR"), F.col("l_partkey").cast("string")) if i == 2 else None, ii)
                 if i == 2 else F.lit(""),
                 wrap("trademark-law-treaty-property",
                      el("tlt-mark-name", F.concat(F.lit("MARK "), F.col("l_partkey").cast("string"), F.lit(f"-{i}")),
                         "\n        "), indent=ii),
                 indent="\n    ")
        return F.when(n > i, p).otherwise(F.lit(""))

    conv = (F.when(F.col("l_returnflag") == "R", F.lit("ASSIGNS THE ENTIRE INTEREST"))
            .when(F.col("l_returnflag") == "A", F.lit("SECURITY AGREEMENT")).otherwise(F.lit("CHANGE OF NAME")))
    corr = wrap("correspondent",
                el("person-or-organization-name", F.concat(F.lit("Corr "), F.col("l_suppkey").cast("string")), "\n    "),
                el("address-1", F.concat(F.col("l_suppkey").cast("string"), F.lit(" Main St")), "\n    "),
                el("address-2", F.lit(""), "\n    "),
                el("address-3", F.when(F.col("l_partkey") % 2 == 0,
                                       F.concat(F.lit("Suite "), F.col("l_partkey").cast("string"))), "\n    "),
                el("address-4", F.concat(F.lit("Floor "), ln.cast("string")), "\n    "), indent="\n  ")
    a = wrap("assignment",
             el("reel-no", F.col("l_orderkey").cast("string"), "\n    "),
             el("frame-no", F.when(ln == 7, F.lit("")).otherwise(ln.cast("string")), "\n    "),
             el("date-recorded", ymd("l_shipdate"), "\n    "),
             el("conveyance-text", conv, "\n    "),
             el("purge-indicator", F.lit("N"), "\n    "),
             el("page-count", F.when(ln == 2, F.lit("2a")).otherwise(F.col("l_quantity").cast("bigint").cast("string")),
                "\n    "),
             corr, indent="\n")
    assignors = wrap("assignors",
                     _party("assignor", F.concat(F.lit("Assignor A"), F.col("l_partkey").cast("string")),
                            F.concat(F.col("l_partkey").cast("string"), F.lit(" Oak Ave")),
                            F.concat(F.lit("City"), (F.col("l_partkey") % 10).cast("string")), F.lit("CA"), F.lit("90001"),
                            F.lit("UNITED STATES")),
                     _party("assignor", F.concat(F.lit("Assignor B"), F.col("l_suppkey").cast("string")),
                            F.lit(None).cast("string"), F.lit("Town"), F.lit(None).cast("string"), F.lit("10001")),
                     indent="\n")
    assignees = wrap("assignees",
                     _party("assignee", F.concat(F.lit("Assignee "), F.col("l_orderkey").cast("string")),
                            F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit("ST"),
                            F.lpad((F.col("l_partkey") % 100000).cast("string"), 5, "0")), indent="\n")
    props = F.when(n > 0, wrap("properties", prop(0), prop(1), prop(2), indent="\n")).otherwise(F.lit(""))
    rec = wrap("assignment-entry", a, assignors, assignees, props, indent="\n")
    return lineitem.select(rec.alias("value"))


# --------------------------------------------------------------------------- proceedings
def proceeding_records(orders_with_names: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    num = (F.lit(91000000) + k).cast("string")
    i = "\n    "
    parties = wrap("party-information",
                   F.when(k % 5 == 0, wrap("party", el("role-code", F.lit("P"), "\n      "), indent=i)).otherwise(F.lit("")),
                   wrap("party", el("role-code", F.lit("P"), "\n      "), el("name", F.col("c_name"), "\n      "), indent=i),
                   wrap("party", el("role-code", F.lit(" d "), "\n      "),
                        el("party-name", F.concat(F.lit("Opposer "), (F.col("o_custkey") % 100).cast("string")),
                           "\n      "), indent=i),
                   indent="\n  ")
    goods = F.concat(F.lit("Class "), (k % 45).cast("string"))
    rec = wrap("proceeding-entry",
               F.when(k % 4 == 0, el("number", num)).otherwise(el("proceeding-number", num)),
               F.when(k % 3 == 0, el("type-code", F.col("o_orderpriority"))).otherwise(el("proceeding-type",
                                                                                          F.col("o_orderpriority"))),
               el("status-code", F.col("o_orderstatus")),
               F.when(k % 2 == 0, el("filed-date", ymd("o_orderdate"))).otherwise(el("filing-date", ymd("o_orderdate"))),
               parties,
               F.when(k % 2 == 0, el("mark-text", F.col("c_name"))).otherwise(el("mark-identification", F.col("c_name"))),
               el("goods-services", goods), el("gs-text", goods),
               F.when(k % 2 == 0, el("goods", F.col("o_orderpriority"))).otherwise(F.lit("")),
               indent="\n")
    return orders_with_names.select(rec.alias("value"))


def write_xml_documents(records: DataFrame, spark: SparkSession, name: str, root_tag: str) -> str:
    """Write one well-formed XML document per partition: prologue, ``<root_tag>``, the records.

    Records are streamed to the output batch by batch (Arrow batches), so a task holds at
    most one batch in memory whatever the partition size.
    """
    path = scratch_path(spark, name)

    def run(it):
        import uuid

        import pandas as pd

        out, n = None, 0
        try:
            for pdf in it:
                vals = [v for v in pdf["value"] if v is not None]
                if not vals:
                    continue
                if out is None:
                    out = open_output(f"{path}/part-{uuid.uuid4().hex}.xml")
                    out.write(f'<?xml version="1.0" encoding="UTF-8"?>\n<{root_tag}>\n'.encode("utf-8"))
                out.write(("\n".join(vals) + "\n").encode("utf-8"))
                n += len(vals)
            if out is not None:
                out.write(f"</{root_tag}>\n".encode("utf-8"))
        finally:
            if out is not None:
                out.close()
        yield pd.DataFrame({"records": [n]})

    records.select("value").mapInPandas(run, "records long").agg(F.sum("records")).first()
    return path


_RENDERED: dict[tuple, str] = {}


def rendered(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """Render a fixture once per (application, input folder, name); reuse while its folder exists."""
    from feedloom.session import path_exists
    k = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    p = _RENDERED.get(k)
    if p is None or not path_exists(spark, p):
        p = build()
        _RENDERED[k] = p
    return p
