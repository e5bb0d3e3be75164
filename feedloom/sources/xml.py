"""XML record scans.

The built-in XML reader produces one partition per file, which does not
scale to multi-GB feed files.  The split scan used here treats the record's
literal close tag as the line separator of the text source, so Hadoop's
record reader splits the file into many input splits and hands every record
to exactly one task.  Each chunk then holds at most one record (plus any
prologue or wrapper text before it); the record is cut out with a regular
expression, its close tag appended, and parsed with ``from_xml`` against an
explicit schema.  Namespace prefixes are ignored by the parser.

Malformed records keep their text in ``_corrupt_record`` with all fields
NULL so callers can split good rows from rejects.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import schemas as S

XML_OPTIONS = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record",
               "attributePrefix": "@", "valueTag": "text", "ignoreSurroundingSpaces": "true"}


def close_tag(tag: str, prefix: str | None = None) -> str:
    return f"</{prefix}:{tag}>" if prefix else f"</{tag}>"


def record_tags(spark: SparkSession, paths, tags: list[str], glob: str | None = None) -> DataFrame:
    """(file_path, prefix, tag) of every listed tag that opens an element; prefix is '' without a namespace.

    The text is cut at '>', so files split and no row is longer than a tag and the text before it.  Rows
    without a tag's name are left out by plain string search before the pattern is tried.
    """
    reader = spark.read.option("lineSep", ">")
    if glob:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    pat = r"<(?:([A-Za-z_][\w.-]*):)?(" + "|".join(re.escape(t) for t in tags) + r")(?:\s[^<]*)?/?$"
    named = reduce(or_, [F.contains("value", F.lit(t)) for t in tags])
    found = (reader.text(paths).select(F.col("_metadata.file_path").alias("file_path"), "value")
             .filter(named & F.col("value").rlike(pat)))
    return found.select("file_path", F.regexp_extract("value", pat, 1).alias("prefix"),
                        F.regexp_extract("value", pat, 2).alias("tag")).distinct()


def namespaces(spark: SparkSession, paths, glob: str | None = None) -> DataFrame:
    """(file_path, prefix, uri) of the namespaces that each file's root element declares ('' is the default one).

    The text is cut at '>' and only the first split of each file is kept: one row a file leaves a task.
    """
    reader = spark.read.option("lineSep", ">")
    if glob:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    rows = (reader.text(paths).where(F.col("_metadata.file_block_start") == 0)
            .select(F.col("_metadata.file_path").alias("file_path"), "value", F.monotonically_increasing_id().alias("at"))
            .where(F.col("value").rlike(r"<[A-Za-z_][^<]*$")))
    root = rows.groupBy("file_path").agg(F.min_by("value", "at").alias("tag"))
    found = F.regexp_extract_all("tag", F.lit(r"""\sxmlns(?::[\w.-]+)?\s*=\s*(?:"[^"]*"|'[^']*')"""), F.lit(0))
    decl = root.select("file_path", F.explode(found).alias("d"))
    return decl.select("file_path", F.regexp_extract("d", r"xmlns:([\w.-]+)", 1).alias("prefix"),
                       F.regexp_extract("d", r"""=\s*["'](.*)["']$""", 1).alias("uri"))


def detect_prefix(spark: SparkSession, paths, tag: str, glob: str | None = None) -> str | None:
    """Namespace prefix used for ``tag`` (e.g. 'ns' for ``<ns:tag>``) anywhere in the files, or None.

    The split scan needs the literal close tag, prefix included.
    """
    first = record_tags(spark, paths, [tag], glob).agg(F.min(F.when(F.col("prefix") != "", F.col("prefix")))).first()
    return first[0]


def record_texts(spark: SparkSession, paths, tag: str, prefix: str | None = None,
                 glob: str | None = None) -> DataFrame:
    """One row per record: (file_path, block_start, record) -- the raw XML of each ``tag`` element.

    ``prefix="auto"`` looks for a namespace prefix in the files.
    """
    if prefix == "auto":
        prefix = detect_prefix(spark, paths, tag, glob)
    end = close_tag(tag, prefix)
    reader = spark.read
    if glob:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    raw = (reader.option("lineSep", end).option("wholetext", "false").text(paths)
           .select("value", F.col("_metadata.file_path").alias("file_path"),
                   F.col("_metadata.file_block_start").alias("block_start")))
    name = f"{prefix}:{tag}" if prefix else tag
    # The record starts at the first "<tag" followed by '>', whitespace or '/'.  One pattern stops at that place; a
    # search for each of these endings would run through the whole record for every one it lacks.
    v, opens = F.col("value"), rf"<{re.escape(name)}[> \t\n\r/]"
    frag = F.substr(v, F.position(F.regexp_extract(v, opens, 0), v))
    return (raw.filter(v.rlike(opens))
            .select("file_path", "block_start", F.concat(frag, F.lit(end)).alias("record")))


def parse_records(records: DataFrame, schema: T.StructType, col: str = "record") -> DataFrame:
    """Parse XML record strings with an explicit schema (corrupt text kept in ``_corrupt_record``)."""
    sch = schema if "_corrupt_record" in schema.fieldNames() else \
        T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
    return records.withColumn("rec", F.from_xml(F.col(col), sch, XML_OPTIONS))


def read_xml(spark: SparkSession, paths, tag: str, schema: T.StructType, prefix: str | None = None,
             glob: str | None = None) -> DataFrame:
    """Split scan + parse; columns: file_path, block_start, record, rec (struct)."""
    return parse_records(record_texts(spark, paths, tag, prefix, glob), schema)


def read_xml_small(spark: SparkSession, paths, tag: str, schema: T.StructType) -> DataFrame:
    """The built-in reader (one task per file); fine for small daily files."""
    if "_corrupt_record" not in schema.fieldNames():
        schema = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
    r = spark.read.format("xml").option("rowTag", tag).options(**XML_OPTIONS).schema(schema).load(paths)
    return r


def read_xml_whole(spark: SparkSession, paths, tag: str, schema: T.StructType) -> DataFrame:
    """S5 in the split-scan layout (file_path + ``rec`` struct), so the same extractors apply."""
    r = read_xml_small(spark, paths, tag, schema)
    return r.select(F.col("_metadata.file_path").alias("file_path"),
                    F.struct(*[F.col(f"`{c}`") for c in r.columns]).alias("rec"))


def read_family(spark: SparkSession, paths, family: str, schema: T.StructType,
                prefix: str | None = None, glob: str | None = None) -> DataFrame:
    """Every record tag of a family, unioned: one split scan per (tag, prefix) over the files that hold it.

    A file without a tag is not scanned for it (the scan would return it as one row); files that hold
    no known tag of a family with a fallback marker go through ``fallback_records``.  Only
    file names reach the driver.  With ``prefix`` given, only records with that prefix are read.
    """
    held: dict[tuple, list[str]] = {}
    known: set[str] = set()
    for r in record_tags(spark, paths, S.RECORD_TAGS[family], glob).orderBy("tag", "prefix", "file_path").collect():
        held.setdefault((r.tag, r.prefix or None), []).append(unquote(r.file_path))
        known.add(unquote(r.file_path))
    out = None
    for (t, p), files in held.items():
        if prefix not in (None, "auto", p):
            continue
        f = read_xml(spark, files, t, schema, p).withColumn("record_tag", F.lit(t))
        out = f if out is None else out.unionByName(f)
    if family in S.FALLBACK_MARKERS:
        reader = spark.read
        if glob:
            reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
        plain = lambda f: re.sub(r"^(\w+:)/+", r"\1/", f)  # noqa: E731  (listings write file:/ or file:///)
        known = set(map(plain, known))
        others = [f for f in map(unquote, reader.text(paths).inputFiles()) if plain(f) not in known]
        if others:
            parent, found = fallback_records(spark, others, S.FALLBACK_MARKERS[family], prefix=prefix)
            if parent:
                f = parse_records(found, schema)
                out = f if out is None else out.unionByName(f)
    if out is None:
        empty = spark.createDataFrame([], "file_path string, block_start long, record string")
        out = parse_records(empty, schema).withColumn("record_tag", F.lit(None).cast("string"))
    return out


def flat_schema(tags: list[str]) -> T.StructType:
    """Schema of a flat record: every listed child as text."""
    return T.StructType([T.StructField(t, T.StringType()) for t in tags])


def generic_records(spark: SparkSession, paths, tag: str, prefix: str | None = None) -> DataFrame:
    """Flat record scan; the fields are the distinct leaf names of all records, in name order.

    Leaf children become text columns named by the local tag ('-' -> '_', lower case).
    """
    recs = record_texts(spark, paths, tag, prefix)
    leaf = F.lit(r"<(?:[\w.-]+:)?([\w.-]+)(?:\s[^>]*)?>[^<]*</")
    names = recs.select(F.explode(F.array_distinct(F.regexp_extract_all("record", leaf, 1))).alias("name")).distinct()
    fields = [r["name"] for r in names.filter(F.col("name") != tag).orderBy("name").collect()]
    schema = flat_schema(fields)
    parsed = parse_records(recs, schema)
    cols = [F.nullif(F.trim(F.col("rec").getField(t)), F.lit("")).alias(t.replace("-", "_").lower())
            for t in fields]
    return parsed.select("file_path", *cols, F.col("rec._corrupt_record").alias("_corrupt_record"))


def marker_parents(spark: SparkSession, paths, marker: str, glob: str | None = None) -> DataFrame:
    """(file_path, prefix, parent): the innermost elements around each ``marker``, from the whole files.

    The text is cut at '>' as in ``record_tags``.  Each split keeps a stack of its own and hands on what
    it cannot settle (closes of elements opened before it, markers right under those, elements left
    open: at most the depth of the document); the splits of a file are then put together in order.  A
    comment or CDATA section is passed over, unless the split begins within it.
    """
    reader = spark.read.option("lineSep", ">")
    if glob:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    rows = reader.text(paths).select(F.col("_metadata.file_path").alias("file_path"),
                                     F.col("_metadata.file_block_start").alias("block"), "value")
    rows = rows.filter(F.col("value").contains("<") | F.col("value").endswith("--") | F.col("value").endswith("]]"))

    def run(batches):
        import pandas as pd
        tag = re.compile(r"<(/?)([A-Za-z_][\w.:-]*)(?:\s[^<]*?)?(/?)$")
        key, opened, events, found, skip = None, [], [], set(), None
        for pdf in batches:
            out = []
            for path, block, v in zip(pdf["file_path"], pdf["block"], pdf["value"]):
                if (path, block) != key:
                    if key:
                        out.append((*key, events + [f"o{t}" for t in opened] + [f"p{t}" for t in sorted(found)]))
                    key, opened, events, found, skip = (path, block), [], [], set(), None
                if skip:
                    skip = None if v.endswith(skip) else skip
                    continue
                for start, end in (("<!--", "--"), ("<![CDATA[", "]]")):
                    at = v.find(start)
                    if at >= 0:
                        skip = None if v.endswith(end) and len(v) >= at + len(start + end) else end
                        break
                else:
                    m = tag.search(v)
                    if m and m[1]:
                        if m[2] in opened:
                            while opened.pop() != m[2]:
                                pass
                        else:
                            opened.clear()
                            events.append(f"c{m[2]}")
                    elif m:
                        if m[2].rpartition(":")[2] == marker:
                            if opened:
                                found.add(opened[-1])
                            elif not events or events[-1] != "m":
                                events.append("m")
                        if not m[3]:
                            opened.append(m[2])
            if out:
                yield pd.DataFrame(out, columns=["file_path", "block", "events"]).astype({"file_path": object})
        if key:
            yield pd.DataFrame([(*key, events + [f"o{t}" for t in opened] + [f"p{t}" for t in sorted(found)])],
                               columns=["file_path", "block", "events"]).astype({"file_path": object})

    def together(pdf):
        import pandas as pd
        opened, found = [], set()
        for events in pdf.sort_values("block")["events"]:
            for e in events:
                kind, name = e[0], e[1:]
                if kind == "c" and name in opened:
                    while opened.pop() != name:
                        pass
                elif kind == "m" and opened:
                    found.add(opened[-1])
                elif kind == "o":
                    opened.append(name)
                elif kind == "p":
                    found.add(name)
        names = sorted(found)
        return pd.DataFrame({"file_path": [pdf["file_path"].iloc[0]] * len(names), "prefix": [n.rpartition(":")[0] for n in names],
                             "parent": [n.rpartition(":")[2] for n in names]}, dtype=object)

    parts = rows.mapInPandas(run, "file_path string, block long, events array<string>")
    return parts.groupBy("file_path").applyInPandas(together, "file_path string, prefix string, parent string")


def fallback_records(spark: SparkSession, paths, marker: str = "proceeding-number",
                     candidates: list[str] | None = None, prefix: str | None = None,
                     glob: str | None = None) -> tuple[str | None, DataFrame]:
    """When no known record tag matches, use the innermost elements that contain ``marker``.

    The parent tags are found file by file in the whole text; each (parent, prefix) is then one split scan
    over its files, whose records without the marker are left out.  Returns the parent tags (joined by
    ',' when files differ; None without any) and the records with their tag.  With ``prefix`` given, only
    elements with that prefix; ``candidates`` restricts the parents.
    """
    held: dict[tuple, list[str]] = {}
    for r in marker_parents(spark, paths, marker, glob).orderBy("parent", "prefix", "file_path").collect():
        if prefix in (None, "auto", r.prefix or None) and (candidates is None or r.parent in candidates):
            held.setdefault((r.parent, r.prefix or None), []).append(unquote(r.file_path))
    out = None
    for (t, p), files in held.items():
        f = record_texts(spark, files, t, p).withColumn("record_tag", F.lit(t))
        out = f if out is None else out.unionByName(f)
    if out is None:
        return None, spark.createDataFrame([], "file_path string, block_start long, record string, record_tag string")
    opens = r"<(?:[A-Za-z_][\w.-]*:)?" + re.escape(marker) + r"[\s/>]"
    return ",".join(dict.fromkeys(t for t, _ in held)), out.filter(F.col("record").rlike(opens))
