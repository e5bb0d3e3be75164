"""Profiling: column profiles, field usage, key and type inference, XML path profiles.

Column profiles are one aggregation pass producing one wide row, then
``stack`` turns it into one row per column.  Nothing per column runs as a
separate job.  Distinct counts are exact by default; ``exact=False`` switches
to HyperLogLog (``approx_count_distinct``) for very wide or very large inputs.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import schemas as S
from feedloom.functions.clean import number_like, pct, strip_ws, try_date


def _stack(wide: DataFrame, cols: list[str], metrics: list[str], out: list[str]) -> DataFrame:
    n = len(cols)
    args = ", ".join(
        f"'{c}', " + ", ".join(f"`{c}__{m}`" for m in metrics) for c in cols)
    return wide.select(F.expr(f"stack({n}, {args}) as (column_name, {', '.join(out)})"))


def column_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Per column: nulls, non-nulls (+%), distinct values, smallest/largest value as text, type."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    cols = df.columns
    for c in cols:
        col = F.col(f"`{c}`")
        dist = F.countDistinct(col) if exact else F.approx_count_distinct(col)
        aggs += [F.count_if(col.isNull()).alias(f"{c}__nulls"), F.count(col).alias(f"{c}__non_null"),
                 dist.cast("bigint").alias(f"{c}__distinct"),
                 F.min(col).cast("string").alias(f"{c}__min"), F.max(col).cast("string").alias(f"{c}__max")]
    wide = df.agg(*aggs)
    long = _stack(wide, cols,
                  ["nulls", "non_null", "distinct", "min", "max"],
                  ["null_count", "non_null_count", "distinct_count", "min_value", "max_value"])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    dtype = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    return long.withColumn("data_type", dtype[F.col("column_name")]) \
        .withColumn("non_null_pct", pct("non_null_count", F.col("null_count") + F.col("non_null_count")))


def field_usage(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Per field, rows where it is present and non-empty, and the share of all rows."""
    fields = fields or df.columns
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in fields:
        v = F.col(f"`{c}`").cast("string")
        aggs.append(F.count_if(v.isNotNull() & (strip_ws(v) != "")).alias(f"{c}__used"))
    wide = df.agg(*aggs)
    long = wide.select("__rows", F.expr("stack({}, {}) as (field, used)".format(
        len(fields), ", ".join(f"'{c}', `{c}__used`" for c in fields))))
    return long.select("field", "used", pct("used", "__rows").alias("used_pct"))


def key_candidates(df: DataFrame, family: str | None = None) -> DataFrame:
    """Q1: candidate keys in preference order; a candidate qualifies only if unique and never NULL."""
    prefs = ([S.PREFERRED_KEY_BY_FAMILY[family]] if family in S.PREFERRED_KEY_BY_FAMILY else []) + S.KEY_CANDIDATES
    present = [c for c in dict.fromkeys(prefs) if c in df.columns] or df.columns[:1]
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in present:
        aggs += [F.countDistinct(F.col(c)).alias(f"{c}__distinct"), F.count_if(F.col(c).isNull()).alias(f"{c}__nulls")]
    wide = df.agg(*aggs)
    long = wide.select("__rows", F.expr("stack({}, {}) as (column_name, rank, distinct_count, null_count)".format(
        len(present), ", ".join(f"'{c}', {i}, `{c}__distinct`, `{c}__nulls`" for i, c in enumerate(present)))))
    long = long.withColumn("qualifies", (F.col("null_count") == 0) & (F.col("distinct_count") == F.col("__rows")))
    # ``long`` has one row per candidate (at most a handful), so a window over it is tiny
    # and avoids re-scanning the input for the best rank.
    from pyspark.sql import Window
    best = F.min(F.when(F.col("qualifies"), F.col("rank"))).over(Window.partitionBy())
    return long.withColumn("chosen", F.coalesce(F.col("rank") == best, F.lit(False))).drop("__rows")


def _date_ok(s: Column) -> Column:
    return try_date(s, ["yyyy-MM-dd", "yyyyMMdd"]).isNotNull()


def column_classes(df: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Q2: classify each column by its values (date / number / boolean / text), names as a tiebreak."""
    cols = df.columns
    # Strip once per value in a projection; the aggregate then reads the stripped text.
    stripped = df.select(*[strip_ws(F.col(f"`{c}`")).alias(c) for c in cols])
    aggs = []
    for c in cols:
        v = F.col(f"`{c}`")
        present = v.isNotNull() & (v != "")
        aggs += [F.count_if(present).alias(f"{c}__present"),
                 F.count_if(present & _date_ok(v)).alias(f"{c}__date"),
                 F.count_if(present & number_like(v) & v.try_cast("double").isNotNull()).alias(f"{c}__number"),
                 F.count_if(present & F.lower(v).isin(*(S.TRUE_TOKENS + S.FALSE_TOKENS + ["t", "f"])))
                 .alias(f"{c}__bool")]
    long = _stack(stripped.agg(*aggs), cols, ["present", "date", "number", "bool"],
                  ["present", "date_like", "number_like", "bool_like"])
    share = lambda m: F.col(m) / F.nullif(F.col("present"), F.lit(0))
    name = F.lower(F.col("column_name"))
    name_date = name.contains("date") | name.endswith("_dt")
    cls = (F.when(F.col("present") == 0, F.lit("empty"))
           .when(share("date_like") >= threshold, F.lit("date"))
           .when(name.endswith("_in") & (share("bool_like") >= threshold), F.lit("boolean"))
           .when(share("number_like") >= threshold, F.lit("number"))
           .when(share("bool_like") >= threshold, F.lit("boolean"))
           .when(name_date, F.lit("date"))
           .otherwise(F.lit("text")))
    return long.withColumn("class", cls)


SQL_TYPE_OF_CLASS = {"date": "DATE", "number": "NUMERIC", "boolean": "BOOLEAN", "text": "TEXT", "empty": "TEXT"}


def typed_schema(classes: DataFrame, key: str | None = None) -> DataFrame:
    """Q5: column -> SQL type from the inferred classes, plus the key flag and lineage columns."""
    m = F.create_map(*[x for k, v in SQL_TYPE_OF_CLASS.items() for x in (F.lit(k), F.lit(v))])
    cols = classes.select("column_name", m[F.col("class")].alias("sql_type"),
                          (F.col("column_name") == F.lit(key)).alias("is_key") if key else F.lit(False).alias("is_key"))
    return cols


def family_of_columns(inventory: DataFrame, file_col: str = "file_path", col_col: str = "column_name") -> DataFrame:
    """Q3: family per file from marker columns, tested in order (assignment before case file)."""
    sets = inventory.groupBy(file_col).agg(F.collect_set(col_col).alias("__cols"))
    fam = F.lit("unknown")
    for marker, family in reversed(S.FAMILY_MARKERS):
        fam = F.when(F.array_contains("__cols", marker), F.lit(family)).otherwise(fam)
    return sets.select(file_col, fam.alias("family"))


# --------------------------------------------------------------------------- XML structure
WALK_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("depth", T.IntegerType()),
    T.StructField("tag", T.StringType()), T.StructField("attrs", T.ArrayType(T.StringType())),
    T.StructField("attr_values", T.ArrayType(T.StringType())),
    T.StructField("children", T.ArrayType(T.StringType())), T.StructField("has_text", T.BooleanType()),
])


def _local(tag: str) -> str:
    return tag.split("}", 1)[1] if "}" in tag else tag.split(":", 1)[-1]


def _walk_batches(it, col):
    import re
    import xml.etree.ElementTree as ET

    import pandas as pd
    strip = re.compile(r"<(/?)[A-Za-z0-9_.-]+:")
    for pdf in it:
        out = []
        for text in pdf[col]:
            if text is None:
                continue
            try:
                root = ET.fromstring(strip.sub(r"<\1", text))
            except ET.ParseError:
                continue
            stack = [(root, _local(root.tag), 0)]
            while stack:
                el, path, depth = stack.pop()
                kids = list(el)
                names = [_local(k.tag) for k in kids]
                out.append((path, depth, _local(el.tag), sorted(_local(a) for a in el.attrib),
                            [f"{_local(a)}={v}" for a, v in sorted(el.attrib.items())],
                            sorted(set(names)), bool(el.text and el.text.strip())))
                stack.extend((k, f"{path}/{n}", depth + 1) for k, n in zip(kids, names))
        yield pd.DataFrame(out, columns=[f.name for f in WALK_SCHEMA.fields])


def element_walk(records: DataFrame, col: str = "record") -> DataFrame:
    """X11: one row per element of every record: path, depth, attributes, child tags, has text.

    A small per-record Python helper (``mapInPandas`` over Arrow batches); records stay
    where the split scan put them.
    """
    return records.select(col).mapInPandas(lambda it: _walk_batches(it, col), WALK_SCHEMA)


PARTIAL_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("occurrences", T.LongType()),
    T.StructField("depth", T.IntegerType()), T.StructField("attrs", T.ArrayType(T.StringType())),
    T.StructField("children", T.ArrayType(T.StringType())), T.StructField("has_text", T.BooleanType()),
])


def _partial_batches(it, col):
    import re
    import xml.etree.ElementTree as ET
    from collections import Counter

    import pandas as pd
    strip = re.compile(r"<(/?)[A-Za-z0-9_.-]+:")
    for pdf in it:
        acc: dict = {}
        for text, n in Counter(pdf[col]).items():
            if text is None:
                continue
            try:
                root = ET.fromstring(strip.sub(r"<\1", text))
            except ET.ParseError:
                continue
            stack = [(root, _local(root.tag), 0)]
            while stack:
                el, path, depth = stack.pop()
                kids = list(el)
                names = [_local(k.tag) for k in kids]
                a = acc.get(path)
                if a is None:
                    a = acc[path] = [0, depth, set(), set(), False]
                a[0] += n
                a[2].update(_local(x) for x in el.attrib)
                a[3].update(names)
                a[4] = a[4] or bool(el.text and el.text.strip())
                stack.extend((k, f"{path}/{n}", depth + 1) for k, n in zip(kids, names))
        yield pd.DataFrame([(p, v[0], v[1], sorted(v[2]), sorted(v[3]), v[4]) for p, v in acc.items()],
                           columns=[f.name for f in PARTIAL_SCHEMA.fields])


# Text between two tags: blank text goes, and legal text that begins with a visible character becomes one '>' (legal there,
# and visible).  Text with any other character or reference stays as it is, for the parser to judge.  Classes list their
# characters: a list is one table look-up, while ranges are tried one after the other.
def _listed(first: int) -> str:
    return "[" + "".join(f"\\x{i:02x}" for i in (9, 10, 13, *range(32, 127)) if i >= first and chr(i) not in "<>&") + "]"


_ENTITY, _PLAIN = "&(?:amp|lt|gt|quot|apos);", _listed(0) + "*+"
_BETWEEN_TAGS = (r">(?:[ \t\r\n]++(?=<)|(?<=(>))[ \t\r\n]*+(?:" + _listed(33) + "|" + _ENTITY + r"|\p{L})" + _PLAIN
                 + "(?:(?:" + _ENTITY + r"|[^\x00-\x7f\ufffe\uffff]++)" + _PLAIN + "){0,50}+(?=<))")


def structure_text(record) -> Column:
    """A record with its text cut down to whether there is any: as well-formed as the record, with the same elements.

    Comments, CDATA sections, instructions and declarations can hold what looks like tags; such records stay whole.
    """
    c = F.col(record) if isinstance(record, str) else record
    return F.when(c.contains("<!") | c.contains("<?"), c).otherwise(F.regexp_replace(c, F.lit(_BETWEEN_TAGS), F.lit(">$1")))


def path_profile_partials(records: DataFrame, col: str = "record") -> DataFrame:
    """X11 pre-aggregated: per Arrow batch, one row per element path (count, depth, names, text).

    A profile needs no values, so the parser gets ``structure_text``, and records of a batch that are alike in it once.
    """
    return records.select(structure_text(col).alias(col)).mapInPandas(lambda it: _partial_batches(it, col), PARTIAL_SCHEMA)


def xml_path_profile(walk: DataFrame) -> DataFrame:
    """Per path: occurrences, depth, attribute names, child tags, whether any has text.

    Accepts the element walk or its per-batch partials (``path_profile_partials``): both carry
    ``path, depth, attrs, children, has_text`` and, for partials, ``occurrences``.  Sets
    collected here are sets of tag/attribute *names* (bounded by the vocabulary), not values.
    """
    occ = F.sum("occurrences") if "occurrences" in walk.columns else F.count(F.lit(1))
    return walk.groupBy("path").agg(
        occ.cast("bigint").alias("occurrences"), F.min("depth").alias("depth"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("attrs")))).alias("attributes"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("children")))).alias("child_tags"),
        F.bool_or("has_text").alias("has_text"))


def attribute_values(walk: DataFrame) -> DataFrame:
    """Distinct values per attribute, as rows with counts (no unbounded collect)."""
    kv = walk.select(F.explode("attr_values").alias("kv"))
    return kv.select(F.split_part("kv", F.lit("="), F.lit(1)).alias("attribute"),
                     F.regexp_extract("kv", r"^[^=]*=(.*)$", 1).alias("value")) \
        .groupBy("attribute", "value").agg(F.count(F.lit(1)).alias("occurrences"))


def path_mapping(profile: DataFrame, family: str) -> DataFrame:
    """Q4: which leaf paths map to a layout column; unmapped ones get the default name."""
    known = {t: n for t, n, _ in S.CASE_HEADER_FIELDS}
    known.update({t: n for t, n in S.CASE_FLAG_FIELDS})
    known.update({t: n for t, n, _ in S.INTL_REG_FIELDS})
    known.update({"serial-number": "serial_no", "registration-number": "registration_number"})
    leaf = F.element_at(F.split("path", "/"), -1)
    m = F.create_map(*[x for k, v in known.items() for x in (F.lit(k), F.lit(v))])
    default = F.lower(F.regexp_replace(leaf, "-", "_"))
    return profile.filter(F.size("child_tags") == 0).select(
        "path", "occurrences", F.coalesce(m[leaf], default).alias("column_name"),
        m[leaf].isNotNull().alias("mapped"), F.lit(family).alias("family"))


def xml_samples(spark: SparkSession, paths, n: int = 5) -> DataFrame:
    """Q7: records of the first tag pattern (in priority order) that has any, first ``n``, as nested JSON.

    Only files that hold a tag are scanned for it: a scan for a tag that a file lacks would return the file as one row.
    """
    from feedloom.sources.xml import record_tags, record_texts
    held: dict[str, list[str]] = {}
    for r in record_tags(spark, paths, S.SAMPLE_TAG_PATTERNS).where("prefix = ''").orderBy("file_path").collect():
        held.setdefault(r["tag"], []).append(unquote(r["file_path"]))
    for tag in S.SAMPLE_TAG_PATTERNS:
        recs = record_texts(spark, held[tag], tag) if tag in held else None
        if recs is not None and not recs.isEmpty():
            return to_json_tree(recs.limit(n), "record").withColumn("tag", F.lit(tag))
    return spark.createDataFrame([], "record string, tree string, tag string")


def _json_batches(it, col):
    import json
    import re
    import xml.etree.ElementTree as ET

    import pandas as pd
    strip = re.compile(r"<(/?)[A-Za-z0-9_.-]+:")

    def node(el):
        d = {f"@{_local(k)}": v for k, v in el.attrib.items()}
        if el.text and el.text.strip():
            d["text"] = el.text.strip()
        for k in el:
            name = _local(k.tag)
            v = node(k)
            if name in d:
                d[name] = d[name] if isinstance(d[name], list) else [d[name]]
                d[name].append(v)
            else:
                d[name] = v
        if set(d) == {"text"}:
            return d["text"]
        return d

    for pdf in it:
        trees = []
        for text in pdf[col]:
            try:
                trees.append(json.dumps(node(ET.fromstring(strip.sub(r"<\1", text))), sort_keys=True))
            except (ET.ParseError, TypeError):
                trees.append(None)
        yield pd.DataFrame({"record": pdf[col], "tree": trees})


def to_json_tree(records: DataFrame, col: str = "record") -> DataFrame:
    """Any element as a nested JSON tree ('@attr', 'text', repeated child -> list)."""
    return records.select(col).mapInPandas(lambda it: _json_batches(it, col), "record string, tree string")


def structure_report(df: DataFrame, family: str | None = None) -> dict[str, DataFrame]:
    """Q6: the full report of a source as DataFrames (profile, key choice, classes)."""
    return {"rows": df.agg(F.count(F.lit(1)).alias("rows")), "profile": column_profile(df),
            "keys": key_candidates(df, family), "classes": column_classes(df)}

