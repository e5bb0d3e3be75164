"""Secret scan with corpus-wide ownership frequency (operator 3), DataFrame functions only.

Each kind's matches come from one regular expression: ``split`` gives the gaps between matches and
``regexp_extract_all`` the matches, so a match's place is the running length of what stands before it.
Every candidate value is hashed; for each hash the distinct owners and repositories that hold it are
counted over the whole corpus, in two steps so that one value held by a third of all rows meets in
partial sums, and so are the distinct texts that hold it.  A value at ``example_owners`` owners, in
``example_repos`` repositories or in ``example_texts`` texts or more is a widely copied example, also
within one owner; one below all three that looks random is owner-specific ("live"); others are shared.
The method adds the spans of live generic tokens (kind ``owned``) that no base span touches.

Defined results: NULL or empty text has no spans; NULL owner or repository counts as one owner or
repository of its own; rows that repeat an id are scanned on their own and identical rows count once
in the frequencies; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.llm.common import materialize, table

# Fixed patterns of the result's definition; the kinds in their listed order.
ASSIGN = r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: A run of 24 hex digits is the whole run, so short runs need not be cut out first.
HEX_LONG = r"[0-9a-f]{24,}"
GENERIC = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "owned")


def _pieces(kind: int, pattern: str) -> Column:
    """Array of (kind, i, gap, value): the length before match ``i`` and the match; empty without any."""
    text = F.col("t")
    found = F.arrays_zip(
        F.slice(F.transform(F.split(text, pattern, -1), F.length), 1,
                F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"))
    rows = F.transform(found, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"),
                                                    x["gap"].alias("gap"), x["value"].alias("value")))
    return F.when(text.rlike(pattern), rows)


def candidates(df: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str) -> DataFrame:
    """One row per candidate: row key, owner, repository, kind, start, end (code points), value hash."""
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"),
                     F.col(owner_col).cast("string").alias("owner"), F.col(repo_col).cast("string").alias("repo"))
    found = [_pieces(k, p) for k, p in enumerate((ASSIGN, ACCESS, HEX_LONG, GENERIC))]
    empty = F.array().cast("array<struct<kind:int,i:int,gap:int,value:string>>")
    rows = rows.select("id", F.xxhash64("t").alias("th"), "owner", "repo",
                       F.explode(F.concat(*[F.coalesce(x, empty) for x in found])).alias("m"))
    rows = rows.select("id", "th", "owner", "repo", "m.*")
    place = Window.partitionBy("id", "th", "owner", "repo", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    # Equal rows are dropped within tasks first, so a row that repeats over the table meets nowhere whole.
    rows = (rows.dropDuplicates()
            .withColumn("end", F.sum(F.col("gap").cast("long") + F.length("value")).over(place))
            .withColumn("start", F.col("end") - F.length("value")))
    secret = F.when(F.col("kind") == 0, F.regexp_extract("value", ASSIGN, 2)).otherwise(F.col("value"))
    value = F.col("secret")
    keep = (F.when(F.col("kind") == 0, F.length(value) >= 6)
            .when(F.col("kind") == 1, F.length(value) >= 20)
            .when(F.col("kind") == 2, F.length(value) >= 24)
            .otherwise(value.rlike("[A-Z]") & value.rlike("[a-z]")))
    random = (F.length(value) >= 16) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & \
        ~F.lower(value).rlike(r"example|changeme|your[_-]|placeholder|(.)\1{5}")
    return (rows.withColumn("secret", secret).where(keep)
            .select("id", "th", "owner", "repo", "kind", "start", "end",
                    F.unhex(F.sha2(value.cast("binary"), 256)).alias("value_hash"), random.alias("random")))


def ownership(found: DataFrame) -> DataFrame:
    """Per value hash: distinct owners, distinct repositories (within owners), occurrences, distinct texts."""
    held = found.groupBy("value_hash", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    owner = held.groupBy("value_hash", "owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("n").alias("n"))
    texts = found.select("value_hash", "th").distinct().groupBy("value_hash").agg(F.count(F.lit(1)).alias("texts"))
    return owner.groupBy("value_hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"),
                                           F.sum("n").alias("occurrences")).join(texts, "value_hash")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repo_col: str = "lang", example_owners: int = 3, example_repos: int = 4, example_texts: int = 16) -> DataFrame:
    """Per row: counts by kind, digest of the base spans, all spans, candidates by class, and live credentials
    (``n_live`` without bare hex digests)."""
    found = materialize(candidates(df, id_col, text_col, owner_col, repo_col), "secret-candidates")
    # Values at one owner need no look-up of their own count beyond this: the join is on the value's
    # hash, and AQE splits a partition that one hash fills.
    classed = found.join(ownership(found), "value_hash", "left").withColumn(
        "class", F.when((F.col("owners") >= example_owners) | (F.col("repos") >= example_repos)
                        | (F.col("texts") >= example_texts), "example").when(F.col("random"), "live").otherwise("shared"))
    span = F.struct("start", "kind", "end", "class")
    grouped = classed.groupBy("id", "th", "owner", "repo").agg(F.sort_array(F.collect_list(span)).alias("all"))
    base = F.filter("all", lambda s: s["kind"] < 3)
    grouped = grouped.withColumn("base", base)
    clear = F.filter("all", lambda s: (s["kind"] == 3) & (s["class"] == "live") & ~F.exists(
        "base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    grouped = grouped.withColumn("spans", F.sort_array(F.concat("base", clear)))
    name = F.array(*[F.lit(k) for k in KINDS])
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(
        ":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda c, field, value: F.size(F.filter(c, lambda s: s[field] == value)).cast("long")
    grouped = grouped.select(
        F.col("id").alias("id_"), F.col("th").alias("th_"), F.col("owner").alias("owner_"), F.col("repo").alias("repo_"),
        *[count("base", "kind", k).alias(f"n_{KINDS[k]}") for k in range(3)],
        text("base").alias("base"), text("spans").alias("spans"),
        *[count("spans", "class", c).alias(f"n_{c}") for c in ("live", "shared", "example")],
        F.size(F.filter("spans", lambda s: (s["class"] == "live") & (s["kind"] != 2))).cast("long").alias("n_live_credential"))
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"),
                     F.col(owner_col).cast("string").alias("owner"), F.col(repo_col).cast("string").alias("repo"))
    same = [F.col(c).eqNullSafe(F.col(c + "_")) for c in ("id", "th", "owner", "repo")]
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return rows.join(grouped, same, "left").select(
        F.col("id").alias(id_col), *[number(f"n_{k}") for k in KINDS[:3]],
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"), number("n_live"), number("n_shared"), number("n_example"),
        number("n_live_credential"))


def secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents: the source is the owner, a language's part of it a repository."""
    return scan(table(spark, sf_dir, "documents")).drop("n_live_credential")
