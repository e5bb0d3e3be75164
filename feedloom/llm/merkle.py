"""Merkle manifest of a dataset by lag and lead windows (operator 12).

Every row is a leaf: the SHA-256 of its framed columns.  Within a group (a language) leaves ascend by id;
every ``ARITY`` consecutive nodes are hashed to a parent, level by level, up to the group's subroot, and
the subroots, ordered by group, likewise up to the root.

Positions come from a range partitioning by (group, id), rows counted per partition and running totals of
those counts, so no group meets in one task.  On each level, a window over blocks of ``WINDOW``
consecutive nodes gives every node the ``ARITY - 1`` rows before and after it by lag and lead columns of
fixed offset; its place in the run masks the lags and the run's length the leads.  What remains are its
siblings, and the run's first child hashes the parent.  Each level has an eighth of the rows of the one
below, and one count (that of the largest group) tells the driver how many there are.

Proofs are laid down from the root: a node's path is its own siblings and its parent's path, so paths
are joined by (group, position of the parent), from one row at the top to one per run of leaves.
Hashes travel as 32 bytes and are spelled in hex only where they are hashed.

Defined results: a NULL column is framed as ``-``; NULL groups form a group of their own, first among the
subroots; NULL ids come first in their group; rows that repeat an id are ordered by their leaf; a NULL id is never
tampered with; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.llm.common import materialize, table

ARITY = 8
#: Nodes of a window: whole runs, few enough for any task.
WINDOW = ARITY ** 3
#: Columns of a leaf, in order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def framed(value: Column) -> Column:
    """``-`` for NULL, else UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def spelled(hashes: Column) -> Column:
    return F.lower(F.hex(hashes))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaves(docs: DataFrame) -> DataFrame:
    """(id, lang, g, h, tampered): a leaf a row, ``g`` a name of the group that is never NULL.

    ``tampered`` is the leaf of the lower-cased text where 3 divides the id's crc32, else NULL.
    """
    def leaf(text: Column) -> Column:
        return digest(F.concat(*[framed(text if c == "text" else F.col(c)) for c in COLUMNS]))

    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return docs.select(F.col("doc_id").alias("id"), "lang", framed(F.col("lang")).alias("g"), leaf(F.col("text")).alias("h"),
                       F.when(chosen, leaf(lower_ascii(F.col("text")))).alias("tampered"))


def ranked(rows: DataFrame, order: list[str | Column], name: str) -> DataFrame:
    """Rows with ``idx``, their position in their group ``g``, and ``n``, the group's size.

    Ties beyond ``order`` are cut by the row's place in the written table, so that any number of equal
    rows spreads over tasks.
    """
    rows = materialize(rows, name).withColumn("tie", F.monotonically_increasing_id())
    keys = [F.col("g"), *order, F.col("tie")]
    placed = materialize(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
                         .withColumn("place", F.monotonically_increasing_id()), f"{name}-sorted")
    part = F.shiftrightunsigned(F.col("place"), 33).alias("part")
    counts = placed.groupBy("g", part).agg(F.count(F.lit(1)).alias("c"), F.min("place").alias("p0"))
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("g", "part", (F.coalesce(F.sum("c").over(before), F.lit(0)) - F.col("p0")).alias("base"),
                           F.sum("c").over(Window.partitionBy("g")).alias("n"))
    return placed.withColumn("part", part).join(counts, ["g", "part"]) \
        .withColumn("idx", F.col("place") + F.col("base")).drop("part", "place", "base")


def siblings(level: DataFrame) -> DataFrame:
    """Nodes (g, idx, n, h, ...) with ``before`` and ``after``, their siblings' hashes left and right, laid end to end."""
    slot, nothing = F.pmod("idx", F.lit(ARITY)), F.lit(b"")
    length = F.least(F.lit(ARITY), F.col("n") - (F.col("idx") - slot))
    block = Window.partitionBy("g", F.floor(F.col("idx") / WINDOW)).orderBy("idx")
    left = [F.when(slot >= j, F.lag("h", j).over(block)).otherwise(nothing) for j in range(ARITY - 1, 0, -1)]
    right = [F.when(slot + j < length, F.lead("h", j).over(block)).otherwise(nothing) for j in range(1, ARITY)]
    return level.withColumn("before", F.concat(*left)).withColumn("after", F.concat(*right))


def parents(level: DataFrame) -> DataFrame:
    """The next level: first children hash their run; a group's only node stays as it is."""
    run = spelled(F.concat("h", "after"))
    return siblings(level).where(F.pmod("idx", F.lit(ARITY)) == 0).select(
        "g", F.floor(F.col("idx") / ARITY).alias("idx"), F.ceil(F.col("n") / ARITY).alias("n"),
        F.when(F.col("n") > 1, digest(run)).otherwise(F.col("h")).alias("h"))


def levels(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Levels from the leaves ``nodes`` (g, idx, n, h) to one node a group."""
    out = [nodes]
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        out.append(materialize(parents(out[-1].select("g", "idx", "n", "h")), f"{name}-{len(out)}"))
        most = -(-most // ARITY)
    return out


def descend(built: list[DataFrame], top: DataFrame, name: str) -> DataFrame:
    """Paths of the lowest level's nodes.  ``top``: (g, path, ...) of every group's last node.

    ``path`` is an array of (before, after), the node's own level first.
    """
    carried = [c for c in top.columns if c != "g"]
    paths = top.select("g", F.lit(0).cast("long").alias("up"), *carried)
    for k in range(len(built) - 2, -1, -1):
        own = F.when(F.col("n") > 1, F.array(F.struct("before", "after"))).otherwise(F.array().cast("array<struct<before:binary,after:binary>>"))
        nodes = siblings(built[k]).withColumn("up", F.floor(F.col("idx") / ARITY)).withColumn("own", own)
        found = nodes.join(paths, ["g", "up"]).withColumn("path", F.concat("own", "path")).drop("before", "after", "own", "up")
        if k == 0:
            return found
        paths = materialize(found.select("g", F.col("idx").alias("up"), *carried), f"{name}-{k}")
    return built[0].withColumn("up", F.col("idx")).join(paths, ["g", "up"]).drop("up")


def proved(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: id, leaf, subroot, root, path and the leaf to fold (``tampered`` where there is one).

    ``path`` holds, level by level up to the root, the hashes left and right of the row's node.
    """
    nodes = materialize(ranked(leaves(docs), [F.col("id"), F.col("h")], "merkle-leaves"), "merkle-nodes")
    built = levels(nodes, "merkle-level")
    langs = nodes.groupBy("g").agg(F.first("lang").alias("lang"))
    subroots = built[-1].select("g", "h").join(langs, "g")
    upper = materialize(ranked(subroots.select(F.lit("").alias("g"), F.col("g").alias("group"), "lang", "h"),
                               [F.col("lang").asc_nulls_first()], "merkle-subroots"), "merkle-upper")
    over = levels(upper, "merkle-upper-level")
    empty = F.array().cast("array<struct<before:binary,after:binary>>")
    top = descend(over, over[-1].select("g", F.col("h").alias("root"), empty.alias("path")), "merkle-upper-paths")
    top = materialize(top.select(F.col("group").alias("g"), F.col("h").alias("subroot"), "root", "path"), "merkle-tops")
    return descend(built, top, "merkle-paths")


def manifest(docs: DataFrame) -> DataFrame:
    """Leaves, roots, proof digests and the check of each (partly tampered) row against the root."""
    rows = proved(docs.select(*COLUMNS))
    proof = F.array_join(F.transform("path", lambda e: spelled(F.concat(e["before"], e["after"]))), "")
    folded = F.aggregate("path", F.coalesce("tampered", "h"),
                         lambda acc, e: digest(F.concat(spelled(e["before"]), spelled(acc), spelled(e["after"]))))
    rows = rows.select(F.col("id").alias("doc_id"), spelled(F.col("h")).alias("leaf"), spelled(F.col("subroot")).alias("subroot"),
                       spelled(F.col("root")).alias("root"), F.sha2(proof.cast("binary"), 256).alias("proof_sha256"),
                       spelled(folded).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def merkle_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def merkle_sql(depth: int = 8) -> str:
    """The manifest in DuckDB SQL for groups of at most ``8 ** depth`` rows."""
    def frame(c: str) -> str:
        return f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(frame(text if c == "text" else c) for c in COLUMNS) + ")"

    alphabet = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    bits = ("list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split(doc_id::varchar, ''), "
            "lambda c: [256 + ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]::bigint[]))), lambda r, b: "
            "CASE WHEN b >= 0 THEN xor(r, b - 256) WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::bigint) ELSE r >> 1 END)")
    sql = [f"""WITH leaf AS MATERIALIZED (SELECT doc_id, lang, {frame('lang')} AS g, {leaf('text')} AS h,
  CASE WHEN xor({bits}, 4294967295::bigint) % 3 = 0 THEN {leaf(f'translate(text, {alphabet})')} END AS t FROM documents),
a0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS idx,
  count(*) OVER (PARTITION BY g) AS n FROM leaf)"""]

    def climb(p: str) -> None:
        for k in range(depth):
            sql.append(f"""{p}{k + 1} AS MATERIALIZED (SELECT g, idx // {ARITY} AS idx, (any_value(n) + {ARITY - 1}) // {ARITY} AS n,
  CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY idx)) ELSE any_value(h) END AS h FROM {p}{k} GROUP BY g, idx // {ARITY})""")

    climb("a")
    sql.append(f"""b0 AS MATERIALIZED (SELECT '' AS g, s.g AS grp, s.h AS h, row_number() OVER (ORDER BY l.lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM a{depth} s JOIN (SELECT g, any_value(lang) AS lang FROM leaf GROUP BY g) l USING (g))""")
    climb("b")
    sql.append(f"p0 AS (SELECT doc_id, g, idx, h AS leaf, coalesce(t, h) AS f, '' AS proof FROM a0)")
    step = 0
    for p in "ab":
        for k in range(depth):
            sql.append(f"""s{p}{k} AS MATERIALIZED (SELECT x.g, x.idx, any_value(x.n) AS n,
  coalesce(string_agg(y.h, '' ORDER BY y.idx) FILTER (y.idx < x.idx), '') AS l, coalesce(string_agg(y.h, '' ORDER BY y.idx) FILTER (y.idx > x.idx), '') AS r
  FROM {p}{k} x JOIN {p}{k} y ON x.g = y.g AND x.idx // {ARITY} = y.idx // {ARITY} GROUP BY x.g, x.idx)""")
            extra = "" if p == "a" else ", p.subroot"
            sql.append(f"""p{step + 1} AS MATERIALIZED (SELECT p.doc_id, p.g, p.idx // {ARITY} AS idx, p.leaf,
  CASE WHEN s.n > 1 THEN sha256(s.l || p.f || s.r) ELSE p.f END AS f, p.proof || s.l || s.r AS proof{extra}
  FROM p{step} p JOIN s{p}{k} s ON p.g = s.g AND p.idx = s.idx)""")
            step += 1
        if p == "a":
            sql.append(f"""p{step + 1} AS MATERIALIZED (SELECT p.doc_id, '' AS g, b.idx, p.leaf, p.f, p.proof, b.h AS subroot FROM p{step} p JOIN b0 b ON p.g = b.grp)""")
            step += 1
    return ",\n".join(sql) + f"""
SELECT p.doc_id, p.leaf, p.subroot, b.h AS root, sha256(p.proof) AS proof_sha256, p.f AS folded_root, p.f = b.h AS verified
FROM p{step} p, b{depth} b"""
