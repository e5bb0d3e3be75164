"""Product codes of vectors by cover-tree Lloyd rounds (operator 13).

Each component x becomes the integer floor(1024 x) and a vector is cut into ``PARTS`` consecutive parts,
each with a codebook of its own.  The vectors of a task are taken in blocks of ``BLOCK``; for every
part of a block a cover tree is built once and written beside the vectors: a node covers its points
within a radius, its children cover them within ``SHRINK`` times that radius, and the points lie in tree order,
so that every subtree is a range and its sum the difference of two cumulative sums.

A Lloyd round sends the codebooks (a fixed size) to the blocks.  From the root down, a node whose
nearest entry is at d1 and whose second nearest is at d2 is given to the nearest one whole if
d1 + r < d2 - r, as the triangle inequality then holds for all its points; only ambiguous nodes descend, and
the points of ambiguous leaves are compared exactly, in integers.  Sums and counts of each (part, entry)
are added up within a task first and then by Spark; the driver sees one row an entry.  After
``rounds`` rounds the same walk assigns the codes.

Defined results: vectors that are NULL, hold NULL or non-finite components, or whose length differs from that of
the vector of the smallest id are left out; a length that does not divide by ``PARTS`` raises ValueError.  Rows with a NULL id are
coded but start no entry, unless all ids are NULL.  Rows that repeat an id are rows of their own (ties among the first
``ENTRIES`` go by the vector); fewer rows give fewer entries.  A component beyond 2^26 raises OverflowError, as
squared distances would leave 64 bits.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import bounds, materialize, share, shared_value, table

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Vectors of a block, and the radius of children as a share of their parent's.
BLOCK = 2048
SHRINK = 0.75
#: Points of a node that is not split any further.
LEAF = 12
LIMIT = 1 << 26


def integers(flat: np.ndarray) -> np.ndarray:
    """floor(1024 x) of finite components."""
    out = np.floor(flat.astype(np.float64) * SCALE)
    if len(out) and np.abs(out).max() >= LIMIT:
        raise OverflowError(f"components must stay within {LIMIT // SCALE}")
    return out.astype(np.int64)


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, points by entries: in doubles while these hold every term, else in 64-bit integers."""
    most = max((int(np.abs(a).max()) for a in (points, entries) if a.size), default=0)
    kind = np.float64 if 4 * most * most * max(1, points.shape[1]) < 1 << 53 else np.int64
    p, e = points.astype(kind), entries.astype(kind)
    return (p * p).sum(1)[:, None] - 2 * (p @ e.T) + (e * e).sum(1)[None, :]


def cover_tree(points: np.ndarray) -> dict[str, np.ndarray]:
    """Cover tree of integer points: ``order`` (points in tree order) and, per node, centre (a point),
    radius, range [start, end) in that order and range of children (adjacent, after their parent).
    """
    p = points.astype(np.float64)
    order = np.arange(len(p))
    centre, radius, start, end, child, children = [], [], [], [], [], []

    def add(c: int, s: int, e: int, d: np.ndarray) -> None:
        centre.append(c), radius.append(float(d.max())), start.append(s), end.append(e)
        child.append(0), children.append(0)

    def distances(rows: np.ndarray, c: int) -> np.ndarray:
        gap = p[rows] - p[c]
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))

    if len(p):
        add(0, 0, len(p), distances(order, 0))
    node = 0
    while node < len(centre):
        s, e = start[node], end[node]
        if e - s > LEAF and radius[node] > 0:
            rows = order[s:e].copy()
            near = distances(rows, centre[node])
            owner, chosen, within = np.zeros(len(rows), np.int64), [centre[node]], SHRINK * radius[node]
            while near.max() > within:
                # The point farthest from all centres so far becomes one, until they cover the node.
                c = int(rows[near.argmax()])
                d = distances(rows, c)
                closer = d < near
                owner[closer], near = len(chosen), np.where(closer, d, near)
                chosen.append(c)
            by = np.argsort(owner, kind="stable")
            order[s:e], near = rows[by], near[by]
            cuts = bounds(np.bincount(owner, minlength=len(chosen))).tolist()
            child[node] = len(centre)
            for c, a, b in zip(chosen, cuts, cuts[1:]):
                if b > a:
                    add(c, s + a, s + b, near[a:b])
            children[node] = len(centre) - child[node]
        node += 1
    return {"order": order.astype(np.int32), "centre": np.array(centre, np.int32), "radius": np.array(radius, np.float64),
            "start": np.array(start, np.int32), "end": np.array(end, np.int32),
            "child": np.array(child, np.int32), "children": np.array(children, np.int32)}


def assign(points: np.ndarray, tree: dict[str, np.ndarray], entries: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Nearest entry of every point (ties to the lower index), as (entry of each point in tree order, -1 where a
    whole subtree was given away, and those subtrees as (start, end, entry))."""
    first = np.sort(np.unique(entries, axis=0, return_index=True)[1])  # equal entries: only the first can win
    live = entries[first]
    found, whole, exact = np.full(len(points), -1, np.int64), [], []
    nodes = np.arange(min(1, len(tree["centre"])))
    while len(nodes):
        d = np.sqrt(squared(points[tree["centre"][nodes]], live).astype(np.float64))
        nearest = d.argmin(1)
        d1 = d[np.arange(len(nodes)), nearest]
        d[np.arange(len(nodes)), nearest] = np.inf
        # A little less than d2 - d1, so that rounding gives no subtree away.
        clear = 2 * tree["radius"][nodes] < (d.min(1) - d1) * (1 - 1e-9) - 1e-6
        for k in np.flatnonzero(clear).tolist():
            whole.append((int(tree["start"][nodes[k]]), int(tree["end"][nodes[k]]), int(first[nearest[k]])))
        rest = nodes[~clear]
        last = rest[tree["children"][rest] == 0]
        if len(last):
            n = tree["end"][last] - tree["start"][last]
            exact.append(np.repeat(tree["start"][last] - (np.cumsum(n) - n), n) + np.arange(int(n.sum())))
        rest = rest[tree["children"][rest] > 0]
        n = tree["children"][rest]
        nodes = np.repeat(tree["child"][rest] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    if exact:
        at = np.concatenate(exact)
        found[at] = first[squared(points[tree["order"][at]], live).argmin(1)]
    return found, whole


def kept(df: DataFrame, vector_col: str):
    """Rows whose vector is not NULL and holds finite components only, the vector as doubles named ``v``."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.where(v.isNotNull() & ~bad).withColumn("v", v)


def blocks(rows: DataFrame, length: int, label_type: str) -> DataFrame:
    """Vectors in blocks: ids, labels and, as bytes, the integer vectors with the tree of each part."""
    def run(batches):
        import pyarrow as pa

        def block(ids, labels, flat):
            points = integers(flat).reshape(-1, length).astype(np.int32)
            trees = [cover_tree(part) for part in np.split(points, PARTS, axis=1)]
            offsets = pa.array([0, len(ids)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(offsets, ids), pa.ListArray.from_arrays(offsets, labels),
                 pa.array([pickle.dumps((points, trees), protocol=5)], pa.binary())], names=["ids", "labels", "data"])

        def joined(parts):
            return parts[0] if len(parts) == 1 else pa.concat_arrays(parts)

        held, count = [], 0
        for batch in batches:
            vectors = batch.column(2)
            if not len(batch):
                continue
            flat = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), length)
            at = 0
            while at < len(batch):
                n = min(BLOCK - count, len(batch) - at)
                held.append((batch.column(0).slice(at, n), batch.column(1).slice(at, n), flat[at:at + n].ravel()))
                count, at = count + n, at + n
                if count == BLOCK:
                    yield block(joined([h[0] for h in held]), joined([h[1] for h in held]), np.concatenate([h[2] for h in held]))
                    held, count = [], 0
        if held:
            yield block(joined([h[0] for h in held]), joined([h[1] for h in held]), np.concatenate([h[2] for h in held]))

    return rows.select("id", "label", "v").mapInArrow(run, f"ids array<long>, labels array<{label_type}>, data binary")


def opened(batch, column: str):
    """(row, part, points, tree) of each block's parts; one block at a time is unpacked."""
    for row, data in enumerate(batch.column(column)):
        points, trees = pickle.loads(data.as_buffer())
        for part, (own, tree) in enumerate(zip(np.split(points.astype(np.int64), PARTS, axis=1), trees)):
            yield row, part, own, tree


def lloyd_sums(packed: DataFrame, codebooks: list[np.ndarray]) -> DataFrame:
    """(part, entry, n, sums) of one assignment, added up by entry."""
    shared = share(packed.sparkSession, codebooks)
    width = codebooks[0].shape[1]

    def run(batches):
        import pyarrow as pa
        books = shared_value(shared)
        n = np.zeros((PARTS, len(books[0])), np.int64)
        sums = np.zeros((PARTS, len(books[0]), width), np.int64)
        for batch in batches:
            for _, part, points, tree in opened(batch, "data"):
                found, whole = assign(points, tree, books[part])
                ordered = points[tree["order"]]
                total = np.concatenate([np.zeros((1, width), np.int64), np.cumsum(ordered, axis=0)])
                for s, e, entry in whole:
                    n[part, entry] += e - s
                    sums[part, entry] += total[e] - total[s]
                single = np.flatnonzero(found >= 0)
                np.add.at(sums[part], found[single], ordered[single])
                n[part] += np.bincount(found[single], minlength=len(books[0]))
        part, entry = np.nonzero(n)
        values = sums[part, entry]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(n[part, entry]),
             pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * width, pa.int32()), pa.array(values.ravel()))],
            names=["part", "entry", "n", "sums"])

    rows = packed.select("data").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    totals = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    return rows.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*totals).alias("sums"))


def codebooks_of(rows: DataFrame, length: int) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids, by part (a fixed number of rows)."""
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(ENTRIES).collect()
    some = [r for r in first if r["id"] is not None] or first
    points = integers(np.array([r["v"] for r in some], np.float64).ravel()).reshape(len(some), length)
    return np.split(points, PARTS, axis=1)


def encode(packed: DataFrame, codebooks: list[np.ndarray], label_type: str) -> DataFrame:
    """(id, label, code, error) of every vector."""
    shared = share(packed.sparkSession, codebooks)

    def run(batches):
        import pyarrow as pa
        books = shared_value(shared)
        for batch in batches:
            ids, labels = batch.column(0), batch.column(1)
            code = error = None
            for row, part, points, tree in opened(batch, "data"):
                found, whole = assign(points, tree, books[part])
                for s, e, entry in whole:
                    found[s:e] = entry
                chosen = np.empty(len(points), np.int64)
                chosen[tree["order"]] = found
                gap = points - books[part][chosen]
                if part == 0:
                    code, error = np.zeros((len(points), PARTS), np.int64), np.zeros(len(points), np.int64)
                code[:, part] = chosen
                error += (gap * gap).sum(1)
                if part == PARTS - 1:
                    text = [("%02x" * PARTS) % tuple(c) for c in code.tolist()]
                    yield pa.RecordBatch.from_arrays([ids[row].values, labels[row].values, pa.array(text, pa.string()), pa.array(error)],
                                                     names=["id", "label", "code", "error"])

    return packed.select("ids", "labels", "data").mapInArrow(run, f"id long, label {label_type}, code string, error long")


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """(id, label, code, error) of every kept vector, and the codebooks (entries by components, a part each)."""
    label_type = df.schema[label_col].dataType.simpleString()
    rows = kept(df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v0")), "v0")
    lead = rows.select("id", F.size("v").alias("n"), "v").orderBy(F.col("id").asc_nulls_last(), "v").first()
    if lead is None:
        return df.sparkSession.createDataFrame([], f"id long, label {label_type}, code string, error long"), []
    length = lead["n"]
    if length % PARTS:
        raise ValueError(f"vectors of {length} components can't be cut into {PARTS} equal parts")
    rows = rows.where(F.size("v") == length)
    books = codebooks_of(rows, length)
    packed = materialize(blocks(rows, length, label_type), "vector-blocks")
    for _ in range(rounds):
        for r in lloyd_sums(packed, books).collect():  # at most one row an entry
            books[r["part"]][r["entry"]] = [s // r["n"] for s in r["sums"]]
    return encode(packed, books, label_type), books


def fingerprint(codebooks: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and position."""
    return hashlib.sha256(",".join(str(x) for book in codebooks for x in book.ravel().tolist()).encode()).hexdigest()


def codes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    coded = materialize(coded, "vector-codes")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256"))


def codes_sql(rounds: int = ROUNDS) -> str:
    """The codes in DuckDB SQL, comparing every part with every entry."""
    nearest = """SELECT p.rid, p.vec_id, p.label, p.part, p.v, arg_min(b.entry, ({d}, b.entry)) AS entry, min({d}) AS d
  FROM parts p JOIN {book} b USING (part) GROUP BY p.rid, p.vec_id, p.label, p.part, p.v""".replace(
        "{d}", "list_sum(list_transform(list_zip(p.v, b.v), lambda t: (t[1] - t[2]) * (t[1] - t[2])))::bigint")
    sql = [f"""WITH ints AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor(x::double * {SCALE})::bigint) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT rid, vec_id, label, part,
  list_slice(v, (part * len(v) // {PARTS} + 1)::bigint, ((part + 1) * len(v) // {PARTS})::bigint) AS v FROM ints, range({PARTS}) r(part)),
b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v FROM parts
  QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= {ENTRIES})"""]
    for k in range(rounds):
        sql.append(f"a{k} AS MATERIALIZED (" + nearest.replace("{book}", f"b{k}") + ")")
        sql.append(f"""m{k} AS MATERIALIZED (SELECT part, entry, list(x ORDER BY pos) AS v FROM (
  SELECT part, entry, pos, floor(sum(x) / count(*))::bigint AS x FROM (SELECT part, entry, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{k})
  GROUP BY part, entry, pos) GROUP BY part, entry)""")
        sql.append(f"b{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.v, b.v) AS v FROM b{k} b LEFT JOIN m{k} m USING (part, entry))")
    sql.append("coded AS MATERIALIZED (" + nearest.replace("{book}", f"b{rounds}") + ")")
    return ",\n".join(sql) + f""",
whole AS (SELECT vec_id, label, string_agg(printf('%02x', entry::integer), '' ORDER BY part) AS code, sum(d)::bigint AS error FROM coded GROUP BY rid, vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::bigint AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM b{rounds}) AS codebooks_sha256 FROM whole"""
