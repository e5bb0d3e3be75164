"""Approximate nearest neighbours over learned partitions (operator 2).

A bounded sample of vectors gives a neighbour graph; recursive bisection along the graph's slowest
direction, refined by swaps, cuts it into equal parts.  A small softmax classifier learns, from a
vector, the distribution of its neighbours over the parts.  Every vector is indexed in its most
probable part; a query visits the ``probes`` most probable parts, a number set on the sample so that
the parts visited hold ``target`` of the true neighbours.  Candidates are ranked by the exact measure.

Equal vectors are searched once, with their smallest ``k + 1`` ids (no list of ``k`` can need more).
Parts are cut into blocks of bounded size on both sides, so no part meets in one task.

Defined results: vectors that are NULL, zero, hold NULL or non-finite components, or have another than
the most frequent length take no part, nor do NULL ids; equal scores go to the smaller id; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.llm.common import materialize, table

#: Least size of the sample; it grows with the parts, ``PER_PART`` vectors each.
SAMPLE = 4096
PER_PART = 16
#: Parts grow with the root of the number of vectors, by this share of it.  The sample is what the driver fits, so both
#: are bounded: beyond about 67 million vectors the parts grow instead of their number.
ROOT_SHARE = 8
MAX_PARTS = 1024
BLOCK = 8192


def part_count(vectors: int) -> int:
    """A power of two near a fixed share of the root of the number of vectors, 2 at least."""
    return min(MAX_PARTS, 1 << max(1, int(np.log2(max(1.0, np.sqrt(vectors) / ROOT_SHARE)))))


def bisect(neigh: np.ndarray, nodes: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray]:
    """Halves of equal size with few graph edges between them."""
    local = np.full(len(neigh), -1)
    local[nodes] = np.arange(len(nodes))
    src = np.repeat(np.arange(len(nodes)), neigh.shape[1])
    dst = local[neigh[nodes].ravel()]
    src, dst = src[dst >= 0], dst[dst >= 0]
    src, dst = np.concatenate([src, dst]), np.concatenate([dst, src])
    n = len(nodes)
    deg = np.bincount(src, minlength=n) + 1e-9
    x = rng.normal(size=n)
    for _ in range(60):  # power iteration of the lazy walk, the constant direction taken out
        x -= (x * deg).sum() / deg.sum()
        x = 0.5 * x + 0.5 * np.bincount(src, x[dst], n) / deg
        x /= np.abs(x).max() + 1e-30
    side = np.zeros(n, bool)
    side[np.argsort(x, kind="stable")[n // 2:]] = True
    for _ in range(5):  # swap the nodes that gain most, in equal numbers
        pull = np.bincount(src, np.where(side[dst], 1.0, -1.0), n)
        gain = np.where(side, -pull, pull)
        a, b = (np.flatnonzero((side == v) & (gain > 0)) for v in (False, True))
        m = min(len(a), len(b)) // 2
        if not m:
            break
        side[a[np.argsort(-gain[a], kind="stable")[:m]]] = True
        side[b[np.argsort(-gain[b], kind="stable")[:m]]] = False
    return nodes[~side], nodes[side]


def fit(sample: np.ndarray, parts: int, k: int = 20, target: float = 0.96, seed: int = 5):
    """Classifier weights [d + 1, parts] and the number of parts a query visits.

    Every fifth vector of the sample takes no part in the training; on these the number of parts is set.
    """
    rng = np.random.default_rng(seed)
    n = len(sample)
    if parts <= 1 or n < 4 * parts:
        return np.zeros((sample.shape[1] + 1, 1)), 1
    kk = min(k, n - 1)
    neigh = np.empty((n, kk), np.int64)
    for i in range(0, n, 512):
        s = sample[i:i + 512] @ sample.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
        neigh[i:i + 512] = np.argpartition(-s, kk - 1, axis=1)[:, :kk]
    groups = [np.arange(n)]
    while len(groups) < parts:
        groups = [h for g in groups for h in bisect(neigh, g, rng)]
    part = np.empty(n, np.int64)
    for g, nodes in enumerate(groups):
        part[nodes] = g
    goal = np.zeros((n, parts))
    for j in range(kk):
        goal[np.arange(n), part[neigh[:, j]]] += 1 / kk
    goal = 0.5 * goal
    goal[np.arange(n), part] += 0.5
    every = np.hstack([sample, np.ones((n, 1))])
    held = np.arange(n) % 5 == 0
    x, goal = every[~held], goal[~held]
    w = np.zeros((x.shape[1], parts))
    m1, m2 = np.zeros_like(w), np.zeros_like(w)
    for r in range(1, 151):
        z = x @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = x.T @ (p - goal) / len(x) + 1e-6 * w
        m1 += 0.1 * (g - m1)
        m2 += 0.01 * (g * g - m2)
        w -= 0.3 * (m1 / (1 - 0.9 ** r)) / (np.sqrt(m2 / (1 - 0.99 ** r)) + 1e-8)
    z = every @ w
    home, rank = z.argmax(1), np.argsort(np.argsort(-z[held], axis=1), axis=1)
    need = np.sort(rank[np.arange(len(rank))[:, None], home[neigh[held]]].ravel())
    return w, int(need[min(len(need) - 1, int(target * len(need)))]) + 1


def search(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, query_modulus: int = 20) -> DataFrame:
    """For every id divisible by ``query_modulus``: its ``k`` nearest rows (query_id, rank, id, score)."""
    spark = df.sparkSession
    v = F.col(vec_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & (F.size("v") > 0)
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))
    dims = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    schema = f"query_id long, rank int, {id_col} long, score double"
    if dims is None:
        return spark.createDataFrame([], schema)
    # -0.0 and 0.0 are one value: adding 0.0 makes equal vectors hash alike.
    rows = rows.where(F.size("v") == dims.d).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    rows = rows.withColumn("h", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.reverse("v")))
    same = Window.partitionBy("h", "h2")
    first = (rows.withColumn("n", F.row_number().over(same.orderBy("id"))).where(F.col("n") <= k + 1)
             .withColumn("rep", F.min("id").over(same)))
    first = materialize(first.select("id", "v", "h", "h2", "rep", "n"), "ann-rows")
    members = first.select("rep", "id")
    reps = first.where("n = 1").select("rep", "v", "h", "h2")
    queries = rows.where(F.col("id") % query_modulus == 0).select("id", "h", "h2").join(reps.select("rep", "h", "h2"), ["h", "h2"])
    queries = materialize(queries.select("id", "rep"), "ann-queries")

    total = reps.count()
    parts = part_count(total)
    sample = np.array([r.v for r in reps.orderBy(F.xxhash64("rep"), "rep").limit(max(SAMPLE, PER_PART * parts)).collect()])
    w, probes = fit(sample, parts, k)
    probes = min(probes, w.shape[1])
    shared = spark.sparkContext.broadcast(w)

    def route(n):
        def run(batches):
            import pandas as pd
            w = shared.value
            for pdf in batches:
                if not len(pdf):
                    continue
                x = np.stack(pdf["v"].to_numpy()).astype(float)
                z = np.hstack([x, np.ones((len(x), 1))]) @ w
                best = np.argsort(-z, axis=1, kind="stable")[:, :n]
                yield pd.DataFrame({"part": best.ravel(), "rep": np.repeat(pdf["rep"].to_numpy(), n),
                                    "v": [a for a in pdf["v"] for _ in range(n)]})
        return run
    schema_part = "part int, rep long, v array<double>"
    index = materialize(reps.select("rep", "v").mapInPandas(route(1), schema_part), "ann-index")
    asked = reps.join(queries.select("rep").distinct(), "rep", "left_semi").select("rep", "v")
    asked = materialize(asked.mapInPandas(route(probes), schema_part), "ann-asked")
    size = {r.part: r["count"] for r in index.groupBy("part").count().collect()}  # at most MAX_PARTS rows
    size_q = {r.part: r["count"] for r in asked.groupBy("part").count().collect()}
    blocks = spark.createDataFrame([(p, -(-n // BLOCK), -(-size_q.get(p, 0) // BLOCK)) for p, n in size.items()], "part int, cbs int, qbs int")
    block = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    left = (asked.join(blocks, "part").withColumn("qb", block("qbs"))
            .withColumn("cb", F.explode(F.sequence(F.lit(0), F.col("cbs") - 1))).select("part", "cb", "qb", "rep", "v"))
    right = (index.join(blocks.where("qbs > 0"), "part").withColumn("cb", block("cbs"))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("qbs") - 1))).select("part", "cb", "qb", "rep", "v"))

    def rank(q, c):
        import pandas as pd
        if not len(q) or not len(c):
            return pd.DataFrame({"q": [], "c": [], "score": []})
        Q, C = np.stack(q["v"].to_numpy()).astype(float), np.stack(c["v"].to_numpy()).astype(float)
        qid, cid, out, m = q["rep"].to_numpy(), c["rep"].to_numpy(), [], min(k + 1, len(c))
        for i in range(0, len(Q), 256):
            s = Q[i:i + 256] @ C.T
            top = np.argpartition(-s, m - 1, axis=1)[:, :m]
            exact = (Q[i:i + 256, None, :] * C[top]).sum(2)
            out.append(pd.DataFrame({"q": np.repeat(qid[i:i + 256], m), "c": cid[top].ravel(), "score": exact.ravel()}))
        return pd.concat(out)

    key = ["part", "cb", "qb"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(rank, "q long, c long, score double")
    nearest = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    found = found.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= k + 1).select("q", "c", "score")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    found = (found.join(members.withColumnRenamed("rep", "c"), "c").withColumn("n", F.row_number().over(best))
             .where(F.col("n") <= k + 1).groupBy("q").agg(F.sort_array(F.collect_list(F.struct("n", "id", "score"))).alias("near")))
    out = queries.join(found.withColumnRenamed("q", "rep"), "rep")
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    out = out.select(F.col("id").alias("query_id"), "near").select("query_id", F.posexplode(others).alias("pos", "x"))
    return out.select("query_id", (F.col("pos") + 1).alias("rank"), F.col("x.id").alias(id_col), F.col("x.score").alias("score"))


def ann_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
