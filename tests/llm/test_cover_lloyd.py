import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from feedloom.llm import cover_lloyd as cl


def plain(rows, rounds=4):
    """rows: (vec_id, vector, label) -> the query's rows, in Python integers."""
    ints = [(i, [math.floor(1024 * float(x)) for x in v], lab) for i, v, lab in rows]
    n = len(ints[0][1]) // 4
    cut = [[v[p * n:(p + 1) * n] for p in range(4)] for _, v, _ in ints]
    first = [k for k in sorted(range(len(ints)), key=lambda k: (ints[k][0] is None, ints[k][0] or 0, ints[k][1]))[:256] if ints[k][0] is not None]
    books = [[list(cut[k][p]) for k in first] for p in range(4)]

    def nearest(v, book):
        d = [sum((a - b) ** 2 for a, b in zip(v, e)) for e in book]
        return d.index(min(d)), min(d)
    for _ in range(rounds):
        for p in range(4):
            sums = {}
            for c in cut:
                n_, s = sums.setdefault(nearest(c[p], books[p])[0], [0, [0] * n])
                sums[nearest(c[p], books[p])[0]] = [n_ + 1, [a + b for a, b in zip(s, c[p])]]
            for e, (k, s) in sums.items():
                books[p][e] = [x // k for x in s]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for (i, _, lab), c in zip(ints, cut):
        near = [nearest(c[p], books[p]) for p in range(4)]
        out.append((i, "".join("%02x" % e for e, _ in near), sum(d for _, d in near), lab))
    total = {}
    for r in out:
        total[r[3]] = total.get(r[3], 0) + r[2]
    return [(i, c, e, total[lab], sha) for i, c, e, lab in out]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x) for x in r))


SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string, code int"


def written(spark, tmp_path, rows):
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    df.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    return cl.codes_query(spark, str(tmp_path)).collect()


def vectors(n, dim, clusters, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    v = (centres[rng.integers(0, clusters, n)] + 0.02 * rng.normal(size=(n, dim))).astype(np.float32)
    return [(int(i), row.tolist(), int(i) % 3 if i % 7 else None) for i, row in zip(rng.permutation(n) * 3, v)]


@pytest.mark.parametrize("clusters", [4, 300])
def test_query_against_plain_rounds(spark, tmp_path, clusters):
    rows = vectors(700, 8, clusters)
    rows += [rows[0]] * 30 + [(None, rows[1][1], 5), (None, [0.0] * 8, None), (9001, [-0.0004] * 8, 1), (9002, [300.0, -300.0] * 4, 1)]
    bad = [(1, None, 1), (2, [None] + [0.1] * 7, 1), (4, [float("nan")] * 8, 1), (5, [float("inf")] + [0.0] * 7, 1), (100_000, [0.5] * 4, 1), (100_001, [], 2)]
    got = written(spark, tmp_path, rows + bad)
    assert ordered(got) == ordered(plain(rows))


def test_fewer_rows_than_entries(spark, tmp_path):
    rows = vectors(40, 4, 10)
    assert ordered(written(spark, tmp_path, rows)) == ordered(plain(rows))


def test_trees_give_subtrees_away_and_cover(monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.integers(-2000, 2000, (20, 16))
    points = np.concatenate([centres[rng.integers(0, 20, 1500)] + rng.integers(-9, 10, (1500, 16)), np.tile(centres[0], (200, 1))])
    tree = cl.cover_tree(points)
    assert sorted(tree["order"].tolist()) == list(range(len(points)))
    for c, r, s, e in zip(tree["centre"], tree["radius"], tree["start"], tree["end"]):
        gap = points[tree["order"][s:e]] - points[c]
        assert np.sqrt((gap * gap).sum(1)).max() <= r * (1 + 1e-12)
    found, whole = cl.assign(points, tree, centres)
    assert sum(e - s for s, e, _ in whole) == len(points)  # every cluster is given away whole
    for s, e, k in whole:
        found[s:e] = k
    assert (found == cl.squared(points[tree["order"]], centres).argmin(1)).all()
    twice = np.concatenate([centres[5:], centres])  # equal entries: the lower index
    found, whole = cl.assign(points, tree, twice)
    for s, e, k in whole:
        found[s:e] = k
    assert (found == cl.squared(points[tree["order"]], twice).argmin(1)).all()


def test_wide_integers_stay_exact():
    rng = np.random.default_rng(4)
    points = rng.integers(-cl.LIMIT + 1, cl.LIMIT, (50, 3))
    exact = [[sum((a - b) ** 2 for a, b in zip(p, q)) for q in points.tolist()] for p in points.tolist()]
    assert cl.squared(points, points).tolist() == exact
    with pytest.raises(OverflowError):
        cl.integers(np.array([70_000.0]))


def test_empty_table_and_uneven_length(spark, tmp_path):
    assert written(spark, tmp_path, []) == []
    schema = T.StructType.fromDDL("vec_id long, embedding array<float>, label int")
    with pytest.raises(ValueError):
        cl.compress(spark.createDataFrame([(1, [0.5] * 6, 1)], schema))


def test_query_on_the_embeddings_and_its_sql(spark):
    got = cl.codes_query(spark, "/root/testdata/sf0.001").collect()
    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM read_parquet('/root/testdata/sf0.001/embeddings.parquet')")
    cols = ", ".join(["vec_id", "code", "error", "label_error", "codebooks_sha256"])
    assert ordered(got) == ordered(con.execute(f"SELECT {cols} FROM ({cl.codes_sql()})").fetchall())
