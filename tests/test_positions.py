"""Positions and first-N per group against brute force, with one group holding a third of the rows."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from feedloom.operators import positions as P


def _skewed(spark, n=3000):
    rows = [("hot" if i % 3 == 0 else f"g{i % 50}", (i * 7919) % 10007, i) for i in range(n)]
    return spark.createDataFrame(rows, "grp string, k long, id long"), rows


def test_group_positions_exact(spark):
    df, rows = _skewed(spark)
    got = {r.id: r.pos for r in P.group_positions(df, ["grp"], ["k", "id"], partitions=16).collect()}
    expect = {}
    for g in {r[0] for r in rows}:
        members = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))
        expect.update({r[2]: i for i, r in enumerate(members)})
    assert got == expect


def test_global_positions_and_batches(spark):
    df, rows = _skewed(spark, 1000)
    got = {r.id: r.pos for r in P.global_positions(df, ["k", "id"], base=1).collect()}
    order = sorted(rows, key=lambda r: (r[1], r[2]))
    assert got == {r[2]: i + 1 for i, r in enumerate(order)}
    b = P.assign_batches(df, ["grp"], ["k", "id"], batch_size=10)
    assert b.filter(F.col("batch_number") != F.floor(F.col("pos") / 10)).count() == 0


def test_first_n_per_group(spark):
    df, rows = _skewed(spark)
    got = sorted((r.grp, r.id) for r in P.first_n_per_group(df, ["grp"], ["k"], 3, tiebreak=["id"]).collect())
    expect = []
    for g in {r[0] for r in rows}:
        members = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))[:3]
        expect += [(g, r[2]) for r in members]
    assert got == sorted(expect)


def test_first_by_aggregate(spark):
    df, rows = _skewed(spark)
    got = {r.grp: r.id for r in P.first_by_aggregate(df, ["grp"], ["k", "id"], ["id"]).collect()}
    expect = {}
    for g in {r[0] for r in rows}:
        expect[g] = min((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))[2]
    assert got == expect


def test_group_positions_with_payload_written_and_compared(spark, tmpdir_path):
    """Many rows, payload columns, a hot and a NULL group; the result is written, then compared."""
    src = spark.range(0, 400_000, numPartitions=8).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else concat('g', id % 50) end g",
        "(id * 7919) % 1000003 k", "id", "repeat('x', 20) payload", "id * 2 amount")
    src.write.parquet(tmpdir_path + "/src")
    df = spark.read.parquet(tmpdir_path + "/src")
    P.group_positions(df, ["g"], ["k", "id"]).write.parquet(tmpdir_path + "/out")
    w = Window.partitionBy("g").orderBy("k", "id")
    want = df.withColumn("want", F.row_number().over(w) - 1).select("id", "want")
    got = spark.read.parquet(tmpdir_path + "/out").join(want, "id")
    assert got.count() == 400_000 and got.where("pos <> want").count() == 0


def test_rank_slice_against_a_whole_sort(spark):
    """Ranks from any place, with NULL and hot leading values, in one or several rounds."""
    import random
    rnd = random.Random(3)
    rows = [(rnd.choice([None, 5, 5, 5, rnd.randrange(1000)]), i, f"p{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, i int, p string").repartition(5)
    whole = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for first, last in ((1, 3), (500, 520), (1400, 1404), (2990, 3000), (2999, 3050), (4000, 4010)):
        for target in (100, 100_000):
            got = P.rank_slice(df, ["k", "i"], first, last, name="rn", target=target, buckets=8).collect()
            assert sorted((r.rn, r.k, r.i, r.p) for r in got) == [(n, *whole[n - 1]) for n in range(first, min(last, 3000) + 1)], (first, target)
    assert P.rank_slice(df.limit(0), ["k", "i"], 1, 5).count() == 0
    words = spark.createDataFrame([(w,) for w in "the quick brown fox jumps over a lazy dog".split()], "w string")
    assert [r.w for r in P.rank_slice(words, ["w"], 2, 3, target=2).orderBy("pos").collect()] == ["brown", "dog"]
