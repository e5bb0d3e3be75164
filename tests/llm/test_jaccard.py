"""N-gram Jaccard join against all pairs."""
import random

import numpy as np
import pytest

from feedloom.llm import jaccard_join, shingles
from feedloom.llm.queries import QUERIES
from tests.llm import brute

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n long, cls string, id long"


def check(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, 1, "x", 5) for i, t in rows], SCHEMA)
    got = jaccard_join.near_duplicates(df, **kw).collect()
    assert len(got) == len(rows)
    want = brute.components([(i, t) for i, t in rows])
    sets = {i: brute.shingles(t) for i, t in rows}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), want[i]) for i in sets}
    return want


def test_query_matches_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute.components(docs)
    got = {r.doc_id: r for r in QUERIES["op5_jaccard_join"](spark, SF).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(got[i].n_shingles == len(brute.shingles(t)) for i, t in docs)


@pytest.mark.parametrize("frequent,seed", [(2, 1), (6, 2), (64, 3)])
def test_hot_groups_and_common_passages(spark, frequent, seed):
    """Near copies with few to many edits, a passage in most documents, short documents."""
    rng = random.Random(seed)
    vocab = [f"w{n}" for n in range(3000)]
    passage = [rng.choice(vocab) for _ in range(60)]
    rows = []
    for _ in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([8, 30, 90, 300]))]
        for _ in range(rng.choice([2, 5, 30])):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 30))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append(w)
    for _ in range(40):
        own = [rng.choice(vocab) for _ in range(rng.choice([5, 15, 40, 200]))]
        rows.append(own + passage if rng.random() < .5 else passage + own)
    rng.shuffle(rows)
    want = check(spark, [(n * 3, " ".join(w)) for n, w in enumerate(rows)], frequent=frequent)
    assert len(set(want.values())) < len(want)


def test_short_copies_share_frequent_shingles_with_other_groups(spark):
    """Rotations of a few words: those one word apart are similar, the others only share combinations with them."""
    rng, rows = random.Random(1), []
    for c in range(400):
        n = rng.randint(13, 20)
        base = [f"c{c}w{k}" for k in range(n)]
        rows += [base[k:] + base[:k] for k in rng.sample(range(n), rng.randint(4, n - 3))]
    rng.shuffle(rows)
    split = {"c161", "c179", "c216", "c318", "c322", "c34", "c364", "c378", "c6", "c95"}  # pairs once counted in two orders
    check(spark, [(n, " ".join(w)) for n, w in enumerate(rows) if w[0].split("w")[0] in split], frequent=2)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "  \n"), (4, "one"), (5, "ONE"), (6, "one two three"), (7, "one two  three"),
            (8, "a b c d e"), (9, "a b c d e f"), (10, "x " * 9000), (11, "x " * 9), (12, "É b"), (13, "é b")]
    assert check(spark, rows)[5] == 4
    df = spark.createDataFrame([(None, "a b c d e f g"), (7, "a b c d e f g"), (7, "a b c d e f g"), (3, "a b c d e f g")],
                               "doc_id long, text string")
    got = jaccard_join.near_duplicates(df).collect()
    assert sorted([(r.doc_id or 0, r.component_id) for r in got]) == [(0, None), (3, 3), (7, 3), (7, 3)]
    assert jaccard_join.near_duplicates(df.limit(0)).count() == 0


def test_rolling_hashes_depend_on_words_only():
    a = list(shingles.shingle_sets([b"A b c d e f", b"a b", b"", b"b c d e f"]))
    assert [len(x) for x in a] == [2, 1, 0, 1] and a[3][0] in a[0]
    assert not np.intersect1d(a[1], a[0]).size
