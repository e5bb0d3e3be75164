"""Nearest neighbours against brute force; planted benchmark passages."""
import random

import numpy as np

from feedloom.llm import ann, decontaminate
from feedloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(rows, k=20):
    ids = np.array([i for i, _ in rows])
    m = np.array([v for _, v in rows], float)
    out = {}
    for n, i in enumerate(ids):
        if i % 20 == 0:
            s = (m * m[n]).sum(1)
            order = [j for j in np.lexsort((ids, -s)) if j != n][:k]
            out[int(i)] = [(int(ids[j]), s[j]) for j in order]
    return out


def recall(got, want):
    near = {}
    for r in got:
        near.setdefault(r.query_id, []).append(r)
    hits = total = 0
    for q, w in want.items():
        rows = sorted(near[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1)) and q not in [r.vec_id for r in rows]
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        hits += len({r.vec_id for r in rows} & {i for i, _ in w})
        total += len(w)
    return hits / total


def test_recall_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "ROOT_SHARE", 2)  # 8 parts of 500 vectors
    monkeypatch.setattr(ann, "BLOCK", 20)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert recall(QUERIES["op2_ann"](spark, SF).collect(), brute(rows)) >= 0.9


def test_recall_with_production_parameters(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert ann.part_count(len(rows)) > 1 and ann.part_count(10 ** 6) > ann.part_count(10 ** 5)
    assert recall(QUERIES["op2_ann"](spark, sf).collect(), brute(rows)) >= 0.9


def test_vector_odd_rows(spark):
    same = [(i, [1.0, 0.0]) for i in range(0, 200, 2)]
    odd = [(1, None), (3, [0.0, -0.0]), (5, [1.0, None]), (7, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (11, [1.0]), (None, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 1, "s") for i, v in same + odd], "vec_id long, embedding array<float>, rank int, score string")
    got = ann.search(df).collect()
    want = brute(same)
    assert {q: [i for i, _ in w] for q, w in want.items()} == {
        q: [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] for q in want}
    assert ann.search(df.limit(0)).count() == 0


def test_planted_passages_are_found(spark):
    rng = random.Random(4)
    vocab = [f"w{n}" for n in range(800)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([4, 9, 20, 40, 80])))) for i in range(30)]
    docs, want = [], set()
    for d in range(60):
        w = [rng.choice(vocab) for _ in range(rng.choice([0, 30, 400]))]
        if d % 2:
            i, t = items[d % 30]
            own = t.upper().split()
            if len(own) >= 40:
                own[len(own) // 2] = "other"
            at = rng.randint(0, len(w))
            w[at:at] = own
            want.add((d, i))
        docs.append((d, " ".join(w), 1, "i"))
    docs += [(90, None, 1, ""), (91, "", 1, ""), (None, items[0][1], 1, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string, id int, item string")
    it = spark.createDataFrame([*items, (98, None), (99, "")], "item_id long, text string")
    got = decontaminate.contamination(df, it, item_block=20).collect()
    pairs = {(None if r.doc_id != r.doc_id or r.doc_id is None else int(r.doc_id), r.item_id) for r in got}
    assert pairs == want | {(None, 0)} and all(r.similarity >= 0.75 for r in got)
    assert decontaminate.contamination(df.limit(0), it).count() == 0 and decontaminate.contamination(df, it.limit(0)).count() == 0


def test_block_tables_guarantee_the_radius():
    rng = np.random.default_rng(1)
    index = decontaminate.Index([(1, b"a b c d e f g h i j k l m n o p")])
    prints, tables = index.classes[0][3:5]
    for _ in range(300):
        flip = rng.choice(64, decontaminate.RADIUS, replace=False)
        f = int(prints[0]) ^ sum(1 << int(x) for x in flip)
        assert any(tables[k][(f >> (16 * k)) & 0xFFFF] for k in range(4))


def plain_best(items, text):
    """item -> best similarity over every window of the item's length, by sliding one word at a time."""
    from collections import Counter
    from math import log

    def shingles(w):
        return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()
    own = {i: shingles(t.lower().split()) for i, t in items}
    df = Counter(s for c in own.values() for s in c)
    weight = lambda s: 1 + log(len(items) / df.get(s, 1))
    words, out = text.lower().split(), {}
    for i, t in items:
        n, best = len(t.split()), 0
        for a in range(max(1, len(words))):
            win = shingles(words[a:a + n])
            if own[i] & win:
                both = sum(weight(s) * min(own[i][s], win[s]) for s in own[i])
                best = max(best, both / sum(weight(s) * max(own[i][s], win[s]) for s in own[i] | win))
        out[i] = best
    return out


def test_every_window_by_sliding(spark):
    rng = random.Random(8)
    vocab = [f"w{n}" for n in range(500)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(n))) for i, n in enumerate([5, 12, 13, 20, 33, 34, 60, 90, 150, 150])]
    items.append((10, items[9][1]))  # an item twice: both are reported
    docs = [(900, " ".join([*vocab, items[9][1]])), (900, " ".join([*vocab, items[9][1]])), (901, items[5][1] + " " + items[5][1])]
    for d in range(40):
        i, t = items[d % 11]
        own = t.split()
        at = rng.randrange(len(own))
        for e in range(rng.choice([0, 1, len(own) // 12, len(own) // 6])):  # some end below the threshold
            own[(at + e) % len(own)] = f"edited{e}"
        rest = [rng.choice(vocab) for _ in range(rng.randrange(200))]
        docs.append((d, " ".join(rest[:50] + own + rest[50:])))
    want = sorted((d, i) for d, t in docs for i, s in plain_best(items, t).items() if s >= 0.75 - 1e-9)
    got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                                      spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == want and len(want) >= 25


def test_very_long_items_and_texts():
    rng = random.Random(9)
    item = [f"v{rng.randrange(50_000)}" for _ in range(20_000)]
    edited = [w if rng.random() > 0.02 else "other" for w in item]
    text = " ".join([f"v{rng.randrange(50_000)}" for _ in range(7_777)] + edited + ["end"] * 30_000)
    index = decontaminate.Index([(1, " ".join(item).encode()), (2, b"a b c d e f")])
    assert [(i, s) for _, i, s, _ in index.scan([text.encode(), b""], 0.75)] == [(0, 7_777)]


def test_recall_of_edited_passages():
    rng, hits, vocab = random.Random(2), 0, [f"w{i}" for i in range(3000)]
    for n, edits in [(60, 3), (100, 6), (200, 16), (400, 40)] * 8:
        item = [rng.choice(vocab) for _ in range(n)]
        at, own = rng.randrange(n), list(item)
        for e in range(edits):  # one run of edits: similarity about 0.8
            own[(at + e) % n] = f"edited{e}"
        shorter = [rng.choice(vocab) for _ in range(int(n / 1.09))]  # shares the item's length class
        index = decontaminate.Index([(0, " ".join(shorter).encode()), (1, " ".join(item).encode())])
        doc = [rng.choice(vocab) for _ in range(rng.randrange(300))] + own + [rng.choice(vocab) for _ in range(rng.randrange(300))]
        hits += [i for _, i, _, _ in index.scan([" ".join(doc).encode()], 0.75)] == [1]
    assert hits >= 30
