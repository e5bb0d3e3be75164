"""PPM scores against a plain trie, base scores by definition, held-out text."""
import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import ppm
from feedloom.llm.queries import QUERIES
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def plain_log10(train, text):
    """Method C with exclusion, contexts of 3 to 0 bytes, recomputed at each byte."""
    counts = collections.defaultdict(collections.Counter)
    for t in train:
        s = ppm.PAD + t + ppm.END
        for i in range(3, len(s)):
            for k in range(4):
                counts[s[i - k:i]][s[i]] += 1
    s, total = ppm.PAD + text + ppm.END, 0.0
    for i in range(3, len(s)):
        p, out = 1.0, set()
        for k in range(3, -1, -1):
            c = {b: n for b, n in counts[s[i - k:i]].items() if b not in out} if s[i - k:i] in counts else {}
            if not c:
                continue
            whole = sum(c.values()) + len(c)
            if s[i] in c:
                p *= c[s[i]] / whole
                break
            p *= len(c) / whole
            out |= set(c)
        else:
            p /= 256 - len(out)
        total += math.log10(p)
    return total


@pytest.fixture(scope="module")
def rows(spark):
    return {r.doc_id: r for r in QUERIES["op7_ppm"](spark, SF).collect()}


def test_base_score_by_definition(spark, rows):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    c = collections.Counter()
    for i, t in docs.items():
        if brute.crc_mod(i, 7) != 2:
            c.update([*brute.words(t), None])
    n, v = sum(c.values()), len(c)
    assert set(rows) == set(docs)
    for i, t in docs.items():
        w = [*brute.words(t), None]
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (brute.crc_mod(i, 7) == 2, len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel=1e-9)


def test_held_out_text_costs_less_than_order_0(spark, rows):
    docs = {r.doc_id: r.text.encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in rows.values() if r.held_out]
    size = sum(len(docs[r.doc_id]) + 1 for r in held)
    bits = -sum(r.score for r in held) / size * math.log2(10)
    n = np.bincount(np.frombuffer(b"".join(docs[r.doc_id] for r in held), np.uint8))
    p = n[n > 0] / n.sum()
    assert bits < 0.8 * -(p * np.log2(p)).sum()


def test_odd_rows_and_plain_trie(spark):
    data = [(1, "abracadabra", False), (2, None, False), (3, "", True), (4, "abracadabra ünd", True), (None, "abc", True), (1, "abracadabra", False)]
    df = spark.createDataFrame([(*r, 5, "k") for r in data], "doc_id long, text string, held boolean, n long, key string")
    got = ppm.score(df, "held").collect()
    train = [b"abracadabra", b"", b"abracadabra"]
    assert len(got) == len(data)
    texts = {(i, t or "") for i, t, _ in data}
    for i, t in texts:
        want = plain_log10(train, t.encode())
        assert any(r.doc_id == i and r.score == pytest.approx(want, abs=1e-4) for r in got), (i, t)
    assert ppm.score(df.limit(0), "held").count() == 0
    none = ppm.score(df.withColumn("held", F.lit(True)), "held").where("doc_id = 3").first()
    assert none.train_tokens == 0 and none.score == pytest.approx(-math.log10(256), abs=1e-5)


def test_pruned_contexts_answer_by_their_suffix():
    c, lens = ppm.codes([b"ab", b""])
    assert [hex(x) for x in c] == ["0xffffff61", "0xffff6162", "0xff6162ff", "0xffffffff"] and list(lens) == [3, 1]


def test_rare_contexts_keep_their_statistics(spark):
    """Contexts that hold a small share of all positions beside a large corpus of other text."""
    train = [b"the quick brown fox jumps over the lazy dog " * 4000, "слово за словом".encode(), b"zq7 zq8 zq7"]
    held = ["слово за словом".encode(), b"zq7 zq8", b"the dog", bytes("ξένος", "utf8")]
    rows = [(n, t.decode(), False) for n, t in enumerate(train)] + [(10 + n, t.decode(), True) for n, t in enumerate(held)]
    got = {r.doc_id: r.score for r in ppm.score(spark.createDataFrame(rows, "doc_id long, text string, held boolean"), "held").collect()}
    for n, t in enumerate(held):
        assert got[10 + n] == pytest.approx(plain_log10(train, t), abs=1e-6)
