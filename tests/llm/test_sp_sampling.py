"""Sampled segmentations: distinct, exact probabilities, round trip, frequencies."""
import math

import numpy as np
import public_tokenizers
import pytest

from feedloom.llm import sp_sampling as S
from feedloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lat():
    return S.Lattices(MODEL)


def all_paths(lat, node):
    if lat.first[node] == lat.first[node + 1]:
        return [((), 0.0)]
    return [((a, *rest), lat.arcs["logq"][a] + p) for a in range(lat.first[node], lat.first[node + 1])
            for rest, p in all_paths(lat, lat.arcs["to"][a])]


def test_probabilities_and_sampling_without_replacement(lat):
    start = lat.starts(["▁then", "▁of"])
    each = [all_paths(lat, s) for s in start]
    every = {x + y: p + q for x, p in each[0] for y, q in each[1]}
    assert sum(map(math.exp, every.values())) == pytest.approx(1)
    n, k = 4000, 3
    keys = S.mix(np.arange(n, dtype=np.uint64))
    got = S.top_k(lat, np.tile(start, n), np.full(n, 2), keys, k)
    firsts, pairs = {}, {}
    for paths, kappa in got:
        segs = [tuple(p.arcs.tolist()) for p in paths]
        assert len(set(segs)) == k and all(p.logp == pytest.approx(every[s]) for p, s in zip(paths, segs))
        values = [p.value for p in paths]
        assert values == sorted(values, reverse=True) and kappa < values[-1]
        firsts[segs[0]] = firsts.get(segs[0], 0) + 1
        pairs[segs[:2][1]] = pairs.get(segs[:2][1], 0) + 1
    for s, p in sorted(every.items(), key=lambda x: -x[1])[:5]:
        p = math.exp(p)
        assert firsts.get(s, 0) / n == pytest.approx(p, abs=4 * math.sqrt(p / n) + .004)
        second = sum(math.exp(q) * p / (1 - math.exp(q)) for t, q in every.items() if t != s)
        assert pairs.get(s, 0) / n == pytest.approx(second, abs=4 * math.sqrt(second / n) + .004)


def test_all_segmentations_when_fewer(lat):
    start = lat.starts(["▁of"])
    total = len(all_paths(lat, start[0]))
    (paths, kappa), = S.top_k(lat, start, np.array([1]), np.array([5], np.uint64), total + 5)
    assert len(paths) == total and kappa == -np.inf


def test_query_round_trips(spark):
    rows = QUERIES["op8_sp_sampling"](spark, SF).collect()
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(rows) == 2 * n and all(r.round_trip and r.log_inclusion <= 0 for r in rows)
    again = {(r.doc_id, r.draw): r.ids_crc32 for r in QUERIES["op8_sp_sampling"](spark, SF).collect()}
    assert all(again[r.doc_id, r.draw] == r.ids_crc32 for r in rows)


def test_odd_rows_and_library_decoding(spark):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [(1, None), (2, ""), (3, "  a  b "), (4, "é 😀\n\tx ꙮ"), (5, "z" * 30_000), (None, "no key"), (4, "é 😀\n\tx ꙮ")]
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in texts], "doc_id long, text string, draw long, key string")
    got = S.sample(df, MODEL, 3).collect()
    text = dict(texts)
    assert {r.doc_id for r in got} == {1, 2, 3, 4, 5, None}
    for r in got:
        ids = np.frombuffer(r.ids, "<i4").tolist()
        assert r.round_trip and sp.decode(ids) == (text[r.doc_id] or "")
    assert [r.log_inclusion for r in got if r.doc_id in (1, 2)] == [0.0, 0.0]
    assert S.sample(df.limit(0), MODEL).count() == 0


def test_space_sign_and_bad_bytes_round_trip(spark):
    import sentencepiece

    import corpus_pipeline
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {1: "▁", 2: "cpu ▁▂▃▁ load ▁", 3: "▁the▁dog", 4: " ▁ \n▁\t ▁▁x"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = S.sample(df, MODEL, 3).collect()
    assert {r.doc_id for r in got} == set(texts) and all(r.round_trip for r in got)
    for r in got:
        ids = np.frombuffer(r.ids, "<i4").tolist()
        assert b"".join(map(S.Lattices(MODEL).surface.__getitem__, ids))[1:].decode() == texts[r.doc_id]
        assert [sp.id_to_piece(i) for i in ids].count("<0x81>") == texts[r.doc_id].count("▁")
    bad = spark.sql("select 9L as doc_id, cast(X'61FF20E29680ED' as string) as text")
    assert all(r.round_trip for r in S.sample(bad, MODEL).collect())
    enc = corpus_pipeline.encode(spark, df.unionByName(bad), SF)
    assert {r.doc_id for r in enc.where("round_trip").collect()} == {*texts, 9}
