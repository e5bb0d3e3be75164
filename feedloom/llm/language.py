"""Language identification by a linear-chain conditional random field over words (operator 1).

Each word gets a score per language from its affixes (1 to 3 characters), its character 2- and 3-grams
and whether it stands in a language's lexicon; transitions between neighbouring words' languages are
learned too.  Forward-backward over a whole text gives each word's posterior, so code-switched text
is labelled word by word; a document's language is the one with the largest mean posterior.

Training uses a bounded sample of labelled rows (``rows_per_lang`` per language, lowest hash first):
their words labelled with the row's language, cut into stretches, and stretches of different languages
joined so that the transitions see switches.  Prediction covers every word of every text.

Defined results: NULL text or text without a letter gives ``und``, score 0; so does every row when no
labelled row exists; equal means go to the smaller language name; rows that repeat an id are predicted
on their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.llm.common import bounds, encode_words, held_out, mix, segment_sums, share, shared_value, slices, table, text_bytes, tidy

BUCKETS = 1 << 15
STRETCH = 24
CHUNK = 48


def clean_types(types: list[bytes]) -> tuple[list[str], np.ndarray]:
    """Lower-cased words and whether they hold a letter."""
    words = [t.decode("utf-8", "replace").lower().strip(".,;:!?\"'()[]") for t in types]
    return words, np.fromiter((w.isalpha() or any(map(str.isalpha, w)) for w in words), bool, len(words))


def word_features(words: list[str]):
    """Buckets of affixes [words, 6] (-1: too short), of n-grams [characters, 2] with the words' bounds,
    and a 64-bit hash of each word."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    cp = np.frombuffer(("\0" + "\0".join(words) + "\0\0\0").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    start = 1 + bounds(lens + 1)[:-1]
    k = np.uint64(0x9E3779B97F4A7C15)

    def bucket(salt, *chars):
        h = np.full(len(chars[0]), salt * int(k) & 0xFFFFFFFFFFFFFFFF, np.uint64)
        for c in chars:
            h = (h ^ c) * k
        return (mix(h) % np.uint64(BUCKETS)).astype(np.int64)
    affix = np.full((len(words), 6), -1, np.int64)
    for n in (1, 2, 3):
        ok = np.flatnonzero(lens >= n)
        s, e = start[ok], start[ok] + lens[ok]
        affix[ok, n - 1] = bucket(n, *[cp[s + i] for i in range(n)])
        affix[ok, n + 2] = bucket(n + 3, *[cp[e - n + i] for i in range(n)])
    at = np.arange(int(lens.sum())) + np.repeat(start - bounds(lens)[:-1], lens)
    grams = np.stack([bucket(7, cp[at], cp[at + 1]), bucket(8, cp[at - 1], cp[at], cp[at + 1])], 1)
    place = np.arange(len(at)) - np.repeat(bounds(lens)[:-1], lens)
    parts = mix((cp[at] + np.uint64(1)) * k + place.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    ends = bounds(lens)
    total = np.concatenate([[np.uint64(0)], np.cumsum(parts, dtype=np.uint64)])
    return affix, grams, ends, mix(total[ends[1:]] - total[ends[:-1]])


class Model:
    """Weights by bucket and language, lexicon (sorted word hashes with their languages), transitions."""

    def __init__(self, langs, weights, lex_hash, lex_lang, lex_weight, trans):
        self.langs, self.weights, self.trans = langs, weights, trans
        self.lex_hash, self.lex_lang, self.lex_weight = lex_hash, lex_lang, lex_weight

    def lexicon(self, hashes):
        """Language in whose lexicon a word stands; the last row, of zeros, for none."""
        if not len(self.lex_hash):
            return np.full(len(hashes), len(self.langs))
        i = np.minimum(np.searchsorted(self.lex_hash, hashes), len(self.lex_hash) - 1)
        return np.where(self.lex_hash[i] == hashes, self.lex_lang[i], len(self.langs))

    def scores(self, words: list[str]) -> np.ndarray:
        affix, grams, ends, hashes = word_features(words)
        w = np.vstack([self.weights, np.zeros((1, len(self.langs)))])
        out = w[affix].sum(1)
        n = np.maximum(np.diff(ends), 1)[:, None]
        out += segment_sums(w[grams[:, 0]] + w[grams[:, 1]], ends) / n
        return out + self.lex_weight[self.lexicon(hashes)]


def forward_backward(scores: np.ndarray, lens: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Posterior of each word's label in sequences of ``lens`` words laid end to end.

    Sequences are cut into chunks; each chunk's product of transfer matrices is formed for all chunks
    at once, the chunk ends are chained along each sequence, then all chunks run forward and backward
    together.  This is the exact recursion, only grouped.
    """
    L = len(trans)
    if not len(scores):
        return np.zeros((0, L))
    m = np.exp(trans - trans.max())
    per = -(-lens // CHUNK)
    seq_first = bounds(per)
    K = int(seq_first[-1])
    ends = bounds(lens)
    chunk_seq = np.repeat(np.arange(len(lens)), per)
    nth = np.arange(K) - seq_first[chunk_seq]
    begin = ends[chunk_seq] + nth * CHUNK
    size = np.minimum(CHUNK, ends[chunk_seq + 1] - begin)
    at = begin[:, None] + np.arange(CHUNK)
    live = np.arange(CHUNK) < size[:, None]
    pot = np.exp(scores - scores.max(1, keepdims=True))
    x = pot[np.where(live, at, 0)]
    x = np.ascontiguousarray(x.transpose(1, 0, 2))
    live = live.T
    prod = np.broadcast_to(np.eye(L), (K, L, L)).copy()
    for t in range(CHUNK):
        on = np.flatnonzero(live[t])
        p = (prod[on] @ m) * x[t, on][:, None, :]
        prod[on] = p / p.max((1, 2), keepdims=True)
    into = np.full((K, L), 1.0 / L)
    after = np.ones((K, L))
    order = np.argsort(nth, kind="stable")
    steps = np.searchsorted(nth[order], np.arange(int(nth.max()) + 2))
    for s in range(1, len(steps) - 1):
        c = order[steps[s]:steps[s + 1]]
        v = (into[c - 1][:, None, :] @ prod[c - 1])[:, 0]
        into[c] = v / v.sum(1, keepdims=True)
    for s in range(len(steps) - 2, 0, -1):
        c = order[steps[s]:steps[s + 1]]
        v = (prod[c] @ after[c][:, :, None])[:, :, 0]
        after[c - 1] = v / v.sum(1, keepdims=True)
    alpha = np.empty((CHUNK, K, L))
    a = into
    for t in range(CHUNK):
        v = (a @ m) * x[t]
        a = np.where(live[t][:, None], v / v.sum(1, keepdims=True), a)
        alpha[t] = a
    b = after
    for t in range(CHUNK - 1, -1, -1):
        alpha[t] *= b
        v = (x[t] * b) @ m.T
        b = np.where(live[t][:, None], v / v.sum(1, keepdims=True), b)
    post = alpha.transpose(1, 0, 2)[live.T]
    return post / post.sum(1, keepdims=True)


def fit(texts: list[bytes], labels: list[str], words_per_lang: int = 12_000, rounds: int = 40, seed: int = 7) -> Model:
    """Maximum conditional likelihood by Adam over all stretches at once, weights shrunk a little."""
    langs = sorted(set(labels))
    L = len(langs)
    flat, lens, types = encode_words([t.split() for t in texts])
    words, letters = clean_types(types)
    y = np.repeat([langs.index(v) for v in labels], lens) if L else np.zeros(0, int)
    ok = letters[flat]
    flat, y = flat[ok], y[ok]
    rng = np.random.default_rng(seed)
    seqs = []
    for k in range(L):
        own = flat[y == k]
        cut = [own[i:i + STRETCH] for i in range(0, len(own) - STRETCH + 1, STRETCH)]
        pick = rng.permutation(len(cut))[:words_per_lang // STRETCH]
        seqs += [(cut[i], np.full(STRETCH, k)) for i in pick]
    if not seqs:
        return Model(langs, np.zeros((BUCKETS, L)), np.zeros(0, np.uint64), np.zeros(0, int), np.zeros((L + 1, L)), np.zeros((L, L)))
    order = rng.permutation(len(seqs))
    # A third of the stretches are halves of two stretches: these show the transitions a switch.
    half, X, Y = STRETCH // 2, [], []
    for n, i in enumerate(order):
        a, ya = seqs[i]
        if n % 3 == 0:
            b, yb = seqs[order[n - 1]]
            a, ya = np.concatenate([a[:half], b[half:]]), np.concatenate([ya[:half], yb[half:]])
        X.append(a)
        Y.append(ya)
    X, Y = np.stack(X), np.stack(Y)
    used, X = np.unique(X, return_inverse=True)
    X = X.reshape(Y.shape)
    affix, grams, ends, hashes = word_features([words[i] for i in used])
    seen = np.zeros((len(used), L))
    np.add.at(seen, (X.ravel(), Y.ravel()), 1)
    best = seen.argmax(1)
    entry = np.flatnonzero((seen.max(1) >= 3) & (seen.max(1) >= 0.9 * seen.sum(1)))
    entry = entry[np.argsort(hashes[entry])]
    model = Model(langs, np.zeros((BUCKETS, L)), hashes[entry], best[entry], np.zeros((L + 1, L)), np.zeros((L, L)))
    lex = model.lexicon(hashes)
    n = np.maximum(np.diff(ends), 1)
    gram_word = np.repeat(np.arange(len(used)), np.diff(ends))
    gram_share = 1.0 / n[gram_word]
    gold = np.zeros((*Y.shape, L))
    np.put_along_axis(gold, Y[:, :, None], 1, 2)
    gold_pairs = np.zeros((L, L))
    np.add.at(gold_pairs, (Y[:, :-1].ravel(), Y[:, 1:].ravel()), 1)
    params = [model.weights, model.lex_weight, model.trans]
    moment = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    S, T = Y.shape
    for r in range(1, rounds + 1):
        w = np.vstack([model.weights, np.zeros((1, L))])
        e = w[affix].sum(1) + segment_sums(w[grams[:, 0]] + w[grams[:, 1]], ends) / n[:, None] + model.lex_weight[lex]
        x = np.exp(e - e.max(1, keepdims=True))[X]
        m = np.exp(model.trans)
        alpha, beta = np.empty((S, T, L)), np.ones((S, T, L))
        a = np.full((S, L), 1.0 / L)
        for t in range(T):
            a = (a @ m) * x[:, t]
            a /= a.sum(1, keepdims=True)
            alpha[:, t] = a
        for t in range(T - 1, 0, -1):
            b = (x[:, t] * beta[:, t]) @ m.T
            beta[:, t - 1] = b / b.sum(1, keepdims=True)
        post = alpha * beta
        post /= post.sum(2, keepdims=True)
        pairs = alpha[:, :-1, :, None] * m * (x[:, 1:] * beta[:, 1:])[:, :, None, :]
        pairs /= pairs.sum((2, 3), keepdims=True)
        diff = (gold - post).reshape(-1, L)
        by_word = np.stack([np.bincount(X.ravel(), diff[:, k], len(used)) for k in range(L)], 1)
        gw = np.zeros((BUCKETS + 1, L))
        for k in range(L):
            g = np.bincount(affix.ravel() % (BUCKETS + 1), np.repeat(by_word[:, k], 6), BUCKETS + 1)
            g += np.bincount(grams.ravel(), np.repeat(by_word[gram_word, k] * gram_share, 2), BUCKETS + 1)
            gw[:, k] = g
        gl = np.stack([np.bincount(lex, by_word[:, k], L + 1) for k in range(L)], 1)
        gl[L] = 0
        grads = [gw[:BUCKETS] / S, gl / S, (gold_pairs - pairs.sum((0, 1))) / S]
        for p, g, (m1, m2) in zip(params, grads, moment):
            g = g - 1e-4 * p
            m1 += 0.1 * (g - m1)
            m2 += 0.05 * (g * g - m2)
            p += 0.15 * (m1 / (1 - 0.9 ** r)) / (np.sqrt(m2 / (1 - 0.95 ** r)) + 1e-8)
    return model


def train(df: DataFrame, id_col: str, text_col: str, lang_col: str, held: str = "held", rows_per_lang: int = 150) -> Model:
    """Fit on at most ``rows_per_lang`` labelled, not held-out rows of each language (lowest hash of the id)."""
    rows = df.where(~F.col(held) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    order = Window.partitionBy(lang_col).orderBy(F.xxhash64(id_col), id_col)
    picked = (rows.select(id_col, lang_col).withColumn("n", F.row_number().over(order))
              .where(F.col("n") <= rows_per_lang).select(id_col).distinct())
    ids = [r[0] for r in picked.collect()]  # at most rows_per_lang for each language
    if not ids:
        return fit([], [])
    sample = (rows.where(F.col(id_col).isin(ids)).dropDuplicates([id_col])
              .select(text_bytes(text_col).alias("t"), lang_col, id_col).collect())
    sample = sorted(((r[1], r[2], bytes(r[0])) for r in sample))
    return fit([t for _, _, t in sample], [v for v, _, _ in sample])


def label_batches(model: Model, texts: list[bytes]):
    """Per slice of texts: (from, to, flat types, types' words, letters, word bounds, posteriors)."""
    for i, j in slices(texts, 2 << 20):
        flat, lens, types = encode_words([t.split() for t in texts[i:j]])
        words, letters = clean_types(types)
        scores = model.scores(words) if words else np.zeros((0, len(model.langs)))
        scores[~letters] = 0
        yield i, j, flat, words, letters, bounds(lens), forward_backward(scores[flat], lens, model.trans)


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score (mean posterior of that language), n_words, switches (language
    changes between neighbouring labelled words)."""
    spark = df.sparkSession
    shared = share(spark, model)
    kind = dict(df.dtypes)[id_col]

    def run(batches):
        import pandas as pd
        model = shared_value(shared)
        names = np.array([*model.langs, "und"], object)
        for pdf in batches:
            texts = pdf["t"].tolist()
            pred, score = np.full(len(texts), len(model.langs)), np.zeros(len(texts))
            n_words, switches = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            if model.langs:
                for i, j, flat, _, letters, ends, post in label_batches(model, texts):
                    ok = letters[flat].astype(float)
                    total = segment_sums(post * ok[:, None], ends)
                    n = np.round(segment_sums(ok, ends)).astype(np.int64)
                    best = np.round(total, 9).argmax(1)
                    pred[i:j] = np.where(n > 0, best, len(model.langs))
                    score[i:j] = np.clip(total[np.arange(j - i), best] / np.maximum(n, 1), 0, 1)
                    n_words[i:j] = n
                    lab = post.argmax(1)
                    turn = np.concatenate([[0.0], (lab[1:] != lab[:-1]) * 1.0]) if len(lab) else np.zeros(0)
                    turn[ends[:-1][ends[:-1] < len(turn)]] = 0
                    switches[i:j] = np.round(segment_sums(turn, ends)).astype(np.int64)
            yield pd.DataFrame({"id": pdf["id"], "lang_pred": names[pred], "score": score, "n_words": n_words, "switches": switches})

    rows = df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("t"))
    out = rows.mapInPandas(tidy(run), f"id {kind}, lang_pred string, score double, n_words long, switches long")
    return out.withColumnRenamed("id", id_col)


def label_words(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every white-space word of every text with its language and posterior: id, i, word, lang, p."""
    shared = share(df.sparkSession, model)
    kind = dict(df.dtypes)[id_col]

    def run(batches):
        import pandas as pd
        model = shared_value(shared)
        names = np.array([*model.langs, "und"], object)
        for pdf in batches:
            texts = pdf["t"].tolist()
            for i, j, flat, words, letters, ends, post in label_batches(model, texts):
                best = post.argmax(1) if len(post) else np.zeros(0, int)
                lens = np.diff(ends)
                yield pd.DataFrame({
                    "id": np.repeat(pdf["id"].to_numpy()[i:j], lens), "i": np.arange(len(flat)) - np.repeat(ends[:-1], lens),
                    "word": np.array(words, object)[flat], "lang": names[np.where(letters[flat], best, len(model.langs))],
                    "p": post[np.arange(len(flat)), best]})

    rows = df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("t"))
    return rows.mapInPandas(run, f"id {kind}, i long, word string, lang string, p double").withColumnRenamed("id", id_col)


def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held", held_out(F.col("doc_id"), 5, 0))
    model = train(docs, "doc_id", "text", "lang")
    out = predict(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "lang_pred", "score", "n_words", "switches")
