"""Language-model scoring by prediction by partial matching (operator 7).

The model is a trie of byte contexts up to three bytes, counted over all training texts.  Its estimate
is method C: at a context with ``T`` counted bytes, ``d`` of them distinct, a byte seen ``n`` times has
``n / (T + d)`` and the escape ``d / (T + d)``; after an escape the shorter context is asked with the
bytes already ruled out excluded, down to a uniform choice among what is left.  The byte 0xFF, which
UTF-8 never holds, stands before and after a text.

Every counted context is kept, in a table dealt by the last two bytes of the context.  The distinct
four-byte codes of all documents meet it there, get their code lengths with escapes and exclusions, and
are joined back to the blocks that hold them, as words are.  Only the counts of contexts of one byte and
of none (at most 257 times 256) are broadcast.

The base score is an add-one unigram model over white-space words.  Words are counted over all training
texts as 64-bit hashes.  Documents are dealt into blocks of about ``block_bytes``; a block's distinct
words and codes are looked up once by a join, and the answers meet the block's documents again.

Defined results: NULL text is empty: it scores its end alone; NULL ids count as held out; rows that
repeat an id are scored on their own; with no training text the unigram counts are 0 and the byte model
is uniform; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import bounds, encode_words, held_out, materialize, segment_sums, share, shared_value, slices, table, text_bytes
from feedloom.llm.shingles import type_hashes

PAD, END = b"\xff\xff\xff", b"\xff"
#: Hash under which the end of a text is counted as a token (no word is empty).
END_HASH = int(type_hashes([b""]).view(np.int64)[0])
WORD, GRAM, BYTES = 0, 1, 2
#: Parts that the contexts' last two bytes are dealt to for the code lengths; one holds whole contexts of up to three bytes.
PARTS = 256


def codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Four-byte codes (three bytes of context, then the byte) of every byte and end, and positions per text."""
    u = np.frombuffer(b"".join(PAD + t + END for t in texts), np.uint8).astype(np.uint32)
    lens = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    c = np.zeros(len(u), np.uint32)
    c[3:] = u[:-3] << 24 | u[1:-2] << 16 | u[2:-1] << 8 | u[3:]
    keep = np.ones(len(u), bool)
    first = bounds(lens + 3)[:-1]
    for i in range(3):
        keep[first + i] = False
    return c[keep], lens


def merged(parts: list) -> list:
    """Counts summed by key."""
    keys, n = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    u, at = np.unique(keys, return_inverse=True)
    return [(u, np.bincount(at, n, len(u)).astype(np.int64))]


def gather(df: DataFrame) -> DataFrame:
    """(t, held) -> (kind, key, n): word, four-byte and byte counts; words and codes of training texts only."""
    def run(batches):
        import pandas as pd
        words, grams, size = [], [], 0

        def emit(kind, parts):
            k, n = merged(parts)[0]
            return pd.DataFrame({"kind": kind, "key": k, "n": n})
        for pdf in batches:
            size += sum(map(len, pdf["t"]))
            texts = pdf["t"][~pdf["held"]].tolist()
            for i, j in slices(texts):
                flat, _, types = encode_words([t.lower().split() for t in texts[i:j]])
                n = np.append(np.bincount(flat, minlength=len(types)), j - i)
                words.append((np.append(type_hashes(types).view(np.int64), END_HASH), n))
                u, n = np.unique(codes(texts[i:j])[0], return_counts=True)
                grams.append((u.astype(np.int64), n))
                if sum(len(k) for k, _ in words) > 3_000_000:
                    words = merged(words)
                    if len(words[0][0]) > 2_000_000:
                        yield emit(WORD, words)
                        words = []
                if sum(len(k) for k, _ in grams) > 2_000_000:
                    grams = merged(grams)
        if words:
            yield emit(WORD, words)
        if grams:
            yield emit(GRAM, grams)
        yield pd.DataFrame({"kind": [BYTES], "key": [0], "n": [size]})

    parts = df.select("t", "held").mapInPandas(run, "kind int, key long, n long")
    return parts.groupBy("kind", "key").agg(F.sum("n").alias("n"))


class Trie:
    """Counted contexts by length (codes ascending) with 256 counts each."""

    def __init__(self, kept: dict[int, tuple[np.ndarray, np.ndarray]]):
        self.kept = kept

    def counts(self, length: int, contexts: np.ndarray) -> np.ndarray:
        """Counts of the contexts' suffixes of that length; zeros where that was never seen."""
        codes_, rows = self.kept[length]
        want = contexts & ((1 << 8 * length) - 1)
        if not len(codes_):
            return np.zeros((len(contexts), 256))
        i = np.minimum(np.searchsorted(codes_, want), len(codes_) - 1)
        return np.where((codes_[i] == want)[:, None], rows[i], 0)

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """Code lengths (negative, base 10) of four-byte codes (ascending)."""
        out = np.empty(len(grams))
        contexts, at = np.unique(grams >> 8, return_inverse=True)
        ends = np.searchsorted(at, np.arange(len(contexts) + 1))
        for i in range(0, len(contexts), 1024):
            c = contexts[i:i + 1024]
            p, open_, esc = np.zeros((len(c), 256)), np.ones((len(c), 256), bool), np.ones((len(c), 1))
            for k in range(3, -1, -1):
                n = np.where(open_, self.counts(k, c), 0)
                seen = n > 0
                d, total = seen.sum(1, keepdims=True), n.sum(1, keepdims=True)
                whole = np.maximum(total + d, 1)
                p = np.where(seen, esc * n / whole, p)
                esc = np.where(d > 0, esc * d / whole, esc)
                open_ &= ~seen
            left = open_.sum(1, keepdims=True)
            p = np.where(open_, esc / np.maximum(left, 1), p)
            lo, hi = ends[i], ends[i + len(c)]
            out[lo:hi] = np.log10(p[at[lo:hi] - i, grams[lo:hi] & 255])
        return out


def counted(grams: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Contexts of that length among four-byte codes with their 256 counts."""
    ctx, at = np.unique(grams >> 8 & (1 << 8 * length) - 1, return_inverse=True)
    rows = np.bincount(at * 256 + (grams & 255), n, len(ctx) * 256).reshape(-1, 256)
    return ctx, rows


def lengths(counts: DataFrame, codes_: DataFrame) -> DataFrame:
    """Code length of each of the distinct ``codes_`` (key): (key, logp)."""
    spark = counts.sparkSession
    grams = counts.where(F.col("kind") == GRAM).select("key", "n")
    near = grams.groupBy(F.col("key").bitwiseAND(0xFFFF).alias("key")).agg(F.sum("n").alias("n")).toPandas()  # at most 65536 rows
    key, n = near["key"].to_numpy(np.int64), near["n"].to_numpy(np.float64)
    shared = share(spark, {k: counted(key, n, k) for k in (0, 1)})
    dealt = lambda df: df.withColumn("part", F.pmod(F.xxhash64(F.shiftright("key", 8).bitwiseAND(0xFFFF)), F.lit(PARTS)))

    def run(grams, wanted):
        import pandas as pd
        key, n = grams["key"].to_numpy(np.int64), grams["n"].to_numpy(np.float64)
        trie = Trie({**shared_value(shared), **{k: counted(key, n, k) for k in (2, 3)}})
        want = np.sort(wanted["key"].to_numpy(np.int64))
        return pd.DataFrame({"key": want, "logp": trie.log10(want)})

    return dealt(grams).groupBy("part").cogroup(dealt(codes_).groupBy("part")).applyInPandas(run, "key long, logp double")


def score(df: DataFrame, held: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 12 << 20) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities)."""
    kind = dict(df.dtypes)[id_col]
    docs = df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("t"), F.col(held).alias("held"))
    counts = materialize(gather(docs), "ppm-counts")
    words = counts.where(F.col("kind") == WORD).select("key", F.col("n").cast("double").alias("n"))
    size, total, distinct = counts.agg(
        F.sum(F.when(F.col("kind") == BYTES, F.col("n"))), F.sum(F.when(F.col("kind") == WORD, F.col("n"))),
        F.count(F.when(F.col("kind") == WORD, 1))).first()
    total, blocks = total or 0, (size or 0) // block_bytes + 1
    docs = docs.withColumn("block", F.pmod(F.xxhash64("id", "t"), F.lit(blocks)).cast("int"))

    def vocabulary(pdf):
        import pandas as pd
        texts, out, grams = pdf["t"].tolist(), [], []
        for i, j in slices(texts):
            out.append(np.unique(type_hashes(encode_words([t.lower().split() for t in texts[i:j]])[2])))
            grams.append(np.unique(codes(texts[i:j])[0]))
        keys = np.unique(np.concatenate([*out, np.array([END_HASH], np.int64).view(np.uint64)])).view(np.int64)
        grams = np.unique(np.concatenate(grams)).astype(np.int64)
        return pd.DataFrame({"block": pdf["block"].iloc[0] if len(pdf) else 0, "kind": np.repeat([WORD, GRAM], [len(keys), len(grams)]),
                             "key": np.concatenate([keys, grams])})

    asked = materialize(docs.groupBy("block").applyInPandas(vocabulary, "block int, kind int, key long"), "ppm-asked")
    asked_words, asked_codes = (asked.where(F.col("kind") == k).select("block", "kind", "key") for k in (WORD, GRAM))
    found = lengths(counts, asked_codes.select("key").distinct())
    known = asked_words.join(words, "key").select("block", "kind", "key", "n").unionByName(
        asked_codes.join(found, "key").select("block", "kind", "key", F.col("logp").alias("n")))

    def run(docs, known):
        import pandas as pd
        texts = docs["t"].tolist()
        grams, known = known[known["kind"] == GRAM].sort_values("key"), known[known["kind"] == WORD]
        gram, length, score_ = grams["key"].to_numpy(np.int64).astype(np.uint32), grams["n"].to_numpy(np.float64), np.zeros(len(texts))
        key = known["key"].to_numpy(np.int64)
        order = np.argsort(key)
        key, count = np.append(key[order], np.iinfo(np.int64).max), np.append(known["n"].to_numpy(np.int64)[order], 0)
        n_tokens, n_known, base = (np.zeros(len(texts), d) for d in (np.int64, np.int64, np.float64))

        def look_up(h):
            i = np.searchsorted(key, h)
            return np.where(key[i] == h, count[i], 0)
        logp = lambda c: np.log10((c + 1.0) / (total + distinct + 1.0))
        end = look_up(np.array([END_HASH]))
        for i, j in slices(texts):
            flat, lens, types = encode_words([t.lower().split() for t in texts[i:j]])
            c = look_up(type_hashes(types).view(np.int64)) if types else np.zeros(0, np.int64)
            ends = bounds(lens)
            n_tokens[i:j] = lens + 1
            n_known[i:j] = np.round(segment_sums((c > 0)[flat] * 1.0, ends)) + int(end[0] > 0)
            base[i:j] = segment_sums(logp(c)[flat], ends) + logp(end)[0]
            c, lens = codes(texts[i:j])
            score_[i:j] = segment_sums(length[np.searchsorted(gram, c)], bounds(lens))
        return pd.DataFrame({"id": docs["id"], "held_out": docs["held"], "n_tokens": n_tokens, "n_known": n_known,
                             "train_tokens": total, "base_score": base, "score": score_})

    out = (docs.groupBy("block").cogroup(known.groupBy("block")).applyInPandas(
        run, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
    return out.withColumnRenamed("id", id_col)


def ppm_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs.withColumn("held", held_out(F.col("doc_id"), 7, 2)), "held")
