"""Benchmark decontamination by SimHash of item-sized windows (operator 6).

Items are put into classes of about one length; for each class, windows of that many words slide over
every whole text.  A window's fingerprint is the sign of the summed bits of its word-pair hashes, from
running sums, so all window sizes share one pass.  Within radius 15 of 64 bits, one of four 16-bit
blocks differs in at most 3 bits: a table per class and block, holding all values that near to an item,
guarantees every such pair.  Each candidate is verified exactly, at every shift up to the stride, by
weighted Jaccard similarity of 5-word shingles (a shingle weighs less the more items hold it).

Items are taken ``item_block`` at a time (a stated query set in blocks), so what a task holds is bounded.

Defined results: NULL or empty texts and items match nothing; repeated rows are scanned on their own;
NULL ids are kept as they are; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import chain, combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import bounds, mix, share, shared_value, slices, table, text_bytes, tidy

RADIUS, BLOCKS, BITS = 15, 4, 16
K = 5
#: Longest item of a length class as a multiple of its shortest.
CLASS = 1.1
#: Sums of weights that differ by no more than this share count as equal.
ROUNDING = 1e-9


def pair_hashes(h: np.ndarray) -> np.ndarray:
    """Hash of each word with the next (the last with nothing)."""
    nxt = np.append(h[1:], np.uint64(0)) if len(h) else h
    return mix(h * np.uint64(0x9E3779B97F4A7C15) + (nxt ^ (nxt >> np.uint64(31))) * np.uint64(0xD1B54A32D192ED03))


def lane_width(longest: int) -> int:
    """Bits of a lane that counts up to ``longest``."""
    return 8 if longest < 1 << 8 else 16 if longest < 1 << 16 else 32


def running_bits(pairs: np.ndarray, width: int) -> np.ndarray:
    """Running sums of each of the 64 bits in lanes of ``width`` bits, several to a 64-bit word.

    Sums wrap over lanes, but a difference of two of them is exact where it fits its lanes.
    """
    lanes = np.uint64(sum(1 << b for b in range(0, 64, width)))
    out = np.zeros((len(pairs) + 1, width), np.uint64)
    for k in range(width):
        np.cumsum((pairs >> np.uint64(k)) & lanes, out=out[1:, k])
    return out


def fingerprints(run: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """SimHash of the pairs [a, b): a bit is 1 if more than half of them set it (bits in the order of the lanes)."""
    out = np.empty(len(a), np.uint64)
    lane = {8: np.uint8, 16: np.uint16, 32: np.uint32}[run.shape[1]]
    for i in range(0, len(a), 1 << 12):
        x, y = a[i:i + (1 << 12)], b[i:i + (1 << 12)]
        ones = np.take(run, y, axis=0)
        ones -= np.take(run, x, axis=0)
        most = ones.view(lane) > ((y - x) >> 1).astype(lane)[:, None]
        out[i:i + len(x)] = np.packbits(most, axis=1).view("<u8")[:, 0]
    return out


def word_hashes(words: list[list]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words end to end, and words per text."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(words)), np.uint64, int(lens.sum())), lens


def shingle_counts(words: list) -> Counter:
    return Counter(tuple(words[i:i + K]) for i in range(max(1, len(words) - K + 1))) if words else Counter()


class Index:
    """Items by length class, with block tables and shingle weights."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.items = [(i, t.lower().split()) for i, t in items]
        self.items = [(i, w) for i, w in self.items if w]
        self.shingles = [shingle_counts(w) for _, w in self.items]
        df = Counter(s for c in self.shingles for s in c)
        n = max(1, len(self.items))
        self.weight = {s: 1 + math.log(n / d) for s, d in df.items()}
        self.default = 1 + math.log(n)
        order = sorted(range(len(self.items)), key=lambda i: len(self.items[i][1]))
        near = [0] + [sum(1 << b for b in c) for r in range(1, RADIUS // BLOCKS + 1) for c in combinations(range(BITS), r)]
        near, groups = np.array(near), []
        for i in order:
            if not groups or len(self.items[i][1]) > CLASS * len(self.items[groups[-1][0]][1]):
                groups.append([])
            groups[-1].append(i)
        self.classes = []
        for g in groups:
            size = round(sum(len(self.items[i][1]) for i in g) / len(g))
            # Items and windows of a class have lanes of one width, hence bits of one order.
            width = lane_width(len(self.items[g[-1]][1]))
            prints = np.zeros(len(g), np.uint64)
            for k, i in enumerate(g):
                h = word_hashes([self.items[i][1]])[0]
                prints[k] = fingerprints(running_bits(pair_hashes(h), width), np.array([0]), np.array([max(1, len(h) - 1)]))[0]
            tables = np.zeros((BLOCKS, 1 << BITS), bool)
            for b in range(BLOCKS):
                part = (prints >> np.uint64(BITS * b)).astype(np.int64) & ((1 << BITS) - 1)
                tables[b, (part[:, None] ^ near).ravel()] = True
            self.classes.append((size, max(1, math.isqrt(size) // 2), np.array(g), prints, tables, width))

    def similarity(self, item: int, window: Counter) -> float:
        own, both, all_ = self.shingles[item], 0.0, 0.0
        for s in own.keys() | window.keys():
            w = self.weight.get(s, self.default)
            both += w * min(own[s], window[s])
            all_ += w * max(own[s], window[s])
        return both / all_ if all_ else 0.0

    def reachable(self, item: int, words: list, threshold: float) -> bool:
        """Whether any window inside ``words`` can reach the threshold: a window shares no more with the item than all
        of them together, and the two together weigh at least as much as the item."""
        own, n = self.shingles[item], len(self.items[item][1])
        if n < K:  # a window of so few words is one shingle of its own length
            return True
        seen, all_, both = Counter(s for s in zip(*(words[i:] for i in range(K))) if s in own), 0.0, 0.0
        for s, c in own.items():
            w = self.weight[s]
            all_ += w * c
            both += w * min(c, seen[s])
        return both >= threshold * all_ * (1 - ROUNDING)

    def best_shift(self, item: int, words: list, ranges: list[tuple[int, int]]) -> tuple[int, float]:
        """First word and exact similarity of the best window that starts in one of the ``ranges``.

        Overlapping ranges are walked once; from one start to the next, one shingle leaves and one comes.
        """
        own, n, best = self.shingles[item], len(self.items[item][1]), (-1, -1.0)
        runs = [tuple(words[i:i + K]) for i in range(len(words) - K + 1)] if n >= K else []
        whole = sum(self.weight[s] * c for s, c in own.items())
        done = -1
        for first, last in sorted(ranges):
            first = max(first, done + 1)
            done = max(done, last)
            seen, both, all_ = Counter(), 0.0, whole
            for s in range(first, last + 1):
                if n < K:
                    sim = self.similarity(item, shingle_counts(words[s:s + n]))
                else:
                    for x in runs[s:s + n - K + 1] if s == first else runs[s + n - K:s + n - K + 1]:
                        w = self.weight.get(x, self.default)
                        both, all_ = (both + w, all_) if seen[x] < own[x] else (both, all_ + w)
                        seen[x] += 1
                    sim = both / all_
                if sim > best[1] + ROUNDING:
                    best = (s, sim)
                if n >= K and s < len(runs):
                    x = runs[s]
                    w = self.weight.get(x, self.default)
                    seen[x] -= 1
                    both, all_ = (both - w, all_) if seen[x] < own[x] else (both, all_ - w)
        s = best[0]
        return s, self.similarity(item, shingle_counts(words[s:s + n])) if s >= 0 else 0.0

    def scan(self, texts: list[bytes], threshold: float):
        """(text number, item number, first word, similarity) of the best window of each text and item at the threshold or above."""
        words = [t.lower().split() for t in texts]
        h, lens = word_hashes(words)
        if not len(h):
            return
        pairs, runs, ends = pair_hashes(h), {}, bounds(lens)
        near: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for size, stride, group, prints, tables, width in self.classes:
            run = runs[width] if width in runs else runs.setdefault(width, running_bits(pairs, width))
            # Starts 0, stride, ... up to the last window; a shorter text is one window.
            many = np.where(lens > 0, np.maximum(0, -(-(lens - size) // stride)) + 1, 0)
            text = np.repeat(np.arange(len(lens)), many)
            start = (np.arange(len(text)) - np.repeat(bounds(many)[:-1], many)) * stride
            start = np.minimum(start, np.maximum(lens[text] - size, 0))
            a = ends[text] + start
            b = np.maximum(np.minimum(a + size, ends[text + 1]) - 1, a + 1)
            f = fingerprints(run, a, b)
            hit = np.zeros(len(f), bool)
            for k in range(BLOCKS):
                hit |= tables[k][(f >> np.uint64(BITS * k)).astype(np.int64) & ((1 << BITS) - 1)]
            hit = np.flatnonzero(hit)
            for step in range(0, len(hit), 4096):
                h = hit[step:step + 4096]
                rows, cols = np.nonzero(np.bitwise_count(f[h][:, None] ^ prints[None]) <= RADIUS)
                for x, c in zip(h[rows].tolist(), cols.tolist()):
                    d, item = int(text[x]), int(group[c])
                    n = len(self.items[item][1])
                    first = max(0, int(start[x]) - stride)
                    last = min(int(start[x]) + stride, max(0, len(words[d]) - 1))
                    if self.reachable(item, words[d][first:last + n], threshold):
                        near.setdefault((d, item), []).append((first, last))
        for (d, item), ranges in near.items():
            s, sim = self.best_shift(item, words[d], ranges)
            if sim >= threshold * (1 - ROUNDING):
                yield d, item, s, sim


def contamination(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", threshold: float = 0.75, item_block: int = 20_000) -> DataFrame:
    """(id, item, start word, n_words, similarity) for every document and item at the threshold or above."""
    spark = df.sparkSession
    kind, item_kind = dict(df.dtypes)[id_col], dict(items.dtypes)[item_col]
    schema = f"id {kind}, item {item_kind}, start_word int, n_words int, similarity double"
    src = items.where(F.col(item_text).isNotNull()).select(F.col(item_col).alias("i"), text_bytes(item_text).alias("t"))
    rows = df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("t"))
    out, blocks = None, -(-src.count() // item_block)
    for n in range(max(1, blocks)):
        chosen = src.where(F.pmod(F.xxhash64("i", "t"), F.lit(max(1, blocks))) == n).collect()  # about item_block rows
        shared = share(spark, Index([(r.i, bytes(r.t)) for r in chosen]))

        def run(batches, shared=shared):
            import pandas as pd
            index = shared_value(shared)
            for pdf in batches:
                texts, ids, found = pdf["t"].tolist(), pdf["id"].to_numpy(), []
                for i, j in slices(texts, 1 << 20):
                    for d, item, s, sim in index.scan(texts[i:j], threshold):
                        found.append((ids[i + d], index.items[item][0], s, len(index.items[item][1]), sim))
                yield pd.DataFrame(found, columns=["id", "item", "start_word", "n_words", "similarity"])

        part = rows.mapInPandas(tidy(run), schema)
        out = part if out is None else out.unionByName(part)
    return out.withColumnsRenamed({"id": id_col, "item": item_col})


def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
