"""5-word shingle hashes of whole texts, vectorised over a slice of texts."""

from __future__ import annotations

import numpy as np
import xxhash

from feedloom.llm.common import bounds, encode_words, mix, slices

K = 5
#: Odd multipliers, one for each place in a shingle.
PLACE = mix(np.arange(1, K + 1, dtype=np.uint64)) | np.uint64(1)


def type_hashes(types: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, types), np.uint64, len(types))


def rolling(h: np.ndarray, lens: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words (a shorter text is one run) of texts laid end to end, and runs per text."""
    n = len(h)
    ends = bounds(lens)
    runs = np.where(lens >= k, lens - k + 1, np.minimum(lens, 1))
    starts = np.arange(int(runs.sum())) + np.repeat(ends[:-1] - bounds(runs)[:-1], runs)
    out = np.zeros(len(starts), np.uint64)
    left = np.repeat(np.minimum(lens, k), runs)
    for i in range(k):
        if n:
            out += np.where(i < left, h[np.minimum(starts + i, n - 1)] * PLACE[i], np.uint64(0))
    return mix(out + left.astype(np.uint64)), runs


def shingle_sets(texts: list[bytes]):
    """Each text's distinct shingle hashes, ascending."""
    for i, j in slices(texts):
        flat, lens, types = encode_words([t.lower().split() for t in texts[i:j]])
        h, runs = rolling(type_hashes(types)[flat] if types else np.zeros(0, np.uint64), lens)
        ends = bounds(runs).tolist()
        for a, b in zip(ends, ends[1:]):
            yield np.unique(h[a:b])
