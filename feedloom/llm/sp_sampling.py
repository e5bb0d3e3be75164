"""SentencePiece segmentations by Gumbel top-k without replacement (operator 8).

A text's lattice has a node for every character boundary and an arc for every piece that fits; a piece's
weight falls with its rank, and characters outside the vocabulary are one arc of their byte pieces (so is U+2581 of the text itself, and bytes that are no UTF-8).  As
no piece goes on over a space, the lattice falls apart at spaces into word lattices that are built once
per word.  Backward sums turn weights into exact arc probabilities.

Segmentations leave a best-first (A*) search in falling order of their Gumbel-perturbed log-probability,
the subtree mass being the exact bound: the first path inherits the root's Gumbel value; at each of its
nodes the other arcs together hold a Gumbel value truncated at the path's own; the largest of these
values is the next segmentation's, which leaves the path there, and so on.  Top ``k`` of these are ``k``
distinct segmentations drawn without replacement.  With ``kappa``, the value of the next one, the
inclusion score of a segmentation of log-probability ``p`` is ``1 - exp(-exp(p - kappa))`` (1 when there
is no next one).  All randomness is a hash of the row key, the draw and the place.

Defined results: NULL or empty text has one, empty segmentation, probability 1; fewer than ``k``
possible segmentations are all returned; rows that repeat a key draw alike; a NULL key is a key of its
own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from itertools import chain, repeat

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import bounds, mix, slices, table, text_bytes, tidy, worker_cache

SPACE = "▁"
#: Stands for the sign itself where a text holds it; like bytes that are no UTF-8 (escaped as surrogates), it is
#: a lone surrogate, which no decoded text and no piece holds, and goes through the byte pieces.
SIGN = "\ud800"
#: No piece goes on over a space, and none holds a line break or tab: there the lattice falls apart.
UNIT = re.compile(f"{SPACE}+[^{SPACE}\n\t]*|[^{SPACE}\n\t]+|[\n\t]")
#: Step of the polynomial hash of a piece's characters.
STEP = np.uint64(0x100000001B3D)
#: Word lattices kept within a task before the cache starts anew.
CACHE_UNITS = 200_000


def marked(text: bytes) -> str:
    """A text as the lattice sees it: a space in front, spaces as ``SPACE``, the sign itself and bad bytes as surrogates."""
    return SPACE + text.decode("utf-8", "surrogateescape").replace(SPACE, SIGN).replace(" ", SPACE)


def raw(char: str) -> bytes:
    """The bytes of a character of a marked text."""
    return SPACE.encode() if char == SIGN else char.encode("utf-8", "surrogateescape")


class Lattices:
    """Word lattices side by side: nodes with their arcs, arcs with probability, target node and piece ids."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.piece = {}
        self.byte = [0] * 256
        self.surface = np.full(sp.get_piece_size(), b"", object)
        for i in range(sp.get_piece_size()):
            s = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(s[3:5], 16)] = i
                self.surface[i] = bytes([int(s[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.piece[s] = i
                self.surface[i] = s.replace(SPACE, " ").encode()
        if any(c in s.lstrip(SPACE) for s in self.piece for c in f"{SPACE}\n\t"):
            raise ValueError("a piece goes on over a space, line break or tab")
        first = min(self.piece.values())
        self.rare = -math.log(sp.get_piece_size())
        self.longest = max(map(len, self.piece))
        # Pieces by hash of their characters, with a small table that sees most misses off.
        hashes = np.zeros(len(self.piece), np.uint64)
        for n, s in enumerate(self.piece):
            for c in s:
                hashes[n:n + 1] = hashes[n:n + 1] * STEP + np.uint64(ord(c) + 1)
        order = np.argsort(hashes)
        self.hash = hashes[order]
        self.hash_id = np.fromiter(self.piece.values(), np.int64)[order]
        self.hint = np.zeros(1 << 20, bool)
        self.hint[mix(self.hash) & np.uint64((1 << 20) - 1)] = True
        # Likewise the hashes that some piece begins with: no place is followed beyond them.
        self.begins = np.zeros(1 << 22, bool)
        h, pieces = np.zeros(len(self.piece), np.uint64), list(self.piece)
        for n in range(self.longest):
            on = [i for i, s in enumerate(pieces) if len(s) > n]
            h[on] = h[on] * STEP + np.array([ord(pieces[i][n]) + 1 for i in on], np.uint64)
            self.begins[mix(h[on]) & np.uint64((1 << 22) - 1)] = True
        self.weight = -np.log(np.maximum(np.arange(sp.get_piece_size()) - first, 0) + 2.0)
        self.clear()

    def clear(self):
        self.start: dict[str, int] = {}
        self.nodes = 0
        # A character outside the vocabulary has the id -1 - n, n being its place among ``extra``.
        self.room = {k: np.zeros(0, t) for k, t in (("edge", float), ("logq", float), ("to", np.int32), ("id", np.int32), ("first", np.int64))}
        self.arcs = {k: self.room[k] for k in ("edge", "logq", "to", "id")}
        self.first = np.zeros(1, np.int64)
        self.extra: list[list[int]] = []

    def grown(self, name: str, old: np.ndarray, new: np.ndarray) -> np.ndarray:
        """``old`` with ``new`` behind it, in a buffer that grows by half when it is full."""
        n = len(old) + len(new)
        if n > len(self.room[name]):
            room = np.empty(n + n // 2, self.room[name].dtype)
            room[:len(old)] = old
            self.room[name] = room
        self.room[name][len(old):n] = new
        return self.room[name][:n]

    def add(self, units: list[str]) -> None:
        """Build the lattices of new words together: arcs of each length at once, then backward sums by
        distance from the word's end."""
        lens = np.fromiter(map(len, units), np.int64, len(units))
        chars = "".join(units)
        cp = np.frombuffer(chars.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        ends = bounds(lens)
        owner = np.repeat(np.arange(len(units)), lens)
        left = ends[owner + 1] - np.arange(len(cp))  # characters to the word's end
        h, on, at, length, ids = np.zeros(len(cp), np.uint64), np.arange(len(cp)), [], [], []
        for n in range(1, self.longest + 1):
            h = h * STEP + cp[on + n - 1] + np.uint64(1)
            m = mix(h)
            maybe = self.hint[m & np.uint64((1 << 20) - 1)]
            hit, seen = on[maybe], h[maybe]
            i = np.minimum(np.searchsorted(self.hash, seen), len(self.hash) - 1)
            ok = self.hash[i] == seen
            at.append(hit[ok])
            length.append(np.full(int(ok.sum()), n))
            ids.append(self.hash_id[i[ok]])
            if n == 1:
                odd = np.setdiff1d(np.arange(len(cp)), at[0], assume_unique=True)
                at.append(odd)
                length.append(np.ones(len(odd), np.int64))
                ids.append(np.full(len(odd), -1))
            go = self.begins[m & np.uint64((1 << 22) - 1)] & (left[on] > n)
            on, h = on[go], h[go]
        at, length, ids = np.concatenate(at), np.concatenate(length), np.concatenate(ids)
        weight = self.weight[ids]
        for n, c in zip(np.flatnonzero(ids < 0).tolist(), odd.tolist()):
            b = raw(chars[c])
            ids[n], weight[n] = -1 - len(self.extra), self.rare * len(b)
            self.extra.append([self.byte[x] for x in b])
        order = np.argsort(at * (self.longest + 1) + (self.longest - length))  # longer arcs of a node first
        at, length, ids, weight = at[order], length[order], ids[order], weight[order]
        node = at + owner[at]  # a word of n characters has n + 1 nodes
        to = node + length
        back = np.zeros(len(cp) + len(units))
        far = left[at]
        by_end = np.argsort(far.astype(np.uint16) if far.max() < 1 << 16 else far, kind="stable")  # 16 bits sort by radix
        groups = bounds(np.bincount(far, minlength=1))
        for d in range(1, len(groups) - 1):
            g = by_end[groups[d]:groups[d + 1]]
            if len(g):
                new = np.flatnonzero(np.diff(node[g], prepend=-1))
                back[node[g[new]]] = np.logaddexp.reduceat(weight[g] + back[to[g]], new)
        logq = np.minimum(weight + back[to] - back[node], 0.0)
        firsts = bounds(np.bincount(node, minlength=len(back)))[:-1]
        total = np.cumsum(np.exp(logq))
        within = total - np.concatenate([[0.0], total])[firsts[node]]
        last = np.append(np.diff(node) != 0, True)
        base, arcs = self.nodes, len(self.arcs["to"])
        new_arcs = {"edge": base + node + np.where(last, 1.0, within), "logq": logq, "to": base + to, "id": ids}
        self.arcs = {k: self.grown(k, v, new_arcs[k]) for k, v in self.arcs.items()}
        self.first = self.grown("first", self.first[:-1], np.append(arcs + firsts, len(self.arcs["to"])))
        self.start.update(zip(units, (base + ends[:-1] + np.arange(len(units))).tolist()))
        self.nodes = base + len(back)

    def starts(self, units: list[str]) -> np.ndarray:
        """Start node of each word; lattices of new words are built first."""
        out = np.fromiter(map(self.start.get, units, repeat(-1)), np.int64, len(units))
        missing = np.flatnonzero(out < 0)
        if len(missing):
            new = list(dict.fromkeys(map(units.__getitem__, missing.tolist())))
            if len(self.start) + len(new) > CACHE_UNITS:
                self.clear()
                new, missing = list(dict.fromkeys(units)), np.arange(len(units))
            self.add(new)
            out[missing] = np.fromiter(map(self.start.__getitem__, map(units.__getitem__, missing.tolist())), np.int64, len(missing))
        return out

    def draw(self, nodes: np.ndarray, seeds: np.ndarray):
        """Complete each node to its word's end: arcs in order, and arcs per node."""
        first, edge, to = self.first, self.arcs["edge"], self.arcs["to"]
        owner, taken = [], []
        live, at, step = np.arange(len(nodes)), nodes, 0
        while True:
            on = first[at + 1] > first[at]
            if not on.all():
                live, at = live[on], at[on]
            if not len(live):
                break
            aim, a = at + uniform(seeds[live], step), first[at]
            on = np.flatnonzero(edge[a] <= aim)
            while len(on):  # a node has few arcs, the likely ones first; its last edge is beyond any aim
                a[on] += 1
                on = on[edge[a[on]] <= aim[on]]
            owner.append(live)
            taken.append(a)
            at, step = to[a].astype(np.int64), step + 1
        if not owner:
            return np.zeros(0, np.int64), np.zeros(len(nodes), np.int64)
        owner, taken = np.concatenate(owner), np.concatenate(taken)
        return taken[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(nodes))

    def ids(self, path: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of arcs laid end to end, and where each of the paths between ``ends`` then ends."""
        ids = self.arcs["id"][path]
        odd = np.flatnonzero(ids < 0)
        if not len(odd):
            return ids, ends
        more = [self.extra[m] for m in (-1 - ids[odd]).tolist()]
        times = np.ones(len(ids), np.int64)
        times[odd] = list(map(len, more))
        out = np.repeat(ids, times)
        out[out < 0] = list(chain.from_iterable(more))
        return out, bounds(times)[ends]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text behind piece ids: surfaces joined, without the space put in front."""
        return b"".join(self.surface[ids].tolist())[1:]


def uniform(seeds: np.ndarray, place) -> np.ndarray:
    """Numbers in (0, 1) from seeds and places."""
    h = mix(seeds + np.uint64(0x9E3779B97F4A7C15) * np.asarray(place, np.uint64))
    return ((h >> np.uint64(12)).astype(np.float64) + 0.5) / (1 << 52)


def truncated(mass: np.ndarray, below, u: np.ndarray) -> np.ndarray:
    """Gumbel values of that log-mass, given that they lie below a value."""
    with np.errstate(over="ignore", divide="ignore"):
        return np.where(mass == -np.inf, -np.inf, mass - np.log(np.exp(np.minimum(mass - below, 700)) - np.log(u)))


def mix_one(seed, salt) -> np.ndarray:
    return mix(np.asarray(seed, np.uint64).reshape(-1) ^ mix(np.array([salt], np.uint64)))


class Path:
    """A found segmentation with the Gumbel values of what leaves it at each of its nodes."""

    def __init__(self, arcs, before, value, rest):
        self.arcs, self.before, self.value, self.rest = arcs, before, value, rest
        self.logp = float(before[-1])
        self.out: dict[int, set[int]] = {}

    def best(self):
        i = int(self.rest.argmax()) if len(self.rest) else -1
        return (float(self.rest[i]), i) if i >= 0 else (-np.inf, -1)


def paths(arcs: list[np.ndarray], logq: np.ndarray, values: list[float], since: list[int], seeds: np.ndarray) -> list[Path]:
    """Paths of given arcs and Gumbel values; what leaves one before its node ``since`` belongs to another path."""
    size = np.fromiter(map(len, arcs), np.int64, len(arcs))
    ends = bounds(size)
    step = logq[np.concatenate(arcs)] if len(arcs) else np.zeros(0)
    before = np.zeros(len(step) + len(arcs))  # every path starts with a 0
    for n, (a, b) in enumerate(zip(ends.tolist(), ends[1:].tolist())):
        np.cumsum(step[a:b], out=before[a + n + 1:b + n + 1])
    owner = np.repeat(np.arange(len(arcs)), size)
    place = np.arange(len(step)) - ends[owner]
    q = np.exp(step)
    with np.errstate(divide="ignore"):
        mass = np.where(q < 1 - 1e-12, before[np.arange(len(step)) + owner] + np.log1p(-np.minimum(q, 1 - 1e-16)), -np.inf)
    mass[place < np.asarray(since, np.int64)[owner]] = -np.inf
    rest = truncated(mass, np.asarray(values)[owner], uniform(seeds[owner], place))
    return [Path(x, before[a + n:b + n + 1], value, rest[a:b])
            for n, (x, value, a, b) in enumerate(zip(arcs, values, ends.tolist(), ends[1:].tolist()))]


def top_k(lat: Lattices, starts: np.ndarray, lens: np.ndarray, keys: np.ndarray, k: int):
    """For texts of ``lens`` words with start nodes ``starts``: per text the paths found and kappa."""
    ends = bounds(lens)
    logq, to, first = lat.arcs["logq"], lat.arcs["to"], lat.first
    word = np.arange(len(starts)) - np.repeat(ends[:-1], lens)
    seeds = lambda r: mix_one(keys, r)
    s = seeds(1)
    arcs, per = lat.draw(starts, mix(np.repeat(s, lens) + word.astype(np.uint64)))
    cut = bounds(per)[ends]
    root = -np.log(-np.log(uniform(seeds(2), 0)))
    gum = seeds(3)
    own = [arcs[a:b] for a, b in zip(cut.tolist(), cut[1:].tolist())]
    found = [[p] for p in paths(own, logq, root.tolist(), [0] * len(own), gum)]
    for r in range(1, k):
        todo, masses, aim, less = [], [], uniform(seeds(10 + r), 0), uniform(seeds(20 + r), 0)
        for d, have in enumerate(found):
            if len(have) < r:
                continue
            value, i, p = max(((*x.best(), n) for n, x in enumerate(have)), key=lambda x: x[0])
            if value == -np.inf:
                continue
            old = have[p]
            node_arc = int(old.arcs[i])
            # The node is the one whose arcs hold node_arc.
            node = int(np.searchsorted(first, node_arc, side="right")) - 1
            lo, hi = int(first[node]), int(first[node + 1])
            out = old.out.setdefault(i, {node_arc})
            choice = [x for x in range(lo, hi) if x not in out]
            w = np.exp(logq[choice])
            arc = choice[min(int(np.searchsorted(np.cumsum(w), aim[d] * w.sum(), side="right")), len(choice) - 1)]
            out.add(arc)
            left = [x for x in choice if x != arc]
            mass = old.before[i] + math.log(np.exp(logq[left]).sum()) if left else -np.inf
            masses.append(mass)
            # Word of arc i: words before it end where a target node has no arcs.
            done = int((first[to[old.arcs[:i]] + 1] == first[to[old.arcs[:i]]]).sum())
            nodes = np.concatenate([[to[arc]], starts[ends[d] + done + 1:ends[d + 1]]])
            todo.append((d, p, i, arc, value, nodes, done))
        if not todo:
            break
        of, values = [x[0] for x in todo], np.array([x[4] for x in todo])
        for (d, p, i, *_), rest in zip(todo, truncated(np.array(masses), values, less[of])):
            found[d][p].rest[i] = rest  # what still leaves the old path there
        size = np.array([len(x[5]) for x in todo])
        place = np.concatenate([np.arange(len(x[5])) + x[6] for x in todo]).astype(np.uint64)
        seed = np.repeat(mix_one(keys[[x[0] for x in todo]], 30 + r), size)
        tail, per = lat.draw(np.concatenate([x[5] for x in todo]), mix(seed + place))
        cut = bounds(per)[bounds(size)]
        fresh = seeds(40 + r)
        new = [np.concatenate([found[d][p].arcs[:i], [arc], tail[cut[n]:cut[n + 1]]]) for n, (d, p, i, arc, *_) in enumerate(todo)]
        for d, p in zip(of, paths(new, logq, values.tolist(), [x[2] + 1 for x in todo], fresh[of])):
            found[d].append(p)
    return [(have, max(x.best()[0] for x in have)) for have in found]


def draws(lat: Lattices, texts: list[bytes], keys: np.ndarray, k: int):
    """Rows (text number, draw, ids, n_pieces, logp, perturbed, log_inclusion, round_trip), a slice of texts at a time."""
    for i, j in slices(texts, 1 << 20):
        units = [UNIT.findall(marked(t)) if t else [] for t in texts[i:j]]
        lens = np.fromiter(map(len, units), np.int64, len(units))
        starts = lat.starts(list(chain.from_iterable(units)))
        found = top_k(lat, starts, lens, keys[i:j], k)
        every = [p.arcs for have, _ in found for p in have]
        ids, ends = lat.ids(np.concatenate(every), bounds(np.fromiter(map(len, every), np.int64, len(every))))
        ids, ends, at, rows = ids.astype("<i4", copy=False), ends.tolist(), 0, []
        for d, (have, kappa) in enumerate(found):
            for n, p in enumerate(have):
                pieces, at = ids[ends[at]:ends[at + 1]], at + 1
                with np.errstate(divide="ignore", over="ignore"):
                    inc = 0.0 if kappa == -np.inf else p.logp - kappa if p.logp - kappa < -30 else float(
                        np.log(-np.expm1(-np.exp(p.logp - kappa))))
                rows.append((i + d, n + 1, pieces.tobytes(), len(pieces), p.logp, p.value, inc, lat.decode(pieces) == texts[i + d]))
        yield rows


def sample(df: DataFrame, model_path: str, k: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row and draw: id, draw (from 1), ids (packed little-endian 32-bit), n_pieces, logp, perturbed,
    log_inclusion, and whether decoding the ids gives the text back."""
    kind = dict(df.dtypes)[id_col]

    def run(batches):
        import pandas as pd
        cache = worker_cache("sp_lattices")
        if model_path not in cache:
            cache[model_path] = Lattices(model_path)
        lat = cache[model_path]
        for pdf in batches:
            texts, keys, ids = pdf["t"].tolist(), pdf["key"].to_numpy(np.int64).view(np.uint64), pdf["id"].to_numpy()
            for rows in draws(lat, texts, keys, k):
                out = pd.DataFrame(rows, columns=["id", "draw", "ids", "n_pieces", "logp", "perturbed", "log_inclusion", "round_trip"])
                yield out.assign(id=ids[out["id"].to_numpy(np.int64)])
        lat.clear()  # the pieces stay for the worker's next task, the words' lattices do not

    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col)).alias("key"), text_bytes(text_col).alias("t"))
    return rows.mapInPandas(tidy(run), f"id {kind}, draw int, ids binary, n_pieces int, logp double, perturbed double, "
                                 "log_inclusion double, round_trip boolean").withColumnRenamed("id", id_col)


def sampling_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    out = sample(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "draw", "n_pieces", "logp", "perturbed", "log_inclusion", "round_trip", F.crc32("ids").alias("ids_crc32"))
