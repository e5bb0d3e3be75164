"""N-gram Jaccard self-join with token-combination prefixes (operator 5).

Tokens are hashes of a document's distinct 5-word shingles; their order is the hash.  With ``n``
tokens, a document at Jaccard 0.75 or more to it misses at most ``e = n // 4`` of them.

1. Documents with equal sets form one class, and the rest works on classes.
2. Each class gives a prefix of ``e + 1 + slack`` tokens.  A token in more than ``frequent`` of these
   prefixes is of the frequent class; all others are of the rare class.
3. A prefix with fewer than ``e + 1`` rare tokens is extended to the whole set.  Tokens in more than
   ``frequent`` of the extended sets become frequent too, until no prefix is short of rare tokens.
4. With the order (rare tokens first, then hash) every similar pair that shares a rare token shares one
   within both prefixes, so rare tokens are indexed singly and the shared ones of a pair counted.
   A pair that shares frequent tokens only lacks all its rare ones, so both its sets hold at most ``e`` of
   them, ``r``: such *poor* classes give their first ``e - r + 1 + G`` frequent tokens, ``G + 1`` of which
   are shared.  Two of these lie in one of ``G`` sub-classes (hash modulo ``G``), so 2-combinations within
   sub-classes are indexed; ``G`` follows the size (power of two), and every class indexes its own level
   and the one below, as partners lie at most a level apart.
5. A combination's classes are first compared with one of them, the one with the smallest share of
   rare tokens (the least edited of near copies; ties go by one of ``HUBS`` orders).  Where that leaves a combination with
   several components, all of its classes outside the largest component are compared with those of
   other components.  Every pair is verified exactly on the whole sets; links give connected components.

No pair of the same component is needed twice, so groups of thousands of near copies cost a few
comparisons a document, and the exact ``r`` of both sides rules pairs out that share a common passage
without being similar.  Each hub's comparisons are dealt over ``salt`` parts, so no group meets in one
task whole.  Shingles are compared by 48 bits of their hashes.

Defined results: NULL or empty text has no shingles and links with nothing; NULL ids link with
nothing and have a NULL component; rows that repeat an id share its component (texts of one id count as
linked); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import materialize, mix, table, text_bytes, tidy
from feedloom.llm.shingles import shingle_sets

FREQUENT = 64
#: Buckets of the filter on ids that picks candidate documents in the second pass; bounds what the driver holds.
ID_BUCKETS = 1 << 20
#: Buckets of the filter on tokens that spares most tokens a shuffle; also a fixed size (8 MB).
TOKEN_BUCKETS = 1 << 26
HUB_PART = 512
#: Hubs that a group sharing its combinations has, each the first in another order.
HUBS = 3


def level_groups(n: int) -> int:
    """Sub-classes of a document's own level."""
    return max(1, (1 << (n.bit_length() - 1)) // 8)


def signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def set_hash(s: np.ndarray) -> int:
    """Signed 64-bit hash of a whole set."""
    c = int((s * np.uint64(0x9E3779B97F4A7C15) ^ (s >> np.uint64(29))).sum(dtype=np.uint64)) ^ (len(s) << 40)
    return c - (1 << 64) if c >= 1 << 63 else c


def prefixes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n tokens, class (hash of the whole set), prefix (only for a class's first document in the task)."""
    def run(batches):
        import pandas as pd
        seen = set()
        for pdf in batches:
            n, cls, pre = [], [], []
            for s in shingle_sets(pdf["t"].tolist()):
                k, c = len(s), set_hash(s)
                n.append(k)
                cls.append(c)
                if k < 3 or c in seen:
                    pre.append(None)
                else:
                    seen.add(c)
                    pre.append(signed(s[:k // 4 + 1 + max(1, k // 32)] >> np.uint64(16)))
            yield pd.DataFrame({"id": pdf["id"], "n": n, "cls": cls, "prefix": pre})

    rows = df.select(F.col(id_col).cast("long").alias("id"), text_bytes(text_col).alias("t"))
    return rows.mapInPandas(tidy(run), "id long, n long, cls long, prefix array<long>")


def combinations(rows: DataFrame, extra: str = "") -> DataFrame:
    """(id, n, r, tokens, ...) -> (sig, id, n, r, ...): 2-combinations of the first frequent tokens within the
    sub-classes of two levels; ``extra`` names further long columns to keep."""
    keep = ["id", "n", "r", *extra.split()]

    def run(batches):
        import pandas as pd
        for pdf in batches:
            sigs, of = [], []
            for row, n, r, tokens in zip(range(len(pdf)), pdf["n"].tolist(), pdf["r"].tolist(), pdf["tokens"]):
                t = np.sort(np.asarray(tokens, np.int64).view(np.uint64))[:n // 4 - r + 1 + max(1, n // 8)]
                g = level_groups(n)
                for level in {g, max(1, g // 2)}:
                    cls = t % np.uint64(level)
                    o = np.argsort(cls, kind="stable")
                    u, c = t[o], cls[o]
                    for gap in range(1, len(u)):
                        same = np.flatnonzero(c[gap:] == c[:-gap])
                        if not len(same):
                            break
                        sigs.append(mix(u[same] * np.uint64(0x9E3779B97F4A7C15) + mix(u[same + gap] + np.uint64(level))))
                        of.append(np.full(len(same), row))
            if sigs:
                out = pdf[keep].iloc[np.concatenate(of)].reset_index(drop=True)
                out.insert(0, "sig", signed(np.concatenate(sigs)))
                yield out

    return rows.select(*keep, "tokens").mapInPandas(run, "sig long, " + ", ".join(f"{c} long" for c in keep))


def possible(counted: bool):
    """Conditions that every similar pair (a, b) without a common rare token meets: a set's ``r`` rare tokens
    are not shared, so at most ``n - overlap`` of them exist.  With ``counted`` on the common combinations
    ``q`` too: of the prefix that ends first at least ``share`` tokens are shared, and spread over the
    sub-classes of the smaller level these make at least so many combinations.
    """
    overlap = F.expr("(3 * (n_a + n_b) + 6) div 7")
    free = lambda s: F.col(f"n_{s}") - overlap - F.col(f"r_{s}")
    sizes = (100 * F.col("n_a") >= 75 * F.col("n_b")) & (100 * F.col("n_b") >= 75 * F.col("n_a"))
    if not counted:
        return sizes & (free("a") >= 0) & (free("b") >= 0)
    prefix = lambda s: F.expr(f"least(n_{s} - r_{s}, n_{s} div 4 - r_{s} + 1 + greatest(1, n_{s} div 8))")
    share = F.greatest(F.lit(0), F.least(prefix("a") - free("a"), prefix("b") - free("b")))
    power = F.pow(F.lit(2.0), F.length(F.bin(F.least("n_a", "n_b"))) - 1).cast("long")
    level = F.greatest(F.lit(1), F.floor(power / 8))
    each, rest = F.floor(share / level), share % level
    return F.col("q") >= rest * each * (each + 1) / 2 + (level - rest) * each * (each - 1) / 2


def token_sets(df: DataFrame, id_col: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """id (class) and packed token set (6 bytes each, ascending) of ``wanted`` classes (id, rep): texts whose
    document's bucket is among those of the representatives are read again."""
    spark = df.sparkSession
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(ID_BUCKETS)).cast("int")
    hit = np.zeros(ID_BUCKETS, bool)
    for r in wanted.select(bucket("rep").alias("b")).distinct().collect():  # at most ID_BUCKETS rows
        hit[r.b] = True
    shared = spark.sparkContext.broadcast(np.packbits(hit))

    def run(batches):
        import pandas as pd
        bits = np.unpackbits(shared.value)
        for pdf in batches:
            pdf = pdf[bits[pdf["b"].to_numpy()] > 0]
            cls, packed = [], []
            for s in shingle_sets(pdf["t"].tolist()):
                cls.append(set_hash(s))
                packed.append((s >> np.uint64(16)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes())
            yield pd.DataFrame({"id": pd.Series(cls, dtype="int64"), "rep": pdf["rep"].to_numpy(), "toks": packed})

    rows = df.select(F.col(id_col).cast("long").alias("rep"), text_bytes(text_col).alias("t")).where("rep is not null")
    found = rows.select("rep", bucket("rep").alias("b"), "t").mapInPandas(tidy(run), "id long, rep long, toks binary")
    return found.join(wanted.select("id", "rep"), ["id", "rep"], "left_semi").select("id", "toks")


def unpack(b: bytes) -> np.ndarray:
    """A packed token set as numbers."""
    a = np.zeros((len(b) // 6, 8), np.uint8)
    a[:, 2:] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return a.view(">u8")[:, 0].astype(np.uint64)


def unpacked(sets: DataFrame) -> DataFrame:
    """(id, toks) -> one row per class: id, n, zone (the whole set)."""
    def run(batches):
        import pandas as pd
        for pdf in batches:
            zone = [signed(unpack(b)) for b in pdf["toks"]]
            yield pd.DataFrame({"id": pdf["id"], "n": [len(z) for z in zone], "zone": zone})

    return sets.groupBy("id").agg(F.max("toks").alias("toks")).mapInPandas(run, "id long, n long, zone array<long>")


def exploded(zones: DataFrame) -> DataFrame:
    return zones.select("id", F.explode("zone").alias("sig"))


def touching(zones: DataFrame, tokens: DataFrame) -> DataFrame:
    """The (id, sig) of ``zones`` whose token is among ``tokens``; a bitmap of fixed size spares the others a shuffle."""
    spark = zones.sparkSession
    place = F.pmod(F.col("sig"), F.lit(TOKEN_BUCKETS)) + 1  # numbered from 1, as bitmap buckets are
    marks = tokens.select(F.bitmap_bucket_number(place).alias("n"), F.bitmap_bit_position(place).alias("at")) \
        .groupBy("n").agg(F.bitmap_construct_agg("at").alias("bits"))
    bits = np.zeros(TOKEN_BUCKETS // 8, np.uint8)
    for r in marks.collect():  # at most TOKEN_BUCKETS / 32768 rows of 4 KB
        bits[(r.n - 1) * 4096:r.n * 4096] = np.frombuffer(bytes(r.bits), np.uint8)
    shared = spark.sparkContext.broadcast(bits)

    def run(batches):
        import pandas as pd
        marked = shared.value
        for pdf in batches:
            lens = pdf["zone"].map(len).to_numpy()
            sig = np.concatenate(pdf["zone"].tolist()) if len(pdf) else np.zeros(0, np.int64)
            at = sig % TOKEN_BUCKETS
            on = (marked[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
            yield pd.DataFrame({"id": np.repeat(pdf["id"].to_numpy(), lens)[on], "sig": sig[on]})

    found = zones.select("id", "zone").mapInPandas(run, "id long, sig long")
    return found.join(tokens.select("sig").distinct(), "sig", "left_semi").select("id", "sig")


def verify(pairs: DataFrame, sets: DataFrame, percent: int = 75) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity: a hub ``a`` meets its partners in sorted order."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HUB_PART).cast("int").alias("parts"))
    pairs = pairs.join(parts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("parts").cast("long")).cast("int"))
    members = pairs.select("a", "salt", F.col("b").alias("id"))
    hubs = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), F.col("a").alias("id"))
    rows = members.unionByName(hubs).join(sets, "id")

    def run(batches):
        import pandas as pd
        key, hub, done = None, [], set()
        for pdf in batches:
            out = []
            for a, salt, i, toks in zip(pdf["a"], pdf["salt"], pdf["id"], pdf["toks"]):
                if (a, salt) != key:
                    key, hub, done = (a, salt), [], set()
                s = unpack(toks)
                if i == a:
                    hub.append(s)
                    continue
                for h in hub if i not in done else []:
                    if not len(h) or not len(s) or 100 * min(len(h), len(s)) < percent * max(len(h), len(s)):
                        continue
                    inter = int((h[np.minimum(np.searchsorted(h, s), len(h) - 1)] == s).sum())
                    if 100 * inter >= percent * (len(h) + len(s) - inter):
                        out.append((a, i))
                        done.add(i)
                        break
            yield pd.DataFrame(out, columns=["a", "b"])

    hub_first = (F.col("id") != F.col("a")).cast("int")
    return (rows.withColumn("o", hub_first).repartition("a", "salt").sortWithinPartitions("a", "salt", "o", "id")
            .select("a", "salt", "id", "toks").mapInPandas(tidy(run), "a long, b long"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) links -> (id, component): smallest label of the neighbourhood, then the label's label, until still."""
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(
                             F.col("a").alias("id"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("label").alias("m"))
                .withColumnRenamed("a", "id"))
        step = labels.join(near, "id").select("id", "label", F.least("label", "m").alias("new"))
        jump = step.select(F.col("id").alias("new"), F.col("new").alias("far"))
        nxt = materialize(step.join(jump, "new", "left").select("id", "label", F.least("new", "far").alias("new")), "labels")
        if nxt.where("label <> new").limit(1).count() == 0:
            return nxt.select("id", F.col("new").alias("component"))
        labels = nxt.select("id", F.col("new").alias("label"))


def classified(df: DataFrame, base: DataFrame, id_col: str, text_col: str, frequent: int):
    """Token classes settled by extending prefixes: (nodes, zones, rare index, frequent tokens).

    ``base`` holds id, rep, n, zone.  nodes: id, rep, n, last, z (length of the final prefix), heavy (its
    frequent tokens); zones: final prefixes; index: (id, sig) of rare tokens in at least two of them.
    """
    rows = exploded(base)
    counts = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    index = materialize(rows.join(counts, "sig").select("id", "sig", (F.col("c") > frequent).alias("many")), "index")
    heavy = materialize(index.where("many").select("sig").distinct(), "frequent")
    whole, zones = None, base.select("id", "n", "zone")
    hits = index.where("many")
    while True:
        heavies = hits.groupBy("id").agg(F.count(F.lit(1)).alias("heavy"))
        nodes = materialize(
            zones.select("id", "n", F.size("zone").cast("long").alias("z"), F.element_at("zone", -1).alias("last"))
            .join(base.select("id", "rep"), "id").join(heavies, "id", "left").withColumn("heavy", F.coalesce("heavy", F.lit(0))), "nodes")
        short = materialize(nodes.where("z < n and z - heavy < n div 4 + 1").select("id", "rep"), "short")
        if not short.limit(1).count():
            break
        got = materialize(unpacked(token_sets(df, id_col, text_col, short)), "whole-sets")
        whole = got if whole is None else materialize(whole.unionByName(got), "whole-sets")
        many = exploded(got).groupBy("sig").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > frequent)
        heavy = materialize(heavy.unionByName(many.select("sig")).distinct(), "frequent")
        zones = base.select("id", "n", "zone").join(whole.select("id"), "id", "left_anti").unionByName(whole)
        hits = exploded(zones).join(heavy, "sig")
    index = index.select("id", "sig")
    if whole is not None:
        tokens, old = exploded(whole), base.join(whole.select("id"), "id", "left_anti")
        index = tokens.unionByName(index.join(whole.select("id"), "id", "left_anti")).unionByName(touching(old, tokens)).distinct()
    index = materialize(index.join(heavy, "sig", "left_anti"), "rare-tokens")
    twice = index.groupBy("sig").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    return nodes, zones, index.join(twice.select("sig"), "sig", "left_semi"), heavy


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id reachable by links)."""
    docs = materialize(prefixes(df, id_col, text_col), "prefixes")
    known = docs.where("id is not null and n > 0")
    classes = materialize(known.groupBy(F.col("cls").alias("id")).agg(
        F.min("id").alias("rep"), F.max("n").alias("n"), F.max("prefix").alias("zone")), "classes")
    nodes, zones, rare, heavy = classified(df, classes.where("zone is not null"), id_col, text_col, frequent)

    # Rare tokens: count the shared ones of each pair, keep pairs that can still reach the similarity.
    rare = materialize(rare.join(nodes.select("id", "n"), "id"), "rare-index")
    traits = nodes.join(rare.groupBy("id").agg(F.count(F.lit(1)).alias("twice")), "id", "left")
    traits = traits.withColumn("alone", F.col("z") - F.col("heavy") - F.coalesce("twice", F.lit(0)))
    side = lambda s: traits.select(F.col("id").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("n", "last", "heavy", "z", "alone")])
    left = rare.select("sig", F.col("id").alias("a"), F.col("n").alias("na"))
    right = rare.select(F.col("sig").alias("sig_"), F.col("id").alias("b"), F.col("n").alias("nb"))
    near_size = (100 * F.col("na") >= 75 * F.col("nb")) & (100 * F.col("nb") >= 75 * F.col("na"))
    shared = left.join(right, (F.col("sig") == F.col("sig_")) & (F.col("a") < F.col("b")) & near_size) \
        .groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"))
    shared = shared.join(side("a"), "a").join(side("b"), "b")
    first = lambda c: F.when(F.col("last_a") <= F.col("last_b"), F.col(c + "_a")).otherwise(F.col(c + "_b"))
    overlap = F.expr("(3 * (n_a + n_b) + 6) div 7")
    rare_pairs = shared.where((F.col("c") >= overlap - first("n") + first("z") - first("heavy"))
                              & (first("alone") <= first("n") - overlap)).select("a", "b")

    # Pairs that share frequent tokens only: combinations of two, each class against a hub.
    poor = nodes.where("z - heavy < n div 4 + 1").select("id", "n", (F.col("z") - F.col("heavy")).alias("r"))
    tokens = exploded(zones.join(poor.select("id"), "id", "left_semi")).join(heavy, "sig", "left_semi")
    tokens = materialize(tokens.groupBy("id").agg(F.collect_list("sig").alias("tokens")).join(poor, "id"), "poor")
    combos = combinations(tokens)
    order = F.struct(F.col("r") / F.col("n"), F.xxhash64("id", F.pmod("sig", F.lit(HUBS))))
    live = combos.groupBy("sig").agg(F.count(F.lit(1)).alias("c"), F.min_by("id", order).alias("hub")).where("c > 1")
    star = combos.join(live.select("sig", "hub"), "sig").where("id <> hub").select(
        F.col("hub").alias("a"), F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("r").alias("r_b")).distinct()
    hubs = poor.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("r").alias("r_a"))
    star = star.join(hubs, "a").where(possible(False)).select("a", "b")
    first_pairs = materialize(rare_pairs.unionByName(star).distinct(), "first-pairs")

    ids = first_pairs.select(F.explode(F.array("a", "b")).alias("id")).unionByName(poor.select("id")).distinct()
    sets = materialize(token_sets(df, id_col, text_col, materialize(nodes.select("id", "rep").join(ids, "id"), "wanted")), "token-sets")
    # Texts of one id count as linked.
    texts = known.select("id", "cls").distinct()
    same_id = texts.join(texts.groupBy("id").agg(F.min("cls").alias("a"), F.max("cls").alias("z")).where("a <> z"), "id") \
        .where("cls <> a").select("a", F.col("cls").alias("b"))
    links = materialize(verify(first_pairs, sets).unionByName(same_id), "links-first")
    label = connected_components(links)

    # Combinations with several components: what lies outside the largest of them meets the others.
    size = label.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    label_size = label.join(size, "component")
    small = F.lit(62) - F.floor(F.log2(F.coalesce("size", F.lit(1)).cast("double")))  # larger components first
    order = F.shiftleft(small.cast("long"), 56) + F.pmod(F.xxhash64("component"), F.lit(1 << 56))
    named = tokens.join(label_size, "id", "left").withColumn("component", F.coalesce("component", "id")).withColumn("place", order)
    named = combinations(named, "component place")
    mixed = named.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("place").alias("main"))
    named = materialize(named.join(mixed.where("lo <> hi").select("sig", "main"), "sig"), "combinations-mixed")
    own = lambda rows, s: rows.select(*[F.col(c).alias(f"{c}_{s}") for c in ("sig", "id", "n", "r", "component", "place", "main")])
    rest = own(named.where("place <> main"), "a").join(
        own(named, "b"), (F.col("sig_a") == F.col("sig_b")) & (F.col("component_a") != F.col("component_b"))
        & ((F.col("place_b") == F.col("main_b")) | (F.col("id_a") < F.col("id_b"))) & possible(False))
    # A combination gives a pair in the order of its own main component: one order for all before they are counted.
    turned = F.col("id_a") > F.col("id_b")
    rest = rest.select(*[F.when(turned, F.col(f"{c}_{t}")).otherwise(F.col(f"{c}_{s}")).alias(f"{c}_{s}")
                         for c in ("id", "n", "r") for s, t in ("ab", "ba")])
    rest = rest.groupBy("id_a", "id_b", "n_a", "n_b", "r_a", "r_b").agg(F.count(F.lit(1)).alias("q")).where(possible(True))
    rest = rest.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    rest = materialize(rest.join(first_pairs, ["a", "b"], "left_anti"), "rest-pairs")
    components = label
    if rest.limit(1).count():
        components = connected_components(links.unionByName(verify(rest, sets)))

    named = classes.join(components, "id", "left").select(F.col("id").alias("cls"), "rep", F.coalesce("component", "id").alias("component"))
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(smallest, "component").select("cls", "component_id")
    return docs.join(named, "cls", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def jaccard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
