import hashlib
import random
import zlib

import duckdb
import pytest

from feedloom.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def frame(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lowered(text):
    return text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def tree(nodes):
    """nodes -> (root, path of each node: a list of (left, right))."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run = a // 8 * 8
            paths[i].append((nodes[run:a], nodes[a + 1:run + 8]))
            at[i] = a // 8
        nodes = [h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def plain(rows):
    """rows: (doc_id, source, lang, n_chars, text) -> the manifest's rows."""
    groups = {}
    for r in rows:
        leaf = h(*map(frame, r))
        tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf, r[0], h(*map(frame, (*r[:4], lowered(r[4])))) if tampered else leaf))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g])]) for g in langs}
    if not langs:
        return []
    root, tops = tree([trees[g][0] for g in langs])
    out = []
    for g, top in zip(langs, tops):
        for x, path in zip(sorted(groups[g]), trees[g][1]):
            f, proof = x[4], []
            for left, right in path + top:
                f = h(*left, f, *right)
                proof += left + right
            out.append((x[3], x[2], trees[g][0], root, h(*proof), f, f == root))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x) for x in r))


def table_of(sizes, seed=3):
    rnd, rows = random.Random(seed), []
    for lang, n in sizes:
        for _ in range(n):
            text = rnd.choice([None, "", "Ünïcode Text", "lower only", "MIXED case " * rnd.randrange(5)])
            rows.append((rnd.randrange(100_000), rnd.choice([None, "s1", "s2"]), lang, rnd.choice([None, 5]), text))
    return rows


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("sizes", [[("en", 1)], [("en", 8), ("de", 9), (None, 65)], [(f"l{i}", 1 + i % 3) for i in range(70)],
                                   [("en", 600), ("", 64), ("é", 1), ("zz", 513)]])
def test_against_plain_trees(spark, sizes, monkeypatch):
    monkeypatch.setattr(merkle, "WINDOW", 64)  # several windows a group
    rows = table_of(sizes)
    rows += [rows[0]] * 20 + [(None, "s", "en", 3, "No Id"), (None, "s", "en", 3, "No Id"), (None,) * 5, (7, "s", "en", 1, "X" * 200_000)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, 0, "x", "y") for r in rows], SCHEMA + ", idx long, h string, path string").repartition(5)
    assert ordered(merkle.manifest(df).collect()) == ordered(plain(rows))


def test_single_row_is_its_own_root(spark):
    row = (4, "s", "en", 2, "hi")
    got = merkle.manifest(spark.createDataFrame([row], SCHEMA)).first()
    assert got.leaf == got.subroot == got.root and got.proof_sha256 == h() and tuple(got) == plain([row])[0]


def test_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sql_agrees_with_plain_trees():
    rows = table_of([("en", 130), (None, 9), ("de", 1)])
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, lang VARCHAR, n_chars BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    got = con.execute(merkle.merkle_sql(4)).fetchall()
    assert ordered(got) == ordered(plain(rows))


def test_tampering_shows(spark):
    rows = [(i, "s", "en", 3, "Upper") for i in range(40)]
    got = {r.doc_id: r.verified for r in merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 3 != 0 for i in range(40)}
