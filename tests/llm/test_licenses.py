"""License lines, licence files and inheritance."""
import re

from feedloom.llm import licenses
from feedloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_license_line_is_found_and_clean_texts_are_not(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in QUERIES["op9_licenses"](spark, SF).collect()}
    assert set(rows) == set(docs)
    has = {i for i, t in docs.items() if re.search("Licensed under|Released under|is licensed under", t)}
    assert {i for i, r in rows.items() if r.own_license} == has
    for i in has:
        assert "icense" in docs[i][rows[i].start:rows[i].end]


def test_nearest_ancestor_and_odd_rows(spark):
    apache, mit = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."
    rows = [(1, apache, "a", None), (2, "plain words", "a", "b"), (3, mit, "a", "b"), (4, "x\n" + mit + "\n" + "other words here " * 50, "c", "d"),
            (5, None, "c", "d"), (6, "", "e/f", None), (None, "words", "a", "z"), (2, "plain words", "a", "b")]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, source string, lang string, start double")
    # The root licence stands in /a itself.
    top = licenses.scan(df.where("doc_id = 1"), dir_cols=("source",)).first()
    assert (top.directory, top.license, top.is_license_file) == ("/a", "Apache-2.0", True)
    got = sorted(((r.doc_id or 0, r.license, r.inherited_from) for r in licenses.scan(df).collect()), key=str)
    want = [(0, None, None), (1, "Apache-2.0", None), (2, "MIT", "/a/b"), (2, "MIT", "/a/b"), (3, "MIT", None), (4, "MIT", None), (5, None, None), (6, None, None)]
    assert got == sorted(want, key=str)
    assert licenses.scan(df.limit(0)).count() == 0


def plain_cosine(texts, templates):
    """For every text, its TF-IDF cosine to every template, from the definition."""
    from collections import Counter
    from math import log, sqrt
    word = lambda t: re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", t.lower())
    known = {w for _, t in templates for w in word(t)}
    df = Counter(w for t in texts for w in set(word(t)) & known)
    idf = lambda w: log((len(texts) + 1) / (df.get(w, 0) + 1)) + 1

    def vector(t):
        v = {x: (1 + log(n)) * idf(x) for x, n in Counter(word(t)).items()}
        size = sqrt(sum(x * x for x in v.values()))
        return {k: x / size for k, x in v.items()}
    sides = [(n, vector(t)) for n, t in templates]
    return [[(sum(x * v[w] for w, x in side.items() if w in v), n) for n, side in sides] for v in map(vector, texts)]


def test_whole_licence_texts_against_plain_cosine(spark):
    """Every stated and stored licence text is found under its own name, with edited copyright lines too."""
    files = licenses.file_templates()
    texts = [t for ts in files.values() for t in ts] + [
        re.sub(r"(?im)^(.*copyright.*)$", "Copyright 2031 Some One, all over again", t, count=1) for ts in files.values() for t in ts]
    names = [n for n, ts in files.items() for _ in ts] * 2
    rows = [(i, t, f"dir{i}", None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    templates = [(n, t) for s in (licenses.header_templates(), files) for n, ts in s.items() for t in ts]
    for i, scores in enumerate(plain_cosine(texts, templates)):
        top = max(s for s, _ in scores)
        assert names[i] in {n for s, n in scores if s > top - 1e-9}
        assert got[i].is_license_file and got[i].license == names[i] and top > 0.8


def test_headers_spdx_lines_and_inheritance_from_a_licence_file(spark):
    apache = "\n".join(["# Licensed under the Apache License, Version 2.0 (the \"License\");", "# you may not use this file except in",
                        "# compliance with the License."])
    rows = [(1, "code\n\n" + apache + "\n\n" + " ".join(f"name{i} = call{i}(arg{i})" for i in range(80)), "s", "x"), (2, "// SPDX-License-Identifier: MIT\nint main;", "s", "x"),
            (3, "SPDX-License-Identifier: GPL-2.0-or-later", "s", "x"), (4, licenses.TEXTS["ISC"], "t", None), (5, "no words on it", "t", "y"),
            (6, licenses.TEXTS["ISC"], "u", None), (7, licenses.TEXTS["MIT"], "u", None), (8, "plain", "u", "v"), (9, "long words " * 60_000, "w", None)]
    rows += [(100 + i, f"filler text number {i} of the house", "z", None) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert [got[i].license for i in (1, 2, 3)] == ["Apache-2.0", "MIT", "GPL-2.0"]
    assert got[5].license is None and got[8].license is None  # /t/y and /u/v do not lie below /t/_ and /u/_
    top = licenses.scan(df.select("doc_id", "text", "source"), dir_cols=("source",)).collect()
    assert {(r.license, r.inherited_from) for r in top if r.directory == "/t"} == {("ISC", None), ("ISC", "/t")}
    # Two licence files in one directory: the best score, then the smallest id.
    both = [r for r in top if r.directory == "/u"]
    best = max((r for r in both if r.is_license_file), key=lambda r: (r.doc_id == 6))
    assert {r.license for r in both if r.doc_id == 8} <= {"ISC", "MIT"} and best.license == "ISC"
    assert all(got[100 + i].license is None for i in range(60)) and got[9].license is None
    assert not got[1].is_license_file and got[4].is_license_file
