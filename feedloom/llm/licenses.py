"""License scan: TF-IDF cosine to templates, then inheritance from the nearest ancestor directory (operator 9).

There are two sets of templates: headers (standard notices and SPDX lines, stated here) and licence files
(whole texts: short ones stated here, long ones read from a folder that is a parameter).  Texts, lines and
templates are sparse TF-IDF vectors of one tokeniser; document frequencies of the templates' terms are
counted over the whole corpus.  Every sentence, line and paragraph is compared with the headers and every
whole text with both sets.  A document whose whole text reaches ``file_level`` is a licence file and sets
its directory's licence.  Documents without an own licence take that of the nearest directory above:
each distinct directory's ancestors are joined by path to the directories with a licence, the deepest
wins, and the result is joined back to the documents.

Units that can't reach ``header_level`` are left out exactly: the terms of a template that a unit shares must hold
``level ** 2`` of its squared weight, so the unit holds one of the terms that remain when the most common ones
short of that share are taken away.  Only units with such a term are compared.

Defined results: NULL or empty text has no own licence; a NULL path part is ``_``; equal scores go to
the first template by name; several licence files in a directory: the best score, then the smallest id;
repeated rows are scanned on their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import os
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import materialize, share, shared_value, table, tidy

#: Folder of whole licence texts, one a file, read by the driver; without it only the texts stated here are known.
LICENSE_DIR = "/usr/share/common-licenses"

# Standard notices by SPDX identifier.
HEADERS = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "GPL-2.0": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."],
    "LGPL-2.1": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                 "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "MIT": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}
# Identifiers of SPDX lines.
SPDX = ["AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1",
        "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense"]
# Whole texts of short licences.
TEXTS = {
    "ISC": """ISC License. Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE
AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE,
DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE.""",
    "MIT": """MIT License. Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
}
WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")
#: Paragraphs, lines and sentences end here.
BREAKS = [re.compile(r"\n[^\w\n]*\n"), re.compile(r"\n"), re.compile(r"(?<=[.;:])\s")]


def header_templates() -> dict[str, list[str]]:
    """Notices and SPDX lines by identifier."""
    out = {n: list(ts) for n, ts in HEADERS.items()}
    for n in SPDX:
        ends = ("", "-only", "-or-later") if "GPL" in n else ("",)
        out.setdefault(n, []).extend(f"SPDX-License-Identifier: {n}{e}" for e in ends)
    return out


def file_templates(folder: str = LICENSE_DIR) -> dict[str, list[str]]:
    """Whole licence texts by identifier: those stated here and those of a folder (links to other files left out)."""
    out = {n: [t] for n, t in TEXTS.items()}
    for name in sorted(os.listdir(folder)) if os.path.isdir(folder) else []:
        path = os.path.join(folder, name)
        if os.path.isfile(path) and not os.path.islink(path):
            with open(path, encoding="utf-8", errors="replace") as f:
                known = "BSD-3-Clause" if name == "BSD" else re.sub(r"-(\d+)$", r"-\1.0", name)
                out.setdefault(known, []).append(f.read())
    return out


def terms(text: str) -> Counter:
    return Counter(WORD.findall(text.lower()))


class Matcher:
    """Cosine of a text to each template; terms no template has weigh as the rarest."""

    def __init__(self, headers: dict[str, list[str]], files: dict[str, list[str]], df: dict[str, int], total: int, level: float):
        self.idf = {t: math.log((total + 1) / (n + 1)) + 1 for t, n in df.items()}
        self.most = math.log(total + 1) + 1
        self.place = {t: i for i, t in enumerate(sorted(df))}
        made = sorted([(n, 0, t) for n, ts in headers.items() for t in ts] + [(n, 1, t) for n, ts in files.items() for t in ts])
        self.names = [n for n, _, _ in made]
        self.header = np.array([k == 0 for _, k, _ in made], bool)
        self.weights = np.zeros((len(self.place), len(made)))
        gate: set[str] = set()
        for j, (_, kind, text) in enumerate(made):
            v = self.vector(terms(text))
            size = math.sqrt(sum(x * x for x in v.values()))
            for t, x in v.items():
                self.weights[self.place[t], j] = x / size
            if not kind:
                spare = level * level * size * size * (1 - 1e-9)
                for t in sorted(v, key=lambda t: (self.idf[t], t)):  # the most common terms are taken away first
                    spare -= v[t] * v[t]
                    if spare <= 0:
                        gate.add(t)
        self.gate = frozenset(gate)

    def vector(self, tf: Counter) -> dict[str, float]:
        return {t: (1 + math.log(n)) * self.idf.get(t, self.most) for t, n in tf.items()}

    def scores(self, tf: Counter) -> np.ndarray:
        v = self.vector(tf)
        own = [t for t in v if t in self.place]
        if not own:
            return np.zeros(len(self.names))
        norm = math.sqrt(sum(x * x for x in v.values()))
        return np.array([v[t] for t in own]) @ self.weights[[self.place[t] for t in own]] / norm

    def best(self, tf: Counter, headers: bool = False) -> tuple[float, str]:
        """Highest score and its template's name, of the headers only or of all templates."""
        s = np.round(self.scores(tf), 12)
        if headers:
            s = np.where(self.header, s, 0.0)
        j = int(s.argmax()) if len(s) else -1
        return (float(s[j]), self.names[j]) if j >= 0 and s[j] > 0 else (0.0, "")

    def header_unit(self, text: str) -> tuple[float, str, int, int]:
        """The sentence, line or paragraph nearest to a header: score, name, start and end."""
        top = (0.0, "", -1, -1)
        places = [m.start() for m in WORD.finditer(text.lower() if text.isascii() else "".join(c.lower() if c.isascii() else c for c in text))
                  if m[0] in self.gate]
        for rule in BREAKS:
            if not places:
                break
            cuts = [0, *(m.end() for m in rule.finditer(text)), len(text)]
            units = dict.fromkeys(int(i) for i in np.searchsorted(cuts, places, side="right"))
            for i in units:
                a, b = cuts[i - 1], cuts[i] if i < len(cuts) else len(text)
                score, name = self.best(terms(text[a:b]), headers=True)
                b = a + len(text[a:b].rstrip())
                if score > top[0] or (score == top[0] and (a, a - b) < (top[2], top[2] - top[3])):
                    top = (score, name, a, b)
        return top


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", dir_cols: tuple[str, ...] = ("source", "lang"),
         headers: dict[str, list[str]] | None = None, files: dict[str, list[str]] | None = None, header_level: float = 0.6,
         file_level: float = 0.6) -> DataFrame:
    """Per row: id, directory, own_license, own_score, start, end (code points of the unit), is_license_file,
    license (own, else inherited), inherited_from."""
    spark = df.sparkSession
    headers, files = headers or header_templates(), file_templates() if files is None else files
    kind = dict(df.dtypes)[id_col]
    vocabulary = sorted({t for set_ in (headers, files) for ts in set_.values() for x in ts for t in terms(x)})
    path = F.concat_ws("/", *[F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("_")), "/+", "_") for c in dir_cols])
    rows = df.select(F.col(id_col).alias("id"), F.concat(F.lit("/"), path).alias("dir"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))

    def frequencies(batches):
        import pandas as pd
        vocab, n = frozenset(vocabulary), Counter()
        for pdf in batches:
            n[""] += len(pdf)
            for t in pdf["t"]:
                n.update(vocab.intersection(WORD.findall(t.lower())))
        yield pd.DataFrame(list(n.items()), columns=["term", "n"])

    counted = {r.term: r.n for r in rows.select("t").mapInPandas(frequencies, "term string, n long")
               .groupBy("term").agg(F.sum("n").alias("n")).collect()}  # the templates' terms
    shared = share(spark, Matcher(headers, files, {t: counted.get(t, 0) for t in vocabulary}, counted.get("", 0), header_level))

    def run(batches):
        import pandas as pd
        match = shared_value(shared)
        for pdf in batches:
            out = []
            for t in pdf["t"]:
                whole, best = match.best(terms(t)), match.header_unit(t)
                own = best if best[0] >= header_level else (best[0], None, None, None)
                out.append((own[1], own[0], own[2], own[3], whole[0] >= file_level, whole[1] if whole[0] >= file_level else None, whole[0]))
            res = pd.DataFrame(out, columns=["own_license", "own_score", "start", "end", "is_license_file", "file_license", "file_score"])
            res.insert(0, "dir", pdf["dir"].to_numpy())
            res.insert(0, "id", pdf["id"].to_numpy())
            yield res

    own = materialize(rows.mapInPandas(tidy(run), f"id {kind}, dir string, own_license string, own_score double, start long, end long, "
                                            "is_license_file boolean, file_license string, file_score double"), "licenses")
    best = F.max_by("file_license", F.struct("file_score", F.negate(F.coalesce(F.col("id").cast("long"), F.lit(0)))))
    set_ = own.where("is_license_file").groupBy(F.col("dir").alias("up")).agg(best.alias("up_license"))
    dirs = own.select("dir").distinct()
    parts = F.split("dir", "/")
    ups = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(2), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).alias("up"))
    near = ups.join(set_, "up").groupBy("dir").agg(F.max_by(F.struct("up", "up_license"), F.length("up")).alias("near"))
    out = own.join(near, "dir", "left")
    mine = F.coalesce(F.col("file_license"), F.col("own_license"))  # a licence file is named by its whole text
    return out.select(F.col("id").alias(id_col), F.col("dir").alias("directory"), "own_license", "own_score", "start", "end", "is_license_file",
                      F.coalesce(mine, F.col("near.up_license")).alias("license"),
                      F.when(mine.isNull(), F.col("near.up")).alias("inherited_from"))


def license_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
