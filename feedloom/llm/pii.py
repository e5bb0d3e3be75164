"""Personal data with offset-preserving deobfuscation (operator 4).

The base detectors run on the text itself.  Then a chain of transducers rewrites the text and carries,
for every character it emits, the source range it stands for: look-alike and wide characters become
ASCII, invisible ones go, spelled digits become digits, at and dot disguises become signs.  The same
detectors run on the result; their spans are mapped back through the ranges and added unless a base span
of that kind covers them: one that only reaches further (the base found the tail of an address) is added
beside the base span.  A text without any disguise passes the chain unread.

Spelled digits, alone or mixed with written groups and with "dot", are rewritten one by one: gaps between
single digits go, those beside longer groups stay as written, and the detectors decide what the run is.  Nine
or more single digits with seven or more spelled count as a phone number even without a plus.  Digits are spelled in
English, German, French or Spanish; a run of one word repeated is no number.  A bare "at"
counts only with bare or bracketed "dot" after it, so prose stays as it is.

Defined results: NULL or empty text has no spans; rows that repeat an id are scanned on their own; an
empty table gives an empty result; other columns are ignored.  Every scan is linear in the text.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import table

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: Every ip, card and phone match lies inside one such run.
NUMERIC = re.compile(r"[+0-9][\x20().+0-9-]{6,}")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile("[^0-9]")

# Characters that look like ASCII ones, by the ASCII character.
LOOK_ALIKES = {
    "a": "аαɑ", "b": "Ьƅ", "c": "сϲ", "d": "ԁ", "e": "еҽ", "g": "ɡ", "h": "һ", "i": "іι", "j": "ј", "k": "κ",
    "l": "ӏ", "m": "м", "n": "ո", "o": "оοօ", "p": "рρ", "q": "ԛ", "r": "г", "s": "ѕ", "t": "т", "u": "υս",
    "v": "ѵν", "w": "ԝ", "x": "хχ", "y": "уγ", "A": "АΑ", "B": "ВΒ", "C": "С", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ",
    "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ", "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "ҮΥ",
    "Z": "Ζ", "-": "‐‑‒–—−", ".": "․。", "@": "﹫", " ": "      　",
}
INVISIBLE = "­​‌‍⁠﻿"
# Digits spelled in the languages of the texts, 0 to 9.
DIGIT_WORDS = {
    "en": ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine"),
    "de": ("null", "eins", "zwei", "drei", "vier", "fünf", "sechs", "sieben", "acht", "neun"),
    "fr": ("zéro", "un", "deux", "trois", "quatre", "cinq", "six", "sept", "huit", "neuf"),
    "es": ("cero", "uno", "dos", "tres", "cuatro", "cinco", "seis", "siete", "ocho", "nueve"),
}
#: The digit of each word, "oh" included.
WORD_DIGIT = {"oh": "0"} | {w: str(d) for words in DIGIT_WORDS.values() for d, w in enumerate(words)}


def fold_map() -> dict[int, str]:
    fold = {ord(c): a for a, cs in LOOK_ALIKES.items() for c in cs}
    fold |= {c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
    # Decimal digits of any script; mathematical digits are among them.
    for c in (*range(0x660, 0x1100), *range(0x1D7CE, 0x1D800)):
        if (d := unicodedata.decimal(chr(c), None)) is not None:
            fold[c] = str(d)
    return fold


FOLD = fold_map()
STRANGE = re.compile("[" + "".join(map(re.escape, map(chr, FOLD))) + INVISIBLE + "]")
HIDDEN = re.compile(f"[{INVISIBLE}]")
_WORD = rf"(?:{'|'.join(WORD_DIGIT)})(?!\w)"
_GROUP = rf"(?:{_WORD}|[0-9]++(?![A-Za-z]))"
_GAP = r"(?:\s{1,2}(?:dot|punkt|point|punto)\s{1,2}|[\s,.()-]{1,3})"
SPELLED = re.compile(rf"(?<!\w)(?:plus[\s-]+|\+\s?)?{_GROUP}(?:{_GAP}{_GROUP})+", re.I)
SPELLED_PART = re.compile(rf"(plus[\s-]+|\+\s?)|(\s{{1,2}}(?:dot|punkt|point|punto)\s{{1,2}})|({_WORD})|([0-9]+)|([\s,.()-]+)", re.I)
SPELLED_HINT = re.compile(rf"(?<!\w)(?:{_WORD}{_GAP}{_GROUP}|[0-9]++{_GAP}{_WORD})", re.I)
DISGUISE_HINT = re.compile(r"[\[({<]\s?(?:at|dot|@|\.|punkt|point|punto|arroba)\s?[\])}>]|\sdot\s", re.I)
_AT = r"\s{0,2}[\[({<]\s?(?:at|@|arroba)\s?[\])}>]\s{0,2}"
_DOT = r"(?:\s{0,2}[\[({<]\s?(?:dot|\.|punkt|point|punto)\s?[\])}>]\s{0,2}|\s{1,2}dot\s{1,2})"
DISGUISED = re.compile(
    rf"(?<![A-Za-z0-9%+-])[A-Za-z0-9._%+-]{{1,64}}(?:(?:{_DOT})[A-Za-z0-9_%+-]{{1,64}}){{0,4}}"
    rf"(?:(?:{_AT}|@)[A-Za-z0-9-]{{1,63}}(?:(?:{_DOT}|\.)[A-Za-z0-9-]{{1,63}}){{1,6}}"
    rf"|\s{{1,2}}at\s{{1,2}}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,6}})", re.I)
_SIGN = re.compile(rf"({_AT}|\s{{1,2}}at\s{{1,2}})|({_DOT})", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def detect(text: str) -> list[tuple[int, int, int]]:
    """Base spans (kind number, start, end)."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at)):
            out.append((0, start, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", done)
    for run in NUMERIC.finditer(text):
        s, off = run[0], run.start()
        if s.count(".") >= 3:
            for m in IP.finditer(s):
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                    out.append((1, off + m.start(), off + m.end()))
        for m in CARD.finditer(s):
            if len(m[0]) >= 12 and 12 <= len(d := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
                out.append((2, off + m.start(), off + m.end()))
        if "+" in s:
            for m in PHONE.finditer(s):
                if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                    out.append((3, off + m.start(), off + m.end()))
    return out


class Tape:
    """A rewritten text and the source range behind each of its characters."""

    def __init__(self, text: str):
        self.text = text
        self.start, self.end = np.arange(len(text)), np.arange(1, len(text) + 1)

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace ranges (ascending, apart); each new character stands for its whole old range."""
        if not edits:
            return
        pieces, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            pieces += [self.text[at:a], new]
            starts += [self.start[at:a], np.full(len(new), self.start[a])]
            ends += [self.end[at:a], np.full(len(new), self.end[b - 1])]
            at = b
        self.text = "".join([*pieces, self.text[at:]])
        self.start = np.concatenate([*starts, self.start[at:]])
        self.end = np.concatenate([*ends, self.end[at:]])


def spelled(m: re.Match) -> list[tuple[int, int, str]]:
    """Edits that make a run of spelled and written digits a written one; none where no digit is spelled."""
    parts = [(p.lastindex, p[0], m.start() + p.start(), m.start() + p.end()) for p in SPELLED_PART.finditer(m[0])]
    if len({text.lower() for what, text, *_ in parts if what in (3, 4)}) < 2 or not any(what == 3 for what, *_ in parts):
        return []  # nothing spelled, or one word over and over ("null, null, null")
    new = ["+" if what == 1 else "." if what == 2 or text == "." else WORD_DIGIT.get(text.lower(), text) for what, text, *_ in parts]
    octets = "".join(n if n == "." or what in (3, 4) else "" for n, (what, *_) in zip(new, parts)).split(".")
    ip = len(octets) == 4 and all(0 < len(o) <= 3 and int(o) <= 255 for o in octets)
    single = [what in (3, 4) and len(n) == 1 for n, (what, *_) in zip(new, parts)]
    run: list[int] = []
    for i, (what, text, _, _) in enumerate(parts):
        if single[i]:
            run.append(i)
        if what == 5 and 0 < i and single[i - 1] and single[i + 1]:
            new[i] = "." if ip and text == "." else ""
        elif what == 4 and not single[i] or i == len(parts) - 1:
            # The digits of one run: a phone number without a sign.
            digits = "".join(new[k] for k in run)
            if parts[0][0] != 1 and len(digits) >= 9 and sum(parts[k][0] == 3 for k in run) >= 7 and not (
                    len(digits) >= 12 and luhn(digits)):
                new[run[0]] = "+" + new[run[0]]
            run = []
    return [(a, b, n) for n, (_, text, a, b) in zip(new, parts) if n != text]


def added(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that only the deobfuscated text shows, in source characters."""
    strange = not text.isascii() and STRANGE.search(text)
    if not (strange or DISGUISE_HINT.search(text) or SPELLED_HINT.search(text)):
        return []
    tape, found = Tape(text), []
    if strange:
        tape.rewrite([(m.start(), m.end(), "") for m in HIDDEN.finditer(text)])
        tape.text = tape.text.translate(FOLD)
    edits = []
    for m in SPELLED.finditer(tape.text):
        edits += spelled(m)
    tape.rewrite(edits)
    edits = []
    for m in DISGUISED.finditer(tape.text):
        for s in _SIGN.finditer(m[0]):
            edits.append((m.start() + s.start(), m.start() + s.end(), "@" if s[1] else "."))
    tape.rewrite(edits)
    covers = [sorted((x, y) for k, x, y in base if k == kind) for kind in range(len(KINDS))]
    at, reach = [0] * len(KINDS), [-1] * len(KINDS)
    for s, kind, e in sorted({(int(tape.start[a]), kind, int(tape.end[b - 1])) for kind, a, b in detect(tape.text)}):
        spans = covers[kind]
        while at[kind] < len(spans) and spans[at[kind]][0] <= s:
            reach[kind] = max(reach[kind], spans[at[kind]][1])
            at[kind] += 1
        if e > reach[kind]:
            found.append((kind, s, e))
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted((s, k, e) for k, s, e in spans))


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: base counts by kind, digest of the base spans, all spans, number of added spans."""
    kind = dict(df.dtypes)[id_col]

    def run(batches):
        import pandas as pd
        for pdf in batches:
            rows = []
            for t in pdf["t"]:
                base = detect(t)
                more = added(t, base)
                n = [0, 0, 0, 0]
                for k, _, _ in base:
                    n[k] += 1
                rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more), len(more)))
            out = pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])
            out.insert(0, "id", pdf["id"].to_numpy())
            yield out

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return rows.mapInPandas(run, f"id {kind}, {counts}, base_sha256 string, spans string, n_added long").withColumnRenamed("id", id_col)


def pii_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
