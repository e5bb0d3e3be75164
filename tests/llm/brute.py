"""Plain re-statements of the results' definitions, for small tables."""
import hashlib
import re
import zlib

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def joined(spans, kinds):
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted((s, kinds.index(k), k, e) for k, s, e in spans))


def secrets(text):
    text = text or ""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def pii(text):
    text = text or ""
    out = [("email", m.start(), m.end()) for m in
           re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, k=5):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))}


def components(docs):
    """docs: list of (id, text) -> {id: component}, exact, by all pairs over shared shingles."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    ids = sorted(sets)
    by = {}
    for i in ids:
        for s in sets[i]:
            by.setdefault(s, []).append(i)
    seen = set()
    for group in by.values():
        for a in range(len(group)):
            for b in range(a + 1, len(group)):
                p = (group[a], group[b])
                if p in seen or find(p[0]) == find(p[1]):
                    continue
                seen.add(p)
                x, y = sets[p[0]], sets[p[1]]
                inter = len(x & y)
                if 100 * inter >= 75 * (len(x) + len(y) - inter):
                    a_, b_ = find(p[0]), find(p[1])
                    parent[max(a_, b_)] = min(a_, b_)
    return {i: find(i) for i in ids}


def crc_mod(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m
