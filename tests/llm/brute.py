"""Plain versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def near_docs(docs, percent):
    """``{doc_id: (n_shingles, component)}``"""
    sets = {i: shingles(t) for i, t in docs}
    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    links = []
    for i, s in sets.items():
        common = Counter(j for x in s for j in where[x] if j < i)
        links += [(i, j) for j, c in common.items() if 100 * c >= percent * (len(s) + len(sets[j]) - c)]
    comp = components(sets, links)
    return {i: (len(sets[i]), comp[i]) for i in sets}


def repeats(docs, length=50):
    """``{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}``"""
    first = {}
    data = {i: (t or "").encode() for i, t in docs}
    for i, b in data.items():
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            first[w] = min(first.get(w, i), i)
    out = {}
    for i, b in data.items():
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < i:
                gone[p:p + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def near_vectors(rows, threshold):
    """``{vec_id: (n_links, component)}`` of ``(vec_id, vector, label)`` rows."""
    ok = [(i, np.array(v, float), l) for i, v, l in rows
          if l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = [(a[0], b[0]) for n, a in enumerate(ok) for b in ok[:n]
             if a[2] == b[2] and len(a[1]) == len(b[1])
             and a[1] @ b[1] / np.linalg.norm(a[1]) / np.linalg.norm(b[1]) >= threshold]
    n = Counter(x for pair in links for x in pair)
    comp = components([r[0] for r in rows], links)
    return {r[0]: (n[r[0]], comp[r[0]]) for r in rows}


BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.IGNORECASE | re.ASCII), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}


def base_spans(text):
    found = [(m.start(), n, m.end(), kind) for n, (kind, (rx, group, least)) in enumerate(BASE.items())
             for m in rx.finditer(text or "") if len(m.group(group)) >= least]
    return [(kind, a, b) for a, _, b, kind in sorted(found)]
