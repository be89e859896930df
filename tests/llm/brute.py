"""Brute-force versions of the operators, straight from their definitions, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import defaultdict

SPACE = re.compile(rb"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def substring_dedup(rows, window=13):
    """rows: (doc_id, text); one (doc_id, n_words, n_removed, kept) each."""
    words = [(d, [w.decode() for w in SPACE.findall((t or "").encode())]) for d, t in rows]
    least = {}
    for d, w in words:
        if d is None:
            continue
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            least[key] = min(least.get(key, d), d)
    out = []
    for d, w in words:
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            if d is not None and least[tuple(w[i : i + window])] < d:
                keep[i : i + window] = [False] * window
        kept = [x for x, k in zip(w, keep) if k]
        out.append((d, len(w), len(w) - len(kept), " ".join(kept)))
    return out


def contamination(rows, items, window=10):
    """One (doc_id, n_words, n_hit, item ids) per row."""
    windows = defaultdict(set)
    for item, text in items:
        w = SYMBOL.findall(ascii_lower(text or ""))
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[i : i + size])].add(item)
    sizes = sorted({len(k) for k in windows})
    out = []
    for d, text in rows:
        w = SYMBOL.findall(ascii_lower(text or ""))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                key = tuple(w[i : i + size])
                if key in windows:
                    hit.update(range(i, i + size))
                    found |= windows[key]
        out.append((d, len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return out


def secrets(text):
    """(start, kind number, end) of the base spans."""
    text = text or ""
    names = r"(password|passwd|secret|token|api_?key)"
    names = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in names)
    out = []
    for m in re.finditer(names + r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 18:
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 16:
            out.append((m.start(), 2, m.end()))
    return sorted(out)


def shingle_set(text, size=5):
    w = [x.decode() for x in SPACE.findall(ascii_lower(text or "").encode())]
    if not w:
        return set()
    if len(w) < size:
        return {tuple(w)}
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def jaccard_components(rows, size=5, percent=75):
    """One (doc_id, n_shingles, component_id) per row."""
    sets = [shingle_set(t, size) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in holders[x]:
                if j < i:
                    common[j] += 1
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)]


def top_k(rows, is_query, k=20, scale=64):
    """(query_id, rank, vec_id, score)."""
    good = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, [math.floor(scale * float(x)) for x in v]))
    out = set()
    for q, v in good:
        if not is_query(q):
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(w) == len(v))[:k]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)}
    return out


WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def line_words(line):
    n = len(WORD.findall(line))
    return max(n, len(line) // 10) if n else 0


def line_dedup(rows, run_words=8):
    """(doc_id, lines removed, text): every run of lines of enough words that occurs before goes, whichever way it is found.

    ``rows``: (doc_id, order key, text). All runs of all documents are compared; lines without words are passed over, and go between two that go.
    """
    docs = {}
    for d, key, text in rows:
        lines = (text or "").split("\n")
        docs[(d is not None, d or 0, key)] = [(i, x, line_words(x)) for i, x in enumerate(lines) if line_words(x)]
    seen, deleted = set(), defaultdict(set)
    for doc in sorted(docs):
        lines = docs[doc]
        for a in range(len(lines)):
            run, words = [], 0
            for z in range(a, len(lines)):
                run.append(lines[z][1])
                words += lines[z][2]
                if words >= run_words:
                    if tuple(run) not in seen:
                        seen.add(tuple(run))
                        if len(run) > 40:
                            break
                        continue
                    deleted[doc] |= {i for i, _, _ in lines[a : z + 1]}
        for (p, _, _), (q, _, _) in zip(lines, lines[1:]):
            if p in deleted[doc] and q in deleted[doc]:
                deleted[doc] |= set(range(p, q))
    out = []
    for d, key, text in rows:
        gone = deleted[(d is not None, d or 0, key)]
        left = [x for i, x in enumerate((text or "").split("\n")) if i not in gone]
        out.append((d, len(gone), text if not gone else "\n".join(left)))
    return out


def pieces(ids_of, text, capacity=2048):
    """(piece, start, length, crc32) of a document."""
    ids = [*ids_of(text or ""), 0]
    edges = [0, len(ids) % capacity or capacity] if len(ids) > capacity else [0, len(ids)]
    while edges[-1] < len(ids):
        edges.append(edges[-1] + capacity)
    out = []
    for k, (a, z) in enumerate(zip(edges, edges[1:])):
        out.append((k, a, z - a, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[a:z]))))
    return out
