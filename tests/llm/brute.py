"""Plain one-machine versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

UP, DOWN = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER = str.maketrans(UP, DOWN)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

ENDS = " \t\n\x0b\x0c\r"  # white space that does not count at the ends of a line


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def license_places(text):
    words = ALNUM.findall((text or "").translate(LOWER))
    found = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    starts = [i for i, _ in found]
    return (
        len(words), len(found), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({x for _, x in found})),
    )


def template_labels(text, templates, names, threshold=0.8):
    """Labels by comparing every window (twice the template's words, a quarter of that apart) with its template."""
    out = {}
    words = ALNUM.findall((text or "").translate(LOWER))
    for label, template in templates.items():
        t, span = set(template.split()), 2 * len(template.split())
        start = 0
        while True:
            own = set(words[start : start + span])
            both = len(own & t)
            if both >= -int(-len(t) * threshold // 1) and own.issuperset(names.get(label, "").split()):
                out[label] = max(out.get(label, 0), both / len(t))
            if start + span >= len(words):
                break
            start += max(1, span // 4)
    return out


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset([tuple(words)])


def near_duplicates(docs):
    """doc_id -> (set size, component) over all pairs."""
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            by[x].append(d)
    shared = Counter()
    for ids in by.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def repeated_words(docs, window=20):
    """doc_id -> (words, removed, digest of the rest)."""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            w = tuple(words[i : i + window])
            if w in seen:
                gone[i : i + window] = [True] * window
            seen.add(w)
        rest = [w for w, g in zip(words, gone) if not g]
        out[doc] = (len(words), len(words) - len(rest), sha(" ".join(rest)))
    return out


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


# The kinds besides the base, in order.
OWN_KINDS = {
    "key_block": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "host_token": r"(?<![A-Za-z0-9_])gh[pousr]_[A-Za-z0-9]{36,}",
    "web_token": r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
}


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    kinds = ["assign", "access", "hex"]
    n = Counter(k for _, k, _ in found)
    joined = lambda some: ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(some))
    base = sha(joined(found))
    for k, pattern in enumerate(OWN_KINDS.values(), 3):
        kinds.append(list(OWN_KINDS)[k - 3])
        found += [(m.start(), k, m.end()) for m in re.finditer(pattern, text)]
    return (n[0], n[1], n[2], base, joined(found))


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 5))
    n = len(words)
    return (
        n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered),
        n < 10 or 100 * len(covered) > 20 * n,
    )


def boilerplate(docs, sites):
    """doc_id -> (lines, removed, text); docs are (id, text, site); the first place stays."""
    held, first = defaultdict(set), {}
    for d, text, site in sorted(docs, key=lambda x: x[0]):
        for at, line in enumerate((text or "").split("\n") if text is not None else []):
            if key := line.strip(ENDS):
                held[key].add(site or "")
                first.setdefault(key, (d, at))
    out = {}
    for d, text, _ in docs:
        if text is None:
            out[d] = (0, 0, None)
            continue
        lines = text.split("\n")
        keep = [
            x for at, x in enumerate(lines)
            if not x.strip(ENDS) or len(held[x.strip(ENDS)]) < sites or first[x.strip(ENDS)] == (d, at)
        ]
        out[d] = (len(lines), len(lines) - len(keep), "\n".join(keep))
    return out


def nearest(rows, queries, k):
    """(query, rank) -> (id, score) over all pairs."""
    good = [
        (i, np.array(v, dtype=np.float64)) for i, v in rows
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    out = {}
    for q, x in good:
        if queries(q):
            scored = sorted((-float((x * y).sum()), i) for i, y in good if i != q and len(y) == len(x))
            for rank, (s, i) in enumerate(scored[:k], 1):
                out[q, rank] = (i, -s)
    return out


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())
