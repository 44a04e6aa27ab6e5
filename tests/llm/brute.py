"""Plain Python versions of the operators, written from their definitions, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACE = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def contamination(docs, items, window=13, one_in=20):
    """[(n_words, n_hit, sorted item ids, contaminated)] of texts; items: [(id, text)]."""
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    split = lambda t: word.findall((t or "").translate(LOWER))
    windows = defaultdict(set)
    for i, t in items:
        w = split(t)
        k = min(window, len(w))
        for p in range(len(w) - k + 1) if w else []:
            windows[tuple(w[p:p + k])].add(i)
    sizes = {len(k) for k in windows}
    out = []
    for t in docs:
        w, hit, found = split(t), set(), set()
        for k in sizes:
            for p in range(len(w) - k + 1):
                ids = windows.get(tuple(w[p:p + k]))
                if ids:
                    hit.update(range(p, p + k))
                    found |= ids
        ids = sorted(str(i) for i in found if i is not None)
        out.append((len(w), len(hit), ids, len(hit) > 0 and one_in * len(hit) >= len(w)))
    return out


def fingerprint(t, n=3):
    w = SPACE.findall((t or "").translate(LOWER))
    if not w:
        return 0
    parts = [" ".join(w)] if len(w) < n else [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def component_roots(fps, distance=3):
    label = list(range(len(fps)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                label[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def component_ids(ids, fps, distance=3):
    roots, least = component_roots(fps, distance), {}
    for r, d in zip(roots, ids, strict=True):
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [least.get(r) for r in roots]


def repeats(texts, window=35):
    """[(n_words, n_removed, kept text)]"""
    words = [SPACE.findall(t or "") for t in texts]
    count = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def personal(t):
    """{kind: [(start, end)]} of the fixed kinds."""
    t = t or ""
    pats = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def ok(kind, m):
        d = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(x) <= 255 for x in m.split("."))
        if kind == "card":
            total = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d)))
            return 14 <= len(d) <= 19 and total % 10 == 0
        return kind == "email" or 10 <= len(d) <= 15

    return {k: [m.span() for m in re.finditer(p, t) if ok(k, m.group())] for k, p in pats.items()}


def personal_row(t):
    found = personal(t)
    spans = sorted((s, i, k, e) for i, (k, v) in enumerate(found.items()) for s, e in v)
    return (*(len(found[k]) for k in ("email", "ip", "card", "phone")), ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans))


def nearest(ids, vectors, every=20, k=20):
    out = {}
    x = np.array(vectors, np.float64)
    for i, q in zip(ids, x, strict=True):
        if i % every == 0:
            s = (x * q).sum(axis=1)
            out[i] = sorted(((-v, j) for v, j in zip(s, ids, strict=True) if j != i))[:k]
    return out
