"""Plain single-process versions of the operators, for tests."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

from viewgrid.llm import textscan as ts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def substring(docs, length=20):
    """docs: [(doc_id, text)] with distinct ids -> {doc_id: (n_words, n_removed, sha256)}"""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            key = tuple(w[i : i + length])
            if key in seen:
                gone[i : i + length] = [True] * length
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[doc_id] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def shingles(text, k):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def near(docs, k=4, percent=80):
    """docs: [(doc_id, text)] with distinct ids -> {doc_id: (n_shingles, component_id, kept)}; every pair that shares a shingle."""
    sets = {d: shingles(t, k) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = {}
    for d in sorted(sets):
        near_ = {}
        for s in sets[d]:
            for e in where.setdefault(s, []):
                near_[e] = near_.get(e, 0) + 1
            where[s].append(d)
        for e, n in near_.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[e]) - n):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def base_rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = {}
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    n = len(w)
    return n, sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n


def contaminated(docs, items, k=5, percent=80):
    """{(doc_id, item_id): shared shingles} of every pair with enough containment."""
    out = {}
    sets = [(i, shingles(t, k)) for i, t in items]
    where = {}
    for i, s in sets:
        for x in s:
            where.setdefault(x, []).append(i)
    size = {i: len(s) for i, s in sets}
    for d, t in docs:
        n = {}
        for x in shingles(t, k):
            for i in where.get(x, ()):
                n[i] = n.get(i, 0) + 1
        out |= {(d, i): c for i, c in n.items() if 100 * c >= percent * size[i]}
    return out


def hard_negatives(rows, keep=5, low=80, high=100):
    """rows: [(vec_id, label, components)] -> sorted (anchor, positive, rank, negative, positive score, negative score); every pair."""
    have = [
        (k, label, [math.floor(256 * float(x)) for x in vec])
        for k, label, vec in rows
        if k is not None and label is not None and vec is not None and all(x is not None and math.isfinite(x) for x in vec)
    ]
    out = set()
    for a, label, v in have:
        if a % 100:
            continue
        scores = sorted((-sum(x * y for x, y in zip(v, w)), k, other) for k, other, w in have if k != a)
        positives = list(dict.fromkeys((-s, k) for s, k, other in scores if other == label))[:keep]
        for p, positive in positives:
            near = list(dict.fromkeys((-s, k) for s, k, other in scores if other != label and low * p <= -100 * s <= high * p))
            out |= {(a, positive, rank, k, p, s) for rank, (s, k) in enumerate(near[:keep], 1)}
    return sorted(out)


def features(text):
    """Words and joined neighbours, as importance resampling takes them."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def resampled(docs, target, percent=25, least_words=20):
    """{doc_id: (n_features, weight, score, rank, n_words)}"""

    def count(rows):
        return Counter(zlib.crc32(x.encode()) % 10_000 for _, t in rows for x in features(t))

    s, t = count(docs), count(target)
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000)))) for b in s}
    out = {}
    for d, text in docs:
        own = [gain[zlib.crc32(x.encode()) % 10_000] for x in features(text)]
        weight = sum(own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{d}".encode()).hexdigest()[:8], 16)
        score = None if d is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[d] = (len(own), weight, score, None, (len(own) + 1) // 2)
    able = sorted((-x[2], d) for d, x in out.items() if d is not None and x[4] >= least_words)
    for rank, (_, d) in enumerate(able[: percent * len(able) // 100], 1):
        out[d] = (*out[d][:3], rank, out[d][4])
    return out


def winnowed(text, gram=12):
    """[(position, hash)] of the rightmost smallest gram of every window."""
    if not text:
        return []
    points = np.array([ord(c) + 1 for c in text], ts.U)
    size = min(gram, len(text))
    hashes = [int(ts.run_hashes(points[i : i + size], size)[0]) for i in range(len(text) - size + 1)]
    window = 4
    while window < 64 and 32 * window <= len(hashes):
        window *= 2
    window = min(window, len(hashes))
    places = {max(range(i, i + window), key=lambda j: (-hashes[j], j)) for i in range(len(hashes) - window + 1)}
    return [(j, hashes[j]) for j in sorted(places)]


def beside_next(docs, fingerprints):
    """Rows of fingerprints.beside_next for distinct doc_ids (a null one comes last)."""
    rows = sorted(((d, t or "") for d, t in docs), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for (d, t), (_, x) in zip(rows, rows[1:] + rows[:1]):
        n = len(t) // 3
        changed = t[: len(t) - n] + x[:n]
        own = fingerprints.Fingerprints([t, changed, x])
        a, b, c = ({h for _, h in winnowed(y)} for y in (t, changed, x))
        near = [len(a & y) / len(a | y) if a | y else 1.0 for y in (b, c)]
        out.append((d, len(t), hashlib.sha256(changed.encode()).hexdigest(), own.text(0), own.text(1), *near))
    return out


def ftrl(rows, labels, m):
    """FTRL-proximal, one coordinate at a time; ``m`` holds the rates.  (weights that aren't 0, bias)"""
    seen = {}
    for x in rows:
        for i in x.tolist():
            seen[i] = seen.get(i, 0) + 1
    z, n, bias, bias_n = {}, {}, 0.0, 1.0

    def weight(i):
        if abs(z.get(i, 0.0)) <= m.L1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return (sign * m.L1 - z[i]) / ((m.BETA + math.sqrt(n[i])) / m.RATE + m.L2)

    for _ in range(m.EPOCHS):
        for x, y in zip(rows, labels):
            own = [i for i in x.tolist() if seen[i] >= m.LEAST_DOCS]
            w = {i: weight(i) for i in own}
            g = 1 / (1 + math.exp(-(sum(w.values()) + bias))) - y
            for i in own:
                old = n.get(i, 0.0)
                n[i] = old + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(old)) / m.RATE * w[i]
            bias_n += g * g
            bias -= m.BIAS_RATE * g / math.sqrt(bias_n)
    return {i: weight(i) for i in z if weight(i)}, bias
