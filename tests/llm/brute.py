"""Plain Python versions of what the operators compute, for small tables of tuples."""

from __future__ import annotations

import hashlib
import re

import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = " \t\n\x0b\x0c\r"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall(lower(text))


def contamination(docs, items, window=13):
    """[(n_words, n_hit, sorted item ids as strings)] for docs [(id, text)] and items [(id, text)]."""
    out = []
    for _, text in docs:
        w, hit, found = words(text), set(), set()
        for item, phrase in items:
            p = words(phrase)
            size = min(window, len(p))
            for o in range(len(p) - size + 1) if p else ():
                for i in range(len(w) - size + 1):
                    if w[i : i + size] == p[o : o + size]:
                        hit.update(range(i, i + size))
                        found.add(str(item))
        out.append((len(w), len(hit), sorted(found)))
    return out


def line_dedup(docs, least=10):
    """[(n_lines, n_dropped, kept)] for docs [(id, text)]; ids may repeat, null ids come last."""
    rank = lambda i: (i is None, i)
    owner = {}
    for i, text in docs:
        for line in (text or "").split("\n"):
            key = lower(line.strip(BLANK))
            if len(key) >= least and (key not in owner or rank(i) < rank(owner[key])):
                owner[key] = i
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        keys = [lower(x.strip(BLANK)) for x in lines]
        kept = [x for x, k in zip(lines, keys, strict=True) if len(k) < least or owner[k] == i]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def fingerprint(text, shingle=3):
    w = [x.encode() for x in re.findall(r"[^\x20\x09-\x0D]+", lower(text))]
    parts = [b" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(docs, distance=3):
    """[(fingerprint, component, number of the group)] for docs [(id, text)]."""
    prints = [fingerprint(t) for _, t in docs]
    group = list(range(len(docs)))
    for a in range(len(docs)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= distance and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    ids = lambda g: [i for (i, _), x in zip(docs, group, strict=True) if x == g and i is not None]
    return [(fp, min(ids(g), default=None), g) for fp, g in zip(prints, group, strict=True)]


def targets(sizes, weights=(5, 2, 1), repeats=3):
    """{source: target} for {source: size}, by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        left = total - sum(capped.values())
        free = [s for s in names if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s: float(repeats * sizes[s]) for s in free if share[s] > repeats * sizes[s]}
        if not over:
            return capped | share
        capped |= over


def taken(docs, target):
    """[words taken] for docs [(id, text, source)]: a cyclic prefix of each source in the order of a hash of the id."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in docs]
    out = [0] * len(docs)
    for s in {x[2] for x in docs}:
        rows = [k for k, x in enumerate(docs) if x[2] == s]
        rows.sort(key=lambda k: (hashlib.md5(("" if docs[k][0] is None else str(docs[k][0])).encode()).hexdigest(), size[k]))
        stream = [k for k in rows for _ in range(size[k])]
        for n in range(int(target[s])):
            out[stream[n % len(stream)]] += 1
    return size, out


def top_k(rows, query_ids, k):
    """{query: [(id, score)]} for rows [(id, vector)]."""
    out = {}
    for q, v in rows:
        if q in query_ids:
            scores = [(sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in rows if i != q]
            out[q] = [(i, s) for s, i in sorted(scores, key=lambda x: (-x[0], x[1]))[:k]]
    return out
