"""Plain versions of what the operators compute, for small inputs."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def repeats(docs, window):
    """(n_words, n_removed, kept digest) per document of unique ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        words = WORD.findall(text or "")
        gone = set()
        for k in range(len(words) - window + 1):
            body = tuple(words[k : k + window])
            if body in seen:
                gone.update(range(k, k + window))
            seen.add(body)
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out[doc_id] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def shingles(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    if 0 < len(words) < n:
        return {tuple(words)}
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}


def components(docs, n, percent):
    """(n_shingles, component) per document of unique ids."""
    sets = {d: shingles(t, n) for d, t in docs}
    up = {d: d for d in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {d: (len(sets[d]), top(d)) for d in ids}


def phrases(text, known):
    words = ALNUM.findall((text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in known.items():
        parts = phrase.split()
        for k in range(len(words)):
            if words[k : k + len(parts)] == parts:
                places.append(k)
                labels.add(label)
    return (
        len(words), len(places), min(places, default=None), max(places, default=None), sorted(labels),
    )


def top_k(points, k, is_query):
    found = []
    for q, x in points.items():
        if is_query(q):
            scores = sorted((-sum(a * b for a, b in zip(x, y)), v) for v, y in points.items() if v != q)
            found += [(q, r + 1, v, -s) for r, (s, v) in enumerate(scores[:k])]
    return sorted(found)
