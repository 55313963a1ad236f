"""Plain single-process versions of the operators, for small inputs."""

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BENCH = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def quality(text):
    w = WORD.findall(text or "")
    grams = list(zip(w, w[1:], w[2:]))
    many, hit, seen, dup = Counter(grams), set(), set(), 0
    for i, g in enumerate(grams):
        if many[g] > 1:
            hit |= {i, i + 1, i + 2}
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit),
            len(w) < 50 or 100 * len(hit) > 50 * len(w))


def substrings(rows, k=13):
    """{row: (n_words, n_removed, kept)} of rows [(doc_id, text)]."""
    first, words = {}, [WORD.findall(t or "") for _, t in rows]
    for (d, _), w in zip(rows, words):
        if d is not None:
            for i in range(len(w) - k + 1):
                g = tuple(w[i:i + k])
                first[g] = min(first.get(g, d), d)
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        if d is not None:
            for i in range(len(w) - k + 1):
                if first[tuple(w[i:i + k])] < d:
                    gone |= set(range(i, i + k))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def contamination(rows, items, k=10):
    wins = {}
    for item, t in items:
        w = BENCH.findall((t or "").translate(LOW))
        n = min(k, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[i:i + n]), set()).add(item)
    sizes = {len(g) for g in wins}
    out = []
    for _, t in rows:
        w, hit, got = BENCH.findall((t or "").translate(LOW)), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i:i + n])) in wins:
                    hit |= set(range(i, i + n))
                    got |= wins[g]
        out.append((len(w), len(hit), sorted(str(x) for x in got if x is not None)))
    return out


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(LOW))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(rows, k=5, percent=75):
    """{doc_id: smallest id reachable}"""
    sets = {d: shingles(t, k) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and find(a) != find(b):
                n = len(sets[a] & sets[b])
                if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {d: find(d) for d in ids}


def repeats(rows, length):
    """[(n_bytes, n_removed, n_spans, kept)]"""
    texts = [(t or "").encode() for _, t in rows]
    many = Counter(b[i:i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for b in texts:
        spans = []
        for i in range(len(b) - length + 1):
            if many[b[i:i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        kept = b"".join(b[x:y] for x, y in zip([0] + [s[1] for s in spans], [s[0] for s in spans] + [len(b)]))
        out.append((len(b), len(b) - len(kept), len(spans), kept))
    return out
