"""The same results the long way, for small tables."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def repeats(texts, length):
    """(bytes, removed, spans, hash of the rest) of every text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        covered = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                covered[i : i + length] = [True] * length
        rest = bytes(b for b, c in zip(t, covered) if not c)
        spans = sum(c and not (i and covered[i - 1]) for i, c in enumerate(covered))
        out.append((len(t), sum(covered), spans, hashlib.sha256(rest).hexdigest()))
    return out


def shingles(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def components(rows, n, percent):
    """(id, set size, least linked id) of every row, by all pairs."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        known = least.get(root(i))
        least[root(i)] = d if known is None else known if d is None else min(known, d)
    return [(d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows)]


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    three = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(three)
    inside = {i + k for i, w in enumerate(three) if seen[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside)
