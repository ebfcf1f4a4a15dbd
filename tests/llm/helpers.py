"""Plain Python versions of what the operators compute, for small inputs."""

import re
from collections import defaultdict

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {i: i + 32 for i in range(65, 91)}


def words(text, pattern=ALNUM):
    return pattern.findall((text or "").translate(FOLD))


def windows(text, length=10):
    w = words(text)
    return [tuple(w[i : i + min(length, len(w))]) for i in range(max(len(w) - length, 0) + 1)] if w else []


def hits(text, items, length=10):
    """(words, words in exact occurrences, sorted ids of items with any); items: (id, text)."""
    w, covered, found = words(text), set(), set()
    for key, item in items:
        for window in windows(item, length):
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    covered |= set(range(i, i + len(window)))
                    found.add("" if key is None else str(key))
    return len(w), len(covered), sorted(found)


def shingles(text, size=3):
    w = words(text, SPACED)
    return {tuple(w[i : i + size]) for i in range(max(len(w) - size, 0) + 1)} if w else set()


def components(docs, size=3, num=9, den=10):
    """docs: [(id, text)] -> [(id, set size, component)] by comparing all pairs."""
    sets = [shingles(t, size) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    by_shingle = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by_shingle[x].append(i)
    pairs = {(a, b) for v in by_shingle.values() for a in v for b in v if a < b}
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if den * common >= num * (len(sets[a]) + len(sets[b]) - common):
            root[find(a)] = find(b)
    names = defaultdict(list)
    for i, (key, _) in enumerate(docs):
        names[find(i)].append(key)
    least = {r: min((k for k in v if k is not None), default=None) for r, v in names.items()}
    return [(key, len(sets[i]), least[find(i)] if sets[i] else key) for i, (key, _) in enumerate(docs)]
