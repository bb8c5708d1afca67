"""Plain models of the operators, for small inputs (test helpers)."""

import re
from collections import defaultdict


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


class Groups:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def root(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def ngram_set(text, k):
    w = words(text)
    if len(w) >= k:
        return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def jaccard_groups(docs, k, num, den):
    """``doc_id -> (set size, smallest linked doc_id)`` by comparing all pairs."""
    sets = {i: ngram_set(t, k) for i, t in docs}
    groups, ids = Groups(sets), sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                groups.join(a, b)
    return {i: (len(sets[i]), groups.root(i)) for i in ids}


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def line_removals(docs, normal, s):
    """Lines that go: all but the first of every connected group."""
    places = defaultdict(list)
    for i, text in docs:
        for n, line in enumerate((text or "").split("\n")):
            own = normal(line)
            if own and len(own.split(" ")) >= s.min_words:
                places[own].append((i, n))
    lines = sorted(places)
    groups = Groups(lines)
    for k, a in enumerate(lines):
        for b in lines[k + 1:]:
            if levenshtein(a.split(" "), b.split(" ")) <= int(
                    max(a.count(" "), b.count(" ")) * (1 - s.similar) + 1 - s.similar + 1e-9):
                groups.join(a, b)
    found = defaultdict(list)
    for x in lines:
        found[groups.root(x)] += places[x]
    return {p for v in found.values() for p in v if p != min(v)}
