"""Plain versions of the operators, for small tables: rows are (id, text)."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = re.compile(r"[\x20\x09-\x0D]")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def last_if_null(x):
    return (x is None, x if x is not None else 0)


class Joined:
    def __init__(self, n):
        self.root = list(range(n))

    def top(self, x):
        while self.root[x] != x:
            x = self.root[x]
        return x

    def link(self, a, b):
        self.root[self.top(a)] = self.top(b)


def shingles(text, k):
    w = words(lower(text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(rows, k, num, den):
    """(id, size of the set, component) of every row."""
    sets = [shingles(t, k) for _, t in rows]
    joined = Joined(len(rows))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                joined.link(i, j)
    ids = defaultdict(list)
    for i, (x, _) in enumerate(rows):
        if x is not None:
            ids[joined.top(i)].append(x)
    return [(x, len(sets[i]), (min(ids[joined.top(i)], default=None) if sets[i] else x)) for i, (x, _) in enumerate(rows)]


def substrings(rows, window):
    """(id, words, removed words, digest of the kept text) of every row; ids are unique."""
    seen, out = set(), []
    for x, text in sorted(rows, key=lambda r: last_if_null(r[0])):
        w = words(text)
        gone = bytearray(len(w))
        for i in range(len(w) - window + 1):
            g = tuple(w[i : i + window])
            if g in seen:
                gone[i : i + window] = b"\1" * window
            seen.add(g)
        kept = " ".join(a for a, b in zip(w, gone, strict=True) if not b)
        out.append((x, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def copies(rows):
    """(id, keep_id, group size, digest) of every row."""
    groups = defaultdict(list)
    for x, t in rows:
        groups[SPACE.sub("", t or "")].append((-len(t or ""), last_if_null(x), x))
    return [(x, min(g := groups[SPACE.sub("", t or "")])[2], len(g), hashlib.sha256(SPACE.sub("", t or "").encode()).hexdigest()) for x, t in rows]


def measures(text):
    t = text or ""
    w = words(t)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, again = set(), 0
    for line in t.split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), again, len(covered)


def line_fates(rows, num, den):
    """(id, lines, removed numbers) of every row."""
    order = sorted(range(len(rows)), key=lambda i: (last_if_null(rows[i][0]), i))
    earlier, out = [], [None] * len(rows)
    for i in order:
        gone, n = [], 0
        for no, line in enumerate((rows[i][1] or "").split("\n")):
            s = frozenset(words(line))
            if not s:
                continue
            n += 1
            if any(den * len(s & e) >= num * len(s | e) for e in earlier):
                gone.append(no)
            earlier.append(s)
        out[i] = (rows[i][0], n, gone)
    return out


def best_pieces(text, pieces):
    """The best total score of cutting a text into pieces (a dict of scores)."""
    best = [0.0] + [None] * len(text)
    for end in range(1, len(text) + 1):
        ways = [best[s] + pieces[text[s:end]] for s in range(end) if best[s] is not None and text[s:end] in pieces]
        best[end] = max(ways, default=None)
    return best[-1]
