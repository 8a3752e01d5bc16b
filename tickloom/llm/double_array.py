"""Double-array tries over sorted 64-bit edges, built and walked by numpy.

An edge is `parent << 32 | label`. A label is spelled as base-256 digits, so a node has
256 children at most; a node is its place in the array, the child of `s` by digit `d` is
`base[s] + d`, and it is there if `check` of that place names `s`. Nodes of many children
get a block of 256 places of their own, the others are put at random into free places, all
of one size at once, in rounds. Walking advances the states of all positions by one digit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WIDE = 16  # children from which a node gets its own block
FILL = 0.4  # share of the places that narrow nodes may fill
FREE = -1


@dataclass
class Trie:
    """`roots[parent - first]` is the base of each parent's node; `base` and `check` are the
    double array, and `base` of a last node is the index of its edge."""

    first: int
    digits: int
    roots: np.ndarray
    base: np.ndarray
    check: np.ndarray

    def find(self, parents: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The index of the edge of each position, or -1."""
        out = np.full(len(parents), FREE, np.int64)
        local = parents - self.first
        at = np.flatnonzero((local >= 0) & (local < len(self.roots)) & (labels >> (8 * self.digits) == 0))
        state = local[at] - len(self.roots) - 1  # parents are below all places, and below FREE
        base = self.roots[local[at]]
        for k in reversed(range(self.digits)):
            place = base + (labels[at] >> (8 * k) & 255)
            there = np.flatnonzero((base >= 0) & (self.check[place] == state))
            at, state = at[there], place[there]
            base = self.base[state]
        out[at] = base
        return out


def placed(nodes: np.ndarray, digits: np.ndarray, free: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The base of every node; children are given as (node, digit) pairs sorted by node, and
    taken out of `free`."""
    n = int(nodes[-1]) + 1 if len(nodes) else 0
    bounds = np.searchsorted(nodes, np.arange(n + 1))
    size = np.diff(bounds)
    base = np.full(n, FREE, np.int64)
    for width in np.unique(size)[::-1]:
        left = np.flatnonzero(size == width)
        spelled = digits[bounds[left][:, None] + np.arange(width)]
        while len(left):
            tried = rng.integers(0, len(free) - 255, len(left))
            places = tried[:, None] + spelled
            good = free[places].all(1)
            # Of nodes that want the same free place, those that get all of theirs stay.
            tried, places, some = tried[good], places[good], np.flatnonzero(good)
            owner = np.full(len(free), FREE, np.int32) if len(some) > len(free) // 64 else None
            if owner is None:
                flat, inverse = np.unique(places, return_inverse=True)
                first = np.full(len(flat), len(some), np.int64)
                np.minimum.at(first, inverse.reshape(places.shape), np.arange(len(some))[:, None])
                won = (first[inverse.reshape(places.shape)] == np.arange(len(some))[:, None]).all(1)
            else:
                owner[places] = np.arange(len(some), dtype=np.int32)[:, None]
                won = (owner[places] == np.arange(len(some))[:, None]).all(1)
            free[places[won]] = False
            base[left[some[won]]] = tried[won]
            keep = np.ones(len(left), bool)
            keep[some[won]] = False
            left, spelled = left[keep], spelled[keep]
    return base


def build(edges: np.ndarray, seed: int = 1) -> Trie:
    """The trie of sorted, distinct edges (int64); a last node holds its edge's index."""
    parents, labels = edges >> 32, edges & 0xFFFFFFFF
    count = max(1, -(-int(labels.max(initial=0)).bit_length() // 8))
    first, last = (int(parents[0]), int(parents[-1])) if len(edges) else (0, -1)
    # The nodes of each level: distinct prefixes, in order; their children are the next level's.
    prefixes = [np.unique(parents)] + [np.unique(edges >> (8 * k)) for k in reversed(range(1, count))] + [edges]
    levels = []
    for i in range(count):
        child = prefixes[i + 1]
        shift = 8 * (count - 1 - i)
        up = child >> (32 - shift) if i == 0 else child >> 8
        levels.append((np.searchsorted(prefixes[i], up), child & 255))
    wide_blocks = narrow = 0
    for nodes, _ in levels:
        sizes = np.bincount(nodes) if len(nodes) else np.zeros(0, np.int64)
        wide_blocks += int((sizes >= WIDE).sum())
        narrow += int(sizes[sizes < WIDE].sum())
    size = 256 * wide_blocks + int(narrow / FILL) + 512
    free = np.ones(size, bool)
    free[: 256 * wide_blocks] = False
    rng, used = np.random.default_rng(seed), 0
    base, check = np.full(size, FREE, np.int32), np.full(size, FREE, np.int32)
    roots = np.full(last - first + 1, FREE, np.int32)
    own = None
    for i, (nodes, digits) in enumerate(levels):
        sizes = np.bincount(nodes, minlength=len(prefixes[i]))
        wide = sizes >= WIDE
        bases = np.full(len(sizes), FREE, np.int64)
        bases[wide] = 256 * (used + np.arange(int(wide.sum())))
        used += int(wide.sum())
        thin = ~wide[nodes]
        renamed = np.cumsum(~wide) - 1
        bases[~wide] = placed(renamed[nodes[thin]], digits[thin], free, rng)
        if i == 0:
            states = prefixes[0] - first - len(roots) - 1
            roots[prefixes[0] - first] = bases
        else:
            states = own
            base[own] = bases
        own = bases[nodes] + digits
        check[own] = states[nodes]
    if len(edges):
        base[own] = np.arange(len(edges), dtype=np.int32)
    return Trie(first, count, roots, base, check)
