"""BK-trees over fingerprints, as arrays.

The first fingerprint is the root; every other goes down the child whose edge carries its Hamming
distance to the node, and becomes that child where there is none. A search follows only the edges whose
label differs from the distance between query and node by no more than the radius. All queries of a
shard go down together, one level per step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: (query, node) pairs looked at together; bounds the memory of a search.
PAIRS = 1 << 20


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits that differ; fingerprints are rows of 64-bit words."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int32)


class BKTree:
    def __init__(self, prints: np.ndarray):
        """``prints``: one fingerprint per row."""
        self.prints = prints
        n = len(prints)
        parent = np.full(n, -1)
        label = np.zeros(n, np.int32)
        rest, at = np.arange(1, n), np.zeros(max(n - 1, 0), np.int64)
        while rest.size:
            d = distance(prints[rest], prints[at])
            order = np.lexsort((rest, d, at))
            rest, at, d = rest[order], at[order], d[order]
            first = np.ones(rest.size, bool)
            first[1:] = (at[1:] != at[:-1]) | (d[1:] != d[:-1])
            parent[rest[first]], label[rest[first]] = at[first], d[first]
            child = rest[first][np.cumsum(first) - 1]
            rest, at = rest[~first], child[~first]
        # Children of a node stand together, sorted by label.
        order = np.lexsort((label, parent))[1:] if n else np.array([], np.int64)
        self.children, self.labels = order, label[order]
        counts = np.bincount(parent[order], minlength=n) if n else np.array([], np.int64)
        self.start = np.concatenate([[0], np.cumsum(counts)])

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, node, distance) arrays of everything within ``radius``, piece by piece."""
        n = len(self.prints)
        if not n:
            return
        size = max(1, PAIRS // n)
        for low in range(0, len(queries), size):
            query = np.arange(low, min(low + size, len(queries)))
            node = np.zeros(query.size, np.int64)
            found = []
            while query.size:
                d = distance(queries[query], self.prints[node])
                hit = d <= radius
                found.append((query[hit], node[hit], d[hit]))
                begin, width = self.start[node], self.start[node + 1] - self.start[node]
                pair = np.repeat(np.arange(query.size), width)
                edge = np.arange(pair.size) - np.repeat(np.cumsum(width) - width, width) + begin[pair]
                keep = np.abs(self.labels[edge] - d[pair]) <= radius
                query, node = query[pair[keep]], self.children[edge[keep]]
            yield tuple(np.concatenate(x) for x in zip(*found))


class Groups:
    """Which members of a shard are linked already."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def _settled(self) -> None:
        while True:
            up = self.label[self.label]
            if np.array_equal(up, self.label):
                return
            self.label = up

    def link(self, a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Joins all pairs; returns positions of pairs, nearest first, that suffice to do so."""
        chosen = []
        order = np.argsort(d, kind="stable")
        while True:
            x, y = self.label[a[order]], self.label[b[order]]
            apart = x != y
            if not apart.any():
                return np.concatenate(chosen) if chosen else np.array([], np.int64)
            order, x, y = order[apart], x[apart], y[apart]
            # Each group takes its first remaining pair to a smaller group; a group is moved once a round.
            high, low = np.maximum(x, y), np.minimum(x, y)
            moved, first = np.unique(high, return_index=True)
            self.label[moved] = low[first]
            self._settled()
            chosen.append(order[first])


def shard_links(prints: np.ndarray, radius: int, near: int = 1) -> tuple[np.ndarray, ...]:
    """Pairs of members of one shard within ``radius``, as (member, other, distance, bridge).

    Each member with its ``near`` nearest, and as many more (``bridge``) as keep together whatever the
    radius links: at most ``near`` + 1 pairs per member, whatever the shard.
    """
    n = len(prints)
    groups, found = Groups(n), []
    for query, node, d in BKTree(prints).search(prints, radius):
        other = query != node
        query, node, d = query[other], node[other], d[other]
        order = np.lexsort((node, d, query))
        counts = np.bincount(query, minlength=n)
        place = np.arange(query.size) - np.repeat(np.cumsum(counts) - counts, counts)
        take = order[place < near]
        found.append((query[take], node[take], d[take], np.zeros(take.size, bool)))
        groups.link(query[take], node[take], d[take])
        more = groups.link(query, node, d)
        found.append((query[more], node[more], d[more], np.ones(more.size, bool)))
    return tuple(np.concatenate(x) for x in zip(*found))
