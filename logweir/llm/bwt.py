"""Burrows-Wheeler transforms of many strings, merged by interleave refinement.

A letter is a *block* of ``size`` bytes. A suffix at byte i of a string reads the blocks at i, i + size, i + 2 * size and so
on, until no whole block is left; there it ends. So every byte is the start of a suffix, and a prefix of d letters is a
string of d * size bytes. The last ``size`` places of a string are the ends of its ``size`` sequences of blocks.

A transform holds, for every suffix in sorted order, the letter before it (0 where there is none). Two transforms are merged
without sorting their suffixes anew: all suffixes are first taken as one after the other; then, again and again, whoever
follows a letter is placed by the letter and by where its own continuation stands now, which after h rounds orders all by h
letters. A neighbour that is told apart in round h shares h - 1 letters with the one before it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Transform:
    """``letters`` before the suffixes in sorted order, and ``places``, where each suffix starts. The ``ends`` first suffixes
    are the empty ones, in the order of their sequences."""

    letters: np.ndarray
    places: np.ndarray
    ends: int


def transform(names: np.ndarray, starts: np.ndarray, stops: np.ndarray, size: int, first: int = 0) -> Transform:
    """The transform of some strings. ``names``: number of the block at every place, from 1, or 0 at a sequence's end;
    ``starts``, ``stops``: first and last place of each string; ``first`` is added to the places."""
    n = names.size
    ended = names == 0
    ends = int(ended.sum())
    # Ends are told apart by their sequence, so that no two suffixes are equal and order is total.
    rank = np.where(ended, np.cumsum(ended) - 1, names + ends)
    limit = np.repeat(stops, stops - starts + 1)
    place, reach, order = np.arange(n), size, None
    while True:
        ahead = place + reach
        beyond = ahead > limit
        after = np.where(beyond, 0, rank[np.minimum(ahead, n - 1)] + 1)
        key = rank.astype(np.int64) * (int(rank.max()) + 2) + after
        order = np.argsort(key, kind="stable")
        fresh = np.empty(n, np.int64)
        fresh[order] = np.cumsum(np.diff(key[order], prepend=key[order[0]]) != 0)
        rank, reach = fresh, reach * 2
        if rank[order[-1]] == n - 1:
            break
    before = order - size
    some = before >= np.repeat(starts, stops - starts + 1)[order]
    letters = np.where(some, names[np.maximum(before, 0)], 0)
    return Transform(letters, order + first, ends)


def merged(one: Transform, two: Transform, depth: int) -> tuple[Transform, np.ndarray]:
    """The transform of the strings of both, and how many letters (``depth`` or more count as ``depth``) each suffix shares
    with the one before it."""
    sides = (one, two)
    n = one.letters.size + two.letters.size
    ends = one.ends + two.ends
    # Where each suffix that is not empty continues: by the letters before, in order.
    onward = [np.argsort(x.letters, kind="stable")[x.ends :] for x in sides]
    heads = [x.letters[o].astype(np.int64) for x, o in zip(sides, onward)]
    empty = [np.arange(one.ends), one.ends + np.arange(two.ends)]
    spot = [np.arange(one.letters.size), one.letters.size + np.arange(two.letters.size)]
    group = [np.zeros(x.letters.size, np.int64) for x in sides]
    shared = np.full(n, -1)
    shared[:ends] = 0
    letter, behind = np.zeros(n, np.int64), np.zeros(n, np.int64)
    level = 0
    while True:
        keys = [h * n + s[o] for h, s, o in zip(heads, spot, onward)]
        less = [np.searchsorted(keys[1], keys[0]), np.searchsorted(keys[0], keys[1])]
        fresh = [np.concatenate([e, ends + np.arange(k.size) + m]) for e, k, m in zip(empty, keys, less)]
        for f, h, g, o, x in zip(fresh, heads, group, onward, sides):
            letter[f[x.ends :]], behind[f[x.ends :]] = h, g[o]
        apart = np.ones(n, bool)
        apart[1:] = (letter[1:] != letter[:-1]) | (behind[1:] != behind[:-1])
        apart[: ends + 1] = True
        shared[apart & (shared < 0)] = level
        group_of = np.maximum.accumulate(np.where(apart, np.arange(n), 0))
        group = [group_of[f] for f in fresh]
        level += 1
        still = all(np.array_equal(a, b) for a, b in zip(fresh, spot))
        spot = fresh
        if still and level >= depth:
            break
    letters, places = np.empty(n, np.int64), np.empty(n, np.int64)
    for s, x in zip(spot, sides):
        letters[s], places[s] = x.letters, x.places
    shared = np.where(shared < 0, depth, np.minimum(shared, depth))
    return Transform(letters, places, ends), shared


def repeated_places(shards: list[tuple[np.ndarray, np.ndarray, np.ndarray]], size: int, depth: int) -> np.ndarray:
    """Which places of all shards' strings start ``depth`` letters that start at another place too.

    ``shards``: ``names, starts, stops`` of each, places within the shard. Transforms are merged two by two.
    """
    queue, first = [], 0
    for names, starts, stops in shards:
        queue.append(transform(names, starts, stops, size, first))
        first += names.size
    shared = None
    while len(queue) > 1:
        made, shared = merged(queue[0], queue[1], depth)
        queue = [*queue[2:], made]
    out = np.zeros(first, bool)
    if shared is None:
        raise ValueError("two shards at least")
    same = shared >= depth
    either = same.copy()
    either[:-1] |= same[1:]
    out[queue[0].places[either]] = True
    return out
