"""Cross-tokenizer alignment: which tokens of one vocabulary stand for which of another.

Both token sequences of a text cover the same bytes. A place where a token of either ends is a shared cut. The cuts of an
interval are found by divide and conquer: the ends of one side are tried from the interval's middle outwards, each looked up
among the other side's by bisection; the first common one cuts the interval in two, and both halves go on. An interval without a
cut is a leaf group. All intervals of a slice of texts are halved together, a level at a time.

Links are all pairs of a group's tokens of either side. Per document they are kept as distinct id pairs with a
multiplicity, so repeats inside a document or group are never expanded. Counts of pairs over the corpus are combined inside each task
before their shuffle; every document then takes up the counts of its own pairs. That table is broadcast only after a check of
its size; beyond it the join shuffles, and adaptive execution splits pairs that very many documents hold.

Defined results: a NULL or empty text has no tokens, nor has one that either side's tokens don't give back byte by byte; they
get zeros and an empty digest; repeated rows and NULL ids are documents of their own and count as such; texts of any length are
encoded whole; an empty table gives no rows; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import PieceIds, pieces_of
from .common import batches_of, staged

#: Bytes of text a task encodes at a time.
SLICE = 1 << 20
#: Pairs with counts that may be broadcast (about 40 bytes each).
BROADCAST = 400_000
#: Characters outside Latin, Cyrillic and common punctuation, about which versions of Unicode may disagree.
UNFAMILIAR = re.compile("[^\x00-\u036f\u0400-\u04ff\u2010-\u2027\u2030-\u205e]")
#: A pair of ids as one number; ids of either side are below it.
SHIFT = 1 << 20
SCHEMA = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<struct<pair: long, times: long>>"
)


class Vocabulary:
    """What a side needs: ids of texts, bytes per id, and ids as text."""

    def __init__(self, tokens: list[bytes], encode):
        self.tokens, self.encode = np.array(tokens, object), encode
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        #: Ids as text, each with a mark behind it.
        self.names = {mark: np.array([f"{i}{mark}" for i in range(len(tokens))], object) for mark in ",|;"}


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin letters for themselves, the other
    bytes in order from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def byte_level(path: str, pattern: str) -> Vocabulary:
    """A byte-level BPE vocabulary whose texts are cut by ``pattern`` and merged by id; they get a space in front."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    letters = byte_letters()
    tokens = [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab().items():
        if all(x in letters for x in token):
            tokens[i] = bytes(letters[x] for x in token)

    special = set(tokenizer.get_added_tokens_decoder())
    memory = PieceIds({token: i for i, token in enumerate(tokens) if token and i not in special})

    def encode(texts: list[str]) -> list[np.ndarray]:
        """Familiar texts by the pairs' ranks, which are the ids of what they merge to; others by the library."""
        spaced = [" " + x for x in texts]
        cut = [None if UNFAMILIAR.search(x) else pieces_of(x, pattern) for x in spaced]
        ids = iter(memory.look_up(list(chain.from_iterable(x for x in cut if x))))
        strange = [x for x, found in zip(spaced, cut) if found is None]
        others = iter(tokenizer.encode_batch_fast(strange, add_special_tokens=False))
        made = (np.array(next(others).ids) if x is None else np.frombuffer(b"".join(islice(ids, len(x))), "<u4") for x in cut)
        return [x.astype(np.int64) for x in made]

    return Vocabulary(tokens, encode)


@lru_cache(maxsize=2)
def piecewise(path: str) -> Vocabulary:
    """A vocabulary of pieces with byte fallback, which puts a space in front by itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    byte = re.compile("<0x([0-9A-F]{2})>")
    tokens = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        code = byte.fullmatch(piece)
        tokens.append(bytes([int(code[1], 16)]) if code else piece.replace("▁", " ").encode())
    return Vocabulary(tokens, lambda texts: model.encode(texts, num_threads=1))


def shared_cuts(a: np.ndarray, b: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Positions in ``a`` of all ends that ``b`` has too, in ascending order.

    ``a``, ``b``: ascending ends of tokens; ``edges``: positions in ``a`` of ends known to be shared, which bound the first
    intervals (the last is ``len(a) - 1``).
    """
    found = [edges]
    # An interval's ends of its own: those strictly between two shared ones.
    low, high = np.concatenate([[0], edges[:-1] + 1]), edges
    while low.size:
        some = high > low
        low, high = low[some], high[some]
        cut = np.full(low.size, -1)
        middle = (low + high) // 2
        alive, away = np.arange(low.size), 0
        while alive.size:
            # The end ``away`` places before the middle, then the one as far behind it.
            for place in (middle[alive] - away, middle[alive] + away):
                inside = (place >= low[alive]) & (place < high[alive]) & (cut[alive] < 0)
                which, at = alive[inside], place[inside]
                where = np.searchsorted(b, a[at])
                hit = b[np.minimum(where, b.size - 1)] == a[at]
                cut[which[hit]] = at[hit]
            away += 1
            alive = alive[(cut[alive] < 0) & ((middle[alive] - away >= low[alive]) | (middle[alive] + away < high[alive]))]
        split = cut >= 0
        found.append(cut[split])
        low, high = np.concatenate([low[split], cut[split] + 1]), np.concatenate([cut[split], high[split]])
    return np.sort(np.concatenate(found))


def aligned(texts: list[str | None], left: Vocabulary, right: Vocabulary) -> list[tuple]:
    """``(n_a, n_b, n_groups, n_links, digest, pairs, times)`` of every text."""
    none = np.array([], np.int64)
    out = [(0, 0, 0, 0, "", none, none)] * len(texts)
    known = [i for i, x in enumerate(texts) if x]
    whole = [texts[i] for i in known]
    a, b = left.encode(whole), right.encode(whole)
    kept = []
    for k, text in enumerate(whole):
        plain = b" " + text.encode()
        a[k], b[k] = np.array(a[k], np.int64), np.array(b[k], np.int64)
        if b"".join(left.tokens[a[k]]) == plain and b"".join(right.tokens[b[k]]) == plain:
            kept.append(k)
    if not kept:
        return out
    ids_a, ids_b = np.concatenate([a[k] for k in kept]), np.concatenate([b[k] for k in kept])
    n_a, n_b = np.array([a[k].size for k in kept]), np.array([b[k].size for k in kept])
    # Texts stand one after another, so every text's end is a shared cut.
    ends_a, ends_b = np.cumsum(left.sizes[ids_a]), np.cumsum(right.sizes[ids_b])
    cuts_a = shared_cuts(ends_a, ends_b, np.cumsum(n_a) - 1)
    cuts_b = np.searchsorted(ends_b, ends_a[cuts_a])
    size_a, size_b = np.diff(cuts_a, prepend=-1), np.diff(cuts_b, prepend=-1)
    doc_of_group = np.searchsorted(np.cumsum(n_a) - 1, cuts_a)
    group_a, group_b = np.repeat(np.arange(cuts_a.size), size_a), np.repeat(np.arange(cuts_b.size), size_b)

    # The groups as text: A's ids of a group, then B's.
    words = np.empty(ids_a.size + ids_b.size, object)
    place_a = np.arange(ids_a.size) + (np.cumsum(size_b) - size_b)[group_a]
    place_b = np.arange(ids_b.size) + np.cumsum(size_a)[group_b]
    words[place_a], words[place_b] = left.names[","][ids_a], right.names[","][ids_b]
    words[place_a[cuts_a]] = left.names["|"][ids_a[cuts_a]]
    words[place_b[cuts_b]] = right.names[";"][ids_b[cuts_b]]
    word_ends = np.cumsum(n_a + n_b)

    # Distinct ids of a side with their number per group, then their pairs per group.
    def distinct(ids: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, ...]:
        key, times = np.unique(group * SHIFT + ids, return_counts=True)
        return key // SHIFT, key % SHIFT, times

    ga, xa, ta = distinct(ids_a, group_a)
    gb, xb, tb = distinct(ids_b, group_b)
    wide = np.bincount(gb, minlength=cuts_a.size)
    begin = np.cumsum(wide) - wide
    links = np.bincount(doc_of_group, size_a * size_b, len(kept)).astype(np.int64)
    groups = np.bincount(doc_of_group, minlength=len(kept))
    first_a = np.searchsorted(doc_of_group[ga], np.arange(len(kept) + 1))
    for d, k in enumerate(kept):
        rows = np.arange(first_a[d], first_a[d + 1])
        each = np.repeat(rows, wide[ga[rows]])
        width = wide[ga[rows]]
        other = np.arange(each.size) - np.repeat(np.cumsum(width) - width, width) + begin[ga[each]]
        pair, at = np.unique(xa[each] * SHIFT + xb[other], return_inverse=True)
        times = np.bincount(at, ta[each] * tb[other]).astype(np.int64)
        text = "".join(words[word_ends[d] - n_a[d] - n_b[d] : word_ends[d]])[:-1]
        digest = sha256(text.encode()).hexdigest()
        out[known[k]] = (int(n_a[d]), int(n_b[d]), int(groups[d]), int(links[d]), digest, pair, times)
    return out


def alignments(docs: DataFrame, byte_path: str, piece_path: str, pattern: str) -> DataFrame:
    """``SCHEMA`` of every row of ``docs``; ``row`` tells rows with the same id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = byte_level(byte_path, pattern), piecewise(piece_path)
        for batch in batches:
            for start, stop in batches_of(batch.column("text"), SLICE):
                part = batch.slice(start, stop - start)
                found = aligned(part.column("text").to_pylist(), left, right)
                *numbers, digests, pairs, times = zip(*found)
                ends = np.cumsum([0, *map(len, pairs)])
                flat = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate(pairs)), pa.array(np.concatenate(times))], ["pair", "times"]
                )
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
                columns = [part.column("row"), part.column("doc_id")]
                columns += [pa.array(x, pa.int64()) for x in numbers] + [pa.array(digests), lists]
                names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs"]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(run, SCHEMA)


def pair_counts(linked: DataFrame) -> DataFrame:
    """``pair, docs, best``: how many documents hold a pair, and whether none of its A id's pairs is held by more.

    An A id has at most as many pairs as the other vocabulary has ids, which bounds its window.
    """
    counts = linked.select(F.explode("pairs.pair").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))
    of_a = Window.partitionBy(F.expr(f"pair div {SHIFT}"))
    return counts.select("pair", "docs", (F.col("docs") == F.max("docs").over(of_a)).alias("best"))


def token_links(docs: DataFrame, byte_path: str, piece_path: str, pattern: str) -> DataFrame:
    """Per document: tokens of either side, groups, links, links whose pair is the most held of its A id, the sum of the links'
    counts, and the digest of the groups."""
    linked = staged(alignments(docs, byte_path, piece_path, pattern), "alignment")
    counts = staged(pair_counts(linked), "alignment-counts")
    if counts.count() <= BROADCAST:
        counts = F.broadcast(counts)
    held = linked.select("row", F.inline("pairs")).join(counts, "pair")
    sums = held.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("docs")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    return (
        linked.drop("pairs")
        .join(sums, "row", "left")
        .select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links",
            F.coalesce("n_best", zero).alias("n_best"),
            F.coalesce("count_sum", zero).alias("count_sum"),
            "groups_sha256",
        )
    )
