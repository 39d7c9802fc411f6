"""Repeated byte strings: every byte covered by a string of ``length`` bytes that also starts anywhere else goes.

Windows (strings of ``length`` bytes) are dealt so that equal ones meet: a window's *anchor* is the leftmost of its
shingles of ``width`` bytes with the least hash, which depends on the window alone. Neighbouring windows with the same anchor form
a *unit*, a string with one place per window. Units are first compared by digest: one that occurs twice is repeated as a
whole, however often it occurs, and only its digest is shuffled. Those with the same anchor but other bytes are compared
through Burrows-Wheeler transforms (``bwt``): a task takes anchors in turn, makes transforms of shards of their units and merges them by
interleave refinement; suffixes that share four letters of a quarter of the length each with a neighbour are repeated windows.

An anchor may be held by very many unlike units. If the units of an anchor are more than a task should merge, they are dealt
again by wider shingles, and in the end by the windows themselves, where a digest decides. Nothing is capped.

Defined results: a NULL text counts as empty; texts below ``length`` bytes lose nothing; repeated rows are further places of
the same strings, so of equal texts of ``length`` bytes or more nothing is left; NULL ids are rows like others; very long texts are dealt
in pieces; an empty table gives no rows; other columns are not read, so their names cannot clash. Digests of 128 bits and block
names of 64 bits stand for the bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bwt
from .common import batches_of, dropped, staged

#: Letters per window; a letter is a block of a quarter of the length.
DEPTH = 4
#: Windows dealt together, and bytes of units whose transforms are merged two by two in one go.
PIECE, SHARD = 1 << 19, 1 << 18
#: Bytes of unlike units of one anchor that a task merges; beyond it they are dealt again.
HOT = 4 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
UNITS = "t binary, p long, n long, anchor long, unit binary"


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2^64."""
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, b, np.uint64)])) for b in (BASE, inverse))


class Hashes:
    """64-bit hashes of the strings of ``width`` bytes at every place, by prefix sums."""

    def __init__(self) -> None:
        self.size = 0

    def __call__(self, data: np.ndarray, width: int) -> np.ndarray:
        if self.size < data.size:
            self.size = max(data.size, 1 << 20)
            self.up, self.down = powers(self.size)
        sums = np.zeros(data.size + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: data.size], out=sums[1:])
        x = (sums[width:] - sums[:-width]) * self.down[: data.size - width + 1]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: block-wise minima from either end of each block."""
    n = values.size - width + 1
    rows = -(-values.size // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: values.size] = values
    blocks = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def pieces_of(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (text, place, bytes) that hold about PIECE windows; a longer text is cut, neighbours overlapping so that
    every window is whole in one of them."""
    found, windows = [], 0
    for i, text in enumerate(texts):
        for place in range(0, len(text) - length + 1, PIECE):
            part = text[place : place + PIECE + length - 1]
            found.append((i, place, part))
            windows += len(part)
            if windows >= PIECE:
                yield found
                found, windows = [], 0
    if found:
        yield found


def units_of(pieces: list[tuple[int, int, bytes]], length: int, width: int, hashes: Hashes) -> tuple:
    """``text, p, n, anchor, unit`` of all windows of some pieces."""
    import xxhash

    whole = b"".join(x for _, _, x in pieces)
    sizes = np.array([len(x) for _, _, x in pieces])
    ends = np.cumsum(sizes)
    data = np.frombuffer(whole, np.uint8)
    shingle = hashes(data, width)
    # The place stands in the low bits, so equal shingles give the leftmost.
    bits = np.uint64(24)
    ranked = (shingle >> bits << bits) | np.arange(shingle.size, dtype=np.uint64)
    anchor = (least(ranked, length - width + 1) & np.uint64((1 << 24) - 1)).astype(np.int64)
    piece = np.repeat(np.arange(sizes.size), sizes)[: anchor.size]
    valid = np.arange(anchor.size) <= ends[piece] - length
    fresh = np.ones(anchor.size, bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
    at = np.flatnonzero(fresh & valid)
    last = np.flatnonzero(valid & ~np.concatenate([valid[1:] & ~fresh[1:], [False]]))
    place = at - (ends - sizes)[piece[at]] + np.array([x for _, x, _ in pieces])[piece[at]]
    text = np.array([x for x, _, _ in pieces])[piece[at]]
    digests = [xxhash.xxh3_128_digest(whole[a : b + length]) for a, b in zip(at.tolist(), last.tolist())]
    return text, place, last - at + 1, shingle[anchor[at]].view(np.int64), digests


def units(strings: DataFrame, length: int, width: int) -> DataFrame:
    """``UNITS`` of every row of ``strings (t, data)``: the ``n`` windows from ``p`` on share an anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for start, stop in batches_of(batch.column("data"), 4 << 20):
                part = batch.slice(start, stop - start)
                names, texts = part.column("t").to_pylist(), part.column("data").to_pylist()
                for pieces in pieces_of(texts, length):
                    text, *columns, digests = units_of(pieces, length, width, hashes)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[i] for i in text.tolist()], pa.binary()), *map(pa.array, columns), pa.array(digests, pa.binary())],
                        ["t", "p", "n", "anchor", "unit"],
                    )

    return strings.where(F.octet_length("data") >= length).mapInArrow(run, UNITS)


def repeated_in(strings: list[bytes], length: int, hashes: Hashes) -> list[np.ndarray]:
    """Which windows of each string start elsewhere among the strings too, by merged transforms of their shards."""
    size = length // DEPTH
    whole = b"".join(x + b"\0" for x in strings)  # one place more than bytes, for the last end
    lengths = np.array([len(x) + 1 for x in strings])
    stops = np.cumsum(lengths) - 1
    starts = stops - lengths + 1
    block = np.zeros(len(whole), np.uint64)
    found = hashes(np.frombuffer(whole, np.uint8), size)
    block[: found.size] = found
    ended = np.arange(block.size) > np.repeat(stops, lengths) - size
    names = np.unique(block, return_inverse=True)[1] + 1
    names[ended] = 0
    # Shards of about SHARD bytes, two at least.
    count = min(len(strings), max(2, -(-len(whole) // SHARD)))
    cuts = np.unique(np.searchsorted(stops, np.arange(1, count) * len(whole) / count))
    cuts = np.unique(np.clip(cuts, 1, len(strings) - 1))
    shards = []
    for low, high in zip([0, *cuts], [*cuts, len(strings)]):
        base = starts[low]
        shards.append((names[base : stops[high - 1] + 1], starts[low:high] - base, stops[low:high] - base))
    hit = bwt.repeated_places(shards, size, DEPTH)
    return [hit[a : b - length + 1] for a, b in zip(starts, stops)]


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of true places, the stop not included."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return [tuple(x) for x in edges.reshape(-1, 2).tolist()]


SPANS = "array<struct<start: long, stop: long>>"
SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def merged_units(rows: DataFrame, length: int) -> DataFrame:
    """``unit, spans`` of ``rows (anchor, unit, data)``: windows that units of the same anchor share."""

    def marks(held: list[tuple[bytes, bytes]], hashes: Hashes) -> pa.RecordBatch:
        flags = repeated_in([data for _, data in held], length, hashes)
        found = [(unit, [dict(start=a, stop=b) for a, b in runs(f)]) for (unit, _), f in zip(held, flags) if f.any()]
        return pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in found], pa.binary()), pa.array([x for _, x in found], SPAN_TYPE)], ["unit", "spans"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, total, last = Hashes(), [], 0, None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("anchor", "unit", "data"))
            for anchor, unit, data in zip(*columns):
                # Units of other anchors share no window, so a new anchor may begin a new round.
                if anchor != last and total >= 2 * SHARD:
                    yield marks(held, hashes)
                    held, total = [], 0
                held.append((unit, data))
                total, last = total + len(data), anchor
        if len(held) > 1:
            yield marks(held, hashes)

    placed = rows.select("anchor", "unit", "data").repartition("anchor").sortWithinPartitions("anchor", "unit")
    return placed.mapInArrow(run, f"unit binary, spans {SPANS}")


def repeated_windows(strings: DataFrame, length: int, widths: tuple[int, ...]) -> DataFrame:
    """``t, spans`` of ``strings (t, data)``: places whose windows start at another place of any row too."""
    every = staged(units(strings, length, widths[0]), "repeats-every")
    # Units of an anchor that occurs once share no window. Only anchors are shuffled to see which.
    again = every.groupBy("anchor").agg(F.count("*").alias("times")).where("times > 1")
    found = staged(every.join(again, "anchor", "left_semi"), "repeats-units")
    dropped(every)
    kinds = found.groupBy("anchor", "unit").agg(
        F.count("*").alias("times"), F.min(F.struct("t", "p")).alias("at"), F.first("n").alias("n")
    )
    kinds = staged(kinds, "repeats-kinds")
    anchors = kinds.groupBy("anchor").agg(
        F.count("*").alias("kinds"), F.sum(F.col("n") + length - 1).alias("bytes"), F.min("times").alias("least")
    )
    # An anchor all of whose units are repeated as they are needs no bytes.
    open_ = kinds.join(anchors.where("kinds > 1 and least = 1"), "anchor")
    open_ = open_.select("anchor", "unit", "n", "bytes", F.col("at.t").alias("t"), F.col("at.p").alias("p"))
    whole = kinds.where("times > 1").select(
        "unit", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n").alias("stop"))).alias("spans")
    )
    # Each text that is asked for goes once to where its units are.
    texts = strings.join(open_.select("t").distinct(), "t", "left_semi").dropDuplicates(["t"])
    piece = F.substring("data", (F.col("p") + 1).cast("int"), (F.col("n") + (length - 1)).cast("int"))
    slices = staged(open_.join(texts, "t").select("anchor", "unit", "bytes", piece.alias("data")), "repeats-slices")
    marks = whole.unionByName(merged_units(slices.where(F.col("bytes") <= HOT) if len(widths) > 1 else slices, length))
    if len(widths) > 1:
        hot = slices.where(F.col("bytes") > HOT).select(F.col("unit").alias("t"), "data")
        if not hot.isEmpty():
            wider = repeated_windows(hot, length, widths[1:])
            marks = marks.unionByName(wider.select(F.col("t").alias("unit"), "spans"))
    # Units repeated as a whole may come from the transforms too.
    placed = found.join(marks, "unit").select("t", "p", F.inline("spans"))
    shifted = placed.select("t", F.struct((F.col("p") + F.col("start")).alias("start"), (F.col("p") + F.col("stop")).alias("stop")).alias("s"))
    spans = staged(shifted.groupBy("t").agg(F.collect_set("s").alias("spans")), "repeats-spans")
    for table in (found, kinds, slices):
        dropped(table)
    return spans


def without_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every row: what is left of a text, as bytes."""
    if length % DEPTH:
        raise ValueError(f"length must be a multiple of {DEPTH}")
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), data.alias("data"))
    name = F.unhex(F.substring(F.sha2("data", 256), 1, 32)).alias("t")
    strings = rows.select(name, "data")
    widths = (length // 4, length * 5 // 8, length)
    spans = repeated_windows(strings.where(F.octet_length("data") >= length), length, widths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in batches_of(batch.column("data"), 4 << 20):
                part = batch.slice(start, stop - start)
                sizes, gone, counts, digests, left = [], [], [], [], []
                for text, found in zip(part.column("data").to_pylist(), part.column("spans").to_pylist()):
                    kept, at, cut, n = [], 0, 0, 0
                    for a, b in joined(found or (), length):
                        kept.append(text[at:a])
                        at, cut, n = b, cut + b - a, n + 1
                    rest = b"".join([*kept, text[at:]])
                    sizes.append(len(text)), gone.append(cut), counts.append(n), left.append(rest)
                    digests.append(hashlib.sha256(rest).hexdigest())
                numbers = (pa.array(x, pa.int64()) for x in (sizes, gone, counts))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *numbers, pa.array(digests, pa.string()), pa.array(left, pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
                )

    placed = rows.select("doc_id", name, "data").join(spans, "t", "left").select("doc_id", "data", "spans")
    return placed.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def joined(spans, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that windows from ``start`` to before ``stop`` cover."""
    out: list[list[int]] = []
    for a, b in sorted((x["start"], x["stop"] + length - 1) for x in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def digests(docs: DataFrame) -> DataFrame:
    """Per document: bytes, removed bytes and runs, and the digest of what is left."""
    return without_repeats(docs).drop("kept")
