"""Byte-level BPE encoding and decoding.

A text is cut into pieces by the vocabulary's pattern, each piece is merged on its own. A segment tree
over the piece's byte positions holds, for every live symbol, the rank of the pair it forms with its
right neighbour; the root is the leftmost minimum. A merge changes three leaves, so a piece of n bytes
takes O(n log n), however long it is.

Defined results: a NULL text counts as empty; an empty text has no ids and decodes to no bytes; repeated
rows each give a row; columns other than the id and the text are not carried, so their names cannot clash.
"""

from __future__ import annotations

import base64
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import batches_of

NO_RANK = 1 << 24  # above every rank; with 64 positions a node still fits 32 bits
#: Pieces whose ids a task remembers, and the longest piece (in bytes) that is merged beside others.
MEMORY, MEMORY_BYTES = 400_000, 64
#: Pieces merged side by side: their trees stay in the processor's cache.
ROWS = 4096
#: Bytes of text a task handles at a time.
SLICE = 2 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def ranks_of(path: str) -> dict[bytes, int]:
    """Read once per Python worker."""
    return read_ranks(path)


@lru_cache(maxsize=4)
def tokens_of(path: str) -> list[bytes]:
    ranks = ranks_of(path)
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


class PairTree:
    """Segment tree over positions; each node holds rank * width + position, so that the minimum is
    the lowest rank and, among equal ranks, the leftmost position."""

    def __init__(self, ranks: list[int]):
        self.width = 1 << max(len(ranks) - 1, 0).bit_length()
        self.none = NO_RANK * self.width
        leaves = [rank * self.width + i for i, rank in enumerate(ranks)]
        self.nodes = [self.none] * self.width + leaves + [self.none] * (self.width - len(leaves))
        for i in range(self.width - 1, 0, -1):
            self.nodes[i] = min(self.nodes[2 * i], self.nodes[2 * i + 1])

    def best(self) -> tuple[int, int]:
        """Rank and position of the leftmost minimum."""
        return divmod(self.nodes[1], self.width)

    def put(self, position: int, rank: int) -> None:
        nodes, i = self.nodes, position + self.width
        nodes[i] = rank * self.width + position
        i >>= 1
        while i:
            left, right = nodes[2 * i], nodes[2 * i + 1]
            low = left if left < right else right
            if nodes[i] == low:
                break
            nodes[i] = low
            i >>= 1


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece. A piece that is a token itself is that token."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    end = list(range(1, n + 1))  # where the symbol that starts here ends
    before = list(range(-1, n - 1))  # start of the live symbol to the left

    def pair(start: int) -> int:
        middle = end[start]
        return NO_RANK if middle >= n else ranks.get(piece[start : end[middle]], NO_RANK)

    tree = PairTree([pair(i) for i in range(n)])
    rank, at = tree.best()
    while rank < NO_RANK:
        gone = end[at]
        end[at] = end[gone]
        if end[at] < n:
            before[end[at]] = at
        tree.put(gone, NO_RANK)
        tree.put(at, pair(at))
        if before[at] >= 0:
            tree.put(before[at], pair(before[at]))
        rank, at = tree.best()
    ids, start = [], 0
    while start < n:
        ids.append(ranks[piece[start : end[start]]])
        start = end[start]
    return ids


class PairTable:
    """Ranks of pairs of ids: every way to cut a token into two tokens, as a sorted array of keys."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
        self.keys = np.array([*(keys[i] for i in order), np.iinfo(np.int64).max], dtype=np.int64)
        self.values = np.array([*(values[i] for i in order), NO_RANK], dtype=np.int64)
        self.bytes = np.array([ranks.get(bytes([i]), 0) for i in range(256)], dtype=np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NO_RANK where it is none; a negative id pairs with nothing."""
        keys = left << 32 | right
        at = np.searchsorted(self.keys, keys)
        found = (self.keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(found, self.values[at], NO_RANK)


def merge_pieces(pieces: list[bytes], pairs: PairTable, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Merges many pieces of up to ``width`` bytes (a power of two), one tree per row of an array.

    Returns the ids of all pieces one after another, and how many each has.
    """
    m, w = len(pieces), width
    lengths = np.fromiter(map(len, pieces), np.int64, m)
    ids = np.full((m, w), -1, np.int64)
    inside = np.arange(w) < lengths[:, None]
    ids[inside] = pairs.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
    after = np.broadcast_to(np.arange(1, w + 1), (m, w)).copy()  # next live position
    before = np.broadcast_to(np.arange(-1, w - 1), (m, w)).copy()
    nodes = np.full((m, 2 * w), NO_RANK * w, np.int32)
    nodes[:, w:] += np.arange(w, dtype=np.int32)
    nodes[:, w : 2 * w - 1] = pairs(ids[:, :-1], ids[:, 1:]) * w + np.arange(w - 1)
    for i in range(w - 1, 0, -1):
        nodes[:, i] = np.minimum(nodes[:, 2 * i], nodes[:, 2 * i + 1])
    flat = nodes.reshape(-1)

    def put(row: np.ndarray, position: np.ndarray, rank: np.ndarray) -> None:
        base, i = row * (2 * w), position + w
        flat[base + i] = rank * w + position
        for _ in range(w.bit_length() - 1):
            i >>= 1
            left = base + 2 * i
            flat[base + i] = np.minimum(flat[left], flat[left + 1])

    row = np.flatnonzero(nodes[:, 1] < NO_RANK * w)
    while row.size:
        rank, at = np.divmod(nodes[row, 1], w)
        gone = after[row, at]
        beyond = after[row, gone]
        ids[row, at], ids[row, gone] = rank, -1
        after[row, at] = beyond
        more = beyond < w
        before[row[more], beyond[more]] = at[more]
        right = np.where(more, ids[row, np.minimum(beyond, w - 1)], -1)
        left = before[row, at]
        some = left >= 0
        # Leaves are set in this order, and every parent after its last changed leaf.
        rows = np.concatenate([row, row, row[some]])
        places = np.concatenate([gone, at, left[some]])
        fresh = pairs(
            np.concatenate([rank, ids[row[some], left[some]]]), np.concatenate([right, rank[some]])
        )
        put(rows, places, np.concatenate([np.full(row.size, NO_RANK), fresh]))
        row = row[nodes[row, 1] < NO_RANK * w]
    live = ids >= 0
    return ids[live], live.sum(1)


class PieceIds(dict):
    """Ids of pieces as little-endian bytes; forgets everything when it is full, so memory is bounded."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.pairs = ranks, PairTable(ranks)
        self.by_bytes = all(bytes([i]) in ranks for i in range(256))

    def look_up(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece; the unknown ones are merged together."""
        if len(self) >= MEMORY:
            self.clear()
        found = list(map(self.get, pieces))
        unknown = [i for i, ids in enumerate(found) if ids is None]
        self.learn({pieces[i] for i in unknown})
        for i in unknown:
            found[i] = self[pieces[i]]
        return found

    def learn(self, pieces: set[str]) -> None:
        """Merges pieces not known yet, short ones side by side."""
        classes: dict[int, list[str]] = {}
        for piece in pieces:
            data = piece.encode()
            whole = self.ranks.get(data)
            if whole is not None:
                self[piece] = whole.to_bytes(4, "little")
            elif len(data) <= MEMORY_BYTES and self.by_bytes:
                classes.setdefault(1 << max(len(data) - 1, 1).bit_length(), []).append(piece)
            else:
                self[piece] = np.array(merge_piece(data, self.ranks), "<u4").tobytes()
        for width, members in classes.items():
            for start in range(0, len(members), ROWS):
                part = members[start : start + ROWS]
                ids, counts = merge_pieces([x.encode() for x in part], self.pairs, width)
                packed, ends = ids.astype("<u4").tobytes(), (np.cumsum(counts) * 4).tolist()
                self.update(zip(part, map(packed.__getitem__, map(slice, [0, *ends], ends))))


@lru_cache(maxsize=4)
def memory_of(path: str) -> PieceIds:
    return PieceIds(ranks_of(path))


def _ranges(first: str) -> str:
    """Body of a character class: all characters whose Unicode category starts with ``first``."""
    inside = [unicodedata.category(chr(i))[0] == first for i in range(sys.maxunicode + 1)]
    edges = np.flatnonzero(np.diff(np.array([False, *inside, False]).astype(np.int8)))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in edges.reshape(-1, 2).tolist())


# The Unicode property White_Space, which the tokenizer's \s means.
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


@lru_cache(maxsize=4)
def pattern_of(pattern: str) -> re.Pattern:
    """``pattern`` for the standard library: property classes and white space written out as ranges."""
    body = {r"\p{L}": _ranges("L"), r"\p{N}": _ranges("N"), r"\s": SPACES}
    out, inside = [], False
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.S):
        inside = (inside or part == "[") and part != "]"
        if part == r"\S" and not inside:
            out.append(f"[^{SPACES}]")
        elif part in body:
            out.append(body[part] if inside else f"[{body[part]}]")
        else:
            out.append(part)
    return re.compile("".join(out))


@lru_cache(maxsize=4)
def plain_pattern_of(pattern: str) -> re.Pattern | None:
    """``pattern`` by the built-in classes, which match several times as fast. It means the same in a
    text without RARE characters. None where the pattern uses classes in another way."""
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\w]|_)")
    plain = plain.replace(r"\p{L}", r"[^\W\d_]").replace(r"\p{N}", r"\d")
    return None if r"\p" in plain else re.compile(plain)


@lru_cache(maxsize=1)
def rare_characters() -> frozenset[str]:
    """Characters that the built-in classes place elsewhere: numerals that are no decimal digits, and
    the separators that count as white space only there."""
    odd = (i for i in range(sys.maxunicode + 1) if unicodedata.category(chr(i)) in ("Nl", "No"))
    return frozenset(map(chr, [*range(0x1C, 0x20), *odd]))


@lru_cache(maxsize=1)
def rare_latin() -> re.Pattern:
    return re.compile("[" + "".join(x for x in rare_characters() if x < "\u0100") + "]")


def is_plain(text: str) -> bool:
    """True if no character of ``text`` is rare."""
    if rare_latin().search(text):
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return rare_characters().isdisjoint(text)
    return True


def pieces_of(text: str, pattern: str) -> list[str]:
    plain = plain_pattern_of(pattern)
    return (plain if plain and is_plain(text) else pattern_of(pattern)).findall(text)


def encode_texts(texts: list[str | None], path: str, pattern: str) -> list[bytes]:
    """Ids of whole texts as little-endian unsigned 32-bit integers."""
    pieces = [pieces_of(x or "", pattern) for x in texts]
    found = iter(memory_of(path).look_up(list(chain.from_iterable(pieces))))
    return [b"".join(islice(found, len(x))) for x in pieces]


def encode_text(text: str, path: str, pattern: str) -> bytes:
    return encode_texts([text], path, pattern)[0]


def decode_ids(ids: bytes, path: str) -> bytes:
    tokens = tokens_of(path)
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def _with_binary(df: DataFrame, source: str, name: str, convert) -> DataFrame:
    """``df`` with a binary column made from each value of ``source``."""
    kept = [c for c in df.columns if c != name]
    schema = StructType([*(df.schema[c] for c in kept), StructField(name, BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in batches_of(batch.column(source), SLICE):
                part = batch.slice(start, stop - start)
                made = pa.array(convert(part.column(source).to_pylist()), pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), made], [*kept, name])

    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids`` of every whole text; ids are packed little-endian 32-bit integers.

    ``path`` is the rank file's place on every worker.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    made = _with_binary(rows, "text", "ids", lambda texts: encode_texts(texts, path, pattern))
    return made.select(F.col("key").alias(key), "ids")


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """``encoded`` with ``bytes``, the bytes that its ids stand for. NULL ids count as none."""
    rows = encoded.select(F.col(key).alias("key"), "ids")
    made = _with_binary(rows, "ids", "bytes", lambda ids: [decode_ids(x or b"", path) for x in ids])
    return made.select(F.col("key").alias(key), "ids", "bytes")


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: number of tokens, digest of its ids, digest of the bytes decoded from them."""
    coded = decode(encode(docs, path, pattern), path)
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
