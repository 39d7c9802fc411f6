"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of n-grams (one to three characters, lower-cased, with spaces at the ends) are added up per language
over a bounded sample of rows, each task giving one row per language and bucket that occurs. The matrix of log
probabilities (languages x buckets, its size independent of the documents) is broadcast; tasks score batches
of texts in numpy by looking up the batch's n-grams and summing them per text.

Defined results: a text that is NULL or has no letter is ``und`` with score 0, as is everything if nothing was
learned; ties go to the first language in code point order; every row gives a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, hash_sample, id_remainder

BITS = 15
ORDERS = (1, 2, 3)
#: Rows learned from, at most in expectation.
SAMPLE = 30_000
FOLDS, HELD_OUT = 3, 1
UNKNOWN = "und"
SLICE = 2 << 20


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all texts, one after another, and where each text's begin.

    Every text is preceded by a space and followed by one; no n-gram reaches into another text.
    """
    padded = [f" {x.lower()}  " for x in texts]
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    starts = np.cumsum(sizes) - sizes
    points = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32)
    n = points.size - 2
    buckets = np.empty((n, len(ORDERS)), np.uint32)
    for column, order in enumerate(ORDERS):
        value = np.full(n, order, np.uint32)
        for i in range(order):
            value = (value ^ points[i : i + n]) * np.uint32(0x9E3779B1)
            value ^= value >> np.uint32(15)
        buckets[:, column] = value >> np.uint32(32 - BITS)
    # The last n-grams of all texts but the last would begin in their second closing space.
    inside = np.ones(n, bool)
    inside[starts[1:] - 1] = inside[starts[1:] - 2] = False
    return buckets[inside], starts - 2 * np.arange(len(texts))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text[:64])) or any(map(str.isalpha, text[64:]))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    prior: np.ndarray
    logs: np.ndarray  # buckets x languages

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        known = [bool(self.languages) and x is not None and has_letter(x) for x in texts]
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        where = np.flatnonzero(known)
        if where.size:
            buckets, starts = grams([texts[i] for i in where])
            totals = np.empty((where.size, len(self.languages)))
            for k in range(len(self.languages)):
                per_place = self.logs[:, k][buckets].sum(axis=1, dtype=np.float32)
                totals[:, k] = self.prior[k] + np.add.reduceat(per_place, starts, dtype=np.float64)
            best = totals.argmax(axis=1)
            scores[where] = 1 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
            for i, b in zip(where, best):
                names[i] = self.languages[b]
        return names, scores


def learn(docs: DataFrame, rows: int = SAMPLE) -> Model:
    """A model from the text and language of rows outside the held-out fold, ``rows`` of them at most."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.where(F.coalesce(id_remainder("doc_id", FOLDS) != HELD_OUT, F.lit(False)))
    known = hash_sample(known.select("doc_id", "lang", "text"), "doc_id", rows, seed=5)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        texts: dict[str, int] = {}
        for batch in batches:
            for start, stop in batches_of(batch.column("text"), SLICE):
                part = batch.slice(start, stop - start)
                langs = np.array(part.column("lang").to_pylist(), dtype=object)
                values = np.array(part.column("text").to_pylist(), dtype=object)
                for lang in dict.fromkeys(langs):
                    mine = list(values[langs == lang])
                    counted = np.bincount(grams(mine)[0].ravel(), minlength=1 << BITS)
                    totals[lang] = totals.get(lang, 0) + counted
                    texts[lang] = texts.get(lang, 0) + len(mine)
        for lang, counted in totals.items():
            places = np.flatnonzero(counted)
            # Bucket -1 counts the texts.
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * (places.size + 1)),
                    pa.array(np.append(places, -1), pa.int32()),
                    pa.array(np.append(counted[places], texts[lang]), pa.int64()),
                ],
                ["lang", "bucket", "n"],
            )

    counts = known.select("lang", "text").mapInArrow(count, "lang string, bucket int, n long")
    # Languages x buckets rows, whatever the number of documents.
    sums = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names, bucket, n = (sums.column(c).to_numpy(zero_copy_only=False) for c in ("lang", "bucket", "n"))
    languages = sorted(set(names.tolist()))
    matrix, texts = np.zeros((1 << BITS, len(languages))), np.zeros(len(languages))
    for k, name in enumerate(languages):
        own, rest = (names == name) & (bucket >= 0), (names == name) & (bucket < 0)
        matrix[bucket[own], k], texts[k] = n[own], n[rest].sum()
    smooth = 0.5
    logs = np.log(matrix + smooth) - np.log(matrix.sum(axis=0) + smooth * matrix.shape[0])
    return Model(languages, np.log(texts / max(texts.sum(), 1)), logs.astype(np.float32))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row of ``docs``; only the text decides."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in batches_of(batch.column("text"), SLICE):
                part = batch.slice(start, stop - start)
                names, scores = shared.value.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)],
                    ["doc_id", "lang_pred", "score"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def predictions(docs: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs``."""
    held = F.coalesce(id_remainder("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return identify(docs, learn(docs, rows)).select("doc_id", held.alias("held_out"), "lang_pred", "score")
