import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from logweir.llm import bwt, repeats
from logweir.llm.queries import QUERIES

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def plain(rows, length):
    """Every window counted in a dictionary."""
    texts = [(r.doc_id, (r.text or "").encode()) for r in rows]
    seen = Counter(x[i : i + length] for _, x in texts for i in range(len(x) - length + 1))
    for doc_id, x in texts:
        gone = np.zeros(len(x), bool)
        for i in range(len(x) - length + 1):
            if seen[x[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(x, np.uint8)[~gone])
        yield (doc_id, len(x), int(gone.sum()), len(repeats.runs(gone)), hashlib.sha256(kept).hexdigest())


def found(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


def texts(seed):
    """Random words, with passages, near copies and repeats inside a text."""
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdeé") for _ in range(draw.randrange(1, 7))) for _ in range(60)]
    some = lambda n: " ".join(draw.choice(words) for _ in range(n))
    common = [some(n) for n in (2, 5, 12, 20, 40)]
    for i in range(120):
        parts = [some(draw.randrange(0, 25)) for _ in range(3)]
        for _ in range(draw.randrange(3)):
            parts.insert(draw.randrange(4), draw.choice(common))
        text = "".join(parts)
        yield i, text
        if i % 9 == 0:
            changed = list(text)
            for _ in range(2):
                if changed:
                    changed[draw.randrange(len(changed))] = "Z"
            yield 1000 + i, "".join(changed)


@pytest.mark.parametrize("seed", range(4))
def test_merged_transforms_find_all_repeated_places(seed):
    draw = np.random.default_rng(seed)
    strings = [bytes(draw.integers(97, 99 + seed, draw.integers(20, 70)).astype(np.uint8)) for _ in range(40)]
    strings += [strings[3], strings[5][:25] + strings[6][3:], b"a" * 50]
    for shard in (64, 300, 10**6):
        repeats.SHARD, kept = shard, repeats.SHARD
        got = repeats.repeated_in(strings, 20, repeats.Hashes())
        repeats.SHARD = kept
        seen = Counter(x[i : i + 20] for x in strings for i in range(len(x) - 19))
        for x, flags in zip(strings, got):
            assert flags.tolist() == [seen[x[i : i + 20]] > 1 for i in range(len(x) - 19)]


def test_merge_orders_as_a_sort_does():
    draw = np.random.default_rng(7)
    strings = [bytes(draw.integers(97, 99, draw.integers(8, 30)).astype(np.uint8)) for _ in range(30)]
    ends = np.cumsum([len(x) + 1 for x in strings])
    starts, stops = ends - [len(x) + 1 for x in strings], ends - 1
    whole = np.frombuffer(b"".join(x + b"\0" for x in strings), np.uint8)
    names = np.where(np.isin(np.arange(whole.size), stops), 0, whole.astype(np.int64) - 96)
    one = bwt.transform(names[: ends[11]], starts[:12], stops[:12], 1)
    two = bwt.transform(names[ends[11] :], starts[12:] - ends[11], stops[12:] - ends[11], 1, ends[11])
    both, shared = bwt.merged(one, two, 100)
    everything = bwt.transform(names, starts, stops, 1)
    assert both.places.tolist() == everything.places.tolist()
    assert both.letters.tolist() == everything.letters.tolist()
    suffix = lambda p: bytes(whole[p : stops[np.searchsorted(stops, p)]])
    for a, b, n in zip(both.places, both.places[1:], shared[1:]):
        x, y = suffix(a), suffix(b)
        same = next((i for i, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))
        assert same == n


@pytest.mark.parametrize("hot", [repeats.HOT, 500, 0])
def test_same_as_counting_windows(spark, docs_of, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    docs = docs_of(texts(5))
    got = found(repeats.without_repeats(docs, 40))
    assert got == sorted(plain(docs.collect(), 40), key=str)
    assert sum(r[2] > 0 for r in got) > 20 and sum(r[2] == 0 for r in got) > 20


def test_nulls_repeats_and_long_texts(spark, docs_of, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 1000)
    draw = random.Random(4)
    long = "".join(draw.choice("abcdefgh ") for _ in range(7000))
    rows = [(1, None), (1, ""), (None, "x" * 39), (2, "y" * 41), (3, "the same text twice, as a whole, and longer")]
    rows += [(3, "the same text twice, as a whole, and longer"), (4, long), (5, "é" * 30 + long[3000:3100] + "ß"), (6, "z" * 40)]
    docs = docs_of(rows)
    got = found(repeats.without_repeats(docs, 40))
    assert got == sorted(plain(docs.collect(), 40), key=str)
    assert found(repeats.without_repeats(docs.limit(0), 40)) == []


def test_only_units_of_anchors_that_occur_again_are_kept(spark, docs_of, monkeypatch):
    kept, gone, write = {}, [], repeats.staged

    def staged(df, name):
        out = write(df, name)
        kept[name] = out.count()
        return out

    drop = repeats.dropped if hasattr(repeats, "dropped") else lambda df: None
    monkeypatch.setattr(repeats, "staged", staged)
    monkeypatch.setattr(repeats, "dropped", lambda df: (gone.append(df), drop(df)), raising=False)
    draw = random.Random(3)
    some = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    common = some(60)
    rows = [(i, some(300)) for i in range(30)] + [(100 + i, some(50) + common + some(50)) for i in range(2)]
    docs = docs_of(rows)
    got = found(repeats.without_repeats(docs, 40))
    assert got == sorted(plain(docs.collect(), 40), key=str)
    assert [r[2] for r in got if r[0] >= 100] == [60, 60]
    assert kept["repeats-kinds"] < 30  # of some hundred units
    assert len(gone) == len(kept) - 1  # the spans remain


def test_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = QUERIES["op13_repeated_strings"](spark, sf_dir)
    assert got.columns == COLUMNS
    assert found(got) == sorted(plain(rows, 400), key=str)
