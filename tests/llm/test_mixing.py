import re
from collections import Counter, defaultdict

import pytest

from logweir.llm import mixing
from logweir.llm.queries import QUERIES


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """The rule step by step: give by weight, cut at the cap, give the excess to the others again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    most = {s: cap * sizes[s] for s in names}
    target, full = {}, set()
    while True:
        left = share * sum(sizes.values()) - sum(most[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        target = {s: most[s] if s in full else left * weight[s] / open_weight for s in names}
        over = {s for s in names if s not in full and target[s] >= most[s]}
        if not over:
            return target
        full |= over


def check(rows, docs):
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, _ in docs}
    by_source = defaultdict(int)
    for d, _, s in docs:
        by_source[s] += size[d]
    target, source = brute_targets(by_source), {d: s for d, _, s in docs}
    took = defaultdict(int)
    assert Counter(r.doc_id for r in rows) == Counter(d for d, *_ in docs)
    for r in rows:
        assert r["size"] == size[r.doc_id] and r.source_size == by_source[source[r.doc_id]]
        assert r.target == pytest.approx(target[source[r.doc_id]])
        assert 0 <= r.taken <= 2 * r["size"]
        took[source[r.doc_id]] += r.taken
    for s, words in took.items():
        assert abs(words - target[s]) <= 1, s


def test_whole_table_and_reruns(spark, sf_dir):
    rows = QUERIES["op8_source_mix"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()
    check(rows, [tuple(d) for d in docs])
    again = QUERIES["op8_source_mix"](spark, sf_dir).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_splitting_tree_quotas(spark, sf_dir):
    mix = mixing.Mix(shards=8)
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sized = mixing.quotas(mixing.sizes(rows), mix)
    balls = sized.selectExpr("name", "none", "block", "1L AS copy").distinct()
    total = Counter(r.name for r in balls.collect())
    parts = mixing.urn(balls, mix).collect()
    by_name, by_shard = Counter(), Counter()
    for r in parts:
        by_name[r.name] += r.n
        by_shard[r.shard] += r.n
    assert by_name == total
    assert max(by_shard.values()) - min(by_shard.values()) <= 3 and len(by_shard) == 8


def test_edge_cases(spark, docs_of):
    docs = [(i, "w " * (i % 7), "b") for i in range(1, 40)] + [(50, "one two three", "a"), (51, None, None), (52, "", "")]
    docs += [(53, "x " * 3000, None), (54, "\t\n", "zero"), (55, "é ü ñ", "Z"), (56, "only", "é")]
    frame = docs_of(docs)
    check(mixing.taken_words(frame).collect(), docs)
    repeated = docs_of([(1, "a b c", "s"), (1, "a b c", "s"), (None, "d e", "s"), (None, "d e", None)])
    rows = mixing.taken_words(repeated).collect()
    assert len(rows) == 4 and all(0 <= r.taken <= 2 * r["size"] for r in rows)
    assert mixing.taken_words(frame.limit(0)).count() == 0


def test_mixed_documents_repeat_and_cut(spark, docs_of):
    docs = [(i, " ".join(f"w{i}x{j}" for j in range(5 + i % 9)), "abc"[i % 3]) for i in range(300)]
    frame = docs_of(docs)
    taken = {r.doc_id: r.taken for r in mixing.taken_words(frame).collect()}
    made = mixing.mixed_documents(frame)
    assert made.columns == frame.columns
    words = Counter()
    for r in made.collect():
        words[r.doc_id] += len(r.text.split())
    assert words == Counter({d: n for d, n in taken.items() if n})
