import zlib

import numpy as np

from logweir.llm import language
from logweir.llm.queries import QUERIES


def test_held_out_rows(spark, sf_dir):
    rows = {r.doc_id: r for r in QUERIES["op9_language_id"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(rows) == len(docs)
    held = [(rows[d.doc_id].lang_pred, d.lang) for d in docs if rows[d.doc_id].held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    assert len(held) > 40 and sum(a == b for a, b in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_scores_equal_a_plain_sum():
    draw = np.random.default_rng(3)
    model = language.Model(["a", "b", "c"], np.log([0.5, 0.3, 0.2]), draw.normal(size=(1 << language.BITS, 3)).astype(np.float32))
    texts = ["Hello wörld", "é", "x" * 500, "1 2", None, "aß\n b"]
    names, scores = model.predict(texts)
    for text, name, score in zip(texts, names, scores):
        if text in ("1 2", None):
            assert (name, score) == ("und", 0)
            continue
        buckets, _ = language.grams([text])
        total = model.prior + model.logs.astype(float)[buckets.ravel()].sum(axis=0)
        chances = np.exp(total - total.max())
        assert name == "abc"[int(total.argmax())] and abs(score - (chances / chances.sum()).max()) < 1e-3


def test_edge_cases(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (None, "the a"), (30, "x" * 50_000), (30, "the cat"), (4, "!! 12")] + [(i, "le chat") for i in range(40, 50)])
    rows = language.predictions(docs).collect()
    assert len(rows) == 16
    assert sum(r.lang_pred == "und" for r in rows) == 3
    assert language.predictions(docs.limit(0)).count() == 0
    unlearned = docs.withColumn("lang", docs["lang"].substr(9, 9)).where("doc_id = 99")
    assert {r.lang_pred for r in language.identify(docs, language.learn(unlearned)).collect()} == {"und"}
