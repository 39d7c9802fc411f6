import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from logweir.llm import bpe, quality
from logweir.llm.queries import tokenizer_path

from test_mixing import brute_targets
from test_secrets import brute


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """What every stage gives, written and read again, with the documents in front."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("pipeline") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def test_all_but_the_last_return_the_columns_of_documents(stages):
    columns = stages["documents"].columns
    assert all(stages[name].columns == columns for name, _ in corpus_pipeline.STAGES[:-1])


def test_quality_keeps_what_is_accepted(spark, sf_dir, stages):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    predicted = quality.classify(stages["documents"], labels).collect()
    assert {r.doc_id for r in stages["quality"].collect()} == {r.doc_id for r in predicted if r.predicted}
    kept = {r.doc_id for r in stages["quality"].collect()}
    good = [r.doc_id for r in labels.where("quality = 1").collect()]
    assert sum(i in kept for i in good) / len(good) > 0.97
    assert len(kept) < stages["documents"].count()


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}


def test_one_of_each_group_stays(stages):
    before = {r.doc_id: shingles(r.text) for r in stages["quality"].collect()}
    kept = {r.doc_id for r in stages["near_duplicates"].collect()}
    ids = sorted(before)
    links = defaultdict(set)
    for a in ids:
        for b in ids:
            if a < b and len(before[a] & before[b]) >= 0.8 * len(before[a] | before[b]):
                links[a].add(b)
                links[b].add(a)
    expected, seen = set(), set()
    for i in ids:
        if i not in seen:
            expected.add(i)
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    todo.extend(links[x])
    assert kept == expected and len(kept) < len(ids)


def test_secrets_are_gone_and_the_rest_is_as_before(stages):
    before = {r.doc_id: r for r in stages["near_duplicates"].collect()}
    after = {r.doc_id: r for r in stages["secrets"].collect()}
    assert set(before) == set(after)
    found = {i for i, r in before.items() if brute(r.text)}
    for i, r in after.items():
        assert not brute(r.text)
        if "[secret]" in (r.text or ""):
            assert r.n_chars == len(r.text)
        else:
            assert r == before[i] and i not in found


def test_mix_meets_the_targets(stages):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    before = {r.doc_id: r for r in stages["secrets"].collect()}
    sizes, took, times = Counter(), Counter(), Counter()
    for r in before.values():
        sizes[r.source] += size(r.text)
    for r in stages["mixing"].collect():
        assert r.source == before[r.doc_id].source
        took[r.source] += size(r.text)
        times[r.doc_id] += size(r.text)
    for source, target in brute_targets(sizes).items():
        assert abs(took[source] - target) <= 1
    assert all(n <= 2 * size(before[i].text) for i, n in times.items())


def test_tokens_are_the_librarys(stages):
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(tokenizer_path()), special_tokens={}
    )
    expected = Counter()
    for r in stages["mixing"].collect():
        ids = library.encode_ordinary(r.text or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        expected[r.doc_id, len(ids), digest, hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in stages["tokens"].collect())
    assert got == expected


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    got = Counter(map(str, corpus_pipeline.run(spark, sf_dir).collect()))
    assert got == Counter(map(str, stages["tokens"].collect()))


def test_stages_take_awkward_rows(spark, docs_of, tmp_path):
    docs = docs_of(
        [(1, None), (2, ""), (2, ""), (None, "a b c"), (None, "a b c"), (None, "z"), (3, "a b c"), (4, None, None)]
        + [(5, "w " * 30_000), (6, "token = 'abcdef'", "é")]
    )
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for make in (docs, docs.limit(0)):
        rows = make
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = f"{tmp_path}/{name}-{make is docs}"
            stage(spark, rows, str(tmp_path)).write.parquet(path)
            rows = spark.read.parquet(path)
            if i < 4:
                assert rows.columns == docs.columns
            if name == "near_duplicates" and make is docs:
                assert sorted((r.doc_id or 0) for r in rows.collect()) == [0, 1, 3, 5, 6]


def test_texts_that_share_an_id_are_documents_of_their_own(spark, sf_dir, docs_of):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    docs = docs_of([(1, a), (1, b), (1, b), (2, c), (None, c), (None, a + " end"), (None, "own words")])
    got = corpus_pipeline.near_duplicates(spark, docs, sf_dir).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, "own words"), (1, a), (1, b), (2, c)]
