import hashlib

from logweir.llm import fingerprints as fp
from logweir.llm.queries import QUERIES


def check(rows, docs):
    """``docs``: (doc_id, text), ids distinct."""
    order = sorted(docs, reverse=True)
    after = {d: order[(i + 1) % len(order)] for i, (d, _) in enumerate(order)}
    texts, got = {d: t or "" for d, t in docs}, {r.doc_id: r for r in rows}
    assert len(rows) == len(docs)
    for d, text in texts.items():
        r, (next_id, following) = got[d], after[d]
        half = len(text) // 2
        edited = text[: len(text) - half] + (following or "")[:half]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest(), d
        a, e, n = (int(x, 16) for x in (r.fingerprint, r.edited_fingerprint, got[next_id].fingerprint))
        assert r.near_edited == 1 - (a ^ e).bit_count() / 64 and r.near_next == 1 - (a ^ n).bit_count() / 64
        others = {int(x.fingerprint, 16) for x in rows} - {a}
        assert r.neighboured == any((a ^ o).bit_count() <= 3 for o in others)
    by_text = {}
    for d, text in texts.items():
        assert by_text.setdefault(text, got[d].fingerprint) == got[d].fingerprint


def test_whole_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = QUERIES["op6_fingerprints"](spark, sf_dir).collect()
    check(rows, docs)
    long = [r for r in rows if r.n_chars > 500]
    assert sum(r.near_edited > r.near_next for r in long) / len(long) > 0.9


def test_votes_of_a_known_text(spark):
    frame = spark.createDataFrame([(1, "a b a b a"), (2, ""), (3, "one"), (4, " \n")], "d long, text string")
    got = {r.d: r.p % (1 << 64) for r in fp.votes(frame, ["d"], "text", "p").collect()}
    h = {
        k: spark.sql(f"select xxhash64({k})").first()[0] % (1 << 64)
        for k in ("'a', 'b'", "'b', 'a'", "'a', null", "'one', null")
    }
    terms = [h["'a', 'b'"]] * 2 + [h["'b', 'a'"]] * 2 + [h["'a', null"]]
    assert got[1] == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in terms) > 5)
    assert got[2] == got[4] == 0 and got[3] == h["'one', null"]


def test_block_tables_find_everything(spark):
    import random

    draw = random.Random(6)
    prints = []
    for _ in range(60):
        x = draw.getrandbits(64)
        prints += [x, *(x ^ sum(1 << b for b in draw.sample(range(64), n)) for n in (1, 2, 3, 4, 5))]
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    frame = spark.createDataFrame(signed, "print long")
    near = lambda a, b: (a ^ b).bit_count() <= 3
    pairs = {(q.query % (1 << 64), q.print % (1 << 64)) for q in fp.within_radius(frame.limit(30), frame).collect()}
    queries = {r.print % (1 << 64) for r in frame.limit(30).collect()}
    assert pairs == {(q, p) for q in queries for p in prints if near(q, p)}
    met = {r.print % (1 << 64) for r in fp.neighboured(frame).collect()}
    assert met == {p for p in prints if any(p != q and near(p, q) for q in prints)}


def test_edge_cases(spark, docs_of):
    docs = [(5, None), (9, ""), (2, "é😀" * 40), (7, "x " * 20_000), (1, "only"), (-3, "a b c")]
    check(fp.fingerprinted(docs_of(docs)).collect(), docs)
    check(fp.fingerprinted(docs_of([(4, "alone here")])).collect(), [(4, "alone here")])
    rows = fp.fingerprinted(docs_of([(None, "abcd"), (None, "ef"), (3, "wxyz"), (3, "wxyz"), (1, "1234")])).collect()
    assert len(rows) == 5
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted(r.edited_sha256 for r in rows if r.doc_id is None) == sorted([sha("abwx"), sha("ew")])
    assert {r.edited_sha256 for r in rows if r.doc_id == 3} == {sha("wx12")}
    assert fp.fingerprinted(docs_of([(1, "a")]).limit(0)).count() == 0
    assert len(fp.fingerprinted(docs_of([(None, "abcd")])).collect()) == 1
