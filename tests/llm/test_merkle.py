import hashlib
import random
import zlib

import pytest

from logweir.llm import merkle
from logweir.llm.queries import QUERIES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    parts = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return sha("".join("-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts))


def plain(rows):
    """The manifest by loops: (doc_id, leaf, subroot, root, proof, folded, verified) of every row."""
    by_source = {}
    for r in rows:
        text = r.text
        if text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
            text = text.replace("\n", "")
        by_source.setdefault(r.source, []).append((r.doc_id, leaf(r, r.text), leaf(r, text)))

    def climb(nodes, paths):
        """``paths``: for every node the indexes of the leaves below; returns the top and fills proofs."""
        while len(nodes) > 1:
            above, below = [], []
            for i in range(0, len(nodes), 3):
                run = nodes[i : i + 3]
                for j, node in enumerate(run):
                    for proof in paths[i + j]:
                        proof.append(("".join(run[:j]), "".join(run[j + 1 :])))
                above.append(sha("".join(run)))
                below.append([p for x in paths[i : i + 3] for p in x])
            nodes, paths = above, below
        return nodes[0], paths[0]

    tops, below, out = [], [], []
    for source in sorted(by_source, key=lambda s: (s is not None, (s or "").encode())):
        leaves = sorted(by_source[source], key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        proofs = [[] for _ in leaves]
        top, _ = climb([x[1] for x in leaves], [[p] for p in proofs])
        tops.append(top)
        below.append(proofs)
        out += [(*x, top, p) for x, p in zip(leaves, proofs)]
    if not out:
        return []
    root, _ = climb(tops, below)
    done = []
    for doc_id, own, shown, top, proof in out:
        at = shown
        for left, right in proof:
            at = sha(left + at + right)
        siblings = sha("".join(left + right for left, right in proof))
        done.append((doc_id, own, top, root, siblings, at, at == root))
    return done


def found(df):
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, df.collect()), key=str)


def expected(rows):
    return sorted(plain(rows), key=str)


def test_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = found(QUERIES["op12_merkle_manifest"](spark, sf_dir))
    assert got == expected(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("sizes", [(1,), (2,), (3,), (4,), (1, 1), (1, 1, 1, 1), (10, 1, 27, 28, 1), (82, 3, 1, 9)])
def test_shapes(spark, docs_of, sizes):
    draw = random.Random(sum(sizes))
    rows = []
    for s, n in enumerate(sizes):
        source = None if s == 1 else f"s{s}é"
        rows += [(draw.randrange(10**6), f"text {i}\nand more", source) for i in range(n)]
    docs = docs_of(rows)
    assert found(merkle.manifest(docs)) == expected(docs.collect())


def test_nulls_repeats_and_empty_tables(spark, docs_of):
    rows = [(7, "a\nb", "x"), (7, "a\nb", "x"), (7, "other", "x"), (None, "n\nn", "x"), (None, None, None)]
    rows += [(8, None, "x"), (8, "", "x"), (2**40, "long " * 50_000, "x")]
    docs = docs_of(rows)
    assert found(merkle.manifest(docs)) == expected(docs.collect())
    assert found(merkle.manifest(docs.limit(0))) == []


def test_one_changed_text_changes_the_root(spark, docs_of):
    rows = [(i, f"text {i}", "s") for i in range(30)]
    one = merkle.manifest(docs_of(rows)).first()["root"]
    rows[17] = (17, "text 17.", "s")
    assert merkle.manifest(docs_of(rows)).first()["root"] != one
