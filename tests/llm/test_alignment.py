import hashlib
import json
import random
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from logweir.llm import alignment
from logweir.llm.queries import QUERIES

PATHS = tuple(map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def library():
    """The byte-level side by the library alone."""
    tokenizer = Tokenizer.from_file(PATHS[0])
    tokenizer.encode_special_tokens = True
    encode = lambda texts: [x.ids for x in tokenizer.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    return alignment.Vocabulary(alignment.byte_level(PATHS[0], public_tokenizers.PATTERN).tokens, encode)


def groups_of(text, left, right):
    """Groups by walking both sides, or None where a text has no tokens."""
    if not text:
        return None
    a, b = left.encode([text])[0], right.encode([text])[0]
    plain = b" " + text.encode()
    if b"".join(left.tokens[i] for i in a) != plain or b"".join(right.tokens[i] for i in b) != plain:
        return None
    groups, i, j = [], 0, 0
    while i < len(a):
        end_a, end_b, x, y = len(left.tokens[a[i]]), len(right.tokens[b[j]]), i + 1, j + 1
        while end_a != end_b:
            if end_a < end_b:
                end_a, x = end_a + len(left.tokens[a[x]]), x + 1
            else:
                end_b, y = end_b + len(right.tokens[b[y]]), y + 1
        groups.append((a[i:x], b[j:y]))
        i, j = x, y
    assert j == len(b)
    return groups


def plain(rows):
    left, right = library(), alignment.piecewise(PATHS[1])
    found = [(r.doc_id, groups_of(r.text, left, right)) for r in rows]
    counts = Counter()
    for _, groups in found:
        counts.update({(x, y) for a, b in groups or () for x in a for y in b})
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    for doc_id, groups in found:
        if groups is None:
            yield (doc_id, 0, 0, 0, 0, 0, 0, "")
            continue
        links = [(x, y) for a, b in groups for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        yield (
            doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
            sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest(),
        )


def found(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def texts():
    draw = random.Random(11)
    pools = [range(32, 127), range(1, 0xD7FF), range(0x1F300, 0x1F700), (9, 10, 13, 32, 0xA0), range(0x4E00, 0x4F00)]
    yield from ("", " ", "\n\n x", "  a   b", "q" * 5000, "ab" * 900, "<|endoftext|> <unk> </s> <0x41>", "a▁b", "①½ ﬁ")
    for _ in range(40):
        yield "".join(chr(draw.choice(draw.choice(pools))) for _ in range(draw.randrange(1, 200)))
    for _ in range(40):
        yield "".join(chr(draw.choice(pools[0])) for _ in range(draw.randrange(1, 300)))


def test_cuts_are_all_common_ends():
    draw = np.random.default_rng(3)
    for n in (1, 2, 3, 10, 100, 1000):
        for share in (0.02, 0.3, 0.9):
            ends = np.arange(1, 4 * n + 1)
            a, b = (np.union1d(ends[draw.random(ends.size) < share], [4 * n]) for _ in range(2))
            cuts = alignment.shared_cuts(a, b, np.array([a.size - 1]))
            assert a[cuts].tolist() == np.intersect1d(a, b).tolist()


def test_whole_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert found(QUERIES["op11_token_alignment"](spark, sf_dir)) == sorted(plain(rows), key=str)


@pytest.mark.parametrize("limit", [alignment.BROADCAST, 0])
def test_odd_texts_nulls_and_repeats(spark, docs_of, monkeypatch, limit):
    monkeypatch.setattr(alignment, "BROADCAST", limit)
    rows = [(i, x) for i, x in enumerate(texts())]
    rows += [(1, "one more"), (1, "one more"), (None, "no id"), (None, None), (500, None), (501, "word " * 40_000)]
    docs = docs_of(rows)
    got = found(alignment.token_links(docs, *PATHS, public_tokenizers.PATTERN))
    assert got == sorted(plain(docs.collect()), key=str)
    assert sum(r[1] > 0 for r in got) > 40


def test_empty_table(spark, docs_of):
    assert found(alignment.token_links(docs_of([(1, "x")]).limit(0), *PATHS, public_tokenizers.PATTERN)) == []


def test_ids_are_the_librarys_for_every_familiar_character():
    familiar = [chr(c) for c in range(0x10000) if not alignment.UNFAMILIAR.search(chr(c))]
    rows = [f"a{c}1{c}{c} {c}b  {c}\n{c}'s{c}" for c in familiar] + list(texts())
    assert len(familiar) > 1000
    got = alignment.byte_level(PATHS[0], public_tokenizers.PATTERN).encode(rows)
    assert list(map(list, got)) == library().encode(rows)


def test_a_pair_that_merges_first_has_the_lower_id():
    model = json.loads(Path(PATHS[0]).read_text())["model"]
    made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    assert made == sorted(made) and not model.get("ignore_merges")
