import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from logweir.llm import bpe
from logweir.llm.queries import QUERIES, tokenizer_path

PATH, PATTERN = tokenizer_path(), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={}
    )


def ids(text):
    return np.frombuffer(bpe.encode_text(text, PATH, PATTERN), "<u4").tolist()


def texts():
    draw = random.Random(5)
    pools = [range(32, 127), range(1, 0xD7FF), range(0x1F300, 0x1F700), (9, 10, 13, 32, 0x85, 0x1C, 0xA0)]
    yield from ("", " ", "\n\n x", "it's  we'll\t", "a" * 3000, "ab" * 2000, "½² Ⅷ\x1cx\x85 ٣", "<|endoftext|>")
    for _ in range(60):
        yield "".join(chr(draw.choice(draw.choice(pools))) for _ in range(draw.randrange(1, 200)))


def test_same_ids_as_library_and_exact_round_trip(library):
    for text in texts():
        assert ids(text) == library.encode_ordinary(text), repr(text[:60])
        assert bpe.decode_ids(bpe.encode_text(text, PATH, PATTERN), PATH) == text.encode()


def test_single_and_side_by_side_merges_agree():
    ranks, pairs = bpe.ranks_of(PATH), bpe.memory_of(PATH).pairs
    draw = random.Random(3)
    pieces = [bytes(draw.choice(b"abcthein \xc3\xa9") for _ in range(draw.randrange(9, 17))) for _ in range(300)]
    pieces = [p for p in pieces if p not in ranks]
    flat, counts = bpe.merge_pieces(pieces, pairs, 16)
    ends = np.cumsum(counts)
    for piece, stop, n in zip(pieces, ends, counts):
        assert flat[stop - n : stop].tolist() == bpe.merge_piece(piece, ranks)


def test_long_piece_is_not_quadratic(library):
    text = "q" * 60_000
    assert ids(text) == library.encode_ordinary(text)


def test_whole_tables(spark, sf_dir, library):
    got = {r.doc_id: r for r in QUERIES["op5_byte_bpe"](spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        expected = library.encode_ordinary(r.text or "")
        assert got[r.doc_id].n_tokens == len(expected)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(np.array(expected, "<u4").tobytes()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_nulls_repeats_and_empty_tables(spark, docs_of):
    docs = docs_of([(1, None), (1, None), (None, "ab"), (2, ""), (3, "x" * 5000)])
    got = sorted((r.doc_id or -1, r.n_tokens) for r in bpe.token_digests(docs, PATH, PATTERN).collect())
    assert [x[:1] for x in got] == [(-1,), (1,), (1,), (2,), (3,)]
    assert [n for d, n in got if d in (1, 2)] == [0, 0, 0]
    assert bpe.token_digests(docs.limit(0), PATH, PATTERN).count() == 0
