import random

import numpy as np
import xxhash

from logweir.llm import bktree, graph, simhash
from logweir.llm.queries import QUERIES


def brute_print(text, n=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    runs = [b" ".join(words[i : i + n]) for i in range(max(len(words) - n + 1, min(len(words), 1)))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, linked):
    """Component id of each (id, print) by flooding."""
    ids, out = sorted(prints), {}
    for i in ids:
        if i in out:
            continue
        todo, out[i] = [i], i
        while todo:
            x = todo.pop()
            for y in ids:
                if y not in out and linked(x, y):
                    out[y] = i
                    todo.append(y)
    return out


def test_tree_finds_exactly_what_brute_force_finds():
    draw = np.random.default_rng(1)
    base = draw.integers(0, 2**63, 40).astype(np.uint64)
    prints = np.unique(np.concatenate([base ^ (np.uint64(1) << np.uint64(b)) for b in range(0, 60, 7)] + [base]))
    prints = np.stack([prints, np.zeros_like(prints)], axis=1)
    for radius in (0, 1, 2, 5):
        got = {(q, n) for part in bktree.BKTree(prints).search(prints, radius) for q, n in zip(*map(list, part[:2]))}
        d = bktree.distance(prints[:, None], prints[None, :])
        assert got == set(zip(*map(list, np.nonzero(d <= radius))))


def test_shard_links_keep_components():
    draw = np.random.default_rng(2)
    prints = np.unique(draw.integers(0, 2**12, 600).astype(np.uint64))
    prints = np.stack([prints, np.zeros_like(prints)], axis=1)
    a, b, _, _ = bktree.shard_links(prints, 1)
    assert len(a) <= 2 * len(prints)
    links = {(int(x), int(y)) for x, y in zip(a, b)} | {(int(y), int(x)) for x, y in zip(a, b)}
    d = bktree.distance(prints[:, None], prints[None, :])
    ids = dict.fromkeys(range(len(prints)))
    assert brute_components(ids, lambda x, y: (x, y) in links) == brute_components(ids, lambda x, y: d[x, y] <= 1)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100 + i, 99) for i in range(1, 60)] + [(7, 7), (3, 2), (2, 3)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {99: 99} | {100 + i: 99 for i in range(1, 60)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_whole_table_against_brute_force(spark, sf_dir):
    got = {r.doc_id: r for r in QUERIES["op2_simhash_dedup"](spark, sf_dir).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    prints = {i: brute_print(t) for i, t in texts.items()}
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    expected = brute_components(prints, lambda x, y: (prints[x] ^ prints[y]).bit_count() <= 2)
    assert {i: r.component_id for i, r in got.items()} == expected


def test_planted_close_fingerprints(spark):
    """Fingerprints made by hand: clusters of flips, linked directly and through others."""
    draw = random.Random(4)
    prints = []
    for _ in range(30):
        x = draw.getrandbits(64)
        for _ in range(draw.randrange(1, 12)):
            prints.append(x)
            for _ in range(draw.randrange(1, 3)):
                x ^= 1 << draw.randrange(64)
    prints = dict(enumerate(dict.fromkeys(prints)))
    signed = [(p - (1 << 64) if p >> 63 else p, 0, i) for i, p in prints.items()]
    shards = simhash.block_shards(spark.createDataFrame(signed, "f0 long, f1 long, member long"))
    roots = {r.node: r.root for r in graph.components(simhash.links_of(shards, 2)).collect()}
    expected = brute_components(prints, lambda x, y: (prints[x] ^ prints[y]).bit_count() <= 2)
    assert {i: roots.get(i, i) for i in prints} == expected


def test_edge_cases(spark, docs_of):
    docs = docs_of([(5, None), (4, ""), (4, ""), (9, " \t\n"), (None, "a b c d"), (7, "A B C D"), (8, "one"), (None, "zz")])
    rows = simhash.near_duplicates(docs).collect()
    got = sorted(((r.doc_id or -1, r.fingerprint, r.component_id) for r in rows), key=str)
    assert len(got) == 8
    zero = [c for d, f, c in got if f == "0" * 16]
    assert zero == [4, 4, 4, 4]
    assert {(d, c) for d, f, c in got if f != "0" * 16} == {(-1, 7), (7, 7), (8, 8), (-1, None)}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def words(draw, n):
    return [draw.choice(["alpha", "beta", "gamma", "delta", "pi", "rho", "tau"]) + str(draw.randrange(400)) for _ in range(n)]


def test_checked_groups_catch_edits_and_leave_the_rest(spark, docs_of):
    draw, rows, group = random.Random(9), [], {}
    shared = words(draw, 60)
    for g in range(25):
        base = words(draw, 300)
        for copy in range(4):
            text = list(base)
            for _ in range(copy * 2):
                text[draw.randrange(300)] = "changed"
            rows.append((10 * g + copy, " ".join(text)))
            group[10 * g + copy] = 10 * g
        rows.append((10 * g + 7, " ".join(words(draw, 60) + shared)))  # half of it is a shared passage
        group[10 * g + 7] = 10 * g + 7
    rows += [(1000 + i, None) for i in range(3)]
    group |= {1000 + i: 1000 for i in range(3)}
    got = simhash.near_duplicates(docs_of(rows), words=5, radius=36, alike=0.8).collect()
    assert {r.doc_id: r.component_id for r in got} == group


def test_repeated_lines_do_not_part_equal_sets(spark, docs_of):
    draw, rows = random.Random(11), []
    for g in range(30):
        base, line = words(draw, 104), " ".join(words(draw, 10))
        # Equal sets of shingles: the line follows itself twice or twenty times.
        for times in (2, 20):
            rows.append((len(rows), " ".join(base) + f" {line}" * times))
    found = simhash.near_duplicates(docs_of(rows), words=5, radius=36, alike=0.8).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: i - i % 2 for i in range(len(rows))}


def star(draw, n, lines):
    """An origin and ``n`` copies with other words in a few places each: like the origin, less so each other."""
    origin = [f"w{draw.randrange(10**6)}" for _ in range(300)]
    for _ in range(n):
        copy = list(origin)
        for at in draw.sample(range(0, 300, 6), lines):
            copy[at] = f"x{draw.randrange(10**9)}"
        yield " ".join(copy)
    yield " ".join(origin)


def test_copies_unlike_each_other_meet_their_origin(spark, docs_of):
    # 6 edits of 300 words: 0.82 like the origin, mostly under 0.7 like each other. The origin has the largest id.
    rows = list(enumerate(star(random.Random(12), 700, 6)))
    want = brute_sets(rows)
    assert len(set(want.values())) == 1
    found = simhash.near_duplicates(docs_of(rows), words=5, radius=36, alike=0.8).collect()
    assert {r.doc_id: r.component_id for r in found} == want


def test_large_shards_are_dealt_into_blocks_and_stay_whole(spark, docs_of, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 50)
    shards = spark.range(1000).selectExpr("1L AS k1", "2L AS k2", "id AS member")
    sizes = spark.createDataFrame([(1, 2, 1000)], "k1 long, k2 long, n long")
    counts = [r["count"] for r in simhash.dealt(shards, sizes).groupBy("k1", "k2", "block").count().collect()]
    assert len(counts) == 20 and sum(counts) == 1000 and max(counts) < 100
    rows = list(enumerate(star(random.Random(14), 200, 6)))
    found = simhash.near_duplicates(docs_of(rows), words=5, radius=36, alike=0.8).collect()
    assert {r.doc_id: r.component_id for r in found} == brute_sets(rows)


def brute_sets(rows):
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in rows}
    return brute_components(sets, lambda x, y: len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y]))


def test_true_links_among_many_that_share_a_template(spark, docs_of):
    """150 texts alike by less than 0.8 through a template, and for 10 of them a longer text just over or under it."""
    draw, rows = random.Random(13), []
    shared = [f"t{i}" for i in range(150)]
    for i in range(150):
        own = [f"o{i}-{j}" for j in range(40)]
        rows.append((len(rows), " ".join(shared + own)))
        if i < 10:
            rows.append((len(rows), " ".join(shared + own + [f"n{i}-{j}" for j in range(40)])))
    want = brute_sets(rows)
    assert len(set(want.values())) == 150
    found = simhash.near_duplicates(docs_of(rows), words=5, radius=36, alike=0.8).collect()
    assert {r.doc_id: r.component_id for r in found} == want
