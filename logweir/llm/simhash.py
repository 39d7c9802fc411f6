"""SimHash near-duplicates by BK-trees.

Fingerprint: every shingle of words votes with its XXH64 hash; a bit is 1 if it is set in over half the
votes. Distinct fingerprints are dealt into shards so that any two that must be compared meet in at
least one; each shard is one BK-tree, and only edges within the radius are followed.

Two ways to deal:

``blocks``  exact. The bits form 8 blocks; two fingerprints that differ in at most 2 bits agree in at
            least 6 blocks, so each is dealt to the 28 shards named by 6 of its 8 blocks. What is left free
            is 16 bits of a 64-bit fingerprint: no shard ever has more than 65,536 members.
``seeds``   for a larger radius with a check of the shingles: the shards are named by pairs of the six
            smallest shingle hashes. Texts whose shingles are alike by 0.8 share two of the six with a
            probability of 0.998. A shard of any size is searched in blocks; what is then still apart in it is
            checked against leaders and at last meets by an exact prefix filter.

A shard's tree is built by the task that owns the shard and never broadcast: all trees together grow with
the documents. A shard gives a few links per member at most, so groups of copies are not expanded into pairs.

Defined results: a NULL text counts as empty; a text without words has fingerprint zero and no seeds;
every row gives a row, repeated ones and those with a NULL id too; the component id is the smallest id
reachable. A row with a NULL id gets the component of the rows with its fingerprint, NULL if there are
none, and links no others. Rows that share an id are one document.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bktree import shard_links
from .common import batches_of, numbered, small_batches, staged
from .graph import components

SEED = 42
BLOCKS, EQUAL = 8, 6
SEEDS = 6
#: Nearest fingerprints of each member whose shingles are checked first, and the share of its checks that a round of leaders
#: must join to be followed by another. Both only save work: what they leave apart meets by the prefix filter.
NEAR, GOOD = 4, 0.2
#: Members of a shard that one task searches.
BLOCK = 1 << 13
#: What makes two texts the same: the fingerprint, and with a check also their set of shingles.
CLASS = ("f0", "f1", "same")
SLICE = 1 << 20


def shingle_hashes(text: str | None, n: int) -> tuple[np.ndarray, list[bytes]]:
    """XXH64 of each run of ``n`` words, A-Z lower-cased; a shorter text is one shingle."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return np.array([], np.uint64), []
    shingles = list(map(b" ".join, zip(*(words[i:] for i in range(n))))) or [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(x, SEED) for x in shingles), np.uint64, len(shingles)), shingles


def vote(hashes: np.ndarray) -> int:
    """Bits set in over half the hashes."""
    if not hashes.size:
        return 0
    bits = np.zeros(64, np.int64)
    for start in range(0, hashes.size, 1 << 16):
        part = hashes[start : start + (1 << 16)].astype("<u8")
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > hashes.size, bitorder="little").view("<u8")[0])


def second_hash(hashes: np.ndarray) -> np.ndarray:
    """Another 64 bits from each hash (a bijective mixer)."""
    x = hashes * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def fingerprints(docs: DataFrame, words: int, wide: bool = False, seeds: bool = False) -> DataFrame:
    """``doc_id, f0, f1, same, seeds`` of every row: the fingerprint's words as longs (``f1`` is 0 unless
    ``wide``); if ``seeds``, a digest of the set of shingles and its smallest hashes, and the votes are those of
    the set, whatever repeats."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in batches_of(batch.column("text"), SLICE):
                part = batch.slice(start, stop - start)
                f0, f1, same, least = [], [], [], []
                for text in part.column("text").to_pylist():
                    hashes, _ = shingle_hashes(text, words)
                    if seeds:
                        hashes = np.unique(hashes)  # likeness is that of sets, so each shingle votes once
                    f0.append(vote(hashes))
                    f1.append(vote(second_hash(hashes)) if wide else 0)
                    same.append(xxhash.xxh64_intdigest(hashes.tobytes()) if seeds else 0)
                    least.append(hashes[: SEEDS if seeds else 0].view(np.int64))
                longs = (pa.array(np.array(x, np.uint64).view(np.int64)) for x in (f0, f1, same))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *longs, pa.array(least, pa.list_(pa.int64()))],
                    ["doc_id", *CLASS, "seeds"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, f0 long, f1 long, same long, seeds array<long>")


def block_shards(distinct: DataFrame) -> DataFrame:
    """Every fingerprint in the shards named by 6 of its 8 blocks (one word per fingerprint)."""
    width = 64 // BLOCKS
    masks = []
    for chosen in combinations(range(BLOCKS), EQUAL):
        mask = sum(((1 << width) - 1) << (width * b) for b in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    keys = F.array(
        *(F.struct(F.lit(i).cast("long").alias("k1"), F.col("f0").bitwiseAND(F.lit(m)).alias("k2")) for i, m in enumerate(masks))
    )
    return distinct.select("f0", "f1", "member", F.inline(keys))


def seed_shards(distinct: DataFrame) -> DataFrame:
    """Every fingerprint in the shards named by two of its seeds; with fewer than two, by what it has."""
    pairs = F.expr(
        "flatten(transform(seeds, (a, i) -> transform(slice(seeds, i + 2, size(seeds)), b -> struct(a AS k1, b AS k2))))"
    )
    short = F.array(F.struct(F.element_at("seeds", 1).alias("k1"), F.lit(0).cast("long").alias("k2")))
    return distinct.where(F.size("seeds") > 0).select(
        "f0", "f1", "member", F.inline(F.when(F.size("seeds") > 1, pairs).otherwise(short))
    )


def links_of(shards: DataFrame, radius: int, near: int = 1, keys: tuple[str, ...] = ("k1", "k2")) -> DataFrame:
    """Links ``a, b, d, bridge`` between members of the same shard, as ``shard_links`` has them.

    Rows arrive sorted by shard; a shard of one member costs nothing, one that spans batches is carried.
    """

    def linked(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        edges = np.flatnonzero(np.logical_or.reduce([rows[k][1:] != rows[k][:-1] for k in keys])) + 1
        starts, stops = np.concatenate([[0], edges]), np.concatenate([edges, [rows["member"].size]])
        prints = np.stack([rows["f0"], rows["f1"]], axis=1).view(np.uint64)
        none = np.array([], np.int64)
        found = [(none, none, none.astype(np.int32), none.astype(bool))]
        for i in np.flatnonzero(stops - starts > 1):
            x, y, d, bridge = shard_links(prints[starts[i] : stops[i]], radius, near)
            found.append((rows["member"][starts[i] + x], rows["member"][starts[i] + y], d, bridge))
        columns = [pa.array(np.concatenate(x)) for x in zip(*found)]
        return pa.RecordBatch.from_arrays(columns, ["a", "b", "d", "bridge"])

    names = [*keys, "f0", "f1", "member"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[dict[str, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
            last = np.logical_and.reduce([rows[k] == rows[k][-1] for k in keys])
            cut = last.size - int(last.sum())
            if cut == 0 and kept and all(kept[-1][k][-1] == rows[k][0] for k in keys):
                kept.append(rows)
                continue
            kept.append({n: v[:cut] for n, v in rows.items()})
            yield linked({n: np.concatenate([x[n] for x in kept]) for n in names})
            kept = [{n: v[cut:] for n, v in rows.items()}]
        if kept:
            yield linked({n: np.concatenate([x[n] for x in kept]) for n in names})

    placed = shards.select(*names).repartition(*keys).sortWithinPartitions(*keys, "f0", "f1")
    return placed.mapInArrow(run, "a long, b long, d int, bridge boolean")


def near_duplicates(
    docs: DataFrame,
    words: int = 3,
    radius: int = 2,
    alike: float | None = None,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs``.

    With ``alike`` None the links are exactly the fingerprints within ``radius`` (at most 2). Otherwise
    fingerprints have 128 bits, shards are named by seeds, and a link also needs shingle sets whose Jaccard
    similarity is ``alike`` or more; texts without words are then alike only to each other.
    """
    if alike is None and not 0 <= radius <= BLOCKS - EQUAL:
        raise ValueError(f"shards by blocks are exact up to radius {BLOCKS - EQUAL}")
    checked = alike is not None
    prints = staged(fingerprints(docs, words, wide=checked, seeds=checked), "simhash")
    distinct = staged(
        prints.groupBy(*CLASS).agg(F.min("doc_id").alias("member"), F.min("seeds").alias("seeds")),
        "simhash-distinct",
    )
    named = distinct.where("member is not null")
    if checked:
        links = alike_links(named, docs, words, radius, alike)
    else:
        links = links_of(block_shards(named), radius)
    roots = components(links, "simhash-groups")
    classes = distinct.join(roots, distinct["member"] == roots["node"], "left").select(
        *CLASS, F.coalesce("root", "member").alias("component_id")
    )
    return prints.join(classes, list(CLASS), "left").select(
        "doc_id", hex_of("f0", "f1", checked).alias("fingerprint"), "component_id"
    )


#: Keys of rows whose id does not name one text; beyond all ids that are counted upwards.
UNNAMED = 1 << 62


def with_keys(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a key ``name`` for every pair of id and text: the id where it stands for one text. Texts that share an
    id, or have none, get keys above UNNAMED in the order of id (NULL last) and digest."""
    text = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)
    kinds = docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("digest"))
    odd = kinds.groupBy("id").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    odd = odd.where("id is null or low < high").select(F.col("id").alias("odd"))
    odd = kinds.join(odd, kinds["id"].eqNullSafe(odd["odd"]), "left_semi").distinct()
    odd = staged(odd.withColumn("last", F.col("id").isNull()), "simhash-odd")
    keys = numbered(odd, "last", "id", "digest").select("id", "digest", (F.col("place") + UNNAMED).alias(name))
    here = F.col("doc_id").cast("long").eqNullSafe(keys["id"]) & (text == keys["digest"])
    return docs.join(keys, here, "left").select(*docs.columns, F.coalesce(name, F.col("doc_id").cast("long")).alias(name))


def kept_documents(docs: DataFrame, words: int, radius: int, alike: float) -> DataFrame:
    """One row of each group of alike texts: the one with the least key of ``with_keys``."""
    small_batches(docs.sparkSession)
    name = "key"
    while name in docs.columns:
        name += "_"
    rows = staged(with_keys(docs, name), "simhash-keyed")
    groups = near_duplicates(rows.select(F.col(name).alias("doc_id"), "text"), words, radius, alike)
    first = groups.where("doc_id = component_id").select(F.col("doc_id").alias(name)).distinct()
    return rows.join(first, name, "left_semi").dropDuplicates([name]).select(*docs.columns)


def hex_of(f0: str, f1: str, wide: bool) -> Column:
    digits = lambda name: F.lower(F.lpad(F.hex(F.col(name)), 16, "0"))
    return F.concat(digits(f1), digits(f0)) if wide else digits(f0)


def with_shingles(texts: DataFrame, n: int) -> DataFrame:
    """``doc_id, shingles`` of ``texts (doc_id, text)``: distinct hashes of the runs of ``n`` words, in built-in
    functions. Runs are made by zipping shifted copies of the words, each made once."""
    lower = F.translate(F.coalesce("text", F.lit("")), ascii_uppercase, ascii_lowercase)
    words = texts.select("doc_id", F.split(F.trim(F.regexp_replace(lower, r"[\x20\x09-\x0D]+", " ")), " ").alias("words"))
    shifted = F.arrays_zip(*(F.slice("words", i + 1, F.greatest(F.size("words"), F.lit(1))).alias(f"w{i}") for i in range(n)))
    runs = F.slice(shifted, 1, F.greatest(F.size("words") - (n - 1), F.lit(1)))
    return words.select("doc_id", F.array_distinct(F.transform(runs, lambda run: F.xxhash64(run))).alias("shingles"))


def dealt(shards: DataFrame, sizes: DataFrame) -> DataFrame:
    """``shards`` with the number of ``blocks`` that a shard is dealt into and the ``block`` of the member."""
    blocks = F.coalesce(F.ceil(F.col("n") / BLOCK), F.lit(1)).cast("int")
    rows = shards.join(sizes, ["k1", "k2"], "left").withColumn("blocks", blocks).drop("n")
    return rows.withColumn("block", F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int"))


def checked_links(links: DataFrame, sets: DataFrame, alike: float) -> DataFrame:
    """The ``links (a, b)`` whose shingle sets have a Jaccard similarity of ``alike`` or more."""
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb"))
    least, most = F.least(F.size("sa"), F.size("sb")), F.greatest(F.size("sa"), F.size("sb"))
    return (
        links.join(one, "a")
        .join(two, "b")
        .where((least >= most * F.lit(alike)) & (shared / (F.size("sa") + F.size("sb") - shared) >= F.lit(alike)))
        .select("a", "b")
    )


def still_apart(shards: DataFrame, links: DataFrame) -> DataFrame:
    """``shards`` whose members ``links`` leave in several groups, with each member's group ``root`` and its
    links ``degree``."""
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
    roots = components(links, "simhash-joined").join(ends, "node")
    rows = shards.join(roots, shards["member"] == roots["node"], "left").select(
        *shards.columns, F.coalesce("root", "member").alias("root"), F.coalesce("degree", F.lit(0)).alias("degree")
    )
    # The least and the greatest root are combined inside each task, so that a shard of any size sends a row per task.
    open_ = rows.groupBy("k1", "k2").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    return staged(rows.join(open_.select("k1", "k2"), ["k1", "k2"], "left_semi"), "simhash-apart")


def leader_links(apart: DataFrame, sets: DataFrame, radius: int, alike: float) -> list[DataFrame]:
    """Links of ``apart`` members to leaders of their shard.

    In every round each shard's member with the most links leads: all members of other groups are checked against it,
    and those that join, with its own group, take no further part there. Rounds go on while they join a good part of what they
    check. A round checks each member of a shard once.
    """
    made, rest = [], apart
    while True:
        best = F.max_by(F.struct("member", "root", "f0", "f1"), F.struct("degree", -F.col("member"))).alias("lead")
        lead = rest.groupBy("k1", "k2").agg(best)
        left = rest.join(lead, ["k1", "k2"]).where(F.col("root") != F.col("lead.root"))
        bits = F.bit_count(F.col("f0").bitwiseXOR(F.col("lead.f0"))) + F.bit_count(F.col("f1").bitwiseXOR(F.col("lead.f1")))
        left = staged(left.withColumn("near", bits <= radius), "simhash-led")
        pairs = left.where("near").select(F.col("lead.member").alias("a"), F.col("member").alias("b")).distinct()
        new = staged(checked_links(pairs, sets, alike), "simhash-alike")
        tried, joined = pairs.count(), new.count()
        if joined:
            made.append(new)
        if joined < GOOD * tried or not tried:
            return made
        both = new.select(F.struct("a", "b").alias("link"))
        link = F.struct(F.greatest("lead.member", "member").alias("a"), F.least("lead.member", "member").alias("b"))
        rest = left.withColumn("link", link).join(both, "link", "left_anti").select(*apart.columns)
        rest = staged(rest, "simhash-rest")


def prefix_pairs(apart: DataFrame, sets: DataFrame, alike: float) -> DataFrame:
    """Pairs ``a, b`` of ``apart`` members of different groups: all whose sets can be alike by ``alike``.

    The shingles of a set stand in the order of how few of these members hold them. Two sets x and y, x no smaller, that
    are alike by t share one among the first |x| - ceil(t |x|) + 1 of x and the first |y| - ceil(2t/(1+t) |y|) + 1 of y, with
    enough of both behind it. What a crowd has in common (a template) is frequent and stands behind these places, unless it
    makes its members alike by nearly t.
    """
    members = staged(apart.select("member", "root").distinct(), "simhash-members")
    held = sets.join(members, sets["doc_id"] == members["member"]).select("member", "root", "shingles")
    rows = held.select("member", "root", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
    often = rows.groupBy("shingle").agg(
        F.count("*").alias("often"), (F.min("root") != F.max("root")).alias("mixed")
    )
    # A shingle of one member takes a place and joins nothing: counted, not shuffled again.
    ranked = rows.join(often.where("often > 1"), "shingle").groupBy("member", "root", "size")
    ranked = ranked.agg(F.sort_array(F.collect_list(F.struct("often", "shingle", "mixed"))).alias("order"))
    place = (F.col("size") - F.size("order") + F.col("at") + 1).alias("place")
    first = ranked.select("member", "root", "size", "order", F.posexplode("order").alias("at", "one"))
    first = first.select("member", "root", "size", place, F.col("one.shingle").alias("shingle"), F.col("one.mixed").alias("mixed"))
    # A hair is taken off, so that rounding never shortens a prefix.
    bound = lambda share: F.col("size") - F.ceil(F.col("size") * F.lit(share) - 1e-9) + 1
    probe = first.where(F.col("mixed") & (F.col("place") <= bound(alike)))
    probe = staged(probe.withColumn("index", F.col("place") <= bound(2 * alike / (1 + alike))), "simhash-prefixes")
    y = probe.where("index").select("shingle", *(F.col(c).alias(f"y_{c}") for c in ("member", "root", "size", "place")))
    behind = F.least(F.col("size") - F.col("place"), F.col("y_size") - F.col("y_place")) + 1
    larger = (F.col("size") > F.col("y_size")) | ((F.col("size") == F.col("y_size")) & (F.col("member") > F.col("y_member")))
    return (
        probe.join(y, "shingle")
        .where(
            larger
            & (F.col("root") != F.col("y_root"))
            & (F.col("y_size") >= F.col("size") * F.lit(alike) - 1e-9)
            & (behind >= (F.col("size") + F.col("y_size")) * F.lit(alike / (1 + alike)) - 1e-9)
        )
        .select(F.col("member").alias("a"), F.col("y_member").alias("b"))
        .distinct()
    )


def alike_links(named: DataFrame, docs: DataFrame, words: int, radius: int, alike: float) -> DataFrame:
    """Links whose texts' shingle sets have a Jaccard similarity of ``alike`` or more, enough to join whatever any
    of them joins.

    First each member is checked against its nearest in its block of the shard, by the shard's BK-tree. Then members are checked
    against leaders of their shard, which finds the origin of a crowd of copies. All members of the shards that are still in several
    groups by then meet by an exact prefix filter, whatever their fingerprints.
    """
    shards = seed_shards(named)
    sizes = staged(shards.groupBy("k1", "k2").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK), "simhash-sizes")
    found = staged(links_of(dealt(shards, sizes), radius, NEAR, ("k1", "k2", "block")), "simhash-links")
    shards = staged(shards, "simhash-shards")
    links = found.where("not bridge").select("a", "b")
    # Members alone in all their shards take no further part.
    many = shards.groupBy("k1", "k2").agg(F.min("member").alias("low"), F.max("member").alias("high")).where("low < high")
    shards = staged(shards.join(many.select("k1", "k2"), ["k1", "k2"], "left_semi"), "simhash-met")
    live = staged(shards.select("member").distinct(), "simhash-live")
    texts = docs.join(live, docs["doc_id"] == live["member"], "left_semi").select("doc_id", "text")
    sets = staged(with_shingles(texts.groupBy("doc_id").agg(F.min("text").alias("text")), words), "simhash-sets")

    links = staged(checked_links(links, sets, alike), "simhash-alike")
    apart = still_apart(shards, links)
    for new in leader_links(apart, sets, radius, alike):
        links = links.union(new)
    apart = still_apart(shards, links)
    return links.union(staged(checked_links(prefix_pairs(apart, sets, alike), sets, alike), "simhash-alike"))
