"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Targets: every source gets its share by weight, at most ``cap`` times its own size; what is cut off goes
   to the others by weight until nobody is above.
2. Quota: whole passes over the source, and a part of one more pass. The rows of a source are dealt to
   ``BLOCKS`` blocks by a seeded hash, which puts them in a random order; the part is the blocks before the
   quota's end. The block in which it ends is dealt to blocks again, and again row by row, so the quota is
   met to the word without ever sorting a source. The row in which it ends gives a part of its words.
3. Tree: the root is an urn of all drawn blocks of all sources. A node's urn is cut in two at random, half
   the blocks for each half of its output shards, which makes the sources' counts multivariate
   hypergeometric; leaves are output shards with exact quotas of blocks per source.
4. Each shard takes its quota of blocks from the source's permuted order, disjoint from the others', and
   orders its rows by a hash.

An urn holds at most (cap + 1) * BLOCKS blocks a source whatever the data, so only its size is bounded by the
number of sources. Everything is built-in column functions; every draw is a hash of seed and name, so reruns
agree.

Defined results: a NULL text has size 0; a NULL source is a source of its own, the last; rows that repeat an
id are placed alike; an empty table gives an empty mix; a row without words is in the mix like any other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, staged, text_or_empty

BLOCKS = 512


@dataclass(frozen=True)
class Mix:
    """``weights`` repeat over the sources in code point order; ``share`` and ``cap`` are multiples of the
    sizes; ``shards`` is a power of two."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    share: float = 1.5
    cap: float = 2.0
    shards: int = 16
    seed: int = 17


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size`` of every row."""
    return docs.select(
        "doc_id", "source", F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size")
    )


def targets(sized: DataFrame, mix: Mix) -> DataFrame:
    """``source, source_size, target`` by filling all sources evenly by weight up to their caps."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    weights = F.array(*map(F.lit, mix.weights))
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(mix.weights))) + 1
    sources = sources.withColumn("weight", F.element_at(weights, turn)).withColumn(
        "most", F.lit(mix.cap) * F.col("source_size")
    )
    # A source is full if filling everybody up to its level does not exceed the total.
    all_rows = Window.partitionBy(F.lit(0))
    level = F.col("most") / F.col("weight")
    below = all_rows.orderBy("level", F.col("source").asc_nulls_last())
    filled = (
        sources.withColumn("level", level)
        .withColumn("total", F.lit(mix.share) * F.sum("source_size").over(all_rows))
        .withColumn("full_words", F.sum("most").over(below))
        .withColumn("open_weight", F.sum("weight").over(all_rows) - F.sum("weight").over(below))
        .withColumn("full", F.col("full_words") + F.col("level") * F.col("open_weight") <= F.col("total"))
    )
    left = F.col("total") - F.sum(F.when(F.col("full"), F.col("most")).otherwise(0.0)).over(all_rows)
    share = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(all_rows)
    target = F.when(F.col("full"), F.col("most")).otherwise(F.least("most", F.col("weight") * left / F.nullif(share, F.lit(0.0))))
    return filled.select("source", "source_size", target.alias("target"))


def _place(level: int, mix: Mix) -> Column:
    """A row's block at each level of refinement, by independent hashes."""
    return F.pmod(F.xxhash64(F.lit(mix.seed), F.lit(level), F.col("doc_id")), F.lit(BLOCKS))


NAME = ["name", "none"]


def _named(rows: DataFrame) -> DataFrame:
    """``name, none`` stand for the source in joins, where NULL must equal NULL."""
    return rows.withColumns({"name": F.coalesce("source", F.lit("")), "none": F.col("source").isNull()})


def _id() -> list[Column]:
    return [F.coalesce("doc_id", F.lit(-1)).alias("id"), F.col("doc_id").isNull().alias("no_id")]


def _cut(parts: DataFrame, order: list, quota: str, state: str) -> DataFrame:
    """Where each source's quota ends in its ``parts (words)``: ``state`` is 2 for parts inside, 1 for the
    part in which it ends, 0 beyond; ``left`` (in ``quota``'s place if that is ``room``) is what the quota
    has left when the part begins."""
    before = Window.partitionBy(*NAME).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col(quota) - F.coalesce(F.sum("words").over(before), F.lit(0))
    cut = F.when(F.col("left") >= F.col("words"), 2).when(F.col("left") > 0, 1).otherwise(0)
    cut = parts.withColumn("left", left).withColumn(state, cut)
    return cut if state == "last_state" else cut.withColumn("room", F.col("left")).drop("left")


def quotas(sized: DataFrame, mix: Mix) -> DataFrame:
    """``sized`` with ``source_size, target, block, passes, extra, drawn``: whole passes of the row's source,
    the words that its last, partial pass takes of the row, and whether that pass takes the row."""
    goals = targets(sized, mix)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(1)
    goals = _named(goals.withColumn("passes", passes.cast("long"))).withColumn(
        "rest", F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long")
    )
    goals = staged(goals.drop("source"), "mix-targets")
    rows = _named(sized).withColumn("block", _place(0, mix)).withColumn("inner", _place(1, mix))

    # Sources' blocks, at most BLOCKS a source; then the blocks of each source's last block.
    blocks = rows.groupBy(*NAME, "block").agg(F.sum("size").alias("words")).join(goals, NAME)
    blocks = staged(_cut(blocks, ["block"], "rest", "state").drop("words", "rest"), "mix-blocks")
    last = blocks.where("state = 1").select(*NAME, "block", "room")
    inner = rows.join(last, [*NAME, "block"]).groupBy(*NAME, "block", "inner", "room")
    inner = _cut(inner.agg(F.sum("size").alias("words")), ["inner"], "room", "inner_state")
    inner = staged(inner.drop("words"), "mix-inner")

    # Rows of the innermost block, one of BLOCKS * BLOCKS of the source, one by one.
    final = rows.join(inner.where("inner_state = 1").select(*NAME, "block", "inner", "room"), [*NAME, "block", "inner"])
    final = final.groupBy(*NAME, "block", "inner", *_id(), "room")
    final = final.agg(F.sum("size").alias("words"), F.count("*").alias("copies"))
    draw = F.xxhash64(F.lit(mix.seed), F.lit(2), "id", "no_id")
    final = _cut(final, [draw, F.col("id"), F.col("no_id")], "room", "last_state")
    part = F.when(F.col("last_state") == 2, F.col("words")).when(F.col("last_state") == 1, F.col("left"))
    part = F.floor(F.coalesce(part, F.lit(0)) / F.col("copies")).alias("part")
    final = final.select(*NAME, "block", "inner", "id", "no_id", part)

    whole = (F.col("state") == 2) | ((F.col("state") == 1) & (F.col("inner_state") == 2))
    edge = F.least("size", F.coalesce("part", F.lit(0)))
    extra = F.when(F.coalesce(whole, F.lit(False)), F.col("size")).otherwise(edge).cast("long")
    return (
        rows.select("*", *_id())
        .join(blocks.drop("room"), [*NAME, "block"])
        .join(inner.drop("room"), [*NAME, "block", "inner"], "left")
        .join(final, [*NAME, "block", "inner", "id", "no_id"], "left")
        .withColumn("extra", extra)
        .withColumn("drawn", F.coalesce(whole, F.lit(False)) | (F.col("extra") > 0))
        .select("doc_id", "source", *NAME, "size", "source_size", "target", "block", "passes", "extra", "drawn")
    )


def urn(blocks: DataFrame, mix: Mix) -> DataFrame:
    """Splits the urn of ``blocks (name, none, block, copy)`` down the tree; returns ``name, none, shard,
    n``: the exact quota of blocks per source and shard."""
    levels = mix.shards.bit_length() - 1
    balls = blocks.withColumn("node", F.lit(0).cast("long"))
    for level in range(levels):
        draw = F.xxhash64(F.lit(mix.seed), F.lit(100 + level), "name", "none", "block", "copy")
        place = Window.partitionBy("node").orderBy(draw, "name", "none", "block", "copy")
        half = F.row_number().over(place) * 2 > F.count("*").over(Window.partitionBy("node"))
        balls = balls.withColumn("node", F.col("node") * 2 + half.cast("long"))
    return balls.groupBy("name", "none", F.col("node").alias("shard")).agg(F.count("*").alias("n"))


def placed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """A row for each row of ``docs``: ``doc_id, source, size, source_size, target, passes, extra, copies``.

    ``copies`` holds a struct for each time the mix takes the row: ``words`` taken, output ``shard``, and the
    ``place`` that orders the shard's rows."""
    if mix.shards < 1 or mix.shards & (mix.shards - 1):
        raise ValueError("shards is a power of two")
    rows = staged(quotas(staged(sizes(docs), "mix-sizes"), mix), "mix-quotas")
    copies = F.expr(
        "concat(if(passes > 0, sequence(1L, passes), array()), if(drawn, array(passes + 1), array()))"
    )
    blocks = rows.select(*NAME, "block", "passes", "drawn").distinct().select(*NAME, "block", F.explode(copies).alias("copy"))
    blocks = staged(blocks.distinct(), "mix-urn")
    # Each shard takes the next n blocks of the source's permuted order.
    draw = F.xxhash64(F.lit(mix.seed), F.lit(3), "block", "copy")
    turn = F.row_number().over(Window.partitionBy(*NAME).orderBy(draw, "block", "copy"))
    order = blocks.withColumn("turn", turn.cast("long"))
    shares = urn(blocks, mix).withColumn("last", F.sum("n").over(Window.partitionBy(*NAME).orderBy("shard")))
    turns = shares.select(*NAME, "shard", F.explode(F.expr("sequence(last - n + 1, last)")).alias("turn"))
    homes = order.join(turns, [*NAME, "turn"]).groupBy(*NAME, "block")
    homes = homes.agg(F.map_from_entries(F.collect_list(F.struct("copy", "shard"))).alias("homes"))
    place = lambda c: F.xxhash64(F.lit(mix.seed), F.lit(4), F.col("doc_id"), c)
    taken = F.transform(
        copies,
        lambda c: F.struct(
            F.when(c > F.col("passes"), F.col("extra")).otherwise(F.col("size")).alias("words"),
            F.element_at("homes", c).alias("shard"),
            place(c).alias("place"),
        ),
    )
    return rows.join(homes, [*NAME, "block"], "left").select(
        "doc_id", "source", "size", "source_size", "target", "passes", "extra", taken.alias("copies")
    )


def taken_words(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per document: its size, its source's size and target, the words the mix takes of it, and the output
    shards that get its copies."""
    return placed(docs, mix).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("passes") * F.col("size") + F.col("extra")).alias("taken"),
        F.array_join(F.col("copies.shard"), ",").alias("shards"),
    )


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row for each time a document is taken. A part of a
    document is its first words. Rows with a NULL id cannot be named by a mix and stay as they are."""
    rows = placed(docs, mix).where("doc_id is not null").select("doc_id", "size", F.explode("copies").alias("copy"))
    rows = rows.distinct().select(F.col("doc_id").alias("mix_id"), F.col("size").alias("mix_size"), "copy.words")
    rows = rows.withColumnRenamed("words", "mix_words")
    first_words = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, F.col("mix_words").cast("int")), " ")
    cut = F.col("mix_words") < F.col("mix_size")
    made = docs.join(rows, docs["doc_id"] == rows["mix_id"]).withColumn("text", F.when(cut, first_words).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.when(cut, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return made.select(*docs.columns).unionByName(docs.where("doc_id is null"))
