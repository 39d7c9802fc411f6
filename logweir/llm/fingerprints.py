"""Document fingerprints: SimHash votes, permuted block tables, and the edited-text probe.

A text's terms are its pairs of neighbouring words (the last word alone too), weighted by how often they occur.
Each occurrence's hash votes on 64 signed bits: a bit is set if more than half the votes set it. The votes
are added up as 32 sums of two 32-bit lanes each, in generated code.

Permuted block tables: the bits form ``radius + 3`` blocks; fingerprints within the radius agree in at least three
of them, so each is put into one table for every choice of three blocks, keyed by these, and two that are near
meet in at least one table. This finds all of them; keys have about 32 bits for a radius of 3.

Everything is built-in functions. Defined results: a NULL text counts as empty, an empty text has fingerprint
zero; every row gives a row. The order of documents is that of their distinct ids. Where rows share an id, the
one whose text has the smallest hash is the "next document" of the id before. Rows with a NULL id have no
place in the order: the document that follows them is the first. A single document follows itself; without
any id, the next text is empty.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, text_or_empty

BITS = 64
NO_ID = -(1 << 63)
KEY = ["k", "none"]


def keyed(docs: DataFrame) -> DataFrame:
    """``k, none, text``; ``k, none`` stand for the id in joins, where NULL must equal NULL. All joins on the
    id take exactly these columns, so that the texts are shuffled once and the exchange is used again."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("k"),
        F.col("doc_id").isNull().alias("none"),
        text_or_empty().alias("text"),
    )


def successors(rows: DataFrame) -> DataFrame:
    """``k, none, half, next_k``: for each id the next smaller one (for the smallest, the largest), and half
    the length of its longest text.

    Ids are range-partitioned; windows run inside a range, and the ranges' ends are joined by a table of one
    row per range.
    """
    ids = rows.groupBy(*KEY).agg(F.floor(F.max(F.length("text")) / 2).alias("half"))
    ranged = ids.where("not none").repartitionByRange(F.desc("k")).withColumn("part", F.spark_partition_id())
    ranged = staged(ranged, "fingerprint-ids")
    inside = Window.partitionBy("part").orderBy(F.desc("k"))
    ends = ranged.groupBy("part").agg(F.max("k").alias("first"))
    whole = Window.partitionBy(F.lit(0))
    ends = ends.select(
        "part", F.coalesce(F.lead("first").over(whole.orderBy("part")), F.max("first").over(whole)).alias("after")
    )
    linked = ranged.withColumn("inner", F.lead("k").over(inside)).join(ends, "part")
    linked = linked.select(*KEY, "half", F.coalesce("inner", "after").alias("next_k"))
    top = F.lit(ranged.agg(F.max("k")).first()[0]).cast("long")
    return linked.unionByName(ids.where("none").select(*KEY, "half", top.alias("next_k")))


def with_edit(docs: DataFrame) -> DataFrame:
    """``keyed`` rows with ``edited, next_k``. The next document's text travels cut to what is needed."""
    rows = keyed(docs)
    asked = successors(rows).select(
        F.col("next_k").alias("k"), F.lit(False).alias("none"), F.col("k").alias("to_k"), F.col("none").alias("to_none"), "half"
    )
    # A written table: the optimizer would otherwise see that ``none`` is false and filter one side's texts.
    asked = staged(asked, "fingerprint-links")
    pieces = rows.join(asked, KEY).select(
        F.col("to_k").alias("k"),
        F.col("to_none").alias("none"),
        F.substring(F.col("text"), F.lit(1), F.col("half").cast("int")).alias("piece"),
        F.xxhash64("text").alias("mark"),
        F.col("k").alias("next_k"),
    )
    pieces = pieces.groupBy(*KEY).agg(F.min_by("piece", "mark").alias("piece"), F.first("next_k").alias("next_k"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - half),
        F.substring(F.coalesce("piece", F.lit("")), F.lit(1), half),
    )
    return rows.join(pieces, KEY, "left").select(*KEY, "text", edited.alias("edited"), "next_k")


def votes(rows: DataFrame, carry: list[str], text: str, name: str) -> DataFrame:
    """``carry`` and the fingerprint, as a long, of every row's ``text``; ``carry`` tells rows apart."""
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut = rows.select(*carry, words.alias("_words"))
    pairs = F.arrays_zip(F.col("_words").alias("a"), F.slice("_words", 2, F.greatest(F.size("_words"), F.lit(1))).alias("b"))
    terms = cut.select(*carry, F.explode_outer(pairs).alias("_term"))
    hashed = F.when(F.col("_term").isNotNull(), F.xxhash64("_term.a", "_term.b"))
    terms = terms.select(*carry, hashed.alias("_hash"))
    lanes = (1 << 32) | 1
    sums = [
        F.sum(F.shiftrightunsigned("_hash", k).bitwiseAND(F.lit(lanes))).alias(f"_{k}") for k in range(32)
    ]
    counted = terms.groupBy(*carry).agg(F.count("_hash").alias("_n"), *sums)
    bits = F.lit(0).cast("long")
    for k in range(32):
        low, high = F.col(f"_{k}").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(f"_{k}", 32)
        for place, votes_for in ((k, low), (k + 32, high)):
            mask = (1 << place) - ((1 << 64) if place == 63 else 0)
            bits = bits.bitwiseOR(F.when(2 * votes_for > F.col("_n"), F.lit(mask)).otherwise(F.lit(0)))
    return counted.select(*carry, bits.alias(name))


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / BITS


def block_tables(prints: DataFrame, radius: int) -> DataFrame:
    """``table, key, print`` for every choice of three blocks."""
    count = radius + 3
    edges = [BITS * i // count for i in range(count + 1)]
    blocks = [((1 << b) - 1) & ~((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(x) for x in combinations(blocks, 3)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(
        *(F.struct(F.lit(i).alias("table"), F.col("print").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed))
    )
    return prints.select("print", F.inline(keys))


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = 3) -> DataFrame:
    """All pairs ``query, print`` of a stated set of query fingerprints and all ``prints`` (both in a column
    ``print``) that differ in at most ``radius`` bits."""
    asked = block_tables(queries.select("print").distinct(), radius).withColumnRenamed("print", "query")
    there = block_tables(prints.select("print").distinct(), radius)
    near = F.bit_count(F.col("query").bitwiseXOR(F.col("print"))) <= radius
    return asked.join(there, ["table", "key"]).where(near).select("query", "print").distinct()


def neighboured(prints: DataFrame, radius: int = 3) -> DataFrame:
    """The fingerprints that have another one within ``radius``. A semi-join, so that a crowd of close
    fingerprints is not expanded into its pairs."""
    there = block_tables(prints.select("print").distinct(), radius)
    other = there.withColumnRenamed("print", "other")
    apart = F.bit_count(F.col("print").bitwiseXOR(F.col("other")))
    met = there.join(
        other, (there["table"] == other["table"]) & (there["key"] == other["key"]) & apart.between(1, radius), "left_semi"
    )
    return met.select("print").distinct()


def hexed(name: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(name)), 16, "0"))


def fingerprinted(docs: DataFrame, radius: int = 3) -> DataFrame:
    """A row for each row of ``docs``: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` and ``neighboured``, whether another document's differing fingerprint lies within
    ``radius``."""
    rows = with_edit(docs).withColumn("row", F.monotonically_increasing_id())
    told = rows.select(
        "row",
        *KEY,
        "next_k",
        F.length("text").cast("long").alias("n_chars"),
        F.xxhash64("text").alias("mark"),
        F.unhex(F.sha2(F.col("edited").cast("binary"), 256)).alias("digest"),
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("which"), F.col("text").alias("body")),
                F.struct(F.lit(1).alias("which"), F.col("edited").alias("body")),
            )
        ),
    )
    carry = ["row", *KEY, "next_k", "n_chars", "mark", "digest"]
    both = votes(told, [*carry, "which"], "body", "print").groupBy(*carry).agg(
        F.max(F.when(F.col("which") == 0, F.col("print"))).alias("print"),
        F.max(F.when(F.col("which") == 1, F.col("print"))).alias("edited_print"),
    )
    both = staged(both, "fingerprints")
    following = both.where("not none").groupBy(F.col("k").alias("next_k")).agg(F.min_by("print", "mark").alias("next_print"))
    near = neighboured(both, radius).withColumn("near", F.lit(True))
    return (
        both.join(following, "next_k", "left")
        .join(near, "print", "left")
        .select(
            F.when(~F.col("none"), F.col("k")).alias("doc_id"),
            "n_chars",
            F.lower(F.hex("digest")).alias("edited_sha256"),
            hexed("print").alias("fingerprint"),
            hexed("edited_print").alias("edited_fingerprint"),
            likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
            likeness(F.col("print"), F.coalesce("next_print", F.lit(0))).alias("near_next"),
            F.coalesce("near", F.lit(False)).alias("neighboured"),
        )
    )
