"""Merkle manifest of a table of documents, with proofs by pointer jumping.

Leaves of a source ascend by ``doc_id``; every three neighbours have a parent until one node, the source's
subroot, is left; the subroots, ordered by source, have parents in the same way up to the root.

Every node knows its parent and its siblings, which is a *segment* of one level. Inner nodes are joined with
themselves: whoever knows a segment up to the ancestor 2^k levels above appends that ancestor's own segment and then knows
one up to 2^(k+1) levels above. Leaves take the segments of 1, 2, 4, ... levels one after another, so log2 of the depth
joins bring every leaf to the root. At a distance d at most 3^d leaves share an ancestor and only one node in 3^d is one,
so no join has a hot key, and the far joins have a few rows on one side; these are broadcast after a check of
their size. Places in a source are counted by range partitions, never by a window over a source.

Defined results: a NULL field is ``-``; a NULL ``doc_id`` comes first in its source and is not tampered with; NULL
is a source of its own; rows that share a ``doc_id`` are ordered by their digest, repeated rows are leaves of their own; a lone
leaf is its source's subroot and a lone source's subroot is the root; an empty table gives no rows; texts of any length are
digested whole; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, staged

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A node's id is its first leaf's place times LEVELS plus its level; above the subroots levels count from UPPER and
#: places are those of sources.
LEVELS, UPPER = 128, 64
#: Bytes of segments that a join may broadcast.
BROADCAST = 8 << 20
#: Siblings to the left and right of a node's ancestors, level by level upwards. Digests are kept as bytes, half as long as
#: the hex text that is hashed.
SEGMENT = "array<struct<left binary, right binary>>"


def digest(*parts: Column) -> Column:
    """SHA-256 of concatenated texts, as bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def text_of(digests: Column | str) -> Column:
    """Digests as lower-case hex text."""
    return F.lower(F.hex(digests))


def field(name: str | Column) -> Column:
    value = (F.col(name) if isinstance(name, str) else name).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, tree, leaf, shown, tie``: the digest of every document, and of what is shown for it later on if that is
    something else."""
    text = F.col("text").cast("string")
    rest = [field(c) for c in FIELDS[:-1]]
    leaf = digest(*rest, field(text))
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    other = digest(*rest, field(F.replace(text, F.lit("\n"), F.lit(""))))
    shown = F.when(tampered & F.contains(text, F.lit("\n")), other)
    # NULL first, then the sources by their bytes.
    source = F.col("source").cast("string")
    tree = F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), source))
    tie = F.monotonically_increasing_id()
    return docs.select("doc_id", tree.alias("tree"), leaf.alias("leaf"), shown.alias("shown"), tie.alias("tie"))


def placed_leaves(leaves: DataFrame) -> DataFrame:
    """``leaves`` with ``first``, the place of their source's first leaf, ``place`` in the source and its size ``n``."""
    rows = numbered(leaves, "tree", "doc_id", "leaf", "shown", "tie")
    # A source's first place and size, per source and task: no join on a source that holds a third of all rows.
    parts = rows.groupBy("tree", "task").agg(F.min("place").alias("low"), F.count("*").alias("rows"))
    whole = Window.partitionBy("tree")
    parts = parts.select(
        "tree", "task", F.min("low").over(whole).alias("first"), F.sum("rows").over(whole).alias("n")
    )
    return rows.join(parts, ["tree", "task"]).select(
        "doc_id", "leaf", "shown", "first", (F.col("place") - F.col("first")).alias("place"), "n"
    )


@dataclass
class Tree:
    """Written tables of nodes, one per level, and what has no parent in them."""

    levels: list[DataFrame]
    tops: DataFrame


def grown(nodes: DataFrame, node_id, name: str) -> Tree:
    """Levels above ``nodes (first, place, n, digest, id, height, ...)``: all trees at once.

    Every level gets ``parent`` and ``left``, ``right``, the digests of the siblings on either side. ``node_id`` makes the id of
    a node from its level and its place there.
    """
    levels, tops = [], []
    size = nodes.agg(F.max("n")).first()[0]
    level = 0
    while size and size > 1:
        up = F.expr(f"place div {ARITY}")
        family = Window.partitionBy("first", up).orderBy("place")
        whole = family.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        before = [F.coalesce(F.lag("digest", i).over(family), F.lit(b"")) for i in range(ARITY - 1, 0, -1)]
        after = [F.coalesce(F.lead("digest", i).over(family), F.lit(b"")) for i in range(1, ARITY)]
        linked = nodes.where("n > 1").withColumns(
            {
                "left": F.concat(*before),
                "right": F.concat(*after),
                "parent": node_id(level + 1, up),
                "top": F.max("height").over(whole),
            }
        )
        tops.append(nodes.where("n = 1").select("first", "digest", "id", "height"))
        linked = staged(linked, f"{name}-{level}")
        levels.append(linked)
        level += 1
        size = -(-size // ARITY)
        nodes = linked.where(F.col("place") % ARITY == 0).select(
            "first",
            up.alias("place"),
            F.expr(f"(n + {ARITY - 1}) div {ARITY}").alias("n"),
            digest(text_of("digest"), text_of("right")).alias("digest"),
            F.col("parent").alias("id"),
            (F.col("top") + 1).alias("height"),
        )
    last = nodes.select("first", "digest", "id", "height")
    for top in tops:
        last = last.union(top)
    return Tree(levels, last)


def step(df: DataFrame, leaf: bool = False) -> DataFrame:
    """A level's nodes with their segment of one level."""
    segment = F.array(F.struct("left", "right")).cast(SEGMENT).alias("segment")
    sub = F.when(F.col("is_sub"), F.col("digest")).alias("sub")
    mine = ["doc_id", "leaf", "shown"] if leaf else ["id", "height"]
    return df.select(*mine, F.col("parent").alias("up"), segment, sub)


def jumped(near: DataFrame, far: DataFrame) -> DataFrame:
    """``near`` with the segments of the ancestors it points to appended; who points to the root stays."""
    far = far.select(F.col("id").alias("at"), F.col("up").alias("far_up"), F.col("segment").alias("far"), F.col("sub").alias("far_sub"))
    joined = near.join(far, near["up"] == far["at"], "left")
    return joined.select(
        *(c for c in near.columns if c not in ("up", "segment", "sub")),
        F.coalesce("far_up", "up").alias("up"),
        F.when(F.col("at").isNull(), F.col("segment")).otherwise(F.concat("segment", "far")).alias("segment"),
        F.coalesce("sub", "far_sub").alias("sub"),
    )


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document, as the module says: its leaf, subroot and root, the digest of its proof, and whether what is
    shown for it still gives the root."""
    leaves = placed_leaves(staged(leaf_digests(docs), "merkle-leaves"))
    base = leaves.select(
        "doc_id", "leaf", "shown", "first", "place", "n", F.col("leaf").alias("digest"),
        ((F.col("first") + F.col("place")) * LEVELS).alias("id"), F.lit(0).alias("height"),
    )
    sources = grown(base, lambda level, place: (F.col("first") + place * ARITY**level) * LEVELS + level, "merkle-source")
    subs = staged(numbered(sources.tops, "first"), "merkle-subroots")
    count = subs.count()
    if not count:
        none = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
        return leaves.select("doc_id", *(text_of("leaf").alias(c) for c in none), F.lit(True).alias("verified"))
    upper = grown(
        subs.select(F.lit(0).cast("long").alias("first"), "place", F.lit(count).cast("long").alias("n"), "digest", "id", "height"),
        lambda level, place: place * LEVELS + UPPER + level,
        "merkle-root",
    )
    root = F.lit(upper.tops.first()["digest"].hex())

    # A leaf that is a subroot itself is linked among the sources.
    subroots = upper.levels[0].select("id", "height", "parent", "left", "right", "digest") if upper.levels else None
    known = sources.levels[0].withColumn("is_sub", F.lit(False)) if sources.levels else None
    near = step(known, leaf=True) if known is not None else None
    lone = base.where("n = 1").select("doc_id", "leaf", "shown", "id", "digest")
    if subroots is not None:
        alone = lone.join(subroots.select("id", "parent", "left", "right"), "id").withColumn("is_sub", F.lit(True))
        alone = step(alone, leaf=True)
    else:
        alone = lone.select(
            "doc_id", "leaf", "shown", F.col("id").alias("up"), F.array().cast(SEGMENT).alias("segment"), F.col("digest").alias("sub")
        )
    near = alone if near is None else near.unionByName(alone)

    # Inner nodes: levels of the sources above the leaves, then the subroots that are no leaves, then the levels above them.
    inner = [step(level.withColumn("is_sub", F.lit(False))) for level in sources.levels[1:]]
    inner += [step(level.withColumn("is_sub", F.lit(i == 0)).where("height > 0")) for i, level in enumerate(upper.levels)]
    depth = upper.tops.agg(F.max("height")).first()[0]
    far, distance = None, 1
    for part in inner:
        far = part if far is None else far.unionByName(part)
    while far is not None and distance < depth:
        # Only an ancestor at this distance, or what stands above one, is asked for from here on.
        far = staged(far.where(F.col("height") >= distance), f"merkle-far-{distance}")
        small = far.count() * (distance * (ARITY - 1) * 56 + 100) <= BROADCAST
        near = jumped(near, F.broadcast(far) if small else far)
        distance *= 2
        if distance < depth:
            far = jumped(far.where(F.col("height") >= distance), F.broadcast(far) if small else far)

    siblings = F.array_join(F.transform("segment", lambda s: text_of(F.concat(s["left"], s["right"]))), "")
    folded = F.aggregate(
        "segment",
        text_of(F.coalesce("shown", "leaf")),
        lambda at, s: F.sha2(F.concat(text_of(s["left"]), at, text_of(s["right"])), 256),
    )
    return near.select(
        "doc_id",
        text_of("leaf").alias("leaf"),
        F.coalesce(text_of("sub"), root).alias("subroot"),
        root.alias("root"),
        F.sha2(siblings, 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _climbed(name: str, start: str, kin: str) -> str:
    """SQL: ``name``, the proof and the folded digest of every row of ``start`` (d, s, idx, proof, fold) up to the top of its tree."""
    return f"""{name} as (
  select d, s, 0 as level, idx, proof, fold from {start}
  union all
  select c.d, c.s, c.level + 1, c.idx // 3, c.proof || k.l || k.r, sha256(k.l || c.fold || k.r)
  from {name} c join {kin} k using (s, level, idx) where k.n > 1)"""


def _grown(name: str, start: str) -> str:
    """SQL: ``name``, all nodes of the trees above ``start`` (s, idx, digest, n), and ``name``_kin with their siblings."""
    return f"""{name} as (
  select s, 0 as level, idx, digest, n from {start}
  union all
  select s, level + 1, idx // 3, sha256(string_agg(digest, '' order by idx)), max((n + 2) // 3)
  from {name} where n > 1 group by s, level, idx // 3),
{name}_kin as (
  select s, level, idx, n,
    coalesce(lag(digest, 2) over run, '') || coalesce(lag(digest) over run, '') as l,
    coalesce(lead(digest) over run, '') || coalesce(lead(digest, 2) over run, '') as r
  from {name} window run as (partition by s, level, idx // 3 order by idx))"""


def oracle_sql() -> str:
    text = "case when even then replace(text, chr(10), '') else text end"
    coded = lambda c: f"coalesce(strlen({c}) || ':' || {c}, '-')"
    rest = " || ".join(coded(f"cast({c} as varchar)") for c in FIELDS[:-1])
    return f"""with recursive bytes as (
  select *, row_number() over () as d, list_transform(range(length(cast(doc_id as varchar))),
      lambda i: cast(ascii(substr(cast(doc_id as varchar), cast(i as integer) + 1, 1)) as bigint)) as b from documents),
parity as (
  -- CRC-32 bit by bit; its last step inverts the lowest bit
  select *, list_reduce(list_prepend(cast(4294967295 as bigint), b), lambda c, x: list_reduce(
    list_prepend(xor(c, x), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
    lambda y, z: case when y & 1 = 1 then xor(y >> 1, 3988292384) else y >> 1 end)) & 1 = 1 as even from bytes),
leaves as (
  select d, doc_id, source, sha256({rest} || {coded("text")}) as leaf, sha256({rest} || {coded("(" + text + ")")}) as shown
  from parity),
placed as (
  select d, doc_id, leaf, shown, dense_rank() over (order by source nulls first) - 1 as s,
    row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as idx,
    leaf as digest, count(*) over (partition by source) as n
  from leaves),
{_grown("tree", "placed")},
tops as (select -1 as s, s as idx, digest, count(*) over () as n from tree where n = 1),
{_grown("crown", "tops")},
starts as (select d, s, idx, '' as proof, shown as fold from placed),
{_climbed("low", "starts", "tree_kin")},
halfway as (
  select l.d, -1 as s, l.s as idx, l.proof, l.fold from low l join tree t using (s, level, idx) where t.n = 1),
{_climbed("high", "halfway", "crown_kin")}
select p.doc_id, p.leaf, tops.digest as subroot, root.digest as root, sha256(h.proof) as proof_sha256,
  h.fold as folded_root, h.fold = root.digest as verified
from placed p join tops on tops.idx = p.s
  join high h on h.d = p.d join crown c on c.level = h.level and c.idx = h.idx and c.n = 1
  cross join (select digest from crown where n = 1) root"""
