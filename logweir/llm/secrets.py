"""Secret scan: known forms, and a battery of randomness tests for tokens of no known form.

Base spans are the matches of three expressions. Every other run of 20 or more token characters is a
candidate. Its encoding (the smallest alphabet it fits) is inferred, and two questions are asked:

* Does it look random *for its encoding*? Chi-squared test of uniform use of the alphabet, runs test
  (changes between the lower and upper half of the alphabet), lag-1 serial correlation of the alphabet
  positions. A token that any of them rejects at level ``alpha / 3`` is no secret.
* How unlikely is it as an *ordinary* token? Ordinary tokens repeat letters as language does and rarely
  change between lower case, upper case and digits. How far the token's repeats fall short of that, and its
  changes exceed it, gives a combined p-value (Stouffer's z).

The second p-values of all candidates go through the Benjamini-Hochberg procedure at rate ``fdr``, separately
in each class of lengths, since short tokens carry less evidence and would otherwise borrow from long ones.
The procedure needs counts on a grid of p-values only, whatever the number of candidates.

Everything is built-in column functions. Positions come from the pieces between matches, so they are code
points. Defined results: a NULL text counts as empty; no match gives no spans and the digest of an empty
string; every row gives a row; adjacent and repeated matches all count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, text_or_empty

# The expressions of the base kinds, in the order in which ties are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
#: Runs of at least so many characters: a shorter run of [0-9a-f] or [A-Z0-9] cannot pass its limit, and what
#: follows it does not depend on whether it matched.
LONG_ACCESS, LONG_HEX = r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"

# Encodings from the smallest alphabet on, as (name, expression, letters in order).
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
ENCODINGS = (
    ("decimal", "^[0-9]+$", DIGITS),
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef"),
    ("HEX", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("lower", "^[a-z]+$", LOWER),
    ("upper", "^[A-Z]+$", UPPER),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("base36", "^[0-9a-z]+$", DIGITS + LOWER),
    ("BASE36", "^[0-9A-Z]+$", DIGITS + UPPER),
    ("letters", "^[A-Za-z]+$", UPPER + LOWER),
    ("base62", "^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER),
    ("base64", "^.+$", UPPER + LOWER + DIGITS + "+/-_"),
)
#: Chance that two letters of ordinary text are the same, that two digits are, and that neighbours of an ordinary
#: token differ in kind (lower, upper, digit, other).
SAME_LETTER, SAME_DIGIT, CHANGE = 0.066, 0.1, 0.12
#: Classes of lengths for the false-discovery control, by their lower ends.
LENGTHS = (20, 28, 40, 64, 128)
#: p-values are counted on a grid of 10 ** (-i / GRID), i from 0 to GRID * DEPTH.
GRID, DEPTH = 50, 40


def matches(text: Column, kind: int, expression: str, group: int = 0) -> Column:
    """All matches of a text, left to right: ``kind``, number ``k``, length of the text between the match and
    the one before (``gap``), length ``n``, and the text of ``group``."""
    none = F.array().cast("array<struct<kind:int,k:int,gap:int,n:int,word:string>>")
    whole = F.regexp_extract_all(text, F.lit(f"({expression})"), F.lit(0))
    words = F.regexp_extract_all(text, F.lit(f"({expression})"), F.lit(group + 1)) if group else whole
    between = F.slice(F.split(text, expression, -1), 1, F.size(whole))
    both = F.arrays_zip(between.alias("gap"), whole.alias("match"), words.alias("word"))
    made = F.transform(
        both,
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("k"),
            F.length(x["gap"]).alias("gap"),
            F.length(x["match"]).alias("n"),
            x["word"].alias("word"),
        ),
    )
    return F.when(F.regexp_like(text, F.lit(expression)), made).otherwise(none)


def encoding_of(word: Column) -> Column:
    """Place in ``ENCODINGS`` of the first that the token fits; padding ``=`` does not count."""
    found = F.lit(None).cast("int")
    for i, (_, expression, _) in reversed(list(enumerate(ENCODINGS))):
        found = F.when(F.regexp_like(word, F.lit(expression)), F.lit(i)).otherwise(found)
    return found


def tail(z: Column) -> Column:
    """Upper tail of the normal distribution, to about 1e-7 absolutely and in proportion far out."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    # The polynomial of Abramowitz and Stegun 26.2.17.
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-x * x / 2) / F.lit(2.5066282746310002) * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


def _sum(array: Column, of: Callable[[Column], Column]) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda s, x: s + of(x).cast("double"))


def two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * tail(F.abs(z)))


def changes(array: Column) -> Column:
    """How often neighbours differ."""
    n = F.size(array)
    pairs = F.zip_with(F.slice(array, 1, n - 1), F.slice(array, 2, n - 1), lambda a, b: F.when(a != b, 1).otherwise(0))
    return F.aggregate(pairs, F.lit(0), lambda s, x: s + x).cast("double")


def battery(tokens: DataFrame) -> DataFrame:
    """``tokens (word)`` with ``encoding`` (its place), ``p_random`` (the smallest p-value of the three tests,
    times three) and ``p_ordinary``."""
    body = F.rtrim(F.col("word"), F.lit("="))
    df = tokens.withColumn("body", body).withColumn("encoding", encoding_of(F.col("body")))
    letters = F.element_at(F.array(*(F.lit(x) for _, _, x in ENCODINGS)), F.col("encoding") + 1)
    chars = F.split("body", "", F.length("body"))
    kind = lambda c: F.when(c.between("0", "9"), 0).when(c.between("a", "z"), 1).when(c.between("A", "Z"), 2).otherwise(3)
    df = df.withColumn("letters", letters).withColumn("chars", chars)
    df = df.withColumn("n", F.length("body").cast("double"))
    df = df.withColumn("k", F.least(F.length("letters"), F.lit(64)).cast("double"))
    df = df.withColumn("codes", F.transform("chars", lambda c: F.instr(F.col("letters"), c).cast("double")))
    df = df.withColumn("kinds", F.transform("chars", kind))

    n, k = F.col("n"), F.col("k")
    squares = _sum(F.array_distinct("codes"), lambda v: F.pow(F.size(F.filter("codes", lambda x: x == v)), 2))
    df = df.withColumn("squares", squares).withColumn("mean", _sum(F.col("codes"), lambda x: x) / n)
    # Chi-squared, made normal by its cube root.
    ratio = (F.col("squares") * k / n - n) / (k - 1)
    spread = 2 / (9 * (k - 1))
    z_uniform = (F.cbrt(F.greatest(ratio, F.lit(0.0))) - (1 - spread)) / F.sqrt(spread)
    # Runs above and below the middle of the alphabet.
    upper = F.transform("codes", lambda x: x > F.col("k") / 2)
    n1 = F.size(F.filter("codes", lambda x: x > F.col("k") / 2)).cast("double")
    expected = 2 * n1 * (n - n1) / n + 1
    variance = (expected - 1) * (expected - 2) / (n - 1)
    z_runs = F.when(variance > 0, (changes(upper) + 1 - expected) / F.sqrt(variance)).otherwise(0.0)
    # Serial correlation of neighbours.
    size = F.size("codes")
    products = F.zip_with(
        F.slice("codes", 1, size - 1),
        F.slice("codes", 2, size - 1),
        lambda a, b: (a - F.col("mean")) * (b - F.col("mean")),
    )
    around = _sum(F.col("codes"), lambda x: F.pow(x - F.col("mean"), 2))
    z_serial = F.when(around > 0, (_sum(products, lambda x: x) / around + 1 / n) * F.sqrt(n)).otherwise(F.sqrt(n))
    # Against ordinary tokens: fewer repeats and more changes of kind.
    pairs = n * (n - 1) / 2
    same = F.when(F.col("encoding") == 0, F.lit(SAME_DIGIT)).otherwise(F.lit(SAME_LETTER))
    z_repeats = (pairs * same - (F.col("squares") - n) / 2) / F.sqrt(2 * pairs * same * (1 - same))
    z_changes = (changes(F.col("kinds")) - 0.5 - (n - 1) * CHANGE) / F.sqrt((n - 1) * CHANGE * (1 - CHANGE))
    least = F.least(two_sided(z_uniform), two_sided(z_runs), two_sided(z_serial))
    return df.select(
        *tokens.columns,
        "encoding",
        F.least(F.lit(1.0), 3 * least).alias("p_random"),
        tail((z_repeats + z_changes) / F.sqrt(F.lit(2.0))).alias("p_ordinary"),
    )


def discovered(tested: DataFrame, fdr: float, alpha: float) -> DataFrame:
    """The rows of ``tested`` (a battery's result) that are secrets."""
    length = sum((F.when(F.length("word") >= x, 1).otherwise(0) for x in LENGTHS), F.lit(0))
    depth = F.floor(-F.log10(F.greatest(F.col("p_ordinary"), F.lit(10.0**-DEPTH))) * GRID)
    cell = F.when(F.col("p_random") >= alpha, F.greatest(depth, F.lit(0))).otherwise(0)
    placed = tested.withColumn("class", length).withColumn("cell", cell.cast("int"))
    counts = placed.groupBy("class", "cell").agg(F.count("*").alias("n"))
    deep = Window.partitionBy("class").orderBy(F.desc("cell"))
    counts = counts.withColumn("found", F.sum("n").over(deep)).withColumn("all", F.sum("n").over(Window.partitionBy("class")))
    passing = counts.where(F.pow(F.lit(10.0), -F.col("cell") / GRID) * F.col("all") <= F.lit(fdr) * F.col("found"))
    # A row per class of lengths at most.
    limits = {r["class"]: r["cell"] for r in passing.groupBy("class").agg(F.min("cell").alias("cell")).collect()}
    if not limits:
        return placed.where(F.lit(False)).drop("class", "cell")
    least = F.lit(None).cast("int")
    for name, limit in sorted(limits.items()):
        least = F.when(F.col("class") == name, F.lit(limit)).otherwise(least)
    return placed.where((F.col("cell") >= least) & (F.col("cell") > 0)).drop("class", "cell")


def found_spans(docs: DataFrame, carry: list[str], fdr: float, alpha: float) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` with a number (``row``) and the columns ``carry``, and all spans
    ``row, kind, start, stop`` (``kind`` is a place in ``KINDS``)."""
    text = text_or_empty()
    forms = [(0, ASSIGN, 2), (1, LONG_ACCESS, 0), (2, LONG_HEX, 0), (3, CANDIDATE, 0)]
    rows = docs.select(*carry, F.concat(*(matches(text, *form) for form in forms)).alias("_matches"))
    rows = staged(rows.withColumn("_row", F.monotonically_increasing_id()), "secret-matches")
    each = rows.select(F.col("_row").alias("row"), F.inline("_matches"))
    walk = Window.partitionBy("row", "kind").orderBy("k")
    each = each.withColumn("stop", F.sum(F.col("gap") + F.col("n")).over(walk).cast("long"))
    each = each.withColumn("start", F.col("stop") - F.col("n"))
    each = each.where((F.col("kind") != 0) | (F.length("word") >= 6)).drop("k", "gap", "n")
    # A candidate that touches a base span is no news.
    base = F.col("kind") < 3
    order = Window.partitionBy("row").orderBy("start", "kind")
    reached = F.max(F.when(base, F.col("stop"))).over(order)
    following = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(0, Window.unboundedFollowing))
    clear = (F.coalesce(reached, F.lit(0)) <= F.col("start")) & (F.coalesce(following >= F.col("stop"), F.lit(True)))
    each = staged(each.withColumn("clear", clear).where(base | F.col("clear")), "secret-spans")
    names = ["row", "kind", "start", "stop"]
    tested = staged(battery(each.where("kind = 3").select(*names, "word")), "secret-tests")
    spans = each.where(base).select(*names).union(discovered(tested, fdr, alpha).select(*names))
    return rows.drop("_matches"), spans


def scan(docs: DataFrame, fdr: float = 0.01, alpha: float = 0.01) -> DataFrame:
    """A row for each row of ``docs``: ``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans``.

    ``spans`` lists ``kind:start:end``, by start, then kind; ``base_sha256`` digests those of the base kinds.
    """
    rows, spans = found_spans(docs, ["doc_id"], fdr, alpha)
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    label = F.concat_ws(":", kind, F.col("start").cast("string"), F.col("stop").cast("string"))
    listed = F.array_sort(F.collect_list(F.struct("start", "kind", "stop", "label")))
    lists = spans.withColumn("label", label).groupBy("row").agg(
        *(F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{name}") for i, name in enumerate(KINDS)),
        listed.alias("listed"),
    )
    joined = lambda xs: F.array_join(F.transform(xs, lambda x: x["label"]), ",")
    lists = lists.withColumn("spans", joined(F.col("listed"))).withColumn(
        "base", joined(F.filter("listed", lambda x: x["kind"] < 3))
    )
    found = rows.join(lists, rows["_row"] == lists["row"], "left")
    return found.select(
        "doc_id",
        *(F.coalesce(f"n_{name}", F.lit(0)).cast("long").alias(f"n_{name}") for name in KINDS),
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def redacted(docs: DataFrame, mark: str = "[secret]", fdr: float = 0.01, alpha: float = 0.01) -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (overlapping spans by one), and ``n_chars`` brought up to
    date where there is such a column. Texts without spans, NULL too, stay as they are."""
    rows, spans = found_spans(docs, docs.columns, fdr, alpha)
    order = Window.partitionBy("row").orderBy("start", "kind", "stop")
    done = F.coalesce(F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = spans.withColumn("done", done).where(F.col("stop") > F.col("done"))
    parts = parts.groupBy(F.col("row").alias("_part_row")).agg(F.array_sort(F.collect_list(F.struct("start", "stop", "done"))).alias("_parts"))
    found = rows.join(parts, F.col("_row") == F.col("_part_row"), "left")
    pieces = F.transform(
        "_parts",
        lambda x: F.concat(
            F.substring(F.col("text"), (x["done"] + 1).cast("int"), F.greatest(x["start"] - x["done"], F.lit(0)).cast("int")),
            F.when(x["start"] >= x["done"], F.lit(mark)).otherwise(F.lit("")),
        ),
    )
    last = F.element_at("_parts", -1)["stop"]
    clean = F.concat(F.array_join(pieces, ""), F.substring(F.col("text"), (last + 1).cast("int"), F.length("text")))
    hit = F.col("_parts").isNotNull()
    made = found.withColumn("text", F.when(hit, clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.when(hit, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return made.select(*docs.columns)
