"""Quality classifier: a sparse rule ensemble over statistics of the text.

Shallow trees are grown on a bounded sample of labelled rows; every path from a root to a node is a rule, a
conjunction of comparisons of statistics. A lasso logistic regression over the rules keeps few of them, and
these become one Spark column expression, so that scoring is a projection in generated code.

Defined results: a NULL text counts as empty; the score of an empty text is what the rules make of zeros;
every row gives a row; NULL labels and ids are not learned from; an id that is labelled more than once counts
once, by majority; without labels of both kinds the score is the smoothed share of the kind there is.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, id_remainder, staged, text_or_empty

#: Labelled rows learned from, at most in expectation.
SAMPLE = 20_000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
STATS = "_quality_stats"


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text, by name; all are 0 for an empty text."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.split(text, "\n")
    n_chars = F.length(text)
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    return {
        "chars": n_chars,
        "words": F.size(words),
        "distinct_words": F.size(F.array_distinct(words)),
        "repeats": F.aggregate(
            F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.when(a == b, 1).otherwise(0)),
            F.lit(0),
            lambda s, x: s + x,
        ),
        "lines": F.size(lines),
        "distinct_lines": F.size(F.array_distinct(lines)),
        "symbols": count(r"[^\p{L}\p{N}\s.,;:'-]"),
        "marks": count(r"[^\p{L}\p{N}\s.,;:'-]{2}"),
        "capitals": count(r"\p{Lu}{2}"),
        "digits": count(r"[0-9]"),
        "stops": count(r"[.,;:]"),
    }


def ratios(stats: Column) -> list[Column]:
    """What the trees compare: shares and logarithms, as doubles."""
    x = {name: stats[name].cast("double") for name in statistics(F.lit(""))}
    part = lambda a, b: F.coalesce(x[a] / F.nullif(x[b], F.lit(0.0)), F.lit(0.0))
    return [
        F.log1p(x["chars"]),
        F.log1p(x["words"]),
        part("chars", "words"),
        part("distinct_words", "words"),
        part("repeats", "words"),
        F.log1p(x["lines"]),
        part("distinct_lines", "lines"),
        part("words", "lines"),
        part("symbols", "words"),
        part("marks", "words"),
        part("capitals", "words"),
        part("digits", "chars"),
        part("stops", "words"),
    ]


@dataclass(frozen=True)
class Rules:
    """Weighted rules; a rule is a tuple of ``(statistic, "<=" or ">", bound)``."""

    intercept: float
    weights: dict[tuple, float] = field(default_factory=dict)

    def score(self, values: Column) -> Column:
        """Probability of label 1, from an array column of ``ratios``."""
        logit = F.lit(self.intercept)
        for rule, weight in self.weights.items():
            logit = logit + F.when(holds(rule, values), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-logit))


def holds(rule: tuple, values: Column) -> Column:
    out = F.lit(True)
    for place, sign, bound in rule:
        value = F.get(values, F.lit(place))
        out = out & (value <= bound if sign == "<=" else value > bound)
    return out


def paths(description: str) -> list[tuple]:
    """All root-to-node paths of the trees in a forest's printed form, each once; comparisons of the same
    statistic in the same direction are merged."""
    found, path = {}, []
    for line in description.splitlines():
        step = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", line)
        if not step:
            continue
        depth = len(step[1])
        path = [x for x in path if x[0] < depth] + [(depth, int(step[2]), step[3], float(step[4]))]
        merged: dict[tuple, float] = {}
        for _, place, sign, bound in path:
            tighter = min if sign == "<=" else max
            merged[place, sign] = tighter(bound, merged.get((place, sign), bound))
        found[tuple(sorted((*k, v) for k, v in merged.items()))] = True
    return list(found)


def majority(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, label`` once per labelled id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    votes = known.groupBy("doc_id").agg(F.avg(F.col(label).cast("double")).alias("votes"))
    return votes.select("doc_id", (F.col("votes") >= 0.5).cast("double").alias("label"))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE, trees: int = 15, depth: int = 3, lasso: float = 0.001) -> Rules:
    """Rules from the labelled documents outside the held-out fold, ``rows`` of them at most."""
    known = majority(labels.where(id_remainder("doc_id", FOLDS) != HELD_OUT), label)
    # Bounded by the parameter, so it may be broadcast: an id and a label a row.
    sample = F.broadcast(hash_sample(known, "doc_id", rows, seed=3))
    values = staged(
        docs.select("doc_id", "text")
        .join(sample, "doc_id")
        .select("label", F.struct(*(c.alias(n) for n, c in statistics(text_or_empty()).items())).alias(STATS))
        .select("label", F.array(*ratios(F.col(STATS))).alias("values")),
        "quality-sample",
    ).repartition(4).cache()
    try:
        counts = {r["label"]: r["count"] for r in values.groupBy("label").count().collect()}
        if len(counts) < 2:
            import math

            good = counts.get(1.0, 0)
            return Rules(math.log((good + 1) / (counts.get(0.0, 0) + 1)))
        forest = RandomForestClassifier(
            labelCol="label", featuresCol="x", numTrees=trees, maxDepth=depth, minInstancesPerNode=5, seed=11
        ).fit(values.select("label", array_to_vector("values").alias("x")))
        rules = paths(forest.toDebugString)
        if not rules:
            import math

            return Rules(math.log(counts[1.0] / counts[0.0]))
        hits = F.array(*(holds(r, F.col("values")).cast("double") for r in rules))
        fitted = LogisticRegression(
            labelCol="label", featuresCol="x", elasticNetParam=1.0, regParam=lasso, maxIter=60
        ).fit(values.select("label", array_to_vector(hits).alias("x")))
        weights = {r: float(w) for r, w in zip(rules, fitted.coefficients.toArray()) if w}
        return Rules(float(fitted.intercept), weights)
    finally:
        values.unpersist()


def with_score(docs: DataFrame, rules: Rules, name: str = "score") -> DataFrame:
    """``docs`` with the score of every row's whole text."""
    stats = F.struct(*(c.alias(n) for n, c in statistics(text_or_empty()).items()))
    scored = docs.withColumn(STATS, stats).withColumn(STATS, F.array(*ratios(F.col(STATS))))
    return scored.withColumn(name, rules.score(F.col(STATS))).drop(STATS)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    scored = with_score(docs.select("doc_id", "text"), learn(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(id_remainder("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, in the columns of ``docs``."""
    score = "_quality_score"
    scored = with_score(docs, learn(docs, labels), score)
    return scored.where(F.col(score) >= THRESHOLD).select(*docs.columns)
