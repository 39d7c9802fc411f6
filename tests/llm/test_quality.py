import math
import zlib

from logweir.llm import quality
from logweir.llm.queries import QUERIES


def test_held_out_rows(spark, sf_dir):
    spark_dir = sf_dir.replace("sf0.001", "sf0.01")
    rows = {r.doc_id: r for r in QUERIES["op10_quality_rules"](spark, spark_dir).collect()}
    labels = spark.read.parquet(f"{spark_dir}/labels.parquet").collect()
    held = [(rows[r.doc_id], r.quality) for r in labels if rows[r.doc_id].held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows.values())
    assert len(held) > 40
    good, bad = [r.score for r, q in held if q == 1], [r.score for r, q in held if q == 0]
    auc = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.9
    assert sum(g >= 0.3 for g in good) / len(good) > 0.97


def test_paths_of_a_printed_forest():
    printed = """Forest
  Tree 0 (weight 1.0):
    If (feature 2 <= 0.5)
     If (feature 2 <= 0.25)
      Predict: 0.0
     Else (feature 2 > 0.25)
      Predict: 1.0
    Else (feature 2 > 0.5)
     If (feature 0 <= -1.5E-4)
      Predict: 0.0
     Else (feature 0 > -1.5E-4)
      Predict: 1.0
"""
    assert set(quality.paths(printed)) == {
        ((2, "<=", 0.5),),
        ((2, "<=", 0.25),),
        ((2, "<=", 0.5), (2, ">", 0.25)),
        ((2, ">", 0.5),),
        ((0, "<=", -1.5e-4), (2, ">", 0.5)),
        ((0, ">", -1.5e-4), (2, ">", 0.5)),
    }


def test_compiled_rules(spark):
    rules = quality.Rules(0.5, {((0, "<=", 1.0), (1, ">", 2.0)): 2.0, ((0, ">", 1.0),): -1.0})
    frame = spark.createDataFrame([(1.0, 3.0), (1.5, 3.0), (1.0, 2.0)], "a double, b double").selectExpr("array(a, b) AS v")
    got = [r[0] for r in frame.select(rules.score(frame["v"])).collect()]
    assert [round(x, 9) for x in got] == [round(1 / (1 + math.exp(-z)), 9) for z in (2.5, -0.5, 0.5)]


def test_edge_cases(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (None, "a b"), (3, "x" * 50_000), (3, "x" * 50_000), (4, "\n\n\t ")])
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 0), (3, 0, 0), (3, 1, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    one_kind = labels.where("quality = 1")
    assert {r.predicted for r in quality.classify(docs, one_kind).collect()} == {1}
    nothing = quality.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in nothing} == {0.5}
    assert quality.classify(docs.limit(0), labels).count() == 0
    assert quality.accepted(docs, one_kind).columns == docs.columns
