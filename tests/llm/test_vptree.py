import numpy as np
import pytest

from logweir.llm import vptree
from logweir.llm.queries import QUERIES


def brute(vectors, queries, k=20):
    """{query: [(vec, score)]} over ``{id: vector}``."""
    ids = np.array(sorted(vectors))
    matrix = np.array([vectors[i] for i in ids], float)
    out = {}
    for q in queries:
        score = vptree.inner_products(np.broadcast_to(np.array(vectors[q], float), matrix.shape), matrix)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def table(spark, vectors):
    rows = [(i, v) for i, v in vectors.items()]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_whole_table_recall(spark, sf_dir):
    got = found(QUERIES["op7_nearest_vectors"](spark, sf_dir))
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    expected = brute(vectors, [i for i in vectors if i % 20 == 0])
    assert set(got) == set(expected)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in expected[q]}) for q in expected)
    assert hits / (20 * len(expected)) >= 0.95
    for q, pairs in got.items():
        assert len(pairs) == 20 and pairs == sorted(pairs, key=lambda x: (-x[1], x[0]))
        for v, score in pairs:
            assert score == pytest.approx(float(np.dot(np.array(vectors[q], float), np.array(vectors[v], float))), abs=1e-12)


@pytest.mark.parametrize("shard, block", [(10_000, 10_000), (300, 7)])
def test_factor_one_is_exact_with_ties_and_norms(spark, shard, block):
    draw = np.random.default_rng(4)
    vectors = {i: (draw.normal(size=8) * draw.choice([0.2, 1, 5])).tolist() for i in range(900)}
    vectors |= {1000 + i: vectors[3] for i in range(400)}  # many ties
    vectors = {i: np.array(v, np.float32).tolist() for i, v in vectors.items()}
    frame = table(spark, vectors)
    got = found(vptree.nearest(frame, frame.where("vec_id % 20 = 0"), relax=1.0, shard=shard, block=block))
    expected = brute(vectors, [i for i in vectors if i % 20 == 0])
    assert got == expected


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, None), (40, [0.0, 0.0]), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [None, 1.0])]
    rows += [(None, [3.0, 3.0]), (1, [2.0, 1.0]), (1, [2.0, 1.0]), (2, [-1.0, 0.0]), (3, [1.0, 2.0, 3.0]), (4, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = found(vptree.nearest(frame, frame.where("vec_id % 20 = 0")))
    assert got == {0: [(1, 4.0), (1, 4.0), (2, -1.0)]}
    assert vptree.nearest(frame.limit(0), frame.limit(0)).count() == 0
    assert vptree.nearest(frame, frame.limit(0)).count() == 0


def test_region_bounds_hold_and_skip_far_clusters():
    draw = np.random.default_rng(6)
    centres = draw.normal(size=(16, 6)) * 20
    points = np.repeat(centres, 100, 0) + draw.normal(size=(1600, 6))
    regions = vptree.Regions(points[::4], 4)
    region, far = regions.place(points)
    low, high = np.full((16, 4), np.inf), np.full((16, 4), -np.inf)
    for r in set(region.tolist()):
        low[r], high[r] = far[region == r].min(axis=0), far[region == r].max(axis=0)
    queries = points[:40] + draw.normal(size=(40, 6)) * 0.1
    bound = regions.bounds(queries, low, high)
    for q in range(40):
        d = np.sqrt(((points - queries[q]) ** 2).sum(axis=1))
        for r in set(region.tolist()):
            assert bound[q, r] <= d[region == r].min() + 1e-6
    # Clusters lie apart, so most regions cannot hold anything near.
    assert (bound > 8).mean() > 0.6


def test_clashing_columns_are_not_read(spark):
    rows = [(i, [float(i % 7) + 1, float(i)], 5, "x", 1.0) for i in range(60)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, shard int, region string, within double")
    got = found(vptree.nearest(frame, frame.where("vec_id % 20 = 0"), relax=1.0, shard=20))
    assert got == brute({r[0]: r[1] for r in rows}, [0, 20, 40])
