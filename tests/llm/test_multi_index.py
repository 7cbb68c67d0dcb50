import numpy as np
import pytest

from catalogflow.llm import multi_index


def test_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = multi_index.search(vectors, "vec_id % 20 = 0")
    assert multi_index.recall(found, vectors) >= 0.9
    rows = found.collect()
    assert len(rows) == 20 * vectors.filter("vec_id % 20 = 0").count()
    x = {r.vec_id: np.array(r.embedding, float) for r in vectors.collect()}
    by = {}
    for r in rows:
        assert r.score == pytest.approx(float(x[r.query_id] @ x[r.vec_id]), abs=1e-12) and r.query_id != r.vec_id
        by.setdefault(r.query_id, []).append((r.rank, -r.score, r.vec_id))
    for mine in by.values():
        mine.sort()
        assert [m[0] for m in mine] == list(range(1, 21)) and [m[1:] for m in mine] == sorted(m[1:] for m in mine)


@pytest.mark.parametrize("sigma", [0.0, 0.3, 1.0])
def test_recall_of_uneven_lengths(spark, sigma):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 16)) * np.exp(rng.normal(size=(3000, 1)) * sigma)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    # a small share of the entries is enough where lengths differ
    for visit in (0.15, multi_index.VISIT) if sigma else (multi_index.VISIT,):
        assert multi_index.recall(multi_index.search(vectors, "vec_id % 20 = 0", visit=visit), vectors) >= 0.9


def test_one_component(spark):
    vectors = spark.createDataFrame([(i, [float(i - 3)]) for i in range(60)], "vec_id long, embedding array<double>")
    got = [(r.rank, r.vec_id, r.score) for r in multi_index.search(vectors, "vec_id = 40", k=3).collect()]
    assert sorted(got) == [(1, 59, 37.0 * 56), (2, 58, 37.0 * 55), (3, 57, 37.0 * 54)]


def test_blocks_and_chunks_change_nothing(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    many = multi_index.search(vectors, "vec_id % 20 = 0", block=7).collect()
    few = multi_index.search(vectors, "vec_id % 20 = 0").collect()
    key = lambda r: (r.query_id, r.rank, r.vec_id)
    assert sorted(map(key, many)) == sorted(map(key, few))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0, 0.0, 0.0]), (20, [0.0, 2.0, 0.0, 0.0]), (3, [1.0, 1.0, 0.0, 0.0]), (4, [1.0, 1.0, 0.0, 0.0]), (5, None),
            (6, [0.0] * 4), (7, [nan, 1.0, 1.0, 1.0]), (8, [inf, 1.0, 1.0, 1.0]), (9, [None, 1.0, 1.0, 1.0]), (10, []), (11, [1.0] * 5),
            (None, [9.0] * 4), (3, [1.0, 1.0, 0.0, 0.0]), (40, [0.0] * 4)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").selectExpr("*", "1 as cell", "2 as block", "3 as v")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in multi_index.search(df, "vec_id % 20 = 0").collect())
    assert got == [(0, 1, 3, 1.0), (0, 2, 3, 1.0), (0, 3, 4, 1.0), (0, 4, 20, 0.0),
                   (20, 1, 3, 2.0), (20, 2, 3, 2.0), (20, 3, 4, 2.0), (20, 4, 0, 0.0)]
    assert multi_index.search(df.limit(0)).collect() == []
    assert multi_index.search(df.filter("vec_id in (5, 6, 10)")).collect() == []


def test_traversal_is_by_summed_distance():
    rng = np.random.default_rng(1)
    a, b, sizes = rng.random(6), rng.random(5), rng.integers(0, 3, 30)
    order = multi_index.visited(a, b, sizes, 10**9)
    total = [a[c // 5] + b[c % 5] for c in order]
    assert total == sorted(total) and set(order) == set(np.flatnonzero(sizes).tolist())
