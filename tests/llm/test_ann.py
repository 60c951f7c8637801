import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemart.llm import ann, queries

SF = "/root/testdata/sf0.1"


def brute(ids, vectors, query, k):
    d = np.sqrt(((vectors - vectors[ids == query][0]) ** 2).sum(axis=1))
    d[ids == query] = np.inf
    best = np.lexsort((ids, d))[:k]
    return ids[best].tolist(), d[best]


@pytest.mark.parametrize(("block", "batch"), [(300, 7), (8192, 4096)])
def test_recall(spark, block, batch):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    local = rows.select("vec_id", "embedding").collect()
    ids, vectors = np.array([r.vec_id for r in local]), np.array([r.embedding for r in local], float)
    got = {}
    for r in ann.search(rows, F.col("id") % 100 == 0, block=block, batch=batch).collect():
        got.setdefault(r.query_id, []).append(r)
    assert sorted(got) == sorted(i for i in ids.tolist() if i % 100 == 0)
    hits = 0
    for query, found in got.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in found] == sorted((r.score, r.vec_id) for r in found)
        near, _ = brute(ids, vectors, query, 10)
        hits += len(set(near) & {r.vec_id for r in found})
        for r in found:
            assert abs(r.score - np.linalg.norm(vectors[ids == query][0] - vectors[ids == r.vec_id][0])) < 1e-9
    assert hits / len(got) / 10 >= 0.9


def test_recall_of_full_blocks():
    """Three full blocks of the registered size, made here as the test vectors are: evenly over a sphere."""
    r = np.random.default_rng(8)
    vectors = r.normal(size=(3 * ann.BLOCK, 64))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    ids = np.arange(len(vectors))
    blocks = [ann.Block(ids[b::3], vectors[b::3]) for b in range(3)]
    hits = 0
    for query in range(0, len(ids), len(ids) // 30):
        found = [b.nearest(query, vectors[query], 10) for b in blocks]
        near, far = (np.concatenate(x) for x in zip(*found, strict=True))
        hits += len(set(near[np.lexsort((near, far))[:10]].tolist()) & set(brute(ids, vectors, query, 10)[0]))
    assert hits / 31 / 10 >= 0.9


def test_very_long_vectors(spark):
    """Longer vectors have smaller blocks."""
    r = np.random.default_rng(9)
    vectors = r.normal(size=(30, 40_000))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = [x.vec_id for x in ann.search(df, F.col("id") == 0, k=3, exact=True).orderBy("rank").collect()]
    assert got == brute(np.arange(30), vectors, 0, 3)[0]


def test_exact_and_clustered(spark):
    """exact=True is brute force; near clusters are found whole without looking at all."""
    r = np.random.default_rng(4)
    centres = r.normal(size=(40, 16))
    vectors = (centres[np.arange(800) % 40] + 0.01 * r.normal(size=(800, 16))).astype(np.float32).astype(float)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").withColumns({n: F.lit(0) for n in ("dims", "block", "asks", "v", "q")})
    ids = np.arange(800)
    for how, least in ((True, 1.0), (False, 0.97)):
        got = {}
        for x in ann.search(rows, F.col("id") % 100 == 0, block=300, exact=how).collect():
            got.setdefault(x.query_id, set()).add((x["rank"], x.vec_id) if how else x.vec_id)
        hits = 0
        for query, found in got.items():
            near = brute(ids, vectors, query, 10)[0]
            hits += len(found & (set(enumerate(near, 1)) if how else set(near)))
        assert len(got) == 8 and hits / 80 >= least
    seen = sum(len(x) for x in ann.Block(ids, vectors).collisions(vectors[0], lambda: 0.05))
    assert seen < 400


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (None, [1.0, 1.0]), (11, [1.0, 0.0, 0.0]), (3, [0.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("clashes"))
    got = [(r.query_id, r["rank"], r.vec_id) for r in ann.search(df, F.col("id") % 100 == 0).orderBy("rank").collect()]
    assert got == [(100, 1, 1), (100, 2, 2), (100, 3, 3), (100, 4, 3)]
    assert ann.search(df.limit(0), F.col("id") % 100 == 0).count() == 0


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 1.0]) for i in range(500)] + [(1000 + i, [float(i), 2.0]) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [r.vec_id for r in ann.search(df, F.col("id") == 100, block=128).orderBy("rank").collect()]
    assert got == list(range(10))
