"""op12 against brute force in Python's integers, and against its SQL."""

import math

import numpy as np
import pytest
from oracle import SF, same_rows
from pyspark.sql import functions as F

from pagemart.llm import negatives, queries


def brute(rows, modulus=100, positives=5, count=5):
    """Sorted result rows from (id, vector, label)."""
    fine = [(i, [math.floor(x * 256) if abs(x) < 2.0**900 else int(x) * 256 for x in v], label) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {}
    for i, v, label in sorted(fine, key=lambda r: (r[0], str(r[2]), r[1])):
        if i % modulus == 0:
            anchors.setdefault(i, (v, label))
    out = []
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    for a, (v, label) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, other) for i, w, other in fine if i != a and len(w) == len(v))
        own = [(i, -s) for s, i, other in scored if other == label][:positives]
        for p, ps in own:
            reach = [(i, -s) for s, i, other in scored if other != label and 80 * ps <= -100 * s <= 100 * ps][:count]
            out += [(a, p, rank, n, clip(ps), clip(ns)) for rank, (n, ns) in enumerate(reach, 1)]
    return sorted(out)


def found(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def mine(df, **how):
    return negatives.mine(df, F.col("id") % 100 == 0, **how)


SCHEMA = "vec_id long, embedding array<double>, label int"


def test_query(spark):
    same_rows(queries.op12_hard_negatives(spark, SF), queries.OP12)
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = found(queries.op12_hard_negatives(spark, SF))
    assert got == brute(rows) and got


@pytest.mark.parametrize("how", [{}, {"block": 7, "batch": 2}])
def test_ties_and_blocks(spark, how):
    """Few distinct vectors, so most scores are equal; a hot label; blocks and batches of a few rows."""
    r = np.random.default_rng(1)
    rows = [(i, r.integers(-2, 4, 3).astype(float).tolist(), int(r.integers(0, 9)) // 4) for i in range(0, 1200, 5)]
    rows += [(10_000 + i, [1.0, 2.0, 3.0], 1) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(1) for n in ("id", "v", "dims", "block", "batch", "blocks", "asked", "beyond")})
    assert found(mine(df, **how)) == brute(rows)


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [1.0, 0.4], 2), (3, [0.0, 0.0], 2), (4, None, 1), (5, [nan, 1.0], 2), (6, [inf, 1.0], 2), (7, [None, 1.0], 2), (8, [1.0, 0.5], None), (None, [1.0, 0.5], 2), (9, [1.0, 0.5, 0.0], 2), (2, [1.0, 0.45], 3), (100, [-1.0, 1.0], 1), (100, [-1.0, 2.0], 1), (200, [], 4), (201, [], 4), (202, [], 5), (300, [0.0, 0.0], 6), (301, [5.0, 1.0], 6), (400, [1.0], 9)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(mine(df)) == brute(rows)
    assert mine(df.limit(0)).count() == 0


@pytest.mark.parametrize("scale", [1.0, 3000.0, 1e9, 1e30, 1e305])
def test_wide_numbers(spark, scale):
    """Exact whatever the components' size: doubles of two fields, Python's integers, scores beyond a long."""
    r = np.random.default_rng(2)
    rows = [(i, (r.normal(1, 0.3, 5) * scale).tolist(), i % 3) for i in range(0, 400, 4)]
    assert found(mine(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_packed_products_are_exact():
    r = np.random.default_rng(3)
    for spread in (3, 300, 60_000, 1 << 24, 1 << 40):
        for n in (1, 2, 5, 33):
            a, c = (np.floor(r.normal(spread / 3, spread, (k, 7))) for k in (4, n))
            packed = negatives.Packed(c, int(a.min()), int(a.max()))
            expected = [[sum(int(x) * int(y) for x, y in zip(u, v, strict=True)) for v in c] for u in a]
            assert packed.scores(a).tolist() == expected
            assert packed.fields >= min(n, 2)
    small = negatives.Packed(np.floor(r.normal(0, 3, (100, 4))), -9, 9)
    assert small.narrow and small.fields > 3 and len(small.wide) < 34
