import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierline.llm.topk import Tree, top_k

SCHEMA = "vec_id long, embedding array<float>, score string, rank int, id int"


def brute(rows, k):
    valid = []
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v):
            valid.append((i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]))
    out = []
    for q, (i, v) in enumerate(valid):
        if i is not None and i % 100 == 0:
            others = [(-sum(a * b for a, b in zip(v, w)), j is None, j or 0, j) for p, (j, w) in enumerate(valid) if p != q and len(w) == len(v)]
            out += [(i, r, j, -s) for r, (s, _, _, j) in enumerate(sorted(others, key=lambda o: o[:3])[:k], 1)]
    return sorted(out, key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "s", 1, 2) for i, v in rows], SCHEMA)
    return sorted((tuple(r) for r in top_k(df, F.col("vec_id") % 100 == 0, **options).collect()), key=repr)


def test_matches_brute_force_over_many_shards(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(700)]
    rows += [(i, [0.5] * 6) for i in range(1000, 1200)]  # one vector that many rows have
    assert run(spark, rows, shard_rows=128, leaf=8) == brute(rows, 10)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [0.0, 1.0]), (1, [1.0, 2.0]), (2, None), (3, []), (4, [None, 1.0]), (5, [float("nan"), 1.0]),
        (6, [float("inf"), 1.0]), (100, [1.0, 2.0, 3.0]), (200, [-1.0, -2.0]), (None, [1.0, 2.0]), (7, [-0.0001, 0.0001]), (-100, [1.0, 2.0]),
    ]
    assert run(spark, rows) == brute(rows, 10)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_scores_beyond_exact_doubles(spark):
    big = float(np.float32(3e9))
    rows = [(0, [big, 1.0]), (1, [big, 2.0]), (2, [big, -1.0]), (3, [0.5, 0.5])]
    got = run(spark, rows)
    assert [r[2] for r in sorted(got, key=lambda r: (r[0], r[1])) if r[0] == 0] == [1, 2, 3]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 120), st.integers(1, 4), st.integers(1, 12), st.integers(0, 10**6))
def test_tree_finds_the_best(n, dims, k, seed):
    rng = np.random.default_rng(seed)
    points = rng.integers(-4, 5, (n, dims))
    query = rng.integers(-4, 5, dims)
    tree = Tree(points, 3)
    bounds = tree.bounds(query[None].astype(float))[0]
    places, scores = tree.search(query, bounds, k, -np.inf, n)
    want = sorted(range(n), key=lambda i: (-int(points[i] @ query), i))[:k]
    assert places.tolist() == want and scores == [int(points[i] @ query) for i in want]
    # a floor that the kth other candidate sets leaves out only what is no better
    floor, before = int(points[want[-1]] @ query), want[-1]
    places, _ = tree.search(query, bounds, k, floor, before)
    assert places.tolist() == [i for i in want if i != want[-1]][:k]


def test_boxes_prune():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.integers(0, 10, (500, 3)), rng.integers(1000, 1010, (500, 3))])
    tree = Tree(points, 16)
    bounds = tree.bounds(np.ones((1, 3)))[0]
    seen = sum(1 for n, b in zip(tree.nodes, bounds) if not n[5] and b >= 3000)
    assert seen < len([n for n in tree.nodes if not n[5]])
    assert pytest.approx(bounds[0]) == points.max(axis=0).sum()
