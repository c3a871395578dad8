"""Hard negatives against brute force: ties, copies, odd rows, deep trees and many pieces of a leaf."""

import random

import numpy as np
from pyspark.sql import functions as F

from countryrank.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def rows(n=400, dim=6, seed=1):
    rnd = random.Random(seed)
    mids = [[rnd.uniform(-1, 1) for _ in range(dim)] for _ in range(8)]
    out = [(i, [m + rnd.uniform(-0.2, 0.2) for m in mids[i % 8]], rnd.randrange(4)) for i in range(n)]
    out += [(1000 + i, out[3][1], i % 3) for i in range(120)]  # copies of one vector
    out += [out[10], out[10], out[20], (None, out[5][1], 1), (7, None, 1), (8, out[8][1], None), (9, [1.0, float("nan")], 1), (11, [1.0, None], 2), (12, [float("inf")], 1), (13, [0.5, 0.5], 2), (10, [], 1)]
    return out


def brute(table, step=10):
    v = []
    for i, x, label in table:
        if x is None or label is None or any(c is None or not np.isfinite(c) for c in x):
            continue
        v.append((i, [int(np.floor(256 * np.float64(np.float32(c)))) for c in x], label))
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    first = lambda s, k: sorted(s, key=lambda t: (-t[0], t[1] is None, t[1] or 0))[:k]
    out = []
    for at, (i, x, label) in enumerate(v):
        if i is None or i % step:
            continue
        scored = [(dot(x, y), j, other) for k, (j, y, other) in enumerate(v) if k != at]
        for ps, p, _ in first([s for s in scored if s[2] == label], 5):
            found = first([s for s in scored if s[2] != label and 30 * ps <= 100 * s[0] <= 90 * ps], 10)
            out += [(i, p, k + 1, j, ps, ns) for k, (ns, j, _) in enumerate(found)]
    return sorted(out, key=repr)


def mined(spark, table, **how):
    df = spark.createDataFrame(table, SCHEMA).withColumn("row", F.lit("x")).withColumn("q", F.lit(1)).withColumn("id", F.lit(2)).repartition(5)
    return sorted(map(tuple, negatives.mine(df, F.col("id") % 10 == 0, **how).collect()), key=repr)


def test_mining_equals_brute_force(spark):
    table = rows()
    want = brute(table)
    assert len(want) > 500
    assert mined(spark, table) == want
    assert mined(spark, table, sample_rows=64, fanout=3, leaf_rows=5) == want


def test_no_rows(spark):
    assert mined(spark, [(1, None, 3)]) == [] == mined(spark, [])


def test_large_components(spark):
    table = [(i, [x * 3e5 for x in v], label) for i, v, label in rows(60) if v and all(c is not None and np.isfinite(c) for c in v)]
    assert mined(spark, table, sample_rows=40, leaf_rows=4) == brute(table)


def test_subtrees_are_left_out():
    rnd = np.random.default_rng(0)
    x = (rnd.normal(size=(20, 8))[rnd.integers(0, 20, 2000)] * 200 + rnd.normal(size=(2000, 8)) * 5).astype(np.int64)
    reach = float((x.astype(float) ** 2).sum(1).max())
    tree = negatives.grow(x, len(x), reach, False, leaf_rows=60)
    leaf = negatives.routed(x, tree)
    low = [np.full((len(p), len(p)), np.inf) for p in tree.points]
    high = [-a for a in low]
    for k, path in enumerate(negatives.paths(tree)):
        for node, j in path:
            d = negatives.apart(x[leaf == k], tree.points[node], tree)
            if len(d):
                low[node][:, j], high[node][:, j] = np.minimum(low[node][:, j], d.min(0)), np.maximum(high[node][:, j], d.max(0))
    q = x[:50]
    score = negatives.products(q, x, False)
    lo = np.sort(score, 1)[:, -20][:, None]
    at = np.sqrt((q.astype(float) ** 2).sum(1)[:, None] + reach - 2.0 * lo)
    seen = np.zeros((50, tree.leaves), bool)
    for k, own in negatives.visited(q, np.zeros_like(at), at, tree, low, high):
        seen[own, k] = True
    assert seen[np.nonzero(score >= lo)[0], leaf[np.nonzero(score >= lo)[1]]].all()
    assert seen.mean() < 0.5
