"""Quantile boosting: a tree against brute force, and held-out coverage."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamworks.operators import models as L


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(5)
    x, z = rng.uniform(0, 10, 3000), rng.uniform(0, 1, 3000)
    y = np.sin(x) * 3 + x + rng.normal(0, 0.3 + 0.15 * x)
    return spark.createDataFrame([(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x, z, y, strict=True))], "id int, x double, z double, y double")


def test_held_out_coverage(noisy):
    found = L.quantile_band(noisy.filter("id < 2000"), noisy.filter("id >= 2000"), ["x", "z"], "y", rounds=14)
    inside, wide_low, wide_high = found.agg(F.avg((F.col("y").between(F.col("low"), F.col("high"))).cast("int")), F.avg(F.when(F.col("x") < 3, F.col("high") - F.col("low"))), F.avg(F.when(F.col("x") > 7, F.col("high") - F.col("low")))).first()
    assert 0.85 <= inside <= 0.95 and wide_high > 1.4 * wide_low  # the band is wider where there is more noise


def test_one_tree_by_hand(noisy):
    share, depth, bins, least = 0.8, 2, 8, 30
    rows = [(r["x"], r["z"], r["y"]) for r in noisy.filter("id < 400").collect()]
    model = L.boosted_quantile(noisy.filter("id < 400"), ["x", "z"], "y", share, rounds=1, depth=depth, rate=1.0, bins=bins, least=least)
    y = np.array([r[2] for r in rows])
    start = np.quantile(y, share)
    g = np.where(y > start, share, share - 1)
    values = np.array([r[:2] for r in rows])
    splits = {}

    def grow(node, at, level):
        if level == depth:
            return
        best = (1e-9, None)
        for f in (0, 1):
            for k in range(1, bins):
                edge = np.quantile(values[:, f], k / bins)
                left = at & (values[:, f] <= edge)
                right = at & ~left
                if min(left.sum(), right.sum()) >= least:
                    gain = g[left].sum() ** 2 / left.sum() + g[right].sum() ** 2 / right.sum() - g[at].sum() ** 2 / at.sum()
                    if gain > best[0] + 1e-12:
                        best = (gain, (f, edge, left, right))
        if best[1]:
            f, edge, left, right = best[1]
            splits[node] = (f, edge)
            grow(2 * node, left, level + 1)
            grow(2 * node + 1, right, level + 1)

    grow(1, np.ones(len(rows), bool), 0)
    (found, leaves), = model.trees
    assert model.start == pytest.approx(start) and {n: (f, pytest.approx(e)) for n, (f, e) in splits.items()} == found
    for leaf, value in leaves.items():
        at = np.ones(len(rows), bool)
        n = leaf
        while n > 1:
            f, edge = splits[n // 2]
            at &= (values[:, f] <= edge) == (n % 2 == 0)
            n //= 2
        assert value == pytest.approx(np.quantile((y - start)[at], share))


def test_empty_and_null_rows(noisy):
    assert L.boosted_quantile(noisy.limit(0), ["x", "z"], "y", 0.5).trees == []
    some = noisy.limit(50).unionByName(noisy.limit(3).withColumn("x", F.lit(None).cast("double")))
    assert L.quantile_band(some, some, ["x", "z"], "y", rounds=1).count() == 53
