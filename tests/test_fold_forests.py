"""Cross validation on shared histograms against separate fits and a tree grown by hand."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamworks.operators import folds as V

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(700):
        a, b, c = (round(float(x), 3) for x in rng.uniform(0, 10, 3))
        y = int(20 * (a > 4) + 7 * (b > 6) + rng.integers(0, 4))
        rows.append((i, a, b, c, y, None if i % 5 == 0 else int(9 * (c > 5)), "extra"))
    rows += [(900, None, 1.0, 1.0, 5, 5, "no feature"), (901, 1.0, 1.0, 1.0, None, None, "no label")]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y int, z int, _fold string").repartition(5)


def shape(forests, first):
    """Cuts and means of a forest; sums of whole numbers are exact, so equal fits are equal."""
    picked = range(first, first + forests.trees)
    return [{n: (f, b, round(g, 6)) for n, (f, b, g) in forests.splits[m].items()} for m in picked], [forests.means[m] for m in picked]


def test_folds_are_what_separate_fits_give(table):
    how = {"trees": 3, "depth": 3, "edges": V.feature_edges(table.dropna(subset=FEATURES), FEATURES, 16)}
    state, both = V.fold_forests(table, FEATURES, ["y", "z"], "id", folds=3, **how)
    state = state.cache()
    assert state.count() == 701
    for fold in range(3):
        rest = table.join(state.filter(F.col("_fold") != fold).select("id"), "id")
        for i, label in enumerate(["y", "z"]):
            _, one = V.fold_forests(rest, FEATURES, [label], "id", folds=1, **how)
            assert shape(one, one.first(0, 1)) == shape(both, both.first(i, fold))
    # smaller settings are cut off the larger run
    small_state, small = V.fold_forests(table, FEATURES, ["y"], "id", folds=3, trees=2, depth=2, edges=how["edges"])
    rows = lambda df: sorted((r["fold"], r["n"], round(r["rmse"], 9), round(r["r2"], 9)) for r in df.collect())
    assert rows(V.fold_scores(small_state, small)) == rows(V.fold_scores(state, both, [2], [2]).filter("label = 'y'"))


def test_a_tree_and_its_scores_by_hand(table):
    state, forests = V.fold_forests(table, FEATURES, ["y"], "id", folds=2, trees=1, depth=2, bins=8, share=1.0, least=5)
    rows = state.select("id", "_fold", "_bins", "_w", F.get("_ys", F.lit(0)).alias("y"), "_nodes").collect()
    weights = [r["_w"][0] for r in rows]
    assert abs(np.mean(weights) - 1) < 0.15 and abs(np.var(weights) - 1) < 0.3

    def grow(part, node, splits, means):
        if not part:
            return
        w, y = np.array([r["_w"][0] for r in part], float), np.array([r["y"] for r in part], float)
        means[node] = (w * y).sum() / w.sum()
        best = None
        for f in range(3):
            for cut in range(8):
                left = np.array([r["_bins"][f] <= cut for r in part])
                if w[left].sum() < 5 or w[~left].sum() < 5:
                    continue
                gain = sum((w[s] * y[s]).sum() ** 2 / w[s].sum() for s in (left, ~left)) - (w * y).sum() ** 2 / w.sum()
                if gain > 1e-9 and (best is None or gain > best[0]):
                    best = (gain, f, cut)
        if best and node < 4:
            splits[node] = best[1:]
            for side, keep in ((0, True), (1, False)):
                grow([r for r in part if (r["_bins"][best[1]] <= best[2]) == keep], 2 * node + side, splits, means)

    for fold in range(2):
        splits, means = {}, {}
        grow([r for r in rows if r["_fold"] != fold and r["_w"][0] > 0 and r["y"] is not None], 1, splits, means)
        m = forests.first(0, fold)
        assert {n: (f, b) for n, (f, b, _) in forests.splits[m].items()} == splits and forests.means[m] == pytest.approx(means)
        held = [(r["y"], means[r["_nodes"][m]]) for r in rows if r["_fold"] == fold and r["y"] is not None]
        score = V.fold_scores(state, forests).filter(F.col("fold") == fold).first()
        y, p = np.array(held).T
        assert score["n"] == len(held) and score["rmse"] == pytest.approx(np.sqrt(np.mean((y - p) ** 2))) and score["r2"] == pytest.approx(1 - np.mean((y - p) ** 2) / np.var(y))


def test_search_and_elimination(table):
    found = V.search_folds(table, FEATURES, "y", "id", trees=(1, 3), depths=(1, 3), folds=3).collect()
    assert len(found) == 4 and [r["rmse"] for r in found if r["chosen"]] == [min(r["rmse"] for r in found)]
    assert next(r for r in found if r["chosen"])["depth"] == 3 and min(r["rmse"] for r in found) < 5
    steps = V.eliminate_by_folds(table, FEATURES, "y", "id", 1, folds=3, trees=4, depth=3)
    assert [n for n, *_ in steps] == [3, 2, 1] and steps[1][2] == ["a", "b"] and steps[2][2] == ["a"] and sum(c for *_, c in steps) == 1 and not steps[2][3]


def test_empty_and_odd_tables(spark, table):
    empty, forests = V.fold_forests(table.limit(0), FEATURES, ["y"], "id", folds=2, trees=2, depth=2)
    assert empty.count() == 0 and not any(forests.means) and V.fold_scores(empty, forests).count() == 0
    same = spark.createDataFrame([(1, 2.0, 3.0)] * 40 + [(None, 2.0, 3.0)], "id int, f double, y double")
    state, forests = V.fold_forests(same, ["f"], ["y"], "id", folds=2, trees=4, depth=2)
    odd = spark.createDataFrame([(i, float(i), float("nan") if i % 2 else float("inf")) for i in range(9)] + [(9, float("nan"), 1.0)], "id int, f double, y double")
    rest, none = V.fold_forests(odd, ["f"], ["y"], "id", folds=2, trees=2, depth=1)
    assert rest.count() == 9 and not any(none.means) and V.fold_scores(rest, none).count() == 0
    assert state.count() == 41 and not any(forests.splits)  # one key has one fold and one weight; nothing can be cut
