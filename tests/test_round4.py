"""Cases of the reviewer's fourth round, small enough to run in seconds."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamworks.operators import counts as N
from loamworks.operators import folds as V
from loamworks.operators import graph as P
from loamworks.operators import models as L


def test_ranks_follow_the_scores_that_are_shown(spark):
    # b tells a little more of y than a does, but nothing at six digits: there the name decides
    def column(d):
        return [(y, x) for y in (0, 1) for x in (0, 1) for _ in range(5000 + (d if x == y else -d))]

    table = spark.createDataFrame([(y, a, b) for (y, a), (_, b) in zip(column(3), column(4), strict=True)], "y int, a int, b int")
    ranked = lambda **how: {r["feature"]: (round(r["score"], 6), r["rank"]) for r in L.mutual_information_ranking(table, ["b", "a"], "y", 2, **how).collect()}
    assert ranked() == {"b": (0.0, 1), "a": (0.0, 2)}
    assert ranked(digits=6) == {"a": (0.0, 1), "b": (0.0, 2)}


def test_no_grid_is_broadcast_by_the_size_of_its_files(spark):
    cells = spark.range(90_000).select((F.col("id") / 300).cast("int").alias("r"), (F.col("id") % 300).cast("int").alias("c"))
    cells = cells.withColumn("v", F.when((F.col("r") == 7) & (F.col("c") == 7), 9).otherwise((F.col("c") / 100).cast("int")))
    found = P.generalise(cells, "v", 20)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (found, P.regions(cells, "v"))]
    assert not any("Broadcast" in plan for plan in plans)
    assert {(r["v"], r["count"]) for r in found.groupBy("v").count().collect()} == {(0, 30_000), (1, 30_000), (2, 30_000)}


def test_folds_of_one_file_are_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(V, "DEALT", 100, raising=False)
    table = spark.range(0, 800, numPartitions=1).select("id", (F.col("id") * 37 % 101).cast("double").alias("a"), (F.col("id") * 53 % 89).cast("double").alias("b"))
    table = table.withColumn("y", (F.col("a") > 40).cast("int") * 20 + (F.col("b") > 30).cast("int") * 7 + F.col("id") % 4)
    how = {"folds": 2, "trees": 2, "depth": 2}
    state, forests = V.fold_forests(table, ["a", "b"], ["y"], "id", **how)
    assert len(state.inputFiles()) >= 8
    scores = sorted(map(tuple, V.fold_scores(state, forests).collect()))
    assert [s[:5] for s in scores] == [("y", 2, 2, f, s[4]) for f, s in enumerate(scores)] and sum(s[4] for s in scores) == 800
    # a few models at once give what all at once give
    monkeypatch.setattr(V, "HELD", 100, raising=False)
    _, blocks = V.fold_forests(table, ["a", "b"], ["y"], "id", **how)
    assert blocks.splits == forests.splits and blocks.means == forests.means and any(forests.splits)


def test_clusters_go_through_different_points_with_their_weights(spark, monkeypatch):
    seen = []

    class Spy(L.KMeans):
        def fit(self, flat):
            seen.append(flat.count())
            return super().fit(flat)

    monkeypatch.setattr(L, "KMeans", Spy)
    # 1,000 copies of one point and few of the others: two pairs far from each other
    rows = [(0.0, 0.0)] * 1000 + [(0.0, 1.0)] * 10 + [(9.0, 0.0)] * 5 + [(9.0, 1.0)] * 5 + [(None, 1.0)] * 7
    table = spark.createDataFrame(rows, "a double, b double")
    (k, cost, silhouette), _ = L.clusters(table, ["a", "b"], [2, 3])
    assert seen == [4, 4]
    a = [x for x, _ in rows if x is not None]
    b = [y for _, y in rows]
    deviation = lambda v: (sum(x * x for x in v) / len(v) - (sum(v) / len(v)) ** 2) ** 0.5
    # the left pair's 1,010 rows and the right pair's 10 lie about their own means; nulls count for b's spread, as in standardise()
    within = (1000 * 10 / 1010 + 5 * 5 / 10) / deviation(b) ** 2
    points = [(x / deviation(a), y / deviation(b), x) for x, y in rows if x is not None]
    mean = lambda v: sum(v) / len(v)

    def one(i):
        gap = lambda same: [(points[i][0] - p[0]) ** 2 + (points[i][1] - p[1]) ** 2 for j, p in enumerate(points) if (p[2] == points[i][2]) == same and j != i]
        own, other = mean(gap(True)), mean(gap(False))
        return (other - own) / max(own, other)

    want = (1000 * one(0) + 10 * one(1000) + 5 * one(1010) + 5 * one(1015)) / 1020
    assert k == 2 and abs(cost - within) < 1e-6 and abs(silhouette - want) < 1e-9


def test_pairs_of_a_dense_place_meet_in_parts(spark, monkeypatch):
    monkeypatch.setattr(P, "HELD", 40, raising=False)
    rows = [(i, i * 37 % 101 / 1000, i * 53 % 97 / 1000, "pq"[i % 2]) for i in range(300)] + [(300, 1.0, 1.0, "p"), (301, 0.0, 0.0, None)]
    table = spark.createDataFrame(rows, "id int, x double, y double, c string")
    like = lambda x, y: 1 - (abs(x[1] - y[1]) + abs(x[2] - y[2]) + (x[3] != y[3])) / 3
    for least in (0.98, 0.9, 0.6):
        found = P.gower_pairs(table, "id", ["x", "y"], ["c"], least)
        want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[3] and b[3] and like(a, b) >= least}
        assert sorted((r["a"], r["b"]) for r in found.collect()) == sorted(want)
    # the place is dealt to many keys of the join, though all its rows lie in one square
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_part" in plan and "SortMergeJoin" in plan


def test_links_are_counted_without_pairs(spark, monkeypatch):
    monkeypatch.setattr(N, "DEALT", 300)
    monkeypatch.setattr(P, "gower_pairs", None)
    # numbers on a lattice whose steps meet the threshold again and again, as exactly as doubles do; some copies
    rows = [(i, i * 37 % 101 % 21 / 20, i * 53 % 97 % 31 / 30 * 7 - 3, "pqr"[i * i % 3]) for i in range(500)] + [(500, 0.5, 0.5, None)]
    table = spark.createDataFrame(rows, "id int, a double, b double, c string")
    like = lambda x, y: 1 - (abs(x[1] / 1.0 - y[1] / 1.0) + abs(x[2] / 7.0 - y[2] / 7.0) + (x[3] != y[3])) / 3 >= 0.9
    found = {r["id"]: r["n_links"] for r in P.gower_links(table, "id", ["a", "b"], ["c"], 0.9).collect()}
    assert found == {x[0]: sum(like(x, y) for y in rows if x[3] is not None and x is not y) for x in rows}
    assert any(abs(abs(x[1] - y[1]) + abs(x[2] - y[2]) / 7 - 0.3) < 1e-12 for x in rows for y in rows)
    one = {r["id"]: r["n_links"] for r in P.gower_links(table, "id", ["a"], [], 0.9).collect()}
    assert one == {x[0]: sum(1 - abs(x[1] - y[1]) >= 0.9 for y in rows if x is not y) for x in rows}
