"""Neighbour searches, clusters, weights and synthetic rows against brute force, with a third of all points on one spot."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from loamworks.operators import graph as P
from loamworks.operators import joins as J
from loamworks.operators import models as L
from loamworks.operators import sampling as B

RNG = random.Random(8)
POINTS = [(i, *((5.0, 5.0) if i % 3 == 0 else (round(RNG.uniform(0, 40), 1), round(RNG.uniform(0, 9), 1))), "abc"[i % 7 % 3], float(i % 11)) for i in range(150)]
POINTS += [(200, 900.0, 900.0, "a", 1.0), (201, 904.0, 900.0, "a", 2.0), (202, 5.0, 5.1, "d", 3.0), (203, 39.0, 1.0, "e", 4.0), (204, 0.0, 2.0, "e", 5.0)]


@pytest.fixture(scope="module")
def points(spark):
    return spark.createDataFrame(POINTS, "id int, x double, y double, cls string, ph double")


def d2(a, b):
    return (a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2


def nearest(p, k, same_class):
    return sorted((d2(p, q), q[0]) for q in POINTS if q[0] != p[0] and (not same_class or q[3] == p[3]))[:k]


@pytest.mark.parametrize("same_class", [False, True])
def test_k_nearest_with_a_crowded_spot(points, same_class):
    found = J.nearest(points, points, "id", None, "id", k=4, other=True, within=("cls",) if same_class else ()).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["id"], r["rank"])):
        got.setdefault(r["id"], []).append((round(r["dist2"], 9), r["n_id"]))
    assert got == {p[0]: [(round(d, 9), i) for d, i in nearest(p, 4, same_class)] for p in POINTS if nearest(p, 4, same_class)}


def test_a_crowded_spot_makes_few_pairs(spark):
    crowd = spark.range(3000).selectExpr("cast(id as int) AS id", "CASE WHEN id % 3 = 0 THEN 7.0D ELSE cast(id as double) END AS x", "0.0D AS y")
    found = J.nearest(crowd, crowd, "id", 3.0, "id", k=5, other=True, bounded=True)
    made = found.sparkSession.createDataFrame([(0,)], "i int")  # the plan is read, not run
    assert "row_number" in found._jdf.queryExecution().toString() and made.count() == 1
    assert found.filter("id % 3 = 0").count() == 5 * 1000
    clusters = B.density_clusters(crowd, "id", 1.5, 3)
    assert clusters.filter("x = 7 and cluster is not null").count() == 1000 + (7 % 3 != 0)


@pytest.mark.parametrize("bounded", [False, True])
def test_a_dense_place_makes_few_pairs(spark, monkeypatch, bounded):
    """A third of all points lies in a place a millionth as wide as the others' and on no common spot."""
    rng, k, n = random.Random(4), 3, 900
    rows = [(i, *(((500 + rng.random() / 1000, 500 + rng.random() / 1000) if i % 3 == 0 else (rng.random() * 1000, rng.random() * 1000)))) for i in range(n)]
    met = []

    def counted(*args, **kwargs):
        found = J.staged(pairs(*args, **kwargs), "counted")
        met.append(found.count())
        return found

    pairs = J.near_pairs
    monkeypatch.setattr(J, "near_pairs", counted)
    df, reach = spark.createDataFrame(rows, "id int, x double, y double"), 60.0
    got = {}
    for r in sorted(J.nearest(df, df, "id", reach if bounded else None, "id", k=k, other=True, bounded=bounded, full=20).collect(), key=lambda r: (r["id"], r["rank"])):
        got.setdefault(r["id"], []).append(r["n_id"])
    best = {p[0]: [(d, i) for d, i in sorted((d2(p, q), q[0]) for q in rows if q[0] != p[0])[:k] if not bounded or d <= reach**2] for p in rows}
    assert got == {i: [j for _, j in b] for i, b in best.items() if b}
    assert len(met) > 8 and max(met) < 27 * k * n / 4 and sum(met) < (n / 3) ** 2 / 2


def test_density_clusters(points):
    eps, least = 1.3, 4
    near = {p[0]: [q[0] for q in POINTS if d2(p, q) <= eps * eps] for p in POINTS}
    cores = {i for i, n in near.items() if len(n) >= least}
    label = {}
    for i in sorted(cores):
        if i not in label:
            front = [i]
            while front:
                j = front.pop()
                if j not in label:
                    label[j] = i
                    front += [m for m in near[j] if m in cores]
    at = {p[0]: p for p in POINTS}
    want = {p[0]: label.get(p[0], label.get(min(((d2(p, at[m]), m) for m in near[p[0]] if m in cores), default=(0, None))[1])) for p in POINTS}
    assert {r["id"]: r["cluster"] for r in B.density_clusters(points, "id", eps, least).collect()} == want


def test_weights_are_kth_distances(points):
    got = {r["id"]: r["weight"] for r in B.density_weights(points, "id", "cls", ["x", "y"], 3).collect()}
    want = {p[0]: math.sqrt(max((d for d, _ in nearest(p, 3, True)), default=0)) for p in POINTS}
    assert got == pytest.approx(want)
    thin = B.density_downsample(points.filter("cls = 'a'"), "id", "cls", ["x", "y"], 10, 3)
    assert thin.count() == 10 and {200, 201} <= {r["id"] for r in thin.collect()}


def test_every_point_with_company_gets_its_rows(points):
    made = B.interpolate(points, "id", "cls", ["x", "y", "ph"], 3, 2).collect()
    assert len(made) == 2 * sum(bool(nearest(p, 1, True)) for p in POINTS)
    at = {p[0]: p for p in POINTS}
    for r in made:
        base = at[r["id"]]
        assert any(min(base[1], q[1]) - 1e-9 <= r["x"] <= max(base[1], q[1]) + 1e-9 and min(base[4], q[4]) - 1e-9 <= r["ph"] <= max(base[4], q[4]) + 1e-9 for q in (at[i] for _, i in nearest(base, 3, True)))
    apart = B.interpolate(points, "id", "cls", ["x", "y", "ph"], 3, 2, apart=0.3).collect()
    far = lambda r: all((r["x"] - q[1]) ** 2 + (r["y"] - q[2]) ** 2 >= 0.09 for q in POINTS)
    assert {(r["id"], r["copy"]) for r in apart} == {(r["id"], r["copy"]) for r in made if far(r)} and 0 < len(apart) < len(made)


def test_gower_links(points):
    span_x, span_p = 904.0, 10.0
    like = lambda a, b: 1 - (abs(a[1] - b[1]) / span_x + abs(a[4] - b[4]) / span_p + (a[3] != b[3])) / 3
    for least in (0.9, 0.613):
        pairs = {(r["a"], r["b"]): r["similarity"] for r in P.gower_pairs(points, "id", ["x", "ph"], ["cls"], least).collect()}
        want = {(a[0], b[0]): like(a, b) for a in POINTS for b in POINTS if a[0] < b[0] and like(a, b) >= least}
        assert pairs == pytest.approx(want)
        links = {r["id"]: (r["representative"], r["n_links"]) for r in P.gower_links(points, "id", ["x", "ph"], ["cls"], least).collect()}
        assert links == {a[0]: (min(b[0] for b in POINTS if (b[1], b[4], b[3]) == (a[1], a[4], a[3])), sum(a[0] in p for p in want)) for a in POINTS}


def test_representatives_settle(points):
    found = L.representatives(points, "id", "cls", ["x", "y"], 3, settled="settled")
    rows = found.collect()
    assert all(r["settled"] for r in rows) and {r["cls"] for r in rows} == {"a", "b", "c", "d", "e"}
    assert len({(r["cls"], r["cluster"]) for r in rows}) == len(rows)
    assert not any(r["settled"] for r in L.representatives(points, "id", "cls", ["x", "y"], 3, rounds=1, settled="settled").collect())
    assert found.filter(F.col("cls") == "e").count() == 2
