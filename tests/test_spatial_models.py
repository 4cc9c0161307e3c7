"""Variograms, kriging and the significance of Moran's I against known fields and brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamworks.operators import graph as P
from loamworks.operators import models as L


@pytest.mark.parametrize("law", [L.Variogram("spherical", 0.4, 2.0, 12.0), L.Variogram("exponential", 0.0, 3.0, 4.0), L.Variogram("exponential", 1.0, 0.5, 9.0)])
def test_the_fit_finds_model_sill_and_range(spark, law):
    h = np.linspace(0.5, 30, 30)
    bins = spark.createDataFrame([(i, 100 + i, float(x), float(law.gamma(np.array([x]))[0])) for i, x in enumerate(h)], "bin int, n long, distance double, gamma double")
    found = L.fit_variogram(bins)
    assert found.model == law.model and found[1:] == pytest.approx(law[1:], rel=0.02, abs=0.02)
    assert L.fit_variogram(bins.limit(0)).sill == 0


def field(law, n, seed):
    rng = np.random.default_rng(seed)
    at = rng.uniform(0, 60, (n, 2))
    h = np.hypot(*(at[:, None] - at[None]).transpose(2, 0, 1))
    cov = law.sill * (1 - law.shape(h)) + law.nugget * np.eye(n)
    return at, np.linalg.cholesky(cov + 1e-9 * np.eye(n)) @ rng.standard_normal(n)


def test_a_made_field_gives_back_its_variogram(spark):
    law = L.Variogram("exponential", 0.1, 2.0, 6.0)
    at, v = field(law, 1500, 3)
    points = spark.createDataFrame([(i, float(x), float(y), float(z)) for i, ((x, y), z) in enumerate(zip(at, v, strict=True))], "id int, x double, y double, v double")
    found = L.fit_variogram(L.variogram(points, "id", "v", 20.0, 15), ("exponential",))
    assert 1.3 < found.sill + found.nugget < 3.0 and 3.0 < found.scale < 11.0


@pytest.mark.parametrize("model", ["spherical", "exponential"])
def test_kriging_systems(spark, model):
    law = L.Variogram(model, 0.2, 1.5, 9.0)
    at, v = field(law, 40, 1)
    sites = [(i, float(x), float(y), float(z)) for i, ((x, y), z) in enumerate(zip(at, v, strict=True))]
    sites += [(50, sites[0][1], sites[0][2], 1.0), (51, 3.0, 3.0, None)]
    targets = [(0, 10.0, 10.0), (1, sites[5][1], sites[5][2]), (2, 200.0, 5.0), (3, None, 1.0)]
    found = L.kriging(spark.createDataFrame(targets, "t int, x double, y double"), spark.createDataFrame(sites, "id int, x double, y double, v double"), "t", "id", "v", None, law.sill, law.scale, law.nugget, k=6, model=model, variance="var")
    got = {r["t"]: (r["kriged"], r["var"]) for r in found.collect()}
    for t, x, y in targets[:3]:
        p = np.array(sorted((q for q in sites if q[3] is not None), key=lambda q: ((q[1] - x) ** 2 + (q[2] - y) ** 2, q[0]))[:6])
        a = np.ones((7, 7))
        a[6, 6] = 0
        a[:6, :6] = law.gamma(np.hypot(p[:, None, 1] - p[None, :, 1], p[:, None, 2] - p[None, :, 2]))
        b = np.append(law.gamma(np.hypot(p[:, 1] - x, p[:, 2] - y)), 1)
        w = np.linalg.lstsq(a, b, rcond=None)[0]
        assert got[t] == pytest.approx((w[:6] @ p[:, 3], max(w @ b, 0)), abs=1e-6)
    assert got[3] == (None, None) and got[1][0] == pytest.approx(sites[5][3], abs=1e-6)


def test_the_better_model_is_chosen(spark):
    """A smooth field with features that tell nothing: kriged residuals do better; without spatial order the forest is as good."""
    rng = np.random.default_rng(2)
    at, v = field(L.Variogram("exponential", 0.01, 4.0, 15.0), 400, 7)
    rows = [(i, float(x), float(y), float(z), float(rng.random())) for i, ((x, y), z) in enumerate(zip(at, v, strict=True))]
    df = spark.createDataFrame(rows, "id int, x double, y double, v double, f double")
    report = {r["model"]: r for r in L.regression_kriging(df, ["f"], "v", "id", 20.0).collect()}
    kriged, plain = report["forest + kriged residuals"], report["forest"]
    assert kriged["chosen"] and not plain["chosen"] and kriged["r2"] > 0.5 > plain["r2"]
    best = L.best_predictions(df.filter("id >= 20"), df.filter("id < 20").drop("v"), ["f"], "v", "id", 20.0).collect()
    assert len(best) == 20 and {r["model"] for r in best} == {"forest + kriged residuals"} and all(r["variance"] >= 0 for r in best)
    assert np.corrcoef([r["prediction"] for r in best], [v[r["id"]] for r in best])[0, 1] > 0.6


def test_moran_against_the_same_draws(spark):
    side = 9
    rng = np.random.default_rng(4)
    value = {r * side + c: float(r + c + rng.normal()) for r in range(side) for c in range(side)}
    links = [(a, b) for a in value for b in value if a != b and max(abs(a // side - b // side), abs(a % side - b % side)) == 1]
    values = spark.createDataFrame(list(value.items()), "zone int, v double")
    edges = spark.createDataFrame(links, "src int, dst int")
    got = P.moran_test(values, edges, "zone", "v", 49, 7).first()
    mean = np.mean(list(value.values()))
    z = {k: v - mean for k, v in value.items()}
    around = {k: [b for a, b in links if a == k] for k in z}
    i = lambda lag: sum(z[k] * lag[k] for k in z) / sum(v * v for v in z.values())
    observed = i({k: np.mean([z[b] for b in around[k]]) for k in z})
    zones = values.select("zone", F.lit(0.0).alias("z"))
    number = {r["n"]: r["zone"] for r in P.numbered(zones.select("zone"), "zone", "n").collect()}
    assert sorted(number) == list(range(len(value)))
    drawn = {}
    for r in P.permuted_neighbours(zones, edges, "zone", 49, 7).collect():
        assert number[r["at"]] != r["zone"]
        drawn.setdefault(r["draw"], {}).setdefault(r["zone"], []).append(z[number[r["at"]]])
    made = [i({k: np.mean(v) for k, v in d.items()}) for d in drawn.values()]
    expected = -1 / (len(z) - 1)
    p = (1 + sum(abs(x - expected) >= abs(observed - expected) for x in made)) / (len(made) + 1)
    assert len(made) == 49 and (got["i"], got["expected"], got["mean"], got["std"], got["p"]) == pytest.approx((observed, expected, np.mean(made), np.std(made), p))
    assert got["p"] == 0.02
    noise = values.withColumn("v", F.rand(3))
    assert P.moran_test(noise, edges, "zone", "v", 49, 7).first()["p"] > 0.05
