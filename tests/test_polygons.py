"""Polygon covers against the ray test over whole rings."""

from __future__ import annotations

import math
import random

import pytest

from loamworks.operators import joins as J

SCHEMA = "pid int, ring array<struct<x:double,y:double>>, x0 double, y0 double, x1 double, y1 double"


def star(rng, x, y, size, n):
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    ring = [(x + size * rng.uniform(0.2, 1) * math.cos(a), y + size * rng.uniform(0.2, 1) * math.sin(a)) for a in turns]
    return [*ring, ring[0]]


def row(pid, ring):
    xs, ys = zip(*ring, strict=True)
    return pid, [{"x": x, "y": y} for x, y in ring], min(xs), min(ys), max(xs), max(ys)


def inside(x, y, ring):
    n = 0
    for (ax, ay), (bx, by) in zip(ring, ring[1:], strict=False):
        n += ((ay > y) != (by > y)) and x < (bx - ax) * (y - ay) / (by - ay) + ax
    return n % 2 == 1


@pytest.mark.parametrize("bucket", [0.7, 5.0, 300.0])
def test_points_in_overlapping_and_concave_polygons(spark, bucket):
    rng = random.Random(5)
    rings = [star(rng, rng.uniform(-40, 40), rng.uniform(-40, 40), rng.choice([1, 8, 60]), rng.choice([3, 9, 400])) for _ in range(14)]
    rings += [[(-50.0, -50.0), (50.0, -50.0), (50.0, 50.0), (-50.0, 50.0), (-50.0, -50.0)], [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0), (0.0, 0.0)], [(1.0, 1.0), (2.0, 2.0), (1.0, 1.0)]]
    places = [(rng.uniform(-60, 60), rng.uniform(-60, 60)) for _ in range(500)] + [(float(i), float(j)) for i in range(-2, 6) for j in range(-2, 6)] + [(50.0, 50.0), (-50.0, -50.0)]
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(places)], "id int, x double, y double")
    polygons = spark.createDataFrame([*(row(k, r) for k, r in enumerate(rings)), (99, None, 0.0, 0.0, 1.0, 1.0), (98, [], 0.0, 0.0, 1.0, 1.0)], SCHEMA)
    got = sorted((r["id"], r["pid"]) for r in J.points_in_polygons(points, polygons, bucket).collect())
    assert got == sorted((i, k) for i, p in enumerate(places) for k, ring in enumerate(rings) if inside(*p, ring))


def test_a_large_polygon_has_few_cells(spark):
    rng = random.Random(1)
    square = [(0.0, 0.0), (1e4, 0.0), (1e4, 1e4), (0.0, 1e4), (0.0, 0.0)]
    wavy = [(5000 + (4000 + 300 * math.sin(9 * a)) * math.cos(a), 5000 + (4000 + 300 * math.sin(9 * a)) * math.sin(a)) for a in (2 * math.pi * k / 2000 for k in range(2000))]
    polygons = spark.createDataFrame([row(1, square), row(2, [*wavy, wavy[0]])], SCHEMA)
    cover = {r["pid"]: r for r in J.polygon_cover(polygons, 1.0).groupBy("pid").agg({"_gx": "count", "_edges": "max"}).collect()}
    assert cover[1]["count(_gx)"] <= 4 and cover[2]["count(_gx)"] < 2 * len(wavy)  # a hundred million buckets lie in the square
    points = spark.createDataFrame([(i, rng.uniform(0, 1e4), rng.uniform(0, 1e4)) for i in range(300)], "id int, x double, y double")
    assert J.points_in_polygons(points, polygons.limit(0), 1.0).count() == 0
    assert J.points_in_polygons(points, polygons, 1.0).filter("pid = 1").count() == 300
