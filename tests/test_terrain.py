"""Filling, flats, boxes in tiles and nearest sources against brute force, on made surfaces."""

from __future__ import annotations

import heapq
import math
import random

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from loamworks.operators import graph as P
from loamworks.operators import grid as G
from loamworks.operators import hydrology as H
from loamworks.operators import tiles
from loamworks.sources.fixtures import Tables

AROUND = [(0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1)]


def around(p):
    return [(p[0] + i, p[1] + j) for i, j in AROUND]


def lowest_passes(z):
    level = {p: v for p, v in z.items() if v is not None and any(z.get(q) is None for q in around(p))}
    heap = [(v, p) for p, v in level.items()]
    heapq.heapify(heap)
    done = set()
    while heap:
        v, p = heapq.heappop(heap)
        if p not in done:
            done.add(p)
            for q in around(p):
                if z.get(q) is not None and max(v, z[q]) < level.get(q, float("inf")):
                    level[q] = max(v, z[q])
                    heapq.heappush(heap, (level[q], q))
    return {p: level.get(p) for p in z}


def surface(spark, z):
    return spark.createDataFrame([(r, c, v) for (r, c), v in z.items()], "r int, c int, dem double")


def rough(rows, columns, heights, seed, gaps=0.02):
    rng = random.Random(seed)
    return {(r, c): None if rng.random() < gaps else float(rng.randrange(heights)) for r in range(rows) for c in range(columns) if rng.random() > gaps}


@pytest.mark.parametrize(("side", "small"), [(8, 0), (8, 1 << 18), (64, 0)])
def test_filling_by_spill_levels(spark, side, small, monkeypatch):
    z = rough(45, 38, 9, side) | {(r, c): 50.0 if 5 <= r <= 30 and c in (4, 33) or r in (5, 30) and 4 <= c <= 33 else 3.0 for r in range(4, 32) for c in range(3, 35)}
    levels = H.spill_levels
    monkeypatch.setattr(H, "spill_levels", lambda passes: levels(passes, small))
    got = {(r["r"], r["c"]): r["filled"] for r in H.fill_sinks(surface(spark, z), "dem", side).collect()}
    assert got == lowest_passes(z)


def test_rounds_do_not_grow_with_a_winding_valley(spark, monkeypatch):
    """A valley of one cell winds through 4,096 columns, up and down between walls; every tile's water runs on to the next."""
    rows = 14
    z = {(r, c): 1000.0 for r in range(rows) for c in range(4096)}
    path = []
    for k, c in enumerate(range(1, 4095, 2)):
        column = [(r, c) for r in range(1, rows - 1)]
        path += column if k % 2 == 0 else column[::-1]
        path.append((path[-1][0], c + 1))
    for k, p in enumerate(path[:-1]):
        z[p] = 500.0 - 0.01 * k + (3.0 if k % 97 == 0 else 0.0)
    z[(path[-2][0], 4095)] = 1.0
    rounds = []
    components = H.components
    monkeypatch.setattr(H, "components", lambda edges: rounds.append(1) or components(edges))
    levels = H.spill_levels
    monkeypatch.setattr(H, "spill_levels", lambda passes: levels(passes, 0))
    got = {(r["r"], r["c"]): r["filled"] for r in H.fill_sinks(surface(spark, z), "dem", 64).collect()}
    assert got == lowest_passes(z) and len(rounds) <= 12


def flat_directions(z):
    """The definition, cell by cell."""
    code, edge = {}, {}
    for p, v in z.items():
        if v is None:
            continue
        n = [z.get(q) for q in around(p)]
        edge[p] = any(x is None for x in n)
        drops = [-1 if x is None else (v - x) / (math.sqrt(2) if i % 2 else 1.0) for i, x in enumerate(n)]
        code[p] = H.CODES[drops.index(max(drops))] if max(drops) > 0 and not edge[p] else (None if edge[p] else 0)
    flat = {p for p, x in code.items() if x == 0}

    def steps(start, free):
        d, front = dict.fromkeys(start[1], start[0]), list(start[1])
        while front:
            found = []
            for p in front:
                for q in around(p):
                    if q in free and q not in d and z[q] == z[p]:
                        d[q] = d[p] + 1
                        found.append(q)
            front = found
        return d

    low = steps((0, [p for p in code if p not in flat]), flat)
    high = steps((1, [p for p in flat if any(z[q] > z[p] for q in around(p))]), flat)
    out = {}
    for p in flat:
        if p in low:
            g = lambda q: 2 * low[q] - high.get(q, 0) if q in flat else -(1 << 20)  # noqa: B023, E731
            drops = [(g(p) - g(q)) / (math.sqrt(2) if i % 2 else 1.0) if z[q] == z[p] and (q not in flat or q in low) else 0 for i, q in enumerate(around(p))]
            out[p] = H.CODES[drops.index(max(drops))]
        else:
            out[p] = 0
    return out


def test_flats_drain(spark):
    z = lowest_passes(rough(50, 60, 6, 3, 0.005))
    plain = {(r["r"], r["c"]): r["direction"] for r in H.flow_direction(surface(spark, z), "dem").collect()}
    want = plain | flat_directions(z)
    for side in (16, 256):
        got = {(r["r"], r["c"]): r["direction"] for r in H.flow_over_flats(surface(spark, z), "dem", side).collect()}
        assert got == want
    assert any(plain[p] == 0 != want[p] for p in z)
    step = dict(zip(H.CODES, AROUND, strict=True))
    for p in z:
        seen = 0
        while want[p]:  # every cell's flow ends on the edge
            p, seen = (p[0] + step[want[p]][0], p[1] + step[want[p]][1]), seen + 1
            assert seen < len(z)
        assert want[p] is None or any(z.get(q) is None for q in around(p))


def test_filled_ground_drains_to_the_edge(spark):
    cells = Tables(spark, DATA).cells.select("r", "c", "dem")
    found = H.drained(cells, "dem")
    assert found.count() == cells.count()
    z = {(r["r"], r["c"]): r["filled"] for r in found.collect()}
    ends = H.accumulate(H.downstream(found)).filter("node = basin")
    assert ends.agg(F.sum("acc")).first()[0] == sum(v is not None for v in z.values())
    for r in ends.collect():
        assert any(z.get(q) is None for q in around((r["node"] // P.ROW, r["node"] % P.ROW)))
    empty = spark.createDataFrame([], "r int, c int, dem double")
    assert H.drained(empty, "dem").count() == 0


def nearest(p, sources):
    return min(((p[0] - r) ** 2 + (p[1] - c) ** 2, r, c) for r, c in sources) if sources else None


@pytest.mark.parametrize("seed", range(4))
def test_nearest_source_without_bound(spark, seed):
    rng = random.Random(seed)
    places = rng.sample([(r, c) for r in range(-9, 40) for c in range(-5, 50)], (900, 300, 60, 2000)[seed])
    places += [(400, 300 + seed), (-200, 7)]
    sources = set(rng.sample(places, (40, 4, 30, 300)[seed]))
    cells = spark.createDataFrame([(r, c, (r, c) in sources, f"{r}/{c}") for r, c in places], "r int, c int, s boolean, name string")
    for reach in (None, 5):
        got = {(r["r"], r["c"]): (r["_d2"], r["_held"]) for r in G.nearest_source(cells, F.col("s"), reach, F.col("name")).collect()}
        for p in places:
            d, r, c = nearest(p, sources)
            assert got[p] == ((None, None) if reach and d > reach * reach else (d, f"{r}/{c}")), (p, reach)
    assert {(r["_d2"], r["_held"]) for r in G.nearest_source(cells, F.lit(False)).collect()} == {(None, None)}
    assert G.distance(cells.limit(0), F.col("s")).count() == 0


def test_rule_repair_leaves_no_breach(spark):
    cells = spark.createDataFrame([(0, c, 9 if c < 500 else 1) for c in range(510)], "r int, c int, dz int")
    assert {r["dz"] for r in P.nearest_value(cells, F.col("dz") <= 4, "dz").collect()} == {1}


# --- boxes in tiles


@pytest.mark.parametrize(("low", "high", "side"), [(-1, 1, 4), (-3, 3, 256), (-7, 2, 8), (1, 3, 8), (0, 0, 4), (-30, 30, 61)])
def test_boxes(spark, low, high, side):
    rng = random.Random(low + 7 * high)
    z = {(r, c): rng.choice([None, rng.randrange(50)]) for r in range(-6, 25) for c in range(-3, 30) if rng.random() < 0.8}
    cells = spark.createDataFrame([(r, c, v, "t") for (r, c), v in z.items()], "r int, c int, v int, note string")
    asked = {"s": ("sum", F.col("v")), "d": ("sum", F.col("v") / 4), "lo": ("min", F.col("v")), "hi": ("max", F.col("v").cast("double"))}
    found = tiles.boxes(cells, asked, low, high, side)
    assert found.columns == ["r", "c", "v", "note", *asked] and [t for _, t in found.dtypes][-4:] == ["bigint", "double", "int", "double"]
    got = {(r["r"], r["c"]): r for r in found.collect()}
    assert len(got) == len(z)
    for (r, c), v in z.items():
        box = [z[r + i, c + j] for i in range(low, high + 1) for j in range(low, high + 1) if z.get((r + i, c + j)) is not None]
        row = got[r, c]
        assert (row["v"], row["note"]) == (v, "t")
        assert (row["s"], row["lo"], row["hi"]) == ((sum(box), min(box), max(box)) if box else (None, None, None))
        assert row["d"] == (sum(box) / 4 if box else None)
    assert tiles.boxes(cells.limit(0), asked, low, high).count() == 0


def test_a_wide_box_costs_what_a_narrow_one_does():
    """Running passes: the work on an array does not depend on the box; a wide halo has tiles to match, so a cell has few copies."""
    import time

    a = np.random.default_rng(0).random((600, 600))

    def seconds(k):
        best = 9.0
        for _ in range(5):
            began = time.perf_counter()
            tiles.over_boxes(a, -k, k, np.add, 0.0)
            best = min(best, time.perf_counter() - began)
        return best

    assert seconds(50) < 3 * seconds(1)
    assert all((1 + 2 * k / tiles.side_for(2 * k)) ** 2 <= 2.26 for k in (1, 25, 50, 500))
