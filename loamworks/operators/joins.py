"""Equi-joins, presence checks and spatial joins of points, zones and grids.

Spatial joins go through bucket columns: points are put in square buckets as wide as
the search radius and meet the buckets around their own, so a join is an equi-join
whose candidates are near by construction; the exact test is a filter on them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamworks.operators.grid import nearest_source
from loamworks.session import ship, staged


def chain(left: DataFrame, rights: list[tuple[DataFrame, list[str]]], how: str = "left") -> DataFrame:
    """Joins one after the other; each right side is reduced to one row per key by its own smallest row first."""
    for right, on in rights:
        rest = [c for c in right.columns if c not in on]
        one = right.groupBy(*on).agg(F.min(F.struct(*rest)).alias("_row")).select(*on, *(F.col(f"_row.{c}").alias(c) for c in rest))
        left = left.join(one, on, how)
    return left


def only_left(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Distinct keys of the left that the right does not have; null keys are no keys."""
    return left.select(on).filter(F.col(on).isNotNull()).distinct().join(right.select(on), on, "left_anti")


def outer_by_pivot(long: DataFrame, key: str, column: str, names: list[str], value: str) -> DataFrame:
    """One row per key with a column per name, as a chain of full outer joins of per-name tables gives, by one aggregate."""
    return long.groupBy(key).agg(*(F.max(F.when(F.col(column) == n, F.col(value))).alias(n) for n in names))


def _cell(x: str, y: str, size: float) -> tuple[Column, Column]:
    return F.floor(F.col(x) / size), F.floor(F.col(y) / size)


def near_pairs(left: DataFrame, right: DataFrame, radius: float, x: str = "x", y: str = "y", within: tuple[str, ...] = (), copy_left: bool = False) -> DataFrame:
    """Pairs of points within ``radius``; columns of the right are prefixed with ``n_``; ``dist2`` is the squared distance.

    The right side is copied to the nine buckets around it, or the left one with ``copy_left``; a pair meets in one bucket
    only. Points of different values in the columns ``within`` never meet.
    """
    a = left.withColumns(dict(zip(("_gx", "_gy"), _cell(x, y, radius), strict=True)))
    b = right.select(*(F.col(c).alias(f"n_{c}") for c in right.columns), *(F.col(c) for c in within)).withColumns(dict(zip(("_gx", "_gy"), _cell(f"n_{x}", f"n_{y}", radius), strict=True)))
    a, b = (_around(a), b) if copy_left else (a, _around(b))
    dx, dy = F.col(x) - F.col(f"n_{x}"), F.col(y) - F.col(f"n_{y}")
    return a.join(b, ["_gx", "_gy", *within]).withColumn("dist2", dx * dx + dy * dy).filter(F.col("dist2") <= radius * radius).drop("_gx", "_gy")


def _around(df: DataFrame) -> DataFrame:
    """The rows in their own bucket and the eight around it."""
    around = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))
    return df.withColumn("_o", F.explode(around)).withColumns({"_gx": F.col("_gx") + F.col("_o.i"), "_gy": F.col("_gy") + F.col("_o.j")}).drop("_o")


#: Right points that a square as wide as the first radius of a search may hold, and the most halvings to get there.
FULL, HALVINGS = 256, 24


def _first_radius(placed: DataFrame, radius: float, within: tuple[str, ...], full: int) -> float:
    """``radius`` halved until no square of this width holds more than ``full`` points (or HALVINGS times).

    Only points of squares that hold more are counted again, in the next three widths at once, until a width fits.
    """
    crowded = lambda e: placed.groupBy(*(c.alias(n) for c, n in zip(_cell("x", "y", radius / 2**e), ("_gx", "_gy"), strict=True)), *within).count().filter(F.col("count") > full)
    for e in range(0, HALVINGS, 4):
        above = crowded(e)
        if above.isEmpty():
            return radius / 2**e
        gx, gy = _cell("x", "y", radius / 2**e)
        placed = staged(placed.withColumns({"_gx": gx, "_gy": gy}).join(above.drop("count"), ["_gx", "_gy", *within], "left_semi").select("x", "y", *within), "crowded")
        wide = F.lit(radius) / F.pow(F.lit(2.0), F.col("_e"))
        sizes = placed.withColumn("_e", F.explode(F.sequence(F.lit(e + 1), F.lit(e + 3)))).groupBy("_e", F.floor(F.col("x") / wide).alias("_gx"), F.floor(F.col("y") / wide).alias("_gy"), *within).count()
        fits = sizes.groupBy("_e").agg(F.max("count").alias("n")).filter(F.col("n") <= full).agg(F.min("_e").alias("e")).first()["e"]
        if fits is not None:
            return radius / 2**fits
    return radius / 2**HALVINGS


def nearest(left: DataFrame, right: DataFrame, key: str, radius: float | None, right_key: str, k: int = 1, other: bool = False, bounded: bool = False, within: tuple[str, ...] = (), full: int = FULL) -> DataFrame:
    """The ``k`` nearest right points of each left point, as ``rank`` 1 to k (ties by the right key).

    The search begins within ``radius``; points that have fewer than ``k`` there are looked up again with the doubled
    radius, until each has ``k`` or has met every right point. ``bounded`` searches within ``radius`` only; those who
    find fewer then have fewer rows. With ``other`` a point is not its own neighbour. Without ``radius`` the first one
    is that of a disc that would hold k points if they were spread evenly. Points without coordinates find nothing.
    Neighbours have equal values in the columns ``within``. Of right points on one spot only as many of the smallest keys
    go in as can be among the k, so a spot that holds a third of all points gives no point more than that many pairs.

    Rounds: each is written before the next, and only open points go on. The first radius is halved until no square of
    its width holds more than ``full`` right points (at least 4 k), so places that are dense without being one spot are done
    at small radii. A point that is still open has fewer than k right points within the last radius; where both sides are
    the same points, a square so holds some 9 k open ones at most, and no right point meets more than a multiple of k of
    them in a round. Left points that crowd where the right side has none are not bounded so.
    """
    w = Window.partitionBy(key).orderBy("dist2", f"n_{right_key}")
    spot = Window.partitionBy("x", "y", *within).orderBy(right_key)
    placed = right.filter(F.col("x").isNotNull() & F.col("y").isNotNull()).withColumn("_spot", F.row_number().over(spot)).filter(F.col("_spot") <= k + int(other)).drop("_spot")
    placed = staged(placed, "placed")
    open_ = left.filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    if radius is None or not bounded:
        n, *box = placed.agg(F.count("*"), F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
        low_x, high_x, low_y, high_y = open_.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
        wide = 0.0 if not n or low_x is None else float(max(high_x, box[1]) - min(low_x, box[0]) + max(high_y, box[3]) - min(low_y, box[2]))
        radius = radius or max(wide * math.sqrt(k / max(1, n)), 1e-9)
    last = radius if bounded else wide
    found, size = None, _first_radius(placed, radius, within, max(full, 4 * k))
    while True:
        pairs = near_pairs(open_, placed, size, within=within, copy_left=True)
        if other:
            pairs = pairs.filter(F.col(key) != F.col(f"n_{right_key}"))
        ranked = pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
        if size >= last:  # every right point was met, or every one within the bound
            return ranked if found is None else found.unionByName(ranked)
        ranked = staged(ranked, "nearest")
        complete = ranked.groupBy(key).count().filter(F.col("count") == k).select(key)
        done = ranked.join(complete, key, "left_semi")
        found = done if found is None else found.unionByName(done)
        open_ = staged(open_.join(complete, key, "left_anti"), "open")
        if open_.isEmpty():
            return found
        size *= 2


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point is inside a closed ring (array of struct x, y): a ray to the right crosses it an odd number of times."""
    step = F.aggregate(
        F.sequence(F.lit(1), F.size(ring) - 1),
        F.lit(0),
        lambda n, i: n + _crosses(x, y, F.get(ring, i - 1), F.get(ring, i)).cast("int"),
    )
    return step % 2 == 1


def _crosses(x: Column, y: Column, a: Column, b: Column) -> Column:
    return ((a["y"] > y) != (b["y"] > y)) & (x < (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]) + a["x"])


def box_ring(x0: str, y0: str, x1: str, y1: str) -> Column:
    """The closed ring of a rectangle."""
    return F.array(*(F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))))


#: Edges that a cell of a polygon's cover may have and still not be cut.
FEW = 16


def _cover(x: np.ndarray, y: np.ndarray, finest: float) -> list[tuple[int, int, int, np.ndarray]]:
    """Cells (level, column, row, edges) that cover a closed ring: a cell of level e is ``finest`` times 2**e wide.

    Cells that no edge meets have none and lie wholly inside. A cell with edges is cut in four until it has few of them or is of
    the finest level; its edges are those that a ray to the right from a point in it may cross.
    """
    if len(x) < 2 or not (np.isfinite(x).all() and np.isfinite(y).all()):
        return []
    ax, ay, bx, by = x[:-1], y[:-1], x[1:], y[1:]
    left, right, low, high = np.minimum(ax, bx), np.maximum(ax, bx), np.minimum(ay, by), np.maximum(ay, by)
    level = max(0, math.ceil(math.log2(max(float(right.max() - left.min()), float(high.max() - low.min()), finest) / finest)))
    wide = finest * 2.0**level
    corners = lambda lo, hi: range(math.floor(lo / wide), math.floor(hi / wide) + 1)
    todo = [(level, i, j, np.arange(len(ax))) for i in corners(left.min(), right.max()) for j in corners(low.min(), high.max())]
    out = []
    while todo:
        level, i, j, edges = todo.pop()
        wide = finest * 2.0**level
        x0, y0, x1, y1, more = i * wide, j * wide, (i + 1) * wide, (j + 1) * wide, 1e-9 * wide
        edges = edges[(low[edges] <= y1 + more) & (high[edges] >= y0 - more) & (right[edges] >= x0 - more)]
        if not len(edges):
            continue
        near = edges[left[edges] <= x1 + more]
        side = [(bx[near] - ax[near]) * (cy - ay[near]) - (by[near] - ay[near]) * (cx - ax[near]) for cx in (x0 - more, x1 + more) for cy in (y0 - more, y1 + more)]
        if not ((np.min(side, axis=0) <= 0) & (np.max(side, axis=0) >= 0)).any():
            cx, cy, e = (x0 + x1) / 2, (y0 + y1) / 2, edges
            crossed = (ay[e] > cy) != (by[e] > cy)
            e = e[crossed]
            if np.count_nonzero(cx < (bx[e] - ax[e]) * (cy - ay[e]) / (by[e] - ay[e]) + ax[e]) % 2:
                out.append((level, i, j, e[:0]))
        elif level == 0 or len(edges) <= FEW:
            out.append((level, i, j, edges))
        else:
            todo += [(level - 1, 2 * i + a, 2 * j + b, edges) for a in (0, 1) for b in (0, 1)]
    return out


def polygon_cover(polygons: DataFrame, finest: float, ring: str = "ring") -> DataFrame:
    """One row per cell of each polygon's cover: ``_level``, ``_gx``, ``_gy`` and ``_edges`` (empty: wholly inside), with the polygon's columns but its ring.

    A large polygon has few large cells inside and small ones along its ring; a long ring is cut by cell.
    """
    ship(polygons.sparkSession)
    kept = [c for c in polygons.columns if c != ring]
    edge = "array<struct<ax: double, ay: double, bx: double, by: double>>"
    schema = T.StructType([*(polygons.schema[c] for c in kept), *T.StructType.fromDDL(f"_level int, _gx long, _gy long, _edges {edge}").fields])
    kind = pa.list_(pa.struct([(n, pa.float64()) for n in ("ax", "ay", "bx", "by")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, cells, held = [], [], []
            for k, points in enumerate(batch["_ring"]):
                if not points.is_valid:
                    continue
                x, y = (points.values.field(n).to_numpy(zero_copy_only=False).astype(np.float64) for n in (0, 1))
                for level, i, j, edges in _cover(x, y, finest):
                    at.append(k)
                    cells.append((level, i, j))
                    held.append([{"ax": x[e], "ay": y[e], "bx": x[e + 1], "by": y[e + 1]} for e in edges.tolist()])
            level, gx, gy = zip(*cells, strict=True) if cells else ((), (), ())
            yield pa.RecordBatch.from_arrays([*(batch[c].take(pa.array(at, pa.int64())) for c in kept), pa.array(level, pa.int32()), pa.array(gx, pa.int64()), pa.array(gy, pa.int64()), pa.array(held, kind)], schema.names)

    plain = F.transform(ring, lambda v: F.struct(v["x"].cast("double").alias("x"), v["y"].cast("double").alias("y")))
    return polygons.select(*kept, plain.alias("_ring")).mapInArrow(run, schema)


def points_in_polygons(points: DataFrame, polygons: DataFrame, bucket: float, ring: str = "ring", x: str = "x", y: str = "y") -> DataFrame:
    """Points joined with the polygons they lie in (without their rings, which are closed arrays of struct x, y).

    A point meets a polygon in one cell of its cover at most, whose finest cells are ``bucket`` wide, and is tested against that
    cell's edges only; ``in_ring`` says what counts as inside. Points are sent once per level that a cover has, a few.
    """
    cover = staged(polygon_cover(polygons, bucket, ring), "cover")
    levels = sorted(r["_level"] for r in cover.select("_level").distinct().collect())
    level = F.explode(F.array(*(F.lit(e) for e in levels)) if levels else F.array().cast("array<int>"))
    asked = points.withColumn("_level", level)
    wide = F.lit(bucket) * F.pow(F.lit(2.0), F.col("_level"))
    asked = asked.withColumns({"_gx": F.floor(F.col(x) / wide).cast("long"), "_gy": F.floor(F.col(y) / wide).cast("long")})
    crossed = F.size(F.filter("_edges", lambda e: ((e["ay"] > F.col(y)) != (e["by"] > F.col(y))) & (F.col(x) < (e["bx"] - e["ax"]) * (F.col(y) - e["ay"]) / (e["by"] - e["ay"]) + e["ax"])))
    met = asked.join(cover, ["_level", "_gx", "_gy"])
    return met.filter((F.size("_edges") == 0) | (crossed % 2 == 1)).drop("_level", "_gx", "_gy", "_edges")


def one_polygon_each(points: DataFrame, polygons: DataFrame, key: str, polygon: str, bucket: float) -> DataFrame:
    """Every point with the polygon of smallest id it lies in, or nulls."""
    pairs = points_in_polygons(points, polygons, bucket).groupBy(key).agg(F.min(polygon).alias(polygon))
    return points.join(pairs, key, "left")


def chained(points: DataFrame, layers: list[tuple[DataFrame, str]], key: str, bucket: float) -> DataFrame:
    """One point layer joined with several polygon layers; each adds its polygon id."""
    for polygons, polygon in layers:
        points = one_polygon_each(points, polygons, key, polygon, bucket)
    return points


def sample_grid(points: DataFrame, cells: DataFrame, bands: list[str], x0: float = 0.0, y0: float = 0.0, size: float = 1.0, keep_outside: bool = True, fill: float | None = None) -> DataFrame:
    """Band values of the cell under each point; points off the grid are kept with the fill value, or dropped."""
    at = points.withColumns({"c": F.floor((F.col("x") - x0) / size).cast("int"), "r": F.floor((F.col("y") - y0) / size).cast("int")})
    joined = at.join(cells.select("r", "c", *bands), ["r", "c"], "left" if keep_outside else "inner")
    return joined.fillna(fill, bands) if fill is not None and keep_outside else joined


def overlay(cells: DataFrame, a: str, b: str, cell_area: float = 1.0) -> DataFrame:
    """Area of every pair of zones that share cells."""
    return cells.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg((F.count("*") * cell_area).alias("area"))


def largest_share(pairs: DataFrame, unit: str, kind: str, area: str = "area") -> DataFrame:
    """The kind with the largest part of each unit (ties: the smallest kind) and its share."""
    w = Window.partitionBy(unit)
    ranked = pairs.withColumns({"share": F.col(area) / F.sum(area).over(w), "_n": F.row_number().over(w.orderBy(F.col(area).desc(), kind))})
    return ranked.filter("_n = 1").drop("_n")


def majority(df: DataFrame, unit: str, value: str, into: str = "majority") -> DataFrame:
    """The commonest value of each unit (ties: the smallest), with its share."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(unit, value).agg(F.count("*").alias("n"))
    found = largest_share(counts, unit, value, "n")
    return found.select(unit, F.col(value).alias(into), F.col("share").alias(f"{into}_share"))


def assign_kind(overlap: DataFrame, points: DataFrame, predicted: DataFrame, unit: str, sure: float = 0.5) -> DataFrame:
    """A unit's kind: by largest overlap; by its points where they are more certain; by predicted cells where it is below ``sure``."""
    joined = overlap.join(points, unit, "left").join(predicted, unit, "left")
    by_points = F.col("points_share") > F.col("share")
    kind = F.when(by_points, F.col("points")).otherwise(F.col("kind"))
    certain = F.when(by_points, F.col("points_share")).otherwise(F.col("share"))
    return joined.select(unit, F.when((certain < sure) & F.col("predicted").isNotNull(), F.col("predicted")).otherwise(kind).alias("kind"), certain.alias("certainty"))


def along_line(lines: DataFrame, cells: DataFrame, key: str, vertices: str, band: str) -> DataFrame:
    """Band values at the vertices of lines, one row per vertex in order ``pos``."""
    points = lines.select(key, F.posexplode(vertices).alias("pos", "_v")).select(key, "pos", F.col("_v.x").alias("x"), F.col("_v.y").alias("y"))
    return sample_grid(points, cells, [band])


def height_above(cells: DataFrame, source: Column, band: str, reach: int | None = None) -> DataFrame:
    """``hand``: band minus the band of the nearest source cell (ties: smallest row, then column); with a ``reach`` in cells, null beyond it."""
    found = nearest_source(cells, source & F.col(band).isNotNull(), reach, F.col(band))
    return found.select("r", "c", (F.col(band) - F.col("_held")).alias("hand"))
