"""Counts of the points in a box around each point, without pairs: work grows with the points times the logarithm of a task's share.

The number of points in a box is made of the numbers below its four corners. Points and corners are dealt into strips by their first
coordinate, then into buckets by the second. What lies below a corner is in its own strip (counted there), in an earlier strip and
its own bucket (counted there), or in an earlier strip and an earlier bucket (running sums over strips x buckets).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamworks.session import discard, ship, staged

#: Points and corners of a strip or bucket, about.
DEALT = 200_000


def _below(rank: np.ndarray, weight: np.ndarray, upto: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each query the weight of the first ``upto`` items whose rank is under ``least``: the items are split by one bit of the rank after another."""
    total, low, high = np.zeros(len(upto), np.int64), np.zeros(len(upto), np.int64), upto
    for bit in reversed(range(len(rank).bit_length())):
        ones = rank >> bit & 1
        order = np.argsort(ones, kind="stable")
        rank, weight = rank[order], weight[order]
        zeros = np.concatenate(([0], np.cumsum(1 - ones)))
        sums = np.concatenate(([0], np.cumsum(weight)))
        right, low0, high0 = least >> bit & 1 == 1, zeros[low], zeros[high]
        total += np.where(right, sums[high0] - sums[low0], 0)
        low, high = np.where(right, zeros[-1] + low - low0, low0), np.where(right, zeros[-1] + high - high0, high0)
    return total


def dominated(klass: np.ndarray, first: np.ndarray, second: np.ndarray, weight: np.ndarray, corner: np.ndarray, strict: bool = False) -> np.ndarray:
    """For each corner the weight of the points of its class with ``first`` (``strict``: below) and ``second`` up to its own; corners and points in one table, told by ``corner``."""

    def points_before(values: np.ndarray, corners_first: bool) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((corner != corners_first, values, klass))
        n = np.empty(len(order), np.int64)
        n[order] = np.cumsum(~corner[order])
        return n, order

    (upto, order), (least, _) = points_before(first, strict), points_before(second, False)
    points = order[~corner[order]]
    found = _below(least[points] - 1, weight[points], upto[corner], least[corner])
    # points of earlier classes come before in both orders
    sums = np.concatenate(([0], np.cumsum(weight[points])))
    return found - sums[np.searchsorted(klass[points], klass[corner])]


def within_boxes(points: DataFrame, reach: float) -> DataFrame:
    """(key, n): for each point (key, klass, u, v, n) the summed n of the points of its class with u above u - reach and up to u + reach, and v likewise, itself among them."""
    ship(points.sparkSession)
    parts = max(1, -(-5 * points.count() // DEALT))
    u, v = ((F.col(x) + reach, F.col(x) - reach) for x in "uv")
    corners = F.array(*(F.struct(a.alias("a"), b.alias("b"), F.lit(sign).alias("sign")) for a, b, sign in ((u[0], v[0], 1), (u[1], v[0], -1), (u[0], v[1], -1), (u[1], v[1], 1))))
    rows = points.select(F.lit(None).cast("long").alias("key"), "klass", "u", "v", F.col("n").cast("long").alias("n"), F.lit(0).alias("sign"))
    rows = rows.unionAll(points.select("key", "klass", F.inline(corners)).select("key", "klass", "a", "b", F.lit(0).cast("long"), "sign"))

    def counted(name: str, at: str, first: str, strict: bool):
        def work(batches):
            held = list(batches)
            if held:
                t = pa.Table.from_batches(held).combine_chunks()
                klass, one, v, n, sign = (t[c].to_numpy() for c in ("klass", first, "v", "n", "sign"))
                below = np.zeros(len(n), np.int64)
                below[sign != 0] = dominated(klass, one, v, n, sign != 0, strict)
                below += t["below"].to_numpy()
                yield from t.set_column(t.schema.get_field_index("below"), "below", pa.array(below)).to_batches()

        return lambda df: (lambda cut: cut.mapInArrow(work, cut.schema))(df.repartitionByRange(parts, "klass", at, *({"u": ["v"], "v": ["strip"]}[at])).withColumn(name, F.spark_partition_id()))

    strips = staged(counted("strip", "u", "u", False)(rows.withColumn("below", F.lit(0).cast("long"))).drop("u"), "strips")
    dealt = staged(counted("bucket", "v", "strip", True)(strips).drop("v"), "buckets")
    discard(strips)
    cells = dealt.groupBy("klass", "strip", "bucket").agg(F.sum("n").alias("w"))
    grid = dealt.select("klass", "strip").distinct().join(dealt.select("klass", "bucket").distinct(), "klass").join(cells, ["klass", "strip", "bucket"], "left")
    before = lambda by, along: Window.partitionBy("klass", by).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    grid = grid.withColumn("w", F.sum("w").over(before("strip", "bucket")))
    grid = grid.withColumn("w", F.coalesce(F.sum("w").over(before("bucket", "strip")), F.lit(0)))
    return dealt.filter("sign <> 0").join(grid, ["klass", "strip", "bucket"]).groupBy("key").agg(F.sum(F.col("sign") * (F.col("below") + F.col("w"))).alias("n"))
