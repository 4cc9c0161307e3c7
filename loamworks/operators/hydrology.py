"""Flow over an elevation grid.

Accumulation and basins use pointer doubling: after k rounds every cell knows the cell
2**k steps downstream, and what it has gathered from upstream cells nearer than that.
Rounds grow with the logarithm of the longest flow path. Sinks are filled from tiles flooded on
their own and a graph of the passes between them; flats drain by the steps to their outlets.
"""

from __future__ import annotations

import functools
import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamworks.operators.graph import ROW, components
from loamworks.operators.grid import AROUND, neighbours
from loamworks.operators.tiles import SIDE, Tile, dealt, per_tile
from loamworks.session import discard, staged

# The codes of the eight flow directions, clockwise from the east.
CODES = [1, 2, 4, 8, 16, 32, 64, 128]


def flow_code(z: Column, around: list[Column]) -> Column:
    """Code of the steepest of eight neighbours (ties: the first clockwise from the east), 0 if none is lower, null without value."""
    drops = [(z - n) / (math.sqrt(2) if i % 2 else 1.0) for i, n in enumerate(around)]
    best, pick = F.greatest(*drops), F.lit(None).cast("int")
    for d, c in zip(drops, CODES, strict=True):
        pick = F.coalesce(pick, F.when((d == best) & (d > 0), c))
    return F.coalesce(pick, F.when(z.isNotNull(), 0))


def flow_direction(cells: DataFrame, band: str) -> DataFrame:
    """``direction``: code of the neighbour with the steepest drop; 0 for a pit or a flat (``flow_over_flats`` drains these), null without value."""
    n = neighbours(cells, band)
    return n.withColumn("direction", flow_code(F.col(band), [F.col(f"n{i}") for i in range(8)])).drop(*(f"n{i}" for i in range(8)))


def downstream(cells: DataFrame, direction: str = "direction") -> DataFrame:
    """(node, down): each cell's number and that of the cell it flows into, null for pits."""
    step = F.lit(None).cast("long")
    for (dr, dc), code in zip(AROUND, CODES, strict=True):
        step = F.when(F.col(direction) == code, F.lit(dr * ROW + dc)).otherwise(step)
    node = F.col("r").cast("long") * ROW + F.col("c")
    return cells.filter(F.col(direction).isNotNull()).select(node.alias("node"), (node + step).alias("down"))


def _doubled(state: DataFrame) -> DataFrame:
    """One round: jumps are joined with themselves; what a jump's source holds is added to its goal; a flow that ends there ends where the goal's does."""
    sent = state.filter("down is not null").groupBy("down").agg(F.sum("acc").alias("more")).withColumnRenamed("down", "node")
    ahead = state.select(F.col("node").alias("down"), F.col("down").alias("next"), F.col("root").alias("end"))
    return (
        state.join(sent, "node", "left")
        .join(ahead, "down", "left")
        .select("node", F.col("next").alias("down"), (F.col("acc") + F.coalesce("more", F.lit(0))).alias("acc"), F.coalesce("root", F.when(F.col("next").isNull(), F.col("end"))).alias("root"))
    )


def accumulate(links: DataFrame) -> DataFrame:
    """(node, acc, basin): cells upstream, itself included, and the pit that the flow ends in."""
    state = staged(links.select("node", "down", F.lit(1).cast("long").alias("acc"), F.when(F.col("down").isNull(), F.col("node")).alias("root")), "flow")
    while not state.filter("down is not null").isEmpty():
        old, state = state, staged(_doubled(state), "flow")
        discard(old)
    return state.select("node", "acc", F.coalesce("root", "node").alias("basin"))


def flow_accumulation(cells: DataFrame, band: str) -> DataFrame:
    """(r, c, acc, basin) of every cell with a value."""
    found = accumulate(downstream(flow_direction(cells, band)))
    return found.select((F.col("node") / ROW).cast("int").alias("r"), (F.col("node") % ROW).cast("int").alias("c"), "acc", "basin")


def channels(flow: DataFrame, least: int) -> DataFrame:
    """Cells with at least ``least`` cells upstream."""
    return flow.filter(F.col("acc") >= least)


def channel_relief(cells: DataFrame, band: str, least: int) -> DataFrame:
    """(r, c, base_level, above, valley_depth) of every cell with a value.

    ``base_level`` is the elevation of the first channel cell (with at least ``least`` cells upstream) on the cell's flow,
    or of the pit it ends in; ``above`` is the height over it; ``valley_depth`` is how far the cell lies below the highest
    cell of its basin.
    """
    node = F.col("r").cast("long") * ROW + F.col("c")
    z = staged(cells.filter(F.col(band).isNotNull()).select("r", "c", node.alias("node"), F.col(band).alias("z")), "levels")
    links = staged(downstream(flow_direction(cells, band)), "links")
    flow = staged(accumulate(links), "flow")
    channel = flow.filter(F.col("acc") >= least).select("node", F.lit(True).alias("_channel"))
    first = accumulate(links.join(channel, "node", "left").select("node", F.when(F.col("_channel").isNull(), F.col("down")).alias("down"))).select("node", F.col("basin").alias("_base"))
    tops = flow.select("node", "basin").join(z.select("node", "z"), "node").groupBy("basin").agg(F.max("z").alias("_top"))
    found = z.join(first, "node").join(z.select(F.col("node").alias("_base"), F.col("z").alias("base_level")), "_base").join(flow.select("node", "basin"), "node").join(tops, "basin")
    return found.select("r", "c", "base_level", (F.col("z") - F.col("base_level")).alias("above"), (F.col("_top") - F.col("z")).alias("valley_depth"))


#: Stands for the outside in the graph of spill levels; every other label is a cell number.
OUTSIDE = -1
HALF = [(0, 1), (1, -1), (1, 0), (1, 1)]


def _flooded(z: np.ndarray, seeds: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Level and label of each cell of a tile: the lowest way to a seed, and the seed it leads to. ``z`` has an empty (NaN) border."""
    width = z.shape[1]
    steps = [dr * width + dc for dr, dc in AROUND]
    height = z.ravel().tolist()
    level, label = [math.inf] * len(height), labels.ravel().tolist()
    heap = []
    for at in np.flatnonzero(seeds).tolist():
        level[at] = height[at]
        heap.append((height[at], at))
    heapq.heapify(heap)
    while heap:
        here, at = heapq.heappop(heap)
        if here > level[at]:
            continue
        for step in steps:
            to = at + step
            up = height[to]
            if up == up:  # not a gap
                up = max(up, here)
                if up < level[to]:
                    level[to], label[to] = up, label[at]
                    heapq.heappush(heap, (up, to))
    return np.array(level).reshape(z.shape), np.array(label, np.int64).reshape(z.shape)


def _tile_floods(cells: DataFrame, band: str, side: int) -> DataFrame:
    """Rows of two kinds: cells (r, c, z, w: level to the tile's edge or the outside, a: label) and passes (a, b: labels, w: lowest level between them).

    A cell on the tile's edge is a label of its own, one beside a gap or the grid's end is the outside. A rim of two
    cells tells which of the next tile's cells are outside.
    """

    def work(table: pa.Table) -> pa.Table:
        tile = Tile(table, rim=1)
        held, there = tile.column("z")
        z = np.where(there, held, np.nan)
        own = tile.array(tile.own, False)
        gap = ~there
        around = np.zeros(z.shape, bool)  # a neighbour that is a gap; cells of the rim's outer row do not count
        other = np.zeros(z.shape, bool)
        for dr, dc in AROUND:
            around[1:-1, 1:-1] |= gap[1 + dr : z.shape[0] - 1 + dr, 1 + dc : z.shape[1] - 1 + dc]
            other[1:-1, 1:-1] |= (there & ~own)[1 + dr : z.shape[0] - 1 + dr, 1 + dc : z.shape[1] - 1 + dc]
        number = (np.arange(z.shape[0])[:, None] + tile.r0) * np.int64(ROW) + np.arange(z.shape[1])[None, :] + tile.c0
        names = np.where(around, OUTSIDE, number)
        inside = np.where(own, z, np.nan)
        w, label = _flooded(inside, own & there & (around | other), names)
        # the next tile's cells stand at their own level under their own label
        w, label = np.where(own, w, np.where(there, z, np.inf)), np.where(own, label, names)
        parts = []
        for dr, dc in HALF:
            rows, columns = slice(0, z.shape[0] - dr), slice(max(-dc, 0), z.shape[1] - max(dc, 0))
            rows2, columns2 = slice(dr, z.shape[0]), slice(max(dc, 0), z.shape[1] + min(dc, 0))
            meet = there[rows, columns] & there[rows2, columns2] & (own[rows, columns] | own[rows2, columns2]) & (label[rows, columns] != label[rows2, columns2])
            a, b = label[rows, columns][meet], label[rows2, columns2][meet]
            parts.append((np.minimum(a, b), np.maximum(a, b), np.maximum(w[rows, columns][meet], w[rows2, columns2][meet])))
        a, b, level = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((level, b, a))
        a, b, level = a[order], b[order], level[order]
        first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))) if len(a) else np.zeros(0, np.int64)
        i, j = np.nonzero(own & there)
        n, m = len(i), len(first)
        none = pa.nulls
        both = lambda x, y, kind: pa.concat_arrays([x if isinstance(x, pa.Array) else pa.array(x, kind), y if isinstance(y, pa.Array) else pa.array(y, kind)])
        return pa.table(
            [
                pa.array([True] * n + [False] * m, pa.bool_()),
                both((i + tile.r0).astype(np.int32), none(m, pa.int32()), pa.int32()),
                both((j + tile.c0).astype(np.int32), none(m, pa.int32()), pa.int32()),
                both(z[i, j], none(m, pa.float64()), pa.float64()),
                both(w[i, j], level[first], pa.float64()),
                both(label[i, j], a[first], pa.int64()),
                both(none(n, pa.int64()), b[first], pa.int64()),
            ],
            ["is_cell", "r", "c", "z", "w", "a", "b"],
        )

    deal = dealt(cells.select("r", "c", F.col(band).cast("double").alias("z")), side, -2, 2)
    return per_tile(deal, work, "is_cell boolean, r int, c int, z double, w double, a long, b long")


def _settled(passes: pa.Table) -> pa.Table:
    """(grp, w): the level at which each group joins the outside, passes taken from the lowest up."""
    order = np.argsort(passes["w"].to_numpy(), kind="stable")
    a, b, w = (passes[c].to_numpy()[order].tolist() for c in ("a", "b", "w"))
    root, held, found = {}, {}, {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for x, y, level in zip(a, b, w, strict=True):
        x, y = top(x), top(y)
        if x == y:
            continue
        x, y = (x, y) if x == top(OUTSIDE) or (y != top(OUTSIDE) and len(held.get(x, (x,))) >= len(held.get(y, (y,)))) else (y, x)
        root[y] = x
        mine = held.pop(y, [y])
        if x == top(OUTSIDE):
            found.update(dict.fromkeys(mine, level))
        else:
            held.setdefault(x, [x]).extend(mine)
    return pa.table([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.float64())], ["grp", "w"])


def spill_levels(passes: DataFrame, small: int = 1 << 18) -> DataFrame:
    """(label, level): how high water of each label must stand to run to the outside, over the passes (a, b, w).

    Boruvka rounds: each group of labels takes its lowest pass, rises to it and joins the group behind it; groups that
    have joined the outside are done. The groups at least halve in a round, so rounds grow with their logarithm. What is
    left of at most ``small`` passes is settled in one task.
    """
    passes = staged(passes.select("a", "b", "w"), "passes")
    ends = passes.select(F.col("a").alias("label")).unionAll(passes.select(F.col("b").alias("label"))).distinct().filter(F.col("label") != OUTSIDE)
    open_, done = staged(ends.select("label", F.col("label").alias("grp"), F.lit(-math.inf).alias("level")), "levels"), []
    while passes.count() > small:
        both = passes.unionAll(passes.select(F.col("b").alias("a"), F.col("a").alias("b"), "w")).filter(F.col("a") != OUTSIDE)
        lowest = staged(both.groupBy("a").agg(F.min(F.struct("w", "b")).alias("m")).select("a", "m.w", "m.b"), "lowest")
        joined = staged(components(lowest.select("a", "b")).filter(F.col("node") != OUTSIDE), "joined")
        risen = open_.join(lowest.select(F.col("a").alias("grp"), "w"), "grp", "left").join(joined.select(F.col("node").alias("grp"), F.col("label").alias("_root")), "grp", "left")
        risen = staged(risen.select("label", F.coalesce("_root", "grp").alias("grp"), F.greatest("level", "w").alias("level")), "levels")
        to = lambda end: joined.select(F.col("node").alias(end), F.col("label").alias(f"_{end}"))  # noqa: B023, E731
        moved = passes.join(to("a"), "a", "left").join(to("b"), "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"), "w").filter("a != b")
        merged = staged(moved.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.min("w").alias("w")), "passes")
        done.append(staged(risen.filter(F.col("grp") == OUTSIDE).select("label", "level"), "settled"))
        left = staged(risen.filter(F.col("grp") != OUTSIDE), "levels")
        for old in (open_, passes, lowest, joined, risen):
            discard(old)
        passes, open_ = merged, left
    last = passes.withColumn("_all", F.lit(True)).groupBy("_all").applyInArrow(_settled, "grp long, w double")
    out = open_.join(last, "grp").select("label", F.greatest("level", "w").alias("level"))
    for part in done:
        out = out.unionByName(part)
    return out


def fill_sinks(cells: DataFrame, band: str, tile: int = SIDE) -> DataFrame:
    """``filled``: the least level at which water from a cell reaches the grid's edge (or a cell beside nulls).

    Each tile is flooded once from its edge: a cell gets its level there and the label of the edge cell it runs to. The
    lowest passes between labels make a graph far smaller than the grid; ``spill_levels`` finds how high each label stands.
    A cell is filled to the higher of the two. No round goes over the cells.
    """
    found = staged(_tile_floods(cells, band, tile), "floods", partition="is_cell")
    inside = found.filter("is_cell").select("r", "c", "z", "w", "a")
    levels = spill_levels(found.filter("not is_cell").groupBy("a", "b").agg(F.min("w").alias("w")))
    # what runs to the outside within its tile is done; the other labels hold a tile's cells at most
    behind = inside.filter(F.col("a") != OUTSIDE).join(levels.withColumnRenamed("label", "a"), "a", "left").select("r", "c", "z", F.greatest("w", "level").alias("filled"))
    whole = inside.filter(F.col("a") == OUTSIDE).select("r", "c", "z", F.col("w").alias("filled")).unionByName(behind)
    gaps = cells.filter(F.col(band).isNull()).select("r", "c", F.lit(None).cast("double").alias("z"), F.lit(None).cast("double").alias("filled"))
    return whole.unionByName(gaps).withColumnRenamed("z", band)


#: Stands for no way to an outlet or to higher ground.
FAR = 1 << 30


def _waves(start: np.ndarray, z: np.ndarray, may: np.ndarray) -> np.ndarray:
    """Steps over equal heights: each cell that ``may`` change gets the least of its start and its neighbours' steps plus one. The arrays' border is empty."""
    steps = [dr * z.shape[1] + dc for dr, dc in AROUND]
    d, level, open_ = start.ravel().copy(), z.ravel(), may.ravel()
    waiting = {int(v): np.flatnonzero(d == v) for v in np.unique(d[d < FAR])}
    front, now = np.zeros(0, np.int64), -1
    while waiting or len(front):
        now = now if len(front) else min(waiting)
        front = np.concatenate((front, waiting.pop(now, front[:0])))
        front = front[d[front] == now]
        reached = [front[:0]]
        for step in steps:
            to = front + step
            to = to[open_[to] & (level[to] == level[front]) & (d[to] > now + 1)]
            d[to] = now + 1
            reached.append(to)
        front, now = np.unique(np.concatenate(reached)), now + 1
    return d.reshape(z.shape)


def flow_over_flats(cells: DataFrame, band: str, side: int = SIDE) -> DataFrame:
    """``direction`` as ``flow_direction``, but cells of a flat go on towards its outlets, and away from higher ground where both agree.

    A flat cell has neighbours on all sides, none of them lower. Its steps over equal heights to the nearest cell that flows on
    or lies on the edge (``low``), and those from the nearest cell beside higher ground (``high``), make a slope of 2 low - high;
    it flows where that falls most steeply. Two steps of ``low`` outweigh one of ``high``, so every flat that has an outlet drains.
    Codes of 0 are left to cells on the edge and to pits without outlet. Tiles search on their own, with a rim of one cell,
    until no steps change: rounds grow with the tiles that a flat crosses, and only flats take part.
    """
    n = neighbours(cells, band)
    z, around = F.col(band), [F.col(f"n{i}") for i in range(8)]
    any_ = lambda test: functools.reduce(Column.__or__, [F.coalesce(test(x), F.lit(False)) for x in around])
    code = flow_code(z, around)
    n = n.withColumns({"direction": code, "_edge": functools.reduce(Column.__or__, [x.isNull() for x in around]), "_level": any_(lambda x: x == z), "_higher": any_(lambda x: x > z)})
    n = staged(n.select(*cells.columns, "direction", "_level", "_higher", ((F.col("direction") == 0) & ~F.col("_edge")).alias("_flat")), "directions")
    state = n.filter("_level").select(
        "r", "c", F.col(band).cast("double").alias("z"), F.col("_flat").alias("flat"),
        F.when(F.col("_flat"), FAR).otherwise(0).alias("low"), F.when(F.col("_flat") & F.col("_higher"), 1).otherwise(FAR).alias("high"),
    )
    state = staged(state, "steps")
    columns = ["r", "c", "z", "flat", "low", "high"]

    def arrays(table: pa.Table) -> tuple[Tile, dict[str, np.ndarray]]:
        tile = Tile(table, rim=1)
        held = {x: tile.column(x)[0] for x in columns[2:]}
        there = tile.array(np.ones(table.num_rows, bool), False)
        held["z"] = np.where(there, held["z"], np.nan)
        for x in ("low", "high"):
            held[x] = np.where(there, held[x], FAR)
        return tile, held

    def search(table: pa.Table) -> pa.Table:
        tile, held = arrays(table)
        own = table.filter(table["_own"])
        may = held["flat"] & tile.array(tile.own, False)
        at = tuple(x[tile.own] for x in tile.at)
        low, high = _waves(held["low"], held["z"], may)[at], _waves(np.where(held["flat"], held["high"], FAR), held["z"], may)[at]
        changed = (low != held["low"][at]) | (high != held["high"][at])
        return pa.table([*(own[x] for x in columns[:4]), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)), pa.array(changed)], [*columns, "changed"])

    def point(table: pa.Table) -> pa.Table:
        tile, held = arrays(table)
        high = np.where(held["high"] == FAR, 0, held["high"])
        # an outlet lies below all of its flat; a way straight on is shorter than one across
        slope = np.where(held["flat"], 2 * held["low"] - high, -(1 << 20)).astype(np.float64)
        slope[np.isnan(held["z"]) | (held["flat"] & (held["low"] == FAR))] = np.inf
        mine = held["flat"] & tile.array(tile.own, False) & (held["low"] < FAR)
        i, j = np.nonzero(mine)
        best, to = np.zeros(len(i)), np.zeros(len(i), np.int32)
        for (dr, dc), code_ in zip(AROUND, CODES, strict=True):
            drop = (slope[i, j] - slope[i + dr, j + dc]) / (math.sqrt(2) if dr and dc else 1.0)
            drop[held["z"][i + dr, j + dc] != held["z"][i, j]] = 0
            to[drop > best] = code_
            best = np.maximum(best, drop)
        return pa.table([pa.array((i + tile.r0).astype(np.int32)), pa.array((j + tile.c0).astype(np.int32)), pa.array(to)], ["r", "c", "_to"])

    while True:
        found = staged(per_tile(dealt(state.select(*columns), side, -1, 1), search, "r int, c int, z double, flat boolean, low int, high int, changed boolean"), "steps")
        discard(state)
        state = found
        if state.filter("changed").isEmpty():
            break
    to = per_tile(dealt(state.select(*columns), side, -1, 1), point, "r int, c int, _to int")
    turned = n.filter("_flat").join(to, ["r", "c"], "left").withColumn("direction", F.coalesce("_to", "direction"))
    return n.filter("_flat is null or not _flat").select(*cells.columns, "direction").unionByName(turned.select(*cells.columns, "direction"))


def drained(cells: DataFrame, band: str) -> DataFrame:
    """(r, c, band, filled, direction): sinks filled, then directions over the filled surface: every cell's flow reaches the edge."""
    filled = staged(fill_sinks(cells, band), "filled")
    return flow_over_flats(filled, "filled")


def ridge_valley(cells: DataFrame, band: str, k: int) -> DataFrame:
    """``line``: 1 where the cell stands above its box and nothing flows through it, -1 for the same on the inverted surface, else 0."""
    from loamworks.operators.grid import tpi

    up = flow_accumulation(cells, band).select("r", "c", F.col("acc").alias("_up"))
    down = flow_accumulation(cells.withColumn(band, -F.col(band)), band).select("r", "c", F.col("acc").alias("_down"))
    t = tpi(cells.select("r", "c", band), band, k)
    line = F.when((F.col("tpi") > 0) & (F.col("_up") == 1), 1).when((F.col("tpi") < 0) & (F.col("_down") == 1), -1).otherwise(0)
    return t.join(up, ["r", "c"], "left").join(down, ["r", "c"], "left").select("r", "c", line.alias("line"))

