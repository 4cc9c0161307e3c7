"""Square tiles of the cell table with a halo, worked on as arrays.

A cell goes to its own tile and to those whose halo holds it: one exchange, whatever is then
computed in both directions. A tile holds at most (tile + halo) squared cells, so neither long
rows nor long columns meet in one task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamworks.session import ship

#: Cells along a tile's side at least; a wide halo asks for twice its span, so that a cell has few copies.
SIDE = 256


def side_for(span: int) -> int:
    return max(SIDE, 2 * span)


def dealt(cells: DataFrame, side: int, low: int, high: int) -> DataFrame:
    """The cells with ``_tr``, ``_tc`` (a tile whose boxes from ``low`` to ``high`` around a cell hold this one) and ``_own``."""
    low, high = min(low, 0), max(high, 0)
    tiles = lambda x: F.sequence(F.floor((F.col(x) - high) / side), F.floor((F.col(x) - low) / side))
    out = cells.withColumn("_tr", F.explode(tiles("r"))).withColumn("_tc", F.explode(tiles("c")))
    return out.withColumn("_own", (F.floor(F.col("r") / side) == F.col("_tr")) & (F.floor(F.col("c") / side) == F.col("_tc")))


def per_tile(deal: DataFrame, work: Callable[[pa.Table], pa.Table], schema) -> DataFrame:
    ship(deal.sparkSession)
    return deal.groupBy("_tr", "_tc").applyInArrow(work, schema)


class Tile:
    """The cells of one tile as arrays over their extent; a border of ``rim`` empty cells around them."""

    def __init__(self, table: pa.Table, rim: int = 0):
        r, c = table["r"].to_numpy(), table["c"].to_numpy()
        self.r0, self.c0 = int(r.min()) - rim, int(c.min()) - rim
        self.shape = int(r.max()) - self.r0 + rim + 1, int(c.max()) - self.c0 + rim + 1
        self.at = (r - self.r0, c - self.c0)
        self.own = table["_own"].to_numpy(zero_copy_only=False)
        self.table = table

    def array(self, values: np.ndarray, empty) -> np.ndarray:
        out = np.full(self.shape, empty, np.asarray(values).dtype)
        out[self.at] = values
        return out

    def column(self, name: str) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 where null or absent) and which there are."""
        held = self.table[name].combine_chunks()
        there = held.is_valid().to_numpy(zero_copy_only=False)
        values = held.fill_null(False if pa.types.is_boolean(held.type) else 0).to_numpy(zero_copy_only=False)
        return self.array(values, 0), self.array(there, False)


def sliding(a: np.ndarray, width: int, op: np.ufunc, empty) -> np.ndarray:
    """``op`` over each window of ``width`` rows, from the window's first row on: two running passes whatever the width.

    Rows are cut into blocks of the width; a window is the end of one block and the start of the next. Nothing is
    subtracted, so sums lose no digits to what lies outside the window.
    """
    n = len(a)
    blocks = -(-n // width) + 1
    full = np.full((blocks * width, *a.shape[1:]), empty, a.dtype)
    full[:n] = a
    full = full.reshape(blocks, width, *a.shape[1:])
    ahead = op.accumulate(full, axis=1).reshape(-1, *a.shape[1:])
    behind = op.accumulate(full[:, ::-1], axis=1)[:, ::-1].reshape(-1, *a.shape[1:])
    out = ahead[width - 1 : width - 1 + n].copy()
    cut = np.flatnonzero(np.arange(n) % width)
    out[cut] = op(behind[cut], out[cut])
    return out


def over_boxes(a: np.ndarray, low: int, high: int, op: np.ufunc, empty) -> np.ndarray:
    """``op`` over the box from ``low`` to ``high`` rows and columns around each place."""
    for _ in range(2):
        n, beside = len(a), lambda k: np.full((max(k, 0), a.shape[1]), empty, a.dtype)  # noqa: B023
        start = max(low, 0)
        a = sliding(np.concatenate((beside(-low), a, beside(high))), high - low + 1, op, empty)[start : start + n]
        a = a.T
    return np.ascontiguousarray(a)


KINDS = {"sum": np.add, "min": np.minimum, "max": np.maximum}


def boxes(cells: DataFrame, values: dict[str, tuple[str, Column]], low: int, high: int, side: int | None = None) -> DataFrame:
    """The cells with, for each name, the sum, min or max of an expression over the box from ``low`` to ``high`` in both directions.

    Null values and absent cells count for nothing; a box without values gives null. A column that a name repeats is replaced.
    """
    kept = [x for x in cells.columns if x not in values]
    asked = cells.withColumns({n: v for n, (_, v) in values.items()})
    for name, (kind, _) in values.items():
        if kind == "sum":
            whole = isinstance(asked.schema[name].dataType, T.IntegralType)
            asked = asked.withColumn(name, F.col(name).cast("long" if whole else "double"))
    schema = T.StructType([cells.schema[x] for x in kept] + [asked.schema[n] for n in values])
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    deal = dealt(asked, side or side_for(high - low), low, high)
    # a copy in a halo carries its values only
    deal = deal.select("_tr", "_tc", "_own", *values, *(x if x in ("r", "c") else F.when(F.col("_own"), F.col(x)).alias(x) for x in kept))
    kinds = {n: kind for n, (kind, _) in values.items()}

    def work(table: pa.Table) -> pa.Table:
        tile = Tile(table)
        own = table.filter(table["_own"])
        if not own.num_rows:
            return own.select([*kept, *kinds])
        places = tuple(x[tile.own] for x in tile.at)
        out = [own[x] for x in kept]
        for name, kind in kinds.items():
            held, there = tile.column(name)
            if kind == "sum":
                empty = held.dtype.type(0)
            else:
                edge = np.inf if held.dtype.kind == "f" else (np.iinfo(held.dtype).max if kind == "min" else np.iinfo(held.dtype).min)
                empty = held.dtype.type(-edge if held.dtype.kind == "f" and kind == "max" else edge)
            found = over_boxes(np.where(there, held, empty), low, high, KINDS[kind], empty)[places]
            any_ = over_boxes(there.astype(np.int8), low, high, np.maximum, np.int8(0))[places]
            out.append(pa.array(found, mask=any_ == 0, type=table.schema.field(name).type))
        return pa.table(out, [*kept, *kinds])

    return per_tile(deal, work, schema)
