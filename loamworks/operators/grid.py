"""Neighbourhood operators on the cell table (r, c, bands...).

Boxes are computed in tiles with a halo (``tiles``): one exchange, then two running passes
over arrays, so a wide box costs a cell no more than a narrow one. Cells that are not in the
table, and null values, count for nothing. Neighbours and weighted passes go by windows along
rows and columns; so that what lies in a row reaches the rows beside it where a column's cell
is absent, gaps within rows are first filled with helper cells, as far as the pass reaches;
they hold no values and do not come out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamworks.operators.tiles import boxes
from loamworks.session import ship


def _along(axis: str, low: int, high: int):
    return Window.partitionBy(axis).orderBy("c" if axis == "r" else "r").rangeBetween(low, high)


def padded(cells: DataFrame, left: int, right: int) -> DataFrame:
    """The cells (``_own`` true) and helper cells at the places of their rows that are absent, up to ``left`` columns before and ``right`` after a cell.

    A helper repeats its cell's other columns: whoever sums anything up asks for ``_own``.
    """
    w = Window.partitionBy("r").orderBy("c")
    spaced = cells.withColumns({"_before": F.lag("c").over(w), "_after": F.lead("c").over(w)})
    c, end = F.col("c"), F.least(F.col("c") + right, F.coalesce(F.col("_after") - 1, F.col("c") + right))
    start = F.greatest(F.col("c") - left, F.coalesce(F.col("_before") + right + 1, F.col("c") - left))
    places = lambda low, high: F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    found = F.concat(F.array(c), places(start.cast("int"), (c - 1).cast("int")), places((c + 1).cast("int"), end.cast("int")))
    kept = [x for x in cells.columns if x != "c"]
    return spaced.select(*kept, "c", F.explode(found.cast("array<int>")).alias("_place")).select(*kept, F.col("_place").alias("c"), (F.col("_place") == c).alias("_own"))


def focal_sums(cells: DataFrame, values: dict[str, Column], k: int) -> DataFrame:
    """The cells with, for each name, the sum of its expression over the (2k + 1) x (2k + 1) box."""
    return boxes(cells, {n: ("sum", v) for n, v in values.items()}, -k, k)


def focal_statistics(cells: DataFrame, band: str, k: int, prefix: str = "focal") -> DataFrame:
    """``<prefix>_mean``, ``_std`` (population) and ``_n`` of the box around each cell."""
    b = F.col(band)
    out = focal_sums(cells, {"_s": b, "_q": b * b, "_k": F.when(b.isNotNull(), 1).otherwise(0)}, k)
    mean = F.try_divide("_s", "_k")
    spread = F.greatest(F.try_divide("_q", "_k") - mean * mean, F.lit(0.0))
    return out.withColumns({f"{prefix}_mean": mean, f"{prefix}_std": F.sqrt(spread), f"{prefix}_n": F.col("_k")}).drop("_s", "_q", "_k")


def focal_extreme(cells: DataFrame, band: str, k: int, which: str, into: str) -> DataFrame:
    """Least or greatest value in the box."""
    found = boxes(cells, {"_x": (which, F.col(band))}, -k, k)
    return found.withColumn(into, F.col("_x")).drop("_x")


def _extremes(cells: DataFrame, band: str, k: int) -> DataFrame:
    return boxes(cells, {"_lo": ("min", F.col(band)), "_hi": ("max", F.col(band))}, -k, k)


def relief(cells: DataFrame, band: str, k: int, into: str = "relief") -> DataFrame:
    """Greatest minus least value in the box."""
    return _extremes(cells, band, k).withColumn(into, F.col("_hi") - F.col("_lo")).drop("_hi", "_lo")


def tpi(cells: DataFrame, band: str, k: int, ratio: bool = False, into: str = "tpi") -> DataFrame:
    """Value minus the mean of its box, or its share of the mean in percent."""
    out = focal_statistics(cells, band, k, "_f")
    v = F.col(band) - F.col("_f_mean")
    return out.withColumn(into, 100 * F.try_divide(v, F.col("_f_mean")) if ratio else v).drop("_f_mean", "_f_std", "_f_n")


def slope_position(tpi_: Column, std: Column, slope: Column, flat: float = 5.0) -> Column:
    """Valley 1 to ridge 6; a TPI of exactly half a deviation up or one down has no class."""
    return (
        F.when(tpi_ > std, 6)
        .when((tpi_ > 0.5 * std) & (tpi_ <= std), 5)
        .when((tpi_ > -0.5 * std) & (tpi_ < 0.5 * std) & (slope > flat), 4)
        .when((tpi_ > -0.5 * std) & (tpi_ < 0.5 * std) & (slope <= flat), 3)
        .when((tpi_ > -std) & (tpi_ <= -0.5 * std), 2)
        .when(tpi_ < -std, 1)
    )


def landform(small: Column, large: Column, slope: Column, factor: float = 1.0, flat: float = 5.0) -> Column:
    """Ten landforms by the band (low, middle, high) of a small-box and of a large-box TPI; the middle splits by slope; nulls are 11."""
    band = lambda v: F.when(v <= -factor, 0).when(v < factor, 1).when(v >= factor, 2)
    s, l = band(small), band(large)
    middle = F.when(slope <= flat, 5).when(slope > flat, 6)
    code = F.when(s == 0, l + 1).when((s == 1) & (l == 0), 4).when((s == 1) & (l == 1), middle).when((s == 1) & (l == 2), 7).when(s == 2, l + 8)
    return F.coalesce(code, F.lit(11))


def landform_by_aspect(t: Column, slope: Column, aspect: Column) -> Column:
    """Twelve classes of TPI, slope and aspect; classes 3, 5, 7 and 9 have conditions that cannot hold, and so does 10 with aspects from 24 to 90."""
    steep, south, even = (slope < 24) & (slope > 6), (aspect > 135) & (aspect < 315), (t > -0.5) & (t < 0.5)
    return (
        F.when(even & (slope < 6), 1).when((t > 1) & steep, 2).when((t > 1) & (slope < 6), 4).when(even & steep & south, 6).when((t < -0.5) & steep & south, 8).when((t < -0.5) & (slope < 6), 11).otherwise(12)
    )


#: The eight neighbours clockwise from the east, as (row step, column step).
AROUND = [(0, 1), (1, 1), (1, 0), (1, -1), (0, -1), (-1, -1), (-1, 0), (-1, 1)]


def neighbours(cells: DataFrame, band: str, prefix: str = "n") -> DataFrame:
    """Columns ``n0`` to ``n7``: the value of the neighbours in the order of AROUND, null where there is none.

    Values beside and above come by lag and lead along one axis each; diagonals are the column neighbours' own side values.
    """
    at = lambda axis, step, v: F.max(v).over(_along(axis, step, step))  # noqa: E731  one row at most in the frame
    out = padded(cells, 1, 1).withColumn("_v", F.when(F.col("_own"), F.col(band)))
    out = out.withColumns({"_e": at("r", 1, "_v"), "_w": at("r", -1, "_v")})
    found = {"n0": F.col("_e"), "n1": at("c", 1, "_e"), "n2": at("c", 1, "_v"), "n3": at("c", 1, "_w"), "n4": F.col("_w"), "n5": at("c", -1, "_w"), "n6": at("c", -1, "_v"), "n7": at("c", -1, "_e")}
    out = out.withColumns({k.replace("n", prefix, 1): v for k, v in found.items()}).filter("_own")
    return out.select(*cells.columns, *(f"{prefix}{i}" for i in range(8) if f"{prefix}{i}" not in cells.columns))


def slope_aspect(cells: DataFrame, band: str, size: float = 1.0) -> DataFrame:
    """``slope`` in degrees and ``aspect`` clockwise from north (-1: flat) by Horn's weights; null at edges and beside nulls."""
    n = neighbours(cells, band)
    gx = ((F.col("n7") + 2 * F.col("n0") + F.col("n1")) - (F.col("n5") + 2 * F.col("n4") + F.col("n3"))) / (8 * size)
    gy = ((F.col("n3") + 2 * F.col("n2") + F.col("n1")) - (F.col("n5") + 2 * F.col("n6") + F.col("n7"))) / (8 * size)
    out = n.withColumns({"_gx": F.when(F.col(band).isNotNull(), gx), "_gy": F.when(F.col(band).isNotNull(), gy)})
    turned = F.degrees(F.atan2(F.col("_gy"), -F.col("_gx")))
    aspect = F.when((F.col("_gx") == 0) & (F.col("_gy") == 0), -1.0).when(turned < 0, 90 - turned).when(turned > 90, 450 - turned).otherwise(90 - turned)
    return out.withColumns({"slope": F.degrees(F.atan(F.sqrt(F.col("_gx") ** 2 + F.col("_gy") ** 2))), "aspect": aspect}).drop("_gx", "_gy", *(f"n{i}" for i in range(8)))


def gradient_slope(cells: DataFrame, band: str, size: float = 1.0) -> DataFrame:
    """``slope`` in degrees from central differences; null at edges."""
    n = neighbours(cells, band)
    dx, dy = (F.col("n0") - F.col("n4")) / (2 * size), (F.col("n2") - F.col("n6")) / (2 * size)
    return n.withColumn("slope", F.when(F.col(band).isNotNull(), F.degrees(F.atan(F.sqrt(dx * dx + dy * dy))))).drop(*(f"n{i}" for i in range(8)))


def curvature(cells: DataFrame, band: str, size: float = 1.0) -> DataFrame:
    """``curvature``, ``profile`` and ``plan`` from second differences; the latter are 0 on flat ground."""
    n = neighbours(cells, band)
    e, s, w, nn = (F.col(f"n{i}") for i in (0, 2, 4, 6))
    z = F.col(band)
    d, ee = ((e + w) / 2 - z) / size**2, ((s + nn) / 2 - z) / size**2
    f = (F.col("n1") + F.col("n5") - F.col("n3") - F.col("n7")) / (4 * size**2)
    g, h = (e - w) / (2 * size), (s - nn) / (2 * size)
    q = g * g + h * h
    profile = F.when(q == 0, 0.0).otherwise(-200 * (d * g * g + ee * h * h + f * g * h) / q)
    plan = F.when(q == 0, 0.0).otherwise(200 * (d * h * h + ee * g * g - f * g * h) / q)
    return n.withColumns({"curvature": -200 * (d + ee), "profile": profile, "plan": plan}).drop(*(f"n{i}" for i in range(8)))


def ruggedness(cells: DataFrame, band: str) -> DataFrame:
    """Root of the summed squared differences to the neighbours that there are."""
    n = neighbours(cells, band)
    total = sum((F.coalesce((F.col(f"n{i}") - F.col(band)) ** 2, F.lit(0.0)) for i in range(8)), F.lit(0.0))
    return n.withColumn("ruggedness", F.when(F.col(band).isNotNull(), F.sqrt(total))).drop(*(f"n{i}" for i in range(8)))


def convergence(cells: DataFrame, aspect: str) -> DataFrame:
    """90 minus the mean angle between the neighbours' aspects and the direction to the centre; null unless all eight are there."""
    n = neighbours(cells, aspect)
    total = F.lit(0.0)
    for i in range(8):
        towards = (90 + 45 * i + 180) % 360
        turn = F.abs((F.col(f"n{i}") - towards + 540) % 360 - 180)
        total = total + turn
    return n.withColumn("convergence", 90 - total / 8).drop(*(f"n{i}" for i in range(8)))


def relative_position(cells: DataFrame, band: str, k: int) -> DataFrame:
    """Where the value stands between the least and greatest of its box, 0 to 1."""
    out = _extremes(cells, band, k)
    return out.withColumn("position", F.try_divide(F.col(band) - F.col("_lo"), F.col("_hi") - F.col("_lo"))).drop("_hi", "_lo")


#: Rows whose sources and cells meet in one task.
STRIP = 8


def _envelope(at: list[int], high: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Lower envelope of the parabolas (x - at)^2 + high, ``at`` ascending: which of them are in it, and from where each is lowest.

    Parabolas that touch it in one point stay, so that ties can be told.
    """
    kept, start = [], []
    for k, (x, h) in enumerate(zip(at, high, strict=True)):
        from_ = -math.inf
        while kept:
            y = at[kept[-1]]
            from_ = (h + x * x - high[kept[-1]] - y * y) / (2 * (x - y))
            if from_ >= start[-1]:
                break
            kept.pop()
            start.pop()
            from_ = -math.inf
        kept.append(k)
        start.append(from_)
    return np.array(kept, np.int64), np.array(start)


def _row_nearest(row: int, columns: np.ndarray, site_c: np.ndarray, site_r: np.ndarray) -> np.ndarray:
    """Position of the nearest site for each of a row's columns; sites ascend by column, one per column. Ties: smallest site row, then column."""
    kept, start = _envelope(site_c.tolist(), ((site_r - row) ** 2).tolist())
    now = np.searchsorted(start, columns, side="right") - 1
    best, tied = kept[now], np.ones(len(columns), bool)
    while True:
        tied = tied & (now > 0) & (start[now] == columns)
        if not tied.any():
            return best
        now = np.where(tied, now - 1, now)
        other = kept[now]
        better = tied & ((site_r[other] < site_r[best]) | ((site_r[other] == site_r[best]) & (site_c[other] < site_c[best])))
        best = np.where(better, other, best)


def nearest_source(cells: DataFrame, source: Column, reach: int | None = None, held: Column | None = None) -> DataFrame:
    """The cells with ``_d2``, the squared distance to the nearest source cell (ties: smallest row, then column), and ``_held``, that cell's ``held``.

    However far it is; with a ``reach``, null beyond it. Along a column each source is nearest to a stretch of rows, which ends
    half way to the next source: it is sent to those rows. There the sources of all columns are parabolas, and their lower
    envelope gives every cell its nearest one, in time linear in the row. Absent cells are no obstacle. A task holds
    ``STRIP`` rows.
    """
    ship(cells.sparkSession)
    found = cells.filter(source).select("r", "c", (F.lit(None).cast("int") if held is None else held).alias("_held"))
    first, last = cells.agg(F.min("r"), F.max("r")).first()
    w = Window.partitionBy("c").orderBy("r")
    before, after = F.lag("r").over(w), F.lead("r").over(w)
    low = F.coalesce(F.floor((before + F.col("r")) / 2) + 1, F.lit(first))
    high = F.coalesce(F.floor((F.col("r") + after) / 2), F.lit(last))
    if reach is not None:
        low, high = F.greatest(low, F.col("r") - reach), F.least(high, F.col("r") + reach)
    stretch = found.select("c", F.col("r").alias("_site"), "_held", low.cast("int").alias("_low"), high.cast("int").alias("_high")).filter("_low <= _high")
    sites = stretch.select("c", "_site", "_held", F.explode(F.sequence("_low", "_high")).alias("r"))
    schema = T.StructType([*cells.schema.fields, T.StructField("_d2", T.LongType()), T.StructField("_held", found.schema["_held"].dataType)])

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        sites, cells = left.sort_by([("r", "ascending"), ("c", "ascending")]), right.sort_by("r").drop_columns("_strip")
        rows, columns = (cells[x].to_numpy().astype(np.int64) for x in ("r", "c"))
        site_row, site_c, site_r = (sites[x].to_numpy().astype(np.int64) for x in ("r", "c", "_site"))
        best = np.full(len(rows), -1)
        for row in np.unique(rows):
            mine, those = (slice(*np.searchsorted(x, (row, row + 1))) for x in (rows, site_row))
            if those.stop > those.start:
                best[mine] = _row_nearest(int(row), columns[mine], site_c[those], site_r[those]) + those.start
        none = best < 0
        at = np.where(none, 0, best)
        d2 = (site_r[at] - rows) ** 2 + (site_c[at] - columns) ** 2 if len(site_r) else np.zeros(len(rows), np.int64)
        if reach is not None:
            none |= d2 > reach * reach
        value = sites["_held"].take(pa.array(np.where(none, None, at), pa.int64())) if len(site_r) else pa.nulls(len(rows), sites.schema.field("_held").type)
        return pa.table([*cells.columns, pa.array(d2, mask=none), value], [*cells.column_names, "_d2", "_held"])

    strip = F.floor(F.col("r") / STRIP).alias("_strip")
    return sites.select("*", strip).groupBy("_strip").cogroup(cells.select(*(F.col(x).alias(x) for x in cells.columns), strip).groupBy("_strip")).applyInArrow(work, schema)


def distance(cells: DataFrame, source: Column, reach: int | None = None, into: str = "distance") -> DataFrame:
    """Distance in cells to the nearest source cell; with a ``reach``, null beyond it."""
    found = nearest_source(cells, source, reach)
    return found.withColumn(into, F.sqrt(F.col("_d2").cast("double"))).drop("_d2", "_held")


def gaussian_density(cells: DataFrame, mask: Column, sigma: float, truncate: float = 4.0, into: str = "density") -> DataFrame:
    """Gaussian density of a mask, scaled by its greatest value; cells off the grid count as empty."""
    k = int(truncate * sigma + 0.5)
    weights = [math.exp(-0.5 * (i / sigma) ** 2) for i in range(-k, k + 1)]
    table = F.array(*(F.lit(w / sum(weights)) for w in weights))

    def smear(df: DataFrame, axis: str, column: str) -> DataFrame:
        at = "c" if axis == "r" else "r"
        seen = df.withColumn("_all", F.collect_list(F.when(F.col(column) != 0, F.struct(F.col(at).alias("at"), F.col(column).alias("m")))).over(_along(axis, -k, k)))
        return seen.withColumn(column, F.aggregate("_all", F.lit(0.0), lambda total, x: total + x["m"] * F.get(table, x["at"] - F.col(at) + k))).drop("_all")

    start = padded(cells, k, k).withColumn("_m", F.when(F.col("_own"), mask.cast("double")))
    out = smear(smear(start, "r", "_m"), "c", "_m").filter("_own").select(*cells.columns, "_m")
    most = out.agg(F.max("_m").alias("_most"))
    return out.crossJoin(F.broadcast(most)).withColumn(into, F.coalesce(F.try_divide("_m", "_most"), F.lit(0.0))).drop("_m", "_most")


def fill_gaps(cells: DataFrame, band: str, k: int = 1) -> DataFrame:
    """Null values replaced by the mean of their box, else by the band's mean."""
    out = focal_statistics(cells, band, k, "_f")
    mean = out.agg(F.avg(band).alias("_mean"))
    return out.crossJoin(F.broadcast(mean)).withColumn(band, F.coalesce(band, "_f_mean", "_mean")).drop("_f_mean", "_f_std", "_f_n", "_mean")


def repair_outliers(cells: DataFrame, band: str, low: float, high: float, k: int, method: str) -> DataFrame:
    """Values outside [low, high] replaced by their good neighbours' mean, median or inverse-distance mean; kept where there are none.

    Only bad cells look around: each goes to the cells of its box.
    """
    bad = cells.filter((F.col(band) < low) | (F.col(band) > high)).select("r", "c")
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-k, k + 1) for j in range(-k, k + 1) if i or j))
    asked = bad.withColumn("_o", F.explode(steps)).select(F.col("r").alias("_r"), F.col("c").alias("_c"), (F.col("r") + F.col("_o.i")).alias("r"), (F.col("c") + F.col("_o.j")).alias("c"), (1 / F.sqrt(F.col("_o.i") * F.col("_o.i") + F.col("_o.j") * F.col("_o.j"))).alias("_w"))
    good = cells.filter((F.col(band) >= low) & (F.col(band) <= high)).select("r", "c", F.col(band).alias("_v"))
    stat = {"mean": F.avg("_v"), "median": F.median("_v"), "idw": F.sum(F.col("_v") * F.col("_w")) / F.sum("_w")}[method]
    found = asked.join(good, ["r", "c"]).groupBy("_r", "_c").agg(stat.alias("_new")).select(F.col("_r").alias("r"), F.col("_c").alias("c"), "_new")
    return cells.join(found, ["r", "c"], "left").withColumn(band, F.coalesce("_new", band)).drop("_new")


def consistency(cells: dict[str, DataFrame], reference: str) -> DataFrame:
    """One row per grid: its extent and number of cells, and whether these agree with the reference."""
    rows = None
    for name, df in cells.items():
        one = df.agg(F.lit(name).alias("grid"), F.min("r").alias("r0"), F.max("r").alias("r1"), F.min("c").alias("c0"), F.max("c").alias("c1"), F.count("*").alias("n"))
        rows = one if rows is None else rows.unionByName(one)
    ref = rows.filter(F.col("grid") == reference).select(F.struct("r0", "r1", "c0", "c1", "n").alias("_ref"))
    return rows.crossJoin(F.broadcast(ref)).withColumn("same", (F.struct("r0", "r1", "c0", "c1", "n") == F.col("_ref")).cast("int")).drop("_ref")


def with_coordinates(cells: DataFrame, x0: float, y0: float, size: float) -> DataFrame:
    """Coordinates of the cell centres."""
    return cells.withColumns({"x": x0 + (F.col("c") + 0.5) * size, "y": y0 - (F.col("r") + 0.5) * size})


def _shape(spark: SparkSession, rows: int, columns: int) -> DataFrame:
    """All places of a grid; rows are dealt to tasks."""
    places = F.sequence(F.lit(0), F.lit(columns - 1)) if columns > 0 else F.array().cast("array<int>")
    return spark.range(rows).select(F.col("id").cast("int").alias("r"), F.explode(places).alias("c"))


def resample_nearest(cells: DataFrame, band: str, factor: float) -> DataFrame:
    """The grid at another cell size (``factor`` old cells wide), each new cell with the old cell under its centre."""
    extent = cells.agg(F.max("r").alias("_r1"), F.max("c").alias("_c1")).first()
    rows, columns = (0 if x is None else int((x + 1) // factor) for x in extent)
    new = _shape(cells.sparkSession, rows, columns)
    at = new.select("r", "c", F.floor((F.col("r") + 0.5) * factor).cast("int").alias("_r"), F.floor((F.col("c") + 0.5) * factor).cast("int").alias("_c"))
    return at.join(cells.select(F.col("r").alias("_r"), F.col("c").alias("_c"), band), ["_r", "_c"], "left").select("r", "c", band)


def resample_bilinear(cells: DataFrame, band: str, factor: float) -> DataFrame:
    """As nearest, but from the four old centres around a new centre; null where one of them is missing."""
    at = resample_nearest(cells, band, factor).select("r", "c", ((F.col("r") + 0.5) * factor - 0.5).alias("_y"), ((F.col("c") + 0.5) * factor - 0.5).alias("_x"))
    at = at.withColumns({"_r": F.floor("_y").cast("int"), "_c": F.floor("_x").cast("int")})
    corner = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1))))
    four = at.withColumn("_o", corner).select("r", "c", (F.col("_r") + F.col("_o.i")).alias("_rr"), (F.col("_c") + F.col("_o.j")).alias("_cc"), ((1 - F.abs(F.col("_y") - F.col("_r") - F.col("_o.i"))) * (1 - F.abs(F.col("_x") - F.col("_c") - F.col("_o.j")))).alias("_w"))
    old = cells.select(F.col("r").alias("_rr"), F.col("c").alias("_cc"), F.col(band).alias("_v"))
    joined = four.join(old, ["_rr", "_cc"], "left")
    whole = F.sum(F.when(F.col("_v").isNull() & (F.col("_w") > 0), 1).otherwise(0)) == 0
    return joined.groupBy("r", "c").agg(F.when(whole, F.sum(F.col("_v") * F.col("_w"))).alias(band))


def morphology(cells: DataFrame, band: str, operation: str, k: int = 1) -> DataFrame:
    """Dilate, erode, open, close, gradient, tophat, bottomhat or edge (value minus erosion) of a grey or binary band."""

    def pass_(df: DataFrame, which: str) -> DataFrame:
        return focal_extreme(df, "_v", k, which, "_v")

    start = cells.withColumn("_v", F.col(band))
    first = {"dilate": ["max"], "erode": ["min"], "open": ["min", "max"], "tophat": ["min", "max"], "close": ["max", "min"], "bottomhat": ["max", "min"], "edge": ["min"]}
    if operation == "gradient":
        return relief(cells, band, k, "_v").withColumn(band, F.col("_v")).drop("_v")
    for which in first[operation]:
        start = pass_(start, which)
    out = {"tophat": F.col(band) - F.col("_v"), "bottomhat": F.col("_v") - F.col(band), "edge": F.col(band) - F.col("_v")}.get(operation, F.col("_v"))
    return start.withColumn(band, out).drop("_v")


def majority_filter(cells: DataFrame, band: str, eight: bool = True) -> DataFrame:
    """A cell takes the value that more than half of its 8 (or 4) neighbours share, else keeps its own."""
    sides = range(8) if eight else (0, 2, 4, 6)
    n = neighbours(cells, band)
    least = 5 if eight else 3
    chosen = F.lit(None).cast(dict(cells.dtypes)[band])
    for i in sides:
        same = sum((F.coalesce(F.col(f"n{i}") == F.col(f"n{j}"), F.lit(False)).cast("int") for j in sides), F.lit(0))
        chosen = F.coalesce(chosen, F.when(same >= least, F.col(f"n{i}")))
    return n.withColumn(band, F.coalesce(chosen, F.col(band))).drop(*(f"n{i}" for i in range(8)))


def fine_into_coarse(coarse: DataFrame, fine: DataFrame, band: str, margin: int = 5) -> DataFrame:
    """The fine grid's value where its valid area, shrunk by ``margin`` cells, has one; the coarse value elsewhere."""
    valid = focal_sums(fine.select("r", "c", band), {"_valid": F.col(band).isNotNull().cast("int")}, margin)
    inner = valid.filter(F.col("_valid") == (2 * margin + 1) ** 2).select("r", "c", F.col(band).alias("_fine"))
    return coarse.join(inner, ["r", "c"], "left").withColumn(band, F.coalesce("_fine", band)).drop("_fine")


def clip(cells: DataFrame, mask: DataFrame) -> DataFrame:
    """Cells that the mask has."""
    return cells.join(mask.select("r", "c"), ["r", "c"], "left_semi")


def threshold_clean(value: Column, low: float, high: float, code: float) -> Column:
    """The code where the value is at or beyond a bound."""
    return F.when((value <= low) | (value >= high), code).otherwise(value)


def texture(cells: DataFrame, band: str, levels: int = 256) -> DataFrame:
    """Co-occurrence of diagonal neighbours in 3 x 3 windows after scaling to 0..levels-1.

    ``contrast``, ``dissimilarity`` and ``homogeneity`` are means over a window's pairs of grey levels; ``energy`` is the
    root of the summed squared shares of its different pairs, ``correlation`` that of the two levels (1 where they do not vary).
    """
    stats = cells.agg(F.min(band).alias("_lo"), F.max(band).alias("_hi"))
    g = cells.crossJoin(F.broadcast(stats)).withColumn("_g", F.floor((F.col(band) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * (levels - 1)).cast("int")).drop("_lo", "_hi")
    n = neighbours(g.select("r", "c", "_g"), "_g").withColumn("_h", F.col("n1"))
    a, b = F.when(F.col("_h").isNotNull(), F.col("_g")), F.when(F.col("_g").isNotNull(), F.col("_h"))  # a pair is counted at its upper left cell
    gap = b - a
    sums = {"contrast": gap * gap, "dissimilarity": F.abs(gap), "homogeneity": 1.0 / (1 + gap * gap), "_k": F.when(gap.isNotNull(), 1).otherwise(0), "_a": a, "_b": b, "_aa": a * a, "_bb": b * b, "_ab": a * b}
    # a window has four pairs at most: both rows' pairs are put side by side and compared with each other
    pair = F.when(gap.isNotNull(), a.cast("long") * levels + b)
    start = padded(n.select("r", "c", "_g", "_h"), 0, 1).withColumns({x: F.when(F.col("_own"), v) for x, v in (sums | {"_p": pair}).items()})
    rows = start.withColumns({x: F.sum(x).over(_along("r", -1, 0)) for x in sums} | {"_p": F.collect_list("_p").over(_along("r", -1, 0))})
    out = rows.withColumns({x: F.sum(x).over(_along("c", -1, 0)) for x in sums} | {"_p": F.flatten(F.collect_list("_p").over(_along("c", -1, 0)))}).filter("_own")
    k = F.col("_k")
    same = F.aggregate("_p", F.lit(0), lambda total, x: total + F.size(F.filter("_p", lambda y: y == x)))  # the sum of squared counts
    va, vb = k * F.col("_aa") - F.col("_a") * F.col("_a"), k * F.col("_bb") - F.col("_b") * F.col("_b")
    correlation = F.when((va == 0) | (vb == 0), 1.0).otherwise((k * F.col("_ab") - F.col("_a") * F.col("_b")) / F.sqrt(va.cast("double") * vb))
    return out.filter(k > 0).select("r", "c", *((F.col(x) / k).alias(x) for x in ("contrast", "dissimilarity", "homogeneity")), (F.sqrt(same.cast("double")) / k).alias("energy"), correlation.alias("correlation"))


def hillshade(slope: Column, aspect: Column, suns: list[tuple[float, float]]) -> Column:
    """Mean shade 0..255 over (azimuth, altitude) pairs in degrees; flat cells face nowhere."""
    s, a = F.radians(slope), F.radians(F.when(aspect < 0, 0.0).otherwise(aspect))
    total = F.lit(0.0)
    for azimuth, altitude in suns:
        z = math.radians(90 - altitude)
        total = total + F.greatest(F.lit(0.0), 255 * (math.cos(z) * F.cos(s) + math.sin(z) * F.sin(s) * F.cos(math.radians(azimuth) - a)))
    return total / len(suns)


def resize(cells: DataFrame, band: str, rows: int, columns: int, fill: float) -> DataFrame:
    """The grid cut or padded to a shape; missing cells and nulls take the fill value."""
    shape = _shape(cells.sparkSession, rows, columns)
    return shape.join(cells.select("r", "c", band), ["r", "c"], "left").withColumn(band, F.coalesce(band, F.lit(fill)))


def low_pass(cells: DataFrame, band: str, times: int) -> DataFrame:
    """The 3 x 3 mean applied again and again; null cells stay null."""
    for _ in range(times):
        cells = focal_statistics(cells, band, 1, "_f").withColumn(band, F.when(F.col(band).isNotNull(), F.col("_f_mean"))).drop("_f_mean", "_f_std", "_f_n")
    return cells


def across_bands(bands: list[str]) -> dict[str, Column]:
    """Mean and range of a cell over several bands."""
    total = sum((F.col(b) for b in bands[1:]), F.col(bands[0]))
    return {"mean": total / len(bands), "range": F.greatest(*bands) - F.least(*bands)}


def long_form(cells: DataFrame, bands: list[str]) -> DataFrame:
    """One row per cell and band."""
    return cells.unpivot(["r", "c"], bands, "band", "value")


def wide_form(long: DataFrame, bands: list[str]) -> DataFrame:
    """One row per cell, a column per band."""
    return long.groupBy("r", "c").agg(*(F.max(F.when(F.col("band") == b, F.col("value"))).alias(b) for b in bands))
