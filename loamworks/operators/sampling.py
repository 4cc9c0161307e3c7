"""Outliers, thinning, balancing and synthetic samples."""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamworks.operators.graph import components
from loamworks.operators.joins import near_pairs, nearest, points_in_polygons
from loamworks.operators.quantiles import quantiles
from loamworks.session import ship, staged

# The five labels of the outlier status.
LABELS = ("Normal", "GlobalHighOutlier", "GlobalLowOutlier", "LocalHighOutlier", "LocalLowOutlier")


def outlier_status(points: DataFrame, key: str, value: str, radius: float | None = None, global_k: float = 5.0, local_k: float = 3.0, k: int = 8) -> DataFrame:
    """``status``: beyond mean +- global_k deviations of all, else beyond mean +- local_k deviations of the k nearest.

    With fewer than k + 1 values all are normal; null values have no status. Neighbours are sought however far they are; ``radius`` is where the search begins.
    """
    has = points.filter(F.col(value).isNotNull())
    stats = has.agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"), F.count("*").alias("_n"))
    near = nearest(has, has, key, radius, key, k=k, other=True)
    local = near.groupBy(key).agg(F.avg(f"n_{value}").alias("_lm"), F.stddev_pop(f"n_{value}").alias("_ls"))
    v = F.col(value)
    status = (
        F.when(v.isNull(), None)
        .when(F.col("_n") < k + 1, LABELS[0])
        .when(v > F.col("_m") + global_k * F.col("_s"), LABELS[1])
        .when(v < F.col("_m") - global_k * F.col("_s"), LABELS[2])
        .when(v > F.col("_lm") + local_k * F.col("_ls"), LABELS[3])
        .when(v < F.col("_lm") - local_k * F.col("_ls"), LABELS[4])
        .otherwise(LABELS[0])
    )
    return points.join(local, key, "left").crossJoin(F.broadcast(stats)).withColumn("status", status).drop("_m", "_s", "_n", "_lm", "_ls")


def radius_outliers(points: DataFrame, key: str, value: str, radius: float, k: float = 2.0) -> DataFrame:
    """Points further than k deviations from the mean of the points within ``radius``, themselves included, where there are others."""
    stats = near_pairs(points, points, radius).groupBy(key).agg(F.avg(f"n_{value}").alias("_m"), F.stddev_pop(f"n_{value}").alias("_s"), F.count("*").alias("_n"))
    return points.join(stats, key).withColumn("outlier", ((F.col("_n") > 1) & (F.abs(F.col(value) - F.col("_m")) > k * F.col("_s"))).cast("int")).drop("_m", "_s", "_n")


def point_net(size: float, polygons: DataFrame, bucket: float, extent: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Regular points inside polygons, with their attributes; x0, y0, x1, y1 is the extent, by default that of all polygons."""
    x0, y0, x1, y1 = extent or polygons.agg(F.min("x0"), F.min("y0"), F.max("x1"), F.max("y1")).first()
    if x0 is None:
        x0 = y0 = x1 = y1 = 0.0
    nx, ny = int((x1 - x0) / size), int((y1 - y0) / size)
    net = polygons.sparkSession.range(nx * ny).select((x0 + (F.col("id") % nx + 0.5) * size).alias("x"), (y0 + (F.floor(F.col("id") / nx) + 0.5) * size).alias("y"))
    return points_in_polygons(net, polygons, bucket)


def standardised(df: DataFrame, vector: str, size: int, by: str, into: str = "z") -> DataFrame:
    """Vectors with every component standardised within its group (population deviation; constant components give 0)."""
    stats = df.groupBy(by).agg(*(f(F.get(vector, F.lit(i))).alias(f"_{n}{i}") for i in range(size) for n, f in (("m", F.avg), ("s", F.stddev_pop))))
    z = F.array(*(F.coalesce(F.try_divide(F.get(vector, F.lit(i)) - F.col(f"_m{i}"), F.col(f"_s{i}")), F.lit(0.0)) for i in range(size)))
    return df.join(stats, by).withColumn(into, z).drop(*(f"_{n}{i}" for i in range(size) for n in "ms"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


#: Parts into which a class's rows are dealt before they are ranked.
PARTS = 64
#: Rows of a stripe where there is one stripe; the number of stripes grows with the square root of the rows.
STRIPE = 4096


def similar_members(df: DataFrame, key: str, vector: str, by: str, least: float = 0.8) -> DataFrame:
    """Rows that are in a pair of cosine similarity above ``least`` within their group; of groups without such pairs, the three quarters of greatest summed similarity.

    Rows are dealt into stripes; a task multiplies two stripes of a group and names the rows that have a partner, never
    the pairs. The sum of a row's similarities is its dot product with the sum of the group's unit vectors.
    """
    ship(df.sparkSession)
    unit = staged(df.withColumn("_u", F.transform(vector, lambda x: x / F.sqrt(dot(F.col(vector), F.col(vector))))).select(key, by, "_u"), "unit")
    stripes = max(1, round((unit.count() / STRIPE) ** 0.5))
    s = F.pmod(F.xxhash64(key), F.lit(stripes))
    sent = unit.withColumn("_s", s).withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    sent = sent.select(key, by, "_u", "_s", F.least("_s", "_t").alias("_i"), F.greatest("_s", "_t").alias("_j"))

    def partnered(pdf: pd.DataFrame) -> pd.DataFrame:
        u, side = np.stack(pdf["_u"].to_numpy()), pdf["_s"].to_numpy()
        i, j = pdf["_i"].iloc[0], pdf["_j"].iloc[0]
        a, b = np.flatnonzero(side == i), np.flatnonzero(side == j)
        has = np.zeros(len(u), bool)
        for at in range(0, len(a), 512):
            rows = a[at : at + 512]
            hit = u[rows] @ u[b].T > least
            hit[rows[:, None] == b[None, :]] = False  # not with itself
            has[rows] |= hit.any(axis=1)
            has[b] |= hit.any(axis=0)
        return pdf.loc[has, [key, by]]

    found = sent.groupBy(by, "_i", "_j").applyInPandas(partnered, unit.select(key, by).schema).distinct()
    found = staged(found, "partnered")
    rest = unit.join(found.select(by).distinct(), by, "left_anti")
    size = unit.select(F.size("_u")).first()
    n = size[0] if size else 0
    sums = rest.groupBy(by).agg(F.array(*(F.sum(F.get("_u", F.lit(i))) for i in range(n))).alias("_sum"))
    scored = rest.join(sums, by).withColumn("_p", dot(F.col("_u"), F.col("_sum")))
    w = Window.partitionBy(by)
    kept = scored.withColumn("_n", F.row_number().over(w.orderBy(F.col("_p").desc(), key))).withColumn("_c", F.count("*").over(w)).filter(F.col("_n") <= 0.75 * F.col("_c"))
    return found.unionByName(kept.select(key, by))


def modal_bin_rows(df: DataFrame, key: str, by: str, features: list[str], bins: int, hits: int) -> DataFrame:
    """Rows that lie in the modal bin of their class for at least ``hits`` features (ties: the lowest bin)."""
    long = df.unpivot([key, by], features, "feature", "v")
    span = long.groupBy(by, "feature").agg(F.min("v").alias("_lo"), F.max("v").alias("_hi"))
    share = F.coalesce(F.try_divide(F.col("v") - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(0.0))
    binned = long.join(span, [by, "feature"]).withColumn("bin", F.least(F.floor(share * bins).cast("int"), F.lit(bins - 1)))
    counts = binned.groupBy(by, "feature", "bin").agg(F.count("*").alias("n"))
    modal = counts.withColumn("_r", F.row_number().over(Window.partitionBy(by, "feature").orderBy(F.col("n").desc(), "bin"))).filter("_r = 1").select(by, "feature", "bin")
    return binned.join(modal, [by, "feature", "bin"]).groupBy(key, by).agg(F.count("*").alias("hits")).filter(F.col("hits") >= hits)


def nearest_to_centre(df: DataFrame, key: str, by: str, features: list[str], share: float = 0.2) -> DataFrame:
    """Rows within the exact ``share`` percentile of distances to their class mean."""
    means = df.groupBy(by).agg(*(F.avg(f).alias(f"_{f}") for f in features))
    d = df.join(means, by).select(key, by, F.sqrt(sum(((F.col(f) - F.col(f"_{f}")) ** 2 for f in features), F.lit(0.0))).alias("distance"))
    cut = quantiles(d, {"_cut": ("distance", share)}, [by])
    return d.join(cut, by).filter(F.col("distance") <= F.col("_cut")).drop("_cut")


def weighted_sample(df: DataFrame, weight: str, by: str, n: int, seed: int) -> DataFrame:
    """n rows per group without replacement, chance by weight: the smallest of -ln(u) / w; u comes from a hash, so reruns agree.

    Tasks keep their own n smallest of a group before anything is sent, so a group's window holds n rows a task.
    """
    columns = [c for c, t in df.dtypes if not t.startswith("array")]
    u = (F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1_000_003)) + 0.5) / 1_000_003
    ranked = df.withColumn("_k", -F.log(u) / F.greatest(F.col(weight), F.lit(1e-12)))
    return ranked.withColumn("_r", F.row_number().over(Window.partitionBy(by).orderBy("_k", *columns))).filter(F.col("_r") <= n).drop("_k", "_r")


def density_weights(df: DataFrame, key: str, by: str, features: list[str], k: int = 5) -> DataFrame:
    """(key, weight): distance to the k-th neighbour of the same class, on the first two principal axes of the features (two features: as they are).

    However far that is; in a class of fewer others the farthest of them counts, a row alone in its class weighs 0.
    """
    from pyspark.ml.feature import PCA, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    if len(features) == 2:
        at = df.select(key, by, *(F.col(f).alias(a) for f, a in zip(features, "xy", strict=True)))
    else:
        flat = VectorAssembler(inputCols=features, outputCol="_f").transform(df)
        axes = PCA(k=2, inputCol="_f", outputCol="_p").fit(flat).transform(flat).withColumn("_a", vector_to_array("_p"))
        at = axes.select(key, by, F.get("_a", F.lit(0)).alias("x"), F.get("_a", F.lit(1)).alias("y"))
    near = nearest(at, at, key, None, key, k=k, other=True, within=(by,))
    far = near.groupBy(key).agg(F.sqrt(F.max("dist2")).alias("weight"))
    return df.select(key).join(far, key, "left").select(key, F.coalesce("weight", F.lit(0.0)).alias("weight"))


def density_downsample(df: DataFrame, key: str, by: str, features: list[str], n: int, k: int = 5, seed: int = 42) -> DataFrame:
    """n rows per class, rather those in thin places: a row's chance goes by ``density_weights``."""
    return weighted_sample(df.join(density_weights(df, key, by, features, k), key), "weight", by, n, seed)


def class_targets(df: DataFrame, by: str, target: int, low: int, high: int) -> DataFrame:
    """(class, n, goal): classes below ``low`` stay, those above ``high`` come down to ``target``, those between shrink half way to it."""
    n = df.groupBy(by).agg(F.count("*").alias("n"))
    goal = F.when(F.col("n") <= low, F.col("n")).when(F.col("n") > high, F.lit(target)).otherwise(F.least(F.col("n"), F.floor((F.col("n") + target) / 2)))
    return n.withColumn("goal", goal.cast("long"))


def balance(df: DataFrame, by: str, targets: DataFrame, order: list) -> DataFrame:
    """The first rows of each class in order, as many as its goal."""
    aimed = df.join(targets.select(by, "goal"), by)
    # a class is cut in two steps: no part gives more than the whole may, and what the parts leave is ranked once more
    columns = [x for x in df.columns if x != by]
    parted = aimed.withColumn("_part", F.pmod(F.xxhash64(*columns), F.lit(PARTS)))
    few = parted.withColumn("_r", F.row_number().over(Window.partitionBy(by, "_part").orderBy(*order))).filter(F.col("_r") <= F.col("goal"))
    return few.withColumn("_r", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("_r") <= F.col("goal")).select(*df.columns)


def copy_small_groups(df: DataFrame, by: list[str], least: int) -> DataFrame:
    """Rows of small groups copied whole until the group has at least ``least`` rows; ``copy`` counts from 1."""
    n = df.groupBy(*by).agg(F.count("*").alias("_n"))
    times = F.greatest(F.lit(1), F.ceil(F.lit(least) / F.col("_n")).cast("int"))
    return df.join(n, by).withColumn("copy", F.explode(F.sequence(F.lit(1), times))).drop("_n")


def resample_small_groups(df: DataFrame, by: list[str], least: int, order: list, seed: int = 42) -> DataFrame:
    """Small groups filled up to ``least`` rows by seeded picks with replacement; larger ones as they are."""
    small = df.groupBy(*by).agg(F.count("*").alias("_n")).filter(F.col("_n") < least)
    # only rows of small groups are ranked: fewer than ``least`` in a window
    ranked = df.join(small.select(*by), by, "left_semi").withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    slots = small.select(*by, "_n", F.explode(F.sequence(F.col("_n") + 1, F.lit(least).cast("long"))).alias("_slot"))
    picks = slots.withColumn("_r", (F.pmod(F.xxhash64(F.lit(seed), "_slot", *by), F.col("_n")) + 1).cast("int")).drop("_n", "_slot")
    return df.unionByName(picks.join(ranked, [*by, "_r"]).select(*df.columns))


def drop_small_classes(df: DataFrame, by: str, least: int, dirty: list[str] | None = None) -> DataFrame:
    """Rows of classes with at least ``least`` rows whose label is not among the dirty ones."""
    kept = df.filter(F.col(by).isNotNull() & ~F.col(by).isin(dirty or []))
    big = kept.groupBy(by).agg(F.count("*").alias("_n")).filter(F.col("_n") >= least).select(by)
    return kept.join(big, by, "left_semi")


def interpolate(df: DataFrame, key: str, by: str, features: list[str], k: int, each: int, seed: int = 42, apart: float = 0.0) -> DataFrame:
    """``each`` synthetic rows for every point whose class has another: between the point and one of the k nearest of its class (by x and y), however far.

    With ``apart``, rows (their x and y must be features) that lie closer than that to any given point of any class are left out.
    """
    near = nearest(df, df, key, None, key, k=k, other=True, within=(by,))
    made = near.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(each)))).withColumn("_u", (F.pmod(F.xxhash64(F.lit(seed), key, f"n_{key}", "_i"), F.lit(1_000_003)) + 0.5) / 1_000_003)
    picked = made.withColumn("_p", F.row_number().over(Window.partitionBy(key, "_i").orderBy(F.xxhash64(F.lit(seed), key, f"n_{key}", "_i"), f"n_{key}"))).filter("_p = 1")
    found = picked.select(key, by, F.col("_i").alias("copy"), *((F.col(f) + F.col("_u") * (F.col(f"n_{f}") - F.col(f))).alias(f) for f in features))
    if not apart:
        return found
    found = staged(found, "made")
    close = near_pairs(found.select(key, "copy", "x", "y"), df.select("x", "y").distinct(), apart).filter(F.col("dist2") < apart * apart).select(key, "copy").distinct()
    return found.join(close, [key, "copy"], "left_anti")


def uniform_samples(df: DataFrame, by: str, features: list[str], each: int, seed: int = 42) -> DataFrame:
    """``each`` synthetic rows per class, every feature drawn evenly between the class's least and greatest value; nulls count for nothing."""
    span = df.groupBy(by).agg(*(f(c).alias(f"_{n}_{c}") for c in features for n, f in (("lo", F.min), ("hi", F.max))))
    made = span.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(each))))
    return made.select(by, "copy", *((F.col(f"_lo_{c}") + _even(seed, by, "copy", F.lit(c)) * (F.col(f"_hi_{c}") - F.col(f"_lo_{c}"))).alias(c) for c in features))


def samples_around(df: DataFrame, key: str, by: str, features: list[str], share: float, each: int, apart: float = 0.0, seed: int = 42) -> DataFrame:
    """``each`` synthetic rows around every row, every feature moved by at most ``share`` of its class's range.

    Valid ones are kept: inside the class's range in all features, and moved by at least ``apart`` of the range in one.
    """
    span = df.groupBy(by).agg(*(f(c).alias(f"_{n}_{c}") for c in features for n, f in (("lo", F.min), ("hi", F.max))))
    made = df.join(span, by).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(each))))
    moved = made.withColumns({f"_new_{c}": F.col(c) + (2 * _even(seed, key, "copy", F.lit(c)) - 1) * share * (F.col(f"_hi_{c}") - F.col(f"_lo_{c}")) for c in features})
    inside = functools.reduce(Column.__and__, (F.col(f"_new_{c}").between(F.col(f"_lo_{c}"), F.col(f"_hi_{c}")) for c in features))
    far = F.greatest(F.lit(0.0), *(F.abs(F.col(f"_new_{c}") - F.col(c)) - apart * (F.col(f"_hi_{c}") - F.col(f"_lo_{c}")) for c in features)) > 0
    return moved.filter(inside & (far if apart else F.lit(True))).select(key, by, "copy", *(F.col(f"_new_{c}").alias(c) for c in features))


def _even(seed: int, *of) -> Column:
    """Evenly between 0 and 1 by a hash, so that reruns agree."""
    return (F.pmod(F.xxhash64(F.lit(seed), *of), F.lit(1_000_003)) + 0.5) / 1_000_003


def count_parameters(df: DataFrame, by: str) -> DataFrame:
    """Suggested bounds from the class sizes: lower quartile, median and upper quartile, and their spread."""
    n = df.groupBy(by).agg(F.count("*").alias("n"))
    return n.agg(F.percentile("n", 0.25).alias("low"), F.percentile("n", 0.5).alias("target"), F.percentile("n", 0.75).alias("high"), F.max("n").alias("most"), F.count("*").alias("classes"))


def density_features(points: DataFrame, key: str, size: float, radius: float | None = None, k: int = 4) -> DataFrame:
    """``cell_n``: points in the same square of ``size``; ``density``: 1 / mean distance to the k nearest, sought from ``radius`` on."""
    placed = points.withColumns({"_sx": F.floor(F.col("x") / size), "_sy": F.floor(F.col("y") / size)})
    counts = placed.groupBy("_sx", "_sy").agg(F.count("*").alias("cell_n"))
    near = nearest(points, points, key, radius, key, k=k, other=True).groupBy(key).agg(F.try_divide(F.lit(1.0), F.avg(F.sqrt("dist2"))).alias("density"))
    # points without coordinates are one square of their own
    counted = placed.join(counts.withColumnsRenamed({"_sx": "_tx", "_sy": "_ty"}), F.col("_sx").eqNullSafe(F.col("_tx")) & F.col("_sy").eqNullSafe(F.col("_ty")))
    return counted.select(*points.columns, "cell_n").join(near, key, "left")


def density_clusters(points: DataFrame, key: str, eps: float, least: int) -> DataFrame:
    """``cluster`` (its smallest core id; null: noise): cores have ``least`` points within ``eps``, themselves included; a border point joins its nearest core (ties: smallest id).

    Points on one spot are all cores or none and near the same others: spots are paired, with their numbers of points, not points.
    """
    placed = points.filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    spots = staged(placed.groupBy("x", "y").agg(F.min(key).cast("long").alias("a"), F.count("*").alias("n")), "spots")
    pairs = staged(near_pairs(spots, spots, eps).select("a", F.col("n_a").alias("b"), F.col("n_n").alias("n"), "dist2"), "pairs")
    cores = pairs.groupBy("a").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("a")
    between = pairs.filter("a < b").join(cores, "a", "left_semi").join(cores.withColumnRenamed("a", "b"), "b", "left_semi")
    named = cores.join(components(between), F.col("a") == F.col("node"), "left").select(F.col("a").alias("b"), F.coalesce("label", "a").alias("cluster"))
    best = pairs.join(named, "b").groupBy("a").agg(F.min(F.struct("dist2", "b", "cluster")).alias("m")).select("a", F.col("m.cluster").alias("cluster"))
    found = spots.join(best, "a", "left").select("x", "y", "cluster")
    return points.join(found, ["x", "y"], "left").select(*points.columns, "cluster")


def local_outlier_factor(points: DataFrame, key: str, k: int, radius: float | None = None) -> DataFrame:
    """``lof``: how much thinner the place of a point is than those of its k nearest, sought from ``radius`` on; null where there are no k others."""
    near = nearest(points, points, key, radius, key, k=k, other=True).select(F.col(key).alias("a"), F.col(f"n_{key}").alias("b"), F.sqrt("dist2").alias("d"))
    full = near.groupBy("a").agg(F.count("*").alias("n"), F.max("d").alias("kd")).filter(F.col("n") == k)
    reach = near.join(full.select(F.col("a").alias("b"), "kd"), "b").withColumn("r", F.greatest("d", "kd"))
    lrd = reach.groupBy("a").agg(F.try_divide(F.lit(1.0), F.avg("r")).alias("lrd"))
    lof = near.join(lrd.select(F.col("a").alias("b"), F.col("lrd").alias("other")), "b").groupBy("a").agg(F.avg("other").alias("m")).join(lrd, "a")
    return points.join(lof.select(F.col("a").alias(key), (F.col("m") / F.col("lrd")).alias("lof")), key, "left")


def hash_split(df: DataFrame, key: str, share: float, seed: int = 42) -> DataFrame:
    """``part``: test for about ``share`` of the keys, else train; the same key always falls alike."""
    return df.withColumn("part", F.when(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(10_000)) < int(share * 10_000), "test").otherwise("train"))
