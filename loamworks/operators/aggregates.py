"""Grouped summaries, area reports, cross tables and model metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamworks.operators.quantiles import quantiles
from loamworks.session import staged

# The ten grades, and their classes high, middle and low.
GRADES = ["一等", "二等", "三等", "四等", "五等", "六等", "七等", "八等", "九等", "十等"]
GRADE_CLASS = {"高等": GRADES[:3], "中等": GRADES[3:6], "低等": GRADES[6:]}
TOTAL = "合计"


def grade_class(grade: Column) -> Column:
    out = None
    for name, grades in GRADE_CLASS.items():
        out = F.when(grade.isin(grades), name) if out is None else out.when(grade.isin(grades), name)
    return out


def with_total(df: DataFrame, key: str, sums: dict[str, Column]) -> DataFrame:
    """The rows and one total row, named in ``key`` and computed by ``sums`` over the rows."""
    total = df.agg(*(v.alias(k) for k, v in sums.items()))
    return df.unionByName(total.withColumn(key, F.lit(TOTAL)).select(*df.columns))


def area_by(df: DataFrame, key: str, area: str) -> DataFrame:
    """Area sum, mean and share of each group and a total row; null groups are left out."""
    sums = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum(area).alias("area"), F.avg(area).alias("mean_area"))
    shares = sums.withColumn("share", 100 * F.col("area") / F.sum("area").over(Window.partitionBy()))
    return with_total(shares, key, {"area": F.sum("area"), "mean_area": F.avg("mean_area"), "share": F.sum("share")})


def grade_table(df: DataFrame, grade: str, area: str, capacity: str) -> DataFrame:
    """Per grade: class, area, share and mean capacity; the total's capacity is weighted by area."""
    rows = df.groupBy(grade).agg(F.sum(area).alias("area"), F.avg(capacity).alias("capacity"))
    rows = rows.withColumns({"grade_class": grade_class(F.col(grade)), "share": 100 * F.col("area") / F.sum("area").over(Window.partitionBy())})
    return with_total(
        rows, grade, {"area": F.sum("area"), "capacity": F.sum(F.col("area") * F.col("capacity")) / F.sum("area"), "grade_class": F.lit(TOTAL), "share": F.sum("share")}
    )


def class_pivot(df: DataFrame, keys: list[str], klass: str, names: list[str], area: str) -> DataFrame:
    """Area and row share of every class for each key; absent classes are 0."""
    sums = df.groupBy(*keys).agg(*(F.sum(F.when(F.col(klass) == n, F.col(area)).otherwise(0.0)).alias(n) for n in names))
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return sums.withColumn("total", total).select(*keys, *names, "total", *((100 * F.col(n) / F.col("total")).alias(f"{n}_share") for n in names))


def class_pivot_total(df: DataFrame, key: str, klass: str, names: list[str], area: str) -> DataFrame:
    """The class pivot of one key with a total row."""
    rows = class_pivot(df, [key], klass, names, area)
    sums = {c: F.sum(c) for c in [*names, "total"]} | {f"{n}_share": 100 * F.sum(n) / F.sum("total") for n in names}
    return with_total(rows, key, sums)


def one_grade(df: DataFrame, keys: list[str], grade: str, value: str, area: str, **means: str) -> DataFrame:
    """Areas of one grade by key, with their share of the grade and the means asked for."""
    rows = df.filter(F.col(grade) == value).groupBy(*keys).agg(F.sum(area).alias("area"), *(F.avg(c).alias(n) for n, c in means.items()))
    return rows.withColumn("share", 100 * F.col("area") / F.sum("area").over(Window.partitionBy()))


def graded_crosstab(df: DataFrame, category: Column, grade: str, grades: list[str], area: str, order: list[str]) -> DataFrame:
    """Categories in fixed order by grade: areas and column shares, absent ones 0, and a total row of shares 100 (0 for an empty column)."""
    sums = df.select(category.alias("category"), grade, area).groupBy("category").agg(*(F.sum(F.when(F.col(grade) == g, F.col(area)).otherwise(0.0)).alias(g) for g in grades))
    fixed = df.sparkSession.createDataFrame([(n, i) for i, n in enumerate(order)], "category string, position int")
    rows = fixed.join(sums, "category", "left").fillna(0.0, grades)
    everything = Window.partitionBy()  # as many rows as categories
    shares = {f"{g}_share": F.when(F.sum(g).over(everything) == 0, 0.0).otherwise(100 * F.col(g) / F.sum(g).over(everything)) for g in grades}
    rows = rows.withColumns(shares)
    totals = {"position": F.lit(len(order))} | {c: F.sum(c) for g in grades for c in (g, f"{g}_share")}
    return with_total(rows, "category", totals)


def binned(value: Column, edges: list[float], labels: list[str]) -> Column:
    """The label of the half-open interval [edge, next edge); null outside."""
    out = None
    for lo, hi, name in zip(edges[:-1], edges[1:], labels, strict=True):
        test = (value >= lo) & (value < hi)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in an explicit order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def count_repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many rows repeat a key that an earlier row has."""
    n = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return n.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeats"))


def keep_best(df: DataFrame, key: str, flag: str, order: list) -> DataFrame:
    """Of each key a flagged row if there is one, else the first in order."""
    return keep_first(df, [key], [F.col(flag).desc(), *order])


def class_shares(df: DataFrame, column: str) -> DataFrame:
    """Counts and shares of the values."""
    n = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def distinct_values(df: DataFrame, key: str, value: str, sep: str = "|") -> DataFrame:
    """The sorted different values of each group as one text."""
    return df.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(value)), sep).alias("distinct_values"))


def first_record(df: DataFrame, key: str, values: list[str], order: list[str]) -> DataFrame:
    """Of each group the values of its first row in order."""
    least = F.min(F.struct(*order, *values)).alias("_row")
    return df.groupBy(key).agg(least).select(key, *(F.col(f"_row.{v}").alias(v) for v in values))


def ranked(values: DataFrame, order: list[str], into: str) -> DataFrame:
    """The rows with their place in ``order``, from 0: dealt by ranges, placed within a range, and moved on by the rows of the ranges before it."""
    dealt = staged(values.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))  # a row per range
    start = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return dealt.withColumn("_w", within).join(start, "_part").withColumn(into, (F.col("_w") + F.col("_start")).cast("int")).drop("_part", "_w", "_start")


def codes(df: DataFrame, column: str, into: str = "code") -> DataFrame:
    """Ordered labels as 0, 1, ...; the distinct labels are ranked by ranges and joined back."""
    return df.join(ranked(df.select(column).filter(F.col(column).isNotNull()).distinct(), [column], into), column, "left")


def codes_by_appearance(df: DataFrame, column: str, order: str, into: str = "code") -> DataFrame:
    """Labels numbered by their first appearance in ``order``."""
    firsts = df.groupBy(column).agg(F.min(order).alias("_first"))
    return df.join(ranked(firsts, ["_first", column], into).drop("_first"), column, "left")


def crosstab_shares(df: DataFrame, row: str, column: str, names: list) -> DataFrame:
    """Row-normalised counts."""
    n = F.count("*")
    return df.groupBy(row).agg(*((F.sum((F.col(column) == v).cast("int")) / n).alias(str(v)) for v in names))


def describe(df: DataFrame, column: str, shares: list[float]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quantiles."""
    plain = df.agg(F.count(column).alias("n"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"), F.min(column).alias("least"), F.max(column).alias("most"))
    return plain.crossJoin(F.broadcast(quantiles(df, {f"q{round(100 * q):02d}": (column, q) for q in shares})))


def zonal(cells: DataFrame, zone: str, bands: dict[str, list[str]]) -> DataFrame:
    """One row per zone; for each band the statistics asked for: mean, std, min, max, sum, count, range, median, or a percentile such as p90.

    Medians and percentiles are exact and interpolated; no zone's values meet in one task.
    """
    make = {
        "mean": F.avg, "std": F.stddev_pop, "min": F.min, "max": F.max, "sum": F.sum, "count": F.count,
        "range": lambda b: F.max(b) - F.min(b),
    }
    share = lambda s: 0.5 if s == "median" else float(s[1:]) / 100
    names = [f"{b}_{s}" for b, stats in bands.items() for s in stats]
    plain = [make[s](b).alias(f"{b}_{s}") for b, stats in bands.items() for s in stats if s in make]
    placed = {f"{b}_{s}": (b, share(s)) for b, stats in bands.items() for s in stats if s not in make}
    found = cells.groupBy(zone).agg(*plain) if plain else cells.select(zone).distinct()
    if placed:
        cuts = quantiles(cells, placed, [zone]).withColumnRenamed(zone, "_zone")
        found = found.join(cuts, F.col(zone).eqNullSafe(F.col("_zone")), "left")
    return found.select(zone, *names)


def centroids(cells: DataFrame, zone: str) -> DataFrame:
    """Centre of the cell centres and envelope of each zone."""
    return cells.groupBy(zone).agg(
        F.avg(F.col("c") + 0.5).alias("x"), F.avg(F.col("r") + 0.5).alias("y"),
        F.min("c").alias("x_min"), F.min("r").alias("y_min"), (F.max("c") + 1).alias("x_max"), (F.max("r") + 1).alias("y_max"),
    )


def band_statistics(cells: DataFrame, bands: list[str]) -> DataFrame:
    """One row per band with minimum, maximum, mean and population deviation; one pass over the grid."""
    wide = cells.agg(*(f(b).alias(f"{b}_{n}") for b in bands for n, f in (("least", F.min), ("most", F.max), ("mean", F.avg), ("std", F.stddev_pop))))
    rows = F.array(*(F.struct(F.lit(b).alias("band"), *(F.col(f"{b}_{n}").alias(n) for n in ("least", "most", "mean", "std"))) for b in bands))
    return wide.select(F.inline(rows))


def band_shares(value: str, edges: list[float]) -> list[Column]:
    """Shares of rows in each interval [edge, next edge)."""
    return [F.avg(((F.col(value) >= lo) & (F.col(value) < hi)).cast("int")).alias(f"share_{i}") for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False))]


def dissolve(cells: DataFrame, by: list[str], first: list[str], cell_area: float = 1.0) -> DataFrame:
    """Cells merged by attributes: area and, of other columns, the value of the first cell."""
    return cells.groupBy(*by).agg((F.count("*") * cell_area).alias("area"), F.min(F.struct("r", "c", *first)).alias("_row")).select(*by, "area", *(F.col(f"_row.{c}").alias(c) for c in first))


def monthly_mean(df: DataFrame, area: str, month: str, value: str, scale: float = 1.0) -> DataFrame:
    """Mean of each area and month, scaled to another unit."""
    return df.groupBy(area, month).agg((F.avg(value) * scale).alias("mean"))


def accuracy(df: DataFrame, truth: str, predicted: str, by: str | None = None) -> DataFrame:
    """Share of right predictions, overall or by group."""
    right = F.avg((F.col(truth) == F.col(predicted)).cast("int")).alias("accuracy")
    return df.groupBy(by).agg(F.count("*").alias("n"), right) if by else df.agg(F.count("*").alias("n"), right)


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def class_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support of each true class; undefined ratios are 0."""
    n = confusion(df, truth, predicted)
    t = n.groupBy(F.col("truth").alias("klass")).agg(F.sum("n").alias("support"), F.sum(F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)).alias("hits"))
    p = n.groupBy(F.col("predicted").alias("klass")).agg(F.sum("n").alias("said"))
    j = t.join(p, "klass", "left")
    precision = F.coalesce(F.try_divide("hits", "said"), F.lit(0.0))
    recall = F.col("hits") / F.col("support")
    return j.select("klass", "support", precision.alias("precision"), recall.alias("recall"), F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)).alias("f1"))


def regression_report(df: DataFrame, truth: str, predicted: str, tolerance: float | None = None) -> DataFrame:
    """R2, MAE, MSE and RMSE; with a tolerance, errors within that share of the true value count as zero."""
    y, e = F.col(truth), F.col(truth) - F.col(predicted)
    if tolerance is not None:
        e = F.when(F.abs(e) <= tolerance * F.abs(y), 0.0).otherwise(e)
    s = df.select(y.alias("y"), e.alias("e")).agg(F.sum(F.col("e") * F.col("e")).alias("ss"), F.avg(F.abs("e")).alias("mae"), F.avg(F.col("e") * F.col("e")).alias("mse"), (F.var_pop("y") * F.count("y")).alias("st"))
    return s.select((1 - F.try_divide("ss", "st")).alias("r2"), "mae", "mse", F.sqrt("mse").alias("rmse"))


def group_maximum(df: DataFrame, keys: list[str], value: str, order: list) -> DataFrame:
    """Rows that hold their group's maximum, one of each (key, maximum)."""
    w = Window.partitionBy(*keys)
    return keep_first(df.withColumn("_max", F.max(value).over(w)).filter(F.col(value) == F.col("_max")).drop("_max"), keys, order)


def combined_prior(areas: DataFrame, points: DataFrame, kind: str, area: str) -> DataFrame:
    """Half of the area share and half of the point share of each kind, made to add up to 1."""
    everything = Window.partitionBy()  # as many rows as kinds
    a = areas.groupBy(kind).agg(F.sum(area).alias("_a")).withColumn("_a", F.col("_a") / F.sum("_a").over(everything))
    p = points.groupBy(kind).agg(F.count("*").alias("_p")).withColumn("_p", F.col("_p") / F.sum("_p").over(everything))
    both = a.join(p, kind, "outer").withColumn("prior", (F.coalesce("_a", F.lit(0.0)) + F.coalesce("_p", F.lit(0.0))) / 2)
    return both.select(kind, (F.col("prior") / F.sum("prior").over(everything)).alias("prior"))


def transition_weights(kinds: DataFrame, slopes: DataFrame, uses: DataFrame, kind: str, slope: str, use: str, factors: list[Column]) -> DataFrame:
    """Product of factors for each kind, slope class and use, normalised over kinds. The three tables hold distinct codes: their product is small."""
    grid = kinds.crossJoin(F.broadcast(slopes)).crossJoin(F.broadcast(uses))
    product = factors[0]
    for f in factors[1:]:
        product = product * f
    return grid.withColumn("_w", product).select(kind, slope, use, (F.col("_w") / F.sum("_w").over(Window.partitionBy(slope, use))).alias("weight"))


def status_report(df: DataFrame, columns: list[str], statuses: list[str]) -> DataFrame:
    """Per status column: rows, and count and percentage of each status."""
    long = df.unpivot([], columns, "column", "status")
    n = long.groupBy("column").agg(F.count("*").alias("n"), *(F.sum((F.coalesce(F.col("status"), F.lit("")) == s).cast("int")).alias(s) for s in statuses))
    return n.withColumns({f"{s}_pct": 100 * F.col(s) / F.col("n") for s in statuses})
