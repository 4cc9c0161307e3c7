"""Summaries, area reports, cross tables, metrics and windows over probabilities."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamworks.functions import scoring as S
from loamworks.operators import aggregates as A
from loamworks.plans.registry import query

# a unit's grade by its id, so that every grade occurs
GRADE = "CASE l_partkey % 10 " + " ".join(f"WHEN {i} THEN '{g}'" for i, g in enumerate(A.GRADES)) + " END"
KLASS = "CASE WHEN l_partkey % 10 <= 2 THEN '高等' WHEN l_partkey % 10 <= 5 THEN '中等' ELSE '低等' END"
CLASSES = list(A.GRADE_CLASS)
G = f"WITH g AS (SELECT *, {GRADE} AS grade, {KLASS} AS klass FROM units)"


def graded(t):
    u = t.units.withColumn("grade", F.expr(GRADE))
    return u.withColumn("klass", A.grade_class(F.col("grade")))


def rounded(df, *columns, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    "A1_area_by_township",
    "WITH a AS (SELECT township, sum(area) AS area, avg(area) AS mean_area FROM units WHERE township IS NOT NULL GROUP BY 1), b AS (SELECT *, 100 * area / sum(area) OVER () AS share FROM a) "
    "SELECT township, round(area, 4) AS area, round(mean_area, 4) AS mean_area, round(share, 4) AS share FROM b UNION ALL SELECT '合计', round(sum(area), 4), round(avg(mean_area), 4), round(sum(share), 4) FROM b",
)
def _(t):
    return rounded(A.area_by(t.units, "township", "area"), "area", "mean_area", "share")


@query(
    "A2_grade_table",
    f"{G}, a AS (SELECT grade, klass, sum(area) AS area, avg(thickness) AS capacity FROM g GROUP BY 1, 2) "
    "SELECT grade, klass AS grade_class, round(area, 4) AS area, round(capacity, 4) AS capacity, round(100 * area / sum(area) OVER (), 4) AS share FROM a "
    "UNION ALL SELECT '合计', '合计', round(sum(area), 4), round(sum(area * capacity) / sum(area), 4), 100.0 FROM a",
)
def _(t):
    return rounded(A.grade_table(graded(t), "grade", "area", "thickness"), "area", "capacity", "share")


def pivot_sql(keys: str) -> str:
    sums = ", ".join(f"sum(CASE WHEN klass = '{k}' THEN area ELSE 0 END) AS {k}" for k in CLASSES)
    total = " + ".join(CLASSES)
    shares = ", ".join(f"round(100 * {k} / ({total}), 4) AS {k}_share" for k in CLASSES)
    return f"{G}, a AS (SELECT {keys}, {sums} FROM g GROUP BY {keys}) SELECT {keys}, {', '.join(f'round({k}, 4) AS {k}' for k in CLASSES)}, round({total}, 4) AS total, {shares} FROM a"


TOTALS = ", ".join([*(f"round(sum({k}), 4)" for k in CLASSES), f"round(sum({' + '.join(CLASSES)}), 4)", *(f"round(100 * sum({k}) / sum({' + '.join(CLASSES)}), 4)" for k in CLASSES)])
PIVOTED = [*CLASSES, "total", *(f"{k}_share" for k in CLASSES)]


@query("A3_township_grade_pivot", f"{pivot_sql('township')} UNION ALL SELECT '合计', {TOTALS} FROM a")
def _(t):
    return rounded(A.class_pivot_total(graded(t), "township", "klass", CLASSES, "area"), *PIVOTED)


@query("A4_hierarchy_grade_pivot", pivot_sql("tl, yl, ts, tz"))
def _(t):
    return rounded(A.class_pivot(graded(t), ["tl", "yl", "ts", "tz"], "klass", CLASSES, "area"), *PIVOTED)


@query("A5_one_grade_by_township", f"{G} SELECT township, sum(area) AS area, round(100 * sum(area) / sum(sum(area)) OVER (), 4) AS share FROM g WHERE grade = '三等' GROUP BY 1")
def _(t):
    return rounded(A.one_grade(graded(t), ["township"], "grade", "三等", "area"), "share")


@query(
    "A6_one_grade_properties",
    f"{G} SELECT tl, yl, ts, tz, sum(area) AS area, round(avg(thickness), 4) AS thickness, round(avg(organic), 4) AS organic, round(100 * sum(area) / sum(sum(area)) OVER (), 4) AS share FROM g WHERE grade = '一等' GROUP BY 1, 2, 3, 4",
)
def _(t):
    return rounded(A.one_grade(graded(t), ["tl", "yl", "ts", "tz"], "grade", "一等", "area", thickness="thickness", organic="organic"), "thickness", "organic", "share")


def crosstab_sql(category: str, order: list[str]) -> str:
    grades = A.GRADES
    sums = ", ".join(f"sum(CASE WHEN grade = '{g}' THEN area ELSE 0 END) AS {g}" for g in grades)
    fixed = ", ".join(f"('{n}', {i})" for i, n in enumerate(order))
    kept = ", ".join(f"coalesce({g}, 0) AS {g}" for g in grades)
    out = ", ".join(f"round({g}, 4) AS {g}, round(CASE WHEN sum({g}) OVER () = 0 THEN 0 ELSE 100 * {g} / sum({g}) OVER () END, 4) AS {g}_share" for g in grades)
    totals = ", ".join(f"round(sum({g}), 4), CASE WHEN sum({g}) = 0 THEN 0.0 ELSE 100.0 END" for g in grades)
    return (
        f"{G}, s AS (SELECT {category} AS category, {sums} FROM g GROUP BY 1), o(category, position) AS (VALUES {fixed}), a AS (SELECT o.category, o.position, {kept} FROM o LEFT JOIN s ON o.category = s.category) "
        f"SELECT category, position, {out} FROM a UNION ALL SELECT '合计', {len(order)}, {totals} FROM a"
    )


def crosstab(t, category, order):
    df = A.graded_crosstab(graded(t), category, "grade", A.GRADES, "area", order)
    return rounded(df, *(c for g in A.GRADES for c in (g, f"{g}_share")))


#: What stands for each report's category in the fixture, with its fixed order; one category is absent on purpose.
CROSSTABS = {
    "A7_terrain": ("position", ["山地坡下", "山地坡中", "山地坡上", "平原"]),
    "A7_texture_config": ("land", ["水田", "旱地", "水浇地", "园地"]),
    "A7_layer_texture": ("tl", ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "NOWHERE"]),
    "A7_irrigation": ("CASE l_linenumber % 4 WHEN 0 THEN '不满足' WHEN 1 THEN '基本满足' WHEN 2 THEN '满足' ELSE '充分满足' END", ["充分满足", "满足", "基本满足", "不满足"]),
    "A7_drainage": ("CASE l_suppkey % 3 WHEN 0 THEN '不满足' WHEN 1 THEN '基本满足' ELSE '满足' END", ["充分满足", "满足", "基本满足", "不满足"]),
}
#: Value, edges of the half-open ranges.
RANGES = {
    "A8_thickness": ("thickness", [0, 10, 20, 30, 40, 60]),
    "A8_layer_thickness": ("thickness / 2", [0, 5, 10, 15, 20, 30]),
    "A8_bulk_density": ("1 + area / 100", [1.0, 1.1, 1.25, 1.35, 1.6]),
    "A8_ph": ("ph", [4.0, 4.5, 5.5, 6.5, 7.5, 8.5, 9.5]),
    "A8_organic_matter": ("organic", [0, 2, 4, 6, 8]),
    "A8_phosphorus": ("area", [0, 5, 10, 20, 40, 60]),
    "A8_potassium": ("area * 4", [0, 50, 100, 150, 250]),
}


def _register_crosstabs():
    for name, (category, order) in CROSSTABS.items():
        query(name, crosstab_sql(category, order))(lambda t, category=category, order=order: crosstab(t, F.expr(category), order))
    for name, (value, edges) in RANGES.items():
        labels = [f"[{lo},{hi})" for lo, hi in zip(edges, edges[1:], strict=False)]
        case = "CASE " + " ".join(f"WHEN {value} >= {lo} AND {value} < {hi} THEN '{n}'" for lo, hi, n in zip(edges, edges[1:], labels, strict=False)) + " END"
        query(name, crosstab_sql(case, labels))(lambda t, value=value, edges=edges, labels=labels: crosstab(t, A.binned(F.expr(value), edges, labels), labels))


_register_crosstabs()


@query("A9_natural_breaks_report")
def _(t):
    edges = S.natural_breaks(t.units, "thickness")
    edges = sorted(set(edges))
    edges[-1] += 1
    labels = [f"[{lo:g},{hi:g})" for lo, hi in zip(edges, edges[1:], strict=False)]
    return crosstab(t, A.binned(F.col("thickness"), edges, labels), labels)


ORD = "layer, lab_id, run_id, ord"


@query("A10_keep_first", f"SELECT site_id, layer, lab_id, run_id, ord, val_txt FROM (SELECT *, row_number() OVER (PARTITION BY site_id, layer ORDER BY {ORD}) AS k FROM samples) WHERE k = 1")
def _(t):
    return A.keep_first(t.samples, ["site_id", "layer"], ORD.split(", ")).drop("flag")


@query("A10_count_repeats", "SELECT CAST(count(*) - count(DISTINCT site_id * 10 + layer) AS BIGINT) AS repeats FROM samples")
def _(t):
    return A.count_repeats(t.samples, ["site_id", "layer"])


@query("A11_keep_best", f"SELECT site_id, layer, lab_id, run_id, ord, flag FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY flag DESC, {ORD}) AS k FROM samples) WHERE k = 1")
def _(t):
    return A.keep_best(t.samples, "site_id", "flag", ORD.split(", ")).drop("val_txt")


@query("A12_class_shares", "SELECT cls, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM sites GROUP BY 1")
def _(t):
    return rounded(A.class_shares(t.sites, "cls"), "share", digits=6)


@query("A13_distinct_values", "SELECT yl, array_to_string(list_sort(list_distinct(list(tz))), '|') AS distinct_values FROM units GROUP BY 1")
def _(t):
    return A.distinct_values(t.units, "yl", "tz")


@query("A14_first_record", "SELECT ts, tl, yl, tz FROM (SELECT *, row_number() OVER (PARTITION BY ts ORDER BY l_orderkey, l_linenumber, tl, yl, tz) AS k FROM units) WHERE k = 1")
def _(t):
    return A.first_record(t.units, "ts", ["tl", "yl", "tz"], ["l_orderkey", "l_linenumber"])


@query("A15_codes", "SELECT site_id, cls, CAST(dense_rank() OVER (ORDER BY cls) - 1 AS INT) AS code FROM sites")
def _(t):
    return A.codes(t.sites.select("site_id", "cls"), "cls")


@query("A15_codes_by_appearance", "WITH f AS (SELECT cls, min(site_id) AS f FROM sites GROUP BY 1), r AS (SELECT cls, CAST(row_number() OVER (ORDER BY f, cls) - 1 AS INT) AS code FROM f) SELECT site_id, cls, code FROM sites JOIN r USING (cls)")
def _(t):
    return A.codes_by_appearance(t.sites.select("site_id", "cls"), "cls", "site_id")


@query("A16_crosstab_shares", f"{G} SELECT land, " + ", ".join(f"round(avg(CASE WHEN klass = '{k}' THEN 1.0 ELSE 0 END), 6) AS {k}" for k in CLASSES) + " FROM g GROUP BY 1")
def _(t):
    return rounded(A.crosstab_shares(graded(t), "land", "klass", CLASSES), *CLASSES, digits=6)


@query(
    "A17_describe",
    "SELECT count(dem) AS n, round(avg(dem), 4) AS mean, round(stddev_samp(dem), 4) AS std, min(dem) AS least, max(dem) AS most, " + ", ".join(f"round(quantile_cont(dem, {q}), 4) AS q{round(100 * q):02d}" for q in (0.1, 0.25, 0.5, 0.75, 0.9)) + " FROM cells",
)
def _(t):
    return rounded(A.describe(t.cells, "dem", [0.1, 0.25, 0.5, 0.75, 0.9]), "mean", "std", "q10", "q25", "q50", "q75", "q90")


@query(
    "A18_zonal_statistics",
    "WITH m AS (SELECT zone_id, pos, row_number() OVER (PARTITION BY zone_id ORDER BY count(*) DESC, pos) AS k FROM cells GROUP BY 1, 2) SELECT s.zone_id, round(avg(dem), 4) AS dem_mean, round(stddev_pop(dem), 4) AS dem_std, min(dem) AS dem_min, max(dem) AS dem_max, count(dem) AS dem_count, "
    "max(b2) - min(b2) AS b2_range, sum(b2) AS b2_sum, median(b2) AS b2_median, any_value(m.pos) AS pos_majority FROM cells s JOIN m ON s.zone_id = m.zone_id AND k = 1 GROUP BY 1",
)
def _(t):
    from loamworks.operators.joins import majority

    z = A.zonal(t.cells, "zone_id", {"dem": ["mean", "std", "min", "max", "count"], "b2": ["range", "sum", "median"]})
    m = majority(t.cells, "zone_id", "pos", "pos_majority").drop("pos_majority_share")
    return rounded(z.join(m, "zone_id"), "dem_mean", "dem_std")


@query(
    "A18_zonal_percentiles",
    "SELECT zone_id, round(quantile_cont(b2, 0.1), 4) AS b2_p10, round(quantile_cont(b2, 0.5), 4) AS b2_median, round(quantile_cont(b2, 0.9), 4) AS b2_p90, round(quantile_cont(dem, 0.25), 4) AS dem_p25, count(dem) AS dem_count FROM cells GROUP BY 1",
)
def _(t):
    return rounded(A.zonal(t.cells, "zone_id", {"b2": ["p10", "median", "p90"], "dem": ["p25", "count"]}), "b2_p10", "b2_median", "b2_p90", "dem_p25")


@query("A19_centroids", "SELECT zone_id, round(avg(c + 0.5), 4) AS x, round(avg(r + 0.5), 4) AS y, min(c) AS x_min, min(r) AS y_min, max(c) + 1 AS x_max, max(r) + 1 AS y_max FROM cells GROUP BY 1")
def _(t):
    return rounded(A.centroids(t.cells, "zone_id"), "x", "y")


BANDS = ["dem", "b2", "b3", "b8"]


@query("A20_band_statistics", " UNION ALL ".join(f"SELECT '{b}' AS band, min({b}) AS least, max({b}) AS most, round(avg({b}), 4) AS mean, round(stddev_pop({b}), 4) AS std FROM cells" for b in BANDS))
def _(t):
    return rounded(A.band_statistics(t.cells, BANDS), "mean", "std")


@query("A21_band_shares", "SELECT " + ", ".join(f"round(avg(CASE WHEN b2 >= {lo} AND b2 < {hi} THEN 1.0 ELSE 0 END), 6) AS share_{i}" for i, (lo, hi) in enumerate([(0, 20), (20, 50), (50, 100)])) + " FROM cells")
def _(t):
    s = t.cells.agg(*A.band_shares("b2", [0, 20, 50, 100]))
    return rounded(s, *s.columns, digits=6)


@query("A22_dissolve", "SELECT dl, dz, count(*) * 1.0 AS area, arg_min(b2, r * 1000 + c) AS b2, arg_min(zone_id, r * 1000 + c) AS zone_id FROM cells GROUP BY 1, 2")
def _(t):
    return A.dissolve(t.cells, ["dl", "dz"], ["b2", "zone_id"])


@query("A23_monthly_mean", "SELECT area_id, CAST(month AS DATE) AS month, round(avg(value) * 0.1, 4) AS mean FROM climate GROUP BY 1, 2")
def _(t):
    return rounded(A.monthly_mean(t.climate, "area_id", "month", "value", 0.1), "mean").withColumn("month", F.to_date("month"))


P5 = [f"p{i}" for i in range(5)]
ARG = "CASE " + " ".join(f"WHEN p{i} = greatest(p0, p1, p2, p3, p4) THEN {i}" for i in range(5)) + " END"
GUESS = f"WITH q AS (SELECT *, {ARG} AS guess FROM probs)"


def guessed(t):
    return t.probs.withColumn("guess", F.expr(ARG))


@query("A24_accuracy", f"{GUESS} SELECT truth, count(*) AS n, round(avg(CASE WHEN truth = guess THEN 1.0 ELSE 0 END), 6) AS accuracy FROM q GROUP BY 1 UNION ALL SELECT NULL, count(*), round(avg(CASE WHEN truth = guess THEN 1.0 ELSE 0 END), 6) FROM q")
def _(t):
    q = guessed(t)
    return rounded(A.accuracy(q, "truth", "guess", "truth").unionByName(A.accuracy(q, "truth", "guess").withColumn("truth", F.lit(None))), "accuracy", digits=6)


@query("A25_confusion", f"{GUESS} SELECT truth, guess AS predicted, count(*) AS n FROM q GROUP BY 1, 2")
def _(t):
    return A.confusion(guessed(t), "truth", "guess")


@query(
    "A25_class_report",
    f"{GUESS}, k AS (SELECT truth AS klass, count(*) AS support, count(*) FILTER (WHERE truth = guess) AS hits FROM q GROUP BY 1), s AS (SELECT guess AS klass, count(*) AS said FROM q GROUP BY 1), "
    "p AS (SELECT k.klass, support, coalesce(hits / nullif(said, 0), 0) AS pr, hits / support AS re FROM k LEFT JOIN s ON k.klass = s.klass) "
    "SELECT klass, support, round(pr, 6) AS precision, round(re, 6) AS recall, round(CASE WHEN pr + re = 0 THEN 0 ELSE 2 * pr * re / (pr + re) END, 6) AS f1 FROM p",
)
def _(t):
    return rounded(A.class_report(guessed(t), "truth", "guess"), "precision", "recall", "f1", digits=6)


REG = "SELECT ph AS y, ph + (site_id % 7 - 3) / 10.0 AS f FROM sites"


@query("A26_regression_report", f"WITH s AS ({REG}) SELECT round(1 - sum((y-f)*(y-f)) / (var_pop(y) * count(*)), 6) AS r2, round(avg(abs(y-f)), 6) AS mae, round(avg((y-f)*(y-f)), 6) AS mse, round(sqrt(avg((y-f)*(y-f))), 6) AS rmse FROM s")
def _(t):
    s = t.sites.select(F.col("ph").alias("y"), F.expr("ph + cast(site_id % 7 - 3 as double) / 10").alias("f"))
    return rounded(A.regression_report(s, "y", "f"), "r2", "mae", "mse", "rmse", digits=6)


@query("A30_tolerant_r2", f"WITH s AS ({REG}), e AS (SELECT y, CASE WHEN abs(y-f) <= 0.05 * abs(y) THEN 0 ELSE y - f END AS e FROM s) SELECT round(1 - sum(e*e) / (var_pop(y) * count(*)), 6) AS r2, round(avg(abs(e)), 6) AS mae, round(avg(e*e), 6) AS mse, round(sqrt(avg(e*e)), 6) AS rmse FROM e")
def _(t):
    s = t.sites.select(F.col("ph").alias("y"), F.expr("ph + cast(site_id % 7 - 3 as double) / 10").alias("f"))
    return rounded(A.regression_report(s, "y", "f", 0.05), "r2", "mae", "mse", "rmse", digits=6)


@query(
    "A27_combined_prior",
    "WITH a AS (SELECT tl AS kind, sum(area) AS s FROM units WHERE tl <> 'ASIA' GROUP BY 1), p AS (SELECT tl AS kind, count(*) AS s FROM units WHERE tl <> 'EUROPE' GROUP BY 1), x AS (SELECT kind, s / sum(s) OVER () AS s FROM a), y AS (SELECT kind, s / sum(s) OVER () AS s FROM p), "
    "z AS (SELECT coalesce(x.kind, y.kind) AS kind, (coalesce(x.s, 0) + coalesce(y.s, 0)) / 2 AS prior FROM x FULL JOIN y ON x.kind = y.kind) SELECT kind, round(prior / sum(prior) OVER (), 6) AS prior FROM z",
)
def _(t):
    u = t.units.withColumnRenamed("tl", "kind")
    return rounded(A.combined_prior(u.filter("kind <> 'ASIA'"), u.filter("kind <> 'EUROPE'"), "kind", "area"), "prior", digits=6)


@query(
    "A28_transition_weights",
    "WITH k AS (SELECT DISTINCT dz AS kind FROM cells), s AS (SELECT DISTINCT pos AS slope FROM cells), u AS (SELECT DISTINCT dl AS use FROM cells), g AS (SELECT kind, slope, use, (1 + (kind * 7 + slope * 3) % 5) * (0.5 + (kind + use) % 4) AS w FROM k, s, u) "
    "SELECT kind, slope, use, round(w / sum(w) OVER (PARTITION BY slope, use), 6) AS weight FROM g",
)
def _(t):
    k, s, u = (t.cells.select(F.col(a).alias(b)).distinct() for a, b in (("dz", "kind"), ("pos", "slope"), ("dl", "use")))
    return rounded(A.transition_weights(k, s, u, "kind", "slope", "use", [F.expr("1 + (kind * 7 + slope * 3) % 5"), F.expr("0.5D + (kind + use) % 4")]), "weight", digits=6)


STATUS = "CASE WHEN val_txt IS NULL THEN 'Missing' WHEN TRY_CAST(val_txt AS DOUBLE) IS NULL THEN 'Dirty' WHEN TRY_CAST(val_txt AS DOUBLE) > 45 THEN 'High' ELSE 'Normal' END"
STATES = ["Normal", "High", "Dirty", "Missing"]


@query(
    "A29_status_report",
    f"WITH s AS (SELECT 'val_sta' AS \"column\", {STATUS} AS status FROM samples UNION ALL SELECT 'flag_sta', CASE WHEN flag = 1 THEN 'High' ELSE 'Normal' END FROM samples) SELECT \"column\", count(*) AS n, "
    + ", ".join(f'count(*) FILTER (WHERE status = \'{s}\') AS "{s}", round(100.0 * count(*) FILTER (WHERE status = \'{s}\') / count(*), 4) AS "{s}_pct"' for s in STATES)
    + " FROM s GROUP BY 1",
)
def _(t):
    s = t.samples.select(F.expr(STATUS).alias("val_sta"), F.expr("CASE WHEN flag = 1 THEN 'High' ELSE 'Normal' END").alias("flag_sta"))
    return rounded(A.status_report(s, ["val_sta", "flag_sta"], STATES), *(f"{s}_pct" for s in STATES))


@query("A31_group_maximum", "SELECT area_id, cls, val, site_id FROM (SELECT *, row_number() OVER (PARTITION BY area_id, cls ORDER BY val DESC, site_id) AS k FROM sites) WHERE k = 1")
def _(t):
    return A.group_maximum(t.sites, ["area_id", "cls"], "val", ["site_id"]).select("area_id", "cls", "val", "site_id")


# --- windows over probabilities and scores


MEAN5, ENT = "(p0+p1+p2+p3+p4)/5", " + ".join(f"p{i} * ln(p{i} + 1e-9)" for i in range(5))


@query(
    "W3_top_classes",
    f"WITH l AS (SELECT vec_id, 0 AS k, p0 AS p FROM probs UNION ALL SELECT vec_id, 1, p1 FROM probs UNION ALL SELECT vec_id, 2, p2 FROM probs UNION ALL SELECT vec_id, 3, p3 FROM probs UNION ALL SELECT vec_id, 4, p4 FROM probs), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, k) AS n FROM l) "
    f"SELECT a.vec_id, a.k AS first, round(a.p, 5) AS p_first, b.k AS second, round(b.p, 5) AS p_second, round(-({ENT}), 5) AS entropy FROM r a JOIN r b ON a.vec_id = b.vec_id AND a.n = 1 AND b.n = 2 JOIN probs q ON q.vec_id = a.vec_id",
)
def _(t):
    top = t.probs.withColumns({"top": S.top_classes(F.array(*P5), 2), "entropy": F.round(S.entropy(F.array(*P5)), 5)})
    one, two = F.get("top", F.lit(0)), F.get("top", F.lit(1))
    return top.select("vec_id", one["klass"].alias("first"), F.round(one["p"], 5).alias("p_first"), two["klass"].alias("second"), F.round(two["p"], 5).alias("p_second"), "entropy")


@query(
    "W4_uncertainty",
    "SELECT vec_id, round(1 - greatest(p0,p1,p2,p3,p4), 5) AS least_sure, round(-(" + ENT + f"), 5) AS entropy, round((p0*p0+p1*p1+p2*p2+p3*p3+p4*p4)/5 - ({MEAN5})*({MEAN5}), 5) AS variance FROM probs",
)
def _(t):
    mean = F.expr(MEAN5)
    return t.probs.select(
        "vec_id", F.round(1 - F.greatest(*P5), 5).alias("least_sure"), F.round(S.entropy(F.array(*P5)), 5).alias("entropy"), F.round(F.expr("(p0*p0+p1*p1+p2*p2+p3*p3+p4*p4)/5") - mean * mean, 5).alias("variance")
    )


@query("W5_reliable_deviation", "WITH e AS (SELECT vec_id, 1 - greatest(p0,p1,p2,p3,p4) AS u FROM probs) SELECT vec_id FROM e WHERE u <= (SELECT avg(u) + stddev_pop(u) FROM e)")
def _(t):
    return S.reliable(t.probs.select("vec_id", (1 - F.greatest(*P5)).alias("u")), "u", "deviation").select("vec_id")


@query("W5_reliable_quartile", "WITH e AS (SELECT vec_id, 1 - greatest(p0,p1,p2,p3,p4) AS u FROM probs) SELECT vec_id FROM e WHERE u <= (SELECT quantile_cont(u, 0.75) FROM e)")
def _(t):
    return S.reliable(t.probs.select("vec_id", (1 - F.greatest(*P5)).alias("u")), "u", "quartile").select("vec_id")


@query("W7_rank_order", f"{G} SELECT DISTINCT grade, CAST(l_partkey % 10 AS INT) AS position FROM g")
def _(t):
    return S.ranked_by(graded(t).select("grade").distinct(), "grade", A.GRADES)


@query("W8_quantile_classes", "WITH q AS (SELECT quantile_cont(dem, 0.2) AS a, quantile_cont(dem, 0.4) AS b, quantile_cont(dem, 0.6) AS c2, quantile_cont(dem, 0.8) AS d FROM cells) SELECT r, c, CAST(dem >= a AS INT) + CAST(dem >= b AS INT) + CAST(dem >= c2 AS INT) + CAST(dem >= d AS INT) AS klass FROM cells, q")
def _(t):
    return S.quantile_classes(t.cells.select("r", "c", "dem"), "dem", [0.2, 0.4, 0.6, 0.8], "klass").drop("dem")


def stretch_sql(low: str, high: str, band: str = "dem") -> str:
    return f"WITH q AS (SELECT {low} AS lo, {high} AS hi FROM cells) SELECT r, c, CASE WHEN {band} IS NOT NULL THEN round(coalesce((greatest(least({band}, hi), lo) - lo) / nullif(hi - lo, 0), 0), 5) END AS {band} FROM cells, q"


@query("W9_percentile_normalise", stretch_sql("quantile_cont(dem, 0.01)", "quantile_cont(dem, 0.99)"))
def _(t):
    return rounded(S.stretch(t.cells.select("r", "c", "dem"), ["dem"]), "dem", digits=5)


@query("W10_minmax_normalise", stretch_sql("min(dem)", "max(dem)"))
def _(t):
    return rounded(S.scale_to_range(t.cells.select("r", "c", "dem"), ["dem"]), "dem", digits=5)
