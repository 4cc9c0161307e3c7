"""Neighbourhood operators on the cell grid; their twins join every cell with its neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamworks.functions import scoring as S
from loamworks.operators import aggregates as A
from loamworks.operators import grid as G
from loamworks.operators import joins as J
from loamworks.plans.registry import query
from loamworks.plans.reports import rounded

NEAR = "cells a JOIN cells n ON n.r BETWEEN a.r - {k} AND a.r + {k} AND n.c BETWEEN a.c - {k} AND a.c + {k}"
BOX = "SELECT a.r, a.c, {} FROM " + NEAR + " GROUP BY a.r, a.c, a.dem"


def box(k, what):
    return BOX.format(what, k=k)


FOCAL = box(2, "round(avg(n.dem), 4) AS focal_mean, round(stddev_pop(n.dem), 3) AS focal_std, count(n.dem) AS focal_n")


@query("S6_flatten_bands", "SELECT r, c, dem, b2, b3 FROM cells")
def _(t):
    return G.wide_form(G.long_form(t.cells, ["dem", "b2", "b3"]), ["dem", "b2", "b3"])


@query("S7_split_bands", "SELECT r, c, 'b2' AS band, b2 AS value FROM cells UNION ALL SELECT r, c, 'b3', b3 FROM cells UNION ALL SELECT r, c, 'dem', dem FROM cells")
def _(t):
    return G.long_form(t.cells, ["b2", "b3", "dem"])


@query("F1_focal_statistics", FOCAL)
def _(t):
    f = G.focal_statistics(t.cells.select("r", "c", "dem"), "dem", 2).select("r", "c", "focal_mean", "focal_std", F.col("focal_n").cast("long").alias("focal_n"))
    return rounded(rounded(f, "focal_mean"), "focal_std", digits=3)


@query("F2_focal_extremes", box(2, "min(n.dem) AS least, max(n.dem) AS most, max(n.dem) - min(n.dem) AS relief"))
def _(t):
    c = t.cells.select("r", "c", "dem")
    return G.relief(G.focal_extreme(G.focal_extreme(c, "dem", 2, "min", "least"), "dem", 2, "max", "most"), "dem", 2).drop("dem")


@query("F3_tpi", box(3, "round(a.dem - avg(n.dem), 4) + 0.0 AS tpi, round(100 * (a.dem - avg(n.dem)) / avg(n.dem), 4) + 0.0 AS ratio"))
def _(t):
    c = G.tpi(G.tpi(t.cells.select("r", "c", "dem"), "dem", 3), "dem", 3, True, "ratio")
    return rounded(c.drop("dem"), "tpi", "ratio").withColumns({"tpi": F.col("tpi") + 0.0, "ratio": F.col("ratio") + 0.0})


# Horn's gradients from the eight neighbours; null where one is missing
AT = ", ".join(f"max(CASE WHEN n.r = a.r + ({dr}) AND n.c = a.c + ({dc}) THEN n.{{b}} END) AS n{i}" for i, (dr, dc) in enumerate(G.AROUND))
HOOD = "h AS (SELECT a.r, a.c, any_value(a.{b}) AS z, " + AT + " FROM " + NEAR.format(k=1) + " GROUP BY a.r, a.c)"
HORN = "WITH " + HOOD.format(b="dem") + ", g AS (SELECT *, CASE WHEN z IS NOT NULL THEN ((n7+2*n0+n1)-(n5+2*n4+n3))/80 END AS gx, CASE WHEN z IS NOT NULL THEN ((n3+2*n2+n1)-(n5+2*n6+n7))/80 END AS gy FROM h)"
SLOPE = "degrees(atan(sqrt(gx*gx+gy*gy)))"
ASPECT = "CASE WHEN gx = 0 AND gy = 0 THEN -1 ELSE (450 - degrees(atan2(gy, -gx))) % 360 END"


def sloped(t):
    return G.slope_aspect(t.cells.select("r", "c", "dem"), "dem", 10.0)


@query("F6_slope_aspect", f"{HORN} SELECT r, c, round({SLOPE}, 4) AS slope, round({ASPECT}, 3) AS aspect FROM g")
def _(t):
    return rounded(rounded(sloped(t).drop("dem"), "slope"), "aspect", digits=3)


@query("F6_gradient_slope", f"WITH {HOOD.format(b='dem')} SELECT r, c, round(CASE WHEN z IS NOT NULL THEN degrees(atan(sqrt(pow((n0-n4)/20, 2) + pow((n2-n6)/20, 2)))) END, 4) AS slope FROM h")
def _(t):
    return rounded(G.gradient_slope(t.cells.select("r", "c", "dem"), "dem", 10.0).drop("dem"), "slope")


CLASS = "CASE WHEN t > s THEN 6 WHEN t > 0.5*s AND t <= s THEN 5 WHEN t > -0.5*s AND t < 0.5*s AND slope > 5 THEN 4 WHEN t > -0.5*s AND t < 0.5*s AND slope <= 5 THEN 3 WHEN t > -s AND t <= -0.5*s THEN 2 WHEN t < -s THEN 1 END"


@query(
    "F4_slope_position",
    f"{HORN}, f AS ({box(2, 'round(a.dem - avg(n.dem), 4) AS t, round(stddev_pop(n.dem), 3) AS s')}), x AS (SELECT f.r, f.c, t, s, round({SLOPE}, 4) AS slope FROM f JOIN g ON f.r = g.r AND f.c = g.c) SELECT r, c, {CLASS} AS klass FROM x",
)
def _(t):
    f = G.focal_statistics(sloped(t), "dem", 2)
    return f.select("r", "c", G.slope_position(F.round(F.col("dem") - F.col("focal_mean"), 4), F.round("focal_std", 3), F.round("slope", 4)).alias("klass"))


BANDOF = "CASE WHEN {0} <= -1 THEN 0 WHEN {0} < 1 THEN 1 WHEN {0} >= 1 THEN 2 END"


@query(
    "F5_landform",
    f"WITH x AS (SELECT r, c, {BANDOF.format('b2 / 30 - 1.5')} AS s, {BANDOF.format('b3 / 30 - 1.5')} AS l, b4 / 10 AS slope FROM cells) "
    "SELECT r, c, CAST(CASE WHEN s = 0 THEN l + 1 WHEN s = 1 AND l = 0 THEN 4 WHEN s = 1 AND l = 1 AND slope <= 5 THEN 5 WHEN s = 1 AND l = 1 THEN 6 WHEN s = 1 THEN 7 WHEN s = 2 THEN l + 8 ELSE 11 END AS INT) AS form FROM x",
)
def _(t):
    return t.cells.select("r", "c", G.landform(F.col("b2") / 30 - 1.5, F.col("b3") / 30 - 1.5, F.col("b4") / 10).alias("form"))


@query(
    "F5_landform_by_aspect",
    "WITH x AS (SELECT r, c, b2 / 20 - 2.5 AS t, b3 / 4 AS slope, b4 * 3.6 AS a FROM cells) SELECT r, c, CASE WHEN t > -0.5 AND t < 0.5 AND slope < 6 THEN 1 WHEN t > 1 AND slope < 24 AND slope > 6 THEN 2 WHEN t > 1 AND slope < 6 THEN 4 "
    "WHEN t > -0.5 AND t < 0.5 AND slope < 24 AND slope > 6 AND a > 135 AND a < 315 THEN 6 WHEN t < -0.5 AND slope < 24 AND slope > 6 AND a > 135 AND a < 315 THEN 8 WHEN t < -0.5 AND slope < 6 THEN 11 ELSE 12 END AS form FROM x",
)
def _(t):
    return t.cells.select("r", "c", G.landform_by_aspect(F.col("b2") / 20 - 2.5, F.col("b3") / 4, F.col("b4") * 3.6).alias("form"))


CURVE = f"WITH {HOOD.format(b='dem')}, d AS (SELECT r, c, ((n0+n4)/2-z) AS d, ((n2+n6)/2-z) AS e, (n1+n5-n3-n7)/4 AS f, (n0-n4)/2 AS g, (n2-n6)/2 AS h FROM h)"


@query(
    "F7_curvature",
    f"{CURVE} SELECT r, c, round(-200*(d+e), 3) + 0.0 AS curvature, round(CASE WHEN g*g+h*h = 0 THEN 0 ELSE -200*(d*g*g+e*h*h+f*g*h)/(g*g+h*h) END, 3) + 0.0 AS profile, round(CASE WHEN g*g+h*h = 0 THEN 0 ELSE 200*(d*h*h+e*g*g-f*g*h)/(g*g+h*h) END, 3) + 0.0 AS plan FROM d",
)
def _(t):
    c = rounded(G.curvature(t.cells.select("r", "c", "dem"), "dem").drop("dem"), "curvature", "profile", "plan", digits=3)
    return c.withColumns({k: F.col(k) + 0.0 for k in ("curvature", "profile", "plan")})


SQ = " + ".join(f"coalesce((n{i}-z)*(n{i}-z), 0)" for i in range(8))


@query("F7_ruggedness", f"WITH {HOOD.format(b='dem')} SELECT r, c, round(CASE WHEN z IS NOT NULL THEN sqrt({SQ}) END, 4) AS ruggedness FROM h")
def _(t):
    return rounded(G.ruggedness(t.cells.select("r", "c", "dem"), "dem").drop("dem"), "ruggedness")


TURN = " + ".join(f"abs((n{i} - {(90 + 45 * i + 180) % 360} + 540) % 360 - 180)" for i in range(8))


@query("F8_convergence", f"WITH {HOOD.format(b='b2')} SELECT r, c, round(90 - ({TURN}) / 8, 4) AS convergence FROM h")
def _(t):
    return rounded(G.convergence(t.cells.select("r", "c", "b2"), "b2").drop("b2"), "convergence")


@query("F8_relative_position", box(2, "round((a.dem - min(n.dem)) / nullif(max(n.dem) - min(n.dem), 0), 5) AS position"))
def _(t):
    return rounded(G.relative_position(t.cells.select("r", "c", "dem"), "dem", 2).drop("dem"), "position", digits=5)


WATER = "v AS (SELECT r, c FROM cells WHERE water = 1), d AS (SELECT a.r, a.c, min((a.r-v.r)*(a.r-v.r)+(a.c-v.c)*(a.c-v.c)) AS d2 FROM cells a JOIN v ON abs(a.r-v.r) <= 6 AND abs(a.c-v.c) <= 6 WHERE (a.r-v.r)*(a.r-v.r)+(a.c-v.c)*(a.c-v.c) <= 36 GROUP BY 1, 2)"


def watered(t):
    return G.distance(t.cells.select("r", "c", "water"), F.col("water") == 1, 6)


@query("F9_distance", "WITH v AS (SELECT r, c FROM cells WHERE water = 1) SELECT a.r, a.c, round(sqrt(min((a.r-v.r)*(a.r-v.r)+(a.c-v.c)*(a.c-v.c))), 4) AS distance, round(exp(-sqrt(min((a.r-v.r)*(a.r-v.r)+(a.c-v.c)*(a.c-v.c))) / 3), 5) AS decay FROM cells a LEFT JOIN v ON true GROUP BY 1, 2")
def _(t):
    d = G.distance(t.cells.select("r", "c", "water"), F.col("water") == 1)
    return d.select("r", "c", F.round("distance", 4).alias("distance"), F.round(F.exp(-F.col("distance") / 3), 5).alias("decay"))


@query("F9_distance_cut", f"WITH {WATER} SELECT a.r, a.c, round(sqrt(d2), 4) AS distance, round(exp(-sqrt(d2) / 3), 5) AS decay FROM cells a LEFT JOIN d ON a.r = d.r AND a.c = d.c")
def _(t):
    return watered(t).select("r", "c", F.round("distance", 4).alias("distance"), F.round(F.exp(-F.col("distance") / 3), 5).alias("decay"))


GAUSS = "exp(-0.5 * (n.{a}-a.{a})*(n.{a}-a.{a}))"


@query(
    "F10_gaussian_density",
    f"WITH p AS (SELECT a.r, a.c, sum(n.water * {GAUSS.format(a='r')} * {GAUSS.format(a='c')}) AS m FROM {NEAR.format(k=4)} GROUP BY 1, 2) SELECT r, c, round(m / (SELECT max(m) FROM p), 5) AS density FROM p",
)
def _(t):
    return rounded(G.gaussian_density(t.cells.select("r", "c", "water"), F.col("water") == 1, 1.0).drop("water"), "density", digits=5)


@query("F11_fill_gaps", f"WITH m AS ({box(1, 'coalesce(a.dem, avg(n.dem), (SELECT avg(dem) FROM cells)) AS dem')}) SELECT r, c, round(dem, 4) AS dem FROM m")
def _(t):
    return rounded(G.fill_gaps(t.cells.select("r", "c", "dem"), "dem"), "dem")


REPAIR = {"mean": "avg(n.b8)", "median": "median(n.b8)", "idw": "sum(n.b8 / sqrt((a.r-n.r)*(a.r-n.r)+(a.c-n.c)*(a.c-n.c))) / sum(1 / sqrt((a.r-n.r)*(a.r-n.r)+(a.c-n.c)*(a.c-n.c)))"}


def _register_repairs():
    for name, stat in REPAIR.items():
        sql = f"WITH f AS (SELECT a.r, a.c, {stat} AS v FROM {NEAR.format(k=1)} AND (n.r <> a.r OR n.c <> a.c) AND n.b8 BETWEEN 5 AND 110 WHERE NOT a.b8 BETWEEN 5 AND 110 GROUP BY 1, 2) SELECT cells.r, cells.c, round(coalesce(f.v, b8), 4) AS b8 FROM cells LEFT JOIN f ON cells.r = f.r AND cells.c = f.c"
        query(f"F12_repair_{name}", sql)(lambda t, name=name: rounded(G.repair_outliers(t.cells.select("r", "c", "b8"), "b8", 5.0, 110.0, 1, name), "b8"))


_register_repairs()


@query(
    "F13_consistency",
    "WITH g AS (SELECT 'all' AS grid, min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1, count(*) AS n FROM cells UNION ALL SELECT 'cut', min(r), max(r), min(c), max(c), count(*) FROM cells WHERE c < 90 UNION ALL SELECT 'same', min(r), max(r), min(c), max(c), count(*) FROM cells) "
    "SELECT g.*, CASE WHEN (g.r0, g.r1, g.c0, g.c1, g.n) = (a.r0, a.r1, a.c0, a.c1, a.n) THEN 1 ELSE 0 END AS same FROM g, g a WHERE a.grid = 'all'",
)
def _(t):
    return G.consistency({"all": t.cells, "cut": t.cells.filter("c < 90"), "same": t.cells}, "all")


@query("F14_coordinates", "SELECT r, c, round(105.0 + (c + 0.5) * 0.01, 6) AS x, round(27.0 - (r + 0.5) * 0.01, 6) AS y FROM cells")
def _(t):
    return rounded(G.with_coordinates(t.cells.select("r", "c"), 105.0, 27.0, 0.01), "x", "y", digits=6)


NEW = "e AS (SELECT max(r) AS r1, max(c) AS c1 FROM cells), t AS (SELECT CAST(i AS INT) AS r, CAST(j AS INT) AS c FROM e, range(0, 100000) x(i), range(0, 1000) y(j) WHERE i < floor((r1 + 1) / 2.5) AND j < floor((c1 + 1) / 2.5))"


@query("F15_resample_nearest", f"WITH {NEW} SELECT t.r, t.c, b2 FROM t LEFT JOIN cells s ON s.r = CAST(floor((t.r + 0.5) * 2.5) AS INT) AND s.c = CAST(floor((t.c + 0.5) * 2.5) AS INT)")
def _(t):
    return G.resample_nearest(t.cells, "b2", 2.5)


@query(
    "F15_resample_bilinear",
    f"WITH {NEW}, q AS (SELECT r, c, (r + 0.5) * 2.5 - 0.5 AS y, (c + 0.5) * 2.5 - 0.5 AS x FROM t), w AS (SELECT q.r, q.c, (1 - abs(y - floor(y) - i)) * (1 - abs(x - floor(x) - j)) AS w, s.dem FROM q CROSS JOIN (VALUES (0), (1)) di(i) CROSS JOIN (VALUES (0), (1)) dj(j) "
    "LEFT JOIN cells s ON s.r = CAST(floor(y) AS INT) + i AND s.c = CAST(floor(x) AS INT) + j) SELECT r, c, round(CASE WHEN count(*) FILTER (WHERE dem IS NULL AND w > 0) = 0 THEN sum(dem * w) END, 4) AS dem FROM w GROUP BY 1, 2",
)
def _(t):
    return rounded(G.resample_bilinear(t.cells, "dem", 2.5), "dem")


@query(
    "F16_fine_into_coarse",
    "WITH f AS (SELECT r, c, b3 FROM cells WHERE r BETWEEN 3 AND 40 AND c BETWEEN 10 AND 60), i AS (SELECT a.r, a.c, any_value(a.b3) AS b3 FROM f a JOIN f n ON abs(a.r-n.r) <= 2 AND abs(a.c-n.c) <= 2 GROUP BY 1, 2 HAVING count(n.b3) = 25) SELECT s.r, s.c, coalesce(i.b3, s.b2) AS b FROM cells s LEFT JOIN i ON s.r = i.r AND s.c = i.c",
)
def _(t):
    fine = t.cells.filter("r BETWEEN 3 AND 40 AND c BETWEEN 10 AND 60").select("r", "c", F.col("b3").alias("b"))
    return G.fine_into_coarse(t.cells.select("r", "c", F.col("b2").alias("b")), fine, "b", 2)


@query("F17_clip", "SELECT r, c, dem FROM cells WHERE zone_id IN (SELECT zone_id FROM zones WHERE dl = 3)")
def _(t):
    return G.clip(t.cells, t.cells.join(t.zones.filter("dl = 3").select("zone_id"), "zone_id", "left_semi")).select("r", "c", "dem")


EXT = "SELECT a.r, a.c, {f}(n.{b}) AS v FROM {src} a JOIN {src} n ON abs(a.r-n.r) <= 1 AND abs(a.c-n.c) <= 1 GROUP BY 1, 2"


def ext(f, src="cells", b="b2"):
    return EXT.format(f=f, b=b, src=src)


MORPH = {
    "dilate": f"WITH x AS ({ext('max')}) SELECT r, c, v AS b2 FROM x",
    "erode": f"WITH x AS ({ext('min')}) SELECT r, c, v AS b2 FROM x",
    "open": f"WITH x AS ({ext('min')}), y AS ({ext('max', 'x', 'v')}) SELECT r, c, v AS b2 FROM y",
    "close": f"WITH x AS ({ext('max')}), y AS ({ext('min', 'x', 'v')}) SELECT r, c, v AS b2 FROM y",
    "gradient": f"WITH x AS ({ext('max')}), y AS ({ext('min')}) SELECT x.r, x.c, x.v - y.v AS b2 FROM x JOIN y ON x.r = y.r AND x.c = y.c",
    "tophat": f"WITH x AS ({ext('min')}), y AS ({ext('max', 'x', 'v')}) SELECT s.r, s.c, b2 - v AS b2 FROM cells s JOIN y ON s.r = y.r AND s.c = y.c",
    "bottomhat": f"WITH x AS ({ext('max')}), y AS ({ext('min', 'x', 'v')}) SELECT s.r, s.c, v - b2 AS b2 FROM cells s JOIN y ON s.r = y.r AND s.c = y.c",
    "edge": f"WITH x AS ({ext('min')}) SELECT s.r, s.c, b2 - v AS b2 FROM cells s JOIN x ON s.r = x.r AND s.c = x.c",
}


def _register_morphology():
    for name, sql in MORPH.items():
        query(f"F18_{name}", sql)(lambda t, name=name: G.morphology(t.cells.select("r", "c", "b2"), "b2", name))


_register_morphology()


@query(
    "F19_majority_filter",
    "WITH m AS (SELECT r, c, CASE WHEN (r * 7 + c * 3) % 5 < 3 THEN 1 ELSE 2 END AS v FROM cells), k AS (SELECT a.r, a.c, n.v, count(*) AS k FROM m a JOIN m n ON abs(a.r-n.r) <= 1 AND abs(a.c-n.c) <= 1 AND (a.r <> n.r OR a.c <> n.c) GROUP BY 1, 2, 3 HAVING count(*) >= 5) SELECT m.r, m.c, coalesce(k.v, m.v) AS v FROM m LEFT JOIN k ON m.r = k.r AND m.c = k.c",
)
def _(t):
    return G.majority_filter(t.cells.select("r", "c", F.expr("CASE WHEN (r * 7 + c * 3) % 5 < 3 THEN 1 ELSE 2 END").alias("v")), "v")


@query("F22_threshold_clean", "SELECT r, c, CASE WHEN b8 <= 10 OR b8 >= 110 THEN -9999 ELSE b8 END AS b8 FROM cells")
def _(t):
    return t.cells.select("r", "c", G.threshold_clean(F.col("b8"), 10, 110, -9999.0).alias("b8"))


@query("F23_rasterise_zones", "SELECT s.r, s.c, z.dl AS code FROM cells s LEFT JOIN zones z ON s.c + 0.5 > x0 AND s.c + 0.5 < x1 AND s.r + 0.5 > y0 AND s.r + 0.5 < y1")
def _(t):
    centres = t.cells.select("r", "c", (F.col("c") + 0.5).alias("x"), (F.col("r") + 0.5).alias("y"))
    z = t.zones.withColumn("ring", J.box_ring("x0", "y0", "x1", "y1"))
    return J.points_in_polygons(centres, z, 10.0).select("r", "c", F.col("dl").alias("code"))


@query(
    "F24_texture",
    "WITH q AS (SELECT min(b2) AS lo, max(b2) AS hi FROM cells), g AS (SELECT r, c, CAST(floor((b2 - lo) / (hi - lo) * 255) AS INT) AS g FROM cells, q), p AS (SELECT a.r, a.c, a.g AS a, n.g AS b, n.g - a.g AS d FROM g a JOIN g n ON n.r = a.r + 1 AND n.c = a.c + 1), w AS (SELECT g.r, g.c, a, b, d FROM g JOIN p ON p.r BETWEEN g.r - 1 AND g.r AND p.c BETWEEN g.c - 1 AND g.c), "
    "e AS (SELECT r, c, sqrt(sum(n * n)) / sum(n) AS energy FROM (SELECT r, c, a, b, count(*) AS n FROM w GROUP BY 1, 2, 3, 4) q GROUP BY 1, 2), s AS (SELECT r, c, avg(d * d) AS contrast, avg(abs(d)) AS dissimilarity, avg(1.0::DOUBLE / (1 + d * d)) AS homogeneity, count(*) AS k, sum(a) AS sa, sum(b) AS sb, count(*) * sum(a * a) - sum(a) * sum(a) AS va, count(*) * sum(b * b) - sum(b) * sum(b) AS vb, sum(a * b) AS ab FROM w GROUP BY 1, 2) "
    "SELECT s.r, s.c, round(contrast, 4) AS contrast, round(dissimilarity, 4) AS dissimilarity, round(homogeneity, 5) AS homogeneity, round(energy, 5) AS energy, round(CASE WHEN va = 0 OR vb = 0 THEN 1 ELSE (k * ab - sa * sb) / sqrt(CAST(va AS DOUBLE) * CAST(vb AS DOUBLE)) END, 5) + 0.0 AS correlation FROM s JOIN e ON s.r = e.r AND s.c = e.c",
)
def _(t):
    return rounded(rounded(G.texture(t.cells, "b2"), "contrast", "dissimilarity"), "homogeneity", "energy", "correlation", digits=5).withColumn("correlation", F.col("correlation") + 0.0)


@query(
    "F25_object_features",
    "SELECT zone_id, round(avg(b4), 4) AS b4_mean, round(stddev_pop(b4), 4) AS b4_std, round(avg(b3), 4) AS b3_mean, round(stddev_pop(b3), 4) AS b3_std, round(avg(2 * b3 - b4 - b2), 4) AS exg, round(avg(coalesce((b3 - b4) / nullif(b3 + b4 - b2, 0), 0)), 4) AS vari, round(avg(greatest(b2, b3, b4)), 4) AS brightness, "
    "round(avg(hue), 3) AS hue, round(avg(saturation), 5) AS saturation, round(avg(dg * dg), 3) AS contrast FROM (SELECT s.*, n.b3 - s.b3 AS dg, coalesce((greatest(s.b2, s.b3, s.b4) - least(s.b2, s.b3, s.b4)) / nullif(greatest(s.b2, s.b3, s.b4), 0), 0) AS saturation, "
    "CASE WHEN greatest(s.b2, s.b3, s.b4) = least(s.b2, s.b3, s.b4) THEN 0 WHEN s.b4 >= s.b3 AND s.b4 >= s.b2 THEN (360 + 60 * (s.b3 - s.b2) / (s.b4 - least(s.b2, s.b3))) % 360 WHEN s.b3 >= s.b2 THEN 120 + 60 * (s.b2 - s.b4) / (s.b3 - least(s.b2, s.b4)) ELSE 240 + 60 * (s.b4 - s.b3) / (s.b2 - least(s.b3, s.b4)) END AS hue "
    "FROM cells s LEFT JOIN cells n ON n.r = s.r + 1 AND n.c = s.c + 1 AND n.zone_id = s.zone_id) q GROUP BY 1",
)
def _(t):
    c = t.cells.withColumns({"exg": F.expr("2 * b3 - b4 - b2"), "vari": S.index("vari", blue=F.col("b2"), green=F.col("b3"), red=F.col("b4")), "brightness": F.greatest("b2", "b3", "b4")} | S.hue_saturation(F.col("b4"), F.col("b3"), F.col("b2")))
    # an object's texture: squared differences of diagonal neighbours that both lie in it
    n = G.neighbours(c.select("r", "c", F.struct("zone_id", "b3").alias("_z")), "_z").select("r", "c", F.when(F.col("n1.zone_id") == F.col("_z.zone_id"), (F.col("n1.b3") - F.col("_z.b3")) ** 2).alias("contrast"))
    singles = ("exg", "vari", "brightness", "hue", "saturation", "contrast")
    z = A.zonal(c.join(n, ["r", "c"]), "zone_id", {"b4": ["mean", "std"], "b3": ["mean", "std"]} | {x: ["mean"] for x in singles})
    z = z.withColumnsRenamed({f"{x}_mean": x for x in singles})
    fine = {"hue": 3, "saturation": 5, "contrast": 3}
    for x, digits in fine.items():
        z = rounded(z, x, digits=digits)
    return rounded(z, *(x for x in z.columns if x not in ("zone_id", *fine)))


@query(
    "F27_alluvial",
    f"{HORN}, f AS ({box(1, 'max(n.dem) - min(n.dem) AS relief')}), {WATER} SELECT g.r, g.c, CASE WHEN coalesce(round({SLOPE}, 4) < 30, false) AND coalesce(sqrt(d2) <= 4, false) AND coalesce(relief < 22, false) THEN 1 ELSE 0 END AS alluvial FROM g JOIN f ON g.r = f.r AND g.c = f.c LEFT JOIN d ON g.r = d.r AND g.c = d.c",
)
def _(t):
    s = G.relief(sloped(t), "dem", 1)
    d = watered(t).select("r", "c", "distance")
    yes = F.coalesce((F.round("slope", 4) < 30) & (F.col("distance") <= 4) & (F.col("relief") < 22), F.lit(False))
    return s.join(d, ["r", "c"]).select("r", "c", yes.cast("int").alias("alluvial"))


SUNS = [(100.0, 20.0), (140.0, 45.0), (180.0, 60.0), (220.0, 45.0), (260.0, 20.0)]
SHADE = " + ".join(
    f"greatest(0, 255 * (cos(radians({90 - alt})) * cos(s) + sin(radians({90 - alt})) * sin(s) * cos(radians({az}) - a)))" for az, alt in SUNS
)


@query("F28_hillshade", f"WITH x AS (SELECT r, c, radians(b2 / 4) AS s, radians(b3 * 3.5) AS a FROM cells) SELECT r, c, round(({SHADE}) / 5, 3) AS shade FROM x")
def _(t):
    return t.cells.select("r", "c", F.round(G.hillshade(F.col("b2") / 4, F.col("b3") * 3.5, SUNS), 3).alias("shade"))


@query(
    "F29_resize",
    "WITH e AS (SELECT max(r) - 4 AS nr, max(c) + 21 AS nc FROM cells), x AS (SELECT unnest(range(0, nr)) AS i FROM e), y AS (SELECT unnest(range(0, nc)) AS j FROM e) SELECT CAST(i AS INT) AS r, CAST(j AS INT) AS c, coalesce(dem, -1) AS dem FROM x CROSS JOIN y LEFT JOIN cells ON r = i AND c = j",
)
def _(t):
    # a reference that is five rows shorter and twenty columns wider
    rows, columns = t.cells.agg(F.max("r") - 4, F.max("c") + 21).first()
    return G.resize(t.cells, "dem", rows, columns, -1.0)


@query(
    "F30_low_pass",
    "WITH one AS (SELECT a.r, a.c, CASE WHEN a.dem IS NOT NULL THEN avg(n.dem) END AS v FROM " + NEAR.format(k=1) + " GROUP BY a.r, a.c, a.dem), two AS (SELECT a.r, a.c, CASE WHEN a.v IS NOT NULL THEN avg(n.v) END AS v FROM one a JOIN one n ON abs(a.r-n.r) <= 1 AND abs(a.c-n.c) <= 1 GROUP BY a.r, a.c, a.v) SELECT r, c, round(v, 6) AS dem FROM two",
)
def _(t):
    return rounded(G.low_pass(t.cells.select("r", "c", "dem"), "dem", 2), "dem", digits=6)


@query("F31_across_bands", "SELECT r, c, round((b2 + b3 + b4 + b8 + b11 + b12) / 6, 4) AS mean, greatest(b2, b3, b4, b8, b11, b12) - least(b2, b3, b4, b8, b11, b12) AS range FROM cells")
def _(t):
    return rounded(t.cells.select("r", "c", *(v.alias(k) for k, v in G.across_bands(["b2", "b3", "b4", "b8", "b11", "b12"]).items())), "mean")
