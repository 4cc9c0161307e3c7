"""Outliers, sampling, balancing, features and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamworks.operators import folds as V
from loamworks.operators import joins as J
from loamworks.operators import models as L
from loamworks.operators import sampling as B
from loamworks.plans.registry import query
from loamworks.plans.reports import rounded

D2 = "(a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)"


@query(
    "B1_outlier_status",
    f"WITH v AS (SELECT * FROM sites WHERE val IS NOT NULL), g AS (SELECT avg(val) AS m, stddev_pop(val) AS s, count(*) AS n FROM v), p AS (SELECT a.site_id, b.val, row_number() OVER (PARTITION BY a.site_id ORDER BY {D2}, b.site_id) AS k FROM v a JOIN v b ON a.site_id <> b.site_id), "
    "l AS (SELECT site_id, avg(val) AS m, stddev_pop(val) AS s FROM p WHERE k <= 8 GROUP BY 1) SELECT v.site_id, CASE WHEN g.n < 9 THEN 'Normal' WHEN val > g.m + 1.5 * g.s THEN 'GlobalHighOutlier' WHEN val < g.m - 1.5 * g.s THEN 'GlobalLowOutlier' "
    "WHEN val > l.m + 2 * l.s THEN 'LocalHighOutlier' WHEN val < l.m - 2 * l.s THEN 'LocalLowOutlier' ELSE 'Normal' END AS status FROM v JOIN l ON v.site_id = l.site_id, g",
)
def _(t):
    return B.outlier_status(t.sites, "site_id", "val", None, 1.5, 2.0).select("site_id", "status")


@query("B2_radius_outliers", f"SELECT a.site_id, CASE WHEN count(*) > 1 AND abs(any_value(a.val) - avg(b.val)) > 1.5 * stddev_pop(b.val) THEN 1 ELSE 0 END AS outlier FROM sites a JOIN sites b ON {D2} <= 36 GROUP BY 1")
def _(t):
    return B.radius_outliers(t.sites, "site_id", "val", 6.0, 1.5).select("site_id", "outlier")


@query(
    "B3_point_net",
    "WITH e AS (SELECT CAST(floor(max(x1) / 3) AS INT) AS nx, CAST(floor(max(y1) / 3) AS INT) AS ny FROM zones), u AS (SELECT unnest(range(0, nx)) AS i FROM e), v AS (SELECT unnest(range(0, ny)) AS j FROM e) "
    "SELECT (i + 0.5) * 3 AS x, (j + 0.5) * 3 AS y, zone_id FROM u CROSS JOIN v JOIN zones ON (i + 0.5) * 3 >= x0 AND (i + 0.5) * 3 < x1 AND (j + 0.5) * 3 >= y0 AND (j + 0.5) * 3 < y1",
)
def _(t):
    z = t.zones.withColumn("ring", J.box_ring("x0", "y0", "x1", "y1"))
    return B.point_net(3.0, z, 10.0).select("x", "y", "zone_id")


@query(
    "B4_similar_members",
    "WITH u AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), c AS (SELECT label, list_dot_product(e, e) AS d, vec_id, e FROM u), p AS (SELECT DISTINCT a.vec_id, a.label FROM c a JOIN c b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) / sqrt(a.d * b.d) > 0.8), "
    "r AS (SELECT * FROM c WHERE label NOT IN (SELECT label FROM p)), s AS (SELECT a.vec_id, a.label, sum(list_dot_product(a.e, b.e) / sqrt(a.d * b.d)) AS s FROM r a JOIN r b ON a.label = b.label GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY s DESC, vec_id) AS k, count(*) OVER (PARTITION BY label) AS n FROM s) "
    "SELECT vec_id, label FROM p UNION ALL SELECT vec_id, label FROM k WHERE k <= 0.75 * n",
)
def _(t):
    e = t.embeddings.select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    return B.similar_members(e, "vec_id", "e", "label")


FEATURES = ["b2", "b3", "b4", "b8"]


@query(
    "B5_modal_bin_rows",
    "WITH l AS (" + " UNION ALL ".join(f"SELECT r * 1000 + c AS id, dz, '{f}' AS f, {f} AS v FROM cells" for f in FEATURES) + "), b AS (SELECT *, CAST(least(floor(coalesce((v - min(v) OVER w) / nullif(max(v) OVER w - min(v) OVER w, 0), 0) * 6), 5) AS INT) AS bin FROM l WINDOW w AS (PARTITION BY dz, f)), "
    "n AS (SELECT dz, f, bin, row_number() OVER (PARTITION BY dz, f ORDER BY count(*) DESC, bin) AS k FROM b GROUP BY 1, 2, 3) SELECT id, b.dz, count(*) AS hits FROM b JOIN n ON b.dz = n.dz AND b.f = n.f AND b.bin = n.bin AND k = 1 GROUP BY 1, 2 HAVING count(*) >= 2",
)
def _(t):
    c = t.cells.select((F.col("r") * 1000 + F.col("c")).alias("id"), "dz", *FEATURES)
    return B.modal_bin_rows(c, "id", "dz", FEATURES, 6, 2)


@query(
    "B6_nearest_to_centre",
    "WITH m AS (SELECT dz, avg(b2) AS m2, avg(b3) AS m3 FROM cells GROUP BY 1), d AS (SELECT r * 1000 + c AS id, cells.dz, sqrt((b2-m2)*(b2-m2)+(b3-m3)*(b3-m3)) AS distance FROM cells JOIN m ON cells.dz = m.dz), q AS (SELECT dz, quantile_cont(distance, 0.2) AS cut FROM d GROUP BY 1) SELECT id, d.dz, round(distance, 4) AS distance FROM d JOIN q ON d.dz = q.dz WHERE distance <= cut",
)
def _(t):
    c = t.cells.select((F.col("r") * 1000 + F.col("c")).alias("id"), "dz", "b2", "b3")
    return rounded(B.nearest_to_centre(c, "id", "dz", ["b2", "b3"]), "distance")


def keyed(t):
    return t.cells.select((F.col("r") * 1000 + F.col("c")).alias("id"), "dz", *FEATURES, F.col("c").cast("double").alias("x"), F.col("r").cast("double").alias("y"))


@query("B7_density_downsample")
def _(t):
    s = t.sites.select("site_id", "cls", "x", "y", "ph", "val").withColumnsRenamed({"x": "sx", "y": "sy"})
    return B.density_downsample(s, "site_id", "cls", ["sx", "sy", "ph"], 50).select("site_id", "cls")


@query(
    "B7_density_weights",
    f"WITH n AS (SELECT a.site_id, sqrt({D2}) AS d, row_number() OVER (PARTITION BY a.site_id ORDER BY {D2}, b.site_id) AS k FROM sites a JOIN sites b ON a.cls = b.cls AND a.site_id <> b.site_id) "
    "SELECT s.site_id, coalesce(round(max(d), 5), 0) AS weight FROM sites s LEFT JOIN n ON n.site_id = s.site_id AND k <= 5 GROUP BY 1",
)
def _(t):
    return rounded(B.density_weights(t.sites, "site_id", "cls", ["x", "y"], 5), "weight", digits=5)


TARGETS = "WITH n AS (SELECT dz, count(*) AS n FROM cells GROUP BY 1), t AS (SELECT dz, n, CAST(CASE WHEN n <= 1000 THEN n WHEN n > 1700 THEN 1200 ELSE least(n, floor((n + 1200) / 2)) END AS BIGINT) AS goal FROM n)"


@query("B8_class_targets", f"{TARGETS} SELECT * FROM t")
def _(t):
    return B.class_targets(t.cells, "dz", 1200, 1000, 1700)


@query("B8_balance", f"{TARGETS} SELECT id, dz FROM (SELECT r * 1000 + c AS id, dz, row_number() OVER (PARTITION BY dz ORDER BY (r * 7919 + c * 104729) % 10007, r * 1000 + c) AS k FROM cells) q JOIN t USING (dz) WHERE k <= goal")
def _(t):
    c = t.cells.select("r", "c", (F.col("r") * 1000 + F.col("c")).alias("id"), "dz")
    return B.balance(c, "dz", B.class_targets(c, "dz", 1200, 1000, 1700), [F.expr("(r * 7919 + c * 104729) % 10007"), "id"]).select("id", "dz")


@query(
    "B9_copy_small_groups",
    "WITH n AS (SELECT layer, flag, count(*) AS n FROM samples GROUP BY 1, 2), m AS (SELECT layer, flag, n, CAST(greatest(1, ceil(5000.0 / n)) AS INT) AS k FROM n) SELECT layer, flag, copy, n FROM m, (SELECT CAST(i AS INT) AS copy FROM range(1, 1000) u(i)) q WHERE copy <= k",
)
def _(t):
    return B.copy_small_groups(t.samples, ["layer", "flag"], 5000).groupBy("layer", "flag", "copy").agg(F.count("*").alias("n"))


@query("B9_resample_small_groups")
def _(t):
    return B.resample_small_groups(t.samples, ["layer", "flag"], 5000, ["site_id", "lab_id", "run_id", "ord"]).groupBy("layer", "flag").agg(F.count("*").alias("n"))


@query("B10_drop_small_classes", "WITH n AS (SELECT lab_id FROM samples GROUP BY 1 HAVING count(*) >= 30) SELECT site_id, layer, lab_id FROM samples WHERE lab_id IN (SELECT lab_id FROM n) AND lab_id NOT IN (1, 2)")
def _(t):
    return B.drop_small_classes(t.samples, "lab_id", 30, [1, 2]).select("site_id", "layer", "lab_id")


@query("B11_interpolate")
def _(t):
    return B.interpolate(t.sites, "site_id", "cls", ["x", "y", "ph"], 3, 2)


@query("B11_interpolate_counts", "SELECT cls, 2 * count(*) AS n, true AS inside FROM sites GROUP BY 1 HAVING count(*) > 1")
def _(t):
    made = B.interpolate(t.sites, "site_id", "cls", ["x", "y", "ph"], 3, 2)
    span = t.sites.groupBy("cls").agg(F.min("ph").alias("lo"), F.max("ph").alias("hi"))
    return made.join(span, "cls").groupBy("cls").agg(F.count("*").alias("n"), F.every(F.col("ph").between(F.col("lo") - 1e-9, F.col("hi") + 1e-9)).alias("inside"))


@query("B11_interpolate_apart")
def _(t):
    return B.interpolate(t.sites, "site_id", "cls", ["x", "y", "ph"], 3, 2, apart=0.2)


RANGED = "WITH s AS (SELECT cls, min(ph) AS lo, max(ph) AS hi, count(*) AS n FROM sites GROUP BY 1) "


@query("B11_uniform_samples", RANGED + "SELECT cls, 40 AS n, true AS inside FROM s")
def _(t):
    made = B.uniform_samples(t.sites, "cls", ["x", "y", "ph"], 40)
    span = t.sites.groupBy("cls").agg(F.min("ph").alias("lo"), F.max("ph").alias("hi"))
    return made.join(span, "cls").groupBy("cls").agg(F.count("*").cast("int").alias("n"), F.every(F.col("ph").between(F.col("lo"), F.col("hi"))).alias("inside"))


@query("B11_samples_around")
def _(t):
    return B.samples_around(t.sites, "site_id", "cls", ["x", "y", "ph"], 0.05, 3, apart=0.01)


@query("B12_count_parameters", "WITH n AS (SELECT dl, count(*) AS n FROM cells GROUP BY 1) SELECT quantile_cont(n, 0.25) AS low, quantile_cont(n, 0.5) AS target, quantile_cont(n, 0.75) AS high, max(n) AS most, count(*) AS classes FROM n")
def _(t):
    return B.count_parameters(t.cells, "dl")


@query(
    "B13_density_features",
    f"WITH c AS (SELECT CAST(floor(x / 10) AS INT) AS i, CAST(floor(y / 10) AS INT) AS j, count(*) AS n FROM sites GROUP BY 1, 2), p AS (SELECT a.site_id, sqrt({D2}) AS d, row_number() OVER (PARTITION BY a.site_id ORDER BY {D2}, b.site_id) AS k FROM sites a JOIN sites b ON a.site_id <> b.site_id), "
    "l AS (SELECT site_id, 1 / avg(d) AS density FROM p WHERE k <= 4 GROUP BY 1) SELECT s.site_id, n AS cell_n, round(density, 5) AS density FROM sites s JOIN c ON i = CAST(floor(x / 10) AS INT) AND j = CAST(floor(y / 10) AS INT) LEFT JOIN l ON l.site_id = s.site_id",
)
def _(t):
    return rounded(B.density_features(t.sites, "site_id", 10.0).select("site_id", "cell_n", "density"), "density", digits=5)


@query(
    "B14_density_clusters",
    f"WITH RECURSIVE p AS (SELECT a.site_id AS a, b.site_id AS b, {D2} AS d2 FROM sites a JOIN sites b ON {D2} <= 4), k AS (SELECT a FROM p GROUP BY 1 HAVING count(*) >= 3), e AS (SELECT a, b FROM p WHERE a IN (SELECT a FROM k) AND b IN (SELECT a FROM k)), "
    "walk AS (SELECT a AS node, a AS pt FROM k UNION SELECT walk.node, e.b FROM walk JOIN e ON e.a = walk.pt), lab AS (SELECT node, min(pt) AS label FROM walk GROUP BY 1), "
    "n AS (SELECT p.a, label, row_number() OVER (PARTITION BY p.a ORDER BY d2, p.b) AS q FROM p JOIN lab ON lab.node = p.b) SELECT s.site_id, n.label AS cluster FROM sites s LEFT JOIN n ON n.a = s.site_id AND q = 1",
)
def _(t):
    return B.density_clusters(t.sites, "site_id", 2.0, 3).select("site_id", "cluster")


@query(
    "B15_local_outlier_factor",
    f"WITH n AS (SELECT * FROM (SELECT a.site_id AS a, b.site_id AS b, sqrt({D2}) AS d, row_number() OVER (PARTITION BY a.site_id ORDER BY {D2}, b.site_id) AS k FROM sites a JOIN sites b ON a.site_id <> b.site_id) q WHERE k <= 5), kd AS (SELECT a, max(d) AS kd FROM n GROUP BY 1), "
    "lrd AS (SELECT n.a, 1 / avg(greatest(d, kd.kd)) AS lrd FROM n JOIN kd ON kd.a = n.b GROUP BY 1), m AS (SELECT n.a, avg(o.lrd) AS m FROM n JOIN lrd o ON o.a = n.b GROUP BY 1) SELECT m.a AS site_id, round(m / lrd, 4) AS lof FROM m JOIN lrd ON lrd.a = m.a",
)
def _(t):
    return rounded(B.local_outlier_factor(t.sites, "site_id", 5).select("site_id", "lof"), "lof")


@query("B16_clusters_elbow")
def _(t):
    found = L.clusters(t.cells, ["b2", "b3", "b4"], list(range(2, 21)))
    best = L.elbow([(k, c) for k, c, _ in found])
    return t.spark.createDataFrame([(k, c, s, k == best) for k, c, s in found], "k int, cost double, silhouette double, elbow boolean")


@query("B17_representatives")
def _(t):
    return L.representatives(keyed(t), "id", "dz", ["b2", "b3"], 4, settled="settled")


@query("B18_hash_split")
def _(t):
    return B.hash_split(keyed(t), "id", 0.2).groupBy("part").agg(F.count("*").alias("n"))


# --- features and models


@query("L1_standardise", "SELECT r, c, round((dem - (SELECT avg(dem) FROM cells)) / (SELECT stddev_pop(dem) FROM cells), 5) AS dem, round((b2 - (SELECT avg(b2) FROM cells)) / (SELECT stddev_pop(b2) FROM cells), 5) AS b2 FROM cells")
def _(t):
    return rounded(L.standardise(t.cells.select("r", "c", "dem", "b2"), ["dem", "b2"]), "dem", "b2", digits=5)


@query("L1_robust_scale", "WITH q AS (SELECT quantile_cont(dem, 0.25) AS a, median(dem) AS m, quantile_cont(dem, 0.75) AS b FROM cells) SELECT r, c, round((dem - m) / (b - a), 5) AS dem FROM cells, q")
def _(t):
    return rounded(L.robust_scale(t.cells.select("r", "c", "dem"), ["dem"]), "dem", digits=5)


@query("L2_label_encoding", "WITH m AS (SELECT land, CAST(dense_rank() OVER (ORDER BY land) - 1 AS INT) AS label FROM (SELECT DISTINCT land FROM units)) SELECT land, label, count(*) AS n FROM units JOIN m USING (land) GROUP BY 1, 2")
def _(t):
    coded, mapping = L.encode_labels(t.units.select("land"), "land")
    return coded.groupBy("label").agg(F.count("*").alias("n")).join(mapping, "label")


@query("L2_one_hot", "SELECT site_id, CASE WHEN cls = 'BUILDING' THEN 1 ELSE 0 END AS \"cls_BUILDING\", CASE WHEN cls = 'MACHINERY' THEN 1 ELSE 0 END AS \"cls_MACHINERY\" FROM sites")
def _(t):
    return L.one_hot(t.sites.select("site_id", "cls"), "cls", ["BUILDING", "MACHINERY"]).drop("cls")


COV = ["b2", "b3", "b4"]


@query("L3_covariances", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(covar_pop({a}, {b}), 4) AS value FROM cells" for i, a in enumerate(COV) for b in COV[i:]))
def _(t):
    return rounded(L.covariances(t.cells, COV), "value")


@query("L3_principal_axes")
def _(t):
    p = L.principal_axes(keyed(t), FEATURES, 2)
    return p.select("id", F.round(F.abs(F.get("pc", F.lit(0))), 4).alias("pc1"), F.round(F.abs(F.get("pc", F.lit(1))), 4).alias("pc2"))


@query("L4_correlations", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS value FROM cells" for i, a in enumerate(COV) for b in COV[i + 1 :]))
def _(t):
    return rounded(L.correlations(t.cells, COV), "value", digits=6)


@query("L4_label_correlation", " UNION ALL ".join(f"SELECT '{a}' AS a, 'dl' AS b, round(corr({a}, dl), 6) AS value FROM cells" for a in COV))
def _(t):
    return rounded(L.correlations(t.cells, COV, "dl"), "value", digits=6)


MI = (
    "WITH q AS (SELECT min({f}) AS lo, max({f}) AS hi FROM cells), n AS (SELECT least(floor(({f} - lo) / (hi - lo) * 8), 7) AS x, dz AS y, count(*) AS n FROM cells, q GROUP BY 1, 2), p AS (SELECT x, y, n / sum(n) OVER () AS p FROM n), m AS (SELECT p, sum(p) OVER (PARTITION BY x) AS px, sum(p) OVER (PARTITION BY y) AS py FROM p) "
    "SELECT '{f}' AS feature, round(sum(p * ln(p / (px * py))), 6) AS score FROM m"
)


@query("L4_mutual_information", MI.format(f="b2"))
def _(t):
    return rounded(L.mutual_information(t.cells, "b2", "dz", 8), "score", digits=6)


RANKED = ["b2", "b3", "b4", "b8", "b11", "b12"]


@query("L4_feature_ranking", "SELECT feature, score, row_number() OVER (ORDER BY score DESC, feature) AS rank FROM (" + " UNION ALL ".join(f"SELECT * FROM ({MI.format(f=f)}) q" for f in RANKED) + ") u")
def _(t):
    return rounded(L.mutual_information_ranking(t.cells, RANKED, "dz", 8, digits=6), "score", digits=6)


SITE_FEATURES = ["x", "y", "val"]


def sites_ml(t):
    return t.sites.withColumns({"val": F.col("val").cast("double"), "ph2": F.col("ph") * F.col("x") / 10, "cls_i": (F.col("area_id") % 3).cast("double")})


@query("L5_forest_search")
def _(t):
    best, error = L.search(sites_ml(t), SITE_FEATURES, "ph2", "site_id", tries=3)
    return t.spark.createDataFrame([(best["trees"], best["depth"], error)], "trees int, depth int, rmse double")


@query("L6_feature_elimination")
def _(t):
    s = L.eliminate_features(sites_ml(t), SITE_FEATURES, "ph2", "site_id", 1)
    return t.spark.createDataFrame([(n, e, ",".join(f)) for n, e, f in s], "n int, rmse double, features string")


@query("L5_cross_validated_search")
def _(t):
    return rounded(V.search_folds(sites_ml(t), SITE_FEATURES, "ph2", "site_id", trees=(2, 4, 8), depths=(2, 3, 4)), "rmse", "spread", "r2")


@query("L6_cross_validated_elimination")
def _(t):
    s = V.eliminate_by_folds(sites_ml(t), SITE_FEATURES, "ph2", "site_id", folds=5, trees=4, depth=3)
    return t.spark.createDataFrame([(n, e, ",".join(f), c) for n, e, f, c in s], "n int, rmse double, features string, chosen boolean")


@query("L7_importances")
def _(t):
    s = sites_ml(t)
    return L.importances(L.forest(s, SITE_FEATURES, "ph2", 8, 4), SITE_FEATURES, s)


@query("L8_per_label")
def _(t):
    return L.per_label(sites_ml(t), SITE_FEATURES, ["ph", "ph2"], "site_id")


#: Eighteen soil properties of a site, each following place and acidity in its own measure.
PROPERTIES = {f"property_{i}": f"ph * {1 + i % 3} + x * {i % 5} / 10 + sin(y / {i + 2})" for i in range(18)}


@query("L8_eighteen_properties")
def _(t):
    wide = sites_ml(t).withColumns({name: F.expr(rule) for name, rule in PROPERTIES.items()})
    return rounded(V.scores_per_label(wide, SITE_FEATURES, list(PROPERTIES), "site_id", folds=3, trees=3, depth=4), "rmse", "r2")


@query("L9_segmented_models")
def _(t):
    s = sites_ml(t).withColumn("segment", F.when(F.col("x") > 50, "east").otherwise("west"))
    return L.segmented(s, "segment", SITE_FEATURES, "cls_i").groupBy("segment", "prediction").agg(F.count("*").alias("n"))


@query("L10_grid_inference")
def _(t):
    model = L.forest(t.cells, ["b2", "b3", "dem"], "b4", 6, 4)
    return L.predict(model, t.cells, ["b2", "b3", "dem"]).select("r", "c", F.round("prediction", 4).alias("prediction"))


@query("L11_tree_spread")
def _(t):
    model = L.forest(t.cells, ["b2", "b3"], "b4", 6, 4)
    return rounded(L.tree_spread(model, t.cells, ["b2", "b3"]).select("r", "c", "mean", "std", "low", "high"), "mean", "std", "low", "high")


@query(
    "L12_variogram",
    f"WITH p AS (SELECT sqrt({D2}) AS d, (a.ph-b.ph)*(a.ph-b.ph)/2 AS g FROM sites a JOIN sites b ON a.site_id < b.site_id AND {D2} <= 100) SELECT CAST(least(floor(d / 2), 4) AS INT) AS bin, count(*) AS n, round(avg(d), 4) AS distance, round(avg(g), 4) AS gamma FROM p GROUP BY 1",
)
def _(t):
    return rounded(L.variogram(t.sites, "site_id", "ph", 10.0, 5), "distance", "gamma")


IDW = "1 / greatest(d2, 1e-12)"


@query(
    "L12_inverse_distance",
    f"WITH p AS (SELECT a.site_id, b.ph, {D2} AS d2, row_number() OVER (PARTITION BY a.site_id ORDER BY {D2}, b.site_id) AS k FROM sites a JOIN sites b ON a.site_id <> b.site_id), "
    f"w AS (SELECT site_id, sum({IDW} * ph) / sum({IDW}) AS idw FROM p WHERE k <= 8 GROUP BY 1) SELECT q.site_id, round(idw, 4) AS idw FROM sites q LEFT JOIN w ON q.site_id = w.site_id",
)
def _(t):
    s = t.sites.select(F.col("site_id").alias("s_id"), "x", "y", "ph")
    return rounded(L.inverse_distance(t.sites.select("site_id", "x", "y"), s, "site_id", "s_id", "ph", other=True).select("site_id", "idw"), "idw")


@query("L12_kriging")
def _(t):
    s = t.sites.select(F.col("site_id").alias("s_id"), "x", "y", "ph")
    return rounded(L.kriging(t.sites.select("site_id", "x", "y"), s, "site_id", "s_id", "ph", None, 2.0, 5.0, other=True).select("site_id", "kriged"), "kriged")


@query("L12_kriging_variance")
def _(t):
    s = t.sites.select(F.col("site_id").alias("s_id"), "x", "y", "ph")
    law = L.fit_variogram(L.variogram(t.sites, "site_id", "ph", 10.0, 10))
    found = L.kriging(t.sites.select("site_id", "x", "y"), s, "site_id", "s_id", "ph", None, law.sill, law.scale, law.nugget, other=True, model=law.model, variance="variance")
    return rounded(found.select("site_id", "kriged", "variance"), "kriged", "variance")


@query("L12_best_predictions")
def _(t):
    s = sites_ml(t)
    return rounded(L.best_predictions(s, s, SITE_FEATURES, "ph2", "site_id", 10.0), "prediction", "variance")


@query("L12_regression_kriging")
def _(t):
    return L.regression_kriging(sites_ml(t), SITE_FEATURES, "ph2", "site_id", 10.0)


@query("L13_boosted")
def _(t):
    s = sites_ml(t)
    return L.predict(L.boosted(s, SITE_FEATURES, "ph2", 5), s, SITE_FEATURES).select("site_id", F.round("prediction", 4).alias("prediction"))


@query("L13_quantile_band")
def _(t):
    # bounds are learned from the training part of the sites, and given for all
    s = B.hash_split(sites_ml(t), "site_id", 0.3)
    found = L.quantile_band(s.filter("part = 'train'"), s, SITE_FEATURES, "ph2", rounds=6)
    return rounded(found.select("site_id", "part", "ph2", "low", "high"), "ph2", "low", "high")


@query("L14_tree_rules")
def _(t):
    s = sites_ml(t)
    rules = [r.strip() for r in L.tree_rules(s, SITE_FEATURES, "cls_i").split("\n") if r.strip()]
    return t.spark.createDataFrame(list(enumerate(rules)), "line int, rule string")


@query("L15_two_models")
def _(t):
    train = t.cells.withColumn("k", (F.col("dz") % 3).cast("double"))
    one, two = (L.forest(train, ["b2", "b3"], "k", n, 4, classify=True) for n in (4, 6))
    return L.two_models(one, two, t.cells, ["b2", "b3"], F.col("water") == 1).select("r", "c", "merged", "agree")


@query("L16_retrain")
def _(t):
    s = sites_ml(t)
    model, data = L.retrain(s.filter("site_id % 2 = 0"), s.filter("site_id % 2 = 1"), SITE_FEATURES, "ph2")
    return L.predict(model, s, SITE_FEATURES).select("site_id", F.round("prediction", 4).alias("prediction"))


@query(
    "G12_lagged_regression",
    "WITH z AS (SELECT zone_id, avg(b2) AS v, avg(b3) AS w FROM cells GROUP BY 1), l AS (SELECT DISTINCT a.zone_id AS s, n.zone_id AS d FROM cells a JOIN cells n ON n.r BETWEEN a.r - 1 AND a.r + 1 AND n.c BETWEEN a.c - 1 AND a.c + 1 WHERE a.zone_id <> n.zone_id), "
    "x AS (SELECT z.zone_id, any_value(z.v) AS y, any_value(z.w) AS w, avg(n.v) AS lag FROM z JOIN l ON l.s = z.zone_id JOIN z n ON n.zone_id = l.d GROUP BY 1), "
    "c AS (SELECT var_pop(lag) AS aa, var_pop(w) AS bb, covar_pop(lag, w) AS ab, covar_pop(lag, y) AS ay, covar_pop(w, y) AS b_y, avg(lag) AS ma, avg(w) AS mb, avg(y) AS my FROM x), k AS (SELECT (bb * ay - ab * b_y) / (aa * bb - ab * ab) AS ka, (aa * b_y - ab * ay) / (aa * bb - ab * ab) AS kb, ma, mb, my FROM c) "
    "SELECT 'lag' AS term, round(ka, 5) AS coefficient FROM k UNION ALL SELECT 'w', round(kb, 5) FROM k UNION ALL SELECT 'intercept', round(my - ka * ma - kb * mb, 5) FROM k",
)
def _(t):
    from loamworks.operators import graph as P

    z = t.cells.groupBy("zone_id").agg(F.avg("b2").alias("v"), F.avg("b3").alias("w"))
    lagged = P.spatial_lag(z, P.contiguity(t.cells, "zone_id"), "zone_id", "v").filter("lag is not null")
    return rounded(L.lagged_regression(lagged, ["lag", "w"], "v"), "coefficient", digits=5)
