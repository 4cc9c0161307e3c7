"""Membership, grading, soil rules and spectral indices."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamworks.functions import scoring as S
from loamworks.plans.registry import query
from loamworks.plans.reports import rounded

U = "l_orderkey, l_linenumber, l_partkey"
KEYS = U.split(", ")
BELL = "1 / (1 + {a} * (ph - {c}) * (ph - {c}))"


@query(
    "M1_membership",
    f"SELECT {U}, round(CASE WHEN thickness <= 10 THEN 1 WHEN thickness >= 45 THEN 0 ELSE 1.2 - 0.025 * thickness END, 5) AS falling, round(CASE WHEN ph <= 4.5 THEN 0 WHEN ph >= 8 THEN 1 ELSE {BELL.format(a=0.2, c=7)} END, 5) AS more, "
    f"round(CASE WHEN ph <= 4.5 OR ph >= 8.5 THEN 0 ELSE {BELL.format(a=0.4, c=6.5)} END, 5) AS best, round(CASE WHEN ph <= 5 THEN 1 WHEN ph >= 8.5 THEN 0 ELSE {BELL.format(a=0.3, c=5)} END, 5) AS less FROM units",
)
def _(t):
    ph = F.col("ph")
    found = t.units.select(
        *KEYS, S.negative_linear(F.col("thickness"), 10, 45, 0.025, 1.2).alias("falling"), S.upper_bound(ph, 4.5, 8, 0.2, 7).alias("more"), S.peak(ph, 4.5, 8.5, 0.4, 6.5).alias("best"), S.lower_bound(ph, 5, 8.5, 0.3, 5).alias("less")
    )
    return rounded(found, "falling", "more", "best", "less", digits=5)


LAND = {"水田": 1.0, "水浇地": 0.85}


@query("M2_concept", f"SELECT {U}, CAST(CASE land WHEN '水田' THEN 1.0 WHEN '水浇地' THEN 0.85 END AS DOUBLE) AS land_sub FROM units")
def _(t):
    return S.concept(t.units, "land", LAND, "land_sub").select(*KEYS, "land_sub")


@query("M2_unknown_categories", "SELECT land, count(*) AS n FROM units WHERE land NOT IN ('水田', '水浇地') GROUP BY 1")
def _(t):
    return S.unknown_categories(t.units, "land", LAND)


SCORE = "coalesce(CASE land WHEN '水田' THEN 1.0 WHEN '水浇地' THEN 0.85 END * 0.3, 0) + coalesce(thickness / 50 * 0.5, 0) + coalesce(organic / 8 * 0.2, 0)"


def composite(t):
    u = S.concept(t.units, "land", LAND, "land_sub").withColumns({"thickness_sub": F.col("thickness") / 50, "organic_sub": F.col("organic") / 8})
    return u.withColumn("score", S.composite({"land_sub": 0.3, "thickness_sub": 0.5, "organic_sub": 0.2}))


@query("M3_composite", f"SELECT {U}, round({SCORE}, 5) AS score FROM units")
def _(t):
    return rounded(composite(t).select(*KEYS, "score"), "score", digits=5)


EDGES = [("一等", 0.83, 1.01), ("二等", 0.61, 0.83), ("三等", 0.407, 0.61), ("四等", 0.203, 0.407)]
GRADED = f"SELECT *, round({SCORE}, 6) AS score FROM units"
CASE = "CASE " + " ".join(f"WHEN score >= {lo} AND score < {hi} THEN '{n}'" for n, lo, hi in EDGES) + " ELSE '未定义' END"


def graded(t):
    g = rounded(composite(t), "score", digits=6)
    return g.withColumn("grade", S.grade(F.col("score"), EDGES))


@query("M4_grade", f"WITH g AS ({GRADED}) SELECT {U}, {CASE} AS grade FROM g")
def _(t):
    return graded(t).select(*KEYS, "grade")


@query("M5_fit_yield")
def _(t):
    points = graded(t).filter("grade <> '未定义'").groupBy("grade").agg(F.avg("score").alias("x"), (1500 / (1 + 3 * (F.avg("score") - 0.9) * (F.avg("score") - 0.9))).alias("y"))
    a, b, c = S.fit_yield(points, "x", "y")
    return points.select("grade", F.round("x", 4).alias("x"), F.round("y", 2).alias("y"), F.round(b / (1 + a * (F.col("x") - c) ** 2), 2).alias("fitted"))


@query(
    "M6_production",
    f"WITH g AS ({GRADED}), h AS (SELECT *, {CASE} AS grade FROM g), m AS (SELECT min(m) AS lo, max(m) AS hi FROM (SELECT avg(score) AS m FROM h GROUP BY grade)), k AS (SELECT h.*, greatest(least(score, hi), lo) AS s FROM h, m) "
    f"SELECT {U}, round(1500 / (1 + 3 * (s - 0.95) * (s - 0.95)), 2) AS capacity, round(1500 / (1 + 3 * (s - 0.95) * (s - 0.95)) * area * 0.8 * 2, 1) AS annual_total FROM k",
)
def _(t):
    p = S.production(graded(t), "grade", "score", "area", 3.0, 1500.0, 0.95, 2, 0.8)
    return p.select(*KEYS, F.round("capacity", 2).alias("capacity"), F.round("annual_total", 1).alias("annual_total"))


@query("M7_natural_breaks")
def _(t):
    edges = S.natural_breaks(t.units, "thickness")
    return t.units.select(F.explode(F.array(*map(F.lit, edges))).alias("edge")).distinct()


@query("M8_coded", "SELECT r, c, CASE WHEN pos IN (1, 2) THEN '山地坡下' WHEN pos IN (3, 4) THEN '山地坡中' WHEN pos IN (5, 6) THEN '山地坡上' END AS position, CASE dz WHEN 1 THEN '不满足' WHEN 2 THEN '基本满足' WHEN 3 THEN '满足' WHEN 4 THEN '充分满足' END AS ability FROM cells")
def _(t):
    return t.cells.select("r", "c", S.coded(F.col("pos"), S.POSITION_CODES).alias("position"), S.coded(F.col("dz"), S.ABILITY_CODES).alias("ability"))


SOILS = ["黄壤", "黄棕壤", "石灰土", "潮土", "水稻土", "紫色土", "石灰(岩)土"]
TEXTURES = ["黏土", "壤质黏土", "砂质壤土", "壤土", "黏壤土", "砂质黏土"]
SOIL = "CASE l_partkey % 7 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SOILS)) + " END"
TEXTURE = "CASE l_suppkey % 6 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(TEXTURES)) + " END"
SOILED = f"WITH s AS (SELECT *, {SOIL} AS soil, {TEXTURE} AS texture FROM units)"


@query(
    "M9_profile_form",
    f"{SOILED} SELECT {U}, CASE WHEN land = '水田' THEN CASE WHEN soil = '水稻土' THEN '紧实型' WHEN texture IN ('黏土', '重黏土', '壤质黏土') THEN '上松下紧型' ELSE '海绵型' END "
    "WHEN soil IN ('黄壤', '黄棕壤') THEN CASE WHEN texture = '砂质壤土' THEN '松散型' WHEN texture IN ('黏壤土', '壤土') THEN '海绵型' ELSE '上松下紧型' END WHEN soil = '石灰土' THEN CASE WHEN texture IN ('黏土', '壤质黏土') THEN '夹层型' ELSE '薄层型' END "
    "WHEN soil = '潮土' THEN CASE WHEN texture IN ('砂质壤土', '壤土') THEN '上紧下松型' ELSE '海绵型' END ELSE '海绵型' END AS form FROM s",
)
def _(t):
    s = t.units.withColumns({"soil": F.expr(SOIL), "texture": F.expr(TEXTURE)})
    return s.select(*KEYS, S.profile_form(F.col("texture"), F.col("soil"), F.col("land")).alias("form"))


@query(
    "M10_effective_thickness",
    f"{SOILED}, a AS (SELECT *, greatest(25.0::DOUBLE, least(130.0::DOUBLE, CASE soil WHEN '紫色土' THEN 75 WHEN '石灰(岩)土' THEN 55 WHEN '黄壤' THEN 70 WHEN '黄棕壤' THEN 65 WHEN '水稻土' THEN 85 ELSE 65 END::DOUBLE * CASE position WHEN '山地坡上' THEN 0.7 WHEN '山地坡下' THEN 1.3 ELSE 1 END::DOUBLE * CASE land WHEN '水田' THEN 1.2 WHEN '水浇地' THEN 1.1 ELSE 0.9 END::DOUBLE)) AS t FROM s), "
    "b AS (SELECT *, CASE WHEN soil = '石灰(岩)土' AND position = '山地坡上' THEN greatest(25, t * 0.85::DOUBLE) WHEN soil = '紫色土' AND position = '山地坡下' AND land = '水田' THEN least(130, t * 1.15::DOUBLE) WHEN soil = '水稻土' AND land = '水田' THEN least(130, t * 1.2::DOUBLE) "
    "WHEN soil = '黄壤' AND position = '山地坡上' AND land = '旱地' THEN greatest(25, t * 0.9::DOUBLE) WHEN soil = '潮土' AND land IN ('水田', '水浇地') THEN least(130, t * 1.15::DOUBLE) ELSE t END AS t2 FROM a) "
    f"SELECT {U}, round(CASE WHEN soil = '潮土' AND position = '山地坡下' THEN least(130, t2 * 1.1::DOUBLE) ELSE t2 END, 1) AS cm FROM b",
)
def _(t):
    return t.units.select(*KEYS, S.effective_thickness(F.expr(SOIL), F.col("land"), F.col("position")).alias("cm"))


TEX = "WITH x AS (SELECT r, c, b2 AS sand, b3 AS silt, b4 AS clay FROM cells), n AS (SELECT r, c, 100 * sand / (sand + silt + clay) AS sand, 100 * silt / (sand + silt + clay) AS silt, 100 * clay / (sand + silt + clay) AS clay FROM x)"


@query(
    "M11_texture_class",
    f"{TEX} SELECT r, c, CASE WHEN clay >= 40 AND silt >= 40 THEN 'SiltyClay' WHEN clay >= 40 AND sand <= 45 THEN 'Clay' WHEN clay >= 40 THEN 'SandyClay' WHEN clay >= 27 AND silt < 28 AND sand > 45 THEN 'SandyClayLoam' WHEN clay >= 27 AND silt >= 28 AND silt < 40 THEN 'ClayLoam' "
    "WHEN clay >= 27 THEN 'SiltyClayLoam' WHEN clay >= 20 AND sand >= 52 THEN 'SandyClayLoam' WHEN clay >= 20 AND silt >= 50 THEN 'SiltyClayLoam' WHEN clay >= 20 THEN 'ClayLoam' WHEN silt >= 80 THEN 'Silt' WHEN silt >= 50 THEN 'SiltLoam' WHEN sand >= 85 THEN 'Sand' "
    "WHEN sand >= 70 THEN 'LoamySand' WHEN sand >= 52 THEN 'SandyLoam' ELSE 'Loam' END AS texture FROM n",
)
def _(t):
    return t.cells.select("r", "c", S.texture_class(F.col("b2"), F.col("b3"), F.col("b4")).alias("texture"))


TEX2 = "WITH x AS (SELECT r, c, b2 AS sand, (100 - b2) / 2 + (b3 % 7) / 10 - 0.3 AS silt, (100 - b2) / 2 AS clay FROM cells WHERE b2 <= 100)"


@query(
    "M12_texture_name",
    f"{TEX2}, m AS (SELECT *, CASE WHEN sand >= 55 AND sand <= 85 THEN '砂质' ELSE '' END AS m1, CASE WHEN silt > 45 THEN '粉质' ELSE '' END AS m2 FROM x) "
    "SELECT r, c, CASE WHEN NOT (sand + silt + clay >= 99.9 AND sand + silt + clay <= 100.1) THEN '输入无效：三个参数之和必须为100%' WHEN sand > 85 THEN '砂土及壤质砂土' ELSE concat(m1, m2, CASE WHEN clay > 25 AND clay < 45 AND m1 = '' AND m2 = '' THEN '壤质' ELSE '' END, "
    "CASE WHEN clay < 15 THEN '壤土' WHEN clay <= 25 THEN '黏壤土' WHEN clay <= 65 THEN '黏土' ELSE '重黏土' END) END AS texture FROM m",
)
def _(t):
    x = t.cells.filter("b2 <= 100").select("r", "c", F.col("b2").alias("sand"), F.expr("(100 - b2) / 2 + (b3 % 7) / 10 - 0.3D").alias("silt"), F.expr("(100 - b2) / 2").alias("clay"))
    return x.select("r", "c", S.texture_name(F.col("sand"), F.col("silt"), F.col("clay")).alias("texture"))


@query(
    "M13_profile_code",
    "SELECT r, c, CASE WHEN dz % 3 = pos % 3 THEN dz % 3 + 1 WHEN dl % 2 = 0 THEN dl % 5 + 1 ELSE 1 END AS code FROM cells",
)
def _(t):
    one = lambda e: F.array(F.expr(e))
    none = F.array().cast("array<int>")
    code = S.profile_code(one("dz % 3 + 1"), one("pos % 3 + 1"), F.when(F.col("dl") % 2 == 0, one("dl % 5 + 1")).otherwise(none))
    return t.cells.select("r", "c", code.alias("code"))


BAND = {"blue": "b2", "green": "b3", "red": "b4", "nir": "b8", "swir1": "b11", "swir2": "b12"}
RATIO = "coalesce(({0}) / nullif({1}, 0), 0)"
INDICES = {
    "ndvi": RATIO.format("b8 - b4", "b8 + b4"),
    "savi": RATIO.format("b8 - b4", "b8 + b4 + 0.5") + " * 1.5",
    "ndwi": RATIO.format("b3 - b8", "b3 + b8"),
    "evi": "2.5 * " + RATIO.format("b8 - b4", "b8 + 6 * b4 - 7.5 * b2 + 1"),
    "lswi": RATIO.format("b8 - b11", "b8 + b11"),
    "mndwi": RATIO.format("b3 - b11", "b3 + b11"),
    "ndmi": RATIO.format("b8 - b11", "b8 + b11"),
    "vari": RATIO.format("b3 - b4", "b3 + b4 - b2"),
    "clay": RATIO.format("b11 - b12", "b11 + b12"),
    "ferrous": RATIO.format("b8 - b11", "b8 + b11"),
    "carbonate": RATIO.format("b4 - b3", "b4 + b3"),
    "rock": RATIO.format("b11 - b3", "b11 + b12 + b3"),
}


def _register_indices():
    for name, sql in INDICES.items():
        query(f"M14_{name}", f"SELECT r, c, round({sql}, 5) + 0.0 AS {name} FROM cells")(
            lambda t, name=name: t.cells.select("r", "c", F.round(S.index(name, **{k: F.col(v) for k, v in BAND.items()}), 5).alias(name))
        )


_register_indices()


@query("M15_tame_extremes", "SELECT r, c, CASE WHEN b8 > 100 THEN (SELECT median(b8) FROM cells) ELSE b8 END AS b8 FROM cells")
def _(t):
    return S.tame_extremes(t.cells.select("r", "c", "b8"), ["b8"])


TREAT = "WITH s AS (SELECT avg(dem) AS m, stddev_pop(dem) AS d, median(dem) AS e FROM cells) SELECT r, c, round(CASE WHEN dem IS NOT NULL THEN {} END, 3) AS dem FROM cells, s"
OUT = "CASE WHEN dem < m - 1.2 * d OR dem > m + 1.2 * d THEN {} ELSE dem END"


def _register_treatments():
    for name, sql in {"truncate": "greatest(least(dem, m + 1.2 * d), m - 1.2 * d)", "mean": OUT.format("m"), "median": OUT.format("e")}.items():
        query(f"M16_{name}", TREAT.format(sql))(lambda t, name=name: rounded(S.treat_outliers(t.cells.select("r", "c", "dem"), "dem", 1.2, name), "dem", digits=3))


_register_treatments()


@query(
    "M17_wetness",
    "SELECT r, c, round(ln(b3 * 10 / tan(radians(greatest(b2 / 4, 0.001)))), 5) AS twi, round(ln((b3 + 1) * 10 / (sin(radians(b2 / 4)) + 0.001)), 5) AS wetness, round(pow(b3 * 10 / 22.13, 0.4) * pow(sin(radians(b2 / 4)) / 0.0896, 1.3), 5) AS ls FROM cells",
)
def _(t):
    slope, acc = F.col("b2") / 4, F.col("b3")
    return rounded(t.cells.select("r", "c", S.twi(acc * 10, slope).alias("twi"), S.wetness(acc, slope, 10.0).alias("wetness"), S.ls_factor(acc, slope, 10.0).alias("ls")), "twi", "wetness", "ls", digits=5)


POSW = lambda w: "CASE pos " + " ".join(f"WHEN {k} THEN {v}" for k, v in w.items()) + " END"
LEVEL = lambda e: "CAST(1 + CAST(s > {} AS INT) + CAST(s > {} AS INT) + CAST(s > {} AS INT) AS INT)".format(*e)
PUMP = "CASE WHEN h <= 0 THEN 1 WHEN h <= 20 THEN 0.9 WHEN h <= 50 THEN 0.7 * exp(-(h - 20) / 50) ELSE 0.3 * exp(-(h - 50) / 200) END"
INPUTS = "WITH i AS (SELECT r, c, pos, b2 / 100 AS water, dem - 1010 AS h, b4 / 3 AS slope, b11 / 100 AS wet, b12 / 100 AS rain, b3 * 30 AS dist FROM cells WHERE dem IS NOT NULL)"


def capability_inputs(t):
    e = {"pos": "pos", "water": "b2 / 100", "h": "dem - 1010", "slope": "b4 / 3", "wet": "b11 / 100", "rain": "b12 / 100", "dist": "b3 * 30"}
    return t.cells.filter("dem IS NOT NULL").select("r", "c", *(F.expr(v).alias(k) for k, v in e.items()))


@query(
    "M18_irrigation",
    f"{INPUTS}, x AS (SELECT r, c, greatest(0, least(1, water * 0.40 + {PUMP} * 0.15 + CASE WHEN slope <= 25 THEN 1 - slope / 25 ELSE 0 END * 0.15 + {POSW(S.IRRIGATION['position'])} * 0.12 + wet * 0.10 + rain * 0.08)) AS s FROM i) SELECT r, c, round(s, 4) AS score, {LEVEL(S.IRRIGATION['levels'])} AS level FROM x",
)
def _(t):
    s = S.irrigation_score(*(F.col(k) for k in ("water", "h", "slope", "pos", "wet", "rain")))
    return capability_inputs(t).withColumn("s", s).select("r", "c", F.round("s", 4).alias("score"), S.levels(F.col("s"), S.IRRIGATION["levels"]).alias("level"))


RIVER = "(CASE WHEN h < 0 THEN 0.1 WHEN h <= 2 THEN 0.2 WHEN h <= 5 THEN 0.4 WHEN h <= 15 THEN 0.7 + 0.3 * (h - 5) / 10 ELSE 0.8 * exp(-(h - 15) / 30) END * 0.45 + exp(-dist / 1000) * 0.35 + water * 0.2) * CASE WHEN h < 2 THEN 0.5 ELSE 1 END"
DSLOPE = "CASE WHEN slope < 1 THEN 0.3 * slope WHEN slope <= 8 THEN 0.3 + 0.7 * (slope - 1) / 7 WHEN slope <= 25 THEN 1 - 0.3 * (slope - 8) / 17 ELSE 0.7 * exp(-(slope - 25) / 10) END"


@query(
    "M19_drainage",
    f"{INPUTS}, x AS (SELECT r, c, greatest(0, least(1, {DSLOPE} * 0.30 + {POSW(S.DRAINAGE['position'])} * 0.25 + (1 - wet) * 0.15 + {RIVER} * 0.20 + (1 - rain) * 0.10)) AS s FROM i) SELECT r, c, round(s, 4) AS score, {LEVEL(S.DRAINAGE['levels'])} AS level FROM x",
)
def _(t):
    i = capability_inputs(t)
    river = S.river_influence(F.col("h"), F.col("dist"), F.col("water"))
    s = S.drainage_score(F.col("slope"), F.col("pos"), river, F.col("wet"), F.col("rain"))
    return i.withColumn("s", s).select("r", "c", F.round("s", 4).alias("score"), S.levels(F.col("s"), S.DRAINAGE["levels"]).alias("level"))


@query(
    "M20_weighted_classes",
    "WITH q AS (SELECT min(b2) AS a, max(b2) AS b, min(b3) AS d, max(b3) AS e FROM cells), s AS (SELECT r, c, 0.6 * ((b2 - a) / (b - a)) + 0.4 * ((b3 - d) / (e - d)) AS s FROM cells, q) SELECT r, c, CAST(1 + CAST(s > 0.25 AS INT) + CAST(s > 0.5 AS INT) + CAST(s > 0.75 AS INT) AS INT) AS level FROM s",
)
def _(t):
    n = S.scale_to_range(t.cells.select("r", "c", "b2", "b3"), ["b2", "b3"])
    return n.select("r", "c", S.levels(0.6 * F.col("b2") + 0.4 * F.col("b3"), (0.25, 0.5, 0.75)).alias("level"))


@query(
    "M21_shape_weight",
    "WITH z AS (SELECT zone_id, n_cells AS a, 2 * (x1 - x0 + y1 - y0) AS p FROM zones) SELECT zone_id, round(0.7 * (4 * pi() * a / (p * p)) + 0.3 * ln(1 + a) / ln(1 + (SELECT max(a) FROM z)), 5) AS weight FROM z",
)
def _(t):
    z = t.zones
    most = z.agg(F.max("n_cells").alias("_most"))
    w = S.shape_weight(F.col("n_cells"), 2 * (F.col("x1") - F.col("x0") + F.col("y1") - F.col("y0")), F.col("_most"))
    return z.crossJoin(F.broadcast(most)).select("zone_id", F.round(w, 5).alias("weight"))


@query("M22_vapour_pressure", "SELECT area_id, CAST(month AS DATE) AS month, round(avg(6.112 * exp(17.67 * (value % 40) / ((value % 40) + 243.5))), 4) AS pressure FROM climate GROUP BY 1, 2")
def _(t):
    c = t.climate.withColumn("p", S.vapour_pressure(F.col("value") % 40))
    return c.groupBy("area_id", F.to_date("month").alias("month")).agg(F.round(F.avg("p"), 4).alias("pressure"))


SCENES = " UNION ALL ".join(f"SELECT r, c, {v} AS v, CAST(({v} * {m}) % 4096 AS INT) AS qa, ({v} + r) % 100 AS cloud FROM cells" for v, m in (("b2", 37), ("b3", 41), ("b4", 43), ("b8", 47)))


@query("M23_clear_composite", f"WITH s AS ({SCENES}) SELECT r, c, median(v) AS v FROM s WHERE cloud < 80 AND (qa & 3072) = 0 GROUP BY 1, 2")
def _(t):
    scenes = None
    for v, m in (("b2", 37), ("b3", 41), ("b4", 43), ("b8", 47)):
        s = t.cells.select("r", "c", F.col(v).alias("v"), F.expr(f"cast(({v} * {m}) % 4096 as int)").alias("qa"), F.expr(f"({v} + r) % 100").alias("cloud"))
        scenes = s if scenes is None else scenes.unionByName(s)
    return S.clear_composite(scenes, "qa", "cloud", 80, ["v"])


@query("M24_products", "SELECT r, c, b2 * b3 AS b2_x_b3, b2 * b4 AS b2_x_b4, b3 * b4 AS b3_x_b4 FROM cells")
def _(t):
    return t.cells.select("r", "c", *(v.alias(k) for k, v in S.products(["b2", "b3", "b4"]).items()))


@query("M25_harmonise_names", f"WITH d AS (SELECT ts, concat('类', min(tz)) AS name FROM units WHERE l_partkey % 2 = 0 GROUP BY 1) SELECT {U}, coalesce(name, u.ts) AS name FROM units u LEFT JOIN d ON u.ts = d.ts")
def _(t):
    from loamworks.operators.cleaning import look_up

    u = t.units
    d = u.filter("l_partkey % 2 = 0").groupBy("ts").agg(F.concat(F.lit("类"), F.min("tz")).alias("name"))
    return look_up(u, F.col("ts"), d, "ts", "name", "found").select(*KEYS, F.coalesce("found", "ts").alias("name"))


@query(
    "M26_erosion_by_slope",
    "SELECT pos, round(avg(b2) * (1 + pos / 10) / (1 + stddev_pop(b3)), 5) AS erosion, round(avg(b4 / (b4 + b2)), 5) AS weathering FROM cells GROUP BY 1",
)
def _(t):
    g = t.cells.groupBy("pos").agg(F.avg("b2").alias("m"), F.stddev_pop("b3").alias("s"), F.avg(F.col("b4") / (F.col("b4") + F.col("b2"))).alias("w"))
    return g.select("pos", F.round(F.expr("m * (1 + pos / 10) / (1 + s)"), 5).alias("erosion"), F.round("w", 5).alias("weathering"))


@query(
    "M27_colour_balance",
    "WITH q AS (SELECT quantile_cont(b2, 0.02) AS lo, quantile_cont(b2, 0.98) AS hi FROM cells) SELECT r, c, round((greatest(least(b2, hi), lo) - lo) / (hi - lo) * 255, 3) AS b2 FROM cells, q",
)
def _(t):
    return rounded(S.stretch(t.cells.select("r", "c", "b2"), ["b2"], 0.02, 0.98, 255.0), "b2", digits=3)
