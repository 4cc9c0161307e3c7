"""Membership functions, rules and scores as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamworks.operators.quantiles import medians, quantiles

UNDEFINED = "未定义"


def _bell(v: Column, a: float, c: float) -> Column:
    return 1 / (1 + a * (v - c) * (v - c))


def negative_linear(v: Column, low: float, high: float, a: float, b: float) -> Column:
    """1 up to ``low``, 0 from ``high``, b - a v between."""
    return F.when(v <= low, 1.0).when(v >= high, 0.0).otherwise(b - a * v)


def upper_bound(v: Column, low: float, high: float, a: float, c: float) -> Column:
    """More is better: 0 up to ``low``, 1 from ``high``, a bell's rise between."""
    return F.when(v <= low, 0.0).when(v >= high, 1.0).otherwise(_bell(v, a, c))


def peak(v: Column, low: float, high: float, a: float, c: float) -> Column:
    """Best at ``c``, 0 at both bounds and beyond."""
    return F.when((v <= low) | (v >= high), 0.0).otherwise(_bell(v, a, c))


def lower_bound(v: Column, low: float, high: float, a: float, c: float) -> Column:
    """Less is better: 1 up to ``low``, 0 from ``high``."""
    return F.when(v <= low, 1.0).when(v >= high, 0.0).otherwise(_bell(v, a, c))


def concept(df: DataFrame, column: str, scores: dict[str, float], into: str) -> DataFrame:
    """The score of a category from a small rule table; unknown categories give null."""
    table = df.sparkSession.createDataFrame(list(scores.items()), f"`{column}` string, `{into}` double")
    return df.join(F.broadcast(table), column, "left")


def unknown_categories(df: DataFrame, column: str, scores: dict[str, float]) -> DataFrame:
    """Categories that the rule table lacks, with their counts."""
    return df.filter(~F.coalesce(F.col(column).isin(list(scores)), F.lit(False))).groupBy(column).agg(F.count("*").alias("n"))


def composite(weights: dict[str, float]) -> Column:
    """Weighted sum in which null terms count as 0."""
    terms = [F.coalesce(F.col(c) * w, F.lit(0.0)) for c, w in weights.items()]
    return sum(terms[1:], terms[0])


def grade(value: Column, edges: list[tuple[str, float, float]]) -> Column:
    """The name of the half-open interval [low, high) that holds the value."""
    out = None
    for name, low, high in edges:
        test = (value >= low) & (value < high)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(UNDEFINED)


def fit_yield(points: DataFrame, score: str, yields: str, rounds: int = 30, most: float | None = None) -> tuple[float, float, float]:
    """(a, b, c) of b / (1 + a (x - c)^2) by damped Gauss-Newton steps; b is the greatest yield.

    Each step is one aggregate of a few sums over the points, whatever their number.
    """
    x, y = F.col(score), F.col(yields)
    b = float(most if most is not None else points.agg(F.max(y)).first()[0])
    start = points.filter(y < b).select(x.alias("x"), F.sqrt(b / y - 1).alias("r"))
    top = points.filter(y >= b).agg(F.avg(x)).first()[0]
    c = float(top if top is not None else points.agg(F.max(x)).first()[0])
    s = start.agg(F.sum(F.abs(F.col("x") - c) * F.col("r")), F.sum((F.col("x") - c) ** 2)).first()
    root = (s[0] / s[1]) if s[1] else 1.0
    a = max(root * root, 1e-9)

    def loss(a: float, c: float) -> float:
        e = y - b / (1 + a * (x - c) * (x - c))
        return float(points.agg(F.sum(e * e)).first()[0])

    now, damp = loss(a, c), 1e-3
    for _ in range(rounds):
        d = x - c
        f = 1 + a * d * d
        e, ja, jc = y - b / f, -b * d * d / (f * f), 2 * a * b * d / (f * f)
        aa, cc, ac, ra, rc = points.agg(*(F.sum(v) for v in (ja * ja, jc * jc, ja * jc, ja * e, jc * e))).first()
        aa, cc = aa * (1 + damp), cc * (1 + damp)
        det = aa * cc - ac * ac
        if not det:
            break
        na, nc = a + (cc * ra - ac * rc) / det, c + (aa * rc - ac * ra) / det
        new = loss(na, nc) if na > 0 else math.inf
        if new < now:
            done = now - new < 1e-12 * max(1.0, now)
            a, c, now, damp = na, nc, new, damp / 5
            if done:
                break
        else:
            damp *= 10
    return a, b, c


def production(df: DataFrame, grade: str, score: str, area: str, a: float, b: float, c: float, seasons: int, ratio: float) -> DataFrame:
    """Capacity of each row from its score, held between the least and greatest mean score of grades, and production per row."""
    means = df.groupBy(grade).agg(F.avg(score).alias("m")).agg(F.min("m").alias("_low"), F.max("m").alias("_high"))
    held = F.greatest(F.least(F.col(score), F.col("_high")), F.col("_low"))
    out = df.crossJoin(F.broadcast(means)).withColumn("capacity", b / (1 + a * (held - c) * (held - c))).drop("_low", "_high")
    return out.withColumns({"season_total": F.col("capacity") * F.col(area) * ratio, "annual_total": F.col("capacity") * F.col(area) * ratio * seasons})


def coded(value: Column, names: dict[int, str]) -> Column:
    """The text of a numeric code; null for other codes."""
    out = None
    for code, name in names.items():
        out = F.when(value == code, name) if out is None else out.when(value == code, name)
    return out


# Slope position by pairs of codes, and the four capability levels.
POSITION_CODES = {1: "山地坡下", 2: "山地坡下", 3: "山地坡中", 4: "山地坡中", 5: "山地坡上", 6: "山地坡上"}
ABILITY_CODES = {1: "不满足", 2: "基本满足", 3: "满足", 4: "充分满足"}

# Texture groups of the profile rule.
CLAYEY = ["黏土", "重黏土", "壤质黏土"]
LOAMY = ["黏壤土", "粉(砂)质黏壤土", "砂质黏壤土", "壤土"]
SANDY = ["砂质壤土", "粉(砂)质壤土"]


def profile_form(texture: Column, soil: Column, land: Column) -> Column:
    """The form of a soil profile from soil type, land use and topsoil texture."""
    dry = land.isin("旱地", "水浇地")
    return (
        F.when((land == "水田") & (soil == "水稻土"), "紧实型")
        .when((land == "水田") & texture.isin(CLAYEY), "上松下紧型")
        .when(dry & soil.isin("黄壤", "黄棕壤"), F.when(texture.isin(SANDY), "松散型").when(texture.isin(LOAMY), "海绵型").otherwise("上松下紧型"))
        .when(dry & (soil == "石灰土"), F.when(texture.isin(CLAYEY), "夹层型").otherwise("薄层型"))
        .when(dry & (soil == "潮土") & texture.isin(*SANDY, "壤土"), "上紧下松型")
        .otherwise("海绵型")
    )


# Base thickness in cm, factors of slope position and land use, and the six special cases.
THICKNESS = {"紫色土": 75.0, "石灰(岩)土": 55.0, "黄壤": 70.0, "黄棕壤": 65.0, "水稻土": 85.0}
OTHER_THICKNESS, THINNEST, THICKEST = 65.0, 25.0, 130.0
POSITION_FACTOR = {"山地坡上": 0.7, "山地坡中": 1.0, "山地坡下": 1.3}
LAND_FACTOR = {"水田": 1.2, "水浇地": 1.1, "旱地": 0.9}


def _factor(value: Column, table: dict[str, float], other: float) -> Column:
    out = None
    for k, v in table.items():
        out = F.when(value == k, v) if out is None else out.when(value == k, v)
    return out.otherwise(other)


def effective_thickness(soil: Column, land: Column, position: Column) -> Column:
    """Effective soil thickness in cm, one decimal."""
    t = _factor(soil, THICKNESS, OTHER_THICKNESS) * _factor(position, POSITION_FACTOR, 1.0) * _factor(land, LAND_FACTOR, 1.0)
    t = F.greatest(F.lit(THINNEST), F.least(t, F.lit(THICKEST)))
    up, down = position == "山地坡上", position == "山地坡下"
    for test, factor in (
        ((soil == "石灰(岩)土") & up, 0.85),
        ((soil == "紫色土") & down & (land == "水田"), 1.15),
        ((soil == "水稻土") & (land == "水田"), 1.2),
        ((soil == "黄壤") & up & (land == "旱地"), 0.9),
        ((soil == "潮土") & land.isin("水田", "水浇地"), 1.15),
        ((soil == "潮土") & down, 1.1),
    ):
        bound = F.greatest(F.lit(THINNEST), t * factor) if factor < 1 else F.least(F.lit(THICKEST), t * factor)
        t = F.when(test, bound).otherwise(t)
    return F.round(t, 1)


def texture_class(sand: Column, silt: Column, clay: Column) -> Column:
    """One of twelve texture classes; the shares are scaled to add up to 100."""
    total = sand + silt + clay
    sand, silt, clay = (100 * v / total for v in (sand, silt, clay))
    return (
        F.when(clay >= 40, F.when(silt >= 40, "SiltyClay").when(sand <= 45, "Clay").otherwise("SandyClay"))
        .when(clay >= 27, F.when((silt < 28) & (sand > 45), "SandyClayLoam").when((silt >= 28) & (silt < 40), "ClayLoam").otherwise("SiltyClayLoam"))
        .when(clay >= 20, F.when(sand >= 52, "SandyClayLoam").when(silt >= 50, "SiltyClayLoam").otherwise("ClayLoam"))
        .when(silt >= 80, "Silt")
        .when(silt >= 50, "SiltLoam")
        .when(sand >= 85, "Sand")
        .when(sand >= 70, "LoamySand")
        .when(sand >= 52, "SandyLoam")
        .otherwise("Loam")
    )


TEXTURE_ERROR = "输入无效：三个参数之和必须为100%"


def texture_name(sand: Column, silt: Column, clay: Column) -> Column:
    """Texture group with its modifiers; an error text where the shares do not add up to 100."""
    total = sand + silt + clay
    group = F.when(clay < 15, "壤土").when(clay <= 25, "黏壤土").when(clay <= 65, "黏土").otherwise("重黏土")
    sandy, silty = (sand >= 55) & (sand <= 85), silt > 45
    loamy = (clay > 25) & (clay < 45) & ~sandy & ~silty
    name = F.concat(F.when(sandy, "砂质").otherwise(""), F.when(silty, "粉质").otherwise(""), F.when(loamy, "壤质").otherwise(""), group)
    return F.when(~((total >= 99.9) & (total <= 100.1)), TEXTURE_ERROR).when(sand > 85, "砂土及壤质砂土").otherwise(name)


def profile_code(texture_codes: Column, slope_codes: Column, main_codes: Column) -> Column:
    """The smallest code that both rules allow, else the smallest main code, else 1."""
    shared = F.array_sort(F.array_intersect(texture_codes, slope_codes))
    first = F.array_sort(main_codes)
    return F.when(F.size(shared) > 0, F.get(shared, F.lit(0))).when(F.size(first) > 0, F.get(first, F.lit(0))).otherwise(F.lit(1))


def guarded(a: Column, b: Column) -> Column:
    """a / b; 0 where that is undefined."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def index(name: str, **b: Column) -> Column:
    """A spectral index by name from the bands blue, green, red, nir, swir1, swir2."""
    d = lambda p, q: guarded(p - q, p + q)
    make = {
        "ndvi": lambda: d(b["nir"], b["red"]),
        "savi": lambda: guarded(b["nir"] - b["red"], b["nir"] + b["red"] + 0.5) * 1.5,
        "ndwi": lambda: d(b["green"], b["nir"]),
        "evi": lambda: 2.5 * guarded(b["nir"] - b["red"], b["nir"] + 6.0 * b["red"] - 7.5 * b["blue"] + 1.0),
        "lswi": lambda: d(b["nir"], b["swir1"]),
        "mndwi": lambda: d(b["green"], b["swir1"]),
        "ndmi": lambda: d(b["nir"], b["swir1"]),
        "vari": lambda: guarded(b["green"] - b["red"], b["green"] + b["red"] - b["blue"]),
        "clay": lambda: d(b["swir1"], b["swir2"]),
        "ferrous": lambda: d(b["nir"], b["swir1"]),
        "carbonate": lambda: d(b["red"], b["green"]),
        "rock": lambda: guarded(b["swir1"] - b["green"], b["swir1"] + b["swir2"] + b["green"]),
    }
    return make[name]()


def tame_extremes(df: DataFrame, bands: list[str], most: float = 100.0) -> DataFrame:
    """Values above ``most`` replaced by the band's exact median."""
    half = medians(df, {f"_{b}": b for b in bands})
    out = df.crossJoin(F.broadcast(half)).withColumns({b: F.when(F.col(b) > most, F.col(f"_{b}")).otherwise(F.col(b)) for b in bands})
    return out.drop(*(f"_{b}" for b in bands))


def treat_outliers(df: DataFrame, column: str, k: float, method: str) -> DataFrame:
    """Values beyond mean +- k deviations cut to that bound, or replaced by the mean or the median."""
    stats = df.agg(F.avg(column).alias("_m"), F.stddev_pop(column).alias("_s"))
    stats = stats.crossJoin(F.broadcast(medians(df, {"_med": column}))) if method == "median" else stats.withColumn("_med", F.lit(None).cast("double"))
    v, low, high = F.col(column), F.col("_m") - k * F.col("_s"), F.col("_m") + k * F.col("_s")
    out = {"truncate": F.greatest(F.least(v, high), low), "mean": F.when((v < low) | (v > high), F.col("_m")).otherwise(v), "median": F.when((v < low) | (v > high), F.col("_med")).otherwise(v)}[method]
    return df.crossJoin(F.broadcast(stats)).withColumn(column, F.when(v.isNotNull(), out)).drop("_m", "_s", "_med")


def twi(area: Column, slope_deg: Column) -> Column:
    """Topographic wetness: log of contributing area over the slope's tangent."""
    return F.log(area / F.tan(F.radians(F.greatest(slope_deg, F.lit(0.001)))))


def wetness(acc: Column, slope_deg: Column, size: float) -> Column:
    return F.log((acc + 1) * size / (F.sin(F.radians(slope_deg)) + 0.001))


def ls_factor(acc: Column, slope_deg: Column, size: float) -> Column:
    """Slope length and steepness."""
    return F.pow(acc * size / 22.13, 0.4) * F.pow(F.sin(F.radians(slope_deg)) / 0.0896, 1.3)


def shape_weight(area: Column, perimeter: Column, greatest_area: Column) -> Column:
    """0.7 of compactness and 0.3 of the log-area ratio."""
    return 0.7 * (4 * math.pi * area / (perimeter * perimeter)) + 0.3 * (F.log1p(area) / F.log1p(greatest_area))


def vapour_pressure(t: Column) -> Column:
    """Saturation vapour pressure in hPa at t degrees."""
    return 6.112 * F.exp(17.67 * t / (t + 243.5))


def clear_pixel(flags: Column, bits: tuple[int, ...] = (10, 11)) -> Column:
    """Whether none of the quality bits is set."""
    return flags.bitwiseAND(F.lit(sum(1 << b for b in bits))) == 0


def clear_composite(scenes: DataFrame, flags: str, cloud: str, most: float, bands: list[str]) -> DataFrame:
    """Median of the clear values of each cell over the scenes with cloud cover below ``most``."""
    return scenes.filter((F.col(cloud) < most) & clear_pixel(F.col(flags))).groupBy("r", "c").agg(*(F.median(b).alias(b) for b in bands))


def products(columns: list[str]) -> dict[str, Column]:
    """Products of all pairs of columns."""
    return {f"{a}_x_{b}": F.col(a) * F.col(b) for i, a in enumerate(columns) for b in columns[i + 1 :]}


def stretch(df: DataFrame, bands: list[str], low: float = 0.01, high: float = 0.99, top: float = 1.0) -> DataFrame:
    """Bands cut at two exact percentiles and scaled to 0..top; a constant band gives 0."""
    ends = low == 0.0 and high == 1.0
    stats = df.agg(*(f(b).alias(f"_{b}{n}") for b in bands for n, f in ((0, F.min), (1, F.max)))) if ends else quantiles(df, {f"_{b}{n}": (b, q) for b in bands for n, q in ((0, low), (1, high))})
    out = {b: F.coalesce(F.try_divide(F.greatest(F.least(F.col(b), F.col(f"_{b}1")), F.col(f"_{b}0")) - F.col(f"_{b}0"), F.col(f"_{b}1") - F.col(f"_{b}0")), F.lit(0.0)) * top for b in bands}
    return df.crossJoin(F.broadcast(stats)).withColumns({b: F.when(F.col(b).isNotNull(), v) for b, v in out.items()}).drop(*(f"_{b}{n}" for b in bands for n in (0, 1)))


def scale_to_range(df: DataFrame, bands: list[str]) -> DataFrame:
    """Min-max scaling."""
    return stretch(df, bands, 0.0, 1.0)


def quantile_classes(df: DataFrame, band: str, shares: list[float], into: str) -> DataFrame:
    """How many of the exact quantiles the value reaches."""
    stats = quantiles(df, {f"_q{i}": (band, q) for i, q in enumerate(shares)})
    count = sum((F.col(band) >= F.col(f"_q{i}")).cast("int") for i in range(len(shares)))
    return df.crossJoin(F.broadcast(stats)).withColumn(into, count).drop(*(f"_q{i}" for i in range(len(shares))))


# Parameters of the irrigation and drainage assessments.
IRRIGATION = {
    "position": {1: 0.9, 2: 0.9, 3: 0.8, 4: 0.5, 5: 0.4, 6: 0.2},
    "weights": {"water": 0.40, "elevation": 0.15, "slope": 0.15, "position": 0.12, "twi": 0.10, "rain": 0.08},
    "levels": (0.30, 0.45, 0.55),
}
DRAINAGE = {
    "position": {1: 0.3, 2: 0.2, 3: 0.5, 4: 0.7, 5: 0.9, 6: 1.0},
    "weights": {"slope": 0.30, "position": 0.25, "water": 0.20, "twi": 0.15, "rain": 0.10},
    "levels": (0.35, 0.50, 0.65),
}


def levels(score: Column, edges: tuple[float, ...]) -> Column:
    """1 and one more for each edge that the score exceeds."""
    return sum(((score > e).cast("int") for e in edges), F.lit(1))


def pumping_effect(height: Column, good: float = 20.0, medium: float = 50.0, decay: float = 200.0) -> Column:
    """How well water reaches a height above its source."""
    return F.when(height <= 0, 1.0).when(height <= good, 0.9).when(height <= medium, 0.7 * F.exp(-(height - good) / medium)).otherwise(0.3 * F.exp(-(height - medium) / decay))


def irrigation_score(water: Column, height: Column, slope: Column, position: Column, wet: Column, rain: Column, steepest: float = 25.0) -> Column:
    """Irrigation capability in 0..1; ``water``, ``wet`` and ``rain`` are scaled to 0..1."""
    w = IRRIGATION["weights"]
    slope_part = F.when(slope <= steepest, 1 - slope / steepest).otherwise(0.0)
    score = water * w["water"] + pumping_effect(height) * w["elevation"] + slope_part * w["slope"] + _factor(position, IRRIGATION["position"], 0.0) * w["position"] + wet * w["twi"] + rain * w["rain"]
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def drainage_slope(slope: Column, low: float = 1.0, best: float = 8.0, most: float = 25.0) -> Column:
    """Slope suitability for drainage: rises to the best slope, falls slowly, then steeply."""
    return (
        F.when(slope < low, 0.3 * slope / low)
        .when(slope <= best, 0.3 + 0.7 * (slope - low) / (best - low))
        .when(slope <= most, 1 - 0.3 * (slope - best) / (most - best))
        .otherwise(0.7 * F.exp(-(slope - most) / 10))
    )


def river_influence(height: Column, distance: Column, density: Column, reach: float = 1000.0) -> Column:
    """Drainage by a river: height bands above it, distance decay and density; halved below 2 m."""
    bands = F.when(height < 0, 0.1).when(height <= 2, 0.2).when(height <= 5, 0.4).when(height <= 15, 0.7 + 0.3 * (height - 5) / 10).otherwise(0.8 * F.exp(-(height - 15) / 30))
    out = bands * 0.45 + F.exp(-distance / reach) * 0.35 + density * 0.2
    return F.when(height < 2, out * 0.5).otherwise(out)


def drainage_score(slope: Column, position: Column, water: Column, wet: Column, rain: Column) -> Column:
    """Drainage capability in 0..1; wetness and rain count against it."""
    w = DRAINAGE["weights"]
    score = drainage_slope(slope) * w["slope"] + _factor(position, DRAINAGE["position"], 0.0) * w["position"] + (1 - wet) * w["twi"] + water * w["water"] + (1 - rain) * w["rain"]
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def natural_breaks(df: DataFrame, column: str, k: int = 5, seed: int = 42, digits: int = 0) -> list[float]:
    """Edges between k clusters of one column: midpoints of sorted k-means centres, between the extremes; equal steps when there are at most k rows."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    rows = df.select(F.col(column).cast("double").alias("v")).filter("v is not null")
    low, high, n = rows.agg(F.min("v"), F.max("v"), F.count("*")).first()
    if not n:
        return []
    if n <= k:
        return [round(low + (high - low) * i / k, digits) for i in range(k + 1)]
    fitted = KMeans(k=k, seed=seed, featuresCol="f").fit(VectorAssembler(inputCols=["v"], outputCol="f").transform(rows))
    centres = sorted(float(c[0]) for c in fitted.clusterCenters())
    return [low, *(round((a + b) / 2, digits) for a, b in zip(centres, centres[1:], strict=False)), high]


def hue_saturation(red: Column, green: Column, blue: Column) -> dict[str, Column]:
    """Hue in degrees (0 for grey) and saturation 0 to 1; of equal greatest bands red comes first, then green."""
    most, least = F.greatest(red, green, blue), F.least(red, green, blue)
    span = most - least
    hue = F.when(span == 0, 0.0).when(red == most, (360 + 60 * (green - blue) / span) % 360).when(green == most, 120 + 60 * (blue - red) / span).otherwise(240 + 60 * (red - green) / span)
    return {"hue": hue, "saturation": F.coalesce(F.try_divide(span, most), F.lit(0.0))}


def entropy(probabilities: Column) -> Column:
    """-sum p ln(p + 1e-9)."""
    return -F.aggregate(probabilities, F.lit(0.0), lambda s, p: s + p * F.log(p + 1e-9))


def top_classes(probabilities: Column, n: int) -> Column:
    """The n likeliest classes as (p, klass) structs, likeliest first, ties by class."""
    pairs = F.transform(probabilities, lambda p, i: F.struct((-p).alias("np"), i.alias("klass"), p.alias("p")))
    return F.transform(F.slice(F.array_sort(pairs), 1, n), lambda s: F.struct(s["p"].alias("p"), s["klass"].alias("klass")))


def reliable(df: DataFrame, value: str, rule: str) -> DataFrame:
    """Rows with value up to mean + population deviation (``deviation``) or up to the 75th percentile (``quartile``)."""
    bound = quantiles(df, {"_b": (value, 0.75)}) if rule == "quartile" else df.agg((F.avg(value) + F.stddev_pop(value)).alias("_b"))
    return df.crossJoin(F.broadcast(bound)).filter(F.col(value) <= F.col("_b")).drop("_b")


def ranked_by(df: DataFrame, column: str, order: list[str], into: str = "position") -> DataFrame:
    """The place of each value in a fixed order; values that it lacks come last."""
    table = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(order)], f"`{column}` string, `{into}` int")
    return df.join(F.broadcast(table), column, "left").withColumn(into, F.coalesce(into, F.lit(len(order))))


