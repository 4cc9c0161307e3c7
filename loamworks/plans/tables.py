"""Projections, cleaning, joins and set operations on survey tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamworks.operators import aggregates as A
from loamworks.operators import cleaning as C
from loamworks.operators import joins as J
from loamworks.plans.registry import query
from loamworks.session import shared_dir
from loamworks.sources import tables as T

STATUS = "CASE WHEN val_txt IS NULL THEN 'Missing' WHEN TRY_CAST(val_txt AS DOUBLE) IS NULL THEN 'Dirty' WHEN TRY_CAST(val_txt AS DOUBLE) > 45 THEN 'High' ELSE 'Normal' END"


SITES = "SELECT site_id, x, y, ph FROM sites"
SITE_SCHEMA = "site_id long, x double, y double, ph double"


def written(df: DataFrame, label: str) -> str:
    """A folder in the shared folder that holds the frame as CSV files of one name part."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.csv(path, header=True)
    return path


@query("S1_read_csv", SITES)
def _(t):
    return T.read_csv(t.spark, written(t.sites.select("site_id", "cls", "x", "y", "ph"), "csv"), "site_id long, cls string, x double, y double, ph double", ["site_id", "x", "y", "ph"])


@query("S2_read_table", "SELECT site_id, cls FROM sites")
def _(t):
    name = f"sites_{uuid.uuid4().hex}"
    T.replace_table(t.sites.select("site_id", "cls"), name, f"{shared_dir(t.spark)}/{name}")
    assert name in T.tables_of(t.spark)
    return T.read_table(t.spark, name)


@query("S3_read_named", SITES)
def _(t):
    return T.read_named(t.spark, written(t.sites.select("site_id", "x", "y", "ph"), "named"), "part-", SITE_SCHEMA)


@query("S8_write_grid", "SELECT r, c, b2 FROM cells WHERE r >= 3 AND r < 12 AND c >= 20 AND c < 95")
def _(t):
    path = f"{shared_dir(t.spark)}/grid-{uuid.uuid4().hex}"
    T.write_grid(t.cells.select("r", "c", "b2"), path, 25)
    return T.read_grid(t.spark, path, 3, 12, 20, 95, 25)


@query("S9_write_reports", "SELECT 'sites' AS report, cls AS k, count(*) AS n FROM sites GROUP BY 2 UNION ALL SELECT 'units', land, count(*) FROM units GROUP BY 2")
def _(t):
    top = f"{shared_dir(t.spark)}/reports-{uuid.uuid4().hex}"
    T.write_reports({n: df.groupBy(F.col(c).alias("k")).agg(F.count("*").alias("n")) for n, df, c in (("sites", t.sites, "cls"), ("units", t.units, "land"))}, top)
    back = [T.read_csv(t.spark, f"{top}/{n}", "k string, n long").select(F.lit(n).alias("report"), "k", "n") for n in ("sites", "units")]
    return back[0].unionByName(back[1])


@query("S10_replace_table", "SELECT land, sum(area) AS area FROM units GROUP BY 1")
def _(t):
    name, path = f"units_{uuid.uuid4().hex}", f"{shared_dir(t.spark)}/units-{uuid.uuid4().hex}"
    sums = t.units.groupBy("land").agg(F.sum("area").alias("area"))
    T.replace_table(sums.withColumn("area", F.lit(0.0)), name, path)
    T.replace_table(sums, name, path)
    return T.read_table(t.spark, name)


@query("P2_tidy_names", "SELECT zone_id, round(avg(b2), 4) AS b2, max(pos) AS position FROM cells GROUP BY 1")
def _(t):
    wide = t.cells.groupBy("zone_id").agg(F.round(F.avg("b2"), 4).alias("b2_mean"), F.max("pos").alias("pos_majority"))
    return C.tidy_names(wide, renamed={"pos": "position"})


@query("S4_common_columns", "SELECT site_id, layer FROM samples UNION ALL SELECT site_id, area_id AS layer FROM sites")
def _(t):
    return T.union_on_common([t.samples, t.sites.withColumnRenamed("area_id", "layer")])


@query("S5_table_to_points", "SELECT site_id, x, y, ph FROM sites WHERE x IS NOT NULL AND y IS NOT NULL")
def _(t):
    return T.points(t.sites.withColumnsRenamed({"x": "lon", "y": "lat"}), "lon", "lat").select("site_id", "x", "y", "ph")


# words that the fixture's texts hold stand for the words of a log
MESSAGES = r"SELECT conv_id, turn, CAST(u.n AS INT) AS line, CASE WHEN regexp_matches(u.l, '(?i)error') THEN 'error' ELSE 'warning' END AS kind, nullif(regexp_extract(u.l, '([0-9]{6})', 1), '') AS code FROM (SELECT conv_id, turn, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS n FROM (SELECT conv_id, turn, regexp_replace(regexp_replace(coalesce(text, ''), 'the ', 'Error ', 'g'), 'de ', 'WARNING 202501 ', 'g') AS t FROM conversations) w) u WHERE regexp_matches(u.l, '(?i)error') OR regexp_matches(u.l, '(?i)warning')"


@query("S11_message_lines", MESSAGES)
def _(t):
    text = F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), "the ", "Error "), "de ", "WARNING 202501 ")
    return T.message_lines(t.conversations.select("conv_id", "turn", text.alias("text")), ["conv_id", "turn"], "text")


@query("P1_subset_rename", "SELECT site_id AS ydbh, layer AS ch, val_txt AS txt FROM samples")
def _(t):
    return C.subset(t.samples, {"site_id": "ydbh", "layer": "ch", "val_txt": "txt"})


@query(
    "P3_keep_left",
    "SELECT s.site_id, s.layer, s.lab_id, s.run_id, s.ord, s.val_txt, s.flag, x, y, ph, val, cls, area_id FROM samples s LEFT JOIN sites p ON s.site_id = p.site_id",
)
def _(t):
    return C.keep_left(t.samples, t.sites, ["site_id"])


@query("P4_keep_fields", "SELECT l_orderkey, l_linenumber, area, tz FROM units")
def _(t):
    return C.drop_fields(C.keep_fields(t.units, ["l_orderkey", "l_linenumber", "area", "tz", "ts"]), ["ts", "absent"])


@query(
    "P5_clean_numbers",
    "SELECT site_id, layer, lab_id, run_id, ord, CASE WHEN NOT regexp_matches(val_txt, '[/*]') THEN TRY_CAST(val_txt AS DOUBLE) END AS val_txt FROM samples",
)
def _(t):
    return C.clean_numbers(t.samples, ["val_txt"]).select("site_id", "layer", "lab_id", "run_id", "ord", "val_txt")


@query(
    "P6_sentinel_fill",
    "SELECT site_id, layer, lab_id, coalesce(TRY_CAST(val_txt AS INT), 1111) AS as_int, coalesce(TRY_CAST(val_txt AS DOUBLE), 0.0001) AS as_double, coalesce(val_txt, '') AS as_text FROM samples",
)
def _(t):
    v = F.col("val_txt")
    return t.samples.select("site_id", "layer", "lab_id", C.filled(v, "int", 1111).alias("as_int"), C.filled(v, "double", 0.0001).alias("as_double"), C.filled(v, "string", "").alias("as_text"))


@query("P7_filter_rows", "SELECT site_id, layer, lab_id, val_txt FROM samples WHERE layer IN (1, 2) AND val_txt IS NOT NULL")
def _(t):
    return C.filter_rows(C.filter_rows(t.samples, "layer", [1, 2]), "val_txt", null=False).select("site_id", "layer", "lab_id", "val_txt")


@query("P8_id_suffix", "SELECT site_id, layer, lab_id FROM samples WHERE CAST(lab_id AS STRING) LIKE '%10' OR CAST(lab_id AS STRING) LIKE '%11'")
def _(t):
    return C.ids_ending(t.samples, "lab_id", ["10", "11"]).select("site_id", "layer", "lab_id")


@query(
    "P9_normal_rows",
    f"WITH s AS (SELECT site_id, layer, lab_id, {STATUS} AS sta, coalesce(TRY_CAST(val_txt AS DOUBLE), 0.0001) AS label FROM samples) SELECT * FROM s WHERE sta = 'Normal' AND label <> 0.0001",
)
def _(t):
    s = t.samples.select("site_id", "layer", "lab_id", F.expr(STATUS).alias("sta"), C.filled(F.col("val_txt"), "double", 0.0001).alias("label"))
    return C.normal_rows(s, "sta", "label")


@query(
    "P10_finite_rows",
    "SELECT site_id, layer, lab_id, TRY_CAST(val_txt AS DOUBLE) AS v FROM samples WHERE TRY_CAST(val_txt AS DOUBLE) IS NOT NULL",
)
def _(t):
    return C.finite_rows(t.samples.select("site_id", "layer", "lab_id", F.col("val_txt").try_cast("double").alias("v")), ["v"])


V = "SELECT site_id, layer, lab_id, TRY_CAST(val_txt AS DOUBLE) AS v FROM samples"


@query("P11_impute_mean", f"WITH s AS ({V}) SELECT site_id, layer, lab_id, round(coalesce(v, (SELECT avg(v) FROM s)), 4) AS v FROM s")
def _(t):
    s = t.samples.select("site_id", "layer", "lab_id", F.col("val_txt").try_cast("double").alias("v"))
    return C.impute(s, ["v"]).withColumn("v", F.round("v", 4))


@query("P11_impute_median", f"WITH s AS ({V}) SELECT site_id, layer, lab_id, coalesce(v, (SELECT median(v) FROM s)) AS v FROM s")
def _(t):
    return C.impute(t.samples.select("site_id", "layer", "lab_id", F.col("val_txt").try_cast("double").alias("v")), ["v"], "median")


@query(
    "P12_forward_fill",
    "SELECT site_id, layer, lab_id, run_id, ord, last_value(val_txt IGNORE NULLS) OVER (PARTITION BY site_id ORDER BY layer, lab_id, run_id, ord ROWS UNBOUNDED PRECEDING) AS val_txt FROM samples",
)
def _(t):
    return C.forward_fill(t.samples, ["val_txt"], ["layer", "lab_id", "run_id", "ord"], ["site_id"]).select("site_id", "layer", "lab_id", "run_id", "ord", "val_txt")


@query("P13_code_lookup", "SELECT l_orderkey, l_linenumber, l_partkey, coalesce(n_name, '未匹配') AS named FROM units LEFT JOIN nation ON l_partkey % 30 = n_nationkey")
def _(t):
    return C.look_up(t.units, F.col("l_partkey") % 30, t.nation, "n_nationkey", "n_name", "named", "未匹配").select("l_orderkey", "l_linenumber", "l_partkey", "named")


LAYER_NAMES = {str(i): f"层{i}" for i in range(1, 5)}


@query(
    "P14_code_list",
    "WITH s AS (SELECT site_id, lab_id, string_agg(CAST(layer AS STRING), ',' ORDER BY layer) AS codes FROM samples GROUP BY 1, 2) "
    "SELECT site_id, lab_id, codes, (SELECT string_agg(CASE WHEN u.x IN ('1', '2', '3', '4') THEN concat('层', u.x) ELSE '' END, ',' ORDER BY u.x) FROM (SELECT unnest(string_split(codes, ',')) AS x) u) AS names FROM s",
)
def _(t):
    s = t.samples.groupBy("site_id", "lab_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("layer")), lambda x: x.cast("string")), ",").alias("codes"))
    return s.withColumn("names", C.names_of_codes(F.col("codes"), LAYER_NAMES))


@query(
    "P15_match_tuples",
    "WITH d AS (SELECT tl, yl, tz, min(ts) AS new_tz FROM units WHERE l_partkey % 3 = 0 GROUP BY 1, 2, 3) SELECT l_orderkey, l_linenumber, l_partkey, coalesce(new_tz, '未匹配') AS new_tz "
    "FROM units u LEFT JOIN d ON u.tl IS NOT DISTINCT FROM d.tl AND u.yl IS NOT DISTINCT FROM d.yl AND u.tz IS NOT DISTINCT FROM d.tz",
)
def _(t):
    on = ["tl", "yl", "tz"]
    d = t.units.filter("l_partkey % 3 = 0").groupBy(*on).agg(F.min("ts").alias("new_tz"))
    return C.match_tuples(t.units, d, on, "new_tz", "未匹配").select("l_orderkey", "l_linenumber", "l_partkey", "new_tz")


@query("P16_first_nonzero", "SELECT site_id, layer, lab_id, coalesce(nullif(TRY_CAST(val_txt AS DOUBLE), 0), nullif(CAST(flag AS DOUBLE), 0), 0) AS v FROM samples")
def _(t):
    return t.samples.select("site_id", "layer", "lab_id", C.first_nonzero(F.col("val_txt"), F.col("flag").cast("string")).alias("v"))


@query(
    "P17_land_kind",
    "WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, concat(lpad(CAST(l_partkey % 14 AS STRING), 2, '0'), CASE WHEN l_partkey % 2 = 0 THEN '01' ELSE '03' END) AS code FROM units) SELECT *, "
    "CASE WHEN code = '0101' THEN '水稻土' WHEN substr(code, 1, 2) IN ('01', '02', '12') THEN '非自然土' WHEN substr(code, 1, 2) IN ('03', '04') THEN '自然土' "
    "WHEN substr(code, 1, 2) IN ('05', '06', '07', '08', '09', '10', '11') THEN '建设用地' ELSE '未分类' END AS kind FROM s",
)
def _(t):
    code = F.concat(F.lpad((F.col("l_partkey") % 14).cast("string"), 2, "0"), F.when(F.col("l_partkey") % 2 == 0, "01").otherwise("03"))
    return t.units.select("l_orderkey", "l_linenumber", "l_partkey", code.alias("code")).withColumn("kind", C.land_kind(F.col("code")))


@query(
    "P18_normal_text",
    r"SELECT l_orderkey, l_linenumber, l_partkey, trim(regexp_replace(translate(concat('  薄层（', ts, '）', chr(10), '壤土  '), '（）', '()'), '\s+', ' ', 'g')) AS name FROM units",
)
def _(t):
    return t.units.select("l_orderkey", "l_linenumber", "l_partkey", C.normal_text(F.concat(F.lit("  薄层（"), "ts", F.lit("）\n壤土  "))).alias("name"))


@query(
    "P19_bracket_variants",
    r"WITH n AS (SELECT DISTINCT concat('薄层(', ts, ')壤') AS name FROM units) SELECT name, name AS variant FROM n UNION SELECT name, regexp_replace(name, '[()]', '', 'g') FROM n UNION SELECT name, regexp_replace(name, '\([^)]*\)', '', 'g') FROM n",
)
def _(t):
    return C.bracket_variants(t.units.select(F.concat(F.lit("薄层("), "ts", F.lit(")壤")).alias("name")).distinct(), "name")


@query(
    "P20_scaled_area",
    "WITH o AS (SELECT township, sum(area) AS own FROM units GROUP BY 1), g AS (SELECT township, own * 1.25 AS given FROM o) SELECT l_orderkey, l_linenumber, l_partkey, "
    "round(abs(area) * (given / own) * 0.0015, 6) AS mu FROM units JOIN o USING (township) JOIN g USING (township)",
)
def _(t):
    given = t.units.groupBy("township").agg((F.sum("area") * 1.25).alias("given"))
    s = C.scale_by(t.units.withColumn("area", F.abs("area")), "area", given, "township", "given")
    return s.select("l_orderkey", "l_linenumber", "l_partkey", F.round(F.col("adjusted") * 0.0015, 6).alias("mu"))


@query(
    "P21_aspect_class",
    "WITH a AS (SELECT r, c, CASE WHEN b2 = 3 THEN -1 ELSE b2 * 4 - 12 END AS aspect FROM cells) SELECT r, c, aspect, CASE WHEN aspect = -1 THEN '平面' WHEN aspect > 0 AND aspect <= 22.5 THEN '北' WHEN aspect > 22.5 AND aspect <= 67.5 THEN '东北' "
    "WHEN aspect > 67.5 AND aspect <= 112.5 THEN '东' WHEN aspect > 112.5 AND aspect <= 157.5 THEN '东南' WHEN aspect > 157.5 AND aspect <= 202.5 THEN '南' WHEN aspect > 202.5 AND aspect <= 247.5 THEN '西南' "
    "WHEN aspect > 247.5 AND aspect <= 292.5 THEN '西' WHEN aspect > 292.5 AND aspect <= 337.5 THEN '西北' WHEN aspect > 337.5 AND aspect <= 360 THEN '北' ELSE '其它' END AS facing FROM a",
)
def _(t):
    a = t.cells.select("r", "c", F.expr("CASE WHEN b2 = 3 THEN -1 ELSE b2 * 4 - 12 END").alias("aspect"))
    return a.withColumn("facing", C.aspect_class(F.col("aspect")))


@query(
    "P22_duplicate_class",
    "SELECT site_id, cls FROM sites UNION ALL SELECT site_id, '复制' FROM sites",
)
def _(t):
    return C.duplicate_class(t.sites.select("site_id", "cls"), "cls", "复制")


@query(
    "P23_consistency_flags",
    "SELECT r, c, CASE WHEN dz * 5 + dl % 5 IN (13,14,17,19,21,23,24,25,26,27,28,38,40,41) THEN 1 ELSE 0 END AS not_farmed, "
    "CASE WHEN pos = 1 AND dz * 5 + dl % 5 IN (1,2,30,31,32,39) THEN 1 ELSE 0 END AS paddy_ok, CASE WHEN dz * 5 + dl % 5 IN (6,7,8,9,10,11,12,20,33,35,36) THEN 1 ELSE 0 END AS \"natural\", "
    "CASE WHEN b2 / 50 <= 0.5 THEN 0 WHEN b2 / 50 <= 1 THEN 1 ELSE 2 END AS depth FROM cells",
)
def _(t):
    flags = C.consistency_flags(F.expr("dz * 5 + dl % 5"), F.when(F.col("pos") == 1, C.PADDY).otherwise("黄壤"), F.expr("b2 / 50"))
    return t.cells.select("r", "c", *(v.alias(k) for k, v in flags.items()))


@query("P24_describe_row", "SELECT l_orderkey, l_linenumber, l_partkey, concat(township, '的', tz, '，利用为', land) AS sentence FROM units")
def _(t):
    return t.units.select("l_orderkey", "l_linenumber", "l_partkey", C.describe_row("%s的%s，利用为%s", F.col("township"), F.col("tz"), F.col("land")).alias("sentence"))


@query("P25_short_hash", "SELECT DISTINCT land, substr(md5(land), 1, 10) AS code FROM units")
def _(t):
    return t.units.select("land").distinct().withColumn("code", C.short_hash(F.col("land")))


@query(
    "P26_route",
    "SELECT CASE WHEN CAST(site_id AS STRING) LIKE '18%' THEN '18' WHEN CAST(site_id AS STRING) LIKE '19%' THEN '19' ELSE 'other' END AS route, count(*) AS n FROM samples GROUP BY 1",
)
def _(t):
    return C.route(t.samples.select(F.col("site_id").cast("string").alias("site_id")), "site_id", ["18", "19"]).groupBy("route").agg(F.count("*").alias("n"))


# --- joins


@query("J1_inner", "SELECT l_orderkey, l_linenumber, l_partkey, s_name FROM units JOIN supplier ON l_suppkey = s_suppkey")
def _(t):
    u = t.units
    s = t.supplier
    return u.join(s, u.l_suppkey == s.s_suppkey).select("l_orderkey", "l_linenumber", "l_partkey", "s_name")


@query(
    "J2_left_chain",
    "WITH a AS (SELECT site_id, min(struct_pack(v1 := lab_id, v2 := run_id)) AS m FROM samples WHERE layer = 1 GROUP BY 1), b AS (SELECT site_id, min(struct_pack(w1 := lab_id)) AS m FROM samples WHERE layer = 2 GROUP BY 1) "
    "SELECT s.site_id, ph, a.m.v1 AS v1, a.m.v2 AS v2, b.m.w1 AS w1 FROM sites s LEFT JOIN a ON s.site_id = a.site_id LEFT JOIN b ON s.site_id = b.site_id",
)
def _(t):
    s = t.samples
    one = s.filter("layer = 1").selectExpr("site_id", "lab_id AS v1", "run_id AS v2")
    two = s.filter("layer = 2").selectExpr("site_id", "lab_id AS w1")
    return J.chain(t.sites.select("site_id", "ph"), [(one, ["site_id"]), (two, ["site_id"])])


@query(
    "J3_outer_by_pivot",
    "WITH l AS (SELECT zone_id, pos, avg(b2) AS v FROM cells GROUP BY 1, 2) SELECT zone_id, " + ", ".join(f'round(v{p}, 4) AS "{p}"' for p in range(1, 7)) + " FROM " + " FULL JOIN ".join(f"(SELECT zone_id, v AS v{p} FROM l WHERE pos = {p}) t{p}" + (" USING (zone_id)" if p > 1 else "") for p in range(1, 7)),
)
def _(t):
    long = t.cells.groupBy("zone_id", F.col("pos").cast("string").alias("pos")).agg(F.round(F.avg("b2"), 4).alias("v"))
    return J.outer_by_pivot(long, "zone_id", "pos", [str(p) for p in range(1, 7)], "v")


@query("J4_right", "SELECT n_name, s.site_id FROM (SELECT * FROM sites WHERE ph > 6) s RIGHT JOIN nation ON area_id = n_nationkey")
def _(t):
    s = t.sites.filter("ph > 6")
    n = t.nation
    return s.join(n, s.area_id == n.n_nationkey, "right").select("n_name", "site_id")


@query("J4_outer", "SELECT a.site_id AS a_id, b.site_id AS b_id FROM (SELECT * FROM sites WHERE ph > 6) a FULL JOIN (SELECT * FROM sites WHERE x > 50) b ON a.site_id = b.site_id")
def _(t):
    a, b = t.sites.filter("ph > 6").select(F.col("site_id").alias("a_id")), t.sites.filter("x > 50").select(F.col("site_id").alias("b_id"))
    return a.join(b, a.a_id == b.b_id, "outer")


@query(
    "J5_one_side_only",
    "SELECT site_id, 'left' AS side FROM (SELECT site_id FROM samples EXCEPT SELECT site_id FROM sites) UNION ALL SELECT site_id, 'right' FROM (SELECT site_id FROM sites EXCEPT SELECT site_id FROM samples)",
)
def _(t):
    left = J.only_left(t.samples, t.sites, "site_id").withColumn("side", F.lit("left"))
    return left.unionByName(J.only_left(t.sites, t.samples, "site_id").withColumn("side", F.lit("right")))


@query(
    "J6_nearest_point",
    "WITH p AS (SELECT q.site_id, n.site_id AS n_site_id, n.ph AS n_ph, (q.x-n.x)*(q.x-n.x)+(q.y-n.y)*(q.y-n.y) AS d2 FROM sites q JOIN sites n ON n.cls <> 'BUILDING' AND n.site_id <> q.site_id), "
    "b AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY d2, n_site_id) AS k FROM p) SELECT q.site_id, n_site_id, n_ph, round(sqrt(d2), 4) AS dist FROM sites q LEFT JOIN b ON q.site_id = b.site_id AND k = 1",
)
def _(t):
    q, s = t.sites, t.sites.filter("cls <> 'BUILDING'")
    found = J.nearest(q, s, "site_id", None, "site_id", other=True).select("site_id", "n_site_id", "n_ph", F.round(F.sqrt("dist2"), 4).alias("dist"))
    return q.select("site_id").join(found, "site_id", "left")


@query(
    "J7_k_nearest",
    "WITH p AS (SELECT a.site_id, b.site_id AS n_site_id, (a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y) AS d2 FROM sites a JOIN sites b ON a.site_id <> b.site_id) "
    "SELECT site_id, n_site_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY d2, n_site_id) AS rank FROM p) WHERE rank <= 8",
)
def _(t):
    return J.nearest(t.sites, t.sites, "site_id", None, "site_id", k=8, other=True).select("site_id", "n_site_id", "rank")


@query(
    "J8_within_radius",
    "SELECT a.site_id, count(*) AS n, round(avg(b.ph), 4) AS mean_ph FROM sites a JOIN sites b ON (a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y) <= 36 GROUP BY 1",
)
def _(t):
    return J.near_pairs(t.sites, t.sites, 6.0).groupBy("site_id").agg(F.count("*").alias("n"), F.round(F.avg("n_ph"), 4).alias("mean_ph"))


INSIDE = "x >= x0 AND x < x1 AND y >= y0 AND y < y1"


@query("J9_points_in_polygons", f"SELECT site_id, zone_id FROM sites JOIN zones ON {INSIDE}")
def _(t):
    z = t.zones.withColumn("ring", J.box_ring("x0", "y0", "x1", "y1"))
    return J.points_in_polygons(t.sites, z, 10.0).select("site_id", "zone_id")


#: A concave ring and one over everything; the corners of the first are off the grid of the points.
BENT = [(3.03, 1.04), (61.02, 7.01), (95.07, 88.02), (50.01, 20.03), (9.06, 70.05), (3.03, 1.04)]
EDGES = ", ".join(f"({ax}, {ay}, {bx}, {by})" for (ax, ay), (bx, by) in zip(BENT, BENT[1:], strict=False))


@query(
    "J9_overlapping_polygons",
    f"WITH e(px, py, qx, qy) AS (VALUES {EDGES}), n AS (SELECT site_id, count(*) FILTER (WHERE (py > y) <> (qy > y) AND x < CAST(qx - px AS DOUBLE) * (y - py) / CAST(qy - py AS DOUBLE) + px) AS n FROM sites CROSS JOIN e GROUP BY 1), b AS (SELECT min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM zones) "
    f"SELECT site_id, zone_id FROM sites JOIN zones ON {INSIDE} UNION ALL SELECT site_id, -1 FROM n WHERE n % 2 = 1 UNION ALL SELECT site_id, -2 FROM sites JOIN b ON {INSIDE}",
)
def _(t):
    z = t.zones.select("zone_id", J.box_ring("x0", "y0", "x1", "y1").alias("ring"))
    bent = t.zones.limit(1).select(F.lit(-1).alias("zone_id"), F.array(*(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in BENT)).alias("ring"))
    all_ = t.zones.agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")).select(F.lit(-2).alias("zone_id"), J.box_ring("x0", "y0", "x1", "y1").alias("ring"))
    return J.points_in_polygons(t.sites, z.unionByName(bent).unionByName(all_), 4.0).select("site_id", "zone_id")


@query("J9_one_polygon_each", f"SELECT site_id, min(zone_id) AS zone_id FROM sites LEFT JOIN zones ON {INSIDE} GROUP BY 1")
def _(t):
    z = t.zones.withColumn("ring", J.box_ring("x0", "y0", "x1", "y1"))
    return J.one_polygon_each(t.sites.select("site_id", "x", "y"), z, "site_id", "zone_id", 10.0).select("site_id", "zone_id")


@query(
    "J10_chained_layers",
    f"WITH big AS (SELECT zone_id // 1000 AS band, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM zones GROUP BY 1) "
    f"SELECT s.site_id, (SELECT min(zone_id) FROM zones WHERE {INSIDE}) AS zone_id, (SELECT min(band) FROM big WHERE {INSIDE}) AS band FROM sites s",
)
def _(t):
    z = t.zones.withColumn("ring", J.box_ring("x0", "y0", "x1", "y1"))
    big = z.groupBy(F.expr("zone_id div 1000").alias("band")).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    big = big.withColumn("ring", J.box_ring("x0", "y0", "x1", "y1"))
    return J.chained(t.sites.select("site_id", "x", "y"), [(z, "zone_id"), (big, "band")], "site_id", 10.0).select("site_id", "zone_id", "band")


@query(
    "J11_sample_grid",
    "SELECT site_id, coalesce(b2, -1) AS b2, coalesce(b8, -1) AS b8 FROM sites LEFT JOIN cells ON c = CAST(floor(x) AS INT) AND r = CAST(floor(y) AS INT)",
)
def _(t):
    return J.sample_grid(t.sites, t.cells, ["b2", "b8"], fill=-1.0).select("site_id", "b2", "b8")


@query("J12_overlay", "SELECT zone_id, dz, count(*) * 25.0 AS area FROM cells GROUP BY 1, 2")
def _(t):
    return J.overlay(t.cells, "zone_id", "dz", 25.0)


@query(
    "J14_assign_kind",
    "WITH o AS (SELECT zone_id, dz, count(*) AS n FROM cells GROUP BY 1, 2), a AS (SELECT zone_id, dz AS kind, n / sum(n) OVER (PARTITION BY zone_id) AS share, row_number() OVER (PARTITION BY zone_id ORDER BY n DESC, dz) AS k FROM o), "
    "q AS (SELECT zone_id, area_id % 9 + 1 AS v, count(*) AS n FROM sites JOIN zones ON x >= x0 AND x < x1 AND y >= y0 AND y < y1 GROUP BY 1, 2), b AS (SELECT zone_id, v AS points, n / sum(n) OVER (PARTITION BY zone_id) AS points_share, row_number() OVER (PARTITION BY zone_id ORDER BY n DESC, v) AS k FROM q), "
    "m AS (SELECT zone_id, pos, count(*) AS n FROM cells GROUP BY 1, 2), p AS (SELECT zone_id, pos AS predicted, row_number() OVER (PARTITION BY zone_id ORDER BY n DESC, pos) AS k FROM m) "
    "SELECT a.zone_id, CASE WHEN (CASE WHEN points_share > share THEN points_share ELSE share END) < 0.5 AND predicted IS NOT NULL THEN predicted WHEN points_share > share THEN points ELSE kind END AS kind, "
    "round(CASE WHEN points_share > share THEN points_share ELSE share END, 4) AS certainty FROM a LEFT JOIN b ON a.zone_id = b.zone_id AND b.k = 1 LEFT JOIN p ON a.zone_id = p.zone_id AND p.k = 1 WHERE a.k = 1",
)
def _(t):
    overlap = J.largest_share(J.overlay(t.cells, "zone_id", "dz"), "zone_id", "dz").select("zone_id", F.col("dz").alias("kind"), "share")
    z = t.zones.withColumn("ring", J.box_ring("x0", "y0", "x1", "y1"))
    inside = J.points_in_polygons(t.sites, z, 10.0).select("zone_id", (F.col("area_id") % 9 + 1).alias("v"))
    points = J.majority(inside, "zone_id", "v", "points")
    predicted = J.majority(t.cells, "zone_id", "pos", "predicted").select("zone_id", "predicted")
    return J.assign_kind(overlap, points, predicted, "zone_id").withColumn("certainty", F.round("certainty", 4))


@query("J13_identity", "SELECT zone_id, dz, CASE WHEN water = 1 THEN pos END AS pos, count(*) AS n_cells FROM cells GROUP BY 1, 2, 3")
def _(t):
    left = t.cells.select("r", "c", "zone_id")
    right = t.cells.select("r", "c", "dz")
    third = t.cells.filter("water = 1").select("r", "c", "pos")
    return left.join(right, ["r", "c"], "left").join(third, ["r", "c"], "left").groupBy("zone_id", "dz", "pos").agg(F.count("*").alias("n_cells"))


@query(
    "J15_attach_predictions",
    "SELECT u.zone_id, u.n_cells, p.n AS predicted FROM zones u LEFT JOIN (SELECT zone_id, count(*) AS n FROM cells WHERE dl = 3 GROUP BY 1) p ON u.zone_id = p.zone_id",
)
def _(t):
    p = t.cells.filter("dl = 3").groupBy("zone_id").agg(F.count("*").alias("predicted"))
    return C.keep_left(t.zones.select("zone_id", "n_cells"), p, ["zone_id"])


@query(
    "J16_height_above_drainage",
    "WITH v AS (SELECT r, c, dem FROM cells WHERE water = 1 AND dem IS NOT NULL), p AS (SELECT a.r, a.c, a.dem - v.dem AS hand, row_number() OVER (PARTITION BY a.r, a.c ORDER BY (a.r-v.r)*(a.r-v.r)+(a.c-v.c)*(a.c-v.c), v.r, v.c) AS k "
    "FROM cells a CROSS JOIN v) SELECT a.r, a.c, hand FROM cells a LEFT JOIN p ON a.r = p.r AND a.c = p.c AND k = 1",
)
def _(t):
    return J.height_above(t.cells, F.col("water") == 1, "dem")


@query(
    "J17_along_line",
    "WITH l AS (SELECT zone_id, 0 AS pos, x0 AS x, y0 AS y FROM zones UNION ALL SELECT zone_id, 1, x1, y0 FROM zones UNION ALL SELECT zone_id, 2, x1, y1 FROM zones) SELECT zone_id, l.pos, dem FROM l LEFT JOIN cells USING (zone_id) WHERE false "
    "UNION ALL SELECT l.zone_id, l.pos, cells.dem FROM l LEFT JOIN cells ON cells.c = CAST(floor(x) AS INT) AND cells.r = CAST(floor(y) AS INT)",
)
def _(t):
    v = F.array(*(F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"))))
    return J.along_line(t.zones.select("zone_id", v.alias("v")), t.cells, "zone_id", "v", "dem").select("zone_id", "pos", "dem")


# --- set operations


@query("U1_concatenate", "SELECT site_id, 'a' AS src FROM sites UNION ALL SELECT site_id, 'b' FROM samples")
def _(t):
    return t.sites.select("site_id", F.lit("a").alias("src")).unionByName(t.samples.select("site_id", F.lit("b").alias("src")))


@query(
    "U2_value_sets",
    "SELECT 'union' AS op, count(*) AS n FROM (SELECT site_id FROM sites UNION SELECT site_id FROM samples) UNION ALL SELECT 'intersect', count(*) FROM (SELECT site_id FROM sites INTERSECT SELECT site_id FROM samples) "
    "UNION ALL SELECT 'difference', count(*) FROM (SELECT site_id FROM sites EXCEPT SELECT site_id FROM samples)",
)
def _(t):
    a, b = t.sites.select("site_id"), t.samples.select("site_id")
    sets = {"union": a.union(b).distinct(), "intersect": a.intersect(b), "difference": a.subtract(b)}
    rows = [v.agg(F.lit(k).alias("op"), F.count("*").alias("n")) for k, v in sets.items()]
    return rows[0].union(rows[1]).union(rows[2])


@query("U3_distinct", "SELECT DISTINCT layer, lab_id % 100 AS lab FROM samples")
def _(t):
    return t.samples.select("layer", (F.col("lab_id") % 100).alias("lab")).distinct()


@query(
    "U4_segments",
    "SELECT CASE WHEN dz <= 3 AND dl <= 4 THEN 'a' WHEN dz <= 3 THEN 'b' WHEN dl IN (5, 6) THEN 'c' ELSE 'd' END AS segment, count(*) AS n, round(avg(b4), 4) AS mean FROM cells GROUP BY 1",
)
def _(t):
    segment = F.when((F.col("dz") <= 3) & (F.col("dl") <= 4), "a").when(F.col("dz") <= 3, "b").when(F.col("dl").isin(5, 6), "c").otherwise("d")
    return t.cells.withColumn("segment", segment).groupBy("segment").agg(F.count("*").alias("n"), F.round(F.avg("b4"), 4).alias("mean"))


@query(
    "U5_mosaic",
    "WITH m AS (SELECT r, c, CASE WHEN b2 > 50 THEN NULL ELSE b2 END AS v, 1 AS src FROM cells UNION ALL SELECT r, c + 3, b3, 2 FROM cells) SELECT r, c, v, src FROM (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY CASE WHEN v IS NULL THEN 1 ELSE 0 END, src) AS k FROM m) WHERE k = 1",
)
def _(t):
    a = t.cells.select("r", "c", F.when(F.col("b2") <= 50, F.col("b2")).alias("v"), F.lit(1).alias("src"))
    b = t.cells.select("r", (F.col("c") + 3).alias("c"), F.col("b3").alias("v"), F.lit(2).alias("src"))
    return A.keep_first(a.unionByName(b), ["r", "c"], [F.col("v").isNull(), "src"])


# --- windows


ORDER = "layer, lab_id, run_id, ord"


@query(
    "W1_number_and_pivot",
    f"WITH n AS (SELECT site_id, lab_id, row_number() OVER (PARTITION BY site_id ORDER BY {ORDER}) AS k FROM samples) SELECT site_id, max(CASE WHEN k = 1 THEN lab_id END) AS v1, max(CASE WHEN k = 2 THEN lab_id END) AS v2, max(CASE WHEN k = 3 THEN lab_id END) AS v3 FROM n GROUP BY 1",
)
def _(t):
    n = t.samples.withColumn("k", F.row_number().over(Window.partitionBy("site_id").orderBy(*ORDER.split(", "))))
    return J.outer_by_pivot(n.withColumn("k", F.concat(F.lit("v"), "k")), "site_id", "k", ["v1", "v2", "v3"], "lab_id")


@query("W2_group_number", "SELECT site_id, layer, lab_id, dense_rank() OVER (ORDER BY layer, flag) - 1 AS grp FROM samples")
def _(t):
    groups = A.ranked(t.samples.select("layer", "flag").distinct(), ["layer", "flag"], "grp").withColumn("grp", F.col("grp").cast("long"))
    return t.samples.join(groups, ["layer", "flag"]).select("site_id", "layer", "lab_id", "grp")


@query("W6_largest", "SELECT site_id, val FROM sites ORDER BY val DESC, site_id LIMIT 15")
def _(t):
    return t.sites.select("site_id", "val").orderBy(F.col("val").desc(), "site_id").limit(15)
