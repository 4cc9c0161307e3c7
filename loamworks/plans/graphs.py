"""Regions, parcels and flow; the twins walk the same links with recursive queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamworks.operators import aggregates as A
from loamworks.operators import graph as P
from loamworks.operators import grid as G
from loamworks.operators import hydrology as H
from loamworks.operators import joins as J
from loamworks.plans.grids import AT, NEAR, ext
from loamworks.plans.registry import query
from loamworks.plans.reports import rounded

ROW = P.ROW
STEP4 = "abs(n.r - a.r) + abs(n.c - a.c) = 1"


def region_sql(src: str, step: str = STEP4) -> str:
    """Labels by recursive reachability from every cell of ``src`` (r, c, v)."""
    return (
        f"WITH RECURSIVE src AS ({src}), e AS (SELECT a.r * {ROW} + a.c AS x, n.r * {ROW} + n.c AS y FROM src a JOIN src n ON n.r BETWEEN a.r - 1 AND a.r + 1 AND n.c BETWEEN a.c - 1 AND a.c + 1 AND {step} AND n.v = a.v), "
        f"reach AS (SELECT r * {ROW} + c AS node, r * {ROW} + c AS pt FROM src UNION SELECT reach.node, e.y FROM reach JOIN e ON reach.pt = e.x), lab AS (SELECT node, min(pt) AS label FROM reach GROUP BY 1)"
    )


BLOCK = "SELECT CAST(r AS BIGINT) AS r, CAST(c AS BIGINT) AS c, dl AS v FROM cells"


@query("G1_regions", f"{region_sql(BLOCK)} SELECT CAST(r AS INT) AS r, CAST(c AS INT) AS c, v, label FROM src JOIN lab ON src.r * {ROW} + src.c = node")
def _(t):
    return P.regions(t.cells, "dl")


@query("G1_regions_eight", f"{region_sql(BLOCK, '(n.r <> a.r OR n.c <> a.c)')}, s AS (SELECT label, v, count(*) AS n FROM src JOIN lab ON src.r * {ROW} + src.c = node GROUP BY 1, 2) SELECT label, v, n FROM s")
def _(t):
    return P.region_sizes(P.regions(t.cells, "dl", eight=True)).select("label", "v", "n")


EDGES = "(SELECT least(z, n) AS a, greatest(z, n) AS b, count(*) * 1.0 AS length FROM (SELECT a.zone_id AS z, n.zone_id AS n FROM cells a JOIN cells n ON (n.r = a.r AND n.c = a.c + 1) OR (n.r = a.r + 1 AND n.c = a.c)) p WHERE z <> n GROUP BY 1, 2)"


@query("G2_adjacency", f"SELECT a, b, length FROM {EDGES} e")
def _(t):
    return P.adjacency(t.cells, "zone_id")


LIMITS = {k: 10.0 + 3 * k for k in range(1, 13)}
SMALL = "n_cells < 10 + 3 * dl"


@query("G3_candidates", f"SELECT zone_id, dl, n_cells, least(x1 - x0, y1 - y0) AS width FROM zones WHERE {SMALL} OR least(x1 - x0, y1 - y0) < 4")
def _(t):
    return P.candidates(t.zones, LIMITS, "dl", "n_cells", 4.0).select("zone_id", "dl", "n_cells", "width")


def merge_sql(first: str) -> str:
    # the class is taken coarse so that neighbours share it
    return (
        f"WITH z AS (SELECT zone_id, dl % 3 AS k, n_cells AS area, {SMALL} AS small FROM zones), n AS (SELECT a AS src, b AS dst, length FROM {EDGES} e UNION ALL SELECT b, a, length FROM {EDGES} e2), "
        f"t AS (SELECT n.src AS zone_id, n.dst AS target, row_number() OVER (PARTITION BY n.src ORDER BY {first} DESC, n.dst) AS q FROM n JOIN z s ON s.zone_id = n.src AND s.small JOIN z d ON d.zone_id = n.dst AND NOT d.small AND d.k = s.k) SELECT zone_id, target FROM t WHERE q = 1"
    )


def _targets(t, by):
    z = t.zones.withColumn("k", F.col("dl") % 3)
    small = P.candidates(z, LIMITS, "dl", "n_cells")
    return P.merge_targets(z, P.adjacency(t.cells, "zone_id"), small, "k", "n_cells", by)


@query("G4_merge_targets_area", merge_sql("d.area"))
def _(t):
    return _targets(t, "area")


@query("G4_merge_targets_length", merge_sql("n.length"))
def _(t):
    return _targets(t, "length")


@query("G4_merge_loop")
def _(t):
    merged = P.merge_small(t.cells.select("r", "c", "zone_id", (F.col("dl") % 3).alias("k")), "zone_id", "k", 41, pairing=True)
    return merged.groupBy("zone_id").agg(F.count("*").alias("n_cells"))


@query(
    "G5_merge_groups",
    f"WITH RECURSIVE z AS (SELECT zone_id, n_cells AS area FROM zones), m AS (SELECT zone_id FROM z WHERE area < 33), n AS (SELECT a AS src, b AS dst FROM {EDGES} e UNION ALL SELECT b, a FROM {EDGES} e2), "
    "w AS (SELECT src, dst FROM n WHERE src IN (SELECT zone_id FROM m) AND dst IN (SELECT zone_id FROM m)), reach AS (SELECT src AS node, src AS pt FROM w UNION SELECT reach.node, w.dst FROM reach JOIN w ON w.src = reach.pt), "
    "g AS (SELECT node AS zone_id, min(pt) AS target FROM reach GROUP BY 1), t AS (SELECT n.src AS zone_id, n.dst AS target, row_number() OVER (PARTITION BY n.src ORDER BY z.area DESC, n.dst) AS q FROM n JOIN z ON z.zone_id = n.dst WHERE n.src IN (SELECT zone_id FROM m) AND n.src NOT IN (SELECT zone_id FROM g)) "
    "SELECT CAST(zone_id AS BIGINT) AS zone_id, CAST(target AS BIGINT) AS target FROM g UNION ALL SELECT CAST(zone_id AS BIGINT), CAST(target AS BIGINT) FROM t WHERE q = 1",
)
def _(t):
    return P.merge_groups(t.cells.select("r", "c", F.col("zone_id").cast("long").alias("zone_id")), "zone_id", 33)


HALF = "SELECT zone_id, r, c, 2 * part + CASE WHEN c1 - c0 >= r1 - r0 THEN CAST(2 * c > c0 + c1 AS BIGINT) ELSE CAST(2 * r > r0 + r1 AS BIGINT) END AS split, part, n > 12 AS big FROM (SELECT *, count(*) OVER w AS n, min(r) OVER w AS r0, max(r) OVER w AS r1, min(c) OVER w AS c0, max(c) OVER w AS c1 FROM {} WINDOW w AS (PARTITION BY zone_id, part))"


def halved(level: int) -> str:
    src = "(SELECT zone_id, r, c, 1 AS part FROM cells)"
    ctes = []
    for i in range(level):
        ctes.append(f"h{i} AS (SELECT zone_id, r, c, CASE WHEN big THEN split ELSE part END AS part FROM ({HALF.format(src)}) q{i})")
        src = f"h{i}"
    return "WITH " + ", ".join(ctes) + f" SELECT zone_id, r, c, CAST(part AS BIGINT) AS part FROM {src}"


@query("G6_split_oversized", halved(4))
def _(t):
    return P.split_oversized(t.cells.select("zone_id", "r", "c"), "zone_id", 12)


HOLE = "(r % 10 BETWEEN 3 AND 4) AND (c % 12 BETWEEN 4 AND 6)"


@query(
    "G7_fill_holes",
    region_sql(f"SELECT CAST(r AS BIGINT) AS r, CAST(c AS BIGINT) AS c, 1 AS v FROM cells WHERE {HOLE}") + ", span AS (SELECT min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1 FROM cells), "
    f"open AS (SELECT DISTINCT label FROM src JOIN lab ON src.r * {ROW} + src.c = node, span WHERE r IN (r0, r1) OR c IN (c0, c1)), "
    f"t AS (SELECT label, n.zone_id, count(*) AS k FROM src a JOIN lab ON a.r * {ROW} + a.c = node JOIN cells n ON n.r BETWEEN a.r - 1 AND a.r + 1 AND n.c BETWEEN a.c - 1 AND a.c + 1 AND {STEP4} WHERE NOT ((n.r % 10 BETWEEN 3 AND 4) AND (n.c % 12 BETWEEN 4 AND 6)) GROUP BY 1, 2), "
    "b AS (SELECT label, zone_id FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY k DESC, zone_id) AS q FROM t) x WHERE q = 1 AND label NOT IN (SELECT label FROM open)) "
    f"SELECT CAST(zone_id AS BIGINT) AS zone_id, count(*) AS n_cells FROM (SELECT zone_id FROM cells WHERE NOT ({HOLE}) UNION ALL SELECT b.zone_id FROM src JOIN lab ON src.r * {ROW} + src.c = node LEFT JOIN b USING (label)) u GROUP BY 1",
)
def _(t):
    holed = t.cells.select("r", "c", F.when(F.expr(HOLE), None).otherwise(F.col("zone_id")).alias("zone_id"))
    return P.fill_holes(holed, "zone_id").groupBy("zone_id").agg(F.count("*").alias("n_cells"))


WATER = "WITH v AS (SELECT r, c FROM cells WHERE water = 1)"


@query("G8_buffer", f"{WATER} SELECT DISTINCT a.r, a.c FROM cells a JOIN v ON abs(a.r-v.r) <= 3 AND abs(a.c-v.c) <= 3 AND (a.r-v.r)*(a.r-v.r)+(a.c-v.c)*(a.c-v.c) <= 9")
def _(t):
    return G.distance(t.cells.select("r", "c", "water"), F.col("water") == 1, 3).filter("distance is not null").select("r", "c")


@query("G8_envelope", "SELECT min(c) AS x0, min(r) AS y0, max(c) + 1 AS x1, max(r) + 1 AS y1 FROM cells WHERE water = 1")
def _(t):
    return t.cells.filter("water = 1").agg(F.min("c").alias("x0"), F.min("r").alias("y0"), (F.max("c") + 1).alias("x1"), (F.max("r") + 1).alias("y1"))


CLOSED = f"SELECT CAST(r AS BIGINT) AS r, CAST(c AS BIGINT) AS c, v FROM (WITH x AS ({ext('max', 'cells', 'water')}), y AS ({ext('min', 'x', 'v')}) SELECT r, c, v FROM y) q WHERE v = 1"


@query("G9_close_and_clean", f"{region_sql(CLOSED)}, s AS (SELECT label, count(*) AS n FROM lab GROUP BY 1) SELECT label, n FROM s WHERE n >= 4")
def _(t):
    closed = G.morphology(t.cells.select("r", "c", "water"), "water", "close").filter("water = 1")
    return P.drop_small_regions(closed, "water", 4).groupBy("label").agg(F.count("*").alias("n"))


@query(
    "G10_sample_edges",
    "SELECT DISTINCT a, b FROM (SELECT p.site_id AS a, q.site_id AS b FROM sites p JOIN sites q ON p.site_id < q.site_id AND (p.x-q.x)*(p.x-q.x)+(p.y-q.y)*(p.y-q.y) <= 4 "
    "UNION ALL SELECT first, site_id FROM (SELECT site_id, min(site_id) OVER (PARTITION BY cls, area_id) AS first FROM sites) g WHERE first < site_id) e",
)
def _(t):
    s = t.sites.select("site_id", "x", "y", "cls", "area_id")
    near = J.near_pairs(s, s, 2.0).filter("site_id < n_site_id").select(F.col("site_id").alias("a"), F.col("n_site_id").alias("b"))
    # a class is linked as a star: all of it hangs on its smallest site, and edges grow with the sites
    first = s.groupBy("cls", "area_id").agg(F.min("site_id").alias("a"))
    same = s.join(first, ["cls", "area_id"]).filter("a < site_id").select("a", F.col("site_id").alias("b"))
    return near.unionByName(same).distinct()


ALIKE = "1 - (abs(a.ph / p - b.ph / p) + abs(a.val / v - b.val / v) + CASE WHEN a.cls <> b.cls THEN 1 ELSE 0 END) / 3"
SPANS = "WITH m AS (SELECT max(ph) - min(ph) AS p, max(val) - min(val) AS v FROM sites)"


@query("G11_gower_pairs", f"{SPANS} SELECT a.site_id AS a, b.site_id AS b, round({ALIKE}, 4) AS similarity FROM sites a JOIN sites b ON a.site_id < b.site_id, m WHERE {ALIKE} >= 0.9")
def _(t):
    return rounded(P.gower_pairs(t.sites, "site_id", ["ph", "val"], ["cls"], 0.9), "similarity")


@query("G11_gower_links", f"{SPANS}, g AS (SELECT a.site_id, count(*) AS n FROM sites a JOIN sites b ON a.site_id <> b.site_id, m WHERE {ALIKE} >= 0.9 GROUP BY 1), k AS (SELECT ph, val, cls, min(site_id) AS representative FROM sites GROUP BY ALL) "
       "SELECT site_id, representative, coalesce(n, 0) AS n_links FROM sites JOIN k USING (ph, val, cls) LEFT JOIN g USING (site_id)")
def _(t):
    return P.gower_links(t.sites.select("site_id", "ph", "val", "cls"), "site_id", ["ph", "val"], ["cls"], 0.9)


ZV = "z AS (SELECT zone_id, avg(b2) AS v FROM cells GROUP BY 1), l AS (SELECT DISTINCT a.zone_id AS s, n.zone_id AS d FROM cells a JOIN cells n ON n.r BETWEEN a.r - 1 AND a.r + 1 AND n.c BETWEEN a.c - 1 AND a.c + 1 WHERE a.zone_id <> n.zone_id)"


def zone_values(t):
    return t.cells.groupBy("zone_id").agg(F.avg("b2").alias("v"))


@query("G12_spatial_lag", f"WITH {ZV} SELECT z.zone_id, round(avg(n.v), 6) AS lag FROM z LEFT JOIN l ON l.s = z.zone_id LEFT JOIN z n ON n.zone_id = l.d GROUP BY 1")
def _(t):
    return rounded(P.spatial_lag(zone_values(t), P.contiguity(t.cells, "zone_id"), "zone_id", "v").select("zone_id", "lag"), "lag", digits=6)


@query(
    "G12_moran",
    f"WITH {ZV}, y AS (SELECT zone_id, v - (SELECT avg(v) FROM z) AS v FROM z), g AS (SELECT y.zone_id, any_value(y.v) AS v, avg(n.v) AS lag FROM y LEFT JOIN l ON l.s = y.zone_id LEFT JOIN y n ON n.zone_id = l.d GROUP BY 1) SELECT round(sum(v * lag) / count(lag) * count(*) / sum(v * v), 5) AS i FROM g",
)
def _(t):
    return rounded(P.moran(zone_values(t), P.contiguity(t.cells, "zone_id"), "zone_id", "v"), "i", digits=5)


@query("G12_moran_test")
def _(t):
    return rounded(P.moran_test(zone_values(t), P.contiguity(t.cells, "zone_id"), "zone_id", "v", 99), "i", "expected", "mean", "std", "p", digits=5)


@query("G13_diameter", "SELECT zone_id, round(sqrt((x1-x0)*(x1-x0)+(y1-y0)*(y1-y0)), 4) AS diameter FROM zones")
def _(t):
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    return t.zones.select("zone_id", F.round(F.sqrt(dx * dx + dy * dy), 4).alias("diameter"))


KEYED = "SELECT CAST(r AS BIGINT) AS r, CAST(c AS BIGINT) AS c, concat_ws('|', zone_id, dz, pos) AS v FROM cells"


@query("J13_identity_parts", f"{region_sql(KEYED)} SELECT label, min(v) AS key, count(*) AS n_cells FROM src JOIN lab ON src.r * {ROW} + src.c = node GROUP BY 1")
def _(t):
    named = P.regions(t.cells.withColumn("key", F.concat_ws("|", "zone_id", "dz", "pos")), "key")
    return named.groupBy("label").agg(F.min("v").alias("key"), F.count("*").alias("n_cells"))


@query("A22_dissolve_parts", f"{region_sql(BLOCK)} SELECT label, min(v) AS dl, count(*) * 1.0 AS area FROM src JOIN lab ON src.r * {ROW} + src.c = node GROUP BY 1")
def _(t):
    return A.dissolve(P.regions(t.cells, "dl").select("r", "c", F.col("v").alias("dl"), "label"), ["label"], ["dl"]).select("label", "dl", "area")


SMOOTH = (
    "WITH k AS (SELECT a.r, a.c, n.dz AS v FROM cells a JOIN cells n ON n.r BETWEEN a.r - 1 AND a.r + 1 AND n.c BETWEEN a.c - 1 AND a.c + 1 AND (a.r <> n.r OR a.c <> n.c) GROUP BY 1, 2, 3 HAVING count(*) >= 5) "
    "SELECT CAST(cells.r AS BIGINT) AS r, CAST(cells.c AS BIGINT) AS c, coalesce(k.v, cells.dz) AS v FROM cells LEFT JOIN k ON cells.r = k.r AND cells.c = k.c"
)
GAP = "({a}.r-{b}.r)*({a}.r-{b}.r)+({a}.c-{b}.c)*({a}.c-{b}.c)"


@query(
    "F20_generalise",
    f"{region_sql(SMOOTH)}, s AS (SELECT label, count(*) AS n FROM lab GROUP BY 1), kept AS (SELECT r, c, v FROM src JOIN lab ON src.r * {ROW} + src.c = node JOIN s USING (label) WHERE n >= 20), lost AS (SELECT * FROM src WHERE r * {ROW} + c NOT IN (SELECT r * {ROW} + c FROM kept)), "
    f"b AS (SELECT lost.v AS old, kept.v AS new, row_number() OVER (PARTITION BY lost.r, lost.c ORDER BY {GAP.format(a='lost', b='kept')}, kept.r, kept.c) AS q FROM lost LEFT JOIN kept ON true) "
    "SELECT dz, count(*) AS n_cells FROM (SELECT v AS dz FROM kept UNION ALL SELECT coalesce(new, old) FROM b WHERE q = 1) u GROUP BY 1",
)
def _(t):
    g = P.generalise(t.cells.select("r", "c", "dz"), "dz", 20)
    return g.groupBy("dz").agg(F.count("*").alias("n_cells"))


def cleaned_sql(source: str) -> str:
    """Expand and shrink by priority (more cells first, then the smaller value) of ``source`` (r, c, v): ranks go up and down the list of values."""
    ranks = f"rk AS (SELECT v, row_number() OVER (ORDER BY count(*), -v) AS k FROM {source} WHERE v IS NOT NULL GROUP BY v), kd AS (SELECT r, c, k FROM {source} LEFT JOIN rk USING (v))"
    step = lambda a, b, f: f"{b} AS (SELECT a.r, a.c, CASE WHEN any_value(a.k) IS NOT NULL THEN {f}(n.k) END AS k FROM {a} a JOIN {a} n ON n.r BETWEEN a.r - 1 AND a.r + 1 AND n.c BETWEEN a.c - 1 AND a.c + 1 GROUP BY a.r, a.c)"
    return f"{ranks}, {step('kd', 'up', 'max')}, {step('up', 'dn', 'min')}, clean AS (SELECT r, c, v FROM dn LEFT JOIN rk USING (k))"


@query("F20_boundary_clean", f"WITH o AS (SELECT r, c, dz AS v FROM cells), {cleaned_sql('o')} SELECT r, c, v AS dz FROM clean")
def _(t):
    return P.boundary_clean(t.cells.select("r", "c", "dz"), "dz")


@query(
    "F21_rule_repair",
    f"WITH bad AS (SELECT r, c, dz FROM cells WHERE dl = 3 AND dz > 4), k AS (SELECT r, c, dz FROM cells WHERE dz <= 4), b AS (SELECT bad.r, bad.c, coalesce(k.dz, bad.dz) AS dz, row_number() OVER (PARTITION BY bad.r, bad.c ORDER BY {GAP.format(a='bad', b='k')}, k.r, k.c) AS q "
    "FROM bad LEFT JOIN k ON true) SELECT r, c, dz FROM b WHERE q = 1 UNION ALL SELECT r, c, dz FROM cells WHERE NOT (dl = 3 AND dz > 4)",
)
def _(t):
    # land class 3 may carry geology 1 to 4 only
    cells = t.cells.select("r", "c", "dl", "dz")
    known = ~((F.col("dl") == 3) & (F.col("dz") > 4))
    fixed = P.nearest_value(cells, known & (F.col("dz") <= 4), "dz")
    return cells.withColumn("_ok", known).join(fixed.select("r", "c", F.col("dz").alias("_new")), ["r", "c"]).select("r", "c", F.when(F.col("_ok"), F.col("dz")).otherwise(F.col("_new")).alias("dz"))


# --- flow

DROPS = [f"(z - n{i}){' / sqrt(2)' if i % 2 else ''}" for i in range(8)]
BEST = f"greatest({', '.join(DROPS)})"
DIR = "CASE WHEN z IS NULL THEN NULL " + " ".join(f"WHEN {d} = {BEST} AND {d} > 0 THEN {c}" for d, c in zip(DROPS, H.CODES, strict=True)) + " ELSE 0 END"
HOOD = "h AS (SELECT a.r, a.c, any_value(a.dem) AS z, " + AT.format(b="dem") + " FROM " + NEAR.format(k=1) + " GROUP BY a.r, a.c)"


@query("H1_flow_direction", f"WITH {HOOD} SELECT r, c, {DIR} AS direction FROM h")
def _(t):
    return H.flow_direction(t.cells.select("r", "c", "dem"), "dem").drop("dem")


DOWN = "CASE d " + " ".join(f"WHEN {c} THEN node + ({dr * ROW + dc})" for (dr, dc), c in zip(G.AROUND, H.CODES, strict=True)) + " END"
FLOW = (
    f"WITH RECURSIVE {HOOD}, f AS (SELECT CAST(r AS BIGINT) * {ROW} + c AS node, {DIR} AS d FROM h), g AS (SELECT node, {DOWN} AS down FROM f WHERE d IS NOT NULL), "
    "walk AS (SELECT node AS start, node, down FROM g UNION ALL SELECT walk.start, g.node, g.down FROM walk JOIN g ON g.node = walk.down)"
)


@query("H2_flow_accumulation", f"{FLOW} SELECT CAST(node // {ROW} AS INT) AS r, CAST(node % {ROW} AS INT) AS c, count(*) AS acc FROM walk GROUP BY node")
def _(t):
    return H.flow_accumulation(t.cells, "dem").select("r", "c", "acc")


@query("H3_fill_sinks")
def _(t):
    return H.fill_sinks(t.cells, "dem").withColumn("depth", F.col("filled") - F.col("dem"))


@query("H1_flow_over_flats")
def _(t):
    # ground in steps of 40, then filled: flats everywhere
    stepped = t.cells.select("r", "c", (F.floor(F.col("dem") / 40) * 40.0).alias("dem"))
    return H.drained(stepped, "dem")


@query("H2_drained_accumulation")
def _(t):
    found = H.accumulate(H.downstream(H.drained(t.cells.select("r", "c", "dem"), "dem")))
    return found.select((F.col("node") / ROW).cast("int").alias("r"), (F.col("node") % ROW).cast("int").alias("c"), "acc")


@query("H4_channels", f"{FLOW} SELECT CAST(node // {ROW} AS INT) AS r, CAST(node % {ROW} AS INT) AS c, count(*) AS acc FROM walk GROUP BY node HAVING count(*) >= 12")
def _(t):
    return H.channels(H.flow_accumulation(t.cells, "dem"), 12).select("r", "c", "acc")


@query("H4_basins", f"{FLOW} SELECT node AS basin, count(*) AS n_cells FROM walk WHERE down IS NULL GROUP BY 1")
def _(t):
    return H.flow_accumulation(t.cells, "dem").groupBy("basin").agg(F.count("*").alias("n_cells"))


@query(
    "H4_channel_relief",
    f"{FLOW}, chan AS (SELECT node FROM walk GROUP BY node HAVING count(*) >= 12), k AS (SELECT g.node, CASE WHEN chan.node IS NULL THEN down END AS down FROM g LEFT JOIN chan ON chan.node = g.node), "
    "stop AS (SELECT node AS start, node, down FROM k UNION ALL SELECT stop.start, k.node, k.down FROM stop JOIN k ON k.node = stop.down), "
    f"z AS (SELECT r, c, CAST(r AS BIGINT) * {ROW} + c AS node, dem FROM cells WHERE dem IS NOT NULL), pit AS (SELECT start, node AS pit FROM walk WHERE down IS NULL), top AS (SELECT pit, max(dem) AS top FROM pit JOIN z ON z.node = start GROUP BY 1) "
    "SELECT z.r, z.c, b.dem AS base_level, z.dem - b.dem AS above, top - z.dem AS valley_depth FROM z JOIN stop ON stop.start = z.node AND stop.down IS NULL JOIN z b ON b.node = stop.node JOIN pit ON pit.start = z.node JOIN top ON top.pit = pit.pit",
)
def _(t):
    return H.channel_relief(t.cells, "dem", 12)


def accumulation_sql(sign: str) -> str:
    """(node, acc) by walking down the surface, or down the inverted one."""
    return f"{FLOW} SELECT node, count(*) AS acc FROM walk GROUP BY 1".replace("a.dem", f"{sign}a.dem").replace("n.dem", f"{sign}n.dem")


@query(
    "F26_ridge_valley",
    f"WITH RECURSIVE one AS (SELECT 1), up AS ({accumulation_sql('')}), down AS ({accumulation_sql('-')}), t AS (SELECT a.r, a.c, a.dem - avg(n.dem) AS tpi FROM {NEAR.format(k=3)} GROUP BY a.r, a.c, a.dem) "
    f"SELECT t.r, t.c, CASE WHEN tpi > 0 AND up.acc = 1 THEN 1 WHEN tpi < 0 AND down.acc = 1 THEN -1 ELSE 0 END AS line FROM t LEFT JOIN up ON up.node = CAST(t.r AS BIGINT) * {ROW} + t.c LEFT JOIN down ON down.node = CAST(t.r AS BIGINT) * {ROW} + t.c",
)
def _(t):
    return H.ridge_valley(t.cells.select("r", "c", "dem"), "dem", 3)
