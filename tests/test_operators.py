"""Edge cases and invariants on literal frames."""

from __future__ import annotations

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from loamworks.functions import scoring as S
from loamworks.operators import aggregates as A
from loamworks.operators import cleaning as C
from loamworks.operators import graph as P
from loamworks.operators import grid as G
from loamworks.operators import hydrology as H
from loamworks.operators import joins as J
from loamworks.operators import models as L
from loamworks.operators import quantiles as Q
from loamworks.operators import sampling as B
from loamworks.sources import tables as T
from loamworks.sources.fixtures import Tables


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def grid(spark, lines):
    return spark.createDataFrame([(r, c, None if v is None else float(v)) for r, line in enumerate(lines) for c, v in enumerate(line)], "r int, c int, v double")


def test_tidy_names(spark):
    df = spark.range(1).selectExpr("1 AS dem_mean", "2 AS dl_majority", "3 AS plain")
    assert C.tidy_names(df, renamed={"plain": "named"}).columns == ["dem", "dl", "named"]


def test_clean_numbers_on_nulls_and_dirt(spark):
    df = spark.createDataFrame([("1.5",), ("/",), ("3*",), (None,), ("x",), ("",)], "t string")
    assert [r[0] for r in C.clean_numbers(df, ["t"]).collect()] == [1.5, None, None, None, None, None]


def test_empty_frames(spark):
    e = spark.createDataFrame([], "k string, v double, x double, y double")
    assert A.area_by(e, "k", "v").count() == 1  # the total row
    assert A.class_shares(e, "k").count() == 0
    assert J.near_pairs(e, e, 1.0).count() == 0
    assert P.components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert S.natural_breaks(e, "v") == []


def test_membership_bounds(spark):
    v = spark.createDataFrame([(4.0,), (6.0,), (8.0,), (None,)], "v double")
    assert [r[0] for r in v.select(S.peak(F.col("v"), 4, 8, 0.5, 6)).collect()] == [0.0, 1.0, 0.0, None]
    assert [r[0] for r in v.select(S.lower_bound(F.col("v"), 4, 8, 0.5, 4)).collect()][:1] == [1.0]


def test_texture_corners(spark):
    df = spark.createDataFrame([(100.0, 0.0, 0.0), (0.0, 100.0, 0.0), (0.0, 0.0, 100.0)], "a double, b double, c double")
    assert [r[0] for r in df.select(S.texture_class(F.col("a"), F.col("b"), F.col("c"))).collect()] == ["Sand", "Silt", "Clay"]


def test_fit_yield_finds_the_curve(spark):
    df = spark.createDataFrame([(x / 10, 1500 / (1 + 4 * (x / 10 - 0.9) ** 2)) for x in range(1, 10)], "x double, y double")
    a, b, c = S.fit_yield(df, "x", "y")
    assert abs(a - 4) < 0.05 and abs(c - 0.9) < 0.01 and b == 1500


def test_point_on_no_polygon_and_concave_ring(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0), (0.0, 0.0)]
    poly = spark.createDataFrame([(1, [{"x": x, "y": y} for x, y in ring], 0.0, 0.0, 4.0, 4.0)], "pid int, ring array<struct<x:double,y:double>>, x0 double, y0 double, x1 double, y1 double")
    pts = spark.createDataFrame([(1, 2.0, 0.5), (2, 2.0, 3.0), (3, 9.0, 9.0), (4, None, 1.0)], "id int, x double, y double")
    assert rows(J.one_polygon_each(pts, poly, "id", "pid", 2.0).select("id", "pid")) == [(1, 1), (2, None), (3, None), (4, None)]


def test_nearest_grows_its_radius(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0)], "id int, x double, y double")
    b = spark.createDataFrame([(7, 5.0, 0.0), (8, 50.0, 0.0)], "id int, x double, y double")
    assert J.nearest(a, b, "id", 1.0, "id", bounded=True).count() == 0
    assert J.nearest(a, b, "id", 1.0, "id").select("n_id").first()[0] == 7
    assert [r["n_id"] for r in J.nearest(a, b, "id", None, "id", k=5).orderBy("rank").collect()] == [7, 8]
    assert J.nearest(a, b.limit(0), "id", None, "id").count() == J.nearest(a.limit(0), b, "id", 1.0, "id").count() == 0


def test_far_points_have_neighbours_too(spark):
    p = spark.createDataFrame([(i, float(i % 5), float(i // 5), float(i % 3)) for i in range(25)] + [(99, 1e6, 1e6, 50.0)], "id int, x double, y double, v double")
    near = J.nearest(p, p, "id", 0.5, "id", k=8, other=True)
    assert near.groupBy("id").count().filter("count = 8").count() == 26
    assert B.outlier_status(p, "id", "v", 0.5, 1e9, 3.0).filter("id = 99").first()["status"] == "LocalHighOutlier"
    assert B.local_outlier_factor(p, "id", 4).filter("lof is null").count() == 0


def test_absent_cells_hide_nothing(spark):
    g = spark.createDataFrame([(0, 0, 3.0), (1, 1, 5.0)], "r int, c int, v double")
    assert [r["focal_n"] for r in G.focal_statistics(g, "v", 1).collect()] == [2, 2]
    assert {(r["n1"], r["n5"]) for r in G.neighbours(g, "v").collect()} == {(5.0, None), (None, 3.0)}
    assert P.regions(g.withColumn("v", F.lit(1)), "v", eight=True).select("label").distinct().count() == 1
    assert sorted(r["distance"] for r in G.distance(g, F.col("v") == 3, 3).collect()) == [0.0, 2**0.5]
    assert P.adjacency(g.withColumn("z", F.col("v").cast("int")), "z", corners=True).count() == 1
    assert G.gaussian_density(g, F.col("v") == 3, 1.0).filter("density > 0").count() == 2
    assert G.padded(g, 2, 2).filter("not _own").count() == 8


def test_helpers_fill_gaps_only(spark):
    g = spark.range(100).selectExpr("cast(id div 10 as int) AS r", "cast(id % 10 as int) AS c")
    assert G.padded(g.filter("c <> 4"), 3, 3).groupBy("r", "c").count().filter("count > 1").count() == 0
    assert G.padded(g, 3, 3).count() == 100 + 10 * 6


def test_fill_is_the_lowest_pass(spark):
    import heapq

    cells = Tables(spark, DATA).cells.select("r", "c", "dem")
    z = {(r["r"], r["c"]): r["dem"] for r in cells.collect()}
    around = lambda p: [(p[0] + i, p[1] + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j]
    level = {p: v for p, v in z.items() if v is not None and any(z.get(q) is None for q in around(p))}
    heap = [(v, p) for p, v in level.items()]
    heapq.heapify(heap)
    done = set()
    while heap:
        v, p = heapq.heappop(heap)
        if p not in done:
            done.add(p)
            for q in around(p):
                if z.get(q) is not None and max(v, z[q]) < level.get(q, float("inf")):
                    level[q] = max(v, z[q])
                    heapq.heappush(heap, (level[q], q))
    assert {(r["r"], r["c"]): r["filled"] for r in H.fill_sinks(cells, "dem").collect()} == {p: level.get(p) for p in z}


def test_merge_loop_one_by_one(spark):
    cells = Tables(spark, DATA).cells.select("r", "c", "zone_id", (F.col("dl") % 3).alias("k"))
    rows_ = cells.collect()
    zone, k = {(r["r"], r["c"]): r["zone_id"] for r in rows_}, {(r["r"], r["c"]): r["k"] for r in rows_}
    while True:
        size, klass, touch = {}, {}, {}
        for p, z in zone.items():
            size[z] = size.get(z, 0) + 1
            klass[z] = min(klass.get(z, k[p]), k[p])
            for q in ((p[0], p[1] + 1), (p[0] + 1, p[1])):
                if q in zone and zone[q] != z:
                    touch.setdefault(z, set()).add(zone[q])
                    touch.setdefault(zone[q], set()).add(z)
        root = {z: z for z in size}

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        moved = False
        for z, n in size.items():
            best = min(((-size[o], o) for o in touch.get(z, ()) if klass[o] == klass[z]), default=None) if n < 41 else None
            if best:
                moved = True
                a, b = find(z), find(best[1])
                root[max(a, b)] = min(a, b)
        if not moved:
            break
        zone = {p: find(z) for p, z in zone.items()}
    assert {(r["r"], r["c"]): r["zone_id"] for r in P.merge_small(cells, "zone_id", "k", 41, pairing=True).collect()} == zone


def test_quantiles_are_percentiles(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "cast(pow(id % 97, 2) as double) AS p", "CASE WHEN id % 7 > 0 THEN cast(id as int) END AS q").unionByName(spark.createDataFrame([(5, None, 4)], "k long, p double, q int"))
    asked = {"a": ("p", 0.1), "b": ("p", 0.5), "c": ("q", 0.999), "d": ("q", 0.0)}
    assert rows(Q.quantiles(df, asked)) == rows(df.agg(*(F.percentile(c, s) for c, s in asked.values())))
    assert rows(Q.quantiles(df.filter("k < 5"), asked, ["k"])) == rows(df.filter("k < 5").groupBy("k").agg(*(F.percentile(c, s) for c, s in asked.values())))
    assert rows(Q.quantiles(df.limit(0), asked)) == [(None,) * 4] and Q.quantiles(df.limit(0), asked, ["k"]).count() == 0


def test_synthetic_samples_stay_in_range(spark):
    df = spark.createDataFrame([(i, "ab"[i % 2], float(i), float(-i)) for i in range(20)] + [(20, "a", None, 1.0)], "id int, k string, p double, q double")
    made = B.uniform_samples(df, "k", ["p", "q"], 50).groupBy("k").agg(F.count("*").alias("n"), F.min("p").alias("lo"), F.max("p").alias("hi")).collect()
    assert {r["n"] for r in made} == {50} and all(0 <= r["lo"] < r["hi"] <= 19 for r in made)
    near = B.samples_around(df, "id", "k", ["p", "q"], 0.1, 4, apart=0.02).join(df.select("id", F.col("p").alias("_p")), "id").collect()
    assert near and all(abs(r["p"] - r["_p"]) <= 1.8 and 0 <= r["p"] <= 19 for r in near)


def test_representatives_of_all_classes(spark):
    df = spark.createDataFrame([(i, i % 3, float(i % 7 // 4 * 100 + i % 2), 0.0) for i in range(60)], "id int, k int, p double, q double")
    found = L.representatives(df, "id", "k", ["p", "q"], 2)
    assert found.groupBy("k").count().filter("count = 2").count() == 3 and found.columns == ["id", "k", "cluster"]


def test_slope_of_a_plane(spark):
    g = grid(spark, [[c * 10 for c in range(4)] for _ in range(4)])
    inner = G.slope_aspect(g, "v", 10.0).filter("r in (1, 2) and c in (1, 2)").collect()
    assert all(abs(r["slope"] - 45) < 1e-9 and abs(r["aspect"] - 270) < 1e-9 for r in inner)


def test_all_null_band(spark):
    g = grid(spark, [[None] * 3] * 3)
    assert G.focal_statistics(g, "v", 1).select("focal_mean").distinct().collect()[0][0] is None
    assert G.fill_gaps(g, "v").filter("v is not null").count() == 0
    assert G.texture(g, "v").count() == 0


def test_five_square_components(spark):
    edges = spark.createDataFrame([(0, 1), (1, 2), (3, 4), (2, 2), (None, 1)], "a long, b long")
    assert rows(P.components(edges)) == [(0, 0), (1, 0), (2, 0), (3, 3), (4, 3)]


def test_long_chain_is_one_component(spark):
    edges = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    assert P.components(edges).select("label").distinct().collect()[0][0] == 0


def test_merge_conserves_cells_and_ends(spark):
    t = Tables(spark, DATA)
    cells = t.cells.select("r", "c", "zone_id", (F.col("dl") % 3).alias("k"))
    merged = P.merge_small(cells, "zone_id", "k", 41, pairing=True)
    assert merged.count() == cells.count()
    assert merged.select("zone_id").distinct().count() < cells.select("zone_id").distinct().count()


def test_split_is_below_the_limit(spark):
    g = spark.range(200).selectExpr("1 AS z", "cast(id div 20 as int) AS r", "cast(id % 20 as int) AS c")
    assert P.split_oversized(g, "z", 16).groupBy("part").count().agg(F.max("count")).first()[0] <= 16


def test_hole_takes_its_neighbour(spark):
    g = grid(spark, [[1, 1, 1, 2], [1, None, 1, 2], [1, 1, 1, None]]).withColumn("z", F.col("v").cast("int")).drop("v")
    filled = {(r["r"], r["c"]): r["z"] for r in P.fill_holes(g, "z").collect()}
    assert filled[1, 1] == 1 and filled[2, 3] is None  # the second gap reaches the edge


def test_bowl_flows_to_its_pit_and_fills(spark):
    bowl = [[9, 9, 9, 9, 9], [9, 5, 5, 5, 9], [9, 5, 1, 5, 9], [9, 5, 5, 5, 9], [9, 9, 9, 9, 8]]
    g = grid(spark, bowl)
    flow = {(r["r"], r["c"]): r["acc"] for r in H.flow_accumulation(g, "v").collect()}
    assert flow[2, 2] >= 17
    filled = {(r["r"], r["c"]): r["filled"] for r in H.fill_sinks(g, "v", tile=2).collect()}
    assert filled[2, 2] == 8 and filled[1, 1] == 8 and filled[0, 0] == 9


def test_fill_is_the_same_for_any_tile(spark):
    g = Tables(spark, DATA).cells.filter("r < 12 and c < 40")
    assert rows(H.fill_sinks(g, "dem", 5)) == rows(H.fill_sinks(g, "dem", 64))


def test_outlier_status_needs_neighbours(spark):
    p = spark.createDataFrame([(i, float(i), 0.0, 1.0) for i in range(5)] + [(9, 1.0, 1.0, None)], "id int, x double, y double, v double")
    assert {r["status"] for r in B.outlier_status(p, "id", "v", 2.0).collect()} == {"Normal", None}


def test_copies_reach_the_minimum(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), ("b", 3)], "k string, v int")
    n = {r["k"]: r["count"] for r in B.copy_small_groups(df, ["k"], 3).groupBy("k").count().collect()}
    assert n == {"a": 3, "b": 3}
    again = [rows(B.resample_small_groups(df, ["k"], 5, ["v"])) for _ in range(2)]
    assert again[0] == again[1] and len(again[0]) == 10


def test_elbow():
    assert L.elbow([(2, 100.0), (3, 40.0), (4, 35.0), (5, 31.0)]) == 3


def test_sources_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, t string")
    df.coalesce(1).write.csv(str(tmp_path / "in" / "one_site.csv"), header=True)
    assert rows(T.read_csv(spark, str(tmp_path / "in" / "one_site.csv"), "id int, t string", ["id"])) == [(1,), (2,)]
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "x_site_1.csv").write_text("id,t\n5,b\n")
    (tmp_path / "deep" / "other.csv").write_text("id,t\n6,c\n")
    assert rows(T.read_named(spark, str(tmp_path / "deep"), "site", "id int, t string")) == [(5, "b")]
    g = grid(spark, [[1, 2, 3], [4, 5, 6]])
    T.write_grid(g, str(tmp_path / "g"), 2)
    assert rows(T.read_grid(spark, str(tmp_path / "g"), 0, 2, 1, 3, 2)) == [(0, 1, 2.0), (0, 2, 3.0), (1, 1, 5.0), (1, 2, 6.0)]
    T.write_reports({"a": df}, str(tmp_path / "rep"))
    assert (tmp_path / "rep" / "a" / "_SUCCESS").exists()


def test_catalog_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS soil LOCATION '{tmp_path}/soil.db'")
    for n in (3, 2):
        T.replace_table(spark.range(n), "soil.sites")
    assert T.tables_of(spark, "soil") == ["sites"] and T.read_table(spark, "soil.sites").count() == 2
    spark.sql("DROP DATABASE soil CASCADE")


def test_scan_logs(spark, tmp_path):
    (tmp_path / "a.log").write_text("fine\nWarning at 123456 and 654321\n\nan ERROR\n")
    assert rows(T.scan_logs(spark, str(tmp_path))) == sorted([("a.log", 2, "warning", "123456"), ("a.log", 4, "error", None)], key=str)


def test_safe_names(spark):
    assert T.safe_names(spark.range(1).selectExpr("1 AS elevation_mean", "2 AS elevation_max", "3 AS z")).columns == ["elevation_", "elevatio_1", "z"]


def test_monthly_mean_stream(spark, tmp_path):
    from loamworks.streaming.climate import monthly_mean_stream

    df = spark.sql("SELECT 1 AS area, timestamp'2024-01-05' AS ts, 2.0D AS v UNION ALL SELECT 1, timestamp'2024-01-09', 4.0D UNION ALL SELECT 1, timestamp'2024-06-01', 1.0D")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = monthly_mean_stream(stream, "area", "ts", "v").writeStream.format("memory").queryName("months").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert rows(spark.table("months").drop("month")) == [(1, 1.0, 1), (1, 3.0, 2)]


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("method", ["truncate", "mean", "median"])
def test_treatment_keeps_nulls(spark, method):
    df = spark.createDataFrame([(1.0,), (1.0,), (100.0,), (None,)], "v double")
    assert S.treat_outliers(df, "v", 1.0, method).filter("v is null").count() == 1
