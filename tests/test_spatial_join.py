"""Grid spatial join: equal to a brute-force check on random data, left-join
semantics, and a plan without Cartesian products."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gridwise.functions.geometry import geom_from_geojson
from gridwise.functions import geometry as G
from gridwise.functions.crs import st_transform
from gridwise.operators.spatial_join import (plan_grid, polygon_cells, spatial_join,
                                             within_candidates)


def _inside(px, py, rings):
    """Independent even-odd reference with boundary exclusion."""
    n = 0
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            cross = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
            if cross == 0 and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
                return False
            if (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1:
                n += 1
    return n % 2 == 1


def _polys(rng, count):
    out = []
    for i in range(count):
        x0, y0 = rng.randint(0, 40), rng.randint(0, 40)
        w, h = rng.randint(1, 12), rng.randint(1, 12)
        outer = [(x0, y0), (x0 + w, y0), (x0 + w, y0 + h), (x0, y0 + h), (x0, y0)]
        rings = [outer]
        if w > 3 and h > 3 and i % 3 == 0:
            rings.append([(x0 + 1, y0 + 1), (x0 + 2, y0 + 1), (x0 + 2, y0 + 2),
                          (x0 + 1, y0 + 2), (x0 + 1, y0 + 1)])
        if i % 5 == 1:   # a triangle instead
            rings = [[(x0, y0), (x0 + w, y0), (x0, y0 + h), (x0, y0)]]
        out.append((i, rings))
    return out


def _geojson(rings):
    return ('{"type":"Polygon","coordinates":['
            + ",".join("[" + ",".join(f"[{x},{y}]" for x, y in r) + "]" for r in rings) + "]}")


@pytest.mark.parametrize("seed,limit,salt", [(1, None, 1), (2, None, 1), (3, 0, 1), (4, 0, 5)])
def test_grid_join_equals_brute_force(spark, seed, limit, salt):
    rng = random.Random(seed)
    polys = _polys(rng, 40)
    # half the points on the integer grid, so many lie exactly on edges
    pts = [(j, float(rng.randint(0, 52)) if j % 2 else rng.uniform(0, 52),
            float(rng.randint(0, 52)) if j % 2 else rng.uniform(0, 52)) for j in range(600)]
    pdf = spark.createDataFrame(pts, "pid long, x double, y double")
    gdf = spark.createDataFrame([(i, _geojson(r)) for i, r in polys], "gid long, t string") \
        .select("gid", geom_from_geojson(F.col("t")).alias("geom"))
    kw = {"salt": salt} if limit is None else {"broadcast_limit": limit, "salt": salt}
    got = sorted((r.pid, r.gid) for r in spatial_join(pdf, gdf, **kw).select("pid", "gid").collect())
    want = sorted((pid, gid) for pid, x, y in pts for gid, rings in polys if _inside(x, y, rings))
    assert got == want


def test_left_join_keeps_misses(spark):
    pdf = spark.createDataFrame([(1, 1.0, 1.0), (2, 50.0, 50.0)], "pid long, x double, y double")
    gdf = spark.createDataFrame([(7, '{"type":"Polygon","coordinates":[[[0,0],[2,0],[2,2],[0,2],[0,0]]]}')],
                                "gid long, t string").select("gid", geom_from_geojson(F.col("t")).alias("geom"))
    got = sorted((r.pid, r.gid) for r in spatial_join(pdf, gdf, how="left").collect())
    assert got == [(1, 7), (2, None)]


def test_candidates_flag_boundary(spark):
    pdf = spark.createDataFrame([(1, 2.0, 1.0), (2, 1.0, 1.0)], "pid long, x double, y double")
    gdf = spark.createDataFrame([(7, '{"type":"Polygon","coordinates":[[[0,0],[2,0],[2,2],[0,2],[0,0]]]}')],
                                "gid long, t string").select("gid", geom_from_geojson(F.col("t")).alias("geom"))
    got = sorted((r.pid, r.within) for r in within_candidates(pdf, gdf).collect())
    assert got == [(1, False), (2, True)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_has_equi_join_not_cartesian(spark):
    pdf = spark.range(100).select(F.col("id").alias("pid"), (F.col("id") % 10).cast("double").alias("x"),
                                  (F.col("id") % 7).cast("double").alias("y"))
    gdf = spark.createDataFrame([(7, '{"type":"Polygon","coordinates":[[[0,0],[5,0],[5,5],[0,5],[0,0]]]}')],
                                "gid long, t string").select("gid", geom_from_geojson(F.col("t")).alias("geom"))
    for limit in (None, 0):
        kw = {} if limit is None else {"broadcast_limit": limit}
        plan = _plan(spatial_join(pdf, gdf, **kw))
        assert "CartesianProduct" not in plan
        assert "BroadcastNestedLoopJoin" not in plan
        assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_layer_above_the_bound_is_not_broadcast(spark, tmp_path):
    """A small file of few rows whose polygons have many edges."""
    spark.range(3).write.parquet(f"{tmp_path}/layer")
    ring = F.transform(F.sequence(F.lit(0), F.lit(2000)), lambda i: F.struct(
        (F.col("id") + 0.4 * F.cos(i % 2000 * math.pi / 1000)).alias("x"),
        (F.col("id") + 0.4 * F.sin(i % 2000 * math.pi / 1000)).alias("y")))
    gdf = spark.read.parquet(f"{tmp_path}/layer").select(F.col("id").alias("gid"), F.struct(
        F.lit(0).alias("srid"), F.lit(2).alias("dim"), F.array(F.array(ring)).alias("parts")).alias("geom"))
    pdf = spark.range(40).select(F.col("id").alias("pid"), (F.col("id") / 10).alias("x"),
                                 (F.col("id") / 10).alias("y"))
    joined = spatial_join(pdf, gdf, broadcast_limit=1 << 20)
    assert "Broadcast" not in _plan(joined)
    assert {(r.pid, r.gid) for r in joined.collect()} == {
        (p, g) for p in range(40) for g in range(3) if 2 * (p / 10 - g) ** 2 < 0.16}


def _star(cx, cy, r_out, r_in, n):
    import math
    pts = []
    for k in range(2 * n):
        r = r_out if k % 2 == 0 else r_in
        a = math.pi * k / n
        pts.append((round(cx + r * math.cos(a), 6), round(cy + r * math.sin(a), 6)))
    return pts + [pts[0]]


def test_many_vertex_stars_and_multipolygons(spark):
    rng = random.Random(11)
    polys = []
    for i in range(25):
        cx, cy = rng.uniform(5, 45), rng.uniform(5, 45)
        rings = [_star(cx, cy, rng.uniform(3, 8), rng.uniform(1, 3), rng.randint(20, 120))]
        polys.append((i, [rings] if i % 4 else [rings, [_star(cx + 20, cy, 2, 1, 15)]]))
    pts = [(j, rng.uniform(0, 70), rng.uniform(0, 50)) for j in range(800)]

    def gj(parts):
        body = ",".join("[" + ",".join("[" + ",".join(f"[{x},{y}]" for x, y in r) + "]"
                                         for r in part) + "]" for part in parts)
        return '{"type":"MultiPolygon","coordinates":[' + body + ']}'

    pdf = spark.createDataFrame(pts, "pid long, x double, y double")
    gdf = spark.createDataFrame([(i, gj(p)) for i, p in polys], "gid long, t string") \
        .select("gid", geom_from_geojson(F.col("t")).alias("geom"))
    got = sorted((r.pid, r.gid) for r in spatial_join(pdf, gdf).select("pid", "gid").collect())
    want = sorted((pid, gid) for pid, x, y in pts for gid, parts in polys
                  if any(_inside(x, y, part) for part in parts))
    assert got == want


def _square(x, y, side):
    return _geojson([[(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]])


@pytest.mark.parametrize("limit", [None, 0])
def test_one_giant_polygon_leaves_small_cells_small(spark, limit):
    shapes = [(i, _square(i % 50, i // 50, 1)) for i in range(2500)] + [(9999, _square(-10, -10, 2000))]
    gdf = spark.createDataFrame(shapes, "gid long, t string").select(
        "gid", geom_from_geojson(F.col("t")).alias("geom"))
    grid = plan_grid(gdf)
    assert len(grid.levels) == 2 and grid.est_bytes > 2501 * 4 * 5 * 88
    cells = polygon_cells(gdf, "geom").groupBy("_g_level", "_g_cx", "_g_cy").count()
    assert cells.agg(F.max("count")).first()[0] <= 9
    assert polygon_cells(gdf, "geom").count() <= 4 * 2501
    pts = spark.range(400).select("id", (F.col("id") % 50 + 0.5).alias("x"),
                                  (F.col("id") % 7 + 0.25).alias("y"))
    pts = pts.unionByName(spark.createDataFrame([(900, 60.0, 60.0), (901, None, 1.0), (902, -99.0, 0.0)],
                                                "id long, x double, y double"))
    kw = {} if limit is None else {"broadcast_limit": limit}
    rows = spatial_join(pts, gdf, how="left", **kw).groupBy("id").agg(F.count("gid").alias("n")).collect()
    assert {r.id: r.n for r in rows} == {**{i: 2 for i in range(400)}, 900: 1, 901: 0, 902: 0}
    assert spatial_join(pts, gdf, **kw).count() == 801


def test_geometry_functions_tell_two_frames_apart(spark):
    """Expressions over a column of the same name in two joined frames."""
    def frame(key, x):
        return spark.createDataFrame([(1, _square(x, x, 2))], f"{key} int, t string").select(
            key, geom_from_geojson(F.col("t")).alias("geom"))

    a, b = frame("k", 0), frame("j", 8)
    both = a.join(b, a["k"] == b["j"])
    for f in (lambda g: G.st_x(G.st_centroid(g)), lambda g: G.bbox(g)["minx"],
              lambda g: G.polygon_edges(g)[0]["x1"], lambda g: G.to_geojson(g),
              lambda g: G.st_within(F.lit(1.0), F.lit(1.0), g),
              lambda g: st_transform(g)["parts"][0][0][0]["x"],
              lambda g: G.within_edges(F.lit(1.0), F.lit(1.0), G.polygon_edges(g))):
        row = both.select(f(a["geom"]).alias("p"), f(b["geom"]).alias("q")).first()
        assert row.p != row.q
    # and each still works on a frame of its own
    assert a.select(G.st_x(G.st_centroid(F.col("geom"))).alias("x")).first().x == 1.0


def _disc(n, x=5.0, y=5.0, r=3.0):
    ring = [(x + r * math.cos(2 * math.pi * k / n), y + r * math.sin(2 * math.pi * k / n))
            for k in range(n)]
    return _geojson([ring + ring[:1]])


def test_edge_tests_do_not_grow_with_vertices(spark):
    most, mean = {}, {}
    for n in (100, 1000, 10_000):
        gdf = spark.createDataFrame([(1, _disc(n))], "gid long, t string").select(
            "gid", geom_from_geojson(F.col("t")).alias("geom"))
        cells = polygon_cells(gdf, "geom").select(F.size("_g_edges").alias("n")).cache()
        most[n] = cells.agg(F.max("n")).first()[0]
        mean[n] = cells.agg(F.avg("n")).first()[0]
        assert cells.agg(F.sum("n")).first()[0] <= 8 * n
        plan = plan_grid(gdf)
        assert plan.levels[0][1] > 0 and plan.est_bytes >= 96 * cells.agg(F.sum("n")).first()[0]
    assert max(mean.values()) < 8 and max(most.values()) <= 24


@pytest.mark.parametrize("limit", [None, 0])
def test_slabs_equal_all_edges(spark, limit):
    """Gaps between parts, holes, long edges, points on vertices and edges, and layers
    that mix polygons of few and of many edges."""
    rng = random.Random(5)
    comb = [(0.0, 0.0)] + [(i / 4, 9.0 if i % 2 else 1.0) for i in range(1, 60)] + [(15.0, 0.0), (0.0, 0.0)]
    disc = [(5 + 3 * math.cos(k / 20), 5 + 3 * math.sin(k / 20)) for k in range(126)]
    disc += disc[:1]
    low = [(x, y - 20) for x, y in disc]
    hole = [(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0), (4.0, 4.0)]
    polys = [(1, [[comb]]), (2, [[disc, hole]]), (3, [[disc], [low]]), (4, [[hole]])]
    corners = [v for _, parts in polys for part in parts for ring in part for v in ring[::7]]
    pts = [(rng.choice(range(-80, 160)) / 8, rng.choice(range(-200, 100)) / 8) for _ in range(1500)] + corners
    pts = [(j, x, y) for j, (x, y) in enumerate(pts)]

    def gj(parts):
        body = ",".join("[" + ",".join("[" + ",".join(f"[{x!r},{y!r}]" for x, y in r) + "]"
                                         for r in part) + "]" for part in parts)
        return '{"type":"MultiPolygon","coordinates":[' + body + ']}'

    pdf = spark.createDataFrame(pts, "pid long, x double, y double")
    gdf = spark.createDataFrame([(i, gj(p)) for i, p in polys], "gid long, t string") \
        .select("gid", geom_from_geojson(F.col("t")).alias("geom"))
    kw = {} if limit is None else {"broadcast_limit": limit}
    got = sorted((r.pid, r.gid) for r in spatial_join(pdf, gdf, **kw).select("pid", "gid").collect())
    flags = pdf.join(F.broadcast(gdf)).where(G.st_within("x", "y", "geom")).select("pid", "gid")
    assert got == sorted((r.pid, r.gid) for r in flags.collect())
    assert len(got) > 150
    both = sorted((r.pid, r.gid) for r in within_candidates(pdf, gdf).where("within")
                  .select("pid", "gid").collect())
    assert both == got
