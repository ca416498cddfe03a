"""Literal geometry cases (FIXTURES.md §3) for parsing, centroid, containment
and projection."""

import pytest
from pyspark.sql import functions as F

from gridwise.functions import geometry as G
from gridwise.functions.crs import st_transform, wgs84_to_rd

CENTROIDS = [
    ('{"type":"Point","coordinates":[4,52]}', (4.0, 52.0)),
    ('{"type":"Polygon","coordinates":[[[0,0],[2,0],[2,2],[0,2],[0,0]]]}', (1.0, 1.0)),
    ('{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4],[0,0]],'
     '[[0,0],[2,0],[2,2],[0,2],[0,0]]]}', (28 / 12, 28 / 12)),
    ('{"type":"MultiPolygon","coordinates":[[[[0,0],[2,0],[2,2],[0,2],[0,0]]],'
     '[[[10,0],[12,0],[12,2],[10,2],[10,0]]]]}', (6.0, 1.0)),
    ('{"type":"LineString","coordinates":[[0,0],[2,0],[2,2]]}', (1.5, 0.5)),
    ('{"type":"MultiPoint","coordinates":[[0,0],[2,4]]}', (1.0, 2.0)),
    ('{"type":"Polygon","coordinates":[[[0,0],[2,0],[0,0]]]}', (1.0, 0.0)),
    ('{"type":"Polygon","coordinates":[[[0,0],[0,2],[2,2],[2,0],[0,0]]]}', (1.0, 1.0)),
    ('{"type":"GeometryCollection","geometries":[{"type":"Point","coordinates":[9,9]},'
     '{"type":"Polygon","coordinates":[[[0,0],[2,0],[2,2],[0,2],[0,0]]]}]}', (1.0, 1.0)),
    ('{"type":"Point","coordinates":[]}', (None, None)),
    ('null', (None, None)),
]


def test_centroids(spark):
    df = spark.createDataFrame([(t,) for t, _ in CENTROIDS], "t string")
    c = G.st_centroid(G.geom_from_geojson(F.col("t")))
    got = {r.t: (r.x, r.y) for r in df.select("t", G.st_x(c).alias("x"),
                                               G.st_y(c).alias("y")).collect()}
    for text, (ex, ey) in CENTROIDS:
        x, y = got[text]
        if ex is None:
            assert x is None and y is None, text
        else:
            assert x == pytest.approx(ex) and y == pytest.approx(ey), text


def test_centroid_translation_invariant(spark):
    ring = [(0, 0), (3, 0), (3, 1), (1, 1), (1, 3), (0, 3), (0, 0)]
    rows = []
    for dx, dy in [(0.0, 0.0), (120000.5, 480000.25), (-7.5, 3.25)]:
        coords = ",".join(f"[{x + dx},{y + dy}]" for x, y in ring)
        rows.append((dx, dy, '{"type":"Polygon","coordinates":[[' + coords + ']]}'))
    df = spark.createDataFrame(rows, "dx double, dy double, t string")
    c = G.st_centroid(G.geom_from_geojson(F.col("t")))
    out = df.select("dx", "dy", G.st_x(c).alias("x"), G.st_y(c).alias("y")).collect()
    base = [r for r in out if r.dx == 0][0]
    for r in out:
        assert r.x - r.dx == pytest.approx(base.x, abs=1e-6)
        assert r.y - r.dy == pytest.approx(base.y, abs=1e-6)


SQUARE_WITH_HOLE = ('{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4],[0,0]],'
                    '[[1,1],[2,1],[2,2],[1,2],[1,1]]]}')
DIAMOND = '{"type":"Polygon","coordinates":[[[0,1],[1,0],[2,1],[1,2],[0,1]]]}'


@pytest.mark.parametrize("poly,x,y,expected", [
    (SQUARE_WITH_HOLE, 3.0, 3.0, True),      # inside
    (SQUARE_WITH_HOLE, 1.5, 1.5, False),     # inside the hole
    (SQUARE_WITH_HOLE, 2.0, 1.5, False),     # on the hole's edge
    (SQUARE_WITH_HOLE, 4.0, 2.0, False),     # on the outer edge
    (SQUARE_WITH_HOLE, 0.0, 0.0, False),     # on a vertex
    (SQUARE_WITH_HOLE, 5.0, 2.0, False),     # outside
    (DIAMOND, 0.5, 1.0, True),               # ray through a vertex counts once
    (DIAMOND, 1.0, 1.0, True),
    (DIAMOND, 1.9, 1.9, False),
])
def test_within(spark, poly, x, y, expected):
    df = spark.createDataFrame([(poly, x, y)], "g string, x double, y double")
    got = df.select(G.st_within("x", "y", G.geom_from_geojson(F.col("g"))).alias("w")).first().w
    assert got is expected


def test_within_null_and_non_area(spark):
    df = spark.createDataFrame([('{"type":"Point","coordinates":[1,1]}', 1.0, 1.0),
                                (None, 1.0, 1.0)], "g string, x double, y double")
    got = [r.w for r in df.select(G.st_within("x", "y", G.geom_from_geojson(F.col("g")))
                                  .alias("w")).collect()]
    assert got == [False, None]


def test_bad_geojson(spark):
    df = spark.createDataFrame([('{"type":"Circle","coordinates":[1,1]}',)], "t string")
    assert df.select(G.geom_from_geojson(F.col("t"), on_error="null").alias("g")).first().g is None
    with pytest.raises(Exception):
        df.select(G.geom_from_geojson(F.col("t")).alias("g")).collect()


def _nested(inner, depth):
    for _ in range(depth):
        inner = '{"type":"GeometryCollection","geometries":[' + inner + ']}'
    return inner


SQUARE = '{"type":"Polygon","coordinates":[[[0,0],[2,0],[2,2],[0,2],[0,0]]]}'


@pytest.mark.parametrize("text,expected", [
    (_nested('{"type":"Point","coordinates":[1,2]}', 2), (1.0, 2.0)),
    (_nested(SQUARE + "," + _nested('{"type":"Point","coordinates":[9,9]}', 3), 2), (1.0, 1.0)),
    (_nested('{"type":"Point","coordinates":[0,0]},' + _nested(SQUARE, 5), 1), (1.0, 1.0)),
    (_nested("", 3), (None, None)),
    (_nested(_nested("", 1) + ',{"type":"LineString","coordinates":[[0,0],[4,0]]}', 1), (2.0, 0.0)),
    (_nested(SQUARE, G.MAX_COLLECTION_DEPTH), (1.0, 1.0)),
])
def test_nested_collections(spark, text, expected):
    c = G.st_centroid(G.geom_from_geojson(F.col("t")))
    r = spark.createDataFrame([(text,)], "t string").select(G.st_x(c), G.st_y(c)).first()
    assert tuple(r) == expected


@pytest.mark.parametrize("text", [_nested(SQUARE, G.MAX_COLLECTION_DEPTH + 1),
                                  _nested('{"type":"Circle"}', 2), _nested(SQUARE + ',{"type":"X"}', 1)])
def test_invalid_collections(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(G.geom_from_geojson(F.col("t"), on_error="null").alias("g")).first().g is None
    with pytest.raises(Exception):
        df.select(G.geom_from_geojson(F.col("t")).alias("g")).collect()


def test_geojson_round_trip(spark):
    texts = [t for t, _ in CENTROIDS[:7]]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    g = G.geom_from_geojson(F.col("t"))
    back = G.geom_from_geojson(G.to_geojson(g))
    rows = df.select(g.alias("a"), back.alias("b")).collect()
    for r in rows:
        assert r.a == r.b


CONTROL = [  # EPSG chain, SURVEY §7.4
    (52.15517440, 5.38720621, 155000.180, 463000.234),
    (52.37453253, 4.88352559, 120700.902, 487525.734),
    (53.21938317, 6.56820053, 233883.309, 582065.403),
]


def test_transform_control_points(spark):
    df = spark.createDataFrame([(a, b) for a, b, _, _ in CONTROL], "lat double, lon double")
    rows = df.select(wgs84_to_rd("lon", "lat").alias("p")).collect()
    for r, (_, _, ex, ey) in zip(rows, CONTROL):
        assert r.p.x == pytest.approx(ex, abs=0.01)
        assert r.p.y == pytest.approx(ey, abs=0.01)


def test_st_transform_geometry(spark):
    df = spark.createDataFrame([(CONTROL[0][1], CONTROL[0][0])], "lon double, lat double")
    g = G.make_point(F.col("lon"), F.col("lat"), srid=4326)
    r = df.select(st_transform(g, 28992).alias("g")).first().g
    assert r.srid == 28992
    assert r.parts[0][0][0].x == pytest.approx(CONTROL[0][2], abs=0.01)


def test_set_srid_keeps_coordinates(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    r = df.select(G.st_set_srid(G.make_point("x", "y"), 28992).alias("g")).first().g
    assert r.srid == 28992 and r.parts[0][0][0].x == 1.0
