"""Geometry as a plain struct column, with GeoJSON parsing, centroid,
point-in-polygon and bounding boxes written as built-in expressions.

    geom: struct<srid:int, dim:int, parts:array<array<array<struct<x,y>>>>>

``dim`` is 0 for (multi)points, 1 for (multi)lines and 2 for (multi)polygons.
``parts`` holds part -> ring -> vertex; points and lines use one ring per
part.  No Python UDF is involved: everything is Spark SQL expressions (the
loops are higher-order ``transform``/``aggregate`` functions), so the work
runs in the executors' JVMs next to the data.

Each function's body is SQL text made once, at import, and handed to the parser
in one call (``bound``); building it call by call took most of a query's
planning time.  Arguments are bound once as fields of the lambda variable ``v``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, StructField,
                               StructType)

POINT_TYPE = StructType([StructField("x", DoubleType()), StructField("y", DoubleType())])
RING_TYPE = ArrayType(POINT_TYPE)
PARTS_TYPE = ArrayType(ArrayType(RING_TYPE))
GEOM_TYPE = StructType([
    StructField("srid", IntegerType()),
    StructField("dim", IntegerType()),
    StructField("parts", PARTS_TYPE),
])

DEFAULT_SRID = 4326
# Collections within collections are unfolded this deep; deeper ones are invalid.
MAX_COLLECTION_DEPTH = 8

_PARTS_SQL = "array<array<array<struct<x:double,y:double>>>>"
GEOM_SQL = f"struct<srid:int,dim:int,parts:{_PARTS_SQL}>"
_HEAD_SCHEMA = "type string, coordinates string, geometries array<string>"
_EMPTY = f"cast(array() as {_PARTS_SQL})"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: str, name: str, body: str) -> str:
    """SQL text that evaluates ``value`` once and uses it as ``name`` in ``body``.

    Expressions are trees: text that repeats a value repeats its subtree, and
    chains of such reuse grow exponentially.  A one-element ``transform`` binds
    the value to a lambda variable instead, so expressions stay linear in size."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def bound(body: str, **args: Column) -> Column:
    """The SQL text ``body`` over ``args``, which it knows as ``v.<name>``."""
    row = F.struct(*[a.alias(n) for n, a in args.items()])
    return F.get(F.call_function("transform", F.array(row), F.expr(f"v -> {body}")), 0)


# ---------------------------------------------------------------------------
# GeoJSON
# ---------------------------------------------------------------------------

def _ring(coords: str) -> str:
    """array<array<double>> -> array<struct<x, y>>, incomplete positions dropped."""
    return (f"filter(transform({coords}, c -> named_struct('x', get(c, 0), 'y', get(c, 1))), "
            "p -> p.x is not null and p.y is not null)")


def _one_part(ring: str) -> str:
    return let(ring, "r", f"if(size(r) > 0, array(array(r)), {_EMPTY})")


def _members(kind: str, coords: str) -> str:
    """struct<dim, parts> of a simple GeoJSON geometry; null dim if the type is
    unknown.  Coordinates are parsed only in the branch of their type."""
    def parsed(depth: int, body: str) -> str:
        schema = "array<" * depth + "double" + ">" * depth
        return let(f"from_json({coords}, '{schema}')", "a", body)

    parts = f"""case {kind}
      when 'Point' then {parsed(1, _one_part(_ring("array(a)")))}
      when 'MultiPoint' then {parsed(2, f"transform({_ring('a')}, p -> array(array(p)))")}
      when 'LineString' then {parsed(2, _one_part(_ring("a")))}
      when 'MultiLineString' then {parsed(3, "transform(filter(a, l -> size(l) > 0), l -> array("
                                             + _ring("l") + "))")}
      when 'Polygon' then {parsed(3, f"if(size(a) > 0, array(transform(a, l -> {_ring('l')})), {_EMPTY})")}
      when 'MultiPolygon' then {parsed(4, "transform(filter(a, g -> size(g) > 0), g -> transform(g, l -> "
                                          + _ring("l") + "))")}
    end"""
    dim = f"""case when {kind} in ('Point', 'MultiPoint') then 0
      when {kind} in ('LineString', 'MultiLineString') then 1
      when {kind} in ('Polygon', 'MultiPolygon') then 2 end"""
    return f"named_struct('dim', {dim}, 'parts', coalesce({parts}, {_EMPTY}))"


def _unfolded(texts: str, depth: int) -> str:
    """The members of nested collections, ``depth`` levels deep, as one flat list."""
    for level in range(depth):
        one = let(f"from_json(m{level}, '{_HEAD_SCHEMA}')", "u",
                  "if(u.type = 'GeometryCollection', "
                  f"coalesce(u.geometries, cast(array() as array<string>)), array(m{level}))")
        texts = f"flatten(transform({texts}, m{level} -> coalesce({one}, array(m{level}))))"
    return texts


def _collection(texts: str) -> str:
    """struct<dim, parts>: the members of the highest dimension.  A member of
    unknown type, or a collection left over, makes the whole geometry invalid."""
    members = (f"transform({_unfolded(texts, MAX_COLLECTION_DEPTH - 1)}, m -> "
               + let(f"from_json(m, '{_HEAD_SCHEMA}')", "h", _members("h.type", "h.coordinates")) + ")")
    found = let("array_max(transform(ms, e -> e.dim))", "top", f"""named_struct(
      'dim', if(exists(ms, e -> e.dim is null), cast(null as int), coalesce(top, 0)),
      'parts', coalesce(flatten(transform(filter(ms, e -> e.dim = top), e -> e.parts)), {_EMPTY}))""")
    return let(members, "ms", found)


def _geojson_sql() -> str:
    bad = "raise_error(concat('invalid GeoJSON geometry: ', substring(v.t, 1, 200)))"
    body = f"""case when h.type = 'GeometryCollection'
        then {_collection("coalesce(h.geometries, cast(array() as array<string>))")}
        else {_members("h.type", "h.coordinates")} end"""
    done = f"""case when v.t is null or trim(v.t) = 'null' then cast(null as {GEOM_SQL})
        when b.dim is null then if(v.fail, cast({bad} as {GEOM_SQL}), cast(null as {GEOM_SQL}))
        else named_struct('srid', v.srid, 'dim', b.dim, 'parts', b.parts) end"""
    return let(f"from_json(v.t, '{_HEAD_SCHEMA}')", "h", let(body, "b", done))


_GEOM_FROM_GEOJSON = _geojson_sql()


def geom_from_geojson(text, srid: int = DEFAULT_SRID, on_error: str = "fail") -> Column:
    """``ST_GeomFromGeoJSON``: GeoJSON geometry text -> geometry struct.

    A null input or the JSON text ``null`` gives a null geometry.  An unknown
    type raises (``on_error='fail'``) or gives null (``on_error='null'``).
    GeometryCollection keeps its members of the highest dimension (that is
    all a centroid or containment test uses); collections within collections
    count as their members, ``MAX_COLLECTION_DEPTH`` levels deep.
    """
    if on_error not in ("fail", "null"):
        raise ValueError("on_error must be 'fail' or 'null'")
    return bound(_GEOM_FROM_GEOJSON, t=_c(text), srid=F.lit(srid), fail=F.lit(on_error == "fail"))


_TO_GEOJSON = let("size(v.g.parts)", "n", """case when v.g is null then null else concat(
    '{"type":"',
    case when v.g.dim = 0 then if(n = 1, 'Point', 'MultiPoint')
         when v.g.dim = 1 then if(n = 1, 'LineString', 'MultiLineString')
         else if(n = 1, 'Polygon', 'MultiPolygon') end,
    '","coordinates":',
    case when v.g.dim = 0 then """ + let(
        "transform(v.g.parts, part -> array(get(get(part, 0), 0).x, get(get(part, 0), 0).y))", "l",
        "if(n = 1, to_json(get(l, 0)), to_json(l))") + """
         when v.g.dim = 1 then """ + let(
        "transform(v.g.parts, part -> transform(get(part, 0), p -> array(p.x, p.y)))", "l",
        "if(n = 1, to_json(get(l, 0)), to_json(l))") + """
         else """ + let(
        "transform(v.g.parts, part -> transform(part, r -> transform(r, p -> array(p.x, p.y))))", "l",
        "if(n = 1, to_json(get(l, 0)), to_json(l))") + """ end,
    '}') end""")


def to_geojson(geom) -> Column:
    """Geometry struct -> compact GeoJSON geometry text."""
    return bound(_TO_GEOJSON, g=_c(geom))


# ---------------------------------------------------------------------------
# making and relabelling
# ---------------------------------------------------------------------------

def make_point(x, y, srid: int = DEFAULT_SRID) -> Column:
    return F.struct(F.lit(srid).alias("srid"), F.lit(0).alias("dim"),
                    F.array(F.array(F.array(F.struct(_c(x).cast("double").alias("x"),
                                                     _c(y).cast("double").alias("y")))))
                    .alias("parts"))


_BOX = """named_struct('srid', v.srid, 'dim', 2, 'parts', array(array(array(
    named_struct('x', v.x0, 'y', v.y0), named_struct('x', v.x1, 'y', v.y0),
    named_struct('x', v.x1, 'y', v.y1), named_struct('x', v.x0, 'y', v.y1),
    named_struct('x', v.x0, 'y', v.y0)))))"""


def make_box(x0, y0, x1, y1, srid: int = DEFAULT_SRID) -> Column:
    """Axis-aligned rectangle polygon (counter-clockwise, closed ring)."""
    sides = {n: _c(c).cast("double") for n, c in zip(("x0", "y0", "x1", "y1"), (x0, y0, x1, y1))}
    return bound(_BOX, srid=F.lit(srid), **sides)


def st_set_srid(geom, srid: int) -> Column:
    """``ST_SetSRID``: relabel only, coordinates unchanged."""
    g = _c(geom)
    return F.when(g.isNull(), g).otherwise(g.withField("srid", F.lit(srid)))


def _first_vertex(g: Column) -> Column:
    return F.get(F.get(F.get(g["parts"], 0), 0), 0)


def st_x(geom) -> Column:
    """``ST_X`` of a point geometry (first vertex; null when empty)."""
    return _first_vertex(_c(geom))["x"]


def st_y(geom) -> Column:
    return _first_vertex(_c(geom))["y"]


def vertices(geom) -> Column:
    """All vertices of a geometry as one array<struct<x,y>>."""
    return F.flatten(F.flatten(_c(geom)["parts"]))


def _bbox_sql(geom: str) -> str:
    return let(f"flatten(flatten({geom}.parts))", "vs", let(
        "named_struct('xs', transform(vs, p -> p.x), 'ys', transform(vs, p -> p.y))", "q",
        "named_struct('minx', array_min(q.xs), 'miny', array_min(q.ys), "
        "'maxx', array_max(q.xs), 'maxy', array_max(q.ys))"))


_BBOX = _bbox_sql("v.g")


def bbox(geom) -> Column:
    """struct<minx, miny, maxx, maxy> of a geometry (nulls when empty)."""
    return bound(_BBOX, g=_c(geom))


# ---------------------------------------------------------------------------
# centroid
# ---------------------------------------------------------------------------

# One pass over a ring rs.r (closing edge included): weight = signed area and the
# first moments, coordinates relative to the origin o.
_RING_AREA = """aggregate(rs.r,
    named_struct('a2', 0.0D, 'sx', 0.0D, 'sy', 0.0D, 'px', cast(null as double),
                 'py', cast(null as double), 'fx', cast(null as double), 'fy', cast(null as double)),
    (acc, p) -> """ + let(
    """named_struct('xj', p.x - o.x, 'yj', p.y - o.y, 'xi', coalesce(acc.px, p.x - o.x),
                 'yi', coalesce(acc.py, p.y - o.y))""", "e", let("e.xi * e.yj - e.xj * e.yi", "cross", """
       named_struct('a2', acc.a2 + cross, 'sx', acc.sx + (e.xi + e.xj) * cross,
         'sy', acc.sy + (e.yi + e.yj) * cross, 'px', e.xj, 'py', e.yj,
         'fx', coalesce(acc.fx, e.xj), 'fy', coalesce(acc.fy, e.yj))""")) + """,
    acc -> """ + let("coalesce(acc.px * acc.fy - acc.fx * acc.py, 0.0D)", "cross", let(
    """named_struct('a2', acc.a2 + cross,
        'sx', acc.sx + coalesce((acc.px + acc.fx) * cross, 0.0D),
        'sy', acc.sy + coalesce((acc.py + acc.fy) * cross, 0.0D))""", "t", """
       named_struct('w', rs.s * abs(t.a2) / 2.0D, 'cx', rs.s * signum(t.a2) * t.sx / 6.0D,
                    'cy', rs.s * signum(t.a2) * t.sy / 6.0D)""")) + ")"

# Segment lengths and length-weighted midpoints along a ring or line r.
_RING_LENGTH = """aggregate(r,
    named_struct('l', 0.0D, 'lx', 0.0D, 'ly', 0.0D, 'px', cast(null as double),
                 'py', cast(null as double)),
    (acc, p) -> """ + let(
    """named_struct('xj', p.x - o.x, 'yj', p.y - o.y, 'xi', coalesce(acc.px, p.x - o.x),
                 'yi', coalesce(acc.py, p.y - o.y))""", "e", let(
        "sqrt((e.xj - e.xi) * (e.xj - e.xi) + (e.yj - e.yi) * (e.yj - e.yi))", "seg", """
       named_struct('l', acc.l + seg, 'lx', acc.lx + seg * (e.xi + e.xj) / 2.0D,
                    'ly', acc.ly + seg * (e.yi + e.yj) / 2.0D, 'px', e.xj, 'py', e.yj)""")) + ")"


def _sum3(arr: str, a: str, b: str, c: str) -> str:
    """Sums of three terms of each element ``e`` of an array, in one pass."""
    return (f"aggregate({arr}, named_struct('a', 0.0D, 'b', 0.0D, 'c', 0.0D), (s, e) -> "
            f"named_struct('a', s.a + ({a}), 'b', s.b + ({b}), 'c', s.c + ({c})))")


def _ratio(x: str, y: str, weight: str, test: str) -> str:
    """Vertex (x / weight, y / weight) moved back from the origin, null unless ``test``."""
    safe = f"if({test}, {weight}, null)"
    return (f"if({test}, named_struct('x', {x} / {safe} + o.x, 'y', {y} / {safe} + o.y), "
            "cast(null as struct<x:double,y:double>))")


def _centroid_sql() -> str:
    """Area centroid for areas; only when that is undefined (lines, zero area)
    the length-weighted centroid; only when that is undefined too the mean of
    the vertices.  Each fallback pass runs only when it is needed."""
    by_points = let(_sum3("flatten(flatten(v.g.parts))", "e.x - o.x", "e.y - o.y", "1.0D"), "tp",
                    _ratio("tp.a", "tp.b", "tp.c", "tp.c > 0"))
    by_length = let(
        _sum3(f"transform(flatten(v.g.parts), r -> {_RING_LENGTH})", "e.l", "e.lx", "e.ly"), "tl",
        f"coalesce({_ratio('tl.b', 'tl.c', 'tl.a', 'tl.a > 0')}, {by_points})")
    signed = ("flatten(transform(v.g.parts, part -> transform(part, (r, i) -> "
              "named_struct('r', r, 's', if(i = 0, 1.0D, -1.0D)))))")
    by_area = let(
        _sum3(f"transform({signed}, rs -> {_RING_AREA})", "e.w", "e.cx", "e.cy"), "ta",
        f"coalesce({_ratio('ta.b', 'ta.c', 'ta.a', 'ta.a != 0.0D')}, {by_length})")
    found = (f"case when v.g.dim = 2 then {by_area} when v.g.dim = 1 then {by_length} "
             f"else {by_points} end")
    geom = f"""named_struct('srid', v.g.srid, 'dim', 0, 'parts',
        if(cc is null or cc.x is null, {_EMPTY}, array(array(array(cc)))))"""
    centre = let("get(get(get(v.g.parts, 0), 0), 0)", "o", let(found, "cc", geom))
    # fast path: a single point is its own centroid (no loop over rings)
    return f"""case when v.g is null then cast(null as {GEOM_SQL})
        when size(v.g.parts) = 1 and size(get(v.g.parts, 0)) = 1
             and size(get(get(v.g.parts, 0), 0)) = 1
          then named_struct('srid', v.g.srid, 'dim', 0, 'parts', v.g.parts)
        else {centre} end"""


_CENTROID = _centroid_sql()


def st_centroid(geom) -> Column:
    """``ST_Centroid``: centre of mass of the highest dimension present.

    Areas are weighted by area with holes subtracted; if the total area is
    zero the rings are treated as lines (length-weighted segment midpoints);
    zero length falls back to the mean of the vertices.  Empty -> a point
    geometry with no vertex (so ``st_x`` is null).
    """
    return bound(_CENTROID, g=_c(geom))


# ---------------------------------------------------------------------------
# containment
# ---------------------------------------------------------------------------

def _edges_sql(geom: str) -> str:
    edge = let("get(r, (k + 1) % size(r))", "q", """named_struct(
        'x1', p.x, 'y1', p.y, 'dx', q.x - p.x, 'dy', q.y - p.y, 'y2', q.y,
        'minx', least(p.x, q.x), 'maxx', greatest(p.x, q.x),
        'miny', least(p.y, q.y), 'maxy', greatest(p.y, q.y))""")
    return f"flatten(transform(flatten({geom}.parts), r -> transform(r, (p, k) -> {edge})))"


_EDGES = _edges_sql("v.g")


def polygon_edges(geom) -> Column:
    """All ring edges of a geometry as array<struct<x1,y1,dx,dy,y2,minx,maxx,
    miny,maxy>> (each ring closed back to its first vertex).  Computed once
    per polygon, so the per-pair containment test is one cheap pass over a
    flat array with everything that depends only on the edge precomputed."""
    return bound(_EDGES, g=_c(geom))


def _crossings(x: str, y: str, edges: str) -> str:
    """True if a ray from the point to the right crosses an odd number of edges and
    the point lies on none (the count is -1 once it is found on one).  Written without division, so horizontal edges need
    no special case.  (The lambda variables' names keep clear of column names.)"""
    cross = f"(({x} - _edge.x1) * _edge.dy - _edge.dx * ({y} - _edge.y1))"
    return f"""aggregate({edges}, 0, (_n, _edge) -> case when _n < 0 then _n
        when {cross} = 0 and {x} >= _edge.minx and {x} <= _edge.maxx
             and {y} >= _edge.miny and {y} <= _edge.maxy then -1
        when (_edge.y1 > {y}) != (_edge.y2 > {y}) and {cross} * _edge.dy < 0 then _n + 1
        else _n end, _n -> _n >= 0 and _n % 2 = 1)"""


_IN_EDGES = _crossings("v.x", "v.y", "v.edges")


def within_edges(px, py, edges) -> Column:
    """Point strictly inside the area bounded by ``edges`` (even-odd rule).

    A point on any edge — outer boundary or hole — is not within.
    """
    return bound(_IN_EDGES, x=_c(px).cast("double"), y=_c(py).cast("double"), edges=_c(edges))


def point_in_edges(x: str, y: str, edges: str) -> Column:
    """``within_edges`` for plain columns given by name (no binding needed, e.g.
    inside a join condition)."""
    return F.expr(_crossings(f"`{x}`", f"`{y}`", f"`{edges}`"))


_WITHIN = let(_bbox_sql("v.g"), "b", f"""case
    when v.x is null or v.y is null or v.g is null then cast(null as boolean)
    else v.g.dim = 2 and v.x > b.minx and v.x < b.maxx and v.y > b.miny and v.y < b.maxy
      and {_crossings("v.x", "v.y", _edges_sql("v.g"))} end""")


def st_within(px, py, geom) -> Column:
    """``ST_Within(point, polygon)`` for a point given by coordinates.

    Only area geometries contain points; null point or geometry -> null.
    """
    return bound(_WITHIN, x=_c(px).cast("double"), y=_c(py).cast("double"), g=_c(geom))
