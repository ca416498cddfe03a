"""Grid-partitioned point-in-polygon join.

A plain ``WHERE st_within(point, polygon)`` has no equality key, so Spark can
only plan a Cartesian product or a broadcast nested-loop join.  We give the
join an equality key instead:

1. every polygon has a level, the power of two that its bounding box's longer
   side fits into, and is replicated onto the cells of that size that the box
   covers: two by two at most, however uneven the sizes in a layer are;
2. every point falls in one cell per level that the layer has, so a
   (point, polygon) pair meets at most once — no de-duplication needed;
3. equi-join on the cell: a broadcast hash join when the polygon side's bound is
   below the limit, otherwise a sort-merge join on the salted cell;
4. the bounding-box test and then the exact ``within`` test run as the join
   condition.

Polygon ring edges are computed once per polygon, before the join, and clipped.
The test counts the edges to the right of a point that its horizontal crosses, so
only edges that reach the point's height and do not lie to its left matter.  A
polygon of many edges is cut into slabs: its cells are divided in height by a power
of two, ``slabs``, so fine that a slab holds a few edges however many the polygon
has, and so coarse that all slabs together hold at most four times its edges (per
column of cells).  The other edges can't change the count, so results stay exact.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridwise.functions.geometry import bbox, bound, let, point_in_edges, polygon_edges

# Polygon side broadcast only when the bound of its size is under this many bytes.
DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024
# Sub-keys of a cell in a shuffled join.
DEFAULT_SALT = 8
# Bytes: an edge is nine doubles and its null bits, with its place in the array;
# keys, box and row overhead come on top.
EDGE_BYTES = 96
ROW_BYTES = 256
CELLS_PER_POLYGON = 4
# Polygons of at most so many edges are not cut into slabs.
FEW_EDGES = 16
# An edge is in one slab more than borders of slabs cross it.
ENTRIES_PER_EDGE = 4
MAX_SLABS_LOG2 = 24
# Slabs of more than CROWDED edges, most of them low ones, are cut once more by
# 2**RECUT_LOG2; that at most triples their entries.
CROWDED = 24
RECUT_LOG2 = 4


@dataclass
class GridPlan:
    # (level, log2 of the slabs that a cell of it is cut into)
    levels: tuple[tuple[int, int], ...]
    polygons: int
    est_bytes: int
    broadcast: bool


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once per row.

    A generator yields them, and the optimizer moves no filter below a
    generator: what a join infers about its keys is not computed a second time
    from the expressions behind them."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _side_and_level(geom: str) -> tuple[Column, Column]:
    b = bbox(F.col(geom))
    side = F.greatest(b["maxx"] - b["minx"], b["maxy"] - b["miny"])
    return side, F.ceil(F.log2(side)).cast("int")


def _edge_count(geom: str) -> Column:
    return F.size(F.flatten(F.flatten(F.col(geom)["parts"])))


def _slabs_log2(edges: Column, n: Column, level: Column) -> Column:
    """log2 of the number of slabs of a cell: the edges' mean height against the cell's."""
    heights = F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + F.abs(e["dy"]))
    share = F.pow(F.lit(2.0), level) * n * (ENTRIES_PER_EDGE - 1) / F.nullif(heights, F.lit(0.0))
    fine = F.least(F.lit(MAX_SLABS_LOG2), F.greatest(F.lit(0), F.floor(F.log2(share)).cast("int")))
    return F.when(n <= FEW_EDGES, F.lit(0)).otherwise(F.coalesce(fine, F.lit(0)))


def plan_grid(polys: DataFrame, geom: str = "geom",
              broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> GridPlan:
    """The levels of a layer and a bound of the size of its replicated side, with
    one aggregate over the polygons (never over the points).

    A polygon of few edges covers at most four cells of its level; each carries its
    edges (``EDGE_BYTES`` each), its attributes and ``ROW_BYTES``.  One of many edges
    has at most ``ENTRIES_PER_EDGE`` entries an edge in each of two columns of cells,
    and no more slabs than entries."""
    side, level = _side_and_level(geom)
    width = F.lit(ROW_BYTES)
    for f in polys.schema.fields:
        if f.name != geom:
            width = width + F.coalesce(F.length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) + 16
    edges = _edge_count(geom)
    entries = 2 * ENTRIES_PER_EDGE * edges
    fine = F.pow(F.lit(2.0), F.col("j")).cast("long") + 1
    weight = F.when(edges <= FEW_EDGES, (width + edges * EDGE_BYTES) * CELLS_PER_POLYGON).otherwise(
        3 * entries * EDGE_BYTES + F.least(3 * entries.cast("long"), 4 * 16 * fine) * width)
    row = (polys.withColumn("_s", side).where("_s > 0").withColumn("_l", level)
           .withColumn("j", _slabs_log2(polygon_edges(F.col(geom)), edges, F.col("_l")))
           .select(F.struct("_l", "j").alias("l"), weight.alias("w"))
           .agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("l")).alias("levels"),
                F.sum("w").alias("bytes")).first())
    est = int(row["bytes"] or 0)
    levels = {(r[0], r[1]) for r in row["levels"] or ()}
    levels |= {(level, fine + RECUT_LOG2) for level, fine in levels if fine}
    return GridPlan(levels=tuple(sorted(levels)),
                    polygons=int(row["n"] or 0), est_bytes=est, broadcast=est <= broadcast_limit)


# The edges of each slab: entries (slab, edge) sorted by slab and cut where it changes.
_SLABS = let(
    """array_sort(flatten(transform(v.edges, e -> transform(
         sequence(cast(floor(e.miny / v.height) as bigint), cast(floor(e.maxy / v.height) as bigint)),
         s -> named_struct('s', s, 'e', e)))), (a, b) -> cast(signum(a.s - b.s) as int))""", "l", let(
        """filter(transform(sequence(0, size(l) - 1), i ->
             if(i = 0 or get(l, i).s != get(l, i - 1).s, i, -1)), i -> i >= 0)""", "starts",
        """transform(starts, (at, k) -> named_struct('slab', get(l, at).s, 'edges', transform(
             slice(l, at + 1, coalesce(get(starts, k + 1), size(l)) - at), x -> x.e)))"""))


_PARTS = 1 << RECUT_LOG2
# A crowded slab (number v.cy of height v.height * parts) into slabs of v.height.
_RECUT = f"""if(v.fine > 0 and size(v.edges) > {CROWDED} and aggregate(v.edges, 0.0D,
      (acc, e) -> acc + least(abs(e.dy), v.height * {_PARTS})) <= size(v.edges) * v.height * {_PARTS} / 8,
    transform(filter({_SLABS}, s -> s.slab between v.cy * {_PARTS} and v.cy * {_PARTS} + {_PARTS - 1}),
      s -> named_struct('cy', s.slab, 'fine', v.fine + {RECUT_LOG2}, 'edges', s.edges)),
    array(named_struct('cy', v.cy, 'fine', v.fine, 'edges', v.edges)))"""


def polygon_cells(polys: DataFrame, geom: str, prefix: str = "_g",
                  slabs: bool = True) -> DataFrame:
    """Polygons with box, one row per column of cells (cx) and slab of it (cy) that they
    cover, with the slab's edges that do not lie to the left of the column.  Without
    ``slabs`` no polygon is cut."""
    side, level = _side_and_level(geom)
    names = {n: f"{prefix}_{n}" for n in ("box", "edges", "level", "fine", "cell", "cx", "cy")}
    box, cell, edges = F.col(names["box"]), F.col(names["cell"]), F.col(names["edges"])
    areas = computed_once(polys.where(F.col(geom)["dim"] == 2), **{
        names["box"]: bbox(F.col(geom)), names["edges"]: polygon_edges(F.col(geom)),
        names["level"]: F.when(side > 0, level)})
    areas = (areas.where(F.col(names["level"]).isNotNull())
             .withColumn(names["fine"], _slabs_log2(edges, F.size(edges), F.col(names["level"]))
                         if slabs else F.lit(0))
             .withColumn(names["cell"], F.pow(F.lit(2.0), F.col(names["level"]))))
    height = cell / F.pow(F.lit(2.0), F.col(names["fine"]))
    if slabs:
        cut = bound(_SLABS, edges=edges, height=height)
        rest = [c for c in areas.columns if c != names["edges"]]
        areas = areas.select(*rest, height.alias("_height"),
                             F.inline(cut).alias(names["cy"], names["edges"]))
        again = bound(_RECUT, edges=edges, height=F.col("_height") / _PARTS, cy=F.col(names["cy"]),
                      fine=F.col(names["fine"]))
        areas = areas.select(*[c for c in rest if c != names["fine"]], F.inline(again).alias(
            names["cy"], names["fine"], names["edges"]))
    else:
        areas = areas.withColumn(names["cy"], F.explode(F.sequence(
            F.floor(box["miny"] / height), F.floor(box["maxy"] / height))))
    areas = areas.withColumn(names["cx"], F.explode(F.sequence(
        F.floor(box["minx"] / cell), F.floor(box["maxx"] / cell))))
    if slabs:
        left = F.col(names["cx"]) * cell
        areas = areas.withColumn(names["edges"], F.filter(edges, lambda e: e["maxx"] >= left))
    return areas.drop(names["cell"])


def _candidates(points: DataFrame, polys: DataFrame, x: str, y: str, geom: str, grid: GridPlan,
                salt: int, keep_geom: bool, closed: bool) -> DataFrame:
    """(point, polygon) pairs whose polygon's box holds the point."""
    px, py, box = F.col(x), F.col(y), F.col("_g_box")
    salt = 1 if grid.broadcast else salt
    # a closed box has points beside every edge: those pairs need uncut polygons
    slabs = not closed and any(fine for _, fine in grid.levels)
    levels = grid.levels if slabs else sorted({(level, 0) for level, _ in grid.levels})
    cells = polygon_cells(polys, geom, slabs=slabs)
    if not keep_geom:
        cells = cells.drop(geom)
    cells = cells.withColumn("_g_s", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    probes = F.array(*[F.struct(
        F.lit(level).alias("_p_level"), F.lit(fine).alias("_p_fine"),
        F.floor(px / math.ldexp(1.0, level)).alias("_p_cx"),
        F.floor(py / math.ldexp(1.0, level - fine)).alias("_p_cy"),
        F.pmod(F.xxhash64(px, py), F.lit(salt)).cast("int").alias("_p_s"))
        for level, fine in levels])
    pts = points.where(px.isNotNull() & py.isNotNull()).select("*", F.inline(probes))
    # without a hint the planner may broadcast a layer above the bound: it takes the frame
    # for as small as the file that its edges were made from
    cells = F.broadcast(cells) if grid.broadcast else cells.hint("merge")
    inside = ((px >= box["minx"]) & (px <= box["maxx"]) & (py >= box["miny"]) & (py <= box["maxy"])
              if closed else
              (px > box["minx"]) & (px < box["maxx"]) & (py > box["miny"]) & (py < box["maxy"])
              & point_in_edges(x, y, "_g_edges"))
    return pts.join(cells, (F.col("_p_level") == F.col("_g_level"))
                    & (F.col("_p_fine") == F.col("_g_fine")) & (F.col("_p_cx") == F.col("_g_cx"))
                    & (F.col("_p_cy") == F.col("_g_cy")) & (F.col("_p_s") == F.col("_g_s")) & inside)


_KEYS = ["_p_level", "_p_fine", "_p_cx", "_p_cy", "_p_s", "_g_level", "_g_fine", "_g_cx", "_g_cy",
         "_g_s", "_g_box", "_g_edges"]


def spatial_join(points: DataFrame, polys: DataFrame, x: str = "x", y: str = "y",
                 geom: str = "geom", how: str = "inner",
                 broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
                 keep_geom: bool = False, grid: GridPlan | None = None,
                 salt: int = DEFAULT_SALT) -> DataFrame:
    """Rows of ``points`` paired with every polygon of ``polys`` that strictly
    contains the point (x, y).  0 hits drops the point (``how='inner'``) or
    keeps it with null polygon columns (``how='left'``); k hits give k rows.  A
    point with a null coordinate has no hit.

    Column names of the two inputs must not overlap (except the geometry,
    which is dropped unless ``keep_geom``).

    When the polygon side is too large to broadcast, the join shuffles on the
    cell and one of ``salt`` sub-keys (points pick one by a hash of their
    coordinates, polygon cells are replicated to all of them), and adaptive
    execution splits what is still too large.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    grid = grid or plan_grid(polys, geom, broadcast_limit)
    extra = [f for f in polys.schema.fields if keep_geom or f.name != geom]
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in extra]
    if not grid.levels:
        out = points.select("*", *nulls)
        return out if how == "left" else out.where("false")
    found = _candidates(points, polys, x, y, geom, grid, salt, keep_geom, False).drop(*_KEYS)
    if how == "inner":
        return found
    # a point without a hit is known by its coordinates
    hit = found.select(F.col(x).alias("_h_x"), F.col(y).alias("_h_y")).distinct()
    missed = points.join(hit, (F.col(x) == F.col("_h_x")) & (F.col(y) == F.col("_h_y")), "left_anti")
    return found.unionByName(missed.select("*", *nulls))


def within_candidates(points: DataFrame, polys: DataFrame, x: str = "x", y: str = "y",
                      geom: str = "geom",
                      broadcast_limit: int = DEFAULT_BROADCAST_LIMIT) -> DataFrame:
    """Every (point, polygon) pair whose polygon's closed bounding box holds the
    point, with the exact ``within`` flag — the candidate set of the grid join,
    never the full Cartesian product."""
    grid = plan_grid(polys, geom, broadcast_limit)
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in polys.schema.fields
             if f.name != geom]
    if not grid.levels:
        return points.select("*", *extra, F.lit(False).alias("within")).where("false")
    px, py, box = F.col(x), F.col(y), F.col("_g_box")
    found = _candidates(points, polys, x, y, geom, grid, DEFAULT_SALT, False, True)
    return found.withColumn(
        "within", point_in_edges(x, y, "_g_edges") & (px > box["minx"])
        & (px < box["maxx"]) & (py > box["miny"]) & (py < box["maxy"])).drop(*_KEYS)
