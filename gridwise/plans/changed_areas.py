"""E6 after a change of the area layers: only inspections near a changed area are
enriched again.

Which areas an inspection gets depends on the polygons that hold its point.  Rows that
are not in both versions of a layer (added, dropped, moved, renamed) are the changed
polygons.  A point outside of all their boxes has the areas that it had, so its
published rows stay; the others are dropped and made anew from ``inspections_total``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwise.operators.spatial_join import plan_grid, within_candidates
from gridwise.plans import enrich


def changed_polygons(old: DataFrame, new: DataFrame, geom: str = "wkb_geometry") -> DataFrame:
    """The geometries (column ``geom``) of the rows that only one of the versions has."""
    new = new.select(*old.columns)
    return (old.exceptAll(new).unionByName(new.exceptAll(old))
            .select(F.col(geom).alias("geom")).where("geom is not null").distinct())


def _touched(points: DataFrame, polygons: DataFrame) -> DataFrame:
    """The distinct points (_rd_x, _rd_y) that lie in the closed box of a polygon."""
    places = points.select("_rd_x", "_rd_y").distinct()
    return within_candidates(places, polygons, x="_rd_x", y="_rd_y").select("_rd_x", "_rd_y").distinct()


def update_areas(published: DataFrame, total: DataFrame, old_hierarchy: DataFrame,
                 hierarchy: DataFrame, old_areas: DataFrame, areas: DataFrame,
                 geom: str = "wkb_geometry") -> DataFrame:
    """``inspections_total_areas`` over the new layers, from the table published over the
    old ones and from ``total``, the inspections (E4) that it was made of.

    The layers are compared whole; of ``published`` and ``total`` the points are tested
    against the changed polygons' boxes, and only touched inspections are joined with the
    new layers.
    """
    polygons = changed_polygons(old_hierarchy, hierarchy, geom).unionByName(
        changed_polygons(old_areas, areas, geom))
    if not plan_grid(polygons).polygons:
        return published
    point = ["_rd_x", "_rd_y"]
    old_rows = enrich.rd_point(published)
    stays = old_rows.join(_touched(old_rows, polygons), point, "left_anti").drop(*point)
    inspections = enrich.rd_point(total)
    again = inspections.join(_touched(inspections, polygons), point, "left_semi").drop(*point)
    fresh = enrich.inspections_total_areas(again, hierarchy, areas, geom, geom)
    return stays.unionByName(fresh.select(*stays.columns))
