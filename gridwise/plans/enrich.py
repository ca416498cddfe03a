"""The enrichment jobs: ``inspections_total`` (E4), the area hierarchy
(E5, E7, E8) and the flagship ``inspections_total_areas`` (E6).

All of them are lazy DataFrames; one action (a write or a collect) runs the
whole chain.  Dimension-sized inputs (score types, area layers) are measured
and broadcast when small, so the inspection rows stream through a single
stage without a shuffle; when a side is too big to broadcast the joins fall
back to shuffled equi-joins (cell key / text key) that adaptive execution can
re-plan and de-skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridwise.functions.crs import wgs84_to_rd
from gridwise.functions.geometry import (geom_from_geojson, st_centroid, st_set_srid,
                                         st_x, st_y)
from gridwise.functions.text import concat_text, str_left, str_right
from gridwise.operators.joins import (broadcast_if_small, in_parallel, join_concat_key,
                                      union_all)
from gridwise.operators.spatial_join import computed_once, plan_grid, spatial_join


def _q(name: str) -> str:
    return f"`{name}`"


# ---------------------------------------------------------------------------
# The staging field names the loader produces and the column
# names of the published tables, in published order.  They must equal the
# original's names for the output to be a drop-in replacement.
# ---------------------------------------------------------------------------
# staging column -> published name (inspections_total, in published order)
TOTAL_FROM_STAGING = [
    ("createdAt", "inspection_created_at"),
    ("creatingUserId", "creating_user_id"),
    ("id", "inspection_round_id"),
    ("inspectionRoundName", "inspection_round_name"),
    ("location.geoJsonProperties.x", "x"),
    ("location.geoJsonProperties.y", "y"),
    ("location.locationId", "location_id"),
    ("modifiedAt", "inspection_round_modified_at"),
    ("photos.0.id", "photo_id"),
    ("photos.0.uri", "photo_uri"),
    ("roundResultCompletedAt", "inspection_round_completed_at"),
    ("score", "score_id"),
]
TOTAL_FROM_TYPES = [
    ("description", "score_description"),
    ("inspection_type_id", "inspection_type_id"),
    ("inspection_type_name", "inspection_type_name"),
    ("measuring_desc", "score_measuring_description"),
    ("name", "score"),
]

TOTAL_AREAS_COLUMNS = [
    "inspection_created_at", "creating_user_id", "inspection_round_id",
    "inspection_round_name", "x", "y", "location_id", "inspection_round_modified_at",
    "photo_id", "photo_uri", "inspection_round_completed_at", "score_id",
    "score_description", "inspection_type_id", "inspection_type_name",
    "score_measuring_description", "score", "lat", "lon", "geojson",
    "stadsdeelcode", "stadsdeelnaam", "gebiedsnaam", "gebiedscode", "wijkcode",
    "wijknaam", "buurtnaam", "buurtcode",
]


def project_rename(staging: DataFrame, mapping=TOTAL_FROM_STAGING) -> DataFrame:
    """Select dotted staging columns under snake_case names (absent -> null)."""
    have = set(staging.columns)
    return staging.select(*[
        (F.col(_q(src)) if src in have else F.lit(None).cast("string")).alias(dst)
        for src, dst in mapping])


def inspections_total(area_staging: DataFrame, object_staging: DataFrame,
                      types: DataFrame, strict_keys: bool = False,
                      geojson_errors: str = "fail") -> DataFrame:
    """Both staging tables unioned, joined to their score option on
    ``text(inspectionItem.id)||text(score) = text(type id)||text(option id)``,
    renamed, with the geometry parsed once: centroid X as ``lat``, Y as
    ``lon`` (the published, swapped names) and ``geom`` labelled 4326."""
    a = union_all(area_staging, object_staging)
    for col in ("inspectionItem.id", "score", "geojson"):
        if col not in a.columns:
            raise KeyError(f"staging column missing: {col}")
    a = a.select(*[F.col(_q(c)).alias(c.replace(".", "__")) for c in a.columns])
    t = types.select(*[F.col(c).alias("_t_" + c) for c in (
        "id", "name", "description", "measuring_desc", "inspection_type_id",
        "inspection_type_name")])
    j = join_concat_key(a, t, ["inspectionItem__id", "score"],
                        ["_t_inspection_type_id", "_t_id"], strict_keys=strict_keys)
    have = set(a.columns)
    geom = geom_from_geojson(F.col("geojson"), on_error=geojson_errors)
    staged = j.select(
        *[(F.col(s.replace(".", "__")) if s.replace(".", "__") in have else F.lit(None)).alias(d)
          for s, d in TOTAL_FROM_STAGING],
        *[F.col("_t_" + s).alias(d) for s, d in TOTAL_FROM_TYPES],
        F.col("geojson"), geom.alias("_g"))
    return (computed_once(staged, _c=st_centroid(F.col("_g")))
            .select(*[F.col(d) for _, d in TOTAL_FROM_STAGING],
                    *[F.col(d) for _, d in TOTAL_FROM_TYPES],
                    st_x("_c").alias("lat"), st_y("_c").alias("lon"),
                    F.col("geojson"), st_set_srid(F.col("_g"), 4326).alias("geom")))


def area_hierarchy(buurt: DataFrame, wijk: DataFrame, stadsdeel: DataFrame,
                   geom: str | None = "wkb_geometry") -> DataFrame:
    """E5: neighbourhood LEFT JOIN quarter on ``RIGHT(vollcode,2) =
    LEFT(code,2)`` LEFT JOIN district on ``code = LEFT(wijkcode,1)``;
    ``buurtcode = district code || neighbourhood code`` (null without a
    district).  Outer joins stay outer: the geometry comes from the
    neighbourhood."""
    b = buurt.select(F.col("code").alias("_b_code"), F.col("naam").alias("buurtnaam"),
                     *([F.col(geom)] if geom else []))
    w0 = wijk.select(F.col("vollcode").alias("wijkcode"), F.col("naam").alias("wijknaam"))
    s0 = stadsdeel.select(F.col("code").alias("stadsdeelcode"),
                          F.col("naam").alias("stadsdeelnaam"))
    w, s = in_parallel(lambda: broadcast_if_small(w0), lambda: broadcast_if_small(s0))
    a = b.join(w, str_right(F.col("wijkcode"), 2) == str_left(F.col("_b_code"), 2), "left")
    d = a.join(s, F.col("stadsdeelcode") == str_left(F.col("wijkcode"), 1), "left")
    return d.select("stadsdeelnaam", "stadsdeelcode", "wijknaam", "wijkcode", "buurtnaam",
                    concat_text(F.col("stadsdeelcode"), F.col("_b_code")).alias("buurtcode"),
                    *([F.col(geom)] if geom else []))


def area_hierarchy_prefix(buurt: DataFrame, wijk: DataFrame, stadsdeel: DataFrame,
                          geom: str | None = "wkb_geometry") -> DataFrame:
    """Three-way inner join ``s.code = LEFT(b.code,1) AND
    w.code = LEFT(b.code,2)``."""
    b = buurt.select(F.col("code").alias("_b_code"), F.col("naam").alias("buurtnaam"),
                     *([F.col(geom)] if geom else []))
    w = broadcast_if_small(wijk.select(F.col("code").alias("_w_code"),
                                       F.col("vollcode").alias("wijkcode"),
                                       F.col("naam").alias("wijknaam")))
    s = broadcast_if_small(stadsdeel.select(F.col("code").alias("stadsdeelcode"),
                                            F.col("naam").alias("stadsdeelnaam")))
    j = (b.join(s, F.col("stadsdeelcode") == str_left(F.col("_b_code"), 1), "inner")
         .join(w, F.col("_w_code") == str_left(F.col("_b_code"), 2), "inner"))
    return j.select("stadsdeelcode",
                    concat_text(F.col("stadsdeelcode"), F.col("_b_code")).alias("buurtcode"),
                    "wijkcode", "stadsdeelnaam", "buurtnaam", "wijknaam",
                    *([F.col(geom)] if geom else []))


def area_hierarchy_spatial(buurt: DataFrame, stadsdeel: DataFrame, wijk: DataFrame,
                           geom: str = "wkb_geometry") -> DataFrame:
    """E8, re-aimed: each neighbourhood's district is the one containing the
    neighbourhood centroid (grid spatial join); its quarter is the one whose
    code is the neighbourhood code's 2-char prefix; then DISTINCT over the
    seven columns, geometry included.

    The original pairs every (neighbourhood, district) with *every* quarter
    (a condition-less cross join); that all-pairs product is not built."""
    cen = st_centroid(F.col(geom))
    b = computed_once(buurt.select(F.col("code").alias("_b_code"),
                                   F.col("naam").alias("buurtnaam"), F.col(geom)), _cen=cen)
    b = b.withColumn("_cx", st_x("_cen")).withColumn("_cy", st_y("_cen")).drop("_cen")
    s = stadsdeel.select(F.col("code").alias("stadsdeelcode"),
                         F.col("naam").alias("stadsdeelnaam"), F.col(geom).alias("_s_geom"))
    a = spatial_join(b, s, x="_cx", y="_cy", geom="_s_geom")
    w = broadcast_if_small(wijk.select(F.col("code").alias("_w_code"),
                                       F.col("vollcode").alias("wijkcode"),
                                       F.col("naam").alias("wijknaam")))
    j = a.join(w, F.col("_w_code") == str_left(F.col("_b_code"), 2), "inner")
    return j.select("stadsdeelcode",
                    concat_text(F.col("stadsdeelcode"), F.col("_b_code")).alias("buurtcode"),
                    "wijkcode", "stadsdeelnaam", "buurtnaam", "wijknaam",
                    F.col(geom)).distinct()


def rd_point(total: DataFrame) -> DataFrame:
    """``ST_TRANSFORM(ST_CENTROID(geom), 28992)`` computed once, from the
    centroid columns (``lat`` holds X, ``lon`` holds Y)."""
    return (computed_once(total, _rd=wgs84_to_rd(F.col("lat"), F.col("lon")))
            .withColumn("_rd_x", F.col("_rd")["x"]).withColumn("_rd_y", F.col("_rd")["y"])
            .drop("_rd"))


def inspections_total_areas(total: DataFrame, hierarchy: DataFrame,
                            working_areas: DataFrame, hierarchy_geom: str = "wkb_geometry",
                            area_geom: str = "wkb_geometry", how: str = "inner",
                            keep_score_id: bool = False) -> DataFrame:
    """E6 (flagship): every inspection whose transformed centroid lies strictly
    inside a neighbourhood of the hierarchy AND inside a working area, with
    both areas' codes and names.  0 hits drops the row, k hits give k rows
    (``how='left'`` keeps unmatched rows instead).

    As published, ``score_id`` repeats the score *name*; ``keep_score_id``
    keeps the numeric id instead."""
    pts = rd_point(total.drop("geom"))
    g = working_areas.select(F.col("naam").alias("gebiedsnaam"),
                             F.col("code").alias("gebiedscode"),
                             F.col(area_geom).alias("_g_geom"))
    # both layers are measured at once (two small jobs side by side)
    grid_d, grid_g = in_parallel(lambda: plan_grid(hierarchy, hierarchy_geom),
                                 lambda: plan_grid(g, "_g_geom"))
    e = spatial_join(pts, hierarchy, x="_rd_x", y="_rd_y", geom=hierarchy_geom, how=how,
                     grid=grid_d)
    out = spatial_join(e, g, x="_rd_x", y="_rd_y", geom="_g_geom", how=how, grid=grid_g)
    if not keep_score_id:
        out = out.withColumn("score_id", F.col("score"))
    return out.select(*TOTAL_AREAS_COLUMNS)
