"""Registered queries: one per operator / job of the inventory, each a
function ``(spark, sf_dir) -> DataFrame`` over the driver's tables.

Computed doubles that the oracle derives by plain arithmetic (centroids,
projected coordinates) are rounded in the final projection only, so that an
exact value-hash comparison is meaningful; the operators themselves never
round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwise.functions import geometry as G
from gridwise.functions.crs import wgs84_to_rd
from gridwise.functions.text import (concat_text, content_type, dated_name, file_ext,
                                     file_stem, key_text, mask_prefixed, str_left, str_right)
from gridwise.operators import shape
from gridwise.operators.joins import join_concat_key, join_prefix, union_all
from gridwise.operators.row_index import with_row_index
from gridwise.session import work_dir
from gridwise.operators.spatial_join import spatial_join, within_candidates
from gridwise.plans import enrich, inputs as I
from gridwise.plans.loaders import inspection_rounds, inspection_types, landed_rounds

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function name (a trailing ``_q`` avoids clashing
    with the operator it exercises and is not part of the key)."""
    name = fn.__name__
    REGISTRY[name[:-2] if name.endswith("_q") else name] = fn
    return fn


def _t(spark, sf_dir):
    return I.Tables(spark, sf_dir)


# ---------------------------------------------------------------------------
# spatial
# ---------------------------------------------------------------------------

@query
def spatial_join_points(spark, sf_dir):
    t = _t(spark, sf_dir)
    return spatial_join(I.pts(t), I.nb(t)).select("id", "x", "y", "code", "naam")


@query
def spatial_join_two_layers(spark, sf_dir):
    t = _t(spark, sf_dir)
    first = spatial_join(I.pts(t), I.nb(t))
    wa = I.wa(t).select(F.col("code").alias("gebiedscode"),
                        F.col("naam").alias("gebiedsnaam"), "geom")
    return spatial_join(first, wa).select("id", "x", "y", "code", "naam",
                                          "gebiedscode", "gebiedsnaam")


def _square_centroids(t):
    sq = I.cust_squares(t)
    c = G.st_centroid(F.col("geom"))
    return sq.withColumn("_c", c).withColumn("cx", G.st_x("_c")).withColumn(
        "cy", G.st_y("_c")).drop("_c")


@query
def spatial_join_centroids(spark, sf_dir):
    t = _t(spark, sf_dir)
    s = I.sdz(t).select(F.col("code").alias("stadsdeelcode"),
                        F.col("naam").alias("stadsdeelnaam"), F.col("geom").alias("s_geom"))
    return (spatial_join(_square_centroids(t).drop("geom"), s, x="cx", y="cy", geom="s_geom")
            .select("id", "code", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"),
                    "stadsdeelcode", "stadsdeelnaam"))


@query
def st_within(spark, sf_dir):
    t = _t(spark, sf_dir)
    return within_candidates(I.pts(t), I.nb(t)).select("id", "code", "within")


def _parsed(t):
    return I.pts_geojson(t).withColumn("geom", G.geom_from_geojson(F.col("geojson")))


@query
def geom_from_geojson(spark, sf_dir):
    t = _t(spark, sf_dir)
    g = F.col("geom")
    b = G.bbox(g)
    return _parsed(t).select("id", g["dim"].alias("dim"), F.size(g["parts"]).alias("n_parts"),
                             F.size(G.vertices(g)).alias("n_vertices"),
                             b["minx"].alias("minx"), b["miny"].alias("miny"),
                             b["maxx"].alias("maxx"), b["maxy"].alias("maxy"))


@query
def st_centroid(spark, sf_dir):
    t = _t(spark, sf_dir)
    c = G.st_centroid(F.col("geom"))
    return _parsed(t).select("id", F.round(G.st_x(c), 6).alias("cx"),
                             F.round(G.st_y(c), 6).alias("cy"))


@query
def nested_collections(spark, sf_dir):
    t = _t(spark, sf_dir)
    c = G.st_centroid(G.geom_from_geojson(F.col("geojson")))
    return I.collections(t).select("id", F.round(G.st_x(c), 6).alias("cx"),
                                   F.round(G.st_y(c), 6).alias("cy"))


@query
def st_within_flag(spark, sf_dir):
    """``ST_Within`` itself, row by row: points on a line through each square."""
    t = _t(spark, sf_dir)
    b = I.pts(t).select("id", F.explode(F.sequence(F.lit(-2), F.lit(2))).alias("step"), "x", "y")
    b = b.join(I.cust_squares(t).select("id", "geom"), "id")
    x = F.col("x") + F.col("step").cast("double") / F.lit(8.0)
    return b.select("id", "step", G.st_within(x, F.col("y"), F.col("geom")).alias("within"))


@query
def spatial_join_detailed(spark, sf_dir):
    """Points against polygons of 10,000 vertices."""
    t = _t(spark, sf_dir)
    return spatial_join(I.pts(t), I.discs(t)).select("id", "code", "naam")


@query
def st_xy(spark, sf_dir):
    t = _t(spark, sf_dir)
    p = G.make_point(F.col("x"), F.col("y"))
    return I.pts(t).select("id", G.st_x(p).alias("px"), G.st_y(p).alias("py"))


@query
def st_set_srid(spark, sf_dir):
    t = _t(spark, sf_dir)
    g2 = G.st_set_srid(F.col("geom"), 28992)
    return _parsed(t).select("id", F.col("geom")["srid"].alias("srid_before"),
                             g2["srid"].alias("srid"),
                             F.size(G.vertices(g2)).alias("n_vertices"))


def _insp_lonlat(t):
    p = t("part")
    k = F.col("p_partkey")
    lon = (F.lit(47000) + ((k * 37) % 1000) * 5).cast("double") / F.lit(10000.0)
    lat = (F.lit(522000) + ((k * 91) % 1000) * 5).cast("double") / F.lit(10000.0)
    return p.select(k.alias("id"), lon.alias("lon"), lat.alias("lat"))


@query
def st_transform_q(spark, sf_dir):
    t = _t(spark, sf_dir)
    rd = wgs84_to_rd(F.col("lon"), F.col("lat"))
    return _insp_lonlat(t).select("id", F.round(rd["x"], 2).alias("rd_x"),
                                  F.round(rd["y"], 2).alias("rd_y"))


# ---------------------------------------------------------------------------
# flagship chain
# ---------------------------------------------------------------------------

def _total(t):
    types = inspection_types(I.type_docs_region(t), doc_order=["id", "_chunk"],
                             with_index=False)
    area, obj = I.split_staging(I.insp_staging(t))
    return enrich.inspections_total(area, obj, types)


@query
def inspections_total(spark, sf_dir):
    t = _t(spark, sf_dir)
    e = _total(t)
    cols = [c for c in e.columns if c not in ("lat", "lon", "geom")]
    return e.select(*cols, F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"),
                    F.col("geom")["srid"].alias("geom_srid"),
                    F.col("geom")["dim"].alias("geom_dim"))


def flagship(t) -> DataFrame:
    b6, w6, s6, g6 = I.rd_layers(t)
    d = enrich.area_hierarchy(b6, w6, s6)
    return enrich.inspections_total_areas(_total(t), d, g6)


@query
def inspections_total_areas(spark, sf_dir):
    t = _t(spark, sf_dir)
    e = flagship(t)
    return e.withColumn("lat", F.round("lat", 9)).withColumn("lon", F.round("lon", 9))


@query
def inspections_changed_areas(spark, sf_dir):
    """E6 over layers of which three neighbourhoods and a working area changed since the
    table was published: one is new, one moved, one has another name, one was dropped."""
    from gridwise.plans.changed_areas import update_areas
    from gridwise.sinks.tables import scan_table
    from gridwise.sinks.versions import replace_version
    t = _t(spark, sf_dir)
    b6, w6, s6, g6 = I.rd_layers(t)
    k = F.col("code")
    moved = G.make_box(F.lit(109500), F.lit(481000), F.lit(116500), F.lit(492000), srid=28992)
    old_b = (b6.where(k != "03a").withColumn("naam", F.when(k == "07a", "former").otherwise(F.col("naam")))
             .withColumn("wkb_geometry", F.when(k == "05a", moved).otherwise(F.col("wkb_geometry"))))
    gone = G.make_box(F.lit(120000), F.lit(480000), F.lit(121000), F.lit(490000), srid=28992)
    old_g = g6.unionByName(g6.where(k == "G0").withColumn("wkb_geometry", gone))
    total = _total(t)
    old_d, d = enrich.area_hierarchy(old_b, w6, s6), enrich.area_hierarchy(b6, w6, s6)
    path = replace_version(enrich.inspections_total_areas(total, old_d, old_g),
                           work_dir(spark, "published_areas"))
    e = update_areas(scan_table(spark, path), total, old_d, d, old_g, g6)
    return e.withColumn("lat", F.round("lat", 9)).withColumn("lon", F.round("lon", 9))


@query
def inspections_end_to_end(spark, sf_dir):
    """The production flow in one plan: nested round documents -> E2 staging
    rows (area rounds: status F, object rounds: the rest) -> E4 -> E6."""
    t = _t(spark, sf_dir)
    staging = inspection_rounds(I.round_docs(t), doc_order=["id", "_doc_chunk"],
                                with_index=False)
    final = F.col("status") == "F"
    area = staging.where(final)
    obj = staging.where(~final | F.col("status").isNull())
    types = inspection_types(I.type_docs_region(t), doc_order=["id", "_chunk"],
                             with_index=False)
    b6, w6, s6, g6 = I.rd_layers(t)
    total = enrich.inspections_total(area, obj, types)
    out = enrich.inspections_total_areas(total, enrich.area_hierarchy(b6, w6, s6), g6)
    return out.withColumn("lat", F.round("lat", 9)).withColumn("lon", F.round("lon", 9))


# ---------------------------------------------------------------------------
# keys, unions, code joins
# ---------------------------------------------------------------------------

def _staging_pairs(t):
    p = t("part")
    sel = [F.col("p_partkey"), F.col("p_size").alias("t"), (F.col("p_partkey") % 25).alias("s")]
    small = p.where(F.col("p_size") <= 25).select(*sel)
    large = p.where(~(F.col("p_size") <= 25) | F.col("p_size").isNull()).select(*sel)
    return small, large


@query
def union_all_q(spark, sf_dir):
    t = _t(spark, sf_dir)
    a, b = _staging_pairs(t)
    return union_all(a, b)


def _key_join(t, strict):
    a, b = _staging_pairs(t)
    s = t("supplier").select("s_suppkey", "s_nationkey")
    return join_concat_key(union_all(a, b), s, ["t", "s"], ["s_suppkey", "s_nationkey"],
                           strict_keys=strict).select("p_partkey", "t", "s", "s_suppkey",
                                                      "s_nationkey")


@query
def join_concat_key_q(spark, sf_dir):
    return _key_join(_t(spark, sf_dir), False)


@query
def join_typed_pair(spark, sf_dir):
    return _key_join(_t(spark, sf_dir), True)


@query
def project_rename(spark, sf_dir):
    c = _t(spark, sf_dir)("customer")
    staging = c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("inspectionRoundName"),
        F.col("c_mktsegment").alias("createdAt"),
        F.col("c_nationkey").cast("bigint").alias("location.locationId"),
        F.col("c_acctbal").alias("location.geoJsonProperties.x"),
        F.concat(F.lit("/p/"), F.col("c_custkey").cast("string")).alias("photos.0.uri"))
    return enrich.project_rename(staging)


@query
def str_left_right(spark, sf_dir):
    c = _t(spark, sf_dir)("customer")
    return c.select("c_custkey", str_left("c_name", 4).alias("l4"),
                    str_right("c_name", 3).alias("r3"))


@query
def str_concat(spark, sf_dir):
    c = _t(spark, sf_dir)("customer")
    return c.select("c_custkey", concat_text(F.col("c_mktsegment"), F.lit("|"),
                                             F.when(F.col("c_acctbal") > 0, F.col("c_name")))
                    .alias("k"))


@query
def cast_text(spark, sf_dir):
    o = _t(spark, sf_dir)("orders")
    return o.select("o_orderkey",
                    key_text(F.col("o_orderkey").cast("double")).alias("key_txt"),
                    key_text(F.col("o_totalprice")).alias("price_txt"))


@query
def mask_prefixed_q(spark, sf_dir):
    c = _t(spark, sf_dir)("customer")
    k = F.col("c_custkey")
    e0 = (F.when(k % 4 == 0, F.concat(F.lit("PG:host="), F.col("c_name")))
          .when(k % 4 == 1, F.concat(F.lit("  PG:"), F.col("c_name")))
          .when(k % 4 == 2, F.concat(F.lit("\tPG:"), F.col("c_name")))
          .otherwise(F.concat(F.lit("host PG:"), F.col("c_name"))))
    m = mask_prefixed(F.array(e0, F.col("c_mktsegment"), F.concat(F.lit(" x"), F.col("c_name"))))
    return c.select("c_custkey", F.get(m, 0).alias("a0"), F.get(m, 1).alias("a1"),
                    F.get(m, 2).alias("a2"))


@query
def dated_name_q(spark, sf_dir):
    c = _t(spark, sf_dir)("customer")
    return c.select("c_custkey", dated_name(F.col("c_name"), "2024-01-01").alias("file_name"))


@query
def content_type_q(spark, sf_dir):
    p = _t(spark, sf_dir)("pages")
    return p.select("page_id", file_ext("url").alias("ext"),
                    content_type("url").alias("content_type"))


@query
def file_stem_q(spark, sf_dir):
    p = _t(spark, sf_dir)("pages")
    return p.select("page_id", file_stem("url").alias("stem"))


@query
def with_row_index_q(spark, sf_dir):
    o = _t(spark, sf_dir)("orders").select("o_orderkey", "o_custkey")
    return with_row_index(o, ["o_orderkey"]).select("o_orderkey", "o_custkey", "idx")


@query
def join_left_suffix_prefix(spark, sf_dir):
    t = _t(spark, sf_dir)
    b = I.buurt_codes(t)
    w = I.wijk_codes(t).select(F.col("vollcode").alias("wijkcode"),
                               F.col("naam").alias("wijknaam"))
    return join_prefix(b, w, str_left(F.col("code"), 2), str_right(F.col("wijkcode"), 2),
                       "left").select("code", F.col("naam").alias("buurtnaam"),
                                      "wijkcode", "wijknaam")


@query
def area_hierarchy(spark, sf_dir):
    t = _t(spark, sf_dir)
    return enrich.area_hierarchy(I.buurt_codes(t), I.wijk_codes(t), I.sd_codes(t), geom=None)


@query
def area_hierarchy_prefix(spark, sf_dir):
    t = _t(spark, sf_dir)
    return enrich.area_hierarchy_prefix(I.buurt_codes(t), I.wijk_codes(t), I.sd_codes(t),
                                        geom=None)


@query
def area_hierarchy_spatial(spark, sf_dir):
    t = _t(spark, sf_dir)
    sq = I.cust_squares(t, geom="wkb_geometry")
    sd = I.sdz(t, geom="wkb_geometry")
    out = enrich.area_hierarchy_spatial(sq, sd, I.wijk_codes(t))
    b = G.bbox(F.col("wkb_geometry"))
    return out.select("stadsdeelcode", "buurtcode", "wijkcode", "stadsdeelnaam", "buurtnaam",
                      "wijknaam", b["minx"].alias("minx"), b["miny"].alias("miny"),
                      b["maxx"].alias("maxx"), b["maxy"].alias("maxy"))


# ---------------------------------------------------------------------------
# documents: explode / merge / flatten
# ---------------------------------------------------------------------------

@query
def explode_types(spark, sf_dir):
    t = _t(spark, sf_dir)
    return inspection_types(I.type_docs_supplier(t), doc_order=["id", "_chunk"],
                            with_index=False)


@query
def inspection_types_q(spark, sf_dir):
    t = _t(spark, sf_dir)
    return inspection_types(I.type_docs_supplier(t), doc_order=["id", "_chunk"])


def _rounds(t):
    return shape.explode_rounds(I.round_docs(t), doc_order=["id", "_doc_chunk"])


@query
def explode_rounds(spark, sf_dir):
    r = _rounds(_t(spark, sf_dir))
    rec = F.col("rec")
    return r.select(rec["id"].alias("round_id"),
                    rec["location"]["locationId"].alias("order_id"),
                    rec["score"].alias("score"), rec["quantity"].alias("quantity"),
                    rec["creatingUserId"].alias("creating_user_id"), "geojson")


@query
def merge_parent_wins(spark, sf_dir):
    r = _rounds(_t(spark, sf_dir))
    rec = F.col("rec")
    return r.select(rec["id"].alias("id"), rec["createdAt"].alias("createdAt"),
                    rec["modifiedAt"].alias("modifiedAt"),
                    rec["creatingUserId"].alias("creatingUserId"),
                    rec["status"].alias("status"), rec["segment"].alias("segment"),
                    rec["inspectionRoundName"].alias("inspectionRoundName"))


@query
def inspection_rounds_q(spark, sf_dir):
    t = _t(spark, sf_dir)
    return inspection_rounds(I.round_docs(t), doc_order=["id", "_doc_chunk"])


def _events(t):
    return t("events")


@query
def drop_fields(spark, sf_dir):
    e = _events(_t(spark, sf_dir))
    st = F.struct("event_id", "event_type",
                  F.concat(F.lit("u"), F.col("user_id").cast("string"))
                  .alias("closingUserDisplayName"), "value")
    df = e.select(st.alias("r"))
    stype = df.schema["r"].dataType
    out = df.select(shape.drop_fields(F.col("r"), stype, ("closingUserDisplayName",)).alias("r"))
    return out.select("r.*")


@query
def drop_key(spark, sf_dir):
    e = _events(_t(spark, sf_dir))
    m = F.create_map(F.lit("event_type"), F.col("event_type"),
                     F.lit("dates"), F.date_format("ts", "yyyy-MM-dd"),
                     F.lit("props"), F.col("props"))
    d = shape.drop_key(m, "dates")
    return e.select("event_id", F.size(d).alias("n_keys"),
                    F.array_contains(F.map_keys(d), "dates").alias("has_dates"),
                    d["event_type"].alias("event_type"), d["props"].alias("props"))


@query
def extract_geojson(spark, sf_dir):
    p = I.pts(_t(spark, sf_dir))
    geom = F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(
        F.struct(F.lit("Point").alias("type"), F.array("x", "y").alias("coordinates")))
    doc = p.select("id", F.struct(F.struct(F.lit("Feature").alias("type"),
                                           geom.alias("geometry")).alias("geoJsonFeature"))
                   .alias("location"))
    gtype = shape.field_type(doc.schema, "location.geoJsonFeature.geometry")
    return doc.select("id", shape.extract_json(F.col("location"), "geoJsonFeature.geometry",
                                               gtype).alias("geojson"))


def _event_records(e):
    return e.select("event_id", F.struct(
        "event_type", "user_id",
        F.from_json("props", "k bigint").alias("props")).alias("r"))


@query
def flatten_long(spark, sf_dir):
    df = _event_records(_events(_t(spark, sf_dir)))
    return shape.flatten_long(df, "event_id", "r")


@query
def flatten_open(spark, sf_dir):
    """Documents of open schema, unfolded as variants."""
    docs = I.open_documents(_t(spark, sf_dir))
    return shape.flatten_json_long(docs, ["id"], "value")


@query
def flatten_wide(spark, sf_dir):
    from gridwise.sources.documents import read_json_text, write_json_text
    e = _events(_t(spark, sf_dir))
    text = e.select(F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"),
                             F.lit(',"props":'), F.col("props"), F.lit("}")).alias("value"))
    path = write_json_text(spark, text, "flatten_wide")
    return shape.flatten_wide(read_json_text(spark, path))


@query
def array_first(spark, sf_dir):
    li = _t(spark, sf_dir)("lineitem")
    photos = I._photos(F.col("l_partkey"), F.col("l_linenumber") % 3)
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     shape.array_first(photos, "id").alias("photo_id"),
                     shape.array_first(photos, "uri").alias("photo_uri"))


@query
def nested_field(spark, sf_dir):
    e = _events(_t(spark, sf_dir))
    doc = e.select("event_id", F.struct(
        F.col("event_id").alias("locationId"),
        F.struct(F.col("value").alias("x"), F.col("user_id").alias("y"))
        .alias("geoJsonProperties")).alias("location"))
    return doc.select("event_id",
                      shape.nested_field("location", "geoJsonProperties.x").alias("x"),
                      shape.nested_field("location", "geoJsonProperties.y").alias("y"))


def _mixed_documents(spark, sf_dir):
    """Round documents as landed JSON texts (see ``inputs.mixed_round_texts``)."""
    from gridwise.sources.documents import write_json_text
    t = _t(spark, sf_dir)
    return write_json_text(spark, I.mixed_round_texts(t), "mixed_rounds")


@query
def inspection_rounds_mixed(spark, sf_dir):
    """E2 over documents with four kinds of geometry and with keys that only some
    rounds or inspections have."""
    rows = landed_rounds(spark, _mixed_documents(spark, sf_dir), with_index=False)
    return rows.select("id", F.col("`location.locationId`").alias("part"), "score", "status",
                       "modifiedAt", "_tag", "note", "geojson")


@query
def inspections_mixed_areas(spark, sf_dir):
    """The same documents through E2, E4 and E6."""
    t = _t(spark, sf_dir)
    staging = landed_rounds(spark, _mixed_documents(spark, sf_dir), with_index=False)
    types = inspection_types(I.type_docs_region(t), doc_order=["id", "_chunk"], with_index=False)
    b6, w6, s6, g6 = I.rd_layers(t)
    total = enrich.inspections_total(staging, staging.where("false"), types)
    out = enrich.inspections_total_areas(total, enrich.area_hierarchy(b6, w6, s6), g6)
    return out.select("inspection_round_id", "location_id", "score", "stadsdeelcode", "wijkcode",
                      "buurtcode", "gebiedscode", F.round("lat", 9).alias("lat"),
                      F.round("lon", 9).alias("lon"))


def all_queries() -> dict[str, Query]:
    # import for registration side effects
    from gridwise.plans import io_queries  # noqa: F401
    return dict(REGISTRY)
