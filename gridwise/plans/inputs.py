"""Inputs derived from the driver's tables (``/root/testdata/sf*/``).

The original works on inspection documents from a web API and on polygon
layers of a city.  The driver gives TPC-H-like tables instead, so each input
here is a deterministic projection of whole tables onto the shapes the
operators expect: customers become points, nations become square
neighbourhoods, regions become bands, parts become inspections, and
customer -> orders -> lineitems become nested round documents.  The DuckDB
oracle in ``gridwise/oracle.py`` builds the same inputs in SQL.

Every input reads whole tables (no id subsets or row caps); its size grows
with the scale factor except for the fixed-size area layers built from
``nation``/``region``, which play the role of the (small) city layers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwise.functions.geometry import bound, make_box
from gridwise.operators.joins import broadcast_if_small
from gridwise.operators.nesting import nest, nest_rows
from gridwise.operators.spatial_join import computed_once


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def _div(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b)).cast("bigint")


def _h(v: Column) -> Column:
    """integer hundredths -> double (exactly v / 100.0)."""
    return v.cast("double") / F.lit(100.0)


def _txt(v: Column) -> Column:
    return v.cast("string")


# ---------------------------------------------------------------------------
# points, squares and bands (plain planar coordinates)
# ---------------------------------------------------------------------------

def pts(t: Tables) -> DataFrame:
    c = t("customer")
    return c.select(F.col("c_custkey").alias("id"),
                    _h((F.col("c_custkey") * 37) % 1000).alias("x"),
                    _h((F.col("c_custkey") * 91) % 1000).alias("y"))


def nb(t: Tables, geom: str = "geom") -> DataFrame:
    n = t("nation")
    k = F.col("n_nationkey")
    x0 = (k % 5) * 2
    y0 = _div(k, 5) * 2
    return n.select(F.lpad(_txt(k), 2, "0").alias("code"), F.col("n_name").alias("naam"),
                    make_box(x0, y0, x0 + 2, y0 + 2, srid=0).alias(geom))


def cust_squares(t: Tables, geom: str = "geom") -> DataFrame:
    """Customers as squares of side 0.5 centred on their point: a polygon
    layer that grows with the data."""
    c = t("customer")
    k = F.col("c_custkey")
    vx = (k * 37) % 1000
    vy = (k * 91) % 1000
    return c.select(k.alias("id"), F.right(F.col("c_name"), F.lit(3)).alias("code"),
                    F.col("c_name").alias("naam"),
                    make_box(_h(vx - 25), _h(vy - 25), _h(vx + 25), _h(vy + 25), srid=0)
                    .alias(geom))


def cust_squares_degrees(t: Tables, geom: str = "geom") -> DataFrame:
    """Customer squares in WGS 84 degrees (side 0.005 deg) around
    lon = 4.7 + vx/2000, lat = 52.2 + vy/2000."""
    c = t("customer")
    k = F.col("c_custkey")
    vlon = F.lit(47000) + ((k * 37) % 1000) * 5
    vlat = F.lit(522000) + ((k * 91) % 1000) * 5

    def deg(v):
        return v.cast("double") / F.lit(10000.0)

    return c.select(k.alias("id"), F.col("c_name").alias("naam"),
                    make_box(deg(vlon - 25), deg(vlat - 25), deg(vlon + 25), deg(vlat + 25))
                    .alias(geom))


DISC_RADIUS = 0.9137
DISC_VERTICES = 10_000


def discs(t: Tables, geom: str = "geom") -> DataFrame:
    """Nations as polygons of ``DISC_VERTICES`` vertices on a circle around the middle of
    their square of the plane (see ``nb``)."""
    n = t("nation")
    k = F.col("n_nationkey")
    step = 2 * math.pi / DISC_VERTICES
    ring = bound(f"""transform(sequence(0, {DISC_VERTICES}), i -> named_struct(
        'x', v.cx + {DISC_RADIUS}D * cos((i % {DISC_VERTICES}) * {step!r}D),
        'y', v.cy + {DISC_RADIUS}D * sin((i % {DISC_VERTICES}) * {step!r}D)))""",
                 cx=((k % 5) * 2 + 1).cast("double"), cy=(_div(k, 5) * 2 + 1).cast("double"))
    disc = F.struct(F.lit(0).alias("srid"), F.lit(2).alias("dim"),
                    F.array(F.array(ring)).alias("parts"))
    return n.select(_txt(k).alias("code"), F.col("n_name").alias("naam"), disc.alias(geom))


def collections(t: Tables) -> DataFrame:
    """The geometries of ``pts_geojson`` within collections: beside them, in a collection
    of its own, a point one unit to the right and an empty collection; every other one
    lies two collections deeper."""
    k = F.col("id")
    vx = (k * 37) % 1000
    vy = (k * 91) % 1000
    deep = F.when(k % 8 >= 4, F.concat(
        F.lit('{"type":"GeometryCollection","geometries":[{"type":"GeometryCollection","geometries":['),
        F.col("geojson"), F.lit("]}]}"))).otherwise(F.col("geojson"))
    point = F.concat(F.lit('{"type":"Point","coordinates":['), _txt(_h(vx + 100)), F.lit(","),
                     _txt(_h(vy)), F.lit("]}"))
    text = F.concat(F.lit('{"type":"GeometryCollection","geometries":['), deep,
                    F.lit(',{"type":"GeometryCollection","geometries":['), point,
                    F.lit(',{"type":"GeometryCollection","geometries":[]}]}]}'))
    return pts_geojson(t).select("id", text.alias("geojson"))


def bands(t: Tables, offset: int, geom: str = "geom") -> DataFrame:
    """Region bands x in (0, 10), y in (2r + offset, 2r + offset + 2)."""
    r = t("region")
    k = F.col("r_regionkey")
    return r.select(_txt(k).alias("code"), F.col("r_name").alias("naam"),
                    make_box(F.lit(0), k * 2 + offset, F.lit(10), k * 2 + offset + 2, srid=0)
                    .alias(geom))


def wa(t: Tables, geom: str = "geom") -> DataFrame:
    return bands(t, 1, geom)


def sdz(t: Tables, geom: str = "geom") -> DataFrame:
    return bands(t, 0, geom)


def pts_geojson(t: Tables) -> DataFrame:
    """Customers as GeoJSON geometries of four kinds, all centred on the
    customer point: Point, square Polygon, LineString, MultiPoint."""
    c = t("customer")
    k = F.col("c_custkey")
    vx = (k * 37) % 1000
    vy = (k * 91) % 1000

    def num(v):
        return _txt(_h(v))

    def xy(a, b):
        return F.concat(F.lit("["), num(a), F.lit(","), num(b), F.lit("]"))

    lo_x, hi_x, lo_y, hi_y = vx - 50, vx + 50, vy - 50, vy + 50
    kind = k % 4
    text = (F.when(kind == 0, F.concat(F.lit('{"type":"Point","coordinates":'), xy(vx, vy),
                                       F.lit("}")))
            .when(kind == 1, F.concat(F.lit('{"type":"Polygon","coordinates":[['),
                                      xy(lo_x, lo_y), F.lit(","), xy(hi_x, lo_y), F.lit(","),
                                      xy(hi_x, hi_y), F.lit(","), xy(lo_x, hi_y), F.lit(","),
                                      xy(lo_x, lo_y), F.lit("]]}")))
            .when(kind == 2, F.concat(F.lit('{"type":"LineString","coordinates":['),
                                      xy(lo_x, vy), F.lit(","), xy(hi_x, vy), F.lit("]}")))
            .otherwise(F.concat(F.lit('{"type":"MultiPoint","coordinates":['),
                                xy(lo_x, lo_y), F.lit(","), xy(hi_x, hi_y), F.lit("]}"))))
    return c.select(k.alias("id"), text.alias("geojson"))


# ---------------------------------------------------------------------------
# code tables for the hierarchy joins
# ---------------------------------------------------------------------------

def buurt_codes(t: Tables) -> DataFrame:
    c = t("customer")
    return c.select(F.right(F.col("c_name"), F.lit(3)).alias("code"),
                    F.col("c_name").alias("naam"))


def wijk_codes(t: Tables) -> DataFrame:
    """Quarters: one per 2-char supplier-name suffix (aggregated over all
    suppliers, so the layer stays small however many suppliers there are)."""
    s = t("supplier")
    suffix = F.right(F.col("s_name"), F.lit(2))
    g = s.groupBy(suffix.alias("code")).agg(F.min("s_nationkey").alias("_n"),
                                            F.min("s_name").alias("naam"))
    return g.select(F.concat(_txt(F.col("_n") % 7), F.col("code")).alias("vollcode"),
                    "code", "naam")


def sd_codes(t: Tables) -> DataFrame:
    r = t("region")
    return r.select(_txt(F.col("r_regionkey")).alias("code"), F.col("r_name").alias("naam"))


# ---------------------------------------------------------------------------
# flagship inputs: inspections (from part), score types, city layers in RD
# ---------------------------------------------------------------------------

def _dec4(v: str) -> str:
    """SQL text: integer ten-thousandths -> decimal text with 4 decimals."""
    return f"cast(floor(({v}) / 10000) as bigint), '.', lpad(cast(({v}) % 10000 as string), 4, '0')"


# lon = v.lon / 10000, lat = v.lat / 10000; 5 is half a side, in 1e-4 degrees
def _insp_geojson() -> str:
    def xy(dx: int, dy: int) -> str:
        return f"'[', {_dec4(f'v.lon + {dx}')}, ',', {_dec4(f'v.lat + {dy}')}, ']'"

    def ring(*corners: tuple[int, int]) -> str:
        return ", ',', ".join(xy(*c) for c in corners)

    return f"""case v.kind
      when 0 then concat('{{"type":"Point","coordinates":', {xy(0, 0)}, '}}')
      when 1 then concat('{{"type":"Polygon","coordinates":[[',
        {ring((-5, -5), (5, -5), (5, 5), (-5, 5), (-5, -5))}, ']]}}')
      when 2 then concat('{{"type":"LineString","coordinates":[', {ring((-5, 0), (5, 0))}, ']}}')
      else concat('{{"type":"MultiPoint","coordinates":[', {ring((-5, -5), (5, 5))}, ']}}') end"""


def insp_staging(t: Tables) -> DataFrame:
    """Flat staging rows (the shape the loader writes) built from ``part``."""
    p = t("part")
    k = F.col("p_partkey")
    vlon = F.lit(47000) + ((k * 37) % 1000) * 5    # lon = vlon / 10000
    vlat = F.lit(522000) + ((k * 91) % 1000) * 5   # lat = vlat / 10000
    geojson = bound(_insp_geojson(), kind=k % 4, lon=vlon, lat=vlat)
    day = F.lpad(_txt(k % 28 + 1), 2, "0")
    month = F.lpad(_txt(k % 12 + 1), 2, "0")
    no_photo = (k % 7) == 0
    return p.select(
        _div(k, 4).alias("id"),
        F.col("p_name").alias("inspectionRoundName"),
        F.concat(F.lit("2024-"), month, F.lit("-"), day).alias("createdAt"),
        F.col("p_size").cast("bigint").alias("creatingUserId"),
        F.concat(F.lit("2024-06-"), day).alias("modifiedAt"),
        F.when((k % 10) == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("2024-07-"), day)).alias("roundResultCompletedAt"),
        (k % 25).alias("score"),
        (k % 5).alias("inspectionItem.id"),
        k.alias("location.locationId"),
        (vlon.cast("double") / F.lit(10000.0)).alias("location.geoJsonProperties.x"),
        (vlat.cast("double") / F.lit(10000.0)).alias("location.geoJsonProperties.y"),
        F.when(no_photo, F.lit(None).cast("bigint")).otherwise(k * 10).alias("photos.0.id"),
        F.when(no_photo, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("/photos/"), _txt(k), F.lit(".jpg"))).alias("photos.0.uri"),
        geojson.alias("geojson"),
    )


def split_staging(staging: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Area rounds are the parts of size up to 25, object rounds the rest;
    the two staging tables together hold every part."""
    small = F.col("creatingUserId") <= 25
    return staging.where(small), staging.where(~small | F.col("creatingUserId").isNull())


def type_docs_region(t: Tables) -> DataFrame:
    """Score-type documents: one per region with its nations as options.
    ``nation`` is a fixed 25-row dimension, so each list is bounded."""
    n = t("nation")
    r = t("region")
    opts = nest(n, ["n_regionkey"], ["n_nationkey"], [
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("score "), F.col("n_name")).alias("description"),
        F.concat(F.lit("measure "), _txt(F.col("n_nationkey"))).alias("measuring_desc"),
    ], "inspectionItemOptions", span=64)
    return (r.join(opts, r["r_regionkey"] == opts["n_regionkey"], "inner")
            .select(F.col("r_regionkey").cast("bigint").alias("id"),
                    F.col("r_name").alias("inspectionItemName"),
                    "_chunk", "inspectionItemOptions"))


def type_docs_supplier(t: Tables) -> DataFrame:
    """Score-type documents that grow with the data: one type per nation, its
    options the nation's suppliers, in documents of spans of 1,024 supplier keys."""
    s = t("supplier")
    n = t("nation")
    opts = nest(s, ["s_nationkey"], ["s_suppkey"], [
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("score "), F.col("s_name")).alias("description"),
        F.concat(F.lit("measure "), _txt(F.col("s_suppkey") % 10)).alias("measuring_desc"),
    ], "inspectionItemOptions", span=1024)
    n = broadcast_if_small(n)
    return (opts.join(n, opts["s_nationkey"] == n["n_nationkey"], "inner")
            .select(F.col("s_nationkey").cast("bigint").alias("id"),
                    F.col("n_name").alias("inspectionItemName"),
                    "_chunk", "inspectionItemOptions"))


def rd_layers(t: Tables):
    """City layers in EPSG:28992: neighbourhood squares ``b6``, quarters
    ``w6``, districts ``s6`` and working-area bands ``g6``."""
    n = t("nation")
    r = t("region")
    k = F.col("n_nationkey")
    x0 = F.lit(108000) + (k % 5) * 7000
    y0 = F.lit(469000) + _div(k, 5) * 11000
    b6 = n.select(F.concat(F.lpad(_txt(k), 2, "0"), F.lit("a")).alias("code"),
                  F.col("n_name").alias("naam"),
                  make_box(x0, y0, x0 + 7000, y0 + 11000, srid=28992).alias("wkb_geometry"))
    w6 = n.select(F.concat(_txt(k % 7), F.lpad(_txt(k), 2, "0")).alias("vollcode"),
                  F.concat(F.lit("W"), F.col("n_name")).alias("naam"),
                  F.lpad(_txt(k), 2, "0").alias("code"))
    rk = F.col("r_regionkey")
    s6 = r.select(_txt(rk).alias("code"), F.col("r_name").alias("naam"))
    gy0 = F.lit(474000) + rk * 11000
    g6 = r.select(F.concat(F.lit("G"), _txt(rk)).alias("code"),
                  F.concat(F.lit("Gebied "), F.col("r_name")).alias("naam"),
                  make_box(F.lit(108000), gy0, F.lit(143000), gy0 + 11000, srid=28992)
                  .alias("wkb_geometry"))
    return b6, w6, s6, g6


# ---------------------------------------------------------------------------
# nested round documents: customer (round) -> orders (inspections) ->
# lineitems (results), in lists of bounded length
# ---------------------------------------------------------------------------

LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
              "l_shipdate"]


def _photos(k: Column, n: Column) -> Column:
    """0, 1 or 2 photos, depending on ``n``."""
    def ph(i):
        return F.struct((k * 10 + i).alias("id"),
                        F.concat(F.lit("/p/"), _txt(k), F.lit("_"), F.lit(str(i))).alias("uri"))
    return (F.when(n == 0, F.array().cast("array<struct<id:bigint,uri:string>>"))
            .when(n == 1, F.array(ph(0)))
            .otherwise(F.array(ph(0), ph(1))))


def _result(line: Column) -> Column:
    """The result document of a lineitem."""
    return F.struct(
        line["l_linenumber"].cast("bigint").alias("id"),
        (line["l_partkey"] % 25).alias("score"),
        F.struct((line["l_suppkey"] % 5).alias("id")).alias("inspectionItem"),
        F.concat(F.lit("user "), _txt(line["l_suppkey"])).alias("creatingUserDisplayName"),
        line["l_suppkey"].alias("creatingUserId"),
        _photos(line["l_partkey"], line["l_linenumber"] % 3).alias("photos"),
        line["l_quantity"].alias("quantity"),
        F.date_format(line["l_shipdate"], "yyyy-MM-dd").alias("createdAt"))


def _inspection(order: Column) -> Column:
    """The inspection document of an order with its list of lines."""
    ok = order["o_orderkey"]
    # WGS 84 degrees: lon = 4.7 + v/2000, lat = 52.2 + w/2000
    gx = (F.lit(47000) + ((ok * 37) % 1000) * 5).cast("double") / F.lit(10000.0)
    gy = (F.lit(522000) + ((ok * 91) % 1000) * 5).cast("double") / F.lit(10000.0)
    return F.struct(
        ok.alias("id"),
        order["o_orderpriority"].alias("closingUserDisplayName"),
        order["createdAt"].alias("createdAt"),
        F.struct(ok.alias("locationId"),
                 F.struct(gx.alias("x"), gy.alias("y")).alias("geoJsonProperties"),
                 F.struct(F.lit("Feature").alias("type"),
                          F.struct(F.lit("Point").alias("type"),
                                   F.array(gx, gy).alias("coordinates")).alias("geometry"))
                 .alias("geoJsonFeature")).alias("location"),
        order["o_orderstatus"].alias("status"),
        F.lit("x").alias("modifiedAt"),
        F.transform(order["lines"], _result).alias("results"))


def _or_empty(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast(df.schema[name].dataType))


def round_docs(t: Tables, line_span: int = 64, order_span: int = 1 << 16) -> DataFrame:
    """Rounds cut by spans of their orders' keys, results by spans of line numbers.

    The lines are shuffled twice, as bare columns: by order and, in lists of those that
    the documents need, by customer.  The documents' fields are made of them after that."""
    li = t("lineitem")
    o = t("orders")
    c = t("customer")
    lines = nest_rows(li, ["l_orderkey"], LINE_ORDER[1:], "lines", span=line_span,
                      together="l_orderkey")
    needed = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]
    lines = lines.withColumn("lines", F.transform(
        "lines", lambda e: F.struct(*[e[n].alias(n) for n in needed])))
    orders = (o.join(lines, o["o_orderkey"] == lines["l_orderkey"], "left")
              .select("o_custkey", "o_orderkey",
                      F.coalesce(F.col("_chunk"), F.lit(-1)).alias("_rchunk"),
                      _or_empty(lines, "lines").alias("lines"),
                      "o_orderpriority", "o_orderdate", "o_orderstatus"))
    insps = nest_rows(orders, ["o_custkey"], ["o_orderkey", "_rchunk"], "orders", span=order_span,
                      carried=[F.col("o_orderpriority"),
                               F.date_format("o_orderdate", "yyyy-MM-dd").alias("createdAt"),
                               F.col("o_orderstatus"), F.col("lines")], together="o_custkey")
    ck = F.col("c_custkey")
    day = F.lpad(_txt(ck % 28 + 1), 2, "0")
    docs = c.join(insps, c["c_custkey"] == insps["o_custkey"], "left")
    docs = docs.select(
        ck.alias("id"),
        F.col("c_name").alias("inspectionRoundName"),
        F.concat(F.lit("2024-01-"), day).alias("modifiedAt"),
        F.when((ck % 9) == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("2024-02-"), day)).alias("roundResultCompletedAt"),
        F.col("c_mktsegment").alias("segment"),
        F.coalesce(F.col("_chunk"), F.lit(-1)).alias("_doc_chunk"),
        _or_empty(insps, "orders").alias("_orders"),
    )
    return computed_once(docs, inspections=F.transform("_orders", _inspection)).drop("_orders")


def open_documents(t: Tables) -> DataFrame:
    """(id, value): a JSON text per order, with its lines as a list of objects that
    hold lists, a member ``x`` of another type in every kind of order, and a pair of
    members whose leaves have one path, in either order."""
    lines = nest_rows(t("lineitem"), ["l_orderkey"], LINE_ORDER[1:], "_lines", span=64,
                      together="l_orderkey")
    ok = F.col("o_orderkey")
    o = t("orders").join(lines, ok == F.col("l_orderkey"), "left")
    listed = F.transform("_lines", lambda e: F.struct(
        e["l_linenumber"].cast("bigint").alias("id"), e["l_partkey"].alias("part"),
        F.transform(F.sequence(F.lit(0), e["l_linenumber"].cast("int") % 3),
                    lambda i: F.concat(F.lit("t"), _txt(i))).alias("tags")))
    k = _txt(ok)
    x = (F.when(ok % 6 == 0, F.concat(F.lit(',"x":'), k))
         .when(ok % 6 == 1, F.concat(F.lit(',"x":"s '), k, F.lit('"')))
         .when(ok % 6 == 2, F.concat(F.lit(',"x":{"y":'), k, F.lit(',"z":null}')))
         .when(ok % 6 == 3, F.concat(F.lit(',"x":['), k, F.lit(',"{t}",true,null,[],{}]')))
         .when(ok % 6 == 4, F.lit(',"x":null')).otherwise(F.lit("")))
    pair = (F.when(ok % 7 == 0, F.concat(F.lit(',"a":{"b":'), k, F.lit('},"a.b":0')))
            .when(ok % 7 == 1, F.concat(F.lit(',"a.b":0,"a":{"b":'), k, F.lit("}")))
            .otherwise(F.lit("")))
    text = F.concat(F.lit('{"o":'), k, x, pair, F.lit(',"lines":'),
                    F.coalesce(F.to_json(listed), F.lit("[]")), F.lit("}"))
    return o.select(ok.alias("id"), text.alias("value"))


def events_json_text(t: Tables) -> DataFrame:
    """Heterogeneous JSON records: ``error`` events carry no ``value`` key."""
    e = t("events")
    base = F.struct("event_id", "event_type", "user_id")
    with_value = F.struct("event_id", "event_type", "user_id", "value")
    text = F.when(F.col("event_type") == "error", F.to_json(base)).otherwise(
        F.to_json(with_value))
    return e.select(text.alias("value"))


def mixed_round_texts(t: Tables) -> DataFrame:
    """One round document per part, as JSON text, with one inspection and one
    result.  The geometry's kind follows the key; ``modifiedAt`` is in every
    inspection, in even rounds (null in every fourth) not in odd ones; ``_tag`` is
    a key of every third round, ``note`` of every fifth inspection."""
    s = insp_staging(t)
    k = F.col("k")
    rows = s.select(F.col("`location.locationId`").alias("k"),
                    F.col("geojson").alias("g"), F.col("score"),
                    F.col("`inspectionItem.id`").alias("item"), "inspectionRoundName")

    def member(name: str, value: Column, when: Column | None = None) -> Column:
        text = F.concat(F.lit(f',"{name}":'), value)
        return text if when is None else F.when(when, text).otherwise("")

    def quoted(value: Column) -> Column:
        return F.concat(F.lit('"'), value, F.lit('"'))

    result = F.concat(F.lit('{"creatingUserDisplayName":"u"'), member("score", _txt(F.col("score"))),
                      member("inspectionItem", F.concat(F.lit('{"id":'), _txt(F.col("item")),
                                                        F.lit("}"))),
                      F.lit("}"))
    insp = F.concat(
        F.lit('{"closingUserDisplayName":"c"'), member("status", quoted(_txt(k % 7))),
        member("modifiedAt", quoted(F.concat(F.lit("i"), _txt(k)))),
        member("note", quoted(F.concat(F.lit("n"), _txt(k))), k % 5 == 0),
        member("location", F.concat(F.lit('{"locationId":'), _txt(k), F.lit(
            ',"geoJsonFeature":{"type":"Feature","geometry":'), F.col("g"), F.lit("}}"))),
        member("results", F.concat(F.lit("["), result, F.lit("]"))), F.lit("}"))
    doc = F.concat(
        F.lit('{"id":'), _txt(_div(k, 4)),
        member("inspectionRoundName", quoted(F.col("inspectionRoundName"))),
        member("modifiedAt", F.when(k % 4 == 0, F.lit("null")).otherwise(
            quoted(F.concat(F.lit("r"), _txt(k)))), k % 2 == 0),
        member("_tag", quoted(F.concat(F.lit("t"), _txt(k))), k % 3 == 0),
        member("inspections", F.concat(F.lit("["), insp, F.lit("]"))), F.lit("}"))
    return rows.select(doc.alias("value"))
