"""Area layer scan (S4) and the layer load job.

Layers arrive as GeoJSON: either line-delimited features or
FeatureCollection documents (one per line or per file).  Each feature gives
one row: its properties (keys lower-cased, values as text) and its geometry
parsed into the geometry struct, optionally reprojected at load time, as the
original reprojects layers once when loading them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridwise.functions.crs import st_transform
from gridwise.functions.geometry import geom_from_geojson
from gridwise.sources.split_json import list_texts

_MEMBER = "properties map<string, string>, geometry string"
_MEMBER_FIELDS = "properties:map<string,string>,geometry:string"
_FEATURE = "type string, properties map<string, string>, geometry string, features array<string>"


def _documents(spark: SparkSession, path: str, whole_files: bool) -> DataFrame:
    text = spark.read.text(path, wholetext=whole_files)
    return text.where(F.trim("value") != "").select(
        "value", F.from_json("value", _FEATURE).alias("d"))


def _is_known(d) -> F.Column:
    return F.coalesce((d["type"] == "Feature")
                      | ((d["type"] == "FeatureCollection") & d["features"].isNotNull()),
                      F.lit(False))


def read_area_layer(spark: SparkSession, path: str, to_srid: int | None = None,
                    whole_files: bool = False, geom: str = "wkb_geometry",
                    source_srid: int = 4326, mode: str = "failfast",
                    split: bool = False) -> DataFrame:
    """GeoJSON features -> rows of lower-cased properties + geometry.

    ``split=True`` reads each file as one FeatureCollection, however written, and of
    any size: many tasks share a file (``split_json``).  ``whole_files=True`` reads
    it in one task.  Otherwise every line is a Feature or a FeatureCollection.  A line that is neither raises in ``failfast`` mode; in
    ``permissive`` mode it gives no row and ``layer_rejects`` lists it.
    """
    if mode not in ("failfast", "permissive"):
        raise ValueError("mode must be 'failfast' or 'permissive'")
    if split:
        return _rows(_split_features(spark, path, mode), to_srid, geom, source_srid)
    docs = _documents(spark, path, whole_files)
    d = F.col("d")
    one = F.struct(d["properties"].alias("properties"), d["geometry"].alias("geometry"))
    many = F.transform(d["features"], lambda f: F.from_json(f, _MEMBER))
    unknown = F.lit(None)
    if mode == "failfast":
        unknown = F.raise_error(F.concat(
            F.lit("neither a Feature nor a FeatureCollection (is the file pretty-printed? "
                  "then read it with whole_files): "), F.substring("value", 1, 200)))
    feats = docs.select(F.explode(
        F.when(~_is_known(d), unknown.cast(f"array<struct<{_MEMBER_FIELDS}>>"))
        .when(d["type"] == "Feature", F.array(one)).otherwise(many)).alias("f"))
    return _rows(feats, to_srid, geom, source_srid)


def _split_features(spark: SparkSession, path: str, mode: str) -> DataFrame:
    member = F.from_json("value", _FEATURE)
    texts = list_texts(spark, path, "features", mode).select(member.alias("d"))
    return texts.where(F.col("d.type") == "Feature").select(
        F.struct("d.properties", "d.geometry").alias("f"))


def _rows(feats: DataFrame, to_srid: int | None, geom: str, source_srid: int) -> DataFrame:
    props = F.transform_keys(F.col("f.properties"), lambda k, v: F.lower(k))
    g = geom_from_geojson(F.col("f.geometry"), srid=source_srid)
    if to_srid is not None:
        g = st_transform(g, to_srid)
    return feats.select(props.alias("properties"), g.alias(geom))


def layer_rejects(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """The lines (or files) of a layer that hold no feature: column ``value``."""
    return _documents(spark, path, whole_files).where(~_is_known(F.col("d"))).select("value")


def layer_columns(layer: DataFrame, names: list[str], geom: str = "wkb_geometry") -> DataFrame:
    """Pick named properties as columns (absent -> null)."""
    return layer.select(*[F.col("properties")[n].alias(n) for n in names], F.col(geom))


def load_layers(spark: SparkSession, layers: dict[str, str], to_srid: int = 28992,
                geom: str = "wkb_geometry", source_srid: int = 4326) -> dict[str, DataFrame]:
    """Every named layer read and reprojected once; returns the frames
    (write them with ``sinks.tables.replace_table`` to persist).  Layers
    already in the target system (``source_srid == to_srid``) pass through."""
    return {name: read_area_layer(spark, path, to_srid=to_srid, geom=geom,
                                  source_srid=source_srid)
            for name, path in layers.items()}
