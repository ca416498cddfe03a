"""gridwise — field-inspection geo-ETL expressed as Spark DataFrame operators.

Sub-packages
------------
functions   Column-level functions: text keys, geometry, projection, JSON shape.
operators   DataFrame-level operators: explode/merge/flatten, key joins,
            grid-partitioned spatial join, row index.
sources     Readers: landed JSON documents, GeoJSON area layers, files, zips.
sinks       Writers: replace table, CSV export, GeoJSON, publish manifest.
plans       The user-facing jobs (load types/rounds/areas, enrich, publish).
streaming   The enrichment job run incrementally over landed documents.

The most used entry points are re-exported here::

    from gridwise import geom_from_geojson, st_centroid, wgs84_to_rd, spatial_join
"""

from gridwise.functions.crs import st_transform, wgs84_to_rd
from gridwise.functions.geometry import (bbox, geom_from_geojson, make_box, make_point,
                                         st_centroid, st_set_srid, st_within, st_x, st_y,
                                         to_geojson)
from gridwise.functions.text import (concat_text, content_type, dated_name, file_stem,
                                     key_text, mask_prefixed, str_left, str_right)
from gridwise.operators.joins import broadcast_if_small, join_concat_key, union_all
from gridwise.operators.row_index import with_row_index
from gridwise.operators.shape import (explode_rounds, explode_types, flatten_long,
                                      flatten_wide, merge_parent_wins)
from gridwise.operators.spatial_join import spatial_join, within_candidates
from gridwise.session import build_session, work_dir

__all__ = [
    "bbox", "broadcast_if_small", "build_session", "concat_text", "content_type",
    "dated_name", "explode_rounds", "explode_types", "file_stem", "flatten_long",
    "flatten_wide", "geom_from_geojson", "join_concat_key", "key_text", "make_box",
    "make_point", "mask_prefixed", "merge_parent_wins", "spatial_join", "st_centroid",
    "st_set_srid", "st_transform", "st_within", "st_x", "st_y", "str_left", "str_right",
    "to_geojson", "union_all", "wgs84_to_rd", "with_row_index", "within_candidates",
    "work_dir",
]
