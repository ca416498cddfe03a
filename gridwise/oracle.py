"""DuckDB SQL equivalents of the registered queries, over the driver's
tables (pre-registered as views).  Each builds the same derived inputs as
``gridwise/plans/inputs.py`` in plain SQL and computes the expected result
with ordinary arithmetic (strict inequalities for containment, the
closed-form projection for coordinates)."""

from __future__ import annotations

import math


# WGS 84 longitude and latitude -> RD New, by the definition of the projection
# and independent of the engine's chain: geodetic latitude by iteration, the
# conformal sphere by isometric latitudes, the stereographic projection by the
# angle from the origin.
# Fixed values (published EPSG parameters):
#   WGS 84 a = 6378137, 1/f = 298.257223563; Bessel 1841 a = 6377397.155,
#   1/f = 299.1528128; Amersfoort to WGS 84: translation (565.2369, 50.0087,
#   465.658) m, rotation (-0.406857330322398, 0.350732676542563,
#   -1.8703473836068) arc seconds, 4.0812 ppm, position vector; origin
#   52 09 22.178 N, 5 23 15.5 E, scale 0.9999079, false origin (155000, 463000)
def rd_sql(src: str, lon: str, lat: str) -> str:
    """A subquery that adds ``rd_x`` and ``rd_y`` to the rows of ``src``."""
    def squared(inverse_flattening):
        return (2 - 1 / inverse_flattening) / inverse_flattening

    def isometric(phi, e):
        return (math.log(math.tan(math.pi / 4 + phi / 2))
                - e / 2 * math.log((1 + e * math.sin(phi)) / (1 - e * math.sin(phi))))

    ew2, a, eb2 = squared(298.257223563), 6377397.155, squared(299.1528128)
    e = math.sqrt(eb2)
    rx, ry, rz = (math.radians(v / 3600) for v in
                  (-0.406857330322398, 0.350732676542563, -1.8703473836068))
    scale = 1 + 4.0812e-6
    phi0 = math.radians(52 + 9 / 60 + 22.178 / 3600)
    lam0 = math.radians(5 + 23 / 60 + 15.5 / 3600)
    w = 1 - eb2 * math.sin(phi0) ** 2
    radius = a * math.sqrt(1 - eb2) / w
    n = math.sqrt(1 + eb2 * math.cos(phi0) ** 4 / (1 - eb2))
    b0 = math.asin(math.sin(phi0) / n)
    m = math.log(math.tan(math.pi / 4 + b0 / 2)) - n * isometric(phi0, e)
    at = (f"SELECT *, radians({lon}) AS z_l, radians({lat}) AS z_p FROM {src}")
    at = f"SELECT *, 6378137.0 / sqrt(1 - {ew2!r} * pow(sin(z_p), 2)) AS z_n FROM ({at})"
    at = (f"SELECT *, (z_n * cos(z_p) * cos(z_l) - 565.2369) / {scale!r} AS z_x, "
          f"(z_n * cos(z_p) * sin(z_l) - 50.0087) / {scale!r} AS z_y, "
          f"(z_n * {1 - ew2!r} * sin(z_p) - 465.658) / {scale!r} AS z_z FROM ({at})")
    at = (f"SELECT *, z_x + ({rz!r}) * z_y - ({ry!r}) * z_z AS z_u, "
          f"z_y - ({rz!r}) * z_x + ({rx!r}) * z_z AS z_v, "
          f"z_z + ({ry!r}) * z_x - ({rx!r}) * z_y AS z_w FROM ({at})")
    at = (f"SELECT *, sqrt(z_u * z_u + z_v * z_v) AS z_r, atan2(z_v, z_u) AS z_lam, "
          f"atan2(z_w, sqrt(z_u * z_u + z_v * z_v) * {1 - eb2!r}) AS z_f0 FROM ({at})")
    for i in range(6):
        at = (f"SELECT *, atan2(z_w + {eb2 * a!r} * sin(z_f{i}) / sqrt(1 - {eb2!r} * "
              f"pow(sin(z_f{i}), 2)), z_r) AS z_f{i + 1} FROM ({at})")
    at = (f"SELECT *, 2 * atan(exp({n!r} * (ln(tan({math.pi / 4!r} + z_f6 / 2)) - {e / 2!r} * "
          f"ln((1 + {e!r} * sin(z_f6)) / (1 - {e!r} * sin(z_f6)))) + ({m!r}))) - {math.pi / 2!r} "
          f"AS z_b, {n!r} * (z_lam - {lam0!r}) AS z_d FROM ({at})")
    half = (f"pow(sin((z_b - {b0!r}) / 2), 2) + pow(sin(z_d / 2), 2) * cos(z_b) * {math.cos(b0)!r}")
    at = f"SELECT *, 2 * asin(sqrt({half})) AS z_s FROM ({at})"
    # the length 2 k R tan(s / 2), divided by sin(s) once for both directions
    at = (f"SELECT *, CASE WHEN z_s = 0 THEN {0.9999079 * radius!r} ELSE "
          f"{2 * 0.9999079 * radius!r} * tan(z_s / 2) / sin(z_s) END AS z_k FROM ({at})")
    return (f"SELECT *, 155000 + z_k * sin(z_d) * cos(z_b) AS rd_x, 463000 + z_k * "
            f"(sin(z_b) - {math.sin(b0)!r} * cos(z_s)) / {math.cos(b0)!r} AS rd_y FROM ({at})")


PTS = ("SELECT c_custkey AS id, CAST((c_custkey * 37) % 1000 AS DOUBLE) / 100.0 AS x, "
       "CAST((c_custkey * 91) % 1000 AS DOUBLE) / 100.0 AS y, "
       "(c_custkey * 37) % 1000 AS vx, (c_custkey * 91) % 1000 AS vy FROM customer")
NB = ("SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, n_name AS naam, "
      "(n_nationkey % 5) * 2 AS x0, (n_nationkey // 5) * 2 AS y0 FROM nation")
WA = "SELECT CAST(r_regionkey AS VARCHAR) AS code, r_name AS naam, 2 * r_regionkey + 1 AS y0 FROM region"
SDZ = "SELECT CAST(r_regionkey AS VARCHAR) AS code, r_name AS naam, 2 * r_regionkey AS y0 FROM region"
BUURT = "SELECT right(c_name, 3) AS code, c_name AS naam FROM customer"
WIJK = ("SELECT CAST(min(s_nationkey) % 7 AS VARCHAR) || right(s_name, 2) AS vollcode, "
        "right(s_name, 2) AS code, min(s_name) AS naam FROM supplier GROUP BY right(s_name, 2)")
QUARTERS = ("SELECT s_suppkey % 100 AS q, min(s_nationkey) % 7 AS digit, min(s_name) AS qname "
            "FROM supplier GROUP BY s_suppkey % 100")
SD = "SELECT CAST(r_regionkey AS VARCHAR) AS code, r_name AS naam FROM region"

SQ = ("SELECT c_custkey AS id, right(c_name, 3) AS code, c_name AS naam, "
      "CAST((c_custkey * 37) % 1000 AS DOUBLE) / 100.0 AS x, "
      "CAST((c_custkey * 91) % 1000 AS DOUBLE) / 100.0 AS y, "
      "CAST((c_custkey * 37) % 1000 - 25 AS DOUBLE) / 100.0 AS x0, "
      "CAST((c_custkey * 91) % 1000 - 25 AS DOUBLE) / 100.0 AS y0, "
      "CAST((c_custkey * 37) % 1000 + 25 AS DOUBLE) / 100.0 AS x1, "
      "CAST((c_custkey * 91) % 1000 + 25 AS DOUBLE) / 100.0 AS y1 FROM customer")
INSIDE_NB = "p.x > n.x0 AND p.x < n.x0 + 2 AND p.y > n.y0 AND p.y < n.y0 + 2"


def _h(v: str) -> str:
    return f"(CAST({v} AS DOUBLE) / 100.0)"


# flagship inputs ----------------------------------------------------------
INSP = (
    "SELECT p_partkey AS k, p_partkey // 4 AS id, p_name AS inspectionRoundName, "
    "'2024-' || lpad(CAST(p_partkey % 12 + 1 AS VARCHAR), 2, '0') || '-' || "
    "lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0') AS createdAt, "
    "CAST(p_size AS BIGINT) AS creatingUserId, "
    "'2024-06-' || lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0') AS modifiedAt, "
    "CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE '2024-07-' || "
    "lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0') END AS roundResultCompletedAt, "
    "p_partkey % 25 AS score, p_partkey % 5 AS item_id, p_partkey AS location_id, "
    "47000 + ((p_partkey * 37) % 1000) * 5 AS vlon, "
    "522000 + ((p_partkey * 91) % 1000) * 5 AS vlat, "
    "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_partkey * 10 END AS photo_id, "
    "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE '/photos/' || CAST(p_partkey AS VARCHAR) "
    "|| '.jpg' END AS photo_uri FROM part"
)


def _dec4(v: str) -> str:
    return (f"(CAST(({v}) // 10000 AS VARCHAR) || '.' || "
            f"lpad(CAST(({v}) % 10000 AS VARCHAR), 4, '0'))")


def _xy4(a: str, b: str) -> str:
    return f"'[' || {_dec4(a)} || ',' || {_dec4(b)} || ']'"


def _xyd(a: str, b: str) -> str:
    """The same pair as a JSON writer prints doubles."""
    return ("'[' || " + " || ',' || ".join(f"CAST(CAST({v} AS DOUBLE) / 10000.0 AS VARCHAR)"
                                            for v in (a, b)) + " || ']'")


def _geojson(xy) -> str:
    return (
        "CASE k % 4 "
        f"WHEN 0 THEN '{{\"type\":\"Point\",\"coordinates\":' || {xy('vlon', 'vlat')} || '}}' "
        "WHEN 1 THEN '{\"type\":\"Polygon\",\"coordinates\":[[' || "
        f"{xy('vlon - 5', 'vlat - 5')} || ',' || {xy('vlon + 5', 'vlat - 5')} || ',' || "
        f"{xy('vlon + 5', 'vlat + 5')} || ',' || {xy('vlon - 5', 'vlat + 5')} || ',' || "
        f"{xy('vlon - 5', 'vlat - 5')} || ']]}}' "
        "WHEN 2 THEN '{\"type\":\"LineString\",\"coordinates\":[' || "
        f"{xy('vlon - 5', 'vlat')} || ',' || {xy('vlon + 5', 'vlat')} || ']}}' "
        "ELSE '{\"type\":\"MultiPoint\",\"coordinates\":[' || "
        f"{xy('vlon - 5', 'vlat - 5')} || ',' || {xy('vlon + 5', 'vlat + 5')} || ']}}' END")


INSP_GEOJSON = _geojson(_xy4)

TYPES = ("SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, 'score ' || n_name AS "
         "description, 'measure ' || CAST(n_nationkey AS VARCHAR) AS measuring_desc, "
         "CAST(r_regionkey AS BIGINT) AS inspection_type_id, r_name AS inspection_type_name "
         "FROM nation JOIN region ON n_regionkey = r_regionkey")

TOTAL = (
    "SELECT a.createdAt AS inspection_created_at, a.creatingUserId AS creating_user_id, "
    "a.id AS inspection_round_id, a.inspectionRoundName AS inspection_round_name, "
    "CAST(a.vlon AS DOUBLE) / 10000.0 AS x, CAST(a.vlat AS DOUBLE) / 10000.0 AS y, "
    "a.location_id AS location_id, a.modifiedAt AS inspection_round_modified_at, "
    "a.photo_id AS photo_id, a.photo_uri AS photo_uri, "
    "a.roundResultCompletedAt AS inspection_round_completed_at, a.score AS score_id, "
    "b.description AS score_description, b.inspection_type_id AS inspection_type_id, "
    "b.inspection_type_name AS inspection_type_name, "
    "b.measuring_desc AS score_measuring_description, b.name AS score, "
    "CAST(a.vlon AS DOUBLE) / 10000.0 AS lat, CAST(a.vlat AS DOUBLE) / 10000.0 AS lon, "
    f"{INSP_GEOJSON.replace('k % 4', 'a.k % 4').replace('vlon', 'a.vlon').replace('vlat', 'a.vlat')} AS geojson "
    f"FROM ({INSP}) a JOIN ({TYPES}) b ON CAST(a.item_id AS VARCHAR) || CAST(a.score AS VARCHAR) "
    "= CAST(b.inspection_type_id AS VARCHAR) || CAST(b.id AS VARCHAR)"
)

G6 = ("SELECT 'G' || CAST(r_regionkey AS VARCHAR) AS code, 'Gebied ' || r_name AS naam, "
      "474000 + r_regionkey * 11000 AS y0 FROM region")
# By the arithmetic of the layers: neighbourhood and quarter are the nation's, the
# district is the region whose key is the nation's modulo 7 (none for 5 and 6).
HIER6 = (
    "SELECT r_name AS stadsdeelnaam, CAST(r_regionkey AS VARCHAR) AS stadsdeelcode, "
    "'W' || n_name AS wijknaam, CAST(n_nationkey % 7 AS VARCHAR) || "
    "lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS wijkcode, n_name AS buurtnaam, "
    "CAST(r_regionkey AS VARCHAR) || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || 'a' AS buurtcode, "
    "108000 + (n_nationkey % 5) * 7000 AS x0, 469000 + (n_nationkey // 5) * 11000 AS y0 "
    "FROM nation LEFT JOIN region ON r_regionkey = n_nationkey % 7"
)

TOTAL_COLS = ("inspection_created_at, creating_user_id, inspection_round_id, "
              "inspection_round_name, x, y, location_id, inspection_round_modified_at, "
              "photo_id, photo_uri, inspection_round_completed_at")
TOTAL_COLS2 = ("score_description, inspection_type_id, inspection_type_name, "
               "score_measuring_description, score")

FLAGSHIP = (
    f"WITH t AS ({rd_sql('(' + TOTAL + ')', 'lat', 'lon')}) "
    f"SELECT {TOTAL_COLS}, t.score AS score_id, {TOTAL_COLS2}, round(t.lat, 9) AS lat, "
    "round(t.lon, 9) AS lon, t.geojson, d.stadsdeelcode, d.stadsdeelnaam, "
    "g.naam AS gebiedsnaam, g.code AS gebiedscode, d.wijkcode, d.wijknaam, d.buurtnaam, "
    f"d.buurtcode FROM t JOIN ({HIER6}) d ON t.rd_x > d.x0 AND t.rd_x < d.x0 + 7000 "
    "AND t.rd_y > d.y0 AND t.rd_y < d.y0 + 11000 "
    f"JOIN ({G6}) g ON t.rd_x > 108000 AND t.rd_x < 143000 AND t.rd_y > g.y0 "
    "AND t.rd_y < g.y0 + 11000"
)

# rounds documents ---------------------------------------------------------
ROUND_ROWS = (
    "SELECT c_custkey, c_name, c_mktsegment, o_orderkey, o_orderdate, o_orderstatus, "
    "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate, "
    "CAST(47000 + ((o_orderkey * 37) % 1000) * 5 AS DOUBLE) / 10000.0 AS gx, "
    "CAST(522000 + ((o_orderkey * 91) % 1000) * 5 AS DOUBLE) / 10000.0 AS gy "
    "FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey"
)
ROUND_GEOJSON = ("'{\"type\":\"Point\",\"coordinates\":[' || CAST(gx AS VARCHAR) || ',' || "
                 "CAST(gy AS VARCHAR) || ']}'")
ROUND_MODIFIED = "'2024-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0')"
ROUND_COMPLETED = ("CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE '2024-02-' || "
                   "lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') END")
LINE_ORDER = ("c_custkey, o_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, "
              "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")


def _photo(i: int, field: str) -> str:
    cond = f"l_linenumber % 3 > {i}"
    if field == "id":
        return f"CASE WHEN {cond} THEN l_partkey * 10 + {i} END"
    return f"CASE WHEN {cond} THEN '/p/' || CAST(l_partkey AS VARCHAR) || '_{i}' END"


INSPECTION_ROUNDS = (
    f"SELECT row_number() OVER (ORDER BY {LINE_ORDER}) - 1 AS idx, "
    "c_custkey AS id, l_partkey % 25 AS score, l_suppkey % 5 AS \"inspectionItem.id\", "
    "l_suppkey AS creatingUserId, "
    f"{_photo(0, 'id')} AS \"photos.0.id\", {_photo(0, 'uri')} AS \"photos.0.uri\", "
    f"{_photo(1, 'id')} AS \"photos.1.id\", {_photo(1, 'uri')} AS \"photos.1.uri\", "
    "l_quantity AS quantity, strftime(o_orderdate, '%Y-%m-%d') AS createdAt, "
    "o_orderkey AS \"location.locationId\", gx AS \"location.geoJsonProperties.x\", "
    "gy AS \"location.geoJsonProperties.y\", 'Feature' AS \"location.geoJsonFeature.type\", "
    f"o_orderstatus AS status, {ROUND_MODIFIED} AS modifiedAt, "
    f"c_name AS inspectionRoundName, {ROUND_COMPLETED} AS roundResultCompletedAt, "
    f"c_mktsegment AS segment, {ROUND_GEOJSON} AS geojson FROM ({ROUND_ROWS})"
)

E2E_STAGING = (
    "SELECT c_custkey AS id, c_name AS inspectionRoundName, "
    "strftime(o_orderdate, '%Y-%m-%d') AS createdAt, l_suppkey AS creatingUserId, "
    f"{ROUND_MODIFIED} AS modifiedAt, {ROUND_COMPLETED} AS roundResultCompletedAt, "
    "l_partkey % 25 AS score, l_suppkey % 5 AS item_id, o_orderkey AS location_id, gx, gy, "
    f"{_photo(0, 'id')} AS photo_id, {_photo(0, 'uri')} AS photo_uri, "
    f"{ROUND_GEOJSON} AS geojson FROM ({ROUND_ROWS})"
)
E2E_TOTAL = (
    "SELECT a.createdAt AS inspection_created_at, a.creatingUserId AS creating_user_id, "
    "a.id AS inspection_round_id, a.inspectionRoundName AS inspection_round_name, "
    "a.gx AS x, a.gy AS y, a.location_id AS location_id, "
    "a.modifiedAt AS inspection_round_modified_at, a.photo_id AS photo_id, "
    "a.photo_uri AS photo_uri, a.roundResultCompletedAt AS inspection_round_completed_at, "
    "b.description AS score_description, b.inspection_type_id AS inspection_type_id, "
    "b.inspection_type_name AS inspection_type_name, "
    "b.measuring_desc AS score_measuring_description, b.name AS score, "
    "a.gx AS lat, a.gy AS lon, a.geojson "
    f"FROM ({E2E_STAGING}) a JOIN ({TYPES}) b ON CAST(a.item_id AS VARCHAR) || "
    "CAST(a.score AS VARCHAR) = CAST(b.inspection_type_id AS VARCHAR) || CAST(b.id AS VARCHAR)"
)
E2E = (
    f"WITH t AS ({rd_sql('(' + E2E_TOTAL + ')', 'lat', 'lon')}) "
    f"SELECT {TOTAL_COLS}, t.score AS score_id, {TOTAL_COLS2}, round(t.lat, 9) AS lat, "
    "round(t.lon, 9) AS lon, t.geojson, d.stadsdeelcode, d.stadsdeelnaam, "
    "g.naam AS gebiedsnaam, g.code AS gebiedscode, d.wijkcode, d.wijknaam, d.buurtnaam, "
    f"d.buurtcode FROM t JOIN ({HIER6}) d ON t.rd_x > d.x0 AND t.rd_x < d.x0 + 7000 "
    "AND t.rd_y > d.y0 AND t.rd_y < d.y0 + 11000 "
    f"JOIN ({G6}) g ON t.rd_x > 108000 AND t.rd_x < 143000 AND t.rd_y > g.y0 "
    "AND t.rd_y < g.y0 + 11000"
)

# pages / names ------------------------------------------------------------
STEP = "regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1)"
EXT = (f"CASE WHEN regexp_matches({STEP}, '.\\.[^.]*$') THEN "
       f"regexp_extract({STEP}, '\\.([^.]*)$', 1) ELSE '' END")


# Registered types of the extensions that the pages' URLs can have.
KINDS = {"html": "text/html", "htm": "text/html", "css": "text/css", "js": "text/javascript",
         "json": "application/json", "xml": "text/xml", "txt": "text/plain", "csv": "text/csv",
         "pdf": "application/pdf", "zip": "application/zip", "png": "image/png",
         "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "svg": "image/svg+xml"}


def _content_type_sql() -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in KINDS.items())
    return f"CASE lower({EXT}) {cases} ELSE NULL END"


def _corner_rows(src: str, lon0: str, lat0: str, lon1: str, lat1: str) -> str:
    return " UNION ALL ".join(
        f"SELECT layer, code, naam, {x} AS lon, {y} AS lat FROM ({src})"
        for x, y in ((lon0, lat0), (lon1, lat0), (lon1, lat1), (lon0, lat1)))


_DEG_BUURT = ("SELECT 'buurt' AS layer, CAST(c_custkey AS VARCHAR) AS code, c_name AS naam, "
              "CAST(47000 + ((c_custkey * 37) % 1000) * 5 - 25 AS DOUBLE) / 10000.0 AS lon0, "
              "CAST(522000 + ((c_custkey * 91) % 1000) * 5 - 25 AS DOUBLE) / 10000.0 AS lat0, "
              "CAST(47000 + ((c_custkey * 37) % 1000) * 5 + 25 AS DOUBLE) / 10000.0 AS lon1, "
              "CAST(522000 + ((c_custkey * 91) % 1000) * 5 + 25 AS DOUBLE) / 10000.0 AS lat1 "
              "FROM customer")
_DEG_SD = ("SELECT 'stadsdeel' AS layer, CAST(r_regionkey AS VARCHAR) AS code, r_name AS naam, "
           "4.7 AS lon0, CAST(5230 + r_regionkey * 10 AS DOUBLE) / 100.0 AS lat0, "
           "5.05 AS lon1, CAST(5240 + r_regionkey * 10 AS DOUBLE) / 100.0 AS lat1 FROM region")
_CORNERS = " UNION ALL ".join(
    _corner_rows(src, "CAST(lon0 AS DOUBLE)", "lat0", "CAST(lon1 AS DOUBLE)", "lat1")
    for src in (_DEG_BUURT, _DEG_SD))
AREA_LAYERS = (
    "SELECT layer, code, naam, 28992 AS srid, round(min(rd_x), 2) AS minx, "
    "round(min(rd_y), 2) AS miny, round(max(rd_x), 2) AS maxx, round(max(rd_y), 2) AS maxy "
    f"FROM ({rd_sql('(' + _CORNERS + ')', 'lon', 'lat')}) GROUP BY layer, code, naam")


ARCHIVES = ("SELECT 'archive_' || CAST(c_custkey // 1000 AS VARCHAR) || '.zip' AS name "
            "FROM customer GROUP BY c_custkey // 1000")

SQL: dict[str, str] = {
    "spatial_join_points":
        f"SELECT p.id, p.x, p.y, n.code, n.naam FROM ({PTS}) p JOIN ({NB}) n ON {INSIDE_NB}",
    "spatial_join_two_layers":
        f"SELECT p.id, p.x, p.y, n.code, n.naam, w.code AS gebiedscode, w.naam AS gebiedsnaam "
        f"FROM ({PTS}) p JOIN ({NB}) n ON {INSIDE_NB} JOIN ({WA}) w ON p.x > 0 AND p.x < 10 "
        "AND p.y > w.y0 AND p.y < w.y0 + 2",
    "spatial_join_centroids":
        "SELECT q.id, q.code, round(q.x, 6) AS cx, round(q.y, 6) AS cy, "
        f"s.code AS stadsdeelcode, s.naam AS stadsdeelnaam FROM ({SQ}) q JOIN ({SDZ}) s "
        "ON q.x > 0 AND q.x < 10 AND q.y > s.y0 AND q.y < s.y0 + 2",
    "st_within":
        f"SELECT p.id, n.code, ({INSIDE_NB}) AS within FROM ({PTS}) p JOIN ({NB}) n "
        "ON p.x >= n.x0 AND p.x <= n.x0 + 2 AND p.y >= n.y0 AND p.y <= n.y0 + 2",
    "geom_from_geojson":
        "SELECT id, CASE id % 4 WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS dim, "
        "CASE id % 4 WHEN 3 THEN 2 ELSE 1 END AS n_parts, "
        "CASE id % 4 WHEN 0 THEN 1 WHEN 1 THEN 5 ELSE 2 END AS n_vertices, "
        f"CASE WHEN id % 4 = 0 THEN {_h('vx')} ELSE {_h('vx - 50')} END AS minx, "
        f"CASE WHEN id % 4 IN (0, 2) THEN {_h('vy')} ELSE {_h('vy - 50')} END AS miny, "
        f"CASE WHEN id % 4 = 0 THEN {_h('vx')} ELSE {_h('vx + 50')} END AS maxx, "
        f"CASE WHEN id % 4 IN (0, 2) THEN {_h('vy')} ELSE {_h('vy + 50')} END AS maxy "
        f"FROM ({PTS})",
    "st_centroid":
        f"SELECT id, round({_h('vx')}, 6) AS cx, round({_h('vy')}, 6) AS cy FROM ({PTS})",
    "nested_collections":
        "SELECT id, round((vx + CASE id % 4 WHEN 0 THEN 50.0 WHEN 3 THEN 100.0 / 3 ELSE 0.0 END) / 100.0, 6) "
        f"AS cx, round({_h('vy')}, 6) AS cy FROM ({PTS})",
    "st_within_flag":
        f"SELECT id, step, x + step / 8.0 > x0 AND x + step / 8.0 < x1 AS within "
        f"FROM ({SQ}), (SELECT unnest(range(-2, 3))::INTEGER AS step)",
    "spatial_join_detailed":
        "SELECT p.id, CAST(n_nationkey AS VARCHAR) AS code, n_name AS naam "
        f"FROM ({PTS}) p, nation WHERE (p.x - ((n_nationkey % 5) * 2 + 1)) ** 2 "
        "+ (p.y - ((n_nationkey // 5) * 2 + 1)) ** 2 < 0.9137 ** 2",
    "st_xy": f"SELECT id, x AS px, y AS py FROM ({PTS})",
    "st_set_srid":
        "SELECT id, 4326 AS srid_before, 28992 AS srid, "
        f"CASE id % 4 WHEN 0 THEN 1 WHEN 1 THEN 5 ELSE 2 END AS n_vertices FROM ({PTS})",
    "st_transform":
        "SELECT id, round(rd_x, 2) AS rd_x, round(rd_y, 2) AS rd_y FROM (" + rd_sql(
            "(SELECT p_partkey AS id, CAST(47000 + ((p_partkey * 37) % 1000) * 5 AS DOUBLE) "
            "/ 10000.0 AS lon, CAST(522000 + ((p_partkey * 91) % 1000) * 5 AS DOUBLE) "
            "/ 10000.0 AS lat FROM part)", "lon", "lat") + ")",
    "inspections_total":
        f"SELECT {TOTAL_COLS}, score_id, {TOTAL_COLS2}, geojson, round(lat, 9) AS lat, "
        f"round(lon, 9) AS lon, 4326 AS geom_srid, "
        f"CASE WHEN geojson LIKE '%\"Point\"%' OR geojson LIKE '%MultiPoint%' THEN 0 "
        f"WHEN geojson LIKE '%LineString%' THEN 1 ELSE 2 END AS geom_dim FROM ({TOTAL})",
    "inspections_total_areas": FLAGSHIP,
    "union_all":
        "SELECT p_partkey, p_size AS t, p_partkey % 25 AS s FROM part WHERE p_size <= 25 "
        "UNION ALL SELECT p_partkey, p_size AS t, p_partkey % 25 AS s FROM part "
        "WHERE NOT (p_size <= 25) OR p_size IS NULL",
    "join_concat_key":
        "SELECT p_partkey, p_size AS t, p_partkey % 25 AS s, s_suppkey, s_nationkey FROM part "
        "JOIN supplier ON CAST(p_size AS VARCHAR) || CAST(p_partkey % 25 AS VARCHAR) = "
        "CAST(s_suppkey AS VARCHAR) || CAST(s_nationkey AS VARCHAR)",
    "join_typed_pair":
        "SELECT p_partkey, p_size AS t, p_partkey % 25 AS s, s_suppkey, s_nationkey FROM part "
        "JOIN supplier ON p_size = s_suppkey AND p_partkey % 25 = s_nationkey",
    "project_rename":
        "SELECT c_mktsegment AS inspection_created_at, NULL::VARCHAR AS creating_user_id, "
        "c_custkey AS inspection_round_id, c_name AS inspection_round_name, c_acctbal AS x, "
        "NULL::VARCHAR AS y, CAST(c_nationkey AS BIGINT) AS location_id, "
        "NULL::VARCHAR AS inspection_round_modified_at, NULL::VARCHAR AS photo_id, "
        "'/p/' || CAST(c_custkey AS VARCHAR) AS photo_uri, "
        "NULL::VARCHAR AS inspection_round_completed_at, NULL::VARCHAR AS score_id "
        "FROM customer",
    "str_left_right": "SELECT c_custkey, left(c_name, 4) AS l4, right(c_name, 3) AS r3 FROM customer",
    "str_concat":
        "SELECT c_custkey, c_mktsegment || '|' || CASE WHEN c_acctbal > 0 THEN c_name END AS k "
        "FROM customer",
    "cast_text":
        "SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS key_txt, "
        "CASE WHEN o_totalprice = floor(o_totalprice) THEN CAST(CAST(o_totalprice AS BIGINT) "
        "AS VARCHAR) ELSE CAST(o_totalprice AS VARCHAR) END AS price_txt FROM orders",
    "mask_prefixed":
        "SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN 'host PG:' || c_name "
        "ELSE 'PG: <CONNECTION STRING REDACTED>' END AS a0, c_mktsegment AS a1, "
        "' x' || c_name AS a2 FROM customer",
    "dated_name": "SELECT c_custkey, c_name || '_2024-01-01.csv' AS file_name FROM customer",
    "content_type": f"SELECT page_id, {EXT} AS ext, {_content_type_sql()} AS content_type FROM pages",
    "file_stem":
        f"SELECT page_id, CASE WHEN {EXT} = '' THEN {STEP} ELSE "
        f"regexp_replace({STEP}, '\\.[^.]*$', '') END AS stem FROM pages",
    "with_row_index":
        "SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx "
        "FROM orders",
    "join_left_suffix_prefix":
        f"SELECT b.code, b.naam AS buurtnaam, w.vollcode AS wijkcode, w.naam AS wijknaam "
        f"FROM ({BUURT}) b LEFT JOIN ({WIJK}) w ON right(w.vollcode, 2) = left(b.code, 2)",
    # a customer's neighbourhood code is its key modulo 1000; the tens of it name
    # the quarter, the hundreds (prefix form) or the quarter's digit the district
    "area_hierarchy":
        "SELECT r_name AS stadsdeelnaam, CAST(r_regionkey AS VARCHAR) AS stadsdeelcode, "
        "qname AS wijknaam, CAST(digit AS VARCHAR) || lpad(CAST(q AS VARCHAR), 2, '0') AS wijkcode, "
        "c_name AS buurtnaam, CAST(r_regionkey AS VARCHAR) || "
        "lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS buurtcode "
        f"FROM customer LEFT JOIN ({QUARTERS}) ON q = c_custkey % 1000 // 10 "
        "LEFT JOIN region ON r_regionkey = digit",
    "area_hierarchy_prefix":
        "SELECT CAST(r_regionkey AS VARCHAR) AS stadsdeelcode, CAST(r_regionkey AS VARCHAR) || "
        "lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS buurtcode, "
        "CAST(digit AS VARCHAR) || lpad(CAST(q AS VARCHAR), 2, '0') AS wijkcode, "
        "r_name AS stadsdeelnaam, c_name AS buurtnaam, qname AS wijknaam "
        f"FROM customer JOIN ({QUARTERS}) ON q = c_custkey % 1000 // 10 "
        "JOIN region ON r_regionkey = c_custkey % 1000 // 100",
    "area_hierarchy_spatial":
        "SELECT DISTINCT s.code AS stadsdeelcode, s.code || q.code AS buurtcode, "
        "w.vollcode AS wijkcode, s.naam AS stadsdeelnaam, q.naam AS buurtnaam, "
        "w.naam AS wijknaam, q.x0 AS minx, q.y0 AS miny, q.x1 AS maxx, q.y1 AS maxy "
        f"FROM ({SQ}) q JOIN ({SDZ}) s ON q.x > 0 AND q.x < 10 AND q.y > s.y0 "
        f"AND q.y < s.y0 + 2 JOIN ({WIJK}) w ON w.code = left(q.code, 2)",
    "explode_types":
        "SELECT s_suppkey AS id, s_name AS name, 'score ' || s_name AS description, "
        "'measure ' || CAST(s_suppkey % 10 AS VARCHAR) AS measuring_desc, "
        "CAST(s_nationkey AS BIGINT) AS inspection_type_id, n_name AS inspection_type_name "
        "FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "inspection_types":
        "SELECT row_number() OVER (ORDER BY s_nationkey, s_suppkey) - 1 AS idx, "
        "s_suppkey AS id, s_name AS name, 'score ' || s_name AS description, "
        "'measure ' || CAST(s_suppkey % 10 AS VARCHAR) AS measuring_desc, "
        "CAST(s_nationkey AS BIGINT) AS inspection_type_id, n_name AS inspection_type_name "
        "FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "explode_rounds":
        "SELECT c_custkey AS round_id, o_orderkey AS order_id, l_partkey % 25 AS score, "
        f"l_quantity AS quantity, l_suppkey AS creating_user_id, {ROUND_GEOJSON} AS geojson "
        f"FROM ({ROUND_ROWS})",
    "merge_parent_wins":
        "SELECT c_custkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS createdAt, "
        f"{ROUND_MODIFIED} AS modifiedAt, l_suppkey AS creatingUserId, o_orderstatus AS status, "
        f"c_mktsegment AS segment, c_name AS inspectionRoundName FROM ({ROUND_ROWS})",
    "inspection_rounds": INSPECTION_ROUNDS,
    "drop_fields": "SELECT event_id, event_type, value FROM events",
    "drop_key":
        "SELECT event_id, 2 AS n_keys, false AS has_dates, event_type, props FROM events",
    "extract_geojson":
        "SELECT id, CASE WHEN id % 10 = 0 THEN 'null' ELSE "
        "'{\"type\":\"Point\",\"coordinates\":[' || CAST(x AS VARCHAR) || ',' || "
        f"CAST(y AS VARCHAR) || ']}}' END AS geojson FROM ({PTS})",
    "flatten_open": """
        WITH l AS (SELECT l_orderkey AS id, l_linenumber AS n, l_partkey AS part,
                          row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
                            l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
                            l_linestatus, l_shipdate) - 1 AS i FROM lineitem),
             o AS (SELECT o_orderkey AS id, o_orderkey % 6 AS kind, o_orderkey % 7 AS pair,
                          CAST(o_orderkey AS VARCHAR) AS k FROM orders)
        SELECT id, 'o' AS path, k AS value FROM o
        UNION ALL SELECT id, 'x', CASE kind WHEN 0 THEN k WHEN 1 THEN 's ' || k END FROM o
                  WHERE kind IN (0, 1, 4)
        UNION ALL SELECT id, 'x.y', k FROM o WHERE kind = 2
        UNION ALL SELECT id, 'x.z', NULL FROM o WHERE kind = 2
        UNION ALL SELECT id, 'x.' || CAST(v.i AS VARCHAR), coalesce(v.value, CASE v.i WHEN 0 THEN k END)
                  FROM o, (VALUES (0, NULL), (1, '{t}'), (2, 'true'), (3, NULL)) v(i, value) WHERE kind = 3
        UNION ALL SELECT id, 'a.b', CASE pair WHEN 0 THEN '0' ELSE k END FROM o WHERE pair IN (0, 1)
        UNION ALL SELECT id, 'lines.' || CAST(i AS VARCHAR) || '.id', CAST(n AS VARCHAR) FROM l
        UNION ALL SELECT id, 'lines.' || CAST(i AS VARCHAR) || '.part', CAST(part AS VARCHAR) FROM l
        UNION ALL SELECT id, 'lines.' || CAST(i AS VARCHAR) || '.tags.' || CAST(j AS VARCHAR),
                         't' || CAST(j AS VARCHAR)
                  FROM (SELECT *, unnest(range(0, n % 3 + 1)) AS j FROM l)""",
    "flatten_long":
        "SELECT event_id, 'event_type' AS path, event_type AS value FROM events "
        "UNION ALL SELECT event_id, 'user_id', CAST(user_id AS VARCHAR) FROM events "
        "UNION ALL SELECT event_id, 'props.k', CAST(CAST(json_extract(props, '$.k') AS BIGINT) "
        "AS VARCHAR) FROM events",
    "flatten_wide":
        "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS \"props.k\" FROM events",
    "array_first":
        "SELECT l_orderkey, l_linenumber, l_partkey, "
        "CASE WHEN l_linenumber % 3 > 0 THEN l_partkey * 10 END AS photo_id, "
        "CASE WHEN l_linenumber % 3 > 0 THEN '/p/' || CAST(l_partkey AS VARCHAR) || '_0' END "
        "AS photo_uri FROM lineitem",
    "nested_field": "SELECT event_id, value AS x, user_id AS y FROM events",
    "records_to_table":
        "SELECT event_id, event_type, user_id, CASE WHEN event_type = 'error' THEN NULL "
        "ELSE value END AS value FROM events",
    "scan_listing":
        "SELECT '/e/' || CAST(event_id AS VARCHAR) AS uri FROM events",
    "scan_detail_by_uri":
        "SELECT '/c/' || CAST(c_custkey AS VARCHAR) AS uri, c_custkey, c_name, c_mktsegment "
        "FROM customer WHERE c_custkey IN (SELECT DISTINCT user_id FROM events)",
    "scan_table": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "sink_replace_table":
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "sink_replace_version":
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "sink_ctas": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "export_csv_semicolon": "SELECT doc_id, text, lang, source FROM documents",
    "export_csv_comma": "SELECT doc_id, text, lang, source FROM documents",
    "export_geojson": (
        "SELECT CAST(id AS VARCHAR) AS code, naam, '{\"type\":\"Polygon\",\"coordinates\":[[' || "
        + " || ',' || ".join(
            "'[' || CAST({} AS VARCHAR) || ',' || CAST({} AS VARCHAR) || ']'".format(a, b)
            for a, b in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0")))
        + f" || ']]}}' AS geometry FROM ({SQ})"),
    "scan_area_layer":
        "SELECT CAST(id AS VARCHAR) AS code, naam, x0 AS minx, y0 AS miny, x1 AS maxx, "
        f"y1 AS maxy FROM ({SQ})",
    "scan_area_layer_split":
        "SELECT CAST(id AS VARCHAR) AS code, naam, x0 AS minx, y0 AS miny, x1 AS maxx, "
        f"y1 AS maxy FROM ({SQ})",
    "area_layers": AREA_LAYERS,
    "scan_objects": "SELECT c_custkey, c_name FROM customer",
    "zip_members":
        "SELECT 'customers_' || CAST(c_custkey // 100 AS VARCHAR) || '.csv' AS member, "
        "CAST(count(*) AS INTEGER) AS n_lines, false AS failed FROM customer "
        "GROUP BY c_custkey // 100 UNION ALL SELECT NULL, NULL, true",
    "list_files":
        f"SELECT name FROM ({ARCHIVES}) UNION ALL SELECT 'broken#1.zip' WHERE EXISTS "
        "(SELECT 1 FROM customer WHERE c_custkey < 1000)",
    "check_objects":
        f"SELECT name, true AS present FROM ({ARCHIVES}) "
        "UNION ALL SELECT 'archive_x#1.zip', false",
    "publish_manifest":
        f"SELECT name, 'application/zip' AS content_type, true AS present FROM ({ARCHIVES}) "
        "UNION ALL SELECT 'archive_x#1.zip', 'application/zip', false",
    "inspection_rounds_mixed":
        "SELECT id, k AS part, score, CAST(k % 7 AS VARCHAR) AS status, "
        "CASE WHEN k % 4 = 0 THEN NULL WHEN k % 2 = 0 THEN 'r' || CAST(k AS VARCHAR) "
        "ELSE 'i' || CAST(k AS VARCHAR) END AS modifiedAt, "
        "CASE WHEN k % 3 = 0 THEN 't' || CAST(k AS VARCHAR) END AS _tag, "
        "CASE WHEN k % 5 = 0 THEN 'n' || CAST(k AS VARCHAR) END AS note, "
        f"{_geojson(_xyd)} AS geojson FROM ({INSP})",
    "inspections_mixed_areas":
        "SELECT inspection_round_id, location_id, score, stadsdeelcode, wijkcode, buurtcode, "
        f"gebiedscode, lat, lon FROM ({FLAGSHIP})",
    "inspections_changed_areas": FLAGSHIP,
    "inspections_total_areas_stream": FLAGSHIP,
    "inspections_end_to_end": E2E,
}
