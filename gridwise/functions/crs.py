"""Coordinate transformation EPSG:4326 (WGS 84 lon/lat) -> EPSG:28992
(Amersfoort / RD New) as closed-form arithmetic in SQL text (see ``geometry``).

Chain: geodetic WGS 84 -> geocentric -> inverse 7-parameter Helmert
(position-vector convention) -> geodetic Bessel 1841 (Bowring's formula plus
one fixed-point refinement) -> oblique stereographic projection (EPSG method
9809, EPSG Guidance Note 7-2).  All parameters are published EPSG values.

Only this pair is supported; any other pair raises.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridwise.functions.geometry import GEOM_SQL, bound, let

# ---------------------------------------------------------------------------
# Fixed values (public EPSG parameters; results must match PostGIS/PROJ).
#   WGS 84 ellipsoid:           a = 6378137.0, 1/f = 298.257223563
#   Bessel 1841 ellipsoid:      a = 6377397.155, 1/f = 299.1528128
#   Amersfoort -> WGS 84 shift: tx = 565.2369 m, ty = 50.0087 m, tz = 465.658 m,
#                               rx = -0.406857330322398", ry = 0.350732676542563",
#                               rz = -1.8703473836068", scale = 4.0812 ppm
#                               (position-vector convention)
#   RD New projection origin:   latitude 52 deg 09' 22.178" N,
#                               longitude 5 deg 23' 15.500" E,
#                               k0 = 0.9999079, false easting 155000 m,
#                               false northing 463000 m
# ---------------------------------------------------------------------------
WGS84_A = 6378137.0
WGS84_INV_F = 298.257223563
BESSEL_A = 6377397.155
BESSEL_INV_F = 299.1528128
HELMERT_T = (565.2369, 50.0087, 465.658)
HELMERT_R_ARCSEC = (-0.406857330322398, 0.350732676542563, -1.8703473836068)
HELMERT_S_PPM = 4.0812
ORIGIN_LAT_DMS = (52, 9, 22.178)
ORIGIN_LON_DMS = (5, 23, 15.500)
K0 = 0.9999079
FALSE_EASTING = 155000.0
FALSE_NORTHING = 463000.0


def _dms(d, m, s):
    return d + m / 60.0 + s / 3600.0


def _e2(inv_f):
    f = 1.0 / inv_f
    return f * (2.0 - f)


class RdParams:
    """Derived constants of the chain (plain floats, computed once)."""

    e2_w = _e2(WGS84_INV_F)
    e2_b = _e2(BESSEL_INV_F)
    e_b = math.sqrt(e2_b)
    b_b = BESSEL_A * (1.0 - 1.0 / BESSEL_INV_F)
    ep2_b = (BESSEL_A ** 2 - b_b ** 2) / b_b ** 2
    tx, ty, tz = HELMERT_T
    rx, ry, rz = (v * math.pi / (180.0 * 3600.0) for v in HELMERT_R_ARCSEC)
    scale = 1.0 + HELMERT_S_PPM * 1e-6
    phi0 = math.radians(_dms(*ORIGIN_LAT_DMS))
    lam0 = math.radians(_dms(*ORIGIN_LON_DMS))
    _s0 = math.sin(phi0)
    _rho0 = BESSEL_A * (1 - e2_b) / (1 - e2_b * _s0 ** 2) ** 1.5
    _nu0 = BESSEL_A / math.sqrt(1 - e2_b * _s0 ** 2)
    R = math.sqrt(_rho0 * _nu0)
    n = math.sqrt(1 + e2_b * math.cos(phi0) ** 4 / (1 - e2_b))
    _S1 = (1 + _s0) / (1 - _s0)
    _S2 = (1 - e_b * _s0) / (1 + e_b * _s0)
    _w1 = (_S1 * _S2 ** e_b) ** n
    _sin_chi00 = (_w1 - 1) / (_w1 + 1)
    c = (n + _s0) * (1 - _sin_chi00) / ((n - _s0) * (1 + _sin_chi00))
    _w2 = c * _w1
    chi0 = math.asin((_w2 - 1) / (_w2 + 1))
    sin_chi0 = math.sin(chi0)
    cos_chi0 = math.cos(chi0)
    two_r_k0 = 2.0 * R * K0


P = RdParams


def _col(v) -> Column:
    return F.col(v) if isinstance(v, str) else v


def _d(value: float) -> str:
    """A double literal."""
    return f"({value!r}D)"


def _chain(first: str, *stages: tuple[str, str]) -> str:
    """``let`` applied stage after stage: (name, body) binds the stage before to
    ``name`` in ``body``."""
    if not stages:
        return first
    name, body = stages[0]
    if len(stages) == 1:
        return let(first, name, body)
    return let(first, name, _chain(body, *stages[1:]))


def _rd_sql(lon: str, lat: str) -> str:
    """struct<x, y> of longitude and latitude.  Stage borders only where a value is
    used again and again; cheap values are written out twice (fewer bindings a row)."""
    a, b = _d(BESSEL_A), _d(P.b_b)
    # geocentric (h = 0), then inverse Helmert: X_a = R^T (X_w - T) / scale
    nu = f"{_d(WGS84_A)} / sqrt(1.0D - {_d(P.e2_w)} * w.sphi * w.sphi)"
    start = (f"named_struct('lam', radians({lon}), 'sphi', sin(radians({lat})), "
             f"'cphi', cos(radians({lat})))")
    shifted = f"""named_struct(
        'ux', ({nu} * w.cphi * cos(w.lam) - {_d(P.tx)}) / {_d(P.scale)},
        'uy', ({nu} * w.cphi * sin(w.lam) - {_d(P.ty)}) / {_d(P.scale)},
        'uz', ({nu} * {_d(1.0 - P.e2_w)} * w.sphi - {_d(P.tz)}) / {_d(P.scale)})"""
    turned = f"""named_struct(
        'ax', u.ux + {_d(P.rz)} * u.uy - {_d(P.ry)} * u.uz,
        'ay', {_d(-P.rz)} * u.ux + u.uy + {_d(P.rx)} * u.uz,
        'az', {_d(P.ry)} * u.ux - {_d(P.rx)} * u.uy + u.uz)"""
    bowring = f"""named_struct('ax', g.ax, 'ay', g.ay, 'az', g.az,
        'p', sqrt(g.ax * g.ax + g.ay * g.ay),
        'th', atan2(g.az * {a}, sqrt(g.ax * g.ax + g.ay * g.ay) * {b}))"""
    first = f"""sin(atan2(d.az + {_d(P.ep2_b * P.b_b)} * pow(sin(d.th), 3),
        d.p - {_d(P.e2_b * BESSEL_A)} * pow(cos(d.th), 3)))"""
    phi = let(first, "s0", f"""sin(atan2(d.az + {_d(P.e2_b)} *
        ({a} / sqrt(1.0D - {_d(P.e2_b)} * s0 * s0)) * s0, d.p))""")
    refined = f"""named_struct('sp', {phi},
        'dl', {_d(P.n)} * (atan2(d.ay, d.ax) - {_d(P.lam0)}))"""
    sa = "((1.0D + f.sp) / (1.0D - f.sp))"
    sb = f"((1.0D - {_d(P.e_b)} * f.sp) / (1.0D + {_d(P.e_b)} * f.sp))"
    sine = let(f"{_d(P.c)} * pow({sa} * pow({sb}, {_d(P.e_b)}), {_d(P.n)})", "q",
               "asin((q - 1.0D) / (q + 1.0D))")
    conformal = let(sine, "chi", """named_struct('sc', sin(chi), 'cc', cos(chi),
        'sdl', sin(f.dl), 'cdl', cos(f.dl))""")
    den = f"(1.0D + h.sc * {_d(P.sin_chi0)} + h.cc * {_d(P.cos_chi0)} * h.cdl)"
    projected = f"""named_struct(
        'x', {_d(FALSE_EASTING)} + {_d(P.two_r_k0)} * h.cc * h.sdl / {den},
        'y', {_d(FALSE_NORTHING)} + {_d(P.two_r_k0)} * (h.sc * {_d(P.cos_chi0)}
             - h.cc * {_d(P.sin_chi0)} * h.cdl) / {den})"""
    return _chain(start, ("w", shifted), ("u", turned), ("g", bowring), ("d", refined),
                  ("f", conformal), ("h", projected))


_TO_RD = _rd_sql("v.lon", "v.lat")
_GEOM_TO_RD = ("transform(v.g.parts, part -> transform(part, ring -> transform(ring, p -> "
               + _rd_sql("p.x", "p.y") + ")))")


def wgs84_to_rd(lon, lat) -> Column:
    """struct<x, y> in EPSG:28992 for WGS 84 longitude/latitude in degrees."""
    return bound(_TO_RD, lon=_col(lon).cast("double"), lat=_col(lat).cast("double"))


def st_transform(geom, to_srid: int = 28992) -> Column:
    """``ST_Transform(g, 28992)`` for geometries labelled 4326: every vertex
    is reprojected; the label becomes 28992.  Other pairs raise."""
    if to_srid != 28992:
        raise NotImplementedError("only EPSG:4326 -> EPSG:28992 is supported")
    return bound(f"""case when v.g is null or v.g.srid = 28992 then v.g
        when v.g.srid != 4326 then cast(raise_error(concat(
          'unsupported transform from SRID ', cast(v.g.srid as string))) as {GEOM_SQL})
        else named_struct('srid', {to_srid}, 'dim', v.g.dim, 'parts', {_GEOM_TO_RD}) end""",
                 g=_col(geom))
