"""Dutch national grid (RD New) -> WGS84 as column expressions (O-G1..O-G3).

The transform is the public definition of the RD New projection: an oblique
stereographic projection of the Gauss conformal sphere of the Bessel 1841
ellipsoid, followed by a 7-parameter (position vector) datum shift to WGS84.
The iterative inverse of the conformal latitude is replaced by its closed
series (Snyder, *Map Projections - A Working Manual*, eq. 3-5), so the plan
stays a flat chain of arithmetic that whole-stage codegen handles in one span.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The public RD New / Bessel 1841 / WGS84 definition.
LAT0_DEG = 52.15616055555555
LON0_DEG = 5.38763888888889
K0 = 0.9999079
X0 = 155000.0
Y0 = 463000.0
BESSEL_A = 6377397.155
BESSEL_RF = 299.1528128
WGS84_A = 6378137.0
WGS84_RF = 298.257223563
# dx, dy, dz (m), rx, ry, rz (arc seconds), scale (ppm)
TOWGS84 = (565.417, 50.3319, 465.552, -0.398957, 0.343988, -1.8774, 4.0725)


def _consts():
    f = 1.0 / BESSEL_RF
    es = 2 * f - f * f
    e = math.sqrt(es)
    phi0 = math.radians(LAT0_DEG)
    sphi = math.sin(phi0)
    cphi2 = math.cos(phi0) ** 2
    rc = math.sqrt(1 - es) / (1 - es * sphi * sphi)
    c = math.sqrt(1 + es * cphi2 * cphi2 / (1 - es))
    chi0 = math.asin(sphi / c)
    ratexp = 0.5 * c * e
    srat = ((1 - e * sphi) / (1 + e * sphi)) ** ratexp
    k = math.tan(0.5 * chi0 + math.pi / 4) / (math.tan(0.5 * phi0 + math.pi / 4) ** c * srat)
    series = (
        es / 2 + 5 * es**2 / 24 + es**3 / 12 + 13 * es**4 / 360,
        7 * es**2 / 48 + 29 * es**3 / 240 + 811 * es**4 / 11520,
        7 * es**3 / 120 + 81 * es**4 / 1120,
        4279 * es**4 / 161280,
    )
    fw = 1.0 / WGS84_RF
    es_w = 2 * fw - fw * fw
    b_w = WGS84_A * (1 - fw)
    ep2_w = (WGS84_A**2 - b_w**2) / b_w**2
    return dict(es=es, rc=rc, c=c, chi0=chi0, k=k, series=series, es_w=es_w, b_w=b_w, ep2_w=ep2_w)


CONST = _consts()


def rd_to_wgs84(df: DataFrame, x: str, y: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Add WGS84 ``lat``/``lon`` (double degrees) for RD New columns ``x``, ``y``."""
    k = CONST
    xx = (F.col(x).cast("double") - X0) / (BESSEL_A * K0)
    yy = (F.col(y).cast("double") - Y0) / (BESSEL_A * K0)
    tmp = "__rd"
    df = df.withColumn(f"{tmp}x", xx).withColumn(f"{tmp}y", yy)
    X, Y = F.col(f"{tmp}x"), F.col(f"{tmp}y")
    rho = F.sqrt(X * X + Y * Y)
    df = df.withColumn(f"{tmp}rho", rho)
    R = F.col(f"{tmp}rho")
    cc = F.atan2(R, F.lit(2 * k["rc"]))
    df = df.withColumn(f"{tmp}c", cc * 2)
    C = F.col(f"{tmp}c")
    sinc_rho = F.when(R == 0, F.lit(1.0 / k["rc"])).otherwise(F.sin(C) / R)
    chi = F.asin(F.cos(C) * math.sin(k["chi0"]) + Y * sinc_rho * math.cos(k["chi0"]))
    lam_s = F.atan2(X * sinc_rho, F.cos(C) * math.cos(k["chi0"]) - Y * math.sin(k["chi0"]) * sinc_rho)
    df = df.withColumn(f"{tmp}chi", chi).withColumn(f"{tmp}lams", lam_s)
    # inverse Gauss sphere: conformal latitude, then the closed series
    chic = F.atan(F.pow(F.tan(F.col(f"{tmp}chi") * 0.5 + math.pi / 4) / k["k"], 1.0 / k["c"])) * 2 - math.pi / 2
    df = df.withColumn(f"{tmp}chic", chic)
    q = F.col(f"{tmp}chic")
    s1, s2, s3, s4 = k["series"]
    phi = q + F.sin(q * 2) * s1 + F.sin(q * 4) * s2 + F.sin(q * 6) * s3 + F.sin(q * 8) * s4
    lam = F.col(f"{tmp}lams") / k["c"] + math.radians(LON0_DEG)
    df = df.withColumn(f"{tmp}phi", phi).withColumn(f"{tmp}lam", lam)
    P, L = F.col(f"{tmp}phi"), F.col(f"{tmp}lam")
    # Bessel geodetic -> geocentric (h = 0)
    n = F.lit(BESSEL_A) / F.sqrt(1 - k["es"] * F.sin(P) * F.sin(P))
    df = df.withColumn(f"{tmp}n", n)
    N = F.col(f"{tmp}n")
    gx = N * F.cos(P) * F.cos(L)
    gy = N * F.cos(P) * F.sin(L)
    gz = N * (1 - k["es"]) * F.sin(P)
    df = df.withColumn(f"{tmp}gx", gx).withColumn(f"{tmp}gy", gy).withColumn(f"{tmp}gz", gz)
    GX, GY, GZ = F.col(f"{tmp}gx"), F.col(f"{tmp}gy"), F.col(f"{tmp}gz")
    dx, dy, dz, rx, ry, rz, s = TOWGS84
    sec = math.pi / (180 * 3600)
    rx, ry, rz, m = rx * sec, ry * sec, rz * sec, 1 + s * 1e-6
    wx = (GX - GY * rz + GZ * ry) * m + dx
    wy = (GX * rz + GY - GZ * rx) * m + dy
    wz = (GX * (-ry) + GY * rx + GZ) * m + dz
    df = df.withColumn(f"{tmp}wx", wx).withColumn(f"{tmp}wy", wy).withColumn(f"{tmp}wz", wz)
    WX, WY, WZ = F.col(f"{tmp}wx"), F.col(f"{tmp}wy"), F.col(f"{tmp}wz")
    # geocentric -> WGS84 geodetic (Bowring)
    p = F.sqrt(WX * WX + WY * WY)
    theta = F.atan2(WZ * WGS84_A, p * k["b_w"])
    df = df.withColumn(f"{tmp}p", p).withColumn(f"{tmp}th", theta)
    Pp, TH = F.col(f"{tmp}p"), F.col(f"{tmp}th")
    latr = F.atan2(
        WZ + F.pow(F.sin(TH), 3) * (k["ep2_w"] * k["b_w"]),
        Pp - F.pow(F.cos(TH), 3) * (k["es_w"] * WGS84_A),
    )
    df = df.withColumn(lat, F.degrees(latr)).withColumn(lon, F.degrees(F.atan2(WY, WX)))
    return df.drop(*[c for c in df.columns if c.startswith(tmp)])


def round_coord(c, precision: int = 8, scale: int = 5) -> Column:
    """Cast to NUMERIC(p,s) as the GTFS writers do (half-up)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, scale).cast(f"decimal({precision},{scale})")


def override_points(df: DataFrame, fixed: DataFrame, key: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Points given directly in WGS84 win over computed ones (O-G2).

    ``fixed`` is a lookup of a handful of rows (key, lat, lon); it is broadcast.
    """
    f = fixed.select(F.col(key), F.col(lat).alias("__flat"), F.col(lon).alias("__flon"))
    return (
        df.join(F.broadcast(f), key, "left")
        .withColumn(lat, F.coalesce("__flat", lat))
        .withColumn(lon, F.coalesce("__flon", lon))
        .drop("__flat", "__flon")
    )


def zero_if_missing(c) -> Column:
    """Missing coordinate -> 0 (O-G3)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col, F.lit(0))


def oracle_sql_rd_to_wgs84(src: str, x: str, y: str) -> str:
    """DuckDB/ANSI SQL (CTE chain body) adding lat/lon to relation ``src``.

    Returns the body of a subquery; stage by stage, the same public formula.
    """
    k = CONST
    s1, s2, s3, s4 = k["series"]
    dx, dy, dz, rx, ry, rz, s = TOWGS84
    sec = math.pi / (180 * 3600)
    rx, ry, rz, m = rx * sec, ry * sec, rz * sec, 1 + s * 1e-6
    a = BESSEL_A * K0
    return f"""(SELECT *, degrees(atan2(wz_ + pow(sin(th_), 3) * {k['ep2_w'] * k['b_w']!r},
                           p_ - pow(cos(th_), 3) * {k['es_w'] * WGS84_A!r})) AS lat,
           degrees(atan2(wy_, wx_)) AS lon FROM (
 SELECT *, sqrt(wx_ * wx_ + wy_ * wy_) AS p_, atan2(wz_ * {WGS84_A!r}, sqrt(wx_ * wx_ + wy_ * wy_) * {k['b_w']!r}) AS th_ FROM (
  SELECT *, (gx_ - gy_ * {rz!r} + gz_ * {ry!r}) * {m!r} + {dx!r} AS wx_,
            (gx_ * {rz!r} + gy_ - gz_ * {rx!r}) * {m!r} + {dy!r} AS wy_,
            (-gx_ * {ry!r} + gy_ * {rx!r} + gz_) * {m!r} + {dz!r} AS wz_ FROM (
   SELECT *, n_ * cos(phi_) * cos(lam_) AS gx_, n_ * cos(phi_) * sin(lam_) AS gy_,
             n_ * (1 - {k['es']!r}) * sin(phi_) AS gz_ FROM (
    SELECT *, {BESSEL_A!r} / sqrt(1 - {k['es']!r} * sin(phi_) * sin(phi_)) AS n_ FROM (
     SELECT *, chic_ + sin(2 * chic_) * {s1!r} + sin(4 * chic_) * {s2!r} + sin(6 * chic_) * {s3!r}
                     + sin(8 * chic_) * {s4!r} AS phi_,
               lams_ / {k['c']!r} + {math.radians(LON0_DEG)!r} AS lam_ FROM (
      SELECT *, 2 * atan(pow(tan(chi_ * 0.5 + {math.pi / 4!r}) / {k['k']!r}, {1.0 / k['c']!r})) - {math.pi / 2!r} AS chic_ FROM (
       SELECT *, asin(cos(c_) * {math.sin(k['chi0'])!r} + y_ * sr_ * {math.cos(k['chi0'])!r}) AS chi_,
                 atan2(x_ * sr_, cos(c_) * {math.cos(k['chi0'])!r} - y_ * {math.sin(k['chi0'])!r} * sr_) AS lams_ FROM (
        SELECT *, CASE WHEN rho_ = 0 THEN {1.0 / k['rc']!r} ELSE sin(c_) / rho_ END AS sr_ FROM (
         SELECT *, 2 * atan2(rho_, {2 * k['rc']!r}) AS c_ FROM (
          SELECT *, sqrt(x_ * x_ + y_ * y_) AS rho_ FROM (
           SELECT *, (CAST({x} AS DOUBLE) - {X0!r}) / {a!r} AS x_, (CAST({y} AS DOUBLE) - {Y0!r}) / {a!r} AS y_
           FROM {src}) s0) s1) s2) s3) s4) s5) s6) s7) s8) s9) s10)"""
