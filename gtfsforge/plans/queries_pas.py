"""Registered queries: PAS metro/tram GTFS builders."""

from __future__ import annotations

from gtfsforge.functions import geo
from gtfsforge.plans import gtfs_pas as pas
from gtfsforge.plans.registry import AS_OF, PUBLISHER, register
from gtfsforge.plans.views import World, oracle

SQL_CLEAN = """
, st AS (SELECT halteid, naam,
           CASE WHEN halteid = 'HA3914' AND x = 99999 THEN 65869 ELSE x END AS x,
           CASE WHEN halteid = 'HA3914' AND x = 99999 THEN 442059 ELSE y END AS y
         FROM pas_stops
         WHERE NOT (naam LIKE '%Remise%' OR naam LIKE '%Garage%' OR naam LIKE '%Opstelspoor%') OR naam IS NULL)
"""


@register("gtfs_stops_pas_b5", oracle(["pas_stops"], SQL_CLEAN + f"""
SELECT halteid AS stop_id, naam AS stop_name, CAST(lat AS DECIMAL(9,6)) AS stop_lat, CAST(lon AS DECIMAL(8,5)) AS stop_lon
FROM {geo.oracle_sql_rd_to_wgs84('st', 'x', 'y')} g"""))
def q_stops_pas(spark, sf):
    return pas.stops_pas(World(spark, sf).pas_stops)


@register("gtfs_routes_pas_b8", oracle(["pas_pujo", "pas_linepublicnumber"], """
, j AS (SELECT p.*, l.linepublicnumber, g.route_type FROM pas_pujo p
        JOIN (VALUES ('T', 0), ('M', 1), ('B', 3), ('H', 3), ('F', 4)) g(modaliteit, route_type) USING (modaliteit)
        LEFT JOIN pas_linepublicnumber l USING (lijnsysteemnr))
SELECT lijnsysteemnr AS route_id, vervoerdercode AS agency_id, coalesce(linepublicnumber, lijnsysteemnr) AS route_short_name,
       CAST(NULL AS VARCHAR) AS route_long_name, route_type
FROM (SELECT *, row_number() OVER (PARTITION BY lijnsysteemnr ORDER BY vervoerdercode, modaliteit) AS rn FROM j) x
WHERE rn = 1"""))
def q_routes_pas(spark, sf):
    w = World(spark, sf)
    return pas.routes_pas(w.pas_pujo, w.pas_linepublicnumber)


@register("gtfs_trips_pas_b12", oracle(["pas_pujo", "pas_pujopass", "pas_stops"], SQL_CLEAN + """
, e AS (SELECT x.vervoerdercode, x.lijnsysteemnr, x.richting, x.ritnummer, x.halteid FROM pas_pujopass x
        JOIN (SELECT vervoerdercode, lijnsysteemnr, richting, ritnummer, max(stopsequentie) AS stopsequentie
              FROM pas_pujopass GROUP BY vervoerdercode, lijnsysteemnr, richting, ritnummer) y
          USING (vervoerdercode, lijnsysteemnr, richting, ritnummer, stopsequentie))
SELECT p.lijnsysteemnr AS route_id, p.voetnoot AS service_id, p.voetnoot || '|' || p.ritnummer AS trip_id,
       st.naam AS trip_headsign, p.richting - 1 AS direction_id, p.ritnummer AS tripcode
FROM pas_pujo p JOIN e USING (vervoerdercode, lijnsysteemnr, richting, ritnummer) JOIN st ON st.halteid = e.halteid"""))
def q_trips_pas(spark, sf):
    w = World(spark, sf)
    return pas.trips_pas(w.pas_pujo, w.pas_pujopass, w.pas_stops)


@register("gtfs_stop_times_pas_b16", oracle(["pas_pujopass"], """
SELECT voetnoot || '|' || ritnummer AS trip_id, coalesce(aankomsttijd, vertrektijd) AS arrival_time,
       coalesce(vertrektijd, aankomsttijd) AS departure_time, halteid AS stop_id, CAST(stopsequentie AS INTEGER) AS stop_sequence
FROM pas_pujopass"""))
def q_stop_times_pas(spark, sf):
    return pas.stop_times_pas(World(spark, sf).pas_pujopass)


@register("gtfs_feed_info_pas_b2", oracle(["pas_voetnoot"], f"""
SELECT '{PUBLISHER[0]}' AS feed_publisher_name, '{PUBLISHER[1]}' AS feed_publisher_url, 'nl' AS feed_lang,
       strftime(min(datum), '%Y%m%d') AS feed_start_date, strftime(max(datum), '%Y%m%d') AS feed_end_date,
       '{AS_OF}' AS feed_version FROM pas_voetnoot"""))
def q_feed_info_pas(spark, sf):
    return pas.feed_info_pas(World(spark, sf).pas_voetnoot, AS_OF, PUBLISHER)


@register("cal_pas_dates_c2", oracle(["pas_voetnoot"], """
SELECT voetnoot AS service_id, strftime(datum, '%Y%m%d') AS date, CAST(1 AS INTEGER) AS exception_type FROM pas_voetnoot"""))
def q_cal_pas(spark, sf):
    return pas.calendar_pas(World(spark, sf).pas_voetnoot)
