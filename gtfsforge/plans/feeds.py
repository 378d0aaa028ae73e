"""Whole GTFS exports: the builders of one input family written as one feed.

Each function writes every GTFS file of a feed as ``out_dir/<name>.txt``, a
header and the rows, NULL as an empty field (``sinks.write_gtfs``).  Tables with
a key are in its order, and rows that repeat one go to ``rejected/``; each
table is derived once.  Long derivations are cut with a reliable checkpoint in
the cluster's checkpoint folder before they fan out into several files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from gtfsforge import sinks
from gtfsforge.operators import calendar as cal
from gtfsforge.operators import timegroups as tg
from gtfsforge.plans import gtfs_iff as iff
from gtfsforge.plans import gtfs_kv1 as kv1
from gtfsforge.plans import gtfs_pas as pas
from gtfsforge.session import cut_lineage


#: Keys that a feed's files must not repeat, and the order of the others.
KEYS = {"agency": ["agency_id"], "stops": ["stop_id"], "routes": ["route_id"], "trips": ["trip_id"], "stop_times": ["trip_id", "stop_sequence"]}
ORDER = {"calendar_dates": ["service_id", "date"], "shapes": ["shape_id", "shape_pt_sequence"]}


def _write(out_dir: str, tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        sinks.write_gtfs(df, out_dir, name, sort=KEYS.get(name) or ORDER.get(name), key=KEYS.get(name))


def write_kv1_passing_feed(t: dict[str, DataFrame], out_dir: str, as_of: str, publisher: tuple[str, str]) -> None:
    """KV1 passing-time feed: agency, feed_info, stops, routes, calendar_dates, trips, stop_times, shapes."""
    routes = kv1.routes_kv1(t)
    files = {
        "agency": kv1.agency_kv1(routes),
        "feed_info": kv1.feed_info(t["operday"], as_of, publisher),
        "stops": kv1.stops_kv1(t),
        "routes": routes,
        "calendar_dates": kv1.calendar_operday(t["operday"]),
        "trips": kv1.trips_passing(t),
        "stop_times": kv1.stop_times_passing(t),
    }
    if "pool" in t and "point_all" in t:
        files["shapes"] = kv1.shapes(t)
    else:
        files["shapes"] = sinks.empty_gtfs(t["pujopass"].sparkSession, "shapes")
    _write(out_dir, files)


def write_kv1_drivetime_feed(t: dict[str, DataFrame], link: DataFrame, out_dir: str, as_of: str, publisher: tuple[str, str]) -> None:
    """KV1 drive-time feed: compress passings (stored as tables in the source), spread and
    accumulate drive times, then trips, stop_times and the expanded calendar; agency, stops,
    routes by the drive-time rule, and shapes.

    ``t['pujo']`` holds the drive-time journeys with their time-demand group.
    """
    rnt = cut_lineage(tg.spread_zero_times(t["timdemrnt"], link))
    t = dict(t, timdempass=tg.cumulate(rnt))
    regular = cal.calendar_regular(t["pegrval"], t["tive"], t["pujo"], t["version"], t["excopday"], as_of)
    exception = cal.calendar_exception(t["pegrval"], t["tive"], t["pujo"], t["version"], t["excopday"], as_of)
    _write(out_dir, {
        "feed_info": kv1.feed_info(t["version"], as_of, publisher, date_col="validfrom", end_col="validthru"),
        "agency": kv1.agency_kv1(kv1.routes_drivetime(t)),
        "stops": kv1.stops_kv1(t),
        "routes": kv1.routes_drivetime(t),
        "shapes": kv1.shapes(t) if "pool" in t and "point_all" in t else sinks.empty_gtfs(t["pujo"].sparkSession, "shapes"),
        "calendar_dates": cal.calendar_union(regular, exception),
        "trips": kv1.trips_drivetime(t),
        "stop_times": kv1.stop_times_drivetime(t),
    })


def write_iff_feed(t: dict[str, DataFrame], out_dir: str, as_of: str, publisher: tuple[str, str]) -> None:
    """IFF rail feed: agency, feed_info, stops, routes, calendar_dates, trips, stop_times, transfers, empty shapes."""
    spark = t["service"].sparkSession
    _write(out_dir, {
        "agency": iff.agency_iff(t),
        "feed_info": iff.feed_info_iff(t["delivery"], as_of, publisher),
        "stops": iff.stops_iff(t),
        "routes": iff.routes_iff(t),
        "calendar_dates": cal.calendar_footnote(t["footnote"], "NS:"),
        "trips": iff.trips_iff(t),
        "stop_times": iff.stop_times_iff(t),
        "transfers": iff.transfers_iff(t),
        "shapes": sinks.empty_gtfs(spark, "shapes"),
    })


def write_pas_feed(t: dict[str, DataFrame], out_dir: str, as_of: str, publisher: tuple[str, str]) -> None:
    """PAS metro/tram feed."""
    spark = t["pujo"].sparkSession
    _write(out_dir, {
        "agency": pas.agency_pas(spark),
        "feed_info": pas.feed_info_pas(t["voetnoot"], as_of, publisher),
        "stops": pas.stops_pas(t["stops"]),
        "routes": pas.routes_pas(t["pujo"], t["linepublicnumber"]),
        "calendar_dates": pas.calendar_pas(t["voetnoot"]),
        "trips": pas.trips_pas(t["pujo"], t["pujopass"], t["stops"]),
        "stop_times": pas.stop_times_pas(t["pujopass"]),
    })
