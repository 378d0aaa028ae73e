"""GTFS builders for PAS metro/tram deliveries (O-B5, O-B8, O-B12, O-B16, O-P5, O-P9, O-P10, O-A3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gtfsforge.functions.geo import rd_to_wgs84
from gtfsforge.functions.timeofday import yyyymmdd
from gtfsforge.operators.corrections import Rule, correct
from gtfsforge.operators.first import first_per, key

# GTFS route_type per PAS modality.
PAS_ROUTE_TYPE = [("T", 0), ("M", 1), ("B", 3), ("H", 3), ("F", 4)]
# Depots and sidings are no passenger stops; a stop delivered with a placeholder position gets its own.
STOP_RULES = (
    Rule("stops", "depots and sidings", "naam like '%Remise%' or naam like '%Garage%' or naam like '%Opstelspoor%'"),
    Rule("stops", "position of HA3914", "halteid = 'HA3914' and x = 99999", (("x", "65869"), ("y", "442059"))),
)
# The PAS agency.
PAS_AGENCY = ("000024", "RET", "http://www.ret.nl", "Europe/Amsterdam", "nl")

TRIP = ["vervoerdercode", "lijnsysteemnr", "richting", "ritnummer"]


def clean_stops(stops: DataFrame) -> DataFrame:
    """Drop depots/sidings (O-P10, O-P5) and apply position fixes (O-P9)."""
    return correct(stops, STOP_RULES)


def stops_pas(stops: DataFrame) -> DataFrame:
    """stops (O-B5)."""
    g = rd_to_wgs84(clean_stops(stops), "x", "y")
    return g.select(F.col("halteid").alias("stop_id"), F.col("naam").alias("stop_name"),
                    F.col("lat").cast("decimal(9,6)").alias("stop_lat"), F.col("lon").cast("decimal(8,5)").alias("stop_lon"))


def routes_pas(pujo: DataFrame, linepublicnumber: DataFrame) -> DataFrame:
    """routes per line system number (O-B8); the source's DISTINCT ON has no order, ties go to
    the smallest operator code and modality."""
    spark = pujo.sparkSession
    rt = F.broadcast(spark.createDataFrame(PAS_ROUTE_TYPE, "modaliteit string, route_type int"))
    j = pujo.join(rt, "modaliteit").join(linepublicnumber, "lijnsysteemnr", "left")
    best = first_per(j, ["lijnsysteemnr"], ["vervoerdercode", "modaliteit"])
    return best.select(F.col("lijnsysteemnr").alias("route_id"), F.col("vervoerdercode").alias("agency_id"),
                       F.coalesce("linepublicnumber", "lijnsysteemnr").alias("route_short_name"),
                       F.lit(None).cast("string").alias("route_long_name"), "route_type")


def trips_pas(pujo: DataFrame, pujopass: DataFrame, stops: DataFrame) -> DataFrame:
    """trips with the last stop's name as headsign (O-B12, O-A3).

    The last stop is found per trip *without* the footnote, as the source does,
    so a trip that runs under two footnotes gets both last stops (ledger 20).
    """
    last = pujopass.groupBy(*TRIP).agg(F.max("stopsequentie").alias("stopsequentie"))
    e = pujopass.join(last, TRIP + ["stopsequentie"]).select(*TRIP, "halteid")
    names = clean_stops(stops).select("halteid", "naam")
    return pujo.join(e, TRIP).join(names, "halteid").select(
        F.col("lijnsysteemnr").alias("route_id"), F.col("voetnoot").alias("service_id"),
        key("voetnoot", "ritnummer").alias("trip_id"), F.col("naam").alias("trip_headsign"),
        (F.col("richting") - 1).alias("direction_id"), F.col("ritnummer").alias("tripcode"))


def stop_times_pas(pujopass: DataFrame) -> DataFrame:
    """stop_times (O-B16)."""
    return pujopass.select(key("voetnoot", "ritnummer").alias("trip_id"),
                           F.coalesce("aankomsttijd", "vertrektijd").alias("arrival_time"),
                           F.coalesce("vertrektijd", "aankomsttijd").alias("departure_time"),
                           F.col("halteid").alias("stop_id"), F.col("stopsequentie").cast("int").alias("stop_sequence"))


def agency_pas(spark) -> DataFrame:
    return spark.createDataFrame([PAS_AGENCY], "agency_id string, agency_name string, agency_url string, "
                                               "agency_timezone string, agency_lang string")


def feed_info_pas(voetnoot: DataFrame, as_of: str, publisher: tuple[str, str]) -> DataFrame:
    from gtfsforge.plans.gtfs_kv1 import feed_info

    return feed_info(voetnoot, as_of, publisher, date_col="datum")


def calendar_pas(voetnoot: DataFrame) -> DataFrame:
    return voetnoot.select(F.col("voetnoot").alias("service_id"), yyyymmdd("datum").alias("date"),
                           F.lit(1).alias("exception_type"))
