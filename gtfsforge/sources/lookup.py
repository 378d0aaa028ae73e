"""Fixed lookup tables used by the GTFS builders (O-P2, O-S20).

These are tiny, fixed-size tables (a few dozen rows at most, independent of
the data volume), so broadcasting them is always safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# GTFS route_type per KV1 transport type.
ROUTE_TYPE = [("TRAM", 0), ("METRO", 1), ("TRAIN", 2), ("BUS", 3), ("BOAT", 4)]

# GTFS wheelchair_accessible per KV1 value.
WHEELCHAIR = [("UNKNOWN", 0), ("ACCESSIBLE", 1), ("NOTACCESSIBLE", 2)]

# KV1 product formula type -> localized route type (18 is absent on purpose).
PRODUCT_FORMULA = [
    (1, "Buurtbus"), (2, "Belbus"), (3, "Express-bus"), (4, "Fast Ferry"), (5, "Hanze-Liner"),
    (6, "Interliner"), (7, "Kamperstadslijn"), (8, "Lijntaxi"), (9, "Media express"), (10, "MAXX"),
    (11, "Natuurexpress"), (12, "Niteliner"), (13, "Q-liner"), (14, "Regioliner"), (15, "Servicebus"),
    (16, "Sneldienst"), (17, "Spitsbus"), (19, "Sternet"), (20, "Sneltram"), (21, "Tram"),
    (22, "Vierdaagse"), (23, "Waterbus"), (24, "Zuidtangent"), (25, "Stoptrein"), (26, "Sneltrein"),
    (27, "Intercity"), (28, "Sprinter"), (29, "Internationale Trein"), (30, "HSL Zuid"), (31, "ICE"),
    (32, "Thalys"), (33, "Valleilijn"), (34, "Breng"), (35, "Opstapper"), (36, "Overstapper"),
    (37, "R-NET"), (38, "Parkshuttle"), (39, "FC-Utrecht Express"),
]

# Product formulas that are on-demand (pickup/drop-off type 3).
ON_DEMAND_FORMULAS = (2, 35, 36)

# Lines that carry bikes (owner, line planning number, trip_bikes_allowed).
BIKES_ALLOWED = [
    ("GVB", "900", 2), ("GVB", "901", 2), ("GVB", "902", 2), ("GVB", "904", 2), ("GVB", "905", 2),
    ("GVB", "906", 2), ("GVB", "907", 2), ("GVB", "26", 2), ("GVB", "50", 2), ("GVB", "51", 2),
    ("GVB", "52", 2), ("GVB", "53", 2), ("GVB", "54", 2), ("CXX", "N419", 2), ("CXX", "Z020", 2),
    ("CXX", "Z050", 2), ("CXX", "Z060", 2), ("VTN", "26", 2), ("ARR", "17090", 2), ("ARR", "17194", 2),
    ("ARR", "17196", 2), ("ARR", "15020", 2), ("ARR", "15021", 2), ("ARR", "15022", 2), ("ARR", "15023", 2),
    ("ARR", "15024", 2),
]

# Agencies (id, name, url); timezone Europe/Amsterdam, language nl.
AGENCIES = [
    ("GVB", "GVB", "http://www.gvb.nl/"),
    ("HTM", "HTM", "http://www.htm.nl/"),
    ("HTMBUZZ", "HTMbuzz", "http://www.htm.nl/"),
    ("CXX", "Connexxion", "http://www.connexxion.nl/"),
    ("BRENG", "Breng", "http://www.breng.nl/"),
    ("HERMES", "Hermes", "http://www.hermes.nl/"),
    ("GVU", "GVU", "http://www.gvu.nl/"),
    ("ARR", "Arriva", "http://www.arriva.nl/"),
    ("VTN", "Veolia", "http://www.veolia.nl/"),
    ("QBUZZ", "Qbuzz", "http://www.qbuzz.nl/"),
    ("SYNTUS", "Syntus", "http://www.syntus.nl/"),
    ("EBS", "EBS", "http://www.ebs-ov.nl/"),
    ("RET", "RET", "http://www.ret.nl/"),
]
AGENCY_TIMEZONE = "Europe/Amsterdam"
AGENCY_LANG = "nl"

FEED_LANG = "nl"


def route_type(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(ROUTE_TYPE, "transporttype string, route_type int"))


def wheelchair(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(WHEELCHAIR, "wheelchairaccessible string, wheelchair_accessible int"))


def product_formula(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(PRODUCT_FORMULA, "productformulatype int, localized_route_type string"))


def bikes_allowed(spark: SparkSession) -> DataFrame:
    return F.broadcast(
        spark.createDataFrame(BIKES_ALLOWED, "dataownercode string, lineplanningnumber string, trip_bikes_allowed int")
    )


def agencies(spark: SparkSession) -> DataFrame:
    return F.broadcast(spark.createDataFrame(AGENCIES, "agency_id string, agency_name string, agency_url string"))


def read_lookup_csv(spark: SparkSession, path: str, schema: str, header: bool = False) -> DataFrame:
    """Lookup CSV with an explicit schema (codes such as '001' stay strings) (O-S20)."""
    return spark.read.schema(schema).option("header", header).csv(path)
