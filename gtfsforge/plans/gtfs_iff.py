"""GTFS builders for IFF rail deliveries (O-B1, O-B2, O-B4, O-B7, O-B11, O-B15, O-B18, O-P9, O-P11).

Inputs are the typed IFF tables (``service``, ``validity``, ``transport``,
``attribute``, ``stop``, ``platform``, ``station``, ``changes``, ``footnote``,
``delivery``, ``company``, ``trnsmode``).  The source applies a few UPDATEs
between its exports; here they are pure functions applied in the same order:
``correct_services`` -> (routes) -> ``number_services`` -> (trips,
stop_times, transfers), and ``wildcard_single_mode`` on the transport table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gtfsforge.functions.geo import rd_to_wgs84
from gtfsforge.functions.timeofday import yyyymmdd
from gtfsforge.operators.corrections import Rule, correct, of_table
from gtfsforge.operators.first import first_per, key, union_distinct

# Road / local modes (bus, tram, metro and replacement services); one list for routes and trips.
ROAD_MODES = ("NSS", "NSB", "B", "NSM", "NST", "BNS", "X", "U", "Y")
# Modes whose trips carry bikes without a GEFI attribute.
BIKE_MODES = ("HSN", "HSI", "NSS", "NSB", "B", "NST")
# International companies split off company 960 by transport mode.
COMPANY_BY_MODE = [("TGV", 980), ("THA", 300), ("ES", 999)]
# Stations given directly in WGS84 (shortname, lon, lat).
FIXED_STATIONS = [("aixtgv", 5.317222, 43.455), ("mannhe", 8.469858, 49.479633), ("magdeb", 11.627778, 52.130556)]
# A description in lower case by mistake; service numbers that are missing, before and after the routes.
RULES = (
    Rule("trnsmode", "name of the stoptrein", "description = 'stoptrein'", (("description", "'Stoptrein'"),)),
    Rule("service", "number from the variant", "servicenumber is null", (("servicenumber", "try_cast(variant as int)"),)),
    Rule("numbered", "no number at all", "servicenumber is null and variant is null", (("servicenumber", "0"),)),
)
# Company -> agency url.
COMPANY_URL = [
    (22, "http://www.gvb.nl"), (911, "http://www.keolis.de"), (500, "http://www.arriva.nl"), (23, "http://www.htm.nl"),
    (600, "http://www.connexxion.nl"), (805, "http://www.connexxion.nl"), (24, "http://www.ret.nl"),
    (980, "http://www.sncf.fr"), (910, "http://www.db.de"), (920, "http://www.nmbs.be"), (700, "http://www.veolia.nl"),
    (701, "http://www.veolia.nl"), (35, "http://www.ebs-ov.nl"), (400, "http://www.syntus.nl"),
    (750, "http://www.qbuzz.nl"), (100, "http://www.ns.nl"), (37, "http://www.ns.nl"), (25, "http://www.ns.nl"),
    (200, "http://www.ns-hispeed.nl"), (960, "http://www.ns-hispeed.nl"), (300, "http://www.thalys.nl"),
    (501, "http://www.breng.nl"), (52, "http://www.breng.nl"), (801, "http://www.syntus.nl"),
    (999, "http://www.eurostar.com"), (54, "http://www.valleilijn.nl"),
]
# The company that services of the ES mode are split off to; deliveries don't list it.
ADDED_COMPANY = (999, "EUROSTAR", "Eurostar")


def companies(company: DataFrame) -> DataFrame:
    """The delivered companies and the added one, unless the delivery has its number itself."""
    added = company.sparkSession.createDataFrame([ADDED_COMPANY], "company int, code string, name string")
    mine = company.select(F.col("company").cast("int").alias("company"), "code", "name")
    return mine.unionByName(added.join(mine.select("company"), "company", "left_anti"))


def modes(trnsmode: DataFrame) -> DataFrame:
    """Delivered transport modes; a description in lower case by mistake is mended."""
    return correct(trnsmode.select("code", "description"), of_table(RULES, "trnsmode"))


def correct_services(service: DataFrame, transport: DataFrame) -> DataFrame:
    """Company 960 services run by TGV/THA/ES get their real company (O-P9)."""
    out = service
    for mode, comp in COMPANY_BY_MODE:
        ids = transport.filter(F.col("transmode") == mode).select("serviceid").distinct().withColumn(f"__m{comp}", F.lit(True))
        out = out.join(ids, "serviceid", "left").withColumn(
            "companynumber",
            F.when((F.col("companynumber") == 960) & F.col(f"__m{comp}").isNotNull(), F.lit(comp)).otherwise(
                F.col("companynumber"))).drop(f"__m{comp}")
    return out


def variant_number(c="variant"):
    """The variant text as a number (the source compares it with integers without a cast)."""
    return F.expr(f"try_cast({c} AS INT)")


def routes_numbering(service: DataFrame) -> DataFrame:
    """servicenumber := variant where the number is missing (before routes)."""
    return correct(service, of_table(RULES, "service"))


def number_services(service: DataFrame) -> DataFrame:
    """After routes: servicenumber := variant, then 0 where both are missing."""
    return correct(service, [*of_table(RULES, "service"), *of_table(RULES, "numbered")])


def wildcard_single_mode(transport: DataFrame) -> DataFrame:
    """Services with one transport row get laststop 999 (matches every stop range) (O-P11)."""
    n = F.count(F.lit(1)).over(Window.partitionBy("serviceid"))
    return transport.withColumn("laststop", F.when(n == 1, F.lit(999)).otherwise(F.col("laststop")))


def trip_number(s="servicenumber", v="variant"):
    return F.coalesce(F.col(s), variant_number(v))


def station_points(station: DataFrame) -> DataFrame:
    """Station positions: RD -> WGS84, fixed WGS84 points win (O-G1, O-G2)."""
    spark = station.sparkSession
    g = rd_to_wgs84(station, "x", "y")
    g = g.withColumn("lat", F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), F.col("lat"))).withColumn(
        "lon", F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), F.col("lon")))
    fixed = F.broadcast(spark.createDataFrame(FIXED_STATIONS, "shortname string, flon double, flat double"))
    return g.join(fixed, "shortname", "left").withColumn("lat", F.coalesce("flat", "lat")).withColumn(
        "lon", F.coalesce("flon", "lon")).drop("flat", "flon")


# ------------------------------------------------------------------ O-B1 / O-B2 / O-C2
def agency_iff(t: dict[str, DataFrame]) -> DataFrame:
    """Companies that run a service, with their url (O-B1)."""
    spark = t["service"].sparkSession
    used = correct_services(t["service"], t["transport"]).select(F.col("companynumber").alias("company")).distinct()
    url = F.broadcast(spark.createDataFrame(COMPANY_URL, "company int, agency_url string"))
    return companies(t["company"]).join(used, "company", "left_semi").join(url, "company", "left").select(
        F.upper("code").alias("agency_id"), F.col("name").alias("agency_name"), "agency_url",
        F.lit("Europe/Amsterdam").alias("agency_timezone"), F.lit("nl").alias("agency_lang"))


def feed_info_iff(delivery: DataFrame, as_of: str, publisher: tuple[str, str]) -> DataFrame:
    """feed_info from the delivery line; the later of the two exports wins (version = as_of) (O-B2)."""
    return delivery.select(F.lit(publisher[0]).alias("feed_publisher_name"), F.lit(publisher[1]).alias("feed_publisher_url"),
                           F.lit("nl").alias("feed_lang"), yyyymmdd("firstday").alias("feed_start_date"),
                           yyyymmdd("lastday").alias("feed_end_date"), F.lit(as_of).alias("feed_version"))


# ------------------------------------------------------------------ O-B4
def stops_iff(t: dict[str, DataFrame], positioned: DataFrame | None = None) -> DataFrame:
    """stops: positioned stops, stations, platform stops (arrival and departure side) and the
    ``|0`` stop per station; one row per stop_id, positioned rows first (O-B4)."""
    st = station_points(t["station"])
    used = t["stop"].select(F.col("station").alias("shortname")).distinct()
    stn = st.join(used, "shortname", "left_semi").filter(F.col("trainchanges") != 2)
    lon8 = F.col("lon").cast("decimal(8,5)")
    lat9 = F.col("lat").cast("decimal(9,6)")
    stations = stn.select(
        F.col("shortname").alias("stop_id"), F.col("shortname").alias("stop_code"), F.col("name").alias("stop_name"),
        lon8.alias("stop_lon"), lat9.alias("stop_lat"),
        F.when(F.col("timezone") == 1, "Europe/London").otherwise("Europe/Amsterdam").alias("stop_timezone"),
        F.lit(1).alias("location_type"), F.lit(None).cast("string").alias("parent_station"),
        F.lit(None).cast("string").alias("platform_code"), F.lit(1).alias("__src"))
    plat = stn.join(t["platform"].select(F.col("station").alias("shortname"), "arrival", "departure"), "shortname")

    def side(c):
        return plat.select(
            F.concat("shortname", F.lit("|"), F.coalesce(c, F.lit("0"))).alias("stop_id"),
            F.col("shortname").alias("stop_code"),
            F.when(F.col(c).isNotNull(), F.concat("name", F.lit(" spoor "), c)).otherwise(F.col("name")).alias("stop_name"),
            F.coalesce(lon8, F.lit(0).cast("decimal(8,5)")).alias("stop_lon"),
            F.coalesce(lat9, F.lit(0).cast("decimal(9,6)")).alias("stop_lat"),
            F.lit(None).cast("string").alias("stop_timezone"), F.lit(0).alias("location_type"),
            F.col("shortname").alias("parent_station"), F.col("departure").alias("platform_code"),
            F.lit(2).alias("__src")).distinct()

    zero = stn.select(
        F.concat("shortname", F.lit("|0")).alias("stop_id"), F.col("shortname").alias("stop_code"),
        F.col("name").alias("stop_name"), F.coalesce(lon8, F.lit(0).cast("decimal(8,5)")).alias("stop_lon"),
        F.coalesce(lat9, F.lit(0).cast("decimal(9,6)")).alias("stop_lat"), F.lit(None).cast("string").alias("stop_timezone"),
        F.lit(0).alias("location_type"), F.col("shortname").alias("parent_station"),
        F.lit(None).cast("string").alias("platform_code"), F.lit(2).alias("__src"))
    parts = [stations, side("arrival"), side("departure"), zero]
    if positioned is not None:
        parts.insert(0, positioned.withColumn("__src", F.lit(0)))
    allstops = union_distinct(*parts)
    # DISTINCT ON (stop_id): positioned rows first, then stations, then by name and platform
    best = first_per(allstops, ["stop_id"], ["__src", "stop_name", F.col("platform_code").asc_nulls_first()])
    return best.drop("__src")


# ------------------------------------------------------------------ O-B7
def _ends(stop: DataFrame) -> DataFrame:
    """First and last stop of every service (DISTINCT ON serviceid ORDER BY idx asc / desc) (O-W5)."""
    return stop.groupBy("serviceid").agg(F.min_by("station", "idx").alias("begin_station"),
                                          F.max_by("station", "idx").alias("dest_station"))


def routes_iff(t: dict[str, DataFrame]) -> DataFrame:
    """routes: rail per (mode, company, hundred-series) named by end stations; road modes per
    undirected pair of end stations (O-B7)."""
    spark = t["service"].sparkSession
    s = routes_numbering(correct_services(t["service"], t["transport"]))
    names = t["station"].select("shortname", "name")
    ends = (_ends(t["stop"])
            .join(names.withColumnRenamed("shortname", "begin_station").withColumnRenamed("name", "begin_name"), "begin_station")
            .join(names.withColumnRenamed("shortname", "dest_station").withColumnRenamed("name", "dest_name"), "dest_station"))
    base = (t["transport"].select("serviceid", "transmode")
            .join(modes(t["trnsmode"]).withColumnRenamed("code", "transmode"), "transmode", "left")
            .join(s.select("serviceid", "companynumber", "servicenumber", "laststop", "servicename"), "serviceid")
            .join(companies(t["company"]).withColumnRenamed("company", "companynumber"), "companynumber")
            .join(ends, "serviceid"))
    hundred = (F.expr("servicenumber div 100") * 100).cast("int")
    rail = base.filter(~F.col("transmode").isin(*ROAD_MODES)).withColumn("hundred", hundred)
    rail = first_per(rail, ["transmode", "companynumber", "hundred"],
                     [(F.col("servicenumber") % 2 == 0).asc_nulls_last(), F.col("laststop").desc_nulls_first(), "serviceid"])
    mode_type = (F.when(F.col("transmode").isin("ES", "HSI", "HSN", "THA", "ICE", "TGV"), 101)
                 .when(F.col("transmode").isin("INT", "IC", "EC"), 102).when(F.col("transmode").isin("EN", "CNL"), 105)
                 .when(F.col("transmode").isin("S", "ST"), 103).when(F.col("transmode") == "SPR", 109).otherwise(2))
    ends_txt = F.concat("begin_name", F.lit(" <-> "), "dest_name")
    rail = rail.select(
        F.concat(F.col("companynumber").cast("string"), F.lit("-"), "transmode", F.lit("-"),
                 F.coalesce(F.col("hundred"), F.lit(0)).cast("string")).alias("route_id"),
        F.upper("code").alias("agency_id"), F.col("description").alias("route_short_name"),
        F.when(F.col("servicename").isNotNull(), F.concat("servicename", F.lit(" "), ends_txt))
        .otherwise(F.concat(ends_txt, F.lit(" "), "transmode", F.col("hundred").cast("string"))).alias("route_long_name"),
        mode_type.alias("route_type"))
    lo, hi = F.least("begin_station", "dest_station"), F.greatest("begin_station", "dest_station")
    road = base.filter(F.col("transmode").isin(*ROAD_MODES)).withColumn("lo", lo).withColumn("hi", hi)
    road = first_per(road, ["transmode", "companynumber", "lo", "hi"], ["begin_station", "serviceid"])
    road = road.select(
        F.concat(F.col("companynumber").cast("string"), F.lit("-"), "transmode", F.lit("-"), "lo", F.lit("-"), "hi").alias("route_id"),
        F.upper("code").alias("agency_id"), F.col("description").alias("route_short_name"),
        ends_txt.alias("route_long_name"), F.lit(3).alias("route_type"))
    return union_distinct(rail, road)


def _route_id(mode="transmode"):
    lo, hi = F.least("begin_station", "dest_station"), F.greatest("begin_station", "dest_station")
    road = F.concat(F.col("companynumber").cast("string"), F.lit("-"), F.col(mode), F.lit("-"), lo, F.lit("-"), hi)
    rail = F.concat(F.col("companynumber").cast("string"), F.lit("-"), F.col(mode), F.lit("-"),
                    F.coalesce((F.expr("servicenumber div 100") * 100).cast("int"), F.lit(0)).cast("string"))
    return F.when(F.col(mode).isin(*ROAD_MODES), road).otherwise(rail)


# ------------------------------------------------------------------ O-B11
def trips_iff(t: dict[str, DataFrame]) -> DataFrame:
    """trips: service x validity x transport, with the 999 wildcards (O-B11, O-J10)."""
    s = number_services(correct_services(t["service"], t["transport"]))
    tr = wildcard_single_mode(t["transport"])
    v = t["validity"].select("serviceid", "footnote", F.col("firststop").alias("v_first"), F.col("laststop").alias("v_last"))
    trj = tr.select("serviceid", "transmode", F.col("firststop").alias("t_first"), F.col("laststop").alias("t_last"))
    stop = t["stop"].select("serviceid", "idx", "station")
    gefi = t["attribute"].filter(F.col("code") == "GEFI").select("serviceid").distinct().withColumn("__gefi", F.lit(True))
    j = (s.join(v, "serviceid")
         .filter(((F.col("v_last") == F.col("laststop")) & (F.col("v_first") == F.col("firststop"))) | (F.col("v_last") == 999))
         .join(trj, "serviceid")
         .filter((F.col("t_first") == F.col("firststop")) | (F.col("t_last") == 999))
         .join(stop.withColumnRenamed("idx", "firststop").withColumnRenamed("station", "begin_station"), ["serviceid", "firststop"])
         .join(stop.withColumnRenamed("idx", "laststop").withColumnRenamed("station", "dest_station"), ["serviceid", "laststop"])
         .join(t["station"].select(F.col("shortname").alias("dest_station"), F.col("name").alias("dest_name")), "dest_station")
         .join(gefi, "serviceid", "left"))
    num = trip_number()
    road = F.col("transmode").isin(*ROAD_MODES)
    return j.select(
        _route_id().alias("route_id"),
        F.concat(F.lit("NS:"), F.col("footnote").cast("string")).alias("service_id"),
        key("serviceid", "footnote", num).alias("trip_id"),
        F.col("dest_name").alias("trip_headsign"),
        F.when(road, (F.col("begin_station") > F.col("dest_station")).cast("int")).otherwise(num % 2).alias("direction_id"),
        F.when(F.col("servicenumber") != variant_number(), variant_number()).otherwise(F.col("servicenumber")).alias("trip_short_name"),
        F.col("serviceid").alias("block_id"),
        F.when(F.col("transmode").isin(*BIKE_MODES), 1).when(F.col("__gefi").isNotNull(), 1).otherwise(2).alias("trip_bikes_allowed"),
    )


# ------------------------------------------------------------------ O-B15
def stop_times_iff(t: dict[str, DataFrame]) -> DataFrame:
    """stop_times: every stop with its attribute codes, the service ranges and validities (O-B15)."""
    from gtfsforge.operators.calendar import explode_range

    s = number_services(correct_services(t["service"], t["transport"]))
    attr = explode_range(t["attribute"].select("serviceid", "code", "firststop", "laststop"),
                         F.col("firststop").cast("int"), F.col("laststop").cast("int"), "idx").select("serviceid", "code", "idx")
    here = ["serviceid", "idx"]
    attrs = attr.groupBy(*here).agg(F.collect_set("code").alias("attrs"))
    stop = t["stop"].select(*here, "station", "arrivaltime", "departuretime")
    # a stop without a service or a place in it is none that anything is known of, its own columns included
    stop = stop.dropna(subset=here).unionByName(stop.where("serviceid is null or idx is null").select(*here).distinct(), allowMissingColumns=True)
    # what is of one stop meets by service and place, then what is of the service by service alone, in whose partitions trips are numbered
    x = (stop.join(attrs, here, "left").join(t["platform"].select(*here, "arrival", "departure"), here, "left")
         .withColumn("attrs", F.coalesce("attrs", F.array().cast("array<string>"))))
    svc = s.select("serviceid", "servicenumber", "variant", F.col("firststop").cast("int").alias("__from"), F.col("laststop").cast("int").alias("__to"))
    runs = x.alias("x").join(svc.alias("s"), (F.col("x.serviceid") == F.col("s.serviceid")) & F.col("idx").between(F.col("__from"), F.col("__to")), "left").drop(F.col("s.serviceid"))
    y = runs.join(t["validity"].select("serviceid", "footnote"), "serviceid", "left")
    num = trip_number()
    w = Window.partitionBy("serviceid", "footnote", num).orderBy("idx")

    def has(c):
        return F.array_contains("attrs", c)

    pickup = F.when(has("NIIN"), 1).when(has("RESV"), 2).when(has("IRES"), 2).otherwise(0)
    drop = F.when(has("NUIT"), 1).when(has("RESV"), 2).when(has("IRES"), 2).otherwise(0)
    y = y.select(
        key("serviceid", "footnote", num).alias("trip_id"),
        F.col("arrivaltime").alias("arrival_time"),
        F.coalesce("departuretime", "arrivaltime").alias("departure_time"),
        F.concat("station", F.lit("|"), F.coalesce("departure", F.lit("0"))).alias("stop_id"),
        F.when(F.col("arrival") != F.col("departure"), F.concat("station", F.lit("|"), "arrival")).alias("arrival_stop_id"),
        F.row_number().over(w).alias("stop_sequence"),
        pickup.alias("pickup_type"), drop.alias("drop_off_type"))
    return y.select("trip_id",
                    F.when(F.col("stop_sequence") == 1, F.col("departure_time")).otherwise(F.col("arrival_time")).alias("arrival_time"),
                    "departure_time", "stop_id", "arrival_stop_id", F.col("stop_sequence").cast("int"), "pickup_type",
                    "drop_off_type")


# ------------------------------------------------------------------ O-B18
def platform_pairs(platform: DataFrame, station: DataFrame) -> DataFrame:
    """Transfers between the platforms of a station (O-J6): pairs of *distinct* platform
    entries of one station, whose number is bounded by the station's platforms (not by
    the number of services).  type 2, layover - 20 s."""
    p = platform.select("station", "departure", "arrival").filter(F.col("departure").isNotNull()).distinct()
    p1 = p.select("station", F.col("departure").alias("d1"), F.col("arrival").alias("a1"))
    p2 = p.select("station", F.col("departure").alias("d2"), F.col("arrival").alias("a2"))
    st = station.select(F.col("shortname").alias("station"), "layovertime")
    return (p1.join(p2, "station").filter(F.col("a1") != F.col("d2")).join(st, "station")
            .select(F.concat("station", F.lit("|"), "d1").alias("from_stop_id"),
                    F.concat("station", F.lit("|"), "d2").alias("to_stop_id"),
                    F.lit(None).cast("string").alias("from_trip_id"), F.lit(None).cast("string").alias("to_trip_id"),
                    F.lit(2).alias("transfer_type"), (F.col("layovertime") - 20).alias("min_transfer_time"))
            .distinct())


def service_changes(t: dict[str, DataFrame], parts: int | None = None) -> DataFrame:
    """Guaranteed / possible connections between two services at a station (O-B18 second part).

    parts: how many partitions calls and changes meet in (default: the session's).
    """
    def meet(df, *cols):
        return df.repartition(parts, *cols) if parts else df

    s = number_services(correct_services(t["service"], t["transport"]))
    niin = t["attribute"].filter(F.col("code") == "NIIN").select("serviceid").distinct()
    c = t["changes"].join(niin.withColumnRenamed("serviceid", "fromservice"), "fromservice", "left_anti").join(
        niin.withColumnRenamed("serviceid", "toservice"), "toservice", "left_anti").filter(
        F.col("fromservice") != F.col("toservice"))

    def side(role, svc_col, time_col):
        plat = t["platform"].select(F.col("serviceid").alias(svc_col), F.col("idx").alias(f"{role}_idx"),
                                    "station", F.col("arrival").alias(f"{role}_arrival"),
                                    F.col("departure").alias(f"{role}_departure"))
        stop = t["stop"].select(F.col("serviceid").alias(svc_col), F.col("idx").alias(f"{role}_idx"), "station",
                                F.col(time_col).alias(f"{role}_time"))
        sv = s.select(F.col("serviceid").alias(svc_col), F.col("firststop").alias(f"{role}_f"),
                      F.col("laststop").alias(f"{role}_l"), F.col("servicenumber").alias(f"{role}_sn"),
                      F.col("variant").alias(f"{role}_var"))
        val = t["validity"].select(F.col("serviceid").alias(svc_col), F.col("footnote").alias(f"{role}_fn"))
        calls = meet(plat, svc_col, f"{role}_idx", "station").join(stop, [svc_col, f"{role}_idx", "station"])
        return meet(calls, svc_col).join(sv, svc_col).filter(
            F.col(f"{role}_idx").between(F.col(f"{role}_f"), F.col(f"{role}_l"))).join(val, svc_col)

    names = t["station"].select(F.col("shortname").alias("station"))
    came = meet(c, "fromservice", "station").join(side("a", "fromservice", "arrivaltime"), ["fromservice", "station"])
    j = (meet(came, "toservice", "station").join(side("d", "toservice", "departuretime"), ["toservice", "station"])
         .join(names, "station", "left_semi")
         .filter(F.col("d_time") > F.col("a_time"))
         .filter(F.col("a_arrival") != F.col("d_departure")))
    ttype = (F.when(F.col("possiblechange") == 0, 3).when(F.col("possiblechange") == 1, 0)
             .when(F.col("possiblechange") == 2, 1).otherwise(99))
    return j.select(
        F.concat("station", F.lit("|"), "a_departure").alias("from_stop_id"),
        F.concat("station", F.lit("|"), "d_departure").alias("to_stop_id"),
        key("fromservice", "a_fn", trip_number("a_sn", "a_var")).alias("from_trip_id"),
        key("toservice", "d_fn", trip_number("d_sn", "d_var")).alias("to_trip_id"),
        ttype.alias("transfer_type"), F.lit(None).cast("int").alias("min_transfer_time"))


def transfers_iff(t: dict[str, DataFrame], parts: int | None = None) -> DataFrame:
    """transfers = platform pairs UNION service-to-service changes (O-B18)."""
    return union_distinct(platform_pairs(t["platform"], t["station"]), service_changes(t, parts))


# ------------------------------------------------------------------ O-B7 (older, per mode) and O-B19
def routes_iff_simple(t: dict[str, DataFrame]) -> DataFrame:
    """One route per (mode, company) named by the mode description (older variant of O-B7)."""
    j = (t["transport"].select("serviceid", "transmode")
         .join(modes(t["trnsmode"]).withColumnRenamed("code", "transmode"), "transmode", "left")
         .join(t["service"].select("serviceid", "companynumber"), "serviceid"))
    rtype = (F.when(F.col("transmode").isin("NSS", "NSB", "B", "BNS", "X", "U", "Y"), 3)
             .when(F.col("transmode") == "NSM", 1).when(F.col("transmode") == "NST", 0).otherwise(2))
    return j.select(F.concat(F.col("companynumber").cast("string"), F.lit("-"), "transmode").alias("route_id"),
                    F.col("companynumber").alias("agency_id"), F.lit(None).cast("string").alias("route_short_name"),
                    F.col("description").alias("route_long_name"), rtype.alias("route_type")).distinct()


def transfers_iff_min(t: dict[str, DataFrame]) -> DataFrame:
    """Older transfers (O-B19): platform pairs (layover time) and possible changes (code 1, 2;
    departure - arrival - 30 s), one row per stop pair with the least time (NULL only if no time)."""
    from gtfsforge.functions.timeofday import to_seconds

    plat = t["platform"]
    deps = plat.select("station", F.col("departure").alias("d")).filter(F.col("d").isNotNull()).distinct()
    p = plat.select("station", "departure", "arrival").distinct()
    p2 = p.select("station", F.col("departure").alias("d2"), F.col("arrival").alias("a2x")).filter(F.col("d2").isNotNull())
    p1 = p.select("station", F.col("arrival").alias("a1"), F.col("departure").alias("d1")).join(
        deps.withColumnRenamed("d", "a1"), ["station", "a1"], "left_semi")
    st = t["station"].select(F.col("shortname").alias("station"), "layovertime")
    pairs = (p1.join(p2, "station").filter(F.col("a1") != F.col("d2")).join(st, "station")
             .select(F.concat("station", F.lit("|"), "a1").alias("from_stop_id"),
                     F.concat("station", F.lit("|"), "d2").alias("to_stop_id"),
                     F.col("layovertime").alias("min_transfer_time")))
    s = t["service"]
    niin = t["attribute"].filter(F.col("code") == "NIIN").select("serviceid").distinct()
    c = (t["changes"].filter(F.col("possiblechange").isin(1, 2))
         .join(niin.withColumnRenamed("serviceid", "fromservice"), "fromservice", "left_anti")
         .join(niin.withColumnRenamed("serviceid", "toservice"), "toservice", "left_anti")
         .filter(F.col("fromservice") != F.col("toservice")))

    def side(role, svc_col):
        pl = plat.select(F.col("serviceid").alias(svc_col), F.col("idx").alias(f"{role}_idx"), "station",
                         F.col("arrival").alias(f"{role}_arrival"), F.col("departure").alias(f"{role}_departure"))
        sp = t["stop"].select(F.col("serviceid").alias(svc_col), F.col("idx").alias(f"{role}_idx"), "station",
                              F.col("arrivaltime").alias(f"{role}_arr"), F.col("departuretime").alias(f"{role}_dep"))
        sv = s.select(F.col("serviceid").alias(svc_col), F.col("firststop").alias(f"{role}_f"), F.col("laststop").alias(f"{role}_l"))
        val = t["validity"].select(F.col("serviceid").alias(svc_col)).distinct()
        return pl.join(sp, [svc_col, f"{role}_idx", "station"]).join(sv, svc_col).filter(
            F.col(f"{role}_idx").between(F.col(f"{role}_f"), F.col(f"{role}_l"))).join(val, svc_col, "left_semi")

    names = t["station"].select(F.col("shortname").alias("station"))
    ch = (c.join(side("a", "fromservice"), ["fromservice", "station"])
          .join(side("d", "toservice"), ["toservice", "station"])
          .join(names, "station", "left_semi")
          .filter(F.col("a_arrival") != F.col("d_departure"))
          .filter(F.col("d_dep") > F.col("a_dep"))
          .select(F.concat("station", F.lit("|"), "a_departure").alias("from_stop_id"),
                  F.concat("station", F.lit("|"), "d_departure").alias("to_stop_id"),
                  (to_seconds("d_dep") - to_seconds("a_arr") - 30).alias("min_transfer_time")))
    return pairs.unionByName(ch).groupBy("from_stop_id", "to_stop_id").agg(
        F.lit(2).alias("transfer_type"), F.min("min_transfer_time").alias("min_transfer_time"))
