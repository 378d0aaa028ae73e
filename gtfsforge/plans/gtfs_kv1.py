"""GTFS builders for KV1 deliveries (O-B1..O-B3, O-B6, O-B9, O-B10, O-B13, O-B14, O-C1).

Each builder is a pure function ``(tables: dict[str, DataFrame], ...) -> DataFrame``.
Dimension tables (stops, patterns, lines, destinations) are left to AQE: it
turns a join into a broadcast hash join when the runtime size of a side is
under ``spark.sql.autoBroadcastJoinThreshold`` and keeps a sort-merge join
otherwise, so nothing unbounded is broadcast.  Only the fixed lookups in
``sources.lookup`` are broadcast by hint.

Scoping: the reference loads one operator per database, so its joins omit
``dataownercode``.  Here several operators share one store, so the joins are
scoped by owner, which is the same result for a single operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gtfsforge.functions.geo import rd_to_wgs84
from gtfsforge.functions.timeofday import seconds_to_time, to_seconds, yyyymmdd
from gtfsforge.operators.first import first_per, key, union_all, union_distinct
from gtfsforge.sources import lookup

PAT = ["version", "dataownercode", "lineplanningnumber", "journeypatterncode"]
LINK = ["version", "dataownercode", "userstopcodebegin", "userstopcodeend"]
SERVICE = ["version", "dataownercode", "organizationalunitcode", "schedulecode", "scheduletypecode"]


def _spark(t):
    return next(iter(t.values())).sparkSession


def fill_transporttype(line: DataFrame) -> DataFrame:
    """Passing-time path: a missing transport type is BOAT for public number FF, else BUS."""
    return line.withColumn(
        "transporttype",
        F.coalesce("transporttype", F.when(F.col("linepublicnumber") == "FF", "BOAT").otherwise("BUS")),
    )


def train_lines(line: DataFrame) -> DataFrame:
    return line.filter(F.col("transporttype") == "TRAIN").select("dataownercode", "lineplanningnumber")


def first_link(jopatili: DataFrame, cols) -> DataFrame:
    """First timing link of every pattern (DISTINCT ON pattern ORDER BY timinglinkorder)."""
    return first_per(jopatili, PAT, ["timinglinkorder"]).select(*PAT, *cols)


# ------------------------------------------------------------------ O-B13
def pattern_info(jt: DataFrame, dest: DataFrame) -> DataFrame:
    """Everything stop_times needs per journey pattern, in one pattern-keyed row:
    the product formula of its first non-18 link and a map stop order -> headsign
    for the stops whose destination differs from the trip's (O-B13).

    Folding both lookups into one table keyed by the pattern means the large
    passings side is joined (and, above the broadcast threshold, shuffled) once
    on the pattern key instead of once per lookup.
    """
    prodform = first_per(jt.filter(F.col("productformulatype") != 18), PAT, ["timinglinkorder"]).select(
        *PAT, "productformulatype"
    )
    # stop -> destination of the link that starts there, plus the end of the last link
    begins = jt.select(*PAT, F.col("timinglinkorder").alias("stoporder"), "destcode")
    ends = first_per(jt, PAT, [F.col("timinglinkorder").desc()]).select(
        *PAT, (F.col("timinglinkorder") + 1).alias("stoporder"), "destcode"
    )
    trip_dest = first_link(jt, [F.col("destcode").alias("trip_destcode")])
    headsign = (
        union_distinct(begins, ends)
        .join(trip_dest, PAT)
        .filter(F.col("destcode") != F.col("trip_destcode"))
        .join(dest.select("version", "dataownercode", "destcode", "destnamefull"), ["version", "dataownercode", "destcode"])
        .groupBy(*PAT)
        .agg(F.map_from_entries(F.collect_list(F.struct(F.col("stoporder").cast("int"), "destnamefull"))).alias("headsigns"))
    )
    return prodform.join(headsign, PAT, "full")


def stop_times_passing(t: dict[str, DataFrame]) -> DataFrame:
    """stop_times from KV1 passing times (O-B13)."""
    p, u, jt, dest = t["pujopass"], t["usrstop"], t["jopatili"], t["dest"]
    stops = u.filter(F.col("getin") | F.col("getout")).select("version", "dataownercode", "userstopcode", "getin", "getout")
    on_demand = F.col("productformulatype").isin(*lookup.ON_DEMAND_FORMULAS)
    return (
        p.join(stops, ["version", "dataownercode", "userstopcode"])
        .join(pattern_info(jt, dest), PAT, "left")
        # line keys are NOT NULL, so NOT IN == anti-join
        .join(train_lines(t["line"]), ["dataownercode", "lineplanningnumber"], "left_anti")
        .select(
            key(*SERVICE, "lineplanningnumber", "journeynumber").alias("trip_id"),
            F.coalesce("targetarrivaltime", "targetdeparturetime").alias("arrival_time"),
            F.coalesce("targetdeparturetime", "targetarrivaltime").alias("departure_time"),
            key("dataownercode", "userstopcode").alias("stop_id"),
            F.col("headsigns")[F.col("stoporder").cast("int")].alias("stop_headsign"),
            F.col("stoporder").cast("int").alias("stop_sequence"),
            F.when(on_demand, 3).otherwise((~F.col("getin")).cast("int")).alias("pickup_type"),
            F.when(on_demand, 3).otherwise((~F.col("getout")).cast("int")).alias("drop_off_type"),
        )
    )


# ------------------------------------------------------------------ O-B9
def trips_passing(t: dict[str, DataFrame]) -> DataFrame:
    """trips from KV1 passing times (O-B9): first passing, headsign of the first link."""
    spark = _spark(t)
    p, j, jt, dest = t["pujopass"], t["jopa"], t["jopatili"], t["dest"]
    # links whose destination exists; the first of them per pattern (DISTINCT ON trip ORDER BY timinglinkorder)
    first = first_per(
        jt.join(dest.select("version", "dataownercode", "destcode", "destnamefull"), ["version", "dataownercode", "destcode"]),
        PAT,
        ["timinglinkorder"],
    ).select(*PAT, F.col("destnamefull").alias("trip_headsign"))
    # both pattern-level lookups joined first: the journeys are joined once on the pattern key
    pat = j.select(*PAT, "direction").join(first, PAT)
    return (
        p.filter(F.col("stoporder") == 1)
        .withColumn("wheelchairaccessible", F.coalesce("wheelchairaccessible", F.lit("UNKNOWN")))
        .join(lookup.wheelchair(spark), "wheelchairaccessible")
        .join(pat, PAT)
        .join(train_lines(t["line"]), ["dataownercode", "lineplanningnumber"], "left_anti")
        .join(lookup.bikes_allowed(spark), ["dataownercode", "lineplanningnumber"], "left")
        .select(
            key("dataownercode", "lineplanningnumber").alias("route_id"),
            key(*SERVICE).alias("service_id"),
            key(*SERVICE, "lineplanningnumber", "journeynumber").alias("trip_id"),
            F.col("journeynumber").cast("string").alias("trip_short_name"),
            "trip_headsign",
            (F.col("direction").cast("int") - 1).alias("direction_id"),
            key(*PAT).alias("shape_id"),
            "wheelchair_accessible",
            "trip_bikes_allowed",
        )
    )


# ------------------------------------------------------------------ O-B6
def routes_kv1(t: dict[str, DataFrame]) -> DataFrame:
    """routes from the latest line version (O-B6)."""
    spark = _spark(t)
    line = fill_transporttype(t["line"])
    jt = t["jopatili"]
    pf = (
        jt.select("version", "dataownercode", "lineplanningnumber", "productformulatype")
        .distinct()
        .join(lookup.product_formula(spark), "productformulatype", "left")
    )
    htm_buzz = jt.filter(F.col("confinrelcode") == "SGHB").select("lineplanningnumber").distinct()
    cand = (
        line.filter(F.col("transporttype") != "TRAIN")
        .join(lookup.route_type(spark), "transporttype")
        .join(pf, ["version", "dataownercode", "lineplanningnumber"])
        .join(htm_buzz.withColumn("__buzz", F.lit(True)), "lineplanningnumber", "left")
    )
    # DISTINCT ON (owner, line) ORDER BY version DESC; the formula breaks remaining ties
    best = first_per(
        cand,
        ["dataownercode", "lineplanningnumber"],
        [F.col("version").desc(), F.col("productformulatype").asc_nulls_last()],
    )
    agency = (
        F.when((F.col("dataownercode") == "ARR") & F.col("lineplanningnumber").like("150__"), "WATERBUS")
        .when((F.col("dataownercode") == "HTM") & F.col("__buzz").isNotNull(), "HTMBUZZ")
        .otherwise(F.col("dataownercode"))
    )
    return best.select(
        key("dataownercode", "lineplanningnumber").alias("route_id"),
        agency.alias("agency_id"),
        F.col("linepublicnumber").alias("route_short_name"),
        F.when(F.col("linepublicnumber") != F.col("linename"), F.col("linename")).alias("route_long_name"),
        "route_type",
        "localized_route_type",
    )


# Agencies of the drive-time feed by the first character of the line planning number.
AGENCY_BY_PREFIX = {"U": "GVU", "A": "BRENG", "X": "BRENG", "L": "HERMES"}


def routes_drivetime(t: dict[str, DataFrame]) -> DataFrame:
    """routes of the drive-time feed (O-B6): agency by line prefix, the long name always, lines without a transport type left out."""
    spark = _spark(t)
    formula = t["jopatili"].select("version", "dataownercode", "lineplanningnumber", "productformulatype").distinct()
    served = (
        t["line"].filter(F.col("transporttype").isNotNull() & (F.col("transporttype") != "TRAIN"))
        .join(lookup.route_type(spark), "transporttype")
        .join(formula.join(lookup.product_formula(spark), "productformulatype", "left"), ["version", "dataownercode", "lineplanningnumber"])
    )
    newest = first_per(served, ["dataownercode", "lineplanningnumber"], [F.col("version").desc(), F.col("productformulatype").asc_nulls_last()])
    by_prefix = F.create_map(*[F.lit(x) for kv in AGENCY_BY_PREFIX.items() for x in kv])
    return newest.select(
        key("dataownercode", "lineplanningnumber").alias("route_id"),
        F.coalesce(F.try_element_at(by_prefix, F.substring("lineplanningnumber", 1, 1)), "dataownercode").alias("agency_id"),
        F.col("linepublicnumber").alias("route_short_name"),
        F.col("linename").alias("route_long_name"),
        "route_type",
        "localized_route_type",
    )


# ------------------------------------------------------------------ O-B1
def agency_kv1(routes: DataFrame) -> DataFrame:
    """Agencies in use by the routes, with name/url from the fixed list (O-B1)."""
    spark = routes.sparkSession
    used = routes.select("agency_id").distinct()
    return used.join(lookup.agencies(spark), "agency_id", "left").select(
        "agency_id",
        F.coalesce("agency_name", "agency_id").alias("agency_name"),
        "agency_url",
        F.lit(lookup.AGENCY_TIMEZONE).alias("agency_timezone"),
        F.lit(lookup.AGENCY_LANG).alias("agency_lang"),
    )


# ------------------------------------------------------------------ O-B2
def feed_info(days: DataFrame, as_of: str, publisher: tuple[str, str], date_col: str = "validdate", end_col: str | None = None) -> DataFrame:
    """feed_info: global first/last day (O-B2, O-A1); ``as_of`` replaces now(), ``publisher`` is (name, url)."""
    name, url = publisher
    end_col = end_col or date_col
    return days.agg(F.min(date_col).alias("s"), F.max(end_col).alias("e")).select(
        F.lit(name).alias("feed_publisher_name"),
        F.lit(url).alias("feed_publisher_url"),
        F.lit(lookup.FEED_LANG).alias("feed_lang"),
        yyyymmdd("s").alias("feed_start_date"),
        yyyymmdd("e").alias("feed_end_date"),
        F.lit(as_of).alias("feed_version"),
    )


# ------------------------------------------------------------------ O-C1
def calendar_operday(operday: DataFrame) -> DataFrame:
    """calendar_dates straight from the operating days (O-C1)."""
    return operday.select(
        key(*SERVICE).alias("service_id"),
        yyyymmdd("validdate").alias("date"),
        F.lit(1).alias("exception_type"),
    )


# ------------------------------------------------------------------ O-B3
def stops_kv1(t: dict[str, DataFrame]) -> DataFrame:
    """stops: parent areas at their centroid plus boarding stops used by a pattern (O-B3)."""
    u, pt, star, jt = t["usrstop"], t["point"], t["usrstar"], t["jopatili"]
    pts = pt.select("version", "dataownercode", F.col("pointcode").alias("userstopcode"), "locationx_ew", "locationy_ns")
    # parent areas: average RD coordinates per (version, area), then transform
    centroid = (
        u.filter(F.col("userstopareacode").isNotNull())
        .join(pts, ["version", "dataownercode", "userstopcode"])
        .groupBy("version", "dataownercode", "userstopareacode")
        .agg(F.avg("locationx_ew").alias("x"), F.avg("locationy_ns").alias("y"))
    )
    area = first_per(star, ["dataownercode", "userstopareacode"], [F.col("version").desc()])
    parents = rd_to_wgs84(
        centroid.join(area.select("version", "dataownercode", "userstopareacode", "name"),
                      ["version", "dataownercode", "userstopareacode"]),
        "x", "y",
    ).select(
        F.concat(key("dataownercode", "userstopareacode"), F.lit("|parent")).alias("stop_id"),
        F.col("name").alias("stop_name"),
        F.col("lat").cast("decimal(8,5)").alias("stop_lat"),
        F.col("lon").cast("decimal(7,5)").alias("stop_lon"),
        F.lit(1).alias("location_type"),
        F.lit(None).cast("string").alias("parent_station"),
    )
    used = union_distinct(
        jt.select("dataownercode", F.col("userstopcodebegin").alias("userstopcode")),
        jt.select("dataownercode", F.col("userstopcodeend").alias("userstopcode")),
    )
    # DISTINCT ON (owner, stop) of boarding stops; newest version first as the tiebreak
    board = first_per(u.filter(F.col("getin") | F.col("getout")), ["dataownercode", "userstopcode"], [F.col("version").desc()])
    children = rd_to_wgs84(
        board.join(pts, ["version", "dataownercode", "userstopcode"]).join(used, ["dataownercode", "userstopcode"], "left_semi"),
        "locationx_ew", "locationy_ns",
    ).select(
        key("dataownercode", "userstopcode").alias("stop_id"),
        F.col("name").alias("stop_name"),
        F.col("lat").cast("decimal(8,5)").alias("stop_lat"),
        F.col("lon").cast("decimal(7,5)").alias("stop_lon"),
        F.lit(0).alias("location_type"),
        F.concat(key("dataownercode", "userstopareacode"), F.lit("|parent")).alias("parent_station"),
    )
    return union_distinct(parents, children)


# ------------------------------------------------------------------ O-B10
def trips_drivetime(t: dict[str, DataFrame]) -> DataFrame:
    """trips from drive-time journeys (O-B10): own-operated journeys only."""
    spark = _spark(t)
    p, j, jt, dest = t["pujo"], t["jopa"], t["jopatili"], t["dest"]
    first = first_link(jt, ["destcode"]).join(
        dest.select("version", "dataownercode", "destcode", "destnamefull"), ["version", "dataownercode", "destcode"]
    )
    return (
        p.filter(F.col("dataownerisoperator"))
        .join(lookup.wheelchair(spark), "wheelchairaccessible")
        .join(j.select(*PAT, "direction"), PAT)
        .join(first.select(*PAT, "destnamefull"), PAT)
        .select(
            key("dataownercode", "lineplanningnumber").alias("route_id"),
            key("version", "dataownercode", "timetableversioncode", "organizationalunitcode", "periodgroupcode",
                "specificdaycode", "daytype").alias("service_id"),
            key("version", "dataownercode", "periodgroupcode", "daytype", "lineplanningnumber", "journeynumber").alias("trip_id"),
            F.col("destnamefull").alias("trip_headsign"),
            (F.col("direction").cast("int") - 1).alias("direction_id"),
            key(*PAT).alias("shape_id"),
        )
    )


# ------------------------------------------------------------------ O-B14
def stop_times_drivetime(t: dict[str, DataFrame]) -> DataFrame:
    """stop_times of drive-time journeys (O-B14): first stop, middle stops, last stop (O-U2, O-K4).

    ``t['timdempass']`` holds the cumulative offsets (O-T7) per pattern and
    time-demand group.  What a journey calls at depends on its pattern and group
    alone, so each group's calls are put together once, as one array (bounded by
    the route's length), and the journeys are joined with that and exploded.
    """
    p, u, tp, jt, dest = t["pujo"], t["usrstop"], t["timdempass"], t["jopatili"], t["dest"]
    on_demand = F.col("productformulatype").isin(*lookup.ON_DEMAND_FORMULAS)
    trip_id = key("version", "dataownercode", "periodgroupcode", "daytype", "lineplanningnumber", "journeynumber")
    d = dest.select("version", "dataownercode", "destcode", "destnamefull")
    stops = u.select("version", "dataownercode", F.col("userstopcode").alias("userstopcodebegin"), "getin", "getout", "userstoptype")
    TG = PAT + ["timedemandgroupcode"]
    w = Window.partitionBy(*PAT).orderBy("timinglinkorder").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    links = jt.select(
        *PAT, "timinglinkorder", "userstopcodebegin", "userstopcodeend", "destcode", "productformulatype", F.min("timinglinkorder").over(w).alias("first"),
        F.max("timinglinkorder").over(w).alias("last"), F.first("destcode").over(w).alias("trip_destcode"))
    sign = F.when(F.col("trip_destcode") != F.col("destcode"), F.col("destnamefull"))

    def call(order, stop, headsign, pickup, drop):
        return F.struct(order.cast("int").alias("stop_sequence"), key("dataownercode", stop).alias("stop_id"), headsign.alias("stop_headsign"),
                        pickup.alias("pickup_type"), drop.alias("drop_off_type"))

    boarded = [F.when(on_demand, 3).otherwise((~F.col(c)).cast("int")) for c in ("getin", "getout")]
    first = (links.where("timinglinkorder = first").join(stops.where("userstoptype = 'PASSENGER'"), ["version", "dataownercode", "userstopcodebegin"])
             .select(*PAT, call(F.col("timinglinkorder"), "userstopcodebegin", F.lit(None).cast("string"), *boarded).alias("first")))
    # the call where link n + 1 begins has the time at which link n ends; so has the last stop
    middle = (links.join(d, ["version", "dataownercode", "destcode"]).join(stops, ["version", "dataownercode", "userstopcodebegin"])
              .select(*PAT, (F.col("timinglinkorder") - 1).alias("timinglinkorder"), call(F.col("timinglinkorder"), "userstopcodebegin", sign, *boarded).alias("call")))
    unboarded = F.when(on_demand, 3).otherwise(0)
    last = (links.where("timinglinkorder = last").join(d, ["version", "dataownercode", "destcode"], "left")
            .select(*PAT, "timinglinkorder", call(F.col("timinglinkorder") + 1, "userstopcodeend", sign, unboarded, unboarded).alias("call")))
    timed = F.struct("call", F.col("totaldrivetime").alias("arrives"), (F.col("totaldrivetime") + F.col("stopwaittime")).alias("leaves"))
    calls = tp.join(union_all(middle, last), PAT + ["timinglinkorder"]).groupBy(*TG).agg(F.collect_list(timed).alias("calls"))
    journeys = p.select(*TG, "periodgroupcode", "daytype", "journeynumber", "departuretime", "dataownerisoperator").join(calls, TG, "left").join(first, PAT, "left")
    start = F.struct(F.col("first").alias("call"), F.lit(None).cast("long").alias("arrives"), F.lit(None).cast("long").alias("leaves"))
    begins = F.filter(F.array(start), lambda x: x["call"].isNotNull() & F.col("dataownerisoperator"))
    every = F.concat(begins, F.coalesce("calls", F.filter(F.array(start), lambda x: F.lit(False))))
    # add32time in its steps, each in a projection of its own: a journey's time is read once, and code that holds the whole
    # of it for every call is too long for the JVM to compile
    journeys = journeys.select(trip_id.alias("trip_id"), "departuretime", to_seconds("departuretime").alias("start"), every.alias("every"))
    out = journeys.select("trip_id", "departuretime", "start", F.explode("every").alias("x"))
    out = out.select("trip_id", "departuretime", "x", *[(F.col("start") + F.col(f"x.{c}").cast("int")).alias(c) for c in ("arrives", "leaves")])
    at = lambda c: F.when(F.col(f"x.{c}").isNull(), F.col("departuretime")).otherwise(seconds_to_time(c))
    return out.select("trip_id", "x.call.stop_sequence", "x.call.stop_id", "x.call.stop_headsign", at("arrives").alias("arrival_time"), at("leaves").alias("departure_time"),
                      "x.call.pickup_type", "x.call.drop_off_type")


# ------------------------------------------------------------------ O-G4 / O-B17
def shapes(t: dict[str, DataFrame], ties: str = "row_number", match_transport: bool = True,
           exclude_train: bool = False) -> DataFrame:
    """Shape polylines: the pool points of every link of a pattern, ordered by
    (link order, distance since start of link) (O-G4).

    ``ties``: ``row_number`` (consecutive) or ``rank`` (equal positions share a
    number, gaps follow).  ``match_transport``: pool transport type must equal
    the line's.  ``exclude_train``: drop patterns of TRAIN lines.
    """
    from gtfsforge.operators.first import seq

    jt, pool, point, line = t["jopatili"], t["pool"], t["point_all"], t["line"]
    # each point is transformed once, however many patterns pass it
    pts = rd_to_wgs84(point, "locationx_ew", "locationy_ns").select(
        "version", F.col("dataownercode").alias("pointdataownercode"), "pointcode",
        F.col("lat").cast("decimal(8,5)").alias("shape_pt_lat"), F.col("lon").cast("decimal(7,5)").alias("shape_pt_lon"))
    ln = line.select("version", "dataownercode", "lineplanningnumber", F.col("transporttype").alias("line_tt"))
    links = jt.select(*PAT, "timinglinkorder", "userstopcodebegin", "userstopcodeend").join(ln, ["version", "dataownercode", "lineplanningnumber"])
    if exclude_train:
        links = links.join(train_lines(line), ["dataownercode", "lineplanningnumber"], "left_anti")
    # links that no pattern uses are left out before their points are put in order
    j = links.join(pool.join(links.select(*LINK), LINK, "left_semi"), LINK)
    if match_transport:
        j = j.filter(F.col("transporttype") == F.col("line_tt"))
    j = j.join(pts, ["version", "pointdataownercode", "pointcode"])
    j = seq(j, PAT, ["timinglinkorder", "distancesincestartoflink"], "shape_pt_sequence", ties=ties)
    # distinct by the pattern's own columns, which the window has brought together already; codes hold no separator
    j = j.select(*PAT, "shape_pt_lat", "shape_pt_lon", F.col("shape_pt_sequence").cast("int").alias("shape_pt_sequence")).distinct()
    return j.select(key(*PAT).alias("shape_id"), "shape_pt_lat", "shape_pt_lon", "shape_pt_sequence")
