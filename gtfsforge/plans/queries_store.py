"""Registered queries: interval joins, whole-delivery merges, cascades, correction rules, reference checks on outputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from gtfsforge.operators import versions as ver
from gtfsforge.operators.corrections import Rule, correct, rule_counts
from gtfsforge.operators.intervals import interval_join
from gtfsforge.operators.keygraph import KV1_GRAPH, cascade_all
from gtfsforge.operators.quality import fk_violations
from gtfsforge.plans import gtfs_iff as iff
from gtfsforge.plans import queries_iff
from gtfsforge.plans.registry import ORACLE, SVC_SQL, register
from gtfsforge.plans.views import World, oracle
from gtfsforge.sinks import mark_repeats

UNIT = ["dataownercode", "organizationalunitcode"]


# ---------------------------------------------------------------- O-J5
def _points_and_ranges(w: World):
    points = w.kv_excopday.select(*UNIT, "validdate", "daytypeason")
    return points, w.kv_schedvers.select(*UNIT, "schedulecode", "scheduletypecode", "validfrom", "validthru")


INTERVALS = ["kv_excopday", "kv_schedvers"]


@register("join_interval_j5", oracle(INTERVALS, """
SELECT dataownercode, organizationalunitcode, validdate, daytypeason, schedulecode, scheduletypecode, validfrom, validthru
FROM kv_schedvers r JOIN kv_excopday p USING (dataownercode, organizationalunitcode) WHERE validdate >= validfrom AND validdate <= validthru"""))
def q_interval(spark, sf):
    points, ranges = _points_and_ranges(World(spark, sf))
    return interval_join(points, ranges, UNIT, "validdate", "validfrom", "validthru")


@register("join_interval_semi_j5", oracle(["kv_operday", "kv_schedvers_delta"], f"""
SELECT {SVC_SQL}, validdate FROM kv_operday SEMI JOIN kv_schedvers_delta s
ON s.dataownercode = kv_operday.dataownercode AND s.schedulecode = kv_operday.schedulecode AND kv_operday.validdate BETWEEN s.validfrom AND s.validthru"""))
def q_interval_semi(spark, sf):
    w = World(spark, sf)
    return interval_join(w.kv_operday, w.kv_schedvers_delta, ["dataownercode", "schedulecode"], "validdate", "validfrom", "validthru", "semi")


@register("join_interval_anti_j5", oracle(["kv_operday", "kv_schedvers_delta"], f"""
SELECT {SVC_SQL}, validdate FROM kv_operday ANTI JOIN kv_schedvers_delta s
ON s.dataownercode = kv_operday.dataownercode AND s.schedulecode = kv_operday.schedulecode AND kv_operday.validdate BETWEEN s.validfrom AND s.validthru"""))
def q_interval_anti(spark, sf):
    w = World(spark, sf)
    return interval_join(w.kv_operday, w.kv_schedvers_delta, ["dataownercode", "schedulecode"], "validdate", "validfrom", "validthru", "anti")


# ---------------------------------------------------------------- O-V6b: a delivery merged into every table
def _merged(w: World) -> dict:
    base = {"operday": w.kv_operday, "schedvers": w.kv_schedvers, "pujopass": w.kv_pujopass_base}
    staged = {"operday": w.kv_operday_delta, "schedvers": w.kv_schedvers_delta, "pujopass": w.kv_pujopass_delta}
    return ver.merge_tables(base, staged, "tail")


MERGED = ["kv_operday", "kv_operday_delta", "kv_schedvers", "kv_schedvers_delta", "kv_pujopass_base", "kv_pujopass_delta"]
SQL_MERGED = f"""
, cut AS (SELECT dataownercode, organizationalunitcode, min(validdate) AS first FROM kv_operday_delta GROUP BY ALL)
, days AS (
  SELECT {SVC_SQL}, validdate FROM kv_operday LEFT JOIN cut USING (dataownercode, organizationalunitcode) WHERE first IS NULL OR validdate < first
  UNION ALL SELECT {SVC_SQL}, validdate FROM kv_operday_delta)
, lost AS (SELECT DISTINCT {SVC_SQL} FROM kv_operday EXCEPT SELECT {SVC_SQL} FROM days)
"""


@register("merge_tables_operday_v6b", oracle(MERGED, SQL_MERGED + "SELECT * FROM days"))
def q_merged_operday(spark, sf):
    return _merged(World(spark, sf))["operday"]


@register("merge_tables_schedvers_v6b", oracle(MERGED, SQL_MERGED + f"""
SELECT * FROM kv_schedvers ANTI JOIN lost USING ({SVC_SQL}) UNION ALL SELECT * FROM kv_schedvers_delta"""))
def q_merged_schedvers(spark, sf):
    return _merged(World(spark, sf))["schedvers"]


@register("merge_tables_pujopass_v6b", oracle(MERGED, SQL_MERGED + f"""
SELECT * FROM kv_pujopass_base ANTI JOIN lost USING ({SVC_SQL}) UNION ALL SELECT * FROM kv_pujopass_delta"""))
def q_merged_pujopass(spark, sf):
    return _merged(World(spark, sf))["pujopass"]


# ---------------------------------------------------------------- O-Q4: cascades level by level
def _without(w: World) -> dict:
    """A version, some schedules and some stops withdrawn at once."""
    tables = {"operday": w.kv_operday, "schedvers": w.kv_schedvers, "usrstop": w.kv_usrstop, "pujopass": w.kv_pujopass}
    stops = w.kv_usrstop.where("userstoptype = 'FINANCIAL'").select("version", "dataownercode", "userstopcode")
    weekend = w.kv_schedvers.where("version = 2 and scheduletypecode = 'SAT'").select(*ver.SCHED_KEY)
    return cascade_all(tables, KV1_GRAPH, {"usrstop": stops, "schedvers": weekend}, {"version": w.kv_version.where("version = 3 and dataownercode = 'HTM'")})


CASCADE = ["kv_operday", "kv_schedvers", "kv_usrstop", "kv_pujopass", "kv_version"]
SQL_GONE = "NOT (version = 3 AND dataownercode = 'HTM') AND NOT (version = 2 AND scheduletypecode = 'SAT')"


@register("cascade_schedvers_q4", oracle(CASCADE, f"SELECT * FROM kv_schedvers WHERE {SQL_GONE}"))
def q_cascade_schedvers(spark, sf):
    return _without(World(spark, sf))["schedvers"]


@register("cascade_operday_q4", oracle(CASCADE, f"SELECT * FROM kv_operday WHERE {SQL_GONE}"))
def q_cascade_operday(spark, sf):
    return _without(World(spark, sf))["operday"]


@register("cascade_pujopass_q4", oracle(CASCADE, f"""
SELECT * FROM kv_pujopass WHERE NOT (version = 3 AND dataownercode = 'HTM')
AND NOT (version = 2 AND scheduletypecode = 'SAT' AND ({', '.join(ver.SCHED_KEY)}) IN (SELECT ({', '.join(ver.SCHED_KEY)}) FROM kv_schedvers))
AND (version, dataownercode, userstopcode) IN (SELECT (version, dataownercode, userstopcode) FROM kv_usrstop WHERE userstoptype <> 'FINANCIAL')"""))
def q_cascade_pujopass(spark, sf):
    return _without(World(spark, sf))["pujopass"]


# ---------------------------------------------------------------- O-P9, O-P10: rules in order
STOP_RULES = (
    Rule("usrstop", "towns of the north", "town in ('T1', 'T2', 'T3')", (("town", "'North'"), ("name", "concat(name, ' (', town, ')')"))),
    Rule("usrstop", "stops of the north without an area get one", "town = 'North' and userstopareacode is null", (("userstopareacode", "'ANORTH'"),)),
    Rule("usrstop", "closed stops", "not getin and not getout"),
    Rule("usrstop", "financial stops aren't boarded", "userstoptype = 'FINANCIAL' or town is null", (("getin", "false"), ("getout", "false"))),
    Rule("usrstop", "what nobody boards is a point", "not getin and not getout", (("userstoptype", "'POINT'"),)),
)


@register("correct_stops_p9", oracle(["kv_usrstop"], """
, s AS (SELECT *, town IN ('T1', 'T2', 'T3') AS north, userstoptype = 'FINANCIAL' AS money FROM kv_usrstop WHERE getin OR getout)
SELECT version, dataownercode, userstopcode, CASE WHEN north THEN name || ' (' || town || ')' ELSE name END AS name,
       CASE WHEN north THEN 'North' ELSE town END AS town, CASE WHEN north THEN ifnull(userstopareacode, 'ANORTH') ELSE userstopareacode END AS userstopareacode,
       getin AND NOT money AS getin, getout AND NOT money AS getout, CASE WHEN money THEN 'POINT' ELSE userstoptype END AS userstoptype FROM s"""))
def q_correct_stops(spark, sf):
    return correct(World(spark, sf).kv_usrstop, STOP_RULES)


@register("correct_counts_p10", oracle(["kv_usrstop"], """
SELECT 'towns of the north' AS rule, count(*) AS rows FROM kv_usrstop WHERE town IN ('T1', 'T2', 'T3')
UNION ALL SELECT 'stops of the north without an area get one', count(*) FROM kv_usrstop WHERE town IN ('T1', 'T2', 'T3') AND userstopareacode IS NULL
UNION ALL SELECT 'closed stops', count(*) FROM kv_usrstop WHERE NOT (getin OR getout)
UNION ALL SELECT 'financial stops aren''t boarded', count(*) FROM kv_usrstop WHERE userstoptype = 'FINANCIAL' AND (getin OR getout)
UNION ALL SELECT 'what nobody boards is a point', count(*) FROM kv_usrstop WHERE userstoptype = 'FINANCIAL' AND (getin OR getout)"""))
def q_correct_counts(spark, sf):
    return rule_counts(World(spark, sf).kv_usrstop, STOP_RULES)


# ---------------------------------------------------------------- O-Q2 on outputs: a feed from which an agency was taken out
@register("gtfs_trips_without_route_q2", f"""
SELECT trip_id, route_id FROM ({ORACLE['gtfs_trips_iff_b11']}) trips
ANTI JOIN (SELECT route_id FROM ({ORACLE['gtfs_routes_iff_b7']}) r WHERE agency_id <> 'C0') routes USING (route_id)""")
def q_trips_without_route(spark, sf):
    """Trips whose route went with its agency."""
    t = queries_iff.tables(World(spark, sf))
    return fk_violations(iff.trips_iff(t), iff.routes_iff(t).where("agency_id <> 'C0'"), ["route_id"]).select("trip_id", "route_id")


@register("gtfs_routes_without_agency_q2", f"SELECT route_id, agency_id FROM ({ORACLE['gtfs_routes_iff_b7']}) r WHERE agency_id = 'C0'")
def q_routes_without_agency(spark, sf):
    """Routes whose agency is missing."""
    t = queries_iff.tables(World(spark, sf))
    return fk_violations(iff.routes_iff(t), iff.agency_iff(t).where("agency_id <> 'C0'"), ["agency_id"]).select("route_id", "agency_id")


# ---------------------------------------------------------------- O-K4: rows that repeat a key, found in the ordered write
@register("stop_times_key_k4", oracle(["kv_pujopass"], """
SELECT journeynumber, userstopcode, stoporder, row_number() OVER (PARTITION BY journeynumber, userstopcode ORDER BY stoporder) > 1 AS rejected
FROM kv_pujopass"""))
def q_stop_times_key(spark, sf):
    calls = World(spark, sf).kv_pujopass.select("journeynumber", "userstopcode", "stoporder")
    return mark_repeats(calls, ["journeynumber", "userstopcode"]).withColumnRenamed("__rejected", "rejected").select(
        "journeynumber", "userstopcode", "stoporder", F.col("rejected"))
