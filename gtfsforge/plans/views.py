"""Transit-shaped views derived from the driver tables.

The driver tables are TPC-H-like; the engine works on timetable tables.  These
views map one onto the other with plain arithmetic so that every registered
query reads the driver tables and its work grows with them.  They are *input
fixtures*: the same view text is run by Spark (``spark.sql``) and by the
DuckDB oracle, so both engines see identical inputs.  The operators under test
are library functions (DataFrame API) on the Spark side and independent SQL on
the oracle side.

Only a common SQL subset is used (no ``div``, no dialect date functions);
``{t}`` placeholders name base tables and are bound per engine.

Mapping of the order key ``k``:
  version = k % 3 + 1, owner = GVB (even k) / HTM (odd k),
  organisational unit = 'U' || (k div 2) % 2, schedule = k div 600,
  schedule type = SAT when k % 5 = 0 else WEEK, line = k % 20 within blocks of 4000 keys,
  journey pattern = k % 40 within the same blocks (a pattern belongs to one line; both grow with the keys), journey = k.
"""

from __future__ import annotations

import os
import re

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _idiv(a: str, b: int) -> str:
    return f"CAST(floor(({a}) / {b}) AS BIGINT)"


def _service(k: str) -> str:
    return (
        f"CAST({k} % 3 + 1 AS INT) AS version, "
        f"CASE WHEN {k} % 2 = 0 THEN 'GVB' ELSE 'HTM' END AS dataownercode, "
        f"'U' || CAST({_idiv(k, 2)} % 2 AS STRING) AS organizationalunitcode, "
        f"CAST({_idiv(k, 600)} AS STRING) AS schedulecode, "
        f"CASE WHEN {k} % 5 = 0 THEN 'SAT' ELSE 'WEEK' END AS scheduletypecode"
    )


def _hms(s: str) -> str:
    """Seconds -> 'HH:MM:SS' (hours may pass 24)."""
    return (
        f"lpad(CAST({_idiv(s, 3600)} AS STRING), 2, '0') || ':' || "
        f"lpad(CAST({_idiv(s, 60)} % 60 AS STRING), 2, '0') || ':' || "
        f"lpad(CAST(({s}) % 60 AS STRING), 2, '0')"
    )


# name -> (dependencies, body)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def _view(name: str, deps: tuple[str, ...], body: str) -> None:
    VIEWS[name] = (deps, body)


# ---------------------------------------------------------------- passings
_view("kv_passing_raw", (), """
SELECT l_orderkey AS k, l_suppkey, l_partkey, l_linenumber, l_returnflag, l_linestatus,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
            l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS INT) AS stoporder
FROM {lineitem}""")

_view("kv_passing_t", ("kv_passing_raw",), f"""
SELECT k, l_suppkey, l_partkey, l_linenumber, l_returnflag, l_linestatus, stoporder,
       CASE WHEN d0 % 9 = 0 THEN 0 ELSE 60 + d0 % 240 END AS drive
FROM (SELECT *, (k % 40) * 7 + stoporder * 13 + ({_idiv('k', 40)} % 3) * 30 AS d0 FROM kv_passing_raw) x""")

_view("kv_passing_s", ("kv_passing_t",), """
SELECT *,
       CAST((k % 27) * 3600 + sum(drive) OVER (PARTITION BY k ORDER BY stoporder
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS dep_s,
       CAST(count(*) OVER (PARTITION BY k) AS INT) AS nstops
FROM kv_passing_t""")

# KV1 PUJOPASS: one row per journey and stop
_view("kv_pujopass", ("kv_passing_s",), f"""
SELECT {_service('k')},
       CAST(k % 20 + 20 * CAST(floor(k / 4000) AS BIGINT) AS STRING) AS lineplanningnumber,
       k AS journeynumber,
       stoporder,
       CAST(k % 40 + 40 * CAST(floor(k / 4000) AS BIGINT) AS STRING) AS journeypatterncode,
       'S' || CAST(l_suppkey AS STRING) AS userstopcode,
       CASE WHEN stoporder = 1 THEN NULL ELSE {_hms('dep_s - stoporder * 5')} END AS targetarrivaltime,
       CASE WHEN stoporder = nstops THEN NULL ELSE {_hms('dep_s')} END AS targetdeparturetime,
       CASE WHEN l_linenumber % 3 = 0 THEN 'ACCESSIBLE' WHEN l_linenumber % 3 = 1 THEN 'NOTACCESSIBLE' ELSE NULL END
           AS wheelchairaccessible,
       true AS dataownerisoperator
FROM kv_passing_s""")

# the passings of a stored base, and those staged with the delta of operating days
_view("kv_pujopass_base", ("kv_pujopass",), """
SELECT p.* FROM kv_pujopass p JOIN {orders} o ON o.o_orderkey = p.journeynumber WHERE o.o_orderstatus <> 'P'""")

_view("kv_pujopass_delta", ("kv_pujopass",), """
SELECT p.* FROM kv_pujopass p JOIN {orders} o ON o.o_orderkey = p.journeynumber WHERE o.o_orderstatus = 'P'""")

# KV1 LINK: measured distance per stop pair and delivery (several per pair; O-T6 takes the minimum)
_view("kv_link", ("kv_passing_s",), """
SELECT CAST(a.k % 3 + 1 AS INT) AS version,
       'S' || CAST(a.l_suppkey AS STRING) AS userstopcodebegin,
       'S' || CAST(b.l_suppkey AS STRING) AS userstopcodeend,
       CAST(CASE WHEN a.l_partkey % 17 = 0 THEN 0 ELSE 50 + (a.l_partkey * 37 + b.l_partkey) % 1500 END AS INT) AS distance
FROM kv_passing_s a JOIN kv_passing_s b ON b.k = a.k AND b.stoporder = a.stoporder + 1""")

# KV1 OPERDAY: operating days of a schedule
_view("kv_operday", (), f"""
SELECT DISTINCT {_service('o_orderkey')}, CAST(o_orderdate AS DATE) AS validdate
FROM {{orders}} WHERE o_orderstatus <> 'P'""")

# staged delta of operating days (a later delivery overlapping the base)
_view("kv_operday_delta", (), f"""
SELECT DISTINCT {_service('o_orderkey')}, CAST(o_orderdate AS DATE) + CAST(o_custkey % 5 AS INT) AS validdate
FROM {{orders}} WHERE o_orderstatus = 'P'""")

# KV1 SCHEDVERS derived from the operating days
_view("kv_schedvers", ("kv_operday",), """
SELECT version, dataownercode, organizationalunitcode, schedulecode, scheduletypecode,
       min(validdate) AS validfrom, max(validdate) AS validthru
FROM kv_operday
GROUP BY version, dataownercode, organizationalunitcode, schedulecode, scheduletypecode""")

# staged schedule versions of the delta
_view("kv_schedvers_delta", ("kv_operday_delta",), """
SELECT version, dataownercode, organizationalunitcode, schedulecode, scheduletypecode,
       min(validdate) AS validfrom, max(validdate) AS validthru
FROM kv_operday_delta
GROUP BY version, dataownercode, organizationalunitcode, schedulecode, scheduletypecode""")

# VERSION: one delivery per (version, owner); the file name is the delivery key
_view("kv_version", (), f"""
SELECT CAST(o_orderkey % 3 + 1 AS INT) AS version,
       CASE WHEN o_orderkey % 2 = 0 THEN 'GVB' ELSE 'HTM' END AS dataownercode,
       min(CAST(o_orderdate AS DATE)) AS validfrom,
       max(CAST(o_orderdate AS DATE)) AS validthru,
       'kv1_' || CASE WHEN o_orderkey % 2 = 0 THEN 'GVB' ELSE 'HTM' END || '_'
           || CAST(CAST(o_orderkey % 3 + 1 AS INT) AS STRING) || CASE WHEN o_orderkey % 3 = 1 THEN '_buzz' ELSE '' END
           AS filename
FROM {{orders}}
GROUP BY CAST(o_orderkey % 3 + 1 AS INT), CASE WHEN o_orderkey % 2 = 0 THEN 'GVB' ELSE 'HTM' END,
         CASE WHEN o_orderkey % 3 = 1 THEN '_buzz' ELSE '' END""")

# ---------------------------------------------------------------- stops
_view("kv_usrstop", ("kv_pujopass",), """
SELECT u.version, u.dataownercode, u.userstopcode,
       s.s_name AS name,
       'T' || CAST(s.s_nationkey AS STRING) AS town,
       CASE WHEN s.s_suppkey % 9 = 0 THEN NULL ELSE 'A' || CAST(s.s_nationkey AS STRING) END AS userstopareacode,
       s.s_suppkey % 5 <> 0 AS getin,
       s.s_suppkey % 7 <> 0 AS getout,
       CASE WHEN s.s_suppkey % 11 = 0 THEN 'FINANCIAL' ELSE 'PASSENGER' END AS userstoptype
FROM (SELECT DISTINCT version, dataownercode, userstopcode FROM kv_pujopass) u
JOIN {supplier} s ON s.s_suppkey = CAST(substr(u.userstopcode, 2) AS BIGINT)""")

_view("kv_point", ("kv_pujopass",), """
SELECT u.version, u.dataownercode, u.userstopcode AS pointcode,
       CAST(20000 + (s.s_suppkey * 2500) % 250000 + u.version * 7 AS BIGINT) AS locationx_ew,
       CAST(310000 + (s.s_suppkey * 7919) % 300000 - u.version * 3 AS BIGINT) AS locationy_ns
FROM (SELECT DISTINCT version, dataownercode, userstopcode FROM kv_pujopass) u
JOIN {supplier} s ON s.s_suppkey = CAST(substr(u.userstopcode, 2) AS BIGINT)""")

_view("kv_usrstar", ("kv_usrstop",), """
SELECT a.version, a.dataownercode, a.userstopareacode, n.n_name AS name
FROM (SELECT DISTINCT version, dataownercode, userstopareacode FROM kv_usrstop
      WHERE userstopareacode IS NOT NULL) a
JOIN {nation} n ON n.n_nationkey = CAST(substr(a.userstopareacode, 2) AS INT)""")

# ---------------------------------------------------------------- lines and patterns
_view("kv_line", (), """
SELECT version, dataownercode, lineplanningnumber, linepublicnumber, linename, transporttype FROM (
  SELECT CAST(c_nationkey % 3 + 1 AS INT) AS version,
         CASE WHEN c_custkey % 2 = 0 THEN 'GVB' ELSE 'HTM' END AS dataownercode,
         CAST(c_custkey % 20 + 20 * CAST(floor(c_custkey / 100) AS BIGINT) AS STRING) AS lineplanningnumber,
         CAST(c_custkey % 20 + 20 * CAST(floor(c_custkey / 100) AS BIGINT) AS STRING) AS linepublicnumber,
         CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 20 + 20 * CAST(floor(c_custkey / 100) AS BIGINT) AS STRING) ELSE c_name END AS linename,
         CASE WHEN c_custkey % 13 = 0 THEN NULL
              WHEN c_mktsegment = 'AUTOMOBILE' THEN 'BUS' WHEN c_mktsegment = 'BUILDING' THEN 'TRAM'
              WHEN c_mktsegment = 'FURNITURE' THEN 'METRO' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'BOAT'
              ELSE 'TRAIN' END AS transporttype,
         row_number() OVER (PARTITION BY c_nationkey % 3, c_custkey % 20, floor(c_custkey / 100) ORDER BY c_custkey) AS rn
  FROM {customer}) x
WHERE rn = 1""")

_view("kv_jopa", ("kv_pujopass",), """
SELECT version, dataownercode, lineplanningnumber, journeypatterncode,
       'BUS' AS journeypatterntype,
       CAST(floor((CAST(journeypatterncode AS BIGINT) % 40) / 20) AS INT) + 1 AS direction
FROM (SELECT DISTINCT version, dataownercode, lineplanningnumber, journeypatterncode FROM kv_pujopass) x""")

# JOPATILI: the timing links of each pattern, taken from its first journey
_view("kv_jopatili", ("kv_pujopass",), """
SELECT p.version, p.dataownercode, p.lineplanningnumber, p.journeypatterncode,
       p.stoporder AS timinglinkorder,
       p.userstopcode AS userstopcodebegin,
       n.userstopcode AS userstopcodeend,
       'CF' || p.dataownercode AS confinrelcode,
       'D' || CAST((p.journeynumber + CASE WHEN p.stoporder > 3 THEN 1 ELSE 0 END) % 25 AS STRING) AS destcode,
       p.stoporder % 4 <> 0 AS istimingstop,
       CASE WHEN (p.journeynumber + p.stoporder) % 6 = 0 THEN 2
            WHEN (p.journeynumber + p.stoporder) % 6 = 1 THEN 18
            WHEN (p.journeynumber + p.stoporder) % 6 = 2 THEN 35
            WHEN (p.journeynumber + p.stoporder) % 6 = 3 THEN NULL
            ELSE 1 END AS productformulatype
FROM kv_pujopass p
JOIN (SELECT version, dataownercode, lineplanningnumber, journeypatterncode, min(journeynumber) AS journeynumber
      FROM kv_pujopass
      GROUP BY version, dataownercode, lineplanningnumber, journeypatterncode) r
  ON r.version = p.version AND r.dataownercode = p.dataownercode AND r.lineplanningnumber = p.lineplanningnumber
 AND r.journeypatterncode = p.journeypatterncode AND r.journeynumber = p.journeynumber
JOIN kv_pujopass n ON n.journeynumber = p.journeynumber AND n.stoporder = p.stoporder + 1""")

_view("kv_dest", ("kv_jopatili",), """
SELECT d.version, d.dataownercode, d.destcode, n.n_name AS destnamefull, n.n_name AS destnamemain
FROM (SELECT DISTINCT version, dataownercode, destcode FROM kv_jopatili) d
JOIN {nation} n ON n.n_nationkey = CAST(substr(d.destcode, 2) AS INT)""")

# POOL: points along each link (begin stop, one intermediate point, end stop), from the first journey that drives it
_view("kv_pool_link", ("kv_passing_s",), """
SELECT version, dataownercode, userstopcodebegin, userstopcodeend, CAST('2024-01-01' AS DATE) AS linkvalidfrom,
       transporttype, d, pk
FROM (
  SELECT *, row_number() OVER (PARTITION BY version, dataownercode, userstopcodebegin, userstopcodeend ORDER BY k) AS rn
  FROM (SELECT CAST(a.k % 3 + 1 AS INT) AS version,
               CASE WHEN a.k % 2 = 0 THEN 'GVB' ELSE 'HTM' END AS dataownercode,
               'S' || CAST(a.l_suppkey AS STRING) AS userstopcodebegin,
               'S' || CAST(b.l_suppkey AS STRING) AS userstopcodeend,
               CASE WHEN a.l_partkey % 2 = 0 THEN 'BUS' ELSE 'TRAM' END AS transporttype,
               CAST(100 + (a.l_partkey * 37 + b.l_partkey) % 1500 AS INT) AS d, a.l_partkey AS pk, a.k
        FROM kv_passing_s a JOIN kv_passing_s b ON b.k = a.k AND b.stoporder = a.stoporder + 1) x) f
WHERE rn = 1""")

_view("kv_pool", ("kv_pool_link",), """
SELECT version, dataownercode, userstopcodebegin, userstopcodeend, linkvalidfrom, dataownercode AS pointdataownercode,
       userstopcodebegin AS pointcode, 0 AS distancesincestartoflink, transporttype FROM kv_pool_link
UNION ALL
SELECT version, dataownercode, userstopcodebegin, userstopcodeend, linkvalidfrom, dataownercode,
       'P' || CAST(pk AS STRING), CAST(floor(d / 2) AS INT), transporttype FROM kv_pool_link
UNION ALL
SELECT version, dataownercode, userstopcodebegin, userstopcodeend, linkvalidfrom, dataownercode,
       userstopcodeend, d, transporttype FROM kv_pool_link""")

# every point a shape may pass: stop points plus the intermediate points (from part)
_view("kv_point_all", ("kv_point", "kv_pool_link"), """
SELECT version, dataownercode, pointcode, locationx_ew, locationy_ns FROM kv_point
UNION ALL
SELECT DISTINCT l.version, l.dataownercode, 'P' || CAST(p.p_partkey AS STRING) AS pointcode,
       CAST(30000 + (p.p_partkey * 3571) % 220000 AS BIGINT) AS locationx_ew,
       CAST(320000 + (p.p_partkey * 7717) % 280000 AS BIGINT) AS locationy_ns
FROM kv_pool_link l JOIN {part} p ON p.p_partkey = l.pk""")

# ---------------------------------------------------------------- drive-time world (calendar)
_view("kv_pujo", (), f"""
SELECT CAST(o_orderkey % 3 + 1 AS INT) AS version,
       CASE WHEN o_orderkey % 2 = 0 THEN 'GVB' ELSE 'HTM' END AS dataownercode,
       'TV' || CAST({_idiv('o_orderkey', 600)} AS STRING) AS timetableversioncode,
       'U' || CAST({_idiv('o_orderkey', 2)} % 2 AS STRING) AS organizationalunitcode,
       'PG' || CAST({_idiv('o_orderkey', 600)} AS STRING) || CASE WHEN o_orderkey % 4 < 3 THEN 'W' ELSE 'S' END
           AS periodgroupcode,
       CASE WHEN o_orderkey % 7 = 0 THEN 'SD' ELSE 'NORM' END AS specificdaycode,
       CASE WHEN o_orderpriority = '1-URGENT' THEN '12345' WHEN o_orderpriority = '2-HIGH' THEN '6'
            WHEN o_orderpriority = '3-MEDIUM' THEN '7' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '67'
            ELSE '1234567' END AS daytype,
       CAST(o_orderkey % 20 + 20 * CAST(floor(o_orderkey / 4000) AS BIGINT) AS STRING) AS lineplanningnumber,
       o_orderkey AS journeynumber,
       CAST(o_orderkey % 40 + 40 * CAST(floor(o_orderkey / 4000) AS BIGINT) AS STRING) AS journeypatterncode,
       CASE WHEN o_custkey % 3 = 0 THEN 'ACCESSIBLE' WHEN o_custkey % 3 = 1 THEN 'NOTACCESSIBLE' ELSE 'UNKNOWN' END
           AS wheelchairaccessible,
       o_orderstatus <> 'F' AS dataownerisoperator,
       CAST(o_orderdate AS DATE) AS orderdate
FROM {{orders}}""")

_view("kv_tive", ("kv_pujo",), """
SELECT version, dataownercode, organizationalunitcode, timetableversioncode, periodgroupcode, specificdaycode,
       min(orderdate) AS validfrom, 'NORMAL' AS timetableversiontype,
       CASE WHEN count(*) % 4 = 0 THEN min(orderdate) + 10 ELSE NULL END AS validthru
FROM kv_pujo
GROUP BY version, dataownercode, organizationalunitcode, timetableversioncode, periodgroupcode, specificdaycode""")

_view("kv_pegrval", ("kv_pujo",), """
SELECT version, dataownercode, organizationalunitcode, periodgroupcode,
       max(orderdate) - 40 AS validfrom,
       max(orderdate) - 40 + CAST(count(*) % 30 AS INT) AS validthru
FROM kv_pujo
GROUP BY version, dataownercode, organizationalunitcode, periodgroupcode""")

# EXCOPDAY: exception days, a few in a month, run as the weekday of their first digit
_view("kv_excopday", (), """
SELECT CAST(month(validdate) % 3 + 1 AS INT) AS version,
       CASE WHEN month(validdate) % 2 = 0 THEN 'GVB' ELSE 'HTM' END AS dataownercode,
       'U' || CAST(year(validdate) % 2 AS STRING) AS organizationalunitcode,
       validdate,
       CAST(((sc % 7) + 1) * 1000000 + sc % 100 AS INT) AS daytypeason,
       'SD' AS specificdaycode
FROM (SELECT CAST(o_orderdate AS DATE) AS validdate, sum(o_custkey) AS sc
      FROM {orders} GROUP BY CAST(o_orderdate AS DATE)) per_day
WHERE (sc + day(validdate)) % 12 = 0""")

# ---------------------------------------------------------------- PAS (metro/tram) world
_view("pas_stops", (), """
SELECT 'HA' || CAST(s_suppkey AS STRING) AS halteid,
       CASE WHEN s_suppkey % 13 = 0 THEN 'Remise ' || s_name WHEN s_suppkey % 17 = 0 THEN s_name || ' Garage'
            ELSE s_name END AS naam,
       CAST(CASE WHEN s_suppkey % 19 = 0 THEN 99999 ELSE 60000 + (s_suppkey * 613) % 40000 END AS BIGINT) AS x,
       CAST(430000 + (s_suppkey * 887) % 30000 AS BIGINT) AS y
FROM {supplier}""")

_view("pas_pujo", (), """
SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'M' WHEN o_orderpriority = '2-HIGH' THEN 'T'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'B' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'H' ELSE 'X' END
           AS modaliteit,
       'RET' AS vervoerdercode,
       lpad(CAST(o_orderkey % 60 AS STRING), 3, '0') AS lijnsysteemnr,
       CAST(o_orderkey % 2 + 1 AS INT) AS richting,
       CAST(o_orderkey AS STRING) AS ritnummer,
       lpad(CAST(o_custkey % 150 AS STRING), 5, '0') AS voetnoot
FROM {orders}""")

_view("pas_pujopass", ("kv_passing_s",), f"""
SELECT 'RET' AS vervoerdercode, lpad(CAST(k % 60 AS STRING), 3, '0') AS lijnsysteemnr, CAST(k % 2 + 1 AS INT) AS richting,
       CAST(k AS STRING) AS ritnummer, lpad(CAST(c.o_custkey % 150 AS STRING), 5, '0') AS voetnoot,
       stoporder AS stopsequentie, 'HA' || CAST(l_suppkey AS STRING) AS halteid,
       CASE WHEN stoporder = 1 THEN NULL ELSE {_hms('dep_s - stoporder * 5')} END AS aankomsttijd,
       CASE WHEN stoporder = nstops THEN NULL ELSE {_hms('dep_s')} END AS vertrektijd
FROM kv_passing_s JOIN {{orders}} c ON c.o_orderkey = k""")

_view("pas_voetnoot", (), """
SELECT DISTINCT lpad(CAST(user_id % 150 AS STRING), 5, '0') AS voetnoot, CAST(ts AS DATE) AS datum FROM {events}""")

# public line numbers for part of the line system numbers (the lookup CSV of a delivery)
_view("pas_linepublicnumber", (), """
SELECT DISTINCT lpad(CAST(o_orderkey % 60 AS STRING), 3, '0') AS lijnsysteemnr,
       CAST(o_orderkey % 60 AS STRING) || CASE WHEN o_orderkey % 60 > 40 THEN 'N' ELSE '' END AS linepublicnumber
FROM {orders} WHERE o_orderkey % 60 % 3 <> 0""")

# ---------------------------------------------------------------- IFF (rail) world
_view("iff_nstops", ("kv_passing_raw",), "SELECT k, CAST(count(*) AS INT) AS nstops FROM kv_passing_raw GROUP BY k")

_view("iff_service", ("iff_nstops",), """
SELECT CAST(o_orderkey AS INT) AS serviceid,
       CASE WHEN o_orderkey % 4 = 0 THEN 100 WHEN o_orderkey % 4 = 2 THEN 960 WHEN o_orderkey % 4 = 3 THEN 22
            ELSE CAST(2000 + o_custkey % 25 AS INT) END AS companynumber,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(NULLIF(o_orderkey % 5000, 0) AS INT) END AS servicenumber,
       CASE WHEN o_orderkey % 7 = 0 AND o_orderkey % 2 = 0 THEN CAST(o_custkey AS STRING)
            WHEN o_orderkey % 11 = 0 THEN CAST(o_custkey AS STRING) ELSE NULL END AS variant,
       1 AS firststop, n.nstops AS laststop,
       CASE WHEN o_orderkey % 6 = 0 THEN 'Sprinter ' || CAST(o_custkey % 10 AS STRING) ELSE NULL END AS servicename
FROM {orders} JOIN iff_nstops n ON n.k = o_orderkey""")

# the delivered companies: one a nation, and those that services of the fixed numbers run for
_view("iff_company", (), """
SELECT CAST(2000 + n_nationkey AS INT) AS company, 'n' || CAST(n_nationkey AS STRING) AS code, n_name AS name FROM {nation}
UNION ALL
SELECT CASE n_nationkey WHEN 0 THEN 100 WHEN 1 THEN 960 WHEN 2 THEN 22 WHEN 3 THEN 980 ELSE 300 END, 'c' || CAST(n_nationkey AS STRING),
       'Company of ' || n_name FROM {nation} WHERE n_nationkey < 5""")

# the delivered modes: all in use but one, which has no description
_view("iff_trnsmode", ("iff_transport",), """
SELECT DISTINCT transmode AS code, CASE WHEN transmode = 'ST' THEN 'stoptrein' ELSE 'Mode ' || transmode END AS description
FROM iff_transport WHERE transmode <> 'HSN'""")

_view("iff_transport", ("iff_nstops",), """
SELECT serviceid, transmode, firststop, laststop FROM (
  SELECT CAST(o_orderkey AS INT) AS serviceid,
         CASE CAST(floor(o_orderkey / 4) AS BIGINT) % 20 WHEN 0 THEN 'IC' WHEN 1 THEN 'SPR' WHEN 2 THEN 'ICE' WHEN 3 THEN 'INT' WHEN 4 THEN 'ST' WHEN 5 THEN 'B' WHEN 6 THEN 'NSS'
              WHEN 7 THEN 'NST' WHEN 8 THEN 'NSM' WHEN 9 THEN 'BNS' WHEN 10 THEN 'TGV' WHEN 11 THEN 'THA' WHEN 12 THEN 'ES' WHEN 13 THEN 'HSN'
              WHEN 14 THEN 'EC' WHEN 15 THEN 'EN' WHEN 16 THEN 'S' WHEN 17 THEN 'NSB' WHEN 18 THEN 'X' ELSE 'U' END AS transmode,
         1 AS firststop,
         CASE WHEN o_orderkey % 10 = 0 AND n.nstops >= 4 THEN CAST(floor(n.nstops / 2) AS INT) ELSE n.nstops END AS laststop
  FROM {orders} JOIN iff_nstops n ON n.k = o_orderkey
  UNION ALL
  SELECT CAST(o_orderkey AS INT), 'B', CAST(floor(n.nstops / 2) AS INT), n.nstops
  FROM {orders} JOIN iff_nstops n ON n.k = o_orderkey WHERE o_orderkey % 10 = 0 AND n.nstops >= 4) x""")

_view("iff_validity", ("iff_nstops",), """
SELECT CAST(o_orderkey AS INT) AS serviceid, CAST(o_custkey % 150 AS INT) AS footnote,
       CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE NULL END AS firststop,
       CASE WHEN o_orderkey % 3 = 0 THEN n.nstops ELSE 999 END AS laststop
FROM {orders} JOIN iff_nstops n ON n.k = o_orderkey""")

_view("iff_attribute", ("kv_passing_raw", "iff_nstops"), """
SELECT CAST(k AS INT) AS serviceid, CASE WHEN l_returnflag = 'R' THEN 'NIIN' ELSE 'NUIT' END AS code,
       stoporder AS firststop, stoporder AS laststop
FROM kv_passing_raw WHERE (l_returnflag = 'R' AND l_linenumber = 3) OR (l_returnflag = 'A' AND l_linenumber = 2)
UNION ALL
SELECT CAST(k AS INT), 'IRES', stoporder, stoporder + 1 FROM kv_passing_raw WHERE l_linestatus = 'F' AND l_linenumber = 4
UNION ALL
SELECT CAST(k AS INT), 'GEFI', 1, nstops FROM iff_nstops WHERE k % 9 = 0""")

_view("iff_stop", ("kv_passing_s",), """
SELECT CAST(k AS INT) AS serviceid, stoporder AS idx, 's' || CAST(l_suppkey AS STRING) AS station,
       CASE WHEN stoporder = 1 THEN NULL ELSE
         lpad(CAST(CAST(floor((dep_s - stoporder * 5) / 3600) AS BIGINT) AS STRING), 2, '0') || ':' ||
         lpad(CAST(CAST(floor((dep_s - stoporder * 5) / 60) AS BIGINT) % 60 AS STRING), 2, '0') || ':00' END AS arrivaltime,
       CASE WHEN stoporder = nstops THEN NULL ELSE
         lpad(CAST(CAST(floor(dep_s / 3600) AS BIGINT) AS STRING), 2, '0') || ':' ||
         lpad(CAST(CAST(floor(dep_s / 60) AS BIGINT) % 60 AS STRING), 2, '0') || ':00' END AS departuretime
FROM kv_passing_s""")

_view("iff_platform", ("kv_passing_raw",), """
SELECT CAST(k AS INT) AS serviceid, stoporder AS idx, 's' || CAST(l_suppkey AS STRING) AS station,
       CAST(l_partkey % 4 + 1 AS STRING) || CASE WHEN l_partkey % 8 < 4 THEN 'a' ELSE 'b' END AS arrival,
       CASE WHEN l_partkey % 5 = 0 THEN CAST((l_partkey + 1) % 4 + 1 AS STRING) || 'a'
            ELSE CAST(l_partkey % 4 + 1 AS STRING) || CASE WHEN l_partkey % 8 < 4 THEN 'a' ELSE 'b' END END AS departure,
       1 AS footnote
FROM kv_passing_raw WHERE l_partkey % 3 <> 0""")

_view("iff_station", (), """
SELECT 's' || CAST(s_suppkey AS STRING) AS shortname, CAST(NULLIF(s_suppkey % 4, 0) AS INT) AS trainchanges,
       CAST((s_suppkey % 5 + 1) * 60 AS INT) AS layovertime,
       CASE WHEN s_nationkey = 23 THEN 'GB' ELSE 'NL' END AS country,
       CASE WHEN s_nationkey = 23 THEN 1 ELSE NULL END AS timezone,
       CASE WHEN s_suppkey % 23 = 0 THEN NULL ELSE CAST(20000 + (s_suppkey * 2500) % 250000 AS BIGINT) END AS x,
       CASE WHEN s_suppkey % 23 = 0 THEN NULL ELSE CAST(310000 + (s_suppkey * 7919) % 300000 AS BIGINT) END AS y,
       s_name AS name
FROM {supplier}""")

# connections offered between consecutive services calling at a station (blocks of 1000 journeys)
_view("iff_changes", ("kv_passing_raw",), """
SELECT station, fromservice, toservice, possiblechange FROM (
  SELECT 's' || CAST(l_suppkey AS STRING) AS station, CAST(k AS INT) AS fromservice,
         CAST(lead(k) OVER (PARTITION BY l_suppkey, CAST(floor(k / 1000) AS BIGINT) ORDER BY k, stoporder) AS INT) AS toservice,
         CAST(k % 3 AS INT) AS possiblechange
  FROM kv_passing_raw) x
WHERE toservice IS NOT NULL AND toservice <> fromservice""")

_view("iff_footnote", (), """
SELECT DISTINCT CAST(user_id % 150 AS INT) AS footnote, CAST(ts AS DATE) AS servicedate FROM {events}""")

_view("iff_delivery", ("iff_footnote",), """
SELECT 100 AS company, min(servicedate) AS firstday, max(servicedate) AS lastday, 1 AS versionnumber,
       'derived' AS description FROM iff_footnote""")

# ---------------------------------------------------------------- footnotes (IFF/PAS validity bits)
# one footnote per user: a 30-character day string from 2024-01-01, '1' where the user was active
_view("kv_footnote_days", (), """
SELECT DISTINCT user_id AS footnote, CAST(ts AS DATE) AS servicedate FROM {events}""")


# ---------------------------------------------------------------- the same rows for less work, on Spark only
# Views that join passings with themselves, or sort them twice: here each journey's passings are sorted once, and what
# the next passing has is read in that order.  The oracle keeps the texts above.
SPARK_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}

_ROWS = "PARTITION BY k ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


def _passings(rows: str) -> str:
    """Passings of lineitem's `rows`, as `kv_passing_s` has them, with the stop and part of the next one."""
    return f"""
SELECT k, l_suppkey, l_partkey, l_linenumber, l_returnflag, l_linestatus, stoporder, drive,
       CAST((k % 27) * 3600 + sum(drive) OVER ({_ROWS} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS dep_s,
       CAST(count(*) OVER (PARTITION BY k) AS INT) AS nstops,
       lead(l_suppkey) OVER ({_ROWS}) AS next_suppkey, lead(l_partkey) OVER ({_ROWS}) AS next_partkey
FROM (SELECT *, CASE WHEN d0 % 9 = 0 THEN 0 ELSE 60 + d0 % 240 END AS drive
      FROM (SELECT *, (k % 40) * 7 + stoporder * 13 + ({_idiv('k', 40)} % 3) * 30 AS d0
            FROM (SELECT *, CAST(row_number() OVER ({_ROWS}) AS INT) AS stoporder FROM ({rows}) r) n) x) t"""


# {many}: a hint on the partitions that the lines of a large table meet in (see World.parts)
_LINES = """SELECT {many} l_orderkey AS k, l_suppkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
  l_returnflag, l_linestatus, l_shipdate FROM {lineitem}"""
SPARK_VIEWS["kv_passing_s"] = ((), _passings(_LINES))

SPARK_VIEWS["kv_link"] = (("kv_passing_s",), """
SELECT CAST(k % 3 + 1 AS INT) AS version,
       'S' || CAST(l_suppkey AS STRING) AS userstopcodebegin,
       'S' || CAST(next_suppkey AS STRING) AS userstopcodeend,
       CAST(CASE WHEN l_partkey % 17 = 0 THEN 0 ELSE 50 + (l_partkey * 37 + next_partkey) % 1500 END AS INT) AS distance
FROM kv_passing_s WHERE stoporder < nstops AND k IS NOT NULL""")

# Links need of a passing its stop and part alone.  Lines alike in number, part and stop are alike there, whichever comes first,
# so the other columns that put lines in order are neither read nor shuffled for them.
_CALLS = "PARTITION BY k ORDER BY l_linenumber, l_partkey, l_suppkey"
_CALLED = "SELECT {many} l_orderkey AS k, l_suppkey, l_partkey, l_linenumber FROM {lineitem}"


def _links(rows: str) -> str:
    """Links between passings of lineitem's `rows`: stop and part of a passing and of the next one."""
    return f"""
SELECT * FROM (
  SELECT k, l_suppkey, l_partkey, CAST(row_number() OVER ({_CALLS}) AS INT) AS stoporder, lead(k) OVER ({_CALLS}) AS next_k,
         lead(l_suppkey) OVER ({_CALLS}) AS next_suppkey, lead(l_partkey) OVER ({_CALLS}) AS next_partkey
  FROM ({rows}) r) n
WHERE next_k IS NOT NULL"""


SPARK_VIEWS["kv_passing_link"] = ((), _links(_CALLED))

# a pattern is known by numbers here; only its first journey's lines are put in order
_PATTERN = f"k % 3, k % 2 = 0, k % 20 + 20 * {_idiv('k', 4000)}, k % 40 + 40 * {_idiv('k', 4000)}"
SPARK_VIEWS["kv_pattern_first"] = ((), f"SELECT min(k) AS k FROM (SELECT l_orderkey AS k FROM {{lineitem}}) o GROUP BY {_PATTERN}")
# {few}: a hint that goes along while the patterns are few (see World.few), so that the lines of the others are never shuffled
SPARK_VIEWS["kv_pattern_link"] = (("kv_pattern_first",), _links(f"""SELECT {{few}} l.* FROM ({_CALLED.replace("{many} ", "")}) l
  LEFT SEMI JOIN kv_pattern_first f ON f.k = l.k"""))

SPARK_VIEWS["kv_jopatili"] = (("kv_pattern_link",), f"""
SELECT CAST(k % 3 + 1 AS INT) AS version,
       CASE WHEN k % 2 = 0 THEN 'GVB' ELSE 'HTM' END AS dataownercode,
       CAST(k % 20 + 20 * CAST(floor(k / 4000) AS BIGINT) AS STRING) AS lineplanningnumber,
       CAST(k % 40 + 40 * CAST(floor(k / 4000) AS BIGINT) AS STRING) AS journeypatterncode,
       stoporder AS timinglinkorder,
       'S' || CAST(l_suppkey AS STRING) AS userstopcodebegin,
       'S' || CAST(next_suppkey AS STRING) AS userstopcodeend,
       'CF' || CASE WHEN k % 2 = 0 THEN 'GVB' ELSE 'HTM' END AS confinrelcode,
       'D' || CAST((k + CASE WHEN stoporder > 3 THEN 1 ELSE 0 END) % 25 AS STRING) AS destcode,
       stoporder % 4 <> 0 AS istimingstop,
       CASE WHEN (k + stoporder) % 6 = 0 THEN 2
            WHEN (k + stoporder) % 6 = 1 THEN 18
            WHEN (k + stoporder) % 6 = 2 THEN 35
            WHEN (k + stoporder) % 6 = 3 THEN NULL
            ELSE 1 END AS productformulatype
FROM kv_pattern_link""")

# Pool and points both read the first journeys of all links: they need the same columns of them, and the filter on rn is one
# that Spark moves no other past (spark_partition_id() is never below 0), so links are put in order and shuffled once for both.
SPARK_VIEWS["kv_pool_link"] = (("kv_passing_link",), """
SELECT version, dataownercode, userstopcodebegin, userstopcodeend, CAST('2024-01-01' AS DATE) AS linkvalidfrom,
       CASE WHEN l_partkey % 2 = 0 THEN 'BUS' ELSE 'TRAM' END AS transporttype,
       CAST(100 + (l_partkey * 37 + next_partkey) % 1500 AS INT) AS d, l_partkey AS pk
FROM (
  SELECT *, row_number() OVER (PARTITION BY userstopcodebegin, userstopcodeend, version, dataownercode
                               ORDER BY k, stoporder, l_partkey, next_partkey) AS rn
  FROM (SELECT CAST(k % 3 + 1 AS INT) AS version,
               CASE WHEN k % 2 = 0 THEN 'GVB' ELSE 'HTM' END AS dataownercode,
               'S' || CAST(l_suppkey AS STRING) AS userstopcodebegin,
               'S' || CAST(next_suppkey AS STRING) AS userstopcodeend,
               k, stoporder, l_partkey, next_partkey
        FROM kv_passing_link) x) f
WHERE rn = 1 AND spark_partition_id() >= 0""")

# the three points of a link from one row of it (inline, below which Spark moves joins that only pick links)
SPARK_VIEWS["kv_pool"] = (("kv_pool_link",), """
SELECT version, dataownercode, userstopcodebegin, userstopcodeend, linkvalidfrom, dataownercode AS pointdataownercode,
       code AS pointcode, at AS distancesincestartoflink, transporttype
FROM kv_pool_link LATERAL VIEW inline(array(
  named_struct('code', userstopcodebegin, 'at', 0), named_struct('code', 'P' || CAST(pk AS STRING), 'at', CAST(floor(d / 2) AS INT)),
  named_struct('code', userstopcodeend, 'at', d))) p AS code, at""")

# a part is looked up once for each version and owner, however many links pass it
SPARK_VIEWS["kv_point_all"] = (("kv_point", "kv_pool_link"), """
SELECT version, dataownercode, pointcode, locationx_ew, locationy_ns FROM kv_point
UNION ALL
SELECT l.version, l.dataownercode, 'P' || CAST(p.p_partkey AS STRING) AS pointcode,
       CAST(30000 + (p.p_partkey * 3571) % 220000 AS BIGINT) AS locationx_ew,
       CAST(320000 + (p.p_partkey * 7717) % 280000 AS BIGINT) AS locationy_ns
FROM (SELECT DISTINCT version, dataownercode, pk FROM kv_pool_link) l
JOIN (SELECT DISTINCT p_partkey FROM {part}) p ON p.p_partkey = l.pk""")

# the stops called at need no order of passings
SPARK_VIEWS["kv_called"] = ((), """
SELECT CAST(v + 1 AS INT) AS version, CASE WHEN even THEN 'GVB' ELSE 'HTM' END AS dataownercode, 'S' || CAST(l_suppkey AS STRING) AS userstopcode
FROM (SELECT DISTINCT l_orderkey % 3 AS v, coalesce(l_orderkey % 2 = 0, false) AS even, l_suppkey FROM {lineitem}) n""")
for _name in ("kv_usrstop", "kv_point"):
    SPARK_VIEWS[_name] = (("kv_called",), VIEWS[_name][1].replace("(SELECT DISTINCT version, dataownercode, userstopcode FROM kv_pujopass)", "kv_called"))


def with_clause(names, tables: dict[str, str]) -> str:
    """A WITH clause holding ``names`` and their dependencies in order."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in VIEWS[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = []
    for n in order:
        body = VIEWS[n][1]
        body = re.sub(r"\{(\w+)\}", lambda m: tables[m.group(1)], body)
        parts.append(f"{n} AS ({body}\n)")
    return "WITH " + ",\n".join(parts) + "\n"


def duckdb_tables() -> dict[str, str]:
    return {t: t for t in BASE_TABLES}


def spark_tables(sf_dir: str) -> dict[str, str]:
    return {t: f"parquet.`{os.path.join(sf_dir, t + '.parquet')}`" for t in BASE_TABLES}


def spark_view(spark, sf_dir: str, name: str):
    """The view as a Spark DataFrame over the parquet files of ``sf_dir``."""
    return spark.sql(with_clause([name], spark_tables(sf_dir)) + f"SELECT * FROM {name}")


def oracle(names, query: str) -> str:
    """DuckDB SQL: the views named, then ``query``."""
    return with_clause(names, duckdb_tables()) + query


_WORLDS: dict = {}

#: Rows of a large table that one task puts in order, about.
ROWS = 250_000
#: Numbers that go to every task at most (32 MB).
FEW = 4_000_000


class World:
    """Lazy accessor: ``World(spark, sf_dir).kv_pujopass`` -> DataFrame.

    Each view is planned once per (session, folder) over its dependencies.
    Nothing is persisted: every query derives what it needs from Parquet, and
    a plan that reads a view several times reuses its exchanges.
    """

    def __new__(cls, spark, sf_dir: str):
        k = (id(spark), os.path.abspath(sf_dir))
        w = _WORLDS.get(k)
        if w is None:
            w = super().__new__(cls)
            w.spark, w.sf_dir = spark, sf_dir
            w._cache = {}
            w._prefix = f"__w{len(_WORLDS)}_"
            _WORLDS[k] = w
        return w

    def __init__(self, spark, sf_dir: str):
        pass

    def view(self, name: str):
        if name not in self._cache:
            deps, body = SPARK_VIEWS.get(name) or VIEWS[name]
            for d in deps:
                self.view(d)
            tables = spark_tables(self.sf_dir)
            if "{many}" in body:
                n = self.parts("lineitem")
                tables["many"] = f"/*+ REPARTITION({n}, k) */" if n else ""
            if "{few}" in body:
                tables["few"] = "/*+ BROADCAST(f) */" if self.few(deps[0]) else ""
            sql = re.sub(r"\{(\w+)\}", lambda m: tables[m.group(1)], body)
            for d in sorted(deps, key=len, reverse=True):
                sql = re.sub(rf"\b{d}\b", self._prefix + d, sql)
            df = self.spark.sql(sql)
            df.createOrReplaceTempView(self._prefix + name)
            self._cache[name] = df
        return self._cache[name]

    def parts(self, name: str) -> int | None:
        """How many partitions the rows of a table should meet in; None: the session's number will do.

        The work of a task is bounded by its rows (ROWS): beyond that, there are more tasks, not larger ones.
        """
        n = -(-self.memo(f"rows of {name}", lambda: self.table(name).count()) // ROWS)
        return n if n > self.spark.sparkContext.defaultParallelism else None

    def few(self, view: str) -> bool:
        """Whether a view of one number has so few rows (FEW) that each task may hold them."""
        return self.memo(f"rows of {view}", lambda: self.view(view).count()) <= FEW

    def memo(self, name: str, build):
        """The plan of a derived result, built once per world."""
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    def __getattr__(self, name):
        if name in VIEWS:
            return self.view(name)
        raise AttributeError(name)

    def table(self, name: str):
        from gtfsforge.session import read_table

        return read_table(self.spark, self.sf_dir, name)
