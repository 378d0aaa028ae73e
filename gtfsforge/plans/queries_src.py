"""Registered queries: tagged-line parsing round trips (IFF timetable).

The tagged lines are derived by Spark from the passings (one block per
journey, positions ``journey * 1000 + k`` inside one file per version), so
the parser's work grows with lineitem; the oracle is the passings
themselves, projected the way the parser must give them back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gtfsforge import files
from gtfsforge.plans.registry import register
from gtfsforge.plans.views import World, oracle
from gtfsforge.session import ensure_checkpoint_dir
from gtfsforge.sources import archives, kv1, tagged

PLAN_AS_OF = "1998-07-01"


def iff_lines(w: World):
    """IFF timetable lines of every journey: each passing is turned into its lines at once."""
    p = w.kv_pujopass
    n = F.count(F.lit(1)).over(Window.partitionBy("journeynumber"))
    p = p.withColumn("nstops", n)
    base = F.col("journeynumber") * 1000
    first = F.col("stoporder") == 1

    def hm(c):
        return F.concat(F.substring(c, 1, 2), F.substring(c, 4, 2))

    def line(pos, tag, body):
        return F.struct(pos.alias("pos"), tag.alias("tag"), body.alias("body"))

    header = line(base, F.lit("#"), F.lpad(F.col("journeynumber").cast("string"), 8, "0"))
    service = line(base + 1, F.lit("%"), F.concat(
        F.lit("100,"), F.lpad((F.col("journeynumber") % 100000).cast("string"), 5, "0"), F.lit(",      ,001,"),
        F.lpad(F.col("nstops").cast("string"), 3, "0"), F.lit(",")))
    validity = line(base + 2, F.lit("-"), F.lit("00001,000,999"))
    arr, dep = F.col("targetarrivaltime"), F.col("targetdeparturetime")
    tag = (F.when(first, ">").when(F.col("stoporder") == F.col("nstops"), "<")
           .when(hm(arr) == hm(dep), ".").otherwise("+"))
    stop = F.rpad(F.col("userstopcode"), 7, " ")
    body = (F.when(tag == ">", F.concat(stop, F.lit(","), F.coalesce(hm(dep), F.lit(""))))
            .when(tag == "<", F.concat(stop, F.lit(","), hm(arr)))
            .when(tag == ".", F.concat(stop, F.lit(","), hm(arr)))
            .otherwise(F.concat(stop, F.lit(","), hm(arr), F.lit(","), hm(dep))))
    call = line(base + F.col("stoporder") * 10, tag, body)
    platform = line(base + F.col("stoporder") * 10 + 1, F.lit("?"), F.concat(
        F.lit("A"), (F.col("stoporder") % 5).cast("string"), F.lit(" ,"),
        F.when(F.col("journeynumber") % 4 == 0, "B").otherwise("A"), (F.col("stoporder") % 5).cast("string"), F.lit(" ,00001")))
    lines = F.array(F.when(first, header), F.when(first, service), F.when(first, validity), call, F.when(F.col("stoporder") % 3 == 0, platform))
    file = F.concat(F.lit("timetbls_v"), F.col("version").cast("string"))
    return p.select(file.alias("file"), F.explode(F.filter(lines, lambda x: x.isNotNull())).alias("x")).select("file", "x.*")


def _iff(w: World):
    t = tagged.iff_timetable(iff_lines(w))
    return tuple(t[k].drop("file") for k in ("service", "validity", "stop", "platform"))


SQL_STOPS = """
, n AS (SELECT journeynumber, count(*) AS nstops FROM kv_pujopass GROUP BY journeynumber)
, s AS (SELECT p.*, n.nstops,
          CASE WHEN p.stoporder = 1 THEN '>' WHEN p.stoporder = n.nstops THEN '<'
               WHEN substr(p.targetarrivaltime, 1, 5) = substr(p.targetdeparturetime, 1, 5) THEN '.' ELSE '+' END AS tag
        FROM kv_pujopass p JOIN n USING (journeynumber))
"""


@register("src_iff_stops_s11", oracle(["kv_pujopass"], SQL_STOPS + """
SELECT CAST(journeynumber AS INTEGER) AS serviceid, CAST(stoporder AS INTEGER) AS idx, userstopcode AS station,
       CASE WHEN tag IN ('.', '+', '<') THEN substr(targetarrivaltime, 1, 5) || ':00' END AS arrivaltime,
       CASE WHEN tag IN ('>', '+') THEN substr(targetdeparturetime, 1, 5) || ':00'
            WHEN tag = '.' THEN substr(targetarrivaltime, 1, 5) || ':00' END AS departuretime
FROM s"""))
def q_iff_stops(spark, sf):
    return _iff(World(spark, sf))[2]


@register("src_iff_service_s11", oracle(["kv_pujopass"], """
SELECT CAST(journeynumber AS INTEGER) AS serviceid, 100 AS companynumber,
       CAST(NULLIF(journeynumber % 100000, 0) AS INTEGER) AS servicenumber, CAST(NULL AS VARCHAR) AS variant,
       1 AS firststop, CAST(count(*) AS INTEGER) AS laststop, CAST(NULL AS VARCHAR) AS servicename
FROM kv_pujopass GROUP BY journeynumber"""))
def q_iff_service(spark, sf):
    return _iff(World(spark, sf))[0]


@register("src_iff_platform_s11", oracle(["kv_pujopass"], """
SELECT CAST(journeynumber AS INTEGER) AS serviceid, CAST(stoporder AS INTEGER) AS idx,
       'A' || CAST(stoporder % 5 AS VARCHAR) AS arrival,
       CASE WHEN journeynumber % 4 = 0 THEN 'B' ELSE 'A' END || CAST(stoporder % 5 AS VARCHAR) AS departure,
       1 AS footnote, userstopcode AS station
FROM kv_pujopass WHERE stoporder % 3 = 0"""))
def q_iff_platform(spark, sf):
    return _iff(World(spark, sf))[3]


@register("dq_platform_q5", oracle(["kv_pujopass"], """
SELECT CAST(journeynumber AS INTEGER) AS serviceid, CAST(stoporder AS INTEGER) AS idx,
       'A' || CAST(stoporder % 5 AS VARCHAR) AS arrival, 'B' || CAST(stoporder % 5 AS VARCHAR) AS departure,
       1 AS footnote, userstopcode AS station
FROM kv_pujopass WHERE stoporder % 3 = 0 AND journeynumber % 4 = 0"""))
def q_dq_platform(spark, sf):
    from gtfsforge.operators.quality import platform_mismatch

    return platform_mismatch(_iff(World(spark, sf))[3])


# ---------------------------------------------------------------- grouped IFF files (changes, footnotes) round trip
def changes_lines(w: World):
    """IFF ``changes`` file text from the connections: one ``#station`` block per station and block of journeys."""
    c = w.iff_changes
    # block position: station number * 10^9 + a running number within the station
    sid = F.substring("station", 2, 20).cast("long")
    w_in = Window.partitionBy("station").orderBy("fromservice", "toservice")
    det = c.select(F.lit("changes").alias("file"),
                   (sid * 1_000_000_000 + F.row_number().over(w_in)).alias("pos"),
                   F.lit("-").alias("tag"),
                   F.concat_ws(",", F.format_string("%05d", F.col("fromservice")), F.format_string("%05d", F.col("toservice")),
                               F.col("possiblechange").cast("string")).alias("body"))
    head = c.select("station").distinct().select(F.lit("changes").alias("file"),
                                                  (F.substring("station", 2, 20).cast("long") * 1_000_000_000).alias("pos"),
                                                  F.lit("#").alias("tag"), F.col("station").alias("body"))
    return head.unionByName(det)


@register("src_iff_changes_s13", oracle(["iff_changes"], "SELECT station, fromservice, toservice, possiblechange FROM iff_changes"))
def q_iff_changes(spark, sf):
    return tagged.iff_groups(changes_lines(World(spark, sf)), "changes")


def footnote_lines(w: World):
    """IFF ``footnote`` file text: ``#id`` then the day bits from the delivery's first day."""
    from gtfsforge.operators.calendar import footnote_bits

    days = w.iff_footnote
    first = w.iff_delivery.select(F.col("firstday").alias("first"), (F.datediff("lastday", "firstday") + 1).alias("n"))
    d = days.withColumn("first", first.select("first").scalar()).withColumn("n", first.select("n").scalar())
    bits = footnote_bits(d, "footnote", "servicedate", F.col("first"), F.col("n"))
    head = bits.select(F.lit("footnote").alias("file"), (F.col("footnote").cast("long") * 2).alias("pos"),
                       F.lit("#").alias("tag"), F.format_string("%05d", "footnote").alias("body"))
    det = bits.select(F.lit("footnote").alias("file"), (F.col("footnote").cast("long") * 2 + 1).alias("pos"),
                      F.substring("bits", 1, 1).alias("tag"), F.expr("substring(bits, 2)").alias("body"))
    return head.unionByName(det)


@register("src_iff_footnotes_s15", oracle(["iff_footnote"], "SELECT footnote, servicedate FROM iff_footnote"))
def q_iff_footnotes(spark, sf):
    w = World(spark, sf)
    first = w.iff_delivery.select("firstday").scalar()
    return tagged.iff_groups(footnote_lines(w), "footnote", firstday=first)


def pas_footnote_lines(w: World):
    """PAS footnote file text: one ``@id,bits`` line for each footnote, a bit for each day from the first one."""
    from gtfsforge.operators.calendar import footnote_bits

    first = w.pas_voetnoot.agg(F.min("datum").alias("a"), (F.datediff(F.max("datum"), F.min("datum")) + 1).alias("n"))
    d = w.pas_voetnoot.withColumn("first", first.select("a").scalar()).withColumn("n", first.select("n").scalar())
    bits = footnote_bits(d, "voetnoot", "datum", F.col("first"), F.col("n"))
    return bits.select(F.lit("RET.VTN").alias("file"), F.col("voetnoot").cast("long").alias("pos"), F.lit("@").alias("tag"),
                       F.concat("voetnoot", F.lit(","), "bits").alias("body"))


@register("src_pas_footnotes_s15", oracle(["pas_voetnoot"], "SELECT voetnoot, datum FROM pas_voetnoot"))
def q_pas_footnotes(spark, sf):
    w = World(spark, sf)
    first = w.pas_voetnoot.agg(F.min("datum").alias("a")).scalar()
    return tagged.pas_footnotes(pas_footnote_lines(w), first)


# ---------------------------------------------------------------- O-S1, S2, S3: KV1 lines
# names and types in file order
KV1_PASSING = {
    "tablename": "string", "version": "integer", "implicit": "string", "dataownercode": "string", "organizationalunitcode": "string", "schedulecode": "string",
    "scheduletypecode": "string", "lineplanningnumber": "string", "journeynumber": "long", "stoporder": "integer", "remark": "string", "userstopcode": "string",
    "targetarrivaltime": "string", "targetdeparturetime": "string", "wheelchairaccessible": "string", "dataownerisoperator": "boolean", "passedon": "date",
}


def _passing_schema() -> StructType:
    out = StructType()
    for name, kind in KV1_PASSING.items():
        out = out.add(name, kind)
    return out


def kv1_lines(w: World):
    """Lines of a delivery folder for each version: passings with quoted remarks, a header, another table, and lines that don't parse."""
    p = w.kv_pujopass
    quoted = F.concat(F.lit('"'), "journeypatterncode", F.lit('|a ""b"""'))
    order = F.when((F.col("journeynumber") % 89 == 0) & (F.col("stoporder") == 2), F.lit("x2")).otherwise(F.col("stoporder").cast("string"))
    names = ["version", "dataownercode", "organizationalunitcode", "schedulecode", "scheduletypecode", "lineplanningnumber", "journeynumber"]
    lead = [F.lit("PUJOPASS"), F.col("version").cast("string"), F.lit("I"), *[F.col(c).cast("string") for c in names[1:]]]
    tail = [order, quoted, F.concat(F.lit(" "), "userstopcode", F.lit(" ")), "targetarrivaltime", "targetdeparturetime", "wheelchairaccessible", F.lit("true"), F.lit("")]
    whole = F.array_join(F.array(*lead, *tail), "|", "")
    line = F.when((F.col("journeynumber") % 97 == 0) & (F.col("stoporder") == 1), F.array_join(F.array(*lead[:5]), "|", "")).otherwise(whole)
    folder = F.concat(F.lit("in/v"), F.col("version").cast("string"))
    # a passing's lines are written in one go, and no filter on a line writes it again
    mine = F.struct(F.concat(folder, F.lit("/PUJOPASSX.TMI")).alias("file"), (F.col("journeynumber") * 1000 + F.col("stoporder")).alias("pos"), line.alias("line"))
    other = F.struct(F.concat(folder, F.lit("/DESTX.csv")).alias("file"), F.col("journeynumber").alias("pos"), F.lit("DEST|1|I|GVB").alias("line"))
    rows = p.select(F.explode(F.when(F.col("stoporder") == 1, F.array(mine, other)).otherwise(F.array(mine))).alias("x")).select("x.*")
    heads = p.select("version").distinct().select(F.concat(folder, F.lit("/PUJOPASSX.TMI")).alias("file"), F.lit(0).cast("long").alias("pos"), F.lit("Tablename|Version_Number|Implicit").alias("line"))
    return rows.unionByName(heads)


@register("src_kv1_lines_s1", oracle(["kv_pujopass"], """
SELECT 'in/v' || version || '/PUJOPASSX.TMI' AS file, journeynumber * 1000 + stoporder AS pos, 'PUJOPASS' AS tablename, version, 'I' AS implicit, dataownercode,
       organizationalunitcode, schedulecode, scheduletypecode, lineplanningnumber, journeynumber, stoporder, journeypatterncode || '|a "b"' AS remark, userstopcode,
       targetarrivaltime, targetdeparturetime, wheelchairaccessible, dataownerisoperator, CAST(NULL AS DATE) AS passedon
FROM kv_pujopass WHERE NOT (stoporder = 1 AND journeynumber % 97 = 0) AND NOT (stoporder = 2 AND journeynumber % 89 = 0)"""))
def q_kv1_lines(spark, sf):
    return kv1.parse_lines(kv1_lines(World(spark, sf)), "pujopass", _passing_schema())[0]


@register("src_kv1_bad_lines_s2", oracle(["kv_pujopass"], """
SELECT 'in/v' || version || '/PUJOPASSX.TMI' AS file, journeynumber * 1000 + stoporder AS pos, if(stoporder = 1, 'fields', 'stoporder') AS reason
FROM kv_pujopass WHERE (stoporder = 1 AND journeynumber % 97 = 0) OR (stoporder = 2 AND journeynumber % 89 = 0)"""))
def q_kv1_bad_lines(spark, sf):
    return kv1.parse_lines(kv1_lines(World(spark, sf)), "pujopass", _passing_schema())[1].drop("line")


# ---------------------------------------------------------------- O-S4: archives
def archived_lines(w: World):
    """Passings as members of archives, a line each, the even journeys in an archive within the archive."""
    p = w.kv_pujopass
    archive = F.concat(F.lit("v"), F.col("version").cast("string"), F.lit("_"), (F.col("journeynumber") % 23).cast("string"), F.lit(".zip!/"))
    inner = F.when(F.col("journeynumber") % 2 == 0, "Csv.zip!/in/").otherwise("")
    line = F.concat_ws("|", F.lit("PUJOPASS"), F.col("version").cast("string"), F.lit("I"), F.col("journeynumber").cast("string"), F.col("stoporder").cast("string"), "userstopcode")
    return p.select(F.concat(archive, inner, F.lit("PUJOPASSX.TMI")).alias("file"), (F.col("journeynumber") * 1000 + F.col("stoporder")).alias("pos"), line.alias("line"))


@register("src_archives_s4", oracle(["kv_pujopass"], """
, f AS (SELECT *, 'v' || version || '_' || journeynumber % 23 || '.zip!/' || if(journeynumber % 2 = 0, 'Csv.zip!/in/', '') || 'PUJOPASSX.TMI' AS file FROM kv_pujopass)
SELECT file, row_number() OVER (PARTITION BY file ORDER BY journeynumber, stoporder) - 1 AS pos, version, journeynumber, stoporder, userstopcode FROM f"""))
def q_archives(spark, sf):
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/archives-{uuid.uuid4().hex}"
    files.make(spark, folder)
    archives.pack_archives(archived_lines(World(spark, sf)), folder)
    schema = StructType()
    for name, kind in (("tablename", "string"), ("version", "integer"), ("implicit", "string"), ("journeynumber", "long"), ("stoporder", "integer"), ("userstopcode", "string")):
        schema = schema.add(name, kind)
    rows = kv1.parse_lines(archives.archive_lines(spark, f"{folder}/*.zip"), "pujopass", schema)[0]
    return rows.select(F.regexp_extract("file", r"(v\d+_\d+\.zip!/.*)$", 1).alias("file"), "pos", "version", "journeynumber", "stoporder", "userstopcode")


# ---------------------------------------------------------------- O-S6, S8, S10: what to load, in which order
def _index(w: World):
    """An index with an entry for each schedule version, its validity, and what was loaded or purged."""
    s = w.kv_schedvers
    n = F.col("schedulecode").cast("int") + F.col("version") * 3 + F.length("scheduletypecode")
    key = F.concat_ws("_", "dataownercode", "version", "organizationalunitcode", "schedulecode", "scheduletypecode")
    e = s.select(
        key.alias("key"), F.concat(key, F.lit(".zip")).alias("zipfile"), (n % 3 + 1).cast("int").alias("versie"), F.when(n % 7 == 0, "false").otherwise("TRUE").alias("isgepubliceerd"),
        F.concat(F.lit("2024-01-"), F.lpad((n % 28 + 1).cast("string"), 2, "0")).alias("publicatiedatum"), F.when(n % 10 == 0, "true").otherwise("false").alias("isbaseline"),
        (n % 50).cast("int").alias("index"), "dataownercode", "validfrom", "validthru", n.alias("n"))
    loaded = e.where("n % 4 = 0").select(F.col("key").alias("filename"), F.when(F.col("n") % 8 == 0, F.col("versie")).otherwise(F.col("versie") - 1).alias("dataownerversion"))
    purged = e.where("n % 9 = 0").select(F.col("key").alias("filename"), F.col("versie").alias("dataownerversion"))
    return e.drop("n", "dataownercode", "validfrom", "validthru"), e.select("key", "dataownercode", "validfrom", "validthru"), loaded, purged


@register("src_load_plan_s10", oracle(["kv_schedvers"], f"""
, e AS (
  SELECT concat_ws('_', dataownercode, version, organizationalunitcode, schedulecode, scheduletypecode) AS key, dataownercode, validthru,
         CAST(schedulecode AS INTEGER) + version * 3 + length(scheduletypecode) AS n
  FROM kv_schedvers)
SELECT key, dataownercode, CAST(n % 3 + 1 AS INTEGER) AS versie, n % 10 = 0 AS baseline,
       CAST(row_number() OVER (PARTITION BY dataownercode ORDER BY n % 10 <> 0, n % 50, n % 28, key) AS INTEGER) AS step
FROM e WHERE n % 7 <> 0 AND n % 8 <> 0 AND n % 9 <> 0 AND validthru >= DATE '{PLAN_AS_OF}' - 1"""))
def q_load_plan(spark, sf):
    return kv1.load_plan(*_index(World(spark, sf)), PLAN_AS_OF).select("key", "dataownercode", "versie", "baseline", "step")


# ---------------------------------------------------------------- PAS journeys and stops, IFF lists and deliveries, typed loads: round trips
def _tagged(df, file, pos, line):
    """Lines as the tagged reader gives them."""
    return df.select(file.alias("file"), pos.cast("long").alias("pos"), line.alias("line")).select(
        "file", "pos", F.substring("line", 1, 1).alias("tag"), F.expr("substring(line, 2)").alias("body"))


def pas_journey_lines(w: World):
    """A PAS file for each direction: a block for each journey, times of day without seconds and without days."""
    p = w.pas_pujopass.withColumn("n", F.count("*").over(Window.partitionBy("ritnummer")))
    hm = lambda c: F.concat(F.lpad((F.substring(c, 1, 2).cast("int") % 24).cast("string"), 2, "0"), F.substring(c, 4, 2))
    at = F.col("ritnummer").cast("long") * 100
    file = F.concat(F.lit("RET.PAS"), F.col("richting").cast("string"))
    arrival, departure = hm("aankomsttijd"), hm("vertrektijd")
    both = F.concat(F.lit("+"), "halteid", F.lit(","), arrival, F.lit(","), departure)
    call = (F.when(F.col("stopsequentie") == 1, F.concat(F.lit(">"), "halteid", F.lit(","), F.coalesce(departure, F.lit(""))))
            .when(F.col("stopsequentie") == F.col("n"), F.concat(F.lit("<"), "halteid", F.lit(","), arrival))
            .when(arrival == departure, F.concat(F.lit("."), "halteid", F.lit(","), arrival)).otherwise(both))
    calls = _tagged(p, file, at + 2 + F.col("stopsequentie"), call)
    j = w.pas_pujo
    head = _tagged(j, file, at, F.concat(F.lit("#"), F.concat_ws(",", "modaliteit", "vervoerdercode", "lijnsysteemnr", F.col("richting").cast("string"), "ritnummer")))
    return head.unionByName(_tagged(j, file, at + 1, F.concat(F.lit("-"), "voetnoot"))).unionByName(calls)


def _pas_time(c: str) -> str:
    """Whole minutes of day of a time, and whether an earlier one of the journey was later (the clock passed midnight)."""
    return f"lpad(CAST(CAST({c}[1:2] AS INTEGER) % 24 AS VARCHAR), 2, '0') || {c}[3:5] || ':00'"


def _pas_rolled(c: str) -> str:
    return f"if(bool_or(back_{c}) OVER w AND {c} IS NOT NULL, CAST(CAST({c}[1:2] AS INTEGER) + 24 AS VARCHAR) || {c}[3:8], {c})"


@register("src_pas_journeys_s16", oracle(["pas_pujopass"], f"""
, t AS (SELECT * REPLACE ({_pas_time('aankomsttijd')} AS aankomsttijd, {_pas_time('vertrektijd')} AS vertrektijd) FROM pas_pujopass)
, b AS (
  SELECT *, ifnull(aankomsttijd < last_value(aankomsttijd IGNORE NULLS) OVER p, false) AS back_aankomsttijd, ifnull(vertrektijd < last_value(vertrektijd IGNORE NULLS) OVER p, false) AS back_vertrektijd
  FROM t WINDOW p AS (PARTITION BY ritnummer ORDER BY stopsequentie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT vervoerdercode, lijnsysteemnr, richting, ritnummer, voetnoot, stopsequentie, halteid, {_pas_rolled('aankomsttijd')} AS aankomsttijd, {_pas_rolled('vertrektijd')} AS vertrektijd
FROM b WINDOW w AS (PARTITION BY ritnummer ORDER BY stopsequentie)"""))
def q_pas_journeys(spark, sf):
    return tagged.pas_journeys(pas_journey_lines(World(spark, sf)))[1]


@register("src_pas_pujo_s16", oracle(["pas_pujo"], "SELECT modaliteit, vervoerdercode, lijnsysteemnr, richting, ritnummer, voetnoot FROM pas_pujo"))
def q_pas_pujo(spark, sf):
    return tagged.pas_journeys(pas_journey_lines(World(spark, sf)))[0]


@register("src_pas_stops_s17", oracle(["pas_stops"], """
SELECT NULL::VARCHAR AS overstaphalte, halteid, '3' AS overstaptijd, NULL::VARCHAR AS maxoverstaptijd, 'NL' AS landcode, NULL::VARCHAR AS tijdzone, NULL::VARCHAR AS attribuut,
       CAST(x AS VARCHAR) AS x, CAST(y AS VARCHAR) AS y, naam, NULL::VARCHAR AS straat, NULL::VARCHAR AS volgendezijstraat, NULL::VARCHAR AS volgendezijstraat2,
       halteid[3:4] AS zone1, NULL::VARCHAR AS zone2, NULL::VARCHAR AS zone3, NULL::VARCHAR AS zone4 FROM pas_stops"""))
def q_pas_stops(spark, sf):
    s = World(spark, sf).pas_stops
    none = F.lit("  ")
    line = F.concat_ws(",", none, "halteid", F.lit(" 3"), none, F.lit("NL"), none, none, F.col("x").cast("string"), F.col("y").cast("string"), F.rpad("naam", 40, " "), none, none, none,
                       F.substring("halteid", 3, 2), none, none, none)
    return tagged.pas_stops(_tagged(s, F.lit("RET.HLT"), F.substring("halteid", 3, 20).cast("long"), line))


@register("src_iff_stations_s12", oracle(["iff_station"], """
SELECT trainchanges, shortname, layovertime, country, timezone, CAST(x // 10 * 10 AS INTEGER) AS x, CAST(y // 10 * 10 AS INTEGER) AS y, name FROM iff_station"""))
def q_iff_stations(spark, sf):
    s = World(spark, sf).iff_station
    text = lambda c: F.coalesce(c.cast("string"), F.lit("0"))
    line = F.concat_ws(",", text(F.col("trainchanges")), F.rpad("shortname", 7, " "), F.lpad((F.col("layovertime") / 60).cast("int").cast("string"), 2, "0"), F.lit("00"), F.rpad("country", 4, " "),
                       text(F.col("timezone")), F.lit("0"), text(F.floor(F.col("x") / 10)), text(F.floor(F.col("y") / 10)), "name")
    at = F.substring("shortname", 2, 20).cast("long")
    lines = _tagged(s, F.lit("stations.dat"), at, line)
    return tagged.iff_list(lines.unionByName(_tagged(s.limit(1), F.lit("stations.dat"), F.lit(0), F.lit("@100,01012024,31012024,0001,x"))), "stations")


@register("src_iff_delivery_s14", oracle(["iff_company", "iff_delivery"], """
SELECT 'company' || c.company || '.dat' AS file, c.company, firstday, lastday, versionnumber, c.name AS description FROM iff_company c CROSS JOIN iff_delivery"""))
def q_iff_delivery(spark, sf):
    w = World(spark, sf)
    day = lambda c: F.date_format(w.iff_delivery.select(c).scalar(), "ddMMyyyy")
    line = F.concat_ws(",", F.concat(F.lit("@"), F.col("company").cast("string")),
                       day("firstday"), day("lastday"), F.lit("0001"), "name")
    file = F.concat(F.lit("company"), F.col("company").cast("string"), F.lit(".dat"))
    first = _tagged(w.iff_company, file, F.lit(0), line)
    return tagged.iff_delivery(first.unionByName(_tagged(w.iff_company, file, F.lit(1), F.concat_ws(",", F.col("company").cast("string"), "code", "name"))))


@register("src_conform_s19", oracle(["kv_pujopass"], """
SELECT journeynumber, stoporder, userstopcode, targetarrivaltime, wheelchairaccessible, stoporder % 2 = 0 AS dataownerisoperator, CAST(NULL AS DATE) AS validfrom,
       CAST(NULL AS INTEGER) AS productformulatype FROM kv_pujopass"""))
def q_conform(spark, sf):
    from gtfsforge.operators.first import ensure_column

    text = World(spark, sf).kv_pujopass.select(
        F.when(F.col("stoporder") % 2 == 0, "T").otherwise(" no ").alias("dataownerisoperator"), F.concat(F.lit(" "), F.col("stoporder").cast("string")).alias("stoporder"),
        F.col("journeynumber").cast("string").alias("journeynumber"), F.rpad("userstopcode", 12, " ").alias("userstopcode"),
        F.coalesce("targetarrivaltime", F.lit(" ")).alias("targetarrivaltime"), F.coalesce("wheelchairaccessible", F.lit("")).alias("wheelchairaccessible"))
    schema = StructType()
    for name, kind in (("journeynumber", "long"), ("stoporder", "integer"), ("userstopcode", "string"), ("targetarrivaltime", "string"), ("wheelchairaccessible", "string"),
                       ("dataownerisoperator", "boolean"), ("validfrom", "date")):
        schema = schema.add(name, kind)
    return ensure_column(kv1.conform(text, schema), "productformulatype", "int")
