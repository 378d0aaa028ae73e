"""Tagged-line timetable files: IFF rail (O-S11..O-S14, O-S18) and PAS metro/tram (O-S16, O-S17).

A file is a sequence of lines whose first character is a tag; a ``#`` line
opens a block (a service / journey) and every following line belongs to it.
Lines are read with their position (``binaryFile`` + ``posexplode``), then
each line gets the position of its block header by a *prefix maximum* of
header positions.  The prefix maximum is computed per fixed-size chunk of
positions and the carry between chunks is a running max over one row per
chunk, so a single huge file is spread over many tasks instead of one
window partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gtfsforge.functions.timeofday import hhmm

STOP_TAGS = (">", ".", "+", ";", "<")


def read_tagged(spark: SparkSession, path: str, charset: str = "cp1252") -> DataFrame:
    """Files -> (file, pos, tag, body); CRLF or LF line ends, empty lines dropped.

    Decoding happens on the executors (``decode`` with the file's charset;
    legacy Java charsets such as cp1252 need ``spark.sql.legacy.javaCharsets``).
    """
    raw = spark.read.format("binaryFile").load(path)
    lines = raw.select(F.col("path").alias("file"),
                       F.posexplode(F.split(F.decode("content", charset), "\r?\n")).alias("pos", "line"))
    return lines.filter(F.length("line") > 0).select(
        "file", F.col("pos").cast("long"), F.substring("line", 1, 1).alias("tag"), F.expr("substring(line, 2)").alias("body"))


def assign_blocks(lines: DataFrame, header: str = "#", chunk: int = 100_000) -> DataFrame:
    """Add ``block`` = position of the latest header line at or before each line (per file).

    Lines before the first header get NULL.
    """
    hdr = F.when(F.col("tag") == header, F.col("pos"))
    c = lines.withColumn("__chunk", F.floor(F.col("pos") / chunk))
    w_local = Window.partitionBy("__chunk", "file").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    c = c.withColumn("__local", F.max(hdr).over(w_local))
    per_chunk = c.groupBy("file", "__chunk").agg(F.max(hdr).alias("__last"))
    w_carry = Window.partitionBy("file").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_chunk.select("file", "__chunk", F.max("__last").over(w_carry).alias("__carry"))
    return (c.join(carry, ["file", "__chunk"], "left")
            .withColumn("block", F.coalesce("__local", "__carry"))
            .drop("__chunk", "__local", "__carry"))


def _fields(n: int):
    parts = F.split(F.col("body"), ",")
    return [F.trim(F.get(parts, i)) for i in range(n)]


def zero_to_null(df: DataFrame, cols) -> DataFrame:
    """``value or ''`` on write, i.e. 0 / '' / False -> NULL on load (O-S18)."""
    for c in cols:
        t = dict(df.dtypes)[c]
        if t == "string":
            df = df.withColumn(c, F.nullif(F.col(c), F.lit("")))
        else:
            df = df.withColumn(c, F.nullif(F.col(c), F.lit(0).cast(t)))
    return df


def _stop_index(df: DataFrame) -> DataFrame:
    """Running count of stop records inside the block (a ``?`` record gets its stop's index)."""
    w = Window.partitionBy("block", "file").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    is_stop = F.when(F.col("tag").isin(*STOP_TAGS), 1).otherwise(0)
    return df.withColumn("idx", F.sum(is_stop).over(w))


def _in_order(lines: DataFrame, chunk: int) -> DataFrame:
    """IFF records with their block's `serviceid`, the number `idx` of stops up to them in it and the station `at_station` of the last one.

    One window over each chunk of positions counts stops and keeps the latest
    header and the latest stop; the last line of each chunk says what the next
    ones go on from.  Lines before a file's first header are left out.
    """
    stop, header = F.col("tag").isin(*STOP_TAGS), F.col("tag") == "#"
    within = Window.partitionBy("__chunk", "file").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    c = lines.withColumn("__chunk", F.floor(F.col("pos") / chunk)).withColumn("__n", F.count(F.when(stop, 1)).over(within))
    opened = F.when(header, F.struct(F.trim("body").cast("int").alias("id"), F.col("__n").alias("n")))
    # a header forgets the stop before it
    at = F.when(stop | header, F.struct(F.when(stop, _fields(1)[0]).alias("station")))
    c = c.withColumns({"__head": F.last(opened, ignorenulls=True).over(within), "__at": F.last(at, ignorenulls=True).over(within)})
    ends = c.groupBy("file", "__chunk").agg(F.max_by(F.struct("__n", "__head", "__at"), "pos").alias("e"))
    before = Window.partitionBy("file").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("__past", F.coalesce(F.sum("e.__n").over(before), F.lit(0)))
    # the stops of a file before its latest header
    began = F.when(F.col("e.__head").isNotNull(), F.struct(F.col("e.__head.id").alias("id"), (F.col("__past") + F.col("e.__head.n")).alias("n")))
    carry = ends.select("file", "__chunk", "__past", F.last(began, ignorenulls=True).over(before).alias("__began"), F.last("e.__at", ignorenulls=True).over(before).alias("__was"))
    # a file's name and chunk are never null
    c = c.join(carry, ["file", "__chunk"]).where("__head is not null or __began is not null")
    own = F.col("__head").isNotNull()
    return c.select(
        "file", "tag", "body", F.when(own, F.col("__head.id")).otherwise(F.col("__began.id")).alias("serviceid"),
        F.when(own, F.col("__n") - F.col("__head.n")).otherwise(F.col("__past") + F.col("__n") - F.col("__began.n")).alias("idx"),
        F.when(F.col("__at").isNotNull(), F.col("__at.station")).otherwise(F.col("__was.station")).alias("at_station"))


def iff_timetable(lines: DataFrame, chunk: int = 100_000) -> dict[str, DataFrame]:
    """IFF timetable records -> timetable_{service,validity,transport,attribute,stop,platform} (O-S11).

    Every table carries its `file`, as service ids are only unique within a delivery.
    A platform record belongs to the stop before it.
    """
    f = _fields(6)
    rec = _in_order(lines, chunk)
    # every table below is a filter + projection of the records in order
    out: dict[str, DataFrame] = {}
    out["service"] = rec.filter(F.col("tag") == "%").select(
        "serviceid", _num(f[0]).alias("companynumber"), _num(f[1]).alias("servicenumber"),
        F.nullif(f[2], F.lit("")).alias("variant"), _num(f[3]).alias("firststop"), _num(f[4]).alias("laststop"),
        F.nullif(f[5], F.lit("")).alias("servicename"), "file")
    out["validity"] = rec.filter(F.col("tag") == "-").select(
        "serviceid", f[0].cast("int").alias("footnote"), _num(f[1]).alias("firststop"), _num(f[2]).alias("laststop"), "file")
    out["transport"] = rec.filter(F.col("tag") == "&").select(
        "serviceid", f[0].alias("transmode"), _num(f[1]).alias("firststop"), _num(f[2]).alias("laststop"), "file")
    out["attribute"] = rec.filter(F.col("tag") == "*").select(
        "serviceid", f[0].alias("code"), _num(f[1]).alias("firststop"), _num(f[2]).alias("laststop"), "file")
    t2, t3 = hhmm(f[1]), hhmm(f[2])
    arr = (F.when(F.col("tag") == ".", t2).when(F.col("tag") == "+", t2).when(F.col("tag") == "<", t2))
    dep = (F.when(F.col("tag") == ">", t2).when(F.col("tag") == ".", t2).when(F.col("tag") == "+", t3))
    out["stop"] = rec.filter(F.col("tag").isin(*STOP_TAGS)).select(
        "serviceid", F.col("idx").cast("int"), f[0].alias("station"), arr.alias("arrivaltime"), dep.alias("departuretime"), "file")
    out["platform"] = rec.filter(F.col("tag") == "?").select(
        "serviceid", F.col("idx").cast("int"), f[0].alias("arrival"), f[1].alias("departure"),
        f[2].cast("int").alias("footnote"), F.col("at_station").alias("station"), "file")
    return out


def _num(c):
    """Numeric field where 0 / blank mean 'absent' (written as empty, loaded as NULL)."""
    return F.nullif(F.nullif(c, F.lit("")).cast("int"), F.lit(0))


def iff_delivery(lines: DataFrame) -> DataFrame:
    """Delivery line ``@company,firstday,lastday,version,description`` of each file (O-S14)."""
    f = _fields(5)
    return lines.filter(F.col("tag") == "@").select(
        "file", f[0].cast("int").alias("company"), F.to_date(f[1], "ddMMyyyy").alias("firstday"),
        F.to_date(f[2], "ddMMyyyy").alias("lastday"), f[3].cast("int").alias("versionnumber"),
        f[4].alias("description"))


def delivery_mismatch(lines: DataFrame, delivery_line: str) -> DataFrame:
    """Files whose first line differs from the delivery line (report rows)."""
    first = lines.groupBy("file").agg(F.min_by(F.concat("tag", "body"), "pos").alias("first_line"))
    return first.filter(F.col("first_line") != F.lit(delivery_line))


def iff_list(lines: DataFrame, kind: str) -> DataFrame:
    """Comma-separated IFF list tables with the unit conversions of the loader (O-S12)."""
    body = F.concat("tag", "body").alias("body")
    rows = lines.filter(~F.col("tag").isin("@")).select(body)
    parts = F.split("body", ",")

    def g(i):
        return F.trim(F.get(parts, i))

    if kind == "stations":
        return rows.select(
            F.nullif(F.nullif(g(0), F.lit("")).cast("int"), F.lit(0)).alias("trainchanges"),
            g(1).alias("shortname"), (g(2).cast("int") * 60).alias("layovertime"), g(4).alias("country"),
            _num(g(5)).alias("timezone"), F.nullif(g(7).cast("int") * 10, F.lit(0)).alias("x"),
            F.nullif(g(8).cast("int") * 10, F.lit(0)).alias("y"), g(9).alias("name"))
    if kind == "contconn":
        return rows.select(g(0).alias("fromstation"), g(1).alias("tostation"),
                           (g(2).cast("int") * 60).alias("connectiontime"), g(3).alias("connectionmode"))
    if kind == "country":
        return rows.select(g(0).alias("code"), (g(1) == "1").alias("inland"), g(2).alias("name"))
    if kind == "trnsmode":
        return rows.select(g(0).alias("code"), g(1).alias("description"))
    if kind in ("trnsattr", "connmode"):
        number = "processingcode" if kind == "trnsattr" else "connectiontype"
        return rows.select(g(0).alias("code"), _num(g(1)).alias(number), g(2).alias("description"))
    if kind == "company":
        return rows.select(g(0).cast("int").alias("company"), g(1).alias("code"), g(2).alias("name"),
                           hhmm(g(3)).alias("timeturn"))
    raise ValueError(kind)


def pas_journeys(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """PAS journeys -> (pujo, pujopass) with midnight rollover of the times (O-S16, O-T10)."""
    from gtfsforge.operators.timegroups import rollover

    b = assign_blocks(lines).filter(F.col("block").isNotNull())
    f = _fields(5)
    head = b.filter(F.col("tag") == "#").select(
        "file", "block", f[0].alias("modaliteit"), f[1].alias("vervoerdercode"), f[2].alias("lijnsysteemnr"),
        f[3].cast("int").alias("richting"), f[4].alias("ritnummer"))
    foot = b.filter(F.col("tag") == "-").select("file", "block", F.trim("body").alias("voetnoot"))
    pujo = head.join(foot, ["file", "block"])
    rec = _stop_index(b.filter(F.col("tag").isin(">", ".", "+", "<")))
    t2, t3 = hhmm(f[1]), hhmm(f[2])
    arr = F.when(F.col("tag").isin(".", "+", "<"), t2)
    dep = F.when(F.col("tag").isin(">", "."), t2).when(F.col("tag") == "+", t3)
    stops = rec.select("file", "block", F.col("idx").cast("int").alias("stopsequentie"), f[0].alias("halteid"),
                       arr.alias("aankomsttijd"), dep.alias("vertrektijd"))
    stops = rollover(stops, ["block", "file"], "stopsequentie", "aankomsttijd")
    stops = rollover(stops, ["block", "file"], "stopsequentie", "vertrektijd")
    pujopass = stops.join(pujo, ["file", "block"]).select(
        "vervoerdercode", "lijnsysteemnr", "richting", "ritnummer", "voetnoot", "stopsequentie", "halteid",
        "aankomsttijd", "vertrektijd")
    return pujo.drop("file", "block"), pujopass


def pas_validity(lines: DataFrame) -> DataFrame:
    """First and last day of each PAS file from its ``&ddmmyyyy-ddmmyyyy`` line (O-S16)."""
    days = F.split("body", "-")
    return lines.filter(F.col("tag") == "&").select(
        "file", F.to_date(F.trim(F.get(days, 0)), "ddMMyyyy").alias("firstday"), F.to_date(F.trim(F.get(days, 1)), "ddMMyyyy").alias("lastday"))


def pas_bad_format(lines: DataFrame, expected: str = "RETPAS1") -> DataFrame:
    """Format lines (``!``) of PAS files that name another format than the expected one (report rows)."""
    return lines.filter((F.col("tag") == "!") & (F.trim("body") != expected)).select("file", F.col("body").alias("format"))


def pas_footnotes(lines: DataFrame, firstday) -> DataFrame:
    """PAS footnote file: ``@id,bits`` lines, a bit for each day from `firstday` -> (voetnoot, datum) (O-S15)."""
    from gtfsforge.operators.calendar import expand_footnotes

    f = _fields(2)
    first = F.lit(firstday).cast("date") if isinstance(firstday, str) else firstday
    rows = lines.filter(F.col("tag") == "@").select(f[0].alias("voetnoot"), f[1].alias("bits"), first.alias("firstday"))
    return expand_footnotes(rows, "voetnoot", "bits", "firstday").withColumnRenamed("servicedate", "datum")


def pas_stops(lines: DataFrame) -> DataFrame:
    """PAS stop list: 17 comma fields, trimmed, blank -> NULL (O-S17)."""
    names = ["overstaphalte", "halteid", "overstaptijd", "maxoverstaptijd", "landcode", "tijdzone", "attribuut", "x",
             "y", "naam", "straat", "volgendezijstraat", "volgendezijstraat2", "zone1", "zone2", "zone3", "zone4"]
    parts = F.split(F.concat("tag", "body"), ",")
    return lines.select(*[F.nullif(F.trim(F.get(parts, i)), F.lit("")).alias(n) for i, n in enumerate(names)])


def _headers(b: DataFrame, cols) -> DataFrame:
    """Header row fields of every block, to be joined onto the block's detail rows."""
    return b.filter(F.col("tag") == "#").select("file", "block", *cols)


def iff_groups(lines: DataFrame, kind: str, firstday=None) -> DataFrame:
    """IFF files made of ``#`` header blocks with detail rows (O-S13, O-S15).

    ``timezone``: ``#tznumber`` then ``-``/``+`` difference,firstday,lastday;
    ``trnsaqst``: ``#code,type,question`` then ``-attribute`` rows (one output row per attribute);
    ``changes``: ``#station`` then tagged from,to,change rows;
    ``footnote``: ``#id`` then one line of day bits from ``firstday`` (expanded to dates).
    Header fields reach the detail rows by an equi-join on (file, block), so a
    large block (a hub station's changes) is just a skewed join key for AQE.
    """
    b = assign_blocks(lines).filter(F.col("block").isNotNull())
    det = b.filter(F.col("tag") != "#")
    f = _fields(3)
    if kind == "timezone":
        h = _headers(b, [F.trim("body").cast("int").alias("tznumber")])
        diff = F.when(F.col("tag") == "-", -f[0].cast("int")).otherwise(f[0].cast("int"))
        d = det.select("file", "block", diff.alias("difference"), F.to_date(f[1], "ddMMyyyy").alias("firstday"),
                       F.to_date(f[2], "ddMMyyyy").alias("lastday"))
        return h.join(d, ["file", "block"]).drop("file", "block")
    if kind == "trnsaqst":
        h = _headers(b, [f[0].alias("code"), (f[1] == "1").alias("inclusive"), f[2].alias("question")])
        d = det.filter(F.col("tag") == "-").select("file", "block", F.trim("body").alias("transattr"))
        return h.join(d, ["file", "block"]).drop("file", "block")
    if kind == "changes":
        h = _headers(b, [F.trim("body").alias("station")])
        # the first character of a detail line is its tag, whatever it is
        d = det.select("file", "block", f[0].cast("int").alias("fromservice"), f[1].cast("int").alias("toservice"),
                       f[2].cast("int").alias("possiblechange"))
        return h.join(d, ["file", "block"]).drop("file", "block")
    if kind == "footnote":
        from gtfsforge.operators.calendar import expand_footnotes

        h = _headers(b, [F.trim("body").cast("int").alias("footnote")])
        d = det.select("file", "block", F.concat("tag", "body").alias("bits"))
        first = F.lit(firstday).cast("date") if isinstance(firstday, str) else firstday
        return expand_footnotes(h.join(d, ["file", "block"]).withColumn("firstday", first), "footnote", "bits", "firstday")
    raise ValueError(kind)
