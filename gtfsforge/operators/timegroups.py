"""Time-demand groups: compress passing times into shared drive-time profiles
and expand them again (O-T2..O-T7, O-T10, O-T13).

Journeys are the unit of work: every window is partitioned by a journey or a
pattern key, so the work spreads over as many tasks as there are journeys.
The only sequential fold (O-T5) is an array aggregate per (pattern, time-demand
group); a group holds the links of one pattern (tens of rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gtfsforge.functions.timeofday import seconds_to_time, to_seconds
from gtfsforge.operators.first import first_per

JOURNEY = ["version", "dataownercode", "organizationalunitcode", "schedulecode", "scheduletypecode",
           "lineplanningnumber", "journeynumber"]
TDG_PK = ["version", "dataownercode", "lineplanningnumber", "journeypatterncode"]


# Window keys with the one that tells rows apart first: rows are compared by it before the others are looked at.
_BY_JOURNEY = ["journeynumber"] + [c for c in JOURNEY if c != "journeynumber"]
_BY_PATTERN = ["journeypatterncode", "lineplanningnumber", "version", "dataownercode"]


# ------------------------------------------------------------------ O-T2
FIRST_PASS = ["departuretime", "wheelchairaccessible", "dataownerisoperator"]
LINK = ["timinglinkorder", "userstopcodebegin", "userstopcodeend", "totaldrivetime", "drivetime", "stopwaittime"]


def _links(pujopass: DataFrame) -> DataFrame:
    """The links, with what the first passing of their journey has (FIRST_PASS)."""
    w = Window.partitionBy(*_BY_JOURNEY).orderBy("stoporder")
    arr = F.coalesce("targetarrivaltime", "targetdeparturetime")
    dep = F.coalesce("targetdeparturetime", "targetarrivaltime")
    # times become seconds once, before a passing meets its neighbours
    df = pujopass.select(*JOURNEY, "stoporder", "journeypatterncode", "userstopcode", to_seconds(arr).alias("arr"), to_seconds(dep).alias("dep"),
                         dep.alias("departuretime"), "wheelchairaccessible", "dataownerisoperator")
    df = df.withColumns({
        "next_stop": F.lead("userstopcode").over(w), "next_arr": F.lead("arr").over(w), "next_dep": F.lead("dep").over(w),
        **{c: F.first(c).over(w) for c in FIRST_PASS}})
    return df.filter(F.col("next_stop").isNotNull()).select(
        *JOURNEY,
        "journeypatterncode",
        F.col("stoporder").alias("timinglinkorder"),
        F.col("userstopcode").alias("userstopcodebegin"),
        F.col("next_stop").alias("userstopcodeend"),
        (F.col("next_dep") - F.col("dep")).alias("totaldrivetime"),
        (F.col("next_arr") - F.col("dep")).alias("drivetime"),
        ((F.col("next_dep") - F.col("dep")) - (F.col("next_arr") - F.col("dep"))).alias("stopwaittime"),
        *FIRST_PASS,
    )


def links(pujopass: DataFrame) -> DataFrame:
    """Consecutive passings of a journey -> timing links with drive and wait times (O-T2)."""
    return _links(pujopass).drop(*FIRST_PASS)


# ------------------------------------------------------------------ O-T3
def _coded(lk: DataFrame, keep=(), together: bool = False, parts: int | None = None) -> DataFrame:
    """Journeys with `signature` (their ordered links), `timedemandgroupcode`, whether they lead their group, and `keep`, which a journey has one of each of.

    A journey's links are put together in the order that they have already, and
    journeys meet once, by pattern, in `parts` partitions (default: the
    session's).  Two hashes of 64 bits stand for the list of links, which goes
    along only where it is asked for.  together: the list and `keep` go along as
    one value, so plans that ask for either read the same shuffle.
    """
    w = Window.partitionBy(*_BY_JOURNEY, "journeypatterncode").orderBy("timinglinkorder")
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # a pattern without a name has no groups; said key by key, so that joins on them add no filter of their own and plans share the shuffles
    df = lk.where(" and ".join(f"{c} is not null" for c in TDG_PK)).withColumns({"__n": F.row_number().over(w), "__links": F.collect_list(F.struct(*LINK)).over(every)}).where("__n = 1")
    df = df.select(*JOURNEY, "journeypatterncode", *keep, F.sort_array("__links").alias("__links"))
    # the list goes along as a list of each column, which takes a third of the room of a list of rows
    own = [F.col(f"__links.{c}").alias(f"__{c}") for c in LINK] + list(keep)
    per_journey = df.select(
        *JOURNEY, "journeypatterncode", F.xxhash64("__links").alias("__a"), F.xxhash64(F.lit(1), "__links").alias("__b"),
        *([F.array(F.struct(*own)).alias("__own")] if together else own))
    per_journey = per_journey.repartition(*([parts] if parts else []), *_BY_PATTERN)
    seen = ["organizationalunitcode", "schedulecode", "scheduletypecode", "journeynumber"]
    alike = Window.partitionBy(*_BY_PATTERN, "__a", "__b").orderBy(*seen)
    df = per_journey.withColumns({"leads": F.row_number().over(alike) == 1, "__first": F.first(F.struct(*seen)).over(alike)})
    code = F.dense_rank().over(Window.partitionBy(*_BY_PATTERN).orderBy("__first")) - 1
    df = df.withColumn("timedemandgroupcode", code.cast("int"))
    if together:
        one = F.element_at("__own", 1)
        df = df.withColumns({c: one[c] for c in [*[f"__{c}" for c in LINK], *keep]}).drop("__own")
    return df.withColumn("signature", F.arrays_zip(*[F.col(f"__{c}").alias(c) for c in LINK])).drop("__a", "__b", "__first", *[f"__{c}" for c in LINK])


def group_codes(lk: DataFrame) -> DataFrame:
    """Give journeys with an identical ordered link list the same 0-based code per pattern (O-T3).

    Codes follow first appearance in journey order, as a sequential pass
    would.  Returns (JOURNEY..., journeypatterncode, timedemandgroupcode, signature).
    """
    return _coded(lk).select(*TDG_PK, *[c for c in JOURNEY if c not in TDG_PK], "signature", "timedemandgroupcode")


# ------------------------------------------------------------------ O-T4
def time_groups(pujopass: DataFrame, together: bool = False, parts: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Compress passings into TIMDEMGRP, TIMDEMRNT and SCHEDPUJO (O-T4).

    Journeys with a single stop have no link and get no group (they are left
    out, see ``single_stop_journeys``).  together: for plans that read both
    TIMDEMRNT and SCHEDPUJO, which then share one shuffle.  parts: how many
    partitions journeys meet in.
    """
    lk = _links(pujopass)
    journeys = _coded(lk, FIRST_PASS, together, parts)
    groups = (journeys if together else _coded(lk.drop(*FIRST_PASS), parts=parts)).where("leads").select(*TDG_PK, "timedemandgroupcode", "signature")
    timdemgrp = groups.select(*TDG_PK, "timedemandgroupcode")
    timdemrnt = groups.select(*TDG_PK, "timedemandgroupcode", F.explode("signature").alias("l")).select(
        *TDG_PK,
        "timedemandgroupcode",
        F.col("l.timinglinkorder").alias("timinglinkorder"),
        F.col("l.userstopcodebegin").alias("userstopcodebegin"),
        F.col("l.userstopcodeend").alias("userstopcodeend"),
        F.col("l.totaldrivetime").alias("totaldrivetime"),
        F.col("l.drivetime").alias("drivetime"),
        F.lit(0).alias("expecteddelay"),
        F.lit(0).alias("layovertime"),
        F.col("l.stopwaittime").alias("stopwaittime"),
        F.lit(0).alias("minimumstoptime"),
    )
    schedpujo = journeys.dropna(subset=JOURNEY).select(*JOURNEY, "journeypatterncode", "timedemandgroupcode", *FIRST_PASS)
    return timdemgrp, timdemrnt, schedpujo


def single_stop_journeys(pujopass: DataFrame) -> DataFrame:
    """Journeys that cannot be compressed (one passing only): the reject table."""
    return pujopass.groupBy(*JOURNEY).count().filter("count = 1").drop("count")


# ------------------------------------------------------------------ O-T6
def min_distance(link: DataFrame) -> DataFrame:
    """Shortest measured distance per (version, begin, end) (O-T6, O-A4)."""
    return link.groupBy("version", "userstopcodebegin", "userstopcodeend").agg(F.min("distance").alias("distance"))


# ------------------------------------------------------------------ O-T5
SPREAD_KEYS = TDG_PK + ["timedemandgroupcode"]


# A fold over a group's links in order.  The state is what is finished and the open run: `done` holds final
# drive times, `time` the run's total so far and `dist` the distances of its links (empty: no run is open).
_STATE = "struct<done:array<bigint>,time:bigint,dist:array<bigint>>"
_LEAST = 4  # seconds of a link whose share rounds to nothing
_NONE = "cast(array() as array<bigint>)"


def _let(name: str, value: str, body: str, kind: str = "array<bigint>") -> str:
    """SQL of body with name standing for value, which is worked out once."""
    return f"aggregate(array({value}), cast(null as {kind}), (_{name}, {name}) -> {body})"


def _shares(time: str, dist: str, last: str) -> str:
    """SQL of a run's drive times: `time` by distance in whole seconds, what is left over on the last link.

    A run without any distance keeps its times: its first link's and `last`, zeros between.
    """
    cut = f"transform(ds, d -> case when ({time}) * d div total = 0 then {_LEAST}L else ({time}) * d div total end)"
    fitted = f"concat(slice(cut, 1, size(cut) - 1), array(element_at(cut, -1) + ({time}) - aggregate(cut, 0L, (a, w) -> a + w)))"
    kept = f"transform(ds, (d, i) -> case when i = size(ds) - 1 then {last} when i = 0 then ({time}) - {last} else 0L end)"
    spread = _let("total", "aggregate(ds, 0L, (a, d) -> a + d)", f"case when total = 0 then {kept} else {_let('cut', cut, fitted)} end")
    return _let("ds", dist, spread)


def _spread_sql(links: str) -> str:
    """SQL that folds `links` (array of struct with drive, dist and opens: the next link has no time) into drive times."""
    going = f"""aggregate({links}, cast(named_struct('done', {_NONE}, 'time', 0L, 'dist', {_NONE}) as {_STATE}), (s, x) ->
      case when size(s.dist) = 0 and x.drive != 0 and not x.opens
             then named_struct('done', concat(s.done, array(x.drive)), 'time', 0L, 'dist', {_NONE})
           when size(s.dist) = 0 or x.drive = 0
             then named_struct('done', s.done, 'time', s.time + x.drive, 'dist', concat(s.dist, array(x.dist)))
           else aggregate(array({_shares("s.time + x.drive", "concat(s.dist, array(x.dist))", "x.drive")}), s, (t, run) ->
             case when element_at(run, -1) = 0 or x.opens
                    then named_struct('done', concat(t.done, slice(run, 1, size(run) - 1)), 'time', element_at(run, -1), 'dist', array(x.dist))
                  else named_struct('done', concat(t.done, run), 'time', 0L, 'dist', {_NONE}) end)
      end,
      s -> case when size(s.dist) = 0 then s.done else concat(s.done, {_shares("s.time", "s.dist", "case when size(s.dist) = 1 then s.time else 0L end")}) end)"""
    return going


def spread_zero_times(timdemrnt: DataFrame, link: DataFrame) -> DataFrame:
    """Spread zero drive times over their run by link distance (O-T5).

    A run is the link before a zero, the zeros, and the first link with a time
    after them; a run's last link may be the first of the next, with its new
    time.  Links without a measured distance are dropped by the inner join, as
    in the source.  A group is the links of one pattern; only groups that hold
    a zero are folded, inside the JVM.
    """
    df = timdemrnt.join(min_distance(link), ["version", "userstopcodebegin", "userstopcodeend"])
    one = F.struct(
        F.col("timinglinkorder").cast("int").alias("timinglinkorder"), "userstopcodebegin", "userstopcodeend",
        F.col("totaldrivetime").cast("long").alias("drive"), F.col("stopwaittime").cast("long").alias("stopwaittime"),
        F.col("distance").cast("long").alias("dist"),
    )
    groups = df.groupBy(*SPREAD_KEYS).agg(F.sort_array(F.collect_list(one)).alias("links"))
    flagged = "transform(links, (x, i) -> named_struct('drive', x.drive, 'dist', x.dist, 'opens', coalesce(get(links, i + 1).drive = 0, false)))"
    times = f"case when exists(links, x -> x.drive = 0) then {_spread_sql('flagged')} else transform(links, x -> x.drive) end"
    spread = groups.withColumn("flagged", F.expr(flagged)).withColumn("times", F.expr(times))
    return spread.select(*SPREAD_KEYS, "times", F.posexplode("links").alias("at", "x")).select(
        *SPREAD_KEYS, F.col("x.timinglinkorder").alias("timinglinkorder"), F.col("x.userstopcodebegin").alias("userstopcodebegin"),
        F.col("x.userstopcodeend").alias("userstopcodeend"), F.get("times", F.col("at")).alias("totaldrivetime"),
        F.col("x.stopwaittime").alias("stopwaittime"), F.col("x.dist").alias("distance"),
    )


# ------------------------------------------------------------------ O-T7
def cumulate(df: DataFrame) -> DataFrame:
    """Cumulative passing offset per group: sum of drive up to the row plus the
    waits of the earlier rows (O-T7) -> TIMDEMPASS."""
    # links come by pattern, group and order already, so that little is left to sort
    w = Window.partitionBy(*_BY_PATTERN, "timedemandgroupcode").orderBy("timinglinkorder")
    drive = F.sum("totaldrivetime").over(w.rowsBetween(Window.unboundedPreceding, 0))
    wait = F.coalesce(F.sum("stopwaittime").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return df.select(
        *SPREAD_KEYS, "timinglinkorder", "userstopcodebegin", "userstopcodeend",
        (drive + wait).cast("long").alias("totaldrivetime"), F.col("stopwaittime").cast("long").alias("stopwaittime"),
    )


# ------------------------------------------------------------------ O-T13
def expand_journeys(pujo: DataFrame, jopatili: DataFrame, timdempass: DataFrame, parts: int | None = None) -> DataFrame:
    """Drive-time journeys back to passings: the first stop at the departure time
    plus every link end at its cumulative offset (stoporder = timinglinkorder + 2) (O-T13).

    Journeys and groups, each one row, meet by pattern in `parts` partitions
    (default: the session's); passings are made, and those that come twice
    left out, where they meet, so passings themselves are never shuffled.
    """
    first = first_per(jopatili, TDG_PK, ["timinglinkorder"]).select(*TDG_PK, F.struct("userstopcodebegin").alias("__first"))
    base = pujo.dropna(subset=TDG_PK).select(
        *TDG_PK, "timedemandgroupcode", "organizationalunitcode",
        F.col("periodgroupcode").alias("schedulecode"), F.col("daytype").alias("scheduletypecode"),
        "journeynumber", "departuretime", "wheelchairaccessible", "dataownerisoperator", F.lit(1).alias("__kind"),
    )
    out_cols = ["version", "dataownercode", "organizationalunitcode", "schedulecode", "scheduletypecode",
                "lineplanningnumber", "journeynumber", "stoporder", "journeypatterncode", "userstopcode",
                "targetarrivaltime", "targetdeparturetime", "wheelchairaccessible", "dataownerisoperator"]
    # a group's passings as one row, a list of each column
    own = ["timinglinkorder", "userstopcodebegin", "totaldrivetime", "stopwaittime"]
    w = Window.partitionBy(*_BY_PATTERN, "timedemandgroupcode").orderBy("timinglinkorder")
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    groups = timdempass.dropna(subset=SPREAD_KEYS).withColumns({"__n": F.row_number().over(w), "__own": F.collect_list(F.struct(*own)).over(every)}).where("__n = 1")
    groups = groups.select(*SPREAD_KEYS, F.lit(0).alias("__kind"), *[F.col(f"__own.{c}").alias(f"__{c}") for c in own])
    # a group's row comes before its journeys
    met = base.unionByName(groups, allowMissingColumns=True).repartition(*([parts] if parts else []), *_BY_PATTERN)
    before = Window.partitionBy(*_BY_PATTERN, "timedemandgroupcode").orderBy("__kind").rowsBetween(Window.unboundedPreceding, 0)
    met = met.withColumns({f"__{c}": F.first(f"__{c}").over(before) for c in own}).where("__kind = 1").join(first, TDG_PK, "left")
    of = lambda at_first, order, stop, total, wait: F.struct(
        F.lit(at_first).alias("at_first"), order.cast("int").alias("stoporder"), stop.alias("userstopcode"), total.alias("total"), wait.alias("wait"))
    none = F.lit(None).cast("long")
    begin = F.when(F.col("__first").isNotNull(), F.array(of(True, F.lit(1), F.col("__first.userstopcodebegin"), none, none)))
    links = F.transform(F.arrays_zip(*[F.col(f"__{c}").alias(c) for c in own]), lambda x: of(False, x.timinglinkorder + 2, x.userstopcodebegin, x.totaldrivetime, x.stopwaittime))
    met = met.withColumn("__start", to_seconds("departuretime")).withColumn("x", F.explode(F.concat(F.coalesce(begin, F.array()), F.coalesce(links, F.array()))))
    # add32time in its steps: a journey's time is read once
    met = met.withColumns({"__arrives": F.col("__start") + F.col("x.total"), "__leaves": F.col("__start") + (F.col("x.total") + F.col("x.wait")).cast("int")})
    at = lambda s: F.when(F.col("x.at_first"), F.col("departuretime")).otherwise(seconds_to_time(s))
    return met.withColumns({
        "stoporder": F.col("x.stoporder"), "userstopcode": F.col("x.userstopcode"), "targetarrivaltime": at("__arrives"), "targetdeparturetime": at("__leaves"),
    }).select(*out_cols).distinct()


# ------------------------------------------------------------------ O-T10
def rollover(df: DataFrame, keys, order: str, time: str, out: str | None = None) -> DataFrame:
    """Midnight rollover: once a time goes backwards along the journey it and
    every later time get +24 h (O-T10).  Times are zero-padded text.

    rolled(i) = some j <= i with t(j) < t(j-1) (NULL times skipped).
    """
    out = out or time
    w = Window.partitionBy(*keys).orderBy(order)
    prev = F.last(F.col(time), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    back = F.when(F.col(time) < prev, 1).otherwise(0)
    df = df.withColumn("__back", back)
    rolled = F.max("__back").over(w.rowsBetween(Window.unboundedPreceding, 0)) > 0
    secs = to_seconds(time) + F.when(rolled, 24 * 3600).otherwise(0)
    return df.withColumn(out, F.when(F.col(time).isNotNull(), seconds_to_time(secs))).drop("__back")
