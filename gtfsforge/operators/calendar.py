"""Operating calendars (O-C1..O-C8, O-S15, O-F1..O-F5).

Date ranges are expanded with ``explode(sequence(...))`` only after the
service keys are de-duplicated (a schedule has one row per journey in the
source), their ranges are united and cut to the version's days, so the
explosion is (services x days that count), never (journeys x days).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gtfsforge.functions.timeofday import yyyymmdd
from gtfsforge.operators.first import first_per, key, union_distinct
from gtfsforge.operators.intervals import interval_join, merged_ranges


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def explode_range(df: DataFrame, lo, hi, out: str) -> DataFrame:
    """``generate_series(lo, hi)`` per row (O-F1 ints, O-F2 dates, 1 day step).

    Reversed bounds give no rows (Spark's ``sequence`` would count down or
    fail), equal bounds give one row; NULL bounds give no rows.
    """
    lo_c, hi_c = _c(lo), _c(hi)
    return df.filter(lo_c <= hi_c).withColumn(out, F.explode(F.sequence(lo_c, hi_c)))


def iso_dow(d) -> Column:
    """Day of week 1 = Monday .. 7 = Sunday (``extract(dow)`` with 0 -> 7) (O-F3)."""
    return F.weekday(_c(d)) + 1


def sunday_dow(d) -> Column:
    """Day of week 1 = Sunday .. 7 = Saturday (``extract(dow) + 1``) (O-F4)."""
    return F.dayofweek(_c(d))


def runs_on(daytype, d, sunday_first: bool = False) -> Column:
    """``position(dow in daytype) != 0`` (O-F5)."""
    dow = sunday_dow(d) if sunday_first else iso_dow(d)
    return F.instr(_c(daytype), dow.cast("string")) > 0


SERVICE7 = ["version", "dataownercode", "timetableversioncode", "organizationalunitcode", "periodgroupcode",
            "specificdaycode"]


#: What an exception day belongs to.
SCOPE = ["version", "dataownercode", "organizationalunitcode"]


def service_ranges(pegrval: DataFrame, tive: DataFrame, pujo: DataFrame, version: DataFrame, as_of: str) -> DataFrame:
    """Service, day type and the disjoint ranges of days on which it may run.

    A service is named by its journeys, their organisational unit included.  Its
    timetable version and the period's validity agree on the unit between
    themselves; journeys are found by version, owner, timetable version, period
    group and specific day alone.  An open end is the first day; days outside
    the version's validity or before the day before ``as_of`` don't count.
    """
    period = ["version", "dataownercode", "organizationalunitcode", "periodgroupcode"]
    run = ["version", "dataownercode", "timetableversioncode", "periodgroupcode", "specificdaycode"]
    pv = pegrval.select(*period, F.col("validfrom").alias("first"), F.col("validthru").alias("p_last"))
    tv = tive.select(*period, "timetableversioncode", "specificdaycode", F.col("validthru").alias("t_last"))
    spans = pv.join(tv, period).select(*run, "first", F.coalesce("t_last", "p_last", "first").alias("last")).distinct()
    v = version.where("validfrom is not null and validthru is not null").select(
        "version", "dataownercode", F.greatest("validfrom", F.date_sub(F.lit(as_of).cast("date"), 1)).alias("v_first"), F.col("validthru").alias("v_last"))
    spans = spans.join(v, ["version", "dataownercode"]).select(*run, F.greatest("first", "v_first").alias("validfrom"), F.least("last", "v_last").alias("validthru"))
    services = pujo.select(*SERVICE7, "daytype").distinct()
    return merged_ranges(services.join(spans.where("validfrom <= validthru"), run), [*SERVICE7, "daytype"], "validfrom", "validthru")


def _exceptions(excopday: DataFrame) -> DataFrame:
    """Exception days by version, owner and unit, and the weekday whose service they run."""
    return excopday.select(*SCOPE, F.to_date("validdate").alias("date"), F.substring(F.col("daytypeason").cast("string"), 1, 1).alias("runs_as")).distinct()


def _dates(days: DataFrame) -> DataFrame:
    return days.select(key(*SERVICE7, "daytype").alias("service_id"), yyyymmdd("date").alias("date"), F.lit(1).alias("exception_type"))


def calendar_regular(pegrval, tive, pujo, version, excopday, as_of: str) -> DataFrame:
    """Regular days of every drive-time service, one row per (service, day) (O-C3).

    Days of its ranges whose weekday is in the day type, but for its version's,
    owner's and unit's exception days that run as another weekday.
    """
    days = explode_range(service_ranges(pegrval, tive, pujo, version, as_of), "validfrom", "validthru", "date").filter(runs_on("daytype", "date"))
    other = _exceptions(excopday).filter(F.col("runs_as") != iso_dow("date").cast("string"))
    return _dates(days.join(other.select(*SCOPE, "date").distinct(), [*SCOPE, "date"], "left_anti"))


def calendar_exception(pegrval, tive, pujo, version, excopday, as_of: str) -> DataFrame:
    """Exception days, one row per (service, day) (O-C4): a day in EXCOPDAY runs
    the services of its version, owner and unit whose day type has its weekday."""
    ranges = service_ranges(pegrval, tive, pujo, version, as_of)
    days = interval_join(_exceptions(excopday), ranges, SCOPE, "date", "validfrom", "validthru", width=30)
    return _dates(days.filter(F.instr("daytype", F.col("runs_as")) > 0)).distinct()


def calendar_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """calendar_dates = regular UNION exception days (O-C5)."""
    return union_distinct(a, b)


def derive_schedvers(tive: DataFrame, pegrval: DataFrame, pujo: DataFrame) -> DataFrame:
    """SCHEDVERS from drive-time tables, one row per service (O-C6).

    The source gives no order for its DISTINCT ON; the tie is broken by the
    timetable version and the period validity.
    """
    t = tive.select("version", "dataownercode", "organizationalunitcode", "periodgroupcode", "specificdaycode",
                    F.col("timetableversioncode").alias("t_ttv"), F.col("validfrom").alias("t_from"),
                    F.col("validthru").alias("t_thru"))
    p = pegrval.select("version", "dataownercode", "organizationalunitcode", "periodgroupcode",
                       F.col("validfrom").alias("p_from"), F.col("validthru").alias("p_thru"))
    pu = pujo.select(*SERVICE7, "daytype").distinct()
    j = (
        t.join(p, ["version", "dataownercode", "organizationalunitcode", "periodgroupcode"])
        .filter(F.col("t_from") != F.col("p_from"))
        .join(pu, ["version", "dataownercode", "organizationalunitcode", "periodgroupcode", "specificdaycode"])
    )
    best = first_per(j, SERVICE7 + ["daytype"], ["t_ttv", "p_from", "t_from"])
    return best.select(
        "version", "dataownercode", "organizationalunitcode",
        F.col("periodgroupcode").alias("schedulecode"),
        F.col("daytype").alias("scheduletypecode"),
        F.col("t_from").alias("validfrom"),
        F.coalesce("t_thru", "p_thru").alias("validthru"),
        # a NULL part makes the description NULL
        F.concat(*[x for c in (*SERVICE7, "daytype") for x in (F.lit("-"), F.col(c).cast("string"))][1:]).alias("description"),
    )


def derive_operday(schedvers: DataFrame, sunday_first: bool = True) -> DataFrame:
    """OPERDAY from SCHEDVERS: every day of the range whose weekday digit is in the
    schedule type (O-C7).  The source numbers days 1 = Sunday here."""
    days = explode_range(schedvers, "validfrom", "validthru", "validdate")
    return days.filter(runs_on("scheduletypecode", "validdate", sunday_first=sunday_first)).select(
        "version", "dataownercode", "organizationalunitcode", "schedulecode", "scheduletypecode", "validdate")


DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def weekly_flags(operday: DataFrame, keys=("version", "dataownercode", "organizationalunitcode", "schedulecode",
                                           "scheduletypecode")) -> DataFrame:
    """GTFS ``calendar``: per service the weekdays on which it runs and its first/last day (O-C8)."""
    dow = iso_dow("validdate")
    aggs = [F.max(F.when(dow == i + 1, 1).otherwise(0)).alias(d) for i, d in enumerate(DAYS)]
    return operday.groupBy(*keys).agg(*aggs, F.min("validdate").alias("s"), F.max("validdate").alias("e")).select(
        key(*keys).alias("service_id"), *DAYS, yyyymmdd("s").alias("start_date"), yyyymmdd("e").alias("end_date"))


def footnote_bits(days: DataFrame, id_col: str, date_col: str, first_day, n_days) -> DataFrame:
    """Day sets -> validity bit strings (one character per day from ``first_day``)."""
    off = F.datediff(F.col(date_col), first_day)
    per = days.select(id_col, off.alias("off"), first_day.alias("firstday"), n_days.alias("ndays")).groupBy(
        id_col, "firstday", "ndays").agg(F.collect_set("off").alias("offs"))
    bits = F.concat_ws("", F.transform(F.sequence(F.lit(0), F.col("ndays") - 1),
                                       lambda i: F.when(F.array_contains("offs", i), "1").otherwise("0")))
    return per.select(id_col, "firstday", bits.alias("bits"))


def expand_footnotes(df: DataFrame, id_col: str, bits: str, firstday) -> DataFrame:
    """Validity bit string -> (id, date) for every '1' (O-S15)."""
    first = _c(firstday)
    return df.select(id_col, first.alias("__first"), F.posexplode(F.split(F.col(bits), "")).alias("pos", "bit")).filter(
        F.col("bit") == "1").select(id_col, F.date_add("__first", F.col("pos")).alias("servicedate"))


def calendar_footnote(footnote: DataFrame, prefix: str = "") -> DataFrame:
    """calendar_dates from footnotes (O-C2): IFF prefixes ``NS:``, PAS none."""
    return footnote.select(F.concat(F.lit(prefix), F.col("footnote").cast("string")).alias("service_id"),
                           yyyymmdd("servicedate").alias("date"), F.lit(1).alias("exception_type"))
