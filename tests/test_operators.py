"""Operator semantics on hand-made fixtures (brute force vs Spark)."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from gtfsforge.functions import geo
from gtfsforge.functions import timeofday as tod
from gtfsforge.operators import calendar as cal
from gtfsforge.operators import first as fo
from gtfsforge.operators import intervals as iv
from gtfsforge.operators import timegroups as tg
from gtfsforge.operators import versions
from gtfsforge.operators.corrections import Rule, correct, rule_counts
from gtfsforge.operators.first import key
from gtfsforge.operators.keygraph import cascade_all, load_order
from gtfsforge.plans.views import World

QUERIES = entry.queries()


RNT = ("version int, dataownercode string, lineplanningnumber string, journeypatterncode string, timedemandgroupcode int, timinglinkorder int, "
       "userstopcodebegin string, userstopcodeend string, totaldrivetime long, stopwaittime long")


def _spread(spark, groups):
    """Spread times of groups [(drive, distance), ...] as lists."""
    rows = [(1, "GVB", "1", str(g), 0, i + 1, f"S{g}_{i}", f"S{g}_{i + 1}", t, 0) for g, x in enumerate(groups) for i, (t, _) in enumerate(x)]
    links = [(1, f"S{g}_{i}", f"S{g}_{i + 1}", d) for g, x in enumerate(groups) for i, (_, d) in enumerate(x)]
    lk = spark.createDataFrame(links, "version int, userstopcodebegin string, userstopcodeend string, distance long")
    got = {(int(r.journeypatterncode), r.timinglinkorder): r.totaldrivetime for r in tg.spread_zero_times(spark.createDataFrame(rows, RNT), lk).collect()}
    return [[got[g, i + 1] for i in range(len(x))] for g, x in enumerate(groups)]


def test_spread_by_hand(spark):
    cases = [
        ([(60, 100), (0, 100), (90, 100)], [50, 50, 50]),  # a run between two times
        ([(60, 100), (0, 300)], [15, 45]),  # a run at the end
        ([(0, 100), (80, 300), (30, 5)], [20, 60, 30]),  # a run at the start, then an untouched link
        ([(10, 100), (0, 1), (31, 9900)], [4, 4, 33]),  # shares that round to nothing, the rest on the last link
        ([(60, 100), (0, 100), (60, 200), (0, 200), (40, 400)], [30, 30, 25, 25, 50]),  # a run's last link opens the next
        ([(60, 0), (0, 0), (30, 0)], [60, 0, 30]),  # no distance, no change
        ([(60, 7), (30, 9)], [60, 30]),
        ([(0, 5)], [4 - 4]),
    ]
    got = _spread(spark, [x for x, _ in cases])
    assert got == [y for _, y in cases]


def test_spread_properties(spark):
    rnd = random.Random(7)
    groups = [[(rnd.choice([0, 0, 30, 60, 120]), rnd.choice([10, 100, 400, 1000])) for _ in range(rnd.randint(1, 12))] for _ in range(500)]
    for x, y in zip(groups, _spread(spark, groups)):
        times = [t for t, _ in x]
        assert sum(y) == sum(times)
        if 0 not in times:
            assert y == times
        # a link that neither is zero nor lies next to one keeps its time
        for i, t in enumerate(times):
            if t and (i == 0 or times[i - 1]) and (i + 1 == len(x) or times[i + 1]):
                assert y[i] == t


def test_rollover_matches_sequential(spark):
    rnd = random.Random(5)
    data, expect = [], {}
    for trip in range(200):
        t = rnd.randint(20 * 60, 23 * 60 + 59)
        prev_adj = None
        for seq in range(rnd.randint(2, 8)):
            t = (t + rnd.randint(1, 40)) % (24 * 60)
            raw = f"{t // 60:02d}:{t % 60:02d}:00"
            adj = raw
            if prev_adj is not None and raw < prev_adj:
                adj = f"{int(raw[:2]) + 24}{raw[2:]}"
            prev_adj = adj
            data.append((trip, seq, raw))
            expect[(trip, seq)] = adj
    df = spark.createDataFrame(data, "trip int, seq int, t string")
    got = {(r.trip, r.seq): r.t for r in tg.rollover(df, ["trip"], "seq", "t").collect()}
    assert got == expect


def test_time_functions(spark):
    df = spark.createDataFrame([("23:59:30", "08:15"), ("25:01:00", None)], "a string, b string")
    r = df.select(tod.to_seconds("a").alias("s"), tod.add32time("a", F.lit(45)).alias("p"),
                  tod.fix_seconds("b").alias("f"), tod.to_seconds("b").alias("sb")).collect()
    assert (r[0].s, r[0].p, r[0].f, r[0].sb) == (86370, "24:00:15", "08:15:00", 29700)
    assert (r[1].s, r[1].p, r[1].f, r[1].sb) == (90060, "25:01:45", None, None)
    hh = spark.createDataFrame([("2350", "01012024")], "h string, d string").select(
        tod.hhmm("h").alias("h"), tod.ddmmyyyy("d").alias("d")).first()
    assert hh.h == "23:50:00" and hh.d == date(2024, 1, 1)


def test_geo_check_point(spark):
    df = spark.createDataFrame([(155000, 463000)], "x long, y long")
    r = geo.rd_to_wgs84(df, "x", "y").first()
    assert abs(r.lat - 52.1551723) < 2e-7 and abs(r.lon - 5.3872036) < 2e-7


def test_explode_range_guards(spark):
    df = spark.createDataFrame([(1, date(2024, 1, 3), date(2024, 1, 1)), (2, date(2024, 1, 1), date(2024, 1, 1)),
                                (3, date(2024, 1, 1), date(2024, 1, 3))], "id int, a date, b date")
    got = sorted((r.id, r.d.day) for r in cal.explode_range(df, "a", "b", "d").collect())
    assert got == [(2, 1), (3, 1), (3, 2), (3, 3)]


def test_not_in_is_null_aware(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(2,)], "k int")
    assert sorted(r.k for r in fo.not_in(left, right, ["k"]).collect()) == [1]
    right_null = spark.createDataFrame([(2,), (None,)], "k int")
    assert fo.not_in(left, right_null, ["k"]).count() == 0


def test_footnote_round_trip(spark):
    bits = spark.createDataFrame([(7, "1010011", date(2024, 1, 1))], "fn int, bits string, first date")
    got = sorted(r.servicedate.day for r in cal.expand_footnotes(bits, "fn", "bits", "first").collect())
    assert got == [1, 3, 6, 7]


def test_fix_seconds_by_the_arrival(spark):
    df = spark.createDataFrame([("08:00", "08:01"), ("08:00:00", "08:01"), (None, "08:01")], "a string, d string")
    got = [tuple(r) for r in df.select(tod.fix_seconds("a"), tod.fix_seconds("d", by="a")).collect()]
    assert got == [("08:00:00", "08:01:00"), ("08:00:00", "08:01"), (None, "08:01")]


def _intervals(spark, seed, dates):
    rnd = random.Random(seed)
    day = (lambda n: date.fromordinal(738000 + n)) if dates else (lambda n: n)
    points = [(rnd.choice(["a", "b", None]), day(rnd.randint(0, 500)) if rnd.random() > 0.05 else None, i) for i in range(400)]
    points += [("a", day(77), 1000 + i) for i in range(300)]  # a full bin
    ranges = [(rnd.choice(["a", "b", None]), day(x), day(x + rnd.choice([0, 1, 5, 30, -2])), i) for i, x in enumerate(rnd.randint(0, 500) for _ in range(150))]
    ranges += [("a", day(480), day(2_000_000), 900), ("b", None, day(3), 901), ("b", day(3), None, 902), ("a", day(77), day(77), 903)]
    kind = "date" if dates else "long"
    return points, ranges, spark.createDataFrame(points, f"k string, p {kind}, id int"), spark.createDataFrame(ranges, f"k string, lo {kind}, hi {kind}, rid int")


@pytest.mark.parametrize("dates,split_rows", [(True, 10**6), (False, 7)])
def test_interval_join_by_hand(spark, dates, split_rows):
    points, ranges, left, right = _intervals(spark, 3, dates)
    met = lambda p, r: None not in (p[0], p[1], r[0], r[1], r[2]) and p[0] == r[0] and r[1] <= p[1] <= r[2]
    pairs = sorted((p[2], r[3]) for p in points for r in ranges if met(p, r))
    join = lambda how, a=left, b=right: iv.interval_join(a, b, ["k"], "p", "lo", "hi", how, split_rows)
    assert sorted((r.id, r.rid) for r in join("inner").collect()) == pairs and join("inner").columns == ["k", "p", "id", "lo", "hi", "rid"]
    hit = {i for i, _ in pairs}
    assert sorted(r.id for r in join("semi").collect()) == sorted(hit)
    assert sorted(r.id for r in join("anti").collect()) == sorted(p[2] for p in points if p[2] not in hit)
    for a, b in ((left.limit(0), right), (left, right.limit(0))):
        assert join("inner", a, b).count() == 0 and join("anti", a, b).count() == a.count()


def test_merged_ranges_cover_the_same_days(spark):
    rnd = random.Random(8)
    rows = [(k, date.fromordinal(738000 + x), date.fromordinal(738000 + x + rnd.randint(-1, 9))) for k in range(5) for x in (rnd.randint(0, 90) for _ in range(12))]
    got = [tuple(r) for r in iv.merged_ranges(spark.createDataFrame(rows, "k int, a date, b date"), ["k"], "a", "b").collect()]
    days = lambda rs: sorted((k, d) for k, a, b in rs for d in range(a.toordinal(), b.toordinal() + 1))
    assert days(got) == sorted(set(days(rows)))
    assert all(not (k == l and a <= c <= b.replace() and (a, b) != (c, d)) for k, a, b in got for l, c, d in got)


def _calendar(spark, excop):
    d = lambda n: date(2024, 1, n)
    period = "version int, dataownercode string, organizationalunitcode string, periodgroupcode string, "
    pegrval = spark.createDataFrame([(1, o, "U1", "P", d(1), d(14)) for o in ("GVB", "HTM")], period + "validfrom date, validthru date")
    tive = spark.createDataFrame([(1, o, "U1", "TV", "P", "N", d(1), None) for o in ("GVB", "HTM")],
                                 "version int, dataownercode string, organizationalunitcode string, timetableversioncode string, periodgroupcode string, specificdaycode string, validfrom date, validthru date")
    # the journeys' own unit differs from the period's
    pujo = spark.createDataFrame([(1, o, "TV", "U9", "P", "N", t) for o in ("GVB", "HTM") for t in ("12345", "67")],
                                 "version int, dataownercode string, timetableversioncode string, organizationalunitcode string, periodgroupcode string, specificdaycode string, daytype string")
    version = spark.createDataFrame([(1, o, d(2), d(12)) for o in ("GVB", "HTM")], "version int, dataownercode string, validfrom date, validthru date")
    exc = spark.createDataFrame(excop, "version int, dataownercode string, organizationalunitcode string, validdate date, daytypeason int, specificdaycode string")
    out = [{(r.service_id, int(r.date[-2:])) for r in f(pegrval, tive, pujo, version, exc, "2024-01-04").collect()} for f in (cal.calendar_regular, cal.calendar_exception)]
    return out, pujo


def test_calendar_of_two_owners(spark):
    name = lambda o, t: f"1|{o}|TV|U9|P|N|{t}"
    # Monday 8 January 2024 runs as a Sunday, at GVB only; another unit's day says nothing
    (regular, exception), pujo = _calendar(spark, [(1, "GVB", "U9", date(2024, 1, 8), 7000001, "N"), (1, "GVB", "U8", date(2024, 1, 9), 7000001, "N"), (2, "GVB", "U9", date(2024, 1, 10), 7000001, "N")])
    week = {3, 4, 5, 8, 9, 10, 11, 12}
    assert regular == {(name("GVB", "12345"), d) for d in week - {8}} | {(name("HTM", "12345"), d) for d in week} | {(name(o, "67"), d) for o in ("GVB", "HTM") for d in (6, 7)}
    assert exception == {(name("GVB", "67"), 8)}
    journeys = {"|".join(str(x) for x in r) for r in pujo.select(*cal.SERVICE7, "daytype").collect()}
    assert {s for s, _ in regular | exception} <= journeys


def test_every_service_of_the_calendar_has_a_journey(spark):
    w = World(spark, "/root/testdata/sf0.001")
    journeys = w.kv_pujo.select(key(*cal.SERVICE7, "daytype").alias("service_id")).distinct()
    days = QUERIES["cal_union_c5"](spark, "/root/testdata/sf0.001")
    assert days.count() > 0 and days.join(journeys, "service_id", "left_anti").count() == 0


def test_rules_in_order(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "b", None), (3, None, 7), (4, "c", 9)], "id int, name string, n int")
    rules = [Rule("t", "swap", "n > 4 and name is not null", (("name", "cast(n as string)"), ("n", "length(name)"))), Rule("t", "gone", "n = 1 and name = '9'"),
             Rule("t", "after", "n = 1", (("name", "'one'"),)), Rule("t", "none", "name = 'zz'")]
    assert sorted(map(tuple, correct(df, rules).collect()), key=str) == [(1, "one", 1), (2, "b", None), (3, None, 7)]
    assert [tuple(r) for r in rule_counts(df, rules).collect()] == [("swap", 2), ("gone", 1), ("after", 1), ("none", 0)]


def test_cascade_by_hand(spark):
    graph = {"b": [("a", ["x"])], "c": [("b", ["x", "y"]), ("d", ["z"])], "e": [("c", ["w"])]}
    rows = {"a": [(1,), (2,)], "b": [(1, 1), (1, 2), (2, 1)], "c": [(1, 1, 5, 10), (2, 1, 5, 11), (2, 1, 6, 12)], "d": [(5,), (6,)], "e": [(10, 0), (11, 0), (12, 0), (None, 0)]}
    cols = {"a": "x int", "b": "x int, y int", "c": "x int, y int, z int, w int", "d": "z int", "e": "w int, v int"}
    tables = {k: spark.createDataFrame(v, cols[k]) for k, v in rows.items()}
    left = cascade_all(tables, graph, {"d": spark.createDataFrame([(6,)], "z int")}, {"a": spark.createDataFrame([(1,)], "x int")})
    assert list(left) == load_order(graph, rows) and {k: sorted(map(tuple, v.collect()), key=str) for k, v in left.items() if k != "a"} == {
        "b": [(2, 1)], "c": [(2, 1, 5, 11)], "d": [(5,)], "e": [(11, 0), (None, 0)]}
    with pytest.raises(ValueError):
        load_order({"a": [("b", [])], "b": [("a", [])]}, ["a"])


def test_purge_and_withdraw_reach_every_table(spark):
    w = World(spark, "/root/testdata/sf0.001")
    tables = {"version": w.kv_version, "operday": w.kv_operday, "pujopass": w.kv_pujopass, "usrstop": w.kv_usrstop}
    kept, gone, changed = versions.purge_tables(tables, "1998-07-25")
    ends = {(r.version, r.dataownercode): r.last for r in w.kv_operday.groupBy("version", "dataownercode").agg(F.max("validdate").alias("last")).collect()}
    out = {k for k, d in ends.items() if d < date(1998, 7, 24)}
    assert changed == bool(out) and {(r.version, r.dataownercode) for r in gone.collect()} == out
    for name in ("operday", "pujopass", "usrstop"):
        assert {tuple(r) for r in kept[name].select("version", "dataownercode").distinct().collect()} == set(ends) - out
    names = w.kv_version.where("filename like '%buzz%'").select("filename")
    left = versions.withdraw({k: tables[k] for k in ("operday", "pujopass")}, w.kv_version, names)
    assert {r.version for r in left["pujopass"].select("version").distinct().collect()} == {1, 3}
