"""Passings are put in order once, journeys meet by pattern once, and lines are written and parsed once."""

import io
import re
from contextlib import redirect_stdout
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gtfsforge.functions.timeofday import seconds_to_time, to_seconds
from gtfsforge.operators import timegroups as tg
from gtfsforge.plans import gtfs_iff
from gtfsforge.plans import gtfs_kv1 as gk
from gtfsforge.plans import views
from gtfsforge.plans.views import SPARK_VIEWS, World, spark_tables, with_clause
from gtfsforge.sources import kv1


def plan(df) -> str:
    with redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("rows")
    rows = []
    for k in (1, 2, 41, 121, 122, 4001, 4121, 9000):
        for i in range(1 + k % 5):
            rows.append((k, 10 + (k + i) % 6, 100 + (k * i) % 9, i % 3, float(i), 1.0, 0.0, 0.0, "RAN"[i % 3], "OF"[i % 2], datetime(1998, 1, 1 + i)))
    rows += rows[3:9]  # rows that come twice
    names = "l_orderkey long, l_suppkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(rows, names).write.parquet(f"{at}/lineitem.parquet")
    return World(spark, str(at))


@pytest.mark.parametrize("name", ["kv_passing_s", "kv_link", "kv_jopatili"])
def test_spark_views_have_the_rows_of_their_texts(spark, world, name):
    was = spark.sql(with_clause([name], spark_tables(world.sf_dir)) + f"SELECT * FROM {name}")
    now = getattr(world, name).select(*was.columns)
    assert name in SPARK_VIEWS and now.dtypes == was.dtypes
    assert sorted(map(str, now.collect())) == sorted(map(str, was.collect()))


def test_passings_are_sorted_once(world):
    assert plan(world.kv_pujopass).count(" Sort [") == 1 and plan(world.kv_link).count("Join") == 0


def test_journeys_meet_once_by_pattern(world):
    p = plan(tg.group_codes(tg.links(world.kv_pujopass)))
    assert "Join" not in p and len(re.findall(r"Exchange hashpartitioning", p)) == 2


def test_table_names_and_times(spark):
    paths = {"a/b/DESTX.TMI": "dest", r"c\USRSTOP.csv": "usrstop", "POINTX": "point", "in/": "", "x.y/LINE.Csv": "line", "BOXx.tmi": "boxx", "Xa.txt": "xa.txt"}
    df = spark.createDataFrame(list(paths.items()), "file string, want string")
    assert {r.file: r.t for r in df.select("file", kv1.table_of("file").alias("t")).collect()} == paths
    times = {"01:02:03": 3723, "1:2:3": 3723, "25:00": 90000, " 00:00:59 ": 59, "100:00:01": 360001, "10:20:": 37200, None: None}
    df = spark.createDataFrame([(t, s) for t, s in times.items()], "t string, s int")
    assert {r.t: r.x for r in df.select("t", to_seconds("t").alias("x")).collect()} == times
    shown = {0: "00:00:00", 3723: "01:02:03", 360001: "100:00:01", -1: "-1:-1:-1", None: None}
    df = spark.createDataFrame([(s,) for s in shown], "s int")
    assert {r.s: r.x for r in df.select("s", seconds_to_time("s").alias("x")).collect()} == shown


def test_groups_of_one_pattern(spark):
    def passing(j, i, stop, at, pattern="P"):
        return (1, "O", "U", "S", "T", "L", j, i, pattern, stop, at, at, None, True)

    rows = [passing(j, i, s, f"0{j}:0{i + (j == 3 and i == 2)}:00") for j in (1, 2, 3) for i, s in ((1, "a"), (2, "b"), (3, "c"))]
    rows += [passing(9, 1, "a", "09:00:00", None), passing(9, 2, "b", "09:01:00", None)]  # no pattern, no group
    names = "version int, dataownercode string, organizationalunitcode string, schedulecode string, scheduletypecode string, lineplanningnumber string, journeynumber long, stoporder int, journeypatterncode string, userstopcode string, targetarrivaltime string, targetdeparturetime string, wheelchairaccessible string, dataownerisoperator boolean"
    grp, rnt, pujo = tg.time_groups(spark.createDataFrame(rows, names))
    assert sorted(r.timedemandgroupcode for r in grp.collect()) == [0, 1]
    assert sorted((r.timedemandgroupcode, r.timinglinkorder, r.totaldrivetime) for r in rnt.collect()) == [(0, 1, 60), (0, 2, 60), (1, 1, 120), (1, 2, 0)]
    assert {r.journeynumber: (r.timedemandgroupcode, r.departuretime) for r in pujo.collect()} == {1: (0, "01:01:00"), 2: (0, "02:01:00"), 3: (1, "03:01:00")}
    coded = tg.group_codes(tg.links(spark.createDataFrame(rows, names))).where(F.col("journeynumber") == 3).first()
    assert [x.userstopcodeend for x in coded.signature] == ["b", "c"]


def compiled_sizes(df) -> list[int]:
    """Bytes of the longest method of each generated class; the JVM interprets a method of 8,000 and more."""
    was = df.sparkSession.conf.get("spark.sql.adaptive.enabled")
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan shows no classes before it has run
    try:
        with redirect_stdout(io.StringIO()) as out:
            df.select("*").explain("codegen")
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", was)
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]


def test_calls_of_drive_times_are_compiled(spark):
    pat = "version int, dataownercode string, lineplanningnumber string, journeypatterncode string"
    p = (1, "O", "L", "P")
    t = {
        "pujo": spark.createDataFrame([(*p, 0, "G", "7", 5, "23:59:30", True), (*p, 0, "G", "7", 6, None, False)], f"{pat}, timedemandgroupcode int, periodgroupcode string, daytype string, journeynumber long, departuretime string, dataownerisoperator boolean"),
        "timdempass": spark.createDataFrame([(*p, 0, 1, 60, 5), (*p, 0, 2, 200, 0)], f"{pat}, timedemandgroupcode int, timinglinkorder int, totaldrivetime long, stopwaittime long"),
        "jopatili": spark.createDataFrame([(*p, 1, "a", "b", "D1", 1), (*p, 2, "b", "c", "D2", 2)], f"{pat}, timinglinkorder int, userstopcodebegin string, userstopcodeend string, destcode string, productformulatype int"),
        "dest": spark.createDataFrame([(1, "O", "D1", "One"), (1, "O", "D2", "Two")], "version int, dataownercode string, destcode string, destnamefull string"),
        "usrstop": spark.createDataFrame([(1, "O", s, True, s != "b", "PASSENGER") for s in "abc"], "version int, dataownercode string, userstopcode string, getin boolean, getout boolean, userstoptype string"),
    }
    df = gk.stop_times_drivetime(t)
    assert max(compiled_sizes(df)) < 8000
    assert sorted((r.trip_id[-1], r.stop_sequence, r.stop_id, r.stop_headsign, r.arrival_time, r.departure_time, r.pickup_type, r.drop_off_type) for r in df.collect() if r.arrival_time) == [
        ("5", 1, "O|a", None, "23:59:30", "23:59:30", 0, 0), ("5", 2, "O|b", "Two", "24:00:30", "24:00:35", 3, 3), ("5", 3, "O|c", "Two", "24:02:50", "24:02:50", 3, 3)]
    assert sum(r.arrival_time is None for r in df.collect()) == 2


def test_links_are_put_together_in_their_order(world):
    p = plan(tg.cumulate(tg.time_groups(world.kv_pujopass)[1]))
    assert "HashAggregate" not in p and len(re.findall(r"Exchange hashpartitioning", p)) == 2


def test_groups_and_journeys_share_a_shuffle(world):
    _, rnt, pujo = tg.time_groups(world.kv_pujopass, together=True)
    both = rnt.join(pujo, [*tg.TDG_PK, "timedemandgroupcode"])
    _, rnt1, pujo1 = tg.time_groups(world.kv_pujopass)
    assert sorted(map(str, both.collect())) == sorted(map(str, rnt1.join(pujo1, [*tg.TDG_PK, "timedemandgroupcode"]).collect()))
    assert re.search(r"ReusedExchange.*journeypatterncode", plan(both).split("Initial Plan")[0])


def test_few_first_journeys_leave_the_lines_where_they_are(world):
    p = plan(world.kv_jopatili)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_large_tables_meet_in_more_partitions(spark, world, monkeypatch):
    assert world.parts("lineitem") is None
    monkeypatch.setattr(views, "ROWS", 1)
    n = world.parts("lineitem")
    assert n == world.table("lineitem").count() > spark.sparkContext.defaultParallelism
    p = plan(tg.time_groups(world.kv_pujopass, parts=n)[1])
    assert re.search(rf"hashpartitioning\(journeypatterncode.*, {n}\), REPARTITION_BY_NUM", p)


def test_stops_of_services_meet_twice(spark):
    def table(rows, names):
        return spark.createDataFrame(rows, names)

    t = {
        "service": table([(1, 100, 11, None, 1, 2), (1, 100, 12, None, 3, 3), (2, 100, 21, None, 1, 2)], "serviceid int, companynumber int, servicenumber int, variant string, firststop int, laststop int"),
        "transport": table([(1, "IC", 1, 3)], "serviceid int, transmode string, firststop int, laststop int"),
        "attribute": table([(1, "NIIN", 1, 2), (1, "NIIN", 2, 2), (1, "NUIT", 2, 2)], "serviceid int, code string, firststop int, laststop int"),
        "stop": table([(1, 1, "a", None, "01:00:00"), (1, 2, "b", "01:05:00", "01:06:00"), (1, 3, "c", "01:09:00", None), (2, 1, "a", None, "02:00:00"),
                       (2, 1, "a", None, "02:00:00"), (None, 1, "x", None, "03:00:00"), (None, 1, "y", None, "03:00:00")], "serviceid int, idx int, station string, arrivaltime string, departuretime string"),
        "platform": table([(1, 2, "b", "1a", "2a", 1)], "serviceid int, idx int, station string, arrival string, departure string, footnote int"),
        "validity": table([(1, 7, None, 999), (2, 8, None, 999)], "serviceid int, footnote int, firststop int, laststop int"),
    }
    got = gtfs_iff.stop_times_iff(t)
    rows = sorted(tuple(map(str, r)) for r in got.collect())
    assert rows == sorted([
        ("1|7|11", "01:00:00", "01:00:00", "a|0", "None", "1", "1", "0"), ("1|7|11", "01:05:00", "01:06:00", "b|2a", "b|1a", "2", "1", "1"),
        ("1|7|12", "01:09:00", "01:09:00", "c|0", "None", "1", "0", "0"), ("2|8|21", "02:00:00", "02:00:00", "a|0", "None", "1", "0", "0"),
        ("2|8|21", "None", "02:00:00", "a|0", "None", "2", "0", "0"), ("None", "None", "None", "None", "None", "1", "0", "0")])
    # what is known of a stop is joined once, the stops themselves never
    assert len(re.findall(r"(?:SortMerge|BroadcastHash)Join", plan(gtfs_iff.stop_times_iff(t)))) == 4


@pytest.fixture(scope="module")
def places(spark, tmp_path_factory):
    """Passings with null stops, parts and journeys, rows that come twice, and links that journeys drive again."""
    at = tmp_path_factory.mktemp("places")
    rows = []
    for k in (1, 2, 3, 4, 41, 121, 122, 4001, 4121, None):
        for i in range(2 + (k or 1) % 4):
            stop = None if (k, i) in ((2, 1), (122, 0)) else 1 + ((k or 7) + i) % 5
            rows.append((k, stop, None if (k, i) == (3, 0) else 1 + ((k or 5) * 3 + i) % 7, i % 2, float(-i), 1.0, 0.0, 0.0, "RAN"[i % 3], "OF"[i % 2], datetime(1998, 1, 9 - i)))
    rows += [rows[0], rows[5], rows[-1]]
    names = "l_orderkey long, l_suppkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(rows, names).write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame([(s, f"Stop {s}", s % 3) for s in (1, 2, 3, 4, 4, 9)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{at}/supplier.parquet")
    spark.createDataFrame([(p,) for p in (1, 2, 2, 3, 4, 5, 6, None)], "p_partkey long").write.parquet(f"{at}/part.parquet")
    spark.createDataFrame([(c, c % 3, f"Line {c}", ("AUTOMOBILE", "BUILDING", "MACHINERY")[c % 3]) for c in range(1, 300)],
                          "c_custkey long, c_nationkey int, c_name string, c_mktsegment string").write.parquet(f"{at}/customer.parquet")
    spark.createDataFrame([(n, f"Nation {n}") for n in range(3)], "n_nationkey int, n_name string").write.parquet(f"{at}/nation.parquet")
    spark.createDataFrame([(1, 1, "O", datetime(1998, 1, 1))], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp").write.parquet(f"{at}/orders.parquet")
    return World(spark, str(at))


@pytest.mark.parametrize("name", ["kv_usrstop", "kv_point", "kv_jopatili", "kv_pool_link", "kv_pool", "kv_point_all"])
def test_views_of_shapes_have_the_rows_of_their_texts(spark, places, name):
    def rows(df):
        links = df.select([c for c in was.columns if c in KEPT.get(name, was.columns)])
        return sorted(map(str, links.collect()))

    # a journey that drives a link twice may give it either part by the text, so those columns are compared in the next test
    KEPT = {"kv_pool_link": ["version", "dataownercode", "userstopcodebegin", "userstopcodeend", "linkvalidfrom"], "kv_pool": ["version", "dataownercode", "userstopcodebegin", "userstopcodeend"]}
    was = spark.sql(with_clause([name], spark_tables(places.sf_dir)) + f"SELECT * FROM {name}")
    now = getattr(places, name).select(*was.columns)
    assert name in SPARK_VIEWS and now.dtypes == was.dtypes and rows(now)
    assert rows(now) == rows(was)


def test_a_link_is_of_its_first_journey(spark, tmp_path):
    row = lambda k, i, stop, part: (k, stop, part, i, 0.0, 1.0, 0.0, 0.0, "R", "O", datetime(1998, 1, 1))
    rows = [row(7, 0, 1, 11), row(7, 1, 2, 12), row(1, 0, 1, 13), row(1, 1, 2, 14), row(1, 2, 1, 15), row(1, 3, 2, 16), row(13, 0, None, 17), row(13, 1, 2, 18)]
    names = "l_orderkey long, l_suppkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    w = World(spark, str(tmp_path))
    assert {(r.userstopcodebegin, r.userstopcodeend): (r.pk, r.d, r.transporttype) for r in w.kv_pool_link.collect()} == {
        ("S1", "S2"): (13, 100 + 13 * 37 + 14, "TRAM"), ("S2", "S1"): (14, 100 + 14 * 37 + 15, "BUS"), (None, "S2"): (17, 100 + 17 * 37 + 18, "TRAM")}
    assert sorted((r.pointcode, r.distancesincestartoflink) for r in w.kv_pool.where("userstopcodebegin = 'S1'").collect()) == [("P13", 297), ("S1", 0), ("S2", 595)]


@pytest.mark.parametrize("name", ["gtfs_shapes_rank_g4", "gtfs_shapes_rownum_g4"])
def test_shapes_put_links_in_order_once(spark, places, name):
    from gtfsforge.plans.registry import QUERIES

    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the plan shows which exchanges are read again
    try:
        p = plan(QUERIES[name](spark, places.sf_dir)).splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    links = [x for x in p if re.search(r" (Exchange|ReusedExchange) .*hashpartitioning\(userstopcodebegin\S+ userstopcodeend", x)]
    assert sum("WindowGroupLimit" in x and "Partial" in x and "userstopcodebegin" in x for x in p) == 1, "pool and points share the links"
    assert links and not any("l_extendedprice" in x for x in p)
    # links that no pattern uses go before they become points
    assert "LeftSemi" in p[next(i for i, x in enumerate(p) if "Generate inline" in x) + 1]


def test_shapes_of_few_links(spark):
    jt = spark.createDataFrame([(1, "O", "L", "P", 1, "a", "b"), (1, "O", "L", "P", 2, "b", "c"), (1, "O", "T", "Q", 1, "a", "b"), (1, "O", "X", "R", 1, "a", "b"), (1, "O", "L", "N", 1, None, "b")],
                               "version int, dataownercode string, lineplanningnumber string, journeypatterncode string, timinglinkorder int, userstopcodebegin string, userstopcodeend string")
    pool = spark.createDataFrame([(1, "O", b, e, "O", p, d, t) for b, e, p, d, t in (("a", "b", "a", 0, "BUS"), ("a", "b", "p", 0, "BUS"), ("a", "b", "b", 9, "BUS"), ("b", "c", "b", 0, "TRAM"), ("b", "c", "nowhere", 3, "TRAM"), ("c", "d", "p", 0, "BUS"), (None, "b", "p", 0, "BUS"))],
                                 "version int, dataownercode string, userstopcodebegin string, userstopcodeend string, pointdataownercode string, pointcode string, distancesincestartoflink int, transporttype string")
    points = spark.createDataFrame([(1, "O", c, 150000 + i * 1000, 460000) for i, c in enumerate("apbq")], "version int, dataownercode string, pointcode string, locationx_ew long, locationy_ns long")
    line = spark.createDataFrame([(1, "O", "L", "BUS"), (1, "O", "T", "TRAIN")], "version int, dataownercode string, lineplanningnumber string, transporttype string")
    t = {"jopatili": jt, "pool": pool, "point_all": points, "line": line}
    seqs = lambda **how: sorted((r.shape_id, r.shape_pt_sequence) for r in gk.shapes(t, **how).collect())
    assert seqs(ties="rank", match_transport=False, exclude_train=True) == [("1|O|L|P", 1), ("1|O|L|P", 1), ("1|O|L|P", 3), ("1|O|L|P", 4)]
    assert seqs() == [("1|O|L|P", 1), ("1|O|L|P", 2), ("1|O|L|P", 3)]


def test_journeys_are_expanded_where_they_meet(spark):
    pat = "version int, dataownercode string, lineplanningnumber string, journeypatterncode string"
    keys = {"P": (1, "O", "L", "P"), "Q": (1, "O", "L", "Q"), "N": (1, "O", None, "N"), "E": (1, "O", "L", "E")}
    pujo = [("P", 0, 5, "23:59:30"), ("P", 0, 5, "23:59:30"), ("P", 1, 5, "23:59:30"), ("P", None, 6, "1:2:3"), ("P", 9, 7, "02:00:00"), ("P", 0, 8, None),
            ("Q", 0, 9, "03:00:00"), ("N", 0, 10, "04:00:00"), ("E", 0, 11, "05:00:00"), ("P", 0, None, "06:00:00")]
    passes = [("P", 0, 1, "b", 60, 5), ("P", 0, 2, "c", 200, None), ("P", 0, 2, "c", 200, None), ("P", 1, 1, "b", 60, 5), ("P", 1, 2, "d", None, 0), ("P", 0, -1, "a", 0, 0),
              ("P", None, 1, "x", 1, 1), ("N", 0, 1, "x", 1, 1), ("Q", 0, 1, None, 30, 0)]
    firsts = [("P", 2, "z"), ("P", 1, "a"), ("E", 1, None), ("N", 1, "n")]
    hms = lambda s: f"{s // 3600:02}:{s // 60 % 60:02}:{s % 60:02}"
    want = set()
    for p, group, journey, at in pujo:
        row = lambda order, stop, arr, dep: (journey, p, order, stop, arr, dep)
        begin = sorted((o, s) for q, o, s in firsts if q == p)
        if p != "N" and begin:
            want.add(row(1, begin[0][1], at, at))
        start = at and sum(int(x) * y for x, y in zip(at.split(":"), (3600, 60, 1)))
        for q, g, order, stop, total, wait in passes if p != "N" and group is not None else []:
            if (q, g) == (p, group):
                arr = None if None in (start, total) else hms(start + total)
                want.add(row(order + 2, stop, arr, None if arr is None or wait is None else hms(start + total + wait)))
    got = tg.expand_journeys(
        spark.createDataFrame([(*keys[p], g, "U", "G", "7", j, at, "W", True) for p, g, j, at in pujo], f"{pat}, timedemandgroupcode int, organizationalunitcode string, periodgroupcode string, daytype string, journeynumber long, departuretime string, wheelchairaccessible string, dataownerisoperator boolean"),
        spark.createDataFrame([(*keys[p], o, s) for p, o, s in firsts], f"{pat}, timinglinkorder int, userstopcodebegin string"),
        spark.createDataFrame([(*keys[p], *x) for p, *x in passes], f"{pat}, timedemandgroupcode int, timinglinkorder int, userstopcodebegin string, totaldrivetime long, stopwaittime long"), 3)
    rows = got.collect()
    assert {(r.journeynumber, r.journeypatterncode, r.stoporder, r.userstopcode, r.targetarrivaltime, r.targetdeparturetime) for r in rows} == want and len(rows) == len(want)
    # no passing is shuffled
    assert not re.search(r"Exchange hashpartitioning\([^)]*targetarrivaltime", plan(got))


def test_expanded_journeys_read_the_lines_once(spark, places, tmp_path):
    from gtfsforge.plans.registry import QUERIES

    places.table("lineitem").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, k, "O", "2-HIGH", datetime(1998, 1, 1)) for k in (1, 2, 3, 41)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the plan shows which exchanges are read again
    try:
        p = plan(QUERIES["tdg_expand_t13"](spark, str(tmp_path)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)
    assert len(re.findall(r"FileScan parquet.*l_extendedprice", p)) == 1 and "ReusedExchange" in p
