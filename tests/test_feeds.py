"""Whole feeds written from the sf0.001 world: every file present with its GTFS header, trips sorted."""

import csv
import os

from gtfsforge import sinks
from gtfsforge.plans import feeds
from gtfsforge.plans import registry as reg
from gtfsforge.plans.queries_iff import tables as iff_tables
from gtfsforge.plans.views import World

SF = "/root/testdata/sf0.001"


def _header(f):
    with open(f, newline="") as x:
        return x.readline().strip()


def _rows(f):
    with open(f, newline="", encoding="utf-8") as x:
        return list(csv.reader(x))[1:]


def test_kv1_passing_feed(spark, tmp_path):
    w = World(spark, SF)
    t = reg.kv1_tables(w)
    t.update(pool=w.kv_pool, point_all=w.kv_point_all)
    feeds.write_kv1_passing_feed(t, str(tmp_path), reg.AS_OF, reg.PUBLISHER)
    assert _header(tmp_path / "stop_times.txt") == ("trip_id,arrival_time,departure_time,stop_id,stop_headsign,"
                                                "stop_sequence,pickup_type,drop_off_type")
    trips = [r[2] for r in _rows(tmp_path / "trips.txt")]
    assert trips == sorted(trips) and len(trips) == reg.QUERIES["gtfs_trips_passing_b9"](spark, SF).count()
    for name in ("agency", "feed_info", "stops", "routes", "calendar_dates", "shapes"):
        assert os.path.getsize(tmp_path / f"{name}.txt") > 0
    rejected = sorted(n for n in os.listdir(tmp_path / "rejected") if not n.endswith(".crc"))
    assert rejected == [f"{n}.txt" for n in ("agency", "routes", "stop_times", "stops", "trips")]
    assert all(_rows(tmp_path / "rejected" / n) == [] for n in rejected)
    assert not [n for n in os.listdir(tmp_path) if n.startswith(".staging")]


def test_drivetime_iff_pas_feeds(spark, tmp_path):
    w = World(spark, SF)
    t = reg.drive_tables(w)
    t.update(timdemrnt=reg.compressed(w)[1], pegrval=w.kv_pegrval, tive=w.kv_tive, excopday=w.kv_excopday)
    feeds.write_kv1_drivetime_feed(t, w.kv_link, str(tmp_path / "dt"), reg.AS_OF, reg.PUBLISHER)
    assert _header(tmp_path / "dt" / "calendar_dates.txt") == "service_id,date,exception_type"
    feeds.write_iff_feed(iff_tables(w), str(tmp_path / "iff"), reg.AS_OF, reg.PUBLISHER)
    assert _header(tmp_path / "iff" / "transfers.txt").startswith("from_stop_id,to_stop_id")
    pt = {"pujo": w.pas_pujo, "pujopass": w.pas_pujopass, "stops": w.pas_stops, "voetnoot": w.pas_voetnoot,
          "linepublicnumber": w.pas_linepublicnumber}
    feeds.write_pas_feed(pt, str(tmp_path / "pas"), reg.AS_OF, reg.PUBLISHER)
    st = _rows(tmp_path / "pas" / "stop_times.txt")
    keys = [(r[0], int(r[4])) for r in st]
    assert keys == sorted(keys)


def test_file_is_in_order_and_replaces_what_was_there(spark, tmp_path):
    out = str(tmp_path / "feed")
    rows = [(f"t{i % 997:04d}", i // 997, f'say "{i}", then\nstop' if i % 50 == 0 else (None if i % 3 == 0 else f" é{i} ")) for i in range(20_000)]
    df = spark.createDataFrame(rows, "trip_id string, stop_sequence int, note string").repartition(9)
    os.makedirs(out + "/.staging-stop_times/rows/__rejected=false")  # what an attempt that died has left
    for f in (out + "/.staging-stop_times/rows/__rejected=false/part-00000", out + "/stop_times.txt"):
        with open(f, "w") as x:
            x.write("half a row")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_gtfs(df, out, "stop_times", key=["trip_id", "stop_sequence"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert _header(out + "/stop_times.txt") == "trip_id,stop_sequence,note"
    assert _rows(out + "/stop_times.txt") == [[a, str(b), c or ""] for a, b, c in sorted(rows, key=lambda r: r[:2])]
    with open(out + "/stop_times.txt", "rb") as x:
        assert x.read().endswith(b"\n")


def test_repeated_and_null_keys_are_rejected_beside_the_file(spark, tmp_path):
    rows = [("b", 2), ("a", 1), ("b", 1), (None, 3), ("c", 9), ("b", 2)]
    sinks.write_gtfs(spark.createDataFrame(rows, "route_id string, n int"), str(tmp_path), "routes", key=["route_id"])
    assert _rows(tmp_path / "routes.txt") == [["a", "1"], ["b", "1"], ["c", "9"]]
    assert _rows(tmp_path / "rejected" / "routes.txt") == [["", "3"], ["b", "2"], ["b", "2"]]
    sinks.write_gtfs(sinks.empty_gtfs(spark, "shapes"), str(tmp_path), "shapes", sort=["shape_id"])
    assert (tmp_path / "shapes.txt").read_text() == "shape_id,shape_pt_lat,shape_pt_lon,shape_pt_sequence\n"


def test_key_check_needs_no_shuffle_beside_the_range_partitioning(spark):
    plan = sinks.mark_repeats(spark.range(100).selectExpr("id % 7 as a", "id as b"), ["a"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in plan
