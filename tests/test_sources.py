"""Sources and sinks on hand-made micro fixtures."""

import io
import zipfile
from datetime import date

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from gtfsforge import sinks
from gtfsforge.sources import kv1, tagged

IFF = ("@100,01012024,07012024,0001,demo\r\n#00000001\r\n%100,01234,      ,001,003,\r\n-00001,000,999\r\n"
       "&IC  ,001,003\r\n*NIIN,003,003,00000\r\n>asd    ,2350\r\n?5a   ,5a   ,00001\r\n.ut     ,0012\r\n<ehv    ,0055\r\n")


def test_iff_micro_fixture(spark, tmp_path):
    p = tmp_path / "timetbls.dat"
    p.write_bytes(IFF.encode("cp1252"))
    lines = tagged.read_tagged(spark, str(p))
    t = tagged.iff_timetable(lines)
    stops = sorted((r.idx, r.station, r.arrivaltime, r.departuretime) for r in t["stop"].collect())
    assert stops == [(1, "asd", None, "23:50:00"), (2, "ut", "00:12:00", "00:12:00"), (3, "ehv", "00:55:00", None)]
    svc = t["service"].first()
    assert (svc.serviceid, svc.companynumber, svc.servicenumber, svc.variant, svc.laststop) == (1, 100, 1234, None, 3)
    plat = t["platform"].first()
    assert (plat.idx, plat.station, plat.arrival) == (1, "asd", "5a")
    assert t["attribute"].first().code == "NIIN"
    d = tagged.iff_delivery(lines).first()
    assert d.company == 100 and d.versionnumber == 1


def test_pas_rollover(spark, tmp_path):
    p = tmp_path / "RET.PAS"
    p.write_bytes("!RETPAS1\r\n#M,RET,001,1,00042\r\n-00001\r\n>A,2350\r\n+B,2359,0001\r\n<C,0010\r\n".encode("cp1252"))
    pujo, passes = tagged.pas_journeys(tagged.read_tagged(spark, str(p)))
    got = sorted((r.stopsequentie, r.halteid, r.aankomsttijd, r.vertrektijd) for r in passes.collect())
    assert got == [(1, "A", None, "23:50:00"), (2, "B", "23:59:00", "24:01:00"), (3, "C", "24:10:00", None)]
    assert pujo.first().voetnoot == "00001"


def test_kv1_reader_header_and_profile(spark, tmp_path):
    d = tmp_path / "kv1"
    d.mkdir()
    (d / "DESTX.csv").write_text("[Recordtype]|Version_Number|Implicit|DataOwnerCode|DestCode|DestNameFull\n"
                                 "DEST|1|I|GVB|D1|Centraal Station\nDEST|1|I|GVB|D2|\n")
    (d / "LINE.TMI").write_text("LINE|1|I|GVB|001|1\n")
    schema = StructType([StructField("tablename", StringType()), StructField("version", IntegerType()),
                         StructField("implicit", StringType()), StructField("dataownercode", StringType()),
                         StructField("destcode", StringType()), StructField("destnamefull", StringType()),
                         StructField("relevantdestnamedetail", StringType())])
    df = kv1.read_kv1(spark, str(d), "dest", schema, owner="GVB", profile_absent=["relevantdestnamedetail"])
    rows = sorted((r.destcode, r.destnamefull, r.relevantdestnamedetail) for r in df.collect())
    assert rows == [("D1", "Centraal Station", None), ("D2", None, None)]


def test_archives_nested(spark, tmp_path):
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("USRSTOP.TMI", "x")
    outer = tmp_path / "feed.zip"
    with zipfile.ZipFile(outer, "w") as z:
        z.writestr("DEST.TMI", "y")
        z.writestr("Csv.zip", inner.getvalue())
    got = sorted(r.member for r in kv1.expand_archives(spark, str(outer)).collect())
    assert got == ["Csv.zip!USRSTOP.TMI", "DEST.TMI"]


def test_index_selection(spark):
    idx = spark.createDataFrame([("a", 2, "true", "true", 1, "2024-01-02"), ("b", 1, "true", "false", 2, "2024-01-01"),
                                 ("c", 1, "false", "false", 0, "2024-01-03")],
                                "key string, versie int, isgepubliceerd string, isbaseline string, index int, "
                                "publicatiedatum string")
    ver = spark.createDataFrame([("a", 1)], "filename string, dataownerversion int")
    pur = spark.createDataFrame([("b", 1)], "filename string, dataownerversion int")
    assert sorted(r.key for r in kv1.new_deliveries(idx, ver, pur).collect()) == ["a"]
    old = idx.filter("key = 'a'").withColumn("versie", F.lit(2))
    assert sorted(r.key for r in kv1.index_diff(old, idx).collect()) == ["b", "c"]
    assert [r.key for r in kv1.load_order(idx, forced_baseline=("b",)).collect()] == ["a", "b", "c"]
    assert [r.key for r in kv1.load_order(idx).collect()] == ["a", "c", "b"]


def test_write_gtfs_and_empty(spark, tmp_path):
    df = spark.createDataFrame([("1", None, 3)], "service_id string, date string, exception_type int")
    sinks.write_gtfs(df, str(tmp_path), "calendar_dates")
    assert (tmp_path / "calendar_dates.txt").read_text().splitlines() == ["service_id,date,exception_type", "1,,3"]
    assert sinks.empty_gtfs(spark, "transfers").columns == sinks.GTFS_COLUMNS["transfers"]
    st, dup = sinks.assemble_stop_times(spark.createDataFrame([("t", 1)], "trip_id string, stop_sequence int"),
                                        spark.createDataFrame([("t", 1)], "trip_id string, stop_sequence int"))
    assert st.count() == 2 and dup.first().n == 2


def test_iff_grouped_files(spark, tmp_path):
    tz = tmp_path / "timezone.dat"
    tz.write_bytes("@100,01012024,07012024,0001,demo\r\n#01\r\n-01,01012024,31032024\r\n+02,01042024,31102024\r\n"
                   .encode("cp1252"))
    got = sorted((r.tznumber, r.difference, str(r.firstday)) for r in
                 tagged.iff_groups(tagged.read_tagged(spark, str(tz)), "timezone").collect())
    assert got == [(1, -1, "2024-01-01"), (1, 2, "2024-04-01")]
    aq = tmp_path / "trnsaqst.dat"
    aq.write_bytes("#BAR ,1,Restaurant on board?\r\n-BAR\r\n-RESD\r\n#FIET,0,Bikes?\r\n-FIET\r\n".encode("cp1252"))
    rows = sorted((r.code, r.inclusive, r.question, r.transattr) for r in
                  tagged.iff_groups(tagged.read_tagged(spark, str(aq)), "trnsaqst").collect())
    assert rows == [("BAR", True, "Restaurant on board?", "BAR"), ("BAR", True, "Restaurant on board?", "RESD"),
                    ("FIET", False, "Bikes?", "FIET")]
    fn = tmp_path / "footnote.dat"
    fn.write_bytes("#00001\r\n1001\r\n#00002\r\n0110\r\n".encode("cp1252"))
    got = sorted((r.footnote, r.servicedate.day) for r in
                 tagged.iff_groups(tagged.read_tagged(spark, str(fn)), "footnote", firstday="2024-01-01").collect())
    assert got == [(1, 1), (1, 4), (2, 2), (2, 3)]
    stations = tmp_path / "stations.dat"
    stations.write_bytes("@100,01012024,07012024,0001,demo\r\n0,asd    ,03,00,NL ,0,0,12100,48700,Amsterdam Centraal\r\n"
                         .encode("cp1252"))
    st = tagged.iff_list(tagged.read_tagged(spark, str(stations)), "stations").first()
    assert (st.trainchanges, st.shortname, st.layovertime, st.timezone, st.x, st.name) == (
        None, "asd", 180, None, 121000, "Amsterdam Centraal")


def _lines(spark, *files):
    rows = [(name, i, x[0], x[1:]) for name, text in files for i, x in enumerate(text)]
    return spark.createDataFrame(rows, "file string, pos long, tag string, body string")


def test_iff_changes_and_lists_from_real_lines(spark):
    got = tagged.iff_groups(_lines(spark, ("changes", ["#asd    ", "-00123,00456,1", "-00456,00789,2"])), "changes").collect()
    assert sorted(tuple(r) for r in got) == [("asd", 123, 456, 1), ("asd", 456, 789, 2)]
    r = tagged.iff_list(_lines(spark, ("trnsattr", ["FIET,0001,Meenemen fiets"])), "trnsattr").first()
    assert (r.code, r.processingcode, r.description) == ("FIET", 1, "Meenemen fiets")
    r = tagged.iff_list(_lines(spark, ("connmode", ["B   ,2,Bus"])), "connmode").first()
    assert (r.code, r.connectiontype, r.description) == ("B", 2, "Bus")


def test_platforms_of_two_files_with_the_same_service(spark):
    block = ["#00000001", ">asd    ,0900", "?2a,2a,00001", "<ut     ,0930", "?5 ,7 ,00001"]
    t = tagged.iff_timetable(_lines(spark, ("one", block), ("two", block)))
    got = sorted((r.file, r.idx, r.station, r.arrival, r.departure) for r in t["platform"].collect())
    assert got == [(f, i, s, a, d) for f in ("one", "two") for i, s, a, d in ((1, "asd", "2a", "2a"), (2, "ut", "5", "7"))]
    assert sorted(r.file for r in t["stop"].collect()) == ["one", "one", "two", "two"]


def test_pas_validity_format_and_footnotes(spark):
    lines = _lines(spark, ("RET.PAS", ["!RETPAS1", "&01012024-31012024"]), ("OLD.PAS", ["!RETPAS0"]))
    assert [(r.file, str(r.firstday), str(r.lastday)) for r in tagged.pas_validity(lines).collect()] == [("RET.PAS", "2024-01-01", "2024-01-31")]
    assert [(r.file, r.format) for r in tagged.pas_bad_format(lines).collect()] == [("OLD.PAS", "RETPAS0")]
    got = tagged.pas_footnotes(_lines(spark, ("RET.VTN", ["@00007,0101", "@00008,1000"])), "2024-01-01").collect()
    assert sorted((r.voetnoot, r.datum.day) for r in got) == [("00007", 2), ("00007", 4), ("00008", 1)]


def test_delivery_meta_skips_header_and_bad_dates(spark):
    text = ["[Recordtype]|Version_Number|I|Owner|a|b|c|ValidDate", "OPERDAY|1|I|GVB|U|S|T|2024-01-03|x", "OPERDAY|1|I|GVB|U|S|T|2024-01-01", "OPERDAY|1|I|GVB|U|S|T|soon", "short|1"]
    r = kv1.delivery_meta(spark.createDataFrame([(x,) for x in text], "value string")).collect()
    assert [(x.dataownercode, str(x.validfrom), str(x.validthru)) for x in r] == [("GVB", "2024-01-01", "2024-01-03")]
    assert kv1.not_expired(kv1.delivery_meta(spark.createDataFrame([(text[1],)], "value string")), "2024-01-04").count() == 1
    assert kv1.not_expired(kv1.delivery_meta(spark.createDataFrame([(text[1],)], "value string")), "2024-01-05").count() == 0


def test_conform(spark):
    raw = spark.createDataFrame([(" 001 ", "t", "", "12")], "code string, flag string, name string, n string")
    schema = StructType([StructField("code", StringType()), StructField("flag", __import__("pyspark.sql.types",
                         fromlist=["BooleanType"]).BooleanType()), StructField("name", StringType()),
                         StructField("n", IntegerType()), StructField("missing", DateType())])
    r = kv1.conform(raw, schema).first()
    assert (r.code, r.flag, r.name, r.n, r.missing) == ("001", True, None, 12, None)


def test_lines_that_do_not_parse_are_reported(spark):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("tablename string, version int, name string, day date, ok boolean, extra string")
    lines = [("d/LINEX.TMI", 0, "Tablename|Version_Number|..."), ("d/LINEX.TMI", 1, 'LINE|1|"a|b ""c"""|2024-01-02|true'), ("d/LINEX.TMI", 2, "LINE|x| n |2024-01-02|f"), ("d/LINEX.TMI", 3, "LINE|1"),
             ("d/LINEX.TMI", 4, "LINE|2| n ||"), ("d/LINEX.TMI", 5, "LINE|2|n|2024-02-30|maybe"), ("d/LINEX.TMI", 6, "  "), ("d/DEST.csv", 1, "DEST|1|x|2024-01-01|t"), ("line.csv", 7, "LINE|3|n|2024-01-01|maybe"), ("line.csv", 8, "LINE|3|n|2024-01-01|t|more")]
    rows, bad = kv1.parse_lines(spark.createDataFrame(lines, "file string, pos long, line string"), "line", schema, ["extra"])
    assert sorted(tuple(r)[2:] for r in rows.collect()) == [("LINE", 1, 'a|b "c"', date(2024, 1, 2), True, None), ("LINE", 2, "n", None, None, None)]
    assert sorted((r.pos, r.reason) for r in bad.collect()) == [(2, "version"), (3, "fields"), (5, "day"), (7, "ok"), (8, "fields")]
    assert rows.columns == ["file", "pos", *schema.names]


def test_iff_records_in_chunks_of_any_length(spark):
    one = ["@100,01012024,07012024,0001,demo", "?x,x,00001", ">none   ,0100"]  # records before the first header belong to no service
    for i in range(1, 6):
        one += [f"#{i:08d}", f"%100,{i:05d},      ,001,003,", "-00001,000,999", f">a{i}    ,09{i:02d}", "?1,1,00001", f"+b{i}     ,0911,0912", ";pass    ", "?2,3,00001", f"<c{i}     ,0930"]
    one += ["#00000009", "?7,8,00001"]  # a platform without a stop before it
    files = ("one", one), ("two", one[3:])

    def found(chunk):
        t = tagged.iff_timetable(_lines(spark, *files), chunk)
        return {k: sorted(map(repr, t[k].collect())) for k in t}

    whole = found(100_000)
    stops = [(f, i, n, s) for f in ("one", "two") for i in range(1, 6) for n, s in enumerate([f"a{i}", f"b{i}", "pass", f"c{i}"], 1)]
    rows = tagged.iff_timetable(_lines(spark, *files), 2)
    assert sorted((r.file, r.serviceid, r.idx, r.station) for r in rows["stop"].collect()) == stops
    platforms = [(f, i, n, s) for f in ("one", "two") for i in range(1, 6) for n, s in ((1, f"a{i}"), (3, "pass"))] + [(f, 9, 0, None) for f in ("one", "two")]
    assert sorted((r.file, r.serviceid, r.idx, r.station) for r in rows["platform"].collect()) == sorted(platforms, key=lambda r: r[:3])
    for chunk in (1, 2, 3, 7, 20):
        assert found(chunk) == whole
