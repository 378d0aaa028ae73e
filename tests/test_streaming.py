"""Delivery folder ingest: each staged file is merged once, in order, and a rerun loads nothing twice."""

import os
import time
from datetime import date

from gtfsforge.operators import versions
from gtfsforge.sources import kv1
from gtfsforge.streaming import deliveries

SCHEMA = "version int, dataownercode string, organizationalunitcode string, schedulecode string, " \
         "scheduletypecode string, validdate date"


def _rows(d0, n, sched):
    return [(1, "GVB", "U1", sched, "WEEK", date(2024, 1, d0 + i)) for i in range(n)]


def test_merge_deliveries_stream(spark, tmp_path):
    staged, base, ckpt = str(tmp_path / "staged"), str(tmp_path / "base"), str(tmp_path / "ckpt")
    d1 = spark.createDataFrame(_rows(1, 10, "A"), SCHEMA)
    d2 = spark.createDataFrame(_rows(5, 3, "B"), SCHEMA)
    d1.coalesce(1).write.parquet(staged + "/d1")
    time.sleep(1.1)
    d2.coalesce(1).write.parquet(staged + "/d2")
    os.makedirs(staged + "/all", exist_ok=True)
    for sub in ("d1", "d2"):
        for f in sorted(os.listdir(f"{staged}/{sub}")):
            if f.endswith(".parquet"):
                os.rename(f"{staged}/{sub}/{f}", f"{staged}/all/{sub}-{f}")
                time.sleep(1.1)
    deliveries.merge_deliveries(spark, staged + "/all", base, SCHEMA, policy="days", checkpoint=ckpt)
    got = sorted(tuple(r) for r in deliveries.read_base(spark, base, SCHEMA).collect())
    empty = spark.createDataFrame([], SCHEMA)
    expect = versions.merge(versions.merge(empty, d1, None, "days"), d2, None, "days")
    assert got == sorted(tuple(r) for r in expect.collect())
    # a second run finds nothing new
    gens = sorted(os.listdir(base))
    deliveries.merge_deliveries(spark, staged + "/all", base, SCHEMA, policy="days", checkpoint=ckpt)
    assert sorted(os.listdir(base)) == gens


def _staged(spark, tmp_path):
    staged = str(tmp_path / "staged")
    for i, (day, n, name) in enumerate([(1, 10, "A"), (5, 3, "B")]):
        spark.createDataFrame(_rows(day, n, name), SCHEMA).coalesce(1).write.parquet(f"{staged}/{i}")
        time.sleep(1.1)
    os.makedirs(staged + "/all")
    for i in range(2):
        for f in sorted(os.listdir(f"{staged}/{i}")):
            if f.endswith(".parquet"):
                os.rename(f"{staged}/{i}/{f}", f"{staged}/all/{i}-{f}")
    return staged + "/all"


def test_fresh_checkpoint_keeps_every_row(spark, tmp_path):
    staged, base = _staged(spark, tmp_path), str(tmp_path / "base")
    for policy in ("none",):  # without deletes a second merge would show as repeated rows
        deliveries.merge_deliveries(spark, staged, base, SCHEMA, policy, str(tmp_path / "one"))
        once = sorted(tuple(r) for r in deliveries.read_base(spark, base, SCHEMA).collect())
        deliveries.merge_deliveries(spark, staged, base, SCHEMA, policy, str(tmp_path / "two"))
        assert sorted(tuple(r) for r in deliveries.read_base(spark, base, SCHEMA).collect()) == once and len(once) == 13


def test_replayed_epoch_and_unfinished_generation(spark, tmp_path):
    base = str(tmp_path / "base")
    batch = spark.createDataFrame([(*r, "file1") for r in _rows(1, 5, "A")], SCHEMA + ", file string")
    for _ in range(2):
        deliveries.merge_batch(spark, batch, base, SCHEMA, "none")
        assert deliveries.read_base(spark, base, SCHEMA).count() == 5
    # an attempt that died before its marker is not read, and the next one takes its place
    spark.createDataFrame(_rows(9, 1, "X"), SCHEMA).write.parquet(f"{base}/gen_0000000001/data")
    assert deliveries.read_base(spark, base, SCHEMA).count() == 5
    more = spark.createDataFrame([(*r, "file2") for r in _rows(7, 2, "B")], SCHEMA + ", file string")
    deliveries.merge_batch(spark, more, base, SCHEMA, "none")
    assert deliveries.read_base(spark, base, SCHEMA).count() == 7
    assert sorted(r.file for r in deliveries.merged_files(spark, base).collect()) == ["file1", "file2"]


TWO = [(1, o, "U1", "A", "WEEK", date(2023 + m // 12, 1 + m % 12, d)) for o in ("GVB", "HTM") for m in range(12, 18) for d in (3, 17)]


def _batch(spark, rows, name):
    return spark.createDataFrame([(*r, name) for r in rows], SCHEMA + ", file string")


def test_only_touched_partitions_are_written(spark, tmp_path):
    base = str(tmp_path / "base")
    assert deliveries.merge_batch(spark, _batch(spark, TWO, "f0"), base, SCHEMA, "days") == 12
    before = deliveries.manifest(spark, base)
    delta = [(2, "GVB", "U1", "B", "WEEK", date(2024, 3, 17)), (2, "GVB", "U1", "B", "WEEK", date(2024, 3, 18))]
    assert deliveries.merge_batch(spark, _batch(spark, delta, "f1"), base, SCHEMA, "days") == 1
    after = deliveries.manifest(spark, base)
    assert {p for p in after if after[p] != before.get(p)} == {("GVB", "202403")}
    want = versions.merge(spark.createDataFrame(TWO, SCHEMA), spark.createDataFrame(delta, SCHEMA), None, "days")
    assert sorted(map(tuple, deliveries.read_base(spark, base, SCHEMA).collect())) == sorted(map(tuple, want.collect()))
    written = lambda g: sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{base}/gen_{g:010d}/data") for f in fs if f.endswith(".parquet"))
    assert written(1) * 4 < written(0)


def test_tail_and_range_policies_on_partitions(spark, tmp_path):
    delta = [(2, "HTM", "U1", "B", "WEEK", date(2024, 5, 9)), (2, "HTM", "U2", "B", "WEEK", date(2024, 6, 9))]
    ranges = spark.createDataFrame([(2, "HTM", "U1", "B", "WEEK", date(2024, 2, 10), date(2024, 4, 10)), (2, "GVB", "U1", "B", "WEEK", date(2024, 6, 17), date(2030, 1, 1))],
                                   "version int, dataownercode string, organizationalunitcode string, schedulecode string, scheduletypecode string, validfrom date, validthru date")
    for policy, sv, hit in (("tail", None, 2), ("range", ranges, 6), ("none", None, 2)):
        base = str(tmp_path / policy)
        deliveries.merge_batch(spark, _batch(spark, TWO, "f0"), base, SCHEMA, "days")
        assert deliveries.merge_batch(spark, _batch(spark, delta, "f1"), base, SCHEMA, policy, sv) == hit
        assert deliveries.merge_batch(spark, _batch(spark, delta, "f1"), base, SCHEMA, policy, sv) == 0
        want = versions.merge(spark.createDataFrame(TWO, SCHEMA), spark.createDataFrame(delta, SCHEMA), sv, policy)
        assert sorted(map(tuple, deliveries.read_base(spark, base, SCHEMA).collect())) == sorted(map(tuple, want.collect()))
        held = deliveries.manifest(spark, base)
        assert held["HTM", "202403"] is None if policy == "range" else held["HTM", "202403"]  # a tombstone


def test_range_policy_in_the_stream(spark, tmp_path):
    staged, ranges, base = (str(tmp_path / x) for x in ("staged", "ranges", "base"))
    os.makedirs(staged), os.makedirs(ranges)
    deliveries_ = [(TWO, TWO[:1]), ([(2, "GVB", "U1", "B", "WEEK", date(2024, 2, 5))], [(2, "GVB", "U1", "B", "WEEK", date(2024, 2, 1))])]
    for i, (rows, spans) in enumerate(deliveries_):
        sv = spark.createDataFrame([(*r, date(2024, 3, 10)) for r in spans], SCHEMA.replace("validdate", "validfrom") + ", validthru date")
        for df, to in ((spark.createDataFrame(rows, SCHEMA), staged), (sv, ranges)):
            df.coalesce(1).write.parquet(f"{tmp_path}/x{i}{os.path.basename(to)}")
            part, = [f for f in os.listdir(f"{tmp_path}/x{i}{os.path.basename(to)}") if f.endswith(".parquet")]
            os.rename(f"{tmp_path}/x{i}{os.path.basename(to)}/{part}", f"{to}/{i}.parquet")
        time.sleep(1.1)
    deliveries.merge_deliveries(spark, staged, base, SCHEMA, "range", str(tmp_path / "ckpt"), schedvers_dir=ranges)
    gvb = sorted(r.validdate for r in deliveries.read_base(spark, base, SCHEMA).where("dataownercode = 'GVB'").collect())
    assert gvb == [d for *_, d in TWO[:2]] + [date(2024, 2, 5)] + [d for *_, d in TWO[5:12]]


def test_plan_order_not_file_time(spark, tmp_path):
    staged, base = str(tmp_path / "staged"), str(tmp_path / "base")
    entries = []
    # the delta's file comes first, the baseline's last; another owner's delivery between them
    for key, owner, index, baseline, first in (("delta", "GVB", 2, "false", 4), ("other", "HTM", 1, "false", 1), ("base", "GVB", 9, "true", 1)):
        rows = [(1 if baseline == "true" else 2, owner, "U1", key, "WEEK", date(2024, 1, first + i)) for i in range(10 if baseline == "true" else 2)]
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{staged}/{key}.zip")
        entries.append((key, f"{key}.zip", 1, "true", "2024-01-01", baseline, index))
    index = spark.createDataFrame(entries, "key string, zipfile string, versie int, isgepubliceerd string, publicatiedatum string, isbaseline string, index int")
    meta = spark.createDataFrame([("delta", "GVB", date(2024, 1, 4), date(2024, 1, 5)), ("other", "HTM", date(2024, 1, 1), date(2024, 1, 2)), ("base", "GVB", date(2024, 1, 1), date(2024, 1, 10))], "key string, dataownercode string, validfrom date, validthru date")
    none = spark.createDataFrame([], "filename string, dataownerversion int")
    plan = kv1.load_plan(index, meta, none, none, "2024-01-01")
    assert sorted((r.dataownercode, r.step, r.key) for r in plan.collect()) == [("GVB", 1, "base"), ("GVB", 2, "delta"), ("HTM", 1, "other")]
    assert deliveries.merge_planned(spark, plan, staged, base, SCHEMA) == 3
    got = sorted((r.validdate.day, r.schedulecode) for r in deliveries.read_base(spark, base, SCHEMA).where("dataownercode = 'GVB'").collect())
    assert got == [(d, "delta" if d in (4, 5) else "base") for d in range(1, 11)]
    assert deliveries.merge_planned(spark, plan, staged, base, SCHEMA) == 0
    assert kv1.load_plan(index, meta, none, none, "2024-01-06").count() == 2  # one is over
    loaded = spark.createDataFrame([("base", 1)], "filename string, dataownerversion int")
    assert sorted(r.key for r in kv1.load_plan(index, meta, loaded, none, "2024-01-01").collect()) == ["delta", "other"]
