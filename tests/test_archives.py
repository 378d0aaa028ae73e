"""Archives by member: nested ones, bad ones, many tasks and bounded memory."""

import io
import random
import resource
import zipfile

from pyspark.sql import functions as F

from gtfsforge.sources import archives


def zipped(entries, method=zipfile.ZIP_DEFLATED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, content in entries:
            z.writestr(name, content)
    return out.getvalue()


def test_lines_of_nested_archives(spark, tmp_path):
    inner = zipped([("a/USRSTOP.TMI", "x|1\r\n\r\ny|2"), ("empty.csv", ""), ("deep.zip", zipped([("b", "z\n")], zipfile.ZIP_STORED))])
    (tmp_path / "feed 1.zip").write_bytes(zipped([("DEST.TMI", b"\xef\xbb\xbfd|1\nd|\xff\n"), ("dir/", ""), ("Csv.ZIP", inner)], zipfile.ZIP_STORED))
    (tmp_path / "feed#2.zip").write_bytes(zipped([("Csv.zip", inner), ("LATIN", "caf€\n".encode("iso-8859-15"))]))
    charset = F.when(F.get("path", 0) == "LATIN", "iso-8859-15")
    got = sorted((r.file.split("/feed", 1)[1], r.pos, r.line) for r in archives.archive_lines(spark, f"{tmp_path}/*.zip", charset, tasks=5).collect())
    nested = lambda outer, name: [(f"{outer}!/{name}!/a/USRSTOP.TMI", 0, "x|1"), (f"{outer}!/{name}!/a/USRSTOP.TMI", 1, ""), (f"{outer}!/{name}!/a/USRSTOP.TMI", 2, "y|2"), (f"{outer}!/{name}!/deep.zip!/b", 0, "z")]
    want = [*nested(" 1.zip", "Csv.ZIP"), (" 1.zip!/DEST.TMI", 0, "d|1"), (" 1.zip!/DEST.TMI", 1, "d|�"), *nested("#2.zip", "Csv.zip"), ("#2.zip!/LATIN", 0, "caf€")]
    assert got == sorted(want)
    content = {(r.member): bytes(r.content) for r in archives.expand_archives(spark, f"{tmp_path}/feed 1.zip").collect()}
    assert content["Csv.ZIP!deep.zip!b"] == b"z\n" and content["Csv.ZIP!empty.csv"] == b"" and len(content) == 4


def test_what_cannot_be_read_is_reported(spark, tmp_path):
    good = zipped([("a", "one\n" * 1000)])
    (tmp_path / "none.zip").write_bytes(b"no archive")
    (tmp_path / "void.zip").write_bytes(zipped([]))
    (tmp_path / "other.zip").write_bytes(zipped([("b", "x" * 100)], zipfile.ZIP_BZIP2))
    (tmp_path / "half.zip").write_bytes(zipped([("in.zip", good[:50]), ("c", "kept")]))
    deep = good
    for _ in range(archives.DEPTH + 1):
        deep = zipped([("d.zip", deep)])
    (tmp_path / "deep.zip").write_bytes(deep)
    rows = archives.members(spark, f"{tmp_path}/*.zip").collect()
    errors = {r.archive.rsplit("/", 1)[1]: r.error for r in rows if r.error}
    assert set(errors) == {"none.zip", "other.zip", "half.zip", "deep.zip"} and errors["other.zip"] == "packed by method 12"
    assert [(r.line, r.pos) for r in archives.archive_lines(spark, f"{tmp_path}/*.zip").collect()] == [("kept", 0)]


def test_damage_is_found(tmp_path):
    for method in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        data = bytearray(zipped([("a", bytes(range(256)) * 40)], method))
        steps = list(archives._listed(io.BytesIO(bytes(data)), [], []))[0][2]
        whole = archives.Entry(io.BytesIO(bytes(data)), **steps[0])
        assert b"".join(iter(whole.read, b"")) == bytes(range(256)) * 40
        data[60] ^= 1
        try:
            broken = archives.Entry(io.BytesIO(bytes(data)), **steps[0])
            b"".join(iter(broken.read, b""))
        except (zipfile.BadZipFile, archives.zlib.error):
            continue
        raise AssertionError("damage wasn't found")


def test_members_of_one_archive_are_many_tasks(spark, tmp_path):
    inner = zipped([(f"m{i}", f"{i}\n") for i in range(20)])
    (tmp_path / "feed.zip").write_bytes(zipped([*[(f"n{i}", f"{i}\n") for i in range(20)], ("in.zip", inner)]))
    by_task = archives.archive_lines(spark, f"{tmp_path}/feed.zip", tasks=40).groupBy(F.spark_partition_id()).count().collect()
    assert len(by_task) == 40 and all(r["count"] == 1 for r in by_task)


def test_memory_stays_small(tmp_path):
    """A member of 400 MB in a nested archive is read in pieces."""
    line = "".join(random.Random(1).choices("abcdefgh|0123456789", k=200)) + "\n"
    path = tmp_path / "big.zip"
    with zipfile.ZipFile(path, "w") as outer, outer.open("in.zip", "w") as f, zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as inner:
        with inner.open("big", "w") as m:
            for _ in range(400):
                m.write(line.encode() * 5000)
    listed = list(archives._list(iter([archives.pa.RecordBatch.from_pydict({"path": [f"file:{path}"]})])))[0].to_pylist()
    batch = archives.pa.RecordBatch.from_pylist([{**listed[0], "charset": "UTF-8"}])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    rows = sum(b.num_rows for b in archives._lines(iter([batch])))
    assert rows == 400 * 5000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 100_000  # KB


def test_packed_lines_come_back(spark, tmp_path):
    names = ["a.zip!/x", "a.zip!/in.zip!/y", "a.zip!/in.zip!/z", "a.zip!/in.zip!/w.zip!/v", "b.zip!/x", "c.zip!/in.zip!/y", "c.zip!/x/y"]
    lines = spark.createDataFrame([(f, i, f"{f} {i}") for f in names for i in range(300)], "file string, pos long, line string").repartition(7)
    archives.pack_archives(lines, str(tmp_path))
    archives.pack_archives(lines, f"file:{tmp_path}")
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a.zip", "b.zip", "c.zip"]
    assert zipfile.ZipFile(tmp_path / "a.zip").testzip() is None
    got = sorted((r.file.rsplit(f"{tmp_path}/")[1], r.pos, r.line) for r in archives.archive_lines(spark, str(tmp_path)).collect())
    assert got == sorted((f, i, f"{f} {i}") for f in names for i in range(300))
