"""Zip archives by member (O-S4): each member is a row of its own task, nested archives included.

``members`` lists the entries of archives from their central directories, with
the steps that lead to each: where an entry begins in the stream around it and
how long it is packed.  ``archive_lines`` deals the listed members out to tasks,
and each task reads its member forwards: it seeks to the entry in the archive's
file, and inflates and skips only within nested archives.  So neither an archive
nor a member is ever held whole, and a large archive is many tasks.

An archive, a nested archive or an entry that can't be read (no zip, encrypted,
packed in another way than stored or deflated, nested more than ``DEPTH`` deep)
is a row with its reason in ``error``; ``archive_lines`` leaves these out.
Folders are no members; empty archives and members give no rows.
"""

from __future__ import annotations

import os
import re
import shutil
import struct
import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from contextlib import ExitStack
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Archives within archives, at most; bytes read at once; bytes of lines in a batch.
DEPTH, READ, BATCH = 8, 1 << 18, 4 << 20
#: Between an archive and what is in it.
INSIDE = "!/"
_STEP = pa.struct([("at", pa.int64()), ("packed", pa.int64()), ("deflated", pa.bool_()), ("crc", pa.int64())])
_LISTED = pa.schema([("archive", pa.string()), ("path", pa.list_(pa.string())), ("size", pa.int64()), ("steps", pa.list_(_STEP)), ("error", pa.string())])
LISTED = "archive string, path array<string>, size long, steps array<struct<at:bigint,packed:bigint,deflated:boolean,crc:bigint>>, error string"


def _store(path: str):
    """(file system, path in it) of a path that isn't local; s3a and s3n are the names Hadoop gives to s3."""
    from urllib.parse import quote

    from pyarrow import fs

    scheme, rest = path.split(":", 1)
    return fs.FileSystem.from_uri(f"{re.sub('^s3[an]$', 's3', scheme)}:{quote(rest, safe='/:@')}")


def local(path: str) -> str | None:
    """The path of a local file, as Spark names it (``file:/x``, ``file:///x`` or plain)."""
    m = re.match(r"file:/*(/.*)", path)
    return m.group(1) if m else path if not re.match(r"[A-Za-z][\w+.-]*:/", path) else None


def opened(path: str):
    """A file of the cluster's store for reading, with seek."""
    if local(path) is not None:
        return open(local(path), "rb")
    store, p = _store(path)
    return store.open_input_file(p)


class Entry:
    """The bytes of an archive's entry, read forwards from a source that is at the beginning of the archive."""

    def __init__(self, source, at: int, packed: int, deflated: bool, crc: int):
        self.source, self.left, self.crc, self.sum = source, packed, crc, 0
        self.inflate = zlib.decompressobj(-zlib.MAX_WBITS) if deflated else None
        skip(source, at)
        head = b""
        while len(head) < 30:
            more = source.read(30 - len(head))
            if not more:
                raise zipfile.BadZipFile("an entry lies beyond the end of its archive")
            head += more
        if head[:4] != b"PK\x03\x04":
            raise zipfile.BadZipFile("no entry where the directory says")
        skip(source, sum(struct.unpack("<HH", head[26:])))

    def _packed(self, n: int) -> bytes:
        piece = self.source.read(min(n, self.left))
        if not piece and self.left:
            raise zipfile.BadZipFile("an entry ends too early")
        self.left -= len(piece)
        return piece

    def read(self, n: int = READ) -> bytes:
        """Some bytes, n at most; none at the end, where the check sum must be right."""
        if self.inflate is None:
            out = self._packed(n) if self.left else b""
        else:
            out = b""
            while not out and not self.inflate.eof:
                out = self.inflate.decompress(self.inflate.unconsumed_tail or self._packed(READ), n)
        self.sum = zlib.crc32(out, self.sum)
        if not out and self.sum != self.crc:
            raise zipfile.BadZipFile("an entry's check sum is wrong")
        return out


def skip(source, n: int) -> None:
    if not isinstance(source, Entry):
        source.seek(source.tell() + n)
        return
    while n > 0:
        piece = source.read(min(n, READ))
        if not piece:
            raise zipfile.BadZipFile("an entry lies beyond the end of its archive")
        n -= len(piece)


def _listed(file, path: list[str], steps: list[dict]) -> Iterator[tuple]:
    """(path, size, steps, error) of each entry of an open archive."""
    try:
        archive = zipfile.ZipFile(file)
    except (zipfile.BadZipFile, OSError, ValueError) as e:
        yield path, None, steps, str(e)
        return
    with archive:
        for i in archive.infolist():
            if i.is_dir():
                continue
            here = [*path, i.filename]
            chain = [*steps, {"at": i.header_offset, "packed": i.compress_size, "deflated": i.compress_type == zipfile.ZIP_DEFLATED, "crc": i.CRC}]
            if i.flag_bits & 1 or i.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
                yield here, i.file_size, chain, "encrypted" if i.flag_bits & 1 else f"packed by method {i.compress_type}"
            elif not i.filename.lower().endswith(".zip"):
                yield here, i.file_size, chain, None
            elif len(here) > DEPTH:
                yield here, i.file_size, chain, f"nested more than {DEPTH} deep"
            else:
                with tempfile.TemporaryFile() as whole:  # the directory is at its end
                    try:
                        with archive.open(i) as f:
                            shutil.copyfileobj(f, whole, READ)
                    except (zipfile.BadZipFile, zlib.error, EOFError) as e:
                        yield here, i.file_size, chain, str(e)
                        continue
                    yield from _listed(whole, here, chain)


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for name in b.column(0).to_pylist():
            rows: list[tuple] = []
            with opened(name) as f:
                for found in _listed(f, [], []):
                    rows.append((name, *found))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _LISTED.types)], schema=_LISTED)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _LISTED.types)], schema=_LISTED)


def members(spark: SparkSession, glob: str) -> DataFrame:
    """archive, path (names from the outermost archive's entry inwards), size, steps and error of every member; no member is read but nested archives."""
    # the content isn't selected, so Spark doesn't read it
    return spark.read.format("binaryFile").load(glob).select("path").mapInArrow(_list, LISTED)


def _entry(row: dict, stack: ExitStack):
    source = stack.enter_context(opened(row["archive"]))
    for step in row["steps"]:
        source = Entry(source, **step)
    return source


_LINES = pa.schema([("file", pa.string()), ("pos", pa.int64()), ("line", pa.string())])


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in b.to_pylist():
            name = row["archive"] + INSIDE + INSIDE.join(row["path"])
            pos = 0

            def batch(text: list[str]) -> pa.RecordBatch:
                lines = [x.removesuffix("\r") for x in text]
                if pos == 0 and lines:
                    lines[0] = lines[0].removeprefix("\ufeff")
                return pa.RecordBatch.from_arrays([pa.array([name] * len(lines)), pa.array(range(pos, pos + len(lines)), pa.int64()), pa.array(lines, pa.string())], schema=_LINES)

            with ExitStack() as stack:
                source = _entry(row, stack)
                kept: list[bytes] = []  # the line that isn't over yet is at its end
                size = 0
                while piece := source.read():
                    kept.append(piece)
                    size += len(piece)
                    if size >= BATCH and b"\n" in piece:
                        whole, _, rest = b"".join(kept).rpartition(b"\n")
                        text = whole.decode(row["charset"], "replace").split("\n")
                        yield batch(text)
                        pos += len(text)
                        kept, size = [rest], len(rest)
                last = b"".join(kept)
                if last:
                    yield batch(last.removesuffix(b"\n").decode(row["charset"], "replace").split("\n"))


def archive_lines(spark: SparkSession, glob: str, charset: str | Column = "UTF-8", tasks: int | None = None) -> DataFrame:
    """file, pos (from 0) and line of all text members of archives, as ``parse_lines`` takes them.

    file is ``<archive>!/<member>``, with another ``!/`` for each nested archive.
    charset: a name, or a column over archive and path (null: UTF-8); bytes that
    aren't of it become U+FFFD.  Line ends and a byte order mark go.  tasks: how
    many the members are dealt out to (default: four for each core).
    """
    listed = members(spark, glob).where("error is null and size > 0")
    named = listed.withColumn("charset", F.coalesce(F.lit(charset) if isinstance(charset, str) else charset, F.lit("UTF-8")))
    dealt = named.select("archive", "path", "steps", "charset").repartition(tasks or 4 * spark.sparkContext.defaultParallelism)
    return dealt.mapInArrow(_lines, "file string, pos long, line string")


_CONTENT = pa.schema([("archive", pa.string()), ("member", pa.string()), ("content", pa.binary())])


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in b.to_pylist():
            with ExitStack() as stack:
                content = b"".join(iter(_entry(row, stack).read, b""))
            yield pa.RecordBatch.from_arrays([pa.array([row["archive"]]), pa.array(["!".join(row["path"])]), pa.array([content], pa.binary())], schema=_CONTENT)


def expand_archives(spark: SparkSession, glob: str, tasks: int | None = None) -> DataFrame:
    """archive, member (``!`` between nested names) and content of all members that can be read, one at a time in a task."""
    listed = members(spark, glob).where("error is null").select("archive", "path", "steps")
    return listed.repartition(tasks or 4 * spark.sparkContext.defaultParallelism).mapInArrow(_contents, "archive string, member string, content binary")


def _packed(folder: str):
    def finish(writers: list, keep: int) -> None:
        while len(writers) > keep:
            writers.pop()[1].close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = local(folder)
        store, base = (None, at) if at is not None else _store(folder)
        mark = uuid.uuid4().hex
        writers: list[tuple] = []  # (name, what is being written) from the archive's file inwards
        done: list[str] = []

        def put() -> None:
            finish(writers, 0)
            if done:
                target = f"{base}/{done[-1]}"
                os.replace(f"{target}.{mark}", target) if store is None else store.move(f"{target}.{mark}", target)

        for b in batches:
            for file, mine in groupby(zip(b.column("file").to_pylist(), b.column("line").to_pylist()), itemgetter(0)):
                names = file.split(INSIDE)
                if not done or names[0] != done[-1]:
                    put()
                    done.append(names[0])
                    path = f"{base}/{names[0]}.{mark}"
                    writers.append((None, open(path, "wb") if store is None else store.open_output_stream(path)))
                    writers.append((names[0], zipfile.ZipFile(writers[-1][1], "w", zipfile.ZIP_DEFLATED)))
                # what is open besides the file itself: an archive at each level and, beneath all, an entry
                have = [n for n, w in writers[1:] if isinstance(w, zipfile.ZipFile)] + [n for n, w in writers[-1:] if not isinstance(w, zipfile.ZipFile)]
                same = next((i for i, (x, y) in enumerate(zip(have, names)) if x != y), min(len(have), len(names)))
                if same < len(names):
                    # an archive inside another holds two writers: its entry in the outer one and itself
                    finish(writers, 2 * same)
                    for level in range(same, len(names)):
                        entry = writers[-1][1].open(names[level], "w", force_zip64=True)
                        writers.append((names[level], entry))
                        if level < len(names) - 1:
                            writers.append((names[level], zipfile.ZipFile(entry, "w", zipfile.ZIP_DEFLATED)))
                writers[-1][1].write("".join([f"{line}\r\n" for _, line in mine]).encode())
        put()
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], names=["archive"])

    return run


def pack_archives(lines: DataFrame, folder: str) -> None:
    """Writes lines (file, pos, line) as zip archives of the folder, which must exist.

    file is ``<archive>!/<member>``, as ``archive_lines`` gives it but for the
    folder.  An archive is one task that writes its lines, sorted by file and
    pos, as they come; it gets its name when it is complete, so a task that is
    run again leaves no half of it.
    """
    archive = F.substring_index("file", INSIDE, 1)
    sorted_ = lines.select("file", "pos", "line").repartition(archive).sortWithinPartitions("file", "pos")
    sorted_.select("file", "line").mapInArrow(_packed(folder), "archive string").write.format("noop").mode("overwrite").save()
