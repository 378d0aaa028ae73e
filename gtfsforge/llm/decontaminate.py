"""Benchmark decontamination by a prefix-filtered set join.

Words are runs of ASCII letters and digits and of all other characters beyond
ASCII, A-Z lower-cased.  An item's windows are its runs of `width` words; an
item of fewer words, but not none, is one window.  A window is the set of its
shingles of `gram` words (a shorter window is one shingle).

1. Shingles of windows are counted over all documents; that orders them from
   rare to frequent.  Windows with a shingle that no document has are out.
2. To contain a window whole, a document must hold every one of its shingles,
   so a prefix of one, the rarest, is necessary and enough to look for.  A
   second pass over the documents posts only such shingles, each with the words
   around it that a window can reach.
3. Postings join windows on the shingle.  Its place in the window says where
   the window would begin and end in the document (positional bound, length
   bound); the words there must be the window's, compared as text.

Both passes read the texts once each without shuffling them; a bit field of
the shingles looked for (its size follows their number, 32 MB at most) keeps
other shingles off the shuffle, exactly or not: the joins decide.  Equal texts
are answered once.

Null texts have no words.  Items without words, and an empty benchmark, hit
nothing.  Rows that repeat an item id are one item; an item without an id hits
words, but is neither counted nor listed.  Rows of documents are answered row
by row, whatever ids they repeat.  Other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shingles as sh
from .common import durable, id_bound, trimmed

#: Byte values of words: digits, a-z after lower-casing, and all of characters beyond ASCII.
SOLID = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
#: log2 of the bits of a field: at least, at most, and over the number of shingles.
LEAST_BITS, MOST_BITS, SPARE_BITS = 16, 28, 5
#: Bytes of a field's pieces while it is put together.
PIECE = 1 << 13
#: At most so many rows of windows or hits are broadcast (about 200 bytes each); beyond, a shuffle join is used.
BROADCAST_ROWS = 100_000


def _grams(words: np.ndarray, first: np.ndarray, sizes: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words of a shingle, first word of each shingle that lies within one row, hash of each)."""
    row_end = np.repeat(first[1:], np.diff(first))
    for g in sizes:
        if len(words) >= g:
            h = sh.gram_hashes(words, g)
            at = np.flatnonzero(np.arange(len(h)) + g <= row_end[: len(h)])
            yield g, at, sh.mix64(h[at] + np.uint64(g))


def _windows(width: int, gram: int):
    """Items to windows: (item_id, n, window, tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, part in sh.chunks(b.column("text")):
                low, s, e, first = sh.word_spans(part, SOLID)
                words = sh.span_hashes(low, s, e)
                raw = low.tobytes()
                out = {"item_id": [], "n": [], "window": [], "tokens": []}
                for row, (i, j) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                    n = min(width, j - i)
                    if not n:
                        continue
                    spelt = [raw[x:y].decode() for x, y in zip(s[i:j].tolist(), e[i:j].tolist())]
                    (_, _, token), = _grams(words[i:j], np.array([0, j - i]), (min(gram, n),))
                    m = n - min(gram, n) + 1
                    for k in range(j - i - n + 1):
                        out["item_id"].append(b.column("item_id")[at + row].as_py())
                        out["n"].append(n)
                        out["window"].append(" ".join(spelt[k : k + n]))
                        out["tokens"].append(token[k : k + m].view(np.int64).tolist())
                yield pa.RecordBatch.from_pydict(out, pa.schema([("item_id", pa.string()), ("n", pa.int32()), ("window", pa.string()), ("tokens", pa.list_(pa.int64()))]))

    return run


def _bits(bits: int):
    """Pieces of the bit field of a task's tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << bits, bool)
        for b in batches:
            seen[_slot(b.column("token").to_numpy().view(np.uint64), bits)] = True
        field = np.packbits(seen).reshape(-1, min(PIECE, (1 << bits) // 8))
        some = np.flatnonzero(field.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([field[i].tobytes() for i in some], pa.binary())], names=["piece", "field"])

    return run


def _either(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"piece": [key[0]], "field": [np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in pdf["field"]]).tobytes()]})


def _slot(token: np.ndarray, bits: int) -> np.ndarray:
    return (token >> np.uint64(64 - bits)).astype(np.int64)


def bit_pieces(tokens: DataFrame) -> tuple[int, DataFrame]:
    """(log2 of bits, pieces of the field in which the bits of all `token`s are set, but those without any)."""
    n = tokens.count()
    bits = min(MOST_BITS, max(LEAST_BITS, n.bit_length() + SPARE_BITS))
    return bits, tokens.select("token").coalesce(16).mapInArrow(_bits(bits), "piece int, field binary").groupBy("piece").applyInPandas(_either, "piece int, field binary")


def bit_field(tokens: DataFrame):
    """A broadcast (log2 of bits, bytes) in which the bits of all `token`s are set."""
    bits, pieces = bit_pieces(tokens)
    size = min(PIECE, (1 << bits) // 8)
    field = np.zeros((1 << bits) // 8, np.uint8)
    for piece, x in pieces.toLocalIterator():  # 2**bits bits in all, 32 MB at most
        field[piece * size : (piece + 1) * size] = np.frombuffer(x, np.uint8)
    return tokens.sparkSession.sparkContext.broadcast((bits, field))


def flagged(rows: DataFrame, key: str, tokens: DataFrame, flag: str) -> DataFrame:
    """rows with `flag`: true for all whose key, a hash, is a `token`, and for few others; no row moves, whatever the number of tokens."""
    bits, pieces = bit_pieces(tokens)
    pieces = durable(pieces.withColumnsRenamed({"piece": "__piece", "field": "__field"}))  # 32 MB at most
    slot = F.shiftrightunsigned(F.col(key), 64 - bits)
    at = rows.withColumns({"__at": F.shiftright(slot, PIECE.bit_length() + 2).cast("int"), "__in": slot.bitwiseAND(8 * PIECE - 1).cast("int")})
    bit = "cast(conv(hex(substring(__field, shiftright(__in, 3) + 1, 1)), 16, 10) as int) & shiftleft(1, 7 - (__in & 7)) != 0"
    met = at.join(F.broadcast(pieces), F.col("__at") == F.col("__piece"), "left").withColumn(flag, F.coalesce(F.expr(f"({bit})"), F.lit(False)))
    return met.drop("__at", "__in", "__piece", "__field")


def _met(field: tuple[int, np.ndarray], token: np.ndarray) -> np.ndarray:
    """Which tokens have their bit set."""
    bits, x = field
    at = _slot(token, bits)
    return np.flatnonzero((x[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1)


def _counted(field, sizes: tuple[int, ...]):
    """Tokens of the field and how often they occur, chunk by chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, part in sh.chunks(b.column("text")):
                low, s, e, first = sh.word_spans(part, SOLID)
                found = [t[_met(field.value, t)] for _, _, t in _grams(sh.span_hashes(low, s, e), first, sizes)]
                token, n = np.unique(np.concatenate([*found, np.zeros(0, np.uint64)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n, pa.int64())], names=["token", "c"])

    return run


_ROW = pa.schema([("doc_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("n_words", pa.int64()), ("token", pa.int64()), ("pos", pa.int64()), ("before", pa.int32()), ("near", pa.string())])


def _posted(field, sizes: tuple[int, ...], width: int):
    """A row for each document, and one for each of its shingles in the field with the words around it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, part in sh.chunks(b.column("text")):
                low, s, e, first = sh.word_spans(part, SOLID)
                rows = b.slice(at, len(part))
                ids, h1, h2 = (rows.column(c) for c in ("doc_id", "h1", "h2"))
                k = len(part)
                yield pa.RecordBatch.from_arrays([ids, h1, h2, pa.array(np.diff(first), pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.string())], schema=_ROW)
                spelt: dict[int, str] = {}
                cut = lambda w: spelt.get(w) or spelt.setdefault(w, low[s[w] : e[w]].tobytes().decode())
                for _, start, token in _grams(sh.span_hashes(low, s, e), first, sizes):
                    hit = _met(field.value, token)
                    for some in (hit[i : i + 4096] for i in range(0, len(hit), 4096)):
                        i = start[some]
                        row = np.searchsorted(first, i, side="right") - 1
                        low_end, high_end = np.maximum(first[row], i - (width - 1)), np.minimum(first[row + 1], i + width)
                        near = [" ".join(map(cut, range(x, y))) for x, y in zip(low_end.tolist(), high_end.tolist())]
                        take = pa.array(row)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.nulls(len(i), pa.int64()), h1.take(take), h2.take(take), pa.nulls(len(i), pa.int64()),
                                pa.array(token[some].view(np.int64)), pa.array(i - first[row], pa.int64()), pa.array(i - low_end, pa.int32()), pa.array(near, pa.string()),
                            ],
                            schema=_ROW,
                        )

    return run


def _bound(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if id_bound(df, BROADCAST_ROWS) else df


def occurrences(docs: DataFrame, items: DataFrame, width: int, gram: int, text_col: str, id_col: str, item_text: str, item_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, found, windows): rows (doc_id, h1, h2, n_words) of docs; found (h1, h2, start, n, w1, w2), where in a text of
    hashes h1, h2 which windows lie; windows (w1, w2, item_id), which items have them."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    d = d.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})
    cut = items.select(F.col(item_id).cast("string").alias("item_id"), F.col(item_text).alias("text")).where(F.col("text").isNotNull())
    cut = durable(
        cut.repartition(F.xxhash64("text")).mapInArrow(_windows(width, gram), "item_id string, n int, window string, tokens array<long>")
        .withColumns({"w1": F.xxhash64("window"), "w2": F.xxhash64(F.lit(1), "window")})
    )
    windows = cut.dropDuplicates(["w1", "w2"])
    shingle = windows.select("w1", "w2", F.posexplode("tokens").alias("off", "token"))
    sizes = tuple(sorted(r[0] for r in cut.select(F.least("n", F.lit(gram))).distinct().collect()))  # `gram` rows at most
    texts = d.select("text")
    field = bit_field(shingle.select("token").distinct())
    count = texts.mapInArrow(trimmed(_counted(field, sizes)), "token long, c long").groupBy("token").agg(F.sum("c").alias("c"))
    count = durable(count.join(_bound(shingle.select("token").distinct()), "token", "left_semi"))
    rarest = (
        shingle.join(_bound(count), "token", "left").groupBy("w1", "w2")
        .agg(F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "token", "off")).alias("x")).where("x.c > 0").select("w1", "w2", "x.token", "x.off")
    )
    prefix = durable(rarest.join(windows.select("w1", "w2", "n", "window"), ["w1", "w2"]))
    field.unpersist()
    field = bit_field(prefix.select("token").distinct())
    posted = durable(d.mapInArrow(trimmed(_posted(field, sizes, width)), "doc_id long, h1 long, h2 long, n_words long, token long, pos long, before int, near string"))
    field.unpersist()
    begin = F.col("before") - F.col("off")
    words = F.split("near", " ", -1)
    found = (
        posted.where("near is not null").select("h1", "h2", "token", "pos", "before", "near").join(_bound(prefix), "token")
        .where((begin >= 0) & (begin + F.col("n") <= F.size(words)))
        .where(F.array_join(F.slice(words, begin + 1, F.col("n")), " ") == F.col("window"))
        .select("h1", "h2", (F.col("pos") - F.col("off")).alias("start"), "n", "w1", "w2").distinct()
    )
    return posted.where("near is null").select("doc_id", "h1", "h2", "n_words"), durable(found), cut.select("w1", "w2", "item_id").distinct()


def decontaminated(
    docs: DataFrame, items: DataFrame, width: int = 10, gram: int = 3,
    id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit (words inside a window that occurs), items (ids of items with one, sorted as strings; null if there are none)."""
    rows, found, windows = occurrences(docs, items, width, gram, text_col, id_col, item_text, item_id)
    before = Window.partitionBy("h1", "h2").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    spans = found.select("h1", "h2", "start", "n").distinct().withColumn("done", F.coalesce(F.max(F.col("start") + F.col("n")).over(before), F.lit(0)))
    hit = spans.groupBy("h1", "h2").agg(F.sum(F.greatest(F.col("start") + F.col("n") - F.greatest("start", "done"), F.lit(0))).alias("n_hit"))
    named = found.select("h1", "h2", "w1", "w2").distinct().join(_bound(windows), ["w1", "w2"]).select("h1", "h2", "item_id").distinct()
    listed = named.groupBy("h1", "h2").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    texts = durable(hit.join(listed, ["h1", "h2"], "left"))
    return rows.join(_bound(texts), ["h1", "h2"], "left").select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), "items")
