"""Byte-level BPE encoding and decoding through a sentencepiece model made from the vocabulary.

A rank file (base64 token, rank) is turned into a sentencepiece BPE model
without training: every byte is a printable character, a piece's score is its
negative rank, so that merges happen in the order of the ranks, and the
normaliser changes nothing.  The model is serialised on the driver and sent to
the executors (about 1 MB).  A text is split by the pattern, each pre-token is
encoded by itself, and ids are decoded through the inverse mapping.

Null texts count as empty: no ids, an empty decoded value.  Very long texts are
one row of work; nothing is cut.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import trimmed

#: Pre-tokens kept by a Python worker, and the longest one kept.
CACHE_ENTRIES, CACHE_LENGTH = 120_000, 32


def byte_characters() -> list[str]:
    """A printable character for each byte: visible Latin-1 characters stand for themselves, the others for 256, 257, ..."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b if b in visible else next(rest)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """A protocol-buffer field: bytes, an unsigned integer, or a 32-bit float."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value & (1 << 64) - 1)


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece ModelProto whose piece ids are the ranks; the unknown piece comes last.

    Field numbers are those of the public sentencepiece_model.proto.
    """
    chars = byte_characters()
    by_rank = sorted(ranks.items(), key=lambda x: x[1])
    if [r for _, r in by_rank] != list(range(len(by_rank))):
        raise ValueError("the ranks must be 0, 1, 2, ... without gaps")
    normal, unknown, bpe = 1, 2, 2
    pieces = [_field(1, "".join(chars[b] for b in t).encode()) + _field(2, float(-r)) + _field(3, normal) for t, r in by_rank]
    pieces.append(_field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown))
    n = len(by_rank)
    trainer = _field(3, bpe) + _field(4, n + 1) + _field(40, n) + b"".join(_field(k, -1) for k in (41, 42, 43))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normaliser)


class Codec(dict):
    """pre-token -> (ids, decoded bytes); what was asked before is kept up to a bound."""

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece

        super().__init__()
        self.split = regex.compile(pattern).findall
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        chars = byte_characters()
        self.to_piece = {b: c for b, c in enumerate(chars)}
        inverse = {c: b for b, c in enumerate(chars)}
        n = self.sp.get_piece_size() - 1
        self.whole = {self.sp.id_to_piece(i): i for i in range(n)}
        self.raw = [bytes(inverse[c] for c in p) for p in self.whole]

    def __missing__(self, token: str) -> tuple[list[int], bytes]:
        mapped = token.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.to_piece)
        one = self.whole.get(mapped)  # a pre-token that is a token needs no merges
        ids = [one] if one is not None else self.sp.encode(mapped)
        value = ids, self.decode(ids)
        if len(token) <= CACHE_LENGTH:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[token] = value
        return value

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for ids, _ in map(self.__getitem__, self.split(text)):
            out += ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.raw.__getitem__, ids))


_codecs: dict[int, Codec] = {}


def codec(model: bytes, pattern: str) -> Codec:
    """The worker's codec for this model; made once in a process."""
    key = hash((model, pattern))
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(model, pattern)
    return _codecs[key]


def _encode(model, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model.value, pattern)
        for b in batches:
            texts = b.column(b.num_columns - 1).to_pylist()
            for at in range(0, max(1, len(texts)), 512):
                ids = [c.encode(t) if t else [] for t in texts[at : at + 512]]
                out = pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*b.slice(at, 512).columns[:-1], out], names=[*b.schema.names[:-1], "ids"])
        c.clear()

    return run


def _decode(model, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model.value, pattern)
        for b in batches:
            for at in range(0, max(1, b.num_rows), 512):
                part = b.slice(at, 512)
                out = pa.array([c.decode(x or ()) for x in part.column("ids").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, out], names=[*b.schema.names, "decoded"])

    return run


def _codec_map(batches: Iterator[pa.RecordBatch], model, pattern: str) -> Iterator[pa.RecordBatch]:
    """Encode and decode at once: ids and the bytes that they stand for."""
    c = codec(model.value, pattern)
    for b in batches:
        keep = b.schema.names[:-1]
        texts = b.column(b.num_columns - 1)
        for at in range(0, max(1, b.num_rows), 512):
            ids, decoded = [], []
            for t in texts.slice(at, 512).to_pylist():
                row: list[int] = []
                raw: list[bytes] = []
                for x, y in map(c.__getitem__, c.split(t or "")):
                    row += x
                    raw.append(y)
                ids.append(row)
                decoded.append(b"".join(raw))
            part = b.slice(at, 512)
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.binary())], names=[*keep, "ids", "decoded"]
            )
    c.clear()  # the worker lives on, and what runs next in it needs the memory


def encode_decode(docs: DataFrame, path: str, pattern: str, key_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """key_cols, ids array<int> and decoded binary of each row's whole text."""
    model = docs.sparkSession.sparkContext.broadcast(serialise(read_ranks(path)))
    keys = docs.select(*key_cols)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema.fields), "ids array<int>", "decoded binary"])
    rows = docs.select(*key_cols, F.col(text_col).alias("__text"))
    return rows.mapInArrow(trimmed(lambda batches: _codec_map(batches, model, pattern)), schema)


def encode(docs: DataFrame, path: str, pattern: str, key_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """key_cols and ids array<int> of each row's whole text."""
    model = docs.sparkSession.sparkContext.broadcast(serialise(read_ranks(path)))
    keys = docs.select(*key_cols)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema.fields), "ids array<int>"])
    return docs.select(*key_cols, F.col(text_col).alias("__text")).mapInArrow(trimmed(_encode(model, pattern)), schema)


def decode(rows: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """rows' other columns, ids, and decoded binary: the bytes of the ids; null ids give empty bytes."""
    model = rows.sparkSession.sparkContext.broadcast(serialise(read_ranks(path)))
    src = rows.select(*[c for c in rows.columns if c not in (ids_col, "decoded")], F.col(ids_col).cast("array<int>").alias("ids"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields), "decoded binary"])
    return src.mapInArrow(trimmed(_decode(model, pattern)), schema)
