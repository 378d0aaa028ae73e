"""Secret scan: fixed patterns, and a conditional random field that adds what they miss.

The patterns' matches always stay.  Tokens of every line are tagged as secret
begin, inside or outside by a linear-chain field whose features are a token's
shape, its neighbours and what kind of file it is in; the tags are decoded by
Viterbi, and tagged stretches that meet no pattern's match are added.  The
field learns from a bounded sample of documents, the matches being its labels.
So that it learns more than the patterns' own shapes, every document with a
match also teaches by a varied copy: each secret is drawn anew from one of a
few alphabets, and the word that names it is another, or an ordinary one.

Null and empty texts have no spans.  Positions are code points, the end
exclusive, over the whole text.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import crf
from .common import hash_cut, trimmed
from .shingles import chunks

# Kinds in order, their patterns, and the least length of a match (of group 2 for the first).
KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a run of 32 or more: what [0-9a-f]+ matches, without shorter runs
#: Rows without a match of these have none of the patterns'.
MAYBE = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]""", "AKIA[A-Z0-9]{12}", "[0-9a-f]{32}")
#: Words that name a secret, as neighbours of a token.
WORDS = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api-key", "key", "auth", "bearer", "credential", "credentials", "private_key", "access_key", "access_token")
#: Documents (with and without matches each, about) and lines that the field learns from, at most.
DOCUMENTS, LINES, WINDOW = 400, 1500, 60
#: Code points of the longest text that it learns from, so that the sample's size is bounded too.
LONGEST = 100_000
#: What a varied secret is made of: hexadecimal digits, letters of both cases, one case, base64, separated groups.
ALPHABETS = {
    "hex": string.hexdigits.lower(), "HEX": string.hexdigits.upper(), "mixed": string.ascii_letters + string.digits, "upper": string.ascii_uppercase + string.digits,
    "lower": string.ascii_lowercase + string.digits, "base64": string.ascii_letters + string.digits + "+/", "dashes": string.ascii_lowercase + string.digits + "-",
    "underscores": string.ascii_letters + string.digits + "_",
}


def base_spans(text: str, maybe=(True, True, True)) -> list[tuple[str, int, int]]:
    """Matches of the patterns by start, then kind."""
    out = []
    if maybe[0]:
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if maybe[1]:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if maybe[2]:
        out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def secret_parts(text: str) -> list[tuple[int, int]]:
    """The secrets themselves within the patterns' matches."""
    return [m.span(2) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8] + [s[1:] for s in base_spans(text, (False, True, True))]


def varied(text: str, parts: list[tuple[int, int]], alphabets: tuple[str, ...] = tuple(ALPHABETS)) -> tuple[str, list[tuple[int, int]]]:
    """(text, secret parts) with every secret drawn anew, 16 to 64 characters of one alphabet, and its name another word.

    Of four names three are of WORDS and one is an ordinary word of the text.
    What is drawn follows from the text, so reruns agree.
    """
    draw = random.Random(hashlib.blake2b(text.encode(errors="replace"), digest_size=8).digest())
    named = {m.start(2): m.span(1) for m in ASSIGN.finditer(text)}
    plain = re.findall(r"[a-z]{3,12}", text[:10_000]) or ["note"]
    out, found, done, length = [], [], 0, 0
    for a, b in sorted(set(parts), key=lambda x: (x[0], -x[1])):
        if a < done:  # within the last one
            continue
        x, y = named.get(a, (a, a))
        if x < done:
            x = y = a
        name = draw.choice(WORDS if draw.random() < 0.75 else plain) if x < y else ""
        letters = ALPHABETS[draw.choice(alphabets)]
        secret = "".join(draw.choices(letters, k=draw.randint(16, 64)))
        if not letters[-1].isalnum():  # neither end is a mark
            secret = draw.choice(string.ascii_letters) + secret[1:-1] + draw.choice(string.digits)
        lead = text[done:x] + name + text[y:a]
        out += [lead, secret]
        length += len(lead)
        found.append((length, length + len(secret)))
        length, done = length + len(secret), b
    return "".join(out) + text[done:], found


_LOWER, _UPPER, _DIGIT, _MARK, _HEX, _HIGH, _VOWEL = range(7)
_CLASS = np.zeros((7, 256), bool)
_CLASS[_LOWER, 97:123] = _CLASS[_UPPER, 65:91] = _CLASS[_DIGIT, 48:58] = _CLASS[_HIGH, 128:] = True
_CLASS[_MARK, list(b"+/_.-")] = True
_CLASS[_HEX, list(b"0123456789abcdefABCDEF")] = True
_CLASS[_VOWEL, list(b"aeiouyAEIOUY")] = True
_TOKEN = _CLASS[[_LOWER, _UPPER, _DIGIT, _MARK, _HIGH]].any(0)
_SET = {w: None for w in WORDS}
FEATURES = 40


def tokens(raw: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row, whether it begins a line) of each token of rows of bytes that begin at `first` (and end there)."""
    n = len(raw)
    solid = _TOKEN[raw]
    edge = np.zeros(n + 1, bool)
    edge[first] = True
    a, b = solid.copy(), solid.copy()
    a[1:] &= ~solid[:-1] | edge[1:-1]
    b[:-1] &= ~solid[1:] | edge[1:-1]
    s, e = np.flatnonzero(a), np.flatnonzero(b) + 1
    row = np.searchsorted(first, s, side="right") - 1
    line = np.concatenate(([0], np.cumsum(raw == 10)))
    new = np.ones(len(s), bool)
    new[1:] = (row[1:] != row[:-1]) | (line[s[1:]] != line[s[:-1]])
    return s, e, row, new


def featurise(raw: np.ndarray, first: np.ndarray, s: np.ndarray, e: np.ndarray, row: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Token shape, neighbours and file features, tokens by FEATURES."""
    k = len(s)
    x = np.zeros((k, FEATURES), np.float32)
    if not k:
        return x
    size = e - s
    total = [np.concatenate(([0], np.cumsum(c[raw]))) for c in _CLASS]
    low, up, dig, mark, hexa, high, vowel = (t[e] - t[s] for t in total)
    letters = low + up
    x[:, 0] = 1
    for i, (a, b) in enumerate(((0, 4), (4, 8), (8, 16), (16, 32), (32, 1 << 40))):
        x[:, 1 + i] = (size >= a) & (size < b)
    mixed = (dig > 0) & (letters > 0)
    shape = [
        dig > 0, up > 0, low > 0, mark > 0, high > 0, mixed, (low > 0) & (up > 1) & (dig > 0), (hexa == size) & (size >= 16), dig == size,
        (up == 1) & (low + mark == size - 1), (raw[e - 1] == 46) & (dig == 0), (vowel * 5 < letters) & (letters >= 6), (size >= 12) & mixed, (up + dig == size) & (size >= 12),
        (low + high == size), (size >= 16) & (letters + dig == size) & (dig > 1),
    ]
    x[:, 6:22] = np.stack(shape, 1)
    # is it a word that names a secret?  only short plain tokens are looked up
    names = np.zeros(k, bool)
    probe = np.flatnonzero((size <= 16) & (size >= 3) & (dig == 0) & (high == 0))
    lead = np.isin(raw[s[probe]] | 32, np.frombuffer(bytes(sorted({w[0].encode()[0] for w in WORDS})), np.uint8))
    data = raw.tobytes()
    for i in probe[lead].tolist():
        names[i] = data[s[i] : e[i]].decode().lower() in _SET
    # the gaps before and after, within the line
    codes = {c: np.concatenate(([0], np.cumsum(raw == c))) for c in b":=\"'"}
    begin = np.concatenate(([0], e[:-1]))
    begin = np.where(new, np.maximum(first[row], s - 2), begin)
    has = lambda cs, a, b: sum(codes[c][b] - codes[c][a] for c in cs) > 0
    after = np.minimum(e + 1, len(raw))
    sets, quoted, quote_after = has(b":=", begin, s), has(b"\"'", begin, s), has(b"\"'", e, after)
    sets &= (raw[s] != 47) | (raw[np.minimum(s + 1, len(raw) - 1)] != 47)  # an address follows its scheme
    previous = lambda v: np.concatenate(([False], v[:-1])) & ~new
    following = lambda v: np.concatenate((v[1:] & ~new[1:], [False]))
    x[:, 22:34] = np.stack(
        [names, previous(names), previous(previous(names)), sets, quoted, quote_after, previous(names) & sets, new, previous(mixed), following(mixed), previous(dig > 0), sets & mixed], 1
    )
    # the file: how much of it are digits, assignments, and whether it names secrets
    rows = len(first) - 1
    length = np.maximum(1, np.diff(first))
    per = lambda t: (t[first[1:]] - t[first[:-1]]) / length
    digits, assigns = per(total[_DIGIT]), per(codes[ord(":")]) + per(codes[ord("=")])
    named = np.bincount(row[names], minlength=rows) > 0
    x[:, 34:38] = np.stack([digits > 0.02, digits > 0.1, assigns > 0.004, named], 1)[row]
    x[:, 38] = sets & (size >= 8)
    x[:, 39] = previous(names) & sets & (size >= 8) & (dig > 0)
    return x


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _taught(text: str, parts: list[tuple[int, int]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first token, features, tags) of each line; of a long one a piece, around its first secret."""
    raw, first = _bytes(pa.array([text]))
    s, e, row, new = tokens(raw, first)
    if not len(s):
        return
    tag = np.zeros(len(s), np.int8)
    for a, b in parts:
        a, b = len(text[:a].encode()), len(text[:b].encode())
        inside = np.flatnonzero((s >= a) & (e <= b))
        if len(inside):
            tag[inside] = crf.INSIDE
            tag[inside[0]] = crf.BEGIN
    x = featurise(raw, first, s, e, row, new)
    starts = np.flatnonzero(new)
    for a, b in zip(starts, np.append(starts[1:], len(s))):
        if b - a > WINDOW:
            hits = np.flatnonzero(tag[a:b])
            a += max(0, int(hits[0]) - WINDOW // 2) if len(hits) else 0
            b = min(b, a + WINDOW)
            if tag[a] == crf.INSIDE:
                tag[a] = crf.BEGIN
        yield int(a), x[a:b], tag[a:b]


def learn(texts: list[str], alphabets: tuple[str, ...] = tuple(ALPHABETS)) -> tuple[np.ndarray, np.ndarray] | None:
    """The field's weights from documents whose labels are the patterns' matches; None if nothing matches or every line does.

    Lines without a match are drawn by hash, half of them from documents
    without any; what one kind of document lacks the other has.  Lines with a
    match come as they are first, then varied, as far as there is room.
    alphabets: of the varied secrets (none: no varied lines).
    """
    labelled, other, plain = [], [], {True: [], False: []}
    for t in texts:
        parts = secret_parts(t)
        mine, seed = plain[bool(parts)], hashlib.blake2b(t.encode(), digest_size=16).digest()
        for a, x, tag in _taught(t, parts):
            if not tag.any():
                drawn = hashlib.blake2b(a.to_bytes(8, "big"), key=seed, digest_size=8).digest()
                mine.append((drawn, x.copy(), tag))
            elif len(labelled) < LINES:
                labelled.append((x.copy(), tag))
        mine.sort(key=lambda r: r[0])
        del mine[LINES // 2 :]
        if parts and alphabets and len(other) < LINES:
            other += [(x.copy(), tag) for _, x, tag in _taught(*varied(t, parts, alphabets)) if tag.any()]
    if not labelled:
        return None
    few, many = sorted(plain.values(), key=len)
    few = few[: LINES // 4]
    drawn = [r[1:] for r in few + many[: LINES // 2 - len(few)]]
    if not drawn:  # nothing says what is no secret
        return None
    room = LINES - len(drawn)
    half = max(room - len(other), room // 2) if other else room
    labelled = labelled[:half]
    xs, ys = zip(*labelled, *other[: room - len(labelled)], *drawn)
    return crf.train(np.concatenate(xs).astype(np.float64), np.concatenate(ys), np.array([len(y) for y in ys]))


def added_spans(texts: pa.Array, model, base: list[list]) -> Iterator[tuple[int, int, int]]:
    """(row, start, end) in code points of the stretches that the field tags and no base span meets."""
    weights, trans = model
    raw, first = _bytes(texts)
    s, e, row, new = tokens(raw, first)
    if not len(s):
        return
    tags = crf.viterbi(featurise(raw, first, s, e, row, new) @ weights, trans, np.flatnonzero(new))
    for i in np.flatnonzero(tags == crf.BEGIN).tolist():
        j = i + 1
        while j < len(tags) and tags[j] == crf.INSIDE and not new[j]:
            j += 1
        r = int(row[i])
        a, b = int(s[i]), int(e[j - 1])
        while b < first[r + 1] and raw[b] == 61:  # padding belongs to what it follows
            b += 1
        points = lambda x, y: int(np.count_nonzero((raw[x:y] & 0xC0) != 0x80))
        start = points(int(first[r]), a)
        end = start + points(a, b)
        if not any(start < y and x < end for _, x, y in base[r]):
            yield r, start, end


def _scanned(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = model.value
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            for at, part in chunks(b.column(b.num_columns - 1)):
                part = pc.fill_null(part, "")
                maybe = list(zip(*(pc.match_substring_regex(part, p).to_pylist() for p in MAYBE)))
                texts = part.to_pylist()
                spans = [base_spans(t, m) if any(m) else [] for t, m in zip(texts, maybe)]
                if field is not None:
                    for r, x, y in list(added_spans(part, field, spans)):
                        spans[r] = sorted([*spans[r], ("crf", x, y)], key=lambda s: (s[1], KINDS.index(s[0])))
                out = b.slice(at, len(part))
                found = pa.array([[{"kind": k, "start": x, "end": y} for k, x, y in s] for s in spans], kind)
                yield pa.RecordBatch.from_arrays([*out.columns[:-1], found], names=[*b.schema.names[:-1], "spans"])

    return run


def scan_secrets(docs: DataFrame, key_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text", documents: int = DOCUMENTS, longest: int = LONGEST) -> DataFrame:
    """key_cols and spans array<struct<kind, start, end>> of each whole text, by start, then kind.

    The field learns from about `documents` texts with and without matches
    each, none of more than `longest` code points; all texts are scanned.
    """
    texts = docs.select(F.col(text_col).alias("text")).where(F.char_length("text") <= longest)
    hit = F.col("text").rlike("|".join((MAYBE[0], "AKIA[A-Z0-9]{12}", "[0-9a-f]{32}")).replace("(?i)", "(?i:", 1).replace("[:=]|", "[:=])|", 1))
    hashed = texts.withColumn("h", F.xxhash64("text"))
    counts = hashed.select("h", hit.alias("hit")).distinct().groupBy("hit").count().collect()  # two rows
    cut = {flag: hash_cut(next((r["count"] for r in counts if r.hit == flag), 0), documents) for flag in (True, False)}
    few = hashed.where(F.col("h") <= max(cut.values())).withColumn("hit", hit).where(f"(hit and h <= {cut[True]}) or (not hit and h <= {cut[False]})")
    taken = [r.text for r in sorted(few.dropDuplicates(["h"]).collect(), key=lambda r: (not r.hit, r.h))]  # about 2 * documents
    model = docs.sparkSession.sparkContext.broadcast(learn(taken))
    keys = docs.select(*key_cols)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema.fields), "spans array<struct<kind:string,start:bigint,end:bigint>>"])
    return docs.select(*key_cols, F.col(text_col).alias("__text")).mapInArrow(trimmed(_scanned(model)), schema)
