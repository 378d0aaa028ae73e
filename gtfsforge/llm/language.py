"""Language ID as inference of a mixture.

Each language has probabilities of byte trigrams (hashed to a fixed number of
buckets), counted over all learning rows.  A document's trigrams are a mixture
of languages; expectation-maximisation estimates the proportions, and the set
of languages is chosen by penalised likelihood: a further language must raise
the log-likelihood by more than the penalty.  The prediction is the language of
the largest proportion, which is the score; of equal ones the first by name.

Trigrams are taken over letters (ASCII letters and all non-ASCII bytes, in
lower case) and single gaps.  Null texts and texts without a letter are `und`
with score 0.  Rows without a label, text or with an excluded id don't teach.
The model has 0.5 MB a language.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import trimmed
from .shingles import chunks

BUCKETS = 1 << 16
#: Added to every count.
SMOOTHING = 0.1
#: Gain in log-likelihood asked of a further language, times the logarithm of the number of trigrams.
PENALTY = 3.0
UNDETERMINED = "und"
#: Most cells (trigrams by languages) worked on at once.
CELLS = 1 << 20

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row << 16 | bucket) of each row's distinct trigrams, sorted, and how often each occurs; fewer than 2**16 rows."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if offsets[-1] - offsets[0] < 3:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    b = _FOLD[np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]]
    row = np.repeat(np.arange(len(texts), dtype=np.uint32), np.diff(offsets))
    x, y, z = (b[i : len(b) - 2 + i] for i in range(3))
    ok = (row[2:] == row[:-2]) & ((x == 32).view(np.uint8) + (y == 32) + (z == 32) < 2)
    key = (x.astype(np.uint32) << 16 | y.astype(np.uint32) << 8 | z)[ok]
    code = row[:-2][ok] << 16 | (key * np.uint32(2654435761)) >> 16
    code.sort()
    first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.zeros(0, np.int64)
    return code[first], np.diff(np.concatenate((first, [len(code)])))


def _taught(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each language's trigrams in a partition."""
    total: dict[str, np.ndarray] = {}
    for b in batches:
        for at, part in _parts(b.column("text"), 1):
            code, count = trigrams(_folded(part))
            langs = b.column("lang").slice(at, len(part)).dictionary_encode()
            names = langs.dictionary.to_pylist()
            of = langs.indices.to_numpy(zero_copy_only=False)[code >> 16]
            for i, name in enumerate(names):
                mine = of == i
                got = np.bincount(code[mine] & 0xFFFF, weights=count[mine], minlength=BUCKETS)
                total[name] = total[name] + got if name in total else got
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.string()), pa.array([zlib.compress(x.astype(np.int64).tobytes(), 1) for x in total.values()], pa.binary())], names=["lang", "counts"]
    )


def _summed(key, pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(BUCKETS, np.int64)
    for x in pdf["counts"]:
        total += np.frombuffer(zlib.decompress(x), np.int64)
    return pd.DataFrame({"lang": [key[0]], "counts": [zlib.compress(total.tobytes(), 1)]})


def _folded(texts: pa.Array) -> pa.Array:
    """Texts in lower case between two gaps; null becomes empty."""
    gap = pa.scalar(" ", texts.type)
    return pc.binary_join_element_wise(gap, pc.utf8_lower(pc.fill_null(texts, "")), gap, pa.scalar("", texts.type))


def learn(rows: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Language names and their trigram probabilities (buckets by languages), from all rows with a text and a label."""
    rows = rows.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    sums = rows.mapInArrow(trimmed(_taught), "lang string, counts binary").groupBy("lang").applyInPandas(_summed, "lang string, counts binary")
    found = sorted((r.lang, np.frombuffer(zlib.decompress(r.counts), np.int64)) for r in sums.collect())  # one row a language
    if not found:
        return [], np.zeros((BUCKETS, 0))
    counts = np.stack([c for _, c in found], 1) + SMOOTHING
    return [name for name, _ in found], counts / counts.sum(0)


def _parts(texts: pa.Array, languages: int) -> Iterator[tuple[int, pa.Array]]:
    for at, part in chunks(texts):
        for i in range(0, len(part), 1 << 15):
            yield at + i, part.slice(i, 1 << 15)


def mixture(p: np.ndarray, row: np.ndarray, count: np.ndarray, rows: int, start: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, log-likelihood) of each row after some rounds of EM from `start`; a zero proportion stays zero.

    p: probability of each trigram (a line of the input) in each language; row
    ascends and every row from 0 to rows - 1 has a line.
    """
    first = np.searchsorted(row, np.arange(rows))
    total = np.add.reduceat(count, first).astype(float)
    pi = start
    for _ in range(rounds):
        mixed = np.einsum("ij,ij->i", p, pi[row])
        pi = pi * np.add.reduceat(p * (count / mixed)[:, None], first, axis=0) / total[:, None]
    mixed = np.einsum("ij,ij->i", p, pi[row])
    return pi, np.add.reduceat(count * np.log(mixed), first)


def infer(prob: np.ndarray, code: np.ndarray, count: np.ndarray, rows: int, penalty: float = PENALTY) -> np.ndarray:
    """Proportions of the chosen languages of each row (zeros for rows without trigrams)."""
    k = prob.shape[1]
    out = np.zeros((rows, k))
    if not len(code) or not k:
        return out
    has, row = np.unique(code >> 16, return_inverse=True)
    p = prob[code & 0xFFFF]
    n = len(has)
    first = np.searchsorted(row, np.arange(n))
    total = np.add.reduceat(count, first)
    single = np.add.reduceat(np.log(p) * count[:, None], first, axis=0)
    best = single.argmax(1)
    pi = np.zeros((n, k))
    pi[np.arange(n), best] = 1
    like = single[np.arange(n), best]
    cost = penalty * np.log(total + 1.0)
    # the likelihood is concave: it can't gain more than its slope allows
    slope = np.add.reduceat(p * (count / p[np.arange(len(row)), best[row]])[:, None], first, axis=0) - total[:, None]
    todo = np.flatnonzero(slope.max(1) > cost)
    if len(todo) and k > 1:
        lines = np.isin(row, todo)
        q, r, c = p[lines], np.searchsorted(todo, row[lines]), count[lines]
        m = len(todo)
        whole, upper = mixture(q, r, c, m, np.full((m, k), 1.0 / k), 12)
        order = np.argsort(-whole + 2.0 * (np.arange(k) != best[todo][:, None]), axis=1)  # the best single language, then by proportion
        alive = upper - like[todo] > cost[todo]
        reached, chosen = like[todo].copy(), pi[todo].copy()
        for size in range(2, k + 1):
            alive_at = np.flatnonzero(alive)
            if not len(alive_at):
                break
            pick = np.isin(r, alive_at)
            start = np.zeros((len(alive_at), k))
            np.put_along_axis(start, order[alive_at, :size], 1.0 / size, axis=1)
            got, like_now = mixture(q[pick], np.searchsorted(alive_at, r[pick]), c[pick], len(alive_at), start, 10)
            better = like_now - reached[alive_at] > cost[todo][alive_at]
            chosen[alive_at[better]] = got[better]
            reached[alive_at[better]] = like_now[better]
            alive[alive_at[~better]] = False
        pi[todo] = chosen
    out[has] = pi
    return out


def _identified(model, penalty: float, text_at: int, keys: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, prob = model.value
        for b in batches:
            for at, part in _parts(b.column(text_at), len(names)):
                letters = pc.fill_null(pc.match_substring_regex(part, r"\p{L}"), False).to_pylist()
                code, count = trigrams(_folded(part))
                share = np.zeros((len(part), len(names)))
                # as many rows at once as keep (trigrams by languages) small
                ends = np.searchsorted(code >> 16, np.arange(len(part)), side="right")
                begin = 0
                while begin < len(part) and names:
                    low = ends[begin - 1] if begin else 0
                    to = max(begin + 1, int(np.searchsorted(ends, low + CELLS // len(names), side="right")))
                    mine = slice(low, ends[to - 1])
                    share[begin:to] = infer(prob, code[mine] - np.uint32(begin << 16), count[mine], to - begin, penalty)
                    begin = to
                pred, score, mix = [], [], []
                for i, x in enumerate(share):
                    j = int(x.argmax()) if len(names) else 0
                    if not letters[i] or not names or not x.any():
                        found = UNDETERMINED if not letters[i] or not names else names[0]
                        pred.append(found), score.append(0.0), mix.append([])
                    else:
                        pred.append(names[j]), score.append(min(1.0, float(x[j])))
                        mix.append([(names[l], float(x[l])) for l in np.flatnonzero(x)])
                out = b.slice(at, len(part))
                yield pa.RecordBatch.from_arrays(
                    [*out.columns[:keys], pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(mix, pa.map_(pa.string(), pa.float64()))],
                    names=[*b.schema.names[:keys], "lang_pred", "score", "proportions"],
                )

    return run


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], key_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text", penalty: float = PENALTY) -> DataFrame:
    """key_cols, lang_pred, score and proportions (language -> share) of each whole text.

    A text with a letter but without any trigram of letters gets the first
    language with score 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keys = docs.select(*key_cols)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema.fields), "lang_pred string, score double, proportions map<string,double>"])
    rows = keys if text_col in key_cols else docs.select(*key_cols, F.col(text_col).alias("__text"))
    at = key_cols.index(text_col) if text_col in key_cols else len(key_cols)
    return rows.mapInArrow(trimmed(_identified(shared, penalty, at, len(key_cols))), schema)
