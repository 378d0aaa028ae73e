"""Token counts by a linear longest-match automaton.

Greedy word-piece splitting takes the longest vocabulary prefix of what is left
of a word, again and again.  The automaton reads each character once: it walks
a trie of the vocabulary; where no edge fits it follows a failure link, which
carries how many tokens are popped on the way.  No piece is ever built; a
word's length is the sum of the popped counts.

Pieces that begin a word carry a mark in front, the others continue one; a word
is read with the mark before it.  A word that has no full split counts as one
unknown token.  Null and empty texts have no words and no tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, trimmed

MARK = "▁"
#: Words kept by a Python worker, and the longest one kept.
CACHE_ENTRIES, CACHE_LENGTH = 200_000, 32


class Automaton(dict):
    """word -> tokens, or -1 if it has no full split.

    A trie of the pieces with failure links; node 0 is where a piece begins.
    """

    def __init__(self, pieces: tuple[str, ...], mark: str):
        super().__init__()
        self.mark = mark
        self.next: list[dict[str, int]] = [{}]
        final = [False]
        for p in filter(None, pieces):
            at = 0
            for c in p:
                to = self.next[at].get(c)
                if to is None:
                    to = len(self.next)
                    self.next.append({})
                    final.append(False)
                    self.next[at][c] = to
                at = to
            final[at] = True
        # breadth first: where to go on after the longest pieces of a node's string are popped, and how many they are
        self.fail = [-1] * len(self.next)
        self.pops = [0] * len(self.next)
        level = [0]
        while level:
            below = []
            for u in level:
                for c, v in self.next[u].items():
                    below.append(v)
                    if final[v]:
                        self.fail[v], self.pops[v] = 0, 1
                        continue
                    at, count = self.fail[u], self.pops[u]
                    while at >= 0 and c not in self.next[at]:
                        at, count = self.fail[at], count + self.pops[at]
                    if at >= 0:
                        self.fail[v], self.pops[v] = self.next[at][c], count
            level = below

    def length(self, word: str) -> int:
        next_, fail, pops = self.next, self.fail, self.pops
        at = count = 0
        for c in self.mark + word:
            to = next_[at].get(c)
            while to is None:
                if fail[at] < 0:
                    return -1
                count += pops[at]
                at = fail[at]
                to = next_[at].get(c)
            at = to
        while at:
            if fail[at] < 0:
                return -1
            count += pops[at]
            at = fail[at]
        return count

    def __missing__(self, word: str) -> int:
        n = self.length(word)
        if len(word) <= CACHE_LENGTH:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = n
        return n


def vocabulary(path: str) -> tuple[str, ...]:
    """The ordinary pieces of a sentencepiece vocabulary; those that begin a word carry the mark."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return tuple(sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)))


_automata: dict[int, Automaton] = {}


def _automaton(broadcast) -> Automaton:
    """The worker's automaton; made once in a process for each vocabulary."""
    key = hash(broadcast.value)
    if key not in _automata:
        _automata.clear()
        _automata[key] = Automaton(*broadcast.value)
    return _automata[key]


def _counts(broadcast):
    words = re.compile(WORD).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = _automaton(broadcast)
        get = a.__getitem__
        for b in batches:
            n, tokens, unknown = [], [], []
            for t in pc.fill_null(b.column(b.num_columns - 1), "").to_pylist():
                lens = np.fromiter(map(get, words(t)), np.int64)
                bad = int(np.count_nonzero(lens < 0))
                n.append(len(lens))
                tokens.append(int(lens.sum()) + 2 * bad)  # an unknown word, -1 so far, is one token
                unknown.append(bad)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(n, pa.int64()), pa.array(tokens, pa.int64()), pa.array(unknown, pa.int64())], names=[*b.schema.names[:-1], "n_words", "n_tokens", "n_unknown"]
            )

    return run


def token_counts(docs: DataFrame, pieces: tuple[str, ...], mark: str = MARK, key_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """key_cols, n_words, n_tokens and n_unknown (words that count as one unknown token) of each whole text."""
    automaton = docs.sparkSession.sparkContext.broadcast((tuple(pieces), mark))
    keys = docs.select(*key_cols)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema.fields), "n_words long, n_tokens long, n_unknown long"])
    return docs.select(*key_cols, F.col(text_col).alias("__text")).mapInArrow(trimmed(_counts(automaton)), schema)
