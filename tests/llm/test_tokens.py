import base64
import hashlib
import random
import sys

import public_tokenizers as vocabularies
import pytest
import tiktoken

from gtfsforge.llm import byte_bpe, wordpiece
from gtfsforge.llm.queries_tokens import op3_byte_bpe, op6_token_counts

RANKS = vocabularies.path("byte_bpe_50k.tiktoken")
PIECES = vocabularies.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(byte_bpe.serialise(byte_bpe.read_ranks(RANKS)), vocabularies.PATTERN)


def test_every_code_point_between_letters(codec, library):
    bad = []
    for at in range(0, sys.maxunicode + 1, 64):
        for lead in ("a", " ", "1", "\n"):
            t = "".join(f"{lead}{chr(c)}{chr(c)}b " for c in range(at, at + 64) if not 0xD800 <= c < 0xE000)
            if codec.encode(t) != library.encode_ordinary(t):
                bad.append(hex(at))
    assert not bad, bad


def test_random_texts_and_round_trip(codec, library):
    rng = random.Random(5)
    alphabet = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "ß", "漢", "🙂", "0", "12", "'s", "'", "!", "...", "​", "\x00", "=" * 9]
    for _ in range(3000):
        t = "".join(rng.choices(alphabet, k=rng.randint(0, 60)))
        ids = codec.encode(t)
        assert ids == library.encode_ordinary(t)
        assert codec.decode(ids) == t.encode()


def test_long_runs(codec, library):
    for t in ("a" * 5000, " " * 5000, "ab1 " * 3000, "é" * 3000, "=" * 3000):
        assert codec.encode(t) == library.encode_ordinary(t)


def test_query_rows_are_those_of_the_library(spark, sf, library):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op3_byte_bpe(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = library.encode_ordinary(r.text or "")
        digest = lambda b: hashlib.sha256(b).hexdigest()
        assert got[r.doc_id] == (len(ids), digest(" ".join(map(str, ids)).encode()), digest((r.text or "").encode()))


def test_bpe_nulls_repeats_and_clashing_names(spark, make_docs):
    docs = make_docs([(1, None, None, None, "x"), (1, "", None, None, "y"), (2, "Hello hello", None, None, None), (2, "Hello hello", None, None, None), (None, "x" * 70_000, None, None, "z")], ", ids string")
    out = byte_bpe.encode_decode(docs, RANKS, vocabularies.PATTERN).collect()
    assert sorted((r.doc_id or 0, len(r.ids), bytes(r.decoded).decode()) for r in out)[1:] == [(1, 0, ""), (1, 0, ""), (2, 2, "Hello hello"), (2, 2, "Hello hello")]
    two = byte_bpe.decode(byte_bpe.encode(docs, RANKS, vocabularies.PATTERN), RANKS, vocabularies.PATTERN)
    assert sorted(len(r.decoded) for r in two.collect()) == [0, 0, 11, 11, 70_000]
    assert byte_bpe.encode_decode(docs.limit(0), RANKS, vocabularies.PATTERN).count() == 0


def naive(word: str, pieces: set[str], longest: int) -> int:
    """Greedy longest match, by trying every prefix; one unknown token if it gets stuck."""
    word, n = wordpiece.MARK + word, 0
    while word:
        k = next((k for k in range(min(longest, len(word)), 0, -1) if word[:k] in pieces), 0)
        if not k:
            return -1
        word, n = word[k:], n + 1
    return n


def test_automaton_equals_trying_every_prefix():
    rng = random.Random(3)
    for _ in range(300):
        pieces = {"".join(rng.choices("ab" + wordpiece.MARK, k=rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
        a = wordpiece.Automaton(tuple(pieces), wordpiece.MARK)
        for _ in range(30):
            w = "".join(rng.choices("abc", weights=(5, 5, 1), k=rng.randint(1, 14)))
            assert a.length(w) == naive(w, pieces, 5), (pieces, w)


def test_counts_of_the_table(spark, sf):
    pieces = set(wordpiece.vocabulary(PIECES))
    longest = max(map(len, pieces))
    import re

    for r in op6_token_counts(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").collect():
        lens = [naive(w, pieces, longest) for w in re.findall(wordpiece.WORD, r.text)]
        assert (r.n_words, r.n_tokens, r.n_unknown) == (len(lens), sum(abs(x) for x in lens), sum(x < 0 for x in lens))


def test_counts_of_nulls_empty_and_unknown(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "ab \x00͸ ab"), (3, "ab \x00͸ ab"), (None, "a" * 50_000)])
    out = sorted(((r.doc_id or 9, r.n_words, r.n_tokens, r.n_unknown) for r in wordpiece.token_counts(docs, (wordpiece.MARK + "a", "b", "a")).collect()))
    assert out == [(1, 0, 0, 0), (2, 0, 0, 0), (3, 3, 5, 1), (3, 3, 5, 1), (9, 1, 50_000, 0)]
    assert wordpiece.token_counts(docs.limit(0), ("a",)).count() == 0
