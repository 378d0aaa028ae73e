import hashlib
import re

import numpy as np
import pyarrow as pa

from gtfsforge.llm import crf, secrets
from gtfsforge.llm.queries_secrets import op7_secret_spans

KEY = "AKIA" + "ABCDEFGH12345678"


def by_hand(text):
    """The patterns as they are stated, every match tried and short ones dropped afterwards."""
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_key", "apikey"))
    out = [("assign", m.start(), m.end()) for m in re.finditer(rf"({word})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m.group(2)) >= 8]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


CASES = [
    "", "nothing here", "password=abcdefgh", "PassWord : 'abcdefg'", "secret:token :abcdefgh", "token==abcdefgh", "api_key='x1y2z3w4v5'", "apikey  =  12345678901", "é é " + KEY, "AKIAAKIA" + KEY,
    "AKIA123", "f" * 31, "f" * 32 + "G" + "0" * 40, "ſecret=abcdefgh", "toKen=abcdefgh", "password='" + "a" * 9 + "' secret=short token: " + "9" * 33, "token\n=abcdefgh", 'token" = "abcd/efg+h="',
]


def test_patterns():
    for t in CASES:
        assert secrets.base_spans(t) == by_hand(t), t


def test_query_over_the_table(spark):
    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = op7_secret_spans(spark, d).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = by_hand(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for x, *_ in base) for k in ("assign", "access", "hex"))
        assert [s for s in r.spans.split(",") if s and not s.startswith("crf")] == [s for s in joined.split(",") if s]


def test_field_finds_secrets_by_itself_and_leaves_prose():
    rng = np.random.default_rng(0)
    word = lambda: "".join(rng.choice(list("abcdeilnorst"), rng.integers(2, 9)))
    code = lambda: "".join(rng.choice(list("0123456789abcdef"), 40))
    prose = lambda: " ".join(word() for _ in range(30))
    teach = [f'{prose()}\n{prose()} token = "{code()}" {prose()}.' for _ in range(60)] + [prose() + "\n" + prose() for _ in range(60)]
    model = secrets.learn(teach)
    new = [f"é {prose()} auth = '{code()}' {prose()}" for _ in range(20)] + [prose() for _ in range(20)]
    found = list(secrets.added_spans(pa.array(new), model, [[] for _ in new]))
    assert {r for r, *_ in found} == set(range(20))
    for r, a, b in found:
        assert re.fullmatch("[0-9a-f]{40}", new[r][a:b])
    assert list(secrets.added_spans(pa.array(new[:1]), model, [[("hex", 0, len(new[0]))]])) == []


def test_clean_documents_teach_however_many_have_secrets(monkeypatch):
    seen = {}
    monkeypatch.setattr(crf, "train", lambda x, tags, lengths: seen.update(x=x, tags=tags, lengths=lengths))
    line = lambda i, j: f"plain words of line {'abcdefghij'[j % 10]} and {'abcdefghij'[i % 10]}\n"
    for secret, clean, want in ((400, 400, 375), (400, 20, 200), (10, 400, 650)):
        texts = ["".join(line(i, j) for j in range(10)) + f'token = "{i:040x}"' for i in range(secret)] + ["".join(line(i, j) for j in range(10)) for i in range(clean)]
        secrets.learn(texts)
        first = np.cumsum(seen["lengths"]) - seen["lengths"]
        hits = np.maximum.reduceat(seen["tags"], first) > 0
        named = seen["x"][first, 37] > 0  # a file that names secrets
        assert hits.sum() == min(2 * secret, 750) and (~hits).sum() == 750  # as they are, and varied and (~named).sum() == want


def test_varied_secrets_keep_their_places():
    for t in CASES:
        parts = secrets.secret_parts(t)
        for alphabet, letters in secrets.ALPHABETS.items():
            new, found = secrets.varied(t, parts, (alphabet,))
            assert (new, found) == secrets.varied(t, parts, (alphabet,))
            assert bool(found) == bool(parts) and (parts or new == t)
            for a, b in found:
                assert 16 <= b - a <= 64 and set(new[a + 1 : b - 1]) <= set(letters) and new[a].isalnum() and new[b - 1].isalnum()
            assert all(b <= c for (_, b), (c, _) in zip(found, found[1:]))


def test_field_finds_alphabets_it_was_not_taught(spark):
    """Secrets of the table drawn anew from an alphabet that was left out, where no pattern finds them; clean documents stay clean."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").where("text is not null").distinct().orderBy("text").collect()]
    has = [t for t in texts if secrets.secret_parts(t)]
    clean = [t for t in texts if not secrets.secret_parts(t)]
    hit = n = 0
    for left_out in ("mixed", "base64", "underscores"):
        model = secrets.learn(clean[::25] + has[::2], tuple(a for a in secrets.ALPHABETS if a != left_out))
        new = [secrets.varied(t, secrets.secret_parts(t), (left_out,)) for t in has[1::2]]
        base = [secrets.base_spans(t) for t, _ in new]
        found = list(secrets.added_spans(pa.array([t for t, _ in new]), model, base))
        want = {(i, *p) for i, (_, parts) in enumerate(new) for p in parts if not any(p[0] < y and x < p[1] for _, x, y in base[i])}
        hit, n = hit + len(want & set(found)), n + len(want)
        assert set(found) <= want
        some = clean[1::10]
        assert list(secrets.added_spans(pa.array(some), model, [[] for _ in some])) == []
    assert n > 100 and hit >= 0.95 * n


def test_addresses_are_no_secrets():
    rng = np.random.default_rng(0)
    word = lambda: "".join(rng.choice(list("abcdeilnorst"), rng.integers(2, 9)))
    teach = [f'{word()} {word()} token = "{rng.bytes(20).hex()}" {word()}' for _ in range(60)] + [" ".join(word() for _ in range(30)) for _ in range(60)]
    model = secrets.learn(teach)
    for t in ("see https://example.com/a/b-2020-01-01/page12 and write to x12@y.org", "version 1.2.3-beta4 of 2024-01-01T12:00:00Z", "key figures: 2019-2020 rose"):
        assert list(secrets.added_spans(pa.array([t]), model, [[]])) == []
    t = "auth: ghp_16C7e42F292c6912E7710c838347Ae178B4a"
    assert list(secrets.added_spans(pa.array([t]), model, [[]])) == [(0, 6, len(t))]


def test_viterbi_is_the_best_of_all_taggings():
    import itertools

    rng = np.random.default_rng(4)
    for _ in range(60):
        lengths = rng.integers(1, 6, 4)
        e = rng.normal(size=(lengths.sum(), 3)) * 2
        trans = rng.normal(size=(3, 3))
        trans[crf.OUT, crf.INSIDE] = crf.NEVER
        starts = np.cumsum(lengths) - lengths
        got = crf.viterbi(e, trans, starts)

        def score(tags, x):
            return sum(x[i, t] for i, t in enumerate(tags)) + sum(trans[a, b] for a, b in zip(tags, tags[1:])) + (crf.NEVER if tags[0] == crf.INSIDE else 0)

        for s, n in zip(starts, lengths):
            x = e[s : s + n]
            assert abs(score(tuple(got[s : s + n]), x) - max(score(t, x) for t in itertools.product(range(3), repeat=int(n)))) < 1e-9


def test_gradient_is_that_of_the_likelihood():
    """Training raises the likelihood of the labels over that of a model without weights."""
    rng = np.random.default_rng(1)
    x = np.concatenate((np.ones((40, 1)), rng.integers(0, 2, (40, 2))), 1).astype(float)
    tags = (x[:, 1] > 0).astype(int)
    w, trans = crf.train(x, tags, np.array([10, 10, 20]), epochs=200)
    assert (crf.viterbi(x @ w, trans, np.array([0, 10, 20])) == tags).all()


def test_nulls_repeats_long_and_clashing_names(spark, make_docs):
    docs = make_docs([(1, None), (1, ""), (2, KEY), (2, KEY), (None, "x " * 50_000 + KEY)])
    got = sorted(((r.doc_id or 9, [tuple(s) for s in r.spans]) for r in secrets.scan_secrets(docs.withColumn("spans", docs.lang)).collect()), key=str)
    assert got == [(1, []), (1, []), (2, [("access", 0, 20)]), (2, [("access", 0, 20)]), (9, [("access", 100_000, 100_020)])]
    assert secrets.scan_secrets(docs.limit(0)).count() == 0


def test_very_long_texts_teach_nothing_and_are_scanned_whole(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(secrets, "learn", lambda texts: seen.extend(texts))
    short = ["plain words", "password = abcdefgh1"]
    long = ["words " * 20_000, "words " * 20_000 + "token: abcdefgh2"]
    rows = secrets.scan_secrets(spark.createDataFrame(list(enumerate([*short, *long, None])), "doc_id long, text string")).collect()
    assert {r.doc_id: [tuple(x) for x in r.spans] for r in rows} == {0: [], 1: [("assign", 0, 20)], 2: [], 3: [("assign", 120_000, 120_016)], 4: []}
    assert sorted(seen) == sorted(short)


def test_no_field_without_a_line_that_has_no_secret(spark, make_docs):
    assert secrets.learn(["", KEY]) is None
    rows = secrets.scan_secrets(make_docs([(1, KEY), (2, "x " * 60_000)])).collect()
    assert sum(len(r.spans) for r in rows) == 1
