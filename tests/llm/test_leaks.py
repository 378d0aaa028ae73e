import hashlib
import random
import re

import pytest

from gtfsforge.llm import decontaminate
from gtfsforge.llm.decontaminate import decontaminated
from gtfsforge.llm.queries_leaks import SQL_LEAKS, op12_benchmark_leaks

ITEMS = "item_id long, text string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_hand(docs, items, width=10):
    """Every window at every place."""
    windows = [(i, w[k : k + min(width, len(w))]) for i, w in ((i, words(t)) for i, t in items) if w for k in range(len(w) - min(width, len(w)) + 1)]
    out = []
    for i, t, *_ in docs:
        w = words(t)
        hit, ids = set(), set()
        for item, x in windows:
            for k in range(len(w) - len(x) + 1):
                if w[k : k + len(x)] == x:
                    hit |= set(range(k, k + len(x)))
                    ids.add(item)
        out.append((str(i), len(w), len(hit), sorted(str(x) for x in ids if x is not None)))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, list(r["items"] or [])) for r in df.collect())


def tables():
    rng = random.Random(4)
    some = lambda n, most: " ".join(rng.choice("abcdefgh")[: rng.randint(1, 1)] + str(rng.randint(0, most)) for _ in range(n))
    items = [(i, some(rng.choice([1, 2, 3, 9, 10, 11, 14, 40]), 3)) for i in range(40)]
    items += [(7, some(12, 3)), (50, None), (51, ""), (52, "...!"), (None, "free item of no id at all"), (60, items[4][1]), (100, "Á É-ß, 'İx' 12 34"), (9, "a a a a a a a a a a a a")]
    docs = [(i, some(rng.randint(0, 120), 3)) for i in range(80)]
    for i in range(80, 140):
        j, t = items[rng.randrange(len(items))]
        cut = (t or "").split(" ")[rng.randint(0, 3) :]
        docs.append((i, some(5, 9) + ". " + ", ".join(cut).upper() + "; " + some(4, 9)))
    docs += [(200, None), (201, ""), (202, "?!"), (203, " ".join(x[1] or "" for x in items)), (204, "a " * 3000), (205, "Á\n\né ß İX 12\x0034 -- free ITEM of no id at all")]
    docs += [(82, docs[82][1])] * 3 + [(None, docs[83][1])] + [(300 + i, docs[85][1]) for i in range(30)]
    docs += [(400, "w" * 300_000 + " " + items[3][1] + " " + "q1 " * 40_000 + items[6][1])]
    return docs, items


@pytest.mark.parametrize("width,gram", [(10, 3), (4, 2), (3, 5), (10, 1)])
def test_by_hand(spark, make_docs, width, gram):
    docs, items = tables()
    docs = docs[:-1] if width != 10 else docs
    df = decontaminated(make_docs(docs).repartition(7), spark.createDataFrame(items, ITEMS), width, gram)
    assert got(df) == by_hand(docs, items, width)


def test_without_broadcasts(spark, make_docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(decontaminate, "LEAST_BITS", 3)
    monkeypatch.setattr(decontaminate, "MOST_BITS", 4)  # a field that lets nearly everything through
    docs, items = tables()
    assert got(decontaminated(make_docs(docs), spark.createDataFrame(items, ITEMS))) == by_hand(docs, items)


def test_against_sql(spark, make_docs, against_sql, sf):
    docs, items = tables()
    mine, sql = against_sql(spark, op12_benchmark_leaks, SQL_LEAKS, documents=make_docs(docs), benchmark=spark.createDataFrame(items, ITEMS))
    assert mine == sql
    both = {n: spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "benchmark")}
    mine, sql = against_sql(spark, op12_benchmark_leaks, SQL_LEAKS, **both)
    assert mine == sql and sum(r[-1] for r in mine) > 0


def test_empty_tables_and_clashing_names(spark, make_docs):
    docs, items = make_docs([(1, "one two three"), (2, None)]), spark.createDataFrame([(5, "two three")], ITEMS)
    assert got(decontaminated(docs.limit(0), items)) == []
    assert got(decontaminated(docs, items.limit(0))) == [("1", 3, 0, []), ("2", 0, 0, [])]
    more = make_docs([(1, "one two three", None, None, 9, 8, "z")], ", h1 long, item_id long, near string")
    other = spark.createDataFrame([(5, "two three", "x", 1)], ITEMS + ", window string, doc_id long")
    assert got(decontaminated(more, other)) == [("1", 3, 2, ["5"])]


def test_digest_of_no_item(spark, sf):
    r = op12_benchmark_leaks(spark, sf).where("n_hit = 0").first()
    assert r.items_sha256 == hashlib.sha256(b"").hexdigest() and r.n_items == 0 and r.contaminated is False
