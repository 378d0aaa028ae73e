import numpy as np

from gtfsforge.llm.language import identify, infer, learn, mixture
from gtfsforge.llm.queries_language import op4_language_id

EN = "the quick brown fox jumps over the lazy dog and then the other thing happened with that weather "
DE = "der schnelle braune fuchs springt über den faulen hund und dann geschah das andere nicht mehr "


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    rows = op4_language_id(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) > 100
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_mixture_shares_are_found(spark, make_docs):
    teach = make_docs([(i, (EN, DE)[i % 2] * 30, ("en", "de")[i % 2]) for i in range(8)])
    model = learn(teach)
    assert model[0] == ["de", "en"]
    assert np.allclose(model[1].sum(0), 1)
    docs = make_docs([(1, EN * 5), (2, DE * 5), (3, EN * 9 + DE * 3), (4, None), (5, ""), (6, "123 -- !!"), (7, "中"), (1, EN * 5), (None, EN * 3000)])
    got = identify(docs, model).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 9
    assert by[1].lang_pred == "en" and by[1].score == 1.0 and by[2].lang_pred == "de"
    assert by[3].lang_pred == "en" and 0.65 < by[3].score < 0.85 and set(by[3].proportions) == {"de", "en"}
    assert [(by[k].lang_pred, by[k].score) for k in (4, 5, 6)] == [("und", 0.0)] * 3
    assert by[None].lang_pred == "en"
    assert identify(docs.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark, make_docs):
    model = learn(make_docs([(1, None, "en"), (2, "text", None)]))
    assert model[0] == []
    assert identify(make_docs([(1, "some text")]), model).first().lang_pred == "und"


def test_em_reaches_the_likelihood_of_a_grid_search():
    rng = np.random.default_rng(0)
    prob = rng.dirichlet(np.ones(50), size=2).T
    draws = np.concatenate((rng.choice(50, 300, p=prob[:, 0]), rng.choice(50, 100, p=prob[:, 1])))
    code, count = np.unique(draws, return_counts=True)
    pi, like = mixture(prob[code], np.zeros(len(code), int), count, 1, np.full((1, 2), 0.5), 200)
    grid = np.linspace(0.001, 0.999, 999)
    best = max((count * np.log(prob[code] @ np.array([g, 1 - g]))).sum() for g in grid)
    assert abs(like[0] - best) < 1e-2
    table = np.full((1 << 16, 2), 1e-9)
    table[:50] = prob
    assert infer(table, code.astype(np.uint32), count, 2)[1].sum() == 0
