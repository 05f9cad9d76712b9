"""Scorers, arg-max rules and the report against the plain-Python model."""

import pytest

import pyref
from textlens.operators import evaluate as ev
from textlens.operators.model import merge_models, test_token_lists as held_out, tokenize, train
from textlens.operators.scoring import ADDONE, ADDONE_AS_CODED, FLOOR, PRODUCT, score

TRAIN_DOCS = [
    ("pos", "good great fine good"),
    ("pos", "great movie, really good!"),
    ("neg", "bad awful movie"),
    ("neg", "awful awful plot"),
    ("neu", "plot movie time"),
    ("neu", "the and of"),  # counts in priors, adds words
]
TEST_DOCS = [
    ("pos", "good plot"),
    ("neg", "awful movie time"),
    ("neu", "unknown words only"),
    ("pos", "great"),
    ("neg", "!!!"),  # no kept word: not a test sample
]


@pytest.fixture(scope="module")
def data(spark):
    rows = [(i, c, t, "train") for i, (c, t) in enumerate(TRAIN_DOCS)] + [
        (100 + i, c, t, "test") for i, (c, t) in enumerate(TEST_DOCS)
    ]
    df = tokenize(spark.createDataFrame(rows, "doc_id long, class string, text string, split string"))
    model = train(df).persist()
    return model, held_out(df)


@pytest.mark.parametrize("mode", [FLOOR, ADDONE, ADDONE_AS_CODED, PRODUCT])
def test_scores_match_per_word_loop(data, mode):
    model, test = data
    priors, lik = pyref.train(TRAIN_DOCS)
    header = model.header()
    got = {r["doc_id"]: (r["scores"], r["pred"]) for r in score(test, model, mode, zero_fix=1e-3, header=header).collect()}
    assert sorted(got) == [100, 101, 102, 103]
    for i, (c, t) in enumerate(TEST_DOCS[:4]):
        want = pyref.score(pyref.words(t), priors, lik, mode, zero_fix=1e-3)
        scores, pred = got[100 + i]
        assert scores == [want[k] for k, _, _ in header]  # bit-identical
        assert pred == pyref.argmax(want)


def test_tie_goes_to_first_class_and_reject(data, spark):
    model, test = data
    header = model.header(["neu", "pos", "neg"])
    r = score(test, model, FLOOR, zero_fix=1e-3, header=header).where("doc_id = 102").first()
    # "unknown words only": every term is ln(1e-3); priors neu 2, pos 2, neg 2 -> tie -> first chosen class
    assert r["pred"] == "neu"
    r2 = score(test, model, FLOOR, zero_fix=1e-3, reject=0.0, header=header).where("doc_id = 102").first()
    assert r2["pred"] == ""


def test_report_with_unclassified(data):
    model, test = data
    pred = score(test, model, FLOOR, zero_fix=1e-3, reject=-9.0).select("doc_id", "class", "pred")
    conf = {r["class"]: r for r in ev.confusion(pred).collect()}
    n = pred.count()
    for c, r in conf.items():
        if r["support"] > 0:
            assert r["tp"] + r["fp"] + r["fn"] + r["tn"] == n
        else:
            assert r["tn"] == 0 and r["fn"] == 0
    assert sum(r["support"] for r in conf.values()) == n
    rep = {r["class"]: r for r in ev.report(ev.confusion(pred)).collect()}
    rows = [r for c, r in rep.items() if c != ev.AVG_TOTAL]
    avg = rep[ev.AVG_TOTAL]
    assert avg["precision"] == pytest.approx(sum(r["precision"] for r in rows) / len(rows))
    assert avg["support"] == n


def test_merge_second_wins(data, spark):
    model, _ = data
    other = train(
        tokenize(spark.createDataFrame([(1, "pos", "zzz", "train")], "doc_id long, class string, text string, split string"))
    )
    m = merge_models(model, other)
    pos = {r["word"]: r["cnt"] for r in m.likelihood.where("class = 'pos'").collect()}
    assert pos == {"zzz": 1}
    assert m.priors.where("class = 'pos'").first()["n_docs"] == 1
    assert m.likelihood.where("class = 'neg'").count() == model.likelihood.where("class = 'neg'").count()
    assert merge_models(m, other).likelihood.count() == m.likelihood.count()


def test_class_without_words_is_not_a_candidate(spark):
    rows = [(1, "a", "x y", "train"), (2, "b", "!!!", "train"), (3, "a", "x", "test")]
    df = tokenize(spark.createDataFrame(rows, "doc_id long, class string, text string, split string"))
    model = train(df)
    assert [c for c, _, _ in model.header()] == ["a"]
    assert {r["class"]: r["n_docs"] for r in model.priors.collect()} == {"a": 1, "b": 1}
    assert score(held_out(df), model, FLOOR).first()["pred"] == "a"


def test_one_word_document_as_coded(spark):
    import math

    rows = [(1, "a", "x y", "train"), (2, "b", "y z z", "train"), (3, "a", "x", "test")]
    df = tokenize(spark.createDataFrame(rows, "doc_id long, class string, text string, split string"))
    model = train(df)
    header = model.header()
    r = score(held_out(df), model, ADDONE_AS_CODED, header=header).first()
    # one word: the total is ln prior counted twice, the only word is never added
    assert r["scores"] == [2 * math.log(1), 2 * math.log(1)]
    assert r["pred"] == "a"  # tie: first class


@pytest.mark.parametrize("mode", [FLOOR, ADDONE])
def test_sparse_sum_equals_dense(spark, mode):
    from paths import SF01
    from textlens.operators.scoring import score_sparse
    from textlens.plans.classify import prepare
    from textlens.sources.corpus import documents_corpus

    docs = prepare(documents_corpus(spark, SF01, "source")).persist()
    model = train(docs).persist()
    header = model.header()
    test = held_out(docs)
    dense = {r["doc_id"]: r for r in score(test, model, mode, zero_fix=1e-5, header=header).collect()}
    sparse = {r["doc_id"]: r for r in score_sparse(test, model, header, mode, zero_fix=1e-5).collect()}
    assert dense.keys() == sparse.keys()
    for d, r in dense.items():
        for a, b in zip(r["scores"], sparse[d]["scores"]):
            assert a == pytest.approx(b, rel=1e-9)
        assert r["pred"] == sparse[d]["pred"]


def test_sparse_sum_shuffles_no_frequent_word(spark):
    """Frequencies are counted in the documents' rows, and what stands in all documents meets a broadcast table."""
    from textlens.operators.model import word_frequencies
    from textlens.operators.scoring import score_sparse
    from textlens.operators.sums import hot_words

    rows = [(i, "ab"[i % 2], f"the the word{i} of", "test" if i % 3 == 0 else "train") for i in range(12)] + [(0, "a", "the the word0 of", "test"), (None, "b", "", "test")]
    df = tokenize(spark.createDataFrame(rows, "doc_id long, class string, text string, split string"))
    got = sorted(map(tuple, word_frequencies(df.where("doc_id <= 1").select("doc_id", "words")).collect()))
    assert got == sorted([(0, "the", 2), (0, "word0", 1), (0, "of", 1)] * 2 + [(1, "the", 2), (1, "word1", 1), (1, "of", 1)])
    model = train(df)
    header = model.header()
    assert {r["word"] for r in hot_words(model.likelihood.select("word", model.likelihood["cnt"].alias("n")), sum(n for _, _, n in header), 4).collect()} >= {"the", "of"}
    sparse = score_sparse(held_out(df), model, header, ADDONE)
    plan = sparse._jdf.queryExecution().executedPlan().toString()
    assert not any("Aggregate" in line and "word#" in line and "doc_id#" in line for line in plan.splitlines())
    dense = {(r["doc_id"], r["class"]): r["scores"] for r in score(held_out(df.dropDuplicates()), model, ADDONE, header=header).collect()}
    for r in sparse.where("doc_id > 0").collect():
        assert r["scores"] == pytest.approx(dense[r["doc_id"], r["class"]], rel=1e-9)
