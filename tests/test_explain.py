"""Explanation views against brute force on a few documents."""

import pytest

import pyref
from textlens.operators import explain as X
from textlens.operators.model import test_token_lists as held_out, tokenize, train
from textlens.operators.scoring import FLOOR

TRAIN_DOCS = [
    ("en", "the cat sat on the mat and the dog"),
    ("en", "a dog and a cat"),
    ("fr", "le chat et le chien"),
    ("fr", "le chien sur le tapis"),
    ("de", "die katze und der hund"),
    ("de", "der hund auf der matte"),
]
TEST_TEXT = " ".join(["the cat le chien der hund"] * 9) + " matte"  # 55 words: 2 full chunks + a part chunk


@pytest.fixture(scope="module")
def pt(spark):
    rows = [(i, c, t, "train") for i, (c, t) in enumerate(TRAIN_DOCS)] + [(99, "en", TEST_TEXT, "test")]
    df = tokenize(spark.createDataFrame(rows, "doc_id long, class string, text string, split string"))
    model = train(df).persist()
    header = model.header(["en", "fr", "de"])
    return X.position_terms(held_out(df), model, header, FLOOR, 1e-4).persist(), header


def _terms(pt):
    r = pt[0].first()
    return r["pterms"], r["lps"], r["totals"], r["words"]


def test_percent_maps_sum(pt):
    terms, lps, totals, _ = _terms(pt)
    assert sum(pyref.pmap(list(totals))) == pytest.approx(99.99)
    assert sum(pyref.pmap(list(lps), prior=True)) == pytest.approx(99.99)
    c = X.sample_coords(pt[0], 3).first()
    assert [c["p0"], c["p1"], c["p2"]] == pyref.pmap(list(totals))


@pytest.mark.parametrize("chunk", [1, 7, 25, 55, 100])
def test_running_score_and_resets(pt, chunk):
    terms, _, _, words = _terms(pt)
    want_pcts, want_resets = pyref.running(terms, 0, len(terms), chunk)
    rs = X.running_score(pt[0], 3, chunk).orderBy("pos").collect()
    assert [[r["p0"], r["p1"], r["p2"]] for r in rs] == want_pcts
    got = X.reset_points(X.running_score(pt[0], 3, chunk), pt[0], pt[1], chunk).orderBy("pos").collect()
    assert [r["pos"] for r in got] == [j for j, _ in want_resets]
    for r, (j, p) in zip(got, want_resets):
        assert r["label"] == f"{j + 1}. {words[j]}"
        assert r["best_pct"] == max(max(p), 0)


def test_running_score_subrange(pt):
    terms, _, _, _ = _terms(pt)
    want, _ = pyref.running(terms, 5, 30, 10)
    rs = X.running_score(pt[0], 3, 10, start=5, end=30).orderBy("pos").collect()
    assert [[r["p0"], r["p1"], r["p2"]] for r in rs] == want
    assert X.running_score(pt[0], 3, 10, start=7, end=7).count() == 0


def test_word_uniqueness(pt):
    terms, _, _, words = _terms(pt)
    names = [c for c, _, _ in pt[1]]
    want = {}
    for w, t in zip(words, terms):
        mx, sec, idx = pyref.top_second(pyref.pmap(list(t)))
        key = (names[idx] if idx >= 0 else None, w)
        if key in want:
            want[key][1] += 1
        elif mx - sec != 0:
            want[key] = [mx - sec, 1]
    got = {(r["winner"], r["word"]): [r["diff"], r["count"]] for r in X.word_uniqueness(pt[0], pt[1]).collect()}
    assert got == want


def test_range_summary_and_winner(pt):
    terms, lps, _, _ = _terms(pt)
    sums = [0.0, 0.0, 0.0]
    for t in terms:
        sums = [a + b for a, b in zip(sums, t)]
    s = {r["kind"]: [r["p0"], r["p1"], r["p2"]] for r in X.range_summary(pt[0], 3).collect()}
    assert s["prior"] == pyref.pmap(list(lps), prior=True)
    assert s["no_prior"] == pyref.pmap(sums)
    w = X.range_winner(X.range_summary(pt[0], 3), pt[1]).first()
    with_p = s["with_prior"]
    assert w["winner"] == ["en", "fr", "de"][with_p.index(max(with_p))]


def test_top_second_quirk_and_true_second():
    # the original scan: second stays 0 when both lower values are negative and the top comes last
    assert pyref.top_second([-5.0, -3.0, 108.0]) == (108.0, 0, 2)
    assert pyref.top_second([108.0, -5.0, -3.0]) == (108.0, -3.0, 0)


def test_word_uniqueness_true_second(pt):
    terms, _, _, words = _terms(pt)
    names = [c for c, _, _ in pt[1]]
    want = {}
    for w, t in zip(words, terms):
        p = pyref.pmap(list(t))
        mx, _, idx = pyref.top_second(p)
        diff = mx - sorted(p, reverse=True)[1]
        key = (names[idx] if idx >= 0 else None, w)
        if key in want:
            want[key][1] += 1
        elif diff != 0:
            want[key] = [diff, 1]
    got = {(r["winner"], r["word"]): [r["diff"], r["count"]] for r in X.word_uniqueness(pt[0], pt[1], second="true").collect()}
    assert got == want


def test_percent_map_of_zero_priors_is_null(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([([0.0, 0.0, 0.0],)], "v array<double>")  # ln of three priors of 1
    r = df.select(X.percent_map(F.col("v"), 3, prior=True).alias("p"), *[c.alias(f"q{i}") for i, c in enumerate(
        X.percent_cols([F.col("v")[i] for i in range(3)], prior=True))]).first()
    assert r["p"] == [None, None, None] and [r["q0"], r["q1"], r["q2"]] == [None, None, None]


def test_samples_that_share_a_name_stay_apart(spark):
    """Sample numbers that restart in every class: each sample's running score is its own."""
    from pyspark.sql import functions as F

    from textlens.operators.explain import position_terms, running_score
    from textlens.operators.scoring import FLOOR
    from textlens.plans.classify import classify

    rows = [(i, c, f"{c} {c} word{i} shared") for c in ("aa", "bb", "cc") for i in range(8)]
    corpus = spark.createDataFrame(rows, "doc_id long, class string, text string")
    run = classify(corpus, FLOOR, 1e-6, classes=["aa", "bb", "cc"])
    pt = position_terms(run.test, run.model, run.header, FLOOR, 1e-6)
    rs = running_score(pt, 3, 25)
    alone = {c: running_score(pt.where(F.col("class") == c), 3, 25).collect() for c in ("aa", "bb", "cc")}
    assert rs.count() == 3 * 2 * 4
    for c, expected in alone.items():
        got = rs.where(F.col("class") == c).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, expected))
    run.release()
