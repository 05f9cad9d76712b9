"""The five-review worked example: counts, add-one scores and the prediction."""

import math

import pytest
from pyspark.sql import functions as F

from textlens.operators.model import Model, tokenize, train
from textlens.operators.scoring import ADDONE, PRODUCT, score

TOY = [
    (1, "Good", "excellent headset"),
    (2, "Bad", "mic doesnt work"),
    (3, "Good", "love this headset"),
    (4, "Bad", "bad quality mic"),
    (5, "Good", "great mic"),
]
QUERY = "excellent headset mic quality"


@pytest.fixture(scope="module")
def toy(spark):
    df = spark.createDataFrame(TOY, "doc_id long, class string, text string").withColumn("split", F.lit("train"))
    model = train(tokenize(df)).persist()
    test = tokenize(spark.createDataFrame([(9, "Good", QUERY)], "doc_id long, class string, text string"))
    return model, test


def test_counts(toy):
    model, _ = toy
    priors = {r["class"]: r["n_docs"] for r in model.priors.collect()}
    assert priors == {"Good": 3, "Bad": 2}
    totals = {r["class"]: r["n_words"] for r in model.totals().collect()}
    assert totals == {"Good": 7, "Bad": 6}
    lik = {(r["class"], r["word"]): r["cnt"] for r in model.likelihood.collect()}
    assert lik[("Good", "headset")] == 2 and lik[("Bad", "mic")] == 2
    assert model.likelihood.select("word").distinct().count() == 10


def test_product_as_coded(toy):
    model, test = toy
    header = model.header()
    r = score(test, model, PRODUCT, header=header).collect()[0]
    s = dict(zip([c for c, _, _ in header], r["scores"]))
    assert s["Good"] == pytest.approx(0.0149938, rel=1e-5)
    assert s["Bad"] == pytest.approx(0.0092593, rel=1e-5)
    assert r["pred"] == "Good"


def test_log_addone(toy):
    model, test = toy
    header = model.header()
    r = score(test, model, ADDONE, header=header).collect()[0]
    s = dict(zip([c for c, _, _ in header], r["scores"]))
    good = math.log(3) + math.log(2 / 7) + math.log(3 / 7) + math.log(2 / 7) + math.log(1 / 7)
    assert s["Good"] == good  # same sequence of float operations as the per-word loop
    assert r["pred"] == "Good"


def test_textbook_formula_with_vocabulary(spark):
    # (cnt+1)/(n+V) with priors 3/5 and 2/5: 0.0000862 and 0.0000366
    good = (2 / 17) * (3 / 17) * (2 / 17) * (1 / 17) * 3 / 5
    bad = (1 / 16) * (1 / 16) * (3 / 16) * (2 / 16) * 2 / 5
    assert round(good, 7) == 0.0000862 and round(bad, 7) == 0.0000366


def test_prior_scale_does_not_change_prediction(toy, spark):
    model, test = toy
    scaled = Model(model.priors.withColumn("n_docs", F.col("n_docs") * 1000), model.likelihood)
    a = score(test, model, ADDONE).collect()[0]["pred"]
    b = score(test, scaled, ADDONE).collect()[0]["pred"]
    assert a == b == "Good"
