"""Order-free sums against the folds in word order."""

import random

import pytest
from pyspark.sql import functions as F

from textlens.operators import sums as S
from textlens.operators.model import test_token_lists as held_out, tokenize, train
from textlens.operators.scoring import ADDONE, ADDONE_AS_CODED, FLOOR, PRODUCT, score


def corpus(spark, seed=1, n=120, longest=60):
    draw = random.Random(seed)
    vocabulary = [f"w{int(draw.paretovariate(0.6))}" for _ in range(400)]
    rows = []
    for i in range(n):
        words = [draw.choice(vocabulary) for _ in range(draw.randrange(0, longest))]
        rows.append((i, ["a", "b", "c", None][i % 4] if i % 3 else "a", " ".join(words), "train" if i % 2 else "test"))
    rows += [(1000, "a", "new words only", "test"), (1001, "b", "w1", "test"), (1002, "b", "", "test")]
    df = tokenize(spark.createDataFrame(rows, "doc_id long, class string, text string, split string").repartition(3))
    return train(df.where("class is not null")).persist(), held_out(df)


@pytest.mark.parametrize("hot", [0, 3, 1 << 16])
@pytest.mark.parametrize("mode", [FLOOR, ADDONE, ADDONE_AS_CODED, PRODUCT])
def test_sums_equal_the_fold(spark, monkeypatch, mode, hot):
    """With no, few and all words broadcast."""
    monkeypatch.setattr(S, "HOT_WORDS", hot)
    model, test = corpus(spark)
    want = {(r["class"], r["doc_id"]): r for r in score(test, model, mode, zero_fix=1e-3).collect()}
    got = {(r["class"], r["doc_id"]): r for r in S.score_sums(test, model, mode, zero_fix=1e-3).collect()}
    assert got.keys() == want.keys() and len(got) > 50
    for key, r in want.items():
        assert got[key]["pred"] == r["pred"]
        assert got[key]["scores"] == pytest.approx(r["scores"], rel=1e-12)


def test_sums_do_not_depend_on_the_layout(spark):
    model, test = corpus(spark, seed=2)
    one, two = ({r["doc_id"]: r["scores"] for r in S.score_sums(t, model, FLOOR).collect()} for t in (test.repartition(7), test.coalesce(1).orderBy(F.desc("doc_id"))))
    assert one == two  # every bit


def test_products_around_the_smallest_double(spark):
    """Long documents whose products vanish, or nearly; ties at zero go to the first class."""
    rows = [(0, "a", " ".join(f"x{i}" for i in range(200)), "train"), (1, "b", " ".join(f"x{i}" for i in range(100, 300)), "train")]
    rows += [(10 + n, "a", " ".join(f"x{(i * 7) % 320}" for i in range(n)), "test") for n in (*range(120, 160), 500)]
    df = tokenize(spark.createDataFrame(rows, "doc_id long, class string, text string, split string"))
    model, test = train(df), held_out(df)
    want = {r["doc_id"]: (r["scores"], r["pred"]) for r in score(test, model, PRODUCT).collect()}
    got = {r["doc_id"]: (r["scores"], r["pred"]) for r in S.score_sums(test, model, PRODUCT).collect()}
    assert got.keys() == want.keys() and want[510] == ([0.0, 0.0], "a")
    for d, (scores, pred) in want.items():
        assert got[d][1] == pred and got[d][0] == pytest.approx(scores, rel=1e-9, abs=0)


def test_parts_hold_the_whole_double(spark):
    draw = random.Random(4)
    xs = [draw.uniform(-40, 40) for _ in range(200)] + [0.0, -1.0, 2.0**-54, -(2.0**-54)]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", *[c.alias(n) for n, c in zip("hl", S.parts(F.col("x")))])
    for r in df.collect():
        assert abs(r["h"] / 2**24 + r["l"] / 2**54 - r["x"]) <= 2.0**-48 and 0 <= r["l"] < 2**30
    empty = corpus(spark)[1].limit(0)
    assert S.score_sums(empty, corpus(spark)[0]).count() == 0


@pytest.mark.parametrize("name", ["nb_floor", "nb_fixed_floor", "nb_addone", "nb_addone_as_coded", "nb_report", "zero_fix_sweep"])
def test_no_document_is_gathered(spark, name):
    from paths import SF001
    from textlens.plans import queries as Q

    plan = Q.QUERIES[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "sort_array" not in plan


def test_repeats_share_one_pass(spark, monkeypatch):
    """Equal to the runs one by one, folded in word order; keys may repeat. No seed has a row of its own for a token, and no
    document's vectors are gathered."""
    from textlens.operators.scoring import FIXED_FLOOR_REJECT
    from textlens.plans import experiments as X

    draw = random.Random(7)
    rows = [(i, "abc"[i % 3], " ".join(f"w{int(draw.paretovariate(0.7))}" for _ in range(draw.randrange(0, 30)))) for i in range(90)]
    rows += [(3, "a", "w1 w2 w900"), (4, "b", ""), (None, "c", "w1"), (7, None, "w2")]
    df = spark.createDataFrame(rows, "doc_id long, class string, text string").repartition(3)
    want_split = {}

    def in_order(docs, seeds, mode, zero_fix, reject):
        want_split["docs"] = docs.count()
        return kept(docs, seeds, mode, zero_fix, reject)

    kept, shared = X._repeats_in_order, X._repeats
    got = X.repeat_mean(df, [1, 2], reject=FIXED_FLOOR_REJECT)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "sort_array" not in plan
    got = sorted(map(tuple, got.collect()))
    monkeypatch.setattr(X, "_repeats", in_order)
    want = sorted(map(tuple, X.repeat_mean(df, [1, 2], reject=FIXED_FLOOR_REJECT).collect()))
    assert got == want and want_split["docs"] >= len(rows) - 2 and shared is not in_order


def test_rare_words_travel_once_a_token(spark, monkeypatch):
    """The rows dealt to documents are tokens with packed counts, not a row for each candidate."""
    monkeypatch.setattr(S, "HOT_WORDS", 0)
    model, test = corpus(spark, n=60)
    dealt = []
    add = S._add_rare

    def watched(rows, tables):
        dealt.append(rows.count())
        return add(rows, tables)

    monkeypatch.setattr(S, "_add_rare", watched)
    S.score_sums(test, model, FLOOR).collect()
    known = {r["word"] for r in model.likelihood.select("word").distinct().collect()}
    assert dealt == [sum(w in known for r in test.collect() for w in r["words"])]


def test_a_line_gets_only_the_steps_of_its_sizes(spark):
    from pyspark.sql import functions as F

    from textlens.operators.sums import coded, decoded
    from textlens.plans.experiments import _needed_steps, _tested_sizes

    k_n, sizes = 2, [10, 20, 30, 40, 50, 60]
    trained, j_n = [s // 5 for s in sizes], len(sizes)
    steps = {(k, j): 7 * k + j + 1 for k in range(k_n) for j in range(j_n) if (k + j) % 3}
    codes = F.array(*[coded(F.lit(v), F.lit(k * j_n + j)) for (k, j), v in steps.items()])
    first, last = _tested_sizes(sizes, trained)
    lines = spark.range(60).select(F.col("id").alias("line_no"), codes.alias("codes"), first.alias("first"), last.alias("last"))
    rows = lines.withColumn("codes", F.transform(_needed_steps(F.col("codes"), k_n, j_n), lambda c: F.struct(*decoded(c)))).collect()
    for r in rows:
        tested = [j for j in range(j_n) if trained[j] <= r["line_no"] < sizes[j]]
        assert tested == list(range(r["first"], r["last"] + 1))
        got = [(i // j_n, i % j_n, v) for v, i in r["codes"]]
        for k in range(k_n):
            for j in tested:
                assert sum(v for k2, j2, v in got if k2 == k and j2 <= j) == sum(v for (k2, j2), v in steps.items() if k2 == k and j2 <= j)
    assert all(len(r["codes"]) <= k_n * max(1, r["last"] - r["first"] + 1) for r in rows) and sum(len(r["codes"]) for r in rows) < 0.7 * len(rows) * len(steps)
