"""Vectors, conversations, mixtures, the pipeline and the registered queries."""

import math

import numpy as np
import pytest
from brute import Groups, jaccard_groups, named, plain_words, tuples
from pyspark.sql import functions as F

import corpus_pipeline
from textlens.llm import queries as Q
from textlens.llm.graph import components
from textlens.llm.mixing import fit, memberships, mixture, rates
from textlens.llm.near_vectors import near_vectors
from textlens.llm.quotations import in_reply_order, linked_messages, parse, unquoted

# ---------------------------------------------------------------- vectors


def brute_vectors(rows, cosine=0.93):
    groups, links = Groups(len(rows)), [0] * len(rows)

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float)
        v = v / np.abs(v).max()
        return v / np.linalg.norm(v)

    units = [unit(v) for _, v, _ in rows]
    for i, x in enumerate(units):
        for j in range(i):
            y = units[j]
            if x is not None and y is not None and rows[i][2] is not None and rows[i][2] == rows[j][2] and len(x) == len(y) and x @ y >= cosine:
                links[i] += 1
                links[j] += 1
                groups.tie(i, j)
    names = named(groups, [r[0] for r in rows])
    return sorted(((i, n, c, i is not None and i == c) for (i, _, _), n, c in zip(rows, links, names)), key=repr)


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr("textlens.llm.near_vectors.BLOCK", 16)  # many blocks
    rng = np.random.default_rng(4)
    rows = []
    for i in range(150):
        base = rng.standard_normal(24)
        rows.append((2 * i, base.tolist(), i % 3))
        if i % 10 == 0:
            rows += [(1000 + 20 * i + k, (base + rng.standard_normal(24) * 0.15 * k).tolist(), i % 3) for k in range(4)]
    rows += [(5000 + k, rows[0][1], 0) for k in range(6)] + [(5000, rows[0][1], 0), (None, rows[0][1], 0)]
    nan, inf = float("nan"), float("inf")
    rows += [(6000 + k, v, 0) for k, v in enumerate([None, [], [0.0] * 24, [nan] * 24, [inf] * 24, [None] * 24, [1.0] * 8, [2.0] * 8])]
    rows += [(7000, rows[0][1], None), (7001, rows[0][1], None), (7002, [1e200] * 24, 1), (7003, [1e-200] * 24, 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, class string, place int").repartition(4)
    assert tuples(near_vectors(spark, df), "vec_id", "n_links", "component_id", "kept") == brute_vectors(rows)
    assert near_vectors(spark, df.limit(0)).count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 20), (30, 31), (31, 30), (40, 41)] + [(100, 100 + i) for i in range(1, 50)] + [(200 + i, 201 + i) for i in range(30)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(tuple(r) for r in components(df).collect())
    assert got[9] == got[8] == got[1] == 1 and got[31] == 30 and got[149] == 100 and got[230] == 200 and 20 not in got
    assert components(df.limit(0)).count() == 0


# ---------------------------------------------------------------- conversations

MESSAGES = [
    (1, 0, "u", "Hello there friend.\nHow are you?\n\nI have a question."),
    (1, 1, "a", "> Hello there friend.\n> How are you?\nFine!"),
    (1, 2, "u", "Other topic here"),
    (1, 3, "a", "On Monday, X wrote:\n> Fine!\n>> hello THERE friend.\n>> How are you?\nGreat"),
    (1, 4, "u", "> other topic here\nyes"),
    (1, 5, "b", "> unknown words\nq"),
    (2, 0, "u", "> Fine!\nno"),
    (1, None, "u", "x"),
    (None, 1, "u", "> Fine!"),
    (3, 0, "u", None),
    (3, 1, "u", ""),
    (1, 1, "a", "> Hello there friend.\n> How are you?\nFine!"),
]


def test_linked_messages(spark):
    df = spark.createDataFrame([(*m, 1, "x") for m in MESSAGES], "conv_id long, turn long, role string, text string, hash int, level string")
    found = linked_messages(spark, df)
    by = {(r["conv_id"], r["turn"]): (r["n_quotes"], r["n_linked"], r["reply_to"], r["thread"], r["text"]) for r in found.collect()}
    assert found.count() == len(MESSAGES)
    assert by[1, 1] == (1, 1, 0, 0, "Fine!")
    assert by[1, 3] == (2, 2, 1, 0, "Great")
    assert by[1, 4] == (1, 1, 2, 2, "yes")
    assert by[1, 5] == (1, 0, None, 5, "q")
    assert by[2, 0] == (1, 0, None, 0, "no")
    assert by[3, 0] == (0, 0, None, 0, None) and by[3, 1] == (0, 0, None, 1, "")
    assert by[1, None][3] is None and by[None, 1][3] is None
    order = [r["turn"] for r in in_reply_order(found.where("conv_id = 1 and turn is not null")).collect()]
    assert order == [0, 1, 1, 3, 2, 4, 5]
    assert linked_messages(spark, df.limit(0)).count() == 0


def test_latest_original_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr("textlens.llm.quotations.CHUNK", 4)
    rows = [(1, t, "u", "> same line\nmine" if t % 7 == 3 else "same line" if t % 5 == 0 else f"text {t}") for t in range(60)]
    found = {r["turn"]: r["reply_to"] for r in linked_messages(spark, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    for t in range(60):
        originals = [u for u in range(t) if u % 5 == 0 and u % 7 != 3]
        assert found[t] == (max(originals) if t % 7 == 3 and originals else None)


def test_parse_round_trip():
    text = "own\n> a\n> > b\n>c\n\nend"
    assert parse(text) == [(0, ["own"]), (1, ["a"]), (2, ["b"]), (1, ["c"]), (0, ["", "end"])]
    assert unquoted(text) == "own\n\nend" and unquoted("no quote\n") == "no quote\n" and unquoted("On it\nI wrote:") == "On it\nI wrote:"


# ---------------------------------------------------------------- mixtures


def brute_rates(tokens, posterior, targets, stay):
    """The same least squares by many plain projected-gradient steps."""
    n, mean = len(tokens), tokens.mean()
    scale = np.maximum(np.maximum(tokens @ posterior, targets) / (mean * n), 1e-3)
    w, r = tokens[:, None] / mean * posterior, np.ones(n)
    step = 1 / (((w**2).mean(0) / scale).sum() + stay)
    for _ in range(20_000):
        error = (r @ w / n - targets / (mean * n)) / scale
        r = np.maximum(0, r - step * (w @ error + stay * (r - 1)))
    return r


def test_rates_meet_targets(spark, monkeypatch):
    monkeypatch.setattr("textlens.llm.mixing.ROUNDS", 300)
    monkeypatch.setattr("textlens.llm.mixing.ENOUGH", 1e-12)
    rng = np.random.default_rng(2)
    tokens = rng.integers(0, 400, 60)
    posterior = rng.dirichlet([0.3, 0.3, 0.3], 60)
    members = spark.createDataFrame([(i, int(t), p.tolist()) for i, (t, p) in enumerate(zip(tokens, posterior))], "doc_id long, tokens long, posterior array<double>").cache()
    targets = np.array([0.6, 0.4, 0.0]) * tokens.sum()
    found, info = rates(members, 3, targets)
    got = np.array([r["rate"] for r in found.orderBy("doc_id").collect()])
    from textlens.llm.mixing import STAY

    best = brute_rates(tokens, posterior, targets, STAY)
    assert (got >= 0).all() and np.abs(got - best).max() < 0.02
    assert np.abs(info["after"] - targets)[:2].max() < 0.05 * tokens.sum()


@pytest.mark.parametrize("long", [20_000, 2_000_000])
def test_rates_with_a_few_very_long_documents(spark, long):
    """Registered settings; long documents are up to thousands of times the mean."""
    rng = np.random.default_rng(3)
    n = 4000
    tokens = rng.integers(20, 400, n)
    tokens[:4] = long
    kind = rng.choice(3, n, p=[0.6, 0.37, 0.03])
    kind[:4] = [0, 1, 0, 1]
    posterior = np.full((n, 3), 0.01) + 0.97 * np.eye(3)[kind]
    members = spark.createDataFrame([(i, int(t), p.tolist()) for i, (t, p) in enumerate(zip(tokens, posterior))], "doc_id long, tokens long, posterior array<double>").cache()
    targets = np.array([0.7, 0.3, 0.0]) * tokens.sum()
    found, info = rates(members, 3, targets)
    got = np.array([r["rate"] for r in found.orderBy("doc_id").collect()])
    from textlens.llm.mixing import STAY

    # at the least, and only there, each rate is what the domains' errors make it
    after = (got * tokens) @ posterior
    assert np.allclose(after, info["after"], rtol=1e-9)
    error = (after - targets) / np.maximum(tokens @ posterior, targets)
    best = np.maximum(0, 1 - tokens / tokens.mean() * (posterior @ error) / STAY)
    assert np.abs(got - best).max() < 1e-2 * max(1, got.max())
    objective = lambda r: ((((r * tokens) @ posterior - targets) ** 2 / np.maximum(tokens @ posterior, targets)).sum() / tokens.sum() + STAY * ((r - 1) ** 2).mean()) / 2
    assert objective(got) <= objective(np.ones(n)) and all(objective(np.maximum(0, got + e * rng.standard_normal(n))) >= objective(got) for e in (1e-3, 1e-2, 0.1))


def test_rates_fail_rather_than_stop_short(spark, monkeypatch):
    monkeypatch.setattr("textlens.llm.mixing.ROUNDS", 1)
    members = spark.createDataFrame([(i, 10 + 1000 * (i == 0), [0.9, 0.1] if i % 3 else [0.2, 0.8]) for i in range(50)], "doc_id long, tokens long, posterior array<double>")
    with pytest.raises(RuntimeError, match="rounds leave"):
        rates(members, 2, np.array([1.0, 0.0]) * 1500)


def test_mixture(spark, docs, no_docs):
    labels = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(15)] + [(None, "a"), (3, None), (99, "b")], "doc_id long, kind string")
    found = mixture(spark, docs, labels, F.col("kind"), {"a": 1.0}).collect()
    assert len(found) == docs.count() and all(r["rate"] >= 0 and 0 <= r["probability"] <= 1 and r["domain"] in "ab" for r in found)
    nothing = mixture(spark, docs, labels.limit(0), F.col("kind"), {"a": 1.0}).collect()
    assert {(r["domain"], r["rate"]) for r in nothing} == {("", 1.0)}
    assert mixture(spark, no_docs, labels, F.col("kind"), {"a": 1.0}).count() == 0


def test_classifier_learns(spark):
    from textlens.llm.mixing import features, posteriors, weighted

    texts = [(f"alpha beta {i} gamma", "x") for i in range(40)] + [(f"delta beta {i} epsilon", "y") for i in range(40)]
    of, slot, value, _ = features([t.encode() for t, _ in texts])
    samples = [(d, slot[of == i], value[of == i]) for i, (_, d) in enumerate(texts)]
    model = fit(samples)
    p = posteriors(model, of, slot, weighted(of, slot, value, model.emphasis, len(texts)), len(texts))
    assert [model.domains[k] for k in p.argmax(1)] == [d for _, d in texts]
    assert memberships(spark, spark.createDataFrame([(1, None), (1, "alpha")], "doc_id long, text string"), model).count() == 2


# ---------------------------------------------------------------- the pipeline and the queries


def test_pipeline_stages(spark):
    """Each stage on what the one before kept, the filters against brute force."""
    import os

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test data")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept[-1], sf).cache()
        assert out.columns == columns or name == corpus_pipeline.STAGES[-1][0]
        kept.append(out)
    language, one, clean, masked, mixed = kept[1:]
    # all of these documents are prose in a known language
    assert language.count() == docs.count()
    rows = [(r["doc_id"], r["text"]) for r in language.collect()]
    assert sorted(r["doc_id"] for r in one.collect()) == sorted({c for c in named(jaccard_groups([t for _, t in rows]), [i for i, _ in rows])})
    windows = {tuple(w[j : j + 10]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() for w in [plain_words(r["text"])] for j in range(max(1, len(w) - 9) if w else 0)}
    sizes = {len(w) for w in windows}

    def dirty(text):
        w = plain_words(text)
        return any(tuple(w[p : p + n]) in windows for n in sizes for p in range(len(w) - n + 1))

    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(r["doc_id"] for r in one.collect() if not dirty(r["text"]))
    before, after = (dict((r["doc_id"], r["text"]) for r in df.collect()) for df in (clean, masked))
    assert before.keys() == after.keys() and any(before[i] != after[i] for i in before)
    assert all("[" in after[i] for i in before if before[i] != after[i])
    assert mixed.count() == masked.count() and mixed.where("rate < 0").count() == 0


def test_every_operator_has_a_query():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {n for n in names if n.startswith("op") and n[2].isdigit()} == set(Q.QUERIES)
    assert {int(n[2:].split("_")[0]) for n in Q.QUERIES} == set(range(1, 14)) and "pipeline" in names
