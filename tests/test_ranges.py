"""Many ranges at once against brute force over each range alone."""

import random

import pytest

import pyref
from textlens.operators import explain as X
from textlens.operators import ranges as R
from textlens.operators.model import test_token_lists as held_out, tokenize, train

TRAIN = [("en", "the cat sat on the mat"), ("fr", "le chat et le chien"), ("de", "die katze und der hund"), ("en", "a dog"), ("de", "zwei hunde")]
CHUNK = 7


@pytest.fixture(scope="module")
def data(spark):
    draw = random.Random(8)
    vocabulary = "the cat mat le chat chien et die katze hund new".split()
    texts = [" ".join(draw.choice(vocabulary) for _ in range(n)) for n in (1, 2, 8, 15, 40, 90)]
    rows = [(i, c, t, "train") for i, (c, t) in enumerate(TRAIN)] + [(100 + i, ["en", "fr"][i % 2], t, "test") for i, t in enumerate(texts)]
    rows.append((100, "fr", "chat chat", "test"))  # a name that two classes share
    docs = tokenize(spark.createDataFrame(rows, "doc_id long, class string, text string, split string"))
    model, test = train(docs).persist(), held_out(docs).persist()
    header = model.header(["en", "fr", "de"])
    asked = [(r["class"], r["doc_id"], a, b) for r in test.collect() for a, b in ((0, len(r["words"])), (3, 3), (2, 2 + CHUNK + 1), (1, 12), (5, 2), (-4, 3), (10, 500), (60, 61))]
    asked += [asked[0], ("de", 100, 0, 5), ("en", 999, 0, 5)]  # a repeated request, and samples that do not exist
    reqs = R.requested(spark.createDataFrame(asked, "class string, doc_id long, start int, end int").repartition(3), test)
    pt = {(r["class"], r["doc_id"]): r for r in X.position_terms(test, model, header).collect()}
    return reqs, X.token_terms(test, model, header), test, header, pt


def wanted(data):
    reqs, _, _, _, pt = data
    for r in reqs.select(*R.REQUEST).collect():
        doc = pt[r["class"], r["doc_id"]]
        s = max(r["start"], 0)
        yield tuple(r), doc, s, max(s, min(r["end"], len(doc["words"])))


def test_ranges(spark, data, monkeypatch):
    monkeypatch.setattr(R, "STRETCH", 4)
    reqs, tokens, test, header, _ = data
    tokens = R.with_prefixes(tokens, 3).persist()
    assert reqs.count() == 7 * 8
    summaries = R.range_summaries(R.range_sums(reqs, tokens, header), 3)
    sums = {(tuple(r[c] for c in R.REQUEST), r["kind"]): [r["p0"], r["p1"], r["p2"]] for r in summaries.collect()}
    words = R.range_tokens(reqs, tokens).persist()
    coords = {}
    for r in R.range_words(words, 3).collect():
        coords.setdefault(tuple(r[c] for c in R.REQUEST), {})[r["pos"]] = (r["label"], [r["p0"], r["p1"], r["p2"]])
    running = R.range_running(words, 3, CHUNK)
    runs, resets, texts = {}, {}, {}
    for r in running.orderBy("pos").collect():
        runs.setdefault(tuple(r[c] for c in R.REQUEST), []).append([r["p0"], r["p1"], r["p2"]])
    for r in R.range_resets(running, header, CHUNK).orderBy("pos").collect():
        resets.setdefault(tuple(r[c] for c in R.REQUEST), []).append(r["pos"])
    texts = {tuple(r[c] for c in R.REQUEST): r["text"] for r in R.range_texts(reqs, test).collect()}
    for key, doc, s, e in wanted(data):
        terms = doc["pterms"]
        assert texts[key] == "".join(w + " " for w in doc["words"][s:e])
        assert sums[key, "prior"] == pytest.approx(pyref.pmap(doc["lps"], prior=True))
        total = [sum(t[k] for t in terms[s:e]) for k in range(3)]
        assert sums[key, "no_prior"] == (pytest.approx(pyref.pmap(total)) if s < e else [None] * 3)
        assert sums[key, "with_prior"] == pytest.approx(pyref.pmap([a + b for a, b in zip(total, doc["lps"])]))
        assert coords.get(key, {}) == {p: (f"{p + 1}. {doc['words'][p]}", pytest.approx(pyref.pmap(terms[p]))) for p in range(s, e)}
        percents, ends = pyref.running(terms, s, e, CHUNK)
        assert len(runs.get(key, [])) == len(percents)
        assert all(a == pytest.approx(b) for a, b in zip(runs.get(key, []), percents))
        assert resets.get(key, []) == [p for p, _ in ends]
    unique = {}
    for r in R.range_uniqueness(words, header).collect():
        unique.setdefault(tuple(r[c] for c in R.REQUEST), {})[r["word"]] = (r["winner"], r["diff"], r["count"])
    names = [c for c, _, _ in header]
    for key, doc, s, e in wanted(data):
        want = {}
        for w, t in zip(doc["words"][s:e], doc["pterms"][s:e]):
            top, second, at = pyref.top_second(pyref.pmap(t))
            if top != second:
                want[w] = (names[at] if at >= 0 else None, pytest.approx(top - second), want.get(w, (0, 0, 0))[2] + 1)
        assert unique.get(key, {}) == want
    assert R.range_tokens(reqs.limit(0), tokens).count() == 0


def test_token_rows_give_the_views_of_the_documents(spark, data):
    _, tokens, test, header, _ = data
    model = train(tokenize(spark.createDataFrame([(i, c, t, "train") for i, (c, t) in enumerate(TRAIN)], "doc_id long, class string, text string, split string")))
    pt = X.position_terms(test, model, header)

    def rows(df):
        return sorted(map(tuple, df.select(sorted(df.columns)).collect()))

    assert rows(X.word_trace(tokens, header)) == rows(X.word_trace(pt, header))
    assert rows(X.word_coords(tokens, 3, 2, 9)) == rows(X.word_coords(pt, 3, 2, 9))
    assert rows(X.running_score(tokens, 3, CHUNK, 1, 30)) == rows(X.running_score(pt, 3, CHUNK, 1, 30))
    assert rows(X.word_uniqueness(X.sample_words(test, model, header), header)) == rows(X.word_uniqueness(pt, header))


def test_tokens_are_packed_into_stretches_and_written(spark, data, monkeypatch):
    monkeypatch.setattr(R, "STRETCH", 4)
    _, tokens, test, _, _ = data
    packed = R.with_prefixes(tokens, 3)
    got = {(r["sample"]["class"], r["sample"]["doc_id"], r["stretch"]): [t["word"] for t in r["ts"]] for r in packed.collect()}
    assert got == {(r["class"], r["doc_id"], i // 4): r["words"][i : i + 4] for r in test.collect() for i in range(0, len(r["words"]), 4)}
    # what the views read is a table, not the joins on the words
    assert "collect_list" not in packed._jdf.queryExecution().executedPlan().toString()


def test_documents_give_what_tokens_give(spark, data, monkeypatch):
    """Sums and counted words straight from the documents, samples of one name included; nothing packs or groups tokens."""
    monkeypatch.setattr(R, "STRETCH", 4)
    reqs, _, test, header, _ = data
    model = train(tokenize(spark.createDataFrame([(i, c, t, "train") for i, (c, t) in enumerate(TRAIN)], "doc_id long, class string, text string, split string")))
    more = tokenize(spark.createDataFrame([(105, "fr", "le chat noir et le chien", "test"), (None, "fr", "chat et chien", "test")], "doc_id long, class string, text string, split string"))
    asked = reqs.select(*R.REQUEST).unionByName(spark.createDataFrame([("fr", None, 0, 2), ("fr", None, 1, 1)], "class string, doc_id long, start int, end int"))

    def rows(df):
        return sorted((tuple(tuple(round(x, 9) for x in v) if isinstance(v, list) else v for v in r) for r in df.collect()), key=repr)

    for docs in (test, test.unionByName(more.select(test.columns))):
        mine = R.requested(asked, docs)
        packed = R.with_prefixes(X.token_terms(docs, model, header), 3)
        assert rows(R.range_sums(mine, docs, header, model)) == rows(R.range_sums(mine, packed, header))
        counted = R.range_word_counts(mine, docs, model, header)
        assert "collect_list" not in counted._jdf.queryExecution().executedPlan().toString()
        got, want = R.range_uniqueness(counted, header), R.range_uniqueness(R.range_tokens(mine, packed), header)
        assert rows(got.withColumn("diff", got["diff"] + 0.0).select(want.columns)) == rows(want)
