"""Operators on documents against brute force, on the edge texts."""

import math
import re
from collections import Counter

import pytest
from brute import held_out, jaccard_groups, named, plain_words, sentence, shingles, spaced_words, tuples

from textlens.llm.decontaminate import contamination, decontaminated
from textlens.llm.language_id import identify, train, training_windows
from textlens.llm.licenses import TEMPLATES, licenses
from textlens.llm.lm_score import lm_scores
from textlens.llm.ngram_join import jaccard_components, one_of_each
from textlens.llm.pii import redacted, with_spans
from textlens.llm.token_counts import token_counts


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def tokenizer(name):
    return pytest.importorskip("public_tokenizers").path(name)


# ---------------------------------------------------------------- token counts


def test_token_counts(spark, docs, no_docs):
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    odd = [(100, "a<|endoftext|>b <|endoftext|><|endoftext|>"), (101, "  two  spaces\n\n\tand\x85more x\x1cy it's I'LL 12ab³"), (102, "ᲊ ԯ՘ 𐖈 𞓐 ՘x")]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    expected = []
    for i, t in pairs(df):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected.append((i, len((t or "").encode()), n, n > 1024))
    assert tuples(token_counts(spark, df, path), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(expected, key=repr)
    assert token_counts(spark, no_docs, path).count() == 0


# ---------------------------------------------------------------- decontamination


def benchmark(spark):
    rows = [("7", sentence(3, 12)), ("7", sentence(1, 60)), ("8", sentence(3, 12)), ("9", "Word"), ("10", None), ("11", " . "), (None, sentence(4, 15)), ("12", "two THREE")]
    return spark.createDataFrame(rows, "item_id string, text string")


def brute_hits(text, items, n=10):
    w, covered, found = plain_words(text), set(), set()
    for item, t in items:
        x = plain_words(t)
        for j in range(max(1, len(x) - n + 1) if x else 0):
            win = x[j : j + n]
            for p in range(len(w) - len(win) + 1):
                if w[p : p + len(win)] == win:
                    covered |= set(range(p, p + len(win)))
                    found |= {item} - {None}
    return len(w), len(covered), tuple(sorted(found)), bool(covered)


@pytest.mark.parametrize("block_bytes", [1 << 20, 64])
def test_contamination(spark, docs, no_docs, monkeypatch, block_bytes):
    monkeypatch.setattr("textlens.llm.decontaminate.BLOCK_BYTES", block_bytes)
    bench = benchmark(spark)
    items = [tuple(r) for r in bench.collect()]
    expected = sorted(((i, *brute_hits(t, items)) for i, t in pairs(docs)), key=repr)
    found = contamination(spark, docs, bench)
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in found.collect()), key=repr)
    assert got == expected
    kept = decontaminated(spark, docs, bench)
    assert kept.columns == docs.columns
    assert tuples(kept, "doc_id", "text") == sorted(((i, t) for i, t in pairs(docs) if not brute_hits(t, items)[3]), key=repr)
    assert contamination(spark, no_docs, bench).count() == 0
    assert contamination(spark, docs, bench.limit(0)).where("contaminated").count() == 0


def test_longest_match(spark):
    bench = spark.createDataFrame([("a", sentence(3, 40))], "item_id string, text string")
    text = "before it " + " ".join(sentence(3, 40).split()[5:30]) + " after"
    (row,) = contamination(spark, spark.createDataFrame([(1, text)], "doc_id long, text string"), bench).collect()
    assert (row["longest"], row["n_hit"]) == (25, 25)


# ---------------------------------------------------------------- n-gram Jaccard join


def test_jaccard_components(spark, docs, no_docs):
    rows = pairs(docs)
    groups = jaccard_groups([t for _, t in rows])
    expected = sorted(zip([i for i, _ in rows], [len(shingles(t)) for _, t in rows], named(groups, [i for i, _ in rows])), key=repr)
    assert tuples(jaccard_components(spark, docs), "doc_id", "n_shingles", "component_id") == expected
    assert jaccard_components(spark, no_docs).count() == 0
    kept = one_of_each(spark, docs)
    assert kept.columns == docs.columns
    with_words = [i for i, (_, t) in enumerate(rows) if shingles(t)]
    blank = {r for r in rows if not shingles(r[1])}
    assert kept.count() == len({groups.root(i) for i in with_words}) + len(blank)


def test_jaccard_chains_and_shared_passages(spark):
    """Chains of copies each a little further away, a passage in many documents, sizes at the threshold."""
    texts, common = [], sentence(50, 40)
    for seed in range(4):
        w = sentence(seed, 90).split()
        for step in range(12):
            w = w[:]
            w[(step * 13) % 90] = f"new{seed}x{step}"
            texts.append(" ".join(w))
    texts += [common + " " + sentence(100 + i, 5 + 4 * i) for i in range(30)]
    texts += [" ".join(sentence(7, 100).split()[:n]) for n in range(20, 100, 3)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    expected = named(jaccard_groups(texts), list(range(len(texts))))
    got = dict(tuple(r) for r in jaccard_components(spark, df).select("doc_id", "component_id").collect())
    assert [got[i] for i in range(len(texts))] == expected


# ---------------------------------------------------------------- licences


def brute_license(text):
    w, places, labels = plain_words(text), [], set()
    for phrase, label in {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}.items():
        x = phrase.split()
        at = [i for i in range(len(w)) if w[i : i + len(x)] == x]
        places += at
        labels |= {label} if at else set()
    return len(w), len(places), min(places, default=None), max(places, default=None), tuple(sorted(labels))


def test_licenses(spark, docs, no_docs):
    extra = ["The MIT License; mit-license MIT mit license GNU General\tPublic Licensé", "general public general public license", "K" + " apache license"]
    notices = [f"Foo! {t.upper()}. bar" for _, t, _ in TEMPLATES]
    broken = "permission is hereby granted free of charge to nobody at all"
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate([*extra, *notices, broken])], "doc_id long, text string"))
    found = licenses(spark, df).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], tuple(r["base_labels"])) for r in found), key=repr)
    assert got == sorted(((i, *brute_license(t)) for i, t in pairs(df)), key=repr)
    by_id = {r["doc_id"]: r for r in found}
    for i, (label, _, _) in enumerate(TEMPLATES):
        r = by_id[100 + len(extra) + i]
        assert label in r["labels"] and r["score"] == 1
    assert by_id[100 + len(extra) + len(notices)]["labels"] == []
    assert all(set(r["base_labels"]) <= set(r["labels"]) and 0 <= r["score"] <= 1 for r in found)
    assert licenses(spark, no_docs).count() == 0


# ---------------------------------------------------------------- personal data

FORMATS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def brute_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(FORMATS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p.lstrip("0")[:4] or 0) < 256 for p in re.findall("[0-9]+", m[0])), "card": 14 <= len(digits) <= 19 and luhn(digits or "1"), "phone": 10 <= len(digits) <= 15}
            if good[kind]:
                out.append((m.start(), k, m.end(), kind))
    return [(kind, a, b) for a, _, b, kind in sorted(out)]


ODD = [
    "a@b.com_x@y.com x@y@z.com 1.2.3.4.5.6.7.8 001.002.003.0004 256.1.1.1",
    "x" * 20_000 + "@" + "a.b" * 10_000,
    " 1 2" * 10_000,
    "+1 (555) 555-1234. +1+2 555 555 5555",
    "é\U0001f600 4539578763621486 4111-1111-1111-1111, +4111 1111 1111 1111",
    "9" * 20_000,
    "a@b.c.@d.e 1.2.3 4",
]


def test_personal_data(spark, docs, no_docs):
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(ODD, 100)), "doc_id long, text string"))
    found = [(r["doc_id"], [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["base"]]) for r in with_spans(spark, df).collect()]
    assert sorted(found, key=repr) == sorted(((i, brute_spans(t)) for i, t in pairs(df)), key=repr)
    out = redacted(spark, docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    masked = dict(pairs(redacted(spark, df.where("doc_id >= 100"))))
    assert masked[100] == "[EMAIL][EMAIL] x@[EMAIL] [IP].[IP] [IP] 256.1.1.1"
    # two cards with one space between are one run of 32 digits, and 16 digits are no phone
    assert masked[104] == "é\U0001f600 4539578763621486 4111-1111-1111-1111, +[CARD]"
    assert with_spans(spark, no_docs).count() == 0


def test_contexts_find_unseen_identifiers(spark):
    """A phrase that always stands before phone numbers finds one that the format misses."""
    rows = [(i, f"{sentence(i, 8)} call me at +1 (202) 555-{1000 + i} {sentence(i + 9, 5)}") for i in range(12)]
    rows += [(50, "please call me at 202-555-0147, thanks"), (51, "it was 202-555-0148 of them"), (52, "call me at 7 tonight")]
    found = {r["doc_id"]: r["spans"] for r in with_spans(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s["kind"], s["start"], s["end"], s["base"]) for s in found[50]] == [("phone", 18, 30, False)]
    assert found[51] == [] and found[52] == []


# ---------------------------------------------------------------- language identification


def test_language_id(spark, docs, no_docs):
    de = [f"der Fluß und die Straße wären {sentence(i, 3)} größer für uns" for i in range(40)]
    en = [f"the river and the street would {sentence(i, 3)} be larger for us" for i in range(40)]
    labelled = spark.createDataFrame([(i, t, "de") for i, t in enumerate(de)] + [(100 + i, t, "en") for i, t in enumerate(en)] + [(200, "zzz", None)], "doc_id long, text string, lang string")
    from pyspark.sql import functions as F

    usable = F.col("doc_id") % 4 != 2
    net = train(training_windows(labelled, F.col("lang"), usable), steps=60)
    assert net.langs == ["de", "en"]
    found = {r["doc_id"]: r for r in identify(spark, labelled, net).collect()}
    assert all(found[i]["lang_pred"] == "de" for i in range(2, 40, 4)) and all(found[100 + i]["lang_pred"] == "en" for i in range(2, 40, 4))
    rows = identify(spark, docs, net).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and 0 <= r["share"] <= 1 for r in rows)
    texts = Counter(pairs(docs))
    no_letters = sum(n for (_, t), n in texts.items() if not any(map(str.isalpha, t or "")))
    assert sum(r["lang_pred"] == "und" for r in rows) == no_letters
    assert {r["lang_pred"] for r in identify(spark, docs, None).collect()} == {"und"}
    assert identify(spark, no_docs, net).count() == 0
    kept = identify(spark, docs, net, keep=lambda label, score: label != "und")
    assert kept.columns == docs.columns and kept.count() == docs.count() - no_letters
    assert train(training_windows(no_docs, F.col("lang"), F.lit(True))) is None


def test_gradients_of_the_network():
    """Backpropagation through time against finite differences."""
    import numpy as np

    from textlens.llm import language_id as L

    rng = np.random.default_rng(0)
    X, U = rng.standard_normal((256, 6)), rng.standard_normal((3, 6))
    windows, up = rng.integers(0, 4, (5, 2)), rng.standard_normal((5, 2, 3))

    def loss(X, U):
        return sum((s * u).sum() for s, u in zip(L._forward(X, U, windows)[0], up))

    dX, dU = L._backward(U, windows, L._forward(X, U, windows)[1], up)
    for table, grad, at in ((X, dX, (1, 0)), (X, dX, (2, 4)), (U, dU, (0, 1)), (U, dU, (2, 5))):
        table[at] += 1e-5
        more = loss(X, U)
        table[at] -= 2e-5
        less = loss(X, U)
        table[at] += 1e-5
        assert abs((more - less) / 2e-5 - grad[at]) < 1e-4


# ---------------------------------------------------------------- language-model scores


@pytest.mark.parametrize("frequent_log", [20, 2])
def test_lm_base_scores(spark, docs, no_docs, monkeypatch, frequent_log):
    monkeypatch.setattr("textlens.llm.lm_score.FREQUENT_LOG", frequent_log)
    monkeypatch.setattr("textlens.llm.lm_score.STEPS", 5)
    path = tokenizer("byte_bpe_50k.tiktoken")
    rows = pairs(docs)
    counts = Counter(w for i, t in rows if not held_out(i, 7) for w in [*spaced_words(t), None])
    n, v = sum(counts.values()), len(counts)
    expected = []
    for i, t in rows:
        w = [*spaced_words(t), None]
        expected.append((i, held_out(i, 7), len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6)))
    found = lm_scores(spark, docs, path).collect()
    got = [(*[r[c] for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")], round(r["base_score"], 6)) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in found)
    if frequent_log == 2:
        assert lm_scores(spark, no_docs, path).count() == 0


def test_lm_model_is_a_causal_distribution():
    """Probabilities of all next subwords add up to one; later ids do not change earlier scores; windows
    score every id once, whatever the batch."""
    import numpy as np

    from textlens.llm import lm_score as M

    rng = np.random.default_rng(1)
    counts = np.zeros(M.VOCABULARY, np.int64)
    ids = [list(rng.integers(0, 300, n)) for n in (40, 200, 0, 3, 16, 17, 33)]
    for t in ids:
        counts += np.bincount([*t, M.END], minlength=M.VOCABULARY)
    windows = [tuple([-1, *t, M.END, *[-1] * 40][:33]) for t in ids] * 4
    model = M.train(windows, counts)
    total = 0.0
    for c in range(M.CLASSES):
        total += (10 ** model.share[model.classes == c]).sum()
    assert abs(total - M.CLASSES) < 1e-6
    one_by_one = np.array([M.score(model, [t])[0] for t in ids])
    assert np.allclose(M.score(model, ids), one_by_one)
    prefix = M.score(model, [ids[1][:50]])[0] - M.score(model, [ids[1][:49]])[0]
    assert math.isfinite(prefix)


def test_lm_training_and_pairs_grow_with_the_corpus():
    """Windows by length, none past its text; turns and shards without an upper bound."""
    import numpy as np

    from textlens.llm import lm_score as M

    small, large = M.plan(10**6), M.plan(10**12)
    assert large[0] == M.EVERY and large[1] * large[2] * M.SHARD_WINDOWS >= 10**12 / 4 / M.EVERY > 100 * small[1] * small[2] * M.SHARD_WINDOWS
    counts = [sum(len(M.windows_of(i, [1] * n, 64.0)[0]) for i in range(200)) for n in (20, 2000, 20_000)]
    assert all(abs(c / (200 * (n + 1) / 64) - 1) < 0.25 for c, n in zip(counts, (20, 2000, 20_000)))
    assert (M.windows_of(7, [5, 6], 0.05)[0] == np.array([-1, 5, 6, M.END, *[-1] * 32])[np.arange(33)]).all(1).any()
    keys, sizes = M.pair_keys([[5, 6], [], [7]])
    assert [(int(k) >> 16, int(k) & 0xFFFF) for k in keys] == [(M.VOCABULARY, 5), (5, 6), (6, M.END), (M.VOCABULARY, M.END), (M.VOCABULARY, 7), (7, M.END)]
    assert sizes.tolist() == [3, 1, 2]


def test_lm_pairs(spark, monkeypatch):
    """After an id the ids of a class add up to one; rare pairs by shuffle give what the table gives; and a
    pair that was seen is likelier than the same words the other way round."""
    import numpy as np
    from pyspark.sql import functions as F

    from textlens.llm import lm_score as M

    monkeypatch.setattr(M, "STEPS", 5)
    path = tokenizer("byte_bpe_50k.tiktoken")
    texts = ["red green blue white " * 30, "green red white blue", "red green blue white"] + [f"some words {i} of text {i * i}" for i in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).cache()
    held = F.col("doc_id").isin(1, 2)
    found = {}
    for log in (20, 2):
        monkeypatch.setattr(M, "FREQUENT_LOG", log)
        found[log] = {r["doc_id"]: r["score"] for r in M.lm_scores(spark, df, path, held_out=held).collect()}
    assert found[20].keys() == found[2].keys() and all(abs(found[20][i] - found[2][i]) < 1e-6 for i in found[2])
    assert found[20][2] > found[20][1] + 1
    docs = df.select("doc_id", "text", held.alias("held_out"))
    pairs = M.summed(M.gathered(docs, path, 4, 8.0, 3).where("bucket >= 0"), "pairs")
    n = Counter(int(w) for r in pairs.collect() for x in np.frombuffer(r["records"], M.WORD) for w in [x["word"]] * int(x["n"]))
    assert n == Counter(int(k) for i, t in enumerate(texts) if i not in (1, 2) for k in M.pair_keys([M.subwords(path, t)])[0])
    ids = M.subword_counts(pairs)
    assert ids.sum() == sum(n.values()) and ids[M.END] == len(texts) - 2
    classes, share = M.class_shares(ids)
    unseen = M.unseen_loss(pairs, classes)
    for before in (M.VOCABULARY, M.subwords(path, "red")[0], 40_000):
        keys = (np.uint64(before) << np.uint64(16)) | np.arange(M.VOCABULARY, dtype=np.uint64)
        p = 10 ** (share + M.seen_gain(np.array([n[int(k)] for k in keys]), keys, share) - unseen[before, classes])
        assert np.allclose(np.bincount(classes, p, M.CLASSES), 1, atol=1e-5)


def test_lm_learns_from_every_subword(spark):
    """The windows of a large corpus hold each subword of the training texts, and each text's end, once as a target."""
    import numpy as np
    from pyspark.sql import functions as F

    from textlens.llm import lm_score as M

    every, turns, _ = M.plan(10**12)
    assert every <= M.WINDOW
    path = tokenizer("byte_bpe_50k.tiktoken")
    texts = ["", None, "a few words", *(f"text {i} of more words, " * i for i in range(1, 30))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("held_out", F.col("doc_id") % 5 == 4)
    found = M.gathered(docs.repartition(3), path, 4, every, 6, 3).where("turn >= 0").collect()
    assert {(r["turn"], r["bucket"]) for r in found} <= {(-(b + 1) % 3, b) for b in range(-6, 0)}
    windows = M.restored([r["records"] for r in found])
    assert sum(r["n"] for r in found) == len(windows)
    targets = Counter(windows[:, 1:].reshape(-1).tolist())
    del targets[-1]
    want = Counter(x for i, t in enumerate(texts) if i % 5 != 4 for x in [*M.subwords(path, t), M.END])
    assert targets == want
