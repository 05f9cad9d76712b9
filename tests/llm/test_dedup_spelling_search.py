"""Exact duplicates, spelling variants and ranked search, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from brute import lowered, sentence, tuples

from textlens.llm import exact_dedup, lexical_search, spelling
from textlens.llm import queries as Q

SF001 = "/root/testdata/sf0.001"

# ---------------------------------------------------------------- exact duplicates


def brute_duplicates(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lowered(t)].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        left = 1
        for i in ids:
            out.append((i, keep, len(ids), i == keep and left > 0, hashlib.sha256(t.encode()).hexdigest()))
            left -= i == keep
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [exact_dedup.MAX_FILTER_BYTES, 4096])
def test_exact_duplicates(spark, docs, limit):
    got = exact_dedup.exact_duplicates(spark, docs, max_filter_bytes=limit)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert tuples(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_duplicates(rows)


def test_exact_duplicates_in_rounds(spark, monkeypatch):
    """Several rounds of small filters, hot groups, repeated rows and few bits a text."""
    monkeypatch.setattr(exact_dedup, "BITS_PER_TEXT", 32)
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", 50)
    monkeypatch.setattr(exact_dedup, "UNROLLED", 3)
    rows = [(i, f"text {i * i % 4001}" if i % 3 else "Same") for i in range(9000)] + [(7, "again")] * 10
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = exact_dedup.exact_duplicates(spark, df, max_filter_bytes=8192)
    assert tuples(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_duplicates(rows)


def test_only_possible_repeats_are_shuffled(spark):
    rows = [(i, f"text {i}") for i in range(20_000)] + [(100_000 + i, f"text {i}") for i in range(500)]
    digested = exact_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    (part,) = exact_dedup.maybe_repeated(digested, len(rows))
    maybe = part.where("maybe").count()
    assert 1000 <= maybe < 1500  # both rows of every repeat, and few others


def test_exact_duplicates_of_nothing(spark, no_docs):
    assert exact_dedup.exact_duplicates(spark, no_docs).count() == 0


# ---------------------------------------------------------------- spelling variants


def brute_variants(rows):
    counts = Counter()
    for i, t in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        k = 0
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        return a[k + (len(a) >= len(b)) :] == b[k + (len(b) >= len(a)) :]

    found = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, vs in found.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(((w, form[w], root(w), n, len(found[w]), words[form[w]] if form[w] else None) for w, n in words.items()), key=repr)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def variants(seed, stems, edits, letters="abÀ"):
    """Texts of words near each other, some of them frequent."""
    draw = random.Random(seed)
    words = []
    for stem in stems:
        words += [stem] * draw.randrange(3, 40)
        for _ in range(edits):
            w = list(draw.choice([w for w in words[-20:] if len(w) > 3] or [stem]))
            at, do = draw.randrange(len(w)), draw.randrange(3)
            w[at : at + (do != 0)] = draw.choice(letters) if do != 2 else ""
            words += ["".join(w)] * draw.randrange(1, 9)
    draw.shuffle(words)
    return [(k, " ".join(words[a : a + 30])) for k, a in enumerate(range(0, len(words), 30))]


def test_spelling_variants(spark, docs):
    rows = variants(1, ["aabbb", "banana", "Große", "aaaaaaa", "abababab", "straße"], 60)
    rows += [(None, "window windows windoow Window"), (None, None), (9, ""), (9, rows[0][1])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(3)
    want = brute_variants(rows)
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] not in (None, r[2]) for r in want)
    assert tuples(spelling.spelling_variants(spark, df), *COLUMNS) == want
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert tuples(spelling.spelling_variants(spark, docs), *COLUMNS) == brute_variants(rows)


def test_spelling_variants_of_long_words(spark):
    """Words around the length from which rotations are hashed."""
    rows = variants(2, ["aabbaab", "bananab", "aaaaaaaa", "bbabbabba", "abab" * 4, "b" * 12], 80)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert tuples(spelling.spelling_variants(spark, df, longest=7), *COLUMNS) == brute_variants(rows)


def test_very_long_words(spark):
    rows = [(i, "x" * 20_000 + " " + "x" * 20_000) for i in range(4)] + [(i, "x" * 9_000 + "y" + "x" * 10_999) for i in range(10, 13)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = spelling.spelling_variants(spark, df).collect()
    assert [(len(r["word"]), r["n"], r["n_near"], r["form_n"]) for r in sorted(got, key=lambda r: r["word"])] == [(20_000, 8, 1, None), (20_000, 3, 1, 8)]


def test_spelling_variants_of_nothing(spark, no_docs):
    assert spelling.spelling_variants(spark, no_docs).count() == 0


# ---------------------------------------------------------------- ranked search


def brute_search(docs, items):
    def terms(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered(t))

    vectors = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(vectors), sum(v.total() for _, v in vectors)
    df = Counter(t for _, v in vectors for t in v)
    out = []
    for item, text in items:
        scored = []
        for i, v in vectors:
            m = 100 - 75 + (75 * v.total() * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * v[t] // (1000 * v[t] + 8 * m)) for t in terms(text) if v[t])
            if score:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:10], 1)]
    return sorted(out, key=repr)


HITS = ("item_id", "rank", "doc_id", "score")


@pytest.mark.parametrize(
    "bounds, setting",
    [({}, {}), ({"BLOCK_ITEMS": 2}, {"leaf": 2, "shard_pairs": 100}), ({"BLOCK_TERMS": 8, "PASS_TERMS": 12}, {"leaf": 1})],
)
def test_lexical_search(spark, docs, monkeypatch, bounds, setting):
    for name, value in bounds.items():
        monkeypatch.setattr(lexical_search, name, value)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(100 + i, sentence(i % 40, 5 + i % 23)) for i in range(120)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, item_id string, score int").repartition(4)
    items = [(1, sentence(3, 12)), (2, "Maple the the"), (2, "maple"), (3, None), (4, ""), (5, "nowhere"), (None, sentence(8, 30)), (6, "é 中文 changed"), (7, sentence(1, 60) + "-word!")]
    asked = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, rank int")
    assert tuples(lexical_search.lexical_search(spark, df, asked, **setting), *HITS) == brute_search(rows, items)


def test_lexical_search_in_integers(spark):
    """An item with so many repeats that doubles would not do."""
    rows = [(i, sentence(i, 20)) for i in range(30)]
    items = [(1, "river " * 400_000 + "stone")]
    got = lexical_search.lexical_search(spark, spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert tuples(got, *HITS) == brute_search(rows, items)


def test_lexical_search_of_nothing(spark, docs, no_docs):
    items = spark.createDataFrame([(1, "river")], "item_id long, text string")
    assert lexical_search.lexical_search(spark, no_docs, items).count() == 0
    assert lexical_search.lexical_search(spark, docs, items.limit(0)).count() == 0


def test_subtrees_are_left_out(monkeypatch):
    """The walk scores far fewer documents than there are once the best are known."""
    import numpy as np

    vectors = [(np.array([t, 10 + t % 7]), np.array([1, 1])) for t in range(10) for _ in range(100)]
    tree = lexical_search.Tree(vectors, list(range(1000)), [100] * 1000)
    weights = np.zeros((20, 1))
    weights[3], weights[13] = 5, 5
    scored = []
    whole = lexical_search._score
    monkeypatch.setattr(lexical_search, "_score", lambda tree, lo, hi, *rest: (scored.append(hi - lo), whole(tree, lo, hi, *rest)))
    best = lexical_search.Best(np.ones(1, np.int64))
    lexical_search.search(tree, weights, best)
    assert len(best.heaps[0]) == 10 and sum(scored) <= 120


# ---------------------------------------------------------------- registered queries


def test_registered_queries(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    assert tuples(Q.QUERIES["op11_exact_dedup"](spark, SF001), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_duplicates(docs)
    assert tuples(Q.QUERIES["op12_spelling_variants"](spark, SF001), *COLUMNS) == brute_variants(docs)
    assert tuples(Q.QUERIES["op13_lexical_search"](spark, SF001), *HITS) == brute_search(docs, items)
