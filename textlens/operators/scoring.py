"""Naive Bayes scoring.

One row per test document carries everything needed to score it against all
K candidate classes:

1. the likelihood is pivoted to one K-vector of counts per word;
2. test tokens are joined to it on ``word`` (sort-merge with AQE skew split,
   or broadcast hash when AQE measures the model side small) and regrouped per
   document in position order, so ``wcnt[j]`` is the count vector of word j;
3. per candidate the score is an *ordered left fold* (``F.aggregate``) over the
   doc's words, so the float result is the same sequence of operations as the
   original per-word loop (same sums, same underflow, same ties);
4. the arg-max is a fold over the K totals: strict ``>`` from the reject
   limit, the first class wins ties, nothing above the limit gives ``''``.

No docs x words x classes rows are materialised, and there is no cross join.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.operators.model import Model, word_frequencies

FLOOR = "floor"  # C1/C2: ln(max(zero_fix, cnt/n))
ADDONE = "addone"  # C4: ln((cnt+1)/n), total = ln prior + all terms
ADDONE_AS_CODED = "addone_as_coded"  # C3: stored terms as C4, total double-counts the prior and skips the last word
PRODUCT = "product"  # C5: prior * prod((cnt+1)/n), no logs
MODES = (FLOOR, ADDONE, ADDONE_AS_CODED, PRODUCT)

# Fixed values of the original scorers.
DEFAULT_REJECT = -1e6  # start of the arg-max in the web app and notebook
FIXED_FLOOR = 1e-8  # batch runner floor
FIXED_FLOOR_REJECT = -1e7  # batch runner start of the arg-max
SMALLEST = -1074  # the smallest positive double is two to this power


def _header_structs(header):
    """The K candidates ``(k, cls, prior, lp, n)`` as literal structs, in class order."""
    return [
        F.struct(
            F.lit(k).alias("k"),
            F.lit(c).alias("cls"),
            F.lit(float(p)).alias("prior"),
            F.lit(math.log(p)).alias("lp"),
            F.lit(float(n)).alias("n"),
        )
        for k, (c, p, n) in enumerate(header)
    ]


def _header_array(header) -> Column:
    """The same candidates as one literal ``ARRAY<STRUCT<..>>``."""
    return F.array(*_header_structs(header))


def class_index(spark, header) -> DataFrame:
    """``(class, k)`` for the K candidates; K rows, broadcast-safe."""
    return spark.createDataFrame([(c, k) for k, (c, _, _) in enumerate(header)], "class string, k int")


def word_vectors(model: Model, header) -> DataFrame:
    """``(word, cnts ARRAY<BIGINT>)``: the likelihood pivoted to one K-vector per word
    (class order of ``header``, 0 where the class never saw the word).

    One partial + final hash aggregate with K conditional sums (code-generated).
    """
    spark = model.likelihood.sparkSession
    lik = model.likelihood.join(F.broadcast(class_index(spark, header)), "class")
    sums = [F.sum(F.when(F.col("k") == i, F.col("cnt")).otherwise(F.lit(0))) for i in range(len(header))]
    return lik.groupBy("word").agg(F.array(*sums).cast("array<bigint>").alias("cnts"))


def with_word_counts(docs: DataFrame, model: Model, header, keep=("class",), with_words: bool = True) -> DataFrame:
    """``(doc_id, ..keep, [words,] wcnt)``: ``wcnt[j]`` is the K-vector of counts of word j.

    Tokens are joined to the per-word vectors on ``word`` (hot words are split
    by AQE's skew join; a small model side is broadcast by AQE at run time)
    and regrouped per document in position order. Count lookups in the score
    folds are then array indexing, O(1) per word and class. Without
    ``with_words`` only positions and vectors travel through the shuffle.
    """
    keep = [c for c in keep if c in docs.columns]
    toks = docs.select("doc_id", *keep, F.posexplode("words").alias("pos", "word"))
    joined = toks.join(word_vectors(model, header), "word", "left")
    fields = ["pos", "word", "cnts"] if with_words else ["pos", "cnts"]
    seq = F.sort_array(F.collect_list(F.struct(*fields)))
    out = joined.groupBy("doc_id", *keep).agg(seq.alias("_seq"))
    cols = [F.col("_seq.cnts").alias("wcnt")]
    if with_words:
        cols.insert(0, F.col("_seq.word").alias("words"))
    return out.select("doc_id", *keep, *cols)


def _cnt(h: Column, c: Column) -> Column:
    """Count of a word in candidate ``h`` from its K-vector ``c`` (NULL vector: unseen word)."""
    return F.coalesce(F.element_at(c, h["k"] + 1), F.lit(0))


def term(mode: str, zero_fix: float):
    """Per-word term for candidate ``h`` as a lambda ``(h, cnt_vector) -> Column``."""
    if mode == FLOOR:
        z = zero_fix if isinstance(zero_fix, Column) else F.lit(float(zero_fix))
        return lambda h, w: F.ln(F.greatest(z, _cnt(h, w) / h["n"]))
    if mode in (ADDONE, ADDONE_AS_CODED):
        return lambda h, w: F.ln((_cnt(h, w) + 1) / h["n"])
    if mode == PRODUCT:
        return lambda h, w: (_cnt(h, w) + 1) / h["n"]
    raise ValueError(f"unknown mode {mode!r}")


def total(mode: str, zero_fix: float):
    """Per-candidate total as a lambda ``h -> Column`` (an ordered fold over the words)."""
    t = term(mode, zero_fix)
    words = F.col("wcnt")
    if mode == PRODUCT:
        return lambda h: F.aggregate(words, h["prior"], lambda acc, w: acc * t(h, w))
    if mode == ADDONE_AS_CODED:
        head = F.slice(words, 1, F.size(words) - 1)
        return lambda h: F.aggregate(head, h["lp"] + h["lp"], lambda acc, w: acc + t(h, w))
    return lambda h: F.aggregate(words, h["lp"], lambda acc, w: acc + t(h, w))


def argmax(scores: Column, classes, reject: float) -> Column:
    """First class with the largest score above ``reject`` (strict ``>``); none -> ``''``."""
    k = len(classes)
    if k == 0:
        return F.lit("")
    start = F.struct(F.lit(float(reject)).alias("s"), F.lit(-1).alias("i"))
    best = F.aggregate(
        F.sequence(F.lit(0), F.lit(k - 1)),
        start,
        lambda acc, i: F.when(
            F.element_at(scores, i + 1) > acc["s"], F.struct(F.element_at(scores, i + 1).alias("s"), i.alias("i"))
        ).otherwise(acc),
        lambda acc: acc["i"],
    )
    names = F.array(*[F.lit(c) for c in classes])
    return F.when(best < 0, F.lit("")).otherwise(F.element_at(names, best + 1))


def score(
    test_docs: DataFrame,
    model: Model,
    mode: str = FLOOR,
    zero_fix: float = FIXED_FLOOR,
    reject: float = DEFAULT_REJECT,
    classes=None,
    header=None,
    keep=("class",),
) -> DataFrame:
    """Score test docs ``(doc_id, class, words, ..)`` against every candidate.

    Returns ``(doc_id, ..keep, scores, pred)``: ``scores ARRAY<DOUBLE>`` has one
    total per candidate in class order. ``classes`` restricts and orders the
    candidates (P9).
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    header = header if header is not None else model.header(classes)
    tot = total(mode, zero_fix)
    # one ordered fold per candidate, unrolled over the K classes
    scored = with_word_counts(test_docs, model, header, keep, with_words=False).withColumn(
        "scores", F.array(*[tot(h) for h in _header_structs(header)])
    )
    return scored.withColumn("pred", argmax(F.col("scores"), [c for c, _, _ in header], reject)).drop("wcnt")


def scores_long(scored: DataFrame, header, keep=("doc_id", "class", "pred")) -> DataFrame:
    """``(.., cand, cand_order, score)``: one row per doc and candidate."""
    names = F.array(*[F.lit(c) for c, _, _ in header])
    return scored.select(*keep, F.posexplode("scores").alias("cand_order", "score")).withColumn(
        "cand", F.element_at(names, F.col("cand_order") + 1)
    )


def score_sparse(
    test_docs: DataFrame,
    model: Model,
    header,
    mode: str = ADDONE,
    zero_fix: float = FIXED_FLOOR,
    reject: float = DEFAULT_REJECT,
) -> DataFrame:
    """C1/C4 in sum form, for many classes or long documents (opt-in).

    ``score = ln prior + m * base + Σ_w tf(w) * (term(w) - base)`` where ``base``
    is the term of an unseen word (``ln zero_fix``, or ``ln(1/n)`` for add-one).
    Term frequencies are counted per (doc, word) in the document's row, joined only
    to the classes that saw the word, and summed per (doc, class) with partial
    aggregation, so no per-token K-vector is moved. Frequent words meet a broadcast
    table of bounded size (``sums.hot_words``), so none is a key of a shuffle and no
    task holds all documents that have it. The sums run in another order than the
    per-word loop (equal to it up to rounding, not bit for bit).
    Returns ``(doc_id, class, scores, pred)``.
    """
    if mode not in (FLOOR, ADDONE):
        raise ValueError("the sum form covers the floored and the add-one scores")
    from textlens.operators.sums import hot_words

    spark = test_docs.sparkSession
    k_n = len(header)
    n_arr = F.array(*[F.lit(float(n)) for _, _, n in header])
    n_k = F.element_at(n_arr, F.col("k") + 1)
    if mode == FLOOR:
        z = float(zero_fix)
        delta = F.ln(F.greatest(F.lit(z), F.col("cnt") / n_k)) - F.lit(math.log(z))
        base = [math.log(z)] * k_n
    else:
        delta = F.ln((F.col("cnt") + 1) / n_k) - F.ln(F.lit(1.0) / n_k)
        base = [math.log(1.0 / float(n)) for _, _, n in header]
    docs = test_docs.select("doc_id", "class", F.size("words").alias("m"))
    tf = word_frequencies(test_docs.select("class", "doc_id", "words")).withColumnRenamed("count", "tf")
    # a row a word: the classes that saw it, with their counts
    lik = model.likelihood.join(F.broadcast(class_index(spark, header)), "class")
    seen = lik.groupBy("word").agg(F.collect_list(F.struct("k", "cnt")).alias("seen"))
    hot = F.broadcast(hot_words(lik.select("word", F.col("cnt").alias("n")), sum(n for _, _, n in header), 2 * k_n))
    frequent = tf.join(F.broadcast(seen.join(hot, "word", "left_semi")), "word")
    rare = tf.join(hot, "word", "left_anti").join(seen.join(hot, "word", "left_anti"), "word")

    def summed(met):
        # K conditional sums in one aggregate: only the classes that have the word send a row
        met = met.select("class", "doc_id", "tf", F.explode("seen").alias("s")).select("class", "doc_id", "tf", "s.k", "s.cnt")
        return met.groupBy("class", "doc_id").agg(*[F.sum(F.when(F.col("k") == k, F.col("tf") * delta)).alias(f"_c{k}") for k in range(k_n)])

    # rare words go to their document as one row each; of the frequent ones a row a document and task
    halves = summed(frequent).unionByName(summed(rare.select("class", "doc_id", "tf", "seen").repartition("class", "doc_id")))
    per_doc = halves.groupBy("class", "doc_id").agg(*[F.sum(f"_c{k}").alias(f"_c{k}") for k in range(k_n)])
    out = docs.join(per_doc, ["class", "doc_id"], "left")
    scores = F.array(
        *[
            F.lit(math.log(p)) + F.col("m") * F.lit(base[k]) + F.coalesce(F.col(f"_c{k}"), F.lit(0.0))
            for k, (_, p, _) in enumerate(header)
        ]
    )
    out = out.select("doc_id", "class", scores.alias("scores"))
    return out.withColumn("pred", argmax(F.col("scores"), [c for c, _, _ in header], reject))
