"""Scores as order-free sums.

A score is a sum of one term for each word, and a double sum depends on the order of its terms. Here a term is
split into two whole numbers, multiples of ``2**-24`` and of ``2**-54``: both steps are exact in doubles, whole
numbers add up exactly, and so partial sums may be merged in any order with the same result. No document
is gathered: every task adds up the words that it has, for each document and candidate.

A sum starts from what the document's words would be worth if the model had never seen them, so only seen words
add something: the difference of their parts from those of an unseen word, in the candidates that have them.
Words meet these in two ways. The most frequent words of the model, at most ``HOT_WORDS`` of them and at
most ``HOT_BYTES`` in all, are broadcast with all their candidates, so a word that stands in every document is
never a key of a shuffle: every task looks up the words of its documents there and adds them up. The rest meet by a
join on the word and go on to their document as one row for each token, with the counts of all candidates packed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlens.operators.model import Model
from textlens.operators.scoring import (
    ADDONE,
    ADDONE_AS_CODED,
    DEFAULT_REJECT,
    FIXED_FLOOR,
    FLOOR,
    MODES,
    PRODUCT,
    SMALLEST,
    argmax,
    score,
)
from textlens.session import saved, small_batches

#: A term is ``high * 2**-HIGH + low * 2**-(HIGH + LOW)``.
HIGH, LOW = 24, 30
#: Bounds of the broadcast table.
HOT_WORDS, HOT_BYTES = 1 << 16, 64 << 20
#: Raw products closer than this (relative), or with a power of two in ``ORDERED``, are multiplied in order.
NEAR, ORDERED = 1e-9, (SMALLEST - 10, -1010)


def parts(x: Column) -> list[Column]:
    """The two whole numbers of a double below 2**29, exact to ``2**-(HIGH + LOW)``."""
    scaled = x * F.lit(2.0**HIGH)
    high = F.floor(scaled)
    return [high, F.floor((scaled - high.cast("double")) * F.lit(2.0**LOW))]


def value(high: Column, low: Column) -> Column:
    """The double of two sums of ``parts``."""
    return (high.cast("double") + low.cast("double") * F.lit(2.0**-LOW)) * F.lit(2.0**-HIGH)


def class_table(spark, header) -> DataFrame:
    """``(class, k, n)`` of the K candidates; K rows."""
    return spark.createDataFrame([(c, k, float(n)) for k, (c, _, n) in enumerate(header)], "class string, k int, n double")


def unseen_parts(n, terms) -> list[Column]:
    """The parts of all terms of an unseen word, for a candidate of ``n`` words."""
    return [p for term in terms for p in parts(term(F.lit(0), n))]


def sum_of_arrays(rows: DataFrame, keys, column: str, size: int) -> DataFrame:
    """``(..keys, column)``: arrays of ``size`` whole numbers, added up place by place."""
    return rows.groupBy(*keys).agg(F.array(*[F.sum(F.get(column, F.lit(i))) for i in range(size)]).alias(column))


def hot_words(counts: DataFrame, n_total: int, size: int) -> DataFrame:
    """``(word)``: the words with a row in ``counts`` (word, n) of more than ``n_total / most`` of the ``n_total``
    occurrences, so fewer than ``most``; saved. ``size`` numbers of each are to be broadcast."""
    most = max(1, min(HOT_WORDS, HOT_BYTES // (8 * max(1, size))))
    return saved(counts.where(F.col("n") > n_total // most).select("word").distinct(), "hot")


def add_up(tokens: DataFrame, keys, table: DataFrame, hot: DataFrame, width: int, cut=None) -> DataFrame:
    """``(..keys, t)``: arrays of ``width`` numbers, the sums over the ``tokens`` (..keys, word) of their words' rows in
    ``table`` (word, i, v0: the number, below 2**47, at place ``i``). At most two rows for each key that has a word there.
    ``cut`` maps a rare word's ``coded`` numbers to those that its token needs, before they are dealt by key."""

    def dense(rows, by):
        one = [F.coalesce(F.sum(F.when(F.col("i") == i, F.col("v0"))), F.lit(0)) for i in range(width)]
        return rows.groupBy(*by).agg(F.array(*one).alias("t"))

    frequent = dense(table.join(F.broadcast(hot), "word", "left_semi"), ["word"])
    by_word = sum_of_arrays(tokens.join(F.broadcast(frequent), "word"), keys, "t", width)
    # a row for each rare word, at most ``width`` numbers: its tokens are dealt by key with these, not with a row for each
    rare = table.join(F.broadcast(hot), "word", "left_anti").select("word", coded(F.col("v0"), F.col("i")).alias("code"))
    rare = rare.repartition("word").groupBy("word").agg(F.collect_list("code").alias("codes"))
    # frequent words stay out of the join on the word, where each would be one hot key
    met = tokens.join(F.broadcast(hot), "word", "left_anti").join(rare, "word")
    codes = F.col("codes") if cut is None else cut(F.col("codes"))
    met = met.select(*keys, codes.alias("codes")).repartition(*keys)
    met = met.select(*keys, F.explode("codes").alias("code")).groupBy(*keys, "code").agg(F.count(F.lit(1)).alias("m"))
    count, place = decoded("code")
    met = met.select(*keys, place.alias("i"), (count * F.col("m")).alias("v0")).groupBy(*keys, "i").agg(F.sum("v0").alias("v0"))
    return by_word.unionByName(dense(met, keys))


def coded(count: Column, place: Column) -> Column:
    """A count (below 2**47) and its place (below 2**16) in one number."""
    return F.shiftleft(count.cast("long"), 16).bitwiseOR(place.cast("long"))


def decoded(code) -> tuple[Column, Column]:
    """(count, place) of ``coded``."""
    code = F.col(code) if isinstance(code, str) else code
    return F.shiftright(code, 16), code.bitwiseAND(F.lit((1 << 16) - 1)).cast("int")


@dataclass
class WordTables:
    """What ``place_sums`` meets the words with. Candidates come in ``blocks`` of equally many, ``ns`` are their numbers of
    words; the frequent words and their gains are broadcast, ``rare`` is ``(word, codes)``."""

    frequent: object
    rare: DataFrame
    ns: list
    blocks: int
    terms: list

    @property
    def each(self) -> int:
        return len(self.ns) // self.blocks

    @property
    def size(self) -> int:
        """Numbers for a block: two parts for each term and candidate."""
        return 2 * len(self.terms) * self.each


def _gains(count: Column, n: Column, terms) -> list[Column]:
    """What a word seen ``count`` times adds to an unseen word's parts, for each term."""
    return [x - y for term in terms for x, y in zip(parts(term(count, n)), parts(term(F.lit(0), n)))]


def word_tables(counts: DataFrame, ns, terms, blocks: int = 1) -> WordTables:
    """The tables of ``counts`` (word, codes: ``coded`` counts of at least 1 and places), any number of rows a word, saved
    as a row for each word. The frequent ones, of bounded size, go through the driver to all tasks."""
    spark, ns, terms = counts.sparkSession, [float(n) for n in ns], list(terms)
    place_n = F.array(*[F.lit(n) for n in ns]) if ns else F.array(F.lit(1.0))
    codes = F.flatten(F.collect_list("codes")).alias("codes")
    words = saved(counts.repartition("word").groupBy("word").agg(codes).withColumn("most", F.shiftright(F.array_max("codes"), 16)), "words")
    most = max(1, min(HOT_WORDS, HOT_BYTES // (16 * len(terms) * max(1, len(ns)))))
    frequent = F.col("most") > int(sum(ns)) // most

    def gains(code):
        count, place = decoded(code)
        return F.array(*_gains(count, F.get(place_n, place), terms))

    hot = words.where(frequent).select("word", "codes", F.flatten(F.transform("codes", gains)).alias("gains")).toArrow()
    each = len(ns) // blocks
    table = np.zeros((hot.num_rows, 2 * len(terms) * len(ns)), np.int64)
    found = [hot.column(c).combine_chunks() for c in ("word", "codes", "gains")]
    row = np.repeat(np.arange(hot.num_rows), pc.list_value_length(found[1]).to_numpy(zero_copy_only=False))
    block, k = np.divmod(found[1].flatten().to_numpy(zero_copy_only=False) & 0xFFFF, max(1, each))
    value_of = found[2].flatten().to_numpy(zero_copy_only=False).reshape(-1, 2 * len(terms))
    for f in range(len(terms)):
        for p in (0, 1):
            np.add.at(table, (row, ((block * len(terms) + f) * each + k) * 2 + p), value_of[:, 2 * f + p])
    shared = spark.sparkContext.broadcast((found[0], table))  # HOT_BYTES at most
    return WordTables(shared, words.where(~frequent).select("word", "codes"), ns, blocks, terms)


def candidate_tables(model: Model, header, terms) -> WordTables:
    """The tables of a model's candidates; a caller who scores again and again makes them once."""
    counts = model.likelihood.join(F.broadcast(class_table(model.likelihood.sparkSession, header)), "class")
    return word_tables(counts.select("word", F.array(coded(F.col("cnt"), F.col("k"))).alias("codes")), [n for _, _, n in header], terms)


#: Numbers that a task adds up at once.
AT_ONCE = 1 << 19


def _meet_frequent(docs: DataFrame, tables: WordTables) -> DataFrame:
    """``docs`` (.., words) as ``(.., n, t, rare)``: the number of words, the sums of the frequent ones' gains, and the words
    that are not frequent."""
    shared, others = tables.frequent, len(docs.columns) - 1
    schema = T.StructType([*docs.drop("words").schema.fields, T.StructField("n", T.LongType()), T.StructField("t", T.ArrayType(T.LongType())), T.StructField("rare", T.ArrayType(T.StringType()))])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = shared.value
        width = table.shape[1]
        step = max(1, AT_ONCE // max(1, width))
        for b in batches:
            lists = b.column(others)
            n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            words = lists.flatten().dictionary_encode()
            place = pc.fill_null(pc.index_in(words.dictionary, value_set=known.cast(words.dictionary.type)), -1).to_numpy(zero_copy_only=False)
            place = place[words.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)
            doc, sums = np.repeat(np.arange(len(n)), n), np.zeros((len(n), width), np.int64)
            hot = np.flatnonzero(place >= 0)
            for a in range(0, len(hot), step):
                at = hot[a : a + step]
                of = doc[at]
                first = np.flatnonzero(np.diff(of, prepend=-1))
                sums[of[first]] += np.add.reduceat(table[place[at]], first, axis=0)
            rest = np.flatnonzero(place < 0)
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc[rest], minlength=len(n)))]).astype(np.int32)
            rare = pa.ListArray.from_arrays(pa.array(ends), words.dictionary.take(words.indices.take(pa.array(rest))))
            t = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * width), pa.array(sums.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*b.columns[:others], pa.array(n), t, rare], names=schema.names)

    small_batches(docs.sparkSession)
    return docs.mapInArrow(meet, schema)


def _numbers(x: np.ndarray) -> list[np.ndarray]:
    """``parts`` of an array of doubles."""
    scaled = x * 2.0**HIGH
    high = np.floor(scaled)
    return [high.astype(np.int64), np.floor((scaled - high) * 2.0**LOW).astype(np.int64)]


def _add_rare(rows: DataFrame, tables: WordTables) -> DataFrame:
    """``rows`` (.., codes), a row for each token, as ``(.., n, t)``: the sums of the gains of neighbouring rows that are equal
    in the other columns."""
    others, terms, ns, each = len(rows.columns) - 1, tables.terms, np.array(tables.ns), tables.each
    width = tables.size * tables.blocks
    schema = T.StructType([*rows.drop("codes").schema.fields, T.StructField("n", T.LongType()), T.StructField("t", T.ArrayType(T.LongType()))])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            new = np.zeros(b.num_rows, bool)
            new[0] = True
            for c in b.columns[:others]:
                key = c.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                new[1:] |= key[1:] != key[:-1]
            lists, first = b.column(others), np.flatnonzero(new)
            run = np.repeat(np.cumsum(new) - 1, pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            codes = lists.flatten().to_numpy(zero_copy_only=False)
            count, place = codes >> 16, codes & 0xFFFF
            block, k = np.divmod(place, max(1, each))
            step = max(1, AT_ONCE // max(1, width))
            at = np.searchsorted(run, np.arange(0, len(first) + step, step))
            gains = [x - y for t in terms for x, y in zip(_numbers(t.numbers(count, ns[place])), _numbers(t.numbers(0 * count, ns[place])))]
            for i, a in enumerate(range(0, len(first), step)):
                here, sums = slice(at[i], at[i + 1]), np.zeros((min(step, len(first) - a), width), np.int64)
                for j, g in enumerate(gains):
                    f, p = divmod(j, 2)
                    np.add.at(sums, (run[here] - a, ((block[here] * len(terms) + f) * each + k[here]) * 2 + p), g[here])
                keys = [c.take(pa.array(first[a : a + step])) for c in b.columns[:others]]
                t = pa.ListArray.from_arrays(pa.array(np.arange(len(sums) + 1, dtype=np.int32) * width), pa.array(sums.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*keys, pa.array(np.zeros(len(sums), np.int64)), t], names=schema.names)

    return rows.mapInArrow(add, schema)


def place_sums(docs: DataFrame, keys, tables: WordTables) -> DataFrame:
    """``(..keys, block, t)``: for each key and block the parts of its words' terms, added up, in the order of terms and
    candidates. ``docs`` are (..keys, mask, words), any number of rows a key; a row counts in the blocks of its ``mask``."""
    blocks, each, size, terms = tables.blocks, tables.each, tables.size, tables.terms
    met = saved(_meet_frequent(docs.select(*keys, "mask", "words"), tables), "met")
    rare = met.select(*keys, "mask", F.explode("rare").alias("word")).join(tables.rare, "word")
    if blocks > 1:
        # only the counts of the row's own blocks go on
        rare = rare.withColumn("codes", F.expr(f"filter(codes, c -> (shiftright(mask, cast((c & 65535) div {each} as int)) & 1) = 1)"))
    # a row for each token, not for each of its candidates
    rare = _add_rare(rare.select(*keys, "mask", "codes").repartition(*keys).sortWithinPartitions(keys[0]), tables)
    there = [F.struct(F.lit(g).alias("block"), F.slice("t", g * size + 1, size).alias("t")) for g in range(blocks)]
    if blocks > 1:
        there = [F.when(F.expr(f"(shiftright(mask, {g}) & 1) = 1"), x) for g, x in enumerate(there)]
    rows = met.select(*keys, "mask", "n", "t").unionByName(rare)
    rows = rows.select(*keys, "n", F.explode(F.array_compact(F.array(*there))).alias("b")).select(*keys, "n", "b.*")
    sums = rows.groupBy(*keys, "block").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("t", F.lit(i))) for i in range(size)]).cast("array<bigint>").alias("t"))
    unseen = []
    for f in range(len(terms)):
        for k in range(each):
            of = [unseen_parts(F.lit(tables.ns[g * each + k]), [terms[f]]) for g in range(blocks)]
            unseen += [of[0][p] if blocks == 1 else F.get(F.array(*[x[p] for x in of]), F.col("block")) for p in (0, 1)]
    return sums.select(*keys, "block", F.array(*[F.get("t", F.lit(i)) + F.col("n") * u for i, u in enumerate(unseen)]).alias("t"))


def term_sums(docs: DataFrame, model: Model, header, terms, keep=("class",), words: Column | None = None, tables=None) -> DataFrame:
    """``(doc_id, ..keep, s0, s1, ..)``: for each document the sums of its words' ``terms``, two columns of
    ``parts`` for each. ``words`` are the words that count, all by default; ``tables`` those of ``candidate_tables``."""
    keys = ["doc_id", *[c for c in keep if c in docs.columns]]
    words = F.col("words") if words is None else words
    tables = tables if tables is not None else candidate_tables(model, header, terms)
    sums = place_sums(docs.select(*keys, F.lit(1).alias("mask"), words.alias("words")), keys, tables)
    return sums.select(*keys, *[F.get("t", F.lit(i)).alias(f"s{i}") for i in range(tables.size)])


@dataclass(frozen=True)
class Term:
    """The term of a word under a mode, as a function of its count and the candidate's number of words."""

    mode: str
    zero_fix: float

    def __call__(self, cnt: Column, n: Column) -> Column:
        if self.mode == FLOOR:
            return F.ln(F.greatest(F.lit(self.zero_fix), cnt / n))
        return (F.log2 if self.mode == PRODUCT else F.ln)((cnt + 1) / n)

    def numbers(self, cnt: np.ndarray, n: np.ndarray) -> np.ndarray:
        if self.mode == FLOOR:
            return np.log(np.maximum(self.zero_fix, cnt / n))
        return np.log((cnt + 1) / n) / (math.log(2) if self.mode == PRODUCT else 1.0)


def mode_term(mode: str, zero_fix: float = FIXED_FLOOR) -> Term:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    return Term(mode, float(zero_fix))


def score_sums(
    test_docs: DataFrame,
    model: Model,
    mode: str = FLOOR,
    zero_fix: float = FIXED_FLOOR,
    reject: float = DEFAULT_REJECT,
    classes=None,
    header=None,
    keep=("class",),
    tables=None,
) -> DataFrame:
    """C8 as ``scoring.score``, from order-free sums: ``(doc_id, ..keep, scores, pred)``.

    Log scores differ from the per-word loop by its rounding only, and are the same in every run. A raw
    product is carried as a power of two, so it underflows where the loop does; see ``_products``.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    header = header if header is not None else model.header(classes)
    terms = [mode_term(mode, zero_fix)]
    if mode == PRODUCT:
        return _products(test_docs, model, header, terms, reject, keep, tables)
    all_but_last = F.slice("words", 1, F.greatest(F.size("words") - 1, F.lit(0))) if mode == ADDONE_AS_CODED else None
    sums = term_sums(test_docs, model, header, terms, keep, all_but_last, tables)
    start = [F.lit(math.log(p) * (2 if mode == ADDONE_AS_CODED else 1)) for _, p, _ in header]
    scores = F.array(*[s + value(F.col(f"s{2 * k}"), F.col(f"s{2 * k + 1}")) for k, s in enumerate(start)])
    out = sums.select("doc_id", *[c for c in keep if c in sums.columns], scores.alias("scores"))
    return out.withColumn("pred", argmax(F.col("scores"), [c for c, _, _ in header], reject))


def power(high: Column, low: Column) -> tuple[Column, Column]:
    """(whole, fraction) of the base-two logarithm that two sums of ``parts`` hold, both exact."""
    carried = high + F.shiftright(low, LOW)
    rest = low.bitwiseAND(F.lit((1 << LOW) - 1)).cast("double") * F.lit(2.0**-LOW)
    fraction = (carried.bitwiseAND(F.lit((1 << HIGH) - 1)).cast("double") + rest) * F.lit(2.0**-HIGH)
    return F.shiftright(carried, HIGH), fraction


def double_of(whole: Column, fraction: Column) -> Column:
    """``2**(whole + fraction)`` as a double: rounded once, 0 below the smallest one."""
    e = F.greatest(whole, F.lit(2 * SMALLEST)).cast("double")
    half = F.floor(e / 2).cast("double")
    return F.pow(F.lit(2.0), fraction) * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), e - half)


def unsettled(wholes, products) -> Column:
    """Whether rounding in word order may decide: a product lies where doubles lose bits before they
    vanish, or the two largest are nearly equal (but for zeros). Factors of more than 1/2 aside, such a document
    has at most some 1,080 words, as each takes a power of two."""
    low, high = ORDERED
    edge = F.lit(False)
    for e in wholes:
        edge = edge | e.between(low, high)
    if len(products) < 2:
        return edge
    top = F.sort_array(F.array(*products), asc=False)
    first, second = F.get(top, F.lit(0)), F.get(top, F.lit(1))
    return edge | ((first > 0) & (first - second <= first * NEAR))


def _products(test_docs, model, header, terms, reject, keep, tables) -> DataFrame:
    """Products as sums of base-two logarithms; the few documents where the order of the factors may
    matter (``unsettled``) are multiplied in order by ``scoring.score``."""
    sums = term_sums(test_docs, model, header, terms, keep, tables=tables)
    keep = [c for c in keep if c in sums.columns]
    # the prior's own parts, added as whole numbers
    prior = [parts(F.log2(F.lit(float(p)))) for _, p, _ in header]
    logs = [power(F.col(f"s{2 * k}") + prior[k][0], F.col(f"s{2 * k + 1}") + prior[k][1]) for k in range(len(header))]
    sums = sums.select("doc_id", *keep, *[c.alias(f"{name}{k}") for k, log in enumerate(logs) for name, c in zip("ef", log)])
    names = range(len(header))
    sums = sums.withColumns({f"p{k}": double_of(F.col(f"e{k}"), F.col(f"f{k}")) for k in names})
    open_ = unsettled([F.col(f"e{k}") for k in names], [F.col(f"p{k}") for k in names])
    sums = saved(sums.select("doc_id", *keep, F.array(*[f"p{k}" for k in names]).alias("scores"), open_.alias("open")), "products")
    settled = sums.where("not open").drop("open")
    settled = settled.withColumn("pred", argmax(F.col("scores"), [c for c, _, _ in header], reject))
    if sums.where("open").isEmpty():
        return settled
    # of these documents only: the factors in their order
    again = test_docs.alias("d").join(sums.where("open").select(*[F.col(c).alias(f"_{c}") for c in ("doc_id", *keep)]).alias("s"), _same_sample(keep), "left_semi")
    return settled.unionByName(score(again, model, PRODUCT, reject=reject, header=header, keep=keep).select(*settled.columns))


def _same_sample(keep) -> Column:
    same = F.lit(True)
    for c in ("doc_id", *keep):
        same = same & F.col(f"d.{c}").eqNullSafe(F.col(f"s._{c}"))
    return same


def floor_sweep(test_docs: DataFrame, model: Model, header, exponents, reject: float = DEFAULT_REJECT) -> DataFrame:
    """C1 at several floors ``1 / 10**v`` in one pass (the zero-fix slider, T15): a word has a term for each floor
    and candidate. ``(doc_id, class, v, scores, pred)``."""
    sums = term_sums(test_docs, model, header, [mode_term(FLOOR, 1.0 / 10.0 ** float(v)) for v in exponents])
    k_n = len(header)

    def scores(j):
        at = [2 * (j * k_n + k) for k in range(k_n)]
        return F.array(*[F.lit(math.log(p)) + value(F.col(f"s{i}"), F.col(f"s{i + 1}")) for i, (_, p, _) in zip(at, header)])

    each = F.explode(F.array(*[F.struct(F.lit(float(v)).alias("v"), scores(j).alias("scores")) for j, v in enumerate(exponents)]))
    out = sums.select("doc_id", "class", each.alias("r")).select("doc_id", "class", "r.v", "r.scores")
    return out.withColumn("pred", argmax(F.col("scores"), [c for c, _, _ in header], reject))
