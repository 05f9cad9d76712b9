"""Explanation operators (E1-E14, T11-T14) over scored test documents.

Inputs come from ``position_terms``: one row per test doc with

* ``words``  ARRAY<STRING>                 the kept tokens,
* ``lps``    ARRAY<DOUBLE>  [K]            ln prior per candidate,
* ``pterms`` ARRAY<ARRAY<DOUBLE>> [m][K]   per-word term per candidate,
* ``totals`` ARRAY<DOUBLE>  [K]            the stored final score per candidate.

Candidate order is the user's class selection order. The percent maps are
defined for three candidates (``33.33``); for K candidates ``99.99 / K`` is used.
Per-document work stays inside the document's row or in windows partitioned by
document (and chunk), so no step gathers more than one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlens.functions.text import numbered_word, rebuild_text, sample_label, word_slice, word_with_count
from textlens.operators.model import Model
from textlens.operators.scoring import FIXED_FLOOR, FLOOR, _header_structs, term, total, with_word_counts, word_vectors
from textlens.operators.sums import hot_words

# Fixed values of the original percent map and axis.
THIRD = 33.33  # percent share of one of three candidates
AXIS_START = 33  # axis minimum starts here
ARGMAX_START = -1e6  # start of the arg-max over percentages


def _scale(k: int) -> float:
    return THIRD if k == 3 else 99.99 / k


def percent_map(values: Column, k: int, prior: bool = False) -> Column:
    """``avg = Σ/k``; scores -> ``((2·avg − x)·s)/avg``, priors -> ``(x·s)/avg``.

    The sum is a left fold from 0 in candidate order, as in the original;
    ``avg = 0`` gives NULL (``try_divide``) instead of an error.
    """
    s = F.lit(_scale(k))
    avg = F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.lit(float(k))
    if prior:
        return F.transform(values, lambda x: F.try_divide(x * s, avg))
    return F.transform(values, lambda x: F.try_divide(((F.lit(2.0) * avg) - x) * s, avg))


def percent_cols(xs, prior: bool = False):
    """E1/E2 unrolled over K element columns (code-generated, same operation order
    as ``percent_map``: a left sum from 0, then the per-element formula)."""
    k = len(xs)
    s = F.lit(_scale(k))
    acc = F.lit(0.0)
    for x in xs:
        acc = acc + x
    avg = acc / F.lit(float(k))
    if prior:
        return [F.try_divide(x * s, avg) for x in xs]
    return [F.try_divide(((F.lit(2.0) * avg) - x) * s, avg) for x in xs]


def position_terms(
    test_docs: DataFrame, model: Model, header, mode: str = FLOOR, zero_fix: float = FIXED_FLOOR, keep=("class",)
) -> DataFrame:
    """C7 (per position): ``(doc_id, ..keep, words, lps, pterms, totals)``."""
    hs = _header_structs(header)
    t = term(mode, zero_fix)
    tot = total(mode, zero_fix)
    out = with_word_counts(test_docs, model, header, keep)
    return out.select(
        "doc_id",
        *[c for c in keep if c in out.columns],
        "words",
        F.array(*[h["lp"] for h in hs]).alias("lps"),
        F.transform("wcnt", lambda c: F.array(*[t(h, c) for h in hs])).alias("pterms"),
        F.array(*[tot(h) for h in hs]).alias("totals"),
    )


def _full_range(start, end):
    s = F.lit(0) if start is None else (F.lit(start) if isinstance(start, int) else start)
    e = F.size("words") if end is None else (F.lit(end) if isinstance(end, int) else end)
    return s, e


#: What names a sample: class and name. Names may repeat between classes.
SAMPLE = ("class", "doc_id")


def _counted(tokens: DataFrame, model: Model, header, mode: str, zero_fix: float) -> DataFrame:
    """``tokens`` (.., word) with ``v ARRAY<DOUBLE>``, the word's term for each candidate. Frequent words meet a
    broadcast table of bounded size, the others a join on the word."""
    vectors = word_vectors(model, header)
    hot = F.broadcast(hot_words(model.likelihood.select("word", F.col("cnt").alias("n")), sum(n for _, _, n in header), len(header)))
    frequent = tokens.join(F.broadcast(vectors.join(hot, "word", "left_semi")), "word")
    rare = tokens.join(hot, "word", "left_anti").join(vectors.join(hot, "word", "left_anti"), "word", "left")
    t = term(mode, zero_fix)
    v = F.array(*[t(h, F.col("cnts")) for h in _header_structs(header)])
    return frequent.unionByName(rare).withColumn("v", v).drop("cnts")


def token_terms(test_docs: DataFrame, model: Model, header, mode: str = FLOOR, zero_fix: float = FIXED_FLOOR) -> DataFrame:
    """C7 as token rows: ``(class, doc_id, pos, word, v)``, a row for each token. ``word_trace``, ``word_coords``,
    ``running_score`` and ``reset_points`` take it where they take ``position_terms``, and gather no document."""
    return _counted(test_docs.select(*SAMPLE, F.posexplode("words").alias("pos", "word")), model, header, mode, zero_fix)


def sample_words(test_docs: DataFrame, model: Model, header, mode: str = FLOOR, zero_fix: float = FIXED_FLOOR) -> DataFrame:
    """``(class, doc_id, word, count, v)``: each distinct word of a sample with its terms, for ``word_uniqueness``."""
    words = test_docs.select(*SAMPLE, F.explode("words").alias("word")).groupBy(*SAMPLE, "word").agg(F.count(F.lit(1)).alias("count"))
    return _counted(words, model, header, mode, zero_fix)


def _token_rows(pt: DataFrame, start=None, end=None) -> DataFrame:
    """``(class, doc_id, pos, i, word, v)`` of the tokens in ``[start, end)``; ``i`` counts from the start."""
    if "pterms" in pt.columns:
        s, e = _full_range(start, end)
        rows = pt.select(*SAMPLE, "words", F.posexplode("pterms").alias("pos", "v"), s.alias("_s"), e.alias("_e"))
        rows = rows.withColumn("word", F.element_at("words", F.col("pos") + 1))
        rows = rows.where((F.col("pos") >= F.col("_s")) & (F.col("pos") < F.col("_e")))
        return rows.select(*SAMPLE, "pos", (F.col("pos") - F.col("_s")).alias("i"), "word", "v")
    first = 0 if start is None else start
    rows = pt.select(*SAMPLE, "pos", (F.col("pos") - first).alias("i"), "word", "v").where(F.col("i") >= 0)
    return rows if end is None else rows.where(F.col("pos") < end)


def word_trace(pt: DataFrame, header) -> DataFrame:
    """C7 long form: ``(doc_id, class, cand, cand_order, pos, word, term)``."""
    names = F.array(*[F.lit(c) for c, _, _ in header])
    rows = _token_rows(pt).select("doc_id", "class", "pos", "word", F.posexplode("v").alias("cand_order", "term"))
    return rows.withColumn("cand", F.element_at(names, F.col("cand_order") + 1))


def sample_coords(pt: DataFrame, k: int) -> DataFrame:
    """E5 (+T10, T13): per test sample the percent map of its K totals, label and word count."""
    n = F.size("words")
    out = pt.select(
        "doc_id",
        "class",
        n.alias("n_words"),
        sample_label(F.col("doc_id"), n).alias("label"),
        percent_map(F.col("totals"), k).alias("pct"),
    )
    return out.select("doc_id", "class", "n_words", "label", *[F.col("pct")[i].alias(f"p{i}") for i in range(k)])


def sample_axis_min(coords: DataFrame, k: int) -> DataFrame:
    """Per candidate ``min(33, min pct)`` over all samples: ``(cand_order, axis_min)``."""
    mins = coords.agg(*[F.min(f"p{i}").alias(f"m{i}") for i in range(k)])
    return mins.select(
        F.posexplode(F.array(*[F.least(F.lit(float(AXIS_START)), F.col(f"m{i}")) for i in range(k)])).alias(
            "cand_order", "axis_min"
        )
    )


def select_samples(pt: DataFrame, selection: DataFrame) -> DataFrame:
    """The rows of the chosen samples; ``selection`` has ``doc_id`` (a click, or any table of ids) and,
    where names repeat between classes, ``class``."""
    key = [c for c in SAMPLE if c in selection.columns]
    return pt.join(selection.select(*key).distinct(), key, "left_semi")


def word_coords(pt: DataFrame, k: int, start=None, end=None) -> DataFrame:
    """E8 (+T13): per word in ``[start, end)``: ``(class, doc_id, pos, label, p0..)``; label ``"<pos+1>. word"``."""
    return coords_of(_token_rows(pt, start, end), SAMPLE, k)


def coords_of(rows: DataFrame, by, k: int) -> DataFrame:
    """``(..by, pos, label, p0..)`` of token rows."""
    pcts = percent_cols([F.element_at("v", i + 1) for i in range(k)])
    return rows.select(*by, "pos", numbered_word(F.col("pos") + 1, F.col("word")).alias("label"), *[p.alias(f"p{i}") for i, p in enumerate(pcts)])


def _range_sums(k: int, s: Column, e: Column) -> Column:
    """Σ of the per-word terms over ``[s, e)`` per candidate, each a left fold from 0."""
    seg = F.slice(F.col("pterms"), s + 1, F.greatest(e - s, F.lit(0)))
    return F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.aggregate(seg, F.lit(0.0), lambda a, v: a + F.element_at(v, i + 1))
    )


def range_summary(pt: DataFrame, k: int, start=None, end=None) -> DataFrame:
    """Three rows per doc: ``prior`` (E2 of ln priors), ``no_prior`` (E1 of the
    range sums) and ``with_prior`` (E1 of range sums + ln prior)."""
    s, e = _full_range(start, end)
    sums = _range_sums(k, s, e)
    return summary_of(pt.select(*SAMPLE, "lps", sums.alias("sums")), SAMPLE, k)


def summary_of(w: DataFrame, by, k: int) -> DataFrame:
    """E9 from ``(..by, lps, sums)``: ln priors and range sums of the K candidates."""
    with_p = F.zip_with("sums", "lps", lambda a, b: a + b)
    kinds = F.array(
        F.struct(F.lit("prior").alias("kind"), percent_map(F.col("lps"), k, prior=True).alias("pct")),
        F.struct(F.lit("no_prior").alias("kind"), percent_map(F.col("sums"), k).alias("pct")),
        F.struct(F.lit("with_prior").alias("kind"), percent_map(with_p, k).alias("pct")),
    )
    out = w.select(*by, F.explode(kinds).alias("r")).select(*by, "r.kind", "r.pct")
    return out.select(*by, "kind", *[F.col("pct")[i].alias(f"p{i}") for i in range(k)])


def _first_max(values: Column, k: int, start: float) -> Column:
    """Index of the first largest value above ``start`` (strict ``>``), else -1."""
    init = F.struct(F.lit(float(start)).alias("s"), F.lit(-1).alias("i"))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(k - 1)),
        init,
        lambda acc, i: F.when(
            F.element_at(values, i + 1) > acc["s"], F.struct(F.element_at(values, i + 1).alias("s"), i.alias("i"))
        ).otherwise(acc),
    )


def range_winner(summary: DataFrame, header, by=SAMPLE) -> DataFrame:
    """Class with the largest ``with_prior`` percentage (strict ``>`` from -1E6)."""
    k = len(header)
    names = F.array(*[F.lit(c) for c, _, _ in header])
    wp = summary.where(F.col("kind") == "with_prior").select(*by, F.array(*[F.col(f"p{i}") for i in range(k)]).alias("v"))
    best = _first_max(F.col("v"), k, ARGMAX_START)
    return wp.select(
        *by,
        F.when(best["i"] >= 0, F.element_at(names, best["i"] + 1)).alias("winner"),
        best["s"].alias("pct"),
    )


def word_axis_min(coords: DataFrame, summary: DataFrame, k: int, by=SAMPLE) -> DataFrame:
    """Per doc and candidate ``min(33, word pcts, prior, no_prior, with_prior)``."""
    a = coords.groupBy(*by).agg(*[F.min(f"p{i}").alias(f"w{i}") for i in range(k)])
    b = summary.groupBy(*by).agg(*[F.min(f"p{i}").alias(f"s{i}") for i in range(k)])
    j = b.join(a, list(by), "left")
    vals = [
        F.least(F.lit(float(AXIS_START)), F.coalesce(F.col(f"w{i}"), F.lit(float(AXIS_START))), F.col(f"s{i}"))
        for i in range(k)
    ]
    return j.select(*by, F.posexplode(F.array(*vals)).alias("cand_order", "axis_min"))


def sample_text(pt: DataFrame, start=None, end=None) -> DataFrame:
    """T11+T12: the words of ``[start, end)`` each followed by one space."""
    s, e = _full_range(start, end)
    return pt.select(*SAMPLE, rebuild_text(word_slice(F.col("words"), s, e)).alias("text"))


def running_score(pt: DataFrame, k: int, chunk: int = 25, start=None, end=None) -> DataFrame:
    """Cumulative term sums from the range start with resets, mapped by E1.

    With ``i`` the index inside the range, the sums restart after every word
    with ``i != 0 and i % chunk == 0`` (so the first chunk has ``chunk + 1``
    words). Running sums are a window partitioned by ``(doc, chunk_id)``,
    ordered by position: each group holds at most ``chunk + 1`` words.
    Output ``(class, doc_id, pos, i, chunk_id, p0.., word)``.
    """
    rows = with_chunks(_token_rows(pt, start, end), chunk)
    w = Window.partitionBy(*SAMPLE, "chunk_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for j in range(k):
        rows = rows.withColumn(f"c{j}", F.sum(F.element_at("v", j + 1)).over(w))
    pcts = percent_cols([F.col(f"c{j}") for j in range(k)])
    return rows.select(*SAMPLE, "pos", "i", "chunk_id", *[p.alias(f"p{j}") for j, p in enumerate(pcts)], "word")


def with_chunks(rows: DataFrame, chunk: int) -> DataFrame:
    """Token rows with the stretch between two resets that they lie in."""
    return rows.withColumn("chunk_id", F.greatest(F.lit(0), F.ceil(F.col("i") / F.lit(int(chunk))) - 1).cast("int"))


def reset_points(running: DataFrame, pt: DataFrame | None, header, chunk: int = 25) -> DataFrame:
    """At each reset word: label ``"<pos+1>. word"``, best % and its class
    (strict ``>`` from 0, first wins; no positive value -> NULL class)."""
    if "word" not in running.columns:
        running = running.join(pt.select(*SAMPLE, "words"), list(SAMPLE)).withColumn("word", F.element_at("words", F.col("pos") + 1))
    return resets_of(running, SAMPLE, header, chunk)


def resets_of(running: DataFrame, by, header, chunk: int) -> DataFrame:
    """E13 from running scores ``(..by, pos, i, word, p0..)``."""
    k = len(header)
    names = F.array(*[F.lit(c) for c, _, _ in header])
    pts = running.where((F.col("i") != 0) & (F.col("i") % F.lit(int(chunk)) == 0))
    best = _first_max(F.array(*[F.col(f"p{j}") for j in range(k)]), k, 0.0)
    return pts.select(
        *by,
        "pos",
        numbered_word(F.col("pos") + 1, F.col("word")).alias("label"),
        best["s"].alias("best_pct"),
        F.when(best["i"] >= 0, F.element_at(names, best["i"] + 1)).alias("best_class"),
    )


def top_and_second(p: Column, k: int) -> tuple[Column, Column, Column]:
    """``(top, second, place)`` of an array of K values, as the word-uniqueness view defines them.

    The top is the largest value if it is positive, at its first place (from 1); else 0, without a place (0), and the
    second is the largest value. Else the second is the largest other value, with one fixed rule: if nothing
    before the top is positive, only the values after it count, and without any the second is 0.
    """
    best = F.array_max(p)
    place = F.array_position(p, best).cast("int")
    before, after = F.slice(p, 1, F.greatest(place - 1, F.lit(0))), F.slice(p, place + 1, k)
    others = F.when(F.coalesce(F.array_max(before), F.lit(0.0)) > 0, F.concat(before, after)).otherwise(after)
    second = F.coalesce(F.array_max(others), F.lit(0.0))
    return F.greatest(best, F.lit(0.0)), F.when(best > 0, second).otherwise(best), F.when(best > 0, place).otherwise(0)


def word_uniqueness(pt: DataFrame, header, start=None, end=None, second: str = "as_coded") -> DataFrame:
    """Per distinct word of the range: winning class and ``top − second`` %,
    occurrences; words with difference 0 are dropped. ``rank`` orders each
    class's list by (diff, word, count) descending.

    ``pt`` may also be the table of ``sample_words`` (the whole range). ``second``: see ``ranked_uniqueness``.
    """
    if "count" in pt.columns:
        words = pt
    else:
        # the same word always has the same terms
        words = _token_rows(pt, start, end).groupBy(*SAMPLE, "word").agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("count"))
    return ranked_uniqueness(words, SAMPLE, header, second)


def ranked_uniqueness(words: DataFrame, by, header, second: str = "as_coded") -> DataFrame:
    """E14 from ``(..by, word, v, count)``: words with their winner, difference, rank and label. ``second="as_coded"``
    follows ``top_and_second``, ``"true"`` takes the second-largest value."""
    if second not in ("as_coded", "true"):
        raise ValueError(f"unknown second mode {second!r}")
    k = len(header)
    names = F.array(*[F.lit(c) for c, _, _ in header])
    top, sec, place = top_and_second(F.col("p"), k)
    if second == "true":
        sec = F.element_at(F.sort_array("p", asc=False), 2) if k > 1 else F.lit(0.0)
    g = words.select(*by, "word", "count", percent_map(F.col("v"), k).alias("p"))
    g = g.select(*by, F.when(place > 0, F.get(names, place - 1)).alias("winner"), "word", (top - sec).alias("diff"), "count")
    g = g.where(F.col("diff") != 0)
    w = Window.partitionBy(*by, "winner").orderBy(F.desc("diff"), F.desc("word"), F.desc("count"))
    return g.withColumn("rank", F.row_number().over(w)).withColumn("label", word_with_count(F.col("word"), F.col("count")))


def top_words(model: Model, chosen, preferred=None, n: int = 150, stopwords=True, prob: bool = False) -> DataFrame:
    """E3/E4 (+P10, J4, J5): the preferred class's most frequent non-stop words.

    ``(rank, word, v_pref, v_other1, v_other2)`` with counts, or with
    ``prob=True`` counts divided by each class's word total (stop words
    included in the total). Ties in count are broken by word.
    """
    from textlens.operators.model import drop_stopwords
    from textlens.operators.sampling import preferred_fallback

    pref, others = preferred_fallback(chosen, preferred)
    # one pass over the three classes: a word's counts come together
    names = {"v_pref": pref} | {f"v_other{j}": c for j, c in enumerate(others, start=1)}
    lik = model.likelihood.where(F.col("class").isin(list(names.values())))
    counts = lik.groupBy("word").agg(*[F.sum(F.when(F.col("class") == c, F.col("cnt"))).alias(v) for v, c in names.items()])
    counts = drop_stopwords(counts.where(F.col("v_pref").isNotNull()), stopwords)
    top = counts.orderBy(F.desc("v_pref"), F.asc("word")).limit(int(n))
    rank = F.row_number().over(Window.orderBy(F.desc("v_pref"), F.asc("word")))  # at most n rows
    out = top.select(rank.alias("rank"), "word", *[F.coalesce(v, F.lit(0)).cast("long").alias(v) for v in names])
    if prob:
        # class word totals (stop words included) for the three classes: K rows from the model header
        n = {c: float(nw) for c, _, nw in model.header([pref, *others])}
        out = out.select(
            "rank",
            "word",
            (F.col("v_pref") / F.lit(n[pref])).alias("v_pref"),
            *[(F.col(f"v_other{j}") / F.lit(n[oc])).alias(f"v_other{j}") for j, oc in enumerate(others, start=1)],
        )
    return out
