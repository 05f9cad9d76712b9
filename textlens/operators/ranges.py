"""Many word ranges at once (T11 with E8-E14).

A request names a sample and a range of its words, ``(class, doc_id, start, end)``, ``end`` excluded; any number of
them, over any samples, are answered together. Ranges are clipped to the sample, an empty one has no words.

Tokens are packed into stretches of at most ``STRETCH``, a row each, so no task holds a document and a token travels
through one shuffle. Requests, short rows, meet the stretches that they touch by an equi-join on sample and stretch.
Sums over ranges come from prefix sums: a stretch carries the sums of all terms before it in its sample, as whole numbers
(``sums.parts``), so the sum of a range needs the two stretches at its ends only and is the difference of two
prefixes, exactly, whatever lies between. Views that list words take them out of each stretch that a request touches.

Views that need sums or counts only take the test documents instead of tokens (``range_sums`` with a model,
``range_word_counts``): no token is packed. For sums each sample is cut where requests begin or end, the words of
each piece are added up (``sums.place_sums``), and a request is again the difference of two prefixes, at its two cuts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlens.functions.text import rebuild_text
from textlens.operators import explain as X
from textlens.operators.explain import SAMPLE
from textlens.operators.model import word_frequencies
from textlens.operators.scoring import FIXED_FLOOR, FLOOR
from textlens.operators.sums import candidate_tables, mode_term, parts, place_sums, value
from textlens.session import saved

#: Tokens of a stretch.
STRETCH = 4096
#: What names a request.
REQUEST = (*SAMPLE, "start", "end")


def requested(requests: DataFrame, test_docs: DataFrame) -> DataFrame:
    """``(class, doc_id, start, end, s, e)``: the distinct requests for samples that exist, with their clipped ranges."""
    m = test_docs.select(*[F.col(c).alias(f"_{c}") for c in SAMPLE], F.size("words").alias("_m")).distinct()
    mine = requests.select(*REQUEST).distinct()
    same = [mine[c].eqNullSafe(F.col(f"_{c}")) for c in SAMPLE]
    s = F.greatest(F.col("start"), F.lit(0))
    e = F.greatest(F.least(F.col("end"), F.col("_m")), s)
    return mine.join(m, same).select(*REQUEST, s.cast("int").alias("s"), e.cast("int").alias("e"))


def _stretch(pos) -> Column:
    return F.floor(pos / STRETCH).cast("int")


def _sums(ts, k: int) -> list[Column]:
    """The sums of the parts of an array's K terms."""

    def summed(j, half):
        return F.aggregate(ts, F.lit(0).cast("long"), lambda a, t: a + parts(F.element_at(t["v"], j + 1))[half])

    return [summed(j, half) for j in range(k) for half in range(2)]


def with_prefixes(tokens: DataFrame, k: int) -> DataFrame:
    """``(sample, stretch, ts, before)`` of token rows (``explain.token_terms``): ``ts`` the tokens (pos, word, v) of a
    stretch in order, ``before`` the sums of the parts of the K terms of all tokens before it in its sample."""
    packed = tokens.select(F.struct(*SAMPLE).alias("sample"), _stretch(F.col("pos")).alias("stretch"), F.struct("pos", "word", "v").alias("t"))
    # written, so that the views of one query do not pack the tokens again
    packed = saved(packed.groupBy("sample", "stretch").agg(F.sort_array(F.collect_list("t")).alias("ts")), "stretches")
    # a stretch with fewer tokens is the last of its sample
    full = packed.where(F.size("ts") >= STRETCH).select("sample", "stretch", F.array(*_sums(F.col("ts"), k)).alias("sum"))
    upto = Window.partitionBy("sample").orderBy("stretch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = full.select(
        F.col("sample").alias("_sample"), (F.col("stretch") + 1).alias("_stretch"), F.array(*[F.sum(F.get("sum", F.lit(i))).over(upto) for i in range(2 * k)]).alias("before")
    )
    none = F.array(*[F.lit(0).cast("long")] * (2 * k))
    out = packed.join(first, (F.col("sample") == F.col("_sample")) & (F.col("stretch") == F.col("_stretch")), "left")
    return out.select("sample", "stretch", "ts", F.coalesce("before", none).alias("before"))


def _met(reqs: DataFrame, tokens: DataFrame, stretches: Column, how: str) -> DataFrame:
    """The requests that hold words, each with those of its ``stretches`` (``with_prefixes``)."""
    kind = tokens.schema["sample"].dataType
    sample = F.struct(*[F.col(c).cast(kind[c].dataType).alias(c) for c in SAMPLE])
    some = reqs.where(F.col("s") < F.col("e")).select(*REQUEST, "s", "e", sample.alias("_sample"), F.explode(stretches).alias("_stretch"))
    # structs are equal if their parts are, nulls too
    return some.join(tokens, (F.col("_sample") == F.col("sample")) & (F.col("_stretch") == F.col("stretch")), how)


def _none(k: int) -> Column:
    return F.array(*[F.lit(0).cast("long")] * (2 * k))


def _with_priors(out: DataFrame, header) -> DataFrame:
    """``(..REQUEST, lps, sums)`` of ``(..REQUEST, _d)``, the sums of parts."""
    sums = out.withColumn("sums", F.array(*[value(F.get("_d", F.lit(2 * j)), F.get("_d", F.lit(2 * j + 1))) for j in range(len(header))]))
    return sums.withColumn("lps", F.array(*[F.lit(math.log(p)) for _, p, _ in header])).select(*REQUEST, "lps", "sums")


def _cut_sums(reqs: DataFrame, docs: DataFrame, model, header, mode: str, zero_fix: float) -> DataFrame:
    """``range_sums`` over test documents whose names are theirs alone."""
    k, kind = len(header), docs.schema
    sample = F.struct(*[F.col(c).cast(kind[c].dataType).alias(c) for c in SAMPLE]).alias("sample")
    asked = reqs.where(F.col("s") < F.col("e")).select(*REQUEST, sample, "s", "e")
    cuts = asked.select("sample", F.explode(F.array("s", "e")).alias("cut")).groupBy("sample").agg(F.sort_array(F.collect_set("cut")).alias("cuts"))
    pieces = F.transform(F.sequence(F.lit(1), F.size("cuts") - 1), lambda i: F.struct(F.get("cuts", i - 1).alias("a"), F.get("cuts", i).alias("cut")))
    # structs are equal if their parts are, nulls too
    met = docs.select(F.struct(*SAMPLE).alias("sample"), "words").join(cuts, "sample").select("sample.*", "words", F.explode(pieces).alias("p"))
    met = met.select(*SAMPLE, "p.cut", F.lit(1).alias("mask"), F.slice("words", F.col("p.a") + 1, F.col("p.cut") - F.col("p.a")).alias("words"))
    keys = ["doc_id", "class", "cut"]
    sums = place_sums(met, keys, candidate_tables(model, header, [mode_term(mode, zero_fix)]))
    upto = Window.partitionBy(*SAMPLE).orderBy("cut").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.array(*[F.sum(F.get("t", F.lit(i))).over(upto) for i in range(2 * k)])
    prefixes = sums.select(F.struct(*SAMPLE).alias("sample"), "cut", before.alias("before"))
    # nothing is before a sample's first cut
    ends = F.explode(F.array(F.struct(F.col("s").alias("cut"), F.lit(-1).alias("sign")), F.struct(F.col("e").alias("cut"), F.lit(1).alias("sign"))))
    ends = asked.select(*REQUEST, "sample", ends.alias("end_")).select(*REQUEST, "sample", "end_.cut", "end_.sign").join(prefixes, ["sample", "cut"], "left")
    d = F.array(*[F.coalesce(F.sum(F.col("sign") * F.get("before", F.lit(i))), F.lit(0)).cast("long") for i in range(2 * k)])
    out = ends.groupBy(*REQUEST).agg(d.alias("_d"))
    return _with_priors(out.unionByName(reqs.where(F.col("s") >= F.col("e")).select(*REQUEST, _none(k).alias("_d"))), header)


def range_sums(reqs: DataFrame, tokens: DataFrame, header, model=None, mode: str = FLOOR, zero_fix: float = FIXED_FLOOR) -> DataFrame:
    """``(..REQUEST, lps, sums)``: ln priors, and each candidate's sum of terms over the range, from the prefixes at its
    two ends. With a ``model`` the ``tokens`` are the test documents, else those of ``with_prefixes``."""
    k = len(header)
    if model is not None:
        name = F.struct(*SAMPLE).alias("_name")
        shared = tokens.select(name).groupBy("_name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_name")
        if shared.isEmpty():
            return _cut_sums(reqs, tokens, model, header, mode, zero_fix)

        def split(rows, how):
            return rows.select("*", name).join(shared, "_name", how).drop("_name")

        # samples that share their name are told apart by the places of their tokens only
        own = _cut_sums(split(reqs, "left_anti"), split(tokens, "left_anti"), model, header, mode, zero_fix)
        packed = with_prefixes(X.token_terms(split(tokens, "left_semi"), model, header, mode, zero_fix), k)
        return own.unionByName(range_sums(split(reqs, "left_semi"), packed, header))

    def places(pos):
        """Where the stretch has the tokens at ``pos``: one place, unless samples share their name."""
        return F.filter(F.sequence(F.lit(0), F.size("ts") - 1), lambda i: F.get(F.col("ts"), i)["pos"] == pos)

    def prefixes(pos, own):
        """The sums of the tokens before that at ``pos`` (with its ``own``), if the stretch has it."""
        sums = F.transform(places(pos), lambda i: F.array(*[F.get("before", F.lit(j)) + x for j, x in enumerate(_sums(F.slice("ts", F.lit(1), i + own), k))]))
        return F.when(F.col("ts").isNotNull(), sums)

    s, last = F.col("s"), F.col("e") - 1
    # within one stretch the difference is the sum of what lies between
    between = F.transform(places(s), lambda i: F.transform(places(last), lambda j: F.array(*_sums(F.slice("ts", i + 1, F.greatest(j - i + 1, F.lit(0))), k))))
    within = F.when(F.col("ts").isNotNull(), F.flatten(between))
    near = _met(reqs.where(_stretch(s) == _stretch(last)), tokens, F.array(_stretch(s)), "left")
    near = near.select(*REQUEST, F.explode_outer(within).alias("_d"))
    far = _met(reqs.where(_stretch(s) < _stretch(last)), tokens, F.array(_stretch(s), _stretch(last)), "left")
    far = far.select(*REQUEST, prefixes(s, 0).alias("a"), prefixes(last, 1).alias("z"))
    far = far.groupBy(*REQUEST).agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("a", "z")])
    far = far.select(*REQUEST, F.explode_outer("a").alias("a"), "z").select(*REQUEST, "a", F.explode_outer("z").alias("z"))
    far = far.select(*REQUEST, F.zip_with("z", "a", lambda z, a: z - a).alias("_d"))
    out = near.unionByName(far).withColumn("_d", F.coalesce("_d", _none(k)))
    return _with_priors(out.unionByName(reqs.where(F.col("s") >= F.col("e")).select(*REQUEST, _none(k).alias("_d"))), header)


def range_word_counts(reqs: DataFrame, test_docs: DataFrame, model, header, mode: str = FLOOR, zero_fix: float = FIXED_FLOOR) -> DataFrame:
    """``(..REQUEST, word, count, v)``: the distinct words of every range, counted in the documents' rows, with their terms.
    A word may come once for each sample of a name that several share."""
    kind = test_docs.schema
    sample = F.struct(*[F.col(c).cast(kind[c].dataType).alias(c) for c in SAMPLE]).alias("_sample")
    asked = reqs.where(F.col("s") < F.col("e")).select(*REQUEST, "s", "e", sample)
    # structs are equal if their parts are, nulls too
    met = asked.join(test_docs.select(F.struct(*SAMPLE).alias("_sample"), "words"), "_sample")
    mine = F.slice("words", F.col("s") + 1, F.col("e") - F.col("s"))
    return X._counted(word_frequencies(met.select(*REQUEST, mine.alias("words"))), model, header, mode, zero_fix)


def range_tokens(reqs: DataFrame, tokens: DataFrame) -> DataFrame:
    """``(..REQUEST, pos, i, word, v)``: the tokens of every range; ``i`` counts from its start."""
    met = _met(reqs, tokens, F.sequence(_stretch(F.col("s")), _stretch(F.col("e") - 1)), "inner")
    mine = F.filter("ts", lambda t: (t["pos"] >= F.col("s")) & (t["pos"] < F.col("e")))
    words = met.select(*REQUEST, "s", F.explode(mine).alias("t"))
    return words.select(*REQUEST, "t.pos", (F.col("t.pos") - F.col("s")).alias("i"), "t.word", "t.v")


def range_summaries(sums: DataFrame, k: int) -> DataFrame:
    """E9 of every request: three rows of percentages."""
    return X.summary_of(sums, REQUEST, k)


def range_winners(summaries: DataFrame, header) -> DataFrame:
    """E10 of every request."""
    return X.range_winner(summaries, header, REQUEST)


def range_words(words: DataFrame, k: int) -> DataFrame:
    """E8 of every request: the percentages of its words (``range_tokens``)."""
    return X.coords_of(words, REQUEST, k)


def range_axis_min(coords: DataFrame, summaries: DataFrame, k: int) -> DataFrame:
    """E11 of every request."""
    return X.word_axis_min(coords, summaries, k, REQUEST)


def range_running(words: DataFrame, k: int, chunk: int = 25) -> DataFrame:
    """E12 of every request: running sums with resets, as whole numbers. A window has at most ``chunk + 1`` words."""
    rows = X.with_chunks(words, chunk)
    w = Window.partitionBy(*REQUEST, "chunk_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = [p for j in range(k) for p in parts(F.element_at("v", j + 1))]
    so_far = [F.sum(p).over(w) for p in own]
    rows = rows.withColumns({f"c{j}": value(so_far[2 * j], so_far[2 * j + 1]) for j in range(k)})
    pcts = X.percent_cols([F.col(f"c{j}") for j in range(k)])
    return rows.select(*REQUEST, "pos", "i", "chunk_id", *[p.alias(f"p{j}") for j, p in enumerate(pcts)], "word")


def range_resets(running: DataFrame, header, chunk: int = 25) -> DataFrame:
    """E13 of every request."""
    return X.resets_of(running, REQUEST, header, chunk)


def range_uniqueness(words: DataFrame, header, second: str = "as_coded") -> DataFrame:
    """E14 of every request, from its words (``range_tokens``) or its counted words (``range_word_counts``)."""
    count = F.sum("count") if "count" in words.columns else F.count(F.lit(1))
    # dealt by request once, for the counts and for the ranks
    counted = words.repartition(*REQUEST).groupBy(*REQUEST, "word").agg(F.first("v").alias("v"), count.alias("count"))
    return X.ranked_uniqueness(counted, REQUEST, header, second)


def range_texts(reqs: DataFrame, test_docs: DataFrame) -> DataFrame:
    """T11+T12 of every request: its words, each followed by a space; an empty range is an empty text."""
    docs = test_docs.select(*[F.col(c).alias(f"_{c}") for c in SAMPLE], "words")
    same = [reqs[c].eqNullSafe(F.col(f"_{c}")) for c in SAMPLE]
    return reqs.join(docs, same).select(*REQUEST, rebuild_text(F.slice("words", F.col("s") + 1, F.col("e") - F.col("s"))).alias("text"))
