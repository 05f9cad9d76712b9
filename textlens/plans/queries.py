"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

``ORACLE[name]`` holds the DuckDB SQL of the same result, when it exists.
Every query reads the given tables and runs over them whole.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from textlens.functions.text import accuracy_text
from textlens.operators import evaluate as ev
from textlens.operators.model import explode_tokens, test_token_lists, tokenize, train
from textlens.operators.sampling import class_sizes, quotas, split_by_ratio
from textlens.operators.scoring import (
    ADDONE,
    ADDONE_AS_CODED,
    DEFAULT_REJECT,
    FIXED_FLOOR,
    FIXED_FLOOR_REJECT,
    FLOOR,
    PRODUCT,
)
from textlens.plans import params as P
from textlens.plans import sql_oracle as S
from textlens.plans.classify import classify, prepare
from textlens.sources.corpus import documents_corpus, quality_corpus

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def r6(c):
    return F.round(c, P.DIGITS)


def corpus(spark, sf, key):
    if key == "quality":
        return quality_corpus(spark, sf)
    return documents_corpus(spark, sf, key)


FLOOR_Z = 1.0 / (10**P.FLOOR_V)

# ---------------------------------------------------------------- sampling


@register("class_sizes", S.with_(f"corpus AS ({S.CORPUS['lang']})") + "SELECT class, count(*) AS n FROM corpus GROUP BY class")
def q_class_sizes(spark, sf):
    return class_sizes(corpus(spark, sf, "lang"))


@register(
    "quota_balanced",
    S.with_(f"corpus AS ({S.CORPUS['lang']})", "sizes AS (SELECT class, count(*) AS n FROM corpus GROUP BY class)")
    + "SELECT class, n, CAST(min(n) OVER () * 50 // 100 AS BIGINT) AS quota FROM sizes",
)
def q_quota_balanced(spark, sf):
    return quotas(corpus(spark, sf, "lang"), pick_pct=50, balanced=True)


@register(
    "quota_balanced_cap",
    S.with_(f"corpus AS ({S.CORPUS['lang']})", "sizes AS (SELECT class, count(*) AS n FROM corpus GROUP BY class)")
    + "SELECT class, n, CAST(least(15, min(n) OVER ()) * 50 // 100 AS BIGINT) AS quota FROM sizes",
)
def q_quota_balanced_cap(spark, sf):
    """P2 with a cap that binds; callers who want the usual one pass ``cap=10000``."""
    return quotas(corpus(spark, sf, "lang"), pick_pct=50, balanced=True, cap=15)


@register(
    "quota_proportional",
    S.with_(f"corpus AS ({S.CORPUS['lang']})", "sizes AS (SELECT class, count(*) AS n FROM corpus GROUP BY class)")
    + f"SELECT class, n, CAST(n * {P.PICK_PCT} // 100 AS BIGINT) AS quota FROM sizes",
)
def q_quota_proportional(spark, sf):
    return quotas(corpus(spark, sf, "lang"), pick_pct=P.PICK_PCT)


@register(
    "split_ratio",
    S.with_(S.split_ctes("lang", pick=P.PICK_PCT)) + "SELECT doc_id, class, rn, split FROM split",
)
def q_split_ratio(spark, sf):
    return split_by_ratio(corpus(spark, sf, "lang"), P.PICK_PCT, P.RATIO).select("doc_id", "class", "rn", "split")


@register(
    "split_shuffled",
    S.with_(S.split_ctes("lang", pick=P.PICK_PCT, order=S.seeded_order(7, "c") + ", c.doc_id"))
    + "SELECT doc_id, class, rn, split FROM split",
)
def q_split_shuffled(spark, sf):
    """Repeatable shuffle by a seeded hash."""
    return split_by_ratio(corpus(spark, sf, "lang"), P.PICK_PCT, P.RATIO, shuffle_seed=7).select(
        "doc_id", "class", "rn", "split"
    )


# ---------------------------------------------------------------- tokens


@register(
    "tokens",
    S.with_(f"corpus AS ({S.CORPUS['lang']})", f"docs AS (SELECT doc_id, class, {S.words_expr()} AS words FROM corpus)")
    + "SELECT doc_id, class, CAST(pos AS INTEGER) AS pos, word FROM "
    "(SELECT doc_id, class, unnest(range(len(words))) AS pos, unnest(words) AS word FROM docs)",
)
def q_tokens(spark, sf):
    return explode_tokens(tokenize(corpus(spark, sf, "lang")), "doc_id", "class")


@register(
    "tokens_nostop",
    S.with_(
        f"corpus AS ({S.CORPUS['lang']})",
        f"docs AS (SELECT doc_id, class, {S.words_expr(stop=True)} AS words FROM corpus)",
    )
    + "SELECT doc_id, class, CAST(pos AS INTEGER) AS pos, word FROM "
    "(SELECT doc_id, class, unnest(range(len(words))) AS pos, unnest(words) AS word FROM docs)",
)
def q_tokens_nostop(spark, sf):
    return explode_tokens(tokenize(corpus(spark, sf, "lang"), stopwords=True), "doc_id", "class")


@register(
    "test_token_lists",
    S.with_(S.split_ctes("lang"))
    + "SELECT doc_id, class, CAST(len(words) AS INTEGER) AS n_words, array_to_string(words, ' ') AS words "
    "FROM docs WHERE split = 'test' AND len(words) > 0",
)
def q_test_token_lists(spark, sf):
    t = test_token_lists(prepare(corpus(spark, sf, "lang")))
    return t.select("doc_id", "class", F.size("words").alias("n_words"), F.array_join("words", " ").alias("words"))


# ---------------------------------------------------------------- model


def _model(spark, sf, key, stop=False):
    return train(prepare(corpus(spark, sf, key), stopwords=stop))


@register("priors", S.with_(S.split_ctes("lang"), S.model_ctes()) + "SELECT class, n_docs FROM priors")
def q_priors(spark, sf):
    return _model(spark, sf, "lang").priors


@register("likelihood", S.with_(S.split_ctes("source"), S.model_ctes()) + "SELECT class, word, cnt FROM lik")
def q_likelihood(spark, sf):
    return _model(spark, sf, "source").likelihood


@register("class_totals", S.with_(S.split_ctes("source"), S.model_ctes()) + "SELECT class, n_words FROM totals")
def q_class_totals(spark, sf):
    return _model(spark, sf, "source").totals()


@register(
    "class_profile",
    S.with_(S.split_ctes("lang"), S.model_ctes())
    + "SELECT coalesce(p.class, t.class) AS class, p.n_docs, t.n_words, "
    + S.r6("CAST(t.n_words AS DOUBLE) / p.n_docs")
    + " AS avg_words FROM priors p FULL OUTER JOIN totals t ON p.class = t.class",
)
def q_class_profile(spark, sf):
    from textlens.operators.model import class_profile

    return class_profile(_model(spark, sf, "lang")).withColumn("avg_words", r6(F.col("avg_words")))


# ---------------------------------------------------------------- scoring


def _pred_out(run):
    return run.scored.select("doc_id", "class", "pred", r6(F.array_max("scores")).alias("score"))


def _pred_sql(key, mode, z, reject, classes=None):
    return S.nb_predictions(key, mode, z, reject, classes) + f"SELECT doc_id, class, pred, {S.r6('score')} AS score FROM pred"


@register("nb_floor", _pred_sql("source", "floor", FLOOR_Z, DEFAULT_REJECT))
def q_nb_floor(spark, sf):
    return _pred_out(classify(corpus(spark, sf, "source"), FLOOR, FLOOR_Z, DEFAULT_REJECT))


@register("nb_fixed_floor", _pred_sql("source", "floor", FIXED_FLOOR, FIXED_FLOOR_REJECT))
def q_nb_fixed_floor(spark, sf):
    return _pred_out(classify(corpus(spark, sf, "source"), FLOOR, FIXED_FLOOR, FIXED_FLOOR_REJECT))


@register("nb_addone", _pred_sql("source", "addone", None, DEFAULT_REJECT))
def q_nb_addone(spark, sf):
    return _pred_out(classify(corpus(spark, sf, "source"), ADDONE))


@register("nb_addone_as_coded", _pred_sql("source", "addone_as_coded", None, DEFAULT_REJECT))
def q_nb_addone_as_coded(spark, sf):
    return _pred_out(classify(corpus(spark, sf, "source"), ADDONE_AS_CODED))


@register("nb_product", _pred_sql("quality", "product", None, DEFAULT_REJECT))
def q_nb_product(spark, sf):
    return _pred_out(classify(corpus(spark, sf, "quality"), PRODUCT))


@register(
    "nb_scores",
    S.with_(S.split_ctes("source"), S.model_ctes(), S.score_ctes("addone"))
    + f"SELECT doc_id, class, cand, CAST(k AS INTEGER) AS cand_order, {S.r6('score')} AS score FROM scores",
)
def q_nb_scores(spark, sf):
    """C4 totals of every candidate for every test document (long form)."""
    from textlens.operators.scoring import scores_long

    run = classify(corpus(spark, sf, "source"), ADDONE)
    long = scores_long(run.scored, run.header, keep=("doc_id", "class"))
    return long.select("doc_id", "class", "cand", "cand_order", r6(F.col("score")).alias("score"))


# ---------------------------------------------------------------- evaluation


def _fixed_run(spark, sf, reject=FIXED_FLOOR_REJECT, classes=None, key="source"):
    return classify(corpus(spark, sf, key), FLOOR, FIXED_FLOOR, reject, classes=classes)


_FIXED_PRED = S.nb_predictions("source", "floor", FIXED_FLOOR, FIXED_FLOOR_REJECT)


@register("confusion", _FIXED_PRED.rstrip() + ",\n" + S.confusion_ctes() + "\nSELECT * FROM conf")
def q_confusion(spark, sf):
    return _fixed_run(spark, sf).confusion()


@register(
    "accuracy",
    _FIXED_PRED
    + "SELECT CAST(sum(CASE WHEN pred = class THEN 1 ELSE 0 END) AS BIGINT) AS correct, count(*) AS total, "
    + S.r6("sum(CASE WHEN pred = class THEN 1 ELSE 0 END) / count(*)")
    + " AS accuracy FROM pred",
)
def q_accuracy(spark, sf):
    return _fixed_run(spark, sf).accuracy().withColumn("accuracy", r6(F.col("accuracy")))


@register(
    "accuracy_text",
    _FIXED_PRED
    + "SELECT CAST(c AS VARCHAR) || ' correct classifications out of ' || CAST(t AS VARCHAR) || ' samples\n"
    "Accuracy: ' || CAST(round(c / t, 3) AS VARCHAR) AS text FROM "
    "(SELECT sum(CASE WHEN pred = class THEN 1 ELSE 0 END) AS c, count(*) AS t FROM pred)",
)
def q_accuracy_text(spark, sf):
    a = _fixed_run(spark, sf).accuracy()
    return a.select(accuracy_text(F.col("correct"), F.col("total")).alias("text"))


def _report_out(rep):
    return rep.select(
        "class",
        r6(F.col("precision")).alias("precision"),
        r6(F.col("recall")).alias("recall"),
        r6(F.col("average")).alias("average"),
        r6(F.col("f1")).alias("f1"),
        "support",
        "row_order",
    )


_REPORT_SELECT = (
    f"SELECT class, {S.r6('precision')} AS precision, {S.r6('recall')} AS recall, {S.r6('average')} AS average, "
    f"{S.r6('f1')} AS f1, support, row_order FROM rep"
)


def _report_sql(pred_sql):
    return pred_sql.rstrip() + ",\n" + S.confusion_ctes() + ",\n" + S.report_ctes() + "\n" + _REPORT_SELECT


@register("nb_report", _report_sql(_FIXED_PRED))
def q_nb_report(spark, sf):
    return _report_out(_fixed_run(spark, sf).report())


def _round2_sql(x: str) -> str:
    """The exact value's two places, halves to even: a hundred times the value, in units of 2**-80."""
    unit = f"{1 << 80}::HUGEINT"
    times = f"(CAST(floor({x} * pow(2.0, 80)) AS HUGEINT) * 100)"
    rest, half = f"({times} % {unit})", f"{1 << 79}::HUGEINT"
    up = f"({rest} > {half} OR ({rest} = {half} AND ({times} // {unit}) % 2 = 1))"
    return f"CAST({times} // {unit} + CASE WHEN {up} THEN 1 ELSE 0 END AS DOUBLE) / 100.0"


@register(
    "report_rounded",
    _FIXED_PRED.rstrip() + ",\n" + S.confusion_ctes() + ",\n" + S.report_ctes() + "\nSELECT class, "
    + ", ".join(f"{_round2_sql(c)} AS {c}" for c in ("precision", "recall", "average", "f1")) + ", support, row_order FROM rep",
)
def q_report_rounded(spark, sf):
    """M3/M4 as displayed: two places."""
    return ev.rounded_report(_fixed_run(spark, sf).report())


@register(
    "unclassified",
    _report_sql(S.nb_predictions("source", "floor", FIXED_FLOOR, P.UNCLASSIFIED_REJECT)),
)
def q_unclassified(spark, sf):
    return _report_out(_fixed_run(spark, sf, reject=P.UNCLASSIFIED_REJECT).report())


@register(
    "class_restrict",
    _report_sql(S.nb_predictions("lang", "floor", FIXED_FLOOR, DEFAULT_REJECT, classes=P.CHOSEN)),
)
def q_class_restrict(spark, sf):
    return _report_out(_fixed_run(spark, sf, reject=DEFAULT_REJECT, classes=list(P.CHOSEN), key="lang").report())


# ---------------------------------------------------------------- top words

def _top_sql(prob: bool, preferred=P.PREFERRED) -> str:
    from textlens.functions.stopwords import sql_list
    from textlens.operators.sampling import preferred_fallback

    pref, (o1, o2) = preferred_fallback(P.CHOSEN, preferred)
    ctes = [
        S.split_ctes("lang"),
        S.model_ctes(),
        f"pl AS (SELECT word, cnt FROM lik WHERE class = '{pref}' AND NOT list_contains([{sql_list()}], word))",
        f"top AS (SELECT word, cnt, row_number() OVER (ORDER BY cnt DESC, word ASC) AS rank FROM pl "
        f"QUALIFY rank <= {P.TOP_N})",
    ]
    v = [
        "t.cnt",
        "CAST(coalesce(a.cnt, 0) AS BIGINT)",
        "CAST(coalesce(b.cnt, 0) AS BIGINT)",
    ]
    if prob:
        v = [
            f"{v[0]} / (SELECT n_words FROM totals WHERE class = '{pref}')",
            f"{v[1]} / (SELECT n_words FROM totals WHERE class = '{o1}')",
            f"{v[2]} / (SELECT n_words FROM totals WHERE class = '{o2}')",
        ]
        v = [S.r6(x) for x in v]
    return S.with_(*ctes) + (
        f"SELECT CAST(t.rank AS INTEGER) AS rank, t.word, {v[0]} AS v_pref, {v[1]} AS v_other1, {v[2]} AS v_other2 FROM top t "
        f"LEFT JOIN lik a ON a.class = '{o1}' AND a.word = t.word LEFT JOIN lik b ON b.class = '{o2}' AND b.word = t.word"
    )


@register("top_words", _top_sql(False))
def q_top_words(spark, sf):
    from textlens.operators.explain import top_words

    return top_words(_model(spark, sf, "lang"), P.CHOSEN, P.PREFERRED, n=P.TOP_N)


@register("top_words_prob", _top_sql(True))
def q_top_words_prob(spark, sf):
    from textlens.operators.explain import top_words

    out = top_words(_model(spark, sf, "lang"), P.CHOSEN, P.PREFERRED, n=P.TOP_N, prob=True)
    return out.select("rank", "word", *[r6(F.col(c)).alias(c) for c in ("v_pref", "v_other1", "v_other2")])


@register("top_words_fallback", _top_sql(False, preferred=None))
def q_top_words_fallback(spark, sf):
    """E3 with no preferred class: P10 falls back to the last chosen class."""
    from textlens.operators.explain import top_words

    return top_words(_model(spark, sf, "lang"), P.CHOSEN, None, n=P.TOP_N)


# ---------------------------------------------------------------- explanation

K3 = len(P.CHOSEN)


def _three(spark, sf):
    return classify(corpus(spark, sf, "lang"), FLOOR, FIXED_FLOOR, DEFAULT_REJECT, classes=list(P.CHOSEN))


def _explain(spark, sf):
    from textlens.operators.explain import position_terms

    run = _three(spark, sf)
    return run, position_terms(run.test, run.model, run.header, FLOOR, FIXED_FLOOR)


def _tokens(spark, sf):
    from textlens.operators.explain import token_terms

    run = _three(spark, sf)
    return run, token_terms(run.test, run.model, run.header, FLOOR, FIXED_FLOOR)


def _pcols(k=K3):
    return [r6(F.col(f"p{i}")).alias(f"p{i}") for i in range(k)]


@register(
    "sample_coords",
    S.explain_sql(
        S.DOC_VEC,
        select="SELECT d.doc_id, d.class, CAST(len(t.words) AS INTEGER) AS n_words, "
        "CAST(d.doc_id AS VARCHAR) || ', words: ' || CAST(len(t.words) AS VARCHAR) AS label, "
        + S.pmap_cols("d.tot")
        + " FROM dv d JOIN test t USING (doc_id)",
    ),
)
def q_sample_coords(spark, sf):
    from textlens.operators.explain import sample_coords

    _, pt = _explain(spark, sf)
    return sample_coords(pt, K3).select("doc_id", "class", "n_words", "label", *_pcols())


@register(
    "sample_axis_min",
    S.explain_sql(
        S.DOC_VEC,
        "sc AS (SELECT " + S.pmap_cols("tot") + " FROM dv)",
        select=" UNION ALL ".join(f"SELECT {i} AS cand_order, least(33, min(p{i})) AS axis_min FROM sc" for i in range(K3)),
    ),
)
def q_sample_axis_min(spark, sf):
    from textlens.operators.explain import sample_axis_min, sample_coords

    _, pt = _explain(spark, sf)
    coords = sample_coords(pt, K3).select("doc_id", *_pcols())
    return sample_axis_min(coords, K3)


@register(
    "sample_label",
    S.explain_sql(
        select="SELECT doc_id, CAST(doc_id AS VARCHAR) || ', words: ' || CAST(len(words) AS VARCHAR) AS label FROM test"
    ),
)
def q_sample_label(spark, sf):
    """The hover label ``"<id>, words: <n>"`` of every test sample."""
    from textlens.functions.text import sample_label

    return _three(spark, sf).test.select("doc_id", sample_label(F.col("doc_id"), F.size("words")).alias("label"))


@register(
    "sample_id",
    S.explain_sql(
        select="SELECT doc_id, regexp_extract(CAST(doc_id AS VARCHAR) || ', words: ' || CAST(len(words) AS VARCHAR), "
        "'(\\d+)', 1) AS sample_id FROM test"
    ),
)
def q_sample_id(spark, sf):
    from textlens.functions.text import sample_id_from_label, sample_label

    label = sample_label(F.col("doc_id"), F.size("words"))
    return _three(spark, sf).test.select("doc_id", sample_id_from_label(label).alias("sample_id"))


@register(
    "sample_select",
    S.explain_sql(
        S.DOC_VEC,
        S.pred_ctes(DEFAULT_REJECT),
        select="SELECT d.doc_id, d.class, p.pred, "
        + ", ".join(f"{S.r6(f'd.tot[{i + 1}]')} AS t{i}" for i in range(K3))
        + f" FROM dv d JOIN pred p USING (doc_id) WHERE d.class = '{P.CHOSEN[-1]}'",
    ),
)
def q_sample_select(spark, sf):
    """The traces of the samples picked on the chart; here every sample of the
    third chosen class (one series of the sample chart)."""
    from textlens.operators.explain import select_samples

    run, pt = _explain(spark, sf)
    picked = run.scored.where(F.col("class") == P.CHOSEN[-1]).select("doc_id", "pred")
    sel = select_samples(pt, picked).join(picked, "doc_id")
    return sel.select("doc_id", "class", "pred", *[r6(F.col("totals")[i]).alias(f"t{i}") for i in range(K3)])


@register(
    "word_trace",
    S.explain_sql(select=f"SELECT doc_id, class, cand, k AS cand_order, CAST(pos AS INTEGER) AS pos, word, {S.r6('term')} AS term FROM terms"),
)
def q_word_trace(spark, sf):
    from textlens.operators.explain import word_trace

    run, tt = _tokens(spark, sf)
    t = word_trace(tt, run.header)
    return t.select("doc_id", "class", "cand", "cand_order", "pos", "word", r6(F.col("term")).alias("term"))


@register(
    "word_coords",
    S.explain_sql(
        S.POS_VEC,
        select="SELECT doc_id, CAST(pos AS INTEGER) AS pos, CAST(pos + 1 AS VARCHAR) || '. ' || word AS label, "
        + S.pmap_cols("v")
        + " FROM pv",
    ),
)
def q_word_coords(spark, sf):
    from textlens.operators.explain import word_coords

    _, tt = _tokens(spark, sf)
    return word_coords(tt, K3).select("doc_id", "pos", "label", *_pcols())


_SUMMARY_CTES = (
    S.DOC_VEC,
    S.RANGE_SUMS,
    "summ AS (\n"
    "  SELECT doc_id, 'prior' AS kind, " + S.pmap_cols("d.lps", prior=True) + " FROM dv d\n"
    "  UNION ALL SELECT doc_id, 'no_prior', " + S.pmap_cols("r.sums") + " FROM rs r\n"
    "  UNION ALL SELECT doc_id, 'with_prior', "
    + S.pmap_cols("list_transform(range(1, 4), lambda i: r.sums[i] + d.lps[i])")
    + " FROM rs r JOIN dv d USING (doc_id))",
)


@register("range_summary", S.explain_sql(*_SUMMARY_CTES, select="SELECT * FROM summ"))
def q_range_summary(spark, sf):
    from textlens.operators.explain import range_summary

    _, pt = _explain(spark, sf)
    return range_summary(pt, K3).select("doc_id", "kind", *_pcols())


_WIN_VAL, _WIN_NAME = S.first_max_case(["p0", "p1", "p2"], list(P.CHOSEN), "-1000000.0")


@register(
    "range_winner",
    S.explain_sql(
        *_SUMMARY_CTES,
        select=f"SELECT doc_id, {_WIN_NAME} AS winner, {_WIN_VAL} AS pct FROM summ WHERE kind = 'with_prior'",
    ),
)
def q_range_winner(spark, sf):
    from textlens.operators.explain import range_summary, range_winner

    run, pt = _explain(spark, sf)
    summ = range_summary(pt, K3).select("class", "doc_id", "kind", *_pcols())
    return range_winner(summ, run.header).drop("class")


@register(
    "word_axis_min",
    S.explain_sql(
        *_SUMMARY_CTES,
        S.POS_VEC,
        "wc AS (SELECT doc_id, " + S.pmap_cols("v") + " FROM pv)",
        "wm AS (SELECT doc_id, " + ", ".join(f"min(p{i}) AS w{i}" for i in range(K3)) + " FROM wc GROUP BY doc_id)",
        "sm AS (SELECT doc_id, " + ", ".join(f"min(p{i}) AS s{i}" for i in range(K3)) + " FROM summ GROUP BY doc_id)",
        select=" UNION ALL ".join(
            f"SELECT sm.doc_id, {i} AS cand_order, least(33, coalesce(wm.w{i}, 33), sm.s{i}) AS axis_min "
            "FROM sm LEFT JOIN wm USING (doc_id)"
            for i in range(K3)
        ),
    ),
)
def q_word_axis_min(spark, sf):
    from textlens.operators.explain import range_summary, word_axis_min, word_coords

    _, pt = _explain(spark, sf)
    coords = word_coords(pt, K3).select("class", "doc_id", *_pcols())
    summ = range_summary(pt, K3).select("class", "doc_id", "kind", *_pcols())
    return word_axis_min(coords, summ, K3).drop("class")


@register(
    "sample_text",
    S.explain_sql(select="SELECT doc_id, CASE WHEN len(words) = 0 THEN '' ELSE array_to_string(words, ' ') || ' ' END AS text FROM test"),
)
def q_sample_text(spark, sf):
    from textlens.operators.explain import sample_text

    return sample_text(_three(spark, sf).test).drop("class")


_RUN_CTES = (
    f"tc AS (SELECT doc_id, k, pos, term, CAST(greatest(0, ceil(pos / {P.CHUNK}) - 1) AS INTEGER) AS chunk_id FROM terms)",
    "ch AS (SELECT doc_id, k, chunk_id, list(term ORDER BY pos) AS ts, list(pos ORDER BY pos) AS ps "
    "FROM tc GROUP BY doc_id, k, chunk_id)",
    "cu AS (SELECT doc_id, k, chunk_id, unnest(ps) AS pos, unnest(list_transform(range(1, len(ts) + 1), "
    "lambda n: list_reduce(list_prepend(0.0::DOUBLE, ts[1:n]), lambda a, x: a + x))) AS c FROM ch)",
    "rv AS (SELECT doc_id, pos, chunk_id, list(c ORDER BY k) AS v FROM cu GROUP BY doc_id, pos, chunk_id)",
    "run AS (SELECT doc_id, CAST(pos AS INTEGER) AS pos, CAST(pos AS INTEGER) AS i, chunk_id, " + S.pmap_cols("v") + " FROM rv)",
)


@register("running_score", S.explain_sql(*_RUN_CTES, select="SELECT * FROM run"))
def q_running_score(spark, sf):
    from textlens.operators.explain import running_score

    _, tt = _tokens(spark, sf)
    return running_score(tt, K3, P.CHUNK).select("doc_id", "pos", "i", "chunk_id", *_pcols())


_RESET_VAL, _RESET_NAME = S.first_max_case(["r.p0", "r.p1", "r.p2"], list(P.CHOSEN), "0")


@register(
    "reset_points",
    S.explain_sql(
        *_RUN_CTES,
        select=f"SELECT r.doc_id, r.pos, CAST(r.pos + 1 AS VARCHAR) || '. ' || t.words[r.pos + 1] AS label, "
        f"{_RESET_VAL} AS best_pct, {_RESET_NAME} AS best_class "
        f"FROM run r JOIN test t USING (doc_id) WHERE r.i <> 0 AND r.i % {P.CHUNK} = 0",
    ),
)
def q_reset_points(spark, sf):
    from textlens.operators.explain import reset_points, running_score

    run, tt = _tokens(spark, sf)
    rs = running_score(tt, K3, P.CHUNK).select("class", "doc_id", "pos", "i", "chunk_id", *_pcols(), "word")
    return reset_points(rs, None, run.header, P.CHUNK).drop("class")


def _uniq_ctes(keys: str, rows: str) -> list[str]:
    """``g``: winner, difference and count of each word, from ``rows`` with the K-vector of terms ``v``."""
    mean = "list_reduce(list_prepend(0.0::DOUBLE, v), lambda a, x: a + x) / 3"
    names = ", ".join(f"'{c}'" for c in P.CHOSEN)
    return [
        # unrounded percentages here: the difference is rounded at the end
        f"wc AS (SELECT {keys}, word, list_transform(v, lambda x: ((2 * ({mean})) - x) * 33.33::DOUBLE / ({mean})) AS p FROM {rows})",
        f"w1 AS (SELECT {keys}, word, p, list_max(p) AS best, list_position(p, list_max(p)) AS place FROM wc)",
        # the values that may come second: all others, or only those after the top if none before it is positive
        f"w2 AS (SELECT {keys}, word, best, place, CASE WHEN coalesce(list_max(p[1:place - 1]), 0) > 0 "
        "THEN list_concat(p[1:place - 1], p[place + 1:]) ELSE p[place + 1:] END AS others FROM w1)",
        f"g AS (SELECT {keys}, word, CASE WHEN best > 0 THEN [{names}][place] END AS winner, "
        "any_value(CASE WHEN best > 0 THEN best - coalesce(list_max(others), 0) ELSE 0 - best END) AS diff, "
        f"count(*) AS count FROM w2 GROUP BY {keys}, word, CASE WHEN best > 0 THEN [{names}][place] END)",
    ]


def _uniq_select(keys: str) -> str:
    return (
        f"SELECT {keys}, winner, word, " + S.r6("diff") + " AS diff, count, "
        f"CAST(row_number() OVER (PARTITION BY {keys}, winner ORDER BY diff DESC, word DESC, count DESC) AS INTEGER) AS rank, "
        "word || '(' || CAST(count AS VARCHAR) || ')' AS label FROM g WHERE diff <> 0"
    )


def _uniq_sql() -> str:
    return S.explain_sql(S.POS_VEC, *_uniq_ctes("doc_id", "pv"), select=_uniq_select("doc_id"))


@register("word_uniqueness", _uniq_sql())
def q_word_uniqueness(spark, sf):
    from textlens.operators.explain import sample_words, word_uniqueness

    run = _three(spark, sf)
    u = word_uniqueness(sample_words(run.test, run.model, run.header), run.header)
    return u.select("doc_id", "winner", "word", r6(F.col("diff")).alias("diff"), "count", "rank", "label")


# ---------------------------------------------------------------- many ranges at once (T11 with E8-E14)

#: Requests for a sample of m words: an empty range, an inner one, an exact multiple of the reset step (the first
#: stretch has a word more), a part chunk at its end, one past the end of the sample.
_REQUESTS = [("3", "3"), ("m div 4", "3 * m div 4"), ("0", f"least(m, {2 * P.CHUNK + 1})"), ("1", f"least(m, {P.CHUNK + 13})"), ("m - 1", "m + 100")]


def _range_sql(*ctes: str, select: str) -> str:
    each = " UNION ".join(
        f"SELECT doc_id, CAST({a} AS INTEGER) AS s0, CAST({b} AS INTEGER) AS e0, m FROM lens" for a, b in ((x.replace("div", "//"), y.replace("div", "//")) for x, y in _REQUESTS)
    )
    return S.explain_sql(
        "lens AS (SELECT doc_id, len(words) AS m FROM test)",
        f"req AS (SELECT doc_id, s0, e0, greatest(s0, 0) AS s, greatest(least(e0, m), s0, 0) AS e FROM ({each}) q)",
        "rt AS (SELECT r.doc_id, r.s0, r.e0, t.pos, t.pos - r.s AS i, t.word, t.k, t.term FROM req r JOIN terms t "
        "ON t.doc_id = r.doc_id AND t.pos >= r.s AND t.pos < r.e)",
        "rv0 AS (SELECT doc_id, s0, e0, pos, i, word, list(term ORDER BY k) AS v FROM rt GROUP BY doc_id, s0, e0, pos, i, word)",
        *ctes,
        select=select,
    )


def _range_requests(spark, sf):
    run, tt = _tokens(spark, sf)
    from textlens.operators.ranges import requested

    m = F.size("words").alias("m")
    ranges = F.explode(F.array(*[F.struct(F.expr(f"cast({a} as int)").alias("start"), F.expr(f"cast({b} as int)").alias("end")) for a, b in _REQUESTS]))
    asked = run.test.select("class", "doc_id", m).select("class", "doc_id", ranges.alias("r")).select("class", "doc_id", "r.*")
    return run, tt, requested(asked, run.test)


def _range_keys():
    return "doc_id", F.col("start").alias("s0"), F.col("end").alias("e0")

_RANGE_SUMMARY = (
    S.DOC_VEC,
    "sums AS (SELECT doc_id, s0, e0, k, sum(term) AS x FROM rt GROUP BY doc_id, s0, e0, k)",
    "rs AS (SELECT r.doc_id, r.s0, r.e0, any_value(d.lps) AS lps, list(coalesce(x, 0) ORDER BY ks.k) AS sums FROM req r "
    "CROSS JOIN (SELECT unnest(range(3)) AS k) ks JOIN dv d USING (doc_id) LEFT JOIN sums USING (doc_id, s0, e0, k) GROUP BY r.doc_id, r.s0, r.e0)",
    "summ AS (SELECT doc_id, s0, e0, 'prior' AS kind, " + S.pmap_cols("lps", prior=True) + " FROM rs\n"
    "  UNION ALL SELECT doc_id, s0, e0, 'no_prior', " + S.pmap_cols("nullif(sums, [0, 0, 0])") + " FROM rs\n"
    "  UNION ALL SELECT doc_id, s0, e0, 'with_prior', " + S.pmap_cols("list_transform(range(1, 4), lambda i: sums[i] + lps[i])") + " FROM rs)",
)


@register("ranges_summary", _range_sql(*_RANGE_SUMMARY, select="SELECT * FROM summ"))
def q_ranges_summary(spark, sf):
    """E9 for all requests, from prefix sums."""
    from textlens.operators import ranges as R

    run, _, reqs = _range_requests(spark, sf)
    sums = R.range_sums(reqs, run.test, run.header, run.model)
    return R.range_summaries(sums, K3).select(*_range_keys(), "kind", *_pcols())


@register(
    "ranges_winner",
    _range_sql(
        *_RANGE_SUMMARY,
        "wm AS (SELECT doc_id, s0, e0, " + ", ".join(f"min(p{i}) AS w{i}" for i in range(K3)) + " FROM (SELECT doc_id, s0, e0, " + S.pmap_cols("v") + " FROM rv0) GROUP BY ALL)",
        "sm AS (SELECT doc_id, s0, e0, " + ", ".join(f"min(p{i}) AS q{i}" for i in range(K3)) + " FROM summ GROUP BY ALL)",
        select=f"SELECT summ.doc_id, summ.s0, summ.e0, {_WIN_NAME} AS winner, {_WIN_VAL} AS pct, "
        + ", ".join(f"least(33, coalesce(wm.w{i}, 33), sm.q{i}) AS a{i}" for i in range(K3))
        + " FROM summ JOIN sm USING (doc_id, s0, e0) LEFT JOIN wm USING (doc_id, s0, e0) WHERE kind = 'with_prior'",
    ),
)
def q_ranges_winner(spark, sf):
    """E10 and E11 for all requests: the class of each range, and the axis minima (columns here)."""
    from textlens.operators import ranges as R

    run, tt, reqs = _range_requests(spark, sf)
    tokens = R.with_prefixes(tt, K3)
    summ = R.range_summaries(R.range_sums(reqs, tokens, run.header), K3).select(*R.REQUEST, "kind", *_pcols())
    coords = R.range_words(R.range_tokens(reqs, tokens), K3).select(*R.REQUEST, *_pcols())
    axis = R.range_axis_min(coords, summ, K3).groupBy(*R.REQUEST).agg(*[F.max(F.when(F.col("cand_order") == i, F.col("axis_min"))).alias(f"a{i}") for i in range(K3)])
    return R.range_winners(summ, run.header).join(axis, list(R.REQUEST)).select(*_range_keys(), "winner", "pct", "a0", "a1", "a2")


@register(
    "ranges_words",
    _range_sql(
        select="SELECT doc_id, s0, e0, CAST(pos AS INTEGER) AS pos, CAST(pos + 1 AS VARCHAR) || '. ' || word AS label, " + S.pmap_cols("v") + " FROM rv0"
    ),
)
def q_ranges_words(spark, sf):
    """E8 for all requests."""
    from textlens.operators import ranges as R

    _, tt, reqs = _range_requests(spark, sf)
    return R.range_words(R.range_tokens(reqs, R.with_prefixes(tt, K3)), K3).select(*_range_keys(), "pos", "label", *_pcols())


_RANGE_RUN = (
    f"tc AS (SELECT doc_id, s0, e0, k, pos, i, word, term, CAST(greatest(0, ceil(i / {P.CHUNK}) - 1) AS INTEGER) AS chunk_id FROM rt)",
    "cu AS (SELECT *, sum(term) OVER (PARTITION BY doc_id, s0, e0, k, chunk_id ORDER BY pos) AS c FROM tc)",
    "rv AS (SELECT doc_id, s0, e0, pos, i, word, chunk_id, list(c ORDER BY k) AS v FROM cu GROUP BY doc_id, s0, e0, pos, i, word, chunk_id)",
    "run AS (SELECT doc_id, s0, e0, CAST(pos AS INTEGER) AS pos, CAST(i AS INTEGER) AS i, word, chunk_id, " + S.pmap_cols("v") + " FROM rv)",
)


@register("ranges_running", _range_sql(*_RANGE_RUN, select="SELECT * EXCLUDE (word) FROM run"))
def q_ranges_running(spark, sf):
    """E12 for all requests."""
    from textlens.operators import ranges as R

    _, tt, reqs = _range_requests(spark, sf)
    rs = R.range_running(R.range_tokens(reqs, R.with_prefixes(tt, K3)), K3, P.CHUNK)
    return rs.select(*_range_keys(), "pos", "i", "chunk_id", *_pcols())


@register(
    "ranges_resets",
    _range_sql(
        *_RANGE_RUN,
        select=f"SELECT doc_id, s0, e0, pos, CAST(pos + 1 AS VARCHAR) || '. ' || word AS label, {_RESET_VAL} AS best_pct, "
        f"{_RESET_NAME} AS best_class FROM run r WHERE i <> 0 AND i % {P.CHUNK} = 0",
    ),
)
def q_ranges_resets(spark, sf):
    """E13 for all requests: none in an empty range, and none at the end of a part chunk."""
    from textlens.operators import ranges as R

    run, tt, reqs = _range_requests(spark, sf)
    rs = R.range_running(R.range_tokens(reqs, R.with_prefixes(tt, K3)), K3, P.CHUNK).select(*R.REQUEST, "pos", "i", "word", *_pcols())
    return R.range_resets(rs, run.header, P.CHUNK).select(*_range_keys(), "pos", "label", "best_pct", "best_class")


@register("ranges_uniqueness", _range_sql(*_uniq_ctes("doc_id, s0, e0", "rv0"), select=_uniq_select("doc_id, s0, e0")))
def q_ranges_uniqueness(spark, sf):
    """E14 for all requests."""
    from textlens.operators import ranges as R

    run, _, reqs = _range_requests(spark, sf)
    u = R.range_uniqueness(R.range_word_counts(reqs, run.test, run.model, run.header), run.header)
    return u.select(*_range_keys(), "winner", "word", r6(F.col("diff")).alias("diff"), "count", "rank", "label")


@register(
    "ranges_text",
    _range_sql(
        select="SELECT r.doc_id, r.s0, r.e0, CASE WHEN r.e <= r.s THEN '' ELSE array_to_string(t.words[r.s + 1:r.e], ' ') || ' ' END AS text "
        "FROM req r JOIN test t USING (doc_id)"
    ),
)
def q_ranges_text(spark, sf):
    """T11+T12 for all requests."""
    from textlens.operators import ranges as R

    run, _, reqs = _range_requests(spark, sf)
    return R.range_texts(reqs, run.test).select(*_range_keys(), "text")


# ---------------------------------------------------------------- zero-fix slider (T15 with C1)

SWEEP = tuple(range(4, 13))


@register(
    "zero_fix_sweep",
    S.with_(
        S.split_ctes("lang"),
        S.model_ctes(),
        f"vs AS (SELECT unnest(range({SWEEP[0]}, {SWEEP[-1] + 1})) AS v)",
        "tw AS (SELECT doc_id, class, unnest(words) AS word, unnest(range(len(words))) AS pos FROM test)",
        "terms AS (SELECT vs.v, tw.doc_id, tw.class, h.class AS cand, h.k, h.n_docs, tw.pos, "
        "ln(greatest(1.0 / pow(10.0, vs.v), CAST(coalesce(l.cnt, 0) AS DOUBLE) / h.n_words)) AS term "
        "FROM tw CROSS JOIN hdr h CROSS JOIN vs LEFT JOIN lik l ON l.class = h.class AND l.word = tw.word)",
        "scores AS (SELECT v, doc_id, class, cand, k, "
        "list_reduce(list_prepend(ln(n_docs), list(term ORDER BY pos)), lambda a, x: a + x) AS score "
        "FROM terms GROUP BY v, doc_id, class, cand, k, n_docs)",
        "best AS (SELECT v, doc_id, class, CASE WHEN score > -1000000.0 THEN cand ELSE '' END AS pred, "
        "row_number() OVER (PARTITION BY v, doc_id ORDER BY score DESC, k) AS r FROM scores)",
    )
    + "SELECT CAST(v AS DOUBLE) AS v, 'Value: 1 / ' || CAST(CAST(round(pow(10.0, v)) AS BIGINT) AS VARCHAR) AS text, "
    "CAST(sum(CASE WHEN pred = class THEN 1 ELSE 0 END) AS BIGINT) AS correct, count(*) AS total, "
    + S.r6("sum(CASE WHEN pred = class THEN 1 ELSE 0 END) / count(*)")
    + " AS accuracy FROM best WHERE r = 1 GROUP BY v",
)
def q_zero_fix_sweep(spark, sf):
    from textlens.functions.text import zero_fix_text
    from textlens.operators.sums import floor_sweep

    docs = prepare(corpus(spark, sf, "lang"))
    model = train(docs).persist()
    header = model.header()
    sc = floor_sweep(test_token_lists(docs), model, header, SWEEP)
    acc = sc.groupBy("v").agg(
        F.sum((F.col("pred") == F.col("class")).cast("long")).alias("correct"), F.count(F.lit(1)).alias("total")
    )
    return acc.select(
        "v",
        zero_fix_text(F.col("v")).alias("text"),
        "correct",
        "total",
        r6(F.col("correct") / F.col("total")).alias("accuracy"),
    )


# ---------------------------------------------------------------- second three-class corpus: conversations.role


@register(
    "role_report",
    _report_sql(
        S.with_(
            S.split_ctes("role", order="c.conv_id, c.turn"),
            S.model_ctes(),
            S.score_ctes("floor", FIXED_FLOOR),
            S.pred_ctes(DEFAULT_REJECT),
        )
    ),
)
def q_role_report(spark, sf):
    from textlens.sources.corpus import conversations_corpus

    run = classify(
        conversations_corpus(spark, sf), FLOOR, FIXED_FLOOR, DEFAULT_REJECT, order_cols=("conv_id", "turn")
    )
    return _report_out(run.report())


# ---------------------------------------------------------------- model merge


@register(
    "model_merge",
    S.with_(
        S.split_ctes("lang"),
        S.model_ctes(),
        "docs2 AS (SELECT doc_id, class, CASE WHEN rn <= 50 * quota // 100 THEN 'train' ELSE 'test' END AS split, words "
        "FROM split JOIN docs USING (doc_id, class, rn) WHERE class IN ('fr', 'de'))",
        "pri2 AS (SELECT class, count(*) AS n_docs FROM docs2 WHERE split = 'train' GROUP BY class)",
        "lik2 AS (SELECT class, word, count(*) AS cnt FROM (SELECT class, unnest(words) AS word FROM docs2 "
        "WHERE split = 'train') GROUP BY class, word)",
        "mp AS (SELECT * FROM priors WHERE class NOT IN (SELECT class FROM pri2) UNION ALL SELECT * FROM pri2)",
        "ml AS (SELECT * FROM lik WHERE class NOT IN (SELECT class FROM lik2) UNION ALL SELECT * FROM lik2)",
    )
    + "SELECT ml.class, ml.word, ml.cnt, mp.n_docs FROM ml JOIN mp USING (class)",
)
def q_model_merge(spark, sf):
    """Model of ``lang`` at a 75 % train share, then ``fr`` and ``de`` from a
    model at a 50 % share; the second model wins whole on shared classes."""
    from textlens.operators.model import merge_models

    c = corpus(spark, sf, "lang")
    first = train(prepare(c))
    second = train(prepare(c, ratio=50).where(F.col("class").isin("fr", "de")))
    m = merge_models(first, second)
    return m.likelihood.join(m.priors, "class").select("class", "word", "cnt", "n_docs")


@register(
    "content_merge",
    S.with_(
        S.split_ctes("lang"),
        "test2 AS (SELECT doc_id, class, words FROM split JOIN docs USING (doc_id, class, rn) WHERE class IN ('fr', 'de') AND rn > 50 * quota // 100 AND len(words) > 0)",
        "test1 AS (SELECT doc_id, class, words FROM docs WHERE split = 'test' AND len(words) > 0)",
    )
    + "SELECT class, CAST(doc_id AS VARCHAR) AS doc_id, array_to_string(words, ' ') AS words FROM test1 WHERE class NOT IN (SELECT class FROM test2) "
    "UNION ALL SELECT class, CAST(doc_id AS VARCHAR), array_to_string(words, ' ') FROM test2",
)
def q_content_merge(spark, sf):
    """J3+S6+S7: the test token lists of two saved models merged (the second wins whole), dumped for examination and read from
    the dump."""
    from textlens.sources.model_io import dump_model, load_content, load_model, merge_content, save_model

    c, roots = corpus(spark, sf, "lang"), [_scratch(spark, "model") for _ in range(3)]
    first, second = prepare(c), prepare(c, ratio=50).where(F.col("class").isin("fr", "de"))
    for docs, root in zip((first, second), roots):
        save_model(train(docs), root, test=test_token_lists(docs))
    merged = merge_content(*[load_content(spark, root) for root in roots[:2]])
    dump_model(load_model(spark, roots[0]), roots[2], merged)
    back = spark.read.schema("class string, doc_id string, words array<string>").json(f"{roots[2]}/content-examine")
    return back.select("class", "doc_id", F.array_join("words", " ").alias("words"))


# ---------------------------------------------------------------- payload


@register("payload_json")
def q_payload_json(spark, sf):
    """The payload as JSON lines (rows-only check: JSON text)."""
    from textlens.sources.model_io import payload

    run, pt = _explain(spark, sf)
    return payload(run.model, pt, run.report(), run.header)


@register(
    "payload_roundtrip",
    S.explain_sql(
        S.pred_ctes(DEFAULT_REJECT),
        S.confusion_ctes(),
        S.report_ctes(),
        "nv AS (SELECT class, count(*) AS n_vocab FROM lik GROUP BY class)",
        "nt AS (SELECT class, count(*) AS n_test, CAST(sum(len(words) + 2) * 3 AS BIGINT) AS n_trace FROM test GROUP BY class)",
        select="SELECT p.class, p.n_docs AS sample_amount, nv.n_vocab, nt.n_test, nt.n_trace, "
        f"{S.r6('r.precision')} AS precision, {S.r6('r.recall')} AS recall, {S.r6('r.f1')} AS f1, "
        "CAST(r.support AS DOUBLE) AS support "
        "FROM priors p JOIN nv USING (class) JOIN nt USING (class) JOIN rep r USING (class)",
    ),
)
def q_payload_roundtrip(spark, sf):
    """S9 -> S10: write the payload as JSON lines and parse it back."""
    from textlens.sources.model_io import parse_payload, payload

    run, pt = _explain(spark, sf)
    classes, words, samples = parse_payload(payload(run.model, pt, run.report(), run.header))
    nv = words.groupBy("class").agg(F.count(F.lit(1)).alias("n_vocab"))
    trace_len = F.aggregate(F.map_values("probs"), F.lit(0).cast("long"), lambda a, arr: a + F.size(arr))
    nt = samples.groupBy("class").agg(F.count(F.lit(1)).alias("n_test"), F.sum(trace_len).alias("n_trace"))
    return classes.join(nv, "class").join(nt, "class").select(
        "class",
        F.col("sampleAmount").alias("sample_amount"),
        "n_vocab",
        "n_test",
        "n_trace",
        r6(F.col("report")[0]).alias("precision"),
        r6(F.col("report")[1]).alias("recall"),
        r6(F.col("report")[3]).alias("f1"),
        F.col("report")[4].alias("support"),
    )


def _document(spark, sf):
    """The payload of the three-class run as one committed document, read back."""
    from textlens.operators.explain import position_terms
    from textlens.sources.document import document_lines, read_document, write_document

    from textlens.session import saved

    run = _three(spark, sf)
    pred = saved(run.predictions(), "predictions")
    report, accuracy = saved(ev.report(ev.confusion(pred)), "report"), saved(ev.accuracy(pred), "accuracy")
    root = _scratch(spark, "document")
    # the lines hold every term: they are made once, and then put in order
    pt = position_terms(run.test, run.model, run.header, FLOOR, FIXED_FLOOR)
    write_document(saved(document_lines(run.model, saved(pt, "terms"), report, accuracy, run.header), "lines"), root)
    return read_document(spark, root)


def _numbers(values) -> str:
    return " UNION ALL ".join(f"SELECT {c} AS class, '{n}' AS name, {i} AS place, {v} FROM {t}" for c, n, i, v, t in values)


_DOC_VALUES = [("class", "sampleAmount", "0", "CAST(n_docs AS DOUBLE) AS value", "priors")]
_DOC_VALUES += [
    (c, n, str(i), f"{S.r6(f)} AS value", f"rep WHERE {w}")
    for c, n, w in (("class", "report", "row_order = 0"), ("NULL", "Avg/total", "row_order = 1"))
    for i, f in enumerate(("precision", "recall", "average", "f1", "CAST(support AS DOUBLE)"))
]
_DOC_VALUES += [("NULL", "accuracy", "0", "CAST(sum(CASE WHEN pred = class THEN 1 ELSE 0 END) AS DOUBLE) AS value", "pred"), ("NULL", "accuracy", "1", "CAST(count(*) AS DOUBLE)", "pred")]


@register("payload_document", S.explain_sql(S.pred_ctes(DEFAULT_REJECT), S.confusion_ctes(), S.report_ctes(), select=_numbers(_DOC_VALUES)))
def q_payload_document(spark, sf):
    """S9+S10: the numbers of the nested document: sample amounts, reports, ``Avg/total`` and ``accuracy``."""
    _, values = _document(spark, sf)
    numbers = F.from_json(F.when(F.col("name") == "sampleAmount", F.concat(F.lit("["), "json", F.lit("]"))).otherwise(F.col("json")), "array<double>")
    return values.select("class", "name", F.posexplode(numbers).alias("place", "value")).withColumn("value", r6(F.col("value")))


@register(
    "payload_words",
    S.explain_sql(
        select="SELECT class, 'wordFreqs' AS section, word AS key, CAST(cnt AS VARCHAR) AS value FROM lik UNION ALL "
        "SELECT class, 'testSamps', CAST(doc_id AS VARCHAR), array_to_string(words, ' ') FROM test"
    ),
)
def q_payload_words(spark, sf):
    """S9+S10: the word counts and the samples' words of the nested document."""
    entries, _ = _document(spark, sf)
    value = F.when(F.col("section") == "testSamps", F.array_join(F.from_json("json", "array<string>"), " ")).otherwise(F.col("json"))
    return entries.where(F.col("section") != "testSampsProbs").select("class", "section", "key", value.alias("value"))


_TRACES = (
    "(SELECT class, CAST(doc_id AS VARCHAR) AS sample, cand, CAST(0 AS INTEGER) AS place, ln(n_docs) AS value FROM scores UNION ALL "
    "SELECT class, CAST(doc_id AS VARCHAR), cand, CAST(pos + 1 AS INTEGER), term FROM terms UNION ALL "
    "SELECT s.class, CAST(s.doc_id AS VARCHAR), s.cand, CAST(len(t.words) + 1 AS INTEGER), s.score FROM scores s JOIN test t USING (doc_id))"
)


@register("payload_traces", S.explain_sql(select=f"SELECT class, sample, cand, place, {S.r6('value')} AS value FROM {_TRACES}"))
def q_payload_traces(spark, sf):
    """S9+S10: every position of every trace of the nested document."""
    entries, _ = _document(spark, sf)
    traces = entries.where(F.col("section") == "testSampsProbs").select("class", F.col("key").alias("sample"), F.explode(F.from_json("json", "map<string, array<double>>")).alias("cand", "trace"))
    return traces.select("class", "sample", "cand", F.posexplode("trace").alias("place", "value")).withColumn("value", r6(F.col("value")))


@register(
    "sample_lookup",
    S.explain_sql(
        "ends AS (SELECT class, min(CAST(doc_id AS VARCHAR)) AS a, max(CAST(doc_id AS VARCHAR)) AS z FROM test GROUP BY class)",
        select="SELECT x.class, x.sample, x.cand, x.place, "
        + S.r6("x.value")
        + " AS value, x.sample || ', words: ' || CAST(len(t.words) AS VARCHAR) AS label, array_to_string(t.words, ' ') AS text "
        f"FROM {_TRACES} x JOIN ends e ON e.class = x.class AND (x.sample = e.a OR x.sample = e.z) "
        "JOIN test t ON t.class = x.class AND CAST(t.doc_id AS VARCHAR) = x.sample",
    ),
)
def q_sample_lookup(spark, sf):
    """E7+S6: the first and the last sample of each class by name, from the bucketed sample store: traces, words, label."""
    from textlens.functions.text import sample_label
    from textlens.sources.model_io import find_samples, save_samples, trace_map

    run, pt = _explain(spark, sf)
    root = _scratch(spark, "samples")
    save_samples(pt, root)
    name = F.col("doc_id").cast("string")
    wanted = run.test.groupBy("class").agg(F.min(name).alias("a"), F.max(name).alias("z")).collect()  # two names a class
    found = find_samples(spark, root, [(r["class"], x) for r in wanted for x in {r["a"], r["z"]}])
    traces = found.select(
        "class",
        F.col("doc_id").alias("sample"),
        sample_label(F.col("doc_id"), F.size("words")).alias("label"),
        F.array_join("words", " ").alias("text"),
        F.explode(trace_map([c for c, _, _ in run.header])).alias("cand", "trace"),
    )
    return traces.select("class", "sample", "label", "text", "cand", F.posexplode("trace").alias("place", "value")).withColumn("value", r6(F.col("value")))


# ---------------------------------------------------------------- labelled lines


def _lines(spark, sf, mode, stop=False):
    from textlens.operators.lines import read_lines
    from textlens.sources.corpus import labelled_lines

    lines = labelled_lines(spark, sf)
    total = lines.count()  # one number: the line count fixes the train/test amounts
    t = total * P.LINE_TRAIN_PCT // 100
    return read_lines(lines, t, total - t, mode, stopwords=stop)


@register(
    "line_label",
    S.with_(S.line_ctes()) + "SELECT line_no, label, class, CAST(len(words) AS INTEGER) AS n_words FROM lt",
)
def q_line_label(spark, sf):
    from textlens.operators.lines import line_tokens
    from textlens.sources.corpus import labelled_lines

    t = line_tokens(labelled_lines(spark, sf))
    return t.select("line_no", "label", "class", F.size("words").alias("n_words"))


_LINE_OUT = "CAST(len(words) AS INTEGER) AS n_words"


@register(
    "line_split_clean",
    S.with_(S.line_ctes())
    + f"SELECT line_no AS doc_id, line_no, class, 'train' AS split, {_LINE_OUT} FROM lt, n WHERE line_no < n.t "
    f"UNION ALL SELECT line_no, line_no, class, 'test', {_LINE_OUT} FROM lt, n "
    "WHERE line_no >= n.t AND line_no < n.t + n.s",
)
def q_line_split_clean(spark, sf):
    return _lines(spark, sf, "clean").select("doc_id", "line_no", "class", "split", F.size("words").alias("n_words"))


@register(
    "line_split_as_coded",
    S.with_(S.line_ctes())
    + f"SELECT line_no AS doc_id, line_no, class, 'train' AS split, {_LINE_OUT} FROM lt, n WHERE line_no < n.t "
    "UNION ALL SELECT CASE WHEN line_no < n.t THEN line_no ELSE line_no - 1 END, line_no, class, 'test', "
    f"{_LINE_OUT} FROM lt, n WHERE line_no <> n.t "
    "AND CASE WHEN line_no < n.t THEN line_no ELSE line_no - 1 END < n.s "
    "AND CASE WHEN line_no < n.t THEN line_no ELSE line_no - 1 END < greatest(n.total - n.t - 1, 0)",
)
def q_line_split_as_coded(spark, sf):
    return _lines(spark, sf, "as_coded").select("doc_id", "line_no", "class", "split", F.size("words").alias("n_words"))


#: The labelled-line files of the original, by line number modulo three.
LINE_FILES = ("amazon_cells_labelled.txt", "imdb_labelled.txt", "yelp_labelled.txt")
#: In the written files a blank line stands before every tenth labelled line.
BLANK_EVERY = 10


def _line_files_sql() -> str:
    names = ", ".join(f"'{n}'" for n in LINE_FILES)
    prefixes = "['revs-amazon ', 'revs-imdb ', 'revs-yelp ']"
    return S.with_(S.line_ctes()) + (
        f"SELECT [{names}][line_no % 3 + 1] AS source, line_no // 3 + line_no // 3 // {BLANK_EVERY} + 1 AS line_no, label, "
        f"{prefixes}[line_no % 3 + 1] || label AS class, CAST(len(words) AS INTEGER) AS n_words, array_to_string(words, ' ') AS words FROM lt"
    )


@register("line_files", _line_files_sql())
def q_line_files(spark, sf):
    """S2+T8: labelled lines written as three files with the original's names and blank lines among them, and read
    by the numbered line scan."""
    from textlens.operators.lines import line_tokens
    from textlens.sources.corpus import labelled_lines, text_lines, write_lines

    root = _scratch(spark, "lines")
    lines = labelled_lines(spark, sf)
    place = F.expr("line_no div 3")
    texts = F.when(place % BLANK_EVERY == 0, F.array(F.lit(""), F.col("line"))).otherwise(F.array("line"))
    source = F.element_at(F.array(*map(F.lit, LINE_FILES)), (F.col("line_no") % 3 + 1).cast("int"))
    each = lines.select(source.alias("source"), place.alias("at"), F.posexplode(texts).alias("half", "line"))
    write_lines(each.select("source", (F.col("at") * 2 + F.col("half")).alias("line_no"), "line"), root)
    toks = line_tokens(text_lines(spark, f"{root}/*", parts=True))
    return toks.select("source", "line_no", "label", "class", F.size("words").alias("n_words"), F.array_join("words", " ").alias("words"))


# ---------------------------------------------------------------- experiments (M7, M8)


def _curve_sql(whole: bool = False) -> str:
    """Sizes 25, 50, ..., 1000 of the as-coded line split, or ``whole``: fortieths of all lines, clean split."""
    from textlens.functions.stopwords import sql_list

    sizes = "sz AS (SELECT CAST(j * 5 AS BIGINT) AS size, CAST(j * 5 * 24 // 100 AS BIGINT) AS t FROM range(5, 205, 5) r(j))"
    samples = [
        "te0 AS (SELECT g.size, g.m, g.t, g.s, lt2.line_no, lt2.class, "
        "CASE WHEN lt2.line_no < g.t THEN lt2.line_no ELSE lt2.line_no - 1 END AS sample, "
        "CASE WHEN g.m = 1 THEN lt2.words_s ELSE lt2.words END AS words FROM g JOIN lt2 ON lt2.line_no <> g.t)",
        "te AS (SELECT te0.size, te0.m, te0.sample, te0.class, te0.words FROM te0, n "
        "WHERE te0.sample < te0.s AND te0.sample < greatest(n.total - te0.t - 1, 0) AND len(te0.words) > 0)",
    ]
    if whole:
        sizes = (
            "sz AS (SELECT DISTINCT CAST(n.total * j // 40 AS BIGINT) AS size, CAST((n.total * j // 40) * 24 // 100 AS BIGINT) AS t "
            "FROM n, range(1, 41) r(j))"
        )
        samples = [
            "te AS (SELECT size, m, sample, class, words FROM (SELECT g.size, g.m, lt2.line_no AS sample, lt2.class, "
            "CASE WHEN g.m = 1 THEN lt2.words_s ELSE lt2.words END AS words "
            "FROM g JOIN lt2 ON lt2.line_no >= g.t AND lt2.line_no < g.size) WHERE len(words) > 0)"
        ]
    return S.with_(
        S.line_ctes(),
        f"lt2 AS (SELECT line_no, class, words, list_filter(words, lambda w: NOT list_contains([{sql_list()}], w)) "
        "AS words_s FROM lt)",
        sizes,
        "g AS (SELECT size, t, size - t AS s, m FROM sz, (SELECT 0 AS m UNION ALL SELECT 1) ms)",
        "tr AS (SELECT g.size, g.m, lt2.line_no, lt2.class, CASE WHEN g.m = 1 THEN lt2.words_s ELSE lt2.words END AS words "
        "FROM g JOIN lt2 ON lt2.line_no < g.t)",
        *samples,
        "pri AS (SELECT size, m, class, count(*) AS n_docs FROM tr GROUP BY size, m, class)",
        "lk AS (SELECT size, m, class, word, count(*) AS cnt FROM (SELECT size, m, class, unnest(words) AS word FROM tr) "
        "GROUP BY size, m, class, word)",
        "tot AS (SELECT size, m, class, sum(cnt) AS n_words FROM lk GROUP BY size, m, class)",
        "fs AS (SELECT size, m, class, min(line_no) AS first_seen FROM tr WHERE len(words) > 0 GROUP BY size, m, class)",
        "hdr AS (SELECT t.size, t.m, t.class, p.n_docs, t.n_words, "
        "row_number() OVER (PARTITION BY t.size, t.m ORDER BY f.first_seen, t.class) AS k "
        "FROM tot t JOIN pri p USING (size, m, class) JOIN fs f USING (size, m, class))",
        "tw AS (SELECT size, m, sample, class, unnest(words) AS word, unnest(range(len(words))) AS pos FROM te)",
        "terms AS (SELECT tw.size, tw.m, tw.sample, tw.class, h.class AS cand, h.k, h.n_docs, tw.pos, "
        "(CAST(coalesce(l.cnt, 0) AS DOUBLE) + 1) / h.n_words AS term FROM tw JOIN hdr h ON h.size = tw.size AND h.m = tw.m "
        "LEFT JOIN lk l ON l.size = tw.size AND l.m = tw.m AND l.class = h.class AND l.word = tw.word)",
        "scores AS (SELECT size, m, sample, class, cand, k, "
        "list_reduce(list_prepend(CAST(n_docs AS DOUBLE), list(term ORDER BY pos)), lambda a, x: a * x) AS score "
        "FROM terms GROUP BY size, m, sample, class, cand, k, n_docs)",
        "best AS (SELECT size, m, sample, class, CASE WHEN score > -1000000.0 THEN cand ELSE '' END AS pred, "
        "row_number() OVER (PARTITION BY size, m, sample ORDER BY score DESC, k) AS r FROM scores)",
    ) + (
        "SELECT size, m = 1 AS stop_words, CAST(sum(CASE WHEN pred = class THEN 1 ELSE 0 END) AS BIGINT) AS correct, "
        "count(*) AS total, "
        + S.r6("sum(CASE WHEN pred = class THEN 1 ELSE 0 END) / count(*)")
        + " AS accuracy FROM best WHERE r = 1 GROUP BY size, m"
    )


@register("learning_curve", _curve_sql())
def q_learning_curve(spark, sf):
    from textlens.plans.experiments import learning_curve
    from textlens.sources.corpus import labelled_lines

    lc = learning_curve(labelled_lines(spark, sf), stopwords=True, train_perc=24, sizes=range(25, 1001, 25), mode="as_coded")
    return lc.withColumn("accuracy", r6(F.col("accuracy")))


@register("learning_curve_whole", _curve_sql(whole=True))
def q_learning_curve_whole(spark, sf):
    from textlens.plans.experiments import learning_curve
    from textlens.sources.corpus import labelled_lines

    lc = learning_curve(labelled_lines(spark, sf), stopwords=True, train_perc=24)
    return lc.withColumn("accuracy", r6(F.col("accuracy")))


SEEDS = (1, 2, 3, 4, 5)


def _repeat_ctes(seeds) -> str:
    """``acc(g, correct, total)``: accuracy of a run for each seed, shuffled by its order value."""
    runs = " UNION ALL ".join(
        f"SELECT {s} AS g, c.doc_id, c.class, row_number() OVER (PARTITION BY c.class ORDER BY {S.seeded_order(s, 'c')}, c.doc_id) AS rn FROM corpus c" for s in seeds
    )
    return S.with_(
        f"corpus AS ({S.CORPUS['source']})",
        "sizes AS (SELECT class, count(*) AS n FROM corpus GROUP BY class)",
        f"words AS (SELECT doc_id, class, {S.words_expr()} AS words FROM corpus)",
        f"runs AS ({runs})",
        f"docs AS (SELECT r.g, r.doc_id, r.class, r.rn <= {P.RATIO} * z.n // 100 AS train, w.words FROM runs r JOIN sizes z USING (class) JOIN words w USING (doc_id, class))",
        "pri AS (SELECT g, class, count(*) AS n_docs FROM docs WHERE train GROUP BY g, class)",
        "lik AS (SELECT g, class, word, count(*) AS cnt FROM (SELECT g, class, unnest(words) AS word FROM docs WHERE train) GROUP BY g, class, word)",
        "hdr AS (SELECT g, class, any_value(n_docs) AS n_docs, sum(cnt) AS n_words, row_number() OVER (PARTITION BY g ORDER BY class) AS k FROM lik JOIN pri USING (g, class) GROUP BY g, class)",
        "tw AS (SELECT g, doc_id, class, unnest(words) AS word, unnest(range(len(words))) AS pos FROM docs WHERE NOT train)",
        "terms AS (SELECT tw.g, tw.doc_id, tw.class, tw.pos, h.class AS cand, h.k, h.n_docs, "
        f"ln(greatest({FIXED_FLOOR!r}, CAST(coalesce(l.cnt, 0) AS DOUBLE) / h.n_words)) AS term "
        "FROM tw JOIN hdr h USING (g) LEFT JOIN lik l ON l.g = tw.g AND l.class = h.class AND l.word = tw.word)",
        "scores AS (SELECT g, doc_id, class, cand, k, list_reduce(list_prepend(ln(n_docs), list(term ORDER BY pos)), lambda a, x: a + x) AS score "
        "FROM terms GROUP BY g, doc_id, class, cand, k, n_docs)",
        f"best AS (SELECT g, class, CASE WHEN score > {FIXED_FLOOR_REJECT!r} THEN cand ELSE '' END AS pred, "
        "row_number() OVER (PARTITION BY g, class, doc_id ORDER BY score DESC, k) AS r FROM scores)",
        "acc AS (SELECT g, CAST(sum(CASE WHEN pred = class THEN 1 ELSE 0 END) AS BIGINT) AS correct, count(*) AS total FROM best WHERE r = 1 GROUP BY g)",
    )


@register(
    "repeat_mean",
    _repeat_ctes(SEEDS)
    + f"SELECT g AS seed, correct, total, {S.r6('correct / total')} AS accuracy, {S.r6('avg(correct / total) OVER ()')} AS mean_accuracy, count(*) OVER () AS runs FROM acc",
)
def q_repeat_mean(spark, sf):
    """M7: five re-sampled runs (seeded shuffles) and their mean."""
    from textlens.plans.experiments import repeat_mean

    rm = repeat_mean(corpus(spark, sf, "source"), seeds=SEEDS, reject=FIXED_FLOOR_REJECT)
    return rm.withColumns({c: r6(F.col(c)) for c in ("accuracy", "mean_accuracy")})


# ---------------------------------------------------------------- linear SVM baseline


@register(
    "random_split",
    S.with_(f"corpus AS ({S.CORPUS['source']})")
    + f"SELECT c.doc_id, c.class, CASE WHEN {S.seeded_order(7, 'c')} / 4503599627370496.0 < {P.RATIO} / 100.0 THEN 'train' ELSE 'test' END AS split FROM corpus c",
)
def q_random_split(spark, sf):
    """Seeded random train/test fractions."""
    from textlens.operators.sampling import random_split

    return random_split(corpus(spark, sf, "source"), pick=1.0, ratio_pct=P.RATIO, seed=7).select("doc_id", "class", "split")


@register(
    "svm_tokens",
    S.with_(f"corpus AS ({S.CORPUS['quality']})")
    + "SELECT class, word, count(*) AS n FROM (SELECT class, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{Nd}\\p{Nl}\\p{Pc}]{2,}')) AS word FROM corpus) "
    "GROUP BY class, word",
)
def q_svm_tokens(spark, sf):
    """The regex words of the labelled documents, and how often each occurs by class."""
    from textlens.operators.svm import svm_tokens

    words = corpus(spark, sf, "quality").select("class", F.explode(svm_tokens(F.col("text"))).alias("word"))
    return words.groupBy("class", "word").agg(F.count(F.lit(1)).alias("n"))


@register("svm_report")
def q_svm_report(spark, sf):
    """C9+M6: one-vs-rest linear SVM on ``quality`` (random 75/25 split), per-class
    report with macro and support-weighted means (rows-only: an iterative fit)."""
    from textlens.operators.sampling import random_split
    from textlens.operators.svm import svm_predict

    split = random_split(corpus(spark, sf, "quality"), pick=1.0, ratio_pct=P.RATIO, seed=7)
    pred = svm_predict(split, c=1.0, stopwords=True)
    rows = ev.class_report(ev.confusion(pred))
    means = ev.weighted_means(rows).persist()  # one row
    return rows.select(
        "class", "precision", "recall", "f1", "support"
    ).unionByName(
        means.select(
            F.lit("macro").alias("class"), F.col("macro_precision").alias("precision"),
            F.col("macro_recall").alias("recall"), F.col("macro_f1").alias("f1"), "support",
        )
    ).unionByName(
        means.select(
            F.lit("weighted").alias("class"), F.col("weighted_precision").alias("precision"),
            F.col("weighted_recall").alias("recall"), F.col("weighted_f1").alias("f1"), "support",
        )
    ).unionByName(
        means.select(*[F.lit("accuracy").alias("class")], *[F.col("accuracy").alias(c) for c in ("precision", "recall", "f1")], "support")
    )


# ---------------------------------------------------------------- files: folder scan, model tables, run log


def _scratch(spark, name):
    """A fresh folder under the shared checkpoint folder of the session."""
    import uuid

    from textlens.session import checkpoint_dir

    return f"{checkpoint_dir(spark).rstrip('/')}/textlens-{name}-{uuid.uuid4().hex}"


@register(
    "folder_scan",
    S.with_(f"corpus AS ({S.CORPUS['lang']})", f"docs AS (SELECT class, {S.words_expr()} AS words FROM corpus)")
    + "SELECT class, count(*) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS n_words FROM docs GROUP BY class",
)
def q_folder_scan(spark, sf):
    """``documents`` written as one file per sample in class folders, then
    read back as a class-folder corpus."""
    from textlens.sources.corpus import folder_corpus, write_folder_corpus

    root = _scratch(spark, "folders")
    write_folder_corpus(corpus(spark, sf, "lang"), root)
    fc = tokenize(folder_corpus(spark, root, partitioned=True))
    return fc.groupBy("class").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.size("words")).cast("long").alias("n_words"))


@register(
    "model_roundtrip",
    S.with_(S.split_ctes("lang"), S.model_ctes())
    + "SELECT l.class, l.word, l.cnt, p.n_docs FROM lik l JOIN priors p USING (class)",
)
def q_model_roundtrip(spark, sf):
    """S5+S6+S7: save the model (likelihood partitioned by class), dump it as
    JSON for examination, and read it back with fixed schemas."""
    from textlens.sources.model_io import dump_model, load_model, save_model

    root = _scratch(spark, "model")
    docs = prepare(corpus(spark, sf, "lang"))
    m = train(docs)
    save_model(m, root, test=test_token_lists(docs))
    dump_model(m, root)
    back = load_model(spark, root)
    return back.likelihood.join(back.priors, "class").select("class", "word", "cnt", "n_docs")


@register(
    "run_log",
    _repeat_ctes(SEEDS[:3])
    + f"SELECT 100.0::DOUBLE AS pick_pct, {S.r6('avg(correct / total)')} AS mean_accuracy, count(*) AS runs, 'documents.source' AS dataset, run "
    "FROM acc, (SELECT unnest(['first', 'second']) AS run) GROUP BY run",
)
def q_run_log(spark, sf):
    """Two runs of the repeat-mean experiment in a run log, one of them replayed (the log holds the seconds too)."""
    import time

    from textlens.plans.experiments import repeat_mean
    from textlens.session import saved
    from textlens.sources.model_io import append_run, read_runs

    root = _scratch(spark, "runlog")
    t0 = time.time()
    rm = saved(repeat_mean(corpus(spark, sf, "source"), seeds=SEEDS[:3], reject=FIXED_FLOOR_REJECT), "repeats")
    metrics = rm.groupBy("runs").agg(F.avg("accuracy").alias("mean_accuracy"))
    metrics = metrics.select(F.lit(100.0).alias("pick_pct"), "mean_accuracy", "runs", F.lit("documents.source").alias("dataset"), F.lit(time.time() - t0).alias("seconds"))
    for run in ("first", "second", "first"):
        append_run(metrics, root, run)
    return read_runs(spark, root).select("pick_pct", r6(F.col("mean_accuracy")).alias("mean_accuracy"), "runs", "dataset", "run")


def _plain_name(c):
    """Sample names as people give them: with spaces and signs, and no numbers alone."""
    return F.concat(F.lit("s+ample no "), F.col(c).cast("string"), F.lit("%.txt"))


@register("folder_report", _report_sql(S.nb_predictions("lang", "floor", FIXED_FLOOR, FIXED_FLOOR_REJECT)).replace("ORDER BY c.doc_id", "ORDER BY 's+ample no ' || CAST(c.doc_id AS VARCHAR) || '%.txt'").replace("SELECT class, round", "SELECT CASE WHEN row_order = 1 THEN class ELSE class || ' + 1' END AS class, round"))
def q_folder_report(spark, sf):
    """``documents`` as plain class folders with such names, read back, trained on and scored; samples in the order of
    their names."""
    from textlens.session import saved
    from textlens.sources.corpus import folder_corpus, write_plain_folders

    root = _scratch(spark, "plain")
    docs = corpus(spark, sf, "lang")
    write_plain_folders(docs.select(_plain_name("doc_id").alias("doc_id"), F.concat("class", F.lit(" + 1")).alias("class"), "text"), root)
    # the files are opened once; the passes of the split, the model and the scores read the table
    return _report_out(classify(saved(folder_corpus(spark, root), "plain-corpus"), FLOOR, FIXED_FLOOR, FIXED_FLOOR_REJECT).report())


# ---------------------------------------------------------------- streaming scorer


@register("stream_scores", _pred_sql("source", "floor", FIXED_FLOOR, FIXED_FLOOR_REJECT))
def q_stream_scores(spark, sf):
    """The held-out documents arrive as files and are scored by the streaming
    scorer against the saved model; the sink holds the same predictions as
    ``nb_fixed_floor``."""
    from textlens.sources.model_io import load_model, save_model
    from textlens.streaming.scorer import start_scoring

    root = _scratch(spark, "stream")
    docs = prepare(corpus(spark, sf, "source"))
    save_model(train(docs), f"{root}/model")
    test_ids = docs.where(F.col("split") == "test").select("doc_id")
    incoming = corpus(spark, sf, "source").join(test_ids, "doc_id", "left_semi")
    incoming.repartition(4).write.parquet(f"{root}/incoming")
    q = start_scoring(
        spark, f"{root}/incoming", incoming.schema, load_model(spark, f"{root}/model"), f"{root}/sink",
        f"{root}/checkpoint", FLOOR, FIXED_FLOOR, FIXED_FLOOR_REJECT,
    )
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/sink")
    return out.select("doc_id", "class", "pred", r6(F.col("score")).alias("score"))


@register("nb_addone_sparse", _pred_sql("source", "addone", None, DEFAULT_REJECT))
def q_nb_addone_sparse(spark, sf):
    """C4 by the sum form (``score_sparse``): same predictions and scores (to 6
    places) as ``nb_addone`` with another data movement."""
    from textlens.operators.model import test_token_lists as held_out
    from textlens.operators.scoring import score_sparse

    docs = prepare(corpus(spark, sf, "source")).persist()
    model = train(docs).persist()
    header = model.header()
    sc = score_sparse(held_out(docs), model, header, ADDONE)
    return sc.select("doc_id", "class", "pred", r6(F.array_max("scores")).alias("score"))
