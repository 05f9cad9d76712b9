"""DuckDB SQL for the registered queries (the correctness oracle).

The SQL is written independently of the Spark plans: plain windows, joins and
list functions over the pre-registered tables. Sums that must match the
original per-word loop bit for bit are ordered list folds (``list_reduce``).
"""

from __future__ import annotations

from textlens.functions.stopwords import sql_list
from textlens.functions.text import PUNCTUATION, WHITESPACE_RE2
from textlens.plans import params as P

PUNCT_SQL = PUNCTUATION.replace("'", "''")

CORPUS = {
    "lang": "SELECT doc_id, lang AS class, text FROM documents",
    "source": "SELECT doc_id, source AS class, text FROM documents",
    "quality": "SELECT l.doc_id, CAST(l.quality AS VARCHAR) AS class, d.text "
    "FROM labels l JOIN documents d USING (doc_id)",
    "role": "SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS doc_id, role AS class, text, conv_id, turn "
    "FROM conversations",
}

# labelled-line stand-in: one line per labelled document, text on one line, a tab, the label
LINES = (
    "lines AS (SELECT CAST(row_number() OVER (ORDER BY l.doc_id) - 1 AS BIGINT) AS line_no, "
    "regexp_replace(d.text, '{ws}', ' ', 'g') || chr(9) || CAST(l.quality AS VARCHAR) AS line "
    "FROM labels l JOIN documents d USING (doc_id))"
)


def line_ctes(train_pct: int = P.LINE_TRAIN_PCT, stop: bool = False) -> str:
    """lines -> lt(line_no, label, class, words) -> n(total, t, s)."""
    stop_cond = f" AND NOT list_contains([{sql_list()}], w)" if stop else ""
    return ",\n".join(
        [
            LINES.format(ws=WHITESPACE_RE2),
            f"lt0 AS (SELECT line_no, list_filter(string_split_regex(lower(translate(line, '{PUNCT_SQL}', '')), "
            f"'{WHITESPACE_RE2}'), lambda w: w <> '') AS allw FROM lines)",
            "lt AS (SELECT line_no, allw[-1] AS label, allw[-1] AS class, "
            f"list_filter(allw, lambda w: w NOT IN ('0', '1'){stop_cond}) AS words FROM lt0 WHERE len(allw) > 0)",
            f"n AS (SELECT count(*) AS total, count(*) * {train_pct} // 100 AS t, count(*) - count(*) * {train_pct} // 100 AS s "
            "FROM lt)",
        ]
    )


def words_expr(text: str = "text", stop: bool = False, digits: bool = False) -> str:
    cond = "w <> ''"
    if digits:
        cond += " AND w NOT IN ('0', '1')"
    if stop:
        cond += f" AND NOT list_contains([{sql_list()}], w)"
    return (
        f"list_filter(list_transform(string_split_regex({text}, '{WHITESPACE_RE2}'), "
        f"lambda w: lower(translate(w, '{PUNCT_SQL}', ''))), lambda w: {cond})"
    )


def seeded_order(seed: int, row: str) -> str:
    """The order value of a seeded shuffle: the first 52 bits of md5 over seed, class and doc_id."""
    return f"CAST('0x' || substr(md5('{seed}|' || {row}.class || '|' || CAST({row}.doc_id AS VARCHAR)), 1, 13) AS BIGINT)"


def split_ctes(
    key: str, pick: int = 100, ratio: int = P.RATIO, balanced: bool = False, stop: bool = False, order: str = "c.doc_id", cap: int | None = None
) -> str:
    """corpus -> sizes -> quota -> split -> docs(doc_id, class, split, rn, words)."""
    if balanced:
        most = "min(n) OVER ()" if cap is None else f"least({cap}, min(n) OVER ())"
        quota = f"CAST({most} * {pick} // 100 AS BIGINT)"
    else:
        quota = f"CAST(n * {pick} // 100 AS BIGINT)"
    return f"""corpus AS ({CORPUS[key]}),
sizes AS (SELECT class, count(*) AS n FROM corpus GROUP BY class),
quota AS (SELECT class, n, {quota} AS quota FROM sizes),
ranked AS (SELECT c.*, row_number() OVER (PARTITION BY c.class ORDER BY {order}) AS rn FROM corpus c),
split AS (
  SELECT r.doc_id, r.class, r.text, r.rn, q.quota,
         CASE WHEN r.rn <= {ratio} * q.quota // 100 THEN 'train' ELSE 'test' END AS split
  FROM ranked r JOIN quota q USING (class) WHERE r.rn <= q.quota),
docs AS (SELECT doc_id, class, split, rn, {words_expr('text', stop)} AS words FROM split)"""


def model_ctes(classes=None) -> str:
    """priors, lik, totals, hdr(class, n_docs, n_words, k), test(doc_id, class, words)."""
    restrict = ""
    order = "t.class"
    if classes:
        lst = ", ".join(f"'{c}'" for c in classes)
        restrict = f" WHERE t.class IN ({lst})"
        order = "list_position([" + lst + "], t.class)"
    test_restrict = f" AND class IN ({', '.join(repr(c) for c in classes)})" if classes else ""
    train_restrict = f" AND class IN ({', '.join(repr(c) for c in classes)})" if classes else ""
    return f"""priors AS (SELECT class, count(*) AS n_docs FROM docs WHERE split = 'train'{train_restrict} GROUP BY class),
lik AS (SELECT class, word, count(*) AS cnt
        FROM (SELECT class, unnest(words) AS word FROM docs WHERE split = 'train'{train_restrict}) GROUP BY class, word),
totals AS (SELECT class, CAST(sum(cnt) AS BIGINT) AS n_words FROM lik GROUP BY class),
hdr AS (SELECT t.class, p.n_docs, t.n_words, CAST(row_number() OVER (ORDER BY {order}) - 1 AS INTEGER) AS k
        FROM totals t JOIN priors p USING (class){restrict}),
test AS (SELECT doc_id, class, words FROM docs WHERE split = 'test' AND len(words) > 0{test_restrict})"""


def term_expr(mode: str, zero_fix: float | None = None) -> str:
    c = "CAST(coalesce(l.cnt, 0) AS DOUBLE)"
    if mode == "floor":
        return f"ln(greatest({zero_fix!r}, {c} / h.n_words))"
    if mode in ("addone", "addone_as_coded"):
        return f"ln(({c} + 1) / h.n_words)"
    if mode == "product":
        return f"({c} + 1) / h.n_words"
    raise ValueError(mode)


def fold_expr(mode: str) -> str:
    """Ordered fold of the per-word terms, as the original loop adds them."""
    terms = "list(term ORDER BY pos)"
    lp = "ln(n_docs)"
    if mode == "product":
        return f"list_reduce(list_prepend(CAST(n_docs AS DOUBLE), {terms}), lambda a, x: a * x)"
    if mode == "addone_as_coded":
        return (
            f"list_reduce(list_prepend({lp}, list_prepend({lp}, list_slice({terms}, 1, count(*) - 1))), "
            "lambda a, x: a + x)"
        )
    return f"list_reduce(list_prepend({lp}, {terms}), lambda a, x: a + x)"


def score_ctes(mode: str, zero_fix: float | None = None) -> str:
    """terms(doc_id, class, cand, k, pos, word, term) and scores(doc_id, class, cand, k, n_docs, score)."""
    return f"""tw AS (SELECT doc_id, class, unnest(words) AS word, unnest(range(len(words))) AS pos FROM test),
terms AS (
  SELECT tw.doc_id, tw.class, h.class AS cand, h.k, h.n_docs, tw.pos, tw.word, {term_expr(mode, zero_fix)} AS term
  FROM tw CROSS JOIN hdr h LEFT JOIN lik l ON l.class = h.class AND l.word = tw.word),
scores AS (
  SELECT doc_id, class, cand, k, n_docs, {fold_expr(mode)} AS score
  FROM terms GROUP BY doc_id, class, cand, k, n_docs)"""


def pred_ctes(reject: float) -> str:
    return f"""best AS (
  SELECT doc_id, class, cand, score,
         row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, k) AS r
  FROM scores),
pred AS (SELECT doc_id, class, CASE WHEN score > {reject!r} THEN cand ELSE '' END AS pred, score FROM best WHERE r = 1)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def nb_predictions(key: str, mode: str, zero_fix, reject, classes=None) -> str:
    return with_(split_ctes(key), model_ctes(classes), score_ctes(mode, zero_fix), pred_ctes(reject))


def confusion_ctes() -> str:
    return """by_true AS (SELECT class, count(*) AS support, sum(CASE WHEN pred = class THEN 1 ELSE 0 END) AS tp
            FROM pred GROUP BY class),
by_pred AS (SELECT pred AS class, count(*) AS fp FROM pred WHERE pred <> class GROUP BY pred),
j AS (SELECT coalesce(t.class, p.class) AS class, t.support, coalesce(t.tp, 0) AS tp, coalesce(p.fp, 0) AS fp
      FROM by_true t FULL OUTER JOIN by_pred p ON t.class = p.class),
conf AS (
  SELECT class, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
         CAST(CASE WHEN support IS NULL THEN 0 ELSE support - tp END AS BIGINT) AS fn,
         CAST(CASE WHEN support IS NULL THEN 0
              ELSE (SELECT count(*) FROM pred) - tp - fp - (support - tp) END AS BIGINT) AS tn,
         CAST(coalesce(support, 0) AS BIGINT) AS support
  FROM j)"""


def report_ctes() -> str:
    return """cr AS (
  SELECT class,
         CASE WHEN tp <> 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision,
         CASE WHEN tp <> 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall,
         support
  FROM conf),
cr2 AS (
  SELECT class, precision, recall, (precision + recall) / 2 AS average,
         CASE WHEN precision + recall <> 0 THEN (2 * precision * recall) / (precision + recall) ELSE 0.0 END AS f1,
         support
  FROM cr),
rep AS (
  SELECT class, precision, recall, average, f1, support, 0 AS row_order FROM cr2
  UNION ALL
  SELECT 'Avg/total', avg(precision), avg(recall), avg(average), avg(f1), CAST(sum(support) AS BIGINT), 1 FROM cr2)"""


def r6(expr: str) -> str:
    return f"round({expr}, {P.DIGITS})"


# ---------------------------------------------------------------- three-class explanation


def pmap_cols(v: str, k: int = 3, prior: bool = False, prefix: str = "p") -> str:
    """Percent-map columns ``p0..`` of a DOUBLE list expression ``v`` (rounded)."""
    s = "33.33::DOUBLE" if k == 3 else f"(99.99::DOUBLE / {k})"
    avg = f"(list_reduce(list_prepend(0.0::DOUBLE, {v}), lambda a, x: a + x) / {k})"
    cols = []
    for i in range(k):
        x = f"{v}[{i + 1}]"
        e = f"({x} * {s}) / {avg}" if prior else f"((2 * {avg}) - {x}) * {s} / {avg}"
        cols.append(f"{r6(e)} AS {prefix}{i}")
    return ", ".join(cols)


def explain_sql(*ctes: str, select: str, zero_fix: float = 1e-8) -> str:
    return with_(split_ctes("lang"), model_ctes(P.CHOSEN), score_ctes("floor", zero_fix), *ctes) + select


# per (doc, pos): the K-vector of terms in candidate order
POS_VEC = "pv AS (SELECT doc_id, class, pos, word, list(term ORDER BY k) AS v FROM terms GROUP BY doc_id, class, pos, word)"
# per doc: the K-vector of totals, ln priors, and full-range sums of terms
DOC_VEC = (
    "dv AS (SELECT doc_id, class, list(score ORDER BY k) AS tot, list(ln(n_docs) ORDER BY k) AS lps FROM scores "
    "GROUP BY doc_id, class)"
)
RANGE_SUMS = (
    "rs0 AS (SELECT doc_id, k, list_reduce(list_prepend(0.0::DOUBLE, list(term ORDER BY pos)), lambda a, x: a + x) AS s "
    "FROM terms GROUP BY doc_id, k),\n"
    "rs AS (SELECT r.doc_id, list(r.s ORDER BY r.k) AS sums FROM rs0 r GROUP BY r.doc_id)"
)


def first_max_case(cols, names, start: str, null_name: str = "NULL") -> tuple[str, str]:
    """SQL for the first largest value above ``start`` (strict ``>``): (value, name)."""
    best = "greatest(" + ", ".join(cols) + ")"
    val = f"CASE WHEN {best} > {start} THEN {best} ELSE {start} END"
    name = f"CASE WHEN {best} <= {start} THEN {null_name} " + " ".join(
        f"WHEN {c} = {best} THEN '{n}'" for c, n in zip(cols, names)
    ) + " END"
    return val, name
