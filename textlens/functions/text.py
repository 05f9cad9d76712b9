"""Column-level text functions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside the JVM (no Python UDF). Tokens are kept as ``ARRAY<STRING>`` per
document: positions are array indices, so token filters never need a shuffle
or a window.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from textlens.functions.stopwords import STOP_WORDS

# Python's ``str.split()`` splits on these 29 code points (BMP whitespace).
# Java and DuckDB ``\s`` differ from it and from each other, so the class is
# spelled out. Java-regex form for Spark:
WHITESPACE_JAVA = (
    "[\\t-\\r\\x1c-\\x1f \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+"
)
# The same class in RE2 syntax (DuckDB), used by the SQL oracles.
WHITESPACE_RE2 = (
    "[\\t-\\r\\x1c-\\x1f \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}"
    "\\x{202f}\\x{205f}\\x{3000}]+"
)
# The 32 ASCII punctuation characters that are deleted from every token.
PUNCTUATION = string.punctuation
# The same 29 whitespace code points as a plain string (for ``translate``).
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_ws(text) -> Column:
    """Whitespace split. May hold empty strings at the edges; ``clean_words`` drops them."""
    return F.split(_c(text), WHITESPACE_JAVA)


def strip_punct(col) -> Column:
    """Delete ASCII punctuation (``well-known`` -> ``wellknown``)."""
    return F.translate(_c(col), PUNCTUATION, "")


def clean_words(text, stopwords=None, drop_digit_labels: bool = False) -> Column:
    """T1+T2+T3+T4+T5(+T6): the ordered kept tokens of a text as ``ARRAY<STRING>``.

    Per token: strip punctuation, lower-case, drop empties, drop stop words.
    Deleting punctuation and lower-casing never adds or removes whitespace, so
    both are applied to the whole text before the split: the tokens are the
    same and every step is a code-generated expression. ``drop_digit_labels``
    also drops every ``'0'``/``'1'`` token (line reader). Array index = the
    kept-token position (T9), so no window is needed.
    """
    # one translate maps every whitespace code point to ' ' and deletes punctuation;
    # splitting on one literal space then uses Java's non-regex fast path
    norm = F.translate(_c(text), WHITESPACE_CHARS + PUNCTUATION, " " * len(WHITESPACE_CHARS))
    words = F.array_remove(F.split(F.lower(norm), " "), "")
    if drop_digit_labels:
        words = F.array_remove(F.array_remove(words, "0"), "1")
    stop = list(stopwords or [])
    if stop:
        words = F.filter(words, lambda w: ~w.isin(stop))  # a hash set, not a scan per token
    return words


def resolve_stopwords(stopwords):
    """``True`` -> the fixed English list, falsy -> none, else the given words."""
    if stopwords is True:
        return list(STOP_WORDS)
    if not stopwords:
        return []
    return list(stopwords)


def word_slice(words, start, end) -> Column:
    """Words ``[start, end)`` of an array (0-based, end exclusive)."""
    start_c = F.lit(start) if isinstance(start, int) else _c(start)
    end_c = F.lit(end) if isinstance(end, int) else _c(end)
    length = F.greatest(end_c - start_c, F.lit(0))
    return F.slice(_c(words), start_c + 1, length)


def rebuild_text(words) -> Column:
    """Each word followed by one space; empty list -> ``''``."""
    w = _c(words)
    return F.when(F.size(w) == 0, F.lit("")).otherwise(F.concat(F.array_join(w, " "), F.lit(" ")))


def sample_label(sample_id, n_words) -> Column:
    """``"<id>, words: <n>"`` hover label of a sample."""
    return F.concat(_c(sample_id).cast("string"), F.lit(", words: "), _c(n_words).cast("string"))


def numbered_word(pos1, word) -> Column:
    """``"<k>. <word>"`` (``pos1`` is 1-based)."""
    return F.concat(_c(pos1).cast("string"), F.lit(". "), _c(word))


def word_with_count(word, count) -> Column:
    """``"<word>(<count>)"``."""
    return F.concat(_c(word), F.lit("("), _c(count).cast("string"), F.lit(")"))


def sample_id_from_label(label) -> Column:
    """First run of digits in a label (``''`` when there is none)."""
    return F.regexp_extract(_c(label), r"(\d+)", 1)


def zero_fix_value(exponent) -> Column:
    """The floor ``1 / 10**v`` for a slider value ``v``."""
    return F.lit(1.0) / F.pow(F.lit(10.0), _c(exponent))


def zero_fix_text(exponent) -> Column:
    """``"Value: 1 / <round(10**v)>"``."""
    return F.concat(F.lit("Value: 1 / "), F.round(F.pow(F.lit(10.0), _c(exponent))).cast("long").cast("string"))


def accuracy_text(correct, total) -> Column:
    """``"c correct classifications out of t samples\\nAccuracy: r"`` (r rounded to 3)."""
    ratio = F.round(F.try_divide(_c(correct).cast("double"), _c(total)), 3)
    return F.concat(
        _c(correct).cast("string"), F.lit(" correct classifications out of "), _c(total).cast("string"),
        F.lit(" samples\nAccuracy: "), ratio.cast("string"),
    )


def class_prefix(source) -> Column:
    """Class-name prefix for a labelled-line file; unknown files get ``''``."""
    s = _c(source)
    return (
        F.when(s == "yelp_labelled.txt", F.lit("revs-yelp "))
        .when(s == "imdb_labelled.txt", F.lit("revs-imdb "))
        .when(s == "amazon_cells_labelled.txt", F.lit("revs-amazon "))
        .otherwise(F.lit(""))
    )
