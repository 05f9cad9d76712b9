"""Licence scan with a positional rare-token index, in DataFrame operations only.

Templates of licence notices are indexed by word and position. For each file, the template words
that it holds are ranked by their inverse document frequency over all documents; the places of the
rarest ones, shifted by their positions in the template, are intersected, and where two rare words
agree on a start, the mandatory key phrase must stand at its place. The score is the
share of the template's words that stand where they should. Plain licence names (base phrases) are
found the same way, from their rarest word, at all their places.

The work is done row by row in array functions, on files that hold all words of a key phrase; the only
shuffle adds up the document frequencies of the few template words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlens.llm.common import id_text

# Base phrases with their labels; notices of common licences with the key phrase that each must hold.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = [
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "permission is hereby granted free of charge",
    ),
    (
        "mit",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        "this permission notice shall be included in all copies",
    ),
    (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
        "you may not use this file except in compliance with the license",
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
        "under the terms of the gnu general public license",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "redistribution and use in source and binary forms",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        "distribute this software for any purpose with or without fee",
    ),
    (
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "subject to the terms of the mozilla public license",
    ),
    ("cc", "licensed under cc by nc 4 0", "licensed under cc by"),
]
#: Rarest words of a template whose places are intersected, and the least share of matching words.
RAREST, MIN_SCORE = 3, 0.6
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _vocabulary() -> list[str]:
    return sorted({w for _, text, _ in TEMPLATES for w in text.split()} | {w for p in PHRASES for w in p.split()})


def _strings(words) -> Column:
    return F.array(*map(F.lit, words))


def _worded(docs: DataFrame) -> DataFrame:
    """``docs`` with the words of the text and the template words among them."""
    words = F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))
    return docs.withColumn("words", words).withColumn("present", F.array_intersect("words", _strings(_vocabulary())))


def rarity(docs: DataFrame) -> dict[str, float]:
    """Inverse document frequency of the template words over all documents."""
    seen = _worded(docs).select(F.explode(F.concat("present", F.array(F.lit("")))).alias("word")).groupBy("word").count()
    count = {r["word"]: r["count"] for r in seen.collect()}
    return {w: math.log((count.get("", 0) + 1) / (count.get(w, 0) + 1)) for w in _vocabulary()}


def _has_all(words) -> Column:
    return F.size(F.array_except(_strings(sorted(set(words))), F.col("present"))) == 0


def _stands(words: list[str], start: Column) -> Column:
    """The words stand at ``start``, one after the other."""
    here = F.lit(True)
    for j, w in enumerate(words):
        here = here & F.coalesce(F.get("words", start + j) == w, F.lit(False))
    return here


def _places(phrase: str, idf: dict[str, float]) -> Column:
    """All places of a phrase, from the places of its rarest word."""
    words = phrase.split()
    at = max(range(len(words)), key=lambda j: (idf[words[j]], -j))

    def place(w, i):
        return F.when((w == words[at]) & _stands(words, i - at), i - at)

    found = F.filter(F.transform("words", place), lambda p: p.isNotNull())
    return F.when(_has_all(words), found).otherwise(F.array().cast("array<int>"))


def _starts(word: Column, text: list[str]) -> Column:
    """Where the template would start, for each place of the word in the file and in the template."""
    at = F.create_map(*[x for w in sorted(set(text)) for x in (F.lit(w), F.array(*[F.lit(j) for j, v in enumerate(text) if v == w]))])
    positions = F.coalesce(F.try_element_at(at, word), F.array().cast("array<int>"))

    def shifted(w, i):
        return F.when(w == word, F.transform(positions, lambda t: i - t))

    return F.flatten(F.filter(F.transform("words", shifted), lambda s: s.isNotNull()))


def _template_score(text: str, key: str, idf: dict[str, float]) -> Column:
    """The best share of the template's words in place among its verified alignments, 0 without any."""
    words, phrase = text.split(), key.split()
    shift = next(j for j in range(len(words)) if words[j : j + len(phrase)] == phrase)
    ranked = sorted(set(words), key=lambda w: (-idf[w], w))
    rarest = F.slice(F.filter(_strings(ranked), lambda w: F.array_contains("present", w)), 1, RAREST)
    starts = F.transform(rarest, lambda w: _starts(w, words))
    # two of the rarest words agree on the start
    agreed = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.lit(RAREST - 1)), lambda d: F.flatten(F.transform(starts, lambda s, i: F.array_intersect(s, F.coalesce(F.get(starts, i + d), F.array().cast("array<int>"))))))))
    verified = F.filter(agreed, lambda s: _stands(phrase, s + shift))
    template = _strings(words)

    def share(s):
        same = F.aggregate(F.sequence(F.lit(0), F.lit(len(words) - 1)), F.lit(0), lambda n, j: n + F.coalesce((F.get("words", s + j) == F.get(template, j)).cast("int"), F.lit(0)))
        return same / F.lit(len(words))

    return F.when(_has_all(phrase), F.coalesce(F.array_max(F.transform(verified, share)), F.lit(0.0))).otherwise(0.0)


def licenses(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row of ``docs``: doc_id, n_words, n_base (places of base phrases), first_word and
    last_word (their smallest and largest start, null without any), base_labels and labels (sorted
    arrays; labels has the templates' too) and score (1 with a base phrase, else the best template's
    share of words in place, 0 without a label).

    Null and empty texts have no words and no labels. Repeated rows and ids stay one row each. Only
    the id and text columns are read. An empty table gives no rows.
    """
    docs = id_text(docs, id_col, text_col)
    idf = rarity(docs)
    labels = list(dict.fromkeys(label for label, _, _ in TEMPLATES))
    found = _worded(docs)
    phrases = {p: f"p_{i}" for i, p in enumerate(PHRASES)}
    found = found.withColumns({c: _places(p, idf) for p, c in phrases.items()})
    found = found.withColumns({f"t_{i}": _template_score(text, key, idf) for i, (_, text, key) in enumerate(TEMPLATES)})
    score = {label: F.greatest(F.lit(0.0), *[F.col(f"t_{i}") for i, t in enumerate(TEMPLATES) if t[0] == label], F.lit(0.0)) for label in labels}
    starts = F.concat(*phrases.values())
    base = F.array_compact(F.array(*[F.when(F.size(c) > 0, F.lit(PHRASES[p])) for p, c in phrases.items()]))
    more = F.array_compact(F.array(*[F.when(score[x] >= MIN_SCORE, F.lit(x)) for x in labels]))
    best = F.greatest(*score.values())
    return found.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(base)).alias("base_labels"),
        F.array_sort(F.array_distinct(F.concat(base, more))).alias("labels"),
        F.when(F.size(base) > 0, 1.0).when(best >= MIN_SCORE, best).otherwise(0.0).alias("score"),
    )
