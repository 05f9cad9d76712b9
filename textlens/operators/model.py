"""Tokenised docs, training counts and model tables.

A model is two long tables, never map columns:
``priors(class, n_docs)`` and ``likelihood(class, word, cnt)``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlens.functions.stopwords import stopwords_df
from textlens.functions.text import clean_words, resolve_stopwords
from textlens.operators.sampling import TEST, TRAIN
from textlens.session import small_batches


def tokenize(df: DataFrame, stopwords=None, text_col: str = "text", drop_digit_labels: bool = False) -> DataFrame:
    """Adds ``words ARRAY<STRING>``: the ordered kept tokens."""
    return df.withColumn(
        "words", clean_words(F.col(text_col), resolve_stopwords(stopwords), drop_digit_labels=drop_digit_labels)
    )


def explode_tokens(docs: DataFrame, *keep) -> DataFrame:
    """``(..keep, pos, word)`` long form of ``words``; ``pos`` is 0-based over kept tokens."""
    return docs.select(*keep, F.posexplode("words").alias("pos", "word"))


def word_frequencies(docs: DataFrame) -> DataFrame:
    """``docs`` (.., words) as ``(.., word, count)``: the distinct words of each row, counted where the row lies: no token
    is shuffled, and a task holds a batch of rows."""
    others = len(docs.columns) - 1
    schema = T.StructType([*docs.drop("words").schema.fields, T.StructField("word", T.StringType()), T.StructField("count", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(others)
            n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            words = lists.flatten().dictionary_encode(null_encoding="encode")
            width = max(1, len(words.dictionary))
            key = np.repeat(np.arange(len(n)), n) * width + words.indices.to_numpy(zero_copy_only=False)
            found, times = np.unique(key, return_counts=True)
            row = pa.array(found // width)
            yield pa.RecordBatch.from_arrays([*[c.take(row) for c in b.columns[:others]], words.dictionary.take(pa.array(found % width)), pa.array(times.astype(np.int64))], names=schema.names)

    small_batches(docs.sparkSession)
    return docs.select(*[c for c in docs.columns if c != "words"], "words").mapInArrow(count, schema)


def test_token_lists(split_docs: DataFrame) -> DataFrame:
    """Test docs with their ordered words; a doc with no kept word does not exist (Q6)."""
    return split_docs.where((F.col("split") == TEST) & (F.size("words") > 0))


@dataclass
class Model:
    """Multinomial NB count tables."""

    priors: DataFrame  # (class, n_docs)
    likelihood: DataFrame  # (class, word, cnt)

    def totals(self) -> DataFrame:
        """``(class, n_words)`` = Σ cnt per class."""
        return self.likelihood.groupBy("class").agg(F.sum("cnt").alias("n_words"))

    def persist(self) -> "Model":
        """Cache both tables (memory, then disk). The model is sized by vocabulary x
        classes, not by documents, and is read by the class header and by scoring."""
        from pyspark import StorageLevel

        return Model(self.priors.persist(StorageLevel.MEMORY_AND_DISK), self.likelihood.persist(StorageLevel.MEMORY_AND_DISK))

    def unpersist(self) -> None:
        self.priors.unpersist()
        self.likelihood.unpersist()

    def restrict(self, classes) -> "Model":
        """P9 on the model tables."""
        cl = list(classes)
        return Model(self.priors.where(F.col("class").isin(cl)), self.likelihood.where(F.col("class").isin(cl)))

    def header(self, classes=None):
        """Candidate classes in class order with ``(class, n_docs, n_words)``.

        Candidates are the classes that have counted words, as in the original
        (a class whose train docs kept no word is never scored). This is a
        K-row, per-class table taken to the driver the way ``pivot`` and
        ``StringIndexer`` take their labels; it never grows with documents.
        Order is ``classes`` when given (the user's selection order), else
        alphabetical.
        """
        t = self.totals()
        if classes is not None:
            t = t.where(F.col("class").isin(list(classes)))
        rows = t.join(self.priors, "class", "left").select("class", "n_docs", "n_words").collect()
        by_class = {r["class"]: r for r in rows}
        order = [c for c in classes if c in by_class] if classes is not None else sorted(by_class)
        out = []
        for c in order:
            r = by_class[c]
            if r["n_docs"] is None or r["n_docs"] == 0:
                raise ValueError(f"class {c!r} has words but no train documents (log of 0 prior)")
            out.append((c, int(r["n_docs"]), int(r["n_words"])))
        return out


def train(split_docs: DataFrame) -> Model:
    """G1+G2: priors from train *documents* (before token filters, Q6),
    likelihood from their kept tokens (partial + final hash aggregate)."""
    tr = split_docs.where(F.col("split") == TRAIN)
    priors = tr.groupBy("class").agg(F.count(F.lit(1)).alias("n_docs"))
    likelihood = (
        tr.select("class", F.explode("words").alias("word")).groupBy("class", "word").agg(F.count(F.lit(1)).alias("cnt"))
    )
    return Model(priors, likelihood)


def class_profile(model: Model) -> DataFrame:
    """G4+G6: ``(class, n_docs, n_words, avg_words)`` with ``avg_words = n_words / n_docs``."""
    return (
        model.priors.join(model.totals(), "class", "full_outer")
        .withColumn("avg_words", F.try_divide(F.col("n_words").cast("double"), F.col("n_docs")))
        .select("class", "n_docs", "n_words", "avg_words")
    )


def merge_models(first: Model, second: Model) -> Model:
    """Union of classes; on a shared class the second model wins whole (per table)."""

    def merge(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.join(b.select("class").distinct(), "class", "left_anti").unionByName(b)

    return Model(merge(first.priors, second.priors), merge(first.likelihood, second.likelihood))


def drop_stopwords(df: DataFrame, stopwords=True) -> DataFrame:
    """Remove stop words from a ``(.., word, ..)`` table with a broadcast anti join (136 rows)."""
    words = resolve_stopwords(stopwords)
    if not words:
        return df
    sw = stopwords_df(df.sparkSession) if stopwords is True else df.sparkSession.createDataFrame(
        [(w,) for w in words], "word string"
    )
    return df.join(F.broadcast(sw), "word", "left_anti")
