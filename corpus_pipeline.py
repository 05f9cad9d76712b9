"""Five stages from raw documents to a training mixture; each works on all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of the documents. ``run`` applies them to the table ``documents``, each written as Parquet to the
shared folder and read back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from textlens.llm.common import table, written
from textlens.llm.decontaminate import decontaminated
from textlens.llm.language_id import UNDETERMINED, identify, train, training_windows
from textlens.llm.mixing import mixture
from textlens.llm.ngram_join import one_of_each
from textlens.llm.pii import redacted
from textlens.llm.queries import MIX, label_domain

#: Documents whose language has a lower mean probability are rejected, as are those without letters.
MIN_SCORE = 0.3


def language_id(spark, docs, sf_dir):
    """Documents in a language that the network knows, by their text alone; it learns from all
    documents that name theirs. Null texts and texts without letters go. If nothing can be
    learned, nothing is known, and all go."""
    net = train(training_windows(docs, F.col("lang"), F.lit(True)))
    return identify(spark, docs, net, keep=lambda label, score: label != UNDETERMINED and score >= MIN_SCORE)


def ngram_jaccard_join(spark, docs, sf_dir):
    """One document of each group of near duplicates: the one with the smallest id."""
    return one_of_each(spark, docs)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents without a ten-word window of the table ``benchmark``."""
    return decontaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark, docs, sf_dir):
    """All documents, their personal data replaced by its kind in brackets."""
    return redacted(spark, docs)


def mixing(spark, docs, sf_dir):
    """doc_id, n_tokens, domain, probability and rate of every document: how often to draw it so that
    the domains of the table ``labels`` get their shares of the tokens, and toxic text none."""
    return mixture(spark, docs, table(spark, sf_dir, "labels"), label_domain(), MIX)


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("mixing", mixing),
]

#: SQL cannot train or apply the network and the classifier; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
