"""End-to-end plans: corpus -> split -> tokens -> model -> scores -> report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlens.operators import evaluate as ev
from textlens.operators.model import Model, test_token_lists, tokenize, train
from textlens.operators.sampling import split_in_place
from textlens.operators.scoring import DEFAULT_REJECT, FIXED_FLOOR, FLOOR, score
from textlens.operators.sums import score_sums
from textlens.session import saved


@dataclass
class Run:
    model: Model
    test: DataFrame  # (doc_id, class, words, ..)
    scorer: Callable[[], DataFrame]
    header: list

    @cached_property
    def scored(self) -> DataFrame:
        """The test documents with scores and prediction; planned when first asked for."""
        return self.scorer()

    def release(self) -> None:
        """Drop the model's tables, where a caller has cached them."""
        self.model.unpersist()

    def predictions(self) -> DataFrame:
        return self.scored.select("doc_id", "class", "pred")

    def confusion(self) -> DataFrame:
        return ev.confusion(self.predictions())

    def report(self) -> DataFrame:
        return ev.report(self.confusion())

    def accuracy(self) -> DataFrame:
        return ev.accuracy(self.predictions())


def prepare(
    corpus: DataFrame,
    pick_pct: int = 100,
    ratio: int = 75,
    balanced: bool = False,
    shuffle_seed: int | None = None,
    stopwords=None,
    order_cols=("doc_id",),
) -> DataFrame:
    """Sample + split (P2-P6) then tokenise (T1-T5, T9): ``(doc_id, class, split, words, ..)``."""
    split = split_in_place(spread(corpus), pick_pct, ratio, balanced, shuffle_seed, order_cols)
    return tokenize(split.select("doc_id", "class", "split", "text"), stopwords).drop("text")


#: A corpus of less text than this for each core is dealt over the cores.
SMALL_BYTES = 32 << 20


def spread(corpus: DataFrame) -> DataFrame:
    """A small corpus (by the optimizer's estimate) over all cores; a large one as its files lie."""
    cores = corpus.sparkSession.sparkContext.defaultParallelism
    size = int(corpus._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return corpus.repartition(cores, "class", "doc_id") if size < cores * SMALL_BYTES else corpus


def classify(
    corpus: DataFrame,
    mode: str = FLOOR,
    zero_fix: float = FIXED_FLOOR,
    reject: float = DEFAULT_REJECT,
    classes=None,
    pick_pct: int = 100,
    ratio: int = 75,
    balanced: bool = False,
    shuffle_seed: int | None = None,
    stopwords=None,
    order_cols=("doc_id",),
    ordered: bool = False,
) -> Run:
    """Train on the train split and score the test split.

    With ``classes`` the model and the test set are restricted to those
    classes, in that order (P9, as the web app does before scoring).
    Scores are order-free sums (``sums.score_sums``); ``ordered=True`` folds each
    document's words in their order instead (``scoring.score``).
    """
    docs = prepare(corpus, pick_pct, ratio, balanced, shuffle_seed, stopwords, order_cols)
    if classes is not None:
        docs = docs.where(F.col("class").isin(list(classes)))
    # the split and tokenised corpus feeds both training and the test set, and every later step the model: they are written
    # once and read as needed, as executors that kept them would fill their memory with the corpus
    docs = saved(docs, "docs")
    trained = train(docs)
    model = Model(saved(trained.priors, "priors"), saved(trained.likelihood, "likelihood"))
    return classify_with(model, test_token_lists(docs), mode, zero_fix, reject, classes, ordered)


def classify_with(
    model: Model, test: DataFrame, mode=FLOOR, zero_fix=FIXED_FLOOR, reject=DEFAULT_REJECT, classes=None, ordered=False
) -> Run:
    """Score an existing test set against an existing model."""
    header = model.header(classes)
    how = score if ordered else score_sums
    return Run(model, test, lambda: how(test, model, mode=mode, zero_fix=zero_fix, reject=reject, header=header), header)
