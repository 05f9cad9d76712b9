"""Plan shape: no cross products, pruned scans, no whole-class windows."""

import pytest

from paths import SF001
from textlens.plans import queries as Q


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["nb_report", "nb_product", "word_trace", "running_score", "word_uniqueness", "top_words", "learning_curve"]
)
def test_no_cross_products(spark, name):
    p = _plan(Q.QUERIES[name](spark, SF001))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_scan_reads_only_needed_columns(spark):
    p = _plan(Q.QUERIES["nb_report"](spark, SF001))
    scans = [line for line in p.splitlines() if "FileScan parquet" in line]
    assert scans
    for line in scans:
        assert "n_chars" not in line and "lang" not in line  # class = source: lang and n_chars are never read


def test_split_has_no_window_over_a_whole_class(spark):
    from textlens.operators.sampling import split_by_ratio
    from textlens.sources.corpus import documents_corpus

    p = _plan(split_by_ratio(documents_corpus(spark, SF001, "source")))
    # every window over the corpus rows is partitioned by (class, bucket), never by class alone
    for line in p.splitlines():
        if "Window [row_number()" in line:
            assert "_b" in line


def test_learning_curve_reaches_the_last_line(spark):
    """More lines than the 1,001 of the original's sizes: every line after the train share is tested."""
    from textlens.plans.experiments import learning_curve

    rows = [("labels", i, f"{'good fine' if i % 2 else 'bad poor'} word\t{i % 2}") for i in range(1200)]
    lines = spark.createDataFrame(rows, "source string, line_no long, line string")
    got = {(r["size"], r["stop_words"]): (r["correct"], r["total"]) for r in learning_curve(lines).collect()}
    assert {s for s, _ in got} == {30 * j for j in range(1, 41)} and len(got) == 80
    assert all(got[s, m][1] == s - s * 24 // 100 for s, m in got)
    assert got[1200, False] == (912, 912)
    assert learning_curve(lines.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["nb_report", "sample_axis_min", "repeat_mean"])
def test_executors_keep_no_corpus(spark, name):
    kept = set(spark.sparkContext._jsc.getPersistentRDDs().keys())
    assert Q.QUERIES[name](spark, SF001).count()
    assert set(spark.sparkContext._jsc.getPersistentRDDs().keys()) <= kept


def test_batches_are_small(spark):
    """A task holds several times a batch, of words and of numbers."""
    from textlens.operators import sums
    from textlens.session import BATCH_BYTES

    assert BATCH_BYTES <= 4 << 20 and 8 * sums.AT_ONCE <= 4 << 20
