"""Evaluation (M1-M6).

Input: predictions ``(doc_id, class, pred)``. Report rows are the classes that
have test docs plus every predicted class (``''`` when unclassified). TN and FN
only go to classes that have test docs (Q5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

AVG_TOTAL = "Avg/total"


def confusion(pred: DataFrame) -> DataFrame:
    """M1: ``(class, tp, fp, fn, tn, support)`` one-vs-rest, LONGs.

    One pass: every prediction adds a row for its true class (support, tp)
    and, when wrong, one for the predicted class (fp); a single partial +
    final aggregate then gives at most K+1 rows.
    """
    wrong = F.col("pred") != F.col("class")
    hit = F.struct(
        F.col("class").alias("c"),
        F.lit(1).alias("s"),
        (~wrong).cast("long").alias("tp"),
        F.lit(0).cast("long").alias("fp"),
    )
    miss = F.when(
        wrong, F.struct(F.col("pred").alias("c"), F.lit(0).alias("s"), F.lit(0).cast("long").alias("tp"), F.lit(1).cast("long").alias("fp"))
    )
    parts = pred.select(F.explode(F.array(hit, miss)).alias("e")).where(F.col("e").isNotNull()).select("e.*")
    j = parts.groupBy(F.col("c").alias("class")).agg(
        F.sum("s").alias("support"), F.sum("tp").alias("tp"), F.sum("fp").alias("fp")
    )
    # the aggregated table has at most K+1 rows; N over it is one small task
    has_test = F.col("support") > 0
    n_total = F.sum("support").over(Window.partitionBy())
    fn = F.when(has_test, F.col("support") - F.col("tp")).otherwise(F.lit(0))
    return j.select(
        "class",
        F.col("tp").cast("long").alias("tp"),
        F.col("fp").cast("long").alias("fp"),
        fn.cast("long").alias("fn"),
        F.when(has_test, n_total - F.col("tp") - F.col("fp") - fn).otherwise(F.lit(0)).cast("long").alias("tn"),
        F.col("support").cast("long").alias("support"),
    )


def accuracy(pred: DataFrame) -> DataFrame:
    """M2: one row ``(correct, total, accuracy)``; empty test set -> NULL ratio."""
    return pred.agg(
        F.coalesce(F.sum((F.col("pred") == F.col("class")).cast("long")), F.lit(0)).alias("correct"),
        F.count(F.lit(1)).alias("total"),
    ).withColumn("accuracy", F.try_divide(F.col("correct").cast("double"), F.col("total")))


def class_report(conf: DataFrame) -> DataFrame:
    """M3: ``(class, precision, recall, average, f1, support)``; all 0 when TP = 0."""
    tp = F.col("tp").cast("double")
    has = F.col("tp") != 0
    p = F.when(has, tp / (F.col("tp") + F.col("fp"))).otherwise(F.lit(0.0))
    r = F.when(has, tp / (F.col("tp") + F.col("fn"))).otherwise(F.lit(0.0))
    out = conf.select("class", p.alias("precision"), r.alias("recall"), "support")
    f1 = F.when(F.col("precision") + F.col("recall") != 0, (2 * F.col("precision") * F.col("recall")) / (
        F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    return out.select(
        "class", "precision", "recall", ((F.col("precision") + F.col("recall")) / 2).alias("average"),
        f1.alias("f1"), "support",
    )


def round2(x) -> F.Column:
    """A ratio from 0 to 1 rounded to two places by its exact binary value, halves to even, as the report shows it.

    A hundred times ``x * 2**53`` is taken as a whole number that fits a long, the rest below it only breaks a tie.
    """
    scaled = x * F.lit(2.0**53)
    whole = F.floor(scaled)
    below = (scaled - whole.cast("double")) * F.lit(100.0)  # exact: it has few bits
    times = whole * F.lit(100).cast("long") + F.floor(below)
    down, rest = F.shiftright(times, 53), times.bitwiseAND(F.lit((1 << 53) - 1))
    half, over = F.lit(1 << 52), below != F.floor(below).cast("double")
    up = (rest > half) | ((rest == half) & (over | (down % 2 == 1)))
    return (down + F.when(up, 1).otherwise(0)).cast("double") / F.lit(100.0)


def rounded_report(rep: DataFrame) -> DataFrame:
    """M3/M4 as displayed: the report's ratios to two places."""
    return rep.withColumns({c: round2(F.col(c)) for c in ("precision", "recall", "average", "f1")})


def report(conf: DataFrame) -> DataFrame:
    """M3+M4+M5: per-class rows plus ``Avg/total`` (unweighted mean of the unrounded
    per-class values, sum of support). ``row_order`` puts ``Avg/total`` last.

    ``ROLLUP`` over the K per-class rows gives both in one pass: a class group
    holds one row (its mean is the value itself), the grand total averages the
    per-class ratios (not a ratio of sums).
    """
    rows = class_report(conf)
    g = rows.rollup("class").agg(
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("average").alias("average"),
        F.avg("f1").alias("f1"),
        F.sum("support").alias("support"),
        F.grouping("class").alias("row_order"),
    )
    return g.select(
        F.when(F.col("row_order") == 1, F.lit(AVG_TOTAL)).otherwise(F.col("class")).alias("class"),
        "precision", "recall", "average", "f1", F.col("support").cast("long").alias("support"),
        F.col("row_order").cast("int").alias("row_order"),
    )


def weighted_means(rows: DataFrame) -> DataFrame:
    """M6: macro and support-weighted means of a per-class report; one row. The share of right predictions is the
    support-weighted recall, which the library's report shows as accuracy."""
    w = F.col("support").cast("double")
    return rows.agg(
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        F.try_divide(F.sum(F.col("precision") * w), F.sum(w)).alias("weighted_precision"),
        F.try_divide(F.sum(F.col("recall") * w), F.sum(w)).alias("weighted_recall"),
        F.try_divide(F.sum(F.col("f1") * w), F.sum(w)).alias("weighted_f1"),
        F.sum("support").alias("support"),
        F.try_divide(F.sum(F.col("recall") * w), F.sum(w)).alias("accuracy"),
    )
