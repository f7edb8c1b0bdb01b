"""Classifier evaluation with exact rank statistics.

ROC AUC is computed exactly as U / (n1·n0) from the Mann-Whitney U of the
scores (MLlib's BinaryClassificationMetrics bins scores by default).  U
needs, for every distinct score, the number of negatives with a lower
score: scores are grouped, range-partitioned, summed per partition (one row
per partition reaches the driver) and the prefix is finished locally.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def prefix_sums(df: DataFrame, order_col: str, cols: list[str], suffix: str = "_below") -> DataFrame:
    """For each row: Σ of ``cols`` over rows with a strictly smaller
    ``order_col`` (``order_col`` unique).  No unpartitioned window."""
    ranged = df.repartitionByRange(order_col).withColumn("_pid", F.spark_partition_id())
    from tenure.operators.sampling import _checkpoint

    ranged = _checkpoint(ranged)
    totals = ranged.groupBy("_pid").agg(*[F.sum(c).alias(c) for c in cols]).collect()
    offsets, acc = [], [0.0] * len(cols)
    for r in sorted(totals, key=lambda r: r["_pid"]):
        offsets.append((r["_pid"], *acc))
        acc = [a + float(r[c] or 0) for a, c in zip(acc, cols)]
    kinds = ", ".join(["_pid int", *[f"_off{i} double" for i in range(len(cols))]])
    offset_rows = df.sparkSession.createDataFrame(offsets, kinds)  # one row a partition
    w = Window.partitionBy("_pid").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(offset_rows, "_pid")
    for i, c in enumerate(cols):
        out = out.withColumn(c + suffix, F.coalesce(F.sum(c).over(w), F.lit(0)).cast("double") + F.col(f"_off{i}")).drop(f"_off{i}")
    return out.drop("_pid")


def rank_statistics(scored: DataFrame, label: str, score: str) -> DataFrame:
    """One row: n1, n0, U (positives vs negatives, ties 0.5), AUC, tie term
    Σ(t³-t), z of the one-sided ('greater') normal approximation with
    continuity and tie correction."""
    by_score = scored.groupBy(F.col(score).alias("_s")).agg(
        F.sum((F.col(label) == 1).cast("long")).cast("double").alias("n1"),
        F.sum((F.col(label) == 0).cast("long")).cast("double").alias("n0"),
    )
    pref = prefix_sums(by_score, "_s", ["n0"])
    t = F.col("n1") + F.col("n0")
    agg = pref.agg(
        F.sum("n1").alias("n1"),
        F.sum("n0").alias("n0"),
        F.sum(F.col("n1") * (F.col("n0_below") + F.lit(0.5) * F.col("n0"))).alias("u_statistic"),
        F.sum(t * t * t - t).alias("tie_term"),
    )
    n = F.col("n1") + F.col("n0")
    ties = F.coalesce(F.try_divide(F.col("tie_term"), n * (n - 1)), F.lit(0.0))
    sigma = F.sqrt(F.col("n1") * F.col("n0") / F.lit(12.0) * ((n + 1) - ties))
    # one class only: AUC and the test are undefined -> NULL, not an error
    return agg.select(
        F.col("n1").cast("long").alias("n_positive"),
        F.col("n0").cast("long").alias("n_negative"),
        "u_statistic",
        F.try_divide(F.col("u_statistic"), F.col("n1") * F.col("n0")).alias("roc_auc"),
        F.try_divide(F.col("u_statistic") - F.col("n1") * F.col("n0") / F.lit(2.0) - F.lit(0.5), sigma).alias("mannwhitney_z"),
    )


def confusion_counts(scored: DataFrame, label: str, pred: str) -> DataFrame:
    """One row: tn, fp, fn, tp."""
    y, p = F.col(label), F.col(pred)
    return scored.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def _div(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def classification_report(counts: DataFrame) -> DataFrame:
    """Per-class precision / recall / f1 / support, accuracy, macro and
    weighted averages from one confusion row (zero division -> 0)."""
    tn, fp, fn, tp = F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    f0 = _div(2 * p0 * r0, p0 + r0)
    f1 = _div(2 * p1 * r1, p1 + r1)
    s0, s1 = tn + fp, fn + tp
    n = s0 + s1
    return counts.select(
        "tn", "fp", "fn", "tp",
        _div(tn + tp, n).alias("accuracy"),
        p0.alias("precision_0"), r0.alias("recall_0"), f0.alias("f1_0"), s0.alias("support_0"),
        p1.alias("precision_1"), r1.alias("recall_1"), f1.alias("f1_1"), s1.alias("support_1"),
        ((p0 + p1) / 2).alias("macro_precision"), ((r0 + r1) / 2).alias("macro_recall"), ((f0 + f1) / 2).alias("macro_f1"),
        _div(p0 * s0 + p1 * s1, n).alias("weighted_precision"),
        _div(r0 * s0 + r1 * s1, n).alias("weighted_recall"),
        _div(f0 * s0 + f1 * s1, n).alias("weighted_f1"),
    )


def evaluate_classifier(scored: DataFrame, label: str, prob: str, pred: str) -> DataFrame:
    """One row: confusion, report, AUC, U, z, mean probability by class.  The
    scores are made once, not for each of the three."""
    from tenure.operators.sampling import _saved

    scored = scored.select(F.col(label).cast("int").alias(label), F.col(prob).cast("double").alias(prob), F.col(pred).cast("int").alias(pred))
    scored = _saved(scored, "scored")
    report = classification_report(confusion_counts(scored, label, pred))
    ranks = rank_statistics(scored, label, prob)
    means = scored.agg(
        F.avg(F.when(F.col(label) == 1, F.col(prob))).alias("mean_predicted_probability_survivors"),
        F.avg(F.when(F.col(label) == 0, F.col(prob))).alias("mean_predicted_probability_nonsurvivors"),
    )
    # three one-row frames, joined on a constant key
    one = [F.lit(1).alias("_k")]
    return (
        report.select("*", *one)
        .join(ranks.select("*", *one), "_k")
        .join(means.select("*", *one), "_k")
        .drop("_k")
    )


def mannwhitney_p(z: float) -> float:
    """One-sided p-value (upper tail) of a standard normal z."""
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def class_metrics(counts: DataFrame) -> DataFrame:
    """Per class: 'accuracy' (precision of the class) and recall, two rows."""
    tn, fp, fn, tp = F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")
    rows = F.array(
        F.struct(F.lit(0).alias("class_label"), F.try_divide(tn.cast("double"), (tn + fn).cast("double")).alias("accuracy"),
                 F.try_divide(tn.cast("double"), (tn + fp).cast("double")).alias("recall")),
        F.struct(F.lit(1).alias("class_label"), F.try_divide(tp.cast("double"), (tp + fp).cast("double")).alias("accuracy"),
                 F.try_divide(tp.cast("double"), (tp + fn).cast("double")).alias("recall")),
    )
    return counts.select(F.explode(rows).alias("r")).select("r.*")
