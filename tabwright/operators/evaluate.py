"""Held-out statistics from a predictions table.

A predictions table has ``y`` and ``yhat`` (codes) and, for curves, ``proba`` (one
probability per label).  ``by`` columns evaluate several models in the same query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.operators.ranking import range_buckets, running_totals

LOG_EPS = 1e-15
COUNT_METRICS = [
    "accuracy", "balanced_accuracy", "f1_macro", "f1_micro", "precision_macro", "precision_micro",
    "recall_macro", "recall_micro",
]


def ratio(top: Column, bottom: Column) -> Column:
    """NULL instead of a division by zero."""
    return top / F.nullif(bottom, F.lit(0))


def accuracy(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A14."""
    return predictions.groupBy(*by).agg(F.avg((F.col("y") == F.col("yhat")).cast("int")).alias("accuracy"))


def confusion_counts(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per (true, predicted) pair met; everything count-based starts here."""
    return predictions.groupBy(*by, "y", "yhat").agg(F.count("*").alias("cnt"))


def label_counts(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn and support per label, from the pairs by a two-way explode."""
    hit = F.col("y") == F.col("yhat")
    sides = F.array(
        F.struct(
            F.col("y").alias("label"),
            F.when(hit, F.col("cnt")).otherwise(F.lit(0)).alias("tp"),
            F.lit(0).cast("bigint").alias("fp"),
            F.when(~hit, F.col("cnt")).otherwise(F.lit(0)).alias("fn"),
        ),
        F.struct(
            F.col("yhat").alias("label"),
            F.lit(0).cast("bigint").alias("tp"),
            F.when(~hit, F.col("cnt")).otherwise(F.lit(0)).alias("fp"),
            F.lit(0).cast("bigint").alias("fn"),
        ),
    )
    long = confusion.select(*by, F.inline(sides))
    return long.groupBy(*by, "label").agg(
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"),
        (F.sum("tp") + F.sum("fn")).alias("support"),
    )


def precision_recall(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One value per label, zero where nothing was predicted or nothing is true."""
    return with_precision_recall(label_counts(confusion_counts(predictions, by), by))


def with_precision_recall(counts: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    zero = F.lit(0.0)
    return counts.withColumns(
        {
            "precision": F.coalesce(ratio(tp, tp + fp), zero),
            "recall": F.coalesce(ratio(tp, tp + fn), zero),
            "f1": F.coalesce(ratio(2 * tp, 2 * tp + fp + fn), zero),
        }
    )


def confusion_normalized(predictions: DataFrame, n_labels: int, by: Sequence[str] = ()) -> DataFrame:
    """Full label grid, every true-label row divided by its sum."""
    counted = confusion_counts(predictions, by)
    rows = counted.groupBy(*by, "y").agg(
        F.map_from_entries(F.collect_list(F.struct("yhat", "cnt"))).alias("cells"), F.sum("cnt").alias("total")
    )
    grid = F.sequence(F.lit(0), F.lit(n_labels - 1))
    present = rows.select(*by, "y", "total", "cells", F.explode(grid).alias("yhat")).select(
        *by, "y", "yhat",
        (F.coalesce(F.try_element_at("cells", F.col("yhat")), F.lit(0)) / F.col("total")).alias("share"),
    )
    if by:
        every = counted.select(*by).distinct()
    else:
        every = counted.sparkSession.range(1).select()
    full = every.select(*by, F.explode(grid).alias("y")).select(*by, "y", F.explode(grid).alias("yhat"))
    return full.join(present, [*by, "y", "yhat"], "left").withColumn("share", F.coalesce("share", F.lit(0.0)))


def one_vs_rest(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per label the score and whether the row truly has that label."""
    return predictions.select(*by, "y", F.posexplode("proba").alias("label", "score")).select(
        *by, "label", "score", (F.col("y") == F.col("label")).cast("bigint").alias("pos")
    )


def curve_counts(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Positives and negatives per distinct score with running totals by falling score.

    Columns: keys, score, pos, neg, tp, fp (inclusive), all_pos, all_neg and the counts of
    the next step.  Any number of curves: they lie one after the other in the range partitions.
    """
    steps = scored.groupBy(*keys, "score").agg(
        F.sum("pos").alias("pos"), (F.count("*") - F.sum("pos")).alias("neg")
    ).withColumn("falling", -F.col("score"))
    cut = range_buckets(steps, list(keys), ["falling"])
    return running_totals(
        cut, list(keys), ["falling"], {"tp": "pos", "fp": "neg"}, {"next_pos": "pos", "next_neg": "neg"},
        {"all_pos": "tp", "all_neg": "fp"},
    ).drop("bucket", "falling")


def roc_points(scored: DataFrame, keys: Sequence[str] = ("label",)) -> DataFrame:
    """(threshold, fpr, tpr) with evenly repeated steps left out, plus the origin.

    The origin has a NULL threshold.  A class without positives or negatives has NULL rates.
    """
    steps = curve_counts(scored, keys)
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    last = F.col("next_pos").isNull()
    bend = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    point = F.struct(
        F.col("score").alias("threshold"),
        ratio(F.col("fp"), F.col("all_neg")).alias("fpr"),
        ratio(F.col("tp"), F.col("all_pos")).alias("tpr"),
    )
    origin = F.struct(
        F.lit(None).cast("double").alias("threshold"),
        ratio(F.lit(0), F.col("all_neg")).alias("fpr"),
        ratio(F.lit(0), F.col("all_pos")).alias("tpr"),
    )
    # The first step of every curve brings the origin along.
    kept = F.when(first, F.array(origin, point)).when(last | bend, F.array(point))
    return steps.select(*keys, F.inline(kept))


def curve_metrics(scored: DataFrame, keys: Sequence[str] = ("label",)) -> DataFrame:
    """A17, M1.8: ``auc`` and ``average_precision`` of every curve from one table of counts.

    Each score step is one trapezoid under the ROC curve and one step of recall.
    """
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    steps = F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp")))
    return curve_counts(scored, keys).groupBy(*keys).agg(
        ratio(area, F.sum("pos") * F.sum("neg")).alias("auc"),
        ratio(steps, F.sum("pos")).alias("average_precision"),
    )


def roc_auc(scored: DataFrame, keys: Sequence[str] = ("label",)) -> DataFrame:
    """Area under the ROC curve."""
    return curve_metrics(scored, keys).drop("average_precision")


def average_precision(scored: DataFrame, keys: Sequence[str] = ("label",)) -> DataFrame:
    """M1.8: precision summed over recall steps."""
    return curve_metrics(scored, keys).drop("auc")


def curve_area(points: DataFrame, keys: Sequence[str] = ("label",)) -> DataFrame:
    """Trapezoid area under stored curve points, in range partitions like any other large group."""
    known = points.where(F.col("fpr").isNotNull() & F.col("tpr").isNotNull()).select(*keys, "fpr", "tpr")
    spot = known.groupBy(*keys, "fpr", "tpr").agg(F.count("*").alias("same"))
    cut = range_buckets(spot.withColumn("along", F.col("fpr") + F.col("tpr")), list(keys), ["along", "fpr", "tpr"])
    stepped = running_totals(
        cut, list(keys), ["along", "fpr", "tpr"], {}, {"next_fpr": "fpr", "next_tpr": "tpr"}
    )
    area = (F.col("next_fpr") - F.col("fpr")) * (F.col("next_tpr") + F.col("tpr")) / 2
    return stepped.groupBy(*keys).agg(F.sum(area).alias("auc"))


def log_loss(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """M1.11."""
    p_true = F.element_at("proba", F.col("y").cast("int") + 1)
    kept = F.least(F.greatest(p_true, F.lit(LOG_EPS)), F.lit(1 - LOG_EPS))
    return predictions.groupBy(*by).agg(F.avg(-F.log(kept)).alias("log_loss"))


def count_metrics(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """M1.1-M1.4, M1.6, M1.7, M1.9, M1.10: one small row per model from the label counts."""
    return counted_metrics(confusion_counts(predictions, by), by)


def counted_metrics(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The same from (true, predicted) pairs that are counted already."""
    counts = with_precision_recall(label_counts(confusion, by))
    tp, fp, fn = F.sum("tp"), F.sum("fp"), F.sum("fn")
    return counts.groupBy(*by).agg(
        ratio(tp, F.sum("support")).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("f1").alias("f1_macro"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1_micro"),
        F.avg("precision").alias("precision_macro"),
        ratio(tp, tp + fp).alias("precision_micro"),
        F.avg("recall").alias("recall_macro"),
        ratio(tp, tp + fn).alias("recall_micro"),
    )


def probability_metrics(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """M1.5, M1.8: per-label values averaged over labels; two classes use the second one."""
    per_label = curve_metrics(one_vs_rest(predictions, by), [*by, "label"])
    two = F.max("label") == 1

    def over_labels(value: str) -> Column:
        return F.when(two, F.max(F.when(F.col("label") == 1, F.col(value)))).otherwise(F.avg(value))

    return per_label.groupBy(*by).agg(
        over_labels("auc").alias("roc_auc"), over_labels("average_precision").alias("average_precision")
    )


def probability_metric(predictions: DataFrame, metric: str, by: Sequence[str] = ()) -> DataFrame:
    """M1.5 or M1.8 alone."""
    return probability_metrics(predictions, by).select(*by, metric)


def metric_panel(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """M1: all eleven metrics per model, one row each."""
    parts = [
        count_metrics(predictions, by),
        probability_metrics(predictions, by),
        log_loss(predictions, by),
    ]
    names = [c for part in parts for c in part.columns if c not in by]
    long = None
    for part in parts:
        values = [c for c in part.columns if c not in by]
        rows = part.select(
            *by, F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in values]))
        )
        long = rows if long is None else long.unionByName(rows)
    return long.groupBy(*by).pivot("metric", names).agg(F.max("value"))


def metric_value(predictions: DataFrame, metric: str, by: Sequence[str] = ()) -> DataFrame:
    """M1: ``score`` per model, larger is better (log loss is negated)."""
    if metric == "log_loss":
        return log_loss(predictions, by).select(*by, (-F.col("log_loss")).alias("score"))
    if metric in ("roc_auc", "average_precision"):
        return probability_metric(predictions, metric, by).select(*by, F.col(metric).alias("score"))
    return count_metrics(predictions, by).select(*by, F.col(metric).alias("score"))


def performance_table(predictions: DataFrame) -> DataFrame:
    """Precision, recall and AUC per label."""
    return precision_recall(predictions).select("label", "precision", "recall").join(
        roc_auc(one_vs_rest(predictions)), "label", "left"
    )


def importance_summary(drops: DataFrame) -> DataFrame:
    """Mean, spread and raw values per feature from (feature, repeat, drop)."""
    return drops.groupBy("feature").agg(
        F.avg("drop").alias("mean"),
        F.stddev_pop("drop").alias("std"),
        F.transform(F.array_sort(F.collect_list(F.struct("repeat", "drop"))), lambda s: s["drop"]).alias("drops"),
    )


def importance_pages(summary: DataFrame, page_size: int = 20) -> DataFrame:
    """Features by falling mean importance, cut into pages.

    One row per feature of the plan, so a single ordered window is small.
    """
    rank = F.row_number().over(W.orderBy(F.desc("mean"), "feature"))
    return summary.withColumn("rank", rank).withColumn(
        "page", F.floor((F.col("rank") - 1) / page_size).cast("int")
    )
