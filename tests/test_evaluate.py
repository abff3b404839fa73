"""A14-A20, E7-E11, M1, W1-W4 against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tabwright.operators.evaluate import (
    accuracy, average_precision, confusion_normalized, count_metrics, curve_area, importance_pages,
    importance_summary, log_loss, metric_panel, metric_value, one_vs_rest, performance_table, precision_recall,
    probability_metric, roc_auc, roc_points,
)
from tabwright.operators.importance import borrowed_rows, permutation_drops, permuted_rows


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(0, s, t) for s, t in zip([0.9, 0.8, 0.8, 0.3, 0.3, 0.1], [1, 1, 0, 0, 1, 0])]
    return spark.createDataFrame(rows, "label int, score double, pos long")


def make_predictions(spark, n=300, k=3, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        weights = [rng.randint(1, 6) for _ in range(k)]
        proba = [w / sum(weights) for w in weights]
        rows.append((i, rng.choice(range(k)), proba, proba.index(max(proba))))
    return spark.createDataFrame(rows, "id long, y int, proba array<double>, yhat int"), rows


def pair_auc(scores, truth):
    good = [s for s, t in zip(scores, truth) if t]
    bad = [s for s, t in zip(scores, truth) if not t]
    return sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))


def test_auc_of_the_small_curve(scored):
    assert roc_auc(scored).first().auc == pytest.approx(7 / 9)
    assert curve_area(roc_points(scored)).first().auc == pytest.approx(7 / 9)


def test_curve_starts_at_the_origin_and_ends_at_one(scored):
    points = [(r.threshold, r.fpr, r.tpr) for r in roc_points(scored).orderBy("fpr", "tpr").collect()]
    assert points[0] == (None, 0.0, 0.0) and points[-1][1:] == (1.0, 1.0)


def test_evenly_repeated_steps_are_left_out(spark):
    rows = [(0, float(s), p) for s, p in [(9, 1), (8, 1), (7, 1), (6, 0), (5, 0), (4, 0), (3, 1)]]
    points = roc_points(spark.createDataFrame(rows, "label int, score double, pos long"))
    kept = sorted((r.threshold for r in points.collect() if r.threshold is not None), reverse=True)
    assert kept == [9.0, 7.0, 4.0, 3.0]


def test_class_without_examples_has_no_auc(spark):
    rows = spark.createDataFrame([(0, 0.4, 1), (0, 0.6, 1)], "label int, score double, pos long")
    assert roc_auc(rows).first().auc is None and curve_area(roc_points(rows)).count() == 0


def test_many_labels_against_pair_counting(spark):
    df, rows = make_predictions(spark)
    got = {r.label: r.auc for r in roc_auc(one_vs_rest(df)).collect()}
    for label in range(3):
        assert got[label] == pytest.approx(pair_auc([r[2][label] for r in rows], [r[1] == label for r in rows]))


def test_label_rates_and_confusion(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "y int, yhat int")
    rates = {r.label: (r.precision, r.recall) for r in precision_recall(df).collect()}
    assert rates == {0: (1.0, 0.5), 1: (pytest.approx(1 / 3), 1.0), 2: (0.0, 0.0)}
    assert accuracy(df).first().accuracy == 0.5
    cells = {(r.y, r.yhat): r.share for r in confusion_normalized(df, 4).collect()}
    assert len(cells) == 16 and cells[0, 0] == cells[0, 1] == 0.5 and cells[2, 1] == 1.0 and cells[3, 3] == 0.0


def test_panel_against_definitions(spark):
    df, rows = make_predictions(spark)
    row = metric_panel(df).first()
    n = len(rows)
    tp = [sum(r[1] == r[3] == c for r in rows) for c in range(3)]
    said = [sum(r[3] == c for r in rows) for c in range(3)]
    true = [sum(r[1] == c for r in rows) for c in range(3)]
    precision, recall = [t / s for t, s in zip(tp, said)], [t / s for t, s in zip(tp, true)]
    assert row.accuracy == row.f1_micro == row.precision_micro == row.recall_micro == pytest.approx(sum(tp) / n)
    assert row.balanced_accuracy == row.recall_macro == pytest.approx(sum(recall) / 3)
    assert row.precision_macro == pytest.approx(sum(precision) / 3)
    assert row.f1_macro == pytest.approx(sum(2 * t / (s + u) for t, s, u in zip(tp, said, true)) / 3)
    assert row.log_loss == pytest.approx(-sum(math.log(r[2][r[1]]) for r in rows) / n)


def test_two_classes_use_the_second_for_curves(spark):
    df, rows = make_predictions(spark, k=2)
    second = pair_auc([r[2][1] for r in rows], [r[1] == 1 for r in rows])
    assert probability_metric(df, "roc_auc").first().roc_auc == pytest.approx(second)


def test_several_models_in_one_query(spark):
    df, _ = make_predictions(spark)
    two = df.withColumn("model", F.lit("a")).unionByName(df.withColumn("model", F.lit("b")).withColumn("yhat", F.col("y")))
    scores = {r.model: r.score for r in metric_value(two, "accuracy", ["model"]).collect()}
    assert scores["b"] == 1.0 and scores["a"] == accuracy(df).first().accuracy
    assert metric_panel(two, ["model"]).count() == count_metrics(two, ["model"]).count() == 2
    assert metric_value(df, "log_loss").first().score == -log_loss(df).first().log_loss


def test_average_precision_by_hand(scored):
    expected = (1 / 3) * 1 + (1 / 3) * (2 / 3) + (1 / 3) * (3 / 5)
    assert average_precision(scored).first().average_precision == pytest.approx(expected)


def test_performance_table_joins_per_label(spark):
    df, _ = make_predictions(spark)
    assert [r.label for r in performance_table(df).orderBy("label").collect()] == [0, 1, 2]


def test_borrowing_is_a_permutation_without_fixed_points(spark):
    df = spark.range(500).withColumn("row", F.array(F.col("id").cast("double")))
    got = borrowed_rows(df, "id", "row", 3, 2).collect()
    for repeat in range(2):
        pairs = [(r.id, int(r.borrowed[0])) for r in got if r.repeat == repeat]
        assert sorted(b for _, b in pairs) == list(range(500)) and all(a != b for a, b in pairs)


def test_only_the_chosen_feature_moves(spark):
    df = spark.range(60).withColumn("row", F.array(F.col("id").cast("double"), F.col("id") * 10.0))
    got = permuted_rows(df, "id", "row", ["a", "b"], 3, 1).collect()
    assert len(got) == 120
    for r in got:
        assert r.row[1] == r.id * 10.0 if r.feature == "a" else r.row[0] == float(r.id)
    assert sum(r.row[0] for r in got if r.feature == "a") == sum(range(60))


def test_importance_ranks_the_deciding_feature_first(spark):
    df = spark.range(400).select(
        "id", (F.col("id") % 2).cast("int").alias("y"), F.array((F.col("id") % 2).cast("double"), F.rand(1)).alias("row")
    )
    drops = permutation_drops(
        df, "id", "row", ["use", "noise"], lambda d: d.withColumn("yhat", F.get("row", F.lit(0)).cast("int")), 5, 3
    )
    pages = importance_pages(importance_summary(drops), 1).orderBy("rank").collect()
    assert [(r.feature, r.page) for r in pages] == [("use", 0), ("noise", 1)]
    assert 0.35 < pages[0]["mean"] < 0.65 and pages[1]["mean"] == 0.0 and len(pages[0].drops) == 3
