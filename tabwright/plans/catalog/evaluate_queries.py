"""Held-out statistics over predictions of closed-form models, so SQL can follow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.operators.evaluate import (
    accuracy, average_precision, confusion_normalized, curve_area, importance_pages, importance_summary,
    metric_panel, one_vs_rest, performance_table, precision_recall, roc_auc, roc_points,
)
from tabwright.operators.importance import permutation_drops
from tabwright.plans.catalog.common import rounded, sql_round, table
from tabwright.plans.catalog.sample_queries import SEED, sql_hash


def _line_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three price bands and a closed-form probability for each line item."""
    lines = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice")
    y = F.when(price < 20000, 0).when(price < 60000, 1).otherwise(2)
    a = F.lit(1.0) + F.col("l_discount") * F.lit(50.0)
    b = F.lit(1.0) + F.col("l_tax") * F.lit(50.0) + F.when(F.col("l_quantity") > 25, F.lit(2.0)).otherwise(F.lit(0.0))
    c = F.lit(1.0) + F.col("l_quantity") / F.lit(10.0)
    rows = lines.select(y.alias("y"), a.alias("a"), b.alias("b"), c.alias("c"))
    total = F.col("a") + F.col("b") + F.col("c")
    proba = F.array(F.col("a") / total, F.col("b") / total, F.col("c") / total)
    return rows.select("y", proba.alias("proba")).withColumn(
        "yhat", (F.array_position("proba", F.array_max("proba")) - 1).cast("int")
    )


_LINES_SQL = """
raw AS (SELECT CASE WHEN l_extendedprice < 20000 THEN 0 WHEN l_extendedprice < 60000 THEN 1 ELSE 2 END AS y,
    1.0::DOUBLE + l_discount * 50.0::DOUBLE AS a,
    1.0::DOUBLE + l_tax * 50.0::DOUBLE + CASE WHEN l_quantity > 25 THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END AS b,
    1.0::DOUBLE + l_quantity / 10.0::DOUBLE AS c FROM lineitem),
pred AS (SELECT y, [a / (a + b + c), b / (a + b + c), c / (a + b + c)] AS proba,
    CASE WHEN a / (a + b + c) >= greatest(b / (a + b + c), c / (a + b + c)) THEN 0
      WHEN b / (a + b + c) >= c / (a + b + c) THEN 1 ELSE 2 END AS yhat FROM raw)"""


def _order_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two classes (urgent or high priority) scored by total price, nearly no ties."""
    score = F.col("o_totalprice") / F.lit(500000.0)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("y"),
        F.array(F.lit(1.0) - score, score).alias("proba"),
        (score > 0.5).cast("int").alias("yhat"),
    )


_ORDERS_SQL = """
pred AS (SELECT CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS INTEGER) AS y,
    [1.0::DOUBLE - o_totalprice / 500000.0::DOUBLE, o_totalprice / 500000.0::DOUBLE] AS proba,
    CAST(o_totalprice / 500000.0::DOUBLE > 0.5 AS INTEGER) AS yhat FROM orders)"""


def _document_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with their length as the score of good quality."""
    labels = table(spark, sf_dir, "labels")
    return labels.join(table(spark, sf_dir, "documents"), "doc_id").select(
        F.lit(1).alias("label"), F.col("n_chars").cast("double").alias("score"),
        F.col("quality").cast("bigint").alias("pos"),
    )


def accuracy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A14, J5."""
    return accuracy(_line_predictions(spark, sf_dir)).select(rounded("accuracy", "accuracy"))


def precision_recall_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A15, A16."""
    rows = precision_recall(_line_predictions(spark, sf_dir))
    return rows.select("label", "tp", "fp", "fn", "support", *[rounded(c, c) for c in ("precision", "recall", "f1")])


def confusion_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A19, E6."""
    return confusion_normalized(_line_predictions(spark, sf_dir), 3).select("y", "yhat", rounded("share", "share"))


def roc_points_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curve points of three one-vs-rest curves with many ties."""
    points = roc_points(one_vs_rest(_line_predictions(spark, sf_dir)))
    return points.select("label", *[rounded(c, c) for c in ("threshold", "fpr", "tpr")])


def roc_points_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E9 on document quality by length."""
    points = roc_points(_document_scores(spark, sf_dir))
    return points.select("label", "threshold", rounded("fpr", "fpr"), rounded("tpr", "tpr"))


def roc_auc_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A17 on nearly tie-free scores."""
    scored = one_vs_rest(_order_predictions(spark, sf_dir))
    return roc_auc(scored).select("label", rounded("auc", "auc"))


def curve_area_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area under the stored points equals the AUC."""
    return curve_area(roc_points(one_vs_rest(_line_predictions(spark, sf_dir)))).select("label", rounded("auc", "auc"))


def average_precision_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1.8 per label."""
    scored = one_vs_rest(_order_predictions(spark, sf_dir))
    return average_precision(scored).select("label", rounded("average_precision", "average_precision"))


def performance_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E11."""
    rows = performance_table(_line_predictions(spark, sf_dir))
    return rows.select("label", *[rounded(c, c) for c in ("precision", "recall", "auc")])


_PANEL = [
    "accuracy", "balanced_accuracy", "f1_macro", "f1_micro", "precision_macro", "precision_micro", "recall_macro",
    "recall_micro", "roc_auc", "average_precision", "log_loss",
]


def _panel(predictions: DataFrame) -> DataFrame:
    return metric_panel(predictions).select(*[rounded(c, c) for c in _PANEL])


def metric_panel_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, M1.1-M1.11 for three classes."""
    return _panel(_line_predictions(spark, sf_dir))


def metric_panel_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, M1.1-M1.11 for two classes."""
    return _panel(_order_predictions(spark, sf_dir))


_FEATURES = ["price", "customer", "status"]
_REPEATS = 4


def _order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "O", 1.0).otherwise(0.0)
    return orders.select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_totalprice") + F.when(F.col("o_orderstatus") == "O", 50000).otherwise(0) > 250000).cast("int").alias("y"),
        F.array(F.col("o_totalprice") / F.lit(100000.0), F.col("o_custkey").cast("double"), status).alias("feature_row"),
    )


def _rule(row: Column) -> Column:
    return (F.get(row, F.lit(0)) + F.get(row, F.lit(2)) / F.lit(2.0) > F.lit(2.5)).cast("int")


def _order_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_drops(
        _order_features(spark, sf_dir), "id", "feature_row", _FEATURES,
        lambda df: df.withColumn("yhat", _rule(F.col("feature_row"))), SEED, _REPEATS,
    )


def permutation_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy lost per feature and repeat."""
    return _order_drops(spark, sf_dir).select("feature", "repeat", rounded("drop", "drop"))


def importance_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features by mean importance, two per page."""
    pages = importance_pages(importance_summary(_order_drops(spark, sf_dir)), 2)
    values = F.concat_ws(",", F.transform("drops", lambda d: F.format_string("%.6f", d + F.lit(0.0))))
    return pages.select(
        "feature", rounded("mean", "mean"), rounded("std", "std"), values.alias("drops"), "rank", "page"
    )


QUERIES = {
    "accuracy_lines": accuracy_lines,
    "precision_recall_lines": precision_recall_lines,
    "confusion_lines": confusion_lines,
    "roc_points_lines": roc_points_lines,
    "roc_points_documents": roc_points_documents,
    "roc_auc_orders": roc_auc_orders,
    "curve_area_lines": curve_area_lines,
    "average_precision_orders": average_precision_orders,
    "performance_lines": performance_lines,
    "metric_panel_lines": metric_panel_lines,
    "metric_panel_orders": metric_panel_orders,
    "permutation_orders": permutation_orders,
    "importance_rank": importance_rank,
}

_COUNTS_SQL = """
counts AS (SELECT l.label, count(*) FILTER (y = label AND yhat = label) AS tp,
    count(*) FILTER (y <> label AND yhat = label) AS fp, count(*) FILTER (y = label AND yhat <> label) AS fn,
    count(*) FILTER (y = label) AS support
  FROM pred, (SELECT DISTINCT y AS label FROM pred UNION SELECT DISTINCT yhat FROM pred) l GROUP BY l.label),
rates AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
    coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM counts)"""

_SCORED_SQL = """
scored AS (SELECT i AS label, proba[i + 1] AS score, CAST(y = i AS BIGINT) AS pos
  FROM pred, (SELECT unnest(range(len((SELECT any_value(proba) FROM pred)))) AS i))"""

_CURVE_SQL = """
steps AS (SELECT label, score, sum(pos) AS pos, count(*) - sum(pos) AS neg FROM scored GROUP BY label, score),
curve AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
    sum(pos) OVER (PARTITION BY label) AS all_pos, sum(neg) OVER (PARTITION BY label) AS all_neg,
    lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg, row_number() OVER w AS r
  FROM steps WINDOW w AS (PARTITION BY label ORDER BY score DESC)),
areas AS (SELECT label, sum(neg * (tp - pos / 2)) / (sum(pos) * sum(neg)) AS auc,
    sum(pos * tp / (tp + fp)) / sum(pos) AS ap FROM curve GROUP BY label)"""

_POINTS_SQL = f"""
SELECT label, {sql_round('score')} AS threshold, {sql_round('fp / all_neg')} AS fpr, {sql_round('tp / all_pos')} AS tpr
FROM curve WHERE r = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
UNION ALL SELECT DISTINCT label, NULL, 0.0, 0.0 FROM curve"""


def sql_panel(predictions: str, two_classes: bool) -> str:
    area = "(SELECT {0} FROM areas WHERE label = 1)" if two_classes else "(SELECT avg({0}) FROM areas)"
    values = {
        "accuracy": "sum(tp) / sum(support)",
        "balanced_accuracy": "avg(recall) FILTER (support > 0)",
        "f1_macro": "avg(f1)",
        "f1_micro": "2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn))",
        "precision_macro": "avg(precision)",
        "precision_micro": "sum(tp) / (sum(tp) + sum(fp))",
        "recall_macro": "avg(recall)",
        "recall_micro": "sum(tp) / (sum(tp) + sum(fn))",
        "roc_auc": area.format("auc"),
        "average_precision": area.format("ap"),
        "log_loss": "(SELECT avg(-ln(least(greatest(proba[y + 1], 1e-15), 1 - 1e-15))) FROM pred)",
    }
    columns = ", ".join(f"{sql_round(v)} AS {k}" for k, v in values.items())
    return f"WITH {predictions}, {_COUNTS_SQL}, {_SCORED_SQL}, {_CURVE_SQL} SELECT {columns} FROM rates"


def _drops_sql() -> str:
    rule = "CAST({p} + {s} / 2.0::DOUBLE > 2.5 AS INTEGER) = y"
    moved = {
        "price": rule.format(p="nxt.price", s="status"),
        "customer": rule.format(p="price", s="status"),
        "status": rule.format(p="price", s="nxt.status"),
    }
    parts = " UNION ALL ".join(
        f"SELECT '{name}' AS feature, repeat, avg(CAST({hit} AS INTEGER)) AS score FROM borrowed GROUP BY repeat"
        for name, hit in moved.items()
    )
    return f"""
WITH base AS (SELECT o_orderkey AS id, o_totalprice / 100000.0::DOUBLE AS price, o_custkey::DOUBLE AS customer,
    CASE WHEN o_orderstatus = 'O' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS status,
    CAST(o_totalprice + CASE WHEN o_orderstatus = 'O' THEN 50000 ELSE 0 END > 250000 AS INTEGER) AS y FROM orders),
hashed AS (SELECT *, {sql_hash(str(SEED), 'repeat', 'id')} AS h
  FROM base, (SELECT unnest(range({_REPEATS})) AS repeat)),
borrowed AS (SELECT *, coalesce(lead({{'price': price, 'status': status}}) OVER w,
    first_value({{'price': price, 'status': status}}) OVER w) AS nxt
  FROM hashed WINDOW w AS (PARTITION BY repeat ORDER BY h, id)),
drops AS (SELECT feature, CAST(repeat AS INTEGER) AS repeat,
    (SELECT avg(CAST({rule.format(p='price', s='status')} AS INTEGER)) FROM base) - score AS drop FROM ({parts}))
"""


SQL = {
    "accuracy_lines": f"WITH {_LINES_SQL} SELECT {sql_round('avg(CAST(y = yhat AS INTEGER))')} AS accuracy FROM pred",
    "precision_recall_lines": f"""WITH {_LINES_SQL}, {_COUNTS_SQL} SELECT label, tp, fp, fn, support,
        {sql_round('precision')} AS precision, {sql_round('recall')} AS recall, {sql_round('f1')} AS f1 FROM rates""",
    "confusion_lines": f"""WITH {_LINES_SQL}, grid AS (SELECT unnest(range(9)) AS g)
        SELECT CAST(g // 3 AS INTEGER) AS y, CAST(g % 3 AS INTEGER) AS yhat,
        {sql_round('(SELECT count(*) FROM pred WHERE y = g // 3 AND yhat = g % 3) / (SELECT count(*) FROM pred WHERE y = g // 3)')} AS share
        FROM grid""",
    "roc_points_lines": f"WITH {_LINES_SQL}, {_SCORED_SQL}, {_CURVE_SQL} {_POINTS_SQL}",
    "roc_points_documents": f"""WITH scored AS (SELECT 1 AS label, n_chars::DOUBLE AS score, quality::BIGINT AS pos
        FROM labels JOIN documents USING (doc_id)), {_CURVE_SQL} {_POINTS_SQL}""",
    "roc_auc_orders": f"WITH {_ORDERS_SQL}, {_SCORED_SQL}, {_CURVE_SQL} SELECT label, {sql_round('auc')} AS auc FROM areas",
    "curve_area_lines": f"WITH {_LINES_SQL}, {_SCORED_SQL}, {_CURVE_SQL} SELECT label, {sql_round('auc')} AS auc FROM areas",
    "average_precision_orders": f"""WITH {_ORDERS_SQL}, {_SCORED_SQL}, {_CURVE_SQL}
        SELECT label, {sql_round('ap')} AS average_precision FROM areas""",
    "performance_lines": f"""WITH {_LINES_SQL}, {_COUNTS_SQL}, {_SCORED_SQL}, {_CURVE_SQL}
        SELECT label, {sql_round('precision')} AS precision, {sql_round('recall')} AS recall, {sql_round('auc')} AS auc
        FROM rates JOIN areas USING (label)""",
    "metric_panel_lines": sql_panel(_LINES_SQL, False),
    "metric_panel_orders": sql_panel(_ORDERS_SQL, True),
    "permutation_orders": _drops_sql() + f"SELECT feature, repeat, {sql_round('drop')} AS drop FROM drops",
    "importance_rank": _drops_sql()
    + f"""SELECT feature, {sql_round('avg(drop)')} AS mean, {sql_round('stddev_pop(drop)')} AS std,
        string_agg(printf('%.6f', drop + 0.0), ',' ORDER BY repeat) AS drops,
        CAST(row_number() OVER (ORDER BY avg(drop) DESC, feature) AS INTEGER) AS rank,
        CAST((row_number() OVER (ORDER BY avg(drop) DESC, feature) - 1) // 2 AS INTEGER) AS page
        FROM drops GROUP BY feature""",
}
