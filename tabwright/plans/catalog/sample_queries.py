"""Split and balance over the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.config import BalanceOptions
from tabwright.operators.sample import (
    balance_copies, balance_quota, balance_rows, class_counts, exact_split, fold_of, hash_split,
)
from tabwright.plans.catalog.common import rounded, sql_round, table

SEED = 10001


def price_band(price: str, low: int, mid: int) -> Column:
    return F.when(F.col(price) < low, F.lit("low")).when(F.col(price) < mid, F.lit("mid")).otherwise(F.lit("high"))


def _banded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", price_band("o_totalprice", 50_000, 200_000).alias("band")
    )


def split_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out membership per customer and its search fold."""
    rows = hash_split(table(spark, sf_dir, "customer"), "c_custkey", SEED)
    return rows.select("c_custkey", "in_test", fold_of("c_custkey", SEED, 5).alias("fold"))


def split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 with exact sizes: global rank by hash, a fifth held out."""
    customers = table(spark, sf_dir, "customer")
    return exact_split(customers, "c_custkey", SEED, customers.count()).select("c_custkey", "in_test")


_QUOTA_SETTINGS = [
    (mode, over) for mode in ("none", "equalize", "average") for over in (1.0, 2.0)
]


def quota_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotas of the price bands for every mode and oversampling limit."""
    lines = table(spark, sf_dir, "lineitem").select(price_band("l_extendedprice", 10_000, 40_000).alias("band"))
    counts = class_counts(lines, "band")
    out = None
    for mode, over in _QUOTA_SETTINGS:
        quota = balance_quota(counts, BalanceOptions(mode, over)).select(
            F.lit(mode).alias("mode"), F.lit(over).alias("oversample"), "band", "cnt", rounded("weight", "weight"),
            rounded("target_count", "target_count"), "quota",
        )
        out = quota if out is None else out.unionByName(quota)
    return out


def balance_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders balanced to averaged class shares, one row per copy counted back."""
    rows = balance_rows(_banded_orders(spark, sf_dir), "band", "o_orderkey", BalanceOptions("average", 2.0), SEED)
    return rows.groupBy("o_orderkey", "band").agg(F.count("*").alias("copies"))


def balance_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies per order for equal classes with heavy oversampling (whole copies too)."""
    copies = balance_copies(
        _banded_orders(spark, sf_dir), "band", "o_orderkey", BalanceOptions("equalize", 9.0), SEED
    )
    return copies.select("o_orderkey", "band", "copies")


QUERIES = {
    "split_customers": split_customers,
    "split_exact": split_exact,
    "quota_lines": quota_lines,
    "balance_orders": balance_orders,
    "balance_equal": balance_equal,
}


def sql_hash(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 15) AS BIGINT)"


def sql_band(price: str, low: int, mid: int) -> str:
    return f"CASE WHEN {price} < {low} THEN 'low' WHEN {price} < {mid} THEN 'mid' ELSE 'high' END"


def _sql_quota(mode: str, over: float) -> str:
    """Quota columns over a table ``c(band, cnt)``."""
    weight = "1.0::DOUBLE / count(*) OVER ()"
    if mode != "equalize":
        weight = f"({weight} + cnt::DOUBLE / sum(cnt) OVER ()) / 2"
    quota = "cnt" if mode == "none" else "CAST(floor(weight * target_count) AS BIGINT)"
    return f"""(SELECT band, cnt, weight, target_count, {quota} AS quota FROM
      (SELECT *, least({over}::DOUBLE * min(cnt) OVER () / min(weight) OVER (), sum(cnt) OVER ()::DOUBLE) AS target_count
       FROM (SELECT band, cnt, {weight} AS weight FROM c)))"""


def _sql_copies(mode: str, over: float) -> str:
    return f"""
WITH t AS (SELECT o_orderkey, {sql_band('o_totalprice', 50_000, 200_000)} AS band,
    {sql_hash(str(SEED), 'o_orderkey')} AS h FROM orders),
c AS (SELECT band, count(*) AS cnt FROM t GROUP BY band),
q AS (SELECT band, cnt, quota // cnt AS whole, quota % cnt AS rest FROM {_sql_quota(mode, over)}),
ranked AS (SELECT o_orderkey, band, row_number() OVER (PARTITION BY band ORDER BY h, o_orderkey) - 1 AS r FROM t),
draws AS (SELECT band, cnt, unnest(generate_series(1, rest)) AS k FROM q WHERE rest > 0),
drawn AS (SELECT band, {sql_hash(str(SEED), 'band', 'k')} % cnt AS r, count(*) AS n FROM draws GROUP BY ALL),
copied AS (SELECT o_orderkey, ranked.band, CAST(whole + coalesce(n, 0) AS BIGINT) AS copies
  FROM ranked JOIN q USING (band) LEFT JOIN drawn ON drawn.band = ranked.band AND drawn.r = ranked.r)
SELECT o_orderkey, band, copies FROM copied"""


SQL = {
    "split_customers": f"""SELECT c_custkey, {sql_hash(str(SEED), 'c_custkey')} / {float(16**15)}::DOUBLE < 0.2 AS in_test,
        CAST({sql_hash(f"'fold{SEED}'", 'c_custkey')} % 5 AS INTEGER) AS fold FROM customer""",
    "split_exact": f"""SELECT c_custkey, row_number() OVER (ORDER BY {sql_hash(str(SEED), 'c_custkey')}, c_custkey)
        <= ceil(0.2 * count(*) OVER ()) AS in_test FROM customer""",
    "quota_lines": f"""WITH c AS (SELECT {sql_band('l_extendedprice', 10_000, 40_000)} AS band, count(*) AS cnt
        FROM lineitem GROUP BY 1) """
    + " UNION ALL ".join(
        f"""SELECT '{mode}' AS mode, {over}::DOUBLE AS oversample, band, cnt, {sql_round('weight')} AS weight,
        {sql_round('target_count')} AS target_count, quota FROM {_sql_quota(mode, over)}"""
        for mode, over in _QUOTA_SETTINGS
    ),
    "balance_orders": _sql_copies("average", 2.0) + " WHERE copies > 0",
    "balance_equal": _sql_copies("equalize", 9.0),
}
