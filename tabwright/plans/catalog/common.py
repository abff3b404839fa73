"""Inputs the queries share, and the SQL twin of each input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.numbers import FLOAT_TEXT, INT_TEXT
from tabwright.sources.scratch import spread, written

PLACES = 6
_DOCUMENTS_PER_FILE = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(column: Column | str, name: str) -> Column:
    # Adding zero turns a negative zero into a plain one.
    return (F.round(column, PLACES) + F.lit(0.0)).alias(name)


def sql_round(expression: str) -> str:
    return f"round({expression}, {PLACES}) + 0.0"


def sql_obs(source: str, pos: str, attributes: list[tuple[str, str, str]]) -> str:
    """UNION ALL of (path, type, text expression) over a table; NULL texts are absent."""
    parts = [
        f"SELECT {pos} AS pos, '{path}' AS path, '{vtype}' AS vtype, text FROM "
        f"(SELECT *, CAST({text} AS VARCHAR) AS text FROM {source}) WHERE text IS NOT NULL"
        for path, vtype, text in attributes
    ]
    return " UNION ALL ".join(parts)


SQL_NUMBER = (
    f"CASE WHEN regexp_matches(text, '{FLOAT_TEXT}') AND NOT isnan(TRY_CAST(regexp_replace(text, '[\\s_]', '', 'g') AS DOUBLE)) "
    "THEN TRY_CAST(regexp_replace(text, '[\\s_]', '', 'g') AS DOUBLE) END"
)


def sql_profile(obs: str) -> str:
    """CTEs obs, freq and prof over an observation query."""
    return f"""
WITH obs AS ({obs}),
freq AS (
  SELECT path, text, count(*) AS n,
    count(*) FILTER (vtype = 'int') AS n_int, count(*) FILTER (vtype = 'float') AS n_float,
    count(*) FILTER (vtype = 'string') AS n_string, count(*) FILTER (vtype = 'date') AS n_date,
    min(pos) FILTER (vtype = 'int') AS first_int, min(pos) FILTER (vtype = 'float') AS first_float,
    min(pos) FILTER (vtype = 'string') AS first_string, min(pos) FILTER (vtype = 'date') AS first_date,
    max(pos) AS last_pos, regexp_matches(text, '{INT_TEXT}') AS int_text,
    regexp_matches(text, '{FLOAT_TEXT}') AS float_text, {SQL_NUMBER} AS number
  FROM obs GROUP BY path, text),
modes AS (
  SELECT path, text AS mode FROM
    (SELECT path, text, row_number() OVER (PARTITION BY path ORDER BY n DESC, last_pos, text) AS r FROM freq)
  WHERE r = 1),
numbers AS (
  SELECT obs.path, freq.number, freq.int_text FROM obs JOIN freq USING (path, text) WHERE freq.number IS NOT NULL),
middles AS (
  SELECT path, median(number) FILTER (int_text) AS median_int, avg(number) FILTER (int_text) AS mean_int,
    median(number) AS median_float, avg(number) AS mean_float FROM numbers GROUP BY path),
prof AS (
  SELECT path, CAST(sum(n) AS BIGINT) AS present, count(*) AS unique_count,
    CAST(sum(n_int) AS BIGINT) AS n_int, CAST(sum(n_float) AS BIGINT) AS n_float,
    CAST(sum(n_string) AS BIGINT) AS n_string, CAST(sum(n_date) AS BIGINT) AS n_date,
    min(first_int) AS first_int, min(first_float) AS first_float,
    min(first_string) AS first_string, min(first_date) AS first_date,
    CAST(coalesce(sum(n_string) FILTER (int_text), 0) AS BIGINT) AS int_strings,
    CAST(coalesce(sum(n_string) FILTER (float_text AND NOT int_text), 0) AS BIGINT) AS float_strings
  FROM freq GROUP BY path)
"""


def sql_plan(obs: str, n_docs: str, target: str, max_categorical: int = 10, promote: bool = False) -> str:
    """CTEs up to ``plan`` with the decision per path."""
    string_rank = "4611686018427387906" if promote else "coalesce(first_string, 4611686018427387903)"
    return sql_profile(obs) + f""",
kinds AS (
  SELECT path, 'int' AS type, n_int + int_strings AS c, coalesce(first_int, 4611686018427387904) AS r FROM prof
  UNION ALL SELECT path, 'float', n_float + int_strings + float_strings, coalesce(first_float, 4611686018427387905) FROM prof
  UNION ALL SELECT path, 'string', n_string, {string_rank} FROM prof
  UNION ALL SELECT path, 'date', n_date, coalesce(first_date, 4611686018427387903) FROM prof),
best AS (
  SELECT path, type, c FROM
    (SELECT *, row_number() OVER (PARTITION BY path ORDER BY c DESC, r) AS k FROM kinds) WHERE k = 1),
judged AS (
  SELECT prof.*, CASE WHEN best.c / ({n_docs}) > 0.8 THEN best.type END AS preferred,
    unique_count > 1 AS many, present / ({n_docs}) > 0.8 AS dense, path = '{target}' AS is_target
  FROM prof JOIN best USING (path)),
plan AS (
  SELECT *, (is_target OR (many AND dense AND (coalesce(preferred IN ('int', 'float'), false)
      OR unique_count <= {max_categorical}))) AS selected,
    CASE WHEN is_target THEN 'string' WHEN many AND dense AND preferred IN ('int', 'float') THEN preferred
      WHEN many AND dense AND unique_count <= {max_categorical} THEN 'string' END AS type,
    CASE WHEN is_target THEN 'Categorical' WHEN many AND dense AND preferred IN ('int', 'float') THEN 'Numerical'
      WHEN many AND dense AND unique_count <= {max_categorical} THEN 'Categorical' END AS sense,
    CASE WHEN is_target THEN NULL WHEN NOT many THEN 'single_value' WHEN NOT dense THEN 'too_sparse'
      WHEN coalesce(preferred IN ('int', 'float'), false) OR unique_count <= {max_categorical} THEN NULL
      ELSE 'too_many_values' END AS reason
  FROM judged)
"""


def mixed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON documents whose attributes change type with the order status.

    amount: number / whole-number text / number text; flag: boolean or text; when.at:
    wrapped date or text; gap: absent, null or number; ident: wrapped long. The documents are
    written once, as the raw documents of a stage are, so that later passes do not parse again.
    """
    # Documents cost far more than the few bytes of their rows: tasks get equal numbers, however the table's file is cut.
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    orders = spread(orders, "o_orderkey", "o_custkey", "o_totalprice")
    iso = F.replace(F.col("o_orderdate").cast("string"), F.lit(" "), F.lit("T"))
    ident = F.struct(F.col("o_custkey").cast("string").alias("$numberLong")).alias("ident")
    dated = F.struct(F.struct(iso.alias("$date")).alias("at")).alias("when")
    plain = F.struct(iso.alias("at")).alias("when")
    priority = F.col("o_orderpriority")
    is_open = F.to_json(
        F.struct(
            F.col("o_totalprice").alias("amount"), F.lit(True).alias("flag"), dated, priority.alias("priority"), ident
        )
    )
    is_final = F.to_json(
        F.struct(
            F.col("o_custkey").cast("string").alias("amount"), priority.alias("flag"), plain,
            F.lit(None).cast("string").alias("gap"), priority.alias("priority"), ident,
        ),
        {"ignoreNullFields": "false"},
    )
    is_part = F.to_json(
        F.struct(
            F.concat(F.lit(" "), F.col("o_totalprice").cast("string")).alias("amount"), F.lit(False).alias("flag"),
            plain, F.col("o_custkey").alias("gap"), priority.alias("priority"), ident,
        )
    )
    text = F.when(F.col("o_orderstatus") == "O", is_open).when(F.col("o_orderstatus") == "F", is_final).otherwise(is_part)
    return written(orders.select(F.col("o_orderkey").alias("pos"), F.try_parse_json(text).alias("doc")), "mixed-orders", _DOCUMENTS_PER_FILE)


_MIXED = {
    "O": [
        ("amount", "float", "o_totalprice"), ("flag", "int", "1"), ("when.at", "date", "o_orderdate"),
        ("priority", "string", "o_orderpriority"), ("ident", "int", "o_custkey"),
    ],
    "F": [
        ("amount", "string", "o_custkey"), ("flag", "string", "o_orderpriority"),
        ("when.at", "string", "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')"), ("priority", "string", "o_orderpriority"),
        ("ident", "int", "o_custkey"),
    ],
    "P": [
        ("amount", "string", "concat(' ', o_totalprice)"), ("flag", "int", "0"),
        ("when.at", "string", "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')"), ("gap", "int", "o_custkey"),
        ("priority", "string", "o_orderpriority"), ("ident", "int", "o_custkey"),
    ],
}
MIXED_ORDERS_SQL = " UNION ALL ".join(
    sql_obs(f"(SELECT * FROM orders WHERE o_orderstatus = '{status}')", "o_orderkey", attributes)
    for status, attributes in _MIXED.items()
)
