"""Cleaning, encoding, sources and artifacts over the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.config import EstimatorSpec
from tabwright.functions.paths import col
from tabwright.operators.clean import accepted, clean_columns, quarantined, target_attribute
from tabwright.operators.encode import KEEP, decode, encode_rows
from tabwright.operators.observe import observations
from tabwright.plans.catalog.common import mixed_orders, rounded, sql_round, table
from tabwright.plans.planning import planned
from tabwright.plans.report import default_row, sample_request
from tabwright.plans.stages import clean_stage, profile_stage
from tabwright.sources.delimited import TableFormat, read_delimited
from tabwright.sources.documents import parse_documents, read_json_lines, readable, write_json_lines
from tabwright.sources.scratch import scratch_dir
from tabwright.sources.store import ASIDE, DEFAULTS, ENCODERS, LOSSES, SENSES, TYPES, ArtifactStore


def _patchy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with zero discounts and taxes, late lines and big lines' status missing."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        F.when(F.col("l_linenumber") < 7, F.col("l_returnflag")).alias("l_returnflag"),
        F.when(F.col("l_quantity") <= 45, F.col("l_linestatus")).alias("l_linestatus"),
        "l_shipdate",
    )


_LINES_SPEC = EstimatorSpec("lines", "l_returnflag", pos=None)
_NUMBERS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
]


def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items fitted to their plan."""
    lines = _patchy_lines(spark, sf_dir)
    return accepted(clean_columns(lines, planned(lines, _LINES_SPEC).attributes(), None))


def clean_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many line items are set aside, by reason and defaults needed."""
    lines = _patchy_lines(spark, sf_dir)
    aside = quarantined(clean_columns(lines, planned(lines, _LINES_SPEC).attributes(), None))
    return aside.groupBy(F.col("_reason").alias("reason"), F.col("_defaults_used").alias("defaults_used")).agg(
        F.count("*").alias("n_rows")
    )


_LINES_SQL = """
WITH lines AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
    nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax,
    CASE WHEN l_linenumber < 7 THEN l_returnflag END AS l_returnflag,
    CASE WHEN l_quantity <= 45 THEN l_linestatus END AS l_linestatus FROM lineitem),
kept AS (SELECT * FROM lines WHERE l_returnflag IS NOT NULL),
defaults AS (
  SELECT median(l_discount) AS d_discount, median(l_tax) AS d_tax,
    (SELECT l_linestatus FROM kept WHERE l_linestatus IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS d_status
  FROM kept),
checked AS (
  SELECT lines.*, defaults.*,
    CAST(l_discount IS NULL AS INTEGER) + CAST(l_tax IS NULL AS INTEGER) + CAST(l_linestatus IS NULL AS INTEGER)
      + CAST(l_returnflag IS NULL AS INTEGER) AS defaults_used,
    CASE WHEN l_returnflag IS NULL THEN 'missing_target'
      WHEN CAST(l_discount IS NULL AS INTEGER) + CAST(l_tax IS NULL AS INTEGER)
        + CAST(l_linestatus IS NULL AS INTEGER) > 1 + 10 // 10 THEN 'too_many_defaults' END AS reason
  FROM lines, defaults)
"""


def _mixed_spec() -> EstimatorSpec:
    return EstimatorSpec("orders", "priority")


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6-F9 on VARIANT: texts turn into numbers, wrapped values are opened."""
    docs = mixed_orders(spark, sf_dir)
    rows = accepted(clean_columns(docs, planned(docs, _mixed_spec()).attributes(), "pos"))
    return rows.select("pos", "amount", "flag", "ident", "priority")


def _flagged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")


_FLAGGED_SPEC = EstimatorSpec("flagged", "o_orderpriority", pos="o_orderkey")


def _cleaned_flagged(spark: SparkSession, sf_dir: str):
    orders = _flagged_orders(spark, sf_dir)
    attributes = planned(orders, _FLAGGED_SPEC).attributes()
    return accepted(clean_columns(orders, attributes, "o_orderkey")), attributes


def encode_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories of every order as codes."""
    cleaned, attributes = _cleaned_flagged(spark, sf_dir)
    return encode_rows(cleaned, attributes).withColumnRenamed("pos", "o_orderkey")


def encode_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes learned without the urgent orders; urgent ones get the extra code."""
    orders = _flagged_orders(spark, sf_dir)
    attributes = planned(orders.where("o_orderpriority <> '1-URGENT'"), _FLAGGED_SPEC).attributes()
    checked = accepted(clean_columns(orders, attributes, "o_orderkey"))
    return encode_rows(checked, attributes, KEEP).select(F.col("pos").alias("o_orderkey"), "o_orderpriority")


def decode_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes turned back into labels."""
    cleaned, attributes = _cleaned_flagged(spark, sf_dir)
    target = target_attribute(attributes)
    coded = encode_rows(cleaned, attributes)
    return coded.select(F.col("pos").alias("o_orderkey"), decode(col(target.path), target).alias("label"))


def default_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample request: every default but the target's, as JSON text."""
    orders = _flagged_orders(spark, sf_dir)
    return sample_request(default_row(spark, planned(orders, _FLAGGED_SPEC).attributes()))


def _store(spark: SparkSession, spec: EstimatorSpec) -> ArtifactStore:
    return ArtifactStore(spark, f"{scratch_dir(spark)}/store-{uuid.uuid4().hex}", spec)


def artifact_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plan tables and cleaned rows written by the stages, read back."""
    spec = EstimatorSpec("flagged", "o_orderpriority", pos="o_orderkey")
    store = _store(spark, spec)
    profile_stage(_flagged_orders(spark, sf_dir), spec, store)
    clean_stage(spec, store)
    long = [
        store.metadata(TYPES, "type").select(F.lit("type").alias("kind"), "path", F.col("type").alias("value")),
        store.metadata(SENSES, "sense").select(F.lit("sense"), "path", "sense"),
        store.read(DEFAULTS).where("default_text IS NOT NULL").select(F.lit("default"), "path", "default_text"),
        store.read(ENCODERS).select(F.lit("label"), "path", F.concat_ws(":", "idx", "label")),
        store.read("cleaned").groupBy("o_orderstatus").count().select(
            F.lit("rows"), F.col("o_orderstatus"), F.col("count").cast("string")
        ),
    ]
    out = long[0]
    for part in long[1:]:
        out = out.union(part)
    return out


def loss_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every order went whose text is broken in one of ten and has no target in one of seven."""
    orders = table(spark, sf_dir, "orders")
    body = F.to_json(F.struct("o_totalprice", F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderpriority")).alias("priority")))
    text = F.when(F.col("o_orderkey") % 10 == 0, F.substring(body, 1, 9)).otherwise(body)
    spec = EstimatorSpec("lossy", "priority")
    store = _store(spark, spec)
    profile_stage(parse_documents(orders.select(F.col("o_orderkey").alias("pos"), text.alias("text"))), spec, store)
    return store.read(LOSSES).unionByName(store.read(ASIDE).groupBy(F.concat(F.lit("aside_"), "_reason").alias("kind")).agg(F.count("*").alias("n")))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as padded delimited text and read back typed."""
    layout = TableFormat(
        (("p_partkey", "int"), ("p_name", "string"), ("p_brand", "string"), ("p_size", "int"), ("p_retailprice", "double")),
        header=False, padded=True,
    )
    path = f"{scratch_dir(spark)}/csv-{uuid.uuid4().hex}"
    part = table(spark, sf_dir, "part").select(*[c for c, _ in layout.columns])
    padded = F.concat_ws(", ", *[F.col(c).cast("string") for c, _ in layout.columns])
    part.select(padded.alias("value")).write.text(path)
    return read_delimited(spark, path, layout)


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as extended JSON lines and read back as documents."""
    path = f"{scratch_dir(spark)}/json-{uuid.uuid4().hex}"
    customer = table(spark, sf_dir, "customer")
    write_json_lines(customer, path)
    obs = observations(readable(read_json_lines(spark, path)), "pos")
    return obs.groupBy("path", "vtype").agg(
        F.count("*").alias("n"), F.countDistinct("text").alias("n_values"),
        rounded(F.sum(F.expr("try_cast(text AS DOUBLE)")), "total"),
    )


QUERIES = {
    "clean_rows": clean_rows,
    "clean_rejected": clean_rejected,
    "clean_documents": clean_documents,
    "encode_orders": encode_orders,
    "encode_unseen": encode_unseen,
    "decode_orders": decode_orders,
    "default_request": default_request,
    "artifact_roundtrip": artifact_roundtrip,
    "loss_accounting": loss_accounting,
    "csv_roundtrip": csv_roundtrip,
    "json_roundtrip": json_roundtrip,
}


def _code(column: str, condition: str = "true") -> str:
    return (
        f"(SELECT {column} AS label, CAST(row_number() OVER (ORDER BY {column}) - 1 AS INTEGER) AS idx "
        f"FROM (SELECT DISTINCT {column} FROM orders WHERE {condition}))"
    )


_NO_URGENT = "o_orderpriority <> '1-URGENT'"

SQL = {
    "clean_rows": _LINES_SQL
    + "SELECT "
    + ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" for c in _NUMBERS if c not in ("l_discount", "l_tax")
    )
    + """, coalesce(l_discount, d_discount) AS l_discount, coalesce(l_tax, d_tax) AS l_tax,
      coalesce(l_linestatus, d_status) AS l_linestatus, l_returnflag FROM checked WHERE reason IS NULL""",
    "clean_rejected": _LINES_SQL
    + "SELECT reason, defaults_used, count(*) AS n_rows FROM checked WHERE reason IS NOT NULL GROUP BY ALL",
    "clean_documents": """SELECT o_orderkey AS pos,
        CAST(CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE o_totalprice END AS DOUBLE) AS amount,
        CASE o_orderstatus WHEN 'O' THEN '1' WHEN 'P' THEN '0' ELSE o_orderpriority END AS flag,
        CAST(o_custkey AS DOUBLE) AS ident, o_orderpriority AS priority FROM orders""",
    "encode_orders": f"""SELECT o_orderkey, s.idx AS o_orderstatus, p.idx AS o_orderpriority, o_totalprice
        FROM orders JOIN {_code('o_orderstatus')} s ON s.label = o_orderstatus
        JOIN {_code('o_orderpriority')} p ON p.label = o_orderpriority""",
    "encode_unseen": f"""SELECT o_orderkey, CAST(coalesce(p.idx, 4) AS INTEGER) AS o_orderpriority
        FROM orders LEFT JOIN {_code('o_orderpriority', _NO_URGENT)} p ON p.label = o_orderpriority""",
    "decode_orders": "SELECT o_orderkey, o_orderpriority AS label FROM orders",
    "default_request": """SELECT concat('{"o_orderstatus":"', s, '","o_totalprice":', p, '}') AS request FROM
        (SELECT median(o_totalprice) AS p FROM orders),
        (SELECT o_orderstatus AS s FROM orders GROUP BY 1 ORDER BY count(*) DESC, max(o_orderkey) LIMIT 1)""",
    "loss_accounting": """
        WITH o AS (SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'unreadable' WHEN o_orderkey % 7 = 0 THEN 'missing_target' ELSE 'raw' END AS kind FROM orders)
        SELECT 'input' AS kind, count(*) AS n FROM o UNION ALL SELECT kind, count(*) FROM o GROUP BY kind
        UNION ALL SELECT 'aside_' || kind, count(*) FROM o WHERE kind <> 'raw' GROUP BY kind""",
    "artifact_roundtrip": f"""
        SELECT 'type' AS kind, path, type AS value FROM
          (VALUES ('o_orderstatus', 'string'), ('o_orderpriority', 'string'), ('o_totalprice', 'float')) t(path, type)
        UNION ALL SELECT 'sense', path, sense FROM (VALUES ('o_orderstatus', 'Categorical'),
          ('o_orderpriority', 'Categorical'), ('o_totalprice', 'Numerical')) t(path, sense)
        UNION ALL (SELECT 'default', 'o_orderstatus', o_orderstatus FROM orders
          GROUP BY ALL ORDER BY count(*) DESC, max(o_orderkey) LIMIT 1)
        UNION ALL (SELECT 'default', 'o_orderpriority', o_orderpriority FROM orders
          GROUP BY ALL ORDER BY count(*) DESC, max(o_orderkey) LIMIT 1)
        UNION ALL SELECT 'label', 'o_orderstatus', concat(idx, ':', label) FROM {_code('o_orderstatus')}
        UNION ALL SELECT 'label', 'o_orderpriority', concat(idx, ':', label) FROM {_code('o_orderpriority')}
        UNION ALL SELECT 'rows', o_orderstatus, CAST(count(*) AS VARCHAR) FROM orders GROUP BY ALL""",
    "csv_roundtrip": "SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_size, p_retailprice FROM part",
    "json_roundtrip": f"""
        SELECT 'c_custkey' AS path, 'int' AS vtype, count(c_custkey) AS n, count(DISTINCT c_custkey) AS n_values,
          {sql_round("sum(c_custkey::DOUBLE)")} AS total FROM customer
        UNION ALL SELECT 'c_nationkey', 'int', count(c_nationkey), count(DISTINCT c_nationkey),
          {sql_round("sum(c_nationkey::DOUBLE)")} FROM customer
        UNION ALL SELECT 'c_acctbal', 'float', count(c_acctbal), count(DISTINCT c_acctbal),
          {sql_round("sum(c_acctbal)")} FROM customer
        UNION ALL SELECT 'c_name', 'string', count(c_name), count(DISTINCT c_name), NULL FROM customer
        UNION ALL SELECT 'c_mktsegment', 'string', count(c_mktsegment), count(DISTINCT c_mktsegment), NULL FROM customer""",
}
