"""Flattening, profiling and type rules over the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.config import EstimatorSpec, SchemaOptions
from tabwright.operators.observe import observations, with_target
from tabwright.operators.profile import freq_of, medians, profile, profile_of
from tabwright.operators.rules import rejected, selected
from tabwright.plans.catalog.common import (
    MIXED_ORDERS_SQL, mixed_orders, rounded, sql_obs, sql_plan, sql_profile, sql_round, table,
)
from tabwright.plans.planning import planned
from tabwright.sources.documents import extended_json, parse_documents
from tabwright.sources.scratch import written


def _comparable(obs: DataFrame) -> DataFrame:
    """Numbers compare as numbers, everything else as text."""
    is_float = F.col("vtype") == "float"
    return obs.select(
        F.col("pos").alias("doc"), "path", "n_keys", "vtype",
        F.when(~is_float, F.col("text")).alias("text"),
        F.when(is_float, F.col("text").cast("double")).alias("number"),
    )


def _comparable_sql(source: str, pos: str, attributes: list[tuple[str, int, str, str]]) -> str:
    parts = []
    for path, n_keys, vtype, expression in attributes:
        text = "NULL" if vtype == "float" else f"CAST({expression} AS VARCHAR)"
        number = expression if vtype == "float" else "NULL"
        parts.append(
            f"SELECT {pos} AS doc, '{path}' AS path, {n_keys} AS n_keys, '{vtype}' AS vtype, {text} AS text, "
            f"CAST({number} AS DOUBLE) AS number FROM {source} WHERE {expression} IS NOT NULL"
        )
    return " UNION ALL ".join(parts)


def doc_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their JSON properties as nested documents."""
    events = table(spark, sf_dir, "events").withColumn("props", F.try_parse_json("props"))
    return _comparable(observations(events, "event_id"))


def ext_json_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as extended JSON text and read back unwrapped."""
    part = table(spark, sf_dir, "part")
    texts = part.select(F.col("p_partkey").alias("pos"), extended_json(part).alias("text"))
    return _comparable(observations(parse_documents(texts).drop("source_text"), "pos"))


def _patchy_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose segment is missing for machinery and empty for buildings."""
    segment = F.col("c_mktsegment")
    holed = F.when(segment == "BUILDING", F.lit("")).when(segment != "MACHINERY", segment)
    return table(spark, sf_dir, "customer").withColumn("c_mktsegment", holed)


def target_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per nation that have a target."""
    kept = with_target(_patchy_customers(spark, sf_dir), "c_mktsegment")
    return kept.groupBy("c_nationkey").agg(F.count("*").alias("n_docs"))


def type_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2, A3: presence and type mix of attributes that change type between documents."""
    profiled = profile_of(mixed_orders(spark, sf_dir), "pos")
    return profiled.select("path", "present", "n_int", "n_float", "n_string", "n_date", "int_strings", "float_strings")


def value_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of every line item attribute with its count."""
    return freq_of(table(spark, sf_dir, "lineitem"), None).select("path", "text", "n")


def attr_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: most frequent value, ties to the one that got there first."""
    return profile_of(table(spark, sf_dir, "orders"), "o_orderkey").select("path", "mode")


def _texty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.get(
        F.array(*[F.lit(x) for x in ("inf", "NaN", "1e5", ".5", "5.", "1__0", "1d", "0x1F", "-7", "+8 ")]),
        F.col("c_nationkey"),
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.substring("c_name", 10, 9).alias("digits"),
        F.col("c_acctbal").cast("string").alias("balance"),
        F.concat(F.lit(" "), F.col("c_nationkey"), F.lit(" ")).alias("padded"),
        F.concat_ws("_", "c_custkey", "c_nationkey").alias("joined"),
        odd.alias("odd"),
        "c_mktsegment",
    )


_TEXTY_SQL = """(SELECT c_custkey, substr(c_name, 10, 9) AS digits, CAST(c_acctbal AS VARCHAR) AS balance,
  concat(' ', c_nationkey, ' ') AS padded, concat(c_custkey, '_', c_nationkey) AS joined,
  list_extract(['inf', 'NaN', '1e5', '.5', '5.', '1__0', '1d', '0x1F', '-7', '+8 '], c_nationkey + 1) AS odd,
  c_mktsegment FROM customer)"""
_TEXTY_OBS = sql_obs(
    _TEXTY_SQL, "c_custkey",
    [(c, "string", c) for c in ("digits", "balance", "padded", "joined", "odd", "c_mktsegment")],
)


def numeric_string_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that read as whole or fractional numbers."""
    return profile_of(_texty_customers(spark, sf_dir), "c_custkey").select("path", "int_strings", "float_strings")


def attr_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile summary of customers, segment as target."""
    kept = with_target(table(spark, sf_dir, "customer"), "c_mktsegment")
    return profile_of(kept, "c_custkey").select(
        "path", "present", "unique_count", "mode", "int_strings", "float_strings"
    )


def _sized_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    grade = (
        F.when(F.col("p_retailprice") < 950, F.lit("low"))
        .when(F.col("p_retailprice") < 1000, F.lit("mid"))
        .otherwise(F.lit("high"))
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type",
        F.nullif("p_size", F.lit(1)).alias("p_size"), "p_retailprice",
        F.when(F.col("p_size") > 40, F.concat(F.col("p_retailprice").cast("string"), F.lit(" ")))
        .otherwise(F.col("p_size").cast("string"))
        .alias("size_or_price"),
        grade.alias("grade"),
        F.lit("kg").alias("unit"),
        F.when(F.col("p_size") > 25, F.col("p_size")).alias("big_size"),
    )


_PART_SQL = """(SELECT p_partkey, p_name, p_brand, p_type, nullif(p_size, 1) AS p_size, p_retailprice,
  CASE WHEN p_size > 40 THEN concat(p_retailprice, ' ') ELSE CAST(p_size AS VARCHAR) END AS size_or_price,
  CASE WHEN p_retailprice < 950 THEN 'low' WHEN p_retailprice < 1000 THEN 'mid' ELSE 'high' END AS grade,
  'kg' AS unit, CASE WHEN p_size > 25 THEN p_size END AS big_size FROM part)"""
_PART_OBS = sql_obs(
    _PART_SQL, "p_partkey",
    [
        ("p_name", "string", "p_name"), ("p_brand", "string", "p_brand"), ("p_type", "string", "p_type"),
        ("p_size", "int", "p_size"), ("p_retailprice", "float", "p_retailprice"),
        ("size_or_price", "string", "size_or_price"), ("grade", "string", "grade"), ("unit", "string", "unit"),
        ("big_size", "int", "big_size"),
    ],
)
_N_PARTS = "SELECT count(*) FROM part"


def median_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact medians and means of numbers and numeric texts."""
    parts = _sized_parts(spark, sf_dir)
    freq = written(freq_of(parts, "p_partkey"), "value_freq")
    means = profile(freq).select("path", "mean_int", "mean_float")
    both = medians(freq).join(means, "path")
    return both.select("path", *[rounded(c, c) for c in ("median_int", "mean_int", "median_float", "mean_float")])


def long_text_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and modes of the documents table, whose texts are long and nearly unique."""
    found = profile_of(table(spark, sf_dir, "documents"), "doc_id")
    return found.select("path", "present", "unique_count", "n_int", "n_string", "mode")


_PARTS_SPEC = EstimatorSpec("parts", "p_type", pos="p_partkey")
_ORDERS_SPEC = EstimatorSpec("orders", "priority")


def _decisions(plan: DataFrame) -> DataFrame:
    return plan.select("path", "selected", "type", "sense", "reason", "present", "unique_count")


_DECISIONS_SQL = "SELECT path, selected, type, sense, reason, present, unique_count FROM plan"


def type_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions for documents with mixed types."""
    return _decisions(planned(mixed_orders(spark, sf_dir), _ORDERS_SPEC).plan)


def type_plan_promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric texts win ties when asked to."""
    spec = EstimatorSpec("parts", "p_type", pos="p_partkey", schema=SchemaOptions(string_numbers="promote"))
    return _decisions(planned(_sized_parts(spark, sf_dir), spec).plan)


def type_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected attributes with reason and non-zero type counts, one row per type."""
    plan = planned(_sized_parts(spark, sf_dir), _PARTS_SPEC).plan
    return rejected(plan).select(
        "path", "present", "unique_count", "reason", F.explode("extended_counts").alias("type", "type_count")
    )


def _number(column: str) -> Column:
    return rounded(column, column)


def default_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default of every selected attribute."""
    plan = planned(_sized_parts(spark, sf_dir), _PARTS_SPEC).plan
    return plan.where("selected").select("path", "type", "sense", _number("default_number"), "default_text")


def selected_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept attributes without the target."""
    return selected(planned(_sized_parts(spark, sf_dir), _PARTS_SPEC).plan)


def label_encoder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of every categorical attribute in text order."""
    return planned(_sized_parts(spark, sf_dir), _PARTS_SPEC).encoders


_LONG_TEXT_SQL = sql_profile(
    sql_obs(
        "(SELECT doc_id, text AS body, lang, source, n_chars FROM documents)", "doc_id",
        [("text", "string", "body"), ("lang", "string", "lang"), ("source", "string", "source"), ("n_chars", "int", "n_chars")],
    )
) + "SELECT path, present, unique_count, n_int, n_string, mode FROM prof JOIN modes USING (path)"

QUERIES = {
    "long_text_profile": long_text_profile,
    "doc_flatten": doc_flatten,
    "ext_json_unwrap": ext_json_unwrap,
    "target_filter": target_filter,
    "type_histogram": type_histogram,
    "value_frequency": value_frequency,
    "attr_mode": attr_mode,
    "numeric_string_counts": numeric_string_counts,
    "attr_profile": attr_profile,
    "median_mean": median_mean,
    "type_plan": type_plan,
    "type_plan_promoted": type_plan_promoted,
    "type_rejects": type_rejects,
    "default_values": default_values,
    "selected_attrs": selected_attrs,
    "label_encoder": label_encoder,
}

_ORDER_ATTRS = [
    ("o_custkey", "int", "o_custkey"), ("o_orderstatus", "string", "o_orderstatus"),
    ("o_totalprice", "float", "o_totalprice"), ("o_orderdate", "date", "o_orderdate"),
    ("o_orderpriority", "string", "o_orderpriority"),
]
_CUSTOMER_ATTRS = [
    ("c_name", "string", "c_name"), ("c_nationkey", "int", "c_nationkey"), ("c_acctbal", "float", "c_acctbal"),
    ("c_mktsegment", "string", "c_mktsegment"),
]
_LINE_ATTRS = [
    (c, "x", c)
    for c in (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
]

SQL = {
    "long_text_profile": _LONG_TEXT_SQL,
    "doc_flatten": _comparable_sql(
        "events", "event_id",
        [
            ("ts", 1, "date", "ts"), ("user_id", 1, "int", "user_id"), ("event_type", 1, "string", "event_type"),
            ("value", 1, "float", "value"), ("props.k", 2, "int", "regexp_extract(props, '\"k\": (-?[0-9]+)', 1)"),
        ],
    ),
    "ext_json_unwrap": _comparable_sql(
        "part", "p_partkey",
        [
            ("p_partkey", 1, "int", "p_partkey"), ("p_name", 1, "string", "p_name"),
            ("p_brand", 1, "string", "p_brand"), ("p_type", 1, "string", "p_type"),
            ("p_size", 1, "int", "p_size"), ("p_retailprice", 1, "float", "p_retailprice"),
        ],
    ),
    "target_filter": """SELECT c_nationkey, count(*) AS n_docs FROM customer
        WHERE c_mktsegment NOT IN ('MACHINERY', 'BUILDING') GROUP BY c_nationkey""",
    "type_histogram": sql_profile(MIXED_ORDERS_SQL)
    + "SELECT path, present, n_int, n_float, n_string, n_date, int_strings, float_strings FROM prof",
    "value_frequency": f"SELECT path, text, count(*) AS n FROM ({sql_obs('lineitem', '0', _LINE_ATTRS)}) GROUP BY path, text",
    "attr_mode": sql_profile(sql_obs("orders", "o_orderkey", _ORDER_ATTRS)) + "SELECT path, mode FROM modes",
    "numeric_string_counts": sql_profile(_TEXTY_OBS) + "SELECT path, int_strings, float_strings FROM prof",
    "attr_profile": sql_profile(sql_obs("customer", "c_custkey", _CUSTOMER_ATTRS))
    + "SELECT path, present, unique_count, mode, int_strings, float_strings FROM prof JOIN modes USING (path)",
    "median_mean": sql_profile(_PART_OBS)
    + "SELECT path, "
    + ", ".join(f"{sql_round(c)} AS {c}" for c in ("median_int", "mean_int", "median_float", "mean_float"))
    + " FROM middles",
    "type_plan": sql_plan(MIXED_ORDERS_SQL, "SELECT count(*) FROM orders", "priority") + _DECISIONS_SQL,
    "type_plan_promoted": sql_plan(_PART_OBS, _N_PARTS, "p_type", promote=True) + _DECISIONS_SQL,
    "type_rejects": sql_plan(_PART_OBS, _N_PARTS, "p_type")
    + """SELECT plan.path, present, unique_count, reason, kinds.type, kinds.c AS type_count
        FROM plan JOIN kinds USING (path) WHERE NOT selected AND kinds.c > 0""",
    "default_values": sql_plan(_PART_OBS, _N_PARTS, "p_type")
    + f"""SELECT path, type, sense,
        CASE WHEN sense = 'Numerical' THEN {sql_round("CASE WHEN type = 'int' THEN median_int ELSE median_float END")}
        END AS default_number,
        CASE WHEN sense = 'Categorical' THEN mode END AS default_text
        FROM plan LEFT JOIN middles USING (path) JOIN modes USING (path) WHERE selected""",
    "selected_attrs": sql_plan(_PART_OBS, _N_PARTS, "p_type")
    + "SELECT path, type, sense FROM plan WHERE selected AND NOT is_target",
    "label_encoder": sql_plan(_PART_OBS, _N_PARTS, "p_type")
    + """SELECT path, text AS label, CAST(row_number() OVER (PARTITION BY path ORDER BY text) - 1 AS INTEGER) AS idx
        FROM freq WHERE path IN (SELECT path FROM plan WHERE sense = 'Categorical')""",
}
