"""Documents from JSON lines, tables and typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.paths import col
from tabwright.functions.values import utc_text


def parse_documents(df: DataFrame, text: str = "text", pos: str | None = "pos") -> DataFrame:
    """(pos, doc, source_text) with ``doc`` NULL where the text is not a JSON document."""
    position = [col(pos).cast("bigint").alias("pos")] if pos else []
    doc = F.try_parse_json(col(text))
    return df.select(*position, doc.alias("doc"), col(text).alias("source_text"))


def readable(parsed: DataFrame) -> DataFrame:
    """Documents that parsed to an object."""
    is_object = F.schema_of_variant("doc").startswith("OBJECT<")
    return parsed.where(F.col("doc").isNotNull() & is_object).drop("source_text")


def unreadable(parsed: DataFrame) -> DataFrame:
    """Non-blank texts that are no JSON object, kept for inspection."""
    is_object = F.coalesce(F.schema_of_variant("doc").startswith("OBJECT<"), F.lit(False))
    return parsed.where(~is_object & (F.trim("source_text") != "")).drop("doc")


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Line-delimited documents, numbered in file order."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("pos"), F.col("value").alias("text"))
    return parse_documents(lines)


def as_documents(df: DataFrame, pos: str) -> DataFrame:
    """A typed table as documents: one VARIANT per row."""
    body = F.struct(*[col(c) for c in df.columns])
    return df.select(col(pos).cast("bigint").alias("pos"), F.to_variant_object(body).alias("doc"))


def iso_text(column: Column, dtype: T.DataType) -> Column:
    """ISO text of a date column; instants end in Z, zone-less ones carry no zone."""
    if isinstance(dtype, T.TimestampType):
        return F.concat(F.replace(utc_text(column), F.lit(" "), F.lit("T")), F.lit("Z"))
    return F.replace(column.cast("timestamp_ntz").cast("string"), F.lit(" "), F.lit("T"))


def _wrapped(column: Column, dtype: T.DataType) -> Column:
    text = column.cast("string")
    if isinstance(dtype, T.LongType):
        return F.struct(text.alias("$numberLong"))
    if isinstance(dtype, T.IntegralType):
        return F.struct(text.alias("$numberInt"))
    if isinstance(dtype, T.FractionalType):
        return F.struct(column.cast("double").cast("string").alias("$numberDouble"))
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.struct(iso_text(column, dtype).alias("$date"))
    return column


def extended_json(df: DataFrame) -> Column:
    """A row as one JSON text with every number and date in its wrapper; NULLs left out."""
    fields = []
    for field in df.schema.fields:
        column = _wrapped(col(field.name), field.dataType)
        fields.append(F.when(col(field.name).isNotNull(), column).alias(field.name))
    return F.to_json(F.struct(*fields))


def write_json_lines(df: DataFrame, path: str) -> None:
    """Replace the folder with line-delimited extended JSON."""
    df.select(extended_json(df).alias("value")).write.mode("overwrite").text(path)


__all__ = [
    "as_documents", "extended_json", "parse_documents", "read_json_lines", "readable",
    "unreadable", "write_json_lines",
]
