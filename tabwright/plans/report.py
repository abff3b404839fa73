"""Report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.paths import quoted
from tabwright.functions.values import INT, NUMERICAL
from tabwright.operators.clean import Attribute


def sample_request(df: DataFrame) -> DataFrame:
    """The one-row table of defaults as the JSON text a client would send."""
    return df.select(F.to_json(F.struct(*[F.col(quoted(c)) for c in df.columns])).alias("request"))


def default_row(spark, attributes: list[Attribute]) -> DataFrame:
    """One row holding the default of every feature: numbers bare, texts quoted."""
    values = []
    for a in attributes:
        if a.is_target:
            continue
        if a.sense != NUMERICAL:
            values.append(F.lit(a.default_text).alias(a.path))
        elif a.type == INT and float(a.default_number).is_integer():
            values.append(F.lit(int(a.default_number)).alias(a.path))
        else:
            values.append(F.lit(float(a.default_number)).alias(a.path))
    return spark.range(1).select(*values)
