"""Typed tables from delimited text: the four known data sets.

Numbers are read as text-tolerant doubles first (values like ``.28``), whole-number
columns are cast afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.paths import col
from tabwright.sources.scratch import written


@dataclass(frozen=True)
class TableFormat:
    columns: tuple[tuple[str, str], ...]   # name, type: int, double or string
    header: bool = False
    padded: bool = False                   # separator is a comma and blanks


# Field names, their order and their types.
IRIS = TableFormat((
    ("sepal_length", "double"), ("sepal_width", "double"), ("petal_length", "double"),
    ("petal_width", "double"), ("class", "string"),
))
WINE = TableFormat((
    ("class", "int"), ("alcohol", "double"), ("malic_acid", "double"), ("ash", "double"),
    ("alcalinity_ash", "double"), ("magnesium", "int"), ("total_phenols", "double"),
    ("flavanoids", "double"), ("nf_phenols", "double"), ("proanthocyanins", "double"),
    ("color_intensity", "double"), ("hue", "double"), ("od_ratio", "double"), ("proline", "int"),
))
ADULT = TableFormat((
    ("age", "int"), ("workclass", "string"), ("fnlwgt", "double"), ("education", "string"),
    ("ed_num_yrs", "double"), ("marital_status", "string"), ("occupation", "string"),
    ("relationship", "string"), ("race", "string"), ("sex", "string"), ("cap_gain", "double"),
    ("cap_loss", "double"), ("hours_per_week", "double"), ("native_country", "string"),
    ("income_class", "string"),
), padded=True)
EARLY_DIABETES = TableFormat((
    ("Age", "int"), ("Gender", "string"), ("Polyuria", "string"), ("Polydipsia", "string"),
    ("sudden weight loss", "string"), ("weakness", "string"), ("Polyphagia", "string"),
    ("Genital thrush", "string"), ("visual blurring", "string"), ("Itching", "string"),
    ("Irritability", "string"), ("delayed healing", "string"), ("partial paresis", "string"),
    ("muscle stiffness", "string"), ("Alopecia", "string"), ("Obesity", "string"), ("class", "string"),
), header=True)


_BAD = "_bad_row"


def _raw(spark: SparkSession, path: str, layout: TableFormat) -> DataFrame:
    types = ", ".join(f"`{name}` {'string' if kind == 'string' else 'double'}" for name, kind in layout.columns)
    return (
        spark.read.schema(f"{types}, {_BAD} string")
        .option("header", layout.header)
        .option("enforceSchema", True)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", layout.padded)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BAD)
        .csv(path)
    )


def read_delimited(spark: SparkSession, path: str, layout: TableFormat) -> DataFrame:
    """Rows with the wanted types; blank lines are left out, rows that do not fit go to ``bad_rows``."""
    rows = _raw(spark, path, layout).where(col(_BAD).isNull()).drop(_BAD).na.drop("all")
    return rows.select(
        *[(col(name).cast("bigint") if kind == "int" else col(name)).alias(name) for name, kind in layout.columns]
    )


def bad_rows(spark: SparkSession, path: str, layout: TableFormat) -> DataFrame:
    """The lines that do not fit the layout: a text in a number field, too many or too few fields.

    Spark gives the raw line only beside parsed fields, so the parsed rows are saved first.
    """
    return written(_raw(spark, path, layout), "parsed").where(col(_BAD).isNotNull()).select(F.col(_BAD).alias("line"))


def numbered(df: DataFrame) -> DataFrame:
    """Add the file-order position that settles ties."""
    return df.withColumn("pos", F.monotonically_increasing_id())
