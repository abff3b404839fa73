"""Category text to code and back."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.paths import col
from tabwright.functions.values import CATEGORICAL
from tabwright.operators.clean import Attribute

ERROR, KEEP, DEFAULT = "error", "keep", "default"
# A literal map is searched value by value; longer label lists go through a join.
LITERAL_LABELS = 64


def code_of(value: Column, attr: Attribute, unseen: str = ERROR) -> Column:
    """Code of a label; ``unseen`` says what a label without a code becomes."""
    labels = attr.labels or ()
    pairs = list(chain.from_iterable((F.lit(label), F.lit(i)) for i, label in enumerate(labels)))
    code = F.try_element_at(F.create_map(*pairs), value) if pairs else F.lit(None).cast("int")
    if unseen == KEEP:
        return F.coalesce(code, F.lit(len(labels)))
    if unseen == DEFAULT:
        fallback = labels.index(attr.default_text) if attr.default_text in labels else 0
        return F.coalesce(code, F.lit(fallback))
    message = F.concat(F.lit(f"unseen category in {attr.path}: "), F.coalesce(value, F.lit("NULL")))
    return F.coalesce(code, F.raise_error(message).cast("int"))


def encode_rows(df: DataFrame, attributes: list[Attribute], unseen: str = ERROR) -> DataFrame:
    """Replace every categorical column by its code; other columns stay."""
    coded = {a.path: a for a in attributes if a.sense == CATEGORICAL and a.path in df.columns}
    short = {p: a for p, a in coded.items() if len(a.labels or ()) <= LITERAL_LABELS}
    out = df.select(*[code_of(col(c), short[c], unseen).alias(c) if c in short else col(c) for c in df.columns])
    for path, attr in coded.items():
        if path not in short:
            out = _encode_by_join(out, attr, unseen)
    return out.select(*[col(c) for c in df.columns])


def _encode_by_join(df: DataFrame, attr: Attribute, unseen: str) -> DataFrame:
    # The label table's size decides the join: Spark broadcasts it only under its threshold.
    labels = list(attr.labels or ())
    table = df.sparkSession.createDataFrame(list(enumerate(labels)), "_idx int, _label string")
    joined = df.join(table, col(attr.path) == F.col("_label"), "left")
    if unseen == KEEP:
        code = F.coalesce("_idx", F.lit(len(labels)))
    elif unseen == DEFAULT:
        code = F.coalesce("_idx", F.lit(labels.index(attr.default_text) if attr.default_text in labels else 0))
    else:
        message = F.concat(F.lit(f"unseen category in {attr.path}: "), F.coalesce(col(attr.path), F.lit("NULL")))
        code = F.coalesce("_idx", F.raise_error(message).cast("int"))
    return joined.withColumn(attr.path, code).drop("_idx", "_label")


def decode(code: Column, attr: Attribute) -> Column:
    """Label of a code, NULL for a code without one."""
    labels = F.array(*[F.lit(label) for label in attr.labels or ()])
    return F.try_element_at(labels, code.cast("int") + 1)


def target_labels(encoders: DataFrame, target: str) -> DataFrame:
    """Labels of the target in code order."""
    return encoders.where(F.col("path") == target).select("idx", "label").orderBy("idx")


def senses(attributes: list[Attribute]) -> list[str]:
    """E5: sense of every feature in column order."""
    return [a.sense for a in attributes if not a.is_target]
