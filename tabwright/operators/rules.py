"""From profile to plan: type, sense, default or reject reason per path.

Every rule is a column expression over one profile row; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.config import EstimatorSpec
from tabwright.functions.numbers import text_to_double
from tabwright.functions.values import (
    CATEGORICAL, DATE, FLOAT, INT, LEARNING_TYPES, MISSING_TEXT, NUMERICAL, STRING,
)

TOO_SPARSE, SINGLE_VALUE, TOO_MANY_VALUES = "too_sparse", "single_value", "too_many_values"
# Types met only inside strings rank behind every type met natively.
_AFTER_ALL_POSITIONS = 2**62


def extended_counts(int_is_float: bool = False) -> dict[str, Column]:
    """Strings that read as numbers also count toward the numeric types."""
    as_float = F.col("n_float") + F.col("int_strings") + F.col("float_strings")
    if int_is_float:
        as_float = as_float + F.col("n_int")
    return {
        INT: F.col("n_int") + F.col("int_strings"),
        FLOAT: as_float,
        STRING: F.col("n_string"),
        DATE: F.col("n_date"),
    }


def preferred_type(spec: EstimatorSpec, n_docs: int) -> Column:
    """R2: the largest extended count wins when it covers enough documents."""
    opts = spec.schema
    late = {INT: _AFTER_ALL_POSITIONS, FLOAT: _AFTER_ALL_POSITIONS + 1}
    candidates = []
    for name, count in extended_counts(opts.int_is_float).items():
        rank = F.coalesce(F.col(f"first_{name}"), F.lit(late.get(name, _AFTER_ALL_POSITIONS - 1)))
        if name == STRING and opts.string_numbers == "promote":
            rank = F.lit(_AFTER_ALL_POSITIONS + 2)
        candidates.append(F.struct(count.alias("n"), (-rank).alias("rank"), F.lit(name).alias("name")))
    best = F.array_max(F.array(*candidates))
    return F.when(best["n"] / F.lit(n_docs) > F.lit(opts.min_typealign), best["name"])


def attribute_plan(profiled: DataFrame, middles: DataFrame, n_docs: int, spec: EstimatorSpec) -> DataFrame:
    """One row per path with decision, type, sense, default and reason."""
    opts = spec.schema
    rows = profiled.join(middles, "path", "left")
    enough_values = F.col("unique_count") > 1
    enough_rows = F.col("present") / F.lit(n_docs) > F.lit(opts.min_present)
    rows = rows.withColumns(
        {
            "preferred": preferred_type(spec, n_docs),
            "sufficient": enough_values & enough_rows,
            "is_target": F.col("path") == spec.target,
            **{f"ext_{t}": c for t, c in extended_counts(opts.int_is_float).items()},
        }
    )
    numeric = F.col("sufficient") & F.coalesce(F.col("preferred").isin(INT, FLOAT), F.lit(False))
    categorical = F.col("sufficient") & (F.col("unique_count") <= opts.max_categorical)
    if spec.is_regression:
        target_type, target_sense = FLOAT, NUMERICAL
    else:
        target_type, target_sense = STRING, CATEGORICAL
    decided = rows.withColumns(
        {
            "selected": F.col("is_target") | numeric | categorical,
            "type": F.when(F.col("is_target"), F.lit(target_type))
            .when(numeric, F.col("preferred"))
            .when(categorical, F.lit(STRING)),
            "sense": F.when(F.col("is_target"), F.lit(target_sense))
            .when(numeric, F.lit(NUMERICAL))
            .when(categorical, F.lit(CATEGORICAL)),
        }
    ).withColumn(
        "reason",
        F.when(F.col("selected"), F.lit(None).cast("string"))
        .when(~enough_values, F.lit(SINGLE_VALUE))
        .when(~enough_rows, F.lit(TOO_SPARSE))
        .otherwise(F.lit(TOO_MANY_VALUES)),
    )
    return decided.withColumns(
        {
            "default_number": F.when(F.col("sense") == NUMERICAL, numeric_default()),
            "default_text": F.when(F.col("sense") == CATEGORICAL, categorical_default()),
        }
    ).select(
        "path", "selected", "is_target", "type", "sense", "reason", "default_number", "default_text",
        "present", "unique_count", "mode", "int_strings", "float_strings",
        *[f"n_{t}" for t in LEARNING_TYPES], *[f"ext_{t}" for t in LEARNING_TYPES],
        "min_keys", "max_keys",
    )


def numeric_default() -> Column:
    """Median, else mean, else mode, else zero."""
    by_type = F.when(F.col("type") == INT, F.coalesce("median_int", "mean_int")).otherwise(
        F.coalesce("median_float", "mean_float")
    )
    return F.coalesce(by_type, text_to_double(F.col("mode")), F.lit(0.0))


def categorical_default() -> Column:
    """Mode, else first label, else int median, else zero."""
    return F.coalesce("mode", "min_label", F.col("median_int").cast("bigint").cast("string"), F.lit("0"))


def constant_default(type_column: Column) -> Column:
    """The default when neither sense nor mode is known."""
    out = F.lit(None).cast("string")
    for name, text in MISSING_TEXT.items():
        out = F.when(type_column == name, F.lit(text)).otherwise(out)
    return out


def label_encoders(freq: DataFrame, plan: DataFrame) -> DataFrame:
    """Labels in ascending text order, numbered from 0, per categorical path.

    Features have at most ``max_categorical`` labels; only those paths are read again.
    """
    wanted = plan.where((F.col("sense") == CATEGORICAL) & F.col("selected")).select("path")
    return label_order(freq.join(wanted, "path", "left_semi").select("path", F.col("text").alias("label")))


def label_order(labels: DataFrame) -> DataFrame:
    """Codes by ascending text; asked again once the keys of long labels have become texts."""
    return labels.withColumn("idx", (F.row_number().over(W.partitionBy("path").orderBy("label")) - 1).cast("int"))


def rejected(plan: DataFrame) -> DataFrame:
    """Dropped attributes with reason and the non-zero type counts."""
    counts = F.create_map(*[x for t in LEARNING_TYPES for x in (F.lit(t), F.col(f"ext_{t}"))])
    raw = F.create_map(*[x for t in LEARNING_TYPES for x in (F.lit(t), F.col(f"n_{t}"))])
    return plan.where(~F.col("selected")).select(
        "path", "present", "unique_count", "reason",
        F.map_filter(raw, lambda _, n: n > 0).alias("type_counts"),
        F.map_filter(counts, lambda _, n: n > 0).alias("extended_counts"),
    )


def selected(plan: DataFrame) -> DataFrame:
    """Kept attributes without the target."""
    return plan.where(F.col("selected") & ~F.col("is_target")).select("path", "type", "sense")
