"""Rows fitted to the plan: typed, complete, or set aside with a reason.

Cleaning reads each attribute straight from its column or VARIANT path, so it is one
narrow select: no shuffle, and the same code runs on a stream.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.numbers import is_int_text, text_to_double, whole_part
from tabwright.functions.paths import col
from tabwright.functions.values import (
    CATEGORICAL, DATE, FLOAT, INT, NUMERICAL, STRING, UNKNOWN, Cell, iso_text_to_date_text, typed_cell, variant_cell,
    variant_kinds,
)
from tabwright.operators.observe import Layout, Leaf

MISSING_TARGET = "missing_target"
BAD_TARGET = "bad_target"
UNSUPPORTED_TYPE = "unsupported_type"
TOO_MANY_DEFAULTS = "too_many_defaults"
UNREADABLE = "unreadable"
ROW, REASON = "_values", "_reason"


@dataclass(frozen=True)
class Attribute:
    """One selected attribute as the driver needs it to write the select."""

    path: str
    type: str
    sense: str
    is_target: bool
    default_number: float | None
    default_text: str | None
    min_keys: int | None = None
    max_keys: int | None = None
    labels: tuple[str, ...] | None = None


def selected_attributes(plan: DataFrame, encoders: DataFrame | None = None) -> list[Attribute]:
    """The selected part of the plan; at most as many rows as a document has attributes."""
    wanted = plan.where("selected")
    if encoders is not None:
        labels = encoders.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("idx", "label"))).alias("ls"))
        wanted = wanted.join(labels, "path", "left").withColumn("labels", F.col("ls.label"))
    else:
        wanted = wanted.withColumn("labels", F.lit(None).cast("array<string>"))
    rows = wanted.orderBy("path").collect()
    return [
        Attribute(
            r["path"], r["type"], r["sense"], r["is_target"], r["default_number"], r["default_text"],
            r["min_keys"], r["max_keys"], tuple(r["labels"]) if r["labels"] is not None else None,
        )
        for r in rows
    ]


def _as_number(cell: Cell, wanted: str) -> Column:
    """number of the wanted kind or NULL when the value cannot be one."""
    native = whole_part(cell.number) if wanted == INT else cell.number
    parsed = text_to_double(cell.string)
    if wanted == INT:
        parsed = F.when(is_int_text(cell.string), parsed)
    return F.when(cell.vtype == STRING, parsed).otherwise(native)


def _as_text(cell: Cell, wanted: str) -> Column:
    """text of the value; dates must read as one."""
    if wanted == DATE:
        return F.when(cell.vtype == DATE, cell.text).when(cell.vtype == STRING, iso_text_to_date_text(cell.string))
    return cell.text


def _typed_shortcut(leaf: Leaf, attr: Attribute) -> Column | None:
    """Typed columns that already have the wanted type need no per-value decision."""
    dtype = leaf.dtype
    if attr.sense == NUMERICAL and isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return leaf.column.cast("int").cast("double") if isinstance(dtype, T.BooleanType) else leaf.column.cast("double")
    if attr.sense == NUMERICAL and attr.type == FLOAT and isinstance(dtype, T.FractionalType):
        number = leaf.column.cast("double")
        return F.when(~F.isnan(number), number)
    if attr.sense == CATEGORICAL and isinstance(dtype, T.StringType):
        return leaf.column
    return None


def clean_columns(
    df: DataFrame,
    attributes: list[Attribute],
    pos: str | None,
    target_needed: bool = True,
    strict_target: bool = False,
    unsupported: str = "missing",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``_values`` holds every selected attribute, ``_reason`` the verdict (NULL = keep).

    ``unsupported="reject"`` drops rows holding an array or object where a scalar is
    expected (P8); the default treats such values as absent, as flattening does.
    """
    layout = Layout(df.schema, (pos,) if pos else ())
    attributes = [a for a in attributes if target_needed or not a.is_target]
    kept = [*([col(pos).alias("pos")] if pos else []), *[col(k) for k in keep]]

    # First fetch each VARIANT once, then decide on it.
    sources = {a.path: layout.source(a.path, a.min_keys, a.max_keys) for a in attributes}
    fetched = {f"_v{i}": sources[a.path] for i, a in enumerate(attributes) if isinstance(sources[a.path], Column)}
    if fetched:
        df = variant_kinds(df.withColumns(fetched), list(fetched))

    values, absent = [], F.lit(False)
    unknown = F.lit(False)
    for i, attr in enumerate(attributes):
        source = sources[attr.path]
        shortcut = _typed_shortcut(source, attr) if isinstance(source, Leaf) else None
        cell = None
        if shortcut is not None:
            value, missing = shortcut, source.column.isNull()
        else:
            if isinstance(source, Leaf):
                cell = typed_cell(source.column, source.dtype)
            elif source is not None:
                cell = variant_cell(f"_v{i}")
            if cell is None:
                value, missing = F.lit(None), F.lit(True)
            else:
                value = _as_number(cell, attr.type) if attr.sense == NUMERICAL else _as_text(cell, attr.type)
                missing = cell.vtype.isNull() | (cell.vtype == UNKNOWN)
                unknown = unknown | F.coalesce(cell.vtype == UNKNOWN, F.lit(False))
        values.append(value.cast("double" if attr.sense == NUMERICAL else "string").alias(f"_r{i}"))
        if attr.is_target:
            absent = missing

    read = df.select(*kept, *values, absent.alias("_absent"), unknown.alias("_unknown"))
    # From here on every value is a plain column: NULL means the default steps in.
    used, row, target_value = F.lit(0), [], None
    for i, attr in enumerate(attributes):
        default = F.lit(attr.default_number).cast("double") if attr.sense == NUMERICAL else F.lit(attr.default_text)
        row.append(F.coalesce(f"_r{i}", default).alias(attr.path))
        used = used + F.col(f"_r{i}").isNull().cast("int")
        if attr.is_target:
            target_value = F.col(f"_r{i}")
    read = read.select(*[c for c in read.columns], used.alias("_defaults_used"))
    reason = F.when(F.col("_absent"), F.lit(MISSING_TARGET))
    if strict_target and target_value is not None:
        reason = reason.when(target_value.isNull(), F.lit(BAD_TARGET))
    if unsupported == "reject":
        reason = reason.when(F.col("_unknown"), F.lit(UNSUPPORTED_TYPE))
    reason = reason.when(F.col("_defaults_used") > 1 + len(attributes) // 10, F.lit(TOO_MANY_DEFAULTS))
    names = [*(["pos"] if pos else []), *keep]
    return read.select(*[col(n) for n in names], F.struct(*row).alias(ROW), "_defaults_used", reason.alias(REASON))


def accepted(checked: DataFrame) -> DataFrame:
    """Rows that passed, without the bookkeeping.

    The verdict decides inside a generator, so it is computed once: a filter would be
    moved below the projection and every value computed twice.
    """
    names = [col(c) for c in checked.columns if c not in (ROW, REASON, "_defaults_used")]
    return checked.select(*names, F.inline(F.when(F.col(REASON).isNull(), F.array(ROW))))


def quarantined(checked: DataFrame) -> DataFrame:
    """Rows set aside, with the reason and the number of defaults they would have needed."""
    names = [col(c) for c in checked.columns if c not in (ROW, REASON, "_defaults_used")]
    aside = F.struct(f"{ROW}.*", "_defaults_used", REASON)
    return checked.select(*names, F.inline(F.when(F.col(REASON).isNotNull(), F.array(aside))))


def feature_names(attributes: list[Attribute]) -> list[str]:
    """Selected paths in plan order, target left out."""
    return [a.path for a in attributes if not a.is_target]


def target_attribute(attributes: list[Attribute]) -> Attribute:
    return next(a for a in attributes if a.is_target)


__all__ = [
    "Attribute", "accepted", "clean_columns", "feature_names", "quarantined",
    "selected_attributes", "target_attribute",
]
