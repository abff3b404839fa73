"""What a single value is: type name, number and text.

A ``Cell`` is three column expressions over one value.  Documents (VARIANT) decide the
type per value; typed columns know it beforehand and skip the work.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.numbers import finite_or_inf

INT, FLOAT, STRING, DATE, UNKNOWN = "int", "float", "string", "date", "unknown"
LEARNING_TYPES = [INT, FLOAT, STRING, DATE]
NUMERICAL, CATEGORICAL = "Numerical", "Categorical"

# Single-key objects that wrap one scalar, and what a broken wrapper holds.
WRAPPER_KEYS = ["$numberDouble", "$numberLong", "$numberInt", "$date"]
MISSING_TEXT = {INT: "0", FLOAT: "0.0", STRING: "", DATE: "1970-01-01 00:00:00"}


@dataclass(frozen=True)
class Cell:
    vtype: Column   # int, float, string, date, unknown; NULL when absent
    number: Column  # double for int and float, NULL otherwise
    text: Column    # canonical text key
    string: Column  # the content where vtype is string


# What each VARIANT tag or wrapper key is to the profile.
KIND_TYPES = {
    "BIGINT": INT, "BOOLEAN": INT, "DOUBLE": FLOAT, "FLOAT": FLOAT, "DECIMAL": FLOAT, "STRING": STRING,
    "DATE": DATE, "TIMESTAMP": DATE, "TIMESTAMP_NTZ": DATE,
    "$numberDouble": FLOAT, "$numberLong": INT, "$numberInt": INT, "$date": DATE,
}


def as_object(value: Column) -> Column:
    """Keys and values of an object, NULL for anything else."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def wrapper_key(fields: Column) -> Column:
    """Key of a single-key wrapper object, NULL for ordinary objects."""
    first = F.try_element_at(F.map_keys(fields), F.lit(1))
    return F.when((F.size(fields) == 1) & first.isin(WRAPPER_KEYS), first)


def utc_text(stamp: Column) -> Column:
    """Text of an instant in UTC whatever the session zone is."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), stamp.cast("timestamp_ntz")).cast("string")


def _has_zone(text: Column) -> Column:
    return text.rlike(r":.*(Z|[+-]\d\d:?\d\d)$")


def iso_text_to_date_text(text: Column) -> Column:
    """ISO date text, with or without a zone, as canonical UTC text."""
    return F.when(_has_zone(text), utc_text(text.try_cast("timestamp"))).otherwise(
        text.try_cast("timestamp_ntz").cast("string")
    )


def variant_date_text(kind: Column, core: Column) -> Column:
    """UTC text of a native date, ISO text or milliseconds."""
    zoned = (kind == "TIMESTAMP") | F.coalesce(_has_zone(F.try_variant_get(core, "$", "string")), F.lit(False))
    stamp = F.when(zoned, utc_text(F.try_variant_get(core, "$", "timestamp"))).otherwise(
        F.try_variant_get(core, "$", "timestamp_ntz").cast("string")
    )
    millis = F.coalesce(
        F.try_variant_get(core, '$["$numberLong"]', "bigint"), F.try_variant_get(core, "$", "bigint")
    )
    return F.coalesce(stamp, utc_text(F.timestamp_millis(millis)))


def variant_kinds(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add ``<c>_kind`` (VARIANT tag or wrapper key), ``<c>_core`` (the value, unwrapped)
    and ``<c>_type`` for every named VARIANT column, replacing the column itself.

    Each fact is computed once, in a projection of its own, so later expressions stay
    small enough to be compiled.
    """
    first = {f"{c}_fields": as_object(F.col(c)) for c in columns}
    first |= {f"{c}_tag": F.schema_of_variant(c) for c in columns}
    second = {f"{c}_wrap": wrapper_key(F.col(f"{c}_fields")) for c in columns}
    third, fourth = {}, {}
    known = F.create_map(*[F.lit(x) for pair in KIND_TYPES.items() for x in pair])
    for c in columns:
        wrap = F.col(f"{c}_wrap")
        third[f"{c}_kind"] = F.coalesce(wrap, F.substring_index(f"{c}_tag", "(", 1))
        third[f"{c}_core"] = F.when(wrap.isNull(), F.col(c)).otherwise(F.try_element_at(f"{c}_fields", wrap))
        fourth[f"{c}_type"] = F.when(
            F.col(f"{c}_kind") != "VOID", F.coalesce(F.try_element_at(known, F.col(f"{c}_kind")), F.lit(UNKNOWN))
        )
    spent = [x for c in columns for x in (c, f"{c}_fields", f"{c}_tag", f"{c}_wrap")]
    return df.withColumns(first).withColumns(second).withColumns(third).drop(*spent).withColumns(fourth)


def scalar_kinds(df: DataFrame, columns: list[str]) -> DataFrame:
    """:func:`variant_kinds` for columns without objects: the tag alone decides."""
    known = F.create_map(*[F.lit(x) for pair in KIND_TYPES.items() for x in pair])
    first = {f"{c}_kind": F.substring_index(F.schema_of_variant(c), "(", 1) for c in columns}
    second = {
        f"{c}_type": F.when(F.col(f"{c}_kind") != "VOID", F.coalesce(F.try_element_at(known, F.col(f"{c}_kind")), F.lit(UNKNOWN)))
        for c in columns
    }
    return df.withColumns(first).withColumns(second).withColumnsRenamed({c: f"{c}_core" for c in columns})


def variant_cell(name: str) -> Cell:
    """Cell of a VARIANT column after ``variant_kinds``; a broken wrapper holds its missing value."""
    vtype, kind, core = F.col(f"{name}_type"), F.col(f"{name}_kind"), F.col(f"{name}_core")
    as_double = F.try_variant_get(core, "$", "double")
    string = F.try_variant_get(core, "$", "string")
    text = (
        F.when(vtype == STRING, string)
        .when(vtype == INT, F.coalesce(F.try_variant_get(core, "$", "bigint").cast("string"), F.lit(MISSING_TEXT[INT])))
        .when(vtype == FLOAT, F.coalesce(as_double.cast("string"), F.lit(MISSING_TEXT[FLOAT])))
        .when(vtype == DATE, F.coalesce(variant_date_text(kind, core), F.lit(MISSING_TEXT[DATE])))
    )
    number = F.when(vtype.isin(INT, FLOAT), finite_or_inf(F.coalesce(as_double, F.lit(0.0))))
    return Cell(vtype, number, text, string)


def column_type(dtype: T.DataType) -> str | None:
    """Type name of a typed column; None when it can never be an attribute."""
    if isinstance(dtype, (T.BooleanType, T.IntegralType)):
        return INT
    if isinstance(dtype, T.FractionalType):
        return FLOAT
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return STRING
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return DATE
    return None


def typed_cell(value: Column, dtype: T.DataType) -> Cell | None:
    """Cell of a typed column; its type is known, so only NULL remains to be asked."""
    name = column_type(dtype)
    if name is None:
        return None
    number, text = F.lit(None).cast("double"), value
    if name == INT:
        whole = value.cast("int") if isinstance(dtype, T.BooleanType) else value
        number, text = whole.cast("double"), whole.cast("string")
    elif name == FLOAT:
        number, text = finite_or_inf(value.cast("double")), value.cast("double").cast("string")
    elif isinstance(dtype, T.TimestampType):
        text = utc_text(value)
    elif name == DATE:
        text = value.cast("timestamp_ntz").cast("string")
    return Cell(F.when(value.isNotNull(), F.lit(name)), number, text, text)
