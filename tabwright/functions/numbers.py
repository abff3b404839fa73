"""Numbers written as text.

Spark, other SQL engines and Python disagree on what ``cast`` accepts, so a pattern
decides first and the cast only ever sees text in a form all of them read alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted text forms of whole and fractional numbers.
INT_TEXT = r"^\s*[+-]?\d+(_\d+)*\s*$"
FLOAT_TEXT = (
    r"^\s*[+-]?((\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?"
    r"|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$"
)


def is_int_text(text: Column) -> Column:
    return text.rlike(INT_TEXT)


def is_float_text(text: Column) -> Column:
    return text.rlike(FLOAT_TEXT)


def finite_or_inf(number: Column) -> Column:
    """NaN carries no order and no mean, so it counts as no number."""
    return F.when(~F.isnan(number), number)


def text_to_double(text: Column) -> Column:
    """Number held by the text, NULL when it holds none (or NaN)."""
    bare = F.regexp_replace(text, r"[\s_]", "")
    return F.when(is_float_text(text), finite_or_inf(bare.try_cast("double")))


def whole_part(number: Column) -> Column:
    """Truncate toward zero, NULL for infinities (they have no whole part)."""
    return finite_or_inf(number - number % F.lit(1.0))
