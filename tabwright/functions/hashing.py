"""Seeded, engine-independent hash numbers.

The first 15 hex digits of an md5 give a 60-bit number that any SQL engine can
recompute, so splits, draws and permutations are repeatable and checkable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 16**15


def hash_number(*parts: Column | str | int) -> Column:
    """md5 of the parts joined by ':' as a whole number in [0, 16^15).

    A str names a column, an int is a constant.
    """
    texts = [(F.col(p) if isinstance(p, str) else p if isinstance(p, Column) else F.lit(p)).cast("string") for p in parts]
    digest = F.md5(F.concat_ws(":", *texts).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def unit_hash(*parts: Column | str | int) -> Column:
    """The same number scaled to [0, 1)."""
    return hash_number(*parts).cast("double") / F.lit(float(HASH_RANGE))
