"""Dotted attribute paths and the key lists behind them.

A nested ``b.c`` and a flat key ``"b.c"`` share one path text.  The profile records how
many keys each path was reached through, which is enough to list the places to look.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "."
SKIPPED_KEY = "_id"


def quoted(path: str) -> str:
    """Column name that contains dots or blanks, safe for ``F.col``."""
    return "`" + path.replace("`", "``") + "`"


def col(path: str) -> Column:
    return F.col(quoted(path))


def join_path(prefix: Column, key: Column) -> Column:
    return F.when(prefix == "", key).otherwise(F.concat_ws(SEPARATOR, prefix, key))


def key_lists(path: str, min_keys: int | None = None, max_keys: int | None = None) -> list[tuple[str, ...]]:
    """Every way to cut the path into keys, most nested first."""
    parts = path.split(SEPARATOR)
    most = min(max_keys or len(parts), len(parts))
    least = max(min_keys or most, 1)
    found = []
    for n_keys in range(most, least - 1, -1):
        for cuts in combinations(range(1, len(parts)), n_keys - 1):
            edges = [0, *cuts, len(parts)]
            found.append(tuple(SEPARATOR.join(parts[a:b]) for a, b in zip(edges, edges[1:])))
    return found


def variant_at(value: Column, keys: tuple[str, ...]) -> Column:
    """Read one attribute straight from a VARIANT; NULL when absent."""
    for key in keys:
        if '"' not in key:
            value = F.try_variant_get(value, f'$["{key}"]', "variant")
        elif "'" not in key:
            value = F.try_variant_get(value, f"$['{key}']", "variant")
        else:
            value = F.try_variant_get(value, "$", "map<string,variant>")[F.lit(key)]
    return value
