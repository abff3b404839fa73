"""Documents and typed tables as one long table of observations.

``observations(pos, path, n_keys, vtype, text)`` holds one row per document and attribute.
Where the attributes of documents lie is read from the data first (``operators.discovery``), at any
depth; flattening then is one select of the paths found. It happens inside each row, so it is a narrow
step: no shuffle, and the VARIANT is dropped before anything is grouped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.paths import SEPARATOR, SKIPPED_KEY, col, join_path, key_lists, variant_at
from tabwright.functions.values import (
    FLOAT, INT, KIND_TYPES, MISSING_TEXT, UNKNOWN, Cell, as_object, column_type, scalar_kinds, typed_cell, variant_cell,
    variant_kinds, wrapper_key,
)
from tabwright.operators.discovery import ANY, NUMBER, SCALAR, WRAPPED, Discovered, VariantLeaf, discover

DOCUMENT = "doc"
#: A select of more paths than this is slow to compile; such documents are opened level by level.
WRITTEN_PATHS = 1000


@dataclass(frozen=True)
class Leaf:
    """Typed column, reachable without looking at the data."""

    keys: tuple[str, ...]
    column: Column
    dtype: T.DataType

    @property
    def path(self) -> str:
        return SEPARATOR.join(self.keys)


class Layout:
    """Where the attributes of a table live: typed leaves, VARIANT columns, or both.

    A VARIANT column named ``doc`` is the document itself; any other VARIANT or map
    column is a sub-document under its own name.
    """

    def __init__(self, schema: T.StructType, skip: tuple[str, ...] = ()):
        self.leaves: list[Leaf] = []
        self.variants: list[tuple[tuple[str, ...], Column]] = []
        for field in schema.fields:
            if field.name in skip or field.name == SKIPPED_KEY:
                continue
            if field.name == DOCUMENT and isinstance(field.dataType, T.VariantType):
                self.variants.append(((), col(field.name)))
            else:
                self._walk((field.name,), col(field.name), field.dataType)

    def _walk(self, keys: tuple[str, ...], column: Column, dtype: T.DataType) -> None:
        if isinstance(dtype, T.StructType):
            for field in dtype.fields:
                if field.name != SKIPPED_KEY:
                    self._walk((*keys, field.name), column.getField(field.name), field.dataType)
        elif isinstance(dtype, T.VariantType):
            self.variants.append((keys, column))
        elif isinstance(dtype, T.MapType) and isinstance(dtype.keyType, T.StringType):
            self.variants.append((keys, F.to_variant_object(column)))
        else:
            self.leaves.append(Leaf(keys, column, dtype))

    def source(self, path: str, min_keys: int | None = None, max_keys: int | None = None):
        """The typed leaf of a path, or a VARIANT expression that reads it."""
        for leaf in self.leaves:
            if leaf.path == path:
                return leaf
        places = []
        for prefix, column in self.variants:
            head = SEPARATOR.join(prefix)
            if not prefix:
                rest, used = path, 0
            elif path == head:
                places.append(column)
                continue
            elif path.startswith(head + SEPARATOR):
                rest, used = path[len(head) + 1 :], len(prefix)
            else:
                continue
            low = max(min_keys - used, 1) if min_keys else None
            high = max(max_keys - used, 1) if max_keys else None
            places += [variant_at(column, keys) for keys in key_lists(rest, low, high)]
        if not places:
            return None
        return F.coalesce(*places) if len(places) > 1 else places[0]

    def fixed_types(self) -> dict[str, tuple[str, int]] | None:
        """(type, number of keys) per path, or None when values decide their own type."""
        if self.variants or len({leaf.path for leaf in self.leaves}) < len(self.leaves):
            return None
        kinds = {leaf.path: (column_type(leaf.dtype), len(leaf.keys)) for leaf in self.leaves}
        return {path: kind for path, kind in kinds.items() if kind[0]}


def _is_open(fields: Column) -> Column:
    """An ordinary object: its keys are attributes of their own."""
    return fields.isNotNull() & wrapper_key(fields).isNull()


def _open_level(nodes: DataFrame) -> DataFrame:
    """Replace every open object by its children; other values pass through."""
    spark = nodes.sparkSession
    opened = nodes.select("*", as_object(F.col("value")).alias("_fields"))
    marked = opened.select(*nodes.columns, F.coalesce(_is_open(F.col("_fields")), F.lit(False)).alias("open"))
    is_open = F.col("open")
    members = spark.tvf.variant_explode_outer(F.when(is_open, F.col("value")).outer()).toDF("_at", "_key", "_child")
    # An open object without members yields one row without a key, which goes away here.
    kept = marked.lateralJoin(members).where(~is_open | (F.col("_key") != SKIPPED_KEY))
    return kept.select(
        "pos",
        F.when(is_open, join_path(F.col("path"), F.col("_key"))).otherwise(F.col("path")).alias("path"),
        (F.col("n_keys") + is_open.cast("int")).alias("n_keys"),
        F.when(is_open, F.col("_child")).otherwise(F.col("value")).alias("value"),
    )


def _opened_observations(df: DataFrame, position: Column, layout: Layout, depth: int) -> DataFrame:
    """Every object opened level by level: for documents with very many paths."""
    roots = [
        F.struct(F.lit(SEPARATOR.join(prefix)).alias("path"), F.lit(len(prefix)).alias("n_keys"), root.alias("value"))
        for prefix, root in layout.variants
    ]
    nodes = df.select(position.alias("pos"), F.inline(F.array(*roots)) if len(roots) > 1 else roots[0].alias("_root"))
    if len(roots) == 1:
        nodes = nodes.select("pos", "_root.*")
    for _ in range(depth):
        nodes = _open_level(nodes)
    facts = variant_kinds(nodes, ["value"])
    cell = variant_cell("value")
    entry = F.struct("path", "n_keys", cell.vtype.alias("vtype"), cell.text.alias("text"))
    # An object without members at the last level is no value.
    is_value = cell.vtype.isNotNull() & ~F.col("value_kind").startswith("OBJECT<")
    # Going through a generator keeps the type test behind the projection that computes it.
    return facts.select("pos", F.inline(F.when(is_value, F.array(entry))))


def _entry(keys: tuple[str, ...], vtype: Column, text: Column) -> Column:
    return F.struct(F.lit(SEPARATOR.join(keys)).alias("path"), F.lit(len(keys)).alias("n_keys"), vtype.alias("vtype"), text.alias("text"))


def _selected_observations(df: DataFrame, position: Column, leaves: list[VariantLeaf], keep_unknown: bool) -> DataFrame:
    """One select of the paths found; only values of changing type are looked at one by one."""
    leaves = [leaf for leaf in leaves if keep_unknown or leaf.kind != UNKNOWN]
    fetched = {f"_v{i}": leaf.read() for i, leaf in enumerate(leaves)}
    rows = df.select(position.alias("pos"), *[value.alias(name) for name, value in fetched.items()])
    rows = variant_kinds(rows, [f"_v{i}" for i, leaf in enumerate(leaves) if leaf.kind in (ANY, UNKNOWN)])
    rows = scalar_kinds(rows, [f"_v{i}" for i, leaf in enumerate(leaves) if leaf.kind == SCALAR])
    entries = []
    for i, leaf in enumerate(leaves):
        name = f"_v{i}"
        if leaf.kind in (ANY, UNKNOWN):
            cell = variant_cell(name)
            # An object's values are attributes of their own.
            entries.append(_entry(leaf.keys, F.when(~F.col(f"{name}_kind").startswith("OBJECT<"), cell.vtype), cell.text))
        elif leaf.kind == SCALAR:
            cell = variant_cell(name)
            entries.append(_entry(leaf.keys, cell.vtype, cell.text))
        elif leaf.kind == WRAPPED:
            vtype = KIND_TYPES[leaf.wrapper]
            text = F.try_variant_get(name, "$", "bigint" if vtype == INT else "double").cast("string")
            text = F.coalesce(text, F.lit(MISSING_TEXT[vtype]))
            entries.append(_entry(leaf.keys, F.when(F.col(name).isNotNull(), F.lit(vtype)), text))
        elif leaf.kind == NUMBER:
            whole = F.schema_of_variant(name) == "BIGINT"
            number = F.when(whole, F.try_variant_get(name, "$", "bigint").cast("string")).otherwise(
                F.try_variant_get(name, "$", "double").cast("string")
            )
            vtype = F.when(whole, F.lit(INT)).when(F.try_variant_get(name, "$", "double").isNotNull(), F.lit(FLOAT))
            entries.append(_entry(leaf.keys, vtype, number))
        else:
            text = F.col(name).cast("string")
            entries.append(_entry(leaf.keys, F.when(text.isNotNull(), F.lit(leaf.kind)), text))
    if not entries:
        empty = F.struct(F.lit("").alias("path"), F.lit(0).alias("n_keys"), F.lit(None).cast("string").alias("vtype"), F.lit("").alias("text"))
        entries = [empty]
    return rows.select("pos", F.inline(F.array(*entries))).where(F.col("vtype").isNotNull())


def _typed_observations(df: DataFrame, position: Column, layout: Layout) -> DataFrame:
    fixed = []
    for leaf in layout.leaves:
        cell = typed_cell(leaf.column, leaf.dtype)
        if cell is None:
            cell = Cell(F.when(leaf.column.isNotNull(), F.lit(UNKNOWN)), F.lit(None), F.lit(None).cast("string"), F.lit(None))
        fixed.append(
            F.struct(
                F.lit(leaf.path).alias("path"), F.lit(len(leaf.keys)).alias("n_keys"),
                cell.vtype.alias("vtype"), cell.text.alias("text"),
            )
        )
    return df.select(position.alias("pos"), F.inline(F.array(*fixed))).where(F.col("vtype").isNotNull())


def observations(
    df: DataFrame,
    pos: str | None,
    skip: tuple[str, ...] = (),
    keep_unknown: bool = False,
    found: Discovered | None = None,
    written_paths: int = WRITTEN_PATHS,
) -> DataFrame:
    """One row per document and attribute, unsupported values dropped.

    ``pos`` is a numeric document order (it settles ties); it is not an attribute unless
    the caller wants it profiled too, then pass a copy under another name.  A table with
    both typed and VARIANT columns is read once per kind, each time only its columns.
    ``found`` saves the pass that looks for the documents' paths.
    """
    layout = Layout(df.schema, (*skip, pos) if pos else skip)
    position = col(pos).cast("bigint") if pos else F.lit(None).cast("bigint")
    parts = []
    if layout.leaves:
        parts.append(_typed_observations(df, position, layout))
    if layout.variants:
        found = found or discover(df, layout.variants)
        if len(found.leaves) <= written_paths:
            parts.append(_selected_observations(df, position, found.leaves, keep_unknown))
        else:
            parts.append(_opened_observations(df, position, layout, found.depth))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows if keep_unknown else rows.where(F.col("vtype") != UNKNOWN)


def with_target(df: DataFrame, target: str, skip: tuple[str, ...] = (), absent: bool = False) -> DataFrame:
    """Rows whose target is present, not null and not the empty text; 0 and false stay.

    ``absent`` gives the other rows instead.
    """
    source = Layout(df.schema, skip).source(target, 1, len(target.split(SEPARATOR)))
    if source is None:
        raise ValueError(f"target {target!r} is not an attribute of the table")
    if isinstance(source, Leaf):
        kept = source.column.isNotNull()
        if isinstance(source.dtype, T.StringType):
            kept = kept & (source.column != "")
        return df.where(~F.coalesce(kept, F.lit(False)) if absent else kept)
    # A filter would move below the projection that parses the document and parse it once
    # more per test; a generator stays where it is.
    read = df.withColumn("_target", source).withColumn("_target_tag", F.schema_of_variant("_target"))
    empty = (F.col("_target_tag") == "STRING") & (F.try_variant_get("_target", "$", "string") == "")
    kept = F.coalesce((F.col("_target_tag") != "VOID") & ~F.coalesce(empty, F.lit(False)), F.lit(False))
    once = F.when(~kept if absent else kept, F.array(F.lit(True)))
    return read.select(*[col(c) for c in df.columns], F.explode(once).alias("_kept")).drop("_kept")
