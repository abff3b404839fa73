"""Where the attributes of documents lie, at any depth.

Most tables hold few different shapes of documents: these are counted in one pass (map-side combined), and a
few shapes tell every path and all types that stand there. Tables of more than ``FEW_SHAPES`` shapes take
another way to the same paths: ``schema_of_variant_agg`` merges the shapes of all documents map-side: one aggregation tells every path
and, where all values agree, their type. Where they do not, it says VARIANT and no more; the objects
among such values are merged in a further aggregation, all places at once, until none is left. There is
one pass for the table and one more per level of places that hold objects in some documents and other values
in others. What reaches the driver is the merged shape: one entry per attribute, as in the plan.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.paths import SKIPPED_KEY, variant_at
from tabwright.functions.values import INT, STRING, UNKNOWN, WRAPPER_KEYS, as_object, wrapper_key

#: Kinds beside the learning types: numbers that may be whole or not, scalars of several types, numbers in a
#: wrapper, and values that must be looked at in full.
NUMBER, SCALAR, WRAPPED, ANY = "number", "scalar", "wrapped", "any"
_KINDS = {"STRING": STRING, "BIGINT": INT, "BOOLEAN": INT, "DECIMAL": NUMBER, "DOUBLE": NUMBER, "FLOAT": NUMBER, "VOID": None}
#: Shapes that are merged on the driver; a shape takes one line of text.
FEW_SHAPES = 1000
_READ_AS = {STRING: "string", INT: "bigint"}


@dataclass
class Shape:
    """A merged VARIANT schema: its tag, and the members of an object."""

    tag: str
    members: dict[str, Shape] = field(default_factory=dict)


def parse_shape(text: str) -> Shape:
    """Shape from a schema text such as ``OBJECT<a: BIGINT, `b c`: OBJECT<d: STRING>>``."""
    at = 0

    def take(end: str) -> str:
        nonlocal at
        start = at
        while at < len(text) and text[at] not in end:
            at += 1
        return text[start:at]

    def key() -> str:
        nonlocal at
        if text[at] != "`":
            return take(":")
        out, at = [], at + 1
        while True:
            out.append(take("`"))
            at += 1
            if at >= len(text) or text[at] != "`":  # a doubled quote stands for itself
                return "".join(out)
            out.append("`")
            at += 1

    def shape() -> Shape:
        nonlocal at
        tag = take("<>(,")
        if at < len(text) and text[at] == "(":
            take(")")
            at += 1
            return Shape(tag)
        if at >= len(text) or text[at] != "<":
            return Shape(tag)
        at += 1
        if tag != "OBJECT":
            shape()
            at += 1
            return Shape(tag)
        members = {}
        while text[at] != ">":
            name = key()
            at += 2  # colon and blank
            members[name] = shape()
            if text[at] == ",":
                at += 2
        at += 1
        return Shape(tag, members)

    return shape()


@dataclass(frozen=True)
class VariantLeaf:
    """A path that holds values: ``keys`` from the attribute root, ``inner`` from the VARIANT column ``root``.

    ``guards`` are objects on the way that must not be wrappers where the value is to count; ``wrapper`` is
    the key under which every value of a wrapped leaf stands.
    """

    keys: tuple[str, ...]
    inner: tuple[str, ...]
    root: Column
    kind: str
    guards: tuple[tuple[str, ...], ...] = ()
    wrapper: str | None = None

    def read(self) -> Column:
        value = variant_at(self.root, (*self.inner, self.wrapper) if self.wrapper else self.inner)
        if self.kind in _READ_AS:
            value = _typed(self.root, self.inner, _READ_AS[self.kind])
        for guard in self.guards:
            value = F.when(wrapper_key(as_object(variant_at(self.root, guard))).isNull(), value)
        return value


@dataclass(frozen=True)
class Discovered:
    leaves: list[VariantLeaf]
    n_rows: int

    @property
    def depth(self) -> int:
        return max((len(leaf.inner) for leaf in self.leaves), default=0)


def _typed(root: Column, keys: tuple[str, ...], kind: str) -> Column:
    """A value whose type is known, read along the whole path in one step where the keys allow it."""
    if any('"' in k for k in keys):
        return F.try_variant_get(variant_at(root, keys), "$", kind)
    return F.try_variant_get(root, "$" + "".join(f'["{k}"]' for k in keys), kind)


def discover(df: DataFrame, roots: list[tuple[tuple[str, ...], Column]], few: int = FEW_SHAPES) -> Discovered:
    """Leaves of the VARIANT columns ``roots`` (prefix of the path, column) and the number of rows."""
    shapes = [F.schema_of_variant(root) for _, root in roots]
    # Lengths of decimals make no other type; a quoted key might only look like one.
    shapes = [F.when(s.contains("`"), s).otherwise(F.regexp_replace(s, r"DECIMAL\(\d+,\d+\)", "DECIMAL")) for s in shapes]
    named = df.select(*[s.alias(f"s{i}") for i, s in enumerate(shapes)])
    counted = named.groupBy(*named.columns).agg(F.count("*").alias("n")).limit(few + 1).collect()
    if len(counted) > few:
        return _merged(df, roots)
    leaves: list[VariantLeaf] = []
    for i, (prefix, root) in enumerate(roots):
        known = [parse_shape(r[f"s{i}"]) for r in counted if r[f"s{i}"] is not None]
        _leaves_of(known, prefix, root, (), (), leaves)
    return Discovered(leaves, sum(r["n"] for r in counted))


def _kind(tag: str) -> str | None:
    return ANY if tag == "VARIANT" else UNKNOWN if tag == "ARRAY" else _KINDS.get(tag, ANY)


def _wrapped(members: list[dict[str, Shape]]) -> str | None:
    """The one key of all these objects where it wraps a plain number."""
    keys = {k for m in members for k in m}
    if len(keys) == 1 and (key := next(iter(keys))) in WRAPPER_KEYS and key != "$date":
        return key if all(not m[key].members for m in members if m) else None
    return None


def _leaves_of(known: list[Shape], prefix, root, inner, guards, leaves: list[VariantLeaf]) -> None:
    """Leaves at and below one place that holds values of the ``known`` shapes."""
    keys = (*prefix, *inner)
    members = [s.members for s in known if s.tag == "OBJECT"]
    kinds = {_kind(s.tag) for s in known if s.tag != "OBJECT"} - {None}
    keys_here = {k for m in members for k in m}
    wrappers = keys_here & set(WRAPPER_KEYS)
    wrapper = None if kinds else _wrapped(members)
    if wrapper:
        leaves.append(VariantLeaf(keys, inner, root, WRAPPED, guards, wrapper))
        return
    if wrappers or ANY in kinds:
        leaves.append(VariantLeaf(keys, inner, root, ANY, guards))
    elif kinds:
        tags = {s.tag for s in known if _kind(s.tag)} - {"OBJECT"}
        alike = len(tags) == 1 or kinds == {NUMBER} or tags <= {"BIGINT", "DECIMAL", "DOUBLE", "FLOAT"}
        kind = (kinds.pop() if len(kinds) == 1 else NUMBER) if alike else SCALAR
        # An object beside scalars would be read as text.
        leaves.append(VariantLeaf(keys, inner, root, ANY if members else kind, guards))
    if len(keys_here) == 1 and wrappers:
        return
    for k in sorted(keys_here - {SKIPPED_KEY}):
        below = [m[k] for m in members if k in m]
        _leaves_of(below, prefix, root, (*inner, k), (*guards, inner) if k in wrappers else guards, leaves)


def _merged(df: DataFrame, roots: list[tuple[tuple[str, ...], Column]]) -> Discovered:
    """The same from merged schemas, for tables of many shapes."""
    leaves: list[VariantLeaf] = []
    n_rows = None
    # Places whose shape is asked for next: prefix, column, keys inside it, guards, whether other values stand there, too.
    asked = [(prefix, root, (), (), False) for prefix, root in roots]
    while asked:
        values = []
        for _, root, inner, _, mixed in asked:
            value = variant_at(root, inner)
            values.append(F.when(F.schema_of_variant(value).startswith("OBJECT<"), value) if mixed else value)
        found = df.agg(F.count("*").alias("n"), *[F.schema_of_variant_agg(v).alias(f"s{i}") for i, v in enumerate(values)]).first()
        n_rows = found["n"] if n_rows is None else n_rows
        again = []

        def walk(shape: Shape, prefix, root, inner, guards) -> None:
            keys = (*prefix, *inner)
            if shape.tag != "OBJECT":
                if shape.tag == "VARIANT":
                    again.append((prefix, root, inner, guards, True))
                kind = ANY if shape.tag == "VARIANT" else UNKNOWN if shape.tag == "ARRAY" else _KINDS.get(shape.tag, ANY)
                if kind:
                    leaves.append(VariantLeaf(keys, inner, root, kind, guards))
                return
            members = {k: m for k, m in shape.members.items() if k != SKIPPED_KEY}
            wrappers = [k for k in shape.members if k in WRAPPER_KEYS]
            if len(shape.members) == 1 and wrappers and wrappers[0] != "$date" and not shape.members[wrappers[0]].members:
                leaves.append(VariantLeaf(keys, inner, root, WRAPPED, guards, wrappers[0]))
                return
            if wrappers:
                leaves.append(VariantLeaf(keys, inner, root, ANY, guards))
                if len(shape.members) == 1:
                    return
            for k, m in members.items():
                walk(m, prefix, root, (*inner, k), (*guards, inner) if k in wrappers else guards)

        for i, (prefix, root, inner, guards, mixed) in enumerate(asked):
            shape = parse_shape(found[f"s{i}"] or "VOID")
            if mixed and shape.tag == "OBJECT":
                # The place itself is a leaf already.
                kept = len(leaves)
                walk(shape, prefix, root, inner, guards)
                leaves[kept:] = [leaf for leaf in leaves[kept:] if leaf.inner != inner]
            elif mixed:
                at = next(k for k, leaf in enumerate(leaves) if leaf.inner == inner and leaf.keys == (*prefix, *inner))
                leaves[at] = replace(leaves[at], kind=SCALAR)
            else:
                walk(shape, prefix, root, inner, guards)
        asked = again
    return Discovered(leaves, n_rows or 0)
