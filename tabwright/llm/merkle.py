"""Merkle manifest of a dataset, with a witness for every document, built by appends.

A document is a leaf: the SHA-256 of its columns, each written as ``-`` if null, else as byte count,
``:`` and value. Per source the leaves stand by id; while several nodes remain, every run of 16
becomes the hash of its digests (hex text, concatenated). The nodes left, one per source, stand by
source and give the root in the same way. A witness of a leaf holds, level by level, the digests before
and after the node on its way to the root.

Witnesses grow by appends. A task takes an aligned block of at most ``16 ** height`` nodes in order and
appends them to :class:`OpenTree`: a full run closes, its parent is appended one level up, and all runs
below the closed nodes are extended by their siblings. What lies below 16 leaves shares one witness.
The blocks' own roots are appends of the next round, on tables ``16 ** height`` times smaller, until
every source has one node; then the sources' nodes are appended in the same way. A source with a third
of all rows is cut into blocks like any other.

Nulls sort first, in sources and ids. Leaves of one id stand by digest, so equal rows are
interchangeable. An empty table has no rows. Columns beside the five are ignored. A lone leaf is its
source's node and a lone source's node the root, without another hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.sources.scratch import written

RUN = 16
#: Levels that one task closes; a block holds RUN ** HEIGHT nodes.
HEIGHT = 3
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

STEP = "struct<before string, after string>"
NODES = f"grp string, block long, lone boolean, ids array<string>, digests array<string>, steps array<{STEP}>, root string"
STEPS = f"array<{STEP}>"


def node_hash(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


@dataclass
class Run:
    """Up to 16 appended nodes and the witness that all of them share above their own run."""

    ids: list
    digests: list[str]
    steps: list[tuple[str, str]] = field(default_factory=list)


@dataclass
class OpenTree:
    """Nodes appended in order; ``open[level]`` is the level's unfinished run of (digest, runs below it)."""

    size: int = 0
    ids: list = field(default_factory=list)
    open: list[list[tuple[str, list[Run]]]] = field(default_factory=lambda: [[]])

    def append(self, node_id, digest: str) -> None:
        self.ids.append(node_id)
        self.size += 1
        self._push(0, digest, [])

    def _push(self, level: int, digest: str, below: list[Run]) -> None:
        while len(self.open) <= level:
            self.open.append([])
        self.open[level].append((digest, below))
        if len(self.open[level]) == RUN:
            self._close(level)

    def _close(self, level: int) -> None:
        nodes, self.open[level] = self.open[level], []
        digests = [d for d, _ in nodes]
        if level == 0:
            below = [Run(self.ids, digests)]
            self.ids = []
        else:
            for k, (_, runs) in enumerate(nodes):
                step = ("".join(digests[:k]), "".join(digests[k + 1 :]))
                for run in runs:
                    run.steps.append(step)
            below = [run for _, runs in nodes for run in runs]
        self._push(level + 1, node_hash(digests), below)

    def finish(self, height: int | None) -> tuple[str, list[Run]]:
        """Root and runs after closing what is open: to one node, or to ``height`` levels where other blocks are siblings.

        A lone node of the only block is its root as it is.
        """
        if height is None and self.size == 1:
            root = self.open[0][0][0]
            return root, [Run(self.ids, [root])]
        level = 0
        while True:
            last = not any(self.open[level + 1 :])
            if level == height or height is None and level and last and len(self.open[level]) == 1:
                return self.open[level][0]
            if self.open[level]:
                self._close(level)
            level += 1


def _field(name: str) -> Column:
    value = F.col(name).cast("string")
    return F.when(F.col(name).isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf(text: Column | None = None) -> Column:
    """Leaf digest of a row of documents; ``text`` takes the place of the column."""
    parts = [_field(c) for c in FIELDS[:-1]]
    body = F.col("text") if text is None else text
    parts.append(F.when(body.isNull(), "-").otherwise(F.concat(F.octet_length(body).cast("string"), F.lit(":"), body)))
    return F.sha2(F.concat(*parts), 256)


def placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Add ``pos``, the place within ``grp`` by ``order``, and ``n``, the group's size; no group in one task.

    Rows are range-partitioned by group and order, so a large group spans many partitions; a seeded
    number splits equal rows, too. Places inside a partition plus the counts of earlier ones make the place.
    """
    keys = [F.col(c).asc_nulls_first() for c in ["grp", *order]]
    ranged = nodes.withColumn("split", F.rand(11)).repartitionByRange(*keys, "split").sortWithinPartitions(*keys).drop("split")
    ranged = written(ranged.withColumn("at", F.monotonically_increasing_id()), "merkle-ordered")
    ranged = ranged.withColumn("part", F.shiftright("at", 33))
    counts = ranged.groupBy("grp", "part").agg(F.min("at").alias("start"), F.count("*").alias("here"))
    group = Window.partitionBy("grp")
    before = F.sum("here").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("grp", "part", (F.col("start") - F.coalesce(before, F.lit(0))).alias("base"), F.sum("here").over(group).alias("n"))
    return ranged.join(counts, ["grp", "part"]).withColumn("pos", F.col("at") - F.col("base")).drop("at", "part", "base")


def appended(nodes: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Append the blocks of (grp, pos, n, id, digest): NODES rows, one per run with its steps, one per block with its root."""
    size = RUN**height
    blocks = (
        nodes.withColumn("block", F.floor(F.col("pos") / size)).repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")
        .select("grp", "block", "n", "id", "digest")
    )
    shape = pa.schema(
        [
            ("grp", pa.string()), ("block", pa.int64()), ("lone", pa.bool_()), ("ids", pa.list_(pa.string())),
            ("digests", pa.list_(pa.string())),
            ("steps", pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))), ("root", pa.string()),
        ]
    )

    def rows(key: tuple, n: int, tree: OpenTree) -> Iterator[dict]:
        root, runs = tree.finish(height if n > size else None)
        base = {"grp": key[0], "block": key[1], "lone": n == 1}
        for run in runs:
            steps = [{"before": a, "after": b} for a, b in run.steps]
            yield base | {"ids": run.ids, "digests": run.digests, "steps": steps, "root": None}
        yield base | {"ids": None, "digests": None, "steps": None, "root": root}

    def append(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, tree, out = None, 0, OpenTree(), []
        for part in batches:
            for grp, block, count, node_id, digest in zip(*[part.column(k).to_pylist() for k in range(5)]):
                if (grp, block) != key:
                    if key:
                        out += rows(key, n, tree)
                    key, n, tree = (grp, block), count, OpenTree()
                    if len(out) >= 512:
                        yield pa.RecordBatch.from_pylist(out, shape)
                        out = []
                tree.append(node_id, digest)
        if key:
            out += rows(key, n, tree)
        yield pa.RecordBatch.from_pylist(out, shape)

    return written(blocks.mapInArrow(append, NODES), "merkle-appended")


def grown(nodes: DataFrame, order: list[str], height: int = HEIGHT) -> tuple[DataFrame, list[DataFrame]]:
    """Roots (grp, digest) of the groups of (grp, id, digest, *order), and the rounds of appends behind them."""
    at, rounds = placed(nodes, order), []
    while True:
        rounds.append(appended(at, height))
        roots = rounds[-1].where("root IS NOT NULL").select("grp", "block", F.col("root").alias("digest"))
        counts = roots.groupBy("grp").agg(F.count("*").alias("n"))
        if counts.where("n > 1").isEmpty():
            return roots.select("grp", "digest"), rounds
        # Block roots are the next round's appends; the node of a finished group passes as a lone one.
        at = roots.join(counts, "grp").select(
            "grp", F.col("block").alias("pos"), "n", F.col("block").cast("string").alias("id"), "digest"
        )


def witnesses(rounds: list[DataFrame], tails: DataFrame) -> DataFrame:
    """(grp, id, digest, steps, *rest) of every node of the first round, from the last round down.

    ``tails`` is (grp, steps, *rest): the steps above each group's root. Tables are joined by run and
    block, before runs are opened, so no row carries a witness through a shuffle alone.
    """
    rest = [c for c in tails.columns if c not in ("grp", "steps")]
    above, each = tails.withColumn("block", F.lit(0).cast("long")), None
    for appends in reversed(rounds):
        if each is not None:
            above = each.select("grp", F.col("id").cast("long").alias("block"), "steps", *rest)
        above = above.withColumnRenamed("steps", "tail")
        opened = appends.where("root IS NULL").drop("root").join(above, ["grp", "block"]).select("*", F.posexplode("digests").alias("k", "digest"))
        own = F.struct(
            F.array_join(F.slice("digests", 1, F.col("k")), "").alias("before"),
            F.array_join(F.slice("digests", F.col("k") + 2, RUN), "").alias("after"),
        )
        inside = F.when(F.col("lone"), F.array().cast(STEPS)).otherwise(F.concat(F.array(own), "steps"))
        each = opened.select(
            "grp", F.element_at("ids", F.col("k") + 1).alias("id"), "digest", F.concat(inside, "tail").alias("steps"), *rest
        )
    return each


def proof(steps: Column) -> Column:
    """Hash of all siblings on the way, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(digest: Column, steps: Column) -> Column:
    """The root that a leaf and its witness give."""
    return F.aggregate(steps, digest, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def manifest(docs: DataFrame, changed: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """Leaf, source's node, root and witness of every document: (doc_id, leaf, other_leaf, subroot, root, steps).

    ``changed`` is a text to hold against the manifest; ``other_leaf`` is the leaf with it.
    """
    group = F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("="), "source"))
    other = leaf(F.col("text") if changed is None else changed)
    leaves = docs.select(group.alias("grp"), F.col("doc_id").cast("long").alias("doc_id"), leaf().alias("digest"), other.alias("other"))
    # A node's id holds what its row needs later: the document's id and its other leaf, if it has one.
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.when(F.col("other") == F.col("digest"), "").otherwise(F.col("other")))
    leaves = written(leaves.withColumn("id", name).drop("other"), "merkle-leaves")
    subroots, inner = grown(leaves, ["doc_id", "digest"], height)
    root, outer = grown(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("id"), "digest"), ["id"], height)
    top = root.select("grp", F.array().cast(STEPS).alias("steps"), F.col("digest").alias("root"))
    tops = witnesses(outer, top).select(F.col("id").alias("grp"), "steps", F.col("digest").alias("subroot"), "root")
    rows = witnesses(inner, tops)
    return rows.select(
        F.substring_index("id", ":", 1).try_cast("long").alias("doc_id"), F.col("digest").alias("leaf"),
        F.coalesce(F.nullif(F.substring_index("id", ":", -1), F.lit("")), "digest").alias("other_leaf"), "subroot", "root", "steps",
    )


def tampered_text() -> Column:
    """The text with A-Z lower-cased where 5 divides the crc32 of the decimal id; a row without id is left alone."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return F.when(hit, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))


def checked(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) with every tampered row folded from its changed leaf."""
    rows = manifest(docs, tampered_text(), height).withColumn("folded_root", folded(F.col("other_leaf"), F.col("steps")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", proof(F.col("steps")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
