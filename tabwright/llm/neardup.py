r"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Signature: one permutation sigma of the 64-bit shingle hashes' upper words, then coordinate k is the
minimum of one second permutation pi over the set shifted circularly by k. Both permutations are
bijections of 32-bit numbers, so two of them give all coordinates. Bands of the signature name
candidates; every link is confirmed on the full sets.

Work stays near linear in big groups. Equal sets become one node first. In each band bucket every
node is compared with the bucket's head (a star), the node that meets most others. Only buckets whose nodes are then not yet in
one component go on: there all pairs of different components are compared by signature inside the
task, in blocks, then by shortened sets, and those that may reach the threshold are verified as well. A pair inside one
component needs no test, since the result is the components. With 32 bands of 4 coordinates a pair
at the threshold of 0.8 shares no band with probability 5e-8; the signature test lets a pair at the
threshold pass but for a probability below 1e-8.

Defined results: null or empty texts have an empty set and are linked with nothing. Texts with fewer
words than a shingle have one shingle, the whole sequence. Rows with a null id are never linked and
have a null component. Rows that repeat an id are one document; if their texts differ, the one with
the smallest digest stands for all of them. Columns beside doc_id and text are ignored. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import mix64, offsets, slices, texts, words
from tabwright.llm.components import components
from tabwright.sources.scratch import written


@dataclass(frozen=True)
class MinHashOptions:
    shingle: int = 5
    #: Links need 100 * intersection >= percent * union.
    percent: int = 80
    bands: int = 32
    rows: int = 4
    #: Coordinates out of bands * rows that must agree before a pair's sets are compared (of 128: 58 %).
    least_agree: int = 74
    #: Nodes of one block when an open bucket's pairs are compared.
    block: int = 512

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows


def shingle_hashes(batch: list[str], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    tokens = [words(t) for t in batch]
    digest = xxhash.xxh3_64_intdigest
    flat = [np.fromiter(map(digest, t), dtype=np.uint64, count=len(t)) for t in tokens]
    sets = []
    for h in flat:
        if not len(h):
            sets.append(h)
            continue
        n = max(1, len(h) - size + 1)
        # The number of words starts the chain, so a short text never equals a shingle of a longer one.
        mixed = np.full(n, min(size, len(h)), dtype=np.uint64)
        for j in range(min(size, len(h))):
            mixed = mix64(mixed ^ h[j : j + n])
        sets.append(np.unique(mixed))
    return sets


def _permute(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A bijection of 32-bit numbers: xor-shifts and odd multipliers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(a)
    x ^= x >> np.uint32(15)
    x *= np.uint32(b)
    x ^= x >> np.uint32(16)
    return x


def signature(hashes: np.ndarray, coordinates: int, rows_at_once: int = 512) -> np.ndarray:
    """min over the set of pi(sigma(x) + k) for k = 0, 1, ..., as 32-bit numbers."""
    base = _permute((hashes >> np.uint64(32)).astype(np.uint32), 0x7FEB352D, 0x846CA68B)
    shift = np.arange(coordinates, dtype=np.uint32)[:, None]
    least = np.full(coordinates, 0xFFFFFFFF, dtype=np.uint32)
    for start in range(0, len(base), rows_at_once):
        moved = shift + base[None, start : start + rows_at_once]
        np.minimum(least, _permute(moved, 0x21F0AAAD, 0x735A2D97).min(axis=1), out=least)
    return least


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.arange(bands, dtype=np.uint64)
    for part in sig.reshape(bands, rows).T.astype(np.uint64):
        key = mix64(key ^ part)
    return key.view(np.int64)


_HASHED = "doc_id long, n long, digest string, sig binary, bands array<long>"


def hashed(docs: DataFrame, opts: MinHashOptions) -> DataFrame:
    """Set size, digest of the set, low halves of the signature and band keys of every row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames):
            sets = shingle_hashes(texts(frame), opts.shingle)
            sigs = [signature(s, opts.coordinates) if len(s) else None for s in sets]
            yield pd.DataFrame(
                {
                    "doc_id": frame.doc_id.astype("Int64").array,
                    "n": [len(s) for s in sets],
                    "digest": [hashlib.md5(s.tobytes()).hexdigest() for s in sets],
                    "sig": [None if s is None else s.astype(np.uint16).tobytes() for s in sigs],
                    "bands": [None if s is None else band_keys(s, opts.bands, opts.rows) for s in sigs],
                }
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, _HASHED)


def full_sets(docs: DataFrame, nodes: DataFrame, opts: MinHashOptions) -> DataFrame:
    """(node, n, items) for the wanted nodes (node, digest): the full shingle sets."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames):
            sets = shingle_hashes(texts(frame), opts.shingle)
            same = [hashlib.md5(s.tobytes()).hexdigest() == d for s, d in zip(sets, frame.digest)]
            yield pd.DataFrame(
                {
                    "node": [n for n, ok in zip(frame.doc_id, same) if ok],
                    "n": [len(s) for s, ok in zip(sets, same) if ok],
                    "items": [s.view(np.int64) for s, ok in zip(sets, same) if ok],
                }
            )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wanted = nodes.select(F.col("node").alias("doc_id"), "digest")
    return own.join(wanted, "doc_id").mapInPandas(run, "node long, n long, items array<long>").dropDuplicates(["node"])


def verified(pairs: DataFrame, sets: DataFrame, opts: MinHashOptions) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold; sizes are compared before sets are sent."""

    def side(end: str, *columns: str) -> DataFrame:
        return sets.select(F.col("node").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns])

    fits = (F.col("n_a") * 100 >= F.col("n_b") * opts.percent) & (F.col("n_b") * 100 >= F.col("n_a") * opts.percent)
    sized = pairs.join(side("a", "n"), "a").join(side("b", "n"), "b").where(fits)
    shared = F.size(F.array_intersect("items_a", "items_b")).cast("long")
    linked = shared * 100 >= (F.col("n_a") + F.col("n_b") - shared) * opts.percent
    return sized.join(side("a", "items"), "a").join(side("b", "items"), "b").where(linked).select("a", "b")


def _open_pairs(open_members: DataFrame, opts: MinHashOptions) -> DataFrame:
    """Pairs of nodes of different components that share an open bucket and agree in their signatures.

    A bucket's nodes are put into blocks by hash, those of its largest component apart from the rest;
    each task compares two blocks at most, so a bucket of any size is split. Blocks of the largest
    component never meet each other, as no pair inside a component needs a test. A pair is looked at in the first bucket that both share, and not if
    that bucket's star has tested it. Pairs that agree in their signatures are compared by the low
    16 bits of their shingle hashes, which can only add to the shared count; only pairs that still
    reach the threshold, nearly all of them links, leave the task to be verified on the full sets.
    """
    parts = open_members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("part"))
    sizes = parts.groupBy("key").agg(
        F.sum("part").alias("size"), F.max("part").alias("most"), F.max_by("component", F.struct("part", "component")).alias("main")
    )
    small, is_main = F.col("size") <= opts.block, F.col("component") == F.col("main")
    rest_blocks = F.when(small, 1).otherwise(F.ceil((F.col("size") - F.col("most")) / opts.block)).cast("int")
    main_blocks = F.when(small, 0).otherwise(F.ceil(F.col("most") / opts.block)).cast("int")
    placed = open_members.join(sizes, "key").withColumns({"rest": rest_blocks, "mains": main_blocks})
    dealt = F.xxhash64("node")
    in_main = F.col("rest") + F.pmod(dealt, F.greatest("mains", F.lit(1)))
    own = F.when(is_main & ~small, in_main).otherwise(F.pmod(dealt, F.col("rest"))).cast("int")
    last = F.col("rest") - 1 + F.when(is_main, 0).otherwise(F.col("mains"))
    sent = placed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    sent = sent.select(
        "key", "head", "node", "component", "n", "sig", "bands", "codes", "own", F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("node")
        sig = np.frombuffer(b"".join(frame.sig), dtype=np.uint16).reshape(len(frame), -1)
        bands = np.stack(frame.bands.to_list())
        node, comp, n, own = (frame[c].to_numpy(dtype=np.int64) for c in ("node", "component", "n", "own"))
        key, head = frame["key"].iloc[0], frame["head"].iloc[0]
        # Two blocks: only pairs across them, as each block meets itself in its own task.
        across = frame.i.iloc[0] != frame.j.iloc[0]
        codes = [c.view(np.uint16) for c in (np.asarray(c, dtype=np.int16) for c in frame.codes)]
        present = np.zeros(1 << 16, dtype=bool)
        out = []
        for x in range(len(frame)):
            if node[x] == head:
                continue
            y = np.arange(x + 1, len(frame))
            y = y[(comp[y] != comp[x]) & (node[y] != head) & ((own[y] != own[x]) | (not across))]
            y = y[(n[y] * 100 >= n[x] * opts.percent) & (n[x] * 100 >= n[y] * opts.percent)]
            y = y[(sig[y] == sig[x]).sum(axis=1) >= opts.least_agree] if len(y) else y
            y = y[bands[x][(bands[y] == bands[x]).argmax(axis=1)] == key] if len(y) else y
            present[codes[x]] = True
            for z in y:
                most = min(int(present[codes[z]].sum()), int(n[x]))
                if most * 100 >= (n[x] + n[z] - most) * opts.percent:
                    out.append((max(node[x], node[z]), min(node[x], node[z])))
            present[codes[x]] = False
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return sent.groupBy("key", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, opts: MinHashOptions = MinHashOptions()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text)."""
    rows = written(hashed(docs, opts), "minhash")
    usable = rows.where("doc_id IS NOT NULL AND n > 0")
    own = usable.groupBy("doc_id").agg(F.min("digest").alias("digest"))
    heads = own.groupBy("digest").agg(F.min("doc_id").alias("node"))
    at_head = heads.select("node", F.col("digest").alias("head_digest"))
    nodes = usable.join(at_head, (F.col("digest") == F.col("head_digest")) & (F.col("doc_id") == F.col("node")))
    nodes = written(nodes.select("node", "digest", "n", "sig", "bands").dropDuplicates(["node"]), "nodes")

    members = nodes.select("node", F.explode("bands").alias("key"))
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    found = written(members.join(sizes, "key"), "members")
    # The node that meets most others is the likely origin of a group of copies: it heads its buckets.
    degree = found.groupBy("node").agg(F.sum("size").alias("degree"))
    ranked = found.join(degree, "node").select("key", "node", F.struct("degree", (-F.col("node")).alias("least")).alias("rank"))
    heads_of = ranked.groupBy("key").agg((-F.max("rank")["least"]).alias("head"))
    shared = written(found.select("key", "node").join(heads_of, "key"), "buckets")
    star = shared.where("node <> head").select(F.greatest("node", "head").alias("a"), F.least("node", "head").alias("b"))
    star = star.distinct()
    ends = shared.select("node").distinct()
    # Every node that any later step compares is in a bucket, so its set is made once, here.
    sets = written(full_sets(docs, nodes.join(ends, "node"), opts), "sets")
    links = written(verified(star, sets, opts), "links")
    first = components(links)

    placed = shared.join(first, "node", "left").select("key", "head", "node", F.coalesce("component", "node").alias("component"))
    # A bucket of two has been tested in full by its star.
    still = placed.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("size")
    )
    still = still.where("lo < hi AND size > 2").select("key")
    # bigint.cast wraps only with ANSI off, so the low bits are moved into the range of a short.
    low = F.transform("items", lambda x: (x.bitwiseAND(0xFFFF) - (1 << 15)).cast("smallint")).alias("codes")
    open_members = placed.join(still, "key").join(nodes.select("node", "n", "sig", "bands"), "node")
    open_members = open_members.join(sets.select("node", low), "node")
    extra = written(_open_pairs(open_members, opts).join(star, ["a", "b"], "left_anti"), "open")
    # The links found last join whole components, so only those components are gone through again.
    late = verified(extra, sets, opts)
    for end in ("a", "b"):
        of_end = first.select(F.col("node").alias(end), F.col("component").alias("_c"))
        late = late.join(of_end, end, "left").withColumn(end, F.coalesce("_c", end)).drop("_c")
    merged = components(late).select(F.col("node").alias("root"), F.col("component").alias("joined"))
    found = heads.join(first, "node", "left").withColumn("root", F.coalesce("component", "node")).join(merged, "root", "left")

    classes = found.select("digest", F.coalesce("joined", "root").alias("found"))
    by_id = own.join(classes, "digest").select("doc_id", "found")
    component = F.coalesce("found", "doc_id")
    return rows.select("doc_id", "n").join(by_id, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"),
    )
