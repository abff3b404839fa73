"""Optimal length buckets for padded batches.

Lengths are words plus one end mark. Documents longer than ``max_length`` are cut into pieces of
that length and a rest, so the global histogram has at most ``max_length`` bars whatever the
table's size. Dynamic programming over those bars chooses the bucket bounds with the least padding.
Inside a bucket every batch holds as many pieces as the token budget allows at the bucket's bound.

Null and empty texts are one piece of length 1 (the end mark). Repeated rows are pieces of their own.
Ties between equally good bounds go to the smallest bounds. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.sources.scratch import written


@dataclass(frozen=True)
class PackOptions:
    max_length: int = 2048
    n_buckets: int = 12
    token_budget: int = 16_384
    #: Rows that one numbering task is planned for.
    rows_per_task: int = 50_000


def n_tokens(text: Column) -> Column:
    r"""Words ``[^\x20\x09-\x0D]+`` and one end mark."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long") + 1


def bucket_bounds(lengths: np.ndarray, counts: np.ndarray, n_buckets: int) -> list[int]:
    """Upper bounds of at most ``n_buckets`` buckets with the least padding in all.

    ``lengths`` ascending and distinct. cost(i, j) of bars i..j in one bucket is
    lengths[j] * pieces - tokens; each round adds a bucket to the best split of every prefix.
    """
    n = len(lengths)
    if not n:
        return []
    pieces = np.concatenate(([0.0], np.cumsum(counts, dtype=np.float64)))
    tokens = np.concatenate(([0.0], np.cumsum(lengths * counts, dtype=np.float64)))
    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    cuts = []
    for _ in range(min(n_buckets, n)):
        cut = np.zeros(n + 1, dtype=np.int64)
        fresh = np.full(n + 1, np.inf)
        fresh[0] = 0.0
        for j in range(1, n + 1):
            cost = best[:j] + lengths[j - 1] * (pieces[j] - pieces[:j]) - (tokens[j] - tokens[:j])
            cut[j] = int(np.argmin(cost))
            fresh[j] = cost[cut[j]]
        cuts.append(cut)
        best = fresh
    bounds, j = [], n
    for cut in reversed(cuts):
        if j:
            bounds.append(int(lengths[j - 1]))
            j = int(cut[j])
    return bounds[::-1]


def pieces(docs: DataFrame, opts: PackOptions) -> DataFrame:
    """(doc_id, piece, start, length): whole documents in pieces of at most ``max_length``."""
    size = F.lit(opts.max_length).cast("long")
    total = docs.select(F.col("doc_id"), n_tokens(F.col("text")).alias("n"))
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, size)).alias("start")
    cut = total.select("doc_id", "n", start)
    return cut.select(
        "doc_id", (F.col("start") / size).cast("long").alias("piece"), "start",
        F.least(size, F.col("n") - F.col("start")).alias("length"),
    )


def packed(docs: DataFrame, opts: PackOptions = PackOptions()) -> DataFrame:
    """(doc_id, piece, start, length, bucket, bound, batch): batch is unique in its bucket.

    Pieces are numbered in (bucket, slot) groups whose number follows the row count, then the
    offsets of the slots are added, so no bucket meets in one task and all batches but the
    bucket's last are full.
    """
    cut = written(pieces(docs, opts), "pieces")
    bars = cut.groupBy("length").count().orderBy("length").collect()  # at most max_length rows
    lengths = np.array([r["length"] for r in bars], dtype=np.int64)
    counts = np.array([r["count"] for r in bars], dtype=np.int64)
    bounds = bucket_bounds(lengths, counts, opts.n_buckets)
    n_slots = max(1, -(-int(counts.sum()) // opts.rows_per_task))
    edges = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array(F.lit(0).cast("long"))
    bucket = F.size(F.filter(edges, lambda b: b < F.col("length")))
    slot = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(n_slots))
    placed = cut.select("*", bucket.alias("bucket"), slot.alias("slot"))
    sizes = placed.groupBy("bucket", "slot").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("bucket").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("bucket", "slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("bucket", "slot").orderBy("doc_id", "piece")
    numbered = placed.withColumn("rank", F.row_number().over(inside) - 1).join(starts, ["bucket", "slot"])
    bound = F.element_at(edges, F.col("bucket") + 1)
    per_batch = F.greatest(F.floor(F.lit(opts.token_budget) / bound), F.lit(1))
    batch = F.floor((F.col("offset") + F.col("rank")) / per_batch).cast("long")
    return numbered.select(
        "doc_id", "piece", "start", "length", F.col("bucket").cast("int").alias("bucket"),
        bound.alias("bound"), batch.alias("batch"),
    )
