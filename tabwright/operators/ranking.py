"""Running totals and ranks over groups of any size.

A window without enough partitions sends a whole group to one task.  Here a group is cut
into buckets first, by value ranges or by hash: running totals inside each bucket, plus the
totals of the buckets before it (one row per group and bucket).  Results equal the plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.hashing import HASH_RANGE
from tabwright.sources.scratch import written

MAX_HASH_BUCKETS = 65_536    # one offset row each


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hash_bucket_count(df: DataFrame) -> int:
    """Hash buckets need no sketch, so a few per shuffle partition keep tasks small."""
    return max(8, min(MAX_HASH_BUCKETS, 4 * _shuffle_partitions(df)))


def hash_bucket(number: Column, buckets: int) -> Column:
    """Bucket of a ``hash_number``: even by construction, no pass over the data."""
    return F.floor(number.cast("double") / F.lit(float(HASH_RANGE)) * buckets).cast("int")


def range_buckets(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Add ``bucket``: the range partition by (keys, order) a row falls into, monotone in ``order`` inside a group.

    Cut points come from Spark's own sample of the rows, so no row is held against a list of them, and a group
    of any share of the rows is spread over partitions. Written once: every later pass reads the same cut, also
    after a lost executor. Rows that agree in keys and order share a partition, so count them together first.
    """
    cut = df.repartitionByRange(*keys, *order).withColumn("bucket", F.spark_partition_id())
    return written(cut, "ranges")


def running_totals(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    totals: dict[str, str],
    heads: dict[str, str] | None = None,
    grand: dict[str, str] | None = None,
) -> DataFrame:
    """Inclusive running sums inside ``keys`` by ``order`` (unique within a group).

    ``df`` carries an int column ``bucket`` that is monotone in ``order``.  ``totals``
    maps output names to summed columns; ``heads`` maps output names to columns whose
    value on the next row is wanted (NULL on the last row of the group).  ``grand`` maps
    output names to names in ``totals`` whose sum over the whole group is wanted.
    """
    heads, grand = heads or {}, grand or {}
    inside = W.partitionBy(*keys, "bucket").orderBy(*order)
    so_far = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    part = df.select(
        "*",
        *[F.sum(src).over(so_far).alias(f"_in_{out}") for out, src in totals.items()],
        *[F.lead(F.struct(src)).over(inside).alias(f"_next_{out}") for out, src in heads.items()],
    )
    sums = df.groupBy(*keys, "bucket").agg(
        *[F.sum(src).alias(f"_sum_{out}") for out, src in totals.items()],
        *[F.min(F.struct(*order, F.col(src).alias("_value"))).alias(f"_head_{out}") for out, src in heads.items()],
        F.count("*").alias("_rows"),
    )
    before = W.partitionBy(*keys).orderBy("bucket")
    offsets = sums.select(
        *keys,
        "bucket",
        *[
            F.coalesce(F.sum(f"_sum_{out}").over(before.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias(
                f"_off_{out}"
            )
            for out in totals
        ],
        *[F.sum(f"_sum_{of}").over(W.partitionBy(*keys)).alias(f"_all_{out}") for out, of in grand.items()],
        *[F.lead(f"_head_{out}").over(before)["_value"].alias(f"_after_{out}") for out in heads],
    )
    joined = part.join(offsets, [*keys, "bucket"])
    return joined.select(
        *df.columns,
        *[(F.col(f"_in_{out}") + F.col(f"_off_{out}")).alias(out) for out in totals],
        *[F.col(f"_all_{out}").alias(out) for out in grand],
        *[
            F.when(F.col(f"_next_{out}").isNotNull(), F.col(f"_next_{out}")[src])
            .otherwise(F.col(f"_after_{out}"))
            .alias(out)
            for out, src in heads.items()
        ],
    )


def ranked_by_hash(df: DataFrame, keys: list[str], number: str, tie: str, out: str = "rank") -> DataFrame:
    """Zero-based rank inside ``keys`` by (hash number, tie-breaker)."""
    buckets = hash_bucket_count(df)
    cut = df.withColumn("bucket", hash_bucket(F.col(number), buckets)).withColumn("_one", F.lit(1).cast("bigint"))
    ranked = running_totals(cut, keys, [number, tie], {out: "_one"})
    return ranked.withColumn(out, F.col(out) - 1).drop("bucket", "_one")
