"""Seeded split and class balancing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.config import BalanceOptions
from tabwright.functions.hashing import hash_number, unit_hash
from tabwright.operators.ranking import ranked_by_hash

TEST_FRACTION = 0.2
_DRAWS_PER_CHUNK = 10_000
_DRAWS_PER_TASK = 250_000


def in_test(id_column: str, seed: int, fraction: float = TEST_FRACTION) -> Column:
    """B1: membership in the held-out part, decided per row; sizes are approximate."""
    return unit_hash(F.lit(seed), F.col(id_column)) < F.lit(fraction)


def hash_split(df: DataFrame, id_column: str, seed: int, fraction: float = TEST_FRACTION) -> DataFrame:
    return df.withColumn("in_test", in_test(id_column, seed, fraction))


def exact_split(df: DataFrame, id_column: str, seed: int, n_rows: int, fraction: float = TEST_FRACTION) -> DataFrame:
    """B1 with exact sizes: the first ceil(fraction * n) rows by hash order are held out."""
    held_out = -int(-(fraction * n_rows) // 1)
    ordered = df.withColumn("_hash", hash_number(F.lit(seed), F.col(id_column)))
    ranked = ranked_by_hash(ordered, [], "_hash", id_column, "_rank")
    return ranked.withColumn("in_test", F.col("_rank") < held_out).drop("_hash", "_rank")


def fold_of(id_column: str, seed: int, folds: int) -> Column:
    """M2: fold number of a row; its own seed so folds are independent of the split."""
    return (hash_number(F.lit(f"fold{seed}"), F.col(id_column)) % folds).cast("int")


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """A12."""
    return df.groupBy(label).agg(F.count("*").alias("cnt"))


def balance_quota(counts: DataFrame, options: BalanceOptions) -> DataFrame:
    """Weight and quota per class from the class counts.

    ``counts`` has one row per class, so the windows over all of it stay tiny.
    """
    every = W.partitionBy()
    n = F.sum("cnt").over(every)
    even = F.lit(1.0) / F.count("*").over(every)
    weight = even if options.mode == "equalize" else (even + F.col("cnt") / n) / 2
    weighed = counts.select("*", weight.cast("double").alias("weight"), n.cast("double").alias("_n"))
    allowed = (F.lit(float(options.max_oversample)) * F.min("cnt").over(every)) / F.min("weight").over(every)
    sized = weighed.withColumn("target_count", F.least(allowed, F.col("_n"))).drop("_n")
    if options.mode == "none":
        return sized.withColumn("quota", F.col("cnt"))
    return sized.withColumn("quota", F.floor(F.col("weight") * F.col("target_count")).cast("bigint"))


def _as_local(table: DataFrame) -> DataFrame:
    return table.sparkSession.createDataFrame(table.collect(), table.schema)


def class_draws(quota: DataFrame, seed: int) -> DataFrame:
    """(class, rank) of every draw of the ``rest`` of a class, in tasks of bounded size.

    The number of tasks is given: the chunks themselves are few bytes, so adaptive execution would
    put all of them, and with them all draws, into one task.
    """
    total = quota.agg(F.coalesce(F.sum("rest"), F.lit(0))).first()[0]
    tasks = max(1, -(-total // _DRAWS_PER_TASK))
    first = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("rest") - 1) / _DRAWS_PER_CHUNK).cast("bigint"))
    chunks = quota.where("rest > 0").select("*", F.explode(first).alias("chunk")).repartition(tasks, "_class", "chunk")
    low = F.col("chunk") * _DRAWS_PER_CHUNK + 1
    high = F.least(F.col("rest"), (F.col("chunk") + 1) * _DRAWS_PER_CHUNK)
    return chunks.select("_class", "cnt", F.explode(F.sequence(low, high)).alias("draw")).select(
        "_class", (hash_number(F.lit(seed), F.col("_class"), F.col("draw")) % F.col("cnt")).alias("_rank")
    )


def balance_copies(df: DataFrame, label: str, id_column: str, options: BalanceOptions, seed: int) -> DataFrame:
    """Add ``copies`` to every row: whole copies plus its share of the drawn rest.

    The rest is drawn with replacement as (class, rank) pairs that meet the rows on that
    pair, so a class of any size spreads over all tasks.  The quota table (one row per
    class) is read once and reused as a local table of known size.
    """
    if options.mode == "none":
        return df.withColumn("copies", F.lit(1).cast("bigint"))
    quota = _as_local(
        balance_quota(class_counts(df, label), options).select(
            F.col(label).alias("_class"),
            "cnt",
            F.floor(F.col("quota") / F.col("cnt")).cast("bigint").alias("whole"),
            (F.col("quota") % F.col("cnt")).alias("rest"),
        )
    )
    draws = class_draws(quota, seed)
    drawn = draws.groupBy("_class", "_rank").agg(F.count("*").alias("_drawn"))
    ranked = ranked_by_hash(
        df.withColumn("_hash", hash_number(F.lit(seed), F.col(id_column))), [label], "_hash", id_column, "_rank"
    )
    ranked = ranked.withColumnRenamed(label, "_class")
    # Draws come out of few bytes of chunks, so adaptive execution takes them for few rows and would broadcast them all.
    with_rest = ranked.join(drawn.hint("merge"), ["_class", "_rank"], "left")
    with_rest = with_rest.join(F.broadcast(quota.select("_class", "whole")), "_class")
    return with_rest.withColumn("copies", F.col("whole") + F.coalesce("_drawn", F.lit(0))).withColumnRenamed(
        "_class", label
    ).select(*df.columns, "copies")


def balance_rows(
    df: DataFrame, label: str, id_column: str, options: BalanceOptions, seed: int, shuffle: bool = False
) -> DataFrame:
    """The balanced rows themselves, in hash order when ``shuffle`` is set."""
    if options.mode == "none":
        return df
    copied = balance_copies(df, label, id_column, options, seed).where("copies > 0")
    rows = copied.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    if shuffle:
        rows = rows.orderBy(hash_number(F.lit(seed), F.col(id_column), F.col("_copy")), F.col(id_column), F.col("_copy"))
    return rows.drop("copies", "_copy")
