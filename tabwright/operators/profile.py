"""Per-attribute statistics from the observations.

One shuffle on (path, text) with map-side combining yields ``value_freq``; everything
else is an aggregation of that table, at most one row per distinct value. Long texts are grouped
by a key of bounded size, and only the few that become a mode or a label are fetched (``with_texts``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabwright.functions.numbers import finite_or_inf, is_int_text, text_to_double
from tabwright.functions.values import LEARNING_TYPES, STRING
from tabwright.operators.discovery import Discovered
from tabwright.operators.observe import Layout, observations
from tabwright.sources.scratch import written

#: Ranges that a path's numbers are cut into before the one with the median is sorted.
MEDIAN_RANGES = 64


#: Characters up to which a text is its own key.
KEY_CHARS = 64


def text_key(text: Column) -> Column:
    """A text, or the head and digest of a long one: same order as the texts where heads differ, at most 129 characters."""
    long = F.concat(F.substring(text, 1, KEY_CHARS), F.lit("\u0001"), F.sha2(text, 256))
    return F.when(F.length(text) > KEY_CHARS, long).otherwise(text)


def is_long(key: Column | str) -> Column:
    return F.length(key) > KEY_CHARS


def long_texts(obs: DataFrame, keys: DataFrame) -> DataFrame:
    """(path, text key, full) of the wanted long keys: one more pass over the observations, few rows kept."""
    wanted = written(keys.where(is_long("text")).distinct(), "long-keys")
    if wanted.isEmpty():
        return wanted.withColumn("full", F.lit(None).cast("string"))
    texts = obs.where(F.length("text") > KEY_CHARS).select("path", F.col("text").alias("full"), text_key(F.col("text")).alias("text"))
    return written(texts.join(wanted, ["path", "text"], "left_semi").groupBy("path", "text").agg(F.min("full").alias("full")), "long-texts")


def with_texts(small: DataFrame, texts: DataFrame, columns: list[str]) -> DataFrame:
    """Keys in ``columns`` of a table with ``path`` replaced by their texts."""
    for c in columns:
        found = texts.select("path", F.col("text").alias(c), F.col("full").alias("_full"))
        small = small.join(found, ["path", c], "left").withColumn(c, F.coalesce("_full", c)).drop("_full").select(*small.columns)
    return small


def profile_of(df: DataFrame, pos: str | None) -> DataFrame:
    """Profile of a table with its modes as whole texts."""
    obs = observations(df, pos)
    found = written(profile(value_freq(obs, Layout(df.schema, (pos,) if pos else ()).fixed_types())), "profile")
    keys = found.select("path", F.explode(F.array("mode", "min_label")).alias("text"))
    return with_texts(found, long_texts(obs, keys), ["mode", "min_label"])


def value_freq(obs: DataFrame, fixed: dict[str, tuple[str, int]] | None = None) -> DataFrame:
    """A4: how often each text occurs per path, split by type, with first/last position; long texts as keys.

    ``fixed`` names the (type, number of keys) of every path when no path can change type,
    as in typed tables; the shuffled rows then carry three numbers instead of twelve.
    """
    # A long text has no native type; whether it reads as a number is asked before it becomes a key.
    long = F.length("text") > KEY_CHARS
    obs = obs.withColumns(
        {
            "long_int": F.when(long, is_int_text(F.col("text"))),
            "long_number": F.when(long, text_to_double(F.col("text"))),
            "text": text_key(F.col("text")),
        }
    )
    if fixed is not None:
        freq = _fixed_type_freq(obs, fixed)
    else:
        counts = [F.count_if(F.col("vtype") == t).alias(f"n_{t}") for t in LEARNING_TYPES]
        firsts = [F.min(F.when(F.col("vtype") == t, F.col("pos"))).alias(f"first_{t}") for t in LEARNING_TYPES]
        freq = obs.groupBy("path", "text").agg(
            F.count("*").alias("n"),
            *counts,
            *firsts,
            F.max("pos").alias("last_pos"),
            F.min("n_keys").alias("min_keys"),
            F.max("n_keys").alias("max_keys"),
            F.max("long_int").alias("long_int"),
            F.max("long_number").alias("long_number"),
        )
    # Texts of native numbers need no pattern: their form is known.
    text, native = F.col("text"), F.col("n_int") + F.col("n_float") > 0
    return freq.withColumns(
        {
            "int_text": F.when(native, F.col("n_int") > 0).when(is_long(text), F.col("long_int")).otherwise(is_int_text(text)),
            "number": F.when(native, finite_or_inf(text.try_cast("double")))
            .when(is_long(text), F.col("long_number"))
            .otherwise(text_to_double(text)),
        }
    ).drop("long_int", "long_number")


def _fixed_type_freq(obs: DataFrame, fixed: dict[str, tuple[str, int]]) -> DataFrame:
    freq = obs.groupBy("path", "text").agg(
        F.count("*").alias("n"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"),
        F.max("long_int").alias("long_int"), F.max("long_number").alias("long_number"),
    )

    def by_path(values: dict[str, object]) -> Column:
        return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("path")]

    vtype = by_path({p: t for p, (t, _) in fixed.items()})
    n_keys = by_path({p: k for p, (_, k) in fixed.items()}).cast("int")
    return freq.withColumn("vtype", vtype).select(
        "path", "text", "n",
        *[F.when(F.col("vtype") == t, F.col("n")).otherwise(F.lit(0)).alias(f"n_{t}") for t in LEARNING_TYPES],
        *[F.when(F.col("vtype") == t, F.col("first_pos")).alias(f"first_{t}") for t in LEARNING_TYPES],
        "last_pos", n_keys.alias("min_keys"), n_keys.alias("max_keys"), "long_int", "long_number",
    )


def freq_of(df: DataFrame, pos: str | None, found: Discovered | None = None) -> DataFrame:
    """Observations and value frequencies of a table in one pass."""
    layout = Layout(df.schema, (pos,) if pos else ())
    return value_freq(observations(df, pos, found=found), layout.fixed_types())


def _int_number() -> Column:
    return F.when(F.col("int_text"), F.col("number"))


def _mean(number: Column) -> Column:
    return F.sum(number * F.col("n")) / F.nullif(F.sum(F.when(number.isNotNull(), F.col("n"))), F.lit(0))


def profile(freq: DataFrame) -> DataFrame:
    """One row per path."""
    strings = F.col(f"n_{STRING}")
    return freq.groupBy("path").agg(
        F.sum("n").alias("present"),
        F.count("*").alias("unique_count"),
        *[F.sum(f"n_{t}").alias(f"n_{t}") for t in LEARNING_TYPES],
        *[F.min(f"first_{t}").alias(f"first_{t}") for t in LEARNING_TYPES],
        F.coalesce(F.sum(F.when(F.col("int_text"), strings)), F.lit(0)).alias("int_strings"),
        F.coalesce(
            F.sum(F.when(~F.col("int_text") & _is_floaty(), strings)), F.lit(0)
        ).alias("float_strings"),
        # The mode is the value that reached the highest count first.
        F.min_by("text", F.struct(-F.col("n"), "last_pos", "text")).alias("mode"),
        F.min("text").alias("min_label"),
        _mean(_int_number()).alias("mean_int"),
        _mean(F.col("number")).alias("mean_float"),
        F.min("min_keys").alias("min_keys"),
        F.max("max_keys").alias("max_keys"),
    )


def _is_floaty() -> Column:
    # NaN texts parse as a number but carry none, so ask the pattern again for them.
    return F.col("number").isNotNull() | F.col("text").rlike(r"^\s*[+-]?[nN][aA][nN]\s*$")


def medians(freq: DataFrame) -> DataFrame:
    """Exact medians of the int-parsable and the float-parsable texts per path.

    One plan at every size, and no path in one task: a mergeable quantile sketch per path cuts its numbers
    into ranges, the ranges are weighed (map-side combined), and only those that hold a middle rank
    are sorted. Both medians share the ranges.
    """
    numbers = freq.where(F.col("number").isNotNull()).select(
        "path", "number", "n", F.when(F.col("int_text"), F.col("n")).otherwise(0).alias("n_int")
    )
    return median_by_narrowing(numbers, {"median_int": "n_int", "median_float": "n"})


def _ranges(numbers: DataFrame) -> DataFrame:
    """Add ``range``: place of the number between its path's cut points, at most MEDIAN_RANGES of them."""
    cuts = F.array(*[F.lit(i / MEDIAN_RANGES) for i in range(1, MEDIAN_RANGES)])
    finite = F.when(~F.isnan("number"), F.col("number"))
    sketches = numbers.groupBy("path").agg(F.kll_sketch_agg_double(finite).alias("sketch"))
    bounds = sketches.select("path", F.kll_sketch_get_quantile_double("sketch", cuts).alias("bounds"))
    # Written, so that its size is known: Spark sends it to all tasks below its own threshold and joins by path above.
    bounds = written(bounds, "median-bounds")
    return numbers.join(bounds, "path").withColumn("range", F.size(F.filter("bounds", lambda b: b < F.col("number")))).drop("bounds")


def median_by_narrowing(numbers: DataFrame, weights: dict[str, str]) -> DataFrame:
    """Exact weighted medians per path of (path, number, weights); ``weights`` maps outputs to weight columns.

    A path whose weights are all 0 has no median.
    """
    cut = _ranges(numbers)
    totals = cut.groupBy("path", "range").agg(*[F.sum(w).alias(f"w_{out}") for out, w in weights.items()])
    path = W.partitionBy("path")
    so_far = path.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    spans = totals.select(
        "path", "range",
        *[F.coalesce(F.sum(f"w_{out}").over(so_far), F.lit(0)).alias(f"before_{out}") for out in weights],
        *[F.sum(f"w_{out}").over(path).alias(f"all_{out}") for out in weights],
        *[F.col(f"w_{out}") for out in weights],
    )

    def middle(out: str) -> tuple[Column, Column]:
        return F.floor((F.col(f"all_{out}") - 1) / 2), F.floor(F.col(f"all_{out}") / 2)

    def holds(out: str) -> Column:
        low, high = middle(out)
        before, here = F.col(f"before_{out}"), F.col(f"w_{out}")
        return (here > 0) & (before <= high) & (before + here > low)

    wanted = spans.where(reduce(Column.__or__, [holds(out) for out in weights]))
    inside = W.partitionBy("path", "range").orderBy("number").rowsBetween(W.unboundedPreceding, W.currentRow)
    ends = [(F.col(f"before_{out}") + F.sum(w).over(inside)).alias(f"end_{out}") for out, w in weights.items()]
    placed = cut.join(wanted, ["path", "range"]).select("*", *ends)
    picks = []
    for out, w in weights.items():
        end, start = F.col(f"end_{out}"), F.col(f"end_{out}") - F.col(w)
        for name, rank in zip(("lo", "hi"), middle(out)):
            picks.append(F.max(F.when((start <= rank) & (end > rank), F.col("number"))).alias(f"{name}_{out}"))
    picked = placed.groupBy("path").agg(*picks)
    return picked.select("path", *[((F.col(f"lo_{out}") + F.col(f"hi_{out}")) / 2).alias(out) for out in weights])
