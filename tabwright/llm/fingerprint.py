r"""Homomorphic multiset hash of a document's paragraphs, in built-in functions only.

A paragraph is a line without the white space around it; empty lines are none. Each paragraph is
hashed to a wide vector and the document's fingerprint is the lane-by-lane sum of the vectors,
modulo powers of two. The sum does not depend on the order of the paragraphs; putting in or taking
out a paragraph adds or subtracts its vector (:func:`inserted`, :func:`deleted`).

The vector has ``EXACT_LANES`` lanes of 32 hash bits (modulo 2^32), which tell unequal multisets
apart, a lane that counts the paragraph's clauses - runs of up to eight words that end at a
sentence mark - and ``BIT_LANES`` lanes (modulo 2^31) that sum one hash bit of every clause. Twice a
bit lane less the count is a sum of random signs, so the cosine of two such vectors estimates the
share of clauses that two documents have in common; its error is about 0.1.

Null texts count as empty: all lanes 0, likeness 1 to another text without clauses and else 0. Equal
texts have equal fingerprints. A null id sorts last. Rows of one id share their next document; where
the next id has several texts, the one with the smallest SHA-256 stands for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.sources.scratch import written

EXACT_LANES, BIT_LANES = 8, 96
_LOW32 = (1 << 32) - 1
_PAIR = (1 << 32) | 1
_CLAUSE = r"(?:[^\s.!?]++[^\S\n]++){0,7}+[^\s]++"
_NO_ID = -(1 << 63)
_LONG = "bigint"


def _zero() -> Column:
    return F.lit(0).cast(_LONG)


def _hashes(strings: str, seed: int) -> Column:
    return F.transform(strings, lambda x: F.xxhash64(F.lit(seed), x))


def _total(values: Column, pick) -> Column:
    return F.aggregate(values, _zero(), lambda acc, x: acc + pick(x))


def with_lanes(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """Columns ``{prefix}exact`` (array of EXACT_LANES), ``{prefix}bits`` (two 31-bit sums per long), ``{prefix}n``."""
    lines = F.filter(
        F.transform(F.split(F.col(text), "\n"), lambda p: F.regexp_replace(p, r"^\s+|\s+$", "")), lambda p: p != ""
    )
    df = df.withColumn(f"{prefix}lines", lines)
    clauses = F.flatten(F.transform(f"{prefix}lines", lambda p: F.regexp_extract_all(p, F.lit(_CLAUSE), F.lit(0))))
    df = df.withColumn(f"{prefix}clauses", clauses)
    n_words = EXACT_LANES // 2
    df = df.withColumns(
        {f"{prefix}w{k}": _hashes(f"{prefix}lines", k) for k in range(n_words)}
        | {f"{prefix}c{k}": _hashes(f"{prefix}clauses", 100 + k) for k in (0, 1)}
    )
    halves = (lambda h: h.bitwiseAND(F.lit(_LOW32)), lambda h: F.shiftrightunsigned(h, 32))
    exact = [
        _total(F.col(f"{prefix}w{k}"), half).bitwiseAND(F.lit(_LOW32)) for k in range(n_words) for half in halves
    ]
    picks = [(0, k) for k in range(32)] + [(1, k) for k in range(BIT_LANES // 2 - 32)]
    bits = [
        _total(F.col(f"{prefix}c{c}"), lambda h, k=k: F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_PAIR))) for c, k in picks
    ]
    n = F.size(f"{prefix}clauses").cast(_LONG)
    scrap = [f"{prefix}{x}" for x in ("lines", "clauses", *[f"w{k}" for k in range(n_words)], "c0", "c1")]
    return df.withColumns(
        {f"{prefix}exact": F.array(*exact), f"{prefix}bits": F.array(*bits), f"{prefix}n": n}
    ).drop(*scrap)


def _hex(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda x: F.lower(F.hex(x))), ".")


def rendered(prefix: str) -> Column:
    """The fingerprint as text: exact lanes, bit lanes, clause count, in hex."""
    return F.concat_ws("-", _hex(F.col(f"{prefix}exact")), _hex(F.col(f"{prefix}bits")), F.lower(F.hex(f"{prefix}n")))


def _added(a: str, b: str, sign: int) -> tuple[Column, Column, Column]:
    both = F.zip_with(
        F.col(f"{a}exact"), F.col(f"{b}exact"), lambda x, y: (x + y * sign).bitwiseAND(F.lit(_LOW32))
    )
    bits = F.zip_with(F.col(f"{a}bits"), F.col(f"{b}bits"), lambda x, y: x + y * sign)
    return both, bits, F.col(f"{a}n") + F.col(f"{b}n") * sign


def inserted(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Lanes of the union of two multisets, from their lanes alone."""
    exact, bits, n = _added(a, b, 1)
    return df.withColumns({f"{out}exact": exact, f"{out}bits": bits, f"{out}n": n})


def deleted(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Lanes of ``a`` without the paragraphs of ``b`` (which must be in it)."""
    exact, bits, n = _added(a, b, -1)
    return df.withColumns({f"{out}exact": exact, f"{out}bits": bits, f"{out}n": n})


def _signs(prefix: str) -> Column:
    n = F.col(f"{prefix}n")
    each = F.transform(
        f"{prefix}bits",
        lambda x: F.array(x.bitwiseAND(F.lit(_LOW32)) * 2 - n, F.shiftrightunsigned(x, 32) * 2 - n),
    )
    return F.transform(F.flatten(each), lambda x: x.cast("double"))


def likeness(a: str, b: str) -> Column:
    """Cosine of the sign sums, in 0..1; 1 where neither text has a clause."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)

    u, v = _signs(a), _signs(b)
    size = F.sqrt(dot(u, u)) * F.sqrt(dot(v, v))
    cosine = F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot(u, v) / F.nullif(size, F.lit(0.0))))
    empty = (F.col(f"{a}n") == 0) & (F.col(f"{b}n") == 0)
    same = (F.col(f"{a}exact") == F.col(f"{b}exact")) & (F.col(f"{a}bits") == F.col(f"{b}bits"))
    return F.when(empty | same, F.lit(1.0)).otherwise(F.coalesce(cosine, F.lit(0.0)))


def neighbours(base: DataFrame) -> DataFrame:
    """(k, need, next_k, next_sha): the next smaller id of every id, the largest after the smallest.

    The ids are range-partitioned once into a written table; each partition is then ordered by
    itself and takes its last neighbour from a table with one row per partition.
    """
    ids = base.groupBy("k").agg(
        F.max(F.floor(F.length("text") / 3)).alias("need"), F.min(F.sha2("text", 256)).alias("sha")
    )
    ids = written(ids.repartitionByRange("k").withColumn("part", F.spark_partition_id()), "ids")
    head = F.struct("k", "sha")
    tops = ids.groupBy("part").agg(F.max(head).alias("top"))
    tops = tops.select(
        "part",
        F.coalesce(F.lag("top").over(Window.orderBy("part")), F.max("top").over(Window.partitionBy())).alias("below"),
    )
    following = F.lead(head).over(Window.partitionBy("part").orderBy(F.col("k").desc()))
    linked = ids.select("part", "k", "need", following.alias("inside")).join(tops, "part")
    after = F.coalesce("inside", "below")
    return linked.select("k", "need", after["k"].alias("next_k"), after["sha"].alias("next_sha"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): both fingerprints and their likenesses; see the contract of op6.

    The texts are shuffled once, by id; the neighbour's first third and lanes follow in a second
    shuffle of about a third of that.
    """
    key = F.coalesce(F.col("doc_id").cast(_LONG), F.lit(_NO_ID).cast(_LONG))
    base = docs.select(key.alias("k"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    links = neighbours(base).select(
        F.col("next_k").alias("k"), F.col("k").alias("of"), "need", F.col("next_sha").alias("sha")
    )
    # An equality of digests would become a second join key and with it another shuffle of the texts.
    heads = base.join(links, "k").where(F.startswith(F.sha2("text", 256), F.col("sha")))
    heads = with_lanes(heads.select("of", "need", "text"), "text", "next_")
    heads = heads.select(
        F.col("of").alias("k"), F.expr("substring(text, 1, need)").alias("head"), "next_exact", "next_bits", "next_n"
    ).dropDuplicates(["k"])
    both = base.join(heads, "k")
    n, m = F.length("text"), F.floor(F.length("text") / 3)
    both = both.withColumns({"n_chars": n.cast(_LONG), "m": m.cast("int")})
    edited = F.expr("concat(substring(text, 1, cast(n_chars as int) - m), substring(head, 1, m))")
    both = with_lanes(with_lanes(both.withColumn("edited", edited), "text", "own_"), "edited", "edit_")
    return both.select(
        F.when(F.col("k") != _NO_ID, F.col("k")).alias("doc_id"), "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"), rendered("own_").alias("fingerprint"),
        rendered("edit_").alias("edited_fingerprint"), likeness("own_", "edit_").alias("near_edited"),
        likeness("own_", "next_").alias("near_next"),
    )
