r"""Source divergence audit: how far the term shares of every source lie from those of its language's other sources.

Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased; null text, lang and source
are ''. A language keeps the V terms that stand in at least ``min_docs`` of its documents. A group (a
source of a language, or the language as a whole) with n_t occurrences of a kept term, N in all, gives it the share
p = 1 + floor(SCALE * (n_t + 2) / (N + 2 V)); two shares differ by f = floor((p - q)^2 / (p + q)). The
divergence of two sources is the sum of f over all kept terms, those that neither has included.

Most terms are absent from most sources, so sums are taken over the terms that stand there (Gustavson's
row-wise sparse product) and the rest is put right in closed form. With p0 a source's share of an absent term:

    sum of f(p, q) = V f(p0, q0)                                        all terms absent in both
                   + sum over A's terms of f(p, q0) - f(p0, q0)         as if B had none of them
                   + sum over B's terms of f(p0, q) - f(p0, q0)
                   + sum over shared terms of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)

The first three need a source's histogram of counts only. The last is accumulated row by row: postings
stand term-major in slices of bounded size; in each slice every source scatters its terms through the
index into one dense accumulator over its peers, so no pair of postings is ever emitted. A slice holds
terms of one language; a language or source with a third of all rows has more slices, not larger ones.

Repeated rows count each. Ids and other columns are ignored. An empty table has no rows; a language
without kept terms has pairs of value 0 and no terms. Integers only; results do not depend on partitions.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.sources.scratch import written

SCALE = 1_000_000_000
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


@dataclass(frozen=True)
class AuditOptions:
    min_docs: int = 10
    #: Terms reported per source.
    top_terms: int = 10
    #: Postings of one slice of the term-major index.
    slice_postings: int = 400_000
    #: Distinct terms that a task holds before it hands its counts on.
    held_terms: int = 400_000


def term_list(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TERMS).split()


def term_counts(docs: DataFrame, opts: AuditOptions = AuditOptions()) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term; the term '' counts the group's documents.

    Tasks add up their own rows first; what they hold is bounded by ``held_terms``.
    """
    shape = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])

    def handed(counts: dict, seen: dict, rows: Counter) -> Iterator[pa.RecordBatch]:
        for (lang, source), docs_of in seen.items():
            n_of = counts[lang, source]
            terms = ["", *[t.decode("utf-8", "surrogatepass") for t in docs_of]]
            n, in_docs = [0, *map(n_of.__getitem__, docs_of)], [rows[lang, source], *docs_of.values()]
            columns = [[lang] * len(terms), [source] * len(terms), terms, n, in_docs]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, shape)], schema=shape)

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen, rows, held = defaultdict(Counter), defaultdict(Counter), Counter(), 0
        for frame in frames:
            for start in range(0, frame.num_rows, 64):
                part = frame.slice(start, 64)
                for lang, source, text in zip(*[part.column(c).to_pylist() for c in ("lang", "source", "text")]):
                    key, terms = (lang, source), term_list(text)
                    docs_of = seen[key]
                    held -= len(docs_of)
                    counts[key].update(terms)
                    docs_of.update(set(terms))
                    held += len(docs_of)
                    rows[key] += 1
                if held > opts.held_terms:
                    yield from handed(counts, seen, rows)
                    counts, seen, rows, held = defaultdict(Counter), defaultdict(Counter), Counter(), 0
        yield from handed(counts, seen, rows)

    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    parts = plain.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column | int, total: Column, v: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 v)), in decimals: counts may pass 9e9; null without kept terms."""
    n = F.lit(n) if isinstance(n, int) else n
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    whole = F.nullif((total + 2 * v).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.call_function("div", scaled, whole) + 1


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of two shares."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def gap_array(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


@dataclass
class Audit:
    """``groups``: (lang, source, total, v, none), the share of an absent term last; ``postings``: (lang, source, term, n, lang_n)."""

    groups: DataFrame
    postings: DataFrame


def audit_tables(docs: DataFrame, opts: AuditOptions = AuditOptions()) -> Audit:
    counts = written(term_counts(docs, opts), "term-counts")
    term = Window.partitionBy("lang", "term")
    of_term = counts.where("term <> ''").select(
        "lang", "source", "term", "n", F.sum("docs").over(term).alias("in_docs"), F.sum("n").over(term).alias("lang_n"),
        # One row of every term counts it.
        (F.row_number().over(term.orderBy("source")) == 1).cast("long").alias("first"),
    )
    postings = written(of_term.where(F.col("in_docs") >= opts.min_docs).drop("in_docs"), "kept-postings")
    totals = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = postings.groupBy("lang").agg(F.sum("first").alias("v"), F.sum("n").alias("lang_total"))
    groups = counts.where("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["total", "v", "lang_total"])
    groups = groups.withColumn("none", share(0, F.col("total"), F.col("v")))
    return Audit(written(groups, "audit-groups"), postings.drop("first"))


def shares(audit: Audit) -> DataFrame:
    """Postings with the group's shares; the groups' table is written, so Spark knows its size and picks the join."""
    both = audit.postings.join(audit.groups, ["lang", "source"])
    return both.withColumn("p", share(F.col("n"), F.col("total"), F.col("v")))


def top_terms(audit: Audit, opts: AuditOptions = AuditOptions()) -> DataFrame:
    """(lang, source, item, value, rank): kept terms that a source has more of than its language, the most divergent first."""
    both = shares(audit).withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("v")))
    over = both.where("p > q").select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return over.withColumn("rank", F.row_number().over(group)).where(F.col("rank") <= opts.top_terms)


def accumulated(source: np.ndarray, term: np.ndarray, p: np.ndarray, none: np.ndarray, chunk: int = 1 << 20) -> Iterator[tuple]:
    """(row, sums over its peers) per source of a slice: corrections of shared terms.

    ``source`` and ``term`` are codes from 0; ``none`` is a source's share of an absent term. Each row
    scatters its terms through the term-major index into one dense array.
    """
    n_sources, n_terms = int(source.max()) + 1, int(term.max()) + 1
    by_term = np.argsort(term, kind="stable")
    col_source, col_p = source[by_term], p[by_term]
    at = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=n_terms))))
    absent = np.zeros(n_sources, dtype=np.int64)
    absent[source] = none
    rows = np.argsort(source, kind="stable")
    cuts = np.concatenate(([0], np.cumsum(np.bincount(source, minlength=n_sources))))
    for row in range(n_sources):
        dense = np.zeros(n_sources, dtype=np.int64)
        own = rows[cuts[row] : cuts[row + 1]]
        fan = at[term[own] + 1] - at[term[own]]
        # Runs of the row's terms whose postings together fit a chunk.
        run = (np.cumsum(fan) - fan) // chunk
        for part in np.split(np.arange(len(own)), np.flatnonzero(np.diff(run)) + 1):
            mine, wide = own[part], fan[part]
            first = np.cumsum(wide) - wide
            post = np.arange(wide.sum()) - np.repeat(first, wide) + np.repeat(at[term[mine]], wide)
            peer, q, mp = col_source[post], col_p[post], np.repeat(p[mine], wide)
            p0, q0 = absent[row], absent[peer]
            np.add.at(dense, peer, gap_array(mp, q) - gap_array(mp, q0) - gap_array(np.full_like(q, p0), q) + gap_array(np.full_like(q, p0), q0))
        dense[row] = 0
        yield row, dense


def shared_corrections(audit: Audit, opts: AuditOptions = AuditOptions()) -> DataFrame:
    """(lang, source, item, value) per slice, source and peer: the last sum of the module's formula."""
    n = max(1, -(-audit.postings.count() // opts.slice_postings))
    cut = shares(audit).withColumn("cut", F.pmod(F.xxhash64("term"), F.lit(n)))
    cut = cut.repartition("lang", "cut").sortWithinPartitions("lang", "cut").select("lang", "cut", "source", "term", "p", "none")
    shape = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def whole(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(parts).combine_chunks()
        coded = {c: held[c].combine_chunks().dictionary_encode() for c in ("source", "term")}
        if isinstance(coded["source"], pa.ChunkedArray):
            coded = {c: a.combine_chunks() for c, a in coded.items()}
        names = coded["source"].dictionary
        lang = held["lang"][0].as_py()
        codes = [coded[c].indices.to_numpy(zero_copy_only=False).astype(np.int64) for c in ("source", "term")]
        for row, dense in accumulated(*codes, held["p"].to_numpy(), held["none"].to_numpy()):
            peers = np.flatnonzero(dense)
            if len(peers):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(peers)), pa.array([names[row].as_py()] * len(peers)), names.take(pa.array(peers)), pa.array(dense[peers])],
                    schema=shape,
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, key = [], None
        for batch in batches:
            lang = batch.column("lang").dictionary_encode()
            codes, cuts = lang.indices.to_numpy(), batch.column("cut").to_numpy()
            change = np.flatnonzero((np.diff(codes) != 0) | (np.diff(cuts) != 0)) + 1
            for start, end in zip([0, *change], [*change, batch.num_rows]):
                now = (lang[int(start)].as_py(), int(cuts[start])) if end > start else key
                if parts and now != key:
                    yield from whole(parts)
                    parts = []
                key = now
                if end > start:
                    parts.append(batch.slice(start, end - start))
        if parts:
            yield from whole(parts)

    return cut.mapInArrow(run, "lang string, source string, item string, value long")


def baselines(audit: Audit, salts: int = 16) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs: the first three sums of the module's formula, in parts.

    A source's histogram of counts has at most sqrt(2 N) entries. All pairs of a language are the
    result itself; ``salts`` spreads a language with most of the sources.
    """
    bars = shares(audit).groupBy("lang", "source", "p").agg(F.count("*").alias("k"))
    bars = bars.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "k")).alias("bars"))
    rows = audit.groups.join(bars, ["lang", "source"], "left").select(
        "lang", "source", F.col("none").alias("p0"), "v", "bars", F.pmod(F.xxhash64("source"), F.lit(salts)).alias("salt")
    )
    every_salt = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt")
    peers = audit.groups.select("lang", F.col("source").alias("item"), F.col("none").alias("q0"), every_salt)
    pairs = rows.join(peers, ["lang", "salt"]).where("source <> item")
    p0, q0 = F.col("p0"), F.col("q0")
    own = F.aggregate(
        F.coalesce("bars", F.array().cast("array<struct<p bigint, k bigint>>")), F.lit(0).cast("long"),
        lambda acc, b: acc + b["k"] * (gap(b["p"], q0) - gap(p0, q0)),
    )
    pairs = pairs.select("lang", "source", "item", F.coalesce(own, F.lit(0)).alias("own"), F.coalesce(F.col("v") * gap(p0, q0), F.lit(0)).alias("base"))
    both = F.array(
        F.struct("source", "item", (F.col("own") + F.col("base")).alias("value")),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("own").alias("value")),
    )
    return pairs.select("lang", F.inline(both))


def pair_divergence(audit: Audit, opts: AuditOptions = AuditOptions()) -> DataFrame:
    """(lang, source, item, value, rank): every other source of the language, the most divergent first."""
    sums = baselines(audit).unionByName(shared_corrections(audit, opts)).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return sums.withColumn("rank", F.row_number().over(group))


def divergence(docs: DataFrame, opts: AuditOptions = AuditOptions()) -> DataFrame:
    """Both parts: (lang, source, part, item, value, rank) with part ``pair`` or ``term``."""
    audit = audit_tables(docs, opts)
    cols = ["lang", "source", "part", "item", "value", "rank"]
    pairs = pair_divergence(audit, opts).withColumn("part", F.lit("pair")).select(*cols)
    return pairs.unionByName(top_terms(audit, opts).withColumn("part", F.lit("term")).select(*cols))
