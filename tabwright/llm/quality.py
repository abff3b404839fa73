r"""Quality by nearest-neighbour voting over labelled latent-semantic vectors.

A document's terms are its character-class trigrams (nine classes: lower, upper, digit, blank, line
end, sentence mark, exclamation mark, other ASCII, beyond ASCII) and how often its words repeat.
Log counts, weighted by inverse document frequency and by length 1, are projected on the leading
singular directions of the labelled sample: that is the latent-semantic vector. Every document's
cosine with every labelled vector is computed exactly, in blocks; the ``neighbours`` largest vote
with their similarity as weight.

Fitting uses at most ``max_labelled`` labelled rows, chosen by a hash of the id, so the vectors sent to
the tasks are bounded by that parameter. Scoring reads every text whole.

Defined results: null and empty texts have no vector and get the sample's share of label 1, as does any
document without a positive similarity; without labelled rows the score is 0.5. A label that is null
is no label; repeated labels of a document each count. Other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import fold


@dataclass(frozen=True)
class KnnOptions:
    max_labelled: int = 4096
    dims: int = 48
    neighbours: int = 15
    #: Rows of one cosine block.
    block: int = 512
    threshold: float = 0.5


_CLASSES = 9
_CLASS = np.full(256, 7, dtype=np.int32)
_CLASS[128:] = 8
for _chars, _kind in (
    ("abcdefghijklmnopqrstuvwxyz", 0), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), ("0123456789", 2), (" \t\x0b\x0c", 3),
    ("\r\n", 4), (".,;:?", 5), ("!", 6),
):
    for _c in _chars:
        _CLASS[ord(_c)] = _kind
N_TRIGRAMS = _CLASSES**3
#: Beside the trigrams: words that repeat the word before, words seen before, words in all.
N_TERMS = N_TRIGRAMS + 3


def term_counts(texts: list[str]) -> np.ndarray:
    """(texts, N_TERMS) counts over whole texts."""
    out = np.zeros((len(texts), N_TERMS), dtype=np.float32)
    for row, text in zip(out, texts):
        raw = text.encode("utf-8", "surrogatepass")
        kinds = _CLASS[np.frombuffer(raw, dtype=np.uint8)]
        if len(kinds) > 2:
            codes = (kinds[:-2] * _CLASSES + kinds[1:-1]) * _CLASSES + kinds[2:]
            row[:N_TRIGRAMS] = np.bincount(codes, minlength=N_TRIGRAMS)
        words = raw.split()
        row[N_TRIGRAMS] = sum(map(bytes.__eq__, words[1:], words))
        row[N_TRIGRAMS + 1] = len(words) - len(set(words))
        row[N_TRIGRAMS + 2] = len(words)
    return out


@dataclass
class LatentVoter:
    """Term weights, projection, and the labelled vectors with their labels."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    opts: KnnOptions

    @classmethod
    def fit(cls, counts: np.ndarray, labels: np.ndarray, opts: KnnOptions) -> LatentVoter:
        n = len(counts)
        idf = np.log((1 + n) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1
        made = cls(idf, np.eye(counts.shape[1], dtype=np.float32), counts[:0], labels, opts)
        weighed = made.weighed(counts)
        # Right singular vectors through the small Gram matrix of the terms.
        values, basis = np.linalg.eigh((weighed.T @ weighed).astype(np.float64))
        made.basis = basis[:, np.argsort(values)[::-1][: opts.dims]].astype(np.float32)
        made.vectors = made.latent(counts)
        return made

    def weighed(self, counts: np.ndarray) -> np.ndarray:
        # Shares of the text, not raw counts: a long text then looks like a short one of its kind.
        rate = counts / np.maximum(counts[:, -1:], 1)
        return _unit(np.log1p(20 * rate) * self.idf)

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return _unit(self.weighed(counts) @ self.basis)

    def vote(self, counts: np.ndarray) -> np.ndarray:
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        out = np.full(len(counts), prior)
        if not len(self.labels):
            return out
        k = min(self.opts.neighbours, len(self.labels))
        for start in range(0, len(counts), self.opts.block):
            part = counts[start : start + self.opts.block]
            cosine = self.latent(part) @ self.vectors.T
            # Ties between neighbours are broken by their place in the sample, which is fixed by hash.
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64)
            weight *= (part[:, -1:] > 0)
            total = weight.sum(axis=1)
            share = (weight * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
            out[start : start + len(part)] = np.where(total > 0, share, prior)
        return np.clip(out, 0.0, 1.0)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(doc_id, text, y): at most ``limit`` labelled rows outside the held-out fold, by a hash of the id."""
    chosen = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 3) != 1))
    chosen = chosen.select(F.col("doc_id").alias("labelled_id"), F.col(label).cast("int").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("labelled_id"), "labelled_id", "y").limit(limit)
    # At most ``limit`` ids: the broadcast is bounded by the parameter.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id")).select(
        "doc_id", "text", "y"
    )


def fit(docs: DataFrame, labels: DataFrame, opts: KnnOptions = KnnOptions()) -> LatentVoter:
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = term_counts([t if isinstance(t, str) else "" for t in frame.text])
            yield pd.DataFrame({"doc_id": frame.doc_id.array, "y": frame.y.array, "terms": [r.tobytes() for r in rows]})

    sample = labelled_sample(docs, labels, "quality", opts.max_labelled)
    got = sample.mapInPandas(count, "doc_id long, y int, terms binary").orderBy("doc_id", "y").collect()
    got = got[: opts.max_labelled]  # rows that repeat an id could pass the limit
    counts = np.frombuffer(b"".join(r.terms for r in got), dtype=np.float32).reshape(-1, N_TERMS)
    return LatentVoter.fit(counts, np.array([r.y for r in got], dtype=np.float64), opts)


def scored(docs: DataFrame, labels: DataFrame, opts: KnnOptions = KnnOptions()) -> DataFrame:
    """All columns of ``docs`` and ``quality_score``: the weighted share of label 1, in one narrow pass."""
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, opts))

    @F.pandas_udf("double")
    def vote(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            parts = []
            for start in range(0, len(batch), held.value.opts.block):
                chunk = [t if isinstance(t, str) else "" for t in batch.iloc[start : start + held.value.opts.block]]
                parts.append(held.value.vote(term_counts(chunk)))
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return docs.withColumn("quality_score", vote.asNondeterministic()(F.col("text")))


def predicted(score: Column, threshold: float) -> Column:
    return (score >= threshold).cast("int")
