r"""Hashed maximum-entropy language model with a class-factored softmax.

log P(token | context) = log P(class | context) + log P(token | class).

* Classes: the end mark, the ``own`` most frequent words one by one, and ``groups`` groups of all other
  words by a hash of their last three bytes.
* P(class | context) is a softmax over hashed features of the words before: the previous word, the pair
  before (an n-gram), and the word two back (a skip feature), each in its own buckets.
* P(token | class) is 1 for the single classes and add-one counts in a group, with one place for
  unseen words, as in the base model.

Training: in each of ``rounds`` rounds the tasks take gradient steps over their own share of the training
documents from the shared weights and return the changed rows; Spark adds the changes per feature row
and the driver moves the weights by their mean. A round takes the documents of one part of the table
by hash, so after all rounds each training document has been used once.

Counts cover all training tokens and are made by Spark. The ``frequent`` most frequent words travel with
the model (a bound that does not grow); counts of rarer words are joined to the documents' rare words.

Defined results: null and empty texts are the end mark alone. Rows with equal id and text get equal
results, each its own row. Without training documents both scores are those of all counts 0. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import fold, mix64, offsets, slices, texts, words
from tabwright.sources.scratch import written

#: The end mark: a blank is in no word.
END = b" "


@dataclass(frozen=True)
class LmOptions:
    fold: int = 7
    held_out: int = 2
    own: int = 31
    groups: int = 32
    previous: int = 2048
    skipped: int = 2048
    pairs: int = 4096
    frequent: int = 65_536
    rounds: int = 2
    rate: float = 0.15
    batch: int = 8192

    @property
    def n_features(self) -> int:
        return 1 + self.previous + self.skipped + self.pairs

    @property
    def n_classes(self) -> int:
        return 1 + self.own + self.groups


@dataclass
class Coded:
    """Tokens of a batch: code per token, hash and group per code, document bounds."""

    codes: np.ndarray
    hashes: np.ndarray
    groups: np.ndarray
    at: np.ndarray


def coded(batch: list[str], opts: LmOptions) -> Coded:
    tokens = [[*words(t), END] for t in batch]
    at = offsets([len(t) for t in tokens])
    coding = pa.array(list(chain.from_iterable(tokens)), pa.large_binary()).dictionary_encode()
    codes, distinct = coding.indices.to_numpy().astype(np.int64), coding.dictionary.to_numpy(zero_copy_only=False)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter(map(digest, distinct), dtype=np.uint64, count=len(distinct)).view(np.int64)
    tails = np.fromiter((digest(w[-3:]) for w in distinct), dtype=np.uint64, count=len(distinct))
    groups = (tails % np.uint64(opts.groups)).astype(np.int32)
    groups[distinct == END] = -1
    return Coded(codes, hashes, groups, at)


_END_HASH = int(np.uint64(xxhash.xxh3_64_intdigest(END)).astype(np.int64))


@dataclass
class LanguageModel:
    """What the tasks need: totals, the frequent words' counts, classes, group sizes and weights."""

    opts: LmOptions
    n: int
    v: int
    top_hash: np.ndarray
    top_count: np.ndarray
    own_hash: np.ndarray
    group_total: np.ndarray
    group_words: np.ndarray
    weights: np.ndarray

    def classes(self, c: Coded) -> np.ndarray:
        """Class per code."""
        place = np.searchsorted(self.own_hash, c.hashes)
        place[place == len(self.own_hash)] = 0
        own = self.own_hash[place] == c.hashes if len(self.own_hash) else np.zeros(len(c.hashes), bool)
        out = np.where(own, 1 + place, 1 + self.opts.own + c.groups)
        return np.where(c.groups < 0, 0, out)

    def known(self, c: Coded) -> np.ndarray:
        """Count per code among the frequent words, 0 elsewhere."""
        if not len(self.top_hash):
            return np.zeros(len(c.hashes), dtype=np.int64)
        place = np.minimum(np.searchsorted(self.top_hash, c.hashes), len(self.top_hash) - 1)
        return np.where(self.top_hash[place] == c.hashes, self.top_count[place], 0)

    def features(self, c: Coded) -> np.ndarray:
        """(tokens, 4) rows of the weights: bias, previous word, word two back, pair."""
        o = self.opts
        h = c.hashes.view(np.uint64)[c.codes]
        first = c.at[:-1]
        one = np.empty_like(h)
        two = np.empty_like(h)
        one[1:], two[2:] = h[:-1], h[:-2]
        one[first] = np.uint64(1)
        two[first] = np.uint64(2)
        second = first + 1
        two[second[second < c.at[1:]]] = np.uint64(1)
        pair = mix64(one * np.uint64(0x9E3779B97F4A7C15) ^ two)
        spread_one, spread_two = mix64(one), mix64(two ^ np.uint64(0xA5A5A5A5))
        out = np.zeros((len(h), 4), dtype=np.int32)
        out[:, 1] = 1 + spread_one % np.uint64(o.previous)
        out[:, 2] = 1 + o.previous + spread_two % np.uint64(o.skipped)
        out[:, 3] = 1 + o.previous + o.skipped + pair % np.uint64(o.pairs)
        return out

    def log_classes(self, features: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Natural log P(class | context) per token, in blocks."""
        out = np.empty(len(classes))
        step = self.opts.batch
        for i in range(0, len(classes), step):
            logit = _logits(self.weights, features[i : i + step])
            logit -= logit.max(axis=1, keepdims=True)
            own = logit[np.arange(len(logit)), classes[i : i + step]]
            np.exp(logit, out=logit)
            out[i : i + step] = own - np.log(logit.sum(axis=1, dtype=np.float64))
        return out

    def trained(self, batches: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, int]:
        """(changed rows, their change, tokens) after gradient steps over the batches."""
        w = self.weights.copy()
        seen = np.full(len(w), 1e-2, dtype=np.float32)
        n = 0
        for features, classes in batches:
            for i in range(0, len(classes), self.opts.batch):
                f, y = features[i : i + self.opts.batch], classes[i : i + self.opts.batch]
                error = _logits(w, f)
                error -= error.max(axis=1, keepdims=True)
                np.exp(error, out=error)
                error /= error.sum(axis=1, keepdims=True)
                error[np.arange(len(y)), y] -= 1
                n += len(y)
                # Every token has the bias: nothing to sort.
                sums = [(np.zeros(1, dtype=np.int64), error.sum(axis=0, keepdims=True))]
                sums += [row_sums(column, error) for column in f.T[1:]]
                for rows, grad in sums:
                    # One step size per feature row, by its squared gradients so far.
                    seen[rows] += (grad * grad).mean(axis=1)
                    w[rows] -= self.opts.rate * grad / np.sqrt(seen[rows])[:, None]
        changed = np.flatnonzero((w != self.weights).any(axis=1))
        return changed, w[changed] - self.weights[changed], n


#: Rows met more often than this are summed one by one.
_OFTEN = 16


def row_sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, sum of the rows of ``values`` of each), from the most to the least frequent key.

    The r-th rows of all keys are added at once, which costs a fraction of one reduction per key and column.
    """
    # Stable sorts of short integers are radix sorts.
    order = np.argsort(keys.astype(np.uint16) if keys.max() < 1 << 16 else keys, kind="stable")
    ordered = keys[order]
    heads = np.flatnonzero(np.diff(ordered, prepend=-1))
    counts = np.diff(heads, append=len(keys))
    falling = np.argsort(-counts, kind="stable")
    heads, counts = heads[falling], counts[falling]
    often = int(np.count_nonzero(counts > _OFTEN))
    out = values[order[heads]]
    for r in range(1, min(int(counts[0]), _OFTEN)):
        more = int(np.searchsorted(-counts, -r))
        out[often:more] += values[order[heads[often:more] + r]]
    for k in range(often):
        out[k] = values[order[heads[k] : heads[k] + counts[k]]].sum(axis=0)
    return ordered[heads], out


def _logits(w: np.ndarray, f: np.ndarray) -> np.ndarray:
    out = w[f[:, 1]]
    out += w[f[:, 2]]
    out += w[f[:, 3]]
    out += w[0]
    return out


def vocabulary(train: DataFrame, opts: LmOptions) -> DataFrame:
    """(h, g, c) of every distinct training token: hash, group (-1: end mark), count."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames, chars=32 << 20):
            c = coded(texts(frame), opts)
            yield pd.DataFrame({"h": c.hashes, "g": c.groups, "c": np.bincount(c.codes, minlength=len(c.hashes))})

    return train.select("text").mapInPandas(count, "h long, g int, c long").groupBy("h").agg(
        F.min("g").alias("g"), F.sum("c").alias("c")
    )


def _training_rows(docs: DataFrame, opts: LmOptions) -> DataFrame:
    return docs.where(fold(F.col("doc_id"), opts.fold) != opts.held_out)


def fit(docs: DataFrame, vocab: DataFrame, opts: LmOptions) -> LanguageModel:
    n, v = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = vocab.where("g >= 0").orderBy(F.desc("c"), "h").limit(opts.frequent).select("h", "c").collect()
    own = np.sort(np.array([r.h for r in top[: opts.own]], dtype=np.int64))
    order = np.argsort(np.array([r.h for r in top], dtype=np.int64))
    ends = vocab.where("g < 0").select("c").first()
    top_hash = np.array([r.h for r in top], dtype=np.int64)[order]
    top_count = np.array([r.c for r in top], dtype=np.int64)[order]
    single = F.col("h").isin([int(h) for h in own])
    sizes = vocab.where((F.col("g") >= 0) & ~single).groupBy("g").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("w"))
    total, distinct = np.zeros(opts.groups), np.zeros(opts.groups)
    for r in sizes.collect():
        total[r.g], distinct[r.g] = r.c, r.w
    weights = np.zeros((opts.n_features, opts.n_classes), dtype=np.float32)
    # Start at the classes' shares, so the first gradients already concern the context.
    place = {int(h): k for k, h in enumerate(own)}
    share = np.zeros(opts.n_classes)
    share[0] = ends.c if ends else 0
    for r in top[: opts.own]:
        share[1 + place[r.h]] = r.c
    share[1 + opts.own :] = total
    weights[0] = np.log((share + 1) / (share.sum() + opts.n_classes))
    # The end mark counts as a frequent word whatever its rank.
    end_at = np.searchsorted(top_hash, _END_HASH)
    top_hash = np.insert(top_hash, end_at, _END_HASH)
    top_count = np.insert(top_count, end_at, ends.c if ends else 0)
    model = LanguageModel(opts, int(n), int(v), top_hash, top_count, own, total, distinct, weights)
    for turn in range(opts.rounds):
        part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(opts.rounds)) == turn
        _round(_training_rows(docs, opts).where(part).select("text"), model)
    return model


def _round(docs: DataFrame, model: LanguageModel) -> None:
    """One distributed round: tasks train from the shared weights, the mean change moves them."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def train(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = held.value

        def batches():
            for frame in slices(frames):
                c = coded(texts(frame), own.opts)
                yield own.features(c), own.classes(c)[c.codes]

        rows, change, n = own.trained(batches())
        if n:
            yield pd.DataFrame({"row": rows, "n": n, "change": [x.tobytes() for x in change.astype(np.float16)]})

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        weight: dict[int, float] = {}
        for frame in frames:
            for row, n, change in zip(frame.row, frame.n, frame.change):
                # Root of the tokens: a task with more text has gone further and counts for more.
                more = np.frombuffer(change, dtype=np.float16).astype(np.float64) * n**0.5
                total[row] = total.get(row, 0) + more
                weight[row] = weight.get(row, 0) + n**0.5
        rows = sorted(total)
        yield pd.DataFrame({"row": rows, "change": [(total[r] / weight[r]).astype(np.float32).tobytes() for r in rows]})

    changes = docs.mapInPandas(train, "row int, n long, change binary").repartition("row")
    for r in changes.mapInPandas(add, "row int, change binary").collect():  # at most n_features rows
        model.weights[r.row] += np.frombuffer(r.change, dtype=np.float32)
    held.unpersist()


_KEY = "doc_id long, mark long"
_PART = f"{_KEY}, h long, tf long, n_tokens long, n_known long, base double, score double"


def scored(docs: DataFrame, opts: LmOptions = LmOptions()) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    vocab = written(vocabulary(_training_rows(docs, opts), opts), "vocabulary")
    model = fit(docs, vocab, opts)
    held = docs.sparkSession.sparkContext.broadcast(model)
    place = float(np.log10(model.n + model.v + 1))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = held.value
        room = np.log10(m.group_total + m.group_words + 1)
        for frame in slices(frames):
            batch = texts(frame)
            c = coded(batch, m.opts)
            count, kind = m.known(c), m.classes(c)
            grouped = kind > m.opts.own
            log_count = np.log10(count + 1.0)
            inside = np.where(grouped, log_count - room[np.maximum(kind - 1 - m.opts.own, 0)], 0.0)
            class_part = m.log_classes(m.features(c), kind[c.codes]) / np.log(10)
            sums = [
                np.add.reduceat(x, c.at[:-1]) for x in (log_count[c.codes] - place, class_part + inside[c.codes])
            ]
            n_known = np.add.reduceat((count > 0)[c.codes].astype(np.int64), c.at[:-1])
            marks = np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) for t in batch], dtype=np.uint64)
            marks = marks.view(np.int64)
            ids = frame.doc_id.astype("Int64").array
            yield pd.DataFrame(
                {
                    "doc_id": ids, "mark": marks, "h": pd.array([pd.NA] * len(batch), dtype="Int64"), "tf": 0,
                    "n_tokens": np.diff(c.at), "n_known": n_known, "base": sums[0], "score": sums[1],
                }
            )
            # Words whose count is not at hand: one row per document and word.
            owner = np.repeat(np.arange(len(batch)), np.diff(c.at))
            rare = (count == 0)[c.codes]
            pairs, tf = np.unique(owner[rare] * len(c.hashes) + c.codes[rare], return_counts=True)
            who, what = np.divmod(pairs, len(c.hashes))
            yield pd.DataFrame(
                {
                    "doc_id": ids[who], "mark": marks[who], "h": c.hashes[what], "tf": tf,
                    "n_tokens": 0, "n_known": 0, "base": 0.0, "score": 0.0,
                }
            )

    parts = docs.mapInPandas(run, _PART)
    whole = model.v <= len(model.top_hash)  # no other word has a count
    parts = parts if whole else written(parts, "lm-parts")
    rows = parts.where("h IS NULL").select("doc_id", "mark", F.lit(1).alias("copies"), "n_tokens", "n_known", "base", "score")
    if not whole:
        seen = parts.where("h IS NOT NULL").select("doc_id", "mark", "h", "tf").join(vocab.select("h", "c"), "h")
        gain = F.col("tf") * F.log10(F.col("c") + 1.0)
        rare = seen.groupBy("doc_id", "mark").agg(F.sum("tf").alias("n_known"), F.sum(gain).alias("base"))
        rows = rows.unionByName(
            rare.select("doc_id", "mark", F.lit(0).alias("copies"), F.lit(0).cast("long").alias("n_tokens"), "n_known", "base",
                        F.col("base").alias("score"))
        )
    total = rows.groupBy("doc_id", "mark").agg(
        F.sum("copies").alias("copies"), *[F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base", "score")]
    )
    each = total.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))

    def share(name: str, kind: str):
        return (F.col(name) / F.col("copies")).cast(kind)

    return each.select(
        "doc_id", (fold(F.col("doc_id"), opts.fold) == opts.held_out).alias("held_out"),
        share("n_tokens", "long").alias("n_tokens"), share("n_known", "long").alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"), share("base", "double").alias("base_score"),
        share("score", "double").alias("score"),
    )
