"""Benchmark decontamination: BM25 over an inverted index of the test items, pruned by block maxima.

The test items are the indexed side. Every window of every training document is a query; all
items whose BM25 score reaches ``recall_share`` of the item's score with itself are retrieved,
none is cut by rank. A retrieved item counts as leaked when ``min_overlap`` of the five-word
shingles of its first half (question) and of its second half (answer) stand in the window.

Pruning: terms are split per item into a cheap part, whose summed weight per item stays small, and an
essential part. Items stand in blocks; for each (window, block) the block's largest cheap sum plus
the block maxima of the essential terms seen bounds every score, and only pairs whose bound reaches
the threshold are scored.

Nulls and empty texts give no rows; an item of no or one word lacks a half and is never leaked. Repeated rows of a
document give the same rows again; repeated items each get their own rows. Columns beside the id
and the text are ignored.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import partial
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import offsets, slices, texts
from tabwright.sources.scratch import written

SCHEMA = "doc_id long, item_id long, bm25_share double, question_overlap double, answer_overlap double"


@dataclass(frozen=True)
class Bm25Options:
    k1: float = 1.2
    b: float = 0.75
    recall_share: float = 0.4
    min_overlap: float = 0.8
    shingle: int = 5
    block_items: int = 2
    least_window: int = 128
    #: Text bytes of the items that one index may hold; more items make more indexes.
    index_bytes: int = 32 << 20
    #: Characters of documents that stand as words at a time; a longer text stands alone.
    slice_chars: int = 1 << 20
    #: Postings that are expanded at a time, a window at least.
    posting_chunk: int = 1 << 19


_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def plain_words(text: str) -> list[bytes]:
    """Words of ASCII letters, digits and all non-ASCII characters, lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def shingles(tokens: list, size: int) -> set[tuple]:
    if not tokens:
        return set()
    return {tuple(tokens[i : i + size]) for i in range(max(1, len(tokens) - size + 1))}


@dataclass(frozen=True)
class ItemStats:
    """What the weights take from all items: their number, words in all, and items per word."""

    n: int
    n_words: int
    df: dict[bytes, int]


def item_stats(items: list[tuple[int, list[bytes]]]) -> ItemStats:
    return ItemStats(len(items), sum(len(w) for _, w in items), Counter(t for _, w in items for t in set(w)))


@dataclass
class BlockIndex:
    """Inverted index of test items: weights are shares of the item's threshold, so 1 retrieves.

    ``stats`` are those of all items where these are a part of them; ``df`` needs the words of these only.
    """

    items: list[tuple[int, list[bytes]]]
    opts: Bm25Options = field(default_factory=Bm25Options)
    stats: ItemStats | None = None

    def __post_init__(self) -> None:
        o = self.opts
        self.items = [(i, w) for i, w in self.items if w]
        n = len(self.items)
        own = item_stats(self.items)
        whole = self.stats or own
        self.vocab = {t: k for k, t in enumerate(own.df)}
        idf = {t: np.log(1 + (whole.n - whole.df[t] + 0.5) / (whole.df[t] + 0.5)) for t in own.df}
        mean = whole.n_words / max(whole.n, 1)
        weights = []
        for _, w in self.items:
            norm = o.k1 * (1 - o.b + o.b * len(w) / mean)
            raw = {t: idf[t] * c * (o.k1 + 1) / (c + norm) for t, c in Counter(w).items()}
            least = o.recall_share * sum(raw.values())
            weights.append({self.vocab[t]: v / least for t, v in raw.items()})
        # Items of like words stand together, so that block maxima stay near single weights.
        order = sorted(range(n), key=lambda i: sorted(weights[i], key=weights[i].get)[0])
        self.items, self.weights = [self.items[i] for i in order], [weights[i] for i in order]
        self.n_blocks = -(-n // o.block_items)
        common = np.array([own.df[t] > max(2, 0.02 * n) for t in self.vocab], dtype=bool)
        self.cheap = np.zeros(self.n_blocks)
        best: dict[tuple[int, int], float] = defaultdict(float)
        for i, w in enumerate(self.weights):
            block = i // o.block_items
            spare = 0.0
            for t, v in w.items():
                if common[t] and spare + v < 0.5:
                    spare += v
                else:
                    best[t, block] = max(best[t, block], v)
            self.cheap[block] = max(self.cheap[block], spare)
        by_term: dict[int, list[tuple[int, float]]] = defaultdict(list)
        for (t, block), v in best.items():
            by_term[t].append((block, v))
        counts = np.array([len(by_term[t]) for t in range(len(self.vocab))], dtype=np.int64)
        self.post_at = offsets(counts)
        flat = [p for t in range(len(self.vocab)) for p in by_term[t]]
        self.post_block = np.array([p[0] for p in flat], dtype=np.int64)
        self.post_most = np.array([p[1] for p in flat])
        longest = max((len(w) for _, w in self.items), default=0)
        self.window = max(o.least_window, 2 * longest)
        self.stride = self.window - longest if longest < o.least_window else longest
        halves = [(w[: (len(w) + 1) // 2], w[(len(w) + 1) // 2 :]) for _, w in self.items]
        self.halves = [(shingles(q, o.shingle), shingles(a, o.shingle)) for q, a in halves]

    def candidates(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """(window, block) pairs whose bound reaches the threshold, as window * n_blocks + block.

        ``ids``: term per word of the batch, -1 if unknown; a window is words [start, end).
        """
        known = np.flatnonzero(ids >= 0)
        known = known[self.post_at[ids[known] + 1] > self.post_at[ids[known]]]
        first, last = np.searchsorted(known, starts), np.searchsorted(known, ends)
        fan = self.post_at[ids[known] + 1] - self.post_at[ids[known]]
        fan_at = offsets(fan)
        # Windows are taken in runs whose postings fit a chunk.
        n_postings = fan_at[last] - fan_at[first]
        run = (np.cumsum(n_postings) - n_postings) // self.opts.posting_chunk
        cuts = np.flatnonzero(np.diff(run)) + 1
        out = [np.empty(0, dtype=np.int64)]
        for lo, hi in zip([0, *cuts], [*cuts, len(starts)]):
            n_hits = last[lo:hi] - first[lo:hi]
            window = np.repeat(np.arange(lo, hi), n_hits)
            hit = np.arange(n_hits.sum()) + np.repeat(first[lo:hi] - offsets(n_hits)[:-1], n_hits)
            width = fan[hit]
            post = np.arange(width.sum()) + np.repeat(self.post_at[ids[known[hit]]] - offsets(width)[:-1], width)
            key = np.repeat(window, width) * self.n_blocks + self.post_block[post]
            # Cheap sums stay below the threshold, so a block without an essential term is out.
            pairs, at = np.unique(key, return_inverse=True)
            bound = np.bincount(at, weights=self.post_most[post], minlength=len(pairs)) + self.cheap[pairs % self.n_blocks]
            out.append(pairs[bound >= 1 - 1e-9])
        return np.concatenate(out)

    def query(self, doc_ids: list, batch: list[str]) -> Iterator[tuple]:
        """Rows of SCHEMA; per document and item the window with the largest score."""
        tokens = [plain_words(t) for t in batch]
        at = offsets([len(t) for t in tokens])
        get = self.vocab.get
        ids = np.concatenate(
            [np.fromiter(map(get, t, repeat(-1)), dtype=np.int64, count=len(t)) for t in tokens]
            or [np.empty(0, dtype=np.int64)]
        )
        n_windows = [max(1, -(-(len(t) - self.window) // self.stride) + 1) if t else 0 for t in tokens]
        doc = np.repeat(np.arange(len(tokens)), n_windows)
        rank = np.arange(len(doc)) - np.repeat(offsets(n_windows)[:-1], n_windows)
        starts = at[doc] + rank * self.stride
        ends = np.minimum(starts + self.window, at[doc + 1])
        found: dict[tuple[int, int], tuple] = {}
        for key in self.candidates(ids, starts, ends):
            w, block = divmod(int(key), self.n_blocks)
            terms = set(ids[starts[w] : ends[w]].tolist())
            lo = block * self.opts.block_items
            for i in range(lo, min(lo + self.opts.block_items, len(self.items))):
                weights = self.weights[i]
                score = sum(map(weights.__getitem__, weights.keys() & terms))
                if score < 1 - 1e-9:
                    continue
                d = int(doc[w])
                seen = shingle_sets(tokens[d][starts[w] - at[d] : ends[w] - at[d]], self.halves[i], self.opts.shingle)
                q, a = (len(s & have) / len(s) if s else 0.0 for s, have in zip(self.halves[i], seen))
                row = (min(q, a), score * self.opts.recall_share, q, a)
                found[d, i] = max(found.get((d, i), row), row)
        for (d, i), (_, share, q, a) in found.items():
            yield doc_ids[d], self.items[i][0], share, q, a


def shingle_sets(tokens: list[bytes], halves: tuple[set, set], size: int) -> list[set]:
    """Shingles of a window, once per half, in the length that the half's shingles have."""
    lengths = [len(next(iter(h))) if h else size for h in halves]
    return [shingles(tokens, n) for n in lengths]


_indexes: dict[str, BlockIndex] = {}


def _built(key: str, held: Broadcast, opts: Bm25Options) -> BlockIndex:
    """The index of a shard, built once per Python worker, which keeps one; ``key`` names the shard."""
    if key not in _indexes:
        _indexes.clear()
        _indexes[key] = BlockIndex(held.value[0], opts, held.value[1])
    return _indexes[key]


def _shards(items: DataFrame, opts: Bm25Options) -> Iterator[Callable[[], BlockIndex]]:
    """Indexes for tasks, each sent as a broadcast pair of a list of (item_id, words), of bounded text size, and the counts of its words over all items."""
    usable = items.where("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = usable.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-size // opts.index_bytes))
    broadcast = items.sparkSession.sparkContext.broadcast

    def send(pair: tuple) -> Callable[[], BlockIndex]:
        return partial(_built, uuid.uuid4().hex, broadcast(pair), opts)

    def listed(part: DataFrame) -> list[tuple[int, list[bytes]]]:
        return [(r.item_id, w) for r in part.collect() if (w := plain_words(r.text))]

    if n == 1:
        held = listed(usable)
        yield send((held, item_stats(held)))
        return

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames):
            stats = item_stats([(0, w) for t in frame.text if (w := plain_words(t))])
            # The empty word stands for the items themselves: their number and their words.
            yield pd.DataFrame(
                {"word": [b"", *stats.df], "n": [stats.n, *stats.df.values()], "n_words": [stats.n_words] + [0] * len(stats.df)}
            )

    counts = usable.select("text").mapInPandas(count, "word binary, n long, n_words long").groupBy("word")
    counts = written(counts.agg(F.sum("n").alias("n"), F.sum("n_words").alias("n_words")), "item-words")
    whole = counts.where(F.length("word") == 0).first()
    for shard in range(n):
        part = usable.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == shard)
        held = listed(part)
        # Only the words of this part are needed, whose size is bounded.
        mine = part.select("text").mapInPandas(count, "word binary, n long, n_words long").select("word").distinct()
        df = {bytes(r.word): r.n for r in counts.where(F.length("word") > 0).join(mine, "word").select("word", "n").collect()}
        yield send((held, ItemStats(whole.n if whole else 0, whole.n_words if whole else 0, df)))


def retrieved(docs: DataFrame, items: DataFrame, opts: Bm25Options = Bm25Options()) -> DataFrame:
    """All (document, item) pairs above the BM25 threshold, with both overlaps.

    ``docs``: doc_id, text; ``items``: item_id, text. The items are split over as many indexes as
    their measured size asks for; each index is sent to the tasks and all documents query it.
    """
    queries = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text <> ''")
    out = None
    for shard in _shards(items, opts):

        def search(frames: Iterator[pd.DataFrame], shard=shard) -> Iterator[pd.DataFrame]:
            index = shard()
            for frame in slices(frames, chars=opts.slice_chars) if index.items else ():
                ids = [None if pd.isna(i) else int(i) for i in frame.doc_id]
                rows = list(index.query(ids, texts(frame)))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")]).astype(
                    {"doc_id": "Int64", "item_id": "Int64"}
                )

        found = queries.mapInPandas(search, SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out


def leaks(docs: DataFrame, items: DataFrame, opts: Bm25Options = Bm25Options()) -> DataFrame:
    """The verified pairs of :func:`retrieved`."""
    both = (F.col("question_overlap") >= opts.min_overlap) & (F.col("answer_overlap") >= opts.min_overlap)
    return retrieved(docs, items, opts).where(both)


def without_leaks(docs: DataFrame, items: DataFrame, opts: Bm25Options = Bm25Options()) -> DataFrame:
    """Documents without a leaked item, all columns kept; no shuffle, a null text is never leaked."""
    for shard in _shards(items, opts):

        def keep(batches: Iterator[pa.RecordBatch], shard=shard) -> Iterator[pa.RecordBatch]:
            index = shard()
            for batch in batches:
                sizes = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                slot = (np.cumsum(sizes) - sizes) // opts.slice_chars
                cuts = np.flatnonzero(np.diff(slot)) + 1
                for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                    part = batch.slice(start, end - start)
                    if index.items and part.num_rows:
                        rows = index.query(list(range(end - start)), [t or "" for t in part.column("text").to_pylist()])
                        bad = {row[0] for row in rows if min(row[3], row[4]) >= opts.min_overlap}
                        part = part.filter(pa.array([i not in bad for i in range(end - start)], type=pa.bool_()))
                    yield part

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
