r"""Toxicity by a support vector machine on a gap-weighted subsequence kernel with Nystroem landmarks.

Kernel. A word's features are its subsequences of three characters that lie within ``span`` characters,
each weighted ``decay`` per character of gap; k(s, t) is the cosine of two words' features. Letters in
between cost weight but do not hide a word, punctuation inside a word is left out, digits and signs
that stand for letters are read as them, and a run of single letters is read as one word.

Landmarks are words of the training sample that go with toxic texts: their rate in distinct toxic texts
is over three times that in clean ones, beyond chance at any share of toxic texts. A sentence has, per
landmark, the largest kernel value of its words; multiplied by the inverse root of the landmarks'
kernel matrix that is the Nystroem map, on which a linear machine is trained. A document is labelled,
its sentences are not, so a toxic document stands for its most toxic sentence (chosen anew in each
round) and a clean one for all its sentences. The document's score is the largest margin, put through
a logistic curve fitted on the sample.

Fitting uses at most ``max_labelled`` labelled rows, chosen by a hash of the id; copies of a text with
the same label count once. Scoring reads whole texts.

Defined results: null and empty texts have the margin of a sentence without any landmark. Without
labelled rows of both kinds the score is 0; where no word goes with toxic texts, it is their share. Null labels are none; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import offsets, slices
from tabwright.llm.quality import labelled_sample
from tabwright.sources.scratch import written


@dataclass(frozen=True)
class KernelOptions:
    max_labelled: int = 8000
    landmarks: int = 192
    span: int = 5
    decay: float = 0.6
    #: Kernel values below this count as 0, which keeps the word features sparse.
    floor: float = 0.45
    #: Sentences that stand for one document of the sample.
    sentences: int = 4
    rounds: int = 3
    cost: float = 4.0
    threshold: float = 0.7
    #: Likelihood ratio (chi square, one degree of freedom) that a landmark reaches: one word in a thousand by chance.
    evidence: float = 10.83


_SYMBOLS = 32
#: Digits and signs read as the letter they stand for.
_LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
_SENTENCE = re.compile(r"[.!?\n]+(?=\s|$)|\n")
_SINGLES = re.compile(r"(?<!\S)(?:\w[^\w\s]?\s){2,}\w(?!\w)")
_CODES: dict[int, int | None] = {}


def _code(char: str) -> int | None:
    char = _LOOKALIKE.get(char, char)
    if "a" <= char <= "z":
        return ord(char) - 96
    return 27 + ord(char) % 5 if char.isalnum() else None


class _Table(dict):
    """str.translate table to symbols 1..31, made as characters come up; others are left out."""

    def __missing__(self, key: int):
        code = _code(chr(key).lower()[0])
        self[key] = None if code is None else chr(code)
        return self[key]


_TABLE = _Table()


def symbols(word: str) -> str:
    return word.translate(_TABLE)


def sentences(text: str) -> list[list[str]]:
    """Words per sentence; runs of three or more single letters are joined to a word."""
    if _SINGLES.search(text):
        text = _SINGLES.sub(lambda m: re.sub(r"\W", "", m[0]), text)
    return [w for s in _SENTENCE.split(text) if s and (w := s.split())]


def features(coded: list[str], span: int, decay: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, triple, weight): all subsequences of three symbols inside ``span`` symbols, repeats apart."""
    at = offsets([len(w) for w in coded])
    chars = np.frombuffer("".join(coded).encode("ascii"), dtype=np.uint8).astype(np.int32)
    owner = np.repeat(np.arange(len(coded), dtype=np.int32), np.diff(at))
    left = np.repeat(at[1:], np.diff(at)) - np.arange(len(chars))  # symbols from here to the word's end
    out = []
    for far in range(2, span):
        start = np.flatnonzero(left > far)
        for near in range(1, far):
            code = (chars[start] * _SYMBOLS + chars[start + near]) * _SYMBOLS + chars[start + far]
            out.append((owner[start], code, np.full(len(start), decay ** (far - 2), dtype=np.float32)))
    if not out:
        return np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.float32)
    return tuple(np.concatenate(x) for x in zip(*out))


def unit_features(words: list[str], span: int, decay: float) -> np.ndarray:
    """Dense (words, triples) rows of length 1; for small lists."""
    word, code, weight = features([symbols(w) for w in words], span, decay)
    dense = np.zeros((len(words), _SYMBOLS**3), dtype=np.float32)
    np.add.at(dense, (word, code), weight)
    return dense / np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-9)


class Landmarks:
    """Kernel values of many words with a fixed list of words."""

    def __init__(self, words: list[str], opts: KernelOptions):
        self.words, self.opts = words, opts
        dense = unit_features(words, opts.span, opts.decay)
        used = np.flatnonzero(dense.any(axis=0))
        self.slot = np.full(_SYMBOLS**3, -1, dtype=np.int32)
        self.slot[used] = np.arange(len(used))
        self.weight = np.ascontiguousarray(dense[:, used].T)
        self.most = self.weight.max(axis=1) if len(words) else np.zeros(0, np.float32)
        # Landmarks that are neighbours in the alphabet share triples, so their largest weights bound them well.
        groups = np.array_split(np.argsort(np.array(words)), -(-len(words) // 8)) if words else []
        self.bound = np.stack([self.weight[:, g].max(axis=1) for g in groups], axis=1) if groups else self.weight
        self.gram = dense @ dense.T
        values, vectors = np.linalg.eigh(self.gram.astype(np.float64) + 1e-3 * np.eye(len(words)))
        self.root = (vectors / np.sqrt(values)) @ vectors.T

    def kernel(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words (by place) that reach the floor with a landmark, and their kernel rows."""
        return self.coded_kernel([symbols(w) for w in words])

    def coded_kernel(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words given as symbols (by place) that reach the floor with a landmark, and their kernel rows.

        Bounds prune before exact values: each triple at its largest weight in any landmark, then
        in each group of eight landmarks.
        """
        o = self.opts
        word, code, weight = features(words, o.span, o.decay)
        slot = self.slot[code]
        hit = slot >= 0
        # Repeated triples only add to the norm, so the root of the single squares is a lower bound of it.
        low = np.sqrt(np.bincount(word, weights=weight * weight, minlength=len(words)))
        most = np.bincount(word[hit], weights=weight[hit] * self.most[slot[hit]], minlength=len(words))
        maybe = np.flatnonzero(most >= o.floor * np.maximum(low, 1e-9) - 1e-6)
        maybe = maybe[low[maybe] > 0]
        place = np.full(len(words), -1, dtype=np.int64)
        place[maybe] = np.arange(len(maybe))
        own = place[word] >= 0
        word, code, weight = place[word[own]], code[own].astype(np.int64), weight[own]
        # The triples come in one sorted run per gap, which a stable sort merges.
        order = np.argsort(word, kind="stable")
        word, code, weight = word[order], code[order], weight[order]
        keep, rows = [], []
        for start in range(0, len(maybe), 4096):
            part = maybe[start : start + 4096]
            lo, hi = np.searchsorted(word, (start, start + len(part)))
            key = (word[lo:hi] - start) * _SYMBOLS**3 + code[lo:hi]
            uniq, inverse = np.unique(key, return_inverse=True)
            total = np.bincount(inverse, weights=weight[lo:hi], minlength=len(uniq))
            who, what = uniq // _SYMBOLS**3, self.slot[uniq % _SYMBOLS**3]
            norm = np.sqrt(np.bincount(who, weights=total * total, minlength=len(part)))
            known = what >= 0
            sparse = np.zeros((len(part), len(self.weight)), dtype=np.float32)
            sparse[who[known], what[known]] = total[known]
            sparse /= np.maximum(norm, 1e-9)[:, None]
            close = (sparse @ self.bound).max(axis=1) >= o.floor - 1e-5
            part, dense = part[close], sparse[close] @ self.weight
            dense[dense < o.floor] = 0
            strong = dense.any(axis=1)
            keep.append(part[strong])
            rows.append(dense[strong])
        if not keep:
            return np.empty(0, np.int64), np.empty((0, len(self.words)), np.float32)
        return np.concatenate(keep), np.concatenate(rows)

    def sentence_rows(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text, feature row) of the sentences that hold a landmark-like word; the others are all 0."""
        split = [sentences(t.lower()) for t in batch]
        # Words that differ in case, signs or look-alike letters only are one list of symbols.
        coded = {w: symbols(w) for w in {w for text in split for s in text for w in s}}
        distinct = list(set(coded.values()))
        found, kernels = self.coded_kernel(distinct)
        place = {distinct[k]: i for i, k in enumerate(found)}
        near = {w: place[c] for w, c in coded.items() if c in place}
        owner, rows = [], []
        for i, text in enumerate(split):
            for s in text:
                if hits := [near[w] for w in s if w in near]:
                    owner.append(i)
                    rows.append(kernels[hits].max(axis=0))
        width = len(self.words)
        return np.array(owner, dtype=np.int64), np.array(rows, dtype=np.float32).reshape(-1, width)


@dataclass
class SubsequenceSvm:
    """Landmarks, weights on the Nystroem map, bias, and the logistic curve of the margins.

    Without landmarks the bias is every text's score.
    """

    landmarks: Landmarks | None
    weights: np.ndarray
    bias: float
    curve: tuple[float, float]

    def margins(self, batch: list[str]) -> np.ndarray:
        out = np.full(len(batch), self.bias)
        if self.landmarks is not None:
            owner, rows = self.landmarks.sentence_rows(batch)
            np.maximum.at(out, owner, rows @ self.weights + self.bias)
        return out

    def scores(self, batch: list[str]) -> np.ndarray:
        if self.landmarks is None:
            return np.full(len(batch), self.bias)
        slope, shift = self.curve
        return 1 / (1 + np.exp(-np.clip(slope * self.margins(batch) + shift, -30, 30)))


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float, steps: int = 25) -> np.ndarray:
    """Weights (last: bias) of the squared hinge loss, classes balanced, by Newton steps on the active rows.

    With the rows inside the margin fixed the loss is quadratic, so each step solves one small system;
    a step that does not lower the loss is halved.
    """
    x = np.hstack([x, np.ones((len(x), 1))])
    sign = np.where(y > 0, 1.0, -1.0)
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y <= 0).sum(), 1)) * cost * 200
    ridge = np.append(np.ones(x.shape[1] - 1), 1e-6)

    def loss(w: np.ndarray) -> float:
        return float(ridge @ (w * w) + share @ np.maximum(0, 1 - sign * (x @ w)) ** 2)

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(steps):
        near = sign * (x @ w) < 1
        part, weight = x[near], share[near]
        goal = np.linalg.solve((part * weight[:, None]).T @ part + np.diag(ridge), part.T @ (weight * sign[near]))
        step = 1.0
        while step > 1e-3 and loss(w + step * (goal - w)) > now:
            step /= 2
        new = w + step * (goal - w)
        if now - loss(new) <= 1e-7 * now:
            break
        w, now = new, loss(new)
    return w


def logistic_curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of P(y = 1 | margin), by damped Newton steps with a small ridge."""
    x = np.column_stack([margin, np.ones(len(margin))])
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + 1e-2 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        w = w - 0.7 * np.linalg.solve(hess, grad)
    return max(float(w[0]), 0.1), float(w[1])


def _distinct(sample: DataFrame) -> DataFrame:
    return sample.select("text", "y").distinct()


def landmark_words(sample: DataFrame, opts: KernelOptions) -> list[str]:
    """The words that stand in toxic texts far more often than in clean ones, strongest evidence first.

    Distinct texts are counted, so a copied text does not push its words up.
    """
    sample = _distinct(sample)

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames):
            for text, y in zip(frame.text, frame.y):
                found = {w.strip(".,;:!?") for s in sentences((text or "").lower()) for w in s}
                found = [w for w in found if 3 <= len(symbols(w)) <= 40]
                yield pd.DataFrame({"word": pd.Series(found, dtype=object), "y": y})

    counts = sample.mapInPandas(split, "word string, y int").groupBy("word").agg(
        F.sum("y").alias("toxic"), F.count(F.lit(1)).alias("n")
    )
    n, n_toxic = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    n_clean = n - n_toxic
    if not n_toxic or not n_clean:
        return []
    toxic, clean = F.col("toxic"), F.col("n") - F.col("toxic")

    def part(seen, share):
        return F.when(seen > 0, 2 * seen * F.log(seen / (F.col("n") * F.lit(share)))).otherwise(0.0)

    counts = counts.withColumn("evidence", part(toxic, n_toxic / n) + part(clean, n_clean / n))
    often = (toxic * F.lit(float(n_clean)) > 3 * clean * F.lit(float(n_toxic))) & (F.col("evidence") >= opts.evidence)
    best = counts.where(often).orderBy(F.desc("evidence"), "word").limit(opts.landmarks)
    return [r.word for r in best.collect()]


def fit(docs: DataFrame, labels: DataFrame, opts: KernelOptions = KernelOptions()) -> SubsequenceSvm:
    sample = written(labelled_sample(docs, labels, "toxic", opts.max_labelled), "toxic-sample")
    words = landmark_words(sample, opts)
    if not words:
        n, n_toxic = _distinct(sample).agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
        return SubsequenceSvm(None, np.zeros(0), n_toxic / n if 0 < n_toxic < n else 0.0, (1.0, 0.0))
    held = docs.sparkSession.sparkContext.broadcast(Landmarks(words, opts))

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames):
            owner, found = held.value.sentence_rows([t if isinstance(t, str) else "" for t in frame.text])
            # The strongest sentences stand for a document of the sample; one of zeros stands for the rest.
            order = np.lexsort((-found.sum(axis=1), owner))
            first = np.searchsorted(owner[order], owner[order])
            order = order[np.arange(len(order)) - first < opts.sentences]
            owner, found = owner[order], found[order]
            own = np.concatenate([np.arange(len(frame)), owner])
            data = [b""] * len(frame) + [r.tobytes() for r in found]
            yield pd.DataFrame(
                {
                    "doc_id": frame.doc_id.to_numpy()[own], "y": frame.y.to_numpy()[own], "row": data,
                    "mark": frame["mark"].to_numpy()[own],
                }
            )

    marked = sample.withColumn("mark", F.xxhash64("text"))
    got = marked.mapInPandas(rows, "doc_id long, y int, row binary, mark long").orderBy("doc_id", "y", "row").collect()
    # The first of the copies of a text stands for all.
    first_of: dict[tuple[int, int], int] = {}
    got = [r for r in got if first_of.setdefault((r.mark, r.y), r.doc_id) == r.doc_id]
    width = len(words)
    x = np.array([np.frombuffer(r.row, dtype=np.float32) if r.row else np.zeros(width, np.float32) for r in got])
    doc = np.unique([r.doc_id for r in got], return_inverse=True)[1]
    y = np.array([r.y for r in got])
    if len(set(y.tolist())) < 2:
        return SubsequenceSvm(None, np.zeros(0), 0.0, (1.0, 0.0))
    root = held.value.root
    mapped = x.astype(np.float64) @ root
    margin = x.sum(axis=1).astype(np.float64).round(4)  # rounding noise does not choose among equal sentences
    for _ in range(opts.rounds):
        order = np.lexsort((-margin, doc))
        top = order[np.flatnonzero(np.diff(doc[order], prepend=-1))]  # the most toxic sentence of each document
        chosen = np.unique(np.concatenate([top[y[top] > 0], np.flatnonzero(y <= 0)]))
        w = linear_svm(mapped[chosen], y[chosen], opts.cost)
        margin = mapped @ w[:-1] + w[-1]
    order = np.lexsort((-margin, doc))
    top = order[np.flatnonzero(np.diff(doc[order], prepend=-1))]
    return SubsequenceSvm(held.value, root @ w[:-1], float(w[-1]), logistic_curve(margin[top], y[top].astype(float)))


def scored(docs: DataFrame, labels: DataFrame, opts: KernelOptions = KernelOptions()) -> DataFrame:
    """All columns of ``docs`` and ``toxic_score`` in one narrow pass."""
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, opts))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            frame = pd.DataFrame({"text": batch})
            parts = [held.value.scores([t if isinstance(t, str) else "" for t in p.text]) for p in slices([frame])]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return docs.withColumn("toxic_score", score.asNondeterministic()(F.col("text")))
