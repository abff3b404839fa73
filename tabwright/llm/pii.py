r"""Personal data by fixed patterns and a skip-chain conditional random field.

Base spans come from four patterns (email, ip, card, phone), leftmost and non-overlapping per kind;
matches that fail their check are dropped without a second try. They always stay.

The field adds spans. Nodes are the tokens (runs without white space) with a digit or an at sign; all
other tokens are none of the kinds and act as a fixed border. Chain factors tie neighbouring
nodes, skip factors tie each node with the next distant one that is the same or similar - equal without
case and surrounding marks, or with the same last seven digits - so a number or address that is
clear in one place is found in its other places as well. A pair of neighbouring tokens has a chain factor only.
The labels of base spans are observed. Tokens that share seven digits or a whole address with an observed
one are tied to it by a factor of fixed strength; chance makes such a pair once in ten million. Loopy sum-product belief propagation runs over all
nodes of a batch at once, a fixed number of rounds, in time linear in the nodes. A token becomes a
span if a kind's belief reaches ``least_belief``, no base span covers it, and it passes its kind's check;
digits and dots alone are a phone only when so tied to an observed one.

Training is by pseudo-likelihood on at most ``max_documents`` documents that have nodes, chosen by a
hash of id and text, with the base spans as labels; a token tied to one of them teaches nothing. Training
and scoring read every text whole; of the sample, the nodes come to the driver and not the texts.

Defined results: null and empty texts have no span. Repeated rows are judged each. Offsets are code
points, ends exclusive. Other columns pass through untouched. Without any node in the table the
field has no weights and adds nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import slices, texts

#: The kinds in their order, and the patterns of the contract.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"\S+")
#: Labels of the field: 0 is none, then the kinds.
_N = 1 + len(KINDS)
_BUCKETS = 4096
#: Log of the odds against chance that seven digits are the same.
_SURE = float(np.log(1e7))


@dataclass(frozen=True)
class FieldOptions:
    max_documents: int = 1500
    rounds: int = 8
    least_belief: float = 0.9
    steps: int = 200
    ridge: float = 1e-3


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def valid(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
    if kind == "card":
        d = _digits(found)
        return 16 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 8 <= len(_digits(found)) <= 15
    return True


def _emails(text: str) -> list[tuple[int, int]]:
    """Email matches, found from their at signs: linear also in texts with long runs and no address."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            free = domain.end()
        free = max(free, at + 1)
        at = text.find("@", free)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [("email", s, e) for s, e in _emails(text)]
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        out += [(kind, *m.span()) for m in pattern.finditer(text) if valid(kind, m[0])]
    return out


def _shape(token: str) -> str:
    """Letters as a, digits as 9, runs as one, other characters as they are; 24 characters at most."""
    out = []
    for c in token:
        c = "9" if "0" <= c <= "9" else "a" if c.isalpha() else c
        if not out or out[-1] != c:
            out.append(c)
            if len(out) == 24:
                break
    return "".join(out)


def _bucket(feature: str) -> int:
    return int.from_bytes(hashlib.blake2b(feature.encode("utf-8", "surrogatepass"), digest_size=4).digest(), "big") % _BUCKETS


@dataclass
class Nodes:
    """The nodes of one text: token spans, hashed features, chain and skip neighbours, observed labels.

    ``tied``: per node the label of the observed nodes that it shares seven digits or an address with, or 0.
    """

    spans: list[tuple[int, int]]
    features: list[list[int]]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]
    labels: list[int]
    tied: list[int] = field(default_factory=list)


def nodes_of(text: str, spans: list[tuple[str, int, int]]) -> Nodes:
    out = Nodes([], [], [], [], [])
    if not _HINT.search(text):
        return out
    tokens = [m.span() for m in _TOKEN.finditer(text)]
    held = [bool(_HINT.search(text, s, e)) for s, e in tokens]
    last_by_key: dict[str, int] = {}
    name: list[str] = []
    node_at: dict[int, int] = {}
    cover = sorted((s, e, 1 + KINDS.index(k)) for k, s, e in spans)
    c = 0
    for t, (start, end) in enumerate(tokens):
        if not held[t]:
            continue
        while c < len(cover) and cover[c][1] <= start:
            c += 1
        label = cover[c][2] if c < len(cover) and cover[c][0] < end else 0
        token = text[start:end]
        core = token.strip(".,;:!?()[]{}<>\"'").lower()
        digits = _digits(core)
        around = [_shape(text[s:e]) if held[u] else "w" for u in (t - 1, t + 1) if 0 <= u < len(tokens) for s, e in [tokens[u]]]
        names = [
            f"s:{_shape(token)}", f"c:{_shape(core)}", f"n:{min(len(digits), 20)}", f"p:{around[0] if t else ''}",
            f"f:{around[-1] if t + 1 < len(tokens) else ''}", f"at:{'@' in core}", f"dot:{core.count('.')}", "bias",
            f"card:{len(digits) >= 16 and luhn(digits)}", f"ip:{core.count('.') == 3 and core.replace('.', '').isdigit()}",
        ]
        node = len(out.spans)
        out.spans.append((start, end))
        out.features.append([_bucket(n) for n in names])
        out.labels.append(label)
        node_at[t] = node
        if t - 1 in node_at:
            out.chain.append((node_at[t - 1], node))
        name.append(core if "@" in core else digits[-7:] if len(digits) >= 7 else "")
        for key in {f"t:{core}", f"d:{digits[-7:]}" if len(digits) >= 7 else f"t:{core}"}:
            other = last_by_key.get(key)
            if core and other is not None and node_at.get(t - 1) != other:
                out.skip.append((other, node))
            last_by_key[key] = node
    seen: dict[str, set[int]] = {}
    for n, label in zip(name, out.labels):
        if n and label:
            seen.setdefault(n, set()).add(label)
    out.tied = [min(seen[n]) if len(seen.get(n, ())) == 1 else 0 for n in name]
    return out


@dataclass
class SkipChainField:
    """Unary weights per hashed feature and label, one table for chain and one for skip factors."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    @classmethod
    def train(cls, found: list[Nodes], opts: FieldOptions) -> SkipChainField:
        feats, labels, chain, skip, tied = _joined(found)
        f = cls(np.zeros((_BUCKETS, _N)), np.zeros((_N, _N)), np.zeros((_N, _N)))
        if not len(labels):
            return f
        memory = [np.full_like(x, 1e-8) for x in (f.unary, f.chain, f.skip)]
        target = np.eye(_N)[labels]
        known = (labels > 0) | (tied == 0)
        for _ in range(opts.steps):
            score = f.unary[feats].sum(axis=1)
            for table, edges in ((f.chain, chain), (f.skip, skip)):
                if len(edges):
                    np.add.at(score, edges[:, 1], table[labels[edges[:, 0]]])
                    np.add.at(score, edges[:, 0], table.T[labels[edges[:, 1]]])
            error = (_softmax(score) - target) * known[:, None] / len(labels)
            grads = [np.zeros_like(f.unary), np.zeros_like(f.chain), np.zeros_like(f.skip)]
            for column in feats.T:
                np.add.at(grads[0], column, error)
            for g, edges in ((grads[1], chain), (grads[2], skip)):
                if len(edges):
                    np.add.at(g, labels[edges[:, 0]], error[edges[:, 1]])
                    np.add.at(g.T, labels[edges[:, 1]], error[edges[:, 0]])
            for table, g, seen in zip((f.unary, f.chain, f.skip), grads, memory):
                g += opts.ridge * table / max(len(labels), 1)
                seen += g * g
                table -= 0.3 * g / np.sqrt(seen)
        # A skip factor may only draw alike tokens together.
        f.skip = np.maximum((f.skip + f.skip.T) / 2, 0) * np.eye(_N) + np.eye(_N) * 1.0
        return f

    def beliefs(self, found: list[Nodes], rounds: int) -> np.ndarray:
        """(nodes, labels): loopy sum-product messages along both directions of every factor."""
        feats, labels, chain, skip, tied = _joined(found)
        if not len(labels):
            return np.zeros((0, _N))
        unary = self.unary[feats].sum(axis=1)
        observed = np.flatnonzero(labels)
        unary[observed, labels[observed]] += 2 * _SURE
        alike = (tied[skip[:, 0]] > 0) & (tied[skip[:, 0]] == tied[skip[:, 1]])
        skip_tables = self.skip + alike[:, None, None] * (_SURE * np.eye(_N))
        edges = np.concatenate([chain, skip]).reshape(-1, 2)
        tables = np.concatenate([np.repeat(self.chain[None], len(chain), 0), skip_tables])
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        target = np.concatenate([edges[:, 1], edges[:, 0]])
        tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        sent = np.zeros((len(source), _N))
        for _ in range(rounds if len(edges) else 0):
            total = unary.copy()
            np.add.at(total, target, sent)
            inner = (total[source] - sent[back])[:, :, None] + tables
            top = inner.max(axis=1, keepdims=True)
            new = np.log(np.exp(inner - top).sum(axis=1)) + top[:, 0]
            new -= new.max(axis=1, keepdims=True)
            sent = 0.5 * sent + 0.5 * new
        total = unary.copy()
        np.add.at(total, target, sent)
        return _softmax(total)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _joined(found: list[Nodes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    feats, labels, chain, skip, tied, base = [], [], [], [], [], 0
    for n in found:
        feats += n.features
        labels += n.labels
        tied += n.tied or [0] * len(n.labels)
        chain += [(a + base, b + base) for a, b in n.chain]
        skip += [(a + base, b + base) for a, b in n.skip]
        base += len(n.spans)
    as_edges = lambda e: np.array(e, dtype=np.int64).reshape(-1, 2)
    as_ints = lambda x: np.array(x, dtype=np.int64)
    return as_ints(feats), as_ints(labels), as_edges(chain), as_edges(skip), as_ints(tied)


def added_spans(text: str, nodes: Nodes, belief: np.ndarray, base: list[tuple[str, int, int]], least: float) -> list[tuple[str, int, int]]:
    """Spans of the field that no base span touches; neighbouring tokens of a kind become one."""
    out: list[list] = []
    taken = sorted((s, e) for _, s, e in base)
    starts = [s for s, _ in taken]
    for (start, end), p in zip(nodes.spans, belief):
        label = int(p.argmax())
        if not label or p[label] < least:
            continue
        while start < end and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        while end > start and not text[end - 1].isalnum():
            end -= 1
        k = np.searchsorted(starts, end)
        if start == end or any(s < end and e > start for s, e in taken[max(0, k - 4) : k]):
            continue
        kind = KINDS[label - 1]
        if out and out[-1][0] == kind and not text[out[-1][2] : start].strip(" ()"):
            out[-1][2] = end
        else:
            out.append([kind, start, end])
    checked = [(k, s, e) for k, s, e in out if valid(k, text[s:e])]
    # A dotted number that is no address, or a long one that is no card, is a phone only as the repeat of one.
    phone = 1 + KINDS.index("phone")
    repeats = [span for span, tied in zip(nodes.spans, nodes.tied) if tied == phone]
    at = [s for s, _ in repeats]

    def repeat(start: int, end: int) -> bool:
        # Digits and dots hold no blank, so the span lies in one token.
        k = int(np.searchsorted(at, start, side="right")) - 1
        return k >= 0 and repeats[k][1] >= end

    return [(k, s, e) for k, s, e in checked if k != "phone" or not re.fullmatch(r"[0-9.]+", text[s:e]) or repeat(s, e)]


def find(batch: list[str], field: SkipChainField, opts: FieldOptions) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text; all spans by kind, then start."""
    base = [base_spans(t) if _HINT.search(t) else [] for t in batch]
    found = [nodes_of(t, b) for t, b in zip(batch, base)]
    belief = field.beliefs(found, opts.rounds)
    out, at = [], 0
    for text, nodes, own in zip(batch, found, base):
        p = belief[at : at + len(nodes.spans)]
        at += len(nodes.spans)
        more = added_spans(text, nodes, p, own, opts.least_belief) if len(p) else []
        out.append((own, sorted(own + more, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _packed(nodes: Nodes) -> bytes:
    """Nodes as bytes, without their places in the text."""
    parts = [nodes.labels, nodes.tied, nodes.features, nodes.chain, nodes.skip]
    counts = np.array([len(nodes.labels), len(nodes.chain), len(nodes.skip)], dtype=np.int32)
    return counts.tobytes() + b"".join(np.array(p, dtype=np.int32).tobytes() for p in parts)


def _unpacked(data: bytes) -> Nodes:
    flat = np.frombuffer(data, dtype=np.int32)
    n, n_chain, n_skip = map(int, flat[:3])
    rest = len(flat) - 3 - 2 * n - 2 * n_chain - 2 * n_skip
    labels, tied, features, chain, skip = np.split(flat[3:], np.cumsum([n, n, rest, 2 * n_chain]))
    pairs = lambda x: [tuple(p) for p in x.reshape(-1, 2).tolist()]
    rows = features.reshape(n, -1).tolist() if n else []
    return Nodes([(0, 0)] * n, rows, pairs(chain), pairs(skip), labels.tolist(), tied.tolist())


def fit(docs: DataFrame, opts: FieldOptions = FieldOptions()) -> SkipChainField:
    """Train on a sample of bounded rows; the nodes of the whole texts come to the driver, not the texts."""

    def nodes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in slices(frames):
            found = [nodes_of(t, base_spans(t)) for t in texts(frame)]
            yield pd.DataFrame({"nodes": [_packed(n) for n in found]})

    some = docs.select("doc_id", "text").where(F.col("text").rlike("[0-9@]"))
    # Short keys choose the sample, so the texts of other documents are not moved.
    key = F.xxhash64(F.col("doc_id"), F.col("text"))
    ranks = some.select(key.alias("key")).orderBy("key").limit(opts.max_documents)
    top = ranks.agg(F.max("key")).first()[0]
    if top is None:
        return SkipChainField.train([], opts)
    sample = some.where(key <= top).limit(opts.max_documents * 2).mapInPandas(nodes, "nodes binary")
    got = sorted({bytes(r.nodes) for r in sample.collect()})
    return SkipChainField.train([_unpacked(n) for n in got], opts)


_FOUND = "struct<base:array<struct<kind:string,start:long,end:long>>,spans:array<struct<kind:string,start:long,end:long>>>"


def with_spans(docs: DataFrame, opts: FieldOptions = FieldOptions()) -> DataFrame:
    """All columns of ``docs`` and ``pii``: struct of the arrays ``base`` and ``spans``."""
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, opts))

    @F.pandas_udf(_FOUND)
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def rows(found):
            return [{"kind": k, "start": s, "end": e} for k, s, e in found]

        for batch in batches:
            got = []
            for part in slices([pd.DataFrame({"text": batch})]):
                got += find(texts(part), held.value, opts)
            yield pd.DataFrame({"base": [rows(b) for b, _ in got], "spans": [rows(s) for _, s in got]})

    return docs.withColumn("pii", spans.asNondeterministic()(F.col("text")))


def redact(docs: DataFrame, opts: FieldOptions = FieldOptions()) -> DataFrame:
    """``docs`` with every span replaced by its kind in square brackets and ``n_chars`` brought up to date."""
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, opts))

    @F.pandas_udf("string")
    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for part in slices([pd.DataFrame({"text": batch})]):
                found = find(texts(part), held.value, opts)
                out += [masked(t, s) if isinstance(t, str) else None for t, (_, s) in zip(part.text, found)]
            yield pd.Series(out, dtype=object)

    done = docs.withColumn("text", mask(F.col("text")))
    return done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start < at:  # inside or across a span of another kind: what is left of it is masked with it
            at = max(at, end)
            continue
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def digest(docs: DataFrame, opts: FieldOptions = FieldOptions()) -> DataFrame:
    """The contract's columns of op5."""

    def text_of(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    found = with_spans(docs.select("doc_id", "text"), opts)

    def count(kind: str):
        return F.size(F.filter("pii.base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(text_of(F.col("pii.base")), 256).alias("base_sha256"),
        text_of(F.col("pii.spans")).alias("spans"),
    )
