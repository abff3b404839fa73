"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is a row of characters with the piece mark for every space and one mark in front. Encoding
merges the two neighbours whose joint piece has the best score (lowest rank), the leftmost among equals, until
no neighbours make a piece. Merges never cross a place where no piece holds the two characters side by
side, so a text falls into words that can be encoded on their own, and equal words once.

The distinct words of a batch stand in flat arrays of symbols. In every round each word finds the lowest rank
among its pairs (one segmented minimum); all words merge at once; merged places are dropped and words
without a pair leave. A word merges all its places of the lowest rank together, counted from the left
where they overlap, if no merge makes a pair of the same or a lower rank; else it merges the leftmost
only. Both give what one merge at a time gives.

Characters without a piece become one byte piece per UTF-8 byte. Null and empty texts have no ids, and
no ids decode to the empty text. Every row stands for itself; other columns pass through where the
names allow (``encode`` adds ``ids``, ``decode`` adds ``decoded``; columns of these names are replaced).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tabwright.llm.common import offsets

MARK = "▁"
NONE = np.iinfo(np.int32).max
CODES = 0x110000
#: Words that a Python worker remembers, by their characters in all; bounds its memory, not the result.
HELD_CHARS = 8 << 20
#: Characters that are encoded in one set of arrays; a longer word stands alone.
ROUND_CHARS = 1 << 20
SLICE_CHARS = 1 << 20
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Pieces:
    """Vocabulary as arrays: symbols are piece ids, or ``size`` + code point for characters without a piece."""

    def __init__(self, model_proto: bytes):
        model = sentencepiece.SentencePieceProcessor(model_proto=model_proto)
        self.size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(self.size)]
        special = np.array([model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(self.size)])
        byte = np.array([model.is_byte(i) for i in range(self.size)])
        plain = {names[i]: i for i in np.flatnonzero(~special & ~byte)}
        scores = np.array([model.get_score(i) for i in range(self.size)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.char_id = np.arange(self.size, self.size + CODES, dtype=np.int32)
        for c, i in plain.items():
            if len(c) == 1:
                self.char_id[ord(c)] = i
        # Pairs are also looked up where a half is a character without a piece of its own.
        halves = plain | {c: self.size + ord(c) for c in set("".join(plain)) - plain.keys()}
        made = [
            (halves[p[:k]], halves[p[k:]], i) for p, i in plain.items() for k in range(1, len(p)) if p[:k] in halves and p[k:] in halves
        ]
        left, right, joint = np.array(made or np.empty((0, 3)), dtype=np.int64).T
        keys = left * (self.size + CODES) + right
        order = np.argsort(keys)
        self.pair_keys, self.pair_ids = keys[order], joint[order].astype(np.int32)
        near = np.array(sorted({ord(p[i]) * CODES + ord(p[i + 1]) for p in plain for i in range(len(p) - 1)}), dtype=np.int64)
        self.near = near
        self.byte_ids = np.zeros(256, dtype=np.int32)
        for i in np.flatnonzero(byte):
            self.byte_ids[int(names[i][3:5], 16)] = i
        bodies = [b"" if special[i] else bytes([int(names[i][3:5], 16)]) if byte[i] else names[i].replace(MARK, " ").encode() for i in range(self.size)]
        for i in range(self.size):
            if model.is_unknown(i):
                bodies[i] = " ⁇ ".encode()
        self.body_at = offsets([len(b) for b in bodies])
        self.bodies = np.frombuffer(b"".join(bodies), dtype=np.uint8)
        self.is_byte, self.is_special = byte, special
        self._forget()
        # Marks rank below all else and equal among themselves, so their runs merge from the left into pieces of
        # the longest length, whatever follows; a vocabulary where this does not hold is encoded without the cut.
        runs = {len(p): i for p, i in plain.items() if set(p) == {MARK}}
        size = max(runs, default=0)
        self.mark_run = 0
        if size > 1 and all(self.rank[i] == self.rank.max() for i in runs.values()):
            if self.merged([MARK * (2 * size)])[1].tolist() == [runs[size]] * 2:
                self.mark_run = size

    def _forget(self) -> None:
        self.held: dict[str, int] = {}
        self.held_chars, self.held_at, self.held_ids = 0, np.zeros(1, dtype=np.int64), np.empty(0, dtype=np.int32)

    def joint(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece made by two neighbouring symbols, -1 if none."""
        keys = left.astype(np.int64) * (self.size + CODES) + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), max(len(self.pair_keys) - 1, 0))
        if not len(self.pair_keys):
            return np.full(len(keys), -1, dtype=np.int32)
        return np.where(self.pair_keys[at] == keys, self.pair_ids[at], np.int32(-1))

    def ranks(self, joint: np.ndarray) -> np.ndarray:
        return np.where(joint >= 0, self.rank[joint], NONE)

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids per word, and the ids of all words one after another; words are not empty."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        starts = offsets([len(w) for w in words])
        both = codes[:-1] * CODES + codes[1:]
        found = np.searchsorted(self.near, both)
        cut = np.concatenate(([True], self.near[np.minimum(found, len(self.near) - 1)] != both if len(self.near) else both >= 0))
        cut[starts[:-1]] = True
        sym = self.char_id[codes]
        # Segments of one symbol are done.
        seg = np.flatnonzero(cut)
        sizes = np.diff(np.append(seg, len(codes)))
        pos = np.flatnonzero(np.repeat(sizes > 1, sizes))
        final, alive = sym.copy(), np.ones(len(sym), dtype=bool)
        self._rounds(sym[pos], np.repeat(np.arange((sizes > 1).sum()), sizes[sizes > 1]), pos, final, alive)
        sizes, symbols = np.add.reduceat(alive, starts[:-1], dtype=np.int64), final[alive]
        odd = np.flatnonzero(symbols >= self.size)
        if not len(odd):
            return sizes, symbols
        # Characters without a piece become their bytes.
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in (symbols[odd] - self.size).tolist()]
        n_bytes = np.ones(len(symbols), dtype=np.int64)
        n_bytes[odd] = [len(r) for r in raw]
        ids = np.repeat(symbols, n_bytes)
        ids[ids >= self.size] = self.byte_ids[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        return np.add.reduceat(n_bytes, offsets(sizes)[:-1]), ids

    def _rounds(self, sym: np.ndarray, word: np.ndarray, pos: np.ndarray, final: np.ndarray, alive: np.ndarray) -> None:
        """Merge until no pair remains; ``final`` at ``pos`` gets the symbols, ``alive`` loses the merged places."""

        def pairs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Joint piece and rank of the pairs that begin at ``at``; none at a word's end."""
            out = np.full(len(at), -1, dtype=np.int32)
            ok = at < len(sym) - 1
            ok[ok] = word[at[ok]] == word[at[ok] + 1]
            out[ok] = self.joint(sym[at[ok]], sym[at[ok] + 1])
            return out, self.ranks(out)

        made, rank = pairs(np.arange(len(sym)))
        while len(sym):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            sizes = np.diff(np.append(first, len(sym)))
            least = np.minimum.reduceat(rank, first)
            busy = least < NONE
            if not busy.all():
                keep = np.repeat(busy, sizes)
                final[pos[~keep]] = sym[~keep]
                sym, word, pos, made, rank = sym[keep], word[keep], pos[keep], made[keep], rank[keep]
                least, sizes = least[busy], sizes[busy]
                if not len(sym):
                    return
                first = offsets(sizes)[:-1]
            at = np.flatnonzero(rank == np.repeat(least, sizes))
            # Overlapping places (a a a): every second one of a run, from its left.
            run = np.concatenate(([True], np.diff(at) > 1))
            lead = at[np.flatnonzero(run)][np.cumsum(run) - 1]
            at = at[(at - lead) % 2 == 0]
            owner = np.searchsorted(first, at, side="right") - 1
            several = np.bincount(owner, minlength=len(first)) > 1
            shared = several[owner]
            if shared.any():
                check = at[shared]
                piece, bound = made[check], least[owner[shared]]
                bad = np.zeros(len(check), dtype=bool)
                behind = check + 2
                ok = behind < len(sym)
                ok[ok] = word[behind[ok]] == word[check[ok]]
                bad[ok] |= self.ranks(self.joint(piece[ok], sym[behind[ok]])) <= bound[ok]
                before = check - 1
                ok = (before >= 0) & (word[before] == word[check])
                bad[ok] |= self.ranks(self.joint(sym[before[ok]], piece[ok])) <= bound[ok]
                # The merge just before has already made its piece when this one comes.
                ok = np.concatenate(([False], np.diff(check) == 2))
                ok[ok] = word[check[np.flatnonzero(ok) - 1]] == word[check[ok]]
                prior = np.flatnonzero(ok) - 1
                bad[ok] |= self.ranks(self.joint(piece[prior], piece[ok])) <= bound[ok]
                bad[ok] |= self.ranks(self.joint(piece[prior], sym[check[ok]])) <= bound[ok]
                lone = np.zeros(len(first), dtype=bool)
                lone[owner[shared][bad]] = True
                leftmost = np.concatenate(([True], np.diff(owner) > 0))
                at = at[leftmost | ~lone[owner]]
            sym[at] = made[at]
            gone = at + 1
            alive[pos[gone]] = False
            keep = np.ones(len(sym), dtype=bool)
            keep[gone] = False
            place = np.cumsum(keep) - 1
            now = place[at]
            sym, word, pos, made, rank = sym[keep], word[keep], pos[keep], made[keep], rank[keep]
            touched = np.zeros(len(sym), dtype=bool)
            touched[now] = touched[np.maximum(now - 1, 0)] = True
            stale = np.flatnonzero(touched)
            made[stale], rank[stale] = pairs(stale)

    def words(self, text: str) -> list[str]:
        """Words of a text in order: marks and what follows; long runs of marks are cut where merges cut them."""
        if not text:
            return []
        marked, size = MARK + text.replace(" ", MARK), self.mark_run
        found = _WORD.findall(marked)
        if not size or MARK * (2 * size) not in marked:
            return found
        out = []
        for w in found:
            # The last marks stay with the word, whose first piece may take one of them.
            if w.startswith(MARK * (2 * size)):
                n = (len(w) - len(w.lstrip(MARK))) // size - 1
                out += [MARK * size] * n
                w = w[n * size :]
            out.append(w)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of all texts."""
        lists = [self.words(t) for t in texts]
        flat = list(chain.from_iterable(lists))
        fresh = {w for w in flat if w not in self.held}
        if self.held_chars + sum(map(len, fresh)) > HELD_CHARS:
            self._forget()
            fresh = set(flat)
        self._learn(list(fresh))
        codes = np.fromiter(map(self.held.__getitem__, flat), dtype=np.int64, count=len(flat))
        sizes = self.held_at[codes + 1] - self.held_at[codes]
        ends = offsets(sizes)
        ids = self.held_ids[np.arange(ends[-1]) - np.repeat(ends[:-1] - self.held_at[codes], sizes)]
        return ends[offsets([len(words) for words in lists])], ids

    def _learn(self, fresh: list[str]) -> None:
        if not fresh:
            return
        lengths = np.array([len(w) for w in fresh])
        sizes, ids = zip(*[self.merged(fresh[start:end]) for start, end in _spans(lengths, ROUND_CHARS)])
        self.held.update(zip(fresh, range(len(self.held), len(self.held) + len(fresh))))
        self.held_chars += int(lengths.sum())
        self.held_at = np.append(self.held_at, self.held_at[-1] + np.cumsum(np.concatenate(sizes)))
        self.held_ids = np.concatenate([self.held_ids, *ids])

    def decode(self, at: np.ndarray, ids: np.ndarray) -> list[str]:
        """Texts of lists of ids given by offsets; a leading mark is dropped, broken UTF-8 of byte pieces becomes U+FFFD."""
        sizes = self.body_at[ids + 1] - self.body_at[ids]
        ends = offsets(sizes)
        raw = self.bodies[np.arange(ends[-1]) - np.repeat(ends[:-1], sizes) + np.repeat(self.body_at[ids], sizes)].tobytes()
        odd = np.concatenate(([0], np.cumsum(self.is_special[ids])))
        out = []
        for start, end in zip(at[:-1].tolist(), at[1:].tolist()):
            try:
                text = raw[ends[start] : ends[end]].decode()
            except UnicodeDecodeError:
                text = self._broken(ids[start:end])
            else:
                if odd[end] > odd[start]:  # a special piece ends a run of bytes, whole or not
                    text = self._broken(ids[start:end])
            # Special pieces have no body; the mark goes from the first piece that is none.
            lead = start
            while lead < end and self.is_special[ids[lead]] and sizes[lead] == 0:
                lead += 1
            marked = lead < end and not self.is_special[ids[lead]] and not self.is_byte[ids[lead]] and text[:1] == " "
            out.append(text[1:] if marked else text)
        return out

    def _broken(self, ids: np.ndarray) -> str:
        """Text of ids whose byte pieces are not all UTF-8: runs of byte pieces are read on their own."""
        out, run = [], bytearray()
        for i in [*ids.tolist(), None]:
            if i is not None and self.is_byte[i]:
                run += self.bodies[self.body_at[i] : self.body_at[i + 1]].tobytes()
                continue
            while run:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[:n]).decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    n = 1
                    out.append("�")
                del run[:n]
            if i is not None:
                out.append(self.bodies[self.body_at[i] : self.body_at[i + 1]].tobytes().decode())
        return "".join(out)


@lru_cache(maxsize=2)
def pieces(model_proto: bytes) -> Pieces:
    """The vocabulary of a worker, with the words it has met."""
    return Pieces(model_proto)


def _spans(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    slot = (np.cumsum(lengths) - lengths) // most
    cuts = np.flatnonzero(np.diff(slot)) + 1
    yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(lengths)])


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``docs`` with ``ids``, the piece ids of ``text``; one narrow pass. The vocabulary file is sent to the tasks."""
    held = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    names = [c for c in docs.columns if c != "ids"]
    shape = T.StructType([*docs.select(*names).schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(held.value)
        for batch in batches:
            text = batch.column("text")
            sizes = np.array([len(t) if t else 0 for t in text.to_pylist()], dtype=np.int64)
            for start, end in _spans(sizes, SLICE_CHARS) if len(sizes) else ():
                part = batch.slice(start, end - start)
                at, ids = model.encode([t or "" for t in part.column("text").to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(at, type=pa.int32()), pa.array(ids, type=pa.int32()))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], lists], names=[*names, "ids"])

    return docs.select(*names).mapInArrow(run, shape)


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text of ``ids``; null ids decode to the empty text."""
    held = encoded.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    names = [c for c in encoded.columns if c != "decoded"]
    shape = T.StructType([*encoded.select(*names).schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(held.value)
        for batch in batches:
            lists = batch.column("ids").fill_null([]) if batch.column("ids").null_count else batch.column("ids")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            for start, end in _spans(sizes, SLICE_CHARS) if len(sizes) else ():
                ids = lists.slice(start, end - start).flatten().to_numpy(zero_copy_only=False)
                texts = model.decode(offsets(sizes[start:end]), ids)
                part = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(texts, type=pa.string())], names=[*names, "decoded"])

    return encoded.select(*names).mapInArrow(run, shape)
