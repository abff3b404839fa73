r"""Token counts by trie-shared dynamic programming over a unigram model.

A pre-token is a word ``[^\x20\x09-\x0D]+`` with the piece mark in front. Its tokens are the pieces of
the segmentation with the best sum of unigram scores; on a tie the one with fewer tokens wins.
The best score of a prefix does not depend on what follows, so the distinct pre-tokens of a batch
are put in a trie and each node is scored once for all words below it; the node where a word
ends stores its count.

Piece scores are taken from the public vocabulary's order: piece number r has the probability
1 / (r + 2) over the sum of them all (Zipf's law), as the vocabulary holds ranks, not unigram
probabilities. Characters that no piece covers cost one token per UTF-8 byte, at ``byte_score`` each.

Null and empty texts have no token. Repeated rows are counted each; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import offsets, slices, texts

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
BYTE_SCORE = -20.0


@lru_cache(maxsize=2)
def unigram_scores(path: str) -> dict[str, float]:
    """Piece -> log probability by rank; control and byte pieces are left out."""
    model = sentencepiece.SentencePieceProcessor(model_proto=Path(path).read_bytes())
    ranks = [
        (r, model.id_to_piece(r)) for r in range(model.get_piece_size())
        if not (model.is_control(r) or model.is_unknown(r) or model.is_byte(r))
    ]
    total = math.log(sum(1 / (k + 2) for k in range(len(ranks))))
    return {piece: -math.log(k + 2) - total for k, (_, piece) in enumerate(ranks)}


class CountTrie:
    """Unigram tokens of many words; every shared prefix is scored once."""

    def __init__(self, scores: dict[str, float], byte_score: float = BYTE_SCORE):
        self.scores, self.byte_score = scores, byte_score
        self.longest = max(map(len, scores), default=1)
        self.nodes = 0

    def counts(self, pretokens: list[str]) -> dict[str, int]:
        """Token count per distinct pre-token.

        In sorted order the words below a trie node stand together, so the path to the present word
        is all of the trie that is needed: the scores of the prefix shared with the word before
        stay, the rest is popped. ``best[i]`` is (score, -tokens) of the first i characters.
        """
        best: list[tuple[float, int]] = [(0.0, 0)]
        get, longest, fallback = self.scores.get, self.longest, self.byte_score
        out, last = {}, ""
        for word in sorted(set(pretokens)):
            shared = 0
            for a, b in zip(word, last):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                n_bytes = len(word[end - 1].encode("utf-8", "surrogatepass"))
                score, less = best[end - 1]
                top = (score + fallback * n_bytes, less - n_bytes)
                for start in range(max(0, end - longest), end):
                    piece = get(word[start:end])
                    if piece is not None:
                        score, less = best[start]
                        score += piece
                        if score > top[0] or score == top[0] and less - 1 > top[1]:
                            top = (score, less - 1)
                best.append(top)
                self.nodes += 1
            out[word] = -best[-1][1]
            last = word
        return out


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_words, n_tokens) per row of ``docs`` (doc_id, text); one narrow pass, no shuffle."""
    scores = docs.sparkSession.sparkContext.broadcast(unigram_scores(vocabulary))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = CountTrie(scores.value)
        known: dict[bytes, int] = {}
        for frame in slices(frames):
            tokens = [t.encode("utf-8", "surrogatepass").split() for t in texts(frame)]
            fresh = {w for t in tokens for w in t if w not in known}
            if len(known) + len(fresh) > 1_000_000:  # bounds the memory of a task, not the result
                known, fresh = {}, {w for t in tokens for w in t}
            names = {MARK + w.decode("utf-8", "surrogatepass"): w for w in fresh}
            known |= {names[p]: n for p, n in trie.counts(list(names)).items()}
            flat = np.fromiter((known[w] for t in tokens for w in t), dtype=np.int64)
            at = offsets([len(t) for t in tokens])
            sums = np.concatenate(([0], np.cumsum(flat)))
            yield pd.DataFrame(
                {"doc_id": frame.doc_id.astype("Int64").array, "n_words": np.diff(at), "n_tokens": sums[at[1:]] - sums[at[:-1]]}
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        run, "doc_id long, n_words long, n_tokens long"
    )
