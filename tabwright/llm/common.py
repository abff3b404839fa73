"""Words and small helpers the training-data operators share."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of one partition that Python tasks are planned for.
PART_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    r"""Words ``[^\x20\x09-\x0D]+`` with A-Z lower-cased; bytes.split cuts at just these characters."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def offsets(lengths) -> np.ndarray:
    """Start of every run, and the total: [2, 3] -> [0, 2, 5]."""
    return np.concatenate(([0], np.cumsum(np.asarray(lengths, dtype=np.int64))))


def texts(frame: pd.DataFrame, column: str = "text") -> list[str]:
    """Texts of a batch, nulls as empty."""
    return [t if isinstance(t, str) else "" for t in frame[column]]


def slices(frames: Iterator[pd.DataFrame], column: str = "text", chars: int = 8 << 20) -> Iterator[pd.DataFrame]:
    """Batches cut so that each holds about ``chars`` characters; a longer text stands alone."""
    for frame in frames:
        if not len(frame):
            continue
        sizes = frame[column].str.len().fillna(0).to_numpy(dtype=np.int64)
        slot = (np.cumsum(sizes) - sizes) // chars
        cuts = np.flatnonzero(np.diff(slot)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(frame)]):
            yield frame.iloc[start:end]


def fold(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def parts_for(n_bytes: int, least: int = 1, each: int = PART_BYTES) -> int:
    return max(least, math.ceil(n_bytes / each))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit (xor-shift and multiply, twice)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
