"""Batch inference of a sentence encoder over whole texts.

Tokens are cut by Spark; Python gets their arrays, turns them into ids, and lays all windows of a batch of documents out as
one padded matrix with a mask of real tokens. The encoder maps (ids, mask, weights) to a vector per window. A document's
vector is the mean of its windows' vectors, weighted by their real tokens, so no text is truncated. Weights are broadcast
once and stay in each Python worker.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.text import safe_text, word_runs

#: Tokens of a window; windows that are encoded at a time; weights that may be broadcast.
WINDOW = 128
WINDOWS_AT_ONCE = 256
MAX_WEIGHT_BYTES = 1 << 30
Encoder = Callable[[np.ndarray, np.ndarray, Mapping[str, np.ndarray]], np.ndarray]


def token_id(token: str, buckets: int, seed: int = 42) -> int:
    """A token's bucket, from 1: 0 is padding."""
    return 1 + int(hashlib.md5(f"{token}:{seed}".encode()).hexdigest()[:8], 16) % buckets


def mean_pooled(ids: np.ndarray, mask: np.ndarray, weights: Mapping[str, np.ndarray]) -> np.ndarray:
    """The plainest encoder: tanh of the masked mean of token vectors ``weights["tokens"]`` (row 0 is padding)."""
    vectors = weights["tokens"][ids] * mask[:, :, None]
    return np.tanh(vectors.sum(axis=1) / np.maximum(mask.sum(axis=1), 1e-9)[:, None])


def _lay_out(tokens: list[list[int]], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, mask, owner): the windows of all documents, padded with 0. A document without tokens has none."""
    parts = [(d, t[i:i + window]) for d, t in enumerate(tokens) for i in range(0, len(t), window)]
    ids, mask = np.zeros((len(parts), window), np.int64), np.zeros((len(parts), window))
    for row, (_, t) in enumerate(parts):
        ids[row, :len(t)], mask[row, :len(t)] = t, 1.0
    return ids, mask, np.array([d for d, _ in parts], np.int64)


def embed(df: DataFrame, id_col: str, text_col: str, encode: Encoder, weights: Mapping[str, np.ndarray], dim: int, buckets: int,
          window: int = WINDOW, out: str = "embedding") -> DataFrame:
    """(id, ``out`` array<double>) for every row; a text without tokens gets zeros. Rows are encoded in small groups, so
    a worker's memory does not grow with a batch's longest text but with ``WINDOWS_AT_ONCE``."""
    size = sum(w.nbytes for w in weights.values())
    if size > MAX_WEIGHT_BYTES:
        raise ValueError(f"weights of {size} bytes are not broadcast")
    held = df.sparkSession.sparkContext.broadcast({k: np.asarray(v) for k, v in weights.items()})
    kind = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for batch in batches:
            tokens = []
            for words in batch["_tokens"]:
                if len(known) > 200_000:
                    known.clear()
                tokens.append([known[w] if w in known else known.setdefault(w, token_id(w, buckets)) for w in words])
            total, count = np.zeros((len(batch), dim)), np.zeros(len(batch))
            for first in range(0, len(tokens), 64):
                ids, mask, owner = _lay_out(tokens[first:first + 64], window)
                for i in range(0, len(ids), WINDOWS_AT_ONCE):
                    part = slice(i, i + WINDOWS_AT_ONCE)
                    real = mask[part].sum(axis=1)
                    np.add.at(total, owner[part] + first, encode(ids[part], mask[part], held.value) * real[:, None])
                    np.add.at(count, owner[part] + first, real)
            yield pd.DataFrame({id_col: batch[id_col], out: list(total / np.maximum(count, 1.0)[:, None])})

    x = df.select(id_col, word_runs(safe_text(text_col)).alias("_tokens"))
    return x.mapInPandas(run, f"`{id_col}` {kind}, {out} array<double>")


def table_by_rule(buckets: int, dim: int) -> np.ndarray:
    """Fixed token vectors for checks: ((31 id + 17 j) mod 97) / 97 - 1/2 at id and element j; padding is 0."""
    ids, j = np.arange(buckets + 1)[:, None], np.arange(dim)[None, :]
    return np.where(ids == 0, 0.0, ((31 * ids + 17 * j) % 97) / 97 - 0.5)


def as_long(df: DataFrame, id_col: str, vector: str = "embedding") -> DataFrame:
    return df.select(id_col, F.posexplode(vector).alias("pos", "value"))
