"""Byte-level BPE by monoid tree reduction.

A text is halved until its parts are short; the leaves are encoded by themselves, and neighbours
are joined up the tree. Joining is associative with the empty text as its unit. A join leaves the
tokens of both sides as they are, except in a window around the seam that is encoded anew.

Why tokens outside the window cannot change: the splitting pattern matches white space only at
the start of a match or alone, never after another character. So every place where white space
follows another character ends one match and starts the next, in the part as in the whole, and ids
depend on nothing but their own match. The window grows from the seam on both sides until it ends at
such a place (or at the side's end).

Decoding turns runs of ids into bytes and concatenates them up the same kind of tree.
"""

from __future__ import annotations

import base64
import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import map_batches
from foldwise.llm.tokens import SPACE

LEAF_CHARS = 4096
LEAF_IDS = 4096
_SEAM = re.compile(f"(?<=[^{SPACE}])(?=[{SPACE}])")


@dataclass(frozen=True)
class Vocabulary:
    """Ranks of a rank file, the splitting pattern, and each id's bytes."""

    encoding: object
    lengths: np.ndarray

    @staticmethod
    def load(path: str, pattern: str) -> Vocabulary:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        return Vocabulary(tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths)


@dataclass(frozen=True)
class Part:
    """text[start:end] and its ids, as if it were a text of its own."""

    start: int
    end: int
    ids: np.ndarray


def _ids(vocabulary: Vocabulary, text: str) -> np.ndarray:
    return np.array(vocabulary.encoding.encode_ordinary(text), dtype="<u4")


def _stable_before(text: str, start: int, seam: int) -> int:
    """The last match boundary before or at ``seam`` that is one in any text; ``start`` if none."""
    width = 32
    while True:
        low = max(start, seam - width)
        found = [m.start() for m in _SEAM.finditer(text, low, seam) if m.start() > start]
        if found:
            return found[-1]
        if low == start:
            return start
        width *= 4


def _stable_after(text: str, seam: int, end: int) -> int:
    """The first such boundary after ``seam``; ``end`` if there is none."""
    width = 32
    while True:
        high = min(end, seam + width)
        for m in _SEAM.finditer(text, seam, high):
            if m.start() > seam:
                return m.start()
        if high == end:
            return end
        width *= 4


def _count_of(vocabulary: Vocabulary, ids: np.ndarray, size: int, from_end: bool) -> int:
    """How many ids at that end of ``ids`` make ``size`` bytes."""
    take = 64
    while size:
        part = ids[len(ids) - min(take, len(ids)):][::-1] if from_end else ids[:take]
        total = np.cumsum(vocabulary.lengths[part])
        at = int(np.searchsorted(total, size))
        if at < len(total):
            if total[at] != size:
                raise ValueError("a boundary lies inside a token")
            return at + 1
        take *= 4
    return 0


def join(vocabulary: Vocabulary, text: str, left: Part, right: Part) -> Part:
    """The two neighbouring parts as one."""
    if left.start == left.end or right.start == right.end:
        return Part(left.start, right.end, np.concatenate([left.ids, right.ids]))
    seam = left.end
    low, high = _stable_before(text, left.start, seam), _stable_after(text, seam, right.end)
    before = _count_of(vocabulary, left.ids, len(text[low:seam].encode()), from_end=True)
    after = _count_of(vocabulary, right.ids, len(text[seam:high].encode()), from_end=False)
    window = _ids(vocabulary, text[low:high])
    return Part(left.start, right.end, np.concatenate([left.ids[:len(left.ids) - before], window, right.ids[after:]]))


def encode(vocabulary: Vocabulary, text: str, start: int = 0, end: int | None = None, leaf: int = LEAF_CHARS) -> Part:
    """``text[start:end]`` by recursive halving."""
    end = len(text) if end is None else end
    if end - start <= leaf:
        return Part(start, end, _ids(vocabulary, text[start:end]))
    middle = (start + end) // 2
    return join(vocabulary, text, encode(vocabulary, text, start, middle, leaf), encode(vocabulary, text, middle, end, leaf))


def decode(vocabulary: Vocabulary, ids: np.ndarray, leaf: int = LEAF_IDS) -> bytes:
    if len(ids) <= leaf:
        return vocabulary.encoding.decode_bytes(ids.tolist())
    return decode(vocabulary, ids[:len(ids) // 2], leaf) + decode(vocabulary, ids[len(ids) // 2:], leaf)


_LOADED: dict[tuple[str, str], Vocabulary] = {}


def vocabulary_of(path: str, pattern: str) -> Vocabulary:
    """Loaded once in each worker process."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Vocabulary.load(path, pattern)
    return _LOADED[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, ids binary, n_tokens, ids_sha256, decoded_sha256) of every row of ``docs`` (doc_id,
    text). ``ids`` are little-endian unsigned 32-bit integers (left out unless ``with_ids``). Null
    text counts as empty and has no ids; repeated rows stay; an empty table gives an empty result."""

    def run(batch: pa.RecordBatch) -> dict:
        vocabulary = vocabulary_of(path, pattern)
        raw, count, digest, decoded = [], [], [], []
        for text in batch.column(1).to_pylist():
            ids = encode(vocabulary, text or "").ids
            raw.append(ids.tobytes())
            count.append(len(ids))
            digest.append(hashlib.sha256(raw[-1]).hexdigest())
            decoded.append(hashlib.sha256(decode(vocabulary, ids)).hexdigest())
        return {"doc_id": batch.column(0), "ids": pa.array(raw, pa.binary()), "n_tokens": pa.array(count, pa.int64()),
                "ids_sha256": digest, "decoded_sha256": decoded}

    schema = "doc_id long, ids binary, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if not with_ids:
        schema = schema.replace("ids binary, ", "", 1)
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), schema, run)
