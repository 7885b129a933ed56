"""Best-fit packing of token sequences, with Martello-Toth dominance reduction.

Every document becomes pieces of at most ``capacity`` ids. How pieces are packed depends only on
how many there are of each length, so the instance is a table of at most ``capacity`` counts,
whatever the number of documents. The plan is made from that table:

1. *Reduction* (:func:`reduce_instance`). A small set that holds a piece j dominates every other
   set with j if what those hold besides j could change places with what the small set holds.
   Such sets are fixed for good and the instance shrinks:
   j alone, if nothing fits beside it; {j, k}, if they fill the sequence exactly; {j, k} with the
   longest k that fits, if no two others that fit beside j together are longer than k.
2. *Best fit* (:func:`best_fit`) of the rest, longest first, each into the fullest sequence that
   has room, for whole groups of alike sequences at once.

The plan (some thousand rows) is sent to the executors. Each piece finds its place by its rank
among the pieces of its length. Ranks come from counts per (length, bucket of documents), so a
length that a third of all pieces share is ranked by many tasks.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldwise.llm.common import map_batches, written
from foldwise.llm.tokens import encoder

#: Rows of one length that one ranking task sorts, about.
BUCKET_ROWS = 10_000


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all have ``capacity`` ids, the first may have fewer."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document; null text counts as empty."""

    def run(batch: pa.RecordBatch) -> dict:
        enc, end = encoder(vocabulary, keep_space=True), end_id.to_bytes(4, "little")
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = enc.encode(text) + end
            for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                rows.append((doc, piece, start, length, zlib.crc32(ids[4 * start:4 * (start + length)])))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        columns = zip(*rows)
        return {c: pa.array(v, k) for c, v, k in zip(("doc_id", "piece", "start", "length", "ids_crc32"), columns, kinds)}

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"),
                       "doc_id long, piece int, start long, length long, ids_crc32 long", run)


def reduce_instance(count: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fix dominating sets; ``count`` (length → pieces) keeps the rest. Returns (set, times)."""
    fixed: list[tuple[tuple[int, ...], int]] = []
    sizes = sorted(s for s, n in count.items() if n > 0)

    def take(lengths: tuple[int, ...], times: int) -> None:
        fixed.append((lengths, times))
        for s in lengths:
            count[s] -= times
            if not count[s]:
                del count[s]
                sizes.remove(s)

    def have(s: int, without: int) -> int:
        return count.get(s, 0) - (s == without)

    def longest_pair(room: int, j: int) -> int:
        """The greatest sum, at most ``room``, of two pieces other than one j."""
        best, low, high = 0, 0, len(sizes) - 1
        while low <= high:
            a, b = sizes[low], sizes[high]
            enough = (have(a, j) >= 2) if a == b else (have(a, j) >= 1 and have(b, j) >= 1)
            if a + b > room:
                high -= 1
            else:
                if enough:
                    best = max(best, a + b)
                elif have(b, j) < 1:
                    high -= 1
                    continue
                low += 1
        for s in sizes:  # two alike
            if have(s, j) >= 2 and 2 * s <= room:
                best = max(best, 2 * s)
        return best

    def least_three(j: int) -> int | None:
        """The sum of the three shortest pieces other than one j; None if there are fewer."""
        left, total = 3, 0
        for s in sizes:
            n = min(left, have(s, j))
            left, total = left - n, total + n * s
            if not left:
                return total
        return None

    changed = True
    while changed:
        changed = False
        for j in sorted(sizes, reverse=True):
            while count.get(j, 0):
                room = capacity - j
                at = bisect_right(sizes, room) - 1
                while at >= 0 and have(sizes[at], j) < 1:
                    at -= 1
                if at < 0:
                    take((j,), count[j])
                    changed = True
                    break
                k = sizes[at]
                times = count[j] // 2 if k == j else min(count[j], count[k])
                if k != room:
                    three = least_three(j)
                    if not (three is None or three > room) or longest_pair(room, j) > k:
                        break
                    if k == j and count[j] == 3:
                        times = 1
                take((j, k), times)
                changed = True
    return fixed


def best_fit(count: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first, each piece into the fullest open sequence with room. Returns (set, times)."""
    open_: list[tuple[int, tuple[int, ...], int]] = []  # (room, set, times), fullest first
    done: list[tuple[tuple[int, ...], int]] = []
    for s in sorted(count, reverse=True):
        left = count[s]
        at = bisect_right(open_, (s, (), 0))
        while left and at < len(open_):
            room, held, times = open_.pop(at)
            each = room // s
            full, some = divmod(min(left, each * times), each)
            for n, m in ((each, full), (some, 1 if some else 0), (0, times - full - (1 if some else 0))):
                if m:
                    insort(open_, (room - n * s, held + (s,) * n, m))
            left -= full * each + some
            at = bisect_right(open_, (s, (), 0))
        if left:
            each = capacity // s
            full, some = divmod(left, each)
            for n, m in ((each, full), (some, 1 if some else 0)):
                if m:
                    insort(open_, (capacity - n * s, (s,) * n, m))
        while open_ and open_[0][0] == 0:
            _, held, times = open_.pop(0)
            done.append((held, times))
    return done + [(held, times) for _, held, times in open_]


def plan(count: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """All sequences, as (lengths of the pieces in one, how many such sequences)."""
    rest = {s: n for s, n in count.items() if n > 0}
    fixed = reduce_instance(rest, capacity)
    return fixed + best_fit(rest, capacity)


def slots(sequences: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """length → rows (first rank, places in a sequence, first sequence, offset), by first rank."""
    rows: dict[int, list] = {}
    ranks: dict[int, int] = {}
    first = 0
    for held, times in sequences:
        offset = 0
        for s in sorted(set(held), reverse=True):
            n = held.count(s)
            rows.setdefault(s, []).append((ranks.get(s, 0), n, first, offset))
            ranks[s] = ranks.get(s, 0) + n * times
            offset += n * s
        first += times
    return {s: np.array(x, dtype=np.int64) for s, x in rows.items()}


def ranked(pieces: DataFrame, rows: int) -> DataFrame:
    """``pieces`` with ``rank``: from 0 among those of their length, by bucket, doc_id and piece."""
    buckets = max(1, -(-rows // BUCKET_ROWS))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = (dealt.groupBy("length", "bucket").count()
              .withColumn("before", F.sum("count").over(Window.partitionBy("length").orderBy("bucket")) - F.col("count"))
              .select("length", "bucket", "before"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32"))
    return (dealt.withColumn("inside", inside).join(before, ["length", "bucket"])
            .withColumn("rank", F.col("before") + F.col("inside") - 1).drop("bucket", "before", "inside"))


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with ``sequence_id`` and ``offset``.

    Repeated rows are packed one by one. Only counts by length (at most ``capacity`` rows) reach
    the driver.
    """
    count = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    place = slots(plan(count, capacity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for s in np.unique(length):
                at, rows = np.flatnonzero(length == s), place[int(s)]
                row = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                number, within = np.divmod(rank[at] - row[:, 0], row[:, 1])
                sequence[at], offset[at] = row[:, 2] + number, row[:, 3] + within * s
            out = batch.select(["doc_id", "piece", "start", "length", "ids_crc32"])
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(sequence), pa.array(offset)],
                                             [*out.schema.names, "sequence_id", "offset"])

    return ranked(pieces, sum(count.values())).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """Encode, cut and pack ``docs`` (doc_id, text). Null and empty texts are one piece: the end id.
    An empty table gives an empty result."""
    return pack(written(token_pieces(docs, vocabulary, end_id, capacity), "pieces"), capacity)
