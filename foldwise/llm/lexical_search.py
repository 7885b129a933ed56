"""Ranked lexical search: an inverted index in shards, searched by Block-Max MaxScore.

Index. Documents are cut, in the order of their partition, into *shards* of bounded text. A shard holds one
list per term: postings (document, tf) in blocks of 128, each block with its first document, its widths and its
*maximum*, the largest tf part that a posting in it can add to a score. Gaps between documents take one or two
bytes, tf one or four, by block. Lists are rows of a Parquet table; the row of the empty term holds the shard's
document ids and length factors m. N and L are counted before, so block maxima are exact.

Search. Queries run in blocks of bounded size against all shards. A task reads its shards one after another
and carries a heap of the k best per query. In a shard the lists of a query are ordered by their largest
block maximum times weight. The longest run of the least lists whose bounds together stay below the k-th
score is *non-essential*: a document found only there cannot enter. The essential lists are added up. Each
document found gets the block maxima of the non-essential lists where it would be; if even that stays
below the k-th score it is rejected, and a non-essential block is decompressed only if a document that is
left falls into it. The heaps of all tasks are merged by Spark. Rejections are strict, so ties are kept.

Score (64-bit integers, div rounds down): terms are maximal matches of :data:`TERM`, only A-Z lower-cased;
w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 25 + (75 n N) div L, and a term adds
w ((10^9 tf) div (1000 tf + 8 m)), as often as the query holds it.

Edge cases: null and empty texts hold no term and don't count in N; a query without known terms has no rows;
rows with the same doc_id are documents of their own, tied ones with one id have adjacent ranks; a null
doc_id comes last among ties; rows that share an item_id are one query with the terms of its different texts;
a null item_id is an item; empty tables give no rows; extra columns do not pass; a text of any length is one
document of one shard.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldwise.llm.common import small_batches, written

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A shard is cut after so many bytes of text, or so many documents (an ordinal takes two bytes).
SHARD_BYTES, SHARD_DOCS = 8 << 20, 1 << 16
BLOCK = 128
#: Rows of the index that go to the JVM at a time.
OUT_ROWS = 4096
#: Terms of the queries that go to the executors at a time.
QUERY_TERMS = 200_000
#: ASCII: letters lower-cased, digits, and a space for all else; other bytes stay.
_TABLE = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else 32 if b < 128 else b for b in range(256))
#: first document, block maximum, where the block's gaps and tfs begin, postings, bytes of a gap and of a tf.
HEAD = np.dtype([("first", "<u4"), ("most", "<u4"), ("gaps", "<u4"), ("tfs", "<u4"), ("n", "<u2"), ("wide", "u1"), ("tf_wide", "u1")])
INDEX = "shard long, term string, n_docs long, heads binary, gaps binary, tfs binary"


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


def tf_part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _slices(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Consecutive byte slices of ``flat``; ``ends``: where each one ends."""
    offsets = np.concatenate(([0], ends)).astype("<i8")
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(flat.tobytes())]).cast(pa.binary())


def _packed(values: np.ndarray, wide: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Little-endian bytes of ``values``, ``wide`` bytes each, and where each one begins."""
    begin = np.cumsum(wide, dtype=np.int64) - wide
    out = np.zeros(int(wide.sum(dtype=np.int64)), np.uint8)
    for k in range(int(wide.max(initial=0))):
        some = wide > k
        out[begin[some] + k] = (values[some] >> (8 * k)) & 255
    return out, begin


def build_shard(number: int, doc_ids: list, texts: list, n_all: int, l_all: int) -> pa.RecordBatch:
    """The rows of one shard."""
    words = pc.ascii_split_whitespace(pa.array([(t or "").encode().translate(_TABLE).decode() for t in texts], pa.large_string()))
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), pc.list_value_length(words).to_numpy(zero_copy_only=False))
    coded = words.flatten().dictionary_encode()
    spelled = coded.dictionary
    known = pc.not_equal(spelled, "").to_numpy(zero_copy_only=False)[coded.indices]
    key = coded.indices.to_numpy(zero_copy_only=False)[known].astype(np.int64) << 16 | doc[known]
    del words, coded, known, doc
    n = np.bincount(key & 0xFFFF, minlength=len(texts)).astype(np.int64)
    m = 25 + (75 * n * n_all) // max(1, l_all)
    key.sort()
    ends = np.flatnonzero(np.diff(key, append=-1))
    key, tf = key[ends], np.diff(ends, prepend=-1)
    code, doc = key >> 16, key & 0xFFFF
    first = np.flatnonzero(np.diff(code, prepend=-1))  # where each list begins
    size = np.diff(first, append=len(code))
    place = np.arange(len(code)) - np.repeat(first, size)
    begins = place % BLOCK == 0
    block = np.cumsum(begins) - 1
    starts = np.flatnonzero(begins)
    gap = np.where(begins, 0, np.diff(doc, prepend=0))
    heads = np.zeros(len(starts), HEAD)
    if len(starts):
        heads["first"], heads["n"] = doc[starts], np.diff(starts, append=len(code))
        heads["most"] = np.maximum.reduceat(tf_part(tf, m[doc]), starts)
        heads["wide"] = np.where(np.maximum.reduceat(gap, starts) < 256, 1, 2)
        heads["tf_wide"] = np.where(np.maximum.reduceat(tf, starts) < 256, 1, 4)
    gaps, gap_at = _packed(gap, heads["wide"][block])
    tfs, tf_at = _packed(tf, heads["tf_wide"][block])
    list_of = np.repeat(np.arange(len(first)), size)[starts]
    heads["gaps"], heads["tfs"] = gap_at[starts] - gap_at[first][list_of], tf_at[starts] - tf_at[first][list_of]
    blocks = np.bincount(list_of, minlength=len(first))
    list_ends = lambda at, flat: np.append(at[first][1:], len(flat))[:len(first)]
    null = np.array([d is None for d in doc_ids])
    about = [np.array([d or 0 for d in doc_ids], "<i8").tobytes(), m.astype("<i8").tobytes(), np.packbits(null).tobytes()]
    one = lambda x, kind: pa.array([x], kind)
    columns = [
        pa.array(np.full(len(first) + 1, number)),
        pa.concat_arrays([one("", pa.string()), spelled.take(pa.array(code[first])).cast(pa.string())]),
        pa.array(np.concatenate(([0], size)).astype(np.int64)),
        pa.concat_arrays([one(about[0], pa.binary()), _slices(heads.view(np.uint8), np.cumsum(blocks) * HEAD.itemsize)]),
        pa.concat_arrays([one(about[1], pa.binary()), _slices(gaps, list_ends(gap_at, gaps))]),
        pa.concat_arrays([one(about[2], pa.binary()), _slices(tfs, list_ends(tf_at, tfs))])]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in INDEX.split(", ")])


class PostingList:
    """One list; blocks are decompressed when first asked for."""

    def __init__(self, heads: bytes, gaps: bytes, tfs: bytes):
        self.heads, self.gaps, self.tfs = np.frombuffer(heads, HEAD), gaps, tfs
        self.most, self.blocks, self.opened = int(self.heads["most"].max()), {}, 0

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and tfs of one block."""
        if b not in self.blocks:
            h = self.heads[b]
            gap = np.frombuffer(self.gaps, f"<u{h['wide']}", h["n"], h["gaps"])
            tf = np.frombuffer(self.tfs, f"<u{h['tf_wide']}", h["n"], h["tfs"])
            self.blocks[b] = int(h["first"]) + np.cumsum(gap, dtype=np.int64), tf.astype(np.int64)
            self.opened += 1
        return self.blocks[b]

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.block(b) for b in range(len(self.heads))]
        return parts[0] if len(parts) == 1 else tuple(np.concatenate(x) for x in zip(*parts))

    def bounds(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each document the block that would hold it, and that block's maximum (before the first block: 0)."""
        b = np.searchsorted(self.heads["first"], docs, side="right") - 1
        return b, np.where(b < 0, 0, self.heads["most"][b].astype(np.int64))

    def tf_of(self, docs: np.ndarray, block: np.ndarray) -> np.ndarray:
        """tf of each document, 0 where the list does not hold it; opens only the blocks named."""
        out = np.zeros(len(docs), np.int64)
        for b in np.unique(block[block >= 0]).tolist():
            found, tf = self.block(b)
            here = np.flatnonzero(block == b)
            at = np.searchsorted(found, docs[here])
            at[at == len(found)] = 0
            out[here] = np.where(found[at] == docs[here], tf[at], 0)
        return out


class Heap:
    """The k best (score, document) so far, equal scores by ascending id, null last."""

    def __init__(self, k: int):
        self.k, self.score, self.doc, self.null = k, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    @property
    def least(self) -> int:
        """A score below it cannot enter."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def merge(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        score, doc, null = np.append(self.score, score), np.append(self.doc, doc), np.append(self.null, null)
        best = np.lexsort((doc, null, -score))[:self.k]
        self.score, self.doc, self.null = score[best], doc[best], null[best]


def search_shard(lists: dict[str, PostingList], about: tuple, query: list[tuple[str, int]], heap: Heap) -> None:
    """Block-Max MaxScore of one query (term, weight) on one shard."""
    m, doc_ids, null = about
    here = sorted(((weight * lists[t].most, weight, t) for t, weight in query if weight and t in lists))
    if not here:
        return
    least = heap.least
    together = np.cumsum([bound for bound, _, _ in here])
    cut = int(np.searchsorted(together, least))  # so many lists stay below the least score together
    if cut == len(here):
        return
    score, seen = np.zeros(len(m), np.int64), np.zeros(len(m), bool)
    for _, weight, t in here[cut:]:
        docs, tf = lists[t].all()
        score[docs] += weight * tf_part(tf, m[docs])
        seen[docs] = True
    docs = np.flatnonzero(seen)
    score = score[docs]
    rest = [(weight, lists[t], *lists[t].bounds(docs)) for _, weight, t in reversed(here[:cut])]
    bound = score + sum((weight * most for weight, _, _, most in rest), np.int64(0))
    left = np.flatnonzero(bound >= least)
    for weight, found, block, most in rest:
        if not len(left):
            return
        some = docs[left]
        exact = weight * tf_part(found.tf_of(some, block[left]), m[some])
        score[left] += exact
        bound[left] += exact - weight * most[left]
        left = left[bound[left] >= least]
    if len(left):
        heap.merge(score[left], doc_ids[docs[left]], null[docs[left]])


class Index:
    """A written index: ``table`` holds its rows, ``n_docs`` the documents with a term."""

    def __init__(self, table: DataFrame, n_docs: int):
        self.table, self.n_docs = table, n_docs


def build(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> Index:
    """Index every whole text of ``docs`` (doc_id, text) in the shared folder."""
    small_batches(docs.sparkSession)
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    n = F.regexp_count("text", F.lit(TERM))
    n_all, l_all = docs.select(n.alias("n")).agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, number = [], [], 0, TaskContext.get().partitionId() << 32

        def shard():
            rows = build_shard(number, ids, texts, n_all, l_all)
            texts.clear()
            for i in range(0, rows.num_rows, OUT_ROWS):
                yield rows.slice(i, OUT_ROWS)
            del rows
            pa.default_memory_pool().release_unused()  # the worker goes on, and its memory is the executor's

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                ids.append(doc_id.as_py())
                texts.append(text)
                size += len(text or "")
                if size >= shard_bytes or len(ids) == SHARD_DOCS:
                    yield from shard()
                    ids, texts, size, number = [], [], 0, number + 1
        if ids:
            yield from shard()

    return Index(written(docs.mapInArrow(run, INDEX), "lexical-index"), n_all)


def _query_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times) of the different texts of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, t.decode(), n) for i, text in zip(*(c.to_pylist() for c in batch.columns)) for t, n in Counter(terms(text)).items()]
            columns = list(zip(*rows)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.int64()))], ["item_id", "term", "times"])

    items = items.select(items["item_id"].cast("long").alias("item_id"), items["text"]).distinct()
    return items.mapInArrow(run, "item_id long, term string, times long").groupBy("item_id", "term").agg(F.sum("times").alias("times"))


def _search_block(index: Index, rows: list, k: int) -> DataFrame:
    """The best of every task for one block of queries."""
    spark = index.table.sparkSession
    wanted = spark.createDataFrame([("",)] + [(t,) for t in sorted({r["term"] for r in rows})], "term string")
    lists = index.table.join(F.broadcast(wanted), "term", "left_semi")  # at most a block of terms
    counts = lists.where("term <> ''").groupBy("term").agg(F.sum("n_docs").alias("df")).collect()
    weight = {r["term"]: math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * r["df"] + 1))) for r in counts}
    queries: dict = {}
    for r in rows:
        if r["term"] in weight:
            queries.setdefault(r["item_id"], []).append((r["term"], weight[r["term"]] * r["times"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = {i: Heap(k) for i in queries}
        held: dict = {}
        shard = None

        def finish():
            doc_ids, m, bits = held.pop("")
            m = np.frombuffer(m, "<i8")
            about = m, np.frombuffer(doc_ids, "<i8"), np.unpackbits(np.frombuffer(bits, np.uint8), count=len(m)).astype(bool)
            lists = {t: PostingList(*x) for t, x in held.items()}
            for i, query in queries.items():
                search_shard(lists, about, query, heaps[i])
            held.clear()

        for batch in batches:
            for number, term, *parts in zip(*(c.to_pylist() for c in batch.columns)):
                if number != shard:
                    if held:
                        finish()
                    shard = number
                held[term] = parts
        if held:
            finish()
        for i, h in heaps.items():
            columns = [[i] * len(h.score), [None if x else d for d, x in zip(h.doc.tolist(), h.null.tolist())], h.score.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])

    dealt = lists.select("shard", "term", "heads", "gaps", "tfs").repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(run, "item_id long, doc_id long, score long")


def search(index: Index, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` highest-scoring documents of each of ``items`` (item_id, text): item_id, rank from 1, doc_id, score."""
    asked = written(_query_terms(items), "lexical-queries")
    n = asked.count()
    blocks = max(1, -(-n // QUERY_TERMS))
    found = None
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()
        part = _search_block(index, rows, k)
        if blocks > 1:
            part = written(part, "lexical-found")
        found = part if found is None else found.unionByName(part)
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
