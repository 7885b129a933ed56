"""N-gram Jaccard self-join with adaptive multi-match prefixes; components of the links.

A document's set holds the 64-bit hashes of its distinct shingles of ``n`` words. Sets x and y link
when |x ∩ y| / |x ∪ y| >= ``percent`` / 100, in whole numbers. Linked sets share at least
need(x) = ceil(percent * |x| / 100) shingles of x. So for every m >= 1, under any order of the
shingles, the first |x| - need(x) + m of x and as many of y have at least m in common: with a longer
prefix more matches can be asked for before a pair is verified. Each document takes the m that
makes its estimated cost least; a pair must then share min(m(x), m(y)) prefix shingles.

Stages, none of which loses a link:

1. Every document: its set's size and id (a hash of the set: equal sets are one from here on), and its
   prefix under the order of the hashes, with m = 1 + |x| / 10.
2. Prefix shingles found in two different sets are counted per document. A document with fewer than m of
   them has no partner. This leaves the *survivors*; only they are read again.
3. Among the survivors: the number of sets that hold each shingle. One held once matches nothing, so a
   set with u others has partners of at most 9u/4 - |x| shingles (for 80 percent) and needs
   u >= need(x). Prefixes under the order (number of sets, hash), so that common passages come
   last; m by estimated cost.
4. Each set is verified against one *hub* per prefix shingle, the cleanest set there. In a large group of
   near copies that finds the component without making its pairs.
5. The other pairs that share enough prefix shingles are verified, unless both are in one component
   already. A pair (x, y) needs o = ceil(percent * (|x| + |y|) / (100 + percent)) in common, so of its
   prefixes only the first u(x) - o + m and u(y) - o + m shingles count, which for sets of like size is far
   less than the whole prefix. A shingle's most frequent component is never paired with itself.

Counts are combined before they are shuffled; joins by shingle are equi-joins of two tables, whose hot
keys Spark splits; nothing is gathered per shingle or group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldwise.llm.common import map_batches, written
from foldwise.llm.components import components

#: The greatest number of shared prefix shingles that is asked for in stage 5.
MOST_MATCHES = 3
#: Cost of looking at one shingle while verifying, in units of one posting read.
VERIFY_COST = 0.01
#: Ids of survivors that may be broadcast to pick their texts; beyond, both sides are shuffled.
BROADCAST_ROWS = 1_000_000


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes (int64) of the runs of ``n`` words; fewer words are one run.

    ``bytes.split`` cuts at exactly the bytes 0x20 and 0x09-0x0D, and ``bytes.lower`` changes A-Z only."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.int64)
    joined, digest = b" ".join(words), xxhash.xxh3_64_intdigest
    if len(words) <= n:
        return np.array([digest(joined)], np.uint64).view(np.int64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends[:-n + 1 or None] - [len(w) + 1 for w in words[:len(words) - n + 1]]).tolist()
    hashes = [digest(joined[s:e]) for s, e in zip(starts, (ends[n - 1:] - 1).tolist())]
    return np.unique(np.array(hashes, np.uint64).view(np.int64))


def need(size: int, percent: int) -> int:
    return -(-percent * size // 100)


def first_matches(size: int) -> int:
    """The m of stage 1."""
    return 1 + size // 10


def _sets(docs: DataFrame, n: int, percent: int, whole: bool) -> DataFrame:
    """(doc_id, n_shingles, set_id, tokens): all hashes, or the prefix of stage 1."""

    def run(batch: pa.RecordBatch) -> dict:
        sizes, ids, tokens = [], [], []
        for text in batch.column(1).to_pylist():
            x = shingle_set(text, n)
            sizes.append(len(x))
            ids.append(np.array([xxhash.xxh3_64_intdigest(x.tobytes())], np.uint64).view(np.int64)[0] if len(x) else None)
            tokens.append(x if whole or not len(x) else x[:min(len(x), len(x) - need(len(x), percent) + first_matches(len(x)))])
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in tokens])]).astype(np.int32)
        values = np.concatenate(tokens) if tokens else np.empty(0, np.int64)
        return {"doc_id": batch.column(0), "n_shingles": pa.array(sizes, pa.int64()), "set_id": pa.array(ids, pa.int64()),
                "tokens": pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))}

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"),
                       "doc_id long, n_shingles long, set_id long, tokens array<bigint>", run)


def _survivors(rows: DataFrame, percent: int) -> DataFrame:
    """(set_id, doc_id): sets that may have a partner, each with its least document (stage 2).

    A partner has at least need(x) shingles, and so an m of at least 1 + need(x) / 10."""
    postings = rows.select("doc_id", "set_id", "n_shingles", F.explode("tokens").alias("token"))
    shared = postings.groupBy("token").agg(F.min("set_id").alias("low"), F.max("set_id").alias("high")).where("low <> high").select("token")
    enough = (postings.join(shared, "token").groupBy("set_id", "doc_id", "n_shingles").count()
              .where(f"count >= 1 + (({percent} * n_shingles + 99) div 100) div 10"))
    return enough.groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(token, place, set_id, size, u, most, matches): the adaptive prefixes of stage 3. ``u`` shingles are in
    other sets, too; ``place`` is a shingle's rank among them, and ``most`` bounds a partner's size."""
    postings = sets.select("set_id", F.col("n_shingles").alias("size"), F.explode("tokens").alias("token"))
    counts = postings.groupBy("token").agg(F.count("*").alias("sets")).where("sets > 1")
    mine = Window.partitionBy("set_id")
    ordered = mine.orderBy("sets", "token")
    shared = (postings.join(counts, "token")
              .withColumn("place", F.row_number().over(ordered))
              .withColumn("read", F.sum("sets").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("u", F.count("*").over(mine))
              .withColumn("need", F.expr(f"({percent} * size + 99) div 100"))
              .where("u >= need").withColumn("m", F.expr("place - (u - need)")))
    cost = F.col("read") * (1 + F.lit(VERIFY_COST) * F.col("size") / F.col("m"))
    choice = F.when((F.col("m") >= 1) & (F.col("m") <= MOST_MATCHES), F.struct(cost.alias("cost"), F.col("m")))
    return (shared.withColumn("matches", F.min(choice).over(mine)["m"]).where("m <= matches")
            .withColumn("most", F.expr(f"({100 + percent} * u) div {percent} - size"))
            .select("token", "place", "set_id", "size", "u", "most", "matches"))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``pairs`` (a, b) whose sets link."""
    one = sets.select(F.col("set_id").alias("a"), F.col("tokens").alias("x"))
    two = sets.select(F.col("set_id").alias("b"), F.col("tokens").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return (pairs.join(one, "a").join(two, "b").withColumn("common", common)
            .where(100 * F.col("common") >= percent * (F.size("x") + F.size("y") - F.col("common"))).select("a", "b"))


def _hub_pairs(prefixes: DataFrame) -> DataFrame:
    """Each set with the cleanest, then largest, set of each of its prefix shingles (stage 4)."""
    hubs = (prefixes.groupBy("token").agg(F.min(F.struct((F.col("size") - F.col("u")).alias("noise"), -F.col("size"), "set_id", "size", "most")).alias("hub"))
            .select("token", F.col("hub.set_id").alias("hub"), F.col("hub.size").alias("hub_size"), F.col("hub.most").alias("hub_most")))
    return (prefixes.join(hubs, "token").where("set_id <> hub and size <= hub_most and hub_size <= most")
            .select(F.greatest("set_id", "hub").alias("a"), F.least("set_id", "hub").alias("b")).distinct())


def _other_pairs(prefixes: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share enough prefix shingles (stage 5)."""
    labelled = (prefixes.join(found.withColumnRenamed("vertex", "set_id"), "set_id", "left")
                .withColumn("component", F.coalesce("component", "set_id")))
    per = labelled.groupBy("token", "component").agg(F.count("*").alias("sets"))
    main = (per.groupBy("token").agg(F.count("*").alias("components"), F.max(F.struct("sets", "component")).alias("main"))
            .where("components > 1").select("token", F.col("main.component").alias("main")))
    mixed = labelled.join(main, "token")
    x, y = mixed.where("component <> main").alias("x"), mixed.alias("y")
    common = f"({percent} * (x.size + y.size) + {99 + percent}) div {100 + percent}"
    near = lambda s: f"{s}.place <= {s}.u - {common} + least(x.matches, y.matches)"
    return (x.join(y, F.expr(f"""x.token = y.token and x.component <> y.component and x.size <= y.most and y.size <= x.most
                                 and {near('x')} and {near('y')} and (y.component = y.main or x.set_id < y.set_id)"""))
            .select(F.greatest("x.set_id", "y.set_id").alias("a"), F.least("x.set_id", "y.set_id").alias("b"),
                    F.least("x.matches", "y.matches").alias("matches"))
            .groupBy("a", "b", "matches").count().where("count >= matches").select("a", "b"))


def link_sets(docs: DataFrame, n: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(rows, found): every document's (doc_id, n_shingles, set_id), and (vertex, component) of the sets
    that link with another. Pairs of linked sets are kept as far as components need them."""
    rows = written(_sets(docs, n, percent, whole=False), "jaccard-rows")
    picked = written(_survivors(rows, percent), "jaccard-survivors")
    few = picked.count() <= BROADCAST_ROWS
    ids = picked.select("doc_id").distinct()
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(ids) if few else ids, "doc_id")
    named = _sets(texts, n, percent, whole=True).join(picked, ["doc_id", "set_id"])
    # sets of rows without a doc_id only have no id to be fetched by: such rows are read again
    nameless = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is null")
    nameless = _sets(nameless, n, percent, whole=True).join(picked.where("doc_id is null").select("set_id"), "set_id", "left_semi")
    sets = written(named.unionByName(nameless).dropDuplicates(["set_id"]), "jaccard-sets")
    prefixes = written(_prefixes(sets, percent), "jaccard-prefixes")
    near = written(_linked(_hub_pairs(prefixes), sets, percent), "jaccard-hub-links")
    found = components(near)
    far = _linked(_other_pairs(prefixes, found, percent), sets, percent)
    # components are joined by the links between them
    return rows.select("doc_id", "n_shingles", "set_id"), components(near.union(far))


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    ``component_id`` is the least doc_id reached by links, the row's own included. Null and empty texts and
    texts of white space have 0 shingles and link with nothing. A null doc_id gets no doc_id of its own:
    its component is the least doc_id linked with it, null if there is none. Repeated rows stay. An empty
    table gives an empty result. Shingles and sets are told apart by 64-bit hashes."""
    rows, found = link_sets(docs, n, percent)
    labelled = (rows.join(found.select(F.col("vertex").alias("set_id"), "component"), "set_id", "left")
                .withColumn("component", F.coalesce("component", "set_id")))
    least = labelled.where("set_id is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return (labelled.join(least, "component", "left")
            .select("doc_id", "n_shingles", F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))
