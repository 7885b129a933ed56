import math
import random
import re
from collections import Counter

import numpy as np

from llm_data import docs, no_docs  # noqa: F401
from foldwise.llm import lexical_search as ls

ITEMS = "item_id long, text string, term string, score int, shard int"


def words(text):
    return re.findall(ls.TERM, re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def plain(documents, items, k=10):
    """Every document scored for every item."""
    tfs = [(i, Counter(words(t))) for i, t in documents]
    n_all, l_all = sum(bool(c) for _, c in tfs), sum(sum(c.values()) for _, c in tfs)
    df = Counter(t for _, c in tfs for t in c)
    out = {}
    asked = {}
    for i, t in set(items):
        asked.setdefault(i, Counter()).update(words(t))
    for item, query in asked.items():
        rows = []
        for i, c in tfs:
            m = 25 + (75 * sum(c.values()) * n_all) // max(1, l_all)
            s = sum(q * math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, q in query.items() if c[t])
            if s > 0:
                rows.append((-s, i is None, i or 0))
        if rows:
            out[item] = [(None if null else i, -s) for s, null, i in sorted(rows)[:k]]
    return out


def found(frame):
    out = {}
    for r in frame.orderBy("item_id", "rank").collect():
        out.setdefault(r["item_id"], []).append((r["doc_id"], r["score"]))
        assert r["rank"] == len(out[r["item_id"]])
    return out


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" if i % 3 else f"É{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    return [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 1, 5, 30, 200])))) for i in range(n)]


def test_terms_equal_the_pattern():
    for t in ["A-Z az 09_x", "É ÉÀ İxK", "a b  c", "\x00a\x7fb", None, "", "日本 語", "x'y"]:
        assert [w.decode() for w in ls.terms(t)] == words(t)


def test_lists_round_trip():
    rows = ls.build_shard(3, list(range(700)), ["a " * (300 if i == 5 else i % 4) + ("b" if i in (0, 699) else "") for i in range(700)], 700, 2000).to_pylist()
    by = {r["term"]: r for r in rows}
    a = ls.PostingList(by["a"]["heads"], by["a"]["gaps"], by["a"]["tfs"])
    doc, tf = a.all()
    assert dict(zip(doc.tolist(), tf.tolist())) == {i: 300 if i == 5 else i % 4 for i in range(700) if i % 4} and by["a"]["n_docs"] == len(doc) and len(a.heads) == 5
    assert ls.PostingList(by["b"]["heads"], by["b"]["gaps"], by["b"]["tfs"]).all()[0].tolist() == [0, 699]


def test_block_maxima_keep_blocks_closed():
    """With a full heap, the common term is looked up only where a document could still enter."""
    texts = ["rare common" if i == 700 else "common " + "filler " * 8 for i in range(2000)]
    rows = {r["term"]: r for r in ls.build_shard(0, list(range(2000)), texts, 2000, 18_000).to_pylist()}
    lists = {t: ls.PostingList(r["heads"], r["gaps"], r["tfs"]) for t, r in rows.items() if t}
    about = np.frombuffer(rows[""]["gaps"], "<i8"), np.frombuffer(rows[""]["heads"], "<i8"), np.zeros(2000, bool)
    heap = ls.Heap(1)
    heap.merge(np.array([100_000_000]), np.array([-1]), np.array([False]))
    ls.search_shard(lists, about, [("rare", 6000), ("common", 1)], heap)
    assert heap.doc.tolist() == [700] and lists["common"].opened == 1
    again = ls.Heap(1)
    again.merge(np.array([10**12]), np.array([-1]), np.array([False]))
    ls.search_shard(lists, about, [("filler", 5)], again)
    assert again.doc.tolist() == [-1] and lists["filler"].opened == 0


def test_search_equals_scoring_everything(spark, monkeypatch):
    documents = corpus(1500, 1)
    items = [(i, t) for i, t in corpus(40, 2)] + [(99, "w1 w1 w1 nowhere"), (100, "nowhere"), (101, None), (7, "w5 w5"), (7, "w5 w5"), (None, "w2")]
    frame = spark.createDataFrame([(i, t, "", 0, 0) for i, t in items], ITEMS)
    documents += documents[:30]
    docs = spark.createDataFrame(documents, "doc_id long, text string").repartition(3)
    want = plain(documents, items)
    assert found(ls.search(ls.build(docs, shard_bytes=20_000), frame)) == want
    monkeypatch.setattr(ls, "QUERY_TERMS", 100)
    assert found(ls.search(ls.build(docs), frame)) == want


def test_edge_rows(spark, docs, no_docs):
    items = [(1, "word1 word2 word30 dog"), (2, "x" * 30_000), (3, "ß und"), (4, "")]
    frame = spark.createDataFrame([(i, t, "", 0, 0) for i, t in items], ITEMS)
    documents = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(ls.search(ls.build(docs), frame)) == plain(documents, items)
    assert ls.search(ls.build(no_docs), frame).count() == 0 and ls.search(ls.build(docs), frame.limit(0)).count() == 0
