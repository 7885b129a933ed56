import random
import zlib
from functools import lru_cache
from itertools import combinations

import numpy as np
import public_tokenizers as P
import pytest

from llm_data import docs, no_docs  # noqa: F401
from foldwise.llm import packing, token_records
from foldwise.llm.tokens import UnitEncoder
from foldwise.session import scratch_path

WORDS = P.path("word_bpe_49k.json")
BYTES = P.path("byte_bpe_50k.json")


def test_frames_round_trip_and_damage_is_found():
    payload = token_records.to_payload(7, np.array([1, 70_000], "<u4"))
    data = token_records.frame(payload) + token_records.frame(token_records.to_payload(None, np.array([], "<u4")))
    first, after = token_records.unframe(data, 0)
    assert first == payload and token_records.from_payload(first)[1].tolist() == [1, 70_000]
    second, end = token_records.unframe(data, after)
    assert token_records.from_payload(second)[0] is None and end == len(data)
    for at in range(after - 1):
        with pytest.raises(ValueError):
            token_records.unframe(data[:at] + bytes([data[at] ^ 1]) + data[at + 1:], 0)


def test_records_of_edge_rows(spark, docs, no_docs):
    path = scratch_path(spark, "records")
    token_records.write_records(docs.repartition(3), path, WORDS, 2)
    index = token_records.write_index(spark, path)
    enc = UnitEncoder(WORDS, False)
    want = sorted(((d["doc_id"] is not None, d["doc_id"] or 0, np.frombuffer(enc.encode(d["text"]) + (2).to_bytes(4, "little"), "<u4")) for d in docs.collect()),
                  key=lambda r: (r[0], r[1], len(r[2])))
    rows = index.orderBy("shard", "record").collect()
    assert [r["doc_id"] for r in rows] == [i if known else None for known, i, _ in want]
    start = 0
    by = {}
    for _, i, ids in want:
        by.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    for r in rows:
        assert r["start"] == start and (r["n_tokens"], r["ids_crc32"]) in by[r["doc_id"] or 0]
        start += r["n_tokens"]
    # a shuffled read takes every record once, by its place
    files = {int(f["path"].split("part-")[1][:5]): bytes(f["content"]) for f in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()}
    order = token_records.shuffled(index, 5).collect()
    assert len(order) == len(rows) and [(r["shard"], r["record"]) for r in order] != [(r["shard"], r["record"]) for r in rows]
    for r in order:
        payload, end = token_records.unframe(files[r["shard"]], r["offset"])
        assert end - r["offset"] == r["length"] and token_records.from_payload(payload)[0] == r["doc_id"]
    empty = scratch_path(spark, "no-records")
    token_records.write_records(no_docs, empty, WORDS, 2)
    assert token_records.write_index(spark, empty).count() == 0


def test_a_repeated_id_is_spread_over_shards(spark, monkeypatch):
    monkeypatch.setattr(token_records, "SHARD_BYTES", 2000)
    rows = [(7 if i % 3 else None, "same text" if i % 2 else f"text {i} " * 5) for i in range(600)] + [(i, "a") for i in range(7)]
    path = scratch_path(spark, "records")
    token_records.write_records(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), path, WORDS, 2)
    found = token_records.write_index(spark, path).orderBy("shard", "record").collect()
    ids = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in found]
    assert ids == sorted((i is not None, i or 0) for i, _ in rows)
    assert len({r["shard"] for r in found if r["doc_id"] == 7}) > 2 and len({r["shard"] for r in found if r["doc_id"] is None}) > 2


def best(items, capacity):
    @lru_cache(None)
    def fewest(left):
        if not left:
            return 0
        j, rest = left[0], left[1:]
        return min(1 + fewest(tuple(x for i, x in enumerate(rest) if i not in c)) for k in range(len(rest) + 1)
                   for c in combinations(range(len(rest)), k) if j + sum(rest[i] for i in c) <= capacity)
    return fewest(tuple(items))


def test_reduction_keeps_the_optimum_and_plans_are_whole():
    rng = random.Random(4)
    for _ in range(250):
        capacity = rng.choice([10, 20, 37])
        items = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 8))), reverse=True)
        count = {s: items.count(s) for s in items}
        left = dict(count)
        fixed = packing.reduce_instance(left, capacity)
        rest = sorted((s for s, n in left.items() for _ in range(n)), reverse=True)
        assert best(items, capacity) == sum(n for _, n in fixed) + best(rest, capacity)
        sequences = packing.plan(count, capacity)
        assert all(sum(held) <= capacity for held, _ in sequences)
        assert sorted((s for held, n in sequences for s in held * n), reverse=True) == items


def test_exact_pairs_are_fixed():
    left = {600: 5, 424: 3, 100: 2}
    assert ((600, 424), 3) in packing.reduce_instance(left, 1024)


def test_only_long_documents_are_cut():
    assert packing.cut(1024, 1024) == [(0, 1024)] and packing.cut(1, 1024) == [(0, 1)]
    assert packing.cut(2500, 1024) == [(0, 452), (452, 1024), (1476, 1024)]


def test_packing_of_edge_rows(docs, no_docs):
    rows = packing.pack_documents(docs, BYTES, 2, 64).collect()
    enc = UnitEncoder(BYTES, True)
    sizes = sum(len(enc.encode(d["text"])) // 4 + 1 for d in docs.collect())
    assert sum(r["length"] for r in rows) == sizes
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    assert len([r for r in rows if r["doc_id"] == 5]) == 1 and [r["length"] for r in rows if r["doc_id"] == 5] == [1]
    assert packing.pack_documents(no_docs, BYTES, 2, 64).count() == 0
