import random

import numpy as np
import pytest

from brute import components, cosine, jaccard_linked, shingles
from llm_data import docs, no_docs  # noqa: F401
from foldwise.llm import jaccard_join, vector_dedup
from foldwise.llm.components import components as spark_components


def near_copies():
    """A base with near copies around the threshold, a common passage, copies, and noise."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(40)]
    rows = []
    for size in (30, 80, 200):
        base = [word() for _ in range(size)]
        for k in range(25):
            copy = list(base)
            for _ in range(rng.randint(0, size // 25)):
                copy[rng.randrange(size)] = word()
            rows.append(" ".join(copy[rng.randint(0, size // 20):]))
    for _ in range(30):
        rows.append(" ".join([word() for _ in range(rng.randint(5, 60))] + passage + [word() for _ in range(rng.randint(0, 20))]))
    rows += [" ".join(passage)] * 3 + [" ".join(passage) + " " + word() for _ in range(4)]
    return [(i * 3, t) for i, t in enumerate(rng.sample(rows, len(rows)))]


@pytest.mark.parametrize("percent", [80, 90])
def test_join_equals_brute_force(spark, percent):
    rows = near_copies()
    got = {r["doc_id"]: r for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 5, percent).collect()}
    sets = {i: shingles(t) for i, t in rows}
    want = components(list(sets), lambda a, b: jaccard_linked(sets[a], sets[b], percent))
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert len(set(want.values())) < len(rows) - 20


def test_join_of_edge_rows(docs, no_docs):
    rows = jaccard_join.near_duplicates(docs, 5, 80).collect()
    assert len(rows) == docs.count()
    by = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None}
    assert by[2] == (56, 1) and by[3] == (57, 1) and by[5] == (0, 5) and by[6] == (0, 6) and by[7] == (0, 7)
    assert by[8] == (1, 8) and by[9] == (1, 8) and by[10] == (1, 10) and by[12][1] == 11
    assert sorted((r["n_shingles"], r["component_id"] or 0) for r in rows if r["doc_id"] is None) == [(0, 0), (56, 1)]
    assert jaccard_join.near_duplicates(no_docs, 5, 80).count() == 0


def test_sets_without_an_id_link_others(spark):
    words = [f"w{i}" for i in range(100)]
    a, b, c = (" ".join(words[:k] + [f"x{k}"] + words[k + 1:]) for k in (50, 10, 90))
    rows = spark.createDataFrame([(None, " ".join(words)), (1, a), (2, b), (3, c), (None, a)], "doc_id long, text string")
    found = jaccard_join.near_duplicates(rows, 5, 80).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in found) == [(0, 1), (0, 1), (1, 1), (2, 1), (3, 1)]


def test_few_words_are_one_shingle():
    assert len(jaccard_join.shingle_set("a b c", 5)) == 1 and len(jaccard_join.shingle_set("a b c d e f", 5)) == 2
    assert jaccard_join.shingle_set("A\tb\x0bC", 5).tolist() == jaccard_join.shingle_set("a b c", 5).tolist()
    assert len(jaccard_join.shingle_set("a b", 5)) == 1


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (7, 7)]
    found = {r["vertex"]: r["component"] for r in spark_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def vectors():
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(25):
        base = rng.normal(size=12)
        rows += [(base + rng.normal(size=12) * rng.choice([0.0, 0.05, 0.1, 0.2])).tolist() for _ in range(12)]
    rows += rng.normal(size=(60, 12)).tolist() + [rows[0]] * 5 + [[x * 1e200 for x in rows[1]], [x * 1e-200 for x in rows[2]]]
    return [(i * 2, v) for i, v in enumerate(rows)]


@pytest.mark.parametrize("cell_rows,block_rows", [(15, 16), (1000, 64)])
def test_vectors_equal_brute_force(spark, monkeypatch, cell_rows, block_rows):
    monkeypatch.setattr(vector_dedup, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(vector_dedup, "BLOCK_ROWS", block_rows)
    rows = vectors() + [(1001, None), (1003, []), (1005, [0.0] * 12), (1007, [float("nan")] * 12), (1009, [float("inf")] * 12), (1011, [None] * 12), (1013, [1.0, 2.0]), (1015, [2.0, 4.0])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in
           vector_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 0.95).collect()}
    scaled = {i: None if v is None else [x / 1e200 if x and abs(x) > 1e100 else x * 1e200 if x and 0 < abs(x) < 1e-100 else x for x in v] if i < 1000 else v for i, v in rows}
    linked = lambda a, b: a != b and cosine(scaled[a], scaled[b]) >= 0.95
    want = components(list(scaled), linked)
    assert {i: c for i, (_, c, _) in got.items()} == want
    assert {i: n for i, (n, _, _) in got.items()} == {i: sum(linked(i, j) for j in scaled) for i in scaled}
    assert all(k == (i == c) for i, (_, c, k) in got.items())


def test_vectors_of_edge_rows(spark):
    kind = "vec_id long, embedding array<float>, class_id long, times long, cell int, home int, key int"
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.01]), (4, [0.0, 1.0]), (None, None)]
    out = vector_dedup.near_duplicates(spark.createDataFrame([(*r, 1, 1, 1, 1, 1) for r in rows], kind), 0.95)
    got = sorted(((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in out.collect()))
    assert got == [(0, 0, 0, False), (0, 2, 1, False), (1, 2, 1, True), (1, 2, 1, True), (4, 0, 4, True)]
    assert vector_dedup.near_duplicates(spark.createDataFrame([], kind), 0.95).count() == 0


def test_no_vector_leaves_its_partner_unseen():
    rng = np.random.default_rng(5)
    points = vector_dedup.unit(rng.normal(size=(400, 8)))
    cells = vector_dedup.Cells(vector_dedup.spherical_kmeans(points, 20), 0.95)
    moved = vector_dedup.unit(points + rng.normal(size=points.shape) * 0.08)
    near = (points * moved).sum(axis=1) >= 0.95
    (h1, in1), (h2, in2) = cells.of(points), cells.of(moved)
    rows = np.arange(len(points))
    assert near.sum() > 100 and (in1[rows, h2] | in2[rows, h1])[near].all()


def test_plan_of_the_join_has_no_cross_join(spark):
    rows = spark.createDataFrame(near_copies()[:20], "doc_id long, text string")
    plan = jaccard_join.near_duplicates(rows, 5, 80)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_many_cells_need_little_memory():
    """2,048 centres of 64 dimensions: the gaps are one cells x cells array."""
    import tracemalloc

    rng = np.random.default_rng(3)
    centres = rng.normal(size=(2048, 64))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    tracemalloc.start()
    cells = vector_dedup.Cells(centres, 0.95)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6
    some = rng.integers(0, 2048, size=(50, 2))
    want = np.linalg.norm(centres[some[:, 0]] - centres[some[:, 1]], axis=1)
    assert (cells.gap[some[:, 0], some[:, 1]] >= want).all() and np.allclose(cells.gap[some[:, 0], some[:, 1]], want, atol=1e-6)
