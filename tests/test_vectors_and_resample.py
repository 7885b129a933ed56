"""Vector hook, PCA and SMOTE properties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.operators import resample, vectors
from foldwise.sources import tables

from conftest import SF_SMALL


def _char_encoder(texts):
    # a tiny deterministic "model": 4 character statistics per text
    return np.array([[len(t), sum(c.isupper() for c in t), t.count(" "), t.count(".")] for t in texts], dtype=float)


def test_embed_hook_runs_in_arrow_batches(spark):
    docs = tables.load(spark, SF_SMALL, "documents", ["doc_id", "text"])
    e = vectors.embed_with_model(docs, "doc_id", "text", _char_encoder, 4)
    got = {r["doc_id"]: r["embedding"] for r in e.collect()}
    ref = {r["doc_id"]: _char_encoder([r["text"] or ""])[0].tolist() for r in docs.collect()}
    assert got.keys() == ref.keys()
    assert all(got[k] == pytest.approx(ref[k]) for k in ref)


def test_hashed_embedding_is_a_token_mean(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None)], "doc_id long, text string")
    e = {r["doc_id"]: r["embedding"] for r in vectors.hashed_text_embedding(docs, "doc_id", "text", 8).collect()}
    assert sum(e[1]) == pytest.approx(1.0) and max(e[1]) == pytest.approx(2 / 3)
    assert e[2] == [0.0] * 8 and e[3] == [0.0] * 8


def test_pca_explained_variance_is_sorted(spark):
    emb = tables.load(spark, SF_SMALL, "embeddings", ["vec_id", "embedding"])
    out, ev = vectors.standardized_pca(emb, "embedding", 5, 64)
    assert ev == sorted(ev, reverse=True) and 0 < sum(ev) <= 1.0 + 1e-9
    assert out.select(F.size("pca").alias("n")).distinct().collect()[0]["n"] == 5


def test_knn_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = [(i, int(i % 2), [float(x) for x in rng.normal(size=6)]) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, c int, v array<double>")
    got = {(r["id"], r["rank"]): r["neighbour_id"] for r in resample.knn_within_class(df, "id", "v", "c", 3, block_rows=8).collect()}
    for i, c, v in rows:
        d = sorted((float(np.linalg.norm(np.array(v) - np.array(w))), j) for j, cc, w in rows if cc == c and j != i)
        for rank in range(1, 4):
            assert got[(i, rank)] == d[rank - 1][1]


def test_smote_rows_lie_between_base_and_neighbour(spark):
    emb = tables.load(spark, SF_SMALL, "embeddings", ["vec_id", "label", "embedding"]).withColumnRenamed("vec_id", "id")
    s = resample.smote(emb, "id", "embedding", "label", 0, 25, 3, seed=1).collect()
    vec = {r["id"]: np.array(r["embedding"], dtype=float) for r in emb.where(F.col("label") == 0).collect()}
    assert len(s) == 25
    for r in s:
        a, b = vec[r["base_id"]], vec[r["neighbour_id"]]
        assert np.allclose(np.array(r["vector"]), a + r["gap"] * (b - a))
        assert 0 <= r["gap"] < 1
    again = resample.smote(emb, "id", "embedding", "label", 0, 25, 3, seed=1).collect()
    assert sorted(map(tuple, [(r["base_id"], r["j"], r["neighbour_id"]) for r in s])) == \
        sorted(map(tuple, [(r["base_id"], r["j"], r["neighbour_id"]) for r in again]))


def test_masked_pool_all_masked_key_is_zero(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 0.0), (1, [3.0, 4.0], 0.0), (2, [1.0, 1.0], 1.0), (2, [3.0, 5.0], 0.0)],
                               "k int, v array<double>, m double")
    got = {(r["k"], r["pos"]): r["value"] for r in vectors.mean_pool(df, ["k"], "v", "m").collect()}
    assert got == {(1, 0): 0.0, (1, 1): 0.0, (2, 0): 1.0, (2, 1): 1.0}


def test_oversample_minority_balances_and_keeps_originals(spark):
    from pyspark.ml.functions import array_to_vector
    from foldwise.operators import train
    rng = np.random.default_rng(1)
    rows = [(i, 1 if i % 4 == 0 else 0, [float(x) for x in rng.normal(size=3)]) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, label int, v array<double>").select(
        "id", "label", array_to_vector("v").alias("features"))
    out = train.oversample_minority(df, seed=3).cache()
    counts = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
    assert counts[0] == counts[1] == 60
    assert out.where(F.col("id") >= 0).count() == 80
    assert out.where(F.col("id") < 0).select("label").distinct().collect()[0]["label"] == 1


@pytest.mark.parametrize("points", [
    [[float(i)] * 3 for i in range(300)],                     # collinear: the k-th distance is met exactly
    [[0.1 * (i % 7), 1.0] for i in range(120)],               # many equal points
    [[2.0, 3.0]] * 40,                                        # one point
])
def test_knn_is_exact_on_degenerate_points(spark, points):
    df = spark.createDataFrame([(i, "a", p) for i, p in enumerate(points)], "id long, c string, v array<double>")
    got = {}
    for r in resample.knn_within_class(df, "id", "v", "c", 5, block_rows=32).collect():
        got.setdefault(r["id"], {})[r["rank"]] = r["neighbour_id"]
    x = np.array(points)
    for i in range(len(points)):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        want = sorted((d[j], j) for j in range(len(points)) if j != i)[:5]
        assert [got[i][k] for k in range(1, 6)] == [j for _, j in want]


def test_oversampling_a_tiny_class_keeps_ids_unique(spark):
    from pyspark.ml.functions import array_to_vector
    from foldwise.operators import train
    rows = [(i, 0, [float(i), 1.0]) for i in range(4000)] + [(4000, 1, [1.0, 2.0]), (10**15, 1, [3.0, 2.0])]
    df = spark.createDataFrame(rows, "id long, label int, v array<double>").select("id", "label", array_to_vector("v").alias("features"))
    new = train.oversample_minority(df).where("id < 0")
    assert new.count() == 3998 == new.select("id").distinct().count()


def test_clustered_rows_visit_few_blocks_and_neighbours_stay_exact(spark):
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(24, 5)) * 100
    x = np.concatenate([c + rng.normal(size=(60, 5)) for c in centres])
    rows = [(int(i), v.tolist(), int(i) % 2) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, v array<double>, c int").repartition(6)
    near, visits, blocks = resample.knn_visits(df, "id", "v", "c", 3, block_rows=32)
    per_class = blocks / 2
    assert blocks > 30 and visits.count() < 0.25 * len(rows) * (per_class - 1)
    got = {}
    for r in resample.knn_within_class(df, "id", "v", "c", 3, block_rows=32).collect():
        got.setdefault(r["id"], {})[r["rank"]] = (r["neighbour_id"], r["distance"])
    for i in range(0, len(rows), 37):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        want = sorted((d[j], j) for j in range(len(rows)) if j != i and j % 2 == i % 2)[:3]
        assert [got[i][k][0] for k in (1, 2, 3)] == [j for _, j in want]
        assert [got[i][k][1] for k in (1, 2, 3)] == pytest.approx([a for a, _ in want])


def test_visits_are_handed_on_in_small_batches():
    """Before: a task held the visits of all rows of an Arrow batch, whose number grows with that of the blocks."""
    import pandas as pd
    rows, blocks = 600, 200
    pdf = pd.DataFrame({"_class": [1] * rows, "_id": range(rows), "_v": [np.zeros(3)] * rows, "_to": [np.zeros(1)] * rows,
                        "_block": [i % blocks for i in range(rows)], "_kth": [None] * rows}).astype({"_kth": float})
    known = {1: (np.arange(blocks), np.zeros(blocks, int), np.zeros(blocks), np.ones(blocks))}
    got = list(resample._visit_batches(pdf, known))
    assert max(map(len, got)) <= resample.VISITS_AT_ONCE
    pairs = pd.concat(got)[["_id", "_block"]]
    assert len(pairs) == len(pairs.drop_duplicates()) == rows * (blocks - 1) and not (pairs["_id"] % blocks == pairs["_block"]).any()


def test_fold_models_vote_in_one_scan(spark):
    """Before: the table was read, and its features were made, once for each model."""
    from pyspark.ml.functions import array_to_vector
    from foldwise.operators import train
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i if i % 9 else None, i % 2, i % 3, [float(x) for x in rng.normal(size=3) + i % 2]) for i in range(90)],
                               "id long, label int, fold int, v array<double>").withColumn("features", array_to_vector("v"))
    models = [train.make_estimator("tree", {"maxDepth": 3}).fit(df.where(F.col("fold") != f)) for f in range(3)]
    got = train.predict_vote(models, df)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    counts = {}
    for m in models:
        for r in m.transform(df).collect():
            key = r["id"], int(r["prediction"])
            counts[key] = counts.get(key, 0) + 1
    want = {i: max((n, -p) for (j, p), n in counts.items() if j == i) for i in {i for i, _ in counts}}
    assert {r["id"]: (r["votes"], -r["vote"]) for r in got.collect()} == want


def test_a_training_table_has_partitions_by_its_rows(spark, monkeypatch):
    """Before: one partition of up to 64 MB, so that a fit ran in one task."""
    from foldwise.plans import q_model
    whole = q_model.train_frame(spark, SF_SMALL)
    monkeypatch.setattr(q_model, "TRAIN_ROWS", 10)
    dealt = q_model.train_frame(spark, SF_SMALL)
    assert dealt.rdd.getNumPartitions() == -(-dealt.count() // 10) > 1
    assert sorted(map(str, dealt.collect())) == sorted(map(str, whole.collect()))


def test_word_lists_match_whole_runs_only(spark):
    from foldwise.functions import text as tx
    texts = ["i", "I am", "hi", "i-i_i i", "é i", "I’m", "éi iß", "", "a.b a.b", "xa.b", "[ [x", "1i i1 i"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(tx._count_in(F.lower("t"), ["I", "a.b", "["]).alias("n"), tx._holds(F.lower("t"), ["I", "a.b", "["]).alias("h")).collect()
    import re
    want = [len(re.findall(r"(?<![^\W])(?:i|a\.b|\[)(?![^\W])", t.lower())) for t in texts]
    assert [r["n"] for r in got] == want and [r["h"] for r in got] == [n > 0 for n in want]
