"""Block products and fold-wise text features, against NumPy and plain loops."""

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from foldwise.operators import foldtext, gram, profile
from foldwise.operators.vectors import names_of

K = 4


def test_correlations_of_400_columns_with_missing_values(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 8))
    x = base @ rng.normal(size=(8, 400)) + rng.normal(size=(300, 400)) + 1e5
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 7], x[:, 8], x[:, 9] = 3.25, np.nan, np.where(np.arange(300) == 5, 1.0, np.nan)
    names = [f"c{i}" for i in range(400)]
    df = spark.createDataFrame([[row] for row in x.tolist()], "v array<double>").repartition(5).select(*[
        F.when(F.lit(i % 2 == 0) & F.isnan(F.col("v")[i]), F.lit(None).cast("double")).otherwise(F.col("v")[i]).alias(n) for i, n in enumerate(names)])
    got = {(r["col_a"], r["col_b"]): r["r"] for r in profile.corr_long(df, names).collect()}
    want = pd.DataFrame(x, columns=names).corr(min_periods=2)
    assert len(got) == 400 * 399 // 2
    for (a, b), r in got.items():
        expected = want.loc[a, b]
        assert (r is None and (np.isnan(expected) or "c7" in (a, b))) or r == pytest.approx(expected, abs=2e-6), (a, b)
    assert got["c3", "c7"] is None and got["c3", "c8"] is None and got["c3", "c9"] is None


def test_few_columns_take_the_same_values_by_both_ways(spark, monkeypatch):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, None, 3.0), (4.0, 1.0, 4.0), (3.0, 7.0, 9.0)], "a double, b double, c double")
    one = sorted(map(tuple, profile.corr_long(df, ["a", "b", "c"]).collect()))
    monkeypatch.setattr(profile, "MAX_PAIRS", 0)
    assert sorted(map(tuple, profile.corr_long(df, ["a", "b", "c"]).collect())) == one
    assert {r["r"] for r in profile.corr_long(df.limit(0), ["a", "b", "c"]).collect()} == {None}


def vectors_of(n=200, d=6):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + 1e4
    x[:, 3] = 2.5
    return x


def test_components_of_each_fold_equal_numpy(spark):
    x = vectors_of()
    fold = np.arange(len(x)) % K
    df = spark.createDataFrame([(i, int(f), v) for i, (f, v) in enumerate(zip(fold, x.tolist()))] + [(999, 1, None)], "id long, fold int, v array<double>").repartition(6)
    pca = gram.FoldPCA(3).fit(df, "v", K)
    out = pca.transform(df, "v")
    assert names_of(out, "pca") == ["text_pca_000", "text_pca_001", "text_pca_002"]
    got = {r["id"]: r["pca"] for r in out.collect()}
    assert got[999] is None
    for f in range(K):
        train = x[fold != f]
        scale = np.where(train.std(axis=0) < 1e-9, 1.0, train.std(axis=0))
        z = (train - train.mean(axis=0)) / scale
        values = np.linalg.svd(z - z.mean(axis=0), compute_uv=False) ** 2 / (len(z) - 1)
        assert pca.moments[f].n == len(train) and pca.values[f] == pytest.approx(values, abs=1e-6)
        assert pca.explained_ratio(f) == pytest.approx(values[:3] / values.sum(), abs=1e-6)
        mine = (x[fold == f] - train.mean(axis=0)) / scale @ pca.axes[f].T
        assert np.allclose([got[i].toArray() for i in np.flatnonzero(fold == f)], mine, atol=1e-5)
        assert np.allclose((z @ pca.axes[f].T).std(axis=0, ddof=1) ** 2, values[:3], atol=1e-5)
    one = pca.transform(df, "v", -1).where("id = 3").first()["pca"].toArray()
    assert np.allclose(one, (x[3] - x.mean(axis=0)) / np.where(x.std(axis=0) < 1e-9, 1, x.std(axis=0)) @ pca.axes[-1].T, atol=1e-5)
    with pytest.raises(ValueError):
        gram.FoldPCA(7).fit(df, "v", K)
    assert gram.fold_moments(df.limit(0), "v", K) == {}


TEXTS = ["The cat the dog", "a cat", None, "", "dog dog dog bird", "the end, the END", "bird_1 é É cat", "the the the a", "a a b b c", "only here"]


def tfidf_by_loops(texts, train, max_features, max_df):
    words = [Counter(re.findall(r"\w+", (t or "").lower())) for t in texts]
    n = len(train)
    df = Counter(w for i in train for w in words[i])
    cf = Counter()
    for i in train:
        cf.update(words[i])
    kept = sorted(sorted((w for w in df if df[w] <= max_df * n), key=lambda w: (-cf[w], w))[:max_features])
    idf = {w: math.log((1 + n) / (1 + df[w])) + 1 for w in kept}
    rows = []
    for c in words:
        v = [(1 + math.log(c[w])) * idf[w] if c[w] else 0.0 for w in kept]
        norm = math.sqrt(sum(a * a for a in v)) or 1.0
        rows.append([a / norm for a in v])
    return kept, rows


def test_tfidf_vectors_of_each_fold_equal_loops(spark):
    docs = spark.createDataFrame([(i, i % 3, t) for i, t in enumerate(TEXTS)], "id long, fold int, text string").repartition(3)
    counts = foldtext.FoldTfidf.counts(docs, "id", "text")
    fitted = foldtext.FoldTfidf(5, max_df=0.6).fit(docs, counts, 3)
    for f in (-1, 0, 1, 2):
        kept, want = tfidf_by_loops(TEXTS, [i for i in range(len(TEXTS)) if i % 3 != f], 5, 0.6)
        out = fitted.vectors(docs, counts, f)
        assert names_of(out, "tfidf") == [f"tfidf_{w}" for w in kept]
        got = {r["id"]: r["tfidf"] for r in out.collect()}
        assert all(isinstance(v, SparseVector) for v in got.values()) and len(got) == len(TEXTS)
        for i, v in enumerate(want):
            assert got[i].toArray().tolist() == pytest.approx(v)
    with pytest.raises(ValueError):
        foldtext.FoldTfidf(0).fit(docs, counts, 3)


def test_a_vector_and_an_embedding_keep_their_names(spark):
    docs = spark.createDataFrame([(i, i % 3, t, [1.0, 0.0] if i else None) for i, t in enumerate(TEXTS)], "id long, fold int, text string, e array<double>")
    counts = foldtext.FoldTfidf.counts(docs, "id", "text")
    fitted = foldtext.FoldTfidf(3).fit(docs, counts, 3)
    both = foldtext.with_embedding(fitted.vectors(docs, counts, 1), "tfidf", "e", 2, "emb")
    names = names_of(both)
    assert names == fitted.names(1) + ["emb_000", "emb_001"]
    long = {(r["id"], r["feature"]): r["value"] for r in foldtext.long(both, ["id"]).collect()}
    assert long[1, "emb_000"] == 1.0 and (0, "emb_000") not in long and not any(f == "emb_001" for _, f in long)
    with pytest.raises(Exception):
        foldtext.with_embedding(fitted.vectors(docs, counts, 1), "tfidf", "e", 3, "emb").where("id = 1").collect()
