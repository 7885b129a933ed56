"""Fold params from counted values, against NumPy on each training set."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.operators import counted
from foldwise.operators.pipeline import ALL_ROWS, FoldPipeline

K = 4
KIND = "id long, fold int, a double, b double, t double, o double, c string, empty double"


def rows(n=400, seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        a = None if i % 9 == 0 else float(np.round(rng.normal() * 3, 1))
        t = None if i % 5 == 0 else float(rng.choice([-4.0, 0.0, 1.0, 50.0, 900.0]))
        out.append((i, i % K, a, float(rng.normal() + 1e6), t, None if i % 7 == 0 else float(i % 3), rng.choice(["x", "y", None]), None))
    return out


def prepared(data, fold):
    """Columns of all rows by the params of one training set."""
    col = lambda j: np.array([np.nan if r[j] is None else r[j] for r in data])
    inside = np.array([fold == ALL_ROWS or r[1] != fold for r in data])
    out = {}
    for name, j in (("a", 2), ("b", 3)):
        v = col(j)
        lo, hi = np.nanquantile(v[inside], [0.01, 0.99])
        v = np.clip(v, lo, hi)
        out[name] = np.where(np.isnan(v), np.nanmedian(v[inside]), v)
    out["ratio"] = out["a"] / out["b"]
    t = col(4)
    out["t"] = np.log1p(np.maximum(np.where(np.isnan(t), np.nanmedian(t[inside]), t), 0.0))
    for name in ("a", "b", "ratio", "t"):
        out[name] = (out[name] - out[name][inside].mean()) / out[name][inside].std()
    o = col(5)
    values, n = np.unique(o[inside & ~np.isnan(o)], return_counts=True)
    out["o"] = np.where(np.isnan(o), values[n.argmax()], o)
    return out


def pipe(**more):
    return FoldPipeline(["a", "b"], ["c"], text_mode="new", ratios=("a", "b"), longtail=["t"], ordinal=["o"], **more)


def test_all_roles_equal_numpy_on_each_training_set(spark):
    data = rows()
    df = spark.createDataFrame(data, KIND).repartition(7)
    fitted = pipe().fit(df, K)
    for fold in (ALL_ROWS, 0, 3):
        got = {r["id"]: r for r in fitted.apply(df, fold).collect()}
        want = prepared(data, fold)
        for name, values in want.items():
            assert [got[i][name] for i in range(len(data))] == pytest.approx(values.tolist(), abs=1e-6), (fold, name)
        for i, r in enumerate(data):
            assert [got[i][f"cat__c_{v}"] for v in ("-1", "x", "y")] == [float((r[6] or "-1") == v) for v in ("-1", "x", "y")]


def test_vectors_are_named_by_role_and_saved_params_give_the_same(spark, tmp_path):
    df = spark.createDataFrame(rows(), KIND)
    fitted = pipe(scaler="minmax").fit(df, K)
    x = fitted.features(df, F.col("fold"), ["id"])
    from foldwise.operators.vectors import names_of

    assert names_of(x) == ["num__a", "num__b", "num__ratio", "log__t", "ord__o", "cat__c_-1", "cat__c_x", "cat__c_y"]
    assert 0 <= min(r["features"][0] for r in fitted.features(df, ALL_ROWS, []).collect())
    fitted.save(str(tmp_path))
    again = pipe(scaler="minmax").load(spark, str(tmp_path)).features(df, F.col("fold"), ["id"])
    assert sorted(map(str, again.collect())) == sorted(map(str, x.collect()))


def test_columns_without_values_and_single_values(spark):
    df = spark.createDataFrame([(0, 0, 5.0, 1.0, None, None, "x", None), (1, 1, None, 1.0, 2.0, 1.0, None, None)], KIND)
    fitted = FoldPipeline(["a", "b", "empty"], ["c"], longtail=["t"], ordinal=["o"]).fit(df, 2)
    r = {x["id"]: x for x in fitted.apply(df, F.col("fold")).collect()}
    assert r[0]["empty"] is None and r[0]["a"] is None and r[1]["a"] == 0.0 and r[0]["b"] == r[1]["b"] == 0.0 and r[1]["t"] is None and r[1]["o"] == 1.0
    assert [v for v in fitted.features(df, ALL_ROWS, []).first()["features"]][2] == 0.0
    nothing = FoldPipeline(["a"], ["c"]).fit(df.limit(0), 2)
    assert nothing.apply(df, 0).count() == 2


def test_moments_of_large_values_do_not_cancel(spark):
    values = [1e9 + i % 3 for i in range(3000)]
    table = counted.count_values(spark.createDataFrame([(v,) for v in values], "v double"), ["v"], {0: F.lit(True)})
    found = counted.moments(table, {"v": [{"lower": None, "upper": None, "filled": 1e9 + 1}]}, lambda v, lo, hi: v)
    assert found["v", 0]["std"] == pytest.approx(math.sqrt(2 / 3)) and found["v", 0]["center"] == pytest.approx(1e9 + 1)


def test_no_row_is_copied_to_its_training_folds(spark):
    """The counted values are one shuffle of (feature, value), whatever k is, and no plan node generates rows per fold."""
    df = spark.createDataFrame(rows(), KIND)
    for k in (2, 9):
        table = counted.count_values(df, ["a", "b"], {f: F.col("fold") != f for f in range(k)})
        plan = table._jdf.queryExecution().toString()
        assert "Generate" not in plan
    fitted = pipe().fit(df, K)
    plan = fitted.apply(df, F.col("fold"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan
