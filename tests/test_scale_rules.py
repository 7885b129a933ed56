"""Ordered and quantile operators on skewed data, and fold-wise fits that never see their own fold."""

import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from foldwise.operators import encode, fitting, importance, impute, metrics, ordered, select, train, weights  # noqa: F401


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one group, half of the values equal, and a null group."""
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        group = "hot" if i % 3 == 0 else rng.choice(["a", "b", None])
        rows.append((i, group, i % 5, None if i % 17 == 0 else 7.0 if i % 2 else rng.gauss(0, 100)))
    return rows, spark.createDataFrame(rows, "id long, g string, fold int, x double").repartition(7)


PROBS = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]


def test_quantiles_equal_numpy(skewed):
    rows, df = skewed
    names = [f"p{i}" for i in range(len(PROBS))]
    got = {r["g"]: [r[n] for n in names] for r in fitting.fit_quantiles(df, ["x"], PROBS, names, by=["g"]).collect()}
    for g in ("hot", "a", "b", None):
        assert got[g] == pytest.approx(list(np.quantile([x for _, h, _, x in rows if h == g and x is not None], PROBS)))


def test_foldwise_quantiles_equal_numpy(skewed):
    rows, df = skewed
    got = {r["fold"]: (r["lo"], r["hi"]) for r in fitting.fit_quantiles(df, ["x"], [0.1, 0.75], ["lo", "hi"], "fold", 5).collect()}
    for f in range(5):
        assert got[f] == pytest.approx(tuple(np.quantile([x for _, _, g, x in rows if g != f and x is not None], [0.1, 0.75])))


def test_quantiles_hold_no_group_in_one_task(spark):
    df = spark.range(200_000).select(F.lit("all").alias("g"), (F.col("id") * 7919 % 199_999).cast("double").alias("x"))
    plan = fitting.fit_quantiles(df, ["x"], [0.5], ["m"], by=["g"])._jdf.queryExecution().toString()
    assert "percentile" not in plan and "collect_list" not in plan
    counted = fitting.long_values(df, ["x"], ["g"]).groupBy("g", "feature", "value").count()
    sizes = [r["count"] for r in counted.repartitionByRange(20, "g", "feature", "value").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 20 and max(sizes) < 3 * 200_000 / 20


def test_row_numbers_with_half_of_the_rows_at_one_time(spark):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id") % 9).cast("double").alias("t"))
    dealt = ordered._running(df.withColumn("one", F.lit(1)), [F.asc("t"), F.asc("id")], ["one"], 16)
    want = {i: n for n, (_, i) in enumerate(sorted((5.0 if i % 2 == 0 else float(i % 9), i) for i in range(20_000)), 1)}
    assert {r["id"]: r["cum_one"] for r in dealt.collect()} == want
    sizes = [r["count"] for r in df.repartitionByRange(16, "t", "id").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3 * 20_000 / 16


def test_running_sums_share_ties(spark):
    rows = [(i, float(i % 4), 1) for i in range(100)] + [(100, None, 1)]
    got = ordered.running_sums(spark.createDataFrame(rows, "id long, k double, n int"), "k", ["n"]).collect()
    assert {(r["k"], r["cum_n"]) for r in got} == {(3.0, 25), (2.0, 50), (1.0, 75), (0.0, 100), (None, 101)} and len(got) == 101


def test_best_by_takes_the_smallest_key_on_ties(spark):
    rows = [("c", 0.5), ("b", 0.9), ("a", 0.9), ("d", None)]
    for _ in range(3):
        random.shuffle(rows)
        df = spark.createDataFrame(rows, "key string, score double").repartition(3)
        assert select.best_by(df, "score", "key").first()["key"] == "a"


def test_importance_absent_from_a_fold_counts_as_zero(spark):
    rows = [(0, "a", 1.0), (0, "b", 1.0), (1, "a", 2.0)]
    got = {r["feature"]: r["cv_mean_importance_norm"] for r in importance.cv_mean(importance.normalize(
        spark.createDataFrame(rows, "fold int, feature string, importance double")), 2).collect()}
    assert got["a"] == pytest.approx(0.75) and got["b"] == pytest.approx(0.25)


def test_text_imputation(spark):
    rows = [(0, "x", None), (0, "y", None), (1, "x", None), (1, None, None), (2, "y", None), (2, None, None)]
    df = spark.createDataFrame(rows, "fold int, a string, b string")
    old = impute.apply_fill_text(df, impute.fit_simple_text(df, ["a", "b"], **impute.preset_text("old")))
    assert [r["a"] for r in old.collect()] == ["x", "y", "x", "x", "y", "x"] and {r["b"] for r in old.collect()} == {None}
    new = impute.apply_fill_text(df, impute.fit_simple_text(df, ["a", "b"], **impute.preset_text("new")))
    assert {r["b"] for r in new.collect()} == {"-1"}
    by_fold = {r["fold"]: r["value"] for r in impute.fit_simple_text(df, ["a"], "most_frequent", fold_col="fold", k=3).collect()}
    assert by_fold == {0: "x", 1: "y", 2: "x"}
    kept = impute.apply_fill_text(df, impute.fit_simple_text(df, ["a"], "most_frequent", fold_col="fold", k=3), "fold").collect()
    assert [(r["fold"], r["a"]) for r in kept if r["a"]] == [(0, "x"), (0, "y"), (1, "x"), (1, "y"), (2, "y"), (2, "x")]


def test_class_weights_come_from_the_training_rows(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, int(rng.random() < 0.3), i % 3, [float(x) for x in rng.normal(size=2)]) for i in range(90)]
    seen = []
    plain = weights.with_weights

    def spy(df, label, table, out="weight"):
        seen.append({r["label"]: round(r["weight"], 9) for r in table.collect()})
        return plain(df, label, table, out)

    monkeypatch.setattr(weights, "with_weights", spy)

    def fitted(rows):
        seen.clear()
        df = spark.createDataFrame(rows, "id long, label int, fold int, v array<double>").withColumn("features", array_to_vector("v")).drop("v")
        train.cross_validate(df, "tree", {"maxDepth": 2}, 3, class_weight="balanced", parallelism=1)
        return list(seen)

    before = fitted(rows)
    after = fitted([(i, 1 - y if f == 1 else y, f, [9.0, 9.0] if f == 1 else v) for i, y, f, v in rows])
    assert before[1] == after[1] and before[0] != after[0]


def test_pipeline_params_never_see_their_own_fold(spark):
    from foldwise.operators.pipeline import FoldPipeline
    rng = np.random.default_rng(6)
    rows = [(i, i % 4, float(rng.normal()), None if i % 9 == 0 else float(rng.normal() + 5), rng.choice(["x", "y", None])) for i in range(200)]
    kind = "id long, fold int, a double, b double, c string"

    def params(rows):
        pipe = FoldPipeline(["a", "b"], ["c"], text_mode="old", ratios=("a", "b")).fit(spark.createDataFrame(rows, kind), 4)
        # sums over counted values are taken in any order
        return {name: sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in t.collect()), key=str) for name, t in pipe.tables.items()}

    before, after = params(rows), params([(i, f, 99.0 + i, -7.0, "new") if f == 2 else (i, f, a, b, c) for i, f, a, b, c in rows])
    assert set(before) == {"clip", "median", "scale", "fill", "categories"}
    for name in before:
        pick = lambda t, f: [r for r in t if r[0] == f]
        assert pick(before[name], 2) == pick(after[name], 2) and pick(before[name], 2)
        if name != "fill":
            assert pick(before[name], 1) != pick(after[name], 1)
    pipe = FoldPipeline(["a", "b"], ["c"], text_mode="old", ratios=("a", "b")).fit(spark.createDataFrame(rows, kind), 4)
    train_a = np.array([a for _, f, a, _, _ in rows if f != 2])
    lo, hi = np.quantile(train_a, [0.01, 0.99])
    clipped = np.clip(train_a, lo, hi)
    got = {r["id"]: r["a"] for r in pipe.apply(spark.createDataFrame(rows, kind), 2).collect()}
    for i, f, a, _, _ in rows:
        if f == 2:
            assert got[i] == pytest.approx((np.clip(a, lo, hi) - clipped.mean()) / clipped.std())


def test_one_hot_of_any_number_of_categories(spark):
    df = spark.createDataFrame([(i, f"v{i % 7}", None if i % 3 else "w") for i in range(40)], "id long, a string, b string")
    params = encode.fit_one_hot(df.where("id < 5"), ["a", "b"])
    want = encode.one_hot_long(df, "id", encode.one_hot_columns(params)).collect()
    assert sorted(map(tuple, encode.one_hot_long_joined(df, "id", ["a", "b"], params).collect()), key=str) == sorted(map(tuple, want), key=str)
