"""Property tests: folds, clipping, imputation, importances, vote, leakage, ordered helpers,
streaming equivalence."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from foldwise.operators import bounds, ensemble, fitting, folds, impute, importance, ordered
from foldwise.plans.common import cleaned_profile
from foldwise.session import scratch_path
from foldwise.sources import tables
from foldwise.streaming import apply as stream

from conftest import SF_MID, SF_SMALL


def test_folds_partition_and_balance(spark):
    t = tables.labelled_text(spark, SF_MID).select("id", "label")
    f = folds.stratified_folds(t, "id", "label", 5, 42, prefix_digits=2).cache()
    assert f.count() == t.count() and f.select("id").distinct().count() == t.count()
    counts = f.groupBy("label", "fold").count().groupBy("label").agg(
        (F.max("count") - F.min("count")).alias("spread"), F.count("*").alias("k")).collect()
    assert all(r["spread"] <= 1 and r["k"] == 5 for r in counts)


def test_bucketed_folds_equal_plain_window(spark):
    t = tables.labelled_text(spark, SF_MID).select("id", "label")
    a = folds.stratified_folds(t, "id", "label", 5, 7, prefix_digits=3)
    w = Window.partitionBy("label").orderBy(folds.row_hash("id", 7), "id")
    b = t.withColumn("fold", ((F.row_number().over(w) - 1) % 5).cast("int"))
    assert a.select("id", "fold").exceptAll(b.select("id", "fold")).count() == 0


def test_clip_is_idempotent_and_impute_leaves_no_nulls(spark):
    x = cleaned_profile(spark, SF_SMALL).select("id", "num_a", "num_b")
    b = bounds.fit_clip_bounds(x, ["num_a", "num_b"])
    once = bounds.apply_clip_bounds(x, b)
    twice = bounds.apply_clip_bounds(once, b)
    assert once.exceptAll(twice).count() == 0
    filled = impute.apply_fill(once, impute.fit_simple(once, ["num_a", "num_b"], "median"))
    assert filled.where(F.col("num_a").isNull() | F.col("num_b").isNull()).count() == 0


def test_foldwise_params_equal_per_fold_refits(spark):
    x = cleaned_profile(spark, SF_SMALL).select("id", "target", "num_a", "num_b")
    x = folds.stratified_folds(x, "id", "target", 4, 1).cache()
    q = {(r["fold"], r["feature"]): r for r in
         fitting.fit_quantiles(x, ["num_a", "num_b"], [0.01, 0.5, 0.99], ["lo", "md", "hi"], "fold", 4).collect()}
    mo = {(r["fold"], r["feature"]): r for r in fitting.fit_moments(x, ["num_a", "num_b"], "fold", 4).collect()}
    for f in range(4):
        tr = x.where(F.col("fold") != f)
        ref_q = {r["feature"]: r for r in fitting.fit_quantiles(tr, ["num_a", "num_b"], [0.01, 0.5, 0.99], ["lo", "md", "hi"]).collect()}
        ref_m = {r["feature"]: r for r in fitting.fit_moments(tr, ["num_a", "num_b"]).collect()}
        for c in ("num_a", "num_b"):
            for n in ("lo", "md", "hi"):
                assert q[(f, c)][n] == pytest.approx(ref_q[c][n])
            assert mo[(f, c)]["mean"] == pytest.approx(ref_m[c]["mean"])
            assert mo[(f, c)]["std_pop"] == pytest.approx(ref_m[c]["std_pop"])


def test_no_leakage_validation_rows_do_not_move_their_fold_params(spark):
    x = cleaned_profile(spark, SF_SMALL).select("id", "target", "num_a")
    x = folds.stratified_folds(x, "id", "target", 5, 3).cache()
    p0 = {r["fold"]: r["value"] for r in impute.fit_simple(x, ["num_a"], "median", fold_col="fold", k=5).collect()}
    y = x.withColumn("num_a", F.when(F.col("fold") == 2, F.col("num_a") * 1000 + 7).otherwise(F.col("num_a")))
    p1 = {r["fold"]: r["value"] for r in impute.fit_simple(y, ["num_a"], "median", fold_col="fold", k=5).collect()}
    assert p0[2] == p1[2]
    assert any(p0[f] != p1[f] for f in (0, 1, 3, 4))


def test_kll_quantiles_close_to_exact(spark):
    li = tables.load(spark, SF_MID, "lineitem", ["l_extendedprice"])
    ex = fitting.fit_quantiles(li, ["l_extendedprice"], [0.1, 0.5, 0.9], ["a", "b", "c"]).collect()[0]
    ap = fitting.fit_quantiles(li, ["l_extendedprice"], [0.1, 0.5, 0.9], ["a", "b", "c"], exact=False).collect()[0]
    for n in "abc":
        assert ap[n] == pytest.approx(ex[n], rel=0.05)


def test_importances_normalised_sum_to_one(spark):
    imp = tables.fold_importance(spark, SF_SMALL)
    s = importance.normalize(imp).groupBy("fold").agg(F.sum("importance_norm").alias("s")).collect()
    assert all(r["s"] == pytest.approx(1.0) for r in s)


def test_vote_is_one_of_the_predictions(spark):
    long = spark.createDataFrame([(i, m, (i * 7 + m * 3) % 3) for i in range(50) for m in range(5)], "id int, model int, pred int")
    v = ensemble.majority_vote(long, "id")
    assert v.join(long, (v.id == long.id) & (v.vote == long.pred), "left_anti").count() == 0


def test_running_sums_equal_single_window(spark):
    df = spark.createDataFrame([(float(i % 37), i % 3, 1) for i in range(2000)], "s double, g int, one int")
    got = ordered.running_sums(df.groupBy("s").agg(F.sum("one").alias("n")), "s", ["n"], descending=True, n_buckets=8)
    w = Window.orderBy(F.desc("s"))
    ref = df.groupBy("s").agg(F.sum("one").alias("n")).withColumn("cum_n", F.sum("n").over(w))
    assert got.select("s", "cum_n").exceptAll(ref.select("s", "cum_n")).count() == 0
    rn = ordered.global_row_number(df.withColumn("id", F.monotonically_increasing_id()), "s", ["id"], n_buckets=8)
    ref2 = df.withColumn("id", F.monotonically_increasing_id()).withColumn("seq", F.row_number().over(Window.orderBy("s", "id")))
    assert rn.select("id", "seq").exceptAll(ref2.select("id", "seq")).count() == 0


def test_fitted_transforms_run_on_a_stream(spark):
    x = cleaned_profile(spark, SF_SMALL).select("id", "num_a", "num_b")
    b = bounds.fit_clip_bounds(x, ["num_a", "num_b"])
    m = impute.fit_simple(x, ["num_a", "num_b"], "median")
    steps = [lambda d: bounds.apply_clip_bounds(d, b), lambda d: impute.apply_fill(d, m)]
    src = scratch_path(spark, "stream-src")
    x.repartition(3).write.parquet(src)
    out = scratch_path(spark, "stream-out")
    q = stream.write_stream(stream.score_stream(stream.read_stream(spark, src, x.schema), steps), out, trigger_once=True)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.exceptAll(stream.apply_steps(x, steps)).count() == 0 and got.count() == x.count()


def test_auto_sizing_keeps_results(spark):
    t = tables.labelled_text(spark, SF_MID).select("id", "label")
    a = folds.stratified_folds(t, "id", "label", 5, 42)
    b = folds.stratified_folds(t, "id", "label", 5, 42, prefix_digits=4)
    assert a.exceptAll(b).count() == 0
    df = spark.createDataFrame([(float(i % 101), 1) for i in range(3000)], "s double, one int")
    r1 = ordered.running_sums(df, "s", ["one"])
    r2 = ordered.running_sums(df, "s", ["one"], n_buckets=16)
    assert r1.exceptAll(r2).count() == 0


def test_attach_falls_back_to_shuffle_join_beyond_bound(spark):
    from foldwise.operators import joins
    df = spark.createDataFrame([(i % 7, i) for i in range(200)], "g int, v int")
    t = df.groupBy("g").agg(F.sum("v").alias("s"))
    small = joins.attach(df, t, ["g"])
    big = joins.attach(df, t, ["g"], max_rows=3)
    assert "BroadcastExchange" in small._jdf.queryExecution().executedPlan().toString()
    assert small.exceptAll(big).count() == 0 and big.count() == 200


def test_hot_key_holding_a_third_of_rows(spark):
    # key 0 holds a third of all rows; every per-key operator must stay exact
    from foldwise.operators import encode, tracking
    rows = [(i, 0 if i % 3 == 0 else i % 50, i % 2, float(i % 17)) for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, g long, y int, x double")
    te = encode.apply_target_mean(df, encode.fit_target_mean(df, "g", "y"), "g")
    hot = te.where(F.col("g") == 0).select("te").distinct().collect()
    ys = [r[2] for r in rows if r[1] == 0]
    assert len(ys) >= 2000 and len(hot) == 1 and hot[0]["te"] == pytest.approx(sum(ys) / len(ys))
    gm = impute.fit_group_means(df, "y", "g", ["x"])
    assert gm["child"].count() == df.select("y", "g").distinct().count()
    runs = df.select(F.col("id").alias("run_id"), F.col("g").cast("string").alias("config_file"),
                     F.col("id").alias("ts"), F.lit("success").alias("status"))
    last = {r["config_file"]: r["run_id"] for r in tracking.latest_per_key(runs, "config_file").collect()}
    assert last["0"] == 5997


def test_stream_query_leaves_no_active_stream(spark):
    import __spark_entry__ as entry_mod
    df = entry_mod.queries()["stream_apply"](spark, SF_SMALL)
    assert df.count() > 0
    assert spark.streams.active == []
