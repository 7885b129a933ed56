"""Early stopping, saved runs, named importances, and searches scored in one scan."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from foldwise.operators import boosting, pipeline, saved_runs, select, train
from foldwise.session import scratch_path


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(240, 3))
    y = (x[:, 0] + 0.5 * rng.normal(size=240) > 0).astype(int)
    rows = [(i, int(y[i]), i % 3, x[i].tolist()) for i in range(240)]
    return spark.createDataFrame(rows, "id long, label int, fold int, v array<double>").select("id", "label", "fold", array_to_vector("v").alias("features")).cache()


def test_the_stop_round_follows_patience():
    assert boosting.stop_round([5, 4, 4.5, 4.4, 3], 2) == (4, 2) and boosting.stop_round([5, 4, 4.5, 3], 2) == (4, 4)
    assert boosting.stop_round([3, 3, 3], 5) == (3, 1) and boosting.stop_round([math.nan, 2, math.nan, math.nan], 2) == (4, 2)
    off = boosting.EarlyStopping(enabled=False)
    assert not off.applies("gbt") and not boosting.EarlyStopping(rounds=0).applies("gbt") and not boosting.EarlyStopping().applies("rf")


def test_a_cut_model_is_the_model_of_fewer_rounds(frame):
    whole = train.make_estimator("gbt", {"maxIter": 8, "maxDepth": 2}).fit(frame)
    short, few = boosting.cut(whole, 3), train.make_estimator("gbt", {"maxIter": 3, "maxDepth": 2}).fit(frame)
    at = lambda m: [r["probability"].toArray().tolist() for r in m.transform(frame).orderBy("id").collect()]
    assert short.getNumTrees == 3 and np.allclose(at(short), at(few)) and short.numFeatures == 3
    with pytest.raises(ValueError):
        boosting.cut(whole, 9)


def test_early_stopping_keeps_the_best_round_of_each_fold(frame):
    stopped = {}
    _, _, models = train.cross_validate(frame, "gbt", {"maxIter": 10, "maxDepth": 4}, 3, early_stopping=boosting.EarlyStopping(rounds=2), stopped=stopped)
    for f, s in stopped.items():
        assert models[f].getNumTrees == s.kept == s.best and s.losses[s.best - 1] == min(s.losses) and (s.stop == 10 or s.stop - s.best == 2)
    last = {}
    _, _, models = train.cross_validate(frame, "gbt", {"maxIter": 10, "maxDepth": 4}, 3, early_stopping=boosting.EarlyStopping(rounds=2, use_best_model=False), stopped=last)
    assert {f: m.getNumTrees for f, m in enumerate(models)} == {f: s.stop for f, s in stopped.items()}
    none = {}
    train.cross_validate(frame, "tree", {"maxDepth": 2}, 3, early_stopping=boosting.EarlyStopping(families=("gbt",)), stopped=none)
    assert none == {}


def test_saved_runs_predict_as_their_models_do(spark, frame):
    registry = saved_runs.RunRegistry(spark, scratch_path(spark, "registry"))
    raw = frame.withColumn("a", F.col("id") * 0.5).withColumn("c", F.when(F.col("id") % 4 > 0, F.concat(F.lit("k"), (F.col("id") % 3).cast("string"))))
    pipe = pipeline.FoldPipeline(["a"], ["c"], text_mode="old").fit(raw, 3)
    models = {"one": ("tree", train.make_estimator("tree", {"maxDepth": 3}).fit(frame), None, 0.5),
              "two": ("svm", train.make_estimator("svm", {"maxIter": 5}).fit(frame), None, 0.9),
              "three": ("rf", pipeline.fit_all(raw, pipe, "rf", {"numTrees": 4, "maxDepth": 3}, label="label"), pipe, 0.9)}
    for run, (family, model, preparation, score) in models.items():
        registry.save(saved_runs.SavedRun(run, family, model, preparation, score))
    registry.save(saved_runs.SavedRun("one", "tree", models["one"][1]))  # again: nothing changes
    assert registry.runs() == ["one", "two", "three"] and registry.best().run == "two"
    got = {(r["run"], r["id"]): (r["pred"], r["p1"]) for r in saved_runs.predict_all(raw, registry.load()).collect()}
    for run, (family, model, preparation, _) in models.items():
        x = preparation.features(raw, pipeline.ALL_ROWS, ["id"]) if preparation else frame
        for r in train.predict(model, x).collect():
            pred, p1 = got[run, r["id"]]
            assert pred == r["pred"] and (p1 == pytest.approx(r["p1"]) if "p1" in r else p1 is None)
    assert len(got) == 3 * 240 and len({r["run"] for r in saved_runs.predict_all(raw, registry.load(["three"])).collect()}) == 1
    with pytest.raises(ValueError):
        registry.load(["four"])


def test_a_search_scores_all_models_in_one_scan(frame):
    grid = [{"maxDepth": d} for d in (1, 2, 3, 4)]
    scores, best = train.search(frame, "tree", grid, 3)
    by = {r["candidate"]: r for r in scores.collect()}
    assert len(by) == 4
    for c, params in enumerate(grid):
        m, _, _ = train.cross_validate(frame, "tree", params, 3)
        from foldwise.operators import metrics

        one = select.selection_scores(metrics.metrics_long(m, ["fold", "split"]).withColumn("candidate", F.lit(c)), "f1", ["mean_minus_std_minus_gap"], 1.0).first()
        name = "score_mean_minus_std_minus_gap"
        assert by[c][name] == pytest.approx(one[name])
    models = train._fit_all(frame, "tree", grid, 3, "fold", "id", "label", None, None, 42, 4, False, None)
    counts = train.confusion_of(frame, models)
    assert counts.where("split = 'validation'").agg(F.sum("n")).first()[0] == 4 * 240 and counts.where("split = 'train'").agg(F.sum("n")).first()[0] == 4 * 480


def test_random_trials_are_distinct():
    space = {"a": [1, 2, 3], "b": ["x", "y"]}
    found = train.random_candidates(space, 6, 1)
    assert len({tuple(sorted(c.items())) for c in found}) == 6 and train.random_candidates(space, 4, 1) == train.random_candidates(space, 4, 1)
    with pytest.raises(ValueError):
        train.random_candidates(space, 7)


def test_importances_carry_the_names_of_the_roles(spark):
    rows = [(i, i % 2, i % 3, float(i % 2) + (i % 7) / 50, float(i % 5), float(i % 3), "xy"[i % 2]) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, label int, fold int, a double, t double, o double, c string")
    pipe = pipeline.FoldPipeline(["a"], ["c"], longtail=["t"], ordinal=["o"])
    m, models = pipeline.cross_validate(df, pipe, "rf", {"numTrees": 5, "maxDepth": 3}, 3, label="label")
    found = pipeline.importances(df, pipe, models).collect()
    assert {r["feature"] for r in found} == {"num__a", "log__t", "ord__o", "cat__c_x", "cat__c_y"} and len(found) == 15
    share = {}
    for r in found:
        share[r["feature"].split("__")[0]] = share.get(r["feature"].split("__")[0], 0) + r["importance"]
    assert share["num"] + share["cat"] > share["log"] + share["ord"]
    assert all(r["f1"] == 1.0 for r in m.collect())
