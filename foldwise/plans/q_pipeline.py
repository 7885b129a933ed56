"""Queries over the leak-safe pipeline: the profile (view P) through its fold-fitted steps."""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.sql import functions as F

from foldwise.operators import folds, importance, pipeline
from foldwise.plans.common import CP_SQL, TARGET, cleaned_profile, r6
from foldwise.plans.registry import query
from foldwise.plans.views_sql import with_views
from foldwise.session import materialize, scratch_path

K, SEED = 5, 42
_NUM, _CAT = ["num_a", "num_b", "num_c"], ["cat_a", "cat_b"]


def profile_folds(spark, d, *more):
    x = cleaned_profile(spark, d).select("id", TARGET, *_NUM, *_CAT, *more)
    return materialize(folds.stratified_folds(x, "id", TARGET, K, SEED))


def new_pipeline():
    return pipeline.FoldPipeline(_NUM, _CAT, text_mode="old", ratios=("num_b", "num_a"), flags={"ratio": True, "bmi": True})


def _design_sql() -> str:
    by = lambda f: ", ".join(f.format(c=c) for c in _NUM)
    clip = lambda t: by("CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, {c}_lo), {c}_hi) END AS {c}")
    ratios = ("num_b / CASE WHEN num_a IS NULL OR num_a = 0 THEN 1e-6 ELSE num_a END AS ratio, "
              "num_b / pow(CASE WHEN num_a IS NULL OR num_a / 100 = 0 THEN 1e-6 ELSE num_a / 100 END, 2) AS bmi")
    scaled = [*_NUM, "ratio", "bmi"]
    long = " UNION ALL ".join(f"SELECT id, fold, '{c}' AS feature, ({c} - {c}_mu) / CASE WHEN {c}_sd = 0 THEN 1 ELSE {c}_sd END AS value FROM v JOIN s ON s.tf = v.fold" for c in scaled)
    mode = lambda c: (f"(SELECT tf, {c} AS m_{c} FROM (SELECT tf, {c}, row_number() OVER (PARTITION BY tf ORDER BY count(*) DESC, {c}) AS r "  # noqa: E731
                      f"FROM t WHERE {c} IS NOT NULL GROUP BY tf, {c}) WHERE r = 1)")
    hot = " UNION ALL ".join(
        f"SELECT v.id, v.fold, concat('cat__{c}_', k.c) AS feature, CASE WHEN coalesce(v.{c}, m.m_{c}) = k.c AND EXISTS "
        f"(SELECT 1 FROM t WHERE t.tf = v.fold AND coalesce(t.{c}, m.m_{c}) = k.c) THEN 1.0 ELSE 0.0 END AS value "
        f"FROM f v JOIN {mode(c)} m ON m.tf = v.fold CROSS JOIN (SELECT DISTINCT {c} AS c FROM f WHERE {c} IS NOT NULL) k" for c in _CAT)
    return with_views(
        f"WITH {CP_SQL}, f AS ({folds.fold_sql('id', TARGET, K, SEED, 'cp')}),\n"
        "t AS (SELECT r.i AS tf, f.* FROM f JOIN range(5) AS r(i) ON f.fold <> r.i),\n"
        f"b AS (SELECT tf, {by('quantile_cont({c}, 0.01) AS {c}_lo, quantile_cont({c}, 0.99) AS {c}_hi')} FROM t GROUP BY tf),\n"
        f"tc AS (SELECT t.tf, {clip('t')} FROM t JOIN b ON b.tf = t.tf),\n"
        f"m AS (SELECT tf, {by('quantile_cont({c}, 0.5) AS {c}_md')} FROM tc GROUP BY tf),\n"
        f"ti AS (SELECT tc.tf, {by('coalesce({c}, {c}_md) AS {c}')} FROM tc JOIN m ON m.tf = tc.tf),\n"
        f"td AS (SELECT *, {ratios} FROM ti),\n"
        f"s AS (SELECT tf, {', '.join(f'avg({c}) AS {c}_mu, stddev_pop({c}) AS {c}_sd' for c in scaled)} FROM td GROUP BY tf),\n"
        f"vc AS (SELECT id, fold, {clip('f')} FROM f JOIN b ON b.tf = f.fold),\n"
        f"vi AS (SELECT id, fold, {by('coalesce({c}, {c}_md) AS {c}')} FROM vc JOIN m ON m.tf = vc.fold),\n"
        f"v AS (SELECT *, {ratios} FROM vi)\n"
        f"SELECT id, fold, feature, round(value, 6) AS value FROM ({long} UNION ALL {hot})", "p")


@query("fold_design", _design_sql())
def fold_design(spark, d):
    """Every row as a validation row, prepared by its own fold's params (fitted on the other folds)."""
    x = profile_folds(spark, d)
    out = new_pipeline().fit(x, K).apply(x, F.col("fold"))
    feats = [c for c in out.columns if c not in ("id", TARGET, "fold")]
    long = out.select("id", "fold", *[F.col(f"`{c}`").cast("double").alias(c) for c in feats]).unpivot(["id", "fold"], feats, "feature", "value")
    return long.select("id", F.col("fold").cast("int").alias("fold"), "feature", r6("value").alias("value"))


@query("train_profile")
def train_profile(spark, d):
    """J1 + J4: cross-validation of the profile with preparation and class weights of each fold."""
    m, _ = pipeline.cross_validate(profile_folds(spark, d), new_pipeline(), "tree", {"maxDepth": 4}, K)
    return m


@query("predict_profile")
def predict_profile(spark, d):
    """Preparation and model fitted on all rows, saved together, loaded, and applied."""
    x = profile_folds(spark, d)
    pipe, path = new_pipeline().fit(x, K), scratch_path(spark, "profile-model")
    pipe.save(f"{path}/params")
    pipeline.fit_all(x, pipe, "tree", {"maxDepth": 4}).write().overwrite().save(f"{path}/model")
    again, model = new_pipeline().load(spark, f"{path}/params"), DecisionTreeClassificationModel.load(f"{path}/model")
    return model.transform(again.features(x, pipeline.ALL_ROWS, ["id", TARGET])).select("id", F.col(TARGET).alias("label"), F.col("prediction").cast("int").alias("pred"))


def _importances(spark, d):
    x = profile_folds(spark, d, "long_tail", "ord_a")
    pipe = pipeline.FoldPipeline(_NUM, _CAT, text_mode="old", ratios=("num_b", "num_a"), longtail=["long_tail"], ordinal=["ord_a"])
    _, models = pipeline.cross_validate(x, pipe, "rf", {"numTrees": 10, "maxDepth": 4}, K)
    return importance.cv_mean(importance.normalize(pipeline.importances(x, pipe, models)), K)


@query("profile_importance")
def profile_importance(spark, d):
    """Mean normalised importances of a cross-validation through all roles, under the vector's own names."""
    return _importances(spark, d).orderBy(F.desc("cv_mean_importance_norm"), "feature")


@query("model_family_share")
def model_family_share(spark, d):
    """D27 on fitted models: the share of num, log, ord and cat features in their importances."""
    return importance.family_share(_importances(spark, d))
