"""Queries over folds, weights, metrics, selection, voting and importances (E4 E5 J4 J11–J18
J23 J24 J26 C5 E6 F2–F4 D22 D24 D27), and over model training (J1 J2 J5–J8 J10 J19–J22 J25 J27)."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.operators import ensemble, fitting, folds, importance, metrics, select, weights
from foldwise.plans.registry import query
from foldwise.plans.views_sql import with_views
from foldwise.sources import tables

K = 5
SEED = 42


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# -- E4 E5 -----------------------------------------------------------------------------------------

@query("stratified_folds", with_views(folds.fold_sql("id", "label", K, SEED, "t").replace("SELECT *,", "SELECT id, label,"), "t"))
def stratified_folds(spark, d):
    t = tables.labelled_text(spark, d).select("id", "label")
    return folds.stratified_folds(t, "id", "label", K, SEED).select("id", "label", "fold")


@query("fold_balance", with_views(
    f"WITH f AS ({folds.fold_sql('id', 'label', K, SEED, 't')})\n"
    "SELECT fold, label, count(*) AS n FROM f GROUP BY fold, label", "t"))
def fold_balance(spark, d):
    f = stratified_folds(spark, d)
    return f.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n"))


@query("holdout_split", with_views(f"SELECT id, label, {folds.holdout_sql('id')} AS is_holdout FROM t", "t"))
def holdout_split(spark, d):
    t = tables.labelled_text(spark, d).select("id", "label")
    return t.select("id", "label", folds.holdout_flag("id").alias("is_holdout"))


# -- J4 ---------------------------------------------------------------------------------------------

@query("class_weights", """
WITH c AS (SELECT quality AS label, count(*) AS n FROM labels WHERE quality IS NOT NULL GROUP BY 1)
SELECT label, n, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n), 6) AS weight FROM c""")
def class_weights(spark, d):
    lab = tables.load(spark, d, "labels", ["quality"])
    w = weights.class_weights(lab, "quality", "balanced")
    return w.select("label", "n", r6("weight").alias("weight"))


@query("class_weights_applied", """
WITH c AS (SELECT quality AS label, count(*) AS n FROM labels WHERE quality IS NOT NULL GROUP BY 1),
w AS (SELECT label, (SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n) AS weight FROM c)
SELECT l.doc_id, l.quality, round(w.weight, 6) AS weight FROM labels l JOIN w ON l.quality = w.label""")
def class_weights_applied(spark, d):
    lab = tables.load(spark, d, "labels", ["doc_id", "quality"])
    x = weights.with_weights(lab, "quality", weights.class_weights(lab, "quality", "balanced"))
    return x.select("doc_id", "quality", r6("weight").alias("weight"))


# -- J11 J12 J13 J14 J15 D22 on the rule-based predictor --------------------------------------------

def _rp_folds(spark, d):
    rp = tables.rule_predictions(spark, d)
    return folds.stratified_folds(rp, "id", "label", K, SEED)


_RPF = f"f AS ({folds.fold_sql('id', 'label', K, SEED, 'rp')}),\nks AS (SELECT CAST(range AS INTEGER) AS k FROM range({K}))"
_CNT = ("count(*) FILTER (WHERE label = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE label <> 1 AND pred = 1) AS fp, "
        "count(*) FILTER (WHERE label = 1 AND pred <> 1) AS fn, count(*) FILTER (WHERE label <> 1 AND pred <> 1) AS tn")
_MET = ("round(CASE WHEN tp + fp + fn + tn > 0 THEN (tp + tn) / (tp + fp + fn + tn) ELSE 0 END, 6) AS accuracy, "
        "round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision, "
        "round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall, "
        "round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1")
_BY_FOLD_SQL = (f"WITH {_RPF},\n"
                f"v AS (SELECT fold, 'validation' AS split, {_CNT} FROM f GROUP BY fold),\n"
                f"t AS (SELECT ks.k AS fold, 'train' AS split, {_CNT} FROM f JOIN ks ON f.fold <> ks.k GROUP BY ks.k),\n"
                "u AS (SELECT * FROM v UNION ALL SELECT * FROM t),\n"
                f"m AS (SELECT fold, split, tp, fp, fn, tn, {_MET} FROM u)\n")


def _metrics_by_fold(spark, d):
    f = _rp_folds(spark, d)
    val = metrics.confusion_counts(f, "label", "pred", ["fold"])
    train = fitting.to_training_folds(val, K, "fold").groupBy("fold").agg(
        *[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")])
    both = val.withColumn("split", F.lit("validation")).unionByName(train.withColumn("split", F.lit("train")))
    m = metrics.binary_metrics(both, ["fold", "split"])
    return m.select(F.col("fold").cast("int").alias("fold"), "split", "tp", "fp", "fn", "tn",
                    *[r6(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@query("metrics_by_fold", with_views(_BY_FOLD_SQL + "SELECT * FROM m", "rp"))
def metrics_by_fold(spark, d):
    return _metrics_by_fold(spark, d)


@query("metrics_summary", with_views(
    _BY_FOLD_SQL + ", l AS (UNPIVOT m ON accuracy, f1, precision, recall INTO NAME metric VALUE value)\n"
    "SELECT split, metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, count(*) AS n_folds "
    "FROM l GROUP BY split, metric", "rp").replace("FROM u)\n, l AS", "FROM u),\nl AS"))
def metrics_summary(spark, d):
    m = _metrics_by_fold(spark, d)
    s = metrics.fold_summary(metrics.metrics_long(m, ["fold", "split"]), ["split"])
    return s.select("split", "metric", r6("mean").alias("mean"), r6("std").alias("std"), "n_folds")


_PC_SQL = ("pc AS (SELECT fold, cls, sum(is_true) AS support, count(*) FILTER (WHERE is_true = 0) AS n_pred, "
           "sum(CASE WHEN is_true = 1 THEN hit ELSE 0 END) AS tp FROM ("
           "SELECT fold, label AS cls, 1 AS is_true, CAST(label = pred AS INTEGER) AS hit FROM f "
           "UNION ALL SELECT fold, pred AS cls, 0 AS is_true, CAST(label = pred AS INTEGER) AS hit FROM f) GROUP BY fold, cls),\n"
           "m0 AS (SELECT fold, cls, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0 END AS p, "
           "CASE WHEN support > 0 THEN tp / support ELSE 0 END AS r, support FROM pc),\n"
           "m2 AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM m0)\n")


@query("weighted_f1", with_views(f"WITH {_RPF},\n{_PC_SQL}"
                                 "SELECT fold, round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM m2 GROUP BY fold", "rp"))
def weighted_f1(spark, d):
    w = metrics.weighted_f1(_rp_folds(spark, d), "label", "pred", ["fold"])
    return w.select(F.col("fold").cast("int").alias("fold"), r6("weighted_f1").alias("weighted_f1"))


@query("class_report", with_views(
    "WITH f AS (SELECT 0 AS fold, label, pred FROM rp),\n" + _PC_SQL.replace("m2 AS", "m2 AS") +
    ", rep AS (SELECT CAST(cls AS VARCHAR) AS class, p AS precision, r AS recall, f1, CAST(support AS BIGINT) AS support FROM m2 "
    "UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f1), CAST(sum(support) AS BIGINT) FROM m2 "
    "UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support), "
    "sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM m2)\n"
    "SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rep",
    "rp").replace("FROM m2)\n, rep AS", "FROM m2),\nrep AS"))
def class_report(spark, d):
    r = metrics.class_report(tables.rule_predictions(spark, d), "label", "pred")
    return r.select("class", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], F.col("support").cast("long").alias("support"))


@query("confusion", with_views("SELECT label, pred, count(*) AS n FROM rp GROUP BY label, pred", "rp"))
def confusion(spark, d):
    return metrics.confusion_matrix(tables.rule_predictions(spark, d), "label", "pred")


_PR_SQL = ("WITH per AS (SELECT score AS threshold, count(*) FILTER (WHERE label = 1) AS pos, "
           "count(*) FILTER (WHERE label <> 1) AS neg FROM rp GROUP BY score),\n"
           "tot AS (SELECT count(*) FILTER (WHERE label = 1) AS np FROM rp),\n"
           "c AS (SELECT threshold, pos, sum(pos) OVER (ORDER BY threshold DESC) AS tp, "
           "sum(neg) OVER (ORDER BY threshold DESC) AS fp FROM per),\n"
           "pr AS (SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, tp / (tp + fp) AS precision, "
           "CASE WHEN np > 0 THEN tp / np ELSE 0 END AS recall, CASE WHEN np > 0 THEN pos / np ELSE 0 END AS recall_step FROM c, tot)\n")


@query("pr_curve", with_views(_PR_SQL + "SELECT threshold, tp, fp, round(precision, 6) AS precision, round(recall, 6) AS recall "
                              "FROM pr", "rp"))
def pr_curve(spark, d):
    c = metrics.pr_curve(tables.rule_predictions(spark, d), "label", "score")
    return c.select("threshold", "tp", "fp", r6("precision").alias("precision"), r6("recall").alias("recall"))


@query("average_precision", with_views(_PR_SQL + "SELECT round(sum(recall_step * precision), 6) AS average_precision FROM pr", "rp"))
def average_precision(spark, d):
    ap = metrics.average_precision(metrics.pr_curve(tables.rule_predictions(spark, d), "label", "score"))
    return ap.select(r6("average_precision").alias("average_precision"))


# -- J16 J18 F2 F3 on the metric rows M ---------------------------------------------------------------

GRID = {"max_depth": [3, 5, 7], "learning_rate": [0.05, 0.1], "n_estimators": [100, 200]}


def _grid_sql():
    rows = select.param_grid(GRID)
    vals = ", ".join(f"({i}, '{r['max_depth']}', '{r['learning_rate']}', '{r['n_estimators']}')" for i, r in enumerate(rows))
    return f"g AS (SELECT * FROM (VALUES {vals}) AS g(candidate, max_depth, learning_rate, n_estimators))"


@query("param_grid", with_views(
    f"WITH {_grid_sql()},\ns AS (SELECT candidate, avg(value) AS mean_f1 FROM m WHERE split = 'validation' GROUP BY candidate)\n"
    "SELECT CAST(g.candidate AS BIGINT) AS candidate, max_depth, learning_rate, n_estimators, round(s.mean_f1, 6) AS mean_f1 "
    "FROM g LEFT JOIN s ON g.candidate = s.candidate", "m"))
def param_grid(spark, d):
    g = select.grid_frame(spark, GRID)  # 12 rows, size known from the parameter
    s = tables.cv_metrics(spark, d).where(F.col("split") == "validation").groupBy("candidate").agg(
        F.avg("value").alias("mean_f1"))
    return F.broadcast(g).join(s, "candidate", "left").select(
        "candidate", "max_depth", "learning_rate", "n_estimators", r6("mean_f1").alias("mean_f1"))


_SEL_SQL = ("s AS (SELECT candidate, avg(value) FILTER (WHERE split = 'validation') AS mean, "
            "stddev_pop(value) FILTER (WHERE split = 'validation') AS std, avg(value) FILTER (WHERE split = 'train') AS train_mean "
            "FROM m WHERE metric = 'f1' GROUP BY candidate),\n"
            "s2 AS (SELECT *, coalesce(greatest(0.0, train_mean - mean), 0.0) AS gap FROM s),\n"
            "s3 AS (SELECT *, mean AS score_mean, mean - std AS score_mean_minus_std, mean - 0.5 * std AS score_mean_minus_half_std, "
            "mean - std - 1.0 * gap AS score_mean_minus_std_minus_gap, mean - 0.5 * std - 1.0 * gap AS score_mean_minus_half_std_minus_gap FROM s2)\n")


@query("selection_score", with_views("WITH " + _SEL_SQL + "SELECT candidate, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in ["mean", "std", "train_mean", "gap"] + [f"score_{m}" for m in select.MODES]) + " FROM s3", "m"))
def selection_score(spark, d):
    s = select.selection_scores(tables.cv_metrics(spark, d))
    return s.select("candidate", *[r6(c).alias(c) for c in s.columns if c != "candidate"])


@query("best_candidate", with_views("WITH " + _SEL_SQL + ", l AS (UNPIVOT s3 ON " + ", ".join(
    f"score_{m}" for m in select.MODES) + " INTO NAME mode VALUE score),\n"
    "r AS (SELECT *, row_number() OVER (PARTITION BY mode ORDER BY score DESC, candidate ASC) AS rn FROM l)\n"
    "SELECT replace(mode, 'score_', '') AS mode, candidate, round(score, 6) AS score FROM r WHERE rn = 1", "m")
    .replace("FROM s2)\n, l AS", "FROM s2),\nl AS"))
def best_candidate(spark, d):
    s = select.selection_scores(tables.cv_metrics(spark, d))
    long = s.unpivot(["candidate"], [f"score_{m}" for m in select.MODES], "mode", "score")
    b = select.best_by(long, "score", "candidate", ["mode"])
    return b.select(F.regexp_replace("mode", "^score_", "").alias("mode"), "candidate", r6("score").alias("score"))


def _family(c):
    return F.when(c % 4 == 0, "RF").when(c % 4 == 1, "GBT").when(c % 4 == 2, "SVM").otherwise("DT")


@query("best_model", with_views(
    "WITH f AS (SELECT CASE candidate % 4 WHEN 0 THEN 'RF' WHEN 1 THEN 'GBT' WHEN 2 THEN 'SVM' ELSE 'DT' END AS model, "
    "avg(value) AS score FROM m WHERE split = 'validation' GROUP BY 1)\n"
    "SELECT model, round(score, 6) AS score FROM f ORDER BY score DESC, model ASC LIMIT 1", "m"))
def best_model(spark, d):
    m = tables.cv_metrics(spark, d).where(F.col("split") == "validation")
    f = m.groupBy(_family(F.col("candidate")).alias("model")).agg(F.avg("value").alias("score"))
    return select.leaderboard(f, "score", ["model", "score"], 1, tie="model").select("model", r6("score").alias("score"))


# -- J23 J24 C5 E6 F4 D27 on per-fold importances I -----------------------------------------------

_NORM_SQL = ("n AS (SELECT fold, feature, CASE WHEN sum(importance) OVER (PARTITION BY fold) > 0 "
             "THEN importance / sum(importance) OVER (PARTITION BY fold) ELSE 0.0 END AS importance_norm FROM i),\n"
             f"cm AS (SELECT feature, sum(importance_norm) / {K} AS cv_mean_importance_norm, count(*) AS n_folds_present "
             "FROM n GROUP BY feature)\n")


def _imp_mean(spark, d):
    return importance.cv_mean(importance.normalize(tables.fold_importance(spark, d)), K)


@query("importance_norm_mean", with_views("WITH " + _NORM_SQL + "SELECT feature, round(cv_mean_importance_norm, 6) AS "
                                          "cv_mean_importance_norm, n_folds_present FROM cm", "i"))
def importance_norm_mean(spark, d):
    return _imp_mean(spark, d).select("feature", r6("cv_mean_importance_norm").alias("cv_mean_importance_norm"),
                                      "n_folds_present")


@query("importance_rank", with_views(
    "WITH " + _NORM_SQL.split("cm AS")[0].rstrip().rstrip(",") +
    ",\nr AS (SELECT *, rank() OVER (PARTITION BY fold ORDER BY importance_norm DESC) AS rank FROM n)\n"
    "SELECT feature, count(*) FILTER (WHERE rank = 1) AS n_first, "
    "round(sum(CASE WHEN rank <= 4 THEN importance_norm ELSE 0.0 END), 6) AS top_share_sum FROM r GROUP BY feature", "i"))
def importance_rank(spark, d):
    r = importance.rank_within(importance.normalize(tables.fold_importance(spark, d)))
    fp = importance.first_places(r, 4)
    return fp.select("feature", "n_first", r6("top_share_sum").alias("top_share_sum"))


@query("importance_top10", with_views("WITH " + _NORM_SQL + "SELECT feature, round(cv_mean_importance_norm, 6) AS "
                                      "cv_mean_importance_norm FROM cm ORDER BY cv_mean_importance_norm DESC, feature ASC LIMIT 10", "i"))
def importance_top10(spark, d):
    m = _imp_mean(spark, d)
    return select.leaderboard(m, "cv_mean_importance_norm", ["feature", "cv_mean_importance_norm"], 10, tie="feature") \
        .select("feature", r6("cv_mean_importance_norm").alias("cv_mean_importance_norm"))


@query("family_share", with_views("WITH " + _NORM_SQL + "SELECT split_part(feature, '__', 1) AS family, "
                                  "round(sum(cv_mean_importance_norm), 6) AS share FROM cm GROUP BY 1", "i"))
def family_share(spark, d):
    s = importance.family_share(_imp_mean(spark, d))
    return s.select("family", r6("share").alias("share"))


# -- J26 D24 majority vote over 4 rule-based fold models on P -----------------------------------------

VOTE_MODELS = 4


def _vote_preds(spark, d):
    p = tables.profile(spark, d).select("id", "num_c")
    preds = [F.when(F.col("num_c") > 80 + 10 * k, 1).otherwise(0).alias(f"pred_{k}") for k in range(VOTE_MODELS)]
    return p.select("id", *preds)


_VOTE_SQL = ("l AS (" + " UNION ALL ".join(
    f"SELECT id, CASE WHEN num_c > {80 + 10 * k} THEN 1 ELSE 0 END AS pred FROM p" for k in range(VOTE_MODELS)) + "),\n"
    "c AS (SELECT id, pred, count(*) AS n FROM l GROUP BY id, pred),\n"
    "v AS (SELECT id, pred AS vote, n AS votes, sum(n) OVER (PARTITION BY id) AS n_models, "
    "row_number() OVER (PARTITION BY id ORDER BY n DESC, pred ASC) AS rn FROM c)\n")


@query("vote_majority", with_views("WITH " + _VOTE_SQL + "SELECT id, vote, votes, CAST(n_models AS BIGINT) AS n_models FROM v WHERE rn = 1", "p"))
def vote_majority(spark, d):
    long = ensemble.to_long(_vote_preds(spark, d), "id", [f"pred_{k}" for k in range(VOTE_MODELS)])
    return ensemble.majority_vote(long, "id")


@query("prediction_counts", with_views("WITH " + _VOTE_SQL + "SELECT count(*) FILTER (WHERE vote = 0) AS n_0, "
                                       "count(*) FILTER (WHERE vote = 1) AS n_1, count(*) AS total FROM v WHERE rn = 1", "p"))
def prediction_counts(spark, d):
    return ensemble.prediction_counts(vote_majority(spark, d), "vote", [0, 1])


# ---------------------------------------------------------------------------------------------------
# Model training, CV, search and prediction (rows-only checks; properties in tests/)
# ---------------------------------------------------------------------------------------------------

from foldwise.functions import text as tx  # noqa: E402
from foldwise.operators import boosting, saved_runs, train, vectors  # noqa: E402
from foldwise.session import materialize, scratch_path  # noqa: E402
from foldwise.sources import files  # noqa: E402
from pyspark.sql import types as T  # noqa: E402
from foldwise.plans.q_text import KEYWORDS_A, KEYWORDS_B, POSITIVE  # noqa: E402


def _features(df):
    return df.select("*", *tx.handcrafted("text", KEYWORDS_A, KEYWORDS_B, POSITIVE))


#: Rows that a partition of a training table holds, about: fits cost far more than reading, so that 64 MB is too many.
TRAIN_ROWS = 20_000


def train_frame(spark, d):
    """Labelled documents → 15 text features, vector, stratified fold; materialised once, so that the fold
    assignment and all fits read a table."""
    t = materialize(vectors.assemble(_features(tables.labelled_text(spark, d)), tx.FEATURE_NAMES).select("id", "label", "features"))
    frame = folds.stratified_folds(t, "id", "label", K, SEED).select("id", "label", "fold", "features")
    parts = -(-t.count() // TRAIN_ROWS)
    return materialize(frame.repartition(parts) if parts > 1 else frame)


def weighted(tf):
    """All labelled rows with balanced class weights, for a refit without folds."""
    return weights.with_weights(tf, "label", weights.class_weights(tf, "label", "balanced"))


def unlabelled_frame(spark, d):
    docs = tables.load(spark, d, "documents", ["doc_id", "text"])
    lab = tables.load(spark, d, "labels", ["doc_id"])
    u = _features(docs.join(lab, "doc_id", "left_anti").withColumnRenamed("doc_id", "id")).drop("text")
    return vectors.assemble(u, tx.FEATURE_NAMES).select("id", "features")


MODEL_PARAMS = {"rf": {"numTrees": 20, "maxDepth": 5}, "gbt": {"maxIter": 20, "maxDepth": 3},
                "tree": {"maxDepth": 5}, "svm": {"maxIter": 20, "regParam": 0.01}}


def _cv(kind, early=None):
    def fn(spark, d):
        m, _, _ = train.cross_validate(train_frame(spark, d), kind, MODEL_PARAMS[kind], K, class_weight="balanced",
                                       early_stopping=early, feature_names=tx.FEATURE_NAMES)
        return m
    return fn


query("train_rf")(_cv("rf"))
query("train_gbt")(_cv("gbt", early=0.2))
query("train_tree")(_cv("tree"))
query("train_svm")(_cv("svm"))


@query("train_rf_smote")
def train_rf_smote(spark, d):
    """J1 + J2: CV where each training fold is over-sampled with SMOTE (no class weights)."""
    m, _, _ = train.cross_validate(train_frame(spark, d), "rf", MODEL_PARAMS["rf"], K, oversample=True,
                                   feature_names=tx.FEATURE_NAMES)
    return m


@query("cv_report")
def cv_report(spark, d):
    """D22 over a real CV: mean and population std of each metric over folds, per split."""
    m, _, _ = train.cross_validate(train_frame(spark, d), "rf", MODEL_PARAMS["rf"], K, class_weight="balanced",
                                   feature_names=tx.FEATURE_NAMES)
    return metrics.fold_summary(metrics.metrics_long(m, ["fold", "split"]), ["split"])


@query("cv_importance")
def cv_importance(spark, d):
    """J22 → J23 → J24: per-fold importances of a CV, normalised, averaged with missing = 0."""
    _, imp, _ = train.cross_validate(train_frame(spark, d), "rf", MODEL_PARAMS["rf"], K, class_weight="balanced",
                                     feature_names=tx.FEATURE_NAMES)
    return importance.cv_mean(importance.normalize(imp), K).orderBy(F.desc("cv_mean_importance_norm"))


SEARCH_GRID = {"numTrees": [10, 20], "maxDepth": [3, 5]}
#: Different trials per family; a trial is a five-fold cross-validation.
TRIALS = 50
SEARCH_SPACES = {"tree": {"maxDepth": [2, 3, 4, 5, 6], "minInstancesPerNode": [1, 2, 5, 10], "impurity": ["gini", "entropy"], "maxBins": [16, 32]},
                 "svm": {"maxIter": [5, 10, 20], "regParam": [0.001, 0.003, 0.01, 0.03, 0.1, 1.0], "standardization": [True, False], "fitIntercept": [True, False]}}


@query("grid_search")
def grid_search(spark, d):
    scores, best = train.search(train_frame(spark, d), "rf", select.param_grid(SEARCH_GRID), K, class_weight="balanced")
    return scores.join(best.select("candidate", F.lit(True).alias("is_best")), "candidate", "left") \
        .withColumn("is_best", F.coalesce("is_best", F.lit(False)))


@query("random_search")
def random_search(spark, d):
    """Seeded random trials of two families, scored by weighted F1 over the same folds; the best of
    all trials is marked."""
    frame, out = train_frame(spark, d), None
    for family, space in SEARCH_SPACES.items():
        scores, _ = train.search(frame, family, train.random_candidates(space, TRIALS, SEED), K, metric="weighted_f1",
                                 class_weight="balanced")
        scores = scores.withColumn("family", F.lit(family)).withColumn("trial", F.format_string("%s_%03d", F.lit(family), F.col("candidate")))
        out = scores if out is None else out.unionByName(scores)
    out = materialize(out)
    score = next(c for c in out.columns if c.startswith("score_"))
    best = select.best_by(out, score, "trial").first()["trial"]
    return out.withColumn("is_best", F.col("trial") == F.lit(best))


@query("predict_full")
def predict_full(spark, d):
    """J21 refit on every labelled row, J25 predict the unlabelled documents, B6 back-map."""
    model = train.make_estimator("rf", MODEL_PARAMS["rf"], weight="weight").fit(weighted(train_frame(spark, d)))
    p = train.predict(model, unlabelled_frame(spark, d))
    from foldwise.operators import clean
    return p.withColumn("pred_raw", clean.backmap_labels("pred", {1: 1, 0: 2}))


@query("predict_fold")
def predict_fold(spark, d):
    """The k fold models of a CV (saved and reloaded, A12) vote on the unlabelled documents."""
    _, _, models = train.cross_validate(train_frame(spark, d), "tree", MODEL_PARAMS["tree"], K, class_weight="balanced")
    path = scratch_path(spark, "fold-models")
    train.save_fold_models(models, path)  # A12: per-fold models saved and loaded back
    return train.predict_vote(train.load_fold_models(path, K, "tree"), unlabelled_frame(spark, d))


@query("predict_all_runs")
def predict_all_runs(spark, d):
    """Three runs saved in a registry, loaded from storage, and all applied in one scan of the unlabelled documents."""
    tf, registry = weighted(train_frame(spark, d)), saved_runs.RunRegistry(spark, scratch_path(spark, "registry"))
    for kind in ("rf", "tree", "gbt"):
        registry.save(saved_runs.SavedRun(f"run_{kind}", kind, train.make_estimator(kind, MODEL_PARAMS[kind], weight="weight").fit(tf)))
    return saved_runs.predict_all(unlabelled_frame(spark, d), registry.load())


@query("early_stopping_rounds")
def early_stopping_rounds(spark, d):
    """The loss on the stop set after each round of every fold's boosted trees, where training stopped, the best round,
    and whether the cut model's own loss is that of its round."""
    frame, stopped = train_frame(spark, d), {}
    stopping = boosting.EarlyStopping(rounds=3, share=0.2)
    _, _, models = train.cross_validate(frame, "gbt", {"maxIter": 15, "maxDepth": 3}, K, early_stopping=stopping, stopped=stopped)
    rows = []
    for f, s in stopped.items():
        stop_set = frame.where((F.col("fold") != f) & folds.holdout_flag("id", stopping.share, SEED + 1))
        again = models[f].evaluateEachIteration(stop_set)
        agrees = len(again) == s.kept and abs(again[-1] - s.losses[s.kept - 1]) < 1e-9
        rows += [(f, i, loss, s.stop, s.best, s.kept, agrees) for i, loss in enumerate(s.losses, 1)]
    return spark.createDataFrame(rows, "fold int, round int, loss double, stop_round int, best_round int, kept_rounds int, agrees boolean")


@query("search_record", with_views(
    "WITH " + _SEL_SQL.rstrip() + ",\n" + _NORM_SQL.rstrip() + f",\n{_grid_sql()},\n"
    "b AS (SELECT * FROM s3 ORDER BY score_mean_minus_std_minus_gap DESC, candidate LIMIT 1)\n"
    "SELECT 'f1' AS search_metric, 'mean_minus_std_minus_gap' AS selection_mode, round(score_mean_minus_std_minus_gap, 6) AS best_selection_score, "
    "round(b.mean, 6) AS best_metric_mean, round(b.std, 6) AS best_metric_std, round(train_mean, 6) AS best_train_metric_mean, round(gap, 6) AS best_overfit_gap, "
    "max_depth, learning_rate, n_estimators, round(b.mean, 6) AS cv_f1_score, (SELECT count(*) FROM cm) AS n_features, "
    "(SELECT feature FROM cm ORDER BY cv_mean_importance_norm DESC, feature LIMIT 1) AS top_feature, "
    "CAST((SELECT count(*) FROM m WHERE candidate = b.candidate AND split = 'validation') AS INTEGER) AS n_folds, "
    "round((SELECT avg(value) FROM m WHERE candidate = b.candidate AND split = 'train'), 6) AS train_f1 FROM b JOIN g ON g.candidate = b.candidate", "m", "i"))
def search_record(spark, d):
    """The nested record of a search (best parameters, validation and training metrics, importances, model metadata),
    written as JSON and read back."""
    record = files.search_record(tables.cv_metrics(spark, d), select.grid_frame(spark, GRID), _imp_mean(spark, d), "random_forest")
    path = scratch_path(spark, "search-record")
    files.write_results_json(record, path)
    r = files.read_results_json(spark, path, T._parse_datatype_string(files.SEARCH_FIELDS))
    p = lambda c: F.col("best_params")[c].alias(c)
    return r.select("search_metric", "selection_mode", *[r6(c).alias(c) for c in ("best_selection_score", "best_metric_mean", "best_metric_std", "best_train_metric_mean", "best_overfit_gap")],
                    p("max_depth"), p("learning_rate"), p("n_estimators"), r6("metadata.cv_f1_score").alias("cv_f1_score"), F.col("metadata.n_features").alias("n_features"),
                    F.col("feature_importance")[0]["feature"].alias("top_feature"), F.size(F.col("cv_results")["f1"]["folds"]).alias("n_folds"),
                    r6(F.col("train_results")["f1"]["mean"]).alias("train_f1"))


@query("train_baseline")
def train_baseline(spark, d):
    """A quick boosted baseline whose positive class weighs three times as much, cross-validated without a search."""
    m, _, _ = train.cross_validate(train_frame(spark, d), "gbt", {"maxIter": 10, "maxDepth": 3, "stepSize": 0.1}, K, class_weight={0: 1.0, 1: 3.0})
    return metrics.fold_summary(metrics.metrics_long(m, ["fold", "split"]), ["split"])


# -- J2 SMOTE on the stored embeddings (class = label) ---------------------------------------------

from foldwise.operators import resample  # noqa: E402

SMOTE_K = 5


@query("smote_neighbours", f"""
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (SELECT a.label, a.vec_id AS id, b.vec_id AS neighbour_id,
        sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])))) AS d
      FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, neighbour_id) AS rank FROM p)
SELECT label, id, CAST(rank AS INTEGER) AS rank, neighbour_id, round(d, 6) AS distance FROM r WHERE rank <= {SMOTE_K}""")
def smote_neighbours(spark, d):
    """Exact k nearest neighbours inside each class, block against block."""
    e = tables.load(spark, d, "embeddings", ["vec_id", "label", "embedding"]).withColumnRenamed("vec_id", "id")
    nb = resample.knn_within_class(e, "id", "embedding", "label", SMOTE_K)
    return nb.select("label", "id", F.col("rank").cast("int").alias("rank"), "neighbour_id",
                     F.round("distance", 6).alias("distance"))


_SMOTE_ROWS_SQL = f"""
WITH e AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
cnt AS (SELECT label, count(*) AS n FROM e GROUP BY label),
mino AS (SELECT label, n AS m FROM cnt ORDER BY n ASC, label ASC LIMIT 1),
nn AS (SELECT (SELECT max(n) FROM cnt) - m AS n_new, m, least({SMOTE_K}, m - 1) AS k FROM mino),
me AS (SELECT e.* FROM e JOIN mino ON e.label = mino.label),
pairs AS (SELECT a.id, b.id AS nid,
            sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])))) AS d
          FROM me a JOIN me b ON a.id <> b.id),
nb AS (SELECT id, nid, row_number() OVER (PARTITION BY id ORDER BY d, nid) AS rank FROM pairs),
ord AS (SELECT id, v, row_number() OVER (ORDER BY CAST(('0x' || substr(md5(concat(CAST(id AS VARCHAR), ':{SEED}')), 1, 12))::BIGINT AS DOUBLE), id) AS r FROM me),
cp AS (SELECT id, v, n_new // m + CASE WHEN r <= n_new % m THEN 1 ELSE 0 END AS copies, k FROM ord, nn),
rw AS (SELECT id, v, k, unnest(range(copies)) AS j FROM cp WHERE copies > 0),
u AS (SELECT id, v, CAST(j AS INTEGER) AS j,
        CAST(floor(CAST(('0x' || substr(md5(concat_ws(':', CAST(id AS VARCHAR), CAST(j AS VARCHAR), '{SEED}', 'n')), 1, 8))::BIGINT AS DOUBLE) / 4294967296.0 * k) + 1 AS BIGINT) AS rank,
        CAST(('0x' || substr(md5(concat_ws(':', CAST(id AS VARCHAR), CAST(j AS VARCHAR), '{SEED}', 'g')), 1, 8))::BIGINT AS DOUBLE) / 4294967296.0 AS gap
      FROM rw),
jn AS (SELECT u.id AS base_id, u.j, nb.nid AS neighbour_id, u.gap, u.v, n2.v AS nv
       FROM u JOIN nb ON u.id = nb.id AND u.rank = nb.rank JOIN me n2 ON n2.id = nb.nid),
ex AS (SELECT *, unnest(range(1, len(v) + 1)) AS p FROM jn)
SELECT (SELECT label FROM mino) AS label, base_id, j, neighbour_id, round(gap, 6) AS gap, CAST(p - 1 AS INTEGER) AS pos,
  round(v[p] + gap * (nv[p] - v[p]), 6) AS value FROM ex"""


@query("smote_rows", _SMOTE_ROWS_SQL)
def smote_rows(spark, d):
    """Synthetic rows for the smallest class up to the size of the largest one, in long form
    (one row per vector element)."""
    e = tables.load(spark, d, "embeddings", ["vec_id", "label", "embedding"]).withColumnRenamed("vec_id", "id")
    counts = train.class_counts(e, "label")
    minority = min(counts, key=lambda c: (counts[c], c))
    n_new = max(counts.values()) - counts[minority]
    s = resample.smote(e, "id", "embedding", "label", minority, n_new, SMOTE_K, SEED)
    return s.select("label", "base_id", "j", "neighbour_id", F.round("gap", 6).alias("gap"),
                    F.posexplode("vector").alias("pos", "value")).withColumn("value", F.round("value", 6))
