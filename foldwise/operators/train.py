"""Training, cross-validation, search and prediction on ``pyspark.ml`` (J1 J5–J8 J10 J19–J22
J25–J27).

Folds are a column (E4), so every fold's training set is a filter of one cached frame. Each
``fit`` is a distributed Spark job; the loop over folds and candidates runs on the driver and
only carries model objects and small metric tables. Predictions of all folds are unioned and
scored in ONE aggregation, so the metric stages do not grow with the number of folds.
"""

from __future__ import annotations

import math
import random
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Mapping, Sequence

from pyspark.ml.classification import (DecisionTreeClassificationModel, DecisionTreeClassifier, GBTClassificationModel,
                                       GBTClassifier, LinearSVC, LinearSVCModel, RandomForestClassificationModel,
                                       RandomForestClassifier)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators import boosting, ensemble, folds, metrics, resample, select, vectors, weights
from foldwise.session import materialize

FAMILIES = ("rf", "gbt", "tree", "svm")


def make_estimator(kind: str, params: Mapping | None = None, label: str = "label", features: str = "features",
                   weight: str | None = None, validation_col: str | None = None, seed: int = 42):
    """J5–J8 model factory. GBT takes ``validation_col`` for early stopping."""
    p = dict(params or {})
    common = {"labelCol": label, "featuresCol": features}
    if weight:
        common["weightCol"] = weight
    kind = kind.lower()
    if kind == "rf":
        return RandomForestClassifier(seed=seed, **common, **p)
    if kind == "gbt":
        if validation_col:
            common["validationIndicatorCol"] = validation_col
        return GBTClassifier(seed=seed, **common, **p)
    if kind == "tree":
        return DecisionTreeClassifier(seed=seed, **common, **p)
    if kind == "svm":
        return LinearSVC(**common, **p)
    raise ValueError(f"unknown model family {kind!r}; one of {FAMILIES}")


def with_predictions(df: DataFrame, models: Sequence) -> DataFrame:
    """``df`` with columns ``_pred0``, ``_pred1``, …: what each model says, from one scan."""
    for i, model in enumerate(models):
        one = model.copy()
        one.setPredictionCol(f"_pred{i}").setRawPredictionCol("")
        if hasattr(one, "setProbabilityCol"):
            one.setProbabilityCol("")
        df = one.transform(df)
    return df


def confusion_of(df: DataFrame, models: Sequence[tuple[int, int, object]], label: str = "label", fold_col: str = "fold") -> DataFrame:
    """(candidate, fold, split, label, pred, n) of ``models``, (candidate, fold, model) each: all of them predict in one
    scan of ``df``, and one aggregate counts the predictions. A row is validation to the models of its own fold and
    training to the others."""
    x = with_predictions(df, [model for _, _, model in models])
    said = [F.struct(F.lit(c).alias("candidate"), F.lit(f).alias("fold"), F.when(F.col(fold_col) == f, "validation").otherwise("train").alias("split"),
                     F.col(f"_pred{i}").cast("int").alias("pred")) for i, (c, f, _) in enumerate(models)]
    rows = x.select(F.col(label).alias("label"), F.explode(F.array(*said)).alias("s")).select("s.candidate", "s.fold", "s.split", "label", "s.pred")
    return materialize(rows.groupBy("candidate", "fold", "split", "label", "pred").agg(F.count(F.lit(1)).alias("n")))


def _with_stop_set(df: DataFrame, id_col: str, share: float, seed: int) -> DataFrame:
    """J10 (S10): the early-stopping set is carved out of the training rows, never the fold
    being scored."""
    return df.withColumn("_is_val", folds.holdout_flag(id_col, share, seed + 1))


def class_counts(df: DataFrame, label: str) -> dict:
    """{class: rows}; one row per class, brought to the driver after a size check."""
    rows = (df.groupBy(F.col(label).alias("c")).agg(F.count(F.lit(1)).alias("n"))
              .limit(weights.MAX_CLASSES + 1).collect())
    if len(rows) > weights.MAX_CLASSES:
        raise ValueError(f"more than {weights.MAX_CLASSES} classes")
    return {r["c"]: r["n"] for r in rows}


def oversample_minority(tr: DataFrame, id_col: str = "id", label: str = "label", features: str = "features",
                        k_neighbors: int = 5, seed: int = 42) -> DataFrame:
    """J2 inside one training set: SMOTE rows for the smallest class up to the largest class.
    Synthetic rows get negative ids (never equal to a real id) and no fold."""
    counts = class_counts(tr, label)
    if len(counts) < 2:
        return tr
    minority = min(counts, key=lambda c: (counts[c], c))
    n_new = max(counts.values()) - counts[minority]
    if n_new == 0 or counts[minority] < 2:
        return tr
    x = tr.withColumn("_arr", vector_to_array(features))
    syn = resample.smote(x, id_col, "_arr", label, minority, n_new, k_neighbors, seed)
    cols = {id_col: (-F.col("number")).cast(tr.schema[id_col].dataType),
            label: F.lit(minority).cast(tr.schema[label].dataType),
            features: array_to_vector("vector")}
    out = syn.select(*[cols[c].alias(c) if c in cols else F.lit(None).cast(tr.schema[c].dataType).alias(c)
                       for c in tr.columns])
    return tr.unionByName(out)


def _training_sets(df: DataFrame, kind: str, k: int, fold_col: str, id_col: str, label: str, weight: str | None,
                   early_stopping: float | boosting.EarlyStopping | None, seed: int, parallelism: int, oversample: bool, class_weight: str | Mapping | None) -> list[tuple[DataFrame, str | None, str | None]]:
    """For each fold its training rows, their weight column and the column of its early-stopping set."""

    def one(f: int):
        tr = df.where(F.col(fold_col) != f)
        if oversample:  # training rows of this fold only; scoring stays on the original rows
            tr = oversample_minority(tr, id_col, label, seed=seed + f)
        wcol = weight
        if class_weight:  # never from the rows that the fold is scored on
            tr, wcol = weights.with_weights(tr, label, weights.class_weights(tr, label, class_weight), "_weight"), "_weight"
        if isinstance(early_stopping, boosting.EarlyStopping):
            share = early_stopping.share if early_stopping.applies(kind) else None
        else:
            share = early_stopping
        if share and kind == "gbt":
            return _with_stop_set(tr, id_col, share, seed), wcol, "_is_val"
        return tr, wcol, None

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, k))) as pool:
        return list(pool.map(one, range(k)))


def _fit_all(df: DataFrame, kind: str, candidates: Sequence[Mapping | None], k: int, fold_col: str, id_col: str, label: str, weight: str | None,
             early_stopping: float | boosting.EarlyStopping | None, seed: int, parallelism: int, oversample: bool, class_weight: str | Mapping | None,
             stopped: dict | None = None) -> list[tuple[int, int, object]]:
    """(candidate, fold, model) of every candidate and fold. A fold's training set is prepared once for all candidates.
    ``stopped`` takes the rounds of models that stop early, by (candidate, fold)."""
    sets = _training_sets(df, kind, k, fold_col, id_col, label, weight, early_stopping, seed, parallelism, oversample, class_weight)

    def fit(at: tuple[int, int]):
        c, f = at
        tr, wcol, vcol = sets[f]
        if vcol and isinstance(early_stopping, boosting.EarlyStopping):
            estimator = make_estimator(kind, candidates[c], label, weight=wcol, seed=seed)
            model, rounds = boosting.fit(estimator, tr.where(~F.col(vcol)), tr.where(vcol), early_stopping)
            if stopped is not None:
                stopped[c, f] = rounds
            return c, f, model
        return c, f, make_estimator(kind, candidates[c], label, weight=wcol, validation_col=vcol, seed=seed).fit(tr)

    # the fits are independent Spark jobs: submit them concurrently (the scheduler shares the
    # executors between them), as CrossValidator does with its ``parallelism``
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(fit, [(c, f) for c in range(len(candidates)) for f in range(k)]))


def cross_validate(df: DataFrame, kind: str, params: Mapping | None, k: int, fold_col: str = "fold",
                   id_col: str = "id", label: str = "label", weight: str | None = None,
                   early_stopping: float | boosting.EarlyStopping | None = None, seed: int = 42, feature_names: Sequence[str] = (),
                   parallelism: int = 4, oversample: bool = False, class_weight: str | Mapping | None = None, stopped: dict | None = None):
    """Fit on fold ≠ f, predict fold f (validation) and its own training rows (train).

    ``oversample`` adds SMOTE rows to each training set (J2); the train-split metrics are still
    computed on the original, un-resampled training rows (S11). ``class_weight`` (J4) fits weights by
    class on each fold's own training rows. ``early_stopping`` (J10): rounds and families by
    :class:`boosting.EarlyStopping`, or the share of the stop set for the library's own rule. Feature names come from the
    vector column unless given.

    Returns (metrics rows (fold, split, tp, fp, fn, tn, accuracy, precision, recall, f1,
    weighted_f1),
    importance rows (fold, feature, importance), fold models).
    """
    rounds: dict = {}
    models = _fit_all(df, kind, [params], k, fold_col, id_col, label, weight, early_stopping, seed, parallelism, oversample, class_weight, rounds)
    if stopped is not None:
        stopped.update({f: r for (_, f), r in rounds.items()})
    m = metrics.metrics_from_confusion(confusion_of(df, models, label, fold_col).drop("candidate"), ["fold", "split"])
    names = list(feature_names) or vectors.names_of(df)
    imp = None
    for _, f, model in models:
        rows = importance_rows(df.sparkSession, model, f, names)
        imp = rows if imp is None else imp.unionByName(rows)
    return m, imp, [model for _, _, model in models]


def importance_rows(spark: SparkSession, model, fold: int, feature_names: Sequence[str]) -> DataFrame:
    """Tree models → featureImportances; linear → |coefficient|. One row per feature."""
    if hasattr(model, "featureImportances"):
        vals = model.featureImportances.toArray()
    elif hasattr(model, "coefficients"):
        vals = [abs(v) for v in model.coefficients.toArray()]
    else:
        vals = []
    names = list(feature_names) or [f"f{i}" for i in range(len(vals))]
    rows = [(fold, names[i], float(v)) for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "fold int, feature string, importance double")


def search(df: DataFrame, kind: str, candidates: Sequence[Mapping], k: int, metric: str = "f1",
           mode: str = "mean_minus_std_minus_gap", gap_lambda: float = 1.0, parallelism: int = 8, fold_col: str = "fold", id_col: str = "id",
           label: str = "label", weight: str | None = None, early_stopping: float | boosting.EarlyStopping | None = None, seed: int = 42, oversample: bool = False,
           class_weight: str | Mapping | None = None) -> tuple[DataFrame, DataFrame]:
    """Every candidate × fold on the same folds; selection score per candidate (J18) and the best one (F2, first
    candidate wins ties). All models are scored in one scan, whatever the number of candidates. Returns (scores, best)."""
    select.score_expr(mode, gap_lambda)  # fail before any job
    models = _fit_all(df, kind, candidates, k, fold_col, id_col, label, weight, early_stopping, seed, parallelism, oversample, class_weight)
    by = ["candidate", "fold", "split"]
    m = metrics.metrics_from_confusion(confusion_of(df, models, label, fold_col), by)
    scores = materialize(select.selection_scores(metrics.metrics_long(m, by), metric, [mode], gap_lambda))
    return scores, select.best_by(scores, f"score_{mode}", "candidate")


def random_candidates(space: Mapping[str, Sequence], n_trials: int, seed: int = 42) -> list[dict]:
    """J20 (re-aimed): seeded random points of a discrete parameter space, all different."""
    keys = sorted(space)
    sizes = [len(space[k]) for k in keys]
    if n_trials > math.prod(sizes):
        raise ValueError(f"{n_trials} trials of a space with {math.prod(sizes)} points")
    out = []
    for number in random.Random(seed).sample(range(math.prod(sizes)), n_trials):
        point = {}
        for k, n in zip(keys, sizes):
            number, at = divmod(number, n)
            point[k] = space[k][at]
        out.append(point)
    return out


def predict(model, df: DataFrame, id_col: str = "id", out: str = "pred") -> DataFrame:
    """(id, pred, p1) — p1 is the positive-class probability when the model has one."""
    t = model.transform(df)
    cols = [F.col(id_col), F.col("prediction").cast("int").alias(out)]
    if "probability" in t.columns:
        cols.append(vector_to_array("probability")[1].alias("p1"))
    return t.select(*cols)


def predict_vote(models: Sequence, df: DataFrame, id_col: str = "id") -> DataFrame:
    """Every fold model predicts in one scan of ``df``; long (id, fold, pred) → majority vote (ties → smaller)."""
    said = [F.struct(F.lit(i).alias("fold"), F.col(f"_pred{i}").cast("int").alias("pred")) for i in range(len(models))]
    long = with_predictions(df, models).select(F.col(id_col), F.explode(F.array(*said)).alias("s")).select(id_col, "s.*")
    return ensemble.majority_vote(long, id_col)


def save_fold_models(models: Sequence, path: str) -> None:
    """One saved model per fold under ``path/fold=<i>``."""
    for i, m in enumerate(models):
        m.write().overwrite().save(f"{path.rstrip('/')}/fold={i}")


MODELS = {"rf": RandomForestClassificationModel, "gbt": GBTClassificationModel, "tree": DecisionTreeClassificationModel, "svm": LinearSVCModel}


def load_fold_models(path: str, k: int, kind: str) -> list:
    """The k fold models saved by :func:`save_fold_models`."""
    return [MODELS[kind].load(f"{path.rstrip('/')}/fold={i}") for i in range(k)]

