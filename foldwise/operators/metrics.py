"""Classification metrics (J11–J15) and fold summaries (D22), all as aggregations.

Every metric comes from confusion counts aggregated once per group (fold, split, candidate…);
the rest is arithmetic with 0 where a ratio is undefined (scikit-learn's zero_division=0).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.operators.ordered import running_sums
from foldwise.session import materialize


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def confusion_counts(df: DataFrame, label: str, pred: str, by: Sequence[str] = (), positive=1) -> DataFrame:
    """(by…, tp, fp, fn, tn) for the positive class."""
    y, p = F.col(label) == positive, F.col(pred) == positive
    return df.groupBy(*by).agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                               F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))


def binary_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, F1 from (tp, fp, fn, tn)."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(*by, "tp", "fp", "fn", "tn",
                         _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                         _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"),
                         _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


METRIC_NAMES = ("accuracy", "f1", "precision", "recall", "weighted_f1")


def metrics_long(metrics: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by…, metric, value) from a wide metrics frame (every metric column present)."""
    cols = [c for c in METRIC_NAMES if c in metrics.columns]
    return metrics.unpivot(list(by), cols, "metric", "value")


def fold_summary(long: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean and population std over folds per (by…, metric)."""
    return long.groupBy(*by, "metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
                                           F.count(F.lit(1)).alias("n_folds"))


def per_class(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """(by…, class, precision, recall, f1, support) for every class seen in labels or
    predictions — one pass: each row contributes to its true class and its predicted class."""
    rows = df.select(*by, F.explode(F.array(
        F.struct(F.col(label).alias("cls"), F.lit(1).alias("is_true"), (F.col(label) == F.col(pred)).cast("int").alias("hit")),
        F.struct(F.col(pred).alias("cls"), F.lit(0).alias("is_true"), (F.col(label) == F.col(pred)).cast("int").alias("hit")),
    )).alias("e")).select(*by, "e.*")
    g = rows.groupBy(*by, "cls").agg(
        F.sum("is_true").alias("support"), F.count_if(F.col("is_true") == 0).alias("n_pred"),
        F.sum(F.when(F.col("is_true") == 1, F.col("hit")).otherwise(0)).alias("tp"))
    prec = _ratio(F.col("tp"), F.col("n_pred"))
    rec = _ratio(F.col("tp"), F.col("support"))
    return g.select(*by, F.col("cls").alias("class"), prec.alias("precision"), rec.alias("recall"),
                    _ratio(2 * prec * rec, prec + rec).alias("f1"), F.col("support").cast("long").alias("support"))


def weighted_f1(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Support-weighted mean F1 over classes."""
    pc = per_class(df, label, pred, by)
    return pc.groupBy(*by).agg((F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"))


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per-class rows plus 'macro avg' and 'weighted avg' rows (class as string)."""
    pc = materialize(per_class(df, label, pred))
    rows = pc.select(F.col("class").cast("string").alias("class"), "precision", "recall", "f1", "support")
    macro = pc.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                   F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    tot = F.sum("support")
    weighted = pc.agg(F.lit("weighted avg").alias("class"),
                      (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
                      (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
                      (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"), tot.alias("support"))
    return rows.unionByName(macro).unionByName(weighted)


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """(label, pred, n)."""
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def pr_curve(df: DataFrame, label: str, score: str, positive=1) -> DataFrame:
    """One point per distinct score threshold t (predict positive when score ≥ t):
    (threshold, tp, fp, precision, recall, recall_step). Counts per distinct score first, then running
    totals in descending score order (bucketed, see :mod:`foldwise.operators.ordered`)."""
    per = df.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == positive).alias("pos"), F.count_if(F.col(label) != positive).alias("neg"))
    total_pos = df.where(F.col(label) == positive).select(F.count(F.lit(1))).scalar()
    r = running_sums(per, "threshold", ["pos", "neg"], descending=True)
    return r.select("threshold", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                    (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                    _ratio(F.col("cum_pos"), total_pos).alias("recall"),
                    _ratio(F.col("pos"), total_pos).alias("recall_step"))


def average_precision(curve: DataFrame) -> DataFrame:
    """AP = Σ (R_n − R_{n−1}) · P_n over thresholds; the recall step of a threshold is its
    own positives over all positives (``recall_step`` of :func:`pr_curve`)."""
    return curve.agg(F.sum(F.col("recall_step") * F.col("precision")).alias("average_precision"))


def metrics_from_confusion(cm: DataFrame, by: Sequence[str], positive=1) -> DataFrame:
    """Binary metrics (J11) and weighted F1 (J12) per group from a confusion table
    (by…, label, pred, n) — a table of groups × classes² rows, so the predictions are
    aggregated once and every metric is derived from that small table."""
    y, p, n = F.col("label") == positive, F.col("pred") == positive, F.col("n")
    counts = cm.groupBy(*by).agg(*[F.sum(F.when(c, n).otherwise(0)).alias(a) for a, c in
                                   (("tp", y & p), ("fp", ~y & p), ("fn", y & ~p), ("tn", ~y & ~p))])
    binary = binary_metrics(counts, by)
    rows = cm.select(*by, "n", F.explode(F.array(
        F.struct(F.col("label").alias("cls"), F.lit(1).alias("is_true"), (F.col("label") == F.col("pred")).cast("int").alias("hit")),
        F.struct(F.col("pred").alias("cls"), F.lit(0).alias("is_true"), (F.col("label") == F.col("pred")).cast("int").alias("hit")),
    )).alias("e")).select(*by, "n", "e.*")
    pc = rows.groupBy(*by, "cls").agg(
        F.sum(F.col("is_true") * F.col("n")).alias("support"), F.sum((1 - F.col("is_true")) * F.col("n")).alias("n_pred"),
        F.sum(F.col("is_true") * F.col("hit") * F.col("n")).alias("tp_c"))
    prec, rec = _ratio(F.col("tp_c"), F.col("n_pred")), _ratio(F.col("tp_c"), F.col("support"))
    f1 = _ratio(2 * prec * rec, prec + rec)
    wf = pc.groupBy(*by).agg((F.sum(f1 * F.col("support")) / F.sum("support")).alias("weighted_f1"))
    return binary.join(wf, list(by))

