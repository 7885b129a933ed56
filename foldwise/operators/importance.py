"""Feature importance operators (J22–J24, C5, E6, F4, D27) over (fold, feature, importance)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def normalize(imp: DataFrame, by: str = "fold") -> DataFrame:
    """Importance / sum per fold (0 when the fold's total is ≤ 0)."""
    tot = F.sum("importance").over(Window.partitionBy(by))
    return imp.withColumn("importance_norm", F.when(tot > 0, F.col("importance") / tot).otherwise(F.lit(0.0)))


def cv_mean(norm: DataFrame, k: int, by: str = "fold") -> DataFrame:
    """Mean normalised importance over k folds, a missing (fold, feature) counting as
    0 — Σ / k over the union, so no outer join is needed. Sorted by the caller."""
    return norm.groupBy("feature").agg((F.sum("importance_norm") / F.lit(k)).alias("cv_mean_importance_norm"),
                                       F.count(F.lit(1)).alias("n_folds_present"))


def rank_within(norm: DataFrame, by: str = "fold") -> DataFrame:
    """Rank of each feature inside its fold (1 = most important; ties share a rank)."""
    w = Window.partitionBy(by).orderBy(F.desc("importance_norm"))
    return norm.withColumn("rank", F.rank().over(w))


def first_places(ranked: DataFrame, top: int = 4) -> DataFrame:
    """Per feature, number of folds where it ranks first, and its summed share in the top."""
    return ranked.groupBy("feature").agg(
        F.count_if(F.col("rank") == 1).alias("n_first"),
        F.sum(F.when(F.col("rank") <= top, F.col("importance_norm")).otherwise(0.0)).alias("top_share_sum"))


def family_share(norm_mean: DataFrame, sep: str = "__") -> DataFrame:
    """Summed mean importance per feature family (the part before ``sep``)."""
    fam = F.split_part(F.col("feature"), F.lit(sep), F.lit(1))
    return norm_mean.groupBy(fam.alias("family")).agg(F.sum("cv_mean_importance_norm").alias("share"))
