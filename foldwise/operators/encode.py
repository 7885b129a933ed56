"""Encoders: one-hot (I17), target / mean encoding (C1, I27), ordinal passthrough (I18 via scale)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators.fitting import to_training_folds
from foldwise.operators.joins import attach

MAX_CATEGORIES = 10_000


def fit_one_hot(df: DataFrame, cols: Sequence[str], max_categories: int = MAX_CATEGORIES) -> DataFrame:
    """(feature, category): distinct non-null categories per column, learnt on ``df``."""
    lv = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "feature", "category")
    return lv.where(F.col("category").isNotNull()).distinct()


def one_hot_columns(params: DataFrame, max_categories: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """Bring the category lists to the driver (their size is checked: one-hot output width is
    the number of categories, so an unbounded list is an error, not something to truncate)."""
    rows = params.limit(max_categories + 1).collect()
    if len(rows) > max_categories:
        raise ValueError(f"more than {max_categories} categories; use target encoding instead")
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r["feature"], []).append(r["category"])
    return {k: sorted(v) for k, v in out.items()}


def apply_one_hot(df: DataFrame, categories: dict[str, list[str]], prefix: str = "cat__", drop: bool = True) -> DataFrame:
    """Dense 0/1 indicator columns ``<prefix><col>_<category>``; unseen or NULL → all zero."""
    ind = []
    for c, cats in categories.items():
        for v in cats:
            ind.append(F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("double"), F.lit(0.0))
                       .alias(f"{prefix}{c}_{v}"))
    out = df.select("*", *ind)
    return out.drop(*categories.keys()) if drop else out


def one_hot_long(df: DataFrame, id_col: str, categories: dict[str, list[str]]) -> DataFrame:
    """Long form of the one-hot output: (id, feature, category) for the indicator that is 1, and
    category NULL for a row whose value is unseen or NULL (all indicators 0)."""
    parts = []
    for c, cats in categories.items():
        known = F.col(c).cast("string").isin(cats) if cats else F.lit(False)
        parts.append(F.struct(F.lit(c).alias("feature"),
                              F.when(known, F.col(c).cast("string")).alias("category")))
    return df.select(id_col, F.explode(F.array(*parts)).alias("o")).select(id_col, "o.feature", "o.category")


def one_hot_long_joined(df: DataFrame, id_col: str, cols: Sequence[str], params: DataFrame) -> DataFrame:
    """:func:`one_hot_long` for any number of categories: the learnt (feature, category) table stays
    distributed and is joined, so no list is brought to the driver."""
    long = df.select(id_col, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot([id_col], list(cols), "feature", "_value")
    known = params.select("feature", F.col("category").alias("_value"), F.col("category"))
    return attach(long, known, ["feature", "_value"]).select(id_col, "feature", "category")


def fit_target_mean(df: DataFrame, cat: str, target: str) -> DataFrame:
    """C1 / I27 fit: (cat, te) = mean target per category."""
    return df.where(F.col(cat).isNotNull()).groupBy(cat).agg(F.avg(F.col(target).cast("double")).alias("te"))


def apply_target_mean(df: DataFrame, params: DataFrame, cat: str, out: str = "te") -> DataFrame:
    """Left join on the category (broadcast after a row-count check, see ``joins.attach``);
    unseen → NULL."""
    return attach(df, params.withColumnRenamed("te", out), [cat])


def fit_target_mean_oof(df: DataFrame, cat: str, target: str, fold_col: str, k: int) -> DataFrame:
    """Fold-safe target encoding: params for fold f use rows of the other folds only. Sums and
    counts are aggregated per (fold, category) once and merged per training fold."""
    part = (df.where(F.col(cat).isNotNull()).groupBy(fold_col, cat)
              .agg(F.sum(F.col(target).cast("double")).alias("s"), F.count(F.lit(1)).alias("n")))
    tr = to_training_folds(part, k, fold_col)
    return tr.groupBy(fold_col, cat).agg((F.sum("s") / F.sum("n")).alias("te"))


def apply_target_mean_oof(df: DataFrame, params: DataFrame, cat: str, fold_col: str, out: str = "te") -> DataFrame:
    return attach(df, params.withColumnRenamed("te", out), [fold_col, cat])
