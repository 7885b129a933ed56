"""Prediction and voting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def to_long(df: DataFrame, id_col: str, pred_cols: Sequence[str]) -> DataFrame:
    """k prediction columns → (id, model, pred)."""
    return df.select(id_col, *pred_cols).unpivot([id_col], list(pred_cols), "model", "pred")


def majority_vote(long: DataFrame, id_col: str, pred: str = "pred", out: str = "vote") -> DataFrame:
    """Most frequent prediction per id; ties → smallest label. Counts per (id, label) are
    a map-side-combined aggregate, then one max_by per id."""
    c = long.groupBy(id_col, F.col(pred).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    return c.groupBy(id_col).agg(F.max_by(F.col("_p"), F.struct(F.col("_n"), -F.col("_p"))).alias(out),
                                 F.max("_n").alias("votes"), F.sum("_n").alias("n_models"))


def prediction_counts(df: DataFrame, pred: str, classes: Sequence) -> DataFrame:
    """Count per predicted class plus total, one row."""
    return df.agg(*[F.count_if(F.col(pred) == c).alias(f"n_{c}") for c in classes],
                  F.count(F.lit(1)).alias("total"))
