"""Sample weights by class (J4): none, balanced n / (k · n_c), or given per class."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_CLASSES = 10_000


def class_weights(df: DataFrame, label: str, mode: str | Mapping = "balanced") -> DataFrame:
    """(label, n, weight). ``mode``: 'none' → 1, 'balanced' → n / (k · n_c), or {class: weight}."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    if isinstance(mode, Mapping):
        m = F.create_map(*[x for k, v in mode.items() for x in (F.lit(k), F.lit(float(v)))])
        return counts.withColumn("weight", F.coalesce(F.try_element_at(m, F.col("label")), F.lit(1.0)))
    if mode == "none":
        return counts.withColumn("weight", F.lit(1.0))
    if mode != "balanced":
        raise ValueError(f"unknown class weight mode {mode!r}")
    total = df.where(F.col(label).isNotNull()).select(F.count(F.lit(1))).scalar()
    k = counts.select(F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", total / (k * F.col("n")))


def with_weights(df: DataFrame, label: str, weights: DataFrame, out: str = "weight") -> DataFrame:
    """Attach the per-class weight as a column (the class table is brought to the driver after a
    size check and inlined as a literal map — no join)."""
    rows = weights.limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError("too many classes for per-class weights")
    m = F.create_map(*[x for r in rows for x in (F.lit(r["label"]), F.lit(float(r["weight"])))])
    return df.withColumn(out, F.coalesce(F.try_element_at(m, F.col(label)), F.lit(1.0)))
