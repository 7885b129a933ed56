"""Fold assignment (E4) and hold-out split (E5), repeatable and partition-independent.

Both are keyed by ``h = md5("<id>:<seed>")``, so a row's fold never depends on partitioning,
executor loss or re-execution, and the SQL oracle computes the same value.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.operators.joins import attach

ROWS_PER_BUCKET = 1_000_000
# the per-(class, bucket) offsets table is broadcast: at most classes × 16^5 rows
MAX_PREFIX_DIGITS = 5


def row_hash(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{int(seed)}")))


def holdout_flag(id_col: str, test_size: float = 0.33, seed: int = 42) -> Column:
    """E5: True for hold-out rows. The first 8 hex digits of h are a uniform 32-bit number;
    comparing the fixed-width lowercase hex string against the threshold is the same as
    comparing the numbers."""
    if not 0 < test_size < 1:
        raise ValueError("test_size must be in (0, 1)")
    threshold = format(int(round(test_size * 16 ** 8)), "08x")
    return F.substring(row_hash(id_col, seed), 1, 8) < F.lit(threshold)


def holdout_split(df: DataFrame, id_col: str, test_size: float = 0.33, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    flag = holdout_flag(id_col, test_size, seed)
    return df.where(~flag), df.where(flag)


def stratified_folds(df: DataFrame, id_col: str, label_col: str, k: int = 5, seed: int = 42,
                     prefix_digits: int | None = None, fold_col: str = "fold") -> DataFrame:
    """Shuffled stratified k-fold. Within each class rows are ordered by (h, id) and dealt
    round-robin: fold = (rank − 1) mod k, so class counts per fold differ by at most one.

    The global per-class rank is computed without putting a class into one task: rows are
    bucketed by the first ``prefix_digits`` hex digits of h (by default sized from the row count
    to about a million rows per bucket: 2 to 5 digits, i.e. 256 to ~1M buckets); the
    per-(class, bucket) counts (at most classes × 16^digits rows — a bounded table) give each
    bucket's starting offset, and the rank is offset + rank inside the bucket. Because md5 hex
    order is prefix order, this equals the rank over the whole class.
    """
    if k < 2:
        raise ValueError("k must be >= 2")
    if prefix_digits is None:
        n = df.count()
        prefix_digits = max(2, min(MAX_PREFIX_DIGITS, math.ceil(math.log(max(n, 1) / ROWS_PER_BUCKET, 16))))
    if not 1 <= prefix_digits <= MAX_PREFIX_DIGITS:
        raise ValueError(f"prefix_digits must be in 1..{MAX_PREFIX_DIGITS}")
    h = row_hash(id_col, seed)
    x = df.withColumn("_h", h).withColumn("_b", F.substring(F.col("_h"), 1, prefix_digits))
    counts = x.groupBy(label_col, "_b").agg(F.count(F.lit(1)).alias("_n"))
    wo = Window.partitionBy(label_col).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(label_col, "_b", F.coalesce(F.sum("_n").over(wo), F.lit(0)).alias("_off"))
    # (number of classes) × 16^prefix_digits rows: broadcast if that is few, else a shuffle join
    j = attach(x, offsets, [label_col, "_b"], how="inner")
    wl = Window.partitionBy(label_col, "_b").orderBy("_h", id_col)
    rank = F.col("_off") + F.row_number().over(wl)
    return j.withColumn(fold_col, ((rank - 1) % k).cast("int")).drop("_h", "_b", "_off")


def fold_sql(id_col: str, label_col: str, k: int = 5, seed: int = 42, source: str = "t") -> str:
    """The same assignment in plain SQL (used by the oracle)."""
    return (f"SELECT *, CAST((row_number() OVER (PARTITION BY {label_col} ORDER BY "
            f"md5(concat(CAST({id_col} AS VARCHAR), ':{seed}')), {id_col}) - 1) % {k} AS INTEGER) AS fold FROM {source}")


def holdout_sql(id_col: str, test_size: float = 0.33, seed: int = 42) -> str:
    threshold = format(int(round(test_size * 16 ** 8)), "08x")
    return f"substr(md5(concat(CAST({id_col} AS VARCHAR), ':{seed}')), 1, 8) < '{threshold}'"
