"""Shared pieces of the registered queries: the profile roles and the cleaned profile table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.operators import clean
from foldwise.sources import tables

# Roles of the profile view (FIXTURES.md §3 P).
TARGET = "target"
TARGET_MAP = {1: 1, 2: 0}
NUMERIC = ["num_a", "num_b", "num_c"]
LONG_TAIL = ["long_tail"]
CATEGORICAL = ["cat_a", "cat_b"]
ORDINAL = ["ord_a"]
DIRTY = ["raw_num"]
TEXT = ["note"]
ALL_NUMERIC = NUMERIC + LONG_TAIL + ORDINAL + ["raw_num"]


def cleaned_profile(spark: SparkSession, sf_dir: str, with_note: bool = False) -> DataFrame:
    """A2 on the profile view: coerce the dirty number, encode the target, drop null targets."""
    p = tables.profile(spark, sf_dir, with_note).withColumnRenamed("target_raw", TARGET)
    return clean.load_and_clean(p, TARGET, TARGET_MAP, numeric=DIRTY)


def r6(c) -> "F.Column":
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# SQL counterpart of cleaned_profile (DuckDB), used as a CTE named ``cp`` after view ``p``.
CP_SQL = """cp AS (
  SELECT id, CAST(CASE target_raw WHEN 1 THEN 1 WHEN 2 THEN 0 END AS INTEGER) AS target,
         cat_a, cat_b, num_a, num_b, num_c, long_tail, ord_a,
         TRY_CAST(raw_num AS DOUBLE) AS raw_num, note
  FROM p)"""
