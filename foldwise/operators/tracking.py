"""Run tracking over an append-only run table.

Every "latest per key" is an aggregation (``max_by`` over an ordering struct), never a window
partitioned by the key, so a key holding a third of all runs is combined map-side like any
other. Comparisons join two per-key tables whose size is the number of keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.functions import names
from foldwise.operators.ordered import global_row_number


def latest_per_key(runs: DataFrame, key: str, order: Sequence[str] = ("ts", "run_id"),
                   only_success: bool = False, status: str = "status") -> DataFrame:
    """The last row per key in ``order`` (optionally among successful rows only)."""
    x = runs.where(F.col(status) == "success") if only_success else runs
    cols = [c for c in runs.columns if c != key]
    return x.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_r")).select(key, "_r.*")


def compare_to_previous(current: DataFrame, previous: DataFrame, key: str, metric: str,
                        name_col: str = "run_name") -> DataFrame:
    """C3 + H8: current row per key ⟕ previous successful row per key; numbers and their
    signed delta as fixed-point text ('' when missing)."""
    p = previous.select(key, F.col(name_col).alias("previous_run"), F.col(metric).alias("_prev"))
    c = current.select(key, "status", F.col(name_col).alias("new_run"), F.col(metric).alias("_new"))
    j = c.join(p, key, "left")
    delta = F.col("_new") - F.col("_prev")
    return j.select(key, "status", F.coalesce(F.col("previous_run"), F.lit("")).alias("previous_run"), "new_run",
                    "_prev", "_new", delta.alias("_delta"),
                    names.fmt_fixed("_prev").alias(f"prev_{metric}"), names.fmt_fixed("_new").alias(f"new_{metric}"),
                    names.fmt_fixed(delta, signed=True).alias(f"delta_{metric}"))


def comparison_counters(cmp: DataFrame, tol: float = 1e-12) -> DataFrame:
    """Improved / degraded / same / new / failed counts of a comparison."""
    ok = F.col("status") == "success"
    d = F.col("_delta")
    return cmp.agg(F.count(F.lit(1)).alias("configs"),
                   F.count_if(ok & F.col("_prev").isNotNull() & (d > tol)).alias("improved"),
                   F.count_if(ok & F.col("_prev").isNotNull() & (d < -tol)).alias("degraded"),
                   F.count_if(ok & F.col("_prev").isNotNull() & (F.abs(d) <= tol)).alias("same"),
                   F.count_if(ok & F.col("_prev").isNull()).alias("new"),
                   F.count_if(~ok).alias("failed"))


def next_run_id(runs: DataFrame, name_col: str = "run_name") -> DataFrame:
    """Max parsed id + 1 (1 when there is none)."""
    i = names.exp_id(name_col)
    return runs.agg(F.coalesce(F.max(F.when(i >= 0, i)) + 1, F.lit(1)).alias("next_run_id"))


def newest_run(runs: DataFrame, name_col: str = "run_name") -> DataFrame:
    """Newest run by parsed id and by time."""
    return runs.agg(F.max_by(F.col(name_col), names.exp_id(name_col)).alias("newest_by_id"),
                    F.max_by(F.col(name_col), F.struct("ts", "run_id")).alias("newest_by_time"))


def trend(runs: DataFrame, metric: str = "mean_f1", spread: str = "std_f1") -> DataFrame:
    """Sequence number in (ts, run_id) order, with the mean ± std band."""
    x = runs.withColumn("_t", F.unix_micros(F.col("ts").cast("timestamp")))
    r = global_row_number(x, "_t", ["run_id"], out="seq").drop("_t")
    return r.select("seq", "run_id", metric, (F.col(metric) - F.col(spread)).alias("band_lo"),
                    (F.col(metric) + F.col(spread)).alias("band_hi"))


def new_keys(after: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """Keys present after but not before (anti join)."""
    return after.select(key).distinct().join(before.select(key), key, "left_anti")


def append(table: DataFrame, rows: DataFrame) -> DataFrame:
    """G1: append rows, aligning columns by name (missing → NULL)."""
    return table.unionByName(rows, allowMissingColumns=True)


def with_name_parts(runs: DataFrame, name_col: str = "run_name", rules=names.MODEL_RULES) -> DataFrame:
    return runs.withColumn("model", names.model_family(name_col, rules)).withColumn("method", names.method_name(name_col))


def year_of(c: str) -> Column:
    return F.year(F.col(c))
