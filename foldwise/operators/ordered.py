"""Global ordered computations without a single-partition window.

``Window.orderBy(x)`` with no partition key moves every row into one task. Here the rows are dealt into
ranges of the *whole* order key, ties included, by Spark's range partitioning, and written once; totals
per range (one row per range) give each range its starting offset, and the running value inside a
range is a window partitioned by range. Ranges are contiguous in the order, so the result equals that of
the single window, and a key that many rows share is spread over ranges like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.session import materialize


def _running(df: DataFrame, order: Sequence, sum_cols: Sequence[str], n_ranges: int | None) -> DataFrame:
    dealt = df.repartitionByRange(n_ranges, *order) if n_ranges else df.repartitionByRange(*order)
    x = materialize(dealt.withColumn("_range", F.spark_partition_id()))
    totals = x.groupBy("_range").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    # a row per range: the single-partition window over it is bounded by their number
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sum_cols])
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (x.join(F.broadcast(offsets), "_range")
             .select(*df.columns, *[(F.col(f"_o_{c}") + F.sum(c).over(inside)).alias(f"cum_{c}") for c in sum_cols]))


def running_sums(df: DataFrame, key: str, sum_cols: Sequence[str], descending: bool = True,
                 tie_cols: Sequence[str] = (), n_buckets: int | None = None,
                 include_ties: bool = True) -> DataFrame:
    """Adds ``cum_<c>`` = running sum of c in ``key`` order (descending by default).

    ``include_ties=True`` makes rows with equal keys share the total through the last of them
    (RANGE semantics — what a threshold sweep needs): keys are summed first, so that a frequent
    one is a single row of the order. Otherwise rows are counted one by one in (key, tie_cols)
    order (ROWS semantics — a row number).
    """
    order = [F.desc(key) if descending else F.asc(key)]
    if not include_ties or tie_cols:
        return _running(df, order + [F.asc(c) for c in tie_cols], sum_cols, n_buckets)
    x = materialize(df)
    per_key = x.groupBy(key).agg(*[F.sum(c).alias(c) for c in sum_cols])
    sums = _running(per_key, order, sum_cols, n_buckets).drop(*sum_cols)
    return (x.join(sums, x[key].eqNullSafe(sums[key]))
             .select(*[x[c] for c in df.columns], *[f"cum_{c}" for c in sum_cols]))


def global_row_number(df: DataFrame, key: str, tie_cols: Sequence[str] = (), out: str = "seq",
                      n_buckets: int | None = None) -> DataFrame:
    """1-based row number in (key, tie_cols) ascending order, computed range by range."""
    r = _running(df.withColumn("_one", F.lit(1)), [F.asc(key)] + [F.asc(c) for c in tie_cols], ["_one"], n_buckets)
    return r.withColumnRenamed("cum__one", out).drop("_one")
