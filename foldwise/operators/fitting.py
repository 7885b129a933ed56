"""Fitting machinery shared by every learnt operator.

A fitted operator is a *params table*: an ordinary DataFrame with one row per feature (and per
fold when fitted fold-wise). Fitting is one aggregation over a long (unpivoted) view of the
input; applying is a projection.

Fold-wise fitting: the params for rows of fold *f* are fitted on the rows whose fold is not
*f*. Instead of re-reading the data k times, every statistic is computed as a *mergeable
partial* per (fold, feature) — counts, sums, mean/M2, min/max, value counts, or KLL sketches —
and the k partial rows of each feature are then replicated to the k-1 training folds they
belong to and merged. The replicated table has k·(k-1)·columns rows (exact quantiles keep one
count per training fold beside each value instead), so the data itself is scanned and shuffled
once, whatever k is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.session import materialize

MAX_PARAM_ROWS = 100_000


def long_values(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., feature, value DOUBLE) — one row per input row and feature."""
    cols = list(cols)
    if not cols:
        raise ValueError("no columns")
    proj = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols])
    return proj.unpivot(list(keys), cols, "feature", "value")


def to_training_folds(partials: DataFrame, k: int, fold_col: str = "fold") -> DataFrame:
    """Replicate each per-fold partial row to the k-1 folds whose training set contains it.

    Output keeps the feature name ``fold_col`` but it now means "params for rows of this fold".
    """
    if k < 2:
        raise ValueError("k must be >= 2")
    others = F.array_remove(F.sequence(F.lit(0), F.lit(k - 1)), F.col(fold_col).cast("int"))
    return partials.withColumn(fold_col, F.explode(others))


def _keys(fold_col: str | None) -> list[str]:
    return [fold_col] if fold_col else []


# ---------------------------------------------------------------------------------------------
# Moments: count, mean, population / sample std, min, max, sum
# ---------------------------------------------------------------------------------------------

def fit_moments(df: DataFrame, cols: Sequence[str], fold_col: str | None = None,
                k: int | None = None) -> DataFrame:
    """(fold?, feature, n, mean, std_pop, std_samp, min, max, sum) per feature.

    Without folds Spark's own one-pass aggregates are used. With folds, per-fold
    (n, mean, M2, min, max) partials are merged with the parallel-variance rule, which stays
    numerically stable for large magnitudes (no sum-of-squares cancellation).
    """
    lv = long_values(df, cols, _keys(fold_col))
    if not fold_col:
        return lv.groupBy("feature").agg(
            F.count("value").alias("n"), F.avg("value").alias("mean"),
            F.stddev_pop("value").alias("std_pop"), F.stddev_samp("value").alias("std_samp"),
            F.min("value").alias("min"), F.max("value").alias("max"), F.sum("value").alias("sum"))
    part = lv.groupBy(fold_col, "feature").agg(
        F.count("value").alias("n_i"), F.avg("value").alias("mean_i"),
        (F.var_pop("value") * F.count("value")).alias("m2_i"),
        F.min("value").alias("min_i"), F.max("value").alias("max_i"), F.sum("value").alias("sum_i"))
    tr = to_training_folds(part, k, fold_col).where(F.col("n_i") > 0)
    w = Window.partitionBy(fold_col, "feature")
    n = F.sum("n_i").over(w)
    mean = F.sum(F.col("n_i") * F.col("mean_i")).over(w) / n
    tr = tr.withColumn("n", n).withColumn("mean", mean)
    merged = tr.groupBy(fold_col, "feature").agg(
        F.first("n").alias("n"), F.first("mean").alias("mean"),
        (F.sum(F.col("m2_i") + F.col("n_i") * F.pow(F.col("mean_i") - F.col("mean"), 2))).alias("m2"),
        F.min("min_i").alias("min"), F.max("max_i").alias("max"), F.sum("sum_i").alias("sum"))
    # A fold whose training rows are all NULL for a feature has no row here; applying such
    # params yields NULL (no-op) for that fold.
    return merged.select(
        fold_col, "feature", F.col("n").cast("long").alias("n"), "mean",
        F.sqrt(F.col("m2") / F.col("n")).alias("std_pop"),
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("std_samp"),
        "min", "max", "sum")


# ---------------------------------------------------------------------------------------------
# Quantiles
# ---------------------------------------------------------------------------------------------

def _q_names(probs: Sequence[float], names: Sequence[str] | None) -> list[str]:
    if names is not None:
        if len(names) != len(probs):
            raise ValueError("names and probs differ in length")
        return list(names)
    return [f"q{str(p).replace('.', '_')}" for p in probs]


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; the keys are the left's."""
    renamed = right.select(*[F.col(c).alias(f"_key_{c}" if c in keys else c) for c in right.columns])
    cond = None
    for c in keys:
        same = F.col(c).eqNullSafe(F.col(f"_key_{c}"))
        cond = same if cond is None else cond & same
    return left.join(renamed, cond, how).drop(*[f"_key_{c}" for c in keys])


def exact_quantiles(lv: DataFrame, keys: Sequence[str], probs: Sequence[float], names: Sequence[str],
                    fold_col: str | None = None, k: int | None = None) -> DataFrame:
    """Interpolated quantiles of ``value`` per ``keys`` (and training fold), with no group in one task.

    1. Equal values are counted (partial counts before the shuffle); fold-wise, one count per training
       fold, i.e. of the rows outside that fold.
    2. The counted values are dealt into ranges of (keys, value), by as many tasks as the data needs, and
       written once.
    3. Totals per range give each range its offset; a running sum inside the range then gives the
       ranks that a value covers.
    4. Of all values only those at a wanted rank are kept, two per probability, and interpolated as
       NumPy does.

    A task holds one range of distinct values, whatever a group's size.
    """
    keys = list(keys)
    wanted = range(k) if fold_col else [0]
    if fold_col:
        counted = lv.groupBy(*keys, "value").agg(*[F.count_if(F.col(fold_col) != f).alias(f"_w{f}") for f in wanted])
    else:
        counted = lv.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("_w0"))
    ranged = materialize(counted.repartitionByRange(*keys, "value").withColumn("_range", F.spark_partition_id()))
    totals = ranged.groupBy(*keys, "_range").agg(*[F.sum(f"_w{f}").alias(f"_t{f}") for f in wanted])
    by_range, all_ranges = Window.partitionBy(*keys).orderBy("_range"), Window.partitionBy(*keys)
    offsets = totals.select(*keys, "_range", *[(F.sum(f"_t{f}").over(by_range) - F.col(f"_t{f}")).alias(f"_o{f}") for f in wanted],
                            *[F.sum(f"_t{f}").over(all_ranges).alias(f"_n{f}") for f in wanted])
    inside = Window.partitionBy(*keys, "_range").orderBy("value")
    ranks = (join_null_safe(ranged, offsets, [*keys, "_range"]).select("*", *[(F.col(f"_o{f}") + F.sum(f"_w{f}").over(inside)).alias(f"_c{f}") for f in wanted]))
    picks = []
    for f in wanted:
        for i, p in enumerate(probs):
            at = (F.col(f"_n{f}") - 1) * F.lit(p)
            for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
                here = (F.col(f"_c{f}") > rank) & (F.col(f"_c{f}") - F.col(f"_w{f}") <= rank)
                picks.append(F.max(F.when(here, F.col("value"))).alias(f"_{side}{f}_{i}"))
    found = ranks.groupBy(*keys).agg(*picks, *[F.max(f"_n{f}").alias(f"_n{f}") for f in wanted])

    def at_prob(f: int, i: int, p: float) -> Column:
        h = (F.col(f"_n{f}") - 1) * F.lit(p)
        lo, hi = F.col(f"_lo{f}_{i}"), F.col(f"_hi{f}_{i}")
        return F.when(lo == hi, lo).otherwise((F.ceil(h) - h) * lo + (h - F.floor(h)) * hi)

    rows = [F.struct(*([F.lit(f).alias("fold")] if fold_col else []), F.col(f"_n{f}").alias("n"),
                     *[at_prob(f, i, p).alias(name) for i, (p, name) in enumerate(zip(probs, names))]) for f in wanted]
    out = found.select(*keys, F.explode(F.array(*rows)).alias("_r")).where("_r.n > 0")
    return out.select(*keys, *([F.col("_r.fold").alias(fold_col)] if fold_col else []), *[F.col("_r")[name].alias(name) for name in names])


def fit_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                  names: Sequence[str] | None = None, fold_col: str | None = None,
                  k: int | None = None, exact: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """(by..., fold?, feature, <one feature per prob>) — linear-interpolated quantiles.

    ``exact=True``: see :func:`exact_quantiles`. ``exact=False`` (an explicit choice of the caller: its
    ranks aren't interpolated) uses KLL sketches, one small sketch per (fold, feature), merged per
    training fold.
    """
    probs = [float(p) for p in probs]
    qn = _q_names(probs, names)
    keys = list(by) + _keys(fold_col)
    lv = long_values(df, cols, keys).where(F.col("value").isNotNull())
    if exact:
        return exact_quantiles(lv, [*by, "feature"], probs, qn, fold_col, k).select(*keys, "feature", *qn)
    sk = lv.groupBy(*keys, "feature").agg(F.expr("kll_sketch_agg_double(value)").alias("_sk"))
    if fold_col:
        sk = to_training_folds(sk, k, fold_col).groupBy(*keys, "feature").agg(
            F.expr("kll_merge_agg_double(_sk)").alias("_sk"))
    return sk.select(*keys, "feature", *[
        F.expr(f"kll_sketch_get_quantile_double(_sk, {p})").alias(n) for p, n in zip(probs, qn)])


# ---------------------------------------------------------------------------------------------
# Most frequent value (ties → smallest, as scikit-learn)
# ---------------------------------------------------------------------------------------------

def fit_mode(df: DataFrame, cols: Sequence[str], fold_col: str | None = None,
             k: int | None = None) -> DataFrame:
    """(fold?, feature, mode): value counts per (fold, feature, value), merged per training fold,
    then the highest count wins with the smallest value on ties."""
    keys = _keys(fold_col)
    counts = (long_values(df, cols, keys).where(F.col("value").isNotNull())
              .groupBy(*keys, "feature", "value").agg(F.count(F.lit(1)).alias("cnt")))
    if fold_col:
        counts = to_training_folds(counts, k, fold_col).groupBy(*keys, "feature", "value").agg(
            F.sum("cnt").alias("cnt"))
    return counts.groupBy(*keys, "feature").agg(
        F.max_by(F.col("value"), F.struct(F.col("cnt"), -F.col("value"))).alias("mode"))


# ---------------------------------------------------------------------------------------------
# Applying params
# ---------------------------------------------------------------------------------------------

def collect_params(params: DataFrame, fold_col: str | None, max_rows: int = MAX_PARAM_ROWS) -> dict:
    """Bring a per-feature params table to the driver as {(fold, feature): row-dict}.

    Params tables have one row per (fold, feature); the bound is checked, never assumed.
    """
    rows = params.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"params table exceeds {max_rows} rows; join it instead of inlining")
    out = {}
    for r in rows:
        d = r.asDict()
        out[(d.get(fold_col) if fold_col else None, d["feature"])] = d
    return out


def param_expr(table: dict, feature: str, field: str, fold_col: str | None) -> Column:
    """Literal (or CASE over folds) for one fitted value."""
    if not fold_col:
        v = table.get((None, feature), {}).get(field)
        return F.lit(v).cast("double")
    out = F.lit(None).cast("double")
    for (f, c), d in sorted(table.items(), key=lambda kv: (kv[0][0], kv[0][1])):
        if c == feature:
            out = F.when(F.col(fold_col) == F.lit(f), F.lit(d.get(field)).cast("double")).otherwise(out)
    return out
