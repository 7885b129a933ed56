"""Profiling aggregates (D1–D21, D29, D30, C6–C8, F5–F7), always in long form.

Every per-feature statistic is computed on an unpivoted ``(keys…, feature, value)`` view, so many
columns cost one scan and one shuffle keyed by (group, feature) — the work spreads over columns
and groups instead of one wide single-row aggregate. Totals needed for shares are scalar
subqueries (``DataFrame.scalar``), which Catalyst evaluates once and inlines.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.operators import gram
from foldwise.operators.fitting import fit_quantiles, join_null_safe, long_values
from foldwise.operators.joins import attach


def _r(c: Column, nd: int = 6) -> Column:
    return F.round(c, nd)


# -- frequencies ----------------------------------------------------------------------------

def freq_table(df: DataFrame, c: str) -> DataFrame:
    """(value, n), NULL excluded, most frequent first (ties by value)."""
    return (df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), F.asc("value")))


def freq_ratio(df: DataFrame, c: str) -> DataFrame:
    """(value, n, share) with share = n / non-null total."""
    total = df.where(F.col(c).isNotNull()).select(F.count(F.lit(1))).scalar()
    return freq_table(df, c).withColumn("share", _r(F.col("n") / total))


def imbalance(df: DataFrame, c: str) -> DataFrame:
    """D3: max/min class count and its grade (<1.5 balanced, <3 mild, else severe)."""
    f = freq_table(df, c).agg(F.max("n").alias("max_n"), F.min("n").alias("min_n"),
                              F.count(F.lit(1)).alias("n_classes"))
    ratio = F.col("max_n") / F.col("min_n")
    return f.select("n_classes", "max_n", "min_n", _r(ratio).alias("ratio"),
                    F.when(ratio < 1.5, "balanced").when(ratio < 3, "mild").otherwise("severe").alias("grade"))


def top_categories(df: DataFrame, c: str, n: int = 10) -> DataFrame:
    """the n most frequent values (ties by value)."""
    return freq_table(df, c).orderBy(F.desc("n"), F.asc("value")).limit(n)


# -- missing values -------------------------------------------------------------------------

def _count_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, non_null, total) from one single-pass aggregation of count(c) per feature."""
    wide = df.agg(F.count(F.lit(1)).alias("__total"), *[F.count(c).alias(c) for c in cols])
    return wide.unpivot(["__total"], list(cols), "feature", "non_null").withColumnRenamed("__total", "total")


def distinct_counts(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """(feature, n_distinct). Exact distinct counts per feature in long form (one shuffle on
    (feature, value)); ``exact=False`` uses HyperLogLog++ instead."""
    lv = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "feature", "value")
    if exact:
        return lv.where(F.col("value").isNotNull()).distinct().groupBy("feature").agg(
            F.count(F.lit(1)).alias("n_distinct"))
    return lv.groupBy("feature").agg(F.approx_count_distinct("value").alias("n_distinct"))


def null_profile(df: DataFrame, cols: Sequence[str], only_missing: bool = True) -> DataFrame:
    """(feature, null_count, non_null, null_pct), only columns that have nulls."""
    c = _count_long(df, cols).select(
        "feature", (F.col("total") - F.col("non_null")).alias("null_count"), "non_null",
        _r((F.col("total") - F.col("non_null")) * 100.0 / F.col("total")).alias("null_pct"))
    c = c.where(F.col("null_count") > 0) if only_missing else c
    return c.orderBy(F.desc("null_pct"), F.asc("feature"))


def null_grade(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Missing grade (>50 high, >20 medium, else low) and a suggested treatment
    (30 % cut: numeric → drop_or_flag / median, categorical → unknown_category / most_frequent)."""
    p = null_profile(df, list(numeric) + list(categorical))
    is_num = F.col("feature").isin(list(numeric))
    return p.select(
        "feature", "null_count", "null_pct",
        F.when(F.col("null_pct") > 50, "high").when(F.col("null_pct") > 20, "medium").otherwise("low").alias("grade"),
        F.when(is_num, F.when(F.col("null_pct") > 30, "drop_or_flag").otherwise("median"))
         .otherwise(F.when(F.col("null_pct") > 30, "unknown_category").otherwise("most_frequent")).alias("treatment"))


def missing_target_rate(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Target rate among rows where each feature is missing, against the overall rate."""
    lv = long_values(df, cols, [target])
    return lv.groupBy("feature").agg(
        F.count_if(F.col("value").isNull()).alias("n_missing"),
        _r(F.avg(F.when(F.col("value").isNull(), F.col(target)))).alias("rate_missing"),
        _r(F.avg(F.col(target))).alias("rate_all"))


# -- describe -------------------------------------------------------------------------------

def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), extra_quantiles: bool = False,
             exact: bool = True) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max per (group…, feature); with
    ``extra_quantiles`` also p01, p99 and the missing percentage."""
    by = list(by)
    lv = long_values(df, cols, by)
    probs = [0.25, 0.5, 0.75] + ([0.01, 0.99] if extra_quantiles else [])
    names = ["q1", "median", "q3"] + (["p01", "p99"] if extra_quantiles else [])
    aggs = [F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"), F.max("value").alias("max")]
    if extra_quantiles:
        aggs.append((F.count_if(F.col("value").isNull()) * 100.0 / F.count(F.lit(1))).alias("missing_pct"))
    g = lv.groupBy(*by, "feature").agg(*aggs)
    q = fit_quantiles(df, cols, probs, names, by=by, exact=exact)
    keys = [*by, "feature"]
    g = join_null_safe(g, q, keys, "left")
    out = [*keys, "count", _r(F.col("mean")).alias("mean"), _r(F.col("std")).alias("std"), _r(F.col("min")).alias("min")]
    out += [_r(F.col(n)).alias(n) for n in names]
    out += [_r(F.col("max")).alias("max")]
    if extra_quantiles:
        out.append(_r(F.col("missing_pct")).alias("missing_pct"))
    return g.select(*out)


# -- quantile bounds and clip impact --------------------------------------------------------

def quantile_bounds(df: DataFrame, cols: Sequence[str], by: Sequence[str], ranges: Mapping[str, tuple],
                    exact: bool = True) -> DataFrame:
    """D9 / C7 fit: (range, group…, feature, lower, upper) for several (lo %, hi %) ranges at
    once — all percentiles of a (group, feature) come from one aggregation buffer."""
    names = list(ranges)
    probs, qn = [], []
    for i, r in enumerate(names):
        lo, hi = ranges[r]
        probs += [lo / 100.0, hi / 100.0]
        qn += [f"lo{i}", f"hi{i}"]
    q = fit_quantiles(df, cols, probs, qn, by=list(by), exact=exact)
    parts = [F.struct(F.lit(r).alias("range"), F.col(f"lo{i}").alias("lower"), F.col(f"hi{i}").alias("upper"))
             for i, r in enumerate(names)]
    return q.select(*by, "feature", F.explode(F.array(*parts)).alias("b")).select(
        "b.range", *by, "feature", "b.lower", "b.upper")


def attach_bounds(df: DataFrame, cols: Sequence[str], by: Sequence[str], bounds: DataFrame,
                  id_cols: Sequence[str] = ()) -> DataFrame:
    """Unpivot the rows and equi-join them with the (group, feature) bounds table.

    The bounds table has ranges × groups × columns rows; AQE broadcasts it when it is small.
    """
    lv = long_values(df, cols, list(id_cols) + list(by)).where(F.col("value").isNotNull())
    return attach(lv, bounds, list(by) + ["feature"], how="inner")


def clip_impact(df: DataFrame, cols: Sequence[str], by: Sequence[str], ranges: Mapping[str, tuple],
                exact: bool = True) -> DataFrame:
    """Per range × group × feature: bounds, valid n, below, above, clipped, clipped %."""
    b = quantile_bounds(df, cols, by, ranges, exact)
    j = attach_bounds(df, cols, by, b)
    g = j.groupBy("range", *by, "feature").agg(
        F.first("lower").alias("lower"), F.first("upper").alias("upper"), F.count(F.lit(1)).alias("valid_n"),
        F.count_if(F.col("value") < F.col("lower")).alias("below"),
        F.count_if(F.col("value") > F.col("upper")).alias("above"))
    return g.select("range", *by, "feature", _r(F.col("lower")).alias("lower"), _r(F.col("upper")).alias("upper"),
                    "valid_n", "below", "above", (F.col("below") + F.col("above")).alias("clipped"),
                    _r((F.col("below") + F.col("above")) * 100.0 / F.col("valid_n")).alias("clipped_pct"))


def clip_impact_rollup(impact: DataFrame) -> DataFrame:
    """One row per range."""
    g = impact.groupBy("range").agg(F.sum("valid_n").alias("valid_n"), F.sum("clipped").alias("clipped"))
    return g.withColumn("clipped_pct", _r(F.col("clipped") * 100.0 / F.col("valid_n")))


def clip_spread(impact: DataFrame, by: Sequence[str]) -> DataFrame:
    """Max − min of clip counts across ranges per group × feature."""
    return impact.groupBy(*by, "feature").agg(
        F.min("clipped").alias("min_clipped"), F.max("clipped").alias("max_clipped"),
        (F.max("clipped") - F.min("clipped")).alias("spread"))


def range_overlap(df: DataFrame, cols: Sequence[str], by: Sequence[str], ranges: Mapping[str, tuple],
                  exact: bool = True) -> DataFrame:
    """For three ranges A, B, C: sizes of the clipped sets and their pairwise
    intersections with % of the smaller, via count_if of flag pairs (no set materialisation)."""
    names = list(ranges)
    if len(names) != 3:
        raise ValueError("range_overlap takes exactly three ranges")
    b = quantile_bounds(df, cols, by, ranges, exact)
    wide = b.groupBy(*by, "feature").pivot("range", names).agg(F.first("lower").alias("lo"), F.first("upper").alias("hi"))
    lv = long_values(df, cols, list(by)).where(F.col("value").isNotNull())
    j = attach(lv, wide, list(by) + ["feature"], how="inner")
    flag = {r: (F.col("value") < F.col(f"`{r}_lo`")) | (F.col("value") > F.col(f"`{r}_hi`")) for r in names}
    a, bb, c = names
    g = j.groupBy(*by, "feature").agg(
        F.count_if(flag[a]).alias("n_a"), F.count_if(flag[bb]).alias("n_b"), F.count_if(flag[c]).alias("n_c"),
        F.count_if(flag[a] & flag[bb]).alias("n_ab"), F.count_if(flag[a] & flag[c]).alias("n_ac"),
        F.count_if(flag[bb] & flag[c]).alias("n_bc"))

    def share(inter, small):
        return _r(F.when(F.col(small) > 0, F.col(inter) * 100.0 / F.col(small)).otherwise(F.lit(0.0)))

    return g.select(*by, "feature", "n_a", "n_b", "n_c", "n_ab", "n_ac", "n_bc",
                    share("n_ab", "n_a").alias("pct_ab"), share("n_ac", "n_a").alias("pct_ac"),
                    share("n_bc", "n_b").alias("pct_bc"))


def reference_range_impact(df: DataFrame, cols: Sequence[str], group: str, ref: DataFrame,
                           overall: bool = True) -> DataFrame:
    """Share of values outside *given* ranges per (group, column) — ``ref`` is a parameter
    table (group, column, ref_lo, ref_hi) — plus, with ``overall``, one row per column over all
    groups (group 'ALL'; the group column is then text), from the same aggregation (grouping
    sets); advice <5 keep, <10 review, else adjust."""
    lv = long_values(df, cols, [group]).where(F.col("value").isNotNull())
    j = attach(lv, ref, [group, "feature"], how="inner")
    aggs = [F.count(F.lit(1)).alias("valid_n"), F.count_if(F.col("value") < F.col("ref_lo")).alias("below"),
            F.count_if(F.col("value") > F.col("ref_hi")).alias("above")]
    g = (j.groupingSets([[group, "feature"], ["feature"]], group, "feature").agg(*aggs, F.grouping(group).alias("_all"))
         if overall else j.groupBy(group, "feature").agg(*aggs))
    pct = (F.col("below") + F.col("above")) * 100.0 / F.col("valid_n")
    grp = (F.when(F.col("_all") == 1, F.lit("ALL")).otherwise(F.col(group).cast("string")) if overall
           else F.col(group))
    return g.select(grp.alias(group), "feature", "valid_n", "below", "above", _r(pct).alias("outside_pct"),
                    F.when(pct < 5, "keep").when(pct < 10, "review").otherwise("adjust").alias("advice"))


def reference_range_table(df: DataFrame, cols: Sequence[str], group: str, ref: DataFrame,
                          exact: bool = True) -> DataFrame:
    """Given range next to observed min / p01 / p99 / max per (group, feature)."""
    q = fit_quantiles(df, cols, [0.01, 0.99], ["p01", "p99"], by=[group], exact=exact)
    mm = long_values(df, cols, [group]).groupBy(group, "feature").agg(F.min("value").alias("min"),
                                                                     F.max("value").alias("max"))
    return (ref.join(q, [group, "feature"], "left").join(mm, [group, "feature"], "left")
               .select(group, "feature", "ref_lo", "ref_hi", _r(F.col("min")).alias("min"),
                       _r(F.col("p01")).alias("p01"), _r(F.col("p99")).alias("p99"), _r(F.col("max")).alias("max")))


def iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5, exact: bool = True) -> DataFrame:
    """Q1, Q3, fences, n, outliers, %, outlier min/max, and the >5 % flag."""
    q = fit_quantiles(df, cols, [0.25, 0.75], ["q1", "q3"], exact=exact).select(
        "feature", "q1", "q3", (F.col("q1") - k * (F.col("q3") - F.col("q1"))).alias("lower"),
        (F.col("q3") + k * (F.col("q3") - F.col("q1"))).alias("upper"))
    lv = long_values(df, cols).where(F.col("value").isNotNull())
    out = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    g = lv.join(F.broadcast(q), "feature").groupBy("feature").agg(
        F.first("q1").alias("q1"), F.first("q3").alias("q3"), F.first("lower").alias("lower"),
        F.first("upper").alias("upper"), F.count(F.lit(1)).alias("n"), F.count_if(out).alias("n_outliers"),
        F.min(F.when(out, F.col("value"))).alias("outlier_min"), F.max(F.when(out, F.col("value"))).alias("outlier_max"))
    pct = F.col("n_outliers") * 100.0 / F.col("n")
    return g.select("feature", *[_r(F.col(c)).alias(c) for c in ("q1", "q3", "lower", "upper")], "n", "n_outliers",
                    _r(pct).alias("outlier_pct"), _r(F.col("outlier_min")).alias("outlier_min"),
                    _r(F.col("outlier_max")).alias("outlier_max"), (pct > 5).alias("high_share"))


# -- correlation ----------------------------------------------------------------------------

#: Pairs of columns that one aggregation holds as expressions.
MAX_PAIRS = 1000


def corr_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every pair (a < b), pairwise-complete: few pairs by one aggregation, more than ``MAX_PAIRS`` by
    block products (:mod:`foldwise.operators.gram`)."""
    cols = list(cols)
    if len(cols) * (len(cols) - 1) // 2 > MAX_PAIRS:
        return gram.correlations(df, cols).withColumn("r", _r(F.col("r")))
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs])
    parts = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"{a}__{b}").alias("r"))
             for a, b in pairs]
    return wide.select(F.explode(F.array(*parts)).alias("p")).select("p.col_a", "p.col_b", _r(F.col("p.r")).alias("r"))


def corr_high_pairs(corr: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs with |r| above the threshold."""
    return corr.where(F.abs(F.col("r")) > threshold)


def corr_target(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """R of each feature with the target, plus |r| for ordering."""
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "feature", "r").select(
        "feature", _r(F.col("r")).alias("r"), _r(F.abs(F.col("r"))).alias("abs_r")).orderBy(F.desc("abs_r"), "feature")


# -- group comparisons ----------------------------------------------------------------------

def group_mean_diff(df: DataFrame, cols: Sequence[str], group: str) -> DataFrame:
    """Mean per group and feature, and the spread of group means relative to their mean:
    diff_pct = (max − min) / |mean of group means| × 100."""
    gm = long_values(df, cols, [group]).where(F.col(group).isNotNull()).groupBy("feature", group).agg(
        F.avg("value").alias("mean"))
    s = gm.groupBy("feature").agg(F.max("mean").alias("max_mean"), F.min("mean").alias("min_mean"),
                                 F.avg("mean").alias("mean_of_means"))
    return s.select("feature", _r(F.col("max_mean")).alias("max_mean"), _r(F.col("min_mean")).alias("min_mean"),
                    _r((F.col("max_mean") - F.col("min_mean")) * 100.0 / F.abs(F.col("mean_of_means"))).alias("diff_pct"))


def class_t_stat(df: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """Welch two-sample t statistic per feature between classes 0 and 1, with a two-sided
    p-value by the normal approximation."""
    g = long_values(df, cols, [label]).groupBy("feature").agg(
        *[F.avg(F.when(F.col(label) == k, F.col("value"))).alias(f"m{k}") for k in (0, 1)],
        *[F.var_samp(F.when(F.col(label) == k, F.col("value"))).alias(f"v{k}") for k in (0, 1)],
        *[F.count(F.when(F.col(label) == k, F.col("value"))).alias(f"n{k}") for k in (0, 1)])
    se = F.sqrt(F.col("v1") / F.col("n1") + F.col("v0") / F.col("n0"))
    t = (F.col("m1") - F.col("m0")) / se
    # two-sided normal p-value: erfc(|t| / sqrt 2), via the Abramowitz–Stegun 7.1.26 form
    z = F.abs(t) / F.sqrt(F.lit(2.0))
    u = 1.0 / (1.0 + 0.3275911 * z)
    poly = u * (0.254829592 + u * (-0.284496736 + u * (1.421413741 + u * (-1.453152027 + u * 1.061405429))))
    p = poly * F.exp(-z * z)
    return g.select("feature", "n0", "n1", _r(F.col("m0")).alias("mean0"), _r(F.col("m1")).alias("mean1"),
                    _r(t).alias("t_stat"), _r(p).alias("p_normal"))


def drift_two_tables(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """mean/std/min/max of each feature in both tables side by side (joined on the
    feature name) and whether the right table leaves the left table's range."""
    def stats(df, sfx):
        return long_values(df, cols).groupBy("feature").agg(
            F.avg("value").alias(f"mean_{sfx}"), F.stddev_samp("value").alias(f"std_{sfx}"),
            F.min("value").alias(f"min_{sfx}"), F.max("value").alias(f"max_{sfx}"))
    j = stats(left, "left").join(stats(right, "right"), "feature", "full")
    outside = (F.col("min_right") < F.col("min_left")) | (F.col("max_right") > F.col("max_left"))
    return j.select("feature", *[_r(F.col(f"{s}_{side}")).alias(f"{s}_{side}")
                                for side in ("left", "right") for s in ("mean", "std", "min", "max")],
                    F.coalesce(outside, F.lit(False)).alias("outside_train_range"))


def out_of_range_samples(df: DataFrame, cols: Sequence[str], by: str, bounds: DataFrame, id_col: str,
                         n: int = 10) -> DataFrame:
    """the first ``n`` rows (by id) outside the bounds per group × feature."""
    j = attach_bounds(df, cols, [by], bounds, [id_col])
    j = j.where((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper")))
    w = Window.partitionBy(by, "feature").orderBy(id_col)
    return (j.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
             .select(by, "feature", id_col, _r(F.col("value")).alias("value"), F.col("rn").cast("long").alias("rn")))
