"""Queries over the profiling aggregates (D*, C6–C8, F5–F7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.operators import folds, profile
from foldwise.plans.common import CP_SQL, TARGET, cleaned_profile
from foldwise.plans.registry import query
from foldwise.plans.views_sql import with_views
from foldwise.sources import tables

P_NUM = ["num_a", "num_b", "num_c", "long_tail", "ord_a", "raw_num"]
P_ALL = ["cat_a", "cat_b", "num_a", "num_b", "num_c", "long_tail", "ord_a", "raw_num", "note"]
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
RANGES = {"p1_99": (1.0, 99.0), "p2.5_97.5": (2.5, 97.5), "p5_95": (5.0, 95.0)}


def long_sql(src: str, cols, keys=(), cast_double: bool = True) -> str:
    """UNION ALL unpivot that keeps NULL values (like Spark's unpivot)."""
    k = "".join(f"{c}, " for c in keys)
    val = (lambda c: f"CAST({c} AS DOUBLE)") if cast_double else (lambda c: f"CAST({c} AS VARCHAR)")
    return "\nUNION ALL ".join(f"SELECT {k}'{c}' AS feature, {val(c)} AS value FROM {src}" for c in cols)


def cp_sql(body: str) -> str:
    return with_views(f"WITH {CP_SQL},\n{body.strip()[5:]}" if body.strip().upper().startswith("WITH ")
                      else f"WITH {CP_SQL}\n{body}", "p")


# -- D1 D2 D3 F5 -------------------------------------------------------------------------------

@query("freq_table", "SELECT event_type AS value, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def freq_table(spark, d):
    return profile.freq_table(tables.load(spark, d, "events", ["event_type"]), "event_type")


@query("freq_ratio", """
SELECT quality AS value, count(*) AS n, round(count(*) / (SELECT count(quality) FROM labels), 6) AS share
FROM labels WHERE quality IS NOT NULL GROUP BY 1""")
def freq_ratio(spark, d):
    return profile.freq_ratio(tables.load(spark, d, "labels", ["quality"]), "quality")


@query("imbalance_grade", """
WITH f AS (SELECT quality, count(*) AS n FROM labels WHERE quality IS NOT NULL GROUP BY 1)
SELECT count(*) AS n_classes, max(n) AS max_n, min(n) AS min_n, round(max(n) / min(n), 6) AS ratio,
  CASE WHEN max(n) / min(n) < 1.5 THEN 'balanced' WHEN max(n) / min(n) < 3 THEN 'mild' ELSE 'severe' END AS grade
FROM f""")
def imbalance_grade(spark, d):
    return profile.imbalance(tables.load(spark, d, "labels", ["quality"]), "quality")


@query("top_categories", """
SELECT p_brand AS value, count(*) AS n FROM part WHERE p_brand IS NOT NULL GROUP BY 1
ORDER BY n DESC, value ASC LIMIT 10""")
def top_categories(spark, d):
    return profile.top_categories(tables.load(spark, d, "part", ["p_brand"]), "p_brand", 10)


# -- D4 D5 D6 D30 ------------------------------------------------------------------------------

@query("distinct_counts", with_views(
    f"WITH l AS ({long_sql('p', P_ALL, cast_double=False)})\n"
    "SELECT feature, count(DISTINCT value) AS n_distinct FROM l WHERE value IS NOT NULL GROUP BY feature", "p"))
def distinct_counts(spark, d):
    return profile.distinct_counts(tables.profile(spark, d, with_note=True), P_ALL)


_NULL_SQL = "SELECT feature, count(*) - count(value) AS null_count, count(value) AS non_null, " \
            "round((count(*) - count(value)) * 100.0 / count(*), 6) AS null_pct FROM l GROUP BY feature"


@query("null_profile", with_views(
    f"WITH l AS ({long_sql('p', P_ALL, cast_double=False)}),\nn AS ({_NULL_SQL})\n"
    "SELECT * FROM n WHERE null_count > 0", "p"))
def null_profile(spark, d):
    return profile.null_profile(tables.profile(spark, d, with_note=True), P_ALL)


_G_NUM = ["num_a", "num_b", "num_c", "long_tail", "ord_a"]
_G_CAT = ["cat_a", "cat_b"]


@query("null_grade", with_views(
    f"WITH l AS ({long_sql('p', _G_NUM + _G_CAT, cast_double=False)}),\nn AS ({_NULL_SQL})\n"
    "SELECT feature, null_count, null_pct, "
    "CASE WHEN null_pct > 50 THEN 'high' WHEN null_pct > 20 THEN 'medium' ELSE 'low' END AS grade, "
    f"CASE WHEN feature IN ({', '.join(repr(c) for c in _G_NUM)}) "
    "THEN CASE WHEN null_pct > 30 THEN 'drop_or_flag' ELSE 'median' END "
    "ELSE CASE WHEN null_pct > 30 THEN 'unknown_category' ELSE 'most_frequent' END END AS treatment "
    "FROM n WHERE null_count > 0", "p"))
def null_grade(spark, d):
    return profile.null_grade(tables.profile(spark, d), _G_NUM, _G_CAT)


@query("missing_target_rate", cp_sql(
    f"WITH l AS ({long_sql('cp', P_NUM, ['target'])})\n"
    "SELECT feature, count(*) FILTER (WHERE value IS NULL) AS n_missing, "
    "round(avg(CASE WHEN value IS NULL THEN target END), 6) AS rate_missing, round(avg(target), 6) AS rate_all "
    "FROM l GROUP BY feature"))
def missing_target_rate(spark, d):
    return profile.missing_target_rate(cleaned_profile(spark, d), P_NUM, TARGET)


# -- D7 D8 -------------------------------------------------------------------------------------

def _describe_sql(src_long: str, keys=(), extra=False) -> str:
    k = "".join(f"{c}, " for c in keys)
    q = [("q1", 0.25), ("median", 0.5), ("q3", 0.75)] + ([("p01", 0.01), ("p99", 0.99)] if extra else [])
    s = (f"SELECT {k}feature, count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, "
         f"round(min(value), 6) AS min, "
         + ", ".join(f"round(quantile_cont(value, {p}), 6) AS {n}" for n, p in q)
         + ", round(max(value), 6) AS max")
    if extra:
        s += ", round(count(*) FILTER (WHERE value IS NULL) * 100.0 / count(*), 6) AS missing_pct"
    return s + f" FROM ({src_long}) GROUP BY {k}feature"


@query("describe_all", _describe_sql(long_sql("lineitem", LI_NUM)))
def describe_all(spark, d):
    return profile.describe(tables.load(spark, d, "lineitem", LI_NUM), LI_NUM)


@query("describe_by_group", cp_sql(_describe_sql(long_sql("cp", P_NUM, ["target"]), ["target"], extra=True)))
def describe_by_group(spark, d):
    return profile.describe(cleaned_profile(spark, d), P_NUM, by=[TARGET], extra_quantiles=True)


# -- C7 D9 D10 D11 D13 on lineitem by return flag ----------------------------------------------

LI_Q = ["l_quantity", "l_extendedprice"]


def _bounds_sql(src: str, cols, key: str) -> str:
    parts = []
    for r, (lo, hi) in RANGES.items():
        parts.append(f"SELECT '{r}' AS range, {key}, feature, quantile_cont(value, {lo / 100}) AS lower, "
                     f"quantile_cont(value, {hi / 100}) AS upper FROM l WHERE value IS NOT NULL GROUP BY {key}, feature")
    return f"l AS ({long_sql(src, cols, [key])}),\nb AS ({' UNION ALL '.join(parts)})"


_IMPACT_SQL = ("i AS (SELECT b.range, b.{k}, b.feature, round(any_value(b.lower), 6) AS lower, "
               "round(any_value(b.upper), 6) AS upper, count(*) AS valid_n, "
               "count(*) FILTER (WHERE l.value < b.lower) AS below, count(*) FILTER (WHERE l.value > b.upper) AS above, "
               "count(*) FILTER (WHERE l.value < b.lower OR l.value > b.upper) AS clipped, "
               "round(count(*) FILTER (WHERE l.value < b.lower OR l.value > b.upper) * 100.0 / count(*), 6) AS clipped_pct "
               "FROM l JOIN b ON l.{k} = b.{k} AND l.feature = b.feature WHERE l.value IS NOT NULL "
               "GROUP BY b.range, b.{k}, b.feature)")


def _li_impact(spark, d):
    li = tables.load(spark, d, "lineitem", ["l_returnflag"] + LI_Q)
    return profile.clip_impact(li, LI_Q, ["l_returnflag"], RANGES)


@query("quantile_bounds", f"WITH {_bounds_sql('lineitem', LI_Q, 'l_returnflag')}\n"
       "SELECT range, l_returnflag, feature, round(lower, 6) AS lower, round(upper, 6) AS upper FROM b")
def quantile_bounds(spark, d):
    li = tables.load(spark, d, "lineitem", ["l_returnflag"] + LI_Q)
    b = profile.quantile_bounds(li, LI_Q, ["l_returnflag"], RANGES)
    return b.select("range", "l_returnflag", "feature", F.round("lower", 6).alias("lower"),
                    F.round("upper", 6).alias("upper"))


_IMPACT_WITH = f"WITH {_bounds_sql('lineitem', LI_Q, 'l_returnflag')},\n" + _IMPACT_SQL.format(k="l_returnflag")


@query("clip_impact", _IMPACT_WITH + "\nSELECT * FROM i")
def clip_impact(spark, d):
    return _li_impact(spark, d)


@query("clip_impact_rollup", _IMPACT_WITH + "\nSELECT range, sum(valid_n)::BIGINT AS valid_n, "
       "sum(clipped)::BIGINT AS clipped, round(sum(clipped) * 100.0 / sum(valid_n), 6) AS clipped_pct FROM i GROUP BY range")
def clip_impact_rollup(spark, d):
    return profile.clip_impact_rollup(_li_impact(spark, d))


@query("clip_spread", _IMPACT_WITH + "\nSELECT l_returnflag, feature, min(clipped) AS min_clipped, "
       "max(clipped) AS max_clipped, max(clipped) - min(clipped) AS spread FROM i GROUP BY l_returnflag, feature")
def clip_spread(spark, d):
    return profile.clip_spread(_li_impact(spark, d), ["l_returnflag"])


# -- C6 D12 G3 range overlap on the profile by target -----------------------------------------

_OV_COLS = ["num_a", "num_b", "num_c"]


@query("range_overlap", cp_sql(
    f"WITH {_bounds_sql('cp', _OV_COLS, 'target')},\n"
    "w AS (SELECT target, feature, "
    + ", ".join(f"any_value(lower) FILTER (WHERE range = '{r}') AS lo{i}, any_value(upper) FILTER (WHERE range = '{r}') AS hi{i}"
                for i, r in enumerate(RANGES))
    + " FROM b GROUP BY target, feature),\n"
    "f AS (SELECT l.target, l.feature, (value < lo0 OR value > hi0) AS fa, (value < lo1 OR value > hi1) AS fb, "
    "(value < lo2 OR value > hi2) AS fc FROM l JOIN w ON l.target = w.target AND l.feature = w.feature WHERE value IS NOT NULL),\n"
    "g AS (SELECT target, feature, count(*) FILTER (WHERE fa) AS n_a, count(*) FILTER (WHERE fb) AS n_b, "
    "count(*) FILTER (WHERE fc) AS n_c, count(*) FILTER (WHERE fa AND fb) AS n_ab, count(*) FILTER (WHERE fa AND fc) AS n_ac, "
    "count(*) FILTER (WHERE fb AND fc) AS n_bc FROM f GROUP BY target, feature)\n"
    "SELECT target, feature, n_a, n_b, n_c, n_ab, n_ac, n_bc, "
    "round(CASE WHEN n_a > 0 THEN n_ab * 100.0 / n_a ELSE 0.0 END, 6) AS pct_ab, "
    "round(CASE WHEN n_a > 0 THEN n_ac * 100.0 / n_a ELSE 0.0 END, 6) AS pct_ac, "
    "round(CASE WHEN n_b > 0 THEN n_bc * 100.0 / n_b ELSE 0.0 END, 6) AS pct_bc FROM g"))
def range_overlap(spark, d):
    return profile.range_overlap(cleaned_profile(spark, d), _OV_COLS, [TARGET], RANGES)


# -- D14 D15 reference ranges ------------------------------------------------------------------

# Parameter table of the fixture: given (target, feature) → (ref_lo, ref_hi).
REF_RANGES = [(1, "num_a", 150.0, 200.0), (0, "num_a", 140.0, 190.0), (1, "num_b", 50.0, 90.0), (0, "num_b", 40.0, 80.0)]
_REF_SQL = ("r AS (SELECT target, feature, CAST(ref_lo AS DOUBLE) AS ref_lo, CAST(ref_hi AS DOUBLE) AS ref_hi FROM (VALUES "
            + ", ".join(f"({t}, '{c}', {lo}, {hi})" for t, c, lo, hi in REF_RANGES) + ") AS r(target, feature, ref_lo, ref_hi))")


def _ref(spark):
    return spark.createDataFrame(REF_RANGES, "target int, feature string, ref_lo double, ref_hi double")


@query("reference_range_impact", cp_sql(
    f"WITH l AS ({long_sql('cp', ['num_a', 'num_b'], ['target'])}),\n{_REF_SQL},\n"
    "g AS (SELECT CASE WHEN grouping(l.target) = 1 THEN 'ALL' ELSE CAST(l.target AS VARCHAR) END AS target, l.feature, count(*) AS valid_n, count(*) FILTER (WHERE value < ref_lo) AS below, "
    "count(*) FILTER (WHERE value > ref_hi) AS above FROM l JOIN r ON l.target = r.target AND l.feature = r.feature "
    "WHERE value IS NOT NULL GROUP BY GROUPING SETS ((l.target, l.feature), (l.feature)))\n"
    "SELECT target, feature, valid_n, below, above, round((below + above) * 100.0 / valid_n, 6) AS outside_pct, "
    "CASE WHEN (below + above) * 100.0 / valid_n < 5 THEN 'keep' WHEN (below + above) * 100.0 / valid_n < 10 "
    "THEN 'review' ELSE 'adjust' END AS advice FROM g"))
def reference_range_impact(spark, d):
    return profile.reference_range_impact(cleaned_profile(spark, d), ["num_a", "num_b"], TARGET, _ref(spark))


@query("reference_range_table", cp_sql(
    f"WITH l AS ({long_sql('cp', ['num_a', 'num_b'], ['target'])}),\n{_REF_SQL},\n"
    "s AS (SELECT target, feature, min(value) AS mn, quantile_cont(value, 0.01) AS p01, "
    "quantile_cont(value, 0.99) AS p99, max(value) AS mx FROM l GROUP BY target, feature)\n"
    "SELECT r.target, r.feature, r.ref_lo, r.ref_hi, round(mn, 6) AS min, round(p01, 6) AS p01, round(p99, 6) AS p99, "
    "round(mx, 6) AS max FROM r LEFT JOIN s ON r.target = s.target AND r.feature = s.feature"))
def reference_range_table(spark, d):
    return profile.reference_range_table(cleaned_profile(spark, d), ["num_a", "num_b"], TARGET, _ref(spark))


# -- D16 IQR ------------------------------------------------------------------------------------

def _iqr_sql(src: str, cols) -> str:
    return (f"WITH l AS ({long_sql(src, cols)}),\n"
            "q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM l "
            "WHERE value IS NOT NULL GROUP BY feature),\n"
            "b AS (SELECT feature, q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q),\n"
            "g AS (SELECT b.feature, any_value(q1) AS q1, any_value(q3) AS q3, any_value(lower) AS lower, "
            "any_value(upper) AS upper, count(*) AS n, count(*) FILTER (WHERE value < lower OR value > upper) AS n_outliers, "
            "min(value) FILTER (WHERE value < lower OR value > upper) AS omin, "
            "max(value) FILTER (WHERE value < lower OR value > upper) AS omax "
            "FROM l JOIN b ON l.feature = b.feature WHERE value IS NOT NULL GROUP BY b.feature)\n"
            "SELECT feature, round(q1, 6) AS q1, round(q3, 6) AS q3, round(lower, 6) AS lower, round(upper, 6) AS upper, "
            "n, n_outliers, round(n_outliers * 100.0 / n, 6) AS outlier_pct, round(omin, 6) AS outlier_min, "
            "round(omax, 6) AS outlier_max, n_outliers * 100.0 / n > 5 AS high_share FROM g")


@query("iqr_outliers", _iqr_sql("lineitem", LI_NUM))
def iqr_outliers(spark, d):
    return profile.iqr_outliers(tables.load(spark, d, "lineitem", LI_NUM), LI_NUM)


@query("iqr_outliers_orders", _iqr_sql("orders", ["o_totalprice"]))
def iqr_outliers_orders(spark, d):
    return profile.iqr_outliers(tables.load(spark, d, "orders", ["o_totalprice"]), ["o_totalprice"])


# -- D17 D18 D19 ---------------------------------------------------------------------------------

def _pairs(cols):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


_CORR_SQL = " UNION ALL ".join(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM lineitem"
                               for a, b in _pairs(LI_NUM))


@query("corr_long", _CORR_SQL)
def corr_long(spark, d):
    return profile.corr_long(tables.load(spark, d, "lineitem", LI_NUM), LI_NUM)


@query("corr_high_pairs", f"SELECT * FROM ({_CORR_SQL}) WHERE abs(r) > 0.5")
def corr_high_pairs(spark, d):
    return profile.corr_high_pairs(corr_long(spark, d), 0.5)


@query("corr_target", cp_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr({c}, target), 6) AS r, round(abs(corr({c}, target)), 6) AS abs_r FROM cp"
    for c in P_NUM)))
def corr_target(spark, d):
    return profile.corr_target(cleaned_profile(spark, d), P_NUM, TARGET)


# -- D20 F6 D29 ----------------------------------------------------------------------------------

_GM_SQL = (f"WITH l AS ({long_sql('p', P_NUM, ['cat_b'])}),\n"
           "gm AS (SELECT feature, cat_b, avg(value) AS mean FROM l WHERE cat_b IS NOT NULL GROUP BY feature, cat_b),\n"
           "s AS (SELECT feature, round(max(mean), 6) AS max_mean, round(min(mean), 6) AS min_mean, "
           "round((max(mean) - min(mean)) * 100.0 / abs(avg(mean)), 6) AS diff_pct FROM gm GROUP BY feature)\n")


def _gm(spark, d):
    p = tables.profile(spark, d).select("cat_b", *[F.col(c) for c in P_NUM[:-1]],
                                        F.col("raw_num").try_cast("double").alias("raw_num"))
    return profile.group_mean_diff(p, P_NUM, "cat_b")


@query("group_mean_diff", with_views(_GM_SQL.replace("FROM p", "FROM pp").replace(
    "WITH l AS", "WITH pp AS (SELECT cat_b, num_a, num_b, num_c, long_tail, ord_a, TRY_CAST(raw_num AS DOUBLE) AS raw_num FROM p),\nl AS")
    + "SELECT * FROM s", "p"))
def group_mean_diff(spark, d):
    return _gm(spark, d)


@query("top_diff", with_views(_GM_SQL.replace("FROM p", "FROM pp").replace(
    "WITH l AS", "WITH pp AS (SELECT cat_b, num_a, num_b, num_c, long_tail, ord_a, TRY_CAST(raw_num AS DOUBLE) AS raw_num FROM p),\nl AS")
    + "SELECT * FROM s ORDER BY diff_pct DESC, feature ASC LIMIT 6", "p"))
def top_diff(spark, d):
    return _gm(spark, d).orderBy(F.desc("diff_pct"), F.asc("feature")).limit(6)


@query("class_t_stat", cp_sql(
    f"WITH l AS ({long_sql('cp', P_NUM, ['target'])}),\n"
    "g AS (SELECT feature, count(value) FILTER (WHERE target = 0) AS n0, count(value) FILTER (WHERE target = 1) AS n1, "
    "avg(value) FILTER (WHERE target = 0) AS m0, avg(value) FILTER (WHERE target = 1) AS m1, "
    "var_samp(value) FILTER (WHERE target = 0) AS v0, var_samp(value) FILTER (WHERE target = 1) AS v1 FROM l GROUP BY feature),\n"
    "t AS (SELECT *, (m1 - m0) / sqrt(v1 / n1 + v0 / n0) AS t FROM g),\n"
    "z AS (SELECT *, abs(t) / sqrt(2.0) AS z, 1.0 / (1.0 + 0.3275911 * abs(t) / sqrt(2.0)) AS u FROM t)\n"
    "SELECT feature, n0, n1, round(m0, 6) AS mean0, round(m1, 6) AS mean1, round(t, 6) AS t_stat, "
    "round(u * (0.254829592 + u * (-0.284496736 + u * (1.421413741 + u * (-1.453152027 + u * 1.061405429)))) * exp(-z * z), 6) AS p_normal "
    "FROM z"))
def class_t_stat(spark, d):
    return profile.class_t_stat(cleaned_profile(spark, d), P_NUM, TARGET)


# -- C8 D21 drift between the training part and the hold-out part ------------------------------

_DRIFT_COLS = ["num_a", "num_b", "num_c", "long_tail"]


@query("drift_two_tables", with_views(
    f"WITH tr AS (SELECT * FROM p WHERE NOT ({folds.holdout_sql('id')})),\n"
    f"te AS (SELECT * FROM p WHERE {folds.holdout_sql('id')}),\n"
    f"a AS (SELECT feature, avg(value) AS mean_left, stddev_samp(value) AS std_left, min(value) AS min_left, max(value) AS max_left "
    f"FROM ({long_sql('tr', _DRIFT_COLS)}) GROUP BY feature),\n"
    f"b AS (SELECT feature, avg(value) AS mean_right, stddev_samp(value) AS std_right, min(value) AS min_right, max(value) AS max_right "
    f"FROM ({long_sql('te', _DRIFT_COLS)}) GROUP BY feature)\n"
    "SELECT coalesce(a.feature, b.feature) AS feature, round(mean_left, 6) AS mean_left, round(std_left, 6) AS std_left, "
    "round(min_left, 6) AS min_left, round(max_left, 6) AS max_left, round(mean_right, 6) AS mean_right, "
    "round(std_right, 6) AS std_right, round(min_right, 6) AS min_right, round(max_right, 6) AS max_right, "
    "coalesce(min_right < min_left OR max_right > max_left, false) AS outside_train_range "
    "FROM a FULL JOIN b ON a.feature = b.feature", "p"))
def drift_two_tables(spark, d):
    train, test = folds.holdout_split(tables.profile(spark, d), "id")
    return profile.drift_two_tables(train, test, _DRIFT_COLS)


# -- F7 ------------------------------------------------------------------------------------------

@query("out_of_range_samples", cp_sql(
    f"WITH l AS ({long_sql('cp', _OV_COLS, ['target', 'id'])}),\n"
    "b AS (SELECT target, feature, quantile_cont(value, 0.05) AS lower, quantile_cont(value, 0.95) AS upper "
    "FROM l WHERE value IS NOT NULL GROUP BY target, feature),\n"
    "o AS (SELECT l.target, l.feature, l.id, l.value, row_number() OVER (PARTITION BY l.target, l.feature ORDER BY l.id) AS rn "
    "FROM l JOIN b ON l.target = b.target AND l.feature = b.feature WHERE value < lower OR value > upper)\n"
    "SELECT target, feature, id, round(value, 6) AS value, rn FROM o WHERE rn <= 10"))
def out_of_range_samples(spark, d):
    cp = cleaned_profile(spark, d)
    b = profile.quantile_bounds(cp, _OV_COLS, [TARGET], {"p5_95": (5.0, 95.0)}).drop("range")
    return profile.out_of_range_samples(cp, _OV_COLS, TARGET, b, "id", 10)
