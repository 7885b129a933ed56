"""Queries over the learnt operators: clip bounds, imputers, scalers, chains, encoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.functions import exprs
from foldwise.operators import bounds, impute
from foldwise.plans.common import TARGET, cleaned_profile, r6
from foldwise.plans.registry import query
from foldwise.plans.views_sql import with_views


def target_profile(spark, d):
    """Flagship: clean → quantile clip (1–99 %) → median impute → derived ratios → aggregate
    by target. Fitting is two one-pass aggregations; applying is a projection."""
    x = cleaned_profile(spark, d).select("id", TARGET, "num_a", "num_b")
    cols = ["num_a", "num_b"]
    x = bounds.apply_clip_bounds(x, bounds.fit_clip_bounds(x, cols, 1, 99))
    x = impute.apply_fill(x, impute.fit_simple(x, cols, "median"))
    x = x.select(TARGET, "num_a", "num_b",
                 exprs.safe_ratio("num_b", "num_a").alias("ratio"),
                 exprs.scaled_power_ratio("num_b", "num_a", 2).alias("bmi"))
    return x.groupBy(TARGET).agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("num_a")).alias("mean_num_a"),
        r6(F.avg("num_b")).alias("mean_num_b"), r6(F.avg("ratio")).alias("mean_ratio"),
        r6(F.avg("bmi")).alias("mean_bmi"))


query("target_profile", with_views("""
WITH x AS (SELECT CAST(CASE target_raw WHEN 1 THEN 1 WHEN 2 THEN 0 END AS INTEGER) AS target, num_a, num_b FROM p),
b AS (SELECT quantile_cont(num_a, 0.01) AS a_lo, quantile_cont(num_a, 0.99) AS a_hi,
             quantile_cont(num_b, 0.01) AS b_lo, quantile_cont(num_b, 0.99) AS b_hi FROM x),
c AS (SELECT target,
        CASE WHEN num_a IS NULL THEN NULL ELSE least(greatest(num_a, a_lo), a_hi) END AS num_a,
        CASE WHEN num_b IS NULL THEN NULL ELSE least(greatest(num_b, b_lo), b_hi) END AS num_b
      FROM x, b),
m AS (SELECT quantile_cont(num_a, 0.5) AS ma, quantile_cont(num_b, 0.5) AS mb FROM c),
f AS (SELECT target, coalesce(num_a, ma) AS num_a, coalesce(num_b, mb) AS num_b FROM c, m)
SELECT target, count(*) AS n, round(avg(num_a), 6) AS mean_num_a, round(avg(num_b), 6) AS mean_num_b,
  round(avg(num_b / CASE WHEN num_a IS NULL OR num_a = 0 THEN 1e-6 ELSE num_a END), 6) AS mean_ratio,
  round(avg(num_b / pow(CASE WHEN num_a IS NULL OR num_a / 100 = 0 THEN 1e-6 ELSE num_a / 100 END, 2)), 6) AS mean_bmi
FROM f GROUP BY target
""", "p"))(target_profile)


# ---------------------------------------------------------------------------------------------
# Imputers, clipping, scaling, chains, encoders, derived features, binning, fold-wise params
# ---------------------------------------------------------------------------------------------

from foldwise.operators import derive, encode, folds, scale  # noqa: E402
from foldwise.plans.common import CP_SQL  # noqa: E402
from foldwise.session import materialize  # noqa: E402
from foldwise.sources import tables  # noqa: E402

IMP_COLS = ["num_a", "num_b", "num_c", "long_tail", "ord_a"]
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _cp(body: str) -> str:
    b = body.strip()
    if b.upper().startswith("WITH "):
        return with_views(f"WITH {CP_SQL},\n{b[5:]}", "p")
    return with_views(f"WITH {CP_SQL}\n{b}", "p")


def _out(x, key_cols, cols):
    return x.select(*key_cols, *[r6(c).alias(c) for c in cols])


def _sel_sql(keys, cols, src, exprs_by_col):
    return "SELECT " + ", ".join(list(keys) + [f"round({exprs_by_col[c]}, 6) AS {c}" for c in cols]) + f" FROM {src}"


def _fill_sql(stat_sql: str) -> str:
    stats = ", ".join(f"{stat_sql.format(c=c)} AS s_{c}" for c in IMP_COLS)
    return _cp(f"WITH s AS (SELECT {stats} FROM cp)\n"
               + _sel_sql(["id"], IMP_COLS, "cp, s", {c: f"coalesce({c}, s_{c})" for c in IMP_COLS}))


@query("impute_median", _fill_sql("quantile_cont({c}, 0.5)"))
def impute_median(spark, d):
    x = cleaned_profile(spark, d).select("id", *IMP_COLS)
    return _out(impute.apply_fill(x, impute.fit_simple(x, IMP_COLS, "median")), ["id"], IMP_COLS)


@query("impute_mean", _fill_sql("avg({c})"))
def impute_mean(spark, d):
    x = cleaned_profile(spark, d).select("id", *IMP_COLS)
    return _out(impute.apply_fill(x, impute.fit_simple(x, IMP_COLS, "mean")), ["id"], IMP_COLS)


# Per-group constants, chosen inside the ranges of view P (num_a from about 133 to 207, num_b from 40 to 120).
GROUP_CONSTANTS = {0: {"num_a": 190.0, "num_b": 96.0}, 1: {"num_a": 150.0, "num_b": 64.0}}


@query("impute_constant_by_group", _cp(
    "SELECT id, round(coalesce(num_a, CASE target WHEN 1 THEN 150.0 WHEN 0 THEN 190.0 END, 170.0), 6) AS num_a, "
    "round(coalesce(num_b, CASE target WHEN 1 THEN 64.0 WHEN 0 THEN 96.0 END, 80.0), 6) AS num_b FROM cp"))
def impute_constant_by_group(spark, d):
    x = cleaned_profile(spark, d).select("id", TARGET, "num_a", "num_b")
    x = impute.fill_constant_by_group(x, TARGET, GROUP_CONSTANTS, ["num_a", "num_b"])
    return _out(x, ["id"], ["num_a", "num_b"])


def _text_mode(c: str) -> str:
    return f"(SELECT {c} FROM cp WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query("impute_text", _cp(
    "SELECT id, coalesce(cat_a, '-1') AS cat_a_new, coalesce(cat_b, '-1') AS cat_b_new, "
    f"coalesce(cat_a, {_text_mode('cat_a')}) AS cat_a_old, coalesce(cat_b, {_text_mode('cat_b')}) AS cat_b_old FROM cp"))
def impute_text(spark, d):
    """I6 on categorical columns, both presets."""
    x = cleaned_profile(spark, d).select("id", *[F.col(c).alias(f"{c}_{m}") for m in ("new", "old") for c in ("cat_a", "cat_b")])
    for m in ("new", "old"):
        cols = [f"cat_a_{m}", f"cat_b_{m}"]
        x = impute.apply_fill_text(x, impute.fit_simple_text(x, cols, **impute.preset_text(m)))
    return x


@query("impute_group_mean", _cp(
    "WITH c AS (SELECT cat_b, cat_a, avg(num_a) AS ca, avg(num_b) AS cb FROM cp "
    "WHERE cat_b IS NOT NULL AND cat_a IS NOT NULL GROUP BY cat_b, cat_a),\n"
    "pa AS (SELECT cat_b, avg(num_a) AS pa, avg(num_b) AS pb FROM cp WHERE cat_b IS NOT NULL GROUP BY cat_b),\n"
    "g AS (SELECT avg(num_a) AS ga, avg(num_b) AS gb FROM cp)\n"
    "SELECT cp.id, round(coalesce(cp.num_a, c.ca, pa.pa, g.ga), 6) AS num_a, round(coalesce(cp.num_b, c.cb, pa.pb, g.gb), 6) AS num_b "
    "FROM cp LEFT JOIN c ON cp.cat_b = c.cat_b AND cp.cat_a = c.cat_a LEFT JOIN pa ON cp.cat_b = pa.cat_b, g"))
def impute_group_mean(spark, d):
    x = cleaned_profile(spark, d).select("id", "cat_a", "cat_b", "num_a", "num_b")
    cols = ["num_a", "num_b"]
    x = impute.apply_group_means(x, impute.fit_group_means(x, "cat_b", "cat_a", cols), "cat_b", "cat_a", cols)
    return _out(x, ["id"], cols)


@query("impute_simple", _cp(
    "WITH m AS (SELECT ord_a AS v, count(*) AS n FROM cp WHERE ord_a IS NOT NULL GROUP BY 1),\n"
    "mo AS (SELECT v FROM m ORDER BY n DESC, v ASC LIMIT 1),\n"
    "n AS (SELECT num_c AS v, count(*) AS n FROM cp WHERE num_c IS NOT NULL GROUP BY 1),\n"
    "no AS (SELECT v FROM n ORDER BY n DESC, v ASC LIMIT 1)\n"
    "SELECT id, round(coalesce(ord_a, (SELECT v FROM mo)), 6) AS ord_a, round(coalesce(num_c, (SELECT v FROM no)), 6) AS num_c, "
    "round(coalesce(long_tail, -1.0), 6) AS long_tail FROM cp"))
def impute_simple(spark, d):
    x = cleaned_profile(spark, d).select("id", "ord_a", "num_c", "long_tail")
    x = impute.apply_fill(x, impute.fit_simple(x, ["ord_a", "num_c"], **impute.preset("old")))
    x = impute.apply_fill(x, impute.fit_simple(x, ["long_tail"], **impute.preset("new")))
    return _out(x, ["id"], ["ord_a", "num_c", "long_tail"])


def _clip_sql(src: str, cols, lo=0.01, hi=0.99, keys=("id",)) -> str:
    b = ", ".join(f"quantile_cont({c}, {lo}) AS lo_{c}, quantile_cont({c}, {hi}) AS hi_{c}" for c in cols)
    return (f"b AS (SELECT {b} FROM {src}),\nclipped AS (SELECT " + ", ".join(keys) + ", "
            + ", ".join(f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, lo_{c}), hi_{c}) END AS {c}" for c in cols)
            + f" FROM {src}, b)")


@query("clip_quantile", _cp(f"WITH {_clip_sql('cp', IMP_COLS)}\n" + _sel_sql(["id"], IMP_COLS, "clipped", {c: c for c in IMP_COLS})))
def clip_quantile(spark, d):
    x = cleaned_profile(spark, d).select("id", *IMP_COLS)
    return _out(bounds.clip_quantile(x, IMP_COLS, 1, 99), ["id"], IMP_COLS)


def _scale_sql(center: str, scl: str) -> str:
    st = ", ".join(f"{center.format(c=c)} AS c_{c}, CASE WHEN {scl.format(c=c)} = 0 THEN 1.0 ELSE {scl.format(c=c)} END AS s_{c}"
                   for c in LI_NUM)
    return (f"WITH s AS (SELECT {st} FROM lineitem)\n"
            + _sel_sql(["l_orderkey", "l_linenumber"], LI_NUM, "lineitem, s", {c: f"({c} - c_{c}) / s_{c}" for c in LI_NUM}))


def _scale_q(kind):
    def fn(spark, d):
        li = tables.load(spark, d, "lineitem", ["l_orderkey", "l_linenumber"] + LI_NUM)
        return _out(scale.scale(li, LI_NUM, kind), ["l_orderkey", "l_linenumber"], LI_NUM)
    return fn


query("scale_standard", _scale_sql("avg({c})", "stddev_pop({c})"))(_scale_q("standard"))
query("scale_minmax", _scale_sql("min({c})", "(max({c}) - min({c}))"))(_scale_q("minmax"))
query("scale_robust", _scale_sql("quantile_cont({c}, 0.5)", "(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"))(
    _scale_q("robust"))

_NUM3 = ["num_a", "num_b", "num_c"]


def _std_sql(src: str, cols, keys=("id",)) -> str:
    st = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}" for c in cols)
    return f"st AS (SELECT {st} FROM {src})\n" + _sel_sql(keys, cols, f"{src}, st", {c: f"({c} - m_{c}) / s_{c}" for c in cols})


@query("numeric_chain", _cp(
    "WITH md AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS md_{c}" for c in _NUM3) + " FROM cp),\n"
    "imp AS (SELECT id, " + ", ".join(f"coalesce({c}, md_{c}) AS {c}" for c in _NUM3) + " FROM cp, md),\n"
    + _clip_sql("imp", _NUM3) + ",\n" + _std_sql("clipped", _NUM3)))
def numeric_chain(spark, d):
    x = cleaned_profile(spark, d).select("id", *_NUM3)
    return _out(scale.numeric_chain(x, _NUM3), ["id"], _NUM3)


@query("longtail_chain", _cp(
    "WITH md AS (SELECT quantile_cont(long_tail, 0.5) AS md FROM cp),\n"
    "imp AS (SELECT id, ln(1 + CASE WHEN coalesce(long_tail, md) IS NULL THEN NULL ELSE greatest(coalesce(long_tail, md), 0.0) END) "
    "AS long_tail FROM cp, md),\n" + _std_sql("imp", ["long_tail"])))
def longtail_chain(spark, d):
    x = cleaned_profile(spark, d).select("id", "long_tail")
    return _out(scale.longtail_chain(x, ["long_tail"]), ["id"], ["long_tail"])


@query("ordinal_chain", _cp(
    "WITH m AS (SELECT ord_a AS v, count(*) AS n FROM cp WHERE ord_a IS NOT NULL GROUP BY 1),\n"
    "mo AS (SELECT v FROM m ORDER BY n DESC, v ASC LIMIT 1)\n"
    "SELECT id, round(coalesce(ord_a, (SELECT v FROM mo)), 6) AS ord_a FROM cp"))
def ordinal_chain(spark, d):
    x = cleaned_profile(spark, d).select("id", "ord_a")
    return _out(scale.ordinal_chain(x, ["ord_a"]), ["id"], ["ord_a"])


# -- I17 one-hot: fit on the training part, apply to the hold-out part -------------------------

_OH = ["cat_a", "cat_b"]


@query("one_hot_fit_apply", with_views(
    f"WITH tr AS (SELECT * FROM p WHERE NOT ({folds.holdout_sql('id')})),\n"
    f"te AS (SELECT * FROM p WHERE {folds.holdout_sql('id')}),\n"
    "cats AS (SELECT DISTINCT 'cat_a' AS feature, cat_a AS category FROM tr WHERE cat_a IS NOT NULL "
    "UNION ALL SELECT DISTINCT 'cat_b', cat_b FROM tr WHERE cat_b IS NOT NULL),\n"
    "l AS (SELECT id, 'cat_a' AS feature, cat_a AS v FROM te UNION ALL SELECT id, 'cat_b', cat_b FROM te)\n"
    "SELECT l.id, l.feature, c.category FROM l LEFT JOIN cats c ON l.feature = c.feature AND l.v = c.category", "p"))
def one_hot_fit_apply(spark, d):
    train, test = folds.holdout_split(tables.profile(spark, d).select("id", *_OH), "id")
    cats = encode.one_hot_columns(encode.fit_one_hot(train, _OH))
    return encode.one_hot_long(test, "id", cats)


# -- H1 H2 H3 H4 I28 -------------------------------------------------------------------------------

def _den(e: str) -> str:
    return f"CASE WHEN {e} IS NULL OR {e} = 0 THEN 1e-6 ELSE {e} END"


@query("derived_ratios", _cp(
    "WITH md AS (SELECT quantile_cont(num_a, 0.5) AS ma, quantile_cont(num_b, 0.5) AS mb FROM cp),\n"
    "x AS (SELECT id, coalesce(num_a, ma) AS a, coalesce(num_b, mb) AS b FROM cp, md)\n"
    f"SELECT id, round(b / {_den('a')}, 6) AS ratio, round(b / pow({_den('a / 100')}, 2), 6) AS bmi, "
    f"round(b / pow({_den('a / 100')}, 3), 6) AS ponderal, round(CASE WHEN b = 0 THEN NULL ELSE a / b END, 6) AS reverse_ratio, "
    "round(a + b, 6) AS total FROM x"))
def derived_ratios(spark, d):
    x = cleaned_profile(spark, d).select("id", "num_a", "num_b")
    x = impute.apply_fill(x, impute.fit_simple(x, ["num_a", "num_b"], "median"))
    flags = {"ratio": True, "bmi": True, "ponderal": True, "reverse_ratio": True, "total": True}
    y = derive.engineer_features(x, "num_b", "num_a", flags)
    return y.select("id", *[r6(c).alias(c) for c in flags])


# -- H7 binning ---------------------------------------------------------------------------------

SIZE_EDGES, SIZE_LABELS = [0, 10, 20, 30, 40, 50], ["xs", "s", "m", "l", "xl"]
PRICE_EDGES, PRICE_LABELS = [900.0, 925.0, 950.0, 975.0, 999.0], ["low", "mid", "high", "top"]


def _bin_sql(c, edges, labels):
    whens = " ".join(f"WHEN {c} > {edges[i]} AND {c} <= {edges[i + 1]} THEN '{lab}'" for i, lab in enumerate(labels))
    return f"CASE {whens} END"


@query("bin_right_closed", f"SELECT p_partkey, {_bin_sql('p_size', SIZE_EDGES, SIZE_LABELS)} AS size_bin, "
       f"{_bin_sql('p_retailprice', PRICE_EDGES, PRICE_LABELS)} AS price_bin FROM part")
def bin_right_closed(spark, d):
    p = tables.load(spark, d, "part", ["p_partkey", "p_size", "p_retailprice"])
    return p.select("p_partkey", exprs.bin_right_closed("p_size", SIZE_EDGES, SIZE_LABELS).alias("size_bin"),
                    exprs.bin_right_closed("p_retailprice", PRICE_EDGES, PRICE_LABELS).alias("price_bin"))


@query("bin_right_closed_orders", "SELECT o_orderkey, " + _bin_sql(
    "o_totalprice", [0.0, 50000.0, 150000.0, 300000.0, 600000.0], ["small", "medium", "large", "huge"]) + " AS price_bin FROM orders")
def bin_right_closed_orders(spark, d):
    o = tables.load(spark, d, "orders", ["o_orderkey", "o_totalprice"])
    return o.select("o_orderkey", exprs.bin_right_closed(
        "o_totalprice", [0.0, 50000.0, 150000.0, 300000.0, 600000.0], ["small", "medium", "large", "huge"]).alias("price_bin"))


# -- C1 I27 target encoding ----------------------------------------------------------------------

@query("target_encode", _cp(
    "WITH te AS (SELECT cat_a, avg(CAST(target AS DOUBLE)) AS te FROM cp WHERE cat_a IS NOT NULL GROUP BY cat_a)\n"
    "SELECT cp.id, cp.cat_a, round(te.te, 6) AS te FROM cp LEFT JOIN te ON cp.cat_a = te.cat_a"))
def target_encode(spark, d):
    x = cleaned_profile(spark, d).select("id", "cat_a", TARGET)
    y = encode.apply_target_mean(x, encode.fit_target_mean(x, "cat_a", TARGET), "cat_a")
    return y.select("id", "cat_a", r6("te").alias("te"))


K = 5


def _folds_cp_sql() -> str:
    return folds.fold_sql("id", "target", K, 42, "cp")


@query("target_encode_oof", _cp(
    f"WITH f AS ({_folds_cp_sql()}),\nks AS (SELECT CAST(range AS INTEGER) AS k FROM range({K})),\n"
    "te AS (SELECT ks.k AS fold, f.cat_a, avg(CAST(f.target AS DOUBLE)) AS te FROM f JOIN ks ON f.fold <> ks.k "
    "WHERE f.cat_a IS NOT NULL GROUP BY ks.k, f.cat_a)\n"
    "SELECT f.id, f.fold, round(te.te, 6) AS te FROM f LEFT JOIN te ON f.fold = te.fold AND f.cat_a = te.cat_a"))
def target_encode_oof(spark, d):
    x = materialize(folds.stratified_folds(cleaned_profile(spark, d).select("id", "cat_a", TARGET), "id", TARGET, K, 42))
    p = encode.fit_target_mean_oof(x, "cat_a", TARGET, "fold", K)
    return encode.apply_target_mean_oof(x, p, "cat_a", "fold").select("id", "fold", r6("te").alias("te"))


# -- J1 (fit part): every fold's params from one pass ---------------------------------------------

@query("fold_params", _cp(
    f"WITH f AS ({_folds_cp_sql()}),\nks AS (SELECT CAST(range AS INTEGER) AS k FROM range({K})),\n"
    "tr AS (SELECT ks.k AS fold, f.num_a, f.num_b, f.num_c FROM f JOIN ks ON f.fold <> ks.k),\n"
    "l AS (" + " UNION ALL ".join(f"SELECT fold, '{c}' AS feature, {c} AS value FROM tr" for c in _NUM3) + ")\n"
    "SELECT fold, feature, round(quantile_cont(value, 0.01), 6) AS lower, round(quantile_cont(value, 0.99), 6) AS upper, "
    "round(quantile_cont(value, 0.5), 6) AS median, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, "
    "count(value) AS n FROM l GROUP BY fold, feature"))
def fold_params(spark, d):
    from foldwise.operators import fitting
    x = materialize(folds.stratified_folds(cleaned_profile(spark, d).select("id", TARGET, *_NUM3), "id", TARGET, K, 42))
    q = fitting.fit_quantiles(x, _NUM3, [0.01, 0.99, 0.5], ["lower", "upper", "median"], "fold", K)
    m = fitting.fit_moments(x, _NUM3, "fold", K)
    j = q.join(F.broadcast(m), ["fold", "feature"])  # k × columns rows by construction
    return j.select(F.col("fold").cast("int").alias("fold"), "feature", *[r6(c).alias(c) for c in ("lower", "upper", "median", "mean")],
                    r6("std_pop").alias("std"), "n")


# -- I19 role-based design matrix (numeric / long-tail / categorical / ordinal roles) ----------

from foldwise.plans.registry import ORACLE  # noqa: E402
from foldwise.plans.views_sql import VIEW_SQL  # noqa: E402

_ROLE_NUM, _ROLE_LOG, _ROLE_ORD, _ROLE_CAT = ["num_a", "num_b", "num_c"], ["long_tail"], ["ord_a"], ["cat_a", "cat_b"]


def _design_sql() -> str:
    cats = " UNION ALL ".join(f"SELECT DISTINCT '{c}' AS f, {c} AS c FROM cp WHERE {c} IS NOT NULL" for c in _ROLE_CAT)
    match = " OR ".join(f"(k.f = '{c}' AND cp.{c} = k.c)" for c in _ROLE_CAT)
    onehot = (f"WITH p AS ({VIEW_SQL['p']}), {CP_SQL}, k AS ({cats})\n"
              f"SELECT cp.id, concat('cat__', k.f, '_', k.c) AS feature, CASE WHEN {match} THEN 1.0 ELSE 0.0 END AS value "
              "FROM cp CROSS JOIN k")
    return (f"WITH nc AS ({ORACLE['numeric_chain']}),\nlc AS ({ORACLE['longtail_chain']}),\noc AS ({ORACLE['ordinal_chain']}),\n"
            f"oh AS ({onehot})\n"
            "SELECT id, concat('num__', feature) AS feature, value FROM (UNPIVOT nc ON num_a, num_b, num_c INTO NAME feature VALUE value) "
            "UNION ALL SELECT id, 'log__long_tail', long_tail FROM lc "
            "UNION ALL SELECT id, 'ord__ord_a', ord_a FROM oc "
            "UNION ALL SELECT id, feature, value FROM oh")


@query("design_matrix", _design_sql())
def design_matrix(spark, d):
    """The profile through its role chains — numeric (impute → clip → scale), long tail
    (impute → lower clip → log1p → scale), ordinal (impute), categorical (one-hot) — as
    (id, feature, value) with role-prefixed output names."""
    x = cleaned_profile(spark, d).select("id", *_ROLE_NUM, *_ROLE_LOG, *_ROLE_ORD, *_ROLE_CAT)
    x = scale.numeric_chain(x, _ROLE_NUM)
    x = scale.longtail_chain(x, _ROLE_LOG)
    x = scale.ordinal_chain(x, _ROLE_ORD)
    cats = encode.one_hot_columns(encode.fit_one_hot(x, _ROLE_CAT))
    x = encode.apply_one_hot(x, cats, prefix="cat__")
    renamed = {**{c: f"num__{c}" for c in _ROLE_NUM}, **{c: f"log__{c}" for c in _ROLE_LOG},
               **{c: f"ord__{c}" for c in _ROLE_ORD}}
    x = x.select("id", *[F.col(c).alias(renamed.get(c, c)) for c in x.columns if c != "id"])
    feats = [c for c in x.columns if c != "id"]
    return x.unpivot(["id"], feats, "feature", "value").select("id", "feature", r6("value").alias("value"))
