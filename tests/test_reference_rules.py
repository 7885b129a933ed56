"""Brute-force checks of operators against the reference's rules written in plain Python."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from foldwise.functions import names
from foldwise.operators import tfidf

DOCS = ["The cat sat; the CAT ran.", "Café déjà vu — 2 cafés, x_y z", "你好 世界 hello hello", "",
        "the the the end", "Zürich Zürich zurich 42 42", "end? END! end."]


def _py_tfidf(docs, max_features, max_df=0.95):
    toks = [re.findall(r"(?u)\b\w+\b", d.lower()) for d in docs]
    n = len(docs)
    dfreq = Counter(t for ts in toks for t in set(ts))
    cf = Counter(t for ts in toks for t in ts)
    kept = [t for t in dfreq if dfreq[t] <= max_df * n]
    vocab = sorted(kept, key=lambda t: (-cf[t], t))[:max_features]
    idf = {t: math.log((1 + n) / (1 + dfreq[t])) + 1 for t in vocab}
    out = {}
    for i, ts in enumerate(toks):
        c = Counter(t for t in ts if t in idf)
        w = {t: (1 + math.log(v)) * idf[t] for t, v in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        for t, x in w.items():
            out[(i, t)] = x / norm
    return out


@pytest.mark.parametrize("k", [3, 8, 50])
def test_tfidf_matches_python_rules(spark, k):
    df = spark.createDataFrame(list(enumerate(DOCS)), "doc_id long, text string")
    got = {(r["doc_id"], r["term"]): r["weight"] for r in tfidf.tfidf_long(df, "doc_id", "text", k).collect()}
    exp = _py_tfidf(DOCS, k)
    assert got.keys() == exp.keys()
    assert all(got[key] == pytest.approx(exp[key]) for key in exp)


def _py_message(file_name):
    name = file_name.replace(".csv", "")
    mode = "full"
    if name.endswith("_fold"):
        mode, name = "fold", name[:-5]
    elif name.endswith("_full"):
        name = name[:-5]
    parts = name.split("_")
    if len(parts) < 6:
        return name
    rest = "_".join(parts[4:])
    for code, label in names.MESSAGE_METHOD_SUFFIX:
        if code in rest:
            rest = rest.replace(code, label)
            break
    return f"{parts[3].capitalize()}: {rest.replace('_', ' ')} ({mode})"


def test_file_messages_match_python_rules(spark):
    files = ["submission_exp_063_exp2_RF_method0_fold.csv", "submission_exp_078_exp3_exp2_with_bmi_tfidf.csv",
             "submission_exp_010_EXP1_CB_method3_full.csv", "submission_exp_5_x.csv", "plain.csv",
             "submission_exp_001_exp1_LGBM_method2_method1_fold.csv", "a_b_c_d_e_f_full"]
    df = spark.createDataFrame([(f,) for f in files], "f string")
    got = [r[0] for r in df.select(names.message_from_file("f")).collect()]
    assert got == [_py_message(f) for f in files]


def test_exp_id_and_model_family(spark):
    rows = ["exp_003_CB_x", "exp_12_rf", "expx_1_", "exp_7_LightGBM_method1", None, "exp_9_xgb"]
    df = spark.createDataFrame([(r,) for r in rows], "n string")
    got = df.select(names.exp_id("n").alias("i"), names.model_family("n").alias("m"),
                    names.method_name("n").alias("k")).collect()
    assert [r["i"] for r in got] == [3, 12, -1, 7, None, 9]  # a missing name has no id
    assert [r["m"] for r in got] == ["CatBoost", "RandomForest", "Other", "LightGBM", "Unknown", "XGBoost"]
    assert got[3]["k"] == names.METHOD_NAMES["method1"] and got[0]["k"] is None


def test_numeric_operators_match_numpy_pandas(spark):
    import numpy as np
    from foldwise.operators import bounds, impute, profile, scale
    from foldwise.plans.common import cleaned_profile
    from conftest import SF_MID
    cols = ["num_a", "num_b", "num_c", "long_tail"]
    x = cleaned_profile(spark, SF_MID).select("id", "target", "cat_a", "cat_b", *cols).cache()
    pdf = x.toPandas().set_index("id").sort_index()
    # clip bounds = np.nanpercentile(1, 99)
    b = {r["feature"]: (r["lower"], r["upper"]) for r in bounds.fit_clip_bounds(x, cols).collect()}
    for c in cols:
        lo, hi = np.nanpercentile(pdf[c].to_numpy(dtype=float), [1, 99])
        assert b[c] == pytest.approx((lo, hi))
    # median / mean imputation = pandas median / mean
    for strategy, fn in (("median", "median"), ("mean", "mean")):
        got = impute.apply_fill(x, impute.fit_simple(x, cols, strategy)).toPandas().set_index("id").sort_index()
        for c in cols:
            exp = pdf[c].fillna(getattr(pdf[c], fn)())
            assert np.allclose(got[c].to_numpy(dtype=float), exp.to_numpy(dtype=float))
    # standard scaling with population std
    got = scale.scale(x, ["num_c"], "standard").toPandas().set_index("id").sort_index()["num_c"]
    exp = (pdf["num_c"] - pdf["num_c"].mean()) / pdf["num_c"].std(ddof=0)
    assert np.allclose(got.to_numpy(dtype=float), exp.to_numpy(dtype=float), equal_nan=True)
    # describe = pandas describe (sample std, linear quartiles)
    d = {r["feature"]: r for r in profile.describe(x, cols).collect()}
    for c in cols:
        s = pdf[c].describe()
        r = d[c]
        assert (r["count"], r["mean"], r["std"], r["min"], r["q1"], r["median"], r["q3"], r["max"]) == pytest.approx(
            (s["count"], s["mean"], s["std"], s["min"], s["25%"], s["50%"], s["75%"], s["max"]), abs=1e-6)
    # grouped mean imputation: (cat_b, cat_a) → cat_b → global
    params = impute.fit_group_means(x, "cat_b", "cat_a", ["num_a"])
    got = impute.apply_group_means(x, params, "cat_b", "cat_a", ["num_a"]).toPandas().set_index("id").sort_index()["num_a"]
    child = pdf.groupby(["cat_b", "cat_a"])["num_a"].transform("mean")
    parent = pdf.groupby("cat_b")["num_a"].transform("mean")
    exp = pdf["num_a"].fillna(child).fillna(parent).fillna(pdf["num_a"].mean())
    assert np.allclose(got.to_numpy(dtype=float), exp.to_numpy(dtype=float))


def _py_ap(labels, scores):
    # scikit-learn: thresholds at distinct scores, descending; AP = Σ (R_n − R_{n−1}) · P_n
    pos = sum(labels)
    ap, prev_r, tp, fp = 0.0, 0.0, 0, 0
    for s in sorted(set(scores), reverse=True):
        tp += sum(1 for y, sc in zip(labels, scores) if sc == s and y == 1)
        fp += sum(1 for y, sc in zip(labels, scores) if sc == s and y != 1)
        r = tp / pos
        ap += (r - prev_r) * (tp / (tp + fp))
        prev_r = r
    return ap


def test_metrics_match_sklearn_definitions(spark):
    from foldwise.operators import metrics
    from foldwise.sources import tables
    from conftest import SF_MID
    rp = tables.rule_predictions(spark, SF_MID).cache()
    rows = rp.collect()
    y, p, s = [r["label"] for r in rows], [r["pred"] for r in rows], [r["score"] for r in rows]
    tp = sum(a == 1 and b == 1 for a, b in zip(y, p)); fp = sum(a == 0 and b == 1 for a, b in zip(y, p))
    fn = sum(a == 1 and b == 0 for a, b in zip(y, p))
    m = metrics.binary_metrics(metrics.confusion_counts(rp, "label", "pred")).collect()[0]
    assert m["precision"] == pytest.approx(tp / (tp + fp)) and m["recall"] == pytest.approx(tp / (tp + fn))
    assert m["f1"] == pytest.approx(2 * tp / (2 * tp + fp + fn))
    f1s, sup = [], []
    for c in (0, 1):
        tpc = sum(a == c and b == c for a, b in zip(y, p)); npred = sum(b == c for b in p); nsup = sum(a == c for a in y)
        pr = tpc / npred if npred else 0.0; rc = tpc / nsup if nsup else 0.0
        f1s.append(2 * pr * rc / (pr + rc) if pr + rc else 0.0); sup.append(nsup)
    w = metrics.weighted_f1(rp, "label", "pred").collect()[0]["weighted_f1"]
    assert w == pytest.approx(sum(f * n for f, n in zip(f1s, sup)) / sum(sup))
    ap = metrics.average_precision(metrics.pr_curve(rp, "label", "score")).collect()[0]["average_precision"]
    assert ap == pytest.approx(_py_ap(y, s))


def test_metrics_from_confusion_equal_direct(spark):
    from foldwise.operators import metrics
    from foldwise.sources import tables
    from conftest import SF_MID
    rp = tables.rule_predictions(spark, SF_MID).withColumn("g", F.col("id") % 3)
    direct = metrics.binary_metrics(metrics.confusion_counts(rp, "label", "pred", ["g"]), ["g"]).join(
        metrics.weighted_f1(rp, "label", "pred", ["g"]), "g")
    cm = rp.groupBy("g", "label", "pred").agg(F.count(F.lit(1)).alias("n"))
    via = metrics.metrics_from_confusion(cm, ["g"])
    a = {r["g"]: r for r in direct.collect()}
    b = {r["g"]: r for r in via.collect()}
    for g in a:
        for c in ("tp", "fp", "fn", "tn", "accuracy", "precision", "recall", "f1", "weighted_f1"):
            assert a[g][c] == pytest.approx(b[g][c])
