"""Queries over cleaning, recoding, filtering and flag operators (B*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.operators import bounds, clean
from foldwise.plans.common import CP_SQL, TARGET, cleaned_profile, r6
from foldwise.plans.registry import query
from foldwise.plans.views_sql import with_views
from foldwise.sources import tables

NUM_OUT = ["num_a", "num_b", "num_c", "long_tail", "ord_a", "raw_num"]


def _cp_sql(body: str) -> str:
    return with_views(f"WITH {CP_SQL}\n{body}", "p")


# -- clean_profile: A2 B1 B2 B3 B4 B11 B19 -----------------------------------------------------

@query("clean_profile", _cp_sql("""
SELECT id, target, CASE target WHEN 1 THEN 'positive' WHEN 0 THEN 'negative' END AS target_label,
  cat_a, round(num_a, 6) AS num_a, round(num_b, 6) AS num_b, round(num_c, 6) AS num_c,
  round(long_tail, 6) AS long_tail, round(ord_a, 6) AS ord_a, round(raw_num, 6) AS raw_num
FROM cp WHERE target IS NOT NULL"""))
def clean_profile(spark, d):
    x = clean.drop_columns(cleaned_profile(spark, d), ["note", "cat_b", "not_a_column"])
    feats = clean.split_features(x, TARGET, exclude=["id"])
    return x.select("id", TARGET, clean.label_from_code(TARGET, {1: "positive", 0: "negative"}).alias("target_label"),
                    *[r6(c).alias(c) if c in NUM_OUT else F.col(c) for c in feats])


# -- recode_values: B8 B9 B10 ------------------------------------------------------------------

BRAND_CODES = {"Brand#1": "B01", "Brand#2": "B02", "Brand#3": "B03"}
SIZE_WORDS = {"SMALL": "S", "MEDIUM": "M", "LARGE": "L"}


@query("recode_values", """
SELECT p_partkey,
  coalesce(CASE p_brand WHEN 'Brand#1' THEN 'B01' WHEN 'Brand#2' THEN 'B02' WHEN 'Brand#3' THEN 'B03' END, p_brand) AS brand_code,
  coalesce(CASE trim(p_type) WHEN 'SMALL' THEN 'S' WHEN 'MEDIUM' THEN 'M' WHEN 'LARGE' THEN 'L' END, trim(p_type)) AS size_code,
  lower(trim(p_name)) AS name_norm
FROM part""")
def recode_values(spark, d):
    p = tables.load(spark, d, "part", ["p_partkey", "p_brand", "p_type", "p_name"])
    p = clean.replace_values(p, {"p_brand": BRAND_CODES})
    return p.select("p_partkey", F.col("p_brand").alias("brand_code"),
                    clean.translate_trimmed("p_type", SIZE_WORDS).alias("size_code"),
                    clean.normalize_text("p_name").alias("name_norm"))


# -- label_backmap: B6 B7 ----------------------------------------------------------------------

@query("label_backmap", _cp_sql("""
SELECT id, CASE WHEN num_c > 100 THEN 1 ELSE 0 END AS pred,
  CAST(coalesce(CASE CASE WHEN num_c > 100 THEN 1 ELSE 0 END WHEN 1 THEN 1 WHEN 0 THEN 2 END,
                CASE WHEN num_c > 100 THEN 1 ELSE 0 END) AS INTEGER) AS pred_raw,
  CAST((2 - target) - 1 AS INTEGER) AS shifted, CAST((2 - target) - 1 + 1 AS INTEGER) AS unshifted
FROM cp"""))
def label_backmap(spark, d):
    x = cleaned_profile(spark, d).select("id", TARGET, F.when(F.col("num_c") > 100, 1).otherwise(0).alias("pred"))
    x = x.withColumn("raw", (2 - F.col(TARGET)).cast("int"))
    x = x.withColumn("shifted", clean.shift_label("raw", -1))
    return x.select("id", "pred", clean.backmap_labels("pred", {1: 1, 0: 2}).alias("pred_raw"), "shifted",
                    clean.shift_label("shifted", 1).alias("unshifted"))


# -- swap_and_fixed_clip: B16 B17 B18 ----------------------------------------------------------

@query("swap_and_fixed_clip", with_views("""
WITH s AS (SELECT id, CASE WHEN num_a < num_b THEN num_b ELSE num_a END AS num_a,
                  CASE WHEN num_a < num_b THEN num_a ELSE num_b END AS num_b, cat_a, note FROM p)
SELECT id,
  round(CASE WHEN num_a IS NULL THEN NULL ELSE least(greatest(num_a, 100), 250) END, 6) AS num_a,
  round(CASE WHEN num_b IS NULL THEN NULL ELSE least(greatest(num_b, 30), 200) END, 6) AS num_b,
  coalesce(cat_a, 'Unknown') AS cat_a, coalesce(note, '') AS note
FROM s""", "p"))
def swap_and_fixed_clip(spark, d):
    x = tables.profile(spark, d, with_note=True).select("id", "num_a", "num_b", "cat_a", "note")
    x = clean.swap_when(x, "num_a", "num_b", F.col("num_a") < F.col("num_b"))
    x = bounds.clip_fixed(x, {"num_a": (100, 250), "num_b": (30, 200)})
    x = clean.fill_missing(x, {"cat_a": "Unknown", "note": ""})
    return x.select("id", r6("num_a").alias("num_a"), r6("num_b").alias("num_b"), "cat_a", "note")


# -- range_filter: B12 B14; null_out_of_range: B13 B15 ----------------------------------------

@query("range_filter", with_views("""
SELECT id, round(num_a, 6) AS num_a, round(num_b, 6) AS num_b, cat_a FROM p
WHERE num_a IS NOT NULL AND num_b IS NOT NULL AND cat_a IS NOT NULL
  AND num_a >= 140 AND num_a <= 180 AND num_b > 40 AND num_b < 100""", "p"))
def range_filter(spark, d):
    x = tables.profile(spark, d).select("id", "num_a", "num_b", "cat_a")
    x = clean.complete_rows(x, ["num_a", "num_b", "cat_a"])
    x = clean.range_filter(x, {"num_a": (140, 180)})
    x = clean.range_filter(x, {"num_b": (40, 100)}, strict=True)
    return x.select("id", r6("num_a").alias("num_a"), r6("num_b").alias("num_b"), "cat_a")


@query("null_out_of_range", with_views("""
WITH n AS (SELECT id, CASE WHEN num_a BETWEEN 130 AND 200 THEN num_a END AS num_a,
                  CASE WHEN num_b BETWEEN 0 AND 150 THEN num_b END AS num_b FROM p)
SELECT id, round(num_a, 6) AS num_a, round(num_b, 6) AS num_b FROM n
WHERE num_a IS NULL OR num_b IS NULL""", "p"))
def null_out_of_range(spark, d):
    x = tables.profile(spark, d).select("id", "num_a", "num_b")
    x = clean.null_out_of_range(x, {"num_a": (130, 200), "num_b": (0, 150)})
    x = clean.rows_with_missing(x, ["num_a", "num_b"])
    return x.select("id", r6("num_a").alias("num_a"), r6("num_b").alias("num_b"))


# -- flags_outlier: B22; flags_missing: B23 ----------------------------------------------------

@query("flags_outlier", with_views("""
SELECT id,
  coalesce(CAST(num_a < 100 AS INTEGER), 0) AS num_a_is_low,
  coalesce(CAST(long_tail < 0 AS INTEGER), 0) AS long_tail_is_low,
  coalesce(CAST(num_b > 90 AS INTEGER), 0) AS num_b_is_high,
  coalesce(CAST(cat_b IN ('ASIA', 'EUROPE') AS INTEGER), 0) AS cat_b_is_listed,
  CAST(coalesce(CAST(num_a < 100 AS INTEGER), 0) + coalesce(CAST(long_tail < 0 AS INTEGER), 0)
     + coalesce(CAST(num_b > 90 AS INTEGER), 0) + coalesce(CAST(cat_b IN ('ASIA', 'EUROPE') AS INTEGER), 0) AS INTEGER) AS outlier_count
FROM p""", "p"))
def flags_outlier(spark, d):
    x = tables.profile(spark, d).select("id", "num_a", "num_b", "long_tail", "cat_b")
    x = clean.outlier_flags(x, low={"num_a": 100, "long_tail": 0}, high={"num_b": 90},
                            in_list={"cat_b": ["ASIA", "EUROPE"]})
    return x.drop("num_a", "num_b", "long_tail", "cat_b")


_MISS = ["num_a", "num_b", "num_c", "cat_a"]


@query("flags_missing", with_views(
    "SELECT id, " + ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}_missing" for c in _MISS)
    + ", CAST(" + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in _MISS) + " AS INTEGER) AS missing_count"
    + f", CAST({len(_MISS)} - (" + " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in _MISS)
    + ") AS INTEGER) AS completeness FROM p", "p"))
def flags_missing(spark, d):
    x = tables.profile(spark, d).select("id", *_MISS)
    return clean.missing_flags(x, _MISS).drop(*_MISS)


# -- anomaly_rules: B20 B21 --------------------------------------------------------------------

def _anomaly_rules(numeric_cols):
    rules = {c: {"negative": True, "zero": True} for c in numeric_cols}
    if "ord_a" in rules:
        rules["ord_a"].update({"min": 1, "max": 5})
    return rules


def _anomaly_sql():
    cols = ["num_a", "num_b", "num_c", "long_tail", "ord_a", "raw_num"]
    parts = []
    for c, r in _anomaly_rules(cols).items():
        conds = [("negative", f"{c} < 0"), ("zero", f"{c} = 0")]
        if "min" in r:
            conds.append(("out_of_range", f"({c} < {r['min']} OR {c} > {r['max']})"))
        for name, cond in conds:
            parts.append(f"SELECT '{c}' AS feature, '{name}' AS rule, count(*) FILTER (WHERE {cond}) AS n_violations, "
                         f"CAST(min(CASE WHEN {cond} THEN {c} END) AS DOUBLE) AS min_violating, "
                         f"CAST(max(CASE WHEN {cond} THEN {c} END) AS DOUBLE) AS max_violating FROM cp")
    return _cp_sql("\nUNION ALL\n".join(parts))


@query("anomaly_rules", _anomaly_sql())
def anomaly_rules(spark, d):
    x = cleaned_profile(spark, d)
    roles = clean.column_roles(x, exclude=["id", TARGET])
    return clean.anomaly_rules(x, _anomaly_rules(roles["numeric"]))
