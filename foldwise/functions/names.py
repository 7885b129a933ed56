"""Run-name and formatting expressions (H8, H10–H14), all built-in column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference for the same names):
# model family by ordered, case-insensitive substring tests; first hit wins, else "Other".
MODEL_RULES = [
    (("CB", "CATBOOST"), "CatBoost"),
    (("RF", "RANDOMFOREST"), "RandomForest"),
    (("LGBM", "LIGHTGBM"), "LightGBM"),
    (("XGB",), "XGBoost"),
]
# readable names of the imputation method codes found in run names
METHOD_NAMES = {
    "method0": "m0: Median",
    "method1": "m1: Mean (Global)",
    "method2": "m2: Mean (Rule-based Range)",
    "method3": "m3: Grouped M/F Median",
}
# method suffixes used when turning a prediction file name into a message
MESSAGE_METHOD_SUFFIX = [
    ("method0", "method0-Median"),
    ("method1", "method1-Mean"),
    ("method2", "method2-Mode"),
    ("method3", "method3-Baseline"),
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exp_id(name) -> Column:
    """Numeric id of ``exp_<digits>_…``; −1 when the name does not match."""
    d = F.regexp_extract(_c(name), r"^exp_(\d+)_", 1)
    return F.when(d == "", F.lit(-1)).otherwise(d.cast("long"))


def model_family(name, rules: Sequence = MODEL_RULES, other: str = "Other") -> Column:
    """Ordered substring tests on the upper-cased name; NULL → 'Unknown'."""
    u = F.upper(_c(name))
    out = F.lit(other)
    for subs, label in reversed(list(rules)):
        cond = F.lit(False)
        for s in subs:
            cond = cond | F.contains(u, F.lit(s))
        out = F.when(cond, F.lit(label)).otherwise(out)
    return F.when(_c(name).isNull(), F.lit("Unknown")).otherwise(out)


def method_code(name) -> Column:
    """H13 (first step): 'method0'..'method3' found in the name, else NULL."""
    m = F.regexp_extract(_c(name), r"(method[0-3])", 1)
    return F.when(m == "", F.lit(None).cast("string")).otherwise(m)


def method_name(name, names: dict = METHOD_NAMES) -> Column:
    """Readable method name (unknown codes kept as the code)."""
    code = method_code(name)
    kv = [x for k, v in names.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.try_element_at(F.create_map(*kv), code), code)


def message_from_file(file_name) -> Column:
    """H14: 'submission_exp_063_exp2_RF_method0_fold.csv' → 'Exp2: RF method0-Median (fold)'.
    Names with fewer than six '_' parts are returned without '.csv' and the mode suffix."""
    name = F.replace(_c(file_name), F.lit(".csv"), F.lit(""))
    is_fold, is_full = F.endswith(name, F.lit("_fold")), F.endswith(name, F.lit("_full"))
    mode = F.when(is_fold, F.lit("fold")).otherwise(F.lit("full"))
    base = F.when(is_fold | is_full, F.substring(name, F.lit(1), F.length(name) - 5)).otherwise(name)
    parts = F.split(base, "_")
    g = F.element_at(parts, 4)
    group = F.concat(F.upper(F.substring(g, 1, 1)), F.lower(F.substring(g, F.lit(2), F.length(g))))
    rest = F.array_join(F.slice(parts, 5, F.size(parts) - 4), "_")
    mm = rest
    for code, label in reversed(MESSAGE_METHOD_SUFFIX):
        mm = F.when(F.contains(rest, F.lit(code)), F.replace(rest, F.lit(code), F.lit(label))).otherwise(mm)
    mm = F.replace(mm, F.lit("_"), F.lit(" "))
    msg = F.concat(group, F.lit(": "), mm, F.lit(" ("), mode, F.lit(")"))
    return F.when(F.size(parts) >= 6, msg).otherwise(base)


def fmt_fixed(c, digits: int = 6, signed: bool = False) -> Column:
    """H8: fixed-point text ('%.6f' / '%+.6f'); NULL → ''.

    Rounding is Java's: HALF_UP on the shortest decimal form of the double. C / Python round the
    exact binary value instead, so the two differ only when that decimal form ends exactly in a
    5 right after the last printed digit (e.g. 82.85 with one decimal).
    """
    pat = f"%{'+' if signed else ''}.{digits}f"
    x = _c(c)
    return F.when(x.isNull(), F.lit("")).otherwise(F.format_string(pat, x))


def fmt_percent(c, digits: int = 2) -> Column:
    """H8: '12.34%' style; NULL → ''."""
    x = _c(c)
    return F.when(x.isNull(), F.lit("")).otherwise(F.concat(F.format_string(f"%.{digits}f", x), F.lit("%")))
