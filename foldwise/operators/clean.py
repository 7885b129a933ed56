"""Row/column cleaning and recoding (B1–B25). Every operator here is a projection or a filter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.functions import exprs


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """B1: drop the listed columns that exist."""
    return df.drop(*[c for c in cols if c in df.columns])


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """B2: text → double, unparsable → NULL."""
    repl = {c: exprs.try_double(c).alias(c) for c in cols if c in df.columns}
    return df.select(*[repl.get(c, F.col(c)) for c in df.columns])


def encode_target(df: DataFrame, target: str, mapping: Mapping, out_type: str = "int") -> DataFrame:
    """B4 then B3: map the target through ``mapping`` (int or string keys), then drop rows whose
    mapped target is NULL (unmapped labels are dropped too, unlike the reference — S7)."""
    mapped = exprs.map_lookup(F.col(target).cast("string"), {str(k): v for k, v in mapping.items()},
                              keep_unmatched=False).cast(out_type)
    return df.withColumn(target, mapped).na.drop(subset=[target])


def load_and_clean(df: DataFrame, target: str, mapping: Mapping, drop: Sequence[str] = (),
                   numeric: Sequence[str] = ()) -> DataFrame:
    """A2: drop listed columns, coerce numerics, encode target, drop null targets."""
    x = drop_columns(df, drop)
    x = coerce_numeric(x, numeric)
    return encode_target(x, target, mapping)


def backmap_labels(pred: str, mapping: Mapping) -> "F.Column":
    """Back-map predictions; unmapped values are kept."""
    return F.coalesce(exprs.map_lookup(F.col(pred).cast("string"), {str(k): v for k, v in mapping.items()},
                                       keep_unmatched=False).cast("int"), F.col(pred).cast("int"))


def shift_label(c: str, delta: int) -> "F.Column":
    """Shift a label code (1,2 ↔ 0,1)."""
    return (F.col(c) + F.lit(delta)).cast("int")


def replace_values(df: DataFrame, per_column: Mapping[str, Mapping]) -> DataFrame:
    """One dictionary per column; unmatched values kept."""
    repl = {c: exprs.map_lookup(c, m).alias(c) for c, m in per_column.items()}
    return df.select(*[repl.get(c, F.col(c)) for c in df.columns])


def translate_trimmed(c: str, mapping: Mapping) -> "F.Column":
    """Trim, then translate; unmatched (trimmed) values kept."""
    t = F.trim(F.col(c))
    return exprs.map_lookup(t, mapping)


def normalize_text(c: str) -> "F.Column":
    """Lower-case and trim."""
    return F.lower(F.trim(F.col(c)))


def label_from_code(c: str, labels: Mapping) -> "F.Column":
    """Readable label from a code; unknown codes → NULL."""
    return exprs.map_lookup(F.col(c).cast("string"), {str(k): v for k, v in labels.items()}, keep_unmatched=False)


def complete_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Keep rows with no missing value (in ``cols`` or all columns)."""
    return df.na.drop("any", subset=list(cols) if cols else None)


def rows_with_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows having any missing value among ``cols`` (all columns by default)."""
    return df.where(exprs.any_null(list(cols) if cols else df.columns))


def range_filter(df: DataFrame, ranges: Mapping[str, tuple], strict: bool = False) -> DataFrame:
    """Conjunctive range filter; ``strict`` uses open bounds. NULL never passes."""
    cond = F.lit(True)
    for c, (lo, hi) in ranges.items():
        x = F.col(c)
        if lo is not None:
            cond = cond & ((x > lo) if strict else (x >= lo))
        if hi is not None:
            cond = cond & ((x < hi) if strict else (x <= hi))
    return df.where(cond)


def null_out_of_range(df: DataFrame, ranges: Mapping[str, tuple]) -> DataFrame:
    """Values outside [lo, hi] become NULL (not clipped)."""
    repl = {c: F.when(F.col(c).between(lo, hi), F.col(c)).alias(c) for c, (lo, hi) in ranges.items()}
    return df.select(*[repl.get(c, F.col(c)) for c in df.columns])


def swap_when(df: DataFrame, a: str, b: str, condition) -> DataFrame:
    """Swap two columns on rows where ``condition`` holds — both in one projection."""
    cond = F.coalesce(condition, F.lit(False))
    repl = {a: F.when(cond, F.col(b)).otherwise(F.col(a)).alias(a),
            b: F.when(cond, F.col(a)).otherwise(F.col(b)).alias(b)}
    return df.select(*[repl.get(c, F.col(c)) for c in df.columns])


def fill_missing(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Constants for missing categories, '' for text."""
    return df.na.fill(dict(values))


def split_features(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> list[str]:
    """Feature list = all columns minus target and the exclude list (schema-driven)."""
    skip = set(exclude) | {target}
    return [c for c in df.columns if c not in skip]


def column_roles(df: DataFrame, exclude: Sequence[str] = ()) -> dict[str, list[str]]:
    """Numeric vs categorical columns from the schema."""
    num, cat = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        (num if isinstance(f.dataType, T.NumericType) else cat).append(f.name)
    return {"numeric": num, "categorical": cat}


def anomaly_rules(df: DataFrame, rules: Mapping[str, Mapping]) -> DataFrame:
    """Domain-rule violations per column in one aggregation.

    ``rules[col]`` may hold ``negative`` (bool), ``zero`` (bool), ``min``/``max`` (range).
    Output (column, rule, n_violations, min_violating, max_violating), one row per rule.
    """
    aggs, meta = [], []
    for c, r in rules.items():
        x = F.col(c)
        conds = []
        if r.get("negative"):
            conds.append(("negative", x < 0))
        if r.get("zero"):
            conds.append(("zero", x == 0))
        if r.get("min") is not None or r.get("max") is not None:
            lo, hi = r.get("min"), r.get("max")
            cond = F.lit(False)
            if lo is not None:
                cond = cond | (x < lo)
            if hi is not None:
                cond = cond | (x > hi)
            conds.append(("out_of_range", cond))
        for name, cond in conds:
            i = len(meta)
            meta.append((c, name))
            aggs += [F.count_if(cond).alias(f"n{i}"), F.min(F.when(cond, x)).alias(f"lo{i}"),
                     F.max(F.when(cond, x)).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    parts = [F.struct(F.lit(c).alias("feature"), F.lit(n).alias("rule"), F.col(f"n{i}").alias("n_violations"),
                      F.col(f"lo{i}").cast("double").alias("min_violating"),
                      F.col(f"hi{i}").cast("double").alias("max_violating"))
             for i, (c, n) in enumerate(meta)]
    return wide.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def outlier_flags(df: DataFrame, low: Mapping[str, float] = None, high: Mapping[str, float] = None,
                  in_list: Mapping[str, Sequence] = None, total_col: str = "outlier_count") -> DataFrame:
    """0/1 flags for value < low, > high, or in a list, plus their row sum."""
    flags = []
    for c, v in (low or {}).items():
        flags.append(F.coalesce((F.col(c) < v).cast("int"), F.lit(0)).alias(f"{c}_is_low"))
    for c, v in (high or {}).items():
        flags.append(F.coalesce((F.col(c) > v).cast("int"), F.lit(0)).alias(f"{c}_is_high"))
    for c, vals in (in_list or {}).items():
        flags.append(F.coalesce(F.col(c).isin(list(vals)).cast("int"), F.lit(0)).alias(f"{c}_is_listed"))
    x = df.select("*", *flags)
    names = [n for n in x.columns if n not in df.columns]
    return x.withColumn(total_col, exprs.row_sum(names).cast("int"))


def missing_flags(df: DataFrame, cols: Sequence[str], total_col: str = "missing_count",
                  complete_col: str = "completeness") -> DataFrame:
    """Per-column missing flags, number missing, number present."""
    flags = [F.col(c).isNull().cast("int").alias(f"{c}_missing") for c in cols]
    x = df.select("*", *flags)
    tot = exprs.row_sum([f"{c}_missing" for c in cols]).cast("int")
    return x.withColumn(total_col, tot).withColumn(complete_col, (F.lit(len(cols)) - F.col(total_col)).cast("int"))


def keep_recognised(df: DataFrame, c: str, other: str = "Other") -> DataFrame:
    """Keep rows whose extracted key is present and not the catch-all value."""
    return df.where(F.col(c).isNotNull() & (F.col(c) != other))


def run_ids_at_least(df: DataFrame, name_col: str, threshold: int) -> DataFrame:
    """Keep run names whose numeric id (exp_<n>_...) is ≥ threshold."""
    rid = F.regexp_extract(F.col(name_col), r"^exp_(\d+)", 1)
    return df.where((rid != "") & (rid.cast("long") >= threshold))
