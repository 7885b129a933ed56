"""Imputers (I1 I2 I3 I4 I6) and the group-parameter join with fall-back chain.

Global imputers fit one value per column (per fold when fold-wise) and apply as
``coalesce(c, value)`` — a projection, no shuffle. Grouped imputers fit a table keyed by
data values (its size depends on the data), so it is attached with a left join that is a
broadcast after a row-count check and a shuffle join (split by AQE when skewed) beyond it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators import fitting
from foldwise.operators.joins import attach
from foldwise.session import materialize


def fit_simple(df: DataFrame, cols: Sequence[str], strategy: str = "median",
               fill_value: float | None = None, fold_col: str | None = None,
               k: int | None = None, exact: bool = True) -> DataFrame:
    """(fold?, column, value). strategy: median | mean | most_frequent | constant.

    median = exact interpolated median (I1), mean (I2), most_frequent with ties → smallest,
    constant = ``fill_value`` (I6). An all-NULL column gets a NULL value (left as is).
    """
    strategy = strategy.lower()
    keys = [fold_col] if fold_col else []
    if strategy == "median":
        p = fitting.fit_quantiles(df, cols, [0.5], ["value"], fold_col, k, exact)
    elif strategy == "mean":
        p = fitting.fit_moments(df, cols, fold_col, k).select(*keys, "feature", F.col("mean").alias("value"))
    elif strategy == "most_frequent":
        p = fitting.fit_mode(df, cols, fold_col, k).select(*keys, "feature", F.col("mode").alias("value"))
    elif strategy == "constant":
        if fill_value is None:
            raise ValueError("constant strategy needs fill_value")
        spark = df.sparkSession
        rows = [(c, float(fill_value)) for c in cols]
        p = spark.createDataFrame(rows, "feature string, value double")
        if fold_col:
            p = p.withColumn(fold_col, F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
            p = p.select(fold_col, "feature", "value")
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return p


def preset(mode: str) -> dict:
    """The two simple-imputer presets: 'new' fills constants, 'old' uses the most frequent."""
    mode = mode.lower()
    if mode == "new":
        return {"strategy": "constant", "fill_value": -1.0}
    if mode == "old":
        return {"strategy": "most_frequent"}
    raise ValueError(f"unknown imputation mode {mode!r}")


def fit_simple_text(df: DataFrame, cols: Sequence[str], strategy: str = "constant", fill_value: str = "-1",
                    fold_col: str | None = None, k: int | None = None) -> DataFrame:
    """I6 for text columns: (fold?, feature, value). 'constant' = ``fill_value``, 'most_frequent' = the
    commonest value, the smallest of them on ties; fold-wise from value counts merged per training
    fold. A column without values gets a NULL value (left as is)."""
    keys = [fold_col] if fold_col else []
    if strategy == "constant":
        p = df.sparkSession.createDataFrame([(c, fill_value) for c in cols], "feature string, value string")
        return p.select(F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias(fold_col), "feature", "value") if fold_col else p
    if strategy != "most_frequent":
        raise ValueError(f"unknown strategy {strategy!r} for text")
    long = df.select(*keys, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot(keys, list(cols), "feature", "value")
    counts = long.where(F.col("value").isNotNull()).groupBy(*keys, "feature", "value").agg(F.count(F.lit(1)).alias("cnt"))
    if fold_col:
        counts = fitting.to_training_folds(counts, k, fold_col).groupBy(*keys, "feature", "value").agg(F.sum("cnt").alias("cnt"))
    return counts.groupBy(*keys, "feature").agg(F.min_by("value", F.struct(-F.col("cnt"), "value")).alias("value"))


def preset_text(mode: str) -> dict:
    """The presets of :func:`preset` for text columns: 'new' fills '-1', 'old' the most frequent value."""
    if mode.lower() == "new":
        return {"strategy": "constant", "fill_value": "-1"}
    if mode.lower() == "old":
        return {"strategy": "most_frequent"}
    raise ValueError(f"unknown imputation mode {mode!r}")


def apply_fill_text(df: DataFrame, params: DataFrame, fold_col: str | None = None) -> DataFrame:
    """coalesce(c, fitted text) for every column in ``params``; a pure projection."""
    table = fitting.collect_params(params, fold_col)
    out = {}
    for c in sorted({c for (_, c) in table}):
        fill = F.lit(table[(None, c)]["value"]) if not fold_col else F.coalesce(
            F.lit(None).cast("string"), *[F.when(F.col(fold_col) == F.lit(f), F.lit(d["value"])) for (f, name), d in sorted(table.items()) if name == c])
        out[c] = F.coalesce(F.col(c).cast("string"), fill).alias(c)
    return df.select(*[out.get(c, F.col(c)) for c in df.columns])


def apply_fill(df: DataFrame, params: DataFrame, fold_col: str | None = None) -> DataFrame:
    """coalesce(c, fitted value) for every column in ``params``; a pure projection."""
    table = fitting.collect_params(params, fold_col)
    cols = sorted({c for (_, c) in table})
    repl = {c: F.coalesce(F.col(c).cast("double"),
                          fitting.param_expr(table, c, "value", fold_col)).alias(c) for c in cols}
    return df.select(*[repl.get(c, F.col(c)) for c in df.columns])


def fill_constant_by_group(df: DataFrame, group_col: str, constants: Mapping, cols: Sequence[str]) -> DataFrame:
    """Fill from a given table {group: {column: value}}; unknown or NULL group → mean of
    that column's constants. The table is a parameter, inlined as a literal map (no join)."""
    out = {}
    for c in cols:
        kv = {g: float(v[c]) for g, v in constants.items() if c in v}
        if not kv:
            continue
        fallback = sum(kv.values()) / len(kv)
        pairs = []
        for g, v in kv.items():
            pairs += [F.lit(str(g)), F.lit(v)]
        lookup = F.try_element_at(F.create_map(*pairs), F.col(group_col).cast("string"))
        out[c] = F.coalesce(F.col(c).cast("double"), lookup, F.lit(fallback)).alias(c)
    return df.select(*[out.get(c, F.col(c)) for c in df.columns])


def fit_group_means(df: DataFrame, parent: str, child: str, cols: Sequence[str]) -> dict[str, DataFrame]:
    """I4 fit: means by (parent, child), by parent, and global, in one pass over the data.

    The (parent, child) level is aggregated once; coarser levels are rolled up from its
    (sum, count) partials, so the input is scanned and shuffled a single time.
    """
    aggs = []
    for c in cols:
        aggs += [F.sum(F.col(c).cast("double")).alias(f"s__{c}"), F.count(c).alias(f"n__{c}")]
    fine = materialize(df.groupBy(parent, child).agg(*aggs))

    def means(frame: DataFrame, keys: list[str]) -> DataFrame:
        sums = []
        for c in cols:
            sums += [F.sum(f"s__{c}").alias(f"s__{c}"), F.sum(f"n__{c}").alias(f"n__{c}")]
        g = frame.groupBy(*keys).agg(*sums) if keys else frame.agg(*sums)
        return g.select(*keys, *[(F.col(f"s__{c}") / F.col(f"n__{c}")).alias(c) for c in cols])

    child_level = fine.where(F.col(parent).isNotNull() & F.col(child).isNotNull()).select(
        parent, child, *[(F.col(f"s__{c}") / F.col(f"n__{c}")).alias(c) for c in cols])
    parent_level = means(fine.where(F.col(parent).isNotNull()), [parent])
    global_level = means(fine, [])
    return {"child": child_level, "parent": parent_level, "global": global_level}


def apply_group_means(df: DataFrame, params: dict[str, DataFrame], parent: str, child: str,
                      cols: Sequence[str]) -> DataFrame:
    """coalesce(value, mean[parent, child], mean[parent], mean[global]).

    The global row is a single row (inlined as literals). The two keyed tables are left-joined
    on their keys with ``joins.attach`` (checked broadcast, shuffle join beyond the bound).
    """
    g = params["global"].collect()[0].asDict()
    ch = params["child"].select(parent, child, *[F.col(c).alias(f"_mc__{c}") for c in cols])
    pa = params["parent"].select(parent, *[F.col(c).alias(f"_mp__{c}") for c in cols])
    j = attach(attach(df, ch, [parent, child]), pa, [parent])
    repl = {c: F.coalesce(F.col(c).cast("double"), F.col(f"_mc__{c}"), F.col(f"_mp__{c}"),
                          F.lit(g[c]).cast("double")).alias(c) for c in cols}
    return j.select(*[repl.get(c, F.col(c)) for c in df.columns])
