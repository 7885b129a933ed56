"""Scalers (I11 I12 I13) and the per-role chains (I15 numeric, I16 long tail, I18 ordinal).

scikit-learn conventions, not ``ml.feature`` ones: standard scaling divides by the
*population* std; a zero scale (constant column) is replaced by 1, so the output is 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions import exprs
from foldwise.operators import bounds, fitting, impute


def fit_scaler(df: DataFrame, cols: Sequence[str], kind: str = "standard", fold_col: str | None = None,
               k: int | None = None, exact: bool = True) -> DataFrame:
    """(fold?, column, center, scale)."""
    keys = [fold_col] if fold_col else []
    kind = kind.lower()
    if kind == "standard":
        m = fitting.fit_moments(df, cols, fold_col, k)
        center, scale = F.col("mean"), F.col("std_pop")
    elif kind == "minmax":
        m = fitting.fit_moments(df, cols, fold_col, k)
        center, scale = F.col("min"), F.col("max") - F.col("min")
    elif kind == "robust":
        m = fitting.fit_quantiles(df, cols, [0.25, 0.5, 0.75], ["q1", "q2", "q3"], fold_col, k, exact)
        center, scale = F.col("q2"), F.col("q3") - F.col("q1")
    else:
        raise ValueError(f"unknown scaler {kind!r}")
    return m.select(*keys, "feature", center.alias("center"),
                    F.when(scale == 0, F.lit(1.0)).otherwise(scale).alias("scale"))


def apply_scaler(df: DataFrame, params: DataFrame, fold_col: str | None = None) -> DataFrame:
    table = fitting.collect_params(params, fold_col)
    cols = sorted({c for (_, c) in table})
    repl = {c: ((F.col(c).cast("double") - fitting.param_expr(table, c, "center", fold_col))
                / fitting.param_expr(table, c, "scale", fold_col)).alias(c) for c in cols}
    return df.select(*[repl.get(c, F.col(c)) for c in df.columns])


def scale(df: DataFrame, cols: Sequence[str], kind: str = "standard", **kw) -> DataFrame:
    fold_col = kw.get("fold_col")
    return apply_scaler(df, fit_scaler(df, cols, kind, **kw), fold_col)


def numeric_chain(df: DataFrame, cols: Sequence[str], strategy: str = "median", lower_pct: float = 1.0,
                  upper_pct: float = 99.0, scaler: str = "standard", fold_col: str | None = None,
                  k: int | None = None, exact: bool = True) -> DataFrame:
    """Impute → clip (bounds fitted on the imputed values) → scale (fitted after clip)."""
    x = impute.apply_fill(df, impute.fit_simple(df, cols, strategy, fold_col=fold_col, k=k, exact=exact), fold_col)
    x = bounds.clip_quantile(x, cols, lower_pct, upper_pct, fold_col, k, exact)
    return scale(x, cols, scaler, fold_col=fold_col, k=k, exact=exact)


def longtail_chain(df: DataFrame, cols: Sequence[str], strategy: str = "median", min_value: float = 0.0,
                   scaler: str = "standard", fold_col: str | None = None, k: int | None = None,
                   exact: bool = True) -> DataFrame:
    """I16: impute → lower clip → log1p → scale."""
    x = impute.apply_fill(df, impute.fit_simple(df, cols, strategy, fold_col=fold_col, k=k, exact=exact), fold_col)
    repl = {c: F.log1p(exprs.clip_lower(c, min_value)).alias(c) for c in cols}
    x = x.select(*[repl.get(c, F.col(c)) for c in x.columns])
    return scale(x, cols, scaler, fold_col=fold_col, k=k, exact=exact)


def ordinal_chain(df: DataFrame, cols: Sequence[str], strategy: str = "most_frequent",
                  fold_col: str | None = None, k: int | None = None) -> DataFrame:
    """Impute only."""
    return impute.apply_fill(df, impute.fit_simple(df, cols, strategy, fold_col=fold_col, k=k), fold_col)
