"""Quantile clip bounds (I8 fit, I9 apply, I10 in-pipeline clip) and fixed-range helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions import exprs
from foldwise.operators import fitting


def fit_clip_bounds(df: DataFrame, cols: Sequence[str], lower_pct: float = 1.0, upper_pct: float = 99.0,
                    fold_col: str | None = None, k: int | None = None, exact: bool = True) -> DataFrame:
    """(fold?, column, lower, upper) from interpolated percentiles (given in percent).

    An all-NULL column yields NULL bounds, and NULL bounds mean "do not clip".
    """
    return fitting.fit_quantiles(df, cols, [lower_pct / 100.0, upper_pct / 100.0],
                                 ["lower", "upper"], fold_col, k, exact)


def apply_clip_bounds(df: DataFrame, params: DataFrame, fold_col: str | None = None) -> DataFrame:
    """Null-guarded clip of every column in ``params``; a projection (no shuffle)."""
    table = fitting.collect_params(params, fold_col)
    cols = sorted({c for (_, c) in table})
    repl = {c: exprs.clip(F.col(c).cast("double"),
                          fitting.param_expr(table, c, "lower", fold_col),
                          fitting.param_expr(table, c, "upper", fold_col)).alias(c) for c in cols}
    return df.select(*[repl.get(c, F.col(c)) for c in df.columns])


def clip_quantile(df: DataFrame, cols: Sequence[str], lower_pct: float = 1.0, upper_pct: float = 99.0,
                  fold_col: str | None = None, k: int | None = None, exact: bool = True) -> DataFrame:
    """Fit and apply in one call."""
    return apply_clip_bounds(df, fit_clip_bounds(df, cols, lower_pct, upper_pct, fold_col, k, exact),
                             fold_col)


def clip_fixed(df: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    """Clip to given (lo, hi) per column; NULL stays NULL."""
    repl = {c: exprs.clip(c, lo, hi).alias(c) for c, (lo, hi) in ranges.items()}
    return df.select(*[repl.get(c, F.col(c)) for c in df.columns])
