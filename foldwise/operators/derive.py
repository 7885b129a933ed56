"""Flag-controlled derived features (I28 over H1–H4): applied after imputation, as projections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.functions import exprs


def derived_columns(a: str | Column, b: str | Column, flags: Mapping[str, bool], scale: float = 100.0, eps: float = 1e-6) -> dict[str, Column]:
    """The enabled expressions over a numerator ``a`` and a denominator ``b``:

    * ``ratio``           a / b (0 or NULL denominator → eps)       H1
    * ``bmi``             a / (b/scale)²                             H2
    * ``ponderal``        a / (b/scale)³                             H3
    * ``reverse_ratio``   b / a, NULL on a zero numerator            H4
    * ``total``           a + b                                      H4
    """
    a, b = exprs.col(a), exprs.col(b)
    cols = {
        "ratio": exprs.safe_ratio(a, b, eps),
        "bmi": exprs.scaled_power_ratio(a, b, 2, scale, eps),
        "ponderal": exprs.scaled_power_ratio(a, b, 3, scale, eps),
        "reverse_ratio": F.try_divide(b, a),
        "total": a + b,
    }
    unknown = set(flags) - set(cols)
    if unknown:
        raise ValueError(f"unknown derived features {sorted(unknown)}")
    return {n: cols[n] for n, on in flags.items() if on}


def engineer_features(df: DataFrame, numerator: str, denominator: str, flags: Mapping[str, bool],
                      scale: float = 100.0, eps: float = 1e-6) -> DataFrame:
    """Adds the columns of :func:`derived_columns`."""
    return df.select("*", *[c.alias(n) for n, c in derived_columns(numerator, denominator, flags, scale, eps).items()])
