"""Column-expression building blocks (all JVM-side, codegen-friendly).

Every helper returns a :class:`pyspark.sql.Column`; none of them adds a Python worker.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_or_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def clip(c: ColumnOrName, lo=None, hi=None) -> Column:
    """Null-guarded clip: NULL stays NULL; a NULL bound means "no bound on that side".

    ``greatest(NULL, x)`` is ``x`` in Spark, so an unguarded clip would silently impute.
    """
    x = col(c)
    out = x
    if lo is not None:
        lo_c = lit_or_col(lo)
        out = F.when(lo_c.isNull(), out).otherwise(F.greatest(out, lo_c))
    if hi is not None:
        hi_c = lit_or_col(hi)
        out = F.when(hi_c.isNull(), out).otherwise(F.least(out, hi_c))
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(out)


def clip_lower(c: ColumnOrName, min_value: float = 0.0) -> Column:
    """H5: lower-bound clip, nulls stay null."""
    return clip(c, lo=min_value)


def safe_denominator(b: ColumnOrName, eps: float = 1e-6) -> Column:
    """b, with 0 or NULL replaced by ``eps`` (the reference's zero rule)."""
    x = col(b)
    return F.when(x.isNull() | (x == 0), F.lit(eps)).otherwise(x)


def safe_ratio(a: ColumnOrName, b: ColumnOrName, eps: float = 1e-6) -> Column:
    """H1: a / b with b = 0 or NULL → eps."""
    return col(a) / safe_denominator(b, eps)


def scaled_power_ratio(a: ColumnOrName, b: ColumnOrName, power: int, scale: float = 100.0,
                       eps: float = 1e-6) -> Column:
    """H2 / H3: a / (b / scale) ** power, with the zero rule applied to b / scale."""
    return col(a) / F.pow(safe_denominator(col(b) / F.lit(scale), eps), F.lit(float(power)))


def try_double(c: ColumnOrName) -> Column:
    """B2: text → double, failures → NULL (plain cast raises under ANSI)."""
    return col(c).cast("string").try_cast("double")


def safe_float(c: ColumnOrName) -> Column:
    """NULL, '' or an unparsable value → NULL."""
    s = F.trim(col(c).cast("string"))
    return F.when(s == "", F.lit(None).cast("double")).otherwise(s.try_cast("double"))


def parse_percent(c: ColumnOrName) -> Column:
    """H9: '12.3%' → 12.3."""
    return F.rtrim(F.trim(col(c)), F.lit("%")).try_cast("double")


def nan_to_null(c: ColumnOrName) -> Column:
    """NaN is not NULL in Spark (max/avg turn NaN); normalise it at the scan."""
    x = col(c)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def map_lookup(c: ColumnOrName, mapping: Mapping, keep_unmatched: bool = True,
               key_type: str = "string") -> Column:
    """Dictionary recode via a literal map; unmatched values kept (or NULL)."""
    if not mapping:
        return col(c) if keep_unmatched else F.lit(None)
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k).cast(key_type), F.lit(v)]
    key = col(c).cast(key_type)
    hit = F.try_element_at(F.create_map(*kv), key)
    return F.coalesce(hit, col(c)) if keep_unmatched else hit


def bin_right_closed(c: ColumnOrName, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """H7: pandas-style ``cut``: bins (e[i], e[i+1]], values outside → NULL, string labels."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need len(labels) == len(edges) - 1")
    x = col(c)
    out = F.lit(None).cast("string")
    for i in range(len(labels) - 1, -1, -1):
        out = F.when((x > F.lit(edges[i])) & (x <= F.lit(edges[i + 1])), F.lit(labels[i])).otherwise(out)
    return out


def row_sum(cols: Sequence[ColumnOrName]) -> Column:
    """Sum of several numeric columns (NULL treated as 0)."""
    out = F.lit(0)
    for c in cols:
        out = out + F.coalesce(col(c), F.lit(0))
    return out


def any_null(cols: Sequence[ColumnOrName]) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | col(c).isNull()
    return out


def round6(c: ColumnOrName) -> Column:
    return F.round(col(c), 6)
