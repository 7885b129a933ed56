"""Attaching derived parameter tables (group means, encodings, bounds) to the data.

Their size depends on the data (one row per group), so they are not broadcast blindly: the
table is materialised once, its rows and their width are checked against bounds, and only then is it
broadcast. Beyond a bound the join is a shuffle join, where AQE's skew handling splits a hot key's
partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.session import materialize

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 128 << 20


def attach(df: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left",
           max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    t = materialize(table)
    text = [c for c, kind in t.dtypes if kind == "string"]
    sizes = t.agg(F.count(F.lit(1)), *[F.sum(F.octet_length(c)) for c in text]).first()
    # 16 bytes a field hold any number; texts are measured
    size = sizes[0] * 16 * len(t.columns) + sum(s or 0 for s in sizes[1:])
    return df.join(F.broadcast(t) if sizes[0] <= max_rows and size <= MAX_BROADCAST_BYTES else t, list(keys), how)
