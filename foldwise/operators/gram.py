"""Sums of products of many columns, as matrix products in Arrow batches: correlations of hundreds of columns (D17–D19) and
fold-wise standardisation with principal components (I23).

A task turns its rows into matrices and adds up their products; it returns one row per column, and the rows of all
tasks are summed by Spark with vector buffers. Values are taken relative to a column's mean, found first, so that sums
of products don't cancel.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators import vectors
from foldwise.session import materialize

#: Elements of a vector whose products are brought to the driver, fold by fold.
MAX_DIM = 1024
_CHUNK = 4096


# -- correlations of scalar columns --------------------------------------------------------------------

def pair_sums(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(i, j, n, s, q, p) for every ordered pair of columns: over the rows in which both have a value (not null, not
    NaN), their number, the sum and the sum of squares of column i, and the sum of products. Values are shifted by
    their column's mean."""
    cols = list(cols)
    d = len(cols)
    x = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])
    means = x.agg(*[F.coalesce(F.avg(c), F.lit(0.0)) for c in x.columns]).first()
    shift = np.array(means, float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((4, d, d))
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(at, _CHUNK)
                value = np.column_stack([c.to_numpy(zero_copy_only=False) for c in part.columns]).astype(float) - shift
                known = ~np.isnan(value)
                value, known = np.where(known, value, 0.0), known.astype(float)
                sums += np.stack([known.T @ known, value.T @ known, (value * value).T @ known, value.T @ value])
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([sums[:, i].ravel() for i in range(d)], pa.list_(pa.float64()))], ["i", "sums"])

    none = df.sparkSession.range(d).select(F.col("id").cast("int").alias("i"), F.array_repeat(F.lit(0.0), 4 * d).alias("sums"))  # of a table without partitions
    merged = (x.mapInArrow(run, "i int, sums array<double>").unionByName(none).groupBy("i")
              .agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums")))
    of = lambda k: F.slice("sums", k * d + 1, d).alias("nsqp"[k])
    return merged.select("i", F.posexplode(F.arrays_zip(*(of(k) for k in range(4)))).alias("j", "at")).select("i", "j", "at.*")


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(col_a, col_b, r) for every pair of columns in their order: Pearson's r over the rows in which both have a
    value; null if one of them is constant there, or there are fewer than two."""
    names = F.array(*[F.lit(c) for c in cols])
    sums = materialize(pair_sums(df, cols))  # a row per ordered pair
    a, b = sums.where("i < j").alias("a"), sums.where("i > j").alias("b")
    both = a.join(b, F.expr("a.i = b.j and a.j = b.i"))
    spread = lambda t: F.col("a.n") * F.col(f"{t}.q") - F.col(f"{t}.s") * F.col(f"{t}.s")
    # of a constant, rounding may leave a spread of some units in the last place of n q
    varies = lambda t: spread(t) > 1e-12 * F.col("a.n") * F.col(f"{t}.q")
    r = (F.col("a.n") * F.col("a.p") - F.col("a.s") * F.col("b.s")) / (F.sqrt(spread("a")) * F.sqrt(spread("b")))
    return both.select(F.get(names, F.col("a.i")).alias("col_a"), F.get(names, F.col("a.j")).alias("col_b"),
                       F.when((F.col("a.n") > 1) & varies("a") & varies("b"), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("r"))


# -- principal components per fold ---------------------------------------------------------------------

@dataclass
class Moments:
    """Of a set of vectors: their number, mean, population deviations (0 as 1) and correlation matrix."""

    n: int
    mean: np.ndarray
    scale: np.ndarray
    correlation: np.ndarray

    @staticmethod
    def of(n: int, sums: np.ndarray, products: np.ndarray, shift: np.ndarray) -> Moments:
        mean = sums / max(n, 1)
        covariance = products / max(n, 1) - np.outer(mean, mean)
        variance = np.diag(covariance)
        constant = variance <= 1e-14 * np.maximum(np.diag(products) / max(n, 1), 1e-300)
        scale = np.where(constant, 1.0, np.sqrt(np.maximum(variance, 0.0)))
        covariance = np.where(constant[:, None] | constant[None, :], 0.0, covariance)
        return Moments(n, mean + shift, scale, covariance / np.outer(scale, scale))


def fold_moments(df: DataFrame, vector: str, k: int, fold_col: str = "fold") -> dict[int, Moments]:
    """Moments of every fold's training rows (all rows under -1), from one sum of products per fold: a training set is
    the total without the fold. Rows with a null vector don't count; all others have one length, MAX_DIM at most."""
    x = df.select(F.col(fold_col).cast("int").alias("fold"), F.col(vector).cast("array<double>").alias("v")).where("v is not null")
    if x.isEmpty():
        return {}
    shift = x.agg(Summarizer.mean(array_to_vector("v"))).first()[0].toArray()
    d = len(shift)
    if d > MAX_DIM:
        raise ValueError(f"vectors of more than {MAX_DIM} elements")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(at, _CHUNK)
                fold = part.column(0).to_numpy(zero_copy_only=False)
                value = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, d) - shift
                value = np.column_stack([np.ones(len(value)), value])  # its products hold the number and the sums, too
                for f in np.unique(fold).tolist():
                    here = value[fold == f]
                    sums[f] = sums.get(f, 0.0) + here.T @ here
        for f, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([f] * (d + 1), pa.int32()), pa.array(range(d + 1), pa.int32()), pa.array(list(s), pa.list_(pa.float64()))], ["fold", "i", "row"])

    rows = (x.mapInArrow(run, "fold int, i int, row array<double>").groupBy("fold", "i")
            .agg(Summarizer.sum(array_to_vector("row")).alias("row")).collect())
    parts = {f: np.zeros((d + 1, d + 1)) for f in range(k)}
    for r in rows:
        parts[r["fold"]][r["i"]] = r["row"].toArray()
    total = sum(parts.values())
    sets = {-1: total} | {f: total - part for f, part in parts.items()}
    return {f: Moments.of(round(s[0, 0]), s[0, 1:], s[1:, 1:], shift) for f, s in sets.items()}


@dataclass
class FoldPCA:
    """I23 fold by fold: standardise by a training set's moments, then project on the leading eigenvectors of its
    correlation matrix. An eigenvector's element of largest size is positive. ``values``: all eigenvalues as sample
    variances, largest first."""

    components: int
    name: str = "text_pca"
    moments: dict[int, Moments] | None = None
    values: dict[int, np.ndarray] | None = None
    axes: dict[int, np.ndarray] | None = None

    def fit(self, df: DataFrame, vector: str, k: int, fold_col: str = "fold") -> FoldPCA:
        self.moments, self.values, self.axes = fold_moments(df, vector, k, fold_col), {}, {}
        for f, m in self.moments.items():
            if not 0 < self.components <= len(m.mean):
                raise ValueError("components must be in 1..length of the vectors")
            value, axis = np.linalg.eigh(m.correlation)
            value, axis = np.maximum(value[::-1], 0.0), axis[:, ::-1].T
            sign = np.sign(axis[np.arange(len(axis)), np.abs(axis).argmax(axis=1)])
            self.values[f] = value * m.n / max(m.n - 1, 1)
            self.axes[f] = (axis * np.where(sign == 0, 1, sign)[:, None])[:self.components]
        return self

    def explained_ratio(self, fold: int) -> np.ndarray:
        return self.values[fold][:self.components] / max(self.values[fold].sum(), 1e-300)

    @property
    def names(self) -> list[str]:
        return [f"{self.name}_{i:03d}" for i in range(self.components)]

    def transform(self, df: DataFrame, vector: str, fold: int | str = "fold", out: str = "pca") -> DataFrame:
        """``df`` with the components as a named vector, by the params of ``fold``: a number, or the column of each row's
        own. A null vector has none."""
        x = df.withColumns({"_v": F.col(vector).cast("array<double>"), "_f": F.lit(fold) if isinstance(fold, int) else F.col(fold).cast("int")})
        params = {f: (m.mean, m.scale, self.axes[f]) for f, m in self.moments.items()}
        names = x.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found: list = [None] * batch.num_rows
                known = np.flatnonzero(batch.column(names.index("_v")).is_valid().to_numpy(zero_copy_only=False))
                of = batch.column(names.index("_f")).to_numpy(zero_copy_only=False)
                value = batch.column(names.index("_v")).drop_null().flatten().to_numpy(zero_copy_only=False)
                if len(known):
                    value = value.reshape(len(known), -1)
                    for f in np.unique(of[known]).tolist():
                        mean, scale, axes = params[int(f)]
                        here = of[known] == f
                        for at, row in zip(known[here], (value[here] - mean) / scale @ axes.T):
                            found[at] = row
                keep = [c for n, c in zip(names, batch.columns) if n not in ("_v", "_f")]
                yield pa.RecordBatch.from_arrays([*keep, pa.array(found, pa.list_(pa.float64()))], [n for n in names if n not in ("_v", "_f")] + ["_pca"])

        kinds = ", ".join(f"`{c}` {kind}" for c, kind in df.dtypes)
        done = x.mapInArrow(run, f"{kinds}, _pca array<double>")
        vector_out = F.when(F.col("_pca").isNotNull(), array_to_vector("_pca"))
        return done.select(*df.columns, vectors.named(vector_out, self.names, out))
