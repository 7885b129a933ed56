"""Near-duplicate vectors: spherical k-means cells, blocked cosine products, one vector kept per group.

Spherical k-means, fitted on a bounded sample, deals the unit vectors into cells. A pair of linked
vectors may lie in two cells, so a vector also *visits* cells whose border is near. Let x live in the
cell of centre c, y in that of d, with |x - y| <= s, the chord of the angle. Along (c - d) / |c - d|, x
measures at least 0 and y at most 0, and they differ by at most s: one of them is within s / 2 of 0. So
it is enough that every vector visits the cells from whose border it is at most s / 2 away: then x visits
y's cell, or y visits x's, and no pair is lost (recall is 1, whatever the centres).

In a cell the residents are compared with residents and visitors, block against block, by matrix
products in double precision. Blocks have a bounded size, so a third of all vectors in one cell become
more tasks, not a larger one. A block pair returns counts of links per vector and, of the links, only a
spanning forest: rows in proportion to its vectors. Equal vectors are one class from the start.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import written
from foldwise.llm.components import components

#: Rows that k-means is fitted on, at most; vectors that a cell should have; cells, at most; rounds.
SAMPLE_ROWS = 20_000
CELL_ROWS = 256
MOST_CELLS = 2_048
ROUNDS = 10
#: Vectors on a side of one comparison, about.
BLOCK_ROWS = 2_048
LINKS = "class_id long, other long, links long"


def spherical_kmeans(points: np.ndarray, cells: int, rounds: int = ROUNDS, seed: int = 11) -> np.ndarray:
    """Unit centres for unit ``points``: assign by cosine, move to the normalised sum."""
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), size=min(cells, len(points)), replace=False)]
    for _ in range(rounds):
        nearest = (points @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, nearest, points)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centres = np.where(norm > 1e-9, total / np.maximum(norm, 1e-9), centres)
    return centres


def unit(rows) -> np.ndarray:
    """Rows scaled to length 1 in double precision; very large and small components stay finite."""
    x = rows.astype(np.float64) if isinstance(rows, np.ndarray) and rows.ndim == 2 else np.array([np.asarray(r, np.float64) for r in rows])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _usable() -> F.Column:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))


def _keyed(vectors: DataFrame) -> DataFrame:
    """Rows with a 128-bit key of the vector, null where it can't link."""
    key = F.when(_usable(), F.struct(F.xxhash64("embedding").alias("a"), F.xxhash64(F.lit(1), F.reverse("embedding")).alias("b")))
    return vectors.select(F.col("vec_id").cast("long"), "embedding").withColumn("key", key)


class Cells:
    """Centres and the rule of visits. ``half``: half the chord of the linking angle."""

    def __init__(self, centres: np.ndarray, cosine: float):
        self.centres = centres
        # |c - d| of unit vectors, from a cells x cells product; rounding must not make a gap smaller
        self.gap = np.sqrt(np.maximum(0.0, 2 - 2 * (centres @ centres.T))) + 1e-7
        self.half = math.sqrt(max(0.0, 2 - 2 * cosine)) / 2 + 1e-9

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Home cells, and which cells each row is in (its own included)."""
        near = x @ self.centres.T
        home = near.argmax(axis=1)
        rows = np.arange(len(x))
        inside = near[rows, home][:, None] - near <= self.half * self.gap[home]
        inside[rows, home] = True
        return home, inside


def _deal(cells: Cells) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 2_000):
                pdf = whole.iloc[at:at + 2_000]
                home, inside = cells.of(unit(pdf["embedding"]))
                row, cell = np.nonzero(inside)
                yield pdf.iloc[row].assign(cell=cell.astype(np.int32), home=home[row].astype(np.int32))
    return run


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Of the links a[i]–b[i], those that join something new."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = find(x), find(y)
        if p != q:
            root[p] = q
            out.append((x, y))
    return out


def _compare(cells: Cells, cosine: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A block of residents against a block of the cell's vectors. A pair that two cells hold counts in
    the one with the smaller number. Rows with a null ``other`` count links."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        parts = [(np.empty(0, np.int64), None, np.empty(0))]
        if len(left) and len(right):
            here = int(pdf["cell"].iloc[0])
            a, b, home = left["class_id"].to_numpy(), right["class_id"].to_numpy(), right["home"].to_numpy()
            x, y = unit(left["embedding"]), unit(right["embedding"])
            linked = (x @ y.T >= cosine) & (a[:, None] != b[None, :])
            linked &= ~(cells.of(x)[1][:, home] & (home < here)[None, :])
            visitor = home != here
            i, j = np.nonzero(linked)
            forest = np.array(_forest(a[i], b[j]), np.int64).reshape(-1, 2)
            parts = [(a, None, linked @ right["times"].to_numpy()), (b[visitor], None, left["times"].to_numpy() @ linked[:, visitor]),
                     (forest[:, 0], forest[:, 1], np.zeros(len(forest)))]
        other = [pd.array([None] * len(k) if o is None else o, dtype="Int64") for k, o, _ in parts]
        return pd.DataFrame({"class_id": np.concatenate([k for k, _, _ in parts]).astype(np.int64), "other": pd.concat(list(map(pd.Series, other)), ignore_index=True),
                             "links": np.concatenate([n for _, _, n in parts]).astype(np.int64)})

    return run


def _sample(classes: DataFrame, n: int, dimension: int) -> np.ndarray:
    """Unit vectors of about ``SAMPLE_ROWS`` of ``n`` classes, by a hash of their number; they come as one Arrow array."""
    share = min(1.0, 1.05 * SAMPLE_ROWS / n)
    some = classes.where(F.pmod("class_id", F.lit(1 << 31)) < F.lit(int(share * (1 << 31)) + 1)).select("class_id", "embedding").limit(2 * SAMPLE_ROWS).toArrow().combine_chunks()
    flat = some.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
    return unit(flat[np.argsort(some.column("class_id").to_numpy())][:SAMPLE_ROWS])


def class_links(classes: DataFrame, cosine: float) -> DataFrame:
    """``classes``: (class_id, times, embedding) of usable vectors. Returns link counts per class (null
    ``other``; several rows of a class add up) and links that keep the components."""
    spark = classes.sparkSession
    out = spark.createDataFrame([], LINKS)
    sizes = classes.groupBy(F.size("embedding").alias("d")).count().collect()
    for dimension, n in sizes:  # vectors of different lengths don't link; one length is usual
        mine = classes.where(F.size("embedding") == dimension)
        cells = Cells(spherical_kmeans(_sample(mine, n, dimension), max(1, min(MOST_CELLS, n // CELL_ROWS))), cosine)
        kind = classes.schema["embedding"].dataType.simpleString()
        dealt = written(mine.mapInPandas(_deal(cells), f"class_id long, times long, embedding {kind}, cell int, home int"), "vector-cells")
        per = dealt.groupBy("cell").agg(F.sum((F.col("home") == F.col("cell")).cast("int")).alias("homes"), F.count("*").alias("all")).collect()
        blocks = spark.createDataFrame([(r["cell"], -(-r["homes"] // BLOCK_ROWS), -(-r["all"] // BLOCK_ROWS)) for r in per if r["homes"]],
                                       "cell int, homes int, alls int")
        spread = dealt.join(F.broadcast(blocks), "cell")  # a row per cell: at most MOST_CELLS
        place = lambda count: F.pmod(F.xxhash64("class_id"), F.col(count)).cast("int")
        each = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
        keep = ["cell", "home", "class_id", "times", "embedding"]
        left = spread.where("home = cell").select(*keep, place("homes").alias("i"), each("alls").alias("j"), F.lit(0).alias("side"))
        right = spread.select(*keep, each("homes").alias("i"), place("alls").alias("j"), F.lit(1).alias("side"))
        out = out.union(left.unionByName(right).groupBy("cell", "i", "j").applyInPandas(_compare(cells, cosine), LINKS))
    return out


def near_duplicates(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding).

    ``n_links`` counts the other rows at this cosine or above, ``component_id`` is the least vec_id
    reached by links, ``kept`` is vec_id = component_id. Vectors that are null, empty, zero, or hold
    null or non-finite components link with nothing. A row with a null vec_id is compared, has the
    least vec_id linked with it (null if none) and isn't kept. Repeated rows link with each other and
    stay. An empty table gives an empty result."""
    rows = _keyed(vectors)
    # a class of equal vectors goes by a number of its own; equal keys mean equal vectors
    classes = written(rows.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("least"), F.count("*").alias("times"), F.any_value("embedding").alias("embedding"))
                      .withColumn("class_id", F.xxhash64("key")), "vector-classes")
    links = written(class_links(classes.select("class_id", "times", "embedding"), cosine), "vector-links")
    counts = links.where("other is null").groupBy("class_id").agg(F.sum("links").alias("links"))
    found = components(links.where("other is not null").select(F.col("class_id").alias("a"), F.col("other").alias("b")))
    known = (classes.select("key", "class_id", "times", "least").join(counts, "class_id", "left").join(found.withColumnRenamed("vertex", "class_id"), "class_id", "left")
             .withColumn("component", F.coalesce("component", "class_id")))
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(least, "component").select("key", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("links"), "component_id")
    return (rows.select("vec_id", "key").join(known, "key", "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
