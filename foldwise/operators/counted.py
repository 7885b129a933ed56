"""Params of every training fold from one table of counted values.

A column's rows are counted by value, with one count per training fold (the rows outside that fold) beside each
value. The table is dealt into ranges of (feature, value), and prefix sums over the ranges give every fold's order
statistics. Clipping only moves counts to the bounds and imputing only moves the count of nulls, so all later
params come from the same table: the median of clipped values is made of clipped order statistics, and moments are
sums over counted values. Rows are never copied to the folds that train on them, and no group is in one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.operators.fitting import MAX_PARAM_ROWS, long_values
from foldwise.session import materialize


def count_values(df: DataFrame, cols: Sequence[str], training: Mapping[int, Column]) -> DataFrame:
    """(feature, value, _range, n0, n1, ...): rows with each value (null included) in each training set; ``training`` says
    by a condition on the row which rows those are. Written once."""
    if len(cols) * len(training) > MAX_PARAM_ROWS:
        raise ValueError(f"more than {MAX_PARAM_ROWS} params; fit the columns in parts")
    flags = [c.alias(f"_in{i}") for i, c in enumerate(training.values())]
    kept = df.select(*flags, *[F.col(c).cast("double").alias(c) for c in cols])
    long = long_values(kept, cols, [f"_in{i}" for i in range(len(flags))])
    counts = long.groupBy("feature", "value").agg(*[F.count_if(f"_in{i}").alias(f"n{i}") for i in range(len(flags))])
    return materialize(counts.repartitionByRange("feature", "value").withColumn("_range", F.spark_partition_id()))


def order_statistics(counted: DataFrame, probs: Sequence[float], sets: int) -> dict[tuple[str, int], dict]:
    """{(feature, i): {n, nulls, at: [(lo, hi, weight of hi), ...]}} for training set ``i`` and each probability: the two
    values between which its quantile lies. A column without values has none."""
    here, order = counted.where("value is not null"), range(sets)
    totals = here.groupBy("feature", "_range").agg(*[F.sum(f"n{i}").alias(f"t{i}") for i in order])
    before, whole = Window.partitionBy("feature").orderBy("_range"), Window.partitionBy("feature")
    offsets = totals.select("feature", "_range", *[(F.sum(f"t{i}").over(before) - F.col(f"t{i}")).alias(f"o{i}") for i in order],
                            *[F.sum(f"t{i}").over(whole).alias(f"all{i}") for i in order])
    inside = Window.partitionBy("feature", "_range").orderBy("value")
    ranked = here.join(offsets, ["feature", "_range"]).select("*", *[(F.col(f"o{i}") + F.sum(f"n{i}").over(inside)).alias(f"c{i}") for i in order])
    picks = [F.max(f"all{i}").alias(f"n{i}") for i in order]
    for i in order:
        for j, p in enumerate(probs):
            at = (F.col(f"all{i}") - 1) * F.lit(float(p))
            for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
                holds = (F.col(f"c{i}") > rank) & (F.col(f"c{i}") - F.col(f"n{i}") <= rank)
                picks.append(F.max(F.when(holds, F.col("value"))).alias(f"{side}{i}_{j}"))
    found = {r["feature"]: r for r in ranked.groupBy("feature").agg(*picks).collect()}
    nulls = {r["feature"]: r for r in counted.where("value is null").collect()}
    out = {}
    for feature in {*found, *nulls}:
        for i in order:
            n = found[feature][f"n{i}"] if feature in found else 0
            h = [(n - 1) * float(p) for p in probs]
            at = [(found[feature][f"lo{i}_{j}"], found[feature][f"hi{i}_{j}"], h[j] - math.floor(h[j])) if n else (None, None, 0.0) for j in range(len(probs))]
            out[feature, i] = {"n": n, "nulls": nulls[feature][f"n{i}"] if feature in nulls else 0, "at": at}
    return out


def between(lo: float | None, hi: float | None, weight: float) -> float | None:
    """The interpolated quantile."""
    return lo if lo is None or lo == hi else (1 - weight) * lo + weight * hi


def clipped(value: float | None, lower: float | None, upper: float | None) -> float | None:
    return value if value is None or lower is None else min(max(value, lower), upper)


def modes(counted: DataFrame, features: Sequence[str], sets: int) -> dict[tuple[str, int], float | None]:
    """{(feature, i): the most frequent value, the least of them on ties}."""
    best = [F.max(F.when(F.col(f"n{i}") > 0, F.struct(F.col(f"n{i}"), -F.col("value"), "value"))).alias(f"m{i}") for i in range(sets)]
    rows = counted.where(F.col("feature").isin(list(features)) & F.col("value").isNotNull()).groupBy("feature").agg(*best).collect()
    return {(r["feature"], i): r[f"m{i}"]["value"] for r in rows for i in range(sets) if r[f"m{i}"]}


def moments(counted: DataFrame, params: Mapping[str, Sequence[Mapping]], prepare: Callable[[Column, Column, Column], Column]) -> dict[tuple[str, int], dict]:
    """{(feature, i): {center, std, min, max}} of prepared values. ``params[feature][i]``: ``lower`` and ``upper``
    bounds, the ``fill`` that nulls become, and its prepared form ``filled``. ``prepare(value, lower, upper)`` is the
    step on a value. Sums are taken of differences to ``filled``: nulls add nothing to them, and nothing cancels."""
    names, sets = ("lower", "upper", "filled"), len(next(iter(params.values()), ()))
    rows = [(f, *([p[i][name] for i in range(sets)] for name in names)) for f, p in params.items()]
    table = counted.sparkSession.createDataFrame(rows, "feature string, lower array<double>, upper array<double>, filled array<double>")
    aggs = []
    for i in range(sets):
        value = prepare(F.col("value"), F.get("lower", F.lit(i)), F.get("upper", F.lit(i)))
        n, d = F.col(f"n{i}"), value - F.get("filled", F.lit(i))
        aggs += [F.sum(n).alias(f"all{i}"), F.sum(n * d).alias(f"s{i}"), F.sum(n * d * d).alias(f"q{i}"),
                 F.min(F.when(n > 0, value)).alias(f"min{i}"), F.max(F.when(n > 0, value)).alias(f"max{i}")]
    joined = counted.join(F.broadcast(table), "feature")  # a row per column
    out = {}
    for r in joined.groupBy("feature").agg(*aggs).collect():
        for i in range(sets):
            filled, n = params[r["feature"]][i]["filled"], r[f"all{i}"]
            if filled is None or not n:
                out[r["feature"], i] = dict.fromkeys(("center", "std", "min", "max"))
                continue
            mean = (r[f"s{i}"] or 0.0) / n
            ends = [x for x in (r[f"min{i}"], r[f"max{i}"]) if x is not None] or [filled]
            out[r["feature"], i] = {"center": filled + mean, "std": math.sqrt(max(0.0, (r[f"q{i}"] or 0.0) / n - mean * mean)), "min": min(ends), "max": max(ends)}
    return out
