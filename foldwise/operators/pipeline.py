"""Leak-safe preprocessing with a model (J1 J4 J21 J22 J25 A12): every learnt step of every fold is fitted on
that fold's training rows only, step after step, and saved with the model.

Roles: numbers go through clip → impute → derived ratio → scale, long tails through impute → lower clip → log1p →
scale, ordinals through impute, and text through impute → one-hot. All folds are fitted from the same few tables:
counted values with a count per training fold (:mod:`foldwise.operators.counted`), counted categories, and for ratios
one aggregate with an expression per fold. No row is copied to the folds that train on it. Params have a row per
fold and column and are inlined as literals.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.functions import exprs
from foldwise.operators import counted, derive, encode, fitting, impute, metrics, train, vectors, weights
from foldwise.session import materialize

#: The fold number of the fit on all rows.
ALL_ROWS = -1
_FOLD = "_params_of"


@dataclass
class FoldPipeline:
    """``ratios``: (numerator, denominator), two of ``numeric``, of the derived columns that ``flags`` switch on.
    ``scaler``: standard (population deviation) or minmax."""

    numeric: Sequence[str]
    categorical: Sequence[str] = ()
    lower_pct: float = 1.0
    upper_pct: float = 99.0
    text_mode: str = "new"
    ratios: tuple[str, str] | None = None
    flags: Mapping[str, bool] = field(default_factory=lambda: {"ratio": True})
    longtail: Sequence[str] = ()
    ordinal: Sequence[str] = ()
    longtail_min: float = 0.0
    scaler: str = "standard"
    tables: dict[str, DataFrame] = field(default_factory=dict)
    _fetched: dict[str, list] = field(default_factory=dict, repr=False)

    @property
    def derived(self) -> list[str]:
        return [n for n, on in self.flags.items() if on] if self.ratios else []

    @property
    def scaled(self) -> list[str]:
        return [*self.numeric, *self.derived, *self.longtail]

    @property
    def inputs(self) -> list[str]:
        return [*self.numeric, *self.longtail, *self.ordinal, *self.categorical]

    @property
    def _table_names(self) -> list[str]:
        return ["clip", "median", "scale", *(["mode"] if self.ordinal else []), *(["fill", "categories"] if self.categorical else [])]

    def fit(self, df: DataFrame, k: int, fold_col: str = "fold") -> FoldPipeline:
        if self.scaler not in ("standard", "minmax"):
            raise ValueError(f"unknown scaler {self.scaler!r}")
        if not set(self.ratios or ()) <= set(self.numeric):
            raise ValueError("ratios are made of numeric columns")
        self._fetched.clear()
        training = {ALL_ROWS: F.lit(True)} | {f: F.col(fold_col) != f for f in range(k)}
        sets = list(training)

        def put(name: str, kind: str, rows: list) -> None:
            self.tables[name] = df.sparkSession.createDataFrame(rows, f"{_FOLD} int, feature string, {kind}")

        values = counted.count_values(df, [*self.numeric, *self.longtail, *self.ordinal], training)
        stats = counted.order_statistics(values, [self.lower_pct / 100, self.upper_pct / 100, 0.5], len(sets))
        none = {"at": [(None, None, 0.0)] * 3}
        params: dict[str, list[dict]] = {}
        for c in (*self.numeric, *self.longtail):
            for i in range(len(sets)):
                low, high, middle = stats.get((c, i), none)["at"]
                if c in self.longtail:
                    fill = counted.between(*middle)
                    one = {"lower": None, "upper": None, "fill": fill, "filled": None if fill is None else math.log1p(max(fill, self.longtail_min))}
                else:
                    lower, upper = counted.between(*low), counted.between(*high)
                    fill = counted.between(counted.clipped(middle[0], lower, upper), counted.clipped(middle[1], lower, upper), middle[2])
                    one = {"lower": lower, "upper": upper, "fill": fill, "filled": fill}
                params.setdefault(c, []).append(one)
        known = [(f, c, p) for c, ps in params.items() for f, p in zip(sets, ps) if p["fill"] is not None]
        put("clip", "lower double, upper double", [(f, c, p["lower"], p["upper"]) for f, c, p in known if c in self.numeric])
        put("median", "value double", [(f, c, p["fill"]) for f, c, p in known])
        found = counted.moments(values, {c: params[c] for c in self.numeric}, exprs.clip)
        if self.longtail:
            found |= counted.moments(values, {c: params[c] for c in self.longtail}, lambda v, lower, upper: F.log1p(exprs.clip_lower(v, self.longtail_min)))
        if self.ratios:
            found |= self._ratio_moments(df, training, params)
        put("scale", "center double, scale double", [(sets[i], c, *self._scale(m)) for (c, i), m in sorted(found.items()) if m["center"] is not None])
        if self.ordinal:
            put("mode", "value double", [(sets[i], c, v) for (c, i), v in sorted(counted.modes(values, self.ordinal, len(sets)).items())])
        if self.categorical:
            self._fit_categories(df, training, put)
        return self

    def _scale(self, m: Mapping) -> tuple[float, float]:
        center, scale = (m["center"], m["std"]) if self.scaler == "standard" else (m["min"], m["max"] - m["min"])
        return center, scale or 1.0

    def _ratio_moments(self, df: DataFrame, training: Mapping[int, Column], params: Mapping) -> dict:
        """One aggregate over the rows, with an expression per training fold."""
        aggs = []
        for i, rows in enumerate(training.values()):
            a, b = (F.coalesce(exprs.clip(F.col(c).cast("double"), F.lit(params[c][i]["lower"]).cast("double"), F.lit(params[c][i]["upper"]).cast("double")),
                               F.lit(params[c][i]["fill"]).cast("double")) for c in self.ratios)
            for name, value in derive.derived_columns(a, b, self.flags).items():
                value = F.when(rows, value)
                aggs += [how(value).alias(f"{what}{i}_{name}") for what, how in (("center", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))]
        found = df.agg(*aggs).first()
        return {(name, i): {what: found[f"{what}{i}_{name}"] for what in ("center", "std", "min", "max")} for name in self.derived for i in range(len(training))}

    def _fit_categories(self, df: DataFrame, training: Mapping[int, Column], put) -> None:
        """From counted categories with a count per training fold. Only the fills reach the driver."""
        flags = [c.alias(f"_in{i}") for i, c in enumerate(training.values())]
        long = (df.select(*flags, *[F.col(c).cast("string").alias(c) for c in self.categorical])
                .unpivot([f"_in{i}" for i in range(len(flags))], list(self.categorical), "feature", "value"))
        counts = materialize(long.groupBy("feature", "value").agg(*[F.count_if(f"_in{i}").alias(f"n{i}") for i in range(len(flags))]))
        how = impute.preset_text(self.text_mode)
        if how["strategy"] == "constant":
            best = [F.when(F.sum(f"n{i}") > 0, F.lit(how["fill_value"])).alias(f"m{i}") for i in range(len(flags))]
        else:
            some = lambda i: F.when((F.col(f"n{i}") > 0) & F.col("value").isNotNull(), F.struct(-F.col(f"n{i}"), "value"))
            best = [F.min(some(i))["value"].alias(f"m{i}") for i in range(len(flags))]
        fills = counts.groupBy("feature").agg(*best).collect()
        put("fill", "value string", [(f, r["feature"], r[f"m{i}"]) for r in fills for i, f in enumerate(training) if r[f"m{i}"] is not None])
        each = F.array(*[F.when(F.col(f"n{i}") > 0, F.lit(f)) for i, f in enumerate(training)])
        seen = counts.select(F.explode(F.array_compact(each)).alias(_FOLD), "feature", "value")
        filled = seen.join(F.broadcast(self.tables["fill"].withColumnRenamed("value", "fill")), [_FOLD, "feature"], "left")  # a row per column and fold
        self.tables["categories"] = materialize(filled.select(_FOLD, "feature", F.coalesce("value", "fill").alias("category")).where("category is not null").distinct())

    def _rows(self, name: str, limit: int = fitting.MAX_PARAM_ROWS) -> list:
        """A params table on the driver, fetched once; its size is checked."""
        if name not in self._fetched:
            rows = self.tables[name].limit(limit + 1).collect()
            if len(rows) > limit:
                raise ValueError(f"more than {limit} rows in {name!r}" + ("; use target encoding instead" if name == "categories" else ""))
            self._fetched[name] = rows
        return self._fetched[name]

    def _param(self, name: str, column: str, value: str, fold: int | Column) -> Column:
        """A fitted value as a literal, or chosen by a fold column."""
        found = {r[_FOLD]: r[value] for r in self._rows(name) if r["feature"] == column}
        kind = "string" if name == "fill" else "double"
        if isinstance(fold, int):
            return F.lit(found.get(fold)).cast(kind)
        out = F.lit(None).cast(kind)
        for f, v in sorted(found.items()):
            out = F.when(fold == f, F.lit(v).cast(kind)).otherwise(out)
        return out

    def _indicators(self, fold: int | Column) -> dict[str, Column]:
        learnt: dict[tuple[str, str], list[int]] = {}
        for r in self._rows("categories", encode.MAX_CATEGORIES):
            learnt.setdefault((r["feature"], r["category"]), []).append(r[_FOLD])
        out = {}
        for c, v in sorted(learnt, key=lambda k: (list(self.categorical).index(k[0]), k[1])):
            value = F.coalesce(F.col(c).cast("string"), self._param("fill", c, "value", fold))
            known = F.lit(fold in learnt[c, v]) if isinstance(fold, int) else fold.isin(learnt[c, v])
            out[f"cat__{c}_{v}"] = F.coalesce(((value == F.lit(v)) & known).cast("double"), F.lit(0.0))
        return out

    def apply(self, df: DataFrame, fold: int | Column) -> DataFrame:
        """``df`` with its columns prepared by the params of ``fold`` (a number or a column); numbers keep
        their names, text becomes ``cat__<column>_<value>``. A projection."""
        at = lambda name, c, value: self._param(name, c, value, fold)
        new = {c: F.coalesce(exprs.clip(F.col(c).cast("double"), at("clip", c, "lower"), at("clip", c, "upper")), at("median", c, "value")) for c in self.numeric}
        new |= {c: F.log1p(exprs.clip_lower(F.coalesce(F.col(c).cast("double"), at("median", c, "value")), self.longtail_min)) for c in self.longtail}
        new |= {c: F.coalesce(F.col(c).cast("double"), at("mode", c, "value")) for c in self.ordinal}
        indicators = self._indicators(fold) if self.categorical else {}
        kept = [c for c in df.columns if c not in self.categorical]
        x = df.select(*[new[c].alias(c) if c in new else F.col(c) for c in kept], *[e.alias(name) for name, e in indicators.items()],
                      *([fold.alias(_FOLD)] if isinstance(fold, Column) else []))
        if isinstance(fold, Column):
            fold = F.col(_FOLD)  # the fold column may itself have been prepared
        ratios = derive.derived_columns(*self.ratios, self.flags) if self.ratios else {}
        scaled = lambda c, value: (value - at("scale", c, "center")) / at("scale", c, "scale")
        plain = [scaled(c, F.col(c)).alias(c) if c in self.numeric or c in self.longtail else F.col(c) for c in kept]
        return x.select(*plain, *[scaled(n, e).alias(n) for n, e in ratios.items()], *[F.col(f"`{n}`") for n in indicators])

    def outputs(self, prepared: DataFrame) -> dict[str, str]:
        """Columns of a prepared table that make up the vector, and their names by role."""
        names = {c: f"num__{c}" for c in (*self.numeric, *self.derived)} | {c: f"log__{c}" for c in self.longtail} | {c: f"ord__{c}" for c in self.ordinal}
        return names | {c: c for c in sorted(c for c in prepared.columns if c.startswith("cat__"))}

    def features(self, df: DataFrame, fold: int | Column, keep: Sequence[str], out: str = "features") -> DataFrame:
        """``keep`` and a vector of all prepared columns (nulls left by columns without values are 0), with the names of
        :meth:`outputs` in its metadata."""
        x = self.apply(df, fold)
        names = self.outputs(x)
        vector = array_to_vector(F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in names]))
        return x.select(*keep, vectors.named(vector, list(names.values()), out))

    def save(self, path: str) -> None:
        for name, table in self.tables.items():
            table.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")  # a row per fold and column, or category

    def load(self, spark: SparkSession, path: str) -> FoldPipeline:
        self._fetched.clear()
        for name in self._table_names:
            self.tables[name] = spark.read.parquet(f"{path}/{name}")
        return self


def cross_validate(df: DataFrame, pipe: FoldPipeline, kind: str, params: Mapping | None, k: int, id_col: str = "id",
                   label: str = "target", fold_col: str = "fold", class_weight: str | None = "balanced", seed: int = 42) -> tuple[DataFrame, list]:
    """(metrics per fold and split, models): preparation, class weights and model of a fold come from its
    training rows; both splits are scored through that fold's preparation."""
    pipe.fit(df, k, fold_col)

    def fit_fold(f: int):
        rows, column = pipe.features(df.where(F.col(fold_col) != f), f, [label]), None
        if class_weight:
            rows, column = weights.with_weights(rows, label, weights.class_weights(rows, label, class_weight), "_weight"), "_weight"
        return train.make_estimator(kind, params, label, weight=column, seed=seed).fit(rows)

    with ThreadPoolExecutor(max_workers=min(4, k)) as pool:
        models = list(pool.map(fit_fold, range(k)))
    # one scan: every row through every fold's preparation and model
    x = df.select(label, fold_col, *[F.col(c).alias(f"_raw_{c}") for c in pipe.inputs])
    for f in range(k):
        x = pipe.features(x.select("*", *[F.col(f"_raw_{c}").alias(c) for c in pipe.inputs]), f, x.columns, f"_features{f}")
    counts = train.confusion_of(x, [(0, f, m.copy({m.featuresCol: f"_features{f}"})) for f, m in enumerate(models)], label, fold_col)
    return metrics.metrics_from_confusion(counts.drop("candidate"), ["fold", "split"]), models


def importances(df: DataFrame, pipe: FoldPipeline, models: Sequence) -> DataFrame:
    """(fold, feature, importance) of a cross-validation's models, by the names that their vectors carry."""
    out = None
    for f, model in enumerate(models):
        rows = train.importance_rows(df.sparkSession, model, f, vectors.names_of(pipe.features(df, f, [])))
        out = rows if out is None else out.unionByName(rows)
    return out


def fit_all(df: DataFrame, pipe: FoldPipeline, kind: str, params: Mapping | None, label: str = "target", class_weight: str | None = "balanced", seed: int = 42):
    """The model on all rows, through the params of all rows."""
    x = pipe.features(df, ALL_ROWS, [label])
    column = None
    if class_weight:
        x, column = weights.with_weights(x, label, weights.class_weights(x, label, class_weight), "_weight"), "_weight"
    return train.make_estimator(kind, params, label, weight=column, seed=seed).fit(x)
