"""Vector operators: masked mean pooling (I22), text embedding column (I21), concatenation and
assembly (I24, I19, C4), standardise + PCA (I23).

Vectors are ``array<double>`` columns (or ``VectorUDT`` where ``pyspark.ml`` needs them).
Element-wise aggregates use the long form ``(key, pos, value)``: the partial aggregate runs
before the shuffle, so pooling many rows of a hot key costs one small partial row per
(partition, key, position).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import PCA, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.functions.text import safe_text, word_runs


def vector_long(df: DataFrame, keys: Sequence[str], vec_col: str) -> DataFrame:
    """(keys…, pos, value) — one row per vector element."""
    return df.select(*keys, F.posexplode(vec_col).alias("pos", "value"))


def mean_pool(df: DataFrame, keys: Sequence[str], vec_col: str, mask_col: str | None = None) -> DataFrame:
    """I22 long form: (keys…, pos, value) = Σ mask·v / max(Σ mask, 1e-9) per key and position.

    One aggregation with ``Summarizer`` (a vector buffer per key, partial aggregation before the
    shuffle); without a mask column every row has weight 1. A key whose masks are all 0 pools
    to the zero vector (the 1e-9 clamp).
    """
    x = df.select(*keys, array_to_vector(F.col(vec_col).cast("array<double>")).alias("_v"),
                  (F.col(mask_col).cast("double") if mask_col else F.lit(1.0)).alias("_m"))
    pos = x.where(F.col("_m") > 0)  # weight-0 rows add nothing to either sum
    g = pos.groupBy(*keys).agg(Summarizer.mean(F.col("_v"), F.col("_m")).alias("_mean"))
    out = g.select(*keys, F.posexplode(vector_to_array("_mean")).alias("pos", "value"))
    if not mask_col:
        return out
    # keys whose rows are all masked out pool to the zero vector
    empty = (df.groupBy(*keys).agg(F.max(F.col(mask_col).cast("double")).alias("_mx"),
                                   F.max(F.size(vec_col)).alias("_dim"))
               .where(~(F.col("_mx") > 0)))
    zeros = empty.select(*keys, F.posexplode(F.array_repeat(F.lit(0.0), F.col("_dim"))).alias("pos", "value"))
    return out.unionByName(zeros)


def long_to_array(long_df: DataFrame, keys: Sequence[str], out: str = "vector") -> DataFrame:
    """(keys…, pos, value) → (keys…, array ordered by pos). A vector has a fixed, small length."""
    g = long_df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("_p"))
    return g.select(*keys, F.transform("_p", lambda s: s["value"]).alias(out))


def hashed_text_embedding(df: DataFrame, id_col: str, text_col: str, dim: int = 64, seed: int = 42,
                          out: str = "embedding") -> DataFrame:
    """I21 (JVM-side default): every word run is a one-hot token vector in ``dim`` hashed
    buckets (md5 of the token with a seed), and the document vector is their mean (mask = real
    tokens) — I22 applied to token vectors. Whole texts; a document without tokens gets the
    zero vector."""
    # Tokens are exploded (codegen'd) and counted per bucket with one aggregation per document:
    # all tokens of a document sit in the same input partition, so the partial aggregate emits
    # one row per document before the shuffle. (Counting inside the row with higher-order
    # functions was measured 10–20× slower: lambdas are interpreted, per token × dimension.)
    # bucket = first 8 hex digits of md5(token:seed), mod dim.
    tok = df.select(F.col(id_col).alias("_id"), F.explode_outer(word_runs(safe_text(text_col))).alias("_t"))
    # the placeholder row of a token-less document stays NULL
    digits = F.substring(F.md5(F.concat(F.col("_t"), F.lit(f":{seed}"))), 1, 8)
    tok = tok.select("_id", (F.conv(digits, 16, 10).cast("long") % dim).cast("int").alias("_b"))
    x = tok.groupBy("_id").agg(F.count("_b").alias("_n"),
                               *[F.count_if(F.col("_b") == i).alias(f"_c{i}") for i in range(dim)])
    n = F.greatest(F.col("_n"), F.lit(1)).cast("double")
    vec = F.array(*[(F.col(f"_c{i}").cast("double") / n) for i in range(dim)])
    return x.select(F.col("_id").alias(id_col), vec.alias(out))


def embed_with_model(df: DataFrame, id_col: str, text_col: str, encode: Callable, dim: int,
                     out: str = "embedding") -> DataFrame:
    """I21 hook for a real sentence encoder: ``encode(list[str]) -> array (n, dim)`` runs on
    Arrow batches inside ``mapInPandas`` (load the model once per worker inside ``encode``)."""
    schema = f"{id_col} long, {out} array<double>"

    def run(batches):
        import pandas as pd
        for pdf in batches:
            texts = pdf[text_col].fillna("").astype(str).tolist()
            vecs = encode(texts) if texts else []
            yield pd.DataFrame({id_col: pdf[id_col].astype("int64"), out: [list(map(float, v)) for v in vecs]})

    return df.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInPandas(run, schema)


def concat_arrays(cols: Sequence[str]):
    """Concatenation of array<double> columns."""
    return F.concat(*[F.col(c).cast("array<double>") for c in cols])


def assemble(df: DataFrame, scalar_cols: Sequence[str], array_cols: dict[str, int] | None = None,
             out: str = "features") -> DataFrame:
    """One ``VectorUDT`` column from scalar and fixed-size array columns ({name: size}),
    in role order. NULL scalars are kept as NaN (the model decides), never dropped."""
    tmp = df
    vec_cols = []
    for c, size in (array_cols or {}).items():
        tmp = tmp.withColumn(f"_v_{c}", array_to_vector(F.col(c).cast("array<double>")))
        tmp = VectorSizeHint(inputCol=f"_v_{c}", size=size, handleInvalid="error").transform(tmp)
        vec_cols.append(f"_v_{c}")
    va = VectorAssembler(inputCols=list(scalar_cols) + vec_cols, outputCol=out, handleInvalid="keep")
    return va.transform(tmp).drop(*vec_cols)


def named(vector: Column, names: Sequence[str], out: str = "features") -> Column:
    """``vector`` as column ``out`` that carries the names of its elements as ML attributes."""
    attributes = {"numeric": [{"idx": i, "name": n} for i, n in enumerate(names)]}
    return vector.alias(out, metadata={"ml_attr": {"attrs": attributes, "num_attrs": len(names)}})


def names_of(df: DataFrame, column: str = "features") -> list[str]:
    """The names of a vector column's elements, from its ML attributes (assembled columns carry them, too)."""
    about = df.schema[column].metadata.get("ml_attr", {})
    names = {a["idx"]: a["name"] for kind in about.get("attrs", {}).values() for a in kind if "name" in a}
    return [names.get(i, f"{column}_{i}") for i in range(about.get("num_attrs", len(names)))]


def feature_names(scalar_cols: Sequence[str], array_cols: dict[str, int], prefixes: dict[str, str]) -> list[str]:
    """Output names: scalars as given, array element i as ``<prefix>_<i:03d>``."""
    names = list(scalar_cols)
    for c, n in array_cols.items():
        names += [f"{prefixes.get(c, c)}_{i:03d}" for i in range(n)]
    return names


def standardized_pca(df: DataFrame, vec_col: str, k: int, dim: int) -> tuple[DataFrame, list[float]]:
    """Population-standardise each element (std 0 → 1), then ``ml.feature.PCA(k)``.
    Returns the projected frame (``pca`` column, array<double>) and the explained variance."""
    long = vector_long(df, [], vec_col)
    st = long.groupBy("pos").agg(F.avg("value").alias("mu"), F.stddev_pop("value").alias("sd"))
    rows = {r["pos"]: (r["mu"], r["sd"] or 1.0) for r in st.collect()}  # dim rows
    mu = F.array(*[F.lit(float(rows[i][0])) for i in range(dim)])
    sd = F.array(*[F.lit(float(rows[i][1]) if rows[i][1] else 1.0) for i in range(dim)])
    z = F.zip_with(F.zip_with(F.col(vec_col).cast("array<double>"), mu, lambda a, b: a - b), sd, lambda a, b: a / b)
    x = df.withColumn("_z", array_to_vector(z))
    model = PCA(k=k, inputCol="_z", outputCol="_pca").fit(x)
    out = model.transform(x).withColumn("pca", vector_to_array("_pca")).drop("_z", "_pca")
    return out, [float(v) for v in model.explainedVariance.toArray()]
