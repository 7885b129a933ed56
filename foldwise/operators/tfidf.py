"""TF-IDF in long form (I20): lower-case word-run tokens, vocabulary = top-N terms by corpus
count after dropping terms present in more than ``max_df`` of the documents, sublinear tf,
smoothed idf ``ln((1+n)/(1+df)) + 1``, L2 norm per document over the vocabulary.

Plan shape: tokens are exploded per document and counted per (doc, term) — the partial
aggregate runs before the shuffle, so the shuffle carries distinct (doc, term) pairs. Document
frequencies are a second aggregate of those pairs (map-side combined, so a term found in a
third of all documents does not load one task). The vocabulary is a top-N (TakeOrderedAndProject,
bounded by ``max_features``) and is broadcast; ``max_features`` is required for that reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.functions.text import safe_text, word_runs
from foldwise.session import checkpoint_dir

MAX_VOCAB = 1_000_000


def term_counts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, term, tf) — whole texts, every token."""
    tok = df.select(F.col(id_col).alias("id"), F.explode(word_runs(safe_text(text_col))).alias("term"))
    return tok.groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))


def fit_vocabulary(df: DataFrame, id_col: str, text_col: str, max_features: int, max_df: float = 0.95,
                   min_df: int = 1, tc: DataFrame | None = None) -> DataFrame:
    """(term, df, idf) for the kept terms. Ties in corpus count are broken by term."""
    if not 0 < max_features <= MAX_VOCAB:
        raise ValueError(f"max_features must be in 1..{MAX_VOCAB}")
    n_docs = df.select(F.count(F.lit(1))).scalar()
    tc = term_counts(df, id_col, text_col) if tc is None else tc
    stats = tc.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
    kept = stats.where((F.col("df") <= F.lit(max_df) * n_docs) & (F.col("df") >= min_df))
    top = kept.orderBy(F.desc("cf"), F.asc("term")).limit(max_features)
    return top.select("term", "df", (F.log((1 + n_docs) / (1 + F.col("df"))) + 1).alias("idf"))


def transform(df: DataFrame, vocab: DataFrame, id_col: str, text_col: str, tc: DataFrame | None = None) -> DataFrame:
    """(id, term, weight): non-zero L2-normalised weights of each document."""
    tc = term_counts(df, id_col, text_col) if tc is None else tc
    w = tc.join(F.broadcast(vocab.select("term", "idf")), "term").select(
        "id", "term", ((1 + F.log(F.col("tf"))) * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("id")))
    return w.select(F.col("id").alias(id_col), "term", (F.col("w") / norm).alias("weight"))


def tfidf_long(df: DataFrame, id_col: str, text_col: str, max_features: int, max_df: float = 0.95) -> DataFrame:
    """Fit and apply on the same documents. The (doc, term) counts feed both the vocabulary and
    the weights; they are materialised once with a reliable checkpoint (shared checkpoint
    folder), so texts are tokenised once and the two branches do not repeat the shuffle."""
    checkpoint_dir(df.sparkSession)
    tc = term_counts(df, id_col, text_col).checkpoint(eager=True)
    return transform(df, fit_vocabulary(df, id_col, text_col, max_features, max_df, tc=tc), id_col, text_col, tc=tc)
