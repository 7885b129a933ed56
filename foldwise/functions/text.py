"""Text expressions: null-safe text (H15) and the 15 handcrafted features.

All features are built-in expressions. Word-boundary rules are expressed through *maximal runs
of word characters* (letters, digits, underscore): a boundary-delimited match of a single word
is exactly such a run, so "``\\bword\\b`` matches" becomes "some run equals word". That keeps
the same meaning in every regex dialect (Java's and RE2's ``\\b``, ``\\d`` and ``\\s`` differ on
non-ASCII text).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed character classes (Unicode-aware, same meaning in Java and RE2 regex dialects).
WORD_RUN = r"[\p{L}\p{N}_]+"
WHITESPACE = r"[\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}]"
NON_WHITESPACE_RUN = r"[^\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}]+"
CJK = r"[\x{4E00}-\x{9FFF}]"
UPPER = r"\p{Lu}"
DIGIT = r"\p{Nd}"
# Fixed value: the punctuation marks that are counted.
PUNCT = r"[.,!?;:~\-]"

# The feature names, in output order.
FEATURE_NAMES = ["text_len", "word_count", "avg_word_len", "is_empty", "chinese_ratio", "upper_ratio",
                 "punctuation_count", "has_self_ref", "has_keyword_a", "has_keyword_b", "sentiment_positive",
                 "ends_with_period", "is_all_lower", "has_number", "is_short_simple"]


def safe_text(c) -> Column:
    """NULL → '' and anything → string."""
    x = F.col(c) if isinstance(c, str) else c
    return F.coalesce(x.cast("string"), F.lit(""))


def words(t: Column) -> Column:
    """Whitespace-separated words (empty pieces dropped), like Python's ``str.split()``."""
    return F.filter(F.split(t, WHITESPACE + "+"), lambda w: w != "")


def word_runs(t: Column) -> Column:
    """Maximal runs of word characters, lower-cased."""
    return F.regexp_extract_all(F.lower(t), F.lit(WORD_RUN), 0)


def count_matches(t: Column, pattern: str) -> Column:
    return F.regexp_count(t, F.lit(pattern))


def _run_pattern(vocab: Sequence[str]) -> str:
    """Regex matching a whole word run equal to one of ``vocab`` (no word character on either
    side) — a match is exactly a maximal run equal to the word. A look at the first character passes most places by."""
    low = [w.lower() for w in vocab]
    alt = "|".join(r"\Q" + w + r"\E" for w in low)
    first = "" if "" in low else "(?=[" + "".join(rf"\x{{{ord(c):X}}}" for c in sorted({w[0] for w in low})) + "])"
    return rf"{first}(?<![\p{{L}}\p{{N}}_])(?:{alt})(?![\p{{L}}\p{{N}}_])"


def _count_in(lower_t: Column, vocab: Sequence[str]) -> Column:
    if not vocab:
        return F.lit(0)
    return F.regexp_count(lower_t, F.lit(_run_pattern(vocab)))


def _holds(lower_t: Column, vocab: Sequence[str]) -> Column:
    return F.regexp_like(lower_t, F.lit(_run_pattern(vocab))) if vocab else F.lit(False)


def handcrafted(text_col: str, keywords_a: Sequence[str], keywords_b: Sequence[str],
                positive_words: Sequence[str], self_words: Sequence[str] = ("i",)) -> list[Column]:
    """The 15 features (doubles), named as :data:`FEATURE_NAMES`. Word lists are parameters.

    ``self_words``: a self-reference is a standalone word run equal to one of them
    (``I``, ``I'm`` and ``I am`` all contain the standalone run ``i``).
    """
    t = safe_text(text_col)
    low = F.lower(t)
    n = F.length(t)
    # all counts are codegen'd regex scans (no per-token lambdas): words are maximal
    # non-whitespace runs, so their total length is the number of non-whitespace characters
    wc = count_matches(t, NON_WHITESPACE_RUN)
    denom = F.greatest(n, F.lit(1)).cast("double")
    # not a ``when``, which would count the words once more
    avg_len = F.coalesce(F.try_divide(n - count_matches(t, WHITESPACE), wc), F.lit(0.0))
    feats = [
        n,
        wc,
        avg_len,
        n == 0,
        count_matches(t, CJK) / denom,
        count_matches(t, UPPER) / denom,
        count_matches(t, PUNCT),
        _holds(low, self_words),
        _holds(low, keywords_a),
        _holds(low, keywords_b),
        _count_in(low, positive_words),
        F.regexp_like(t, F.lit(r"\." + WHITESPACE + r"*\z")),
        (t == low) & (n > 0),
        F.regexp_like(t, F.lit(DIGIT)),
        (n > 0) & (n <= 8) & ~F.contains(t, F.lit(" ")),
    ]
    return [f.cast("double").alias(name) for f, name in zip(feats, FEATURE_NAMES)]
