"""Toxicity by compression distance: which zstandard dictionary makes a window shorter?

Training (on a bounded sample of labelled rows) makes two dictionaries of one size. The *ordinary* one is
trained by zstandard on windows of ordinary text. The *toxic* one is trained by zstandard on what toxic
documents add to that: their words, in groups, that recur there in many different contexts, far more often than in
ordinary documents; behind them it holds the ordinary dictionary's content. (Trained on whole toxic windows it
would hold what is frequent in any text, and miss the few words that make a document toxic.) So ordinary text is
as long under either dictionary, and the difference of the two compressed lengths of a window is what toxic
passages save.

A document is cut into windows of ``WINDOW`` bytes, whole words each, and every window is
compressed twice. The greatest differences, and how many pass a threshold, go through a logistic fit that is
calibrated on sample rows which the dictionaries haven't seen.

Only the ids of the sample, counts of words, windows of the ordinary class and five numbers per calibration row
reach the driver. Texts of the sample stay on the executors; of a text longer than ``SAMPLE_BYTES``, random
pieces of that size together teach.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import map_batches, sampled, small_batches, written

WINDOW = 96
LEVEL = 5
ORDINARY_BYTES = 14_000
#: Bounds of the training sample: labelled documents, and bytes of each, in so many pieces. Half of the documents are
#: toxic, if there are as many; a class with fewer leaves its places to the other.
SAMPLE_ROWS = 8_000
SAMPLE_BYTES, PIECES = 32_768, 8
#: A toxic word has so many times its share in ordinary text, and so many different contexts that of all
#: words fewer than CHANCE would have them in toxic text only, if they fell there by the texts' sizes.
LEAST_RATIO, CHANCE = 15, 0.1
#: Of the sample's documents of each class, the dictionaries learn from this share; the rest calibrates.
DICTIONARY_SHARE = 0.65
#: Windows of ordinary text that train its dictionary, and bytes of each.
ORDINARY_WINDOWS, ORDINARY_WINDOW = 20_000, 200
#: Bytes of the toxic dictionary for a byte of different words, samples of a word at most, and words of a sample.
ROOM, SAMPLES, TOGETHER = 1, 100, 4
#: Bytes that a window saves.
THRESHOLDS = (1, 3, 5, 7)
_WORD = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
_WINDOW = re.compile(rb"(?s).{%d}\S{0,%d}|.+" % (WINDOW, WINDOW))


def windows(text: str | None) -> list[bytes]:
    """The whole text in windows that end with a word (or after 2 * WINDOW bytes)."""
    return _WINDOW.findall((text or "").encode().lower())


def pieces(text: str | None, seed: int) -> list[bytes]:
    """The text, or of a longer one than ``SAMPLE_BYTES`` random pieces from all over it, whole words each."""
    data = (text or "").encode().lower()
    if len(data) <= SAMPLE_BYTES:
        return [data]
    rng, size = random.Random(seed), SAMPLE_BYTES // PIECES
    part = len(data) / PIECES
    starts = [int(i * part + rng.random() * (part - size)) for i in range(PIECES)]
    return [re.sub(rb"(?s)^\S+\s+(?=.)|\s+\S*$", b"", data[i:i + size]) for i in starts]


def _each(batches: Iterator[pa.RecordBatch], fn, names: list[str], kinds: list) -> Iterator[pa.RecordBatch]:
    """Rows that ``fn`` makes of each row, a few input rows at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, 4):  # a row of the sample has thousands of words
            rows = [r for row in batch.slice(i, 4).to_pylist() for r in fn(row)]
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _document_words(row: dict) -> list[tuple]:
    return [(w, row["toxic"]) for w in {w for p in row["pieces"] for w in _WORD.findall(p)}]


def _contexts(row: dict) -> set[tuple]:
    """(word, class, word before, word after)."""
    found = set()
    for p in row["pieces"]:
        words = [b"", *_WORD.findall(p), b""]
        found.update((w, row["toxic"], before, after) for before, w, after in zip(words, words[1:], words[2:]))
    return found


def toxic_words(sample: DataFrame, sizes: Sequence[int]) -> list[tuple[bytes, int]]:
    """Words of ``sample`` (toxic, pieces) that are no chance in toxic texts, with the number of their different neighbours
    there, fewest first. Counting contexts rather than occurrences keeps copies of a text from making its words look
    frequent. ``sizes``: bytes of the ordinary and of the toxic pieces. All counts are taken by Spark."""
    words = sample.mapInArrow(lambda b: _each(b, _document_words, ["word", "toxic"], [pa.binary(), pa.int32()]), "word binary, toxic int")
    words = written(words.groupBy("word").agg(F.sum("toxic").alias("n")), "toxic-words")
    least = math.ceil(math.log(max(2, words.count()) / CHANCE) / math.log(sum(sizes) / sizes[1]))

    def ratio(toxic, ordinary):
        return (toxic >= least) & (toxic / sizes[1] >= LEAST_RATIO * (ordinary + 0.5) / sizes[0])

    likely = words.where(ratio(F.col("n"), F.lit(0))).select("word")
    names = ["word", "toxic", "before", "after"]
    contexts = sample.mapInArrow(lambda b: _each(b, _contexts, names, [pa.binary(), pa.int32(), pa.binary(), pa.binary()]),
                                 "word binary, toxic int, before binary, after binary").join(likely, "word", "left_semi").distinct()
    counts = contexts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("ordinary"))
    chosen = [(bytes(r["word"]), r["toxic"]) for r in counts.where(ratio(F.col("toxic"), F.col("ordinary"))).collect()]
    return sorted(chosen, key=lambda r: (r[1], r[0]))


def toxic_content(words: list[tuple[bytes, int]]) -> bytes:
    """What zstandard trains on samples of the words (each as often as it has contexts, up to ``SAMPLES``), after those
    words that it left out."""
    samples = [b" " + w + b" " for w, n in words for _ in range(min(n, SAMPLES))]
    random.Random(7).shuffle(samples)
    size = -(-ROOM * sum(len(w) + 2 for w, _ in words) // 512) * 512
    try:
        content = zstandard.train_dictionary(size, [b"".join(samples[i:i + TOGETHER]) for i in range(0, len(samples), TOGETHER)]).as_bytes()[-size:]
    except zstandard.ZstdError:  # too few samples to train on
        content = b""
    return b"".join(b" " + w + b" " for w, _ in words if b" " + w + b" " not in content) + content


def ordinary_content(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(ORDINARY_BYTES, samples).as_bytes()[-ORDINARY_BYTES:]
    except zstandard.ZstdError:  # too few samples to train on: their own text
        return b"".join(samples)[-ORDINARY_BYTES:]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    parameters = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_dict_id=False, write_checksum=False)
    dictionary.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)


@dataclass(frozen=True)
class Model:
    """The two dictionaries' contents and the calibration (weights, then the intercept)."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]


_COMPRESSORS: dict[tuple[bytes, bytes], tuple] = {}


def _compressors(model: Model) -> tuple:
    key = (model.ordinary, model.toxic)
    if key not in _COMPRESSORS:
        _COMPRESSORS.clear()
        _COMPRESSORS[key] = (_compressor(model.ordinary), _compressor(model.toxic))
    return _COMPRESSORS[key]


def window_features(model: Model, found: list[bytes]) -> list[float]:
    """The greatest three savings by the toxic dictionary, and logarithms of how many exceed each threshold and of
    the number of windows: the more there are, the more one of them saves by chance."""
    plain, toxic = _compressors(model)
    saved = [len(plain.compress(w)) - len(toxic.compress(w)) for w in found]
    top = [*sorted((max(x, 0) for x in saved), reverse=True)[:3], 0, 0, 0]
    return [*top[:3], *(math.log1p(sum(x > t for x in saved)) for t in THRESHOLDS), math.log1p(len(saved))]


def features(model: Model, text: str | None) -> list[float]:
    return window_features(model, windows(text))


def logistic(x: np.ndarray, y: np.ndarray, rows: np.ndarray) -> tuple[float, ...]:
    """Newton's method with a small ridge. Each row counts as so many as ``rows`` says."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (rows * (p - y)) + 1e-2 * w
        curve = (x * (rows * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w = w - np.linalg.solve(curve, slope)
    return tuple(map(float, w))


def train(rows: DataFrame, shares: Sequence[float] = (1, 1)) -> Model | None:
    """A model from ``rows`` (at, toxic, text), a bounded sample: in the order of ``at``, the first of each class teach
    the dictionaries. None without rows of both classes. ``shares``: which part of all ordinary and of all toxic
    documents the rows are; the calibration weighs them back. Rows with the same ``at`` are one: the least text."""
    small_batches(rows.sparkSession)
    rows = rows.groupBy("at", "toxic").agg(F.min("text").alias("text"))
    cut = rows.mapInArrow(lambda b: _each(b, lambda r: [(r["at"], r["toxic"], pieces(r["text"], r["at"]))], ["at", "toxic", "pieces"],
                                          [pa.int64(), pa.int32(), pa.list_(pa.binary())]), "at long, toxic int, pieces array<binary>")
    sample = written(cut, "toxic-sample")
    size = F.aggregate("pieces", F.lit(0), lambda n, p: n + F.octet_length(p))
    known = sorted(tuple(r) for r in sample.select("toxic", "at", size.alias("size")).collect())
    classes = [[r for r in known if r[0] == k] for k in (0, 1)]
    if not all(classes):
        return None
    cuts = [math.ceil(DICTIONARY_SHARE * len(rows)) for rows in classes]
    before = [rows[cut][1] if cut < len(rows) else None for rows, cut in zip(classes, cuts)]  # the first that calibrates
    sizes = [max(1, sum(r[2] for r in rows[:cut])) for rows, cut in zip(classes, cuts)]
    calibrates = F.when(F.col("toxic") == 1, F.col("at") >= F.lit(before[1])).otherwise(F.col("at") >= F.lit(before[0]))
    calibrates = F.coalesce(calibrates, F.lit(False))
    teach, rest = sample.where(~calibrates), sample.where(calibrates)
    if None in before:
        rest = sample
    step = max(2000, -(-sizes[0] // ORDINARY_WINDOWS))
    cut_windows = lambda r: [(r["at"], j, p[j:j + ORDINARY_WINDOW]) for p in r["pieces"] for j in range(0, len(p), step)]
    ordinary = teach.where("toxic = 0").mapInArrow(lambda b: _each(b, cut_windows, ["at", "j", "w"], [pa.int64(), pa.int64(), pa.binary()]), "at long, j long, w binary")
    base = ordinary_content([bytes(r[2]) for r in sorted(tuple(r) for r in ordinary.limit(2 * ORDINARY_WINDOWS + SAMPLE_ROWS).collect())])
    content = toxic_content(toxic_words(teach, sizes))
    # zstandard sets up its tables by a dictionary's size, and fills them in steps: equal sizes and places
    # keep ordinary text equally long under both
    content = content.rjust(-(-(len(content) + 1) // 512) * 512 - 1) + b" "
    model = Model(b" " * len(content) + base, content + base, ())
    measure = lambda r: [(r["at"], r["toxic"], window_features(model, [w for p in r["pieces"] for w in _WINDOW.findall(p)]))]
    found = rest.mapInArrow(lambda b: _each(b, measure, ["at", "toxic", "x"], [pa.int64(), pa.int32(), pa.list_(pa.float64())]), "at long, toxic int, x array<double>")
    found = sorted(tuple(r) for r in found.collect())
    x, y = np.array([r[2] for r in found]), np.array([r[1] for r in found])
    stand_for = 1 / np.array(shares, float)[y]
    return Model(model.ordinary, model.toxic, logistic(x, y.astype(float), stand_for * len(y) / stand_for.sum()))


def held_out(doc_id: F.Column) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Train on ``docs`` (doc_id, text) labelled by ``labels`` (doc_id, toxic), but for held-out rows.
    Null ids and labels, and ids without a document, teach nothing; an id labelled both ways is toxic. The sample's
    ids are bounded by ``SAMPLE_ROWS`` and so are broadcast."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    each = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    each = written(each.join(docs.select("doc_id"), "doc_id", "left_semi"), "toxic-labels")
    found = {r["toxic"]: r["count"] for r in each.groupBy("toxic").count().collect()}
    sizes = [found.get(k, 0) for k in (0, 1)]
    places = [min(sizes[k], max(SAMPLE_ROWS // 2, SAMPLE_ROWS - sizes[1 - k])) for k in (0, 1)]
    if not all(places):
        return None
    picked = [(r["doc_id"], r["toxic"], at) for k in (0, 1) for at, r in enumerate(sampled(each.where(F.col("toxic") == k), "doc_id", places[k]))]
    ids = docs.sparkSession.createDataFrame(picked, "doc_id long, toxic int, at long")
    return train(docs.join(F.broadcast(ids), "doc_id").select("at", "toxic", "text"), [places[k] / sizes[k] for k in (0, 1)])


def score(docs: DataFrame, model: Model | None, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text). Null texts
    count as empty, and empty texts get the calibration's base rate; without a model (no rows
    of both classes) every score is 0. Repeated rows stay; an empty table gives an empty result. With
    ``keep``, the text and those columns of ``docs`` are returned as well."""

    carried = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in (["text", *keep] if keep else []))

    def run(batch: pa.RecordBatch) -> dict:
        if model is None:
            p = np.zeros(batch.num_rows)
        else:
            x = np.array([features(model, t) for t in batch.column(1).to_pylist()])
            w = np.array(model.weights)
            p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
        return dict(zip(batch.schema.names, batch.columns)) | {"held_out": batch.column(2), "score": p, "predicted": (p >= 0.5).astype(np.int32)}

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text", held_out(F.col("doc_id")).alias("held_out"), *keep),
                       "doc_id long, held_out boolean, score double, predicted int" + carried, run)
