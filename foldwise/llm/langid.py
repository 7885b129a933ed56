"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers, one from each side, read a text in windows of ``WINDOW`` bytes; every
position gets a distribution over the learned languages from both states. A document's
distribution is the mean over the positions that belong to letters. The network is trained here,
in numpy, by back-propagation through time and Adam.

Gates and candidates use x / (1 + |x|) in place of the exponential functions: the same shape, but
a few vector instructions per state.

Training reads a bounded sample (``SAMPLE_ROWS`` labelled documents by the order of a hash, as many of each
language as there are, up to ``WINDOWS_PER_ROW`` windows of each document, cut on the executors from anywhere in
its text); prediction reads every byte of every text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import map_batches

WINDOW = 64
HIDDEN = 8
#: Bounds of the training sample: documents, windows of each, and languages (the most frequent ones).
SAMPLE_ROWS = 4000
WINDOWS_PER_ROW = 6
MAX_LANGUAGES = 1000
STEPS, BATCH, RATE = 500, 256, 0.02
UNKNOWN = "und"
_CHUNK = 4096
#: Bytes of letters, once a text is lower-cased: a-z and every byte of a non-ASCII character.
_LETTER_BYTE = np.zeros(256, bool)
_LETTER_BYTE[97:123] = True
_LETTER_BYTE[128:] = True


def _squash(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


@dataclass
class Network:
    """For each direction a ``table`` (3 * hidden, 256), the bytes' input to the update gate, the reset gate and
    the candidate, and ``recurrent`` (3 * hidden, hidden). ``out``: (languages, 2 * hidden + 1), the last
    column is the bias."""

    languages: list[str]
    table: list[np.ndarray]
    recurrent: list[np.ndarray]
    out: np.ndarray

    @staticmethod
    def new(languages: list[str], seed: int = 7) -> Network:
        rng, h = np.random.default_rng(seed), HIDDEN
        draw = lambda *shape: (rng.normal(size=shape) * 0.3).astype(np.float32)
        return Network(languages, [draw(3 * h, 256) for _ in range(2)], [draw(3 * h, h) for _ in range(2)], draw(len(languages), 2 * h + 1))

    def states(self, side: int, data: np.ndarray, mask: np.ndarray | None = None):
        """Run one direction over ``data`` (positions, windows); yields (position, state, cache).
        Where ``mask`` is 0 the state is reset, so padding leaves no trace."""
        h, n = HIDDEN, data.shape[1]
        state = np.zeros((h, n), np.float32)
        for t in range(len(data)) if side == 0 else range(len(data) - 1, -1, -1):
            given, held = self.table[side][:, data[t]], self.recurrent[side] @ state
            gate_in = given[:2 * h] + held[:2 * h]
            gates = 0.5 * _squash(gate_in) + 0.5
            new_in = given[2 * h:] + gates[h:] * held[2 * h:]
            new = _squash(new_in)
            before = state
            state = new + gates[:h] * (before - new)
            if mask is not None:
                state = state * mask[t]
            yield t, state, (before, gate_in, gates, held[2 * h:], new_in, new)

    def probabilities(self, data: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """The distribution at every position: (positions, languages, windows)."""
        h = HIDDEN
        logits = np.empty((len(data), len(self.languages), data.shape[1]), np.float32)
        for t, state, _ in self.states(0, data, mask):
            logits[t] = self.out[:, :h] @ state + self.out[:, -1:]
        for t, state, _ in self.states(1, data, mask):
            logits[t] += self.out[:, h:2 * h] @ state
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def gradients(self, data: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy over all positions, by back-propagation through time."""
        h, (steps, n) = HIDDEN, data.shape
        caches: list[dict] = [{}, {}]
        kept: list[list] = [[None] * steps, [None] * steps]
        for side in (0, 1):
            for t, state, cache in self.states(side, data):
                caches[side][t], kept[side][t] = cache, state
        g_table, g_rec = [np.zeros_like(x) for x in self.table], [np.zeros_like(x) for x in self.recurrent]
        g_out = np.zeros_like(self.out)
        errors = []
        for t in range(steps):
            both = np.concatenate([kept[0][t], kept[1][t], np.ones((1, n), np.float32)])
            p = self.out @ both
            p = np.exp(p - p.max(axis=0))
            p /= p.sum(axis=0)
            p[target, np.arange(n)] -= 1
            p /= steps * n
            g_out += p @ both.T
            errors.append(p)
        for side in (0, 1):
            back = np.zeros((h, n), np.float32)
            for t in range(steps - 1, -1, -1) if side == 0 else range(steps):
                before, gate_in, gates, held_new, new_in, new = caches[side][t]
                d = back + self.out[:, side * h:(side + 1) * h].T @ errors[t]
                update, reset = gates[:h], gates[h:]
                d_new = d * (1 - update) / (1 + np.abs(new_in)) ** 2
                d_gate = np.concatenate([d * (before - new), d_new * held_new]) * 0.5 / (1 + np.abs(gate_in)) ** 2
                d_given = np.concatenate([d_gate, d_new])
                d_held = np.concatenate([d_gate, d_new * reset])
                np.add.at(g_table[side].T, data[t], d_given.T)
                g_rec[side] += d_held @ before.T
                back = d * update + self.recurrent[side].T @ d_held
        return [*g_table, *g_rec, g_out]


def train(texts: list[str], languages: list[str], seed: int = 7) -> Network | None:
    """A network for ``texts`` and their languages; None without any."""
    rng = np.random.default_rng(seed)
    windows = []
    for text, language in zip(texts, languages):
        data = text.lower().encode()
        for start in rng.integers(0, max(1, len(data) - WINDOW + 1), size=min(WINDOWS_PER_ROW, 1 + len(data) // WINDOW)):
            windows.append((data[start:start + WINDOW], language))
    return train_windows(windows, seed)


def train_windows(windows: list[tuple[bytes, str]], seed: int = 7) -> Network | None:
    """A network for windows of lower-cased bytes and their languages; None without any."""
    names = sorted({language for _, language in windows})
    if not names:
        return None
    rng = np.random.default_rng(seed)
    target = [names.index(language) for _, language in windows]
    windows = [w.ljust(WINDOW) for w, _ in windows]
    data = np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WINDOW)
    target = np.array(target)
    network = Network.new(names, seed)
    weights = [*network.table, *network.recurrent, network.out]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, STEPS + 1):
        at = rng.integers(0, len(data), size=BATCH)
        rate = RATE * (1 - step / (STEPS + 1))
        for w, g, m, v in zip(weights, network.gradients(np.ascontiguousarray(data[at].T), target[at]), first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return network


def document_probabilities(network: Network, texts: list[str]) -> np.ndarray:
    """(documents, languages): mean over the letter positions of each whole text; 0 without any."""
    lower = [t.lower().encode() for t in texts]
    padded = b"".join(b + b" " * (-len(b) % WINDOW) for b in lower)
    sizes = np.array([len(b) for b in lower])
    owner = np.repeat(np.arange(len(texts)), -(-sizes // WINDOW))
    data = np.frombuffer(padded, np.uint8).reshape(-1, WINDOW)
    real = np.concatenate([np.arange(n) < s for s, n in zip(sizes, sizes + -sizes % WINDOW)]).reshape(-1, WINDOW) if len(data) else np.zeros((0, WINDOW), bool)
    total, count = np.zeros((len(texts), len(network.languages))), np.zeros(len(texts))
    for i in range(0, len(data), _CHUNK):
        block, mask = np.ascontiguousarray(data[i:i + _CHUNK].T), np.ascontiguousarray(real[i:i + _CHUNK].T)
        letters = (_LETTER_BYTE[block] & mask).astype(np.float32)
        p = network.probabilities(block, mask.astype(np.float32))
        np.add.at(total, owner[i:i + _CHUNK], np.einsum("tcn,tn->nc", p, letters))
        np.add.at(count, owner[i:i + _CHUNK], letters.sum(axis=0))
    return total / np.maximum(count, 1)[:, None]


def held_out(doc_id: F.Column) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame) -> Network | None:
    """Train on ``docs`` (doc_id, text, lang). Rows with a null text, lang or doc_id, rows whose lang is ``und``, and
    held-out rows, teach nothing. Each language has an equal part of ``SAMPLE_ROWS``. Only windows reach the driver, of
    at most twice as many rows; texts of any length teach."""
    known = docs.select("doc_id", "text", "lang").where("doc_id is not null and text is not null and lang is not null").where(F.col("lang") != UNKNOWN)
    known = known.where(~held_out(F.col("doc_id")))
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not counts:
        return None
    part = max(1, SAMPLE_ROWS // len(counts))
    # a few more than wanted, so that chance leaves no language short
    shares = [(r["lang"], int(min(1.0, (1.2 * part + 20) / r["count"]) * (1 << 31))) for r in counts]
    shares = docs.sparkSession.createDataFrame(shares, "lang string, _share long")
    length = F.char_length("text")
    starts = F.transform(F.sequence(F.lit(1), F.least(F.lit(WINDOWS_PER_ROW), 1 + F.floor(length / WINDOW).cast("int"))),
                         lambda i: 1 + F.pmod(F.xxhash64("doc_id", i), F.greatest(F.lit(1), length - WINDOW + 1)).cast("int"))
    cut = F.transform(starts, lambda i: F.substring(F.col("text"), i, F.lit(WINDOW)))
    some = known.withColumn("_hash", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))).join(F.broadcast(shares), "lang").where("_hash <= _share")
    rows = some.select("lang", "_hash", cut.alias("windows")).limit(2 * SAMPLE_ROWS + 40 * len(counts)).collect()
    taken: dict[str, int] = {}
    windows = []
    for r in sorted(rows, key=lambda r: (r["_hash"], r["windows"])):
        taken[r["lang"]] = taken.get(r["lang"], 0) + 1
        if taken[r["lang"]] <= part:
            windows += [(w.lower().encode()[:WINDOW], r["lang"]) for w in r["windows"]]
    return train_windows(windows)


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def with_letters(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has a letter: those that :func:`predict` gives a language, given a network."""

    def run(batch: pa.RecordBatch) -> dict:
        kept = batch.filter(pa.array(map(_has_letter, batch.column("text").to_pylist()), pa.bool_()))
        return dict(zip(kept.schema.names, kept.columns))

    return map_batches(docs, ", ".join(f"{c} {kind}" for c, kind in docs.dtypes), run)


def predict(docs: DataFrame, network: Network | None, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs`` (doc_id, text): the language of
    greatest mean probability and that probability. Null texts and texts without a letter get
    ``und`` and 0, as do all texts if there was nothing to learn from. Ties take the first language
    by name; repeated rows stay; an empty table gives an empty result. With ``keep``, the text and those columns of
    ``docs`` are returned as well."""

    carried = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in (["text", *keep] if keep else []))

    def run(batch: pa.RecordBatch) -> dict:
        texts = batch.column(1).to_pylist()
        known = [bool(network) and _has_letter(t) for t in texts]
        label, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if any(known):
            at = np.flatnonzero(known)
            p = document_probabilities(network, [texts[i] for i in at])
            score[at] = np.clip(p.max(axis=1), 0, 1)
            for i, k in zip(at, p.argmax(axis=1)):
                label[i] = network.languages[k]
        return dict(zip(batch.schema.names, batch.columns)) | {"held_out": batch.column(2), "lang_pred": label, "score": score}

    # the null check is all that prediction needs of the keys; lang and source never reach it
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text", held_out(F.col("doc_id")).alias("held_out"), *keep),
                       "doc_id long, held_out boolean, lang_pred string, score double" + carried, run)
