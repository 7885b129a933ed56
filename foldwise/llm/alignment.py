"""Cross-tokenizer alignment: which ids of two vocabularies stand for the same bytes, corpus-wide.

Both tokenizers encode the same bytes, a space and the text. Where tokens of both end at the same byte, the
text is cut into *groups*; a *link* is a pair of an A and a B token occurrence whose byte ranges overlap.

Inverted pair bitmaps. Documents are cut into shards and numbered in them. Per shard and id pair (a, b) there is
a compressed bitmap of the documents that hold the pair linked, and *multiplicity planes*: plane k holds the
documents in which bit k - 1 of (links - 1) is set, so that links = documents + sum of 2^(k-1) |plane k|. A
bitmap is the ordered list of its two-byte numbers or, where that is shorter, a row of bits. Shards number
disjoint documents, so a pair's bitmaps are OR-merged by joining them up, and their popcounts add to its document
and link counts. The postings then return the scores: a shard's bitmaps, beside the counts of their pairs, add up
what each of its documents gets.

Tokens of both sides end wherever a unit of text ends (see :class:`Aligner`), so a text's tokens, groups and links are those of
its units one after another: each distinct unit is encoded and aligned once and remembered.

Edge cases: a text that is null or empty, or whose A or B tokens don't spell its bytes (piece vocabularies may
normalise), has no tokens: zeros and an empty digest. A null doc_id and repeated rows are documents of their
own. Texts are encoded whole, whatever their length. Empty tables give no rows; extra columns do not pass.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldwise.llm.common import small_batches, written
from foldwise.llm.tokens import BEFORE_SPACE, LONG_UNIT, WORD_MARK, byte_letters, encoder, unit_pattern

#: A shard is cut after so many characters of text, or so many documents (a number takes two bytes).
SHARD_CHARS, SHARD_DOCS = 4 << 20, 1 << 16
#: a < 2^31, b < 2^16 and a document number share a 64-bit key.
B_BITS, DOC_BITS = 16, 16
COLUMNS = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


#: Distinct units remembered (as many older ones beside them); units looked up, and characters of texts taken, at a time.
MAX_UNITS, SLICE_UNITS, SLICE_CHARS = 400_000, 1 << 15, 1 << 18
#: Stands between units that are encoded in one call; texts that hold it are encoded whole.
GUARD = "\0"


class Side:
    """One tokenizer's ids of whole texts and of units (with the number of each unit's ids), and each id's bytes."""

    def __init__(self, encode: Callable[[str], np.ndarray], encode_units: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], spelled: list[bytes]):
        self.encode, self.encode_units, self.spelled = encode, encode_units, spelled
        self.size = np.array([len(s) for s in spelled], np.int64)

    def spells(self, ids: np.ndarray, text: bytes) -> bool:
        return b"".join(map(self.spelled.__getitem__, ids.tolist())) == text


def byte_side(path: str) -> tuple[Side, Callable[[str], bool]]:
    """A byte-level ``tokenizers`` vocabulary; special tokens in texts are plain text. Also tells texts that it must encode whole."""
    enc = encoder(path, keep_space=True, plain_specials=True, max_units=20_000)  # units are remembered with their alignment
    byte_of = {letter: b for b, letter in byte_letters().items()}
    vocabulary = enc.known.tokenizer.get_vocab(with_added_tokens=True)
    spelled = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        spelled[i] = bytes(byte_of[x] for x in token) if all(x in byte_of for x in token) else token.encode()

    def ids(packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, "<u4").astype(np.int64)

    def units(some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        packed = enc.encode_units(some)
        return ids(b"".join(packed)), np.array(list(map(len, packed)), np.int64) // 4

    return Side(lambda text: ids(enc.encode(" " + text)), units, spelled), enc.whole


def piece_side(path: str) -> tuple[Side, re.Pattern | None]:
    """A ``sentencepiece`` model, which puts a space before the text itself. Also the pattern of units (None: it must
    encode texts whole).

    A byte-pair model only ever joins characters into pieces of its vocabulary: no token holds two neighbours
    that stand side by side in no piece, and what is on either side of them is encoded independently."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    byte = [re.fullmatch("<0x([0-9A-F]{2})>", p) if model.is_byte(i) else None for i, p in enumerate(pieces)]
    spelled = [bytes([int(b[1], 16)]) if b else p.replace("▁", " ").encode() for p, b in zip(pieces, byte)]

    def ids(text: str) -> np.ndarray:
        return np.array(model.encode(text, num_threads=1), np.int64)

    known = [p.replace("▁", " ") for i, p in enumerate(pieces) if not (byte[i] or model.is_control(i) or model.is_unknown(i))]
    guard = int(ids(GUARD)[-1])
    pattern = None
    if byte[guard] and _joins_only(model) and not any(GUARD in p or WORD_MARK.search(p) for p in known):
        pattern = unit_pattern("".join(sorted({c for p in known for c in BEFORE_SPACE.findall(p)})))

    def units(some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = ids(GUARD + GUARD.join(some))
        at = np.flatnonzero(found == guard)
        return found[at[0]:][found[at[0]:] != guard], np.diff(at, append=len(found)) - 1

    return Side(ids, units, spelled), pattern


def _joins_only(model) -> bool:
    """Whether a model does nothing to a text but write its spaces as marks, one more before it, and join characters pair by pair."""
    try:
        from sentencepiece import sentencepiece_model_pb2 as kinds
    except ImportError:  # protobuf is not installed: unknown
        return False
    proto = kinds.ModelProto.FromString(model.serialized_model_proto())
    normal, trained = proto.normalizer_spec, proto.trainer_spec
    return (trained.model_type == kinds.TrainerSpec.BPE and not trained.treat_whitespace_as_suffix and not normal.precompiled_charsmap
            and normal.add_dummy_prefix and normal.escape_whitespaces and not normal.remove_extra_whitespaces
            and all(p.type != kinds.ModelProto.SentencePiece.UNUSED for p in proto.pieces))


def align(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of both sides end at the byte offsets ``end_a`` and ``end_b``, each holds a byte, and the last ends agree.
    Returns the links as (index in a, index in b), and the indices at which groups end in a and in b."""
    last = np.searchsorted(end_b, end_a)  # the token of b in which each token of a ends
    together = end_b[last] == end_a
    first = np.concatenate(([0], (last + together)[:-1]))
    n = last - first + 1
    at_a = np.repeat(np.arange(len(end_a)), n)
    at_b = np.arange(len(at_a)) + np.repeat(first - (np.cumsum(n) - n), n)
    return at_a, at_b, np.flatnonzero(together), last[together]


class GroupText:
    """Writes groups as `a1,a2|b1;a3|b2,b3`: decimal ids in order."""

    def __init__(self, n_a: int, n_b: int):
        # an id of either side with the mark that follows it, by (side, whether it ends its group's ids)
        self.words = [b"%d%c" % (i, mark) for n, marks in ((n_a, b",|"), (n_b, b",;")) for mark in marks for i in range(n)]
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.n_a, self.n_b = n_a, n_b

    def write(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The groups, each with a mark after it, and where each id in them ends."""
        code = np.empty(len(a) + len(b), np.int64)
        groups = np.arange(len(last_a))
        of_a, of_b = np.repeat(groups, np.diff(last_a, prepend=-1)), np.repeat(groups, np.diff(last_b, prepend=-1))
        before = np.concatenate(([0], last_b[:-1] + 1))  # ids of b in earlier groups
        marked_a, marked_b = a.copy(), b + 2 * self.n_a
        marked_a[last_a] += self.n_a
        marked_b[last_b] += self.n_b
        code[np.arange(len(a)) + before[of_a]] = marked_a
        code[np.arange(len(b)) + (last_a + 1)[of_b]] = marked_b
        return b"".join(map(self.words.__getitem__, code.tolist())), np.cumsum(self.size[code])


#: What is found of a text or unit: its groups as text, the id pair of each link (64 bits each), numbers of A ids, B ids and groups.
Found = tuple[bytes, bytes, int, int, int]


class Aligner:
    """Aligns texts.

    Units (``pattern``) end where no token of either vocabulary goes on, so each distinct unit is aligned by itself and
    remembered in a table of bounded size (when it is full, units that were not asked for since the last time
    go; long units are not kept). Texts that must be encoded whole, or of which a unit isn't spelled by its tokens, are aligned whole."""

    def __init__(self, byte_vocabulary: str, piece_model: str, max_units: int = MAX_UNITS):
        (self.a, self.whole), (self.b, self.pattern) = byte_side(byte_vocabulary), piece_side(piece_model)
        self.groups = GroupText(len(self.a.spelled), len(self.b.spelled))
        self.max_units, self.known, self.older = max_units, {}, {}

    def find(self, texts: list[str]) -> list[Found | None]:
        """What is found of each text, none of them empty; None: its tokens don't spell it."""
        parts: list[list[Found] | None] = [[] for _ in texts]
        some, n = [], 0
        for k, text in enumerate(texts):
            spaced = " " + text
            if self.pattern is None or GUARD in text or self.whole(spaced):
                parts[k] = None
                continue
            units = self.pattern.findall(spaced)
            for i in range(0, len(units), SLICE_UNITS):
                some.append((k, units[i:i + SLICE_UNITS]))
                n += len(some[-1][1])
                if n >= SLICE_UNITS:
                    self._look_up(some, parts)
                    some, n = [], 0
        self._look_up(some, parts)
        return [self._whole_text(text) if of is None else of[0] if len(of) == 1 else _joined(of) for text, of in zip(texts, parts)]

    def _look_up(self, some: list[tuple[int, list[str]]], parts: list[list[Found] | None]) -> None:
        """Add what is found of the units of some texts to their parts; None: a unit isn't spelled."""
        known = self.known
        new = set().union(*(units for _, units in some)).difference(known)
        known.update((u, self.older[u]) for u in new if u in self.older)
        self._learn([u for u in new if u not in known])
        for k, units in some:
            found = list(map(known.__getitem__, units))
            if None in found:
                parts[k] = None
            elif parts[k] is not None:
                parts[k].append(_joined(found))
        for u in new:
            if len(u) > LONG_UNIT:
                del known[u]
        if len(known) > self.max_units:
            self.older, self.known = known, {}

    def _learn(self, units: list[str]) -> None:
        if not units:
            return
        found = self._aligned(*self.a.encode_units(units), *self.b.encode_units(units), units)
        if found:
            self.known.update(zip(units, found))
        elif len(units) == 1:
            self.known[units[0]] = None
        else:  # one of them isn't spelled
            self._learn(units[:len(units) // 2])
            self._learn(units[len(units) // 2:])

    def _whole_text(self, text: str) -> Found | None:
        a, b = self.a.encode(text), self.b.encode(text)
        found = self._aligned(a, np.array([len(a)]), b, np.array([len(b)]), [" " + text])
        return found and found[0]

    def _aligned(self, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, texts: list[str]) -> list[Found] | None:
        """What is found of each text, given the ids of all and how many each has; None: a text isn't spelled by its ids."""
        raw = [t.encode() for t in texts]
        end, joined = np.cumsum(list(map(len, raw))), b"".join(raw)
        end_a, end_b, to_a, to_b = np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b]), np.cumsum(n_a), np.cumsum(n_b)
        if not (n_a.all() and n_b.all() and np.array_equal(end_a[to_a - 1], end) and np.array_equal(end_b[to_b - 1], end)
                and self.a.spells(a, joined) and self.b.spells(b, joined)):
            return None
        at_a, at_b, last_a, last_b = align(end_a, end_b)
        written_groups, word_end = self.groups.write(a, b, last_a, last_b)
        pairs = (a[at_a] << B_BITS | b[at_b]).astype("<i8").tobytes()
        text_to, links_to, groups_to = word_end[to_a + to_b - 1], np.searchsorted(at_a, to_a), np.searchsorted(last_a, to_a)
        found, i, j = [], 0, 0
        for text, link, *n in zip(text_to.tolist(), (8 * links_to).tolist(), n_a.tolist(), n_b.tolist(), np.diff(groups_to, prepend=0).tolist()):
            found.append((written_groups[i:text - 1], pairs[j:link], *n))
            i, j = text, link
        return found


def _joined(found: list[Found]) -> Found:
    """What is found of texts that stand one after another."""
    groups, pairs, *n = zip(*found)
    return b";".join(groups), b"".join(pairs), *map(sum, n)


@lru_cache(1)
def _aligner(byte_vocabulary: str, piece_model: str) -> Aligner:
    return Aligner(byte_vocabulary, piece_model)


def bitmap(numbers: np.ndarray) -> bytes:
    """A compressed bitmap of ascending document numbers: a kind byte, then two-byte numbers or bits."""
    if len(numbers) * 16 <= int(numbers[-1]) + 1:
        return b"\0" + numbers.astype("<u2").tobytes()
    bits = np.zeros(int(numbers[-1]) + 1, np.uint8)
    bits[numbers] = 1
    return b"\1" + np.packbits(bits, bitorder="little").tobytes()


def numbers(bitmap: bytes) -> np.ndarray:
    """The document numbers in a bitmap."""
    if bitmap[0] == 0:
        return np.frombuffer(bitmap, "<u2", offset=1).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8, offset=1), bitorder="little"))


POSTINGS = "a int, b int, plane int, n_docs long, bitmap binary"
DOCS = "number int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
SHARD = f"shard long, {POSTINGS}, {DOCS}"


class _Shard:
    """Documents of one shard, as they are aligned."""

    def __init__(self, number: int):
        self.number, self.chars, self.docs, self.keys = number, 0, [], []

    def add(self, doc_id: int | None, text: str | None, found: Found | None) -> None:
        at, row = len(self.docs), (0, 0, 0, 0, "")
        self.chars += len(text or "")
        if found:
            groups, pairs, n_a, n_b, n_groups = found
            pair, links = np.unique(np.frombuffer(pairs, "<i8").astype(np.int64), return_counts=True)
            self.keys.append((pair << DOC_BITS | at, links))
            row = (n_a, n_b, n_groups, len(pairs) // 8, hashlib.sha256(groups).hexdigest())
        self.docs.append((at, doc_id, *row))

    def rows(self) -> Iterator[pa.RecordBatch]:
        """The shard's postings, then its documents."""
        fields = [f.split() for f in SHARD.split(", ")]
        kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}

        def batch(n: int, columns: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(columns[name], kinds[kind]) if name in columns else pa.nulls(n, kinds[kind]) for name, kind in fields],
                                              [name for name, _ in fields])

        if self.keys:
            key, links = (np.concatenate(x) for x in zip(*self.keys))
            order = np.argsort(key, kind="stable")
            key, more = key[order], links[order] - 1
            for plane in range(int(more.max()).bit_length() + 1):
                some = key if plane == 0 else key[more >> (plane - 1) & 1 == 1]
                pair, doc = some >> DOC_BITS, some & ((1 << DOC_BITS) - 1)
                first = np.flatnonzero(np.diff(pair, prepend=-1))
                maps = [bitmap(doc[i:j]) for i, j in zip(first.tolist(), [*first[1:].tolist(), len(doc)])]
                n = np.diff(first, append=len(doc))
                yield batch(len(first), {"shard": np.full(len(first), self.number), "a": (pair[first] >> B_BITS).astype(np.int32), "plane": np.full(len(first), plane, np.int32),
                                         "b": (pair[first] & ((1 << B_BITS) - 1)).astype(np.int32), "n_docs": n, "bitmap": maps})
        columns = dict(zip([f.split()[0] for f in DOCS.split(", ")], zip(*self.docs)))
        yield batch(len(self.docs), columns | {"shard": [self.number] * len(self.docs)})


def _slices(batch: pa.RecordBatch) -> Iterator[list[tuple[int | None, str | None]]]:
    """The rows (doc_id, text) of a batch, about SLICE_CHARS of text at a time."""
    some, chars = [], 0
    for doc_id, text in zip(batch.column(0), batch.column(1)):
        some.append((doc_id.as_py(), text.as_py()))
        chars += len(some[-1][1] or "")
        if chars >= SLICE_CHARS:
            yield some
            some, chars = [], 0
    yield some


def build(docs: DataFrame, byte_vocabulary: str, piece_model: str, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """Align every whole text of ``docs`` (doc_id, text) and write the shards: postings (``a`` not null) and documents."""

    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_vocabulary, piece_model)
        shard = _Shard(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for some in _slices(batch):
                found = iter(aligner.find([text for _, text in some if text]))
                for doc_id, text in some:
                    shard.add(doc_id, text, next(found) if text else None)
                    if shard.chars >= shard_chars or len(shard.docs) == SHARD_DOCS:
                        yield from shard.rows()
                        shard = _Shard(shard.number + 1)
        if shard.docs:
            yield from shard.rows()

    return written(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, SHARD), "alignment")


def pair_counts(shards: DataFrame) -> DataFrame:
    """(a, b, n_docs, n_links): popcounts of each pair's merged bitmap and of its planes, over the whole corpus."""
    worth = F.expr("shiftleft(1L, greatest(plane - 1, 0))")
    return shards.where("a is not null").groupBy("a", "b").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("n_docs")).otherwise(0)).alias("n_docs"), F.sum(F.col("n_docs") * worth).alias("n_links"))


def document_scores(shards: DataFrame) -> DataFrame:
    """Per document: tokens, groups, links, links that are their A id's most frequent ones (``n_best``), and the sum of the
    document counts of its links (``count_sum``)."""
    # counts grow with the corpus: they are never broadcast, and only the keys of postings are joined with them
    counts = pair_counts(shards).select("a", "b", F.col("n_docs").alias("count"))
    counts = counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("a")))  # at most a row per B id
    known = shards.where("plane = 0").select("shard", "a", "b").join(counts.hint("merge"), ["a", "b"])
    every = shards.unionByName(known.select("shard", "a", "b", "count", "best"), allowMissingColumns=True)

    def scores(table: pa.Table) -> pa.Table:
        def pairs(some: pa.Table) -> np.ndarray:
            a, b = (some.column(c).to_numpy().astype(np.int64) for c in ("a", "b"))
            return a << B_BITS | b

        docs = table.filter(pc.is_valid(table.column("number"))).sort_by("number")
        known, postings = table.filter(pc.is_valid(table.column("count"))), table.filter(pc.is_valid(table.column("bitmap")))
        best, total = np.zeros(docs.num_rows, np.int64), np.zeros(docs.num_rows, np.int64)
        key = pairs(known)
        order = np.argsort(key)
        for i in range(0, postings.num_rows, 8192):
            some = postings.slice(i, 8192)
            row = order[np.searchsorted(key, pairs(some), sorter=order)]
            found = [numbers(x) for x in some.column("bitmap").to_pylist()]
            n, at = [len(x) for x in found], np.concatenate(found)
            links = 1 << np.maximum(some.column("plane").to_numpy().astype(np.int64) - 1, 0)
            np.add.at(best, at, np.repeat(links * known.column("best").to_numpy()[row], n))
            np.add.at(total, at, np.repeat(links * known.column("count").to_numpy()[row], n))
        values = {name: docs.column(name) for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        return pa.table(values | {"n_best": pa.array(best), "count_sum": pa.array(total), "groups_sha256": docs.column("groups_sha256")})

    return every.groupBy("shard").applyInArrow(scores, f"doc_id long, {COLUMNS}")


def align_documents(docs: DataFrame, byte_vocabulary: str, piece_model: str) -> DataFrame:
    """The scores of :func:`document_scores` for every row of ``docs`` (doc_id, text)."""
    return document_scores(build(docs, byte_vocabulary, piece_model))
