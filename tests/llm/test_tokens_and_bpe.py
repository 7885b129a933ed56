import random

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from llm_data import docs, no_docs  # noqa: F401
from foldwise.llm import bpe
from foldwise.llm.tokens import UnitEncoder

PIECES = ["a", "The", " ", "  ", "\n", "'s", "é", "É", "1", "23", "!", "word,", " ", "\xa0", "\x1c", "中文", "😀", "'ll", "\t", "x" * 9,
          "é", "H̱", "<|endoftext|>", "ß", "İ", "Σ", "\x85", "_", "µ", "½"]


def some_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("file,keep", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_unit_encoder_equals_the_library(file, keep):
    for plain in (False, True):
        enc, library = UnitEncoder(P.path(file), keep, max_units=200, plain_specials=plain), Tokenizer.from_file(P.path(file))
        library.encode_special_tokens = plain
        for text in some_texts(1500, 1) + ["x" * 20_000, "a " * 5000, "a<|endoftext|>b <|startoftext|>  <|ENDOFTEXT|>", None]:
            assert np.frombuffer(enc.encode(text), "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_remembered_units_are_short():
    enc = UnitEncoder(P.path("byte_bpe_50k.json"), True)
    enc.encode("中" * 500 + " short")
    assert set(enc.known) == {" short"}


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def test_tree_reduction_equals_tiktoken(vocabulary):
    for text in some_texts(1500, 2) + ["x" * 9000, " " * 9000, "a b" * 5000]:
        want = vocabulary.encoding.encode_ordinary(text)
        for leaf in (1, 5, 4096) if len(text) < 1000 else (500, 4096):
            assert bpe.encode(vocabulary, text, leaf=leaf).ids.tolist() == want
        assert bpe.decode(vocabulary, np.array(want, "<u4"), leaf=3) == text.encode()


def test_join_is_associative_with_a_unit(vocabulary):
    for text in some_texts(300, 3):
        cuts = sorted(random.Random(text).choices(range(len(text) + 1), k=3))
        a, b, c, d = (bpe.encode(vocabulary, text, s, e) for s, e in zip([0, *cuts], [*cuts, len(text)]))
        join = lambda x, y: bpe.join(vocabulary, text, x, y)
        assert join(join(join(a, b), c), d).ids.tolist() == join(a, join(b, join(c, d))).ids.tolist()


def test_edge_rows(docs, no_docs, vocabulary):
    out = bpe.encode_documents(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    rows = out.collect()
    assert len(rows) == docs.count()
    for want, got in zip(docs.collect(), rows):
        ids = vocabulary.encoding.encode_ordinary(want["text"] or "")
        assert (got["doc_id"], np.frombuffer(got["ids"], "<u4").tolist()) == (want["doc_id"], ids)
    assert bpe.encode_documents(no_docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_marks_are_units_of_their_own_and_a_lowered_special_token_is_none():
    """Before: a unit was remembered for each word with each mark, and `<|EndOfText|>` was read as the special token."""
    enc = UnitEncoder(P.path("byte_bpe_50k.json"), True)
    words, marks = [" one", " two", " three", "\nfour"], [",", ".", "!?", "...", ";)"]
    text = "".join(w + m for w in words for m in marks)
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert list(np.frombuffer(enc.encode(text), "<u4")) == library.encode(text, add_special_tokens=False).ids
    assert enc.known.keys() >= {" one", ",", "..."} and " one," not in enc.known
    enc, library = UnitEncoder(P.path("word_bpe_49k.json"), False), Tokenizer.from_file(P.path("word_bpe_49k.json"))
    for text in ("x <|EndOfText|> y", "x<|ENDOFTEXT|>", "x <|endoftext|> y"):
        assert list(np.frombuffer(enc.encode(text), "<u4")) == library.encode(text, add_special_tokens=False).ids
