import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from llm_data import docs, no_docs  # noqa: F401
from foldwise.llm import alignment
from foldwise.llm.tokens import byte_letters

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
PIECES = ["a", "The", " ", "  ", "\n", "'s", "é", "1", "23", "!", "word", "中文", "😀", "\t", "\x00", "ﬁ", "<s>", "</s>", "<|endoftext|>", "<0x41>", "ation", "tion s"]


@pytest.fixture(scope="module")
def plain():
    """n_a, n_b, links by id pair and the group text of one text, by the libraries and loops over bytes."""
    library, model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    library.encode_special_tokens = True
    byte_of = {x: b for b, x in byte_letters().items()}

    def spell(piece):
        found = re.fullmatch("<0x([0-9A-F]{2})>", piece)
        return bytes([int(found[1], 16)]) if found else piece.replace("▁", " ").encode()

    def one(text):
        if not text:
            return 0, 0, [], ""
        raw = (" " + text).encode()
        a, b = library.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
        bytes_a = [bytes(byte_of[x] for x in library.id_to_token(i)) for i in a]
        bytes_b = [spell(model.id_to_piece(i)) for i in b]
        if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            return 0, 0, [], ""
        owner_a = [k for k, t in enumerate(bytes_a) for _ in t]
        owner_b = [k for k, t in enumerate(bytes_b) for _ in t]
        links = [(a[i], b[j]) for i, j in sorted(set(zip(owner_a, owner_b)))]
        groups, i, j = [], 0, 0
        for at in range(len(raw)):
            if (at + 1 == len(raw) or owner_a[at] != owner_a[at + 1]) and (at + 1 == len(raw) or owner_b[at] != owner_b[at + 1]):
                groups.append(",".join(map(str, a[i:owner_a[at] + 1])) + "|" + ",".join(map(str, b[j:owner_b[at] + 1])))
                i, j = owner_a[at] + 1, owner_b[at] + 1
        return len(a), len(b), links, ";".join(groups)

    return one


def expected(plain, texts):
    found = [plain(t) for t in texts]
    counts = Counter(pair for _, _, links, _ in found for pair in set(links))
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(n, most.get(a, 0))
    return [(n_a, n_b, len(g.split(";")) if g else 0, len(links), sum(counts[x] == most[x[0]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(g.encode()).hexdigest() if g else "") for n_a, n_b, links, g in found], found


def rows(frame):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((str(r["doc_id"]), *(r[c] for c in names)) for r in frame.collect())


def test_bitmaps_round_trip():
    rng = random.Random(1)
    for n, top in ((1, 1), (1, 60_000), (300, 65_536), (9000, 65_536), (64, 64)):
        want = np.array(sorted(rng.sample(range(top), n)), np.int64)
        assert alignment.numbers(alignment.bitmap(want)).tolist() == want.tolist()
    assert len(alignment.bitmap(np.arange(65_536))) == 1 + 8192 and len(alignment.bitmap(np.array([65_535]))) == 3


def test_alignment_equals_loops_over_bytes(spark, plain):
    rng = random.Random(2)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(400)] + ["a▁b", "The word " * 300, None, "", " ", "\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want, found = expected(plain, texts)
    shards = alignment.build(docs, A, B, shard_chars=3000)
    assert rows(alignment.document_scores(shards)) == sorted((str(i), *w) for i, w in enumerate(want))
    per_doc, links = Counter(), Counter()
    for _, _, pairs, _ in found:
        per_doc.update(set(pairs))
        links.update(pairs)
    assert {(r["a"], r["b"]): (r["n_docs"], r["n_links"]) for r in alignment.pair_counts(shards).collect()} == {x: (per_doc[x], links[x]) for x in per_doc}
    assert shards.where("plane > 6").count() > 0


def test_edge_rows(docs, no_docs, plain):
    source = docs.collect()
    want, _ = expected(plain, [r["text"] for r in source])
    assert rows(alignment.align_documents(docs, A, B)) == sorted((str(r["doc_id"]), *w) for r, w in zip(source, want))
    assert alignment.align_documents(no_docs, A, B).count() == 0


CUTS = PIECES + ["\r", "\r\n", ";\r\n", "!!", "word;", "(a)", "\x01", "é", "é", "　", "\xa0", " ", "▁", "é,", "L'eau", "x" * 70, "中" * 70, "\x85"]


@pytest.mark.parametrize("max_units", [400_000, 3])
def test_units_of_a_text_align_as_the_whole_text(max_units, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE_UNITS", 7)
    aligner, rng = alignment.Aligner(A, B, max_units), random.Random(4)
    texts = ["".join(rng.choice(CUTS) + rng.choice(["", "", " "]) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    clean = [t for t in texts if not set(t) & {"▁", "\x00", "́"}]
    assert len(clean) > 300 and any("\r" in t for t in clean)
    for some in (texts, clean):
        want = [aligner._whole_text(t) for t in some]
        assert aligner.find(some) == want
    assert None not in want and len(aligner.known) <= max_units + 7 * 40


def test_each_distinct_unit_is_aligned_once(monkeypatch):
    aligner, asked = alignment.Aligner(A, B), Counter()
    encode = aligner.b.encode_units
    monkeypatch.setattr(aligner.b, "encode_units", lambda units: asked.update(units) or encode(units))
    monkeypatch.setattr(aligner.b, "encode", None)
    for _ in range(3):
        aligner.find(["The word, the word\r\nand a word!", "a word;\r\nthe end"] * 5)
    assert set(asked.values()) == {1} and {" The", " word", ",", " word\r\nand", ";\r\nthe"} - set(asked) == {";\r\nthe"} and " word;\r\nthe" in asked


def test_units_are_not_cut_where_a_piece_goes_on():
    side, pattern = alignment.piece_side(B)
    assert pattern.findall(" a;\r\nb c!! \r\n\r\n d") == [" a;\r\nb", " c", "!!", " \r\n\r\n d"]
    ids, n = side.encode_units([" a;\r\nb", "!!", "\n", " \x01"])
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    assert n.sum() == len(ids) and ids[:n[0]].tolist() == model.encode("a;\r\nb") and n.tolist()[2] == 1


def test_a_model_that_scores_whole_paths_encodes_whole_texts(tmp_path):
    lines = ["the word and the other word", "a word in the end"] * 50
    sentencepiece.SentencePieceTrainer.train(sentence_iterator=iter(lines), model_prefix=str(tmp_path / "m"), vocab_size=300, model_type="unigram",
                                             byte_fallback=True, hard_vocab_limit=False, normalization_rule_name="identity", minloglevel=2)
    path = str(tmp_path / "m.model")
    assert alignment.piece_side(path)[1] is None
    aligner = alignment.Aligner(A, path)
    assert aligner.find(["the word and"]) == [aligner._whole_text("the word and")]
