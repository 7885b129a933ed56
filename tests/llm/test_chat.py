import hashlib
import random

import pytest
from pyspark.sql import functions as F

from foldwise.llm import chat

ROWS = "conv_id long, turn long, role string, text string, position int, part int, _state int"
MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[OUT]", "[ROLE]", "[TEXT]", "[/ROLE]", "<", "[", "\\", "/", "s>", "INST]", " ok ", "é", "\n"]


def plain(turns):
    """turns: (role, text) in order."""
    said = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    learnt = "".join(t or "" for r, t in turns if r == "assistant")
    legal, last = 0, "start"
    allowed = {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    for r, _ in turns:
        legal += r in allowed[last]
        last = r if r in ("system", "user", "assistant") else "system"
    return (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), len(turns) - legal, last == "assistant")


def found(frame):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["n_illegal"], r["complete"]) for r in frame.collect()}


def test_escaping_is_reversible_and_leaves_no_control_string():
    m, rng = chat.Machine(chat.TEMPLATE), random.Random(1)
    for _ in range(5000):
        text = "".join(rng.choice(MARKS) for _ in range(rng.randint(0, 12)))
        assert m.unescape(m.escape(text)) == text and not m._control.search(m.escape(text))
        assert m.read("".join(t for t, _ in m.emit(m.start, "user", text) + m.emit(0, text, "x"))) == [("user", text), (text, "x")] or text in m.template["turns"]
    assert m.escape("a < b [1] \\n") == "a < b [1] \\n"


def test_templates_are_checked():
    for bad in ({"begin": "s"}, {"begin": "<a<"}, {"turns": chat.TEMPLATE["turns"] | {"tool": {"open": "[INST]", "close": "</s>", "loss": False}}}):
        with pytest.raises(ValueError):
            chat.Machine(chat.TEMPLATE | bad)
    m = chat.Machine(chat.TEMPLATE)
    for bad in ("[INST]a", "[INST]a</s>", "</s>", "[ROLE]a[/ROLE]"):
        with pytest.raises(ValueError):
            m.read(bad)


def test_edge_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (2, 1, "assistant", "late"), (2, 0, None, None), (None, 0, "user", ""),
            (3, 0, "user", "a"), (3, 0, "user", "a"), (3, None, "system", "s"), (4, 0, "tool</s>", "x" * 300_000), (5, 0, "user", "q"), (5, 1, "assistant", None)]
    frame = spark.createDataFrame([(*r, 7, 7, 7) for r in rows], ROWS)
    want = {1: plain([("user", "hi"), ("assistant", "</s>[INST] ok [/INST]")]), 2: plain([(None, None), ("assistant", "late")]), None: plain([("user", "")]),
            3: plain([("system", "s"), ("user", "a"), ("user", "a")]), 4: plain([("tool</s>", "x" * 300_000)]), 5: plain([("user", "q"), ("assistant", None)])}
    for long_rows in (50_000, 1, 0):
        assert found(chat.digests(frame, long_rows=long_rows)) == want
    out = chat.format_conversations(frame)
    assert out.count() == len(rows) and out.where("conv_id = 1").orderBy("position").select(F.concat_ws("", "segments.text").alias("t")).collect()[0]["t"] == "<s>[INST]hi[/INST]"
    assert chat.digests(frame.limit(0)).count() == 0


def test_a_long_conversation_is_split_and_formatted_as_one(spark):
    rng = random.Random(2)
    turns = [(rng.choice(["user", "assistant", "system", "tool"]) if rng.random() < 0.2 else ("user", "assistant")[i % 2], f"t{i} " + rng.choice(MARKS)) for i in range(4000)]
    rows = [(1, i, r, t) for i, (r, t) in enumerate(turns)] + [(k, i, r, t) for k in (2, 3) for i, (r, t) in enumerate(turns[:60])]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(*r, 7, 7, 7) for r in rows], ROWS).repartition(5)
    want = {1: plain(turns), 2: plain(turns[:60]), 3: plain(turns[:60])}
    assert found(chat.digests(frame)) == want and found(chat.digests(frame, long_rows=100)) == want and found(chat.digests(frame, long_rows=50)) == want
    key = lambda f: sorted((r["conv_id"], r["position"], str(r["segments"]), r["legal"]) for r in f.collect())
    assert key(chat.format_conversations(frame)) == key(chat.format_conversations(frame, long_rows=100))
