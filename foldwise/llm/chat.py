"""Chat formatting: a finite-state machine over roles, driven by a declarative template.

A template names, for each role, the control strings around its turns and whether its text carries loss; for
each state, the roles that may come next and the state that they lead to; and the states in which a
conversation may end. The machine reads a conversation's rows in order and emits one output row per turn: its
*segments*, each a text and a loss flag. A turn that the table does not allow is emitted all the same, marked
``legal = false``, and the machine goes on from the state that its role leads to.

Escaping. Every control string starts with a lead character and holds neither another one nor the escape
character. In a text, each lead character, with the escape characters right after it, that is followed by the
rest of a control string gets one more escape character there. So no control string is left in a text, other
text stays as it is, and taking one escape character away gives the text back.

Order and skew. Rows go by (turn, role, hash of the text, text), nulls first. A conversation of at most
``long_rows`` rows is read in one task, as a stream. A longer one is dealt into ranges of that order; each
range's effect on the machine is a map from state to state, the maps are composed (one row per range), and
then all ranges are formatted side by side from their true start states.

Edge cases: a null text is empty, a null role is ''; a role without a template is written between the
template's ``other`` marks, never legal, and read back with its name; a null conv_id is one conversation;
repeated rows are turns of their own; an empty table has no output; extra columns do not pass.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foldwise.llm.common import small_batches, written
from foldwise.operators.joins import attach

#: [INST] and </s> as instruction-tuned models know them; the other marks are of the same kind.
TEMPLATE = {
    "leads": "<[", "escape": "\\", "begin": "<s>", "start": "start",
    "turns": {"system": {"open": "[SYS]", "close": "[/SYS]", "loss": False},
              "user": {"open": "[INST]", "close": "[/INST]", "loss": False},
              "assistant": {"open": "[OUT]", "close": "</s>", "loss": True}},
    "other": {"open": "[ROLE]", "name_end": "[TEXT]", "close": "[/ROLE]"},
    "moves": {"start": {"system": "ready", "user": "asked"}, "ready": {"user": "asked"},
              "asked": {"assistant": "answered"}, "answered": {"user": "asked"}},
    "after_illegal": {"system": "ready", "user": "asked", "assistant": "answered", None: "ready"},
    "accept": ["answered"],
}
#: Rows of a conversation that one task reads as a stream; longer ones are split.
LONG_ROWS = 50_000
SEGMENTS = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))
FORMATTED = "conv_id long, position long, segments array<struct<text:string,loss:boolean>>, legal boolean, complete boolean"
ORDER = ("turn", "role", "_hash", "text")


class Machine:
    """A checked template: the transition table, the emissions of each turn, and the way back."""

    def __init__(self, template: dict):
        t = self.template = template
        marks = [m[k] for m in (*t["turns"].values(), t["other"]) for k in ("open", "name_end", "close") if k in m]
        controls = sorted({t["begin"], *marks})
        for c in controls:
            if len(c) < 2 or c[0] not in t["leads"] or any(x in t["leads"] + t["escape"] for x in c[1:]):
                raise ValueError(f"{c!r} must be a lead character and others that are neither leads nor the escape")
        opens = [m["open"] for m in (*t["turns"].values(), t["other"])]
        if len(set(opens)) < len(opens):
            raise ValueError("two roles open alike")
        rest = "|".join(re.escape(c[1:]) for c in sorted(controls, key=len, reverse=True))
        lead, esc = f"[{re.escape(t['leads'])}]", re.escape(t["escape"])
        self._in = re.compile(f"({lead}{esc}*)(?={rest})")
        self._out = re.compile(f"({lead}{esc}*){esc}(?={rest})")
        self._control = re.compile("(" + "|".join(map(re.escape, controls)) + ")")
        self.states = sorted({t["start"], *t["moves"], *(s for m in t["moves"].values() for s in m.values()), *t["after_illegal"].values()})
        self.number = {s: i for i, s in enumerate(self.states)}
        self.start, self.accept = self.number[t["start"]], {self.number[s] for s in t["accept"]}
        self.by_open = {m["open"]: role for role, m in t["turns"].items()}

    def escape(self, text: str) -> str:
        return self._in.sub(lambda m: m[1] + self.template["escape"], text)

    def unescape(self, text: str) -> str:
        return self._out.sub(r"\1", text)

    def step(self, state: int, role: str) -> tuple[int, bool]:
        """The next state, and whether ``role`` is allowed in ``state``."""
        to = self.template["moves"].get(self.states[state], {}).get(role)
        after = self.template["after_illegal"]
        return self.number[after.get(role, after[None]) if to is None else to], to is not None

    def emit(self, state: int, role: str, text: str) -> list[tuple[str, bool]]:
        """The segments of one turn that comes in ``state``."""
        t = self.template
        begin = t["begin"] if state == self.start else ""
        turn = t["turns"].get(role)
        if turn:
            return [(begin + turn["open"], False), (self.escape(text), turn["loss"]), (turn["close"], False)]
        other = t["other"]
        return [(begin + other["open"] + self.escape(role) + other["name_end"], False), (self.escape(text), False), (other["close"], False)]

    def read(self, formatted: str) -> list[tuple[str, str]]:
        """(role, text) of each turn of formatted text: one turn, several, or a whole conversation."""
        pieces, turns, at = self._control.split(formatted), [], 1
        other = self.template["other"]
        while at < len(pieces):
            mark, body = pieces[at], pieces[at + 1]
            if mark == self.template["begin"]:
                at += 2
                continue
            if mark == other["open"] and pieces[at + 2:at + 3] == [other["name_end"]]:
                role, body, close, at = self.unescape(body), pieces[at + 3], other["close"], at + 2
            elif mark in self.by_open:
                role = self.by_open[mark]
                close = self.template["turns"][role]["close"]
            else:
                raise ValueError(f"{mark!r} opens no turn")
            if pieces[at + 2:at + 3] != [close]:
                raise ValueError(f"the turn of {role!r} does not end in {close!r}")
            turns.append((role, self.unescape(body)))
            at += 4
        return turns


def _column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def _stream(rows: DataFrame, template: dict) -> DataFrame:
    """Format rows that come in order, each (conv_id, part) in one partition, from state ``_state`` and position ``_offset``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, group, state, position = Machine(template), object(), 0, 0
        for batch in batches:
            out = []
            for key in zip(*(_column(batch, c) for c in ("conv_id", "part", "role", "text", "_state", "_offset"))):
                if key[:2] != group:
                    group, state, position = key[:2], machine.start if key[4] is None else key[4], key[5] or 0
                after, legal = machine.step(state, key[2])
                segments = [{"text": t, "loss": loss} for t, loss in machine.emit(state, key[2], key[3])]
                out.append((key[0], position, segments, legal, after in machine.accept))
                state, position = after, position + 1
            columns = list(zip(*out)) if out else [()] * 5
            kinds = (pa.int64(), pa.int64(), SEGMENTS, pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in FORMATTED.split(", ")])

    return rows.mapInArrow(run, FORMATTED)


def _effects(rows: DataFrame, template: dict) -> DataFrame:
    """(conv_id, part, n, moves): what each part does to the machine, as the state reached from each state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, group, moves, n = Machine(template), None, [], 0

        def done():
            return pa.RecordBatch.from_arrays([pa.array([group[0]], pa.int64()), pa.array([group[1]], pa.int32()), pa.array([n], pa.int64()),
                                               pa.array([moves], pa.list_(pa.int32()))], ["conv_id", "part", "n", "moves"])

        for batch in batches:
            for conv, part, role in zip(*(_column(batch, c) for c in ("conv_id", "part", "role"))):
                if (conv, part) != group:
                    if group:
                        yield done()
                    group, moves, n = (conv, part), list(range(len(machine.states))), 0
                moves, n = [machine.step(s, role)[0] for s in moves], n + 1
        if group:
            yield done()

    return rows.mapInArrow(run, "conv_id long, part int, n long, moves array<int>")


def _starts(effects: DataFrame, start: int) -> DataFrame:
    """The state and position in which each part begins. One row per part: a conversation's window holds at most one per range."""
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    state = F.aggregate(F.collect_list("moves").over(before), F.lit(start), lambda s, m: F.get(m, s))
    return effects.select("conv_id", "part", state.alias("_state"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))


def _dealt(rows: DataFrame) -> DataFrame:
    """Each (conv_id, part) in one partition, in order."""
    return rows.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", *ORDER)


def _parts(rows: DataFrame, template: dict, long_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Formatted short conversations, each whole and in order in one partition, and long ones (None: there are none)."""
    small_batches(rows.sparkSession)
    machine = Machine(template)  # raises here, not on an executor
    clean = rows.select(rows["conv_id"].cast("long").alias("conv_id"), rows["turn"].cast("long").alias("turn"), F.coalesce(rows["role"], F.lit("")).alias("role"),
                        F.coalesce(rows["text"], F.lit("")).alias("text"), F.xxhash64(F.coalesce(rows["text"], F.lit(""))).alias("_hash"))
    clean = clean.withColumns({"_key": F.coalesce("conv_id", F.lit(0)), "_none": F.col("conv_id").isNull()})
    no_start = {"_state": F.lit(None).cast("int"), "_offset": F.lit(0).cast("long")}
    long = written(clean.groupBy("_key", "_none").count().where(F.col("count") > long_rows).select("_key", "_none"), "long-conversations")
    if long.isEmpty():
        return _stream(_dealt(clean.withColumns({"part": F.lit(0)} | no_start)), template), None
    short = attach(clean, long, ["_key", "_none"], "left_anti").withColumns({"part": F.lit(0)} | no_start)
    ranges = attach(clean, long, ["_key", "_none"], "left_semi").repartitionByRange("conv_id", *ORDER[:3])
    dealt = written(ranges.withColumn("part", F.spark_partition_id()), "long-turns")
    starts = written(_starts(_effects(_dealt(dealt), template), machine.start), "long-starts")
    starts = starts.select(F.coalesce("conv_id", F.lit(0)).alias("_key"), F.col("conv_id").isNull().alias("_none"), "part", "_state", "_offset")
    return _stream(_dealt(short), template), _stream(_dealt(attach(dealt, starts, ["_key", "_none", "part"])), template)


def format_conversations(rows: DataFrame, template: dict = TEMPLATE, long_rows: int = LONG_ROWS) -> DataFrame:
    """Format ``rows`` (conv_id, turn, role, text): one row per turn with its ``position`` in the conversation (from 0),
    its ``segments`` (text, loss), ``legal`` (the template allows it there) and ``complete`` (the conversation could end
    here). The segments of a conversation, one after another in order of position, are its formatted text."""
    short, long = _parts(rows, template, long_rows)
    return short if long is None else short.unionByName(long)


def _digest(formatted: DataFrame, template: dict) -> DataFrame:
    """Read formatted turns back, as a stream in order, and digest each conversation."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_illegal", "complete"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, conv, now = Machine(template), object(), None

        def row():
            return (conv, now[0], now[1].hexdigest(), now[2], now[3].hexdigest(), *now[4:])

        for batch in batches:
            done = []
            for i, segments, legal, complete in zip(*(_column(batch, c) for c in ("conv_id", "segments", "legal", "complete"))):
                if i != conv or now is None:
                    if now:
                        done.append(row())
                    conv, now = i, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, True]
                text = "".join(s["text"] for s in segments)
                for role, said in machine.read(text):
                    now[0] += 1
                    now[1].update(f"{role}\n{said}\n".encode())
                for s in segments:
                    if s["loss"]:
                        learnt = machine.unescape(s["text"])
                        now[2] += len(learnt)
                        now[3].update(learnt.encode())
                now[4], now[5], now[6] = now[4] + len(text), now[5] + (not legal), complete
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(row(), kinds)], names)

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                     "formatted_chars long, n_illegal long, complete boolean")


def digests(rows: DataFrame, template: dict = TEMPLATE, long_rows: int = LONG_ROWS) -> DataFrame:
    """Format ``rows``, read the output back, and return per conversation: n_turns, SHA-256 of role, line feed, text, line
    feed of every turn; characters and SHA-256 of the text under loss; formatted characters; illegal turns; whether it
    ends where it may. A digest of a long conversation is one stream of its formatted turns (SHA-256 has no parallel
    form); it holds one batch at a time."""
    short, long = _parts(rows, template, long_rows)
    found = _digest(short, template)
    if long is None:
        return found
    return found.unionByName(_digest(long.repartition("conv_id").sortWithinPartitions("conv_id", "position"), template))
