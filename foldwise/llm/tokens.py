"""Whole-text encoding with the ``tokenizers`` library, one call per distinct unit.

Strings of special tokens in a text are read as the library reads them (as those tokens), unless
``plain_specials`` asks for plain text.

The library needs about 1 CPU second per MB of text, but its work is independent between
*units* of text. Both vocabularies used here split text before merging, with patterns in which no
match holds white space after another character. So every place where white space follows another
character is a match boundary, and the ids of a text are the ids of its units one after another.
:class:`UnitEncoder` encodes each distinct unit once, through the library, and remembers its ids in
a table of bounded bytes (when it is full, units that were not asked for since the last time go; long units are
not kept). Texts for which this does not hold are encoded whole.
"""

from __future__ import annotations

import os
import re
import struct

#: Characters with the Unicode property White_Space.
SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Letters of a simple word (ASCII and Latin-1: normalisation changes nothing but their case), and marks that may follow it.
_WORD, _MARKS = r"[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]", r"[!-&(-/:-@\[-`{-~]"
#: Units of more characters are not remembered: those of text without white space hardly come again.
LONG_UNIT = 64
_COMBINING = re.compile("[\u0300-\u036f]")
#: Where units are cut inside a run of other characters, and where before white space.
WORD_MARK, BEFORE_SPACE = re.compile(_WORD + _MARKS), re.compile(f"(?<=[^{SPACE}])[{SPACE}]")

#: A word of ASCII and Latin-1 letters, then ASCII marks other than the apostrophe: two matches of the
#: splitting patterns.
_SIMPLE = re.compile(f"( ?{_WORD}+)({_MARKS}*)")
#: Where patterns keep white space, one of these before a simple word (and its space) is a match of its own.
_BREAKS = "\t\n\r"


def unit_pattern(glued: str = "") -> re.Pattern:
    """The units of a text: each is white space and what follows it up to the next white space, cut between a simple word
    and its marks, which are matches of their own. No cut is made before white space that starts with a character of
    ``glued``. Possessive: one pass over any text."""
    end, more = f"(?![^{SPACE}])", ""
    if glued:
        end, more = f"{end}(?![{re.escape(glued)}])", f"(?:[{re.escape(glued)}][{SPACE}]*+[^{SPACE}]*+)*+"
    return re.compile(f" ?{_WORD}++(?={_MARKS}*+{end})|{_MARKS}++{end}|[{SPACE}]*+[^{SPACE}]++{more}|[{SPACE}]++")


_UNIT = unit_pattern()


def byte_letters() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + k) for k, b in enumerate(other)}


_LETTERS = byte_letters()


class _Known(dict):
    """Unit → packed ids; a unit not seen yet goes through the library. A simple word goes straight to
    the vocabulary's model, which saves the normalising and splitting that leave it as it is."""

    def __init__(self, tokenizer, keep_space: bool):
        super().__init__()
        self.tokenizer, self.model, self.keep_space, self.older = tokenizer, tokenizer.model, keep_space, {}

    def age(self) -> None:
        """Forget the units that were not asked for since the last time."""
        self.older = dict(self)
        self.clear()

    def __missing__(self, unit) -> bytes:
        if (packed := self.older.get(unit)) is not None:
            self[unit] = packed
            return packed
        text = unit if self.keep_space else unit.decode()
        simple = _SIMPLE.fullmatch(text)
        if not simple and self.keep_space and text[0] in _BREAKS and _SIMPLE.fullmatch(text, 1):
            packed = self[text[0]] + self[text[1:]]
        elif not simple:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            packed = struct.pack(f"<{len(ids)}I", *ids)
        elif simple[2]:
            word, marks = simple.groups()
            packed = self[word] + self[marks] if self.keep_space else self[word.encode()] + self[marks.encode()]
        else:
            word = text if self.keep_space else text.lower()
            letters = word.replace(" ", _LETTERS[32]) if word.isascii() else word.encode().decode("latin-1").translate(_LETTERS)
            ids = [t.id for t in self.model.tokenize(letters)]
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(unit) <= LONG_UNIT:
            self[unit] = packed
        return packed


class UnitEncoder:
    """ids of texts as little-endian unsigned 32-bit bytes, by a ``tokenizers`` vocabulary file.

    ``keep_space=True`` (byte-level vocabularies): a unit is a run of white space and the run of
    other characters after it; a simple word's marks are a unit of their own. ``keep_space=False`` (vocabularies that lower-case and drop white
    space): a unit is a run of other characters between ASCII white space, with A-Z lower-cased.
    ``max_units``: distinct units remembered (as many older ones beside them), each of at most LONG_UNIT characters.
    """

    def __init__(self, path: str, keep_space: bool, max_units: int = 400_000, plain_specials: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = plain_specials
        added = tokenizer.get_added_tokens_decoder().values()
        self._specials = [t.content for t in added if not t.normalized]
        folded = [re.escape(t.content) for t in added if t.normalized]
        self._folded = re.compile("|".join(folded), re.IGNORECASE) if folded else None
        self.keep_space, self.max_units, self.known = keep_space, max_units, _Known(tokenizer, keep_space)

    def whole(self, text: str) -> bool:
        """Texts that are encoded whole: special tokens, combining marks (lower-casing A-Z first might change what they compose to)."""
        written = text if self.keep_space else text.lower()  # a unit that is lower-cased could turn into a special token
        if any(s in written for s in self._specials) or self._folded and self._folded.search(text):
            return True
        return not text.isascii() and _COMBINING.search(text) is not None

    def encode(self, text: str | None) -> bytes:
        """The ids of one whole text (null: none)."""
        if not text:
            return b""
        if self.whole(text):
            ids = self.known.tokenizer.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(self.encode_units(_UNIT.findall(text) if self.keep_space else text.encode().lower().split()))

    def encode_units(self, units: list) -> list[bytes]:
        """The ids of each unit of a text that isn't encoded whole."""
        packed = list(map(self.known.__getitem__, units))
        if len(self.known) > self.max_units:
            self.known.age()
        return packed


_ENCODERS: dict[tuple, UnitEncoder] = {}


def encoder(path: str, keep_space: bool, plain_specials: bool = False, max_units: int = 400_000) -> UnitEncoder:
    """This process's encoder for a vocabulary file; workers keep it between tasks."""
    key = path, keep_space, plain_specials, max_units
    if key not in _ENCODERS:
        _ENCODERS.clear()  # one vocabulary at a time bounds a worker's memory
        _ENCODERS[key] = UnitEncoder(path, keep_space, max_units, plain_specials)
    return _ENCODERS[key]
