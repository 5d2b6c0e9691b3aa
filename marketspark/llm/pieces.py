"""Cutting texts into units that a byte-level BPE encodes independently, and remembering their ids.

A text is cut before a single space or line break between two characters that are no white space: the piece
that starts there is the same whatever stands before it, and no rule looks further than a run of white
space. Most words of a corpus repeat, so that a task encodes few units and looks up the rest. What a task
remembers is bounded by two generations of ``LIMIT`` entries; forgetting an entry only costs time.
"""

import re

import regex

#: Fixed value: the pattern that splits texts before the merges of a byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LIMIT = 250_000

split_pieces = regex.compile(PATTERN).findall
_BLANKS = regex.compile(r"\s{2,}")
_MAYBE_BLANKS = re.compile(r"\s\s")
#: A stop or comma that does not follow a letter or digit.
_ODD_STOP = re.compile(r"[\W_][.,]")
#: Either of both, in one pass.
_ODD = re.compile(r"[\W_](?:[.,]|(?<=\s)\s)")
#: Before a unit that no space precedes. A text that holds it is not cut at all.
_MARK = "\1"


def alphabet() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file: bytes that are printable in
    Latin-1 stand for themselves, the others follow from code point 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [byte for byte in range(256) if byte not in shown]
    return [chr(byte if byte in shown else 256 + hidden.index(byte)) for byte in range(256)]


def units(text: str) -> list[str]:
    """The text's units, in order, as ``written`` gives them their characters back."""
    if _MARK in text:
        return [_MARK + text]
    if _ODD.search(text) is None:
        return _cut(text, True)
    if _MAYBE_BLANKS.search(text) is None:
        return _cut(text, False)
    found, place = [], 0
    for run in _BLANKS.finditer(text):
        if run.start() > place:
            found += _from_run(text[place : run.start()])
        place = run.start()
    return found + _from_run(text[place:])


def _cut(text: str, stops: bool) -> list[str]:
    """Of a text without adjacent white space. ``stops``: stops and commas behind words become units of their own,
    so that a word is one unit with and without them."""
    spaced = text.replace("\n", " \n")
    if stops:
        spaced = spaced.replace(", ", " \1, ").replace(". ", " \1. ")
    found = spaced.split(" ")
    found[0] = _MARK + found[0]
    return found


def _regular(text: str) -> list[str]:
    return _cut(text, _ODD_STOP.search(text) is None)


def _from_run(text: str) -> list[str]:
    """A run of white space, if there is one, goes with the word behind it: its end decides how it splits."""
    run = _BLANKS.match(text)
    if run is None:
        return _regular(text)
    found = _regular(text[run.end() :])
    found[0] = _MARK + run.group() + found[0][1:]
    return found


def written(unit: str) -> str:
    """The characters of a unit."""
    if unit[:1] == _MARK:
        return unit[1:]
    return unit if unit[:1] == "\n" else " " + unit


class Remembered(dict):
    """Unit to value; a missing one is taken from the previous generation or made. A key longer than ``longest`` is made each
    time, so that the bytes remembered are bounded too."""

    def __init__(self, make, limit: int = LIMIT, longest: int | None = None):
        super().__init__()
        self.make, self.limit, self.older, self.longest = make, limit, {}, longest

    def __missing__(self, key):
        if self.longest is not None and len(key) > self.longest:
            return self.make(key)
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Pieces:
    """Ids of whole texts, given a function from one piece to its ids as bytes."""

    def __init__(self, encode_piece, limit: int = LIMIT, pieces: int | None = None, longest: int | None = None):
        self.encode_piece = encode_piece
        self.of_piece = Remembered(encode_piece, pieces or limit, longest)
        self.of_unit = Remembered(self._unit, limit, longest)

    def _unit(self, unit: str) -> bytes:
        if unit.isalpha():
            return self.encode_piece(" " + unit)
        return b"".join(map(self.of_piece.__getitem__, split_pieces(written(unit))))

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.of_unit.__getitem__, units(text)))
