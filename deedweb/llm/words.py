"""Tokens of texts by way of their pretokens.

Byte-level tokenizers split a text into pretokens by a pattern and encode each pretoken by itself. Pretokens come again and
again, so what they gave is kept, up to a stated number of bytes, and only new ones are encoded. They are looked up by
their characters, never by a hash alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import regex

#: The pattern that byte-level vocabularies of this kind are split by.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPLIT = regex.compile(PATTERN)

#: Bytes that a generation of kept pretokens holds, and the longest that is kept, in characters. A worker process outlives
#: its tasks, so twice this is memory that later stages go without.
KEPT_BYTES, KEPT_LENGTH = 64 << 20, 64
#: What an entry takes beside its characters and ids: two objects and their place in a table.
ENTRY = 180
#: Characters of a text that are split at once.
SEGMENT = 1 << 20


class Kept(dict):
    """What pretokens gave, in two generations: when the new one is full, the old one goes."""

    def __init__(self, make: Callable[[str], bytes], most: int = KEPT_BYTES) -> None:
        super().__init__()
        self.make, self.most, self.held = make, most, 0
        self.old: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key) or self.make(key)
        if len(key) <= KEPT_LENGTH:
            self.held += ENTRY + len(key) + len(value)
            if self.held > self.most:
                self.old, self.held = dict(self), 0
                self.clear()
            self[key] = value
        return value


class WordTokens:
    """``make`` encodes a pretoken: little-endian unsigned 32-bit ids. ``added`` has the ids of strings that are tokens
    wherever they stand."""

    def __init__(self, make: Callable[[str], bytes], added: dict[str, int]):
        self.added = {k: v.to_bytes(4, "little") for k, v in added.items()}
        self.cut = cutter(added)
        self.kept = Kept(make)

    def encode(self, text: str) -> bytes:
        """The ids of a text."""
        return b"".join([self.added[x] if special else self._plain(x) for x, special in pieces(text, self.added, self.cut)])

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.kept.__getitem__, SPLIT.findall(text)))


def cutter(added: dict[str, int]) -> regex.Pattern:
    """A pattern that finds added tokens, the longest first."""
    return regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True))) or r"(?!)")


def pieces(text: str, added: dict, cut: regex.Pattern) -> Iterator[tuple[str, bool]]:
    """The parts of a text that may be encoded apart; those that are added tokens are marked."""
    at = 0
    for m in cut.finditer(text) if any(a in text for a in added) else ():
        yield from ((x, False) for x in segments(text[at : m.start()]))
        yield m[0], True
        at = m.end()
    yield from ((x, False) for x in segments(text[at:] if at else text))


def segments(text: str) -> Iterator[str]:
    """A long text in parts of ``SEGMENT`` characters or a little more. A space between two characters that are no white
    space begins a pretoken whatever stands before it, so parts begin at such spaces."""
    at = 0
    while len(text) - at > 2 * SEGMENT:
        cut = text.find(" ", at + SEGMENT)
        while cut > 0 and (text[cut - 1].isspace() or text[cut + 1 : cut + 2].isspace() or cut + 1 == len(text)):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    if at < len(text):
        yield text[at:] if at else text
