"""Pieces of a text before byte-pair merges, and a bounded memo of what was made of them."""

from __future__ import annotations

import regex

#: Fixed value: the pattern that splits a text for the byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_PIECE = regex.compile(PATTERN)


def pieces(text: str) -> list[str]:
    return _PIECE.findall(text)


def keys(text: str) -> list[str] | None:
    """Keys of parts whose pieces, in order, are the pieces of the text; None if the white space is not plain.

    Plain is: single spaces and line feeds, between other printable characters. Then no piece reaches over a space from
    before it, or over a line feed, so the text can be cut there by plain string methods. A key is a word for that word
    with the space before it, or a line feed and a word for the first word of a line; a line feed alone is itself.
    """
    out: list[str] = []
    for line in text.split("\n"):
        if not line or not line.isprintable() or line[0] == " " or line[-1] == " " or "  " in line:
            return None
        parts = line.split(" ")
        parts[0] = "\n" + parts[0]
        if out:
            out.append("\n")
        out += parts
    return out


def part(key: str) -> str:
    """The text that a key stands for."""
    return " " + key if key[0] != "\n" else key[1:] or key


class Memo(dict):
    """``make(key)`` by key. It keeps two generations of ``limit`` short keys and makes the rest again."""

    def __init__(self, make, limit: int = 150_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value
