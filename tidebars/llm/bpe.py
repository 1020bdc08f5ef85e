"""BPE encoding by backtracking, and decoding by an offset table.

An Aho-Corasick automaton over the vocabulary gives the longest token that starts at each byte of a piece. Tokens are taken
greedily; a token may follow another only if the merges, applied to the two side by side, would leave them apart. If it may
not, the next shorter prefix token is tried; if none is left, the last token is taken back and its end is never tried
again. Each end is closed at most once, so the work is linear in the piece and the result is what the merges give.

Null texts count as empty; repeated rows are coded each on its own. Texts are cut at the tokens that the vocabulary file adds
(special tokens), which stand for themselves. Ids travel as little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import array
import functools
import json
import re
import sys

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidebars.llm.frames import appended, prepare
from tidebars.llm.pieces import Memo, keys, part, pieces

#: Ids whose bytes are looked up at a time.
_STRIDE = 1 << 18
#: Encoded parts that a worker remembers, twice; it saves time and does not change a result.
REMEMBERED = 150_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable bytes for themselves, the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """A byte-level BPE vocabulary of the tokenizers library's file format, and its pair-compatibility table."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("not a byte-level BPE file without normalizer and prefix space")
        letters = byte_letters()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in self.added}
        self.size = 1 + max([*self.ids.values(), *self.added.values()])
        self.bytes = [b""] * self.size
        for token, i in self.ids.items():
            self.bytes[i] = token
        for token, i in self.added.items():
            self.bytes[i] = token.encode()
        self.length = [len(b) for b in self.bytes]
        self.rank, self.left, self.right, self.merge = [-1] * self.size, [0] * self.size, [0] * self.size, {}
        for rank, pair in enumerate(model["merges"]):
            a, b = (model["vocab"][t] for t in (pair.split(" ") if isinstance(pair, str) else pair))
            made = self.ids[self.bytes[a] + self.bytes[b]]
            if self.rank[made] >= 0:
                raise ValueError("a token is made by two merges")
            self.merge[a, b] = rank
            self.rank[made], self.left[made], self.right[made] = rank, a, b
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.cut = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.apart = Memo(lambda pair: self._stay_apart(*pair), limit=200_000)
        self.shorter = Memo(lambda token: self._next_prefix(token[0]), limit=self.size)
        self.encoded = Memo(self._encode_part, limit=remembered)
        self.offsets = np.concatenate(([0], np.cumsum(self.length)))
        self.table = np.frombuffer(b"".join(self.bytes), dtype=np.uint8)

    def _stay_apart(self, a: int, b: int) -> bool:
        """Undo the merges inside a and b, latest first; no merge over the border may come before what is undone."""
        until = sys.maxsize
        while True:
            if self.merge.get((a, b), sys.maxsize) < until:
                return False
            if self.rank[a] < 0 and self.rank[b] < 0:
                return True
            if self.rank[a] > self.rank[b]:
                until, a = self.rank[a], self.right[a]
            else:  # of two equal merges the left one comes first
                until, b = self.rank[b] + 1, self.left[b]

    def _next_prefix(self, token: int) -> int:
        data = self.bytes[token]
        return next((self.ids[data[:k]] for k in range(len(data) - 1, 0, -1) if data[:k] in self.ids), -1)

    def encode_piece(self, data: bytes) -> list[int]:
        n, length, apart = len(data), self.length, self.apart
        longest = [0] * (n + 1)
        for end, token in self.automaton.iter(data.decode("latin-1")):
            longest[end + 1 - length[token]] = token  # longer ones come later
        taken: list[int] = []
        reachable = bytearray(b"\x01") * (n + 1)
        at, token = 0, longest[0]
        while at < n:
            end = at + length[token]
            if reachable[end] and (not taken or apart[taken[-1], token]):
                taken.append(token)
                at, token = end, longest[end]
                continue
            token = self.shorter[token,]
            if token < 0:
                reachable[at] = 0
                token = taken.pop()
                at -= length[token]
        return taken

    def _encode_part(self, key: str) -> bytes:
        ids = array.array("I")
        for piece in pieces(part(key)):
            data = piece.encode()
            whole = self.ids.get(data)
            ids.extend(self.encode_piece(data) if whole is None else (whole,))
        return ids.tobytes()

    def _encode_plain(self, text: str) -> bytes:
        found = keys(text)
        if found is None:
            found = ["\n" + p if p != "\n" else p for p in pieces(text)]
        return b"".join(map(self.encoded.__getitem__, found))

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.cut is None or not self.cut.search(text):
            return self._encode_plain(text)
        out, at = [], 0
        for found in self.cut.finditer(text):
            out += [self._encode_plain(text[at : found.start()]), np.array([self.added[found.group()]], dtype="<u4").tobytes()]
            at = found.end()
        return b"".join([*out, self._encode_plain(text[at:])])

    def decode(self, ids: bytes | None) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters. An id outside the vocabulary is an error."""
        numbers, out = np.frombuffer(ids or b"", dtype="<u4").astype(np.int64), []
        if len(numbers) and numbers.max() >= self.size:
            raise ValueError(f"id {numbers.max()} is not in a vocabulary of {self.size}")
        for at in range(0, len(numbers), _STRIDE):
            part = numbers[at : at + _STRIDE]
            starts = self.offsets[part]
            sizes = self.offsets[part + 1] - starts
            ends = np.cumsum(sizes)
            out.append(self.table[np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)].tobytes())
        return b"".join(out).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def vocabulary(path: str, remembered: int = REMEMBERED) -> Vocabulary:
    """One for each Python worker."""
    return Vocabulary(path, remembered)


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids``. ``path``: the vocabulary file, at the same place on every machine."""
    prepare(docs.sparkSession)

    def make(texts: pa.Array):
        ids = [vocabulary(path).encode(t) for t in texts.to_pylist()]
        return pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())

    return appended(docs, [text], make, "n_tokens bigint, ids binary")


def decode(docs: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``docs`` with ``decoded``, the text of ``ids``; null ids count as none."""
    prepare(docs.sparkSession)

    def make(column: pa.Array):
        return (pa.array([vocabulary(path).decode(i) for i in column.to_pylist()], pa.string()),)

    return appended(docs, [ids], make, "decoded string")


def round_trip(docs: DataFrame, path: str, text: str = "text", remembered: int = REMEMBERED) -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids`` and ``decoded``, in one pass. ``remembered``: encoded parts that a worker keeps."""
    prepare(docs.sparkSession)

    def make(texts: pa.Array):
        words = vocabulary(path, remembered)
        ids = [words.encode(t) for t in texts.to_pylist()]
        return (pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()),
                pa.array([words.decode(i) for i in ids], pa.string()))

    return appended(docs, [text], make, "n_tokens bigint, ids binary, decoded string")
