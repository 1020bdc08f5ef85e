"""Spelling variants: words one inserted, deleted or replaced code point apart, found by a bit-sliced position index.

The index of a block of words holds a bitset over the block for every (position, letter). For a query word the bitsets of its
letters are combined letter by letter, for the whole block at once: the words that agree so far (no error), and those that
agree so far but for one replaced, one extra (bitsets shifted by one position) or one missing letter. A block answers all its
queries of a length side by side in numpy.

Blocks come from halves: two words one edit apart, the shorter of which has L letters, share their first or their last L // 2
letters. Groups of words that share such a half are cut into tiles, and two tiles meet in one task, so a half may be shared
by any number of words; small groups share a block. A pair that shares both halves counts in the group of the first one.

A null or empty text has no words. Repeated documents count each. Documents with a null id count like others (``vocabulary``).
Ties between near words of equal count go to the smaller in code-point order.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidebars.llm.frames import pick, prepare, settle
from tidebars.session import Rounds

MIN_LETTERS = 6
MIN_COUNT = 5
#: A word's form has at least so many times its count.
MORE = 5
#: Words of a tile of a large group, and words of a block of small groups.
TILE, BLOCK = 4_096, 512
#: Letters of a block of small groups.
BLOCK_LETTERS = 1 << 16
#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 200_000


def _count_words(least: int, worn: int | None):
    run_of_letters = re.compile("[a-zÀ-ÿ]{%d,}" % least)

    def batch_of(counts):
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches):
        counts, crc = Counter(), zlib.crc32
        for batch in batches:
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = data.as_py()
                if not data:
                    continue
                own = Counter(run_of_letters.findall(data.lower().decode()))  # bytes: lowers A-Z alone
                if worn:
                    seed = crc(f"{'' if doc is None else doc}:".encode())
                    for word in [w for w in own if crc(w.encode(), seed) % worn == 0]:
                        at, n = crc(word.encode(), seed) % len(word), own.pop(word)
                        less = word[:at] + word[at + 1 :]
                        if len(less) >= least:
                            counts[less] += n
                counts.update(own)
            if len(counts) > HELD_WORDS:
                yield batch_of(counts)
                counts = Counter()
        if counts:
            yield batch_of(counts)

    return run


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = MIN_LETTERS, count: int = MIN_COUNT,
               worn: int | None = None) -> DataFrame:
    """``word, n``: runs of Latin letters (A-Z lower-cased) with at least ``least`` letters and ``count`` occurrences.

    ``worn`` wears some words down first, for tests of what finds them again: where it divides the crc32 of ``<id>:<run>``
    (a null id is written as nothing), the run loses the letter at that number modulo its length.
    """
    prepare(docs.sparkSession)
    rows = pick(docs, doc_id, text).toDF("doc_id", "text").select("doc_id", F.col("text").cast("binary"))
    words = rows.mapInArrow(_count_words(least, worn), "word string, n bigint")
    return words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= count)


class PositionIndex:
    """Bitsets over ``words`` by (position, letter)."""

    def __init__(self, words: list[str]):
        self.words, self.sizes = words, np.array([len(w) for w in words])
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        self.letters, self.coded = np.unique(points, return_inverse=True)
        self.starts = np.cumsum(self.sizes) - self.sizes
        owner = np.repeat(np.arange(len(words)), self.sizes)
        place = np.arange(len(points)) - self.starts[owner]
        slots, row = np.unique(place * len(self.letters) + self.coded, return_inverse=True)
        # one place in front and one behind, and row 0, are empty: shifted positions need no test
        self.rows = np.zeros((self.sizes.max() + 3) * len(self.letters), dtype=np.int64)
        self.rows[slots + len(self.letters)] = np.arange(1, len(slots) + 1)
        self.rows = self.rows.reshape(-1, len(self.letters))
        width = -(-len(words) // 64) * 64
        held = np.zeros((len(slots) + 1, width), dtype=bool)
        held[row + 1, owner] = True
        self.bits = self._pack(held)
        self.of_size = {n: self._pack(np.pad(self.sizes == n, (0, width - len(words)))) for n in set(self.sizes.tolist())}
        self.none, self.all = np.zeros(width // 64, dtype="<u8"), self._pack(np.arange(width) < len(words))

    @staticmethod
    def _pack(held: np.ndarray) -> np.ndarray:
        return np.packbits(held, axis=-1, bitorder="little").view("<u8")

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word): numbers of words one edit apart; ``queries`` are numbers of words of one length."""
        size = int(self.sizes[queries[0]])
        coded = self.coded[self.starts[queries][:, None] + np.arange(size)]
        same = np.broadcast_to(self.all, (len(queries), len(self.all))).copy()
        replaced, extra, short = (np.zeros_like(same) for _ in range(3))
        for j in range(size):
            before, here, after = (self.bits[self.rows[j + k, coded[:, j]]] for k in range(3))
            short = (short & before) | same
            extra = (extra | same) & after
            replaced = (replaced & here) | (same & ~here)
            same &= here
        found = (replaced & self.of_size[size]) | ((extra | same) & self.of_size.get(size + 1, self.none))
        found |= short & self.of_size.get(size - 1, self.none)
        hits = np.unpackbits(found.view(np.uint8), axis=1, bitorder="little")
        row, word = np.nonzero(hits)
        return queries[row], word


def _pairs(words: list[str], group: np.ndarray, least: np.ndarray, last: np.ndarray, side: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs (a, b) of near words of a block, both ways; ``group``, the group's ``least`` length, whether it is by ``last``
    letters, and the ``side`` of each word: where two tiles meet, only pairs across them count; -1 in a tile that is alone."""
    index = PositionIndex(words)
    for size in np.unique(index.sizes).tolist():
        a, b = index.near(np.flatnonzero(index.sizes == size))
        kept = (group[a] == group[b]) & (np.minimum(index.sizes[a], index.sizes[b]) == least[a])
        for x, y in zip(a[kept].tolist(), b[kept].tolist()):
            half = int(least[x]) // 2
            if last[x] and words[x][:half] == words[y][:half]:
                continue
            if side[x] < 0 or side[x] != side[y]:
                yield x, y


def _search(block: int, block_letters: int):
    def run(batches):
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        held, letters, number, key, whole = [], 0, -1, None, []

        def found():
            words, counts = [h[0] for h in held], [h[1] for h in held]
            near, best = Counter(), {}
            arrays = (np.array([h[i] for h in held]) for i in (2, 3, 4, 5))
            for a, b in _pairs(words, *arrays):
                near[a] += 1
                best[a] = min(best.get(a, (0, "")), (-counts[b], words[b]))
            if near:
                columns = [(words[a], n, -best[a][0], best[a][1]) for a, n in near.items()]
                types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*columns), types)],
                                                 names=["word", "n_near", "best_n", "best"])

        for least, last, half, low, high, word, n, tile in rows:
            if (least, last, half, low, high) != key:
                key, number = (least, last, half, low, high), number + 1
                held, whole = held + whole, []
                if len(held) >= block or letters >= block_letters:
                    yield from found()
                    held, letters = [], 0
            whole.append((word, n, number, least, bool(last), -1 if low == high else int(tile == high)))
            letters += len(word)
        held = held + whole
        if held:
            yield from found()

    return run


def near_words(vocab: DataFrame, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """``word, n_near, best_n, best`` of every word of ``vocab(word, n)`` with a near word: how many there are, and the one with
    the largest count."""
    prepare(vocab.sparkSession)
    size = F.length("word")
    half = lambda n, last: F.struct(
        n.alias("least"), F.lit(last).alias("last"),
        (F.right(F.col("word"), F.floor(n / 2)) if last else F.left(F.col("word"), F.floor(n / 2))).alias("half"))
    keys = F.array(*(half(n, last) for n in (size, size - 1) for last in (0, 1)))
    members = vocab.select("word", "n", F.explode(keys).alias("k")).select("k.*", "word", "n")
    group = ["least", "last", "half"]
    # a group without a word of the least length has no pair of its own
    sizes = members.groupBy(group).agg(F.count("*").alias("size"), F.max(F.length("word") == F.col("least")).alias("short"))
    sizes = sizes.filter("size > 1 AND short").select(*group, F.ceil(F.col("size") / tile).alias("tiles"))
    own = F.pmod(F.xxhash64("word"), F.col("tiles"))
    met = members.join(sizes, group).withColumn("tile", own).withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
    met = met.select(*group, F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "word", "n", "tile")
    place = [*group, "low", "high"]
    dealt = met.repartition(*place).sortWithinPartitions(*place)
    found = dealt.mapInArrow(_search(block, BLOCK_LETTERS), "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the end of the chain of forms. Counts rise along a chain, so it ends; each round doubles the reach."""
    written = Rounds(forms.sparkSession, "spelling-roots")
    links = written.write(forms.select("word", F.col("form").alias("root")))
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if links.join(further, "root", "left_semi").isEmpty():
            return links
        links = written.write(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")))


def group_variants(vocab: DataFrame, more: int = MORE, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """``vocab(word, n)``, distinct words, with ``form`` (the near word of the largest count, if that is ``more`` times the
    word's), ``root`` (the end of the chain of forms), ``n_near`` and ``form_n``."""
    vocab = settle(vocab.select("word", "n"), "spelling-vocabulary")
    taken = F.col("best_n") >= more * F.col("n")
    found = vocab.join(near_words(vocab, tile, block), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(taken, F.col("best")).alias("form"),
        F.when(taken, F.col("best_n")).alias("form_n"))
    found = settle(found, "spelling-forms")
    roots = _roots(found.filter("form IS NOT NULL"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
