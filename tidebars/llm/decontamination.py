"""Benchmark decontamination: n-gram windows of test items are looked up in every document.

The windows of the test items form a set of sorted hashes that every task holds, split into blocks of a checked size; a window
costs some 24 bytes. A task turns the words of a document into vocabulary numbers (0: in no test item), hashes only windows
without a 0, looks the hashes up and compares the words of each hit exactly.

Words: A-Z are lower-cased; a word is a run of digits, letters a-z and non-ASCII characters. A null text has no words. An
item with fewer words than a window is one window; an item without words, or whose id is null, takes no part. Items that
share an id count as one. Repeated documents are judged each on its own.
"""

from __future__ import annotations

import array
import functools
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidebars.llm.frames import beside, pick, prepare, restore, settle, with_results

WINDOW = 13
#: Characters of test items whose windows a task holds at a time; more items are scanned for in several passes.
BLOCK_CHARS = 8_000_000

FOUND = "struct<n_words: bigint, n_hit: bigint, items: array<string>, hits: array<struct<first: bigint, last: bigint>>>"

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_TO_WORDS = bytes(b if b in _KEPT else 0x20 for b in bytes(range(256)).lower())
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(data: bytes | None) -> list[bytes]:
    return data.translate(_TO_WORDS).split() if data else []


class WindowSet:
    """The windows of some test items, by length, as packed arrays.

    ``words`` holds the vocabulary numbers of all items one after the other. A layer holds sorted hashes, for each the place
    in ``words`` of one window that has it, and the items of that window. Different windows of one hash lie in further layers.
    """

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.numbers: dict[bytes, int] = {}
        self.names = sorted({item for item, _ in items})
        number_of = {name: n for n, name in enumerate(self.names)}
        words, starts = array.array("I"), {}
        for item, data in items:
            numbers = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(data)]
            size = min(window, len(numbers))
            if size:
                starts.setdefault(size, []).append((len(words), len(numbers) - size + 1, number_of[item]))
                words.extend(numbers)
        self.words = np.array(words, dtype=np.uint32)
        self.layers = [(size, layer) for size, runs in starts.items() for layer in self._layers(size, np.array(runs, dtype=np.int64))]

    def _hash(self, words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros(len(starts), dtype=np.uint64)
        for j in range(size):
            out = (out ^ words[starts + j].astype(np.uint64)) * _STEP
            out ^= out >> np.uint64(29)
        return out

    def _equal(self, words: np.ndarray, starts: np.ndarray, heads: np.ndarray, size: int) -> np.ndarray:
        same = np.ones(len(starts), dtype=bool)
        for j in range(size):
            same &= words[starts + j] == self.words[heads + j]
        return same

    def _layers(self, size: int, runs: np.ndarray):
        """(hashes, heads, first member, members) of the windows that start in ``runs``: (first word, windows, item)."""
        counts = runs[:, 1]
        before = np.cumsum(counts) - counts
        starts = np.repeat(runs[:, 0] - before, counts) + np.arange(counts.sum())
        owners = np.repeat(runs[:, 2], counts).astype(np.uint32)
        hashes = self._hash(self.words, starts, size)
        while len(starts):
            order = np.lexsort((owners, hashes))
            starts, owners, hashes = starts[order], owners[order], hashes[order]
            new = np.concatenate(([True], hashes[1:] != hashes[:-1]))
            heads, number = starts[new], np.cumsum(new) - 1
            same = self._equal(self.words, starts, heads[number], size)
            held, of = owners[same], number[same]
            once = np.concatenate(([True], (of[1:] != of[:-1]) | (held[1:] != held[:-1])))
            first = np.searchsorted(of[once], np.arange(len(heads) + 1))
            yield hashes[new], heads.astype(np.uint32), first.astype(np.uint32), held[once]
            starts, owners, hashes = starts[~same], owners[~same], hashes[~same]

    def find(self, words: list[bytes]) -> tuple[np.ndarray, list[str]]:
        """Which words lie inside a window, and the items whose windows occur, sorted."""
        n, items = len(words), []
        edges = np.zeros(n + 1, dtype=np.int64)
        numbers = np.fromiter(map(self.numbers.get, words, itertools.repeat(0)), dtype=np.uint32, count=n)
        known = np.concatenate(([0], np.cumsum(numbers > 0)))
        for size, (hashes, heads, first, members) in self.layers:
            if n < size:
                continue
            starts = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(starts):
                continue
            keys = self._hash(numbers, starts, size)
            near = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
            met = hashes[near] == keys
            starts, near = starts[met], near[met]
            same = self._equal(numbers, starts, heads[near].astype(np.int64), size)
            starts, near = starts[same], near[same]
            np.add.at(edges, starts, 1)
            np.add.at(edges, starts + size, -1)
            items += [members[first[w] : first[w + 1]] for w in np.unique(near)]
        found = np.unique(np.concatenate(items)) if items else []
        return np.cumsum(edges[:n]) > 0, [self.names[i] for i in found]


def _runs(hit: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edges[::2], edges[1::2])]


def _scan(block, arrow_type):
    def scan(text: pa.Array) -> pa.Array:
        windows, out = block.value, []
        for data in text:
            words = words_of(data.as_py())
            hit, items = windows.find(words)
            out.append({"n_words": len(words), "n_hit": int(hit.sum()), "items": items, "hits": _runs(hit)})
        return pa.array(out, type=arrow_type)

    return scan


def _union(arrow_type):
    """What all blocks found in a document, together."""

    def union(found: pa.Array) -> pa.Array:
        out = []
        for parts in found:
            parts = parts.as_py()
            hit, items = np.zeros(parts[0]["n_words"], dtype=bool), set()
            for part in parts:
                items.update(part["items"])
                for run in part["hits"]:
                    hit[run["first"] : run["last"] + 1] = True
            out.append({"n_words": len(hit), "n_hit": int(hit.sum()), "items": sorted(items), "hits": _runs(hit)})
        return pa.array(out, type=arrow_type)

    return union


def _blocks(benchmark: DataFrame, item_id: str, text: str, window: int, block_chars: int):
    """The window sets, one at a time. Items are dealt to blocks by a hash of their id and text, repeated ones once."""
    items = pick(benchmark, item_id, text).toDF("item", "text").filter("item IS NOT NULL AND text IS NOT NULL")
    items = items.select(F.col("item").cast("string").alias("item"), F.col("text").cast("binary").alias("data")).distinct()
    chars = items.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0]
    count = max(1, -(-chars // block_chars))
    for number in range(count):
        part = items.filter(F.pmod(F.xxhash64("item", "data"), F.lit(count)) == number) if count > 1 else items
        yield WindowSet([(r.item, bytes(r.data)) for r in part.collect()], window)


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                       item_text: str = "text", window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items`` (ids whose windows occur, sorted as strings) and ``hits`` (runs of
    hit words, by first and last word number)."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    spark = docs.sparkSession
    prepare(spark)
    arrow_type = to_arrow_type(_parse_datatype_string(FOUND))
    results = ["n_words", "n_hit", "items", "hits"]
    blocks = _blocks(benchmark, item_id, item_text, window, block_chars)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        scan = F.arrow_udf(_scan(spark.sparkContext.broadcast(first), arrow_type), FOUND)
        return with_results(docs, [text], lambda data: scan(data.cast("binary")), results)

    # a task holds one block at a time: the texts are written once, and each block adds its hits by row
    keyed = settle(beside(docs, [text], lambda data: data).withColumn("row", F.monotonically_increasing_id()), "contamination-texts")
    parts = []
    for windows in itertools.chain([first, second], blocks):
        sent = spark.sparkContext.broadcast(windows)
        part = keyed.select("row", F.arrow_udf(_scan(sent, arrow_type), FOUND)(F.col("made").cast("binary")).alias("found"))
        parts.append(settle(part.filter("found.n_hit > 0") if parts else part, "contamination-hits"))
        sent.destroy()
    found = functools.reduce(DataFrame.unionAll, parts).groupBy("row").agg(F.collect_list("found").alias("found"))
    found = found.select("row", F.arrow_udf(_union(arrow_type), FOUND)("found").alias("found"))
    taken = set(results)
    keep = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c.lower() not in taken]
    return keyed.join(found, "row").select(*keep, *(F.col(f"found.{r}").alias(r) for r in results))


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """A twentieth of the words or more lie inside test windows."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def _cut(text: pa.Array, hits: pa.Array) -> pa.Array:
    import re

    word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    out = []
    for value, runs in zip(text.to_pylist(), hits.to_pylist()):
        if value is not None and runs:
            spans = [m.span() for m in word.finditer(value)]
            at, parts = 0, []
            for run in runs:
                parts.append(value[at : spans[run["first"]][0]])
                at = spans[run["last"]][1]
            value = "".join([*parts, value[at:]])
        out.append(value)
    return pa.array(out, type=pa.string())


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text: str = "text", **how) -> DataFrame:
    """``docs`` without contaminated documents, or with the hit passages cut out of all texts (``remove="spans"``)."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove is documents or spans")
    whole = beside(docs, [text], lambda t: t).withColumnRenamed("made", "text")
    found = find_contamination(whole, benchmark, text="text", **how)
    if remove == "documents":
        return restore(found.filter(~contaminated(F.col("n_hit"), F.col("n_words"))), docs.columns)
    cut = F.arrow_udf(_cut, "string")
    clean = F.when(F.size("hits") > 0, cut(F.col("text"), F.col("hits"))).otherwise(F.col("text"))
    return restore(found.withColumn(f"c{docs.columns.index(text)}", clean), docs.columns)
