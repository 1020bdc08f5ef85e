"""Token ids in binary files: frequency-ranked, byte-aligned, with the control bytes apart from the data bytes.

An id is replaced by its rank by frequency over all documents (ties: the smaller id first), so that the usual ids take one
byte. Two bits in the control bytes tell how many bytes, one to four, each rank takes; the data bytes follow in a block of
their own. Reading looks up four lengths by control byte and gathers with numpy; there is no loop over ids.

A file holds consecutive documents in ascending id order: a header, the document ids, whether these are null, the number of
ids of each document, the control bytes, the data bytes. Documents with null ids come first; rows that share an id are
ordered by a hash of their text, equal rows in any order. A null text counts as empty, and each document ends with the end
id. File names rise with the order of the documents. A file is written under another name and then moved, so a task that
runs again leaves the same files.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import struct
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidebars.llm.frames import pick, prepare, settle
from tidebars.llm.pieces import part

#: Ids in a file; a longer document has a file of its own.
IDS_PER_FILE = 2_000_000
#: Characters of texts that are encoded together.
CHARS = 12_000_000
#: Largest vocabulary whose counts a task holds.
VOCABULARY_BOUND = 1 << 24

_HEADER = struct.Struct("<4sIQQQ")  # mark, documents, ids, ids before the file, data bytes
_MARK = b"ids1"
_STRIDE = 1 << 17  # ids decoded at a time, a multiple of four

_SIZES = np.array([[1 + (c >> 2 * k & 3) for k in range(4)] for c in range(256)], dtype=np.uint8)
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype="<u4")

BLOCKS = "part int, before bigint, n_ids bigint, docs binary, nulls binary, sizes binary, ids binary"


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, dtype="<u4")
    code = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    quads = np.concatenate((code, np.zeros(-len(code) % 4, dtype=np.uint8))).reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    ends = np.cumsum(code + 1, dtype=np.int64)
    starts, parts = ends - (code + 1), values.view(np.uint8).reshape(-1, 4)
    data = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    data[starts] = parts[:, 0]
    for k in (1, 2, 3):
        at = np.flatnonzero(code >= k)
        data[starts[at] + k] = parts[at, k]
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The values of ``pack``."""
    quads = np.frombuffer(control, dtype=np.uint8)
    raw = np.concatenate((np.frombuffer(data, dtype=np.uint8), np.zeros(3, dtype=np.uint8)))
    four = np.ndarray((max(0, len(raw) - 3),), dtype="<u4", buffer=raw, strides=(1,))  # the four bytes from each place on
    out, at = np.empty(count, dtype="<u4"), 0
    for first in range(0, count, _STRIDE):
        sizes = _SIZES[quads[first // 4 : (first + _STRIDE) // 4]].ravel()[: count - first]
        ends = at + np.cumsum(sizes, dtype=np.int64)
        out[first : first + len(sizes)] = four[ends - sizes] & _MASKS[sizes]
        at = int(ends[-1])
    return out


def write_image(start: int, docs: bytes, nulls: bytes, sizes: bytes, ranks: np.ndarray) -> bytes:
    control, data = pack(ranks)
    header = _HEADER.pack(_MARK, len(nulls), len(ranks), start, len(data))
    return b"".join((header, docs, nulls, sizes, control, data))


def read_image(image) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids before the file, document ids, which of them are null, ids in each document, ranks."""
    image = memoryview(image)
    mark, n, count, start, data_bytes = _HEADER.unpack_from(image)
    if mark != _MARK:
        raise ValueError("not a file of token ids")
    cuts = np.cumsum([_HEADER.size, 8 * n, n, 8 * n, -(-count // 4), data_bytes]).tolist()
    docs, nulls, sizes, control, data = (image[a:b] for a, b in zip(cuts, cuts[1:]))
    ranks = unpack(control, data, count)
    return start, np.frombuffer(docs, "<i8"), np.frombuffer(nulls, np.bool_), np.frombuffer(sizes, "<i8"), ranks


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the tasks for all cores
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class _Known:
    """Ids of words, one behind the other, and the number of each word."""

    def __init__(self):
        self.numbers: dict[str, int] = {}
        self.ends, self.flat = np.zeros(1, dtype=np.int64), np.zeros(0, dtype="<u4")

    @property
    def count(self) -> int:
        return len(self.ends) - 1

    def add(self, words: list[str], sizes: np.ndarray, flat: np.ndarray) -> None:
        self.numbers.update(zip(words, range(self.count, self.count + len(words))))
        self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(sizes)))
        self.flat = np.concatenate((self.flat, flat))

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some words, one behind the other, and how many each has."""
        starts, sizes = self.ends[numbers], self.ends[numbers + 1] - self.ends[numbers]
        after = np.cumsum(sizes)
        return self.flat[np.repeat(starts - (after - sizes), sizes) + np.arange(after[-1] if len(after) else 0)], sizes


class TextEncoder:
    """The tokenizers library, which sees each distinct part between spaces once while it is remembered.

    Texts of plain white space (``pieces.keys``) are cut at spaces and line feeds, and the parts of many texts are numbered in
    one pass, so that a part is looked up once for all of them. New parts go to the library as one text with spaces between
    them, where a token that begins with a space begins a part; parts without a space before them are kept apart by a special
    token, at which the library cuts a text before anything else. Texts that hold special tokens or unusual white space, and
    all texts if the file is not byte-level BPE, go to the library whole. Two generations of ``limit`` parts are remembered.
    """

    def __init__(self, path: str, limit: int = 400_000, longest: int = 64, together: int = 64, chars: int = CHARS):
        self.library, self.limit, self.longest, self.together, self.chars = _tokenizer(path), limit, longest, together, chars
        spec = json.loads(self.library.to_str())
        before = spec["pre_tokenizer"] or {}
        plain = before.get("type") == "ByteLevel" and not before["add_prefix_space"] and before["use_regex"]
        added = spec["added_tokens"]
        plain &= not spec["normalizer"] and all(t["special"] and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in added)
        self.special = [t["content"] for t in added]
        self.apart = added[0] if plain and added else None
        names = self.library.get_vocab()
        self.spaced = np.zeros(max(names.values(), default=0) + 1, dtype=bool)
        self.spaced[[i for name, i in names.items() if name.startswith("\u0120")]] = True  # how byte-level files write a space
        self.known, self.old = _Known(), _Known()

    def _plain(self, text: str) -> bool:
        """Whether ``pieces.keys`` can cut the text, and the library takes nothing in it for a special token."""
        if self.apart is None or text[0] in " \n" or text[-1] in " \n" or not text.replace("\n", "").isprintable():
            return False
        return not any(s in text for s in ("  ", " \n", "\n ", "\n\n", *self.special))

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _cut(self, parts: list[str], glue: str, first) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts and how many each has. ``first``: where a part begins among the ids."""
        texts = [glue.join(parts[i : i + self.together]) for i in range(0, len(parts), self.together)]
        ids = np.frombuffer(b"".join(self._whole(texts)), dtype="<u4")
        at = np.flatnonzero(first(ids))
        return ids, np.diff(np.append(at, len(ids)))

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new words, one behind the other, and how many each has."""
        plain = [w[0] != "\n" for w in words]
        ids, sizes = self._cut([part(w) for w, p in zip(words, plain) if p], "", lambda ids: self.spaced[ids])
        if all(plain):
            return ids, sizes
        mark, glue = self.apart["id"], self.apart["content"]
        odd, odd_sizes = self._cut([glue + part(w) for w, p in zip(words, plain) if not p], "", lambda ids: ids == mark)
        both = _Known()
        both.add([], sizes, ids)
        both.add([], odd_sizes - 1, odd[odd != mark])
        order = np.empty(len(words), dtype=np.int64)
        order[np.flatnonzero(plain)] = np.arange(len(sizes))
        order[np.flatnonzero(~np.array(plain))] = np.arange(len(sizes), len(words))
        return both.gather(order)

    def _numbers(self, words: list[str]) -> np.ndarray:
        numbers = np.fromiter(map(self.known.numbers.get, words, itertools.repeat(-1)), dtype=np.int64, count=len(words))
        at = np.flatnonzero(numbers < 0)
        fresh = [words[i] for i in at.tolist()]
        before = np.fromiter(map(self.old.numbers.get, fresh, itertools.repeat(-1)), dtype=np.int64, count=len(fresh))
        for some, ids_of in ((before >= 0, lambda w: self.old.gather(before[before >= 0])), (before < 0, self._learn)):
            if some.any():
                own = [fresh[i] for i in np.flatnonzero(some).tolist()]
                ids, sizes = ids_of(own)
                numbers[at[some]] = self.known.count + np.arange(len(own))
                self.known.add(own, sizes, ids)
        return numbers

    def _encode_plain(self, texts: list[str]) -> list[np.ndarray]:
        # the words of pieces.keys, by one replacement and one cut of all texts
        cut = pc.split_pattern(pa.array(["\n" + t.replace("\n", " \n \n") for t in texts], pa.large_string()), " ")
        coded = cut.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        numbers = self._numbers(words)[coded.indices.to_numpy()]
        flat, sizes = self.known.gather(numbers)
        after = np.concatenate(([0], np.cumsum(sizes)))[cut.offsets.to_numpy()]
        for i in np.flatnonzero(pc.utf8_length(coded.dictionary).to_numpy() > self.longest).tolist():
            del self.known.numbers[words[i]]
        if len(self.known.numbers) > self.limit:
            self.known, self.old = _Known(), self.known
        return np.split(flat, after[1:-1])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, plain, held = [b""] * len(texts), [], 0
        odd = []

        def flush():
            for i, ids in zip(plain, self._encode_plain([texts[i] for i in plain])):
                out[i] = ids.tobytes()

        for i, text in enumerate(texts):
            if not text:
                continue
            if not self._plain(text):
                odd.append(i)
                continue
            if plain and held + len(text) > self.chars:
                flush()
                plain, held = [], 0
            plain.append(i)
            held += len(text)
        if plain:
            flush()
        for i, ids in zip(odd, self._whole([texts[i] for i in odd])):
            out[i] = ids
        return out


@functools.lru_cache(maxsize=1)
def _encoder(path: str) -> TextEncoder:
    """One for each Python worker."""
    return TextEncoder(path)


def _together(batches):
    """Ids and texts of many rows at a time."""
    docs, texts, held = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            docs.append(doc)
            texts.append(text.as_py())
            held += len(texts[-1] or "")
            if held >= CHARS:
                yield docs, texts
                docs, texts, held = [], [], 0
    if docs:
        yield docs, texts


def _blocks(path: str, end_id: int | None, per_file: int, wide: str):
    tail = b"" if end_id is None else struct.pack("<I", end_id)

    def run(batches):
        number = TaskContext.get().partitionId()
        encode, (docs, ids, held, before) = _encoder(path).encode, ([], [], 0, 0)

        def block():
            flat = np.frombuffer(b"".join(ids), dtype="<u4").astype(wide)
            sizes = np.array([len(i) // 4 for i in ids], dtype="<i8")
            known = np.array([0 if d is None else d for d in docs], dtype="<i8")
            nulls = np.array([d is None for d in docs], dtype=np.bool_)
            row = [number, before, len(flat), known.tobytes(), nulls.tobytes(), sizes.tobytes(), flat.tobytes()]
            types = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)],
                                              names=["part", "before", "n_ids", "docs", "nulls", "sizes", "ids"])

        for rows in _together(batches):
            for doc, own in zip(rows[0], encode(rows[1])):
                own += tail
                if ids and held + len(own) // 4 > per_file:
                    yield block()
                    docs, ids, held, before = [], [], 0, before + held
                docs.append(doc)
                ids.append(own)
                held += len(own) // 4
        if docs:
            yield block()

    return run


def _count(wide: str, size: int):
    def run(batches):
        counts = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for ids in batch.column(0):
                counts += np.bincount(np.frombuffer(ids.as_buffer(), dtype=wide), minlength=size)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["id", "n"])

    return run


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://"))


def _put(folder: str, name: str, image: bytes) -> None:
    files, base = _filesystem(folder)
    files.create_dir(base, recursive=True)
    hidden = f"{base}/_{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(hidden) as out:
        out.write(image)
    files.move(hidden, f"{base}/{name}")


def _write(folder: str, wide: str, rank_of, starts):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ranks = rank_of.value[np.frombuffer(row["ids"], dtype=wide)]
                start = starts.value[row["part"]] + row["before"]
                image = write_image(start, row["docs"], row["nulls"], row["sizes"], ranks)
                name = f"{row['part']:07d}-{row['before']:015d}.ids"
                _put(folder, name, image)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v]) for v in (name, start, len(row["nulls"]), row["n_ids"], len(image))],
                    names=["file", "start", "n_docs", "n_ids", "n_bytes"])

    return run


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int | None = None, doc_id: str = "doc_id",
                      text: str = "text", per_file: int = IDS_PER_FILE) -> DataFrame:
    """Write the ids of all documents to ``folder``, which all machines share, and return a row for each file.

    ``path``: the vocabulary file of the tokenizers library, at the same place on every machine; ``end_id``: appended to
    every document. Counts and starts reach the driver as one number for each vocabulary entry and each task.
    """
    spark = docs.sparkSession
    prepare(spark)
    size = max(_tokenizer(path).get_vocab_size(), (end_id or 0) + 1)
    if size > VOCABULARY_BOUND:
        raise ValueError(f"a vocabulary of {size} is over {VOCABULARY_BOUND}")
    wide = "<u2" if size <= 1 << 16 else "<u4"
    rows = pick(docs, doc_id, text).toDF("doc_id", "text")
    # the last key splits rows that are equal in all others
    rows = rows.withColumns({"tie": F.xxhash64("text"), "copy": F.monotonically_increasing_id()})
    ordered = rows.repartitionByRange("doc_id", "tie", "copy").sortWithinPartitions("doc_id", "tie", "copy")
    blocks = settle(ordered.select("doc_id", "text").mapInArrow(_blocks(path, end_id, per_file, wide), BLOCKS), "id-blocks",
                    compression="zstd")
    counted = blocks.select("ids").mapInArrow(_count(wide, size), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(size, dtype=np.int64)
    for row in counted.collect():  # at most a row for each vocabulary entry
        counts[row.id] = row.n
    id_of = np.lexsort((np.arange(size), -counts)).astype("<u4")
    rank_of = np.empty(size, dtype="<u4")
    rank_of[id_of] = np.arange(size, dtype="<u4")
    starts, total = {}, 0
    for row in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect():  # a row for each task
        starts[row.part], total = total, total + row.n
    _put(folder, "_ranks", id_of.tobytes())
    send = spark.sparkContext.broadcast
    return settle(blocks.mapInArrow(_write(folder, wide, send(rank_of), send(starts)),
                                    "file string, start bigint, n_docs bigint, n_ids bigint, n_bytes bigint"), "id-files")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start`` (ids of all documents before it), ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers)
    of every document in the files of ``folder``."""
    prepare(spark)
    files, base = _filesystem(folder)
    with files.open_input_stream(f"{base}/_ranks") as source:
        id_of = spark.sparkContext.broadcast(np.frombuffer(source.read(), dtype="<u4"))

    def run(batches):
        for batch in batches:
            for image in batch.column(0):
                start, docs, nulls, sizes, ranks = read_image(image.as_buffer())
                ids = id_of.value[ranks]
                ends = np.cumsum(sizes)
                for lo in range(0, len(docs), 256):
                    at = slice(lo, lo + 256)
                    own = [ids[e - n : e].tobytes() for e, n in zip(ends[at].tolist(), sizes[at].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs[at], mask=nulls[at]), pa.array(start + ends[at] - sizes[at]), pa.array(sizes[at]), pa.array(own, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    images = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder)
    return images.select("content").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
