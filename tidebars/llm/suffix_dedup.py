"""Removal of repeated byte strings by suffix arrays.

A window is a string of ``LENGTH`` bytes of one text. All bytes of a window that also starts anywhere else go.

Windows are dealt to shards by content, so that equal windows meet and no pair of text blocks has to be compared: the key of a
window is the least hash among its strings of ``GRAM`` bytes, and a run is a stretch of neighbouring windows of one key.

1. A task writes its texts as files in the shared folder and lists the runs of each file, sorted by key.
   Of runs that are equal within a file one is listed; all of them are repeats.
2. The sorted lists of all files meet by ranges of keys. A run whose key is nowhere else holds no repeat. Runs that are equal
   from end to end (128-bit digests) are repeats as a whole, and one of them stands for all.
3. The files are asked for the bytes of the runs that are left, each different run once; these are dealt to shards by key, or,
   where a key has many, by key and digest.
4. In a shard, a suffix array by Larsson-Sadakane refinement (only suffixes that are still tied are sorted again, by the ranks
   of their continuations at twice the distance) and Kasai's common prefixes tell which windows are repeated.
5. Shards of one key are merged: each brings its different windows as a list sorted by digest, cut by ranges; each list is
   looked up in the others by binary search.
6. Each file takes the windows found and cuts its texts.

A hash decides only which bytes are compared (a chance collision costs a comparison), digests of 128 bits stand for equal
strings. No step holds more than a file, a shard, or a range of the key lists. Nothing reaches the driver but sizes.

A null text is empty. Texts shorter than a window keep all bytes. Repeated rows are each other's repeats and lose all bytes that
windows cover. A string of one letter repeats itself. What is kept may begin or end inside a character, so it is binary.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidebars.llm.frames import pick, prepare, settle
from tidebars.session import scratch_dir

LENGTH = 200
#: Bytes of the strings of which a window's least hash is its key.
GRAM = 32
#: Windows of a run at most; a longer stretch is several runs.
RUN = 4_096
#: Bytes of texts in a file; a longer text has one of its own.
FILE_BYTES = 8 << 20
#: Window starts whose keys are computed at a time.
CHUNK = 1 << 20
#: Bytes of a suffix array, and of the runs of one key in a shard.
SHARD_BYTES, KEY_BYTES = 1 << 20, 1 << 17
#: Run entries in a range of the key lists, about.
RANGE_RUNS = 1 << 20

_RUNS = np.dtype([("key", "<u8"), ("digest", "S16"), ("start", "<u4"), ("n", "<u2"), ("again", "u1"), ("copied", "u1")])
_ASKED = np.dtype([("key", "<u8"), ("part", "<u4"), ("parts", "<u4"), ("start", "<u4"), ("n", "<u2"), ("known", "u1")])
_SPANS = np.dtype([("start", "<u4"), ("n", "<u4")])
_OWNED = np.dtype([("digest", "S16"), ("file", "<i8"), ("start", "<u4"), ("single", "u1")])

_MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


# -- keys and runs ------------------------------------------------------------------------------


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number; the end is filled with zeros."""
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    return np.ndarray((len(data),), dtype="<u8", buffer=padded, strides=(1,)).copy()


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each place on, of which there are ``len(data) - gram + 1``."""
    words, count = _words(data), len(data) - gram + 1
    out = np.zeros(count, dtype="u8")
    for k, at in enumerate([*range(0, gram - 8, 8), gram - 8]):
        out = (out ^ words[at : at + count]) * _MIX[k % 4]
        out ^= out >> np.uint64(29)
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of the ``width`` values from each place on."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


def list_runs(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """The runs of the texts that lie one behind the other in ``data``, sorted by key."""
    begins = np.concatenate(([0], ends[:-1]))
    change = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(change, begins, 1)
    np.add.at(change, np.maximum(begins, ends - (length - 1)), -1)
    starts = np.cumsum(change[:-1]) > 0  # places where a window of one text starts
    held, view = [], memoryview(data)
    for first in range(0, len(data) - length + 1, CHUNK):
        own = starts[first : min(first + CHUNK, len(data) - length + 1)]
        hashes = _gram_hashes(data[first : first + len(own) + length - 1], gram)
        keys = _least(hashes, length - gram + 1)
        same = np.concatenate(([False], own[1:] & own[:-1] & (keys[1:] == keys[:-1])))
        at = np.flatnonzero(own & ~same)
        stop = np.flatnonzero(own & ~np.concatenate((same[1:], [False]))) + 1
        if len(at) and (stop - at).max() > RUN:
            cut = [np.arange(a, b, RUN) for a, b in zip(at, stop)]
            stop = np.concatenate([np.append(c[1:], b) for c, b in zip(cut, stop)])
            at = np.concatenate(cut)
        if not len(at):
            continue
        runs = np.zeros(len(at), dtype=_RUNS)
        runs["key"], runs["start"], runs["n"] = keys[at], at + first, stop - at
        hashes.sort()
        runs["again"] = np.searchsorted(hashes, runs["key"], "right") - np.searchsorted(hashes, runs["key"], "left") > 1
        runs["key"] *= _MIX[0]  # least values crowd at zero; their products spread over all ranges
        runs["digest"] = [hashlib.blake2b(view[a:b], digest_size=16).digest()
                          for a, b in zip((at + first).tolist(), (stop + first + length - 1).tolist())]
        held.append(runs)
    runs = np.concatenate(held) if held else np.zeros(0, dtype=_RUNS)
    return runs[np.argsort(runs["key"], kind="stable")]


def collapse_copies(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One of each group of equal runs, marked as ``copied``; and the spans of all that have a copy here."""
    keys = runs["key"]
    near = np.concatenate(([False], keys[1:] == keys[:-1]))
    near[:-1] |= near[1:]
    some = np.flatnonzero(near)  # runs that share their key, in the order of keys
    some = some[np.lexsort((runs["digest"][some], keys[some]))]
    again = runs[some]
    new = np.ones(len(some), dtype=bool)
    new[1:] = (again["key"][1:] != again["key"][:-1]) | (again["digest"][1:] != again["digest"][:-1])
    copies = np.diff(np.append(np.flatnonzero(new), len(some)))
    spans = np.zeros(int(copies[copies > 1].sum()), dtype=_SPANS)
    copied = again[np.repeat(copies, copies) > 1]
    spans["start"], spans["n"] = copied["start"], copied["n"]
    runs = runs.copy()
    runs["copied"][some[new]] = copies > 1
    listed = np.ones(len(runs), dtype=bool)
    listed[some[~new]] = False
    return runs[listed], spans


def match_runs(runs: np.ndarray, length: int = LENGTH, key_bytes: int = KEY_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the runs of all files in a range of keys: which are repeats as a whole, which are to be asked for, and what to ask."""
    order = np.argsort(runs["key"], kind="stable")
    keys = runs["key"][order]
    fresh = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=bool)
    sizes = np.diff(np.append(np.flatnonzero(fresh), len(keys)))
    left = order[(np.repeat(sizes, sizes) > 1) | (runs["again"][order] > 0) | (runs["copied"][order] > 0)]
    left = left[np.lexsort((runs["digest"][left], runs["key"][left]))]
    some = runs[left]
    new_key = np.concatenate(([True], some["key"][1:] != some["key"][:-1])) if len(some) else np.zeros(0, dtype=bool)
    new = new_key | (np.concatenate(([True], some["digest"][1:] != some["digest"][:-1])) if len(some) else new_key)
    copies = np.diff(np.append(np.flatnonzero(new), len(some)))
    whole = np.repeat((copies > 1) | (np.maximum.reduceat(some["copied"], np.flatnonzero(new)) > 0 if len(some) else False), copies)
    of_key = np.cumsum(new_key) - 1
    kinds = np.bincount(of_key, weights=new, minlength=of_key[-1] + 1 if len(some) else 0)
    weight = np.bincount(of_key, weights=np.where(new, some["n"] + np.int64(length - 1), 0), minlength=len(kinds))
    asked = new & ((kinds[of_key] > 1) | ~whole)
    ask = np.zeros(int(asked.sum()), dtype=_ASKED)
    one = some[asked]
    for name in ("key", "start", "n"):
        ask[name] = one[name]
    ask["known"] = whole[asked]
    ask["parts"] = np.maximum(1, -(-weight[of_key[asked]] // key_bytes))
    heads = np.frombuffer(b"".join(d.ljust(16, b"\0")[:8] for d in one["digest"].tolist()), dtype="<u8")
    ask["part"] = heads % ask["parts"]
    return left[whole], left[asked], ask


# -- suffix arrays ------------------------------------------------------------------------------

#: Places that fit a packed sort key beside two ranks; bytes that fit one beside a place, as digits of which 0 is the end.
_PACKED = (1 << 21) - 2
_FIRST = 5


def _sorted_by(major: np.ndarray, minor: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """``place`` ordered by (major, minor): one sort of packed numbers where they fit."""
    if n <= _PACKED:
        packed = (major.astype("u8") << np.uint64(42)) | (minor.astype("u8") << np.uint64(21)) | place.astype("u8")
        packed.sort()
        return (packed & np.uint64((1 << 21) - 1)).astype(np.int64)
    return place[np.lexsort((minor, major))]


def suffix_array(data: np.ndarray) -> np.ndarray:
    """The places of ``data`` in the order of its suffixes."""
    n = len(data)
    digits = np.concatenate((data.astype("u8") + np.uint64(1), np.zeros(_FIRST, dtype="u8")))
    head = np.zeros(n, dtype="u8")
    for k in range(_FIRST):
        head = head * np.uint64(257) + digits[k : k + n]
    if n <= _PACKED:
        packed = (head << np.uint64(21)) | np.arange(n, dtype="u8")
        packed.sort()
        order = (packed & np.uint64((1 << 21) - 1)).astype(np.int64)
    else:
        order = np.argsort(head, kind="stable")
    fresh = np.concatenate(([True], head[order][1:] != head[order][:-1])) if n else np.zeros(0, dtype=bool)
    slots, reach = np.arange(n), _FIRST
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, slots, 0))

    def beyond(place):
        return np.where(place + reach < n, rank[np.minimum(place + reach, n - 1)] + 1, 0)

    while True:
        tied = ~(fresh & np.concatenate((fresh[1:], [True])))
        slots = slots[tied]
        if not len(slots):
            return order
        place = order[slots]
        place = _sorted_by(rank[place], beyond(place), place, n)
        major, minor = rank[place], beyond(place)
        fresh = np.concatenate(([True], (major[1:] != major[:-1]) | (minor[1:] != minor[:-1])))
        order[slots] = place
        rank[place] = np.maximum.accumulate(np.where(fresh, slots, 0))
        reach *= 2


def common_prefixes(data: np.ndarray, begins: np.ndarray, counts: np.ndarray, before: np.ndarray, most: int) -> np.ndarray:
    """Kasai's common prefixes, at most ``most``, of each start and the one ``before`` it in the suffix array (-1: none).

    Starts are ``counts`` neighbouring places from each of ``begins`` on; from one place to the next a prefix gets shorter by
    one at most, as long as the neighbour's next place is a start too. All stretches go on side by side.
    """
    words, out = _words(data), np.zeros(len(data), dtype=np.int64)
    by_count = np.argsort(-counts, kind="stable")
    begins, counts = begins[by_count], counts[by_count]
    have, last = np.zeros(len(begins), dtype=np.int64), np.full(len(begins), -2)
    for step in range(int(counts[0]) if len(counts) else 0):
        lanes = int(np.searchsorted(-counts, -step, "left"))  # stretches with more than ``step`` starts
        place = begins[:lanes] + step
        other, follows = before[place], last[:lanes] + 1
        goes_on = (last[:lanes] >= 0) & (before[np.minimum(follows, len(before) - 1)] != -2)
        h = np.where(goes_on, np.maximum(have[:lanes] - 1, 0), 0)
        open_ = np.flatnonzero((other >= 0) & (h < most))
        while len(open_):
            differ = words[place[open_] + h[open_]] ^ words[other[open_] + h[open_]]
            equal = np.where(differ == 0, 8, np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) >> 3)
            h[open_] += equal
            open_ = open_[(equal == 8) & (h[open_] < most)]
        h = np.where(other >= 0, np.minimum(h, most), 0)
        out[place], have[:lanes], last[:lanes] = h, h, other
    return out


def repeated_windows(bodies: list, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all window starts in ``bodies``, joined: the starts, the number of the class of equal windows, its size."""
    data = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    sizes = np.array([len(b) for b in bodies])
    begins, counts = np.cumsum(sizes) - sizes, sizes - (length - 1)
    is_start = np.zeros(len(data), dtype=bool)
    places = np.repeat(begins, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    is_start[places] = True
    order = suffix_array(data)
    order = order[is_start[order]]
    before = np.full(len(data), -2)
    before[order] = np.concatenate(([-1], order[:-1]))
    shared = common_prefixes(data, begins, counts, before, length)[order] >= length
    of = np.cumsum(~shared) - 1
    return order, of, np.bincount(of)[of] if len(of) else of


# -- tables -------------------------------------------------------------------------------------


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://"))


def _put(folder: str, number: int, docs: pa.Array, texts: pa.Array) -> None:
    files, base = _filesystem(folder)
    files.create_dir(base, recursive=True)
    table = pa.table({"doc_id": docs, "text": texts})
    with files.open_output_stream(f"{base}/{number & (1 << 64) - 1:016x}.arrow") as out:
        with pa.ipc.new_file(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(table)


def _get(folder: str, number: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Document ids, the texts one behind the other, the end of each."""
    files, base = _filesystem(folder)
    with files.open_input_stream(f"{base}/{number & (1 << 64) - 1:016x}.arrow") as source:
        table = pa.ipc.open_file(source.read()).read_all().combine_chunks()
    text = table.column("text").combine_chunks()
    data = b"".join(text.to_pylist())
    return table.column("doc_id"), np.frombuffer(data, dtype=np.uint8), np.cumsum([len(t) for t in text.to_pylist()], dtype=np.int64)


def _batch(rows: list[tuple], **types: pa.DataType) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values())], names=list(types))


def _write_files(folder: str, length: int, gram: int, file_bytes: int):
    """Texts to files; for each file its number, its bytes and its runs. A task that runs again writes other files, and what
    it returns names those."""
    def run(batches):
        docs, texts, held = [], [], 0

        def done():
            number = uuid.uuid4().int >> 65  # a positive long
            _put(folder, number, pa.array(docs, pa.int64()), pa.array(texts, pa.large_binary()))
            data = np.frombuffer(b"".join(texts), dtype=np.uint8)
            runs, spans = collapse_copies(list_runs(data, np.cumsum([len(t) for t in texts], dtype=np.int64), length, gram))
            return _batch([(number, len(runs), runs.tobytes(), spans.tobytes())], file=pa.int64(), n_runs=pa.int64(), runs=pa.binary(),
                          spans=pa.binary())

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or b""
                if docs and held + len(text) > file_bytes:
                    yield done()
                    docs, texts, held = [], [], 0
                docs.append(doc)
                texts.append(text)
                held += len(text)
        if docs:
            yield done()

    return run


def _cut_lists(ranges: int):
    def run(batches):
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                runs = np.frombuffer(data.as_buffer(), dtype=_RUNS)
                of = (runs["key"] >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
                cuts = np.append(np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))), len(runs)) if len(runs) else [0]
                rows = [(int(of[a]), number, runs[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]
                if rows:
                    yield _batch(rows, range=pa.int64(), file=pa.int64(), runs=pa.binary())

    return run


def _runs_of(batches, n_keys: int):
    """Runs of rows that are equal in their first ``n_keys`` columns; rows come sorted."""
    import itertools

    rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
    for key, run in itertools.groupby(rows, lambda r: r[:n_keys]):
        yield key, [r[n_keys:] for r in run]


def _by_file(files: np.ndarray, values: np.ndarray) -> dict[int, bytes]:
    order = np.argsort(files, kind="stable")
    files, values = files[order], values[order]
    cuts = np.append(np.flatnonzero(np.concatenate(([True], files[1:] != files[:-1]))), len(files)) if len(files) else [0]
    return {int(files[a]): values[a:b].tobytes() for a, b in zip(cuts, cuts[1:])}


def _match(length: int, key_bytes: int):
    def run(batches):
        for _, rows in _runs_of(batches, 1):
            lists = [np.frombuffer(r[1], dtype=_RUNS) for r in rows]
            runs, files = np.concatenate(lists), np.repeat([r[0] for r in rows], [len(x) for x in lists])
            whole, asked, ask = match_runs(runs, length, key_bytes)
            spans = np.zeros(len(whole), dtype=_SPANS)
            spans["start"], spans["n"] = runs["start"][whole], runs["n"][whole]
            spans, ask = _by_file(files[whole], spans), _by_file(files[asked], ask)
            out = [(f, spans.get(f, b""), ask.get(f, b"")) for f in spans.keys() | ask.keys()]
            if out:
                yield _batch(out, file=pa.int64(), spans=pa.binary(), asked=pa.binary())

    return run


def _cut_bodies(folder: str, length: int):
    def run(batches):
        for (number,), rows in _runs_of(batches, 1):
            _, data, _ = _get(folder, number)
            view = memoryview(data)
            for (asked,) in rows:
                ask = np.frombuffer(asked, dtype=_ASKED)
                out = [(*a[:3], number, a[3], bool(a[5]), view[a[3] : a[3] + a[4] + length - 1].tobytes()) for a in ask.tolist()]
                out = [(k - (1 << 64) if k >> 63 else k, *rest) for k, *rest in out]
                yield _batch(out, key=pa.int64(), part=pa.int64(), parts=pa.int64(), file=pa.int64(), start=pa.int64(),
                             known=pa.bool_(), body=pa.binary())

    return run


def _spans_of(files: np.ndarray, starts: np.ndarray) -> list[tuple[int, bytes]]:
    """Window starts as spans of neighbours, by file."""
    order = np.lexsort((starts, files))
    files, starts = files[order], starts[order]
    fresh = np.concatenate(([True], (files[1:] != files[:-1]) | (starts[1:] != starts[:-1] + 1))) if len(files) else np.zeros(0, dtype=bool)
    at = np.flatnonzero(fresh)
    spans = np.zeros(len(at), dtype=_SPANS)
    spans["start"], spans["n"] = starts[at], np.diff(np.append(at, len(files)))
    return list(_by_file(files[at], spans).items())


def _shards(length: int, ranges: int, shard_bytes: int):
    """Spans of the repeats in each shard, by file; and the windows of shards that are to be merged, by range of digests."""
    types = dict(file=pa.int64(), spans=pa.binary(), key=pa.int64(), range=pa.int64(), part=pa.int64(), windows=pa.binary())

    def found(held):
        bodies = [h[5] for h in held]
        order, of, size = repeated_windows(bodies, length)
        sizes = np.array([len(b) for b in bodies])
        begins = np.cumsum(sizes) - sizes
        body = np.searchsorted(begins, order, "right") - 1
        files, firsts, known = (np.array([h[i] for h in held]) for i in (2, 3, 4))
        starts = firsts[body] + order - begins[body]
        hit = (size > 1) & ~known[body]
        rows = [(f, s, None, None, None, None) for f, s in _spans_of(files[body[hit]], starts[hit])]
        parts = np.array([h[1] for h in held])
        if (parts > 1).any():
            rows += merged(held, bodies, order, of, size, begins, body, files, starts, known, parts)
        return _batch(rows, **types) if rows else None

    def merged(held, bodies, order, of, size, begins, body, files, starts, known, parts):
        first = np.concatenate(([True], of[1:] != of[:-1])) & (parts[body] > 1)  # one window of each class
        at = np.flatnonzero(first)
        windows = np.zeros(len(at), dtype=_OWNED)
        data = b"".join(bodies)
        windows["digest"] = [hashlib.blake2b(data[p : p + length], digest_size=16).digest() for p in order[at].tolist()]
        windows["file"], windows["start"] = files[body[at]], starts[at]
        windows["single"] = (size[at] == 1) & ~known[body[at]]
        keys, part = np.array([h[0][0] for h in held])[body[at]], np.array([h[0][1] for h in held])[body[at]]
        of_range = np.array([d.ljust(16, b"\0")[0] * 256 + d.ljust(16, b"\0")[1] for d in windows["digest"].tolist()]) * ranges >> 16
        by = np.lexsort((windows["digest"], part, of_range, keys))
        keys, part, of_range, windows = keys[by], part[by], of_range[by], windows[by]
        new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (part[1:] != part[:-1]) | (of_range[1:] != of_range[:-1])))
        cuts = np.append(np.flatnonzero(new), len(windows))
        return [(None, None, int(keys[a]), int(of_range[a]), int(part[a]), windows[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]

    def run(batches):
        held, size = [], 0
        for key, rows in _runs_of(batches, 2):
            weight = sum(len(r[4]) for r in rows)
            if held and size + weight > shard_bytes:
                if (out := found(held)) is not None:
                    yield out
                held, size = [], 0
            held += [(key, *r) for r in rows]
            size += weight
        if held and (out := found(held)) is not None:
            yield out

    return run


def merge_windows(lists: list[np.ndarray]) -> np.ndarray:
    """The single windows of sorted lists that another list holds too."""
    found = []
    for i, own in enumerate(lists):
        hit = np.zeros(len(own), dtype=bool)
        for j, other in enumerate(lists):
            if i != j:
                at = np.minimum(np.searchsorted(other["digest"], own["digest"]), len(other) - 1)
                hit |= other["digest"][at] == own["digest"]
        found.append(own[hit & (own["single"] > 0)])
    return np.concatenate(found)


def _merge(batches):
    for _, rows in _runs_of(batches, 2):
        if len(rows) > 1:
            hit = merge_windows([np.frombuffer(r[1], dtype=_OWNED) for r in rows])
            out = _spans_of(hit["file"], hit["start"].astype(np.int64))
            if out:
                yield _batch(out, file=pa.int64(), spans=pa.binary())


def _cut_texts(folder: str, length: int):
    spans_type = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for (number,), rows in _runs_of(batches, 1):
            docs, data, ends = _get(folder, number)
            change = np.zeros(len(data) + 1, dtype=np.int64)
            for (spans,) in rows:
                if spans:
                    own = np.frombuffer(spans, dtype=_SPANS)
                    np.add.at(change, own["start"], 1)
                    np.add.at(change, own["start"].astype(np.int64) + own["n"] + (length - 1), -1)
            gone = np.cumsum(change[:-1]) > 0
            out, begin = [], 0
            for doc, end in zip(docs.to_pylist(), ends.tolist()):
                cut = gone[begin:end]
                edges = np.flatnonzero(np.diff(np.concatenate(([0], cut.view(np.int8), [0])))).tolist()
                spans = [{"first": a, "end": b} for a, b in zip(edges[::2], edges[1::2])]
                out.append((doc, end - begin, int(cut.sum()), spans, data[begin:end][~cut].tobytes()))
                begin = end
                if len(out) == 256:
                    yield _batch(out, doc_id=pa.int64(), n_bytes=pa.int64(), n_removed=pa.int64(), spans=spans_type, kept=pa.binary())
                    out = []
            if out:
                yield _batch(out, doc_id=pa.int64(), n_bytes=pa.int64(), n_removed=pa.int64(), spans=spans_type, kept=pa.binary())

    return run


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<first: bigint, end: bigint>>, kept binary"


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM,
                   file_bytes: int = FILE_BYTES, shard_bytes: int = SHARD_BYTES, key_bytes: int = KEY_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans`` (removed, in bytes) and ``kept`` (the remaining bytes) of every row of ``docs``.

    ``length``: bytes of a window; ``gram``: 8 to ``length``. The other sizes bound what a task holds.
    """
    spark = docs.sparkSession
    prepare(spark)
    folder = scratch_dir(spark, "suffix-texts")
    rows = pick(docs, doc_id, text).toDF("doc_id", "text").select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary"))
    files = settle(rows.mapInArrow(_write_files(folder, length, gram, file_bytes), "file bigint, n_runs bigint, runs binary, spans binary"),
                   "suffix-runs")
    total, count = files.agg(F.coalesce(F.sum("n_runs"), F.lit(0)), F.count("*")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_RUNS))
    ranges = 4 * parts
    lists = files.select("file", "runs").mapInArrow(_cut_lists(ranges), "range bigint, file bigint, runs binary")
    met = lists.repartition(parts, "range").sortWithinPartitions("range")
    matched = settle(met.mapInArrow(_match(length, key_bytes), "file bigint, spans binary, asked binary"), "suffix-matched")
    by_file = min(max(1, count), max(parts, -(-count // 64)))
    asked = matched.filter(F.octet_length("asked") > 0).select("file", "asked")
    bodies = asked.repartition(by_file, "file").sortWithinPartitions("file").mapInArrow(
        _cut_bodies(folder, length), "key bigint, part bigint, parts bigint, file bigint, start bigint, known boolean, body binary")
    dealt = bodies.repartition(parts, "key", "part").sortWithinPartitions("key", "part")
    found = settle(dealt.mapInArrow(_shards(length, min(parts, 1 << 16), shard_bytes),
                                    "file bigint, spans binary, key bigint, range bigint, part bigint, windows binary"), "suffix-found")
    windows = found.filter("windows IS NOT NULL").select("key", "range", "part", "windows")
    merged = windows.repartition(parts, "key", "range").sortWithinPartitions("key", "range").mapInArrow(_merge, "file bigint, spans binary")
    spans = files.select("file", "spans").unionByName(matched.select("file", "spans")).unionByName(
        found.filter("spans IS NOT NULL").select("file", "spans")).unionByName(merged)
    return spans.repartition(by_file, "file").sortWithinPartitions("file").mapInArrow(_cut_texts(folder, length), RESULT)
