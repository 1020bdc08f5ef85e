"""SimHash near-dedup with Golay-code fuzzy keys.

The 64 bits of a fingerprint are cut into three segments of at most 23 bits. If two fingerprints differ in at most two bits,
then one segment is equal in both (pigeonhole) and the next one differs in at most two bits. The binary Golay code of length
23 is perfect, and two words that differ in at most two bits share a codeword within distance 4 of both. A word has one such
codeword, or six when it lies at distance 3 from the nearest. So the keys (number of a segment, its bits, index of a codeword
near the next segment) bring all pairs within two bits together; each pair is then verified.

Only distinct fingerprints are joined, so copies cost nothing. A key that more than ``CROWD`` fingerprints share would emit
a square of pairs; its members are linked another exact way: each emits the 65 words within one bit of itself, two
fingerprints within two bits share such a word, no word has more than 65 takers, and the takers of a word, which are all
within two bits of each other, form a star.

A null or blank text has fingerprint zero. Rows with a null id belong to components but never name one, unless a component
has no other id. Repeated rows are members like any other.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidebars.llm.components import connected
from tidebars.llm.frames import beside, pick, prepare, restore, settle

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Members of a key up to which its pairs are compared one by one.
CROWD = 48
#: Shingles whose bits are counted at a time.
_CHUNK = 32_768
#: Generator of the binary Golay code, x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 (a fixed value), and its lengths.
_GENERATOR, _LENGTH, _INFO = 0b110001110101, 23, 12
#: First bit and width of each segment.
SEGMENTS = ((0, 21), (21, 21), (42, 22))


def _bits_over_half(hashes: np.ndarray) -> int:
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = np.ascontiguousarray(hashes[at : at + _CHUNK]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint(data: bytes | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the word shingles of a UTF-8 text; 0 without words."""
    words = data.lower().split() if data else []
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*(itertools.islice(words, k, None) for k in range(shingle))))
    hashed = map(xxhash.xxh64_intdigest, parts, itertools.repeat(SEED))
    return _bits_over_half(np.fromiter(hashed, dtype=np.uint64, count=max(1, len(words) - shingle + 1)))


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    @F.arrow_udf("bigint")
    def hashes(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py(), shingle) for t in texts], type=pa.int64())

    return hashes(text.cast("binary"))


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word by the generator."""
    words = words.copy()
    for bit in range(_LENGTH - 1, _LENGTH - _INFO - 1, -1):
        words = np.where(words >> bit & 1, words ^ (_GENERATOR << (bit - (_LENGTH - _INFO))), words)
    return words


@functools.cache
def _patterns() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the error patterns of weight 4 or less, and how many there are."""
    masks = np.array([sum(1 << b for b in bits) for k in range(5) for bits in itertools.combinations(range(_LENGTH), k)], dtype=np.int64)
    order = np.argsort(_syndrome(masks), kind="stable")
    of, counts = _syndrome(masks)[order], np.bincount(_syndrome(masks), minlength=1 << (_LENGTH - _INFO))
    place = np.arange(len(of)) - (np.cumsum(counts) - counts)[of]
    table = np.zeros((len(counts), counts.max()), dtype=np.int64)
    table[of, place] = masks[order]
    return table, counts


def codeword_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index): the codewords within distance 4 of each 23-bit word, by their information bits."""
    table, counts = _patterns()
    syndromes = _syndrome(words)
    rows = np.repeat(np.arange(len(words)), counts[syndromes])
    place = np.arange(len(rows)) - np.repeat(np.cumsum(counts[syndromes]) - counts[syndromes], counts[syndromes])
    return rows, (words[rows] ^ table[syndromes[rows], place]) >> (_LENGTH - _INFO)


def golay_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of each fingerprint: segment number, the bits of that segment, a codeword near the next one."""
    segments = [(prints >> np.int64(first)) & np.int64((1 << width) - 1) for first, width in SEGMENTS]
    rows, keys = [], []
    for number, exact in enumerate(segments):
        row, index = codeword_indices(segments[(number + 1) % len(SEGMENTS)])
        rows.append(row)
        keys.append((np.int64(number) << 40) | (exact[row] << _INFO) | index)
    return np.concatenate(rows), np.concatenate(keys)


def within_one_bit(prints: np.ndarray) -> np.ndarray:
    """The fingerprint and its 64 neighbours, a row for each fingerprint."""
    flips = np.concatenate((np.zeros(1, dtype=np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64))).view(np.int64)
    return prints[:, None] ^ flips[None, :]


def _emit_golay(batches):
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        rows, keys = golay_keys(prints)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(prints[rows])], ["key", "print"])


def _emit_flips(batches):
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(prints), 4096):
            words = within_one_bit(part := prints[at : at + 4096])
            yield pa.RecordBatch.from_arrays([pa.array(words.ravel()), pa.array(np.repeat(part, 65))], ["key", "print"])


def near_pairs(prints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``high, low``: links that connect all of the distinct ``print`` values within two bits of each other.

    Every pair within two bits is a link, except inside crowded keys, where stars replace pairs.
    """
    keys = settle(prints.select("print").mapInArrow(_emit_golay, "key bigint, print bigint"), "golay")
    sizes = settle(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "golay-sizes")
    crowded = sizes.filter(F.col("n") > crowd).select("key")
    few = settle(keys.join(sizes.filter(F.col("n") <= crowd).select("key"), "key", "left_semi"), "golay-few")
    pairs = (
        few.groupBy("key").agg(F.sort_array(F.collect_list("print")).alias("p"))
        .select(F.explode(F.expr(
            "flatten(transform(p, (x, i) -> transform(filter(slice(p, i + 2, size(p)), y -> bit_count(x ^ y) <= 2),"
            " y -> named_struct('high', y, 'low', x))))")).alias("e"))
        .select("e.high", "e.low")
    )
    members = keys.join(crowded, "key", "left_semi").select("print").distinct()
    stars = (
        members.mapInArrow(_emit_flips, "key bigint, print bigint")
        .groupBy("key").agg(F.collect_list("print").alias("p"), F.min("print").alias("low"))
        .filter("size(p) > 1")
        .select(F.explode(F.expr("filter(p, x -> x > low)")).alias("high"), "low")
    )
    return pairs.unionByName(stars)


def _prints(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    prepare(docs.sparkSession)
    rows = pick(docs, doc_id, text).toDF("doc_id", "text")
    return settle(rows.select("doc_id", fingerprint_column(F.col("text"), shingle).alias("print")), "prints")


def _classes(prints: DataFrame, crowd: int) -> DataFrame:
    """``print, id, root``: a row for each distinct fingerprint, with the smallest id of its component and its root."""
    classes = settle(prints.groupBy("print").agg(F.min("doc_id").alias("id")), "print-classes")
    roots = connected(near_pairs(classes, crowd))
    rooted = settle(
        classes.join(roots.withColumnRenamed("node", "print"), "print", "left")
        .select("print", "id", F.coalesce("root", "print").alias("root")), "print-roots")
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    return settle(rooted.join(least, "root").select("print", "id", "root", "component_id"), "print-components")


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                       crowd: int = CROWD) -> DataFrame:
    """``doc_id, print, component_id`` of every row: the fingerprint and the smallest id that links of at most two
    differing bits reach."""
    prints = _prints(docs, doc_id, text, shingle)
    classes = _classes(prints, crowd).select("print", "component_id")
    return prints.join(classes, "print").select("doc_id", "print", "component_id")


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                     crowd: int = CROWD) -> DataFrame:
    """One row of each component of ``docs``: one with the smallest id; of rows that also share the fingerprint, any one."""
    prints = _prints(docs, doc_id, text, shingle)
    classes = _classes(prints, crowd)
    first = classes.filter(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min("print").alias("kept_print"), F.first("component_id", ignorenulls=True).alias("kept_id"))
    flat, own = beside(docs, [text], lambda t: t), f"c{docs.columns.index(doc_id)}"
    # An id that one row has tells whether the row stays; only rows of other ids need their fingerprint beside it.
    shared = settle(prints.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("shared_id")), "shared-ids")
    alone = first.join(shared, F.col("kept_id").eqNullSafe(F.col("shared_id")), "left_anti")
    chosen = flat.join(alone, F.col(own) == F.col("kept_id"), "left_semi")
    if not shared.isEmpty():
        marked = flat.join(shared, F.col(own).eqNullSafe(F.col("shared_id")), "left_semi").withColumn(
            "made", fingerprint_column(F.col("made"), shingle))
        kept = (F.col("made") == F.col("kept_print")) & F.col(own).eqNullSafe(F.col("kept_id"))
        few = restore(marked.join(first, kept, "left_semi").dropDuplicates(["made", own]), docs.columns)
        return restore(chosen, docs.columns).unionAll(few)
    return restore(chosen, docs.columns)
