"""License scans: MinHash bands over overlapping windows find templates, exact shingle containment verifies them.

Words are as in benchmark decontamination (A-Z lower-cased; runs of digits, letters and non-ASCII characters). Shingles have
five words, or as many as a shorter template has. A template of T distinct shingles is searched for in windows of 2S shingles
that start at multiples of S, S being the least power of two that is T or more; a single shingle is searched for in windows of
one. A window matches if it holds ``CONTAINED`` of the template's distinct shingles or more.

Such a window and its template have a Jaccard similarity of at least 0.8 T / (2S + 0.2 T). A band is one minimum of a hash
function, so one band agrees with that probability; the number of bands is chosen for each S so that all fail together with a
probability of ``MISS`` at most. Retrieval can thus miss a match once in a million; it never adds one.

Templates are held by every task in blocks of a checked size; more of them are searched for in several passes, each of which
adds its matches to those of the last. A template's number counts through the blocks, within a block by id and text.

Null and empty texts have no match; repeated documents are judged each on its own. Repeated templates count once. Templates without an id or without words take no part; those that share an id count as
one license.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidebars.llm.decontamination import words_of
from tidebars.llm.frames import pick, prepare, settle, with_results

SHINGLE, CONTAINED, MISS = 5, 0.8, 1e-6
#: Bytes of templates that a task holds at a time, about; their shingles take some fifty times as much.
BLOCK_BYTES = 2_000_000
#: Shingles of a text whose minima are taken at a time.
_STRETCH = 1 << 14

#: Notices as the licenses ask for them to be quoted.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
                   " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
                     " the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
                " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
                " later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
            " provided that the above copyright notice and this permission notice appear in all copies."),
    ("LicenseRef-All-Rights-Reserved", "All rights reserved."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
            " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
            " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

FOUND = "array<struct<license: string, template: int, first: bigint, last: bigint, contained: double>>"


def bands(t: int, s: int, contained: float = CONTAINED, miss: float = MISS) -> int:
    """Bands that find a template of t shingles, in windows by s, all but ``miss`` of the time."""
    if s == 1:
        return 1
    least = contained * t / (2 * s + (1 - contained) * t)
    return math.ceil(math.log(miss) / math.log(1 - least))


def hashed(words: list[bytes], size: int) -> np.ndarray:
    """A hash of each shingle of ``size`` words."""
    if len(words) < size:
        return np.zeros(0, dtype=np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    out = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for k in range(size):
        out = (out ^ own[k : k + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out


@dataclass
class _Class:
    """Templates with shingles of one size and one S."""

    size: int
    step: int
    factors: np.ndarray
    minima: np.ndarray  # sorted
    members: list[tuple[int, ...]]  # templates by minimum
    sieve: np.ndarray  # by the highest bits: whether some minimum has them

    def near(self, hashes: np.ndarray) -> set[tuple[int, int]]:
        """(window, template) where a minimum agrees."""
        found, reach = set(), self.step if self.step > 1 else 0
        for start in range(0, len(hashes), _STRETCH):
            part = hashes[start : start + _STRETCH + reach]
            least = np.minimum.reduceat(self.factors[:, None] * part[None, :], np.arange(0, len(part), self.step), axis=1)
            if reach and least.shape[1] > 1:
                least = np.concatenate((np.minimum(least[:, :-1], least[:, 1:]), least[:, -1:]), axis=1)
            least = least[:, : -(-min(_STRETCH, len(hashes) - start) // self.step)]
            _, windows = at = np.nonzero(self.sieve[least >> np.uint64(48)])
            values = least[at]
            places = np.minimum(np.searchsorted(self.minima, values), len(self.minima) - 1)
            for window, place in zip(windows[ok := self.minima[places] == values].tolist(), places[ok].tolist()):
                found.update((start // self.step + window, t) for t in self.members[place])
        return found


class TemplateIndex:
    def __init__(self, templates: list[tuple[str, bytes]], contained: float = CONTAINED, miss: float = MISS, first: int = 0):
        self.contained, self.names, self.shingles, self.sizes, self.first = contained, [], [], [], first
        self.classes: list[_Class] = []
        groups: dict[tuple[int, int], list[int]] = {}
        for name, data in templates:
            words = words_of(data)
            if not words:
                continue
            size = min(SHINGLE, len(words))
            own = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
            groups.setdefault((size, 1 << (len(own) - 1).bit_length()), []).append(len(self.names))
            self.names.append(name)
            self.shingles.append(own)
            self.sizes.append(size)
        rng = np.random.default_rng(3)
        for (size, step), numbers in sorted(groups.items()):
            count = max(bands(len(self.shingles[t]), step, contained, miss) for t in numbers)
            factors = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            by_value: dict[int, set[int]] = {}
            for t in numbers:
                own = np.array([hashed(list(s), size)[0] for s in self.shingles[t]], dtype=np.uint64)
                for value in (factors[:, None] * own[None, :]).min(axis=1).tolist():
                    by_value.setdefault(value, set()).add(t)
            minima = np.array(sorted(by_value), dtype=np.uint64)
            sieve = np.zeros(1 << 16, dtype=bool)
            sieve[minima >> np.uint64(48)] = True
            self.classes.append(_Class(size, step, factors, minima, [tuple(sorted(by_value[int(m)])) for m in minima], sieve))

    def find(self, data: bytes | None) -> list[dict]:
        """Matching templates, each with the first word, the last word and the containment of its best window (of equals
        the first)."""
        words, out = words_of(data), []
        hashes = {size: hashed(words, size) for size in {c.size for c in self.classes}}
        for one in self.classes:
            best: dict[int, tuple[float, int]] = {}
            for window, t in sorted(one.near(hashes[one.size])) if len(hashes[one.size]) else ():
                first, own = window * one.step, self.shingles[t]
                stop = min(first + (2 * one.step if one.step > 1 else 1), len(words) - one.size + 1)
                held = set(zip(*(itertools.islice(words, first + k, stop + k) for k in range(one.size)))) & own
                if len(held) >= self.contained * len(own) and len(held) / len(own) > best.get(t, (0.0, 0))[0]:
                    best[t] = len(held) / len(own), first
            for t, (share, first) in best.items():
                places = [i for i in range(first, min(first + 2 * one.step, len(words) - one.size + 1))
                          if tuple(words[i : i + one.size]) in self.shingles[t]]
                out.append({"license": self.names[t], "template": self.first + t, "first": places[0], "last": places[-1] + one.size - 1, "contained": share})
        return sorted(out, key=lambda m: (m["license"], m["template"]))


def _blocks(templates: DataFrame | None, license_id: str, license_text: str, block_bytes: int, contained: float, miss: float):
    """The indexes, one at a time. Templates are dealt to blocks by a hash of their id and text."""
    if templates is None:
        yield TemplateIndex([(name, text.encode()) for name, text in TEMPLATES], contained, miss)
        return
    given = pick(templates, license_id, license_text).toDF("name", "text").filter("name IS NOT NULL AND text IS NOT NULL")
    given = given.select(F.col("name").cast("string").alias("name"), F.col("text").cast("binary").alias("data")).distinct()
    size = given.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0]
    count, first = max(1, -(-size // block_bytes)), 0
    for number in range(count):
        part = given.filter(F.pmod(F.xxhash64("name", "data"), F.lit(count)) == number) if count > 1 else given
        index = TemplateIndex(sorted((r.name, bytes(r.data)) for r in part.collect()), contained, miss, first)
        first += len(index.names)
        yield index


def _scan(index, arrow_type):
    def scan(texts: pa.Array) -> pa.Array:
        return pa.array([index.value.find(t.as_py()) for t in texts], type=arrow_type)

    return scan


def find_licenses(docs: DataFrame, templates: DataFrame | None = None, text: str = "text", license_id: str = "license",
                  license_text: str = "text", contained: float = CONTAINED, miss: float = MISS,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``licenses`` (distinct ids, sorted) and ``matches`` (template, first and last word, containment).

    ``templates``: ids and texts; without it ``TEMPLATES``.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    spark = docs.sparkSession
    prepare(spark)
    arrow_type = to_arrow_type(_parse_datatype_string(FOUND))
    found = docs
    for number, own in enumerate(_blocks(templates, license_id, license_text, block_bytes, contained, miss)):
        scan = F.arrow_udf(_scan(spark.sparkContext.broadcast(own), arrow_type), FOUND)
        if number:
            found = settle(found, "licenses")  # a task holds one block at a time

        def build(data: Column, *old: Column, scan=scan) -> Column:
            new = scan(data.cast("binary"))
            return F.struct((F.concat(old[0], new) if old else new).alias("matches"))

        found = with_results(found, [text, *(["matches"] if number else [])], build, ["matches"])
    order = lambda a, b: F.when(a["license"] < b["license"], -1).when(a["license"] > b["license"], 1).otherwise(a["template"] - b["template"])
    found = with_results(found, ["matches"], lambda m: F.struct(F.array_sort(m, order).alias("matches")), ["matches"]) if number else found
    licenses = lambda m: F.struct(F.array_sort(F.array_distinct(F.transform(m, lambda x: x["license"]))).alias("licenses"))
    return with_results(found, ["matches"], licenses, ["licenses"])
