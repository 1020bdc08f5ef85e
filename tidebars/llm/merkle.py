"""Merkle manifest of a table, and proofs that single rows belong to it.

A leaf is the SHA-256 of the fields of a row. The leaves of a group (say a language) in order form a tree: every two
consecutive nodes become their hash, the last one alone if their number is odd, until one remains. The roots of the groups
in order form one more tree in the same way, whose root stands for the table. Digests are lowercase hex text and are hashed
as such.

The leaves are numbered by a sort over the whole table and cut into spans of ``1 << SPAN_BITS``; a task builds the levels
inside a span, and the tops of spans are the leaves of the next round, so a group may hold any share of the rows.

Proofs are made by spans too, as an octopus multiproof: a span lists the coordinates that its wanted leaves need and cannot
derive from each other, each once; one join fetches them; the span derives the interiors that its leaves share and writes
out the path of each leaf.

Null fields have a form of their own, so they differ from empty texts. A null group is a group of its own and comes first, as do
null order values. Leaves that tie in their order are ordered by their hash; repeated rows are leaves each, with equal paths
but for their place. An empty table has no leaves and no root.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidebars.llm.frames import pick, prepare, settle

#: Levels that a task builds at a time: a span has at most 4,096 leaves.
SPAN_BITS = 12
#: The number of the tree over the roots of the groups.
TOP = -1


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """A field as hashed: its bytes and their number, or a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*fields: Column) -> Column:
    return F.sha2(F.concat(*(field(f) for f in fields)).cast("binary"), 256)


def heights(width: int) -> Iterator[int]:
    """The number of nodes of each level, from the leaves to the root."""
    while True:
        yield width
        if width <= 1:
            return
        width = -(-width // 2)


def _height(width: Column) -> Column:
    return F.when(width > 1, F.length(F.bin(width - 1))).otherwise(0)


def _numbered(df: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """``df`` with ``idx``, the place of a row in its group from 0: a sort by ranges, and sums over the ranges."""
    keys = [*group, *order, "copy"]
    rows = df.withColumn("copy", F.monotonically_increasing_id())  # parts rows that are equal in everything else
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("copy")
    rows = settle(ordered.withColumn("place", F.monotonically_increasing_id()), label)
    rows = rows.withColumn("part", F.shiftright("place", 33))
    parts = rows.groupBy("part", *group).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.expr(
        f"sum(n) OVER ({'PARTITION BY ' + ', '.join(group) if group else ''} ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"),
        F.lit(0))
    parts = parts.select("part", *group, "first", before.alias("before"))
    return rows.join(parts, ["part", *group]).withColumn("idx", F.col("place") - F.col("first") + F.col("before")).drop(
        "part", "place", "first", "before")


def _grouped(batches, n_keys: int, size: int = 8_192) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows that are equal in their first ``n_keys`` columns; rows come sorted."""
    rows = (row for b in batches for at in range(0, b.num_rows, size)
            for row in zip(*(c.to_pylist() for c in b.slice(at, size).columns)))
    for key, run in itertools.groupby(rows, lambda r: r[:n_keys]):
        yield key, [r[n_keys:] for r in run]


def _climb(span_bits: int):
    """From (tree, span, level, width, idx, digest) to the nodes above, up to the top of the span or of the tree."""
    def run(batches):
        for (tree, _), rows in _grouped(batches, 2):
            level, width, first = rows[0][:3]
            nodes, out = [r[3] for r in rows], []
            whole = width <= 1 << span_bits
            for _ in range(span_bits):
                if whole and len(nodes) == 1:
                    break
                nodes = [digest(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
                level, first = level + 1, first >> 1
                out += [(tree, level, first + i, d) for i, d in enumerate(nodes)]
            if out:
                types = [pa.int64(), pa.int32(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 names=["tree", "level", "idx", "digest"])

    return run


def _levels(leaves: DataFrame, span_bits: int, label: str) -> DataFrame:
    """``tree, level, idx, digest`` of all nodes of the trees with ``leaves(tree, width, idx, digest)``."""
    schema = "tree bigint, level int, idx bigint, digest string"
    found = leaves.select("tree", F.lit(0).alias("level"), "idx", "digest")
    widths, widest = leaves.select("tree", "width").distinct(), leaves.agg(F.max("width")).first()[0] or 0
    rows, level = leaves.select("tree", "width", "idx", "digest"), 0
    while widest > 1:
        spans = rows.select("tree", F.shiftright("idx", span_bits).alias("span"), F.lit(level).alias("level"), "width", "idx", "digest")
        built = settle(spans.repartition("tree", "span").sortWithinPartitions("tree", "span", "idx").mapInArrow(_climb(span_bits), schema), label)
        found = found.unionByName(built)
        widest = -(-widest >> span_bits)
        level += span_bits
        widths = widths.filter(F.col("width") > 1 << span_bits).select(
            "tree", F.shiftright(F.col("width") + ((1 << span_bits) - 1), span_bits).alias("width"))
        rows = built.filter(F.col("level") == level).join(widths, "tree")
    return found


@dataclass(frozen=True)
class Manifest:
    """``leaves``: the columns given, ``group, tree, width, idx, leaf``; ``nodes``: tree, level, idx, digest of every node;
    ``trees``: ``group, tree, width, subroot``; ``root``: one row, or none for an empty table."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    root: DataFrame
    span_bits: int = SPAN_BITS


def build_manifest(rows: DataFrame, group: str, order: list[str], span_bits: int = SPAN_BITS) -> Manifest:
    """The trees over ``rows``, which have a column ``leaf`` (``leaf_hash``); other columns are carried along."""
    prepare(rows.sparkSession)
    rows = settle(rows, "merkle-rows")
    trees = _numbered(rows.groupBy(group).agg(F.count("*").alias("width")), [], [group], "merkle-trees")
    trees = settle(trees.withColumnRenamed("idx", "tree"), "merkle-trees")
    placed = rows.join(trees.withColumnRenamed(group, "_group"), F.col(group).eqNullSafe(F.col("_group"))).drop("_group")
    leaves = settle(_numbered(placed, ["tree"], [*order, "leaf"], "merkle-order"), "merkle-leaves")
    nodes = _levels(leaves.withColumnRenamed("leaf", "digest"), span_bits, "merkle-nodes")
    roots = nodes.join(trees.select("tree", "width"), "tree").filter((F.col("level") == _height(F.col("width"))) & (F.col("idx") == 0))
    trees = settle(trees.join(roots.select("tree", F.col("digest").alias("subroot")), "tree"), "merkle-subroots")
    count = trees.agg(F.count("*").alias("width"))
    top = trees.select(F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("idx"), F.col("subroot").alias("digest"))
    upper = _levels(top.crossJoin(F.broadcast(count)), span_bits, "merkle-top")  # the count is one row
    root = upper.join(F.broadcast(count), F.col("level") == _height(F.col("width"))).select(F.col("digest").alias("root"))
    return Manifest(leaves, nodes.unionByName(upper), trees, root, span_bits)


def missing_coordinates(places: Iterable[int], width: int) -> list[tuple[int, int]]:
    """(level, index) of the least set of nodes that the paths of the leaves at ``places`` need beyond what the leaves give."""
    out, known = [], sorted(set(places))
    for level, count in enumerate(heights(width)):
        own = set(known)
        out += [(level, i ^ 1) for i in known if i ^ 1 not in own and i ^ 1 < count]
        known = sorted({i >> 1 for i in known})
    return out


def derive(leaves: dict[int, str], fetched: dict[tuple[int, int], str], width: int) -> list[dict[int, str]]:
    """The digests on and beside the paths of the leaves, by level and index."""
    levels, own = [], dict(leaves)
    for level, count in enumerate(heights(width)):
        here = own | {i: d for (at, i), d in fetched.items() if at == level}
        levels.append(here)
        if count > 1:
            own = {i: digest(*(here[c] for c in (2 * i, 2 * i + 1) if c < count)) for i in {i >> 1 for i in own}}
    return levels


def path_of(levels: list[dict[int, str]], place: int, width: int) -> list[dict]:
    """What stands before and after the node on each level below the root."""
    out = []
    for here, count in zip(levels, heights(width)):
        if count > 1:
            other = here[place ^ 1] if place ^ 1 < count else None
            out.append({"before": other if place & 1 else None, "after": None if place & 1 else other})
            place >>= 1
    return out


def _missing(batches):
    for (tree, span), run in _grouped(batches, 2):
        width, groups = run[0][0], run[0][1]
        need = [(tree, *c) for c in missing_coordinates((r[2] for r in run), width)]
        need += [(TOP, *c) for c in missing_coordinates([tree], groups)]
        if need:
            columns = zip(*((tree, span, *n) for n in need))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             names=["of_tree", "span", "tree", "level", "idx"])


PATH = "array<struct<before: string, after: string>>"


def _expand(leaves: pa.Table, fetched: pa.Table) -> pa.Table:
    rows = list(zip(*(leaves.column(c).to_pylist() for c in ("tree", "width", "groups", "idx", "leaf"))))
    path = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
    names, types = ["tree", "idx", "subroot", "root", "path"], [pa.int64(), pa.int64(), pa.string(), pa.string(), path]
    if not rows:
        return pa.Table.from_arrays([pa.array([], t) for t in types], names=names)
    tree, width, groups = rows[0][:3]
    nodes = list(zip(*(fetched.column(c).to_pylist() for c in ("node_tree", "level", "node_idx", "digest"))))
    levels = derive({r[3]: r[4] for r in rows}, {n[1:3]: n[3] for n in nodes if n[0] == tree}, width)
    subroot = levels[-1][0]
    upper = derive({tree: subroot}, {n[1:3]: n[3] for n in nodes if n[0] == TOP}, groups)
    above, root = path_of(upper, tree, groups), upper[-1][0]
    out = [(tree, i, subroot, root, path_of(levels, i, width) + above) for i in dict.fromkeys(r[3] for r in rows)]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def prove(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """``tree, idx, subroot, root, path`` of the ``wanted`` leaves (rows of ``manifest.leaves``; all by default).

    ``path`` leads from the leaf to the root: what stands before or after the node on each level, both null where it is alone.
    """
    leaves = (manifest.leaves if wanted is None else wanted).select("tree", "width", "idx", "leaf")
    groups = F.broadcast(manifest.trees.agg(F.count("*").alias("groups")))  # one row
    leaves = leaves.crossJoin(groups).withColumn("span", F.shiftright("idx", manifest.span_bits))
    spans = leaves.select("tree", "span", "width", "groups", "idx").repartition("tree", "span").sortWithinPartitions("tree", "span")
    need = settle(spans.mapInArrow(_missing, "of_tree bigint, span bigint, tree bigint, level int, idx bigint"), "merkle-need")
    levels = [r.level for r in need.select("level").distinct().collect()]  # one for each doubling of the rows
    nodes = manifest.nodes.filter(F.col("level").isin(levels) if levels else F.lit(False))
    got = nodes.join(need, ["tree", "level", "idx"]).select(
        F.col("of_tree").alias("tree"), "span", F.col("tree").alias("node_tree"), "level", F.col("idx").alias("node_idx"), "digest")
    schema = f"tree bigint, idx bigint, subroot string, root string, path {PATH}"
    return leaves.groupBy("tree", "span").cogroup(got.groupBy("tree", "span")).applyInArrow(_expand, schema)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    beside = lambda d: F.coalesce(d, F.lit(""))
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(beside(s["before"]), acc, beside(s["after"])).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """The hash of all siblings on a path, from the leaf to the root."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.coalesce(s["before"], s["after"], F.lit(""))), "").cast("binary"), 256)


def manifest_of(docs: DataFrame, fields: list[str], group: str, order: list[str], span_bits: int = SPAN_BITS,
                **more: Column) -> Manifest:
    """The manifest of the rows of ``docs`` over ``fields``; ``more`` columns, of the fields by name, ride along."""
    rows = pick(docs, *dict.fromkeys([*fields, group, *order]))
    hashed = rows.select(*dict.fromkeys([group, *order]), leaf_hash(*(F.col(f) for f in fields)).alias("leaf"),
                         *(c.alias(n) for n, c in more.items()))
    return build_manifest(hashed, group, order, span_bits)
