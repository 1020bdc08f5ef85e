import hashlib
import zlib
from collections import defaultdict

import pytest
from cases import clashing, odd_documents, rows

from tidebars.llm import merkle as m
from tidebars.llm.queries import LEAF_FIELDS, QUERIES


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in LEAF_FIELDS))


def brute_tree(nodes):
    """The root, and for each leaf its siblings as (digest or None, whether it stands before)."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, p in zip(paths, places):
            path.append((nodes[p ^ 1] if p ^ 1 < len(nodes) else None, bool(p & 1)))
        places = [p >> 1 for p in places]
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def folded(node, path):
    for other, before in path:
        node = h(*([] if other is None else [other]) if before else [], node, *([] if other is None or before else [other]))
    return node


def brute(docs):
    langs = defaultdict(list)
    for r in docs:
        langs[r["lang"]].append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in order:
        own = sorted(langs[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees.append((own, *brute_tree([leaf(r) for r in own])))
    root, above = brute_tree([t[1] for t in trees])
    out = []
    for (own, subroot, paths), top in zip(trees, above):
        for r, path in zip(own, paths):
            bad = dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None:
                bad["n_chars"] += 1
            end = folded(leaf(bad), path + top)
            proof = h(*(d for d, _ in path + top if d))
            out.append((r["doc_id"], leaf(r), subroot, root, proof, end, end == root))
    return sorted(out, key=repr)


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def test_query_equals_brute_force_on_the_whole_table(spark, sf_dir):
    docs = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = rows(QUERIES["op13_merkle"](spark, sf_dir), *COLUMNS)
    assert got == brute(docs)
    assert {g[-1] for g in got} == {True, False}


@pytest.mark.parametrize("span_bits", [12, 2, 1])
def test_odd_rows_in_spans_of_any_size(spark, folder, span_bits):
    docs = odd_documents(spark, [f"text {i} é" for i in range(11)])
    nobody = docs.selectExpr("doc_id", "text", "cast(null AS string) AS lang", "source", "n_chars").limit(5)
    docs = docs.unionByName(nobody)
    docs.write.parquet(f"{folder}/documents.parquet")
    got = rows(QUERIES["op13_merkle"](spark, folder, span_bits), *COLUMNS)
    assert got == brute([r.asDict() for r in docs.collect()])
    wide = m.manifest_of(clashing(docs, "leaf", "tree", "idx", "TEXT"), LEAF_FIELDS, "lang", ["doc_id"])
    assert {r.root for r in wide.root.collect()} == {g[3] for g in got}


def test_one_row_and_no_rows(spark, folder):
    docs = odd_documents(spark, ["alone"])
    docs.limit(1).write.parquet(f"{folder}/documents.parquet")
    only = QUERIES["op13_merkle"](spark, folder).first()
    assert only.leaf == only.subroot == only.root and only.proof_sha256 == h()
    none = m.manifest_of(docs.limit(0), LEAF_FIELDS, "lang", ["doc_id"])
    assert none.root.count() == 0 and m.prove(none).count() == 0


def test_a_few_proofs_fetch_the_least_and_hold(spark):
    docs = odd_documents(spark, [f"text {i}" for i in range(40)])
    manifest = m.manifest_of(docs, LEAF_FIELDS, "lang", ["doc_id"])
    wanted = manifest.leaves.filter("doc_id IN (3, 4, 5, 17)")
    proofs = m.prove(manifest, wanted).join(wanted.select("tree", "idx", "leaf"), ["tree", "idx"])
    held = proofs.select(m.fold(proofs.leaf, proofs.path).alias("end"), "root").collect()
    assert len(held) == 4 and all(r.end == r.root == manifest.root.first().root for r in held)


def test_missing_coordinates_are_least():
    for width in range(1, 18):
        for mask in range(1, min(1 << width, 4096)):
            places = [i for i in range(width) if mask >> i & 1]
            need = m.missing_coordinates(places, width)
            assert len(need) == len(set(need))
            nodes = [h(str(i)) for i in range(width)]
            tree = [nodes]
            while len(tree[-1]) > 1:
                tree.append([h(*tree[-1][i : i + 2]) for i in range(0, len(tree[-1]), 2)])
            below = lambda level, i: set(range(i << level, min((i + 1) << level, width)))
            assert not any(below(*c) & set(places) for c in need)
            levels = m.derive({i: nodes[i] for i in places}, {c: tree[c[0]][c[1]] for c in need}, width)
            assert levels[-1][0] == tree[-1][0]
