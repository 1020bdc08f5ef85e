import hashlib
import os
import re

import numpy as np
import pytest
import public_tokenizers
from cases import clashing, odd_documents
from test_bpe import library_ids
from test_decontamination import brute as contamination
from test_secret_scan import brute as secrets
from test_simhash import brute_components, brute_print

import corpus_pipeline as p
from tidebars.llm import quality


@pytest.fixture(scope="module")
def staged(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in p.STAGES:
        after = stage(spark, docs, sf_dir).persist()
        out.append((name, docs.collect(), after.collect(), after.columns))
        docs = after
    return out


def test_columns_stay(spark, sf_dir, staged):
    own = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    assert [s[0] for s in staged] == [n for n, _ in p.STAGES] and all(s[3] == own for s in staged[:-1])


def test_quality_follows_the_rules(spark, sf_dir, staged):
    _, before, after, _ = staged[0]
    model = quality.fit_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = [r.doc_id for r in before if model.constant + sum(
        w for rule, w in model.weights.items() if all(a < quality.statistics(r.text.encode())[n] <= b for n, a, b in rule)) >= 0]
    assert sorted(r.doc_id for r in after) == sorted(good) and 0 < len(after) < len(before)


def test_one_of_each_group_stays(staged):
    _, before, after, _ = staged[1]
    prints = {r.doc_id: brute_print(r.text) for r in before}
    roots, low = brute_components(set(prints.values())), {}
    for i, x in sorted(prints.items()):
        low.setdefault(roots[x], i)
    assert sorted(r.doc_id for r in after) == sorted(low.values())


def test_contaminated_documents_go(spark, sf_dir, staged):
    _, before, after, _ = staged[2]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    clean = [r.doc_id for r in before for n, h, _ in [contamination(r.text, items)] if not (h and 20 * h >= n)]
    assert sorted(r.doc_id for r in after) == sorted(clean)


def test_secrets_are_replaced(staged):
    _, before, after, _ = staged[3]
    texts = {r.doc_id: r.text for r in after}
    assert len(texts) == len(before)
    for r in before:
        spans = secrets(r.text)
        assert (texts[r.doc_id] == r.text) == (not spans)
        if spans:
            first, last = min(s[1] for s in spans), max(s[2] for s in spans)
            assert texts[r.doc_id].startswith(r.text[:first] + "[secret]") and texts[r.doc_id].endswith(r.text[last:])


def test_ids_of_all_that_is_left(staged):
    _, before, after, _ = staged[4]
    expected = {r.doc_id: hashlib.sha256(np.array(library_ids(r.text), dtype="<u4").tobytes()).hexdigest() for r in before}
    assert {r.doc_id: r.ids_sha256 for r in after} == expected


def test_run_gives_the_last_stage(spark, sf_dir, staged):
    assert sorted(map(tuple, p.run(spark, sf_dir).collect())) == sorted(map(tuple, staged[-1][2]))


def test_odd_rows_and_an_empty_table(spark, folder):
    docs = clashing(odd_documents(spark, ["The same words over and over again.", "Different words, once."]),
                    "score", "made", "print", "component_id", "n_hit", "row", "secrets", "ids", "c1")
    for frame, name in ((docs, "odd"), (docs.limit(0), "none")):
        frame.write.parquet(f"{folder}/{name}/documents.parquet")
        spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/{name}/labels.parquet")
        spark.createDataFrame([(1, "some item")], "item_id bigint, text string").write.parquet(f"{folder}/{name}/benchmark.parquet")
    rows = p.run(spark, f"{folder}/odd").collect()
    # one of the row that is there twice, one of the null, empty and blank texts
    assert sorted(str(r.doc_id) for r in rows) == ["0", "1", "2", "5", "None"] and p.run(spark, f"{folder}/none").count() == 0
    assert re.fullmatch("[0-9a-f]{64}", rows[0].ids_sha256) and public_tokenizers.path("byte_bpe_50k.json")


def test_a_run_keeps_its_last_stage_alone(spark, sf_dir, folder):
    from tidebars import session

    token = session._RUN.set(f"{folder}/scratch")
    try:
        rows = p.run(spark, sf_dir).count()
        left = os.listdir(f"{folder}/scratch")
    finally:
        session._RUN.reset(token)
    assert rows and len(left) == 1 and left[0].startswith("pipeline-token_ids")
