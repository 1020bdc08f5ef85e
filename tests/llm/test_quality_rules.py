import math
import random
import zlib

import pyarrow as pa
import pytest
from cases import clashing, odd_documents

from tidebars.llm import quality as q


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def corpus(spark, n=400):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) for _ in range(rng.randrange(20, 60))]
        good = i % 4 != 0
        rows.append((i, " ".join(words) + "." if good else " ".join(w.upper() + "!!" for w in words)))
        labels.append((i, int(good)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int")


@pytest.fixture(scope="module")
def learnt(spark):
    docs, labels = corpus(spark)
    return docs, labels, q.fit_rules(docs, labels)


def by_hand(model, text):
    values = q.statistics(None if text is None else text.encode())
    total = model.constant + sum(w for rule, w in model.weights.items() if all(low < values[n] <= high for n, low, high in rule))
    return 1 / (1 + math.exp(-total))


def test_scores_are_the_rules(spark, learnt):
    docs, _, model = learnt
    assert model.weights and model.text().count("\n") == len(model.weights)
    odd = clashing(odd_documents(spark, ["All is well here.", "SHOUT!! SHOUT!!"]), "score", "Predicted", "made")
    for row in q.score(odd, model).collect():
        assert row.score == pytest.approx(by_hand(model, row.text), abs=1e-9)
        assert row.predicted == int(row.score >= 0.5)


def test_held_out_accuracy(learnt):
    docs, labels, model = learnt
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in q.score(docs, model).collect() if is_held_out(r.doc_id)]
    assert len(rows) > 50 and all(r.predicted == truth[r.doc_id] for r in rows)
    assert {r.doc_id for r in q.keep_good(docs, model).collect()} == {i for i, v in truth.items() if v}


def test_held_out_labels_teach_nothing(spark, learnt):
    docs, labels, model = learnt
    turned = labels.rdd.map(lambda r: (r[0], 1 - r[1]) if zlib.crc32(str(r[0]).encode()) % 3 == 1 else (r[0], r[1]))
    assert q.fit_rules(docs, spark.createDataFrame(turned, labels.schema)) == model


def test_one_class_no_labels_no_documents(spark, learnt):
    docs, labels, model = learnt
    ones = q.fit_rules(docs, labels.filter("quality = 1"))
    assert not ones.weights and ones.constant > 0
    none = q.fit_rules(docs, labels.limit(0))
    assert not none.weights and none.constant == 0
    assert q.fit_rules(docs.limit(0), labels).constant == 0
    assert q.score(docs.limit(0), model).count() == 0
    odd = spark.createDataFrame([(1, None), (None, 1), (3, 0), (3, 1), (10**9, 1)], "doc_id bigint, quality int")
    assert not q.fit_rules(docs, odd).weights


def test_bound_thins_the_sample(spark, learnt):
    docs, labels, _ = learnt
    assert 20 < q._sample(docs, labels, "doc_id", "text", "quality", 60).count() < 110


def test_statistics_are_taken_of_labelled_texts_alone(spark, learnt, monkeypatch):
    docs, labels, _ = learnt
    seen, own = spark.sparkContext.accumulator(0), q._statistics

    def counted(texts: pa.Array) -> pa.Array:
        seen.add(len(texts))
        return own(texts)

    monkeypatch.setattr(q, "_statistics", counted)
    told = sum(not is_held_out(i) for i in range(40))
    assert q._sample(docs, labels.filter("doc_id < 40"), "doc_id", "text", "quality", 30_000).count() == told
    assert told <= seen.value <= 2 * told  # once more for the ranges of the sort


def test_paths_of_a_tree():
    tree = "x\n  If (feature 0 <= 1.5)\n   If (feature 2 <= 0.25)\n    Predict: 0.0\n   Else (feature 2 > 0.25)\n    Predict: 1.0\n  Else (feature 0 > 1.5)\n   Predict: 1.0\n"
    inf = math.inf
    assert q.rules_of(tree) == {((0, -inf, 1.5),), ((0, 1.5, inf),), ((0, -inf, 1.5), (2, -inf, 0.25)), ((0, -inf, 1.5), (2, 0.25, inf))}


def test_registered_query(spark, sf_dir):
    from tidebars.llm.queries import QUERIES

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES["op2_quality"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == is_held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    told = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in told) >= 0.9 * len(told)
