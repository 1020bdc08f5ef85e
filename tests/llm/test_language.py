import math
import random

import numpy as np
import pytest
from cases import clashing, odd_documents
from test_quality_rules import is_held_out

from tidebars.llm import language as lg

SYLLABLES = {"aa": "ka to mi ra ne", "bb": "sch ung heit ver öl", "cc": "éau oui çon le qu"}


def brute_grams(text):
    out, runs = set(), "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    if not runs:
        return out
    flat = " " + " ".join(runs) + " "
    for n in (1, 2, 3):
        out |= {flat[i : i + n] for i in range(len(flat) - n + 1)}
    return out


def decoded(codes):
    out = set()
    for c in codes.tolist():
        if c >> 62 == 3:
            out.add(chr(c & ((1 << 21) - 1)))
        elif c >> 63:
            c &= (1 << 63) - 1
            out.add("".join(chr(c >> s & ((1 << 21) - 1)) for s in (21, 0)))
        else:
            out.add("".join(chr(c >> s & ((1 << 21) - 1)) for s in (42, 21, 0)))
    return out


@pytest.mark.parametrize("text", ["Hello, world", "a", "", None, " .. ", "42", "Été à la mer 12 fois!", "x-y", "İstanbul 日本 語", "aa " * 500])
def test_grams_against_brute_force(text):
    found = lg.grams(text)
    assert len(found) == len(set(found.tolist())) and (np.sort(found) == found).all()
    assert decoded(found) == brute_grams(text)


def corpus(spark, n=240):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        name = list(SYLLABLES)[i % 3]
        words = ["".join(rng.choices(SYLLABLES[name].split(), k=rng.randrange(1, 4))) for _ in range(rng.randrange(5, 40))]
        rows.append((i, " ".join(words), name))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


@pytest.fixture(scope="module")
def learnt(spark):
    docs = corpus(spark)
    return docs, lg.fit_languages(docs, landmarks=30, sample=90)


def test_held_out_accuracy_and_batches(learnt):
    docs, model = learnt
    rows = lg.identify(docs, model).collect()
    assert all(r.lang_pred == r.lang for r in rows if is_held_out(r.doc_id))
    one_by_one = [model.predict([r.text]) for r in rows]
    assert [r.lang_pred for r in rows] == [p[0][0] for p in one_by_one]
    assert all(math.isclose(r.score, p[1][0], abs_tol=1e-5) and 0 <= r.score <= 1 for r, p in zip(rows, one_by_one))


def test_scores_are_kernel_values_times_weights(spark):
    """The one matrix product equals the ridge regression on kernel values, taken the long way."""
    docs = corpus(spark, 60)
    model = lg.fit_languages(docs, landmarks=10**6, sample=10**6)
    own = [(r.text, r.lang) for r in docs.orderBy("doc_id").collect() if not is_held_out(r.doc_id)]
    marks = [brute_grams(t) for t in sorted({t for t, _ in own})]
    kernel = lambda a, b: len(a & b) / math.sqrt(len(a) * len(b))
    k = np.array([[kernel(brute_grams(t), m) for m in marks] for t, _ in own])
    among = np.array([[kernel(a, b) for b in marks] for a in marks])
    y = np.array([[lang == name for name in model.languages] for _, lang in own], dtype=float)
    w = (1 / y.sum(axis=0))[y.argmax(axis=1)]
    left = k.T @ (k * w[:, None]) + lg.RIDGE * len(model.languages) * among
    left += 1e-9 * np.trace(left) / len(left) * np.eye(len(left))
    expected = k @ np.linalg.solve(left, k.T @ (y * w[:, None]))
    assert model.scores([lg.grams(t) for t, _ in own]) == pytest.approx(expected, abs=2e-3)


def test_every_one_of_many_languages_is_learnt(spark):
    rows = [(100 * k + i, "word" if k < 300 or not i else "12 34", f"l{k}") for k in range(301) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = {f"l{k}" for k in range(301) if not is_held_out(100 * k)} | {f"l{k}" for k in range(300)}
    assert set(lg.fit_languages(docs, sample=300).languages) == kept


def test_more_languages_than_landmarks_stay_small(spark):
    """No number of languages is refused, and the weights are factors of the landmarks' size."""
    rng = random.Random(4)
    word = {k: "".join(rng.choices("abcdefghijklmnopqrstuvwxyzäöüéèñçøåß", k=7)) for k in range(2_100)}
    rows = [(3 * k + i, f"{word[k]} {word[k]}{i}", f"l{k:04}") for k in word for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = lg.fit_languages(docs)
    learnt = {r[2] for r in rows if not is_held_out(r[0])}
    assert set(model.languages) == learnt and len(learnt) > 2_000
    assert model.weights.shape[1] == len(model.mix) < 200 and model.mix.shape[1] == len(model.languages)
    found = [lg.grams(r[1]) for r in rows[:300]]
    assert model.scores(found) == pytest.approx(lg.LanguageModel(model.languages, model.terms, model.weights @ model.mix).scores(found), abs=1e-4)
    assert lg.identify(docs.limit(20), model).filter("score BETWEEN 0 AND 1").count() == 20


def test_bounded_terms_and_products_in_pieces(spark, learnt, monkeypatch):
    docs, model = learnt
    texts = [lg.grams(r.text) for r in docs.limit(50).collect()]
    whole = model.scores(texts)
    monkeypatch.setattr(lg, "_CELLS", 3 * len(model.terms))
    assert model.scores(texts) == pytest.approx(whole, abs=1e-6)
    monkeypatch.setattr(lg, "MOST_TERMS", 60)
    few = lg.fit_languages(docs, landmarks=30, sample=90)
    assert len(few.terms) == 60
    rows = lg.identify(docs, few).collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.95 * len(rows)


def test_odd_rows(spark, learnt):
    docs = clashing(odd_documents(spark, ["ka to mi", "123 !!", "schungheit"]), "lang_pred", "Score", "LANG_")
    rows = {(r.doc_id, r.text): r for r in lg.identify(docs, learnt[1]).collect()}
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in rows.values())
    assert rows[0, "ka to mi"].lang_pred == "aa" and rows[2, "schungheit"].lang_pred == "bb"
    assert lg.identify(docs.limit(0), learnt[1]).count() == 0


def test_nothing_to_learn(spark, learnt):
    model = lg.fit_languages(learnt[0].limit(0))
    assert {(r.lang_pred, r.score) for r in lg.identify(learnt[0], model).collect()} == {("und", 0.0)}
    blank = spark.createDataFrame([(0, "12", "aa"), (2, None, "bb")], learnt[0].schema)
    assert lg.fit_languages(blank).languages == []


def test_registered_query(spark, sf_dir):
    from tidebars.llm.queries import QUERIES

    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op3_language"](spark, sf_dir).collect()
    assert len(rows) == len(truth)
    told = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in told) >= 0.95 * len(told)
