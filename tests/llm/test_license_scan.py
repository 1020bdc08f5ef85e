import random

import numpy as np
from cases import clashing, odd_documents
from test_decontamination import plain_words

from tidebars.llm import license_scan as ls


def brute(text, templates=ls.TEMPLATES, contained=ls.CONTAINED):
    words, out = plain_words(text), set()
    for number, (name, body) in enumerate((n, b) for n, b in templates if plain_words(b)):
        t = plain_words(body)
        size = min(5, len(t))
        own = {tuple(t[i : i + size]) for i in range(len(t) - size + 1)}
        step = 1
        while step < len(own):
            step *= 2
        shingles = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
        for start in range(0, len(shingles), step):
            if len(set(shingles[start : start + (2 * step if step > 1 else 1)]) & own) >= contained * len(own):
                out.add((name, number))
    return out


def noisy(text, rng, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = rng.choice(["foo", "bar", "the"])
    return " ".join(words)


def texts(seed=2):
    rng = random.Random(seed)
    filler = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do".split()
    out = ["Released under the MIT License", "licensed UNDER cc by-nc 4.0!", "nothing to see", "the License the License the License the License"]
    for _, body in ls.TEMPLATES:
        for changes in (0, 1, 2, 5):
            before, after = (" ".join(rng.choices(filler, k=rng.randrange(90))) for _ in range(2))
            out.append(f"{before} {noisy(body, rng, changes)} {after}")
    return out


def test_against_brute_force(spark):
    docs = clashing(odd_documents(spark, texts()), "matches", "Licenses", "license")
    found = ls.find_licenses(docs).collect()
    for row in found:
        expected = brute(row.text)
        assert {(m.license, m.template) for m in row.matches} == expected, row.text
        assert row.licenses == sorted({n for n, _ in expected})
        for m in row.matches:
            assert m.contained >= ls.CONTAINED and 0 <= m.first <= m.last < len(plain_words(row.text))
    assert sum(len(r.licenses) > 0 for r in found) >= 20
    assert ls.find_licenses(docs.limit(0)).count() == 0


def test_own_templates_and_none(spark):
    templates = spark.createDataFrame([("A", "one two"), ("B", None), (None, "three four"), ("C", ""), ("A", "all rights reserved worldwide by us")],
                                      "license string, text string")
    docs = odd_documents(spark, ["so one two three", "ALL rights, reserved worldwide by us", "one"])
    assert {r.doc_id: r.licenses for r in ls.find_licenses(docs, templates).collect() if r.licenses} == {0: ["A"], 1: ["A"]}
    assert {tuple(r.licenses) for r in ls.find_licenses(docs, templates.limit(0)).collect()} == {()}


def test_templates_in_several_blocks(spark):
    rng = random.Random(2)
    own = [(f"L{i % 40:02}", " ".join(rng.choices([f"w{k}" for k in range(30)], k=rng.randrange(1, 30)))) for i in range(60)]
    templates = spark.createDataFrame([*own, own[0], ("N", None), (None, "w1")], "license string, text string")
    docs = clashing(odd_documents(spark, [" ".join(t for _, t in rng.sample(own, 3)) for _ in range(40)]), "matches", "Licenses")
    by_text = lambda df: sorted((r.doc_id or -1, r.text or "", r.licenses, [(m.license, m.first, m.last, m.contained) for m in sorted(
        r.matches, key=lambda m: (m.license, m.first, m.last, m.contained))]) for r in df.collect())
    one, many = ls.find_licenses(docs, templates), ls.find_licenses(docs, templates, block_bytes=700)
    assert by_text(one) == by_text(many) and sum(len(r.matches) > 2 for r in many.collect()) >= 40
    for r in many.collect():
        assert [(m.license, m.template) for m in r.matches] == sorted((m.license, m.template) for m in r.matches)
    number = {}
    for m in (m for r in many.collect() for m in r.matches):
        assert number.setdefault(m.template, m.license) == m.license and m.template < 60


def test_rights_reserved_line(spark, sf_dir):
    docs = odd_documents(spark, ["some words. ALL rights\nreserved", "all rights are reserved", "Released under the MIT License. All rights reserved."])
    found = {r.doc_id: r.licenses for r in ls.find_licenses(docs).collect() if r.licenses}
    assert found == {0: ["LicenseRef-All-Rights-Reserved"], 2: ["LicenseRef-All-Rights-Reserved", "MIT"]}
    planted = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("text LIKE '%All rights reserved.%'")
    assert all(r.licenses for r in ls.find_licenses(planted).collect())


def test_bands_keep_their_promise():
    for t, s in ((2, 2), (3, 4), (8, 8), (17, 32), (60, 64)):
        least = 0.8 * t / (2 * s + 0.2 * t)
        assert (1 - least) ** ls.bands(t, s) <= ls.MISS
    assert ls.bands(1, 1) == 1


def test_stretches_meet(monkeypatch):
    index = ls.TemplateIndex([(n, b.encode()) for n, b in ls.TEMPLATES])
    rng = np.random.default_rng(5)
    body = " ".join(texts(7) * 3 + [f"w{i}" for i in rng.integers(0, 50, 3000)]).encode()
    whole = index.find(body)
    monkeypatch.setattr(ls, "_STRETCH", 256)
    assert index.find(body) == whole and whole
