"""Language identification by a string kernel.

A text is the set of its letter n-grams of one to three letters (lower case; whatever is not a letter separates words). The
blended-spectrum presence kernel of two texts is the number of n-grams that both have, over the root of the product of what
each has. Kernel values against landmark texts stand for a text (Nyström), and one ridge regression for each language on those
values gives its score. All of it is linear in the presence of the landmarks' n-grams, so a batch of texts is scored by one
product of a presence matrix and a weight matrix.

The sample is drawn in one pass and written; landmarks and kernel values come from that small table. With more languages than
landmarks the weights stay two factors (by term and landmark, by landmark and language), so what tasks hold grows with neither
texts nor the product of terms and languages.

A null text, or one without a letter, is ``und`` with score 0 and teaches nothing. Repeated rows count as often as they occur.
Texts that tie take the language that sorts first. Without anything to learn from, all texts are ``und``.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidebars.llm.frames import held_out, pick, prepare, settle, with_results
from tidebars.session import small_frame

#: Texts learnt from, and landmarks, about, over all languages; both are shared out evenly and chosen by a hash of text and id.
SAMPLE, LANDMARKS = 3_000, 96
#: Texts of each language that are learnt from however many languages there are, or all where it has fewer.
LEAST = 20
RIDGE = 1e-3
#: Texts scored by one product.
BATCH = 128
#: N-grams of the landmarks that the model knows; of more, those that most landmarks have.
MOST_TERMS = 200_000
#: Cells of a presence matrix.
_CELLS = 1 << 24
UNKNOWN = "und"

_RESULT = "struct<lang_pred: string, score: double>"
_BITS = np.uint64(21)
_TWO, _ONE = np.uint64(1 << 63), np.uint64(3 << 62)


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _distinct(ordered: np.ndarray) -> np.ndarray:
    return ordered[np.concatenate(([True], ordered[1:] != ordered[:-1]))] if len(ordered) else ordered


def grams(text: str | None) -> np.ndarray:
    """The distinct n-grams of a text as sorted numbers; none without a letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le"), dtype="<u4")
    letter = _letters()[points]
    if not letter.any():
        return np.zeros(0, dtype=np.uint64)
    points = np.where(letter, points, 32)
    keep = letter | np.concatenate(([False], letter[:-1]))  # one space for each gap
    points = np.concatenate(([32], points[keep], [32][: int(letter[-1])], [0, 0])).astype(np.uint64)
    three = np.sort(points[:-2] << (_BITS * np.uint64(2)) | points[1:-1] << _BITS | points[2:])
    three = _distinct(three)
    two = _distinct(three >> _BITS)
    one = _distinct(two >> _BITS)
    zero = np.uint64((1 << 21) - 1)
    three = three[three & zero != 0]
    two = two[(two & zero != 0) & (two >> _BITS != 0)]
    return np.concatenate((three, two | _TWO, one[one != 0] | _ONE))


@dataclass
class LanguageModel:
    """``terms``: the landmarks' n-grams, sorted; ``weights``: a row for each, a column for each language, or for each landmark
    where ``mix`` has a row for each landmark and a column for each language."""

    languages: list[str]
    terms: np.ndarray
    weights: np.ndarray
    mix: np.ndarray | None = None

    def scores(self, found: list[np.ndarray]) -> np.ndarray:
        """A row for each set of n-grams."""
        step, out = max(1, _CELLS // max(1, len(self.terms))), []
        for at in range(0, len(found), step):
            present = np.zeros((len(found[at : at + step]), len(self.terms)), dtype=np.float32)
            for row, own in zip(present, found[at : at + step]):
                row[_places(self.terms, own)] = 1
            product = present @ self.weights
            out.append(product if self.mix is None else product @ self.mix)
        sizes = np.array([max(1, len(own)) for own in found])
        return np.concatenate(out) / np.sqrt(sizes)[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        found = [grams(t) for t in texts]
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        scores = self.scores(found)
        best = scores.argmax(axis=1)
        top = np.clip(scores[np.arange(len(best)), best], 0, 1)
        known = [len(own) > 0 for own in found]
        return ([self.languages[b] if k else UNKNOWN for b, k in zip(best, known)],
                [float(t) if k else 0.0 for t, k in zip(top, known)])


def _places(terms: np.ndarray, own: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(terms, own), len(terms) - 1)
    return at[terms[at] == own]


def _kernel(terms: np.ndarray, marks: np.ndarray, sizes: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Kernel values of a set against the landmarks; ``marks``: presence by term and landmark."""
    return marks[_places(terms, own)].sum(axis=0, dtype=np.float64) / np.sqrt(max(1, len(own)) * sizes)


def _draw(rows: DataFrame, sample: int, landmarks: int) -> DataFrame | None:
    """(lang, text, rank, mark): about ``sample`` rows, as many of each language where there are enough, or ``LEAST`` of each, and
    about ``landmarks`` rows marked, both by a hash. ``rank`` is by hash within a language."""
    counts = rows.groupBy("lang").count().collect()  # a row for each language
    if not counts:
        return None
    each = max(1.0, sample / len(counts))
    told = each if each >= 3 * LEAST else 3.0 * LEAST  # so many by hash that hardly ever fewer than LEAST are there
    span = 1 << 50
    shares = small_frame(rows.sparkSession, [
        (r["lang"], int(min(1.0, told / r["count"]) * span), int(min(1.0, landmarks / len(counts) / r["count"]) * span)) for r in counts
    ], "name string, told long, marks long")
    place = F.pmod("hash", F.lit(span))
    drawn = rows.join(shares, F.col("lang") == F.col("name")).filter((place < F.col("told")) | (place < F.col("marks")))
    drawn = settle(drawn.select("lang", "text", "hash", (place < F.col("told")).alias("told"), (place < F.col("marks")).alias("mark")), "language-sample")
    if each < 3 * LEAST:
        few = Window.partitionBy("lang").orderBy("hash")  # over the drawn rows, of which a language has about 3 * LEAST
        return drawn.withColumn("told", F.row_number().over(few) <= max(LEAST, int(each)))
    return drawn


def _gram_rows(batches):
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            own = grams(text.as_py())
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()]), pa.array([own.tobytes()], pa.binary())], names=["lang", "grams"])


def fit_languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE,
                  landmarks: int = LANDMARKS) -> LanguageModel:
    """Learn from the texts with a language that are not held out, ``sample`` of them at most, about, or ``LEAST`` of each language."""
    prepare(docs.sparkSession)
    rows = pick(docs, doc_id, text, lang).toDF("id", "text", "lang").filter("lang IS NOT NULL").filter(F.col("text").rlike(r"\p{L}"))
    rows = rows.filter(~held_out(F.col("id"))).select("lang", "text", F.xxhash64("id", "text").alias("hash"))
    drawn = _draw(rows, sample, landmarks)
    if drawn is None:
        return LanguageModel([], np.zeros(0, np.uint64), np.zeros((0, 0), np.float32))
    schema = "lang string, grams binary"
    marked = drawn.filter("mark").select("lang", "text").mapInArrow(_gram_rows, schema).collect()
    sets = sorted((r["lang"], bytes(r["grams"])) for r in marked)
    sets = [np.frombuffer(g, dtype=np.uint64) for _, g in dict.fromkeys(sets)]
    if not sets:
        return LanguageModel([], np.zeros(0, np.uint64), np.zeros((0, 0), np.float32))
    terms, shared = np.unique(np.concatenate(sets), return_counts=True)
    if len(terms) > MOST_TERMS:
        terms = np.sort(terms[np.lexsort((terms, -shared))[:MOST_TERMS]])
    marks = np.zeros((len(terms), len(sets)), dtype=np.float32)
    for column, own in enumerate(sets):
        marks[np.searchsorted(terms, own[np.isin(own, terms)]), column] = 1
    sizes = np.maximum(1, marks.sum(axis=0, dtype=np.float64))
    sent = docs.sparkSession.sparkContext.broadcast((terms, marks, sizes))

    def kernel_rows(batches):
        for batch in batches:
            for name, text_ in zip(batch.column(0), batch.column(1)):
                own = grams(text_.as_py())
                if len(own):
                    values = _kernel(*sent.value, own)
                    yield pa.RecordBatch.from_arrays([pa.array([name.as_py()]), pa.array([values.tolist()])], names=["lang", "values"])

    told = drawn.filter("told").select("lang", "text").mapInArrow(kernel_rows, "lang string, values array<double>").collect()
    told = sorted((r["lang"], tuple(r["values"])) for r in told)
    languages = sorted({t[0] for t in told})
    values = np.array([t[1] for t in told])
    place = {name: i for i, name in enumerate(languages)}
    numbers = np.array([place[t[0]] for t in told])
    weight = (1 / np.bincount(numbers))[numbers]  # each language weighs as much
    target = np.zeros((values.shape[1], len(languages)))
    np.add.at(target.T, numbers, values * weight[:, None])
    among = (marks.T.astype(np.float64) @ marks) / np.sqrt(np.outer(sizes, sizes))
    left = values.T @ (values * weight[:, None]) + RIDGE * len(languages) * among
    left += 1e-9 * np.trace(left) / len(left) * np.eye(len(left))
    solved = np.linalg.solve(left, target)
    solved = solved / np.sqrt(sizes)[:, None]
    if len(languages) > len(sets):
        return LanguageModel(languages, terms, marks, solved.astype(np.float32))
    return LanguageModel(languages, terms, (marks @ solved).astype(np.float32))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1)."""
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf(_RESULT)
    def predict(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        for at in range(0, len(texts), BATCH):
            own = sent.value.predict(texts[at : at + BATCH].to_pylist())
            names += own[0]
            scores += own[1]
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    return with_results(docs, [text], lambda t: predict(t), ["lang_pred", "score"])
