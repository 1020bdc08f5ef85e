"""Quality classifier: a sparse ensemble of rules over text statistics, scored as one Spark column.

Shallow trees are grown on labelled documents, each path from a root to a node is a rule (a conjunction of comparisons of
statistics), a logistic regression with a lasso penalty weighs the rules, and those that keep a weight are compiled into a
column expression. Scoring is then one pass that takes statistics and evaluates the expression.

Null and empty texts have the statistics 0 and are scored like any other. Labels that are null, or whose document is missing
or held out, teach nothing; several labels of one id count as their mean, rounded up. With no or only one class to learn from,
the score is the smoothed share of label 1 for every text.
"""

from __future__ import annotations

import operator
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidebars.llm.frames import beside, held_out, pick, prepare, restore, settle, with_results

#: Labelled rows that are learnt from, about; more are thinned by a hash of their id.
SAMPLE = 30_000
TREES, DEPTH, LASSO, SEED = 24, 3, 0.0004, 11
#: Tasks that a round over the sample, which is bounded, takes.
_TASKS = 6

STATISTICS = (
    "chars", "words", "word_length", "longest_word", "upper", "digits", "symbols", "bars", "exclaims", "commas", "stops", "non_ascii",
    "lines", "line_repeats", "distinct_words", "top_word", "word_repeats", "words_per_line",
)
_SPACE = [9, 10, 11, 12, 13, 32]
_SYMBOLS = [ord(c) for c in "#$%&*@^~<>{}[]=+_/\\"]


def statistics(data: bytes | None) -> tuple[float, ...]:
    """The ``STATISTICS`` of a UTF-8 text: shares are of bytes, words, or lines."""
    if not data:
        return (0.0,) * len(STATISTICS)
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    n = len(data)
    words = data.lower().split()
    lines = data.split(b"\n")
    kept = max(1, len(words))
    letters = max(1, int(counts[65:91].sum() + counts[97:123].sum()))
    return (
        float(n), float(len(words)), (n - counts[_SPACE].sum()) / kept, float(max(map(len, words), default=0)),
        counts[65:91].sum() / letters, counts[48:58].sum() / n, counts[_SYMBOLS].sum() / n, counts[ord("|")] / kept,
        counts[ord("!")] / kept, counts[ord(",")] / kept, counts[ord(".")] / kept, counts[128:].sum() / n,
        float(len(lines)), 1 - len(set(lines)) / len(lines), len(set(words)) / kept,
        max(Counter(words).values(), default=0) / kept, sum(map(operator.eq, words, words[1:])) / kept, len(words) / len(lines),
    )


def _statistics(texts: pa.Array) -> pa.Array:
    rows = np.array([statistics(t.as_py()) for t in texts], dtype=float).reshape(-1, len(STATISTICS))
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], names=list(STATISTICS))


def statistics_column(text: Column) -> Column:
    made = F.arrow_udf(_statistics, "struct<" + ", ".join(f"{s}: double" for s in STATISTICS) + ">")
    return made(text.cast("binary"))


#: A rule: for some statistics, by number, the least value (not included) and the greatest.
Rule = tuple[tuple[int, float, float], ...]


def rules_of(tree: str) -> set[Rule]:
    """The paths to all nodes but the root, from the printed form of a tree."""
    found, path = set(), []
    for line in tree.splitlines():
        step = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not step:
            continue
        depth, number, sign, value = len(step[1]), int(step[2]), step[3], float(step[4])
        path = [p for p in path if p[0] < depth] + [(depth, number, sign, value)]
        bounds: dict[int, tuple[float, float]] = {}
        for _, n, s, v in path:
            low, high = bounds.get(n, (-np.inf, np.inf))
            bounds[n] = (max(low, v), high) if s == ">" else (low, min(high, v))
        found.add(tuple((n, *bounds[n]) for n in sorted(bounds)))
    return found


def rule_column(rule: Rule, made: Column) -> Column:
    """1 where the statistics in the struct ``made`` satisfy the rule, else 0."""
    held = F.lit(True)
    for number, low, high in rule:
        value = made[STATISTICS[number]]
        if low > -np.inf:
            held = held & (value > low)
        if high < np.inf:
            held = held & (value <= high)
    return held.cast("double")


@dataclass
class QualityRules:
    """Weighted rules; ``text`` prints them."""

    constant: float
    weights: dict[Rule, float] = field(default_factory=dict)

    def score_column(self, made: Column) -> Column:
        total = F.lit(self.constant)
        for rule, weight in self.weights.items():
            total = total + rule_column(rule, made) * weight
        return 1 / (1 + F.exp(-total))

    def text(self) -> str:
        def one(rule):
            return " AND ".join(
                f"{'' if low == -np.inf else f'{low:.6g} < '}{STATISTICS[n]}{'' if high == np.inf else f' <= {high:.6g}'}" for n, low, high in rule)

        return "\n".join([f"{self.constant:+.4f}", *(f"{w:+.4f} {one(r)}" for r, w in self.weights.items())])


def _sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, bound: int) -> DataFrame:
    known = pick(labels, doc_id, label).toDF("id", "label").filter("id IS NOT NULL AND label IS NOT NULL").filter(~held_out(F.col("id")))
    known = known.groupBy("id").agg((F.avg("label") >= 0.5).cast("double").alias("label"))
    total = known.count()
    rows = pick(docs, doc_id, text).toDF("id", "text").filter("id IS NOT NULL").filter(~held_out(F.col("id")))
    if total > bound:
        share = int(bound / total * (1 << 30))
        known, rows = (x.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share) for x in (known, rows))
    # The written labels are bounded by ``bound``; by that size Spark sends them to the texts, and statistics are taken of
    # labelled texts alone, also where few are labelled.
    rows = rows.join(settle(known, "quality-labels"), "id").withColumn("made", statistics_column(F.col("text")))
    return settle(rows.select("id", "label", "made.*").sort("id", *STATISTICS), "quality-sample").coalesce(_TASKS)


def fit_rules(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
              bound: int = SAMPLE) -> QualityRules:
    """Learn from the labelled documents that are not held out; ``bound`` is about how many are learnt from."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import array_to_vector

    prepare(docs.sparkSession)
    sample = _sample(docs, labels, doc_id, text, label, bound)
    n, ones = sample.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < ones < n:
        return QualityRules(float(np.log((ones + 1) / (n - ones + 1))))
    told = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(sample)
    forest = RandomForestClassifier(labelCol="label", numTrees=TREES, maxDepth=DEPTH, maxBins=64, subsamplingRate=0.7,
                                    featureSubsetStrategy="onethird", minInstancesPerNode=5, seed=SEED).fit(told)
    rules = sorted(set().union(*(rules_of(t.toDebugString) for t in forest.trees)))
    if not rules:
        return QualityRules(float(np.log((ones + 1) / (n - ones + 1))))
    made = F.struct(*STATISTICS)
    held = sample.select("label", array_to_vector(F.array(*(rule_column(r, made) for r in rules))).alias("features")).persist()
    lasso = LogisticRegression(labelCol="label", elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=60, tol=1e-6)
    model = lasso.fit(held)
    held.unpersist()
    weights = {r: float(w) for r, w in zip(rules, model.coefficients.toArray()) if w}
    return QualityRules(float(model.intercept), weights)


def score(docs: DataFrame, model: QualityRules, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 is likelier) and ``predicted`` (1 from 0.5 on)."""
    prepare(docs.sparkSession)

    scored = with_results(docs, [text], lambda t: F.struct(statistics_column(t).alias("score")), ["score"])
    scored = with_results(scored, ["score"], lambda made: F.struct(model.score_column(made).alias("score")), ["score"])
    return with_results(scored, ["score"], lambda s: F.struct((s >= 0.5).cast("int").alias("predicted")), ["predicted"])


def keep_good(docs: DataFrame, model: QualityRules, text: str = "text") -> DataFrame:
    """The documents that score 0.5 or more."""
    prepare(docs.sparkSession)
    flat = beside(docs, [text], statistics_column)
    return restore(flat.filter(model.score_column(F.col("made")) >= 0.5), docs.columns)
