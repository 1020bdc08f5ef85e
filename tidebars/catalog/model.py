"""Checked queries over the next-state model.

The fit itself is iterative, so only its first-round sums have SQL; the scoring is checked on weights
given by a rule.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidebars.catalog import fixtures as fx
from tidebars.catalog.registry import query
from tidebars.catalog.windows import FEATURES, state_features
from tidebars.operators import states as st
from tidebars.operators import transitions as tr
from tidebars.operators.runs import symbol_sizes
from tidebars.schema import FEATURE_COLS
from tidebars.session import Rounds

COMPLETE = "ret_lag_20 IS NOT NULL AND target_state IS NOT NULL"


@query("m01_training_rows", f'SELECT symbol, "timestamp", {FEATURES}, target_state FROM features WHERE {COMPLETE}', uses="features")
def training(spark, sf_dir):
    return st.training_rows(state_features(spark, sf_dir)).select("symbol", "timestamp", *FEATURE_COLS, "target_state")


@query("a10_class_list", f"""SELECT symbol, string_agg(DISTINCT target_state, '|' ORDER BY target_state) AS classes
FROM features WHERE {COMPLETE} GROUP BY symbol""", uses="features")
def class_list(spark, sf_dir):
    classes = tr.classes_per_symbol(state_features(spark, sf_dir))
    return classes.select("symbol", F.array_join("classes", "|").alias("classes"))


@query("m02_label_codes", f"""SELECT symbol, "timestamp", target_state,
       dense_rank() OVER (PARTITION BY symbol ORDER BY target_state) - 1 AS label FROM features WHERE {COMPLETE}""", uses="features")
def label_codes(spark, sf_dir):
    return tr.label_codes(state_features(spark, sf_dir)).withColumn("label", F.col("label").cast("bigint"))


_X = [*FEATURE_COLS, "1.0"]
_SUMS = ["sum(ln(2.0::DOUBLE))"] + [f"sum(-y * 0.5::DOUBLE * {x})" for x in _X] + [
    f"sum(0.25::DOUBLE * {_X[i]} * {_X[j]})" for i in range(len(_X)) for j in range(i, len(_X))
]
_NAMES = ["loss"] + [f"g{i}" for i in range(len(_X))] + [f"h{i}_{j}" for i in range(len(_X)) for j in range(i, len(_X))]


@query("m03_first_round_sums", f"""SELECT symbol, label, {", ".join(f"round({s}, 6) AS {n}" for s, n in zip(_SUMS, _NAMES))}
FROM (SELECT f.*, c.label, CASE WHEN f.target_state = c.label THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS y
      FROM (SELECT * FROM features WHERE {COMPLETE}) f
      JOIN (SELECT DISTINCT symbol, target_state AS label FROM features WHERE {COMPLETE}) c USING (symbol))
GROUP BY symbol, label""", uses="features")
def first_round_sums(spark, sf_dir):
    features = state_features(spark, sf_dir)
    start = tr.classes_per_symbol(features).select(
        "symbol", F.explode("classes").alias("label"), F.array(*[F.lit(0.0)] * tr.N_WEIGHTS).alias("w")
    )
    sums = tr.model_sums(st.training_rows(features), start)
    return sums.select("symbol", "label", *[F.round(F.col(n), 6).alias(n) for n in _NAMES])


_RULED = " + ".join(f"c.i * {k + 1} / 10.0::DOUBLE * {x}" for k, x in enumerate(_X))
_AT_WEIGHTS = ["sum(greatest(-m, 0.0) + ln(1.0::DOUBLE + exp(-abs(m))))"] + [f"sum(-y * miss * {x})" for x in _X] + [
    f"sum(miss * (1.0::DOUBLE - miss) * {_X[i]} * {_X[j]})" for i in range(len(_X)) for j in range(i, len(_X))
]


@query("m03_sums_at_weights", f"""SELECT symbol, label, {", ".join(f"round({s}, 6) AS {n}" for s, n in zip(_AT_WEIGHTS, _NAMES))}
FROM (SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(m)) AS miss FROM (
  SELECT f.*, c.label, CASE WHEN f.target_state = c.label THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS y, y * ({_RULED}) AS m
  FROM (SELECT * FROM features WHERE {COMPLETE}) f
  JOIN (SELECT symbol, target_state AS label, row_number() OVER (PARTITION BY symbol ORDER BY target_state) AS i
        FROM (SELECT DISTINCT symbol, target_state FROM features WHERE {COMPLETE})) c USING (symbol)))
GROUP BY symbol, label""", uses="features")
def sums_at_weights(spark, sf_dir):
    features = state_features(spark, sf_dir)
    ruled = ruled_models(features).select(
        "symbol", F.explode(F.arrays_zip(F.col("classes").alias("label"), F.col("weights").alias("w"))).alias("m")
    ).select("symbol", "m.label", "m.w")
    sums = tr.model_sums(st.training_rows(features), ruled)
    return sums.select("symbol", "label", *[F.round(F.col(n), 6).alias(n) for n in _NAMES])


def _per_label(models):
    """(symbol, label, w) of every fitted model; two classes have one, for the later class."""
    labels = F.when(F.size("classes") == 2, F.slice("classes", 2, 1)).otherwise(F.col("classes"))
    return models.select("symbol", F.explode(F.arrays_zip(labels.alias("label"), F.col("weights").alias("w"))).alias("m")).select(
        "symbol", "m.label", "m.w"
    )


_CLASSES = f"""SELECT symbol, target_state AS label, count(*) OVER (PARTITION BY symbol) AS k,
  row_number() OVER (PARTITION BY symbol ORDER BY target_state) AS i
  FROM (SELECT DISTINCT symbol, target_state FROM tick_features WHERE {COMPLETE})"""


@query("m03_fit_is_optimal", f"""SELECT symbol, label, {", ".join(f"0.0::DOUBLE AS g{i}" for i in range(len(_X)))}
FROM ({_CLASSES}) WHERE k > 2 OR (k = 2 AND i = 2)""", uses="tick_features")
def fit_is_optimal(spark, sf_dir):
    """The penalised gradient at the fitted weights; the objective is strictly convex, so zero proves the fit."""
    return _slopes(tick_features(spark, sf_dir))


def _slopes(features, group_rows=None):
    features, models = _fitted(features, group_rows)
    weights = _per_label(models)
    sums = tr.model_sums(st.training_rows(features), weights).join(weights, ["symbol", "label"])
    return sums.select("symbol", "label", *[
        F.abs(F.round(F.col(f"g{i}") + F.col("w")[i], 5)).alias(f"g{i}") for i in range(tr.N_WEIGHTS)
    ])


def tick_features(spark, sf_dir):
    bars = fx.tick_bars(spark, sf_dir)
    sizes = symbol_sizes(bars)
    labelled = st.with_states(bars, sizes).withColumnRenamed("new_state", "market_state")
    return st.lag_features(labelled, sizes=sizes)


def _fitted(features, group_rows=None):
    """Features and their models, each computed once and written: fit and scoring read both again and again. Rows of few
    long symbols come out of their windows in as many tasks as there are symbols; they are dealt anew."""
    features = Rounds(features.sparkSession, "features").write(features.repartition("symbol", "timestamp"))
    return features, Rounds(features.sparkSession, "models").write(tr.fit_transitions(features, group_rows))


@query("m05_row_sums", f"""SELECT c.symbol, c.label AS from_state, CASE WHEN s.symbol IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS total,
       c.k AS n FROM ({_CLASSES}) c LEFT JOIN (
  SELECT DISTINCT symbol, market_state FROM tick_features WHERE ret_lag_20 IS NOT NULL AND market_state IS NOT NULL) s
ON s.symbol = c.symbol AND s.market_state = c.label""", uses="tick_features")
def row_sums(spark, sf_dir):
    features, models = _fitted(tick_features(spark, sf_dir))
    probs = tr.transition_probs(features, models)
    return probs.groupBy("symbol", "from_state").agg(F.round(F.sum("prob"), 9).alias("total"), F.count("prob").alias("n"))


@query("m03_fitted_models", f"""SELECT f.symbol, 'ok' AS status, f.n, 0::BIGINT AS dropped, c.label FROM (
  SELECT symbol, count(*) AS n FROM features WHERE {COMPLETE} GROUP BY symbol) f JOIN (
  SELECT symbol, target_state AS label, count(*) OVER (PARTITION BY symbol) AS k,
         row_number() OVER (PARTITION BY symbol ORDER BY target_state) AS i
  FROM (SELECT DISTINCT symbol, target_state FROM features WHERE {COMPLETE})) c ON c.symbol = f.symbol
WHERE k > 2 OR (k = 2 AND i = 2)""", uses="features")
def fitted(spark, sf_dir):
    _, models = _fitted(state_features(spark, sf_dir))
    return models.join(_per_label(models), "symbol").select("symbol", "status", "n", "dropped", "label")


@query("m03_large_fit_is_optimal", f"""SELECT symbol, label, {", ".join(f"0.0::DOUBLE AS g{i}" for i in range(len(_X)))}
FROM ({_CLASSES}) WHERE k > 2 OR (k = 2 AND i = 2)""", uses="tick_features")
def large_fit_is_optimal(spark, sf_dir):
    """As ``m03_fit_is_optimal`` with a group limit so low that all symbols count as large."""
    return _slopes(tick_features(spark, sf_dir), group_rows=10)


def ruled_models(features):
    """Models with weights by a rule in place of a fit: class i (from 1), feature k (from 0)."""
    weight = lambda i: F.array(*[(i * (k + 1)).cast("double") / 10 for k in range(tr.N_WEIGHTS)])
    return tr.classes_per_symbol(features).select(
        "symbol", "classes", F.transform("classes", lambda c, i: weight(i + 1)).alias("weights"), F.lit("ok").alias("status")
    )


_Z = " + ".join(f"c.i * {k + 1} / 10.0::DOUBLE * {x}" for k, x in enumerate(_X))
_SCORED = f"""WITH classes AS (
  SELECT symbol, target_state AS to_state, row_number() OVER (PARTITION BY symbol ORDER BY target_state) AS i
  FROM (SELECT DISTINCT symbol, target_state FROM features WHERE {COMPLETE})), raw AS (
  SELECT f.symbol, f."timestamp", f.market_state AS from_state, c.to_state, 1.0::DOUBLE / (1.0::DOUBLE + exp(-({_Z}))) AS p
  FROM features f JOIN classes c ON f.symbol = c.symbol
  WHERE f.ret_lag_20 IS NOT NULL AND f.market_state IS NOT NULL), scored AS (
  SELECT *, p / sum(p) OVER (PARTITION BY symbol, "timestamp") AS prob FROM raw)"""


@query("m04_probabilities", f'FROM ({_SCORED} SELECT symbol, "timestamp", from_state, to_state, round(prob, 9) AS prob FROM scored)', uses="features")
def probabilities(spark, sf_dir):
    features = state_features(spark, sf_dir)
    scored = tr.state_probabilities(features, ruled_models(features))
    return scored.withColumn("prob", F.round("prob", 9))


@query("a09_grouped_means", f"""FROM ({_SCORED} SELECT symbol, from_state, to_state, round(avg(prob), 9) AS prob
FROM scored GROUP BY ALL)""", uses="features")
def grouped_means(spark, sf_dir):
    features = state_features(spark, sf_dir)
    scored = tr.state_probabilities(features, ruled_models(features))
    return scored.groupBy("symbol", "from_state", "to_state").agg(F.round(F.avg("prob"), 9).alias("prob"))


@query("j04_state_pairs", f"""FROM ({_SCORED} SELECT a.symbol, a.to_state AS from_state, b.to_state,
       coalesce(round(avg(s.prob), 9), 0.0) AS prob
FROM classes a JOIN classes b ON a.symbol = b.symbol
LEFT JOIN scored s ON s.symbol = a.symbol AND s.from_state = a.to_state AND s.to_state = b.to_state GROUP BY ALL)""", uses="features")
def state_pairs(spark, sf_dir):
    features = state_features(spark, sf_dir)
    return tr.transition_probs(features, ruled_models(features)).withColumn("prob", F.round("prob", 9))


@query("m05_transition_matrix", f"""SELECT a.symbol, a.label AS from_state, b.label AS to_state, s.symbol IS NULL AS never_current
FROM ({_CLASSES}) a JOIN ({_CLASSES}) b ON a.symbol = b.symbol LEFT JOIN (
  SELECT DISTINCT symbol, market_state FROM tick_features WHERE ret_lag_20 IS NOT NULL AND market_state IS NOT NULL) s
ON s.symbol = a.symbol AND s.market_state = a.label""", uses="tick_features")
def transition_matrix(spark, sf_dir):
    features, models = _fitted(tick_features(spark, sf_dir))
    probs = tr.transition_probs(features, models)
    return probs.select("symbol", "from_state", "to_state", (F.col("prob") == 0).alias("never_current"))


@query("m06_matrix_view", f"""FROM ({_SCORED}, cells AS (SELECT a.symbol, a.i AS line, b.i AS place, coalesce(round(avg(s.prob), 9), 0.0) AS prob
  FROM classes a JOIN classes b ON a.symbol = b.symbol
  LEFT JOIN scored s ON s.symbol = a.symbol AND s.from_state = a.to_state AND s.to_state = b.to_state GROUP BY ALL)
SELECT c.symbol, n.states, c.line, c.place, c.prob FROM cells c JOIN (
  SELECT symbol, string_agg(to_state, '|' ORDER BY to_state) AS states FROM classes GROUP BY symbol) n ON n.symbol = c.symbol)""", uses="features")
def matrix(spark, sf_dir):
    features = state_features(spark, sf_dir)
    view = tr.matrix_view(tr.transition_probs(features, ruled_models(features)))
    lines = view.select("symbol", F.array_join("states", "|").alias("states"), F.posexplode("matrix").alias("line", "probs"))
    cells = lines.select("symbol", "states", "line", F.posexplode("probs").alias("place", "prob"))
    return cells.select("symbol", "states", (F.col("line") + 1).cast("bigint").alias("line"), (F.col("place") + 1).cast("bigint").alias("place"),
                        F.round("prob", 9).alias("prob"))
