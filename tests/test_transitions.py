import numpy as np
import pytest
from pyspark.sql import functions as F

from tidebars.catalog import fixtures as fx, model
from tidebars.operators import states as st
from tidebars.operators import transitions as tr
from tidebars.schema import FEATURE_COLS


@pytest.fixture(scope="module")
def features(spark, sf_dir):
    bars = fx.tick_bars(spark, sf_dir)
    labelled = st.with_states(bars).withColumnRenamed("new_state", "market_state")
    return st.lag_features(labelled).persist()


def dense_newton(x, y):
    """Plain minimiser of the same objective, written out anew."""
    w = np.zeros(x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-(x @ w)))
        g = w + x.T @ (p - (y > 0))
        h = np.eye(len(w)) + (x.T * (p * (1 - p))) @ x
        w = w - np.linalg.solve(h, g)
        if np.abs(g).max() < 1e-11:
            break
    return w, np.abs(g).max()


def test_fit_matches_a_dense_solution(features):
    models = {r.symbol: r for r in tr.fit_transitions(features).collect()}
    rows = st.training_rows(features).toPandas()
    assert set(models) == set(rows.symbol)
    for symbol, own in rows.groupby("symbol"):
        x = np.column_stack([own[FEATURE_COLS].to_numpy(), np.ones(len(own))])
        model = models[symbol]
        assert model.n == len(own) and model.classes == sorted(set(own.target_state))
        labels = model.classes[1:] if len(model.classes) == 2 else model.classes
        for label, w in zip(labels, model.weights, strict=True):
            expected, slope = dense_newton(x, np.where(own.target_state == label, 1, -1))
            assert slope < 1e-8
            np.testing.assert_allclose(w, expected, atol=1e-8)


def test_large_symbols_get_the_same_models(features):
    small = {r.symbol: r for r in tr.fit_transitions(features).collect()}
    n = sorted(r.n for r in small.values())
    large = {r.symbol: r for r in tr.fit_transitions(features, group_rows=n[2]).collect()}
    assert set(small) == set(large)
    for s in small:
        assert small[s].classes == large[s].classes and small[s].status == large[s].status
        np.testing.assert_allclose(small[s].weights, large[s].weights, atol=1e-8)


def test_matrix_rows_sum_to_one_or_zero(features):
    models = tr.fit_transitions(features)
    probs = tr.transition_probs(features, models)
    sums = probs.groupBy("symbol", "from_state").agg(F.sum("prob").alias("total"), F.count("prob").alias("n")).collect()
    sizes = {r.symbol: len(r.classes) for r in models.collect()}
    for r in sums:
        assert r.n == sizes[r.symbol]
        assert r.total == pytest.approx(1.0) or r.total == 0.0


def tiny(spark, targets, current=None):
    rng = np.random.default_rng(1)
    rows = []
    for i, target in enumerate(targets):
        x = rng.normal(size=len(FEATURE_COLS))
        rows.append(("T", i, (current or targets)[i], *map(float, x), target, True))
    schema = "symbol string, timestamp int, market_state string, " + ", ".join(f"{c} double" for c in FEATURE_COLS)
    return spark.createDataFrame(rows, schema + ", target_state string, history boolean")


def test_two_classes_use_one_model(spark):
    f = tiny(spark, ["Stable", "Strong Up"] * 20)
    models = tr.fit_transitions(f)
    row = models.first()
    assert row.classes == ["Stable", "Strong Up"] and len(row.weights) == 1
    scored = tr.state_probabilities(f, models).toPandas()
    w = np.array(row.weights[0])
    x = f.toPandas()[FEATURE_COLS].to_numpy()
    up = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    got = scored[scored.to_state == "Strong Up"].sort_values("timestamp").prob
    np.testing.assert_allclose(got, up, rtol=1e-12)
    both = scored.groupby("timestamp").prob.sum()
    np.testing.assert_allclose(both, 1.0)


def test_status_rows_and_class_never_current(spark):
    one = tr.fit_transitions(tiny(spark, ["Stable"] * 5)).first()
    assert one.status == "single_class" and one.weights == []
    assert tr.transition_probs(tiny(spark, ["Stable"] * 5), tr.fit_transitions(tiny(spark, ["Stable"] * 5))).count() == 0
    none = tiny(spark, ["Stable"] * 5).withColumn("ret_lag_20", F.lit(None).cast("double"))
    row = tr.fit_transitions(none).first()
    assert row.status == "no_data" and row.n == 0 and row.dropped == 5
    f = tiny(spark, ["Slight Up", "Stable", "Strong Up"] * 5, current=["Slight Up", "Stable", "Strong Down"] * 5)
    cells = {(r.from_state, r.to_state): r.prob for r in tr.transition_probs(f, tr.fit_transitions(f)).collect()}
    assert len(cells) == 9
    assert all(cells["Strong Up", to] == 0.0 for to in ("Slight Up", "Stable", "Strong Up"))
    assert not any(frm == "Strong Down" for frm, _ in cells)


def test_matrix_view_has_class_order(spark):
    f = tiny(spark, ["Slight Up", "Stable", "Strong Up"] * 8)
    view = tr.matrix_view(tr.transition_probs(f, tr.fit_transitions(f))).first()
    assert view.states == ["Slight Up", "Stable", "Strong Up"]
    np.testing.assert_allclose(np.array(view.matrix).sum(axis=1), 1.0)


@pytest.mark.parametrize("group_rows", [None, 10])
def test_a_fit_that_does_not_converge_is_said_so(spark, monkeypatch, group_rows):
    f = tiny(spark, ["Slight Up", "Stable", "Strong Up"] * 8)
    monkeypatch.setattr(tr, "MAX_ROUNDS", 2)
    monkeypatch.setattr(tr, "_fit_group", lambda pdf, fit=tr._fit_group: fit(pdf))
    if group_rows is None:
        rows = st.training_rows(f).toPandas()
        assert tr._fit_group(rows).status.tolist() == ["not_converged"]
        return
    models = tr.fit_transitions(f, group_rows=group_rows)
    row = models.first()
    assert row.status == "not_converged" and row.weights == []
    assert tr.transition_probs(f, models).count() == 0


def test_all_sigmoids_underflow(spark):
    f = tiny(spark, ["Slight Up", "Stable", "Strong Up"])
    weights = [[0.0] * 6 + [-2000.0], [0.0] * 6 + [-2000.0], [0.0] * 6 + [-3000.0]]
    models = spark.createDataFrame([("T", ["Slight Up", "Stable", "Strong Up"], weights, "ok")], tr.MODEL_SCHEMA)
    probs = {(r.timestamp, r.to_state): r.prob for r in tr.state_probabilities(f, models).collect()}
    assert probs[0, "Slight Up"] == pytest.approx(0.5) and probs[0, "Strong Up"] == pytest.approx(0.0)


def test_no_group_is_larger_than_the_limit(features):
    assert tr.GROUP_ROWS <= 200_000
    with pytest.MonkeyPatch.context() as m:
        m.setattr(tr, "GROUP_ROWS", 5)
        assert {r.status for r in tr.fit_transitions(features).collect()} <= {"ok", "single_class"}


def test_rows_of_one_large_symbol_lie_in_many_tasks(spark):
    f = tiny(spark, ["Slight Up", "Stable", "Strong Up"] * 400).coalesce(1)
    classes = tr.classes_per_symbol(f)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        held = tr.pack_rows(st.training_rows(f), classes).groupBy(F.spark_partition_id()).agg(F.sum("size").alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r.n for r in held) == 1200 and len(held) == 4
    assert max(r.n for r in held) < 600


def test_block_sums_are_those_of_the_rows(features):
    rows, classes = st.training_rows(features), tr.classes_per_symbol(features)
    weights = F.array(*[F.lit(0.1 * i - 0.2) for i in range(tr.N_WEIGHTS)])
    models = classes.select("symbol", F.transform("classes", lambda c, i: F.struct(i.alias("place"), weights.alias("w"))).alias("models"))
    parts = tr.pack_rows(rows, classes).join(models, "symbol").mapInPandas(tr._block_sums, tr._SUMS_SCHEMA)
    got = {(r.symbol, r.place): r for r in parts.groupBy("symbol", "place").agg(*[F.sum(c).alias(c) for c in tr._SUMS]).collect()}
    plain = tr.model_sums(rows, classes.select("symbol", F.explode("classes").alias("label"), weights.alias("w"))).collect()
    place = {(r.symbol, c): i for r in classes.collect() for i, c in enumerate(r.classes)}
    assert len(got) == len(plain)
    for r in plain:
        np.testing.assert_allclose([got[r.symbol, place[r.symbol, r.label]][c] for c in tr._SUMS], [r[c] for c in tr._SUMS], rtol=1e-9, atol=1e-9)


def test_queries_compute_features_once(spark, features):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    n = features.count()
    slopes = model._slopes(features.mapInPandas(counted, features.schema), group_rows=10)
    assert slopes.count() > 0 and seen.value == n
