import os

import pytest
from test_store_and_jobs import bars

from tidebars import session
from tidebars.operators import states, transitions
from tidebars.plans import jobs
from tidebars.sources.tables import TableStore


@pytest.fixture
def base(tmp_path):
    """A scratch folder of this test alone."""
    token = session._RUN.set(str(tmp_path))
    yield tmp_path
    session._RUN.reset(token)


def closes(n=60):
    return {"A": [10 + (7 * i % 13) / 4 for i in range(n)], "B": [20 + (5 * i % 11) / 3 for i in range(n)]}


def test_a_round_goes_once_the_next_is_complete(spark, base):
    rounds = session.Rounds(spark, "round")
    df = rounds.write(spark.range(10))
    for n in (5, 3, 0):
        df = rounds.write(df.limit(n))
        assert df.count() == n and len(os.listdir(base)) == 1


def test_the_last_complete_round_outlives_a_failure(spark, base):
    rounds = session.Rounds(spark, "round")
    df = rounds.write(spark.range(10))
    with pytest.raises(Exception):
        rounds.write(df.selectExpr("raise_error('lost') AS id"))
    assert df.count() == 10


@pytest.mark.parametrize("keep", [False, True])
def test_a_run_takes_its_scratch_with_it(spark, base, keep):
    out = session.scratch_dir(spark, "out")
    with session.scratch_run(spark, keep=keep) as folder:
        made = session.scratch_dir(spark, "table")
        assert made.startswith(folder)
        spark.range(4).write.parquet(made)
        with session.scratch_run(spark):
            spark.range(1).write.parquet(session.scratch_dir(spark, "inner"))
        assert len([f for f in os.listdir(folder) if f.startswith("run")]) == 0
        spark.read.parquet(made).write.parquet(out)
    assert os.path.exists(made) == keep and spark.read.parquet(out).count() == 4
    assert not session.scratch_dir(spark, "later").startswith(folder)


def test_a_failed_run_takes_its_scratch_with_it(spark, base):
    with pytest.raises(KeyError), session.scratch_run(spark):
        spark.range(4).write.parquet(session.scratch_dir(spark, "table"))
        raise KeyError
    assert os.listdir(base) == []


def test_a_fit_of_large_symbols_keeps_one_round(spark, base):
    store = TableStore(spark, str(base / "store")).initialize()
    jobs.insert_bars(store, bars(spark, closes()))
    features = states.classified_features(store.read("bars"), "fresh")
    models = transitions.fit_transitions(features, group_rows=10)
    assert {r.status for r in models.collect()} <= {"ok", "single_class", "not_converged"}
    assert len([f for f in os.listdir(base) if f.startswith("standing")]) == 1


def test_a_state_run_leaves_its_store_alone(spark, base):
    store = TableStore(spark, str(base / "store")).initialize()
    jobs.insert_bars(store, bars(spark, closes()))
    result = jobs.transform_states(store, None, "2020-03-31")
    assert os.listdir(base) == ["store"]
    assert result.status.count() == 2 and result.transitions.count() > 0 and result.window.count() == 120
