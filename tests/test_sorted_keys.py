import datetime as dt
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidebars.operators import sorted_keys
from tidebars.plans import jobs
from tidebars.schema import KEY
from tidebars.session import scratch_dir
from tidebars.sources.tables import CommitError, TableStore

DAY = dt.datetime(2020, 1, 1)
SCHEMA = "symbol string, timestamp timestamp_ntz, open double, high double, low double, close double, volume long"


def bars(spark, days, symbols=("A", "B")):
    rows = [(s, DAY + dt.timedelta(days=d), 1.0, 1.0, 1.0, float(d + 1), 1) for s in symbols for d in days]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def store(spark):
    return TableStore(spark, scratch_dir(spark, "case")).initialize()


def files_of(spark, *files):
    """Keys as given, each list in a file of its own."""
    path = scratch_dir(spark, "keys")
    for keys in files:
        rows = spark.createDataFrame([(s, DAY + dt.timedelta(days=d)) for s, d in keys], "symbol string, timestamp timestamp_ntz")
        rows.coalesce(1).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def judged(df):
    found = sorted_keys.stretches(df, F.year("timestamp"), F.lit(0))
    return {r.year: (r.n, r.first, r.last, r.doubtful) for r in sorted_keys.judged_cells(found).collect()}


def test_neighbours_in_a_file_and_ends_of_files(spark):
    day = lambda d: DAY + dt.timedelta(days=d)
    assert judged(files_of(spark, [("A", 0), ("A", 1), ("B", 0)])) == {2020: (3, day(0), day(1), False)}
    assert judged(files_of(spark, [("A", 0), ("A", 1), ("A", 1), ("B", 0)]))[2020][3]
    # files that lie one behind the other cannot share a key, files that touch do, files that overlap may
    assert not judged(files_of(spark, [("A", 0), ("A", 5)], [("A", 6), ("B", 0)]))[2020][3]
    assert judged(files_of(spark, [("A", 0), ("A", 5)], [("A", 5), ("B", 0)]))[2020][3]
    assert judged(files_of(spark, [("A", 0), ("B", 5)], [("A", 7)]))[2020][3]
    assert judged(files_of(spark, [("A", 9), ("A", 1), ("A", 9)]))[2020][3]  # not sorted at all
    # a null symbol is a key like any other, and not the empty one
    assert not judged(files_of(spark, [(None, 0), ("", 0), ("A", 0)]))[2020][3]
    assert judged(files_of(spark, [(None, 0), (None, 0)]))[2020][3]
    assert judged(files_of(spark, [("A", 0)]).filter("symbol = 'X'")) == {}


def test_no_row_is_shuffled(spark):
    found = sorted_keys.stretches(files_of(spark, [("A", 0)]), F.year("timestamp"), F.lit(0))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan and "Sort" not in plan


@pytest.mark.parametrize("seed", range(30))
def test_stretches_over_batches_equal_brute_force(seed):
    rng = random.Random(seed)
    rows, expected = [], []
    for file in range(rng.randint(1, 4)):
        keys = sorted((rng.choice("ABCé"), rng.randint(0, 6)) for _ in range(rng.randint(1, 12)))
        rows += [(s, t, 2020, 1, file) for s, t in keys]
        expected.append((file, len(keys), keys[0], keys[-1], sum(a == b for a, b in zip(keys, keys[1:])), min(t for _, t in keys), max(t for _, t in keys)))
    cuts = sorted({0, len(rows), *(rng.randint(0, len(rows)) for _ in range(rng.randint(0, 6)))})
    types = [pa.string(), pa.timestamp("us"), pa.int32(), pa.int32(), pa.int64()]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a:b]), types)], names=list("stybf")) for a, b in zip(cuts, cuts[1:])]
    got = [r for b in sorted_keys._stretches([batches[0].slice(0, 0), *batches]) for r in b.to_pylist()]
    micros = lambda v: (v - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    assert [(r["file"], r["n"], (r["low"]["s"], r["low"]["t"]), (r["high"]["s"], r["high"]["t"]), r["copies"], micros(r["first"]), micros(r["last"])) for r in got] == expected


def test_copies_in_a_cell_that_spark_has_split(spark, store, monkeypatch):
    """The stretches of the files meet, so the keys of the cell are grouped, and a true repeat is refused."""
    stage = TableStore._stage
    monkeypatch.setattr(TableStore, "_stage", lambda self, name, df, *a, **k: stage(self, name, df.repartition(3) if name == "bars" else df, *a, **k))
    monkeypatch.setattr("pyspark.sql.DataFrame.hint", lambda self, *a: self)
    store.commit(appends={"bars": bars(spark, range(40))})
    assert store.read("bars").count() == 80 == store.row_count("bars")
    with pytest.raises(CommitError, match="repeated"):
        store.commit(replaces={"bars": store.read("bars").unionAll(store.read("bars").limit(1))})


def opened_parts(monkeypatch):
    opened, part_rows = [], TableStore.part_rows
    monkeypatch.setattr(TableStore, "part_rows", lambda self, table, parts: opened.extend(
        (table, p) for held in parts.values() for p in held) or part_rows(self, table, parts))
    return opened


def test_times_and_counts_are_known_without_opening_a_file(spark, store, monkeypatch):
    for month in range(4):
        jobs.insert_bars(store, bars(spark, range(30 * month, 30 * month + 20)))
    old = {p for t in ("raw_bars", "bars") for held in store.manifest()["tables"][t].values() for p in held}
    opened = opened_parts(monkeypatch)
    assert store.row_count("raw_bars") == 160 and store.row_count("transition_probs") == 0
    assert not [t for t, _ in opened if t in ("raw_bars", "bars")]
    # a range inside the year, a gap between folders, exact ends
    assert store.read("raw_bars", start="2020-03-05", end="2020-03-08").count() == 8
    assert len({p.split("/")[1] for _, p in opened}) == 1
    opened.clear()
    assert store.read("raw_bars", start="2020-01-25", end="2020-01-28").count() == 0 and not opened
    assert store.read("raw_bars", start="2020-01-20", end="2020-01-31").count() == 4  # the 31st is a folder's first day
    # a later day is compared with no stored key, a late one with the folder of its time
    opened.clear()
    jobs.insert_bars(store, bars(spark, [200]))
    assert not old & {p for _, p in opened}
    jobs.insert_bars(store, bars(spark, [35]))
    assert {p.split("/")[1] for t, p in opened if p in old} and store.row_count("bars") == 162
    with pytest.raises(CommitError, match="repeated"):
        store.commit(appends={"raw_bars": bars(spark, [35])})


def test_spans_follow_refreshes_compaction_and_new_buckets(spark, store):
    for day in range(10):
        jobs.insert_bars(store, bars(spark, [day]))
    jobs.refresh_averages(store)
    jobs.compact(store)
    jobs.rebucket(store, 3)

    def check():
        manifest = store.manifest()
        spans = {r.part: (r.n, r.first, r.last) for r in store.read("part_spans").collect()}
        held = {p: t for t in ("raw_bars", "bars", "bar_states") for c in manifest["tables"].get(t, {}).values() for p in c}
        assert set(spans) == set(held)
        for part, table in held.items():
            times = [r.timestamp for r in store.part_rows(table, {"": [part]}).select(*KEY).collect()]
            assert spans[part] == (len(times), min(times), max(times))

    check()
    jobs.transform_states(store, None, "2020-01-10")
    check()


def test_a_store_without_spans_still_works(spark, store, monkeypatch):
    """Folders of which nothing is noted are opened, and counted by their files."""
    jobs.insert_bars(store, bars(spark, range(5)))
    monkeypatch.setattr(TableStore, "spans", lambda self, manifest=None: {})
    assert store.row_count("bars") == 10 and store.read("bars", start="2020-01-05").count() == 2
    with pytest.raises(CommitError, match="repeated"):
        store.commit(appends={"raw_bars": bars(spark, [2])})
    with pytest.raises(CommitError, match="would replace"):
        store.commit(replaces={"bars": store.read("bars").filter("close < 3")})
