import datetime as dt
import os

import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from tidebars.catalog import fixtures as fx, registry
from tidebars.plans import jobs, views
from tidebars.schema import MA_COLS
from tidebars.session import scratch_dir
from tidebars.sources import landing as landed
from tidebars.sources.tables import CommitError, TableStore, latest_times
from tidebars.streaming.ingest import stream_increment

DAY = dt.datetime(2020, 1, 1)
SCHEMA = "symbol string, timestamp timestamp_ntz, open double, high double, low double, close double, volume long"


def bars(spark, closes, first=DAY, volume=1):
    rows = [(s, first + dt.timedelta(days=i), c, c, c, float(c), volume) for s, cs in closes.items() for i, c in enumerate(map(float, cs))]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def store(spark):
    return TableStore(spark, scratch_dir(spark, "case")).initialize()


def contents(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def test_insert_keeps_stored_rows_and_is_repeatable(spark, store):
    jobs.insert_bars(store, bars(spark, {"A": [1, 2]}))
    jobs.insert_bars(store, bars(spark, {"A": [9, 9, 3], "B": [5]}))
    assert sorted((r.symbol, r.close) for r in store.read("bars").collect()) == [("A", 1.0), ("A", 2.0), ("A", 3.0), ("B", 5.0)]
    before = contents(store.read("raw_bars"))
    commit = jobs.insert_bars(store, bars(spark, {"A": [9, 9, 3], "B": [5]}))
    assert commit.rows == {"raw_bars": 0, "bars": 0}
    assert contents(store.read("raw_bars")) == before


def test_repeated_keys_are_refused_and_nothing_appears(spark, store):
    twice = bars(spark, {"A": [1]}).unionAll(bars(spark, {"A": [2]}))
    with pytest.raises(CommitError, match="repeated"):
        store.commit(appends={"raw_bars": bars(spark, {"A": [1]}), "bars": twice})
    assert store.manifest()["version"] == 0
    assert store.read("raw_bars").count() == 0


def test_second_writer_of_a_version_fails(spark, store):
    base = store.manifest()
    store.commit(appends={"bars": bars(spark, {"A": [1]})}, base=base)
    with pytest.raises(CommitError, match="another writer"):
        store.commit(appends={"bars": bars(spark, {"B": [1]})}, base=base)
    assert [r.symbol for r in store.read("bars").collect()] == ["A"]


def test_replacing_with_fewer_rows_is_refused(spark, store):
    store.commit(appends={"bars": bars(spark, {"A": [1, 2, 3]})})
    with pytest.raises(CommitError, match="would replace"):
        store.commit(replaces={"bars": store.read("bars").filter("close < 3")})


def test_reader_keeps_its_version(spark, store):
    store.commit(appends={"bars": bars(spark, {"A": [1]})})
    old = store.read("bars")
    store.commit(replaces={"bars": store.read("bars").withColumn("close", F.lit(2.0))})
    assert old.first().close == 1.0 and store.read("bars").first().close == 2.0


def test_only_years_in_range_are_read(spark, store):
    store.commit(appends={"bars": bars(spark, {"A": [1] * 800})})
    files = {f.split("/")[-3] for f in store.read("bars", start="2021-03-01", end="2021-04-01").inputFiles()}
    assert files == {"year=2021"}
    plan = store.read("bars", "A", "2021-03-01", "2021-04-01").select("close")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(symbol,A)" in plan and "GreaterThanOrEqual(timestamp" in plan
    assert "ReadSchema: struct<symbol:string,timestamp:timestamp_ntz,close:double>" in plan


def test_average_refresh_is_repeatable_and_incremental_equals_rebuild(spark, sf_dir):
    all_bars = fx.cent_bars(spark, sf_dir)
    a, b = [TableStore(spark, scratch_dir(spark, "case")).initialize() for _ in "ab"]
    late = (F.col("symbol") == "BUILDING") & (F.dayofyear("timestamp") == 60) | (F.year("timestamp") >= 2001)
    for t in (a, b):
        t.commit(appends={n: all_bars.filter(~late) for n in ("raw_bars", "bars")})
    assert jobs.refresh_averages(a).commit is not None
    assert jobs.refresh_averages(a).commit is None
    for t in (a, b):
        jobs.insert_bars(t, all_bars)
    jobs.refresh_averages(a)
    jobs.refresh_averages(b, rebuild=True)
    smooth = [c for c in MA_COLS if c.startswith("ema")]
    as_text = lambda t: contents(t.wide().withColumns({c: F.round(c, 4) for c in smooth}))
    assert as_text(a) == as_text(b)
    assert a.wide().dropna(subset=MA_COLS).count() == all_bars.count()


def test_refresh_of_listed_symbols_leaves_others(spark, store):
    both = bars(spark, {"A": [1, 2, 3], "B": [4, 5]})
    store.commit(appends={"raw_bars": both, "bars": both})
    listed = spark.createDataFrame([("A",), ("X",)], "symbol string")
    status = {r.symbol: (r.n, r.ok, r.reason) for r in jobs.refresh_averages(store, listed).status.collect()}
    assert status == {"A": (3, True, None), "X": (0, False, "no_raw_bars")}
    got = {(r.symbol, r.close): r.sma_5 for r in store.wide().collect()}
    assert got == {("A", 1.0): 1.0, ("A", 2.0): 1.5, ("A", 3.0): 2.0, ("B", 4.0): None, ("B", 5.0): None}


def test_some_periods_only(spark, store):
    both = bars(spark, {"A": [1, 2, 3]})
    store.commit(appends={"raw_bars": both, "bars": both})
    jobs.refresh_averages(store, periods=[10])
    jobs.refresh_averages(store, periods=[5])
    last = store.wide().orderBy(F.desc("timestamp")).first()
    assert last.sma_10 == 2.0 and last.sma_5 == 2.0 and last.sma_20 is None
    with pytest.raises(ValueError):
        jobs.refresh_averages(store, periods=[7])


def test_state_job_twice_and_stored_labels(spark, sf_dir, store):
    smooth = fx.smooth_bars(spark, sf_dir)
    store.commit(appends={"raw_bars": smooth, "bars": smooth})
    first = jobs.transform_states(store, None, "2001-08-01", labels="stored")
    assert {r.reason for r in first.status.collect()} == {"no_data"}
    assert store.read("transition_probs").count() == 0
    states = contents(store.read("bars"))
    fresh = jobs.transform_states(store, None, "2001-08-01")
    assert contents(store.read("bars")) == states
    probs = contents(store.read("transition_probs"))
    again = jobs.transform_states(store, None, "2001-08-01", labels="stored")
    assert contents(store.read("transition_probs")) == probs
    assert contents(fresh.status) == contents(again.status)
    window = store.read("bars", start=dt.datetime(2000, 8, 1), end="2001-08-01")
    firsts = window.groupBy("symbol").agg(F.min_by("market_state", "timestamp").alias("s")).collect()
    assert all(r.s is None for r in firsts)
    with pytest.raises(ValueError):
        jobs.transform_states(store, None, "2001-08-01", labels="other")


def write_csv(folder, source, stem, lines, adjusted=False):
    path = os.path.join(folder, source)
    os.makedirs(path, exist_ok=True)
    head = "Date,Open,High,Low,Close,Adj Close,Volume" if adjusted else "Date,Open,High,Low,Close,Volume"
    with open(os.path.join(path, f"{stem}.csv"), "w") as f:
        f.write("\n".join([head, *lines]) + "\n")


def line(day, price, volume=1, adjusted=False):
    return f"{day},{price},{price},{price},{price},{'0,' if adjusted else ''}{volume}"


@pytest.fixture
def landing(folder):
    write_csv(folder, "primary", "aapl.us", [line("2024-01-02", 1), line("2024-01-02", 9), line("2024-01-03", 2)])
    write_csv(folder, "primary", "aapl", [line("2024-01-04", 50)])
    write_csv(folder, "primary", "sap.de", [line("2024-01-02", 3)])
    write_csv(folder, "primary", "neg.us", [line("2024-01-02", -3), line("2024-01-03", 3)])
    write_csv(folder, "primary", "old.us", [line("1990-01-02", 3)])
    write_csv(folder, "primary", "nil.us", [])
    write_csv(folder, "secondary", "old", [line("2024-01-02", 7, adjusted=True)], adjusted=True)
    write_csv(folder, "secondary", "nil", [line("2024-01-05", 8, 2.5, adjusted=True)], adjusted=True)
    with open(os.path.join(folder, "tickers.txt"), "w") as f:
        f.write("AAPL\n\n  SAP.DE \t\nNEG\nOLD\nNIL\nAAPL\nGONE\n")
    return folder


def ingested(store):
    return sorted((r.symbol, r.timestamp.date().isoformat(), r.close, r.volume) for r in store.read("bars").collect())


EXPECTED = [("AAPL", "2024-01-02", 1.0, 1), ("AAPL", "2024-01-03", 2.0, 1), ("NIL", "2024-01-05", 8.0, 2),
            ("OLD", "2024-01-02", 7.0, 1), ("SAP.DE", "2024-01-02", 3.0, 1)]


def test_backfill_from_files(spark, store, landing):
    universe = landed.read_universe(spark, f"{landing}/tickers.txt")
    result = jobs.historical_backfill(store, landing, universe, "2024-01-31", default_start="2024-01-01")
    assert ingested(store) == EXPECTED
    status = {r.symbol: r.reason for r in result.status.collect()}
    assert status == {"AAPL": None, "SAP.DE": None, "OLD": None, "NIL": None, "GONE": "empty",
                      "NEG": "negative_price"}
    write_csv(landing, "primary", "aapl.us", [line("2024-01-03", 77), line("2024-01-09", 4)])
    spark.catalog.clearCache()
    jobs.daily_increment(store, landing, universe, "2024-01-31T23:50:00")
    assert [r for r in ingested(store) if r[0] == "AAPL"] == [*EXPECTED[:2], ("AAPL", "2024-01-09", 4.0, 1)]
    done = jobs.daily_increment(store, landing, universe, "2024-01-09T23:50:00")
    assert {r.symbol: r.reason for r in done.status.collect()}["AAPL"] == "up_to_date"


def test_stream_takes_each_file_once(spark, store, landing, folder):
    universe = landed.read_universe(spark, f"{landing}/tickers.txt")
    checkpoint = scratch_dir(spark, "stream")
    run = lambda: stream_increment(store, landing, universe, "2024-01-31", checkpoint, "2024-01-01").awaitTermination()
    run()
    assert ingested(store) == EXPECTED
    run()
    assert ingested(store) == EXPECTED
    write_csv(landing, "primary", "gone.us", [line("2024-01-10", 6)])
    run()
    assert ingested(store) == sorted([*EXPECTED, ("GONE", "2024-01-10", 6.0, 1)])


def test_missing_sources_and_lists(spark, folder):
    assert landed.read_universe(spark, f"{folder}/none.txt").count() == 0
    assert landed.scan_sources(spark, folder).count() == 0


def test_one_bad_file_leaves_the_others_alone(spark, store, folder):
    write_csv(folder, "primary", "aapl.us", [line("2024-01-02", 1)])
    write_csv(folder, "secondary", "nil", [line("2024-01-02", 5, adjusted=True)], adjusted=True)
    for stem, body in (("nil.us", "No data"), ("bad.us", "a,b,c\n1,2,3\n"), ("void.us", ""), ("swap.us", "Volume,Close,Low,High,Open,Datetime\n7,4,1,9,2,2024-01-02\n")):
        with open(os.path.join(folder, "primary", f"{stem}.csv"), "w") as f:
            f.write(body)
    universe = spark.createDataFrame([(x,) for x in ("AAPL", "NIL", "BAD", "VOID", "SWAP")], "symbol string")
    result = jobs.daily_increment(store, folder, universe, "2024-01-31")
    assert ingested(store) == [("AAPL", "2024-01-02", 1.0, 1), ("NIL", "2024-01-02", 5.0, 1), ("SWAP", "2024-01-02", 4.0, 7)]
    assert {r.symbol: r.reason for r in result.status.collect()} == {
        "AAPL": None, "NIL": None, "BAD": "unreadable_file", "VOID": "empty", "SWAP": None}


def test_copies_are_ordered_by_file_then_line(spark, store, folder):
    path = os.path.join(folder, "primary", "ticker=aapl.us")
    os.makedirs(path)
    for name, lines in (("part-00000.csv", [line("2024-01-02", 1)]), ("part-00001.csv", [line(f"2024-01-{d:02}", 99) for d in range(1, 29)])):
        with open(os.path.join(path, name), "w") as f:
            f.write("\n".join(["Date,Open,High,Low,Close,Volume", *lines]) + "\n")
    jobs.daily_increment(store, folder, spark.createDataFrame([("AAPL",)], "symbol string"), "2024-01-31")
    assert [r for r in ingested(store) if r[1] == "2024-01-02"] == [("AAPL", "2024-01-02", 1.0, 1)]


def test_parts_of_a_ticker_in_any_order_of_arrival(spark, store, folder):
    path = os.path.join(folder, "primary", "ticker=aapl.us")
    os.makedirs(path)
    for i, day in enumerate(("2024-01-10", "2024-01-02", "2024-01-05")):
        file = os.path.join(path, f"part-{i}.csv")
        with open(file, "w") as f:
            f.write("Date,Open,High,Low,Close,Volume\n" + line(day, i + 1) + "\n")
        os.utime(file, (1_600_000_000 + i, 1_600_000_000 + i))
    universe = spark.createDataFrame([("AAPL",)], "symbol string")
    stream_increment(store, folder, universe, "2024-01-31", scratch_dir(spark, "stream")).awaitTermination()
    assert [r[1] for r in ingested(store)] == ["2024-01-02", "2024-01-05", "2024-01-10"]


def test_a_stored_key_is_not_published_twice(spark, store):
    store.commit(appends={"bars": bars(spark, {"A": [1, 2]})})
    with pytest.raises(CommitError, match="repeated"):
        store.commit(appends={"bars": bars(spark, {"A": [5]})})
    with pytest.raises(CommitError, match="repeated"):
        store.commit(replaces={"bars": store.read("bars").unionAll(store.read("bars"))})
    assert store.read("bars").count() == 2


def test_cells_do_not_gather_folders_for_ever(spark, store):
    for day in range(12):
        store.commit(appends={"raw_bars": bars(spark, {"A": [day]}, first=DAY + dt.timedelta(days=day))})
    jobs.compact(store)
    assert store.read("raw_bars").count() == 12
    assert max(len(p) for p in store.manifest()["tables"]["raw_bars"].values()) <= 8


def test_one_symbol_is_read_from_its_bucket_and_a_late_bar_rewrites_it_alone(spark, store):
    names = [f"S{i}" for i in range(40)]
    closes = {s: range(1, 500) for s in names}
    both = bars(spark, closes)
    store.commit(appends={"raw_bars": both, "bars": both})
    jobs.refresh_averages(store)
    of = {f.split("/")[-2] for f in store.read("bars", "S7").inputFiles()}
    assert len(of) == 1
    before = store.manifest()["tables"]["bars"]
    assert jobs.refresh_averages(store).commit is None
    jobs.insert_bars(store, bars(spark, {"S7": [9]}, first=dt.datetime(2020, 6, 1, 12)))
    jobs.refresh_averages(store)
    after = store.manifest()["tables"]["bars"]
    bucket = of.pop().split("=")[1]
    assert {c for c in after if after[c] != before.get(c)} == {f"{y}/{bucket}" for y in (2020, 2021)}
    whole = TableStore(spark, scratch_dir(spark, "case")).initialize()
    raw = store.read("raw_bars")
    whole.commit(appends={"raw_bars": raw, "bars": raw})
    jobs.refresh_averages(whole, rebuild=True)
    smooth = {c: F.round(c, 6) for c in MA_COLS if c.startswith("ema")}
    assert contents(store.wide().withColumns(smooth)) == contents(whole.wide().withColumns(smooth))


def test_sparse_symbols_get_whole_frames(spark, store):
    """A symbol with a bar a month needs more than the year before for its 200-bar frames."""
    rows = [("M", dt.datetime(1990 + m // 12, m % 12 + 1, 3), 1.0, 1.0, 1.0, float(m), 1) for m in range(300)]
    both = spark.createDataFrame(rows, SCHEMA)
    early = both.filter("close < 295")
    store.commit(appends={"raw_bars": early, "bars": early})
    jobs.refresh_averages(store)
    jobs.insert_bars(store, both)
    jobs.refresh_averages(store)
    last = store.wide().orderBy(F.desc("timestamp")).first()
    assert last.sma_200 == pytest.approx(sum(range(100, 300)) / 200) and last.sma_50 == pytest.approx(sum(range(250, 300)) / 50)


def test_a_late_old_bar_and_a_new_day_of_another_symbol_of_the_bucket(spark):
    """The look-back of each symbol ends at its own first stale bar, however far apart they are."""
    stores = [TableStore(spark, scratch_dir(spark, "case")).initialize(buckets=1) for _ in "ab"]
    early = bars(spark, {"A": range(1, 1801), "B": range(5000, 6500)})
    rest = bars(spark, {"A": [7]}, first=dt.datetime(2020, 9, 1, 12)).unionAll(bars(spark, {"B": [9000]}, first=dt.datetime(2024, 3, 1)))
    rest = rest.unionAll(bars(spark, {"C": range(1, 40)}, first=dt.datetime(2020, 3, 1)))
    for t in stores:
        jobs.insert_bars(t, early)
    jobs.refresh_averages(stores[0])
    for t in stores:
        jobs.insert_bars(t, rest)
    jobs.refresh_averages(stores[0])
    jobs.refresh_averages(stores[1], rebuild=True)
    smooth = {c: F.round(c, 6) for c in MA_COLS if c.startswith("ema")}
    assert contents(stores[0].wide().withColumns(smooth)) == contents(stores[1].wide().withColumns(smooth))


def test_bars_without_a_usable_close_do_not_shorten_the_look_back(spark):
    odd = {20: float("nan"), 100: float("inf"), 150: float("-inf"), 300: float("nan")}
    closes = [odd.get(i, float(i)) for i in range(366)]
    stores = [TableStore(spark, scratch_dir(spark, "case")).initialize(buckets=1) for _ in "ab"]
    for t in stores:
        jobs.insert_bars(t, bars(spark, {"A": closes}))
    jobs.refresh_averages(stores[0])
    for t in stores:
        jobs.insert_bars(t, bars(spark, {"A": [500]}, first=dt.datetime(2021, 1, 1)))
    jobs.refresh_averages(stores[0])
    jobs.refresh_averages(stores[1], rebuild=True)
    smooth = {c: F.round(c, 6) for c in MA_COLS if c.startswith("ema")}
    assert contents(stores[0].wide().withColumns(smooth)) == contents(stores[1].wide().withColumns(smooth))


def test_a_wrong_stored_probability_shows(spark, sf_dir, monkeypatch):
    right, con = jobs.transition_probs, connect(sf_dir)
    monkeypatch.setattr(jobs, "transition_probs", lambda *a: right(*a).withColumn("prob", F.col("prob") * 0.9))
    registry.load()
    equal = {n: compare(spark, con, n, registry.QUERIES[n], registry.SQL[n], sf_dir)[0] for n in registry.QUERIES if n.startswith("s16")}
    assert [n for n in equal if not equal[n]] == ["s16_row_sums", "s16_two_universes_row_sums"]


def test_matrices_of_other_universes_stay(spark, sf_dir, store):
    smooth = fx.smooth_bars(spark, sf_dir)
    store.commit(appends={"raw_bars": smooth, "bars": smooth})
    listed = lambda *s: spark.createDataFrame([(x,) for x in s], "symbol string")
    jobs.transform_states(store, listed("BUILDING"), "2001-08-01")
    first = contents(store.read("transition_probs"))
    result = jobs.transform_states(store, listed("MACHINERY", "ABSENT"), "2001-08-01")
    assert {r.symbol for r in store.read("transition_probs").collect()} == {"BUILDING", "MACHINERY"}
    assert set(first) <= set(contents(store.read("transition_probs")))
    status = {r.symbol: (r.n > 0, r.ok, r.reason) for r in result.status.collect()}
    assert status == {"MACHINERY": (True, True, None), "ABSENT": (False, False, "no_bars")}


def test_price_view_and_stored_view(spark, store):
    store.commit(appends={"bars": bars(spark, {"A": [1, 2, 3], "B": [4]})})
    view = views.price_view(store, "A", dt.date(2020, 1, 2), dt.date(2020, 1, 3))
    assert [r.close for r in view.collect()] == [2.0, 3.0]
    _, filled = views.stored_averages_view(store, "A")
    assert filled.count() == 0
    assert "disp_ema_21" in views.live_averages_view(store, "A").columns


def listed(spark, *symbols):
    return spark.createDataFrame([(x,) for x in symbols], "symbol string")


def cells_changed(before, after):
    return {c for c in after if after[c] != before.get(c)}


def test_a_listed_refresh_opens_nothing_when_there_is_nothing_to_do_and_its_buckets_alone_otherwise(spark, store, monkeypatch):
    names = [f"S{i}" for i in range(30)]
    jobs.insert_bars(store, bars(spark, {s: range(1, 260) for s in names}))
    universe = listed(spark, *names)
    assert jobs.refresh_averages(store, universe).commit is not None
    opened = []
    part_rows = TableStore.part_rows
    monkeypatch.setattr(TableStore, "part_rows", lambda self, table, parts: opened.extend(
        (table, c, p) for c in parts for p in parts[c]) or part_rows(self, table, parts))
    assert jobs.refresh_averages(store, universe).commit is None
    assert {t for t, _, _ in opened} <= {"symbol_marks", "average_tails"}
    old = store.manifest()["tables"]
    jobs.insert_bars(store, bars(spark, {s: [7] for s in names}, first=dt.datetime(2021, 1, 1)))
    before = store.manifest()["tables"]["bars"]
    opened.clear()
    jobs.refresh_averages(store, listed(spark, "S3"))
    own = {c.split("/")[1] for t, c, _ in opened}
    assert len(own) == 1
    # neither the folders of the earlier years nor those of other buckets were looked into
    assert not {p for t, c, p in opened if t in ("raw_bars", "bars")} & {p for t in ("raw_bars", "bars") for ps in old[t].values() for p in ps}
    assert cells_changed(before, store.manifest()["tables"]["bars"]) == {f"2021/{own.pop()}"}
    got = {r.symbol: r.sma_5 for r in store.wide(start="2021-01-01").collect()}
    assert got.pop("S3") == pytest.approx((256 + 257 + 258 + 259 + 7) / 5) and set(got.values()) == {None}
    jobs.refresh_averages(store, universe)
    assert [r.sma_5 for r in store.wide(start="2021-01-01").collect()] == [pytest.approx(207.4)] * len(names)


def test_tails_equal_those_of_whole_histories(spark):
    stores = [TableStore(spark, scratch_dir(spark, "case")).initialize(buckets=2) for _ in "ab"]
    closes = {"A": range(1, 500), "B": [5.0] * 40, "C": [float("nan"), 3, float("inf")]}
    days = [{"A": [9], "C": [4]}, {"A": [8], "B": [7], "D": [1]}, {"A": [float("nan")], "B": [6]}, {"A": [2], "D": [3]}]
    for t in stores:
        jobs.insert_bars(t, bars(spark, closes))
    jobs.refresh_averages(stores[0])
    for i, day in enumerate(days):
        for t in stores:
            jobs.insert_bars(t, bars(spark, day, first=dt.datetime(2022, 1, 1 + i)))
        jobs.refresh_averages(stores[0])
    late = bars(spark, {"B": [100]}, first=dt.datetime(2020, 1, 10, 12))
    for t in stores:
        jobs.insert_bars(t, late)
    jobs.refresh_averages(stores[0])
    jobs.refresh_averages(stores[1], rebuild=True)
    smooth = {c: F.round(c, 6) for c in MA_COLS if c.startswith("ema")}
    assert contents(stores[0].wide().withColumns(smooth)) == contents(stores[1].wide().withColumns(smooth))
    tails = [contents(t.read("average_tails").select("symbol", "until", "closes")) for t in stores]
    assert tails[0] == tails[1] and len(tails[0]) == 4
    assert jobs.refresh_averages(stores[0]).commit is None
    assert stores[0].read("symbol_marks").filter("since IS NOT NULL").count() == 0


def test_averages_of_bars_that_came_before_their_raw_bars(spark, store):
    both = bars(spark, {"A": [1, 2, 3]})
    store.commit(appends={"bars": both})
    assert jobs.refresh_averages(store).commit is None
    store.commit(appends={"raw_bars": both})
    jobs.refresh_averages(store)
    assert sorted(r.sma_5 for r in store.wide().collect()) == [1.0, 1.5, 2.0]


def test_a_state_run_rewrites_no_average(spark, sf_dir, store):
    smooth = fx.smooth_bars(spark, sf_dir)
    jobs.insert_bars(store, smooth)
    jobs.refresh_averages(store)
    before, wide = store.manifest()["tables"], contents(store.wide().drop("market_state"))
    jobs.transform_states(store, None, "2001-08-01")
    after = store.manifest()["tables"]
    assert after["bars"] == before["bars"] and after["bar_states"]
    assert contents(store.wide().drop("market_state")) == wide
    assert store.wide().filter("market_state IS NOT NULL").count() > 0
    states = contents(store.read("bars").select("symbol", "timestamp", "market_state"))
    jobs.refresh_averages(store, rebuild=True)
    assert contents(store.read("bars").select("symbol", "timestamp", "market_state")) == states


def test_states_that_come_with_bars_are_stored(spark, store):
    states = bars(spark, {"A": [1, 2]}).withColumn("market_state", F.when(F.col("close") > 1, "Strong Up"))
    store.commit(appends={"bars": states})
    assert {r.close: r.market_state for r in store.read("bars").collect()} == {1.0: None, 2.0: "Strong Up"}


def test_a_plan_reads_no_stored_bars(spark, store, landing, monkeypatch):
    universe = landed.read_universe(spark, f"{landing}/tickers.txt")
    jobs.historical_backfill(store, landing, universe, "2024-01-31", default_start="2024-01-01")
    seen = []
    plan = landed.fetch_plan
    monkeypatch.setattr(jobs.landed, "fetch_plan", lambda u, latest, *a: seen.extend(latest.inputFiles()) or plan(u, latest, *a))
    jobs.daily_increment(store, landing, universe, "2024-02-01T23:50:00")
    assert any("/symbol_marks/" in f for f in seen) and all("/symbol_marks/" in f or f.endswith("tickers.txt") for f in seen)
    kept = {r.symbol: r.latest for r in store.marks(universe).collect()}
    assert kept == {r.symbol: r.latest for r in latest_times(store.read("raw_bars")).collect()}


def test_only_the_files_of_listed_tickers_are_opened(spark, folder):
    for i in range(50):
        write_csv(folder, "primary", f"t{i}.us", [line("2024-01-02", i)])
        write_csv(folder, "secondary", f"t{i}", [line("2024-01-02", i, adjusted=True)], adjusted=True)
    write_csv(folder, "primary", "a[b]{c}.us", [line("2024-01-02", 1)])
    wanted = landed.candidates(listed(spark, "T7", "A[B]{C}"))
    files = landed.scan_sources(spark, folder, wanted).inputFiles()
    assert {os.path.basename(f) for f in files} == {"t7.us.csv", "t7.csv", "a%5Bb%5D%7Bc%7D.us.csv"} or len(files) == 3
    assert landed.scan_sources(spark, folder, wanted).filter("cells[0] = '2024-01-02'").count() == 3
    assert landed.scan_sources(spark, folder, landed.candidates(listed(spark, "NONE"))).count() == 0


def test_compaction_keeps_rows_and_settled_folders(spark, store):
    names = [f"S{i}" for i in range(6)]
    for day in range(10):
        jobs.insert_bars(store, bars(spark, {s: [day] for s in names}, first=DAY + dt.timedelta(days=day)))
        jobs.refresh_averages(store)
    wide, most = contents(store.wide()), lambda: max(len(p) for t in ("raw_bars", "bars") for p in store.manifest()["tables"][t].values())
    assert most() > 8
    jobs.compact(store)
    assert most() <= 8 and contents(store.wide()) == wide
    held = {p for t in ("raw_bars", "bars") for ps in store.manifest()["tables"][t].values() for p in ps}
    assert set(store.manifest()["settled"]) == held
    assert jobs.refresh_averages(store).commit is None and jobs.compact(store) is None


def test_buckets_can_grow(spark):
    store = TableStore(spark, scratch_dir(spark, "case")).initialize(buckets=2)
    names = [f"S{i}" for i in range(20)]
    jobs.insert_bars(store, bars(spark, {s: range(1, 400) for s in names}))
    jobs.refresh_averages(store)
    jobs.transform_states(store, None, "2020-12-31")
    wide = contents(store.wide())
    jobs.rebucket(store, 64)
    assert contents(store.wide()) == wide and store.manifest()["buckets"] == 64
    assert len({c.split("/")[1] for c in store.manifest()["tables"]["bars"]}) > 2
    assert jobs.refresh_averages(store).commit is None
    jobs.insert_bars(store, bars(spark, {"S1": [3]}, first=dt.datetime(2021, 6, 1)))
    jobs.refresh_averages(store, listed(spark, "S1"))
    assert store.wide("S1", start="2021-06-01").first().sma_5 == pytest.approx((396 + 397 + 398 + 399 + 3) / 5)
