"""Time the jobs on few long and on many short symbols; print one JSON line.

"long" is the bars of the five segments, "many" the bars of the parts, "deep" the latter under 200 symbols, whose histories are
the longest; each dated anew to the consecutive days before
``RUN_END``, so that thousands of symbols have models. Stores are filled before the clock starts. Each job gets one warm-up run
and two timed ones; the median counts. A daily refresh takes the next day in each run. Rows a second are by the rows a job works
on: the bars of the window for D3, those of the day for the daily refresh, the landed lines for D1.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import Window, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidebars.catalog import fixtures as fx  # noqa: E402
from tidebars.catalog.landing import land_scenario  # noqa: E402
from tidebars.functions.times import time_literal  # noqa: E402
from tidebars.operators.moving_averages import moving_average  # noqa: E402
from tidebars.operators.runs import symbol_sizes  # noqa: E402
from tidebars.operators.states import with_states  # noqa: E402
from tidebars.plans import jobs  # noqa: E402
from tidebars.session import get_session, scratch_dir  # noqa: E402
from tidebars.sources.tables import TableStore, in_range  # noqa: E402

RUN_END = "2001-08-01"
TIMED_RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def dated_anew(bars):
    """The bars of each symbol on the consecutive days up to ``RUN_END``."""
    back = F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("timestamp"))) - 1
    day = F.date_sub(time_literal(RUN_END).cast("date"), back).cast("timestamp_ntz")
    return bars.withColumn("timestamp", day)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="tidebars-bench-")
    spark = get_session(
        "bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g",
        spark__local__dir=f"{scratch}/local", spark__checkpoint__dir=f"{scratch}/shared", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, rows = {}, {}

    def new_store():
        return TableStore(spark, scratch_dir(spark, "tables")).initialize()

    def timed(name, n, run):
        taken = []
        for turn in range(1 + TIMED_RUNS):
            start = time.perf_counter()
            run(turn)
            taken.append(time.perf_counter() - start)
        seconds[name], rows[name] = round(statistics.median(taken[1:]), 3), n

    parts = fx.part_bars(spark, sf_dir)
    deep = parts.withColumn("timestamp", F.col("timestamp") + F.expr("make_interval(0, 0, 0, 0, 0, 0, pmod(xxhash64(symbol), 86400))"))
    deep = deep.withColumn("symbol", F.concat(F.lit("D"), F.pmod(F.xxhash64("symbol"), F.lit(200)))).dropDuplicates(["symbol", "timestamp"])
    for label, source in (("long", fx.segment_bars(spark, sf_dir)), ("many", parts), ("deep", deep)):
        bars = dated_anew(source).persist()
        n = bars.count()
        days = [r[0] for r in bars.select("timestamp").distinct().orderBy(F.desc("timestamp")).limit(1 + TIMED_RUNS).collect()][::-1]
        store, daily = new_store(), new_store()
        store.commit(appends={"raw_bars": bars, "bars": bars})
        listed = bars.select("symbol").distinct().persist() if label == "deep" else None  # the others refresh all symbols
        early = bars.filter(F.col("timestamp") < days[0])
        daily.commit(appends={"raw_bars": early, "bars": early})
        jobs.refresh_averages(daily)

        def flagship(_):
            held = store.read("bars")
            sizes = symbol_sizes(held)
            out = with_states(held, sizes).transform(moving_average("close", 20, sizes=sizes))
            out.write.format("noop").mode("overwrite").save()

        def next_day(turn):
            jobs.insert_bars(daily, bars.filter(F.col("timestamp") == days[turn]))
            jobs.refresh_averages(daily, listed)

        timed(f"d04_rebuild_{label}", n, lambda _: jobs.refresh_averages(store, rebuild=True))
        timed(f"d04_append_day_{label}", bars.filter(F.col("timestamp") == days[-1]).count(), next_day)
        if label == "deep":  # the length of histories matters to these two
            bars.unpersist()
            continue
        in_window = in_range(bars, f"{int(RUN_END[:4]) - 1}{RUN_END[4:]}", RUN_END).count()
        timed(f"states_sma20_{label}", n, flagship)
        timed(f"d03_transform_states_{label}", in_window, lambda _: jobs.transform_states(store, None, RUN_END))
        models = store.read("transition_probs").select("symbol").distinct().count()
        rows[f"models_{label}"] = models
        bars.unpersist()
    landing = land_scenario(spark, sf_dir)
    universe = fx.segment_bars(spark, sf_dir).select("symbol").distinct()
    lines = spark.read.option("recursiveFileLookup", "true").text(landing).count()
    timed("d01_daily_increment_long", lines, lambda _: jobs.daily_increment(new_store(), landing, universe, "2001-12-31T23:50:00"))
    spark.stop()
    print(json.dumps({
        "metric": "total_median_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "rows_per_sec": {k: round(rows[k] / v) for k, v in seconds.items()}, "models": {k: v for k, v in rows.items() if k.startswith("models")},
        "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
