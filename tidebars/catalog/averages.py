"""Checked queries over moving averages. Closes are whole cents, so plain and weighted sums are exact;
exponential averages are compared after rounding."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidebars.catalog import fixtures as fx
from tidebars.catalog.registry import query
from tidebars.operators import moving_averages as ma
from tidebars.schema import DEFAULT_DISPLAY_PERIODS, STANDARD_PERIODS


def sma_sql(p, column="close"):
    frame = f'OVER (PARTITION BY symbol ORDER BY "timestamp" ROWS BETWEEN {p - 1} PRECEDING AND CURRENT ROW)'
    return f"CAST(sum({column}) {frame} AS DOUBLE) / count(*) {frame}"


def wma_sql(p):
    frame = f'OVER (PARTITION BY symbol ORDER BY "timestamp" ROWS BETWEEN {p - 1} PRECEDING AND CURRENT ROW)'
    held = f"list(close) {frame}"
    return f"list_sum(list_transform({held}, lambda v, i: v * i)) / (len({held}) * (len({held}) + 1) / 2.0)"


def ema_sql(p, column="close"):
    """A sum over all earlier bars, for a self join of numbered bars i (this) and j (earlier)."""
    a = f"(2.0::DOUBLE / {p + 1})"
    d = f"(1.0::DOUBLE - {a})"
    return f"sum((CASE WHEN j.rn = 1 THEN 1.0::DOUBLE ELSE {a} END) * j.{column} * pow({d}, i.rn - j.rn))"


def numbered(bars):
    return f'SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "timestamp") AS rn FROM {bars}'


def ema_query(bars, columns, digits):
    """``columns``: {name: (period, value column)}."""
    picked = ", ".join(f"round({ema_sql(p, c)}, {digits}) AS {name}" for name, (p, c) in columns.items())
    return f"""SELECT i.symbol, i."timestamp", {picked}
FROM ({numbered(bars)}) i JOIN ({numbered(bars)}) j ON i.symbol = j.symbol AND j.rn <= i.rn
GROUP BY i.symbol, i."timestamp" """


def rounded(df, names, digits):
    return df.select("symbol", "timestamp", *[F.round(F.col(n), digits).alias(n) for n in names])


def _named(kind, periods=STANDARD_PERIODS, column="close"):
    return {f"{kind}_{p}": (kind, column, p) for p in periods}


@query("w05_sma", "SELECT symbol, \"timestamp\", " + ", ".join(f"{sma_sql(p)} AS sma_{p}" for p in STANDARD_PERIODS) + " FROM cent_bars", uses="cent_bars")
def sma(spark, sf_dir):
    wanted = _named("sma")
    return ma.add_averages(fx.cent_bars(spark, sf_dir), wanted).select("symbol", "timestamp", *wanted)


@query("w05_sma_parts", "SELECT symbol, \"timestamp\", " + ", ".join(f"{sma_sql(p)} AS sma_{p}" for p in (5, 10, 20)) + " FROM part_bars", uses="part_bars")
def sma_parts(spark, sf_dir):
    wanted = _named("sma", (5, 10, 20))
    return ma.add_averages(fx.part_bars(spark, sf_dir), wanted).select("symbol", "timestamp", *wanted)


@query("w06_ema", ema_query("cent_bars", {f"ema_{p}": (p, "close") for p in STANDARD_PERIODS}, 0), uses="cent_bars")
def ema(spark, sf_dir):
    wanted = _named("ema")
    return rounded(ma.add_averages(fx.cent_bars(spark, sf_dir), wanted), wanted, 0)


@query("w06_ema_ticks", ema_query("tick_bars", {f"ema_{p}": (p, "close") for p in (2, 20, 200)}, 2), uses="tick_bars")
def ema_ticks(spark, sf_dir):
    wanted = _named("ema", (2, 20, 200))
    return rounded(ma.add_averages(fx.tick_bars(spark, sf_dir), wanted), wanted, 2)


@query("w06_ema_parts", ema_query("part_bars", {f"ema_{p}": (p, "close") for p in (5, 10, 20)}, 0), uses="part_bars")
def ema_parts(spark, sf_dir):
    wanted = _named("ema", (5, 10, 20))
    return rounded(ma.add_averages(fx.part_bars(spark, sf_dir), wanted), wanted, 0)


@query("w07_wma", "SELECT symbol, \"timestamp\", " + ", ".join(f"{wma_sql(p)} AS wma_{p}" for p in STANDARD_PERIODS) + " FROM cent_bars", uses="cent_bars")
def wma(spark, sf_dir):
    wanted = _named("wma")
    return ma.add_averages(fx.cent_bars(spark, sf_dir), wanted).select("symbol", "timestamp", *wanted)


@query("f05_weighted_average", f"SELECT symbol, \"timestamp\", {wma_sql(7)} AS wma_7 FROM part_bars", uses="part_bars")
def weighted_average(spark, sf_dir):
    wanted = _named("wma", (7,))
    return ma.add_averages(fx.part_bars(spark, sf_dir), wanted).select("symbol", "timestamp", "wma_7")


@query("w08_volume_averages", f"""SELECT s.symbol, s."timestamp", s.sma_volume, e.ema_volume FROM (
  SELECT symbol, "timestamp", {sma_sql(20, "volume")} AS sma_volume FROM cent_bars) s
JOIN ({ema_query("cent_bars", {"ema_volume": (20, "volume")}, 6)}) e ON s.symbol = e.symbol AND s."timestamp" = e."timestamp" """, uses="cent_bars")
def volume_averages(spark, sf_dir):
    wanted = {"sma_volume": ("sma", "volume", 20), "ema_volume": ("ema", "volume", 20)}
    out = ma.add_averages(fx.cent_bars(spark, sf_dir), wanted)
    return out.select("symbol", "timestamp", "sma_volume", F.round("ema_volume", 6).alias("ema_volume"))


@query("w09_named_average", f"""SELECT a.symbol, a."timestamp", a.sma_15, a.wma_15, e.ema_15 FROM (
  SELECT symbol, "timestamp", {sma_sql(15)} AS sma_15, {wma_sql(15)} AS wma_15 FROM part_bars) a
JOIN ({ema_query("part_bars", {"ema_15": (15, "close")}, 0)}) e ON a.symbol = e.symbol AND a."timestamp" = e."timestamp" """, uses="part_bars")
def named_average(spark, sf_dir):
    bars = fx.part_bars(spark, sf_dir)
    sizes = ma.symbol_sizes(bars)
    for kind in ("SMA", "Ema", "wma"):
        bars = bars.transform(ma.moving_average("close", 15, kind, sizes=sizes))
    return bars.select("symbol", "timestamp", "sma_15", "wma_15", F.round("ema_15", 0).alias("ema_15"))


def _by_period_sql(bars, p):
    averages = ema_query(bars, {"ema": (p, "close"), "ema_volume": (p, "volume")}, 0)
    return f"""SELECT a.symbol, a."timestamp", {p} AS period, a.sma, a.sma_volume, e.ema, e.ema_volume, a.wma FROM (
  SELECT symbol, "timestamp", {sma_sql(p)} AS sma, {sma_sql(p, "volume")} AS sma_volume, {wma_sql(p)} AS wma FROM {bars}) a
JOIN ({averages}) e ON a.symbol = e.symbol AND a."timestamp" = e."timestamp" """


@query("w10_averages_by_period", " UNION ALL ".join(_by_period_sql("cent_bars", p) for p in STANDARD_PERIODS), uses="cent_bars")
def by_period(spark, sf_dir):
    long = ma.averages_by_period(fx.cent_bars(spark, sf_dir))
    return long.withColumns({"ema": F.round("ema", 0), "ema_volume": F.round("ema_volume", 0)})


@query("w11_display_averages", f"""SELECT s.*, {", ".join(f"e.disp_ema_{p}" for p in DEFAULT_DISPLAY_PERIODS)} FROM (
  SELECT symbol, "timestamp", {", ".join(f"{sma_sql(p)} AS disp_sma_{p}" for p in DEFAULT_DISPLAY_PERIODS)} FROM cent_bars) s
JOIN ({ema_query("cent_bars", {f"disp_ema_{p}": (p, "close") for p in DEFAULT_DISPLAY_PERIODS}, 0)}) e
ON s.symbol = e.symbol AND s."timestamp" = e."timestamp" """, uses="cent_bars")
def display(spark, sf_dir):
    out = ma.display_averages(fx.cent_bars(spark, sf_dir), DEFAULT_DISPLAY_PERIODS)
    names = [f"disp_ema_{p}" for p in DEFAULT_DISPLAY_PERIODS]
    return out.select("symbol", "timestamp", *[f"disp_sma_{p}" for p in DEFAULT_DISPLAY_PERIODS],
                      *[F.round(F.col(n), 0).alias(n) for n in names])


@query("f06_average_columns", """SELECT kind || '_' || period AS column_name, count(*) AS n
FROM cent_bars CROSS JOIN (SELECT unnest(['sma', 'ema', 'wma']) AS kind) CROSS JOIN (
  SELECT unnest([5, 10, 20, 50, 100, 200]) AS period) GROUP BY ALL""", uses="cent_bars")
def average_columns(spark, sf_dir):
    out = ma.standard_averages(fx.cent_bars(spark, sf_dir))
    names = [c for c in out.columns if c.split("_")[0] in ma.KINDS]
    counts = out.agg(*[F.count(c).alias(c) for c in names])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in names
    ])).alias("r")).select("r.*")


_FULL = "SELECT * FROM part_bars WHERE volume % 7 <> 0"


@query("w05_missing_values", f"""SELECT p.symbol, p."timestamp", a.sma_3, a.sma_50, a.wma_5 FROM part_bars p LEFT JOIN (
  SELECT symbol, "timestamp", {sma_sql(3)} AS sma_3, {sma_sql(50)} AS sma_50, {wma_sql(5)} AS wma_5 FROM ({_FULL})) a
ON a.symbol = p.symbol AND a."timestamp" = p."timestamp" """, uses="part_bars")
def missing_values(spark, sf_dir):
    """Bars without a close count in no frame, on the short path (SMA 3) and on the other."""
    bars = fx.part_bars(spark, sf_dir).withColumn("close", F.when(F.col("volume") % 7 != 0, F.col("close")))
    sizes = ma.symbol_sizes(bars)
    short = ma.add_averages(bars, {"sma_3": ("sma", "close", 3)}, sizes)
    out = ma.add_averages(short, {"sma_50": ("sma", "close", 50), "wma_5": ("wma", "close", 5)}, sizes)
    return out.select("symbol", "timestamp", "sma_3", "sma_50", "wma_5")
