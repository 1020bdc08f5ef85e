"""Bars derived from the driver tables, in Spark and as the same text for the SQL check.

Prices come in whole cents where averages are compared, so that sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidebars.operators.runs import ordered_runs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: symbol is the customer's market segment; keys repeat."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_mktsegment").alias("symbol"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("timestamp"),
        F.col("o_totalprice").alias("close"),
        F.col("o_orderkey").alias("ordinal"),
    )


def _roll_up(rows: DataFrame, price: str, first: F.Column, last: F.Column, volume) -> DataFrame:
    return rows.groupBy("symbol", "timestamp").agg(
        first.alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        last.alias("close"),
        volume.alias("volume"),
    )


def segment_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few long symbols: orders per market segment and day."""
    return _roll_up(order_rows(spark, sf_dir), "close", F.min_by("close", "ordinal"), F.max_by("close", "ordinal"), F.count(F.lit(1)))


def in_cents(bars: DataFrame) -> DataFrame:
    return bars.select("symbol", "timestamp", *[F.round(F.col(c) * 100).alias(c) for c in ("open", "high", "low", "close")], "volume")


def cent_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_cents(segment_bars(spark, sf_dir))


def smooth_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing mean of 100 days of orders: closes that reach all five states."""
    daily = order_rows(spark, sf_dir).groupBy("symbol", "timestamp").agg(
        F.sum(F.round(F.col("close") * 100).cast("bigint")).alias("cents"), F.count(F.lit(1)).alias("volume")
    )
    runs = ordered_runs(daily, back=99)
    frame = runs.rows(-99, 0)
    mean = F.sum("cents").over(frame).cast("double") / F.sum("volume").over(frame).cast("double") / 100
    out = runs.finish(runs.df.withColumn("close", mean))
    return out.select("symbol", "timestamp", *[F.col("close").alias(c) for c in ("open", "high", "low", "close")], "volume")


def part_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many short symbols: lines per part and ship day, in cents."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("symbol"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("timestamp"),
        F.round(F.col("l_extendedprice") * 100).alias("price"),
        "l_orderkey", "l_linenumber", "l_quantity",
    )
    order = F.struct("l_orderkey", "l_linenumber", "price")
    # The order ends with the price, so its least and its largest value hold the prices too.
    return _roll_up(lines, "price", F.min(order)["price"], F.max(order)["price"], F.sum("l_quantity").cast("bigint"))


def tick_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ticks per event type, in cents; some closes are zero."""
    cents = F.round(F.col("value") * 100)
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        *[cents.alias(c) for c in ("open", "high", "low", "close")], F.lit(1).cast("bigint").alias("volume"),
    )


def dirty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text with the faults a vendor file may hold; ``ordinal`` gives the input order."""
    k = F.col("ordinal")
    price = F.col("close").cast("decimal(12,2)").cast("string")
    close = (
        F.when(k % 61 == 0, "1d").when(k % 67 == 0, "nan").when(k % 71 == 0, "").otherwise(price)
    )
    return order_rows(spark, sf_dir).select(
        F.when(k % 41 == 0, F.concat(F.lit("  "), "symbol", F.lit("\t")))
        .when(k % 43 == 0, F.lit(None).cast("string")).otherwise(F.col("symbol")).alias("symbol"),
        F.when(k % 53 == 0, "01/02/2024").when(k % 59 == 0, "bad")
        .otherwise(F.date_format("timestamp", "yyyy-MM-dd")).alias("timestamp"),
        *[close.alias(c) for c in ("open", "high", "low", "close")],
        F.when(k % 73 == 0, F.concat((k % 100).cast("string"), F.lit(".5")))
        .otherwise((k % 100).cast("string")).alias("volume"),
        "ordinal",
    )
