"""The fixtures of ``fixtures.py`` as SQL, and a helper that prefixes a query with those it needs."""

from __future__ import annotations

# The number text accepted by the coercion.
NUMBER = r"'^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$'"

BAR = 'symbol, "timestamp", open, high, low, close, volume'

STATE_CASE = """CASE WHEN ret > 0.005 THEN 'Strong Up' WHEN ret > 0.001 THEN 'Slight Up'
 WHEN ret < -0.005 THEN 'Strong Down' WHEN ret < -0.001 THEN 'Slight Down'
 WHEN ret IS NOT NULL THEN 'Stable' END"""

# Name: (the ones it reads, text).
FIXTURES: dict[str, tuple[tuple[str, ...], str]] = {
    "order_rows": ((), """
  SELECT c_mktsegment AS symbol, o_orderdate AS "timestamp", o_totalprice AS close, o_orderkey AS ordinal
  FROM orders JOIN customer ON o_custkey = c_custkey"""),
    "segment_bars": (("order_rows",), """
  SELECT symbol, "timestamp", arg_min(close, ordinal) AS open, max(close) AS high, min(close) AS low,
         arg_max(close, ordinal) AS close, count(*) AS volume
  FROM order_rows GROUP BY symbol, "timestamp" """),
    "cent_bars": (("segment_bars",), """
  SELECT symbol, "timestamp", round(open * 100) AS open, round(high * 100) AS high, round(low * 100) AS low,
         round(close * 100) AS close, volume FROM segment_bars"""),
    "order_days": (("order_rows",), """
  SELECT symbol, "timestamp", CAST(sum(CAST(round(close * 100) AS BIGINT)) AS BIGINT) AS cents, count(*) AS volume
  FROM order_rows GROUP BY symbol, "timestamp" """),
    "smooth_bars": (("order_days",), """
  SELECT symbol, "timestamp", volume,
         CAST(sum(cents) OVER w AS DOUBLE) / CAST(sum(volume) OVER w AS DOUBLE) / 100 AS close
  FROM order_days
  WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp" ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)"""),
    "returns": (("smooth_bars",), """
  SELECT symbol, "timestamp", close, CASE WHEN p = 0 THEN 0.0 ELSE (close - p) / p END AS ret
  FROM (SELECT symbol, "timestamp", close, lag(close) OVER (PARTITION BY symbol ORDER BY "timestamp") AS p FROM smooth_bars)"""),
    "states": (("returns",), f"""
  SELECT symbol, "timestamp", close, ret, {STATE_CASE} AS state FROM returns"""),
    "features": (("states",), """
  SELECT symbol, "timestamp", market_state, target_state, r AS ret_lag_0,
         lag(r, 1) OVER w AS ret_lag_1, lag(r, 2) OVER w AS ret_lag_2, lag(r, 5) OVER w AS ret_lag_5,
         lag(r, 10) OVER w AS ret_lag_10, lag(r, 20) OVER w AS ret_lag_20
  FROM (SELECT symbol, "timestamp", state AS market_state, lead(state) OVER w AS target_state,
               close / lag(close) OVER w - 1 AS r
        FROM states WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp"))
  WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp")"""),
    "part_lines": ((), """
  SELECT concat('P', l_partkey) AS symbol, l_shipdate AS "timestamp", round(l_extendedprice * 100) AS price,
         l_orderkey, l_linenumber, l_quantity FROM lineitem"""),
    "part_bars": (("part_lines",), """
  SELECT symbol, "timestamp", arg_min(price, row(l_orderkey, l_linenumber, price)) AS open, max(price) AS high,
         min(price) AS low, arg_max(price, row(l_orderkey, l_linenumber, price)) AS close,
         CAST(sum(l_quantity) AS BIGINT) AS volume
  FROM part_lines GROUP BY symbol, "timestamp" """),
    "tick_bars": ((), """
  SELECT event_type AS symbol, ts AS "timestamp", round(value * 100) AS close, 1 AS volume FROM events"""),
    "tick_features": (("tick_bars",), f"""
  SELECT symbol, "timestamp", market_state, lead(market_state) OVER w AS target_state, r AS ret_lag_0,
         lag(r, 1) OVER w AS ret_lag_1, lag(r, 2) OVER w AS ret_lag_2, lag(r, 5) OVER w AS ret_lag_5,
         lag(r, 10) OVER w AS ret_lag_10, lag(r, 20) OVER w AS ret_lag_20
  FROM (SELECT *, {STATE_CASE} AS market_state FROM (
    SELECT symbol, "timestamp", CASE WHEN p = 0 THEN 0.0 ELSE (close - p) / p END AS ret, close / nullif(p, 0) - 1 AS r
    FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY "timestamp") AS p FROM tick_bars)))
  WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp")"""),
    "dirty_rows": (("order_rows",), """
  SELECT CASE WHEN ordinal % 41 = 0 THEN concat('  ', symbol, chr(9)) WHEN ordinal % 43 = 0 THEN NULL
              ELSE symbol END AS symbol,
         CASE WHEN ordinal % 53 = 0 THEN '01/02/2024' WHEN ordinal % 59 = 0 THEN 'bad'
              ELSE strftime("timestamp", '%Y-%m-%d') END AS "timestamp",
         CASE WHEN ordinal % 61 = 0 THEN '1d' WHEN ordinal % 67 = 0 THEN 'nan' WHEN ordinal % 71 = 0 THEN ''
              ELSE CAST(CAST(close AS DECIMAL(12,2)) AS VARCHAR) END AS close,
         CASE WHEN ordinal % 73 = 0 THEN concat(ordinal % 100, '.5') ELSE CAST(ordinal % 100 AS VARCHAR) END AS volume,
         ordinal FROM order_rows"""),
    "typed_rows": (("dirty_rows",), f"""
  SELECT regexp_replace(symbol, '^\\s+|\\s+$', '', 'g') AS symbol,
         CAST(try_strptime("timestamp", '%Y-%m-%d') AS TIMESTAMP) AS "timestamp",
         CASE WHEN regexp_matches(close, {NUMBER}) THEN TRY_CAST(close AS DOUBLE) END AS close,
         CASE WHEN regexp_matches(volume, {NUMBER}) THEN TRY_CAST(volume AS DOUBLE) END AS raw_volume,
         ordinal FROM dirty_rows"""),
    "coerced_rows": (("typed_rows",), """
  SELECT symbol, "timestamp", close AS open, close AS high, close AS low, close,
         CAST(round_even(raw_volume, 0) AS BIGINT) AS volume, ordinal
  FROM typed_rows
  WHERE symbol IS NOT NULL AND "timestamp" IS NOT NULL AND close IS NOT NULL AND raw_volume IS NOT NULL"""),
    "kept": (("coerced_rows",), f"""
  SELECT {BAR} FROM coerced_rows
  QUALIFY row_number() OVER (PARTITION BY symbol, "timestamp" ORDER BY ordinal) = 1"""),
    "faulty": (("segment_bars",), """
  SELECT symbol, "timestamp", open, high,
         CASE WHEN symbol = 'BUILDING' AND day("timestamp") = 13 THEN -low ELSE low END AS low, close,
         CASE WHEN symbol = 'MACHINERY' AND day("timestamp") = 13 THEN -volume ELSE volume END AS volume
  FROM segment_bars"""),
}


def _needed(names, seen):
    for name in names:
        _needed(FIXTURES[name][0], seen)
        seen.setdefault(name, FIXTURES[name][1])
    return seen


def using(names: str, body: str) -> str:
    """``body`` behind a WITH clause of the named fixtures and what they read."""
    ctes = _needed(names.split(), {})
    return "WITH " + ", ".join(f"{n} AS ({text})" for n, text in ctes.items()) + "\n" + body
