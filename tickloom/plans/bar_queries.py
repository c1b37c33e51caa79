"""Registered queries on bars, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import analytics
from ..operators.bars import bars, bars_from_ids, bars_sweep, tick_bars
from ..operators.tick_rule import day, with_side
from ..trades import trades_ev, trades_ord

THRESHOLD = 100_000.0
ORDERS_THRESHOLD = 5_000_000.0
VOLUME = 5_000.0
#: Trades of a chunk, for the tick rule that starts afresh in each.
CHUNK = 500
IMBALANCE = {"init_ticks": 20, "alpha_ticks": 0.5, "alpha_imbalance": 0.5, "time_reset": 5.0}
OLDER = {"init_t": 50_000.0, "alpha_volume": 0.5, "alpha_imbalance": 0.5}
GRID = [{"threshold": 50_000.0}, {"threshold": 100_000.0}, {"threshold": 250_000.0}]

EV = """tr AS (SELECT event_type AS symbol, event_id AS trade_id, epoch_us(ts) // 1000 AS ms, value AS price,
  (CAST(json_extract_string(props, '$.k') AS INT) + 1)::DOUBLE AS qty,
  value * (CAST(json_extract_string(props, '$.k') AS INT) + 1)::DOUBLE AS quote_qty FROM events)"""
ORD = "tr AS (SELECT o_orderpriority AS symbol, o_orderkey AS trade_id, epoch_ms(o_orderdate) AS ms, o_totalprice AS price, 1.0::DOUBLE AS qty, o_totalprice AS quote_qty FROM orders)"
SIGNED = """lagged AS (SELECT *, lag(price) OVER w AS before, row_number() OVER w AS rn FROM tr WINDOW w AS (PARTITION BY symbol ORDER BY ms, trade_id)),
raw AS (SELECT *, CASE WHEN before > price THEN 1 WHEN before < price THEN -1 END AS r FROM lagged),
filled AS (SELECT *, coalesce(last_value(r IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ms, trade_id ROWS UNBOUNDED PRECEDING), 1)::TINYINT AS side FROM raw),
sg AS (SELECT *, quote_qty * side AS net FROM filled)"""
#: Sums carried from trade to trade; c tells that the trade before closed its bar.
CARRY = """CASE WHEN w.closed THEN 0.0 ELSE w.th END + s.net AS th, CASE WHEN w.closed THEN 0.0 ELSE w.usd END + abs(s.net) AS usd,
CASE WHEN w.closed THEN 0.0 ELSE w.vol END + s.qty AS vol, CASE WHEN s.side > 0 THEN CASE WHEN w.closed THEN 0.0 ELSE w.buy END + s.net ELSE CASE WHEN w.closed THEN 0.0 ELSE w.buy END END AS buy,
w.bar + w.closed::INT AS bar"""
BAR_OF = """bar_of AS (SELECT w.*, s.price, s.ms, s.side FROM walk w JOIN sg s USING (symbol, rn)),
shape AS (SELECT symbol, bar, min(ms) AS start_time, max(ms) AS end_time, arg_min(price, rn) AS open, max(price) AS high, min(price) AS low, arg_max(price, rn) AS close,
  arg_max(th, rn) AS theta_k, arg_max(buy, rn) AS total_volume_buy_usd, arg_max(usd, rn) AS total_volume_usd, arg_max(vol, rn) AS total_volume,
  count(*) AS ticks, count(*) FILTER (WHERE side > 0) AS ticks_buy, bool_or(closed) AS closed, max(rn) AS last_rn FROM bar_of GROUP BY symbol, bar)"""
FIELDS = "symbol, bar::BIGINT AS bar_id, start_time, end_time, open, high, low, close, theta_k, total_volume_buy_usd, total_volume_usd, total_volume, ticks, ticks_buy"


def simple_walk(trigger: str) -> str:
    """Bars that close when ``trigger`` (of the carried sums) holds."""
    return f"""walk AS (
  SELECT symbol, 0::BIGINT AS rn, 0.0::DOUBLE AS th, 0.0::DOUBLE AS usd, 0.0::DOUBLE AS vol, 0.0::DOUBLE AS buy, 0 AS bar, false AS closed FROM (SELECT DISTINCT symbol FROM tr)
  UNION ALL
  SELECT x.symbol, x.rn, x.th, x.usd, x.vol, x.buy, x.bar, {trigger} FROM (SELECT s.symbol, s.rn, {CARRY} FROM walk w JOIN sg s ON s.symbol = w.symbol AND s.rn = w.rn + 1) x)"""


def bars_sql(source: str, trigger: str, tail: str = "") -> str:
    return f"WITH RECURSIVE {source}, {SIGNED}, {simple_walk(trigger)}, {BAR_OF} " + (tail or f"SELECT {FIELDS} FROM shape WHERE closed")


SIDES_SQL = f"WITH {EV}, {SIGNED} SELECT symbol, trade_id, side::INT AS side FROM sg"
STANDARD_SQL = bars_sql(EV, f"x.usd >= {THRESHOLD}")


def imbalance_sql(flow: str) -> str:
    """Bars by the imbalance of ``flow``: th, the signed quote volume, or tk, bought trades less sold ones."""
    return f"""WITH RECURSIVE {EV}, {SIGNED},
walk AS (
  SELECT symbol, 0::BIGINT AS rn, 0.0::DOUBLE AS th, 0.0::DOUBLE AS usd, 0.0::DOUBLE AS vol, 0.0::DOUBLE AS buy, 0 AS bar, false AS closed, 0.0::DOUBLE AS tk,
    0::BIGINT AS n, 0::BIGINT AS start, 20.0::DOUBLE AS et, 0.0::DOUBLE AS ei, true AS warm, 20.0::DOUBLE AS thr FROM (SELECT DISTINCT symbol FROM tr)
  UNION ALL
  SELECT z.symbol, z.rn, z.th, z.usd, z.vol, z.buy, z.bar, z.closed, z.tk, z.n, z.start, z.et, z.ei,
    CASE WHEN z.closed THEN z.ms - z.start > 18000000.0 ELSE z.warm END, CASE WHEN z.closed THEN CASE WHEN z.ms - z.start > 18000000.0 THEN 20.0 ELSE z.et * z.ei END ELSE z.thr END
  FROM (SELECT y.* EXCLUDE (et, ei),
      CASE WHEN NOT y.closed THEN y.et WHEN y.warm THEN y.n::DOUBLE ELSE y.et + 0.5 * (y.n - y.et) END AS et,
      CASE WHEN NOT y.closed THEN y.ei WHEN y.warm THEN abs(y.{flow}) / y.n ELSE y.ei + 0.5 * (abs(y.{flow}) / y.n - y.ei) END AS ei
    FROM (SELECT x.*, CASE WHEN x.warm THEN x.n ELSE abs(x.{flow}) END >= x.thr AS closed
      FROM (SELECT s.symbol, s.rn, s.ms, {CARRY}, CASE WHEN w.closed THEN 0.0 ELSE w.tk END + s.side AS tk,
          CASE WHEN w.closed THEN 0 ELSE w.n END + 1 AS n, CASE WHEN w.closed OR w.n = 0 THEN s.ms ELSE w.start END AS start, w.et, w.ei, w.warm, w.thr
        FROM walk w JOIN sg s ON s.symbol = w.symbol AND s.rn = w.rn + 1) x) y) z),
{BAR_OF}
SELECT {FIELDS}, e.et AS "ewma_T", e.ei AS ewma_imbalance FROM shape JOIN (SELECT symbol, rn, et, ei FROM walk) e USING (symbol) WHERE closed AND e.rn = shape.last_rn"""


IMBALANCE_SQL = imbalance_sql("th")
OLDER_WALK = f"""WITH RECURSIVE {EV}, {SIGNED},
walk AS (
  SELECT symbol, 0::BIGINT AS rn, 0.0::DOUBLE AS th, 0.0::DOUBLE AS usd, 0.0::DOUBLE AS vol, 0.0::DOUBLE AS buy, 0 AS bar, false AS closed, 50000.0::DOUBLE AS et, 1.0::DOUBLE AS dif, 50000.0::DOUBLE AS thr FROM (SELECT DISTINCT symbol FROM tr)
  UNION ALL
  SELECT z.symbol, z.rn, z.th, z.usd, z.vol, z.buy, z.bar, z.closed, z.et, z.dif, CASE WHEN z.closed THEN z.et * abs(z.dif) ELSE z.thr END
  FROM (SELECT y.* EXCLUDE (et, dif, share), CASE WHEN NOT y.closed THEN y.et WHEN y.dif = 1.0 THEN y.usd ELSE y.et + 0.5 * (y.usd - y.et) END AS et,
      CASE WHEN NOT y.closed THEN y.dif WHEN y.dif = 1.0 THEN y.share ELSE y.dif + 0.5 * (y.share - y.dif) END AS dif
    FROM (SELECT x.*, abs(x.th) >= x.thr AS closed, CASE WHEN x.usd = 0 THEN 1.0 ELSE abs(2 * x.buy / x.usd - 1) END AS share
      FROM (SELECT s.symbol, s.rn, {CARRY}, w.et, w.dif, w.thr FROM walk w JOIN sg s ON s.symbol = w.symbol AND s.rn = w.rn + 1) x) y) z),
{BAR_OF} """

CHUNKED_SQL = STANDARD_SQL.replace(
    "lag(price) OVER w AS before", f"lag(price) OVER (PARTITION BY symbol, trade_id // {CHUNK} ORDER BY ms, trade_id) AS before"
).replace("OVER (PARTITION BY symbol ORDER BY ms, trade_id ROWS", f"OVER (PARTITION BY symbol, trade_id // {CHUNK} ORDER BY ms, trade_id ROWS")
RUN_SQL = f"""WITH RECURSIVE {EV}, {SIGNED},
walk AS (
  SELECT symbol, 0::BIGINT AS rn, 0.0::DOUBLE AS th, 0.0::DOUBLE AS usd, 0.0::DOUBLE AS vol, 0.0::DOUBLE AS buy, 0 AS bar, false AS closed,
    0::BIGINT AS start, NULL::DOUBLE AS et, NULL::DOUBLE AS sh, 50000.0::DOUBLE AS thr FROM (SELECT DISTINCT symbol FROM tr)
  UNION ALL
  SELECT z.symbol, z.rn, z.th, z.usd, z.vol, z.buy, z.bar, z.closed, z.start, z.et, z.sh,
    CASE WHEN NOT z.closed THEN z.thr WHEN z.ms - z.start > 14400000.0 THEN 50000.0::DOUBLE ELSE z.et * z.sh END
  FROM (SELECT y.* EXCLUDE (et, sh, share),
      CASE WHEN NOT y.closed THEN y.et WHEN y.et IS NULL THEN y.usd ELSE y.et + 0.1::DOUBLE * (y.usd - y.et) END AS et,
      CASE WHEN NOT y.closed THEN y.sh WHEN y.et IS NULL THEN y.share ELSE y.sh + 0.1::DOUBLE * (y.share - y.sh) END AS sh
    FROM (SELECT x.*, greatest(x.buy, x.usd - x.buy) >= x.thr AS closed, CASE WHEN x.usd = 0 THEN 1.0 ELSE greatest(x.buy, x.usd - x.buy) / x.usd END AS share
      FROM (SELECT s.symbol, s.rn, s.ms, {CARRY}, CASE WHEN w.closed OR w.rn = 0 THEN s.ms ELSE w.start END AS start, w.et, w.sh, w.thr
        FROM walk w JOIN sg s ON s.symbol = w.symbol AND s.rn = w.rn + 1) x) y) z),
{BAR_OF} SELECT {FIELDS} FROM shape WHERE closed"""


def with_bars(query):
    """Queries over the standard bars of the event trades."""
    return lambda spark, d: query(bars(trades_ev(spark, d), "standard", {"threshold": THRESHOLD}))


def rounded(df, columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


QUERIES = {
    "tick_rule_side": lambda spark, d: with_side(trades_ev(spark, d)).select("symbol", "trade_id", F.col("side").cast("int").alias("side")),
    "tick_rule_side_by_days": lambda spark, d: with_side(trades_ev(spark, d), block=day()).select("symbol", "trade_id", F.col("side").cast("int").alias("side")),
    "net_volume": lambda spark, d: with_side(trades_ev(spark, d)).select("symbol", "trade_id", "net"),
    "standard_dollar_bars": lambda spark, d: bars(trades_ev(spark, d), "standard", {"threshold": THRESHOLD}),
    "standard_dollar_bars_partial": lambda spark, d: bars(trades_ev(spark, d), "standard", {"threshold": THRESHOLD}, emit_partial=True),
    "standard_dollar_bars_ties": lambda spark, d: bars(trades_ord(spark, d), "standard", {"threshold": ORDERS_THRESHOLD}),
    "imbalance_dollar_bars": lambda spark, d: bars(trades_ev(spark, d), "imbalance", IMBALANCE),
    "tick_imbalance_bars": lambda spark, d: bars(trades_ev(spark, d), "tick_imbalance", IMBALANCE),
    "volume_imbalance_bars": lambda spark, d: bars(trades_ev(spark, d), "volume_imbalance", OLDER, emit_partial=True),
    "volume_imbalance_params": lambda spark, d: bars(trades_ev(spark, d), "volume_imbalance", OLDER, trace=True),
    "bars_param_sweep": lambda spark, d: bars_sweep(trades_ev(spark, d), "standard", GRID).withColumn("param_id", F.col("param_id").cast("int")),
    "volume_bars": lambda spark, d: bars(trades_ev(spark, d), "volume", {"threshold": VOLUME}),
    "standard_dollar_bars_chunked": lambda spark, d: bars(trades_ev(spark, d).withColumn("chunk", F.floor(F.col("trade_id") / CHUNK)), "standard", {"threshold": THRESHOLD}, reset_key="chunk"),
    "run_dollar_bars": lambda spark, d: bars(trades_ev(spark, d), "run", {"init_t": 50_000.0}),
    "tick_bars": lambda spark, d: rounded(tick_bars(trades_ev(spark, d), 100), ["theta_k", "total_volume_buy_usd", "total_volume_usd"], 4),
    "bar_ohlcv_from_ids": lambda spark, d: rounded(bars_from_ids(with_side(trades_ord(spark, d)).withColumn("bar_id", F.floor(F.col("trade_id") / 64))), ["theta_k", "total_volume_buy_usd", "total_volume_usd"], 2),
    "bars_sell_volume": with_bars(lambda b: b.select("symbol", "bar_id", (F.col("total_volume_buy_usd") - F.col("total_volume_usd")).alias("total_volume_sell_usd"))),
    "bars_log_series": with_bars(lambda b: b.select("symbol", "bar_id", F.round(F.log(F.greatest("close", F.lit(0.01))), 9).alias("log_close"))),
    "bar_gaps": with_bars(lambda b: analytics.gaps(b)),
    "bars_gap_stats": with_bars(lambda b: rounded(analytics.describe(analytics.gaps(b), ["gap_minutes"], ("symbol",)), ["mean", "std", "low", "q25", "q50", "q75", "high"])),
    "bars_describe": with_bars(lambda b: rounded(analytics.describe(b, ["open", "high", "low", "close", "total_volume_usd"], ("symbol",)), ["mean", "std", "low", "q25", "q50", "q75", "high"])),
    "bars_per_day": with_bars(lambda b: b.groupBy("symbol").agg(F.round(F.count("*") / ((F.max("end_time") - F.min("start_time")) / 86_400_000.0), 6).alias("bars_per_day"))),
    "imbalance_threshold": lambda spark, d: bars(trades_ev(spark, d), "imbalance", IMBALANCE).select("symbol", "bar_id", (F.col("ewma_T") * F.col("ewma_imbalance")).alias("thres")),
}


def _stats(column: str, source: str) -> str:
    return f"""SELECT symbol, '{column}' AS "column", count(x) AS n, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, round(min(x), 6) AS low, round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.5), 6) AS q50, round(quantile_cont(x, 0.75), 6) AS q75, round(max(x), 6) AS high
  FROM (SELECT symbol, {column}::DOUBLE AS x FROM {source}) GROUP BY symbol"""


BARS = f"bars AS (SELECT {FIELDS} FROM shape WHERE closed)"
GAPS = "gaps AS (SELECT symbol, bar_id, (end_time - lag(end_time) OVER (PARTITION BY symbol ORDER BY bar_id)) / 60000.0::DOUBLE AS gap_minutes FROM bars QUALIFY gap_minutes IS NOT NULL)"


def over_bars(tail: str, more: str = "") -> str:
    return bars_sql(EV, f"x.usd >= {THRESHOLD}", f", {BARS} {more} {tail}")


SUMS = """min(ms) AS start_time, max(ms) AS end_time, arg_min(price, (ms, trade_id)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (ms, trade_id)) AS close,
round(sum(net), {0}) AS theta_k, round(sum(CASE WHEN side > 0 THEN net ELSE 0.0 END), {0}) AS total_volume_buy_usd, round(sum(abs(net)), {0}) AS total_volume_usd, sum(qty) AS total_volume, count(*) AS ticks, count(*) FILTER (WHERE side > 0) AS ticks_buy"""

ORACLE = {
    "tick_rule_side": SIDES_SQL,
    "tick_rule_side_by_days": SIDES_SQL,
    "net_volume": f"WITH {EV}, {SIGNED} SELECT symbol, trade_id, net FROM sg",
    "standard_dollar_bars": STANDARD_SQL,
    "standard_dollar_bars_partial": bars_sql(EV, f"x.usd >= {THRESHOLD}", f"SELECT {FIELDS} FROM shape"),
    "standard_dollar_bars_ties": bars_sql(ORD, f"x.usd >= {ORDERS_THRESHOLD}"),
    "standard_dollar_bars_chunked": CHUNKED_SQL,
    "run_dollar_bars": RUN_SQL,
    "volume_bars": bars_sql(EV, f"x.vol >= {VOLUME}"),
    "imbalance_dollar_bars": IMBALANCE_SQL,
    "tick_imbalance_bars": imbalance_sql("tk"),
    "imbalance_threshold": f'SELECT symbol, bar_id, "ewma_T" * ewma_imbalance AS thres FROM ({IMBALANCE_SQL})',
    "volume_imbalance_bars": OLDER_WALK + "SELECT symbol, bar::BIGINT AS bar_id, start_time, end_time, open, high, low, close, theta_k AS imbalance_col, total_volume_buy_usd, total_volume_usd, total_volume FROM shape",
    "volume_imbalance_params": OLDER_WALK + "SELECT symbol, bar::BIGINT AS bar_id, et AS ewma_volume, dif AS ewma_dif, thr AS thres FROM walk WHERE closed",
    "bars_param_sweep": " UNION ALL ".join(f"SELECT {i} AS param_id, * FROM ({bars_sql(EV, f'x.usd >= {g["threshold"]}')})" for i, g in enumerate(GRID)),
    "tick_bars": f"WITH {EV}, {SIGNED} SELECT symbol, (rn - 1) // 100 AS bar_id, {SUMS.format(4)} FROM sg GROUP BY ALL",
    "bar_ohlcv_from_ids": f"WITH {ORD}, {SIGNED} SELECT symbol, trade_id // 64 AS bar_id, {SUMS.format(2)} FROM sg GROUP BY ALL",
    "bars_sell_volume": over_bars("SELECT symbol, bar_id, total_volume_buy_usd - total_volume_usd AS total_volume_sell_usd FROM bars"),
    "bars_log_series": over_bars("SELECT symbol, bar_id, round(ln(greatest(close, 0.01)), 9) AS log_close FROM bars"),
    "bar_gaps": over_bars("SELECT * FROM gaps", f", {GAPS}"),
    "bars_gap_stats": over_bars(_stats("gap_minutes", "gaps"), f", {GAPS}"),
    "bars_describe": over_bars(" UNION ALL ".join(_stats(c, "bars") for c in ("open", "high", "low", "close", "total_volume_usd"))),
    "bars_per_day": over_bars("SELECT symbol, round(count(*) / ((max(end_time) - min(start_time)) / 86400000.0::DOUBLE), 6) AS bars_per_day FROM bars GROUP BY symbol"),
}
