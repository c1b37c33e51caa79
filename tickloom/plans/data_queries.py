"""Registered queries on calendars, quality, merges and scalars, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import analytics, calendar, merge
from ..sources import footers, inventory, rolling
from ..trades import table, trades_ev

FIRST, LAST, MARK = "1995-01-01", "2001-08-01", "2024-01-20"


def orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("symbol"), "o_totalprice", F.to_date("o_orderdate").alias("day"), "o_orderdate", "o_custkey", "o_orderstatus")


def order_days(spark, d):
    return orders(spark, d).select("symbol", "day").distinct()


def holes(spark, d):
    """Months of the orders without those that a rule takes out."""
    return orders(spark, d).select(F.trunc("day", "MM").alias("month")).distinct().where((F.month("month") * 7 + F.year("month")) % 5 != 0)


def month_calendar(spark):
    return calendar.days(spark, FIRST, LAST, "1 month").withColumnRenamed("day", "month")


def all_days(spark, d):
    symbols = orders(spark, d).select("symbol").distinct()
    return symbols.select("symbol", F.explode(F.sequence(F.lit(FIRST).cast("date"), F.lit(LAST).cast("date"))).alias("day"))


def events(spark, d):
    return trades_ev(spark, d)


def split_events(spark, d):
    e = events(spark, d)
    mark = F.unix_millis(F.lit(f"{MARK} 00:00:00").cast("timestamp"))
    return e.where(F.col("ms") <= mark), e.where(F.col("ms") > mark - 86_400_000)


def raw_rows(spark, d):
    """Orders as raw text fields, some of them broken."""
    o = orders(spark, d)
    k = F.col("o_orderkey")
    return o.select(k, F.when(k % 11 == 0, "x").otherwise(k.cast("string")).alias("f_id"), F.when(k % 13 == 0, "").otherwise(F.round("o_totalprice", 0).cast("long").cast("string")).alias("f_price"), F.element_at(F.array(*[F.lit(x) for x in ("true", "True", "TRUE", "false", "False", "yes", "1")]), (k % 7 + 1).cast("int")).alias("f_flag"))


RAW_SQL = """raw AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE o_orderkey::VARCHAR END AS f_id,
 CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE round(o_totalprice, 0)::BIGINT::VARCHAR END AS f_price, (['true','True','TRUE','false','False','yes','1'])[(o_orderkey % 7 + 1)::INT] AS f_flag FROM orders)"""


def names(spark, d):
    k = F.col("o_orderkey")
    date = F.date_format("day", "yyyy-MM-dd")
    return orders(spark, d).select(k, F.when(k % 4 == 0, F.concat(F.lit("BTCUSDT-Trades-"), F.date_format("day", "yyyy-MM"), F.lit(".parquet"))).when(k % 4 == 1, F.concat(F.lit("BTCUSDT-trades-"), date, F.lit(".parquet"))).when(k % 4 == 2, F.concat(F.lit("BTCUSDT-Trades-Optimized-"), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(".parquet"))).otherwise(F.lit("foo.parquet")).alias("name"))


NAMES_SQL = """names AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'BTCUSDT-Trades-' || strftime(o_orderdate, '%Y-%m') || '.parquet' WHEN 1 THEN 'BTCUSDT-trades-' || strftime(o_orderdate, '%Y-%m-%d') || '.parquet'
 WHEN 2 THEN 'BTCUSDT-Trades-Optimized-' || lpad((o_orderkey % 1000)::VARCHAR, 3, '0') || '.parquet' ELSE 'foo.parquet' END AS name FROM orders)"""


def missing_months(spark, d):
    return calendar.missing(month_calendar(spark), holes(spark, d), ["month"])


def month_ranges(spark, d):
    return orders(spark, d).groupBy("symbol", F.trunc("day", "MM").alias("month")).agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def regex_names(spark, d):
    n = names(spark, d)
    part = lambda p, g: F.nullif(F.regexp_extract("name", p, g), F.lit("")).try_cast("int")
    return n.select("o_orderkey", part(scalars.MONTHLY, 2).alias("year"), part(scalars.MONTHLY, 3).alias("month"), part(scalars.DAILY, 4).alias("day"), part(scalars.COMPACTED, 2).alias("number"))


def states(spark, d):
    k = F.col("o_orderkey")
    days = orders(spark, d).groupBy("day").agg(F.max(k % 2 == 0).alias("zip"), F.max(k % 5 == 0).alias("csv"), F.max(k % 17 == 0).alias("done"))
    return days.select("day", merge.state(F.col("zip"), F.col("csv"), F.col("done")).alias("state"))


def checksums(spark, d):
    files = table(spark, d, "documents").select("doc_id", F.col("text").cast("binary").alias("content"))
    real = F.sha2("content", 256)
    sums = files.where("doc_id % 5 <> 0").select("doc_id", F.concat(F.when(F.col("doc_id") % 7 == 0, F.lit("00")).otherwise(F.lit("")), real, F.lit("  file.zip")).alias("checksum"))
    return merge.verify(files, sums, "doc_id").select("doc_id", "status")


def coverage(spark, d):
    span = orders(spark, d).groupBy("o_custkey").agg(F.min("o_orderdate").cast("timestamp").alias("a"), F.max("o_orderdate").cast("timestamp").alias("b"))
    return span.select("o_custkey", scalars.coverage_class(F.col("a"), F.col("b")).alias("coverage"))


QUERIES = {
    "time_bounds": lambda spark, d: events(spark, d).groupBy("symbol").agg(F.min("ms").alias("first_ms"), F.max("ms").alias("last_ms"), F.count("*").alias("n")),
    "latest_per_symbol": lambda spark, d: events(spark, d).groupBy("symbol").agg(F.max_by("price", F.struct("ms", "trade_id")).alias("last_price"), F.max("ms").alias("last_ms")),
    "sort_trades": lambda spark, d: events(spark, d).orderBy("ms", "trade_id").select("symbol", "trade_id", "ms"),
    "calendar_series": lambda spark, d: calendar.days(spark, FIRST, LAST).select(F.date_format("day", "yyyy-MM-dd").alias("day")),
    "missing_months": lambda spark, d: missing_months(spark, d).select(F.date_format("month", "yyyy-MM").alias("month")),
    "completeness_pct": lambda spark, d: holes(spark, d).agg(F.count("*").alias("existing")).join(missing_months(spark, d).agg(F.count("*").alias("missing"))).select("existing", "missing", F.round(calendar.complete(F.col("existing"), F.col("missing")), 6).alias("completeness")),
    "month_head_tail_gaps": lambda spark, d: calendar.month_gaps(orders(spark, d), "day", ("symbol",)).select("symbol", F.date_format("month", "yyyy-MM").alias("month"), F.col("days_covered").cast("long").alias("days_covered"), F.col("missing_head").cast("long").alias("missing_head"), F.col("missing_tail").cast("long").alias("missing_tail")),
    "distinct_days": lambda spark, d: order_days(spark, d).select("symbol", F.date_format("day", "yyyy-MM-dd").alias("day")),
    "missing_days": lambda spark, d: calendar.missing(all_days(spark, d), order_days(spark, d), ["symbol", "day"]).select("symbol", F.date_format("day", "yyyy-MM-dd").alias("day")),
    "daily_gaps": lambda spark, d: calendar.daily_gaps(order_days(spark, d), ("symbol",)).select("symbol", F.date_format("missing_day", "yyyy-MM-dd").alias("missing_day")),
    "expand_ranges": lambda spark, d: calendar.expand(month_ranges(spark, d), "first_day", "last_day", keys=("symbol",)).select("symbol", F.date_format("day", "yyyy-MM-dd").alias("day")),
    "except_days": lambda spark, d: all_days(spark, d).select("day").distinct().exceptAll(order_days(spark, d).where("symbol = '1-URGENT'").select("day")).select(F.date_format("day", "yyyy-MM-dd").alias("day")),
    "union_distinct_days": lambda spark, d: order_days(spark, d).where("symbol = '1-URGENT'").select("day").union(order_days(spark, d).where("symbol = '2-HIGH'").select("day")).distinct().select(F.date_format("day", "yyyy-MM-dd").alias("day")),
    "weekend_split": lambda spark, d: order_days(spark, d).groupBy("symbol", calendar.is_weekend(F.col("day")).alias("weekend")).agg(F.count("*").alias("days")),
    "top_n_missing": lambda spark, d: missing_months(spark, d).orderBy("month").limit(5).select(F.date_format("month", "yyyy-MM").alias("month")),
    "range_join_files": lambda spark, d: merge.within(calendar.days(spark, FIRST, LAST), month_ranges(spark, d)).groupBy("symbol", "month").agg(F.count("*").alias("days")).select("symbol", F.date_format("month", "yyyy-MM").alias("month"), "days"),
    "dedup_trades": lambda spark, d: merge.first_by(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_quantity", "l_returnflag", "l_linestatus"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"),
    "watermark_filter": lambda spark, d: merge.newer(split_events(spark, d)[1], split_events(spark, d)[0]).select("symbol", "trade_id", "ms"),
    "merge_incremental": lambda spark, d: merge.merge_incremental(*split_events(spark, d), ["trade_id"], order=["ms", "symbol"]).select("symbol", "trade_id", "ms"),
    "union_files": lambda spark, d: events(spark, d).where("trade_id % 2 = 0").unionByName(events(spark, d).where("trade_id % 2 = 1")).select("symbol", "trade_id", "price"),
    "epoch_normalize": lambda spark, d: orders(spark, d).select("o_orderkey", scalars.epoch_ms(F.element_at(F.array(F.lit(1704067200), F.lit(1704067200123), F.lit(1704067200123456)), (F.col("o_orderkey") % 3 + 1).cast("int")) + F.col("o_orderkey") % 1000).alias("ms")),
    "scalar_bool_parse": lambda spark, d: raw_rows(spark, d).select("o_orderkey", scalars.flag(F.col("f_flag")).alias("flag")),
    "filter_parseable": lambda spark, d: raw_rows(spark, d).where(F.col("f_id").try_cast("long").isNotNull() & F.col("f_price").try_cast("double").isNotNull()).select("o_orderkey", F.col("f_price").cast("double").alias("price")),
    "regex_filename_dates": regex_names,
    "scalar_path_template": lambda spark, d: orders(spark, d).select("o_orderkey", scalars.url_path(F.lit("btcusdt"), F.element_at(F.array(F.lit("spot"), F.lit("um"), F.lit("cm")), (F.col("o_orderkey") % 3 + 1).cast("int")), F.when(F.col("o_orderkey") % 2 == 0, "daily").otherwise("monthly"), F.col("day")).alias("path")),
    "coverage_class": coverage,
    "dq_nonpositive": lambda spark, d: events(spark, d).groupBy("symbol").agg(F.count_if(F.col("price") <= 0).alias("bad_price"), F.count_if(F.col("qty") <= 0).alias("bad_qty"), F.bool_or(F.col("price") <= 0).alias("any_bad")),
    "dq_nulls": lambda spark, d: events(spark, d).groupBy("symbol").agg(F.count_if(F.col("ms").isNull()).alias("null_time"), (F.count("*") == 0).alias("empty")),
    "pipeline_state_case": lambda spark, d: states(spark, d).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "state"),
    "status_counts": lambda spark, d: states(spark, d).groupBy("state").agg(F.count("*").alias("n")),
    "ledger_reconcile": lambda spark, d: merge.reconcile(all_days(spark, d), order_days(spark, d), ["symbol", "day"]).groupBy("symbol", "present").agg(F.count("*").alias("n")),
    "checksum_verify": checksums,
    "argmin_balance": lambda spark, d: analytics.balance(table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count("*").cast("double").alias("a"), F.max("l_extendedprice").alias("b"), F.max("l_quantity").alias("c")), "l_returnflag", ["a", "b", "c"]).select("l_returnflag", F.round("score", 6).alias("score")),
}



def periods(spark, d):
    """Files named by the day of their last order, with the day of their first: some differ."""
    g = orders(spark, d).groupBy("o_custkey").agg(F.min("day").alias("first_day"), F.max("day").alias("named"))
    return g.select("o_custkey", "first_day", "named")


def stems(spark, d):
    """Inputs and outputs by stem: an output for most inputs."""
    k = F.col("o_orderkey")
    inputs = orders(spark, d).select(F.concat(F.lit("T-"), F.date_format("day", "yyyy-MM-dd")).alias("stem")).distinct()
    return inputs, orders(spark, d).where(k % 3 == 0).select(F.concat(F.lit("T-"), F.date_format("day", "yyyy-MM-dd")).alias("stem")).distinct()


def archives(spark, d):
    """A row per day: whether its archive has been checked and extracted."""
    k = F.col("o_orderkey")
    return orders(spark, d).groupBy("day").agg(F.bool_or(k % 2 == 0).alias("checked"), F.bool_or(k % 5 == 0).alias("csv"))


def day_text(c="day"):
    return F.date_format(c, "yyyy-MM-dd").alias(c)


QUERIES |= {
    "intersect_days": lambda spark, d: order_days(spark, d).where("symbol = '1-URGENT'").select("day").intersect(order_days(spark, d).where("symbol = '2-HIGH'").select("day")).select(day_text()),
    "valid_years": lambda spark, d: calendar.since(orders(spark, d), "o_orderdate", 1995).groupBy("symbol").agg(F.count("*").alias("n"), F.date_format(F.min("day"), "yyyy-MM-dd").alias("first_day")),
    "complete_days": lambda spark, d: calendar.before(order_days(spark, d), "day", F.lit("1998-01-01").cast("date")).groupBy("symbol").agg(F.count("*").alias("days"), F.date_format(F.max("day"), "yyyy-MM-dd").alias("last_day")),
    "period_mismatch": lambda spark, d: periods(spark, d).where(calendar.other_period("named", "first_day", "MM")).select("o_custkey", day_text("named"), day_text("first_day")),
    "outputs_missing": lambda spark, d: calendar.missing(*stems(spark, d), ["stem"]),
    "archives_to_clean": lambda spark, d: archives(spark, d).where("csv and checked").select(day_text()),
    "archives_to_extract": lambda spark, d: archives(spark, d).where("not csv").select(day_text()),
    "download_queue": lambda spark, d: archives(spark, d).where("checked").select("day").union(archives(spark, d).where("csv").select("day")).distinct().select(day_text()),
}

PART = 200_000


def day_files(spark, d):
    """A file per symbol and day, whose size goes by its orders."""
    name = F.concat(F.lit("T-"), F.date_format("day", "yyyy-MM-dd"))
    return orders(spark, d).groupBy("symbol", name.alias("name")).agg((F.sum("o_orderkey") % 50_000 + 1_000).cast("long").alias("bytes"))


def footer_bounds(spark, d):
    """Rows and time bounds of the events by footers."""
    f = footers.footers(spark, f"{d}/events.parquet", "ts")
    return f.agg(F.sum("n_rows").alias("n_rows"), F.unix_millis(F.min("low")).alias("first_ms"), F.unix_millis(F.max("high")).alias("last_ms"))


def iteration_means(spark, d):
    m = analytics.iteration_means(table(spark, d, "lineitem"), ["l_returnflag"], ["l_quantity", "l_discount"])
    return m.select("l_returnflag", "iterations", *[F.round(c, 6).alias(c) for c in ("l_quantity", "l_discount")])


QUERIES |= {
    "head_trades": lambda spark, d: inventory.head(events(spark, d), 100, ("ms", "trade_id")).select("symbol", "trade_id", "ms"),
    "tail_trades": lambda spark, d: inventory.tail(events(spark, d), 1000, ("ms", "trade_id")).select("symbol", "trade_id", "ms"),
    "footer_bounds": footer_bounds,
    "rolling_parts": lambda spark, d: rolling.numbered(day_files(spark, d), PART),
    "inventory_totals": lambda spark, d: day_files(spark, d).groupBy("symbol").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes")),
    "iteration_means": iteration_means,
}

DAYS = f"cal AS (SELECT unnest(generate_series(DATE '{FIRST}', DATE '{LAST}', INTERVAL 1 DAY))::DATE AS day)"
OD = "od AS (SELECT DISTINCT o_orderpriority AS symbol, o_orderdate::DATE AS day FROM orders)"
MONTHS = f"months AS (SELECT unnest(generate_series(DATE '{FIRST}', DATE '{LAST}', INTERVAL 1 MONTH))::DATE AS month), held AS (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS month FROM orders WHERE (month(o_orderdate) * 7 + year(o_orderdate)) % 5 <> 0), lost AS (SELECT month FROM months WHERE month NOT IN (SELECT month FROM held))"
EV = "ev AS (SELECT event_type AS symbol, event_id AS trade_id, epoch_us(ts) // 1000 AS ms, value AS price, (CAST(json_extract_string(props, '$.k') AS INT) + 1)::DOUBLE AS qty FROM events)"
MARK_MS = f"epoch_ms(TIMESTAMP '{MARK} 00:00:00')"
RANGES = "ranges AS (SELECT o_orderpriority AS symbol, date_trunc('month', o_orderdate)::DATE AS month, min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day FROM orders GROUP BY ALL)"
STATES = "st AS (SELECT o_orderdate::DATE AS day, CASE WHEN bool_or(o_orderkey % 17 = 0) THEN 'completed' WHEN bool_or(o_orderkey % 5 = 0) THEN 'csv_ready' WHEN bool_or(o_orderkey % 2 = 0) THEN 'zip_ready' ELSE 'not_downloaded' END AS state FROM orders GROUP BY 1)"
D = "strftime({}, '%Y-%m-%d')"

ORACLE = {
    "time_bounds": f"WITH {EV} SELECT symbol, min(ms) AS first_ms, max(ms) AS last_ms, count(*) AS n FROM ev GROUP BY symbol",
    "latest_per_symbol": f"WITH {EV} SELECT symbol, arg_max(price, (ms, trade_id)) AS last_price, max(ms) AS last_ms FROM ev GROUP BY symbol",
    "sort_trades": f"WITH {EV} SELECT symbol, trade_id, ms FROM ev ORDER BY ms, trade_id",
    "calendar_series": f"WITH {DAYS} SELECT {D.format('day')} AS day FROM cal",
    "missing_months": f"WITH {MONTHS} SELECT strftime(month, '%Y-%m') AS month FROM lost",
    "completeness_pct": f"WITH {MONTHS} SELECT (SELECT count(*) FROM held) AS existing, (SELECT count(*) FROM lost) AS missing, round(100.0::DOUBLE * (SELECT count(*) FROM held) / ((SELECT count(*) FROM held) + (SELECT count(*) FROM lost)), 6) AS completeness",
    "month_head_tail_gaps": f"WITH {RANGES} SELECT symbol, strftime(month, '%Y-%m') AS month, (last_day - first_day + 1)::BIGINT AS days_covered, (first_day - month)::BIGINT AS missing_head, (last_day(month) - last_day)::BIGINT AS missing_tail FROM ranges",
    "distinct_days": f"WITH {OD} SELECT symbol, {D.format('day')} AS day FROM od",
    "missing_days": f"WITH {DAYS}, {OD}, al AS (SELECT s.symbol, cal.day FROM cal, (SELECT DISTINCT symbol FROM od) s) SELECT symbol, {D.format('day')} AS day FROM (SELECT * FROM al EXCEPT SELECT * FROM od)",
    "daily_gaps": f"WITH {OD}, nx AS (SELECT symbol, day, lead(day) OVER (PARTITION BY symbol ORDER BY day) AS n FROM od) SELECT symbol, {D.format('g')} AS missing_day FROM (SELECT symbol, unnest(generate_series(day + 1, n - 1, INTERVAL 1 DAY))::DATE AS g FROM nx WHERE n - day > 1)",
    "expand_ranges": f"WITH {RANGES} SELECT DISTINCT symbol, {D.format('g')} AS day FROM (SELECT symbol, unnest(generate_series(first_day, last_day, INTERVAL 1 DAY))::DATE AS g FROM ranges)",
    "except_days": f"WITH {DAYS}, {OD} SELECT {D.format('day')} AS day FROM (SELECT day FROM cal EXCEPT SELECT day FROM od WHERE symbol = '1-URGENT')",
    "union_distinct_days": f"WITH {OD} SELECT {D.format('day')} AS day FROM (SELECT day FROM od WHERE symbol = '1-URGENT' UNION SELECT day FROM od WHERE symbol = '2-HIGH')",
    "weekend_split": f"WITH {OD} SELECT symbol, isodow(day) >= 6 AS weekend, count(*) AS days FROM od GROUP BY ALL",
    "top_n_missing": f"WITH {MONTHS} SELECT strftime(month, '%Y-%m') AS month FROM lost ORDER BY month LIMIT 5",
    "range_join_files": f"WITH {DAYS}, {RANGES} SELECT symbol, strftime(month, '%Y-%m') AS month, count(*) AS days FROM cal JOIN ranges ON day BETWEEN first_day AND last_day GROUP BY ALL",
    "dedup_trades": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax, l_quantity, l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE rn = 1",
    "watermark_filter": f"WITH {EV} SELECT symbol, trade_id, ms FROM ev WHERE ms > {MARK_MS} - 86400000 AND ms > (SELECT max(ms) FROM ev WHERE ms <= {MARK_MS})",
    "merge_incremental": f"WITH {EV} SELECT symbol, trade_id, ms FROM ev WHERE ms <= {MARK_MS} UNION ALL SELECT symbol, trade_id, ms FROM ev n WHERE ms > {MARK_MS} - 86400000 AND ms >= (SELECT max(ms) FROM ev WHERE ms <= {MARK_MS}) AND trade_id NOT IN (SELECT trade_id FROM ev WHERE ms <= {MARK_MS})",
    "union_files": f"WITH {EV} SELECT symbol, trade_id, price FROM ev WHERE trade_id % 2 = 0 UNION ALL SELECT symbol, trade_id, price FROM ev WHERE trade_id % 2 = 1",
    "epoch_normalize": "WITH t AS (SELECT o_orderkey, ([1704067200, 1704067200123, 1704067200123456])[(o_orderkey % 3 + 1)::INT] + o_orderkey % 1000 AS t FROM orders) SELECT o_orderkey, CASE WHEN length(t::VARCHAR) >= 16 THEN t // 1000 WHEN length(t::VARCHAR) >= 13 THEN t ELSE t * 1000 END AS ms FROM t",
    "scalar_bool_parse": f"WITH {RAW_SQL} SELECT o_orderkey, lower(trim(f_flag)) = 'true' AS flag FROM raw",
    "filter_parseable": f"WITH {RAW_SQL} SELECT o_orderkey, f_price::DOUBLE AS price FROM raw WHERE try_cast(f_id AS BIGINT) IS NOT NULL AND try_cast(f_price AS DOUBLE) IS NOT NULL",
    "regex_filename_dates": f"WITH {NAMES_SQL} SELECT o_orderkey, try_cast(nullif(regexp_extract(name, '{scalars.MONTHLY}', 2), '') AS INT) AS year, try_cast(nullif(regexp_extract(name, '{scalars.MONTHLY}', 3), '') AS INT) AS month, try_cast(nullif(regexp_extract(name, '{scalars.DAILY}', 4), '') AS INT) AS day, try_cast(nullif(regexp_extract(name, '{scalars.COMPACTED}', 2), '') AS INT) AS number FROM names",
    "scalar_path_template": "SELECT o_orderkey, 'data/' || CASE o_orderkey % 3 WHEN 0 THEN 'spot' WHEN 1 THEN 'futures/um' ELSE 'futures/cm' END || '/' || CASE WHEN o_orderkey % 2 = 0 THEN 'daily' ELSE 'monthly' END || '/trades/BTCUSDT/BTCUSDT-trades-' || CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y-%m') END || '.zip' AS path FROM orders",
    "coverage_class": "WITH s AS (SELECT o_custkey, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders GROUP BY 1), h AS (SELECT *, (epoch_us(b) - epoch_us(a)) / 3.6e9 AS h, date_diff('day', a, b) + 1 AS n FROM s) SELECT o_custkey, CASE WHEN h < 1 THEN 'minutes' WHEN h < 24 THEN 'hours' WHEN h < 168 THEN 'days' WHEN n > 25 THEN 'month' WHEN n > 15 THEN 'most of a month' ELSE 'weeks' END AS coverage FROM h",
    "dq_nonpositive": f"WITH {EV} SELECT symbol, count(*) FILTER (WHERE price <= 0) AS bad_price, count(*) FILTER (WHERE qty <= 0) AS bad_qty, bool_or(price <= 0) AS any_bad FROM ev GROUP BY symbol",
    "dq_nulls": f"WITH {EV} SELECT symbol, count(*) FILTER (WHERE ms IS NULL) AS null_time, count(*) = 0 AS empty FROM ev GROUP BY symbol",
    "pipeline_state_case": f"WITH {STATES} SELECT {D.format('day')} AS day, state FROM st",
    "status_counts": f"WITH {STATES} SELECT state, count(*) AS n FROM st GROUP BY state",
    "ledger_reconcile": f"WITH {DAYS}, {OD}, al AS (SELECT s.symbol, cal.day FROM cal, (SELECT DISTINCT symbol FROM od) s) SELECT al.symbol, od.day IS NOT NULL AS present, count(*) AS n FROM al LEFT JOIN od ON al.symbol = od.symbol AND al.day = od.day GROUP BY ALL",
    "checksum_verify": "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'unchecked' WHEN doc_id % 7 = 0 THEN 'mismatch' ELSE 'ok' END AS status FROM documents",
    "argmin_balance": "WITH g AS (SELECT l_returnflag, count(*)::DOUBLE AS a, max(l_extendedprice) AS b, max(l_quantity) AS c FROM lineitem GROUP BY 1) SELECT l_returnflag, round((a / min(a) OVER () + b / min(b) OVER () + c / min(c) OVER ()) / 3, 6) AS score FROM g",
}

AR = "ar AS (SELECT o_orderdate::DATE AS day, bool_or(o_orderkey % 2 = 0) AS checked, bool_or(o_orderkey % 5 = 0) AS csv FROM orders GROUP BY 1)"
STEM = "'T-' || strftime(o_orderdate, '%Y-%m-%d') AS stem"

ORACLE |= {
    "intersect_days": f"WITH {OD} SELECT {D.format('day')} AS day FROM (SELECT day FROM od WHERE symbol = '1-URGENT' INTERSECT SELECT day FROM od WHERE symbol = '2-HIGH')",
    "valid_years": "SELECT o_orderpriority AS symbol, count(*) AS n, strftime(min(o_orderdate), '%Y-%m-%d') AS first_day FROM orders WHERE year(o_orderdate) >= 1995 GROUP BY 1",
    "complete_days": f"WITH {OD} SELECT symbol, count(*) AS days, strftime(max(day), '%Y-%m-%d') AS last_day FROM od WHERE day < DATE '1998-01-01' GROUP BY 1",
    "period_mismatch": "WITH g AS (SELECT o_custkey, min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS named FROM orders GROUP BY 1) SELECT o_custkey, strftime(named, '%Y-%m-%d') AS named, strftime(first_day, '%Y-%m-%d') AS first_day FROM g WHERE date_trunc('month', named) <> date_trunc('month', first_day)",
    "outputs_missing": f"SELECT {STEM} FROM orders EXCEPT SELECT {STEM} FROM orders WHERE o_orderkey % 3 = 0",
    "archives_to_clean": f"WITH {AR} SELECT {D.format('day')} AS day FROM ar WHERE csv AND checked",
    "archives_to_extract": f"WITH {AR} SELECT {D.format('day')} AS day FROM ar WHERE NOT csv",
    "download_queue": f"WITH {AR} SELECT {D.format('day')} AS day FROM ar WHERE checked UNION SELECT {D.format('day')} AS day FROM ar WHERE csv",
}

FILES = "files AS (SELECT o_orderpriority AS symbol, 'T-' || strftime(o_orderdate, '%Y-%m-%d') AS name, (sum(o_orderkey) % 50000 + 1000)::BIGINT AS bytes FROM orders GROUP BY ALL)"
ROLLS = f"""WITH RECURSIVE {FILES}, f AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY name) AS rn FROM files),
walk AS (
  SELECT symbol, rn, 0::BIGINT AS number, 0.9::DOUBLE * bytes AS held FROM f WHERE rn = 1
  UNION ALL
  SELECT f.symbol, f.rn, w.number + (w.held + 0.9::DOUBLE * f.bytes > 0.95::DOUBLE * {PART})::INT,
    CASE WHEN w.held + 0.9::DOUBLE * f.bytes > 0.95::DOUBLE * {PART} THEN 0.0::DOUBLE ELSE w.held END + 0.9::DOUBLE * f.bytes
  FROM walk w JOIN f ON f.symbol = w.symbol AND f.rn = w.rn + 1)
SELECT symbol, name, bytes, number FROM walk JOIN f USING (symbol, rn)"""

ORACLE |= {
    "head_trades": f"WITH {EV} SELECT symbol, trade_id, ms FROM ev ORDER BY ms, trade_id LIMIT 100",
    "tail_trades": f"WITH {EV} SELECT symbol, trade_id, ms FROM ev ORDER BY ms DESC, trade_id DESC LIMIT 1000",
    "footer_bounds": "SELECT count(*) AS n_rows, epoch_us(min(ts)) // 1000 AS first_ms, epoch_us(max(ts)) // 1000 AS last_ms FROM events",
    "rolling_parts": ROLLS,
    "inventory_totals": f"WITH {FILES} SELECT symbol, count(*) AS files, sum(bytes)::BIGINT AS bytes FROM files GROUP BY symbol",
    "iteration_means": "SELECT l_returnflag, count(*) AS iterations, round(avg(l_quantity::DOUBLE), 6) AS l_quantity, round(avg(l_discount::DOUBLE), 6) AS l_discount FROM lineitem GROUP BY 1",
}
