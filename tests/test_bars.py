import numpy as np
import pytest
from pyspark.sql import functions as F
from tickloom.operators import kernels
from tickloom.operators.bars import bars, bars_from_ids, tick_bars
from tickloom.operators.tick_rule import with_side

PRICES = [100.0, 100.0, 101.0, 101.0, 99.0, 99.0, 100.0]
QTY = [1.0, 1.0, 1.0, 2.0, 1.0, 1.0, 1.0]


def golden(spark, parts=1):
    rows = [("A", i + 1, i * 1000, p, q, p * q) for i, (p, q) in enumerate(zip(PRICES, QTY))]
    return spark.createDataFrame(rows, "symbol string, trade_id long, ms long, price double, qty double, quote_qty double").repartition(parts)


def test_sides(spark):
    assert [r.side for r in with_side(golden(spark, 3)).orderBy("trade_id").collect()] == [1, 1, -1, -1, 1, 1, -1]
    assert [r.side for r in with_side(golden(spark), convention="standard").orderBy("trade_id").collect()] == [1, 1, 1, 1, -1, -1, 1]
    chunk = golden(spark).withColumn("chunk", (F.col("trade_id") > 3).cast("int"))
    assert [r.side for r in with_side(chunk, reset_key="chunk").orderBy("trade_id").collect()] == [1, 1, -1, 1, 1, 1, -1]


@pytest.mark.parametrize("convention", ["reference", "standard"])
def test_sides_by_blocks(spark, convention):
    """Blocks without a change, of one trade and of null prices, null and many symbols, repeated prices at borders."""
    rng = np.random.default_rng(11)
    rows = []
    for symbol in ("A", "B", None, ""):
        ms = np.sort(rng.integers(0, 40_000, 400))
        price = np.repeat(rng.integers(99, 102, 100), 4).astype(float).tolist()
        rows += [(symbol, i, int(m), None if i % 97 == 5 else p, 1.0, 2.0, int(m) // 15_000) for i, (m, p) in enumerate(zip(ms, price))]
    rows += [("B", 1000, None, 100.0, 1.0, 2.0, 0), ("C", 1, 5, 1.0, 1.0, 2.0, 0)]
    t = spark.createDataFrame(rows, "symbol string, trade_id long, ms long, price double, qty double, quote_qty double, chunk int").repartition(5)
    for reset in (None, "chunk"):
        want = with_side(t, convention=convention, reset_key=reset)
        for width in (7, 1000, 10**9):
            got = with_side(t, convention=convention, reset_key=reset, block=F.floor(F.col("ms") / width))
            assert got.columns == want.columns and got.count() == len(rows) and got.exceptAll(want).isEmpty()
    assert with_side(t.where("false"), block=F.col("ms")).count() == 0


def test_standard(spark):
    got = [tuple(r)[1:] for r in bars(golden(spark, 3), "standard", {"threshold": 300.0}, emit_partial=True).orderBy("bar_id").collect()]
    assert got == [
        (0, 0, 2000, 100.0, 101.0, 100.0, 101.0, 99.0, 200.0, 301.0, 3.0, 3, 2),
        (1, 3000, 4000, 101.0, 101.0, 99.0, 99.0, -103.0, 99.0, 301.0, 3.0, 2, 1),
        (2, 5000, 6000, 99.0, 100.0, 99.0, 100.0, -1.0, 99.0, 199.0, 2.0, 2, 1),
    ]
    assert bars(golden(spark), "standard", {"threshold": 301.0}).count() == 2
    assert bars(golden(spark), "standard", {"threshold": 0.0}).count() == 7


def test_imbalance(spark):
    p = {"init_ticks": 2, "alpha_ticks": 0.5, "alpha_imbalance": 0.5, "time_reset": 5.0}
    got = [(r.theta_k, r.ticks, r.ewma_T, r.ewma_imbalance) for r in bars(golden(spark), "imbalance", p, emit_partial=True).orderBy("bar_id").collect()]
    assert got[:2] == [(200.0, 2, 2.0, 100.0), (-303.0, 2, 2.0, 125.75)] and got[2][:2] == (98.0, 3)
    got = [(r.theta_k, r.ewma_T, r.ewma_imbalance) for r in bars(golden(spark), "imbalance", p | {"time_reset": 0.0001}).orderBy("bar_id").collect()]
    assert got == [(200.0, 2.0, 100.0), (-303.0, 2.0, 151.5), (198.0, 2.0, 99.0)]


def test_older_variant(spark):
    p = {"init_t": 150.0, "alpha_volume": 0.5, "alpha_imbalance": 0.5}
    got = [(r.imbalance_col, r.total_volume_usd, r.total_volume_buy_usd) for r in bars(golden(spark), "volume_imbalance", p, emit_partial=True).orderBy("bar_id").collect()]
    assert got == [(200.0, 200.0, 200.0), (-303.0, 303.0, 0.0), (98.0, 298.0, 198.0)]
    assert [tuple(r)[2:] for r in bars(golden(spark), "volume_imbalance", p, trace=True).orderBy("bar_id").collect()] == [(200.0, 1.0, 200.0), (303.0, 1.0, 303.0)]


@pytest.mark.parametrize("make", [lambda: kernels.Standard(5000.0), lambda: kernels.Imbalance(7, 0.5, 0.5, 0.001), lambda: kernels.VolumeImbalance(3000.0), lambda: kernels.Volume(40.0), lambda: kernels.Run(3000.0)])
def test_pieces_do_not_matter(make):
    rng = np.random.default_rng(1)
    n = 3000
    price, qty, side = rng.uniform(50, 150, n), rng.exponential(3, n), rng.choice([-1, 1], n)
    ms, net = np.arange(n) * 1000, price * qty * side
    whole = make().step(price, ms, net, side, qty)
    kernel, pieces, at = make(), [], 0
    for size in rng.integers(1, 40, 1000):
        pieces += kernel.step(*[c[at : at + size] for c in (price, ms, net, side, qty)]) if at < n else []
        at += size
    assert whole == pieces and len(whole) > 5


def test_conservation_and_ids(spark):
    t = golden(spark)
    b = bars(t, "standard", {"threshold": 150.0}, emit_partial=True)
    assert b.agg(F.sum("ticks")).first()[0] == 7 and b.agg(F.sum("total_volume_usd")).first()[0] == 801.0
    assert tick_bars(t, 3).orderBy("bar_id").select("ticks").collect()[-1][0] == 1
    assert bars_from_ids(t.withColumn("bar_id", F.lit(0))).first().ticks_buy == 4


def test_empty(spark):
    assert bars(golden(spark).where("false"), "standard", {"threshold": 1.0}, emit_partial=True).count() == 0


def test_table_function(spark):
    from tickloom.operators import udtf

    udtf.register(spark)
    with_side(golden(spark)).createOrReplaceTempView("signed")
    rows = spark.sql("SELECT * FROM standard_bars(TABLE(SELECT symbol, trade_id, ms, price, net, side, qty FROM signed) PARTITION BY symbol ORDER BY (ms, trade_id), 300.0D)").collect()
    assert [(r.bar_id, r.theta_k) for r in rows] == [(0, 99.0), (1, -103.0)]


def test_stream(spark, tmp_path):
    from tickloom.streaming.bars import stream_bars

    src = str(tmp_path / "in")
    for k in range(2):
        golden(spark).where(f"trade_id % 7 {'<' if k == 0 else '>='} 4 AND trade_id < 7" if k == 0 else "trade_id >= 4").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(golden(spark).schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = stream_bars(stream, "standard", {"threshold": 300.0}).writeStream.format("memory").queryName("streamed").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [(r.bar_id, r.theta_k) for r in spark.table("streamed").orderBy("bar_id").collect()] == [(0, 99.0), (1, -103.0)]


def test_chunks_in_many_tasks(spark):
    """A rule that restarts by chunk must not deal the chunks of one symbol to different kernels."""
    rng = np.random.default_rng(4)
    price, qty = rng.uniform(50, 150, 4000).round(2), rng.exponential(3, 4000).round(3)
    rows = [("A" if i % 3 else None, i, i * 1000, float(p), float(q), float(p * q), i // 100) for i, (p, q) in enumerate(zip(price, qty))]
    t = spark.createDataFrame(rows, "symbol string, trade_id long, ms long, price double, qty double, quote_qty double, chunk int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(map(str, bars(t.repartition(8), "standard", {"threshold": 20_000.0}, reset_key="chunk").collect()))
        ids = [r.bar_id for r in bars(t.repartition(8), "standard", {"threshold": 20_000.0}, reset_key="chunk").where("symbol = 'A'").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(ids) == list(range(len(ids))) and len(ids) > 10
    assert got == sorted(map(str, bars(t.coalesce(1), "standard", {"threshold": 20_000.0}, reset_key="chunk").collect()))


def test_sweep_is_each_alone(spark):
    from tickloom.operators.bars import bars_sweep

    t = golden(spark, 3)
    grid = [{"threshold": 150.0}, {"threshold": 300.0}]
    swept = bars_sweep(t, "standard", grid, emit_partial=True).orderBy("param_id", "bar_id").collect()
    alone = [(i, *r) for i, p in enumerate(grid) for r in bars(t, "standard", p, emit_partial=True).orderBy("bar_id").collect()]
    assert [tuple(r) for r in swept] == alone


def test_tick_imbalance(spark):
    """Against the rule, one trade at a time."""
    n = 600
    prices = [100.0 + (i * 7919 % 13) - (i * 104729 % 11) + i // 40 for i in range(n)]
    t = spark.createDataFrame([("A", i, i * 1000, p, 1.0 + i % 5, p * (1.0 + i % 5)) for i, p in enumerate(prices)], "symbol string, trade_id long, ms long, price double, qty double, quote_qty double")
    sides = [r.side for r in with_side(t).orderBy("trade_id").collect()]
    want, flow, ticks, warm, limit, et, ei = [], 0, 0, True, 10.0, 10.0, 0.0
    for i, s in enumerate(sides):
        flow, ticks = flow + s, ticks + 1
        if (ticks if warm else abs(flow)) >= limit:
            et, ei = (float(ticks), abs(flow) / ticks) if warm else (et + 0.5 * (ticks - et), ei + 0.5 * (abs(flow) / ticks - ei))
            want.append((i * 1000, ticks, et, ei))
            flow, ticks, warm, limit = 0, 0, False, et * ei
    got = bars(t.repartition(5), "tick_imbalance", {"init_ticks": 10, "alpha_ticks": 0.5, "alpha_imbalance": 0.5}).orderBy("bar_id").collect()
    assert [(r.end_time, r.ticks, r["ewma_T"], r.ewma_imbalance) for r in got] == want and len(want) > 5


def test_table_functions(spark):
    """Every kind of bars in SQL equals its DataFrame form."""
    from tickloom.operators import udtf

    udtf.register(spark)
    t = golden(spark)
    with_side(t).createOrReplaceTempView("signed_all")
    for kind, params in (("volume", {"threshold": 2.0}), ("run", {"init_t": 200.0}), ("volume_imbalance", {"init_t": 150.0}), ("tick_imbalance", {"init_ticks": 2.0}), ("imbalance", {"init_ticks": 2.0})):
        args = ", ".join(f"{v}D" for v in params.values())
        got = spark.sql(f"SELECT * FROM {kind}_bars(TABLE(SELECT symbol, trade_id, ms, price, net, side, qty FROM signed_all) PARTITION BY symbol ORDER BY (ms, trade_id), {args})").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, bars(t, kind, params).collect())) and got
