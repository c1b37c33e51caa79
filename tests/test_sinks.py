import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tickloom.operators.parallel import parallel_map
from tickloom.sources import footers, inventory, rolling
from tickloom.streaming.append import append, arriving


def plain_numbers(sizes, bound, number=0, held=None):
    """The rolling rule, one file at a time."""
    out, open_, size = [], held is not None, held or 0.0
    for s in sizes:
        if open_ and size + 0.9 * s > 0.95 * bound:
            number, size = number + 1, 0.0
        size, open_ = size + 0.9 * s, True
        out.append(number)
    return out


def test_numbered(spark):
    sizes = [(7919 * i) % 1000 + 1 for i in range(500)] + [5000, 1, 0]
    files = spark.createDataFrame([("A", f"{i:04d}", s) for i, s in enumerate(sizes)] + [("B", "x", 10**6)], "symbol string, name string, bytes long").repartition(5)
    got = {(r.symbol, r.name): r.number for r in rolling.numbered(files, 2000).collect()}
    assert [got["A", f"{i:04d}"] for i in range(len(sizes))] == plain_numbers(sizes, 2000) and got["B", "x"] == 0
    one = files.where("symbol = 'A'").drop("symbol")
    on = [r.number for r in rolling.numbered(one, 2000, (), 3, 1500.0).orderBy("name").collect()]
    assert on == plain_numbers(sizes, 2000, 3, 1500.0) and on[0] in (3, 4)
    assert rolling.numbered(files.where("false"), 2000).count() == 0


def test_compact_rolling(spark, tmp_path):
    t = inventory.synthetic_trades(spark, 3000)
    src, more, out = (str(tmp_path / x) for x in ("s", "m", "o"))
    for i in range(3):
        t.where(f"trade_id > {i * 700} and trade_id <= {(i + 1) * 700}").coalesce(1).write.mode("append").parquet(src)
    size = sum(p.stat().st_size for p in (tmp_path / "s").glob("*.parquet"))
    assert rolling.compact_rolling(spark, src, out, max_bytes=int(size * 0.7)) == 2100
    found = rolling.parts(spark, out).orderBy("number").collect()
    assert [r.number for r in found] == [1, 2]
    t.where("trade_id > 2100").coalesce(1).write.parquet(more)
    assert rolling.compact_rolling(spark, more, out, max_bytes=int(size * 0.7), update=True) == 3000
    back = spark.read.parquet(out)
    assert back.select("trade_id").distinct().count() == 3000 and rolling.newest(spark, out).count() > 0
    assert max(r.number for r in rolling.parts(spark, out).collect()) >= 2


def test_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    t = inventory.synthetic_trades(spark, 1000)
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    t.repartition(3).write.option("compression", "zstd").parquet(path)
    spark.conf.unset("spark.sql.parquet.outputTimestampType")
    pq.write_table(pq.read_table(path).slice(0, 0), f"{path}/empty.parquet")
    f = footers.footers(spark, path)
    rows = f.collect()
    assert sum(r.n_rows for r in rows) == 1000 and len(rows) == 4 and {r.codec for r in rows if r.n_rows} == {"zstd"}
    assert f.agg(F.min("low"), F.max("high")).first() == t.agg(F.min("time"), F.max("time")).first()
    assert all(r.low is None for r in rows if not r.n_rows)
    assert all(r.low is None for r in footers.footers(spark, path, "price").collect())
    assert all(r.low is None and r.n_rows is not None for r in footers.footers(spark, path, "no such").collect())


def test_heads_and_texts(spark, tmp_path):
    t = inventory.synthetic_trades(spark, 50).repartition(4)
    assert [r.trade_id for r in inventory.head(t, 3, ("trade_id",)).collect()] == [1, 2, 3]
    assert sorted(r.trade_id for r in inventory.tail(t, 2, ("trade_id",)).collect()) == [49, 50]
    entries = spark.createDataFrame([("2024-01-03", "failed"), ("2024-01-01", "processing_failed"), ("2024-01-02", "verified")], "date string, status string")
    inventory.write_failed(entries, str(tmp_path / "f"))
    assert [r.value for r in spark.read.text(str(tmp_path / "f")).collect()] == ["2024-01-01", "2024-01-03"]
    bars = spark.createDataFrame([(0, 1.0)], "bar_id long, close double")
    for stamp, sample in (("20240101T000000", "a"), ("20240102T000000", "b")):
        inventory.write_bars(bars, str(tmp_path / "bars"), "standard", stamp, sample=sample)
    assert {(r.run, r.sample) for r in inventory.read_bars(spark, str(tmp_path / "bars"), "standard").collect()} == {("standard_20240101T000000", "a"), ("standard_20240102T000000", "b")}


def test_parallel_map(spark):
    def half(item):
        if item["n"] % 3 == 0:
            raise ValueError("three")
        return {"n": item["n"], "half": item["n"] / 2}

    rows = parallel_map(spark.range(1, 8).withColumnRenamed("id", "n"), half, "n long, half double", tries=2, tasks=3).collect()
    assert sorted((r.n, r.half) for r in rows if r.error is None) == [(n, n / 2) for n in (1, 2, 4, 5, 7)]
    assert [r.error for r in rows if r.error] == ["ValueError: three"] * 2
    with pytest.raises(ValueError, match="tries"):
        parallel_map(spark.range(1), half, "n long", tries=0)


def test_append(spark, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("s", "o", "c"))
    t = inventory.synthetic_trades(spark, 100).withColumn("symbol", F.lit("A"))
    schema = t.schema.simpleString()[7:-1].replace(":", " ")
    for part in (t.where("trade_id <= 60"), t.where("trade_id > 40")):  # twenty come twice
        part.write.mode("append").parquet(src)
        append(arriving(spark, src, schema), out, state).awaitTermination(120)
    back = spark.read.parquet(out)
    assert back.count() == back.select("trade_id").distinct().count() == 100
