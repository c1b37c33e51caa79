import hashlib
import zipfile

import pytest
from pyspark.sql import functions as F
from tickloom.functions import scalars
from tickloom.operators import calendar, merge
from tickloom.sources import archives, csv, inventory

SPOT = "1,42000.10,0.5,21000.05,1704067200123,True,True\n2,42000.10,0.1,4200.01,1704067200124456,false,TRUE\n"
BAD = "x,1,1,1,1704067200123,True,True\n3,1,1,1,1704067200123,yes,True\n4,,1,1,1704067200123,True,True\n1,2,3\n"
FUTURES = "id,price,qty,quote_qty,time,is_buyer_maker\n10,42010.0,2,84020.0,1704067201000,true\n"


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text(SPOT + BAD)
    (tmp_path / "b.csv").write_text(FUTURES)
    rows = csv.read_csv(spark, str(tmp_path / "*.csv")).withColumn("ms", F.unix_millis("time")).orderBy("trade_id").collect()
    assert [(r.trade_id, r.ms, r.isBuyerMaker, r.isBestMatch) for r in rows] == [(1, 1704067200123, True, True), (2, 1704067200124, False, True), (3, 1704067200123, False, True), (10, 1704067201000, True, False)]
    assert csv.read_csv(spark, str(tmp_path / "b.csv"), missing_best_match=None).first().isBestMatch is None
    assert csv.read_csv(spark, str(tmp_path / "b.csv"), width=7).count() == 0
    csv.write_csv(csv.read_csv(spark, str(tmp_path / "a.csv")), str(tmp_path / "out"))
    assert csv.read_csv(spark, str(tmp_path / "out")).count() == 3


def test_csv_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Time,is_buyer_maker,id,note,quote_qty,QTY,price\n1704067201000,true,10,x,84020.0,2,42010.0\n1704067201001,true,11,84020.0,2,42010.0\n")
    (tmp_path / "b.csv").write_text(SPOT)
    rows = csv.read_csv(spark, str(tmp_path / "*.csv")).orderBy("trade_id").collect()
    assert [(r.trade_id, r.price, r.qty, r.quoteQty, r.isBuyerMaker, r.isBestMatch) for r in rows] == [(1, 42000.10, 0.5, 21000.05, True, True), (2, 42000.10, 0.1, 4200.01, False, True), (10, 42010.0, 2.0, 84020.0, True, False)]
    assert csv.read_csv(spark, str(tmp_path / "b.csv"), headers=False).count() == 2


def test_archives(spark, tmp_path):
    for name, members in (("A-trades-2024-01.zip", {"a.csv": SPOT, "sub/b.csv": SPOT}), ("B-trades-2024-01.zip", {"x.csv": SPOT, "y.csv": SPOT + BAD * 20})):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for m, text in members.items():
                z.writestr(m, text)
    good = hashlib.sha256((tmp_path / "A-trades-2024-01.zip").read_bytes()).hexdigest()
    (tmp_path / "A-trades-2024-01.zip.CHECKSUM").write_text(f"{good}  A-trades-2024-01.zip\n")
    assert {r.name: r.status for r in archives.checked(spark, str(tmp_path)).collect()} == {"A-trades-2024-01.zip": "ok", "B-trades-2024-01.zip": "unchecked"}
    assert all(r.intact for r in archives.intact(archives.files(spark, str(tmp_path))).collect())
    rows = archives.read_archives(spark, str(tmp_path)).groupBy("name").count().collect()
    assert {r["name"]: r["count"] for r in rows} == {"A-trades-2024-01.zip": 2, "B-trades-2024-01.zip": 3}
    (tmp_path / "A-trades-2024-01.zip.CHECKSUM").write_text("00  A\n")
    with pytest.raises(ValueError, match="checksums"):
        archives.read_archives(spark, str(tmp_path))


def test_write_compact_ledger(spark, tmp_path):
    t = inventory.synthetic_trades(spark, 1000)
    path = str(tmp_path / "t")
    assert inventory.write_trades(t.where("trade_id <= 500"), path) == 500
    assert inventory.write_trades(t.where("trade_id > 500"), path, codec="zstd") == 1000
    assert inventory.compact(spark, path, str(tmp_path / "c"), max_bytes=20_000) == 1000
    files = inventory.parquet_files(spark, str(tmp_path / "c")).orderBy("first_time").collect()
    assert sum(f.rows for f in files) == 1000 and len(files) > 1 and all(a.last_time < b.first_time for a, b in zip(files, files[1:]))
    with pytest.raises(ValueError):
        inventory.write_trades(t, path, codec="brotli")
    (tmp_path / "l.json").write_text('{"downloaded": ["2024-01-01"], "failed": ["2024-01-02"]}')
    assert {(r.date, r.status) for r in inventory.read_ledger(spark, str(tmp_path / "l.json")).collect()} == {("2024-01-01", "downloaded"), ("2024-01-02", "failed")}
    assert csv.harmonise(t.drop("isBestMatch").withColumnRenamed("trade_id", "id")).columns == t.columns


def test_merge(spark):
    old = spark.createDataFrame([(1, 500), (2, 1000)], "trade_id long, ms long")
    new = spark.createDataFrame([(4, 999), (5, 1000), (6, 1001), (6, 1001), (2, 1000)], "trade_id long, ms long")
    assert sorted(r.trade_id for r in merge.newer(new, old).collect()) == [6, 6]
    assert sorted(r.trade_id for r in merge.merge_incremental(old, new, ["trade_id"]).collect()) == [1, 2, 5, 6]
    assert merge.newer(new, old.where("false")).count() == 5


def test_calendar(spark):
    held = spark.sql("SELECT DATE '2024-01-01' AS month UNION ALL SELECT DATE '2024-03-01'")
    lost = calendar.missing(calendar.days(spark, "2024-01-01", "2024-04-01", "1 month").withColumnRenamed("day", "month"), held, ["month"])
    assert sorted(str(r.month) for r in lost.collect()) == ["2024-02-01", "2024-04-01"]
    days = spark.sql("SELECT explode(array(DATE '2024-01-01', DATE '2024-01-02', DATE '2024-01-05')) AS day")
    assert sorted(str(r.missing_day) for r in calendar.daily_gaps(days).collect()) == ["2024-01-03", "2024-01-04"]
    m = spark.sql("SELECT 'A' AS s, explode(array(DATE '2023-03-03', DATE '2023-03-29')) AS t")
    r = calendar.month_gaps(m, "t", ("s",)).first()
    assert (r.days_covered, r.missing_head, r.missing_tail) == (27, 2, 2)


def test_scalars(spark):
    df = spark.createDataFrame([(1704067200,), (1704067200123,), (1704067200123456,)], "t long")
    assert [r.m for r in df.select(scalars.epoch_ms(F.col("t")).alias("m")).collect()] == [1704067200000, 1704067200123, 1704067200123]
    flags = spark.createDataFrame([("true",), ("TRUE",), ("yes",), (None,)], "f string")
    assert [r.b for r in flags.select(scalars.flag(F.col("f")).alias("b")).collect()] == [True, True, False, False]
