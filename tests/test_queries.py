"""Every query that SQL can express, held against DuckDB on the smallest tables."""

import os

import numpy as np
import pandas as pd
import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list[str]:
    df = df[sorted(df.columns)]
    plain = lambda v: "-" if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and np.isnan(v)) else str(list(v)) if isinstance(v, (list, np.ndarray)) else float(v) if isinstance(v, (int, float, np.number)) and not isinstance(v, (bool, np.bool_)) else v
    return sorted(str([plain(v) for v in r]) for r in df.itertuples(index=False, name=None))


def catalogue():
    from tickloom import catalogue

    return catalogue


@pytest.mark.parametrize("name", sorted(catalogue().oracle_sql()))
def test_query(spark, duck, name):
    got = catalogue().queries()[name](spark, SF).toPandas()
    want = duck.execute(catalogue().oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_run_bars_conserve(spark):
    from tickloom.operators.bars import bars
    from tickloom.trades import trades_ev

    t = trades_ev(spark, SF)
    assert bars(t, "run", {"init_t": 5000.0}, emit_partial=True).groupBy().sum("ticks").first()[0] == t.count()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_without_the_corpus_part(tmp_path):
    """The engine alone, as it is when the optional folders are gone."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    top = Path(__file__).resolve().parents[1]
    shutil.copytree(top / "tickloom", tmp_path / "tickloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (top / name).exists():
            shutil.copy(top / name, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'standard_dollar_bars' in q and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
