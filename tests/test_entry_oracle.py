"""Driver contract and oracle parity on the smallest scale factor."""

import importlib.util
import os

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"
spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
entry_mod = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry_mod)

from scripts_check import compare  # noqa: E402

SQL = entry_mod.oracle_sql()
SLOW = {"grid_search", "mlp_fit", "forest_fit", "model_summary"}


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert set(df.columns) >= {"window_id", "mav", "mean_x"}
    df.count()


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(entry_mod.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    got = entry_mod.queries()[name](spark, SF).toPandas()
    exp = con.execute(SQL[name]).df()
    ok, msg = compare(got, exp)
    assert ok, msg
