"""Every registered query against its DuckDB oracle on the smallest tables,
plus the driver contract."""
import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SMALL
from tools.check_oracle import TABLES, digest, spark_rows

KEYS = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_contract(spark):
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    df = E.entry(spark)
    assert df.columns == ["run_dir", "name", "stem", "pass_rate"]
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    cols, rows = spark_rows(E.queries()[key](spark, SMALL))
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert len(cols) > 0
        return
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = [list(r) for r in res.fetchall()]
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(cols, rows)[0] == digest(dcols, drows)[0]
