"""Each registered query against its DuckDB oracle on the smallest scale factor."""

import os

import duckdb
import pytest

from tests.conftest import SF_SMALL
import __spark_entry__ as E
from scripts.check_oracle import TABLES, digest

NAMES = [n for n in E.queries() if n in E.oracle_sql()]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [r.asDict() for r in sdf.collect()]
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    drows = [dict(zip(cols, r)) for r in cur.fetchall()]
    assert sorted(sdf.columns) == sorted(cols)
    assert len(srows) == len(drows)
    assert digest(srows, sorted(cols))[0] == digest(drows, sorted(cols))[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["card", "deck_appearances", "rarity"]
