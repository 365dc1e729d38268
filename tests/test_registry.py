"""Every registered query against its DuckDB oracle on the smallest tables,
plus the driver entry point."""

import duckdb
import pytest

from paths import SF_SMALL
from strobe.plans.compare import same_result
from strobe.plans.registry import ORACLES, QUERIES, load_all
from strobe.plans.tables import TABLES

load_all()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck.execute(ORACLES[name]).df()
    ok, why = same_result(got, want)
    assert ok, why


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == ["user_id", "bucket", "v_value", "v_min", "v_max", "v_mean"]
    assert set(QUERIES) <= set(e.queries())
    assert set(ORACLES) <= set(e.oracle_sql()) <= set(e.queries())
