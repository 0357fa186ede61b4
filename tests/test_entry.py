import duckdb
import pytest

import __spark_entry__ as E
from fleetspark.plans import catalog
from tools.check_oracle import TABLES, canon

BATCH_SUBSET = [
    "daily_revenue", "shipment_quarantine", "scd2_tracked", "master_scd2_tracked", "vehicle_scorecard",
    "asof_dimension_join", "fuel_cost_efficiency", "nearest_reading", "route_position", "trip_distance",
    "latest_events_topk",
]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["shipment_date", "route_name", "priority", "revenue"]
    assert df.count() > 0


def test_every_query_of_the_library_has_an_oracle():
    own = set(catalog.queries())
    assert own <= set(E.queries())
    assert own == own & set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", BATCH_SUBSET)
def test_matches_oracle(spark, sf_small, con, name):
    df = E.queries()[name](spark, sf_small)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = sorted(df.columns)
    a = canon([tuple(r[c] for c in order) for r in df.collect()])
    oc = rel.columns
    b = canon([tuple(r[oc.index(c)] for c in order) for r in rel.fetchall()])
    assert a == b
