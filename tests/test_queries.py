"""Every registered query runs at sf0.001 and matches its DuckDB oracle; entry() runs."""

import pytest

import __spark_entry__ as entry
from homesense.plans.catalog_of_queries import REGISTRY
from homesense.plans.compare import compare, duckdb_with_views

SF = "/root/testdata/sf0.001"
QUERIES = {name: q.fn for name, q in REGISTRY.items()}     # the library's own; the others have their own tests
ORACLE = {name: q.sql for name, q in REGISTRY.items() if q.sql}


@pytest.fixture(scope="module")
def con():
    return duckdb_with_views(SF)


def test_entry(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["transition", "n", "mean_dur_s"] and len(rows) > 0


def test_every_query_has_an_oracle_or_is_listed():
    assert sorted(set(QUERIES) - set(ORACLE)) == []
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    pdf = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLE:
        assert len(pdf) > 0
        return
    ok, why = compare(pdf, con.sql(ORACLE[name]).df())
    assert ok, why


TIME_HEAVY = ["localize", "utc_to_local", "epoch_to_local", "dst_shift", "sleep_dailies", "activity_weeklies",
              "time_cdf", "incremental_append", "physiology", "legacy_doors"]


@pytest.mark.parametrize("name", TIME_HEAVY)
def test_session_time_zone_does_not_change_results(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        pdf = QUERIES[name](spark, SF).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ok, why = compare(pdf, con.sql(ORACLE[name]).df())
    assert ok, why
