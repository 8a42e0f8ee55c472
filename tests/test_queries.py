"""Registered queries against their SQL on the smallest data, and the contract of the registry."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
FAST = [
    "etl_reject_funnel", "etl_typed_raw", "etl_enriched", "dim_date", "dim_customer", "dim_product", "dim_location",
    "fact_sales", "surrogate_keys", "kpi_monthly", "kpi_overview_filtered", "kpi_date_range", "kpi_top_customers",
    "kpi_region_rollup", "rfm", "clv", "clv_box", "product_performance", "cohort_retention", "insights",
    "agg_monthly_sales", "behavior_daily", "inventory_snapshot", "feat_segmentation", "feat_invoice", "ts_daily",
    "dq_all", "dq_referential", "profile_numeric", "fc_series", "st_cleanse", "st_sessions",
]


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql(spark, sf_dir, database, name):
    df = contract.queries()[name](spark, sf_dir)
    assert len(set(df.columns)) == len(df.columns)
    expected = database.sql(contract.oracle_sql()[name])
    names = sorted(df.columns)
    assert names == sorted(expected.columns)
    mine = [tuple(_plain(r[c]) for c in names) for r in df.collect()]
    theirs = [tuple(_plain(r[expected.columns.index(c)]) for c in names) for r in expected.fetchall()]
    assert sorted(mine, key=repr) == sorted(theirs, key=repr)


def test_every_sql_belongs_to_a_query():
    from lakemart.plans.oracle import SQL

    assert set(SQL) <= set(contract.queries())


def test_entry_runs(spark):
    assert contract.entry(spark).columns == [
        "Year", "Month", "MonthName", "MonthlyRevenue", "NumOrders", "TotalQuantity", "NumCustomers",
    ]


def test_enrichment_batches_are_bounded_by_bytes(spark, sf_dir, database, monkeypatch):
    """A batch of two files reads the whole dimensions for a number of lines that does not grow with them."""
    from lakemart.streaming import jobs

    files, read = [], jobs.read_stream

    def opened(spark, path, schema, files_per_batch=None, **options):
        files.append(files_per_batch)
        return read(spark, path, schema, files_per_batch, **options)

    monkeypatch.setattr(jobs, "read_stream", opened)
    test_query_matches_sql(spark, sf_dir, database, "st_enrich")
    assert files == [None]
