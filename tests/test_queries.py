"""Every named query against its SQL check on the smallest data."""

import os

import pytest

import __spark_entry__ as spark_entry
from check_queries import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


# one panel per composition; TEST_ALL_PANELS=1 or check_queries.py runs all of them
PANELS = {
    f"panel_{p}"
    for p in (
        "business_orders_per_second_by_status", "business_checkout_latency", "business_payment_failure_rate",
        "business_product_view_series", "ingest_ingest_storage_enabled", "ingest_consumption_by_zone", "table_cpu_percent",
        "table_heap_percent", "table_network_in", "table_fields_per_second", "broker_error_rate", "broker_total_throughput",
        "broker_produce_latency_99p", "group_consumer_throughput", "group_consumer_lag", "group_consumer_lag_by_partition",
        "topic_partition_total", "topic_topic_size", "topic_bytes_in", "topic_partition_messages_in", "topic_consume_statistics",
    )
}
NAMES = [n for n in spark_entry.queries() if not n.startswith("panel_") or n in PANELS or os.environ.get("TEST_ALL_PANELS")]


def test_panel_names():
    assert PANELS <= set(spark_entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = spark_entry.queries()[name](spark, SF_DIR)
    sql = spark_entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, duck, sql) is None


def test_entry(spark):
    assert spark_entry.entry(spark).columns == ["repo", "star_count"]
