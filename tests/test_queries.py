"""Every query against its SQL on the smallest tables. Those that write hundreds of folders run in tests.oracle_check."""

import pytest

import __spark_entry__ as contract
from aeroline.plans.catalogue import QUERIES
from oracle.statements import STATEMENTS
from tests.conftest import SF_DIR
from tests.oracle_check import compare, connect

SLOW = {"bronze_partitions", "medallion_fact", "warehouse_fact", "medallion_two_deliveries", "stream_landing", "stream_join_inner", "stream_join_left", "validation_report", "job_end_to_end",
        "reprocessed_facts", "reprocessing_checks", "job_report", "history_windows", "stream_interval_inner", "stream_interval_left", "stream_join_anti",
        "catalogue_readings", "listed_unprocessed_partitions", "archived_batches"}


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_equals_sql(spark, connection, name):
    problem, _, _ = compare(spark, connection, name, QUERIES[name], STATEMENTS[name], SF_DIR)
    assert problem is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(STATEMENTS)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_flagship_query(spark):
    assert contract.entry(spark).columns == ["date", "hour", "avg_aqi"]
    assert contract.entry(spark).count() > 0
