"""Every registered query against its oracle. ORACLE_SF chooses the scale factor."""

import os

import pytest

import __spark_entry__ as contract
from compare import differences
from racestream.plans.queries import QUERIES

FOLDER = f"/root/testdata/sf{os.environ.get('ORACLE_SF', '0.001')}"


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_oracle(spark, name):
    result = contract.queries()[name](spark, FOLDER)
    only_spark, only_duckdb, rows = differences(result, contract.oracle_sql()[name], FOLDER)
    assert not only_spark and not only_duckdb
    assert rows > 0


def test_entry_has_the_expected_rows(spark):
    result = contract.entry(spark)
    assert result.columns == ["window_start", "position", "driver_number"]
    assert result.count() == 373
