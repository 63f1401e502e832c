"""Every registered operator against its DuckDB SQL on the smallest test tables."""

import pytest

import __spark_entry__ as E
from reelframe.registry import all_queries
from tests.conftest import SF_SMALL
from tools.check_oracle import compare

KEYS = sorted(all_queries())  # the library's own; the training-data queries have tests in tests/llm


def test_every_key_is_registered_and_has_an_oracle():
    assert set(KEYS) <= set(E.queries())
    assert set(KEYS) <= set(E.oracle_sql())


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["genre", "position", "title", "year", "rating"]


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, key):
    report = compare(spark, SF_SMALL, [key], verbose=False)[key]
    assert "error" not in report, report.get("error")
    if report["oracle"]:
        assert report["cols_match"], report
        assert report["types_match"], report
        assert report["spark_rows"] == report["oracle_rows"], report
        assert report["values_match"], report
