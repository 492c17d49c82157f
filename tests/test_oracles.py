"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checker import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.QUERIES, contract.ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def larger():
    return connect("/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_has_rows(larger, name):
    assert larger.execute(f"select count(*) from ({ORACLES[name]})").fetchone()[0] > 0


@pytest.mark.parametrize(("name", "column", "expected"), [
    ("ingest_outcomes", "status", {"SUCCESS", "FAILED", "SKIPPED"}),
    ("ingest_outcomes", "reason", {"already exists", "missing file", "no trade_report rows", None}),
    ("summary_file", "reason", {"already exists", "missing file", "no trade_report rows", None}),
    ("range_ingest", "reason", {"already exists", "missing file", None}),
    ("malformed_rows", "reason", {"field count", "bad timestamp", "bad sale_size", "bad sale_price"}),
])
def test_every_branch_occurs(larger, name, column, expected):
    rows = larger.execute(f"select distinct {column} from ({ORACLES[name]})").fetchall()
    assert {row[0] for row in rows} == expected


def test_trade_filter_reaches_the_scan(spark, capsys):
    QUERIES["large_trades"](spark, SF_DIR).explain("formatted")
    assert "EqualTo(event_type,purchase)" in capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry_returns_rows(spark):
    assert contract.entry(spark).columns == [
        "date", "symbol", "total_volume", "avg_price", "trade_count", "vwap"
    ]
    assert contract.entry(spark).count() > 0
