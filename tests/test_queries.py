"""Every named query against its SQL."""

import sys
from types import SimpleNamespace

import pytest
from compare import duck_rows, spark_rows

import __spark_entry__ as contract
from kerbflow.catalogue import QUERIES
from kerbflow.oracle import SQL

SF = "/root/testdata/sf0.01"


def test_names_match():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "window_start",
        "window_end",
        "pickup_location",
        "trip_count",
        "avg_fare",
        "total_fare",
        "avg_trip_distance",
    ]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    names, rows = spark_rows(contract.queries()[name](spark, SF))
    expected_names, expected = duck_rows(contract.oracle_sql()[name], SF)
    assert names == expected_names
    assert rows == expected


@pytest.mark.parametrize("missing", ["corpus_pipeline", "kerbflow.llm"])
def test_base_queries_stay_when_the_corpus_part_cannot_be_imported(monkeypatch, missing):
    monkeypatch.setitem(sys.modules, missing, None)
    with pytest.warns(UserWarning, match="left out"):
        assert contract._corpus() == ({}, {})


def test_a_fault_of_the_corpus_part_is_not_hidden(monkeypatch):
    monkeypatch.setitem(sys.modules, "kerbflow.llm", SimpleNamespace(queries=SimpleNamespace(QUERIES={}, SQL={})))
    monkeypatch.setitem(sys.modules, "corpus_pipeline", SimpleNamespace())
    with pytest.raises(AttributeError):
        contract._corpus()
