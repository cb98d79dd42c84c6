"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from verification.check import compare

QUERIES = {k: q for k, q in entry.queries().items() if k not in {*entry.LLM_QUERIES}}
SQL = {k: q for k, q in entry.oracle_sql().items() if k not in {*entry.LLM_QUERIES}}


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 24


@pytest.mark.parametrize("key", [k for k in QUERIES if not k.startswith("stream_")])
def test_query_matches_sql(spark, folder, key):
    assert compare(spark, folder, QUERIES[key], SQL[key]) == ""


# The others are compared with their batch forms in test_streams.
STREAMS = "hourly_top_tips popular_places rides_and_fares nearest_taxi ongoing_rides taxi_query".split()


@pytest.mark.parametrize("key", [f"stream_{k}" for k in STREAMS])
def test_stream_matches_sql(spark, folder, key):
    assert compare(spark, folder, QUERIES[key], SQL[key]) == ""
