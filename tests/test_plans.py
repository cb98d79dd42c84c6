"""What the physical plans must look like."""

import re

import pytest

import __spark_entry__ as entry
from rillstone import views
from rillstone.operators import relational
from rillstone.plans import bikes, rides

QUERIES = entry.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


def test_only_needed_columns_are_read(spark, folder):
    text = plan(bikes.zip_codes_over(views.table(spark, folder, "lineitem").selectExpr("l_partkey zip_code", "l_quantity duration")))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in text
    assert exchanges(text) == 1 and "partial_sum" in text


def test_filters_reach_the_scan(spark, folder):
    text = plan(relational.selection(views.table(spark, folder, "customer"), views.F.col("c_acctbal") > 10))
    assert "GreaterThan(c_acctbal,10.0)" in text


@pytest.mark.parametrize(
    "key, moves",
    [
        ("ride_cleansing", 0), ("increment_map", 0), ("rides_table_view", 0), ("posts_xml_parse", None), ("dedup_first", 1),
        ("hourly_tips", 1), ("hourly_top_tips", 2), ("popular_places", 2), ("rides_per_hour", 1), ("ride_count", 1),
        ("nearest_taxi", 1), ("latest_ride_per_taxi", 1), ("route_cell_traffic", 2), ("matvec_join", 2), ("matmul_join", 1),
    ],
)
def test_number_of_shuffles(spark, folder, key, moves):
    text = plan(QUERIES[key](spark, folder))
    if moves is not None:
        assert exchanges(text) == moves
    assert "CartesianProduct" not in text


# After the range partitioning: one shuffle of the rows by group and range, and four of the carry table (groups and ranges,
# groups with several, their totals, the window over them), of a row per group and range at most. Then what the query adds.
@pytest.mark.parametrize(
    "key, more",
    [
        ("driving_segments", 1), ("driving_sessions", 1), ("travel_time_prediction", 0), ("ride_count_running", 0),
        ("rule_pair_match", 0), ("asof_enrich", 0), ("inverted_index", 1),
    ],
)
def test_shuffles_of_ordered_queries(spark, folder, key, more):
    text = plan(QUERIES[key](spark, folder))
    assert exchanges(text) == 5 + more
    assert len(re.findall("FileScan", text)) == 3 and len(re.findall(r"FileScan.*/ranges-", text)) == 3
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert len(re.findall(r"hashpartitioning\([^()]*_slice#\d+, \d+\), ENSURE", text)) >= 2


@pytest.mark.parametrize("key", ["word_count", "matmul_join", "hourly_tips", "nearest_taxi", "latest_ride_per_taxi", "rides_per_hour"])
def test_rows_are_combined_before_the_shuffle(spark, folder, key):
    assert re.search(r"partial_", plan(QUERIES[key](spark, folder)))


def test_no_python_in_column_queries(spark, folder):
    for key in ("ride_lines_parse", "car_lines_parse", "posts_xml_parse", "travel_time_prediction", "farthest_stations"):
        assert not re.search(r"Python|Pandas", plan(QUERIES[key](spark, folder)))


def test_reused_input_is_scanned_once(spark, folder):
    """START and END events come from one pass over the orders."""
    assert plan(rides.rides_per_hour(views.rides(spark, folder))).count("FileScan") == 1
