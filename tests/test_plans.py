"""What the plans of the registered queries must look like on large data."""

import re

import pytest

import __spark_entry__ as entry
from helpers import plan_of

QUERIES = entry.queries()


def plan(spark, sf_dir, name):
    return plan_of(QUERIES[name](spark, sf_dir))


def test_event_types_are_filtered_in_the_scan(spark, sf_dir):
    text = plan(spark, sf_dir, "order_projection")
    assert re.search(r"PushedFilters: \[Or\(In\(event_type, \[", text)
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in text
    assert text.count("Exchange") == 1


@pytest.mark.parametrize(
    "name, columns",
    [
        ("type_mix", "event_type:string"),
        ("key_placement", "event_id:bigint,user_id:bigint,event_type:string"),
        ("cyclic_products", "o_orderkey:bigint"),
        ("end_offsets", "event_id:bigint,user_id:bigint"),
    ],
)
def test_only_needed_columns_are_read(spark, sf_dir, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(spark, sf_dir, name)


def test_the_tail_bound_reaches_the_scan(spark, sf_dir):
    text = plan(spark, sf_dir, "tail_read")
    assert re.search(r"event_id#\d+L? >= \d+", text.split("FileScan")[-1])


@pytest.mark.parametrize("name", ["retry_outcome", "retry_stage", "contract_check", "type_route", "outbox_relay"])
def test_row_by_row_operators_do_not_shuffle(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text
    assert text.count("FileScan") == 1


@pytest.mark.parametrize("name", ["order_check", "log_offsets"])
def test_no_window_runs_over_a_whole_log_partition(spark, sf_dir, name):
    """The window above the scan is split into blocks; the log is never sent to one task."""
    text = plan(spark, sf_dir, name)
    windows = [line for line in text.splitlines() if "+- Window [" in line]
    assert "_block" in windows[-1] and "SinglePartition" not in text
