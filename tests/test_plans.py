"""What the physical plans must and must not contain."""

import re

import pytest

from suite import QUERIES

SF = "/root/testdata/sf0.001"
# files are written before these return a frame; their plans only read the outcome
STORED = ("suite.storage", "suite.streams")
LAZY = [n for n, fn in QUERIES.items() if fn.__module__ not in STORED]
# joins without keys, each with a one-row aggregate or a list of days given by the caller
KEYLESS = {
    "close_status",
    "close_status_none_done",
    "one_row_cross_join",
    "quality_rules",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cartesian_product_and_no_global_window(spark, name):
    lines = plan(QUERIES[name](spark, SF)).split("\n")
    text = "\n".join(lines)
    assert "CartesianProduct" not in text
    if name not in KEYLESS:
        assert "BroadcastNestedLoopJoin" not in text
    for i, line in enumerate(lines):
        if re.search(r"(^|[-+ ])Window \[", line):
            assert not any("Exchange SinglePartition" in below for below in lines[i + 1 : i + 4])
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text and "MapInPandas" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = QUERIES["acquisition_windows"](spark, SF)
    text = plan(text)
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_conditional_counts_do_not_expand(spark):
    text = plan(QUERIES["conditional_distinct_counts"](spark, SF))
    assert "Expand" not in text
    assert text.count("Exchange hashpartitioning") == 2


def test_only_open_rows_of_a_log_are_shuffled(spark):
    text = plan(QUERIES["repair_linebreak"](spark, SF))
    union = text.split("Union", 1)[1]
    good, _ = re.split(r"\n   :?\+- ", union, maxsplit=1)[0], union
    assert "Exchange" not in good


@pytest.mark.parametrize("name", ["upsert_range", "upsert_range_null_safe"])
def test_range_upsert_reads_its_input_a_fixed_number_of_times(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert len(re.findall(r"Scan parquet .*orders|FileScan parquet \[o_", text)) <= 2


def test_latest_day_is_a_scalar_subquery(spark):
    text = plan(QUERIES["latest_snapshot"](spark, SF))
    assert "ubquery" in text and "Join" not in text
