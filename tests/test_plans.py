"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from streammart.checks.queries import REGISTRY

# Queries that only plan; those that write tables or run streams are left to the other tests.
LAZY = [
    n
    for n in sorted(REGISTRY)
    if not n.startswith(("src_", "sink_", "serve_", "stream_"))
]


def plan(spark, name: str, broadcast: bool = True) -> str:
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB" if broadcast else "-1")
    try:
        df = entry.queries()[name](spark, SMALL)
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", LAZY)
def test_no_pairs_and_no_python(spark, name):
    """Tables too large to broadcast: still no cross product, no nested loops, no Python."""
    text = plan(spark, name, broadcast=False)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text
    assert "BroadcastExchange" not in text


@pytest.mark.parametrize(
    "name",
    """win_traffic_by_dims win_home_detail_uv win_cart_uu win_sku_amounts win_province_orders
    state_fix_new_flag state_first_of_day state_retract_offsets state_latest_per_key
    state_first_seen dim_apply_changes cfg_current""".split(),
)
def test_rows_of_a_key_are_never_sorted_in_one_task(spark, name):
    assert not re.search(r"\bWindow \[", plan(spark, name))


@pytest.mark.parametrize("name", ["win_login_back", "win_payment_users", "win_order_users"])
def test_window_functions_see_days_not_events(spark, name):
    text = plan(spark, name)
    window = re.search(r"\bWindow \[", text).start()
    below = text[window:]
    assert below.index("HashAggregate") < below.index("FileScan")


@pytest.mark.parametrize("name", ["win_global_sum", "win_register", "win_keyword_count"])
def test_sums_are_reduced_before_the_shuffle(spark, name):
    text = plan(spark, name)
    below = text[text.index("Exchange") :]
    assert "partial_" in below


def test_scans_read_only_what_is_used(spark):
    text = plan(spark, "win_payment_users")
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>", text)
    assert "EqualTo(event_type,purchase)" in text


def test_a_day_opens_one_folder(spark):
    df = entry.queries()["serve_gmv"](spark, SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
    assert "cur_date" in filters and "2024-01-01" in filters


@pytest.mark.parametrize("name", ["route_dims", "route_facts"])
def test_routes_are_a_constant_and_the_log_stays_where_it_is(spark, name):
    text = plan(spark, name)
    assert "Join" not in text and "Exchange" not in text
    assert "from_json" not in text  # folded into a literal


def test_a_table_of_the_split_log_opens_its_folders_only(spark):
    text = plan(spark, "fact_order_detail_split", broadcast=False)
    scans = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", text)
    opened = [re.search(r"table#\d+ = (\w+)", filters).group(1) for filters in scans]
    assert sorted(opened) == ["order_detail", "order_detail_activity", "order_detail_coupon", "order_info"]
    assert "from_json" not in text
