"""Edge cases per operator, on rows written here."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from conftest import collect
from streammart import schemas
from streammart.functions import camel_name, snake_columns, snake_name, today_partition
from streammart.functions.text import explode_words
from streammart.operators import changelog as cl
from streammart.operators import joins, logs, state
from streammart.operators.windows import tumble_agg
from streammart.plans import facts, serving, summaries
from streammart.sources import topics

COMMON = {"ar": "1", "ba": "b", "ch": "web", "is_new": "0", "md": "m", "mid": "d1", "os": "o", "sid": "s", "uid": "7", "vc": "v1"}
DISPLAY = {"item": "4", "item_type": "sku_id", "pos_id": 5, "pos_seq": 1}
ACTION = {"action_id": "get_coupon", "item": "1", "item_type": "coupon_id", "ts": 1700000000500}
START_LOG = {"common": COMMON, "start": {"entry": "icon", "loading_time": 3, "open_ad_id": 1, "open_ad_ms": 2, "open_ad_skip_ms": 0}, "ts": 1700000000000}
PAGE_LOG = {"common": COMMON, "page": {"page_id": "home", "during_time": 9}, "displays": [DISPLAY] * 10, "actions": [ACTION] * 3, "ts": 1700000000001}
ERR_LOG = {"common": COMMON, "page": {"page_id": "cart", "during_time": 8}, "err": {"error_code": 1234, "msg": "boom"}, "displays": [DISPLAY] * 6, "actions": [ACTION] * 2, "ts": 1700000000002}


def messages(spark, *values):
    texts = [v if v is None or isinstance(v, str) else json.dumps(v) for v in values]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def change(table, type, data, old=None, ts=1700000000, database="shop"):
    return {"database": database, "table": table, "type": type, "ts": ts, "data": data, "old": old}


def changes(spark, *items):
    return topics.parse_changelog(messages(spark, *items), delay=None)


def at(spark, rows, ddl):
    """Rows whose ``et`` is given as text."""
    return spark.createDataFrame(rows, ddl).withColumn("et", F.to_timestamp("et"))


def test_log_split_counts(spark):
    good, bad = logs.split_bad_records(messages(spark, START_LOG, PAGE_LOG, ERR_LOG, "{oops", "", None, "[1]", "3"))
    counts = {name: df.count() for name, df in logs.split_log(good).items()}
    assert counts == {"start": 1, "page": 2, "display": 16, "action": 5, "err": 1}
    assert sorted(r[0] for r in bad.collect()) == ["", "3", "[1]", "{oops"]


def test_start_with_err_is_in_both_and_pageless_is_in_neither(spark):
    both = {**START_LOG, "err": {"error_code": 1, "msg": "m"}, "displays": [DISPLAY]}
    pageless = {"common": COMMON, "ts": 5}
    out = logs.split_log(logs.split_bad_records(messages(spark, both, pageless))[0])
    assert {n: d.count() for n, d in out.items()} == {"err": 1, "start": 1, "display": 0, "action": 0, "page": 0}


def test_action_time_replaces_record_time(spark):
    good, _ = logs.split_bad_records(messages(spark, PAGE_LOG))
    assert {r["ts"] for r in logs.explode_actions(good).collect()} == {1700000000500}
    assert {r["ts"] for r in logs.explode_displays(good).collect()} == {1700000000001}


def test_parse_is_evaluated_once(spark):
    good, _ = logs.split_bad_records(messages(spark, PAGE_LOG))
    plan = good.filter("ts > 0")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") <= 1


def test_changelog_cleaning(spark):
    data = {"id": "1"}
    df = changes(
        spark,
        change("t", "insert", data),
        change("t", "bootstrap-insert", data),
        change("t", "bootstrap-start", data),
        change("t", "insert", {}),
        change("t", "insert", None),
        change("t", "insert", data, database="other"),
        "{bad",
        "",
    )
    assert cl.clean_changelog(df, "shop").count() == 2
    assert cl.drop_bootstrap(df).count() == 4


def test_numbers_become_text_and_seconds_become_time(spark):
    row = changes(spark, change("t", "insert", {"a": 2.5, "b": {"c": 1}})).first()
    assert row["data"] == {"a": "2.5", "b": '{"c":1}'}
    assert row["et"].timestamp() == 1700000000


def test_cart_additions(spark):
    df = changes(
        spark,
        change("cart_info", "insert", {"id": "1", "sku_num": "3"}),
        change("cart_info", "update", {"id": "2", "sku_num": "5"}, {"sku_num": "2"}),
        change("cart_info", "update", {"id": "3", "sku_num": "1"}, {"sku_num": "2"}),
        change("cart_info", "update", {"id": "4", "sku_num": "1"}, {"checked": "0"}),
        change("order_detail", "update", {"id": "5", "sku_num": "9"}, {"sku_num": "1"}),
        change("cart_info", "update", {"id": "6", "sku_num": "x"}, {"sku_num": "1"}),
    )
    got = {r["id"]: r["sku_num"] for r in facts.fact_cart_add(df).collect()}
    assert got == {"1": 3, "2": 3}


def test_transition(spark):
    df = changes(
        spark,
        change("o", "update", {"id": "1", "s": "3"}, {"s": "1"}),
        change("o", "update", {"id": "2", "s": "3"}, {"s": "2"}),
        change("o", "update", {"id": "3", "s": "3"}, {"other": "2"}),
        change("o", "insert", {"id": "4", "s": "3"}),
    )
    ids = lambda d: sorted(r["data"]["id"] for r in d.collect())
    assert ids(cl.transition(df, "s", "3", "1")) == ["1"]
    assert ids(cl.transition(df, "s", "3")) == ["1", "2"]


def route(table, sink, columns="id"):
    return {"source_table": table, "sink_table": sink, "sink_family": "info", "sink_columns": columns, "sink_row_key": "id"}


def test_current_config(spark):
    snapshot = spark.createDataFrame([tuple(route("a", "dim_a").values()), tuple(route("b", "dim_b").values())], schemas.DIM_ROUTE)
    log = topics.parse_config_changes(
        messages(
            spark,
            {"op": "u", "ts_ms": 5, "before": route("a", "dim_a"), "after": route("a2", "dim_a2")},
            {"op": "d", "ts_ms": 6, "before": route("b", "dim_b"), "after": None},
            {"op": "c", "ts_ms": 7, "before": None, "after": route("c", "dim_c")},
            {"op": "u", "ts_ms": 8, "before": route("c", "dim_c"), "after": route("c", "dim_c", "id,x")},
        )
    )
    got = {r["source_table"]: r["sink_columns"] for r in cl.current_config(snapshot, log, ["source_table"]).collect()}
    assert got == {"a2": "id", "c": "id,x"}
    assert cl.current_config(snapshot, None, ["source_table"]).count() == 2


def test_config_snapshot_comes_first(spark, tmp_path):
    snapshot = spark.createDataFrame([tuple(route("a", "dim_a").values())], schemas.DIM_ROUTE)
    (tmp_path / "routes").mkdir()
    later = {"op": "u", "ts_ms": 5, "before": route("a", "dim_a"), "after": route("a", "dim_z")}
    (tmp_path / "routes" / "0.txt").write_text(json.dumps(later) + "\n")
    both = topics.read_config_changes(spark, snapshot, topics="routes", root=str(tmp_path))
    assert [r["op"] for r in both.orderBy("ts_ms").collect()] == ["r", "u"]
    assert cl.current_config(None, both, ["source_table"]).first()["sink_table"] == "dim_z"


def test_dim_changes_patch_cell_by_cell(spark):
    dim = spark.createDataFrame([("1", "old", "x"), ("2", "two", "y"), ("9", "keep", "z")], "row_key string, a string, b string")
    df = spark.createDataFrame(
        [
            ("1", "update", {"a": "new", "b": None}, 1),
            ("2", "delete", {}, 1),
            ("2", "insert", {"a": "again"}, 2),
            ("3", "insert", {"a": "p", "b": "q"}, 1),
            ("3", "update", {"a": "r"}, 2),
            ("4", "insert", {"a": "gone"}, 1),
            ("4", "delete", {}, 2),
        ],
        "row_key string, type string, data map<string,string>, ts int",
    )
    out = cl.apply_dim_changes(dim, df, ["a", "b"], ["ts"])
    assert collect(out.select("row_key", "a", "b")) == sorted(
        [("new", "x", "1"), ("again", None, "2"), ("r", "q", "3"), ("keep", "z", "9")], key=repr
    )
    wiped = cl.apply_dim_changes(dim, df, ["a", "b"], ["ts"], null_overwrites=True)
    assert ("new", None, "1") in collect(wiped.select("row_key", "a", "b"))


def test_route_facts_adds_time_and_prunes(spark):
    config = spark.createDataFrame([("c", "insert", "dwd_c", "id,ts")], schemas.FACT_ROUTE)
    df = changes(spark, change("c", "insert", {"id": "1", "x": "2", "ts": "old"}), change("c", "update", {"id": "2"}))
    rows = cl.route_facts(df, config).collect()
    assert [(r["sink_table"], r["data"]) for r in rows] == [("dwd_c", {"id": "1", "ts": "1700000000"})]


def test_new_flag_over_two_days(spark):
    df = at(
        spark,
        [
            ("a", "1", "2024-01-01 10:00:00", 1),
            ("a", "1", "2024-01-01 11:00:00", 2),
            ("a", "1", "2024-01-02 10:00:00", 3),
            ("b", "0", "2024-01-01 10:00:00", 4),
            ("b", "1", "2024-01-01 11:00:00", 5),
            (None, "1", "2024-01-01 11:00:00", 6),
            (None, "1", "2024-01-03 11:00:00", 7),
        ],
        "mid string, flag string, et string, n int",
    )
    got = {r["n"]: r["is_new"] for r in state.fix_new_flag(df, "mid", "flag").collect()}
    assert got == {1: "1", 2: "1", 3: "0", 4: "0", 5: "0", 6: "1", 7: "0"}


def test_return_after_eight_days(spark):
    df = at(
        spark,
        [
            ("a", "2024-01-01 23:00:00"),
            ("a", "2024-01-08 23:59:59"),  # 7 days 23 h 59 min after midnight of the first
            ("b", "2024-01-01 23:00:00"),
            ("b", "2024-01-09 00:00:00"),  # 8 days after midnight of the first
        ],
        "uid string, et string",
    )
    rows = state.login_flags(df, "uid").collect()
    assert sum(r["uu_ct"] for r in rows) == 4 and sum(r["back_ct"] for r in rows) == 1


def test_first_and_new_are_named_right(spark):
    df = at(spark, [("u", "2024-01-01 00:00:01"), ("u", "2024-01-01 00:00:02"), ("u", "2024-01-02 00:00:01")], "user_id string, et string")
    rows = summaries.order_users(df, width="1 day").orderBy("stt").collect()
    assert [(r["order_unique_user_count"], r["order_new_user_count"]) for r in rows] == [(1, 1), (1, 0)]


def test_three_versions_leave_the_last(spark):
    rows = [("d", "o", "5", "2024-01-01 00:00:01", n, a) for n, a in ((1, "10.00"), (2, None), (3, "7.00"))]
    df = at(spark, rows, "id string, order_id string, province_id string, et string, v int, split_total_amount string")
    offset = state.offset_versions(
        df.withColumn("m", F.col("split_total_amount").cast("decimal(16,2)")), ["id"], ["et", "v"], ["m"]
    )
    assert offset.count() == 5
    assert float(offset.agg(F.sum("m")).first()[0]) == 7.0
    total = summaries.province_totals(df, order=("et", "v")).collect()
    assert [(r["order_count"], float(r["order_amount"])) for r in total] == [(1, 7.0)]


def test_left_join_with_a_bound(spark):
    left = at(spark, [("1", "2024-01-01 00:00:00"), ("2", "2024-01-01 00:00:00")], "id string, et string")
    right = at(spark, [("1", "x", "2024-01-01 00:00:31"), ("2", "y", "2024-01-01 00:00:30")], "rid string, c string, et string")
    out = joins.fact_join(left, right, ("id", "rid"), "left", "30 seconds")
    assert {r["id"]: r["c"] for r in out.collect()} == {"1": None, "2": "y"}


def test_interval_join_finds_each_pair_once(spark):
    """Against a plain range join, with times on and around slot borders."""
    base = spark.range(0, 4000, 7).select(F.lit("k").alias("k"), F.timestamp_seconds("id").alias("et"), F.col("id").alias("p"))
    other = spark.range(0, 4000, 11).select(F.lit("k").alias("k"), F.timestamp_millis(F.col("id") * 1000 + 500).alias("et"), F.col("id").alias("q"))
    got = joins.interval_join(base, other, "k", "100 seconds", "5 seconds").select("p", "q")
    want = [(p, q) for p in range(0, 4000, 7) for q in range(0, 4000, 11) if p - 100 <= q + 0.5 <= p + 5]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_missing_dimension_row(spark):
    df = spark.createDataFrame([("1",), ("2",), (None,)], "k string")
    dim = spark.createDataFrame([("1", "one")], "id string, name string")
    assert {r["k"]: r["n"] for r in joins.enrich(df, dim, "k", {"n": "name"}, on_missing="null").collect()} == {"1": "one", "2": None, None: None}
    assert joins.enrich(df, dim, "k", {"n": "name"}, on_missing="drop").count() == 1
    with pytest.raises(Exception, match="no dimension row for k"):
        joins.enrich(df, dim, "k", {"n": "name"}).collect()
    assert joins.enrich(df.filter("k = '1'"), dim, "k", {"n": "name"}).count() == 1


def test_two_lookups_of_one_dictionary(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    dic = spark.createDataFrame([("1", "one"), ("2", "two")], "dic_code string, dic_name string")
    once = joins.lookup(df, dic, "a", "dic_code", {"a_name": "dic_name"})
    twice = joins.lookup(once, dic, "b", "dic_code", {"b_name": "dic_name"})
    assert tuple(twice.first()) == ("1", "2", "one", "two")


def test_words(spark):
    df = spark.createDataFrame([("Red red BLUE-5g!",), ("...",), (None,)], "p string")
    assert sorted(r["word"] for r in explode_words(df, "p").collect()) == ["5g", "blue", "red"]
    pairs = lambda text: [text[i : i + 2] for i in range(0, len(text), 2)]
    got = explode_words(spark.createDataFrame([("小米小米手机",)], "p string"), "p", segmenter=pairs)
    assert sorted(r["word"] for r in got.collect()) == ["小米", "手机"]


def test_words_in_sql(spark):
    from streammart.functions import register_functions

    register_functions(spark)
    spark.createDataFrame([(1, "Red red BLUE"), (2, "...")], "n int, keyword string").createOrReplaceTempView("phrases")
    got = spark.sql("SELECT n, word FROM phrases, LATERAL split_words(phrases.keyword)").collect()
    assert sorted(tuple(r) for r in got) == [(1, "blue"), (1, "red")]


def test_custom_accumulator(spark):
    df = at(spark, [(2.0, "2024-01-01 00:00:01"), (4.0, "2024-01-01 00:00:02")], "x double, et string")
    out = tumble_agg(df, [], [F.sum("x").alias("s"), F.count("x").alias("n")], result=[(F.col("s") / F.col("n")).alias("mean")])
    assert [tuple(r) for r in out.collect()] == [("2024-01-01 00:00:00", "2024-01-01 00:00:10", "2024-01-01", 3.0)]


def test_names(spark):
    assert snake_name("orderAmountCt") == "order_amount_ct" and camel_name("order_amount") == "orderAmount"
    assert snake_columns(spark.createDataFrame([(1,)], "uvCt int")).columns == ["uv_ct"]


def test_serving_today_and_series(spark):
    today = spark.range(1).select(F.date_format(F.current_date(), "yyyy-MM-dd"), today_partition()).first()
    df = spark.createDataFrame([(today[0], "b", 2), (today[0], "a", 2), (today[0], "c", 9), ("2020-01-01", "d", 99)], "cur_date string, ch string, uv_ct bigint")
    for day in (None, today[1]):
        top = serving.channel_uv(df, day, limit=2)
        assert [tuple(r) for r in top.collect()] == [("c", 9), ("a", 2)]
    row = serving.as_series(serving.channel_uv(df, limit=2), "ch", "uv_ct", "channel").first()
    assert (row["categories"], row["data"]) == (["c", "a"], [9, 2])


def test_processing_times(spark):
    row = facts.with_processing_times(spark.range(1)).first()
    assert row["ct"] == row["pt"] and row["uct"] == row["ut"] > 1_700_000_000


@pytest.mark.parametrize("limit", [10, 1])
def test_routes_by_constant_and_by_join_agree(spark, limit):
    """Several routes of one table, routes with NULL, names with quotes, more routes than fit, none at all."""
    rows = [("a", "insert", 1), ("a", "update", 2), ("b", "insert", 3), ("o'\"x", "insert", 4), (None, "insert", 5), ("a", None, 6)]
    changes = spark.createDataFrame(rows, "`table` string, type string, n int")
    routes = [("a", "insert", "one"), ("a", "insert", "two"), ("a", None, "no"), (None, "insert", "no"), ("o'\"x", "insert", "q"), ("c", "insert", "no")]
    config = spark.createDataFrame(routes, "source_table string, source_type string, sink_table string")
    on = {"table": "source_table", "type": "source_type"}
    got = cl.with_routes(changes, config, on, limit)
    assert collect(got.select("n", "_route.sink_table")) == [(1, "one"), (1, "two"), (4, "q")]
    assert cl.with_routes(changes, config.limit(0), on, limit).count() == 0


def chained(spark):
    """Rows with a key, and a chain of three dimensions: a has a NULL and a dangling key, two rows of b share an id."""
    dims = {
        "a": spark.createDataFrame([("1", "x"), ("2", "y"), ("3", "gone"), ("4", None)], "id string, b string"),
        "b": spark.createDataFrame([("x", "p", "bx"), ("x", "p", "bx2"), ("y", "q", "by")], "id string, c string, name string"),
        "c": spark.createDataFrame([("p", "cp")], "id string, name string"),
    }
    steps = [(dims["a"], "k", {"b": "b"}), (dims["b"], "b", {"c": "c", "b_name": "name"}), (dims["c"], "c", {"c_name": "name"})]
    return spark.range(6).select(F.nullif("id", F.lit(0)).cast("string").alias("k")), steps


def test_a_chain_gives_what_its_steps_give(spark):
    rows, steps = chained(spark)
    found = [("1", "x", "p", "bx", "cp"), ("1", "x", "p", "bx2", "cp")]
    rest = [("2", "y", "q", "by", None), ("3", "gone", None, None, None), ("4", None, None, None, None), ("5", None, None, None, None), (None, None, None, None, None)]
    names = ["k", "b", "c", "b_name", "c_name"]
    got = {how: sorted(map(tuple, joins.enrich_chain(rows, steps, on_missing=how).select(names).collect()), key=repr) for how in ("drop", "null")}
    assert got == {"drop": sorted(found, key=repr), "null": sorted(found + rest, key=repr)}
    assert joins.enrich_chain(rows.filter("k = '1'"), steps).count() == 2
    for k, message in (("'2'", "c = q"), ("'3'", "b = gone"), ("'4'", "b = NULL"), ("'5'", "k = 5"), ("null", "k = NULL")):
        with pytest.raises(Exception, match=f"no dimension row for {message}"):
            joins.enrich_chain(rows.filter(f"k <=> {k}"), steps).collect()
    with pytest.raises(ValueError):
        joins.enrich_chain(rows, steps, on_missing="ignore")


@pytest.mark.parametrize("how", ["fail", "null", "drop"])
def test_rows_meet_a_chain_of_dimensions_in_one_join(spark, how):
    """Dimensions are joined to each other first: many rows are not shuffled by a key with few values."""
    rows, steps = chained(spark)
    text = joins.enrich_chain(rows, steps, on_missing=how)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = next(i for i, line in enumerate(text) if "Range (" in line)
    above, level = [], depth(text[at])
    for line in reversed(text[:at]):
        if depth(line) < level:
            level = depth(line)
            above.append(line)
    assert sum("Join" in line for line in above) == 1


def test_a_product_whose_lines_were_all_replaced_keeps_its_row_with_zeros(spark):
    rows = spark.createDataFrame(
        [("1", "a", "old", "2024-01-01 00:00:01", 1, "9.00"), ("1", "b", "new", "2024-01-01 02:00:00", 2, "5.00"), ("2", "b", "newer", "2024-01-01 02:00:05", 1, None), ("2", None, None, "2024-01-01 02:00:01", 1, "x")],
        "id string, sku_id string, sku_name string, et string, v int, amount string",
    )
    lines = rows.select("id", "sku_id", "sku_name", F.col("et").cast("timestamp").alias("et"), "v", *[F.col("amount").alias(c) for c, _ in summaries.SKU_AMOUNTS.values()])
    out = summaries.sku_amounts(lines, "1 hour", order=("et", "v"))
    got = {(r["stt"][11:13], r["sku_id"]): (r["sku_name"], *[str(r[c]) for c in summaries.SKU_AMOUNTS]) for r in out.collect()}
    zeros = ("0.0000", "0.00", "0.00", "0.00")
    assert got == {("00", "a"): ("old", *zeros), ("02", "b"): ("newer", "5.0000", "5.00", "5.00", "5.00"), ("02", None): (None, *zeros)}
