"""One query per operator, over whole test tables. The matching SQL is in ``oracle``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streammart import schemas
from streammart.checks import views as v
from streammart.functions import (
    as_decimal,
    as_int,
    colon_key,
    day_of,
    day_start_ms,
    epoch_ms,
    is_blank,
    partition_day,
    stamp_of,
)
from streammart.operators import changelog as cl
from streammart.operators import joins, logs, state
from streammart.plans import facts, serving, summaries
from streammart.session import configure, scratch_path, setting
from streammart.sources import sinks, topics, upserts

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def plain(df: DataFrame, *drop: str) -> DataFrame:
    """Comparable types: amounts as doubles (they are exact until here), times as text."""
    out = []
    for name, kind in df.dtypes:
        if name in drop:
            continue
        if kind.startswith("decimal"):
            out.append(F.col(name).cast("double").alias(name))
        elif kind.startswith("timestamp"):
            out.append(stamp_of(name).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def map_text(c: str):
    """A map as text with its keys in order."""
    pairs = F.array_sort(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return F.array_join(pairs, ";")


# --- sources -------------------------------------------------------------------------------------


def raw_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a text message; some are cut off and some are empty."""
    e = v.events(spark, sf_dir)
    whole = F.concat(
        F.lit('{"event_id":'), "event_id", F.lit(',"type":"'), "event_type", F.lit('","k":'), "k", F.lit("}")
    )
    cut = (F.col("event_type") == "error") & (F.col("value") < 5)
    empty = (F.col("event_type") == "click") & (F.col("value") < 1)
    message = F.when(cut, F.substring(whole, 1, 12)).when(empty, "").otherwise(whole)
    return e.select(message.alias("value"))


def written(spark: SparkSession, messages: DataFrame, topic: str) -> dict:
    """Put messages on a file topic; returns how to read it."""
    root = scratch_path(spark, "topic")
    sinks.write_topic(messages, topic, root=root)
    return {"topics": topic, "root": root}


@query
def src_topic(spark, sf_dir):
    return topics.read_topic(spark, **written(spark, raw_topic(spark, sf_dir), "raw"))


@query
def src_json_table(spark, sf_dir):
    raw = topics.read_topic(spark, **written(spark, raw_topic(spark, sf_dir), "raw"))
    return raw.transform(topics.parse_json("event_id bigint, type string, k int"))


@query
def src_json_table_bad(spark, sf_dir):
    """Both outputs of a reader that diverts: the typed records, and the texts that could not be read."""
    raw = topics.read_topic(spark, **written(spark, raw_topic(spark, sf_dir), "raw"))
    good, bad = topics.diverted(raw.transform(topics.parse_json("event_id bigint, type string, k int", keep_bad=True)))
    nothing = {"event_id": F.lit(None).cast("bigint"), "type": F.lit(None).cast("string"), "k": F.lit(None).cast("int")}
    return good.withColumn("bad", F.lit(None).cast("string")).unionByName(bad.select(*[c.alias(n) for n, c in nothing.items()], F.col("value").alias("bad")))


def broken_changelog(spark, sf_dir):
    """The change log as messages: some of them cut off, in some the time is a word."""
    rows = v.changelog(spark, sf_dir)
    events = v.events(spark, sf_dir).select("event_id", "event_type", "value")
    message = rows.select("event_id", F.to_json(F.struct("database", "table", "type", "ts", "data", "old")).alias("whole")).join(events, "event_id")
    cut = (F.col("event_type") == "error") & (F.col("value") < 5)
    word = (F.col("event_type") == "view") & (F.col("value") < 5)
    worded = F.regexp_replace("whole", '"ts":[0-9]+', '"ts":"soon"')
    return message.select(F.when(cut, F.substring("whole", 1, 20)).when(word, worded).otherwise(F.col("whole")).alias("value"))


@query
def src_changelog_bad(spark, sf_dir):
    back = topics.read_changelog(spark, keep_bad=True, **written(spark, broken_changelog(spark, sf_dir), schemas.TOPIC_CHANGELOG))
    good, bad = topics.diverted(back)
    kept = good.select("table", "type", "ts", F.lit(None).cast("string").alias("bad"))
    lost = bad.select(*[F.lit(None).cast(t).alias(c) for c, t in good.select("table", "type", "ts").dtypes], F.substring("value", 1, 20).alias("bad"))
    return kept.unionByName(lost)


@query
def stream_changelog_bad(spark, sf_dir):
    """A running job reads what it can and writes the rest to the error topic: nothing is lost."""
    from streammart.plans import jobs

    source = written(spark, broken_changelog(spark, sf_dir), schemas.TOPIC_CHANGELOG)
    changes = topics.read_changelog(spark, delay=None, keep_bad=True, streaming=True, **source)
    out, errors = scratch_path(spark, "facts"), scratch_path(spark, "errors")
    job = jobs.start_routed_fact_job(
        changes, lambda: v.fact_routes(spark), out, f"{out}-checkpoint", v.DATABASE, {"availableNow": True}, errors
    )
    job.awaitTermination()
    bad = topics.read_topic(spark, jobs.error_topic(schemas.TOPIC_CHANGELOG), root=errors)
    facts_out = spark.read.text(out).select(F.col("sink_table").cast("string"), F.from_json("value", "id string").getField("id").alias("id"))
    return facts_out.withColumn("bad", F.lit(None).cast("string")).unionByName(
        bad.select(*[F.lit(None).cast("string").alias(c) for c in ("sink_table", "id")], F.substring("value", 1, 20).alias("bad"))
    )


@query
def src_changelog(spark, sf_dir):
    rows = v.changelog(spark, sf_dir).drop("et", "event_id")
    source = written(spark, sinks.to_json_rows(rows), schemas.TOPIC_CHANGELOG)
    back = topics.read_changelog(spark, **source)
    return back.select(
        "database", "table", "type", "ts", stamp_of("et").alias("et"), F.col("data")["sku_num"].alias("sku_num"), F.col("old")["sku_num"].alias("old_sku_num")
    )


def split_log(spark, changes):
    """A change log written once by table and read back."""
    root = scratch_path(spark, "split")
    topics.write_split_changelog(changes, root)
    return topics.read_split_changelog(configure(spark), root)


@query
def src_changelog_split(spark, sf_dir):
    """The log after it was split by table once: nothing is lost, and a replay adds nothing."""
    root = scratch_path(spark, "split")
    changes = topics.read_changelog(spark, **written(spark, sinks.to_json_rows(v.changelog(spark, sf_dir).drop("et", "event_id")), schemas.TOPIC_CHANGELOG))
    for batch in (0, 1, 1):
        topics.write_split_changelog(changes.filter(F.pmod("ts", F.lit(2)) == batch), root, batch)
    back = topics.read_split_changelog(configure(spark), root)
    return back.select(
        "database", "table", "type", "ts", stamp_of("et").alias("et"), F.col("data")["sku_num"].alias("sku_num"), F.col("old")["sku_num"].alias("old_sku_num")
    )


@query
def src_fact(spark, sf_dir):
    rows = facts.fact_cart_add(v.changelog(spark, sf_dir)).drop("et")
    source = written(spark, sinks.to_json_rows(rows), "dwd_trade_cart_add")
    return plain(topics.read_fact(spark, "dwd_trade_cart_add", **source))


@query
def src_page_log(spark, sf_dir):
    rows = v.pages(spark, sf_dir).select("common", "page", "ts")
    source = written(spark, sinks.to_json_rows(rows), "dwd_traffic_page")
    back = topics.read_page_log(spark, **source)
    return back.select("common.mid", "common.ch", "page.page_id", "page.during_time", "ts", stamp_of("et").alias("et"))


@query
def src_config_changes(spark, sf_dir):
    rows = v.config_changes(spark, sf_dir)
    source = written(spark, sinks.to_json_rows(rows), "routes")
    back = topics.read_config_changes(spark, **source)
    return back.select("op", "ts_ms", F.col("before.source_table").alias("before_table"), F.col("after.source_table").alias("after_table"), F.col("after.sink_columns").alias("sink_columns"))


def route_snapshot(spark, sf_dir):
    """A routing table of the time before the first half of the changes was made."""
    n = v.table(spark, sf_dir, "nation")
    return n.select(
        F.concat(F.lit("table_"), "n_nationkey").alias("source_table"),
        F.concat(F.lit("snap_"), "n_name").alias("sink_table"),
        F.lit("info").alias("sink_family"),
        F.lit("id").alias("sink_columns"),
        F.lit("id").alias("sink_row_key"),
    )


@query
def stream_config_changes(spark, sf_dir):
    """A snapshot and the changes made after it, as one stream."""
    source = written(spark, sinks.to_json_rows(v.config_changes(spark, sf_dir)), "routes")
    stream = topics.read_config_changes(
        spark, route_snapshot(spark, sf_dir), as_of=70, handover=scratch_path(spark, "handover"), streaming=True, **source
    )
    return drained_undated(spark, "stream-config", stream).select(
        "op", "ts_ms", F.col("before.source_table").alias("before_table"), F.col("after.source_table").alias("after_table"), F.col("after.sink_table").alias("sink_table")
    )


@query
def src_config_snapshot(spark, sf_dir):
    from streammart.sources.tables import read_config_snapshot

    path = scratch_path(spark, "routes")
    v.config_changes(spark, sf_dir).filter("op <> 'd'").select("after.*").write.parquet(path)
    return read_config_snapshot(spark, path).select("source_table", "sink_table", "sink_columns")


@query
def src_dim(spark, sf_dir):
    from streammart.sources.tables import read_dim

    c = v.table(spark, sf_dir, "customer")
    rows = c.select(v.text("c_custkey").alias("id"), "c_name", F.col("c_nationkey").alias("n"), F.lit(0).alias("ver"))
    root = scratch_path(spark, "dim")
    sinks.write_upsert(rows, f"{root}/dim_customer", ["id"], ["ver"], buckets=8)
    return read_dim(spark, root, "dim_customer").select("id", "c_name", "n")


@query
def src_upsert_topic(spark, sf_dir):
    """Events as a topic keyed by user, with tombstones, written in three parts: what is left of it as a stream."""
    e = v.events(spark, sf_dir).select("user_id", "event_id", "event_type", "k")
    records = upserts.keyed_records(e, ["user_id"], "event_id", F.col("k") >= 90)
    root = scratch_path(spark, "keyed")
    for third in range(3):
        upserts.write_keyed_topic(records.filter(F.col("seq") % 3 == third).coalesce(1), "users", root=root)
    source = upserts.read_keyed_topic(spark, "users", root=root, streaming=True, options={"maxFilesPerTrigger": "1"})
    rows = drained_undated(spark, "stream-upsert", upserts.normalised(source, "user_id bigint, event_type string, k int"))
    net = rows.groupBy("user_id", "event_type", "k").agg(F.sum(upserts.sign()).cast("bigint").alias("n"))
    return net.filter("n <> 0")


@query
def sink_upsert_topic(spark, sf_dir):
    """An add-and-retract log back into a keyed topic: its newest records are the log's net rows."""
    e = v.events(spark, sf_dir).select("user_id", "event_id", "event_type", "k")
    gone = F.when(F.col("k") >= 90, upserts.DELETED).otherwise(upserts.AFTER)
    again = e.withColumn("op", F.explode(F.array(gone, F.lit(upserts.BEFORE))))
    root = scratch_path(spark, "keyed-out")
    upserts.write_keyed_topic(upserts.retractions_as_records(again, ["user_id"], "event_id"), "users", root=root)
    back = upserts.normalised(upserts.read_keyed_topic(spark, "users", root=root), "user_id bigint, event_type string, k int")
    return back.select("op", "user_id", "event_type", "k")


# --- sinks ---------------------------------------------------------------------------------------


@query
def sink_append(spark, sf_dir):
    root = scratch_path(spark, "append")
    rows = sinks.to_json_rows(v.events(spark, sf_dir).select("event_id", "user_id", "event_type"))
    sinks.write_topic(rows, "facts", root=root)
    return topics.read_topic(spark, "facts", root=root)


@query
def sink_routed(spark, sf_dir):
    root = scratch_path(spark, "routed")
    routed = facts.routed_facts(v.changelog(spark, sf_dir), v.fact_routes(spark), v.DATABASE)
    rows = routed.select("sink_table", map_text("data").alias("value"))
    sinks.write_routed(rows, root=root)
    back = configure(spark).read.text(root)
    return back.select("value", F.col("sink_table").cast("string").alias("sink_table"))


@query
def sink_upsert(spark, sf_dir):
    e = v.events(spark, sf_dir).select("user_id", "event_id", "event_type", "k")
    table = sinks.UpsertTable(spark, scratch_path(spark, "upsert"), ["user_id"], buckets=8)
    early = e.filter("event_type in ('view', 'click', 'error')")
    late = e.filter("event_type in ('signup', 'purchase')")
    table.merge(early, ["event_id"], source="a", batch_id=0)
    table.merge(late, ["event_id"], deleted="k >= 90", source="a", batch_id=1)
    table.merge(early, ["event_id"], source="a", batch_id=0)  # a replay: must change nothing
    return table.read().select("user_id", "event_id", "event_type", "k")


@query
def sink_summary(spark, sf_dir):
    root = scratch_path(spark, "summary")
    rows = summaries.traffic_by_dims(v.pages(spark, sf_dir), width="1 day", tie="event_id")
    sinks.write_summary(rows, root, batch="first")
    sinks.write_summary(rows, root, batch="first")  # a replay: must change nothing
    return sinks.read_summary(spark, root)


@query
def sink_summary_two_batches(spark, sf_dir):
    """Two batches with rows of the same days: both stay."""
    root = scratch_path(spark, "summary")
    rows = summaries.traffic_by_dims(v.pages(spark, sf_dir), width="1 day", tie="event_id")
    sinks.write_summary(rows.filter("ch <= 'ch1'"), root)
    sinks.write_summary(rows.filter("ch > 'ch1'"), root)
    return sinks.read_summary(spark, root)


@query
def sink_json_rows(spark, sf_dir):
    e = v.events(spark, sf_dir)
    return sinks.to_json_rows(
        e.select(F.col("event_id").alias("eventId"), F.col("event_type").alias("eventType"), F.col("k").alias("propK"))
    )


# --- change log ----------------------------------------------------------------------------------


@query
def flt_changelog_clean(spark, sf_dir):
    rows = cl.clean_changelog(v.changelog(spark, sf_dir), v.DATABASE)
    return rows.select("table", "type", "ts", F.col("data")["id"].alias("id"))


@query
def flt_drop_bootstrap(spark, sf_dir):
    return cl.drop_bootstrap(v.changelog(spark, sf_dir)).select("event_id", "type")


@query
def flt_table_inserts(spark, sf_dir):
    rows = cl.changes_of(v.changelog(spark, sf_dir), "cart_info", "insert", ["id", "user_id", "sku_id", "sku_num"], v.DATABASE)
    return rows.drop("et")


@query
def flt_status_transition(spark, sf_dir):
    ch = v.changelog(spark, sf_dir)
    exact = cl.transition(ch, "order_status", "1003", "1001").withColumn("kind", F.lit("exact"))
    to = cl.transition(ch, "order_status", "1005").withColumn("kind", F.lit("any"))
    return exact.unionByName(to).select("kind", "event_id")


@query
def fact_cart_add(spark, sf_dir):
    return facts.fact_cart_add(v.changelog(spark, sf_dir)).drop("et")


@query
def prj_keep_columns(spark, sf_dir):
    rows = cl.keep_columns(v.changelog(spark, sf_dir), F.lit("id,sku_num,missing"))
    return rows.select("event_id", map_text("data").alias("kept"))


@query
def prj_decimal_product(spark, sf_dir):
    li = v.table(spark, sf_dir, "lineitem")
    product = cl.decimal_product(v.text(F.col("l_quantity").cast("int")), v.text(v.money("l_extendedprice")))
    return plain(
        li.select("l_orderkey", "l_linenumber", "l_partkey", product.alias("original"), product.cast("string").alias("as_text"))
    )


@query
def route_dims(spark, sf_dir):
    changes = cl.clean_changelog(v.changelog(spark, sf_dir), v.DATABASE)
    rows = cl.route_dims(changes, v.dim_routes(spark))
    return rows.select("sink_table", "type", "row_key", map_text("data").alias("cells"), "ts")


@query
def route_facts(spark, sf_dir):
    rows = facts.routed_facts(v.changelog(spark, sf_dir), v.fact_routes(spark))
    return rows.select("sink_table", map_text("data").alias("cells"))


@query
def cfg_current(spark, sf_dir):
    n = v.table(spark, sf_dir, "nation")
    snapshot = n.select(
        F.concat(F.lit("table_"), "n_nationkey").alias("source_table"),
        F.concat(F.lit("snap_"), "n_name").alias("sink_table"),
        F.lit("info").alias("sink_family"),
        F.lit("id").alias("sink_columns"),
        F.lit("id").alias("sink_row_key"),
    )
    current = cl.current_config(snapshot, v.config_changes(spark, sf_dir), ["source_table"])
    return current.select("source_table", "sink_table", "sink_columns")


@query
def dim_apply_changes(spark, sf_dir):
    c = v.table(spark, sf_dir, "customer")
    dim = c.select(v.text("c_custkey").alias("row_key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    e = v.events(spark, sf_dir)
    data = F.create_map(
        F.lit("name"), F.when(F.col("k") % 2 == 0, F.concat(F.lit("n"), "event_id")),
        F.lit("segment"), F.when(F.col("value") < 10, F.col("event_type")),
    )
    kind = F.when(F.col("k") >= 90, "delete").when(F.col("k") >= 50, "update").otherwise("insert")
    changes = e.select(v.text("user_id").alias("row_key"), kind.alias("type"), data.alias("data"), "ts", "event_id")
    return cl.apply_dim_changes(dim, changes, ["name", "segment"], ["ts", "event_id"])


@query
def dim_build(spark, sf_dir):
    """Change log and routes to dimensions, in one go."""
    built = facts.build_dims(
        v.changelog(spark, sf_dir),
        v.dim_routes(spark),
        None,
        {},
        {"dim_cart": ["id", "sku_num"], "dim_user": ["id", "user_id"]},
        v.DATABASE,
        ["ts", "event_id"],
    )
    cart = built["dim_cart"].select(F.lit("dim_cart").alias("dim"), "row_key", F.col("sku_num").alias("cell"))
    user = built["dim_user"].select(F.lit("dim_user").alias("dim"), "row_key", F.col("id").alias("cell"))
    return cart.unionByName(user)


# --- logs ----------------------------------------------------------------------------------------


@query
def flt_logins(spark, sf_dir):
    rows = logs.logins(v.pages(spark, sf_dir))
    return rows.select("event_id", "common.uid", "page.last_page_id")


@query
def flt_tombstones(spark, sf_dir):
    return logs.drop_tombstones(raw_topic(spark, sf_dir))


@query
def flt_bad_records(spark, sf_dir):
    good, bad = logs.split_bad_records(raw_topic(spark, sf_dir), "event_id bigint, type string, k int")
    return good.select("event_id", F.lit(None).cast("string").alias("bad")).unionByName(
        bad.select(F.lit(None).cast("bigint").alias("event_id"), F.col("value").alias("bad"))
    )


@query
def log_split_err(spark, sf_dir):
    rows = logs.split_log(v.app_logs(spark, sf_dir))["err"]
    return rows.select("common.mid", "ts", "err.error_code", "err.msg")


@query
def log_split_start(spark, sf_dir):
    rows = logs.split_log(v.app_logs(spark, sf_dir))["start"]
    return rows.select("common.mid", "ts", "start.entry", "start.loading_time")


@query
def log_split_page(spark, sf_dir):
    rows = logs.split_log(v.app_logs(spark, sf_dir))["page"]
    return rows.select("common.mid", "ts", "page.page_id", "page.during_time")


@query
def log_explode_displays(spark, sf_dir):
    rows = logs.split_log(v.app_logs(spark, sf_dir))["display"]
    return rows.select("common.mid", "ts", "display.item", "display.pos_id", "display.pos_seq")


@query
def log_explode_actions(spark, sf_dir):
    rows = logs.split_log(v.app_logs(spark, sf_dir))["action"]
    return rows.select("common.mid", "ts", "action.action_id", "action.item")


@query
def lat_split_words(spark, sf_dir):
    d = v.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("keyword"))
    return logs.lateral_split_words(d)


# --- joins ---------------------------------------------------------------------------------------


def order_side(spark, sf_dir):
    o = v.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", F.timestamp_seconds(F.lit(v.T0) + F.col("o_orderkey") * 10).alias("et"))


def line_side(spark, sf_dir):
    li = v.table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
        F.timestamp_seconds(F.lit(v.T0) + F.col("l_orderkey") * 10 + F.col("l_linenumber") * 6).alias("et"),
    )


@query
def join_inner(spark, sf_dir):
    rows = joins.fact_join(line_side(spark, sf_dir), order_side(spark, sf_dir), ("l_orderkey", "o_orderkey"), "inner", "30 seconds")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey")


@query
def join_left(spark, sf_dir):
    lines = line_side(spark, sf_dir)
    returned = lines.filter("l_returnflag = 'R'").select("l_orderkey", F.col("l_linenumber").alias("n"), F.col("l_suppkey").alias("coupon"), "et")
    rows = joins.fact_join(lines, returned, [("l_orderkey", "l_orderkey"), ("l_linenumber", "n")], "left", "5 seconds")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "coupon")


def user_events(spark, sf_dir, kind):
    e = v.events(spark, sf_dir).filter(F.col("event_type") == kind)
    return e.select("user_id", "event_id", "et")


def _orders_around(spark, sf_dir, before):
    paid = user_events(spark, sf_dir, "purchase").withColumnRenamed("event_id", "payment_id")
    seen = user_events(spark, sf_dir, "view").withColumnRenamed("event_id", "order_id")
    return joins.interval_join(paid, seen, "user_id", before, "5 seconds").select("user_id", "payment_id", "order_id")


@query
def join_interval(spark, sf_dir):
    return _orders_around(spark, sf_dir, "30 minutes")


@query
def join_interval_day(spark, sf_dir):
    return _orders_around(spark, sf_dir, "1 day")


@query
def join_lookup(spark, sf_dir):
    o = v.table(spark, sf_dir, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("code"))
    return joins.lookup(o, v.region_dic(spark, sf_dir), "code", "dic_code", {"name": "dic_name"})


@query
def join_multi_key(spark, sf_dir):
    lines = line_side(spark, sf_dir).select("l_orderkey", "l_partkey", "l_linenumber")
    back = line_side(spark, sf_dir).filter("l_returnflag = 'R'").select("l_orderkey", "l_partkey", F.col("l_suppkey").alias("returned_to"))
    rows = joins.fact_join(lines, back, [("l_orderkey", "l_orderkey"), ("l_partkey", "l_partkey")])
    return rows


@query
def join_enrich(spark, sf_dir):
    c = v.table(spark, sf_dir, "customer").select("c_custkey", v.text("c_nationkey").alias("nation"))
    return joins.enrich(c, v.provinces(spark, sf_dir), "nation", {"nation_name": "name"})


@query
def join_enrich_chain(spark, sf_dir):
    li = v.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", v.text("l_suppkey").alias("s"))
    dims = v.sku_dims(spark, sf_dir)
    return joins.enrich_chain(
        li,
        [
            (dims["dim_base_category3"], "s", {"s_name": "name", "n": "category2_id"}),
            (dims["dim_base_category2"], "n", {"n_name": "name", "r": "category1_id"}),
            (dims["dim_base_category1"], "r", {"r_name": "name"}),
        ],
    )


# --- facts ---------------------------------------------------------------------------------------


@query
def fact_order_detail(spark, sf_dir):
    return plain(facts.fact_order_detail(v.trade_changes(spark, sf_dir), database=v.DATABASE), "et")


@query
def fact_order_detail_split(spark, sf_dir):
    """Order lines from a log that was split by table once: each side opens its own folder."""
    changes = split_log(spark, v.trade_changes(spark, sf_dir))
    return plain(facts.fact_order_detail(changes, database=v.DATABASE), "et")


@query
def fact_order_cancel(spark, sf_dir):
    ch = v.trade_changes(spark, sf_dir)
    return plain(facts.fact_order_cancel(facts.fact_order_detail(ch), ch, database=v.DATABASE), "et")


@query
def fact_payment(spark, sf_dir):
    ch = v.trade_changes(spark, sf_dir)
    dic = v.region_dic(spark, sf_dir)
    return plain(facts.fact_payment(facts.fact_order_detail(ch), ch, dic, database=v.DATABASE), "et")


@query
def fact_refund(spark, sf_dir):
    dic = v.nation_dic(spark, sf_dir)
    return plain(facts.fact_refund(v.trade_changes(spark, sf_dir), dic, database=v.DATABASE), "et")


@query
def fact_refund_payment(spark, sf_dir):
    dic = v.region_dic(spark, sf_dir)
    return plain(facts.fact_refund_payment(v.trade_changes(spark, sf_dir), dic, database=v.DATABASE), "et")


@query
def fact_comment(spark, sf_dir):
    rows = facts.fact_comment(v.changelog(spark, sf_dir), v.nation_dic(spark, sf_dir), v.DATABASE)
    return rows.drop("et")


# --- keyed state ---------------------------------------------------------------------------------


@query
def state_fix_new_flag(spark, sf_dir):
    rows = state.fix_new_flag(v.pages(spark, sf_dir), tie="event_id")
    return rows.select("event_id", F.col("common.is_new").alias("was"), "is_new")


@query
def state_first_of_day(spark, sf_dir):
    p = v.pages(spark, sf_dir).select("event_id", "et", F.col("common.mid").alias("mid"))
    return state.first_of_day(p, ["mid"], tie="event_id").select("event_id", "is_first")


@query
def state_retract_offsets(spark, sf_dir):
    rows = v.order_versions(spark, sf_dir)
    out = state.offset_versions(rows, ["id"], list(v.VERSION_ORDER), ["split_total_amount", "split_coupon_amount"])
    return plain(out.select("id", "sku_id", "v2", "v3", "split_total_amount", "split_coupon_amount"))


@query
def state_retract_duplicates(spark, sf_dir):
    """Every version delivered twice, and once more without a time."""
    rows = v.order_versions(spark, sf_dir)
    rows = rows.union(rows).union(rows.withColumn("et", F.lit(None).cast("timestamp")))
    out = state.offset_versions(rows, ["id"], list(v.VERSION_ORDER), ["split_total_amount", "split_coupon_amount"])
    return plain(out.select("id", "sku_id", "v2", "v3", "split_total_amount", "split_coupon_amount"))


@query
def state_retract_nulls(spark, sf_dir):
    """Versions whose second order column is NULL for a part of them: a NULL ranks lowest, and nothing is lost."""
    rows = v.order_versions(spark, sf_dir).withColumn("v1", F.when(F.col("v1") % 3 != 0, F.col("v1")))
    out = state.offset_versions(rows, ["id"], list(v.VERSION_ORDER), ["split_total_amount", "split_coupon_amount"])
    return plain(out.select("id", "sku_id", "v2", "v3", "split_total_amount", "split_coupon_amount"))


@query
def state_latest_per_key(spark, sf_dir):
    rows = v.order_versions(spark, sf_dir).select("id", "sku_id", "split_total_amount", *v.VERSION_ORDER)
    return plain(state.latest_per_key(rows, ["id"], list(v.VERSION_ORDER)).drop("v1", "v2", "v3"))


@query
def state_first_seen(spark, sf_dir):
    rows = v.order_versions(spark, sf_dir).withColumn("tie", F.struct("v1", "v2", "v3"))
    out = state.first_seen(rows, "order_id", {"order": "order_id", "sku_id": "sku_id"}, tie="tie")
    return plain(out)


# --- summaries -----------------------------------------------------------------------------------


@query
def win_keyword_count(spark, sf_dir):
    return summaries.keyword_counts(v.searches(spark, sf_dir))


@query
def win_traffic_by_dims(spark, sf_dir):
    return summaries.traffic_by_dims(v.pages(spark, sf_dir), width="1 hour", tie="event_id")


@query
def win_traffic_10s(spark, sf_dir):
    return summaries.traffic_by_dims(v.pages(spark, sf_dir), tie="event_id")


@query
def win_home_detail_uv(spark, sf_dir):
    return summaries.home_detail_uv(v.pages(spark, sf_dir), width="1 hour")


@query
def win_login_back(spark, sf_dir):
    return summaries.login_users(v.pages(spark, sf_dir), width="1 day")


@query
def win_register(spark, sf_dir):
    rows = v.events(spark, sf_dir).filter("event_type = 'signup'")
    return summaries.registrations(rows.select(stamp_of("et").alias("create_time")), width="1 hour")


@query
def win_cart_uu(spark, sf_dir):
    return summaries.cart_users(facts.fact_cart_add(v.changelog(spark, sf_dir)), width="1 hour")


@query
def win_payment_users(spark, sf_dir):
    return summaries.payment_users(user_events(spark, sf_dir, "purchase"), width="1 hour")


@query
def win_order_users(spark, sf_dir):
    return summaries.order_users(v.order_versions(spark, sf_dir), width="1 hour")


@query
def win_global_sum(spark, sf_dir):
    from streammart.operators.windows import tumble_agg

    e = v.events(spark, sf_dir)
    total = F.sum(v.money("value")).alias("amount")
    return plain(tumble_agg(e, [], [F.count(F.lit(1)).alias("n"), total], width="1 hour"))


@query
def win_sku_amounts(spark, sf_dir):
    rows = summaries.sku_orders(
        v.order_versions(spark, sf_dir), v.sku_dims(spark, sf_dir), width="1 hour", order=v.VERSION_ORDER
    )
    return plain(rows)


def province_summary(spark, sf_dir):
    return summaries.province_orders(
        v.order_versions(spark, sf_dir), v.provinces(spark, sf_dir), width="1 hour", order=v.VERSION_ORDER
    )


@query
def win_province_orders(spark, sf_dir):
    return plain(province_summary(spark, sf_dir))


# --- dashboard -----------------------------------------------------------------------------------


def stored(spark, rows, label):
    root = scratch_path(spark, label)
    sinks.write_summary(rows, root)
    return sinks.read_summary(spark, root)


@query
def serve_gmv(spark, sf_dir):
    return plain(serving.gmv(stored(spark, province_summary(spark, sf_dir), "province"), 20240101))


@query
def serve_province_gmv(spark, sf_dir):
    return plain(serving.province_gmv(stored(spark, province_summary(spark, sf_dir), "province"), 20240101))


def _top_channels(spark, sf_dir):
    rows = summaries.traffic_by_dims(v.pages(spark, sf_dir), width="1 hour", tie="event_id")
    return serving.channel_uv(stored(spark, rows, "traffic"), 20240102, limit=3)


@query
def serve_channel_uv(spark, sf_dir):
    return _top_channels(spark, sf_dir)


@query
def serve_channel_series(spark, sf_dir):
    out = serving.as_series(_top_channels(spark, sf_dir), "ch", "uv_ct", "channel")
    return out.select(
        F.array_join("categories", ",").alias("categories"),
        "name",
        F.array_join(F.transform("data", lambda n: n.cast("string")), ",").alias("data"),
    )


# --- streams -------------------------------------------------------------------------------------
# The same builders over the tables read as streams that end: marker rows far in the future close all windows, and what
# comes of them is left out, so that the results are those of a batch.


def state_partitions(spark: SparkSession):
    """One machine gets one state partition per core, for as long as the block runs."""
    key = "spark.sql.shuffle.partitions"
    n = int(spark.conf.get(key))
    if spark.sparkContext.master.startswith("local"):
        n = min(n, spark.sparkContext.defaultParallelism)
    return setting(spark, key, str(n))


def drain(spark: SparkSession, stream: DataFrame, out: str, gather: bool = True) -> None:
    """Run a stream over everything there is."""
    with state_partitions(spark):
        query = sinks.write_summary(stream, out, f"{out}-checkpoint", {"availableNow": True}, gather=gather)
        query.awaitTermination()


def drained(spark: SparkSession, label: str, stream: DataFrame, gather: bool = True) -> DataFrame:
    """The rows a stream writes."""
    root = scratch_path(spark, label)
    drain(spark, stream, root, gather)
    return sinks.read_summary(spark, root)


def drained_undated(spark: SparkSession, label: str, stream: DataFrame) -> DataFrame:
    """The rows of a stream without days: there is nothing to gather them by."""
    return drained(spark, label, stream.withColumn("cur_date", F.lit("all")), gather=False)


@query
def stream_traffic_by_dims(spark, sf_dir):
    rows = summaries.traffic_by_dims(v.pages(spark, v.Closed(sf_dir)), width="1 hour")
    return v.ended(drained(spark, "stream-traffic", rows))


@query
def stream_home_detail_uv(spark, sf_dir):
    rows = summaries.home_detail_uv(v.pages(spark, v.Closed(sf_dir)), width="1 hour")
    return v.ended(drained(spark, "stream-home", rows))


@query
def stream_login_back(spark, sf_dir):
    rows = summaries.login_users(v.pages(spark, v.Closed(sf_dir)), width="1 day")
    return v.ended(drained(spark, "stream-login", rows))


@query
def stream_payment_users(spark, sf_dir):
    rows = summaries.payment_users(user_events(spark, v.Closed(sf_dir), "purchase"), width="1 hour")
    return v.ended(drained(spark, "stream-payment", rows))


@query
def stream_keyword_count(spark, sf_dir):
    return v.ended(drained(spark, "stream-keyword", summaries.keyword_counts(v.searches(spark, v.Closed(sf_dir)))))


@query
def stream_province_orders(spark, sf_dir):
    totals = summaries.province_totals(
        v.order_versions(spark, v.Closed(sf_dir)), width="1 hour", order=v.VERSION_ORDER
    )
    names = v.provinces(spark, sf_dir)
    return plain(summaries.province_names(v.ended(drained(spark, "stream-province", totals)), names))


@query
def stream_latest_per_key(spark, sf_dir):
    """The versions of a line are at most eight seconds apart, so ten seconds hold them all."""
    from streammart.streaming import keyed

    rows = v.order_versions(spark, v.Closed(sf_dir)).select("id", "sku_id", "split_total_amount", *v.VERSION_ORDER)
    latest = keyed.stream_latest_per_key(rows, ["id"], list(v.VERSION_ORDER), "10 seconds", et="et")
    kept = v.ended(drained_undated(spark, "stream-latest", latest), "et")
    return plain(kept.select("id", "sku_id", "split_total_amount", "et"))


@query
def stream_late_drop(spark, sf_dir):
    """Errors of the first ten days arrive after day twenty: too late to be counted."""
    from streammart.operators.windows import tumble_agg

    e = v.events(spark, sf_dir).select("event_id", "event_type", "et")
    day = F.dayofmonth("et")
    late = (F.col("event_type") == "error") & (day <= 10)
    root = scratch_path(spark, "late")
    out = scratch_path(spark, "late-out")
    last = v.table(spark, sf_dir, "events").limit(1).select("event_id", "event_type", F.lit("2040-01-01 00:00:00").cast("timestamp").alias("et"))
    for part in (e.filter(~late & (day <= 20)), e.filter(late | (day > 20)), last):
        part.write.mode("append").parquet(root)
        arrivals = spark.readStream.schema(e.schema).parquet(root)
        counted = tumble_agg(arrivals, [], [F.count(F.lit(1)).alias("n")], width="1 hour")
        drain(spark, counted, out)
    return v.ended(sinks.read_summary(spark, out))


@query
def stream_fix_new_flag(spark, sf_dir):
    fixed = state.fix_new_flag(v.pages(spark, v.Live(sf_dir)))
    rows = fixed.select("event_id", F.col("common.is_new").alias("was"), "is_new")
    return drained_undated(spark, "stream-flag", rows).drop("cur_date")


@query
def stream_retract_offsets(spark, sf_dir):
    measures = ["split_total_amount", "split_coupon_amount"]
    versions = v.order_versions(spark, v.Live(sf_dir)).select("id", "sku_id", *v.VERSION_ORDER, *measures)
    out = state.offset_versions(versions, ["id"], list(v.VERSION_ORDER), measures)
    rows = out.select("id", "sku_id", "v2", "v3", "split_total_amount", "split_coupon_amount")
    return plain(drained_undated(spark, "stream-offset", rows), "cur_date")


@query
def stream_refund(spark, sf_dir):
    changes = v.trade_changes(spark, v.Live(sf_dir)).withWatermark("et", "3 seconds")
    rows = facts.fact_refund(changes, v.nation_dic(spark, sf_dir), "5 seconds", v.DATABASE)
    return plain(drained_undated(spark, "stream-refund", rows), "et", "cur_date")


@query
def stream_order_detail(spark, sf_dir):
    """Order lines written early and corrected: what is left after all corrections."""
    from streammart.streaming import keyed

    changes = v.trade_changes(spark, v.Live(sf_dir)).withWatermark("et", "3 seconds")
    rows = drained_undated(spark, "stream-detail", facts.early_order_detail(changes, "60 seconds", v.DATABASE))
    rows = plain(rows, "et", "cur_date", "ver")
    return keyed.netted(rows, ["id"], "sign", "n")


@query
def stream_chain_province(spark, sf_dir):
    """Raw change messages -> early order lines -> append-only fact log -> orders per province: each job reads the last one's topic."""
    raw = written(spark, sinks.to_json_rows(v.trade_changes(spark, sf_dir).drop("et")), schemas.TOPIC_CHANGELOG)
    changes = topics.read_changelog(spark, streaming=True, **raw)
    log, name = scratch_path(spark, "chain"), "dwd_trade_order_detail"
    lines = sinks.to_json_rows(facts.order_detail_log(facts.early_order_detail(changes, "60 seconds", v.DATABASE)))
    with state_partitions(spark):
        sinks.write_topic(lines, name, root=log, checkpoint=f"{log}-checkpoint", trigger={"availableNow": True}).awaitTermination()
    marker = spark.createDataFrame([("end", "end", "0", 2200000000, 1)], "id string, order_id string, province_id string, ts bigint, ver bigint")
    sinks.write_topic(sinks.to_json_rows(marker), f"{name}_end", root=log)
    facts_in = topics.read_fact(spark, name, delay="0 seconds", topics=[name, f"{name}_end"], root=log, streaming=True)
    totals = summaries.province_totals(facts_in, width="1 hour", order=("et", "ver"))
    return plain(summaries.province_names(v.ended(drained(spark, "chain-province", totals)), v.provinces(spark, sf_dir)))


# --- scalars -------------------------------------------------------------------------------------


@query
def scalar_functions(spark, sf_dir):
    e = v.events(spark, sf_dir)
    stamp = stamp_of("et")
    return plain(
        e.select(
            "event_id",
            F.from_json("props", "k int")["k"].alias("parsed"),
            as_int("event_type").alias("not_a_number"),
            as_int(v.text("k")).alias("number"),
            as_decimal(v.text(v.money("value"))).alias("amount"),
            F.when(F.col("k") > 50, "big").otherwise("small").alias("size"),
            day_of("et").alias("day"),
            stamp.alias("stamp"),
            partition_day("et").alias("par"),
            epoch_ms(stamp).alias("stamp_ms"),
            day_start_ms(day_of("et")).alias("day_ms"),
            F.unix_seconds(F.timestamp_seconds(F.floor(F.col("ts") / 1000))).alias("secs"),
            is_blank(F.nullif("event_type", F.lit("view"))).cast("int").alias("blank"),
            colon_key("event_type", v.text("k")).alias("key"),
        )
    )
