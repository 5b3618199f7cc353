"""Test tables re-shaped as logs, change logs and fact rows.

``SQL`` holds the same views in DuckDB's dialect, as common table expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streammart.functions import event_time, stamp_of
from streammart.session import configure, scratch_path

DATABASE = "shop"
T0 = 1704067200  # 2024-01-01 00:00:00 UTC, the first second of the order views


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if not isinstance(sf_dir, Live):
        return configure(spark).read.parquet(path)
    # As a pattern the path may be one file or a folder of files.
    rows = configure(spark).read.parquet(path)
    stream = spark.readStream.schema(rows.schema).options(**sf_dir.options).parquet(f"{path[:-1]}[{path[-1]}]")
    if not isinstance(sf_dir, Closed) or name not in CLOSING:
        return stream
    folder = scratch_path(spark, f"closing-{name}")
    CLOSING[name](rows).write.parquet(folder)
    return stream.unionByName(spark.readStream.schema(rows.schema).parquet(folder))


class Live(str):
    """A table folder to be read as streams: every view then becomes one."""

    options: dict[str, str] = {}


class Closed(Live):
    """Streams that end: each table is followed by marker rows decades later, which pass the filters of all views.

    They move the watermark beyond every window. What comes of them is dated at ``END`` or later; see ``ended``.
    """


END = "2039-01-01"
LAST_KEY = 10**8  # an order this many times ten seconds, or a document as many seconds, after the first


def _last_events(e: DataFrame) -> DataFrame:
    """One event of each type."""
    far = F.lit("2040-01-01 00:00:00").cast(e.schema["ts"].dataType)
    kinds = e.groupBy("event_type").agg(F.max("props").alias("props"))
    return kinds.select(
        F.lit(-1).cast("bigint").alias("event_id"), far.alias("ts"), F.lit(-1).cast("bigint").alias("user_id"), "event_type", F.lit(15.0).alias("value"), F.lit('{"k": 1}').alias("props")
    ).select(e.columns)


def _last_orders(o: DataFrame) -> DataFrame:
    """One order of each status."""
    one = o.groupBy("o_orderstatus").agg(F.max(F.struct(*[c for c in o.columns if c != "o_orderstatus"])).alias("o"))
    return one.select("o_orderstatus", "o.*").withColumn("o_orderkey", F.lit(LAST_KEY).cast("bigint")).select(o.columns)


def _last_lines(li: DataFrame) -> DataFrame:
    """A line with every kind of change."""
    one = li.limit(1).withColumns({"l_orderkey": F.lit(LAST_KEY).cast("bigint"), "l_returnflag": F.lit("R"), "l_linestatus": F.lit("F")})
    return one.withColumn("l_discount", F.explode(F.array(F.lit(0.0), F.lit(0.1)))).select(li.columns)


def _last_documents(d: DataFrame) -> DataFrame:
    return d.limit(1).withColumns({"doc_id": F.lit(12 * LAST_KEY).cast("bigint"), "text": F.lit("end")}).select(d.columns)


CLOSING = {"events": _last_events, "orders": _last_orders, "lineitem": _last_lines, "documents": _last_documents}


def ended(rows: DataFrame, day: str = "cur_date") -> DataFrame:
    """Without what came of the marker rows."""
    return rows.filter(F.col(day) < END)


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with its time as ``ts`` (epoch ms) and ``et``, and the number in ``props`` as ``k``."""
    df = table(spark, sf_dir, "events").withColumn(
        "ts", F.unix_millis(F.col("ts").cast("timestamp"))
    )
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return df.withColumns({"et": event_time("ts"), "k": k})


def by_type(**values) -> Column:
    """A value per event type."""
    out = F.when(F.lit(False), F.lit(None))
    for kind, value in values.items():
        out = out.when(F.col("event_type") == kind, value if isinstance(value, Column) else F.lit(value))
    return out


def common() -> Column:
    return F.struct(
        F.concat(F.lit("ar"), text(F.col("user_id") % 7)).alias("ar"),
        F.lit("brand").alias("ba"),
        F.concat(F.lit("ch"), text(F.col("user_id") % 5)).alias("ch"),
        F.when(F.col("value") < 20, "1").otherwise("0").alias("is_new"),
        F.lit("model").alias("md"),
        text("user_id").alias("mid"),
        F.lit("os").alias("os"),
        text("event_id").alias("sid"),
        F.when(F.col("event_type") == "error", "").otherwise(text("user_id")).alias("uid"),
        F.concat(F.lit("v"), text(F.col("k") % 3)).alias("vc"),
    )


def page() -> Column:
    opener = F.when(F.col("value") >= 10, F.lit("login"))
    return F.struct(
        F.round(F.col("value") * 100).cast("bigint").alias("during_time"),
        by_type(
            view="home", click="good_detail", purchase="payment", signup="register", error="mine"
        ).alias("page_id"),
        by_type(view="mine", click="home", purchase="search", error="good_list", signup=opener).alias(
            "last_page_id"
        ),
        F.lit(None).cast("string").alias("refer_id"),
        text("k").alias("item"),
        F.lit("sku_id").alias("item_type"),
        F.lit(None).cast("bigint").alias("from_pos_id"),
        F.lit(None).cast("bigint").alias("from_pos_seq"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a page view."""
    return events(spark, sf_dir).select(
        "event_id", "ts", "et", common().alias("common"), page().alias("page")
    )


def app_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an app-log record: sign-ups start the app, errors and dear sign-ups carry err."""
    kind = F.col("event_type")
    item = F.struct(
        text("k").alias("item"),
        F.lit("sku_id").alias("item_type"),
        F.col("k").cast("bigint").alias("pos_id"),
    )
    steps = F.sequence(F.lit(1), F.lit(1) + F.col("k") % 3)
    displays = F.transform(
        steps, lambda i: F.struct(item["item"].alias("item"), item["item_type"].alias("item_type"), item["pos_id"].alias("pos_id"), i.cast("bigint").alias("pos_seq"))
    )
    actions = F.transform(
        steps,
        lambda i: F.struct(
            F.concat(F.lit("act"), text(i)).alias("action_id"),
            text("k").alias("item"),
            F.lit("sku_id").alias("item_type"),
            (F.col("ts") + i).alias("ts"),
        ),
    )
    start = F.struct(
        F.lit("icon").alias("entry"),
        F.col("k").cast("bigint").alias("loading_time"),
        F.lit(0).cast("bigint").alias("open_ad_id"),
        F.lit(0).cast("bigint").alias("open_ad_ms"),
        F.lit(0).cast("bigint").alias("open_ad_skip_ms"),
    )
    err = F.struct(F.col("k").cast("bigint").alias("error_code"), F.col("props").alias("msg"))
    failed = (kind == "error") | ((kind == "signup") & (F.col("value") >= 50))
    return events(spark, sf_dir).select(
        "event_id",
        common().alias("common"),
        F.when(kind == "signup", start).alias("start"),
        F.when(kind != "signup", page()).alias("page"),
        F.when(failed, err).alias("err"),
        F.when(kind.isin("view", "click", "signup"), displays).alias("displays"),
        F.when(kind == "purchase", actions).alias("actions"),
        "ts",
        "et",
    )


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a change of one of five business tables."""
    k = F.col("k")
    change = (
        F.when(k < 40, "insert")
        .when(k < 80, "update")
        .when(k < 90, "delete")
        .when(k < 98, "bootstrap-insert")
        .otherwise("")
    )
    data = F.create_map(
        *[
            part
            for name, value in {
                "id": text("event_id"),
                "user_id": text("user_id"),
                "sku_id": text("k"),
                "sku_num": text(F.floor("value")),
                "appraise": text(F.col("user_id") % 25),
                "comment_txt": F.col("props"),
                "order_status": F.when(F.col("value") < 60, "1003").otherwise("1005"),
            }.items()
            for part in (F.lit(name), value)
        ]
    )
    old = F.create_map(
        F.lit("sku_num"),
        text("k"),
        F.lit("order_status"),
        F.when(F.col("value") < 30, "1001"),
    )
    empty = F.map_filter(data, lambda key, _: F.lit(False))
    return events(spark, sf_dir).select(
        F.when(F.col("value") < 100, DATABASE).otherwise("archive").alias("database"),
        by_type(
            view="order_info",
            click="cart_info",
            purchase="payment_info",
            signup="user_info",
            error="comment_info",
        ).alias("table"),
        change.alias("type"),
        F.floor(F.col("ts") / 1000).alias("ts"),
        F.when(F.col("value") < 1, empty).otherwise(data).alias("data"),
        F.when(change == "update", old).alias("old"),
        F.timestamp_seconds(F.floor(F.col("ts") / 1000)).alias("et"),
        "event_id",
    )


def _change(df: DataFrame, name: str, kind: str, ts: Column, data: dict, old: dict | None = None) -> DataFrame:
    def as_map(values: dict) -> Column:
        return F.create_map(*[p for n, v in values.items() for p in (F.lit(n), text(v))])

    return df.select(
        F.lit(DATABASE).alias("database"),
        F.lit(name).alias("table"),
        F.lit(kind).alias("type"),
        ts.cast("bigint").alias("ts"),
        as_map(data).alias("data"),
        (as_map(old) if old else F.lit(None).cast("map<string,string>")).alias("old"),
    )


def money(c: str) -> Column:
    return F.col(c).cast("decimal(16,2)")


def line_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def trade_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and order lines as the inserts and updates of eight business tables."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    placed = F.lit(T0) + F.col("o_orderkey") * 10
    base = F.lit(T0) + F.col("l_orderkey") * 10
    seq = F.col("l_linenumber")
    lined = base + seq * 6
    order = {
        "id": F.col("o_orderkey"),
        "user_id": F.col("o_custkey"),
        "province_id": F.col("o_custkey") % 25,
    }
    status, was = F.col("o_orderstatus"), {"order_status": F.lit("1001")}
    cancelled = placed + F.col("o_custkey") % 1200
    paid = placed + F.col("o_custkey") % 2400
    returned = F.col("l_returnflag") == "R"
    refund = {"order_id": F.col("l_orderkey"), "sku_id": F.col("l_partkey"), "refund_num": F.col("l_quantity").cast("int")}
    parts = [
        _change(o, "order_info", "insert", placed, {**order, "order_status": F.lit("1001")}),
        _change(
            li,
            "order_detail",
            "insert",
            lined,
            {
                "id": line_id(),
                "order_id": F.col("l_orderkey"),
                "sku_id": F.col("l_partkey"),
                "sku_name": F.concat(F.lit("sku-"), text("l_partkey")),
                "create_time": stamp_of(F.timestamp_seconds(lined)),
                "sku_num": F.col("l_quantity").cast("int"),
                "order_price": money("l_extendedprice"),
                "split_total_amount": money("l_extendedprice"),
                "split_activity_amount": money("l_discount"),
                "split_coupon_amount": money("l_tax"),
            },
        ),
        _change(
            li.filter("l_discount > 0.05"),
            "order_detail_activity",
            "insert",
            lined + seq,
            {"order_detail_id": line_id(), "activity_id": F.col("l_suppkey"), "activity_rule_id": seq},
        ),
        _change(
            li.filter(returned),
            "order_detail_coupon",
            "insert",
            lined + 20,
            {"order_detail_id": line_id(), "coupon_id": F.col("l_suppkey")},
        ),
        _change(
            o.filter(status == "F"),
            "order_info",
            "update",
            cancelled,
            {**order, "order_status": F.lit("1003"), "operate_time": stamp_of(F.timestamp_seconds(cancelled))},
            was,
        ),
        _change(
            o.filter(status == "O"),
            "payment_info",
            "update",
            paid,
            {
                "order_id": F.col("o_orderkey"),
                "user_id": F.col("o_custkey"),
                "payment_type": F.substring("o_orderpriority", 1, 1),
                "callback_time": stamp_of(F.timestamp_seconds(paid)),
                "payment_status": F.lit("1602"),
            },
            {"payment_status": F.lit("1601")},
        ),
        _change(
            li.filter(returned),
            "order_refund_info",
            "insert",
            base + seq * 3,
            {
                **refund,
                "id": line_id(),
                "user_id": F.col("l_suppkey"),
                "create_time": stamp_of(F.timestamp_seconds(base + seq * 3)),
                "refund_type": seq * 6,
                "refund_reason_type": F.col("l_suppkey") % 25,
                "refund_reason_txt": F.col("l_linestatus"),
                "refund_amount": money("l_extendedprice"),
            },
        ),
        _change(
            o.filter(status == "P"),
            "order_info",
            "update",
            placed + 10,
            {**order, "order_status": F.lit("1005")},
            was,
        ),
        _change(
            li.filter(returned & (F.col("l_linestatus") == "F")),
            "refund_payment",
            "update",
            base + seq,
            {
                "id": line_id(),
                "order_id": F.col("l_orderkey"),
                "sku_id": F.col("l_partkey"),
                "payment_type": seq,
                "callback_time": stamp_of(F.timestamp_seconds(base + seq)),
                "total_amount": money("l_extendedprice"),
                "refund_status": F.lit("1602"),
            },
            {"refund_status": F.lit("1601")},
        ),
        _change(
            li.filter(returned),
            "order_refund_info",
            "update",
            base + 3,
            {**refund, "refund_status": F.lit("0705")},
            {"refund_status": F.lit("0701")},
        ),
        _change(
            o.filter(status == "F"),
            "order_info",
            "update",
            placed + 5,
            {**order, "order_status": F.lit("1006")},
            {"order_status": F.lit("1005")},
        ),
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("et", F.timestamp_seconds("ts"))


def nation_dic(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(text("n_nationkey").alias("dic_code"), F.col("n_name").alias("dic_name"))


def region_dic(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select(text("r_regionkey").alias("dic_code"), F.col("r_name").alias("dic_name"))


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines where the same (order, line number) occurs in several versions.

    A version is placed by ``et`` and then by the ``v1``-``v3`` columns, which tell all rows apart.
    """
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        text("l_orderkey").alias("order_id"),
        text(F.col("l_orderkey") % 50).alias("user_id"),
        text("l_partkey").alias("sku_id"),
        F.concat(F.lit("sku-"), text("l_partkey")).alias("sku_name"),
        text(F.col("l_orderkey") % 25).alias("province_id"),
        money("l_extendedprice").alias("split_original_amount"),
        money("l_discount").alias("split_activity_amount"),
        money("l_tax").alias("split_coupon_amount"),
        money("l_extendedprice").alias("split_total_amount"),
        F.timestamp_seconds(F.lit(T0) + F.col("l_orderkey") * 10 + F.col("l_partkey") % 9).alias("et"),
        F.col("l_partkey").alias("v1"),
        F.col("l_suppkey").alias("v2"),
        F.col("l_extendedprice").alias("v3"),
    )


VERSION_ORDER = ("et", "v1", "v2", "v3")


def sku_dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    part = table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return {
        "dim_sku_info": part.select(
            text("p_partkey").alias("id"),
            text("p_size").alias("spu_id"),
            F.col("p_brand").alias("tm_id"),
            text(F.col("p_size") % 10).alias("category3_id"),
        ),
        "dim_spu_info": part.select(
            text("p_size").alias("id"), F.concat(F.lit("spu-"), text("p_size")).alias("spu_name")
        ).distinct(),
        "dim_base_trademark": part.select(
            F.col("p_brand").alias("id"), F.upper("p_brand").alias("tm_name")
        ).distinct(),
        "dim_base_category3": supplier.select(
            text("s_suppkey").alias("id"),
            F.col("s_name").alias("name"),
            text("s_nationkey").alias("category2_id"),
        ),
        "dim_base_category2": nation.select(
            text("n_nationkey").alias("id"),
            F.col("n_name").alias("name"),
            text("n_regionkey").alias("category1_id"),
        ),
        "dim_base_category1": region.select(
            text("r_regionkey").alias("id"), F.col("r_name").alias("name")
        ),
    }


def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(text("n_nationkey").alias("id"), F.col("n_name").alias("name"))


def searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a keyword search, one per second."""
    d = table(spark, sf_dir, "documents")
    page = F.struct(
        F.lit("good_list").alias("page_id"),
        F.lit("search").alias("last_page_id"),
        F.col("text").alias("item"),
        F.lit("keyword").alias("item_type"),
    )
    return d.select(page.alias("page"), F.timestamp_seconds(F.lit(T0) + F.col("doc_id")).alias("et"), "doc_id")


def config_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as one change of a routing table with a row per nation."""
    c = table(spark, sf_dir, "customer")

    def route(nation: Column) -> Column:
        return F.struct(
            F.concat(F.lit("table_"), text(nation)).alias("source_table"),
            F.concat(F.lit("dim_"), text("c_custkey")).alias("sink_table"),
            F.lit("info").alias("sink_family"),
            F.concat(F.lit("id,"), F.lower("c_mktsegment")).alias("sink_columns"),
            F.lit("id").alias("sink_row_key"),
        )

    here = F.col("c_nationkey")
    op = (
        F.when(F.col("c_mktsegment") == "BUILDING", "r")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "u")
        .when(F.col("c_mktsegment") == "MACHINERY", "d")
        .otherwise("c")
    )
    return c.select(
        op.alias("op"),
        F.col("c_custkey").alias("ts_ms"),
        F.when(op.isin("u", "d"), route(F.when(op == "u", (here + 1) % 25).otherwise(here))).alias("before"),
        F.when(op != "d", route(here)).alias("after"),
    )


def dim_routes(spark: SparkSession) -> DataFrame:
    rows = [
        ("cart_info", "dim_cart", "info", "id,sku_id,sku_num", "id"),
        ("user_info", "dim_user", "info", "id,user_id", "user_id"),
    ]
    ddl = "source_table string, sink_table string, sink_family string, sink_columns string, sink_row_key string"
    return spark.createDataFrame(rows, ddl)


def fact_routes(spark: SparkSession) -> DataFrame:
    rows = [
        ("user_info", "insert", "dwd_user_register", "id,user_id"),
        ("cart_info", "update", "dwd_interaction_favor_add", "id,sku_id"),
    ]
    return spark.createDataFrame(
        rows, "source_table string, source_type string, sink_table string, sink_columns string"
    )


# --- the same views for DuckDB -------------------------------------------------------------------

_EV = """
ev as (
  select event_id, user_id, event_type, value, props, epoch_us(ts) // 1000 as ts,
         epoch_ms(epoch_us(ts) // 1000) as et, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k
  from events
)"""

_PAGES = """
pages as (
  select event_id, ts, et, event_type, k, props, value,
    'ar' || (user_id % 7) as ar, 'ch' || (user_id % 5) as ch, 'v' || (k % 3) as vc,
    case when value < 20 then '1' else '0' end as is_new,
    cast(user_id as varchar) as mid,
    case when event_type = 'error' then '' else cast(user_id as varchar) end as uid,
    cast(round(value * 100) as bigint) as during_time,
    case event_type when 'view' then 'home' when 'click' then 'good_detail'
      when 'purchase' then 'payment' when 'signup' then 'register' else 'mine' end as page_id,
    case event_type when 'view' then 'mine' when 'click' then 'home' when 'purchase' then 'search'
      when 'error' then 'good_list' else case when value >= 10 then 'login' end end as last_page_id
  from ev
)"""

_CHANGES = """
ch as (
  select event_id, k, value, event_type,
    case when value < 100 then 'shop' else 'archive' end as db,
    case event_type when 'view' then 'order_info' when 'click' then 'cart_info'
      when 'purchase' then 'payment_info' when 'signup' then 'user_info' else 'comment_info' end as tab,
    case when k < 40 then 'insert' when k < 80 then 'update' when k < 90 then 'delete'
      when k < 98 then 'bootstrap-insert' else '' end as type,
    ts // 1000 as ts, value >= 1 as has_data,
    case when value >= 1 then cast(event_id as varchar) end as id,
    case when value >= 1 then cast(user_id as varchar) end as user_id,
    case when value >= 1 then cast(k as varchar) end as sku_id,
    case when value >= 1 then cast(cast(floor(value) as bigint) as varchar) end as sku_num,
    case when value >= 1 then cast(user_id % 25 as varchar) end as appraise,
    case when value >= 1 then props end as comment_txt,
    case when value >= 1 then case when value < 60 then '1003' else '1005' end end as order_status,
    case when k >= 40 and k < 80 then cast(k as varchar) end as old_sku_num,
    case when k >= 40 and k < 80 and value < 30 then '1001' end as old_order_status
  from ev
)"""

_LINES = f"""
li as (
  select *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as line_id,
    {T0} + l_orderkey * 10 as base
  from lineitem
)"""

_DETAIL = f"""
od as (
  select line_id as id, cast(l_orderkey as varchar) as order_id, cast(o_custkey as varchar) as user_id,
    cast(l_partkey as varchar) as sku_id, 'sku-' || l_partkey as sku_name,
    cast(o_custkey % 25 as varchar) as province_id,
    cast(act.activity_id as varchar) as activity_id, cast(act.rule as varchar) as activity_rule_id,
    cast(cou.coupon_id as varchar) as coupon_id,
    strftime(epoch_ms((base + l_linenumber * 6) * 1000), '%Y-%m-%d') as date_id,
    strftime(epoch_ms((base + l_linenumber * 6) * 1000), '%Y-%m-%d %H:%M:%S') as create_time,
    cast(cast(l_quantity as int) as varchar) as sku_num,
    cast(cast(cast(l_quantity as int) as decimal(16,2)) * cast(l_extendedprice as decimal(16,2)) as double) as split_original_amount,
    cast(cast(l_discount as decimal(16,2)) as double) as split_activity_amount,
    cast(cast(l_tax as decimal(16,2)) as double) as split_coupon_amount,
    cast(cast(l_extendedprice as decimal(16,2)) as double) as split_total_amount,
    base + l_linenumber * 6 as ts
  from li join orders on l_orderkey = o_orderkey
  left join (select line_id as aid, l_suppkey as activity_id, l_linenumber as rule from li where l_discount > 0.05) act
    on line_id = aid
  left join (select line_id as cid, l_suppkey as coupon_id from li where l_returnflag = 'R') cou
    on line_id = cid
)"""

_VERSIONS = f"""
ov as (
  select concat_ws('-', l_orderkey, l_linenumber) as id, cast(l_orderkey as varchar) as order_id,
    cast(l_orderkey % 50 as varchar) as user_id, cast(l_partkey as varchar) as sku_id,
    'sku-' || l_partkey as sku_name, cast(l_orderkey % 25 as varchar) as province_id,
    cast(l_extendedprice as decimal(16,2)) as price, cast(l_discount as decimal(16,2)) as activity,
    cast(l_tax as decimal(16,2)) as coupon,
    epoch_ms(({T0} + l_orderkey * 10 + l_partkey % 9) * 1000) as et,
    l_partkey as v1, l_suppkey as v2, l_extendedprice as v3
  from lineitem
),
ranked as (
  select *, row_number() over (partition by id order by et desc, v1 desc, v2 desc, v3 desc) as back,
    row_number() over (partition by order_id order by et, v1, v2, v3) as order_row
  from ov
)"""

SQL = {
    "ev": _EV,
    "pages": _EV + "," + _PAGES,
    "changes": _EV + "," + _CHANGES,
    "lines": _LINES,
    "detail": _LINES + "," + _DETAIL,
    "versions": _VERSIONS,
}
