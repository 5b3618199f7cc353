"""DuckDB SQL with the answer of each query in ``queries``."""

from __future__ import annotations

from streammart.checks.views import SQL, T0

DAY = "'%Y-%m-%d'"
STAMP = "'%Y-%m-%d %H:%M:%S'"
HOUR = 3600
ORACLE: dict[str, str] = {}


def day(t: str) -> str:
    return f"strftime({t}, {DAY})"


def stamp(t: str) -> str:
    return f"strftime({t}, {STAMP})"


def windowed(source: str, seconds: int, keys: str, aggs: str) -> str:
    """Tumbling aggregation of a table with ``et``."""
    w = seconds * 1000
    comma = f"{keys}, " if keys else ""
    group = f", {keys}" if keys else ""
    return f"""
    select {stamp('epoch_ms(b)')} as stt, {stamp(f'epoch_ms(b + {w})')} as edt,
      {day('epoch_ms(b)')} as cur_date, {comma}{aggs}
    from (select *, (epoch_ms(et) // {w}) * {w} as b from {source}) group by b{group}"""


def sums(*names: str) -> str:
    return ", ".join(f"cast(sum({n}) as bigint) as {n}" for n in names)


def first_days(source: str, keys: str, where: str = "true") -> str:
    """First time per key and day, with the day before it on which the key occurred."""
    return f"""
    fd as (select {keys}, {day('et')} as d, min(et) as et from {source} where {where} group by {keys}, {day('et')}),
    fl as (select *, lag(d) over (partition by {keys} order by d) as prev from fd)"""


def add(name: str, sql: str, view: str | None = None) -> None:
    """Register SQL; ``view`` puts the named tables of ``views.SQL`` in front of it."""
    ORACLE[name] = f"with {SQL[view]}\n{sql}" if view else sql


RAW = """, raw as (
  select case when event_type = 'error' and value < 5 then substr(whole, 1, 12)
              when event_type = 'click' and value < 1 then '' else whole end as value,
    event_type = 'error' and value < 5 as cut, event_type = 'click' and value < 1 as empty,
    event_id, event_type, k
  from (select *, '{"event_id":' || event_id || ',"type":"' || event_type || '","k":' || k || '}' as whole from ev)
)"""

add("src_topic", RAW + " select value from raw", "ev")
add("src_json_table", RAW + " select event_id, event_type as type, k from raw where not cut and not empty", "ev")
add("src_json_table_bad", RAW + """ select case when not cut and not empty then event_id end as event_id,
      case when not cut and not empty then event_type end as type, case when not cut and not empty then k end as k,
      case when cut or empty then value end as bad from raw""", "ev")
BROKEN = ", broken as (select *, event_type in ('error', 'view') and value < 5 as bad, substr('{\"database\":\"' || db || '\",\"table\":', 1, 20) as head from ch)"
add(
    "src_changelog_bad",
    BROKEN + """ select case when not bad then tab end as "table", case when not bad then type end as type, case when not bad then ts end as ts,
      case when bad then head end as bad from broken""",
    "changes",
)
add(
    "stream_changelog_bad",
    BROKEN + """ select case when tab = 'user_info' then 'dwd_user_register' else 'dwd_interaction_favor_add' end as sink_table, id, null as bad
      from broken where not bad and db = 'shop' and ((tab = 'user_info' and type = 'insert') or (tab = 'cart_info' and type = 'update'))
    union all select null, null, head from broken where bad""",
    "changes",
)
add(
    "src_changelog",
    f"""select db as "database", tab as "table", type, ts, {stamp('epoch_ms(ts * 1000)')} as et,
      sku_num, old_sku_num from ch""",
    "changes",
)
CART = """
    select id, user_id, sku_id,
      cast(case when old_sku_num is null then cast(sku_num as int) else cast(sku_num as int) - cast(old_sku_num as int) end as bigint) as sku_num,
      ts
    from ch where tab = 'cart_info' and (type = 'insert'
      or (type = 'update' and cast(sku_num as int) > cast(old_sku_num as int)))"""
add("src_fact", f"select *, {stamp('epoch_ms(ts * 1000)')} as et from ({CART})", "changes")
add("src_page_log", f"select mid, ch, page_id, during_time, ts, {stamp('et')} as et from pages", "pages")
ROUTES = """
    select c_custkey as ts_ms, 'table_' || c_nationkey as here, 'table_' || ((c_nationkey + 1) % 25) as other,
      'dim_' || c_custkey as sink_table, 'id,' || lower(c_mktsegment) as sink_columns,
      case c_mktsegment when 'BUILDING' then 'r' when 'HOUSEHOLD' then 'u' when 'MACHINERY' then 'd' else 'c' end as op
    from customer"""
add(
    "src_config_changes",
    f"""select op, ts_ms, case op when 'u' then other when 'd' then here end as before_table,
      case when op <> 'd' then here end as after_table,
      case when op <> 'd' then sink_columns end as sink_columns from ({ROUTES})""",
)
add("src_config_snapshot", f"select here as source_table, sink_table, sink_columns from ({ROUTES}) where op <> 'd'")
add("src_dim", "select cast(c_custkey as varchar) as id, c_name, c_nationkey as n from customer")

ORACLE["stream_config_changes"] = f"""select op, ts_ms, case op when 'u' then other when 'd' then here end as before_table,
      case when op <> 'd' then here end as after_table, case when op <> 'd' then sink_table end as sink_table from ({ROUTES}) where ts_ms > 70
    union all select 'r', 70, null, 'table_' || n_nationkey, 'snap_' || n_name from nation"""
add(
    "sink_append",
    """select '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' as value from ev""",
    "ev",
)
FACT_ROUTES = """
    select case when tab = 'user_info' then 'dwd_user_register' else 'dwd_interaction_favor_add' end as sink_table,
      case when not has_data then 'ts=' || ts
        when tab = 'user_info' then 'id=' || id || ';ts=' || ts || ';user_id=' || user_id
        else 'id=' || id || ';sku_id=' || sku_id || ';ts=' || ts end as cells, db
    from ch where (tab = 'user_info' and type = 'insert') or (tab = 'cart_info' and type = 'update')"""
add("sink_routed", f"select sink_table, cells as value from ({FACT_ROUTES}) where db = 'shop'", "changes")
add(
    "sink_upsert",
    """, both_parts as (
      select user_id, event_id, event_type, k, case when event_type in ('signup', 'purchase') then 1 else 0 end as part from ev
    ), newest as (
      select *, row_number() over (partition by user_id order by part desc, event_id desc) as rn from both_parts
    ) select user_id, event_id, event_type, k from newest where rn = 1 and not (part = 1 and k >= 90)""",
    "ev",
)


def traffic(seconds: int) -> str:
    return f""", flagged as (
      select *, case when row_number() over (partition by mid, {day('et')} order by et, event_id) = 1 then 1 else 0 end as uv_ct,
        case when coalesce(last_page_id, '') = '' then 1 else 0 end as sv_ct, 1 as pv_ct, during_time as dur_sum
      from pages
    ), traffic as ({windowed('flagged', seconds, 'vc, ch, ar, is_new', sums('uv_ct', 'sv_ct', 'pv_ct', 'dur_sum'))})
    """


add("sink_summary", traffic(24 * HOUR) + "select * from traffic", "pages")
add(
    "sink_json_rows",
    """select '{"event_id":' || event_id || ',"event_type":"' || event_type || '","prop_k":' || k || '}' as value from ev""",
    "ev",
)

add(
    "flt_changelog_clean",
    """select tab as "table", type, ts, id from ch
    where db = 'shop' and type in ('insert', 'update', 'delete', 'bootstrap-insert') and has_data""",
    "changes",
)
add("flt_drop_bootstrap", "select event_id, type from ch where type <> '' and type not like '%bootstrap-%'", "changes")
add(
    "flt_table_inserts",
    "select id, user_id, sku_id, sku_num, ts from ch where tab = 'cart_info' and type = 'insert' and db = 'shop'",
    "changes",
)
add(
    "flt_status_transition",
    """select 'exact' as kind, event_id from ch where type = 'update' and old_order_status = '1001' and order_status = '1003'
    union all
    select 'any', event_id from ch where type = 'update' and old_order_status is not null and order_status = '1005'""",
    "changes",
)
add("fact_cart_add", CART, "changes")
add(
    "prj_keep_columns",
    "select event_id, case when has_data then 'id=' || id || ';sku_num=' || sku_num else '' end as kept from ch",
    "changes",
)
add(
    "prj_decimal_product",
    """select l_orderkey, l_linenumber, l_partkey, cast(p as double) as original, cast(p as varchar) as as_text
    from (select *, cast(cast(l_quantity as int) as decimal(16,2)) * cast(l_extendedprice as decimal(16,2)) as p from lineitem)""",
)
CLEAN = "db = 'shop' and type in ('insert', 'update', 'delete', 'bootstrap-insert') and has_data"
add(
    "route_dims",
    f"""select 'dim_cart' as sink_table, type, id as row_key, 'id=' || id || ';sku_id=' || sku_id || ';sku_num=' || sku_num as cells, ts
    from ch where {CLEAN} and tab = 'cart_info'
    union all
    select 'dim_user', type, user_id, 'id=' || id || ';user_id=' || user_id, ts from ch where {CLEAN} and tab = 'user_info'""",
    "changes",
)
add("route_facts", f"select sink_table, cells from ({FACT_ROUTES})", "changes")
add(
    "cfg_current",
    f"""with ch as ({ROUTES}), steps as (
      select -1 as ts_ms, 1 as alive, 'table_' || n_nationkey as source_table, 'snap_' || n_name as sink_table, 'id' as sink_columns from nation
      union all select ts_ms, 1, here, sink_table, sink_columns from ch where op <> 'd'
      union all select ts_ms, 0, case op when 'u' then other else here end, sink_table, sink_columns from ch where op in ('u', 'd')
    ), newest as (
      select *, row_number() over (partition by source_table order by ts_ms desc, alive desc) as rn from steps
    ) select source_table, sink_table, sink_columns from newest where rn = 1 and alive = 1""",
)
add(
    "dim_apply_changes",
    """, c as (
      select cast(user_id as varchar) as row_key, k >= 90 as gone, event_id,
        case when k % 2 = 0 then 'n' || event_id end as name, case when value < 10 then event_type end as segment from ev
    ), net as (
      select row_key, max(event_id) filter (gone) as g, max(event_id) filter (not gone) as p,
        max(event_id) filter (not gone and name is not null) as name_at,
        arg_max(name, event_id) filter (not gone and name is not null) as name,
        max(event_id) filter (not gone and segment is not null) as segment_at,
        arg_max(segment, event_id) filter (not gone and segment is not null) as segment
      from c group by row_key
    ), dim as (select cast(c_custkey as varchar) as row_key, c_name, c_mktsegment from customer)
    select coalesce(dim.row_key, net.row_key) as row_key,
      case when name_at is not null and (g is null or name_at > g) then name when g is null then c_name end as name,
      case when segment_at is not null and (g is null or segment_at > g) then segment when g is null then c_mktsegment end as segment
    from dim full outer join net on dim.row_key = net.row_key
    where net.row_key is null or g is null or coalesce(p > g, false)""",
    "ev",
)

add(
    "dim_build",
    f"""select 'dim_cart' as dim, id as row_key, sku_num as cell from ch where {CLEAN} and tab = 'cart_info' and type <> 'delete'
    union all
    select 'dim_user', user_id, id from (
      select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
      from ch where {CLEAN} and tab = 'user_info') where rn = 1 and type <> 'delete'""",
    "changes",
)

add("flt_logins", "select event_id, uid, last_page_id from pages where uid <> '' and coalesce(last_page_id, 'login') = 'login'", "pages")
add("flt_tombstones", RAW + " select value from raw where value <> ''", "ev")
add(
    "flt_bad_records",
    RAW + " select case when not (cut or empty) then event_id end as event_id, case when cut or empty then value end as bad from raw",
    "ev",
)
ERR = "(event_type = 'error' or (event_type = 'signup' and value >= 50))"
add("log_split_err", f"select mid, ts, cast(k as bigint) as error_code, props as msg from pages where {ERR}", "pages")
add("log_split_start", "select mid, ts, 'icon' as entry, cast(k as bigint) as loading_time from pages where event_type = 'signup'", "pages")
add("log_split_page", "select mid, ts, page_id, during_time from pages where event_type <> 'signup'", "pages")
add(
    "log_explode_displays",
    """select mid, ts, cast(k as varchar) as item, cast(k as bigint) as pos_id, cast(i as bigint) as pos_seq
    from (select *, unnest(range(1, 2 + k % 3)) as i from pages where event_type in ('view', 'click'))""",
    "pages",
)
add(
    "log_explode_actions",
    """select mid, ts + i as ts, 'act' || i as action_id, cast(k as varchar) as item
    from (select *, unnest(range(1, 2 + k % 3)) as i from pages where event_type = 'purchase')""",
    "pages",
)
WORDS = r"unnest(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')))"
add("lat_split_words", f"select doc_id, {WORDS} as word from documents")

JOINED = "(select *, l_orderkey as o, l_linenumber * 6 as off from lineitem)"
add(
    "join_inner",
    f"select l_orderkey, l_linenumber, l_partkey, o_custkey from {JOINED} join orders on o = o_orderkey and off <= 30",
)
add(
    "join_left",
    """select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, r.l_suppkey as coupon
    from lineitem l left join (select * from lineitem where l_returnflag = 'R') r
      on l.l_orderkey = r.l_orderkey and l.l_linenumber = r.l_linenumber""",
)
for name, before in (("join_interval", "30 minutes"), ("join_interval_day", "1 day")):
    add(
        name,
        f"""select p.user_id, p.event_id as payment_id, o.event_id as order_id
        from ev p join ev o on p.user_id = o.user_id and p.event_type = 'purchase' and o.event_type = 'view'
          and o.et >= p.et - interval '{before}' and o.et <= p.et + interval '5 seconds'""",
        "ev",
    )
add(
    "join_lookup",
    """select o_orderkey, substr(o_orderpriority, 1, 1) as code, r_name as name
    from orders join region on substr(o_orderpriority, 1, 1) = cast(r_regionkey as varchar)""",
)
add(
    "join_multi_key",
    """select l.l_orderkey, l.l_partkey, l.l_linenumber, r.l_suppkey as returned_to
    from lineitem l join lineitem r on l.l_orderkey = r.l_orderkey and l.l_partkey = r.l_partkey and r.l_returnflag = 'R'""",
)
add(
    "join_enrich",
    "select c_custkey, cast(c_nationkey as varchar) as nation, n_name as nation_name from customer left join nation on c_nationkey = n_nationkey",
)
add(
    "join_enrich_chain",
    """select l_orderkey, l_linenumber, l_partkey, cast(l_suppkey as varchar) as s, s_name, cast(s_nationkey as varchar) as n,
      n_name, cast(n_regionkey as varchar) as r, r_name
    from lineitem left join supplier on l_suppkey = s_suppkey left join nation on s_nationkey = n_nationkey
    left join region on n_regionkey = r_regionkey""",
)

add("fact_order_detail", "select * from od", "detail")
AMOUNTS = "split_original_amount, split_activity_amount, split_coupon_amount"
add(
    "fact_order_cancel",
    f"""select id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id,
      {day('epoch_ms(c.ts * 1000)')} as date_id, {stamp('epoch_ms(c.ts * 1000)')} as cancel_time,
      sku_num, {AMOUNTS}, split_total_amount, c.ts
    from od join (select o_orderkey, {T0} + o_orderkey * 10 + o_custkey % 1200 as ts from orders where o_orderstatus = 'F') c
      on od.order_id = cast(c.o_orderkey as varchar)""",
    "detail",
)
add(
    "fact_payment",
    f"""select id as order_detail_id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id, coupon_id,
      code as payment_type_code, r_name as payment_type_name, {stamp('epoch_ms(c.ts * 1000)')} as callback_time,
      sku_num, {AMOUNTS}, split_total_amount as split_payment_amount, c.ts
    from od join (select o_orderkey, substr(o_orderpriority, 1, 1) as code, {T0} + o_orderkey * 10 + o_custkey % 2400 as ts
                  from orders where o_orderstatus = 'O') c
      on od.order_id = cast(c.o_orderkey as varchar) and od.ts >= c.ts - 1800 and od.ts <= c.ts + 5
    join region on code = cast(r_regionkey as varchar)""",
    "detail",
)
add(
    "fact_refund",
    f"""select line_id as id, cast(l_suppkey as varchar) as user_id, cast(l_orderkey as varchar) as order_id,
      cast(l_partkey as varchar) as sku_id, cast(o_custkey % 25 as varchar) as province_id,
      {day('epoch_ms((base + l_linenumber * 3) * 1000)')} as date_id,
      {stamp('epoch_ms((base + l_linenumber * 3) * 1000)')} as create_time,
      cast(l_linenumber * 6 as varchar) as refund_type_code, t.n_name as refund_type_name,
      cast(l_suppkey % 25 as varchar) as refund_reason_type_code, r.n_name as refund_reason_type_name,
      l_linestatus as refund_reason_txt, cast(cast(l_quantity as int) as bigint) as refund_num,
      cast(cast(l_extendedprice as decimal(16,2)) as double) as refund_amount, base + l_linenumber * 3 as ts
    from li join orders on l_orderkey = o_orderkey and o_orderstatus = 'P'
    join nation t on l_linenumber * 6 = t.n_nationkey join nation r on l_suppkey % 25 = r.n_nationkey
    where l_returnflag = 'R'""",
    "lines",
)
add(
    "fact_refund_payment",
    f"""select p.line_id as id, cast(o_custkey as varchar) as user_id, cast(p.l_orderkey as varchar) as order_id,
      cast(p.l_partkey as varchar) as sku_id, cast(o_custkey % 25 as varchar) as province_id,
      cast(p.l_linenumber as varchar) as payment_type_code, r_name as payment_type_name,
      {day('epoch_ms((p.base + p.l_linenumber) * 1000)')} as date_id,
      {stamp('epoch_ms((p.base + p.l_linenumber) * 1000)')} as callback_time,
      cast(cast(d.l_quantity as int) as bigint) as refund_num,
      cast(cast(p.l_extendedprice as decimal(16,2)) as double) as refund_amount, p.base + p.l_linenumber as ts
    from li p join li d on p.l_orderkey = d.l_orderkey and p.l_partkey = d.l_partkey and d.l_returnflag = 'R'
    join orders on p.l_orderkey = o_orderkey and o_orderstatus = 'F'
    join region on p.l_linenumber = r_regionkey
    where p.l_returnflag = 'R' and p.l_linestatus = 'F'""",
    "lines",
)
add(
    "fact_comment",
    """select id, user_id, sku_id, appraise, n_name as appraise_name, comment_txt, ts
    from ch join nation on appraise = cast(n_nationkey as varchar)
    where tab = 'comment_info' and type = 'insert' and db = 'shop'""",
    "changes",
)

add(
    "state_fix_new_flag",
    f""", f as (select *, first_value(is_new) over w as first_flag, first_value({day('et')}) over w as first_day
      from pages window w as (partition by mid order by et, event_id))
    select event_id, is_new as was,
      case when is_new = '1' and not (first_flag = '1' and first_day = {day('et')}) then '0' else is_new end as is_new from f""",
    "pages",
)
add(
    "state_first_of_day",
    f"""select event_id, case when row_number() over (partition by mid, {day('et')} order by et, event_id) = 1 then 1 else 0 end as is_first from pages""",
    "pages",
)
add(
    "state_retract_offsets",
    """select id, sku_id, v2, v3, cast(price as double) as split_total_amount, cast(coupon as double) as split_coupon_amount from ranked
    union all
    select id, sku_id, v2, v3, cast(-price as double), cast(-coupon as double) from ranked where back > 1""",
    "versions",
)
NULLED = ", nulled as (select * replace (case when v1 % 3 <> 0 then v1 end as v1) from ov), placed as (select *, row_number() over (partition by id order by et desc, v1 desc nulls last, v2 desc, v3 desc) as place from nulled)"
add(
    "state_retract_nulls",
    NULLED + """ select id, sku_id, v2, v3, cast(price as double) as split_total_amount, cast(coupon as double) as split_coupon_amount from placed
    union all select id, sku_id, v2, v3, cast(-price as double), cast(-coupon as double) from placed where place > 1""",
    "versions",
)
add(
    "state_latest_per_key",
    f"select id, sku_id, cast(price as double) as split_total_amount, {stamp('et')} as et from ranked where back = 1",
    "versions",
)
add(
    "state_first_seen",
    f"select {stamp('et')} as et, order_id as \"order\", sku_id from ranked where order_row = 1",
    "versions",
)

add(
    "win_keyword_count",
    f"""with w as (select epoch_ms(({T0} + doc_id) * 1000) as et, {WORDS} as keyword from documents)
    {windowed('w', 10, 'keyword', 'count(*) as keyword_count')}""",
)
add("win_traffic_by_dims", traffic(HOUR) + "select * from traffic", "pages")
add("win_traffic_10s", traffic(10) + "select * from traffic", "pages")
add(
    "win_home_detail_uv",
    "," + first_days("pages", "mid, page_id", "page_id in ('home', 'good_detail')") + windowed(
        "(select et, case when page_id = 'home' then 1 else 0 end as home_uv_ct, case when page_id = 'home' then 0 else 1 end as good_detail_uv_ct from fl)",
        HOUR, "", sums("home_uv_ct", "good_detail_uv_ct"),
    ),
    "pages",
)
add(
    "win_login_back",
    "," + first_days("pages", "uid", "uid <> '' and coalesce(last_page_id, 'login') = 'login'") + windowed(
        "(select et, case when prev is not null and epoch_ms(et) - epoch_ms(cast(prev as timestamp)) >= 8 * 86400000 then 1 else 0 end as back_ct, 1 as uu_ct from fl)",
        24 * HOUR, "", sums("back_ct", "uu_ct"),
    ),
    "pages",
)
add(
    "win_register",
    windowed("(select date_trunc('second', et) as et from ev where event_type = 'signup')", HOUR, "", "count(*) as register_ct"),
    "ev",
)
add(
    "win_cart_uu",
    f""", cart as (select *, epoch_ms(ts * 1000) as et from ({CART})),"""
    + first_days("cart", "user_id")
    + windowed("fl", HOUR, "", "count(*) as cart_add_uu_ct"),
    "changes",
)


def ever(source: str, where: str, prefix: str) -> str:
    return "," + first_days(source, "user_id", where) + windowed(
        f"(select et, 1 as {prefix}_unique_user_count, case when prev is null then 1 else 0 end as {prefix}_new_user_count from fl)",
        HOUR, "", sums(f"{prefix}_unique_user_count", f"{prefix}_new_user_count"),
    )


add("win_payment_users", ever("ev", "event_type = 'purchase'", "payment_suc"), "ev")
add("win_order_users", ever("ov", "true", "order"), "versions")
add(
    "win_global_sum",
    windowed("ev", HOUR, "", "count(*) as n, cast(sum(cast(value as decimal(16,2))) as double) as amount"),
    "ev",
)
add(
    "win_sku_amounts",
    ", net as (select *, case when back = 1 then 1 else 0 end as live from ranked), summed as ("
    + windowed(
        "net", HOUR, "sku_id, sku_name",
        """cast(sum(price * live) as double) as original_amount, cast(sum(activity * live) as double) as activity_reduce_amount,
        cast(sum(coupon * live) as double) as coupon_reduce_amount, cast(sum(price * live) as double) as order_amount""",
    )
    + """) select stt, edt, cur_date, p_brand as trademark_id, upper(p_brand) as trademark_name,
      cast(n_regionkey as varchar) as category1_id, r_name as category1_name,
      cast(s_nationkey as varchar) as category2_id, n_name as category2_name,
      cast(p_size % 10 as varchar) as category3_id, s_name as category3_name, sku_id, sku_name,
      cast(p_size as varchar) as spu_id, 'spu-' || p_size as spu_name,
      original_amount, activity_reduce_amount, coupon_reduce_amount, order_amount
    from summed join part on sku_id = cast(p_partkey as varchar) join supplier on p_size % 10 = s_suppkey
    join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "versions",
)
PROVINCES = (
    ", parts as (select et, province_id, 0 as n, case when back = 1 then price else 0 end as price from ranked"
    " union all select et, province_id, 1, 0 from ranked where order_row = 1), summed as ("
    + windowed("parts", HOUR, "province_id", "cast(sum(n) as bigint) as order_count, sum(price) as order_amount")
    + """), named as (select stt, edt, cur_date, province_id, n_name as province_name, order_count, order_amount
      from summed join nation on province_id = cast(n_nationkey as varchar)) """
)
add(
    "win_province_orders",
    PROVINCES + "select * replace (cast(order_amount as double) as order_amount) from named",
    "versions",
)
add("serve_gmv", PROVINCES + "select cast(sum(order_amount) as double) as amount from named where cur_date = '2024-01-01'", "versions")
add(
    "serve_province_gmv",
    PROVINCES + "select province_name as province, cast(sum(order_amount) as double) as amount from named where cur_date = '2024-01-01' group by 1",
    "versions",
)
TOP = traffic(HOUR) + ", top as (select ch, cast(sum(uv_ct) as bigint) as uv_ct from traffic where cur_date = '2024-01-02' group by ch order by uv_ct desc, ch limit 3) "
add("serve_channel_uv", TOP + "select * from top", "pages")
add(
    "serve_channel_series",
    TOP + "select string_agg(ch, ',' order by uv_ct desc, ch) as categories, 'channel' as name, string_agg(cast(uv_ct as varchar), ',' order by uv_ct desc, ch) as data from top",
    "pages",
)
add(
    "scalar_functions",
    f"""select event_id, k as parsed, cast(null as int) as not_a_number, k as number,
      cast(cast(value as decimal(16,2)) as double) as amount,
      case when k > 50 then 'big' else 'small' end as size, {day('et')} as day, {stamp('et')} as stamp,
      strftime(et, '%Y%m%d') as par, (ts // 1000) * 1000 as stamp_ms, epoch_ms(date_trunc('day', et)) as day_ms,
      ts // 1000 as secs, case when event_type = 'view' then 1 else 0 end as blank, event_type || ':' || k as key
    from ev""",
    "ev",
)


for streamed in ("traffic_by_dims", "home_detail_uv", "login_back", "payment_users", "province_orders", "keyword_count"):
    ORACLE[f"stream_{streamed}"] = ORACLE[f"win_{streamed}"]
ORACLE["stream_late_drop"] = f"with {SQL['ev']}" + windowed(
    "(select et from ev where not (event_type = 'error' and day(et) <= 10))", HOUR, "", "count(*) as n"
)
ORACLE["stream_fix_new_flag"] = ORACLE["state_fix_new_flag"]
ORACLE["stream_latest_per_key"] = ORACLE["state_latest_per_key"]
ORACLE["stream_retract_offsets"] = ORACLE["state_retract_offsets"]
# The streamed join names a bound of five seconds of event time.
ORACLE["stream_refund"] = ORACLE["fact_refund"].replace("o_orderstatus = 'P'", "o_orderstatus = 'P' and abs(l_linenumber * 3 - 10) <= 5")
ORACLE["state_retract_duplicates"] = ORACLE["state_retract_offsets"]
ORACLE["sink_summary_two_batches"] = ORACLE["sink_summary"]
add(
    "src_upsert_topic",
    """, newest as (select *, row_number() over (partition by user_id order by event_id desc) as place from ev)
    select user_id, event_type, k, cast(1 as bigint) as n from newest where place = 1 and k < 90""",
    "ev",
)
add(
    "sink_upsert_topic",
    """, newest as (select *, row_number() over (partition by user_id order by event_id desc) as place from ev)
    select '+I' as op, user_id, event_type, k from newest where place = 1 and k < 90""",
    "ev",
)
ORACLE["src_changelog_split"] = ORACLE["src_changelog"]
ORACLE["fact_order_detail_split"] = ORACLE["fact_order_detail"]
ORACLE["stream_order_detail"] = f"with one as ({ORACLE['fact_order_detail']}) select *, count(*) as n from one group by all"
add(
    "stream_chain_province",
    # Lines that share an id are versions of one line, in the order of their texts.
    ", lines as (select * from od qualify row_number() over (partition by id order by ts desc, sku_num desc, cast(cast(split_total_amount as decimal(16,2)) as varchar) desc) = 1)"
    ", placed as (select *, epoch_ms(ts * 1000) as et, row_number() over (partition by order_id order by ts) as place from lines)"
    ", parts as (select et, province_id, case when place = 1 then 1 else 0 end as n, split_total_amount as price from placed), summed as ("
    + windowed("parts", HOUR, "province_id", "cast(sum(n) as bigint) as order_count, sum(cast(price as decimal(16,2))) as order_amount")
    + """) select stt, edt, cur_date, province_id, n_name as province_name, order_count, cast(order_amount as double) as order_amount
      from summed join nation on province_id = cast(n_nationkey as varchar)""",
    "detail",
)
