"""Summary tables (M1-M10): tumbling-window sums over the fact and log streams.

All of them run on batches and streams. Counts of distinct users come from "first row of the day"
sets, which are added to the plain sums by a union, so the rows themselves are never sorted by user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streammart.functions import as_decimal, is_blank
from streammart.operators import logs as log_ops
from streammart.operators.joins import enrich, enrich_chain
from streammart.operators.state import (
    day_and_ever_flags,
    first_rows_of_day,
    first_seen,
    latest_per_key,
    login_flags,
    offset_versions,
)
from streammart.operators.windows import (
    DEFAULT_WIDTH,
    ensure_watermark,
    stamp_window,
    tumble,
    tumble_agg,
)


def _sums(*names: str) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def _count(value: int, name: str) -> Column:
    return F.lit(value).cast("bigint").alias(name)


def keyword_counts(
    pages: DataFrame, width: str = DEFAULT_WIDTH, delay: str = "0 seconds", segmenter=None
) -> DataFrame:
    """Searches per word; a word counts once per search."""
    words = log_ops.lateral_split_words(log_ops.search_keywords(pages), segmenter=segmenter)
    if words.isStreaming:
        from streammart.streaming.keyed import stream_window_counts

        counted = stream_window_counts(words, "word", "keyword_count", width, delay=delay)
        return stamp_window(counted).withColumnRenamed("word", "keyword")
    counted = tumble_agg(
        words, ["word"], [F.count(F.lit(1)).alias("keyword_count")], width=width, delay=delay
    )
    return counted.withColumnRenamed("word", "keyword")


def traffic_by_dims(
    pages: DataFrame,
    width: str = DEFAULT_WIDTH,
    delay: str = "0 seconds",
    tie: str | None = None,
) -> DataFrame:
    """Visitors, sessions, views and seconds by version, channel, area and visitor kind.

    A device is a visitor once a day, in the group of its first view.
    """
    dims = {c: f"common.{c}" for c in ("vc", "ch", "ar", "is_new")}
    views = ensure_watermark(pages, "et", delay).select(
        "et",
        *[F.col(path).alias(c) for c, path in dims.items()],
        _count(0, "uv_ct"),
        is_blank("page.last_page_id").cast("bigint").alias("sv_ct"),
        _count(1, "pv_ct"),
        F.col("page.during_time").alias("dur_sum"),
    )
    first = first_rows_of_day(pages, {"mid": "common.mid"}, dims, tie=tie, delay=delay)
    visitors = first.select(
        "et",
        *dims,
        _count(1, "uv_ct"),
        _count(0, "sv_ct"),
        _count(0, "pv_ct"),
        _count(0, "dur_sum"),
    )
    sums = _sums("uv_ct", "sv_ct", "pv_ct", "dur_sum")
    return tumble_agg(views.unionByName(visitors), list(dims), sums, width=width, delay=delay)


def home_detail_uv(
    pages: DataFrame, width: str = DEFAULT_WIDTH, delay: str = "0 seconds"
) -> DataFrame:
    """Devices that saw the home page, and product pages, for the first time that day."""
    seen = log_ops.home_and_detail(pages)
    first = first_rows_of_day(
        seen, {"mid": "common.mid", "page_id": "page.page_id"}, delay=delay
    )
    flags = first.select(
        "et",
        (F.col("page_id") == "home").cast("bigint").alias("home_uv_ct"),
        (F.col("page_id") == "good_detail").cast("bigint").alias("good_detail_uv_ct"),
    )
    sums = _sums("home_uv_ct", "good_detail_uv_ct")
    return tumble_agg(flags, [], sums, width=width, delay=delay)


def login_users(
    pages: DataFrame, width: str = DEFAULT_WIDTH, delay: str = "0 seconds", gap_days: int = 8
) -> DataFrame:
    """Users who logged in for the first time that day, and those back after a gap."""
    flags = login_flags(log_ops.logins(pages), "common.uid", gap_days=gap_days, delay=delay)
    return tumble_agg(flags, [], _sums("back_ct", "uu_ct"), width=width, delay=delay)


def registrations(
    registers: DataFrame, width: str = DEFAULT_WIDTH, delay: str = "0 seconds"
) -> DataFrame:
    """Registrations, timed by ``create_time`` text."""
    rows = registers.select(
        F.try_to_timestamp("create_time", F.lit("yyyy-MM-dd HH:mm:ss")).alias("et")
    )
    count = [F.count(F.lit(1)).alias("register_ct")]
    return tumble_agg(rows.filter("et is not null"), [], count, width=width, delay=delay)


def cart_users(
    cart: DataFrame, width: str = DEFAULT_WIDTH, delay: str = "0 seconds"
) -> DataFrame:
    """Users who put something into their cart for the first time that day."""
    first = first_rows_of_day(cart, {"user_id": "user_id"}, delay=delay)
    total = [F.count(F.lit(1)).alias("cart_add_uu_ct")]
    return tumble_agg(first, [], total, width=width, delay=delay)


def payment_users(
    payments: DataFrame, width: str = DEFAULT_WIDTH, delay: str = "0 seconds"
) -> DataFrame:
    """Users paying for the first time that day (unique) and for the first time ever (new)."""
    flags = day_and_ever_flags(payments, "user_id", delay=delay).select(
        "et",
        F.col("unique_ct").alias("payment_suc_unique_user_count"),
        F.col("new_ct").alias("payment_suc_new_user_count"),
    )
    sums = _sums("payment_suc_unique_user_count", "payment_suc_new_user_count")
    return tumble_agg(flags, [], sums, width=width, delay=delay)


def order_users(
    order_detail: DataFrame, width: str = DEFAULT_WIDTH, delay: str = "0 seconds"
) -> DataFrame:
    """Users ordering for the first time that day (unique) and for the first time ever (new)."""
    flags = day_and_ever_flags(order_detail, "user_id", delay=delay).select(
        "et",
        F.col("unique_ct").alias("order_unique_user_count"),
        F.col("new_ct").alias("order_new_user_count"),
    )
    sums = _sums("order_unique_user_count", "order_new_user_count")
    return tumble_agg(flags, [], sums, width=width, delay=delay)


def _net_versions(
    rows: DataFrame, keys: list[str], order: list[str], measures: list[str], ttl: str, delay: str
) -> DataFrame:
    """Rows whose sums count only the latest version of each key.

    A stream offsets replaced versions. A batch reaches the same sums without marking rows: the
    latest versions carry the amounts, and all rows carry zeros so that no group goes missing.
    """
    # What only told the versions apart has done its work.
    rest = [c for c in rows.columns if c == "et" or c not in (*keys, *order)]
    if rows.isStreaming:
        return offset_versions(rows, keys, order, measures, ttl=ttl, delay=delay, columns=rest)
    types = dict(rows.dtypes)
    empty = rows.withColumns({m: F.lit(0).cast(types[m]) for m in measures})
    return empty.select(*rest).unionByName(latest_per_key(rows, keys, order, carry=rest).select(*rest))


SKU_AMOUNTS = {
    "original_amount": ("split_original_amount", "decimal(32,4)"),
    "activity_reduce_amount": ("split_activity_amount", "decimal(16,2)"),
    "coupon_reduce_amount": ("split_coupon_amount", "decimal(16,2)"),
    "order_amount": ("split_total_amount", "decimal(16,2)"),
}


def sku_amounts(
    order_detail: DataFrame,
    width: str = DEFAULT_WIDTH,
    delay: str = "0 seconds",
    order: tuple[str, ...] = ("et",),
    ttl: str = "1 hour",
) -> DataFrame:
    """Amounts per product, before its attributes are added."""
    amounts = [
        F.coalesce(F.col(c).try_cast(kind), F.lit(0).cast(kind)).alias(name)
        for name, (c, kind) in SKU_AMOUNTS.items()
    ]
    name, group = F.max("sku_name").alias("sku_name"), ["sku_id", "sku_name", "et"]
    if order_detail.isStreaming:
        rows = order_detail.select("id", *group, *amounts, *[c for c in order if c != "et"])
        net = _net_versions(rows, ["id"], list(order), list(SKU_AMOUNTS), ttl, delay)
        return tumble_agg(net, ["sku_id"], [name, *_sums(*SKU_AMOUNTS)], width=width, delay=delay)
    # As _net_versions, but versions travel with their amounts as they came, and all rows carry NULLs instead of
    # zeros, which are cheaper to add up.
    carry = [*group, *[c for c, _ in SKU_AMOUNTS.values()]]
    latest = latest_per_key(order_detail, ["id"], list(order), carry=carry).select(*group, *amounts)
    empty = order_detail.select(*group, *[F.lit(None).cast(kind).alias(name) for name, (_, kind) in SKU_AMOUNTS.items()])
    net = empty.unionByName(latest)
    # Text cannot sit in a hash aggregate's buffer. As a key it can, so order lines are summed by
    # hashing, and only the summed rows are sorted to settle a product that changed its name. They are
    # dealt and sorted by product, as a join with a large dimension needs them.
    named = net.groupBy(tumble("et", width).alias("window"), "sku_id", "sku_name").agg(*_sums(*SKU_AMOUNTS))
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in SKU_AMOUNTS]
    summed = named.repartition("sku_id").groupBy("sku_id", "window").agg(name, *sums)
    return stamp_window(summed.select("window", "sku_id", "sku_name", *SKU_AMOUNTS))


def sku_attributes(
    summed: DataFrame, dims: dict[str, DataFrame], on_missing: str = "fail"
) -> DataFrame:
    """Add trademark, spu and the three category levels, each step using keys of an earlier one.

    This follows the aggregation, so it looks up one row per window and product, not per order line.
    """
    steps = [
        (
            dims["dim_sku_info"],
            "sku_id",
            {"spu_id": "spu_id", "trademark_id": "tm_id", "category3_id": "category3_id"},
        ),
        (dims["dim_spu_info"], "spu_id", {"spu_name": "spu_name"}),
        (dims["dim_base_trademark"], "trademark_id", {"trademark_name": "tm_name"}),
        (
            dims["dim_base_category3"],
            "category3_id",
            {"category3_name": "name", "category2_id": "category2_id"},
        ),
        (
            dims["dim_base_category2"],
            "category2_id",
            {"category2_name": "name", "category1_id": "category1_id"},
        ),
        (dims["dim_base_category1"], "category1_id", {"category1_name": "name"}),
    ]
    rows = enrich_chain(summed, steps, on_missing=on_missing)
    return rows.select(
        "stt",
        "edt",
        "cur_date",
        "trademark_id",
        "trademark_name",
        "category1_id",
        "category1_name",
        "category2_id",
        "category2_name",
        "category3_id",
        "category3_name",
        "sku_id",
        "sku_name",
        "spu_id",
        "spu_name",
        *SKU_AMOUNTS,
    )


def sku_orders(
    order_detail: DataFrame,
    dims: dict[str, DataFrame],
    width: str = DEFAULT_WIDTH,
    delay: str = "0 seconds",
    order: tuple[str, ...] = ("et",),
    on_missing: str = "fail",
    ttl: str = "1 hour",
) -> DataFrame:
    """Order amounts per product with its attributes; corrected order lines count once.

    A stream forgets a version ``ttl`` of event time after it; a later correction would then be added.
    """
    return sku_attributes(sku_amounts(order_detail, width, delay, order, ttl), dims, on_missing)


def province_totals(
    order_detail: DataFrame,
    width: str = DEFAULT_WIDTH,
    delay: str = "0 seconds",
    order: tuple[str, ...] = ("et",),
    ttl: str = "1 hour",
) -> DataFrame:
    """Orders and amounts per province, before the name is added."""
    base = ensure_watermark(order_detail, "et", delay)
    rows = base.select(
        "id",
        "province_id",
        "et",
        F.coalesce(as_decimal("split_total_amount"), F.lit(0).cast("decimal(16,2)")).alias(
            "order_amount"
        ),
        *[c for c in order if c != "et"],
    )
    net = _net_versions(rows, ["id"], list(order), ["order_amount"], ttl, delay)
    amounts = net.select("et", "province_id", _count(0, "order_count"), "order_amount")
    tie = next((c for c in order if c != "et"), None)
    first = first_seen(order_detail, "order_id", {"province_id": "province_id"}, tie=tie, delay=delay)
    counts = first.select(
        "et",
        "province_id",
        _count(1, "order_count"),
        F.lit(0).cast("decimal(16,2)").alias("order_amount"),
    )
    sums = _sums("order_count", "order_amount")
    return tumble_agg(
        amounts.unionByName(counts), ["province_id"], sums, width=width, delay=delay
    )


def province_names(
    summed: DataFrame, province: DataFrame, on_missing: str = "fail"
) -> DataFrame:
    rows = enrich(
        summed, province, "province_id", {"province_name": "name"}, on_missing=on_missing
    )
    return rows.select(
        "stt", "edt", "cur_date", "province_id", "province_name", "order_count", "order_amount"
    )


def province_orders(
    order_detail: DataFrame,
    province: DataFrame,
    width: str = DEFAULT_WIDTH,
    delay: str = "0 seconds",
    order: tuple[str, ...] = ("et",),
    on_missing: str = "fail",
    ttl: str = "1 hour",
) -> DataFrame:
    """Orders (each counted once) and amounts per province, with its name; ``ttl`` as in :func:`sku_orders`."""
    return province_names(province_totals(order_detail, width, delay, order, ttl), province, on_missing)
