"""Fact tables (D1-D10), one builder per table.

Each takes change-log rows (batch or stream) and returns typed rows; amounts are exact decimals.
``bound`` is the event-time distance two joined records may have. A batch needs none and keeps every pair;
a join of two streams must name one, as it bounds the state (30 seconds for order lines, 910 seconds for
cancelled orders and 5 seconds for refunds are the surveyed settings).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streammart.functions import as_decimal, day_of
from streammart.operators.changelog import (
    apply_dim_changes,
    cart_additions,
    cells,
    changes_of,
    clean_changelog,
    current_config,
    decimal_product,
    drop_bootstrap,
    route_dims,
    route_facts,
    transition,
)
from streammart.operators.joins import early_left_join, fact_join, interval_join, lookup

# Status codes of the source system.
ORDER_PLACED, ORDER_CANCELLED = "1001", "1003"
ORDER_REFUNDING, ORDER_REFUNDED = "1005", "1006"
PAYMENT_DONE, REFUND_PAID, REFUND_DONE = "1602", "1602", "0705"


def _of(changes: DataFrame, table: str, database: str | None) -> DataFrame:
    rows = changes.filter(F.col("table") == table)
    return rows.filter(F.col("database") == database) if database else rows


def _order_line_sides(changes: DataFrame, database: str | None) -> tuple[DataFrame, ...]:
    """Orders, their lines, and the lines' activities and coupons."""
    order = changes_of(changes, "order_info", "insert", ["id", "user_id", "province_id"], database)
    line = changes_of(
        changes,
        "order_detail",
        "insert",
        [
            "id",
            "order_id",
            "sku_id",
            "sku_name",
            "create_time",
            "sku_num",
            "order_price",
            "split_total_amount",
            "split_activity_amount",
            "split_coupon_amount",
        ],
        database,
    )
    activity = changes_of(
        changes,
        "order_detail_activity",
        "insert",
        ["order_detail_id", "activity_id", "activity_rule_id"],
        database,
    )
    coupon = changes_of(
        changes, "order_detail_coupon", "insert", ["order_detail_id", "coupon_id"], database
    )
    return order, line, activity, coupon


def _order_detail_columns(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select(
        "id",
        "order_id",
        "user_id",
        "sku_id",
        "sku_name",
        "province_id",
        "activity_id",
        "activity_rule_id",
        "coupon_id",
        day_of("create_time").alias("date_id"),
        "create_time",
        "sku_num",
        decimal_product(F.col("sku_num"), F.col("order_price")).alias("split_original_amount"),
        as_decimal("split_activity_amount").alias("split_activity_amount"),
        as_decimal("split_coupon_amount").alias("split_coupon_amount"),
        as_decimal("split_total_amount").alias("split_total_amount"),
        "ts",
        "et",
        *more,
    )


def fact_order_detail(
    changes: DataFrame, bound: str | None = None, database: str | None = None
) -> DataFrame:
    """Order lines with their order, and with activity and coupon where there is one.

    A line is written once: a stream holds a line without activity or coupon until the watermark
    passes the bound. :func:`early_order_detail` writes it early and corrects it.
    """
    order, line, activity, coupon = _order_line_sides(changes, database)
    if changes.isStreaming:
        rows = fact_join(line, order, ("order_id", "id"), "inner", bound)
        rows = fact_join(rows, activity, ("id", "order_detail_id"), "left", bound)
        rows = fact_join(rows, coupon, ("id", "order_detail_id"), "left", bound)
        return _order_detail_columns(rows)
    # The order comes last: a join of the result by order finds it dealt by order already. Amounts travel as numbers.
    amounts = ["order_price", "split_total_amount", "split_activity_amount", "split_coupon_amount"]
    line = line.withColumns({c: as_decimal(c) for c in amounts})
    rows = fact_join(line, activity, ("id", "order_detail_id"), "left", bound)
    rows = fact_join(rows, coupon, ("id", "order_detail_id"), "left", bound)
    rows = fact_join(rows, order, ("order_id", "id"), "inner", bound)
    return _order_detail_columns(rows)


def early_order_detail(changes: DataFrame, bound: str = "30 seconds", database: str | None = None) -> DataFrame:
    """Order lines as soon as line and order are there, with ``sign`` and ``ver`` as :func:`early_left_join` adds them."""
    order, line, activity, coupon = _order_line_sides(changes, database)
    rows = fact_join(line, order, ("order_id", "id"), "inner", bound, buckets=256)
    sides = [side.withColumnRenamed("order_detail_id", "id").drop("ts") for side in (activity, coupon)]
    return _order_detail_columns(early_left_join(rows, sides, "id", bound, behind=bound), "sign", "ver")


def order_detail_log(rows: DataFrame) -> DataFrame:
    """The append-only fact log of :func:`early_order_detail`: every version of a line, with the times of its writing.

    ``ver`` puts the versions of a line in order. A reader that nets versions (T7) needs no rows that are taken back.
    """
    return with_processing_times(rows.filter("sign = 1").drop("sign", "et"))


def with_processing_times(fact: DataFrame) -> DataFrame:
    """Add when a row was processed: ``ct``/``pt`` as timestamps, ``uct``/``ut`` in epoch seconds."""
    now = F.current_timestamp()
    return fact.withColumns(
        {"ct": now, "uct": F.unix_timestamp(now), "pt": now, "ut": F.unix_timestamp(now)}
    )


def fact_order_cancel(
    order_detail: DataFrame,
    changes: DataFrame,
    bound: str | None = None,
    database: str | None = None,
) -> DataFrame:
    """The lines of orders that went from placed to cancelled, with the time of cancelling."""
    gone = transition(
        _of(changes, "order_info", database), "order_status", ORDER_CANCELLED, ORDER_PLACED
    )
    gone = gone.select(*cells({"cancelled_id": "id", "cancel_time": "operate_time"}), "ts", "et")
    rows = fact_join(
        gone,
        order_detail.drop("date_id", "create_time", "ct", "uct", "pt", "ut"),
        ("cancelled_id", "order_id"),
        "inner",
        bound,
    )
    return rows.select(
        "id",
        F.col("cancelled_id").alias("order_id"),
        "user_id",
        "sku_id",
        "sku_name",
        "province_id",
        "activity_id",
        "activity_rule_id",
        "coupon_id",
        day_of("cancel_time").alias("date_id"),
        "cancel_time",
        "sku_num",
        "split_original_amount",
        "split_activity_amount",
        "split_coupon_amount",
        "split_total_amount",
        "ts",
        "et",
    )


def join_payments(
    order_detail: DataFrame,
    changes: DataFrame,
    before: str = "30 minutes",
    after: str = "5 seconds",
    database: str | None = None,
) -> DataFrame:
    """Successful payments with the lines ordered from ``before`` until ``after`` around them."""
    paid = transition(_of(changes, "payment_info", database), "payment_status", PAYMENT_DONE)
    paid = paid.select(
        *cells(
            {
                "paid_order_id": "order_id",
                "payment_type_code": "payment_type",
                "callback_time": "callback_time",
            }
        ),
        "ts",
        "et",
    )
    return interval_join(paid, order_detail, ("paid_order_id", "order_id"), before, after)


def fact_payment(
    order_detail: DataFrame,
    changes: DataFrame,
    dic: DataFrame,
    before: str = "30 minutes",
    after: str = "5 seconds",
    database: str | None = None,
) -> DataFrame:
    """Paid order lines with the name of the payment type; an unknown type drops the row."""
    return name_payments(join_payments(order_detail, changes, before, after, database), dic)


def name_payments(rows: DataFrame, dic: DataFrame) -> DataFrame:
    rows = lookup(rows, dic, "payment_type_code", "dic_code", {"payment_type_name": "dic_name"})
    return rows.select(
        F.col("id").alias("order_detail_id"),
        F.col("paid_order_id").alias("order_id"),
        "user_id",
        "sku_id",
        "sku_name",
        "province_id",
        "activity_id",
        "activity_rule_id",
        "coupon_id",
        "payment_type_code",
        "payment_type_name",
        "callback_time",
        "sku_num",
        "split_original_amount",
        "split_activity_amount",
        "split_coupon_amount",
        F.col("split_total_amount").alias("split_payment_amount"),
        "ts",
        "et",
    )


def join_refunds(
    changes: DataFrame, bound: str | None = None, database: str | None = None
) -> DataFrame:
    """Refund requests with the province of their order."""
    request = changes_of(
        changes,
        "order_refund_info",
        "insert",
        {
            "id": "id",
            "user_id": "user_id",
            "order_id": "order_id",
            "sku_id": "sku_id",
            "create_time": "create_time",
            "refund_type_code": "refund_type",
            "refund_reason_type_code": "refund_reason_type",
            "refund_reason_txt": "refund_reason_txt",
            "refund_num": "refund_num",
            "refund_amount": "refund_amount",
        },
        database,
    )
    order = transition(_of(changes, "order_info", database), "order_status", ORDER_REFUNDING)
    order = order.select(*cells({"refunded_id": "id", "province_id": "province_id"}), "et")
    return fact_join(request, order, ("order_id", "refunded_id"), "inner", bound)


def name_refunds(rows: DataFrame, dic: DataFrame) -> DataFrame:
    rows = lookup(rows, dic, "refund_type_code", "dic_code", {"refund_type_name": "dic_name"})
    rows = lookup(
        rows, dic, "refund_reason_type_code", "dic_code", {"refund_reason_type_name": "dic_name"}
    )
    return rows.select(
        "id",
        "user_id",
        "order_id",
        "sku_id",
        "province_id",
        day_of("create_time").alias("date_id"),
        "create_time",
        "refund_type_code",
        "refund_type_name",
        "refund_reason_type_code",
        "refund_reason_type_name",
        "refund_reason_txt",
        F.col("refund_num").try_cast("bigint").alias("refund_num"),
        as_decimal("refund_amount").alias("refund_amount"),
        "ts",
        "et",
    )


def fact_refund(
    changes: DataFrame,
    dic: DataFrame,
    bound: str | None = None,
    database: str | None = None,
) -> DataFrame:
    """Refund requests with the names of type and reason."""
    return name_refunds(join_refunds(changes, bound, database), dic)


def join_refund_payments(
    changes: DataFrame, bound: str | None = None, database: str | None = None
) -> DataFrame:
    """Refunds paid out, with the refund line's quantity and the order's user and province."""
    paid = transition(_of(changes, "refund_payment", database), "refund_status", REFUND_PAID)
    paid = paid.select(
        *cells(
            {
                "id": "id",
                "order_id": "order_id",
                "sku_id": "sku_id",
                "payment_type_code": "payment_type",
                "callback_time": "callback_time",
                "refund_amount": "total_amount",
            }
        ),
        "ts",
        "et",
    )
    line = transition(_of(changes, "order_refund_info", database), "refund_status", REFUND_DONE)
    line = line.select(*cells(["order_id", "sku_id", "refund_num"]), "et")
    order = transition(_of(changes, "order_info", database), "order_status", ORDER_REFUNDED)
    order = order.select(
        *cells({"refunded_id": "id", "user_id": "user_id", "province_id": "province_id"}), "et"
    )
    rows = fact_join(paid, line, [("order_id", "order_id"), ("sku_id", "sku_id")], "inner", bound)
    return fact_join(rows, order, ("order_id", "refunded_id"), "inner", bound)


def name_refund_payments(rows: DataFrame, dic: DataFrame) -> DataFrame:
    rows = lookup(rows, dic, "payment_type_code", "dic_code", {"payment_type_name": "dic_name"})
    return rows.select(
        "id",
        "user_id",
        "order_id",
        "sku_id",
        "province_id",
        "payment_type_code",
        "payment_type_name",
        day_of("callback_time").alias("date_id"),
        "callback_time",
        F.col("refund_num").try_cast("bigint").alias("refund_num"),
        as_decimal("refund_amount").alias("refund_amount"),
        "ts",
        "et",
    )


def fact_refund_payment(
    changes: DataFrame,
    dic: DataFrame,
    bound: str | None = None,
    database: str | None = None,
) -> DataFrame:
    """Refunds paid out, with the name of the payment type."""
    return name_refund_payments(join_refund_payments(changes, bound, database), dic)


def fact_cart_add(changes: DataFrame, database: str | None = None) -> DataFrame:
    return cart_additions(changes, database)


def fact_comment(changes: DataFrame, dic: DataFrame, database: str | None = None) -> DataFrame:
    """New comments with the name of their rating."""
    rows = changes_of(
        changes,
        "comment_info",
        "insert",
        ["id", "user_id", "sku_id", "appraise", "comment_txt"],
        database,
    )
    rows = lookup(rows, dic, "appraise", "dic_code", {"appraise_name": "dic_name"})
    times = [c for c in ("ts", "et") if c in rows.columns]
    return rows.select(
        "id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt", *times
    )


def routed_facts(changes: DataFrame, config: DataFrame, database: str | None = None) -> DataFrame:
    """Facts that need no join: pruned and addressed as the routing table says."""
    return route_facts(drop_bootstrap(changes), config, database)


def build_dims(
    changes: DataFrame,
    snapshot: DataFrame | None,
    config_changes: DataFrame | None,
    current: dict[str, DataFrame],
    columns: dict[str, list[str]],
    database: str,
    order: list[str],
) -> dict[str, DataFrame]:
    """All dimensions after a batch of changes: ``{sink table: rows}``.

    ``columns`` names the cells of each dimension; ``current`` holds the stored ones.
    """
    config = current_config(snapshot, config_changes, ["source_table"])
    routed = route_dims(clean_changelog(changes, database), config, *order)
    return {
        name: apply_dim_changes(
            current.get(name), routed.filter(F.col("sink_table") == name), cols, order
        )
        for name, cols in columns.items()
    }
