"""Dashboard queries over one day of a summary table (A7, A8, L1, L2).

``day`` is a ``yyyyMMdd`` number; None means today in the session's time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streammart.functions import today_partition


def _day_text(day: int | None) -> Column:
    # Only constants: the comparison with the partition column is settled while listing folders.
    number = today_partition() if day is None else F.lit(int(day))
    return F.date_format(F.to_date(number.cast("string"), "yyyyMMdd"), "yyyy-MM-dd")


def one_day(summary: DataFrame, day: int | None = None) -> DataFrame:
    return summary.filter(F.col("cur_date") == _day_text(day))


def gmv(province_orders: DataFrame, day: int | None = None) -> DataFrame:
    """Revenue of a day."""
    return one_day(province_orders, day).agg(F.sum("order_amount").alias("amount"))


def province_gmv(province_orders: DataFrame, day: int | None = None) -> DataFrame:
    """Revenue of a day by province."""
    return (
        one_day(province_orders, day)
        .groupBy(F.col("province_name").alias("province"))
        .agg(F.sum("order_amount").alias("amount"))
    )


def channel_uv(traffic: DataFrame, day: int | None = None, limit: int = 5) -> DataFrame:
    """The channels with the most visitors of a day; equal counts are ranked by name."""
    return (
        one_day(traffic, day)
        .groupBy("ch")
        .agg(F.sum("uv_ct").alias("uv_ct"))
        .orderBy(F.desc("uv_ct"), "ch")
        .limit(limit)
    )


def as_series(ranked: DataFrame, category: str, value: str, name: str) -> DataFrame:
    """Chart form of a short ranking: one row with parallel lists, greatest value first."""
    pair = F.struct((-F.col(value)).alias("neg"), F.col(category).alias("cat"))
    rows = ranked.agg(F.array_sort(F.collect_list(pair)).alias("_p"))
    return rows.select(
        F.col("_p.cat").alias("categories"),
        F.lit(name).alias("name"),
        F.transform("_p.neg", lambda n: -n).alias("data"),
    )
