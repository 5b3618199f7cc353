"""Scalar column expressions. All of them are built-ins, so they stay inside generated code."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = "yyyy-MM-dd"
STAMP = "yyyy-MM-dd HH:mm:ss"
COMPACT_DAY = "yyyyMMdd"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_map(value: Column | str) -> Column:
    """JSON object text to ``map<string,string>``; NULL when the text is not a JSON object."""
    return F.from_json(_col(value), "map<string,string>")


def parsed_once(value: Column | str, schema: str) -> Column:
    """JSON text as a struct whose ``_bad`` holds the text when it does not fit the schema.

    The one-element generator keeps later filters on the result above the parse. As a plain
    projection the filter would be pushed below it with a second copy of the parse.
    """
    options = {"columnNameOfCorruptRecord": "_bad"}
    return F.explode(F.array(F.from_json(_col(value), f"{schema}, _bad string", options)))


def event_time(ts: Column | str, unit: str = "ms") -> Column:
    """Epoch number to a timestamp. The change log counts seconds, the application log milliseconds."""
    if unit == "ms":
        return F.timestamp_millis(_col(ts))
    if unit == "s":
        return F.timestamp_seconds(_col(ts))
    raise ValueError(f"unit must be 'ms' or 's', not {unit!r}")


def day_of(t: Column | str) -> Column:
    """``yyyy-MM-dd`` of a timestamp or a ``yyyy-MM-dd HH:mm:ss`` string."""
    return F.date_format(_col(t), DAY)


def stamp_of(t: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a timestamp."""
    return F.date_format(_col(t), STAMP)


def partition_day(t: Column | str) -> Column:
    """``yyyyMMdd`` of a timestamp, the form dashboard requests use."""
    return F.date_format(_col(t), COMPACT_DAY)


def epoch_ms(stamp: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text to epoch milliseconds; NULL when it does not parse."""
    return F.unix_millis(F.try_to_timestamp(_col(stamp), F.lit(STAMP)))


def day_start_ms(day: Column | str) -> Column:
    """``yyyy-MM-dd`` text to the epoch milliseconds of its midnight."""
    return F.unix_millis(F.try_to_timestamp(_col(day), F.lit(DAY)))


def today_partition() -> Column:
    """Today as a ``yyyyMMdd`` number, the default day of the dashboard queries."""
    return F.date_format(F.current_date(), COMPACT_DAY).cast("int")


def as_int(c: Column | str) -> Column:
    """Text to integer; NULL instead of an error when it is not a number."""
    return _col(c).try_cast("int")


def as_decimal(c: Column | str, precision: int = 16, scale: int = 2) -> Column:
    """Text to an exact decimal; NULL instead of an error when it is not a number."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def is_blank(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit("")) == ""


def not_blank(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit("")) != ""


def colon_key(*cols: Column | str) -> Column:
    """``a:b`` for showing composite keys. Joins use the separate columns instead."""
    return F.concat_ws(":", *[_col(c) for c in cols])


def keep_keys(data: Column | str, wanted: Column | str) -> Column:
    """Keep the entries of a map whose key occurs in a comma-separated list."""
    keys = F.split(_col(wanted), ",")
    return F.map_filter(_col(data), lambda k, _: F.array_contains(keys, k))


def snake_name(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", name).lower()


def camel_name(name: str) -> str:
    head, *tail = name.split("_")
    return head + "".join(part.capitalize() for part in tail)


def snake_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_name(c) for c in df.columns])
