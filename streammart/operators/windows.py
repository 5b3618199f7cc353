"""Event time, tumbling windows and window stamps (W1-W4, A1-A6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streammart.functions import day_of, event_time, stamp_of

DEFAULT_WIDTH = "10 seconds"


def has_watermark(df: DataFrame, et: str = "et") -> bool:
    return "spark.watermarkDelayMs" in df.schema[et].metadata


def ensure_watermark(df: DataFrame, et: str = "et", delay: str = "0 seconds") -> DataFrame:
    """Attach a watermark to a stream that has none yet; leave batches alone."""
    if not df.isStreaming or has_watermark(df, et):
        return df
    return df.withWatermark(et, delay)


def with_event_time(
    df: DataFrame, ts: str = "ts", unit: str = "ms", delay: str | None = None, et: str = "et"
) -> DataFrame:
    """Add ``et`` from an epoch column; on a stream, rows later than ``delay`` are dropped."""
    df = df.withColumn(et, event_time(ts, unit))
    return ensure_watermark(df, et, delay) if delay else df


def tumble(et: Column | str = "et", width: str = DEFAULT_WIDTH) -> Column:
    """The epoch-aligned window a row belongs to."""
    return F.window(F.col(et) if isinstance(et, str) else et, width)


def stamp_window(df: DataFrame, window: str = "window") -> DataFrame:
    """Replace the window by ``stt``, ``edt`` and ``cur_date`` (the day the window starts)."""
    rest = [c for c in df.columns if c != window]
    start, end = F.col(f"{window}.start"), F.col(f"{window}.end")
    return df.select(
        stamp_of(start).alias("stt"),
        stamp_of(end).alias("edt"),
        day_of(start).alias("cur_date"),
        *rest,
    )


def tumble_agg(
    df: DataFrame,
    keys: list[str],
    aggs: list[Column],
    et: str = "et",
    width: str = DEFAULT_WIDTH,
    delay: str = "0 seconds",
    result: list[Column] | None = None,
) -> DataFrame:
    """Aggregate per window and key, stamped.

    With no keys this is one row per window. Each task aggregates its own rows first, so what is
    shuffled is one row per task, window and key, whatever the key's share of the input.

    A custom accumulator is a set of mergeable aggregates (``aggs``) plus the expressions that turn
    them into its ``result``; a grouped-aggregate Python UDF would pull a whole group into one task.
    """
    df = ensure_watermark(df, et, delay)
    grouped = df.groupBy(tumble(et, width).alias("window"), *keys).agg(*aggs)
    return stamp_window(grouped.select("window", *keys, *result) if result else grouped)
