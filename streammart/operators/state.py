"""Keyed flags over event time (T1-T8), batch form.

Every operator here answers "is this the first / latest / previous row of its key?". None sorts a
key's raw rows in one task: an aggregate finds the deciding value, which each task reduces before the
shuffle, and rows that need marking are matched on key *and* position, which spreads a hot key.
Streams are handed to :mod:`streammart.streaming.keyed`.

Positions are ``order`` columns and must be unique within a key; ``et`` alone may tie, so the batch
forms take a tie-break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streammart.functions import day_of


def latest_per_key(
    df: DataFrame, keys: list[str], order: list[str | Column], carry: list[str] | None = None
) -> DataFrame:
    """The row with the greatest ``order`` of each key: corrections applied, one row per key."""
    columns = carry if carry is not None else [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*columns), F.struct(*order)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "_newest.*")


def mark_extreme(
    df: DataFrame, keys: list[str | Column], order: list[str], flag: str, latest: bool = False
) -> DataFrame:
    """Flag the first (or latest) row of each key with 1, the others with 0."""
    named = [F.col(k) if isinstance(k, str) else k for k in keys]
    at = F.struct(*order)
    pick = (F.max(at) if latest else F.min(at)).alias("_at")
    grouped = df.select(*[k.alias(f"_k{i}") for i, k in enumerate(named)], *order)
    edge = grouped.groupBy(*[f"_k{i}" for i in range(len(named))]).agg(pick)
    edge = edge.select(
        *[F.col(f"_k{i}") for i in range(len(named))],
        *[F.col(f"_at.{c}").alias(f"_o{i}") for i, c in enumerate(order)],
        F.lit(1).alias("_edge"),
    )
    # NULL keys form a group like any other, hence the null-safe comparison.
    condition = F.lit(True)
    for i, k in enumerate(named):
        condition = condition & k.eqNullSafe(F.col(f"_k{i}"))
    # A row without a time (the first order column) is neither first nor latest; a NULL further on is a value, the least.
    for i, c in enumerate(order):
        here = F.col(f"_o{i}")
        condition = condition & (df[c].eqNullSafe(here) if i else df[c] == here)
    joined = df.join(edge, condition, "left")
    return joined.select(*df.columns, F.coalesce("_edge", F.lit(0)).alias(flag))


def fix_new_flag(
    logs: DataFrame,
    key: str = "common.mid",
    flag: str = "common.is_new",
    et: str = "et",
    tie: str | None = None,
) -> DataFrame:
    """Repair the new-visitor flag: it may be "1" only on a device's first day.

    A device whose first record says "0" was first seen before the log starts, so all of its later
    "1" flags are wrong. Adds ``is_new``; the nested flag is left as it was.
    """
    if logs.isStreaming:
        from streammart.streaming.keyed import stream_fix_new_flag

        return stream_fix_new_flag(logs, key, flag, et)
    order = [et] + ([tie] if tie else [])
    rows = logs.withColumns({"_mid": F.col(key), "_flag": F.col(flag)})
    first = rows.groupBy("_mid").agg(
        F.min(F.struct(*order, day_of(et).alias("day"), F.col("_flag").alias("first_flag"))).alias("f")
    )
    # NULL where the first record says "0": then no day of this device may say "1".
    verdict = first.select(
        F.col("_mid").alias("_dev"),
        F.when(F.col("f.first_flag") == "1", F.col("f.day")).alias("new_day"),
    )
    # Only rows that claim to be new have to meet their device's verdict; the rest, which is most
    # of a busy device's traffic, is neither shuffled nor joined.
    claims = F.coalesce(F.col("_flag") == "1", F.lit(False))
    claiming = rows.filter(claims)
    joined = claiming.join(verdict, claiming["_mid"].eqNullSafe(verdict["_dev"]), "left")
    fixed = F.when(F.col("new_day") == day_of(et), F.lit("1")).otherwise(F.lit("0"))
    settled = joined.select(*logs.columns, fixed.alias("is_new"))
    others = rows.filter(~claims).select(*logs.columns, F.col("_flag").alias("is_new"))
    return settled.unionByName(others)


def with_fixed_flag(logs: DataFrame, **options) -> DataFrame:
    """The records with the repaired flag put back into ``common``."""
    fixed = fix_new_flag(logs, **options)
    return fixed.withColumn("common", F.col("common").withField("is_new", F.col("is_new"))).drop(
        "is_new"
    )


def first_of_day(
    df: DataFrame, keys: list[str], et: str = "et", tie: str | None = None, flag: str = "is_first"
) -> DataFrame:
    """Every row, with 1 on the first row of its key on its day (batch only)."""
    order = [et] + ([tie] if tie else [])
    return mark_extreme(df, [*keys, day_of(et)], order, flag)


def first_rows_of_day(
    df: DataFrame,
    keys: dict[str, str],
    payload: dict[str, str] | None = None,
    et: str = "et",
    tie: str | None = None,
    history: bool = False,
    delay: str = "0 seconds",
) -> DataFrame:
    """One row per key and day: the key, ``day``, the first ``et``, and that row's payload.

    With ``history`` also ``prev_day``, the previous day the key occurred on, or NULL.
    ``keys`` and ``payload`` map new names to columns.
    """
    payload = payload or {}
    if df.isStreaming:
        from streammart.streaming.keyed import stream_first_rows_of_day

        return stream_first_rows_of_day(df, keys, payload, et, history, delay)
    rows = df.select(
        *[F.col(c).alias(name) for name, c in keys.items()],
        *[F.col(c).alias(name) for name, c in payload.items()],
        F.col(et).alias("et"),
        day_of(et).alias("day"),
        *([F.col(tie).alias("_tie")] if tie else []),
    )
    grouped = rows.groupBy(*keys, "day")
    if payload:
        # Without a tie-break, rows of one key at one instant are ranked by their payload.
        rank = F.struct("et", *(["_tie"] if tie else []), *payload)
        first = grouped.agg(F.min(rank).alias("_f"))
        first = first.select(*keys, "day", "_f.et", *[F.col(f"_f.{c}") for c in payload])
    else:
        # One fixed-width value per group: hash aggregation, no sorting.
        first = grouped.agg(F.min("et").alias("et"))
    if history:
        # At most one row per key and day is left here.
        days = Window.partitionBy(*keys).orderBy("day")
        first = first.withColumn("prev_day", F.lag("day").over(days))
    return first


def login_flags(
    df: DataFrame, key: str, et: str = "et", gap_days: int = 8, delay: str = "0 seconds"
) -> DataFrame:
    """A user's first login of each day: ``uu_ct`` 1, and ``back_ct`` 1 after a gap.

    The gap runs from midnight of the previous login day and counts when it is at least
    ``gap_days`` x 24 hours.
    """
    first = first_rows_of_day(df, {"_key": key}, et=et, history=True, delay=delay)
    gap = F.datediff(F.col("day").cast("date"), F.col("prev_day").cast("date"))
    return first.select(
        "et",
        F.coalesce((gap >= gap_days).cast("bigint"), F.lit(0).cast("bigint")).alias("back_ct"),
        F.lit(1).cast("bigint").alias("uu_ct"),
    )


def day_and_ever_flags(
    df: DataFrame, key: str, et: str = "et", delay: str = "0 seconds"
) -> DataFrame:
    """A key's first row of each day: ``unique_ct`` 1, and ``new_ct`` 1 if it is its first ever."""
    first = first_rows_of_day(df, {"_key": key}, et=et, history=True, delay=delay)
    return first.select(
        "et",
        F.lit(1).cast("bigint").alias("unique_ct"),
        F.col("prev_day").isNull().cast("bigint").alias("new_ct"),
    )


def first_seen(
    df: DataFrame,
    key: str,
    payload: dict[str, str],
    et: str = "et",
    tie: str | None = None,
    ttl: str = "1 day",
    delay: str = "0 seconds",
) -> DataFrame:
    """The first row of each key: its ``et`` and payload.

    A stream forgets a key when the watermark is ``ttl`` past it; a batch remembers every key.
    """
    if df.isStreaming:
        from streammart.streaming.keyed import stream_first_seen

        return stream_first_seen(df, key, payload, et, ttl, delay)
    rank = F.struct(
        F.col(et).alias("et"),
        *([F.col(tie).alias("_tie")] if tie else []),
        *[F.col(c).alias(name) for name, c in payload.items()],
    )
    first = df.groupBy(F.col(key).alias("_key")).agg(F.min(rank).alias("_f"))
    return first.select("_f.et", *[F.col(f"_f.{name}").alias(name) for name in payload])


def offset_versions(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    measures: list[str],
    et: str = "et",
    ttl: str = "1 hour",
    delay: str = "0 seconds",
    columns: list[str] | None = None,
) -> DataFrame:
    """Undo replaced versions: every row, and each replaced row again with its measures negated.

    Sums over the result equal sums over the latest versions, in every group a version ever fell
    into. A NULL measure counts as 0 when negated. ``order`` must tell the versions of a key apart: rows that
    agree on keys and order are the same version delivered again, and count once; a NULL in ``order`` ranks lowest.
    Rows without a time are left out, as they fall into no window. ``columns``, ``et`` among them, are those the result has.
    """
    if df.isStreaming:
        from streammart.streaming.keyed import stream_offset_versions

        return stream_offset_versions(df, keys, order, measures, et, ttl, delay, columns=columns)
    once = df.filter(F.col(et).isNotNull()).dropDuplicates([*keys, *order])
    marked = mark_extreme(once, keys, order, "_latest", latest=True)
    sign = F.when(F.col("_latest") == 1, F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(-1)))
    signed = marked.withColumn("_sign", F.explode(sign)).drop("_latest")
    types = dict(df.dtypes)
    undone = {
        m: F.when(F.col("_sign") == 1, F.col(m))
        .otherwise(-F.coalesce(F.col(m), F.lit(0)))
        .cast(types[m])
        for m in measures
    }
    return signed.withColumns(undone).select(*(columns or df.columns))
