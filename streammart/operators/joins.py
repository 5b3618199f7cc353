"""Joins (J1-J7): fact joins with a time bound, interval joins, dictionary and dimension look-ups.

None of them hints at a broadcast. Catalyst broadcasts a side whose statistics, or whose measured
shuffle size under AQE, is below ``spark.sql.autoBroadcastJoinThreshold``, and shuffles it otherwise;
AQE then splits the partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

On = list[tuple[str, str]] | tuple[str, str] | str


def _pairs(on: On) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    return [on] if isinstance(on, tuple) else list(on)


def interval(text: str) -> Column:
    return F.expr(f"interval {text}")


def _prefixed(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(f"_r_{c}") for c in df.columns])


def fact_join(
    left: DataFrame,
    right: DataFrame,
    on: On,
    how: str = "inner",
    bound: str | None = None,
    et: str = "et",
    buckets: int | None = None,
) -> DataFrame:
    """Equi join of two fact sides on one or more columns, keeping the left time.

    ``bound`` limits how far apart in event time two matching rows may be. Streams need it: with it
    Spark knows when a stored row can no longer match, drops it, and lets an unmatched left row of a
    ``left`` join out. Batches may leave it out. Right columns whose names the left side also has
    are dropped.

    With ``buckets`` the rows of an inner join of two streams are held packed in as many buckets of keys, which takes less
    disk. What it makes may be ``bound`` behind the watermark: only for readers that take ``behind``.
    """
    if left.isStreaming and right.isStreaming and bound is None:
        raise ValueError("a join of two streams needs a bound, otherwise its state grows for ever")
    pairs = _pairs(on)
    extra = [c for c in right.columns if c not in left.columns and c not in {r for _, r in pairs}]
    if buckets and left.isStreaming and right.isStreaming:
        if how != "inner":
            raise ValueError("only inner joins are held in buckets")
        from streammart.streaming.keyed import stream_inner_join

        return stream_inner_join(left, right, pairs, extra, bound, et, buckets)
    other = _prefixed(right)
    condition = F.lit(True)
    for lcol, rcol in pairs:
        condition = condition & (left[lcol] == other[f"_r_{rcol}"])
    if bound:
        near = interval(bound)
        condition = condition & (
            (other[f"_r_{et}"] >= left[et] - near) & (other[f"_r_{et}"] <= left[et] + near)
        )
    joined = left.join(other, condition, how)
    return joined.select(*left.columns, *[F.col(f"_r_{c}").alias(c) for c in extra])


def early_left_join(
    left: DataFrame, sides: list[DataFrame], key: str, bound: str, et: str = "et", delay: str = "3 seconds", behind: str = "0 seconds"
) -> DataFrame:
    """Left rows with the matches of several sides on one key, written at once and corrected later (J2).

    Adds ``sign`` and ``ver``. A left row without a match is written with NULLs as soon as it comes (``sign`` 1); when
    a match arrives within ``bound`` of event time, that row is taken back (``sign`` -1) and written again. Sums of
    sign times measure over the result are those of a left join; ``ver`` counts the writes of a key, so its greatest is
    the newest. On a batch this is the left join itself. Left rows may be ``behind`` the watermark, as an earlier join leaves them.
    """
    extra = [[c for c in side.columns if c not in left.columns] for side in sides]
    if not left.isStreaming:
        rows = left
        for side in sides:
            rows = fact_join(rows, side, key, "left", bound, et)
        return rows.withColumns({"sign": F.lit(1), "ver": F.lit(1).cast("bigint")})
    from streammart.streaming.keyed import stream_early_left_join

    out = stream_early_left_join([left, *sides], [key], bound, et, delay, behind=behind)
    return out.select(
        *[(F.col("k0") if c == key else F.col("rows")[0][f"s0_{c}"]).alias(c) for c in left.columns],
        *[F.col("rows")[i][f"s{i}_{c}"].alias(c) for i, names in enumerate(extra, 1) for c in names],
        "sign",
        "ver",
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: On,
    before: str,
    after: str,
    et: str = "et",
) -> DataFrame:
    """Pairs with equal keys whose right time lies in [left time - before, left time + after].

    Both sides are also joined on a time slot as long as the interval. A left row looks into the
    two or three slots its interval touches, a right row is in exactly one, so each pair
    is found once, and a hot key is spread over its slots and never compared with its whole history.
    """
    pairs = _pairs(on)
    lo, hi = interval(before), interval(after)
    width = F.greatest(F.lit(1), _seconds(before) + _seconds(after))
    first, last = (F.floor(F.unix_seconds(t) / width) for t in (F.col(et) - lo, F.col(et) + hi))
    probes = left.withColumn("_slot", F.explode(F.sequence(first, last)))
    other = _prefixed(right.withColumn("_slot", F.floor(F.unix_seconds(F.col(et)) / width)))
    condition = probes["_slot"] == other["_r__slot"]
    for lcol, rcol in pairs:
        condition = condition & (probes[lcol] == other[f"_r_{rcol}"])
    condition = condition & (
        (other[f"_r_{et}"] >= probes[et] - lo) & (other[f"_r_{et}"] <= probes[et] + hi)
    )
    extra = [c for c in right.columns if c not in left.columns and c not in {r for _, r in pairs}]
    joined = probes.join(other, condition)
    return joined.select(*left.columns, *[F.col(f"_r_{c}").alias(c) for c in extra])


def _seconds(text: str) -> Column:
    zero = F.timestamp_seconds(F.lit(0))
    return F.unix_seconds(zero + interval(text))


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str,
    columns: Mapping[str, str],
    how: str = "inner",
) -> DataFrame:
    """Add dictionary columns ``{new name: dim column}``; rows without a match are dropped.

    Reading ``dim`` anew for each micro-batch gives the values in force when a row is processed.
    """
    table = dim.select(
        F.col(dim_key).alias("_k"), *[F.col(c).alias(name) for name, c in columns.items()]
    )
    return df.join(table, df[key] == table["_k"], how).drop("_k")


def enrich(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    columns: Mapping[str, str],
    dim_key: str = "id",
    on_missing: str = "fail",
) -> DataFrame:
    """Add dimension columns. A key without a row fails the job, gives NULLs or drops the row."""
    return enrich_chain(df, [(dim, key, columns)], dim_key, on_missing)


def enrich_chain(
    df: DataFrame,
    steps: list[tuple[DataFrame, str, Mapping[str, str]]],
    dim_key: str = "id",
    on_missing: str = "fail",
) -> DataFrame:
    """Several look-ups in order; a step may use a key that an earlier one added.

    Such a step is joined to the earlier dimension, not to the rows: they meet one table for each key of their own and
    are never dealt by a key that has few values.
    """
    if on_missing not in ("fail", "null", "drop"):
        raise ValueError("on_missing must be 'fail', 'null' or 'drop'")
    how = "inner" if on_missing == "drop" else "left"
    own, chains = set(df.columns), []
    for i, (dim, key, columns) in enumerate(steps):
        # A left join of a found row sets the flag, so that what is missing is told from a NULL that is there.
        table = dim.select(
            F.col(dim_key).alias(f"_k{i}"),
            *[F.col(c).alias(name) for name, c in columns.items()],
            *([F.lit(True).alias(f"_hit{i}")] if on_missing == "fail" else []),
        )
        at = None if key in own else next((n for n, (_, _, t) in enumerate(chains) if key in t.columns), None)
        if at is None:
            chains.append((i, key, table))
        else:
            first, start, earlier = chains[at]
            chains[at] = (first, start, earlier.join(table, earlier[key] == table[f"_k{i}"], how).drop(f"_k{i}"))
    for i, key, table in chains:
        df = df.join(table, df[key] == table[f"_k{i}"], how).drop(f"_k{i}")
    if on_missing == "fail":
        for i, (_, key, columns) in enumerate(steps):
            message = F.concat(F.lit(f"no dimension row for {key} = "), F.coalesce(key, F.lit("NULL")))
            checked = {
                name: F.when(F.col(f"_hit{i}"), F.col(name)).otherwise(F.raise_error(message))
                for name in columns
            }
            df = df.withColumns(checked).drop(f"_hit{i}")
    return df
