"""Streaming forms of the keyed operators in :mod:`streammart.operators.state`."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from streammart.functions import day_of
from streammart.operators.windows import ensure_watermark, has_watermark, tumble
from streammart.streaming import processors
from streammart.streaming.processors import (
    EarlyLeftJoin,
    FirstOfDay,
    FirstSeen,
    FirstSeenByKey,
    FixNewFlag,
    InnerJoin,
    LatestAfterDelay,
    LatestInBucket,
    Normalise,
    OffsetByKey,
    OffsetVersions,
    WindowCounts,
)

# Send the processors to the executors by value: the package need not be installed there.
cloudpickle.register_pickle_by_value(processors)


def millis(text: str) -> int:
    """``"5 seconds"`` as milliseconds."""
    return int(pd.Timedelta(text) / pd.Timedelta(milliseconds=1))


def keep_first_rows(df: DataFrame, groups: list[str], order: list[str]) -> DataFrame:
    """Reduce each Arrow batch, before the shuffle, to its first row per group.

    This is the map-side half of a keyed "first": a key with most of the traffic sends one row per
    batch to its state instead of all. The batch's newest row stays too, so that the watermark
    advances as if nothing had been removed.
    """

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                first = pdf.sort_values(order, na_position="first").drop_duplicates(groups)
                newest = pdf.loc[[pdf["et"].idxmax()]]
                yield first if newest.index[0] in first.index else pd.concat([first, newest])

    return df.mapInPandas(reduce, df.schema)


def _candidates(
    df: DataFrame, keys: dict, payload: dict, et: str, groups: list[str], delay: str
) -> DataFrame:
    """Watermarked rows that may be the first of their key, reduced where that is possible.

    Rows without a time belong to no day and are left out, as in a batch.
    """
    rows = df.filter(F.col(et).isNotNull()).select(
        *[F.col(c).alias(name) for name, c in keys.items()],
        *[F.col(c).alias(name) for name, c in payload.items()],
        F.col(et).alias("et"),
        day_of(et).alias("day"),
    )
    if has_watermark(df, et):
        return rows
    rows = keep_first_rows(rows, [*keys, *groups], ["et", *payload])
    return rows.withWatermark("et", delay)


def stream_first_rows_of_day(
    df: DataFrame, keys: dict, payload: dict, et: str, history: bool, delay: str
) -> DataFrame:
    midnight = F.date_trunc("day", "et") + F.expr("interval 1 day")
    rows = _candidates(df, keys, payload, et, ["day"], delay)
    rows = rows.withColumn("day_end", F.unix_millis(midnight))
    names = [*keys, "day", "et", *payload]
    fields = [T.StructField(c, rows.schema[c].dataType) for c in names]
    first = rows.groupBy(*keys).transformWithState(
        statefulProcessor=FirstOfDay(list(keys), list(payload)),
        outputStructType=T.StructType([*fields, T.StructField("prev_day", T.StringType())]),
        outputMode="append",
        timeMode="EventTime",
        eventTimeColumnName="et",
    )
    return first if history else first.drop("prev_day")


def bucket_of(keys: list[str], buckets: int) -> Column:
    """Buckets must stay the same between restarts; choose more for more live keys."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def packed(rows: DataFrame, delay: str, reduce: Callable[[pa.Table], pa.Table] | None = None) -> DataFrame:
    """Rows with ``_bucket`` and ``_et`` as one row for each bucket in a piece of a partition: ``rows`` in Arrow bytes.

    Spark hands rows to a state processor one by one; packed ones travel and are compared as tables. ``reduce`` leaves
    out rows of a piece that change no result. ``_et`` becomes the newest time in the pack, also of rows left out. Spark leaves a pack
    out when all of it is late; late rows in others are left out by the processors.
    """
    time = rows.schema["_et"]
    kind = T.StructType([T.StructField("_bucket", rows.schema["_bucket"].dataType), time, T.StructField("rows", T.BinaryType())])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        parts, n = [], 0
        for batch in batches:
            parts.append(batch)
            n += batch.nbytes
            if n >= processors.PACKED:
                yield pa.Table.from_batches(parts).combine_chunks()
                parts, n = [], 0
        if parts:
            yield pa.Table.from_batches(parts).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            if not piece.num_rows:
                continue
            ends = piece.select(["_bucket", "_et"]).group_by("_bucket").aggregate([("_et", "max")])
            ends = dict(zip(ends["_bucket"].to_pylist(), ends["_et_max"].cast(pa.int64()).to_pylist(), strict=True))
            rest = reduce(piece) if reduce else piece
            # Rows of one time are alike, and alike rows are packed small.
            rest = rest.take(pc.sort_indices(rest, sort_keys=[("_bucket", "ascending"), ("_et", "ascending")]))
            runs = pc.run_end_encode(rest["_bucket"].combine_chunks())
            stops = runs.run_ends.to_pylist()
            body = rest.drop_columns(["_bucket", "_et"])
            packs = [processors.pack(body.slice(i, j - i)) for i, j in zip([0, *stops], stops, strict=False)]
            values = runs.values
            times = pa.array([ends[b] for b in values.to_pylist()], pa.int64()).cast(piece.schema.field("_et").type)
            yield pa.RecordBatch.from_arrays([values, times, pa.array(packs, pa.binary())], names=["_bucket", "_et", "rows"])

    out = rows.mapInArrow(run, kind)
    return out if has_watermark(out, "_et") else out.withWatermark("_et", delay)


def unpacked(packs: DataFrame, fields: list[T.StructField], et: str | None = None) -> DataFrame:
    """The rows of packs; their time, if named, carries the watermark that the packs have."""
    marked = [T.StructField(f.name, f.dataType, True, packs.schema["_et"].metadata if f.name == et else {}) for f in fields]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("rows"):
                yield from processors.unpack(data.as_py()).select(names).to_batches(processors.PIECE)

    return packs.mapInArrow(run, T.StructType(marked))


def over_buckets(packs: DataFrame, processor: StatefulProcessor) -> DataFrame:
    return packs.groupBy("_bucket").transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType="_et timestamp, rows binary",
        outputMode="append",
        timeMode="EventTime",
        eventTimeColumnName="_et",
    )


def netted(rows: DataFrame, keys: list[str], sign: str, count: str, buckets: int = 256) -> DataFrame:
    """What is left of corrected rows (a batch): each different row with the sum of its signs as ``count``, unless that is 0.

    What ``groupBy`` of all columns gives, dealt by keys in packs, which are half the size of rows.
    """
    names = [c for c in rows.columns if c != sign]
    signed = rows.withColumns({sign: F.col(sign).cast("bigint"), "_et": F.lit(0).cast("timestamp"), "_bucket": bucket_of(keys, buckets)})

    def added(table: pa.Table, by: list[str]) -> pa.Table:
        return table.group_by(by, use_threads=False).aggregate([(sign, "sum")]).rename_columns([*by, sign])

    def left(packs: pa.Table) -> pa.Table:
        table = added(processors.joined([processors.unpack(data.as_py()) for data in packs["rows"]]), names)
        return table.filter(pc.not_equal(table[sign], 0)).rename_columns([*names, count])

    packs = packed(signed, "0 seconds", lambda piece: added(piece, [*names, "_bucket", "_et"]))
    kind = T.StructType([*[T.StructField(c, rows.schema[c].dataType) for c in names], T.StructField(count, T.LongType())])
    return packs.groupBy("_bucket").applyInArrow(left, kind)


def stream_first_seen(
    df: DataFrame, key: str, payload: dict, et: str, ttl: str, delay: str, buckets: int = 256
) -> DataFrame:
    """Without a watermark yet, only the first row of a key is sent from each piece of a partition: a hot key is no bucket's burden."""
    rows = df.filter(F.col(et).isNotNull()).select(
        F.col(key).alias("seen_key"),
        *[F.col(c).alias(name) for name, c in payload.items()],
        F.col(et).alias("et"),
        F.unix_millis(et).alias("et_ms"),
        F.col(et).alias("_et"),
    )
    order = ["et", *payload]
    fields = [T.StructField(c, rows.schema[c].dataType) for c in order]
    rows = rows.withColumn("_bucket", bucket_of(["seen_key"], buckets))
    # Before a watermark late rows are not told apart, and after it they may not hide others.
    first = None if has_watermark(df, et) else lambda piece: processors.first_rows(piece, ["seen_key"], order)
    packs = packed(rows, delay, first)
    return unpacked(over_buckets(packs, FirstSeen(list(payload), millis(ttl))), fields, "et")


def stream_fix_new_flag(logs: DataFrame, key: str, flag: str, et: str) -> DataFrame:
    """No watermark is involved: a record that comes late is judged like any other.

    Records that do not claim to be new pass by the state; only the first of each device in each
    Arrow batch is shown to it.
    """
    claims = F.coalesce(F.col(flag) == "1", F.lit(False))
    others = logs.filter(~claims).select(*logs.columns, F.col(flag).alias("is_new"))
    seen = logs.filter(F.col(et).isNotNull()).select(
        F.col(key).alias("_mid"),
        F.col(et).alias("et"),
        day_of(et).alias("day"),
        F.when(claims, "1").otherwise("0").alias("flag"),
        # Whole records travel as JSON text: nested columns do not survive a trip through pandas.
        F.when(claims, F.to_json(F.struct(*logs.columns))).alias("row"),
    )

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            claiming = pdf["row"].notna()
            first = pdf[~claiming].sort_values("et", na_position="first").drop_duplicates("_mid")
            yield pd.concat([pdf[claiming], first])

    judged = (
        seen.mapInPandas(reduce, seen.schema)
        .groupBy("_mid")
        .transformWithState(
            statefulProcessor=FixNewFlag(),
            outputStructType="et timestamp, row string, is_new string",
            outputMode="append",
            timeMode="None",
        )
    )
    record = F.from_json("row", logs.drop(et).schema).alias("r")
    settled = judged.select("et", "is_new", record).select(
        *[F.col("et").alias(et) if c == et else F.col(f"r.{c}").alias(c) for c in logs.columns],
        "is_new",
    )
    return settled.unionByName(others)


def stream_offset_versions(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    measures: list[str],
    et: str,
    ttl: str,
    delay: str,
    buckets: int = 256,
    columns: list[str] | None = None,
) -> DataFrame:
    """``columns``, ``et`` among them, are what the result is to have: others are left behind in the state."""
    columns = columns or df.columns
    rows = df.filter(F.col(et).isNotNull()).withColumns({"et_ms": F.unix_millis(F.col(et)), "_et": F.col(et)})
    rows = rows.withColumn("_bucket", bucket_of(keys, buckets))
    undone = over_buckets(packed(rows, delay), OffsetVersions(keys, order, measures, et, millis(ttl), columns))
    return unpacked(undone, [df.schema[c] for c in columns], et)


def stream_latest_per_key(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    delay: str = "5 seconds",
    et: str | None = None,
    late: str = "0 seconds",
    buckets: int = 256,
) -> DataFrame:
    """One row per burst of versions: the latest, ``delay`` after the first of them.

    Without ``et`` the clock decides, so that reruns may cut bursts differently. With ``et`` a version is written once the
    watermark (``late`` behind the newest row) is ``delay`` past the first of its burst: the same rows from the same
    micro-batches, but none while no newer row of any key arrives. Rows without a time are then left out. As what is written is older than
    the watermark, the result has none: windows over it belong into a job that reads what this one wrote.
    """
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    if et is not None:
        rows = df.filter(F.col(et).isNotNull()).withColumns({"_at_ms": F.unix_millis(F.col(et)), "_et": F.col(et)})
        packs = packed(rows.withColumn("_bucket", bucket_of(keys, buckets)), late)
        held = packs.groupBy("_bucket").transformWithStateInPandas(
            statefulProcessor=LatestInBucket(keys, order, millis(delay)),
            outputStructType="rows binary",
            outputMode="append",
            timeMode="EventTime",
        )
        return unpacked(held, list(schema))
    return df.groupBy(*keys).transformWithState(
        statefulProcessor=LatestAfterDelay(df.columns, order, millis(delay)),
        outputStructType=schema,
        outputMode="append",
        timeMode="ProcessingTime",
    )


def stream_normalised(records: DataFrame, ttl: str | None) -> DataFrame:
    """``op``, ``value``, ``seq`` of keyed records; see :func:`streammart.sources.upserts.normalised`."""

    def newest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.sort_values("seq").drop_duplicates("key", keep="last")

    rows = records.select("key", "value", "seq")
    return (
        rows.mapInPandas(newest, rows.schema)
        .groupBy("key")
        .transformWithState(
            statefulProcessor=Normalise(millis(ttl) if ttl else None),
            outputStructType="op string, value string, seq bigint",
            outputMode="append",
            timeMode="ProcessingTime" if ttl else "None",
        )
    )


def first_seen_by_key(df: DataFrame, key: str, payload: dict, et: str = "et", ttl: str = "1 day") -> DataFrame:
    """The first row of each key, whose state Spark drops after ``ttl`` of processing time: one value a key.

    The event-time form, :func:`stream_first_seen`, gives the same rows on every run; this one forgets by the clock, as
    a running job's retention does, and its state grows key by key instead of being rewritten by the bucket.
    """
    rows = df.filter(F.col(et).isNotNull()).select(
        F.col(key).alias("seen_key"), *[F.col(c).alias(name) for name, c in payload.items()], F.col(et).alias("et")
    )
    fields = [T.StructField(c, rows.schema[c].dataType) for c in ["et", *payload]]
    return rows.groupBy("seen_key").transformWithState(
        statefulProcessor=FirstSeenByKey(list(payload), millis(ttl)),
        outputStructType=T.StructType(fields),
        outputMode="append",
        timeMode="ProcessingTime",
    )


def offset_versions_by_key(df: DataFrame, keys: list[str], order: list[str], measures: list[str], et: str = "et", ttl: str = "1 hour") -> DataFrame:
    """:func:`stream_offset_versions` with one value a key in the state, dropped by Spark after ``ttl`` of processing time."""
    rows = df.filter(F.col(et).isNotNull())
    return rows.groupBy(*keys).transformWithState(
        statefulProcessor=OffsetByKey(rows.columns, order, measures, millis(ttl)),
        outputStructType=T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema]),
        outputMode="append",
        timeMode="ProcessingTime",
    )


def stream_window_counts(
    df: DataFrame, key: str, count: str, width: str, et: str = "et", delay: str = "0 seconds", buckets: int = 256
) -> DataFrame:
    """``window``, the key and how many rows have them, once the watermark has passed the window's end.

    What :func:`streammart.operators.windows.tumble_agg` counts, for keys that are nearly as many as the rows, such as words:
    it holds a state row for each window and key, this one a packed table for each bucket of them.
    """
    rows = ensure_watermark(df, et, delay).filter(F.col(et).isNotNull())
    # Late is what falls into a closed window, so packs are dated by the ends of their windows.
    end = tumble(et, width)["end"].alias("_et", metadata=rows.schema[et].metadata)
    rows = rows.select(end, F.col(key).alias("key")).withColumn("_bucket", bucket_of(["_et", "key"], buckets))
    made = packed(rows, delay, processors.window_counts).groupBy("_bucket").transformWithStateInPandas(
        statefulProcessor=WindowCounts(),
        outputStructType="rows binary",
        outputMode="append",
        timeMode="EventTime",
    )
    fields = T.StructType([T.StructField("end_us", T.LongType()), T.StructField("key", rows.schema["key"].dataType), T.StructField("n", T.LongType())])
    window = tumble(F.timestamp_micros(F.col("end_us") - 1), width)
    return unpacked(made, list(fields)).select(window.alias("window"), F.col("key").alias(key), F.col("n").alias(count))


def stream_inner_join(
    left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], extra: list[str], bound: str, et: str, buckets: int, delay: str = "3 seconds"
) -> DataFrame:
    """Left columns and the ``extra`` ones of the right rows that have equal keys and times within ``bound``.

    Spark's join of two streams holds each row in a state row of its own; here a bucket of keys is one packed state row.
    A pair is up to ``bound`` behind the watermark, as its later row decides when it is made.
    """
    for lkey, rkey in pairs:
        if left.schema[lkey].dataType != right.schema[rkey].dataType:
            raise ValueError(f"{lkey} and {rkey} have different types")
    keys = [r for _, r in pairs]
    sides = [
        (left, [lkey for lkey, _ in pairs], [F.col(c) for c in left.columns if c != et], "_left"),
        (right, keys, [F.col(c).alias(f"_r_{c}") for c in dict.fromkeys([*keys, *extra])], "_right"),
    ]
    packs = []
    for rows, on, columns, at in sides:
        # NULL keys and rows without a time meet nothing.
        rows = rows.dropna(subset=[*on, et]).select(*columns, F.unix_micros(et).alias(at), F.col(et).alias("_et"), bucket_of(on, buckets).alias("_bucket"))
        packs.append(packed(rows, delay))
    names = [*left.columns, *extra]
    joiner = InnerJoin([(lkey, f"_r_{rkey}") for lkey, rkey in pairs], names, et, millis(bound) * 1000)
    made = over_buckets(packs[0].unionByName(packs[1]), joiner)
    return unpacked(made, [*[left.schema[c] for c in left.columns], *[right.schema[c] for c in extra]], et)


def stream_early_left_join(
    sides: list[DataFrame], keys: list[str], bound: str, et: str, delay: str, buckets: int = 256, behind: str = "0 seconds"
) -> DataFrame:
    """``sign``, ``ver``, the keys as ``k0``, ``k1`` and so on, and ``rows``: the left row and each side's match, where sides share ``keys``.

    A row is a struct of the left columns (``s0_`` and the name) and those that other sides add (``s1_`` and so on), without keys;
    only those of its side are set. Rows may be ``behind`` the watermark by that much.
    """
    names = [f"k{n}" for n in range(len(keys))]
    left = sides[0].columns
    cells = [(i, c, side.schema[c].dataType) for i, side in enumerate(sides) for c in side.columns if c not in keys and (i == 0 or c not in left)]

    def row(side: int):
        return F.struct(*[(F.col(c) if i == side else F.lit(None)).cast(kind).alias(f"s{i}_{c}") for i, c, kind in cells])

    parts = [
        side.filter(F.col(et).isNotNull()).select(
            *[F.col(k).alias(name) for name, k in zip(names, keys, strict=True)],
            F.lit(i).alias("side"),
            F.unix_millis(et).alias("at"),
            row(i).alias("row"),
            # Dated later by what they may be behind, so that Spark does not take their packs to be late.
            (F.col(et) + F.expr(f"interval {behind}")).alias("_et", metadata=side.schema[et].metadata),
        )
        for i, side in enumerate(sides)
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    made = packed(rows.withColumn("_bucket", bucket_of(names, buckets)), delay).groupBy("_bucket").transformWithStateInPandas(
        statefulProcessor=EarlyLeftJoin(names, len(sides) - 1, millis(bound), millis(behind)),
        outputStructType="rows binary",
        outputMode="append",
        timeMode="EventTime",
    )
    kind = T.StructType([T.StructField(f"s{i}_{c}", k) for i, c, k in cells])
    fields = [T.StructField("sign", T.IntegerType()), T.StructField("ver", T.LongType()), *[T.StructField(n, rows.schema[n].dataType) for n in names]]
    return unpacked(made, [*fields, T.StructField("rows", T.ArrayType(kind))])
