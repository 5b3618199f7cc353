"""Keyed topics with tombstones (K3, S2): records that replace or delete the row of their key.

A record is ``key`` and ``value``, both JSON text; a NULL value deletes the row. ``seq`` orders the records of a key: the
offset on a broker, where a key stays in one partition, or a number the writer gives in a file topic.
Reading turns such a log into rows that are added and taken back again, so that plain sums over it are sums
over the newest row of each key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from streammart.operators.state import latest_per_key
from streammart.sources.sinks import Trigger, start_stream, write_topic
from streammart.sources.topics import parse_json, read_topic

RECORD = "key string, value string, seq bigint"
# The change kinds of an add-and-retract log.
ADDED, BEFORE, AFTER, DELETED = "+I", "-U", "+U", "-D"


def read_keyed_topic(
    spark: SparkSession,
    topic: str,
    root: str | None = None,
    brokers: str | None = None,
    streaming: bool = False,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """``key``, ``value`` (NULL is a tombstone) and ``seq``."""
    if brokers is None:
        return read_topic(spark, topic, root=root, streaming=streaming, options=options).transform(parse_json(RECORD))
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    rows = (
        reader.option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("kafka.isolation.level", "read_committed")
        .options(**(options or {}))
        .load()
    )
    return rows.select(F.col("key").cast("string"), F.col("value").cast("string"), F.col("offset").alias("seq"))


def keyed_records(rows: DataFrame, keys: list[str], seq: str, deleted: Column | None = None, leave: tuple[str, ...] = ()) -> DataFrame:
    """``key``, ``value``, ``seq`` of rows; where ``deleted`` holds the value is a tombstone. ``leave`` is not part of it."""
    whole = F.to_json(F.struct(*[c for c in rows.columns if c not in (seq, *leave)]), {"ignoreNullFields": "false"})
    gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    return rows.select(key.alias("key"), F.when(~gone, whole).alias("value"), F.col(seq).cast("bigint").alias("seq"))


def retractions_as_records(rows: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The keyed records of an add-and-retract log (``op``): what takes back an old version needs no record."""
    return keyed_records(rows.filter(F.col("op") != BEFORE), keys, seq, F.col("op") == DELETED, ("op",))


def write_keyed_topic(
    records: DataFrame,
    topic: str,
    root: str | None = None,
    brokers: str | None = None,
    checkpoint: str | None = None,
    trigger: Trigger | None = None,
) -> StreamingQuery | None:
    """Append keyed records; tombstones too."""
    if brokers is None:
        line = F.to_json(F.struct("key", "value", "seq"), {"ignoreNullFields": "false"})
        return write_topic(records.select(line.alias("value")), topic, root=root, checkpoint=checkpoint, trigger=trigger)
    rows = records.select("key", "value")
    settings = {"kafka.bootstrap.servers": brokers, "topic": topic}
    if records.isStreaming:
        return start_stream(rows, checkpoint, trigger=trigger).format("kafka").options(**settings).start()
    rows.write.format("kafka").options(**settings).save()
    return None


def normalised(records: DataFrame, schema: str, ttl: str | None = None) -> DataFrame:
    """``op``, ``seq`` and the row's columns: every row as it is added, taken back, or deleted.

    A stream keeps the newest record of each key, for ever or for ``ttl`` of processing time; versions of a key that
    arrive in one micro-batch count as their last one, and records older than the newest seen are passed over. A
    batch adds the newest row of each key once. Records whose key or ``seq`` is NULL name no row and are left out.
    """
    named = records.filter("key is not null and seq is not null")
    if named.isStreaming:
        from streammart.streaming.keyed import stream_normalised

        changed = stream_normalised(named, ttl)
    else:
        newest = latest_per_key(named, ["key"], ["seq"], carry=["value", "seq"])
        changed = newest.filter("value is not null").select(F.lit(ADDED).alias("op"), "value", "seq")
    fields = T.StructType.fromDDL(schema).names
    row = F.from_json("value", schema).alias("_r")
    return changed.select("op", "seq", row).select("op", "seq", *[F.col(f"_r.{c}").alias(c) for c in fields])


def sign(op: Column | str = "op") -> Column:
    """1 for a row that is added, -1 for one that is taken back."""
    return F.when((F.col(op) if isinstance(op, str) else op).isin(ADDED, AFTER), F.lit(1)).otherwise(F.lit(-1))
