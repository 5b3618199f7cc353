"""Sharding (operator 7) by weighted rendezvous hashing, with built-in functions only.

Each shard bids -weight / ln(u) for a record, u a hash of the record's key and the shard; the highest bid wins.
A new shard can only win records for itself, and the rest stay where they are. Slots number a shard's records
without gaps: records fall into many small buckets by a hash, buckets get offsets from their counts, and only
records of one bucket and shard are sorted together.

Cases: null text has size 1 and the checksum of an empty text; records with a null key share one shard; repeated
rows share shard and bucket order but get slots of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streammart.llm.common import partitions_of, unit_hash

SHARDS = 8
ROWS_PER_BUCKET = 100_000


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Number of the winning shard; the lower one on equal bids."""
    bids = [
        F.struct(
            (F.lit(float(weight)) / -F.log(unit_hash(key.cast("string"), F.lit(shard)) + F.lit(2.0**-54))).alias("bid"),
            F.lit(-shard).alias("minus"),
        )
        for shard, weight in enumerate(weights)
    ]
    best = F.greatest(*bids) if len(bids) > 1 else bids[0]
    return (-best["minus"]).cast("int")


def with_slots(rows: DataFrame, shard: str, order: Sequence[str], buckets: int) -> DataFrame:
    """Add ``slot``: 0, 1, ... in each shard, by bucket and then by ``order``."""
    bucket = F.pmod(F.xxhash64(*order, F.lit("slot")), F.lit(buckets))
    rows = rows.withColumn("_bucket", bucket)
    counts = rows.groupBy(shard, "_bucket").agg(F.count("*").alias("_rows"))
    # One row for each shard and bucket.
    before = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard, "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(shard, "_bucket").orderBy(*order)
    numbered = rows.withColumn("_place", F.row_number().over(inside) - 1).join(offsets, [shard, "_bucket"])
    return numbered.withColumn("slot", (F.col("_offset") + F.col("_place")).cast("long")).drop("_bucket", "_offset", "_place")


def sharded(docs: DataFrame, shards: int = SHARDS, weights: Sequence[float] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (with one more shard of weight 1)."""
    weights = list(weights) if weights else [1.0] * shards
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(
        "doc_id", (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32")
    )
    total = docs.count()
    rows = rows.withColumn("shard", shard_of(F.col("doc_id"), weights))
    rows = rows.withColumn("grown_shard", shard_of(F.col("doc_id"), [*weights, 1.0]))
    buckets = max(4 * partitions_of(docs.sparkSession), total // ROWS_PER_BUCKET)
    rows = with_slots(rows, "shard", ["doc_id", "text_crc32", "size"], buckets)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return sharded(docs)
