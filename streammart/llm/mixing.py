"""Mixing sources to target weights (operator 10), with built-in functions only.

Sources in code point order, null last, weigh 5, 2, 1, repeating. They share the words of all documents by
weight; no target exceeds ``EPOCHS`` times its source, and the excess goes to the others by weight. Documents
get hash-random keys and are sorted by them inside their source; prefix sums of the word counts come from key
ranges (buckets), their offsets, and a running sum inside each range. A source gives each document once for every
full epoch of its target, and in one more pass the words up to the exact remainder: the document on the cut
gives its leading words.

Cases: null text has no words; documents without words take none; a null source is a source of its own; rows with
equal keys are ordered by id and text; fully repeated rows are interchangeable; an empty table gives an empty
result; targets are doubles, the words taken are cut at their whole part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streammart.llm.common import SPACES, free_name, partitions_of

WEIGHTS = (5, 2, 1)
EPOCHS = 3
ROWS_PER_BUCKET = 100_000
KEY_BITS = 60


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACES}]+")), F.lit(0)).cast("long")


def random_key(key: Column) -> Column:
    """A uniform 60-bit number from the key's text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("null")).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size, target: one row a source, so its ordered windows are small.

    Sources reach their cap in the order of cap over weight. With the k first ones capped, the others would get
    the rest by weight; the right k is the first whose level does not exceed the next ratio, and the levels of
    all later k are lower.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*map(F.lit, weights))
    place = (F.row_number().over(by_name) - 1) % len(weights)
    sizes = sizes.withColumn("weight", F.element_at(cycle, (place + 1).cast("int")).cast("long"))
    cap = epochs * F.col("source_size")
    ratio = cap / F.col("weight")
    by_ratio = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    later = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(earlier), F.lit(0))) / F.sum("weight").over(later)
    sizes = sizes.select("source", "source_size", "weight", cap.alias("cap"), ratio.alias("ratio"), level.alias("level"))
    final = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything)
    share = F.least(F.col("cap").cast("double"), F.col("weight") * final)
    return sizes.select("source", "source_size", F.coalesce(share, F.lit(0.0)).alias("target"))


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken, and the ``carry`` columns of each row."""
    rows = docs.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        random_key(F.col("doc_id")).alias("key"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("crc"),
        *carry,
    )
    buckets = max(4 * partitions_of(docs.sparkSession), docs.count() // ROWS_PER_BUCKET)
    # Ranges of a uniform key are known splitters: bucket numbers follow the order of the keys.
    bucket = F.floor(F.col("key").cast("double") / float(1 << KEY_BITS) * buckets).cast("long")
    rows = rows.withColumn("bucket", bucket)
    parts = rows.groupBy("source", "bucket").agg(F.sum("size").alias("size"))
    goals = targets(parts, weights, epochs)
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each source and bucket, with the words of the source's earlier buckets.
    offsets = parts.select("source", "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    offsets = offsets.withColumnRenamed("source", "name").join(
        goals.withColumnRenamed("source", "name2"), F.col("name").eqNullSafe(F.col("name2"))
    )
    offsets = offsets.drop("name2").withColumnRenamed("bucket", "range")
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "crc", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = (F.col("bucket") == F.col("range")) & F.col("source").eqNullSafe(F.col("name"))
    rows = rows.join(offsets, same)
    budget = F.floor("target").cast("long")
    full = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div source_size")).otherwise(F.lit(0))
    rest = budget - full * F.col("source_size") - F.col("offset") - F.col("within")
    taken = full * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return rows.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), *carry)


def repeated(docs: DataFrame, taken: DataFrame, row: str = "row_id") -> DataFrame:
    """The mixed rows of ``docs``, known by the column ``row``: each as often as taken, the last one perhaps cut to its first words.

    ``taken`` has that column, size and taken. Documents without words are not part of a mix of words.
    """
    names = [c for c in docs.columns if c != row]
    size, count, copy = (free_name(docs.columns, c) for c in ("size", "taken", "copy"))
    chosen = taken.filter("taken > 0").select(row, F.col("size").alias(size), F.col("taken").alias(count))
    rows = docs.join(chosen, row)
    copies = F.sequence(F.lit(1), F.ceil(F.col(count) / F.col(size)).cast("int"))
    rows = rows.withColumn(copy, F.explode(copies))
    words = F.least(size, F.col(count) - (F.col(copy) - 1) * F.col(size)).cast("int")
    lead = F.concat_ws("", F.slice(F.regexp_extract_all("text", F.lit(f"[{SPACES}]*[^{SPACES}]+"), 0), 1, words))
    cut = words < F.col(size)
    rows = rows.withColumn("text", F.when(cut, lead).otherwise(F.col("text")))
    if "n_chars" in names:
        rows = rows.withColumn("n_chars", F.when(cut, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return rows.select(names)


def digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return mixed(docs)
