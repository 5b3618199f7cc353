"""Importance resampling towards a target distribution (operator 12), over hashed n-grams.

Texts are normalised (A-Z lower-cased, separators collapsed to single spaces) and scanned once by an overlapped
regular expression: at each word boundary it emits the spans of the 1-, 2- and 3-word features that begin there.
A feature's bucket is its bytes' crc32 modulo ``BUCKETS``. Bucket counts over all documents and over all target
texts give each bucket a gain; a document's weight is the sum of the gains of its features; its score adds a
Gumbel draw that a hash of its id fixes, and the highest scores are drawn: sampling without replacement in
proportion to the exponential of the weights.

Words are runs of ASCII letters, digits and all characters beyond ASCII. Cases: a null or empty text has no
features and weight 0, and is never drawn; texts of any length are scanned whole, two bytes held for a feature; a
null doc_id is hashed as the text ``null`` and comes after all others among ties; rows that repeat an id tie and
are ordered by their place in the table; an empty table gives an empty result, an empty target counts as T = 0;
carried columns may have any names, an output column replaces one of the same name.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from streammart.llm.common import slices, stored, table
from streammart.llm.ranking import ranked

BUCKETS = 10_000
PERCENT, LEAST_WORDS, SEED = 5, 20, 42


def _normal_bytes() -> bytes:
    """A-Z to a-z, ASCII letters, digits and all bytes from 0x80 as they are, the rest to a space."""
    lower = bytes(range(256)).lower()
    return bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in lower)


NORMAL = _normal_bytes()
# At every word: the word, and the one and the two that follow it where they exist, each with its space.
GRAMS = regex.compile(rb"(?<![^ ])([^ ]++)(?:( [^ ]++)(?:( [^ ]++))?+)?+(?![^ ])")


def normalised(text: bytes) -> bytes:
    return b" ".join(text.translate(NORMAL).split())


def gram_buckets(text: bytes, buckets: int = BUCKETS) -> tuple[array, int]:
    """The bucket of each 1- to 3-word feature, repeats included, and the number of words."""
    found, words, crc = array("H"), 0, zlib.crc32
    add = found.append
    for match in GRAMS.finditer(normalised(text), overlapped=True):
        one, two, three = match.groups()
        words += 1
        code = crc(one)
        add(code % buckets)
        if two is not None:
            code = crc(two, code)
            add(code % buckets)
            if three is not None:
                add(crc(three, code) % buckets)
    return found, words


def featured(docs: DataFrame, text_col: str = "text", carry: Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """One scan: for each document ``row`` (its carried columns), ``n_words``, ``codes`` (two bytes a feature); for each task one row of bucket ``counts``."""
    data = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(F.struct(*([F.col(c) for c in carry] or [F.lit(None).alias("none")])).alias("row"), data.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, kind, fields = np.zeros(buckets, np.int64), None, ["row", "n_words", "codes", "counts"]
        for batch in slices(batches):
            kind = batch.column(0).type
            words, codes = [], []
            for text in batch.column(1):
                grams, n = gram_buckets(text.as_buffer().to_pybytes(), buckets)
                codes.append(grams.tobytes())
                words.append(n)
                counts += np.bincount(np.frombuffer(codes[-1], np.uint16), minlength=buckets)
            blank = pa.nulls(batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(codes, pa.binary()), blank], fields)
        if kind is not None:
            total = pa.array([counts.tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), total], fields)

    new = [StructField("n_words", LongType()), StructField("codes", BinaryType()), StructField("counts", BinaryType())]
    schema = StructType([StructField("row", rows.schema["row"].dataType), *new])
    return rows.mapInArrow(run, schema)


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket`` and its count ``n`` over all documents."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for counts in batch.column(0):
                total += np.frombuffer(counts.as_buffer(), np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    parts = features.filter("counts is not null").select("counts").mapInArrow(unpack, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(spark: SparkSession, source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket: a table of fixed size."""
    s, t = (counts.withColumnRenamed("n", name) for counts, name in ((source, "s"), (target, "t")))
    both = spark.range(buckets).withColumnRenamed("id", "bucket").join(s, "bucket", "left").join(t, "bucket", "left")
    held = both.select("bucket", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("s", "t"))).toArrow().to_pydict()
    all_s, all_t = float(sum(held["s"]) + buckets), float(sum(held["t"]) + buckets)
    found = np.zeros(buckets, np.int64)
    for bucket, s_here, t_here in zip(held["bucket"], held["s"], held["t"]):
        found[bucket] = math.floor(1000 * math.log((t_here + 1.0) * all_s / ((s_here + 1.0) * all_t)))
    return found


def gumbel(key: Column, seed: int = SEED) -> Column:
    """A Gumbel draw in thousandths, fixed by the key's text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def resampled(
    docs: DataFrame,
    target: DataFrame,
    carry: Sequence[str] | None = None,
    key: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Every document with its carried columns (all, unless named), ``n_features``, ``weight``, ``score`` and ``rank``.

    ``rank`` is null where the document was not drawn; ``filter("rank is not null")`` is the sample. The bucket of a
    feature takes 16 bits, so at most 65,536 buckets can be asked for.
    """
    spark = docs.sparkSession
    carry = list(docs.columns if carry is None else carry)
    features = stored(featured(docs, text_col, list(dict.fromkeys([*carry, key])), buckets), "grams")
    of_target = bucket_counts(featured(target, text_col, buckets=buckets), buckets)
    shared = spark.sparkContext.broadcast(gains(spark, bucket_counts(features, buckets), of_target, buckets))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            codes = [np.frombuffer(c.as_buffer(), np.uint16) for c in batch.column("codes")]
            columns = [
                batch.column("row"),
                batch.column("n_words"),
                pa.array([len(c) for c in codes], pa.int64()),
                pa.array([int(gain[c].sum()) for c in codes], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "n_words", "n_features", "weight"])

    rows = features.filter("counts is null").select("row", "n_words", "codes")
    schema = StructType([rows.schema["row"], *(StructField(c, LongType()) for c in ("n_words", "n_features", "weight"))])
    weighed = rows.mapInArrow(weigh, schema)
    score = F.col("weight") + gumbel(F.col("row")[key], seed)
    scored = stored(weighed.withColumns({"score": score, "number": F.monotonically_increasing_id()}), "scored")
    able = scored.filter(F.col("n_words") >= least_words)
    draws = able.count() * percent // 100
    order = [-F.col("score"), F.col("row")[key].isNull(), F.col("row")[key]]
    places = ranked(able, order, "number").filter(F.col("rank") <= draws)
    found = scored.join(places, "number", "left")
    out = ["n_features", "weight", "score", "rank"]
    return found.select(*[F.col("row")[c].alias(c) for c in carry if c not in out], *out)


def digests(spark: SparkSession, docs: DataFrame, target: DataFrame) -> DataFrame:
    """The contract's columns."""
    return resampled(docs, target, carry=["doc_id"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
