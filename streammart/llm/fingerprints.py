"""Document fingerprints (operator 9) from prefix polynomial hashes.

The prefix array of a text holds, for each position, the polynomial hash of everything before it, modulo two
primes. Differences of prefix values answer the equality of any two spans, and longest common extensions are
found by binary search over them. A fingerprint is the length, a power-of-two grid step, the prefix hashes
at the at most 32 grid positions and the end, and the hashes of the spans of 16 code points whose hashes come
first in a fixed order: 64 different ones, or the root of the length if that is more. Two fingerprints are
compared on the coarser grid, extension by extension, for the share of the longer text in equal spans at equal
positions; and by their chosen spans, wherever they stand, for the estimated share of the different spans of the
text with more of them, at most the shorter length over the longer. Likeness is the larger of the two; that of
texts with fewer than 16 code points is from the grid alone.

Cases: null counts as empty; two empty texts are alike with 1, an empty and another with 0; a table of one row
has itself as the next document; rows with equal ids follow each other by a hash of their text; null ids come
last; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streammart.llm.common import bounded_sample, partitions_of, slices

PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
GRID = 32
SPAN, SPANS = 16, 64


class Powers:
    """Powers of the bases, extended by doubling; index i holds base**i."""

    def __init__(self, bases: tuple[int, ...] = BASES) -> None:
        self.bases = bases
        self.tables = [np.ones(1, np.uint64) for _ in PRIMES]

    def upto(self, n: int) -> list[np.ndarray]:
        while len(self.tables[0]) <= n:
            for k, (prime, base) in enumerate(zip(PRIMES, self.bases)):
                table = self.tables[k]
                factor = np.uint64(pow(base, len(table), prime))
                self.tables[k] = np.concatenate([table, table * factor % np.uint64(prime)])
        return self.tables


POWERS = Powers()
INVERSES = Powers(tuple(pow(base, -1, prime) for prime, base in zip(PRIMES, BASES)))


def ranked(hashes: np.ndarray) -> np.ndarray:
    """The order in which spans are chosen, from their hashes by the first prime; different hashes stay different."""
    turned = hashes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (turned ^ (turned >> np.uint64(32))) * np.uint64(0xD1342543DE82EF95)


def spans_of(n: int) -> int:
    """How many spans a text of n code points may choose."""
    return max(SPANS, math.isqrt(n))


class Prefixes:
    """Prefix hashes of a text: value[i] covers the code points before i."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = len(codes)
        tables = POWERS.upto(self.n)
        self.values = []
        for prime, table in zip(PRIMES, tables):
            # Terms stay below 2**31, so the running sum of 2**32 code points fits.
            sums = np.cumsum(codes * table[: self.n] % np.uint64(prime)) % np.uint64(prime)
            self.values.append(np.concatenate([np.zeros(1, np.uint64), sums]))

    def same(self, i: int, other: Prefixes, j: int, length: int) -> bool:
        """Whether the spans of ``length`` at i here and at j there are equal."""
        if i + length > self.n or j + length > other.n:
            return False
        tables = POWERS.upto(max(i, j))
        for k, prime in enumerate(PRIMES):
            own = (int(self.values[k][i + length]) - int(self.values[k][i])) % prime
            his = (int(other.values[k][j + length]) - int(other.values[k][j])) % prime
            if own * int(tables[k][j]) % prime != his * int(tables[k][i]) % prime:
                return False
        return True

    def extension(self, i: int, other: Prefixes, j: int) -> int:
        """Length of the longest common extension from i here and j there."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            middle = (low + high + 1) // 2
            if self.same(i, other, j, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def chosen(self) -> np.ndarray:
        """Hashes by both primes of the chosen spans, a row each, in their order; the same wherever a span stands."""
        count, most = self.n - SPAN + 1, spans_of(self.n)
        if count < 1:
            return np.zeros((0, 2), np.uint32)
        inverses = INVERSES.upto(count)

        def at(k: int, i: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
            prime = np.uint64(PRIMES[k])
            return (self.values[k][end] + prime - self.values[k][i]) * inverses[k][i] % prime

        rank = ranked(at(0, slice(0, count), slice(SPAN, None)))
        first, places = np.zeros(0), None
        if count > 4 * most:  # most texts have few spans twice: a small part of the order is enough
            places = np.flatnonzero(rank < np.uint64(2 * most * (1 << 64) // count))
            first = np.unique(rank[places], return_index=True)[1]
        if len(first) < most:
            places, first = np.arange(count), np.unique(rank, return_index=True)[1]
        places = places[first[:most]]
        return np.stack([at(k, places, places + SPAN) for k in range(2)], axis=1).astype(np.uint32)

    def fingerprint(self) -> str:
        step = 1
        while step * GRID < self.n:
            step *= 2
        at = [*range(step, self.n, step), self.n] if self.n else []
        a, b = self.values
        grid = "".join(f"{int(a[i]):08x}{int(b[i]):08x}" for i in at)
        return f"{self.n}:{step}:{grid}:" + self.chosen().astype(">u4").tobytes().hex()


def parsed(fingerprint: str) -> tuple[int, int, list[int]]:
    n, step, data = fingerprint.split(":")[:3]
    return int(n), int(step), [0, *(int(data[i : i + 16], 16) for i in range(0, len(data), 16))]


def likeness(one: str, two: str) -> float:
    """The larger of the shares that the grid and the chosen spans tell."""
    return 1.0 if one == two else max(in_place(one, two), anywhere(one, two))


def anywhere(one: str, two: str) -> float:
    """Share of equal spans, as far as both fingerprints reach in the order of spans, in that with more of them."""
    hashes, ranks, sizes, reach = [], [], [], None
    for fingerprint in (one, two):
        n, _, _, *data = fingerprint.split(":")
        found = np.frombuffer(bytes.fromhex("".join(data)), ">u4").reshape(-1, 2)
        if not len(found):
            return 0.0
        rank = ranked(found[:, 0])
        if len(rank) >= spans_of(int(n)):
            reach = rank[-1] if reach is None else min(reach, rank[-1])
        sizes.append(int(n))
        hashes.append(found.astype(np.uint64) @ np.array([1 << 32, 1], np.uint64))
        ranks.append(rank)
    own, his = (h if reach is None else h[r <= reach] for h, r in zip(hashes, ranks))
    share = len(np.intersect1d(own, his, assume_unique=True)) / max(len(own), len(his))
    return min(share, min(sizes) / max(sizes))


def in_place(one: str, two: str) -> float:
    """Share of the longer text in spans that are equal at equal positions, as far as the grid tells."""
    (n, step, own), (m, other_step, his) = parsed(one), parsed(two)
    if not n or not m:
        return 0.0
    wide = max(step, other_step)
    at = list(range(0, min(n, m), wide))
    left = [own[p // step] for p in at]
    right = [his[p // other_step] for p in at]
    if n == m:
        at.append(n)
        left.append(own[-1])
        right.append(his[-1])

    def gap(i: int) -> tuple[int, int]:
        """Difference of the prefixes; equal at two places if the span between is equal."""
        return (
            ((left[i] >> 32) - (right[i] >> 32)) % PRIMES[0],
            ((left[i] & 0xFFFFFFFF) - (right[i] & 0xFFFFFFFF)) % PRIMES[1],
        )

    gaps = [gap(i) for i in range(len(at))]
    equal, i = 0, 0
    while i < len(at) - 1:
        low, high = i, len(at) - 1
        while low < high:
            middle = (low + high + 1) // 2
            if gaps[middle] == gaps[i]:
                low = middle
            else:
                high = middle - 1
        equal += at[low] - at[i]
        i = max(low, i + 1) if low > i else i + 1
    return equal / max(n, m)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _order(not_null: bool, doc_id, code: int) -> tuple:
    return (not_null, doc_id if not_null else 0, code)


def neighbours(docs: DataFrame) -> DataFrame:
    """doc_id, text, bucket, ghost, in partitions where each row is followed by the next in descending doc_id.

    Splitters from a bounded sample cut the order into buckets. The first row of each bucket is repeated as a
    ghost at the end of the bucket before it, and that of the first bucket at the end of the last.
    Rows equal in id and text are sampled one by one, so that many of them make several splitters; they are dealt over all
    the buckets that these bound. Such a row is told from its equals by its place in the input, which a table keeps
    when a task is run again.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("code", F.xxhash64("text")).withColumn("named", F.col("doc_id").isNotNull())
    docs = docs.withColumn("place", F.xxhash64(F.monotonically_increasing_id()))
    count = 4 * partitions_of(spark)
    sample = bounded_sample(docs.select("named", "doc_id", "code", "place"), 32 * count, "doc_id", "code", "place").collect()
    keys = sorted(_order(r["named"], r["doc_id"], r["code"]) for r in sample)
    splitters = spark.sparkContext.broadcast(keys[:: max(1, len(keys) // count)][1:])

    @F.pandas_udf("int")
    def bucket_of(named: pd.Series, doc_id: pd.Series, code: pd.Series, place: pd.Series) -> pd.Series:
        cuts, out = splitters.value, []
        for *key, at in zip(named, doc_id, code, place):
            low = bisect.bisect_left(cuts, _order(*key))
            high = bisect.bisect_right(cuts, _order(*key), low)
            out.append(-(low + at % (high - low + 1)))
        return pd.Series(out, dtype="int32")

    plain = F.coalesce("doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType))
    docs = docs.withColumn("bucket", bucket_of("named", plain, "code", "place")).drop("place")
    heads = docs.groupBy("bucket").agg(F.max(F.struct("named", "doc_id", "code")).alias("head")).collect()  # a row a bucket
    if not heads:
        return docs.select("doc_id", "text", "bucket", F.lit(False).alias("ghost"))
    by_bucket = {r["bucket"]: r["head"] for r in heads}
    order = sorted(by_bucket)  # the first in descending order has the smallest number
    ghosts = [(order[i - 1], h["named"], h["doc_id"], h["code"]) for i, b in enumerate(order) for h in [by_bucket[b]]]
    kind = docs.schema["doc_id"].dataType.simpleString()
    ghosts = spark.createDataFrame(ghosts, f"into int, named boolean, head_id {kind}, head_code long")
    # One row a bucket, so its size is bounded by the number of partitions. Equal rows may head many buckets: their text is
    # looked up once.
    ghosts = ghosts.groupBy("head_id", "head_code").agg(F.collect_list("into").alias("into"))
    same = (F.col("code") == F.col("head_code")) & F.col("doc_id").eqNullSafe(F.col("head_id"))
    heads_text = docs.drop("bucket").join(F.broadcast(ghosts), same).dropDuplicates(["head_id", "head_code"])
    columns = ["doc_id", "text", "bucket", "code", "named", "ghost"]
    ghost_rows = heads_text.withColumn("bucket", F.explode("into")).withColumn("ghost", F.lit(True)).select(columns)
    rows = docs.withColumn("ghost", F.lit(False)).select(columns).union(ghost_rows)
    # By number, not by hash, so that partitions have as many buckets each.
    rows = rows.repartitionById(partitions_of(spark), F.pmod(-F.col("bucket"), F.lit(partitions_of(spark))).cast("int"))
    inside = ["bucket", "ghost", F.col("named").desc(), F.col("doc_id").desc_nulls_last(), F.col("code").desc()]
    return rows.sortWithinPartitions(*inside).select("doc_id", "text", "bucket", "ghost")


def compared(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprints of the text and its edited text, their likeness, and that to the next text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "common_edited"]
        held = None  # the row that waits for the next one: id, text, prefixes, fingerprint, bucket
        for batch in slices(batches):
            ids, rows = [], []
            for doc_id, text, bucket, ghost in zip(*(c.to_pylist() for c in batch.columns)):
                prefixes = Prefixes(text)
                own = prefixes.fingerprint()
                if held is not None and held[4] == bucket:
                    other = edited(held[1], text)
                    changed = Prefixes(other)
                    digest = hashlib.sha256(other.encode()).hexdigest()
                    mark = changed.fingerprint()
                    ids.append(held[0])
                    rows.append(
                        (len(held[1]), digest, held[3], mark, likeness(held[3], mark), likeness(held[3], own), held[2].extension(0, changed, 0))
                    )
                held = None if ghost else (doc_id, text, prefixes, own, bucket)
            if rows:
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
                columns = [pa.array(v, k) for v, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("doc_id").type), *columns], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_edited long"
    return neighbours(docs).mapInArrow(run, schema)


def digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return compared(docs)
