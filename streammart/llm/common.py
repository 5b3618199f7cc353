"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from streammart.session import scratch_path

SPACES = "\\x20\\x09-\\x0D"


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches in pieces of a few rows, so that Python objects of few texts exist at a time.

    At the end Arrow's pool gives back what it holds in reserve: workers outlive their tasks, beside the executor's heap.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    pa.default_memory_pool().release_unused()


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage where executors may be lost."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(names: Iterable[str], wish: str) -> str:
    """``wish``, made longer until no column has that name in any case."""
    taken = {n.lower() for n in names}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(key: Column, folds: int) -> Column:
    """crc32 of the key's text, modulo ``folds``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(folds)


def unit_hash(*keys: Column) -> Column:
    """A uniform number in [0, 1) from a hash of the keys."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 11).cast("double") / F.lit(float(1 << 53))


def bounded_sample(df: DataFrame, most: int, *keys: str) -> DataFrame:
    """About ``most`` rows, never more: those with the smallest hashes of the keys, thinned before they are sorted."""
    total = df.count()
    rate = min(1.0, 1.2 * (most + 50) / max(1, total))
    pick = unit_hash(*(F.col(k) for k in keys), F.lit("sample"))
    thinned = df.withColumn("_pick", pick).filter(F.col("_pick") < F.lit(rate))
    return thinned.orderBy("_pick", *keys).limit(most).drop("_pick")


def in_one_task(rows: DataFrame, work: Callable[[pa.Table], dict[str, list]], schema: str) -> list[Row]:
    """``work`` on all of a bounded table in one task; its few rows, given as columns, go to the driver."""
    kinds = rows.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            yield from pa.table(work(pa.Table.from_batches(held)), arrow).to_batches()

    return rows.coalesce(1).mapInArrow(run, kinds).collect()


def ngram_slots(text: str, low: int, high: int, bits: int) -> np.ndarray:
    """Hash slots of all character n-grams of ``low`` to ``high`` code points, repeats included."""
    chars = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    found, state = [], np.zeros(len(chars), np.uint32)
    for n in range(1, min(high, len(chars)) + 1):
        state = state[: len(chars) - n + 1] * np.uint32(0x01000193) + chars[n - 1 :] + np.uint32(n)
        if n >= low:
            mixed = (state ^ (state >> np.uint32(15))) * np.uint32(0x9E3779B1)
            found.append(mixed >> np.uint32(32 - bits))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
