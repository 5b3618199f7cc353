"""Global row numbers without sorting a table in one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streammart.llm.common import stored


def ranked(rows: DataFrame, order: Sequence[Column], number: str, rank: str = "rank") -> DataFrame:
    """``number`` and ``rank``: 1, 2, 3, ... in the given order; ``number`` tells rows apart and settles ties.

    The rows are range-partitioned by the order and sorted in their ranges; a row's rank is its place there
    behind the rows of all earlier ranges. What the driver sees is one count for each range.
    """

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            places = pa.array(range(at, at + batch.num_rows), pa.int64())
            at += batch.num_rows
            parts = pa.array([part] * batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), parts, places], ["number", "part", "place"])

    named = rows.select(F.col(number).cast("long").alias("number"), *[k.alias(f"k{i}") for i, k in enumerate(order)])
    by = [*[F.col(f"k{i}") for i in range(len(order))], F.col("number")]
    ranges = named.repartitionByRange(*by).sortWithinPartitions(*by)
    found = stored(ranges.select("number").mapInArrow(placed, "number long, part long, place long"), "ranked")
    before, total = {}, 0
    for part, n in sorted(found.groupBy("part").count().collect()):
        before[part], total = total, total + n
    if not before:
        return found.select(F.col("number").alias(number), F.col("place").alias(rank))
    offsets = F.create_map(*(F.lit(x) for pair in before.items() for x in pair))
    return found.select(F.col("number").alias(number), (F.col("place") + offsets[F.col("part")] + 1).alias(rank))
