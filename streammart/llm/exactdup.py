"""Exact duplicates (operator 6) by content sort.

Texts lose their white space; sampled splitters range-partition them, an external sort inside each partition
places equal texts next to each other, and neighbours are compared in full. The sort key starts with the first
bytes and the digest of the normalised text, which bounds the size of a splitter, and ends with length and id,
so that a large group spreads over several partitions; runs that cross a boundary are stitched through a table
with one row for each partition. Of equal texts the row with the most code points, then the smallest id, stays.

Cases: null counts as empty, so null, empty and blank texts are one group; a null id sorts last; of fully
repeated rows exactly one stays; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streammart.llm.common import partitions_of, slices, stored

SPACE = b" \t\n\r\x0b\x0c"
LEAD = 32


def normalised(docs: DataFrame) -> DataFrame:
    """doc_id, row_id, n_chars of the original, and the normalised bytes with their lead and digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "row_id", "n_chars", "body", "lead", "digest"]
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            bodies = [t.encode().translate(None, SPACE) for t in texts]
            columns = [
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array(bodies, pa.binary()),
                pa.array([b[:LEAD] for b in bodies], pa.binary()),
                pa.array([hashlib.sha256(b).digest() for b in bodies], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_id"), *columns], names)

    kind, row_kind = (docs.schema[c].dataType.simpleString() for c in ("doc_id", "row_id"))
    schema = f"doc_id {kind}, row_id {row_kind}, n_chars long, body binary, lead binary, digest binary"
    return docs.select("doc_id", "row_id", "text").mapInArrow(run, schema)


def marked(ordered: DataFrame) -> DataFrame:
    """Compare neighbours of a sorted partition in full.

    ``what`` = row: a row with the number of its run and whether it opens it; run: a finished run of at least
    two rows, or the first or last of the partition, with its size and the id of its first row; edge: the
    partition's first and last body and its number of runs.
    """
    id_types = [ordered.schema[c].dataType.simpleString() for c in ("doc_id", "row_id")]
    names = ["what", "part", "run", "doc_id", "row_id", "digest", "opens", "size", "first", "last", "runs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        number, size, before, lead, first = -1, 0, None, None, None
        kinds = dict.fromkeys(names, pa.int64()) | {"what": pa.string(), "digest": pa.binary(), "opens": pa.bool_()}
        kinds |= {"first": pa.binary(), "last": pa.binary()}

        def out(rows: list[dict]) -> pa.RecordBatch:
            columns = [pa.array([r.get(n) for r in rows], kinds[n]) for n in names]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in slices(batches):
            kinds |= {c: batch.column(c).type for c in ("doc_id", "row_id")}
            rows = []
            for doc_id, row_id, body, digest in zip(
                *(batch.column(c).to_pylist() for c in ("doc_id", "row_id", "body", "digest"))
            ):
                opens = before is None or body != before
                if opens:
                    if size > 1 or number == 0:
                        rows.append({"what": "run", "part": part, "run": number, "doc_id": lead, "size": size})
                    number, size, lead, before = number + 1, 0, doc_id, body
                    first = body if first is None else first
                size += 1
                rows.append(
                    {"what": "row", "part": part, "run": number, "doc_id": doc_id, "row_id": row_id, "digest": digest, "opens": opens}
                )
            yield out(rows)
        if number >= 0:
            yield out(
                [
                    {"what": "run", "part": part, "run": number, "doc_id": lead, "size": size},
                    {"what": "edge", "part": part, "first": first, "last": before, "runs": number + 1},
                ]
            )

    schema = "what string, part long, run long, doc_id {}, row_id {}, digest binary, opens boolean, size long, first binary, last binary, runs long"
    return ordered.mapInArrow(run, schema.format(*id_types))


def stitched(edges: DataFrame) -> DataFrame:
    """(part, run = 0, to_part, to_run) of first runs that continue a run of an earlier partition.

    ``edges`` has one row for each partition, so the ordered windows run over as many rows as there are tasks.
    """
    order = Window.orderBy("part")
    near = edges.select("part", "runs", F.lag("part").over(order).alias("before"))
    first = edges.select("part", "first")
    last = edges.select(F.col("part").alias("before"), "last")
    joined = near.join(first, "part").join(last, "before", "left")
    joined = joined.select("part", "runs", F.coalesce(F.col("first") == F.col("last"), F.lit(False)).alias("continues"))
    whole = F.col("continues") & (F.col("runs") == 1)
    anchor = F.last(F.when(~whole, F.struct("part", "runs")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    joined = joined.withColumn("anchor", anchor).filter("continues")
    return joined.select("part", F.lit(0).cast("long").alias("run"), F.col("anchor.part").alias("to_part"), (F.col("anchor.runs") - 1).alias("to_run"))


def exact_groups(docs: DataFrame) -> DataFrame:
    """For each row of ``docs`` (doc_id, text, row_id): doc_id, row_id, keep_id, group_size, kept, digest."""
    order = [F.col("lead"), F.col("digest"), F.col("n_chars").desc(), F.col("doc_id").asc_nulls_last()]
    inside = [F.col("lead"), F.col("digest"), F.col("body"), *order[2:]]
    parted = normalised(docs).repartitionByRange(partitions_of(docs.sparkSession), *order)
    parts = stored(marked(parted.sortWithinPartitions(*inside)), "sorted")
    moves = stitched(parts.filter("what = 'edge'"))
    runs = parts.filter("what = 'run'").select("part", "run", F.col("doc_id").alias("lead"), "size").join(moves, ["part", "run"], "left")
    runs = runs.select("part", "run", "lead", "size", F.coalesce("to_part", "part").alias("to_part"), F.coalesce("to_run", "run").alias("to_run"))
    groups = runs.groupBy("to_part", "to_run").agg(
        F.sum("size").alias("group_size"), F.min_by(F.struct("lead"), "part").alias("keep")
    )
    known = runs.join(groups, ["to_part", "to_run"]).select(
        "part", "run", "group_size", "keep", (F.col("part") != F.col("to_part")).alias("moved")
    )
    rows = parts.filter("what = 'row'").select("doc_id", "row_id", "digest", "part", "run", "opens")
    out = rows.join(known, ["part", "run"], "left")
    alone = F.col("keep").isNull()
    return out.select(
        "doc_id",
        "row_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep.lead")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("opens") & ~F.coalesce("moved", F.lit(False))).alias("kept"),
        "digest",
    )


def digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    groups = exact_groups(docs.select("doc_id", "text", F.lit(0).cast("long").alias("row_id")))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
