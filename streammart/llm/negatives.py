"""Hard-negative mining (operator 13) over Hilbert-ordered Parquet blocks with zone maps.

Rows are ordered along a Hilbert curve through the leading principal axes of a bounded sample and written as
Parquet blocks of ``BLOCK_ROWS`` rows, each with the minimum and maximum of every dimension: its zone map. Interval
arithmetic on a zone map bounds the inner products of an anchor with all rows of the block, and only blocks whose
bounds meet what an anchor looks for are joined with it: first the rows that may be among its positives, then those
that may fall into one of its score windows. Both searches begin with the anchor's home block, whose scores raise
the bar for all others. The bounds are sound, so the result is exact; the sample only shapes the order.

Work is dealt by (block, chunk of anchors), both of bounded size; what a pair of them finds are at most the few best
rows of an anchor. On data without structure the bounds exclude little, and the anchors, a stated query set, meet
every block.

Components become floor(256 * x), held in two, four or eight bytes; beyond the range of a long they saturate, and so
do scores. Vectors shorter than the longest are padded with zeros. Cases: rows with a null label, vector or component,
or a non-finite component, take no part, nor do rows without a vec_id, which no result could name; rows that repeat a
vec_id are rows of their own; ties go to the smaller vec_id; a positive with a negative score has an empty window;
anchors without positives or negatives give no rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streammart.llm.common import stored, table

SCALE = 256
ANCHOR_EVERY, MOVED_EVERY, LABELS = 100, 7, 10
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
BLOCK_ROWS, BLOCKS_PER_PART, BLOCKS_PER_CHUNK, BLOCKS_PER_PAGE = 2048, 16, 128, 256
SAMPLE_ROWS, AXES, AXIS_BITS = 2000, 6, 10
EXACT = float(1 << 53)  # whole numbers below this are exact as doubles
PLACES = 1 << 20  # a row's number is its block's times this, plus its place


# --- numbers -------------------------------------------------------------------------------------


def quantised(vectors: pa.Array, dims: int) -> np.ndarray:
    """floor(256 * x) of every component as int64, zero beyond a vector's own length."""
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64)
    sizes = np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    whole = np.clip(np.floor(SCALE * flat), -(2.0**63), 2.0**63 - 1024).astype(np.int64)
    if len(sizes) * dims == len(whole) and (sizes == dims).all():
        return whole.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = whole
    return out


def packed(matrix: np.ndarray) -> bytes:
    """The matrix in the narrowest of two, four and eight bytes a number."""
    most = max(abs(int(matrix.max())), abs(int(matrix.min()))) if matrix.size else 0
    kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
    return matrix.astype(kind).tobytes()


def unpacked(data: bytes, rows: int, dims: int) -> np.ndarray:
    width = len(data) // max(1, rows * dims)
    return np.frombuffer(data, {2: np.int16, 4: np.int32, 8: np.int64}.get(width, np.int16)).reshape(rows, dims)


def products(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where every sum is exact, else in whole numbers of any length."""
    if not rows.size or not anchors.size:
        return np.zeros((len(rows), len(anchors)), np.int64)
    most = float(np.abs(rows.astype(np.float64)).max()) * float(np.abs(anchors.astype(np.float64)).max()) * rows.shape[1]
    if most < EXACT:
        return (rows.astype(np.float64) @ anchors.astype(np.float64).T).astype(np.int64)
    whole = rows.astype(object) @ anchors.astype(object).T
    return np.clip(whole, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor (row) with anything in each zone (column)."""
    a, low, high = (m.astype(np.float64) for m in (anchors, low, high))
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    slack = 1e-9 * (np.abs(a) @ np.maximum(np.abs(low), np.abs(high)).T)  # rounding, where sums are not exact
    return up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers: reflections undone bit by bit, then a Gray code."""
    axes = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    first = axes[0]
    for bit in range(bits - 1, 0, -1):
        mask = (1 << bit) - 1
        for i, axis in enumerate(axes):
            set_here = (axis >> bit) & 1 == 1
            swap = np.where(set_here, 0, (first ^ axis) & mask)
            first = first ^ np.where(set_here, mask, swap)
            axes[i] = first if i == 0 else axis ^ swap
            axes[0] = first
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    flip = np.zeros_like(first)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((axes[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    place = np.zeros_like(first)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            place = (place << 1) | (((axis ^ flip) >> bit) & 1)
    return place


def axes_of(sample: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Centre, leading principal axes, and the range of the sample on each."""
    centre = sample.mean(0)
    turned = np.linalg.svd(sample - centre, full_matrices=False)[2][:AXES].T
    on = (sample - centre) @ turned
    return centre, turned, on.min(0), np.maximum(on.max(0), on.min(0) + 1e-9)


# --- blocks --------------------------------------------------------------------------------------


def prepared(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and vector of the rows that take part; every seventh id has its label moved on."""
    x = F.col("vector")
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    moved = F.when(F.col("vec_id") % MOVED_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("vector"))
    rows = rows.filter("vec_id is not null and label is not null and vector is not null").filter(finite)
    return rows.withColumn("label", moved)


def curved(rows: DataFrame, dims: int, fitted: tuple) -> DataFrame:
    """Add ``curve``, a row's place on the Hilbert curve."""
    centre, turned, low, high = fitted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            on = (quantised(batch.column("vector"), dims) - centre) @ turned
            cells = np.clip((on - low) / (high - low), 0, 1) * ((1 << AXIS_BITS) - 1)
            curve = hilbert(cells.astype(np.int64), AXIS_BITS)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(curve, pa.int64())], [*batch.schema.names, "curve"])

    return rows.mapInArrow(run, rows.select("*", F.lit(0).cast("long").alias("curve")).schema)


BLOCK = "part long, place long, n int, ids array<long>, labels array<long>, vectors binary, low array<long>, high array<long>, kinds array<long>"


def blocks_of(embeddings: DataFrame) -> tuple[DataFrame, int]:
    """The written blocks, numbered along the curve in ``seq``, and the number of dimensions."""
    spark = embeddings.sparkSession
    rows = prepared(embeddings)
    total, dims = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    picked = rows.orderBy(F.xxhash64("vec_id", "vector")).limit(SAMPLE_ROWS).select("vector").toArrow()
    sample = quantised(picked.column(0).combine_chunks(), dims) if total else np.zeros((1, max(1, dims)))
    rows = curved(rows, dims, axes_of(sample.astype(np.float64))) if total and dims else rows.withColumn("curve", F.lit(0).cast("long"))
    parts = max(1, -(-total // (BLOCK_ROWS * BLOCKS_PER_PART)))
    order = ["curve", "vec_id", "label", "spread"]
    spread = F.xxhash64("vector")
    ranges = rows.withColumn("spread", spread).repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def block(part: int, place: int, found: pa.Table) -> pa.RecordBatch:
        matrix = quantised(found.column("vector").combine_chunks(), dims)
        labels = found.column("label").to_numpy()
        values = [part, place, len(labels), found.column("vec_id").to_pylist(), labels.tolist(), packed(matrix)]
        zone = [matrix.min(0).tolist(), matrix.max(0).tolist(), np.unique(labels).tolist()]
        longs = pa.list_(pa.int64())
        kinds = [pa.int64(), pa.int64(), pa.int32(), longs, longs, pa.binary(), longs, longs, longs]
        names = "part place n ids labels vectors low high kinds".split()
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip([*values, *zone], kinds)], names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, held, n = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            while batch.num_rows:
                piece = batch.slice(0, BLOCK_ROWS - n)
                batch = batch.slice(piece.num_rows)
                held.append(piece)
                n += piece.num_rows
                if n == BLOCK_ROWS:
                    yield block(part, place, pa.Table.from_batches(held))
                    place, held, n = place + 1, [], 0
        if n:
            yield block(part, place, pa.Table.from_batches(held))

    found = stored(ranges.select("vec_id", "label", "vector").mapInArrow(cut, BLOCK), "blocks")
    # One count for each range goes to the driver.
    before, seen = [], 0
    for part, n in sorted(found.groupBy("part").count().collect()):
        before += [F.lit(part), F.lit(seen)]
        seen += n
    offset = F.create_map(*before)[F.col("part")] if before else F.lit(0)
    return found.withColumn("seq", (offset + F.col("place")).cast("long")).drop("part", "place"), dims


ANCHOR = "number long, home long, chunk long, anchor_id long, label long, vector binary"


def anchors_of(blocks: DataFrame, dims: int, every: int) -> DataFrame:
    """The rows whose id is divisible by ``every``, in chunks along the curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seq, n, ids, labels, vectors in zip(*(batch.column(c).to_pylist() for c in ("seq", "n", "ids", "labels", "vectors"))):
                at = np.flatnonzero(np.array(ids, np.int64) % every == 0)
                matrix = unpacked(vectors, n, dims)
                values = [
                    (seq * PLACES + at).tolist(),
                    [seq] * len(at),
                    [seq // BLOCKS_PER_CHUNK] * len(at),
                    [ids[i] for i in at],
                    [labels[i] for i in at],
                    [packed(matrix[i : i + 1]) for i in at],
                ]
                kinds = [pa.int64()] * 5 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], "number home chunk anchor_id label vector".split())

    return stored(blocks.select("seq", "n", "ids", "labels", "vectors").mapInArrow(run, ANCHOR), "anchors")


# --- which blocks an anchor must read ------------------------------------------------------------


def matrix_of(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    rows = [unpacked(v, 1, dims)[0] for v in column.to_pylist()]
    return np.array(rows, np.int64).reshape(len(rows), dims)


def chosen(anchors: DataFrame, blocks: DataFrame, dims: int, meets) -> DataFrame:
    """(seq, chunk, number): the blocks that each anchor must read, as ``meets`` decides from the bounds.

    Chunks of anchors meet pages of zone maps, so neither side is held whole anywhere.
    """
    pages = -(-blocks.count() // BLOCKS_PER_PAGE)
    chunks = [r[0] for r in anchors.select("chunk").distinct().collect()]  # one number for some 260,000 rows
    if not pages or not chunks:
        return anchors.select(F.col("home").alias("seq"), "chunk", "number").limit(0)
    page = F.floor(F.col("seq") / BLOCKS_PER_PAGE).cast("long")
    zones = blocks.select("seq", "low", "high", "kinds", page.alias("page"), F.explode(F.array(*(F.lit(c).cast("long") for c in chunks))).alias("chunk"))
    asking = anchors.withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pages - 1).cast("long"))))

    def run(zone: pa.Table, ask: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64)] * 3
        if zone.num_rows and ask.num_rows:
            low, high = (np.array(zone.column(c).to_pylist(), np.int64).reshape(zone.num_rows, dims) for c in ("low", "high"))
            least, most = bounds(matrix_of(ask.column("vector"), dims), low, high)
            a, z = np.nonzero(meets(ask, zone.column("kinds").to_pylist(), least, most))
            found = [zone.column("seq").to_numpy()[z], ask.column("chunk").to_numpy()[a], ask.column("number").to_numpy()[a]]
        return pa.table([pa.array(v, pa.int64()) for v in found], ["seq", "chunk", "number"])

    pairs = zones.groupBy("page", "chunk").cogroup(asking.groupBy("page", "chunk"))
    return pairs.applyInArrow(run, "seq long, chunk long, number long")


def has_label(labels: np.ndarray, kinds: list[list[int]], same: bool) -> np.ndarray:
    """Whether a block has a row of an anchor's label, or one of another label."""
    return np.array([[(label in own) if same else (len(own) > 1 or label not in own) for own in map(set, kinds)] for label in labels], bool)


def may_be_positive(ask: pa.Table, kinds: list[list[int]], least: np.ndarray, most: np.ndarray) -> np.ndarray:
    bar = np.array([-np.inf if b is None else float(b) for b in ask.column("bar").to_pylist()])
    return has_label(ask.column("label").to_numpy(), kinds, True) & (most >= bar[:, None])


def may_be_negative(ask: pa.Table, kinds: list[list[int]], least: np.ndarray, most: np.ndarray) -> np.ndarray:
    meets = np.zeros(least.shape, bool)
    for a, own in enumerate(ask.column("wanted").to_pylist()):
        for w in own:
            meets[a] |= (most[a] >= w["low"]) & (least[a] <= w["high"])
    return meets & has_label(ask.column("label").to_numpy(), kinds, False)


# --- reading them --------------------------------------------------------------------------------


def searched(pairs: DataFrame, blocks: DataFrame, dims: int, find, schema: str) -> DataFrame:
    """``find(block, anchor, scores)`` for each anchor of ``pairs`` (its columns with ``seq`` and ``chunk``) and block."""
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64()] * len(names)
    needed = pairs.groupBy(F.col("seq").alias("block"), F.col("chunk").alias("dealt")).count()
    read = blocks.select("seq", "n", "ids", "labels", "vectors").join(needed, F.col("seq") == F.col("block"))

    def run(block: pa.Table, ask: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if block.num_rows and ask.num_rows:
            n = block.column("n")[0].as_py()
            own = {c: np.array(block.column(c)[0].as_py(), np.int64) for c in ("ids", "labels")}
            own["numbers"] = block.column("seq")[0].as_py() * PLACES + np.arange(n)
            rows = unpacked(block.column("vectors")[0].as_py(), n, dims)
            for start in range(0, ask.num_rows, 256):
                some = ask.slice(start, 256)
                scores = products(rows, matrix_of(some.column("vector"), dims))
                for j, anchor in enumerate(some.drop_columns(["vector"]).to_pylist()):
                    out += find(own, anchor, scores[:, j])
        return pa.table([pa.array(v, k) for v, k in zip(zip(*out) if out else [[]] * len(names), kinds)], names)

    read = read.select(F.col("block").alias("seq"), F.col("dealt").alias("chunk"), "n", "ids", "labels", "vectors")
    return read.groupBy("seq", "chunk").cogroup(pairs.groupBy("seq", "chunk")).applyInArrow(run, schema)


def best(ids: np.ndarray, scores: np.ndarray, at: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` best of the rows ``at``: higher scores first, then smaller ids."""
    if len(at) > most:
        bar = np.partition(scores[at], len(at) - most)[len(at) - most]
        at = at[scores[at] >= bar]
    return at[np.lexsort((ids[at], -scores[at]))[:most]]


def first_rows(rows: DataFrame, keys: Sequence[str], most: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id")
    return rows.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= most)


def positives(anchors: DataFrame, blocks: DataFrame, dims: int, most: int) -> DataFrame:
    """number, id, score, rank: the best other rows of an anchor's label."""

    def find(block: dict, anchor: dict, scores: np.ndarray) -> list[tuple]:
        hit = (block["labels"] == anchor["label"]) & (block["numbers"] != anchor["number"])
        if anchor["bar"] is not None:
            hit &= scores >= anchor["bar"]
        return [(anchor["number"], int(block["ids"][i]), int(scores[i])) for i in best(block["ids"], scores, np.flatnonzero(hit), most)]

    schema = "number long, id long, score long"
    asking = anchors.withColumn("bar", F.lit(None).cast("long"))
    near = first_rows(searched(asking.withColumn("seq", F.col("home")), blocks, dims, find, schema), ["number"], most, "rank")
    bars = near.filter(F.col("rank") == most).select("number", F.col("score").alias("bar"))
    asking = stored(anchors.join(bars, "number", "left"), "asking")
    pairs = chosen(asking, blocks, dims, may_be_positive).join(asking.drop("chunk"), "number")
    return stored(first_rows(searched(pairs, blocks, dims, find, schema), ["number"], most, "rank"), "positives")


def window_of(score: Column, low: int, high: int) -> tuple[Column, Column]:
    """The least and greatest whole negative score n with low * score <= 100 * n <= high * score."""
    wide = score.cast("decimal(38,0)")
    return (-F.floor(-wide * low / 100)).cast("long"), F.floor(wide * high / 100).cast("long")


def negatives(anchors: DataFrame, found: DataFrame, blocks: DataFrame, dims: int, most: int, low: int, high: int) -> DataFrame:
    """number, place (the positive's rank), id, score, rank: the best rows of other labels in each positive's window."""

    def find(block: dict, anchor: dict, scores: np.ndarray) -> list[tuple]:
        at = np.flatnonzero(block["labels"] != anchor["label"])
        out = []
        for w in anchor["wanted"]:
            inside = at[(scores[at] >= w["low"]) & (scores[at] <= w["high"])]
            out += [(anchor["number"], w["place"], int(block["ids"][i]), int(scores[i])) for i in best(block["ids"], scores, inside, most)]
        return out

    schema = "number long, place long, id long, score long"
    least, greatest = window_of(F.col("score"), low, high)
    windows = found.select("number", F.col("rank").cast("long").alias("place"), least.alias("low"), greatest.alias("high")).filter("low <= high")
    gather = F.sort_array(F.collect_list(F.struct("place", "low", "high"))).alias("wanted")  # at most one a positive
    asking = stored(anchors.join(windows.groupBy("number").agg(gather), "number"), "asking")
    near = first_rows(searched(asking.withColumn("seq", F.col("home")), blocks, dims, find, schema), ["number", "place"], most, "rank")
    bars = near.filter(F.col("rank") == most).select("number", "place", F.col("score").alias("bar"))
    raised = windows.join(bars, ["number", "place"], "left").withColumn("low", F.greatest("low", "bar"))
    asking = stored(anchors.join(raised.groupBy("number").agg(gather), "number"), "raised")
    pairs = chosen(asking, blocks, dims, may_be_negative).join(asking.drop("chunk"), "number")
    return first_rows(searched(pairs, blocks, dims, find, schema), ["number", "place"], most, "rank")


def mined(
    embeddings: DataFrame,
    every: int = ANCHOR_EVERY,
    most_positives: int = POSITIVES,
    most_negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    blocks, dims = blocks_of(embeddings)
    anchors = anchors_of(blocks, dims, every)
    found = positives(anchors, blocks, dims, most_positives)
    rows = negatives(anchors, found, blocks, dims, most_negatives, low, high)
    pairs = found.select("number", F.col("rank").cast("long").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    rows = rows.join(pairs, ["number", "place"]).join(anchors.select("number", "anchor_id"), "number")
    return rows.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(table(spark, sf_dir, "embeddings"))
