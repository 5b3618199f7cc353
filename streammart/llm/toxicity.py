"""Toxicity (operator 8): a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A document's features are the hash slots of its character 1- to 4-grams, present or not. Slot ratios come from
counts over all labelled training rows, added up in the tasks. The classifier (logistic loss, adaptive steps)
is fitted on a sample of at most ``SAMPLE_ROWS`` labelled rows, its features scaled by the ratios.

Cases: null text scores as an empty one; an empty text scores the fitted bias; a null doc_id is neither held out
nor learned from; label rows with a null are dropped, and of several labels of one document the toxic one holds;
repeated rows each get their row, and rows that repeat an id are sampled by id and text; texts of any length are
read whole; with no labelled rows every score is 0; an empty table gives an empty result; other columns may have any
names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from streammart.llm.common import fold_of, free_name, in_one_task, ngram_slots, slices, stored, unit_hash

LOW, HIGH, BITS = 1, 4, 18
SAMPLE_ROWS = 5000
FOLDS, HELD_OUT = 5, 0
PASSES, STEP, RIDGE = 4, 0.1, 1e-6
NOTHING = -30.0  # the bias of a model that had nothing to learn from


def present(text: str | None) -> np.ndarray:
    """The distinct slots of a text, ascending."""
    seen = np.zeros(1 << BITS, bool)
    seen[ngram_slots(text or "", LOW, HIGH, BITS)] = True
    return np.flatnonzero(seen).astype(np.int32)


@dataclass
class Model:
    """Slot weights with the ratios multiplied in, so that a score is one sum over a text's slots."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        sums = np.array([self.weights[present(t)].sum() for t in texts]) + self.bias
        return 1 / (1 + np.exp(-np.clip(sums, -30, 30)))


def gathered(rows: DataFrame, sample_rate: float) -> DataFrame:
    """One pass over (doc_id, text, toxic, pick): slot counts by class for each task, and the sampled rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sizes = np.zeros((2, 1 << BITS), np.int64), [0, 0]
        names = ["slot", "clean", "toxic", "pick", "label", "slots"]

        def out(slot, clean, toxic, pick, label, slots):
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.binary()]
            values = [slot, clean, toxic, pick, label, slots]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

        for batch in slices(batches):
            texts, labels, picks = (batch.column(c).to_pylist() for c in ("text", "toxic", "pick"))
            sampled = []
            for text, label, pick in zip(texts, labels, picks):
                slots = present(text)
                counts[label, slots] += 1
                sizes[label] += 1
                if pick < sample_rate:
                    sampled.append((pick, label, slots.tobytes()))
            if sampled:
                n = len(sampled)
                yield out([None] * n, [None] * n, [None] * n, *map(list, zip(*sampled)))
        if sum(sizes):
            used = np.flatnonzero(counts.sum(0))
            n = len(used) + 1
            slot, clean, toxic = ([*used, -1], [*counts[0, used], sizes[0]], [*counts[1, used], sizes[1]])
            yield out(slot, clean, toxic, [None] * n, [None] * n, [None] * n)

    return rows.mapInArrow(run, "slot int, clean long, toxic long, pick double, label int, slots binary")


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on the labelled documents outside the held-out fold."""
    known = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id is not null and toxic in (0, 1)")
        .filter(fold_of(F.col("doc_id"), FOLDS) != HELD_OUT)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    texts = docs.select("doc_id", "text").filter(fold_of(F.col("doc_id"), FOLDS) != HELD_OUT)
    # One plan at every size: the texts are shuffled once, however few or many the labels are.
    rows = texts.join(known.hint("merge"), "doc_id").withColumn("pick", unit_hash(F.col("doc_id"), F.col("text"), F.lit("toxicity")))
    rate = 1.2 * (sample_rows + 50) / max(1, known.count())
    parts = stored(gathered(rows.select("text", "toxic", "pick"), rate), "toxicity")
    # At most one row a slot and one a sampled text: a table of fixed size.
    counts = parts.filter("slot is not null").groupBy("slot").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    sample = parts.filter("pick is not null").select("pick", "label", "slots").orderBy("pick", "slots").limit(sample_rows)

    def work(held: pa.Table) -> dict[str, list]:
        own = held.filter(pc.is_valid(held.column("slot"))).select(["slot", "clean", "toxic"]).to_pandas()
        rows = held.filter(pc.is_valid(held.column("pick"))).select(["pick", "label", "slots"])
        taken = sorted(zip(*(rows.column(c).to_pylist() for c in ("pick", "slots", "label"))))
        model = fit(own, [(np.frombuffer(slots, np.int32), label) for _, slots, label in taken])
        return {"weights": [model.weights.tobytes()], "bias": [model.bias]}

    found = in_one_task(counts.unionByName(sample, allowMissingColumns=True), work, "weights binary, bias double")
    if not found:
        return Model(np.zeros(1 << BITS), NOTHING)
    return Model(np.frombuffer(bytes(found[0]["weights"])), found[0]["bias"])


def fit(counts: pd.DataFrame, sample: list[tuple[np.ndarray, int]]) -> Model:
    width = 1 << BITS
    totals = counts[counts["slot"] < 0]
    if not len(totals) or not sample:
        return Model(np.zeros(width), NOTHING)
    own = counts[counts["slot"] >= 0]
    seen = np.ones((2, width))
    seen[0, own["slot"]] += own["clean"]
    seen[1, own["slot"]] += own["toxic"]
    clean, toxic = int(totals["clean"].iloc[0]), int(totals["toxic"].iloc[0])
    ratio = np.log(seen[1] / (toxic + 2)) - np.log(seen[0] / (clean + 2))
    weights, squares = np.zeros(width), np.full(width, 1e-8)
    bias, bias_squares = float(np.log((toxic + 1) / (clean + 1))), 1e-8
    order = np.random.default_rng(7)
    for _ in range(PASSES):
        for i in order.permutation(len(sample)):
            slots, label = sample[i]
            scaled = ratio[slots]
            error = 1 / (1 + np.exp(-np.clip(scaled @ weights[slots] + bias, -30, 30))) - label
            slope = error * scaled + RIDGE * weights[slots]
            squares[slots] += slope**2
            weights[slots] -= STEP * slope / np.sqrt(squares[slots])
            bias_squares += error**2
            bias -= STEP * error / np.sqrt(bias_squares)
    return Model(weights * ratio, bias)


def with_scores(docs: DataFrame, model: Model, text_col: str, score: str) -> DataFrame:
    """The rows with the score of their text. The broadcast model has a fixed size of 2 MB."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    names = docs.columns
    schema = StructType([*docs.schema, StructField(score, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = Model(*shared.value)
        for batch in slices(batches):
            scores = here.scores(batch.column(text_col).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*names, score])

    return docs.mapInArrow(run, schema)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    out = with_scores(docs.select("doc_id", "text"), model, "text", "score")
    held_out = F.coalesce(fold_of(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def predictions(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, train(docs, labels))


def keep_clean(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose score is below ``limit``."""
    score = free_name(docs.columns, "score")
    return with_scores(docs, model, "text", score).filter(F.col(score) < limit).select(docs.columns)
