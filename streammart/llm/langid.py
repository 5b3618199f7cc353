"""Language identification (operator 4): sparse multinomial logistic regression on TF-IDF character n-grams.

Character 1- to 4-grams are hashed into slots; a slot's document frequency is counted over all training
documents. Weights are learned by follow-the-regularised-leader with elastic-net penalties on a sample of at
most ``SAMPLE_ROWS`` training documents, spread evenly over the languages; a temperature fitted on a part of
the sample that the weights have not seen calibrates the probabilities.

Cases: null texts and texts without a letter get ``und`` with score 0; so does every text if nothing could be
learned; null languages are not learned from; texts of any length are read whole; rows that repeat an id are sampled by id
and text; other columns are not read; a null doc_id is neither held out nor learned from; repeated rows
each get their row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from streammart.llm.common import fold_of, ngram_slots, slices, stored, unit_hash

LOW, HIGH, BITS = 1, 4, 16
SAMPLE_ROWS = 3000
FOLDS, HELD_OUT = 3, 1
PASSES, ALPHA, BETA, L1, L2 = 3, 0.5, 1.0, 1e-3, 1e-3
UNKNOWN = "und"


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots and their counts."""
    counts = np.bincount(ngram_slots(text, LOW, HIGH, BITS), minlength=1 << BITS)
    slots = np.flatnonzero(counts)
    return slots.astype(np.int32), counts[slots].astype(np.float32)


def weighted(slots: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Damped term frequency times idf, of unit length."""
    values = (1 + np.log(counts)) * idf[slots]
    return values / max(1e-12, float(np.sqrt(values @ values)))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # slots + 1 rows, the last is the bias; one column a language
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        slots, counts = counted(text)
        score = weighted(slots, counts, self.idf) @ self.weights[slots] + self.weights[-1]
        chance = softmax(score / self.temperature)
        best = int(chance.argmax())
        return self.languages[best], float(chance[best])


def softmax(score: np.ndarray) -> np.ndarray:
    power = np.exp(score - score.max(-1, keepdims=True))
    return power / power.sum(-1, keepdims=True)


def follow_leader(rows: list[tuple[np.ndarray, np.ndarray, int]], width: int, classes: int) -> np.ndarray:
    """Per-coordinate follow-the-regularised-leader; most weights end as exact zeros through the L1 part."""
    lead, squares = np.zeros((width, classes)), np.zeros((width, classes))

    def current(at: np.ndarray) -> np.ndarray:
        z, n = lead[at], squares[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    order = np.random.default_rng(7)
    for _ in range(PASSES):
        for i in order.permutation(len(rows)):
            slots, values, label = rows[i]
            now = current(slots)
            error = softmax(values @ now)
            error[label] -= 1
            slope = values[:, None] * error
            grown = squares[slots] + slope**2
            lead[slots] += slope - (np.sqrt(grown) - np.sqrt(squares[slots])) / ALPHA * now
            squares[slots] = grown
    return current(np.arange(width))


def temperature_of(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by a narrowing search."""
    if not len(labels):
        return 1.0
    low, high = np.log(0.02), np.log(20.0)
    for _ in range(6):
        grid = np.linspace(low, high, 13)
        loss = [-np.log(softmax(scores / np.exp(t))[np.arange(len(labels)), labels] + 1e-300).mean() for t in grid]
        best, step = grid[int(np.argmin(loss))], grid[1] - grid[0]
        low, high = best - step, best + step
    return float(np.exp(best))


def gathered(rows: DataFrame) -> DataFrame:
    """One pass over (text, lang, pick, rate): document frequencies of each task, and the sampled rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, total = np.zeros(1 << BITS, np.int64), 0
        names = ["slot", "n", "pick", "lang", "slots", "counts"]
        kinds = [pa.int32(), pa.int64(), pa.float64(), pa.string(), pa.binary(), pa.binary()]

        def out(*values):
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

        for batch in slices(batches):
            sampled = []
            for text, lang, pick, rate in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "pick", "rate"))):
                slots, counts = counted(text)
                frequency[slots] += 1
                total += 1
                if pick < rate:
                    sampled.append((pick, lang, slots.tobytes(), counts.tobytes()))
            if sampled:
                yield out([None] * len(sampled), [None] * len(sampled), *map(list, zip(*sampled)))
        if total:
            used = np.flatnonzero(frequency)
            yield out([*used, -1], [*frequency[used], total], *[[None] * (len(used) + 1)] * 4)

    return rows.mapInArrow(run, "slot int, n long, pick double, lang string, slots binary, counts binary")


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from text and lang of the documents outside the held-out fold."""
    rows = docs.select("doc_id", "text", "lang").filter("text is not null and lang is not null")
    rows = rows.filter(fold_of(F.col("doc_id"), FOLDS) != HELD_OUT)
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    width = 1 << BITS
    if not languages:
        return Model([], np.zeros(width), np.zeros((width + 1, 0)), 1.0)
    share = 1.2 * (sample_rows + 50) / len(languages)
    rates = F.create_map(*(F.lit(x) for lang in languages for x in (lang, share / sizes[lang])))
    pick = unit_hash(F.col("doc_id"), F.col("text"), F.lit("language"))
    parts = stored(gathered(rows.select("text", "lang", pick.alias("pick"), rates[F.col("lang")].alias("rate"))), "langid")
    # At most one row a slot: a table of fixed size.
    frequency = parts.filter("slot is not null").groupBy("slot").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    # A pick is below its language's rate; over the rate, the cut to the sample's size takes of each language alike.
    turn = (F.col("pick") / rates[F.col("lang")]).alias("turn")
    sample = parts.filter("pick is not null").select(turn, "lang", "slots", "counts")
    sample = sample.orderBy("turn", "slots").limit(sample_rows).toArrow()
    total = int(frequency.loc[frequency["slot"] < 0, "n"].iloc[0])
    own = frequency[frequency["slot"] >= 0]
    seen = np.zeros(width)
    seen[own["slot"]] = own["n"]
    idf = np.log((1 + total) / (1 + seen)) + 1
    number = {lang: i for i, lang in enumerate(languages)}
    examples = []
    for lang, own_slots, own_counts in zip(sample.column("lang").to_pylist(), sample.column("slots"), sample.column("counts")):
        slots = np.frombuffer(own_slots.as_buffer(), np.int32)
        values = weighted(slots, np.frombuffer(own_counts.as_buffer(), np.float32), idf)
        examples.append((np.append(slots, width), np.append(values, 1.0), number[lang]))
    held = examples[::5] if len(examples) >= 50 else []
    weights = follow_leader([e for i, e in enumerate(examples) if not held or i % 5], width + 1, len(languages))
    scores = np.array([values @ weights[slots] for slots, values, _ in held])
    return Model(languages, idf, weights, temperature_of(scores, np.array([e[2] for e in held], int)))


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score. The broadcast model has a fixed size for each language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("doc_id", "text")
    schema = StructType([rows.schema["doc_id"], StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shared.value.predict(t) for t in batch.column("text").to_pylist()]
            values = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.string(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *values], schema.names)

    held_out = F.coalesce(fold_of(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return rows.mapInArrow(run, schema).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def predictions(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return predicted(docs, train(docs))
