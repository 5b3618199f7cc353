"""Benchmark decontamination (operator 11): one Aho-Corasick automaton over the normalised windows of all test texts.

Texts are normalised to their words, lower-cased in A-Z and joined by single spaces; a window is ``WINDOW``
consecutive words of a test text, or the whole text if it has fewer. The windows, each between two spaces, become
the patterns of one automaton, and each document is scanned once. Words inside any occurrence are hit; runs of hit
words are mapped back to code points of the original text.

The windows of all tests have a checked size: what fits into ``SHARD_BYTES`` is one automaton, shared with the
tasks; more are dealt by hash to several, and the documents, with what was found so far, are scanned by one after
the other, so that neither the driver nor a task holds more than one.

Words are runs of ASCII letters, digits and all characters beyond ASCII. Cases: null and empty texts, of documents
or tests, have no words, no window and no hit; texts of any length are scanned whole; a null item_id is named
``null``; tests that repeat an id count as one item, and tests that share a window are all found by it; repeated
documents each get their row; without tests nothing is hit; an empty table gives an empty result; carried columns
may have any names, an output column replaces one of the same name.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from streammart.llm.common import slices, stored, table
from streammart.llm.resampling import NORMAL

WINDOW = 10
SHARD_BYTES = 32 << 20
FOUND = ["n_words", "firsts", "lasts", "items"]


def windows(items: DataFrame, text_cols: Sequence[str], id_col: str, size: int) -> DataFrame:
    """``window`` and the sorted ``items`` (ids as text) that have it; a repeated window counts once for an item."""
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    texts = items.select(name.alias("item"), F.explode(F.array(*(F.col(c).cast("binary") for c in text_cols))).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = text.translate(NORMAL).split()
                found = {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(found), pa.string()), pa.array(list(found), pa.binary())], ["item", "window"])

    pieces = texts.filter("text is not null").mapInArrow(run, "item string, window binary")
    return pieces.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items"))


class Automaton:
    """Windows as patterns over Latin-1 text, that is bytes; a match gives the windows that end where it ends."""

    def __init__(self, patterns: list[tuple[bytes, list[str]]]):
        self.names, self.machine = [items for _, items in patterns], ahocorasick.Automaton()
        for i, (window, _) in enumerate(patterns):
            self.machine.add_word(f" {window.decode('latin-1')} ", (i, len(window)))
        if patterns:
            self.machine.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[int], list[int], set[str]]:
        """First and last word of each run of hit words, and the items found."""
        if not words or not self.names:
            return [], [], set()
        line = f" {b' '.join(words).decode('latin-1')} "
        ends, sizes, seen = [], [], set()
        for end, (pattern, size) in self.machine.iter(line):
            ends.append(end)
            sizes.append(size)
            seen.add(pattern)
        if not ends:
            return [], [], set()
        gaps = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
        last = np.searchsorted(gaps, ends) - 1  # a match ends on the space behind its last word
        first = np.searchsorted(gaps, np.array(ends) - np.array(sizes) - 1)
        turns = np.zeros(len(words) + 1, np.int64)
        np.add.at(turns, first, 1)
        np.add.at(turns, last + 1, -1)
        return *runs(np.cumsum(turns[:-1]) > 0), {name for i in seen for name in self.names[i]}


def runs(hit: np.ndarray) -> tuple[list[int], list[int]]:
    """First and last places of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return edge[::2].tolist(), (edge[1::2] - 1).tolist()


def code_points(text: bytes, firsts: list[int], lasts: list[int]) -> list[dict[str, int]]:
    """Code points [start, end) in the original text of runs of words."""
    if not firsts:
        return []
    data = np.frombuffer(text, np.uint8)
    inside = np.concatenate([[0], np.frombuffer(text.translate(NORMAL), np.uint8) != 32, [0]]).astype(np.int8)
    edge = np.flatnonzero(np.diff(inside))
    begins, ends = edge[::2], edge[1::2]
    passed = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return [{"start": int(passed[begins[a]]), "end": int(passed[ends[b]])} for a, b in zip(firsts, lasts)]


_built: dict[object, Automaton] = {}


def automaton(key: object, patterns) -> Automaton:
    """The automaton of a broadcast list, built once per worker; only the newest is kept."""
    if key not in _built:
        _built.clear()
        _built[key] = Automaton(patterns.value)
    return _built[key]


def scanned(docs: DataFrame, patterns: list[tuple[bytes, list[str]]], last: bool) -> DataFrame:
    """One pass over ``row``, ``text`` and what earlier passes found; the last one maps it to code points."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(patterns)
    key = uuid.uuid4().hex
    spans = StructType([StructField("start", LongType()), StructField("end", LongType())])
    kinds = [LongType(), ArrayType(LongType()), ArrayType(LongType()), ArrayType(StringType())]
    found = [StructField(n, k) for n, k in zip(FOUND, kinds)]
    if last:
        found = [StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("items", ArrayType(StringType())), StructField("spans", ArrayType(spans))]
    schema = StructType([docs.schema["row"], *([] if last else [docs.schema["text"]]), *found])
    more = "n_words" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(key, shared)
        for batch in slices(batches):
            out = {f.name: [] for f in found}
            for i, held in enumerate(batch.column("text")):
                text = held.as_buffer().to_pybytes()
                words = text.translate(NORMAL).split()
                firsts, lasts, items = machine.scan(words)
                if more:
                    items |= set(batch.column("items")[i].as_py())
                    turns = np.zeros(len(words) + 1, np.int64)
                    np.add.at(turns, [*firsts, *batch.column("firsts")[i].as_py()], 1)
                    np.add.at(turns, [n + 1 for n in (*lasts, *batch.column("lasts")[i].as_py())], -1)
                    firsts, lasts = runs(np.cumsum(turns[:-1]) > 0)
                out["n_words"].append(len(words))
                out["items"].append(sorted(items))
                if last:
                    out["n_hit"].append(sum(lasts) - sum(firsts) + len(lasts))
                    out["spans"].append(code_points(text, firsts, lasts))
                else:
                    out["firsts"].append(firsts)
                    out["lasts"].append(lasts)
            kept = [batch.column("row")] if last else [batch.column("row"), batch.column("text")]
            kind = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            types = {"n_words": pa.int64(), "n_hit": pa.int64(), "items": pa.list_(pa.string()), "spans": pa.list_(kind)}
            new = [pa.array(out[f.name], types.get(f.name, pa.list_(pa.int64()))) for f in found]
            yield pa.RecordBatch.from_arrays([*kept, *new], schema.names)

    return docs.mapInArrow(run, schema)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_text: Sequence[str] = ("text",),
    item_id: str = "item_id",
    window: int = WINDOW,
    carry: Sequence[str] | None = None,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The carried columns (all, unless named) with ``n_words``, ``n_hit``, ``items`` (sorted ids as text) and ``spans``.

    ``item_text`` names the columns of a test, such as its question and its answer, whose windows are sought.
    """
    carry = list(docs.columns if carry is None else carry)
    patterns = stored(windows(items, item_text, item_id, window), "windows")
    held = F.octet_length("window") + F.size("items") * 8 + F.aggregate("items", F.lit(0), lambda n, x: n + F.octet_length(x)) + 32
    total = patterns.agg(F.sum(held)).first()[0] or 0
    shards = -(-total // shard_bytes) or 1
    patterns = patterns.withColumn("shard", F.pmod(F.xxhash64("window"), F.lit(shards)))
    data = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(F.struct(*([F.col(c) for c in carry] or [F.lit(None).alias("none")])).alias("row"), data.alias("text"))
    for shard in range(shards):
        own = patterns.filter(F.col("shard") == shard).select("window", "items").toArrow()
        own = list(zip(own.column(0).to_pylist(), own.column(1).to_pylist()))
        rows = scanned(rows, own, last=shard == shards - 1)
        if shard < shards - 1:
            rows = stored(rows, "scanned")
    out = ["n_words", "n_hit", "items", "spans"]
    return rows.select(*[F.col("row")[c].alias(c) for c in carry if c not in out], *out)


def digests(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    """The contract's columns."""
    found = contaminated(docs, items, carry=["doc_id"])
    names = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    n = F.size("items").cast("long")
    return found.select("doc_id", "n_words", "n_hit", n.alias("n_items"), names.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
