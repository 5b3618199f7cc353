"""Near-duplicates (operator 5): chosen-path set similarity join over word shingles, then connected components.

Documents with the same word sequence form one class. A class has its set of shingle hashes, 128 minwise tokens
of that set, and a 128-bit sketch with one bit of each token. In each of ``TREES`` independent trees a class
walks down: the hash of the path so far chooses one of the minwise tokens, and its value names the child node.
A node of at most ``LEAF`` classes is compared exhaustively and not branched further. In a larger node of the
first ``STARS`` levels all classes are compared with one pivot, which joins the large groups, and the node
branches. Then the classes
outside a large node's largest component are compared with ``PIVOTS`` more members of that component, and what is
still outside is compared with the whole node, if it is at most ``LEAF`` classes or the node is as deep as trees
go; else the node's children do it. Pairs that are already connected are not compared again,
and a pair that meets in several large nodes is made in one of them. A link at the threshold is missed by one tree of depth d with chance
1 - 0.85^d: 12 trees miss it with 2e-10 at depth 1, 2e-5 at depth 3 and 4e-3 at depth 6, and for links of
one large group only if no other path joins its members.

Candidates pass a size bound that loses nothing and a sketch bound five standard deviations below the threshold,
in large nodes also one of four deviations on a sketch of 512 bits; links are confirmed on the full sets. Shingles are compared by 64-bit hashes of their words.

Cases: documents without words, or with null text, have an empty set and link with nothing; texts shorter than a
shingle are one shingle; repeated rows each get their row, of the same class; a null doc_id never becomes a
component's id unless all its ids are null; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streammart.llm.common import slices, stored, unit_hash
from streammart.llm.components import components

WORDS = 5
PERCENT = 85
TOKENS = 128
FINE = 512
TREES = 12
DEPTH = 6
LEAF = 64
STARS = 3
PIVOTS = 16
WORD_CACHE = 500_000

_RANDOM = np.random.default_rng(20240517)
_MULTIPLY = _RANDOM.integers(0, 1 << 64, FINE, dtype=np.uint64) | np.uint64(1)
_ADD = _RANDOM.integers(0, 1 << 64, FINE, dtype=np.uint64)
_ROOTS = _RANDOM.integers(0, 1 << 64, TREES, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1342543DE82EF95)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit word hashes, kept for words seen before."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = value
        return value


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode().lower().split()


def shingles(tokens: list[bytes], hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``WORDS`` words, or of the whole sequence if it is shorter."""
    if not tokens:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    size = min(WORDS, len(own))
    state = np.full(len(own) - size + 1, size, np.uint64)
    for i in range(size):
        state = state * _BASE + own[i : len(own) - size + 1 + i]
    return np.unique(mixed(state))


def minwise(found: np.ndarray, size: int = TOKENS) -> np.ndarray:
    """For each of the first ``size`` hash functions the smallest value over the set."""
    least = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(found), 1024):
        part = found[start : start + 1024]
        for k in range(0, size, TOKENS):
            hashed = part[None, :] * _MULTIPLY[k : k + TOKENS, None] + _ADD[k : k + TOKENS, None]
            np.minimum(least[k : k + TOKENS], hashed.min(1), out=least[k : k + TOKENS])
    return least


def sketched(least: np.ndarray) -> np.ndarray:
    """One bit of each minwise value, packed into 64-bit numbers; a row for each row."""
    return np.packbits((mixed(least) >> np.uint64(63)).astype(np.uint8), axis=1).view(np.int64)


def paths(tokens: np.ndarray) -> np.ndarray:
    """Node ids [document, tree, level]; the path so far chooses which token branches."""
    rows = np.arange(len(tokens))[:, None]
    node = np.broadcast_to(_ROOTS, (len(tokens), TREES))
    out = np.empty((len(tokens), TREES, DEPTH), np.uint64)
    for level in range(DEPTH):
        choice = (mixed(node) >> np.uint64(57)).astype(np.int64)
        node = mixed(node * _ODD + mixed(tokens[rows, choice]))
        out[:, :, level] = node
    return out


def described(docs: DataFrame) -> DataFrame:
    """For each row: doc_id, row_id, n, key of the word sequence, tid of the text, sketch (s0, s1), trees of node ids."""
    node_lists = pa.list_(pa.list_(pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches):
            keys, tids, sizes, least = [], [], [], []
            for text in batch.column("text").to_pylist():
                tokens = words(text)
                found = shingles(tokens, hashes)
                sizes.append(len(found))
                keys.append(hashlib.blake2b(b" ".join(tokens), digest_size=16).digest() if tokens else None)
                tids.append(hashlib.md5(text.encode()).digest() if tokens else None)
                least.append(minwise(found))
            least = np.array(least)
            sketch = sketched(least)
            nodes = paths(least).view(np.int64)
            inner = pa.ListArray.from_arrays(np.arange(0, nodes.size + 1, DEPTH, dtype=np.int32), pa.array(nodes.ravel()))
            trees = pa.ListArray.from_arrays(np.arange(0, len(inner) + 1, TREES, dtype=np.int32), inner)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(tids, pa.binary()),
                    pa.array(sketch[:, 0]),
                    pa.array(sketch[:, 1]),
                    trees.cast(node_lists),
                ],
                ["doc_id", "row_id", "n", "key", "tid", "s0", "s1", "trees"],
            )

    docs = docs.select("doc_id", "row_id", "text")
    kind, row_kind = (docs.schema[c].dataType.simpleString() for c in ("doc_id", "row_id"))
    schema = f"doc_id {kind}, row_id {row_kind}, n long, key binary, tid binary, s0 long, s1 long, trees array<array<long>>"
    return docs.mapInArrow(run, schema)


def most_unequal(percent: int, size: int, deviations: float) -> int:
    """Unequal bits that a pair at the threshold exceeds only beyond so many standard deviations."""
    match = 0.5 + percent / 200
    return size - int(size * match - deviations * (size * match * (1 - match)) ** 0.5)


def likely(percent: int) -> Column:
    """Whether a pair of descriptions, prefixed a_ and b_, can reach the threshold (missed: under 1e-6)."""
    differ = F.bit_count(F.col("a_s0").bitwiseXOR(F.col("b_s0"))) + F.bit_count(F.col("a_s1").bitwiseXOR(F.col("b_s1")))
    small, large = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    return (differ <= most_unequal(percent, TOKENS, 5)) & (100 * small >= percent * large)


def likelier(percent: int) -> Column:
    """The same by the finer sketch (missed: under 1e-4 at the threshold itself)."""
    unequal = [F.bit_count(F.col("a_bits")[i].bitwiseXOR(F.col("b_bits")[i])) for i in range(FINE // 64)]
    return reduce(Column.__add__, unequal) <= most_unequal(percent, FINE, 4)


def _side(rows: DataFrame, prefix: str) -> DataFrame:
    names = [c for c in ("key", "n", "s0", "s1", "bits", "part", "top", "nodes") if c in rows.columns]
    return rows.select("node", *(F.col(c).alias(f"{prefix}_{c}") for c in names))


def _pairs(joined: DataFrame, percent: int) -> DataFrame:
    pairs = joined.filter(F.col("a_key") != F.col("b_key")).filter(likely(percent))
    return pairs.select(F.least("a_key", "b_key").alias("a"), F.greatest("a_key", "b_key").alias("b"))


def branch(classes: DataFrame, percent: int) -> tuple[list[DataFrame], list[DataFrame], list[DataFrame]]:
    """Candidate pairs of small nodes by level, of pivots by level, and the rows of the large nodes by level."""
    leaves, stars, large = [], [], []
    rows = classes.select("key", "n", "s0", "s1", F.posexplode("trees").alias("tree", "path"))
    for level in range(DEPTH):
        here = rows.withColumn("node", F.col("path")[level])
        sizes = here.groupBy("node").agg(F.count("*").alias("rows")).filter("rows > 1")
        here = here.join(sizes, "node")
        small = here.filter(F.col("rows") <= LEAF)
        both = _side(small, "a").join(_side(small, "b"), "node").filter("a_key < b_key")
        leaves.append(stored(_pairs(both, percent).distinct(), "pairs"))
        rows = stored(here.filter(F.col("rows") > LEAF).select("node", "key", "n", "s0", "s1", "tree", "path"), "nodes")
        if rows.isEmpty():
            break
        large.append(rows)
        if level < STARS:
            order = F.struct(F.xxhash64("node", "key").alias("h"), "key", "n", "s0", "s1")
            pivots = rows.groupBy("node").agg(F.min(order).alias("p")).select("node", "p.*").drop("h")
            stars.append(_pairs(_side(pivots, "a").join(_side(rows, "b"), "node"), percent))
        rows = rows.drop("node")
    return leaves, stars, large


def across(held: DataFrame, parts: DataFrame, percent: int, pivots: int | None) -> DataFrame:
    """Pairs of different components in large nodes: the classes outside a node's largest component, with others.

    ``held`` has a row for each class: key, n, s0, s1, bits, and ``at``, its large nodes with level and tree.
    With ``pivots``, the others are about that many members of the largest component, picked by a hash of their
    own, so that nodes of other trees and levels mostly pick the same ones. Without,
    they are the whole node; nodes with more such classes than a leaf holds are then left to their children,
    unless there are none, and the children of a node compared as a whole are left out, for they have no other
    pairs. Each pair is made in one of the nodes where it meets.
    """
    parts = parts.withColumnRenamed("node", "key")
    held = held.join(parts, "key", "left").withColumn("part", F.coalesce("label", "key")).drop("label")
    rows = held.select("key", "part", F.inline("at"))
    shares = rows.groupBy("node", "level", "part").agg(F.count("*").alias("rows"))
    most = shares.groupBy("node", "level").agg(F.sum("rows").alias("all"), F.max(F.struct("rows", "part")).alias("top"))
    top = (F.col("top.part").alias("top"), F.col("top.rows").alias("inside"), (F.col("all") - F.col("top.rows")).alias("outside"))
    few = (F.col("inside") > 1) if pivots else (F.col("level") == DEPTH - 1) | (F.col("outside") <= LEAF)
    most = most.select("node", "level", *top).filter((F.col("outside") > 0) & few).drop("level")
    rows, outer = stored(rows.join(most, "node"), "places"), F.col("part") != F.col("top")

    def side(chosen: DataFrame) -> DataFrame:
        """The chosen rows with all that pairs need; joined by class, and then spread over its nodes again."""
        places = chosen.groupBy("key").agg(F.collect_list(F.struct("node", "top")).alias("places"))
        classes = held.drop("at").join(places, "key")
        return classes.select("key", "n", "s0", "s1", "bits", "part", F.col("places.node").alias("nodes"), F.inline("places"))

    if pivots:
        share = unit_hash(F.col("key"), F.lit("pivot"))
        others, rest = side(rows.filter(~outer & (share * F.col("inside") < pivots))), side(rows.filter(outer))
    else:
        whole = F.min("level").over(Window.partitionBy("key", "tree"))
        others = side(rows.withColumn("whole", whole).filter("level = whole"))
        rest = others.filter(outer)
    joined = _side(others, "a").join(_side(rest.drop("top"), "b"), "node")
    joined = joined.filter("a_part != b_part and (a_part = a_top or a_key < b_key)").filter(likelier(percent))
    return _pairs(joined.filter("node = array_min(array_intersect(a_nodes, b_nodes))"), percent)


def apart(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component yet."""
    for end in ("a", "b"):
        pairs = pairs.join(parts.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label")), end, "left")
    differ = F.coalesce("a_label", "a") != F.coalesce("b_label", "b")
    return pairs.filter(differ).select("a", "b")


def item_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, items, bits: the full shingle sets of the ``wanted`` classes (key, tid), and their finer sketches."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches):
            found = [shingles(words(t), hashes) for t in batch.column("text").to_pylist()]
            bits = list(sketched(np.array([minwise(f, FINE) for f in found])))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in ([f.view(np.int64) for f in found], bits)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *lists], ["key", "items", "bits"])

    texts = docs.select(F.unhex(F.md5(F.col("text").cast("binary"))).alias("tid"), "text").join(wanted, "tid")
    items = texts.select("key", "text").dropDuplicates(["key"]).mapInArrow(sets, "key binary, items array<long>, bits array<long>")
    return stored(items, "sets")


def confirmed(pairs: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of class keys whose full shingle sets reach the threshold."""
    left = items.select(F.col("key").alias("a"), F.col("items").alias("a_items"))
    right = items.select(F.col("key").alias("b"), F.col("items").alias("b_items"))
    joined = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("a_items", "b_items"))
    joined = joined.select("a", "b", shared.alias("i"), (F.size("a_items") + F.size("b_items")).alias("s"))
    return stored(joined.filter(F.col("i") * 100 >= percent * (F.col("s") - F.col("i"))).select("a", "b"), "links")


def connected(docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(node, label) of all classes that have a link."""
    leaves, stars, large = branch(classes, percent)
    pairs = stored(union_of([leaves[0], *stars]).distinct(), "candidates")
    ends = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key")))
    # Nodes of deeper levels hold no other classes than the large nodes of the first.
    ends = union_of([ends, *(rows.select("key") for rows in large[:1])]).distinct()
    items = item_sets(docs, classes.select("key", "tid").join(ends, "key"))
    links = confirmed(pairs, items, percent)
    parts = components(links)
    if not large:
        return parts
    places = [rows.withColumn("place", F.struct(F.lit(i).alias("level"), "tree", "node")) for i, rows in enumerate(large)]
    held = union_of([rows.select("key", "n", "s0", "s1", "place") for rows in places])
    # At most one place of a class for each tree and level.
    held = held.groupBy("key", "n", "s0", "s1").agg(F.collect_list("place").alias("at"))
    held, tried = stored(held.join(items.select("key", "bits"), "key"), "held"), None
    for pivots in (PIVOTS, None):
        pairs = across(held, parts, percent, pivots)
        if pivots and leaves[1:]:
            pairs = pairs.union(apart(union_of(leaves[1:]), parts))
        pairs = pairs.distinct()
        tried = stored(pairs.join(tried, ["a", "b"], "left_anti") if tried else pairs, "candidates")
        more = confirmed(tried, items, percent)
        if not more.isEmpty():
            links = links.union(more)
            parts = components(links)
    return parts


def union_of(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out


def near_duplicate_rows(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """For each row of ``docs`` (doc_id, text, row_id): doc_id, row_id, n_shingles, component_id, kept.

    One row of a component is kept: that of the smallest doc_id, then row_id.
    """
    rows = stored(described(docs), "described")
    filled = rows.filter("key is not null")
    # Rows of one class agree on everything but their ids and tid, and any tid of the class will do.
    classes = stored(filled.drop("doc_id", "row_id").dropDuplicates(["key"]), "classes")
    parts = connected(docs, classes, percent)
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_id")
    members = filled.groupBy("key").agg(F.min(first).alias("first"))
    members = members.join(parts.withColumnRenamed("node", "key"), "key", "left")
    members = members.withColumn("label", F.coalesce("label", "key"))
    firsts = members.groupBy("label").agg(F.min("first").alias("keep"))
    found = members.join(firsts, "label").select("key", "keep")
    out = rows.select("doc_id", "row_id", "n", "key").join(found, "key", "left")
    alone = F.col("key").isNull()
    return out.select(
        "doc_id",
        "row_id",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("component_id"),
        (alone | (F.col("row_id") == F.col("keep.row_id"))).alias("kept"),
    )


def digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The contract's columns, in which every row of a component's smallest doc_id is kept."""
    found = near_duplicate_rows(docs.withColumn("row_id", F.lit(0).cast("long")))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))
