"""Byte-level BPE (operator 1): encoding and decoding over Arrow batches with the tokenizers library.

A rank file gives the vocabulary and the merges. Text is cut by the pattern, the UTF-8 bytes of each piece
are mapped to printable characters, and the library's BPE model merges them. Pieces that are tokens are looked up; of
the others a worker keeps those it saw lately, in a cache bounded by pieces and by characters. The ids of a piece are
kept as the bytes of its 32-bit numbers, so that those of a text are joined like bytes and become an Arrow array as they are.

Cases: a null text encodes as an empty one; an empty text has no ids; texts of any length are read whole;
ids that are null or outside the vocabulary raise an error in ``decode``; a null id list decodes as empty.
Other columns are carried along; an output column replaces an input column of the same name.
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StringType, StructField, StructType
from tokenizers import Tokenizer, models

Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

# A worker keeps two generations of pieces, each of at most so many pieces and characters; longer ones are not kept.
CACHE_PIECES, CACHE_CHARS, LONG_PIECE = 200_000, 4_000_000, 200


def byte_table() -> list[str]:
    """A printable character for each byte: itself where printable, else the next one from U+0100."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


class Codec:
    """The vocabulary of one rank file, with the library's BPE model over mapped bytes."""

    def __init__(self, ranks_path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}
        self.pattern = regex.compile(pattern)
        to_char = byte_table()
        self.mapping = "".join(to_char)
        # A pair may merge whenever its bytes are a token; the token's rank orders the merges.
        # A piece that is itself a token is taken whole.
        merges = [
            (self._mapped(token[:cut]), self._mapped(token[cut:]))
            for token in sorted(ranks, key=ranks.__getitem__)
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        vocab = {self._mapped(token): rank for token, rank in ranks.items()}
        self.model = Tokenizer(models.BPE(vocab=vocab, merges=merges, ignore_merges=True, cache_capacity=0))
        # Decoding turns the characters of a token back into bytes; each token's bytes are worked out once.
        byte_of = {c: b for b, c in enumerate(to_char)}
        self.tokens = {rank: bytes(byte_of[c] for c in text) for text, rank in vocab.items()}
        # By id, for whole columns; a number that is not an id has none.
        self.by_id = pa.array([self.tokens.get(i) for i in range(max(self.tokens, default=-1) + 1)], pa.binary())
        self.whole = {}
        for token, rank in ranks.items():
            try:
                self.whole[token.decode()] = np.int32(rank).tobytes()
            except UnicodeDecodeError:
                continue  # part of a character: never a piece
        self.cache, self.older, self.chars = dict(self.whole), {}, 0

    def _mapped(self, data: bytes) -> str:
        return data.decode("latin-1").translate(self.mapping)

    def merged(self, pieces: list[str]) -> list[bytes]:
        """The library's ids of each piece, all pieces sent as one sequence of words."""
        # Byte 255 occurs in no UTF-8 text.
        words = self._mapped(b"\xff".join([p.encode() for p in pieces])).split(self.mapping[255])
        coded = self.model.encode(words, is_pretokenized=True, add_special_tokens=False)
        ends = 4 * np.cumsum(np.bincount(np.array(coded.word_ids, np.int64), minlength=len(pieces)))
        ids = np.array(coded.ids, np.int32).tobytes()
        cuts = [0, *ends.tolist()]
        return [ids[i:j] for i, j in zip(cuts, cuts[1:])]

    def learn(self, pieces: set[str]) -> None:
        """Put these pieces into the cache; those that neither generation has go through the library."""
        missing = [p for p in pieces if p not in self.cache]
        if not missing:
            return
        size = sum(map(len, missing))
        if len(self.cache) - len(self.whole) + len(missing) > CACHE_PIECES or self.chars + size > CACHE_CHARS:
            self.older, self.cache, self.chars = self.cache, dict(self.whole), 0
            missing = [p for p in pieces if p not in self.cache]
            size = sum(map(len, missing))
        self.chars += size
        new = []
        for p in missing:
            ids = self.older.get(p)
            if ids is None:
                new.append(p)
            else:
                self.cache[p] = ids
        if new:
            self.cache.update(zip(new, self.merged(new)))

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as the bytes of their 32-bit numbers."""
        split = [self.pattern.findall(t) for t in texts]  # the pattern has no groups
        distinct = set(chain.from_iterable(split))
        self.learn(distinct)
        known = self.cache
        out = [b"".join(map(known.__getitem__, pieces)) for pieces in split]
        for p in distinct:
            if len(p) > LONG_PIECE:
                known.pop(p, None)
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [np.frombuffer(ids, np.int32).tolist() for ids in self.packed(texts)]

    def offsets(self, text: str, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Code points [start, end) that each token touches; a token with part of a character touches it."""
        ends = np.cumsum([len(self.tokens[i]) for i in ids], dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        data = np.frombuffer(text.encode(), np.uint8)
        char_of_byte = np.cumsum((data & 0xC0) != 0x80) - 1
        return char_of_byte[starts], char_of_byte[ends - 1] + 1

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode_column(self, ids: pa.Array) -> pa.Array:
        """The bytes of each id list of a column: the ids' bytes are looked up and joined in Arrow; null lists are empty."""
        flat, bounds = ids.flatten(), np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy())])
        parts = self.by_id.take(flat.cast(pa.int32()))
        if parts.null_count:
            raise KeyError("an id is null or outside the vocabulary")
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), parts), b"")


@functools.lru_cache(maxsize=2)
def codec(ranks_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, pattern)


def _lists(values: list, kind: pa.DataType) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.fromiter(chain.from_iterable(values), dtype=kind.to_pandas_dtype(), count=int(bounds[-1]))
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat, kind))


def _rows(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of batches of about ``most`` bytes in ``column``."""
    for batch in batches:
        sizes = batch.column(column).nbytes // max(1, batch.num_rows)
        step = max(1, min(512, most // max(1, sizes)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
    pa.default_memory_pool().release_unused()


def _encoding(ranks_path: str, pattern: str, names: list[str], offsets: bool = False) -> Work:
    """Batches with ``_bpe_text`` become the columns ``names`` and the ids, and with ``offsets`` their spans."""
    new = ["ids", "starts", "ends"] if offsets else ["ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(ranks_path, pattern)
        for batch in _rows(batches, "_bpe_text"):
            texts = batch.column("_bpe_text").to_pylist()
            packed = coder.packed(texts)
            bounds = np.concatenate([[0], np.cumsum([len(ids) // 4 for ids in packed])]).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(packed), np.int32))
            out = [batch.column(n) for n in names] + [pa.ListArray.from_arrays(pa.array(bounds), flat)]
            if offsets:
                spans = [coder.offsets(t, np.frombuffer(i, np.int32).tolist()) for t, i in zip(texts, packed)]
                out += [_lists([s[k] for s in spans], pa.int32()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(out, [*names, *new])

    return run


def _decoding(ranks_path: str, pattern: str, names: list[str], ids_col: str, as_text: bool) -> Work:
    """Batches with ``ids_col`` become the columns ``names`` and the bytes, and with ``as_text`` the text."""
    new = ["decoded_bytes", "decoded"] if as_text else ["decoded_bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(ranks_path, pattern)
        for batch in _rows(batches, ids_col):
            data = coder.decode_column(batch.column(ids_col))
            out = [*(batch.column(n) for n in names), data]
            if as_text:
                out.append(pa.array([d.decode("utf-8", "replace") for d in data.to_pylist()], pa.string()))
            yield pa.RecordBatch.from_arrays(out, [*names, *new])

    return run


def encode(
    df: DataFrame,
    ranks_path: str,
    pattern: str,
    text_col: str = "text",
    offsets: bool = False,
    keep_text: bool = True,
) -> DataFrame:
    """Add ``ids`` array<int>, and with ``offsets`` also ``starts`` and ``ends`` array<int>."""
    new = ["ids", "starts", "ends"] if offsets else ["ids"]
    keep = df.drop(*new).withColumn("_bpe_text", F.coalesce(F.col(text_col), F.lit("")))
    names = [c for c in keep.columns if c != "_bpe_text" and (keep_text or c != text_col)]
    schema = StructType([*keep.select(names).schema, *(StructField(n, ArrayType(IntegerType())) for n in new)])
    return keep.mapInArrow(_encoding(ranks_path, pattern, names, offsets), schema)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", as_text: bool = True) -> DataFrame:
    """Add ``decoded_bytes``, and with ``as_text`` the ``decoded`` text, in which cut characters become U+FFFD."""
    new = ["decoded_bytes", "decoded"] if as_text else ["decoded_bytes"]
    keep = df.drop(*new)
    kinds = [BinaryType(), StringType()]
    schema = StructType([*keep.schema, *(StructField(n, k) for n, k in zip(new, kinds))])
    return keep.mapInArrow(_decoding(ranks_path, pattern, keep.columns, ids_col, as_text), schema)


def multi_50k() -> tuple[str, str]:
    """The rank file and pattern of the registered query; both are parameters of the operator."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def round_trip(docs: DataFrame) -> DataFrame:
    """``ids`` and ``decoded_bytes`` in place of the text of ``docs``.

    One pass: a task holds the vocabulary in one worker. ``decode`` after ``encode`` takes two workers a task, and
    workers and their vocabularies outlive the stage.
    """
    ranks, pattern = multi_50k()
    keep = docs.drop("ids", "decoded_bytes").withColumn("_bpe_text", F.coalesce(F.col("text"), F.lit("")))
    names = [c for c in keep.columns if c not in ("_bpe_text", "text")]
    schema = StructType([*keep.select(names).schema, StructField("ids", ArrayType(IntegerType())), StructField("decoded_bytes", BinaryType())])
    coded, decoded = _encoding(ranks, pattern, names), _decoding(ranks, pattern, [*names, "ids"], "ids", as_text=False)
    return keep.mapInArrow(lambda batches: decoded(coded(batches)), schema)


def digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The contract's columns, from the ids and the decoded bytes."""
    done = round_trip(docs.select("doc_id", "text"))
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded_bytes", 256).alias("decoded_sha256"),
    )
