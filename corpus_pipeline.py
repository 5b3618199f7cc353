"""A training-data pipeline over ``documents``: each stage is written as Parquet and read again by the next.

toxicity -> exact duplicates -> near-duplicates -> mixture of sources -> byte-level BPE.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streammart.llm import bpe, exactdup, mixing, neardup, toxicity
from streammart.llm.common import free_name, stored, table


ROW = "_row_number"


# Word shingles of this similarity make near-duplicates of two documents in the stage, as in the operator's own query.
PERCENT = neardup.PERCENT


def numbered(docs: DataFrame, name: str = ROW) -> DataFrame:
    """Rows with a name, the digest of their file and their place in it: the same however a scan is cut into tasks.

    What is not a plain scan of files is written first. ``name`` is the new column, which must not be one of ``docs``.
    """
    if docs._jdf.queryExecution().analyzed().nodeName() != "LogicalRelation":
        docs = stored(docs, "numbered")
    at = docs.metadataColumn("_metadata")
    return docs.withColumn(name, F.unhex(F.md5(F.concat_ws("#", at["row_index"], at["file_path"]).cast("binary"))))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop rows that the classifier, learned from these rows' labels, holds to be toxic.

    A null text is scored as an empty one; without labels nothing is dropped; repeated rows fare alike.
    """
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of texts that are equal up to white space.

    The longest text stays, of equally long ones the smallest id (null last), of rows that repeat it one. Null texts are
    equal to empty ones. An empty table stays empty; columns of any names are kept.
    """
    name = free_name(docs.columns, ROW)
    rows = numbered(docs, name)
    kept = exactdup.exact_groups(rows.select("doc_id", "text", F.col(name).alias("row_id"))).filter("kept").select(F.col("row_id").alias(name))
    return rows.join(kept, name, "left_semi").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str, percent: int = PERCENT) -> DataFrame:
    """Keep one row of each component of documents whose shingle sets reach ``percent`` similarity.

    The smallest id stays (null last), of rows that repeat it one. Texts without words, or null, are linked with nothing and
    all stay. An empty table stays empty; columns of any names are kept.
    """
    name = free_name(docs.columns, ROW)
    rows = numbered(docs, name)
    found = neardup.near_duplicate_rows(rows.select("doc_id", "text", F.col(name).alias("row_id")), percent)
    kept = found.filter("kept").select(F.col("row_id").alias(name))
    return rows.join(kept, name, "left_semi").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat, keep or cut documents so that each source gives the words of its target.

    Texts without words, or null, are no part of a mix of words. A null source is a source. Rows with equal keys are
    ordered by id and text. An empty table stays empty; columns of any names are kept.
    """
    name = free_name(docs.columns, ROW)
    rows = numbered(docs, name)
    taken = mixing.mixed(rows, carry=[name])
    return mixing.repeated(rows, taken, name).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, the ids, and the digest of the text decoded from them."""
    done = bpe.round_trip(docs.select("doc_id", "source", "lang", "text"))
    return done.select(
        "doc_id", "source", "lang", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded_bytes", 256).alias("decoded_sha256")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_duplicates),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

# SQL cannot express the classifier, the components or the merges; tests compare with a plain computation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
