"""Table sources (S7, S8): configuration over JDBC, dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streammart.functions import camel_name
from streammart.sources.sinks import UpsertTable


def read_table_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    camel: bool = False,
    **options: str,
) -> DataFrame:
    """Read a whole table. Give ``partitionColumn``, bounds and ``numPartitions`` for a large one."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if user:
        reader = reader.option("user", user).option("password", password or "")
    df = reader.options(**options).load()
    return df.toDF(*[camel_name(c) for c in df.columns]) if camel else df


def read_config_snapshot(
    spark: SparkSession,
    path: str | None = None,
    url: str | None = None,
    table: str | None = None,
    **options: str,
) -> DataFrame:
    """A whole routing table, from Parquet (``path``) or a database (``url`` and ``table``)."""
    if path:
        return spark.read.parquet(path)
    return read_table_jdbc(spark, url, table, **options)


def read_dim(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current rows of a dimension table; call it again to see newer ones."""
    return UpsertTable(spark, f"{root}/{name}").read()
