"""Topic sources (S1-S6): raw text, change log, facts, page log, routing changes.

A topic is read from a broker when ``brokers`` is given, otherwise from text files below
``root/<topic>``. The Kafka connector is a separate Spark package; without it only the file form
runs.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streammart import schemas
from streammart.functions import parsed_once
from streammart.operators.windows import with_event_time
from streammart.session import scratch_path, setting

# Files that a task has open at a time; a task that meets more tables sorts its remaining rows by table.
OPEN_TABLES = 32


def read_topic(
    spark: SparkSession,
    topics: str | list[str],
    root: str | None = None,
    brokers: str | None = None,
    streaming: bool = False,
    starting: str = "latest",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """One ``value STRING`` column; several topics are read together. NULL values survive."""
    names = [topics] if isinstance(topics, str) else list(topics)
    if brokers:
        reader = spark.readStream if streaming else spark.read
        # A batch read cannot start at the end of a topic.
        offsets = starting if streaming else "earliest"
        return (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", brokers)
            .option("subscribe", ",".join(names))
            .option("startingOffsets", offsets)
            .option("kafka.isolation.level", "read_committed")
            .options(**(options or {}))
            .load()
            .select(F.col("value").cast("string").alias("value"))
        )
    if root is None:
        raise ValueError("give brokers or root")
    # The glob keeps one file source for several topics, which streams require.
    path = f"{root}/{names[0]}" if len(names) == 1 else f"{root}/{{{','.join(names)}}}"
    reader = spark.readStream if streaming else spark.read
    return reader.options(**(options or {})).text(path).select("value")


def tagged_json(raw: DataFrame, schema: str, source: str = "records") -> DataFrame:
    """Typed columns and ``_bad``: the text of a record that does not fit the schema, otherwise NULL.

    A record is bad when it is no JSON object (an empty text included) or a field has another type; its typed columns
    are NULL. NULL values are tombstones, no records. How many records and bad ones went through is observed
    under the name ``diverted <source>``: a stream's progress reports it for each micro-batch.
    """
    ok = F.col("_r").isNotNull() & F.col("_r._bad").isNull()
    fields = T.StructType.fromDDL(schema).names
    rows = raw.filter(F.col("value").isNotNull()).select("value", parsed_once("value", schema).alias("_r"))
    rows = rows.select(*[F.when(ok, F.col(f"_r.{c}")).alias(c) for c in fields], F.when(~ok, F.col("value")).alias("_bad"))
    return rows.observe(f"diverted {source}", F.count(F.lit(1)).alias("records"), F.count("_bad").alias("bad"))


def diverted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, unreadable texts as ``value``) of rows that were parsed with ``keep_bad``."""
    return rows.filter("_bad is null").drop("_bad"), rows.filter("_bad is not null").select(F.col("_bad").alias("value"))


def parse_json(schema: str, keep_bad: bool = False, source: str = "records"):
    """``df.transform(parse_json(ddl))``: typed columns; rows that are not such JSON objects are dropped.

    With ``keep_bad`` they stay, as :func:`tagged_json` says, to be split off by :func:`diverted`.
    """

    def run(df: DataFrame) -> DataFrame:
        if keep_bad:
            return tagged_json(df, schema, source)
        return (
            df.select(parsed_once("value", schema).alias("_r"))
            .filter("_r is not null and _r._bad is null")
            .select("_r.*")
            .drop("_bad")
        )

    return run


def parse_changelog(raw: DataFrame, delay: str | None = "3 seconds", keep_bad: bool = False) -> DataFrame:
    """Change-log envelope plus ``et`` (its ``ts`` counts seconds)."""
    rows = raw.transform(parse_json(schemas.CHANGELOG, keep_bad, schemas.TOPIC_CHANGELOG))
    return with_event_time(rows, "ts", "s", delay)


def parse_page_log(raw: DataFrame, delay: str | None = "0 seconds", keep_bad: bool = False) -> DataFrame:
    """Page records plus ``et`` (their ``ts`` counts milliseconds)."""
    rows = raw.transform(parse_json(schemas.PAGE_LOG, keep_bad, schemas.LOG_OUTPUTS["page"]))
    return with_event_time(rows, "ts", "ms", delay)


def parse_fact(raw: DataFrame, name: str, delay: str | None = "3 seconds", keep_bad: bool = False) -> DataFrame:
    """A fact topic with ``et``; registrations carry their time as text."""
    rows = raw.transform(parse_json(schemas.FACT_SCHEMAS[name], keep_bad, name))
    if "ts" in rows.columns:
        unit = "ms" if name.startswith("dwd_traffic") else "s"
        return with_event_time(rows, "ts", unit, delay)
    return rows


def read_changelog(spark: SparkSession, delay: str | None = "3 seconds", keep_bad: bool = False, **source) -> DataFrame:
    source.setdefault("topics", schemas.TOPIC_CHANGELOG)
    return parse_changelog(read_topic(spark, **source), delay, keep_bad)


def write_split_changelog(changes: DataFrame, root: str, batch_id: int = 0, gather: bool = False) -> None:
    """Change rows as Parquet below ``table=`` and ``batch_id=``: one parse for all their readers.

    Writing a ``batch_id`` again replaces the tables it holds. Each task writes the tables it meets, without a shuffle
    or a sort of the log. ``gather`` is for the many small batches of a stream: their rows are brought together first,
    so that a table that makes up most of the log is cut into several files, small ones become one.
    """
    fields = T.StructType.fromDDL(schemas.CHANGELOG).names
    rows = changes.select(*fields, F.lit(batch_id).alias("batch_id"))
    with setting(changes.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_TABLES)):
        (
            (rows.hint("rebalance", "table") if gather else rows)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy("table", "batch_id")
            .parquet(root)
        )


def read_split_changelog(
    spark: SparkSession, root: str, delay: str | None = "3 seconds", streaming: bool = False
) -> DataFrame:
    """The change log as :func:`write_split_changelog` left it; a filter on ``table`` opens that table's folders only."""
    fields = T.StructType.fromDDL(schemas.CHANGELOG).names
    reader = spark.readStream if streaming else spark.read
    rows = reader.schema(f"{schemas.CHANGELOG}, batch_id bigint").parquet(root).select(*fields)
    return with_event_time(rows, "ts", "s", delay)


def read_page_log(spark: SparkSession, delay: str | None = "0 seconds", keep_bad: bool = False, **source) -> DataFrame:
    source.setdefault("topics", schemas.LOG_OUTPUTS["page"])
    return parse_page_log(read_topic(spark, **source), delay, keep_bad)


def read_fact(
    spark: SparkSession, name: str, delay: str | None = "3 seconds", keep_bad: bool = False, **source
) -> DataFrame:
    source.setdefault("topics", name)
    return parse_fact(read_topic(spark, **source), name, delay, keep_bad)


def parse_config_changes(raw: DataFrame, route: str = schemas.DIM_ROUTE, keep_bad: bool = False) -> DataFrame:
    """Routing-table changes: ``op``, ``ts_ms``, ``before``, ``after``."""
    return raw.transform(parse_json(schemas.config_change(route), keep_bad, "routes"))


def read_config_changes(
    spark: SparkSession,
    snapshot: DataFrame | None = None,
    route: str = schemas.DIM_ROUTE,
    as_of: int | None = None,
    handover: str | None = None,
    **source,
) -> DataFrame:
    """The full snapshot as ``r`` rows, followed by the changes read from a topic; a batch or one stream.

    ``as_of`` is the ``ts_ms`` up to which the snapshot already holds the changes: its rows carry that time, and changes
    up to it are left out. Without it the rows carry 0 and every change follows.

    For a stream the snapshot is a source of files in the folder ``handover`` beside the topic. It is written there once,
    by the first start; a restart finds it and goes on, so one folder belongs to one checkpoint. Without a name a
    fresh scratch folder is taken, and a restart would send the snapshot of that moment again.
    """
    changes = parse_config_changes(read_topic(spark, **source), route)
    if snapshot is None:
        return changes
    if as_of is not None:
        changes = changes.filter(F.col("ts_ms") > as_of)
    columns = changes.select("after.*").columns
    as_rows = snapshot.select(
        F.lit("r").alias("op"),
        F.lit(as_of or 0).cast("bigint").alias("ts_ms"),
        F.lit(None).cast(changes.schema["before"].dataType).alias("before"),
        F.struct(*columns).alias("after"),
    )
    if changes.isStreaming:
        folder = handover or scratch_path(spark, "handover")
        if not written_before(spark, folder):
            as_rows.write.mode("overwrite").parquet(folder)
        as_rows = spark.readStream.schema(as_rows.schema).parquet(folder)
    return as_rows.unionByName(changes)


def written_before(spark: SparkSession, folder: str) -> bool:
    """Whether a write into the folder has been completed."""
    try:
        return not spark.read.format("binaryFile").load(f"{folder}/_SUCCESS").isEmpty()
    except AnalysisException:
        return False


__all__ = [
    "diverted",
    "parse_changelog",
    "parse_config_changes",
    "parse_fact",
    "parse_json",
    "parse_page_log",
    "read_changelog",
    "read_config_changes",
    "read_fact",
    "read_page_log",
    "read_topic",
    "tagged_json",
]
