"""Sinks (K1-K4, K6): append, routed, upsert and summary tables."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streammart.functions import snake_name
from streammart.operators.state import latest_per_key
from streammart.session import setting

Trigger = dict[str, object]
Finish = Callable[[DataFrame], DataFrame]

# Topics as files: change messages pack to a sixth. A compressed file is read by one task, so it holds at most so many rows.
TOPIC_FILES = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "500000"}


def to_json_rows(df: DataFrame, *keep: str) -> DataFrame:
    """Each row as one JSON object with snake_case names in ``value``; ``keep`` stays beside it."""
    fields = [F.col(c).alias(snake_name(c)) for c in df.columns if c not in keep]
    return df.select(*keep, F.to_json(F.struct(*fields)).alias("value"))


def start_stream(
    df: DataFrame,
    checkpoint: str,
    each: Callable[[DataFrame, int], None] | None = None,
    trigger: Trigger | None = None,
    mode: str = "append",
):
    """A configured stream writer; ``each`` gets every micro-batch with its id."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"processingTime": "5 seconds"}))
    return writer.foreachBatch(each) if each else writer


def write_topic(
    rows: DataFrame,
    topic: str,
    root: str | None = None,
    brokers: str | None = None,
    checkpoint: str | None = None,
    trigger: Trigger | None = None,
) -> StreamingQuery | None:
    """Append ``value`` rows to one topic.

    To files a stream is exactly-once through its checkpoint; to a broker it is at-least-once.
    """
    rows = rows.select("value")
    if rows.isStreaming:
        writer = start_stream(rows, checkpoint, trigger=trigger)
        if brokers:
            return (
                writer.format("kafka")
                .option("kafka.bootstrap.servers", brokers)
                .option("topic", topic)
                .start()
            )
        return writer.format("text").options(**TOPIC_FILES).option("path", f"{root}/{topic}").start()
    if brokers:
        rows.write.format("kafka").option("kafka.bootstrap.servers", brokers).option(
            "topic", topic
        ).save()
    else:
        rows.write.mode("append").options(**TOPIC_FILES).text(f"{root}/{topic}")
    return None


def write_topic_batch(rows: DataFrame, topic: str, root: str, batch_id: int) -> None:
    """The ``value`` rows of one micro-batch; a replay replaces what it wrote before."""
    rows.select("value").write.mode("overwrite").text(f"{root}/{topic}/batch_id={batch_id}")


def write_routed(
    rows: DataFrame,
    root: str | None = None,
    brokers: str | None = None,
    topic_col: str = "sink_table",
    checkpoint: str | None = None,
    trigger: Trigger | None = None,
) -> StreamingQuery | None:
    """Write ``value`` to the topic each row names: a broker topic or a ``sink_table=`` folder."""
    if brokers:
        rows = rows.select(F.col(topic_col).alias("topic"), "value")
    else:
        rows = rows.select(topic_col, "value")
    if rows.isStreaming:
        writer = start_stream(rows, checkpoint, trigger=trigger)
        if brokers:
            return writer.format("kafka").option("kafka.bootstrap.servers", brokers).start()
        return writer.format("text").partitionBy(topic_col).option("path", root).start()
    if brokers:
        rows.write.format("kafka").option("kafka.bootstrap.servers", brokers).save()
    else:
        # Rebalancing splits a destination that gets most rows and merges the small ones.
        rows.hint("rebalance", topic_col).write.mode("append").partitionBy(topic_col).text(root)
    return None


class UpsertTable:
    """Parquet rows, one per key, in partitions; a merge reads the partitions it touches and overwrites them.

    A table that grows with time should name a column a key never changes, such as the day of an order line, as
    ``part``: it is partitioned by it, and a merge leaves other days alone. Without it keys are dealt to ``buckets``
    partitions by hash.

    A merge is written beside the table first and then put in place by a dynamic partition overwrite. A driver that
    dies between the two leaves the merge whole beside the table, and the next merge puts it in place again. Each
    partition also holds one row per source, without columns, naming the last batch applied: a replay skips
    the partitions that have it. One writer per table; a reader that starts during the overwrite may miss partitions
    that are being replaced, so look-ups that need whole tables belong into the writer's own batch or after it.
    """

    PART, SOURCE, BATCH = "_part", "_source", "_batch"

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: list[str] | None = None,
        buckets: int = 64,
        part: str | None = None,
    ):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.buckets, self.part = keys, buckets, part
        self.rows, self.staged = f"{self.root}/rows", f"{self.root}/staged"

    def _path(self, path: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _there(self, path: str) -> bool:
        fs, path = self._path(path)
        return fs.exists(path)

    @staticmethod
    def _folder(part: object) -> str:
        """The partition of a value; two values may share one."""
        return "d-" + re.sub("[^A-Za-z0-9.-]", "_", "none" if part is None else str(part))

    def part_of(self) -> Column:
        if self.part is None:
            return F.concat(F.lit("b-"), F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("string"))
        value = F.coalesce(F.col(self.part).cast("string"), F.lit("none"))
        return F.concat(F.lit("d-"), F.regexp_replace(value, "[^A-Za-z0-9.-]", "_"))

    def _load(self, folders: list[str] | None = None) -> DataFrame | None:
        """Rows and batch marks of the given partitions, or of all; files older than a column answer NULL for it."""
        if not self._there(self.rows):
            return None
        paths = [self.rows]
        if folders is not None:
            paths = [p for p in (f"{self.rows}/{self.PART}={f}" for f in folders) if self._there(p)]
        if not paths:
            return None
        return self.spark.read.option("mergeSchema", "true").option("basePath", self.rows).parquet(*paths)

    def exists(self) -> bool:
        return self._there(self.rows)

    def read(self, parts: list[str] | None = None) -> DataFrame:
        """The current rows; of the given parts only, if the table has parts."""
        stored = self._load(None if parts is None else sorted(map(self._folder, parts)))
        rows = None if stored is None else stored.filter(F.col(self.BATCH).isNull())
        if rows is None or rows.isEmpty():
            raise FileNotFoundError(f"no rows have been merged into {self.root}")
        if parts is not None:
            rows = rows.filter(F.coalesce(F.col(self.part).cast("string"), F.lit("none")).isin(list(map(str, parts))))
        return rows.drop(self.PART, self.SOURCE, self.BATCH)

    def _put_in_place(self) -> None:
        """Overwrite the partitions that are written whole beside the table; nothing if there are none."""
        if not self._there(f"{self.staged}/_SUCCESS"):
            return
        (
            self.spark.read.parquet(self.staged)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.PART)
            .parquet(self.rows)
        )
        fs, path = self._path(self.staged)
        fs.delete(path, True)

    def rewrite(
        self,
        changes: DataFrame,
        build: Callable[[DataFrame | None, DataFrame], DataFrame],
        source: str = "batch",
        batch_id: int | None = None,
    ) -> bool:
        """Replace the touched partitions by ``build(their current rows, changes)``.

        A batch already applied for ``source`` is skipped, so replays after a restart change
        nothing. Returns whether anything was written.
        """
        self._put_in_place()
        changes = changes.withColumn(self.PART, self.part_of()).persist()
        try:
            # Days or buckets, not rows: what comes back is bounded by the partitions of the table.
            touched = [r[0] for r in changes.select(self.PART).distinct().collect()]
            stored = self._load(touched) if touched else None
            wanted = changes
            if stored is not None and batch_id is not None:
                seen = stored.filter((F.col(self.SOURCE) == source) & (F.col(self.BATCH) >= batch_id))
                done = [r[0] for r in seen.select(self.PART).distinct().collect()]
                touched = [p for p in touched if p not in set(done)]
                stored = stored.filter(~F.col(self.PART).isin(done))
                wanted = changes.filter(~F.col(self.PART).isin(done))
            if not touched:
                return False
            applied = F.lit(-1 if batch_id is None else batch_id).cast("bigint")
            marks = wanted.select(self.PART, F.lit(source).alias(self.SOURCE), applied.alias(self.BATCH))
            current = None
            if stored is not None:
                is_mark = F.col(self.BATCH).isNotNull()
                marks = marks.unionByName(stored.filter(is_mark).select(*marks.columns))
                current = stored.filter(~is_mark).drop(*marks.columns)
            marks = marks.groupBy(self.PART, self.SOURCE).agg(F.max(self.BATCH).alias(self.BATCH))
            built = build(current, wanted.drop(self.PART)).withColumn(self.PART, self.part_of())
            built = built.unionByName(marks, allowMissingColumns=True)
            built.hint("rebalance", self.PART).write.mode("overwrite").partitionBy(self.PART).parquet(self.staged)
            self._put_in_place()
        finally:
            changes.unpersist()
        return True

    def merge(
        self,
        changes: DataFrame,
        order: list[str],
        deleted: str | None = None,
        source: str = "batch",
        batch_id: int | None = None,
    ) -> bool:
        """Upsert: the last change of a key wins; ``deleted`` is a SQL predicate for tombstones."""

        def build(current: DataFrame | None, rows: DataFrame) -> DataFrame:
            newest = latest_per_key(rows, self.keys, order)
            kept = newest.filter(f"not coalesce({deleted}, false)") if deleted else newest
            if current is None:
                return kept
            untouched = current.join(newest.select(*self.keys), self.keys, "left_anti")
            return untouched.unionByName(kept, allowMissingColumns=True)

        return self.rewrite(changes, build, source, batch_id)


def write_upsert(
    changes: DataFrame,
    root: str,
    keys: list[str],
    order: list[str],
    deleted: str | None = None,
    buckets: int = 64,
    part: str | None = None,
    checkpoint: str | None = None,
    trigger: Trigger | None = None,
    finish: Finish | None = None,
) -> StreamingQuery | None:
    """Upsert a batch or a stream into an :class:`UpsertTable`.

    ``finish`` turns each micro-batch into the rows to write, e.g. a look-up in dimensions as they
    are at that moment.
    """
    table = UpsertTable(changes.sparkSession, root, keys, buckets, part)
    finish = finish or (lambda rows: rows)
    if not changes.isStreaming:
        table.merge(finish(changes), order, deleted)
        return None

    def each(batch: DataFrame, batch_id: int) -> None:
        table.merge(finish(batch), order, deleted, source=checkpoint, batch_id=batch_id)

    return start_stream(changes, checkpoint, each, trigger).start()


def write_summary(
    df: DataFrame,
    root: str,
    checkpoint: str | None = None,
    trigger: Trigger | None = None,
    finish: Finish | None = None,
    batch: str | None = None,
    gather: bool = True,
) -> StreamingQuery | None:
    """Summary rows as Parquet below ``cur_date=``, so that a day's query opens one folder.

    A replayed micro-batch of a checkpoint overwrites the folders it wrote the first time. Each batch write
    adds rows under an id of its own, or under ``batch``, where it replaces what was written under that id.
    Streams of different checkpoints do not meet either. ``gather`` brings the rows of a day together; without it each
    task writes a file for each day it meets, which suits rows of one day.
    """

    def save(rows: DataFrame, batch_id: str) -> None:
        rows = (finish(rows) if finish else rows).withColumn("batch_id", F.lit(batch_id))
        # A stream's session runs without adaptive execution, and the hint would go unheard.
        with setting(rows.sparkSession, "spark.sql.adaptive.enabled", "true"):
            (
                (rows.hint("rebalance", "cur_date") if gather else rows)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .option("compression", "zstd")
                .partitionBy("cur_date", "batch_id")
                .parquet(root)
            )

    if not df.isStreaming:
        save(df, f"batch-{batch or uuid.uuid4().hex}")
        return None
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    return start_stream(df, checkpoint, lambda rows, n: save(rows, f"{stream}-{n}"), trigger).start()


def read_summary(spark: SparkSession, root: str) -> DataFrame:
    """A summary table; ``cur_date`` is text."""
    rows = spark.read.parquet(root)
    return rows.withColumn("cur_date", F.col("cur_date").cast("string")).drop("batch_id")
