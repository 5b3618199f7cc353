"""The running jobs: streams wired to their tables.

Each function starts its queries and returns them. ``checkpoint`` is a folder of its own per job, on
the shared file system; restarting with the same folder continues where the job stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streammart import schemas
from streammart.operators.changelog import (
    apply_dim_changes,
    bounded_routes,
    clean_changelog,
    current_config,
    drop_bootstrap,
    route_dims,
    route_facts,
)
from streammart.operators.logs import split_log, tag_bad_records
from streammart.operators.state import with_fixed_flag
from streammart.operators.windows import with_event_time
from streammart.sources.sinks import (
    Trigger,
    UpsertTable,
    start_stream,
    to_json_rows,
    write_summary,
    write_topic_batch,
    write_upsert,
)
from streammart.sources.topics import diverted, write_split_changelog

ReadConfig = Callable[[], DataFrame]


def error_topic(topic: str) -> str:
    """Where the unreadable records of a topic go."""
    return f"{topic}_error"


@contextmanager
def keep_good(batch: DataFrame, topic: str, errors: str | None, batch_id: int) -> Iterator[DataFrame]:
    """The readable records of a micro-batch; the others are written to the topic's error topic below ``errors``.

    The micro-batch has ``_bad`` if its source was parsed with ``keep_bad``. It is cached, so that both outputs come from
    one parse. A replay replaces what it wrote.
    """
    if "_bad" not in batch.columns:
        yield batch
        return
    if errors is None:
        raise ValueError(f"{topic} keeps its unreadable records: name a folder for their topic")
    batch = batch.persist()
    try:
        good, bad = diverted(batch)
        write_topic_batch(bad, error_topic(topic), errors, batch_id)
        yield good
    finally:
        batch.unpersist()


def start_error_job(
    rows: DataFrame, topic: str, errors: str, checkpoint: str, trigger: Trigger | None = None
) -> StreamingQuery:
    """The unreadable records of a source (parsed with ``keep_bad``) to its error topic, beside jobs that read the others."""

    def save(batch: DataFrame, batch_id: int) -> None:
        with keep_good(batch, topic, errors, batch_id):
            pass

    return start_stream(rows.filter("_bad is not null").select("_bad"), checkpoint, save, trigger).start()


def start_log_job(
    raw: DataFrame, root: str, checkpoint: str, trigger: Trigger | None = None
) -> StreamingQuery:
    """Application log -> err, start, display, action, page and exception topics.

    Unreadable messages travel beside the records, and each micro-batch is cached, so that all six
    topics are written from one parse.
    """
    tagged = tag_bad_records(raw.filter(F.col("value").isNotNull()))
    bad = F.when(F.col("record").isNull(), F.col("value")).alias("bad")
    records = with_event_time(tagged.select("record.*", bad), "ts", "ms")
    fixed = with_fixed_flag(records).drop("et")

    def save(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            outputs = split_log(batch.filter("bad is null").drop("bad"))
            outputs = {name: to_json_rows(rows) for name, rows in outputs.items()}
            outputs["bad"] = batch.filter("bad is not null").select(F.col("bad").alias("value"))
            for name, rows in outputs.items():
                write_topic_batch(rows, schemas.LOG_OUTPUTS[name], root, batch_id)
        finally:
            batch.unpersist()

    return start_stream(fixed, checkpoint, save, trigger).start()


def start_dim_job(
    changes: DataFrame,
    read_config: ReadConfig,
    root: str,
    database: str,
    checkpoint: str,
    trigger: Trigger | None = None,
    buckets: int = 64,
    errors: str | None = None,
) -> StreamingQuery:
    """Change log -> dimension tables below ``root``, routed by the configuration of the moment.

    Unreadable records of a log read with ``keep_bad`` go to its error topic below ``errors``. A route that disappears is no longer written to; its table stays. New columns start as NULL.
    """
    spark = changes.sparkSession

    def save(batch: DataFrame, batch_id: int) -> None:
        with keep_good(batch, schemas.TOPIC_CHANGELOG, errors, batch_id) as rows:
            apply(rows, batch_id)

    def apply(batch: DataFrame, batch_id: int) -> None:
        # The routing table holds one row per dimension, and each dimension is a table to write.
        config = bounded_routes(read_config())
        if config is None:
            raise ValueError("too many dimension routes for one job: split the configuration over several")
        if not config:
            return
        routes = spark.createDataFrame(config, schemas.DIM_ROUTE)
        # Changes of one row come from one topic partition, in order; ts counts whole seconds.
        arrival = F.monotonically_increasing_id()
        routed = route_dims(clean_changelog(batch, database).withColumn("_n", arrival), routes, "_n")
        routed = routed.persist()
        try:
            # Routes into one dimension are applied together: a batch id is used once for each table.
            sinks: dict[str, dict[str, None]] = {}
            for route in config:
                sinks.setdefault(route["sink_table"], {}).update(dict.fromkeys(route["sink_columns"].split(",")))
            for name, wanted in sinks.items():
                columns = list(wanted)
                table = UpsertTable(spark, f"{root}/{name}", ["row_key"], buckets)

                def build(current: DataFrame | None, rows: DataFrame, columns=columns) -> DataFrame:
                    if current is not None:
                        missing = [c for c in columns if c not in current.columns]
                        current = current.withColumns(
                            {c: F.lit(None).cast("string") for c in missing}
                        )
                        # Columns that no route names any more keep their cells.
                        columns = [*columns, *(c for c in current.columns if c not in (*columns, "row_key"))]
                    return apply_dim_changes(current, rows, columns, ["ts", "_n"])

                rows = routed.filter(F.col("sink_table") == name)
                table.rewrite(rows, build, source=checkpoint, batch_id=batch_id)
        finally:
            routed.unpersist()

    return start_stream(changes.drop("et"), checkpoint, save, trigger).start()


def start_split_job(
    changes: DataFrame, root: str, checkpoint: str, trigger: Trigger | None = None, errors: str | None = None
) -> StreamingQuery:
    """Change log -> one folder per business table, to be read by :func:`streammart.sources.topics.read_split_changelog`.

    The log is parsed here once; jobs that want some tables open only those. A replay replaces what it wrote.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        with keep_good(batch, schemas.TOPIC_CHANGELOG, errors, batch_id) as rows:
            write_split_changelog(rows, root, batch_id, gather=True)

    return start_stream(changes.drop("et"), checkpoint, save, trigger).start()


def start_routed_fact_job(
    changes: DataFrame,
    read_config: ReadConfig,
    root: str,
    checkpoint: str,
    database: str | None = None,
    trigger: Trigger | None = None,
    errors: str | None = None,
) -> StreamingQuery:
    """Change log -> one topic per configured (table, type), unreadable records as in :func:`start_dim_job`."""

    def save(batch: DataFrame, batch_id: int) -> None:
        with keep_good(batch, schemas.TOPIC_CHANGELOG, errors, batch_id) as rows:
            route(rows, batch_id)

    def route(batch: DataFrame, batch_id: int) -> None:
        routed = route_facts(drop_bootstrap(batch), read_config(), database)
        rows = routed.select("sink_table", F.to_json("data").alias("value"))
        (
            rows.withColumn("batch_id", F.lit(batch_id))
            .hint("rebalance", "sink_table")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("sink_table", "batch_id")
            .text(root)
        )

    return start_stream(changes.drop("et"), checkpoint, save, trigger).start()


def start_fact_job(
    fact: DataFrame,
    root: str,
    key: str,
    checkpoint: str,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    trigger: Trigger | None = None,
    buckets: int = 64,
    part: str | None = None,
) -> StreamingQuery:
    """A fact stream -> its table, one row per ``key``.

    ``part`` names a column that is fixed for a key, usually ``date_id``: a micro-batch then rewrites
    buckets of the days it touches, not of the whole history.

    ``finish`` adds dictionary names to each micro-batch, reading the dictionary as it is then, e.g.
    ``lambda rows: name_payments(rows, read_dim(spark, dims, "dim_base_dic"))``.
    """
    return write_upsert(
        fact,
        root,
        [key],
        ["ts"],
        buckets=buckets,
        part=part,
        checkpoint=checkpoint,
        trigger=trigger,
        finish=finish,
    )


def start_summary_job(
    summary: DataFrame,
    root: str,
    checkpoint: str,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """A summary stream -> its table by day; ``finish`` adds dimension attributes."""
    return write_summary(summary, root, checkpoint, trigger, finish)


def config_reader(
    keys: list[str],
    snapshot: Callable[[], DataFrame | None],
    changes: Callable[[], DataFrame | None] = lambda: None,
) -> ReadConfig:
    """Routes in force whenever it is called: snapshot and changes are read anew."""
    return lambda: current_config(snapshot(), changes(), keys)
