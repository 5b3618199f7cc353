"""Snapshot and changes in one stream, diverted records, keyed topics, early joins, state that expires."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from conftest import collect
from streammart import schemas
from streammart.operators import joins, state
from streammart.plans import jobs
from streammart.sources import sinks, topics, upserts
from streammart.streaming import keyed
from test_jobs import NOW, run, topic  # noqa: F401
from test_operators import change, route

ROW = "id string, n int"


def save(spark, stream, path):
    """Run to the end with the checkpoint beside the output; all rows written so far."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-ck").trigger(**NOW).start()
    query.awaitTermination()
    return spark.read.parquet(path)


def test_the_snapshot_comes_once_and_changes_follow(spark, tmp_path, topic):  # noqa: F811
    conf = topic("routes")
    conf.put({"op": "c", "ts_ms": 5, "before": None, "after": route("old", "dim_old")})
    conf.put({"op": "c", "ts_ms": 15, "before": None, "after": route("new", "dim_new")})
    snapshot = spark.createDataFrame([tuple(route("brand", "dim_brand").values())], schemas.DIM_ROUTE)

    def go(rows):
        changes = topics.read_config_changes(
            spark, rows, as_of=10, handover=str(tmp_path / "handover"), topics="routes", root=str(tmp_path), streaming=True
        )
        out = save(spark, changes, str(tmp_path / "out"))
        return sorted((r.op, r.ts_ms, r.sink) for r in out.select("op", "ts_ms", F.col("after.sink_table").alias("sink")).collect())

    assert go(snapshot) == [("c", 15, "dim_new"), ("r", 10, "dim_brand")]
    # A restart goes on after the hand-over, whatever the table holds by now.
    conf.put({"op": "u", "ts_ms": 20, "before": route("new", "dim_new"), "after": route("new", "dim_newer")})
    assert go(snapshot.limit(0)) == [("c", 15, "dim_new"), ("r", 10, "dim_brand"), ("u", 20, "dim_newer")]


def test_a_snapshot_needs_no_folder_name(spark, tmp_path, topic):  # noqa: F811
    topic("routes").put({"op": "c", "ts_ms": 5, "before": None, "after": route("a", "dim_a")})
    snapshot = spark.createDataFrame([tuple(route("b", "dim_b").values())], schemas.DIM_ROUTE)
    changes = topics.read_config_changes(spark, snapshot, topics="routes", root=str(tmp_path), streaming=True)
    assert save(spark, changes, str(tmp_path / "out")).count() == 2


def test_bad_records_are_kept_counted_and_written_apart(spark, tmp_path, topic):  # noqa: F811
    log = topic("topic_db")
    log.put(change("brand", "insert", {"id": "1"}), "{broken", '{"ts": "soon"}')
    log.put("", "[1]", change("brand", "insert", {"id": "2"}))
    rows = topics.read_changelog(spark, root=str(tmp_path), keep_bad=True)
    good, bad = topics.diverted(rows)
    assert good.count() == 2 and sorted(r.value for r in bad.collect()) == sorted(["", "[1]", "{broken", '{"ts": "soon"}'])
    assert topics.read_changelog(spark, root=str(tmp_path)).count() == 2
    config = spark.createDataFrame([("brand", "insert", "dwd_brand", "id")], schemas.FACT_ROUTE)
    errors = str(tmp_path / "errors")

    def go():
        stream = topics.read_changelog(spark, delay=None, keep_bad=True, root=str(tmp_path), streaming=True)
        job = jobs.start_routed_fact_job(stream, lambda: config, str(tmp_path / "facts"), str(tmp_path / "ck"), trigger=NOW, errors=errors)
        run(job)
        return job

    first = go()
    seen = [p.observedMetrics["diverted topic_db"] for p in map(lambda x: x, first.recentProgress) if p.observedMetrics]
    assert sum(m["records"] for m in seen) == 6 and sum(m["bad"] for m in seen) == 4
    log.put("later")
    go()
    assert topics.read_topic(spark, jobs.error_topic("topic_db"), root=errors).count() == 5
    assert spark.read.text(str(tmp_path / "facts")).count() == 2


def test_error_job_and_missing_folder(spark, tmp_path, topic):  # noqa: F811
    topic("topic_db").put("nothing", change("brand", "insert", {"id": "1"}))
    stream = topics.read_changelog(spark, delay=None, keep_bad=True, root=str(tmp_path), streaming=True)
    run(jobs.start_error_job(stream, "topic_db", str(tmp_path / "errors"), str(tmp_path / "ck"), NOW))
    assert [r.value for r in topics.read_topic(spark, "topic_db_error", root=str(tmp_path / "errors")).collect()] == ["nothing"]
    with pytest.raises(ValueError):
        with jobs.keep_good(topics.read_changelog(spark, keep_bad=True, root=str(tmp_path)), "topic_db", None, 0):
            pass


def test_null_versions_are_offset(spark):
    rows = spark.createDataFrame(
        [("a", 1, None, 10), ("b", 1, None, 3), ("b", 1, 2, 4), ("c", None, 1, 9)], "id string, s int, seq int, m int"
    ).withColumn("et", F.timestamp_seconds("s"))
    net = state.offset_versions(rows, ["id"], ["et", "seq"], ["m"]).groupBy("id").agg(F.sum("m").alias("m"))
    assert collect(net) == [("a", 10), ("b", 4)]


def records(spark, rows):
    df = spark.createDataFrame(rows, "id string, n int, seq bigint, gone boolean")
    return upserts.keyed_records(df.drop("gone"), ["id"], "seq").join(df.select("seq", "gone"), "seq").select(
        "key", F.when(~F.col("gone"), F.col("value")).alias("value"), "seq"
    )


def test_keyed_topic_adds_and_retracts(spark, tmp_path):
    out, parts = str(tmp_path / "out"), [
        [("a", 1, 1, False), ("a", 2, 2, False), ("b", 1, 3, False)],
        [("a", 3, 5, False), ("b", 1, 6, True), ("c", 9, 7, True)],
        [("a", 2, 4, False), ("b", 4, 8, False), ("a", 3, 9, False)],
    ]
    got = []
    for part in parts:
        upserts.write_keyed_topic(records(spark, part).coalesce(1), "t", root=str(tmp_path))
        stream = upserts.read_keyed_topic(spark, "t", root=str(tmp_path), streaming=True)
        rows = {(r.op, r.id, r.n) for r in save(spark, upserts.normalised(stream, ROW), out).collect()}
        got.append(rows - set().union(*got))
    # Versions of one micro-batch count as the last; a late record and an equal row change nothing.
    assert got == [{("+I", "a", 2), ("+I", "b", 1)}, {("-U", "a", 2), ("+U", "a", 3), ("-D", "b", 1)}, {("+I", "b", 4)}]
    view = upserts.normalised(upserts.read_keyed_topic(spark, "t", root=str(tmp_path)), ROW)
    assert collect(view.select("id", "n")) == [("a", 3), ("b", 4)]


def test_early_left_join_corrects_what_it_wrote(spark, tmp_path, topic):  # noqa: F811
    log = topic("rows")
    ddl = "kind string, id string, v string, s bigint"

    def go():
        rows = topics.read_topic(spark, "rows", root=str(tmp_path), streaming=True).transform(topics.parse_json(ddl))
        rows = rows.withColumn("et", F.timestamp_seconds("s")).withWatermark("et", "3 seconds")
        left = rows.filter("kind = 'left'").select("id", "v", "et")
        sides = [rows.filter(f"kind = '{k}'").select("id", F.col("v").alias(k), "et") for k in ("x", "y")]
        out = save(spark, joins.early_left_join(left, sides, "id", "30 seconds"), str(tmp_path / "out"))
        return sorted((r.ver, r.sign, r.id, r.v, r.x, r.y) for r in out.collect() if r.id == "1")

    log.put({"kind": "left", "id": "1", "v": "l", "s": 100})
    assert go() == [(1, 1, "1", "l", None, None)]
    log.put({"kind": "x", "id": "1", "v": "late", "s": 110}, {"kind": "y", "id": "1", "v": "far", "s": 200})
    assert go() == [(1, 1, "1", "l", None, None), (2, -1, "1", "l", None, None), (3, 1, "1", "l", "late", None)]
    # The watermark has passed the bound: the key's rows are dropped and nothing more is corrected.
    log.put({"kind": "left", "id": "2", "v": "l", "s": 900})
    go()
    log.put({"kind": "left", "id": "2", "v": "l", "s": 1900})
    log.put({"kind": "y", "id": "1", "v": "too late", "s": 111})
    assert len(go()) == 3


def test_early_left_join_of_a_batch_is_the_left_join(spark):
    left = spark.createDataFrame([("1", 100), ("2", 100)], "id string, s bigint").withColumn("et", F.timestamp_seconds("s"))
    side = spark.createDataFrame([("1", "x", 110), ("1", "far", 500)], "id string, x string, t bigint").withColumn("et", F.timestamp_seconds("t"))
    got = joins.early_left_join(left, [side.drop("t")], "id", "30 seconds").select("id", "x", "sign", "ver")
    assert collect(got) == [("1", 1, 1, "x"), ("2", 1, 1, None)]


def test_state_with_time_to_live_forgets(spark, tmp_path, topic):  # noqa: F811
    """A key that Spark has dropped counts again; before that it does not."""
    log = topic("seen")

    def put(*values):
        log.put(*[{"id": i, "n": n, "s": s} for i, n, s in values])

    put(("a", 1, 10), ("a", 2, 5), ("b", 7, 1))
    rows = topics.read_topic(spark, "seen", root=str(tmp_path), streaming=True, options={"maxFilesPerTrigger": "1"})
    rows = rows.transform(topics.parse_json("id string, n int, s bigint")).withColumn("et", F.timestamp_seconds("s"))
    first = keyed.first_seen_by_key(rows, "id", {"n": "n"}, ttl="8 seconds")
    query = first.writeStream.format("memory").queryName("seen").trigger(processingTime="500 milliseconds").start()

    def reach(n, seconds=60):
        end = time.time() + seconds
        while spark.table("seen").count() < n and time.time() < end:
            time.sleep(0.3)
        return sorted(r.n for r in spark.table("seen").collect())

    try:
        assert reach(2) == [2, 7]
        put(("a", 3, 20), ("c", 9, 21))
        assert reach(3) == [2, 7, 9]
        time.sleep(10)
        put(("a", 4, 30))
        assert reach(4) == [2, 4, 7, 9]
    finally:
        query.stop()


def test_offsets_by_key_net_to_the_latest(spark, tmp_path, topic):  # noqa: F811
    log = topic("versions")
    log.put({"id": "a", "v": 1, "m": 5, "s": 1}, {"id": "a", "v": 3, "m": 7, "s": 3}, {"id": "b", "v": 1, "m": 2, "s": 1})
    log.put({"id": "a", "v": 2, "m": 6, "s": 2}, {"id": "a", "v": 3, "m": 7, "s": 3}, {"id": "b", "v": 4, "m": None, "s": 4})
    rows = topics.read_topic(spark, "versions", root=str(tmp_path), streaming=True, options={"maxFilesPerTrigger": "1"})
    rows = rows.transform(topics.parse_json("id string, v int, m int, s bigint")).withColumn("et", F.timestamp_seconds("s"))
    out = keyed.offset_versions_by_key(rows, ["id"], ["et", "v"], ["m"])
    query = out.writeStream.format("memory").queryName("versions").trigger(processingTime="500 milliseconds").start()
    try:
        end = time.time() + 60
        while spark.table("versions").count() < 8 and time.time() < end:
            time.sleep(0.3)
        net = spark.table("versions").groupBy("id").agg(F.sum("m").alias("m"))
        assert collect(net) == [("a", 7), ("b", 0)]
    finally:
        query.stop()


def test_error_topic_names():
    assert jobs.error_topic("a") == "a_error" and sinks.write_topic
