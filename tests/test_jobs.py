"""Streams wired to tables: the jobs, restarts, replays."""

from __future__ import annotations

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import collect
from streammart import schemas
from streammart.operators import state
from streammart.operators.joins import lookup
from streammart.plans import jobs, summaries
from streammart.sources import sinks, topics
from streammart.sources.tables import read_dim
from test_operators import COMMON, ERR_LOG, PAGE_LOG, START_LOG, change, route

NOW = {"availableNow": True}


class Topic:
    """A file topic that grows."""

    def __init__(self, folder):
        self.folder, self.n = str(folder), 0
        os.makedirs(self.folder)

    def put(self, *items):
        path = f"{self.folder}/{self.n:04d}.txt"
        with open(path, "w") as f:
            f.writelines((i if isinstance(i, str) else json.dumps(i)) + "\n" for i in items)
        os.utime(path, (1_700_000_000 + self.n, 1_700_000_000 + self.n))
        self.n += 1


@pytest.fixture
def topic(tmp_path):
    return lambda name: Topic(tmp_path / name)


def run(queries):
    for q in queries if isinstance(queries, list) else [queries]:
        q.awaitTermination()


def test_log_job(spark, tmp_path, topic):
    log = topic("topic_log")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")

    def go():
        raw = topics.read_topic(spark, "topic_log", root=str(tmp_path), streaming=True, options={"maxFilesPerTrigger": "1"})
        run(jobs.start_log_job(raw, out, ck, NOW))

    def count(name):
        try:
            return topics.read_topic(spark, schemas.LOG_OUTPUTS[name], root=out).count()
        except Exception:
            return 0

    log.put(START_LOG, PAGE_LOG, "{broken")
    log.put(ERR_LOG)
    go()
    assert {n: count(n) for n in schemas.LOG_OUTPUTS} == {"err": 1, "start": 1, "display": 16, "action": 5, "page": 2, "bad": 1}
    # A restart goes on; state survives: the device was first seen without the new flag.
    log.put({**PAGE_LOG, "common": {**COMMON, "is_new": "1"}, "ts": 1700000900000})
    go()
    pages = topics.read_page_log(spark, root=out)
    assert pages.count() == 3
    assert {r["is_new"] for r in pages.select("common.is_new").collect()} == {"0"}


def test_dim_job_follows_the_configuration(spark, tmp_path, topic):
    log, conf = topic("topic_db"), topic("routes")
    dims, ck = str(tmp_path / "dims"), str(tmp_path / "ck")
    snapshot = spark.createDataFrame([tuple(route("brand", "dim_brand", "id,name").values())], schemas.DIM_ROUTE)
    conf.put({"op": "d", "ts_ms": 1, "before": route("none", "dim_none"), "after": None})
    reader = jobs.config_reader(
        ["source_table"],
        lambda: snapshot,
        lambda: topics.parse_config_changes(topics.read_topic(spark, "routes", root=str(tmp_path))),
    )

    def go():
        changes = topics.read_changelog(spark, root=str(tmp_path), streaming=True, delay=None)
        run(jobs.start_dim_job(changes, reader, dims, "shop", ck, NOW, buckets=4))

    log.put(
        change("brand", "bootstrap-insert", {"id": "1", "name": "one", "extra": "x"}),
        change("brand", "insert", {"id": "2", "name": "two"}),
        change("city", "insert", {"id": "7", "name": "seven"}),
    )
    go()
    assert collect(read_dim(spark, dims, "dim_brand").select("id", "name")) == [("1", "one"), ("2", "two")]

    # The route learns a column, a second table is routed, rows change twice in one second.
    conf.put(
        {"op": "u", "ts_ms": 2, "before": route("brand", "dim_brand", "id,name"), "after": route("brand", "dim_brand", "id,name,logo")},
        {"op": "c", "ts_ms": 3, "before": None, "after": route("city", "dim_city", "id,name")},
    )
    log.put(
        change("brand", "update", {"id": "1", "name": "uno", "logo": "l"}, {"name": "one"}),
        change("brand", "update", {"id": "1", "name": None}, {"name": "uno"}),
        change("brand", "delete", {"id": "2", "name": "two"}),
        change("city", "insert", {"id": "8", "name": "eight"}),
    )
    go()
    assert collect(read_dim(spark, dims, "dim_brand").select("id", "name", "logo")) == [("1", "l", "uno")]
    assert collect(read_dim(spark, dims, "dim_city").select("id", "name")) == [("8", "eight")]


def test_routed_fact_job(spark, tmp_path, topic):
    log = topic("topic_db")
    config = spark.createDataFrame([("user_info", "insert", "dwd_user_register", "id,create_time")], schemas.FACT_ROUTE)
    log.put(
        change("user_info", "insert", {"id": "1", "create_time": "2024-01-01 00:00:05", "x": "y"}),
        change("user_info", "bootstrap-insert", {"id": "2"}),
    )
    changes = topics.read_changelog(spark, root=str(tmp_path), streaming=True, delay=None)
    run(jobs.start_routed_fact_job(changes, lambda: config, str(tmp_path / "out"), str(tmp_path / "ck"), "shop", NOW))
    rows = spark.read.text(str(tmp_path / "out")).collect()
    assert [(json.loads(r["value"]), r["sink_table"]) for r in rows] == [
        ({"id": "1", "create_time": "2024-01-01 00:00:05", "ts": "1700000000"}, "dwd_user_register")
    ]


def test_fact_job_looks_names_up_when_it_writes(spark, tmp_path, topic):
    facts = topic("dwd_trade_cart_add")
    names = sinks.UpsertTable(spark, str(tmp_path / "dims" / "dic"), ["code"], 2)
    names.merge(spark.createDataFrame([("1", "one", 0)], "code string, name string, v int"), ["v"])

    def go():
        stream = topics.read_fact(spark, "dwd_trade_cart_add", root=str(tmp_path), streaming=True)
        finish = lambda rows: lookup(rows, read_dim(spark, str(tmp_path / "dims"), "dic"), "sku_id", "code", {"name": "name"})
        run(jobs.start_fact_job(stream, str(tmp_path / "out"), "id", str(tmp_path / "ck"), finish, NOW, 2))

    row = {"id": "a", "user_id": "u", "sku_id": "1", "sku_num": 1, "ts": 5}
    facts.put(row, {**row, "sku_num": 4, "ts": 9})
    go()
    names.merge(spark.createDataFrame([("1", "uno", 1)], "code string, name string, v int"), ["v"])
    facts.put({**row, "id": "b"})
    go()
    out = sinks.UpsertTable(spark, str(tmp_path / "out")).read()
    assert collect(out.select("id", "name", "sku_num")) == [("a", "one", 4), ("b", "uno", 1)]


def test_summary_job_and_restart(spark, tmp_path, topic):
    pages = topic("dwd_traffic_page")

    def page(mid, second):
        return {"common": {**COMMON, "mid": mid}, "page": {"page_id": "home", "during_time": 5}, "ts": 1704067200000 + second * 1000}

    def go():
        stream = topics.read_page_log(spark, root=str(tmp_path), streaming=True, delay=None)
        run(jobs.start_summary_job(summaries.traffic_by_dims(stream), str(tmp_path / "out"), str(tmp_path / "ck"), trigger=NOW))
        return sinks.read_summary(spark, str(tmp_path / "out"))

    pages.put(page("a", 1), page("a", 2), page("b", 3), page("a", 15))
    first = go()
    assert collect(first.select("uv_ct", "pv_ct", "sv_ct", "dur_sum")) == [(15, 3, 3, 2)]
    pages.put(page("b", 16), page("c", 17), page("c", 60))
    both = go()  # "b" was already counted today, before the restart
    assert [tuple(r) for r in both.orderBy("stt").select("uv_ct", "pv_ct").collect()] == [(2, 3), (1, 3)]


def stored_files(root):
    """Partition -> its files."""
    rows = root / "rows"
    return {p: sorted(os.listdir(rows / p)) for p in os.listdir(rows) if "=" in p}


def test_upsert_table(spark, tmp_path):
    table = sinks.UpsertTable(spark, str(tmp_path / "t"), ["id"], buckets=4)
    assert not table.exists()
    rows = spark.range(100).select("id", F.lit("a").alias("x"), F.lit(0).alias("v"))
    assert table.merge(rows, ["v"], source="s", batch_id=0)
    assert not table.merge(rows.withColumn("x", F.lit("replayed")), ["v"], source="s", batch_id=0)
    update = spark.createDataFrame([(5, "b", 1), (5, "c", 2), (6, None, 1)], "id bigint, x string, v int")
    before = stored_files(tmp_path / "t")
    assert table.merge(update, ["v"], deleted="x is null", source="s", batch_id=1)
    now = table.read()
    assert now.count() == 99 and now.filter("x = 'c'").count() == 1
    assert now.filter("id = 6").count() == 0
    # only the touched buckets were written again
    after = stored_files(tmp_path / "t")
    assert len(before) == 4 and sum(before[p] != after[p] for p in before) <= 2
    table.merge(spark.range(100).select("id", F.lit(None).cast("string").alias("x"), F.lit(9).alias("v")), ["v"], deleted="x is null")
    with pytest.raises(FileNotFoundError):
        table.read()
    assert not (tmp_path / "t" / "staged").exists()


def test_half_written_merge_is_invisible(spark, tmp_path):
    table = sinks.UpsertTable(spark, str(tmp_path / "t"), ["id"], buckets=2)
    table.merge(spark.range(10).withColumn("v", F.lit(0)), ["v"])

    def crash(current, changes):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        table.rewrite(spark.range(5).withColumn("v", F.lit(1)), crash)
    os.makedirs(tmp_path / "t" / "staged" / "_part=b-0")  # left behind by a dead writer
    assert table.read().count() == 10
    table.merge(spark.range(20).withColumn("v", F.lit(2)), ["v"])
    assert table.read().count() == 20


def test_streams_to_files(spark, tmp_path, topic):
    source = topic("in")
    source.put("x", "y")
    raw = topics.read_topic(spark, "in", root=str(tmp_path), streaming=True)
    run(sinks.write_topic(raw, "copy", root=str(tmp_path / "o"), checkpoint=str(tmp_path / "c1"), trigger=NOW))
    routed = raw.withColumn("sink_table", F.concat(F.lit("t_"), "value"))
    run(sinks.write_routed(routed, root=str(tmp_path / "r"), checkpoint=str(tmp_path / "c2"), trigger=NOW))
    assert collect(topics.read_topic(spark, "copy", root=str(tmp_path / "o"))) == [("x",), ("y",)]
    back = spark.read.text(str(tmp_path / "r"))
    assert collect(back) == [("t_x", "x"), ("t_y", "y")]


def test_several_topics_are_read_together(spark, tmp_path, topic):
    topic("a").put("1")
    topic("b").put("2", "3")
    topic("c").put("4")
    assert topics.read_topic(spark, ["a", "b"], root=str(tmp_path)).count() == 3


def test_upsert_table_with_parts(spark, tmp_path):
    table = sinks.UpsertTable(spark, str(tmp_path / "t"), ["id"], buckets=2, part="day")
    rows = spark.range(40).select("id", F.concat(F.lit("d"), F.col("id") % 4).alias("day"), F.lit(0).alias("v"))
    table.merge(rows, ["v"])
    before = stored_files(tmp_path / "t")
    table.merge(rows.filter("day = 'd1'").withColumn("v", F.lit(1)), ["v"])
    after = stored_files(tmp_path / "t")
    assert {p for p in after if before[p] != after[p]} == {"_part=d-d1"}
    assert table.read().count() == 40 and table.read(["d1"]).count() == 10
    assert table.read().agg(F.sum("v")).first()[0] == 10


def test_upsert_table_keeps_cells_of_added_columns(spark, tmp_path):
    table = sinks.UpsertTable(spark, str(tmp_path / "t"), ["id"], buckets=4)
    table.merge(spark.range(40).selectExpr("id", "'a' as name", "1 as v"), ["v"])
    later = spark.createDataFrame([(i, "b", "s", 2) for i in (0, 1, 2, 50)], "id long, name string, seg string, v int")
    table.merge(later, ["v"])
    table.merge(spark.range(10, 30).selectExpr("id", "'c' as name", "3 as v"), ["v"])
    rows = {r["id"]: r for r in table.read().collect()}
    assert len(rows) == 41
    assert {i for i, r in rows.items() if r["seg"] == "s"} == {0, 1, 2, 50}
    assert {r["name"] for i, r in rows.items() if 10 <= i < 30} == {"c"}


def test_two_routes_into_one_dimension(spark, tmp_path, topic):
    log = topic("topic_db")
    routes = [tuple(route(t, "dim_ab", f"id,{c}").values()) for t, c in (("a", "x"), ("b", "y"))]
    dims, ck = str(tmp_path / "dims"), str(tmp_path / "ck")
    log.put(change("a", "insert", {"id": "1", "x": "left"}), change("b", "insert", {"id": "1", "y": "right"}))
    changes = topics.read_changelog(spark, root=str(tmp_path), streaming=True, delay=None)
    reader = lambda: spark.createDataFrame(routes, schemas.DIM_ROUTE)
    run(jobs.start_dim_job(changes, reader, dims, "shop", ck, NOW, buckets=4))
    assert collect(read_dim(spark, dims, "dim_ab").select("id", "x", "y")) == [("1", "left", "right")]


def test_summary_batches_of_one_day_add_up(spark, tmp_path):
    for name in ("x", "y"):
        sinks.write_summary(spark.createDataFrame([("2024-01-01", name)], "cur_date string, ch string"), str(tmp_path / "s"))
    assert sorted(r["ch"] for r in sinks.read_summary(spark, str(tmp_path / "s")).collect()) == ["x", "y"]


def test_redelivered_versions_and_rows_without_time(spark):
    rows = [("k", 1, 10.0, "2024-01-01"), ("k", 2, 7.0, "2024-01-01"), ("k", 2, 7.0, "2024-01-01"), ("k", 3, 5.0, None)]
    df = spark.createDataFrame(rows, "id string, v int, amount double, t string").selectExpr("id", "v", "amount", "to_timestamp(t) as et")
    assert state.offset_versions(df, ["id"], ["et", "v"], ["amount"]).agg({"amount": "sum"}).first()[0] == 7.0


def test_merge_cut_off_while_it_is_put_in_place(spark, tmp_path):
    """The writer dies after it removed old partitions: the next one finds the merge beside the table."""
    root = tmp_path / "t"
    table = sinks.UpsertTable(spark, str(root), ["id"], buckets=2)
    table.merge(spark.range(10).withColumn("v", F.lit(0)), ["v"], source="s", batch_id=0)
    copied = {}

    class Cut(sinks.UpsertTable):
        def _put_in_place(self):
            if os.path.exists(f"{self.staged}/_SUCCESS"):
                shutil.rmtree(f"{self.rows}/_part=b-0")
                copied["cut"] = True
                raise RuntimeError("lost")

    change = spark.range(20).withColumn("v", F.lit(1))
    with pytest.raises(RuntimeError):
        Cut(spark, str(root), ["id"], buckets=2).merge(change, ["v"], source="s", batch_id=1)
    assert copied and table.read().count() < 10
    assert not table.merge(change, ["v"], source="s", batch_id=1)  # put in place again, so the replay has nothing to do
    assert table.read().count() == 20 and table.read().agg(F.sum("v")).first()[0] == 20


def test_replay_skips_only_the_partitions_that_have_the_batch(spark, tmp_path):
    table = sinks.UpsertTable(spark, str(tmp_path / "t"), ["id"], part="day")
    rows = spark.createDataFrame([(1, "a", 0), (2, None, 0), (3, "a/b", 0)], "id long, day string, v int")
    table.merge(rows.filter("day = 'a'"), ["v"], source="s", batch_id=3)
    assert table.merge(rows.withColumn("v", F.lit(9)), ["v"], source="s", batch_id=3)
    assert collect(table.read().select("id", "v")) == [(1, 0), (2, 9), (3, 9)]
    assert collect(table.read(["a/b"]).select("id")) == [(3,)]


def test_a_route_appears_while_the_job_runs(spark, tmp_path, topic):
    log, routes = topic("topic_db"), [("user_info", "insert", "dwd_user_register", "id")]
    reader = lambda: spark.createDataFrame(routes, schemas.FACT_ROUTE)
    changes = topics.read_changelog(spark, root=str(tmp_path), streaming=True, delay=None, options={"maxFilesPerTrigger": "1"})
    job = jobs.start_routed_fact_job(changes, reader, str(tmp_path / "out"), str(tmp_path / "ck"), "shop", {"processingTime": "0 seconds"})
    try:
        log.put(change("user_info", "insert", {"id": "1"}), change("favor_info", "insert", {"id": "2"}))
        job.processAllAvailable()
        routes.append(("favor_info", "insert", "dwd_interaction_favor_add", "id"))
        log.put(change("user_info", "insert", {"id": "3"}), change("favor_info", "insert", {"id": "4"}))
        job.processAllAvailable()
    finally:
        job.stop()
    rows = spark.read.text(str(tmp_path / "out"))
    got = sorted((json.loads(r["value"])["id"], r["sink_table"]) for r in rows.collect())
    assert got == [("1", "dwd_user_register"), ("3", "dwd_user_register"), ("4", "dwd_interaction_favor_add")]


def test_split_job_and_its_readers(spark, tmp_path, topic):
    log, out, errors = topic("topic_db"), str(tmp_path / "split"), str(tmp_path / "errors")

    def go(checkpoint):
        changes = topics.read_changelog(spark, root=str(tmp_path), streaming=True, delay=None, keep_bad=True)
        run(jobs.start_split_job(changes, out, str(tmp_path / checkpoint), NOW, errors))

    log.put(change("a", "insert", {"id": "1"}), change(None, "insert", {"id": "0"}), "{broken")
    go("ck")
    log.put(change("a", "insert", {"id": "2"}), change("b", "insert", {"id": "3"}))
    go("ck")
    back = topics.read_split_changelog(spark, out)
    assert collect(back.select("table", F.col("data")["id"])) == [("0", None), ("1", "a"), ("2", "a"), ("3", "b")]
    assert collect(spark.read.text(f"{errors}/topic_db_error").select("value")) == [("{broken",)]
    stream = topics.read_split_changelog(spark, out, delay=None, streaming=True).filter("table = 'a'")
    rows = stream.select(F.col("data")["id"].alias("value"))
    run(sinks.write_topic(rows, "copy", root=str(tmp_path / "o"), checkpoint=str(tmp_path / "c2"), trigger=NOW))
    assert collect(topics.read_topic(spark, "copy", root=str(tmp_path / "o"))) == [("1",), ("2",)]


def test_a_split_log_is_not_shuffled(spark, tmp_path):
    """A whole log is written by the tasks that read it; the small batches of a stream are gathered by table."""
    rows = spark.range(0, 400, 1, 4).selectExpr("'shop' as database", "if(id % 2 = 0, 'a', 'b') as table", "'insert' as type", "id as ts", "map('id', string(id)) as data", "cast(null as map<string,string>) as old")
    files = {}
    for gather in (False, True):
        out = str(tmp_path / f"split-{gather}")
        topics.write_split_changelog(rows, out, gather=gather)
        files[gather] = len(list((tmp_path / f"split-{gather}").glob("table=*/batch_id=0/*.parquet")))
        back = topics.read_split_changelog(spark, out)
        assert collect(back.drop("et").selectExpr("database", "table", "type", "ts", "data['id'] as id", "old is null")) == collect(
            rows.selectExpr("database", "table", "type", "ts", "data['id'] as id", "old is null")
        )
    assert files == {False: 8, True: 2}
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
