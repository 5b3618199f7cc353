"""Joins of two streams in packed buckets, netted corrections, summaries of streams by day, packed topics."""

from __future__ import annotations


import glob

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from conftest import collect
from streammart.plans import facts
from streammart.sources import sinks, topics
from streammart.streaming import keyed, processors
from test_stream_packs import At, Handle, frames, rows_of

CHANGE = "`table` string, type string, ts bigint, data map<string,string>"


def order(i, s, user="u"):
    return ("order_info", "insert", s, {"id": i, "user_id": user, "province_id": "7"})


def line(i, order_id, s):
    return ("order_detail", "insert", s, {"id": i, "order_id": order_id, "sku_id": "k", "sku_num": "2", "order_price": "1.50", "create_time": "2024-01-01 00:00:00"})


def activity(i, name, s):
    return ("order_detail_activity", "insert", s, {"order_detail_id": i, "activity_id": name, "activity_rule_id": "r"})


def coupon(i, name, s):
    return ("order_detail_coupon", "insert", s, {"order_detail_id": i, "coupon_id": name})


PARTS = [
    [line("l1", "1", 100), order("2", 100), activity("l9", "a", 90), coupon("l9", "c", 90)],
    # The order comes when its line is behind the watermark; the line's activity after that.
    [order("1", 150), line("l2", "2", 155), activity("l8", "a", 150), coupon("l8", "c", 150), line(None, None, 150), line("l3", None, 150)],
    [activity("l1", "a1", 148), coupon("l2", "c1", 156), coupon("l2", "c2", 156), order("1", 152, "v"), order("2", 900, "too far")],
    [line("x", "x", 2000), order("y", 2000), activity("x", "a", 2000), coupon("x", "c", 2000)],
    [line("x", "x", 9000), order("y", 9000), activity("x", "a", 9000), coupon("x", "c", 9000)],
]


def changes_of(spark, parts, folder):
    for part in parts:
        spark.createDataFrame(part, CHANGE).coalesce(1).write.mode("append").parquet(folder)
    rows = spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", 1).parquet(folder)
    dated = [r.withColumn("et", F.timestamp_seconds("ts")) for r in (rows, spark.read.parquet(folder))]
    return dated[0].withWatermark("et", "3 seconds"), dated[1]


def drained(rows, out):
    query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-ck").trigger(availableNow=True).start()
    query.awaitTermination()
    return query.recentProgress


def net(rows):
    rows = rows.drop("ver")
    names = [c for c in rows.columns if c != "sign"]
    return collect(rows.groupBy(*names).agg(F.sum("sign").alias("n")).filter("n <> 0"))


def test_early_lines_of_several_micro_batches_net_to_the_batch(spark, tmp_path):
    stream, batch = changes_of(spark, PARTS, str(tmp_path / "in"))
    drained(facts.early_order_detail(stream, "60 seconds"), str(tmp_path / "out"))
    got, want = net(spark.read.parquet(str(tmp_path / "out"))), net(facts.early_order_detail(batch, "60 seconds"))
    assert got == want and len(got) == 4


def test_early_lines_hold_buckets_not_rows(spark, tmp_path):
    """Spark's join of two streams held two state rows and more for each line and order."""
    rows = [r for i in range(1500) for r in (order(f"o{i}", 100), line(f"l{i}", f"o{i}", 101))]
    stream, _ = changes_of(spark, [rows], str(tmp_path / "in"))
    progress = drained(facts.early_order_detail(stream, "60 seconds"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1500
    assert max(sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in progress) <= 2 * 4 * 256


def test_a_pair_is_made_once_and_rows_are_dropped_in_time():
    handle = Handle()
    join = processors.InnerJoin([("k", "_r_k")], ["k", "v", "et", "w"], "et", 10_000)
    join.init(handle)

    def left(*rows):
        return pa.table({"k": [r[0] for r in rows], "v": [r[1] for r in rows], "_left": pa.array([r[2] * 1000 for r in rows], pa.int64())})

    def right(*rows):
        return pa.table({"_r_k": [r[0] for r in rows], "_r_w": [r[1] for r in rows], "_right": pa.array([r[2] * 1000 for r in rows], pa.int64())})

    def pairs(out):
        return sorted((r["k"], r["v"], r["w"]) for r in rows_of(out))

    assert pairs(join.handleInputRows(0, frames([left(("a", "l1", 100), ("a", "far", 120)), right(("a", "r1", 110), ("b", "r", 100))]), At(0))) == [("a", "far", "r1"), ("a", "l1", "r1")]
    assert pairs(join.handleInputRows(0, frames([right(("a", "r2", 105))]), At(104))) == [("a", "l1", "r2")]
    assert handle.timers[-1] == 131
    # Rows that can meet no row on time are gone; what the bucket has seen pass is late.
    out = list(join.handleInputRows(0, frames([left(("a", "late", 103), ("b", "l", 113)), right(("a", "r3", 112))]), At(116)))
    assert pairs(out) == [("a", "far", "r3")]
    assert all(pdf["_et"][0] == pd.Timestamp(113, unit="ms", tz="UTC") for pdf in out)
    list(join.handleExpiredTimer(0, At(131), None))
    assert handle.value.get()[:2] == (None, None)


def test_netted_is_the_group_by_of_all_columns(spark, monkeypatch):
    monkeypatch.setattr(processors, "PACKED", 64)
    rows = [("a", 1.5, 1), ("a", 1.5, -1), ("a", None, 1), ("a", None, 1), (None, None, 1), ("b", 0.0, -1), ("b", 0.0, 1), ("b", 2.0, -1)]
    df = spark.createDataFrame(rows * 3, "id string, x double, sign int").repartition(3)
    want = df.groupBy("id", "x").agg(F.sum("sign").alias("n")).filter("n <> 0")
    assert collect(keyed.netted(df, ["id"], "sign", "n")) == collect(want) and want.count() == 3


def test_days_of_a_stream_are_gathered(spark, tmp_path):
    """A stream's session has no adaptive execution, without which the hint was dropped: a file for each task and day."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(4000).select(F.concat(F.lit("2024-01-0"), (F.col("id") % 9 + 1).cast("string")).alias("cur_date"), "id").repartition(8).write.parquet(folder)
    rows = spark.readStream.schema("cur_date string, id bigint").option("maxFilesPerTrigger", 8).parquet(folder)
    sinks.write_summary(rows, out, f"{out}-ck", {"availableNow": True}).awaitTermination()
    assert sinks.read_summary(spark, out).agg(F.count("id"), F.sum("id")).first()[:] == (4000, 3999 * 2000)
    assert len(glob.glob(f"{out}/cur_date=*/*/*.parquet")) == 9


def test_offsets_without_the_columns_that_ordered_them():
    table = pa.table({"id": ["a", "a", None, None, "c"], "v": [1, 2, 4, 3, 5], "m": [10, 20, 40, 30, 50], "et": pa.array([0] * 5, pa.timestamp("us", "UTC")), "et_ms": [0] * 5})
    offset = processors.OffsetVersions(["id"], ["v"], ["m"], "et", 1000, ["et", "m"])
    handle = Handle()
    offset.init(handle)
    out = rows_of(offset.handleInputRows(0, frames([table]), At(0)))
    assert sorted(r["m"] for r in out) == [-30, -10, 10, 20, 30, 40, 50] and set(out[0]) == {"et", "m"}
    assert sorted(r["m"] for r in processors.unpack(handle.value.get()[0]).to_pylist()) == [20, 40, 50]


def test_topics_are_packed_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    """Change messages as plain text took six times the disk; one packed file is one task's, so it may not grow without end."""
    monkeypatch.setitem(sinks.TOPIC_FILES, "maxRecordsPerFile", "1000")
    rows = spark.range(2500).select(F.to_json(F.struct("id", F.lit("größe").alias("name"))).alias("value")).coalesce(1)
    sinks.write_topic(rows, "batch", root=str(tmp_path))
    stream = topics.read_topic(spark, "batch", root=str(tmp_path), streaming=True)
    sinks.write_topic(stream, "stream", root=str(tmp_path), checkpoint=str(tmp_path / "ck"), trigger={"availableNow": True}).awaitTermination()
    want = collect(rows)
    for topic in ("batch", "stream"):
        assert len(glob.glob(f"{tmp_path}/{topic}/*.txt.gz")) >= 3 and not glob.glob(f"{tmp_path}/{topic}/*.txt")
        assert collect(topics.read_topic(spark, topic, root=str(tmp_path))) == want
