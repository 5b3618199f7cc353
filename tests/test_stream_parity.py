"""The same builder on a stream (several micro-batches) and on a batch gives the same rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, collect
from streammart.checks import views as v
from streammart.operators import changelog, state
from streammart.plans import facts, summaries
from streammart.session import scratch_path
from streammart.sources import sinks

NOW = {"availableNow": True}
BEFORE_END = "2039-01-01"


def drain(spark, df, batches=4):
    """Run a stream to its end; its rows."""
    root = scratch_path(spark, "drain")
    query = (
        df.writeStream.format("parquet")
        .option("path", root)
        .option("checkpointLocation", f"{root}-ck")
        .trigger(**NOW)
        .start()
    )
    query.awaitTermination()
    assert query.lastProgress["batchId"] >= batches - 1
    return spark.read.parquet(root)


def signups(spark, sf):
    rows = v.events(spark, sf).filter("event_type = 'signup'")
    return rows.select(F.date_format("et", "yyyy-MM-dd HH:mm:ss").alias("create_time"))


def purchases(spark, sf):
    return v.events(spark, sf).filter("event_type = 'purchase'").select("user_id", "event_id", "et")


def carts(spark, sf):
    return facts.fact_cart_add(v.changelog(spark, sf))


SUMMARIES = {
    "keywords": lambda s, d: summaries.keyword_counts(v.searches(s, d)),
    "traffic": lambda s, d: summaries.traffic_by_dims(v.pages(s, d), width="6 hours"),
    "home": lambda s, d: summaries.home_detail_uv(v.pages(s, d), width="6 hours"),
    "logins": lambda s, d: summaries.login_users(v.pages(s, d), width="1 day"),
    "register": lambda s, d: summaries.registrations(signups(s, d), width="6 hours"),
    "cart": lambda s, d: summaries.cart_users(carts(s, d), width="6 hours"),
    "payments": lambda s, d: summaries.payment_users(purchases(s, d), width="6 hours"),
    "orders": lambda s, d: summaries.order_users(v.order_versions(s, d), width="10 minutes"),
    "sku": lambda s, d: summaries.sku_amounts(
        v.order_versions(s, d), width="10 minutes", order=v.VERSION_ORDER
    ),
    "province": lambda s, d: summaries.province_totals(
        v.order_versions(s, d), width="10 minutes", order=v.VERSION_ORDER
    ),
}


@pytest.mark.parametrize("name", SUMMARIES)
def test_summary(spark, live, name):
    build = SUMMARIES[name]
    got = collect(drain(spark, build(spark, live)).filter(F.col("cur_date") < BEFORE_END))
    want = collect(build(spark, SMALL))
    assert got == want and want


def test_fix_new_flag(spark, live):
    def build(sf):
        return state.fix_new_flag(v.pages(spark, sf)).select("event_id", "common.mid", "page.page_id", "et", "is_new")

    got = collect(drain(spark, build(live)).filter(F.col("event_id") < 10**6))
    want = collect(build(SMALL))
    assert got == want and want


def test_offset_versions(spark, live):
    def build(sf):
        rows = v.order_versions(spark, sf).filter(F.col("et") < F.lit(BEFORE_END).cast("timestamp"))
        rows = rows.select("id", "sku_id", "split_total_amount", *v.VERSION_ORDER)
        return state.offset_versions(rows, ["id"], list(v.VERSION_ORDER), ["split_total_amount"])

    got = collect(drain(spark, build(live)))
    want = collect(build(SMALL))
    assert got == want and want


@pytest.mark.parametrize("name", ["order_detail", "payment", "cancel", "refund", "refund_payment"])
def test_fact(spark, live, name):
    """Joins with the same bounds, including left joins whose unmatched rows have to wait."""

    def build(sf):
        changes = v.trade_changes(spark, sf)
        if changes.isStreaming:
            changes = changes.withWatermark("et", "3 seconds")
        detail = facts.fact_order_detail(changes, "30 seconds")
        if name == "order_detail":
            return detail
        if name == "payment":
            # What a job reads is the fact table, a source with a watermark of its own.
            return facts.fact_payment(lines(sf), changes, v.region_dic(spark, SMALL))
        if name == "cancel":
            return facts.fact_order_cancel(lines(sf), changes, "910 seconds")
        if name == "refund":
            return facts.fact_refund(changes, v.nation_dic(spark, SMALL), "5 seconds")
        return facts.fact_refund_payment(changes, v.region_dic(spark, SMALL), "5 seconds")

    def lines(sf):
        rows = v.trade_changes(spark, sf).filter("`table` = 'order_detail'")
        typed = rows.select(
            *changelog.cells(["id", "order_id", "sku_id", "sku_name", "sku_num"]),
            *[F.col("data")["order_id"].alias(c) for c in ("user_id", "province_id", "activity_id", "activity_rule_id", "coupon_id")],
            *[F.col("data")["order_price"].alias(f"split_{c}_amount") for c in ("original", "activity", "coupon", "total")],
            "ts",
            "et",
        )
        return typed.withWatermark("et", "3 seconds") if typed.isStreaming else typed

    got = collect(drain(spark, build(live)).filter(F.col("et") < F.lit(BEFORE_END).cast("timestamp")))
    want = collect(build(SMALL))
    assert got == want and want


def test_comment_and_cart_facts(spark, live):
    def build(sf):
        changes = v.changelog(spark, sf)
        return facts.fact_comment(changes, v.nation_dic(spark, SMALL)).select("id", "appraise_name")

    got = collect(drain(spark, build(live)).filter("cast(id as bigint) < 1000000"))
    assert got == collect(build(SMALL)) and got


def test_hot_key_is_reduced_before_the_shuffle(spark):
    from streammart.streaming.keyed import keep_first_rows

    df = spark.range(0, 50_000, numPartitions=2).select(
        F.lit("hot").alias("mid"), F.timestamp_seconds("id").alias("et")
    )
    kept = keep_first_rows(df, ["mid"], ["et"])
    # two rows (first and newest) per Arrow batch of 10,000
    assert kept.count() <= 12
    assert kept.agg(F.min("et"), F.max("et")).collect() == df.agg(F.min("et"), F.max("et")).collect()


def test_days_of_another_time_zone(spark):
    """Eight hours ahead: days and times survive the trip through the processors."""
    from streammart.session import configure

    configure(spark, "Asia/Shanghai")
    try:
        folder = scratch_path(spark, "zone")
        spark.range(0, 2000, 1, 1).select(
            (F.col("id") % 17).cast("string").alias("user_id"),
            F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 300).alias("et"),
            (F.col("id") % 900).cast("string").alias("id"),
            F.col("id").alias("v"),
            F.lit(1).cast("decimal(16,2)").alias("m"),
        ).write.parquet(folder)
        batch = spark.read.parquet(folder)
        stream = spark.readStream.schema(batch.schema).parquet(folder)

        def days(df):
            rows = state.first_rows_of_day(df, {"user_id": "user_id"}, {"id": "id"}, history=True)
            return rows.withColumn("et", F.unix_micros("et"))

        def versions(df):
            rows = state.offset_versions(df, ["id"], ["et", "v"], ["m"])
            return rows.withColumn("et", F.unix_micros("et"))

        for build in (days, versions):
            assert collect(drain(spark, build(stream), batches=1)) == collect(build(batch))
        assert days(batch).filter("day = '2024-01-01' and et >= 1704124800000000").count() == 0
    finally:
        configure(spark)


def test_late_rows_are_dropped(spark, tmp_path):
    """A row behind the watermark that two earlier micro-batches set is not counted."""
    import pandas as pd

    from conftest import save_parts

    def part(*seconds):
        times = pd.to_datetime(list(seconds), unit="s")
        return pd.DataFrame({"mid": [f"m{s}" for s in seconds], "et": times.astype("datetime64[us]")})

    save_parts([part(5, 100), part(200), part(7, 1000), part(2000)], str(tmp_path / "in"))
    source = spark.read.parquet(str(tmp_path / "in"))
    stream = (
        spark.readStream.schema("mid string, et timestamp")
        .option("maxFilesPerTrigger", 1)
        .parquet(str(tmp_path / "in"))
    )
    assert source.count() == 6
    from streammart.operators.windows import tumble_agg

    counted = drain(spark, tumble_agg(stream, [], [F.count(F.lit(1)).alias("n")]))
    got = {r["stt"][-8:]: r["n"] for r in counted.collect()}
    assert got == {"00:00:00": 1, "00:01:40": 1, "00:03:20": 1, "00:16:40": 1}


def test_join_of_streams_needs_a_bound(spark, live):
    left = v.pages(spark, live).select("event_id", "et")
    with pytest.raises(ValueError):
        from streammart.operators.joins import fact_join

        fact_join(left, left.withColumnRenamed("event_id", "e2"), ("event_id", "e2"))


def test_latest_after_delay(spark, tmp_path):
    """Versions of a key that arrive together come out once, as the latest."""
    import time

    import pandas as pd

    from conftest import save_parts
    from streammart.streaming.keyed import stream_latest_per_key

    pdf = pd.DataFrame({"id": ["a", "a", "b"], "version": [1, 2, 1], "amount": [5.0, 6.0, 7.0]})
    save_parts([pdf], str(tmp_path / "in"))
    stream = spark.readStream.schema("id string, version bigint, amount double").parquet(str(tmp_path / "in"))
    out = stream_latest_per_key(stream, ["id"], ["version"], "1 second")
    query = out.writeStream.format("memory").queryName("held").trigger(processingTime="500 milliseconds").start()
    try:
        for _ in range(60):
            if spark.table("held").count() >= 2:
                break
            time.sleep(0.5)
        assert collect(spark.table("held")) == [(6.0, "a", 2), (7.0, "b", 1)]
    finally:
        query.stop()


def test_latest_per_key_by_event_time(spark, live):
    """Over several micro-batches: one row a key, the one that a batch finds, as versions are less than the delay apart."""
    from streammart.streaming.keyed import stream_latest_per_key

    def rows(sf):
        return v.order_versions(spark, sf).select("id", "sku_id", *v.VERSION_ORDER)

    order = list(v.VERSION_ORDER)
    got = drain(spark, stream_latest_per_key(rows(live), ["id"], order, "10 seconds", et="et"))
    assert collect(got.filter(F.col("et") < BEFORE_END)) == collect(state.latest_per_key(rows(SMALL), ["id"], order, ["sku_id", *order]).select(got.columns))


def test_a_second_burst_is_written_again(spark, tmp_path):
    """What comes after a key was written opens a new burst; a row without a time, or one behind the watermark, is left out."""
    import datetime

    import pandas as pd

    from conftest import save_parts
    from streammart.streaming.keyed import stream_latest_per_key

    def at(second):
        return None if second is None else datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=second)

    def part(*rows):
        return pd.DataFrame([(k, version, at(s)) for k, version, s in rows], columns=["id", "version", "et"]).astype({"version": "Int64", "et": "datetime64[us]"})

    parts = [
        part(("a", 1, 0), ("a", 2, 2), ("b", 1, 3), ("c", 9, None)),
        part(("a", 3, 4), ("b", None, 3), ("z", 1, 60)),
        part(("a", 4, 70), ("a", 9, 1), ("z", 2, 61)),
        part(("z", 1, 500)),
    ]
    save_parts(parts, str(tmp_path / "in"))
    stream = spark.readStream.schema("id string, version bigint, et timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = drain(spark, stream_latest_per_key(stream, ["id"], ["version"], "10 seconds", et="et"))
    assert sorted((r.id, r.version) for r in got.collect()) == [("a", 3), ("a", 4), ("b", 1), ("z", 2)]
