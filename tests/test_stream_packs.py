"""State processors that get their rows packed by bucket."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from conftest import collect, save_parts
from streammart.operators import logs
from streammart.operators.windows import tumble_agg
from streammart.plans import summaries
from streammart.streaming import processors


class Value:
    value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class At:
    def __init__(self, watermark):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):
        return self.watermark


def frames(tables):
    return iter([pd.DataFrame({"rows": [processors.pack(t)]}) for t in tables])


def rows_of(out):
    return [r for pdf in out for data in pdf["rows"] for r in processors.unpack(data).to_pylist()]


def test_a_bucket_is_compared_in_proportion_to_its_rows(monkeypatch):
    """Many frames of a bucket: what is held is not sorted again with each of them."""
    monkeypatch.setattr(processors, "PIECE", 10)
    sorted_rows = []
    ordered = processors.ordered
    monkeypatch.setattr(processors, "ordered", lambda rows, columns: (sorted_rows.append(rows.num_rows), ordered(rows, columns))[1])
    n = 2000
    tables = [
        pa.table({"id": [f"k{i}" for i in range(j, j + 10)], "v": list(range(10)), "m": [1] * 10, "et": pa.array([0] * 10, pa.timestamp("us", "UTC")), "et_ms": [0] * 10})
        for j in range(0, n, 10)
    ]
    offset = processors.OffsetVersions(["id"], ["et", "v"], ["m"], "et", 1000)
    offset.latest = Value()
    assert len(rows_of(offset.handleInputRows(0, frames(tables), At(0)))) == n
    assert sum(sorted_rows) <= 4 * n

    sorted_rows.clear()
    first = processors.FirstSeen([], 1000)
    first.seen = Value()
    seen = [t.rename_columns(["seen_key", "v", "m", "et", "et_ms"]) for t in tables]
    assert len(rows_of(first.handleInputRows(0, frames(seen), At(0)))) == n
    assert sum(sorted_rows) <= 4 * n


def test_versions_survive_packing_exactly():
    """Large numbers beside NULLs, decimals, and the same version delivered twice."""
    from decimal import Decimal

    schema = pa.schema([("id", pa.string()), ("v", pa.int64()), ("m", pa.decimal128(16, 2)), ("et", pa.timestamp("us", "UTC")), ("et_ms", pa.int64())])
    big = 2**53
    rows = [("a", big + 1, Decimal("1.10")), ("a", None, None), ("a", big, Decimal("2.20")), ("b", 1, Decimal("3.30")), ("b", 1, Decimal("3.30"))]
    table = pa.Table.from_pylist([{"id": i, "v": v, "m": m, "et": 0, "et_ms": 0} for i, v, m in rows], schema)
    offset = processors.OffsetVersions(["id"], ["v"], ["m"], "et", 1000)
    offset.latest = Value()
    got = [(r["id"], r["v"], r["m"]) for r in rows_of(offset.handleInputRows(0, frames([table]), At(0)))]
    undone = [("a", None, None), ("a", big, Decimal("-2.20")), ("b", 1, Decimal("-3.30"))]
    assert sorted(got, key=repr) == sorted(rows + undone, key=repr)
    assert {(r["id"], r["v"]) for r in processors.unpack(offset.latest.value[0]).to_pylist()} == {("a", big + 1), ("b", 1)}


class Handle:
    """Counts what each bucket asks of the state store."""

    def __init__(self):
        self.calls, self.timers, self.value = 0, [], Value()

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value.get()

    def update(self, value):
        self.calls += 1
        self.value.update(value)

    def clear(self):
        self.value.clear()

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)


def test_latest_versions_of_a_bucket_share_state_and_timer():
    handle = Handle()
    latest = processors.LatestInBucket(["id"], ["v"], 10)
    latest.init(handle)

    def rows(*triples):
        return pa.Table.from_pylist([{"id": i, "v": v, "_at_ms": at} for i, v, at in triples], pa.schema([("id", pa.string()), ("v", pa.int64()), ("_at_ms", pa.int64())]))

    many = rows(*[(f"k{i}", v, 100 + v) for i in range(500) for v in (2, 1)], (None, None, 101), (None, 7, 103))
    assert rows_of(latest.handleInputRows(0, frames([many]), At(0))) == []
    assert handle.calls <= 3 and handle.timers == [111]
    # An earlier time that comes later does not move the end of the while; k0 gets a newer version.
    assert rows_of(latest.handleInputRows(0, frames([rows(("k0", 3, 50))]), At(90))) == []
    out = rows_of(latest.handleExpiredTimer(0, At(111), None))
    assert len(out) == 501 and {r["id"]: r["v"] for r in out}["k0"] == 3 and {r["id"]: r["v"] for r in out}[None] == 7
    assert processors.unpack(handle.value.get()[0]).num_rows == 0


def test_early_joins_of_a_bucket_share_state_and_timer():
    handle = Handle()
    early = processors.EarlyLeftJoin(["k0"], 1, 10)
    early.init(handle)

    def rows(*four):
        return pa.Table.from_pylist([{"k0": k, "side": s, "at": at, "row": r} for k, s, at, r in four], pa.schema([("k0", pa.string()), ("side", pa.int32()), ("at", pa.int64()), ("row", pa.string())]))

    out = rows_of(early.handleInputRows(0, frames([rows(*[(f"k{i}", 0, 100, f"L{i}") for i in range(500)])]), At(0)))
    assert len(out) == 500 and all(r["sign"] == 1 and r["ver"] == 1 and r["rows"][1] is None for r in out)
    assert handle.calls <= 3 and handle.timers == [111]
    out = rows_of(early.handleInputRows(0, frames([rows(("k7", 1, 105, "R7"), ("k8", 1, 190, "R8"))]), At(0)))
    assert [(r["sign"], r["ver"], r["rows"]) for r in out] == [(-1, 2, ["L7", None]), (1, 3, ["L7", "R7"])]
    list(early.handleExpiredTimer(0, At(150), None))
    assert sorted(r["row"] for r in processors.unpack(handle.value.get()[0]).to_pylist()) == ["L8", "R8"]


def searched(spark, folder, parts):
    """Searches of (second of 2024-01-01, phrase), one micro-batch a part."""
    start = pd.Timestamp("2024-01-01", tz="UTC")
    save_parts([pd.DataFrame({"item": [p for _, p in part], "et": [start + pd.Timedelta(seconds=s) for s, _ in part]}) for part in parts], folder)
    rows = spark.readStream.schema("item string, et timestamp").option("maxFilesPerTrigger", 1).parquet(folder)
    return rows.select(F.struct(F.lit("home").alias("last_page_id"), F.lit("list").alias("page_id"), F.lit("keyword").alias("item_type"), "item").alias("page"), "et")


def drained(spark, rows, out):
    query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-ck").trigger(availableNow=True).start()
    query.awaitTermination()
    return collect(spark.read.parquet(out)), query.recentProgress


def test_words_are_counted_as_the_windowed_aggregate_counts_them(spark, tmp_path):
    """Also behind the watermark while the window is open; what comes after it has closed is left out."""
    parts = [
        [(1, "a b"), (5, "a")],
        [(3, "a c"), (8, "b b")],
        [(12, "a"), (14, None), (13, "")],
        [(4, "a z"), (25, "z")],
        [(4, "a y"), (24, "a"), (41, "a")],
        [(6, "a"), (7, "c"), (25, "late a"), (42, "open")],
    ]
    pages = searched(spark, str(tmp_path / "in"), parts)
    got, _ = drained(spark, summaries.keyword_counts(pages), str(tmp_path / "packed"))
    words = logs.lateral_split_words(logs.search_keywords(pages))
    plain = tumble_agg(words, ["word"], [F.count(F.lit(1)).alias("keyword_count")]).withColumnRenamed("word", "keyword")
    want, _ = drained(spark, plain, str(tmp_path / "plain"))
    assert got == want and ("2024-01-01", "2024-01-01 00:00:10", "a", 4, "2024-01-01 00:00:00") in [(r[0], r[1], r[2], r[3], r[4]) for r in got]


def test_state_is_buckets_not_words(spark, tmp_path):
    """Twenty thousand words in open windows: a state row for each would make the state as large as the log."""
    parts = [[(n % 60, " ".join(f"w{n}x{i}" for i in range(200))) for n in range(100)]]
    _, progress = drained(spark, summaries.keyword_counts(searched(spark, str(tmp_path / "in"), parts), delay="1 hour"), str(tmp_path / "out"))
    assert sum(op["numRowsTotal"] for op in progress[-1]["stateOperators"]) <= 4 * 256
