"""Stateful processors behind the keyed operators.

The pandas variant of the interface builds one data frame per key, which took two to four times as
long as plain rows for keys with a row or two; it is used where keys are bucketed. State is only
what later rows depend on. No timer per key cleans it up: each costs several calls to the JVM.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


# Fixed value: rows that are packed, and compared, at a time. A task holds a few such pieces.
PIECE = 100_000
# Fixed value: bytes of rows that a task packs by bucket at a time. Larger packs are fewer and smaller in all.
PACKED = 64 << 20


def rank(row: Row, columns: list[str]) -> tuple:
    """Sorts like Spark does: NULLs first."""
    return tuple((row[c] is not None, row[c]) for c in columns)


class FirstOfDay(StatefulProcessor):
    """Emit the first row of each day of a key, with the day before it on which the key occurred.

    State is the key's days that the watermark has not passed, and the newest one it has: one small
    value per key, kept for ever, as "first ever" and "back after a gap" demand.
    """

    def __init__(self, keys: list[str], payload: list[str]):
        self.payload = payload
        self.make = Row(*keys, "day", "et", *payload, "prev_day")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.days = handle.getValueState("days", "days string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        order = ["et", *self.payload]
        first: dict[str, Row] = {}
        for row in rows:
            best = first.get(row["day"])
            if best is None or rank(row, order) < rank(best, order):
                first[row["day"]] = row
        value = self.days.get()
        ends = json.loads(value[0]) if value else {}
        fresh = sorted(day for day in first if day not in ends)
        if not fresh:
            return
        ends.update({day: first[day]["day_end"] for day in fresh})
        known = sorted(ends)
        for day in fresh:
            row, i = first[day], known.index(day)
            previous = known[i - 1] if i else None
            yield self.make(*key, day, row["et"], *[row[c] for c in self.payload], previous)
        limit = timerValues.getCurrentWatermarkInMs()
        for day in [day for day in known if ends[day] <= limit][:-1]:
            del ends[day]
        self.days.update((json.dumps(ends),))

    def close(self) -> None:
        pass


class FixNewFlag(StatefulProcessor):
    """Judge rows flagged new against the first day of their device, kept for ever.

    Rows are ``et``, ``day``, ``flag`` and ``row``; those without ``row`` only help to find the
    first record.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.new_day = handle.getValueState("new_day", "new_day string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        value = self.new_day.get()
        if value:
            new_day = value[0]
        else:
            # The earliest record decides, so the device's first micro-batch is read to its end.
            rows = list(rows)
            first = min(rows, key=lambda r: rank(r, ["et", "flag"]))
            new_day = first["day"] if first["flag"] == "1" else ""
            self.new_day.update((new_day,))
        for row in rows:
            if row["row"] is not None:
                is_new = "1" if row["day"] == new_day else "0"
                yield Row(et=row["et"], row=row["row"], is_new=is_new)

    def close(self) -> None:
        pass


def pack(rows: pa.Table) -> bytes:
    """Rows as Arrow bytes, which keep every type exactly."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(rows)
    return out.getvalue().to_pybytes()


def unpack(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.BufferReader(data)).read_all()


def joined(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).combine_chunks()


def gathered(frames: Iterator[pd.DataFrame], held: Callable[[], int]) -> Iterator[pa.Table]:
    """Packed rows in tables of at least as many rows as are held: what is held is then gone through a few times, not once a frame."""
    parts, n = [], 0
    for pdf in frames:
        for data in pdf["rows"]:
            parts.append(unpack(data))
            n += parts[-1].num_rows
            if n >= max(held(), PIECE):
                yield joined(parts)
                parts, n = [], 0
    if parts:
        yield joined(parts)


def on_time(rows: pa.Table, at: str, watermark: int | None) -> pa.Table:
    """Without the late rows of a pack: those behind the watermark that the bucket was last called with."""
    return rows.filter(pc.greater_equal(rows[at], watermark)) if watermark else rows


def ordered(rows: pa.Table, columns: list[str]) -> pa.Table:
    """Sorts like Spark does: NULLs first. Rows that agree stay in their order."""
    by = [(c, "ascending") for c in columns]
    return rows.take(pc.sort_indices(rows, sort_keys=by, null_placement="at_start"))


def repeated(rows: pa.Table, columns: list[str], keep: str) -> pa.Array:
    """Whether a row is not the first (or last) one with its values."""
    return pa.array(rows.select(columns).to_pandas(use_threads=False).duplicated(keep=keep).to_numpy())


def newest(rows: pa.Table, et: str) -> pd.DataFrame:
    """A packed row of output, dated by the newest row in it."""
    return pd.DataFrame({"_et": [pd.Timestamp(pc.max(rows[et].cast(pa.int64())).as_py(), unit="us", tz="UTC")], "rows": [pack(rows)]})


class OffsetVersions(StatefulProcessor):
    """Pass rows on, and every replaced version once more with negated measures.

    Works on a bucket of keys at a time, packed, so that a micro-batch costs one state read and write per
    bucket and whole tables are compared at once. State is the latest version of each key,
    until the watermark is ``ttl_ms`` past it. A version the watermark has passed is not undone: its
    window is closed.
    """

    def __init__(self, keys: list[str], order: list[str], measures: list[str], et: str, ttl_ms: int, columns: list[str] | None = None):
        self.keys, self.order, self.measures, self.et, self.ttl_ms, self.columns = keys, order, measures, et, ttl_ms, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", "rows binary, watermark bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        watermark = timerValues.getCurrentWatermarkInMs()
        value = self.latest.get()
        held, before = (unpack(bytes(value[0])), value[1]) if value else (None, None)
        for table in gathered(rows, lambda: 0 if held is None else held.num_rows):
            table = on_time(table, "et_ms", before)
            if not table.num_rows:
                continue
            known = table if held is None else joined([held, table])
            # Only keys with several versions have to be put in order.
            several = pa.array(known.select(self.keys).to_pandas(use_threads=False).duplicated(keep=False).to_numpy())
            single, known = known.filter(pc.invert(several)), ordered(known.filter(several), [*self.keys, *self.order])
            replaced = repeated(known, self.keys, "last")
            undone = known.filter(pc.and_(replaced, pc.greater_equal(known["et_ms"], watermark)))
            for m in self.measures:
                undone = undone.set_column(undone.schema.get_field_index(m), undone.schema.field(m), pc.negate(undone[m]))
            held = joined([single, known.filter(pc.invert(replaced))])
            names = self.columns or table.column_names
            yield newest(joined([table.select(names), undone.select(names)]), self.et)
        if held is not None:
            self.latest.update((pack(held.filter(pc.greater(held["et_ms"], watermark - self.ttl_ms))), watermark))

    def close(self) -> None:
        pass


class FirstSeen(StatefulProcessor):
    """Emit the first row of each key, a bucket of keys at a time.

    A key is forgotten when the watermark is ``ttl_ms`` past the row it was first seen in.
    """

    def __init__(self, payload: list[str], ttl_ms: int):
        self.order, self.ttl_ms = ["et", *payload], ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "rows binary, watermark bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        value = self.seen.get()
        before = value[1] if value else None
        first = None
        for table in gathered(rows, lambda: 0 if first is None else first.num_rows):
            table = on_time(table, "et_ms", before)
            first = first_rows(table if first is None else joined([first, table]), ["seen_key"], self.order)
        if first is None:
            return
        held = unpack(bytes(value[0])) if value else first.select(["seen_key", "et_ms"]).slice(0, 0)
        fresh = first.filter(pc.invert(pc.is_in(first["seen_key"], value_set=held["seen_key"].combine_chunks())))
        if fresh.num_rows:
            held = pa.concat_tables([held, fresh.select(["seen_key", "et_ms"])])
            watermark = timerValues.getCurrentWatermarkInMs()
            self.seen.update((pack(held.filter(pc.greater(held["et_ms"], watermark - self.ttl_ms))), watermark))
            yield newest(fresh.select(self.order), "et")

    def close(self) -> None:
        pass


def first_rows(rows: pa.Table, keys: list[str], order: list[str]) -> pa.Table:
    rows = ordered(rows, order)
    return rows.filter(pc.invert(repeated(rows, keys, "first")))


def window_counts(rows: pa.Table) -> pa.Table:
    """Rows with the end of their window as ``_et``, counted by window and key."""
    counted = rows.group_by(["_bucket", "_et", "key"], use_threads=False).aggregate([([], "count_all")])
    return counted.rename_columns(["_bucket", "_et", "key", "n"]).append_column("end_us", counted["_et"].cast(pa.int64()))


class WindowCounts(StatefulProcessor):
    """Add up the counts of each window and key of a bucket, and emit them when the watermark is past the window's end.

    State is the counts of open windows; one timer a bucket looks for those that have closed.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "rows binary, watermark bigint")

    def _closed(self, counts: pa.Table, watermark: int) -> Iterator[pd.DataFrame]:
        """Emit the counts of closed windows, in pieces, and hold the others."""
        over = pc.less_equal(counts["end_us"], watermark * 1000)
        closed, held = counts.filter(over), counts.filter(pc.invert(over))
        for at in range(0, closed.num_rows, PIECE):
            yield pd.DataFrame({"rows": [pack(closed.slice(at, PIECE))]})
        self.open.update((pack(held), watermark))
        if held.num_rows:
            self.handle.registerTimer(-(-pc.min(held["end_us"]).as_py() // 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        value = self.open.get()
        held, before = (unpack(bytes(value[0])), value[1]) if value else (None, None)
        for table in gathered(rows, lambda: 0 if held is None else held.num_rows):
            if before:
                table = table.filter(pc.greater(table["end_us"], before * 1000))
            names = ["end_us", "key", "n"]
            table = table.select(names) if held is None else joined([held, table.select(names)])
            added = table.group_by(names[:2], use_threads=False).aggregate([("n", "sum")])
            held = added.rename_columns(names)
        if held is not None:
            yield from self._closed(held, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        value = self.open.get()
        if value:
            yield from self._closed(unpack(bytes(value[0])), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


class LatestAfterDelay(StatefulProcessor):
    """Hold the latest version of a key for a while, then emit it once.

    The while starts when the first version held arrives.
    """

    def __init__(self, columns: list[str], order: list[str], delay_ms: int):
        self.columns, self.make = columns, Row(*columns)
        self.order, self.delay_ms = order, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "row binary, due bigint")

    def _load(self) -> tuple[Row | None, int]:
        value = self.last.get()
        return (self.make(*pickle.loads(bytes(value[0]))), value[1]) if value else (None, 0)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last, due = self._load()
        fresh = last is None
        for row in rows:
            if last is None or rank(row, self.order) >= rank(last, self.order):
                last = row
        if fresh:
            due = self.delay_ms + timerValues.getCurrentProcessingTimeInMs()
            self.handle.registerTimer(due)
        self.last.update((pickle.dumps(tuple(last[c] for c in self.columns), protocol=4), due))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        row, due = self._load()
        if row is not None and due <= expiredTimerInfo.getExpiryTimeInMs():
            self.last.clear()
            yield row

    def close(self) -> None:
        pass


class LatestInBucket(StatefulProcessor):
    """Hold the latest version of each key of a bucket until the watermark is ``delay_ms`` past the first, then emit it once.

    The first is the least ``_at_ms`` of the micro-batch in which the key was not held. State is the versions held; one
    timer a bucket looks for those whose time is over.
    """

    def __init__(self, keys: list[str], order: list[str], delay_ms: int):
        self.keys, self.order, self.delay_ms = keys, order, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "rows binary, watermark bigint")

    def _split(self, watermark: int) -> tuple[pa.Table | None, pa.Table | None, int | None]:
        """Versions whose time is over, those still held, and the watermark before."""
        value = self.held.get()
        if not value:
            return None, None, None
        held = unpack(bytes(value[0]))
        over = pc.less_equal(held["_at_ms"], watermark - self.delay_ms)
        return held.filter(over), held.filter(pc.invert(over)), value[1]

    def _hold(self, held: pa.Table, watermark: int) -> None:
        self.held.update((pack(held), watermark))
        if held.num_rows:
            self.handle.registerTimer(pc.min(held["_at_ms"]).as_py() + self.delay_ms)

    def _latest(self, rows: pa.Table) -> pa.Table:
        rows = ordered(rows, self.order)
        return rows.filter(pc.invert(repeated(rows, self.keys, "last")))

    def _starting(self, rows: pa.Table, starts: pa.Table) -> pa.Table:
        """Rows, one a key, with the time of the first row of their key in ``starts``."""
        starts = starts.filter(pc.invert(repeated(starts, self.keys, "first")))
        at = [(c, "ascending") for c in self.keys]
        rows, starts = (t.take(pc.sort_indices(t, sort_keys=at)) for t in (rows, starts))
        return rows.set_column(rows.schema.get_field_index("_at_ms"), "_at_ms", starts["_at_ms"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        over, held, before = self._split(timerValues.getCurrentWatermarkInMs())
        if over is not None and over.num_rows:
            yield pd.DataFrame({"rows": [pack(over)]})  # their time is over, though the timer is only looked at after these rows
        fresh = None
        for table in gathered(rows, lambda: 0 if fresh is None else fresh.num_rows):
            table = on_time(table, "_at_ms", before)
            known = table if fresh is None else joined([fresh, table])
            fresh = self._starting(self._latest(known), ordered(known, ["_at_ms"]))
        if held is not None and held.num_rows:
            known = joined([held, fresh])
            fresh = self._starting(self._latest(known), known)
        if fresh is not None:
            self._hold(fresh, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        over, held, _ = self._split(timerValues.getCurrentWatermarkInMs())
        if over is not None and over.num_rows:
            yield pd.DataFrame({"rows": [pack(over)]})
            self._hold(held, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


class Normalise(StatefulProcessor):
    """Keyed records to added and retracted ones: the newest record of a key replaces the one before it.

    Of a micro-batch only the newest record counts, so nothing but it is held. State is the newest record, with Spark's
    time to live if one is given.
    """

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "value string, seq bigint", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest = None
        for row in rows:
            if newest is None or (row["seq"], row["value"] or "") > (newest["seq"], newest["value"] or ""):
                newest = row
        held = self.last.get()
        before, at = held if held else (None, None)
        if newest is None or (at is not None and newest["seq"] <= at):
            return
        self.last.update((newest["value"], newest["seq"]))
        if newest["value"] == before:
            return
        if before is not None:
            yield Row(op="-U" if newest["value"] is not None else "-D", value=before, seq=newest["seq"])
        if newest["value"] is not None:
            yield Row(op="+I" if before is None else "+U", value=newest["value"], seq=newest["seq"])

    def close(self) -> None:
        pass


class FirstSeenByKey(StatefulProcessor):
    """Emit the first row of a key, and again once Spark's time to live has dropped the key."""

    def __init__(self, payload: list[str], ttl_ms: int):
        self.order, self.ttl_ms = ["et", *payload], ttl_ms
        self.make = Row(*self.order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first = min(rows, key=lambda r: rank(r, self.order))
        if not self.seen.exists():
            self.seen.update((True,))
            yield self.make(*[first[c] for c in self.order])

    def close(self) -> None:
        pass


class OffsetByKey(StatefulProcessor):
    """Pass the versions of a key on, and each replaced one once more with negated measures.

    Only the newest version is held, by Spark's time to live. A version that comes late is taken back at once.
    """

    def __init__(self, columns: list[str], order: list[str], measures: list[str], ttl_ms: int):
        self.columns, self.order, self.measures, self.ttl_ms = columns, order, measures, ttl_ms
        self.make = Row(*columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", "row binary", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        value = self.latest.get()
        last = held = self.make(*pickle.loads(bytes(value[0]))) if value else None
        for row in rows:
            at = rank(row, self.order)
            if last is not None and at == rank(last, self.order):
                continue  # the same version delivered again
            yield self.make(*[row[c] for c in self.columns])
            late = last is not None and at < rank(last, self.order)
            gone = row if late else last
            if gone is not None:
                undone = [-gone[c] if c in self.measures and gone[c] is not None else gone[c] for c in self.columns]
                yield self.make(*undone)
            if not late:
                last = row
        if last is not held:
            self.latest.update((pickle.dumps(tuple(last[c] for c in self.columns), protocol=4),))

    def close(self) -> None:
        pass


class InnerJoin(StatefulProcessor):
    """Pairs of left and right rows with equal keys whose times are at most ``bound_us`` apart, a bucket of keys at a time.

    Packs hold rows of one side each, with their time ``et`` in microseconds as ``_left`` or ``_right``; right columns begin with
    ``_r_``. Fresh rows meet what is held and each other, held ones do not meet again. State is the rows that can still
    meet rows on time: dropped with the next rows of the bucket, or by a timer when all of them are over.
    """

    def __init__(self, pairs: list[tuple[str, str]], columns: list[str], et: str, bound_us: int):
        self.pairs, self.columns, self.et, self.bound_us = pairs, columns, et, bound_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "left_rows binary, right_rows binary, watermark bigint")

    def _met(self, left: pa.Table | None, right: pa.Table | None) -> pa.Table | None:
        if left is None or right is None or not left.num_rows or not right.num_rows:
            return None
        names = [f"k{i}" for i in range(len(self.pairs))]
        sides = [
            pa.Table.from_arrays([*[t[pair[n]] for pair in self.pairs], pa.array(np.arange(t.num_rows))], names=[*names, at])
            for n, (t, at) in enumerate(((left, "i"), (right, "j")))
        ]
        found = sides[0].join(sides[1], names, join_type="inner", use_threads=False)
        i, j = found["i"].to_numpy(), found["j"].to_numpy()
        near = np.abs(left["_left"].to_numpy()[i] - right["_right"].to_numpy()[j]) <= self.bound_us
        i, j = i[near], j[near]
        i, j = pa.array(i), pa.array(j)
        made = {c: left[c].take(i) for c in self.columns if c in left.column_names}
        made[self.et] = left["_left"].take(i).cast(pa.timestamp("us", "UTC"))
        made |= {c: right[f"_r_{c}"].take(j) for c in self.columns if c not in made}
        return pa.table({c: made[c] for c in self.columns})

    def _load(self) -> tuple[list[pa.Table | None], int | None]:
        value = self.held.get()
        return ([unpack(bytes(data)) if data is not None else None for data in value[:2]], value[2]) if value else ([None, None], None)

    def _hold(self, sides: list[pa.Table | None], watermark: int) -> None:
        until, kept = None, []
        for rows, at in zip(sides, ("_left", "_right"), strict=True):
            if rows is not None:
                rows = rows.filter(pc.greater_equal(rows[at], watermark * 1000 - self.bound_us))
                if rows.num_rows:
                    until = max(until or 0, (pc.max(rows[at]).as_py() + self.bound_us) // 1000)
            kept.append(pack(rows) if rows is not None and rows.num_rows else None)
        self.held.update((*kept, watermark))
        if until is not None:
            self.handle.registerTimer(until + 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, before = self._load()
        parts: list[list[pa.Table]] = [[], []]

        def meet() -> Iterator[pd.DataFrame]:
            fresh = [joined(p) if p else None for p in parts]
            newest = max(pc.max(t[at]).as_py() for t, at in zip(fresh, ("_left", "_right"), strict=True) if t is not None)
            made = [self._met(fresh[0], fresh[1]), self._met(fresh[0], held[1]), self._met(held[0], fresh[1])]
            for n, t in enumerate(fresh):
                if t is not None:
                    held[n] = t if held[n] is None else joined([held[n], t])
                parts[n].clear()
            for pairs in made:
                # Dated by the newest of the fresh rows: a pair can be older than the watermark.
                for at in range(0, 0 if pairs is None else pairs.num_rows, PIECE):
                    yield pd.DataFrame({"_et": [pd.Timestamp(newest, unit="us", tz="UTC")], "rows": [pack(pairs.slice(at, PIECE))]})

        n = 0
        for pdf in rows:
            for data in pdf["rows"]:
                table = unpack(data)
                side = int("_right" in table.column_names)
                table = on_time(table, ("_left", "_right")[side], before and before * 1000)
                if table.num_rows:
                    parts[side].append(table)
                    n += table.num_rows
                if n >= max(PIECE, *[0 if t is None else t.num_rows for t in held]):
                    yield from meet()
                    n = 0
        if n:
            yield from meet()
        self._hold(held, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._hold(self._load()[0], timerValues.getCurrentWatermarkInMs())
        return iter(())

    def close(self) -> None:
        pass


def as_text(value: object) -> str:
    """A row as text, by which equal rows are told."""
    if isinstance(value, dict):
        return json.dumps({k: v for k, v in value.items() if v is not None}, default=str, ensure_ascii=False, separators=(",", ":"))
    return str(value)


class EarlyLeftJoin(StatefulProcessor):
    """Left rows joined with what is there, corrected when more comes: each change takes back what it replaces.

    Works on a bucket of keys. Rows are ``side`` (0: left), ``at`` (event time in ms) and ``row`` (text or a struct). State is the rows
    of a key within the bound, with the writes of the key so far (``n``) and the time ``until`` which it can meet others:
    dropped with the next rows of the bucket once the watermark is past it, or by a timer when the whole bucket is.
    Rows may be ``behind_ms`` behind the watermark: it is taken to be that much earlier.
    """

    def __init__(self, keys: list[str], sides: int, bound_ms: int, behind_ms: int = 0):
        self.keys, self.sides, self.bound_ms, self.behind_ms = keys, sides, bound_ms, behind_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "rows binary, watermark bigint")

    def _joined(self, rows: list) -> dict[tuple, int]:
        """How often each combination of a left row and its matches occurs, NULL where a side has none."""
        found: dict[tuple, int] = {}
        for _, at, left in (r for r in rows if r[0] == 0):
            made = [(left,)]
            for side in range(1, self.sides + 1):
                match = [r[2] for r in rows if r[0] == side and abs(r[1] - at) <= self.bound_ms] or [None]
                made = [(*m, x) for m in made for x in match]
            for m in made:
                found[m] = found.get(m, 0) + 1
        return found

    def _writes(self, known: list, every: list, n: int) -> list[tuple]:
        """What a key writes that has several rows of a side, after ``n`` writes."""
        before, after = self._joined(known), self._joined(every)
        out = []
        for sign in (-1, 1):
            for made in sorted({**before, **after}, key=str):
                change = after.get(made, 0) - before.get(made, 0)
                for _ in range(max(0, sign * change)):
                    n += 1
                    out.append((sign, n, made))
        return out

    def _watermark(self, timerValues) -> int:
        return max(0, timerValues.getCurrentWatermarkInMs() - self.behind_ms)

    def _hold(self, held: pa.Table, watermark: int) -> None:
        held = held.filter(pc.greater_equal(held["until"], watermark))
        self.held.update((pack(held), watermark))
        if held.num_rows:
            self.handle.registerTimer(pc.max(held["until"]).as_py() + 1 + self.behind_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = joined([unpack(data) for pdf in rows for data in pdf["rows"]])
        value = self.held.get()
        held = unpack(bytes(value[0])) if value else None
        fresh = on_time(fresh, "at", value[1] if value else None)
        if not fresh.num_rows:
            return
        names = [*self.keys, "side", "at", "row"]
        every, old, writes = fresh.select(names), 0, np.zeros(0, np.int64)
        if held is not None:
            touched = pc.is_in(held[self.keys[0]], value_set=fresh[self.keys[0]].combine_chunks())
            meets, held = held.filter(touched), held.filter(pc.invert(touched))
            every, old, writes = joined([meets.select(names), every]), meets.num_rows, meets["n"].to_numpy()
        # Rows are numbered, those held first, and so are their keys.
        of = every.select(self.keys).to_pandas(use_threads=False).groupby(self.keys, sort=False, dropna=False).ngroup().to_numpy()
        side, time, row = every["side"].to_numpy(), every["at"].to_numpy(), every["row"].combine_chunks()
        keys, width = int(of.max()) + 1, self.sides + 1
        several = (np.bincount(of * width + side, minlength=keys * width).reshape(keys, width) > 1).any(axis=1)
        n, until, added = np.zeros(keys, np.int64), np.full(keys, np.iinfo(np.int64).min), np.zeros(keys, bool)
        n[of[:old]] = writes
        added[of[old:]] = True
        np.maximum.at(until, of, time)
        # Where no side of a key has several rows, a key is one line of row numbers, -1 for none.
        at = np.full((keys, width), -1)
        at[of, side] = np.arange(len(of))
        one = np.flatnonzero(added & ~several & (at[:, 0] >= 0))
        at = at[one]
        after = np.where((at >= 0) & (np.abs(time[at] - time[at[:, :1]]) <= self.bound_ms), at, -1)
        before = np.where(after < old, after, -1)
        again = (at[:, 0] < old) & (after[:, 1:] >= old).any(axis=1)
        now = (at[:, 0] >= old) | again
        signs = [np.full(again.sum(), -1), np.full(now.sum(), 1)]
        vers = [n[one][again] + 1, (n[one] + again + 1)[now]]
        made = [before[again], after[now]]
        n[one] += now.astype(np.int64) + again
        many: dict[int, list[int]] = {}
        for i in np.flatnonzero((added & several)[of]).tolist():
            many.setdefault(int(of[i]), []).append(i)
        for k, places in many.items():
            texts = {i: as_text(row[i].as_py()) for i in places}
            whole = [(int(side[i]), int(time[i]), texts[i]) for i in places]
            found = self._writes(whole[: sum(i < old for i in places)], whole, int(n[k]))
            place = {(s, text): i for i, (s, _, text) in zip(places, whole, strict=True)}
            n[k] += len(found)
            signs.append(np.array([f[0] for f in found], np.int64))
            vers.append(np.array([f[1] for f in found], np.int64))
            made.append(np.array([[place.get((s, text), -1) for s, text in enumerate(f[2])] for f in found], np.int64).reshape(-1, width))
        hold = every.append_column("n", pa.array(n[of])).append_column("until", pa.array(until[of] + self.bound_ms))
        self._hold(hold if held is None else joined([held, hold]), self._watermark(timerValues))
        made = np.concatenate(made)
        if len(made):
            cells = row.take(pa.array(made.ravel(), mask=made.ravel() < 0))
            out = every.select(self.keys).take(pa.array(made[:, 0]))
            out = out.append_column("sign", pa.array(np.concatenate(signs), pa.int32())).append_column("ver", pa.array(np.concatenate(vers)))
            out = out.append_column("rows", pa.ListArray.from_arrays(pa.array(np.arange(0, made.size + 1, width), pa.int32()), cells))
            yield pd.DataFrame({"rows": [pack(out)]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        value = self.held.get()
        if value:
            self._hold(unpack(bytes(value[0])), self._watermark(timerValues))
        return iter(())

    def close(self) -> None:
        pass
