"""State processors with timers by event time: a group's rows are taken in order once the watermark has passed them.

Rows wait in a map state, some thousands as one value, so that a batch of a hot group is neither gathered in a frame nor put in order as a whole, and what
came out of order within the watermark's delay is taken in its place. What is due is taken by columns, and results leave in blocks. They need the RocksDB state store.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Rows that wait as one value, rows that are put in order at once, and rows of a result that leave as one.
CHUNK, ORDERED, GIVEN = 20_000, 1_000_000, 10_000
#: Parts of the time that is due, to cut it into runs of ORDERED rows.
PARTS = 1_024
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run(rows: DataFrame, by: str, processor: "InOrder", schema: str) -> DataFrame:
    """The rows that a processor gives for the groups of a stream with a watermark."""
    spark = rows.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    key, *gives = schema.split(", ")
    processor.gives = [c.split()[0] for c in (key, *gives)]
    blocks = ", ".join([key, *["{} array<{}>".format(*c.split()) for c in gives]])
    given = rows.groupBy(by).transformWithState(processor, blocks, "append", "eventTime")
    return given.select(by, F.inline(F.arrays_zip(*processor.gives[1:])))


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(packed)).read_all()


def _together(parts: list[pa.Table]) -> pa.Table:
    """Tables as one; a column without values in one of them has the others' type."""
    return pa.concat_tables(parts, promote_options="permissive")


def _longs(column: pa.ChunkedArray, null: int = 0) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), null).to_numpy()


class InOrder(StatefulProcessor):
    """What all have in common: a map state of waiting rows by chunk, when the first of them is due, and timers.

    A subclass has `waits` (the waiting rows' columns, `sec` and what orders rows of one second first), `known` (the schema of what a group's rows lead to),
    load(known or None), take(rows), passed(now) and saved(), which is the known state (None: forget the group) and the next time to be called.
    take() gets rows in order as a table and gives columns, passed() gives columns too; runs of rows come one after the other.
    """

    waits: list[str]
    known: str
    gives: list[str]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.row = Row(*self.gives)
        self.waiting = handle.getMapState("waiting", "chunk long", "low long, high long, rows binary")
        self.first = handle.getValueState("first", "begin long, end long, sec long, n long")
        self.state = handle.getValueState("known", self.known)
        self.more(handle)

    def more(self, handle: StatefulProcessorHandle) -> None:
        """Further states of a subclass."""

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        begin, end, first, n = self.first.get() if self.first.exists() else (0, 0, None, 0)
        before = first
        while chunk := list(islice(rows, CHUNK)):
            columns = dict(zip(chunk[0].__fields__, zip(*chunk, strict=True), strict=True))
            table = pa.table({c: pa.array(columns[c], pa.int64() if c == "sec" else None) for c in self.waits})
            table = table.filter(pc.is_valid(table["sec"]))  # no time, no place in the order
            if table.num_rows:
                low = self.wait(end, table)
                first = low if first is None else min(first, low)
                end, n = end + 1, n + table.num_rows
        if n:
            self.first.update((begin, end, first, n))
            if first != before:
                self.wake(first, timerValues)
        return iter(())

    def wait(self, chunk: int, table: pa.Table) -> int:
        """Keep a chunk; its least time."""
        span = pc.min_max(table["sec"]).as_py()
        self.waiting.updateValue((chunk,), (span["min"], span["max"], _packed(table)))
        return span["min"]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() // 1000
        self.load(self.state.get() if self.state.exists() else None)
        begin, end, first, n = self.first.get() if self.first.exists() else (0, 0, None, 0)
        if first is not None and first <= now:
            for low, high in self.runs(Times(self, begin, end), first, now, n):
                due = [self.between(t, low, high) for a, z, t in self.chunks(begin, end) if a < high and z >= low]
                due = _together(due)
                if due.num_rows:
                    due = due.take(pc.sort_indices(due, [(c, "ascending") for c in self.waits], null_placement="at_start"))
                    yield from self.blocks(key, self.take(due.combine_chunks()))
            left = self.leave(begin, end, now)
            if left:
                self.first.update(left)
                self.wake(left[2], timerValues)
            else:
                self.first.clear()
        yield from self.blocks(key, self.passed(now))
        known, at = self.saved(now)
        if known is None:
            if self.state.exists():
                self.state.clear()
        else:
            self.state.update(known)
        if at is not None:
            self.wake(at, timerValues)

    def chunks(self, begin: int, end: int) -> Iterator[tuple[int, int, pa.Table]]:
        """The waiting chunks with their least and greatest times, one at a time."""
        for i in range(begin, end):
            low, high, rows = self.waiting.getValue((i,))
            yield low, high, _unpacked(rows)

    @staticmethod
    def between(rows: pa.Table, low: int, high: int) -> pa.Table:
        at = rows["sec"]
        return rows.filter(pc.and_(pc.greater_equal(at, low), pc.less(at, high)))

    def leave(self, begin: int, end: int, now: int) -> tuple[int, int, int, int] | None:
        """Drop what was due; the chunks that are left, their first time and number of rows."""
        to, first, n, held, rest = end, None, 0, 0, []
        for i in range(begin, end):
            low, high, rows = self.waiting.getValue((i,))
            if high > now:
                rest.append(_unpacked(rows) if low > now else self.between(_unpacked(rows), now + 1, high + 1))
                held += rest[-1].num_rows
            self.waiting.removeKey((i,))
            if held and (held >= CHUNK or i == end - 1):
                low = self.wait(to, _together(rest))
                to, first, n, held, rest = to + 1, low if first is None else min(first, low), n + held, 0, []
        return (end, to, first, n) if n else None

    def blocks(self, key, given) -> Iterator[Row]:
        """Columns of results as rows of arrays."""
        for columns in given:
            for i in range(0, len(columns[0]), GIVEN):
                part = [c[i : i + GIVEN] for c in columns]
                yield self.row(key[0], *[c if isinstance(c, list) else c.tolist() for c in part])

    @staticmethod
    def runs(rows, first: int, now: int, n: int) -> Iterator[tuple[int, int]]:
        """Times from, until: of the due rows, about ORDERED at once. A second's rows stay together. rows.get() gives times, one or several at once."""
        if n <= ORDERED:
            yield first, now + 1
            return
        width = max(1, -(-(now + 1 - first) // PARTS))
        count = np.zeros(PARTS, np.int64)
        for r in rows.get():
            at = np.atleast_1d(r[0])
            count += np.bincount((at[at <= now] - first) // width, minlength=PARTS)
        begin, held = 0, 0
        for i, c in enumerate(count):
            if held and held + c > ORDERED:
                yield first + begin * width, first + i * width
                begin, held = i, 0
            held += int(c)
        yield first + begin * width, now + 1

    def wake(self, at: int, timerValues) -> None:
        """Be called when the watermark passes `at` (seconds), or with the next one if it has."""
        self.handle.registerTimer(max(int(at) * 1000, timerValues.getCurrentWatermarkInMs() + 1))

    def load(self, known) -> None:
        raise NotImplementedError

    def take(self, rows: pa.Table) -> Iterator[tuple]:
        raise NotImplementedError

    def passed(self, now: int) -> Iterator[tuple]:
        return iter(())

    def saved(self, now: int):
        raise NotImplementedError

    def close(self) -> None:
        pass


class Times:
    """The times of a group's waiting rows, a chunk at once."""

    def __init__(self, of: InOrder, begin: int, end: int):
        self.of, self.begin, self.end = of, begin, end

    def get(self) -> Iterator[tuple[np.ndarray]]:
        for _, _, rows in self.of.chunks(self.begin, self.end):
            yield (_longs(rows["sec"]),)


class Renewed(InOrder):
    """The keys of a group are entries of a map state; all go when `seconds` have passed since the last addition."""

    known = "last long"
    waits = ["sec", "key"]

    def __init__(self, key_type: str, seconds: int):
        self.key_type, self.seconds = key_type, seconds

    def more(self, handle):
        self.seen = handle.getMapState("seen", f"key {self.key_type}", "sec long")

    def load(self, known):
        self.last = known[0] if known else None

    def take(self, rows):
        held, empty, keys, secs = set(), False, [], []  # held: keys that are certainly in the map; each is asked for once
        for sec, key in zip(rows["sec"].to_pylist(), rows["key"].to_pylist(), strict=True):
            if self.last is not None and sec - self.last >= self.seconds:
                self.seen.clear()
                held, empty = set(), True
            if key in held:
                continue
            held.add(key)
            if empty or not self.seen.containsKey((key,)):
                self.seen.updateValue((key,), (sec,))
                self.last = sec
                keys.append(key)
                secs.append(sec)
        yield keys, secs

    def saved(self, now):
        if self.last is not None and now >= self.last + self.seconds:
            self.seen.clear()
            self.last = None
        return (None, None) if self.last is None else ((self.last,), self.last + self.seconds)


class Finished(InOrder):
    """S3: what a crawl has scheduled and done, and whether its end was told."""

    waits = ["sec", "event_id", "kind", "n"]
    known = "total long, done long, last long, told boolean"

    def __init__(self, idle: int, forget: int):
        self.idle, self.forget = idle, max(idle, forget)

    def load(self, known):
        self.total, self.done, self.last, self.told = known or (0, 0, None, False)

    def take(self, rows):
        sec, n = _longs(rows["sec"]), _longs(rows["n"])
        scheduled = np.where(pc.fill_null(pc.equal(rows["kind"].cast(pa.string()), "scheduled"), False).to_numpy(), n, 0)
        total, done = np.cumsum(scheduled), np.cumsum(n - scheduled)
        gap = np.diff(sec, prepend=sec[0] + 1 if self.last is None else self.last)
        quiet, gone = np.flatnonzero(gap >= self.idle), np.flatnonzero(gap >= self.forget)
        after = lambda places, i: int(places[k]) if (k := np.searchsorted(places, i)) < len(places) else len(sec)
        had, did, told, i, out = self.total, self.done, self.told, 0, []
        while i < len(sec):
            if told:
                i = after(gone, i)
                if i == len(sec):
                    break
                told, had, did = False, -int(total[i] - scheduled[i]), -int(done[i] - n[i] + scheduled[i])  # forgotten by then
            elif gap[i] >= self.idle:
                told = True
                out.append(("error", int(sec[i] - gap[i]) + self.idle))
                i += 1
                continue
            stop = after(quiet, i + 1)
            t, d = total[i:stop] + had, done[i:stop] + did
            full = np.flatnonzero(((t > 0) & (t <= d)) | ((t == 0) & (d > 0)))
            if len(full):
                told, i = True, i + int(full[0])
                out.append(("finished", int(sec[i])))
                i += 1
            else:
                i = stop
        self.total, self.done, self.last, self.told = int(total[-1]) + had, int(done[-1]) + did, int(sec[-1]), told
        yield [s for s, _ in out], [t for _, t in out]

    def passed(self, now):
        if self.last is not None and not self.told and now - self.last >= self.idle:
            self.told = True
            yield ["error"], [self.last + self.idle]

    def saved(self, now):
        if self.last is None or (self.told and now >= self.last + self.forget):
            return None, None
        return (self.total, self.done, self.last, self.told), self.last + (self.forget if self.told else self.idle)


class Delayed(InOrder):
    """When the latest message of an id is due, and how long it waits then."""

    waits = ["sec", "seq", "event", "update_interval", "due_date"]
    known = "due long, wait long, seq long"

    def __init__(self, default: int):
        self.default = default

    def load(self, known):
        self.due, self.wait_s, self.seq = known or (None, 0, None)

    @staticmethod
    def fired(due, wait, seq, times):
        """Of messages: each fires so many times from when it is due."""
        ends = np.cumsum(times)
        for start in range(0, int(ends[-1]), GIVEN):
            at = np.arange(start, min(start + GIVEN, int(ends[-1])))
            i = np.searchsorted(ends, at, "right")
            yield seq.take(pa.array(i)).to_pylist(), due[i] + wait[i] * (at - ends[i] + times[i])

    def passed(self, now):
        if self.due is not None and self.due <= now:
            n = (now - self.due) // self.wait_s + 1
            yield from self.fired(np.array([self.due]), np.array([self.wait_s]), pa.array([self.seq], pa.int64()), np.array([n]))
            self.due += n * self.wait_s

    def take(self, rows):
        sec, wait = _longs(rows["sec"]), _longs(rows["update_interval"])
        wait = np.where(wait == 0, self.default, wait)
        dated = pc.is_valid(rows["due_date"]).to_numpy()
        due = np.where(dated, _longs(rows["due_date"]), sec + wait)
        armed = ~pc.fill_null(pc.equal(rows["event"].cast(pa.string()), "delete"), False).to_numpy()
        seq = rows["seq"].cast(pa.int64())
        yield from self.passed(int(sec[0]))
        until = sec[1:]
        if len(until):
            yield from self.fired(due[:-1], wait[:-1], seq[:-1], np.where(armed[:-1] & (due[:-1] <= until), (until - due[:-1]) // wait[:-1] + 1, 0))
        self.due, self.wait_s, self.seq = int(due[-1]) if armed[-1] else None, int(wait[-1]), seq[-1].as_py()

    def saved(self, now):
        return (None, None) if self.due is None else ((self.due, self.wait_s, self.seq), self.due)


class Retried(InOrder):
    """Failures of an item since its last success; an item that doesn't come back is forgotten."""

    waits = ["sec", "seq", "ok"]
    known = "count long, last long"

    def __init__(self, most: int, forget: int):
        self.most, self.forget = most, forget

    def load(self, known):
        self.count, self.last = known or (0, None)

    def take(self, rows):
        sec, ok = _longs(rows["sec"]), pc.fill_null(rows["ok"].cast(pa.bool_()), False).to_numpy()
        fresh = np.diff(sec, prepend=sec[0] if self.last is None else self.last) >= self.forget
        fresh[1:] |= ok[:-1]
        failed = np.cumsum(~ok)
        begin = np.maximum.accumulate(np.where(fresh, np.arange(len(sec)), -1))  # where a row's run of failures begins; -1: before these rows
        failures = failed - np.where(begin > 0, failed[np.maximum(begin, 1) - 1], np.where(begin == 0, 0, -self.count))
        attempts = np.where(ok, 0, (failures - 1) % self.most + 1)
        yield rows["seq"].to_pylist(), np.where(ok, "ENRICH", np.where(attempts < self.most, "retry", "abandoned")), attempts
        self.count, self.last = int(attempts[-1]) % self.most, int(sec[-1])

    def saved(self, now):
        if not self.count or now >= self.last + self.forget:
            return None, None
        return (self.count, self.last), self.last + self.forget
