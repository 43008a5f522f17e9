"""Stateful processors for ``groupBy(...).transformWithStateInPandas``.

Each processor keeps only the state that the operator needs (a slot, a
counter, three slots for each key of a bucket, a small map of window means) and
works on the rows of one micro-batch in (timestamp, event_seq) order.  Times are microseconds in
the data; Spark timers and watermarks are milliseconds.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..schema import TASK_SCHEMA

# A slot of the sequence rule holds one whole task event.
SLOT_SCHEMA = T.StructType(TASK_SCHEMA.fields + [T.StructField("event_seq", T.LongType())])
SLOT_COLUMNS = [f.name for f in SLOT_SCHEMA.fields]


def _sorted(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    frames = [f for f in rows if len(f)]
    if not frames:
        return pd.DataFrame()
    df = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
    return df.sort_values(["timestamp", "event_seq"], kind="stable")


def _timer_ms(micros: int) -> int:
    """First millisecond timer that fires only after ``micros`` has passed."""
    return micros // 1000 + 1


def _packed(rows: pa.Table) -> bytes:
    """A table as one state value (Arrow IPC)."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as w:
        w.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(value) -> pa.Table:
    return pa.ipc.open_stream(bytes(value)).read_all()


def _codes(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """The number of each row's key, from 0 in order of appearance."""
    return rows.select(keys).to_pandas().groupby(keys, sort=False, dropna=False).ngroup().to_numpy()


class Ordered(StatefulProcessor):
    """Base of the processors that walk each key's rows in event-time order.

    The group of the processor is a bucket of keys (``jobs.bucketed``), so that a
    micro-batch costs calls to the state store, timers and frames for each bucket,
    not for each key; a state value is a table of the bucket's keys or rows (Arrow IPC).

    Rows wait in a list state, one value a micro-batch, until the watermark has
    passed them: from then on no earlier row of their key can come.  One event-time
    timer a bucket stands at the earliest waiting row, or at ``due`` if that is
    earlier.  When it fires, all rows that the watermark has passed are taken out
    and given to ``advance`` at once, with one write of the rest.  The result does
    not depend on the order of arrival within the watermark's delay, on the cut
    into micro-batches nor on the number of buckets; a bucket holds the rows of
    that delay.

    ``ordered=False``: rows are given to ``advance`` as they come, ordered
    within one micro-batch only.
    """

    def __init__(self, keys: list[T.StructField], buffer: list[T.StructField], ordered: bool = True):
        self.keys, self.ordered = [f.name for f in keys], ordered
        fields = {f.name: f for f in [*keys, *buffer]}
        self.schema = pa.schema([(n, to_arrow_type(f.dataType)) for n, f in fields.items()])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        if self.ordered:
            self.waiting = handle.getListState("waiting", "rows binary")
            self.wake = handle.getValueState("wake", "ms long")
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        """Creates the operator's own state."""

    def advance(self, rows: pa.Table, upto: int | None, now: int) -> Iterator[pd.DataFrame]:
        """Takes the bucket's next rows (``in_order`` gives their order); all rows
        before ``upto`` (microseconds; None without a watermark) have come.  Sets
        ``due``: microseconds after which ``advance`` is wanted without a row.
        ``now``: processing time in milliseconds."""
        raise NotImplementedError

    def in_order(self, rows: pa.Table, codes: np.ndarray) -> np.ndarray:
        """Row numbers by key, then (timestamp, event_seq)."""
        return np.lexsort((rows["event_seq"].to_numpy(), rows["timestamp"].to_numpy(), codes))

    @staticmethod
    def stored(state) -> pa.Table | None:
        return _unpacked(state.get()[0]) if state.exists() else None

    @staticmethod
    def store(state, rows: pa.Table) -> None:
        if len(rows):
            state.update((_packed(rows),))
        else:
            state.clear()

    def _table(self, frame: pd.DataFrame) -> pa.Table:
        return pa.table([pa.array(frame[f.name], f.type, from_pandas=True) for f in self.schema], schema=self.schema)

    def _wake_after(self, micros: int) -> None:
        ms = _timer_ms(micros)
        now = self.wake.get()[0] if self.wake.exists() else None
        if now is None or ms < now:
            if now is not None:
                self.handle.deleteTimer(now)
            self.handle.registerTimer(ms)
            self.wake.update((ms,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from ()  # a generator: every path returns an (empty) iterator
        tables = [self._table(f) for f in rows if len(f)]
        if not tables:
            return
        new = pa.concat_tables(tables)
        if not self.ordered:
            self.due = None
            yield from self.advance(new, None, timerValues.getCurrentProcessingTimeInMs())
            return
        self.waiting.appendValue((_packed(new),))
        self._wake_after(int(new["timestamp"].to_numpy().min()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upto = timerValues.getCurrentWatermarkInMs() * 1000
        values = list(self.waiting.get()) if self.waiting.exists() else []
        rows = pa.concat_tables([_unpacked(v[0]) for v in values]) if values else self.schema.empty_table()
        ready = rows["timestamp"].to_numpy() < upto
        later = rows.filter(pa.array(~ready))
        if len(later) < len(rows):
            if len(later):
                self.waiting.put([(_packed(later),)])
            else:
                self.waiting.clear()
        self.wake.clear()
        self.due = None
        yield from self.advance(rows.filter(pa.array(ready)), upto, 0)
        wanted = [] if self.due is None else [self.due]
        if len(later):
            wanted.append(int(later["timestamp"].to_numpy().min()))
        if wanted:
            self._wake_after(min(wanted))

    def close(self) -> None:
        pass


_ORDER_FIELDS = [T.StructField("timestamp", T.LongType()), T.StructField("event_seq", T.LongType())]


class RunningCount(Ordered):
    """J1 stream: one output row per input event with the running count.  The
    bucket's state is a table of its keys with their counts."""

    def __init__(self, key: T.StructField, ordered: bool = True):
        super().__init__([key], _ORDER_FIELDS, ordered)

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "rows binary")

    def advance(self, rows, upto, now) -> Iterator[pd.DataFrame]:
        if not len(rows):
            return
        before, new = self.stored(self.count), rows.select(self.keys)
        known = 0 if before is None else len(before)
        keys = new if before is None else pa.concat_tables([before.select(self.keys), new])
        codes = _codes(keys, self.keys)
        size = np.bincount(codes[known:], minlength=int(codes.max()) + 1)
        base = np.zeros(len(size), np.int64)
        if known:
            base[codes[:known]] = before["n"].to_numpy()
        order = self.in_order(rows, codes[known:])
        by_key = codes[known:][order]
        place = np.arange(len(order)) - (np.cumsum(size) - size)[by_key]
        first = np.unique(codes, return_index=True)[1]
        self.store(self.count, keys.take(first).append_column("n", pa.array(base + size)))
        out = rows.take(order).to_pandas()
        out["event_count"] = base[by_key] + place + 1
        yield out


def pairs_by_key(codes, typ, repeat: str = "latest"):
    """Alternating pairs of many keys, vectorised, over rows sorted by key and
    order.  Run r of a key is entered with a full slot iff ``(r - 1 - j)`` is
    even, ``j`` its last earlier run of length >= 2 (or -1).  Returns (emitting
    rows, partner of each row, last row of each key, the row that is in the
    slot after it or -1)."""
    n = len(typ)
    idx = np.arange(n)
    fresh = np.ones(n, dtype=bool)  # first row of its key
    fresh[1:] = codes[1:] != codes[:-1]
    chg = fresh.copy()
    chg[1:] |= typ[1:] != typ[:-1]
    run = np.cumsum(chg)
    base = np.maximum.accumulate(np.where(fresh, run, 0)) - 1  # runs of the keys before
    longest = np.maximum.accumulate(np.where(~chg, run, 0))
    before = np.concatenate([[0], longest[:-1]]) - base
    j = np.where(before > 0, before, -1)
    is_open = ((run - base - 1 - j) % 2) == 0
    emit = chg & is_open
    if repeat == "latest":
        partner = idx - 1
        filler_last = idx  # the slot always holds the run's newest row
    else:
        prev_emit = np.concatenate([[False], emit[:-1]])
        fill = ~emit & (chg | (prev_emit & ~chg))
        filler_last = np.maximum.accumulate(np.where(fill, idx, -1))
        partner = np.concatenate([[-1], filler_last[:-1]])
    # slot after the rows: empty when the last run was entered full and is
    # one row long, else that run's type with its filler (first) / last row
    last = np.flatnonzero(np.concatenate([fresh[1:], [True]]))
    start = np.maximum.accumulate(np.where(chg, idx, 0))[last]
    empty = is_open[start] & (start == last)
    return np.flatnonzero(emit), partner, last, np.where(empty, -1, filler_last[last])


def match_pairs(typ, ts, seq, slot, repeat: str = "latest"):
    """One key's alternating pairs over sorted arrays.

    ``slot`` is the stored (type, ts, seq) or None.  A full slot is the
    state after one row from an empty slot, so it is prepended as a virtual
    first row and the closed form of the batch matcher applies
    (``pairs_by_key``).  Returns (emitting row indexes, partner indexes -- both
    into the arrays with the virtual row --, the arrays, and the slot after the
    batch).
    """
    if slot is not None:
        typ = np.concatenate([[slot[0]], typ])
        ts = np.concatenate([[slot[1]], ts])
        seq = np.concatenate([[slot[2]], seq])
    emit, partner, _, after = pairs_by_key(np.zeros(len(typ), np.int64), typ, repeat)
    k = int(after[0])
    return emit, partner, (typ, ts, seq), None if k < 0 else (int(typ[k]), int(ts[k]), int(seq[k]))


class PairMatcher(Ordered):
    """T1 stream: one slot per key; same type replaces (``latest``) or is
    ignored (``first``); the other type emits the pair and empties the slot.
    ``carry`` columns come from the closing event.  The bucket's state is a table
    of its full slots; they go before the new rows as virtual first rows, and all
    keys are matched at once by ``pairs_by_key`` (numpy)."""

    def __init__(self, keys: list[T.StructField], type_a: int, type_b: int, repeat: str = "latest",
                 carry: list | None = None, event_time: bool = False, ttl_ms: int | None = None,
                 ordered: bool = True):
        carry = list(carry or [])
        super().__init__(keys, _ORDER_FIELDS + [T.StructField("event_type", T.IntegerType())] + carry, ordered)
        self.types, self.repeat = (type_a, type_b), repeat
        self.carry, self.event_time, self.ttl_ms = [f.name for f in carry], event_time, ttl_ms

    def open(self, handle: StatefulProcessorHandle) -> None:
        # ttl_ms: a slot that is not touched for that long (processing time)
        # is dropped -- bounds the state of keys that never close a pair; the
        # store drops a bucket that no row reaches for that long
        self.slot = handle.getValueState("slot", "rows binary", self.ttl_ms)

    def advance(self, rows, upto, now) -> Iterator[pd.DataFrame]:
        typ = rows["event_type"].to_numpy()
        rows = rows.filter(pa.array((typ == self.types[0]) | (typ == self.types[1])))
        if not len(rows):
            return
        rows = rows.append_column("touched", pa.array(np.full(len(rows), now)))
        slots = self.stored(self.slot)
        full = 0
        if slots is not None:
            if self.ttl_ms is not None:
                slots = slots.filter(pa.array(slots["touched"].to_numpy() + self.ttl_ms > now))
            full, rows = len(slots), pa.concat_tables([slots, rows])
        codes = _codes(rows, self.keys)
        order = np.lexsort((rows["event_seq"].to_numpy(), rows["timestamp"].to_numpy(),
                            np.arange(len(rows)) >= full, codes))
        rows, codes, came = rows.take(order), codes[order], order >= full
        emit, partner, last, after = pairs_by_key(codes, rows["event_type"].to_numpy(), self.repeat)
        kept = rows.take(after[after >= 0])
        if self.ttl_ms is not None:  # a key's new rows touch its slot
            touched = np.where(came[last], now, rows["touched"].to_numpy()[last])[after >= 0]
            kept = kept.set_column(kept.schema.get_field_index("touched"), "touched", pa.array(touched))
        self.store(self.slot, kept)
        if not len(emit):
            return
        ts, seq, p = rows["timestamp"].to_numpy(), rows["event_seq"].to_numpy(), partner[emit]
        names = list(dict.fromkeys([*self.keys, "timestamp", "event_seq", "event_type", *self.carry]))
        out = rows.select(names).take(emit).to_pandas()
        out["partner_timestamp"] = ts[p]
        out["partner_seq"] = seq[p]
        out["duration"] = np.abs(ts[emit] - ts[p])
        if self.event_time:
            # a row for a later operator must lie past the watermark: its event
            # time is the first moment at which the pair is certain
            certain = out["timestamp"] if upto is None else [upto + 1000] * len(out)
            out["event_time"] = pd.to_datetime(certain, unit="us", utc=True)
        yield out


class SequenceRule(Ordered):
    """T2 stream (repeat epochs, event time).

    The first event of each of e1, e2, e3 since the last reset fills a slot;
    the first e1 opens an epoch that ends at t(e1) + limit.  It closes with
    the first later event of the key, which may open the next one, or when the
    watermark passes its end.  On close the triple is
    emitted when t1 < t2 < t3 and t3 - t1 <= limit, and the slots reset.
    Without an e1 the slots stay filled (and block later events of their
    type), as in the reference -- unless ``ttl_us`` is set: then slots that
    wait longer than that (event time) for an e1 are cleared.

    The bucket's state is, for each of the three slots, a table of the events in
    it.  The walk holds row numbers only; the rows of state and output are taken
    from the tables at once.
    """

    def __init__(self, keys: list[T.StructField], e1: int, e2: int, e3: int, limit_us: int,
                 ttl_us: int | None = None):
        super().__init__(keys, SLOT_SCHEMA.fields, True)
        self.order, self.limit, self.ttl_us = (e1, e2, e3), int(limit_us), ttl_us

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.slots = [handle.getValueState(f"slot{i}", "rows binary") for i in range(3)]

    def _end(self, ts, slots) -> int | None:
        """Last moment of the slots: the epoch's end, or without an e1 the
        end of their ttl."""
        if slots[0] is not None:
            return ts[slots[0]] + self.limit
        filled = [ts[s] for s in slots[1:] if s is not None]
        return min(filled) + self.ttl_us if filled and self.ttl_us else None

    def advance(self, rows, upto, now) -> Iterator[pd.DataFrame]:
        before = [self.stored(s) for s in self.slots]
        known = [0 if b is None else len(b) for b in before]
        rows = pa.concat_tables([*(b for b in before if b is not None), rows])
        if not len(rows):
            return
        codes, new = _codes(rows, self.keys), sum(known)
        order = np.lexsort((rows["event_seq"].to_numpy()[new:], rows["timestamp"].to_numpy()[new:],
                            codes[new:])) + new
        key, ts, typ = codes.tolist(), rows["timestamp"].to_pylist(), rows["event_type"].to_pylist()
        held: dict[int, list] = {}  # key: its three slots (row numbers)
        at = 0
        for i, n in enumerate(known):
            for r in range(at, at + n):
                held.setdefault(key[r], [None] * 3)[i] = r
            at += n
        ends = {k: self._end(ts, s) for k, s in held.items()}
        found: list[list] = []
        e1, *others = self.order

        def close(k: int) -> None:
            s = held.pop(k)
            if None not in s and ts[s[0]] < ts[s[1]] < ts[s[2]] <= ts[s[0]] + self.limit:
                found.append(s)

        for r in order.tolist():
            k = key[r]
            slots = held.get(k)
            if slots is not None and ends[k] is not None and ts[r] > ends[k]:
                close(k)
                slots = None
            if slots is None:
                slots, ends[k] = held.setdefault(k, [None] * 3), None
            if typ[r] == e1 and slots[0] is None:
                slots[0] = r
            else:
                hit = [i for i, e in enumerate(others, 1) if typ[r] == e and slots[i] is None]
                for i in hit:
                    slots[i] = r
                if not hit or slots[0] is not None:
                    continue
            ends[k] = self._end(ts, slots)
        for k in [k for k in held if ends[k] is not None and upto is not None and ends[k] < upto]:
            close(k)
        self.due = min((ends[k] for k in held if ends[k] is not None), default=None)
        for i, (state, n) in enumerate(zip(self.slots, known)):
            inside = [s[i] for s in held.values() if s[i] is not None]
            if n or inside:
                # the table of a slot is rewritten only when other events are in it
                begin = sum(known[:i])
                if len(inside) != n or any(not begin <= r < begin + n for r in inside):
                    self.store(state, rows.take(np.array(inside, np.int64)))
        if found:
            triples = np.array(found)
            out = rows.select(self.keys).take(triples[:, 0]).to_pandas()
            parts = [rows.select(SLOT_COLUMNS).take(triples[:, i]).to_pandas().add_prefix(f"{name}_")
                     for i, name in enumerate(("first", "second", "third"))]
            yield pd.concat([out, *parts], axis=1)


class LongestSession(StatefulProcessor):
    """J8 stream: input is the union of closed sessions (``kind='s'``,
    ``session_events``) and FINISH job events (``kind='f'``).  The first
    FINISH arms a timer just after its time (reference behaviour), or one
    gap later with ``wait_us`` = gap (``wait_for_open_session``: a session
    whose last event is at or before the finish has closed by then); when it
    fires the largest session seen so far is emitted and the job's state is
    cleared."""

    def __init__(self, wait_us: int = 0):
        self.wait_us = int(wait_us)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", "n long")
        self.finish = handle.getValueState("finish", "t long")
        self.done = handle.getValueState("done", "d boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield from ()  # a generator: every path returns an (empty) iterator
        df = _sorted(rows)
        if df.empty or self.done.exists():
            return
        s = df[df["kind"] == "s"]
        if len(s):
            n = int(s["session_events"].max())
            if not self.best.exists() or self.best.get()[0] < n:
                self.best.update((n,))
        f = df[df["kind"] == "f"]
        if len(f) and not self.finish.exists():
            t = int(f["timestamp"].iloc[0])
            self.finish.update((t,))
            self.handle.registerTimer(_timer_ms(t + self.wait_us))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        best = self.best.get()[0] if self.best.exists() else None
        self.best.clear()
        self.finish.clear()
        self.done.update((True,))
        if best is not None:
            yield pd.DataFrame({"job_id": [key[0]], "session_events": [best]})

    def close(self) -> None:
        pass


class MovingAverageCheck(StatefulProcessor):
    """J12 stream: window means per machine arrive as windows close, in order
    of their ends (a micro-batch brings all windows that closed between two
    watermarks).  The last ``windows - 1`` means stay in one value state;
    each new mean is checked as it arrives against the frame that it completes: if
    the frame's means follow each other by one slide, the relative-difference test
    applies.  No timer; the state never exceeds the frame."""

    def __init__(self, windows: int, slide_us: int, diff: float, by: str = "machine_id"):
        self.n, self.slide, self.diff, self.by = windows, slide_us, diff, by

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getValueState("ring", "ends array<long>, means array<double>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = [f for f in rows if len(f)]
        if not frames:
            return
        new = pd.concat(frames).sort_values("window_end")
        ends, means = self.ring.get() if self.ring.exists() else ([], [])
        ends = np.r_[np.array(ends, np.int64), new["window_end"].to_numpy(np.int64)]
        means = np.r_[np.array(means, float), new["current_avg"].to_numpy(float)]
        back = self.n - 1
        keep = max(0, len(ends) - back)
        self.ring.update((ends[keep:].tolist(), means[keep:].tolist()))
        if len(ends) <= back:
            return
        last, cur = ends[back:], means[back:]
        # ends are distinct multiples of the slide: a whole frame spans n - 1 slides
        whole = last - ends[:len(last)] == back * self.slide
        mov = np.lib.stride_tricks.sliding_window_view(means, self.n).mean(axis=1)
        hit = whole & (2 * np.abs(cur - mov) / (cur + mov) > self.diff)
        if hit.any():
            yield pd.DataFrame({self.by: [key[0]] * int(hit.sum()), "window_end": last[hit],
                                "current_avg": cur[hit], "moving_avg": mov[hit]})

    def close(self) -> None:
        pass


class RunningMax(StatefulProcessor):
    """J3 stream: per priority, one row per completed task with the largest
    duration so far (the reference's rolling max)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", "m long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        df = _sorted(rows)
        if df.empty:
            return
        start = self.best.get()[0] if self.best.exists() else None
        run = df["duration"].cummax()
        if start is not None:
            run = run.clip(lower=start)
        self.best.update((int(run.iloc[-1]),))
        yield pd.DataFrame({"priority": df["priority"].values, "timestamp": df["timestamp"].values,
                            "event_seq": df["event_seq"].values, "max_duration": run.values})

    def close(self) -> None:
        pass


class InvariantCheck(StatefulProcessor):
    """J11 stream, per priority: pairs closing at or before ``training_end``
    update the bounds; later pairs wait until the watermark passes the
    training end (a timer), then are checked against the bounds; after that
    they are checked on arrival."""

    OUT = ["priority", "job_id", "task_index", "timestamp", "event_seq", "duration"]

    def __init__(self, training_end_us: int):
        self.end = int(training_end_us)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bounds = handle.getValueState("bounds", "lo long, hi long")
        # one value a micro-batch: a table of the rows that wait (Arrow IPC)
        self.pending = handle.getListState("pending", "rows binary")
        self.armed = handle.getValueState("armed", "a boolean")

    def _check(self, rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if not self.bounds.exists():
            return
        lo, hi = self.bounds.get()
        out = rows[(rows["duration"] > hi) | (rows["duration"] < lo)]
        if len(out):
            yield out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = [f[self.OUT] for f in rows if len(f)]
        if not frames:
            return
        df = pd.concat(frames, ignore_index=True)
        train = df[df["timestamp"] <= self.end]
        if len(train):
            lo, hi = int(train["duration"].min()), int(train["duration"].max())
            if self.bounds.exists():
                old = self.bounds.get()
                lo, hi = min(lo, old[0]), max(hi, old[1])
            self.bounds.update((lo, hi))
        det = df[df["timestamp"] > self.end]
        if not len(det):
            return
        if timerValues.getCurrentWatermarkInMs() * 1000 > self.end:
            yield from self._check(det)
            return
        self.pending.appendValue((_packed(pa.Table.from_pandas(det, preserve_index=False)),))
        if not self.armed.exists():
            self.handle.registerTimer(_timer_ms(self.end))
            self.armed.update((True,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        values = list(self.pending.get())
        self.pending.clear()
        for v in values:
            yield from self._check(_unpacked(v[0]).to_pandas())

    def close(self) -> None:
        pass


# Processors travel to Python workers by value, so neither the executors'
# workers nor the driver-side state-schema runner need this package on
# their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
