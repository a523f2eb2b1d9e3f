"""Event-time timers per key, where no built-in window fits.

A key's entries wait in state until the watermark has reached their time, so that all that can still arrive
in time has arrived. Then they are settled in the order of ``seq``, and expiry is decided between one entry and
the next, so results depend neither on how the log is cut into batches nor on the order within the delay.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerline.functions.clock import watermarked, without_zone

_MICROS_PER_MILLI = 1000
CHUNK_ENTRIES = 1024
# A key without anything pending is forgotten so long after its last entry.
HORIZON = timedelta(days=90)
# Entries are kept as numbers: operations by code, no deadline as the least number.
OPS = {"fetch": 1, "keep_alive": 2, "ack": 3, "requeue": 4}
NEVER = -(1 << 63)


def _millis_after(micros: int) -> int:
    """First whole millisecond strictly after a time: a row expires when now is past it."""
    return micros // _MICROS_PER_MILLI + 1


class Waiting:
    """Entries of one key that wait, as whole numbers (seq, micros, value), in chunks of state.

    The key's state holds a line per chunk: its size, the least ``seq`` in it with that entry's time, the earliest time and the
    time at which it is looked at again. A call reads only chunks in which something may be settled, and new entries go to the
    newest chunk, so a key with many entries costs time in proportion to them, however many calls there are.
    """

    def __init__(self, chunks, packed: bytes | None):
        self.chunks = chunks
        numbers = array("q", bytes(packed) if packed else b"")
        self.lines = {numbers[i]: list(numbers[i + 1 : i + 6]) for i in range(0, len(numbers), 6)}

    def packed(self) -> bytearray:
        return bytearray(array("q", [n for chunk, line in self.lines.items() for n in (chunk, *line)]).tobytes())

    def _read(self, chunk: int) -> list[tuple[int, int, int]]:
        numbers = array("q", bytes(self.chunks.getValue((chunk,))[0]))
        return list(zip(numbers[0::3], numbers[1::3], numbers[2::3]))

    def add(self, entries: list[tuple[int, int, int]], wake: int | None = None) -> None:
        """``wake``: the time before which these need not be looked at, if later than their own."""
        entries = sorted(entries, key=lambda entry: entry[1])
        newest = max(self.lines, default=-1)
        if entries and newest >= 0 and wake is None and self.lines[newest][0] + len(entries) <= CHUNK_ENTRIES:
            before = self.lines.pop(newest)
            self._write(newest, [*self._read(newest), *entries], min(before[4], entries[0][1]))
            return
        for at in range(0, len(entries), CHUNK_ENTRIES):
            newest += 1
            some = entries[at : at + CHUNK_ENTRIES]
            self._write(newest, some, some[0][1] if wake is None else wake)

    def _write(self, chunk: int, entries: list[tuple[int, int, int]], wake: int) -> None:
        self.chunks.updateValue((chunk,), (bytearray(array("q", [n for entry in entries for n in entry]).tobytes()),))
        least = min(entries)
        self.lines[chunk] = [len(entries), least[0], least[1], min(entry[1] for entry in entries), wake]

    def ready(self, now: int) -> list[tuple[int, int, int]]:
        """Takes out what may be settled, in the order of ``seq``: the watermark has passed its time, and that of every
        waiting entry with a smaller ``seq``."""
        # A chunk's least seq, if its time is still to come, holds up all chunks that begin behind it.
        ahead = min(((line[1], line[2]) for line in self.lines.values() if _millis_after(line[2]) > now), default=None)
        looked = []
        for chunk, line in self.lines.items():
            if _millis_after(line[4]) <= now:
                if ahead is not None and line[1] > ahead[0]:
                    line[4] = ahead[1]
                else:
                    looked.append(chunk)
        if not looked:
            return []
        entries = [entry for chunk in looked for entry in self._read(chunk)]
        for chunk in looked:
            del self.lines[chunk]
            self.chunks.removeKey((chunk,))
        later = [entry for entry in entries if _millis_after(entry[1]) > now]
        barrier = min([(line[1], line[2]) for line in self.lines.values()] + [entry[:2] for entry in later], default=None)
        passed = sorted(entry for entry in entries if _millis_after(entry[1]) <= now)
        if barrier is None:
            return passed
        count = bisect_left(passed, barrier)
        # What waits for another entry is looked at when that one's time has passed.
        self.add(later)
        self.add(passed[count:], barrier[1])
        return passed[:count]

    def next_time(self) -> int | None:
        """Time of the waiting entry with the smallest ``seq``: nothing is settled before."""
        return min(((line[1], line[2]) for line in self.lines.values()), default=(0, None))[1]

    def earliest(self) -> int | None:
        return min((line[3] for line in self.lines.values()), default=None)


class _Timed(StatefulProcessor):
    """Waiting entries and one value state: what the subclass keeps, the time of the last settled entry, the lines of the
    waiting ones, and the time of its only timer (0 = none).

    Every call on the handle is a round trip to the JVM, so timers are touched only when they move. The timer
    stands at the next waiting entry's time, at the next expiry or at the time to forget the key, whichever is first.
    """

    state_schema = ""
    horizon = 0

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.state_schema + ", seen LONG, waiting BINARY, timer LONG")
        self.chunks = handle.getMapState("chunks", "chunk LONG", "entries BINARY")

    def rearm(self, timer: int, wanted: int) -> int:
        if wanted != timer:
            if timer:
                self.handle.deleteTimer(timer)
            if wanted:
                self.handle.registerTimer(wanted)
        return wanted

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        kept = self.state.get()
        entries = [self.entry(row) for row in rows]
        if kept is not None or not self.known_only:
            yield from self.settled(key, kept, entries, timerValues.getCurrentWatermarkInMs(), False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self.settled(key, self.state.get(), [], timerValues.getCurrentWatermarkInMs(), True)

    known_only = False

    def settled(self, key, kept, entries, now: int, fired: bool) -> Iterator[Row]:
        *state, seen, packed, timer = kept or (*self.start, -1, None, 0)
        if fired:
            timer = 0
        waiting = Waiting(self.chunks, packed)
        waiting.add(entries)
        for entry in waiting.ready(now):
            expired, state = self.step(key, state, entry)
            seen = max(seen, entry[1])
            yield from expired
        # The next entry in the order of ``seq`` lies beyond the watermark, as does all that can still arrive before it.
        end, following = self.end(state), waiting.next_time()
        if end is not None and _millis_after(end) <= now and not (following is not None and following <= end):
            expired, state = self.lapse(key, state)
            yield from expired
            end = self.end(state)
        times = [_millis_after(t) for t in (waiting.next_time(), end) if t is not None]
        keep = bool(times) or self.worth(state)
        if keep and not times and self.forgettable(state):
            forget = _millis_after(seen + self.horizon)
            keep = forget > now
            times = [forget]
        # What the watermark has passed already waits for the first of the entries.
        timer = self.rearm(timer, min((t for t in times if t > now), default=0) if keep else 0)
        if keep:
            self.state.update((*state, seen, waiting.packed(), timer))
        else:
            self.state.clear()

    def close(self) -> None:
        pass


class LeaseMonitor(_Timed):
    """Emits a queue row each time its lease runs out. Input: seq, id, micros, op.

    Follows the log entry by entry in the order of ``seq``. With an initial state from a queue, ids that it does not hold are
    ignored and an acknowledged row's state goes at once; without one, an acknowledged row is remembered as gone, and a
    lease that ran out as held, until ``horizon`` has passed since its last entry.
    """

    state_schema = "seq LONG, held BOOLEAN, gone BOOLEAN, touch LONG, pending BOOLEAN"
    start = (-1, False, False, -1, False)

    def __init__(self, timeout_micros: int, horizon_micros: int, known_only: bool = False):
        self.timeout = timeout_micros
        self.horizon = horizon_micros
        self.known_only = known_only

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        touch = initialState.micros
        held = touch is not None
        timer = self.rearm(0, _millis_after(touch + self.timeout)) if held else 0
        self.state.update((-1, held, False, touch if held else -1, held, -1, bytearray(), timer))

    def entry(self, row: Row):
        return row.seq, row.micros, OPS.get(row.op, 0)

    def step(self, key, state, entry):
        last, held, gone, touch, pending = state
        seq, micros, op = entry
        out = []
        if gone or seq <= last:
            return out, state
        if pending and micros > touch + self.timeout:
            pending = False
            out.append(self.expired(key, touch))
        if op == OPS["fetch"] or (held and op == OPS["keep_alive"]):
            held, touch, pending = True, micros, True
        elif held:
            held, pending, gone = False, False, op == OPS["ack"]
        return out, [seq, held, gone, touch, pending]

    def end(self, state):
        return state[3] + self.timeout if state[4] else None

    def lapse(self, key, state):
        # The holder may still keep the lease alive, so the state stays.
        return [self.expired(key, state[3])], [*state[:4], False]

    def worth(self, state):
        return not state[2] if self.known_only else state[1] or state[2]

    def forgettable(self, state):
        return not self.known_only

    def expired(self, key, touch: int) -> Row:
        return Row(id=key[0], fetched=touch, expired=touch + self.timeout)


class ExpiryMonitor(_Timed):
    """Emits a key's tombstone each time it expires. Input: seq, key, micros, deadline (NULL = never).

    A key's last ``seq`` is remembered until ``horizon`` has passed since its last entry."""

    state_schema = "seq LONG, deadline LONG"
    start = (-1, None)

    def __init__(self, horizon_micros: int):
        self.horizon = horizon_micros

    def entry(self, row: Row):
        return row.seq, row.micros, NEVER if row.deadline is None else row.deadline

    def step(self, key, state, entry):
        last, deadline = state
        seq, micros, new = entry
        if seq <= last:
            return [], state
        lapsed = [self.expired(key, deadline)] if deadline is not None and micros > deadline else []
        return lapsed, [seq, None if new == NEVER else new]

    def end(self, state):
        return state[1]

    def lapse(self, key, state):
        return [self.expired(key, state[1])], [-1, None]

    def worth(self, state):
        return state[0] >= 0

    def forgettable(self, state):
        return True

    def expired(self, key, deadline: int) -> Row:
        return Row(key=key[0], deadline=deadline)


def _micros(column: str):
    return F.unix_micros(F.col(column).cast("timestamp"))


def _time(column: str):
    return without_zone(F.timestamp_micros(F.col(column)))


def _span(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def lease_stream(
    log: DataFrame, timeout: timedelta, delay: str = "1 hour", horizon: timedelta = HORIZON, queue: DataFrame | None = None
) -> DataFrame:
    """Leases of a log stream ``(seq, id, ts, op)`` that ran out: the rows that may be delivered again.

    ``queue`` ``(id, fetchedat)`` is the queue when the stream starts: its leases are running already, and entries of ids that
    it does not hold are ignored."""
    entries = watermarked(log, delay).withColumn("micros", _micros("ts"))
    start = None if queue is None else queue.select("id", _micros("fetchedat").alias("micros")).groupBy("id")
    expired = entries.groupBy("id").transformWithState(
        LeaseMonitor(_span(timeout), _span(horizon), queue is not None),
        outputStructType="id LONG, fetched LONG, expired LONG",
        outputMode="Append",
        timeMode="eventTime",
        initialState=start,
    )
    return expired.select("id", _time("fetched").alias("fetchedat"), _time("expired").alias("expired_at"))


def key_expiry_stream(commands: DataFrame, delay: str = "1 hour", horizon: timedelta = HORIZON) -> DataFrame:
    """Tombstones of keys in a stream ``(seq, ts, key, expire_at)`` of expire and persist commands
    (``expire_at`` NULL): each time a key is past the expiry that its latest command gave it."""
    versions = watermarked(commands, delay).withColumns({"micros": _micros("ts"), "deadline": _micros("expire_at")})
    gone = versions.groupBy("key").transformWithState(
        ExpiryMonitor(_span(horizon)), outputStructType="key STRING, deadline LONG", outputMode="Append", timeMode="eventTime"
    )
    return gone.select("key", _time("deadline").alias("expireat"))
