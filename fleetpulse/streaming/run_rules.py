"""The stateful operator behind the look-back rules on a stream.

This module depends on no other of the package: it is shipped to Python workers by value, so
that they need nothing installed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# Names in transit; Spark hands rows over as named tuples, which cannot start with "_".
NULLS, NANS, MICROS = "null_bits", "nan_bits", "event_micros"

# Where a frame stands in its span, and the lane it goes on in.
SPAN, EDGE, LANE = "event_span", "edge", "lane"
INNER, HEAD, TAIL = 0, 1, 2
ALL_SPANS = -(2**62)

# Rules, and the readings they look at.
COUNTER_FELL, FROZEN, DRIFTED = "counter_fell", "frozen", "drifted"
READ = CYCLE, PRESSURE, SPEED, FUEL, EXHAUST = "time_cycles", "P30", "Nc", "phi", "T50"


# Above this many rows, frames that arrive together wait in an entry for each hour.
ENTRY_ROWS = 2_000
SPAN_MICROS = 3_600_000_000
JUDGED_ROWS = 20_000


class RunRules(StatefulProcessor):
    """Judge a unit's frames in event-time order, across micro-batches.

    Waiting frames lie in a map by their earliest time and their arrival, so a new frame rewrites
    nothing. Entries that the watermark has reached are read hour by hour and judged as far as
    no later entry can hold an earlier frame, with the last few frames carried along. A task
    never holds more of a unit than an hour, a batch of arriving rows, and small entries.
    """

    def __init__(
        self, columns: list[str], places: dict[str, int], rules: list[str], horizon: int
    ):
        self.columns = columns
        self.places = places
        self.rules = rules
        self.horizon = horizon

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.judged = handle.getValueState("judged", "frames binary")
        self.arrivals = handle.getValueState("arrivals", "count long")
        self.waiting = handle.getMapState("waiting", "first long, arrival long", "frames binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        stored = self.arrivals.get()
        arrival = stored[0] if stored else 0
        for chunk in rows:
            arrival += 1
            self._put(chunk[self.columns], arrival)
        yield from self._release(timerValues, arrival)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._release(timerValues, self.arrivals.get()[0])

    def close(self) -> None:
        pass

    def _put(self, frames: pd.DataFrame, arrival: int) -> None:
        micros = frames[MICROS].to_numpy()
        if len(frames) <= ENTRY_ROWS:
            parts = [frames]
        else:
            parts = [part for _, part in frames.groupby(micros // SPAN_MICROS)]
        for part in parts:
            self.waiting.updateValue((int(part[MICROS].min()), arrival), (_to_bytes(part),))

    def _release(self, timer_values, arrival: int) -> Iterator[pd.DataFrame]:
        """Judge what the watermark has passed, and ask to be called for what still waits."""
        watermark = timer_values.getCurrentWatermarkInMs() * 1000
        entries = sorted(tuple(place) for place in self.waiting.keys())
        due = [place for place in entries if place[0] <= watermark]
        upcoming = [place[0] for place in entries[len(due) : len(due) + 1]]
        stored = self.judged.get() if due else None
        judged = _from_bytes(stored[0]) if stored else pd.DataFrame()
        held: list[pd.DataFrame] = []
        for n, place in enumerate(due):
            held.append(_from_bytes(self.waiting.getValue(place)[0]))
            self.waiting.removeKey(place)
            following = due[n + 1][0] if n + 1 < len(due) else None
            if following is not None and following // SPAN_MICROS == place[0] // SPAN_MICROS:
                continue
            frames = pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
            micros = frames[MICROS].to_numpy()
            safe = micros <= watermark if following is None else micros < following
            held = [frames[~safe]] if not safe.all() else []
            ready = frames[safe].sort_values(
                [MICROS, f"value{self.places[CYCLE]}"], na_position="first", kind="stable"
            )
            for start in range(0, len(ready), JUDGED_ROWS):
                part = ready.iloc[start : start + JUDGED_ROWS]
                run = pd.concat([judged, part], ignore_index=True) if len(judged) else part
                run = run.reset_index(drop=True)
                yield self._judge(run).iloc[len(judged):]
                judged = run[self.columns].tail(self.horizon - 1).reset_index(drop=True)
        if due:
            self.judged.update((_to_bytes(judged),))
        for later in held:  # one at most
            arrival += 1
            self._put(later, arrival)
            upcoming.append(int(later[MICROS].min()))
        self.arrivals.update((arrival,))
        if upcoming:
            self.handle.registerTimer(min(upcoming) // 1000 + 1)

    def _judge(self, run: pd.DataFrame) -> pd.DataFrame:
        read = {name: _Reading(run, place) for name, place in self.places.items()}
        steps = range(1, self.horizon)
        hits = {}
        for n, code in enumerate(self.rules):
            if code == COUNTER_FELL:
                hit = read[CYCLE].below(read[CYCLE].back(1))
            elif code == FROZEN:
                hit = read[SPEED].differs(read[SPEED].back(self.horizon - 1))
                for step in steps:
                    hit = hit & read[PRESSURE].equals(read[PRESSURE].back(step))
            else:
                hit = read[FUEL].back(1).below(read[FUEL])
                hit = hit & read[EXHAUST].below(read[EXHAUST].back(1))
            hits[f"hit{n}"] = hit
        return run[self.columns].assign(**hits)


class SpanRules(RunRules):
    """Judge the frames of one span of time of a unit, all but its first few.

    Keys are a unit and the number of a span, so a unit is spread over as many tasks as it has
    open spans. The first frames of a span look back into earlier ones: they leave unjudged as
    ``HEAD``. When the watermark has passed the span, its last frames leave once more as ``TAIL``,
    and its state is forgotten. ``EdgeRules`` puts the edges together.
    """

    def __init__(
        self, columns: list[str], places: dict[str, int], rules: list[str], horizon: int, micros: int
    ):
        super().__init__(columns, places, rules, horizon)
        self.micros = micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.passed = handle.getValueState("passed", "count long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self.span = int(key[1])
        yield from super().handleInputRows(key, rows, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.span = int(key[1])
        if self.arrivals.get():  # else the span was closed by an earlier timer
            yield from super().handleExpiredTimer(key, timerValues, expiredTimerInfo)

    def _release(self, timer_values, arrival: int) -> Iterator[pd.DataFrame]:
        stored = self.passed.get()
        passed = stored[0] if stored else 0
        for part in super()._release(timer_values, arrival):
            head = np.arange(passed, passed + len(part)) < self.horizon - 1
            yield self._marked(part, np.where(head, HEAD, INNER))
            passed += len(part)
        end = (self.span + 1) * self.micros
        if timer_values.getCurrentWatermarkInMs() * 1000 < end:
            self.passed.update((passed,))
            self.handle.registerTimer(end // 1000)
            return
        last = _from_bytes(self.judged.get()[0]) if self.judged.get() else pd.DataFrame()
        if len(last):
            hits = {f"hit{n}": np.zeros(len(last), bool) for n in range(len(self.rules))}
            yield self._marked(last.assign(**hits), np.full(len(last), TAIL))
        for state in (self.judged, self.arrivals, self.passed):
            state.clear()

    def _marked(self, part: pd.DataFrame, edge: np.ndarray) -> pd.DataFrame:
        lane = np.where(edge == INNER, self.span, ALL_SPANS)
        return part.assign(**{SPAN: self.span, EDGE: edge.astype("int32"), LANE: lane})


class EdgeRules(RunRules):
    """Judge the first frames of each span after the last ones of the spans before.

    Keys are a unit and a lane. A unit's edges share one lane, a few frames a span; frames that
    are judged already pass through lanes of their own. All frames of earlier spans come no later
    than the head of a span, so nothing waits: the state is the last frames before the open
    span, and its own heads so far.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.before = handle.getValueState("before", "frames binary")
        self.heads = handle.getValueState("heads", "span long, frames binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        hits = [f"hit{n}" for n in range(len(self.rules))]
        if int(key[1]) != ALL_SPANS:
            for chunk in rows:
                yield chunk[[*self.columns, *hits]]
            return
        order = [SPAN, EDGE, MICROS, f"value{self.places[CYCLE]}"]
        edges = pd.concat(list(rows), ignore_index=True).sort_values(order, na_position="first", kind="stable")
        stored, opened = self.before.get(), self.heads.get()
        before = _from_bytes(stored[0]) if stored else pd.DataFrame()
        span, heads = (opened[0], _from_bytes(opened[1])) if opened else (None, pd.DataFrame())
        for of_span, group in edges.groupby(SPAN, sort=True):
            if of_span != span:
                span, heads = of_span, pd.DataFrame()
            new = group[group[EDGE] == HEAD][self.columns]
            known = [part for part in (before, heads) if len(part)]
            if len(new):
                run = pd.concat([*known, new], ignore_index=True)
                yield self._judge(run).iloc[len(run) - len(new):]
                heads = pd.concat([heads, new], ignore_index=True) if len(heads) else new
            tail = group[group[EDGE] == TAIL][self.columns]
            if len(tail):
                run = pd.concat([before, tail], ignore_index=True) if len(before) else tail
                before, heads = run.tail(self.horizon - 1).reset_index(drop=True), pd.DataFrame()
        self.before.update((_to_bytes(before),))
        self.heads.update((int(span), _to_bytes(heads)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return iter(())


class _Reading:
    """A column with its NULLs, compared as Spark compares: NULL is never a hit, NaN equals
    itself and is above every number."""

    def __init__(self, run: pd.DataFrame | None, place: int = 0):
        if run is not None:
            self.known = (run[NULLS].to_numpy() & (1 << place)) == 0
            self.value = run[f"value{place}"].to_numpy(dtype="float64")
            self.nan = np.isnan(self.value)

    def back(self, steps: int) -> _Reading:
        shifted = _Reading(None)
        shifted.known = np.concatenate([np.zeros(steps, bool), self.known])[: len(self.known)]
        shifted.value = np.concatenate([np.zeros(steps), self.value])[: len(self.value)]
        shifted.nan = np.concatenate([np.zeros(steps, bool), self.nan])[: len(self.nan)]
        return shifted

    def _both(self, other: _Reading) -> np.ndarray:
        return self.known & other.known

    def equals(self, other: _Reading) -> np.ndarray:
        same = (self.value == other.value) | (self.nan & other.nan)
        return self._both(other) & same

    def differs(self, other: _Reading) -> np.ndarray:
        return self._both(other) & ~self.equals(other)

    def below(self, other: _Reading) -> np.ndarray:
        less = (self.value < other.value) | (~self.nan & other.nan)
        return self._both(other) & less


def _to_bytes(frames: pd.DataFrame) -> bytes:
    if not len(frames):
        return b""
    table = pa.Table.from_pandas(frames, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _from_bytes(data: bytes | None) -> pd.DataFrame:
    if not data:
        return pd.DataFrame()
    return pa.ipc.open_stream(pa.py_buffer(bytes(data))).read_all().to_pandas()
