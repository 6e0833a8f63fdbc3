"""Keyed state with timers: circuit breakers that half-open by themselves, and leases that expire when no heartbeat comes.

Each operator has a stream form, whose timers follow the watermark, and a batch form over a table with the same steps. Timers that are due at or
before a call are taken before it, whether the stream has fired them already or not, so both forms give the same transitions for calls in
order, and a restart from the checkpoint goes on where it stopped. State of a key is a few numbers; a closed breaker without
recent failures and a finished lease leave none.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..sources.shared import ship

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
CHANGES = "key string, at_ms long, old_state string, new_state string"


class Breaker:
    """One key's breaker over calls in order. `threshold` failures within `window_ms` open it; after `cooldown_ms` it half-opens; the next call closes it or opens it again."""

    state = "name string, fails array<long>, due long"

    def __init__(self, threshold: int, window_ms: int, cooldown_ms: int):
        self.threshold, self.window_ms, self.cooldown_ms = threshold, window_ms, cooldown_ms

    def start(self) -> tuple:
        return "CLOSED", [], -1

    def due(self, state: tuple) -> int | None:
        return state[2] if state[0] == "OPEN" else None

    def fire(self, state: tuple, out: list) -> tuple:
        out.append((state[2], "OPEN", "HALF_OPEN"))
        return "HALF_OPEN", [], -1

    def step(self, state: tuple, at: int, failed: bool, out: list) -> tuple:
        name, fails, due = state
        if name == "OPEN":
            return state
        if not failed:
            if name == "HALF_OPEN":
                out.append((at, name, "CLOSED"))
                return "CLOSED", [], -1
            return state
        fails = [f for f in fails if at - f < self.window_ms][-(self.threshold - 1) :] if self.threshold > 1 else []
        fails.append(at)
        if name == "HALF_OPEN" or len(fails) >= self.threshold:
            out.append((at, name, "OPEN"))
            return "OPEN", [], at + self.cooldown_ms
        return name, fails, due

    def over(self, state: tuple) -> bool:
        return state[0] == "CLOSED" and not state[1]


class Lease:
    """One job's lease over its events in order: `lease` and `heartbeat` hold it for `ttl_ms` more, `done` ends it; left alone it expires."""

    state = "name string, fails array<long>, due long"

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def start(self) -> tuple:
        return "QUEUED", [], -1

    def due(self, state: tuple) -> int | None:
        return state[2] if state[0] == "LEASED" else None

    def fire(self, state: tuple, out: list) -> tuple:
        out.append((state[2], "LEASED", "QUEUED"))
        return "QUEUED", [], -1

    def step(self, state: tuple, at: int, event: str, out: list) -> tuple:
        if event == "done" and state[0] == "LEASED":
            out.append((at, "LEASED", "DONE"))
            return "DONE", [], -1
        if event == "lease" and state[0] == "QUEUED":
            out.append((at, "QUEUED", "LEASED"))
            return "LEASED", [], at + self.ttl_ms
        if event == "heartbeat" and state[0] == "LEASED":
            return "LEASED", [], at + self.ttl_ms
        return state

    def over(self, state: tuple) -> bool:
        return state[0] == "QUEUED"


def run_steps(machine, state: tuple, rows, upto: int | None = None) -> tuple[list, tuple]:
    """Changes and the state after (at, event) rows in order, and after timers that are due by `upto`."""
    out: list = []
    for at, event in rows:
        while (due := machine.due(state)) is not None and due <= at:
            state = machine.fire(state, out)
        state = machine.step(state, at, event, out)
    while upto is not None and (due := machine.due(state)) is not None and due <= upto:
        state = machine.fire(state, out)
    return out, state


def _frame(key: str, out: list) -> pd.DataFrame:
    return pd.DataFrame({"key": pd.Series([key] * len(out), dtype=object), "at_ms": pd.Series([o[0] for o in out], dtype="int64"), "old_state": pd.Series([o[1] for o in out], dtype=object), "new_state": pd.Series([o[2] for o in out], dtype=object)})


class _Processor(StatefulProcessor):
    def __init__(self, machine):
        self.machine = machine

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", self.machine.state)

    def _read(self) -> tuple:
        if not self.held.exists():
            return self.machine.start()
        name, fails, due = self.held.get()
        return name, list(fails or []), due

    def _write(self, state: tuple) -> None:
        due = self.machine.due(state)
        for timer in list(self.handle.listTimers()):
            if timer != due:
                self.handle.deleteTimer(timer)
        if due is not None:
            self.handle.registerTimer(due)
        if self.machine.over(state):
            self.held.clear()
        else:
            self.held.update(state)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values(["at_ms", "seq"], kind="stable")
        out, state = run_steps(self.machine, self._read(), zip(pdf["at_ms"].tolist(), pdf["event"].tolist()))
        self._write(state)
        yield _frame(key[0], out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out, state = run_steps(self.machine, self._read(), [], expiredTimerInfo.getExpiryTimeInMs())
        self._write(state)
        yield _frame(key[0], out)

    def close(self) -> None:
        pass


def changes_stream(events: DataFrame, machine, late: str = "0 seconds") -> DataFrame:
    """Changes (key, at_ms, old_state, new_state) of a stream (key, ts, seq, event), in append mode. Events of one micro-batch are taken by (time, seq); those behind the watermark are dropped. Needs the RocksDB state store, which is set for the session."""
    spark = events.sparkSession
    ship(spark)
    spark.conf.set(PROVIDER, ROCKS)
    timed = events.withWatermark("ts", late).selectExpr("key", "ts", "unix_millis(cast(ts as timestamp)) AS at_ms", "seq", "event")
    return timed.groupBy("key").transformWithStateInPandas(_Processor(machine), CHANGES, "Append", "EventTime")


def changes_batch(events: DataFrame, machine, upto_ms: int | None = None) -> DataFrame:
    """The same over a table, with the timers that are due by `upto_ms` (none after the last event, if not given)."""
    ship(events.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["at_ms", "seq"], kind="stable")
        out, _ = run_steps(machine, machine.start(), zip(pdf["at_ms"].tolist(), pdf["event"].tolist()), upto_ms)
        return _frame(pdf["key"].iloc[0], out)

    return events.selectExpr("key", "unix_millis(cast(ts as timestamp)) AS at_ms", "seq", "event").groupBy("key").applyInPandas(run, CHANGES)


class _Counter(StatefulProcessor):
    def __init__(self, keys: list[str]):
        self.keys = keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        added = sum(int(pdf["lodestone_n"].sum()) for pdf in rows)
        total = added + (self.total.get()[0] if self.total.exists() else 0)
        self.total.update((total,))
        yield pd.DataFrame({**{k: [v] for k, v in zip(self.keys, key)}, "total": [total], "added": [added]})

    def close(self) -> None:
        pass


def counter_deltas(stream: DataFrame, keys: list[str], value: str | None = None) -> DataFrame:
    """(keys, total, added) in append mode: for each key of a micro-batch its rows (or the sum of `value`, a whole number) so far, and what the batch adds. State is one number a key; no earlier batch is read."""
    spark = stream.sparkSession
    ship(spark)
    spark.conf.set(PROVIDER, ROCKS)
    kinds = dict(stream.dtypes)
    counted = stream.selectExpr(*keys, f"cast({value or '1'} AS long) AS lodestone_n")
    return counted.groupBy(*keys).transformWithStateInPandas(_Counter(keys), ", ".join([*(f"{k} {kinds[k]}" for k in keys), "total long", "added long"]), "Append", "None")
