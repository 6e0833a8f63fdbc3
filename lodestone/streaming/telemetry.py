"""Telemetry as streams: windowed indicators, a circuit breaker with keyed state, effects once a key.

Late rows beyond the watermark are dropped; the batch forms of these operators have no such rule.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import ratio


def sliding_indicators(http: DataFrame, late: str = "10 minutes", size: str = "10 minutes", step: str = "1 minute") -> DataFrame:
    """Calls, cache hits and 429 ratio by host over sliding windows."""
    g = http.withWatermark("ts", late).groupBy(F.window("ts", size, step), "host")
    net = ~F.col("from_cache")
    return g.agg(F.count(F.lit(1)).alias("calls"), F.count_if("from_cache").alias("cached"), ratio(F.count_if(net & (F.col("status") == 429)), F.nullif(F.count_if(net), F.lit(0)), 6).alias("limited_ratio"))


def sessions(events: DataFrame, key: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), key).agg(F.count(F.lit(1)).alias("n"))


def distinct_effects(effects: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Each effect once, while its key is within the watermark."""
    return effects.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def write_once(effects: DataFrame, path: str, keys: list[str], checkpoint: str):
    """A foreachBatch sink that is safe to run again: a batch writes a folder of its own, whole."""

    def put(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates(keys).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return effects.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)


def fan_out(stream: DataFrame, sinks: list[Callable[[DataFrame, int], None]], checkpoint: str):
    def put(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, number)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)


def breaker_steps(rows: list[tuple[float, bool]], state: tuple, threshold: int, window: float, cooldown: float) -> tuple[list[tuple[float, str, str]], tuple]:
    """Transitions of one host's breaker over (time, failed) in order. state: name, failure times, time it opened."""
    name, fails, opened = state
    fails, out = list(fails), []
    for t, failed in rows:
        if name == "OPEN" and t - opened >= cooldown:
            out.append((t, name, "HALF_OPEN"))
            name = "HALF_OPEN"
        if name == "OPEN":
            continue
        if failed:
            fails = [f for f in fails if t - f < window][-(threshold - 1) :] if threshold > 1 else []
            fails.append(t)
            if name == "HALF_OPEN" or len(fails) >= threshold:
                out.append((t, name, "OPEN"))
                name, opened, fails = "OPEN", t, []
        elif name == "HALF_OPEN":
            out.append((t, name, "CLOSED"))
            name, fails = "CLOSED", []
    return out, (name, fails, opened)


def _transitions(host: str, out: list[tuple[float, str, str]]) -> pd.DataFrame:
    text = lambda x: pd.Series(x, dtype=object)
    return pd.DataFrame({"host": text([host] * len(out)), "ts": pd.Series([float(t) for t, _, _ in out], dtype=float), "old_state": text([a for _, a, _ in out]), "new_state": text([b for _, _, b in out])})


def breaker(calls: DataFrame, threshold: int = 5, window: float = 30.0, cooldown: float = 60.0) -> DataFrame:
    """Transitions (host, ts, old_state, new_state) of a stream of calls (host, ts, failed), with state by host."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        name, fails, opened = state.get if state.exists else ("CLOSED", [], 0.0)
        pdf = pd.concat(list(frames)).sort_values("ts", kind="stable")
        rows = list(zip(pdf["ts"].astype("int64") / 1e9 if pdf["ts"].dtype.kind != "M" else pdf["ts"].map(pd.Timestamp.timestamp), pdf["failed"]))
        out, (name, fails, opened) = breaker_steps(rows, (name, fails, opened), threshold, window, cooldown)
        state.update((name, list(fails), float(opened)))
        yield _transitions(key[0], out)

    return calls.groupBy("host").applyInPandasWithState(run, "host string, ts double, old_state string, new_state string", "name string, fails array<double>, opened double", "append", GroupStateTimeout.NoTimeout)


def breaker_batch(calls: DataFrame, threshold: int = 5, window: float = 30.0, cooldown: float = 60.0) -> DataFrame:
    """The same over a table."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["ts", "event_id"], kind="stable")
        out, _ = breaker_steps(list(zip(pdf["ts"].map(pd.Timestamp.timestamp), pdf["failed"])), ("CLOSED", [], 0.0), threshold, window, cooldown)
        return _transitions(pdf["host"].iloc[0], out)

    return calls.groupBy("host").applyInPandas(run, "host string, ts double, old_state string, new_state string")


def running_counts(stream: DataFrame, keys: list[str], value: str | None = None) -> DataFrame:
    """Counts (and a sum) by key over all of a stream so far; in update mode a batch gives the keys that changed."""
    sums = [F.sum(value).alias("total")] if value else []
    return stream.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *sums)
