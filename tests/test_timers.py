import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from lodestone.streaming import timers

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
MS = int(T0.timestamp() * 1000)


def batches(kind):
    r = random.Random(3)
    out, t = [], 0
    for _ in range(4):
        rows = []
        for _ in range(60):
            t += r.choice([1, 1, 2, 40])
            event = r.random() < 0.6 if kind == "breaker" else r.choice(["lease", "heartbeat", "done"])
            rows.append((f"k{r.randrange(4)}", T0 + timedelta(seconds=t), len(out) * 100 + len(rows), event))
        out.append(rows)
    return out


def machine(kind):
    return timers.Breaker(3, 30_000, 60_000) if kind == "breaker" else timers.Lease(25_000)


@pytest.mark.parametrize("kind", ["breaker", "lease"])
def test_stream_equals_batch_over_restarts(spark, tmp_path, kind):
    schema = f"key string, ts timestamp, seq long, event {'boolean' if kind == 'breaker' else 'string'}"
    parts = batches(kind)
    parts.append([("last", T0 + timedelta(days=1), 10**6, parts[0][0][3])])  # moves the watermark past all timers
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"p={i}"))
        # each part is a run of its own from the same checkpoint
        source = spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "p=*"))
        stream = timers.changes_stream(source, machine(kind))
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).outputMode("append").trigger(availableNow=True).start().awaitTermination(120)
    whole = spark.createDataFrame([r for p in parts for r in p], schema)
    got = sorted(tuple(r) for r in spark.read.schema(timers.CHANGES).parquet(str(tmp_path / "out")).where("key <> 'last'").collect())
    want = sorted(tuple(r) for r in timers.changes_batch(whole, machine(kind), MS + 86_400_000).where("key <> 'last'").collect())
    assert got == want and len(want) > 20


def test_a_timer_that_is_due_comes_before_the_call():
    b = timers.Breaker(2, 1000, 5000)
    out, state = timers.run_steps(b, b.start(), [(0, True), (10, True), (20, True), (5010, True), (10010, False)])
    assert out == [(10, "CLOSED", "OPEN"), (5010, "OPEN", "HALF_OPEN"), (5010, "HALF_OPEN", "OPEN"), (10010, "OPEN", "HALF_OPEN"), (10010, "HALF_OPEN", "CLOSED")]
    assert b.over(state)


def test_empty_table(spark):
    none = spark.createDataFrame([], "key string, ts timestamp, seq long, event boolean")
    assert timers.changes_batch(none, timers.Breaker(2, 1, 1)).select(F.count("*")).first()[0] == 0
