import datetime as dt

import pytest
from pyspark.sql import functions as F

from lodestone.sources import datasets
from lodestone.streaming import telemetry as streams


def test_dataset_round_trip(spark, tmp_path):
    root = str(tmp_path / "Chunks")
    rows = spark.range(1025).select(F.concat(F.lit("doc-"), F.floor(F.col("id") / 10).cast("string")).alias("doc_id"), F.col("id").alias("chunk_id"), F.concat(F.lit("chunk text "), F.col("id").cast("string")).alias("text"), F.col("id").cast("int").alias("tokens"))
    rows = rows.withColumn("span", F.struct(F.lit(0).alias("start"), F.length("text").alias("end"))).withColumn("created_at", F.timestamp_seconds(F.lit(1704067200) + F.col("chunk_id") * 86400 % 5000000)).withColumn("schema_version", F.lit("chunks/1.0.0")).withColumn("section", F.lit(None).cast("string")).withColumn("meta", F.lit(None).cast("map<string,string>"))
    datasets.write_dataset(rows, root, datasets.CHUNKS, fmt="parquet")
    back = datasets.open_chunks(spark, root, ["doc_id", "tokens"], "mm = '01'")
    assert 0 < back.count() < 1025 and back.columns == ["doc_id", "tokens"]
    s = datasets.summarize(datasets.open_chunks(spark, root), "doc_id")
    assert s["rows"] == 1025 and sum(s["months"].values()) == 1025 and s["files"] >= 2 and len(s["sample"]) == 10
    keys = datasets.partition_keys(F.col("_metadata.file_path"))
    assert datasets.open_chunks(spark, root).select(keys["fmt"].alias("f"), keys["yyyy"].alias("y")).distinct().count() == 1
    with pytest.raises(ValueError):
        datasets.write_dataset(rows.drop("tokens"), root, datasets.CHUNKS)
    with pytest.raises(ValueError):
        datasets.open_vectors(spark, root, "other")


def test_json_lines_listing_and_scopes(spark, tmp_path):
    p = tmp_path / "rows.jsonl"
    p.write_text('{"a": 1}\nnot json\n{"a": 2}\n')
    schema = datasets.T.StructType.fromDDL("a int")
    assert sorted(r.a for r in datasets.read_jsonl(spark, str(p), schema, 1).collect()) == [1, 2]
    with pytest.raises(ValueError):
        datasets.read_jsonl(spark, str(p), schema)
    assert [(r.relpath, r.size_bytes) for r in datasets.listing(spark, str(tmp_path), "*.jsonl").collect()] == [("rows.jsonl", p.stat().st_size)]
    t = str(tmp_path / "staging")
    for n in (1, 2):
        datasets.stage_listing(spark.createDataFrame([("x", n)], "scope string, n int"), t)
    datasets.stage_listing(spark.createDataFrame([("y", 9)], "scope string, n int"), t)
    assert sorted((r.scope, r.n) for r in spark.read.parquet(t).collect()) == [("x", 2), ("y", 9)]
    for fmt in ("csv", "json", "orc"):
        datasets.write_rows(spark.range(5), str(tmp_path / fmt), fmt)
        assert spark.read.format(fmt).load(str(tmp_path / fmt)).count() >= 5


@pytest.fixture()
def calls(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, f"h{i % 2}", t0 + dt.timedelta(seconds=10 * i), i % 5 in (0, 1, 2), i % 3 == 0, 429 if i % 4 == 0 else 200) for i in range(120)]
    df = spark.createDataFrame(rows, "event_id long, host string, ts timestamp, failed boolean, from_cache boolean, status int")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    return df, spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))


def _drain(stream, name, mode, spark, tmp_path):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).start()
    q.processAllAvailable()
    q.stop()
    return spark.table(name)


def test_sliding_stream_equals_batch(spark, tmp_path, calls):
    batch, stream = calls
    got = _drain(streams.sliding_indicators(stream), "sliding", "complete", spark, tmp_path)
    want = streams.sliding_indicators(batch)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_breaker_stream_equals_batch(spark, tmp_path, calls):
    batch, stream = calls
    got = _drain(streams.breaker(stream.select("host", "ts", "failed"), 3, 120.0, 60.0), "breaker", "append", spark, tmp_path)
    want = streams.breaker_batch(batch, 3, 120.0, 60.0)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 0


def test_breaker_rules():
    out, state = streams.breaker_steps([(0, True), (1, True), (2, False), (20, False), (21, True), (40, False)], ("CLOSED", [], 0.0), 2, 10.0, 15.0)
    assert out == [(1, "CLOSED", "OPEN"), (20, "OPEN", "HALF_OPEN"), (20, "HALF_OPEN", "CLOSED")] and state[0] == "CLOSED"


def test_effects_once(spark, tmp_path, calls):
    _, stream = calls
    q = streams.write_once(streams.distinct_effects(stream, ["host"]), str(tmp_path / "effects"), ["host"], str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "effects")).count() == 2
