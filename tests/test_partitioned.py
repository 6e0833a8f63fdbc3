import io
import json
import os
import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from lodestone.sources import partitioned


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 10**6])
def test_each_line_lies_in_one_range(size):
    r = random.Random(2)
    data = b"".join(bytes(r.choice(b"ab") for _ in range(r.choice([0, 1, 5, 40]))) + b"\n" for _ in range(60)) + b"no end"
    got = [x for at in range(0, len(data), size) for x in partitioned.lines_of_range(io.BytesIO(data), at, min(at + size, len(data)))]
    assert got == data.split(b"\n")


def test_ranges_read_what_one_reader_reads(spark, tmp_path):
    rows = [{"id": k, "text": "é" * (k % 50), "x": None if k % 3 else k / 2} for k in range(500)]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.jsonl").write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows[:300]))
    (tmp_path / "a" / "two.jsonl").write_text("\n\n".join(json.dumps(r) for r in rows[300:]) + "\n")
    (tmp_path / "a" / "_hidden.jsonl").write_text("not json")
    df = partitioned.read_lines(spark, str(tmp_path / "a"), "id long, text string, x double", 700)
    assert df.rdd.getNumPartitions() > 20
    assert {r.id: (r.text, r.x) for r in df.collect()} == {r["id"]: (r["text"], r["x"]) for r in rows}
    assert df.count() == 500


def test_sqlite_by_ranges_with_filters(spark, tmp_path):
    path = str(tmp_path / "c.db")
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE t (name TEXT, size INTEGER, share REAL)")
        c.executemany("INSERT INTO t VALUES (?, ?, ?)", [(f"n{k % 7}" if k % 11 else None, k, k / 4) for k in range(1000)])
        c.execute("DELETE FROM t WHERE size BETWEEN 200 AND 420")
        c.execute("CREATE TABLE none (name TEXT)")
    df = partitioned.read_table(spark, path, "t", "name string, size long, share double", 90)
    assert df.rdd.getNumPartitions() > 8
    want = [(f"n{k % 7}" if k % 11 else None, k, k / 4) for k in range(1000) if not 200 <= k <= 420]
    assert sorted(df.collect(), key=lambda r: r.size) == want
    some = df.where("name = 'n3' and size > 150 and share <= 200.5")
    assert sorted(tuple(r) for r in some.collect()) == [r for r in want if r[0] == "n3" and r[1] > 150 and r[2] <= 200.5]
    assert partitioned.read_table(spark, path, "none", "name string").collect() == []


def test_parts_are_closed_by_bytes_and_appear_whole(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(2000).select("id", F.repeat(F.lit("x"), (F.col("id") % 60).cast("int")).alias("text"), F.lit(None).cast("string").alias("none"), F.lit("2024-01-02").cast("date").alias("day")).repartition(3)
    partitioned.write_lines(df, path, 5000)
    partitioned.write_lines(df.limit(1).withColumn("text", F.repeat(F.lit("y"), 9000)), path, 5000)
    sizes = [os.path.getsize(f"{path}/{f}") for f in os.listdir(path)]
    assert sum(s > 5000 for s in sizes) == 1 and len(sizes) > 20 and not any(f.startswith("_") for f in os.listdir(path))
    back = partitioned.read_lines(spark, path, "id long, text string, day string", 999)
    assert back.count() == 2001 and back.where("text not like 'y%'").select(F.sum("id"), F.countDistinct("id"), F.max("day")).first()[:] == (1999000, 2000, "2024-01-02")


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "bad")
    partitioned.write_lines(spark.range(10), path)
    before = sorted(os.listdir(path))
    bad = spark.range(0, 1000, 1, 4).select("id", F.when(F.col("id") == 900, F.raise_error(F.lit("no"))).alias("x"))
    with pytest.raises(Exception, match="no"):
        partitioned.write_lines(bad, path)
    assert sorted(os.listdir(path)) == before


def test_few_rows_are_python_objects_at_a_time():
    import tracemalloc

    import pyarrow as pa

    rows = pa.RecordBatch.from_pylist([{"id": k, "text": "\u00e9x" * 2500} for k in range(4000)])
    tracemalloc.start()
    n = sum(len(x) for x in partitioned._lines(iter([rows])))
    assert n > 4000 * 7500 and tracemalloc.get_traced_memory()[1] < 4 << 20
    tracemalloc.reset_peak()
    lines = ([k, "y" * 50_000] for k in range(2000))
    sizes = [b.num_rows for b in partitioned._batches(lines, pa.schema([("id", pa.int64()), ("text", pa.string())]))]
    assert sum(sizes) == 2000 and max(sizes) < 100 and tracemalloc.get_traced_memory()[1] < 32 << 20
    tracemalloc.stop()


def test_written_values_of_all_kinds(spark, tmp_path):
    path = str(tmp_path / "kinds")
    df = spark.sql("SELECT 1L AS id, timestamp'2024-01-02 03:04:05.5' AS t, timestamp_ntz'2024-01-02 03:04:05' AS n, map('a', 1) AS m, named_struct('x', array(1, null)) AS s, 1.50BD AS d, X'0aff' AS b, CAST(NULL AS string) AS z")
    partitioned.write_lines(df, path)
    (line,) = [x for f in os.listdir(path) for x in open(f"{path}/{f}")]
    import datetime

    local = datetime.datetime(2024, 1, 2, 3, 4, 5, 500000, datetime.timezone.utc).astimezone().replace(tzinfo=None).isoformat()
    assert json.loads(line) == {"id": 1, "t": local, "n": "2024-01-02T03:04:05", "m": {"a": 1}, "s": {"x": [1, None]}, "d": "1.50", "b": "0aff", "z": None}
