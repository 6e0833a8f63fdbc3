"""What the operators share: session set-up, the shared folder, Arrow text access and rolling hashes."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Rows that one Arrow batch brings to Python; a batch of long texts stays small.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """Let the workers import this package, bound Arrow batches, and make sure a checkpoint folder is set."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where it is unset."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or getattr(spark, "_lodestone_shared", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set, and executors do not see a folder of the driver")
        folder = "file://" + tempfile.mkdtemp(prefix="lodestone-")
        spark._lodestone_shared = folder
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_dir(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def tidy() -> None:
    """Give memory that numpy and Arrow have freed back to the system: workers and the driver live on between stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidied(run):
    """A partition function that tidies up when its partition is done."""

    def then_tidy(batches):
        try:
            yield from run(batches)
        finally:
            tidy()

    return then_tidy


def settle(df: DataFrame, what: str) -> DataFrame:
    """Write a table into the shared folder and read it again: cuts the lineage, and survives lost executors."""
    spark = df.sparkSession
    path = fresh_dir(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle_buckets(df: DataFrame, key: str, buckets: int, what: str) -> DataFrame:
    """Like `settle`, with the rows of a key in one bucket, so that a join by it need not shuffle this side. No table stays in the catalog."""
    spark = df.sparkSession
    path = fresh_dir(spark, what)
    name = "lodestone_" + uuid.uuid4().hex
    df.write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(name)
    table = spark.table(name)
    _ = table.schema  # resolves the files before the name goes
    spark.sql(f"DROP TABLE {name}")
    return table


#: Rows of a few numbers that one task takes: so few are not worth a shuffle.
ONE_TASK = 1 << 17


def only_task(df: DataFrame, whole: bool) -> DataFrame:
    """The table in one partition, if it is known to be small: joins and groups of such tables need no shuffle."""
    return df.coalesce(1) if whole else df


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and its offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold up to `most` bytes, or one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


BASE = np.uint64(0x9E3779B97F4A7C15)
BASE2 = np.uint64(0xD6E8FEB86659FD93)


def powers(n: int, base: np.uint64 = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i mod 2**64 for i up to n (an odd base has an inverse)."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    out = []
    for b in (base, inverse):
        p = np.full(n + 1, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def prefix_hash(data: np.ndarray, power: np.ndarray) -> np.ndarray:
    """H with H[j] - H[i] = sum of (byte + 1) * base**k over i <= k < j."""
    h = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=h[1:])
    return h


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Bytes 0x20 and 0x09 to 0x0D part words.
GAP = np.zeros(256, bool)
GAP[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts that lie one after another, and the first word of each text (one more at the end)."""
    gap = np.empty(len(data) + 1, bool)
    gap[:-1] = GAP[data]
    gap[-1] = True
    before = np.empty(len(data) + 1, bool)
    before[0] = True
    before[1:] = gap[:-1]
    cut = offsets[offsets < len(data)]
    before[cut] = True
    starts = np.flatnonzero(before[:-1] & ~gap[:-1])
    after = gap[1:].copy()
    after[offsets[(offsets > 0)] - 1] = True
    ends = np.flatnonzero(after & ~gap[:-1]) + 1
    return starts, ends, np.searchsorted(starts, offsets)
