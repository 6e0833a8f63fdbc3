"""Exact top-k search: tiled matrix products of queries and shards, partial selection per tile, tree merging.

Vectors are packed into tiles of at most `tile_rows` rows, held as one binary row each in the narrowest whole numbers that hold them. Tiles of all
rows are dealt to lanes of about `lane_tiles`; query tiles go to every lane (a stated query set against all rows, in blocks). A cell is a
query tile in a lane: a task works through one cell after another, and holds the top lists of one query tile. The lists of lanes
are merged `fan_in` at a time until one list a query is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare

TILE_ROWS = 1024
LANE_TILES = 64
FAN_IN = 16


def _blocks(rows: int, prefix: str = ""):
    """(id, components as long array) rows -> (ids, dim, width, components) of up to `rows` vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            ids = np.concatenate([h[0] for h in held])
            dim = max(h[1].shape[1] for h in held)
            mat = np.concatenate([np.pad(h[1], ((0, 0), (0, dim - h[1].shape[1]))) for h in held])
            held.clear()
            low, high = mat.min(initial=0), mat.max(initial=0)
            width = next(w for w in (1, 2, 4, 8) if -(1 << (8 * w - 1)) <= low and high < 1 << (8 * w - 1))
            return pa.RecordBatch.from_arrays([pa.array([ids.tobytes()]), pa.array([dim], pa.int32()), pa.array([width], pa.int32()), pa.array([mat.astype(f"<i{width}").tobytes()])], [prefix + c for c in ("ids", "dim", "width", "mat")])

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            vec = batch.column(1)
            off = vec.offsets.to_numpy()
            flat = vec.values.to_numpy(zero_copy_only=False)
            sizes = np.diff(off)
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                for i in range(0, len(at), rows):
                    some = at[i : i + rows]
                    held.append((ids[some], flat[off[some][:, None] + np.arange(dim)].reshape(len(some), dim).astype(np.int64)))
                    if sum(len(h[0]) for h in held) >= rows:
                        yield flush()
        if held:
            yield flush()

    return run


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: by floating point where every partial sum is below 2**53, else by Python's integers, held within 64 bits."""
    d = min(q.shape[1], v.shape[1])
    q, v = q[:, :d], v[:, :d]
    bound = d * float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(v.astype(float)).max(initial=0))
    if bound < 2**53:
        return (q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    if bound < 2**62:
        return q @ v.T
    exact = q.astype(object) @ v.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id, in that order."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _matrix(ids: bytes, dim: int, width: int, mat: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(mat, f"<i{width}").reshape(len(ids), dim).astype(np.int64)


def _tiles(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, qi, q, tops = None, None, None, []

        def lists() -> pa.RecordBatch:
            n = [len(t[0]) for t in tops]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(sum(n), cell[0], np.int64)), pa.array(np.repeat(qi, n)), pa.array(np.concatenate([t[1] for t in tops])), pa.array(np.concatenate([t[0] for t in tops]))],
                ["lane", "query_id", "vec_id", "score"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                if cell != (row["lane"], row["q_ids"]):
                    if cell:
                        yield lists()
                    cell = row["lane"], row["q_ids"]
                    qi, q = _matrix(row["q_ids"], row["q_dim"], row["q_width"], row["q_mat"])
                    tops = [(np.zeros(0, np.int64),) * 2 for _ in qi]
                vi, v = _matrix(row["ids"], row["dim"], row["width"], row["mat"])
                s = products(q, v)
                for i, me in enumerate(qi):
                    line, ids = s[i], vi
                    if len(tops[i][0]) == k:
                        at = np.flatnonzero(line >= tops[i][0][-1])
                        line, ids = line[at], ids[at]
                    keep = ids != me
                    line, ids = np.concatenate((tops[i][0], line[keep])), np.concatenate((tops[i][1], ids[keep]))
                    at = best(line, ids, k)
                    tops[i] = (line[at], ids[at])
        if cell:
            yield lists()

    return run


def search(vectors: DataFrame, is_query, k: int = 20, scale: int = 64, tile_rows: int = TILE_ROWS, lane_tiles: int = LANE_TILES, fan_in: int = FAN_IN) -> DataFrame:
    """The k rows of `vectors` (vec_id, embedding) with the highest inner products, for each row where `is_query` holds.

    Components become floor(scale * x). Gives query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id; a row is
    never its own candidate. Rows whose id, vector or any component is null, NaN or infinite take no part; vectors
    of unequal length meet over the shorter one; an empty vector scores 0; repeated ids are candidates each; no rows
    or no queries give no rows; other columns are not read. Scores beyond 64 bits are held at its ends.
    """
    spark = prepare(vectors.sparkSession)
    ok = F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    rows = vectors.filter(ok).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"), is_query.alias("is_q"))
    n, n_q = rows.agg(F.count(F.lit(1)), F.count_if("is_q")).first()
    # a lane is a set of tiles; every query tile goes once to every lane
    lanes = max(1, -(-n // (tile_rows * lane_tiles)), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // tile_rows)))
    dealt = rows.repartition(lanes, F.xxhash64("vec_id")) if lanes > 1 else rows
    shards = dealt.select("vec_id", "v").mapInArrow(_blocks(tile_rows), "ids binary, dim int, width int, mat binary")
    asked = rows.filter("is_q").select("vec_id", "v").repartition(max(1, -(-n_q // tile_rows)), "vec_id").mapInArrow(_blocks(tile_rows, "q_"), "q_ids binary, q_dim int, q_width int, q_mat binary")
    shards = shards.withColumn("lane", F.pmod(F.xxhash64("ids"), F.lit(lanes)))
    asked = asked.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))))
    # in a merge join the left row meets all tiles of its lane in turn: a cell
    cells = asked.hint("merge").join(shards, "lane").select("lane", "q_ids", "q_dim", "q_width", "q_mat", "ids", "dim", "width", "mat")
    lists = cells.mapInArrow(_tiles(k), "lane long, query_id long, vec_id long, score long")
    order = [F.col("score").desc(), F.col("vec_id").asc()]
    while lanes > fan_in:
        lists = lists.withColumn("lane", F.floor(F.col("lane") / F.lit(fan_in)))
        w = Window.partitionBy("query_id", "lane").orderBy(*order)
        lists = lists.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).drop("rank")
        lanes = -(-lanes // fan_in)
    w = Window.partitionBy("query_id").orderBy(*order)
    ranked = lists.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op5_topk(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.pmod(F.col("vec_id"), F.lit(20)) == 0)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
