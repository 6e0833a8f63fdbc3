"""An inverted file with product codes: centres moved over all rows from a bounded sample, kept as tables, searched by cells and distance tables, exact on what it keeps.

Codebooks are arrays of fixed size. Rows (namespace, id, cell, code, vector) are a plain table partitioned by namespace, so an index is saved by
writing it, restored by reading it, and routed or evicted by its namespace.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import ship
from .retrieval import DIGITS, _unit, top_k

#: Rows and numbers of the training sample at most.
SAMPLE, NUMBERS = 50_000, 16 << 20
#: Cells at most, and queries that are searched for at once.
MOST_CELLS, MOST_QUERIES = 4096, 1024


def lloyd(x: np.ndarray, k: int, steps: int = 10, seed: int = 0) -> np.ndarray:
    """k centres of the rows of x, by nearest Euclidean distance; fewer rows give as many centres."""
    c = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(steps):
        near = nearest(x, c)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(c))
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(1)[None] - 2 * x @ c.T).argmin(1)


@dataclass
class Codes:
    """Cell centres, and a codebook for each of the equal parts of a residual."""

    centres: np.ndarray
    books: np.ndarray  # parts, codes, numbers of a part

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = nearest(x, self.centres)
        rest = (x - self.centres[cell]).reshape(len(x), len(self.books), -1)
        return cell, np.stack([nearest(rest[:, p], b) for p, b in enumerate(self.books)], 1).astype(np.uint8)

    def decode(self, cell: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The vectors that cells and codes stand for."""
        return self.centres[cell] + np.concatenate([b[code[:, p]] for p, b in enumerate(self.books)], 1)

    def to_json(self) -> str:
        return json.dumps({"centres": self.centres.tolist(), "books": self.books.tolist()})

    @staticmethod
    def from_json(text: str) -> Codes:
        d = json.loads(text)
        return Codes(np.array(d["centres"]), np.array(d["books"]))


def _unit32(column: pa.Array, dim: int) -> np.ndarray:
    v = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim).astype(np.float64)
    return v / np.where((n := np.linalg.norm(v, axis=1, keepdims=True)) > 0, n, 1)


def refine_centres(vectors: DataFrame, centres: np.ndarray, vec: str = "embedding", steps: int = 2) -> np.ndarray:
    """Lloyd's steps over all rows: tasks sum their rows by cell, sums are added by cell, and only the new centres come to the driver. An empty cell keeps its centre."""
    dim = centres.shape[1]
    rows = vectors.where(F.size(vec) == dim).select(F.col(vec).cast("array<double>").alias("v"))
    for _ in range(steps):
        sent = vectors.sparkSession.sparkContext.broadcast(centres)

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros_like(sent.value), np.zeros(len(sent.value), np.int64)
            for batch in batches:
                x = _unit32(batch.column(0), dim)
                cell = nearest(x, sent.value)
                np.add.at(total, cell, x)
                n += np.bincount(cell, minlength=len(n))
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(list(total[at]), pa.list_(pa.float64())), pa.array(n[at])], ["cell", "s", "n"])

        # a row a cell and task, added up by cell
        added = rows.mapInArrow(sums, "cell int, s array<double>, n long").groupBy("cell")
        zero = F.array_repeat(F.lit(0.0), dim)
        added = added.agg(F.aggregate(F.collect_list("s"), zero, lambda a, x: F.zip_with(a, x, lambda i, j: i + j)).alias("s"), F.sum("n").alias("n")).toArrow()
        centres = centres.copy()
        for cell, total, n in zip(*(added[c].to_pylist() for c in ("cell", "s", "n"))):
            centres[cell] = np.array(total) / n
    return centres


def train(vectors: DataFrame, cells: int | None = None, parts: int = 8, codes: int = 64, seed: int = 0, key: str = "vec_id", vec: str = "embedding", sample: int = SAMPLE, steps: int = 2) -> Codes:
    """Codebooks for vectors, L2-normalised, whose length is a multiple of `parts`. By default there are as many cells as the root of the rows, MOST_CELLS at most.

    Centres start from at most `sample` rows (and NUMBERS numbers), drawn by a hash of the id, and are moved by `steps` of Lloyd's over all rows; codebooks of residuals come from the same sample.
    """
    ship(vectors.sparkSession)
    rows = vectors.where(F.size(vec) > 0)
    dim = infer_dim(rows, vec) or parts
    rows = rows.where(F.size(vec) == dim)
    cells = cells or max(1, min(MOST_CELLS, round(rows.count() ** 0.5)))
    some = rows.orderBy(F.xxhash64(F.lit(seed), key), key).limit(min(sample, max(codes, NUMBERS // dim))).select(F.col(vec).cast("array<double>").alias("v")).toArrow()
    x = _unit([np.asarray(v) for v in some["v"].to_pylist()]) if some.num_rows else np.zeros((1, dim))
    centres = refine_centres(rows, lloyd(x, cells, seed=seed), vec, steps) if some.num_rows else lloyd(x, cells, seed=seed)
    rest = (x - centres[nearest(x, centres)]).reshape(len(x), parts, -1)
    books = [lloyd(rest[:, p], codes, seed=seed + p + 1) for p in range(parts)]
    return Codes(centres, np.stack(books))


def infer_dim(vectors: DataFrame, vec: str = "embedding") -> int | None:
    """The length of a vector that is there, or nothing."""
    row = vectors.where(F.size(vec) > 0).select(F.size(vec)).first()
    return row[0] if row else None


def build(vectors: DataFrame, codes: Codes, key: str = "vec_id", vec: str = "embedding", namespace: str | None = None) -> DataFrame:
    """(namespace, id, cell, code, vector) of every row whose vector has the trained length."""
    ship(vectors.sparkSession)
    sent = vectors.sparkSession.sparkContext.broadcast(codes)
    dim = codes.centres.shape[1]
    rows = vectors.where(F.size(vec) == dim).select((F.col(namespace).cast("string") if namespace else F.lit("default")).alias("namespace"), F.col(key).cast("long").alias("id"), F.col(vec).cast("array<float>").alias("vector"))

    def run(batches):
        for pdf in batches:
            if len(pdf):
                cell, code = sent.value.encode(_unit(list(pdf["vector"])))
                yield pdf.assign(cell=cell.astype(np.int32), code=[c.tobytes() for c in code])[["namespace", "id", "cell", "code", "vector"]]

    return rows.mapInPandas(run, "namespace string, id long, cell int, code binary, vector array<float>")


@dataclass
class Asked:
    """A block of queries: unit vectors' products with the centres and with each part's codes, and the queries that probe a cell."""

    ids: list
    by_centre: np.ndarray  # queries, cells
    tables: np.ndarray  # queries, parts, codes
    probing: dict[int, np.ndarray]

    @staticmethod
    def of(ids: list, q: np.ndarray, codes: Codes, probes: int) -> Asked:
        c = codes.centres
        near = ((c * c).sum(1)[None] - 2 * q @ c.T).argsort(1)[:, :probes]
        parts = q.reshape(len(q), len(codes.books), -1)
        tables = np.einsum("qpd,pcd->qpc", parts, codes.books).astype(np.float32)
        return Asked(ids, q @ c.T, tables, {cell: np.flatnonzero((near == cell).any(1)) for cell in np.unique(near).tolist()})


def _by_tables(sent, most: int):
    """(id, cell, code) -> (query_id, id, cell, score): the best `most` rows of this partition for each query, scored by sums of table entries; no vector is decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Asked = sent.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0)) for _ in asked.ids]
        for batch in batches:
            ids, cells = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            code = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(len(ids), -1)
            for cell in np.unique(cells).tolist():
                at, qs = np.flatnonzero(cells == cell), asked.probing.get(cell, ())
                for q in qs:
                    score = asked.by_centre[q, cell] + asked.tables[q][np.arange(code.shape[1]), code[at]].sum(1, dtype=np.float64)
                    i, c, s = np.append(best[q][0], ids[at]), np.append(best[q][1], np.full(len(at), cell, np.int32)), np.append(best[q][2], score)
                    if len(s) > most:
                        keep = np.lexsort((i, -s))[:most]
                        i, c, s = i[keep], c[keep], s[keep]
                    best[q] = i, c, s
        n = [len(s) for *_, s in best]
        if sum(n):
            columns = [pa.array(np.repeat(np.array(asked.ids, np.int64), n)), *(pa.array(np.concatenate([b[k] for b in best])) for k in range(3))]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "id", "cell", "score"])

    return run


def search(queries: DataFrame, index: DataFrame, codes: Codes, k: int = 10, probes: int = 8, refine: int = 8, namespace: str | None = None) -> DataFrame:
    """(query_id, id, rank, score): cosine of the k best. A query reads the codes of its `probes` nearest cells, and the vectors of its best k * refine rows by codes alone.

    Rows are read where they lie: a block of at most MOST_QUERIES queries is sent with its distance tables, only k * refine rows a query and task leave it,
    and a cell of any size is many tasks' work. More queries are taken in turns.
    """
    spark = queries.sparkSession
    ship(spark)
    rows = index if namespace is None else index.where(F.col("namespace") == namespace)
    q = queries.where(F.size("vector") == codes.centres.shape[1]).select(F.col("query_id").cast("long").alias("query_id"), F.col("vector").cast("array<float>").alias("vector"))
    table, out = q.limit(MOST_QUERIES + 1).toArrow(), None
    turns = 1 if table.num_rows <= MOST_QUERIES else -(-2 * q.count() // MOST_QUERIES)
    for turn in range(turns):
        mine = table if turns == 1 else q.where(F.pmod(F.xxhash64("query_id"), F.lit(turns)) == turn).toArrow()
        if not mine.num_rows:
            continue
        x = _unit([np.asarray(v) for v in mine["vector"].to_pylist()])
        asked = Asked.of(mine["query_id"].to_pylist(), x, codes, probes)
        some = rows.where(F.col("cell").isin(list(asked.probing))) if len(asked.probing) < len(codes.centres) else rows
        found = some.select("id", "cell", "code").mapInArrow(_by_tables(spark.sparkContext.broadcast(asked), k * refine), "query_id long, id long, cell int, score double")
        rough = F.broadcast(top_k(found, k * refine, "id").select("query_id", "id", "cell"))  # k * refine rows for each of MOST_QUERIES queries at most
        units = spark.sparkContext.broadcast(dict(zip(asked.ids, x)))

        def exact(batches, units=units):
            for pdf in batches:
                if len(pdf):
                    s = np.einsum("ij,ij->i", np.stack([units.value[i] for i in pdf["query_id"]]), _unit(list(pdf["vector"])))
                    yield pd.DataFrame({"query_id": pdf["query_id"], "id": pdf["id"], "score": np.round(s, DIGITS)})

        scored = some.select("id", "cell", "vector").join(rough, ["id", "cell"]).select("query_id", "id", "vector").mapInPandas(exact, "query_id long, id long, score double")
        out = scored if out is None else out.unionByName(scored)
    return top_k(out if out is not None else spark.createDataFrame([], "query_id long, id long, score double"), k, "id")


def work(queries: DataFrame, index: DataFrame, codes: Codes, probes: int) -> DataFrame:
    """(query_id, read, total): rows whose codes a query reads, and all rows."""
    sizes = {r["cell"]: r["n"] for r in index.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a cell
    c, total = codes.centres, sum(sizes.values())
    weights = np.array([sizes.get(i, 0) for i in range(len(c))])

    @F.pandas_udf("long")
    def read(v: pd.Series) -> pd.Series:
        near = ((c * c).sum(1)[None] - 2 * _unit(list(v)) @ c.T).argsort(1)[:, :probes]
        return pd.Series(weights[near].sum(1))

    return queries.where(F.size("vector") == c.shape[1]).select("query_id", read("vector").alias("read"), F.lit(total).alias("total"))


def save(index: DataFrame, codes: Codes, path: str, mode: str = "errorifexists") -> None:
    """The rows by namespace, and the codebooks beside them: the rows come first, so a folder with codebooks is whole."""
    # in order of cells within files, so that a search reads the row groups of its cells
    index.repartitionByRange("namespace", "cell", "id").sortWithinPartitions("namespace", "cell", "id").write.mode(mode).partitionBy("namespace").parquet(f"{path}/rows")
    index.sparkSession.createDataFrame([(codes.to_json(),)], "codes string").coalesce(1).write.mode(mode).parquet(f"{path}/codes")


def load(spark: SparkSession, path: str) -> tuple[DataFrame, Codes]:
    codes = Codes.from_json(spark.read.parquet(f"{path}/codes").first()[0])
    return spark.read.schema("id long, cell int, code binary, vector array<float>, namespace string").parquet(f"{path}/rows"), codes


def snapshot(index: DataFrame) -> DataFrame:
    """Rows and cells in use by namespace."""
    return index.groupBy("namespace").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("cell").alias("cells"))


def idle_namespaces(use: DataFrame, now, seconds: int) -> DataFrame:
    """Namespaces whose last use (namespace, ts) is longer ago than that: those to evict."""
    last = use.groupBy("namespace").agg(F.max("ts").alias("last_used"))
    return last.where(F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("last_used") > seconds)


def reconstruct(index: DataFrame, ids: DataFrame) -> DataFrame:
    """The stored vectors of the ids asked for; ids that are not there give null."""
    return ids.select("id").join(index.select("id", "vector"), "id", "left")


def both_or_neither(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Of two writes that belong together, the rows that both hold: what is on one side alone is rolled back."""
    return left.join(right.select(key).distinct(), key, "left_semi"), right.join(left.select(key).distinct(), key, "left_semi")
