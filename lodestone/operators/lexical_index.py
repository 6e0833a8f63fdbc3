"""A stored, impact-ordered inverted index: built once, appended to, and searched by skipping documents.

Documents are dealt to shards of about SHARD_DOCS, of SHARD_BYTES at most, of like size, by a hash of their key. A row of the index holds the postings of one term in one shard, largest
counts in the shortest documents first, and for each run of RUN postings what bounds their weights: the largest count, the smallest length, the largest
sparse weight. One more row a shard holds its documents. Rows lie sorted by term, so that a search reads the row groups
of its terms.

A search deals its terms' rows by shard, and takes the shards of the longest documents first. In a shard, a query takes its terms from the largest bound down and keeps the k-th best score so far, of this
and earlier shards, as its floor. A run whose bound, with all that later terms can add, stays under the floor brings no new
documents; and once later terms cannot reach the floor at all, only documents that still can are looked up in them. All other
postings are never scored. The rows are those of a search over all postings.

A segment is written before its row of figures, so an append that fails leaves nothing that a search reads.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import tokenize
from .retrieval import CHANNEL_K, DIGITS, parts_of, top_k

SHARD_DOCS = 1024
#: Bytes of text of a shard, about: shards of longer documents hold fewer of them.
SHARD_BYTES = 4 << 20
#: Bytes of text to a word, about.
WORD_BYTES = 6
#: Postings that share one bound.
RUN = 64
#: Files at most that the rows of one term are spread over by one write.
SPREAD = 64
#: Terms of queries that are searched for at once; more are taken in turns.
MOST_TERMS = 1 << 18
#: Slack of a bound against rounding.
SLACK = 1e-6
K1, B = 1.2, 0.75

#: Documents of a shard: the row of no term.
DOCS = ""
ROWS = "segment string, shard long, term string, n int, at array<int>, tf array<int>, max_tf array<int>, min_dl array<long>, max_sparse array<double>, key array<long>, dl array<long>, top array<int>"
SEGMENTS = "segment string, docs long, tokens long"
GONE = "segment string, shard long, at array<int>, docs long, tokens long"


def shard_rows(docs: DataFrame, tokens: Column, key: str, segment: str, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Index rows of documents (key, text), whose keys are unique. Texts are shuffled once, by shard; all that follows keeps that partitioning."""
    size = F.floor(F.log2(F.octet_length("text") + F.lit(1)) * 2).cast("int")
    rows = docs.where(F.col(key).isNotNull() & F.col("text").isNotNull()).select(F.col(key).cast("long").alias("key"), "text", size.alias("size"))
    shard, parts = _shard(rows.select("key", "size"), shard_docs)
    words = rows.select("key", "text", shard.alias("shard")).repartition(parts, "shard").select("shard", "key", tokens.alias("words")).where(F.size("words") > 0)
    return rows_of(words.select("shard", "key", F.explode(F.concat(F.array(F.lit(DOCS)), "words")).alias("term")).groupBy("shard", "key", "term").agg(F.count(F.lit(1)).cast("int").alias("tf")), segment)


def _shard(rows: DataFrame, shard_docs: int, unit: int = 1) -> tuple[Column, int]:
    """The shard of a row (key, size): of those of its size, by a hash of the key. Larger sizes have larger numbers. And the partitions that all texts ask for, of `unit` bytes to one of size."""
    # sizes are halves of a power of two: some 70 at most
    counts = {r["size"]: r["n"] for r in rows.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = lambda s: max(1, min(shard_docs, int(SHARD_BYTES // (unit * 2 ** ((s + 1) / 2)))))
    shards = F.create_map(*(F.lit(x) for s, n in counts.items() for x in (s, max(1, -(-n // most(s)))))) if counts else F.lit(None).cast("map<int,int>")
    place = F.col("size").cast("long") * F.lit(1 << 40) + F.pmod(F.xxhash64("key"), F.element_at(shards, F.col("size")))
    return place, parts_of(int(sum(n * unit * 2 ** ((s + 1) / 2) for s, n in counts.items())))


def rows_of(post: DataFrame, segment: str) -> DataFrame:
    """(shard, key, term, tf), with a posting of no term for each document -> a row for each shard and term, and one for the documents of a shard."""
    # A shard is a group of bounded size, so its documents and a term's postings in it are arrays of bounded size.
    own, word = Window.partitionBy("shard", "key"), F.when(F.col("term") != DOCS, F.col("tf"))
    post = post.withColumn("dl", F.coalesce(F.sum(word).over(own), F.lit(0).cast("long"))).withColumn("top", F.coalesce(F.max(word).over(own), F.lit(0)))
    post = post.withColumn("at", F.dense_rank().over(Window.partitionBy("shard").orderBy("key")) - 1)
    is_docs = F.col("term") == DOCS
    first = F.when(is_docs, F.col("at")).otherwise(-F.col("tf"))  # documents by place, postings by count
    rows = post.groupBy("shard", "term").agg(F.sort_array(F.collect_list(F.struct(first.alias("first"), "dl", "at", "top", F.when(is_docs, F.col("key")).alias("key")))).alias("p"))
    starts = F.sequence(F.lit(1), F.size("p"), F.lit(RUN))
    runs = lambda f: F.transform(starts, lambda i: f(F.slice("p", i, F.lit(RUN))))
    sparse = lambda x: F.log1p(-x["first"]) * (0.5 - x["first"] / x["top"])
    of_word, of_docs = lambda c: F.when(~is_docs, c), lambda c: F.when(is_docs, F.col(f"p.{c}"))
    return rows.select(
        F.lit(segment).alias("segment"), "shard", "term", F.size("p").alias("n"), of_word(F.col("p.at")).alias("at"), of_word(F.transform("p", lambda x: -x["first"])).alias("tf"),
        of_word(runs(lambda r: -F.get(r, F.lit(0))["first"])).alias("max_tf"), of_word(runs(lambda r: F.array_min(F.transform(r, lambda x: x["dl"])))).alias("min_dl"),
        of_word(runs(lambda r: F.array_max(F.transform(r, sparse)))).alias("max_sparse"), of_docs("key").alias("key"), of_docs("dl").alias("dl"), of_docs("top").alias("top"),
    )


@dataclass
class Request:
    """What all shards need to know of a search: the terms of each query with their weights, and how postings are weighed."""

    ids: list
    asked: list[list[tuple[str, float]]]
    kind: str
    k: int
    k1: float
    b: float
    avgdl: float

    def weigh(self, tf: np.ndarray, dl: np.ndarray, top: np.ndarray) -> np.ndarray:
        if self.kind == "sparse":
            return np.log1p(tf) * (0.5 + tf / top)
        w = 1 + np.log1p(tf)
        return w if self.kind == "compat" else w * (self.k1 + 1) / (w + self.k1 * (1 - self.b + self.b * dl / self.avgdl))

    def bound(self, row: dict) -> np.ndarray:
        return row["max_sparse"] if self.kind == "sparse" else self.weigh(row["max_tf"], row["min_dl"], row["max_tf"])


def _search_shard(req: Request, asked: list[tuple[str, float]], rows: dict[str, dict], docs: dict, dead: np.ndarray, floor: float) -> tuple[np.ndarray, int, int]:
    """Scores of a shard's documents for one query, exact where they reach the floor; postings scored, and postings there."""
    mine = sorted(((q * rows[t]["bound"].max(), q, rows[t]) for t, q in asked if t in rows), key=lambda x: -x[0])
    rest = np.append(np.cumsum([c for c, *_ in mine][::-1])[::-1], 0.0)
    acc, scored = np.zeros(len(docs["key"])), 0
    total = sum(len(r["at"]) for *_, r in mine)
    if rest[0] < floor - SLACK:
        return acc, 0, total
    for i, (_, q, row) in enumerate(mine):
        at = row["at"]
        if rest[i] >= floor - SLACK:
            fresh = np.flatnonzero(q * row["bound"] + rest[i + 1] >= floor - SLACK)
            upto = (fresh[-1] + 1) * RUN if len(fresh) else 0
            pos = np.append(np.arange(min(upto, len(at))), upto + np.flatnonzero(acc[at[upto:]] > 0))
        else:
            pos = np.flatnonzero((acc + rest[i] >= floor - SLACK)[at] & (acc[at] > 0))
        if dead.any():
            pos = pos[~dead[at[pos]]]
        some = at[pos]
        acc[some] += q * req.weigh(row["tf"][pos], docs["dl"][some], docs["top"][some])
        scored += len(pos)
        if len(acc) >= req.k:
            least = np.partition(acc, len(acc) - req.k)[len(acc) - req.k]
            floor = max(floor, least) if least > 0 else floor
    return acc, scored, total


def _searched(sent):
    """Rows in order of their shard -> (query_id, key, score) of each query's k best in this partition, and (query_id, null, null, scored, total)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        req: Request = sent.value
        best = [(np.zeros(0, np.int64), np.zeros(0)) for _ in req.ids]
        floors, work = np.full(len(req.ids), -np.inf), np.zeros((len(req.ids), 2), np.int64)
        by_term = defaultdict(list)
        for i, terms in enumerate(req.asked):
            for t, _ in terms:
                by_term[t].append(i)

        def close(rows: dict[str, dict], docs: dict | None, dead: list) -> None:
            if docs is None:
                return
            gone = np.zeros(len(docs["key"]), bool)
            for d in dead:
                gone[d] = True
            for row in rows.values():
                row["bound"] = req.bound(row)
            for i in sorted({i for t in rows for i in by_term[t]}):
                acc, *did = _search_shard(req, req.asked[i], rows, docs, gone, floors[i])
                work[i] += did
                score = np.round(acc, DIGITS)
                at = np.flatnonzero((score > 0) & (acc >= floors[i] - SLACK))
                keys, score = np.append(best[i][0], docs["key"][at]), np.append(best[i][1], score[at])
                order = np.lexsort((keys, -score))[: req.k]
                best[i] = keys[order], score[order]
                if len(order) == req.k:
                    floors[i] = score[order[-1]]

        names = ("at", "tf", "max_tf", "min_dl", "max_sparse", "key", "dl", "top")
        here, rows, docs, dead = None, {}, None, []
        for batch in batches:
            col = {c: batch.column(c) for c in batch.schema.names}
            for r in range(batch.num_rows):
                shard = col["segment"][r].as_py(), col["shard"][r].as_py()
                if shard != here:
                    close(rows, docs, dead)
                    here, rows, docs, dead = shard, {}, None, []
                row = {c: col[c][r].values.to_numpy(zero_copy_only=False) for c in names if col[c][r].is_valid}
                term = col["term"][r].as_py()
                if term is None:
                    dead.append(row["at"])
                elif term == DOCS:
                    docs = row
                else:
                    rows[term] = row
        close(rows, docs, dead)
        ids = np.array(req.ids, np.int64)
        n = [len(k) for k, _ in best]
        if ids.size:
            keys, score = np.concatenate([k for k, _ in best]), np.concatenate([s for _, s in best])
            none = pa.nulls(len(ids))
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, n)), pa.array(keys), pa.array(score), pa.nulls(len(keys), pa.int64()), pa.nulls(len(keys), pa.int64())], names=list(FOUND))
            yield pa.RecordBatch.from_arrays([pa.array(ids), none.cast(pa.int64()), none.cast(pa.float64()), pa.array(work[:, 0]), pa.array(work[:, 1])], names=list(FOUND))

    return run


FOUND = {"query_id": "long", "key": "long", "score": "double", "scored": "long", "total": "long"}


@dataclass
class LexicalIndex:
    """An index in a folder that driver and executors share: rows by segment, figures of segments, and deleted documents."""

    spark: SparkSession
    path: str

    def _read(self, what: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{what}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)  # not written yet

    def segments(self) -> DataFrame:
        return self._read("segments", SEGMENTS)

    def gone(self) -> DataFrame:
        """Places of deleted documents by shard, with how many documents and tokens they were."""
        return self._read("gone", GONE)

    def rows(self) -> DataFrame:
        """The rows of segments that are whole."""
        whole = [r[0] for r in self.segments().select("segment").distinct().collect()]
        return self._read("rows", ROWS).where(F.col("segment").isin(whole))

    def _commit(self, rows: DataFrame, segment: str) -> None:
        spread = rows.repartition("term", F.pmod("shard", F.lit(SPREAD))).sortWithinPartitions("term", "shard")
        spread.write.mode("append").partitionBy("segment").parquet(f"{self.path}/rows")
        docs = self._read("rows", ROWS).where((F.col("segment") == segment) & (F.col("term") == DOCS))
        tokens = F.aggregate("dl", F.lit(0).cast("long"), lambda a, x: a + x)
        whole = docs.agg(F.lit(segment).alias("segment"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("docs"), F.coalesce(F.sum(tokens), F.lit(0)).cast("long").alias("tokens"))
        whole.coalesce(1).write.mode("append").parquet(f"{self.path}/segments")

    def append(self, docs: DataFrame, tokens: Column | None = None, key: str = "doc_id", shard_docs: int = SHARD_DOCS) -> str:
        """Add documents (key, text) as a segment. Keys are unique, and not in the index (`upsert` sees to that); rows without a key or text are left out."""
        segment = "s" + uuid.uuid4().hex
        self._commit(shard_rows(docs, tokens if tokens is not None else tokenize("text"), key, segment, shard_docs), segment)
        return segment

    def documents(self) -> DataFrame:
        """(segment, shard, key, at, dl) of what is not deleted; reads the documents' rows alone."""
        rows = self.rows().where(F.col("term") == DOCS).select("segment", "shard", F.posexplode(F.arrays_zip("key", "dl")).alias("at", "d")).select("segment", "shard", "d.key", "at", "d.dl")
        return rows.join(self.gone().select("segment", "shard", F.explode("at").alias("at")), ["segment", "shard", "at"], "left_anti")

    def delete(self, keys: DataFrame, key: str = "doc_id") -> None:
        """Take documents out by key; keys that are not there do nothing. Marks their places; no row is written anew."""
        asked = keys.select(F.col(key).cast("long").alias("key")).where("key is not null").distinct()
        held = self.documents().join(asked, "key", "left_semi").groupBy("segment", "shard")
        held.agg(F.collect_list("at").alias("at"), F.count(F.lit(1)).alias("docs"), F.sum("dl").alias("tokens")).write.mode("append").parquet(f"{self.path}/gone")

    def upsert(self, docs: DataFrame, tokens: Column | None = None, key: str = "doc_id") -> str:
        """Documents replace those of the same key."""
        self.delete(docs, key)
        return self.append(docs, tokens, key)

    def postings(self, terms: DataFrame | None = None) -> DataFrame:
        """(segment, shard, key, term, tf) of what is not deleted, of some terms or all."""
        rows = self.rows().where(F.col("term") != DOCS)
        rows = rows if terms is None else rows.join(terms, "term", "left_semi")
        rows = rows.select("segment", "shard", "term", F.explode(F.arrays_zip("at", "tf")).alias("p")).select("segment", "shard", "term", "p.*")
        return rows.join(self.documents().select("segment", "shard", "at", "key"), ["segment", "shard", "at"]).select("segment", "shard", "key", "term", "tf")

    def merge(self) -> LexicalIndex:
        """All that is not deleted as one segment of a new index beside this one, without the texts."""
        new = LexicalIndex(self.spark, f"{self.path.rstrip('/')}-{uuid.uuid4().hex}")
        segment = "s" + uuid.uuid4().hex
        size = F.floor(F.log2(F.col("dl") + F.lit(1)) * 2).cast("int")
        docs = self.documents().select("key", size.alias("size"))
        shard, parts = _shard(docs, SHARD_DOCS, WORD_BYTES)
        placed = docs.select("key", shard.alias("shard"))
        post = self.postings().select("key", "term", "tf").join(placed, "key").unionByName(placed.select("key", "shard", F.lit(DOCS).alias("term"), F.lit(1).alias("tf")))
        post = post.repartition(parts, "shard")
        new._commit(rows_of(post, segment), segment)
        return new

    def _request(self, table: pa.Table, k: int, kind: str, k1: float, b: float) -> tuple[Request, DataFrame]:
        """The request for some queries' terms, which are bounded, and the index rows that it needs."""
        by_query: dict = defaultdict(list)
        for qid, term, q in zip(*(table[c].to_pylist() for c in ("query_id", "term", "q"))):
            by_query[qid].append((term, q))
        names = sorted({t for terms in by_query.values() for t, _ in terms})
        rows = self.rows().where(F.col("term").isin([DOCS, *names]))
        avgdl = 1.0
        if kind == "bm25":
            gone = self.gone()
            n, tokens = self.segments().agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
            lost = gone.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
            n, tokens = n - lost[0], tokens - lost[1]
            avgdl = tokens / n if n and tokens else 1.0
            df = rows.where(F.col("term") != DOCS)
            if lost[0]:
                dead = gone.groupBy("segment", "shard").agg(F.flatten(F.collect_list("at")).alias("dead"))
                df = df.join(dead, ["segment", "shard"], "left").withColumn("n", F.col("n") - F.coalesce(F.size(F.array_intersect("at", "dead")), F.lit(0)))
            known = {r["term"]: r["n"] for r in df.groupBy("term").agg(F.sum("n").alias("n")).collect() if r["n"] > 0}
            by_query = {qid: [(t, float(np.log(1 + (n - known[t] + 0.5) / (known[t] + 0.5)))) for t, _ in terms if t in known] for qid, terms in by_query.items()}
        return Request(list(by_query), list(by_query.values()), kind, k, k1, b, avgdl), rows

    def search(self, queries: DataFrame, k: int = CHANNEL_K, kind: str = "bm25", k1: float = K1, b: float = B, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
        """The k best documents of each query (query_id, term, weight), and the work done.

        kind "bm25" is Okapi over stored weights 1 + ln(1 + tf), in which query weights do not count; "compat" and "sparse" are dot products of the
        query's weights with 1 + ln(1 + tf) and ln(1 + tf) (0.5 + tf / max tf). Only weights over zero count. Gives (query_id, key, score, rank), and
        (query_id, scored, total): postings that were scored, and those of the query's terms. Ties go to the smaller key.
        """
        if kind not in ("bm25", "compat", "sparse"):
            raise ValueError(f"no such search: {kind}")
        asked = queries.select("query_id", "term").distinct().withColumn("q", F.lit(1.0)) if kind == "bm25" else queries.where("weight > 0").select("query_id", "term", F.col("weight").cast("double").alias("q"))
        asked = asked.where(F.col("term") != DOCS)
        table, found = asked.select("query_id", "term", "q").limit(MOST_TERMS + 1).toArrow(), None
        turns = 1 if table.num_rows <= MOST_TERMS else -(-2 * asked.count() // MOST_TERMS)
        for turn in range(turns):
            mine = table if turns == 1 else asked.select("query_id", "term", "q").where(F.pmod(F.xxhash64("query_id"), F.lit(turns)) == turn).toArrow()
            req, rows = self._request(mine, k, kind, k1, b)
            dead = self.gone().select("segment", "shard", "at")
            dealt = rows.unionByName(dead, allowMissingColumns=True).repartition("segment", "shard").sortWithinPartitions(F.col("shard").desc(), "segment")
            some = dealt.mapInArrow(_searched(self.spark.sparkContext.broadcast(req)), ", ".join(f"{c} {t}" for c, t in FOUND.items()))
            found = some if found is None else found.unionByName(some)
        hits = top_k(found.where("key is not null").select("query_id", "key", "score"), k, "key").withColumnRenamed("key", key)
        return hits, found.where("key is null").groupBy("query_id").agg(F.sum("scored").alias("scored"), F.sum("total").alias("total"))
