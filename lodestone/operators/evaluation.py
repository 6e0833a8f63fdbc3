"""Checks of a retrieval index: self hits, perturbed queries, recall, likeness of neighbours, leaks between namespaces, pages, oversampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .retrieval import dense_search, dot, normalize, recall_at

#: Standard deviation of the noise that queries are perturbed with, and least shares of the gates (fixed values).
NOISE = 0.01
GATES = {"self_hit": 0.99, "perturb_top3": 0.95, "recall_at_10": 0.95}


def sampled(vectors: DataFrame, every: int, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """Queries (query_id, vector): the rows whose id is divisible by `every`."""
    return vectors.where(F.col(key) % every == 0).select(F.col(key).alias("query_id"), F.col(vec).alias("vector"))


def perturbed(queries: DataFrame, noise: float = NOISE, seed: int = 7) -> DataFrame:
    """Query vectors with normal noise, the same for the same seed and id (a Box-Muller pair of hashes each)."""
    u = lambda i, k: (F.pmod(F.xxhash64(F.lit(seed), "query_id", i, F.lit(k)), F.lit(1 << 52)).cast("double") + 0.5) / F.lit(float(1 << 52))
    normal = lambda i: F.sqrt(-2 * F.ln(u(i, 0))) * F.cos(u(i, 1) * 2 * 3.141592653589793)
    return queries.withColumn("vector", F.transform("vector", lambda x, i: x.cast("double") + normal(i) * noise))


def hits_within(found: DataFrame, k: int, key: str = "vec_id") -> DataFrame:
    """(n, hits, share): queries whose own row is among their first k."""
    own = F.max(F.when((F.col(key) == F.col("query_id")) & (F.col("rank") <= k), 1)).alias("hit")
    every = found.groupBy("query_id").agg(own)
    return every.agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("hits"), F.round(F.count("hit") / F.count(F.lit(1)), 6).alias("share"))


def neighbour_likeness(found: DataFrame, vectors: DataFrame, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """By query: pairs among its hits, their mean and largest cosine. Pairs are made within one query's list alone, whose length the search bounds."""
    rows = found.select("query_id", key, "rank").join(vectors.select(key, normalize(vec).alias("v")), key)
    a, b = rows.alias("a"), rows.alias("b")
    pairs = a.join(b, (F.col("a.query_id") == F.col("b.query_id")) & (F.col("a.rank") < F.col("b.rank"))).select(F.col("a.query_id").alias("query_id"), dot("a.v", "b.v").alias("c"))
    return pairs.groupBy("query_id").agg(F.count(F.lit(1)).alias("pairs"), F.round(F.avg("c"), 6).alias("mean_cosine"), F.round(F.max("c"), 6).alias("max_cosine"))


def leaks(found: DataFrame, rows: DataFrame, wanted: DataFrame, key: str = "vec_id", namespace: str = "namespace") -> DataFrame:
    """Hits of another namespace than their query (query_id, namespace) asked for; none is what is wanted."""
    want = wanted.select("query_id", F.col(namespace).alias("__want"))
    return found.join(rows.select(key, namespace), key).join(want, "query_id").where(F.col(namespace) != F.col("__want")).drop("__want")


def calibrate(vectors: DataFrame, search, ks: list[int], every: int, key: str = "vec_id") -> DataFrame:
    """(oversample, recall): mean recall at 10 of search(queries, k) cut to its k best, for each k."""
    asked = sampled(vectors, every, key)
    truth = dense_search(asked, vectors, 10, key=key)
    out = None
    for k in ks:
        one = recall_at(search(asked, k), truth, k if k < 10 else 10, key).agg(F.round(F.avg("recall"), 6).alias("recall")).select(F.lit(k).alias("oversample"), "recall")
        out = one if out is None else out.unionByName(one)
    return out


def gates(measures: DataFrame, least: dict[str, float] = GATES) -> DataFrame:
    """(name, share) with the least share asked for and whether it is met."""
    limit = F.create_map(*(F.lit(x) for kv in least.items() for x in kv))
    return measures.withColumn("least", F.element_at(limit, F.col("name"))).withColumn("passed", F.col("share") >= F.col("least"))
