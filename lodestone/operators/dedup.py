"""Duplicate content, its cost and its retention, over artifacts (id, artifact_id, resolver, sha256, bytes, content_type, created_at)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import ratio


def duplicates(docs: DataFrame) -> DataFrame:
    """Digests held more than once; bytes saved are (n - 1) times the mean size, in whole bytes."""
    g = docs.where("sha256 is not null").groupBy("sha256").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("total"))
    return g.where("n > 1").select("sha256", "n", "total", F.expr("(n - 1) * (total div n)").alias("saved"))


def top_duplicates(docs: DataFrame, top: int = 10) -> DataFrame:
    return duplicates(docs).orderBy(F.desc("saved"), "sha256").limit(top)


def totals(docs: DataFrame) -> DataFrame:
    """One row: rows, distinct digests and artifacts, bytes, and the share of rows that repeat a digest (rows without one count as such)."""
    a = docs.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("sha256").alias("n_digests"), F.count_distinct("artifact_id").alias("n_artifacts"), F.sum(F.when(F.col("bytes") > 0, F.col("bytes"))).alias("bytes"))
    return a.withColumn("dedup_ratio", ratio(F.col("n") - F.col("n_digests"), F.col("n"), 6, 0.0))


def by_resolver(docs: DataFrame) -> DataFrame:
    g = docs.groupBy("resolver").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("sha256").alias("n_digests"), F.sum("bytes").alias("bytes"))
    return g.withColumn("dedup_ratio", ratio(F.col("n") - F.col("n_digests"), F.col("n"), 6, 0.0))


def priority(n: Column, size: Column, age_days: Column) -> Column:
    """0.2 of the copies (full at 10), 0.6 of the size (full at 1 GB), 0.2 of the age (full at a year)."""
    part = lambda x, full: F.least(F.greatest(x / float(full), F.lit(0.0)), F.lit(1.0))
    return 0.2 * part(n, 10) + 0.6 * part(size, 1 << 30) + 0.2 * part(age_days, 365)


def should_dedup(size: Column, age_days: Column, resolver: Column, least_size: int = 1024, least_age: int = 0, allowed: list[str] | None = None) -> Column:
    ok = (size >= least_size) & (age_days >= least_age)
    return ok & resolver.isin(allowed) if allowed else ok


def candidates(docs: DataFrame, now, top: int = 10) -> DataFrame:
    """Duplicate groups by priority."""
    g = docs.where("sha256 is not null").groupBy("sha256").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("total"), F.min("created_at").alias("first"))
    age = F.datediff(F.lit(now).cast("timestamp"), "first")
    g = g.where("n > 1").withColumn("priority", F.round(priority(F.col("n"), F.expr("total div n").cast("double"), age), 6))
    return g.select("sha256", "n", "priority").orderBy(F.desc("priority"), "sha256").limit(top)


def retention(docs: DataFrame, now, base_days: int, by_type: dict[str, int] | None = None, by_resolver_days: dict[str, int] | None = None, large_bytes: int | None = None, large_days: int | None = None, least_replicas: int = 1) -> DataFrame:
    """keep or delete by the first rule that applies: size tier, resolver, content type, base. A digest with fewer than `least_replicas` copies is kept; a limit of 0 knows no age."""
    lookup = lambda m, c: F.coalesce(*(F.when(F.col(c) == k, F.lit(v)) for k, v in m.items())) if m else F.lit(None).cast("int")
    tier = F.when(F.col("bytes") >= large_bytes, F.lit(large_days)) if large_bytes is not None else F.lit(None).cast("int")
    limit = F.coalesce(tier, lookup(by_resolver_days, "resolver"), lookup(by_type, "content_type"), F.lit(base_days))
    replicas = F.count(F.lit(1)).over(Window.partitionBy("sha256"))
    age = F.datediff(F.lit(now).cast("timestamp"), "created_at")
    d = docs.withColumn("limit_days", limit).withColumn("replicas", replicas).withColumn("age_days", age)
    gone = (F.col("limit_days") > 0) & (F.col("age_days") > F.col("limit_days")) & (F.col("replicas") >= least_replicas)
    return d.withColumn("decision", F.when(gone, "delete").otherwise("keep"))


def integrity(docs: DataFrame) -> DataFrame:
    """Violations: the same artifact from one resolver twice, and rows without a digest."""
    twice = docs.groupBy("artifact_id", "resolver").count().where("count > 1").select(F.lit("duplicate").alias("problem"), F.concat_ws("/", F.col("artifact_id").cast("string"), "resolver").alias("what"))
    return twice.unionByName(docs.where("sha256 is null or sha256 = ''").select(F.lit("no digest").alias("problem"), F.col("id").cast("string").alias("what")))


def verify(contents: DataFrame, share: float = 1.0, seed: int = 0) -> DataFrame:
    """(path, content, sha256): whether the content still has its digest, for all rows or a sample."""
    rows = contents if share >= 1 else contents.sample(share, seed)
    return rows.select("path", (F.sha2("content", 256) == F.col("sha256")).alias("matches"))
