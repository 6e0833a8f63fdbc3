"""State that pipelines carry from run to run: cached plans, lock files, schemas, manifests, counters, stage attempts, leases."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ordering import numbered

#: What a lock file holds of each plan.
PLAN = T.StructType().add("id", "string").add("resolver", "string").add("url", "string").add("filename", "string").add("version", "string").add("license", "string").add("media_type", "string").add("service", "string").add("checksum", "string")


# --- plans


def cache_plan(plans: DataFrame, new: DataFrame, key: str = "id", order: str = "cached_at") -> DataFrame:
    """Plans with the new ones; of each key the newest is current, the others stay as history."""
    rows = plans.drop("is_current").unionByName(new.drop("is_current"), allowMissingColumns=True)
    newest = Window.partitionBy(key).orderBy(F.desc(order), *(F.desc(c) for c in ("plan_id",) if c in rows.columns))
    return rows.withColumn("is_current", F.row_number().over(newest) == 1)


def cached_plan(plans: DataFrame, **where) -> DataFrame:
    """The current plans that match all of the given columns."""
    rows = plans.where("is_current")
    for name, value in where.items():
        rows = rows.where(F.col(name) == F.lit(value))
    return rows


def plan_history(plans: DataFrame, key: str, order: str = "cached_at", limit: int = 10) -> DataFrame:
    """The newest `limit` plans of each key with how many came before each."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return plans.withColumn("back", F.row_number().over(w) - 1).where(F.col("back") < limit)


def lock_rows(plans: DataFrame) -> DataFrame:
    """One JSON text a plan, keys in order, nulls left out: the entries of a lock file."""
    fields = sorted(c for c in plans.columns if c in PLAN.names)
    return plans.select("id", F.to_json(F.struct(*fields)).alias("entry"))


def from_lock(rows: DataFrame) -> DataFrame:
    """Plans from the entries of a lock file."""
    return rows.select(F.from_json("entry", PLAN).alias("p")).select("p.*")


# --- schemas


def schema_rows(df: DataFrame) -> list[tuple[str, str, bool]]:
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema]


def schema_drift(expected: T.StructType, found: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, change, expected type, found type) where two schemas differ: missing, added, type or nullable."""
    have, want = ({f.name: f for f in s} for s in (found, expected))
    out: list[tuple[str, str, str | None, str | None]] = []
    for name in sorted(have.keys() | want.keys()):
        a, b = want.get(name), have.get(name)
        x, y = (f.dataType.simpleString() if f else None for f in (a, b))
        if not b:
            out.append((name, "missing", x, None))
        elif not a:
            out.append((name, "added", None, y))
        elif x != y:
            out.append((name, "type", x, y))
        elif b.nullable and not a.nullable:
            out.append((name, "nullable", x, y))
    return out


def drift_table(df: DataFrame, expected: T.StructType) -> DataFrame:
    kinds = "column string, change string, expected string, found string"
    return df.sparkSession.createDataFrame(schema_drift(expected, df.schema), kinds)


def migrate(df: DataFrame, steps: list[tuple[int, Callable[[DataFrame], DataFrame]]], version: str = "schema_version") -> DataFrame:
    """Bring rows up to date: each step (to version n) holds for rows below n, in order; rows of a later version are left as they are.

    Steps change values, not the set of columns: a column that a step needs is added (null) before it runs.
    """
    for n, step in sorted(steps, key=lambda x: x[0]):
        old = df.where(F.coalesce(version, F.lit(0)) < n)
        df = step(old).withColumn(version, F.lit(n)).unionByName(df.where(F.coalesce(version, F.lit(0)) >= n), allowMissingColumns=True)
    return df


# --- manifests


def compacted(manifest: DataFrame, key: str = "doc_id", order: str = "seq") -> DataFrame:
    """The last entry of each key, as a rotation keeps it."""
    rest = F.struct(*(c for c in manifest.columns if c != key))
    return manifest.groupBy(key).agg(F.max_by(rest, F.col(order)).alias("v")).select(key, "v.*")


def rotate(manifest: DataFrame, most: int, order: str = "seq") -> DataFrame:
    """Entries with the number of the part they belong to: parts of `most` entries in order, the last one open (0 is the oldest)."""
    return numbered(manifest, [], order, "__at").withColumn("part", F.floor(F.col("__at") / F.lit(most)).cast("long")).drop("__at")


def url_index(entries: DataFrame, url: str = "canonical_url", order: str = "seq", existing: DataFrame | None = None, path: str = "path") -> DataFrame:
    """The latest successful entry of each URL; with `existing` (path), only those whose file is still there."""
    rows = compacted(entries.where(F.col(url).isNotNull() & (F.col("status") == "success")), url, order)
    return rows if existing is None else rows.join(existing.select(path).distinct(), path, "left_semi")


# --- stages


def stage_attempts(entries: DataFrame) -> DataFrame:
    """By stage: attempts, successes, skips, failures, the share that failed, seconds in all."""
    n = lambda s: F.count_if(F.col("status") == s)
    return entries.groupBy("stage").agg(
        F.count(F.lit(1)).alias("attempts"), n("success").alias("succeeded"), n("skip").alias("skipped"), n("failure").alias("failed"),
        F.round(n("failure") / F.count(F.lit(1)), 6).alias("failed_share"), F.round(F.sum("duration_s"), 6).alias("seconds"),
    )


def chunk_file_stats(chunks: DataFrame, rules: dict[str, Column], files: DataFrame | None = None, file: str = "file") -> DataFrame:
    """By file: rows, rows that break a rule, whether it goes to quarantine (any row broken); files of `files` without rows are missing."""
    broken = F.lit(False)
    for c in rules.values():
        broken = broken | ~F.coalesce(c, F.lit(False))
    g = chunks.groupBy(file).agg(F.count(F.lit(1)).alias("rows"), F.count_if(broken).alias("broken"))
    if files is not None:
        g = files.select(file).distinct().join(g, file, "left")
    return g.select(file, F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("broken", F.lit(0)).alias("broken"), F.coalesce(F.col("broken") > 0, F.lit(False)).alias("quarantined"), F.col("rows").isNull().alias("missing"))


# --- counters


def increments(counts: DataFrame, key: list[str], order: str, value: str) -> DataFrame:
    """What each snapshot of a running counter adds to the one before; a counter that falls was set back, and adds all it has."""
    before = F.lag(value).over(Window.partitionBy(*key).orderBy(order))
    return counts.withColumn("added", F.when(before.isNull() | (F.col(value) < before), F.col(value)).otherwise(F.col(value) - before))


def since_last(now: DataFrame, last: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """The change of each value since the last poll; keys that are new count from nothing, keys that are gone do not show."""
    old = last.select(*key, *(F.col(v).alias(f"__{v}") for v in values))
    return now.join(old, key, "left").select(*key, *(F.col(v) - F.coalesce(f"__{v}", F.lit(0)) for v in values)).toDF(*key, *values)


# --- leases


def backoff(attempts, base: float = 60.0, factor: float = 2.0, most: float = 3600.0) -> Column:
    """Seconds to wait after the given number of failed attempts."""
    n = F.col(attempts) if isinstance(attempts, str) else attempts
    return F.least(F.lit(most), F.lit(base) * F.pow(F.lit(factor), F.greatest(n - 1, F.lit(0))))


def after_failure(jobs: DataFrame, now, most_attempts: int = 3, **wait) -> DataFrame:
    """Jobs that failed once more: put back with a wait, or in error when their attempts are used up."""
    n = F.col("attempts") + 1
    done = n >= most_attempts
    due = F.timestamp_micros(F.unix_micros(F.lit(now).cast("timestamp")) + (backoff(n, **wait) * 1_000_000).cast("long"))
    return jobs.withColumn("state", F.when(done, "ERROR").otherwise("QUEUED")).withColumn("available_at", F.when(~done, due)).withColumn("attempts", n)


def heartbeat(jobs: DataFrame, beats: DataFrame, seconds: int) -> DataFrame:
    """Leases renewed by the last beat (job_id, worker, ts) of the worker that holds them, while the lease was still open."""
    last = beats.join(jobs.select("job_id", F.col("worker").alias("__w"), F.col("lease_until").alias("__u")), "job_id")
    last = last.where((F.col("worker") == F.col("__w")) & (F.col("ts") <= F.col("__u"))).groupBy("job_id").agg(F.max("ts").alias("__ts"))
    until = F.col("__ts") + F.expr(f"interval {seconds} seconds")
    return jobs.join(last, "job_id", "left").withColumn("lease_until", F.greatest("lease_until", until)).drop("__ts")
