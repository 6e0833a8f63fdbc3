"""Stock queries over an events table (run_id, ts, type, level, service, payload as JSON text), by name and category."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.percentiles import order_statistics


def field(name: str, kind: str = "string") -> Column:
    """A payload field: one JSON path, read where it is used."""
    return F.get_json_object("payload", f"$.{name}").cast(kind)


def _of(events: DataFrame, kind: str) -> DataFrame:
    return events.where(F.col("type") == kind)


def _share(cond: Column) -> Column:
    return F.round(100.0 * F.count_if(cond) / F.count(F.lit(1)), 2)


def net_latency_distribution(events: DataFrame) -> DataFrame:
    e = _of(events, "net.request").select("service", field("elapsed_ms", "double").alias("ms"))
    ps = order_statistics(e, ["service"], "ms", {f"p{p}_ms": ("linear", p / 100) for p in (50, 95, 99)})
    sums = e.groupBy("service").agg(F.count(F.lit(1)).alias("request_count"), F.avg("ms").alias("avg_ms"), F.max("ms").alias("max_ms"))
    out = sums.alias("a").join(ps.alias("b"), F.col("a.service").eqNullSafe(F.col("b.service")), "left")
    return out.select("a.service", "request_count", "p50_ms", "p95_ms", "p99_ms", "avg_ms", "max_ms")


def net_cache_hit_ratio(events: DataFrame) -> DataFrame:
    hit = F.col("cache").isin("hit", "revalidated")
    e = _of(events, "net.request").select("service", field("cache").alias("cache"))
    return e.groupBy("service").agg(F.count(F.lit(1)).alias("total_requests"), F.count_if(hit).alias("cached_requests"), _share(hit).alias("hit_ratio_percent"))


def ratelimit_pressure(events: DataFrame, top: int = 10) -> DataFrame:
    e = _of(events, "ratelimit.acquire").select(F.substring(field("key"), 1, 40).alias("key"), field("allowed", "boolean").alias("ok"), field("blocked_ms", "long").alias("ms"))
    out = e.groupBy("key").agg(F.count(F.lit(1)).alias("acquire_count"), F.count_if(~F.col("ok")).alias("blocked_count"), F.sum("ms").alias("total_blocked_ms"), _share(~F.col("ok")).alias("block_rate_percent"))
    return out.where("total_blocked_ms > 0").orderBy(F.desc("total_blocked_ms"), "key").limit(top)


def ratelimit_cooldowns(events: DataFrame) -> DataFrame:
    e = _of(events, "ratelimit.cooldown").select(F.substring(field("key"), 1, 40).alias("key"), field("status_code", "int").alias("status_code"), field("cooldown_ms", "long").alias("ms"), field("cooldown_sec", "double").alias("sec"))
    return e.groupBy("key", "status_code").agg(F.count(F.lit(1)).alias("cooldown_count"), F.sum("ms").alias("total_cooldown_ms"), F.avg("sec").alias("avg_cooldown_sec"))


def policy_rejections(events: DataFrame) -> DataFrame:
    e = events.where(F.col("type").endswith(".error")).select(field("error_code").alias("error_code"), field("elapsed_ms", "double").alias("ms"))
    return e.groupBy("error_code").agg(F.count(F.lit(1)).alias("rejection_count"), F.round(F.avg("ms"), 2).alias("avg_gate_ms"), F.max("ms").alias("max_gate_ms"))


def policy_heatmap(events: DataFrame, top: int = 50) -> DataFrame:
    """Errors by day and type, newest day first."""
    e = events.where(F.col("type").endswith(".error")).groupBy(F.to_date("ts").alias("date"), "type").agg(F.count(F.lit(1)).alias("error_count"))
    return e.orderBy(F.desc("date"), F.desc("error_count"), "type").limit(top)


def extract_zip_bombs(events: DataFrame, top: int = 20) -> DataFrame:
    e = _of(events, "extract.done").select("ts", "service", field("entries_total", "long").alias("entries_total"), field("entries_included", "long").alias("entries_included"), field("bytes_written", "double").alias("bytes"), field("duration_ms", "double").alias("duration_ms"))
    per = F.round(F.col("bytes") / F.nullif("entries_included", F.lit(0)), 2)
    e = e.withColumn("bytes_per_entry", per).where((F.col("entries_total") > 1000) | (F.col("bytes_per_entry") > 10.0))
    return e.drop("bytes").orderBy(F.desc("ts"), "service").limit(top)


def extract_summary(events: DataFrame) -> DataFrame:
    e = _of(events, "extract.done").select(F.to_date("ts").alias("date"), field("entries_total", "long").alias("n"), field("bytes_written", "long").alias("b"), field("duration_ms", "double").alias("d"))
    return e.groupBy("date").agg(F.count(F.lit(1)).alias("extraction_count"), F.sum("n").alias("total_entries"), F.sum("b").alias("total_bytes"), F.avg("d").alias("avg_duration_ms"))


@dataclass(frozen=True)
class Stock:
    category: str
    about: str
    build: Callable[[DataFrame], DataFrame]


REGISTRY = {
    "net_latency_distribution": Stock("slo", "latency percentiles of requests by service", net_latency_distribution),
    "net_cache_hit_ratio": Stock("slo", "share of requests that the cache served", net_cache_hit_ratio),
    "ratelimit_pressure": Stock("ratelimit", "keys that were blocked longest", ratelimit_pressure),
    "ratelimit_cooldowns": Stock("ratelimit", "cool-downs by key and status", ratelimit_cooldowns),
    "policy_rejections": Stock("policy", "rejections by error code", policy_rejections),
    "policy_heatmap": Stock("policy", "errors by day and type", policy_heatmap),
    "extract_zip_bombs": Stock("extraction", "archives that look like bombs", extract_zip_bombs),
    "extract_summary": Stock("extraction", "extractions by day", extract_summary),
}


def list_queries(category: str | None = None) -> list[str]:
    return sorted(k for k, v in REGISTRY.items() if category in (None, v.category))


def get_query(name: str) -> Callable[[DataFrame], DataFrame]:
    if name not in REGISTRY:
        raise KeyError(f"no stock query {name!r}; there are {', '.join(list_queries())}")
    return REGISTRY[name].build


def query_summary() -> dict[str, int]:
    out: dict[str, int] = {}
    for v in REGISTRY.values():
        out[v.category] = out.get(v.category, 0) + 1
    return out


def tail(events: DataFrame, n: int = 20, level: str | None = None, type_prefix: str | None = None, since=None) -> DataFrame:
    """The newest events that pass the filters."""
    if level:
        events = events.where(F.col("level") == level)
    if type_prefix:
        events = events.where(F.col("type").startswith(type_prefix))
    if since is not None:
        events = events.where(F.col("ts") >= F.lit(since).cast("timestamp"))
    ties = [c for c in ("run_id", "type", "service", "event_id") if c in events.columns]
    return events.orderBy(F.desc("ts"), *ties).limit(n)
