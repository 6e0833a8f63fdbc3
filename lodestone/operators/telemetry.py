"""Service indicators over telemetry tables: http_events, fallback_attempts, breaker transitions, jobs, rate events."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.percentiles import by_index, order_statistics
from ..functions.scalars import ratio
from .frames import recent_sum

#: Targets of job objectives: name -> (target, budget, whether more is better) (fixed values).
OBJECTIVES = {
    "completion_rate": (0.995, 0.005, True),
    "p50_s": (30.0, 10.0, False),
    "p95_s": (120.0, 30.0, False),
    "p99_s": (300.0, 60.0, False),
}
DONE = ("FINALIZED", "INDEXED", "DEDUPED")


def run_indicators(http: DataFrame, attempts: DataFrame) -> DataFrame:
    """By run: yield, cache-hit percent, share of 429 among network calls, p95 of rate delays (by index)."""
    net = ~F.col("from_cache")
    a = attempts.groupBy("run_id").agg(F.count(F.lit(1)).alias("attempts"), F.count_if(F.col("outcome") == "success").alias("wins"))
    h = http.groupBy("run_id").agg(F.count(F.lit(1)).alias("calls"), F.count_if("from_cache").alias("cached"), F.count_if(net).alias("net"), F.count_if(net & (F.col("status") == 429)).alias("limited"))
    p = by_index(http, ["run_id"], "rate_delay_ms", {"rate_delay_p95_ms": 0.95})
    j = h.join(a, "run_id", "full_outer").join(p, "run_id", "left")
    return j.select("run_id", ratio(F.col("wins"), F.col("attempts"), 6).alias("yield"), ratio(100.0 * F.col("cached"), F.col("calls"), 4).alias("cache_hit_percent"), ratio(100.0 * F.col("limited"), F.col("net"), 4).alias("limited_percent"), "rate_delay_p95_ms")


def first_success(attempts: DataFrame) -> DataFrame:
    """Seconds from a work's first attempt to its first success."""
    g = attempts.groupBy("run_id", "work_id").agg(F.min("ts").alias("t0"), F.min(F.when(F.col("outcome") == "success", F.col("ts"))).alias("t1"))
    return g.where("t1 is not null").select("run_id", "work_id", (F.col("t1").cast("timestamp").cast("double") - F.col("t0").cast("timestamp").cast("double")).alias("ttfp_s"))


def limited_by_host(http: DataFrame) -> DataFrame:
    net = ~F.col("from_cache")
    return http.groupBy("host").agg(ratio(F.count_if(net & (F.col("status") == 429)), F.nullif(F.count_if(net), F.lit(0)), 6).alias("limited_ratio"))


def opens_by_host(transitions: DataFrame) -> DataFrame:
    return transitions.where("old_state = 'CLOSED' and new_state = 'OPEN'").groupBy("host").agg(F.count(F.lit(1)).alias("opens"))


def open_durations(transitions: DataFrame) -> DataFrame:
    """From each OPEN (exactly) to the host's next transition to another state."""
    w = Window.partitionBy("host").orderBy("ts", "event_id")
    t = transitions.withColumn("next_ts", F.lead("ts").over(w)).withColumn("next_state", F.lead("new_state").over(w))
    t = t.where("new_state = 'OPEN' and next_state <> 'OPEN'")
    return t.select("host", "ts", (F.col("next_ts").cast("timestamp").cast("double") - F.col("ts").cast("timestamp").cast("double")).alias("open_s"))


def advisor_metrics(http: DataFrame, now, seconds: int = 600) -> DataFrame:
    """By host over the last `seconds`: calls, 429 ratio, failures, median Retry-After."""
    h = http.where(F.col("ts") >= F.lit(now).cast("timestamp") - F.expr(f"interval {seconds} seconds"))
    return h.groupBy("host").agg(F.count(F.lit(1)).alias("calls"), ratio(F.count_if(F.col("status") == 429), F.count(F.lit(1)), 6).alias("limited_ratio"), F.count_if(F.col("status") >= 500).alias("failures")).join(order_statistics(h, ["host"], "retry_after_s", {"retry_after_s": ("linear", 0.5)}), "host", "left")


def advice(metrics: DataFrame) -> DataFrame:
    """Slow down at 5 % of 429; reset time from Retry-After, held within 15 and 900 s."""
    return metrics.withColumn("rate_factor", F.when(F.col("limited_ratio") >= 0.05, 0.8).otherwise(1.0)).withColumn("reset_s", F.greatest(F.lit(15.0), F.least(F.lit(900.0), "retry_after_s")))


def completion(jobs: DataFrame) -> DataFrame:
    """Share of jobs that ended well; 1 without jobs."""
    return jobs.agg(F.count(F.lit(1)).alias("jobs"), ratio(F.count_if(F.col("state").isin(*DONE)), F.count(F.lit(1)), 6, 1.0).alias("completion_rate"))


def time_to_complete(jobs: DataFrame, keys: list[str]) -> DataFrame:
    """Percentiles (by index) of seconds from creation to completion."""
    done = jobs.where(F.col("state").isin(*DONE)).withColumn("s", F.col("updated_at").cast("timestamp").cast("double") - F.col("created_at").cast("timestamp").cast("double"))
    return by_index(done, keys, "s", {"p50_s": 0.5, "p95_s": 0.95, "p99_s": 0.99}, clamp=True)


def lease_latency(jobs: DataFrame, ops: DataFrame) -> DataFrame:
    """Seconds from creation to the first operation, for all jobs."""
    first = ops.groupBy("job_id").agg(F.min("started_at").alias("t"))
    return jobs.join(first, "job_id", "left").select("job_id", (F.col("t").cast("timestamp").cast("double") - F.col("created_at").cast("timestamp").cast("double")).alias("lease_s"))


def replay_rate(ops: DataFrame) -> DataFrame:
    """Share of operations done again for a (job, kind) that had one."""
    g = ops.groupBy("job_id", "kind").agg(F.count(F.lit(1)).alias("n"))
    return g.agg(ratio(F.sum(F.col("n") - 1), F.sum("n"), 6, 0.0).alias("replay_rate"))


def objective(name: str, actual: Column, directional: bool = True) -> Column:
    """pass, warn (within the budget), fail. directional False judges by distance alone."""
    target, budget, more = OBJECTIVES[name]
    miss = (F.lit(target) - actual if more else actual - F.lit(target)) if directional else F.abs(actual - F.lit(target))
    return F.when(miss <= 0 if directional else miss <= budget, "pass").when(miss <= (budget if directional else 2 * budget), "warn").otherwise("fail")


#: Of each objective of the job report: target and allowed distance (fixed values; times in ms).
REPORTED = {
    "job_completion_rate": (0.995, 0.005), "time_to_complete_p50": (30000.0, 5000.0), "time_to_complete_p95": (120000.0, 20000.0),
    "crash_recovery_success_rate": (0.999, 0.001), "lease_acquisition_p99": (100.0, 50.0), "operation_replay_rate": (0.05, 0.10),
}


def objectives_report(jobs: DataFrame, ops: DataFrame) -> DataFrame:
    """(objective, actual, target, status) of jobs and their operations: pass within the allowed distance from the target, warning within twice, else fail. Recovery counts as whole, as jobs that ended have recovered; times without jobs are 0."""
    times = time_to_complete(jobs, []).select((F.col("p50_s") * 1000).alias("time_to_complete_p50"), (F.col("p95_s") * 1000).alias("time_to_complete_p95"))
    leases = by_index(lease_latency(jobs, ops), [], "lease_s", {"p": 0.99}, clamp=True).select((F.col("p") * 1000).alias("lease_acquisition_p99"))
    rates = completion(jobs).select(F.col("completion_rate").alias("job_completion_rate"), F.lit(1.0).alias("crash_recovery_success_rate"))
    parts = (rates, times, leases, replay_rate(ops).select(F.col("replay_rate").alias("operation_replay_rate")))
    out = None
    for one in parts:  # a row each
        rows = one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("objective"), F.col(c).cast("double").alias("actual")) for c in one.columns))).alias("o")).select("o.*")
        out = rows if out is None else out.unionByName(rows)
    pick = lambda i: F.element_at(F.create_map(*(F.lit(x) for name, v in REPORTED.items() for x in (name, v[i]))), F.col("objective"))
    known = jobs.sparkSession.createDataFrame([(n,) for n in REPORTED], "objective string").join(out, "objective", "left")
    known = known.select("objective", F.coalesce("actual", F.lit(0.0)).alias("actual"), pick(0).alias("target"), pick(1).alias("allowed"))
    far = F.abs(F.col("actual") - F.col("target"))
    status = F.when(far <= F.col("allowed"), "pass").when(far <= 2 * F.col("allowed"), "warning").otherwise("fail")
    return known.select("objective", "actual", "target", status.alias("status"))


def attempts_overall(a: DataFrame, *keys: str) -> DataFrame:
    """Attempts, success rate and mean time; times of 0 or null do not count."""
    t = F.when(F.col("elapsed_ms") > 0, F.col("elapsed_ms"))
    win = F.count_if(F.col("outcome") == "success")
    return a.groupBy(*keys).agg(F.count(F.lit(1)).alias("attempts"), win.alias("wins"), ratio(win, F.count(F.lit(1)), 3).alias("success_rate"), F.round(F.avg(t), 1).alias("avg_ms"))


def top_failures(a: DataFrame, top: int = 5) -> DataFrame:
    return a.where("outcome <> 'success'").groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason").limit(top)


def halves(a: DataFrame, keys: list[str]) -> DataFrame:
    """Success rate of the older and the newer half, by time; the odd row is in the newer."""
    w = Window.partitionBy(*keys)
    r = a.withColumn("__i", F.row_number().over(w.orderBy("ts", "event_id"))).withColumn("__n", F.count(F.lit(1)).over(w))
    old = F.col("__i") <= F.floor(F.col("__n") / 2)
    rate = lambda c: ratio(F.count_if(c & (F.col("outcome") == "success")), F.count_if(c), 6)
    return r.groupBy(*keys).agg(rate(old).alias("first_half"), rate(~old).alias("second_half"))


def best_tier(a: DataFrame) -> DataFrame:
    g = attempts_overall(a, "tier")
    return g.agg(F.max_by("tier", F.struct("success_rate", "tier")).alias("best_tier"))


def first_win(a: DataFrame) -> DataFrame:
    """Tiered fallback over recorded attempts: the source of the lowest tier, then the fastest, that succeeded."""
    return a.where("outcome = 'success'").groupBy("work_id").agg(F.min_by("source", F.struct("tier", "elapsed_ms", "source")).alias("source"))


def limiter_rollup(rate: DataFrame) -> DataFrame:
    """By host and role: acquisitions, waits, blocks, last backend."""
    got = F.col("action") == "acquire"
    return rate.groupBy("host", "role").agg(F.count_if(got).alias("acquired"), F.sum(F.when(got, F.col("delay_ms"))).alias("wait_ms"), F.count_if(F.col("action") == "block").alias("blocked"), F.max_by("backend", F.struct("ts", "event_id")).alias("backend"))


def gate_summary(gates: DataFrame) -> DataFrame:
    """By gate: pass rate, extremes and percentiles by index."""
    p = by_index(gates, ["gate"], "elapsed_ms", {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}, clamp=True)
    g = gates.groupBy("gate").agg(F.count(F.lit(1)).alias("n"), ratio(F.count_if("passed"), F.count(F.lit(1)), 6).alias("pass_rate"), F.min("elapsed_ms").alias("min_ms"), F.max("elapsed_ms").alias("max_ms"), F.round(F.avg("elapsed_ms"), 4).alias("avg_ms"))
    return g.join(p, "gate")


def alerts(summary: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Rows (key columns, metric, value, threshold) where a metric is over its threshold."""
    rows = F.array(*(F.struct(F.lit(k).alias("metric"), F.col(k).cast("double").alias("value"), F.lit(float(v)).alias("threshold")) for k, v in limits.items()))
    keys = [c for c in summary.columns if c not in limits]
    return summary.select(*keys, F.explode(rows).alias("a")).select(*keys, "a.*").where("value > threshold")


def run_summary(a: DataFrame) -> DataFrame:
    """One JSON record a run: counts by outcome, reason and source."""
    count = lambda c: a.groupBy("run_id", c).count().groupBy("run_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.coalesce(c, F.lit("none")), "count")))).alias(c))
    return count("outcome").join(count("reason"), "run_id").join(count("source"), "run_id").select("run_id", F.to_json(F.struct("outcome", "reason", "source")).alias("record"))


def ema(rows: DataFrame, key: str, order: str, value: str, alpha: float = 0.2, start: float = 0.75) -> DataFrame:
    """Exponential mean by key in order, held within 0.001 and 1.

    An ordered fold over each key's last values: each step shrinks what came before by 1 - alpha (the bounds never widen it), so those
    further back than `n` weigh less than a double's last digit, and no key's rows are gathered whole.
    """
    n = max(1, math.ceil(math.log(1e-18) / math.log1p(-alpha))) if alpha < 1 else 1
    last = rows.withColumn("__r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where(F.col("__r") <= n)
    folded = F.aggregate(F.transform(F.sort_array(F.collect_list(F.struct(order, value))), lambda s: s[value].cast("double")), F.lit(start), lambda m, x: F.greatest(F.lit(0.001), F.least(F.lit(1.0), alpha * x + (1 - alpha) * m)))
    return last.groupBy(key).agg(folded.alias("ema"))


def state_of(events: DataFrame, ranks: dict[str, int]) -> DataFrame:
    """The furthest state of each job: states only move forward."""
    rank = F.coalesce(*(F.when(F.col("state") == k, F.lit(v)) for k, v in ranks.items()))
    return events.groupBy("job_id").agg(F.max_by("state", rank).alias("state"))


def stale_leases(jobs: DataFrame, now) -> DataFrame:
    return jobs.where((F.col("state") == "LEASED") & (F.col("lease_until") < F.lit(now).cast("timestamp")))


def lease_order(jobs: DataFrame, now, n: int) -> DataFrame:
    """Jobs a worker would take next: queued and due, or leased and expired."""
    due = F.coalesce("available_at", "created_at")
    ok = ((F.col("state") == "QUEUED") & (due <= F.lit(now).cast("timestamp"))) | ((F.col("state") == "LEASED") & (F.col("lease_until") < F.lit(now).cast("timestamp")))
    return jobs.where(ok).orderBy(due, "created_at", "job_id").limit(n)


def queue_stats(jobs: DataFrame) -> DataFrame:
    """Jobs by state, with a total row (null state)."""
    return jobs.rollup("state").agg(F.count(F.lit(1)).alias("n"))


def bandwidth(downloads: DataFrame, seconds: int = 60) -> DataFrame:
    """Bytes over the last `seconds` before each download, by host."""
    rows = downloads.withColumn("__s", F.col("ts").cast("timestamp").cast("long"))
    return recent_sum(rows, ["host"], "__s", "bytes", seconds, "recent_bytes").drop("__s")


def limit_streaks(http: DataFrame) -> DataFrame:
    """By host: the longest run of 429 answers in order of time, and the mean Retry-After within it."""
    w = Window.partitionBy("host").orderBy("ts", "event_id")
    r = http.withColumn("__ok", F.sum((F.col("status") != 429).cast("int")).over(w)).where("status = 429")
    runs = r.groupBy("host", "__ok").agg(F.count(F.lit(1)).alias("streak"), F.avg("retry_after_s").alias("retry_after_s"))
    return runs.groupBy("host").agg(F.max("streak").alias("longest_streak"), F.round(F.max_by("retry_after_s", F.struct("streak", F.col("retry_after_s"))), 4).alias("retry_after_s"))


def metric_summary(rows: DataFrame, metric: str, value: str, since=None, ts: str = "ts") -> DataFrame:
    """By metric within a window of time: count, extremes, mean, percentiles by index."""
    rows = rows if since is None else rows.where(F.col(ts) >= F.lit(since).cast("timestamp"))
    p = by_index(rows, [metric], value, {"p50": 0.5, "p95": 0.95, "p99": 0.99}, clamp=True)
    g = rows.groupBy(metric).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("min"), F.max(value).alias("max"), F.round(F.avg(value), 6).alias("avg"))
    return g.join(p, metric)


def download_indicators(downloads: DataFrame) -> DataFrame:
    """By run: megabytes that deduplication saved (linked, copied or skipped content), and files without a path or digest."""
    saved = F.when(F.col("dedupe_action").isin("hardlink", "copy", "skipped"), F.col("content_length"))
    return downloads.groupBy("run_id").agg(F.round(F.coalesce(F.sum(saved), F.lit(0)) / F.lit(1024.0 * 1024.0), 6).alias("dedupe_saved_mb"), F.count_if(F.col("final_path").isNull() | F.col("sha256").isNull()).alias("corruption_count"))


def timeseries(attempts: DataFrame, step: str = "1 day") -> DataFrame:
    """Snapshots by step of time: attempts, success rate, mean and percentiles of the time they took, and the tier that did best (the smaller on ties)."""
    a = attempts.withColumn("start", F.window("ts", step)["start"])
    win = F.count_if(F.col("outcome") == "success")
    t = F.when(F.col("elapsed_ms") > 0, F.col("elapsed_ms"))
    g = a.groupBy("start").agg(F.count(F.lit(1)).alias("attempts"), ratio(win, F.count(F.lit(1)), 6).alias("success_rate"), F.round(F.avg(t), 4).alias("avg_ms"))
    p = by_index(a.where("elapsed_ms > 0"), ["start"], "elapsed_ms", {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}, clamp=True)
    tiers = a.groupBy("start", "tier").agg((win / F.count(F.lit(1))).alias("r")).groupBy("start").agg(F.max_by("tier", F.struct("r", -F.col("tier"))).alias("top_tier"), F.round(F.max("r"), 6).alias("top_tier_rate"))
    return g.join(p, "start", "left").join(tiers, "start")
