"""Registered queries: each applies an operator to views of the driver's tables; SQL says the same in DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import percentiles, scalars
from ..operators import catalog, dedup, documents, frames, markup, observability, retrieval, telemetry
from ..streaming import telemetry as streams
from .views import view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
NOW = "2024-01-31 00:00:00"


def query(sql: str | None = None):
    """Register the function under its name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = with_views(sql)
        return f

    return add


def views(spark: SparkSession, d: str, *names: str) -> list[DataFrame]:
    return [view(spark, d, n) for n in names]


# --- stock observability queries


@query("""SELECT service, count(*) AS request_count, round(quantile_cont(ms, 0.5), 6) AS p50_ms, round(quantile_cont(ms, 0.95), 6) AS p95_ms, round(quantile_cont(ms, 0.99), 6) AS p99_ms, round(avg(ms), 6) AS avg_ms, max(ms) AS max_ms
  FROM (SELECT service, CAST(payload->>'$.elapsed_ms' AS DOUBLE) AS ms FROM @obs WHERE type = 'net.request') GROUP BY service""")
def net_latency_distribution(s, d):
    df = observability.get_query("net_latency_distribution")(view(s, d, "obs"))
    return df.select("service", "request_count", *(F.round(c, 6).alias(c) for c in ("p50_ms", "p95_ms", "p99_ms", "avg_ms")), "max_ms")


@query("""SELECT service, count(*) AS total_requests, count(*) FILTER (c IN ('hit', 'revalidated')) AS cached_requests, round(100.0 * count(*) FILTER (c IN ('hit', 'revalidated')) / count(*), 2)::DOUBLE AS hit_ratio_percent
  FROM (SELECT service, payload->>'$.cache' AS c FROM @obs WHERE type = 'net.request') GROUP BY service""")
def net_cache_hit_ratio(s, d):
    return observability.get_query("net_cache_hit_ratio")(view(s, d, "obs"))


@query("""SELECT key, count(*) AS acquire_count, count(*) FILTER (NOT ok) AS blocked_count, CAST(sum(ms) AS BIGINT) AS total_blocked_ms, round(100.0 * count(*) FILTER (NOT ok) / count(*), 2)::DOUBLE AS block_rate_percent
  FROM (SELECT substr(payload->>'$.key', 1, 40) AS key, CAST(payload->>'$.allowed' AS BOOLEAN) AS ok, CAST(payload->>'$.blocked_ms' AS BIGINT) AS ms FROM @obs WHERE type = 'ratelimit.acquire')
  GROUP BY key HAVING sum(ms) > 0 ORDER BY total_blocked_ms DESC, key LIMIT 10""")
def ratelimit_pressure(s, d):
    return observability.get_query("ratelimit_pressure")(view(s, d, "obs"))


@query("""SELECT key, status_code, count(*) AS cooldown_count, CAST(sum(ms) AS BIGINT) AS total_cooldown_ms, round(avg(sec), 6) AS avg_cooldown_sec
  FROM (SELECT substr(payload->>'$.key', 1, 40) AS key, CAST(payload->>'$.status_code' AS INTEGER) AS status_code, CAST(payload->>'$.cooldown_ms' AS BIGINT) AS ms, CAST(payload->>'$.cooldown_sec' AS DOUBLE) AS sec FROM @obs WHERE type = 'ratelimit.cooldown')
  GROUP BY key, status_code""")
def ratelimit_cooldowns(s, d):
    return observability.get_query("ratelimit_cooldowns")(view(s, d, "obs")).withColumn("avg_cooldown_sec", F.round("avg_cooldown_sec", 6))


@query("""SELECT error_code, count(*) AS rejection_count, round(avg(ms), 2) AS avg_gate_ms, max(ms) AS max_gate_ms
  FROM (SELECT payload->>'$.error_code' AS error_code, CAST(payload->>'$.elapsed_ms' AS DOUBLE) AS ms FROM @obs WHERE type LIKE '%.error') GROUP BY error_code""")
def policy_rejections(s, d):
    return observability.get_query("policy_rejections")(view(s, d, "obs"))


@query("""SELECT CAST(ts AS DATE) AS date, type, count(*) AS error_count FROM @obs WHERE type LIKE '%.error' GROUP BY 1, 2 ORDER BY date DESC, error_count DESC, type LIMIT 50""")
def policy_heatmap(s, d):
    return observability.get_query("policy_heatmap")(view(s, d, "obs"))


@query("""SELECT ts, service, entries_total, entries_included, round(b / nullif(entries_included, 0), 2) AS bytes_per_entry, duration_ms
  FROM (SELECT ts, service, CAST(payload->>'$.entries_total' AS BIGINT) AS entries_total, CAST(payload->>'$.entries_included' AS BIGINT) AS entries_included, CAST(payload->>'$.bytes_written' AS DOUBLE) AS b, CAST(payload->>'$.duration_ms' AS DOUBLE) AS duration_ms FROM @obs WHERE type = 'extract.done')
  WHERE entries_total > 1000 OR round(b / nullif(entries_included, 0), 2) > 10.0 ORDER BY ts DESC, service LIMIT 20""")
def extract_zip_bombs(s, d):
    return observability.get_query("extract_zip_bombs")(view(s, d, "obs")).select("ts", "service", "entries_total", "entries_included", "bytes_per_entry", "duration_ms")


@query("""SELECT CAST(ts AS DATE) AS date, count(*) AS extraction_count, CAST(sum(CAST(payload->>'$.entries_total' AS BIGINT)) AS BIGINT) AS total_entries, CAST(sum(CAST(payload->>'$.bytes_written' AS BIGINT)) AS BIGINT) AS total_bytes, round(avg(CAST(payload->>'$.duration_ms' AS DOUBLE)), 6) AS avg_duration_ms
  FROM @obs WHERE type = 'extract.done' GROUP BY 1""")
def extract_summary(s, d):
    return observability.get_query("extract_summary")(view(s, d, "obs")).withColumn("avg_duration_ms", F.round("avg_duration_ms", 6))


@query("""SELECT ts, type, service, run_id FROM @obs WHERE level = 'ERROR' AND starts_with(type, 'fetch') AND ts >= TIMESTAMP '2024-01-20' ORDER BY ts DESC, run_id, type, service, event_id LIMIT 25""")
def events_tail(s, d):
    return observability.tail(view(s, d, "obs"), 25, "ERROR", "fetch", "2024-01-20").select("ts", "type", "service", "run_id")


# --- catalog


@query("""SELECT version_id, service, created_at FROM @versions WHERE service = 's1' ORDER BY created_at DESC LIMIT 3 OFFSET 1""")
def list_versions(s, d):
    return catalog.list_versions(view(s, d, "versions"), "s1", 3, 1).select("version_id", "service", "created_at")


@query("""SELECT file_id, relpath FROM @files WHERE version_id = 'v3' AND relpath LIKE 'd/1%' AND format = 'en' ORDER BY relpath, file_id LIMIT 20""")
def list_files(s, d):
    return catalog.list_files(view(s, d, "files"), "v3", "en", "d/1", 20).select("file_id", "relpath")


@query("""SELECT validation_id, file_id, run_at FROM @validations WHERE validator = 'quality' AND NOT passed ORDER BY run_at DESC, validation_id LIMIT 15""")
def list_validations(s, d):
    return catalog.list_validations(view(s, d, "validations"), "quality", False, 15).select("validation_id", "file_id", "run_at")


@query("SELECT * FROM @artifacts WHERE artifact_id = 'a7'")
def find_by_artifact_id(s, d):
    return catalog.lookup(view(s, d, "artifacts"), "artifact_id", "a7")


@query("SELECT f.file_id, f.artifact_id, a.status FROM @files f JOIN @artifacts a USING (artifact_id)")
def files_of_artifacts(s, d):
    return catalog.files_of_artifacts(*views(s, d, "files", "artifacts")).select("file_id", "artifact_id", "status")


@query("SELECT validation_id, file_id, version_id, validator FROM @validations JOIN (SELECT file_id, version_id FROM @files WHERE version_id = 'v4') USING (file_id)")
def validations_of_version(s, d):
    return catalog.validations_of_version(*views(s, d, "validations", "files"), "v4").select("validation_id", "file_id", "version_id", "validator")


@query("SELECT validation_id, file_id, relpath, version_id FROM @validations JOIN (SELECT file_id, relpath, version_id FROM @files) USING (file_id) WHERE NOT passed")
def validation_failures(s, d):
    return catalog.validation_failures(*views(s, d, "validations", "files")).select("validation_id", "file_id", "relpath", "version_id")


@query("""SELECT count(*) AS total, CAST(sum(size_bytes) AS BIGINT) AS bytes, CAST(trunc(avg(size_bytes)) AS BIGINT) AS avg_bytes, count(*) FILTER (status = 'fresh') AS n_fresh, count(*) FILTER (status = 'cached') AS n_cached, count(*) FILTER (status = 'failed') AS n_failed FROM @artifacts""")
def artifact_stats(s, d):
    return catalog.artifact_stats(view(s, d, "artifacts"))


@query("SELECT coalesce(format, 'unknown') AS format, count(*) AS n, CAST(sum(size_bytes) AS BIGINT) AS bytes, CAST(trunc(avg(size_bytes)) AS BIGINT) AS avg_bytes FROM @files GROUP BY 1")
def file_stats(s, d):
    return catalog.file_stats(view(s, d, "files"))


@query("SELECT validator, count(*) AS total, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed, round(100.0 * (count(*) FILTER (passed) / count(*)::DOUBLE), 2) AS pass_percent FROM @validations GROUP BY validator")
def validation_summary(s, d):
    return catalog.validation_summary(view(s, d, "validations"))


@query("""WITH j AS (SELECT file_id, bool_or(NOT passed) AS bad FROM @validations GROUP BY file_id),
  g AS (SELECT version_id, count(*) AS n, sum(size_bytes) AS b, count(DISTINCT format) AS k, count(*) FILTER (bad) AS f FROM @files LEFT JOIN j USING (file_id) GROUP BY version_id)
  SELECT version_id, service, coalesce(n, 0) AS n_files, CAST(coalesce(b, 0) AS BIGINT) AS bytes, coalesce(k, 0) AS n_formats, coalesce(f, 0) AS files_failed FROM @versions LEFT JOIN g USING (version_id)""")
def version_stats(s, d):
    return catalog.version_stats(*views(s, d, "versions", "files", "validations"))


@query("SELECT version_id, coalesce(format, 'unknown') AS format, count(*) AS n, CAST(sum(size_bytes) AS BIGINT) AS bytes FROM @files GROUP BY version_id, coalesce(format, 'unknown') UNION ALL SELECT version_id, NULL, count(*), CAST(sum(size_bytes) AS BIGINT) FROM @files GROUP BY version_id UNION ALL SELECT NULL, NULL, count(*), CAST(sum(size_bytes) AS BIGINT) FROM @files")
def storage_usage(s, d):
    return catalog.storage_usage(view(s, d, "files"))


@query("SELECT relpath, size_bytes, format, file_id FROM @files ORDER BY size_bytes DESC, file_id LIMIT 5")
def largest_files(s, d):
    return catalog.latest_summary(view(s, d, "files"))[1]


@query("""WITH x AS (SELECT relpath, sum(size_bytes) AS x FROM @files WHERE version_id = 'v1' GROUP BY relpath), y AS (SELECT relpath, sum(size_bytes) AS y FROM @files WHERE version_id = 'v2' GROUP BY relpath),
  j AS (SELECT * FROM x FULL JOIN y USING (relpath))
  SELECT count(*) FILTER (x IS NULL) AS added, count(*) FILTER (y IS NULL) AS removed, count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) AS common, CAST(coalesce(sum(y) FILTER (x IS NULL), 0) AS BIGINT) AS bytes_added, CAST(coalesce(sum(x) FILTER (y IS NULL), 0) AS BIGINT) AS bytes_removed,
         CAST(coalesce(sum(y), 0) - coalesce(sum(x), 0) AS BIGINT) AS net_bytes, least(count(*) FILTER (x IS NULL), count(*) FILTER (y IS NULL)) AS churn FROM j""")
def version_delta(s, d):
    return catalog.version_delta(view(s, d, "files"), "v1", "v2")


@query("SELECT file_id, relpath FROM @files WHERE version_id = 'v2' AND relpath NOT IN (SELECT relpath FROM @files WHERE version_id = 'v1')")
def added_files(s, d):
    return catalog.added_files(view(s, d, "files"), "v1", "v2").select("file_id", "relpath")


@query("SELECT file_id, relpath FROM @files WHERE version_id = 'v2' AND relpath IN (SELECT relpath FROM @files WHERE version_id = 'v1')")
def common_files(s, d):
    return catalog.common_files(view(s, d, "files"), "v1", "v2").select("file_id", "relpath")


@query("SELECT relpath, size_bytes FROM @listing l WHERE NOT EXISTS (SELECT 1 FROM @artifacts a WHERE a.fs_relpath = l.relpath) AND NOT EXISTS (SELECT 1 FROM @files f WHERE f.cas_relpath = l.relpath)")
def orphans(s, d):
    return catalog.orphans(*views(s, d, "listing", "artifacts", "files"))


@query("SELECT artifact_id FROM @artifacts a WHERE NOT EXISTS (SELECT 1 FROM @files f WHERE f.artifact_id = a.artifact_id)")
def orphaned_artifacts(s, d):
    return catalog.orphaned_artifacts(*views(s, d, "artifacts", "files")).select("artifact_id")


@query("SELECT file_id FROM @files f WHERE NOT EXISTS (SELECT 1 FROM @validations v WHERE v.file_id = f.file_id AND passed)")
def orphaned_files(s, d):
    return catalog.orphaned_files(*views(s, d, "files", "validations")).select("file_id")


@query("""WITH f AS (SELECT cas_relpath AS relpath, max(size_bytes) AS db_bytes FROM @files GROUP BY 1),
  j AS (SELECT relpath, db_bytes, size_bytes AS fs_bytes FROM f FULL JOIN @listing l USING (relpath))
  SELECT *, CASE WHEN fs_bytes IS NULL THEN 'missing' WHEN db_bytes IS NULL THEN 'untracked' ELSE 'size' END AS drift FROM j WHERE fs_bytes IS NULL OR db_bytes IS NULL OR db_bytes <> fs_bytes""")
def catalog_drift(s, d):
    return catalog.drift(*views(s, d, "listing", "files"))


@query("SELECT version_id, service, CAST(nth AS INTEGER) AS nth FROM (SELECT *, row_number() OVER (PARTITION BY service ORDER BY created_at DESC, version_id) AS nth FROM @versions) WHERE nth > 2")
def beyond_latest(s, d):
    return catalog.beyond_latest(view(s, d, "versions"), 2).select("version_id", "service", "nth")


@query("SELECT version_id FROM @versions WHERE created_at < TIMESTAMP '2024-01-31' - INTERVAL '20' DAY")
def retention_days(s, d):
    return catalog.older_than(view(s, d, "versions"), "created_at", 20, NOW).select("version_id")


@query("""WITH gone AS (SELECT version_id FROM (SELECT *, row_number() OVER (PARTITION BY service ORDER BY created_at DESC, version_id) AS nth FROM @versions) WHERE nth > 2)
  SELECT validation_id FROM @validations WHERE file_id IN (SELECT file_id FROM @files WHERE version_id NOT IN (SELECT version_id FROM gone))""")
def prune_cascade(s, d):
    v, f, x = views(s, d, "versions", "files", "validations")
    return catalog.prune({"versions": v, "files": f, "validations": x}, catalog.beyond_latest(v, 2))["validations"].select("validation_id")


@query("SELECT item_id, status, seq FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY seq DESC) AS r FROM @manifest) WHERE r = 1")
def latest_entries(s, d):
    return catalog.latest(view(s, d, "manifest"), ["item_id"], "seq").select("item_id", "status", "seq")


@query("""WITH a AS (SELECT * FROM @manifest WHERE seq % 2 = 0), b AS (SELECT * FROM @manifest WHERE seq % 2 = 1)
  SELECT item_id, status, seq FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY seq DESC) AS r FROM (SELECT * FROM a UNION ALL SELECT * FROM b)) WHERE r = 1""")
def upsert_by_rebuild(s, d):
    m = view(s, d, "manifest")
    return catalog.upsert(m.where("seq % 2 = 0"), m.where("seq % 2 = 1"), ["item_id"], "seq").select("item_id", "status", "seq")


@query("SELECT DISTINCT item_id FROM @manifest WHERE seq % 2 = 1 AND item_id NOT IN (SELECT item_id FROM @manifest WHERE seq % 2 = 0 AND item_id % 2 = 0)")
def register_or_get(s, d):
    m = view(s, d, "manifest")
    return catalog.register(m.where("seq % 2 = 0 and item_id % 2 = 0"), m.where("seq % 2 = 1"), ["item_id"]).select("item_id")


@query("""WITH a AS (SELECT artifact_id, status, size_bytes FROM @artifacts WHERE artifact_id NOT LIKE '%5'), b AS (SELECT artifact_id, CASE WHEN artifact_id LIKE '%3' THEN 'gone' ELSE status END AS status, size_bytes + CASE WHEN artifact_id LIKE '%7' THEN 1 ELSE 0 END AS size_bytes FROM @artifacts WHERE artifact_id NOT LIKE '%9'),
  j AS (SELECT coalesce(a.artifact_id, b.artifact_id) AS artifact_id, CASE WHEN a.artifact_id IS NULL THEN 'added' WHEN b.artifact_id IS NULL THEN 'removed' WHEN a.status <> b.status OR a.size_bytes <> b.size_bytes THEN 'modified' END AS change,
        concat_ws(',', CASE WHEN a.status <> b.status THEN 'status' END, CASE WHEN a.size_bytes <> b.size_bytes THEN 'size_bytes' END) AS f FROM a FULL JOIN b ON a.artifact_id = b.artifact_id)
  SELECT artifact_id, change, CASE WHEN change = 'modified' THEN f END AS fields FROM j WHERE change IS NOT NULL""")
def plan_diff(s, d):
    x = view(s, d, "artifacts").select("artifact_id", "status", "size_bytes")
    a = x.where("artifact_id not like '%5'")
    b = x.where("artifact_id not like '%9'").withColumn("size_bytes", F.col("size_bytes") + F.when(F.col("artifact_id").like("%7"), 1).otherwise(0)).withColumn("status", F.when(F.col("artifact_id").like("%3"), "gone").otherwise(F.col("status")))
    return catalog.plan_diff(a, b, "artifact_id", ["status", "size_bytes"])


@query("""WITH l AS (SELECT item_id, status, input_hash FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY seq DESC) AS r FROM @manifest) WHERE r = 1)
  SELECT action, count(*) AS n FROM (SELECT CASE WHEN output_exists AND l.status IN ('success', 'skip') AND l.input_hash = w.input_hash THEN 'skip' ELSE 'process' END AS action FROM @work w LEFT JOIN l USING (item_id)) GROUP BY action""")
def resume_plan(s, d):
    return catalog.resume(*views(s, d, "work", "manifest")).groupBy("action").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH f AS (SELECT version_id, sum(size_bytes) AS b FROM @files GROUP BY 1), v AS (SELECT service, version_id, created_at, CAST(coalesce(b, 0) AS BIGINT) AS bytes FROM @versions LEFT JOIN f USING (version_id))
  SELECT *, bytes - lag(bytes) OVER (PARTITION BY service ORDER BY created_at, version_id) AS change FROM v""")
def growth_report(s, d):
    return catalog.growth(*views(s, d, "versions", "files"))


# --- duplicates and retention


@query("SELECT sha256, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS total, CAST((count(*) - 1) * (sum(bytes) // count(*)) AS BIGINT) AS saved FROM @store WHERE sha256 IS NOT NULL GROUP BY sha256 HAVING count(*) > 1")
def find_duplicates(s, d):
    return dedup.duplicates(view(s, d, "store"))


@query("SELECT sha256, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS total, CAST((count(*) - 1) * (sum(bytes) // count(*)) AS BIGINT) AS saved FROM @store WHERE sha256 IS NOT NULL GROUP BY sha256 HAVING count(*) > 1 ORDER BY saved DESC, sha256 LIMIT 10")
def top_duplicates(s, d):
    return dedup.top_duplicates(view(s, d, "store"))


@query("SELECT count(*) AS n, count(DISTINCT sha256) AS n_digests, count(DISTINCT artifact_id) AS n_artifacts, CAST(sum(bytes) FILTER (bytes > 0) AS BIGINT) AS bytes, round((count(*) - count(DISTINCT sha256)) / count(*)::DOUBLE, 6) AS dedup_ratio FROM @store")
def store_totals(s, d):
    return dedup.totals(view(s, d, "store"))


@query("SELECT resolver, count(*) AS n, count(DISTINCT sha256) AS n_digests, CAST(sum(bytes) AS BIGINT) AS bytes, round((count(*) - count(DISTINCT sha256)) / count(*)::DOUBLE, 6) AS dedup_ratio FROM @store GROUP BY resolver")
def dedup_by_resolver(s, d):
    return dedup.by_resolver(view(s, d, "store"))


@query("""WITH g AS (SELECT sha256, count(*) AS n, sum(bytes) // count(*) AS m, min(created_at) AS f FROM @store WHERE sha256 IS NOT NULL GROUP BY sha256 HAVING count(*) > 1)
  SELECT sha256, n, round(0.2 * least(n / 10.0::DOUBLE, 1) + 0.6 * least(m / 1073741824.0::DOUBLE, 1) + 0.2 * least(date_diff('day', f, TIMESTAMP '2024-01-31') / 365.0::DOUBLE, 1), 6) AS priority FROM g ORDER BY priority DESC, sha256 LIMIT 10""")
def dedup_candidates(s, d):
    return dedup.candidates(view(s, d, "store"), NOW)


@query("""WITH r AS (SELECT *, CASE WHEN bytes >= 5000 THEN 30 WHEN resolver = 'src3' THEN 0 WHEN content_type = 'de' THEN 100 ELSE 200 END AS limit_days, count(*) OVER (PARTITION BY sha256) AS replicas, date_diff('day', created_at, TIMESTAMP '2024-01-31') AS age FROM @store)
  SELECT id, CAST(limit_days AS INTEGER) AS limit_days, replicas, CASE WHEN limit_days > 0 AND age > limit_days AND replicas >= 2 THEN 'delete' ELSE 'keep' END AS decision FROM r""")
def retention_decisions(s, d):
    out = dedup.retention(view(s, d, "store"), NOW, 200, {"de": 100}, {"src3": 0}, 5000, 30, 2)
    return out.select("id", "limit_days", "replicas", "decision")


@query("""SELECT 'duplicate' AS problem, concat_ws('/', CAST(artifact_id AS STRING), resolver) AS what FROM @store GROUP BY artifact_id, resolver HAVING count(*) > 1 UNION ALL SELECT 'no digest', CAST(id AS STRING) FROM @store WHERE sha256 IS NULL OR sha256 = ''""")
def integrity_violations(s, d):
    return dedup.integrity(view(s, d, "store"))


# --- service indicators


@query("""WITH a AS (SELECT run_id, count(*) FILTER (outcome = 'success') / count(*)::DOUBLE AS y FROM @attempts GROUP BY run_id),
  h AS (SELECT run_id, 100.0 * count(*) FILTER (from_cache) / count(*)::DOUBLE AS c, 100.0 * count(*) FILTER (NOT from_cache AND status = 429) / nullif(count(*) FILTER (NOT from_cache), 0)::DOUBLE AS l, list_sort(list(rate_delay_ms)) AS r FROM @http GROUP BY run_id)
  SELECT run_id, round(y, 6) AS yield, round(c, 4) AS cache_hit_percent, round(l, 4) AS limited_percent, r[CAST(floor(len(r) * 0.95) AS BIGINT) + 1] AS rate_delay_p95_ms FROM h FULL JOIN a USING (run_id)""")
def run_indicators(s, d):
    return telemetry.run_indicators(*views(s, d, "http", "attempts"))


@query("""SELECT run_id, work_id, round(epoch(min(ts) FILTER (outcome = 'success')) - epoch(min(ts)), 3) AS ttfp_s FROM @attempts GROUP BY run_id, work_id HAVING count(*) FILTER (outcome = 'success') > 0""")
def time_to_first_success(s, d):
    return telemetry.first_success(view(s, d, "attempts")).withColumn("ttfp_s", F.round("ttfp_s", 3))


@query("SELECT host, round(count(*) FILTER (NOT from_cache AND status = 429) / nullif(count(*) FILTER (NOT from_cache), 0)::DOUBLE, 6) AS limited_ratio FROM @http GROUP BY host")
def limited_by_host(s, d):
    return telemetry.limited_by_host(view(s, d, "http"))


@query("SELECT host, count(*) AS opens FROM @transitions WHERE old_state = 'CLOSED' AND new_state = 'OPEN' GROUP BY host")
def breaker_opens(s, d):
    return telemetry.opens_by_host(view(s, d, "transitions"))


@query("""SELECT host, ts, round(epoch(n) - epoch(ts), 3) AS open_s FROM (SELECT *, lead(ts) OVER w AS n, lead(new_state) OVER w AS ns FROM @transitions WINDOW w AS (PARTITION BY host ORDER BY ts, event_id)) WHERE new_state = 'OPEN' AND ns <> 'OPEN'""")
def breaker_open_durations(s, d):
    return telemetry.open_durations(view(s, d, "transitions")).withColumn("open_s", F.round("open_s", 3))


@query("""SELECT host, calls, limited_ratio, failures, retry_after_s, CASE WHEN limited_ratio >= 0.05 THEN 0.8 ELSE 1.0 END::DOUBLE AS rate_factor, greatest(15.0, least(900.0, retry_after_s))::DOUBLE AS reset_s
  FROM (SELECT host, count(*) AS calls, round(count(*) FILTER (status = 429) / count(*)::DOUBLE, 6) AS limited_ratio, count(*) FILTER (status >= 500) AS failures, median(retry_after_s) AS retry_after_s FROM @http WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL '864000' SECOND GROUP BY host)""")
def breaker_advice(s, d):
    return telemetry.advice(telemetry.advisor_metrics(view(s, d, "http"), NOW, 864000))


@query("SELECT count(*) AS jobs, round(count(*) FILTER (state = 'FINALIZED') / count(*)::DOUBLE, 6) AS completion_rate FROM @jobs")
def job_completion(s, d):
    return telemetry.completion(view(s, d, "jobs"))


@query("""SELECT kind, x[least(CAST(floor(len(x) * 0.5) AS BIGINT), len(x) - 1) + 1] AS p50_s, x[least(CAST(floor(len(x) * 0.95) AS BIGINT), len(x) - 1) + 1] AS p95_s, x[least(CAST(floor(len(x) * 0.99) AS BIGINT), len(x) - 1) + 1] AS p99_s
  FROM (SELECT kind, list_sort(list(CAST(job_id % 1000 AS DOUBLE))) AS x FROM @jobs WHERE state = 'FINALIZED' GROUP BY kind)""")
def time_to_complete(s, d):
    return telemetry.time_to_complete(view(s, d, "jobs"), ["kind"])


@query("SELECT kind, CASE WHEN p <= 120 THEN 'pass' WHEN p - 120 <= 30 THEN 'warn' ELSE 'fail' END AS status FROM (SELECT kind, list_sort(list(job_id % 1000))[CAST(floor(count(*) * 0.95) AS BIGINT) + 1] AS p FROM @jobs WHERE state = 'FINALIZED' GROUP BY kind)")
def objective_status(s, d):
    t = telemetry.time_to_complete(view(s, d, "jobs"), ["kind"])
    return t.select("kind", telemetry.objective("p95_s", F.col("p95_s")).alias("status"))


@query("SELECT job_id, epoch(t) - epoch(created_at) AS lease_s FROM @jobs LEFT JOIN (SELECT job_id, min(started_at) AS t FROM @ops GROUP BY job_id) USING (job_id)")
def lease_latency(s, d):
    return telemetry.lease_latency(*views(s, d, "jobs", "ops"))


@query("SELECT round(sum(n - 1) / sum(n)::DOUBLE, 6) AS replay_rate FROM (SELECT job_id, kind, count(*) AS n FROM @ops GROUP BY job_id, kind)")
def replay_rate(s, d):
    return telemetry.replay_rate(view(s, d, "ops"))


@query("SELECT tier, count(*) AS attempts, count(*) FILTER (outcome = 'success') AS wins, round(count(*) FILTER (outcome = 'success') / count(*)::DOUBLE, 3) AS success_rate, round(avg(elapsed_ms) FILTER (elapsed_ms > 0), 1) AS avg_ms FROM @attempts GROUP BY tier")
def attempts_by_tier(s, d):
    return telemetry.attempts_overall(view(s, d, "attempts"), "tier")


@query("SELECT source, count(*) AS attempts, count(*) FILTER (outcome = 'success') AS wins, round(count(*) FILTER (outcome = 'success') / count(*)::DOUBLE, 3) AS success_rate, round(avg(elapsed_ms) FILTER (elapsed_ms > 0), 1) AS avg_ms FROM @attempts GROUP BY source")
def attempts_by_source(s, d):
    return telemetry.attempts_overall(view(s, d, "attempts"), "source")


@query("SELECT reason, count(*) AS n FROM @attempts WHERE outcome <> 'success' GROUP BY reason ORDER BY n DESC, reason LIMIT 5")
def top_failures(s, d):
    return telemetry.top_failures(view(s, d, "attempts"))


@query("""SELECT source, round(count(*) FILTER (i <= n // 2 AND outcome = 'success') / nullif(count(*) FILTER (i <= n // 2), 0)::DOUBLE, 6) AS first_half, round(count(*) FILTER (i > n // 2 AND outcome = 'success') / nullif(count(*) FILTER (i > n // 2), 0)::DOUBLE, 6) AS second_half
  FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ts, event_id) AS i, count(*) OVER (PARTITION BY source) AS n FROM @attempts) GROUP BY source""")
def trend_halves(s, d):
    return telemetry.halves(view(s, d, "attempts"), ["source"])


@query("SELECT work_id, source FROM (SELECT *, row_number() OVER (PARTITION BY work_id ORDER BY tier, elapsed_ms, source) AS r FROM @attempts WHERE outcome = 'success') WHERE r = 1")
def tiered_fallback(s, d):
    return telemetry.first_win(view(s, d, "attempts"))


@query("SELECT host, role, count(*) FILTER (action = 'acquire') AS acquired, CAST(sum(delay_ms) FILTER (action = 'acquire') AS BIGINT) AS wait_ms, count(*) FILTER (action = 'block') AS blocked, arg_max(backend, (ts, event_id)) AS backend FROM @rate GROUP BY host, role")
def limiter_rollup(s, d):
    return telemetry.limiter_rollup(view(s, d, "rate"))


@query("SELECT host, role, quantile_disc(delay_ms, 0.95) AS p95 FROM @rate WHERE action = 'acquire' GROUP BY host, role")
def nearest_rank_p95(s, d):
    return percentiles.by_index(view(s, d, "rate").where("action = 'acquire'"), ["host", "role"], "delay_ms", {"p95": 0.95}, "nearest")


@query("""SELECT gate, count(*) AS n, round(count(*) FILTER (passed) / count(*)::DOUBLE, 6) AS pass_rate, min(elapsed_ms) AS min_ms, max(elapsed_ms) AS max_ms, round(avg(elapsed_ms), 4) AS avg_ms,
  list_sort(list(elapsed_ms))[CAST(floor(count(*) * 0.5) AS BIGINT) + 1] AS p50_ms, list_sort(list(elapsed_ms))[CAST(floor(count(*) * 0.95) AS BIGINT) + 1] AS p95_ms, list_sort(list(elapsed_ms))[CAST(floor(count(*) * 0.99) AS BIGINT) + 1] AS p99_ms FROM @gates GROUP BY gate""")
def gate_summary(s, d):
    return telemetry.gate_summary(view(s, d, "gates"))


@query("SELECT gate, 'max_ms' AS metric, max(elapsed_ms)::DOUBLE AS value, 3400.0::DOUBLE AS threshold FROM @gates GROUP BY gate HAVING max(elapsed_ms) > 3400")
def threshold_alerts(s, d):
    return telemetry.alerts(telemetry.gate_summary(view(s, d, "gates")).select("gate", "max_ms"), {"max_ms": 3400.0})


@query("SELECT state, count(*) AS n FROM @jobs GROUP BY state UNION ALL SELECT NULL, count(*) FROM @jobs")
def queue_stats(s, d):
    return telemetry.queue_stats(view(s, d, "jobs"))


@query("SELECT job_id FROM @jobs WHERE state = 'LEASED' AND lease_until < TIMESTAMP '1998-01-01'")
def stale_leases(s, d):
    return telemetry.stale_leases(view(s, d, "jobs"), "1998-01-01").select("job_id")


@query("""SELECT job_id FROM @jobs WHERE (state = 'QUEUED' AND coalesce(available_at, created_at) <= TIMESTAMP '1998-01-01') OR (state = 'LEASED' AND lease_until < TIMESTAMP '1998-01-01') ORDER BY coalesce(available_at, created_at), created_at, job_id LIMIT 30""")
def lease_order(s, d):
    return telemetry.lease_order(view(s, d, "jobs"), "1998-01-01", 30).select("job_id")


@query("SELECT event_id, sum(elapsed_ms) OVER (PARTITION BY host ORDER BY floor(epoch(ts))::BIGINT RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW)::BIGINT AS recent_bytes FROM @http")
def bandwidth_window(s, d):
    return telemetry.bandwidth(view(s, d, "http").withColumnRenamed("elapsed_ms", "bytes"), 3600).select("event_id", "recent_bytes")


@query("""SELECT source, round(list_reduce(list_prepend(0.75::DOUBLE, list(CASE WHEN outcome = 'success' THEN 1 ELSE 0 END::DOUBLE ORDER BY event_id)), lambda m, x: greatest(0.001::DOUBLE, least(1::DOUBLE, 0.2::DOUBLE * x + 0.8::DOUBLE * m))), 9) AS ema FROM @attempts GROUP BY source""")
def pass_rate_ema(s, d):
    e = telemetry.ema(view(s, d, "attempts").withColumn("win", (F.col("outcome") == "success").cast("double")), "source", "event_id", "win")
    return e.withColumn("ema", F.round("ema", 9))


_COUNTS = "(SELECT run_id, '{{' || string_agg('\"' || k || '\":' || n, ',' ORDER BY k) || '}}' AS j FROM (SELECT run_id, {0} AS k, count(*) AS n FROM @attempts GROUP BY 1, 2) GROUP BY 1)"


@query(f"""SELECT o.run_id AS run_id, '{{"outcome":' || o.j || ',"reason":' || r.j || ',"source":' || s.j || '}}' AS record FROM {_COUNTS.format("outcome")} o JOIN {_COUNTS.format("reason")} r ON o.run_id = r.run_id JOIN {_COUNTS.format("source")} s ON o.run_id = s.run_id""")
def run_summary(s, d):
    return telemetry.run_summary(view(s, d, "attempts"))


@query()
def circuit_breaker(s, d):
    calls = view(s, d, "http").select("host", "ts", "event_id", (F.col("status") >= 429).alias("failed"))
    return streams.breaker_batch(calls, 3, 7200.0, 3600.0)


# --- retrieval: tokens are runs of ASCII letters, digits and apostrophes, as both engines read them

_TOKENS = "regexp_extract_all(lower(text), '[a-z0-9'']+')"
_POST = f"""d AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents) GROUP BY 1, 2),
  q AS (SELECT item_id AS query_id, term, count(*) AS tf FROM (SELECT item_id, unnest({_TOKENS}) AS term FROM benchmark) GROUP BY 1, 2)"""


def ascii_tokens(text: str = "text"):
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9']+)"), F.lit(1))


def _both(s, d):
    docs, items = views(s, d, "documents", "benchmark")
    post = retrieval.postings(docs, tokens=ascii_tokens())
    asked = retrieval.postings(items.withColumnRenamed("item_id", "query_id"), "query_id", tokens=ascii_tokens())
    return post, asked


@query(f"WITH {_POST} SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM d GROUP BY term")
def term_statistics(s, d):
    post, _ = _both(s, d)
    return post.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


@query(f"WITH {_POST} SELECT doc_id, term, tf, round(1 + ln(1 + tf), 6) AS bm25_weight, round(ln(1 + tf) * (0.5 + tf / m), 6) AS sparse_weight FROM (SELECT *, max(tf) OVER (PARTITION BY doc_id)::DOUBLE AS m FROM d)")
def term_weights(s, d):
    post, _ = _both(s, d)
    return retrieval.term_weights(post).select("doc_id", "term", "tf", F.round("bm25_weight", 6).alias("bm25_weight"), F.round("sparse_weight", 6).alias("sparse_weight"))


@query(f"""WITH {_POST}, l AS (SELECT doc_id, sum(tf)::DOUBLE AS dl FROM d GROUP BY 1), n AS (SELECT count(*)::DOUBLE AS n, avg(dl) AS a FROM l), f AS (SELECT term, count(*)::DOUBLE AS df FROM d GROUP BY 1)
  SELECT doc_id, term, round(w, 6) AS weight FROM (SELECT doc_id, term, ln((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / a)) AS w FROM d JOIN l USING (doc_id) JOIN f USING (term), n) WHERE w > 0""")
def bm25_vectors(s, d):
    post, _ = _both(s, d)
    return retrieval.bm25_vectors(post).select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query(f"""WITH {_POST}, l AS (SELECT doc_id, sum(tf)::DOUBLE AS dl FROM d GROUP BY 1), n AS (SELECT count(*)::DOUBLE AS n, avg(dl) AS a FROM l), f AS (SELECT term, count(*)::DOUBLE AS df FROM d GROUP BY 1),
  s AS (SELECT query_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * (1 + ln(1 + d.tf)) * 2.2 / (1 + ln(1 + d.tf) + 1.2 * (0.25 + 0.75 * dl / a))), 9) AS score FROM q JOIN d USING (term) JOIN f USING (term) JOIN l USING (doc_id), n GROUP BY 1, 2)
  SELECT query_id, doc_id, CAST(r AS INTEGER) AS rank, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS r FROM s WHERE score > 0) WHERE r <= 10""")
def bm25_search(s, d):
    post, asked = _both(s, d)
    return retrieval.bm25_search(asked, post, 10).select("query_id", "doc_id", "rank", F.round("score", 6).alias("score"))


_CHANNELS = f"""{_POST}, dw AS (SELECT *, 1 + ln(1 + tf) AS b, ln(1 + tf) * (0.5 + tf / max(tf) OVER (PARTITION BY doc_id)::DOUBLE) AS p FROM d), qw AS (SELECT *, 1 + ln(1 + tf) AS b, ln(1 + tf) * (0.5 + tf / max(tf) OVER (PARTITION BY query_id)::DOUBLE) AS p FROM q),
  s AS (SELECT query_id, doc_id, round(sum(qw.b * dw.b), 9) AS b, round(sum(qw.p * dw.p), 9) AS p FROM qw JOIN dw USING (term) GROUP BY 1, 2)"""


@query(f"WITH {_CHANNELS} SELECT query_id, doc_id, CAST(r AS INTEGER) AS rank, round(p, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY p DESC, doc_id) AS r FROM s WHERE p > 0) WHERE r <= 10")
def sparse_search(s, d):
    post, asked = _both(s, d)
    w = lambda x, k: retrieval.term_weights(x, k).select(k, "term", F.col("sparse_weight").alias("weight"))
    return retrieval.sparse_search(w(asked, "query_id"), w(post, "doc_id"), 10).select("query_id", "doc_id", "rank", F.round("score", 6).alias("score"))


@query(f"WITH {_CHANNELS} SELECT query_id, doc_id, CAST(r AS INTEGER) AS rank, round(b, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY b DESC, doc_id) AS r FROM s WHERE b > 0) WHERE r <= 10")
def compat_search(s, d):
    post, asked = _both(s, d)
    w = lambda x, k: retrieval.term_weights(x, k).select(k, "term", F.col("bm25_weight").alias("weight"))
    return retrieval.sparse_search(w(asked, "query_id"), w(post, "doc_id"), 10).select("query_id", "doc_id", "rank", F.round("score", 6).alias("score"))


_DOT = "list_sum(list_transform(range(1, len(q.embedding) + 1), lambda i: q.embedding[i]::DOUBLE * c.embedding[i]::DOUBLE))"
_NORM = "sqrt(list_sum(list_transform({0}.embedding, lambda x: x::DOUBLE * x::DOUBLE)))"
_COS = f"round({_DOT} / ({_NORM.format('q')} * {_NORM.format('c')}), 9)"


def _asked(s, d):
    """The benchmark's items with the vectors of their numbers, the documents, and the documents' vectors."""
    v = view(s, d, "embeddings")
    items = view(s, d, "benchmark").withColumnRenamed("item_id", "query_id")
    items = items.join(v.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")), "query_id", "left")
    docs = view(s, d, "documents")
    return items, docs, v.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector")).join(docs.select("doc_id"), "doc_id", "left_semi")


_SOME_LANGS = "lang IN ('en', 'fr')"


def _fused(ranks: str, where: str, dense: bool) -> str:
    """SQL of the channels' ranks within `where`, and of their fusion."""
    third = f""", v AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY x DESC, doc_id) AS r FROM (SELECT q.vec_id AS query_id, c.vec_id AS doc_id, {_COS} AS x FROM embeddings q, embeddings c
      WHERE q.vec_id IN (SELECT item_id FROM benchmark) AND c.vec_id IN (SELECT doc_id FROM documents WHERE {where})))""" if dense else ""
    return f"""{ranks}, k AS (SELECT * FROM s WHERE doc_id IN (SELECT doc_id FROM documents WHERE {where})),
  r AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY b DESC, doc_id) AS r FROM k WHERE b > 0 UNION ALL SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY p DESC, doc_id) FROM k WHERE p > 0){third},
  f AS (SELECT query_id, doc_id, round(sum(1 / (60.0::DOUBLE + r)), 12) AS score FROM ({"SELECT * FROM r UNION ALL SELECT * FROM v" if dense else "SELECT * FROM r"}) WHERE r <= 50 GROUP BY 1, 2),
  g AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS fused_rank FROM f)"""


@query(f"WITH {_fused(_CHANNELS, 'true', True)} SELECT query_id, doc_id, fused_rank, round(score, 9) AS score FROM g WHERE fused_rank <= 10")
def hybrid_search(s, d):
    items, docs, vectors = _asked(s, d)
    found = retrieval.hybrid(items, docs, tokens=ascii_tokens(), q_tokens=ascii_tokens(), vectors=vectors)
    return found.select("query_id", "doc_id", "fused_rank", F.round("score", 9).alias("score"))


@query(f"WITH {_fused(_CHANNELS, _SOME_LANGS, True)} SELECT query_id, doc_id, fused_rank, round(score, 9) AS score FROM g WHERE fused_rank <= 10")
def hybrid_filtered(s, d):
    items, docs, vectors = _asked(s, d)
    found = retrieval.hybrid(items, docs, tokens=ascii_tokens(), q_tokens=ascii_tokens(), vectors=vectors, filters={"lang": ["en", "fr"]})
    return found.select("query_id", "doc_id", "fused_rank", F.round("score", 9).alias("score"))


@query(f"""WITH RECURSIVE {_fused(_CHANNELS, 'true', True)}, h AS (SELECT query_id, doc_id, score, fused_rank AS rank FROM g WHERE fused_rank <= 200),
  p AS (SELECT query_id, doc_id, map(list(other), list(x)) AS near FROM (SELECT a.query_id AS query_id, a.doc_id AS doc_id, b.doc_id AS other, CASE WHEN q.vec_id IS NULL OR c.vec_id IS NULL THEN 0 ELSE {_DOT} / ({_NORM.format("q")} * {_NORM.format("c")}) END AS x
    FROM h a JOIN h b ON a.query_id = b.query_id LEFT JOIN embeddings q ON q.vec_id = a.doc_id LEFT JOIN embeddings c ON c.vec_id = b.doc_id) GROUP BY 1, 2),
  m AS (SELECT query_id, 1 AS k, [doc_id] AS ids FROM h WHERE rank = 1 UNION ALL
    SELECT query_id, k + 1, list_append(ids, arg_min(doc_id, [-gain, rank::DOUBLE])) FROM (SELECT m.query_id AS query_id, m.k AS k, m.ids AS ids, h.doc_id AS doc_id, h.rank AS rank, round(0.6::DOUBLE * h.score - 0.4::DOUBLE * list_max(list_transform(m.ids, lambda i: p.near[i])), 9) AS gain
      FROM m JOIN h ON h.query_id = m.query_id AND NOT list_contains(m.ids, h.doc_id) JOIN p ON p.query_id = h.query_id AND p.doc_id = h.doc_id WHERE m.k < 10) GROUP BY query_id, k, ids)
  SELECT m.query_id AS query_id, h.doc_id AS doc_id, round(h.score, 9) AS score, CAST(m.i AS INTEGER) AS mmr_rank FROM (SELECT query_id, unnest(ids) AS doc_id, generate_subscripts(ids, 1) AS i FROM m WHERE k = 10) m JOIN h ON h.query_id = m.query_id AND h.doc_id = m.doc_id""")
def hybrid_diverse(s, d):
    items, docs, vectors = _asked(s, d)
    found = retrieval.hybrid(items, docs, tokens=ascii_tokens(), q_tokens=ascii_tokens(), vectors=vectors, diversify=True)
    return found.withColumn("score", F.round("score", 9))


@query(f"""WITH s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, {_COS} AS score FROM embeddings q, embeddings c WHERE q.vec_id % 100 = 0)
  SELECT query_id, vec_id, CAST(r AS INTEGER) AS rank, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 10""")
def dense_search(s, d):
    v = view(s, d, "embeddings")
    asked = v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return retrieval.dense_search(asked, v, 10).select("query_id", "vec_id", "rank", F.round("score", 6).alias("score"))


@query(f"""WITH s AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r, max(score) OVER (PARTITION BY query_id) >= 0.999 AS met FROM
  (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, {_COS} AS score FROM embeddings q, embeddings c WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id))
  SELECT query_id, vec_id, CAST(r AS INTEGER) AS rank, round(score, 6) AS score, NOT met AS fell_back FROM s WHERE r <= CASE WHEN met THEN 40 ELSE 5 END AND (score >= 0.999 OR NOT met)""")
def range_fallback(s, d):
    v = view(s, d, "embeddings")
    asked = v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    found = retrieval.range_search(asked, v, 0.999, 40, 5, others=True)
    return found.select("query_id", "vec_id", "rank", F.round("score", 6).alias("score"), "fell_back")


@query(f"SELECT query_id, vec_id, CAST(r AS INTEGER) AS rank, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, {_COS} AS score FROM embeddings q, embeddings c WHERE q.vec_id % 100 = 0) WHERE score >= 0.5)")
def range_search(s, d):
    v = view(s, d, "embeddings")
    asked = v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return retrieval.dense_search(asked, v, None, 0.5).select("query_id", "vec_id", "rank", F.round("score", 6).alias("score"))


@query(f"""WITH RECURSIVE h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, {_COS} AS score FROM embeddings q, embeddings c WHERE q.vec_id % 100 = 0)) WHERE rank <= 50),
  p AS (SELECT query_id, vec_id, map(list(other), list(x)) AS near FROM (SELECT a.query_id AS query_id, a.vec_id AS vec_id, b.vec_id AS other, {_DOT} / ({_NORM.format("q")} * {_NORM.format("c")}) AS x FROM h a JOIN h b ON a.query_id = b.query_id JOIN embeddings q ON q.vec_id = a.vec_id JOIN embeddings c ON c.vec_id = b.vec_id) GROUP BY 1, 2),
  m AS (SELECT query_id, 1 AS k, [vec_id] AS ids FROM h WHERE rank = 1 UNION ALL
    SELECT query_id, k + 1, list_append(ids, arg_min(vec_id, [-gain, rank::DOUBLE])) FROM (SELECT m.query_id AS query_id, m.k AS k, m.ids AS ids, h.vec_id AS vec_id, h.rank AS rank, round(0.6::DOUBLE * h.score - 0.4::DOUBLE * list_max(list_transform(m.ids, lambda i: p.near[i])), 9) AS gain
      FROM m JOIN h ON h.query_id = m.query_id AND NOT list_contains(m.ids, h.vec_id) JOIN p ON p.query_id = h.query_id AND p.vec_id = h.vec_id WHERE m.k < 10) GROUP BY query_id, k, ids)
  SELECT m.query_id AS query_id, h.vec_id AS vec_id, round(h.score, 6) AS score, CAST(m.i AS INTEGER) AS mmr_rank FROM (SELECT query_id, unnest(ids) AS vec_id, generate_subscripts(ids, 1) AS i FROM m WHERE k = 10) m JOIN h ON h.query_id = m.query_id AND h.vec_id = m.vec_id""")
def mmr_rerank(s, d):
    v = view(s, d, "embeddings")
    asked = v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    hits = retrieval.dense_search(asked, v, 50).join(v.select("vec_id", F.col("embedding").alias("vector")), "vec_id")
    return retrieval.mmr(hits.drop("rank"), key="vec_id").withColumn("score", F.round("score", 6))


@query(f"""WITH RECURSIVE h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, c.label AS doc, {_COS} AS score FROM embeddings q, embeddings c WHERE q.vec_id % 100 = 0)) WHERE rank <= 50),
  p AS (SELECT query_id, vec_id, map(list(other), list(x)) AS near FROM (SELECT a.query_id AS query_id, a.vec_id AS vec_id, b.vec_id AS other, {_DOT} / ({_NORM.format("q")} * {_NORM.format("c")}) AS x FROM h a JOIN h b ON a.query_id = b.query_id JOIN embeddings q ON q.vec_id = a.vec_id JOIN embeddings c ON c.vec_id = b.vec_id) GROUP BY 1, 2),
  m AS (SELECT DISTINCT query_id, 0 AS k, 0::BIGINT AS t, 0::BIGINT AS b, []::BIGINT[] AS ids, []::BIGINT[] AS docs, false AS ended FROM h UNION ALL
    SELECT query_id, k + 1, CASE WHEN (over OR burst) THEN t ELSE t + nt END, CASE WHEN (over OR burst) THEN b ELSE b + nb END, CASE WHEN (over OR burst) THEN ids ELSE list_append(ids, vec_id) END, CASE WHEN (over OR burst) THEN docs ELSE list_append(docs, doc) END, NOT over AND burst
    FROM (SELECT m.*, h.vec_id AS vec_id, h.doc::BIGINT AS doc, h.vec_id % 90 + 10 AS nt, h.vec_id % 700 + 100 AS nb, len(list_filter(m.docs, lambda x: x = h.doc)) >= 3 OR coalesce(list_max(list_transform(m.ids, lambda i: p.near[i])) >= 0.98, false) AS over, m.t + h.vec_id % 90 + 10 > 2000 OR m.b + h.vec_id % 700 + 100 > 32000 AS burst
      FROM m JOIN h ON h.query_id = m.query_id AND h.rank = m.k + 1 JOIN p ON p.query_id = h.query_id AND p.vec_id = h.vec_id WHERE NOT m.ended)),
  z AS (SELECT query_id, arg_max(ids, k) AS ids FROM m GROUP BY query_id)
  SELECT z.query_id AS query_id, h.vec_id AS chunk_id, h.doc::BIGINT AS doc, round(h.score, 6) AS score, CAST(h.rank AS INTEGER) AS fused_rank FROM z JOIN h ON h.query_id = z.query_id AND list_contains(z.ids, h.vec_id)""")
def shaped_results(s, d):
    v = view(s, d, "embeddings")
    asked = v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    hits = retrieval.dense_search(asked, v, 50).join(v.select("vec_id", "label", F.col("embedding").alias("vector")), "vec_id")
    rows = hits.select("query_id", F.col("vec_id").alias("chunk_id"), F.col("label").cast("long").alias("doc"), "score", F.col("rank").alias("fused_rank"), (F.col("vec_id") % 90 + 10).alias("tokens"), (F.col("vec_id") % 700 + 100).alias("bytes"), "vector")
    return retrieval.shape(rows).withColumn("score", F.round("score", 6))


@query("""SELECT doc_id, n_chars FROM documents WHERE n_chars < 3000 OR (n_chars = 3000 AND doc_id > 10) ORDER BY n_chars DESC, doc_id LIMIT 20""")
def keyset_page(s, d):
    return retrieval.page_after(view(s, d, "documents").select("doc_id", F.col("n_chars").alias("score")), 20, (3000, 10)).select("doc_id", F.col("score").alias("n_chars"))


@query("SELECT doc_id FROM documents WHERE source IN ('src1', 'src2') AND lang = 'en'")
def metadata_filter(s, d):
    docs = view(s, d, "documents")
    return docs.where(retrieval.matches({"source": F.col("source"), "lang": F.col("lang")}, {"source": ["src1", "src2"], "lang": "en"})).select("doc_id")


@query("SELECT doc_id, array_to_string(list_filter(['the', 'der', 'loser'], lambda t: contains(lower(text), t)), ' ') AS found FROM documents")
def highlights(s, d):
    toks = F.array(F.lit("the"), F.lit("der"), F.lit("loser"))
    return view(s, d, "documents").select("doc_id", F.array_join(retrieval.highlight(toks, F.col("text")), " ").alias("found"))


# --- documents


@query(f"""WITH t AS (SELECT doc_id, {_TOKENS} AS t FROM documents), w AS (SELECT doc_id, unnest(range(0, len(t), 150)) AS s, t FROM t WHERE len(t) > 0)
  SELECT doc_id, CAST(s // 150 AS INTEGER) AS chunk, CAST(s AS INTEGER) AS start, CAST(least(len(t) - s, 200) AS INTEGER) AS n_tokens, array_to_string(t[s + 1:s + 200], ' ') AS tokens FROM w""")
def sliding_windows(s, d):
    w = documents.sliding_windows(view(s, d, "documents"), 200, 50, ascii_tokens())
    return w.select("doc_id", "chunk", "start", "n_tokens", F.array_join("tokens", " ").alias("tokens"))


@query()
def coalesced_chunks(s, d):
    p = documents.paragraphs(view(s, d, "documents")).withColumn("refs", F.array().cast("array<string>")).withColumn("pages", F.array(F.col("chunk"))).withColumn("confidence", F.lit(1.0))
    return documents.coalesce_small_runs(p, 40, 200)


_LINES = """l AS (SELECT doc_id, ls, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
  p AS (SELECT doc_id, i - 1 AS chunk, ls[i] AS text, coalesce(list_sum(list_transform(ls[1:i - 1], lambda x: length(x) + 1)), 0) AS off FROM l WHERE trim(ls[i], ' ') <> '')"""


@query(f"""WITH {_LINES}, h AS (SELECT *, sha256(doc_id || chr(31) || CAST(off AS BIGINT) || chr(31) || nfc_normalize(text)) AS x FROM p)
  SELECT doc_id, CAST(chunk AS INTEGER) AS chunk, CAST(off AS INTEGER) AS "offset", x[1:8] || '-' || x[9:12] || '-5' || x[14:16] || '-' || substr('89ab', CAST(('0x' || x[17:17])::INTEGER % 4 + 1 AS INTEGER), 1) || x[18:20] || '-' || x[21:32] AS uuid FROM h""")
def chunk_uuids(s, d):
    return documents.with_uuids(documents.paragraphs(view(s, d, "documents"))).select("doc_id", "chunk", "offset", "uuid")


@query(r"""SELECT page_id, nullif(regexp_extract(html, '(?is)<html[^>]*\blang=["'']?([A-Za-z-]+)', 1), '') AS lang,
  nullif(regexp_extract(html, '(?is)<meta\s+[^>]*name=["'']description["''][^>]*content=["'']([^"'']*)', 1), '') AS description, nullif(regexp_extract(html, '(?is)<meta\s+[^>]*name=["'']keywords["''][^>]*content=["'']([^"'']*)', 1), '') AS keywords FROM pages""")
def html_language(s, d):
    return markup.page_metadata(view(s, d, "pages")).select("page_id", "lang", "description", "keywords")


@query()
def html_metadata(s, d):
    return markup.page_metadata(view(s, d, "pages"))


@query()
def canonical_urls(s, d):
    return view(s, d, "pages").select("page_id", scalars.canonical_url()("url").alias("url"), scalars.canonical_url("landing")("url").alias("landing"), scalars.canonical_host(F.col("url")).alias("host"))


@query("SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)', 1)) AS host FROM pages")
def canonical_hosts(s, d):
    return view(s, d, "pages").select("page_id", scalars.canonical_host(F.col("url")).alias("host"))


@query("SELECT doc_id FROM documents WHERE NOT (n_chars > 200 AND lang IN ('en', 'de')) OR n_chars IS NULL")
def quarantine(s, d):
    _, bad = documents.validated(view(s, d, "documents"), {"length": F.col("n_chars") > 200, "lang": F.col("lang").isin("en", "de")})
    return bad.select("doc_id")


@query("SELECT count(*) FILTER (chunk) AS without_vector, count(*) FILTER (NOT chunk) AS without_chunk FROM (SELECT true AS chunk FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings) UNION ALL SELECT false FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM documents))")
def vector_coverage(s, d):
    c, v = view(s, d, "documents").select(F.col("doc_id").alias("uuid")), view(s, d, "embeddings").select(F.col("vec_id").alias("uuid"))
    p = documents.pairing(c, v)
    return p.agg(F.count_if(F.col("problem") == "no vector").alias("without_vector"), F.count_if(F.col("problem") == "no chunk").alias("without_chunk"))


@query("SELECT round(avg(n), 6) AS mean_nonzero, round(1 - sum(n) / sum(k)::DOUBLE, 6) AS zero_share, count(*) FILTER (n = 0) AS empty_rows FROM (SELECT len(list_filter(embedding, lambda x: x > 0)) AS n, len(embedding) AS k FROM embeddings)")
def weight_sparsity(s, d):
    x = documents.sparsity(view(s, d, "embeddings"), "embedding")
    return x.select(F.round("mean_nonzero", 6).alias("mean_nonzero"), F.round("zero_share", 6).alias("zero_share"), "empty_rows")


@query("SELECT doc_id, CAST(ceil(log2(greatest(n_chars, 1)::DOUBLE)) AS INTEGER) AS bucket, (row_number() OVER (PARTITION BY ceil(log2(greatest(n_chars, 1)::DOUBLE)) ORDER BY doc_id) - 1) // 32 AS batch FROM documents")
def length_batches(s, d):
    return documents.batches(view(s, d, "documents"), "n_chars", 32, "doc_id").select("doc_id", "bucket", "batch")


@query("SELECT doc_id, CAST(('0x' || substr(sha256(CAST(doc_id AS STRING)), 1, 16))::UBIGINT % 16 AS INTEGER) AS shard FROM documents")
def hash_shards(s, d):
    return view(s, d, "documents").select("doc_id", scalars.stable_shard(F.col("doc_id").cast("string"), 16).alias("shard"))


@query("SELECT relpath, size_bytes, file_id FROM (SELECT *, row_number() OVER (PARTITION BY relpath ORDER BY CAST(substr(file_id, 2) AS BIGINT)) AS r FROM @files) WHERE r = 1")
def first_per_path(s, d):
    f = view(s, d, "files").withColumn("seq", F.substring("file_id", 2, 20).cast("long"))
    return documents.one_per_path(f).select("relpath", "size_bytes", "file_id")


# --- generic SQL that comes with the engine


@query("SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS qty, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube_lineitem(s, d):
    return view(s, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").cast("long").alias("qty"), F.count(F.lit(1)).alias("n"))


@query("SELECT s_nationkey AS nation FROM supplier INTERSECT SELECT c_nationkey FROM customer")
def intersect_nations(s, d):
    return view(s, d, "supplier").select(F.col("s_nationkey").alias("nation")).intersect(view(s, d, "customer").select("c_nationkey"))


@query("SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders")
def except_customers(s, d):
    return view(s, d, "customer").select(F.col("c_custkey").alias("id")).exceptAll(view(s, d, "orders").select("o_custkey").distinct())


@query("SELECT e.event_id, max(p.ts) AS last_purchase FROM events e JOIN events p ON p.user_id = e.user_id AND p.event_type = 'purchase' AND p.ts <= e.ts WHERE e.event_type = 'error' GROUP BY e.event_id")
def as_of_purchase(s, d):
    e = view(s, d, "events")
    bought = e.where("event_type = 'purchase'").select("user_id", "ts", F.col("ts").alias("last_purchase"))
    return frames.as_of(e.where("event_type = 'error'").select("event_id", "user_id", "ts"), bought, ["user_id"], "ts", ["last_purchase"]).where("last_purchase is not null").select("event_id", "last_purchase")


@query("""WITH m AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '6' HOUR THEN 0 ELSE 1 END AS new FROM events), g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM m)
  SELECT user_id, count(*) AS n, min(ts) AS start FROM g GROUP BY user_id, k""")
def sessions(s, d):
    e = view(s, d, "events")
    return e.groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count(F.lit(1)).alias("n")).select("user_id", "n", F.col("w.start").alias("start"))


@query("SELECT host, time_bucket(INTERVAL '1' HOUR, ts) AS start, count(*) AS calls, count(*) FILTER (from_cache) AS cached FROM @http GROUP BY 1, 2")
def hourly_indicators(s, d):
    g = streams.sliding_indicators(view(s, d, "http"), "1 hour", "1 hour", "1 hour")
    return g.select("host", F.col("window.start").alias("start"), "calls", "cached")


@query("SELECT host, n AS longest_streak, round(x, 4) AS retry_after_s FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY n DESC, x DESC) AS r FROM (SELECT host, k, count(*) AS n, avg(retry_after_s) AS x FROM (SELECT host, status, retry_after_s, sum(CASE WHEN status <> 429 THEN 1 ELSE 0 END) OVER (PARTITION BY host ORDER BY ts, event_id) AS k FROM @http) WHERE status = 429 GROUP BY host, k)) WHERE r = 1")
def limit_streaks(s, d):
    return telemetry.limit_streaks(view(s, d, "http"))


@query("""WITH h AS (SELECT * FROM @http WHERE ts >= TIMESTAMP '2024-01-15') SELECT host, count(*) AS n, min(elapsed_ms) AS min, max(elapsed_ms) AS max, round(avg(elapsed_ms), 6) AS avg,
  list_sort(list(elapsed_ms))[CAST(floor(count(*) * 0.5) AS BIGINT) + 1] AS p50, list_sort(list(elapsed_ms))[CAST(floor(count(*) * 0.95) AS BIGINT) + 1] AS p95, list_sort(list(elapsed_ms))[CAST(floor(count(*) * 0.99) AS BIGINT) + 1] AS p99 FROM h GROUP BY host""")
def metric_summary(s, d):
    return telemetry.metric_summary(view(s, d, "http"), "host", "elapsed_ms", "2024-01-15")


@query("SELECT job_id, created_at FROM @jobs WHERE available_at IS NULL OR available_at >= TIMESTAMP '1998-01-01'")
def plans_since(s, d):
    return catalog.since(view(s, d, "jobs"), "1998-01-01", "available_at").select("job_id", "created_at")


@query("SELECT source, count(*) AS chunks, count(DISTINCT doc_id) AS documents FROM documents GROUP BY source UNION ALL SELECT NULL, count(*), count(DISTINCT doc_id) FROM documents")
def namespace_stats(s, d):
    return retrieval.namespace_stats(view(s, d, "documents"), "source")


@query("SELECT DISTINCT source AS s, lang AS p, CAST(n_chars % 7 AS STRING) AS o FROM documents")
def canonical_triples(s, d):
    return catalog.canonical_triples(view(s, d, "documents").select(F.col("source").alias("s"), F.col("lang").alias("p"), (F.col("n_chars") % 7).cast("string").alias("o")))


@query()
def probe_search(s, d):
    v = view(s, d, "embeddings")
    c, rows = retrieval.partition_vectors(v)
    asked = v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return retrieval.probe_search(asked, c, rows, 10, 12)


@query()
def hash_embeddings(s, d):
    return view(s, d, "documents").select("doc_id", retrieval.hash_embedding()(ascii_tokens()).alias("vec"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hybrid retrieval of the benchmark's items over the documents."""
    return hybrid_search(spark, sf_dir)


from . import more, stored  # noqa: E402, F401  their queries register here, too
