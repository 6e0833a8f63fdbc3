"""Operator inputs as views of the driver's tables, in SQL that Spark and DuckDB both run. @name stands for a table or another view."""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "obs": """
      SELECT event_id, concat('run-', CAST(user_id % 12 AS STRING)) AS run_id, ts,
             CASE event_type WHEN 'view' THEN 'net.request' WHEN 'click' THEN 'ratelimit.acquire' WHEN 'signup' THEN 'ratelimit.cooldown' WHEN 'error' THEN 'fetch.error' ELSE 'extract.done' END AS type,
             CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level, concat('svc-', CAST(user_id % 5 AS STRING)) AS service,
             concat('{"elapsed_ms":', CAST(CAST(round(value * 10) AS BIGINT) AS STRING), ',"cache":"', CASE event_id % 4 WHEN 0 THEN 'hit' WHEN 1 THEN 'revalidated' ELSE 'miss' END,
                    '","key":"key-', CAST(user_id % 30 AS STRING), '","allowed":', CASE WHEN event_id % 3 = 0 THEN 'false' ELSE 'true' END, ',"blocked_ms":', CAST(CAST(round(value) AS BIGINT) AS STRING),
                    ',"status_code":', CASE WHEN event_id % 2 = 0 THEN '429' ELSE '503' END, ',"cooldown_ms":', CAST(event_id % 5000 AS STRING), ',"cooldown_sec":', CAST(event_id % 50 AS STRING),
                    ',"error_code":"E', CAST(event_id % 6 AS STRING), '","entries_total":', CAST(event_id % 1200 AS STRING), ',"entries_included":', CAST(event_id % 40 AS STRING),
                    ',"bytes_written":', CAST(event_id % 900 AS STRING), ',"duration_ms":', CAST(event_id % 70 AS STRING), '}') AS payload
      FROM @events""",
    "http": """
      SELECT event_id, concat('run-', CAST(user_id % 12 AS STRING)) AS run_id, ts, concat('h', CAST(user_id % 9 AS STRING)) AS host,
             CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 429 WHEN event_type = 'error' THEN 503 ELSE 200 END AS status, event_id % 4 = 0 AS from_cache,
             CAST(round(value) AS BIGINT) AS rate_delay_ms, CASE WHEN event_type = 'error' THEN CAST(event_id % 1000 AS DOUBLE) END AS retry_after_s, CAST(round(value * 10) AS BIGINT) AS elapsed_ms
      FROM @events""",
    "attempts": """
      SELECT event_id, concat('run-', CAST(user_id % 12 AS STRING)) AS run_id, ts, user_id AS work_id, event_id % 3 AS tier, concat('s', CAST(event_id % 7 AS STRING)) AS source,
             CASE WHEN event_type IN ('purchase', 'signup') THEN 'success' ELSE 'fail' END AS outcome, event_type AS reason, CASE WHEN event_id % 11 = 0 THEN 0 ELSE CAST(round(value * 10) AS BIGINT) END AS elapsed_ms
      FROM @events""",
    "transitions": """
      SELECT event_id, ts, concat('h', CAST(user_id % 9 AS STRING)) AS host, CASE event_id % 3 WHEN 0 THEN 'CLOSED' WHEN 1 THEN 'OPEN' ELSE 'HALF_OPEN' END AS old_state,
             CASE event_id % 3 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'HALF_OPEN' ELSE 'CLOSED' END AS new_state
      FROM @events WHERE event_type = 'error'""",
    "rate": """
      SELECT event_id, ts, concat('h', CAST(user_id % 9 AS STRING)) AS host, CASE WHEN event_id % 2 = 0 THEN 'metadata' ELSE 'artifact' END AS role, CASE WHEN event_type = 'error' THEN 'block' ELSE 'acquire' END AS action,
             CAST(round(value) AS BIGINT) AS delay_ms, concat('b', CAST(event_id % 4 AS STRING)) AS backend FROM @events""",
    "gates": """
      SELECT event_type AS gate, user_id % 4 <> 0 AS passed, CAST(round(value * 10) AS BIGINT) AS elapsed_ms FROM @events""",
    "jobs": """
      SELECT o_orderkey AS job_id, CASE o_orderstatus WHEN 'F' THEN 'FINALIZED' WHEN 'O' THEN 'QUEUED' ELSE 'LEASED' END AS state, o_orderpriority AS kind, o_orderdate AS created_at,
             o_orderdate + (o_orderkey % 1000) * INTERVAL '1' SECOND AS updated_at, o_orderdate + (o_orderkey % 50) * INTERVAL '1' DAY AS lease_until, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL '2' DAY END AS available_at
      FROM @orders""",
    "ops": "SELECT l_orderkey AS job_id, CASE WHEN l_linenumber > 4 THEN 'again' ELSE l_returnflag END AS kind, l_shipdate AS started_at FROM @lineitem",
    "versions": """
      SELECT concat('v', CAST(n_nationkey AS STRING)) AS version_id, concat('s', CAST(n_regionkey AS STRING)) AS service, TIMESTAMP '2024-01-01 00:00:00' + n_nationkey * INTERVAL '1' DAY AS created_at, n_name AS plan_hash FROM @nation""",
    "artifacts": """
      SELECT concat('a', CAST(s_suppkey AS STRING)) AS artifact_id, concat('v', CAST(s_nationkey AS STRING)) AS version_id, CAST(round(s_acctbal * 100) AS BIGINT) AS size_bytes,
             CASE s_suppkey % 3 WHEN 0 THEN 'fresh' WHEN 1 THEN 'cached' ELSE 'failed' END AS status, concat('p/', CAST(s_suppkey AS STRING)) AS fs_relpath FROM @supplier""",
    "files": """
      SELECT concat('f', CAST(doc_id AS STRING)) AS file_id, concat('a', CAST(doc_id % 120 AS STRING)) AS artifact_id, concat('v', CAST(doc_id % 23 AS STRING)) AS version_id, concat('d/', CAST(doc_id % 40 AS STRING)) AS relpath,
             CASE WHEN lang = 'es' THEN NULL ELSE lang END AS format, n_chars AS size_bytes, concat('cas/', CAST(doc_id % 700 AS STRING)) AS cas_relpath FROM @documents""",
    "validations": """
      SELECT concat('x', CAST(doc_id AS STRING)) AS validation_id, concat('f', CAST(doc_id AS STRING)) AS file_id, CASE WHEN doc_id % 2 = 0 THEN 'quality' ELSE 'shape' END AS validator, quality = 1 AS passed,
             TIMESTAMP '2024-02-01 00:00:00' + (doc_id % 300) * INTERVAL '1' HOUR AS run_at FROM @labels""",
    "listing": "SELECT concat('cas/', CAST(doc_id % 900 AS STRING)) AS relpath, max(n_chars) AS size_bytes FROM @documents GROUP BY 1",
    "store": """
      SELECT doc_id AS id, doc_id % 500 AS artifact_id, source AS resolver, CASE WHEN doc_id % 50 = 0 THEN NULL ELSE md5(text) END AS sha256, n_chars AS bytes, lang AS content_type,
             TIMESTAMP '2023-01-01 00:00:00' + (doc_id % 400) * INTERVAL '1' DAY AS created_at FROM @documents""",
    "manifest": """
      SELECT event_id AS seq, user_id AS item_id, CASE WHEN event_type = 'error' THEN 'failure' WHEN event_type = 'view' THEN 'skip' ELSE 'success' END AS status, concat('h', CAST(event_id % 3 AS STRING)) AS input_hash FROM @events""",
    "work": "SELECT c_custkey AS item_id, concat('h', CAST(c_custkey % 3 AS STRING)) AS input_hash, c_custkey % 5 <> 0 AS output_exists FROM @customer",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or a table itself."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    mark = f"{zlib.crc32(sf_dir.encode()):08x}"

    def temp(m: re.Match) -> str:
        view(spark, sf_dir, m[1]).createOrReplaceTempView(f"lodestone_{m[1]}_{mark}")
        return f"lodestone_{m[1]}_{mark}"

    return spark.sql(re.sub(r"@(\w+)", temp, VIEWS[name]))


def with_views(sql: str) -> str:
    """DuckDB SQL with the views that it names (as @name) in front."""
    done: dict[str, str] = {}

    def need(text: str) -> str:
        def one(m: re.Match) -> str:
            if m[1] in VIEWS and m[1] not in done:
                done[m[1]] = need(VIEWS[m[1]])
            return f"v_{m[1]}" if m[1] in VIEWS else m[1]

        return re.sub(r"@(\w+)", one, text)

    body = need(sql)
    if not done:
        return body
    ctes = ", ".join(f"v_{k} AS ({v})" for k, v in done.items())
    own = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", body, re.IGNORECASE)
    return f"WITH {own[1] or ''}{ctes}, {body[own.end():]}" if own else f"WITH {ctes} {body}"
