"""More registered queries: state of pipelines, readers and writers, evaluation, index lifecycle, scalar rules."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import percentiles, scalars
from ..operators import catalog, dedup, documents, evaluation, lifecycle, retrieval, telemetry, vector_index
from ..sources import datasets, readers
from ..sources.shared import fresh_dir
from .catalogue import _COS, query, view


_folder = fresh_dir


# --- percentile and scalar rules


@query("""SELECT host, list_sort(list(elapsed_ms))[CAST(floor((count(*) - 1) * 0.95) AS BIGINT) + 1] AS p95 FROM @http GROUP BY host""")
def index_span_p95(s, d):
    return percentiles.by_index(view(s, d, "http"), ["host"], "elapsed_ms", {"p95": 0.95}, "index_span")


@query("""SELECT host, round(quantile_cont(elapsed_ms, 0.99), 6) AS p99 FROM @http GROUP BY host""")
def inclusive_p99(s, d):
    return percentiles.by_index(view(s, d, "http"), ["host"], "elapsed_ms", {"p99": 0.99}, "inclusive").select("host", F.round("p99", 6).alias("p99"))


@query("""SELECT event_id, date_trunc('second', ts) AS http_date, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day FROM events""")
def parsed_instants(s, d):
    e = view(s, d, "events")
    text = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    return e.select("event_id", scalars.parse_instant(text).cast("timestamp_ntz").alias("http_date"), scalars.parse_instant(F.date_format("ts", "yyyyMMdd")).cast("timestamp_ntz").alias("day"))


@query(r"""SELECT page_id, name, CASE WHEN c = '' THEN 'file' ELSE substr(c, 1, 255) END AS safe FROM (SELECT page_id, name, regexp_replace(regexp_replace(name, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g') AS c
  FROM (SELECT page_id, nullif(regexp_extract(url, '^[^?#]*/([^/?#]+)(?:[?#].*)?$', 1), '') AS name FROM pages))""")
def file_names(s, d):
    p = view(s, d, "pages").select("page_id", scalars.basename_from_url(F.col("url")).alias("name"))
    return p.select("page_id", "name", scalars.safe_filename(F.col("name")).alias("safe"))


@query("""SELECT artifact_id, sha256('{"artifact":"' || artifact_id || '","bytes":' || size_bytes || ',"status":"' || status || '"}') AS key FROM @artifacts""")
def idempotency_keys(s, d):
    return view(s, d, "artifacts").select("artifact_id", scalars.idempotency_key({"status": F.col("status"), "artifact": F.col("artifact_id"), "bytes": F.col("size_bytes")}).alias("key"))


@query("""SELECT file_id, CASE size_bytes % 12 WHEN 0 THEN 'CC-BY-4.0' WHEN 1 THEN 'CC BY-NC 4.0' WHEN 2 THEN 'CC-BY-ND-4.0' WHEN 3 THEN 'CC0-1.0' WHEN 4 THEN 'CC0-1.0' WHEN 5 THEN 'Apache-2.0' WHEN 6 THEN 'Apache-2.0' WHEN 7 THEN 'MIT License'
  WHEN 8 THEN 'CC-BY-SA-3.0' WHEN 9 THEN 'CC-BY-4.0' WHEN 10 THEN NULL END AS licence FROM @files""")
def licences(s, d):
    raw = ["cc by", "CC  BY-NC 4.0", "cc-by-nd-4.0", "Creative Commons Zero", "Public Domain", "apache license 2.0", " Apache ", "MIT  License", "cc-by-sa-3.0", "Creative Commons Attribution 4.0", "  "]
    pick = F.element_at(F.array(*(F.lit(x) for x in raw), F.lit(None)), (F.col("size_bytes") % 12 + 1).cast("int"))
    return view(s, d, "files").select("file_id", scalars.spdx(pick).alias("licence"))


@query("""SELECT file_id, s[1:2] || '/' || s[3:4] || '/' || s AS path, CASE WHEN size_bytes >= 1024 THEN printf('%.2f KB', size_bytes / 1024.0) ELSE size_bytes || ' B' END AS size FROM (SELECT file_id, size_bytes, sha256(file_id) AS s FROM @files)""")
def store_paths(s, d):
    f = view(s, d, "files")
    return f.select("file_id", F.substring(scalars.cas_path(F.sha2("file_id", 256)), 8, 100).alias("path"), scalars.human_bytes("size_bytes").alias("size"))


@query("""SELECT doc_id, nullif(trim(split_part(text, chr(10), 1)), NULL) AS title, substr(text, 1, 500) AS preview FROM (SELECT doc_id, text FROM documents) WHERE length(trim(split_part(text, chr(10), 1))) < 200
  UNION ALL SELECT doc_id, NULL, substr(text, 1, 500) FROM documents WHERE NOT coalesce(length(trim(split_part(text, chr(10), 1))) < 200, false)""")
def text_metadata(s, d):
    return documents.text_metadata(view(s, d, "documents"))


@query("""SELECT event_id, payload->>'$.key' AS title, payload->>'$.error_code' AS description FROM (SELECT event_id, payload FROM @obs)""")
def json_metadata(s, d):
    o = view(s, d, "obs").select("event_id", F.regexp_replace(F.regexp_replace("payload", '"key":', '"name":'), '"error_code":', '"description":').alias("body"))
    return documents.json_metadata(o, "event_id", "body").select("event_id", "title", "description")


@query(r"""WITH b AS (SELECT page_id, html, regexp_replace(regexp_replace(html, '<script\b.*?</script>', '', 'gis'), '<style\b.*?</style>', '', 'gis') AS balanced FROM pages),
  x AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(balanced, '<iframe\b.*?</iframe>', '', 'gis'), '<link\b[^>]*rel=\s*[''"]?stylesheet[^>]*>', '', 'gi'), '<meta\b[^>]*>', '', 'gi'), '<!--.*?-->', '', 'gs') AS most FROM b),
  s AS (SELECT *, regexp_replace(most, '\s+on[a-zA-Z]+\s*=\s*(".*?"|''[^'']*''|[^\s>]+)', '', 'gi') AS strict FROM x)
  SELECT page_id, sha256(html) AS permissive, sha256(balanced) AS balanced, sha256(strict) AS strict, CAST(length(strict) AS INTEGER) AS n FROM s""")
def sanitised_pages(s, d):
    clean = {p: documents.sanitised("html", p) for p in documents.PROFILES}
    return view(s, d, "pages").select("page_id", *(F.sha2(c, 256).alias(p) for p, c in clean.items()), F.length(clean["strict"]).alias("n"))


@query("""SELECT doc_id, 'r' || (doc_id % 3) AS refs, CASE WHEN doc_id % 5 = 0 THEN '1' ELSE '1,' || (doc_id % 5 + 1) END AS pages FROM documents""")
def refs_and_pages(s, d):
    item = lambda r, p: F.struct(r.alias("ref"), F.array(*(x.cast("string") for x in p)).alias("pages"))
    ref = F.concat(F.lit("r"), (F.col("doc_id") % 3).cast("string"))
    items = F.array(item(ref, [F.col("doc_id") % 5 + 1, F.lit("x"), F.lit(0)]), item(ref, [F.lit(1), F.lit(-4)]), item(F.lit(None).cast("string"), []))
    rows = view(s, d, "documents").select("doc_id", F.lit(0).alias("chunk"), items.alias("items"))
    return documents.refs_and_pages(rows).select("doc_id", F.array_join("refs", ",").alias("refs"), F.array_join("pages", ",").alias("pages"))


@query("""SELECT folded, count(DISTINCT relpath) AS n FROM (SELECT lower(relpath) AS folded, relpath FROM (SELECT CASE WHEN size_bytes % 2 = 0 THEN upper(relpath) ELSE relpath END AS relpath FROM @files)) GROUP BY folded HAVING count(DISTINCT relpath) > 1""")
def case_collisions(s, d):
    return documents.case_collisions(view(s, d, "files").select(F.when(F.col("size_bytes") % 2 == 0, F.upper("relpath")).otherwise(F.col("relpath")).alias("relpath")))


@query("""SELECT version_id, created_at AS at FROM @versions WHERE created_at >= TIMESTAMP '2024-01-10' UNION ALL SELECT version_id, NULL FROM @versions WHERE created_at < TIMESTAMP '2024-01-10'""")
def version_listing(s, d):
    v = view(s, d, "versions").withColumn("mtime", F.when(F.col("created_at") >= F.lit("2024-01-10").cast("timestamp"), F.col("created_at"))).withColumn("downloaded_at", F.lit(None).cast("timestamp")).withColumn("last_modified", F.lit(None).cast("timestamp"))
    return catalog.version_listing(v).select("version_id", F.col("at").cast("timestamp_ntz").alias("at"))


@query("SELECT doc_id AS path, doc_id % 7 <> 0 AS matches FROM documents WHERE text IS NOT NULL")
def verified_contents(s, d):
    t = view(s, d, "documents").where("text is not null")
    wrong = F.when(F.col("doc_id") % 7 == 0, F.lit("no digest")).otherwise(F.sha2("text", 256))
    return dedup.verify(t.select(F.col("doc_id").alias("path"), F.col("text").alias("content"), wrong.alias("sha256")))


@query("""SELECT query_id, doc_id, channel FROM (SELECT *, row_number() OVER (PARTITION BY query_id, doc_id ORDER BY o) AS r FROM (
  SELECT doc_id % 11 AS query_id, doc_id % 97 AS doc_id, CASE doc_id % 3 WHEN 0 THEN 'dense' WHEN 1 THEN 'splade' ELSE 'bm25' END AS channel, CASE doc_id % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS o FROM documents)) WHERE r = 1""")
def deduped_candidates(s, d):
    channel = F.element_at(F.array(F.lit("dense"), F.lit("splade"), F.lit("bm25")), (F.col("doc_id") % 3 + 1).cast("int"))
    rows = view(s, d, "documents").select((F.col("doc_id") % 11).alias("query_id"), (F.col("doc_id") % 97).alias("doc_id"), channel.alias("channel"))
    return retrieval.dedupe_candidates(rows)


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS qty FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())""")
def grouping_sets(s, d):
    view(s, d, "lineitem").createOrReplaceTempView("lodestone_lineitem")
    return s.sql("SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS qty FROM lodestone_lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")


@query("""SELECT c_custkey, CAST(rank() OVER w AS INTEGER) AS rank, CAST(dense_rank() OVER w AS INTEGER) AS dense, CAST(ntile(4) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS INTEGER) AS quarter,
  lag(c_custkey) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS before, lead(c_custkey, 2) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS after FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_mktsegment)""")
def window_functions(s, d):
    from pyspark.sql import Window

    by, key = Window.partitionBy("c_nationkey").orderBy("c_mktsegment"), Window.partitionBy("c_nationkey").orderBy("c_custkey")
    return view(s, d, "customer").select("c_custkey", F.rank().over(by).alias("rank"), F.dense_rank().over(by).alias("dense"), F.ntile(4).over(key).alias("quarter"), F.lag("c_custkey").over(key).alias("before"), F.lead("c_custkey", 2).over(key).alias("after"))


@query("SELECT source, true AS close FROM documents GROUP BY source")
def approx_documents(s, d):
    g = view(s, d, "documents").groupBy("source").agg(F.approx_count_distinct("doc_id", 0.02).alias("a"), F.count_distinct("doc_id").alias("n"))
    return g.select("source", (F.abs(F.col("a") - F.col("n")) <= 0.1 * F.col("n")).alias("close"))


# --- state


def _plans(s, d, where: str):
    return view(s, d, "orders").where(where).select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("plan_id"), F.col("o_orderdate").alias("cached_at"), F.col("o_orderpriority").alias("resolver"))


@query("""SELECT id, plan_id, resolver FROM (SELECT o_custkey AS id, o_orderkey AS plan_id, o_orderpriority AS resolver, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1 AND resolver = '1-URGENT'""")
def cached_plans(s, d):
    kept = lifecycle.cache_plan(_plans(s, d, "o_orderkey % 2 = 0"), _plans(s, d, "o_orderkey % 2 = 1"))
    return lifecycle.cached_plan(kept, resolver="1-URGENT").select("id", "plan_id", "resolver")


@query("""SELECT id, plan_id, CAST(r AS INTEGER) AS back FROM (SELECT o_custkey AS id, o_orderkey AS plan_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) - 1 AS r FROM orders) WHERE r < 3""")
def plan_history(s, d):
    p = _plans(s, d, "true").withColumn("at", F.struct("cached_at", "plan_id"))
    return lifecycle.plan_history(p, "id", "at", 3).select("id", "plan_id", "back")


@query("""SELECT 'o' || o_orderkey AS id, '{"id":"o' || o_orderkey || '","resolver":"' || o_orderpriority || '"' || CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE ',"version":"v' || (o_orderkey % 9) || '"' END || '}' AS entry, 'o' || o_orderkey AS again FROM orders""")
def lock_entries(s, d):
    o = view(s, d, "orders").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("id"), F.col("o_orderpriority").alias("resolver"), F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.lit("v"), (F.col("o_orderkey") % 9).cast("string"))).alias("version"))
    rows = lifecycle.lock_rows(o)
    return rows.join(lifecycle.from_lock(rows).select("id", F.col("id").alias("again")), "id")


@query("""SELECT * FROM (VALUES ('extra', 'missing', 'double', NULL), ('lang', 'type', 'int', 'string'), ('n_chars', 'added', NULL, 'bigint'), ('source', 'added', NULL, 'string')) t("column", change, expected, found)""")
def schema_drift(s, d):
    want = T.StructType().add("doc_id", "long").add("text", "string").add("lang", "integer").add("extra", "double")
    return lifecycle.drift_table(view(s, d, "documents").select("doc_id", "text", "lang", "source", "n_chars"), want)


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN upper(c_mktsegment) || '!' WHEN c_custkey % 3 = 1 THEN c_mktsegment || '!' ELSE c_mktsegment END AS segment, CASE WHEN c_custkey % 3 = 2 THEN 5 ELSE 2 END AS schema_version FROM (SELECT c_custkey, lower(c_mktsegment) AS c_mktsegment FROM customer)""")
def migrated_rows(s, d):
    c = view(s, d, "customer").select("c_custkey", F.lower("c_mktsegment").alias("segment"), F.when(F.col("c_custkey") % 3 == 1, 1).when(F.col("c_custkey") % 3 == 2, 5).alias("schema_version"))
    return lifecycle.migrate(c, [(2, lambda x: x.withColumn("segment", F.concat("segment", F.lit("!")))), (1, lambda x: x.withColumn("segment", F.upper("segment")))])


@query("""SELECT item_id, seq, status FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY seq DESC) AS r FROM @manifest) WHERE r = 1""")
def compacted_manifest(s, d):
    return lifecycle.compacted(view(s, d, "manifest"), "item_id", "seq").select("item_id", "seq", "status")


@query("SELECT seq, (row_number() OVER (ORDER BY seq) - 1) // 500 AS part FROM @manifest")
def rotated_manifest(s, d):
    return lifecycle.rotate(view(s, d, "manifest"), 500).select("seq", "part")


@query("""SELECT url, page_id FROM (SELECT url, page_id, row_number() OVER (PARTITION BY url ORDER BY page_id DESC) AS r FROM (SELECT regexp_replace(url, '[0-9]+', '0', 'g') AS url, page_id FROM pages) WHERE page_id % 5 <> 0) WHERE r = 1 AND page_id % 3 <> 1""")
def url_index(s, d):
    p = view(s, d, "pages").select(F.regexp_replace("url", "[0-9]+", "0").alias("canonical_url"), "page_id", F.when(F.col("page_id") % 5 == 0, "failure").otherwise("success").alias("status"), F.col("page_id").cast("string").alias("path"))
    there = p.where("page_id % 3 <> 1").select("path")
    return lifecycle.url_index(p, order="page_id", existing=there).select(F.col("canonical_url").alias("url"), "page_id")


@query("""SELECT stage, count(*) AS attempts, count(*) FILTER (status = 'success') AS succeeded, count(*) FILTER (status = 'skip') AS skipped, count(*) FILTER (status = 'failure') AS failed, round(count(*) FILTER (status = 'failure') / count(*)::DOUBLE, 6) AS failed_share,
  round(sum(seq % 10) / 4.0::DOUBLE, 6) AS seconds FROM (SELECT input_hash AS stage, status, seq FROM @manifest) GROUP BY stage""")
def stage_attempts(s, d):
    return lifecycle.stage_attempts(view(s, d, "manifest").select(F.col("input_hash").alias("stage"), "status", ((F.col("seq") % 10) / 4).alias("duration_s")))


@query("""SELECT f AS file, coalesce(n, 0) AS rows, coalesce(b, 0) AS broken, coalesce(b > 0, false) AS quarantined, n IS NULL AS missing FROM (SELECT unnest(['src0', 'src1', 'src2', 'srcX']) AS f) LEFT JOIN
  (SELECT source, count(*) AS n, count(*) FILTER (NOT coalesce(n_chars > 50 AND lang <> 'fr', false)) AS b FROM documents GROUP BY source) ON f = source""")
def chunk_file_stats(s, d):
    files = s.createDataFrame([(x,) for x in ("src0", "src1", "src2", "srcX")], "file string")
    return lifecycle.chunk_file_stats(view(s, d, "documents").withColumnRenamed("source", "file"), {"long": F.col("n_chars") > 50, "lang": F.col("lang") != "fr"}, files)


_SNAPS = "SELECT host, start, CAST(CASE WHEN epoch(start)::BIGINT // 3600 % 50 = 0 THEN 0 ELSE sum(n) OVER (PARTITION BY host ORDER BY start) END AS BIGINT) AS total FROM (SELECT host, date_trunc('hour', ts) AS start, count(*) AS n FROM @http GROUP BY 1, 2)"


def _snapshots(s, d):
    from pyspark.sql import Window

    h = view(s, d, "http").groupBy("host", F.date_trunc("hour", "ts").alias("start")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("host").orderBy("start"))
    return h.withColumn("total", F.when(F.expr("unix_timestamp(cast(start as timestamp)) div 3600") % 50 == 0, F.lit(0)).otherwise(total)).drop("n")


@query(f"WITH c AS ({_SNAPS}) SELECT host, start, CASE WHEN b IS NULL OR total < b THEN total ELSE total - b END AS added FROM (SELECT *, lag(total) OVER (PARTITION BY host ORDER BY start) AS b FROM c)")
def counter_increments(s, d):
    return lifecycle.increments(_snapshots(s, d), ["host"], "start", "total").select("host", "start", "added")


@query("""SELECT a.host AS host, a.n - coalesce(b.n, 0) AS calls FROM (SELECT host, count(*) AS n FROM @http GROUP BY host) a LEFT JOIN (SELECT host, count(*) AS n FROM @http WHERE ts < TIMESTAMP '2024-01-20' AND host <> 'h3' GROUP BY host) b ON a.host = b.host""")
def live_delta(s, d):
    h = view(s, d, "http")
    n = lambda x: x.groupBy("host").agg(F.count(F.lit(1)).alias("calls"))
    return lifecycle.since_last(n(h), n(h.where("ts < timestamp '2024-01-20' and host <> 'h3'")), ["host"], ["calls"])


@query("""SELECT job_id, n AS attempts, CASE WHEN n >= 3 THEN 'ERROR' ELSE 'QUEUED' END AS state, CASE WHEN n < 3 THEN TIMESTAMP '1998-01-01' + CASE n WHEN 1 THEN INTERVAL '60' SECOND ELSE INTERVAL '120' SECOND END END AS available_at FROM (SELECT job_id, job_id % 4 + 1 AS n FROM @jobs)""")
def failed_jobs(s, d):
    j = view(s, d, "jobs").withColumn("attempts", F.col("job_id") % 4)
    return lifecycle.after_failure(j, "1998-01-01", 3).select("job_id", "attempts", "state", F.col("available_at").cast("timestamp_ntz").alias("available_at"))


@query("""SELECT job_id, CASE WHEN job_id % 3 = 0 THEN lease_until WHEN job_id % 3 = 1 THEN lease_until + INTERVAL '300' SECOND ELSE lease_until END AS lease_until FROM @jobs""")
def renewed_leases(s, d):
    j = view(s, d, "jobs").withColumn("worker", F.lit("w1"))
    kind = F.col("job_id") % 3
    beats = j.where(kind > 0).select("job_id", F.when(kind == 1, "w1").otherwise("w2").alias("worker"), F.col("lease_until").alias("ts"))
    late = j.select("job_id", F.lit("w1").alias("worker"), (F.col("lease_until") + F.expr("interval 1 hour")).alias("ts"))
    return lifecycle.heartbeat(j, beats.unionByName(late), 300).select("job_id", F.col("lease_until").cast("timestamp_ntz").alias("lease_until"))


# --- readers and writers


@query("SELECT count(*) AS n FROM documents")
def counted_by_footers(s, d):
    return s.createDataFrame([(readers.count_footers(s, f"{d}/documents.parquet"),)], "n long")


@query("SELECT event_id, ts FROM @attempts WHERE ts > TIMESTAMP '2024-01-20' AND tier = 1 AND source = 's2'")
def telemetry_records(s, d):
    return readers.telemetry_records(view(s, d, "attempts"), "2024-01-20", 1, "s2").select("event_id", "ts")


@query("""SELECT relpath FROM @listing WHERE NOT (regexp_matches(relpath, '^cas/1[0-9]$') OR regexp_matches(relpath, '^(.*/)?2[^/]*$') OR relpath = 'cas/300')""")
def discovered_files(s, d):
    return view(s, d, "listing").where(~readers.ignored("relpath", ("cas/1?", "2*", "300"))).select("relpath")


@query("""SELECT strftime(DATE '2024-01-01' + CAST(doc_id % 90 AS INTEGER), '%Y-%m') AS month, count(*) AS chunks, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents WHERE (doc_id % 90) >= 31 GROUP BY 1""")
def chunk_dataset(s, d):
    """Chunks written by month, read back with the months pruned."""
    root = _folder(s, "chunks")
    rows = view(s, d, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), F.lit(0).cast("long").alias("chunk_id"), F.coalesce("text", F.lit("")).alias("text"), F.col("n_chars").cast("int").alias("tokens"),
        F.struct(F.lit(0).alias("start"), F.col("n_chars").cast("int").alias("end")).alias("span"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 90).cast("int")).cast("timestamp").alias("created_at"),
        F.lit("chunks/1.0.0").alias("schema_version"), F.lit(None).cast("string").alias("section"), F.create_map(F.lit("lang"), F.coalesce("lang", F.lit(""))).alias("meta"),
    )
    datasets.write_dataset(rows, root, datasets.CHUNKS, fmt="parquet")
    back = datasets.open_chunks(s, root, where="mm >= 2")
    return back.groupBy(F.format_string("%04d-%02d", F.col("yyyy").cast("int"), F.col("mm").cast("int")).alias("month")).agg(F.count(F.lit(1)).alias("chunks"), F.sum("tokens").cast("long").alias("chars"))


@query("SELECT role, count(*) AS n, count(DISTINCT conv_id) AS conversations FROM conversations GROUP BY role")
def jsonl_round_trip(s, d):
    path = _folder(s, "turns") + ".jsonl"
    c = view(s, d, "conversations").select("conv_id", "turn", "role", "text")
    datasets.write_rows(c, path, "json")
    return datasets.read_jsonl(s, path, c.schema).groupBy("role").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("conv_id").alias("conversations"))


@query("SELECT count(*) AS rows, true AS whole FROM customer")
def backed_up(s, d):
    path = _folder(s, "backup")
    said = readers.backup(view(s, d, "customer"), path)
    return readers.recover(s, path, said).agg(F.count(F.lit(1)).alias("rows"), F.lit(True).alias("whole"))


@query("""SELECT 'lodestone_calls{host="' || host || '"} ' || count(*) AS line FROM @http GROUP BY host UNION ALL SELECT 'lodestone_limited{host="' || host || '"} ' || count(*) FILTER (status = 429) FROM @http GROUP BY host""")
def dashboard_lines(s, d):
    g = view(s, d, "http").groupBy("host").agg(F.count(F.lit(1)).alias("calls"), F.count_if(F.col("status") == 429).alias("limited"))
    return readers.dashboard(g, "lodestone", ["host"], "prometheus")


@query("""SELECT 'family=dense/fmt=parquet/yyyy=' || strftime(ts, '%Y') || '/mm=' || strftime(ts, '%m') || '/part-' || event_id || '.parquet' AS path, 'dense' AS family, 'parquet' AS fmt, strftime(ts, '%Y') AS yyyy, strftime(ts, '%m') AS mm FROM events""")
def partition_paths(s, d):
    path = F.concat(F.lit("family=dense/fmt=parquet/yyyy="), F.date_format("ts", "yyyy"), F.lit("/mm="), F.date_format("ts", "MM"), F.lit("/part-"), F.col("event_id").cast("string"), F.lit(".parquet"))
    p = view(s, d, "events").select(path.alias("path"))
    return p.select("path", *(c.alias(n) for n, c in datasets.partition_keys(F.col("path")).items()))


# --- evaluation and index


@query("""SELECT count(*) AS n, count(*) AS hits, 1.0::DOUBLE AS share FROM embeddings WHERE vec_id % 20 = 0""")
def self_hits(s, d):
    v = view(s, d, "embeddings")
    return evaluation.hits_within(retrieval.dense_search(evaluation.sampled(v, 20), v, 10), 10)


@query()
def perturbed_hits(s, d):
    v = view(s, d, "embeddings")
    return evaluation.hits_within(retrieval.dense_search(evaluation.perturbed(evaluation.sampled(v, 20)), v, 3), 3)


@query(f"""WITH h AS (SELECT * FROM (SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, {_COS} AS score FROM embeddings q, embeddings c WHERE q.vec_id % 100 = 0)) WHERE r <= 5)
  SELECT query_id, count(*) AS pairs, round(avg(score), 6) AS mean_cosine, round(max(score), 6) AS max_cosine FROM (SELECT a.query_id AS query_id, {_COS} AS score FROM h a JOIN h b ON a.query_id = b.query_id AND a.r < b.r JOIN embeddings q ON q.vec_id = a.vec_id JOIN embeddings c ON c.vec_id = b.vec_id) GROUP BY query_id""")
def neighbour_likeness(s, d):
    v = view(s, d, "embeddings")
    return evaluation.neighbour_likeness(retrieval.dense_search(evaluation.sampled(v, 100), v, 5), v)


@query(f"""SELECT query_id, vec_id FROM (SELECT query_id, vec_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, {_COS} AS score FROM embeddings q, embeddings c WHERE q.vec_id % 100 = 0)) WHERE r <= 10 AND vec_id % 3 <> query_id % 3""")
def namespace_leaks(s, d):
    v = view(s, d, "embeddings").withColumn("namespace", F.col("vec_id") % 3)
    asked = evaluation.sampled(v, 100)
    found = retrieval.dense_search(asked, v, 10)
    return evaluation.leaks(found, v, asked.select("query_id", (F.col("query_id") % 3).alias("namespace"))).select("query_id", "vec_id")


@query()
def index_search(s, d):
    v = view(s, d, "embeddings")
    codes = vector_index.train(v, parts=16, codes=256)
    # the given vectors have no clusters, so recall asks for most cells; of vectors, each query reads 80
    return vector_index.search(evaluation.sampled(v, 100), vector_index.build(v, codes), codes, probes=-(-3 * len(codes.centres) // 4), refine=8)


@query("SELECT vec_id AS id, CAST(label % 3 AS STRING) AS namespace, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 4) AS total FROM embeddings WHERE label % 3 < 2")
def restored_index(s, d):
    v = view(s, d, "embeddings").withColumn("ns", F.col("label") % 3)
    codes = vector_index.train(v, cells=8, parts=4, codes=16)
    path = _folder(s, "index")
    vector_index.save(vector_index.build(v, codes, namespace="ns"), codes, path)
    rows, _ = vector_index.load(s, path)
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return rows.where("namespace in ('0', '1')").select("id", "namespace", F.round(total, 4).alias("total"))


@query("SELECT vec_id AS id, CAST(len(embedding) AS INTEGER) AS dim, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 4) AS total FROM embeddings WHERE vec_id % 10 = 0 UNION ALL SELECT -1, NULL, NULL")
def reconstructed(s, d):
    v = view(s, d, "embeddings")
    codes = vector_index.train(v, cells=4, parts=4, codes=8)
    ids = v.where("vec_id % 10 = 0").select(F.col("vec_id").alias("id")).unionByName(s.createDataFrame([(-1,)], "id long"))
    r = vector_index.reconstruct(vector_index.build(v, codes), ids)
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return r.select("id", F.when(F.col("vector").isNotNull(), F.size("vector")).alias("dim"), F.round(total, 4).alias("total"))


@query("SELECT doc_id AS id FROM documents WHERE doc_id % 2 = 0 AND doc_id IN (SELECT vec_id FROM embeddings)")
def written_on_both(s, d):
    chunks = view(s, d, "documents").where("doc_id % 2 = 0").select(F.col("doc_id").alias("id"))
    kept, other = vector_index.both_or_neither(chunks, view(s, d, "embeddings").select(F.col("vec_id").alias("id")), "id")
    return kept.join(other.select("id"), "id", "left_semi")


@query("SELECT 'svc-' || (user_id % 5) AS namespace FROM events GROUP BY 1 HAVING epoch(TIMESTAMP '2024-01-31 12:00:00') - floor(epoch(max(ts))) > 40000")
def idle_namespaces(s, d):
    return vector_index.idle_namespaces(view(s, d, "obs").select(F.col("service").alias("namespace"), "ts"), "2024-01-31 12:00:00", 40000).select("namespace")


# --- indicators, triples, commits


@query("""SELECT run_id, round(coalesce(sum(CASE WHEN event_id % 4 < 3 THEN elapsed_ms END), 0) / (1024.0::DOUBLE * 1024.0::DOUBLE), 6) AS dedupe_saved_mb, count(*) FILTER (event_id % 17 = 0 OR event_id % 19 = 0) AS corruption_count FROM @http GROUP BY run_id""")
def download_indicators(s, d):
    k = F.col("event_id")
    rows = view(s, d, "http").select(
        "run_id", F.element_at(F.array(*(F.lit(x) for x in ("hardlink", "copy", "skipped", "none"))), (k % 4 + 1).cast("int")).alias("dedupe_action"), F.col("elapsed_ms").alias("content_length"),
        F.when(k % 17 != 0, "p").alias("final_path"), F.when(k % 19 != 0, "d").alias("sha256"),
    )
    return telemetry.download_indicators(rows)


@query("""WITH a AS (SELECT *, date_trunc('day', ts) AS start, CASE WHEN elapsed_ms > 0 THEN elapsed_ms END AS t FROM @attempts), g AS (SELECT start, count(*) AS attempts, round(count(*) FILTER (outcome = 'success') / count(*)::DOUBLE, 6) AS success_rate, round(avg(t), 4) AS avg_ms, list_sort(list(t) FILTER (t IS NOT NULL)) AS l FROM a GROUP BY start),
  r AS (SELECT start, tier, count(*) FILTER (outcome = 'success') / count(*)::DOUBLE AS r FROM a GROUP BY 1, 2), b AS (SELECT start, tier, r, row_number() OVER (PARTITION BY start ORDER BY r DESC, tier) AS k FROM r)
  SELECT g.start AS start, attempts, success_rate, avg_ms, l[CAST(floor(len(l) * 0.5) AS BIGINT) + 1] AS p50_ms, l[CAST(floor(len(l) * 0.95) AS BIGINT) + 1] AS p95_ms, l[CAST(floor(len(l) * 0.99) AS BIGINT) + 1] AS p99_ms, tier AS top_tier, round(r, 6) AS top_tier_rate FROM g JOIN b ON g.start = b.start AND k = 1""")
def timeseries(s, d):
    return telemetry.timeseries(view(s, d, "attempts"))


@query("""WITH t AS (SELECT DISTINCT CASE WHEN doc_id % 3 = 0 THEN '_:n' || (doc_id * 7 % 50) ELSE source END AS s, lang AS p, CASE WHEN doc_id % 4 = 0 THEN '_:n' || (doc_id * 11 % 50) ELSE 'o' || (n_chars % 5) END AS o FROM documents WHERE lang IS NOT NULL AND n_chars IS NOT NULL AND source IS NOT NULL),
  m AS (SELECT x, row_number() OVER (ORDER BY s, p, o, i) AS k FROM (SELECT s, p, o, 0 AS i, s AS x FROM t UNION ALL SELECT s, p, o, 1, o FROM t) WHERE starts_with(x, '_:')), n AS (SELECT x, '_:b' || (row_number() OVER (ORDER BY min(k)) - 1) AS name FROM m GROUP BY x)
  SELECT coalesce(a.name, s) AS s, p, coalesce(b.name, o) AS o FROM t LEFT JOIN n a ON a.x = s LEFT JOIN n b ON b.x = o""")
def named_blanks(s, d):
    k = F.col("doc_id")
    blank = lambda f: F.concat(F.lit("_:n"), (k * f % 50).cast("string"))
    rows = view(s, d, "documents").where("lang is not null and n_chars is not null and source is not null")
    return catalog.named_blanks(rows.select(F.when(k % 3 == 0, blank(7)).otherwise(F.col("source")).alias("s"), F.col("lang").alias("p"), F.when(k % 4 == 0, blank(11)).otherwise(F.concat(F.lit("o"), (F.col("n_chars") % 5).cast("string"))).alias("o")))


_DONE = """SELECT v.version_id AS version_id, service, created_at, CASE WHEN NOT EXISTS (SELECT 1 FROM @artifacts a WHERE a.version_id = v.version_id) THEN 'download' WHEN NOT EXISTS (SELECT 1 FROM @files f WHERE f.version_id = v.version_id AND f.format = 'en') THEN 'extract' END AS stopped_at FROM @versions v"""


def _done(s, d):
    files = view(s, d, "files").where("format = 'en'")
    return catalog.committed(view(s, d, "versions"), {"download": view(s, d, "artifacts"), "extract": files})


@query(f"SELECT version_id, stopped_at FROM ({_DONE})")
def committed_versions(s, d):
    return _done(s, d).select("version_id", "stopped_at")


@query(f"SELECT service, version_id FROM (SELECT *, row_number() OVER (PARTITION BY service ORDER BY created_at DESC, version_id DESC) AS r FROM ({_DONE}) WHERE stopped_at IS NULL) WHERE r = 1")
def latest_pointers(s, d):
    return catalog.latest_pointer(_done(s, d))


@query("SELECT event_id, epoch_ms(ts) // 600000 AS slot, (row_number() OVER (PARTITION BY epoch_ms(ts) // 600000 ORDER BY ts, event_id) - 1) // 4 AS batch FROM events")
def micro_batches(s, d):
    return retrieval.micro_batches(view(s, d, "events"), 600_000, 4, key="event_id").select("event_id", "slot", "batch")
