"""Registered queries over stored indexes. An index is built once a session and input folder, and searched by all of its queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import percentiles, scalars
from ..operators import documents, markup, retrieval, telemetry, vector_join
from ..operators.lexical_index import LexicalIndex
from .catalogue import _COS, _POST, ORACLE, ascii_tokens, query, view
from ..sources import datasets, partitioned, readers
from ..streaming import telemetry as streams
from ..streaming import timers
from .more import _folder
from .views import with_views

_BUILT: dict[tuple[str, str, str], object] = {}


def built(s, d: str, what: str, make):
    """What `make` builds in a new shared folder, once."""
    name = (s.sparkContext.applicationId, d, what)
    if name not in _BUILT:
        _BUILT[name] = make(_folder(s, what))
    return _BUILT[name]


def _lexical(s, d) -> LexicalIndex:
    """The documents in three steps: English ones, all others, and the first again as an upsert of those with an even number."""

    def make(path):
        docs = view(s, d, "documents").select("doc_id", "text", "lang")
        index = LexicalIndex(s, path)
        index.append(docs.where("lang = 'en'"), ascii_tokens())
        index.append(docs.where("lang is null or lang <> 'en'"), ascii_tokens())
        index.upsert(docs.where("doc_id % 16 = 0"), ascii_tokens())
        return index

    return built(s, d, "lexical", make)


def _search(s, d, kind: str):
    asked = retrieval.postings(view(s, d, "benchmark").withColumnRenamed("item_id", "query_id"), "query_id", tokens=ascii_tokens())
    if kind != "bm25":
        asked = retrieval.term_weights(asked, "query_id").withColumnRenamed({"compat": "bm25_weight", "sparse": "sparse_weight"}[kind], "weight")
    return _lexical(s, d).search(asked, 10, kind)


@query()
def stored_bm25(s, d):
    return _search(s, d, "bm25")[0].select("query_id", "doc_id", "rank", F.round("score", 3).alias("score"))


@query()
def stored_compat(s, d):
    return _search(s, d, "compat")[0].select("query_id", "doc_id", "rank", F.round("score", 3).alias("score"))


@query()
def stored_sparse(s, d):
    return _search(s, d, "sparse")[0].select("query_id", "doc_id", "rank", F.round("score", 3).alias("score"))


# The rows are those of the searches that read every posting; scores are compared to three digits, as each engine adds terms in its own order.
ORACLE |= {name: ORACLE[whole].replace("round(score, 6)", "round(score, 3)").replace("round(b, 6)", "round(b, 3)").replace("round(p, 6)", "round(p, 3)") for name, whole in (("stored_bm25", "bm25_search"), ("stored_compat", "compat_search"), ("stored_sparse", "sparse_search"))}


@query(f"WITH {_POST} SELECT query_id, count(*) AS postings, true AS skips FROM (SELECT DISTINCT query_id, term FROM q) JOIN d USING (term) GROUP BY query_id")
def stored_postings(s, d):
    """Postings of each query's terms that are not deleted, and whether the search opened no more than there are."""
    asked = retrieval.postings(view(s, d, "benchmark").withColumnRenamed("item_id", "query_id"), "query_id", tokens=ascii_tokens())
    index = _lexical(s, d)
    live = index.postings().join(F.broadcast(asked.select("query_id", "term").distinct()), "term").groupBy("query_id").agg(F.count(F.lit(1)).alias("postings"))
    return live.join(index.search(asked, 10, "bm25")[1], "query_id").select("query_id", "postings", (F.col("scored") <= F.col("total")).alias("skips"))


# --- near duplicates among vectors

_REPS = """r AS (SELECT min(vec_id) AS id, any_value(embedding) AS embedding FROM embeddings WHERE len(embedding) > 0 GROUP BY embedding)"""
_LIKE = """round(list_sum(list_transform(range(1, len(x.embedding) + 1), lambda i: x.embedding[i]::DOUBLE * y.embedding[i]::DOUBLE)) / (sqrt(list_sum(list_transform(x.embedding, lambda v: v::DOUBLE * v::DOUBLE))) * sqrt(list_sum(list_transform(y.embedding, lambda v: v::DOUBLE * v::DOUBLE)))), 9)"""


@query(f"WITH {_REPS} SELECT x.id AS a, y.id AS b, round({_LIKE}, 6) AS score FROM r x JOIN r y ON x.id < y.id WHERE {_LIKE} >= 0.35")
def near_vectors(s, d):
    pairs = vector_join.near_duplicates(view(s, d, "embeddings"), 0.35)[1]
    return pairs.select("a", "b", F.round("score", 6).alias("score"))


@query("SELECT vec_id AS id, min(vec_id) OVER (PARTITION BY embedding) AS rep FROM embeddings WHERE len(embedding) > 0")
def vector_classes(s, d):
    return vector_join.classes(view(s, d, "embeddings"))[0]


@query(f"""SELECT vec_id FROM embeddings y WHERE vec_id % 3 = 0 AND NOT EXISTS (SELECT 1 FROM embeddings x WHERE (x.vec_id % 3 <> 0 OR x.vec_id < y.vec_id) AND {_LIKE} >= 0.35)""")
def ingested_vectors(s, d):
    """A third of the vectors taken in beside the others, less those that are near to one that is there or comes earlier."""
    v = view(s, d, "embeddings")
    return vector_join.ingest(v.where("vec_id % 3 = 0"), v.where("vec_id % 3 <> 0"), 0.35).select("vec_id")


# --- order statistics of a table in which one key holds nine rows of ten

_HOT = "SELECT CASE WHEN event_id % 10 < 9 THEN 'hot' WHEN event_id % 20 < 10 THEN NULL ELSE event_type END AS k, value FROM events"


@query(f"""WITH g AS (SELECT k, list_sort(list(value)) AS l, count(value) AS n, quantile_cont(value, 0.95) AS a, quantile_cont(value, 0.13) AS b FROM ({_HOT}) GROUP BY k)
  SELECT k, round(a, 6) AS linear, round(b, 6) AS inclusive, l[CAST(floor(n * 0.5) AS BIGINT) + 1] AS floored, l[CAST(ceil(0.99 * n) AS BIGINT)] AS nearest, l[CAST(floor((n - 1) * 0.9) AS BIGINT) + 1] AS spanned, l[n // 2 + 1] AS middle, n FROM g""")
def hot_percentiles(s, d):
    e = view(s, d, "events")
    k = F.when(F.col("event_id") % 10 < 9, "hot").when(F.col("event_id") % 20 < 10, None).otherwise(F.col("event_type"))
    rows = e.select(k.alias("k"), "value")
    rules = {"linear": ("linear", 0.95), "inclusive": ("inclusive", 0.1234), "floored": ("index_floor", 0.5), "nearest": ("nearest", 0.99), "spanned": ("index_span", 0.9), "middle": ("middle", 0.5)}
    out = percentiles.order_statistics(rows, ["k"], "value", rules).alias("p").join(rows.groupBy("k").agg(F.count("value").alias("n")).alias("c"), F.col("p.k").eqNullSafe(F.col("c.k")))
    return out.select("p.k", F.round("linear", 6).alias("linear"), F.round("inclusive", 6).alias("inclusive"), "floored", "nearest", "spanned", "middle", "n")


# --- planned partitions, commits and timers


@query("SELECT doc_id, lang, source, n_chars, text FROM documents")
def rotated_round_trip(s, d):
    """The documents as JSON lines in parts closed by bytes, read again by ranges of bytes."""
    path = _folder(s, "rotated").removeprefix("file://")
    partitioned.write_lines(view(s, d, "documents"), path, 1 << 20)
    return partitioned.read_lines(s, path, "doc_id long, lang string, source string, n_chars long, text string", 300_000)


@query("""WITH RECURSIVE e AS (SELECT host, event_id, epoch_us(ts) // 1000 AS ms, status >= 429 AS failed, row_number() OVER (PARTITION BY host ORDER BY ts, event_id) AS n FROM @http),
  s AS (
    SELECT DISTINCT host, 0::BIGINT AS n, 'CLOSED' AS name, []::BIGINT[] AS fails, -1::BIGINT AS due, -1::BIGINT AS ms, NULL::BIGINT AS fired, NULL::VARCHAR AS was FROM e
    UNION ALL
    SELECT host, n, CASE WHEN opens THEN 'OPEN' WHEN closes THEN 'CLOSED' ELSE name END, CASE WHEN opens OR closes THEN [] WHEN failed AND name <> 'OPEN' THEN f ELSE fails END, CASE WHEN opens THEN ms + 3600000 WHEN name = 'OPEN' THEN due ELSE -1 END, ms, fired, CASE WHEN opens OR closes THEN name END
    FROM (SELECT *, name <> 'OPEN' AND failed AND (name = 'HALF_OPEN' OR len(f) >= 3) AS opens, name = 'HALF_OPEN' AND NOT failed AS closes
      FROM (SELECT *, list_append(list_filter(fails, lambda x: ms - x < 7200000)[-2:], ms) AS f
        FROM (SELECT s.host, e.n, e.ms, e.failed, CASE WHEN s.name = 'OPEN' AND s.due <= e.ms THEN 'HALF_OPEN' ELSE s.name END AS name, CASE WHEN s.name = 'OPEN' AND s.due <= e.ms THEN [] ELSE s.fails END AS fails, s.due, CASE WHEN s.name = 'OPEN' AND s.due <= e.ms THEN s.due END AS fired
          FROM s JOIN e ON e.host = s.host AND e.n = s.n + 1))))
  SELECT host AS key, fired AS at_ms, 'OPEN' AS old_state, 'HALF_OPEN' AS new_state FROM s WHERE fired IS NOT NULL
  UNION ALL SELECT host, ms, was, name FROM s WHERE was IS NOT NULL""")
def timed_breaker(s, d):
    """Breakers whose cooldowns end by a timer, at the moment they are due."""
    calls = view(s, d, "http").select(F.col("host").alias("key"), "ts", F.col("event_id").alias("seq"), (F.col("status") >= 429).alias("event"))
    return timers.changes_batch(calls, timers.Breaker(3, 7_200_000, 3_600_000))


@query(f"""WITH r AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, {_COS} AS score FROM embeddings q JOIN embeddings c ON c.label = 3 AND q.vec_id % 100 = 0)
  SELECT query_id, vec_id, CAST(n AS INTEGER) AS rank, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM r) WHERE n <= 12""")
def overfetched_search(s, d):
    """A search that cannot filter, asked for more until twelve rows of one label are left."""
    v = view(s, d, "embeddings")
    asked = v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    found, _ = retrieval.overfetched(lambda q, k: retrieval.dense_search(q, v, k), asked, v.where("label = 3"), 12)
    return found.select("query_id", "vec_id", "rank", F.round("score", 6).alias("score"))


@query("""WITH d AS (SELECT list_sort(list(CAST(job_id % 1000 AS DOUBLE))) AS x FROM @jobs WHERE state = 'FINALIZED'),
  l AS (SELECT list_sort(list(epoch(t) - epoch(created_at))) AS x FROM @jobs JOIN (SELECT job_id, min(started_at) AS t FROM @ops GROUP BY job_id) USING (job_id)),
  g AS (SELECT job_id, kind, count(*) AS n FROM @ops GROUP BY job_id, kind),
  r AS (SELECT 'job_completion_rate' AS objective, round(count(*) FILTER (state = 'FINALIZED') / count(*)::DOUBLE, 6) AS actual, 0.995::DOUBLE AS target, 0.005::DOUBLE AS allowed FROM @jobs
    UNION ALL SELECT 'time_to_complete_p50', 1000 * x[least(CAST(floor(len(x) * 0.5) AS BIGINT), len(x) - 1) + 1], 30000, 5000 FROM d UNION ALL SELECT 'time_to_complete_p95', 1000 * x[least(CAST(floor(len(x) * 0.95) AS BIGINT), len(x) - 1) + 1], 120000, 20000 FROM d
    UNION ALL SELECT 'crash_recovery_success_rate', 1, 0.999, 0.001 UNION ALL SELECT 'lease_acquisition_p99', 1000 * x[least(CAST(floor(len(x) * 0.99) AS BIGINT), len(x) - 1) + 1], 100, 50 FROM l
    UNION ALL SELECT 'operation_replay_rate', round(sum(n - 1) / sum(n)::DOUBLE, 6), 0.05, 0.10 FROM g)
  SELECT objective, actual, target, CASE WHEN abs(actual - target) <= allowed THEN 'pass' WHEN abs(actual - target) <= 2 * allowed THEN 'warning' ELSE 'fail' END AS status FROM r""")
def objectives_report(s, d):
    return telemetry.objectives_report(view(s, d, "jobs"), view(s, d, "ops"))


# --- whole documents


@query()
def chunked_documents(s, d):
    return markup.chunk_documents(view(s, d, "documents"), least=40, most=120)


@query()
def chunked_pages(s, d):
    return markup.chunk_documents(view(s, d, "pages"), "page_id", "html", "html", 40, 120)


@query("""SELECT vec_id, CASE WHEN r >= 0.8 THEN 0.7 WHEN r <= 0.3 THEN 1.25 ELSE 1.0 END::DOUBLE AS weight FROM (SELECT vec_id, (vec_id % 11) / 10.0 AS r FROM embeddings)""")
def dense_weights(s, d):
    v = view(s, d, "embeddings")
    return v.select("vec_id", retrieval.dense_weight(1.0, (F.col("vec_id") % 11) / F.lit(10.0)).cast("double").alias("weight"))


# --- tokens of any script, states, effects, readers

_WORDS = "regexp_extract_all(lower(text), '[\\p{L}\\p{M}\\p{Nd}\\p{Pc}'']+')"
_UNICODE = _POST.replace("regexp_extract_all(lower(text), '[a-z0-9'']+')", _WORDS)


@query(f"WITH {_UNICODE} SELECT doc_id, term, tf FROM d")
def unicode_tokens(s, d):
    return retrieval.postings(view(s, d, "documents"))


ORACLE["unicode_bm25"] = ORACLE["stored_bm25"].replace("regexp_extract_all(lower(text), '[a-z0-9'']+')", _WORDS)


@query(ORACLE["unicode_bm25"])
def unicode_bm25(s, d):
    """The stored index over words of any script, which is what it takes by itself."""

    def make(path):
        index = LexicalIndex(s, path)
        index.append(view(s, d, "documents"))
        return index

    asked = retrieval.postings(view(s, d, "benchmark").withColumnRenamed("item_id", "query_id"), "query_id")
    hits, _ = built(s, d, "words", make).search(asked, 10)
    return hits.select("query_id", "doc_id", "rank", F.round("score", 3).alias("score"))


@query("""SELECT item_id AS job_id, CASE max(CASE status WHEN 'failure' THEN 0 WHEN 'skip' THEN 1 ELSE 2 END) WHEN 0 THEN 'failure' WHEN 1 THEN 'skip' ELSE 'success' END AS state FROM @manifest GROUP BY item_id""")
def furthest_states(s, d):
    m = view(s, d, "manifest").select(F.col("item_id").alias("job_id"), F.col("status").alias("state"))
    return telemetry.state_of(m, {"failure": 0, "skip": 1, "success": 2})


@query("SELECT DISTINCT user_id, event_type FROM events")
def effects_once(s, d):
    """A stream of effects of which each is written once a key."""
    path, e = _folder(s, "effects"), view(s, d, "events")
    stream = s.readStream.schema(e.schema).parquet(f"{d}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    once = streams.distinct_effects(stream, ["user_id", "event_type"], "3650 days").select("user_id", "event_type")
    once.writeStream.format("parquet").option("path", path).option("checkpointLocation", _folder(s, "effects-check")).trigger(availableNow=True).start().awaitTermination()
    return s.read.schema("user_id long, event_type string").parquet(path)


@query("""SELECT doc_id, len(p) AS n, len(list_filter(p, lambda x: starts_with(ltrim(x), '#') OR starts_with(ltrim(x), 'Figure caption:') OR starts_with(ltrim(x), 'Table:') OR starts_with(ltrim(x), 'Picture description:') OR starts_with(ltrim(x), '<!-- image -->'))) AS opening
  FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS p FROM documents) WHERE len(p) > 0""")
def paragraph_counts(s, d):
    return documents.paragraphs(view(s, d, "documents")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("boundary").alias("opening"))


@query(r"""SELECT page_id, substr(regexp_replace(regexp_replace(url, '\.[A-Za-z0-9]{1,8}$', ''), '[^A-Za-z0-9._/-]', '_', 'g'), 1, 512) AS rel_id FROM pages""")
def relative_ids(s, d):
    return view(s, d, "pages").select("page_id", scalars.relative_id(F.col("url")).alias("rel_id"))


@query("SELECT vec_id, label FROM embeddings WHERE vec_id % 5 <> 0 UNION ALL SELECT vec_id, -1 AS label FROM embeddings WHERE vec_id % 5 = 0")
def upserted_rows(s, d):
    v = view(s, d, "embeddings").select("vec_id", "label")
    return retrieval.upsert(v, v.where("vec_id % 5 = 0").withColumn("label", F.lit(-1)), "vec_id")


@query("SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 300 OFFSET 50")
def rows_of_a_range(s, d):
    return readers.rows_between(view(s, d, "documents").select("doc_id", "lang", "n_chars"), 50, 350, "doc_id")


@query("SELECT c_custkey, c_name, kind FROM customer, (VALUES ('csv'), ('jsonl'), ('parquet')) AS k(kind)")
def rows_by_suffix(s, d):
    """Customers written in three formats, each read by the suffix of its path."""
    c, root, out = view(s, d, "customer").select("c_custkey", "c_name"), _folder(s, "suffix"), None
    for kind in ("csv", "jsonl", "parquet"):
        datasets.write_rows(c, f"{root}/rows.{kind}", {"jsonl": "json"}.get(kind, kind))
        some = readers.read_rows(s, f"{root}/rows.{kind}", c.schema).withColumn("kind", F.lit(kind))
        out = some if out is None else out.unionByName(some)
    return out


@query("SELECT seq, item_id, status, CASE WHEN seq % 2 = 0 THEN 'jsonl' ELSE 'csv' END AS origin FROM @manifest")
def entries_of_earlier_runs(s, d):
    m, root = view(s, d, "manifest").select("seq", "item_id", "status"), _folder(s, "entries")
    datasets.write_rows(m.where("seq % 2 = 0"), f"{root}/a", "json")
    datasets.write_rows(m.where("seq % 2 = 1"), f"{root}/b", "csv")
    return readers.previous_entries(s, m.schema, f"{root}/a", f"{root}/b")


@query("SELECT CAST(vec_id AS STRING) AS uuid, CAST(len(embedding) AS INTEGER) AS dim FROM embeddings WHERE label < 5")
def vector_dataset(s, d):
    """Dense vectors written as a dataset by month, and read back with a filter."""
    root, v = _folder(s, "vectors"), view(s, d, "embeddings")
    made = {"uuid": F.col("vec_id").cast("string"), "vec": F.col("embedding"), "dim": F.size("embedding"), "created_at": F.to_timestamp(F.format_string("2024-%02d-01", F.col("label") + 1))}
    rows = v.select(*(made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in datasets.DENSE))
    datasets.write_dataset(rows, root, datasets.DENSE, family="dense", fmt="parquet")
    return datasets.open_vectors(s, root, "dense", ["uuid", "dim"], "mm < '06'")


# A breaker whose cooldown ends with the next call after it, in SQL.
ORACLE["circuit_breaker"] = with_views("""WITH RECURSIVE e AS (SELECT host, event_id, epoch_us(ts) / 1000000.0 AS ms, status >= 429 AS failed, row_number() OVER (PARTITION BY host ORDER BY ts, event_id) AS n FROM @http),
  s AS (
    SELECT DISTINCT host, 0::BIGINT AS n, 'CLOSED' AS name, []::DOUBLE[] AS fails, -1::DOUBLE AS due, -1::DOUBLE AS ms, NULL::DOUBLE AS fired, NULL::VARCHAR AS was FROM e
    UNION ALL
    SELECT host, n, CASE WHEN opens THEN 'OPEN' WHEN closes THEN 'CLOSED' ELSE name END, CASE WHEN opens OR closes THEN [] WHEN failed AND name <> 'OPEN' THEN f ELSE fails END, CASE WHEN opens THEN ms WHEN name = 'OPEN' THEN due ELSE -1 END, ms, fired, CASE WHEN opens OR closes THEN name END
    FROM (SELECT *, name <> 'OPEN' AND failed AND (name = 'HALF_OPEN' OR len(f) >= 3) AS opens, name = 'HALF_OPEN' AND NOT failed AS closes
      FROM (SELECT *, list_append(list_filter(fails, lambda x: ms - x < 7200)[-2:], ms) AS f
        FROM (SELECT s.host, e.n, e.ms, e.failed, CASE WHEN s.name = 'OPEN' AND e.ms - s.due >= 3600 THEN 'HALF_OPEN' ELSE s.name END AS name, CASE WHEN s.name = 'OPEN' AND e.ms - s.due >= 3600 THEN [] ELSE s.fails END AS fails, s.due, CASE WHEN s.name = 'OPEN' AND e.ms - s.due >= 3600 THEN e.ms END AS fired
          FROM s JOIN e ON e.host = s.host AND e.n = s.n + 1))))
  SELECT host, fired AS ts, 'OPEN' AS old_state, 'HALF_OPEN' AS new_state FROM s WHERE fired IS NOT NULL
  UNION ALL SELECT host, ms, was, name FROM s WHERE was IS NOT NULL""")
