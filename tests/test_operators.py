import math
import os
import unicodedata
import uuid

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.functions import percentiles, scalars
from lodestone.operators import catalog, dedup, documents, observability, retrieval, telemetry
from lodestone.plans import catalogue, profiler


def test_percentile_rules(spark):
    x = spark.createDataFrame([("a", v) for v in (50, 120, 180, 200, 300)] + [("b", v) for v in (750, 900)], "k string, v long")
    near = {r.k: r.p for r in x.groupBy("k").agg(percentiles.nearest("v", 0.95).alias("p")).collect()}
    assert near == {"a": 300, "b": 900}
    idx = {r.k: (r.p50, r.p100) for r in percentiles.by_index(x, ["k"], "v", {"p50": 0.5, "p100": 1.0}).collect()}
    assert idx == {"a": (180, None), "b": (900, None)}
    span = {r.k: r.p for r in percentiles.by_index(x, ["k"], "v", {"p": 0.5}, "index_span").collect()}
    assert span == {"a": 180, "b": 750}
    assert percentiles.by_index(x, ["k"], "v", {"p": 1.0}, clamp=True).agg(F.max("p")).first()[0] == 900
    assert x.where("k = 'b'").agg(percentiles.linear("v", 0.5)).first()[0] == 825


def test_registry_names_and_categories():
    assert len(observability.list_queries()) == 8 and observability.query_summary() == {"slo": 2, "ratelimit": 2, "policy": 2, "extraction": 2}
    with pytest.raises(KeyError):
        observability.get_query("none")


def test_scalars(spark):
    one = spark.createDataFrame([("Straße ＡＢ Café's", "HTTP://Ex.COM:80/a/../b?z=1&utm_source=q&a=2#f", "Sun, 06 Nov 1994 08:49:37 GMT")], "t string, u string, d string")
    r = one.select(scalars.tokenize("t").alias("a"), scalars.fold_tokens("t").alias("b"), scalars.canonical_url()("u").alias("c"), scalars.canonical_url("landing")("u").alias("l"), scalars.canonical_host(F.col("u")).alias("h"), scalars.parse_instant(F.col("d")).alias("i"), scalars.content_hash(F.col("t")).alias("x")).first()
    assert r.a == ["straße", "ａｂ", "café's"] and r.b == ["strasse", "ab", "café's"]
    assert r.c == "http://ex.com/b?a=2&utm_source=q&z=1" and r.l == "http://ex.com/b?z=1&a=2" and r.h == "ex.com" and r.i.year == 1994
    assert len(r.x) == 64
    ids = one.select(scalars.chunk_uuid(F.lit("d"), F.lit(3), F.col("t")).alias("u"), scalars.legacy_chunk_uuid(F.lit("d"), F.lit("s"), F.col("t")).alias("v")).first()
    assert uuid.UUID(ids.u).version == 5 and uuid.UUID(ids.v).version == 5 and uuid.UUID(ids.u).variant == uuid.RFC_4122
    assert unicodedata.is_normalized("NFKC", one.select(scalars.nfkc(F.col("t"))).first()[0])
    assert scalars.period_seconds("1m") == 30 * 86400 and scalars.rate_per_second("300/min") == 5
    v = one.select(scalars.human_bytes(F.lit(1536)), scalars.masked(F.lit("token=abc&x=1")), scalars.spdx(F.lit("Apache License 2.0")), scalars.media_type(F.lit("Text/HTML; charset=x")), scalars.safe_filename(F.lit("a b?.txt")), scalars.basename_from_url(F.lit("http://h/x/y.pdf?q"))).first()
    assert tuple(v) == ("1.50 KB", "token=***&x=1", "Apache-2.0", "text/html", "a_b_.txt", "y.pdf")


def test_fusion_weights_and_pages(spark):
    a = spark.createDataFrame([(1, 7, 1), (1, 8, 2)], "query_id long, doc_id long, rank int")
    b = spark.createDataFrame([(1, 8, 1), (1, 9, 2)], "query_id long, doc_id long, rank int")
    f = {r.doc_id: (r.score, r.fused_rank) for r in retrieval.rrf([(a, 1.0), (b, 0.5)]).collect()}
    assert math.isclose(f[8][0], 1 / 62 + 0.5 / 61) and f[8][1] == 1 and f[7][1] == 2
    w = spark.createDataFrame([(0.9,), (0.1,), (0.5,)], "r double").select(retrieval.dense_weight(1.0, "r")).collect()
    assert [x[0] for x in w] == [0.7, 1.25, 1.0]
    ranked = spark.createDataFrame([(i, float(i // 2)) for i in range(10)], "doc_id long, score double")
    got, anchor = [], None
    while rows := retrieval.page_after(ranked, 3, anchor).collect():
        got += [r.doc_id for r in rows]
        c = retrieval.encode_cursor(rows[-1].score, rows[-1].doc_id, 3, "m")
        anchor = retrieval.decode_cursor(c, 3, "m")
    assert got == [8, 9, 6, 7, 4, 5, 2, 3, 0, 1]
    assert retrieval.decode_cursor("??", 3, "m") is None
    with pytest.raises(ValueError):
        retrieval.decode_cursor(c, 4, "m")
    assert retrieval.fingerprint("q", None, {"b": 1, "a": 2}, True, False) == retrieval.fingerprint("q", None, {"a": 2, "b": 1}, True, False)


def test_mmr_and_shaping():
    s, v = np.array([1.0, 0.99, 0.5]), np.array([[1.0, 0], [1.0, 0.01], [0, 1.0]])
    assert retrieval.mmr_order(s, v, 0.6, 3) == [0, 2, 1] and retrieval.mmr_order(s, v, 1.0, 2) == [0, 1]
    row = lambda i, doc, vec, t=10, b=10: {"i": i, "doc": doc, "vector": vec, "tokens": t, "bytes": b}
    rows = [row(0, 1, [1, 0]), row(1, 1, [1, 0.001]), row(2, 1, [0, 1]), row(3, 1, [1, 1]), row(4, 1, [-1, 1]), row(5, 2, [0, 0]), row(6, 2, [0, 0]), row(7, 3, [-1, 0], 5000), row(8, 3, [-1, -1])]
    assert [r["i"] for r in retrieval.shape_rows(rows)] == [0, 2, 3, 5, 6]
    assert [r["i"] for r in retrieval.shape_rows(rows, tokens=0)] == [0, 2, 3, 5, 6, 7, 8]


def test_dense_search_recall_and_range(spark):
    g = np.random.default_rng(3)
    m = g.normal(size=(300, 8)).astype(np.float32)
    v = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)], "vec_id long, embedding array<float>").repartition(3)
    q = v.where("vec_id < 5").selectExpr("vec_id as query_id", "embedding as vector")
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    got = retrieval.dense_search(q, v, 10)
    truth = [(i, int(j), r + 1) for i in range(5) for r, j in enumerate(np.argsort(-(u[i] @ u.T), kind="stable")[:10])]
    t = spark.createDataFrame(truth, "query_id long, vec_id long, rank int")
    assert retrieval.recall_at(got, t, 10).agg(F.min("recall")).first()[0] == 1.0
    assert retrieval.hit_rate(got, 1, "vec_id", "query_id").first().hit_rate == 1.0
    n = {r.query_id: r["count"] for r in retrieval.dense_search(q, v, None, 0.3).groupBy("query_id").count().collect()}
    assert n == {i: int((u[i] @ u.T >= 0.3).sum()) for i in range(5)}
    blocks = retrieval.dense_search(q, v, 10, most_queries=2, block=64)  # too many for one block
    assert sorted((r.query_id, r.rank, r.vec_id) for r in blocks.collect()) == sorted((r.query_id, r.rank, r.vec_id) for r in got.collect())


def test_coalescing():
    row = lambda t, b=False: {"text": " ".join(["w"] * t), "tokens": t, "offset": 0, "boundary": b, "refs": ["r"], "pages": [t], "confidence": t / 10}
    out = documents.coalesce_rows([row(3), row(3), row(20), row(2, True), row(4), row(9)], 8, 12)
    assert [r["tokens"] for r in out] == [6, 20, 6, 9]
    assert out[0]["pages"] == [3] and out[2]["pages"] == [2, 4] and "\n\n" in out[0]["text"] and out[2]["confidence"] == 0.4


def test_windows_validation_paths(spark):
    w = documents.sliding_windows(spark.createDataFrame([(1, "a b c d e"), (2, "")], "doc_id long, text string"), 4, 2).collect()
    assert [(r.start, r.tokens) for r in w] == [(0, ["a", "b", "c", "d"]), (2, ["c", "d", "e"]), (4, ["e"])]
    good, bad = documents.validated(spark.createDataFrame([(1, 5), (2, None), (3, -1)], "id long, n int"), {"n": F.col("n") > 0})
    assert [r.id for r in good.collect()] == [1] and {r.id for r in bad.collect()} == {2, 3}
    p = spark.createDataFrame([("A/x", 1, 9), ("a/X", 2, 8), ("A/x", 3, 7)], "relpath string, seq int, n int")
    assert [r.n for r in documents.case_collisions(p).collect()] == [2]
    assert {r.relpath: r.n for r in documents.one_per_path(p, "last_wins").collect()} == {"A/x": 7, "a/X": 8}
    with pytest.raises(ValueError):
        documents.one_per_path(p, "reject")


def test_catalog_rules(spark):
    m = spark.createDataFrame([(1, 1, "success", "h"), (1, 2, "failure", "h"), (2, 3, "skip", "h"), (3, 4, "success", "old")], "item_id long, seq long, status string, input_hash string")
    w = spark.createDataFrame([(1, "h", True), (2, "h", True), (3, "h", True), (4, "h", True), (2, "h", False)], "item_id long, input_hash string, output_exists boolean")
    assert sorted((r.item_id, r.action) for r in catalog.resume(w, m).collect()) == [(1, "process"), (2, "process"), (2, "skip"), (3, "process"), (4, "process")]
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string")
    assert {r.k: r.v for r in catalog.upsert(old, new, ["k"]).collect()} == {1: "a", 2: "c", 3: "d"}
    assert [r.k for r in catalog.register(old, new, ["k"]).collect()] == [3]
    assert {r.k: r.v for r in retrieval.upsert(old, new, "k").collect()} == {1: "a", 2: "c", 3: "d"}


def test_defaults_without_rows(spark):
    jobs = spark.createDataFrame([], "state string")
    assert telemetry.completion(jobs).first().completion_rate == 1.0
    store = spark.createDataFrame([], "id long, artifact_id long, sha256 string, bytes long")
    assert dedup.totals(store).first().dedup_ratio == 0.0
    x = spark.createDataFrame([(100.0,), (140.0,), (500.0,), (1.0,)], "p95_s double")
    assert [r[0] for r in x.select(telemetry.objective("p95_s", F.col("p95_s"))).collect()] == ["pass", "warn", "fail", "pass"]
    assert x.select(telemetry.objective("p95_s", F.col("p95_s"), directional=False)).collect()[3][0] == "fail"


def test_profiler_names_costly_nodes(spark):
    a = spark.range(100).withColumn("k", F.col("id") % 7)
    report = profiler.profile(a.join(a.select("k").distinct(), "k").groupBy("k").count())
    assert report["exchanges"] >= 1 and isinstance(report["advice"], list)
    assert any("cross" in x for x in profiler.profile(a.crossJoin(a.select(F.col("id").alias("j"))))["advice"])


def test_probes_find_most_neighbours(spark):
    g = np.random.default_rng(5)
    m = (g.normal(size=(8, 16))[g.integers(0, 8, 600)] + 0.3 * g.normal(size=(600, 16))).astype(np.float32)
    v = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)], "vec_id long, embedding array<float>")
    q = v.where("vec_id % 50 = 0").selectExpr("vec_id as query_id", "embedding as vector")
    c, rows = retrieval.partition_vectors(v, 8)
    assert rows.count() == 600
    got = retrieval.recall_at(retrieval.probe_search(q, c, rows, 10, 4), retrieval.dense_search(q, v, 10), 10)
    assert got.agg(F.avg("recall")).first()[0] >= 0.9
    assert retrieval.should_rebuild(8, 2) and not retrieval.should_rebuild(0, 0)
    assert retrieval.reservoir(v, 7, "vec_id").count() == 7


def test_hash_embedding_is_a_unit_vector(spark):
    r = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "t array<string>").select(retrieval.hash_embedding(48)("t").alias("v")).collect()
    assert abs(sum(x * x for x in r[0].v) - 1) < 1e-5 and len(r[0].v) == 48 and not any(r[1].v) and not any(r[2].v)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_registered_probes_find_most_neighbours(spark, sf):
    d = f"/root/testdata/{sf}"
    if not os.path.isdir(d):
        pytest.skip("no test tables")
    v = spark.read.parquet(f"{d}/embeddings.parquet")
    q = v.where("vec_id % 100 = 0").selectExpr("vec_id as query_id", "embedding as vector")
    recall = retrieval.recall_at(catalogue.QUERIES["probe_search"](spark, d), retrieval.dense_search(q, v, 10), 10).agg(F.avg("recall")).first()[0]
    print(sf, "recall", recall)
    assert recall >= 0.9


def test_registered_hash_embeddings_have_the_default_length(spark):
    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no test tables")
    assert len(catalogue.QUERIES["hash_embeddings"](spark, d).first().vec) == 2560


def test_hash_embedding_holds_one_row_at_a_time():
    import hashlib
    import tracemalloc

    import pyarrow as pa

    rows = [[f"w{(i * j) % 97}" for j in range(20)] for i in range(3000)] + [[], None]
    sent = pa.array(rows, pa.list_(pa.string()))
    tracemalloc.start()
    got = retrieval._token_hashes(sent, 2560).to_pylist()
    assert tracemalloc.get_traced_memory()[1] < 30 << 20
    tracemalloc.stop()
    plain = np.resize(sum(np.frombuffer(hashlib.sha256(w.encode()).digest(), np.uint8) / 255.0 for w in rows[7]), 2560)
    assert np.array_equal(np.resize(np.array(got[7], np.float32), 2560), (plain / np.linalg.norm(plain)).astype(np.float32)) and not any(got[-1] + got[-2])


def test_range_fallback_finds_other_queries_rows(spark, tmp_path):
    rows = [(0, [1.0, 0.0], 0), (100, [1.0, 0.001], 0), (7, [0.0, 1.0], 0), (200, [0.5, 0.5], 0), (201, [0.4, 0.6], 0)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {(r.query_id, r.vec_id, r.fell_back) for r in catalogue.QUERIES["range_fallback"](spark, str(tmp_path)).collect()}
    assert got == {(0, 100, False), (100, 0, False), *((200, k, True) for k in (0, 7, 100, 201))}
    q = spark.createDataFrame([(r[0], r[1]) for r in rows], "query_id long, vector array<float>")
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    blocks = retrieval.dense_search(q, v, 2, most_queries=2, block=2, others=True).collect()
    assert len(blocks) == 10 and all(r.query_id != r.vec_id for r in blocks)


def test_micro_batches_go_by_the_rows_own_clock(spark):
    rows = [(1, "2024-03-31 02:30:00"), (2, "2024-03-31 02:31:00.0005"), (None, "2024-03-31 02:31:00.0005"), (3, None), (4, "1969-12-31 23:55:00")]
    df = spark.createDataFrame(rows, "event_id long, t string").selectExpr("event_id", "cast(t as timestamp_ntz) as ts")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # 02:30 is not there on that day
        got = {(r.event_id, r.slot, r.batch) for r in retrieval.micro_batches(df, 600_000, 2, key="event_id").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    slot = 1711852200000 // 600_000
    assert got == {(1, slot, 0), (2, slot, 0), (None, slot, 1), (3, None, 0), (4, 0, 0)}


def test_micro_batches_round_to_milliseconds_as_the_sql(spark, tmp_path):
    """Slots change half a millisecond early; rows of both kinds of time, beside the registered SQL."""
    last = ["2024-01-01 00:09:59.9994", "2024-01-01 00:09:59.999499", "2024-01-01 00:09:59.9995", "2024-01-01 00:09:59.999999", "2024-01-01 00:10:00", "2024-02-29 23:59:59.999501", "1969-12-31 23:49:59.9996", "1969-12-31 23:49:59.9995", "1969-12-31 23:50:00.0005", "1969-12-31 23:50:00.000501", "1969-12-31 23:40:00.0005", "1969-12-31 23:40:00.0004", "1899-12-31 23:40:00.000499", None]
    rows = [(i, t) for i, t in enumerate(last * 3)]
    for kind in ("timestamp_ntz", "timestamp"):
        path = f"{tmp_path}/{kind}"
        spark.createDataFrame(rows, "event_id long, t string").selectExpr("event_id", f"cast(t as {kind}) as ts").write.parquet(f"{path}/events.parquet")
        got = {tuple(r) for r in catalogue.QUERIES["micro_batches"](spark, path).collect()}
        with duckdb.connect() as c:
            c.sql(f"create view events as select * from '{path}/events.parquet/*.parquet'")
            want = set(c.sql(catalogue.ORACLE["micro_batches"]).fetchall())
        assert got == want and len(got) == len(rows)


def test_postings_are_dealt_by_bytes_of_text(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "TASK_BYTES", 1000)
    docs = spark.createDataFrame([(i, "a b c a " * 25) for i in range(40)] + [(40, None)], "doc_id long, text string")
    post = retrieval.postings(docs)
    assert post.rdd.getNumPartitions() == 8
    assert {(r.doc_id, r.term, r.tf) for r in post.collect()} == {(i, w, n) for i in range(40) for w, n in (("a", 50), ("b", 25), ("c", 25))}


def _ties():
    g = np.random.default_rng(9)
    m = np.repeat(g.integers(-2, 3, size=(60, 4)), 5, axis=0).astype(np.float32)
    m[m.any(axis=1) == 0, 0] = 1
    u = m.astype(float) / np.linalg.norm(m.astype(float), axis=1, keepdims=True)
    return m, np.round(u @ u.T, 9), u


def _plain(s, k, floor, others):
    out = set()
    for i in range(0, 300, 3):
        order = [j for j in np.lexsort((np.arange(300), -s[i])) if (floor is None or s[i, j] >= floor) and not (others and i == j)]
        out |= {(i, int(j), r + 1, s[i, j]) for r, j in enumerate(order[:k])}
    return out


CUTS = ((4, None, False), (4, None, True), (40, None, False), (None, 0.4, True), (3, 0.9, False))


@pytest.mark.parametrize("k,floor,others", CUTS)
def test_kept_pairs_are_bounded_and_whole(monkeypatch, k, floor, others):
    """Small steps: rows leave before the end, and none of the best is lost."""
    for name, value in (("STEP", 64), ("TILE", 16), ("HELD", 150)):
        monkeypatch.setattr(retrieval, name, value)
    _, s, u = _ties()
    at = np.random.default_rng(1).permutation(300)
    kept = retrieval._Kept(np.arange(0, 300, 3), u[::3], k, floor, others)
    kept.most = min(kept.most, 150)
    out, most = [], 0
    for a in range(0, 300, 50):
        for b in kept.add(at[a : a + 50], u[at[a : a + 50]]):
            out.append(b)
        most = max(most, kept.n)
    out += list(kept.rest())
    assert most <= 150 and len(out) > 1
    rows = [r for b in out for r in zip(*(c.to_pylist() for c in b.columns))]
    got = set()
    for i in range(0, 300, 3):
        mine = sorted(((-x, j) for q, j, x in rows if q == i))
        assert len(mine) == len(set(mine))
        got |= {(i, j, r + 1, -x) for r, (x, j) in enumerate(mine[:k])}
    assert got == _plain(s, k, floor, others)


def test_many_queries_meet_rows_in_a_grid(spark):
    """Ties go to smaller keys, and the plan has no side that is collected or broadcast."""
    m, s, _ = _ties()
    v = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)], "vec_id long, embedding array<float>").repartition(3)
    q = v.where("vec_id % 3 = 0").selectExpr("vec_id as query_id", "transform(embedding, x -> double(x)) as vector")
    for most in (4096, 7):
        for k, floor, others in CUTS:
            found = retrieval.dense_search(q, v, k, floor, most_queries=most, block=40, others=others)
            assert {tuple(r) for r in found.select("query_id", "vec_id", "rank", "score").collect()} == _plain(s, k, floor, others), (most, k, floor)
    plan = retrieval.dense_search(q, v, 4, most_queries=7, block=40)._jdf.queryExecution().toString()
    assert "Join" not in plan and "MapInArrow" in plan


def test_own_rows_are_counted_in_one_pass(spark):
    from lodestone.operators import evaluation

    found = spark.createDataFrame([(1, 1, 1), (1, 5, 2), (2, 3, 1), (2, 2, 4), (3, 9, 1)], "query_id long, vec_id long, rank int")
    got = evaluation.hits_within(found, 3)
    assert got.first()[:] == (3, 1, 0.333333) and "Join" not in got._jdf.queryExecution().toString()


def test_probes_multiply_cells_with_their_queries(spark):
    """The rows of the cells that a query probes, ranked as brute force does, without a joined row for each pair."""
    g = np.random.default_rng(6)
    m = np.repeat(g.normal(size=(100, 8)), 3, axis=0).astype(np.float32)
    v = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)], "vec_id long, embedding array<float>")
    q = v.where("vec_id % 10 = 0").selectExpr("vec_id as query_id", "embedding as vector")
    c, rows = retrieval.partition_vectors(v, 6)
    found = retrieval.probe_search(q, c, rows, 7, 2, block=4)
    cell = {r.vec_id: r.cell for r in rows.select("vec_id", "cell").collect()}
    u = m.astype(float) / np.linalg.norm(m.astype(float), axis=1, keepdims=True)
    s, want = np.round(u @ u.T, 9), set()
    for i in range(0, 300, 10):
        near = set(np.argsort(-(m[i] @ c.T))[:2].tolist())
        order = [j for j in np.lexsort((np.arange(300), -s[i])) if cell[int(j)] in near]
        want |= {(i, int(j), r + 1) for r, j in enumerate(order[:7])}
    assert {(r.query_id, r.vec_id, r["rank"]) for r in found.collect()} == want
    assert "Join" not in found._jdf.queryExecution().toString()


def test_coalescing_by_document_and_offsets_in_one_pass(spark):
    texts = ["# a\nb c\n\n  d\u00e9 e\n" + "x\n" * 30, None, "", "\n \n", "one", "\U0001f600\u00a0y\nz\nFigure caption: q\nw " + "v " * 60 + "\nend"] * 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    p = documents.paragraphs(docs)
    want, chunks = {}, []
    for i, text in enumerate(texts):
        at = 0
        for k, x in enumerate((text.split("\n") if text is not None else [])):
            if x.strip(" ") != "":
                want[i, k] = (x, at)
            at += len(x) + 1
    assert {(r.doc_id, r.chunk): (r.text, r.offset) for r in p.collect()} == want
    assert "lambda" in p._jdf.queryExecution().toString() and "aggregate(" not in p._jdf.queryExecution().toString()  # no array that grows by copies
    full = p.withColumn("refs", F.lit(None).cast("array<string>")).withColumn("pages", F.array("chunk")).withColumn("confidence", F.lit(1.0))
    for r in full.collect():
        chunks.append({**r.asDict(), "refs": []})
    plain = set()
    for i in range(len(texts)):
        rows = documents.coalesce_rows(sorted((c for c in chunks if c["doc_id"] == i), key=lambda c: c["chunk"]), 5, 20)
        plain |= {(i, k, r["text"], r["tokens"], r["offset"], tuple(r["pages"])) for k, r in enumerate(rows)}
    got = documents.coalesce_small_runs(full, 5, 20)
    assert {(r.doc_id, r.chunk, r.text, r.tokens, r.offset, tuple(r.pages)) for r in got.collect()} == plain
    assert "MapInArrow" in got._jdf.queryExecution().toString()  # no data frame a document


def test_overfetching_searches_once_a_round(spark):
    v = spark.createDataFrame([(i, [1.0, float(i)], i % 10) for i in range(100)], "vec_id long, embedding array<float>, label int")
    q = v.where("vec_id % 50 = 0").selectExpr("vec_id as query_id", "embedding as vector")
    seen = spark.sparkContext.accumulator(0)
    rounds = []

    def counted(batches):
        seen.add(1)
        yield from batches

    def search(asked, k):
        rounds.append(k)
        hits = retrieval.dense_search(asked, v, k).coalesce(1)
        return hits.mapInArrow(counted, hits.schema)

    found, k = retrieval.overfetched(search, q, v.where("label = 3"), 8, top_k=5)
    assert {(r.query_id, r.vec_id) for r in found.where("rank <= 8").collect()} <= {(a, b) for a in (0, 50) for b in range(3, 100, 10)}
    assert found.count() == 16 and k == rounds[-1] and len(rounds) > 1 and seen.value == len(rounds)


def test_kept_pairs_that_leave_at_the_end_are_whole(monkeypatch):
    """The last cut keeps over half of what may be held, so its rows leave in the cut itself."""
    monkeypatch.setattr(retrieval, "HELD", 100)
    _, _, u = _ties()
    kept = retrieval._Kept(np.arange(8), u[:8], 10, None, False)
    out = [*kept.add(np.arange(10), u[:10]), *kept.rest()]
    assert {(r["query_id"], r["key"]) for b in out for r in b.to_pylist()} == {(i, j) for i in range(8) for j in range(10)} and not kept.held


def test_overfetching_fills_pages_beyond_the_largest_planned_k(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "MOST_K", 20)
    # rows that pass are the farthest of query 0 and the nearest of query 150, and query 999 is no vector
    v = spark.createDataFrame([(i, [1.0, i / 100], 3 if i >= 140 else 1) for i in range(160)], "vec_id long, embedding array<float>, label int")
    q = spark.createDataFrame([(0, [1.0, 0.0]), (150, [1.0, 1.5]), (999, None)], "query_id long, vector array<float>")
    rounds = []

    def search(asked, k):
        rounds.append((k, {r.query_id for r in asked.collect()}))
        return retrieval.dense_search(asked, v, k)

    found = retrieval.overfetched(search, q, v.where("label = 3"), 12, top_k=5)[0].collect()
    assert sorted((r.query_id, r.rank) for r in found) == [(i, n) for i in (0, 150) for n in range(1, 13)]
    assert [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == 0] == list(range(140, 152))
    assert rounds[0][1] == {0, 150, 999} and all(asked == {0} for _, asked in rounds[1:]) and rounds[-1][0] > 140
    none = retrieval.overfetched(lambda q, k: retrieval.dense_search(q, v, k), q, v.where("label = 7"), 12, top_k=5)[0]
    assert none.count() == 0
