import os
import sqlite3

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions import scalars
from lodestone.operators import documents, evaluation, lifecycle, retrieval, vector_index
from lodestone.sources import readers

SF = "/root/testdata/sf0.01"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
VECS = "vec_id long, embedding array<float>"


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first().x


# --- wrong answers of before


@pytest.mark.parametrize(
    "raw, want",
    [("CC BY-NC 4.0", "CC BY-NC 4.0"), ("cc-by-nd-4.0", "CC-BY-ND-4.0"), ("CC-BY", "CC-BY-4.0"), ("Creative Commons  Zero", "CC0-1.0"), ("apache 2.0", "Apache-2.0"), ("Apache-2.0 WITH exceptions", "Apache-2.0 WITH exceptions"), (" ", None), (None, None)],
)
def test_licences_are_matched_whole(spark, raw, want):
    assert one(spark, scalars.spdx(F.lit(raw).cast("string"))) == want


def test_sections_open_at_markers_alone(spark):
    for text, want in (("# One", True), ("  Table: x", True), ("Figure caption: y", True), ("<!-- image -->", True), ("Table stakes are high", False), ("Abstract thoughts", False), ("", False)):
        assert one(spark, documents.is_boundary(F.lit(text))) is want


def test_trackers_and_hosts():
    url = "HTTPS://Bücher.Example:443/a/../b?utm_source=x&yclid=1&_hsmi=2&q=%20z&ref_=3#top"
    assert scalars.canonical(url, "landing") == "https://xn--bcher-kva.example/b?q=+z"
    assert "yclid=1" in scalars.canonical(url, "index")


def test_tokens_with_spans_and_folded(spark):
    df = spark.createDataFrame([("Straße, it's ﬁne",), (None,)], "text string")
    rows = df.select(scalars.tokens_with_spans("text").alias("s"), scalars.fold_tokens("text").alias("f")).collect()
    assert [(t.token, t.start, t.end) for t in rows[0].s] == [("straße", 0, 6), ("it's", 8, 12), ("ﬁne", 13, 16)]
    assert rows[0].f == ["strasse", "it's", "fine"] and rows[1].s is None and rows[1].f is None


# --- retrieval


def test_ema_reads_the_end_of_a_long_history(spark):
    from lodestone.operators import telemetry

    r = np.random.default_rng(1)
    x = (r.random(3000) < 0.4).astype(float)
    m = 0.75
    for v in x:
        m = max(0.001, min(1.0, 0.2 * v + 0.8 * m))
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(x)] + [("b", 0, 0.0)], "k string, i int, v double")
    got = {r.k: r.ema for r in telemetry.ema(df, "k", "i", "v").collect()}
    assert abs(got["a"] - m) < 1e-12 and abs(got["b"] - 0.6) < 1e-12


def test_dense_search_leaves_out_odd_vectors(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, []), (5, [1.0, 0.0, 0.0]), (6, [2.0, 0.0])], VECS)
    q = spark.createDataFrame([(10, [3.0, 0.0]), (11, None), (12, [0.0, 0.0, 1.0]), (13, [])], "query_id long, vector array<float>")
    for most in (4096, 1):
        got = {(r.query_id, r.vec_id, r["rank"], r.score) for r in retrieval.dense_search(q, v, 2, most_queries=most, block=2).collect()}
        assert got == {(10, 1, 1, 1.0), (10, 6, 2, 1.0), (12, 5, 1, 0.0)}


def test_range_search_falls_back(spark):
    v = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(6)], VECS)
    q = spark.createDataFrame([(0, [1.0, 0.0]), (1, [-1.0, 0.0])], "query_id long, vector array<float>")
    got = [(r.query_id, r.vec_id, r["rank"], r.fell_back) for r in retrieval.range_search(q, v, 0.9, 2, 1).orderBy("query_id", "rank").collect()]
    assert got == [(0, 5, 1, False), (0, 4, 2, False), (1, 0, 1, True)]
    assert [retrieval.planned_k(*a) for a in ((10,), (100,), (10, 0.1), (10, 0.0), (0, 1.0, 1))] == [50, 150, 150, 10_000, 2]
    assert retrieval.planned_k(10, 1.0, 50, least=77) == 77 and retrieval.blended_rate(1.0, 0.0) == 0.8 and retrieval.blended_rate(0.001, -1) == 0.001


def test_hybrid_equals_a_plain_version(spark):
    r = np.random.default_rng(5)
    words = [f"t{i}" for i in range(30)]
    docs = [(i, " ".join(r.choice(words, 12)), "en" if i % 3 else "fr") for i in range(40)]
    docs += [(40, docs[0][1], "en"), (41, "", "en"), (42, None, "en")]
    vecs = {i: r.normal(size=4) for i in range(0, 43, 2)}
    items = [(q, " ".join(r.choice(words, 4)), r.normal(size=4).tolist()) for q in range(5)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    v = spark.createDataFrame([(i, x.tolist()) for i, x in vecs.items()], "doc_id long, vector array<double>")
    q = spark.createDataFrame(items, "query_id long, text string, vector array<double>")

    def plain(filters):
        out = {}
        kept = [d for d in docs if not filters or d[2] in filters]
        for qid, text, x in items:
            ranks = []
            for weigh in (lambda tf, top: 1 + np.log1p(tf), lambda tf, top: np.log1p(tf) * (0.5 + tf / top)):
                count = lambda t: {w: t.split().count(w) for w in set(t.split())}
                a, scores = count(text), []
                for d, t, _ in kept:
                    b = count(t or "")
                    s = sum(weigh(a[w], max(a.values())) * weigh(b[w], max(b.values())) for w in a if w in b)
                    if s > 0:
                        scores.append((-round(s, 9), d))
                ranks.append([d for _, d in sorted(scores)[:50]])
            ids = {d for d, _, _ in kept}
            ranks.append([d for _, d in sorted((-round(float(np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y)), 9), d) for d, y in vecs.items() if d in ids)[:50]])
            fused = {}
            for rank in ranks:
                for i, d in enumerate(rank, 1):
                    fused[d] = fused.get(d, 0) + 1 / (60 + i)
            best = sorted(((-round(s, 12), d) for d, s in fused.items()))
            out[qid] = [(d, -s) for s, d in best]
        return out

    for filters in (None, ["fr"]):
        got = {}
        for row in retrieval.hybrid(q, df, k=7, vectors=v, filters={"lang": filters} if filters else None).orderBy("query_id", "fused_rank").collect():
            got.setdefault(row.query_id, []).append((row.doc_id, row.score))
        want = plain(filters)
        assert {k: [d for d, _ in x] for k, x in got.items()} == {k: [d for d, _ in x[:7]] for k, x in want.items()}

    diverse = {}
    for row in retrieval.hybrid(q, df, k=6, vectors=v, diversify=True).orderBy("query_id", "mmr_rank").collect():
        diverse.setdefault(row.query_id, []).append(row.doc_id)
    for qid, rows in plain(None).items():
        left, chosen = list(rows[:200]), []
        unit = lambda d: vecs[d] / np.linalg.norm(vecs[d]) if d in vecs else np.zeros(4)
        while len(chosen) < 6:
            gain = [0.6 * s - 0.4 * (max(float(unit(d) @ unit(c)) for c in chosen) if chosen else 0.0) for d, s in left]
            chosen.append(left.pop(int(np.argmax(gain)))[0])
        assert diverse[qid] == chosen


# --- vector index


@tables
@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_registered_indexes_have_the_recall_asked_for(spark, sf):
    from lodestone.plans import catalogue

    truth = catalogue.QUERIES["dense_search"](spark, sf)
    found = catalogue.QUERIES["probe_search"](spark, sf)
    assert retrieval.recall_at(found, truth, 10).agg(F.avg("recall")).first()[0] >= 0.9
    found = catalogue.QUERIES["index_search"](spark, sf).withColumnRenamed("id", "vec_id")
    assert retrieval.recall_at(found, truth, 10).agg(F.avg("recall")).first()[0] >= 0.9
    hits = catalogue.QUERIES["perturbed_hits"](spark, sf).first()
    assert hits.share >= evaluation.GATES["perturb_top3"]


def test_index_survives_a_round_trip(spark, tmp_path):
    r = np.random.default_rng(2)
    v = spark.createDataFrame([(i, r.normal(size=8).tolist(), i % 2) for i in range(300)] + [(300, None, 0), (301, [1.0], 1)], "vec_id long, embedding array<float>, ns int")
    codes = vector_index.train(v, cells=6, parts=4, codes=16)
    index = vector_index.build(v, codes, namespace="ns")
    vector_index.save(index, codes, str(tmp_path / "i"))
    rows, back = vector_index.load(spark, str(tmp_path / "i"))
    assert rows.count() == 300 and np.allclose(back.books, codes.books)
    q = evaluation.sampled(v.where("size(embedding) = 8"), 50)
    a = vector_index.search(q, index, codes, 5, probes=6, namespace="0").collect()
    b = vector_index.search(q, rows, back, 5, probes=6, namespace="0").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and {r.id % 2 for r in a} == {0}
    x = np.array([r.vector for r in rows.orderBy("id").collect()])
    cell, code = codes.encode(vector_index._unit(list(x)))
    assert np.linalg.norm(codes.decode(cell, code) - vector_index._unit(list(x)), axis=1).mean() < 0.6
    assert vector_index.infer_dim(v) == 8 and vector_index.infer_dim(v.where("vec_id = 300")) is None


def test_gates_and_calibration(spark):
    r = np.random.default_rng(3)
    v = spark.createDataFrame([(i, r.normal(size=6).tolist()) for i in range(120)], VECS)
    got = evaluation.calibrate(v, lambda q, k: retrieval.dense_search(q, v, k), [5, 10], 20).orderBy("oversample").collect()
    assert [(g.oversample, g.recall) for g in got] == [(5, 1.0), (10, 1.0)]
    m = spark.createDataFrame([("self_hit", 1.0), ("recall_at_10", 0.5)], "name string, share double")
    assert {(g.name, g.passed) for g in evaluation.gates(m).collect()} == {("self_hit", True), ("recall_at_10", False)}


# --- readers


def test_footers_splits_and_batches(spark, tmp_path):
    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    path = str(tmp_path / "t")
    df.repartition(3).write.parquet(path)
    assert readers.count_footers(spark, path) == 1000
    told = readers.footers(spark, spark.read.parquet(path)).collect()
    assert len(told) == 3 and sum(t["rows"] for t in told) == 1000 and all(t["row_groups"] == 1 for t in told)
    wrong = [r[0] for r in readers.problems(spark, path, T.StructType().add("id", "long").add("x", "string").add("y", "long"), ("no.such.key",)).collect()]
    assert wrong[:2] == ["x: bigint, not string", "y: missing, not bigint"] and sum("no.such.key" in w for w in wrong) == 3
    assert [t.num_rows for t in readers.batches(spark.read.parquet(path), 300)] == [300, 300, 300, 100]
    assert readers.head(df, 4).num_rows == 4 and readers.from_arrow(spark, readers.head(df, 4)).count() == 4
    assert [r.id for r in readers.rows_between(df, 5, 8, "id").collect()] == [5, 6, 7]
    lines = str(tmp_path / "l")
    df.write.json(lines)
    assert readers.splits(spark, lines).count() >= 1
    assert readers.read_rows(spark, str(tmp_path / "t")).count() == 1000


def test_entries_of_earlier_runs(spark, tmp_path):
    schema = T.StructType().add("item_id", "long").add("status", "string")
    with sqlite3.connect(tmp_path / "m.db") as con:
        con.execute("CREATE TABLE manifest (item_id INTEGER, status TEXT)")
        con.executemany("INSERT INTO manifest VALUES (?, ?)", [(1, "success"), (2, None)])
    spark.createDataFrame([(3, "skip")], schema).write.json(str(tmp_path / "j"))
    spark.createDataFrame([(4, "failure")], schema).write.option("header", True).csv(str(tmp_path / "c"))
    got = readers.previous_entries(spark, schema, str(tmp_path / "j"), str(tmp_path / "c"), (str(tmp_path / "m.db"), "manifest"))
    assert {tuple(r) for r in got.collect()} == {(1, "success", "sqlite"), (2, None, "sqlite"), (3, "skip", "jsonl"), (4, "failure", "csv")}
    assert readers.previous_entries(spark, schema).count() == 0


def test_evaluation_set_and_panels(spark, tmp_path):
    path = tmp_path / "e.jsonl"
    path.write_text('{"document": {"doc_id": "d1", "namespace": "n", "metadata": {"a": "b"}}, "queries": [{"query": "q", "expected_doc_id": "d1"}]}\n{"queries": []}\n')
    docs, asked = readers.read_evaluation(spark, str(path))
    assert [r.doc_id for r in docs.collect()] == ["d1"] and [r.query for r in asked.collect()] == ["q"]
    g = spark.createDataFrame([("a", 2)], "host string, n long")
    assert readers.dashboard(g, "x", ["host"]).first().line == '{"host":"a","n":2}'
    assert readers.dashboard(g, "x", ["host"], "panel").first().line == '{"title":"n","target":"x_n"}'


def test_a_copy_that_changed_is_refused(spark, tmp_path):
    said = readers.backup(spark.range(10), str(tmp_path / "b"))
    assert readers.recover(spark, str(tmp_path / "b"), said).count() == 10
    with pytest.raises(ValueError):
        readers.recover(spark, str(tmp_path / "b"), {**said, "rows": 9})


# --- documents and state


def test_image_summary(spark):
    kind = "doc_id long, chunk int, text string, images array<struct<captioned:boolean,classified:boolean,confidence:double,classes:array<struct<label:string,confidence:double>>>>"
    df = spark.createDataFrame([(1, 0, "see Table: x", []), (1, 1, "plain", [(True, False, 0.2, [("map", 0.9), (None, 0.1)])]), (2, 0, " <!-- image --> z", [(False, False, None, [])])], kind)
    got = {(r.doc_id, r.chunk): (r.has_caption, r.has_classification, r.num_images, r.confidence, r.labels) for r in documents.image_summary(df).collect()}
    assert got == {(1, 0): (True, False, 0, None, []), (1, 1): (True, True, 1, 0.9, ["map"]), (2, 0): (True, False, 1, None, [])}


def test_sanitiser_profiles(spark):
    html = "<meta name=x><p onclick=\"x()\" id=a>a<SCRIPT>evil()\n</SCRIPT><!-- c --><style>p {}</style><nav>n</nav><iframe src=y>z</iframe><link rel='stylesheet' href=s></p>"
    got = {p: one(spark, documents.sanitised(F.lit(html), p)) for p in documents.PROFILES}
    assert got["permissive"] == html
    assert got["balanced"] == "<meta name=x><p onclick=\"x()\" id=a>a<!-- c --><nav>n</nav><iframe src=y>z</iframe><link rel='stylesheet' href=s></p>"
    assert got["strict"] == "<p id=a>a<nav>n</nav></p>"


def test_rotation_keeps_parts_full(spark):
    df = spark.createDataFrame([(i * i,) for i in range(1003)], "seq long")
    sizes = {r.part: r["count"] for r in lifecycle.rotate(df, 100).groupBy("part").count().collect()}
    assert sizes == {**{k: 100 for k in range(10)}, 10: 3}
    assert lifecycle.rotate(df.limit(0), 100).count() == 0


def test_backoff_grows_to_its_bound(spark):
    assert [one(spark, lifecycle.backoff(F.lit(n))) for n in (0, 1, 2, 3, 20)] == [60.0, 60.0, 120.0, 240.0, 3600.0]


def test_stream_counters_write_what_each_batch_adds(spark, tmp_path):
    from lodestone.streaming import timers

    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    for i, keys in enumerate(("aab", "ac", "bbb")):
        (src / f"{i}.json").write_text("".join(f'{{"k": "{k}"}}\n' for k in keys))
        stream = timers.counter_deltas(spark.readStream.schema("k string").json(str(src)), ["k"])
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
        q.awaitTermination(60)
    got = sorted((r.k, r.total, r.added) for r in spark.read.parquet(out).collect())
    assert got == [("a", 2, 2), ("a", 3, 1), ("b", 1, 1), ("b", 4, 3), ("c", 1, 1)]
