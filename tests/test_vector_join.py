import math
import random

import numpy as np
import pytest

from lodestone.operators import vector_join

SCHEMA = "vec_id long, embedding array<float>, home string, band int"


def rows(r, n=500, dim=8):
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(12)]
    out = [(k, [float(np.float32(x + r.gauss(0, 0.3))) for x in centres[k % 12 if k % 3 else 0]], "x", 1) for k in range(n)]
    out += [(n + k, out[5][1], "x", 1) for k in range(60)]  # copies
    out += [(700, None, "x", 1), (701, [], "x", 1), (702, [0.0] * dim, "x", 1), (703, [float("nan")] * dim, "x", 1), (704, [1.0, None] * 4, "x", 1), (None, out[5][1], "x", 1)]
    return out + [(710, [1.0, 2.0], "x", 1), (711, [2.0, 4.0], "x", 1), (712, [-0.0, 1.0], "x", 1), (713, [0.0, 1.0], "x", 1)]


def classes(data):
    ok = [(k, v) for k, v, *_ in data if k is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    name: dict = {}
    for k, v in ok:
        v = tuple(x + 0.0 for x in v)
        name[v] = min(k, name.get(v, k))
    return name, {k: name[tuple(x + 0.0 for x in v)] for k, v in ok}


def pairs(name, least):
    out, items = {}, sorted((k, np.array(v) / np.linalg.norm(v)) for v, k in name.items())
    for i, (a, x) in enumerate(items):
        for b, y in items[i + 1 :]:
            if len(x) == len(y) and round(float(x @ y), 9) >= least:
                out[a, b] = round(float(x @ y), 6)
    return out


@pytest.mark.parametrize(("least", "pivots", "tile"), [(0.95, None, 512), (0.95, 30, 16), (0.5, 40, 64), (-1.0, 5, 64), (1.0, 20, 512)])
def test_equals_brute_force(spark, monkeypatch, least, pivots, tile):
    monkeypatch.setattr(vector_join, "TILE_ROWS", tile)
    data = rows(random.Random(9))
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    members, found = vector_join.near_duplicates(df, least, pivots=pivots)
    name, member = classes(data)
    assert dict(members.collect()) == member
    got = [(x.a, x.b, round(x.score, 6)) for x in found.collect()]
    assert len(got) == len({g[:2] for g in got})
    assert {g[:2]: g[2] for g in got} == pytest.approx(pairs(name, least), abs=2e-6)


def test_ingest_keeps_what_is_new(spark):
    data = rows(random.Random(4))
    df = spark.createDataFrame(data, SCHEMA)
    held, new = df.where("vec_id % 2 = 0 and vec_id < 700"), df.where("vec_id % 2 = 1 or vec_id >= 700")
    kept = {r.vec_id for r in vector_join.ingest(new, held, 0.98).collect()}
    taken = [r[:2] for r in data if r[0] is not None and r[0] % 2 == 0 and r[0] < 700]
    unit = lambda v: np.array(v) / np.linalg.norm(v)
    want, seen = set(), [unit(v) for _, v in taken]
    for k, v, *_ in sorted((r for r in data if r[0] is not None and (r[0] % 2 == 1 or r[0] >= 700)), key=lambda r: r[0]):
        usable = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        if not usable:
            want.add(k)
            continue
        if not any(len(s) == len(v) and round(float(s @ unit(v)), 9) >= 0.98 for s in seen):
            want.add(k)
        seen.append(unit(v))  # also rows that go hold later ones off
    assert kept - {None} == want


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    members, found = vector_join.near_duplicates(none, 0.9)
    assert members.collect() == [] and found.collect() == []
    assert vector_join.ingest(none, none, 0.9).collect() == []


def test_index_finds_neighbours_of_clustered_vectors_in_few_cells(spark):
    """Vectors around 40 centres: a tenth of the rows is read, a hot cell among them, and nearly all neighbours are found."""
    from pyspark.sql import functions as F

    from lodestone.operators import retrieval, vector_index

    r = np.random.default_rng(3)
    centres = r.normal(size=(40, 16))
    data = [(k, (centres[0 if k % 3 == 0 else k % 40] + 0.2 * r.normal(size=16)).astype(np.float32).tolist()) for k in range(3000)]
    v = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(4).cache()
    q = v.where("vec_id % 60 = 7").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    codes = vector_index.train(v, parts=4, codes=64)
    index = vector_index.build(v, codes).cache()
    assert len(codes.centres) == 55
    truth = retrieval.dense_search(q, v, 10)
    found = vector_index.search(q, index, codes, 10, probes=6, refine=8).withColumnRenamed("id", "vec_id")
    assert retrieval.recall_at(found, truth, 10).agg(F.avg("recall")).first()[0] >= 0.9
    did = vector_index.work(q, index, codes, 6).agg(F.sum("read"), F.sum("total")).first()
    assert did[0] * 4 < did[1]
    none = vector_index.search(q.where("false"), index, codes)
    assert none.columns == found.withColumnRenamed("vec_id", "id").columns and none.collect() == []


def test_vectors_without_clusters_are_compared_in_groups(spark, monkeypatch):
    """Where each row would visit nearly every place, it is sent once a group; places are still taken where angles tell."""
    monkeypatch.setattr(vector_join, "CELL_ROWS", 8)
    monkeypatch.setattr(vector_join, "GROUP_ROWS", (50, 16384))
    monkeypatch.setattr(vector_join, "GROUPS", 8)
    monkeypatch.setattr(vector_join, "TILE_ROWS", 16)
    r = np.random.default_rng(8)
    data = [(k, r.normal(size=16).astype(np.float32).tolist(), "x", 1) for k in range(600)] + [(900, [1.0, 2.0], "x", 1), (901, [2.0, 4.1], "x", 1)]
    df = spark.createDataFrame(data, SCHEMA)
    settled = []
    settle = vector_join.settle
    monkeypatch.setattr(vector_join, "settle", lambda df, what: settled.append((what, settle(df, what))) or settled[-1][1])
    found = {(x.a, x.b): round(x.score, 6) for x in vector_join.near_duplicates(df, 0.35)[1].collect()}
    assert found == pytest.approx(pairs(classes(data)[0], 0.35), abs=2e-6)
    rows = sum(len(t.ids) // 8 for what, x in settled if what == "tiles" for t in x.collect())
    assert rows == 602  # each row lies in one tile


def test_a_batch_of_visits_is_bounded(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(vector_join, "VISITS", 500)
    v = np.random.default_rng(1).normal(size=(2000, 8)).astype(np.float32)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(2000)), pa.array(np.ones(2000, bool)), pa.array(list(v), pa.list_(pa.float32()))], ["id", "fresh", "v"])
    sent = type("Sent", (), {"value": {8: vector_join._unit(v[:100])}})
    out = list(vector_join._place(sent, 1.2)(iter([batch])))
    assert max(b.num_rows for b in out) <= 500 and sum(b.num_rows for b in out) > 2000 * 20
    home = pa.Table.from_batches(out).filter(pa.compute.field("home"))
    assert sorted(home["id"].to_pylist()) == list(range(2000))
