import re
from collections import defaultdict

from pyspark.sql import functions as F

from lodestone.llm import mixing


def levels(sizes, share=1.5, most=2.0):
    keys = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = [(5, 2, 1)[i % 3] for i in range(len(keys))]
    cap = [most * sizes[k] for k in keys]
    full = set()
    while True:
        left = share * sum(sizes.values()) - sum(cap[i] for i in full)
        open_w = sum(w[i] for i in range(len(keys)) if i not in full)
        t = [cap[i] if i in full else left * w[i] / open_w for i in range(len(keys))]
        more = {i for i in range(len(keys)) if t[i] > cap[i] + 1e-9} - full
        if not more:
            return dict(zip(keys, t))
        full |= more


def test_targets_and_quotas(docs, rows):
    got = mixing.mix(docs, block_docs=4, shard_words=5000).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    want = levels(sizes)
    taken, parts = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        assert len(r.shards) >= -(-r.taken // r.size) if r.size else r.taken == 0
        taken[r.source] += r.taken
        parts[r.source] += bool(r.size and r.taken % r.size)
    for s, t in want.items():
        assert abs(taken[s] - t) <= 1 and parts[s] <= 1
    again = mixing.mix(docs.repartition(2), block_docs=4, shard_words=5000).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken, str(r.shards))
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_materialised_rows_hold_what_is_taken(docs):
    want = {}
    for r in mixing.mix(docs).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.taken
    out = mixing.materialise(docs)
    assert out.columns == docs.columns
    have = defaultdict(int)
    for r in out.collect():
        have[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert r.n_chars == len(r.text)
    assert {k: v for k, v in want.items() if v} == dict(have)


def test_materialise_keeps_columns_named_like_helpers(spark):
    table = [(i if i % 3 else None, f"w{i} x y", "s%d" % (i % 4), 777, f"b{i}", 1.5, i, "t") for i in range(60)]
    df = spark.createDataFrame(table, "doc_id long, text string, source string, size long, b string, target double, rank int, shards string")
    rows = {tuple(r) for r in mixing.materialise(df).collect()}
    assert rows and all(r[3] == 777 and r[4] == f"b{r[6]}" and r[5] == 1.5 and r[7] == "t" for r in rows)
    got = mixing.mix(df).collect()
    assert len(got) == 60 and {r.size for r in got} == {3} and {r.b for r in got} == {f"b{i}" for i in range(60)}


def test_split_keeps_quotas(spark):
    q = spark.createDataFrame([([17, 0, 5, 120],)], "q array<long>")
    got = mixing.split_quotas(q, 3).collect()
    assert len(got) == 8 and [sum(r.q[i] for r in got) for i in range(4)] == [17, 0, 5, 120]
    sums = [sum(r.q) for r in got]
    assert max(sums) - min(sums) <= 1 and min(min(r.q) for r in got) >= 0


def test_a_deep_tree_keeps_quotas(spark):
    got = mixing.split_quotas(spark.createDataFrame([([300, 41, 1],)], "q array<long>"), 8).collect()
    assert len({r.shard for r in got}) == 256 and [sum(r.q[i] for r in got) for i in range(3)] == [300, 41, 1]


def test_draws_follow_the_distribution(spark):
    for total, good, draws in ((10, 4, 5), (500, 180, 250), (7, 7, 3), (5, 0, 2), (2, 1, 1)):
        x = mixing.hypergeometric(F.lit(total), F.lit(good), F.lit(draws), mixing._uniform(F.lit(1), "id"))
        r = spark.range(3000).select(x.alias("x")).agg(F.avg("x").alias("m"), F.min("x").alias("a"), F.max("x").alias("b")).first()
        var = draws * good / total * (1 - good / total) * (total - draws) / (total - 1)
        assert abs(r.m - draws * good / total) <= 5 * (var / 3000) ** 0.5 and r.a >= max(0, draws + good - total) and r.b <= min(good, draws)


def test_empty_table(nothing):
    assert mixing.mix(nothing).collect() == [] and mixing.materialise(nothing).collect() == []
