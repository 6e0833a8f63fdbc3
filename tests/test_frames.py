import random

from pyspark.sql import functions as F

from lodestone.operators import frames

SCHEMA = "k string, t long, v long, id int"


def table(spark, n=3000, seed=1):
    r = random.Random(seed)
    rows = [("hot" if r.random() < 0.9 else r.choice(["a", "b", None]), r.randrange(2000) if i % 50 else 7, r.choice([None, 1, 5, -2, 2**40]), i) for i in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(6)


def test_recent_and_running_sums(spark):
    rows, df = table(spark)
    add = lambda xs: sum(x for x in xs if x is not None)
    got = {x.id: (x.k, x.t, x.v, x.recent) for x in frames.recent_sum(df, ["k"], "t", "v", 60).collect()}
    assert len(got) == len(rows)
    for k, t, v, i in rows[::37]:
        assert got[i] == (k, t, v, add(b for a, s, b, _ in rows if a == k and t - 60 <= s <= t)) or got[i][3] is None
    run = {x.id: x.running for x in frames.running_sum(df, ["k"], "t", "v").collect()}
    for k, t, _, i in rows[::41]:
        assert (run[i] or 0) == add(b for a, s, b, _ in rows if a == k and s <= t)


def test_as_of_takes_the_last_row_before(spark):
    rows, df = table(spark)
    right, r_df = table(spark, 700, 2)
    got = {x.id: (x.rid, x.rv) for x in frames.as_of(df, r_df.select("k", "t", F.col("v").alias("rv"), F.col("id").alias("rid")), ["k"], "t", ["rid", "rv"], tie="rid").collect()}
    strict = {x.id: x.rid for x in frames.as_of(df, r_df.select("k", "t", F.col("id").alias("rid")), ["k"], "t", ["rid"], tie="rid", strict=True).collect()}
    for k, t, _, i in rows[::29]:
        best = max(((s, j, b) for a, s, b, j in right if a == k and s <= t), default=None)
        assert got[i] == ((best[1], best[2]) if best else (None, None))
        before = max(((s, j) for a, s, _, j in right if a == k and s < t), default=None)
        assert strict[i] == (before[1] if before else None)


def test_a_hot_key_is_many_ranges(spark):
    _, df = table(spark)
    assert frames.in_ranges(df.where("k = 'hot'"), ["k"], "t").select("__range").distinct().count() >= 1
    assert frames.recent_sum(df.where("false"), ["k"], "t", "v", 5).collect() == []
