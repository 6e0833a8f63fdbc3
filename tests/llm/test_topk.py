import math
import random

from pyspark.sql import functions as F

from lodestone.llm import topk


def test_equals_brute_force_with_ties(spark):
    r = random.Random(4)
    vecs = [(k, [r.choice([-1.0, -0.5, 0.0, 0.3, 1.0]) for _ in range(6)], "x") for k in range(150)]
    vecs += [(200, None, "x"), (201, [float("nan")] * 6, "x"), (202, [1.0, None, 1.0, 1.0, 1.0, 1.0], "x"), (203, [float("inf")] * 6, "x"), (None, [1.0] * 6, "x"), (204, [], "x"), (205, [1.0, 1.0], "x"), (7, vecs[7][1], "x")]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<float>, dim string").repartition(3)
    got = sorted((x.query_id, x.rank, x.vec_id, x.score) for x in topk.search(df, F.col("vec_id") % 20 == 0, k=9, tile_rows=16, fan_in=2).collect())
    whole = [(k, [math.floor(64 * float(x)) for x in __import__("numpy").float32(v)]) for k, v, _ in vecs if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, x in whole:
        if q % 20 == 0:
            s = sorted((-sum(a * b for a, b in zip(x, y)), k) for k, y in whole if k != q)[:9]
            want += [(q, i + 1, k, -v) for i, (v, k) in enumerate(s)]
    assert got == sorted(want)


def test_large_components_stay_exact(spark):
    df = spark.createDataFrame([(0, [2.0**50, 1.0]), (1, [2.0**50, 3.0])], "vec_id long, embedding array<double>")
    assert [r.score for r in topk.search(df, F.col("vec_id") == 0).collect()] == [2**63 - 1]


def test_empty_table(spark):
    assert topk.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).collect() == []
