import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import hardnegatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, i long, lane long, score string"


def brute(rows, is_anchor, positives=5, negatives=5, scale=256):
    ok = [(k, [math.floor(scale * float(np.float32(x))) for x in v], y) for k, v, y, *_ in rows if None not in (k, v, y) and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, x, y in ok:
        if not is_anchor(q):
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, v)), k, z == y) for k, v, z in ok)
        for s, p, _ in [r for r in scored if r[2] and r[1] != q][:positives]:
            inside = [(r[1], -r[0]) for r in scored if not r[2] and 80 * -s <= 100 * -r[0] <= 100 * -s][:negatives]
            out += [(q, p, k + 1, n, -s, t) for k, (n, t) in enumerate(inside)]
    return sorted(out)


def rows(r, n=400, dim=10):
    out = [(k, [r.choice([-1.0, -0.5, 0.0, 0.3, 1.0]) for _ in range(dim)], 1 if r.random() < 0.4 else r.randrange(5), 7, 7, "x") for k in range(n)]
    out += [(n + k, out[20][1], 1, 7, 7, "x") for k in range(40)]  # copies of an anchor's vector
    out += [(n + 100 + k, out[20][1], 3, 7, 7, "x") for k in range(40)]
    odd = [None, [float("nan")] * dim, [1.0, None] * (dim // 2), [float("inf")] * dim]
    out += [(1000 + k, v, 1, 7, 7, "x") for k, v in enumerate(odd)] + [(1020, [1.0] * dim, None, 7, 7, "x"), (None, [1.0] * dim, 1, 7, 7, "x")]
    return out + [(1040, [], 1, 7, 7, "x"), (1041, [1.0, 1.0], 2, 7, 7, "x"), (1060, [0.5] * (dim + 3), 4, 7, 7, "x")]


@pytest.mark.parametrize(("tile", "anchors", "chunk"), [(16, 4, 3), (1024, 256, 32)])
def test_equals_brute_force(spark, tile, anchors, chunk):
    data = rows(random.Random(8))
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = hn.mine(df, F.col("vec_id") % 20 == 0, tile_rows=tile, anchor_rows=anchors, chunk=chunk)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute(data, lambda k: k % 20 == 0)


def test_many_labels_of_few_rows(spark):
    r = random.Random(3)
    data = [(k, [r.random() for _ in range(4)], k // 2, 7, 7, "x") for k in range(120)]
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    got = hn.mine(df, F.col("vec_id") % 10 == 0, tile_rows=16, anchor_rows=8, chunk=2)
    assert sorted(map(tuple, got.collect())) == brute(data, lambda k: k % 10 == 0)


def test_scores_beyond_64_bits_are_held(spark):
    data = [(0, [2.0**50, 1.0], 1), (1, [2.0**50, 3.0], 1), (2, [2.0**50, 9.0], 2)]
    got = hn.mine(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int"), F.col("vec_id") == 0, chunk=1).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 2**63 - 1, 2**63 - 1)]


def test_partial_sums_pass_through_wide_numbers(spark):
    data = [(0, [2.0**40, 2.0**40], 1), (1, [2.0**40, -(2.0**40) + 2.0], 1), (2, [2.0**40, -(2.0**40) + 2.0], 2)]
    got = hn.mine(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int"), F.col("vec_id") == 0, chunk=1).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 2**57, 2**57)]


def test_no_rows_no_anchors_one_label(spark):
    none = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([(k, [1.0, 2.0], 1, 7, 7, "x") for k in range(9)], SCHEMA)
    assert hn.mine(none, F.lit(True)).collect() == []
    assert hn.mine(one, F.lit(False)).collect() == []
    assert hn.mine(one, F.lit(True)).collect() == []
