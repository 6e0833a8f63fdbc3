import math
import random

import pytest
from pyspark.sql import functions as F

from lodestone.functions import percentiles

RULES = {"a": ("linear", 0.95), "b": ("index_floor", 0.5), "c": ("nearest", 0.95), "d": ("index_span", 0.99), "e": ("middle", 0.5), "f": ("inclusive", 0.331), "g": ("nearest", 0.0), "h": ("nearest", 1.0), "i": ("linear", 1.0)}


def want(values):
    x, n = sorted(values, key=lambda v: (math.isnan(v), v)), len(values)

    def between(p):
        at = (n - 1) * p
        lo, share = math.floor(at), at - math.floor(at)
        return float(x[lo]) if not share else x[lo] * (1 - share) + x[lo + 1] * share

    return between(0.95), x[int(n * 0.5)], x[max(math.ceil(0.95 * n) - 1, 0)], x[int(0.99 * (n - 1))], x[n // 2], between(0.34), x[0], x[-1], float(x[-1])


@pytest.mark.parametrize("kind", ["long", "double", "int"])
def test_rules_equal_sorted_lists(spark, kind):
    r = random.Random(1)
    draw = {"long": lambda: r.choice([r.randrange(-(2**63), 2**63), r.randrange(100), 2**62, 2**62 + 1]), "double": lambda: r.choice([r.gauss(0, 1), r.gauss(0, 1) * 1e300, 1e-300 * r.random(), 0.0, 1.5]), "int": lambda: r.randrange(50)}[kind]
    groups = {"hot": [draw() for _ in range(3000)], None: [draw() for _ in range(40)], "one": [draw()], "same": [draw()] * 9}
    rows = [(k, 1, v, "x") for k, vs in groups.items() for v in vs] + [("nulls", 1, None, "x"), ("hot", 1, None, "x")]
    df = spark.createDataFrame(rows, f"k string, j int, v {kind}, n string").repartition(4)
    got = {x.k: tuple(x[c] for c in RULES) for x in percentiles.order_statistics(df, ["k"], "v", RULES).collect()}
    assert got.keys() == groups.keys()
    for k, vs in groups.items():
        assert got[k] == pytest.approx(want(vs), rel=1e-12)


def test_values_that_are_not_finite(spark):
    values = [float("-inf"), -1e308, -3.0, 0.0, 2.0, 1e308, float("inf"), float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    out = percentiles.select_ranks(df, [], "v", {f"r{i}": F.lit(i) for i in range(9)}).first()
    assert [repr(out[f"r{i}"]) for i in range(9)] == [repr(v) for v in values]


def test_past_the_end_is_null_or_clamped(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    assert percentiles.by_index(df, ["k"], "v", {"p": 1.0}).first().p is None
    assert percentiles.by_index(df, ["k"], "v", {"p": 1.0}, clamp=True).first().p == 2
    assert percentiles.by_index(df.where("false"), ["k"], "v", {"p": 0.5}).collect() == []
