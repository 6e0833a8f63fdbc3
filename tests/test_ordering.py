import random

import pytest
from pyspark.sql import functions as F

from lodestone.functions.ordering import numbered
from lodestone.operators import catalog


@pytest.mark.parametrize("values", ["hashed", "ends", "outlier", "equal", "text"])
def test_numbers_follow_the_order(spark, values):
    r = random.Random(7)
    n = 20_000 if values in ("hashed", "outlier") else 2_000
    make = {"hashed": lambda k: r.randrange(-(2**63), 2**63), "ends": lambda k: r.choice([-(2**63), 2**63 - 1, 0, k]), "outlier": lambda k: 10**15 if k == 5 else k, "equal": lambda k: 4, "text": lambda k: f"t{k % 90}"}[values]
    rows = [(None if k % 10 == 0 else "hot" if k % 10 < 9 else f"k{k % 3}", make(k) if k % 97 else None) for k in range(n)]
    df = spark.createDataFrame(rows, f"k string, v {'string' if values == 'text' else 'long'}").repartition(5)
    out = numbered(df, ["k"], "v").collect()
    by: dict = {}
    for x in out:
        by.setdefault(x.k, []).append((x["at"], x.v))
    assert sum(map(len, by.values())) == n
    for got in by.values():
        got.sort(key=lambda x: x[0])
        assert [a for a, _ in got] == list(range(len(got)))
        assert [v for _, v in got] == sorted((v for _, v in got), key=lambda v: (v is not None, v or (0 if values != "text" else "")))


def test_an_outlier_leaves_the_others_in_many_ranges(spark):
    df = spark.createDataFrame([(10**15 if k == 5 else k,) for k in range(20_000)], "v long").repartition(4)
    assert numbered(df, [], "v").groupBy(F.spark_partition_id()).count().count() >= 1  # runs without overflow
    assert numbered(df.where("false"), [], "v").collect() == []


def triples(r, names):
    edges = [(a, f"p{r.randrange(2)}", b) for a in range(12) for b in range(12) if r.random() < 0.2]
    return [(names[a], p, names[b]) for a, p, b in edges] + [(names[0], "label", "x"), ("iri", "has", names[3])]


def test_graph_hash_does_not_depend_on_labels(spark):
    make = lambda rows: catalog.graph_hash(spark.createDataFrame(rows, "s string, p string, o string")).first()
    one = triples(random.Random(1), [f"_:a{k}" for k in range(12)])
    shuffled = [f"_:z{k}" for k in random.Random(5).sample(range(12), 12)]
    same = triples(random.Random(1), shuffled)
    assert make(one) == make(same + same[:3])
    unlike = [*same[:-1], ("iri", "has", shuffled[4])]
    assert make(unlike).hash != make(one).hash
    assert make([*same, (shuffled[1], "p0", "y")]).hash != make(one).hash
    assert make([("a", "b", "c")]).n_triples == 1
    assert make([("a", "b", "c")]).hash != make([("a", "b", "_:c")]).hash


def test_colours_tell_apart_what_differs_far_away(spark):
    chain = [(f"_:n{k}", "next", f"_:n{k + 1}") for k in range(9)]
    colours = {r.x: r.colour for r in catalog.blank_colours(spark.createDataFrame(chain, "s string, p string, o string")).collect()}
    assert len(set(colours.values())) == 10
    ring = [(f"_:n{k}", "next", f"_:n{(k + 1) % 6}") for k in range(6)]
    assert len({r.colour for r in catalog.blank_colours(spark.createDataFrame(ring, "s string, p string, o string")).collect()}) == 1
    assert catalog.blank_colours(spark.createDataFrame([], "s string, p string, o string")).collect() == []
