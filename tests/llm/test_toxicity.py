import random
import zlib

import numpy as np
import pytest

from lodestone.llm import toxicity


@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(8)
    bad = ["moron", "scum", "loweiab", "loweicd", "loweief", "trash"]
    out = []
    for k in range(600):
        toxic = k % 5 == 0
        w = ["".join(r.choice("aeioutnrsl") for _ in range(r.randint(2, 8))) for _ in range(80)]
        for _ in range(4 * toxic):
            w[r.randrange(80)] = r.choice(bad)
        out.append((k, " ".join(w) + ".", int(toxic), 0.3))
    return out


def test_held_out_accuracy_and_odd_texts(spark, labelled):
    docs = spark.createDataFrame([(k, t, s) for k, t, _, s in labelled], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(k, y) for k, _, y, _ in labelled] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model, with_spans=True).collect()}
    held = [(k, y) for k, _, y, _ in labelled if zlib.crc32(str(k).encode()) % 3 == 1]  # none of these was learnt from
    assert len(held) > 150 and np.mean([got[k].predicted == y for k, y in held]) > 0.97
    assert np.mean([got[k].score for k, y in held if y]) > np.mean([got[k].score for k, y in held if not y]) + 0.5
    for k, t, y, _ in labelled[:50]:
        for s in got[k].spans:
            assert t.encode()[s.start : s.end].decode() in t.split() or t.encode()[s.start : s.end].decode() + "." in t.split()
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "..."), (None, "x"), (4, "a " * 50000), (4, "a " * 50000)], "doc_id long, text string")
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == 6 and all(0 <= r.score < 0.7 for r in rows)
    assert len({r.score for r in rows}) == 1  # without toxic words, and without words, the same
    assert toxicity.score(odd.limit(0), model).collect() == []


def test_without_labels_of_both_kinds(spark):
    docs = spark.createDataFrame([(2, "fine words")], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(docs, model).first().predicted == 0


def test_marginals_equal_enumeration():
    g = np.random.default_rng(1)
    crf = toxicity.Crf(np.zeros(2, np.float32), 0.0, np.log([[0.9, 0.1], [0.4, 0.6]]), np.log([0.8, 0.2]))
    score = g.normal(size=5)
    w = toxicity.Words(*(np.zeros(5, int) for _ in range(3)), np.zeros(5, int), np.arange(5), np.zeros((1, 5), int))
    p, pairs = toxicity.forward_backward(score, w, crf, True)
    total, mass, two = 0.0, np.zeros(5), np.zeros((2, 2))
    for k in range(32):
        y = [(k >> i) & 1 for i in range(5)]
        v = np.exp(crf.first[y[0]] + sum(score[i] * y[i] for i in range(5)) + sum(crf.trans[y[i], y[i + 1]] for i in range(4)))
        total += v
        mass += v * np.array(y)
        for i in range(4):
            two[y[i], y[i + 1]] += v
    assert np.allclose(p, mass / total) and np.allclose(pairs, two / total)
