import random
import re
from collections import defaultdict

import numpy as np
import pytest

from lodestone.llm import components, jaccard


def words(r, n, pool=4000):
    return ["w" + format(r.randrange(pool), "x") for _ in range(n)]


def brute(rows):
    sets = []
    for doc, text, *_ in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        s = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.append((doc, s))
    reach = {d: d for d, _ in sets if d is not None}

    def root(x):
        while reach[x] != x:
            x = reach[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is None or b is None or not x or not y:
                continue
            k = len(x & y)
            if 100 * k >= 80 * (len(x) + len(y) - k):
                p, q = sorted((root(a), root(b)))
                reach[q] = p
    return sorted(((d, len(s), None if d is None else root(d)) for d, s in sets), key=str)


@pytest.mark.parametrize("most", [64, 2])
def test_components_equal_brute_force(docs, rows, most):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join(docs, tile_most=most).collect()), key=str)
    assert got == brute(rows)


def test_texts_that_share_a_doc_id_keep_their_links(spark):
    r = random.Random(3)
    a, b = (" ".join(words(r, 60)) for _ in range(2))
    table = [(5, a), (5, b), (2, a + " more"), (3, b + " more"), (9, a + " more"), (7, ""), (None, b)]
    got = {(x.doc_id, x.n_shingles): x.component_id for x in jaccard.join(spark.createDataFrame(table, "doc_id long, text string")).collect()}
    assert got == {(d, n): c for d, n, c in brute(table)} and got[3, 57] == 2


def test_long_unrelated_texts_with_a_common_shingle_are_pruned_by_bits():
    g = np.random.default_rng(4)
    sets = [np.unique(np.append(g.integers(0, 1 << 60, 3000), 12345)).astype(np.uint64) for _ in range(200)]
    first = np.concatenate(([0], np.cumsum([len(x) for x in sets])))
    ((_, maps),) = jaccard._by_width(jaccard.bitmaps(np.concatenate(sets), first)).values()
    n = np.diff(first)
    left = sum(int(jaccard.enough(jaccard.bound(maps[k : k + 1], maps[:k], n[k], n[:k]), n[k], n[:k]).sum()) for k in range(1, 200))
    assert left == 0


def test_a_family_that_one_pivot_does_not_hold(spark):
    """A chain of near copies, each like the next alone, and a shingle spread over tiles: found by the rounds in hot shingles."""
    r = random.Random(8)
    common, loose = words(r, 60), words(r, 400, 10**6)
    table = [(100 - k, " ".join(common + loose[2 * k : 2 * k + 8])) for k in range(70)]
    table += [(200 + k, " ".join(common + words(r, 40, 10**6))) for k in range(30)]
    df = spark.createDataFrame(table, "doc_id long, text string")
    want = brute(table)
    for spread in (1 << 18, 20):
        got = sorted(((x.doc_id, x.n_shingles, x.component_id) for x in jaccard.join(df, tile_most=8, spread_at=spread).collect()), key=str)
        assert got == want


def test_empty_table(nothing):
    assert jaccard.join(nothing).collect() == []


def test_keep_one_keeps_columns_and_one_of_each_group(docs, rows):
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    groups = {d: c for d, _, c in brute(rows) if d is not None}
    n = sum(1 for r in rows if r[0] is None or groups[r[0]] == r[0])
    assert kept.count() == n


def test_star_and_chain_components(spark):
    edges = [(1, x) for x in range(2, 40)] + [(100 + i, 101 + i) for i in range(30)] + [(5, 5)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[x] == 1 for x in range(1, 40)) and all(got[x] == 100 for x in range(100, 131))


def test_bound_never_under_the_overlap():
    g = np.random.default_rng(1)
    for _ in range(50):
        x, y = (np.unique(g.integers(0, 3000, n)).astype(np.uint64) << np.uint64(20) for n in g.integers(1, 900, 2))
        h, first = np.concatenate((x, y)), np.array([0, len(x), len(x) + len(y)])
        a, b = (np.frombuffer(m, np.uint8)[None] for m in jaccard.bitmaps(h, first))
        assert jaccard.bound(a, b, np.array([len(x)]), np.array([len(y)]))[0] >= len(np.intersect1d(x, y))


def test_tiles_list_each_pair_of_like_size():
    g = np.random.default_rng(2)
    h, node, size = g.integers(0, 20, 200).astype(np.uint64), g.integers(0, 60, 200).astype(np.uint64), np.zeros(200, np.int32)
    size[:] = (node * 3 + 10).astype(np.int32)
    a, b, hot = jaccard.tile_pairs(h, node, size, 1000)
    want = set()
    by = defaultdict(set)
    for k, n in zip(h, node):
        by[k].add(int(n))
    for s in by.values():
        want |= {(x, y) for x in s for y in s if x < y and 100 * (x * 3 + 10) >= 80 * (y * 3 + 10)}
    assert set(zip(a.tolist(), b.tolist())) == want and not len(hot)
