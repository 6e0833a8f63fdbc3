import hashlib
import re

import xxhash

from lodestone.llm import spotsigs as s


def plain_signatures(text):
    """Signatures by the rule in words: a common word with the two content words after it; runs of two words, and the first word alone; else the text."""
    w = re.findall(r"[^\W_]+", text.lower())
    found = set()
    for i, x in enumerate(w):
        if x in s.SPOTS:
            after = [y for y in w[i + 1 :] if y not in s.SPOTS][:2]
            if len(after) == 2:
                found.add(" ".join([x, *after]))
    found |= {" ".join(p) for p in zip(w, w[1:])} | set(w[:1])
    return found or ({text} if text else set())


def jaccard(x, y):
    return len(x & y) / len(x | y) if x and y else float(not x and not y)


def test_walk_equals_a_plain_version(docs, rows):
    """Everything but the hashes is rebuilt here; fingerprints are those of the plain signatures' hashes."""
    got = sorted((tuple(r) for r in s.fingerprints(docs, range_rows=7).collect()), key=str)
    known = sorted((r[0], r[1] or "") for r in rows if r[0] is not None)
    pairs = list(zip(known, known[1:] + known[:1])) + [((None, r[1]), (None, r[1])) for r in rows if r[0] is None]
    hashed = lambda names: "".join(sorted(format(xxhash.xxh32_intdigest(x), "08x") for x in names))
    want = []
    for (d, t), (_, u) in pairs:
        q = len(t) // 4
        e = t[: len(t) - q] + u[:q]
        a, b, c = plain_signatures(t), plain_signatures(e), plain_signatures(u)
        want.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), hashed(a), hashed(b), jaccard(a, b), jaccard(a, c), len(a)))
    assert got == sorted(want, key=str) and len(got) == len(rows)


def test_fingerprints_read_back_and_prune():
    a = s.signatures("the quick brown fox and the lazy dog of a small town with the old red barn")
    assert set(s.parse(s.fingerprint(a)).tolist()) == a
    assert s.likeness(set(), set()) == 1 and s.likeness(a, set()) == 0 and s.likeness(a, a) == 1
    assert s.likeness({1}, {1, 2, 3}, 0.8) == 0 and s.signatures("") == set() and s.signatures("!!") != set()


def test_near_pairs_equal_brute_force(docs, rows):
    got = {(r.a, r.b): round(r.likeness, 9) for r in s.near_pairs(docs).collect()}
    reps = {}
    for r in rows:
        if r[0] is not None and r[1] and (g := frozenset(s.signatures(r[1]))):
            reps[g] = min(r[0], reps.get(g, r[0]))
    want = {}
    for x, a in reps.items():
        for y, b in reps.items():
            if a < b and s.likeness(x, y) >= 0.8:
                want[(a, b)] = round(s.likeness(x, y), 9)
    assert got == want


def test_empty_and_single(spark, nothing):
    assert s.fingerprints(nothing).collect() == []
    one = s.fingerprints(spark.createDataFrame([(3, "the cat sat on the mat")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1


def test_an_edit_across_any_number_of_chains_stays_alike():
    # from no spot to many: the text and its edit differ in one chain, or in none
    for n in range(12):
        text = " ".join([f"m{i} n{i} o{i} p{i} q{i}" for i in range(20)] + [f"the b{i} c{i}" for i in range(n)])
        less = text.replace("the b0", "tho b0")
        a, b = s.signatures(text), s.signatures(less)
        assert s.likeness(a, b) > 0.8, n
        assert s.likeness(a, s.signatures(s.edited(text, "the x of y in z " * 60))) > 0.4, n
    assert s.signatures("one") < s.signatures("one two") < s.signatures("one two three")


def test_near_pairs_across_few_chains(spark):
    text = " ".join([f"m{i} n{i} o{i}" for i in range(30)] + [f"the b{i} c{i}" for i in range(6)])
    docs = spark.createDataFrame([(1, text), (2, text.replace("the b0", "tho b0")), (3, "quite another text")], "doc_id long, text string")
    assert [(r.a, r.b) for r in s.near_pairs(docs).collect()] == [(1, 2)]
