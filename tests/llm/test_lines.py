import random
import re
from collections import defaultdict

from lodestone.llm import lines


def brute(rows, least=10):
    docs = {}
    for r in rows:
        key = r[0] if r[0] is not None else ("none", r[1])
        docs[key] = (r[1] or "").split("\n")
    places = defaultdict(list)
    order = sorted(docs, key=lambda k: (isinstance(k, tuple), str(k) if isinstance(k, tuple) else k))
    for key in order:
        ls = docs[key]
        full = [i for i, x in enumerate(ls) if re.search(r"[^\x20\x09-\x0D]", x)]
        for k in range(1, len(full) + 1):
            for o in range(len(full) - k + 1):
                some = [ls[i] for i in full[o : o + k]]
                if sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in some) >= least:
                    places[(k, *some)].append((key, full[o], full[o + k - 1]))
    gone = defaultdict(set)
    for found in places.values():
        for key, a, b in found[1:]:
            gone[key] |= set(range(a, b + 1))
    return {key: "\n".join(x for i, x in enumerate(ls) if i not in gone[key]) for key, ls in docs.items()}, gone


def test_equals_brute_force(docs, rows):
    some = docs.filter("doc_id is not null")
    want, gone = brute([r for r in rows if r[0] is not None])
    out = lines.dedup(some)
    assert out.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    for r in out.collect():
        assert (r.text or "") == want[r.doc_id], r.doc_id
        assert r.n_removed == len(gone[r.doc_id])
        assert r.text is None or r.n_chars == len(r.text)


def test_rows_without_id_stay(docs):
    assert lines.dedup(docs).filter("doc_id is null").count() == 2


def test_empty_table(nothing):
    assert lines.dedup(nothing).collect() == []


def all_lengths(texts, least=10):
    """Lines that go, by doc_id: runs of every length."""
    places = defaultdict(list)
    for key, text in sorted(texts.items()):
        ls = text.split("\n")
        full = [i for i, x in enumerate(ls) if x.strip()]
        for o in range(len(full)):
            for e in range(o + 1, len(full) + 1):
                run = tuple(ls[i] for i in full[o:e])
                if sum(len(x.split()) for x in run) >= least:
                    places[run].append((key, full[o], full[e - 1]))
    gone = defaultdict(set)
    for found in places.values():
        for key, a, b in found[1:]:
            gone[key] |= set(range(a, b + 1))
    return gone


def test_runs_of_every_length(spark):
    r = random.Random(3)
    runs = [[4, 4, 4], [2] * 7, [1] * 15, [3, 3, 60], [60, 3, 3], [1, 12, 1], [5, 4], [1] * 9, [3] * 21]
    fresh = iter(range(10**6))
    line = lambda n: " ".join(f"x{next(fresh)}" for _ in range(n))
    texts = {}
    for k, sizes in enumerate(runs):
        run = [line(n) for n in sizes]
        for copy in range(3):
            texts[10 * k + copy] = "\n".join([line(2), *run[:1], "", *run[1:], line(1)])
    for k in range(100, 160):  # few kinds of lines, so runs overlap and repeat within a text
        texts[k] = "\n".join(r.choice(["a", "b c", "d e f", "", "g h i j"]) for _ in range(r.randrange(1, 30)))
    want = all_lengths(texts)
    assert want[1] and not want[71]
    got = lines.dedup(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    for g in got:
        assert g.n_removed == len(want[g.doc_id]), g.doc_id
        assert g.text == "\n".join(x for i, x in enumerate(texts[g.doc_id].split("\n")) if i not in want[g.doc_id])
