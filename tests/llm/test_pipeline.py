import random
import re
from collections import defaultdict

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_line_dedup(rows, least=10):
    """Texts by doc_id, less the lines in runs of any length that start earlier too."""
    places = defaultdict(list)
    for key, text in sorted(rows.items()):
        ls = (text or "").split("\n")
        full = [i for i, x in enumerate(ls) if WORD.search(x)]
        for o in range(len(full)):
            for e in range(o + 1, len(full) + 1):
                if sum(len(WORD.findall(ls[i])) for i in full[o:e]) >= least:
                    places[tuple(ls[i] for i in full[o:e])].append((key, full[o], full[e - 1]))
    gone = defaultdict(set)
    for found in places.values():
        for key, a, b in found[1:]:
            gone[key] |= set(range(a, b + 1))
    kept = {k: "\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in gone[k]) for k, t in rows.items()}
    return {k: t for k, t in kept.items() if not gone[k] or WORD.search(t)}


def plain_groups(rows):
    """The smallest doc_id of each document's group by word shingles."""
    sets = {}
    for k, t in rows.items():
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {k: k for k in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {k: find(k) for k in rows}


def texts(df):
    return {r.doc_id: r.text for r in df.collect() if r.doc_id is not None}


def test_stages_equal_plain_versions(spark, tmp_path, docs):
    d = str(tmp_path)
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k % 7 == 0)) for k in range(1, 60)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    got, columns = spark.read.parquet(f"{d}/documents.parquet"), ["doc_id", "text", "lang", "source", "n_chars"]
    assert len(corpus_pipeline.STAGES) == 5
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = got
        got = stage(spark, before, d)
        got.write.parquet(f"{d}/stage{k}")
        got = spark.read.parquet(f"{d}/stage{k}")
        if k < 4:
            assert got.columns == columns, name
        if k == 1:
            want = plain_line_dedup(texts(before))
            assert {a: b or "" for a, b in texts(got).items()} == want
        if k == 2:
            groups = plain_groups(texts(before))
            assert {r.doc_id for r in got.collect() if r.doc_id is not None} == {a for a, b in groups.items() if a == b}
        if k == 3:
            size = lambda df: sum(len(WORD.findall(r.text or "")) for r in df.collect())
            assert abs(size(got) - 1.5 * size(before)) <= 10
            whole = texts(before)
            assert all((whole[r.doc_id] or "").startswith(r.text) for r in got.collect() if r.doc_id is not None)
        if k == 4:
            ends = got.groupBy("sequence_id").agg({"length": "sum", "offset": "min"}).collect()
            assert all(r["sum(length)"] <= 4096 and r["min(offset)"] == 0 for r in ends)


def test_toxic_documents_go_and_clean_ones_stay(spark, tmp_path):
    r = random.Random(11)
    d, bad = str(tmp_path), ["vexgrol", "drumblat", "skorvid", "plenzak"]
    rows = []
    for k in range(600):
        w = ["".join(r.choice("aeioutnrsl") for _ in range(r.randint(2, 8))) for _ in range(80)]
        for _ in range(4 * (k % 5 == 0)):
            w[r.randrange(80)] = r.choice(bad)
        rows.append((k, " ".join(w) + "."))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(400)], "doc_id long, toxic int").write.parquet(f"{d}/labels.parquet")
    kept = set(texts(corpus_pipeline.not_toxic(spark, df, d)))
    assert len(kept & {k for k in range(600) if k % 5 == 0}) <= 3 and len(kept) >= 477
