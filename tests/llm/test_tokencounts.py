import random

import public_tokenizers as P

from lodestone.llm import tokencounts


def test_edits_equal_counting_anew():
    c = tokencounts.counter(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    r = random.Random(6)
    letters = "ab '\n  1,.stredveml \t éß中''"
    for _ in range(400):
        d = tokencounts.Document("".join(r.choice(letters) for _ in range(r.randint(0, 900))), c)
        for _ in range(5):
            a = r.randint(0, len(d.text))
            b = min(len(d.text), a + r.choice([0, 0, 1, 3, 60]))
            new = "".join(r.choice(letters) for _ in range(r.choice([0, 1, 2, 9, 3000])))
            want = d.text[:a] + new + d.text[b:]
            d.edit(a, b, new)
            assert d.text == want and d.tree.total == len(c.bpe.encode_ordinary(want))


def test_query_rows(docs, rows, nothing):
    c = tokencounts.counter(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    got = tokencounts.counts(docs.withColumn("edits", tokencounts.some_edits()), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    assert len(got) == len(rows)
    want = {}
    for r in rows:
        t = r[1] or ""
        n = len(t)
        tail = int(n - n / 100)
        e = t[: n // 4] + " (as edited) " + t[n // 4 : n // 2] + t[n // 2 + n // 50 : tail] + " It's the end." if r[1] is not None else t
        want.setdefault(r[0], []).append((n, len(c.bpe.encode_ordinary(t)), len(e), len(c.bpe.encode_ordinary(e))))
    for r in got:
        assert (r.n_chars, r.n_tokens, r.edited_chars, r.edited_tokens) in want[r.doc_id]
    assert tokencounts.counts(nothing.withColumn("edits", tokencounts.some_edits()), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect() == []


def test_odd_edits(spark):
    df = spark.createDataFrame([(1, "hello world", [(20, 30, "x"), (3, None, None), None, (0, 5, "AB"), (2, 4, "C")]), (2, None, None)], "doc_id long, text string, edits array<struct<start:int,stop:int,text:string>>")
    got = {r.doc_id: r for r in tokencounts.counts(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()}
    assert got[1].edited_chars == len("AB" + "C" + " world" + "x") and got[2].edited_tokens == 0


def test_one_very_long_pre_token():
    c = tokencounts.counter(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    d = tokencounts.Document("ab" * 15_000, c)
    for a, b, new in ((0, 0, "x"), (10_000, 10_003, "yz"), (29_000, 30_000, ""), (5, 5, " ")):
        want = d.text[:a] + new + d.text[b:]
        d.edit(a, b, new)
        assert d.text == want and d.tree.total == len(c.bpe.encode_ordinary(want))
