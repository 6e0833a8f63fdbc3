import random
import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from lodestone.llm import packing

PATH = P.path("word_bpe_49k.json")


def test_ids_equal_the_tokenizer():
    tok, enc = Tokenizer.from_file(PATH), packing.encoder(PATH)
    odd = ["", "a<|endoftext|>b", "É é ΑΣ ΣΑΣ.", "a\xa0b", "x\x1cy don't I'LL 'S²½ªº__a_b 3d４", "é a ﬁ ĳ Ǆ İstanbul ß ſ", "中文 mixed中", "ͅx ŉ ǰ", "ɏɐ a_b_ __x ×÷", "***&&& %%word###"]
    for t in odd:
        assert enc.ids(t) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


def test_first_fit_equals_plain_search():
    r = random.Random(2)
    for _ in range(30):
        x = sorted((r.randint(1, 100) for _ in range(r.randint(1, 120))), reverse=True)
        room, bins, offsets = [], [], []
        for n in x:
            b = next((i for i, k in enumerate(room) if k >= n), len(room))
            if b == len(room):
                room.append(100)
            bins.append(b)
            offsets.append(100 - room[b])
            room[b] -= n
        assert packing.first_fit(x, 100) == (bins, offsets)


def test_pieces_cover_each_id_once(docs, rows, nothing):
    got = packing.pack(docs, PATH, group_docs=16, keep_ids=True).collect()
    tok = Tokenizer.from_file(PATH)
    want = {}
    for r in rows:
        want.setdefault(r[0], []).append(tok.encode(r[1] or "", add_special_tokens=False).ids + [2])
    assert sum(r.length for r in got) == sum(len(x) for v in want.values() for x in v)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(ids) == r.length and any(x[r.start : r.start + r.length] == ids.tolist() and len(x) == r.doc_tokens for x in want[r.doc_id])
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 4096
    assert packing.pack(nothing, PATH).collect() == []


def test_little_padding_and_rows_without_id(spark):
    r = random.Random(7)
    rows = [(k if k % 3 else None, " ".join(r.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(int(2 ** r.uniform(0, 12))))) for k in range(900)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH, group_docs=200)
    one = got.agg({"length": "sum", "sequence_id": "approx_count_distinct"}).first()
    sequences, groups = got.select("sequence_id").distinct().count(), {s.sequence_id >> 32 for s in got.select("sequence_id").collect()}
    assert one["sum(length)"] / (sequences * 4096) > 0.95
    # rows without doc_id are spread over the groups
    assert {s.sequence_id >> 32 for s in got.filter("doc_id is null").collect()} == groups and len(groups) == 5


def test_equal_rows_are_spread_over_groups(spark):
    """A third of rows without id and text, a third of equal rows: no group is over twice as large as it is meant to be."""
    rows = [(None, None)] * 3000 + [(7, "the same text in all of them")] * 3000 + [(100 + k, f"text {k}") for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = packing.pack(df, PATH, group_docs=500).selectExpr("sequence_id >> 32 AS g").groupBy("g").count().toPandas()["count"]
    assert out.sum() == 9000 and out.max() <= 1000
