import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from lodestone.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    " ", "  ", "a ", " a", "a  b", "▁", "▁▁", "a▁b ▁ c", "▁a", "\n\n x\ty \r\n", "  　", "nul\0 in \0", "<s> </s> <unk>", "0123 45.6e7", "😀 👩‍👩‍👧 x", "中文 テスト", "é é", "ﬁ Ⅳ", " " * 40 + "x" + " " * 17,
    "x" * 5000, "▁" * 33 + "y", "�​",
]


def want(sp, rows):
    out = []
    for key, text in rows:
        ids = sp.encode(text or "", add_bos=True, add_eos=True)
        out.append((key, ids, sp.decode(ids)))
    return sorted(out, key=repr)


def got(df, key="doc_id"):
    return sorted(((r[key], [int.from_bytes(r.ids[k : k + 4], "little") for k in range(0, len(r.ids), 4)], r.decoded) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block", [300, pieces.BLOCK])
def test_equals_the_library(spark, docs, rows, block):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert got(pieces.encode(docs, PATH, block=block)) == want(sp, [(r[0], r[1]) for r in rows])


def test_odd_texts(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = [(f"k{i}", t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "block string, text string").repartition(3)
    assert got(pieces.encode(df, PATH, key="block"), "block") == want(sp, rows)


def test_each_distinct_chunk_is_segmented_once(spark, monkeypatch):
    asked = []

    class Spy:
        def encode(self, chunks, num_threads):
            asked.extend(chunks)
            return [[7]] * len(chunks)

    import pyarrow as pa

    monkeypatch.setattr(pieces, "_plain", lambda model: Spy())
    import numpy as np
    import zstandard

    chunks = ["▁a", "▁bb", "▁ccc"]
    row = lambda block, some: (block, 0, pieces.squeeze(np.array([len(c.encode()) for c in some])), zstandard.compress("".join(some).encode()))
    data = [row(1, chunks), row(2, chunks[::-1]), row(3, ["▁a", "▁d"])]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*data)], ["block", "bucket", "lens", "chars"])
    monkeypatch.setattr(pieces, "tidied", lambda run: run)
    assert [pieces.loosen(b.column(3)[0].as_py()).tolist() for b in pieces._segment(b"")(iter([batch]))] == [[7, 7, 7], [7, 7, 7], [7, 7]]
    assert sorted(asked) == ["▁a", "▁bb", "▁ccc", "▁d"]


def test_models_whose_pieces_cross_markers_take_whole_texts():
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    assert pieces.can_cut(proto.SerializeToString())
    proto.pieces[500].piece = "a▁b"
    assert not pieces.can_cut(proto.SerializeToString())


def test_numbers_come_back():
    import numpy as np

    for x in ([], [0], [1, 2**31, 2**32 - 1, 300]):
        assert pieces.loosen(pieces.squeeze(np.array(x, np.uint32))).tolist() == x


def test_empty_table(spark, nothing):
    assert pieces.encode(nothing, PATH).collect() == []
