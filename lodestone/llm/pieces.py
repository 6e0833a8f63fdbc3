"""SentencePiece encoding and decoding by a table of distinct chunks.

A text is normalised as the model asks and cut before each run of white-space markers, which no piece crosses. Blocks of some megabytes
of text become numbers of their own distinct chunks, frequent ones small, and are written once, in buckets by block. The distinct
chunks of all blocks are dealt by hash: what is equal meets in one group, where it is segmented once; the ids go back to each
block that asked, which joins them by position and decodes whole texts. Neither texts nor occurrences of chunks are shuffled.
"""

from __future__ import annotations

import itertools
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, settle_buckets, tidied

#: White space as the library marks it in pieces and normalised texts.
MARK = "▁"
#: Bytes of text of one block, after which it is closed.
BLOCK = 16 << 20
#: Bytes of text to a group of distinct chunks.
GROUP = 128 << 20
#: Bytes of texts that one batch of results holds.
RESULT = 4 << 20
CUT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def _proto(model: bytes):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    return proto


def can_cut(model: bytes) -> bool:
    """Whether no piece of the model goes on with a marker after another character, so that texts may be cut before markers."""
    proto = _proto(model)
    if proto.trainer_spec.model_type not in (1, 2) or proto.trainer_spec.treat_whitespace_as_suffix or not proto.normalizer_spec.escape_whitespaces:
        return False
    pieces = {p.piece for p in proto.pieces if p.type in (1, 4, 5)}
    return (MARK in pieces or proto.trainer_spec.byte_fallback) and not any(MARK in p.lstrip(MARK) for p in pieces)


@lru_cache(maxsize=2)
def _whole(model: bytes):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_proto=model)


@lru_cache(maxsize=2)
def _plain(model: bytes):
    """The model for texts that are normalised already: nothing is put before them, taken from them or mapped."""
    from sentencepiece import SentencePieceProcessor

    proto = _proto(model)
    spec = proto.normalizer_spec
    spec.name, spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces = "identity", b"", False, False
    return SentencePieceProcessor(model_proto=proto.SerializeToString())


def squeeze(numbers: np.ndarray) -> bytes:
    """Numbers below 2**32 as their first bytes, then their second, and so on, compressed."""
    return zstandard.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def loosen(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(4, -1).T).view("<u4").ravel()


class _Numbers(dict):
    def __missing__(self, chunk: str) -> int:
        n = self[chunk] = len(self)
        return n


def _blocks(model: bytes, groups: int, block: int, key_type: pa.DataType):
    """(key, text) -> one row a block: keys, chunks a text, chunk numbers, the group of each chunk, and the chunks asked of each group."""
    cut = CUT.findall if can_cut(model) else (lambda x: [x] if x else [])
    request = pa.list_(pa.struct([("bucket", pa.int64()), ("lens", pa.binary()), ("chars", pa.binary())]))
    schema = pa.schema([("block", pa.int64()), ("keys", pa.list_(key_type)), ("counts", pa.binary()), ("codes", pa.binary()), ("buckets", pa.binary()), ("asks", request)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        keys, counts, codes, numbers, size = [], [], array("I"), _Numbers(), 0

        def flush() -> pa.RecordBatch:
            nonlocal keys, counts, codes, numbers, size, made
            seen = np.frombuffer(codes, np.uint32)
            order = np.argsort(-np.bincount(seen, minlength=len(numbers)), kind="stable")
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            chunks = [c.encode() for c in numbers]
            chunks = [chunks[k] for k in order]
            bucket = np.array([zlib.crc32(c) % groups for c in chunks], np.uint32)
            asks = []
            for b in np.unique(bucket):
                some = [chunks[k] for k in np.flatnonzero(bucket == b)]
                asks.append({"bucket": int(b), "lens": squeeze(np.array([len(c) for c in some])), "chars": zstandard.compress(b"".join(some), 3)})
            row = [(part << 32) + made], [keys], [squeeze(np.array(counts, np.uint32))], [squeeze(place[seen])], [squeeze(bucket)], [asks]
            made += 1
            keys, counts, codes, numbers, size = [], [], array("I"), _Numbers(), 0
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, schema.types)], schema=schema)

        for batch in batches:
            texts = batch.column(1)
            for k in range(batch.num_rows):
                text = texts[k].as_py() or ""
                found = cut(_whole(model).normalize(text))
                codes.extend(map(numbers.__getitem__, found))
                keys.append(batch.column(0)[k])
                counts.append(len(found))
                size += len(text)
                if size >= block:
                    yield flush()
        if keys:
            yield flush()

    return tidied(run)


def _segment(model: bytes):
    """Rows in order of their group -> ids of the chunks they ask for; each chunk of a group is segmented once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, known = None, {}
        for batch in batches:
            for k in range(batch.num_rows):
                bucket = batch.column(1)[k].as_py()
                if bucket != group:
                    group, known = bucket, {}
                ends = np.cumsum(loosen(batch.column(2)[k].as_py()), dtype=np.int64).tolist()
                chars = zstandard.decompress(batch.column(3)[k].as_py())
                chunks = [chars[a:b] for a, b in zip([0, *ends], ends)]
                new = [c for c in chunks if c not in known]
                for c, ids in zip(new, _plain(model).encode([c.decode() for c in new], num_threads=1)):
                    known[c] = array("I", ids)
                found = [known[c] for c in chunks]
                ids = np.frombuffer(b"".join(found), np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[k].as_py()]), pa.array([bucket]), pa.array([squeeze(np.array([len(x) for x in found]))]), pa.array([squeeze(ids)])], ["block", "bucket", "lens", "ids"],
                )

    return tidied(run)


def _restore(model: bytes, key: str, key_type: pa.DataType):
    """A block's chunk numbers and the ids of its chunks -> (key, ids, decoded) of its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = _whole(model)
        begin, end = ([x] if x >= 0 else [] for x in (sp.bos_id(), sp.eos_id()))

        def rows(keys: list, ids: list) -> pa.RecordBatch:
            raw = [np.array(x, "<u4").tobytes() for x in ids]
            return pa.RecordBatch.from_arrays([pa.array(keys, key_type), pa.array(raw, pa.binary()), pa.array(sp.decode(ids, num_threads=1), pa.string())], [key, "ids", "decoded"])

        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                counts, codes, buckets = (loosen(row[c].as_py()) for c in ("counts", "codes", "buckets"))
                lens, starts, flat, base = np.zeros(len(buckets), np.int64), np.zeros(len(buckets), np.int64), [], 0
                for answer in row["answers"].as_py() or []:
                    at = np.flatnonzero(buckets == answer["bucket"])
                    lens[at] = loosen(answer["lens"])
                    starts[at] = base + np.cumsum(lens[at]) - lens[at]
                    flat.append(loosen(answer["ids"]))
                    base += len(flat[-1])
                flat = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
                held, keys, size, at = [], [], 0, 0
                for n, own in zip(counts.tolist(), row["keys"].values if len(counts) else ()):
                    c = codes[at : at + n]
                    at += n
                    many = lens[c]
                    upto = np.cumsum(many)
                    ids = flat[np.repeat(starts[c] - upto + many, many) + np.arange(upto[-1] if n else 0)]
                    held.append([*begin, *ids.tolist(), *end])
                    keys.append(own)
                    size += 4 * len(ids)
                    if size >= RESULT:
                        yield rows(keys, held)
                        held, keys, size = [], [], 0
                if keys:
                    yield rows(keys, held)

    return tidied(run)


def encode(docs: DataFrame, model_file: str, key: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """Each text of `docs` (`key`, text) as the ids of a SentencePiece model, with begin and end ids, and decoded again: key, ids, decoded.

    `ids` are little-endian unsigned 32-bit numbers. They are the library's own, without sampling, for any text: null and empty texts hold the
    begin and end ids only; the longest texts are blocks of their own; repeated rows are answered each; an empty table gives no
    rows; other columns are not read. Where pieces of a model may cross white space, a whole text is one chunk.
    """
    spark = prepare(docs.sparkSession)
    with open(model_file, "rb") as f:
        model = f.read()
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(parts, -(-total // GROUP))
    kind = docs.schema[key].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    arrow = to_arrow_type(kind)
    schema = f"block long, keys array<{kind.simpleString()}>, counts binary, codes binary, buckets binary, asks array<struct<bucket:bigint,lens:binary,chars:binary>>"
    blocks = settle_buckets(docs.select(key, "text").mapInArrow(_blocks(model, groups, block, arrow), schema), "block", max(parts, -(-total // (4 * block))), "blocks")
    asks = blocks.select("block", F.explode("asks").alias("a")).select("block", "a.bucket", "a.lens", "a.chars")
    answers = asks.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_segment(model), "block long, bucket long, lens binary, ids binary")
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "lens", "ids")).alias("answers"))
    met = blocks.select("block", "keys", "counts", "codes", "buckets").hint("merge").join(answers, "block", "left")
    return met.mapInArrow(_restore(model, key, arrow), f"`{key}` {kind.simpleString()}, ids binary, decoded string")


def op13_pieces(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select(
        "doc_id", F.expr("cast(octet_length(ids) div 4 AS long)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
