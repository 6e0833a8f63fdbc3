"""Packing: first-fit decreasing over a tournament tree of bin capacities, in randomised groups of documents.

Texts are tokenised where they are read; only a short row for each piece is shuffled, to the group of its document.
Groups hold about `group_docs` documents, so a task's memory does not grow with the corpus.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, tidied

SEQUENCE = 4096
END_ID = 2
GROUP_DOCS = 4096
SEED = 20
CACHE = 600_000
#: The tokenizer's own split, after lower-casing (fixed values).
PRETOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|[^\s0-9A-Za-zªµºÀ-ÖØ-öø-ɏ]+")
#: Words of these characters are split as PRETOKEN says; all others go to the tokenizer whole.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-įı-ɏ]+")


class WordEncoder:
    """Ids of white-space words, kept by word: the tokenizer drops white space, so a text's ids are those of its words in turn."""

    def __init__(self, path: str, cache: int = CACHE):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.cache = cache
        self.words: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        end = self.tok.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(end.values()) + 1, bool)
        self.last[[i for t, i in end.items() if t.endswith("</w>")]] = True

    def _parts(self, new: list[str]) -> None:
        for i in range(0, len(new), 200):
            some = new[i : i + 200]
            ids = np.array(self.tok.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.last[ids]) + 1
            if len(cuts) == len(some):
                a = 0
                for w, b in zip(some, cuts):
                    self.parts[w] = ids[a:b].tobytes()
                    a = b
            else:
                for w in some:
                    self.parts[w] = self._whole(w)

    def _whole(self, word: str) -> bytes:
        return np.array(self.tok.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: set[bytes]) -> None:
        """Make sure that all of these words have their ids; of words seen before, those in use stay."""
        if len(self.words) > self.cache:
            self.old, self.words = self.words, {}
        if len(self.parts) > self.cache:
            self.parts.clear()
        split: dict[bytes, list[str]] = {}
        for w in words.difference(self.words):
            if w in self.old:
                self.words[w] = self.old[w]
                continue
            s = w.decode()
            if "<|" not in s and PLAIN.fullmatch(s):
                split[w] = PRETOKEN.findall(s.lower())
            else:
                self.words[w] = self._whole(s)
        self._parts(list({p for ps in split.values() for p in ps if p not in self.parts}))
        for w, ps in split.items():
            self.words[w] = b"".join([self.parts[p] for p in ps])

    def batch(self, texts: list[str | None], most: int = 4 << 20) -> Iterator[bytes]:
        """The ids of each text, learnt for some texts at once."""
        i = 0
        while i < len(texts):
            lists, size = [], 0
            while i < len(texts) and (not lists or size < most):
                raw = (texts[i] or "").encode()
                lists.append(raw.split())
                size += len(raw)
                i += 1
            self._learn(set().union(*lists))
            get = self.words.__getitem__
            for words in lists:
                yield b"".join(map(get, words))

    def ids(self, text: str) -> bytes:
        return next(self.batch([text]))


_encoders: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, cache: int = CACHE) -> WordEncoder:
    if (path, cache) not in _encoders:
        _encoders[path, cache] = WordEncoder(path, cache)
    return _encoders[path, cache]


def _pieces(path: str, size: int, end_id: int, keep_ids: bool, cache: int):
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, cache)
        # equal rows of a partition are told apart by their number, whatever order they come in
        part, seen = TaskContext.get().partitionId() << 32, Counter()
        for batch in batches:
            out: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), enc.batch(batch.column(1).to_pylist())):
                ids += tail
                n, whole = len(ids) // 4, zlib.crc32(ids)
                nth = part + seen[doc, whole]
                seen[doc, whole] += 1
                for a in range(0, n, size):
                    piece = ids[4 * a : 4 * (a + size)]
                    out.append((doc, a, len(piece) // 4, zlib.crc32(piece), n, whole, nth, *([piece] if keep_ids else [])))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "whole", "nth", *(["ids"] if keep_ids else [])]
            kinds = [pa.int64()] * 7 + [pa.binary()] * keep_ids
            cols = list(zip(*out)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return run


def first_fit(lengths: list[int], size: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length, given in falling order. A tournament tree over the bins holds the largest room below each node, so the first bin with room is found in a logarithm of the bins."""
    n = 1
    while n < len(lengths):
        n *= 2
    tree = [size] * (2 * n)
    bins, offsets, full = [], [], 0
    where: dict[int, int] = {}
    for x in lengths:
        i = 1
        while i < n:
            i *= 2
            if tree[i] < x:
                i += 1
        room = tree[i]
        offsets.append(size - room)
        b = where.setdefault(i, full)
        full += b == full
        bins.append(b)
        room -= x
        tree[i] = room
        while i > 1:
            i //= 2
            a, c = tree[2 * i], tree[2 * i + 1]
            room = a if a > c else c
            if tree[i] == room:
                break
            tree[i] = room
    return bins, offsets


def _pack_group(size: int):
    def run(table: pa.Table) -> pa.Table:
        order = [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]
        table = table.sort_by(order)
        bins, offsets = first_fit(table["length"].to_pylist(), size)
        group = np.asarray(table["grp"].to_numpy(), np.int64)
        table = table.append_column("sequence_id", pa.array((group << 32) + np.array(bins, np.int64), pa.int64()))
        return table.append_column("offset", pa.array(offsets, pa.int64())).drop_columns(["grp"])

    return run


def pack(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = END_ID, group_docs: int = GROUP_DOCS, seed: int = SEED, keep_ids: bool = False, cache: int = CACHE) -> DataFrame:
    """Pack documents (doc_id, text) into sequences of at most `size` tokens; a row for each piece.

    A document's ids are those of `tokenizer` without special tokens, then `end_id`; documents over `size` are cut at
    multiples of it. Groups are drawn by a hash of doc_id, the document's ids, its partition, its number among
    equal rows there and the seed, so that equal rows, and those without doc_id, are spread too; in each, pieces go by falling length to the
    first sequence with room. sequence_id holds the group in its upper half. keep_ids adds the ids themselves
    (`ids`, little-endian unsigned 32 bits). `cache` bounds the words that a worker remembers.

    Null and empty texts give one piece that holds end_id alone; equal lengths go by doc_id, start and checksum;
    repeated rows are packed each; an empty table gives no row; other columns are not read.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    groups = max(1, -(-docs.count() // group_docs))
    kinds = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long{}" + ", ids binary" * keep_ids
    pieces = docs.mapInArrow(tidied(_pieces(tokenizer, size, end_id, keep_ids, cache)), kinds.format(", whole long, nth long"))
    pieces = pieces.withColumn("grp", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "whole", "nth"), F.lit(groups))).drop("whole", "nth")
    kinds = kinds.format("")
    packed = pieces.groupBy("grp").applyInArrow(_pack_group(size), f"{kinds}, sequence_id long, offset long")
    return packed


def op10_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
