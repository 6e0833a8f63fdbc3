"""Token counts that follow edits: a segment tree over a document's pre-tokens; an edit re-encodes its region and boundary context alone.

A byte-level BPE never merges across pre-tokens, so a text's count is the sum over its pre-tokens, and a pre-token's count depends on its
characters alone. Leaves are blocks of pre-tokens; inner nodes hold sums of characters and of tokens. An edit finds its
block by descending the sums, goes back to the last pre-token that the edit cannot reach, splits on until a boundary of the new text
meets one of the old, replaces the pre-tokens between, and updates the sums above the blocks that it touched.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

BLOCK = 128
CACHE = 500_000
#: A pre-token that ends this far before an edit cannot change: the pattern looks one character past its match.
REACH = 2


class Counter:
    """Tokens of pre-tokens, kept by pre-token."""

    def __init__(self, vocabulary: str, pattern: str):
        import regex
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}
        self.encoded = 0

    def counts(self, pretokens: list[str]) -> list[int]:
        try:
            return [self.known[p] for p in pretokens]
        except KeyError:
            pass
        if len(self.known) > CACHE:
            self.known.clear()
        for p in set(pretokens).difference(self.known):
            self.known[p] = len(self.bpe.encode_ordinary(p))
        return [self.known[p] for p in pretokens]


class Tree:
    """Blocks of pre-token lengths and counts under a binary tree of their sums."""

    def __init__(self, lengths: list[int], counts: list[int]):
        self.lengths = [lengths[i : i + BLOCK] for i in range(0, len(lengths), BLOCK)] or [[]]
        self.counts = [counts[i : i + BLOCK] for i in range(0, len(counts), BLOCK)] or [[]]
        self._build()

    def _build(self) -> None:
        self.size = 1
        while self.size < len(self.lengths):
            self.size *= 2
        pad = [0] * (self.size - len(self.lengths))
        self.chars = [0] * self.size + [sum(b) for b in self.lengths] + pad
        self.tokens = [0] * self.size + [sum(b) for b in self.counts] + pad
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def find(self, at: int) -> tuple[int, int]:
        """The block that holds the character at `at` (the last block for the end), and its first character."""
        i, start = 1, 0
        while i < self.size:
            i *= 2
            if at >= start + self.chars[i] and i + 1 < 2 * self.size and self.chars[i + 1]:
                start += self.chars[i]
                i += 1
        return i - self.size, start

    def _update(self, block: int) -> None:
        i = block + self.size
        self.chars[i], self.tokens[i] = sum(self.lengths[block]), sum(self.counts[block])
        i //= 2
        while i:
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]
            i //= 2

    def replace(self, first: tuple[int, int], last: tuple[int, int], lengths: list[int], counts: list[int]) -> None:
        """Put pre-tokens in place of those from place `first` up to place `last` (block, index in it)."""
        (b, i), (c, j) = first, last
        if b == c:
            self.lengths[b][i:j], self.counts[b][i:j] = lengths, counts
        else:
            self.lengths[b][i:], self.counts[b][i:] = lengths, counts
            self.lengths[c][:j], self.counts[c][:j] = [], []
            for k in range(b + 1, c):
                self.lengths[k], self.counts[k] = [], []
        if len(self.lengths[b]) > 16 * BLOCK:  # a large insertion: blocks anew
            flat = [x for k in self.lengths for x in k], [x for k in self.counts for x in k]
            self.__init__(*flat)
            return
        for k in range(b, c + 1):
            self._update(k)


class Document:
    """A text with its tree; edits keep both in step."""

    def __init__(self, text: str, counter: Counter):
        self.text, self.counter = text, counter
        pretokens = counter.pattern.findall(text)
        self.tree = Tree(list(map(len, pretokens)), counter.counts(pretokens))
        self.encoded = 0

    def edit(self, start: int, stop: int, new: str) -> None:
        """Replace text[start:stop]."""
        old, tree = self.text, self.tree
        self.text = old[:start] + new + old[stop:]
        shift = len(new) - (stop - start)
        # back to the last pre-token that ends too early to change
        block, at = tree.find(max(0, start - REACH))
        i = 0
        while i < len(tree.lengths[block]) and at + tree.lengths[block][i] <= start - REACH:
            at += tree.lengths[block][i]
            i += 1
        first, begin = (block, i), at
        # split on until a new boundary is an old one
        c, j, end = block, i, at
        found: list[str] = []
        place = begin
        met = False
        for m in self.counter.pattern.finditer(self.text, begin):
            found.append(m.group())
            place = m.end()
            if place - shift < stop:
                continue
            while end < place - shift and c < len(tree.lengths):
                if j == len(tree.lengths[c]):
                    c, j = c + 1, 0
                    continue
                end += tree.lengths[c][j]
                j += 1
            if end == place - shift and place >= start + len(new):
                met = True
                break
        if not met:  # to the end of the text
            c = len(tree.lengths) - 1
            j = len(tree.lengths[c])
        self.encoded += place - begin
        if c == len(tree.lengths):
            c, j = c - 1, len(tree.lengths[-1])
        tree.replace(first, (c, j), list(map(len, found)), self.counter.counts(found))


_counters: dict[tuple[str, str], Counter] = {}


def counter(vocabulary: str, pattern: str) -> Counter:
    key = (vocabulary, pattern)
    if key not in _counters:
        _counters[key] = Counter(*key)
    return _counters[key]


def _count(vocabulary: str, pattern: str):
    names = ["doc_id", "n_chars", "n_tokens", "edited_chars", "edited_tokens", "reencoded_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocabulary, pattern)
        for batch in batches:
            rows = []
            for doc, text, edits in zip(*(batch.column(k).to_pylist() for k in range(3))):
                d = Document(text or "", c)
                n, before = len(d.text), d.tree.total
                clean, limit = [], 0
                for e in sorted((e for e in edits or [] if e and e["start"] is not None), key=lambda e: (e["start"], e["stop"] or 0)):
                    a = min(n, max(limit, e["start"]))
                    b = min(n, max(a, e["stop"] if e["stop"] is not None else a))
                    clean.append((a, b, e["text"] or ""))
                    limit = b
                for a, b, t in reversed(clean):
                    d.edit(a, b, t)
                rows.append((doc, n, before, len(d.text), d.tree.total, d.encoded))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*rows) if rows else [[]] * 6)], names)

    return run


def counts(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """n_chars and n_tokens of documents (doc_id, text, edits), edited_chars and edited_tokens after the edits, and reencoded_chars, the characters that the edits made it read again.

    edits: array<struct<start int, stop int, text string>>, by code points of the text as it is; an edit that reaches into the one before
    it starts where that one stops, offsets past the end count as the end, and a null stop as the start. Null texts and null edits are empty; a text of
    any length is read whole; repeated rows are counted each; an empty table gives no rows; other columns are not read.
    """
    prepare(docs.sparkSession)
    kinds = "doc_id long, n_chars long, n_tokens long, edited_chars long, edited_tokens long, reencoded_chars long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "edits").mapInArrow(_count(vocabulary, pattern), kinds)


def some_edits() -> object:
    """Three edits by the length of the text: words put in at a quarter, a fiftieth cut out at the half, and another ending for the last hundredth."""
    n = F.length("text")
    quarter, half, tail = (n / 4).cast("int"), (n / 2).cast("int"), (n - n / 100).cast("int")
    edit = lambda a, b, t: F.struct(a.cast("int").alias("start"), b.cast("int").alias("stop"), F.lit(t).alias("text"))
    return F.array(edit(quarter, quarter, " (as edited) "), edit(half, half + (n / 50).cast("int"), ""), edit(tail, n, " It's the end."))


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("edits", some_edits())
    return counts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
