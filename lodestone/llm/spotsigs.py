"""Document fingerprints: SpotSigs. Chains of content words that follow common words, as a set of hashes.

A spot is a common word; its signature is the word with the next CHAIN content words after it. Common words carry the running prose of a page,
so spots fall all over a text and an edit touches only those near it. Runs of words stand beside the chains in every text, short or long,
with many spots or none: no threshold parts a text from its edit. A fingerprint lists the sorted 32-bit hashes of
the distinct signatures in hexadecimal. Two fingerprints are compared by the Jaccard index of their sets; the lengths bound
it, so pairs from far-apart length classes are pruned unread.

The next document by doc_id is found without a second copy of the corpus: documents are dealt to ranges of doc_id, each range
also gets the first document of the range after it, and a task walks its range in order. Ranges begin at the ids that a hash draws, one in
RANGE_ROWS at most; a task holds two documents at a time, so ranges need no bound.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, settle, tidied

CHAIN = 2
LIKE = 0.8
#: Documents in a range, in the mean, on large tables.
RANGE_ROWS = 16384
#: Documents whose results a task holds at once.
WALK_ROWS = 64
#: Common words of English, German, French and Spanish (our own choice).
SPOTS = frozenset("the a an is was of to in and it that this with for der die das ein eine ist und den dem nicht mit von zu le la les un une est et de des que qui pour dans el los las una es y en por con del se".split())
WORD = re.compile(r"[^\W_]+")


def signatures(text: str, chain: int = CHAIN) -> set[int]:
    """Hashes of the spots' chains, and of the runs of up to `chain` words that end at each word. A text without words has its own hash; an empty text has none."""
    if not text:
        return set()
    words = WORD.findall(text.lower())
    common = SPOTS.__contains__
    spots = [i for i, w in enumerate(words) if common(w)]
    is_spot = set(spots)
    content = [w for i, w in enumerate(words) if i not in is_spot]
    # the number of content words before a spot is its place less the spots before it
    h = xxhash.xxh32_intdigest
    last = len(content) - chain
    found = {h(" ".join((words[i], *content[i - k : i - k + chain]))) for k, i in enumerate(spots) if i - k <= last}
    found.update(h(" ".join(words[:i])) for i in range(1, min(chain, len(words) + 1)))
    found.update(map(h, map(" ".join, zip(*(words[i:] for i in range(chain))))))
    return found or {h(text)}


def fingerprint(sigs: set[int]) -> str:
    return np.sort(np.fromiter(sigs, ">u4", len(sigs))).astype(">u4").tobytes().hex()


def parse(fp: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fp), ">u4").astype(np.uint32)


def likeness(x, y, least: float = 0.0) -> float:
    """The Jaccard index of two sets; 0 unread where their sizes already keep it under `least`. Two empty sets are alike."""
    a, b = len(x), len(y)
    if not a or not b:
        return float(a == b)
    if min(a, b) < least * max(a, b):
        return 0.0
    both = len(x & y)
    return both / (a + b - both)


def edited(text: str, after: str) -> str:
    """The text with its last quarter of code points (rounded down) replaced by as many from the start of the next text, or all of it."""
    n = len(text) // 4
    return text[: len(text) - n] + after[:n]


def _walk():
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "signatures"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # part, doc_id, text, borrowed: in order of part and doc_id; a borrowed row ends its part and gives no output
        held = None
        # fingerprints are longer than texts, so few rows are held at once
        for batch in (b.slice(i, WALK_ROWS) for b in batches for i in range(0, b.num_rows, WALK_ROWS)):
            rows = []
            for part, doc, text, borrowed in zip(*(batch.column(k).to_pylist() for k in range(4))):
                text = text or ""
                sigs = signatures(text)
                if doc is None:
                    other = edited(text, text)
                    o = signatures(other)
                    rows.append((doc, len(text), hashlib.sha256(other.encode()).hexdigest(), fingerprint(sigs), fingerprint(o), likeness(sigs, o), 1.0, len(sigs)))
                    continue
                if held is not None and held[0] == part:
                    _, d, t, s, fp = held
                    other = edited(t, text)
                    o = signatures(other)
                    rows.append((d, len(t), hashlib.sha256(other.encode()).hexdigest(), fp, fingerprint(o), likeness(s, o), likeness(s, sigs), len(s)))
                held = None if borrowed else (part, doc, text, sigs, fingerprint(sigs))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * len(names), kinds)], names)

    return run


def chained(docs: DataFrame, rows: int) -> DataFrame:
    """(part, doc_id, text, borrowed) in ranges of about `rows` documents by doc_id, each ended by the first document of the next range (after the last: of the first). Rows without doc_id are spread over the ranges."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    drawn = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(rows)) == 0
    ids = docs.filter("doc_id is not null").agg(F.min("doc_id").alias("first"), F.collect_set(F.when(drawn, F.col("doc_id"))).alias("cuts")).first()
    # one id in `rows`: the first of each range
    starts = np.array(sorted({ids["first"], *ids["cuts"]}) if ids["first"] is not None else [], np.int64)
    held = docs.sparkSession.sparkContext.broadcast(starts)

    @F.pandas_udf("part long, before long")
    def place(doc: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(held.value, doc.to_numpy(), "right") - 1
        begins = held.value[at] == doc.to_numpy()
        return pd.DataFrame({"part": at, "before": pd.Series(np.where(begins, (at - 1) % len(held.value), -1))})

    spread = F.pmod(F.xxhash64("text"), F.lit(max(1, len(starts))))
    none = docs.filter("doc_id is null").select(spread.alias("part"), "doc_id", "text", F.lit(False).alias("borrowed"))
    if not len(starts):
        return none
    placed = docs.filter("doc_id is not null").withColumn("p", place("doc_id"))
    places = F.array_compact(F.array(F.struct(F.col("p.part").alias("part"), F.lit(False).alias("borrowed")), F.when(F.col("p.before") >= 0, F.struct(F.col("p.before").alias("part"), F.lit(True).alias("borrowed")))))
    dealt = placed.select("doc_id", "text", F.explode(places).alias("q")).select("q.part", "doc_id", "text", "q.borrowed").unionByName(none)
    # of rows that repeat an id, one stands for the id in the range before; those without id come first
    tasks = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(tasks, "part").sortWithinPartitions("part", "borrowed", F.col("doc_id").asc_nulls_first(), "text")


def fingerprints(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """fingerprint, edited_fingerprint, near_edited and near_next of every document (doc_id, text), with n_chars (code points), edited_sha256 and the number of signatures.

    The edited text has its last quarter replaced by the start of the next document, by ascending doc_id (after the last: the first).
    Null texts are empty: their fingerprint is empty, and alike only to another empty one. A document that is alone
    is its own next. Rows that repeat a doc_id follow each other by text; a row without doc_id has no place in the
    order and is its own next, too; an empty table gives no rows; other columns are not read.
    """
    spark = prepare(docs.sparkSession)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = max(1, min(range_rows, docs.count() // (16 * tasks)))  # enough ranges that tasks come out even
    out = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, signatures long"
    return chained(docs, rows).mapInArrow(tidied(_walk()), out)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(signatures(t or "")) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "s"])


def near_pairs(docs: DataFrame, least: float = LIKE) -> DataFrame:
    """(a, b, likeness) of representatives a < b of equal fingerprints whose Jaccard index is `least` or more, and nothing for empty ones.

    Equal fingerprints are one representative, the smallest doc_id. Sets are dealt by the hashes among their first |x| - ceil(least |x|) + 1, to
    classes of set length of ratio `least`: pairs meet in a class or the one above, and lengths prune before sets are read.
    """
    prepare(docs.sparkSession)
    sets = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    sets = sets.mapInArrow(tidied(_sets), "doc_id long, s array<long>").filter(F.size("s") > 0)
    sets = settle(sets.groupBy("s").agg(F.min("doc_id").alias("id")).withColumn("n", F.size("s")), "sigs")
    head = F.slice("s", F.lit(1), F.col("n") - F.ceil(F.col("n") * least).cast("int") + 1)
    rows = sets.select(F.explode(head).alias("g"), "id", "n").withColumn("band", F.floor(F.log("n") / F.lit(-np.log(least))))
    up = rows.select("g", F.explode(F.array("band", F.col("band") + 1)).alias("band"), F.col("id").alias("a"), F.col("n").alias("na"), F.col("band").alias("ba"))
    pairs = up.join(rows.select("g", "band", F.col("id").alias("b"), F.col("n").alias("nb")), ["g", "band"])
    pairs = pairs.filter("a <> b and (ba < band or a < b)").filter(F.least("na", "nb") >= least * F.greatest("na", "nb"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    # sets travel with the pairs alone, not with every row of a class
    one, two = (sets.select(F.col("id").alias(k), F.col("s").alias(f"s{k}")) for k in "ab")
    both = F.size(F.array_intersect("sa", "sb"))
    found = pairs.join(one, "a").join(two, "b").select("a", "b", (both / (F.size("sa") + F.size("sb") - both)).alias("likeness"))
    return found.filter(F.col("likeness") >= least)


def op9_spotsigs(spark, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
