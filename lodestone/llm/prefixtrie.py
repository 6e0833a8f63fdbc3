"""Conversation prefix trie: families of conversations build small tries, whose combined nodes are merged by key.

A turn is a digest of role and text and its text's length, taken where it is scanned, so that no text is shuffled. Conversations
are cogrouped with the family's base; one family gives one row a distinct prefix, and only those rows are shuffled by the prefix's key.

The nodes of the merged trie whose smallest member is the same conversation form one path, since fewer members never have a smaller
least. Sums over subtrees therefore run over the tree of paths: by doubling, each path hands what it has gathered to the path
2, 4, 8 ... above it, in as many rounds as the logarithm of that tree's height; sums within a path are one running sum.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, settle

FAMILY = 5
HEADS = 9
ROOT = bytes(16)
#: Bytes of joined ids that one row holds.
PIECE = 1 << 16
NODE = pa.schema([("key", pa.binary()), ("parent", pa.binary()), ("depth", pa.int32()), ("conv", pa.int64()), ("n", pa.int64()), ("bytes", pa.int64()), ("ends", pa.list_(pa.int64()))])


def head(conv_id: int, most: int = HEADS) -> int:
    """How many turns of its family's base a conversation starts with."""
    return zlib.crc32(str(conv_id).encode()) % most


def turn_digests(turns: DataFrame) -> DataFrame:
    """(conv, turn, digest, bytes): 16 bytes of SHA-256 of role and text, told apart by the role's length; null role or text counts as empty."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn"), F.unhex(F.substring(F.sha2(told, 256), 1, 32)).alias("digest"), F.octet_length(text).cast("long").alias("bytes"),
    )


def _conversations(table: pa.Table) -> dict[int, list[tuple[bytes, int]]]:
    """Turns of each conversation in order: null turn first, ties by digest."""
    at = sorted(zip(table["conv"].to_pylist(), table["turn"].to_pylist(), table["digest"].to_pylist(), table["bytes"].to_pylist()), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))
    out: dict[int, list[tuple[bytes, int]]] = {}
    for conv, _, digest, size in at:
        out.setdefault(conv, []).append((digest, size))
    return out


def _family(heads: int):
    def run(base: pa.Table, rest: pa.Table) -> pa.Table:
        start = _conversations(base)
        members = {**start, **_conversations(rest)}
        first = next(iter(start.values()), [])
        nodes: dict[bytes, list] = {}
        for conv in sorted(members):
            h = head(conv, heads)
            path = [*first[:h], *members[conv][h:]]
            key, parent = ROOT, None
            for depth in range(len(path) + 1):
                size = 0
                if depth:
                    digest, size = path[depth - 1]
                    parent, key = key, hashlib.blake2b(key + digest, digest_size=16).digest()
                node = nodes.setdefault(key, [key, parent, depth, conv, 0, size, []])
                node[4] += 1
            node[6].append(conv)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*nodes.values()), NODE.types)], schema=NODE) if nodes else NODE.empty_table()

    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, id) in order -> (key, first id, ids as decimals joined by commas), in pieces of about PIECE bytes."""
    key, ids, size, out = None, [], 0, []

    def close() -> None:
        nonlocal ids, size
        if ids:
            out.append((key, ids[0], ",".join(map(str, ids))))
        ids, size = [], 0

    def rows() -> pa.RecordBatch:
        some = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], ["key", "first", "ids"])
        out.clear()
        return some

    for batch in batches:
        for k, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key or size >= PIECE:
                close()
                key = k
            ids.append(i)
            size += len(str(i)) + 1
        if out:
            yield rows()
    close()
    if out:
        yield rows()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, ids) in order -> (key, SHA-256 of all ids joined by commas); a key's pieces are hashed one after another."""
    key, state = None, None
    for batch in batches:
        keys, hashes = [], []
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key:
                if state is not None:
                    keys.append(key)
                    hashes.append(state.hexdigest())
                key, state = k, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(hashes)], ["key", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])


def ends_hashes(family_nodes: DataFrame) -> DataFrame:
    """(key, ends_sha256) of nodes at which conversations end. Ids of a node lie in ranges of their order; only joined pieces meet in one task."""
    ends = family_nodes.filter(F.size("ends") > 0).select("key", F.explode("ends").alias("id"))
    pieces = ends.repartitionByRange("key", "id").sortWithinPartitions("key", "id").mapInArrow(_joined, "key binary, first long, ids string")
    return pieces.repartition("key").sortWithinPartitions("key", "first").select("key", "ids").mapInArrow(_hashed, "key binary, ends_sha256 string")


def _path_totals(paths: DataFrame) -> DataFrame:
    """(c, up, leaves, saved) of a forest of paths -> (c, leaves, saved) summed over each path and all below it."""
    while True:
        gathered = paths.filter("up is not null").groupBy(F.col("up").alias("c")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        beyond = paths.filter("up is not null").select("c", "up").join(paths.filter("up is not null").select(F.col("c").alias("up"), F.col("up").alias("next")), "up").select("c", "next")
        paths = settle(
            paths.join(gathered, "c", "left").join(beyond, "c", "left").select(
                "c", F.col("next").alias("up"), (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ),
            "paths",
        )
        if paths.filter("up is not null").isEmpty():
            return paths.select("c", "leaves", "saved")


def trie(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """One row a node of the prefix trie of `turns` (conv_id, turn, role, text), after each conversation is rebuilt.

    Conversation c takes its first h = crc32(decimal c) % `heads` turns from conversation c - c % `family` (all, if it has fewer;
    none, if there is no such conversation), then its own after its first h. c % `family` has the sign of c. Turns are in order
    of `turn`, null first; equal ones by a digest of role and text. Null role or text is empty; rows without conv_id take
    no part; repeated rows are turns each; an empty table gives no rows; other columns are not read. Prefixes are equal when their
    128-bit digests are. A family is built in one task from about a hundred bytes a turn, whatever the texts.

    Returns conv_id (smallest member), depth, parent_conv_id (the parent's conv_id, null at the root), n_convs, n_children,
    n_leaves, saved_tokens (over the subtree, (n_convs - 1) times the last text's bytes) and ends_sha256.
    """
    prepare(turns.sparkSession)
    told = turn_digests(turns)
    base = F.col("conv") % F.lit(family)
    left = told.filter(base == 0).withColumn("base", F.col("conv"))
    right = told.filter(base != 0).withColumn("base", F.col("conv") - base)
    schema = "key binary, parent binary, depth int, conv long, n long, bytes long, ends array<long>"
    built = settle(left.groupBy("base").cogroup(right.groupBy("base")).applyInArrow(_family(heads), schema), "families")

    merged = built.groupBy("key", "parent", "depth", "bytes").agg(F.min("conv").alias("conv"), F.sum("n").alias("n"))
    nodes = settle(merged.withColumn("own", (F.col("n") - 1) * F.col("bytes")), "nodes")

    # One path a conversation that is the least of some node; its first node hangs below (up, at).
    paths = nodes.groupBy("conv").agg(F.min("depth").alias("first"), F.max("depth").alias("last"), F.min_by("parent", "depth").alias("parent"), F.sum("own").alias("saved"))
    owners = nodes.select(F.col("key").alias("parent"), F.col("conv").alias("up"))
    paths = settle(paths.join(owners, "parent", "left").select(F.col("conv").alias("c"), "up", (F.col("first") - 1).alias("at"), "last", "saved"), "hung")
    branched = paths.filter("up is not null").select(F.col("up").alias("c"), F.col("at").alias("last")).distinct().withColumn("branched", F.lit(1))
    weighed = paths.join(branched, ["c", "last"], "left").select("c", "up", F.when(F.col("branched").isNull(), 1).otherwise(0).cast("long").alias("leaves"), "saved")
    totals = _path_totals(settle(weighed, "weighed"))

    below = paths.filter("up is not null").join(totals.withColumnRenamed("saved", "sum_saved"), "c")
    hung = below.groupBy(F.col("up").alias("conv"), F.col("at").alias("depth")).agg(F.count(F.lit(1)).alias("n_hung"), F.sum("leaves").alias("leaves"), F.sum("sum_saved").alias("saved"))
    starts = paths.select(F.col("c").alias("conv"), (F.col("at") + 1).alias("depth"), F.col("up").alias("parent_conv"))
    both = hung.unionByName(starts, allowMissingColumns=True).groupBy("conv", "depth").agg(*[F.sum(c).alias(c) for c in ("n_hung", "leaves", "saved")], F.max("parent_conv").alias("parent_conv"))
    w = Window.partitionBy("conv").orderBy(F.col("depth").desc())
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = nodes.join(both, ["conv", "depth"], "left").withColumn("n_children", F.coalesce("n_hung", F.lit(0)) + F.when(F.lag("depth").over(w).isNull(), 0).otherwise(1))
    summed = known.select(
        "key", "conv", "depth", "n", "n_children",
        F.when(F.lead("depth").over(w).isNull(), F.col("parent_conv")).otherwise(F.col("conv")).alias("parent_conv_id"),
        F.sum(F.coalesce("leaves", F.lit(0)) + F.when(F.col("n_children") == 0, 1).otherwise(0)).over(upto).alias("n_leaves"),
        F.sum(F.coalesce("saved", F.lit(0)) + F.col("own")).over(upto).alias("saved_tokens"),
    )
    ends = ends_hashes(built)
    return summed.join(ends, "key", "left").select(
        F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"), F.col("n_children").cast("long").alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: CRC-32 of a text from its definition: eight shifts a byte, by the reversed polynomial 0xEDB88320.
_CRC = """
xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({x}, ''), lambda c: ord(c)::BIGINT)),
  lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
    lambda s, k: xor(s >> 1, CASE WHEN s & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT)
"""

OP12_SQL = f"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d, strlen(coalesce(text, '')) AS b
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT c, list(struct_pack(d := d, b := b) ORDER BY k) AS own FROM t GROUP BY c),
r AS (
  SELECT l.c, list_concat(coalesce(o.own, [])[1:h], l.own[h + 1:]) AS path
  FROM (SELECT *, {_CRC.format(x="c::VARCHAR")} % 9 AS h FROM l) l LEFT JOIN l o ON o.c = l.c - l.c % 5),
p AS (SELECT c, d, path[1:d] AS prefix, len(path) = d AS ends, CASE WHEN d = 0 THEN 0 ELSE path[d].b END AS b FROM r, unnest(range(len(path) + 1)) AS u(d)),
n AS (
  SELECT prefix, d, any_value(b) AS b, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY prefix, d),
k AS (SELECT c.prefix[1:c.d - 1] AS prefix, count(*) AS n_children FROM n c WHERE c.d > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.prefix = n.prefix),
s AS (
  SELECT up.prefix, count_if(x.n_children = 0) AS n_leaves, sum((x.n_convs - 1) * x.b) AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS a FROM m) x JOIN m up ON up.prefix = x.prefix[1:a] GROUP BY up.prefix)
SELECT m.conv_id, m.d AS depth, up.conv_id AS parent_conv_id, m.n_convs, m.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN s ON s.prefix = m.prefix LEFT JOIN m up ON m.d > 0 AND up.prefix = m.prefix[1:m.d - 1]
"""
