"""N-gram Jaccard join: exact classes of documents whose word shingles have a Jaccard index of 0.8 or more.

1. A pass over the texts gives each document's set size and a 128-bit set hash; equal sets become one node, whatever doc_ids they have.
   The pass also counts shingles in a table of fixed size, whose sums order shingles from rare to common.
2. Two sets that link share one of their rarest |x| - ceil(0.8 |x|) + 1 shingles. A second pass deals these to tiles by shingle;
   in a tile, sorted by size, only nodes of neighbouring size bands meet. A shingle with more rows than a tile takes is spread over tiles.
3. Bit counts of the two hashed bitmaps, whose width follows the set's size, bound the overlap from above; what passes is settled by
   intersecting the sorted shingle arrays.
4. A shingle with more than `tile_most` nodes never lists its pairs. Its nodes meet a pivot first; then nodes outside its largest
   component try their best partners by bit counts in one block of its nodes, for TURNS rounds; only what is still outside
   meets all of its nodes, in blocks. So a family of near copies costs a few checks for each member.
Links between nodes already known to be connected are not checked: only components are asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, mix, powers, prefix_hash, prepare, settle, spans, tidied, utf8, word_spans
from .components import components

WORDS = 5
PERCENT = 80
TILE_MOST = 64
SKETCH_BITS = 20
SLICES = 16
BITS = 8
#: Bits (a power of two) of the bitmap of wanted texts.
MARK_BITS = 25
#: Nodes whose numbers may be broadcast (8 bytes each).
IDS = 1 << 19
BLOCK = 256
#: Rounds in which a node of a hot shingle tries only its BEST partners of one block, before all that is left is tried.
TURNS = 1
BEST = 4
#: Rows of one shingle that one tile takes.
SPREAD_AT = 1 << 18
CHUNK = 1 << 20

_tables: list[tuple[np.ndarray, np.ndarray]] = []


def shingles(data: np.ndarray, offsets: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles, ascending within a text, and the first of each text (one more at the end)."""
    if not _tables or len(_tables[0][0]) <= len(data):
        _tables[:] = [powers(max(len(data) + 1, CHUNK + 1))]
    power, inverse = _tables[0]
    low = LOWER[data]
    start, end, first = word_spans(low, offsets)
    h = prefix_hash(low, power)
    word = mix((h[end] - h[start]) * inverse[start])
    count = np.diff(first)
    made = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(len(count)), made)
    if not len(doc):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    begin = np.concatenate(([0], np.cumsum(made)))
    at = np.arange(len(doc)) - begin[doc] + first[doc]
    size = np.minimum(count, n)[doc]
    out = np.zeros(len(doc), np.uint64)
    for k in range(n):
        live = size > k
        step = mix(out[live] * np.uint64(0x9FB21C651E98DF25) + word[at[live] + k])
        out[live] = step
    order = np.lexsort((out, doc))
    out, doc = out[order], doc[order]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    return out[keep], np.concatenate(([0], np.cumsum(np.bincount(doc[keep], minlength=len(count)))))


def _sums(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    c = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x, out=c[1:])
    return c[first[1:]] - c[first[:-1]]


def bitmaps(h: np.ndarray, first: np.ndarray) -> list[bytes]:
    """A bitmap for each set, of a power of two of bits that is BITS a shingle or more, so that it fills alike at every size."""
    size = np.diff(first)
    width = np.left_shift(1, np.ceil(np.log2(np.maximum(size * BITS, 64))).astype(np.int64))
    begin = np.concatenate(([0], np.cumsum(width)))
    bits = np.zeros(begin[-1], np.uint8)
    doc = np.repeat(np.arange(len(size)), size)
    bits[begin[doc] + ((h >> np.uint64(20)).astype(np.int64) & (width[doc] - 1))] = 1
    raw = np.packbits(bits).tobytes()
    return [raw[x // 8 : y // 8] for x, y in zip(begin[:-1].tolist(), begin[1:].tolist())]


def folded(x: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps (a row each) as they are at a smaller width, in bytes."""
    return x if x.shape[1] == width else np.bitwise_or.reduce(x.reshape(len(x), -1, width), axis=1)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "t1", "t2", "n_shingles", "s1", "s2", "slice", "counts"]
    counts = np.zeros(1 << SKETCH_BITS, np.uint32)
    shift = np.uint64(64 - SKETCH_BITS)
    for batch in batches:
        data, offsets = utf8(batch.column(3))
        out: list[tuple] = []
        for i, j in spans(offsets, CHUNK):
            h, first = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            counts += np.bincount((h >> shift).astype(np.int64), minlength=len(counts)).astype(np.uint32)
            s1, s2 = _sums(mix(h), first).view(np.int64), _sums(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first).view(np.int64)
            out.append((np.diff(first), s1, s2))
        n = len(offsets) - 1
        cat = lambda k: pa.array(np.concatenate([o[k] for o in out]) if out else [], pa.int64())
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), cat(0), cat(1), cat(2), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
    parts = counts.reshape(SLICES, -1)
    none = pa.nulls(SLICES, pa.int64())
    yield pa.RecordBatch.from_arrays([none] * 6 + [pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in parts])], names)


def _add_counts(table: pa.Table) -> pa.Table:
    total = np.zeros((1 << SKETCH_BITS) // SLICES, np.uint64)
    for c in table["counts"]:
        total += np.frombuffer(c.as_buffer(), np.uint32)
    return pa.table({"slice": table["slice"][:1], "counts": [np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes()]})


def _prefixes(sketch, tiles: int, spread_at: int):
    """Rows of (tile, open, shingles, nodes, sizes), each a run of packed numbers; a node is dealt once by a task.

    A shingle that the sketch counts over `spread_at` times is spread over as many tiles as that takes, and marked open: its pairs are not listed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        shift = np.uint64(64 - SKETCH_BITS)
        seen: set[int] = set()
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            got: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for i, j in spans(offsets, CHUNK):
                h, first = shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                node = _sums(mix(h), first)
                size = np.diff(first)
                fresh = np.array([x not in seen for x in node.tolist()], bool) & (size > 0)
                if len(seen) > 200_000:
                    seen.clear()
                seen.update(node.tolist())
                doc = np.repeat(np.arange(len(size)), size)
                h, doc = h[fresh[doc]], doc[fresh[doc]]
                order = np.lexsort((h, counts[(h >> shift).astype(np.int64)], doc))
                h, doc = h[order], doc[order]
                at = np.arange(len(h)) - np.searchsorted(doc, doc)
                keep = at < size[doc] - (PERCENT * size[doc] + 99) // 100 + 1
                got.append((h[keep], node[doc[keep]], size[doc[keep]].astype(np.int32)))
            if not got:
                continue
            h, node, size = (np.concatenate([g[k] for g in got]) for k in range(3))
            lanes = counts[(h >> shift).astype(np.int64)].astype(np.uint64) // np.uint64(spread_at)
            tile = ((((h >> np.uint64(8)) + mix(node) % (lanes + np.uint64(1))) % np.uint64(tiles)) * np.uint64(2) + (lanes > 0)).astype(np.int64)
            order = np.argsort(tile, kind="stable")
            h, node, size, tile = h[order], node[order], size[order], tile[order]
            cut = np.flatnonzero(np.diff(tile, prepend=-1))
            end = np.append(cut[1:], len(tile))
            yield pa.RecordBatch.from_arrays(
                [pa.array((tile[cut] // 2).astype(np.int32)), pa.array(tile[cut] % 2 == 1), *(pa.array([x[a:b].tobytes() for a, b in zip(cut, end)], pa.binary()) for x in (h, node, size))],
                ["tile", "open", "shingles", "nodes", "sizes"],
            )

    return run


def tile_pairs(h: np.ndarray, node: np.ndarray, size: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (smaller node, larger node) that share a shingle and whose sizes are within the ratio, and the places in h of shingles with over `most` nodes."""
    order = np.lexsort((node, size, h))
    h, node, size = h[order], node[order], size[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (node[1:] != node[:-1])
    h, node, size = h[keep], node[keep], size[keep]
    order = order[keep]
    cut = np.flatnonzero(np.diff(h, prepend=~h[:1]) != 0) if len(h) else np.zeros(0, np.int64)
    run = np.diff(np.append(cut, len(h)))
    n = np.repeat(run, run)
    hot = n > most
    left = np.flatnonzero((n > 1) & ~hot)
    a, b = [], []
    h1, s1, k1 = h[left], size[left].astype(np.int64), node[left]
    live = np.arange(len(left))
    d = 1
    while len(live):
        live = live[live + d < len(left)]
        live = live[(h1[live] == h1[live + d]) & (100 * s1[live] >= PERCENT * s1[live + d])]
        a.append(np.minimum(k1[live], k1[live + d]))
        b.append(np.maximum(k1[live], k1[live + d]))
        d += 1
    none = np.zeros(0, np.uint64)
    return np.concatenate(a or [none]), np.concatenate(b or [none]), order[hot]


def _tiles(most: int):
    """kind 0: (a, b, shared shingles) of a pair; kind 1: (shingle, node, size) of a shingle with too many nodes for pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for t, is_open, *x in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if is_open:
                    yield _kinds(1, *(np.frombuffer(b, d) for b, d in zip(x, (np.uint64, np.uint64, np.int32))))
                else:
                    held.setdefault(t, []).append(x)
        for t in list(held):
            rows = held.pop(t)
            h, node, size = (np.frombuffer(b"".join(r[k] for r in rows), d) for k, d in enumerate((np.uint64, np.uint64, np.int32)))
            a, b, hot = tile_pairs(h, node, size, most)
            if len(a):
                pair = np.stack([a, b], 1).view("u8,u8").ravel()
                pair, n = np.unique(pair, return_counts=True)
                yield _kinds(0, pair["f0"], pair["f1"], n)
            if len(hot):
                yield _kinds(1, h[hot], node[hot], size[hot])

    return run


def _kinds(kind: int, a, b, n) -> pa.RecordBatch:
    cols = [pa.array(np.full(len(a), kind, np.int32)), pa.array(np.ascontiguousarray(a).view(np.int64)), pa.array(np.ascontiguousarray(b).view(np.int64)), pa.array(np.asarray(n, np.int64))]
    return pa.RecordBatch.from_arrays(cols, ["kind", "a", "b", "n"])


def enough(overlap, na, nb):
    """Whether an overlap makes a link: 100 * overlap >= 80 * union."""
    return 100 * overlap >= PERCENT * (na + nb - overlap)


def bound(x: np.ndarray, y: np.ndarray, na, nb) -> np.ndarray:
    """The overlap at most: each bit that one bitmap has alone stands for a shingle that the other set lacks."""
    width = min(x.shape[1], y.shape[1])
    x, y = folded(x, width), folded(y, width)
    return np.minimum(na - np.bitwise_count(x & ~y).sum(1, dtype=np.int64), nb - np.bitwise_count(y & ~x).sum(1, dtype=np.int64))


def _by_width(column: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Places and bitmaps (a row each) by width."""
    width = np.array([len(b) for b in column], np.int64)
    return {w: (at := np.flatnonzero(width == w), np.frombuffer(b"".join([column[i] for i in at]), np.uint8).reshape(len(at), w)) for w in np.unique(width).tolist()}


def _by_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
        ba, bb = batch.column("ba").to_pylist(), batch.column("bb").to_pylist()
        ok = np.zeros(len(na), bool)
        for at, x in _by_width(ba).values():
            for some, y in _by_width([bb[i] for i in at]).values():
                ok[at[some]] = enough(bound(x[some], y, na[at[some]], nb[at[some]]), na[at[some]], nb[at[some]])
        yield batch.filter(pa.array(ok)).select(["a", "b"])


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of a bitmap of fixed size with a bit for each text hash."""
    bits = np.zeros(1 << MARK_BITS, bool)
    for batch in batches:
        bits[batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - MARK_BITS)] = True
    at = np.flatnonzero(bits.reshape(SLICES, -1).any(1))
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array([np.packbits(x).tobytes() for x in bits.reshape(SLICES, -1)[at]], pa.binary())], ["slice", "bits"])


def _add_marks(table: pa.Table) -> pa.Table:
    total = np.zeros((1 << MARK_BITS) // SLICES // 8, np.uint8)
    for c in table["bits"]:
        total |= np.frombuffer(c.as_buffer(), np.uint8)
    return pa.table({"slice": table["slice"][:1], "bits": [total.tobytes()]})


def _marked(wanted: DataFrame) -> np.ndarray:
    """The bitmap of the wanted texts: where a bit is missing, a text is not wanted, so most others never travel."""
    sums = wanted.select("t1").mapInArrow(_marks, "slice int, bits binary").groupBy("slice").applyInArrow(_add_marks, "slice int, bits binary")
    parts = {r["slice"]: np.frombuffer(r["bits"], np.uint8) for r in sums.collect()}  # SLICES rows, 4 MB in all
    return np.concatenate([parts.get(k, np.zeros((1 << MARK_BITS) // SLICES // 8, np.uint8)) for k in range(SLICES)])


def _zipped(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        bits = sent.value
        for batch in batches:
            at = batch.column(1).to_numpy().view(np.uint64) >> np.uint64(64 - MARK_BITS)
            batch = batch.filter(pa.array(bits[at >> np.uint64(3)] & (np.uint8(128) >> (at & np.uint64(7)).astype(np.uint8)) > 0))
            data, offsets = utf8(batch.column(3))
            raw = data.data
            texts = pa.array([z.compress(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), texts], ["doc_id", "t1", "t2", "z"])

    return run


def _mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps of the sets beside their texts."""
    for batch in batches:
        data, offsets = _unzipped(batch.column("z"))
        maps: list[bytes] = []
        for i, j in spans(offsets, CHUNK):
            maps += bitmaps(*shingles(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
        yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("n"), pa.array(maps, pa.binary()), batch.column("z")], ["node", "n", "bitmap", "z"])


def _unzipped(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    z = zstandard.ZstdDecompressor()
    return utf8(pa.array([z.decompress(x) for x in column.to_pylist()], pa.large_binary()))


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        da, oa = _unzipped(batch.column("ta"))
        db, ob = _unzipped(batch.column("tb"))
        keep = np.zeros(len(oa) - 1, bool)
        for i, j in spans(oa + ob, CHUNK):
            ha, fa = shingles(da[oa[i] : oa[j]], oa[i : j + 1] - oa[i])
            hb, fb = shingles(db[ob[i] : ob[j]], ob[i : j + 1] - ob[i])
            for k in range(j - i):
                x, y = ha[fa[k] : fa[k + 1]], hb[fb[k] : fb[k + 1]]
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                keep[i + k] = len(both) and enough(int((both[1:] == both[:-1]).sum()), len(x), len(y))
        yield batch.filter(pa.array(keep)).select(["a", "b"])


def _against_blocks(best: int | None):
    """Blocks of a shingle's nodes outside its largest component, against blocks of all its nodes: the pairs that bit counts leave, of each node outside the `best` ones by overlap, or all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                few, many = r["few"], r["many"]
                ids, labels, size = (np.array([m[k] for m in many], np.int64) for k in ("node", "label", "n"))
                maps = _by_width([m["bitmap"] for m in many])
                me, other, score = [], [], []
                for f in few:
                    x = np.frombuffer(f["bitmap"], np.uint8)[None]
                    at, over = [], []
                    for some, y in maps.values():
                        ok = (labels[some] != f["label"]) & (PERCENT * np.maximum(size[some], f["n"]) <= 100 * np.minimum(size[some], f["n"]))
                        if ok.any():
                            most = bound(x, y[ok], f["n"], size[some][ok])
                            keep = enough(most, f["n"], size[some][ok])
                            at.append(some[ok][keep])
                            over.append(most[keep] / (f["n"] + size[some][ok][keep] - most[keep]))
                    if not at:
                        continue
                    to, over_ = np.concatenate(at), np.concatenate(over)
                    if best is not None and len(to) > best:
                        pick = np.argsort(-over_, kind="stable")[:best]
                        to, over_ = to[pick], over_[pick]
                    me.append(np.full(len(to), f["node"]))
                    other.append(ids[to])
                    score.append(over_)
                if me:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (me, other, score)], ["me", "other", "score"])

    return run


def _only(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of these nodes (node). Up to IDS of them are broadcast, so that no other text travels; they are counted first."""
    ids = settle(ids.distinct(), "ids")
    return texts.join(F.broadcast(ids), "node", "left_semi") if ids.count() <= IDS else texts


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of pairs (a, b) of nodes, those that link: bit counts first, then whole texts."""
    one, two = (texts.select(F.col("node").alias(k), F.col("n").alias(f"n{k}"), F.col("bitmap").alias(f"b{k}")) for k in "ab")
    near = pairs.hint("merge").join(one, "a").hint("merge").join(two, "b").filter("100 * least(na, nb) >= 80 * greatest(na, nb)").mapInArrow(tidied(_by_bits), "a long, b long")
    near = settle(near, "near")
    t = texts.select(F.col("node").alias("a"), F.col("z").alias("ta")), texts.select(F.col("node").alias("b"), F.col("z").alias("tb"))
    return near.hint("merge").join(t[0], "a").hint("merge").join(t[1], "b").select("a", "b", "ta", "tb").mapInArrow(tidied(_exact), "a long, b long")


def _open(hot: DataFrame, known: DataFrame, texts: DataFrame) -> DataFrame:
    """Nodes of the hot shingles that hold more than one component, with their shingle's largest component and counts."""
    marked = settle(hot.join(known, "node", "left").select("shingle", "node", F.coalesce("component", "node").alias("label")), "marked")
    split = marked.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("k"))
    split = split.groupBy("shingle").agg(F.count(F.lit(1)).alias("labels"), F.max(F.struct("k", "label")).alias("m"), F.sum("k").alias("total")).filter("labels > 1")
    split = settle(split.select("shingle", F.col("m.label").alias("main"), F.expr("total - m.k").alias("few"), "total"), "split")
    rows = settle(marked.join(split, "shingle"), "rows")
    return settle(rows.join(_only(texts.select("node", "n", "bitmap"), rows.select("node")), "node"), "open")


def _across(rows: DataFrame, best: int | None, turn: int = 0) -> DataFrame:
    """Pairs (me, other, score) of nodes of open shingles: of each node outside the largest component the `best` in one block of all nodes, drawn by `turn`; or, without `best`, all that pass."""
    member = F.struct("node", "label", "n", "bitmap")
    blocks = lambda size: F.ceil(F.col(size) / F.lit(BLOCK)).cast("long")
    few = rows.filter("label <> main").withColumn("i", F.pmod(F.xxhash64("node"), blocks("few"))).groupBy("shingle", "i").agg(F.collect_list(member).alias("few"))
    many = rows.withColumn("j", F.pmod(F.xxhash64("node"), blocks("total")))
    if best is not None:
        many = many.filter(F.col("j") == F.pmod(F.lit(turn), blocks("total")))
    many = many.groupBy("shingle", "j").agg(F.collect_list(member).alias("many"))
    return few.join(many, "shingle").select("few", "many").mapInArrow(tidied(_against_blocks(best)), "me long, other long, score double")


def _ties(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b) of nodes that one doc_id holds: rows of one doc_id with unlike texts are one document."""
    rows = sets.filter("n_shingles > 0 and doc_id is not null").select("doc_id", F.struct("s1", "s2").alias("s"))
    several = settle(rows.groupBy("doc_id").agg(F.min("s").alias("lo"), F.max("s").alias("hi")).filter("lo <> hi").select("doc_id", "lo"), "several")
    one, two = (nodes.select(F.struct("s1", "s2").alias(s), F.col("node").alias(k)) for s, k in (("s", "a"), ("lo", "b")))
    return rows.join(several, "doc_id").filter("s <> lo").select("s", "lo").distinct().join(one, "s").join(two, "lo").select("a", "b")


def join(docs: DataFrame, tile_most: int = TILE_MOST, spread_at: int = SPREAD_AT) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links reach, itself included) of every document (doc_id, text).

    Words are runs of bytes other than 0x20 and 0x09 to 0x0D, A to Z lower-cased; a set holds the distinct runs of five words, or
    all words where there are fewer. Null, empty and wordless texts have no shingles and link with nothing. Repeated
    rows are a row each; rows of one doc_id with unlike texts have sets of their own and are in one component; a null doc_id is in no component (null); an empty table gives no rows; other columns are not read.
    """
    spark = prepare(docs.sparkSession)
    tasks = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = F.col("text").cast("string")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(3), text).alias("t2"), text.alias("text"))
    made = settle(docs.mapInArrow(tidied(_nodes), "doc_id long, t1 long, t2 long, n_shingles long, s1 long, s2 long, slice int, counts binary"), "sets")
    sums = made.filter("slice is not null").select("slice", "counts").groupBy("slice").applyInArrow(_add_counts, "slice int, counts binary")
    parts = {r["slice"]: r["counts"] for r in sums.collect()}  # SLICES rows, 4 MB in all
    counts = np.concatenate([np.frombuffer(parts[k], np.uint32) for k in range(SLICES)]) if parts else np.zeros(1 << SKETCH_BITS, np.uint32)
    sets = made.filter("slice is null").drop("slice", "counts")
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    # a node is a set; s1 stands for it in tiles, and one row of its smallest doc_id gives its text
    nodes = sets.filter("n_shingles > 0 and doc_id is not null").groupBy("s1", "s2").agg(F.min(F.struct("doc_id", "t1", "t2")).alias("r"), F.max("n_shingles").alias("n"))
    nodes = settle(nodes.select(F.monotonically_increasing_id().alias("node"), "s1", "s2", "n", "r.doc_id", "r.t1", "r.t2"), "nodes")
    tiles = int(max(tasks, total // 5 // 400_000))
    dealt = docs.select("text").mapInArrow(tidied(_prefixes(spark.sparkContext.broadcast(counts), tiles, spread_at)), "tile int, open boolean, shingles binary, nodes binary, sizes binary")
    found = settle(dealt.repartition(tiles, "tile").mapInArrow(tidied(_tiles(tile_most)), "kind int, a long, b long, n long"), "tiles")
    ids = nodes.select("s1", "node")
    pairs = found.filter("kind = 0").groupBy("a", "b").agg(F.sum("n").alias("shared"))
    pairs = pairs.join(ids.select(F.col("s1").alias("a"), F.col("node").alias("x")), "a").join(ids.select(F.col("s1").alias("b"), F.col("node").alias("y")), "b")
    pairs = settle(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "shared").filter("a <> b"), "pairs")
    hot = found.filter("kind = 1").join(ids.select(F.col("s1").alias("b"), "node"), "b")
    hot = settle(hot.select(F.col("a").alias("shingle"), "node", F.col("n").alias("size")).distinct(), "hot")

    # first links: each node with the partner that shares most, and each node of a hot shingle with a pivot, the node that has most of its shingles there
    sides = pairs.select("a", "b", "shared", F.col("a").alias("me")).unionByName(pairs.select("a", "b", "shared", F.col("b").alias("me")))
    first = sides.groupBy("me").agg(F.max(F.struct("shared", -F.col("a"), -F.col("b"), "a", "b")).alias("p")).select("p.a", "p.b")
    weight = hot.groupBy("node").agg((F.count(F.lit(1)) / F.max("size")).alias("w"))
    pivots = hot.join(weight, "node").groupBy("shingle").agg(F.max(F.struct("w", -F.col("node"), "node")).alias("p")).select("shingle", F.col("p.node").alias("pivot"))
    star = hot.join(settle(pivots, "pivots"), "shingle").filter("node <> pivot").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
    tried = settle(first.unionByName(star).distinct(), "first")
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).unionByName(hot.select("node")).distinct()
    wanted = settle(nodes.join(wanted, "node").select("node", "n", "doc_id", "t1", "t2"), "wanted")
    # texts travel compressed, one row a node however many copies there are; what grows with the corpus is merged at every size, never broadcast
    marks = spark.sparkContext.broadcast(_marked(wanted))
    zipped = docs.filter("doc_id is not null").mapInArrow(tidied(_zipped(marks)), "doc_id long, t1 long, t2 long, z binary")
    texts = zipped.join(wanted.hint("merge"), ["doc_id", "t1", "t2"]).dropDuplicates(["doc_id", "t1", "t2"])
    texts = settle(texts.select("node", "n", "z").mapInArrow(tidied(_mapped), "node long, n long, bitmap binary, z binary"), "texts")
    links = settle(_links(tried, texts), "links")
    known = components(links.unionByName(_ties(sets, nodes)))

    # then whatever joins two components: pairs of the other shingles, and in hot ones the best of a few blocks first, then all that is left
    label = lambda side, name: known.select(F.col("node").alias(side), F.col("component").alias(name))
    rest = pairs.join(label("a", "la"), "a", "left").join(label("b", "lb"), "b", "left")
    rest = rest.filter(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b").join(tried, ["a", "b"], "left_anti")
    for turn in range(TURNS + 1):
        rows = _open(hot, known, texts)
        closed = rows.isEmpty()
        if closed and turn:
            break
        pair = F.least("me", "other").alias("a"), F.greatest("me", "other").alias("b")
        if closed:
            some = rest
        elif turn < TURNS:
            some = _across(rows, BEST, turn).select(*pair, "me", "score").join(tried, ["a", "b"], "left_anti")
            some = some.groupBy("me").agg(F.max(F.struct("score", "a", "b")).alias("p")).select("p.a", "p.b")
            some = some.unionByName(rest) if turn == 0 else some
        else:
            some = _across(rows, None).select(*pair).join(tried, ["a", "b"], "left_anti")
        some = settle(some.distinct(), "across")
        if not some.isEmpty():
            tried = settle(tried.unionByName(some), "tried")
            ids = some.select(F.col("a").alias("node")).unionByName(some.select(F.col("b").alias("node")))
            more = settle(_links(some, _only(texts, ids)), "links")
            if not more.isEmpty():
                known = components(more.unionByName(known.select(F.col("node").alias("a"), F.col("component").alias("b"))))
        if closed:
            break

    # a component has the smallest doc_id of its nodes
    member = nodes.join(known, "node").select("s1", "s2", "component", "doc_id")
    least = settle(member.groupBy("component").agg(F.min("doc_id").alias("component_id")), "least")
    reach = settle(member.join(least, "component").select("s1", "s2", F.col("component_id").alias("far")), "reach")
    own = nodes.select("s1", "s2", F.col("doc_id").alias("near"))
    out = sets.select("doc_id", "n_shingles", "s1", "s2").join(settle(own.join(reach, ["s1", "s2"], "left"), "roots"), ["s1", "s2"], "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("far", "near", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each component the row with the smallest doc_id (and documents without shingles, and those without doc_id); columns stay. Rows that repeat that doc_id all stay."""
    spark = prepare(docs.sparkSession)
    found = join(docs.select("doc_id", "text"))
    drop = settle(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("__drop")).distinct(), "copies")
    return docs.join(drop, F.col("doc_id").cast("long") == F.col("__drop"), "left_anti")


def op1_jaccard(spark, sf_dir: str) -> DataFrame:
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')))
                      WHEN len(ws) >= 1 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
l AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM e x JOIN e y ON x.g = y.g AND x.doc_id <> y.doc_id
  GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM s JOIN r ON r.a = s.doc_id GROUP BY s.doc_id, sh
"""
