"""Exact substring removal: bytes covered by a 200-byte string that starts anywhere else.

Windows of 200 bytes are dealt by their smallest 50-byte hash (equal windows have equal ones), as runs of windows that
share it. A run travels as four numbers; one aggregate tells runs whose smallest hash is alone (nothing repeats), runs that are equal
all through (all repeats), and runs that meet others at an edge. Only distinct runs of the last kind are compared:

* each task puts the bytes of its runs into one pool with prefix polynomial hashes, and mergesorts the suffixes that start at the
  shared 50 bytes. Two suffixes are compared by a binary search for their common extension, so in a logarithm of its length;
  extensions of neighbours are then verified byte by byte;
* windows with i bytes left of the shared place and 200 - i right of it repeat where their suffixes lie in one interval of common
  extensions of 200 - i bytes or more, and the i bytes before them are equal (two polynomial hashes of unlike bases).

Runs are told apart by the smallest hash and a hash of the whole run over another base. If two suffixes with equal hashes have unequal bytes, their
pool is settled by the windows' own bytes instead. The runs of a place with very many distinct ones (an edge of a passage that fills a
share of the corpus) do not fit one task; there, windows are told apart by a cryptographic digest, one by one, over all tasks.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, BASE2, mix, powers, prefix_hash, prepare, settle, spans, tidied, utf8

LENGTH = 200
SEED = 50
CHUNK = 1 << 20
POOL = 16 << 20
MANY = 4096

_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int, base=BASE) -> tuple[np.ndarray, np.ndarray]:
    if int(base) not in _tables or len(_tables[int(base)][0]) <= n:
        _tables[int(base)] = powers(max(n + 1, CHUNK + 1), base)
    return _tables[int(base)]


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """Runs of windows with one (leftmost) smallest seed hash, over texts that lie one after another: that hash, a hash of the run's bytes, first window, number of windows."""
    none = (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    n = len(data)
    if n < length:
        return none
    power, inverse = _powers(n)
    h = prefix_hash(data, power)
    own = low = mix((h[seed:] - h[:-seed]) * inverse[: n - seed + 1])
    width, size = length - seed + 1, 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if width > size:
        low = np.minimum(low[: -(width - size)], low[width - size :])
    step = np.zeros(n + 1, np.int8)
    fit = np.diff(offsets) >= length
    step[offsets[:-1][fit]] += 1
    step[offsets[1:][fit] - length + 1] -= 1
    at = np.flatnonzero(np.cumsum(step[: len(low)], dtype=np.int8))
    if not len(at):
        return none
    low = low[at]
    new = np.ones(len(at), bool)
    # a run also ends where its leftmost smallest seed drops out and an equal one follows, as in periodic text
    new[1:] = (low[1:] != low[:-1]) | (np.diff(at) != 1) | (own[at[:-1]] == low[1:])
    first = np.flatnonzero(new)
    start, count = at[first], np.diff(np.append(first, len(at)))
    end = start + count - 1 + length
    power2, inverse2 = _powers(n, BASE2)
    h2 = prefix_hash(data, power2)
    return low[first], mix((h2[end] - h2[start]) * inverse2[start] + count.astype(np.uint64)), start, count


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key, sub = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        data, offsets = utf8(batch.column(2))
        for i, j in spans(offsets, CHUNK):
            off = offsets[i : j + 1] - offsets[i]
            m, c, start, count = runs(data[offsets[i] : offsets[j]], off)
            doc = np.searchsorted(off, start, "right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (m.view(np.int64), c.view(np.int64), key[i + doc], sub[i + doc], ((start - off[doc]) << 32) | count)], ["m", "c", "key", "sub", "pn"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    z = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        raw = data.data
        text = [z.compress(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "key", "sub")), pa.array(text, pa.binary())], ["doc_id", "key", "sub", "z"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs of each document."""
    z = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = []
        for key, sub, packed, found in zip(*(batch.column(k).to_pylist() for k in ("key", "sub", "z", "found"))):
            text = z.decompress(packed)
            for f in found:
                p, n = f["pn"] >> 32, f["pn"] & 0xFFFFFFFF
                rows.append((f["m"], key, sub, p, n, f["k"], f["hot"], text[p : p + n - 1 + LENGTH]))
        kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.bool_(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 8, kinds)], ["m", "key", "sub", "p", "n", "k", "hot", "bytes"])


class Pool:
    """Bytes of many runs with prefix hashes; extensions of pairs of places, for whole arrays at once."""

    def __init__(self, pieces: list[bytes]):
        self.data = np.frombuffer(b"".join(pieces), np.uint8)
        self.off = np.concatenate(([0], np.cumsum([len(p) for p in pieces]))).astype(np.int64)
        (self.power, self.inverse), (p2, self.inverse2) = _powers(len(self.data)), _powers(len(self.data), BASE2)
        self.h, self.h2 = prefix_hash(self.data, self.power), prefix_hash(self.data, p2)

    def extension(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common extension of places x and y, at most `most`: a binary search over prefix hashes."""
        low, high = np.zeros(len(x), np.int64), most.astype(np.int64)
        hx, hy, ix, iy = self.h[x], self.h[y], self.inverse[x], self.inverse[y]
        while (low < high).any():
            mid = (low + high + 1) >> 1
            same = (self.h[x + mid] - hx) * ix == (self.h[y + mid] - hy) * iy
            low = np.where(same, mid, low)
            high = np.where(same, high, mid - 1)
        return low

    def less(self, x: np.ndarray, y: np.ndarray, ax: np.ndarray, ay: np.ndarray) -> np.ndarray:
        """Whether suffix x (of ax bytes) comes before suffix y (of ay bytes)."""
        most = np.minimum(ax, ay)
        n = self.extension(x, y, most)
        ended = n == most
        cx, cy = (self.data[np.minimum(p + n, len(self.data) - 1)] for p in (x, y))
        return np.where(ended, ax < ay, cx < cy)

    def sort(self, place: np.ndarray, room: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of suffixes within their groups (group ascending): a bottom-up mergesort, all merges of a level at once."""
        order = np.arange(len(place))
        first = np.searchsorted(group, group)
        size = np.bincount(np.unique(first, return_inverse=True)[1])
        size = np.repeat(size, size)
        at = np.arange(len(place)) - first
        width = 1
        while len(size) and width < size.max():
            live = np.flatnonzero(size > width)
            run = at[live] // width
            other = first[live] + (run ^ 1) * width
            end = np.minimum(other + width, first[live] + size[live])
            low, high = np.minimum(other, end), end.copy()
            mine, left = order[live], run % 2 == 0
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                mid = (low[open_] + high[open_]) >> 1
                a, b = mine[open_], order[mid]
                # of equal suffixes those of the left run stay first
                before = np.where(left[open_], self.less(place[b], place[a], room[b], room[a]), ~self.less(place[a], place[b], room[a], room[b]))
                low[open_] = np.where(before, mid + 1, low[open_])
                high[open_] = np.where(before, high[open_], mid)
            base = first[live] + (run // 2) * 2 * width
            to = base + (at[live] - run * width) + np.where(other < end, low - other, 0)
            moved = order.copy()
            moved[to] = mine
            order = moved
            width *= 2
        return order

    def verified(self, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> bool:
        """Byte by byte: whether the extensions hold, and end where they are said to."""
        for i in range(0, len(x), 4096):
            a, b, k = x[i : i + 4096], y[i : i + 4096], n[i : i + 4096]
            at = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            if (self.data[np.repeat(a, k) + at] != self.data[np.repeat(b, k) + at]).any():
                return False
        return True


def by_bytes(pieces: list[bytes], m: np.ndarray, windows: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """What repeated() gives, from the windows' own bytes; equal windows have equal m."""
    out: list[bool] = []
    for i, j in zip(cut := np.flatnonzero(np.diff(m, prepend=~m[:1]) != 0), np.append(cut[1:], len(m))):
        seen = Counter(p[k : k + length] for p, n in zip(pieces[i:j], windows[i:j]) for k in range(n))
        out += [seen[p[k : k + length]] > 1 for p, n in zip(pieces[i:j], windows[i:j]) for k in range(n)]
    return np.array(out, bool)


def repeated(pieces: list[bytes], m: np.ndarray, windows: np.ndarray, length: int = LENGTH, seed: int = SEED) -> np.ndarray:
    """For runs of `windows` windows each (m ascending, the smallest seed hash): whether each window, in turn, is found in another place of the same pool."""
    pool = Pool(pieces)
    total = int(windows.sum())
    begin = np.concatenate(([0], np.cumsum(windows)))
    out = np.zeros(total, bool)
    if not total:
        return out
    # places of the shared seed in each run
    seeds = mix((pool.h[seed:] - pool.h[:-seed]) * pool.inverse[: len(pool.data) - seed + 1])
    owner = np.repeat(np.arange(len(pieces)), np.diff(pool.off))[: len(seeds)]
    place = np.flatnonzero((seeds == m[owner]) & (np.arange(len(seeds)) + seed <= pool.off[owner + 1]))
    own = owner[place]
    previous = np.full(len(place), -1, np.int64)
    previous[1:] = np.where(own[1:] == own[:-1], place[:-1], -1)
    low = np.maximum(np.where(previous >= 0, previous + 1, pool.off[own]), place - (length - seed))
    high = np.minimum(place, pool.off[own] + windows[own] - 1)
    ok = low <= high
    place, own, low, high = place[ok], own[ok], low[ok], high[ok]
    group = np.searchsorted(np.unique(m), m[own])
    room = np.minimum(pool.off[own + 1] - place, length)
    order = pool.sort(place, room, group)
    place, own, low, high, room, group = (x[order] for x in (place, own, low, high, room, group))
    lcp = np.full(len(place), -1, np.int64)
    if len(place) > 1:
        lcp[1:] = np.where(group[1:] == group[:-1], pool.extension(place[1:], place[:-1], np.minimum(room[1:], room[:-1])), -1)
        same = lcp > 0
        if not pool.verified(place[same], place[np.flatnonzero(same) - 1], lcp[same]):
            return by_bytes(pieces, m, windows, length)
    for left in range(length - seed + 1):
        has = np.flatnonzero((place - left >= low) & (place - left <= high))
        if len(has) < 2:
            continue
        interval = np.cumsum(lcp < length - left)[has].astype(np.uint64)
        s, e = place[has] - left, place[has]
        a = mix((pool.h[e] - pool.h[s]) * pool.inverse[s] + interval * np.uint64(0x9E3779B97F4A7C15))
        b = (pool.h2[e] - pool.h2[s]) * pool.inverse2[s]
        by = np.lexsort((b, a))
        twin = (a[by][1:] == a[by][:-1]) & (b[by][1:] == b[by][:-1])
        hit = np.zeros(len(has), bool)
        hit[by[1:][twin]] = True
        hit[by[:-1][twin]] = True
        at = has[hit]
        out[begin[own[at]] + place[at] - left - pool.off[own[at]]] = True
    return out


def _intervals(flag: np.ndarray, windows: np.ndarray, key: np.ndarray, sub: np.ndarray, p: np.ndarray) -> pa.RecordBatch:
    """Flagged windows as byte ranges of their documents."""
    begin = np.concatenate(([0], np.cumsum(windows)))
    edge = np.zeros(len(flag) + 1, bool)
    edge[begin] = True
    f = np.concatenate(([False], flag, [False]))
    first = np.flatnonzero(f[1:-1] & (~f[:-2] | edge[:-1]))
    last = np.flatnonzero(f[1:-1] & (~f[2:] | edge[1:]))
    own = np.searchsorted(begin, first, "right") - 1
    return pa.RecordBatch.from_arrays([pa.array(key[own]), pa.array(sub[own]), pa.array(p[own] + first - begin[own]), pa.array(p[own] + last - begin[own] + LENGTH)], ["key", "sub", "s", "e"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order of m; whole groups are put into a pool until it is full."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        m, key, sub, p, n, k, data = zip(*rows)
        n, k = np.array(n, np.int64), np.array(k)
        flag = repeated(list(data), np.array(m, np.int64).view(np.uint64), n)
        flag &= np.repeat(k == 1, n)  # the others are known to repeat as a whole
        return _intervals(flag, n, np.array(key, np.int64), np.array(sub, np.int32), np.array(p, np.int64))

    held: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in ("m", "key", "sub", "p", "n", "k", "bytes"))):
            if size >= POOL and row[0] != held[-1][0]:
                held.sort(key=lambda r: r[0] & 0xFFFFFFFFFFFFFFFF)
                yield solve(held)
                held, size = [], 0
            held.append(row)
            size += len(row[6])
    if held:
        held.sort(key=lambda r: r[0] & 0xFFFFFFFFFFFFFFFF)
        yield solve(held)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest of every window, as two numbers."""
    for batch in batches:
        for key, sub, p, n, k, data in zip(*(batch.column(c).to_pylist() for c in ("key", "sub", "p", "n", "k", "bytes"))):
            made = b"".join([hashlib.blake2b(data[i : i + LENGTH], digest_size=16).digest() for i in range(n)])
            ab = np.frombuffer(made, np.int64).reshape(n, 2)
            yield pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1]), pa.array(np.full(n, key)), pa.array(np.full(n, sub, np.int32)), pa.array(p + np.arange(n)), pa.array(np.full(n, k))], ["a", "b", "key", "sub", "p", "k"])


def _strip(with_text: bool):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else [])]
    kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            found = batch.column("found")
            for i, (doc, packed) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("z").to_pylist())):
                text = z.decompress(packed)
                cut, spans_, kept, at = 0, 0, [], 0
                if found[i].is_valid:
                    se = found[i].values
                    s, e = (se.field(k).to_numpy() for k in ("s", "e"))
                    by = np.argsort(s, kind="stable")
                    s, e = s[by], np.maximum.accumulate(e[by])
                    new = np.ones(len(s), bool)
                    new[1:] = s[1:] > e[:-1]
                    first = np.flatnonzero(new)
                    for a, b in zip(s[first].tolist(), e[np.append(first[1:], len(s)) - 1].tolist()):
                        kept.append(text[at:a])
                        cut += b - a
                        spans_ += 1
                        at = b
                kept.append(text[at:])
                rest = b"".join(kept)
                rows.append((doc, len(text), cut, spans_, hashlib.sha256(rest).hexdigest(), *([rest] if with_text else [])))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * len(names), kinds)], names)

    return run


def strip(docs: DataFrame, many: int = MANY, with_text: bool = False) -> DataFrame:
    """Of documents (doc_id, text): n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256; with_text adds the bytes kept (`kept`).

    A byte goes if a 200-byte string over it starts anywhere else, in the same text too; strings are judged on the input and never
    cross documents. Null texts are empty, and texts under 200 bytes lose nothing. Repeated rows repeat each other and go
    whole; rows of one doc_id with unlike texts are documents each, as are rows without doc_id. An empty table
    gives no rows; other columns are not read.
    """
    spark = prepare(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # a document is a doc_id (or, without one, a hash) and a hash of its text
    doc = ["key", "sub"]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("key"), F.hash(text, "doc_id").alias("sub"), text.alias("text"))
    rec = settle(docs.select(*doc, "text").mapInArrow(tidied(_runs), "m long, c long, key long, sub int, pn long"), "rec")
    # what is joined with rec is written first: of two plain sides Spark splits the larger where one key is hot
    seen = rec.groupBy("m").agg(F.count(F.lit(1)).alias("t"), F.min("c").alias("c0"), F.max("c").alias("c1")).filter("t > 1")
    met = settle(rec.join(settle(seen.select("m", (F.col("c0") == F.col("c1")).alias("whole")), "seen"), "m"), "runs")
    mixed = met.filter("not whole")
    kinds = mixed.groupBy("m", "c").agg(F.count(F.lit(1)).alias("k"), F.min(F.struct(*doc, "pn")).alias("r"))
    kinds = settle(kinds.select("m", "c", "k", "r.key", "r.sub", "r.pn"), "kinds")
    crowd = settle(kinds.groupBy("m").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > many).select("m", F.lit(True).alias("hot")), "crowd")
    ask = kinds.join(crowd, "m", "left").groupBy(*doc).agg(F.collect_list(F.struct("m", "pn", "k", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("found"))
    packed = docs.mapInArrow(tidied(_packed), "doc_id long, key long, sub int, z binary")
    cut = settle(packed.dropDuplicates(doc).join(ask, doc).mapInArrow(tidied(_cut), "m long, key long, sub int, p long, n long, k long, hot boolean, bytes binary"), "bytes")
    tasks = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    edge = cut.filter("not hot").repartition(tasks, "m").sortWithinPartitions("m").mapInArrow(tidied(_compare), "key long, sub int, s long, e long")
    one = settle(cut.filter("hot").mapInArrow(tidied(_windows), "a long, b long, key long, sub int, p long, k long"), "windows")
    twice = settle(one.groupBy("a", "b").agg(F.count(F.lit(1)).alias("t")).filter("t > 1").select("a", "b"), "twice")
    lone = one.filter("k = 1").join(twice, ["a", "b"]).select(*doc, F.col("p").alias("s"), (F.col("p") + LENGTH).alias("e"))
    start, count = F.shiftrightunsigned("pn", 32), F.col("pn").bitwiseAND(F.lit(0xFFFFFFFF))
    whole = met.filter("whole").select(*doc, "pn").unionByName(mixed.join(kinds.filter("k > 1").select("m", "c"), ["m", "c"]).select(*doc, "pn"))
    whole = whole.select(*doc, start.alias("s"), (start + count + F.lit(LENGTH - 1)).alias("e"))
    found = whole.unionByName(edge).unionByName(lone).groupBy(*doc).agg(F.collect_list(F.struct("s", "e")).alias("found"))
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return packed.join(found, doc, "left").select("doc_id", "z", "found").mapInArrow(tidied(_strip(with_text)), out)


def op2_substrings(spark, sf_dir: str) -> DataFrame:
    return strip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
