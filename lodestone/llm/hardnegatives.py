"""Hard-negative mining by a block matrix multiply over rows and dimensions (SUMMA), added up by a shuffle.

Rows are sorted into tiles by label, and every tile is cut into chunks of dimensions. A product task holds one chunk of one lane of
candidate tiles, meets it with the same chunk of the anchor tiles, and gives a partial whole-number score tile a pair. A shuffle by
(anchor tile, lane) brings the partial tiles of a pair together, where they are added and reduced to lists of k a window at once.

Two rounds share the work, so that every score is made once: pairs of tiles that share a label give the positives, whose scores
set the windows; pairs that hold different labels give the negatives inside them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, settle

TILE_ROWS = 1024
ANCHOR_ROWS = 256
CHUNK = 32
LANE_TILES = 64
#: Bytes of partial tiles that one Arrow batch gathers.
BATCH_BYTES = 4 << 20
#: Bytes of one number that 64 bits do not hold.
WIDE = 24
LOW, HIGH = -(2**63), 2**63 - 1

TILE = "tile long, labels array<long>, chunk int, n int, dim int, width int, ids binary, row_labels binary, mat binary"
PARTIAL = "i long, lane long, j long, chunk int, a_n int, b_n int, width int, mat binary, a_ids binary, a_labels binary, b_ids binary, b_labels binary"


def pack(m: np.ndarray) -> tuple[int, bytes]:
    """Whole numbers in the narrowest form that holds them all: (bytes a number, bytes)."""
    if m.dtype == object:
        return WIDE, b"".join(int(x).to_bytes(WIDE, "little", signed=True) for x in m.ravel())
    low, high = m.min(initial=0), m.max(initial=0)
    width = next(w for w in (1, 2, 4, 8) if -(1 << (8 * w - 1)) <= low and high < 1 << (8 * w - 1))
    return width, m.astype(f"<i{width}").tobytes()


def unpack(width: int, raw: bytes, rows: int, cols: int) -> np.ndarray:
    if width == WIDE:
        flat = [int.from_bytes(raw[k : k + WIDE], "little", signed=True) for k in range(0, len(raw), WIDE)]
        return np.array(flat, object).reshape(rows, cols)
    return np.frombuffer(raw, f"<i{width}").reshape(rows, cols)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T, exact: by floating point where all sums stay below 2**53, by 64-bit numbers below 2**62, else by Python's numbers."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    bound = d * float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0))
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    return a.astype(object) @ b.astype(object).T


def add(parts: list[np.ndarray]) -> np.ndarray:
    """The sum of partial tiles; numbers beyond 64 bits are held at their ends."""
    if len(parts) == 1 and parts[0].dtype != object:
        return parts[0].astype(np.int64)
    most = sum(float(np.abs(p.astype(np.float64)).max(initial=0)) for p in parts)
    if most < 2**62:
        return np.sum([p.astype(np.int64) for p in parts], axis=0, dtype=np.int64)
    return np.clip(np.sum([p.astype(object) for p in parts], axis=0), LOW, HIGH).astype(np.int64)


def _blocks(rows: int, chunk: int):
    """(id, label, components) in order of labels -> tiles of up to `rows` rows, one row a chunk; a tile ends where a label does, if it is an eighth full."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal made, size
            ids, labels = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            dim = max(h[2].shape[1] for h in held)
            mat = np.concatenate([np.pad(h[2], ((0, 0), (0, dim - h[2].shape[1]))) for h in held])
            held.clear()
            size = 0
            tile = (part << 32) + made
            made += 1
            out = []
            for k, at in enumerate(range(0, max(dim, 1), chunk)):
                cut = mat[:, at : at + chunk]
                width, raw = pack(cut)
                first = k == 0
                out.append((tile, np.unique(labels).tolist(), k, len(ids), cut.shape[1], width, ids.tobytes() if first else b"", labels.tobytes() if first else b"", raw))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.list_(pa.int64()), *[pa.int32()] * 4, *[pa.binary()] * 3))],
                ["tile", "labels", "chunk", "n", "dim", "width", "ids", "row_labels", "mat"],
            )

        last = None
        for batch in batches:
            ids, labels = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
            vec = batch.column(2)
            sizes = np.diff(vec.offsets.to_numpy())
            mat = np.zeros((len(ids), int(sizes.max(initial=0))), np.int64)
            mat[np.arange(mat.shape[1]) < sizes[:, None]] = vec.flatten().to_numpy(zero_copy_only=False)
            ends = np.append(np.flatnonzero(np.diff(labels)) + 1, len(labels))
            start = 0
            for end in ends[ends > 0]:
                if size and labels[start] != last and size * 8 >= rows:
                    yield flush()
                last = labels[start]
                while start < end:
                    upto = min(end, start + rows - size)
                    held.append((ids[start:upto], labels[start:upto], mat[start:upto]))
                    size += upto - start
                    start = upto
                    if size >= rows:
                        yield flush()
        if held:
            yield flush()

    return run


def _multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of anchor and candidate tiles of one chunk -> partial score tiles."""
    types = (*[pa.int64()] * 3, *[pa.int32()] * 4, *[pa.binary()] * 5)
    names = [c.split()[0] for c in PARTIAL.split(", ")]
    held, size = [], 0
    for batch in batches:
        for k in range(batch.num_rows):
            r = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
            s = product(unpack(r["a_width"], r["a_mat"], r["a_n"], r["a_dim"]), unpack(r["width"], r["mat"], r["n"], r["dim"]))
            width, raw = pack(s)
            held.append((r["i"], r["lane"], r["tile"], r["chunk"], r["a_n"], r["n"], width, raw, r["a_ids"], r["a_labels"], r["ids"], r["row_labels"]))
            size += len(raw)
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
                held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)


class Tops:
    """Lists of the k best (score descending, id ascending) of numbered slots."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot = self.score = self.id = np.zeros(0, np.int64)
        self.floor = np.full(slots, LOW, np.int64)

    def offer(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = np.concatenate((self.slot, slot)), np.concatenate((self.score, score)), np.concatenate((self.id, ids))
        order = np.lexsort((ids, ~score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        place = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        keep = place < self.k
        self.slot, self.score, self.id = slot[keep], score[keep], ids[keep]
        full = place == self.k - 1
        self.floor[slot[full]] = score[full]


def _reduce(k: int, low: int, high: int):
    """Partial tiles in order of (anchor tile, lane, candidate tile) -> best rows a window, of each anchor tile and lane.

    Where the tile's windows come first (negative j), they ask for other labels within them; without, each anchor asks for its own label.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, pair, parts, tops, wins, names, a_ids = None, None, [], None, None, None, None

        def close_pair() -> None:
            nonlocal tops
            if not parts:
                return
            s = add(parts)
            a_id, a_label, b_id, b_label = names
            same = a_label[:, None] == b_label[None, :]
            if wins is None:
                tops = tops or Tops(len(a_id), k)
                a, b = np.nonzero(same & (s >= tops.floor[:, None]) & (a_id[:, None] != b_id[None, :]))
                tops.offer(a, s[a, b], b_id[b])
            else:
                row, lo, hi = wins
                tops = tops or Tops(len(row), k)
                for at in range(0, len(row), max(1, len(a_id))):
                    w = slice(at, at + max(1, len(a_id)))
                    some = s[row[w]]
                    ok = (some >= np.maximum(lo[w], tops.floor[w])[:, None]) & (some <= hi[w][:, None]) & ~same[row[w]]
                    a, b = np.nonzero(ok)
                    tops.offer(a + at, some[a, b], b_id[b])
            parts.clear()

        def close_cell() -> Iterator[pa.RecordBatch]:
            close_pair()
            if tops is not None and len(tops.slot):
                own = a_ids[tops.slot] if wins is None else np.zeros(len(tops.slot), np.int64)
                n = len(tops.slot)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, cell[0])), pa.array(tops.slot), pa.array(own), pa.array(tops.id), pa.array(tops.score)], ["i", "slot", "anchor_id", "vec_id", "score"])

        for batch in batches:
            col = {name: batch.column(name) for name in batch.schema.names}
            for r in range(batch.num_rows):
                get = lambda name: col[name][r].as_py()  # noqa: B023, E731
                here = get("i"), get("lane")
                if here != cell:
                    if cell is not None:
                        yield from close_cell()
                    cell, pair, tops, wins = here, None, None, None
                if get("j") < 0:
                    asked = get("wins")
                    scores = [w["score"] for w in asked]
                    wins = (
                        np.array([w["a"] for w in asked], np.int64),
                        np.array([max(-((-low * x) // 100), LOW) for x in scores], np.int64),
                        np.array([min(high * x // 100, HIGH) for x in scores], np.int64),
                    )
                    continue
                if get("j") != pair:
                    close_pair()
                    pair = get("j")
                parts.append(unpack(get("width"), get("mat"), get("a_n"), get("b_n")))
                if get("chunk") == 0:
                    names = tuple(np.frombuffer(get(c), np.int64) for c in ("a_ids", "a_labels", "b_ids", "b_labels"))
                    a_ids = names[0]
        if cell is not None:
            yield from close_cell()

    return run


def mine(
    vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256,
    tile_rows: int = TILE_ROWS, anchor_rows: int = ANCHOR_ROWS, chunk: int = CHUNK, lane_tiles: int = LANE_TILES,
) -> DataFrame:
    """Hard negatives of the rows of `vectors` (vec_id, embedding, label) where `is_anchor` holds.

    Components become floor(scale * x); a score is a whole-number inner product. An anchor's positives are its first `positives` other
    rows of the same label; for each, the first `negatives` rows of other labels whose score is between `low` and `high` hundredths
    of the positive's are returned: anchor_id, positive_id, rank, negative_id, positive_score, negative_score. Order is by score, then
    by smaller vec_id. `label` replaces the column.

    Rows whose vec_id, label, vector or any component is null, NaN or infinite take no part; vectors of unequal length meet over the
    shorter one; an empty vector scores 0. A row with the anchor's vec_id is not its positive; repeated ids are candidates each, and
    repeated anchors are answered each. No rows, no anchors, or one label only give no rows. Other columns are not read. Scores beyond
    64 bits are held at its ends. A label may hold any share of the rows: its rows lie in many tiles.

    Partial tiles are shuffled once: anchors times rows times chunks, in the narrowest numbers that hold them.
    """
    spark = prepare(vectors.sparkSession)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), (F.col("label") if label is None else label).cast("long").alias("y"), "embedding", is_anchor.alias("is_a"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("y").isNotNull() & F.col("embedding").isNotNull() & finite)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    n, n_a = rows.agg(F.count(F.lit(1)), F.count_if("is_a")).first()
    lanes = max(1, -(-n // (tile_rows * lane_tiles)), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // tile_rows)))

    def tiles(some: DataFrame, count: int, per: int, what: str) -> DataFrame:
        spread = F.xxhash64("vec_id")
        ranged = some.select("vec_id", "y", whole.alias("v"), spread.alias("spread")).repartitionByRange(max(1, -(-count // (per * 4))), "y", "spread")
        return settle(ranged.sortWithinPartitions("y", "spread").select("vec_id", "y", "v").mapInArrow(_blocks(per, chunk), TILE), what)

    b = tiles(rows, n, tile_rows, "candidates").withColumn("lane", F.pmod(F.xxhash64("tile"), F.lit(lanes)))
    a = tiles(rows.filter("is_a"), n_a, anchor_rows, "anchors").select(F.col("tile").alias("i"), "chunk", *[F.col(c).alias(f"a_{c}") for c in ("labels", "n", "dim", "width", "mat")], F.col("ids").alias("a_ids"), F.col("row_labels").alias("a_row_labels"))
    every_lane = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long")))
    chunks = (b.agg(F.max("chunk")).first()[0] or 0) + 1
    # Both sides are dealt by (lane, chunk); in a merge join an anchor chunk meets all candidate chunks of its lane in turn.
    grid = lanes * chunks
    left = a.withColumn("lane", every_lane).repartition(grid, "lane", "chunk")
    right = b.repartition(grid, "lane", "chunk")

    def partials(wanted: Column) -> DataFrame:
        cells = left.hint("merge").join(right, ["lane", "chunk"]).filter(wanted)
        cells = cells.select("i", "lane", "tile", "chunk", "a_n", "a_dim", "a_width", "a_mat", "a_ids", F.col("a_row_labels").alias("a_labels"), "n", "dim", "width", "mat", "ids", "row_labels")
        return cells.mapInArrow(_multiply, PARTIAL)

    best = "i long, slot long, anchor_id long, vec_id long, score long"
    found = partials(F.arrays_overlap("a_labels", "labels"))
    found = found.repartition("i", "lane").sortWithinPartitions("i", "lane", "j", "chunk").mapInArrow(_reduce(positives, low, high), best)
    w = Window.partitionBy("i", "slot").orderBy(F.col("score").desc(), "vec_id")
    found = settle(found.withColumn("p", F.row_number().over(w)).filter(F.col("p") <= positives), "positives")

    # The windows of an anchor tile: at most anchor_rows * positives, in one row; a window's place in it is its slot.
    by_tile = found.groupBy("i").agg(F.sort_array(F.collect_list(F.struct(F.col("slot").alias("a"), "p", "anchor_id", F.col("vec_id").alias("positive_id"), "score"))).alias("wins"))
    by_tile = settle(by_tile, "windows")
    asks = by_tile.withColumn("lane", every_lane).withColumn("j", F.lit(-1).cast("long"))
    pure = (F.size("a_labels") == 1) & (F.size("labels") == 1) & (F.col("a_labels")[0] == F.col("labels")[0])
    stream = partials(~pure).unionByName(asks, allowMissingColumns=True)
    hard = stream.repartition("i", "lane").sortWithinPartitions("i", "lane", "j", "chunk").mapInArrow(_reduce(negatives, low, high), best)
    w = Window.partitionBy("i", "slot").orderBy(F.col("score").desc(), "vec_id")
    hard = hard.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= negatives)
    windows = by_tile.select("i", F.posexplode("wins").alias("slot", "win")).withColumn("slot", F.col("slot").cast("long"))
    return hard.drop("anchor_id").join(windows, ["i", "slot"]).select(
        F.col("win.anchor_id").alias("anchor_id"), F.col("win.positive_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), F.col("win.score").alias("positive_score"), F.col("score").alias("negative_score"),
    )


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors, F.col("vec_id") % 100 == 0, moved)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS y,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS anchor_id, c.vec_id AS vec_id, q.y = c.y AS same,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""
