"""Near-duplicate join of vectors by cosine: exact, pruned by angles to pivots, in tiles.

Angles between vectors obey the triangle inequality. Two vectors within an angle `a` of each other therefore differ by at most `a` in their angle
to any pivot, and if x lies nearest to pivot p, then y is at most 2a further from p than from its own nearest pivot. So each vector is at home
with its nearest pivot, in a band of its angle to it, and visits only cells and bands where a partner can be; each pair meets once. Rows of a
cell and band are packed into tiles of bounded size, and pairs of tiles are compared as matrix products, so a crowded cell
is many tasks' work. Equal vectors are one class first: copies cost one row.

Where angles tell little (a wide angle, vectors without clusters), a row would visit nearly all places. A sample tells, and such vectors are dealt
to groups instead, of which each pair is compared: a row is then sent as often as there are groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import settle, ship
from .retrieval import DIGITS

#: Pivots at most, and numbers that they hold at most together.
PIVOTS, NUMBERS = 1024, 4 << 20
#: Vectors to a pivot, in the mean, where there are not too many pivots.
CELL_ROWS = 256
TILE_ROWS = 512
#: Parts that the rows of one cell and band are dealt to for packing.
SALT = 16
#: Rows that a group of the plain square has at least and at most, and groups where neither holds.
GROUP_ROWS, GROUPS = (1024, 16384), 16
#: Rows that the visits are judged by, and visits that one Arrow batch holds.
JUDGED, VISITS = 256, 1 << 14
#: Slack of angles against rounding.
SLACK = 1e-6
#: Bands are no narrower, in radians.
BAND = 0.02

PLACED = "cell int, band int, home boolean, dim int, id long, fresh boolean, v binary"
TILE = "tile long, cell int, band int, home boolean, dim int, any_fresh boolean, ids binary, fresh binary, v binary"


def classes(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", fresh: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(id, rep) of every row whose vector is there, finite and not empty or zero, and the classes of equal vectors: (id, fresh, v), named by their least id (of rows that are not fresh, if any)."""
    ok = F.size(vec) > 0
    ok = ok & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(vec, lambda x: x != 0)
    rows = vectors.where(F.col(key).isNotNull() & ok).select(F.col(key).cast("long").alias("id"), (F.col(fresh) if fresh else F.lit(True)).alias("fresh"), F.transform(vec, lambda x: x.cast("float") + F.lit(0.0).cast("float")).alias("v"))
    least = rows.groupBy("v").agg(F.min(F.struct("fresh", "id")).alias("least"))
    reps = settle(least.select("least.id", "least.fresh", "v"), "classes")
    return rows.join(reps.select(F.col("id").alias("rep"), "v"), "v").select("id", "rep"), reps


def _matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, float32 matrix) of the vectors of each length."""
    sizes, off = np.diff(column.offsets.to_numpy()), column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float32)
    return [((at := np.flatnonzero(sizes == n)), flat[off[at][:, None] + np.arange(n)]) for n in np.unique(sizes)]


def _unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _visits(v: np.ndarray, pivots: np.ndarray | None, angle: float) -> tuple[np.ndarray, ...]:
    """(row, cell, whether it is the row's own, first band, last band, its band there) of the cells that unit vectors are in or visit."""
    width = max(angle, BAND)
    far = np.arccos(np.clip(v @ pivots.T, -1, 1)) if pivots is not None else np.zeros((len(v), 1))
    home = far.argmin(1)
    near = far[np.arange(len(v)), home]
    # cells before a row's own that may hold a partner, and its own
    row, cell = np.nonzero((far <= near[:, None] + 2 * angle + SLACK) & (np.arange(far.shape[1]) <= home[:, None]))
    own = cell == home[row]
    low = np.maximum(0, np.floor((far[row, cell] - angle - SLACK) / width)).astype(int)
    high = np.floor((far[row, cell] + angle + SLACK) / width).astype(int)
    mine = np.floor(far[row, cell] / width).astype(int)
    high[own] = mine[own]
    return row, cell, own, low, high, mine


def _place(sent, angle: float):
    """(id, fresh, v) -> the cell and band where each vector is at home, and those it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, JUDGED) for b in batches for k in range(0, b.num_rows, JUDGED)):
            ids, fresh = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            for at, v in _matrix(batch.column(2)):
                row, cell, own, low, high, mine = _visits(_unit(v), sent.value.get(v.shape[1]), angle)
                n = high - low + 1
                row, cell, own, mine = (np.repeat(x, n) for x in (row, cell, own, mine))
                band = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                raw = [x.tobytes() for x in v]
                for k in range(0, len(row), VISITS):
                    r, c, b, m = (x[k : k + VISITS] for x in (row, cell, band, own & (band == mine)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(m), pa.array(np.full(len(r), v.shape[1], np.int32)), pa.array(ids[at][r]), pa.array(fresh[at][r].astype(bool)), pa.array([raw[x] for x in r], pa.binary())],
                        [c.split()[0] for c in PLACED.split(", ")],
                    )

    return run


def _deal(groups: dict[int, int]):
    """(id, fresh, v) -> each vector at home in one of its length's groups, by a hash of its id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, fresh = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            for at, v in _matrix(batch.column(2)):
                group = (ids[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(groups[v.shape[1]])
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group.astype(np.int32)), pa.array(np.zeros(n, np.int32)), pa.array(np.ones(n, bool)), pa.array(np.full(n, v.shape[1], np.int32)), pa.array(ids[at]), pa.array(fresh[at].astype(bool)), pa.array([x.tobytes() for x in v], pa.binary())],
                    [c.split()[0] for c in PLACED.split(", ")],
                )

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (dim, cell, band, home) -> tiles of up to TILE_ROWS of one place."""
    part, made, here, held = TaskContext.get().partitionId(), 0, None, []

    def flush() -> pa.RecordBatch:
        nonlocal made
        ids, fresh = np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], bool)
        row = [(part << 32) + made], [here[1]], [here[2]], [here[3]], [here[0]], [bool(fresh.any())], [ids.tobytes()], [fresh.tobytes()], [b"".join(h[2] for h in held)]
        made += 1
        held.clear()
        types = pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, types)], [c.split()[0] for c in TILE.split(", ")])

    for batch in batches:
        place = zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("dim", "cell", "band", "home")))
        for p, *row in zip(place, *(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("id", "fresh", "v"))):
            if held and (p != here or len(held) >= TILE_ROWS):
                yield flush()
            here = p
            held.append(row)
    if held:
        yield flush()


def _compare(least: float, gone: bool):
    """Pairs of tiles of one place -> pairs of vectors with a cosine of `least` or more; or, with `gone`, of each such pair the fresh one (the larger, where both are)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, x = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k].as_py() for c in batch.schema.names if not c.startswith("h_")}
                mine = batch.column("h_tile")[k].as_py()
                if mine != last:
                    raw = {c: batch.column(f"h_{c}")[k].as_py() for c in ("ids", "fresh", "v")}
                    last, x = mine, (np.frombuffer(raw["ids"], np.int64), np.frombuffer(raw["fresh"], bool), _unit(np.frombuffer(raw["v"], np.float32).reshape(-1, r["dim"])))
                ids, fresh, v = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["fresh"], bool), _unit(np.frombuffer(r["v"], np.float32).reshape(-1, r["dim"]))
                s = x[2] @ v.T
                ok = s >= least - 10**-DIGITS  # and rounded below
                if not (x[1].all() and fresh.all()):
                    ok &= x[1][:, None] | fresh[None, :]
                a, b = np.nonzero(np.triu(ok, 1) if r["tile"] == mine else ok)
                s = np.round(s[a, b], DIGITS)
                a, b, s = a[s >= least], b[s >= least], s[s >= least]
                if len(a) and gone:
                    both = x[1][a] & fresh[b]
                    out = np.where(both, np.maximum(x[0][a], ids[b]), np.where(fresh[b], ids[b], x[0][a]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.unique(out))], ["id"])
                elif len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x[0][a], ids[b])), pa.array(np.maximum(x[0][a], ids[b])), pa.array(s)], ["a", "b", "score"])

    return run


def _met(homes: DataFrame, others: DataFrame) -> DataFrame:
    """Home tiles beside all tiles of their place."""
    homes = homes.select("dim", "cell", "band", *(F.col(c).alias(f"h_{c}") for c in ("tile", "any_fresh", "ids", "fresh", "v")))
    # in a merge join a home tile meets all tiles of its place in turn
    met = homes.hint("merge").join(others, ["dim", "cell", "band"]).where((~F.col("home") | (F.col("tile") >= F.col("h_tile"))) & (F.col("any_fresh") | F.col("h_any_fresh")))
    return met.select("h_tile", "h_ids", "h_fresh", "h_v", "dim", "tile", "ids", "fresh", "v")


def groups_of(n: int) -> int:
    """Groups that n vectors are dealt to where all pairs of groups are compared."""
    return max(1, -(-n // min(GROUP_ROWS[1], max(GROUP_ROWS[0], n // GROUPS))))


def near_pairs(reps: DataFrame, least: float, pivots: int | None = None, gone: bool = False) -> DataFrame:
    """(a, b, score), a < b, of all pairs of `reps` (id, fresh, v; see classes) with a cosine of `least` or more of which one is fresh. Vectors of unlike length never pair.

    With `gone`, (id) of what such pairs take out: of two fresh vectors the larger, else the fresh one. `pivots` asks for so many, whatever they spare.
    """
    spark = reps.sparkSession
    ship(spark)
    angle = math.acos(max(-1.0, min(1.0, least - 10**-DIGITS)))
    dims = [(r[0], r[1]) for r in reps.groupBy(F.size("v")).count().orderBy(F.desc("count")).limit(64).collect()]  # vectors of rarer lengths share a cell
    sent, groups = {}, {}
    for dim, n in dims:
        most = max(1, min(pivots or PIVOTS, n // CELL_ROWS if pivots is None else n, NUMBERS // (dim * len(dims)) or 1))
        some = reps.where(F.size("v") == dim).orderBy(F.xxhash64(F.lit(3), "id"), "id").limit(most + JUDGED).select("v").toArrow()["v"].to_pylist()
        unit = _unit(np.array(some, np.float32))
        sent[dim] = unit[:most]
        if pivots is None and len(unit) > most:
            _, _, _, low, high, _ = _visits(unit[most:], sent[dim], angle)
            if (high - low + 1).sum() > groups_of(n) * (len(unit) - most):
                groups[dim] = groups_of(n)
    square = F.size("v").isin(list(groups))
    placed = reps.where(~square).select("id", "fresh", "v").mapInArrow(_place(spark.sparkContext.broadcast(sent), angle), PLACED)
    dealt = placed.repartition("dim", "cell", "band", F.pmod(F.xxhash64("id"), F.lit(SALT))).sortWithinPartitions("dim", "cell", "band", "home")
    tiles = settle(dealt.mapInArrow(_pack, TILE), "tiles")
    met = _met(tiles.where("home"), tiles)
    if groups:
        dealt = reps.where(square).select("id", "fresh", "v").mapInArrow(_deal(groups), PLACED).repartition("dim", "cell").sortWithinPartitions("dim", "cell")
        tiles = settle(dealt.mapInArrow(_pack, TILE), "tiles")
        last = F.element_at(F.create_map(*(F.lit(x) for kv in groups.items() for x in kv)), F.col("dim")) - 1
        others = tiles.select("dim", F.explode(F.sequence(F.lit(0), "cell")).alias("to"), *(c for c in tiles.columns if c not in ("dim", "band", "home"))).withColumnRenamed("cell", "band").withColumnRenamed("to", "cell")
        met = met.unionByName(_met(tiles.withColumn("band", F.explode(F.sequence("cell", last))), others.withColumn("home", F.col("cell") == F.col("band"))))
    found = met.mapInArrow(_compare(least, gone), "id long" if gone else "a long, b long, score double")
    return found.distinct() if gone else found


def near_duplicates(vectors: DataFrame, least: float, key: str = "vec_id", vec: str = "embedding", pivots: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Members (id, rep) of the classes of equal vectors, and near pairs (a, b, score) between the classes' names: no pair of unlike vectors is lost, and copies are not expanded."""
    members, reps = classes(vectors, key, vec)
    return members, near_pairs(reps, least, pivots)


def ingest(new: DataFrame, held: DataFrame, least: float, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """The new rows to take in: those whose vector is not equal or near to one that is held or to a new one of smaller key. New rows whose vector takes no part (null, empty, zero, not finite) are taken in as they are."""
    both = held.select(key, vec).withColumn("__new", F.lit(False)).unionByName(new.select(key, vec).withColumn("__new", F.lit(True)))
    members, reps = classes(both, key, vec, "__new")
    new_reps = reps.where("fresh").select("id")
    # of a pair the larger new key goes; beside a held one, the new one
    out = near_pairs(reps, least, gone=True)
    stay = new_reps.join(out, "id", "left_anti")
    dropped = members.join(stay, "id", "left_anti").select(F.col("id").alias(key))
    return new.join(dropped, key, "left_anti")
