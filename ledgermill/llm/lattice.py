"""Near-duplicate vectors by hashing to E8 lattice points.

Each table projects the unit vectors to 8 dimensions and decodes them to the
nearest point of the E8 lattice. A vector is stored under its own point and
looks into its own and the nearest neighbouring points. Pairs that meet are
screened by a 64-bit sign sketch, made distinct, and verified by their cosine.
Equal vectors are one class and are never paired with each other.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import ship
from ledgermill.llm.graph import components
from ledgermill.session import stage

# With these, 2 vectors at a cosine of 0.95 meet with a probability over 0.99
# (64 dimensions, measured); closer ones more often.
TABLES, PROBES, SCALE = 12, 8, 3.5
# Signs of 64 projections: at a cosine of 0.95 about 7 differ, of unrelated vectors 32.
SIGNS = 22
SEED = 20_240_917


def _d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of even sum."""
    r = np.rint(x)
    odd = np.flatnonzero(r.sum(1) % 2)
    worst = np.abs(x - r)[odd].argmax(1)
    r[odd, worst] += np.where(x[odd, worst] >= r[odd, worst], 1, -1)
    return r


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8: D8 and D8 shifted by a half in every coordinate."""
    a, b = _d8(x), _d8(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1)
    return np.where(closer[:, None], a, b)


@lru_cache(maxsize=1)
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    eye = np.eye(8)
    whole = [s * eye[i] + t * eye[j] for i, j in combinations(range(8), 2) for s, t in product((1, -1), repeat=2)]
    half = [np.array(s) / 2 for s in product((1, -1), repeat=8) if s.count(-1) % 2 == 0]
    return np.array(whole + half)


@lru_cache(maxsize=8)
def _projections(dim: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng((SEED, dim))
    each = [np.linalg.qr(rng.standard_normal((max(dim, 8), 8)))[0][:dim] for _ in range(tables)]
    return np.stack(each), rng.standard_normal((dim, 64))


def _keys(points: np.ndarray, table: int, dim: int) -> np.ndarray:
    """64-bit keys of lattice points."""
    out = np.full(points.shape[:-1], table * 1_000_003 + dim, np.uint64)
    twice = (points * 2).astype(np.int64).astype(np.uint64)
    for k in range(8):
        out = (out ^ twice[..., k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def _vectors(column: pa.Array):
    """(rows, matrix) for each dimension that occurs."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        yield rows, flat[starts[rows][:, None] + np.arange(dim)]


def _cells(tables: int, probes: int, scale: float, looking: bool):
    """Arrow batches (cid, vec) to (cid, key, signs): own points, and neighbouring ones if ``looking``."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids = part.column("cid").to_numpy()
                for rows, m in _vectors(part.column("vec")):
                    unit = m / np.linalg.norm(m, axis=1)[:, None]
                    planes, sides = _projections(m.shape[1], tables)
                    signs = np.packbits(unit @ sides > 0, axis=1).view(np.int64)[:, 0]
                    for t in range(tables):
                        x = unit @ planes[t] * (scale * np.sqrt(m.shape[1] / 8))
                        points = nearest(x)[:, None, :]
                        if looking and probes:
                            near = np.argpartition(-(x - points[:, 0]) @ neighbours().T, probes - 1, 1)[:, :probes]
                            points = np.concatenate((points, points + neighbours()[near]), 1)
                        keys = _keys(points, t, m.shape[1])
                        n = keys.shape[1]
                        yield pa.RecordBatch.from_pydict({"cid": pa.array(np.repeat(ids[rows], n)), "key": pa.array(keys.ravel()),
                                                          "signs": pa.array(np.repeat(signs, n))})

    return run


def _cosines(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            cos = np.empty(part.num_rows)
            for (rows, x), (_, y) in zip(_vectors(part.column("x")), _vectors(part.column("y")), strict=True):
                cos[rows] = (x * y).sum(1) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
            yield pa.RecordBatch.from_pydict({"a": part.column("a"), "b": part.column("b"), "cosine": pa.array(cos)})


def near_duplicates(df: DataFrame, threshold: float = 0.95, key: str = "vec_id", vector: str = "embedding",
                    tables: int = TABLES, probes: int = PROBES, scale: float = SCALE) -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    n_links: other rows linked directly, equal vectors among them; component_id:
    the smallest id reachable; kept: whether that is its own. Vectors of different
    lengths do not link. A vector that is null, empty, zero, or holds null or
    non-finite components, or whose id is null, links with nothing. Repeated rows
    are vectors of their own; other columns are left aside; an empty table gives no rows.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    usable = ("coalesce(id IS NOT NULL AND NOT exists(vec, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity')) "
              "AND exists(vec, x -> x <> 0), false)")
    sound = rows.where(usable)
    # The number of a class is fixed once it is written.
    classes = stage(sound.groupBy("vec").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
                         .withColumn("cid", F.monotonically_increasing_id()), "lattice-classes")
    vectors = classes.select("cid", "vec")
    out = "cid bigint, key bigint, signs bigint"
    at, look = (vectors.mapInArrow(_cells(tables, probes, scale, looking), out).alias(name)
                for looking, name in ((False, "at"), (True, "look")))
    met = at.join(look, F.expr(f"at.key = look.key AND at.cid <> look.cid AND bit_count(at.signs ^ look.signs) <= {SIGNS}"))
    pairs = met.select(F.least("at.cid", "look.cid").alias("a"), F.greatest("at.cid", "look.cid").alias("b")).distinct()
    both = (pairs.join(vectors.select(F.col("cid").alias("a"), F.col("vec").alias("x")), "a")
                 .join(vectors.select(F.col("cid").alias("b"), F.col("vec").alias("y")), "b")
                 .where("size(x) = size(y)"))
    links = stage(both.select("a", "b", "x", "y").mapInArrow(_cosines, "a bigint, b bigint, cosine double")
                      .where(F.col("cosine") >= threshold).select("a", "b"), "lattice-links")
    size = classes.select(F.col("cid").alias("b"), "copies")
    count = (links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(size, "b")
                  .groupBy(F.col("a").alias("cid")).agg(F.sum("copies").alias("others")))
    part = components(links).withColumnsRenamed({"node": "cid", "component": "part"})
    joined = classes.join(count, "cid", "left").join(part, "cid", "left").withColumn("part", F.coalesce("part", "cid"))
    first = joined.groupBy("part").agg(F.min("first").alias("component_id"))
    of = joined.join(first, "part").select(
        "vec", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    linked = sound.join(of, "vec").select("id", "n_links", "component_id")
    alone = rows.where(f"NOT {usable}").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.expr("id <=> component_id"))
