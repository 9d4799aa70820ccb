"""Centroid clustering (Lloyd's rounds in integers) behind a PCA-rotated filter.

Vectors become integer vectors once.  They are stored with their leading
coordinates after a rotation to the principal axes of all vectors and with
the norm of the rest.  A rotation keeps distances, and the rest of two
vectors differs by at least the difference of its norms, so

    |projected difference|^2 + (difference of residual norms)^2

is a lower bound of the squared distance to a centroid.  Centroids whose
bound exceeds the exact distance to the most promising one are filtered out;
the survivors are verified in integers, so rounding in the rotation (less
than the slack) never changes a result.

Every round is one pass over the stored vectors; a task sends at most one
sum per centroid.  The driver holds the centroids and a second-moment
matrix, whose sizes depend on ``k`` and ``dim`` alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from lakebars.llm.common import materialize, prepare
from lakebars.session import discard

CENTROIDS = 40
ROUNDS = 5
DIMENSION = 64
SCALE = 256
PREFIX = "2:"             # salt of the order in which first centroids are taken
VARIANCE = 0.8            # share of the variance that the leading coordinates hold
LEADING = 32              # leading coordinates at most
LARGEST = 1 << 27         # integer components beyond this could overflow a long squared distance
SLACK = 1e-9              # relative, far above the rounding of double precision
PAIRS = 1 << 15           # survivors verified at a time


def usable(vector: Column, dim: int) -> Column:
    """Whether a vector has ``dim`` components, none NULL, NaN or infinite."""
    return (F.size(vector) == dim) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def integers(column: pa.Array, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, as rows of longs."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    whole = np.floor(scale * x)
    if len(whole) and np.abs(whole).max() >= LARGEST:
        raise ValueError(f"a component of {np.abs(x).max():g} is too large: its squared distance would not fit a long")
    return whole.astype(np.int64)


class Rotation:
    """Turns integer vectors to principal axes: the leading coordinates and the norm of the rest."""

    def __init__(self, mean: np.ndarray, moments: np.ndarray, variance: float = VARIANCE, leading: int = LEADING):
        spread, axes = np.linalg.eigh(moments)
        spread, self.axes, self.mean = np.maximum(spread[::-1], 0), axes[:, ::-1], mean
        share = np.cumsum(spread) / max(spread.sum(), 1e-300)
        self.lead = int(min(len(mean), leading, 1 + np.searchsorted(share, variance)))

    def __call__(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        turned = (vectors - self.mean) @ self.axes
        return turned[:, :self.lead], np.linalg.norm(turned[:, self.lead:], axis=1)


def lower_bounds(lead, rest, to_lead, to_rest) -> np.ndarray:
    """Lower bounds of all squared distances, less the slack that covers rounding."""
    own, far = (lead ** 2).sum(1)[:, None], (to_lead ** 2).sum(1)
    bound = own - 2 * (lead @ to_lead.T) + far + (rest[:, None] - to_rest) ** 2
    return bound - SLACK * (own + far + rest[:, None] ** 2 + to_rest ** 2 + 1)


def nearest(vectors, lead, rest, centroids, to_lead, to_rest) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each row (ties: the smaller number), its squared distance, and how many were verified."""
    if not len(vectors):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    bound = lower_bounds(lead, rest, to_lead, to_rest)
    best = bound.argmin(1)
    least = ((vectors - centroids[best]) ** 2).sum(1)
    open_ = bound <= least[:, None]
    open_[np.arange(len(vectors)), best] = False
    row, other = np.nonzero(open_)
    for lo in range(0, len(row), PAIRS):
        i, j = row[lo:lo + PAIRS], other[lo:lo + PAIRS]
        d = ((vectors[i] - centroids[j]) ** 2).sum(1)
        order = np.lexsort((j, d, i))                       # a row's best of this slice comes first
        i, j, d = i[order], j[order], d[order]
        head = np.r_[True, i[1:] != i[:-1]] if len(i) else np.zeros(0, bool)
        i, j, d = i[head], j[head], d[head]
        better = (d < least[i]) | ((d == least[i]) & (j < best[i]))
        best[i[better]], least[i[better]] = j[better], d[better]
    return best, least, len(row) + len(vectors)


def _sums(frame: DataFrame, group: str, values: str) -> DataFrame:
    """Componentwise sums of arrays by ``group``, added up in Spark as ``(group, at, total)``."""
    kind = "decimal(38,0)" if dict(frame.dtypes)[values] == "array<bigint>" else "double"
    return (frame.select(group, F.posexplode(values).alias("at", "x"))
            .groupBy(group, "at").agg(F.sum(F.col("x").cast(kind)).alias("total")))


def principal_axes(rows: DataFrame, dim: int, scale: int) -> Rotation:
    """The rotation of all rows: one pass, every task sends its second moments."""
    def run(batches):
        total = np.zeros((dim + 1, dim + 1))
        for batch in batches:
            v = integers(batch.column(0), dim, scale).astype(np.float64)
            one = np.c_[v, np.ones(len(v))]
            total += one.T @ one
        yield pa.RecordBatch.from_arrays([pa.array(range(dim + 1), pa.int32()),
                                          pa.array(list(total), pa.list_(pa.float64()))], ["i", "x"])

    total = np.zeros((dim + 1, dim + 1))
    for r in _sums(rows.mapInArrow(run, "i int, x array<double>"), "i", "x").collect():   # (dim + 1)^2 numbers
        total[r["i"], r["at"]] = r["total"]
    n = max(total[dim, dim], 1.0)
    mean = total[dim, :dim] / n
    return Rotation(mean, total[:dim, :dim] / n - np.outer(mean, mean))


def first_centroids(rows: DataFrame, k: int, dim: int, scale: int, prefix: str) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest hashes; equal ids by their vectors, NULL ids last."""
    drawn = (rows.select(F.sha2(F.concat(F.lit(prefix), F.col("id").cast("string")).cast("binary"), 256).alias("h"), "v")
             .orderBy(F.asc_nulls_last("h"), "v").limit(k).collect())
    flat = pa.array([r["v"] for r in drawn], pa.list_(pa.float64()))
    return integers(flat, dim, scale)


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CENTROIDS,
                    rounds: int = ROUNDS, dim: int = DIMENSION, scale: int = SCALE, prefix: str = PREFIX) -> DataFrame:
    """One row per usable vector: ``id_col``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``,
    ``centroid`` (array of longs).

    Vectors of another length and those that hold NULL, NaN or infinite
    components are left out.  Each row is a vector of its own: repeated rows
    and ids count as often as they stand there, and a NULL id is kept (as a
    first centroid it comes after all others).  Fewer than ``k`` vectors make
    as many centroids; no vector, no row.  Equal distances go to the smaller
    centroid, a centroid that loses all its vectors stays where it is.
    Other columns are ignored.  Components of ``LARGEST / scale`` and beyond
    raise, since their squared distance would not fit a long.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(usable(F.col("v"), dim))
    centroids = first_centroids(rows, k, dim, scale, prefix)
    id_type = vectors.schema[id_col].dataType
    if not len(centroids):
        longs = [StructField(c, LongType()) for c in ("distance", "cluster_inertia", "inertia")]
        return spark.createDataFrame([], StructType([StructField(id_col, id_type), StructField("cluster", IntegerType()),
                                                     *longs, StructField("centroid", ArrayType(LongType()))]))
    turn = principal_axes(rows.select("v"), dim, scale)

    def stored(batches):
        for batch in batches:
            v = integers(batch.column(1), dim, scale)
            lead, rest = turn(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(v.astype(np.int32)), pa.list_(pa.int32())),
                 pa.array(list(lead), pa.list_(pa.float64())), pa.array(rest)], ["id", "v", "lead", "rest"])

    id_kind = id_type.simpleString()
    store = materialize(rows.mapInArrow(stored, f"id {id_kind}, v array<int>, lead array<double>, rest double"), "vectors")

    def assigned(batches, at):
        to_lead, to_rest = turn(at)
        for batch in batches:
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.int64)
            lead = batch.column("lead").flatten().to_numpy(zero_copy_only=False).reshape(-1, turn.lead)
            rest = batch.column("rest").to_numpy(zero_copy_only=False)
            yield batch, v, *nearest(v, lead, rest, at, to_lead, to_rest)[:2]

    for _ in range(rounds):
        def partial(batches, at=centroids):
            total = np.zeros((len(at), dim + 1), np.int64)    # a task's vectors: far from overflowing a long
            for _, v, best, _ in assigned(batches, at):
                np.add.at(total, best, np.c_[v, np.ones(len(v), np.int64)])
            held = np.nonzero(total[:, dim])[0]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()),
                                              pa.array(list(total[held]), pa.list_(pa.int64()))], ["cluster", "x"])

        sums: dict = {}
        for r in _sums(store.mapInArrow(partial, "cluster int, x array<long>"), "cluster", "x").collect():
            sums.setdefault(r["cluster"], {})[r["at"]] = int(r["total"])      # k * (dim + 1) numbers
        moved = centroids.copy()
        for cluster, total in sums.items():
            moved[cluster] = [total[j] // total[dim] for j in range(dim)]
        centroids = moved

    def last(batches, at=centroids):
        for batch, _, best, least in assigned(batches, at):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(best, pa.int32()), pa.array(least, pa.int64())],
                                             ["id", "cluster", "distance"])

    final = materialize(store.mapInArrow(last, f"id {id_kind}, cluster int, distance long"), "assigned")
    discard(store)
    inertia = {r["cluster"]: int(r["n"]) for r in final.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()}      # k rows
    whole = sum(inertia.values())
    about = spark.createDataFrame([(c, n, whole, centroids[c].tolist()) for c, n in inertia.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return (final.join(F.broadcast(about), "cluster")                             # k rows
            .select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid"))


def centroid_digest(centroid: Column) -> Column:
    """Lowercase hex SHA-256 of the components as decimal integers joined by commas."""
    return F.sha2(F.array_join(centroid.cast("array<string>"), ",").cast("binary"), 256)

