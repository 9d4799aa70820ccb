"""Embedding near-duplicates by spherical-cap filters over structured random product codes.

Each rotation turns the vectors by a random orthogonal matrix and cuts them
in two halves; a filter direction is a pair of random codewords, one for
each half.  A vector is list-decoded to all directions whose inner product
with it exceeds the cap's threshold: codewords are scored half by half, and
only pairs that can reach the threshold are looked at.  Close vectors share
a filter with high probability; vectors are joined on filters and every pair
inside is verified by its exact cosine in double precision.

The more vectors there are, the smaller are the caps and the more filters
there are (:func:`scaled`), so that a filter holds as many unrelated vectors
at any size: the vectors compared with one of them stay about the same.

A pair is counted in the smallest filter that both vectors have, so counts
need no list of pairs; components need one edge per vector and filter.
Equal vectors are one node with a size.  A filter with more than
``BUCKET_NODES`` vectors is split in chunks, and each pair of chunks is a
group of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from lakebars.llm.common import materialize, prepare, shuffle_width
from lakebars.llm.graph import connected_components

COSINE = 0.9
ROTATIONS = 5
BASE_ROWS = 10_000       # vectors up to which the next two hold; see ``scaled``
CODEWORDS = 128          # of each half
CAP = 3.2                # threshold in standard deviations of a random inner product (1 / sqrt(dimension))
SHORT_NUMBERS = 10_000_000   # vectors whose filters can be numbered by 32 bits
DECODED = 1 << 21        # scores of codewords held at a time
BUCKET_NODES = 2048      # vectors of a filter in one group
FIRST_FILTERS = (4, 12)  # filters of a pair compared before all of them are
BLOCK = 512              # rows of a group compared at a time
SEED = 5


def product_code(dim: int, rotation: int, seed: int, codewords: int) -> tuple:
    """A rotation and the codewords of its halves, the same in every task."""
    rng = np.random.default_rng([seed, dim, rotation])
    turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    cut = dim // 2
    halves = []
    for width in (cut, dim - cut):
        words = rng.standard_normal((codewords, max(1, width)))
        halves.append(words / np.linalg.norm(words, axis=1, keepdims=True))
    return turn, cut, halves


def cap_share(dim: int, least: float) -> float:
    """Share of the unit sphere whose inner product with a given direction exceeds ``least``."""
    def below(angle):
        at = np.linspace(0, angle, 4001)
        return np.trapezoid(np.sin(at) ** (dim - 2), at)

    return float(below(np.arccos(min(1.0, max(-1.0, least)))) / below(np.pi))


def scaled(rows: int, dim: int, codewords: int = CODEWORDS, cap: float = CAP, cosine: float = COSINE) -> tuple[int, float]:
    """Codewords of a half and threshold for so many vectors.

    Up to ``BASE_ROWS`` they are the given ones.  Beyond, with ``both`` the
    share of a cap's vectors whose close partner is in the cap too, the cap's
    share of the sphere is made proportional to ``both / rows`` and the
    number of filters to ``rows / both^2``.  So a close pair shares as many
    filters as before, and a vector meets as many unrelated ones as before.
    """
    least = min(cap / np.sqrt(dim), 0.6)
    if rows <= BASE_ROWS or dim < 3:
        return codewords, least
    apart = np.sqrt((1 - cosine) / (1 + cosine))

    def both(s: float) -> float:
        return max(1e-3, cap_share(dim - 1, apart * s / np.sqrt(1 - s * s))) if dim > 3 else 1.0

    share, low, high = cap_share(dim, least) * BASE_ROWS / rows / both(least), least, 1.0
    for _ in range(50):
        middle = (low + high) / 2
        low, high = (middle, high) if cap_share(dim, middle) > share * both(middle) else (low, middle)
    return int(np.ceil(codewords * np.sqrt(rows / BASE_ROWS) * both(least) / both(low))), low


def decode(unit: np.ndarray, rotations: int = ROTATIONS, codewords: int = CODEWORDS, cap: float = CAP,
           seed: int = SEED, codes: dict | None = None, rows: int = 0, cosine: float = COSINE) -> tuple[np.ndarray, np.ndarray]:
    """Rows and filter numbers: all filters that each unit vector exceeds the threshold of.

    One-dimensional vectors have one filter for each sign.  ``codes`` keeps
    the product codes between calls; ``rows`` is the number of vectors in all.
    """
    dim = unit.shape[1]
    if dim < 2:
        return np.arange(len(unit)), (unit[:, 0] > 0).astype(np.int64)
    found_rows, filters, codes = [], [], {} if codes is None else codes
    if ("scaled", dim) not in codes:
        codes["scaled", dim] = scaled(rows, dim, codewords, cap, cosine)
    codewords, least = codes["scaled", dim]
    least = least * np.sqrt(2)
    for r in range(rotations):
        if (dim, r) not in codes:
            codes[dim, r] = product_code(dim, r, seed, codewords)
        turn, cut, (left, right) = codes[dim, r]
        step = max(1, DECODED // codewords)
        for at in range(0, len(unit), step):
            turned = unit[at:at + step] @ turn
            a, b = turned[:, :cut] @ left.T, turned[:, cut:] @ right.T
            row, i = np.nonzero(a + b.max(axis=1, keepdims=True) >= least)
            width = max(1, DECODED // codewords)
            for lo in range(0, len(row), width):
                part = slice(lo, lo + width)
                k, j = np.nonzero(a[row[part], i[part]][:, None] + b[row[part]] >= least)
                found_rows.append(row[part][k] + at)
                filters.append((r * codewords + i[part][k]) * codewords + j)
    row, number = np.concatenate([*found_rows, np.zeros(0, np.int64)]), np.concatenate([*filters, np.zeros(0, np.int64)])
    order = np.lexsort((number, row))
    return row[order], number[order]


def _vectors(column: pa.Array) -> list:
    return [np.asarray(v.values, np.float64) if v.is_valid else None for v in column]


def usable(vector) -> bool:
    """Whether a vector can link: not NULL, not empty, finite, not zero."""
    return vector is not None and len(vector) > 0 and bool(np.isfinite(vector).all()) and bool(vector.any())


def _filter_rows(nodes: DataFrame, params: dict) -> DataFrame:
    """One row per node: dimension and all its filters (no vector)."""
    def run(batches):
        codes: dict = {}
        for batch in batches:
            found = [(i, v) for i, v in enumerate(_vectors(batch.column(1))) if usable(v)]
            for dim in sorted({len(v) for _, v in found}):
                at = np.array([i for i, v in found if len(v) == dim])
                x = unit_rows(np.array([v for _, v in found if len(v) == dim]))
                row, number = decode(x, **params, codes=codes)
                ends = np.cumsum(np.bincount(row, minlength=len(x)))
                own = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(number, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), dim), pa.int32()), batch.column(0).take(pa.array(at)), own],
                    ["dim", "node", "filters"])

    return nodes.select("node", "embedding").mapInArrow(run, "dim int, node long, filters array<long>")


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def first_shared(own: list[np.ndarray], i: np.ndarray, j: np.ndarray, number: int) -> np.ndarray:
    """Whether ``number`` is the smallest filter that the vectors of each pair share.

    ``own`` are ascending lists.  Close vectors mostly share one of their
    first few filters, so these are looked at first and whole lists only
    where they settle nothing.
    """
    own = [x[x < number] for x in own]
    width = max(1, max(map(len, own)))
    lower = np.full((len(own), width), -1, np.int64)
    for k, x in enumerate(own):
        lower[k, :len(x)] = x
    out, left = np.ones(len(i), bool), np.arange(len(i))
    for part in sorted({min(w, width) for w in (*FIRST_FILTERS, width)}):
        step, still = max(1, 4_000_000 // (part * part)), []
        for lo in range(0, len(left), step):
            at = left[lo:lo + step]
            a, b = lower[i[at], :part], lower[j[at], :part]
            shared = ((a[:, :, None] == b[:, None, :]) & (a[:, :, None] >= 0)).any(axis=(1, 2))
            out[at[shared]] = False
            still.append(at[~shared])
        left = np.concatenate([*still, left[:0]])
    return out


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Component labels after the links (i, j): the smallest row number of each component."""
    while True:
        a, b = label[i], label[j]
        if (a == b).all():
            return label
        least = np.minimum(a, b)
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        while (label[label] != label).any():
            label = label[label]


def compare(nodes: np.ndarray, sizes: np.ndarray, units: np.ndarray, own: list[np.ndarray], side: np.ndarray,
            crossing: bool, number: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of one group, its rows by ascending node: for each row the copies it links to that are first found
    here, and the first row of its component.

    ``crossing``: only pairs of a row of side 0 and one of side 1 count.
    """
    counts, label = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
    for lo in range(0, len(nodes), BLOCK):
        i, j = np.nonzero(units[lo:lo + BLOCK] @ units[lo:].T >= cosine)
        i, j = i + lo, j + lo
        pick = i < j
        if crossing:
            pick &= side[i] != side[j]
        i, j = i[pick], j[pick]
        if len(i):
            label = _merge(label, i, j)
            new = first_shared(own, i, j, number)
            np.add.at(counts, i[new], sizes[j[new]])
            np.add.at(counts, j[new], sizes[i[new]])
    return counts, label


class _Rows:
    """Rows of a batch as arrays: group keys, side, node, size, and the flat vectors and filter lists with offsets."""

    def __init__(self, batch=None, parts: list["_Rows"] | None = None):
        if batch is not None:
            self.keys = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[:7]])
            (self.values, self.at), (self.own, self.own_at) = (self._lists(c) for c in batch.columns[7:9])
        else:
            self.keys = np.concatenate([p.keys for p in parts])
            self.values, self.at = self._joined([(p.values, p.at) for p in parts])
            self.own, self.own_at = self._joined([(p.own, p.own_at) for p in parts])

    @staticmethod
    def _lists(column) -> tuple[np.ndarray, np.ndarray]:
        offsets = column.offsets.to_numpy()
        return column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]], offsets - offsets[0]

    @staticmethod
    def _joined(parts) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum([0, *(len(v) for v, _ in parts)])
        return (np.concatenate([v for v, _ in parts]),
                np.concatenate([[0], *(at[1:] + end for (_, at), end in zip(parts, ends))]))

    def part(self, lo: int, hi: int) -> "_Rows":
        out = object.__new__(_Rows)
        out.keys = self.keys[lo:hi]
        out.values, out.at = self.values[self.at[lo]:self.at[hi]], self.at[lo:hi + 1] - self.at[lo]
        out.own, out.own_at = self.own[self.own_at[lo]:self.own_at[hi]], self.own_at[lo:hi + 1] - self.own_at[lo]
        return out


def _compare_groups(cosine: float):
    """Task function over rows sorted by group and node: emits (a, b, n): counts as (node, NULL, n), edges as (a, b, 0)."""
    def group(rows: _Rows):
        if len(rows.keys) < 2:
            return [], [], []
        _, number, i, j, _, _, _ = rows.keys[0].tolist()
        nodes = rows.keys[:, 5]
        units = unit_rows(rows.values.astype(np.float64).reshape(len(nodes), -1))
        own = np.split(rows.own, rows.own_at[1:-1])
        counts, label = compare(nodes, rows.keys[:, 6], units, own, rows.keys[:, 4], i != j, number, cosine)
        linked = np.flatnonzero(counts)
        moved = np.flatnonzero(label != np.arange(len(nodes)))
        return (np.r_[nodes[linked], nodes[moved]].tolist(),
                [None] * len(linked) + nodes[label[moved]].tolist(), counts[linked].tolist() + [0] * len(moved))

    def run(batches):
        held, a, b, n = [], [], [], []   # held: the parts of the group that the last batch ended in

        def close():
            if held:
                for out, more in zip((a, b, n), group(_Rows(parts=held) if len(held) > 1 else held[0])):
                    out.extend(more)
                held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _Rows(batch)
            keys = rows.keys[:, :4]
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]).tolist()
            for lo, hi in zip(starts, [*starts[1:], len(keys)]):
                if held and (held[0].keys[0, :4] != keys[lo]).any():
                    close()
                held.append(rows.part(lo, hi))
            if len(a) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, n)], ["a", "b", "n"])
                a, b, n = [], [], []
        close()
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, n)], ["a", "b", "n"])

    return run


def embedding_groups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                     cosine: float = COSINE, **params) -> DataFrame:
    """One row per input row: ``id_col``, ``n_links``, ``component_id``, ``kept``.

    Vectors link when their cosine in double precision is at least
    ``cosine``; ``n_links`` counts the other rows linked directly, copies
    included, and ``component_id`` is the smallest id reachable.  Vectors
    that are NULL, empty, zero or hold NULLs or non-finite components link
    with nothing, nor do vectors of different lengths.  Rows with a NULL id
    have no links and a NULL component, and are kept.  Rows that repeat an
    id and a vector count as rows of their own.  No rows give no rows.
    """
    spark = vectors.sparkSession
    prepare(spark)
    kind = vectors.schema[vector_col].dataType
    kept = kind if kind == ArrayType(FloatType()) else ArrayType(DoubleType())   # single precision travels as it is
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kept).alias("embedding"))
    whole = (F.col("id").isNotNull() & F.col("embedding").isNotNull()
             & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
             & F.exists("embedding", lambda x: x != 0))
    # -0.0 and 0.0 are one value, as in a comparison
    zero = F.lit(0.0).cast(kept.elementType)
    rows = rows.withColumn("embedding", F.when(whole, F.transform("embedding", lambda x: F.when(x == 0, zero).otherwise(x))))
    nodes, seen = materialize(rows.where(F.col("embedding").isNotNull()).groupBy("embedding").agg(
        F.min("id").alias("node"), F.count(F.lit(1)).alias("size")), "vectors", [F.count(F.lit(1)).alias("n")])
    params = {"rows": seen["n"], "cosine": cosine, **params}
    number = "int" if seen["n"] <= SHORT_NUMBERS else "long"
    members = materialize(
        rows.where(F.col("embedding").isNotNull()).join(nodes, "embedding").select("id", "node", "size"), "members")

    # which filters are shared is settled without vectors; these are added in one shuffle to the groups
    decoded = materialize(_filter_rows(nodes, params), "filters")
    each = decoded.select("dim", "node", F.explode("filters").alias("filter"))
    sizes = each.groupBy("dim", "filter").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    shared = each.join(sizes, ["dim", "filter"])
    shared = shared.withColumn("c", F.ceil(F.col("n") / BUCKET_NODES).cast("long"))
    shared = shared.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("c")))
    shared = shared.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1)).alias("other"))
    places = shared.groupBy("dim", "node").agg(
        F.collect_list(F.struct("filter", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                                (F.col("mine") > F.col("other")).cast("int").alias("side"))).alias("places"),
        F.array_sort(F.collect_set("filter")).alias("own"))
    keys = ["dim", "filter", "i", "j"]
    groups = places.join(nodes, "node").select("dim", "node", "size", "embedding", "own", F.explode("places").alias("p"))
    groups = groups.select("dim", "p.filter", "p.i", "p.j", "p.side", "node", "size", "embedding",
                           F.transform("own", lambda x: x.cast(number)).alias("own"))
    dealt = groups.repartition(shuffle_width(spark), *keys).sortWithinPartitions(*keys, "node")
    found = materialize(dealt.mapInArrow(_compare_groups(cosine), "a long, b long, n long"), "links")

    counts = found.where(F.col("b").isNull()).groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    roots = connected_components(found.where(F.col("b").isNotNull()))
    known = (nodes.select("node").join(counts, "node", "left").join(roots, "node", "left")
             .select("node", F.coalesce("others", F.lit(0)).alias("others"),
                     F.coalesce("root", "node").alias("component_id")))
    linked = members.join(known, "node").select(
        "id", (F.col("others") + F.col("size") - 1).cast("long").alias("n_links"), "component_id")
    alone = rows.where(F.col("embedding").isNull()).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
