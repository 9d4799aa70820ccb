"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components.

A fingerprint of ``width`` bits is cut into ``max_distance + 2`` blocks.  Two
fingerprints that differ in at most ``max_distance`` bits agree on at least
two whole blocks, so joining on every pair of blocks finds all of them.
Equal fingerprints are one node; the pairs inside a block bucket are never
written out: a bucket is reduced in its task to one edge per node.  A bucket
with more than ``BUCKET_NODES`` nodes is split into chunks, and every pair of
chunks is its own group, so no group is unbounded and no pair is lost.
"""

from __future__ import annotations

from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lakebars.llm.common import LOWER_TABLE, fresh, materialize, prepare, shuffle_width, text_key
from lakebars.llm.graph import connected_components

BITS = 64
SEED = 42
SHINGLE = 3
MAX_DISTANCE = 3
BUCKET_NODES = 2048     # nodes of a bucket handled as one group; larger buckets are split in chunks
PIECE = 1 << 15         # shingles whose bits are counted at a time


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of a whole text as a signed 64-bit integer (no words, or NULL: 0).

    A bit is set if it is set in over half of the shingles' XXH64 values.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_TABLE).split()
    if not words:
        return 0
    if len(words) < shingle:
        grams, total = iter([b" ".join(words)]), 1
    else:
        grams = map(b" ".join, zip(*(islice(words, i, None) for i in range(shingle))))
        total = len(words) - shingle + 1
    hashes = map(xxhash.xxh64_intdigest, grams, repeat(seed))
    ones = np.zeros(BITS, np.int64)
    for lo in range(0, total, PIECE):
        part = np.fromiter(islice(hashes, PIECE), np.dtype("<u8"), min(PIECE, total - lo))
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, seed: int = SEED, keep_text_key: bool = False) -> DataFrame:
    """``(id, fp)`` for every row, repeats included; with ``keep_text_key`` also the text's identity."""
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"),
                         *([text_key(text).alias("text_key")] if keep_text_key else []))
    names = ["id", "fp", *source.columns[2:]]

    def run(batches):
        for batch in batches:
            fps = [fingerprint(t, shingle, seed) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps, pa.int64()), *batch.columns[2:]], names)

    return source.mapInArrow(run, "id long, fp long" + ", text_key struct<a:long,b:long>" * keep_text_key)


def _block_masks(max_distance: int) -> list[int]:
    """Signed masks, one for each pair of the ``max_distance + 2`` blocks."""
    n = max_distance + 2
    cuts = [round(i * BITS / n) for i in range(n + 1)]
    blocks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(cuts, cuts[1:])]
    masks = [a | b for a, b in combinations(blocks, 2)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def bucket_edges(fps: np.ndarray, nodes: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """Edges that connect the nodes of one bucket as their close pairs do, at most one per node.

    Breadth first: each node is compared with the nodes not reached yet.
    """
    order = np.argsort(nodes, kind="stable")
    fps, nodes, edges = fps[order], nodes[order], []
    while nodes.size > 1:
        root, front = nodes[0], [fps[0]]
        fps, nodes = fps[1:], nodes[1:]
        while front and nodes.size:
            near = np.bitwise_count(fps ^ front.pop()) <= max_distance
            if near.any():
                edges.extend((root, x) for x in nodes[near])
                front.extend(fps[near])
                fps, nodes = fps[~near], nodes[~near]
    return edges


def _edges_of_runs(max_distance: int, keys: int):
    """Task function over rows sorted by ``keys`` leading columns, then fp and node."""
    def run(batches):
        held = None
        for batch in batches:
            rows = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys + 2)])
            if held is not None:
                rows = np.concatenate([held, rows])
            starts = np.flatnonzero(np.r_[True, (rows[1:, :keys] != rows[:-1, :keys]).any(axis=1)])
            held = rows[starts[-1]:]
            yield from emit(rows, starts)
        if held is not None and len(held):
            yield from emit(held, np.array([0, len(held)]))

    def emit(rows, starts):
        edges = []
        for lo, hi in zip(starts[:-1], starts[1:]):
            if hi - lo > 1:
                edges += bucket_edges(rows[lo:hi, keys].view(np.uint64), rows[lo:hi, keys + 1], max_distance)
        if edges:
            a, b = np.array(edges, np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def close_edges(nodes: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Edges ``(a, b)`` between the nodes of ``nodes(fp, node)`` (one row per fingerprint).

    They connect exactly the nodes that chains of fingerprints at most
    ``max_distance`` bits apart connect.
    """
    spark = nodes.sparkSession
    masks = _block_masks(max_distance)
    keyed = nodes.select("fp", "node", F.explode(F.array(*[
        F.struct(F.lit(i).cast("long").alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for i, m in enumerate(masks)])).alias("k")).select("k.t", "k.key", "fp", "node")
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    shared = keyed.join(sizes, ["t", "key"])
    # a bucket of n nodes has c = ceil(n / BUCKET_NODES) chunks; group (i, j) holds chunks i and j
    shared = shared.withColumn("c", F.ceil(F.col("n") / BUCKET_NODES).cast("long"))
    shared = shared.withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("c")))
    groups = shared.select("t", "key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("c") - 1)).alias("other"),
                           "mine", "fp", "node")
    groups = groups.select("t", "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                           "fp", "node")
    keys = ["t", "key", "i", "j"]
    dealt = groups.repartition(shuffle_width(spark), *keys).sortWithinPartitions(*keys, "node")
    return dealt.mapInArrow(_edges_of_runs(max_distance, len(keys)), "a long, b long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   max_distance: int = MAX_DISTANCE, seed: int = SEED, keep_text_key: bool = False) -> DataFrame:
    """One row per input row: ``id_col``, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest id that chains of links reach, the row's
    own included.  Rows with a NULL id get the component of their
    fingerprint's other rows, or NULL when there are none; they never carry a
    link themselves.  Repeated rows are returned as often as they come.  NULL
    and empty texts have fingerprint zero.  No rows give no rows.
    ``keep_text_key`` adds the text's identity, ``text_key``.
    """
    prepare(docs.sparkSession)
    rows = materialize(fingerprints(docs, id_col, text_col, shingle, seed, keep_text_key), "simhash")
    nodes = rows.where(F.col("id").isNotNull()).groupBy("fp").agg(F.min("id").alias("node"))
    nodes = materialize(nodes, "simhash-nodes")
    roots = connected_components(close_edges(nodes, max_distance))
    known = nodes.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    out = rows.join(known, "fp", "left")
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      "component_id", *(["text_key"] if keep_text_key else []))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The documents of ``docs`` (all columns) that come first in their component.

    A row is judged by its own fingerprint.  One row stays for each kept id:
    of several that come first, the one with the smallest hash of its text
    (then of its columns).  Documents without an id cannot be told apart and
    stay.
    """
    key_id, a, b, rank = (fresh(c, docs.columns) for c in ("keep_id", "keep_a", "keep_b", "keep_rank"))
    key = text_key(F.col(text_col).cast("string"))
    groups = simhash_groups(docs, id_col, text_col, keep_text_key=True, **params)
    kept = groups.where(F.col(id_col) == F.col("component_id")).groupBy(F.col(id_col).alias(key_id)).agg(
        F.min("text_key").alias("k")).select(key_id, F.col("k.a").alias(a), F.col("k.b").alias(b))
    rows = docs.join(kept, (docs[id_col] == kept[key_id]) & (key["a"] == kept[a]) & (key["b"] == kept[b]), "left_semi")
    plain = [c for c in docs.columns if "map<" not in docs.schema[c].dataType.simpleString()]
    alone = rows.groupBy(F.col(id_col).alias(key_id)).agg(
        F.min_by(F.struct(*docs.columns), F.xxhash64(*plain)).alias(rank)).select(f"{rank}.*")
    return alone.unionByName(docs.where(F.col(id_col).isNull()))
