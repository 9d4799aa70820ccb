"""Benchmark decontamination with suffix arrays over the training documents.

A task gathers documents to a shard of bounded size, numbers their words by
the test vocabulary, and sorts the suffixes of every stretch that could hold
a whole test window (a word that no test item has ends a stretch, as no
verbatim match can cross it).  Each test suffix is then binary-searched in
the shard's suffix array; its range gives all places where its window
occurs, and the matches are extended to their full length.

The test set is dealt to blocks of bounded size by a hash of its items.  Tasks
make the windows of a block and write them to the shared work folder, from
which each worker of a pass reads the one block that the pass is about; the
driver sees sizes only.  One block, the usual case, is one pass over the
documents, which are not shuffled.  With more, every block's pass writes what
it found (few, short rows) before the next one starts, and the documents meet
the sum in one join.
"""

from __future__ import annotations

import math
import os
import pickle
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakebars.llm.common import WORD_TABLE, fresh, materialize, new_run_dir, prepare, text_key, worker_state
from lakebars.sources.paged import uri

WINDOW = 13
SHARE = 20               # contaminated: SHARE * hit words >= words
BLOCK_BYTES = 16 << 20   # UTF-8 bytes of test items of a block, in expectation
PART_BYTES = 4 << 20     # bytes of a row of a written block
SHARD_WORDS = 1 << 20    # words of a shard; a longer document is a shard of its own
QUERIES = 1 << 15        # test suffixes searched at a time
PAIRS = 1 << 20          # pairs of a place in a document and one in an item extended at a time

FOUND = {"n_words": "long", "hits": "array<struct<start:long,end:long>>", "items": "array<string>",
         "matches": "array<struct<item_id:string,item_start:long,doc_start:long,n_words:long>>"}
HIT_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
MATCH_TYPE = pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int64()),
                                 ("doc_start", pa.int64()), ("n_words", pa.int64())]))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_TABLE).split()


def test_block(items: list[tuple[str | None, str]], window: int) -> dict:
    """Numbered words of some test items, their distinct windows, and where each window is.

    ``words`` holds all items, a zero after each; ``starts`` and ``widths``
    one suffix for each distinct window; ``place_*`` one row for each place of
    a window in an item, by window and the word before it (zero: none), which
    ``place_key`` holds as one number.
    """
    vocabulary, names, flat, seen = {}, [], [], {}
    for item_id, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text)]
        base, width = len(flat), min(window, len(ids))
        flat += ids + [0]
        names.append(item_id)
        for i in range(len(ids) - width + 1 if ids else 0):
            seen.setdefault(tuple(ids[i:i + width]), []).append((len(names) - 1, i, base + i))
    places = [(k, *p) for k, own in enumerate(seen.values()) for p in own]
    columns = np.array(places, np.int64).reshape(-1, 4).T
    words = np.array(flat + [0] * (window + 1), np.int32)
    key = columns[0] * (len(vocabulary) + 1) + np.where(columns[2] > 0, words[columns[3] - 1], 0)
    order = np.argsort(key, kind="stable")
    columns, key = columns[:, order], key[order]
    return {"vocabulary": vocabulary, "names": names, "words": words, "place_key": key,
            "starts": np.array([p[0][2] for p in seen.values()], np.int64),
            "widths": np.array([len(g) for g in seen], np.int64),
            "place_first": np.searchsorted(columns[0], np.arange(len(seen) + 1)),
            "place_item": columns[1], "place_offset": columns[2], "place_at": columns[3]}


def suffix_array(text: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` ordered by their suffixes of ``text`` (zeros end a suffix), by their first ``depth`` words at least.

    Prefix doubling: ranks by 2^k words give the ranks by 2^(k+1).
    """
    rank, step = text.astype(np.int64), 1
    while step < depth and len(text):
        after = np.zeros_like(rank)
        after[:-step] = rank[step:]
        after[rank == 0] = 0
        order, rank = np.unique(rank * (rank.max() + 1) + after, return_inverse=True)
        if order[0] != 0:  # zeros must keep rank zero
            rank = rank + 1
        rank[text == 0] = 0
        step *= 2
    return starts[np.argsort(rank[starts], kind="stable")]


def _range_of(text, suffixes, words, starts, widths, window) -> tuple[np.ndarray, np.ndarray]:
    """For each test suffix, the range of training suffixes that begin with its window."""
    reach = np.arange(window)
    used = reach < widths[:, None]
    wanted = np.where(used, words[starts[:, None] + reach], 0)

    def bound(upper: bool) -> np.ndarray:
        lo, hi = np.zeros(len(starts), np.int64), np.full(len(starts), len(suffixes), np.int64)
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            have = text[suffixes[np.minimum(mid, len(suffixes) - 1)][:, None] + reach]
            differ = (have != wanted) & used
            at = differ.argmax(axis=1)
            rows = np.arange(len(starts))
            less = np.where(differ[rows, at], have[rows, at] < wanted[rows, at], upper)
            lo = np.where(open_ & less, mid + 1, lo)
            hi = np.where(open_ & ~less, mid, hi)
        return lo

    return bound(False), bound(True)


def _spread(firsts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and members of the ranges [first, first + count)."""
    rows = np.repeat(np.arange(len(counts)), counts)
    return rows, np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts - firsts, counts)


def _long_stretches(text: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose stretch of non-zero words has ``shortest`` words left, and all places of these stretches."""
    ends, places = np.flatnonzero(text == 0), np.flatnonzero(text)
    starts = places[ends[np.searchsorted(ends, places)] - places >= shortest]
    inside = np.zeros(len(text) + 1, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, starts + shortest, -1)
    keep = np.cumsum(inside[:-1]) > 0
    keep[1:] |= keep[:-1]  # the zero that ends a stretch
    return starts, np.flatnonzero(keep)


def search_shard(docs: list[np.ndarray], block: dict, window: int) -> dict[int, tuple[list, list, list]]:
    """By number of document: hit stretches, item ids, longest match with each item."""
    if not len(block["starts"]):
        return {}
    sizes = np.array([len(d) for d in docs], np.int64)
    firsts = np.cumsum(sizes + 1) - (sizes + 1)
    text = np.zeros(int((sizes + 1).sum()) + window, np.int32)
    for at, ids in zip(firsts, docs):
        text[at:at + len(ids)] = ids
    starts, where = _long_stretches(text, int(block["widths"].min()))
    if not len(starts):
        return {}
    small = np.concatenate([text[where], np.zeros(window + 1, np.int32)])
    suffixes = suffix_array(small, np.searchsorted(where, starts), window)

    marks, best = np.zeros(len(text) + 1, np.int64), [np.zeros(0, np.int64)] * 5
    for lo in range(0, len(block["starts"]), QUERIES):
        q = slice(lo, lo + QUERIES)
        begin, end = _range_of(small, suffixes, block["words"], block["starts"][q], block["widths"][q], window)
        rows, member = _spread(begin, end - begin)
        at, rows = where[suffixes[member]], rows + lo
        np.add.at(marks, at, 1)
        np.add.at(marks, at + block["widths"][rows], -1)
        for pair, place in _new_pairs(text, at, rows, block):
            best = _best(best, _extended(text, at[pair], firsts, block, place))
    doc, item, n, offset, at = best
    covered, out = np.cumsum(marks[:-1]) > 0, {}
    for k in range(len(doc)):
        d = int(doc[k])
        if d not in out:
            own = covered[firsts[d]:firsts[d] + sizes[d]]
            edges = np.flatnonzero(np.diff(np.r_[False, own, False]))
            out[d] = (list(zip(edges[::2].tolist(), edges[1::2].tolist())), [], [])
        name = block["names"][item[k]]
        if name is not None:
            out[d][1].append(name)
        out[d][2].append({"item_id": name, "item_start": int(offset[k]), "doc_start": int(at[k] - firsts[d]),
                          "n_words": int(n[k])})
    return out


def _new_pairs(text, at, rows, block):
    """Pairs of an occurrence and a place of its window that cannot be extended to the left, in slices.

    These are all places but those with the same word before them.  Every
    longest match begins at such a pair.
    """
    size = len(block["vocabulary"]) + 1
    first, last = block["place_first"][rows], block["place_first"][rows + 1]
    key = rows * size + text[at - 1]  # the last word of text is a zero
    same, after = (np.searchsorted(block["place_key"], key, side=side) for side in ("left", "right"))
    none = text[at - 1] == 0
    same, after = np.where(none, last, same), np.where(none, last, after)
    ends = np.cumsum(same - first + last - after)
    lo = 0
    while lo < len(at):
        done = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + PAIRS, side="right")))
        q = slice(lo, hi)
        left, right = _spread(first[q], (same - first)[q]), _spread(after[q], (last - after)[q])
        yield (np.concatenate(x) + shift for x, shift in zip(zip(left, right), (lo, 0)))
        lo = hi


def _extended(text, at, firsts, block, place):
    """Document, item, length and places of the matches that begin at these pairs, at full length."""
    words, start = block["words"], block["place_at"][place]
    length, live = np.zeros(len(at), np.int64), np.arange(len(at))
    while len(live):
        have, want = text[at[live] + length[live]], words[start[live] + length[live]]
        live = live[(have == want) & (have != 0)]
        length[live] += 1
    return (np.searchsorted(firsts, at, side="right") - 1, block["place_item"][place], length,
            block["place_offset"][place], at)


def _best(*found):
    """By document and item the longest match, of equal ones the first in the document, then in the item."""
    doc, item, n, offset, at = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((offset, at, -n, item, doc))
    doc, item, n, offset, at = (x[order] for x in (doc, item, n, offset, at))
    best = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])][:len(doc)])
    return [x[best] for x in (doc, item, n, offset, at)]


def write_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int, window: int) -> tuple[str, int]:
    """Blocks of test items, made by tasks and written to the shared folder: ``(folder, number of blocks)``.

    Items with the same id and text are one.  An item larger than a block is
    not cut.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).where(
        "text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))

    def build(key, table):
        rows = sorted(zip(table.column("id").to_pylist(), table.column("text").to_pylist()), key=lambda r: (r[0] or "", r[1]))
        data = pickle.dumps(test_block(rows, window), protocol=5)
        parts = [data[lo:lo + PART_BYTES] for lo in range(0, len(data), PART_BYTES)]
        return pa.table({"part": pa.array(range(len(parts)), pa.int32()), "data": pa.array(parts, pa.binary()),
                         "block": pa.array([key[0].as_py()] * len(parts), pa.int32())})

    root = os.path.join(new_run_dir(spark, "test-items"), "blocks")
    (items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n)).cast("int")).groupBy("block")
     .applyInArrow(build, "part int, data binary, block int").write.mode("error").partitionBy("block").parquet(root))
    return uri(spark, root), n


def read_block(root: str, number: int, window: int) -> dict:
    """A written block; an empty one if no item was dealt to it."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, folder = fs.FileSystem.from_uri(f"{root}/block={number}")
    files = [f.path for f in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if f.path.endswith(".parquet")]
    rows = [r for f in files for r in pq.read_table(f, filesystem=store, partitioning=None).to_pylist()]
    data = b"".join(r["data"] for r in sorted(rows, key=lambda r: r["part"]))
    return pickle.loads(data) if data else test_block([], window)


def _pass(frame: DataFrame, text_col: str, block, window: int, found: dict[str, str], keep: list[str]) -> DataFrame:
    """One pass over the documents: adds the block's hits, items and matches to those carried along."""
    schema = StructType([frame.schema[c] for c in keep])
    names, text_at = frame.columns, frame.columns.index(text_col)
    out_at = [names.index(c) for c in keep]
    carried = {k: names.index(v) for k, v in found.items()}

    def run(batches):
        test = worker_state((block, "contamination-block"), lambda: read_block(*block, window))
        number = test["vocabulary"].get

        def flush(held):
            docs = [ids for _, ids in held]
            sizes = iter([len(ids) for ids in docs])
            hits = search_shard(docs, test, window)
            i = 0
            while i < len(held):
                batch = held[i][0]
                n = batch.num_rows
                yield batch, [next(sizes) for _ in range(n)], [hits.get(i + k) for k in range(n)]
                i += n

        def finish(held):
            for batch, n_words, hits in flush(held):
                old = {k: batch.column(carried[k]).to_pylist() for k in ("hits", "items", "matches")}
                spans, items, matches = [], [], []
                for k, hit in enumerate(hits):
                    a, b, c = hit or ([], [], [])
                    spans.append(merge_spans(old["hits"][k] or [], a))
                    items.append(sorted({*(old["items"][k] or []), *b}))
                    matches.append((old["matches"][k] or []) + c)
                new = {"n_words": pa.array(n_words, pa.int64()), "hits": pa.array(spans, HIT_TYPE),
                       "items": pa.array(items, pa.list_(pa.string())), "matches": pa.array(matches, MATCH_TYPE)}
                where = {carried[k]: k for k in carried}
                yield pa.RecordBatch.from_arrays(
                    [new[where[j]] if j in where else batch.column(j) for j in out_at], keep)

        held, size = [], 0
        for batch in batches:
            for text in batch.column(text_at).to_pylist():
                ids = np.fromiter(map(number, words_of(text), repeat(0)), np.int32)
                held.append((batch, ids))
                size += len(ids)
            if size >= SHARD_WORDS:
                yield from finish(held)
                held, size = [], 0
        if held:
            yield from finish(held)

    return frame.mapInArrow(run, schema)


def merge_spans(old: list[dict], new: list[tuple[int, int]]) -> list[dict]:
    """The union of two lists of stretches, ascending and apart."""
    out: list[dict] = []
    for lo, hi in sorted([(s["start"], s["end"]) for s in old] + list(new)):
        if out and lo <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], hi)
        else:
            out.append({"start": lo, "end": hi})
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                  keep: list[str] | None = None, names: dict[str, str] | None = None) -> DataFrame:
    """``docs`` (columns ``keep``, all rows) with what the test items share with them.

    Adds ``n_words``, ``hits`` (stretches of words inside occurrences of item
    windows), ``n_hit``, ``items`` (ids of items with occurring windows,
    sorted as strings), ``matches`` (the longest verbatim match with each
    item and its places) and ``contaminated``.  An item of fewer than
    ``window`` words is one window; items without words (NULL, empty) match
    nothing, NULL texts have no words; items with a NULL id count for the
    hits and matches, not for ``items``.  ``names`` renames added columns that
    would clash.
    """
    spark = docs.sparkSession
    prepare(spark)
    keep = docs.columns if keep is None else keep
    names = {k: (names or {}).get(k, k) for k in ("n_words", "hits", "items", "matches", "n_hit", "contaminated")}
    found = {k: fresh(f"found_{k}", docs.columns) for k in FOUND}
    needed = [c for c in docs.columns if c in keep or c == text_col]
    frame = docs.select(*needed, *[F.lit(None).cast(FOUND[k]).alias(found[k]) for k in found])
    root, blocks = write_blocks(benchmark, item_col, item_text_col, block_bytes, window)
    columns, number = [c for c in needed if c in keep], 0
    if blocks > 1:
        frame, number = _joined_passes(docs.select(*needed), text_col, root, blocks, window, found), blocks
    frame = _pass(frame, text_col, (root, number), window, found, [*columns, *found.values()])
    n_hit = F.aggregate(found["hits"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    out = frame.select(*keep, *[F.col(found[k]).alias(names[k]) for k in found], n_hit.alias(names["n_hit"]))
    rule = (F.col(names["n_hit"]) > 0) & (SHARE * F.col(names["n_hit"]) >= F.col(names["n_words"]))
    return out.withColumn(names["contaminated"], rule)


def _joined_passes(docs: DataFrame, text_col: str, root: str, blocks: int, window: int, found: dict[str, str]) -> DataFrame:
    """The documents with what all blocks found, to be finished by a pass over a block without items.

    A pass keeps the rows of texts with hits, by a 128-bit key of the text.
    """
    a, b = (fresh(n, [*docs.columns, *found.values()]) for n in ("key_a", "key_b"))
    key = text_key(F.col(text_col).cast("string"))
    keyed = docs.withColumns({a: key["a"], b: key["b"]})
    empty = {v: F.lit(None).cast(FOUND[k]) for k, v in found.items()}
    parts = []
    for number in range(blocks):
        own = _pass(keyed.select(a, b, text_col).withColumns(empty), text_col, (root, number), window, found,
                    [a, b, *found.values()])
        parts.append(materialize(own.where(F.size(found["hits"]) > 0).dropDuplicates([a, b]), "contamination"))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    sums = union.groupBy(a, b).agg(*[F.array_sort(F.flatten(F.collect_list(found[k]))).alias(found[k])
                                     for k in ("hits", "items", "matches")])
    joined = keyed.join(sums, [a, b], "left").withColumn(found["n_words"], empty[found["n_words"]])
    return joined.select(*docs.columns, *found.values())


def decontaminate(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """The documents (all columns) that are not contaminated."""
    names = {k: fresh(k, docs.columns) for k in ("n_words", "hits", "items", "matches", "n_hit", "contaminated")}
    found = contamination(docs, benchmark, names=names, **params)
    return found.where(~F.col(names["contaminated"])).select(*docs.columns)
