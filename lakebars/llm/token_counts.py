"""Token counts of a public tokenizer by two-tier lookup of pre-token lengths.

A text's pieces between ASCII white space are tokenized alike wherever they
stand, so a text's count is the sum over its pieces.  The first tier is a
broadcast table of the corpus's frequent pieces, bounded in rows and bytes;
the second is a bounded cache in each Python worker, filled by the
tokenizer library itself.  Pieces are never shuffled: a task reports only
those that are frequent in one of its batches, to build the first tier.
"""

from __future__ import annotations

import os
import re
import uuid
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakebars.llm.common import prepare, worker_state

LIMIT = 2048             # tokens beyond which a document is over the limit
FREQUENT = 1 << 15       # pieces of the broadcast table at most
PIECE_BYTES = 64         # longer pieces are left to the caches
SHARE = 20_000           # frequent in a batch: at least one in SHARE of its pieces
CACHE = 1 << 18          # pieces a worker remembers beside the table
SLICE = 1 << 20          # bytes of a text split at a time

_SPACE = re.compile(rb"[ \t-\r]")


def slices(data: bytes):
    """The pieces between ASCII white space, in lists of about ``SLICE`` bytes."""
    lo = 0
    while lo < len(data):
        cut = _SPACE.search(data, lo + SLICE)
        hi = cut.start() if cut else len(data)
        yield data[lo:hi].split()
        lo = hi


class Lengths(dict):
    """Tokens by piece: the frequent table, then what the library said before, then the library.

    Pieces over ``PIECE_BYTES`` are not remembered, so the bound on pieces is one on bytes too.
    """

    def __init__(self, frequent: dict, tokenizer, bound: int):
        super().__init__(frequent)
        self.frequent, self.tokenizer, self.bound = frequent, tokenizer, bound + len(frequent)

    def __missing__(self, piece: bytes) -> int:
        n = count(self.tokenizer, piece)
        if len(piece) <= PIECE_BYTES:
            if len(self) >= self.bound:
                self.clear()
                self.update(self.frequent)
            self[piece] = n
        return n


def count(tokenizer, data: bytes) -> int:
    return len(tokenizer.encode(data.decode("utf-8", "surrogatepass"), add_special_tokens=False).ids)


def refuse_unsuitable(tokenizer, table: dict) -> None:
    """Raises unless texts of the corpus's frequent pieces have the sum of their pieces' tokens, whatever lies between."""
    pieces = [*table, b"a", b"B1,", "é".encode(), b"don't", b"x" * 80]
    own = {p: table.get(p) if p in table else count(tokenizer, p) for p in pieces}
    for k, gap in enumerate((b" ", b"  ", b"\n", b"\t", b" \n ", b"\r\n", b"\x0b", b"\x0c")):
        some = pieces[k::8][:500]
        text = gap + gap.join(some) + gap
        if count(tokenizer, text) != sum(own[p] for p in some):
            raise ValueError("this tokenizer does not treat the pieces between white space alone: "
                             f"their tokens do not add up to those of a text with {gap!r} between them")


def load(definition: str):
    """A tokenizer from the text of its JSON file, without truncation and padding."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def frequent_pieces(docs: DataFrame, text_col: str, limit: int = FREQUENT, share: int = SHARE) -> list[bytes]:
    """The ``limit`` most frequent short pieces, counted where a batch has them often.

    A piece that is one in ``share`` of the whole corpus is that frequent in
    at least one batch, so it is among those reported.
    """
    def run(batches):
        for batch in batches:
            counts: Counter = Counter()
            for text in batch.column(0).to_pylist():
                for part in slices((text or "").encode("utf-8", "surrogatepass")):
                    counts.update(part)
            least = max(2, counts.total() / share)
            often = [(p, n) for p, n in counts.items() if n >= least and len(p) <= PIECE_BYTES]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in often], pa.binary()),
                                              pa.array([n for _, n in often], pa.int64())], ["piece", "n"])

    found = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "piece binary, n long")
    top = found.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(limit)
    return [bytes(r["piece"]) for r in top.collect()]  # at most ``limit`` short rows


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT, frequent: int = FREQUENT, cache: int = CACHE) -> DataFrame:
    """One row per input row: ``id_col``, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    ``tokenizer_path`` is a tokenizer JSON file on the driver; its text is
    sent to the workers.  The tokenizer must drop white space and treat the
    pieces between it independently, as word-level BPE does; one that is found
    not to raises.  Special strings inside texts are handled as the library does by default.  A NULL text
    counts as empty: no bytes and no tokens.  No rows give no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    tokenizer = load(definition)
    pieces = frequent_pieces(docs, text_col, frequent)
    table = {p: count(tokenizer, p) for p in pieces}
    refuse_unsuitable(tokenizer, table)
    shared, run_id = spark.sparkContext.broadcast((definition, table)), uuid.uuid4().hex

    def run(batches):
        lengths = worker_state((run_id, "lengths"),
                               lambda: Lengths(shared.value[1], load(shared.value[0]), cache))
        of = lengths.__getitem__
        for batch in batches:
            n_bytes, n_tokens = [], []
            for text in batch.column(1).to_pylist():
                data = (text or "").encode("utf-8", "surrogatepass")
                n_bytes.append(len(data))
                n_tokens.append(sum(sum(map(of, part)) for part in slices(data)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                 pa.array([n > limit for n in n_tokens], pa.bool_())], names)

    names = [id_col, "n_bytes", "n_tokens", "over_limit"]
    rows = docs.select(id_col, F.col(text_col).cast("string"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
