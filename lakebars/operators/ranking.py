"""Row numbers inside groups that may be arbitrarily large.

``row_number() OVER (PARTITION BY key ORDER BY ts)`` sends a whole group to
one task.  Here every row gets a *piece*: the stretch of ``width`` units of
the order column it falls in.  A group has as many pieces as stretches it
spans, so a busy group is cut however many other groups there are, and no
pass over the data is needed to find the cuts.  Rows are numbered inside
(key, piece) by an ordinary window; the largest number in each (key, piece)
is its size, and a small table of those sizes supplies the offset of each
piece within its key.

Orders by several columns, by text or downwards have no such unit: there
the cuts are sampled.  A bounded sample of the rows is sorted by group and
order; every ``step``-th sampled row of a group is a splitter, and a row's
piece is the number of its group's splitters before it.  A group gets
splitters in proportion to its share of all rows, so only large groups are
cut, in pieces of about equal size, and the splitters are few enough to be
sent to every task.

Pieces are a pure function of the row (and of the splitters, which are drawn
once), so every consumer recomputes the same numbers: nothing is
materialised, and a lost task recomputes exactly what it had.  The driver
sees nothing but splitters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

# Width of a piece: 15 minutes of a timestamp, one day of a date, one unit of a number.
TIME_WIDTH = 900.0
PIECE_ROWS = 1_000_000   # rows of a piece between two splitters, about
SPLITTERS = 10_000       # splitters of all groups together at most, about
SAMPLED = 100            # sampled rows for each splitter
SEED = 11


@dataclass(frozen=True)
class By:
    """One column of an order; NULLs come first upwards and last downwards."""
    column: str
    descending: bool = False

    def sort(self) -> Column:
        return F.col(self.column).desc_nulls_last() if self.descending else F.col(self.column).asc_nulls_first()

    def before(self, splitter: Column) -> Column:
        """Whether the splitter's value comes before the row's."""
        own, other = F.col(self.column), splitter[self.column]
        later = (own < other) if self.descending else (own > other)
        null_first = own.isNull() & other.isNotNull() if self.descending else own.isNotNull() & other.isNull()
        return F.coalesce(later, null_first)

    def same(self, splitter: Column) -> Column:
        return F.col(self.column).eqNullSafe(splitter[self.column])


def _not_after(splitter: Column, order: list[By]) -> Column:
    """Whether the row is at the splitter or behind it: column by column, the first that differs decides."""
    found = F.lit(True)
    for by in reversed(order):
        found = by.before(splitter) | (by.same(splitter) & found)
    return found


def sampled_splitters(df: DataFrame, keys: list[str], order: list[By], piece_rows: int = PIECE_ROWS,
                      most: int = SPLITTERS, seed: int = SEED) -> DataFrame | None:
    """``(keys..., _splitters)`` of the groups that a sample finds large, in chunks; ``None`` if no group needs any.

    A splitter stands for about ``piece_rows`` rows of its group and for
    ``SAMPLED`` rows of the sample; there are ``most`` at most.  One pass
    counts the rows, one samples them.  Splitters are collected once, so that
    what follows is a pure function of them.
    """
    total = df.count()
    wanted = min(most, total // piece_rows)
    if not wanted:
        return None
    cols = [by.column for by in order]
    sample = df.select(*keys, *cols)
    share = wanted * SAMPLED / total
    step = SAMPLED if share < 1 else max(1, total // wanted)
    if share < 1:
        sample = sample.sample(share, seed)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*[by.sort() for by in order]))
    chosen = sample.withColumn("_at", place).where(F.col("_at") % step == 0).select(*keys, "_at", F.struct(*cols).alias("_s"))
    held = df.sparkSession.createDataFrame(chosen.collect(), chosen.schema)      # a row for each splitter
    listed = held.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_s"))), lambda x: x["_s"]).alias("_s"))
    width = F.ceil(F.sqrt(F.size("_s"))).cast("int")
    return listed.select(*keys, width.alias("_width"), F.transform(
        F.sequence(F.lit(0), F.size("_s") - 1, width), lambda at: F.slice("_s", at + 1, width)).alias("_splitters"))


def assign_sampled_pieces(df: DataFrame, keys: list[str], order: list[By], **sampling) -> DataFrame:
    """Add ``_piece``: how many splitters of its group are not after the row; found chunk first, then inside it."""
    own = sampled_splitters(df, keys, order, **sampling)
    if own is None:
        return df.withColumn("_piece", F.lit(0).cast("bigint"))
    own = own.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    joined = df.join(F.broadcast(own), [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], "left")
    chunk = F.size(F.filter("_splitters", lambda c: _not_after(F.element_at(c, 1), order)))
    inside = F.size(F.filter(F.element_at("_splitters", F.col("_chunk")), lambda s: _not_after(s, order)))
    joined = joined.withColumn("_chunk", F.when(F.col("_splitters").isNotNull(), chunk).otherwise(F.lit(0)))
    piece = F.when(F.col("_chunk") > 0, (F.col("_chunk") - 1) * F.col("_width") + inside).otherwise(F.lit(0))
    return joined.select(*df.columns, piece.cast("bigint").alias("_piece"))


def _numeric_order(df: DataFrame, column: str):
    """A number that orders like ``column``; zone-free for local timestamps
    (a time-zone conversion is not monotonic across DST changes)."""
    c = F.col(column)
    dtype = df.schema[column].dataType
    if isinstance(dtype, TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, TimestampNTZType):
        seconds = F.expr(f"date_part('SECOND', `{column}`)").cast("double")
        return (F.unix_date(F.to_date(c)).cast("double") * 86400.0
                + F.hour(c) * 3600.0 + F.minute(c) * 60.0 + seconds)
    if isinstance(dtype, DateType):
        return F.unix_date(c)
    return c


def assign_pieces(df: DataFrame, column: str, width: float | None = None) -> DataFrame:
    """Add ``_piece`` (NULL where the order value is), monotone in ``column``.

    Columns that are neither times nor numbers have one piece.
    """
    dtype = df.schema[column].dataType
    if not isinstance(dtype, (TimestampType, TimestampNTZType, DateType, NumericType)):
        return df.withColumn("_piece", F.lit(0).cast("bigint"))
    timed = isinstance(dtype, (TimestampType, TimestampNTZType))
    unit = (width if width is not None else TIME_WIDTH if timed else 1.0) * (1e6 if isinstance(dtype, TimestampType) else 1.0)
    value = _numeric_order(df, column).cast("double") / F.lit(float(unit))
    # NaN and the infinities are at the ends; greatest and least would take NULL for the other value
    bounded = F.when(F.isnan(value) | (value > 9e18), F.lit(9e18)).when(value < -9e18, F.lit(-9e18)).otherwise(value)
    return df.withColumn("_piece", F.floor(bounded).cast("bigint"))


def _order(order) -> list[By]:
    """``"c"`` upwards, ``"c desc"`` downwards."""
    out = []
    for o in order:
        if isinstance(o, By):
            out.append(o)
        elif o.lower().endswith((" desc", " asc")):
            name, way = o.rsplit(" ", 1)
            out.append(By(name, way.lower() == "desc"))
        else:
            out.append(By(o))
    return out


def rank_within(df: DataFrame, keys: list[str], order: list, rank_col: str = "rn",
                size_col: str | None = "group_rows", descending_col: str | None = None,
                width: float | None = None, **sampling) -> DataFrame:
    """Add the 1-based position of every row in its group by ``order``.

    ``order`` names columns (``"c"`` upwards with NULLs first, ``"c desc"``
    downwards with NULLs last).  One time or number upwards is cut by
    ``width``; any other order by sampled splitters.  Rows that are equal in
    all order columns are numbered in any order, and are one piece.
    ``size_col`` carries the group size; ``descending_col`` the position from
    the end (``size - rn + 1``)."""
    if not keys:
        alone = rank_within(df.withColumn("_all", F.lit(0)), ["_all"], order, rank_col, size_col, descending_col, width, **sampling)
        return alone.drop("_all")
    by = _order(order)
    first = df.schema[by[0].column].dataType
    if len(by) == 1 and not by[0].descending and isinstance(first, (TimestampType, TimestampNTZType, DateType, NumericType)):
        pieced = assign_pieces(df, by[0].column, width)
    else:
        pieced = assign_sampled_pieces(df, keys, by, **sampling)

    # Number rows inside (key, piece); the same shuffle also yields each
    # piece's size (its largest local number).
    local = pieced.withColumn(
        "_local", F.row_number().over(Window.partitionBy(*keys, "_piece").orderBy(*[x.sort() for x in by])))
    counts = local.groupBy(*keys, "_piece").agg(F.max("_local").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy(F.col("_piece").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    if size_col or descending_col:
        counts = counts.withColumn("_size", F.sum("_n").over(Window.partitionBy(*keys)))
    counts = counts.select(*[F.col(k).alias(f"_p_{k}") for k in keys], F.col("_piece").alias("_p_piece"),
                           "_before", *(["_size"] if size_col or descending_col else []))
    cond = [F.col("_piece").eqNullSafe(F.col("_p_piece"))] + [F.col(k).eqNullSafe(F.col(f"_p_{k}")) for k in keys]
    joined = local.join(counts, cond, "inner")
    rn = (F.col("_before") + F.col("_local")).cast("bigint")
    return joined.select(
        *[F.col(c) for c in df.columns],
        rn.alias(rank_col),
        *([F.col("_size").cast("bigint").alias(size_col)] if size_col else []),
        *([(F.col("_size") - rn + 1).cast("bigint").alias(descending_col)] if descending_col else []),
    )


def candle_rank(candles: DataFrame) -> DataFrame:
    """Position of each candle in its (ticker, trade_date) from the
    first (``rn_open``) and from the last (``rn_close``) candle by begin_ts."""
    base = candles.where(F.col("trade_date").isNotNull()).select("ticker", "trade_date", "begin_ts")
    return rank_within(base, ["ticker", "trade_date"], ["begin_ts"], rank_col="rn_open",
                       size_col=None, descending_col="rn_close")
