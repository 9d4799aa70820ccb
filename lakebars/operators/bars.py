"""Daily bars from minute candles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BAR_KEYS = ["ticker", "trade_date"]


def daily_hlv(candles: DataFrame, keys: list[str] = BAR_KEYS) -> DataFrame:
    """A1: max(high), min(low), sum(volume) per ticker-day (partial + final hash agg)."""
    return candles.where(F.col("trade_date").isNotNull()).groupBy(*keys).agg(
        F.max("high").alias("high_price"),
        F.min("low").alias("low_price"),
        F.sum("volume").alias("volume"),
    )


def daily_ohlcv(candles: DataFrame, keys: list[str] = BAR_KEYS) -> DataFrame:
    """A4: one OHLCV bar per ticker-day in a single aggregation.

    open/close are the values of the first/last candle by begin_ts (a NULL
    there stays NULL, as with a first-row pick); all-NULL high/low/volume give
    NULL.  ``min_by``/``max_by`` keep a fixed-width buffer, so Spark plans a
    hash aggregate with a map-side partial step: a hot ticker is combined
    before the shuffle.  Column order is that of the staged bar.
    """
    bars = candles.where(F.col("trade_date").isNotNull()).groupBy(*keys).agg(
        F.min_by("open", "begin_ts").alias("open_price"),
        F.max_by("close", "begin_ts").alias("close_price"),
        F.max("high").alias("high_price"),
        F.min("low").alias("low_price"),
        F.sum("volume").alias("volume"),
    )
    others = [k for k in keys if k != "trade_date"]
    return bars.select("trade_date", "open_price", "close_price", "high_price", "low_price",
                       "volume", *others)


def dedupe_latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """A5: one row per key, the first by ``order`` (put the newest load first).

    ``row_number() = 1`` is planned with a partial WindowGroupLimit before the
    shuffle, so every map task forwards at most one row per key.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def value_where(predicate: Column, value: Column | str) -> Column:
    """A2: conditional aggregate; the largest ``value`` among the rows that satisfy ``predicate``."""
    return F.max(F.when(predicate, F.col(value) if isinstance(value, str) else value))


def first_and_last(candles: DataFrame, keys: list[str] = BAR_KEYS) -> DataFrame:
    """Open of the first and close of the last candle by begin_ts, one hash aggregate."""
    return candles.where(F.col("trade_date").isNotNull()).groupBy(*keys).agg(
        F.min_by("open", "begin_ts").alias("open_price"),
        F.max_by("close", "begin_ts").alias("close_price"))


def recombined_ohlcv(candles: DataFrame, keys: list[str] = BAR_KEYS) -> DataFrame:
    """A1 joined with the open/close aggregate on the (null-safe) key.

    The jobs use :func:`daily_ohlcv`, which needs one aggregation and no join.
    """
    ends = first_and_last(candles, keys).withColumnsRenamed({k: f"_end_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_end_{k}")) for k in keys])
    others = [k for k in keys if k != "trade_date"]
    return daily_hlv(candles, keys).join(ends, same).select(
        "trade_date", "open_price", "close_price", "high_price", "low_price", "volume", *others)


def union_frames(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL of many frames, matched by column name."""
    return reduce(DataFrame.unionByName, frames)


def distinct_candles(candles: DataFrame, load_col: str = "load_date") -> DataFrame:
    """A5 before A4: one candle for each begin of a ticker's load.

    A load that repeats a candle counts it once; when the repeats differ, the
    largest by volume, then by prices, is taken, so open and close do not
    depend on the order of tasks.
    """
    order = [F.col(c).desc_nulls_last() for c in ("volume", "close", "open", "high", "low")]
    return dedupe_latest(candles, ["ticker", load_col, "begin_ts"], order)


def daily_ohlcv_latest_load(candles: DataFrame, load_col: str = "load_date") -> DataFrame:
    """S2 + F1 + A4 fused: the bar of each ticker's newest load, in one scan.

    ``candles`` are typed candles of every load in the window, tagged with
    their load date.  Bars are aggregated per (ticker, load date) with the
    own-day filter folded into the aggregates (``min_by``/``max_by`` skip rows
    whose ordering is NULL), so the window is read once and only partial
    aggregates are shuffled.  The newest load per ticker is then picked among
    at most ``lookback + 1`` bars per ticker.  A load whose file holds no
    candle of its own day still wins and yields no bar, as the per-ticker
    fallback only looks at which files exist.
    """
    own = F.col("trade_date") == F.col(load_col)
    ts = F.when(own, F.col("begin_ts"))
    per_load = candles.groupBy("ticker", load_col).agg(
        F.min_by("open", ts).alias("open_price"),
        F.max_by("close", ts).alias("close_price"),
        F.max(F.when(own, F.col("high"))).alias("high_price"),
        F.min(F.when(own, F.col("low"))).alias("low_price"),
        F.sum(F.when(own, F.col("volume"))).alias("volume"),
        F.count_if(own).alias("_on_day"),
    )
    newest = Window.partitionBy("ticker")
    picked = (per_load.withColumn("_newest", F.max(load_col).over(newest))
              .where((F.col(load_col) == F.col("_newest")) & (F.col("_on_day") > 0)))
    return picked.select(F.col(load_col).alias("trade_date"), "open_price", "close_price", "high_price",
                         "low_price", "volume", "ticker")
