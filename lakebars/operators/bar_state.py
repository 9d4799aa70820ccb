"""Mergeable bar states (A4, A5): a late load updates a bar without a second look at the day.

A state is what one load knows of one bar: first and last candle as (time,
value), extremes, sums and rows.  States of different loads add up in any
order; a load that is stored again replaces what it said before.  The
operational bar of a (ticker, day) is the sum of its states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

BAR_STATE = StructType([
    StructField("ticker", StringType()), StructField("load_id", LongType()),
    StructField("first_ts", TimestampNTZType()), StructField("first_open", DoubleType()),
    StructField("last_ts", TimestampNTZType()), StructField("last_close", DoubleType()),
    StructField("high", DoubleType()), StructField("low", DoubleType()),
    StructField("volume", LongType()), StructField("candles", LongType()), StructField("trade_date", DateType())])


def bar_states(candles: DataFrame, load_id="load_id") -> DataFrame:
    """Typed candles of one or more loads -> a state for each (ticker, day, load): one hash aggregate.

    Candles without a day are left out; a NULL price or volume is kept as
    the value of its candle and ignored by extremes and sums, as in
    :func:`~lakebars.operators.bars.daily_ohlcv`.
    """
    rows = candles.where(F.col("trade_date").isNotNull()).withColumn("load_id", F.col(load_id).cast("bigint"))
    return rows.groupBy("ticker", "trade_date", "load_id").agg(
        F.min("begin_ts").alias("first_ts"), F.min_by("open", "begin_ts").alias("first_open"),
        F.max("begin_ts").alias("last_ts"), F.max_by("close", "begin_ts").alias("last_close"),
        F.max("high").alias("high"), F.min("low").alias("low"), F.sum("volume").alias("volume"),
        F.count(F.lit(1)).alias("candles")).select(*BAR_STATE.fieldNames())


def merge_states(held: DataFrame, new: DataFrame) -> DataFrame:
    """The states after ``new``: those of its (day, load) pairs replace held ones, all others stay.

    The anti join is on few pairs (the days and loads that ``new`` brings),
    which Spark broadcasts after measuring them.
    """
    loads = new.select("trade_date", "load_id").distinct()
    return held.join(loads, ["trade_date", "load_id"], "left_anti").select(*BAR_STATE.fieldNames()).unionByName(
        new.select(*BAR_STATE.fieldNames()))


def bars_from_states(states: DataFrame) -> DataFrame:
    """The daily bars that the states add up to; of candles at the same time the one of the newest load counts.

    Column order is that of the staged bar.
    """
    first, last = F.struct("first_ts", (-F.col("load_id")).alias("l")), F.struct("last_ts", "load_id")
    return states.groupBy("ticker", "trade_date").agg(
        F.min_by("first_open", first).alias("open_price"), F.max_by("last_close", last).alias("close_price"),
        F.max("high").alias("high_price"), F.min("low").alias("low_price"), F.sum("volume").alias("volume")).select(
        "trade_date", "open_price", "close_price", "high_price", "low_price", "volume", "ticker")
