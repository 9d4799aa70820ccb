"""Literal seed rows (S10) and the ticker universe as a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from lakebars.functions.params import parse_ticker_list
from lakebars.schemas import ISSUER


def seed_rows(spark: SparkSession, rows: list[tuple], schema: StructType = ISSUER) -> DataFrame:
    """``INSERT ... VALUES`` rows as a DataFrame with a fixed schema."""
    return spark.createDataFrame(rows, schema)


def universe_frame(spark: SparkSession, tickers) -> DataFrame:
    """A ticker list parameter ("A,B,C") as a one-column frame for a semi join.

    Its size is that of the parameter held by the driver, so it may be
    broadcast without further checks.
    """
    names = parse_ticker_list(tickers)
    return spark.createDataFrame([(t,) for t in names], StructType([StructField("ticker", StringType(), False)]))
