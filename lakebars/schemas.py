"""Explicit schemas of every layer; nothing on the hot path is inferred."""

from pyspark.sql.types import (ArrayType, BooleanType, DateType, DecimalType, DoubleType, LongType,
                               StringType, StructField, StructType, TimestampNTZType)

PRICE = DecimalType(18, 6)
RETURN_PCT = DecimalType(18, 2)

# One raw candle as it lands in the JSONL files: every field is text so that
# a malformed value costs one field, not the row (see functions.casts).
RAW_CANDLE = StructType([
    StructField("begin", StringType()),
    StructField("open", StringType()),
    StructField("close", StringType()),
    StructField("high", StringType()),
    StructField("low", StringType()),
    StructField("volume", StringType()),
])

# Raw API page: {"candles": {"metadata": {...}, "data": [[...], ...]}}
PAGE = StructType([
    StructField("candles", StructType([
        StructField("data", ArrayType(ArrayType(StringType()))),
    ])),
])

ISSUER = StructType([
    StructField("ticker", StringType(), False),
    StructField("company_name", StringType()),
    StructField("sector", StringType()),
    StructField("dividend_policy_active", BooleanType()),
])

STAGED_BAR = StructType([
    StructField("trade_date", DateType()),
    StructField("open_price", DoubleType()),
    StructField("close_price", DoubleType()),
    StructField("high_price", DoubleType()),
    StructField("low_price", DoubleType()),
    StructField("volume", LongType()),
    StructField("ticker", StringType()),
])

ODS_BAR = StructType([
    StructField("ticker", StringType()),
    StructField("open_price", PRICE),
    StructField("close_price", PRICE),
    StructField("high_price", PRICE),
    StructField("low_price", PRICE),
    StructField("volume", LongType()),
    StructField("load_dt", TimestampNTZType()),
    StructField("trade_date", DateType()),
])

DIMENSION = StructType([
    StructField("emitent_id", LongType()),
    StructField("ticker", StringType()),
    StructField("company_name", StringType()),
    StructField("sector", StringType()),
    StructField("dividend_policy_active", BooleanType()),
    StructField("valid_from", TimestampNTZType()),
    StructField("valid_to", TimestampNTZType()),
    StructField("is_current", BooleanType()),
])

MART = StructType([
    StructField("ticker", StringType()),
    StructField("company_name", StringType()),
    StructField("sector", StringType()),
    StructField("is_dividend_payer", BooleanType()),
    StructField("open_price", PRICE),
    StructField("close_price", PRICE),
    StructField("high_price", PRICE),
    StructField("low_price", PRICE),
    StructField("volume", LongType()),
    StructField("daily_return_pct", RETURN_PCT),
    StructField("trade_date", DateType()),
])

ISSUER_ATTRIBUTES = ["company_name", "sector", "dividend_policy_active"]


def ddl(schema: StructType) -> str:
    """Column list for CREATE TABLE."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
