"""Raw API pages: decode (S6, X17) and encode (the inverse, used to land test pages).

A page is ``{"candles": {"metadata": {name: {...}, ...}, "data": [[v, ...], ...]}}``.
Column names are the keys of ``metadata`` in document order; a key repeated
in the text counts once, at its first position, as when the page is parsed
into a JSON object.  Each inner array is one record; pairing names with
values follows ``dict(zip(names, row))``: the shorter side wins.  Missing
``candles``/``data``/``metadata`` mean no records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakebars.operators.ranking import rank_within
from lakebars.schemas import PAGE

CANDLE_FIELDS = ("begin", "open", "close", "high", "low", "volume")
# Column order of a candle page as the exchange API sends it (fixed format).
PAGE_COLUMNS = ("open", "close", "high", "low", "value", "volume", "begin", "end")


def page_names(page: Column) -> Column:
    """Distinct metadata keys in order of first appearance; [] when absent."""
    keys = F.array_distinct(F.json_object_keys(F.get_json_object(page, "$.candles.metadata")))
    return F.coalesce(keys, F.array().cast("array<string>"))


def page_rows(page: Column) -> Column:
    """The data array as array<array<string>>; numbers keep their source text."""
    data = F.from_json(page, PAGE).getField("candles").getField("data")
    return F.coalesce(data, F.array().cast("array<array<string>>"))


def decode_pages(pages: DataFrame, page_col: str = "page", fields=CANDLE_FIELDS,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """One output row per record of every page: (keep..., record_pos, fields...)."""
    named = pages.select(*keep, page_names(F.col(page_col)).alias("_names"),
                         page_rows(F.col(page_col)).alias("_rows"))
    rows = named.select(*keep, "_names", F.posexplode("_rows").alias("record_pos", "_row"))
    width = F.least(F.size("_names"), F.size("_row"))
    pairs = F.arrays_zip(F.slice("_names", 1, width).alias("k"), F.slice("_row", 1, width).alias("v"))
    rows = rows.select(*keep, "record_pos", pairs.alias("_pairs"))

    def field(name: str) -> Column:
        hits = F.filter("_pairs", lambda p: p["k"] == F.lit(name))
        return F.try_element_at(hits, F.lit(-1))["v"]

    return rows.select(*keep, "record_pos", *[field(n).alias(n) for n in fields])


def page_records(pages: DataFrame, page_col: str = "page", keep: tuple[str, ...] = ()) -> DataFrame:
    """Every record of every page as a JSON object of all its fields: (keep..., record_pos, record).

    Values are JSON strings with the page's own text; a missing value is null.
    """
    named = pages.select(*keep, page_names(F.col(page_col)).alias("_names"),
                         page_rows(F.col(page_col)).alias("_rows"))
    rows = named.select(*keep, "_names", F.posexplode("_rows").alias("record_pos", "_row"))
    width = F.least(F.size("_names"), F.size("_row"))
    fields = F.map_from_arrays(F.slice("_names", 1, width), F.slice("_row", 1, width))
    return rows.select(*keep, "record_pos", F.to_json(fields).alias("record"))


def next_page_start(pages: DataFrame, page_col: str = "page", start_col: str = "start",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Offset of the following request: current start (0 if absent) + raw row count.
    An empty page ends paging (NULL next start)."""
    n = F.size(page_rows(F.col(page_col)))
    start = F.coalesce(F.col(start_col), F.lit(0)).cast("bigint")
    return pages.select(*keep, start.alias("start"), n.cast("bigint").alias("records"),
                        F.when(n > 0, start + n).alias("next_start"))


def _json_number(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("null"))


def encode_pages(candles: DataFrame, page_size: int, keys: tuple[str, ...] = ("ticker", "trade_date")) -> DataFrame:
    """Typed candles -> pages of at most ``page_size`` records per key, ordered by begin_ts.

    Output: (keys..., start, page).  Page numbers come from a skew-safe rank,
    so no key group is gathered in one task; one page holds ``page_size`` rows.
    """
    meta = ",".join(f'"{c}":{{"type":"{"datetime" if c in ("begin", "end") else "double"}"}}'
                    for c in PAGE_COLUMNS)
    ranked = rank_within(candles, list(keys), ["begin_ts"], rank_col="_rn", size_col=None)
    begin = F.date_format("begin_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    end = F.date_format(F.col("begin_ts") + F.expr("INTERVAL 59 SECONDS"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    turnover = (F.col("close") * F.col("volume"))
    values = {
        "open": _json_number(F.col("open")), "close": _json_number(F.col("close")),
        "high": _json_number(F.col("high")), "low": _json_number(F.col("low")),
        "value": _json_number(turnover), "volume": _json_number(F.col("volume")),
    }
    # to_json(array(x)) renders the quoted, escaped JSON string; strip the brackets.
    values["begin"] = F.regexp_extract(F.to_json(F.array(begin)), r"^\[(.*)\]$", 1)
    values["end"] = F.regexp_extract(F.to_json(F.array(end)), r"^\[(.*)\]$", 1)
    row_json = F.concat(F.lit("["), F.concat_ws(",", *[values[c] for c in PAGE_COLUMNS]), F.lit("]"))
    per_row = ranked.select(*keys, F.floor((F.col("_rn") - 1) / page_size).cast("bigint").alias("_page"),
                            F.col("_rn"), row_json.alias("_json"))
    grouped = per_row.groupBy(*keys, "_page").agg(
        F.sort_array(F.collect_list(F.struct("_rn", "_json"))).alias("_items"))
    body = F.array_join(F.transform("_items", lambda x: x["_json"]), ",")
    page = F.concat(F.lit('{"candles":{"metadata":{' + meta + '},"data":['), body, F.lit("]}}"))
    return grouped.select(*keys, (F.col("_page") * page_size).alias("start"), page.alias("page"))
