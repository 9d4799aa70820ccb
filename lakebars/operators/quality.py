"""Data-quality operators (Q1-Q3, A3).

Q1 rules for a daily bar; a NULL comparison is not a violation, so NULL
prices pass, and a day without rows passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DataQualityError(RuntimeError):
    """Raised when a gate fails; downstream steps must not run."""


class GateStopped(DataQualityError):
    """The quality gate found violations; ``counts`` says how many of each rule."""

    def __init__(self, counts: dict):
        super().__init__(f"data-quality gate failed: {counts}")
        self.counts = counts


class MissingSnapshotError(RuntimeError):
    """Q3: no reference snapshot for the process date or its fallback dates."""


# Fixed rule set of the daily-bar gate (must match the reference's check):
# high < low, volume < 0, open <= 0, close <= 0.
BAR_RULES: dict[str, str] = {
    "high_below_low": "high_price < low_price",
    "negative_volume": "volume < 0",
    "non_positive_open": "open_price <= 0",
    "non_positive_close": "close_price <= 0",
}


def _rules(rules: dict[str, Column | str] | None) -> dict[str, Column]:
    rules = BAR_RULES if rules is None else rules
    return {name: F.expr(p) if isinstance(p, str) else p for name, p in rules.items()}


def dq_violations(bars: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Rows that break at least one rule, with the names of the broken rules."""
    rules = _rules(rules)
    hit = F.concat_ws(",", *[F.when(pred, F.lit(name)) for name, pred in rules.items()])
    return bars.withColumn("failed_rules", hit).where(F.col("failed_rules") != "")


def dq_summary(bars: DataFrame, by: tuple[str, ...] = ("trade_date",),
               rules: dict[str, Column] | None = None) -> DataFrame:
    """One pass, one ``count_if`` per rule, per group; ``passed`` when all are 0."""
    rules = _rules(rules)
    counts = [F.count_if(pred).alias(name) for name, pred in rules.items()]
    total = sum((F.col(name) for name in rules), F.lit(0))
    return (bars.groupBy(*by).agg(F.count(F.lit(1)).alias("rows_checked"), *counts)
            .withColumn("violations", total.cast("bigint"))
            .withColumn("passed", F.col("violations") == 0))


def gate_metrics(rules: dict[str, Column] | None = None, where: Column | None = None) -> list[Column]:
    """The gate's aggregates: rows checked and one ``count_if`` per rule,
    over the rows that satisfy ``where`` (all rows when None).

    Usable in ``agg`` or as an ``Observation`` of a write that already
    passes over the rows, so the gate costs no extra job.
    """
    rules = _rules(rules)
    scope = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    return [F.count_if(scope).alias("rows_checked"),
            *[F.count_if(scope & pred).alias(name) for name, pred in rules.items()]]


#: Staged prices that the price type cannot hold; they arrive as NULL and would pass the other rules.
LOST_PRICES = "price_out_of_range"


def gate_verdict(counts: dict, rules: dict[str, Column] | None = None) -> dict:
    """Raise :class:`GateStopped` when any rule count, or that of lost prices, is non-zero."""
    names = {*_rules(rules), LOST_PRICES}
    result = {k: int(v or 0) for k, v in counts.items() if k == "rows_checked" or k in names}
    failed = {k: v for k, v in result.items() if k in names and v}
    result["passed"] = not failed
    if failed:
        raise GateStopped(failed)
    return result


def combine_counts(*counts: dict) -> dict:
    out: dict = {}
    for c in counts:
        for k, v in c.items():
            out[k] = out.get(k, 0) + int(v or 0)
    return out


def dq_gate(bars: DataFrame, rules: dict[str, Column] | None = None) -> dict:
    """Check ``bars`` (already restricted to the dates under test); raise on failure.

    Only one row of counts reaches the driver.
    """
    return gate_verdict(bars.agg(*gate_metrics(rules)).first().asDict(), rules)


def key_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q2: keys that occur more than once, and NULL keys, with their counts.

    The count is a partial aggregate, so a hot key costs one row per map task.
    """
    any_null = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .where((F.col("row_count") > 1) | any_null))


def assert_unique_keys(df: DataFrame, keys: list[str], what: str = "source") -> None:
    """Raise when a key repeats or is NULL (PRIMARY KEY / conflict target check)."""
    bad = key_duplicates(df, keys).limit(5).collect()
    if bad:
        raise DataQualityError(f"{what}: duplicate or NULL keys on {keys}: {[r.asDict() for r in bad]}")
