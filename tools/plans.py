"""Write docs/PLANS.md: the final (post-AQE) formatted plans of the headline operators.

    python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NOTES = {
    "daily_ohlcv_by_user": "A4: one partial hash aggregate before the only exchange; pruned 4-column read.",
    "day_filter": "F1: `to_date(ts) = D` arrives at Parquet as a pushed range on `ts`.",
    "dedupe_latest": "A5: partial `WindowGroupLimit` before the exchange forwards one row per key per task.",
    "upsert_orders": "D2: one scan of each side, a single full outer join on the key; the key check uses the sort of the join.",
    "scd2_merge": "D3 (strict): per merge one aggregate of each side + one full outer join; no semi or anti joins.",
    "mart_daily": "J5 + X15: bars aggregate, as-of join (AQE picks the build side from measured sizes).",
    "candle_rank": "W1/W2: time pieces inside the group; one exchange, reused for the piece sizes; offsets from a small table.",
    "silver_bars": "L2: one JSON scan of the window's folders, repeated candles dropped before the shuffle, one aggregate per (ticker, load date), newest load per ticker.",
}


def final_plan(df) -> str:
    df.collect()  # run it, so the adaptive plan is final
    jvm = df.sparkSession.sparkContext._jvm
    text = jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    text = re.sub(r"#\d+L?", "", text)                    # expression ids only add noise
    text = re.sub(r"file:/tmp/[^\],]*", "file:<work>", text)
    return text


def silver_bars_frame(spark, sf_dir):
    from pyspark.sql import functions as F

    from lakebars.plans import bindings as B
    from lakebars.plans import jobs
    from lakebars.session import new_run_dir

    root = new_run_dir(spark, "plans-lakehouse")
    lh = jobs.Lakehouse(root, db="p_" + os.path.basename(root).replace("-", "_")).ensure(spark)
    raw = B.raw_candles(B.table(spark, sf_dir, "events"), by="user")
    landed = raw.withColumn("load_date", F.to_date(F.col("begin").try_cast("timestamp_ntz")))
    jobs.land_candle_records(lh, landed.select(
        "ticker", "load_date", F.to_json(F.struct("begin", "open", "close", "high", "low", "volume")).alias("record")))
    return jobs.silver_bars(spark, lh, B.PROCESS_DATE)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from lakebars.plans import registry as R
    from lakebars.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    qs = R.queries()
    parts = [f"# Final physical plans ({os.path.basename(sf_dir)}, local[8], AQE on)\n",
             "Generated by `tools/plans.py` after running each query, so adaptive decisions "
             "(broadcast conversion, coalesced partitions) are the ones taken.\n"]
    for name, note in NOTES.items():
        df = silver_bars_frame(spark, sf_dir) if name == "silver_bars" else qs[name](spark, sf_dir)
        parts.append(f"\n## {name}\n\n{note}\n\n```\n{final_plan(df).strip()}\n```\n")
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    os.makedirs(os.path.dirname(out), exist_ok=True)
    with open(out, "w") as fh:
        fh.write("".join(parts))
    print(out, sum(len(p) for p in parts))
    spark.stop()


if __name__ == "__main__":
    main()
