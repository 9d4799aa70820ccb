"""Independent ANSI SQL (DuckDB dialect) for every registered query.

Written from the semantics, not from the Spark code: first/last through
``arg_min_null``/``arg_max_null``, dedup through ``QUALIFY``, upserts through
``FULL OUTER JOIN``, the SCD2 merge as one branch for each outcome over the
lined-up tickers, the daily return through exact integer arithmetic on cents (half away from zero).
"""

from __future__ import annotations

D = "DATE '2024-01-15'"
D_PREV = "DATE '2024-01-14'"
LATE_TS = "TIMESTAMP '2024-01-08 00:00:00'"
RUN_TS = "TIMESTAMP '2024-01-15 00:00:00'"
BASE_TS = "TIMESTAMP '2024-01-01 00:00:00'"
START = "TIMESTAMP '1900-01-01 00:00:00'"
OPEN_END = "TIMESTAMP '9999-12-31 23:59:59'"

CANDLE_COLS = "ticker, begin_ts, open, close, high, low, volume, trade_date"


def candles(by: str = "type") -> str:
    ticker = "event_type" if by == "type" else "CAST(user_id AS VARCHAR)"
    return (f"SELECT {ticker} AS ticker, ts AS begin_ts, value AS open, value AS close, value AS high, "
            f"value AS low, CAST(json_extract_string(props, '$.k') AS BIGINT) AS volume, "
            f"CAST(ts AS DATE) AS trade_date FROM events")


def bars(by: str = "type") -> str:
    return (f"SELECT trade_date, arg_min_null(open, begin_ts) AS open_price, "
            f"arg_max_null(close, begin_ts) AS close_price, max(high) AS high_price, "
            f"min(low) AS low_price, CAST(sum(volume) AS BIGINT) AS volume, ticker "
            f"FROM ({candles(by)}) c GROUP BY ticker, trade_date")


def issuers(version: int) -> str:
    if version == 1:
        return ("SELECT CAST(c_custkey AS VARCHAR) AS ticker, c_name AS company_name, "
                "c_mktsegment AS sector, c_acctbal > 0 AS dividend_policy_active "
                "FROM customer WHERE c_custkey % 13 <> 0")
    return ("SELECT CAST(c_custkey AS VARCHAR) AS ticker, c_name AS company_name, "
            "CASE WHEN c_custkey % 7 = 0 THEN 'RESEGMENTED' ELSE c_mktsegment END AS sector, "
            "CASE WHEN c_custkey % 11 = 0 THEN NOT (c_acctbal > 0) ELSE c_acctbal > 0 END "
            "AS dividend_policy_active FROM customer WHERE c_custkey % 17 <> 0")


HASH = "md5(concat_ws('||', company_name, sector, CAST(dividend_policy_active AS VARCHAR)))"


def v1_dimension() -> str:
    """v1 loaded into an empty dimension."""
    return (f"SELECT ticker, company_name, sector, dividend_policy_active, {START} AS valid_from, "
            f"{OPEN_END} AS valid_to, TRUE AS is_current FROM ({issuers(1)}) v1")


def merged_dimension(run_ts: str = RUN_TS) -> str:
    """v2 merged at ``run_ts``: tickers of both sides lined up once, then one branch for each outcome."""
    same = (f"md5(concat_ws('||', p.old.company_name, p.old.sector, CAST(p.old.flag AS VARCHAR))) = "
            f"md5(concat_ws('||', p.new.company_name, p.new.sector, CAST(p.new.flag AS VARCHAR)))")
    packed = "{{'company_name': {t}.company_name, 'sector': {t}.sector, 'flag': {t}.dividend_policy_active}}"
    pairs = (f"SELECT COALESCE(a.ticker, b.ticker) AS ticker, a.ticker IS NOT NULL AS was, b.ticker IS NOT NULL AS given, "
             f"{packed.format(t='a')} AS old, {packed.format(t='b')} AS new "
             f"FROM ({issuers(1)}) a FULL OUTER JOIN ({issuers(2)}) b ON a.ticker = b.ticker")
    lined = f"SELECT p.*, was AND given AND NOT ({same}) AS changed FROM ({pairs}) p"

    def branch(side: str, lo: str, hi: str, current: str, when: str) -> str:
        return (f"SELECT ticker, {side}.company_name AS company_name, {side}.sector AS sector, "
                f"{side}.flag AS dividend_policy_active, {lo} AS valid_from, {hi} AS valid_to, "
                f"{current} AS is_current FROM ({lined}) l WHERE {when}")

    return " UNION ALL ".join([
        branch("old", START, run_ts, "FALSE", "changed"),                 # closed
        branch("old", START, OPEN_END, "TRUE", "was AND NOT changed"),    # kept
        branch("new", run_ts, OPEN_END, "TRUE", "changed"),               # opened after a closed one
        branch("new", START, OPEN_END, "TRUE", "given AND NOT was"),      # opened for a new ticker
    ])


def scd2_ctes(run_ts: str = RUN_TS) -> str:
    return f"dim1 AS ({v1_dimension()}), dim2 AS ({merged_dimension(run_ts)})"


def mart(dim: str = "dim2", source: str | None = None, more: str = "", same: str = "") -> str:
    """Mart rows from user bars (or ``source``) and a dimension CTE; return on integer cents."""
    return f"""
SELECT b.ticker, d.company_name, d.sector, d.dividend_policy_active AS is_dividend_payer,
       b.open_price, b.close_price, b.high_price, b.low_price, b.volume,
       CASE WHEN b.o_c > 0 THEN CAST(sign(b.c_c - b.o_c) * ((2 * abs(b.c_c - b.o_c) * 10000 + b.o_c) // (2 * b.o_c)) AS DOUBLE) / 100.0
       END AS daily_return_pct,
       b.trade_date{more}
FROM (SELECT *, CAST(round(open_price * 100) AS BIGINT) AS o_c, CAST(round(close_price * 100) AS BIGINT) AS c_c
      FROM ({source or bars('user')}) x) b
JOIN {dim} d ON {same}b.ticker = d.ticker AND b.trade_date >= CAST(d.valid_from AS DATE)
            AND b.trade_date < CAST(d.valid_to AS DATE)"""


RULES = {
    "high_below_low": "high_price < low_price",
    "negative_volume": "volume < 0",
    "non_positive_open": "open_price <= 0",
    "non_positive_close": "close_price <= 0",
}


def three_runs() -> str:
    """CTEs of the runs of D-1 (1), D (2) and D+1 (3): what each stages, which the gate stops, the dimension each leaves.

    A run is stopped if a bar in the operational table, as the run leaves it,
    breaks a rule on a day that the run touched (its own day included).
    """
    day = ("DATE '2024-01-13'", D_PREV, D, "DATE '2024-01-16'")
    v2_first = (f"SELECT ticker, company_name, sector, dividend_policy_active, {START} AS valid_from, "
                f"{OPEN_END} AS valid_to, TRUE AS is_current FROM ({issuers(2)}) v2")
    own_day = "CASE run WHEN 1 THEN {} WHEN 2 THEN {} ELSE {} END".format(*day[1:])
    return f"""
{scd2_ctes()}, late2 AS ({merged_dimension("TIMESTAMP '2024-01-17 00:00:00'")}), dim2b AS ({merged_dimension("TIMESTAMP '2024-01-16 00:00:00'")}),
b AS ({bars('user')}),
has AS (SELECT ticker, CAST(ticker AS BIGINT) % 5 = 0 AS late, bool_or(trade_date = {day[0]}) AS d13,
        bool_or(trade_date = {day[1]}) AS d14, bool_or(trade_date = {day[2]}) AS d15, bool_or(trade_date = {day[3]}) AS d16
        FROM b GROUP BY ticker),
staged AS (SELECT 1 AS run, ticker, CASE WHEN d14 AND NOT late THEN {day[1]} WHEN d13 THEN {day[0]} END AS day FROM has
           UNION ALL SELECT 2, ticker, CASE WHEN d15 THEN {day[2]} WHEN d14 THEN {day[1]} END FROM has
           UNION ALL SELECT 3, ticker, CASE WHEN d16 THEN {day[3]} WHEN d15 THEN {day[2]} END FROM has),
ods AS (SELECT b.*, s.run FROM b JOIN (SELECT ticker, day, min(run) AS run FROM staged GROUP BY ticker, day) s
        ON s.ticker = b.ticker AND s.day = b.trade_date),
runs AS (SELECT unnest([1, 2, 3]) AS run),
touched AS (SELECT run, day, count(*) AS staged_rows FROM staged WHERE day IS NOT NULL GROUP BY run, day
            UNION ALL SELECT run, {own_day}, 0 FROM runs
            WHERE NOT EXISTS (SELECT 1 FROM staged s WHERE s.run = runs.run AND s.day = {own_day.replace('run', 'runs.run', 1)})),
gate AS (SELECT t.run, t.day, t.staged_rows, {", ".join(f"count(*) FILTER (WHERE {p}) AS {n}" for n, p in RULES.items())}
         FROM touched t LEFT JOIN ods ON ods.trade_date = t.day AND ods.run <= t.run GROUP BY t.run, t.day, t.staged_rows),
ok AS (SELECT run, max({" + ".join(RULES)}) = 0 AS ok FROM gate GROUP BY run),
flags AS (SELECT bool_or(ok AND run = 1) AS ok1, bool_or(ok AND run = 2) AS ok2 FROM ok),
dims AS (SELECT 1 AS run, d.* FROM dim1 d
         UNION ALL SELECT 2, d.* FROM dim2b d, flags WHERE ok1 UNION ALL SELECT 2, d.* FROM ({v2_first}) d, flags WHERE NOT ok1
         UNION ALL SELECT 3, d.* FROM dim2b d, flags WHERE ok1 AND ok2 UNION ALL SELECT 3, d.* FROM late2 d, flags WHERE ok1 AND NOT ok2
         UNION ALL SELECT 3, d.* FROM ({v2_first}) d, flags WHERE NOT ok1),
last_run AS (SELECT t.day, max(t.run) AS run FROM touched t JOIN ok ON ok.run = t.run AND ok.ok GROUP BY t.day)"""


LINEITEM_ORDER = ("l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, "
                  "l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC")
LINEITEM_VALUES = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                   "l_returnflag", "l_linestatus", "l_shipdate"]


def anomalies() -> str:
    return f"""
SELECT ticker, trade_date,
       CASE WHEN volume % 13 = 0 THEN 0.0 ELSE open_price END AS open_price,
       CASE WHEN volume % 17 = 0 THEN NULL ELSE close_price END AS close_price,
       CASE WHEN volume % 7 = 0 THEN low_price - 1 ELSE high_price END AS high_price,
       low_price,
       CASE WHEN volume % 11 = 0 THEN -volume ELSE volume END AS volume
FROM ({bars('user')}) b"""


def _pick(cols, src="s", tgt="t", flag="s.o_orderkey"):
    return ", ".join(f"CASE WHEN {flag} IS NOT NULL THEN {src}.{c} ELSE {tgt}.{c} END AS {c}" for c in cols)


ORDER_VALUES = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def oracle_sql() -> dict[str, str]:
    c_type = candles("type")
    c_user = candles("user")
    rules_case = ", ".join(f"CASE WHEN {p} THEN '{n}' END" for n, p in RULES.items())
    rule_counts = ", ".join(f"count(*) FILTER (WHERE {p}) AS {n}" for n, p in RULES.items())
    rule_sum = " + ".join(f"count(*) FILTER (WHERE {p})" for p in RULES.values())
    li_keys = "l_orderkey, l_linenumber"
    mart_cols = ("ticker, company_name, sector, is_dividend_payer, CAST(open_price AS DOUBLE) AS open_price, "
                 "CAST(close_price AS DOUBLE) AS close_price, CAST(high_price AS DOUBLE) AS high_price, "
                 "CAST(low_price AS DOUBLE) AS low_price, volume, daily_return_pct, trade_date")
    latest_load = (
        f"WITH c AS (SELECT *, trade_date AS load_date FROM ({c_user}) x "
        f"WHERE trade_date IN ({D_PREV}, {D})), m AS (SELECT ticker, max(load_date) AS load_date "
        f"FROM c GROUP BY ticker) SELECT c.* FROM c JOIN m ON c.ticker = m.ticker AND c.load_date = m.load_date")
    return {
        "candles_typed": c_type,
        "day_filter": f"SELECT * FROM ({c_type}) c WHERE trade_date = {D}",
        "daily_hlv": (f"SELECT ticker, trade_date, max(high) AS high_price, min(low) AS low_price, "
                      f"CAST(sum(volume) AS BIGINT) AS volume FROM ({c_user}) c GROUP BY ticker, trade_date"),
        "candle_rank": (f"SELECT ticker, trade_date, begin_ts, "
                        f"row_number() OVER (PARTITION BY ticker, trade_date ORDER BY begin_ts) AS rn_open, "
                        f"row_number() OVER (PARTITION BY ticker, trade_date ORDER BY begin_ts DESC) AS rn_close "
                        f"FROM ({c_type}) c"),
        "rank_by_text": (
            "WITH r AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'HOT' ELSE o_orderstatus END AS held, o_orderpriority, "
            "CAST(o_orderkey AS VARCHAR) AS order_text FROM orders) SELECT *, "
            "row_number() OVER (PARTITION BY held ORDER BY o_orderpriority DESC, order_text) AS rn, "
            "count(*) OVER (PARTITION BY held) AS group_rows, "
            "row_number() OVER (PARTITION BY held ORDER BY o_orderpriority, order_text DESC) AS rn_last FROM r"),
        "daily_ohlcv": bars("type"),
        "daily_ohlcv_by_user": bars("user"),
        "recombined_ohlcv": (
            f"SELECT trade_date, (list(open ORDER BY begin_ts))[1] AS open_price, "
            f"(list(close ORDER BY begin_ts DESC))[1] AS close_price, max(high) AS high_price, min(low) AS low_price, "
            f"CAST(sum(volume) AS BIGINT) AS volume, ticker FROM ({c_type}) c GROUP BY ticker, trade_date"),
        "dedupe_latest": (f"SELECT * FROM lineitem QUALIFY row_number() OVER "
                          f"(PARTITION BY {li_keys} ORDER BY {LINEITEM_ORDER}) = 1"),
        "latest_available_load": latest_load,
        "latest_load_by_manifest": latest_load,
        "page_decode": c_type,
        "next_page_offset": (
            f"WITH r AS (SELECT ticker, trade_date, (row_number() OVER (PARTITION BY ticker, trade_date "
            f"ORDER BY begin_ts) - 1) // 100 AS page FROM ({c_type}) c) "
            f"SELECT ticker, trade_date, page * 100 AS start, count(*) AS records, "
            f"page * 100 + count(*) AS next_start FROM r GROUP BY ticker, trade_date, page"),
        "universe_filter": f"SELECT * FROM ({c_type}) c WHERE ticker IN ('click', 'purchase', 'view')",
        "union_frames": f"SELECT * FROM ({c_type}) a UNION ALL SELECT * FROM ({c_user}) b",
        "silver_deduped": bars("user"),
        "bars_from_late_loads": bars("user"),
        "dq_violations": (f"SELECT * FROM (SELECT *, concat_ws(',', {rules_case}) AS failed_rules "
                          f"FROM ({anomalies()}) a) v WHERE failed_rules <> ''"),
        "dq_gate": (f"SELECT trade_date, count(*) AS rows_checked, {rule_counts}, "
                    f"CAST({rule_sum} AS BIGINT) AS violations, ({rule_sum}) = 0 AS passed "
                    f"FROM ({anomalies()}) a GROUP BY trade_date"),
        "key_duplicates": (f"SELECT {li_keys}, count(*) AS row_count FROM lineitem GROUP BY {li_keys} "
                           f"HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL"),
        "upsert_orders": (
            f"WITH t AS (SELECT *, {BASE_TS} AS load_dt FROM orders WHERE o_orderkey % 3 < 2), "
            f"s AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * CAST(1.1 AS DOUBLE) AS o_totalprice, "
            f"o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 3 > 0) "
            f"SELECT COALESCE(s.o_orderkey, t.o_orderkey) AS o_orderkey, {_pick(ORDER_VALUES)}, "
            f"CASE WHEN s.o_orderkey IS NOT NULL THEN {RUN_TS} ELSE t.load_dt END AS load_dt "
            f"FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey"),
        "upsert_keeps_latest": (
            f"WITH t AS (SELECT *, {BASE_TS} AS load_dt FROM lineitem WHERE l_linestatus = 'F' "
            f"QUALIFY row_number() OVER (PARTITION BY {li_keys} ORDER BY {LINEITEM_ORDER}) = 1), "
            f"s AS (SELECT * FROM lineitem WHERE l_linestatus = 'O' "
            f"QUALIFY row_number() OVER (PARTITION BY {li_keys} ORDER BY {LINEITEM_ORDER}) = 1) "
            f"SELECT COALESCE(s.l_orderkey, t.l_orderkey) AS l_orderkey, "
            f"COALESCE(s.l_linenumber, t.l_linenumber) AS l_linenumber, "
            f"{_pick(LINEITEM_VALUES, flag='s.l_orderkey')}, "
            f"CASE WHEN s.l_orderkey IS NOT NULL THEN {RUN_TS} ELSE t.load_dt END AS load_dt "
            f"FROM t FULL OUTER JOIN s ON t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber"),
        "upsert_in_buckets": (
            f"SELECT ticker, open_price, close_price, high_price, low_price, "
            f"CASE WHEN CAST(ticker AS BIGINT) % 3 > 0 THEN volume + 1 ELSE volume END AS volume, "
            f"CASE WHEN CAST(ticker AS BIGINT) % 3 > 0 THEN {RUN_TS} ELSE {BASE_TS} END AS load_dt, trade_date "
            f"FROM ({bars('user')}) b"),
        "insert_if_absent": "SELECT * FROM customer",
        "row_hash": (f"SELECT ticker, {HASH} AS row_hash FROM (SELECT CAST(c_custkey AS VARCHAR) AS ticker, "
                     f"c_name AS company_name, c_mktsegment AS sector, c_acctbal > 0 AS dividend_policy_active "
                     f"FROM customer) c"),
        "scd2_changed": f"WITH {scd2_ctes()} SELECT ticker FROM dim2 WHERE NOT is_current",
        "scd2_new": (f"SELECT b.* FROM ({issuers(2)}) b LEFT JOIN ({issuers(1)}) a ON a.ticker = b.ticker "
                     f"WHERE a.ticker IS NULL"),
        "scd2_rerun_older_date": (
            f"WITH {scd2_ctes()}, {scd2_ctes(LATE_TS).replace('dim1', 'early1').replace('dim2', 'early2')} "
            f"SELECT * FROM dim2 WHERE is_current UNION ALL "
            f"SELECT * FROM early2 WHERE NOT is_current UNION ALL "
            f"SELECT ticker, company_name, sector, dividend_policy_active, {LATE_TS} AS valid_from, "
            f"{RUN_TS} AS valid_to, FALSE AS is_current FROM early2 WHERE is_current AND valid_from = {LATE_TS}"),
        "scd2_merge": f"WITH {scd2_ctes()} SELECT * FROM dim2",
        "scd2_asof_join": (
            f"WITH {scd2_ctes()} SELECT b.ticker, b.trade_date, d.company_name, d.sector, "
            f"d.dividend_policy_active, d.valid_from, d.valid_to FROM ({bars('user')}) b JOIN dim2 d "
            f"ON b.ticker = d.ticker AND b.trade_date >= CAST(d.valid_from AS DATE) "
            f"AND b.trade_date < CAST(d.valid_to AS DATE)"),
        "mart_daily": f"WITH {scd2_ctes()} SELECT {mart_cols} FROM ({mart()}) m",
        "day_rebuild": f"WITH {scd2_ctes()} SELECT {mart_cols} FROM ({mart()}) m",
        "day_rebuild_empty": f"WITH {scd2_ctes()} SELECT {mart_cols} FROM ({mart()}) m WHERE trade_date <> {D}",
        "partition_replace": (
            f"WITH {scd2_ctes()} SELECT {mart_cols} FROM ({mart('dim1')}) m WHERE trade_date <> {D} "
            f"UNION ALL SELECT {mart_cols} FROM ({mart('dim2')}) m WHERE trade_date = {D}"),
        "seed_reference": "SELECT * FROM nation",
        "jsonl_round_trip": f"SELECT *, trade_date AS load_date FROM ({c_type}) c",
        "parquet_round_trip": issuers(1),
        "paged_source": c_type,
        "bronze_daily": f"SELECT *, trade_date AS load_date FROM ({c_type}) c",
        "skip_if_empty": (
            f"SELECT DATE '2023-12-31' AS process_date, "
            f"CASE WHEN count(*) = 0 THEN 'SKIPPED' ELSE 'WRITTEN' END AS status, count(*) AS row_count "
            f"FROM events WHERE CAST(ts AS DATE) = DATE '2023-12-31' UNION ALL "
            f"SELECT {D} AS process_date, CASE WHEN count(*) = 0 THEN 'SKIPPED' ELSE 'WRITTEN' END AS status, "
            f"count(*) AS row_count FROM events WHERE CAST(ts AS DATE) = {D}"),
        "daily_run_end_to_end": (
            f"WITH {three_runs()}, served AS (SELECT o.*, l.run AS by_run FROM ods o JOIN last_run l "
            f"ON l.day = o.trade_date AND o.run <= l.run) "
            f"SELECT {mart_cols} FROM ({mart('dims', 'SELECT * FROM served', same='d.run = b.by_run AND ')}) m"),
        "run_ledger": (
            f"WITH {three_runs()} SELECT CASE g.run WHEN 1 THEN {D_PREV} WHEN 2 THEN {D} ELSE DATE '2024-01-16' END AS process_date, "
            f"g.day AS trade_date, CASE g.run WHEN 1 THEN {D} WHEN 2 THEN DATE '2024-01-16' ELSE DATE '2024-01-17' END "
            f"+ INTERVAL 0 DAY AS run_ts, CASE WHEN NOT ok.ok THEN 'STOPPED' WHEN EXISTS (SELECT 1 FROM ods o JOIN dims d "
            f"ON d.run = g.run AND d.ticker = o.ticker AND o.trade_date >= CAST(d.valid_from AS DATE) "
            f"AND o.trade_date < CAST(d.valid_to AS DATE) WHERE o.trade_date = g.day AND o.run <= g.run) "
            f"THEN 'PUBLISHED' ELSE 'EMPTY' END AS state, CAST(g.staged_rows AS BIGINT) AS staged_rows, "
            f"CAST({' + '.join(RULES)} AS BIGINT) AS violations, "
            f"concat_ws(',', {', '.join(f"CASE WHEN {n} > 0 THEN '{n}' END" for n in RULES)}) AS failed_rules "
            f"FROM gate g JOIN ok ON ok.run = g.run"),
        "publish_many_days": (
            f"WITH {scd2_ctes()} SELECT {mart_cols} FROM ({mart('dim1')}) m WHERE trade_date < {D} "
            f"UNION ALL SELECT {mart_cols} FROM ({mart('dim2')}) m WHERE trade_date >= {D}"),
    }
