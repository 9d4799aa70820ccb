"""Page decode (S6), paging loop and the Python Data Source."""

import json

import pytest
from pyspark.sql import functions as F

from lakebars.operators.pages import decode_pages, next_page_start, page_records
from lakebars.sources.paged import (FetchError, PageError, advance_by_rows, exchange_rows, page_chain, read_pages,
                                    single_page, with_retry)


def pages_df(spark, docs):
    return spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "pid int, page string")


def test_decode_shapes(spark):
    meta = '{"open":{},"close":{},"begin":{}}'
    docs = [
        '{"candles":{"metadata":' + meta + ',"data":[[10.0,10.5]]}}',                  # shorter row
        '{"candles":{"metadata":' + meta + ',"data":[[1,2,"2024-01-02 10:00:00",9]]}}',  # longer row
        '{"candles":{"metadata":{"open":{},"open":{},"close":{}},"data":[[1,2,3]]}}',     # repeated name
        '{"candles":{"metadata":' + meta + ',"data":[]}}',                             # empty data
        '{"other":1}',                                                                  # no candles
    ]
    out = decode_pages(pages_df(spark, docs), fields=("open", "close", "begin"), keep=("pid",))
    rows = {r["pid"]: r for r in out.collect()}
    assert set(rows) == {0, 1, 2}
    assert (rows[0]["open"], rows[0]["close"], rows[0]["begin"]) == ("10.0", "10.5", None)
    assert (rows[1]["open"], rows[1]["close"], rows[1]["begin"]) == ("1", "2", "2024-01-02 10:00:00")
    # a repeated key counts once, at its first position (as a parsed JSON object)
    assert (rows[2]["open"], rows[2]["close"]) == ("1", "2")


def test_next_page_start(spark):
    docs = ['{"candles":{"metadata":{"a":{}},"data":[[1],[2],[3]]}}', '{"candles":{"data":[]}}']
    df = pages_df(spark, docs).withColumn("start", F.lit(3))
    out = {r["pid"]: r for r in next_page_start(df, keep=("pid",)).collect()}
    assert (out[0]["records"], out[0]["next_start"]) == (3, 6)
    assert out[1]["next_start"] is None


def _fake_api(sizes):
    def fetch(params):
        start = params.get("start", 0)
        index = {0: 0, 3: 1, 6: 2}.get(start, 2)
        n = sizes[index]
        return {"candles": {"metadata": {"open": {}, "begin": {}},
                            "data": [[start + i, f"t{start + i}"] for i in range(n)]}}
    return fetch


def test_page_chain_stops_on_empty_page():
    calls = []
    fetch = _fake_api([3, 3, 0])

    def spy(params):
        calls.append(params.get("start", 0))
        return fetch(params)

    got = list(page_chain(spy, advance_by_rows(), {"ticker": "A"}))
    assert [start for start, _ in got] == [0, 3] and sum(exchange_rows(page) for _, page in got) == 6
    assert calls == [0, 3, 6]


def test_long_chain_has_no_limit():
    def fetch(params):
        start = params.get("start", 0)
        return json.dumps({"candles": {"data": [[start]] if start < 3000 else []}})

    assert sum(1 for _ in page_chain(fetch, advance_by_rows(), {})) == 3000


def test_single_page():
    assert list(page_chain(lambda p: {"x": 1}, single_page, {})) == [(0, '{"x": 1}')]
    assert list(page_chain(lambda p: [], single_page, {})) == []


@pytest.mark.parametrize("page", ['{"candles":{"data":5}}', '{"candles":[]}', "[1]", "<html>", '{"candles":{"data":[1]}}'])
def test_malformed_page_raises(page):
    pages = ['{"candles":{"data":[[1]]}}', page]
    fetch = lambda params: pages[min(1, params.get("start", 0))]
    with pytest.raises(PageError):
        list(page_chain(fetch, advance_by_rows(), {}))
    assert len(list(page_chain(fetch, advance_by_rows(), {}, on_bad_page="stop"))) == 1


def test_chain_that_does_not_advance_raises():
    stuck = lambda page, params: (1, dict(params))
    with pytest.raises(PageError):
        list(page_chain(lambda p: "{}", stuck, {"start": 0}))


def test_retry_waits_and_gives_up():
    def failing(*errors):
        left = list(errors)

        def fetch(params):
            if left:
                raise left.pop(0)
            return "page"
        return fetch

    waits = []
    run = lambda *e, **k: with_retry(failing(*e), sleep=waits.append, jitter=lambda: 0.0, **k)({})
    assert run(FetchError("busy", 503), ConnectionResetError(), TimeoutError()) == "page"
    assert waits == [1.0, 2.0, 4.0]
    waits.clear()
    assert run(FetchError("slow down", 429, retry_after=17.5)) == "page" and waits == [17.5]
    waits.clear()
    with pytest.raises(FetchError):
        run(FetchError("not found", 404))
    assert waits == []
    with pytest.raises(FetchError):
        run(*[FetchError("busy", 500)] * 9, retries=7)
    assert waits == [1.0, 2.0, 4.0, 8.0, 16.0, 30.0, 30.0]
    waits.clear()
    with_retry(failing(TimeoutError()), sleep=waits.append, jitter=lambda: 1.0)({})
    assert waits == [0.5]                       # jitter takes up to a half


def test_requests_are_read_in_parallel_with_own_parameters(spark):
    def fetch(params):
        rows = [[params["interval"], params["date"], params["ticker"]]] * params["n"]
        return {"candles": {"metadata": {"open": {}, "begin": {}, "close": {}},
                            "data": rows[params.get("start", 0):params.get("start", 0) + 2]}}

    requests = spark.createDataFrame([("A", "2024-01-02", '{"interval": 1, "n": 5}'),
                                      ("B", "2024-01-03", '{"interval": 24, "n": 2}')],
                                     "ticker string, load_date string, params string")
    pages = read_pages(requests, fetch)
    assert sorted((r["ticker"], r["request_start"]) for r in pages.collect()) == [("A", 0), ("A", 2), ("A", 4), ("B", 0)]
    records = page_records(pages, keep=("ticker", "load_date")).collect()
    assert len(records) == 7
    assert {r["record"] for r in records if r["ticker"] == "B"} == {'{"open":"24","begin":"2024-01-03","close":"B"}'}


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

value = st.one_of(st.integers(-5, 500), st.sampled_from(["2024-01-02 10:00:00", "x", ""]))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.sampled_from(["open", "close", "begin", "extra"]), max_size=5),
       st.lists(st.lists(value, max_size=6), max_size=4))
def test_spark_decode_agrees_with_parsed_pages(spark, names, data):
    meta = "{" + ",".join(f'"{n}":{{}}' for n in names) + "}"
    page = '{"candles":{"metadata":' + meta + ',"data":' + json.dumps(data) + "}}"
    parsed = json.loads(page)["candles"]
    records = [dict(zip(parsed["metadata"], row)) for row in parsed["data"]]
    assert exchange_rows(page) == len(records)
    expected = [tuple(None if r.get(f) is None else str(r[f]) for f in ("open", "close", "begin"))
                for r in records]
    out = decode_pages(pages_df(spark, [page]), fields=("open", "close", "begin"), keep=("pid",))
    got = [tuple(r[f] for f in ("open", "close", "begin")) for r in out.orderBy("record_pos").collect()]
    assert got == expected


@pytest.mark.parametrize("body", ['{"error": "try later"}', '{"candles": {"metadata": {}}}', "{}"])
def test_missing_records_do_not_end_a_chain(body):
    """An error body sent as success in mid-chain raises; the pages after it are not lost."""
    pages = {0: '{"candles":{"data":[[1]]}}', 1: body}
    with pytest.raises(PageError):
        list(page_chain(lambda params: pages[params.get("start", 0)], advance_by_rows(), {}))
