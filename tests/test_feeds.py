import json

import pytest

from pointgate.operators import points as P
from pointgate.operators.feeds import OVERSIZE_TEXT, decode_feed, resolve_channels

NOW = 1_700_000_000_000
NOW_NS = NOW * 1_000_000


def decode(spark, provider, *messages, **how):
    texts = [m if isinstance(m, str) else json.dumps(m) for m in messages]
    df = spark.createDataFrame([(t,) for t in texts], "raw string").coalesce(1)
    return decode_feed(df, provider, as_of_ms=NOW, **how).collect()


def one(spark, provider, message, **how):
    rows = decode(spark, provider, message, **how)
    return (rows[0].feed, rows[0].metrics, rows[0].timestamp_ns) if rows else None


TRADE = {"symbol": "A/B", "side": "buy", "price": 2.5, "qty": 3.0, "ord_type": "x", "trade_id": 1, "timestamp": "2024-01-05T00:00:00.5Z"}


def kraken(channel, *data, **more):
    return {"channel": channel, "type": "update", "data": list(data), **more}


def test_kraken_trade(spark):
    assert one(spark, "kraken", kraken("trade", TRADE)) == ("trade", [2.5, 3.0], NOW_NS)
    assert one(spark, "KRAKEN", kraken("trade", {"price": "2.5", "quantity": "3"})) == ("trade", [2.5, 3.0], NOW_NS)
    # Only the first trade counts.
    assert one(spark, "kraken", kraken("trade", {"price": 1, "qty": 1}, TRADE))[1] == [1.0, 1.0]


@pytest.mark.parametrize(
    "data",
    [
        [],
        [{"price": 0, "qty": 1}],
        [{"price": 1, "qty": -1}],
        [{"price": "nan", "qty": 1}],
        [{"price": 1}],
        [{"qty": 1}],
        # A present but unusable qty is not replaced by quantity.
        [{"price": 1, "qty": "x", "quantity": 2}],
        [5],
        [{"price": True, "qty": 1}],
    ],
)
def test_kraken_trade_skipped(spark, data):
    assert one(spark, "kraken", kraken("trade", *data)) is None


def test_kraken_other_channels(spark):
    quote = {"bid": 1, "ask": "2", "last": 3, "volume": 4}
    assert one(spark, "kraken", kraken("ticker", quote)) == ("ticker", [1, 2, 3, 4], NOW_NS)
    assert one(spark, "kraken", kraken("ticker", {**quote, "volume": None}))[1] == [1, 2, 3, 0]
    assert one(spark, "kraken", kraken("ticker", {"bid": 1, "ask": 2, "last": 3})) is None
    book = {"bids": [{"price": 1, "qty": 2}, {"price": 0, "qty": 0}], "asks": [{"price": 3, "qty": 4}]}
    assert one(spark, "kraken", kraken("book", book)) == ("book", [1, 2, 3, 4], NOW_NS)
    assert one(spark, "kraken", kraken("book", {**book, "asks": []})) is None
    bar = {"open": 1, "high": 2, "low": 0.5, "close": 1.5, "volume": 9}
    assert one(spark, "kraken", kraken("ohlc", bar)) == ("ohlc", [1, 2, 0.5, 1.5, 9], NOW_NS)
    assert one(spark, "kraken", kraken("heartbeat")) is None
    assert one(spark, "kraken", {"method": "subscribe", "channel": "trade", "data": [TRADE]}) is None
    assert one(spark, "kraken", [kraken("trade", TRADE)]) is None


def test_kraken_time_of_the_message(spark):
    got = one(spark, "kraken", kraken("trade", TRADE), ts_path="timestamp")
    assert got[2] == 1_704_412_800_500_000_000


def test_binance(spark):
    trade = {"e": "trade", "E": 1700, "s": "X", "p": "2.5", "q": "3"}
    want = ("trade", [2.5, 3.0], 1_700_000_000)
    assert one(spark, "binance", trade) == want
    assert one(spark, "binance_futures", {**trade, "e": "aggTrade"}) == want
    assert one(spark, "binance", {"stream": "x@trade", "data": trade}) == want
    assert one(spark, "binance", {"e": "trade", "p": 2.5, "q": 3}) == ("trade", [2.5, 3.0], NOW_NS)
    assert one(spark, "binance", {**trade, "E": 1700.5})[2] == NOW_NS
    assert one(spark, "binance", {**trade, "p": "0"}) is None
    assert one(spark, "binance", {"result": None, "id": 1}) is None
    assert one(spark, "binance", {"stream": "x@trade", **trade}) is None
    assert one(spark, "binance", {"e": "24hrTicker", "b": "1", "a": "2", "c": "3"}) == ("ticker", [1, 2, 3, 0], NOW_NS)
    depth = {"e": "depthUpdate", "E": 1, "b": [["1", "2"], ["0", "0"]], "a": [["3", "4"]]}
    assert one(spark, "binance", depth) == ("depth", [1, 2, 3, 4], 1_000_000)
    assert one(spark, "binance", {**depth, "b": []}) is None
    kline = {"e": "kline", "E": 9, "k": {"T": 5, "o": "1", "h": "2", "l": "0", "c": "1.5"}}
    assert one(spark, "binance", kline) == ("kline", [1, 2, 0, 1.5, 0], 5_000_000)
    assert one(spark, "binance", {"e": "markPriceUpdate", "E": 2, "p": "5", "r": "0.1"}) == ("markPrice", [5, 0.1], 2_000_000)


def test_request_response(spark):
    trades = {"id": 1, "status": 200, "result": [{"price": "2.5", "qty": "3", "time": 7}]}
    assert one(spark, "binance_ws_api", trades) == ("trades_recent", [2.5, 3.0], 7_000_000)
    assert one(spark, "binance_ws_api", {**trades, "status": 400}) is None
    price = {"status": 200, "result": {"price": "5"}}
    assert one(spark, "binance_ws_api", price, channels=["user_data", "ticker_price"]) == ("ticker_price", [5.0], NOW_NS)
    assert one(spark, "binance_ws_api", price, channels=["other"]) is None
    depth = {"status": 200, "result": {"bids": [["1", "2"]], "asks": [["3", "4"]]}}
    assert one(spark, "binance_ws_api", depth, channels=["depth_snapshot"])[1] == [1, 2, 3, 4]
    report = {"event": {"e": "executionReport", "T": 3, "p": "1", "q": "2"}}
    assert one(spark, "binance_ws_api", report) == ("user_data", [1.0, 2.0], 3_000_000)
    assert one(spark, "binance_ws_api", {"event": None, **trades}) is None


def subscription(**result):
    return {"jsonrpc": "2.0", "method": "eth_subscription", "params": {"subscription": "0x1", "result": result}}


def test_chain(spark):
    block = {"number": "0x10", "timestamp": "0x65", "gasUsed": "0x5208", "baseFeePerGas": "0x3b9aca00"}
    assert one(spark, "alchemy", subscription(**block)) == ("newHeads", [1e9, 21000.0], 101 * 10**9)
    del block["baseFeePerGas"]
    assert one(spark, "infura", subscription(**block))[1] == [21000.0, 21000.0]
    # Text is always hexadecimal, numbers are themselves.
    assert one(spark, "alchemy", subscription(number=1, timestamp="100", gasUsed=100))[1:] == ([100.0, 100.0], 256 * 10**9)
    assert one(spark, "alchemy", subscription(number=1, gasUsed="0x1")) is None
    pending = {"channels": ["pending"]}
    assert one(spark, "alchemy", subscription(hash="0xa", gas="0x2", maxFeePerGas="0x5"), **pending) == ("pending", [5.0, 2.0], NOW_NS)
    assert one(spark, "alchemy", subscription(hash="0xa", gasPrice="0x0", maxPriorityFeePerGas="0x7"), **pending)[1] == [7.0, 21000.0]
    assert one(spark, "alchemy", subscription(hash="0xa"), **pending) is None
    assert one(spark, "alchemy", subscription(hash="0xa", gasPrice="0x5")) is None
    assert one(spark, "alchemy", subscription(**block), **pending) is None
    assert one(spark, "alchemy", {"jsonrpc": "2.0", "id": 1, "result": "0x1"}) is None


def test_invalid_json_is_rejected_and_oversize_is_replaced(spark):
    rows = decode(spark, "kraken", '{"channel":', kraken("trade", TRADE, pad="x" * 400), kraken("trade", TRADE), max_bytes=300)
    assert [(r.error_code, r.raw if r.error_code else None) for r in rows] == [
        (P.PARSE_ERROR, '{"channel":'), (P.OVERSIZE, OVERSIZE_TEXT), (None, None),
    ]


def test_channels():
    assert resolve_channels("kraken", [" book ", ""]) == ["book"]
    assert resolve_channels("Kraken", ["  "]) == ["trade"]
    assert resolve_channels("binance_futures") == ["aggTrade"]
    assert resolve_channels("binance_ws_api") == ["trades_recent"]
    assert resolve_channels("infura", None, "newPendingTransactions") == ["pending"]
    assert resolve_channels("alchemy") == ["newHeads"]
    assert resolve_channels("custom") == []


def test_unknown_provider(spark):
    with pytest.raises(ValueError):
        decode(spark, "nowhere", "{}")


@pytest.mark.parametrize("provider", ["kraken", "binance", "binance_ws_api", "alchemy"])
def test_messages_are_parsed_once_and_not_shuffled(spark, provider):
    df = spark.createDataFrame([("{}",)], "raw string").repartition(2)
    points = decode_feed(df, provider, as_of_ms=NOW).filter("metrics[0] > 0")
    plan = points._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("try_parse_json") == 1
    assert points._jdf.queryExecution().sparkPlan().toString().count("Exchange") == 1


def test_kraken_rows_of_a_message(spark):
    rows = [{**TRADE, "price": p} for p in (1.0, 0.0, 3.0)]
    message = json.dumps({"channel": "trade", "data": rows})
    others = ['{"channel":"trade","data":[]}', '{"channel":"trade","data":{}}', '{"channel":']
    assert [r.metrics[0] for r in decode(spark, "kraken", message)] == [1.0]
    got = decode(spark, "kraken", message, *others, explode_all=True)
    assert sorted(r.metrics[0] for r in got if r.error_code is None) == [1.0, 3.0]
    assert sum(r.error_code is not None for r in got) == 1
