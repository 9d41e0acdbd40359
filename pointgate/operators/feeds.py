"""Exchange and chain feed messages -> points with a feed name.

Each message is parsed once; the shape to read is chosen by its own type field.  Messages of no known shape
(acknowledgements, unused channels, unusable prices) are dropped without notice; invalid JSON is rejected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointgate.functions import json as J
from pointgate.functions import times
from pointgate.functions.numbers import hex_to_decimal_text, is_finite, positive, strict_double
from pointgate.operators import points as P

PROVIDERS = ("kraken", "binance", "binance_futures", "binance_ws_api", "alchemy", "infura")
OVERSIZE_TEXT = "[oversize websocket text frame]"
DEFAULT_PENDING_GAS = 21_000.0

_DOC = "__doc"
_POINT_TYPE = (
    "struct<timestamp_ns:bigint,texts:array<string>,metrics:array<double>,feed:string,all_positive:boolean,"
    "zero_slot:int>"
)


def resolve_channels(
    provider: str, channels: Sequence[str] | None = None, subscription: str | None = None
) -> list[str]:
    """Trimmed non-empty channel names, else the provider's default."""
    named = [c.strip() for c in channels or () if c.strip()]
    if named:
        return named
    # Default channel per provider.
    defaults = {
        "kraken": "trade",
        "binance": "trade",
        "binance_futures": "aggTrade",
        "binance_ws_api": "trades_recent",
        "alchemy": "newHeads",
        "infura": "newHeads",
    }
    provider = provider.lower()
    if provider in ("alchemy", "infura") and subscription in (
        "alchemy_pendingTransactions",
        "newPendingTransactions",
    ):
        return ["pending"]
    return [defaults[provider]] if provider in defaults else []


def _event_ts(now: Column, ms: str) -> Column:
    """Time from a staged column of whole milliseconds."""
    return F.coalesce(times.whole_ms_to_ns(F.col(ms)), now)


def _members(value: str, members: str, path: str = "$") -> Column:
    """Several members of a VARIANT object at once; those of another kind than declared are null."""
    return F.try_variant_get(value, path, f"struct<{members}>")


def _point(
    ts: Column, feed: str, *texts: Column | str, all_positive: bool = False, zero_slot: int = -1
) -> Column:
    """A candidate point with its metrics still as text.

    The message kind only chooses which texts to read; they are turned into numbers in one place for all
    kinds, which keeps the generated code small (the JVM does not compile methods beyond a size).  ``zero_slot`` is the metric that is 0 when unusable.
    """
    slots = [F.col(t) if isinstance(t, str) else t for t in texts]
    return F.struct(
        ts.alias("timestamp_ns"),
        F.array(*slots).alias("texts"),
        F.lit(None).cast("array<double>").alias("metrics"),
        F.lit(feed).alias("feed"),
        F.lit(all_positive).alias("all_positive"),
        F.lit(zero_slot).alias("zero_slot"),
    )


def _number_point(ts: Column, feed: str, *metrics: Column) -> Column:
    """A candidate point whose metrics are numbers already."""
    return F.struct(
        ts.alias("timestamp_ns"),
        F.lit(None).cast("array<string>").alias("texts"),
        F.array(*metrics).alias("metrics"),
        F.lit(feed).alias("feed"),
        F.lit(False).alias("all_positive"),
        F.lit(-1).alias("zero_slot"),
    )


def _metric_stages(from_text: bool) -> list[dict[str, Column]]:
    """Stage ``__metrics`` and ``__usable`` of ``__point``.

    Usable: no metric is missing, the time is known, and trades have a price and a quantity above zero.
    """
    if from_text:
        zero = F.col("__point.zero_slot")
        metrics = F.transform("__point.texts", lambda t, i: F.coalesce(strict_double(t), F.when(i == zero, F.lit(0.0))))
    else:
        metrics = F.col("__point.metrics")
    complete = F.col("__point.timestamp_ns").isNotNull() & F.forall("__metrics", lambda m: m.isNotNull())
    fair = positive(F.get("__metrics", F.lit(0))) & positive(F.get("__metrics", F.lit(1)))
    usable = complete & (~F.col("__point.all_positive") | fair)
    return [{"__metrics": metrics}, {"__usable": F.coalesce(usable, F.lit(False))}]


def _as_text(value: str | Column) -> Column:
    """Text of a VARIANT member."""
    return F.try_variant_get(value, "$", "string")


# What a decoder gives: columns to stage over the parsed document, and the candidate point.
Decoded = tuple[list[dict[str, Column]], Column]


def _kraken(now: Column, ts_path: str | None, explode_all: bool) -> Decoded:
    document = "method variant, channel string, data variant"
    # Only the first element of ``data`` counts, unless all are asked for.  Members whose presence matters are kept
    # as VARIANT.
    row = (
        "price string, qty variant, quantity string, bid string, ask string, last string, volume variant,"
        " bids variant, asks variant, open string, high string, low string, close string"
    )
    kind = F.col("__kind")
    at = "$" if explode_all else "$[0]"
    stages = [
        {"__v": _members(_DOC, document, J.ROOT)},
        {"__kind": F.when(F.col("__v.method").isNull(), F.col("__v.channel")), "__data": F.col("__v.data")},
        *([{"__data": F.explode_outer(F.try_variant_get("__data", "$", "array<variant>"))}] if explode_all else []),
        {"__row": _members("__data", row, at)},
        {
            "__bid": F.when(kind == "book", _members("__row.bids", "price string, qty string", "$[0]")),
            "__ask": F.when(kind == "book", _members("__row.asks", "price string, qty string", "$[0]")),
        },
    ]
    if ts_path is not None:
        stated = F.try_variant_get("__data", f'{at}["{ts_path}"]', "string")
        stages.append({"__now": F.coalesce(times.rfc3339_to_ns(stated), now)})
        now = F.col("__now")
    has_qty, has_volume = F.col("__row.qty").isNotNull(), F.col("__row.volume").isNotNull()
    qty = F.when(has_qty, _as_text("__row.qty")).otherwise(F.col("__row.quantity"))
    quote = ("__row.bid", "__row.ask", "__row.last", _as_text("__row.volume"))
    bar = ("__row.open", "__row.high", "__row.low", "__row.close", _as_text("__row.volume"))
    point = (
        F.when(kind == "trade", _point(now, "trade", "__row.price", qty, all_positive=True))
        .when((kind == "ticker") & has_volume, _point(now, "ticker", *quote, zero_slot=3))
        .when(kind == "book", _point(now, "book", "__bid.price", "__bid.qty", "__ask.price", "__ask.qty"))
        .when((kind == "ohlc") & has_volume, _point(now, "ohlc", *bar, zero_slot=4))
    )
    return stages, point


def _binance(now: Column) -> Decoded:
    # ``E`` and ``T`` are read apart from the other members: names that differ by case only are ambiguous.
    member = "e string, p string, q string, b variant, a variant, c string, v string, r string, k variant"
    kind = F.col("__kind")
    stages = [
        {"__outer": _members(_DOC, "stream variant, data variant", J.ROOT)},
        # Combined streams wrap the message.
        {
            "__inner": F.when(F.col("__outer.stream").isNotNull(), F.col("__outer.data")).otherwise(
                F.try_variant_get(_DOC, J.ROOT, "variant")
            )
        },
        {"__in": _members("__inner", member), "__event": F.try_variant_get("__inner", "$.E", "variant")},
        {"__kind": F.col("__in.e")},
        {
            "__bar": F.when(
                kind == "kline",
                _members("__in.k", "T variant, o string, h string, l string, c string, v string"),
            ),
            "__bid": F.when(kind == "depthUpdate", F.try_variant_get("__in.b", "$[0]", "array<string>")),
            "__ask": F.when(kind == "depthUpdate", F.try_variant_get("__in.a", "$[0]", "array<string>")),
        },
        {"__ms": J.unsigned(F.when(kind == "kline", F.col("__bar.T")).otherwise(F.col("__event")))},
    ]
    ts = _event_ts(now, "__ms")
    quote = (_as_text("__in.b"), _as_text("__in.a"), "__in.c", "__in.v")
    best = [F.get(side, F.lit(i)) for side in ("__bid", "__ask") for i in (0, 1)]
    point = (
        F.when(kind.isin("trade", "aggTrade"), _point(ts, "trade", "__in.p", "__in.q", all_positive=True))
        .when(kind == "24hrTicker", _point(ts, "ticker", *quote, zero_slot=3))
        .when(kind == "depthUpdate", _point(ts, "depth", *best))
        .when(kind == "kline", _point(ts, "kline", *(f"__bar.{m}" for m in "ohlcv"), zero_slot=4))
        .when(kind == "markPriceUpdate", _point(ts, "markPrice", "__in.p", "__in.r", zero_slot=1))
    )
    return stages, point


def _request_response(now: Column, channels: Sequence[str]) -> Decoded:
    """Replies to polling requests, and order reports of the account stream."""
    document = "event variant, status variant, result variant"
    primary = next((c for c in channels if c != "user_data"), "trades_recent")
    is_event = F.col("__event").isNotNull()
    stages = [
        {"__v": _members(_DOC, document, J.ROOT)},
        {"__event": F.col("__v.event"), "__result": F.col("__v.result")},
        {
            "__report": _members("__event", "e string, p string, q string, T variant"),
            "__moment": F.try_variant_get("__event", "$.E", "variant"),
            "__trade": F.when(~is_event, _members("__result", "price string, qty string, time variant", "$[0]")),
        },
        # The second time is used only when the first is absent, not when it is unusable.
        {"__ms": J.unsigned(F.when(is_event, F.coalesce("__moment", "__report.T")).otherwise(F.col("__trade.time")))},
    ]
    ts = _event_ts(now, "__ms")
    report = _point(ts, "user_data", "__report.p", "__report.q", all_positive=True)
    at = lambda path: F.try_variant_get("__result", path, "string")
    if primary == "ticker_price":
        reply = _point(now, primary, at("$.price"))
    elif primary == "trades_recent":
        reply = _point(ts, primary, "__trade.price", "__trade.qty", all_positive=True)
    elif primary == "depth_snapshot":
        reply = _point(now, primary, at("$.bids[0][0]"), at("$.bids[0][1]"), at("$.asks[0][0]"), at("$.asks[0][1]"))
    else:
        reply = F.lit(None)
    point = F.when(is_event, F.when(F.col("__report.e") == "executionReport", report)).otherwise(
        F.when(J.unsigned(F.col("__v.status")) == 200, reply)
    )
    return stages, point


# Where a pending transaction states its price, in order of preference.
PENDING_PRICES = ("gasPrice", "maxFeePerGas", "maxPriorityFeePerGas")


def _chain(now: Column, channels: Sequence[str]) -> Decoded:
    """Block headers (newHeads) and pending transactions of a JSON-RPC subscription."""
    number_keys = ("gasUsed", "baseFeePerGas", "gas", *PENDING_PRICES)
    members = ", ".join(f"{key} variant" for key in ("number", "timestamp", *number_keys))
    document = f"method string, params struct<result struct<{members}>>"
    block = F.col("__block")
    # A header and a transaction need different members; reading them through shared slots keeps the code small.
    slots = ("a", "b", "c", "d")
    header_keys, pending_keys = ("gasUsed", "baseFeePerGas", None, None), (*PENDING_PRICES, "gas")

    def member_of(header: str | None, pending: str) -> Column:
        other = F.col(f"__result.{pending}")
        return F.when(block, F.col(f"__result.{header}")).otherwise(other) if header else F.when(~block, other)

    kind = lambda slot: F.col(f"__type_{slot}")
    text = lambda slot: F.try_variant_get(f"__x_{slot}", "$", "string")
    from_hex = lambda slot: hex_to_decimal_text(text(slot))

    def quantity(slot: str) -> Column:
        """A string is hexadecimal, a JSON number is itself."""
        plain = F.when(J.is_number(kind(slot)), text(slot))
        return F.when(J.is_string(kind(slot)), from_hex(slot)).otherwise(plain).try_cast("double")

    seconds = F.when(J.is_string(kind("time")), from_hex("time").try_cast("bigint"))
    stages = [
        {"__v": _members(_DOC, document, J.ROOT)},
        {"__kind": F.col("__v.method"), "__result": F.col("__v.params.result")},
        {"__block": F.col("__result.number").isNotNull(), "__x_time": F.col("__result.timestamp")},
        {f"__x_{s}": member_of(header, pending) for s, header, pending in zip(slots, header_keys, pending_keys)},
        {f"__type_{slot}": J.value_type(F.col(f"__x_{slot}")) for slot in (*slots, "time")},
        {
            "__seconds": seconds.otherwise(J.unsigned(F.col("__x_time"))),
            **{f"__q_{slot}": quantity(slot) for slot in slots},
        },
    ]

    def usable(slot: str) -> Column:
        value = F.col(f"__q_{slot}")
        return F.when(positive(value) & is_finite(value), value)

    last_second = F.lit(9_223_372_036).cast("bigint")
    capped = F.when(F.col("__seconds") > last_second, last_second).otherwise(F.col("__seconds"))
    gas_used = F.col("__q_a")
    header = _number_point(
        capped * F.lit(1_000_000_000).cast("bigint"), "newHeads", F.coalesce(usable("b"), gas_used), gas_used
    )
    price = F.coalesce(usable("a"), usable("b"), usable("c"))
    pending = _number_point(now, "pending", price, F.coalesce(usable("d"), F.lit(DEFAULT_PENDING_GAS)))
    chosen = F.lit(None)
    if "pending" in channels:
        chosen = F.when(~block, pending)
    if "newHeads" in channels:
        chosen = F.when(block, header).otherwise(chosen)
    return stages, F.when(F.col("__kind") == "eth_subscription", chosen)


def decode_feed(
    df: DataFrame,
    provider: str,
    raw: str = "raw",
    channels: Sequence[str] | None = None,
    subscription: str | None = None,
    as_of_ms: int | None = None,
    ts_path: str | None = None,
    max_bytes: int | None = None,
    explode_all: bool = False,
) -> DataFrame:
    """Raw messages -> points with ``feed``.  Works on batch frames and streams; adds no shuffle.

    ``explode_all`` (kraken only) makes a point of every row of a message, not of its first alone.
    ``ts_path`` (kraken only) names the member of the message row to take the time from, instead of arrival.
    """
    provider = provider.lower()
    if provider not in PROVIDERS:
        raise ValueError(f"unknown provider {provider}; supported: {', '.join(PROVIDERS)}")
    wanted = resolve_channels(provider, channels, subscription)
    now = times.as_of_ns(as_of_ms)
    if provider == "kraken":
        stages, point = _kraken(now, ts_path, explode_all)
    elif provider == "binance_ws_api":
        stages, point = _request_response(now, wanted)
    elif provider in ("alchemy", "infura"):
        stages, point = _chain(now, wanted)
    else:
        stages, point = _binance(now)
    oversize = F.lit(False) if max_bytes is None else F.octet_length(raw) > max_bytes
    text = F.when(~oversize, F.col(raw))
    staged = df.withColumns({"__over": oversize, _DOC: J.parse_document(text)})
    opened = {"__ok": J.is_document(_DOC)}
    metric_stages = _metric_stages(from_text=provider not in ("alchemy", "infura"))
    for stage in [opened, *stages, {"__point": point.cast(_POINT_TYPE)}, *metric_stages]:
        staged = staged.withColumns(stage)
    made = [c for c in staged.columns if c not in df.columns]
    error = F.when(F.col("__over"), F.lit(f"message exceeded {max_bytes} bytes")).when(
        ~F.col("__ok"), F.lit("invalid JSON")
    )
    code = F.when(F.col("__over"), F.lit(P.OVERSIZE)).when(~F.col("__ok"), F.lit(P.PARSE_ERROR))
    return P.with_point(
        staged,
        F.col("__point.timestamp_ns"),
        F.col("__metrics"),
        F.when(F.col("__over"), F.lit(OVERSIZE_TEXT)).otherwise(F.col(raw)),
        feed=F.when(F.col("__ok"), F.col("__point.feed")),
        parse_error=error,
        error_code=code,
        keep=F.col("__over") | ~F.col("__ok") | F.col("__usable"),
        drop=tuple(made),
    )
