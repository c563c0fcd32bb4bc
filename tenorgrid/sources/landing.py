"""Landed JSON to flat tables. Every function takes a table with one JSON text per fetched response."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tenorgrid.functions.fixed import LEG_OUTCOME, OTHER, OUTCOMES
from tenorgrid.functions.text import parse_symbol
from tenorgrid.functions.times import iso_epoch, iso_timestamp, month_contract, month_key
from tenorgrid.functions.values import lookup, no_nan, number
from tenorgrid.operators.classify import classify_questions
from tenorgrid.operators.dedup import dedup_keep_last
from tenorgrid.operators.joins import nearest_match
from tenorgrid.operators.rules import Rule, broken_rules
from tenorgrid.sources import schemas


def _conform(df: DataFrame, schema) -> DataFrame:
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


def unreadable(df: DataFrame, parsed: Column, body: str = "body", rule: str = "unreadable_body") -> DataFrame:
    """Responses whose body does not give the expected list, whole, with the rule they break.

    ``parsed`` is the expression that a ``flatten_*`` explodes; a body that is cut off or no JSON makes it NULL or a
    list with a NULL or empty element, and would otherwise leave without a trace.
    """
    broken = parsed.isNull() | F.exists(parsed, lambda x: x.isNull())
    return df.where(F.coalesce(broken, F.lit(True))).withColumn("rule", F.lit(rule))


def candle_list(body: str = "body") -> Column:
    return F.from_json(F.col(body), schemas.CANDLE_JSON)


def trade_list(body: str = "body") -> Column:
    return F.from_json(F.get_json_object(F.col(body), "$.trades"), schemas.TRADE_JSON)


def history_list(body: str = "body") -> Column:
    return F.from_json(F.get_json_object(F.col(body), "$.history"), schemas.HISTORY_JSON)


def _arrived(df: DataFrame) -> DataFrame:
    """The column ``arrival`` (any ordered type) tells which of several responses came last."""
    return df if "arrival" in df.columns else df.withColumn("arrival", F.lit(0))


def _latest(flat: DataFrame, schema, key: list[str]) -> DataFrame:
    """One row per key, from the latest arrival, ties to the largest row."""
    typed = flat.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields), "arrival")
    return dedup_keep_last(typed, key, ["arrival"]).drop("arrival")


def flatten_candles(df: DataFrame, body: str = "body", venue: str = "a", now: Column | None = None) -> DataFrame:
    """Bars of one response per row (``event_id, market_id, outcome, interval, body``, ``arrival``) to flat bars.

    Nested open/high/low/close objects hold numbers as text; blank means no value. A bar that ends after
    ``now`` is still in progress. Of bars repeated by overlapping requests the latest arrival counts. Bodies that
    do not parse are rows of ``unreadable(df, candle_list())``.
    """
    df = _arrived(df)
    bars = df.select("event_id", "market_id", "outcome", "interval", "arrival", F.explode(candle_list(body)).alias("c"))
    bars = bars.where(F.col("c").isNotNull())
    side = lambda obj, name: number(F.col(f"c.{obj}.{name}_dollars"))
    cols = {"ts": F.col("c.end_period_ts"), "vol": number("c.volume_fp"), "oi": number("c.open_interest_fp"),
            "venue": F.lit(venue), "is_partial": F.col("c.end_period_ts") > (
                now if now is not None else F.unix_seconds(F.current_timestamp()))}
    for prefix, obj, names in (("bid", "yes_bid", "open high low close"), ("ask", "yes_ask", "open high low close"),
                               ("price", "price", "open high low close mean previous")):
        cols |= {f"{prefix}_{n}": side(obj, n) for n in names.split()}
    return _latest(bars.withColumns(cols), schemas.QUOTE_BARS, ["market_id", "interval", "ts"])


def flatten_trades(df: DataFrame, body: str = "body", venue: str = "a") -> DataFrame:
    """Trades of one page per row (``event_id, market_id, outcome, body``, ``arrival``), once per trade id, as it
    came last. Bodies that do not parse are rows of ``unreadable(df, trade_list())``.
    """
    rows = _arrived(df).select("event_id", "market_id", "outcome", "arrival", F.explode(trade_list(body)).alias("t"))
    rows = rows.where(F.col("t").isNotNull())
    at = iso_timestamp("t.created_time")
    flat = rows.select(
        F.lit(venue).alias("venue"), "event_id", "market_id", "outcome", F.unix_seconds(at).alias("ts"),
        F.unix_micros(at).alias("ts_us"), "t.created_time", "t.trade_id", number("t.count_fp").alias("count"),
        "t.taker_side", "t.taker_book_side", number("t.yes_price_dollars").alias("yes_price"),
        number("t.no_price_dollars").alias("no_price"),
        F.coalesce("t.is_block_trade", F.lit(False)).alias("is_block_trade"), "arrival")
    return _latest(flat, schemas.TRADES, ["trade_id"])


def flatten_markets(df: DataFrame, body: str = "body", venue: str = "a", now: Column | None = None) -> DataFrame:
    """Market metadata (``series_ticker, leg, series_body, body``) to one wide row per market.

    A body without a market ticker gives no market; it is a row of ``unreadable_markets(df)``.
    """
    parsed = df.withColumn("m", F.from_json(F.col(body), schemas.MARKET_JSON)).where(F.col("m.ticker").isNotNull())
    m = lambda name: F.col(f"m.{name}")
    series = lambda name: F.get_json_object("series_body", f"$.{name}")
    numbers = {"floor_strike": "floor_strike", "cap_strike": "cap_strike", "settlement_value": "settlement_value_dollars",
               "volume_fp": "volume_fp", "volume_24h_fp": "volume_24h_fp", "open_interest_fp": "open_interest_fp",
               "liquidity_dollars": "liquidity_dollars", "last_price": "last_price_dollars", "yes_bid": "yes_bid_dollars",
               "yes_ask": "yes_ask_dollars"}
    cols = {
        "venue": F.lit(venue), "event_id": m("event_ticker"), "market_id": m("ticker"),
        "outcome": lookup("leg", LEG_OUTCOME, OTHER), "ts": iso_epoch(m("open_time")),
        "subtitle": F.coalesce(F.nullif(m("subtitle"), F.lit("")), m("yes_sub_title")),
        "custom_strike": F.get_json_object(F.col(body), "$.custom_strike"),
        "tick_size": number(F.get(m("price_ranges"), 0)["step"]),
        "fee_type": series("fee_type"), "fee_multiplier": number(series("fee_multiplier")),
        "series_frequency": series("frequency"), "series_title": series("title"),
        "contract_terms_url": series("contract_terms_url"), "settlement_sources": series("settlement_sources"),
        "snapshot_ts": now if now is not None else F.unix_seconds(F.current_timestamp()),
        **{out: number(m(src)) for out, src in numbers.items()},
    }
    made = {*cols, "series_ticker", "leg"}
    cols |= {f.name: m(f.name) for f in schemas.LADDER_MARKETS.fields if f.name not in made}
    return _conform(parsed.withColumns(cols), schemas.LADDER_MARKETS)


def unreadable_markets(df: DataFrame, body: str = "body") -> DataFrame:
    """Market responses without a ticker, whole."""
    ticker = F.from_json(F.col(body), schemas.MARKET_JSON)["ticker"]
    return df.where(ticker.isNull()).withColumn("rule", F.lit("unreadable_body"))


def flatten_history(df: DataFrame, body: str = "body", venue: str = "b") -> DataFrame:
    """Price history of one response per row (``event_id, market_id, token_id, outcome, outcome_label,
    fidelity, body``, ``arrival``) to points; the latest response wins where two hold the same point. Bodies that do
    not parse are rows of ``unreadable(df, history_list())``.
    """
    points = _arrived(df).select("event_id", "market_id", "token_id", "outcome", "outcome_label", "fidelity", "arrival",
                                 F.explode(history_list(body)).alias("h")).where(F.col("h").isNotNull())
    flat = points.select("*", F.lit(venue).alias("venue"), F.col("h.t").alias("ts"), F.col("h.p").alias("p"))
    return _latest(flat, schemas.POINTS, ["token_id", "fidelity", "ts"])


def _text_array(c: Column) -> Column:
    """JSON text inside JSON; missing text is an empty list."""
    return F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))


def event_body(schema: str, body: str = "body") -> Column:
    """An event's JSON; NULL where the text is no JSON, is cut off, or has no list of markets. The text is parsed once."""
    corrupt = "_corrupt_record"
    whole = F.from_json(F.col(body), schema.removesuffix(">") + f",{corrupt}:string>", {"columnNameOfCorruptRecord": corrupt})
    return F.get(F.filter(F.array(whole), lambda w: w[corrupt].isNull() & w["markets"].isNotNull()), F.lit(0))


def unreadable_events(df: DataFrame, schema: str = schemas.EVENT_JSON, body: str = "body") -> DataFrame:
    """Event responses that give no list of markets, whole."""
    return df.where(event_body(schema, body).isNull()).withColumn("rule", F.lit("unreadable_body"))


def match_events(inventory: DataFrame, venue_events: DataFrame, calendar: DataFrame, decision: str, tol_days: int = 8) -> DataFrame:
    """Event inventory (``event_id, body``, ``arrival``) and the venue's own event records (the same columns) to one row
    per market, in its place of the event, with the venue record it takes; an event without markets is one row.

    Of several responses for an event the one that arrived last counts. The two nested lists meet inside the event: one
    join of events, then a market takes the first venue record with the same token list, otherwise the first with the
    same question text, and each row carries its own record alone. The decision is the calendar entry within
    ``tol_days`` of the event's end.
    """
    last = lambda df, name: _arrived(df).groupBy("event_id").agg(F.max_by("body", "arrival").alias(name))
    ev = last(inventory, "body").select("event_id", event_body(schemas.EVENT_JSON).alias("e"))
    ven = last(venue_events, "body").select("event_id", event_body(schemas.VENUE_EVENT_JSON).alias("g"))
    both = ev.join(ven.withColumn("has_body", F.lit(True)), "event_id", "left")
    text = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    records = F.coalesce("g.markets", F.array().cast(f"array<{schemas.VENUE_MARKET_JSON}>"))
    # All texts are read here, once a market and once a record; what is per event is taken before the markets part, so
    # that no market carries the lists of its event.
    both = both.select(
        "event_id", F.col("e.title").alias("event_title"), F.col("e.start").alias("start_date"), F.col("e.end").alias("event_end"),
        F.col("e.closed").alias("event_closed"), F.col("g.id").alias("venue_event_id"), F.col("g.negRisk").alias("neg"),
        F.col("g.resolutionSource").alias("event_source"), F.size(records).alias("n_records"),
        (F.col("has_body").isNotNull() & F.col("g").isNull()).alias("venue_unreadable"), records.alias("records"),
        F.transform(records, lambda r: _text_array(r["clobTokenIds"])).alias("record_toks"), F.transform(records, lambda r: text(r["question"])).alias("record_qs"),
        F.transform("e.markets", lambda m: F.struct(m.alias("m"), _text_array(m["tokens"]).alias("toks"), _text_array(m["outcomes"]).alias("outs"),
                                                    text(m["q"]).alias("q"))).alias("markets"))

    def place(x: Column, i: Column) -> Column:
        at = lambda found: F.nullif(found, F.lit(0).cast("bigint"))
        same = F.when(F.size(x["toks"]) > 0, at(F.array_position("record_toks", x["toks"])))
        first = F.coalesce(same, at(F.array_position("record_qs", x["q"])))
        return F.struct(i.alias("idx"), x["m"].alias("m"), x["toks"].alias("toks"), x["outs"].alias("outs"),
                        F.get("records", first.cast("int") - 1).alias("r"))

    # An event without markets is one NULL place, an unreadable one has none and leaves.
    places = F.transform("markets", place)
    rows = both.select(*(c for c in both.columns if c not in ("records", "record_toks", "record_qs", "markets")),
                       F.explode(F.when(F.size("markets") == 0, F.array(F.get(places, F.lit(0)))).otherwise(places)).alias("x"))
    rows = rows.select("*", "x.*").drop("x").withColumn("question", F.col("m.q"))
    rows = classify_questions(rows, "question").withColumns({
        "own_toks": F.col("toks"),
        "toks": F.when(F.size("toks") > 0, F.col("toks")).otherwise(_text_array(F.col("r.clobTokenIds"))),
        "outs": F.when(F.size("outs") > 0, F.col("outs")).otherwise(_text_array(F.col("r.outcomes"))),
        "condition_id": F.nullif("r.conditionId", F.lit("")),
        "event_day": F.substring("event_end", 1, 10).try_cast("date")})
    rows = rows.withColumn("market_id", F.coalesce("condition_id", F.concat_ws("#", "event_id", "idx")))
    return nearest_match(rows, "event_day", calendar, decision, tol_days, "decision")


def event_markets(matched: DataFrame, venue: str = "b") -> DataFrame:
    """The markets of ``match_events`` in the shared schema.

    Token ids and labels come from the inventory, or from the venue record when they are missing there. A market
    without a condition id is named by event and position.
    """
    token = lambda label: F.coalesce(
        F.get("toks", F.nullif(F.array_position("outs", label), F.lit(0)).cast("int") - 1), F.lit(""))
    end = F.coalesce(F.nullif("m.end", F.lit("")), F.nullif("event_end", F.lit("")))
    blank = lambda c: F.coalesce(c, F.lit(""))
    flat = matched.where("idx IS NOT NULL").select(
        F.lit(venue).alias("venue"), "event_id", "market_id",
        "outcome", F.col("detail").alias("outcome_detail"), blank("note").alias("mapping_note"),
        F.coalesce(iso_epoch(end), F.lit(-1)).alias("ts"), "question", blank("event_title").alias("event_title"),
        F.to_json("outs").alias("outcomes"), F.to_json("toks").alias("token_ids"), token("Yes").alias("yes_token_id"),
        token("No").alias("no_token_id"), blank("start_date").alias("start_date"), blank(end).alias("end_date"),
        blank("r.closedTime").alias("closed_time"), F.col("decision").cast("string").alias("decision_date"),
        F.coalesce("m.closed", F.lit(False)).alias("closed"), F.coalesce("event_closed", F.lit(False)).alias("event_closed"),
        F.col("m.vol").alias("volume"), F.col("r.volumeNum").alias("venue_volume"),
        F.col("r.liquidityNum").alias("venue_liquidity"), F.col("r.enableOrderBook").alias("enable_order_book"),
        (F.coalesce("neg", F.lit(False)) | F.coalesce("r.negRisk", F.lit(False))).alias("neg_risk"),
        F.to_json(_text_array(F.col("r.outcomePrices"))).alias("final_outcome_prices"),
        blank("r.description").alias("description"), blank("venue_event_id").alias("venue_event_id"), blank("r.id").alias("venue_market_id"),
        blank("r.slug").alias("market_slug"), blank("condition_id").alias("condition_id"), blank("r.questionID").alias("question_id"),
        blank("r.startDate").alias("venue_start_date"), blank("r.endDate").alias("venue_end_date"),
        blank("r.umaResolutionStatus").alias("resolution_status"),
        F.coalesce(F.nullif("r.resolutionSource", F.lit("")), F.nullif("event_source", F.lit("")), F.lit("")).alias("resolution_source"))
    return _conform(flat, schemas.POINT_MARKETS)


def flatten_events(inventory: DataFrame, venue_events: DataFrame, calendar: DataFrame, decision: str,
                   venue: str = "b", tol_days: int = 8) -> DataFrame:
    """Event inventory and venue records to one row per market; see ``match_events`` and ``event_markets``."""
    return event_markets(match_events(inventory, venue_events, calendar, decision, tol_days), venue)


def event_anomalies(matched: DataFrame) -> DataFrame:
    """What the landing of ``match_events`` found wanting, as (``check``, ``key``, ``detail``), from one pass over it."""
    col = F.col
    event, market = F.coalesce("idx", F.lit(0)) == 0, col("idx").isNotNull()
    blank = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("")) == ""
    day = lambda c: F.substring(c, 1, 10)
    return broken_rules(matched, [
        Rule("event start is empty", event & blank(col("start_date")), col("event_id"), col("event_end")),
        Rule("no decision near the end", event & col("decision").isNull(), col("event_id"), col("event_end")),
        Rule("event without markets", col("idx").isNull(), col("event_id")),
        Rule("venue record unreadable", event & col("venue_unreadable"), col("event_id")),
        Rule("no matching venue record", market & col("r").isNull() & (col("n_records") > 0), col("market_id"), col("question")),
        Rule("tokens recovered", market & (F.size("own_toks") == 0) & (F.size("toks") > 0), col("market_id"), col("question")),
        Rule("tokens missing", market & (F.size("toks") == 0), col("market_id"), col("question")),
        Rule("question not mapped", market & (col("detail") == "UNMAPPED"), col("market_id"), col("question")),
        Rule("no condition id", market & col("condition_id").isNull(), col("market_id"), col("question")),
        Rule("no Yes label", market & ~F.array_contains("outs", "Yes"), col("market_id"), F.to_json("outs")),
        Rule("market end differs", market & ~blank(col("m.end")) & (day("m.end") != day("event_end")), col("market_id"), col("m.end")),
    ])


def token_plan(markets: DataFrame) -> DataFrame:
    """Tokens to collect per market: always Yes, No for canonical outcomes, all when there is no Yes."""
    from tenorgrid.operators.sets import keep_collectable, unnest_zip

    arrays = markets.select("event_id", "market_id", "outcome", _text_array(F.col("token_ids")).alias("toks"),
                            _text_array(F.col("outcomes")).alias("outs")).withColumn("all_labels", F.col("outs"))
    rows = unnest_zip(arrays, "toks", "outs", "token_id", "label")
    keep = keep_collectable(F.col("all_labels"), F.col("label"), F.col("outcome").isin(*OUTCOMES))
    return rows.where(keep).select("event_id", "market_id", "token_id", "outcome", "label")


def normalise_bars(df: DataFrame, symbol: str, venue: str = "c", date: str = "date") -> DataFrame:
    """Daily open/high/low/close/volume bars of any symbol to the shared futures schema.

    The settlement is the close, open interest is unknown, NaN becomes NULL. A continuous symbol takes the
    contract of each bar's calendar month.
    """
    d = F.col(date)
    s = df.withColumn("__s", parse_symbol(symbol))
    delivery = F.col("__s.delivery_month")
    ohlc = {n: no_nan(F.col(n).cast("double")) for n in ("open", "high", "low", "close")}
    flat = s.withColumns({
        **ohlc, "venue": F.lit(venue), "event_id": F.coalesce(delivery, month_key(d)),
        "market_id": F.col("__s.contract"), "outcome": F.lit(OTHER), "ts": F.unix_date(d).cast("bigint") * 86400,
        "date": d, "contract": F.col("__s.contract"), "source_symbol": F.col(symbol), "product": F.col("__s.product"),
        "delivery_month": delivery,
        "front_contract_est": F.when(delivery.isNull(), month_contract(d, F.col("__s.product"))),
        "settle": no_nan(F.col("close").cast("double")), "volume": no_nan(F.col("volume").cast("double")).cast("bigint"),
        "open_interest": F.lit(None),
    })
    return _conform(flat, schemas.FUTURES_BARS)
