"""Explicit schemas; readers never infer."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "smallint": T.ShortType(),
    "double": T.DoubleType(), "float": T.FloatType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "timestamp": T.TimestampType(), "array<string>": T.ArrayType(T.StringType()),
    "array<float>": T.ArrayType(T.FloatType()),
}


def fields(**columns: str) -> T.StructType:
    """``fields(double="a b", string="c")`` -> struct in the order given."""
    return T.StructType([T.StructField(n, _TYPES[t]) for t, names in columns.items() for n in names.split()])


def ordered(spec: str) -> T.StructType:
    """``"a string, b double"`` -> struct."""
    pairs = (part.split() for part in spec.split(","))
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in pairs])


KEYS = "venue string, event_id string, market_id string, outcome string, ts bigint"

QUOTE_BARS = ordered(
    f"{KEYS}, interval int, bid_close double, ask_close double, price_close double, vol double, oi double, "
    "bid_open double, bid_high double, bid_low double, ask_open double, ask_high double, ask_low double, "
    "price_open double, price_high double, price_low double, price_mean double, price_previous double, "
    "is_partial boolean")

TRADES = ordered(
    f"{KEYS}, ts_us bigint, created_time string, trade_id string, count double, taker_side string, "
    "taker_book_side string, yes_price double, no_price double, is_block_trade boolean")

LADDER_MARKETS = ordered(
    f"{KEYS}, ticker string, event_ticker string, series_ticker string, leg string, title string, subtitle string, "
    "expiration_value string, market_type string, strike_type string, custom_strike string, floor_strike double, "
    "cap_strike double, status string, result string, created_time string, open_time string, close_time string, "
    "expected_expiration_time string, expiration_time string, latest_expiration_time string, settlement_ts string, "
    "occurrence_datetime string, settlement_value double, settlement_timer_seconds bigint, can_close_early boolean, "
    "early_close_condition string, rules_primary string, rules_secondary string, price_level_structure string, "
    "tick_size double, volume_fp double, volume_24h_fp double, open_interest_fp double, liquidity_dollars double, "
    "last_price double, yes_bid double, yes_ask double, fee_type string, fee_multiplier double, "
    "series_frequency string, series_title string, contract_terms_url string, settlement_sources string, "
    "snapshot_ts bigint")

POINTS = ordered(
    "venue string, event_id string, market_id string, token_id string, outcome string, outcome_label string, "
    "ts bigint, p double, fidelity smallint")

POINT_MARKETS = ordered(
    "venue string, event_id string, market_id string, outcome string, outcome_detail string, mapping_note string, "
    "ts bigint, question string, event_title string, outcomes string, token_ids string, yes_token_id string, "
    "no_token_id string, start_date string, end_date string, closed_time string, decision_date string, "
    "closed boolean, event_closed boolean, volume double, venue_volume double, venue_liquidity double, "
    "enable_order_book boolean, neg_risk boolean, final_outcome_prices string, description string, "
    "venue_event_id string, venue_market_id string, market_slug string, condition_id string, question_id string, "
    "venue_start_date string, venue_end_date string, resolution_status string, resolution_source string")

FUTURES_BARS = ordered(
    f"{KEYS}, date date, contract string, source_symbol string, product string, delivery_month string, "
    "front_contract_est string, open double, high double, low double, close double, settle double, volume bigint, "
    "open_interest bigint")

RATES = ordered(f"{KEYS}, date date, series_id string, value double")

SETTLEMENT_FEED = ordered(
    "trade_date date, symbol string, price double, stat_flags int, instrument_id bigint, ts_recv timestamp")

SPINE = ordered(
    "meeting_date date, meeting_month string, ladder_event string, ladder_status string, ladder_close string, "
    "ladder_result_outcome string, point_events array<string>, point_events_decision array<string>, "
    "point_events_other array<string>, contract_symbol string, contract_source string, "
    "contract_source_symbol string, contract_data_available boolean, effective_date date, month_end date, "
    "days_in_month int, days_post int, delta double, realized_change_bp int, realized_outcome string")

# Nested shapes of landed JSON.
QUOTE_SIDE = "struct<open_dollars:string,high_dollars:string,low_dollars:string,close_dollars:string>"
PRICE_SIDE = ("struct<open_dollars:string,high_dollars:string,low_dollars:string,close_dollars:string,"
              "mean_dollars:string,previous_dollars:string>")
CANDLE_JSON = (f"array<struct<end_period_ts:bigint,yes_bid:{QUOTE_SIDE},yes_ask:{QUOTE_SIDE},price:{PRICE_SIDE},"
               "volume_fp:string,open_interest_fp:string>>")
TRADE_JSON = ("array<struct<trade_id:string,created_time:string,count_fp:string,taker_side:string,"
              "taker_book_side:string,yes_price_dollars:string,no_price_dollars:string,is_block_trade:boolean>>")
MARKET_JSON = (
    "struct<ticker:string,event_ticker:string,title:string,subtitle:string,yes_sub_title:string,"
    "expiration_value:string,market_type:string,strike_type:string,custom_strike:variant,floor_strike:string,"
    "cap_strike:string,status:string,result:string,created_time:string,open_time:string,close_time:string,"
    "expected_expiration_time:string,expiration_time:string,latest_expiration_time:string,settlement_ts:string,"
    "occurrence_datetime:string,settlement_value_dollars:string,settlement_timer_seconds:bigint,"
    "can_close_early:boolean,early_close_condition:string,rules_primary:string,rules_secondary:string,"
    "price_level_structure:string,price_ranges:array<struct<start:string,end:string,step:string>>,"
    "volume_fp:string,volume_24h_fp:string,open_interest_fp:string,liquidity_dollars:string,"
    "last_price_dollars:string,yes_bid_dollars:string,yes_ask_dollars:string>")
HISTORY_JSON = "array<struct<t:bigint,p:double>>"
EVENT_MARKET_JSON = ("struct<q:string,tokens:string,outcomes:string,end:string,closed:boolean,vol:double>")
EVENT_JSON = (f"struct<title:string,start:string,end:string,closed:boolean,markets:array<{EVENT_MARKET_JSON}>>")
VENUE_MARKET_JSON = (
    "struct<id:string,slug:string,conditionId:string,questionID:string,question:string,clobTokenIds:string,"
    "outcomes:string,outcomePrices:string,startDate:string,endDate:string,closedTime:string,volumeNum:double,"
    "liquidityNum:double,enableOrderBook:boolean,negRisk:boolean,umaResolutionStatus:string,"
    "resolutionSource:string,description:string>")
VENUE_EVENT_JSON = f"struct<id:string,negRisk:boolean,resolutionSource:string,markets:array<{VENUE_MARKET_JSON}>>"

# Tables the registered queries run on.
TEST_TABLES = {
    "region": ordered("r_regionkey int, r_name string"),
    "nation": ordered("n_nationkey int, n_name string, n_regionkey int"),
    "customer": ordered("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    "supplier": ordered("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    "part": ordered("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
    "orders": ordered("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                      "o_orderdate timestamp, o_orderpriority string"),
    "lineitem": ordered("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                        "l_linestatus string, l_shipdate timestamp"),
    "events": ordered("event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"),
    "documents": ordered("doc_id bigint, text string, lang string, source string, n_chars bigint"),
    "embeddings": ordered("vec_id bigint, embedding array<float>, label int"),
    "pages": ordered("page_id bigint, url string, html string"),
    "benchmark": ordered("item_id bigint, text string"),
    "labels": ordered("doc_id bigint, quality int, toxic int"),
    "conversations": ordered("conv_id bigint, turn bigint, role string, text string"),
}
