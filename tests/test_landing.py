"""Landed JSON, CSV and feeds to typed tables."""

import json

from pyspark.sql import functions as F

from tenorgrid.functions.text import event_month, parse_symbol
from tenorgrid.operators.classify import classify_questions
from tenorgrid.plans.futures import decade_counts, futures_bars, settlement_outrights
from tenorgrid.plans.ladder import quote_bars
from tenorgrid.sources.landing import (candle_list, flatten_candles, flatten_events, flatten_history, flatten_markets,
                                       flatten_trades, history_list, normalise_bars, token_plan, trade_list, unreadable,
                                       unreadable_markets)
from tenorgrid.sources.readers import (assemble_parts, manifest_value, read_series_csv, read_union_by_name,
                                       series_header_check, unreadable_dates)
from tenorgrid.sources.schemas import POINTS, RATES, ordered
from tenorgrid.sources.sinks import materialise, named_table_counts, register_views, write_sorted
from tests.helpers import d, epoch, order, rows


def test_candles(spark):
    bar = lambda ts, close: {"end_period_ts": ts, "yes_bid": {"open_dollars": "0.10", "close_dollars": close}, "yes_ask": {"close_dollars": "0.9900"},
                             "price": {"close_dollars": "", "mean_dollars": None}, "volume_fp": "12.00", "open_interest_fp": "x"}
    body = json.dumps([bar(100, "0.0000"), bar(200, "0.5000"), bar(200, "0.5000")])
    df = spark.createDataFrame([("E", "E-H0", "HOLD", 1440, body), ("E", "E-H0", "HOLD", 1440, json.dumps([bar(200, "0.5000")]))],
                               "event_id string, market_id string, outcome string, interval int, body string")
    out = flatten_candles(df, now=F.lit(150))
    assert rows(out, "ts", "bid_open", "bid_close", "ask_close", "price_close", "vol", "oi", "is_partial") == [
        (100, 0.1, 0.0, 0.99, None, 12.0, None, False), (200, 0.1, 0.5, 0.99, None, 12.0, None, True)]
    assert rows(quote_bars(out), "ts", "mid") == [(100, None), (200, 0.745)]


def test_trades(spark):
    page = {"trades": [{"trade_id": "t1", "created_time": "2026-09-15T13:58:59.123456Z", "count_fp": "3.00", "yes_price_dollars": "0.87",
                        "no_price_dollars": "0.13", "taker_side": "yes"}], "cursor": "c"}
    df = spark.createDataFrame([("E", "M", "HOLD", json.dumps(page))] * 2, "event_id string, market_id string, outcome string, body string")
    out = flatten_trades(df)
    s = epoch("2026-09-15T13:58:59")
    assert rows(out, "trade_id", "ts", "ts_us", "count", "is_block_trade", "taker_book_side") == [("t1", s, s * 10**6 + 123456, 3.0, False, None)]


def test_markets(spark):
    m = {"ticker": "E-H25", "event_ticker": "E", "open_time": "2026-01-01T00:00:00Z", "subtitle": "", "yes_sub_title": "Hike 25",
         "custom_strike": {"a": 1}, "cap_strike": "0.25", "price_ranges": [{"start": "0", "end": "1", "step": "0.0100"}], "can_close_early": True}
    bare = {"ticker": "E-X", "event_ticker": "E", "price_ranges": []}
    df = spark.createDataFrame([("S", "H25", json.dumps({"fee_type": "q", "fee_multiplier": 1, "settlement_sources": [{"n": 1}]}), json.dumps(m)),
                                ("S", "ZZ", "{}", json.dumps(bare))], "series_ticker string, leg string, series_body string, body string")
    out = flatten_markets(df, now=F.lit(7))
    assert rows(out, "market_id", "outcome", "subtitle", "custom_strike", "cap_strike", "tick_size", "fee_multiplier", "settlement_sources", "snapshot_ts") == sorted([
        ("E-H25", "HIKE25", "Hike 25", '{"a":1}', 0.25, 0.01, 1.0, '[{"n":1}]', 7), ("E-X", "OTHER", None, None, None, None, None, None, 7)], key=order)


def test_history(spark):
    df = spark.createDataFrame([("e", "m", "t", "HOLD", "Yes", 60, json.dumps({"history": [{"t": 10, "p": 0.5}, {"t": 20, "p": 0.6}]}))],
                               "event_id string, market_id string, token_id string, outcome string, outcome_label string, fidelity int, body string")
    out = flatten_history(df)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in POINTS] and rows(out, "ts", "p", "fidelity") == [(10, 0.5, 60), (20, 0.6, 60)]


HISTORY = "event_id string, market_id string, token_id string, outcome string, outcome_label string, fidelity int, body string, arrival int"


def test_latest_arrival_wins_in_either_order(spark):
    body = lambda p: json.dumps({"history": [{"t": 10, "p": p}]})
    row = lambda p, n: ("e", "m", "t", "HOLD", "Yes", 60, body(p), n)
    for order_ in ([row(0.1, 1), row(0.9, 2)], [row(0.9, 2), row(0.1, 1)]):
        assert rows(flatten_history(spark.createDataFrame(order_, HISTORY)), "ts", "p") == [(10, 0.9)]


def test_unreadable_bodies_are_accounted_for(spark):
    good, cut, bad = json.dumps({"history": [{"t": 10, "p": 0.5}]}), '{"history": [{"t": 10, "p": 0.', "<html>"
    df = spark.createDataFrame([("e", "m", "t", "HOLD", "Yes", 60, b, i) for i, b in enumerate([good, cut, bad, None])], HISTORY)
    assert flatten_history(df).count() == 1
    assert rows(unreadable(df, history_list()), "arrival", "rule") == [(i, "unreadable_body") for i in (1, 2, 3)]
    trades = df.withColumn("body", F.regexp_replace("body", "history", "trades"))
    assert rows(unreadable(trades, trade_list()), "arrival") == [(1,), (2,), (3,)]
    candles = spark.createDataFrame([("[]",), ('[{"end_period_ts": 1}]',), ('[{"end_per',), (None,)], "body string")
    assert rows(unreadable(candles, candle_list()), "body") == [('[{"end_per',), (None,)]
    markets = spark.createDataFrame([("S", "H25", "{}", b) for b in ('{"ticker": "T"}', '{"tick', "x", None)],
                                    "series_ticker string, leg string, series_body string, body string")
    assert flatten_markets(markets).count() == 1 and unreadable_markets(markets).count() == 3


def test_undecided_decades_are_counted(spark):
    feed = spark.createDataFrame([(d("2022-01-03"), "ZQF2", 99.0, 1, "2022-01-03 20:00:00"), (d("2022-01-03"), "ZQG7", 95.0, 5, "2022-01-03 20:00:00")],
                                 "trade_date date, symbol string, price double, instrument_id bigint, r string").withColumn(
        "ts_recv", F.col("r").cast("timestamp")).drop("r")
    assert rows(decade_counts(feed), "n_decades", "n_rows") == [(0, 1), (1, 1)]
    assert settlement_outrights(feed).count() == 1


def test_events_and_token_plan(spark):
    inventory = {"title": "Fed decision in March?", "start": "2026-01-02", "end": "2026-03-20T00:00:00Z", "closed": True, "markets": [
        {"q": "Fed decreases interest rates by 25 bps?", "tokens": '["1","2"]', "outcomes": '["Yes","No"]', "end": None, "closed": True, "vol": 5.5},
        {"q": " No change? ", "tokens": None, "outcomes": None, "end": "2026-03-18", "closed": False, "vol": None},
        {"q": "Who is favored for Fed decision?", "tokens": '["7","8"]', "outcomes": '["Cut"]', "end": None, "closed": None, "vol": 1}]}
    venue = {"id": 9, "negRisk": True, "markets": [
        {"question": "other text", "conditionId": "0xa", "clobTokenIds": '["1","2"]', "outcomePrices": '["1","0"]', "volumeNum": 6, "description": "x" * 2500},
        {"question": "no change?", "conditionId": "0xb", "clobTokenIds": '["3","4"]', "outcomes": '["Yes","No"]'}]}
    inv = spark.createDataFrame([("ev", json.dumps(inventory))], "event_id string, body string")
    ven = spark.createDataFrame([("ev", json.dumps(venue))], "event_id string, body string")
    cal = spark.createDataFrame([(d("2026-03-18"),), (d("2026-04-29"),)], "meeting_date date")
    out = flatten_events(inv, ven, cal, "meeting_date")
    assert rows(out, "market_id", "outcome", "token_ids", "yes_token_id", "no_token_id", "decision_date", "volume", "venue_volume", "neg_risk", "closed") == sorted([
        ("0xa", "CUT25", '["1","2"]', "1", "2", "2026-03-18", 5.5, 6.0, True, True),
        ("0xb", "HOLD", '["3","4"]', "3", "4", "2026-03-18", None, None, True, False),
        ("ev#2", "OTHER", '["7","8"]', "", "", "2026-03-18", 1.0, None, True, False)], key=order)  # the event's own mark
    first = out.where("market_id = '0xa'").first()
    assert len(first.description) == 2500 and first.ts == epoch("2026-03-20T00:00:00") and first.question == inventory["markets"][0]["q"]
    assert rows(token_plan(out), "market_id", "token_id", "label") == sorted([
        ("0xa", "1", "Yes"), ("0xa", "2", "No"), ("0xb", "3", "Yes"), ("0xb", "4", "No"), ("ev#2", "7", "Cut"), ("ev#2", "8", "idx1")], key=order)


def test_classify(spark):
    cases = {
        "Will there be no change in rates?": ("HOLD", "HOLD"),
        "Fed raises interest rates by 0 bps?": ("HOLD", "HOLD_0BP"),
        "Fed increases interest rates by 25+ bps?": ("HIKE50P", "HIKE25P"),
        "Fed decreases interest rates by 25+ bps?": ("OTHER", "CUT25P"),
        "Fed decreases interest rates by 75+ bps?": ("CUT50P", "CUT75P"),
        "Fed cuts by 10 bp?": ("OTHER", "CUT10"),
        "Fed hikes rates by 30 bps?": ("OTHER", "HIKE30"),
        "Fed hikes rates by 100 bps?": ("HIKE50P", "HIKE100"),
        "Fed lowers rates by 25 bps?": ("CUT25", "CUT25"),
        "Will Waller dissent?": ("OTHER", "DISSENT_INDIVIDUAL"),
        "FOMC decision result in a 25bp cut with ≤2 dissents?": ("OTHER", "COMBO_CUT25_DISSENT<=2"),
        "FOMC decision result in no change?": ("OTHER", "COMBO_HOLD"),
        "FOMC decision result in chaos?": ("OTHER", "COMBO_UNK"),
        "Cut–Pause—Hike in the next three decisions?": ("OTHER", "PATH_CUT_PAUSE_HIKE"),
        "Will the Fed decide differently?": ("OTHER", "PATH_OTHER"),
        "What is favored for Fed decision?": ("OTHER", "ODDS_FAVORED_2WAY"),
        "Fed change rates to another level?": ("OTHER", "CATCHALL_OTHER_LEVEL"),
        "Fed set interest rates above 4.25% (75 bps or more)?": ("OTHER", "THRESHOLD_ABOVE_4.25PCT_HIKE_GE75"),
        "What happens?": ("OTHER", "UNMAPPED"),
    }
    df = spark.createDataFrame([(q,) for q in cases] + [(None,)], "q string")
    got = {r.q: (r.outcome, r.detail) for r in classify_questions(df, "q").collect()}
    assert got == {**cases, None: (None, None)}


def test_symbols_and_tickers(spark):
    s = spark.createDataFrame([("ZQU26.CBT",), ("ZQ=F",), ("SR1V26.CME",)], "s string")
    assert rows(s.select("s", parse_symbol("s").alias("p")).select("s", "p.*"), "s", "product", "contract", "delivery_month") == [
        ("SR1V26.CME", "SR1", "SR1V26", "2026-10"), ("ZQ=F", "ZQ", "ZQ=F", None), ("ZQU26.CBT", "ZQ", "ZQU26", "2026-09")]
    e = spark.createDataFrame([("KXFEDDECISION-26OCT",), ("FEDDECISION-24MAR20",), ("FEDDECISION-24XXX",), ("OTHER-1",)], "e string")
    assert rows(e.select("e", event_month("e").alias("m")).select("e", "m.*"), "e", "ym", "day") == sorted([
        ("KXFEDDECISION-26OCT", "2026-10", None), ("FEDDECISION-24MAR20", "2024-03", 20), ("FEDDECISION-24XXX", None, None), ("OTHER-1", None, None)], key=order)


def test_settlement_feed(spark):
    feed = spark.createDataFrame([
        (d("2022-01-03"), "ZQF2", 99.0, 1, 1, "2022-01-03 20:00:00", 3), (d("2022-01-03"), "ZQF2", 99.1, 2, 1, "2022-02-01 01:00:00", 3),
        (d("2022-01-03"), "ZQF2", 50.0, 2, 1, "2022-03-01 01:00:00", 9), (d("2031-06-02"), "ZQF2", 97.0, 1, 2, "2031-06-02 20:00:00", 3),
        (d("2022-01-03"), "ZQF2-ZQG2", 0.1, 1, 3, "2022-01-03 20:00:00", 3), (d("1999-12-31"), "ZQF0", 95.0, 1, 4, "1999-12-31 20:00:00", 3),
        (d("2022-01-03"), "ZQG7", 95.0, 1, 5, "2022-01-03 20:00:00", 3)],
        "trade_date date, symbol string, price double, stat_flags int, instrument_id bigint, r string, stat_type int").withColumn(
        "ts_recv", F.col("r").cast("timestamp")).drop("r")
    assert rows(settlement_outrights(feed), "trade_date", "symbol", "dm", "h", "price") == [
        (d("2022-01-03"), "ZQF2", "2022-01", 0, 99.1), (d("2031-06-02"), "ZQF2", "2032-01", 7, 97.0)]


def test_bars(spark):
    df = spark.createDataFrame([("ZQU26.CBT", d("2026-09-11"), 96.0, 97.0, 95.0, 96.2675, float("nan")), ("ZQ=F", d("2026-09-11"), float("nan"), 1.0, 1.0, 96.0, 7.0)],
                               "symbol string, date date, open double, high double, low double, close double, volume double")
    out = normalise_bars(df, "symbol")
    assert rows(out, "contract", "event_id", "delivery_month", "front_contract_est", "open", "settle", "volume", "open_interest") == sorted([
        ("ZQU26", "2026-09", "2026-09", None, 96.0, 96.2675, None, None), ("ZQ=F", "2026-09", None, "ZQU26", None, 96.0, 7, None)], key=order)
    assert rows(futures_bars(out, F.lit("2026-09-11").cast("date")), "contract", "is_continuous", "is_partial", "contract_month") == [
        ("ZQ=F", True, True, "2026-09"), ("ZQU26", False, True, "2026-09")]


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "EFFR.csv").write_text("observation_date,EFFR\n2026-01-01,.\n2026-01-02,3.63\n")
    (tmp_path / "SOFR.csv").write_text("DATE,SOFR\n2026-01-02,3.60\nnot a date,1\n")
    paths = [str(tmp_path / f) for f in ("EFFR.csv", "SOFR.csv")]
    rates = read_series_csv(spark, paths)
    assert [f.name for f in rates.schema] == [f.name for f in RATES]
    assert rows(rates, "series_id", "date", "value", "ts") == sorted([
        ("EFFR", d("2026-01-01"), None, epoch("2026-01-01T00:00:00")), ("EFFR", d("2026-01-02"), 3.63, epoch("2026-01-02T00:00:00")),
        ("SOFR", d("2026-01-02"), 3.6, epoch("2026-01-02T00:00:00"))], key=order)
    assert rows(unreadable_dates(spark, paths), "series_id", "raw_date", "raw_value") == [("SOFR", "not a date", "1")]
    assert rows(series_header_check(spark, paths), "series_id", "header_ok") == [("EFFR", True), ("SOFR", False)]

    (tmp_path / "manifest.json").write_text('{\n "fetched_at_utc": "2026-09-17T01:02:03",\n "x": {"y": 1}}')
    fetched = manifest_value(spark, str(tmp_path / "manifest.json"), "fetched_at_utc")
    flagged = rates.withColumn("late", F.col("date") >= F.substring(fetched.scalar(), 1, 10).cast("date"))
    assert flagged.where("late").count() == 0 and fetched.first()[0].startswith("2026-09-17")

    a = spark.createDataFrame([(2, "x"), (1, "y")], "k int, a string")
    b = spark.createDataFrame([(3, 1.5)], "k int, b double")
    write_sorted(a, str(tmp_path / "parts" / "a"), ["k"], files=1)
    write_sorted(b, str(tmp_path / "parts" / "b"), ["k"])
    both = ordered("k int, a string, b double")
    expected = sorted([(1, "y", None), (2, "x", None), (3, None, 1.5)], key=order)
    assert rows(assemble_parts(spark, str(tmp_path / "parts"), both), "k", "a", "b") == expected
    folders = [str(tmp_path / "parts" / x) for x in "ab"]
    assert rows(read_union_by_name(spark, folders, both), "k", "a", "b") == expected
    assert rows(read_union_by_name(spark, folders), "k", "a", "b") == expected
    assert [r.k for r in spark.read.parquet(folders[0]).collect()] == [1, 2]

    spark.sql(f"CREATE DATABASE IF NOT EXISTS scratch LOCATION '{tmp_path}/db'")
    for n in (1, 2):
        table = materialise(spark.range(n), "scratch.t")
    register_views({"v_t": table})
    assert rows(named_table_counts(spark, ["v_t", "scratch.t"]), "table_name", "n_rows") == [("scratch.t", 2), ("v_t", 2)]
    spark.sql("DROP DATABASE scratch CASCADE")
