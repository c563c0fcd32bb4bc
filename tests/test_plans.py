"""Spine, panel, checks and hedge layer on small inputs with known answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tenorgrid.operators.aggregates import error_summary
from tenorgrid.plans import coverage as cov
from tenorgrid.plans import hedge, quality, spine as sp
from tenorgrid.plans.futures import fair_prices, implied_probabilities, rate_calendar, settlement_check
from tenorgrid.plans.ladder import daily_points, point_ladder_daily
from tenorgrid.plans.panel import Panel
from tenorgrid.sources.schemas import FUTURES_BARS, POINT_MARKETS, POINTS, QUOTE_BARS, RATES, SPINE, TRADES
from tests.helpers import d, epoch, rows


def table(spark, schema, *records):
    """Rows given as dictionaries; fields left out are NULL."""
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in records], schema)


@pytest.fixture(scope="module")
def calendar(spark):
    return sp.decision_calendar(spark).withColumns(sp.calendar_columns()).cache()


def test_calendar(calendar):
    by = {str(r.meeting_date): r for r in calendar.collect()}
    assert len(by) == 49
    for day in ("2024-01-31", "2024-07-31"):
        assert by[day].delta == 0 and by[day].days_post == 0
    assert by["2026-09-16"].delta == 14 / 30 and by["2026-09-16"].contract_symbol == "ZQU26"


def test_instrument_selection(calendar):
    picked = hedge.select_instrument(calendar)
    got = picked.agg(F.count_if("front_eligible"), F.count_if("back_eligible"), F.count("instrument"),
                     F.count_if(F.col("instrument").isNull())).first()
    assert tuple(got) == (27, 23, 45, 4)
    last_day = picked.where("w = 0 AND instrument IS NOT NULL").select("instrument", "span").distinct().collect()
    assert all(tuple(r) == ("FRONT", 1.0) for r in last_day)


def test_front_exposure(calendar):
    share = {r.days_before: r.share_blind for r in hedge.front_exposure(calendar, [19, 30]).collect()}
    dates = [(r.meeting_date, r.effective_date) for r in calendar.collect()]
    blind = lambda n: sum((m - dt.timedelta(days=n)).strftime("%Y%m") < e.strftime("%Y%m") for m, e in dates) / len(dates)
    assert share == {n: pytest.approx(blind(n)) for n in (19, 30)} and share[30] == 1.0


def test_spine(spark):
    cal = spark.createDataFrame([(d("2026-09-16"),), (d("2026-10-28"),), (d("2026-12-09"),)], "meeting_date date")
    events = spark.createDataFrame([("KXFEDDECISION-26SEP", 2), ("FEDDECISION-26SEP16", 1), ("KXFEDDECISION-26OCT", 3), ("JUNK", 4)], "event_id string, seq int")
    legs = spark.createDataFrame([
        ("FEDDECISION-26SEP16", "H25", "t1", "settled", "2026-09-16T17:59:00Z", "yes"), ("FEDDECISION-26SEP16", "H0", "t2", "closed", "2026-09-16T17:58:00Z", "no")],
        "event_id string, leg string, ticker string, status string, close string, result string")
    points = spark.createDataFrame([("b", "Fed decision in September?", "2026-09-16"), ("a", "Fed Interest Rates: September 2026", "2026-09-16T12:00:00Z"),
                                    ("c", "Dissents?", "2026-09-16"), ("x", "Fed decision in May?", "2026-05-01")], "event_id string, title string, end string")
    target = spark.createDataFrame([(d("2026-09-16"), 4.0), (d("2026-09-17"), 4.25)], "date date, value double")
    futures = spark.createDataFrame([("ZQU26", "2026-09"), ("ZQ=F", "2026-10")], "contract string, event_id string")
    out = sp.build_spine(cal, events, legs, points, target, futures)
    assert out.schema.names == SPINE.names
    sep, oct_, dec = out.orderBy("meeting_date").collect()
    assert (sep.ladder_event, sep.ladder_status, sep.ladder_close, sep.ladder_result_outcome) == ("FEDDECISION-26SEP16", "mixed:closed,settled", "2026-09-16T17:58:00Z", "HIKE25")
    assert (sep.point_events, sep.point_events_decision, sep.point_events_other) == (["a", "b", "c"], ["a", "b"], ["c"])
    assert (sep.contract_source, sep.contract_source_symbol, sep.realized_change_bp, sep.realized_outcome) == ("contract", "ZQU26.CBT", 25, "HIKE25")
    assert (oct_.ladder_status, oct_.contract_source, oct_.contract_data_available, oct_.point_events) == ("purged", "continuous_in_month", True, [])
    assert (dec.ladder_event, dec.ladder_status, dec.contract_data_available) == (None, None, False)
    windows = rows(sp.decision_windows(out), "meeting_date", "prev_meeting_date", "prev_effective_date")
    assert windows[0][1:] == (d("2021-12-15"), d("2021-12-16")) and windows[1][1:] == (d("2026-09-16"), d("2026-09-17"))
    direct = sp.dated_links(points, cal)
    assert rows(direct, "meeting_date", "event_id", "role") == rows(sp.spine_links(out), "meeting_date", "event_id", "role")
    markets = table(spark, POINT_MARKETS, dict(market_id="1", event_id="a", outcome="HOLD", volume=None), dict(market_id="2", event_id="b", outcome="HOLD", volume=None))
    linked = sp.link_events(direct, markets)
    assert rows(linked.where("is_primary"), "event_id", "volume") == [("a", 0.0)]
    found = cov.anomalies(spark.createDataFrame([], POINTS), markets, out, events, legs, points)
    got = {(r.check, r.key) for r in found.collect()}
    assert {("several events in a month", "2026-09"), ("ticker does not parse", "JUNK"), ("event not linked", "x"), ("several decision events", "2026-09-16"),
            ("volume is null", "1"), ("volume is null", "2"), ("closes differ", "FEDDECISION-26SEP16")} == got


PRICES = {"CUT50P": 0.005, "CUT25": 0.005, "HOLD": 0.38, "HIKE25": 0.6, "HIKE50P": 0.01}


@pytest.fixture(scope="module")
def panel(spark):
    """One decision: five quoted legs and five point legs on two days, one named contract, a flat rate."""
    spine = table(spark, SPINE, dict(
        meeting_date=d("2026-09-16"), meeting_month="2026-09", ladder_event="KXFEDDECISION-26SEP", ladder_status="active", ladder_result_outcome="HIKE25",
        point_events_decision=["p"], point_events_other=["o"], contract_symbol="ZQU26", contract_source="contract", contract_data_available=True,
        effective_date=d("2026-09-17"), days_in_month=30, days_post=14, delta=14 / 30, realized_change_bp=25, realized_outcome="HIKE25"))
    bar_end = lambda day: epoch(f"{day}T04:00:00")
    bars = table(spark, QUOTE_BARS, *(
        dict(event_id="KXFEDDECISION-26SEP", market_id=k, outcome=k, ts=bar_end(day), interval=1440, bid_close=p - 0.005, ask_close=p + 0.005, vol=10.0, oi=1.0, is_partial=False)
        for k, p in PRICES.items() for day in ("2026-09-11", "2026-09-12")))
    points = table(spark, POINTS, *(
        dict(event_id="p", market_id=f"m{k}", token_id=f"t{k}", outcome=k, outcome_label="Yes", ts=epoch(f"2026-09-10T{h}:00:00"), p=p + bump, fidelity=60)
        for k, p in PRICES.items() for h, bump in ((15, 0.2), (18, 0.0))))
    markets = table(spark, POINT_MARKETS, *(
        dict(event_id="p", market_id=f"m{k}", outcome=k, outcome_detail=k, volume=1.0, decision_date="2026-09-16", start_date="2026-08-01", end_date="2026-09-16") for k in PRICES))
    futures = table(spark, FUTURES_BARS, *(
        dict(contract="ZQU26", event_id="2026-09", delivery_month="2026-09", source_symbol="ZQU26.CBT", date=d(day), settle=96.2675, close=96.2675, volume=v)
        for day, v in (("2026-09-10", 5), ("2026-09-11", 5), ("2026-09-16", 9))))
    rates = table(spark, RATES, *(dict(series_id="EFFR", date=d(day), value=v) for day, v in (
        ("2026-09-09", 3.62), ("2026-09-10", 3.63), ("2026-09-11", 9.99), ("2026-09-12", None))))
    trades = table(spark, TRADES, dict(event_id="KXFEDDECISION-26SEP", market_id="HOLD", trade_id="1", ts=epoch("2026-09-11T14:00:00"), count=2.0))
    raw = {"spine": spine, "quote_bars": bars, "trades": trades, "points": points, "point_markets": markets, "futures": futures, "rates": rates}
    return Panel(raw, F.lit("2026-09-16").cast("date"))


def test_basis_point_check(panel):
    """Expected move 15.25 bp: fair 100 - 3.63 - 14/30 * 0.1525 and the basis that follows."""
    row = panel["basis_daily"].where("date = DATE'2026-09-11'").first()
    assert row.rate_pre == 3.63 and row.rate_pre_date == d("2026-09-10")
    move = (0.6 * 25 + 0.01 * 50 - 0.005 * 75) / 1.0
    assert row.ladder_e_move_bp == pytest.approx(move)
    assert row.ladder_fair == pytest.approx(100 - 3.63 - 14 / 30 * move / 100)
    assert row.basis_ladder_bp == pytest.approx((row.ladder_fair - 96.2675) * 100)
    assert row.ladder_ok and row.points_ok and row.pre_decision and row.ladder_fair_sameday is not None
    assert row.points_fair == pytest.approx(row.ladder_fair)
    assert 100 - 3.63 - 14 / 30 * 0.1561 == pytest.approx(96.2972, abs=5e-5)


def test_probabilities_sum_to_one(panel):
    for name in ("ladder_daily", "point_ladder_daily"):
        for r in panel[name].collect():
            assert sum(r[f"p_{k.lower()}"] for k in PRICES) == pytest.approx(1.0)


def test_coverage_and_checks(panel):
    c = panel["coverage_matrix"].first()
    assert (c.ladder_bars_day, c.ladder_bars_hour, c.ladder_trades, c.points_decision_events, c.points_decision_hourly, c.points_other_events,
            c.contract_rows_total, c.contract_rows_pre_decision, c.basis_days_ladder) == (10, 0, 1, 1, 10, 1, 3, 2, 1)
    got = {r.name: r.passed for r in panel["checks"].collect()}
    assert got.pop("settlement equals month mean") is False
    assert all(got.values()) and len(got) == 14
    assert panel.publish("t_") and panel["trades"].sparkSession.table("t_basis_daily").count() == panel["basis_daily"].count()


def test_trade_coverage(panel):
    assert rows(cov.trade_coverage(panel["trades"], panel["quote_bars"]), "market_id", "n_trades", "trades_contracts", "bar_volume", "bar_volume_before_first_trade", "share_missing") == [
        ("HOLD", 1, 2.0, 20.0, 10.0, 0.5)]


def test_volume_suspect(panel):
    assert [r.volume_suspect for r in panel["futures"].orderBy("date").collect()] == [None, True, False]


def point_inputs(spark, legs):
    points = table(spark, POINTS, *(dict(event_id="p", market_id=m, token_id=m, outcome_label="Yes", ts=epoch("2026-09-10T15:00:00"), p=p, fidelity=60) for m, _, _, p in legs))
    markets = table(spark, POINT_MARKETS, *(dict(event_id="p", market_id=m, outcome=o, outcome_detail=x, volume=1.0, decision_date="2026-09-16") for m, o, x, _ in legs))
    spine = table(spark, SPINE, dict(meeting_date=d("2026-09-16"), effective_date=d("2026-09-17"), point_events_decision=["p"], point_events_other=[]))
    links = sp.link_events(sp.spine_links(spine), markets)
    return point_ladder_daily(daily_points(points, markets), links, sp.decision_windows(spine)).first()


def test_legs_sharing_an_outcome_and_any_hike(spark):
    shared = point_inputs(spark, [("a", "CUT50P", "CUT50", 0.10), ("b", "CUT50P", "CUT75P", 0.05), ("c", "HOLD", "HOLD", 0.35), ("d", "HIKE50P", "HIKE25P", 0.5)])
    assert shared.yes_cut50p == pytest.approx(0.15) and shared.n_outcomes == 3 and shared.n_legs == 4 and shared.n_legs_half == 1
    assert shared.top_is_any_hike and shared.e_move_bp == pytest.approx(-50 * 0.15 + 25 * 0.5)
    exact = point_inputs(spark, [("c", "HOLD", "HOLD", 0.4), ("e", "HIKE25", "HIKE25", 0.2), ("d", "HIKE50P", "HIKE25P", 0.4)])
    assert not exact.top_is_any_hike and exact.e_move_bp == pytest.approx(25 * 0.2 + 50 * 0.4)


def test_zero_weight_move_is_undefined(spark):
    df = spark.createDataFrame([(5.33, 0.0, 94.6), (5.33, 0.5, 94.545)], "r double, delta double, s double")
    df = df.withColumns(fair_prices(F.col("r"), F.col("delta"), F.col("s"))).withColumns(implied_probabilities(F.col("implied_move_bp")))
    a, b = df.collect()
    assert a.implied_move_bp is None and (a.p_hike25_fut, a.p_hold_fut, a.p_cut25_fut, a.implied_defined) == (0, 1, 0, False)
    assert b.implied_move_bp == pytest.approx(25) and b.p_hike25_fut == pytest.approx(1) and b.implied_defined


def test_month_identity(spark):
    march = [(d("2024-03-01") + dt.timedelta(days=i), 5.33) for i in range(31)]
    rates = spark.createDataFrame(march, "date date, effr double")
    bars = spark.createDataFrame([(d("2024-03-27"), 94.0), (d("2024-03-28"), 94.6675)], "date date, settle double")
    row = settlement_check(bars, rate_calendar(rates)).first()
    assert row.implied_settle == pytest.approx(94.67) and row.diff_bp == pytest.approx(-0.25) and row.n_days == 31
    check = quality.settlement_identity(settlement_check(bars, rate_calendar(rates)), "2024-01", "2024-12", 1)
    assert check.first().passed


def test_hedge_error_and_decision(spark):
    """A 25 bp cut on an exact calendar: the spread settles on the cut and the hedge misses nothing."""
    spine = spark.createDataFrame([(d("2024-09-18"), d("2024-09-19"), 12 / 30, -25)], "meeting_date date, effective_date date, delta double, realized_change_bp int")
    days = [d("2024-08-01") + dt.timedelta(days=i) for i in range(92)]
    cal = spark.createDataFrame([(x, 5.33 if x < d("2024-09-19") else 5.08) for x in days], "date date, effr_ff double")
    picked = hedge.select_instrument(spine)
    assert rows(picked, "instrument", "near_month", "far_month") == [("FRONT", "2024-09", "2024-10")]
    err = hedge.hedge_error(cal, picked, spine)
    assert err.first().err_cents == pytest.approx(0, abs=1e-9)
    prices = spark.createDataFrame([(d("2024-09-10"), "2024-09", 94.77), (d("2024-09-10"), "2024-10", 94.92), (d("2024-09-11"), "2024-09", 94.77)],
                                   "date date, delivery_month string, settle double")
    assert rows(hedge.implied_decision(prices, picked), "date", "implied_decision") == [(d("2024-09-10"), pytest.approx(-0.25))]
    step = hedge.pass_through(spine.withColumn("month_end", F.last_day("meeting_date")), cal).first()
    assert step.step_error_bp == pytest.approx(0, abs=1e-9) and step.mean_resid_bp == pytest.approx(0, abs=1e-9)
    summary = error_summary(err, F.col("err_cents"), 1e-3).first()
    assert (summary.n, summary.n_within) == (1, 1)


def test_payoff_and_replication(spark):
    df = spark.createDataFrame([(5.0, 1.0), (-5.0, 1.0), (0.5, 0.0)], "b double, e double")
    assert rows(hedge.net_payoff(df, "b", "e", F.lit(2.0), 1.0), "b", "net_cents") == [(-5.0, 4.0), (5.0, 2.0)]
    legs = spark.createDataFrame([("CUT50P", -50.0), ("CUT25", -25.0), ("HOLD", 0.0), ("HIKE25", 25.0), ("HIKE50P", 50.0)], "outcome string, units double")
    assert {r.payoff for r in hedge.replication_payoff(legs).collect()} == {0.0}
    days = spark.createDataFrame([(d("2026-09-15"), d("2026-09-16")), (d("2026-09-16"), d("2026-09-16"))], "date date, meeting_date date")
    assert rows(hedge.before_decision(days), "date") == [(d("2026-09-15"),)]
    one = spark.range(1)
    assert one.select(hedge.basis_cents(F.lit(10.0), F.lit(4.0))).first()[0] == 24.0
    assert one.select(hedge.friction_per_digital(F.lit(22.0), F.lit(0.467))).first()[0] == pytest.approx(4.52, abs=0.01)
    assert one.select(hedge.digitals_per_spread(F.lit(0.5))).first()[0] == pytest.approx(520.875)


def test_following_contract(spark):
    spine = spark.createDataFrame([(d("2026-09-16"), d("2026-09-17")), (d("2026-10-28"), d("2026-10-29"))], "meeting_date date, effective_date date")
    assert rows(hedge.following_contract(spine), "meeting_date", "following_month", "w_following", "other_meeting", "other_delta") == [
        (d("2026-09-16"), "2026-10", 1.0, d("2026-10-28"), pytest.approx(3 / 31)), (d("2026-10-28"), "2026-11", 1.0, None, 0.0)]


def test_trailing_window(spark):
    pts = table(spark, POINTS, *(dict(market_id="m", token_id="t", ts=ts, p=0.5, fidelity=f) for ts, f in (
        (0, 60), (100 * 86400, 60), (100 * 86400 + 3000, 1), (100 * 86400 + 4000, 1), (60 * 86400, 1), (50 * 86400, 1))))
    ends = spark.createDataFrame([("m", True, 200 * 86400)], "market_id string, closed boolean, end_ts long")
    bounds = cov.trailing_bounds(pts, ends, F.lit(10**9))
    assert rows(bounds, "keep_from", "keep_until") == [(55 * 86400 + 3600, 100 * 86400 + 3600)]
    assert sorted(r.ts for r in cov.trailing_trim(pts, bounds).where("fidelity = 1").collect()) == [60 * 86400, 100 * 86400 + 3000]
