"""Dense grids, calendars and the traps around them."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
import datetime as dt


from tenorgrid.functions.times import (is_federal_holiday, is_weekend, iso_epoch, local_date, month_contract, next_business_day)
from tenorgrid.functions.values import bucket_change, mid_price, ratio, taker_fee
from tenorgrid.operators.aggregates import last_value
from tenorgrid.operators.asof import asof_by_date, asof_join, calendar_ffill
from tenorgrid.operators.dedup import duplicate_count
from tenorgrid.operators.grid import date_series, dense_ffill
from tenorgrid.operators.joins import nearest_match
from tenorgrid.operators.ordered import gaps
from tenorgrid.plans.ladder import daily_quotes, quote_bars
from tests.helpers import d, epoch, order, rows

DAYS = [d("2026-01-01") + dt.timedelta(days=i) for i in range(40)]


def grid(spark, data, cap=None):
    df = spark.createDataFrame(data, "e string, leg string, d date, mid double" + (", cap date" if cap else ""))
    return dense_ffill(df, ["e"], ["leg"], "d", ["mid"], cap="cap" if cap else None)


def test_last_row_is_carried_even_when_its_mid_is_null(spark):
    data = [("e", "A", DAYS[0], 0.4), ("e", "A", DAYS[2], None)] + [("e", "B", DAYS[i], 0.1) for i in range(4)]
    out = rows(grid(spark, data), "leg", "d", "mid", "stale_days", "obs_date")
    assert len(out) == 8
    assert ("A", DAYS[3], None, 1, DAYS[2]) in out and ("A", DAYS[1], 0.4, 1, DAYS[0]) in out


def test_span_is_the_groups(spark):
    data = [("e", "A", DAYS[0], 0.4), ("e", "B", DAYS[3], 0.6)]
    out = rows(grid(spark, data), "leg", "d", "mid", "stale_days")
    assert ("B", DAYS[0], None, None) in out and ("A", DAYS[3], 0.4, 3) in out and len(out) == 8


def test_all_points_after_the_cap_give_no_rows(spark):
    assert grid(spark, [("e", "A", DAYS[5], 0.4, DAYS[1])], cap=True).count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.tuples(st.sampled_from("ef"), st.sampled_from("ABC"), st.integers(0, 25)), st.sampled_from([None, 0.1, 0.9]), min_size=1),
       st.integers(0, 30))
def test_grid_against_brute_force(spark, obs, cap):
    data = [(e, leg, DAYS[i], v, DAYS[cap]) for (e, leg, i), v in obs.items()]
    expected = []
    for e in {k[0] for k in obs}:
        seen = [i for (ee, _, i) in obs if ee == e]
        for leg in {k[1] for k in obs if k[0] == e}:
            for i in range(min(seen), min(max(seen), cap) + 1):
                past = [j for (ee, ll, j) in obs if ee == e and ll == leg and j <= i]
                expected.append((e, leg, DAYS[i], obs[e, leg, max(past)] if past else None, i - max(past) if past else None))
    assert rows(grid(spark, data, cap=True), "e", "leg", "d", "mid", "stale_days") == sorted(expected, key=order)


def test_calendar_fill_and_strict_lookup(spark):
    rate = spark.createDataFrame([(DAYS[0], 5.0), (DAYS[3], 4.0)], "date date, r double")
    assert rows(calendar_ffill(rate, "date", ["r"]), "date", "r", "obs_date") == [
        (DAYS[0], 5.0, DAYS[0]), (DAYS[1], 5.0, DAYS[0]), (DAYS[2], 5.0, DAYS[0]), (DAYS[3], 4.0, DAYS[3])]
    bars = spark.createDataFrame([(x, i) for i, x in enumerate([DAYS[0], DAYS[3], DAYS[3], DAYS[9]])], "day date, i int")
    out = asof_by_date(bars, "day", rate, "date", strict=True)
    assert rows(out, "i", "r", "matched_t") == [(0, None, None), (1, 5.0, DAYS[0]), (2, 5.0, DAYS[0]), (3, 4.0, DAYS[3])]


def test_empty_date_range_gives_no_row(spark):
    df = spark.createDataFrame([("a", DAYS[3], DAYS[1]), ("b", DAYS[1], DAYS[2])], "k string, d0 date, d1 date")
    assert rows(date_series(df, "d0", "d1", "day"), "k", "day") == [("b", DAYS[1]), ("b", DAYS[2])]


def test_bar_end_covers_one_local_day(spark):
    ends = ["2026-01-10T05:00:00", "2026-03-08T05:00:00", "2026-03-09T05:00:00", "2026-03-10T04:00:00", "2026-07-02T04:00:00"]
    df = spark.createDataFrame([(epoch(t),) for t in ends], "ts long")
    got = [str(r[0]) for r in df.select(local_date("ts", shift_s=43200)).collect()]
    assert got == ["2026-01-09", "2026-03-07", "2026-03-08", "2026-03-09", "2026-07-01"]


def test_nearest_within_eight_days(spark):
    dim = spark.createDataFrame([(d("2026-01-28"),), (d("2026-02-07"),)], "m date")
    df = spark.createDataFrame([(d("2026-01-23"),), (d("2026-01-19"),), (d("2026-02-02"),), (None,)], "x date")
    assert rows(nearest_match(df, "x", dim, "m", 8, "n"), "x", "n") == sorted(
        [(d("2026-01-23"), d("2026-01-28")), (d("2026-01-19"), None), (d("2026-02-02"), d("2026-01-28")), (None, None)], key=order)


def test_gaps(spark):
    df = spark.createDataFrame([("a", DAYS[0]), ("a", DAYS[11]), ("a", DAYS[12])], "k string, d date")
    assert rows(gaps(df, ["k"], "d", 10), "k", "gap_start", "gap_end", "gap_days") == [("a", DAYS[0], DAYS[11], 11)]


def test_next_business_day_against_search(spark):
    days = spark.sql("SELECT explode(sequence(date'1990-01-01', date'2060-12-31', interval 1 day)) AS d")
    flags = days.select("d", (is_weekend("d") | is_federal_holiday("d")).alias("closed"), next_business_day("d").alias("n")).orderBy("d").collect()
    following = None
    for r in reversed(flags):
        if following is not None and r.d.year < 2060:
            assert r.n == following
        if not r.closed:
            following = r.d
    closed = {str(r.d) for r in flags if r.closed}
    assert {"2021-06-18", "2021-12-31", "2023-01-02", "2024-11-28", "2026-07-03"} <= closed and "2020-06-19" not in closed


def test_values(spark):
    df = spark.createDataFrame([(0.0, 0.99, -75), (0.0, 0.98, -50), (0.87, 0.88, -25), (0.1, 0.2, 0), (0.1, 0.2, 25), (0.1, 0.2, 50), (0.1, 0.2, 10), (0.1, 0.2, None)],
                               "bid double, ask double, bp int")
    got = df.select(mid_price("bid", "ask").alias("m"), bucket_change("bp").alias("o")).collect()
    assert [r.m for r in got][:3] == [None, 0.49, 0.875]
    assert [r.o for r in got] == ["CUT50P", "CUT50P", "CUT25", "HOLD", "HIKE25", "HIKE50P", "OTHER", None]
    one = spark.range(1)
    fee = lambda c, p: one.select(taker_fee(F.lit(c), F.lit(p))).first()[0]
    assert fee(100, 0.5) == 1.75 and fee(1, 0.5) == 0.02 and fee(1, 0.0) == 0.0
    assert one.select(ratio(F.lit(1.0), F.lit(0.0))).first()[0] is None
    assert one.select(month_contract(F.lit("2026-09-16").cast("date"), "ZQ")).first()[0] == "ZQU26"
    iso = lambda x: one.select(iso_epoch(F.lit(x))).first()[0]
    assert iso("2026-09-16") == epoch("2026-09-16T00:00:00") == iso("2026-09-16T00:00:00Z") == iso("2026-09-16 02:00:00+02:00")
    assert iso(" ") is None and iso("soon") is None


def test_null_traps(spark):
    df = spark.createDataFrame([("a", 1, 0.5), ("a", 2, None), ("b", 1, None)], "k string, t int, v double")
    assert rows(df.groupBy("k").agg(last_value("v", "t").alias("v")), "k", "v") == [("a", 0.5), ("b", None)]
    keys = spark.createDataFrame([(1, None), (1, None), (1, 2), (None, 2)], "a int, b int")
    assert tuple(duplicate_count(keys, ["a", "b"]).first()) == (4, 3, 1)


def test_asof_by_date_reads_the_facts_once(spark):
    bars = spark.createDataFrame([(1, d("2026-01-01")), (2, d("2026-01-05")), (3, d("2026-02-01")), (4, None), (5, d("2025-12-01"))], "i int, day date")
    rate = spark.createDataFrame([(d("2026-01-01"), 1.0), (d("2026-01-04"), None), (d("2026-01-05"), 3.0), (d("2026-01-05"), 2.0)], "date date, r double")
    strict = asof_by_date(bars, "day", rate, "date", strict=True)
    assert rows(strict, "i", "matched_t", "r") == sorted([(1, None, None), (2, d("2026-01-04"), None), (3, d("2026-01-05"), 3.0), (4, None, None), (5, None, None)], key=order)
    both = asof_by_date(bars, "day", rate, "date")
    assert rows(both, "i", "matched_t", "r") == sorted([(1, d("2026-01-01"), 1.0), (2, d("2026-01-05"), 3.0), (3, d("2026-01-05"), 3.0), (4, None, None), (5, None, None)], key=order)


def test_rows_that_cannot_match_enter_no_ordered_group(spark):
    left = spark.createDataFrame([("a", 5, 1), (None, 5, 2), ("a", None, 3)], "k string, t int, i int")
    right = spark.createDataFrame([("a", 4, 1.0), (None, 4, 2.0)], "k string, s int, v double")
    assert rows(asof_join(left, right, ["k"], "t", "s"), "i", "v") == [(1, 1.0), (2, None), (3, None)]


def test_last_bar_of_a_day_counts_in_either_order(spark):
    bars = [("E", "E-M", "HOLD", 1440, 1767330000 + k * 100, 0.1 * (k + 1), 0.9) for k in range(2)]
    for order_ in (bars, bars[::-1]):
        df = spark.createDataFrame(order_, "event_id string, market_id string, outcome string, interval int, ts bigint, bid_close double, ask_close double")
        full = quote_bars(df.withColumns({c: F.lit(None).cast("double") for c in ("price_close", "price_mean", "vol", "oi")}).withColumn("is_partial", F.lit(False)))
        got = daily_quotes(full, "").collect()
        assert len(got) == 1 and got[0]["bid_close"] == pytest.approx(0.2)
